"""The release corpus by plain Python over lists, row after row: what the build is held against."""

import copy
import hashlib
import json

from loomsql.functions.keys import stable_hash_py
from loomsql.plans import program

OPERATORS = ["missing_comma", "unknown_column", "invalid_join_condition", "missing_group_by"]
STAGE = {"missing_comma": "parse", "unknown_column": "resolve", "invalid_join_condition": "logic", "missing_group_by": "logic"}


def text_of(p, item_sep=", "):
    def both(x):
        return " AND ".join(e["expression"] for e in x)

    items = [f"{i['expression']} AS {i['alias']}" for i in p["select_items"]]
    lines = ["SELECT " + item_sep.join(items[:2]), f"FROM {p['base_table']['name']} AS {p['base_table']['alias']}"]
    lines += [f"INNER JOIN {j['right_table']['name']} AS {j['right_table']['alias']} ON {j['on_expression']}" for j in p["joins"]]
    for word, said in (("WHERE", both(p["where_predicates"])), ("GROUP BY", ", ".join(p["group_by"])), ("HAVING", both(p["having"])), ("ORDER BY", ", ".join(f"{o['expression']} {o['direction']}" for o in p["order_by"]))):
        lines += [f"{word} {said}"] if said else []
    return "\n".join(lines + ([f"LIMIT {p['limit']}"] if p["limit"] is not None else []))


def corrupted(p, operator, family):
    q = copy.deepcopy(p)
    if operator == "missing_comma":
        return q, text_of(q, " ")
    if operator == "unknown_column":
        q["select_items"][0] |= {"expression": q["select_items"][0]["expression"].split(".")[0] + ".unknown_column", "is_aggregate": False}
    if operator == "invalid_join_condition":
        if not q["joins"]:
            return None
        bad = "shipment_status" if family == "logistics" else "t1_invalid"
        q["joins"][0]["on_expression"] = f"t1.warehouse_id = {q['joins'][0]['right_table']['alias']}.{bad}"
    if operator == "missing_group_by":
        if not q["group_by"]:
            return None
        q["group_by"] = []
    return q, text_of(q)


def stage_of(q, schema, parses):
    """The first stage that fails on a program of the generator's shapes."""
    if not parses:
        return "parse"
    names = {"t1": q["base_table"]["name"]} | {j["right_table"]["alias"]: j["right_table"]["name"] for j in q["joins"]}
    said = [x["expression"] for part in ("select_items", "where_predicates", "having", "order_by") for x in q[part]] + q["group_by"] + [j["on_expression"] for j in q["joins"]]
    for expression in said:
        for token in expression.replace("(", " ").replace(")", " ").split():
            if "." in token and token.split(".")[1] not in {c.name for c in schema.table(names[token.split(".")[0]]).columns}:
                return "resolve"
    edges = {frozenset(((a, b), (c, d))) for a, b, c, d in schema.join_graph}
    for j in q["joins"]:
        ends = [tuple(e.split(".")) for e in j["on_expression"].split(" = ")]
        if frozenset((names[a], c) for a, c in ends) not in edges:
            return "logic"
    return "logic" if any(i["is_aggregate"] for i in q["select_items"]) and not q["group_by"] else "valid"


def canonical(p):
    def renamed(x):
        if isinstance(x, dict):
            return {k: v if k == "metadata" else renamed(v) for k, v in x.items()}
        if isinstance(x, list):
            return [renamed(v) for v in x]
        if isinstance(x, str):
            for k in "123":
                x = "s" + k if x == "t" + k else x.replace(f"t{k}.", f"s{k}.")
        return x

    q = renamed(copy.deepcopy(p))
    q["metadata"] = dict(p["metadata"])
    q["metadata"]["program_hash"] = stable_hash_py(q)
    return q


def loose(text):
    for word in ("SELECT", "FROM", "INNER JOIN", "WHERE", "GROUP BY", "HAVING", "ORDER BY", "LIMIT", " AS ", " ASC"):
        text = text.replace(word, word.lower())
    return text.replace("\n", "  \n")


def row_of(kind, number, operator, p, schema):
    family, meta = schema.schema_family, p["metadata"]
    label = {"clean": "clean", "corrupt": "repair", "normalize": "canonicalization"}[kind]
    out = {
        "task": {"clean": "generate_clean_query"}.get(kind, label), "dialect": p["dialect"], "db_schema_id": meta["schema_id"], "schema_family": family, "is_source_valid": kind != "corrupt",
        "complexity": meta["complexity"], "template_id": p["template_id"], "provenance": "manual_config_v1", "num_joins": len(p["joins"]), "nesting_depth": 0, "ambiguity_flag": False,
        "id": f"{dict(clean='sqlclean', corrupt='sqlcorrupt', normalize='sqlnormalize')[kind]}_{family}_{number:06d}",
        "semantic_hash": stable_hash_py({"program_hash": stable_hash_py(p), "schema_id": meta["schema_id"], "task": label, "template_id": p["template_id"]}),
        "source_sql": text_of(p), "source_ast_hash": stable_hash_py(p), "target_sql": None, "target_ast_hash": None, "error_tags": [], "normalization_rules": [],
        "corruption_recipe_id": None, "extra": {}, "config": "clean_reference", "render_variant_id": "canonical",
    }
    if kind == "corrupt":
        q, text = corrupted(p, operator, family)
        out |= {"source_sql": text, "source_ast_hash": stable_hash_py(q), "target_sql": text_of(p), "target_ast_hash": stable_hash_py(p), "corruption_recipe_id": operator, "render_variant_id": operator}
        out |= {"error_tags": ["group_by_missing" if operator == "missing_group_by" else operator], "extra": {"intended_failure_stage": STAGE[operator]}, "config": f"corrupt_{meta['complexity']}"}
    if kind == "normalize":
        q = canonical(p)
        out |= {"source_sql": loose(text_of(p)), "target_sql": text_of(q), "target_ast_hash": stable_hash_py(q), "config": "normalize_structural", "render_variant_id": "normalized"}
        out |= {"normalization_rules": ["deterministic_aliases", "keyword_casing", "deterministic_spacing", "explicit_order_direction"]}
    return out


def build(config, families):
    """The rows in release order."""
    g, s = config["generation"], config["splits"]
    done, made, attempt = {"clean": 0, "corrupt": 0, "normalize": 0}, [], 0
    while len(made) < g["target_total_rows"] * g["oversample_factor"] and attempt < g["max_attempts"]:
        schema, complexity = families[attempt % len(families)], g["complexities"][attempt % len(g["complexities"])]
        names = g["templates"][complexity]
        p = program.generate(schema, template_id=names[attempt % len(names)], complexity=complexity, seed=g["seed_start"] + attempt)
        attempt += 1
        if stage_of(p, schema, True) != "valid":
            continue
        kind = min(done, key=lambda k: done[k] / max(g["task_targets"][k], 1))
        operator = g["corruption_operators"][done["corrupt"] % len(g["corruption_operators"])] if kind == "corrupt" else None
        if operator:
            tried = corrupted(p, operator, schema.schema_family)
            if not tried or stage_of(tried[0], schema, operator != "missing_comma") != STAGE[operator]:
                continue
        done[kind] += 1
        made.append(row_of(kind, done[kind], operator, p, schema))
    seen, groups = set(), {}
    for r in made:
        key = tuple(r[k] for k in ("dialect", "db_schema_id", "source_sql", "target_sql", "task"))
        if key not in seen:
            seen.add(key)
            groups.setdefault(r["semantic_hash"], {}).setdefault(r["render_variant_id"], r)
    kept = [r for variants in groups.values() for r in list(variants.values())[: g["max_render_variants_per_semantic_group"]]][: g["target_total_rows"]]
    by_family = {}
    for r in kept:
        by_family.setdefault((r["schema_family"], r["template_id"]), []).append(r)
    order, first, then = list(by_family), s["validation_template_families"], s["in_domain_template_families"]
    for f, members in by_family.items():
        key = stable_hash_py({"schema_family": f[0], "template_id": f[1]})
        bucket = int(stable_hash_py({"group_key": key})[:8], 16) % 100
        if f[0] in s["ood_schema_families"] or f[1] in s["ood_template_ids"]:
            split = "test_ood"
        elif f in order[:first]:
            split = "validation"
        else:
            split = "test_in_domain" if f in order[first : first + then] or bucket < int(s["in_domain_eval_ratio"] * 100) else "train"
        for r in members:
            r["split"] = split
    return [r for members in by_family.values() for r in members]


def digests(rows):
    """(task, schema family, rows, SHA-256 of their ids, splits, texts and hashes in the order of ids)."""
    out = {}
    for r in sorted(rows, key=lambda r: r["id"]):
        line = "|".join([r["id"], r["split"], r["source_sql"], r["target_sql"] or "", r["source_ast_hash"], r["target_ast_hash"] or "", r["semantic_hash"]])
        out.setdefault((r["task"], r["schema_family"]), []).append(line)
    return sorted((*k, len(v), hashlib.sha256("\n".join(v).encode()).hexdigest()) for k, v in out.items())


if __name__ == "__main__":
    from loomsql.plans.corpus import RELEASE
    from loomsql.sources.schemas import FAMILIES

    found = build(RELEASE, FAMILIES)
    print(json.dumps(digests(found), indent=1), len(found))
