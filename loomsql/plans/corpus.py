"""Corpus building: attempts in parallel, a small ordered fold that schedules tasks, then rows, dedup, splits, release."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loomsql.functions import keys
from loomsql.functions import programs as P
from loomsql.operators import dedup, splits, validate
from loomsql.plans import program
from loomsql.sources import export, schemas

#: Fields of a record, in order, and the tasks' labels (id namespace, task, label in the semantic hash).
FIELDS = "id config task dialect db_schema_id schema_family source_sql is_source_valid complexity template_id source_ast_hash semantic_hash provenance split target_sql error_tags normalization_rules num_joins nesting_depth corruption_recipe_id target_ast_hash ambiguity_flag render_variant_id extra".split()
TASKS = {"clean": ("sqlclean", "generate_clean_query", "clean"), "corrupt": ("sqlcorrupt", "repair", "repair"), "normalize": ("sqlnormalize", "canonicalization", "canonicalization")}


def schedule(found: list, operators: list[str], targets: dict[str, int], most: int) -> list[tuple]:
    """(attempt, task, number, operator) by an ordered fold over (attempt, valid, eligible operators): each valid attempt
    goes to the task that is least filled for its target; an operator that doesn't fit leaves its task waiting. Numbers
    count from 1 in each task."""
    done, out = dict.fromkeys(TASKS, 0), []
    for attempt, valid, eligible in found:
        if len(out) >= most:
            break
        if not valid:
            continue
        task = min(TASKS, key=lambda t: done[t] / max(targets.get(t, 0), 1))
        operator = operators[done["corrupt"] % len(operators)] if task == "corrupt" else None
        if operator is None or operator in eligible:
            done[task] += 1
            out.append((attempt, task, done[task], operator))
    return out


def _chosen(operator: Column, values: dict) -> Column:
    found = F.lit(None)
    for name, value in values.items():
        found = F.when(operator == name, value).otherwise(found)
    return found


def rows(decided: DataFrame, families: list[schemas.Schema]) -> DataFrame:
    """Records, with `pos`, from attempt, schema_family, program, task_kind, number, operator."""
    p, family, kind, operator = F.col("program"), F.col("schema_family"), F.col("task_kind"), F.col("operator")
    is_ = lambda k: kind == k
    canonical = P.canonical(p)
    own, target = P.program_hash(p), P.render(p)
    # Of a corruption that leaves the program as it is, the clean hash stands.
    broken = _chosen(operator, {o: P.program_hash(P.corrupted(p, o, family)) for o in P.CORRUPTIONS})
    broken_sql = _chosen(operator, {o: P.corrupted_sql(p, o, family) for o in P.CORRUPTIONS})
    label = lambda i: F.when(is_("clean"), TASKS["clean"][i]).when(is_("corrupt"), TASKS["corrupt"][i]).otherwise(TASKS["normalize"][i])
    none = F.array().cast("array<string>")
    values = {
        "id": keys.row_id(label(0), family, F.col("number")),
        "config": F.when(is_("clean"), "clean_reference").when(is_("corrupt"), F.concat(F.lit("corrupt_"), p["metadata"]["complexity"])).otherwise("normalize_structural"),
        "task": label(1),
        "dialect": p["dialect"],
        "db_schema_id": p["metadata"]["schema_id"],
        "schema_family": family,
        "source_sql": F.when(is_("clean"), target).when(is_("corrupt"), broken_sql).otherwise(P.noncanonical(p)),
        "is_source_valid": ~is_("corrupt"),
        "complexity": p["metadata"]["complexity"],
        "template_id": p["template_id"],
        "source_ast_hash": F.when(is_("corrupt"), broken).otherwise(own),
        "semantic_hash": keys.semantic_hash(p["metadata"]["schema_id"], p["template_id"], label(2), own),
        "provenance": F.element_at(F.create_map(*[F.lit(x) for s in families for x in (s.schema_id, s.provenance)]), p["metadata"]["schema_id"]),
        "split": F.lit("train"),
        "target_sql": F.when(is_("corrupt"), target).when(is_("normalize"), P.render(canonical)),
        "error_tags": F.coalesce(_chosen(operator, {o: F.array(F.lit(v[2])) for o, v in P.CORRUPTIONS.items()}), none),
        "normalization_rules": F.when(is_("normalize"), F.array(*[F.lit(r) for r in P.RULES])).otherwise(none),
        "num_joins": F.size(p["joins"]),
        "nesting_depth": F.lit(0),
        "corruption_recipe_id": F.when(operator.isNotNull(), P.recipe_id(operator)),
        "target_ast_hash": F.when(is_("corrupt"), own).when(is_("normalize"), P.program_hash(canonical)),
        "ambiguity_flag": F.lit(False),
        "render_variant_id": F.when(is_("clean"), "canonical").when(is_("corrupt"), operator).otherwise("normalized"),
        "extra": F.when(is_("corrupt"), F.create_map(F.lit("intended_failure_stage"), _chosen(operator, {o: F.lit(v[1]) for o, v in P.CORRUPTIONS.items()}))).otherwise(F.create_map().cast("map<string,string>")),
    }
    return decided.select(F.col("attempt").alias("pos"), *[values[f].alias(f) for f in FIELDS])


def build(spark: SparkSession, config: dict, families: list[schemas.Schema] | None = None) -> tuple[DataFrame, dict]:
    """(records with `position`, stats) of a corpus config."""
    families = families or schemas.load_schemas(config["schemas"])
    g, s = config["generation"], config["splits"]
    target, operators = int(g["target_total_rows"]), g["corruption_operators"]
    candidates = target * max(int(g.get("oversample_factor", 4)), 1)
    made = program.attempts(spark, families, g["complexities"], g["templates"], int(g.get("seed_start", 0)), int(g.get("max_attempts", target * 20))).persist()
    p, family = F.col("program"), F.col("schema_family")
    # Checks don't look at the template, and few programs differ otherwise: each shape is checked once.
    shape = p.withField("template_id", F.lit("")).withField("metadata", p["metadata"].withField("program_hash", F.lit("")))
    shaped = made.select("attempt", "schema_family", shape.alias("program"), F.sha2(F.to_json(F.struct("schema_family", shape.alias("p"))), 256).alias("shape"))
    shapes = shaped.groupBy("shape").agg(F.any_value("schema_family").alias("schema_family"), F.any_value("program").alias("program"))
    valid = (F.size(P.resolve_errors(p, families)) == 0) & (F.size(P.logic_errors(p, families)) == 0)
    # The clean text (operator null) and each corrupted one; whether it is as it should be if it parses, and if it doesn't.
    texts = [F.struct(F.lit(None).cast("string").alias("operator"), P.render(p).alias("text"), valid.alias("parsed"), F.lit(False).alias("unparsed"))]
    for o in operators:
        fits, stage = F.coalesce(P.applies(p, o), F.lit(False)), P.CORRUPTIONS[o][1]
        parsed = F.lit(False) if stage == "parse" else fits & (P.failure_stage(F.lit(True), P.corrupted(p, o, family), families) == stage)
        texts.append(F.struct(F.lit(o).alias("operator"), P.corrupted_sql(p, o, family).alias("text"), parsed.alias("parsed"), (fits if stage == "parse" else F.lit(False)).alias("unparsed")))
    tried = validate.with_parse_errors(shapes.select("shape", F.inline(F.array(*texts))).where("operator IS NULL OR parsed OR unparsed").persist(), "text", by_shape=True)
    good = F.when(F.size("parse_errors") == 0, F.col("parsed")).otherwise(F.col("unparsed"))
    judged = tried.groupBy("shape").agg(F.bool_or(F.col("operator").isNull() & good).alias("valid"), F.collect_list(F.when(good, F.col("operator"))).alias("eligible"))
    # At most max_attempts small tuples, a setting of the config: scheduling is a fold over them and needs no more.
    found = shaped.select("attempt", "shape").join(judged, "shape").select("attempt", "valid", "eligible").orderBy("attempt").collect()
    plan = schedule([tuple(r) for r in found], operators, g["task_targets"], candidates)
    decided = made.join(spark.createDataFrame(plan, "attempt long, task_kind string, number int, operator string"), "attempt")
    records = rows(decided, families).persist()
    kept = dedup.keep_first(records, keys.exact_row_key(), "pos").persist()
    capped = dedup.cap_variants(kept, F.col("semantic_hash"), F.col("render_variant_id"), keys.exact_row_key(), "pos", int(g.get("max_render_variants_per_semantic_group", 2))).persist()
    n, n_kept, n_capped = records.count(), kept.count(), capped.count()
    if n_capped < target:
        raise ValueError(f"Generated only {n_capped} unique rows after deduplication, need {target}.")
    order = F.struct("group_first", "pos")
    final = dedup.truncate(capped, target, "group_first", "pos").withColumn("rank", order).persist()
    validation = [r["family"] for r in splits.holdouts(final, int(s.get("validation_template_families", 1)), "rank").collect()]
    in_domain = [r["family"] for r in splits.holdouts(final, int(s.get("in_domain_template_families", 1)), "rank", validation).collect()]
    done = splits.build_splits(
        final, "rank", validation=validation, in_domain=in_domain, ood_schema_families=s.get("ood_schema_families", []), ood_template_ids=s.get("ood_template_ids", []),
        hard_complexity_to_ood=bool(s.get("hard_complexity_to_ood", False)), in_domain_eval_ratio=float(s.get("in_domain_eval_ratio", 0.2)),
    ).withColumn("position", F.struct("family_first", "rank")).persist()
    pairs = lambda df: {r[0]: r[1] for r in df.collect()}
    shared, split_counts = pairs(splits.leakage_counts(done)), pairs(splits.split_counts(done))
    stats = {
        "requested_rows": target, "generated_candidates": n, "candidate_target": candidates,
        "dedup": {"input_rows": n, "removed_exact_duplicates": n - n_kept, "output_rows": n_kept},
        "render_variants": {"removed_render_variants": n_kept - n_capped, "output_rows": n_capped},
        "final_rows": done.count(), "split_counts": split_counts,
        "split_summary": {"split_counts": split_counts, "schema_family": pairs(splits.split_summary(done, "schema_family")), "complexity": pairs(splits.split_summary(done, "complexity"))},
        "leakage_report": {"has_leakage": any(shared.values()), "overlap_counts": shared}, "task_counts": pairs(splits.task_counts(done)),
    }
    for df in (made, records, kept, capped, final):  # what follows reads `done`
        df.unpersist()
    return done.select("position", *FIELDS), stats


def build_release(spark: SparkSession, config: dict, output: str | Path, families: list[schemas.Schema] | None = None) -> dict:
    records, stats = build(spark, config, families)
    return export.release(records, output, dataset_name=config["dataset"]["name"], order="position", stats=stats)


#: The release configuration.
RELEASE = {
    "dataset": {"name": "corpus", "version": "v1"},
    "generation": {
        "target_total_rows": 2500,
        "task_targets": {"clean": 500, "corrupt": 1200, "normalize": 800},
        "complexities": ["easy", "medium", "hard"],
        "templates": {
            "easy": ["baseline_summary", "entity_listing", "dimension_slice", "recent_activity"],
            "medium": ["category_rollup", "carrier_rollup", "department_summary", "segment_aggregation"],
            "hard": ["cross_table_audit", "operations_breakdown", "finance_review", "entity_health_check"],
        },
        "corruption_operators": ["missing_comma", "unknown_column", "invalid_join_condition", "missing_group_by"],
        "max_render_variants_per_semantic_group": 3,
        "oversample_factor": 4,
        "seed_start": 11,
        "max_attempts": 40000,
    },
    "splits": {
        "validation_template_families": 3, "in_domain_template_families": 2, "in_domain_eval_ratio": 0.2, "ood_schema_families": ["hr_payroll"],
        "ood_template_ids": ["finance_review", "entity_health_check"], "hard_complexity_to_ood": False,
    },
}
