"""Column functions over the program struct: render, classify, corrupt, canonicalize, resolve and check."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from loomsql.functions.keys import ascii_json
from loomsql.sources.schemas import Schema

#: Corruption operators with family, stage at which they must fail, and error tag.
CORRUPTIONS = {
    "missing_comma": ("parser-breaking", "parse", "missing_comma"),
    "unknown_column": ("schema-breaking", "resolve", "unknown_column"),
    "invalid_join_condition": ("logic-breaking", "logic", "invalid_join_condition"),
    "missing_group_by": ("logic-breaking", "logic", "group_by_missing"),
}
#: Rules of canonicalization, in the order in which they are reported, with their families.
RULES = {"deterministic_aliases": "structural", "keyword_casing": "surface", "deterministic_spacing": "surface", "explicit_order_direction": "surface"}
#: Keywords that the non-canonical rendering writes in lower case, in this order.
LOWERED = ["SELECT", "FROM", "INNER JOIN", "WHERE", "GROUP BY", "HAVING", "ORDER BY", "LIMIT", " AS ", " ASC"]


def _item(i: Column) -> Column:
    return F.when(F.coalesce(i["alias"], F.lit("")) == "", i["expression"]).otherwise(F.concat(i["expression"], F.lit(" AS "), i["alias"]))


def _clause(word: str, items: Column, by: str, text=lambda x: x["expression"]) -> Column:
    return F.when(F.size(items) > 0, F.concat(F.lit(word), F.array_join(F.transform(items, text), by)))


def _once(p: Column, f) -> Column:
    """f(p), with p in it once and made once a row."""
    return F.get(F.transform(F.array(p), f), 0)


def render(p: Column) -> Column:
    """The text. What _once() gave is made once here too; of other expressions only the fields that the text needs are."""
    return _once(p, _render) if str(p).startswith("Column<'get(transform(array(") else _render(p)


def _render(p: Column) -> Column:
    table = lambda t: F.concat(t["name"], F.lit(" AS "), t["alias"])
    joins = F.transform(p["joins"], lambda j: F.concat(j["join_type"], F.lit(" "), table(j["right_table"]), F.lit(" ON "), j["on_expression"]))
    return F.concat_ws(
        "\n",
        F.concat(F.lit("SELECT "), F.array_join(F.transform(p["select_items"], _item), ", ")),
        F.concat(F.lit("FROM "), table(p["base_table"])),
        joins,
        _clause("WHERE ", p["where_predicates"], " AND "),
        _clause("GROUP BY ", p["group_by"], ", ", lambda x: x),
        _clause("HAVING ", p["having"], " AND "),
        _clause("ORDER BY ", p["order_by"], ", ", lambda o: F.concat(o["expression"], F.lit(" "), o["direction"])),
        F.concat(F.lit("LIMIT "), p["limit"].cast("string")),
    )


def complexity(p: Column) -> Column:
    return (
        F.when((F.size(p["joins"]) >= 2) | (F.size(p["having"]) > 0), "hard")
        .when((F.size(p["joins"]) > 0) | (F.size(p["group_by"]) > 0) | F.exists(p["select_items"], lambda i: i["is_aggregate"]), "medium")
        .otherwise("easy")
    )


def program_hash(p: Column) -> Column:
    return F.sha2(ascii_json(p), 256)


def unknown_column(p: Column) -> Column:
    first = lambda i: F.struct(i["alias"].alias("alias"), F.concat(F.substring_index(i["expression"], ".", 1), F.lit(".unknown_column")).alias("expression"), F.lit(False).alias("is_aggregate"))
    return p.withField("select_items", F.transform(p["select_items"], lambda i, k: F.when(k == 0, first(i)).otherwise(i)))


def invalid_join_condition(p: Column, family: Column) -> Column:
    base = p["base_table"]["alias"]
    wrong = F.when(family == "logistics", "shipment_status").otherwise(F.concat(base, F.lit("_invalid")))
    on = lambda j: j.withField("on_expression", F.concat(base, F.lit(".warehouse_id = "), j["right_table"]["alias"], F.lit("."), wrong))
    return p.withField("joins", F.transform(p["joins"], lambda j, k: F.when(k == 0, on(j)).otherwise(j)))


def missing_group_by(p: Column) -> Column:
    return p.withField("group_by", F.array().cast("array<string>"))


def corrupted(p: Column, operator: str, family: Column) -> Column:
    """The program after a corruption; missing_comma leaves it and breaks the text."""
    return {"missing_comma": lambda: p, "unknown_column": lambda: unknown_column(p), "invalid_join_condition": lambda: invalid_join_condition(p, family), "missing_group_by": lambda: missing_group_by(p)}[operator]()


def recipe_id(*operators: Column) -> Column:
    """Of operators that are applied one after the other."""
    return F.concat_ws("+", *operators)


def metric_parts(expression: Column) -> Column:
    """The function and the argument of an aggregate's text; null for another expression."""
    parts = F.struct(F.substring_index(expression, "(", 1).alias("function"), F.regexp_extract(expression, r"(?s)^[^(]*\((.*)\)$", 1).alias("argument"))
    return F.when(expression.rlike(r"(?s)^[^(]*\(.*\)$"), parts)


def applies(p: Column, operator: str) -> Column:
    return {"missing_comma": F.size(p["select_items"]) >= 2, "unknown_column": F.lit(True), "invalid_join_condition": F.size(p["joins"]) > 0, "missing_group_by": F.size(p["group_by"]) > 0}[operator]


def corrupted_sql(p: Column, operator: str, family: Column) -> Column:
    if operator != "missing_comma":
        return render(corrupted(p, operator, family))
    items = F.transform(p["select_items"], _item)
    head = F.concat(F.lit("SELECT "), F.get(items, 0), F.lit(" "), F.array_join(F.slice(items, 2, F.size(items)), ", "))
    rest = render(p)
    return F.concat(head, F.substr(rest, F.char_length(head) + 2))


def _pairs(p: Column) -> Column:
    """(old alias, new alias) in FROM order."""
    refs = F.concat(F.array(p["base_table"]), F.transform(p["joins"], lambda j: j["right_table"]))
    return F.transform(refs, lambda t, k: F.struct(t["alias"].alias("old"), F.concat(F.lit("s"), (k + 1).cast("string")).alias("new")))


def _renamed(text: Column, pairs: Column) -> Column:
    return F.aggregate(pairs, text, lambda acc, m: F.replace(acc, F.concat(m["old"], F.lit(".")), F.concat(m["new"], F.lit("."))))


def canonical(p: Column) -> Column:
    """Aliases s1, s2, ... in FROM order, upper-case join types and directions, and the hash of the result (made while the
    old one still stands in it). An ON expression knows the aliases up to its own join.

    Of a named column only the fields that are asked for are made. A longer expression stands in the result once: its copies
    would make the plan of a program that is canonicalized twice too large for the driver."""
    if re.fullmatch(r"Column<'[\w.]+'>", str(p)):
        return _canonical(p)
    return _once(p, _canonical)


def _canonical(p: Column) -> Column:
    pairs = _pairs(p)
    named = lambda t, k: t.withField("alias", F.get(pairs, k)["new"])
    swap = lambda items: F.transform(items, lambda x: x.withField("expression", _renamed(x["expression"], pairs)))
    joins = F.transform(
        p["joins"],
        lambda j, k: F.struct(
            F.upper(j["join_type"]).alias("join_type"),
            _renamed(j["on_expression"], F.slice(pairs, F.lit(1), k + 2)).alias("on_expression"),
            named(j["right_table"], k + 1).alias("right_table"),
        ),
    )
    order = F.transform(p["order_by"], lambda o: F.struct(F.upper(o["direction"]).alias("direction"), _renamed(o["expression"], pairs).alias("expression")))
    out = p.withField("base_table", named(p["base_table"], F.lit(0))).withField("joins", joins).withField("order_by", order)
    out = out.withField("group_by", F.transform(p["group_by"], lambda g: _renamed(g, pairs)))
    for name in ("select_items", "where_predicates", "having"):
        out = out.withField(name, swap(p[name]))
    return out.withField("metadata", p["metadata"].withField("program_hash", program_hash(out)))


def noncanonical(p: Column) -> Column:
    text = reduce(lambda t, w: F.replace(t, F.lit(w), F.lit(w.lower())), LOWERED, render(p))
    return F.replace(text, F.lit("\n"), F.lit("  \n"))


def column_refs(expression: Column) -> Column:
    """alias.column tokens of an expression; both parts in upper case are no reference."""
    upper = lambda c: c.rlike("[A-Z]") & ~c.rlike("[a-z]")
    split = lambda t: F.struct(F.substring_index(t, ".", 1).alias("alias"), F.substring_index(t, ".", -1).alias("name"))
    tokens = F.filter(F.regexp_extract_all(expression, F.lit(r"[0-9A-Za-z_.]+"), 0), lambda t: t.rlike(r"^[^.]+\.[^.]+$"))
    return F.filter(F.transform(tokens, split), lambda r: ~(upper(r["alias"]) & upper(r["name"])))


def expressions(p: Column) -> Column:
    of = lambda items, name="expression": F.transform(items, lambda x: x[name])
    return F.concat(of(p["select_items"]), of(p["where_predicates"]), of(p["joins"], "on_expression"), p["group_by"], of(p["having"]), of(p["order_by"]))


def table_columns(schemas: list[Schema]) -> Column:
    """schema_id.table to its columns: as many entries as the schema configs have tables."""
    return F.create_map(*[x for s in schemas for t in s.tables for x in (F.lit(f"{s.schema_id}.{t.name}"), F.array(*[F.lit(c.name) for c in t.columns]))])


def resolve_errors(p: Column, schemas: list[Schema]) -> Column:
    known, schema = table_columns(schemas), p["metadata"]["schema_id"]
    of = lambda name: F.element_at(known, F.concat(schema, F.lit("."), name))
    refs = F.concat(F.array(p["base_table"]), F.transform(p["joins"], lambda j: j["right_table"]))
    tables = F.transform(F.filter(refs, lambda t: of(t["name"]).isNull()), lambda t: F.concat(F.lit("Unknown table: "), t["name"]))
    aliases = F.transform(F.filter(refs, lambda t: F.coalesce(t["alias"], F.lit("")) == ""), lambda t: F.concat(F.lit("Missing alias of table: "), t["name"]))
    wrong = lambda t: F.transform(
        F.filter(F.flatten(F.transform(expressions(p), column_refs)), lambda r: (r["alias"] == t["alias"]) & of(t["name"]).isNotNull() & ~F.array_contains(of(t["name"]), r["name"])),
        lambda r: F.concat(F.lit("Unknown column: "), r["alias"], F.lit("."), r["name"]),
    )
    return F.concat(tables, aliases, F.flatten(F.transform(refs, wrong)))


def logic_errors(p: Column, schemas: list[Schema]) -> Column:
    aggregate = F.exists(p["select_items"], lambda i: i["is_aggregate"])
    end = lambda t, c: F.concat_ws(".", t, c)
    edges = F.create_map(*[x for s in schemas for x in (F.lit(s.schema_id), F.array(*[F.lit("=".join(sorted((f"{a}.{b}", f"{c}.{d}")))) for a, b, c, d in s.join_graph]))])
    refs = F.concat(F.array(p["base_table"]), F.transform(p["joins"], lambda j: j["right_table"]))

    def check(j: Column) -> Column:
        on = j["on_expression"]
        sides = F.transform(F.split(on, "=", 2), lambda s: F.trim(s))
        equal = F.forall(sides, lambda s: s.rlike(r"^[^.]+\.[^.]+$")) & (F.size(sides) == 2)
        named = F.transform(sides, lambda s: end(F.get(F.filter(refs, lambda t: t["alias"] == F.substring_index(s, ".", 1)), 0)["name"], F.substring_index(s, ".", -1)))
        unknown = ~F.forall(sides, lambda s: F.exists(refs, lambda t: t["alias"] == F.substring_index(s, ".", 1)))
        return (
            F.when(~equal, F.concat(F.lit("Not an equality of two columns: "), on))
            .when(unknown, F.concat(F.lit("Unknown alias in join: "), on))
            .when(~F.array_contains(F.element_at(edges, p["metadata"]["schema_id"]), F.array_join(F.array_sort(named), "=")), F.concat(F.lit("Not in the join graph: "), on))
        )

    grouped = F.when(aggregate & (F.size(p["group_by"]) == 0), "Aggregate without GROUP BY")
    having = F.when((F.size(p["having"]) > 0) & ~aggregate, "HAVING without aggregate")
    return F.filter(F.concat(F.array(grouped, having), F.transform(p["joins"], check)), lambda e: e.isNotNull())


def failure_stage(parses: Column, p: Column, schemas: list[Schema]) -> Column:
    return F.when(~parses, "parse").when(F.size(resolve_errors(p, schemas)) > 0, "resolve").when(F.size(logic_errors(p, schemas)) > 0, "logic").otherwise("valid")


def validation_report(p: Column, parse_errors: Column, schemas: list[Schema]) -> Column:
    """is_valid, the outcome of each stage, and the errors of those that failed. All stages run, whatever an earlier one
    found. `parse_errors` come from Spark's parser (operators/validate.py) and are empty for a text that parses."""
    errors = {"parse": parse_errors, "resolve": resolve_errors(p, schemas), "logic": logic_errors(p, schemas)}
    passed = {stage: F.size(found) == 0 for stage, found in errors.items()}
    return F.struct(
        reduce(lambda a, b: a & b, passed.values()).alias("is_valid"),
        F.struct(*[ok.alias(stage) for stage, ok in passed.items()]).alias("stage_results"),
        F.map_filter(F.create_map(*[x for stage, found in errors.items() for x in (F.lit(stage), found)]), lambda _, found: F.size(found) > 0).alias("errors"),
    )


def from_tables(p: Column) -> Column:
    """Names of the base table and of the joined ones, in FROM order."""
    return F.concat(F.array(p["base_table"]["name"]), F.transform(p["joins"], lambda j: j["right_table"]["name"]))
