"""Registered queries of the engine's own operators, each with DuckDB SQL that gives the same rows."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomsql.functions import keys
from loomsql.functions import programs as P
from loomsql.operators import dedup, splits, validate
from loomsql.plans import corpus, program
from loomsql.sources import export
from loomsql.sources.schemas import FAMILIES, columns_frame, edges_frame

_queries: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_oracles: dict[str, str] = {}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def query(oracle: str | None = None):
    def add(f):
        _queries[f.__name__] = f
        if oracle:
            _oracles[f.__name__] = oracle
        return f

    return add


def queries() -> dict:
    return dict(_queries)


def oracle_sql() -> dict[str, str]:
    return dict(_oracles)


def _docs(spark, sf_dir) -> DataFrame:
    """Documents as benchmark rows: family = (lang, source), exact key = text, split by row so that keys leak."""
    d = _table(spark, sf_dir, "documents")
    return d.select("doc_id", F.col("lang").alias("schema_family"), F.col("source").alias("template_id"), "text", F.when(F.col("n_chars") > 2000, "hard").otherwise("easy").alias("complexity"))


_FAMILY = "sha256('{\"schema_family\":\"' || lang || '\",\"template_id\":\"' || source || '\"}')"
_BUCKET = "(('0x' || substr(sha256('{\"group_key\":\"' || %s || '\"}'), 1, 8))::BIGINT %% 100)"


@query("SELECT doc_id, lang, source, sha256(text) AS text_key FROM (SELECT *, row_number() OVER (PARTITION BY sha256(text) ORDER BY doc_id) AS n FROM documents) WHERE n = 1")
def exact_dedup_keep_first(spark, sf_dir):
    d = _table(spark, sf_dir, "documents").select("doc_id", "lang", "source", F.sha2("text", 256).alias("text_key"))
    return dedup.keep_first(d, F.col("text_key"), "doc_id")


@query("SELECT count(*) AS input_rows, count(*) - count(DISTINCT text) AS removed_exact_duplicates, count(DISTINCT text) AS output_rows FROM documents")
def exact_dedup_stats(spark, sf_dir):
    return dedup.keep_first_stats(_table(spark, sf_dir, "documents"), F.sha2("text", 256))


@query("SELECT doc_id, sha256('{\"lang\":\"' || lang || '\",\"n\":' || n_chars || ',\"source\":\"' || source || '\"}') AS k FROM documents")
def stable_key(spark, sf_dir):
    return _table(spark, sf_dir, "documents").select("doc_id", keys.stable_hash(lang=F.col("lang"), source=F.col("source"), n=F.col("n_chars")).alias("k"))


@query("SELECT doc_id, printf('%s_%s_%06d', 'sqlclean', lang, doc_id) AS row_id FROM documents")
def row_ids(spark, sf_dir):
    return _table(spark, sf_dir, "documents").select("doc_id", keys.row_id(F.lit("sqlclean"), F.col("lang"), F.col("doc_id")).alias("row_id"))


@query(f"SELECT doc_id, {_BUCKET % 'source'} AS bucket FROM documents")
def split_bucket(spark, sf_dir):
    return _table(spark, sf_dir, "documents").select("doc_id", keys.split_bucket(F.col("source")).alias("bucket"))


@query("SELECT source, count(*) AS group_rows FROM documents GROUP BY source")
def semantic_group_counts(spark, sf_dir):
    return dedup.group_counts(_table(spark, sf_dir, "documents"), "source")


_CAP = """WITH v AS (SELECT *, row_number() OVER (PARTITION BY source, lang ORDER BY doc_id) AS a FROM documents),
c AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS b, min(doc_id) OVER (PARTITION BY source) AS group_first FROM v WHERE a = 1)
"""


def _capped(spark, sf_dir):
    d = _table(spark, sf_dir, "documents").select("doc_id", "source", "lang")
    return dedup.cap_variants(d, F.col("source"), F.col("lang"), F.col("doc_id").cast("string"), "doc_id", 2)


@query(_CAP + "SELECT doc_id, source, lang, group_first FROM c WHERE b <= 2")
def cap_variants_k2(spark, sf_dir):
    return _capped(spark, sf_dir)


@query(_CAP + "SELECT (SELECT count(*) FROM documents) - count(*) AS removed_render_variants, count(*) AS output_rows FROM c WHERE b <= 2")
def cap_variants_stats(spark, sf_dir):
    out = _capped(spark, sf_dir).agg(F.count("*").alias("output_rows"))
    return _table(spark, sf_dir, "documents").agg(F.count("*").alias("n")).join(out).select((F.col("n") - F.col("output_rows")).alias("removed_render_variants"), "output_rows")


@query(_CAP + "SELECT doc_id, source FROM c WHERE b <= 2 ORDER BY group_first, doc_id LIMIT 25")
def truncate_first_n(spark, sf_dir):
    return dedup.truncate(_capped(spark, sf_dir), 25, "group_first", "doc_id").select("doc_id", "source")


@query(f"SELECT DISTINCT {_FAMILY} AS family FROM documents")
def template_family_keys(spark, sf_dir):
    return splits.template_family_ids(_docs(spark, sf_dir))


_FAMS = f"f AS (SELECT {_FAMILY} AS family, lang, source, min(doc_id) AS first_row, arg_min(CASE WHEN n_chars > 2000 THEN 'hard' ELSE 'easy' END, doc_id) AS complexity FROM documents GROUP BY lang, source), r AS (SELECT *, row_number() OVER (ORDER BY first_row) AS n FROM f)"


@query(f"WITH {_FAMS} SELECT family, first_row FROM r WHERE n BETWEEN 4 AND 6")
def family_holdouts(spark, sf_dir):
    d = _docs(spark, sf_dir)
    skip = [r["family"] for r in splits.holdouts(d, 3, "doc_id").collect()]
    return splits.holdouts(d, 3, "doc_id", skip)


_SPLIT = f"""WITH {_FAMS}, s AS (SELECT lang, source, first_row, CASE WHEN lang IN ('de') OR source IN ('src3') THEN 'test_ood' WHEN complexity = 'hard' AND lang = 'zz' THEN 'test_ood'
 WHEN n <= 3 THEN 'validation' WHEN n <= 5 THEN 'test_in_domain' WHEN {_BUCKET % 'family'} < 20 THEN 'test_in_domain' ELSE 'train' END AS split FROM r),
a AS (SELECT d.*, s.split, s.first_row FROM documents d JOIN s USING (lang, source))
"""


def _split(spark, sf_dir):
    d = _docs(spark, sf_dir)
    first = [r["family"] for r in splits.holdouts(d, 3, "doc_id").collect()]
    then = [r["family"] for r in splits.holdouts(d, 2, "doc_id", first).collect()]
    return splits.build_splits(d, "doc_id", validation=first, in_domain=then, ood_schema_families=["de"], ood_template_ids=["src3"])


@query(_SPLIT + "SELECT doc_id, split, first_row AS family_first FROM a")
def assign_splits(spark, sf_dir):
    return _split(spark, sf_dir).select("doc_id", "split", "family_first")


@query(_SPLIT + "SELECT v.split, count(a.split) AS n_rows FROM (VALUES ('train'), ('validation'), ('test_in_domain'), ('test_ood')) v(split) LEFT JOIN a USING (split) GROUP BY v.split")
def split_counts_zero_filled(spark, sf_dir):
    return splits.split_counts(_split(spark, sf_dir))


@query(_SPLIT + "SELECT split || ':' || lang AS name, count(*) AS n_rows FROM a GROUP BY 1")
def split_summary_by_family(spark, sf_dir):
    return splits.split_summary(_split(spark, sf_dir), "schema_family")


@query(_SPLIT + "SELECT split || ':' || CASE WHEN n_chars > 2000 THEN 'hard' ELSE 'easy' END AS name, count(*) AS n_rows FROM a GROUP BY 1")
def split_summary_by_complexity(spark, sf_dir):
    return splits.split_summary(_split(spark, sf_dir), "complexity")


def _leaky(spark, sf_dir):
    d = _docs(spark, sf_dir)
    return d.select(
        F.when(F.col("doc_id") % 2 == 0, "train").otherwise("validation").alias("split"), "schema_family", "template_id", F.lit("t").alias("task"), F.lit("s").alias("db_schema_id"),
        F.md5("text").alias("source_sql"), F.lit(None).cast("string").alias("target_sql"), F.lit("a").alias("dialect"),
        F.md5("text").alias("source_ast_hash"), F.when(F.col("template_id") != "src0", F.md5("text")).alias("semantic_hash"),
    )


_LEAK = f"""WITH k AS (SELECT doc_id % 2 AS split, unnest([{{'kind': 'exact', 'value': 't|s|' || md5(text) || '||a'}}, {{'kind': 'ast', 'value': md5(text)}},
 {{'kind': 'semantic', 'value': CASE WHEN source <> 'src0' THEN md5(text) END}}, {{'kind': 'template_family', 'value': {_FAMILY}}}]) AS p FROM documents),
l AS (SELECT p.kind AS kind, p.value AS value, count(DISTINCT split) AS n_splits FROM k WHERE p.value IS NOT NULL GROUP BY 1, 2 HAVING count(DISTINCT split) > 1)
"""


@query(_LEAK + "SELECT kind, value, n_splits FROM l")
def leakage_details(spark, sf_dir):
    return splits.leakage_details(_leaky(spark, sf_dir))


@query(_LEAK + "SELECT v.kind, count(l.kind) AS n_shared FROM (VALUES ('exact'), ('ast'), ('semantic'), ('template_family')) v(kind) LEFT JOIN l USING (kind) GROUP BY v.kind")
def leakage_counts(spark, sf_dir):
    return splits.leakage_counts(_leaky(spark, sf_dir))


@query("SELECT lang AS task, count(*) AS n_rows FROM documents GROUP BY 1")
def task_counts(spark, sf_dir):
    return splits.task_counts(_table(spark, sf_dir, "documents").select(F.col("lang").alias("task")))


# The generated SQL subset, run on the star schema.


@query("SELECT o_orderstatus, o_totalprice, o_orderkey FROM orders AS t1 WHERE o_orderstatus <> '' AND o_orderpriority IS NOT NULL ORDER BY o_totalprice DESC, o_orderkey LIMIT 25")
def easy_select_filter_sort_limit(spark, sf_dir):
    t1 = _table(spark, sf_dir, "orders").alias("t1")
    return t1.where("t1.o_orderstatus <> '' AND t1.o_orderpriority IS NOT NULL").select("o_orderstatus", "o_totalprice", "o_orderkey").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(25)


def _medium(function: str):
    spark_f, money = {"sum": F.sum, "avg": F.avg, "min": F.min, "max": F.max, "count": F.count}[function], "decimal(18,2)"
    cast = {"sum": "decimal(28,2)", "avg": "double", "min": money, "max": money, "count": "bigint"}[function]

    def run(spark, sf_dir):
        n, c = _table(spark, sf_dir, "nation").alias("t1"), _table(spark, sf_dir, "customer").alias("t2")
        value = spark_f(F.col("t2.c_acctbal").cast(money)).cast(cast)
        value = F.round(value, 4) if function == "avg" else value
        return n.join(c, F.col("t2.c_nationkey") == F.col("t1.n_nationkey")).where("t2.c_acctbal IS NOT NULL").groupBy("n_name").agg(value.alias("value")).orderBy(F.desc("value"), "n_name").limit(10)

    run.__name__ = f"medium_{function}"
    value = f"{function}(t2.c_acctbal::DECIMAL(18,2))::{cast}"
    value = f"round({value}, 4)" if function == "avg" else value
    query(f"SELECT n_name, {value} AS value FROM nation t1 INNER JOIN customer t2 ON t2.c_nationkey = t1.n_nationkey WHERE t2.c_acctbal IS NOT NULL GROUP BY n_name ORDER BY value DESC, n_name LIMIT 10")(run)


for _f in ("sum", "avg", "min", "max", "count"):
    _medium(_f)


@query("SELECT n_name, sum(t3.o_totalprice::DECIMAL(18,2))::DECIMAL(28,2) AS sum_price FROM nation t1 INNER JOIN customer t2 ON t2.c_nationkey = t1.n_nationkey INNER JOIN orders t3 ON t3.o_custkey = t2.c_custkey WHERE t3.o_totalprice IS NOT NULL AND t1.n_name <> '' GROUP BY n_name HAVING sum(t3.o_totalprice) > 10")
def hard_two_joins_having(spark, sf_dir):
    n, c, o = (_table(spark, sf_dir, t).alias(a) for t, a in (("nation", "t1"), ("customer", "t2"), ("orders", "t3")))
    joined = n.join(c, F.col("t2.c_nationkey") == F.col("t1.n_nationkey")).join(o, F.col("t3.o_custkey") == F.col("t2.c_custkey"))
    out = joined.where("t3.o_totalprice IS NOT NULL AND t1.n_name <> ''").groupBy("n_name").agg(F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("decimal(28,2)").alias("sum_price"))
    return out.where("sum_price > 10")


# Programs as columns: each nation takes the program of its key modulo their number, with its name and region in it. The
# oracles start from texts and findings that are written out by hand.


def _program(base, items, where, order, joins=(), group=(), having=(), schema="logistics_v1") -> dict:
    """items: expression AS alias; joins: table, alias, ON expression. What has a bracket is an aggregate."""
    ref = lambda t: dict(zip(("name", "alias"), t, strict=True))
    one = lambda x: [{"expression": e} for e in x]
    made = [{"expression": e, "alias": a, "is_aggregate": "(" in e} for e, a in (i.split(" AS ") for i in items)]
    return {
        "base_table": ref(base), "dialect": "ansi_like", "group_by": list(group), "having": one(having),
        "joins": [{"join_type": "INNER JOIN", "on_expression": on, "right_table": ref((t, a))} for t, a, on in joins], "limit": "{limit}",
        "metadata": {"complexity": "hard", "program_hash": "h", "schema_id": schema}, "order_by": [dict(zip(("expression", "direction"), order.split(), strict=True))],
        "select_items": made, "template_id": "template_{name}", "where_predicates": one(where),
    }


_W, _S = ("warehouses", "t1"), ("shipments", "t2")
_ON = "t2.warehouse_id = t1.warehouse_id"
_PLAIN, _SUM = ["t1.region AS region", "t1.warehouse_id AS warehouse_id"], ["t1.region AS region", "SUM(t2.shipping_cost) AS sum_shipping_cost"]
_NAMED = ["t1.region <> '{name}'"]


def _joined(on: str, table: str = "shipments") -> dict:
    return _program(_W, _SUM, _NAMED, "t1.region ASC", [(table, "t2", on)], ["t1.region"])


_FROM_W = "SELECT t1.region AS region, t1.warehouse_id AS warehouse_id\nFROM warehouses AS t1\nWHERE t1.region <> '{name}'\n"
_FROM_WS = "SELECT t1.region AS region, SUM(t2.shipping_cost) AS sum_shipping_cost\nFROM warehouses AS t1\nINNER JOIN shipments AS t2 ON t2.warehouse_id = t1.warehouse_id\nWHERE t1.region <> '{name}'\nGROUP BY t1.region\n"
#: Program, its text, errors of resolution and of logic, and the stage at which it fails without a GROUP BY, and with an
#: invalid join.
_CASES = [
    (_program(_W, _PLAIN, _NAMED, "t1.region DESC"), _FROM_W + "ORDER BY t1.region DESC\nLIMIT {limit}", [], [], "valid", "valid"),
    (
        _program(("shipments", "t1"), ["t1.ship_date AS ship_date", "SUM(t1.shipping_cost) AS sum_shipping_cost"], ["t1.shipping_cost IS NOT NULL", "t1.ship_date IS NOT NULL"], "SUM(t1.shipping_cost) DESC", group=["t1.ship_date"]),
        "SELECT t1.ship_date AS ship_date, SUM(t1.shipping_cost) AS sum_shipping_cost\nFROM shipments AS t1\nWHERE t1.shipping_cost IS NOT NULL AND t1.ship_date IS NOT NULL\nGROUP BY t1.ship_date\nORDER BY SUM(t1.shipping_cost) DESC\nLIMIT {limit}", [], [], "logic", "valid",
    ),
    (_joined(_ON), _FROM_WS + "ORDER BY t1.region ASC\nLIMIT {limit}", [], [], "logic", "logic"),
    (
        _program(_W, _SUM, _NAMED, "t1.region ASC", [(*_S, _ON)], ["t1.region"], ["SUM(t2.shipping_cost) > 10"]),
        _FROM_WS + "HAVING SUM(t2.shipping_cost) > 10\nORDER BY t1.region ASC\nLIMIT {limit}", [], [], "logic", "logic",
    ),
    (
        _program(_W, ["t1.region AS region", "COUNT(t3.event_id) AS count_event_id"], ["t3.event_id IS NOT NULL"], "t1.region ASC", [(*_S, _ON), ("delivery_events", "t3", "t3.shipment_id = t2.shipment_id")], ["t1.region"]),
        "SELECT t1.region AS region, COUNT(t3.event_id) AS count_event_id\nFROM warehouses AS t1\nINNER JOIN shipments AS t2 ON t2.warehouse_id = t1.warehouse_id\nINNER JOIN delivery_events AS t3 ON t3.shipment_id = t2.shipment_id\nWHERE t3.event_id IS NOT NULL\nGROUP BY t1.region\nORDER BY t1.region ASC\nLIMIT {limit}", [], [], "logic", "logic",
    ),
    (
        _program(_W, ["t1.region AS region", "MAX(t1.warehouse_id) AS max_warehouse_id"], _NAMED, "t1.region ASC"),
        "SELECT t1.region AS region, MAX(t1.warehouse_id) AS max_warehouse_id\nFROM warehouses AS t1\nWHERE t1.region <> '{name}'\nORDER BY t1.region ASC\nLIMIT {limit}", [], ["Aggregate without GROUP BY"], "logic", "logic",
    ),
    (_program(_W, _PLAIN, _NAMED, "t1.region DESC", having=["t1.warehouse_id > 5"]), _FROM_W + "HAVING t1.warehouse_id > 5\nORDER BY t1.region DESC\nLIMIT {limit}", [], ["HAVING without aggregate"], "logic", "logic"),
    (_program(("depots", "t1"), _PLAIN, _NAMED, "t1.region DESC"), _FROM_W.replace("warehouses", "depots") + "ORDER BY t1.region DESC\nLIMIT {limit}", ["Unknown table: depots"], [], "resolve", "resolve"),
    (_joined(_ON, "trucks"), _FROM_WS.replace("shipments", "trucks") + "ORDER BY t1.region ASC\nLIMIT {limit}", ["Unknown table: trucks"], [f"Not in the join graph: {_ON}"], "resolve", "resolve"),
    (_program(("warehouses", ""), _PLAIN, _NAMED, "t1.region DESC"), _FROM_W.replace("AS t1", "AS ") + "ORDER BY t1.region DESC\nLIMIT {limit}", ["Missing alias of table: warehouses"], [], "parse", "parse"),
    (
        _program(_W, ["t1.nothing AS region", "t1.warehouse_id AS warehouse_id"], ["t1.nothing IS NOT NULL"], "t1.region DESC"),
        "SELECT t1.nothing AS region, t1.warehouse_id AS warehouse_id\nFROM warehouses AS t1\nWHERE t1.nothing IS NOT NULL\nORDER BY t1.region DESC\nLIMIT {limit}", ["Unknown column: t1.nothing", "Unknown column: t1.nothing"], [], "resolve", "resolve",
    ),
    *[
        (_joined(on), _FROM_WS.replace(_ON, on) + "ORDER BY t1.region ASC\nLIMIT {limit}", [], [f"{what}: {on}"], stage, "logic" if stage == "logic" else stage)
        for on, what, stage in (
            ("t2.warehouse_id >= t1.warehouse_id", "Not in the join graph", "logic"), ("t2.warehouse_id <> t1.warehouse_id", "Not an equality of two columns", "logic"),
            ("t9.warehouse_id = t1.warehouse_id", "Unknown alias in join", "logic"), ("t2.carrier_id = t1.warehouse_id", "Not in the join graph", "logic"),
        )
    ],
    (
        _program(("departments", "t1"), ["t1.cost_center AS cost_center", "AVG(t2.department_id) AS avg_department_id"], ["t1.cost_center <> ''"], "t1.cost_center ASC", [("employees", "t2", "t2.department_id = t1.department_id")], ["t1.cost_center"], schema="hr_payroll_v1"),
        "SELECT t1.cost_center AS cost_center, AVG(t2.department_id) AS avg_department_id\nFROM departments AS t1\nINNER JOIN employees AS t2 ON t2.department_id = t1.department_id\nWHERE t1.cost_center <> ''\nGROUP BY t1.cost_center\nORDER BY t1.cost_center ASC\nLIMIT {limit}", [], [], "logic", "resolve",
    ),
]


def _programs(spark, sf_dir) -> DataFrame:
    cases = spark.createDataFrame([(i, json.dumps(c[0])) for i, c in enumerate(_CASES)], "v int, program string")
    n = _table(spark, sf_dir, "nation").withColumn("v", F.col("n_nationkey") % len(_CASES))
    filled = F.replace(F.replace(F.col("program"), F.lit('"{limit}"'), F.col("n_regionkey").cast("string")), F.lit("{name}"), F.col("n_name"))
    return n.join(F.broadcast(cases), "v").select(F.col("n_nationkey").alias("n"), F.from_json(filled, program.PROGRAM).alias("program"))


def _family(p):
    return F.regexp_replace(p["metadata"]["schema_id"], "_v1$", "")


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _listed(values: list[str]) -> str:
    return "[" + ", ".join(map(_quoted, values)) + "]::VARCHAR[]"


_P = "WITH c(v, t, resolve, logic, ungrouped, misjoined) AS (VALUES " + ", ".join(f"({i}, {_quoted(t)}, {_listed(r)}, {_listed(g)}, {_quoted(a)}, {_quoted(b)})" for i, (_, t, r, g, a, b) in enumerate(_CASES)) + f""")
, p AS (SELECT n_nationkey AS n, v, replace(replace(t, '{{name}}', n_name), '{{limit}}', n_regionkey::VARCHAR) AS sql, resolve, logic, ungrouped, misjoined FROM nation JOIN c ON n_nationkey % {len(_CASES)} = v)
"""
_COMMA, _COLUMN = r"regexp_replace(sql, '^(SELECT [^,\n]*), ', '\1 ')", r"regexp_replace(sql, '^SELECT (\w+)\.\w+', 'SELECT \1.unknown_column')"
_JOIN = r"regexp_replace(sql, ' ON [^\n]*', ' ON t1.warehouse_id = t2.' || CASE WHEN sql LIKE '%FROM departments%' THEN 't1_invalid' ELSE 'shipment_status' END)"
_GROUP = r"regexp_replace(sql, '\nGROUP BY [^\n]*', '')"
_CLAUSES = " || ' ' || ".join([*[rf"regexp_extract(sql, '(?:^|\n){w} ([^\n]*)', 1)" for w in ("SELECT", "WHERE")], r"array_to_string(regexp_extract_all(sql, ' ON ([^\n]*)', 1), ' ')", *[rf"regexp_extract(sql, '\n{w} ([^\n]*)', 1)" for w in ("GROUP BY", "HAVING", "ORDER BY")]])


def _lowered(text: str) -> str:
    for w in P.LOWERED:
        text = f"replace({text}, '{w}', '{w.lower()}')"
    return f"replace({text}, chr(10), '  ' || chr(10))"


def _program_query(name: str, column, oracle: str, text=None):
    """text: of the program, what the column's second argument has the parse errors of."""

    def run(spark, sf_dir):
        rows = _programs(spark, sf_dir)
        if text:
            rows = validate.with_parse_errors(rows.withColumn("text", text(F.col("program"))), "text")
        return rows.select("n", column(F.col("program"), *[F.col("parse_errors")] * bool(text)).alias("value"))

    run.__name__ = name
    query(f"{_P}SELECT n, {oracle} AS value FROM p")(run)


_program_query("render_sql_text", P.render, "sql")
_program_query("noncanonical_text", P.noncanonical, _lowered("sql"))
_program_query("canonical_alias_text", lambda p: P.render(P.canonical(p)), "CASE WHEN v = 9 THEN replace(replace(sql, '.', 's1.'), 'AS ' || chr(10), 'AS s1' || chr(10)) ELSE replace(replace(replace(replace(replace(replace(sql, 't1.', 's1.'), 't2.', 's2.'), 't3.', 's3.'), 'AS t1', 'AS s1'), 'AS t2', 'AS s2'), 'AS t3', 'AS s3') END")
_program_query("complexity_label", P.complexity, r"CASE WHEN sql LIKE '%HAVING%' OR len(regexp_extract_all(sql, 'INNER JOIN')) > 1 THEN 'hard' WHEN sql LIKE '%INNER JOIN%' OR sql LIKE '%GROUP BY%' OR regexp_matches(sql, '^SELECT[^\n]*\(') THEN 'medium' ELSE 'easy' END")
_program_query("metric_parts", lambda p: P.metric_parts(F.get(p["select_items"], 1)["expression"])["argument"], r"nullif(regexp_extract(sql, '^SELECT [^\n]*\(([^)]*)\)', 1), '')")
for _o, _text in (("missing_comma", _COMMA), ("unknown_column", _COLUMN), ("invalid_join_condition", _JOIN), ("missing_group_by", _GROUP)):
    _program_query(f"corrupt_{_o.removesuffix('_condition')}", lambda p, o=_o: P.corrupted_sql(p, o, _family(p)), _text)
_program_query("column_refs", lambda p: F.array_join(F.transform(F.flatten(F.transform(P.expressions(p), P.column_refs)), lambda r: F.concat_ws(".", r["alias"], r["name"])), ","), rf"array_to_string(list_filter(regexp_extract_all({_CLAUSES}, '[0-9A-Za-z_.]+'), lambda x: regexp_matches(x, '^[^.]+\.[^.]+$')), ',')")
_program_query("resolve_errors", lambda p: F.array_join(P.resolve_errors(p, FAMILIES), ";"), "array_to_string(resolve, ';')")
_program_query("logic_errors", lambda p: F.array_join(P.logic_errors(p, FAMILIES), ";"), "array_to_string(logic, ';')")
_program_query("from_tables", lambda p: F.array_join(P.from_tables(p), ","), r"array_to_string(regexp_extract_all(sql, '(?:FROM|JOIN) (\w+)', 1), ',')")
_program_query(
    "validation_report",
    lambda p, e: F.to_json(F.struct(*[(r := P.validation_report(p, e, FAMILIES))[f].alias(f) for f in ("is_valid", "stage_results")], *[F.array_join(r["errors"][s], ";").alias(s) for s in ("resolve", "logic")])),
    """'{"is_valid":' || (v <> 9 AND len(resolve || logic) = 0) || ',"stage_results":{"parse":' || (v <> 9) || ',"resolve":' || (len(resolve) = 0) || ',"logic":' || (len(logic) = 0) || '}' || CASE WHEN len(resolve) > 0 THEN ',"resolve":"' || array_to_string(resolve, ';') || '"' ELSE '' END || CASE WHEN len(logic) > 0 THEN ',"logic":"' || array_to_string(logic, ';') || '"' ELSE '' END || '}'""",
    P.render,
)
for _o, _stage in (("missing_comma", "'parse'"), ("unknown_column", "CASE WHEN v = 9 THEN 'parse' ELSE 'resolve' END"), ("invalid_join_condition", "misjoined"), ("missing_group_by", "ungrouped")):
    _program_query(f"failure_stage_{_o}", lambda p, e, o=_o: P.failure_stage(F.size(e) == 0, P.corrupted(p, o, _family(p)), FAMILIES), _stage, lambda p, o=_o: P.corrupted_sql(p, o, _family(p)))


@query(f"{_P}SELECT n, kind, json_serialize_sql(text)->>'error' = 'false' AS parses FROM (SELECT n, unnest(['clean', 'missing_comma', 'lower case', 'no columns', 'blank']) AS kind, unnest([sql, {_COMMA}, {_lowered('sql')}, 'SELECT FROM', ' ']) AS text FROM p WHERE v <> 9) WHERE text <> ' ' UNION ALL SELECT n, 'blank', false FROM p WHERE v <> 9")
def parse_validity(spark, sf_dir):
    p = F.col("program")
    kinds = {"clean": P.render(p), "missing_comma": P.corrupted_sql(p, "missing_comma", F.lit("logistics")), "lower case": P.noncanonical(p), "no columns": F.lit("SELECT FROM"), "blank": F.lit(" ")}
    texts = _programs(spark, sf_dir).where(F.col("program.base_table.alias") != "").select("n", F.inline(F.array(*[F.struct(F.lit(k).alias("kind"), t.alias("text")) for k, t in kinds.items()])))
    return validate.with_parse_errors(texts, "text").select("n", "kind", (F.size("parse_errors") == 0).alias("parses"))


@query("SELECT * FROM (VALUES " + ", ".join(f"('{s.schema_id}', {i}::BIGINT, '{e[0]}', '{e[1]}', '{e[2]}', '{e[3]}')" for s in FAMILIES for i, e in enumerate(s.join_graph)) + ") v(schema_id, position, left_table, left_column, right_table, right_column)")
def join_edges(spark, sf_dir):
    return edges_frame(spark, FAMILIES)


@query("SELECT * FROM (VALUES " + ", ".join(f"('{s.schema_id}', '{t.name}', {i}::BIGINT, '{c.name}', '{c.data_type}', {str(c.name == t.primary_key).lower()})" for s in FAMILIES for t in s.tables for i, c in enumerate(t.columns)) + ") v(schema_id, table_name, position, column_name, data_type, is_key)")
def schema_columns(spark, sf_dir):
    return columns_frame(spark, FAMILIES)


@query()
def corpus_rows(spark, sf_dir):
    return corpus.build(spark, corpus.RELEASE, FAMILIES)[0].select(*corpus.FIELDS)


#: Of the release's rows by task and schema family their number, and the SHA-256 of their ids, splits, texts and
#: hashes; computed by plain Python over lists (tests/plain_corpus.py). The numbers by task are the published ones.
DIGESTS = [
    ("canonicalization", "hr_payroll", 220, "ec662ad2869f6bb3a51e81e3d7f734d3d95474f14f7da58c451cfa6497f0c319"),
    ("canonicalization", "logistics", 136, "f5ac8489cea1d92f38210c1d21e96b1b9f2bf1f88951eb2d4f57f1e6015b9a9a"),
    ("canonicalization", "retail_sales", 209, "39e4c9c4cb892b8299c3d373de016fd85e97c27f7f3cea141392d2843dbedb76"),
    ("generate_clean_query", "hr_payroll", 121, "33dca92d181c83056eb8403425b412d1c69d20840161f4990fc6dea204f82f61"),
    ("generate_clean_query", "logistics", 395, "8fec73ae95c724be0ad7a94a964dcaa99f9befb920c093a59e2fe2fb4246c253"),
    ("generate_clean_query", "retail_sales", 107, "c505bce275909beff0b7b5485cd86f842b499191701365b9919eb3976c6b4fe9"),
    ("repair", "hr_payroll", 432, "49a3a48ccffdd9b41d8aa0d99ea7c1d9dd1b11f34bd1e3e8ec7500382dd6dbd4"),
    ("repair", "logistics", 601, "93ce944865f1aff94671d27bd6d6725f604ea99fef189dc5285fae1f1ee26735"),
    ("repair", "retail_sales", 279, "dd0faa56b04ae1b7c4b7b3fd1e98c822b76c2f4fb58d774b715d27066f0f6d08"),
]


@query("SELECT * FROM (VALUES " + ", ".join(f"('{t}', '{f}', {n}::BIGINT, '{d}')" for t, f, n, d in DIGESTS) + ") v(task, schema_family, n_rows, rows_sha256)")
def corpus_digest(spark, sf_dir):
    """Of the release configuration, whose target bounds the rows of a group."""
    line = F.concat_ws("|", "id", "split", "source_sql", F.coalesce("target_sql", F.lit("")), "source_ast_hash", F.coalesce("target_ast_hash", F.lit("")), "semantic_hash")
    lines = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("id", line.alias("line")))), lambda x: x["line"]), "\n")
    return corpus_rows(spark, sf_dir).groupBy("task", "schema_family").agg(F.count("*").alias("n_rows"), F.sha2(lines, 256).alias("rows_sha256"))


@query("SELECT doc_id, '{\"doc_id\": ' || doc_id || ', \"lang\": \"' || lang || '\", \"source\": \"' || source || '\"}' AS line FROM documents")
def jsonl_records(spark, sf_dir):
    """The lines that the JSONL sink writes."""
    rows = export.json_lines(_table(spark, sf_dir, "documents").select("doc_id", "lang", "source", F.col("doc_id").alias("pos")), "pos")
    return rows.select(F.get_json_object("line", "$.doc_id").cast("long").alias("doc_id"), "line")
