import json

import duckdb
import pytest
from pyspark.sql import functions as F

from loomsql import catalogue, cli
from loomsql.functions import keys
from loomsql.functions import programs as P
from loomsql.operators import dedup
from loomsql.operators.validate import parse_sql
from loomsql.plans import corpus, program
from loomsql.sources import schemas
from loomsql.sources.schemas import FAMILIES

DATA = "/root/testdata/sf0.001"
BY_NAME = {s.schema_family: s for s in FAMILIES}
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def sql(spark, p, column=P.render):
    return program.frame(spark, [p]).select(column(F.col("program"))).first()[0]


def test_hashes_and_ids(spark):
    assert keys.stable_hash_py({"y": 2, "x": 1}) == "689a8f1db95402580476e38c264278ce7b1e664320cfb4e9ae8d3a908cf09964"
    row = spark.sql("SELECT 'retail_sales' schema_family, 'baseline_summary' template_id")
    family = row.select(keys.template_family_key().alias("k")).withColumn("b", keys.split_bucket(F.col("k"))).first()
    assert family["k"] == "ba0d9cc54b7b09c5f3065cb6a8ce988d5b0354df9c960f1f5a33558edd588122" and family["b"] == 70
    ids = spark.sql("SELECT 12 a, 1234567 b").select(keys.row_id(F.lit("sqlcorrupt"), F.lit("join"), F.col("a")), keys.row_id(F.lit("x"), F.lit("y"), F.col("b"))).first()
    assert tuple(ids) == ("sqlcorrupt_join_000012", "x_y_1234567")


def test_schemas(tmp_path):
    logistics = BY_NAME["logistics"]
    assert logistics.schema_id == "logistics_v1" and len(logistics.join_graph) == 3
    path = schemas.write_schema(BY_NAME["hr_payroll"], tmp_path / "x.json")
    assert json.loads(path.read_text())["tables"][0]["name"] == "departments"
    with pytest.raises(KeyError):
        logistics.table("nope")


def test_generator_is_seeded(spark):
    make = lambda f, c, s: program.generate(BY_NAME[f], template_id="t", complexity=c, seed=s)
    assert make("retail_sales", "easy", 11) == make("retail_sales", "easy", 11)
    medium, hard = make("logistics", "medium", 2), make("hr_payroll", "hard", 1)
    assert medium["base_table"]["name"] == "warehouses" and medium["joins"][0]["right_table"]["name"] == "shipments" and medium["group_by"]
    assert hard["having"] and sql(spark, hard, P.complexity) == "hard" and sql(spark, medium, P.complexity) == "medium"
    assert sql(spark, medium, P.program_hash) == keys.stable_hash_py(medium)
    with pytest.raises(ValueError):
        make("logistics", "odd", 1)


def test_corruptions_fail_where_intended(spark):
    p = program.generate(BY_NAME["logistics"], template_id="carrier_rollup", complexity="medium", seed=2)
    for o, (_, stage, _) in P.CORRUPTIONS.items():
        assert sql(spark, p, lambda c, o=o: P.failure_stage(F.lit(o != "missing_comma"), P.corrupted(c, o, F.lit("logistics")), FAMILIES)) == stage
    assert sql(spark, p, lambda c: P.failure_stage(F.lit(True), c, FAMILIES)) == "valid"
    assert not parse_sql(spark, sql(spark, p, lambda c: P.corrupted_sql(c, "missing_comma", F.lit("logistics"))))[0]
    assert parse_sql(spark, sql(spark, p))[0] and not parse_sql(spark, "SELECT FROM")[0] and not parse_sql(spark, " ")[0]


def test_program_functions_on_generated_programs_of_all_shapes(spark):
    made = [(f, program.generate(BY_NAME[f.schema_family], template_id="t", complexity=c, seed=i)) for f in FAMILIES for c in program.COMPLEXITIES for i in range(12)]

    def text(p, items=None, group=True):
        items = items or ", ".join(f"{i['expression']} AS {i['alias']}" for i in p["select_items"])
        both = lambda x: " AND ".join(e["expression"] for e in x)
        lines = [f"SELECT {items}", f"FROM {p['base_table']['name']} AS {p['base_table']['alias']}"]
        lines += [f"{j['join_type']} {j['right_table']['name']} AS {j['right_table']['alias']} ON {j['on_expression']}" for j in p["joins"]]
        lines += ["WHERE " + both(p["where_predicates"])] * bool(p["where_predicates"]) + ["GROUP BY " + ", ".join(p["group_by"])] * bool(p["group_by"] and group)
        lines += ["HAVING " + both(p["having"])] * bool(p["having"]) + ["ORDER BY " + ", ".join(f"{o['expression']} {o['direction']}" for o in p["order_by"])] * bool(p["order_by"])
        return "\n".join(lines + [f"LIMIT {p['limit']}"] * (p["limit"] is not None))

    rows = program.frame(spark, [p for _, p in made])
    p, none = F.col("program"), F.lit("logistics")
    values = {
        "sql": P.render(p), "label": P.complexity(p), "tables": P.from_tables(p), "resolve": P.resolve_errors(p, FAMILIES), "logic": P.logic_errors(p, FAMILIES),
        "comma": P.corrupted_sql(p, "missing_comma", none), "column": P.corrupted_sql(p, "unknown_column", none), "group": P.corrupted_sql(p, "missing_group_by", none),
        "unknown": P.resolve_errors(P.unknown_column(p), FAMILIES), "ungrouped": P.logic_errors(P.missing_group_by(p), FAMILIES),
    }
    shapes = set()
    for (_, q), r in zip(made, rows.orderBy("n").select(*[v.alias(k) for k, v in values.items()]).collect(), strict=True):
        aggregate, (one, two) = any(i["is_aggregate"] for i in q["select_items"]), [f"{i['expression']} AS {i['alias']}" for i in q["select_items"]]
        shapes.add((len(q["joins"]), bool(q["group_by"]), bool(q["having"])))
        assert r["sql"] == text(q) and r["group"] == text(q, group=False) and r["comma"] == text(q, f"{one} {two}")
        assert r["column"] == text(q, f"{one.split('.')[0]}.unknown_column AS {one.split(' AS ')[1]}, {two}")
        assert r["label"] == ("hard" if len(q["joins"]) > 1 or q["having"] else "medium" if q["joins"] or q["group_by"] or aggregate else "easy")
        assert r["tables"] == [q["base_table"]["name"], *[j["right_table"]["name"] for j in q["joins"]]]
        assert r["resolve"] == r["logic"] == [] and r["unknown"] == ["Unknown column: t1.unknown_column"]
        assert r["ungrouped"] == ["Aggregate without GROUP BY"] * aggregate
    assert {n for n, _, _ in shapes} == {0, 1, 2} and {g for _, g, _ in shapes} == {True, False}


def test_normalization(spark):
    p = program.generate(BY_NAME["retail_sales"], template_id="baseline_summary", complexity="medium", seed=1)
    canonical, loose = sql(spark, p, lambda c: P.render(P.canonical(c))), sql(spark, p, P.noncanonical)
    assert "s1." in canonical and "SELECT" in canonical and "select" in loose
    assert sql(spark, p, lambda c: P.render(P.canonical(P.canonical(c)))) == canonical


def test_repeated_canonicalization_keeps_plans_small(spark):
    """The driver's memory holds a plan many times over while it is optimized."""
    p = program.generate(BY_NAME["logistics"], template_id="t", complexity="hard", seed=3)
    column, found = F.col("program"), []
    for _ in range(3):
        column = P.canonical(column)
        found.append((len(str(column)), sql(spark, p, lambda c, column=column: column)))
    assert found[1][0] < 3 * found[0][0] and found[2][0] < 4 * found[0][0]
    once = P.render(P.canonical(F.col("program")))
    assert len(str(P.render(column))) < len(str(column)) + len(str(once)) and sql(spark, p, lambda c: P.render(column)) == sql(spark, p, lambda c: once)
    without_hash = [{k: v for k, v in r.asDict(recursive=True).items() if k != "metadata"} for _, r in found]
    assert without_hash[0] == without_hash[1] == without_hash[2]
    # The hash is of the result with the old hash in it, so it is another one each time.
    assert len({r["metadata"]["program_hash"] for _, r in found}) == 3


def test_cap_keeps_first_of_each_variant(spark):
    rows = spark.createDataFrame([(1, "a", "x"), (2, "b", "x"), (3, "a", "x"), (4, "a", "y"), (5, "a", ""), (6, "a", None)], "pos long, g string, v string")
    kept = dedup.cap_variants(rows, F.col("g"), F.col("v"), F.col("pos").cast("string"), "pos", 3).orderBy("group_first", "pos")
    assert [r["pos"] for r in kept.collect()] == [1, 4, 5, 2]


def test_command_line(spark, tmp_path, capsys):
    tables = [
        {"name": "w", "primary_key": "id", "columns": [{"name": "id", "data_type": "integer"}, {"name": "region", "data_type": "text"}]},
        {"name": "s", "primary_key": "id", "columns": [{"name": "id", "data_type": "integer"}, {"name": "w_id", "data_type": "integer", "value_strategy": "foreign_key"}, {"name": "cost", "data_type": "decimal"}],
         "foreign_keys": [{"column": "w_id", "references_table": "w", "references_column": "id"}]},
    ]
    config = tmp_path / "x.yaml"
    config.write_text(json.dumps({"schema_family": "x", "version": "v1", "tables": tables}))
    said = lambda *a: (cli.main(list(a), spark), capsys.readouterr().out.splitlines())[1]
    assert said("schema", str(config), "--output-dir", str(tmp_path)) == [str(tmp_path / "x_v1.json")]
    assert said("clean", str(config), "--seed", "3")[0].startswith("SELECT ")
    out = said("corrupt", str(config), "--operator", "missing_group_by")
    assert out[out.index("-- observed_failure_stage") + 1] == out[out.index("-- intended_failure_stage") + 1] == "logic"
    assert said("normalize", str(config))[-4:] == list(P.RULES)
    with pytest.raises(ValueError):
        cli.main(["corrupt", str(config), "--complexity", "easy", "--operator", "missing_group_by"], spark)
    (tmp_path / "r" / "data").mkdir(parents=True)
    (tmp_path / "r" / "data" / "records.jsonl").write_text("{}\n")
    (tmp_path / "r" / "manifest.json").write_text("{}")
    assert said("stage", "--release-dir", str(tmp_path / "r"), "--output-dir", str(tmp_path / "d")) == [str(tmp_path / "d")] and (tmp_path / "d" / "data" / "records.jsonl").exists()


def test_validation_report_runs_all_stages(spark):
    p = program.generate(BY_NAME["logistics"], template_id="t", complexity="medium", seed=2)
    none = F.array().cast("array<string>")
    good = sql(spark, p, lambda c: P.validation_report(c, none, FAMILIES))
    assert good["is_valid"] and good["errors"] == {}
    bad = sql(spark, p, lambda c: P.validation_report(P.unknown_column(P.missing_group_by(c)), F.array(F.lit("no SQL")), FAMILIES))
    assert not bad["is_valid"] and set(bad["errors"]) == {"parse", "resolve", "logic"} and not any(bad["stage_results"])


def test_parse_results_decide(spark, monkeypatch):
    config = corpus.RELEASE | {"generation": corpus.RELEASE["generation"] | {"target_total_rows": 6, "max_attempts": 60}}
    rows = corpus.build(spark, config, FAMILIES)[0].collect()
    texts = [r["source_sql"] for r in rows]
    said = dict(zip(texts, corpus.validate.parse_all(spark, texts), strict=True))
    assert rows and all(bool(said[r["source_sql"]]) == (r["corruption_recipe_id"] == "missing_comma") for r in rows if r["task"] != "canonicalization")
    monkeypatch.setattr(corpus.validate, "parse_all", lambda spark, texts: ["no"] * len(texts))
    with pytest.raises(ValueError):
        corpus.build(spark, config, FAMILIES)
    stages = catalogue.queries()["failure_stage_unknown_column"](spark, DATA).collect()
    assert {r["value"] for r in stages} == {"parse"}


def test_release(spark, tmp_path):
    paths = corpus.build_release(spark, corpus.RELEASE, tmp_path, FAMILIES)
    manifest = json.loads((tmp_path / "manifest.json").read_text())
    lines = [json.loads(x) for x in open(paths["data_path"])]
    assert manifest["num_rows"] == len(lines) == 2500 and set(lines[0]) == set(corpus.FIELDS)
    stats = manifest["stats"]
    # The published figures of the release configuration.
    assert stats["task_counts"] == {"generate_clean_query": 623, "repair": 1312, "canonicalization": 565}
    assert not stats["leakage_report"]["has_leakage"]
    split = {(r["schema_family"], r["template_id"]): r["split"] for r in lines}
    assert split["retail_sales", "baseline_summary"] == "validation" and split["logistics", "cross_table_audit"] == "train" and split["hr_payroll", "carrier_rollup"] == "test_ood"


@pytest.mark.parametrize("name", sorted(catalogue.oracle_sql()))
def test_oracle(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    got = catalogue.queries()[name](spark, DATA)
    names = sorted(got.columns)
    want = con.execute(f"SELECT {', '.join(names)} FROM ({catalogue.oracle_sql()[name]})").fetchall()
    assert sorted(map(repr, map(tuple, got.select(*names).collect()))) == sorted(map(repr, want))
