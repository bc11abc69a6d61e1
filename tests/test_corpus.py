import json
import os
import shutil
import subprocess
import sys
from pathlib import Path

import plain_corpus
import pytest
from pyspark.sql import functions as F

from loomsql import catalogue, cli
from loomsql.functions import keys
from loomsql.functions import programs as P
from loomsql.operators import dedup, validate
from loomsql.plans import corpus, program
from loomsql.sources import export, schemas
from loomsql.sources.schemas import FAMILIES

REPO = Path(__file__).resolve().parents[1]


def small():
    g = corpus.RELEASE["generation"] | {"target_total_rows": 60, "task_targets": {"clean": 12, "corrupt": 28, "normalize": 20}, "max_attempts": 3000}
    return corpus.RELEASE | {"generation": g, "splits": corpus.RELEASE["splits"] | {"validation_template_families": 1}}


def test_the_release_is_that_of_plain_python(spark):
    want = plain_corpus.build(corpus.RELEASE, FAMILIES)
    got = [r.asDict() for r in corpus.build(spark, corpus.RELEASE, FAMILIES)[0].orderBy("position").drop("position").collect()]
    assert got == want and len(got) == 2500
    assert plain_corpus.digests(want) == sorted(catalogue.DIGESTS)
    first = {task: min(r["id"].rsplit("_", 1)[1] for r in got if r["task"] == task) for task in ("generate_clean_query", "repair", "canonicalization")}
    assert first == dict.fromkeys(first, "000001")


def test_a_corpus_from_yaml_on_the_command_line(spark, tmp_path, capsys):
    import yaml

    config = small() | {"schemas": [str(REPO / f"loomsql/families/{f.schema_family}.yaml") for f in FAMILIES]}
    (tmp_path / "config.yaml").write_text(yaml.safe_dump(config))
    assert schemas.load_schemas(config["schemas"]) == FAMILIES
    cli.main(["release", str(tmp_path / "config.yaml"), "--output-dir", str(tmp_path / "out")], spark)
    paths = capsys.readouterr().out.split()
    lines, want = Path(paths[0]).read_text().splitlines(), plain_corpus.build(small(), FAMILIES)
    assert lines == [json.dumps(r, sort_keys=True) for r in want] and len(lines) == 60
    manifest = json.loads(Path(paths[1]).read_text())
    assert manifest["num_rows"] == manifest["stats"]["final_rows"] == 60
    # The same lines by the sink for shared storage, and the rows back from Parquet.
    records = corpus.build(spark, small(), FAMILIES)[0]
    export.write_jsonl_folder(records, f"file://{tmp_path}/folder", "position", parts=4)
    parts = sorted((tmp_path / "folder").glob("part-*"))
    assert len(parts) > 1 and "".join(p.read_text() for p in parts).splitlines() == lines
    export.write_parquet(records, f"file://{tmp_path}/parquet")
    assert spark.read.parquet(f"file://{tmp_path}/parquet").count() == 60


def test_stable_hashes_of_any_text(spark):
    texts = ["", None, "é", "€😀", "\x7f", "\n\t\b", "\x1f\x0b\x00"[:2], "\\u001F", "\\\\u001f", '"\\', "a/<b>", " 𐍈", "plain"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", keys.stable_hash(z=F.col("t"), a=F.lit(1)).alias("h")).collect()
    for r in rows:
        assert r["h"] == keys.stable_hash_py({"a": 1, "z": r["t"]}), repr(r["t"])


def test_texts_of_one_shape_parse_alike(spark):
    p = F.col("program")
    texts = [P.render(p), *[P.corrupted_sql(p, o, F.lit("logistics")) for o in P.CORRUPTIONS], P.noncanonical(p), F.lit("SELECT FROM"), F.lit(" "), F.lit(None).cast("string")]
    made = [program.generate(f, template_id="t", complexity=c, seed=i) for f in FAMILIES for c in program.COMPLEXITIES for i in range(8)]
    rows = program.frame(spark, made).select(F.explode(F.array(*texts)).alias("text")).distinct()
    one, two = ({r["text"]: bool(r["parse_errors"]) for r in validate.with_parse_errors(rows, "text", by_shape=by).collect()} for by in (False, True))
    assert one == two and set(one.values()) == {True, False} and len(one) > 200
    assert validate.shape_of("SELECT t1.date AS a_1 FROM b WHERE c <> 'd e' LIMIT 25", {"SELECT", "DATE", "AS", "FROM", "WHERE", "LIMIT"}) == "SELECT x.date AS x FROM x WHERE x <> '' LIMIT 0"


def test_names_and_families(spark):
    row = spark.sql("SELECT named_struct('schema_family', 'a', 'template_id', 'b') x, named_struct('schema_family', 'a', 'template_id', 'b') y, named_struct('schema_family', 'a', 'template_id', 'c') z")
    got = row.select(keys.versioned(F.lit("a"), F.lit("v1")), keys.same_template_family("x", "y"), keys.same_template_family("x", "z"), P.recipe_id(F.lit("one"), F.lit("two"))).first()
    assert tuple(got) == ("a_v1", True, False, "one+two")
    parts = spark.createDataFrame([("SUM(t2.x)",), ("t1.x",), ("f(g(x))",)], "e string").select(P.metric_parts(F.col("e")).alias("p")).collect()
    assert [p["p"] and tuple(p["p"]) for p in parts] == [("SUM", "t2.x"), None, ("f", "g(x)")]


def test_exact_and_semantic_keys(spark):
    columns = {"dialect": "d", "db_schema_id": "s", "source_sql": "é", "target_sql": None, "task": "t"}
    row = spark.createDataFrame([tuple(columns.values())], ", ".join(f"{c} string" for c in columns))
    want = keys.stable_hash_py({"dialect": "d", "schema": "s", "source_sql": "é", "target_sql": None, "task": "t"})
    assert row.select(keys.exact_row_key()).first()[0] == want
    said = row.select(keys.semantic_hash(F.lit("s"), F.lit("m"), F.lit("repair"), F.lit("h"))).first()[0]
    assert said == keys.stable_hash_py({"schema_id": "s", "template_id": "m", "task": "repair", "program_hash": "h"})
    assert row.select(keys.exact_audit_key()).first()[0] == "t|s|é||d"


def test_dedup_keeps_columns_that_clash(spark):
    extra = "_key _n _g _v key KEY_ rank group variant Group_"
    rows = spark.createDataFrame([(i, i % 3, *["x"] * 9) for i in range(9)], "pos long, k long, " + ", ".join(f"`{c}` string" for c in extra.split()[:9]))
    first = dedup.keep_first(rows, F.col("k"), "pos").collect()
    assert sorted(r["pos"] for r in first) == [0, 1, 2] and first[0].asDict().keys() == set(rows.columns) and {r["rank"] for r in first} == {"x"}
    capped = dedup.cap_variants(rows, F.col("k"), F.col("pos").cast("string"), F.lit(""), "pos", 2)
    assert capped.columns == [*rows.columns, "group_first"] and sorted((r["pos"], r["group_first"], r["group"]) for r in capped.collect()) == [(i, i % 3, "x") for i in range(6)]
    assert dedup.keep_first(rows.limit(0), F.col("k"), "pos").collect() == []


def test_groups_are_limited_before_they_are_sorted(spark):
    rows = spark.range(10).select(F.col("id").alias("pos"), (F.col("id") % 2).alias("k"))
    capped = dedup.cap_variants(rows, F.col("k"), F.col("pos").cast("string"), F.lit(""), "pos", 2)
    assert capped._jdf.queryExecution().optimizedPlan().toString().count("WindowGroupLimit") == 2


def test_programs_of_the_catalogue_cover_all_branches(spark):
    made = [c[0] for c in catalogue._CASES]
    assert {len(p["joins"]) for p in made} == {0, 1, 2} and any(not p["group_by"] for p in made) and len({p["metadata"]["schema_id"] for p in made}) == 2
    labels = {r[0] for r in catalogue.queries()["complexity_label"](spark, "/root/testdata/sf0.001").select("value").collect()}
    stages = {r[0] for r in catalogue.queries()["failure_stage_missing_group_by"](spark, "/root/testdata/sf0.001").select("value").collect()}
    assert labels == set(program.COMPLEXITIES) and stages == {"valid", "parse", "resolve", "logic"}


@pytest.mark.parametrize("with_pipeline", [True, False])
def test_the_rest_stands_without_the_llm_folders(tmp_path, with_pipeline):
    left_out = shutil.ignore_patterns(".git", "llm", "__pycache__", "spark-warehouse", *([] if with_pipeline else ["corpus_pipeline.py"]))
    shutil.copytree(REPO, tmp_path / "repo", ignore=left_out)
    code = "import __spark_entry__ as e; names = set(e.queries()); assert 'corpus_rows' in names and 'pipeline' not in names and not any(n.startswith('op') for n in names); assert set(e.oracle_sql()) < names; import bench"
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path / "repo", env=os.environ | {"PYTHONPATH": str(tmp_path / "repo")}, capture_output=True, text=True)
    assert done.returncode == 0, done.stderr
