"""Every operator and stage on tables with columns that clash with names of its own, with odd rows, and without rows."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from loomsql.llm import bagminhash, chat, decontaminate, htmltext, learn, lm, media, mixing, quality, toxicity, urlfilter

EXTRA = "_k _c _s _l _t _f _key _n _g _v key Key_ KEY__ place of_class class_id class_key found Found_ text_key may_hold mix MIX_P fitted of_source of_lang of_topic weight p score predicted held_out label bands root node bag size hash band one two block shard doc tokens topic rule verdict host path digest short turns segments formatted ts starts blocks clip clips m".split()
ROWS = [(1, None, "s", "en"), (2, "", "s", None), (3, " ".join(f"w{i % 911}" for i in range(20_000)), None, "en"), (4, "same words here again and again", "s", "en"), (4, "same words here again and again", "s", "en"), (4, "other", "s", "de"), (None, "x", "s", "en"), (5, "same words here, again and again!", "s", "en")]


def with_extra(df):
    taken = {c.lower() for c in df.columns}
    names = []
    for c in EXTRA:
        if c.lower() not in taken and c.lower() not in {n.lower() for n in names}:
            names.append(c)
    return df.select("*", *[F.lit(f"extra {c}").alias(c) for c in names])


@pytest.fixture
def docs(spark):
    return with_extra(spark.createDataFrame(ROWS, "doc_id long, text string, source string, lang string"))


@pytest.fixture
def bench(spark):
    return with_extra(spark.createDataFrame([(1, "Same words HERE"), (2, None), (None, "other"), (3, ""), (4, "same words here again")], "item_id long, text string"))


@pytest.fixture
def labels(spark):
    return with_extra(spark.createDataFrame([(1, 0, 1), (3, 1, 0), (4, 0, 1), (None, 1, 1), (5, None, None), (99, 1, 1)], "doc_id long, toxic int, quality int"))


def operators(spark, docs, bench, labels):
    """Each as (name, whether it keeps the extra columns, a frame of all rows, a frame of no rows)."""
    none, pages = docs.limit(0), with_extra(docs.select(F.col("doc_id").alias("page_id"), F.col("lang").alias("url"), F.col("text").alias("html")))
    turns = with_extra(docs.select(F.col("doc_id").alias("conv_id"), F.lit(1).alias("turn"), F.col("lang").alias("role"), "text"))
    video = docs.withColumn("video", media.encode("text"))
    toxic, good = toxicity.fit(docs, labels), quality.fit(docs, labels)
    either = lambda f: (f(docs), f(none))
    return [
        ("chat", False, chat.digest(turns), chat.digest(turns.limit(0))),
        ("media", False, *either(media.digest)),
        ("clips", True, media.clips(video.where("doc_id = 4").drop("clip"), "video"), media.clips(video.drop("clip").limit(0), "video")),
        ("html", False, htmltext.extract(pages), htmltext.extract(pages.limit(0))),
        ("toxicity", False, *either(lambda d: toxicity.score_toxicity(d, toxic))),
        ("quality", False, *either(lambda d: quality.score_quality(d, good))),
        ("lm", False, *either(lm.score_lm)),
        ("decontamination", False, *either(lambda d: decontaminate.contamination(d, bench))),
        ("decontamination, large", True, *either(lambda d: decontaminate.find(d, bench, most_bytes=1, name="of_benchmark").drop("of_benchmark"))),
        ("mixing", False, *either(mixing.mixed)),
        ("mixing by frames", True, *either(lambda d: mixing.mixture(d, most_cells=0, name="of_mixing").drop("of_mixing"))),
        ("near duplicates", False, *either(bagminhash.near_duplicates)),
        ("urls", False, urlfilter.judge(pages, with_extra(urlfilter.rules_frame(spark))), urlfilter.judge(pages.limit(0), urlfilter.rules_frame(spark))),
    ]


def test_operators(spark, docs, bench, labels):
    for name, keeps, some, none in operators(spark, docs, bench, labels):
        rows = some.collect()
        assert none.collect() == [] and len(rows) == {"chat": 6, "clips": len(rows)}.get(name, len(ROWS)), name
        if keeps:
            assert set(docs.columns) - {"clip"} <= set(some.columns), name
            assert all(r["_k"] == "extra _k" and r["key"] == "extra key" for r in rows), name


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_stages(spark, docs, bench, labels, tmp_path, name, stage):
    for table, rows in (("labels", labels), ("benchmark", bench)):
        rows.write.parquet(f"{tmp_path}/{table}.parquet")
    out = stage(spark, docs, str(tmp_path))
    kept = out.collect()
    assert out.columns[: len(docs.columns)] == docs.columns and stage(spark, docs.limit(0), str(tmp_path)).collect() == []
    assert all(r["_k"] == "extra _k" and r["Key_"] == "extra Key_" for r in kept)
    if name == "near_dedup":  # null and empty; the repeated row; words that are equal but for their marks
        assert sorted((r["doc_id"] or -1, r["text"] or "") for r in kept) == sorted({(-1, "x"), (1, ""), (3, ROWS[2][1]), (4, ROWS[3][1]), (4, "other")})
    if name == "decontamination":
        assert sorted(r["doc_id"] or -1 for r in kept) == [-1, 1, 2, 3, 4]
    if name in ("toxicity", "quality"):
        for table in ("labels",):  # without labels all scores are 0.5
            labels.limit(0).write.parquet(f"{tmp_path}/none/{table}.parquet")
        assert stage(spark, docs, f"{tmp_path}/none").count() == (0 if name == "toxicity" else len(ROWS))


def test_sample_is_bounded_by_rows_and_bytes(spark):
    docs = spark.range(400).select(F.col("id").alias("doc_id"), F.concat(F.lit("word "), F.repeat(F.lit("x"), 95)).alias("text"))
    labels = docs.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("toxic"))
    fit = lambda **k: learn.fit(docs, labels, "toxic", F.lit(True), toxicity.CONFIG, **k).fitted_rows
    assert (fit(), fit(per_class=30), fit(class_bytes=1000), fit(class_bytes=1)) == (400, 60, 20, 2)
