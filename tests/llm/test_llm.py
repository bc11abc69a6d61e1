import hashlib
import re
import zlib
from collections import Counter
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from loomsql.llm import bagminhash, chat, decontaminate, htmltext, media, mixing, quality, queries, scratch, toxicity, urlfilter

DATA = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LONG = " ".join(f"wörd{i % 977}" for i in range(30_000))
#: Null and empty texts, a very long one, repeated rows, a repeated id, a null id, and a column with a clashing name.
ODD = [(1, None, "s", "en", 0.1), (2, "", "s", None, 0.2), (3, LONG, None, "en", 0.3), (4, "same words here again and again", "s", "en", 0.4), (4, "same words here again and again", "s", "en", 0.4), (4, "other", "s", "en", 0.4), (None, "x", "s", "en", 0.5)]


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


@pytest.fixture
def odd(spark):
    return spark.createDataFrame(ODD, "doc_id long, text string, source string, lang string, score double")


@pytest.fixture
def documents(spark):
    return spark.read.parquet(f"{DATA}/documents.parquet")


def test_chat_reads_back_what_it_was_told(spark):
    said = "a<|im_end|>\n<|im_start|>x &lt;| &amp; <|im_sep|>"
    rows = [(1, 2, "assistant", said), (1, 1, "user", None), (1, 3, "assistant", "more<"), (2, 0, None, "|x"), (3, 0, "a\nb", ""), (None, None, "user", "n")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    out = {r["conv_id"]: r for r in chat.format_conversations(turns).withColumn("turns", chat.parse_formatted(F.col("formatted"))).collect()}
    assert [tuple(t) for t in out[1]["turns"]] == [("user", ""), ("assistant", said), ("assistant", "more<")] and out[1]["n_blocks"] == 2
    assert [tuple(t) for t in out[2]["turns"]] == [("", "|x")] and [tuple(t) for t in out[3]["turns"]] == [("a\nb", "")] and out[None]["turns"][0]["text"] == "n"
    digest = {r["conv_id"]: r for r in chat.digest(turns).collect()}[1]
    assert digest["loss_sha256"] == hashlib.sha256((said + "more<").encode()).hexdigest() and digest["loss_chars"] == len(said) + 5
    assert chat.digest(turns.limit(0)).collect() == []


def test_media_keeps_the_payload(spark, odd):
    for r in media.digest(odd).collect():
        text = next((t or "").encode() for i, t, *_ in ODD if i == r["doc_id"] and len((t or "").encode()) == r["n_bytes"])
        payload = text.ljust(max(1, -(-len(text) // 192)) * 192)
        assert (r["payload_bytes"], r["payload_sha256"], r["tail_crc32"]) == (len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-16:]))
    assert media.digest(odd.limit(0)).collect() == []


def test_media_decodes_any_bytes_and_cuts_shots(spark):
    rng = np.random.default_rng(5)
    still, other = rng.integers(0, 60, (12, 192)).astype(np.uint8), rng.integers(180, 256, (9, 192)).astype(np.uint8)
    samples = np.concatenate((still, other, rng.integers(0, 256, (1, 192)).astype(np.uint8)))
    file = media.write_avi(*media.encode_frames(samples))
    back, bounds, begins, _ = media.load([file, None, file])
    assert (back == np.concatenate((samples, samples))).all() and bounds.tolist() == [0, 22, 22, 44]
    assert {0, 12} <= set(np.flatnonzero(begins[:22]).tolist())
    rows = media.clips(spark.createDataFrame([(7, bytearray(file))], "id long, video binary"), "video").orderBy("clip").collect()
    assert rows[0]["start_s"] == 0 and rows[1]["first_frame"] == 12 and rows[-1]["end_s"] == pytest.approx(22 / media.FPS)


@pytest.mark.parametrize("cuts", [[1], [2], [1, 2], [1, 2, 3], [5, 6], [22], [22, 23], *[list(range(k, 24, k)) for k in (2, 3, 4, 5, 8, 9)], *[list(range(k - 1, 24, k)) for k in (2, 3, 5, 8)]])
def test_media_finds_each_cut_of_short_shots(cuts):
    for strength in (1.0, 0.3):  # still frames, where a cut moves that share of the samples to a new bin
        bins = np.cumsum(np.bincount(cuts, minlength=24))[:, None] % 2 * (np.arange(192) < 192 * strength)
        still = (40 + 100 * bins).astype(np.uint8)
        begins = media.shots(np.concatenate((still, still)), np.array([0, 24, 48]))
        assert np.flatnonzero(begins).tolist() == [0, *cuts, 24, *[24 + c for c in cuts]]


def test_media_takes_steady_motion_for_one_shot():
    rng = np.random.default_rng(3)
    still = np.full((30, 192), 40, np.uint8)
    level = rng.integers(0, 256, (30, 192)).astype(np.uint8) * (np.arange(192) < 110) + np.uint8(40) * (np.arange(192) >= 110)
    for samples in (level, np.concatenate((still, level)), np.concatenate((level, still))):
        begins = np.flatnonzero(media.shots(samples.astype(np.uint8), np.array([0, len(samples)]))).tolist()
        assert set(begins) <= {0, 30, 31}
    assert np.flatnonzero(media.shots(np.repeat(np.array([[40], [90], [140]], np.uint8), [1, 1, 1], axis=0), np.array([0, 3]))).tolist() == [0, 1, 2]


def test_html_blocks():
    page = "<html><head><title>x</title></head><body><nav>a<p>b</nav><div class='cookie notice'>c</div><article><h1>T &amp; u</h1><p>one<br>two <b>th</b>ree<p>four<div id=comments>d</div></article><footer>e"
    assert [t for t, a, m in htmltext.blocks(page) if a and not m] == ["T & u", "one two three", "four"]
    assert htmltext.blocks(None) == [] and htmltext.blocks("") == []


def test_html_boilerplate_is_found_across_groups(spark):
    menu, policy = "Home about the company and all of its many products", "Read our long privacy policy about everything you do here"
    rows = [(i, f"http://x.com/{i}", f"<body><div>{menu}</div><p>unique text {i} with {i * 7919} zebras</p><div>{policy}</div>", "c") for i in range(6)]
    rows += [(7, None, None, "c"), (8, "http://y.com", "<article>Quoted words that another page of this host has too</article>", "c"), (9, "http://y.com/2", "<article>Quoted words that another page of this host has too</article>", "c")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    want = {i: f"unique text {i} with {i * 7919} zebras" for i in range(6)} | {7: ""} | dict.fromkeys((8, 9), "Quoted words that another page of this host has too")
    for size in (2, 4096):
        assert {r["page_id"]: r["text"] for r in htmltext.extract(pages, group_pages=size).collect()} == want
    assert htmltext.extract(pages.limit(0)).collect() == []


def test_html_loose_text_of_pages_with_an_article(spark):
    notice = "Every page of this host tells its readers about the same long notice"
    body = [" ".join(f"w{i}x{k}" for k in range(20)) for i in range(4)]
    rows = [(i, f"http://x.com/{i}", f"<div>{notice}</div><article><h1>T{i}</h1></article><div>{body[i]}</div><div>by A {i}</div><nav>nav {body[i][::-1]}</nav>") for i in range(4)]
    rows += [(5, "http://x.com/5", "<article><div class=ad>Buy now</div></article><p>short but all there is"), (6, "http://x.com/6", f"<article>art</article><p>{notice}")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    want = {i: f"T{i}\n\n{body[i]}" for i in range(4)} | {5: "short but all there is", 6: "art"}
    for size in (2, 4096):
        assert {r["page_id"]: r["text"] for r in htmltext.extract(pages, group_pages=size).collect()} == want


def test_suffix_array_coverage_against_brute_force():
    rng = np.random.default_rng(2)
    for _ in range(30):
        words, page = rng.integers(1, 4, 60).astype(np.uint64), np.sort(rng.integers(0, 4, 60))
        where = {}
        for i in range(60 - 4):
            if page[i] == page[i + 4]:
                where.setdefault(tuple(words[i : i + 5]), []).append(i)
        want = np.zeros(60, bool)
        for at in where.values():
            if len({page[i] for i in at}) > 1:
                for i in at:
                    want[i : i + 5] = True
        assert (htmltext.covered(words, page, depth=5) == want).all()


def test_classifiers_on_held_out_rows(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    for kind, label in ((toxicity, "toxic"), (quality, "quality")):
        model = kind.fit(docs, labels)
        scores = (kind.score_toxicity if kind is toxicity else kind.score_quality)(docs, model).where("held_out").join(labels, "doc_id").collect()
        one, two = ([r["score"] for r in scores if r[label] == k] for k in (1, 0))
        auc = np.mean([np.mean(np.greater(a, two) + np.equal(a, two) / 2) for a in one])
        assert auc > 0.9, (label, auc)


def test_classifiers_on_odd_rows(spark, odd):
    for kind in (toxicity, quality):
        label = "toxic" if kind is toxicity else "quality"
        none = spark.createDataFrame([], f"doc_id long, {label} int")
        some = spark.createDataFrame([(1, 0), (3, 1), (4, 1), (4, 0), (None, 1), (2, None), (99, 1)], f"doc_id long, {label} int")
        for labels in (none, some):
            model = kind.fit(odd, labels)
            out = (kind.score_toxicity if kind is toxicity else kind.score_quality)(odd, model).collect()
            assert len(out) == len(ODD) and all(0 <= r["score"] <= 1 and r["held_out"] is not None for r in out)
        assert (toxicity.reject_toxic if kind is toxicity else quality.keep_good)(odd, model).columns == odd.columns


@pytest.mark.parametrize("targets", [{"source": {"a": 0.7, None: 0.3, 5: 1.0}, "lang": {"zz": 1.0}}, {"source": {"c": 1.0}, "lang": {None: 1.0}}, {"source": {"e": 1.0}}])
def test_mixing_gives_the_same_by_frames(spark, targets):
    rows = [(i, "one two three" if s != "e" else "", s, g) for i, (s, g) in enumerate([(s, g) for s in ("a", "b", None, "e") for g in ("en", "de", None)] + [("c", "en")])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    one, two = ({r["doc_id"]: (r["mix"]["weight"], r["mix"]["p"], r["mix"]["kept"]) for r in mixing.mixture(docs, targets, most_cells=most).collect()} for most in (mixing.MOST_CELLS, 0))
    assert len(one) == len(two) == len(rows)
    for i in one:
        assert one[i][:2] == pytest.approx(two[i][:2], abs=1e-6) and one[i][2] == two[i][2], rows[i]
    if None in targets["source"]:
        by = Counter()
        for i, _, s, g in rows:
            by["s", s] += one[i][0] * 3 * (s != "e")
            by["l", g] += one[i][0] * 3 * (s != "e")
        assert by["s", "a"] / sum(by["s", s] for s in ("a", "b", "c", None)) == pytest.approx(0.7) and by["s", "b"] == 0
        assert by["l", "en"] == pytest.approx(by["l", None])


def test_decontamination_against_brute_force(spark, documents, odd):
    items = [(1, " ".join(f"wörd{i}" for i in range(100, 115))), (2, "Same WORDS, here"), (3, None), (4, ""), (None, "other"), (12, "same words here")]
    for docs, bench in ((documents, spark.read.parquet(f"{DATA}/benchmark.parquet")), (odd, spark.createDataFrame(items, "item_id long, text string"))):
        named = [(r["item_id"], WORD.findall(lower(r["text"]))) for r in bench.collect() if r["item_id"] is not None]
        want = []
        for r in docs.collect():
            words, hit, found = WORD.findall(lower(r["text"])), set(), set()
            at = {}
            for n in {min(10, len(w)) for _, w in named if w}:
                for k in range(len(words) - n + 1):
                    at.setdefault(tuple(words[k : k + n]), []).append(k)
            for item, w in named:
                for k in range(max(1, len(w) - 9) if w else 0):
                    window = tuple(w[k : k + 10])
                    for p in at.get(window, ()):
                        hit.update(range(p, p + len(window)))
                        found.add(str(item))
            want.append((r["doc_id"] or -1, len(words), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()))
        for size in (decontaminate.MOST_BYTES, 60):
            got = decontaminate.find(docs, bench, most_bytes=size).select("doc_id", "found.n_words", "found.n_hit", "found.n_items", "found.items_sha256").collect()
            assert sorted((r[0] or -1, *r[1:]) for r in got) == sorted(want)
    spans = decontaminate.find(odd, bench).where("doc_id = 4 AND found.n_hit > 0").first()["found"]["spans"]
    assert ODD[3][1][spans[0]["start"] : spans[0]["end"]] == "same words here"


def test_bagminhash_is_unbiased_and_finds_what_brute_force_finds(spark, documents, odd):
    rng = np.random.default_rng(1)
    a, b, same = rng.integers(0, 4, 50), rng.integers(0, 8, 50), 0.0
    for _ in range(40):
        k = rng.integers(1, 1 << 62, 50, dtype=np.uint64)
        one, two = (bagminhash.signatures(np.zeros((w > 0).sum(), np.int64), k[w > 0], w[w > 0], 1, 200) for w in (a, b))
        same += (one == two).mean() / 40
    assert same == pytest.approx(np.minimum(a, b).sum() / np.maximum(a, b).sum(), abs=0.03)
    rows = documents.select("doc_id", "text").collect()
    bags = {}
    for r in rows:
        w = WORD.findall(lower(r["text"]))
        bags[r["doc_id"]] = Counter(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4) if w else 0))
    root = {i: i for i in bags}
    find = lambda i: i if root[i] == i else find(root[i])
    for i, j in combinations(sorted(bags), 2):
        if (bags[i] | bags[j]) and sum((bags[i] & bags[j]).values()) >= 0.8 * sum((bags[i] | bags[j]).values()):
            x, y = sorted((find(i), find(j)))
            root[y] = x
    got = {r["doc_id"]: r["class_id"] for r in bagminhash.near_duplicates(documents).collect()}
    assert got == {i: find(i) for i in bags}
    assert bagminhash.keep_one(documents).count() == len(set(got.values()))
    assert sorted((r["doc_id"] or -1) for r in bagminhash.near_duplicates(odd).collect()) == [-1, 1, 2, 3, 4, 4, 4]
    assert sorted((r["doc_id"] or -1) for r in bagminhash.keep_one(odd).collect()) == [-1, 1, 3, 4, 4]  # 1 and 2 are both empty
    assert bagminhash.near_duplicates(odd.limit(0)).collect() == []


def test_mixing_meets_its_margins(spark, odd):
    # Enough documents that every source has every language and topic: else no weights meet all margins.
    rows = mixing.mixed(spark.read.parquet("/root/testdata/sf0.1/documents.parquet")).collect()
    total = sum(r["n_tokens"] for r in rows)
    for m in mixing.MARGINS:
        own, raked = Counter(), Counter()
        for r in rows:
            own[r[m]] += r["n_tokens"]
            raked[r[m]] += r["n_tokens"] * r["weight"]
        goal = {k: v ** mixing.TEMPER[m] for k, v in own.items() if v}
        for k in goal:
            assert raked[k] / total == pytest.approx(goal[k] / sum(goal.values()), rel=0.02)
    assert sum(r["n_tokens"] * r["p"] for r in rows) == pytest.approx(mixing.BUDGET * total, rel=1e-6)
    assert mixing.mixed(odd).count() == len(ODD) and mixing.sample(odd).columns[:-1] == odd.columns and mixing.mixed(odd.limit(0)).collect() == []


def test_urls(spark):
    urls = ["http://A.Example.org/en/12?x", "https://example.org/es/1", "http://com/de/", "http://xcom/de/", "ftp://b.com/fr/", "org/", None, "http://org", "http://c.org/#/es/", ""]
    pages = spark.createDataFrame([(i, u, "x") for i, u in enumerate(urls)], "page_id long, url string, rule string")
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in urlfilter.judge(pages, urlfilter.rules_frame(spark)).collect()}
    assert got[0] == ("a.example.org", "/en/12", "example.org/en/1", "block") and got[1][2:] == ("example.org/es/", "block") and got[2][2:] == ("com/de/", "block")
    assert got[3][2:] == (None, "allow") and got[4][2:] == ("com/fr/", "allow") and got[5] == got[6] == got[9] == ("", "", None, "allow")
    assert got[7] == ("org", "", None, "allow") and got[8][2:] == ("org/", "allow")
    assert urlfilter.judge(pages.limit(0), urlfilter.rules_frame(spark)).collect() == []


def test_all_ten_are_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.queries()) == list(range(1, 11))


def test_texts_of_one_to_four_words_are_one_shingle():
    keys, bounds = bagminhash.shingles(pa.array(["a b c", "A, b! c", "", "a b c d e f"], pa.large_string()))
    assert bounds.tolist() == [0, 1, 2, 2, 4] and keys[0] == keys[1]


def test_signatures_do_not_depend_on_the_batch():
    rng = np.random.default_rng(3)
    texts = [" ".join(f"w{k}" for k in rng.integers(0, 300, rng.integers(1, 14))) for _ in range(3000)]
    all_at_once = bagminhash.bands(pa.array(texts, pa.large_string())).to_pylist()
    for at in range(0, 3000, 50):
        assert bagminhash.bands(pa.array(texts[at : at + 1], pa.large_string())).to_pylist() == all_at_once[at : at + 1]


def test_no_link_of_a_bucket_is_lost(spark):
    rng = np.random.default_rng(9)
    base = [f"w{i}" for i in range(120)]
    texts = []
    for n in range(60):
        own = list(base)
        for at in rng.choice(len(base), 1 + n % 4, replace=False):
            own[at] = f"x{rng.integers(1000)}"
        texts.append(" ".join(own))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    # All in one bucket, as in a large group of near copies.
    nodes = docs.select("doc_id", bagminhash._key("text").alias("key"), F.array(F.lit(7).cast("long")).alias("bands"))
    keys = [hashlib.md5(t.encode()).hexdigest() for t in texts]
    packs = bagminhash.packed(pa.array(texts, pa.large_string())).to_pylist()
    root = {k: k for k in keys}
    find = lambda i: i if root[i] == i else find(root[i])
    for i, j in combinations(range(len(texts)), 2):
        if bagminhash.overlap(packs[i], packs[j]) >= 0.88:
            x, y = sorted((find(keys[i]), find(keys[j])))
            root[y] = x
    for block_texts in (8, 512):
        got = {r["key"]: r["root"] for r in bagminhash.roots(docs, nodes, 0.88, block_texts).collect()}
        one, two = ({frozenset(k for k in keys if of[k] == r) for r in of.values()} for of in (got, {k: find(k) for k in keys}))
        assert one == two and 1 < len(one) < len(texts)


def test_overlaps_of_blocks_are_those_of_pairs():
    rng = np.random.default_rng(4)
    texts = [" ".join(f"w{k}" for k in rng.integers(0, 2 + n % 5, rng.integers(0, 60))) for n in range(40)] + [LONG, LONG + " more", ""]
    packs = bagminhash.packed(pa.array(texts, pa.large_string())).to_pylist()
    got = bagminhash.overlaps(packs[:20], packs[20:] + packs[:3])
    want = [[bagminhash.overlap(a, b) for b in packs[20:] + packs[:3]] for a in packs[:20]]
    assert (got == np.array(want)).all() and bagminhash.overlaps(packs[40:41], packs[41:42])[0, 0] > 0.99
    bags = [Counter(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4) if w else 0)) for w in (t.split() for t in texts[:40])]
    for (a, x), (b, y) in combinations(zip(bags, packs[:40], strict=True), 2):
        assert bagminhash.overlap(x, y) == (sum((a & b).values()) / sum((a | b).values()) if a | b else 0)


def test_pipeline_stages_keep_the_right_rows(spark):
    import corpus_pipeline

    labels, bench = (spark.read.parquet(f"{DATA}/{t}.parquet") for t in ("labels", "benchmark"))
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs.collect()
        out = scratch.written(stage(spark, docs, DATA), f"test-{name}")
        assert out.columns[: len(docs.columns)] == docs.columns
        if name in ("toxicity", "quality"):
            kind, score, keeps = (toxicity, toxicity.score_toxicity, lambda s: s < 0.5) if name == "toxicity" else (quality, quality.score_quality, lambda s: s >= 0.5)
            scores = {r["doc_id"]: r["score"] for r in score(docs, kind.fit(docs, labels)).collect()}
            want = [r["doc_id"] for r in before if keeps(scores[r["doc_id"]])]
        elif name == "near_dedup":
            words = {r["doc_id"]: WORD.findall(lower(r["text"])) for r in before}
            bags = {i: Counter(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4) if w else 0)) for i, w in words.items()}
            of = {i: i for i in bags}
            for i, j in combinations(sorted(bags), 2):
                if bags[i] == bags[j] or sum((bags[i] & bags[j]).values()) >= 0.8 * sum((bags[i] | bags[j]).values()):
                    x, y = sorted((of[i], of[j]))
                    of = {k: x if c == y else c for k, c in of.items()} if x != y else of
            want = sorted(set(of.values()))
        elif name == "decontamination":
            named = [w for r in bench.collect() if (w := WORD.findall(lower(r["text"])))]
            windows = {tuple(w[i : i + decontaminate.WINDOW]) for w in named for i in range(max(1, len(w) - decontaminate.WINDOW + 1))}
            lengths = {len(w) for w in windows}
            words = {r["doc_id"]: WORD.findall(lower(r["text"])) for r in before}
            want = [i for i, w in words.items() if not any(tuple(w[k : k + n]) in windows for n in lengths for k in range(len(w) - n + 1))]
        else:
            want = [r["doc_id"] for r in mixing.mixture(docs).select("doc_id", "mix.p", mixing.draw("doc_id").alias("u")).collect() if r["u"] < r["p"]]
        kept[name] = sorted(r["doc_id"] for r in out.collect())
        assert kept[name] == sorted(want) and 0 < len(want) <= len(before), name
        docs = out
    assert sorted(r["doc_id"] for r in corpus_pipeline.run(spark, DATA).collect()) == kept["mixing"]
