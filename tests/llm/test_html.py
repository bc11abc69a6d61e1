"""Extraction against slow versions: of the main text of the given pages, and of which blocks repeat across pages."""

import html
import math
import re

import numpy as np
import pytest

from loomsql.llm import htmltext


def slow(pages, depth=htmltext.DEPTH):
    """Texts by (url, html): windows of each host's distinct pages in a dictionary, block by block."""
    parsed = {p: htmltext.blocks(p[1]) for p in set(pages)}
    host = {p: (re.match(r"(?s).*?://([^/?#]*)", p[0] or "") or ["", ""])[1].lower() for p in parsed}
    streams, where = {}, {}
    for p, found in parsed.items():
        own = [i for i, (_, a, m) in enumerate(found) if a and not m]
        edges = {i for i in own[:2] + own[-2:] if depth <= len(found[i][0].split()) <= htmltext.EDGE_WORDS}
        streams[p] = [(i, w) for i, (t, a, m) in enumerate(found) if i in edges or not a and not m for w in t.split()], bool(own), edges
        words = [w for _, w in streams[p][0]]
        for k in range(len(words) - depth + 1):
            where.setdefault((host[p], tuple(words[k : k + depth])), set()).add(p)
    out = {}
    for p, found in parsed.items():
        (stream, has_article, edges), n = streams[p], sum(h == host[p] for h in host.values())
        words, kept, usable = [w for _, w in stream], [], []
        for i, (text, article, marked) in enumerate(found):
            if marked or not article and len(text.split()) < depth and has_article:
                continue
            usable.append(text)
            at = [k for k, (b, _) in enumerate(stream) if b == i]
            least = max(htmltext.LEAST_PAGES, math.ceil(htmltext.TEMPLATE * n)) if i in edges else 2
            hit = {k + j for k in range(len(words) - depth + 1) if len(where[host[p], tuple(words[k : k + depth])]) >= least for j in range(depth)}
            if not at or sum(k in hit for k in at) / len(at) < htmltext.COVERED:
                kept.append(text)
        out[p] = "\n\n".join(kept or usable)
    return out


def test_main_text_of_the_given_pages(spark):
    for r in htmltext.extract(spark.read.parquet("/root/testdata/sf0.01/pages.parquet")).join(spark.read.parquet("/root/testdata/sf0.01/pages.parquet").select("page_id", "html"), "page_id").collect():
        article = re.search(r"<article>(.*)</article>", r["html"], re.S)[1]
        parts = [html.unescape(re.sub(r"<[^>]*>", "", re.sub(r"<br\s*/?>", " ", p))) for p in re.split(r"</?(?:h1|p|div|ul|li)\b[^>]*>", article)]
        want = "\n\n".join(t for t in (" ".join(p.split()) for p in parts) if t)
        assert r["text"] == want and r["n_chars"] == len(want)


def made_pages(rng):
    words = lambda n, top: " ".join(f"w{k}" for k in rng.integers(0, top, n))
    pool = [words(int(n), 50) for n in rng.integers(3, 30, 12)]
    pages = []
    for i in range(90):
        host, body = ("a.com", "b.com", "b.com")[i % 3], []
        for _ in range(rng.integers(0, 5)):
            tag = ("div", "p", "nav", "section")[rng.integers(4)]
            body.append(f"<{tag}>{pool[rng.integers(12)] if rng.random() < 0.6 else words(12, 10**6)}</{tag}>")
        if rng.random() < 0.9:
            inside = [f"<p>{pool[rng.integers(12)] if rng.random() < 0.3 else words(15, 10**6)}</p>" for _ in range(rng.integers(0, 5))]
            body.insert(0, "<article>" + "".join(inside) + f"<p>{pool[0] if host == 'b.com' else words(9, 10**6)} of our template and its words here</p></article>")
        pages.append((f"http://{host}/{i % 80}", "".join(body)))
    return [*pages, pages[0], (None, "<p>loose"), ("http://a.com/none", None), ("http://A.com/", "")]


@pytest.mark.parametrize("group_pages", [7, htmltext.GROUP_PAGES])
def test_extraction_against_brute_force(spark, group_pages):
    pages = made_pages(np.random.default_rng(4))
    want = slow(pages)
    frame = spark.createDataFrame([(i, u, h, "x", "y") for i, (u, h) in enumerate(pages)], "page_id long, url string, html string, text string, key string")
    got = {r["page_id"]: r["text"] for r in htmltext.extract(frame, group_pages=group_pages).collect()}
    assert got == {i: want[p] for i, p in enumerate(pages)}
    assert any("of our template" in h and "of our template" not in want[u, h] for u, h in pages if u and h)  # the array has decided inside of articles


def slow_whole(pages, depth=htmltext.DEPTH):
    """Texts by (url, html), judging all unmarked blocks: the windows of all of them in a dictionary."""
    parsed = {p: [b for b in htmltext.blocks(p[1]) if not b[2]] for p in set(pages)}
    host = {p: (re.match(r"(?s).*?://([^/?#]*)", p[0] or "") or ["", ""])[1].lower() for p in parsed}
    words, where, out = {p: [w for t, _, _ in found for w in t.split()] for p, found in parsed.items()}, {}, {}
    for p, stream in words.items():
        for k in range(len(stream) - depth + 1):
            where.setdefault((host[p], tuple(stream[k : k + depth])), set()).add(p)
    for p, found in parsed.items():
        n, at, kept, usable = sum(h == host[p] for h in host.values()), 0, [], []
        on = [len(where[host[p], tuple(words[p][k : k + depth])]) for k in range(len(words[p]) - depth + 1)]
        for text, article, _ in found:
            size, least = len(text.split()), max(htmltext.LEAST_PAGES, math.ceil(htmltext.TEMPLATE * n)) if article else 2
            hits = [any(m >= least for m in on[max(0, k - depth + 1) : k + 1]) for k in range(at, at + size)]
            at += size
            if article or size >= depth or not any(a for _, a, _ in found):
                usable.append(text)
                if sum(hits) / size < htmltext.COVERED:
                    kept.append(text)
        out[p] = "\n\n".join(kept or usable)
    return out


def pages_with_lines_inside(rng):
    """Articles with template lines in the middle, long and in short lines on end, quotes of other articles, copies."""
    words = lambda n: " ".join(f"w{k}" for k in rng.integers(0, 10**6, n))
    long, short, quote = words(70), [words(4), words(3), words(5)], words(30)
    pages, teasers = [], []
    for i in range(80):
        own = [words(int(rng.integers(3, 60))) for _ in range(8)]
        inside = [*own[:3], *([long] if rng.random() < 0.9 else []), own[3], *([quote] if rng.random() < 0.5 else []), *own[4:6], *(short if rng.random() < 0.9 else []), *own[6:]]
        teasers.append(own[4])
        loose = [f"<div>{teasers[int(rng.integers(len(teasers)))]} and</div>" for _ in range(2)] + [f"<div>{words(20)}</div>"]
        pages.append((f"http://{('a.com', 'b.com', 'b.com')[i % 3]}/{i}", "<article>" + "".join(f"<p>{t}</p>" for t in inside) + "</article>" + "".join(loose)))
    return [*pages, *pages[:40], (None, None), ("http://a.com/x", "<p>loose")], long, short, quote


@pytest.mark.parametrize("group_pages, bins", [(7, 32), (htmltext.GROUP_PAGES, 32), (9, 1)])
def test_all_places_of_articles_are_judged(spark, monkeypatch, group_pages, bins):
    monkeypatch.setattr(htmltext, "BINS", bins)
    monkeypatch.setattr(htmltext, "LEAST_BITS", 4 if bins == 1 else htmltext.LEAST_BITS)
    pages, long, short, quote = pages_with_lines_inside(np.random.default_rng(6))
    want = slow_whole(pages)
    frame = spark.createDataFrame([(i, *p) for i, p in enumerate(pages)], "page_id long, url string, html string").repartition(3)
    got = {r["page_id"]: r["text"] for r in htmltext.extract(frame, group_pages=group_pages).collect()}
    assert got == {i: want[p] for i, p in enumerate(pages)}
    assert any(long in p[1] for p in pages[:80]) and not any(t in got[i] for i in range(80) for t in (long, *short)) and any(quote in t for t in got.values())


def test_suffix_array_and_common_prefixes():
    rng = np.random.default_rng(5)
    for top in (2, 4, 1000):
        words = rng.integers(0, top, 80).astype(np.uint64)
        array, ranks = htmltext.suffix_array(words)
        suffixes = [tuple(words[i:].tolist()) for i in range(80)]
        assert array.tolist() == sorted(range(80), key=lambda i: suffixes[i])
        common = lambda a, b: next((k for k, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))
        assert htmltext.common_prefixes(array, ranks).tolist() == [common(suffixes[i], suffixes[j]) for i, j in zip(array[:-1], array[1:], strict=True)]
    assert htmltext.suffix_array(np.zeros(0, np.uint64))[0].tolist() == []


@pytest.mark.parametrize(
    "page, want",
    [
        ("<p>a</p><p title=it's>b</p><p>c</p><p>d's e</p><p>f</p>", ["a", "b", "c", "d's e", "f"]),
        ("<p title=\"x > y\" data-class='ad'>a</p><p class = 'ad'>b</p><p title = 'c>d'>e", ["a", "e"]),
        ("<p title='never closed>a</p><p>b</p>", ["a", "b"]),
        ("<article class='post comment'><p>said</p></article><article><p>text</p></article>", ["text"]),
        ("<body class='comments-open'><p>a 1 < 2 &amp; 3 > 2 <3</p>", ["a 1 < 2 & 3 > 2 <3"]),
        ("<div>a<script>if (x < '</p>') y</script>b<style>p{}</style></div>", ["ab"]),
    ],
)
def test_markup(page, want):
    assert [t for t, _, marked in htmltext.blocks(page) if not marked] == want


def test_very_long_html(spark):
    body = " ".join(f"wörd{i}" for i in range(60_000))
    pages = spark.createDataFrame([(1, "http://x.com/1", f"<nav>menu</nav><article><p>{body}</p></article>" + "<a title='" * 3000), (2, "http://x.com/2", f"<div>{body}</div>")], "page_id long, url string, html string")
    assert {r["page_id"]: r["text"] for r in htmltext.extract(pages).collect()} == {1: body, 2: body}
