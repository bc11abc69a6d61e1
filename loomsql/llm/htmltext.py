"""HTML extraction: blocks from the markup, and a suffix array per host that finds boilerplate repeated across pages.

1. Each page's markup is cut, once, into text blocks. Blocks inside elements that can't be main text (menus, forms,
   scripts, adverts, reader comments, ...) are marked. Blocks inside article or main elements are the article.
2. A page's stream has the words of all its unmarked blocks, in page order. The streams of a host's pages are concatenated
   with a mark between pages; a suffix array of them (by prefix doubling) and the common prefixes of its neighbours give
   the substrings of DEPTH words or more, and on how many distinct pages each occurs.
3. A block is boilerplate if such substrings cover COVERED of its words: outside of an article those that occur on two
   pages; inside one, where pages may quote or copy one another, those on TEMPLATE of the host's pages and on LEAST_PAGES
   at least. All blocks are judged, at any place of a page and of any length.
4. A page's text is its unmarked article blocks and, in page order, the unmarked loose blocks of DEPTH words or more,
   without the boilerplate. Where no article has an unmarked block, it is the unmarked loose blocks of any length that
   aren't boilerplate (all unmarked ones if none is left: the page is then a copy of another).

Words that can't be in such a substring don't go into the array. By a hash each window of DEPTH words falls into one of
2 ** bits bins, and of each host and bin the pages with a window in it are counted. That is never less than the pages of
one window, so a window is left out only if its bin has too few pages to matter: fewer than step 3 asks for inside of
articles, and, if it touches loose text anywhere on the host, fewer than two. All occurrences of any other window stay,
so the array's counts of these, and with them the result, are those of the whole streams. Where bins fill up (pages far
longer than the mean) more words go into the array.

A host's pages are dealt into groups of about GROUP_PAGES pages and GROUP_BYTES of streams, each with an array of its own;
on how many pages of the host a window of DEPTH words occurs, if it does in two groups, is found by an aggregation over
the host's windows, so the result doesn't depend on the groups.

Defined results: null or empty html gives an empty text; pages equal in url and html count as one page; a null url is
an empty host; unclosed elements end with the page, tables' rows and list items are blocks; html of any length is parsed
whole; an empty table gives no rows; extra columns play no part.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import bytesops as bo
from .scratch import dropped, written
from .subword import _ranges

DEPTH, COVERED, GROUP_PAGES, GROUP_BYTES = 8, 0.8, 2048, 4 << 20
TEMPLATE, LEAST_PAGES = 2 / 3, 20
#: Words up to which a block of an article is judged: no limit.
EDGE_WORDS = float("inf")
#: Bins of windows for each word of the mean page, least and most bits of a bin; windows held before bins are sent; parts
#: of the input whose bins are added up at once.
BINS, LEAST_BITS, MOST_BITS, HELD, PARTS = 32, 12, 20, 4_000_000, 64

#: Fixed values, all of HTML: elements without an end tag; elements whose content isn't markup; block elements.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = "script|style|noscript|template|iframe|svg|textarea|title"
BLOCK = set(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol p pre section summary table tbody tfoot thead tr ul".split()
)
#: Elements that are never main text, and words of a class, id or role that say so.
NEVER = set("head nav footer aside form menu dialog button select object canvas audio video".split())
WORDS = set(
    "ad ads advert adverts advertisement advertising alert banner breadcrumb breadcrumbs comment comments complementary consent contentinfo cookie cookies footer masthead menu modal nav navbar navigation newsletter notice notices pagination popup promo promotion related replies respond search share sharing sidebar social sponsor sponsored subscribe toolbar".split()
)
#: Words of a class, id or role that make even an article of its own no main text.
COMMENTS = set("comment comments reply replies respond".split())
#: Up to the end of a tag: a quote opens a value only right after an equals sign.
_REST = r"""(?:=\s*+(?:"[^"]*+"|'[^']*+')|[^>])*+"""
_TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<(?P<raw>{RAW})\b{_REST}>.*?(?:</(?P=raw)\s*>|\Z)|<[!?][^>]*>|<(?P<end>/?)(?P<name>[a-zA-Z][-a-zA-Z0-9:]*)(?P<attributes>{_REST})>",
    re.S | re.I,
)
_NAMED = re.compile(r"""(?<![-\w])(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
_HIDDEN = re.compile(r"""(?:^|\s)hidden(?:\s|=|/|$)|display\s*:\s*none""", re.I)
_WORD = re.compile(r"[a-z]+")


def _marked(name: str, attributes: str, inside: int) -> bool:
    if name in NEVER or name == "header" and not inside:
        return True
    if not attributes.strip() or name in ("html", "body", "main") and not inside:
        return False
    said = {w for m in _NAMED.finditer(attributes) for w in _WORD.findall((m[1] or m[2] or m[3] or "").lower())}
    if name == "article" and not inside:
        return bool(said & COMMENTS)
    return bool(said & WORDS) or "header" in said and not inside or bool(_HIDDEN.search(attributes))


def blocks(page: str | None) -> list[tuple[str, bool, bool]]:
    """(text, inside an article, marked as no main text) of each block with text, in page order."""
    out, held = [], []
    skip, depth, inside, at = None, 0, 0, 0
    page = page or ""

    def close():
        text = " ".join("".join(held).split())
        if text:
            out.append((text, inside > 0, skip is not None))
        held.clear()

    for m in _TOKEN.finditer(page):
        if m.start() > at:
            held.append(entities.unescape(page[at : m.start()]))
        at = m.end()
        name = m["name"] and m["name"].lower()
        if not name:
            continue
        if name == "br" or name in ("td", "th"):
            held.append(" ")
            continue
        if name in VOID and name != "hr":
            continue
        is_block, end = name in BLOCK, m["end"]
        if is_block:
            close()
        if skip:
            if name == skip:
                depth += -1 if end else not m["attributes"].endswith("/")
            if not depth or skip == "p" and is_block or skip == "head" and name == "body":
                close()
                skip, depth = None, 0
                if end or name == "hr":
                    continue
            else:
                continue
        if not end and name not in VOID and _marked(name, m["attributes"], inside) and not m["attributes"].endswith("/"):
            close()
            skip, depth = name, 1
        elif name in ("article", "main"):
            inside = max(0, inside + (-1 if end else 1))
    if at < len(page) and not re.match(r"</?[a-zA-Z!?]", page[at:]):
        held.append(entities.unescape(page[at:]))
    elif at < len(page) and (cut := re.sub(r"<[^>]*\Z", "", page[at:])):
        held.append(entities.unescape(cut))
    close()
    return out


def _words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of texts, one after the other, and the number of words of each."""
    data, offsets = bo.separated(texts)
    starts, ends = bo.spans(data, bo.NOT_SPACE)
    return bo.hashed(bo.prefix_sums(data), starts, ends), np.diff(bo.rows_of(starts, offsets))


def suffix_array(words: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Places in the order of their suffixes, and by k the ranks of the places' next 2 ** k words (equal ranks: equal words;
    the end of all comes before any word), up to the first k at which all differ."""
    n = len(words)
    ranks = [np.unique(words, return_inverse=True)[1].astype(np.int64)]
    while n and ranks[-1].max() < n - 1:
        step = 1 << (len(ranks) - 1)
        after = np.full(n, -1)
        after[: max(n - step, 0)] = ranks[-1][step:]
        ranks.append(np.unique(ranks[-1] * (n + 1) + after + 1, return_inverse=True)[1].astype(np.int64))
    return np.argsort(ranks[-1]), ranks


def common_prefixes(array: np.ndarray, ranks: list[np.ndarray]) -> np.ndarray:
    """Of each two neighbours in the suffix array, the number of words with which both suffixes begin."""
    n, one, two = len(array), array[:-1].copy(), array[1:].copy()
    out = np.zeros(len(one), np.int64)
    for k in range(len(ranks) - 1, -1, -1):
        # A rank of 2 ** k words that reaches beyond the end of all is equal to no other one.
        on = np.flatnonzero((one < n) & (two < n))
        on = on[ranks[k][one[on]] == ranks[k][two[on]]]
        out[on] += 1 << k
        one[on] += 1 << k
        two[on] += 1 << k
    return out


def pages_with(words: np.ndarray, page: np.ndarray, more: tuple[np.ndarray, np.ndarray] | None = None, depth: int = DEPTH, run: np.ndarray | None = None) -> np.ndarray:
    """On how many distinct pages each place's next `depth` words occur; 0 for a place with fewer before its run ends.
    words: the pages' streams, one after the other. more: windows() and the pages that they have in all groups. run:
    numbers of the runs that were adjacent on a page; without them, a page is one."""
    n, run = len(words), page if run is None else run
    out = np.zeros(n, np.int64)
    if n < depth:
        return out
    # A mark of its own after each run: no two suffixes agree beyond the end of a run.
    last = np.flatnonzero(np.append(run[1:] != run[:-1], True))
    number = np.unique(words, return_inverse=True)[1] + len(last)
    stream, of_page = np.insert(number, last + 1, np.arange(len(last))), np.insert(page, last + 1, page[last])
    array, ranks = suffix_array(stream)
    group = np.concatenate(([0], np.cumsum(common_prefixes(array, ranks) < depth)))
    pair = np.unique(group * (int(page.max()) + 1) + of_page[array]) // (int(page.max()) + 1)
    counts = np.empty(len(stream), np.int64)
    counts[array] = np.bincount(pair, minlength=int(group[-1]) + 1)[group]
    out = np.delete(counts, last + 1 + np.arange(len(last)))
    if more is not None and len(more[0]):
        known, own = np.argsort(more[0]), windows(words, depth)
        at = np.minimum(np.searchsorted(more[0][known], own), len(known) - 1)
        out = np.where(more[0][known][at] == own, np.maximum(out, more[1][known][at]), out)
    return np.where(_whole(run, depth), out, 0)


def _whole(run: np.ndarray, depth: int) -> np.ndarray:
    """Which places have `depth` words before their run ends."""
    whole = np.zeros(len(run), bool)
    whole[: max(len(run) - depth + 1, 0)] = run[: max(len(run) - depth + 1, 0)] == run[depth - 1 :]
    return whole


def covered(words: np.ndarray, page: np.ndarray, more: tuple[np.ndarray, np.ndarray] | None = None, depth: int = DEPTH, least: int = 2) -> np.ndarray:
    """Which words lie in a substring of `depth` words or more that occurs on `least` distinct pages."""
    return _spread(pages_with(words, page, more, depth) >= least, depth)


def _spread(hits: np.ndarray, depth: int) -> np.ndarray:
    level = np.zeros(len(hits) + 1, np.int64)
    np.add.at(level, np.flatnonzero(hits), 1)
    np.add.at(level, np.minimum(np.flatnonzero(hits) + depth, len(hits)), -1)
    return np.cumsum(level)[:-1] > 0


def windows(words: np.ndarray, depth: int = DEPTH) -> np.ndarray:
    """A hash of the window that begins at each place."""
    out = np.zeros(len(words), np.uint64)
    padded = np.concatenate((words, np.zeros(depth, np.uint64)))
    with np.errstate(over="ignore"):
        for k in range(depth):
            out = bo.mix(out * np.uint64(0x9E3779B97F4A7C15) + padded[k : k + len(words)])
    return out


#: A page's unmarked blocks, in page order; of each what it is (0: too short a loose text beside an article, 1: loose text,
#: 2: text of an article); the number of their words.
PARSED = "struct<texts:array<string>, kinds:array<int>, n:bigint>"
_PARSED = pa.struct([("texts", pa.list_(pa.string())), ("kinds", pa.list_(pa.int32())), ("n", pa.int64())])
#: Of a page's stream the words that go into the array and their runs of adjacent places in it; the words of all its blocks.
STREAM = "struct<words:binary, runs:binary, sizes:array<int>>"
_STREAM = pa.struct([("words", pa.binary()), ("runs", pa.binary()), ("sizes", pa.list_(pa.int32()))])
#: By bin, the pages with a window in it, and whether one of these touches loose text (null: none does).
BINNED = pa.schema([("host", pa.string()), ("part", pa.int64()), ("counts", pa.binary()), ("loose", pa.binary())])
_DDL = "host string, part bigint, counts binary, loose binary"


def _candidates(found: list[tuple[str, bool, bool]], depth: int) -> tuple[list[str], list[int], int]:
    unmarked = [(text, article, text.count(" ") + 1) for text, article, marked in found if not marked]
    own = any(article for _, article, _ in unmarked)
    return [u[0] for u in unmarked], [2 if a else int(n >= depth or not own) for _, a, n in unmarked], sum(u[2] for u in unmarked)


def _streams(texts: pa.ListArray, depth: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Slices of pages: the first page; the first block of each page and after the last; the words of each block; the
    words; the page, in the slice, of each word; windows()."""
    flat, first = bo.texts(texts.flatten()), np.asarray(texts.offsets).astype(np.int64)
    if not len(flat):
        return
    first -= first[0]
    at, a = bo.buffers(flat)[1][first], 0
    while a < len(texts):
        b = max(a + 1, int(np.searchsorted(at, at[a] + bo.SLICE_BYTES, "right")) - 1)
        if first[b] > first[a]:
            words, sizes = _words(flat.slice(first[a], first[b] - first[a]))
            page = np.repeat(np.repeat(np.arange(b - a), np.diff(first[a : b + 1])), sizes)
            yield a, first[a : b + 1], sizes, words, page, windows(words, depth)
        a = b


def _zipped(numbers: np.ndarray) -> bytes:
    return pa.compress(numbers.tobytes(), "zstd", asbytes=True)


def _unzipped(data: bytes, size: int, kind: type) -> np.ndarray:
    return np.frombuffer(pa.decompress(data, size * np.dtype(kind).itemsize, "zstd"), kind)


def _binned(batches: Iterator[pa.RecordBatch], depth: int, bits: int) -> Iterator[pa.RecordBatch]:
    """Rows of BINNED, for each host of some of the pages of a part of the input."""
    from pyspark import TaskContext

    part, numbers, counted, touching, held = TaskContext.get().partitionId() // PARTS, {}, [], [], 0

    def sent():
        bins, n = np.unique(np.concatenate(counted), return_counts=True)
        loose, rows = np.unique(np.concatenate(touching)), []
        for host, k in numbers.items():
            (a, b), (c, d) = (np.searchsorted(x, [k << bits, (k + 1) << bits]) for x in (bins, loose))
            if a < b:
                counts, flags = np.zeros(1 << bits, np.uint64), np.zeros(1 << bits, bool)
                counts[bins[a:b] - (k << bits)] = n[a:b]
                flags[loose[c:d] - (k << bits)] = True
                rows.append((host, part, _zipped(counts), _zipped(flags) if c < d else None))
            if len(rows) == 256:
                yield pa.RecordBatch.from_pylist([dict(zip(BINNED.names, r, strict=True)) for r in rows], BINNED)
                rows = []
        yield pa.RecordBatch.from_pylist([dict(zip(BINNED.names, r, strict=True)) for r in rows], BINNED)

    for batch in batches:
        of_page = np.array([numbers.setdefault(h, len(numbers)) for h in batch.column(0).to_pylist()], np.int64)
        kinds = batch.column(2).flatten().to_numpy()
        for row, first, sizes, _, page, hashes in _streams(batch.column(1), depth):
            whole = np.flatnonzero(_whole(page, depth))
            bins = (hashes[whole] >> np.uint64(64 - bits)).astype(np.int64)
            distinct = np.unique(page[whole] << bits | bins)
            counted.append(of_page[row + (distinct >> bits)] << bits | distinct & (1 << bits) - 1)
            loose = np.concatenate(([0], np.cumsum(np.repeat(kinds[first[0] : first[-1]] == 1, sizes))))
            near = loose[whole + depth] > loose[whole]
            touching.append(np.unique(of_page[row + page[whole[near]]] << bits | bins[near]))
            held += len(distinct)
            if held >= HELD:
                yield from sent()
                numbers, counted, touching, held = {}, [], [], 0
                of_page = np.array([numbers.setdefault(h, len(numbers)) for h in batch.column(0).to_pylist()], np.int64)
    if counted:
        yield from sent()


def _added(table: pa.Table, bits: int) -> tuple[np.ndarray, np.ndarray]:
    counts, loose = np.zeros(1 << bits, np.uint64), np.zeros(1 << bits, bool)
    for one, flags in zip(table.column("counts"), table.column("loose"), strict=True):
        counts += _unzipped(one.as_py(), 1 << bits, np.uint64)
        if flags.is_valid:
            loose |= _unzipped(flags.as_py(), 1 << bits, bool)
    return counts, loose


def _of_part(table: pa.Table, bits: int) -> pa.Table:
    counts, loose = _added(table, bits)
    return pa.table([table.column("host")[:1], table.column("part")[:1], [_zipped(counts)], [_zipped(loose)]], schema=BINNED)


def _of_host(table: pa.Table, bits: int) -> pa.Table:
    """The bins whose windows go into the host's array, if there are any."""
    counts, loose = _added(table, bits)
    used = (counts >= _least(table.column("of_host")[0].as_py())) | loose & (counts >= 2)
    rows = [(table.column("host")[0].as_py(), table.column("of_host")[0].as_py(), _zipped(used))] if used.any() else []
    return pa.Table.from_pylist([dict(host=h, of_host=n, bins=b) for h, n, b in rows], pa.schema([("host", pa.string()), ("of_host", pa.int64()), ("bins", pa.binary())]))


def _least(pages: int) -> int:
    """Pages on which a substring is that takes text from an article."""
    return max(LEAST_PAGES, int(np.ceil(TEMPLATE * pages)))


def _used(texts: pa.ListArray, bins: pa.Array, depth: int, bits: int) -> pa.Array:
    """Rows of STREAM; null for a page without a window in one of its host's bins."""
    out = [None] * len(texts)
    for row, first, sizes, words, page, hashes in _streams(texts, depth):
        at, whole = np.searchsorted(page, np.arange(len(first))), _whole(page, depth)
        first, known = first - first[0], (None, None)
        for k in range(len(first) - 1):
            a, b = at[k : k + 2]
            if b - a < depth:
                continue
            own = bins[row + k].as_py()
            if own != known[0]:
                known = own, _unzipped(own, 1 << bits, bool)
            hits = whole[a:b] & known[1][(hashes[a:b] >> np.uint64(64 - bits)).astype(np.int64)]
            places = np.flatnonzero(_spread(hits, depth))
            if len(places):
                out[row + k] = dict(words=words[a:b][places].tobytes(), runs=_as_runs(places), sizes=sizes[first[k] : first[k + 1]].tolist())
    return pa.array(out, _STREAM)


def _as_runs(places: np.ndarray) -> bytes:
    """Starts and lengths of the runs of adjacent places."""
    first = np.flatnonzero(np.append(True, np.diff(places) != 1))
    return np.concatenate((places[first], np.diff(np.append(first, len(places))))).tobytes()


def _places(runs: bytes) -> np.ndarray:
    return _ranges(*np.frombuffer(runs, np.int64).reshape(2, -1))


def _runs(places: np.ndarray, page: np.ndarray) -> np.ndarray:
    """Numbers of the runs of adjacent places of a page."""
    return np.cumsum(np.append(True, (np.diff(places) != 1) | (page[1:] != page[:-1]))) if len(places) else places


def _boilerplate(rows: pa.Table, depth: int) -> pa.Table:
    """Of the pages of a group, the blocks to drop."""
    known = rows.filter(pc.is_valid(rows.column("window")))
    more = np.array(known.column("window").to_pylist(), np.int64).view(np.uint64), np.array(known.column("pages").to_pylist(), np.int64)
    pages = rows.filter(pc.is_valid(rows.column("key")))
    found, seen, streams = [], set(), []
    for key, words, runs, sizes, kinds in zip(*(pages.column(c).to_pylist() for c in ("key", "words", "runs", "sizes", "kinds")), strict=True):
        if key not in seen:
            seen.add(key)
            streams.append((key, np.frombuffer(words, np.uint64), _places(runs), sizes, kinds))
    if streams:
        page = np.repeat(np.arange(len(streams)), [len(s[1]) for s in streams])
        n = pages_with(np.concatenate([s[1] for s in streams]), page, more, depth, _runs(np.concatenate([s[2] for s in streams]), page))
        marks = {1: _spread(n >= 2, depth), 2: _spread(n >= _least(pages.column("of_host")[0].as_py()), depth)}
        at = 0
        for key, words, places, sizes, kinds in streams:
            block = np.repeat(np.arange(len(sizes)), sizes)[places]
            share = {k: np.bincount(block, m[at : at + len(words)], len(sizes)) / np.array(sizes) for k, m in marks.items()}
            drop = [bool(k and share[k][i] >= COVERED) for i, k in enumerate(kinds)]
            if any(drop):
                found.append((key, drop))
            at += len(words)
    return pa.table({"key": pa.array([f[0] for f in found], pa.string()), "drop": pa.array([f[1] for f in found], pa.list_(pa.bool_()))})


def extract(pages: DataFrame, depth: int = DEPTH, group_pages: int = GROUP_PAGES, group_bytes: int = GROUP_BYTES) -> DataFrame:
    """page_id, url, text, n_chars of every page."""

    @F.arrow_udf(PARSED)
    def parsed(column: pa.Array) -> pa.Array:
        out = [_candidates(blocks(page), depth) for page in column.to_pylist()]
        columns = list(zip(*out, strict=True)) if out else [[]] * len(_PARSED)
        return pa.StructArray.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _PARSED, strict=True)], fields=list(_PARSED))

    key = F.md5(F.concat(F.coalesce("url", F.lit("")), F.lit("\n"), F.coalesce("html", F.lit(""))))
    host = F.lower(F.coalesce(F.regexp_extract("url", r"(?s)\A.*?://([^/?#]*)", 1), F.lit("")))
    # Parsed once; the streams, and later the texts, are read from this table.
    base = written(pages.select("page_id", "url", host.alias("host"), key.alias("key"), parsed(F.col("html")).alias("p")).select("page_id", "url", "host", "key", "p.*"), "blocks", "zstd")
    bits = int(np.clip(np.ceil(np.log2(BINS * max(base.agg(F.avg("n")).first()[0] or 0, 1))), LEAST_BITS, MOST_BITS))

    @F.arrow_udf(STREAM)
    def used(texts: pa.Array, bins: pa.Array) -> pa.Array:
        return _used(texts, bins, depth, bits)

    @F.arrow_udf("array<bigint>")
    def windows_of(words: pa.Array, runs: pa.Array) -> pa.Array:
        out = []
        for w, r in zip(words.to_pylist(), runs.to_pylist(), strict=True):
            w, p = np.frombuffer(w, np.uint64), _places(r)
            out.append(np.unique(windows(w, depth)[_whole(_runs(p, np.zeros(len(p))), depth)]).view(np.int64).tolist())
        return pa.array(out, pa.list_(pa.int64()))

    of_hosts = base.groupBy("host").agg(F.count_distinct("key").alias("of_host"))
    # Added up by parts of the input first, so that no task gets the bins of a host from all of it.
    binned = base.select("host", "texts", "kinds").mapInArrow(lambda x: _binned(x, depth, bits), _DDL).groupBy("host", "part").applyInArrow(lambda t: _of_part(t, bits), _DDL)
    bins = written(binned.join(of_hosts, "host").groupBy("host").applyInArrow(lambda t: _of_host(t, bits), "host string, of_host bigint, bins binary"), "bins")
    streams = base.join(bins, "host").select("host", "of_host", "key", "kinds", used(F.col("texts"), F.col("bins")).alias("s")).where("s is not null")
    streams = written(streams.select("host", "of_host", "key", "kinds", "s.*"), "streams", "zstd")
    # Hosts of more pages or longer streams than a group has; other hosts are one group each.
    size = F.greatest(F.ceil(F.count("*") / group_pages), F.ceil(F.sum(F.octet_length("words")) / group_bytes))
    large = streams.groupBy("host").agg(size.alias("groups")).where("groups > 1")
    grouped = streams.join(large, "host", "left").withColumn("group", F.pmod(F.xxhash64("key"), F.coalesce("groups", F.lit(1))))
    # Of large hosts, each different page once: the windows that occur in two groups. Counts are combined before the shuffle.
    once = grouped.where("groups > 1").dropDuplicates(["host", "key"])
    apart = once.select("host", "group", F.explode(windows_of(F.col("words"), F.col("runs"))).alias("window")).groupBy("host", "group", "window").agg(F.count("*").alias("n"))
    # The list has a number for each group of the host at most.
    shared = apart.groupBy("host", "window").agg(F.sum("n").alias("pages"), F.collect_list("group").alias("in")).where(F.size("in") > 1)
    columns = {"of_host": "bigint", "key": "string", "words": "binary", "runs": "binary", "sizes": "array<int>", "kinds": "array<int>"}
    known = shared.select("host", F.explode("in").alias("group"), "window", "pages").selectExpr("host", "`group`", *(f"cast(null as {t}) as {c}" for c, t in columns.items()), "window", "pages")
    rows = grouped.selectExpr("host", "`group`", *columns, "cast(null as bigint) as window", "cast(null as bigint) as pages").unionByName(known)
    dropped_blocks = rows.groupBy("host", "group").applyInArrow(lambda t: _boilerplate(t, depth), "key string, drop array<boolean>")
    # Written first: its size then tells how to join it, and it holds only pages that lose a block.
    lost_blocks = written(dropped_blocks, "boilerplate")
    dropped(bins, streams)
    joined = base.select("page_id", "url", "key", "texts", "kinds").join(lost_blocks, "key", "left")
    usable = lambda i: F.get("kinds", i) > 0
    lost = lambda i: F.coalesce(F.get("drop", i), F.lit(False))
    some = lambda keep: F.filter(F.transform("texts", lambda t, i: F.when(keep(i), t)), lambda t: t.isNotNull())
    unique = some(lambda i: usable(i) & ~lost(i))
    kept = F.when(F.size(unique) > 0, unique).otherwise(some(usable))
    return joined.withColumn("kept", kept).select("page_id", "url", F.array_join("kept", "\n\n").alias("text")).withColumn("n_chars", F.char_length("text").cast("long"))
