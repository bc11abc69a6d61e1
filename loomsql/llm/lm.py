"""LM scoring with an n-gram model over all training text, kept as Elias-Fano tries dealt out over shards.

1. Documents are packed into blocks of about BLOCK_TOKENS tokens; a block keeps its distinct words (as 64-bit hashes, of
   which 48 bits stay once words are counted) and its texts as numbers of them.
2. Words are counted: each block sends its distinct words to shards, by their hashes, and gets their counts in all
   training documents back.
3. Then for each order from 2 to ORDER: a block sends its distinct n-grams, grouped by context, to a shard that a hash of
   the context chooses. With a context goes its count, with a word its count in the block and the probability (in steps)
   that the shorter context gives it. The shard adds the counts up and builds a trie of quantised smoothed probabilities
   in memory-mapped levels: contexts, monotone pointers, successors. Each block's n-grams are looked up by successor
   search in their context's range; the block keeps what comes back.
4. Blocks score their documents.

A context that was seen more than SALT_TOKENS times is dealt over as many shards as that takes, by a hash of the next word:
no shard gets more of it, however frequent it is. Nothing is broadcast but four numbers; the model has no pruning and no
cap. Messages are rows of a block and a shard, so their number grows with the product of both; see the README for the
sizes at which larger blocks and shards are needed.

The probability of a word w after a context h that was seen c(h) times: (1 - m) * c(h, w) / c(h) + m * p(w after h without
its first word), with m = A * c(h) ** -E by LEFT, or 1 where c(h) is 0; of no context, (c(w) + 0.1) / (N + 0.1 * (V + 1)). A
start mark stands before a text. As all factors depend on counts that are exact, m needs no count of a context's different
successors, which no shard of a dealt-out context would have.

Defined results: a null text is an empty one (one end token); texts of any length are scored whole; a null id is an empty
id for the fold; repeated rows are counted each; without training documents N = V = 0 and all words are unknown; an empty
table gives no rows; extra columns play no part.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import bytesops as bo
from .eliasfano import Trie
from .scratch import dropped, written
from .subword import _ranges

ORDER, FOLDS = 3, 10
#: By order, A and E of the share of a context's probability that is left to the shorter context.
LEFT = {2: (0.97, 0.1), 3: (0.85, 0.2)}
BLOCK_TOKENS = 1_000_000
#: Tokens per shard, about, and occurrences of a context in one shard.
SHARD_TOKENS, SALT_TOKENS = 500_000, 250_000
#: Keys of the end token and of the context before a text: no word and no context has them but by chance.
END, START = np.uint64(0x1F3D5B79A2C4E687), np.uint64(0x3C6EF372FE94F82B)
#: Steps of a code to a factor of ten in a probability. Code 0 is no code, code 1 a probability of one.
STEPS = 2000
#: By order (3 and more alike), bytes that tell the words after one context apart: longer contexts have fewer of them.
SECOND = {2: 4, 3: 3}
#: Steps to a factor of e in the probability that goes with a word, which is one byte.
LOW_STEPS = 8
#: Bytes of messages that a block hands over at once, about.
BATCH_BYTES = 1 << 20

BLOCK = pa.schema([("block", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("held_out", pa.list_(pa.bool_())), ("sizes", pa.binary()), ("words", pa.binary()), ("tokens", pa.binary()), ("n_train", pa.int64()), ("n_docs", pa.int64()), ("counts", pa.list_(pa.binary())), ("codes", pa.list_(pa.binary()))])
MESSAGE = pa.schema([("shard", pa.int64()), ("block", pa.int64()), ("keys", pa.binary()), ("sizes", pa.binary()), ("totals", pa.binary()), ("seconds", pa.binary()), ("low", pa.binary()), ("counts", pa.binary())])
ANSWER = pa.schema([("shard", pa.int64()), ("block", pa.int64()), ("counts", pa.binary()), ("codes", pa.binary()), ("types", pa.int64())])
SCORES = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("train_tokens", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())])


def ddl(schema: pa.Schema) -> str:
    names = {pa.int64(): "bigint", pa.binary(): "binary", pa.float64(): "double", pa.bool_(): "boolean", pa.list_(pa.int64()): "array<bigint>", pa.list_(pa.bool_()): "array<boolean>", pa.list_(pa.binary()): "array<binary>"}
    return ", ".join(f"{f.name} {names[f.type]}" for f in schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [[]] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(columns, schema, strict=True)], schema=schema)


def _planes(numbers: np.ndarray, k: int) -> bytes:
    """The low k bytes of each number: all first bytes, then all second ones, ..."""
    return b"".join((numbers >> numbers.dtype.type(8 * i)).astype(np.uint8).tobytes() for i in range(k))


def _numbers(data: bytes, k: int) -> np.ndarray:
    planes, out = np.frombuffer(data, np.uint8).reshape(k, -1), np.zeros(len(data) // k, np.uint64)
    for i, plane in enumerate(planes):
        if i < 2 or plane.any():
            out |= plane.astype(np.uint64) << np.uint64(8 * i)
    return out


def _packed(data: bytes) -> bytes:
    """Compressed, after the length."""
    return len(data).to_bytes(8, "little") + pa.compress(data, "zstd", asbytes=True)


def _unpacked(data: bytes) -> bytes:
    return pa.decompress(memoryview(data)[8:], int.from_bytes(data[:8], "little"), "zstd", asbytes=True)


def _shrunk(numbers: np.ndarray, k: int = 4) -> bytes:
    """Numbers of k bytes, mostly small, byte by byte and compressed."""
    return _packed(_planes(numbers, k))


def _grown(data: bytes, k: int = 4) -> np.ndarray:
    return _numbers(_unpacked(data), k).view(np.int64)


def _index(n: int) -> type:
    """The kind of number that places among n are kept as."""
    return np.int32 if n < 1 << 31 else np.int64


def distinct(numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct numbers, ascending, and the place of each number among them. Where a number and its place fit into 64
    bits, these are sorted as one."""
    n, kind = len(numbers), numbers.dtype
    least = numbers.min() if n else 0
    bits = n.bit_length()
    if not n or int(numbers.max()) - int(least) >= 1 << (64 - bits):
        return np.unique(numbers, return_inverse=True)
    both = (numbers - least).view(np.uint64)
    del numbers  # a caller that keeps no name for them has their memory back
    both <<= np.uint64(bits)
    both |= np.arange(n, dtype=np.uint64)
    both.sort()
    place = (both & np.uint64((1 << bits) - 1)).view(np.int64)
    both >>= np.uint64(bits)
    new = np.empty(n, bool)
    new[0], new[1:] = True, both[1:] != both[:-1]
    both = both[new]
    of = np.empty(n, _index(n))
    of[place] = np.cumsum(new, dtype=of.dtype)
    of -= 1
    return both.view(kind) + least, of


def tokens_of(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of all texts of a slice, an end token after each text, and the tokens of each text."""
    data, offsets = bo.separated(array)
    data = bo.lowered(data)
    starts, ends = bo.spans(data, bo.NOT_SPACE)
    bounds = bo.rows_of(starts, offsets)
    keys = bo.hashed(bo.prefix_sums(data), starts, ends)
    return np.insert(keys, bounds[1:], END), np.diff(bounds) + 1


def held_out(doc_ids: list) -> list[bool]:
    return [zlib.crc32(b"" if i is None else str(i).encode()) % FOLDS == 0 for i in doc_ids]


def left(order: int, seen: np.ndarray) -> np.ndarray:
    """The share of a context's probability that goes by the shorter context."""
    a, e = LEFT[min(order, max(LEFT))]
    return np.where(seen > 0, a * np.maximum(seen, 1).astype(float) ** -e, 1.0)


def coded(p: np.ndarray) -> np.ndarray:
    return (1 + np.clip(np.rint(-np.log10(p) * STEPS), 0, 65534)).astype(np.uint16)


def decoded(codes: np.ndarray) -> np.ndarray:
    return _DECODED[codes]


def _low_coded(p: np.ndarray) -> np.ndarray:
    return np.clip(np.rint(-np.log(p) * LOW_STEPS), 0, 255).astype(np.uint8)


def _low_decoded(codes: np.ndarray) -> np.ndarray:
    return _LOW_DECODED[codes]


#: The probability of each code.
_DECODED, _LOW_DECODED = 10 ** (-(np.arange(65536.0) - 1) / STEPS), np.exp(-np.arange(256.0) / LOW_STEPS)


def _blocks(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext

    part, k = TaskContext.get().partitionId(), 0
    ids, keys, sizes, total = [], [], [], 0

    def pack():
        words, tokens = distinct(np.concatenate(keys))
        n, held = np.concatenate(sizes), held_out(ids)
        # Frequent words get small numbers: they compress well.
        order = np.argsort(-np.bincount(tokens), kind="stable")
        number = np.empty(len(order), np.uint32)
        number[order] = np.arange(len(order), dtype=np.uint32)
        train = ~np.array(held)
        return _batch([((part << 24) + k, ids, held, n.astype(np.int64).tobytes(), _planes(words[order], 8), _shrunk(number[tokens]), int(n[train].sum()), int(train.sum()), [], [])], BLOCK)

    for batch in batches:
        array = bo.texts(batch.column(1))
        for row, some in bo.slices(array):
            found, n = tokens_of(some)
            ids += batch.column(0).slice(row, len(some)).to_pylist()
            keys.append(found)
            sizes.append(n)
            total += len(found)
            if total >= most:
                yield pack()
                ids, keys, sizes, total, k = [], [], [], 0, k + 1
    if ids:
        yield pack()
    bo.forget()


class Block:
    """A block's distinct n-grams, at the last order whose counts have come back or the one after it."""

    def __init__(self, row: dict, train_tokens: int, types: int, train_docs: int, salt_tokens: int = SALT_TOKENS):
        self.number, self.order, self.train_docs, self.salt_tokens = row["block"], 1, train_docs, salt_tokens
        tokens = _grown(row["tokens"])
        self.tokens = tokens.astype(_index(len(tokens)))
        self.words = _numbers(row["words"], 6) << np.uint64(16) if row["counts"] else _numbers(row["words"], 8)
        self.sizes = np.frombuffer(row["sizes"], np.int64)
        self.train = np.repeat(~np.array(row["held_out"], bool), self.sizes)
        self.first = np.cumsum(self.sizes) - self.sizes
        #: The n-gram at each place, and of the distinct ones their number, contexts and last words.
        self.of, self.n = self.tokens, len(self.words)
        self.context = self.word = self.context_hashes = self.seen = self.low = None
        self.counts = self.p = None
        if row["counts"]:
            self.counts = _grown(row["counts"][0], 6)
            self.p = (self.counts + 0.1) / (train_tokens + 0.1 * (types + 1))
            self.known = self.counts > 0
            for k in range(len(row["codes"])):
                self.longer()
                self.learn(_grown(row["counts"][k + 1], 6) if k + 1 < len(row["counts"]) else None, _grown(row["codes"][k], 2))

    def longer(self) -> None:
        """On to the next order. What only the last one needed goes first: a block's memory is a task's."""
        hashes, shorter, p = self.hashes(), self.of, self.p
        self.seen = np.append(self.counts, self.train_docs)
        self.context = self.word = self.low = self.counts = self.p = None
        bits = len(self.words).bit_length()
        grams, self.of = distinct(self._joined(bits))
        self.context, self.word = (grams >> bits).astype(_index(len(hashes) + 1)), (grams & ((1 << bits) - 1)).astype(self.tokens.dtype)
        self.n, self.order, self.context_hashes = len(grams), self.order + 1, np.append(hashes, START)
        del grams, hashes
        of_shorter = np.empty(self.n, shorter.dtype)
        of_shorter[self.of] = shorter
        self.low = p[of_shorter]

    def _joined(self, bits: int) -> np.ndarray:
        """At each place the n-gram before it, or the start's number, and the word there."""
        out = np.empty(len(self.of), np.int64)
        out[1:] = self.of[:-1]
        out[self.first] = self.n
        out <<= bits
        out |= self.tokens
        return out

    def hashes(self) -> np.ndarray:
        """Of the distinct n-grams."""
        if self.order == 1:
            return self.words
        with np.errstate(over="ignore"):
            out = self.context_hashes[self.context]
            out *= np.uint64(0x9E3779B97F4A7C15)
            out += self.words[self.word]
            out += np.uint64(1)
        return bo.mix(out)

    def learn(self, counts: np.ndarray | None, codes: np.ndarray) -> None:
        """The counts of the distinct n-grams, and the codes of their probabilities; what has none goes by the shorter."""
        self.counts = counts
        self.p, none = decoded(codes), np.flatnonzero(codes == 0)
        self.p[none] = left(self.order, self.seen[self.context[none]]) * self.low[none]

    def laid_out(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The order in which n-grams are sent; of each group its key, size and context. Keys ascend, and their first bits
        choose the shard."""
        if self.order == 1:
            keys = bo.mix(self.words)
            order = np.argsort(keys)
            return order, keys[order], np.ones(len(order), np.int64), order
        new = np.append(True, self.context[1:] != self.context[:-1])
        order, salt, hot = None, None, np.flatnonzero((self.seen >= self.salt_tokens)[self.context])
        if len(hot):
            # Places change within a context only.
            order, salt = np.arange(self.n, dtype=_index(self.n)), np.zeros(self.n, np.uint32)
            salt[hot] = bo.mix(self.words[self.word[hot]]) % (1 + self.seen[self.context[hot]] // self.salt_tokens).astype(np.uint64)
            order[hot] = hot[np.lexsort((salt[hot], self.context[hot]))]
            salt = salt[order]
            new[1:] |= salt[1:] != salt[:-1]
        at = np.flatnonzero(new)
        del new, hot
        context = self.context[at]
        with np.errstate(over="ignore"):
            keys = self.context_hashes[context]
            keys *= np.uint64(31)
            if salt is not None:
                keys += salt[at]
            keys = bo.mix(keys)
        by, sizes = np.argsort(keys), np.diff(np.append(at, self.n))
        keys, sizes, context = keys[by], sizes[by], context[by]
        places = _ranges(at[by], sizes).astype(_index(self.n))
        return places if order is None else order[places], keys, sizes, context

    def messages(self, shards: int) -> Iterator[tuple]:
        order, keys, sizes, context = self.laid_out()
        counts = np.bincount(self.of[self.train], minlength=self.n).astype(_index(len(self.of)))
        bounds = np.searchsorted(_shard(keys, shards), np.arange(shards + 1))
        ends = np.concatenate(([0], np.cumsum(sizes)))
        for s in np.flatnonzero(np.diff(bounds)).tolist():
            a, b = bounds[s : s + 2]
            grams = order[ends[a] : ends[b]]
            if self.order == 1:
                yield s, self.number, _planes(np.diff(keys[a:b], prepend=np.uint64(0)), 8), None, None, None, None, _shrunk(counts[grams])
                continue
            short = keys[a:b] >> np.uint64(16)
            yield s, self.number, _planes(np.diff(short, prepend=np.uint64(0)), 6), _shrunk(sizes[a:b]), _shrunk(self.seen[context[a:b]], 6), _planes(_second(self.words[self.word[grams]], self.order), SECOND[min(self.order, 3)]), _packed(_low_coded(self.low[grams]).tobytes()), _shrunk(counts[grams])


def _shard(keys: np.ndarray, shards: int) -> np.ndarray:
    return (((keys >> np.uint64(32)) * np.uint64(shards)) >> np.uint64(32)).astype(np.int64)


def _second(words: np.ndarray, order: int) -> np.ndarray:
    """What tells the words after one context apart."""
    return words >> np.uint64(64 - 8 * SECOND[min(order, 3)])


def _sent(batches: Iterator[pa.RecordBatch], numbers: tuple, shards: int) -> Iterator[pa.RecordBatch]:
    """A block's messages of the order after those that it has the counts of."""
    for batch in batches:
        for k in range(batch.num_rows):  # one block at a time
            block = Block(batch.slice(k, 1).to_pylist()[0], *numbers)
            if block.counts is not None:
                block.longer()
            out, total = [], 0
            for message in block.messages(shards):
                out.append(message)
                total += sum(len(x) for x in message[2:] if x is not None)
                if total >= BATCH_BYTES:
                    yield _batch(out, MESSAGE)
                    out, total = [], 0
            if out:
                yield _batch(out, MESSAGE)


def _counted(table: pa.Table) -> pa.Table:
    """All that one shard was sent of words: their counts."""
    keys = [np.cumsum(_numbers(x, 8)) for x in table.column("keys").to_pylist()]
    words, of = distinct(np.concatenate(keys))
    total = np.bincount(of, np.concatenate([_grown(x) for x in table.column("counts").to_pylist()]), len(words)).astype(np.int64)
    counts = [_shrunk(x, 6) for x in np.split(total[of], np.cumsum([len(k) for k in keys])[:-1])]
    return pa.table([table.column("shard"), table.column("block"), counts, pa.nulls(len(counts), pa.binary()), [int((total > 0).sum())] + [0] * (len(counts) - 1)], schema=ANSWER)


def _answered(table: pa.Table, order: int, last: bool) -> pa.Table:
    """All that one shard was sent of n-grams: counts added up, the trie built, and asked for each block's n-grams."""
    col = {n: table.column(n).to_pylist() for n in MESSAGE.names}
    keys, sizes = [np.cumsum(_numbers(x, 6)) for x in col["keys"]], [_grown(x) for x in col["sizes"]]
    lengths = [int(z.sum()) for z in sizes]
    contexts, of_group = distinct(np.concatenate(keys))
    seen = np.empty(len(contexts), np.int64)
    seen[of_group] = np.concatenate([_grown(x, 6) for x in col["totals"]])
    # Distinct n-grams as (context's number, second word), ascending: in few bits, so that distinct() sorts them as one.
    bits = 8 * SECOND[min(order, 3)]
    grams = np.repeat(of_group.astype(np.uint64) << np.uint64(bits), np.concatenate(sizes))
    grams |= np.concatenate([_numbers(x, SECOND[min(order, 3)]) for x in col.pop("seconds")])
    del keys, sizes, of_group
    grams, of = distinct(grams)
    n = np.bincount(of, np.concatenate([_grown(x) for x in col["counts"]]), len(grams))
    low_of = np.empty(len(grams), np.uint8)
    low_of[of] = np.frombuffer(b"".join(_unpacked(x) for x in col.pop("low")), np.uint8)
    context, second = (grams >> np.uint64(bits)).astype(np.int64), (grams & np.uint64((1 << bits) - 1)).astype(np.uint32)
    some = n > 0
    c, m = seen[context[some]], left(order, seen)[context[some]]
    p = (1 - m) * n[some] / np.maximum(c, 1) + m * _low_decoded(low_of[some])
    trie = Trie.build(contexts[context[some]], second[some], coded(np.minimum(p, 1.0)), 1 << 48)
    codes = trie.lookup(contexts, np.bincount(context, minlength=len(contexts)), second)
    at = np.cumsum(lengths)[:-1]
    counts = pa.nulls(len(lengths), pa.binary()) if last else [_shrunk(x, 6) for x in np.split(n.astype(np.int64)[of], at)]
    return pa.table([col["shard"], col["block"], counts, [_shrunk(x, 2) for x in np.split(codes[of], at)], [0] * len(lengths)], schema=ANSWER)


def _returned(block: Block, answers: pa.Table) -> tuple[np.ndarray | None, np.ndarray | None]:
    """Counts and codes of a block's distinct n-grams, from the shards' answers."""
    answers, order, out = answers.sort_by("shard"), block.laid_out()[0], []
    for name, size, kind in (("counts", 6, np.int64), ("codes", 2, np.uint16)):
        parts, place = [x for x in answers.column(name) if x.is_valid], 0
        out.append(np.empty(len(order), kind) if parts else None)
        for x in parts:  # one shard's at a time
            part = _grown(x.as_py(), size)
            out[-1][order[place : place + len(part)]] = part
            place += len(part)
    return tuple(out)


def _merged(blocks: pa.Table, answers: pa.Table, numbers: tuple) -> pa.Table:
    """The block with the counts and codes that have come back."""
    rows = []
    for row in blocks.to_pylist():
        block = Block(row, *numbers)
        if row["counts"]:
            block.longer()
        counts, codes = _returned(block, answers)
        row["counts"].append(_shrunk(counts, 6))
        row["codes"] += [] if codes is None else [_shrunk(codes, 2)]
        if block.order == 1:
            row["words"] = _planes(block.words >> np.uint64(16), 6)
        rows.append(tuple(row[n] for n in BLOCK.names))
    return pa.Table.from_batches([_batch(rows, BLOCK)])


def _scored(blocks: pa.Table, answers: pa.Table | None, numbers: tuple) -> pa.Table:
    out = [SCORES.empty_table()]
    for row in blocks.to_pylist():
        block = Block(row, *numbers)
        add = lambda x: np.add.reduceat(x, block.first)  # noqa: E731, B023
        known = add(block.known[block.tokens].astype(np.int64))
        base = score = add(np.log10((_grown(row["counts"][0], 6) + 0.1) / (numbers[0] + 0.1 * (numbers[1] + 1)))[block.tokens])
        if answers is not None:
            block.longer()
            block.learn(*_returned(block, answers))
            score = add(np.log10(block.p)[block.of])
        out.append(pa.table([row["doc_ids"], row["held_out"], block.sizes, known, np.full(len(block.sizes), numbers[0]), base, score], schema=SCORES))
    return pa.concat_tables(out)


def score_lm(docs: DataFrame, order: int = ORDER, block_tokens: int = BLOCK_TOKENS, shard_tokens: int = SHARD_TOKENS, salt_tokens: int = SALT_TOKENS) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every document."""
    blocks = written(docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(lambda x: _blocks(x, block_tokens), ddl(BLOCK)), "blocks")
    total = blocks.agg(F.sum("n_train").alias("n"), F.sum("n_docs").alias("docs")).first()
    tokens, train_docs = total["n"] or 0, total["docs"] or 0
    shards, numbers = max(1, -(-tokens // shard_tokens)), (tokens, 0, train_docs, salt_tokens)
    for k in range(1, order + 1):
        answers = written(blocks.mapInArrow(_sender(numbers, shards), ddl(MESSAGE)).groupBy("shard").applyInArrow(_answerer(k, k == order), ddl(ANSWER)), "answers")
        if k == 1:
            numbers = (tokens, answers.agg(F.sum("types")).first()[0] or 0, train_docs, salt_tokens)
        both = blocks.groupBy("block").cogroup(answers.groupBy("block"))
        if k < order:
            merged = written(both.applyInArrow(_merger(numbers), ddl(BLOCK)), "blocks")
            dropped(blocks, answers)
            blocks = merged
    return both.applyInArrow(_scorer(numbers, order), ddl(SCORES))


# What runs on executors; each holds what it needs of the driver's values.


def _sender(numbers: tuple, shards: int):
    return lambda batches: _sent(batches, numbers, shards)


def _answerer(order: int, last: bool):
    return _counted if order == 1 else lambda table: _answered(table, order, last)


def _merger(numbers: tuple):
    return lambda blocks, answers: _merged(blocks, answers, numbers)


def _scorer(numbers: tuple, order: int):
    if order == 1:
        return lambda blocks, answers: _scored(_merged(blocks, answers, numbers), None, numbers)
    return lambda blocks, answers: _scored(blocks, answers, numbers)
