"""Language-model scores by context-tree weighting over binary-decomposed bytes.

A byte is eight binary decisions; a decision's node is the bits before it. The
context of a byte is the ``DEPTH`` bytes before it, so each node has a tree of contexts
of 0 to ``DEPTH`` bytes. Every context of a node keeps how often 0 and 1 followed (a
Krichevsky-Trofimov estimate) and weighs its own estimate against the product of
those of its longer contexts, half and half a priori. The weights follow from the counts
of the learned texts; a bit's probability is the mixture of the estimates along its
context path, and a text's score the sum of the logs. Contexts that no learned
text holds take no part: the path ends at the longest known one. The model is then fixed:
scoring does not update it.

A-Z are lower-cased, for tokens and bytes alike. A text is preceded by and ends in the byte
0xFF, which UTF-8 does not have, so probabilities over all texts add up to 1 at most.

How it runs, with nothing whole in one place:

1. Documents go to the shared folder in blocks of about ``BLOCK_BYTES`` of text, compressed.
2. Each block sends the byte strings of ``DEPTH`` + 1 that occur in it and its words, with
   how often they do in learned texts (0 for texts only scored). They are summed over blocks.
3. The trees are weighed from the longest contexts up. Byte strings meet by their last
   ``NEAR`` context bytes, so a group holds whole subtrees and at most
   256 ** (``DEPTH`` - ``NEAR`` + 1) rows, however many texts there are. The contexts above
   them meet by their last byte (256 groups of at most 65,536 rows each); the 255 nodes
   without context come to the driver.
4. Each byte string's log probability and each word's count are joined to the blocks that hold
   it, and go back to their block's documents, which are scored whole. A block's strings come sorted, in
   small batches, with its packs among them.

So rows between the stages grow with the number of blocks times the distinct strings of a block; a
string that all texts hold is a row a block, never a row an occurrence.

The base score is that of single words: the sum over a text's words and its end of
log10((c + 0.5) / (N + 0.5 * (V + 1))).

Defined cases: a null text is an empty one (one token, its end); rows without ``doc_id`` and
rows for which ``learn`` is null are scored, not learned from; repeated rows are learned
from and scored each; without learned texts every bit has probability 1/2; words are told apart by
63-bit hashes; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import U64, mix, slices, word_spans, written

#: Bytes of context (3 to 7), and how many of them the deep groups share.
DEPTH, NEAR = 5, 3
BLOCK_BYTES = 64 << 20
#: Bytes of text that are packed into one row of a block.
PACK_BYTES = 1 << 18
MERGE_ROWS = 1 << 19
#: Rows of the longest run that are merged with the others at a time.
RANGE_ROWS = 1 << 17
#: Bytes of words that are hashed at a time (a longer single word is hashed alone).
WORD_BYTES = 1 << 18
#: Rows of whole groups that are weighed at a time.
GROUP_ROWS = 1 << 17
END = 0xFF
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32
LOG2 = float(np.log(2))


# --- estimates -----------------------------------------------------------------------

_SMALL = 4096
_log_half = np.concatenate([[0.0], np.cumsum(np.log(np.arange(_SMALL) + 0.5))])      # log of 0.5 * 1.5 * ... up to n terms
_log_fact = np.concatenate([[0.0], np.cumsum(np.log(np.arange(_SMALL) + 1.0))])


def _log_gamma(x: np.ndarray) -> np.ndarray:
    """Stirling's series, for x above ``_SMALL``."""
    return (x - 0.5) * np.log(x) - x + 0.5 * np.log(2 * np.pi) + 1 / (12 * x) - 1 / (360 * x ** 3)


def _rising_half(n: np.ndarray) -> np.ndarray:
    """log of Gamma(n + 1/2) / Gamma(1/2)."""
    small = n <= _SMALL
    return np.where(small, _log_half[np.where(small, n, 0)], _log_gamma(np.where(small, _SMALL, n) + 0.5) - 0.5 * np.log(np.pi))


def _factorial(n: np.ndarray) -> np.ndarray:
    small = n <= _SMALL
    return np.where(small, _log_fact[np.where(small, n, 0)], _log_gamma(np.where(small, _SMALL, n) + 1.0))


def log_kt(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """log of the Krichevsky-Trofimov probability of any sequence with these counts."""
    return _rising_half(zeros) + _rising_half(ones) - _factorial(zeros + ones)


# --- byte strings --------------------------------------------------------------------
#
# A key holds, from the high byte on, the context from its last byte to its first, then
# the byte that follows. The key of a shorter context leaves out the first bytes.


def shorter(keys: np.ndarray) -> np.ndarray:
    """The keys (or node keys) of one context byte less."""
    return (keys >> 16 << 8) | (keys & 255)


def string_keys(data: np.ndarray, offsets: np.ndarray, depth: int = DEPTH) -> tuple[np.ndarray, np.ndarray]:
    """The key of every byte of every text and of its end, and the first of each text."""
    n = len(offsets) - 1
    out = np.full(len(data) + depth * (n + 1), END, np.uint8)
    taken = np.ones(len(out), bool)
    gaps = offsets + depth * np.arange(n + 1)
    for i in range(depth):
        taken[gaps + i] = False
    out[taken] = _LOWER[data]
    # In place: eight bytes a byte of text, once.
    keys = np.zeros(len(out) - depth, np.int64)
    for back in [*range(1, depth + 1), 0]:
        keys <<= 8
        keys |= out[depth - back:len(out) - back]
    # Of the bytes between two texts only the first is an end.
    taken[gaps[1:]] = True
    return keys[taken[depth:]], np.cumsum(np.diff(offsets) + 1) - np.diff(offsets) - 1


_rng = np.random.default_rng(11)
_BYTE = _rng.integers(1, 2 ** 63, 256, dtype=np.uint64) * U64(2) + U64(1)
_BYTE[ord("A"):ord("Z") + 1] = _BYTE[ord("a"):ord("z") + 1]


def word_keys(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A negative key per word, a hash of its bytes, and per text the index of its first word."""
    starts, ends, first = word_spans(data, offsets)
    if not len(starts):
        return np.zeros(0, np.int64), first
    size = ends - starts
    after = np.cumsum(size)
    power = np.full(int(size.max()), 0x9E3779B97F4A7C15, np.uint64)
    power[0] = 1
    power = np.cumprod(power, dtype=np.uint64)
    total, a = np.empty(len(size), np.uint64), 0
    while a < len(size):
        b = max(a + 1, int(np.searchsorted(after, after[a] - size[a] + WORD_BYTES, "right")))
        before = after[a:b] - size[a:b] - (after[a] - size[a])
        place = np.arange(before[-1] + size[b - 1]) - np.repeat(before, size[a:b])
        total[a:b] = np.add.reduceat(_BYTE[data[np.repeat(starts[a:b], size[a:b]) + place]] * power[place], before)
        a = b
    return (mix(total + size.astype(np.uint64)) | U64(1 << 63)).view(np.int64), first


def summed(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order and the sum of each one's ``n``."""
    order = np.argsort(keys, kind="stable")
    keys, n = keys[order], n[order]
    at = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])[:len(keys)])
    return keys[at], np.add.reduceat(n, at) if len(at) else n


def merged(runs: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """``summed`` over runs of sorted distinct keys, one range of keys after the other."""
    longest = max((k for k, _ in runs), key=len)
    cuts = longest[RANGE_ROWS::RANGE_ROWS]
    at = [np.concatenate([[0], np.searchsorted(k, cuts), [len(k)]]) for k, _ in runs]
    rows, size = sum(len(k) for k, _ in runs), 0
    keys, n = np.empty(rows, np.int64), np.empty(rows, np.int64)
    for i in range(len(cuts) + 1):
        k, m = summed(*(np.concatenate([run[j][a[i]:a[i + 1]] for run, a in zip(runs, at)]) for j in (0, 1)))
        keys[size:size + len(k)], n[size:size + len(k)] = k, m
        size += len(k)
    return keys[:size].copy(), n[:size].copy()


class Counter:
    """Sums by key, merged whenever ``MERGE_ROWS`` rows have come together."""

    def __init__(self):
        self.held, self.rows = [], 0

    def add(self, keys: np.ndarray, counted: bool) -> None:
        """``keys`` are sorted in place."""
        keys.sort()
        at = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])[:len(keys)])
        n = np.diff(np.append(at, len(keys))) if counted else np.zeros(len(at), np.int64)
        self.held.append((keys[at], n))
        self.rows += len(at)
        if self.rows > MERGE_ROWS and len(self.held) > 1:
            self.held = [self.merged()]
            self.rows = 0                  # what is merged already does not count again

    def merged(self) -> tuple[np.ndarray, np.ndarray]:
        if not self.held:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return merged(self.held)


# --- weighing ------------------------------------------------------------------------

class Level:
    """All nodes of contexts of one length.

    ``keys``: sorted distinct keys, ``n``: how often each occurs in learned texts,
    ``longer``: (node keys, log of the product of the weighted probabilities of the
    contexts one byte longer), None for the longest contexts. A node key is the context
    and, in the last byte, a 1 followed by the bits before the decision.

    By bit and key: ``share`` (weight of the own estimate), ``bit`` (estimate of the
    key's bit) and ``seen`` (whether learned texts hold the node)."""

    def __init__(self, keys: np.ndarray, n: np.ndarray, longer: tuple[np.ndarray, np.ndarray] | None):
        self.share, self.bit, self.seen = np.empty((8, len(keys))), np.empty((8, len(keys))), np.empty((8, len(keys)), bool)
        nodes, weighted = [], []
        for k in range(8):
            prefix = keys >> (8 - k)
            new = np.concatenate([[True], prefix[1:] != prefix[:-1]])[:len(keys)]
            at, node = np.flatnonzero(new), np.cumsum(new) - 1
            one = (keys >> (7 - k)) & 1
            both, ones = np.add.reduceat(n, at), np.add.reduceat(n * one, at)
            own = log_kt(both - ones, ones)
            name = (keys[at] >> 8 << 8) | (1 << k) | ((keys[at] & 255) >> (8 - k))
            if longer is None:
                log_w, share = own, np.ones(len(at))
            else:
                place = np.minimum(np.searchsorted(longer[0], name), len(longer[0]) - 1)
                log_w = np.logaddexp(own, np.where(longer[0][place] == name, longer[1][place], 0.0)) - LOG2
                share = np.exp(np.minimum(own - LOG2 - log_w, 0.0))
            self.share[k] = share[node]
            self.bit[k] = (np.where(one == 1, ones[node], (both - ones)[node]) + 0.5) / (both[node] + 1.0)
            self.seen[k] = both[node] > 0
            nodes.append(name)
            weighted.append(log_w)
        self.nodes, self.weighted = np.concatenate(nodes), np.concatenate(weighted)

    def above(self) -> tuple[np.ndarray, np.ndarray]:
        """Node keys of one context byte less, and the sums over their longer contexts."""
        return summed(shorter(self.nodes), self.weighted)


def mixed(level: Level, at: np.ndarray, p: np.ndarray, known: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Mixture of a level's estimates with ``p``, that of the longer contexts, where
    ``known``; and whether the level's nodes are known. ``at``: each column's key in the level."""
    own, share = level.bit[:, at], level.share[:, at]
    return np.where(known, share * own + (1 - share) * p, own), level.seen[:, at]


def deep(keys: np.ndarray, n: np.ndarray, depth: int, near: int) -> tuple[np.ndarray, np.ndarray, Level]:
    """Whole groups of keys weighed from ``depth`` up to ``near`` context bytes: by
    bit and key the mixture and whether it is known, and the last level."""
    level = Level(keys, n, None)
    p, known = level.bit, level.seen
    at = np.arange(len(keys))
    for _ in range(depth - near):
        keys, down = np.unique(shorter(keys), return_inverse=True)
        n = np.bincount(down, n, minlength=len(keys)).astype(np.int64)
        level = Level(keys, n, level.above())
        at = down[at]
        p, known = mixed(level, at, p, known)
    return p, known, level


def _flags(known: np.ndarray) -> np.ndarray:
    return (known * (1 << np.arange(8))[:, None]).sum(axis=0)


def _known(flags: np.ndarray) -> np.ndarray:
    return (flags[None, :] >> np.arange(8)[:, None]) & 1 == 1


def _lists(p: np.ndarray) -> pa.Array:
    """(8, rows) as one list of eight a row."""
    return pa.ListArray.from_arrays(pa.array(np.arange(0, 8 * p.shape[1] + 1, 8, dtype=np.int32)), pa.array(np.ascontiguousarray(p.T).ravel()))


def _table(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, 8).T


_DEEP = "key long, known int, p array<double>"


def _weigh_deep(depth: int, near: int):
    def rows(keys: np.ndarray, n: np.ndarray) -> Iterator[pa.RecordBatch]:
        p, known, level = deep(keys, n, depth, near)
        yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(_flags(known).astype(np.int32)), _lists(p)], names=["key", "known", "p"])
        # The last level's nodes: known is -1, p the one number.
        name, total = level.above()
        one = pa.ListArray.from_arrays(pa.array(np.arange(len(name) + 1, dtype=np.int32)), pa.array(total))
        yield pa.RecordBatch.from_arrays([pa.array(name), pa.array(np.full(len(name), -1, np.int32)), one], names=["key", "known", "p"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shift, keys, n = 8 * (depth - near + 1), np.zeros(0, np.int64), np.zeros(0, np.int64)
        for batch in batches:
            keys = np.concatenate([keys, batch.column("key").to_numpy()])
            n = np.concatenate([n, batch.column("n").to_numpy()])
            if len(keys) >= GROUP_ROWS:
                whole = int(np.searchsorted(keys >> shift, keys[-1] >> shift))      # the last group may go on
                if whole:
                    yield from rows(keys[:whole], n[:whole])
                    keys, n = keys[whole:], n[whole:]
        if len(keys):
            yield from rows(keys, n)

    return run


_NEAR = "key long, known int, a array<double>, b array<double>, c array<double>"


def _weigh_near(near: int):
    """Levels ``near`` - 1 to 1 of the contexts that end in one byte: the mixture is
    a + b * p with the longer contexts' p, or c where they are not known."""
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        keys, n = left.column("key").to_numpy(), left.column("n").to_numpy()
        order = np.argsort(keys)
        keys, n = keys[order], n[order]
        names, total = summed(right.column("key").to_numpy(), right.column("total").to_numpy())
        level = Level(keys, n, (names, total))
        full, at = keys, np.arange(len(keys))
        a, b = mixed(level, at, np.zeros((8, len(keys))), np.ones((8, len(keys)), bool))[0], 1 - level.share
        c, known = level.bit, level.seen
        for _ in range(near - 2):
            keys, down = np.unique(shorter(keys), return_inverse=True)
            n = np.bincount(down, n, minlength=len(keys)).astype(np.int64)
            level = Level(keys, n, level.above())
            at = down[at]
            a = mixed(level, at, a, np.ones_like(known))[0]
            b = b * (1 - level.share[:, at])
            c, known = mixed(level, at, c, known)
        names, total = level.above()
        empty = pa.ListArray.from_arrays(pa.array(np.zeros(len(names) + 1, np.int32)), pa.array(np.zeros(0)))
        one = pa.ListArray.from_arrays(pa.array(np.arange(len(names) + 1, dtype=np.int32)), pa.array(total))
        return pa.concat_tables([
            pa.table({"key": pa.array(full), "known": pa.array(_flags(known).astype(np.int32)), "a": _lists(a), "b": _lists(b), "c": _lists(c)}),
            pa.table({"key": pa.array(names), "known": pa.array(np.full(len(names), -1, np.int32)), "a": one, "b": empty, "c": empty})])

    return run


def log_probabilities(counts: DataFrame, depth: int = DEPTH, near: int = NEAR) -> DataFrame:
    """key and value: log10 of the probability of the key's byte after its context.
    ``counts`` (key, n): every byte string to be scored, and how often learned texts hold it."""
    group = F.shiftright("key", 8 * (depth - near + 1))
    weighed = written(counts.repartition(group).sortWithinPartitions("key").mapInArrow(_weigh_deep(depth, near), _DEEP), "ct-deep")
    # Keys and nodes of one context byte less.
    upper = (F.shiftright("key", 8 * (depth - near + 2)).cast("long") * 256 + F.col("key").bitwiseAND(F.lit(255)))
    rows = counts.groupBy(upper.alias("key")).agg(F.sum("n").alias("n")).withColumn("last", F.shiftright("key", 8 * (near - 1)))
    nodes = (weighed.where("known = -1").groupBy("key").agg(F.sum(F.col("p")[0]).alias("total"))
             .withColumn("last", F.shiftright("key", 8 * (near - 1))))
    above = written(rows.groupBy("last").cogroup(nodes.groupBy("last")).applyInArrow(_weigh_near(near), _NEAR), "ct-near")
    # Without context: 255 nodes and 256 bytes at most.
    byte = F.col("key").bitwiseAND(F.lit(255)).alias("key")
    single = counts.groupBy(byte).agg(F.sum("n").alias("n")).orderBy("key").collect()
    total = above.where("known = -1").groupBy(byte).agg(F.sum(F.col("a")[0]).alias("total")).orderBy("key").collect()
    if not single:
        return counts.select("key", F.lit(0.0).alias("value"))
    root = Level(np.array([r["key"] for r in single], np.int64), np.array([r["n"] for r in single], np.int64),
                 (np.array([r["key"] for r in total], np.int64), np.array([r["total"] for r in total])))
    place = np.zeros(256, np.int64)
    place[[r["key"] for r in single]] = np.arange(len(single))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            keys, p = batch.column("key").to_numpy(), _table(batch.column("p"))
            a, b, c = (_table(batch.column(x)) for x in "abc")
            p = np.where(_known(batch.column("known").to_numpy()), a + b * p, c)
            p, known = mixed(root, place[keys & 255], p, _known(batch.column("near_known").to_numpy()))
            value = np.log10(np.where(known, p, 0.5)).sum(axis=0)
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(value)], names=["key", "value"])

    above = above.where("known >= 0").select(F.col("key").alias("upper"), F.col("known").alias("near_known"), "a", "b", "c")
    return weighed.where("known >= 0").withColumn("upper", upper).join(above, "upper").drop("upper").mapInArrow(run, "key long, value double")


# --- documents -----------------------------------------------------------------------

def _packed(rows: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, rows.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_batch(rows)
    return sink.getvalue().to_pybytes()


def _unpacked(packs: pa.Array) -> Iterator[pa.RecordBatch]:
    for pack in packs:
        yield from pa.ipc.open_stream(pack.as_buffer())


def _dealt(depth: int):
    """Compressed packs of rows, with the number of their block (so many bytes of one task's rows) and a
    byte string of each: its place among its block's strings."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, done = TaskContext.get().partitionId() << 32, 0
        for batch in batches:
            for a, b, data, _ in slices(batch.column("text"), PACK_BYTES):
                block = task + done // BLOCK_BYTES
                done += len(data) + 64 * (b - a)
                middle = data[len(data) // 2:][:depth + 1]
                place = string_keys(middle, np.array([0, len(middle)]), depth)[0][len(middle) - 1]
                yield pa.RecordBatch.from_arrays([pa.array([block]), pa.array([place]), pa.array([_packed(batch.slice(a, b - a))], pa.binary())], names=["block", "key", "pack"])

    return run


def in_blocks(docs: DataFrame, learn: Column, depth: int) -> tuple[DataFrame, int]:
    """(block, key, pack) of all rows, in the shared folder, and how many are learned from."""
    picked = docs.select("doc_id", "text", F.coalesce(learn, F.lit(False)).alias("learn"))
    size, learned = picked.agg(F.sum(F.octet_length("text") + 64), F.count_if("learn")).first()
    # A task writes about one block.
    packs = picked.coalesce(max(1, round((size or 0) / BLOCK_BYTES))).mapInArrow(_dealt(depth), "block long, key long, pack binary")
    return written(packs, "ct-blocks"), learned


def _strings(depth: int):
    """Distinct byte strings and words of each run of rows of one block."""
    def rows(block: int, counter: Counter) -> Iterator[pa.RecordBatch]:
        keys, n = counter.merged()
        for a in range(0, len(keys), 1 << 16):
            part = keys[a:a + (1 << 16)]
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(part), block)), pa.array(part), pa.array(n[a:a + len(part)])], names=["block", "key", "n"])
        pa.default_memory_pool().release_unused()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, counter = None, Counter()
        for batch in batches:
            for block, rows_of in zip(batch.column("block").to_pylist(), _unpacked(batch.column("pack"))):
                if last is not None and block != last:
                    yield from rows(last, counter)
                    counter = Counter()
                last, learn = block, rows_of.column("learn").to_numpy(zero_copy_only=False)
                for a, b, data, offsets in slices(rows_of.column("text")):
                    keys, first = string_keys(data, offsets, depth)
                    words, of = word_keys(data, offsets)
                    for k, size in ((keys, np.diff(np.append(first, len(keys)))), (words, np.diff(of))):
                        learned = np.repeat(learn[a:b], size)
                        counter.add(k[learned], True)
                        counter.add(k[~learned], False)
        if last is not None:
            yield from rows(last, counter)

    return run


def _score(depth: int, total: int, distinct: int, ends: int):
    """Whole blocks, one after the other: their strings and words by key, and their packs among them."""
    scale = np.log10(total + 0.5 * (distinct + 1))

    def scored(names: list[np.ndarray], values: list[np.ndarray], packs: list[pa.Array]) -> Iterator[pa.RecordBatch]:
        # The lists are emptied: a block's strings are held once. A block that two tasks read sends its strings
        # twice, with the same value: the first is found. Every string and word of the block is among them.
        names[:] = [np.concatenate(names)]
        values[:] = [np.concatenate(values)]
        (name,), (value,) = names, values
        for pack in packs:
            for rows in _unpacked(pack):
                for a, b, data, offsets in slices(rows.column("text")):
                    keys, first = string_keys(data, offsets, depth)
                    score = np.add.reduceat(value[np.searchsorted(name, keys)], first)
                    words, of = word_keys(data, offsets)
                    text = np.repeat(np.arange(b - a), np.diff(of))
                    c = value[np.searchsorted(name, words)]
                    known = np.bincount(text[c > 0], minlength=b - a) + (ends > 0)
                    base = np.bincount(text, np.log10(c + 0.5) - scale, minlength=b - a) + (np.log10(ends + 0.5) - scale)
                    yield pa.RecordBatch.from_arrays(
                        [rows.column("doc_id")[a:b], pa.array(np.diff(of) + 1), pa.array(known.astype(np.int64)), pa.array(base), pa.array(score)],
                        names=["doc_id", "n_tokens", "n_known", "base_score", "score"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, names, values, packs = None, [], [], []
        for batch in batches:
            block = batch.column("block").to_numpy()
            cuts = np.concatenate([[0], np.flatnonzero(block[1:] != block[:-1]) + 1, [len(block)]])
            for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
                if a == b:
                    continue
                if last is not None and block[a] != last:
                    yield from scored(names, values, packs)
                    names, values, packs = [], [], []
                last, part = block[a], batch.slice(a, b - a)
                string = part.column("pack").is_null().to_numpy(zero_copy_only=False)
                names.append(part.column("key").to_numpy()[string])
                values.append(part.column("value").to_numpy(zero_copy_only=False)[string])
                if not string.all():
                    packs.append(part.column("pack").drop_null())
        if last is not None:
            yield from scored(names, values, packs)

    return run


def score_documents(docs: DataFrame, learn: Column, depth: int = DEPTH, near: int = NEAR) -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score and score of every row of
    ``docs`` (doc_id, text); the model learns from the rows for which ``learn`` holds."""
    blocks, ends = in_blocks(docs, learn, depth)
    held = written(blocks.select("block", "pack").mapInArrow(_strings(depth), "block long, key long, n long"), "ct-strings")
    counts = written(held.groupBy("key").agg(F.sum("n").alias("n")), "ct-counts")
    words, strings = counts.where("key < 0"), counts.where("key >= 0")
    row = words.agg(F.sum("n"), F.count(F.when(F.col("n") > 0, 1))).first()
    total, distinct = (row[0] or 0) + ends, row[1] + (ends > 0)
    values = words.select("key", F.col("n").cast("double").alias("value")).unionByName(log_probabilities(strings, depth, near))
    sent = held.select("block", "key").join(values, "key").select("block", "key", "value")
    kind = dict(docs.dtypes)["doc_id"]
    # Packs lie among the strings, so that a batch of rows is small: a group of a cogroup goes to Python in one buffer.
    rows = sent.withColumn("pack", F.lit(None).cast("binary")).unionByName(blocks.withColumn("value", F.lit(None).cast("double")))
    scored = (rows.repartition("block").sortWithinPartitions("block", "key")
              .mapInArrow(_score(depth, total, distinct, ends), f"doc_id {kind}, n_tokens long, n_known long, base_score double, score double"))
    return scored.select("doc_id", "n_tokens", "n_known", F.lit(total).cast("long").alias("train_tokens"), "base_score", "score")
