"""MinHash near-duplicates with sequential Bayesian verification.

1. One pass over the texts gives every document the hashes of its distinct word
   shingles, a 128-bit key of that set, and a MinHash signature. Documents of
   equal sets form a class; classes are numbered, and only one number a class goes on.
2. Signatures are cut into bands; equal bands make buckets. Every member of a
   bucket is paired with the bucket's smallest number, never with all others.
3. Pairs are compared signature batch by batch: as soon as the posterior
   probability that the similarity reaches the threshold is below ``MISS``,
   the pair is dropped. Survivors are verified on their full shingle sets.
4. Links are joined to components. Buckets that still hold several components are
   compared again across components, in pairs of blocks of ``BLOCK`` members: the
   tasks prune by signature, get the full sets of the members that still have a
   partner, and verify within the task. Only links that join components leave it,
   so no partner is lost to a cap and a large group of copies costs a few
   links a document; its pairs are never rows.

The chance to miss a pair at the threshold is that of sharing no band
((1 - t^4)^32: 6e-11 at 0.85, 5e-8 at 0.8) plus ``MISS`` per compared batch. Sets
are held as 64-bit hashes.

Defined cases: null and blank texts have no shingles and are linked with
nothing; a text with fewer words than a shingle is one shingle; an empty table
gives an empty result. Rows of one ``doc_id`` with different texts are judged text by text:
``near_duplicates`` then links those that have shingles, as they are one document, and
``one_of_each`` does not, so a text goes only where one that is like it stays. Rows without
``doc_id`` are kept, and take no part in links unless a row with an id has the same set.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import apart, shingle_hashes, slices, split_by_ids, word_hashes, word_spans, written
from .components import components

HASHES, ROWS = 128, 4
BANDS = HASHES // ROWS
BATCH = 32                 # hashes compared between two looks at the posterior
MISS = 1e-6
BLOCK = 1024               # members of a bucket that meet in one comparison

_rng = np.random.default_rng(41)
_MUL = (_rng.integers(0, 2**31, HASHES, dtype=np.uint32) * np.uint32(2) + np.uint32(1))[:, None]
_XOR = _rng.integers(0, 2**32, HASHES, dtype=np.uint32)[:, None]


def _sets(texts: pa.Array, n: int) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    for _, _, data, offsets in slices(texts):
        starts, ends, first = word_spans(data, offsets)
        words = word_hashes(data, starts, ends)
        for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
            yield np.unique(shingle_hashes(words[a:b], n))


def signature(shingles: np.ndarray) -> np.ndarray:
    """128 minima; of each the 16 low bits, which tell the shingle, are kept."""
    low = np.full(HASHES, 0xFFFFFFFF, np.uint32)
    h = (shingles >> np.uint64(32)).astype(np.uint32)
    for i in range(0, len(h), 2048):
        np.minimum(low, ((h[None, i:i + 2048] ^ _XOR) * _MUL).min(axis=1), out=low)
    return low.astype(np.uint16)


#: What tells a shingle set apart: its size and 128 bits of its hashes.
KEY = ["n_shingles", "k1", "k2"]
_KEY_TYPES = "n_shingles long, k1 long, k2 long"


def _key(s: np.ndarray) -> tuple[int, int, int]:
    if not len(s):
        return 0, 0, 0
    spread = (s ^ (s >> np.uint64(29))) * np.uint64(0xD6E8FEB86659FD93)
    return len(s), int(s.sum(dtype=np.uint64).astype(np.int64)), int(np.bitwise_xor.reduce(spread).astype(np.int64))


def _keyed(n: int, keep: list[str], more: str | None = None, value=None):
    """The columns ``keep`` of the rows, the keys of their texts' sets, and ``value`` of the sets as ``more``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, values = [], []
            for s in _sets(batch.column("text"), n):
                keys.append(_key(s))
                if value:
                    values.append(value(s))
            columns = [batch.column(c) for c in keep] + [pa.array([k[i] for k in keys], pa.int64()) for i in range(3)]
            yield pa.RecordBatch.from_arrays(columns + ([pa.array(values, pa.binary())] if value else []), names=keep + KEY + ([more] if value else []))
    return run


def _signature_bytes(s: np.ndarray) -> bytes | None:
    return signature(s).tobytes() if len(s) else None


@lru_cache
def min_matches(num: int, den: int, miss: float = MISS) -> tuple[int, ...]:
    """For 32, 64, ... compared hashes: the fewest matches at which the similarity
    still reaches num/den with a posterior probability of ``miss`` (uniform prior)."""
    grid = (np.arange(1, 20001) - 0.5) / 20000
    out = []
    for k in range(BATCH, HASHES + 1, BATCH):
        m = np.arange(k + 1)[:, None]
        logs = m * np.log(grid) + (k - m) * np.log1p(-grid)
        density = np.exp(logs - logs.max(axis=1, keepdims=True))
        above = density[:, grid >= num / den].sum(axis=1) / density.sum(axis=1)
        out.append(int(np.argmax(above >= miss)))
    return tuple(out)


def _alive(a: np.ndarray, b: np.ndarray, least: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray]:
    """Indexes of the pairs that no batch prunes, and their matches."""
    left, hits = np.arange(len(a)), np.zeros(len(a), np.int64)
    for i, need in enumerate(least):
        cols = slice(i * BATCH, (i + 1) * BATCH)
        hits = hits + (a[left, cols] == b[left, cols]).sum(axis=1)
        keep = hits >= need
        left, hits = left[keep], hits[keep]
    return left, hits


def _matrix(sigs: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(sigs.to_pylist()), np.uint16).reshape(len(sigs), HASHES)


def _prune(num: int, den: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        least = min_matches(num, den)
        for batch in batches:
            if batch.num_rows:
                left, _ = _alive(_matrix(batch.column("sig_a")), _matrix(batch.column("sig_b")), least)
                yield batch.select(["a", "b"]).take(pa.array(left))
    return run


def _alike(x: np.ndarray, y: np.ndarray, num: int, den: int) -> bool:
    """Whether the Jaccard similarity of two sorted sets is at least num / den."""
    both = int((x[np.minimum(np.searchsorted(x, y), len(x) - 1)] == y).sum())
    return den * both >= num * (len(x) + len(y) - both)


def _verify(num: int, den: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("set_a").to_pylist(), batch.column("set_b").to_pylist()):
                keep.append(_alike(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), num, den))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))
    return run


def _set_table(nodes: DataFrame, classes: DataFrame, repeated: DataFrame | None, docs: DataFrame, n: int) -> DataFrame:
    """(rep, set) of the classes ``nodes`` (rep), from the texts of their smallest ids. An id of
    ``repeated`` may have several texts: there the row is found by its set's key too."""
    needed = written(nodes.distinct().join(classes, "rep"), "nd-needed")
    some, _ = split_by_ids(docs, needed, "doc_id")        # most other texts stay out of the shuffle
    once = needed if repeated is None else needed.join(repeated, "doc_id", "left_anti")
    texts = some.join(once.select("rep", "doc_id").hint("merge"), "doc_id")
    sets = texts.mapInArrow(_keyed(n, ["rep"], "set", np.ndarray.tobytes), f"rep long, {_KEY_TYPES}, set binary").select("rep", "set")
    if repeated is not None:
        rows = some.join(repeated.hint("merge"), "doc_id", "left_semi")
        rows = rows.mapInArrow(_keyed(n, ["doc_id"], "set", np.ndarray.tobytes), f"doc_id long, {_KEY_TYPES}, set binary")
        rows = rows.groupBy("doc_id", *KEY).agg(F.any_value("set").alias("set"))
        sets = sets.unionByName(rows.join(needed, ["doc_id", *KEY]).select("rep", "set"))
    return written(sets, "nd-sets")


def _verified(pairs: DataFrame, sets_of: Callable[[DataFrame], DataFrame], num: int, den: int) -> DataFrame:
    """The pairs (a, b) whose full shingle sets are similar enough."""
    pairs = written(pairs, "nd-pairs")
    sets = sets_of(pairs.select(F.explode(F.array("a", "b")).alias("rep")))
    wide = (pairs.join(sets.select(F.col("rep").alias("a"), F.col("set").alias("set_a")), "a")
            .join(sets.select(F.col("rep").alias("b"), F.col("set").alias("set_b")), "b"))
    return written(wide.mapInArrow(_verify(num, den), "a long, b long").distinct(), "nd-links")


def _by_group(handle):
    """Call ``handle`` on the rows of each (key, i, j); they come sorted by it."""
    keys = ("key", "i", "j")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            values = np.stack([batch.column(c).to_numpy() for c in keys])
            cuts = (np.flatnonzero((values[:, 1:] != values[:, :-1]).any(axis=0)) + 1).tolist()
            if held and any(held[-1].column(c)[-1].as_py() != batch.column(c)[0].as_py() for c in keys):
                cuts.insert(0, 0)
            at = 0
            for cut in cuts:
                if cut > at:
                    held.append(batch.slice(at, cut - at))
                yield from handle(pa.Table.from_batches(held).combine_chunks())
                held, at = [], cut
            held.append(batch.slice(at))
        if held:
            yield from handle(pa.Table.from_batches(held).combine_chunks())

    return run


def _partners(rows: pa.Table, num: int, den: int) -> Iterator[tuple[int, np.ndarray]]:
    """For members of a block pair: (row, rows of other components that no
    batch of hashes prunes), each pair in one direction and only in the first
    band that the two share. Pairs with the bucket's centre are decided already."""
    least = min_matches(num, den)
    comp, rep, size, blk = (rows.column(c).to_numpy() for c in ("comp", "rep", "n", "blk"))
    band, centre = rows.column("band")[0].as_py(), rows.column("centre")[0].as_py()
    split = rows.column("i")[0].as_py() != rows.column("j")[0].as_py()
    names, counts = np.unique(comp, return_counts=True)
    if len(names) < 2:
        return
    sig = _matrix(rows.column("sig"))
    bands = sig.view(np.uint64)
    largest = comp == names[counts.argmax()]
    for x in np.flatnonzero(~largest & (rep != centre)):
        other = (comp != comp[x]) & (rep != centre) & (largest | (rep > rep[x]))
        other &= den * np.minimum(size, size[x]) >= num * np.maximum(size, size[x])
        if split:
            other &= blk != blk[x]
        y = np.flatnonzero(other)
        y = y[(bands[y] == bands[x]).argmax(axis=1) == band]
        if len(y):
            left, _ = _alive(sig[y], np.broadcast_to(sig[x], (len(y), HASHES)), least)
            if len(left):
                yield x, y[left]


def _with_partners(num: int, den: int):
    def handle(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        some = np.zeros(len(rows), bool)
        for x, y in _partners(rows, num, den):
            some[x] = some[y] = True
        if some.any():
            yield from rows.filter(pa.array(some)).to_batches()
    return _by_group(handle)


def _joining_links(num: int, den: int):
    """Verified links between components, as few as join them within the rows."""
    def handle(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        rep, comp = rows.column("rep").to_numpy(), rows.column("comp").to_numpy()
        sets: dict[int, np.ndarray] = {}
        parent = {c: c for c in comp.tolist()}

        def root(c: int) -> int:
            while parent[c] != c:
                parent[c] = c = parent[parent[c]]
            return c

        def members(row: int) -> np.ndarray:
            if row not in sets:
                sets[row] = np.frombuffer(rows.column("set")[row].as_py(), np.uint64)
            return sets[row]

        out = []
        for x, partners in _partners(rows, num, den):
            for y in partners.tolist():
                a, b = root(int(comp[x])), root(int(comp[y]))
                if a != b and _alike(members(int(x)), members(y), num, den):
                    parent[max(a, b)] = min(a, b)
                    out.append((int(rep[x]), int(rep[y])))
        if out:
            yield pa.RecordBatch.from_pydict({"a": pa.array([p[0] for p in out], pa.int64()), "b": pa.array([p[1] for p in out], pa.int64())})
    return _by_group(handle)


def _rest(members: DataFrame, reps: DataFrame, found: DataFrame, sets_of: Callable[[DataFrame], DataFrame],
          num: int, den: int) -> DataFrame | None:
    """Links between components that share a bucket without a link to its
    centre. ``found``: the components so far."""
    blocks = _blocks(members, reps, found)
    if blocks.isEmpty():
        return None
    group = ("key", "i", "j")
    some = written(blocks.repartition(*group).sortWithinPartitions(*group).mapInArrow(_with_partners(num, den), blocks.schema), "nd-partners")
    if some.isEmpty():
        return None
    wide = some.join(sets_of(some.select("rep")), "rep").repartition(*group).sortWithinPartitions(*group, "rep")
    return written(wide.mapInArrow(_joining_links(num, den), "a long, b long").distinct(), "nd-links")


class _Judged(NamedTuple):
    features: DataFrame            # doc_id and the key of every row
    classes: DataFrame             # rep, doc_id (smallest) and key of every class with an id
    links: DataFrame               # a, b: similar classes, as few as join the components
    found: DataFrame               # node, component: the classes that have links
    repeated: DataFrame | None     # doc_id: those of several rows


def _judge(docs: DataFrame, shingle: int, similarity: tuple[int, int]) -> _Judged:
    num, den = similarity
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    features = written(docs.mapInArrow(_keyed(shingle, ["doc_id"], "sig", _signature_bytes), f"doc_id long, {_KEY_TYPES}, sig binary"), "nd-features")
    repeated = written(features.where("doc_id is not null").groupBy("doc_id").agg(F.count(F.lit(1)).alias("times")).where("times > 1").select("doc_id"),
                       "nd-repeated")
    repeated = None if repeated.isEmpty() else repeated
    # Written, so that a class has one number for good.
    classes = written(features.where("n_shingles > 0").groupBy(*KEY).agg(F.min("doc_id").alias("doc_id")).where("doc_id is not null")
                      .withColumn("rep", F.monotonically_increasing_id()), "nd-classes")
    reps = written(features.join(classes, ["doc_id", *KEY])
                   .select("rep", F.col("n_shingles").alias("n"), "sig").dropDuplicates(["rep"]), "nd-reps")

    def sets_of(nodes: DataFrame) -> DataFrame:
        return _set_table(nodes, classes, repeated, docs, shingle)

    bands = reps.select("rep", F.posexplode(F.transform(
        F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda i: F.substring("sig", i * (2 * ROWS) + 1, F.lit(2 * ROWS)))).alias("band", "_v"))
    bands = bands.select("rep", "band", F.xxhash64("band", "_v").alias("key"))
    buckets = written(bands.groupBy("key").agg(F.count(F.lit(1)).alias("members"), F.min("rep").alias("centre"))
                      .where("members > 1"), "nd-buckets")
    members = written(bands.join(buckets, "key"), "nd-members")

    def pruned(pairs: DataFrame) -> DataFrame:
        wide = (pairs.join(reps.select(F.col("rep").alias("a"), F.col("n").alias("n_a"), F.col("sig").alias("sig_a")), "a")
                .join(reps.select(F.col("rep").alias("b"), F.col("n").alias("n_b"), F.col("sig").alias("sig_b")), "b")
                .where(F.least("n_a", "n_b") * den >= F.greatest("n_a", "n_b") * num))
        return wide.select("a", "b", "sig_a", "sig_b").mapInArrow(_prune(num, den), "a long, b long")

    stars = members.where("rep <> centre").select(F.col("rep").alias("a"), F.col("centre").alias("b")).distinct()
    links = _verified(pruned(stars), sets_of, num, den)
    found = written(components(links), "nd-components")
    more = _rest(members, reps, found, sets_of, num, den)
    if more is not None and not more.isEmpty():
        links = links.unionByName(more)
        found = written(components(links), "nd-components")
    return _Judged(features.drop("sig"), classes, links, found, repeated)


def _named(classes: DataFrame, found: DataFrame) -> DataFrame:
    """(key, component_id): the smallest id of every class's component."""
    linked = classes.select("rep", "doc_id").join(found, F.col("rep") == F.col("node"))
    least = linked.groupBy("component").agg(F.min("doc_id").alias("least"))
    least = linked.select("rep", "component").join(least, "component").select("rep", "least")
    return written(classes.join(least, "rep", "left").select(*KEY, F.coalesce("least", "doc_id").alias("component_id")), "nd-named")


def near_duplicates(docs: DataFrame, shingle: int = 3, similarity: tuple[int, int] = (85, 100)) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of ``docs``
    (doc_id long, text). Documents whose sets have a Jaccard similarity of at least
    similarity[0] / similarity[1] are linked; a component goes by its smallest id."""
    judged = _judge(docs, shingle, similarity)
    found = judged.found
    if judged.repeated is not None:
        # The texts of one id hang on one of them.
        texts = (judged.features.join(judged.repeated, "doc_id", "left_semi").join(judged.classes.drop("doc_id"), KEY)
                 .select("doc_id", F.col("rep").alias("a")).distinct())
        same = texts.join(texts.groupBy("doc_id").agg(F.min("a").alias("b")), "doc_id").where("a <> b").select("a", "b")
        found = written(components(judged.links.unionByName(same)), "nd-components")
    return (judged.features.join(_named(judged.classes, found), KEY, "left")
            .withColumn("component_id", F.coalesce("component_id", "doc_id"))
            .select("doc_id", "n_shingles", "component_id",
                    F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept")))


def _blocks(members: DataFrame, reps: DataFrame, found: DataFrame) -> DataFrame:
    """Members of buckets that hold several components, with signatures, dealt to
    pairs of blocks. Buckets of two were decided by their only pair."""
    some = members.where("members > 2")
    placed = written(some.join(found, some.rep == found.node, "left")
                     .select("key", "band", "rep", "members", "centre", F.coalesce("component", "rep").alias("comp")), "nd-placed")
    open_ = written(placed.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"))
                    .where("lo < hi").select("key"), "nd-open")
    n_blocks = F.ceil(F.col("members") / BLOCK).cast("int")
    blocked = (placed.join(open_, "key").withColumn("blocks", n_blocks)
               .withColumn("blk", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
               .join(reps, "rep"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    return written(blocked.withColumn("_o", other).select(
        "key", F.least("blk", "_o").alias("i"), F.greatest("blk", "_o").alias("j"), "blk", "band", "rep", "n", "comp", "centre", "sig"),
        "nd-blocks")


@apart
def one_of_each(docs: DataFrame, shingle: int = 5, similarity: tuple[int, int] = (8, 10)) -> DataFrame:
    """``docs`` with one row, of the smallest id, of every near-duplicate component of texts.
    Where that id has several such rows, the smallest of them by its columns stays;
    of the rows of one id without shingles one stays too."""
    judged = _judge(docs, shingle, similarity)
    named = _named(judged.classes, judged.found)
    gone = written(judged.features.join(named, KEY).where("doc_id <> component_id").select("doc_id").distinct(), "nd-gone")
    if judged.repeated is None:
        some, plain = split_by_ids(docs, gone, "doc_id")
        return plain.unionByName(some.join(gone.hint("merge"), "doc_id", "left_anti").select(*docs.columns))
    special = written(gone.select("doc_id", F.lit(True).alias("_gone")).join(judged.repeated.withColumn("_again", F.lit(True)), "doc_id", "full"),
                      "nd-special")
    some, plain = split_by_ids(docs, special, "doc_id")
    some = some.join(special.hint("merge"), "doc_id", "left")
    single = some.where("_gone is null and _again is null").select(*docs.columns)
    # Rows of a repeated id are judged by their own texts.
    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    again = (some.where("_again").select(*docs.columns).mapInArrow(_keyed(shingle, docs.columns), f"{types}, {_KEY_TYPES}")
             .join(named.hint("merge"), KEY, "left").where("component_id is null or doc_id = component_id"))
    rest = [c for c in docs.columns if c != "doc_id"]
    # Several texts of that id may be like each other: one of them stays.
    merged = again.join(_component_of(judged), KEY, "left").groupBy("doc_id", "component").agg(F.min(F.struct(*rest)).alias("_row"))
    return plain.unionByName(single).unionByName(merged.select("doc_id", "_row.*").select(*docs.columns))


def _component_of(judged: _Judged) -> DataFrame:
    """(key, component): the number of every class's component."""
    return (judged.classes.join(judged.found, F.col("rep") == F.col("node"), "left")
            .select(*KEY, F.coalesce("component", "rep").alias("component")))
