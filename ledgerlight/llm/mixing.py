"""Mixing sources to target weights by subset-sum budget fitting.

1. Documents are counted by (source, exact word count) with map-side combine.
2. Each source gets a target in words; what exceeds ``max_repeats`` times its
   size goes to the others by weight until no target is above its limit. Sources stay a
   table (there may be one for every host): each round is one sum over it.
3. Whole passes over a source fill most of a target above its size. For the
   rest every length gives the same share of its documents, and a
   bounded-knapsack dynamic programme over length counts closes the remaining
   budget, to the word wherever the lengths allow it. It keeps, for every sum, the first piece
   that reaches it, so its memory is one number a word of the budget.
4. The chosen number of documents of every (source, length) is taken in the
   order of a seeded hash of the id. Hash cells are counted first, so a length that
   a third of all rows share is not sorted in one task: whole cells are taken
   or left, and only the one cell that the cut falls into is ranked.

Only histograms (bounded by the number of different lengths of a source)
meet in one task, one source each; rows never do.

Defined cases: null text has size 0; a null source is a source of its own,
last in order; documents of size 0 take 0 words; rows of one id and length share
their hash and are taken together; an empty table gives an empty result; columns
of the input pass through, added ones begin with ``mix_``.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.rank import global_row_number
from .common import apart, written

WEIGHTS = (1, 2, 3)
MAX_REPEATS = 3
SEED = 17
#: Words left for the dynamic programme: at most this and twice a source's longest document.
DP_WORDS = 1 << 14
#: Hash cells of a (source, length) group, at most.
CELLS = 1 << 12
#: Up to so many (source, length) rows the finished plan is broadcast (about 15 MB); beyond, it is joined by shuffle.
PLAN_ROWS = 200_000


def word_count(text: Column) -> Column:
    """Number of ``[^\\x20\\x09-\\x0D]+`` in the text; null: 0."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def targets(sources: DataFrame, max_repeats: float = MAX_REPEATS) -> DataFrame:
    """``sources`` (mix_source_size, _weight) with mix_target, the words for each: 100 % of all
    words by weight, none above its limit."""
    limit, target = F.lit(float(max_repeats)) * F.col("mix_source_size"), None
    capped, n_capped = F.lit(False), -1
    while True:
        at = sources.agg(F.sum("mix_source_size").alias("words"), F.sum(F.when(~capped, F.col("_weight"))).alias("weight"),
                         F.sum(F.when(capped, limit)).alias("taken"), F.count_if(capped).alias("n")).first()
        if at["n"] == n_capped or not at["weight"]:       # no further source is above its limit, or none is left
            return sources.withColumn("mix_target", limit if target is None else F.when(capped, limit).otherwise(target))
        n_capped = at["n"]
        # As others are capped a share only grows, so who is above stays above.
        target = F.lit(float(at["words"]) - float(at["taken"] or 0)) * F.col("_weight") / F.lit(at["weight"])
        capped = target > limit


def fit_counts(lengths: np.ndarray, counts: np.ndarray, budget: int, dp_words: int = DP_WORDS) -> np.ndarray:
    """How many documents of each length to take so that the words come as
    near to ``budget`` as they can without going over."""
    take = np.zeros(len(lengths), np.int64)
    total = int((lengths * counts).sum())
    if budget <= 0 or total == 0:
        return take
    if budget >= total:
        return counts.astype(np.int64).copy()
    take = np.array([int(c) * budget // total for c in counts], np.int64)   # the same share of every length
    left = budget - int((take * lengths).sum())
    window = max(dp_words, 2 * int(lengths.max()))
    for i in np.argsort(-lengths):                                          # down to the window, long ones first
        if left <= window:
            break
        more = min(int(counts[i] - take[i]), (left - window // 2) // int(lengths[i]) if lengths[i] else 0)
        if more > 0:
            take[i] += more
            left -= more * int(lengths[i])
    # Bounded knapsack: first[w] is the first piece with which w words can be made.
    pieces, first = [], np.full(left + 1, -1, np.int32)
    reached = np.zeros(left + 1, bool)
    reached[0] = True
    for i in np.argsort(lengths):
        length, spare = int(lengths[i]), int(counts[i] - take[i])
        spare = min(spare, left // length) if length else 0
        k = 1
        while spare > 0:                                                    # 1, 2, 4, ... and the rest
            k = min(k, spare)
            new = reached[:left + 1 - k * length] & ~reached[k * length:]
            first[k * length:][new] = len(pieces)
            reached[k * length:] |= new
            pieces.append((i, k, k * length))
            spare -= k
            k *= 2
        if reached[left]:
            break
    at = int(np.flatnonzero(reached)[-1])
    while at:
        i, k, words = pieces[first[at]]
        take[i] += k
        at -= words
    return take


def _plan(group: pd.DataFrame) -> pd.DataFrame:
    group = group.sort_values("size").reset_index(drop=True)
    lengths, counts = group["size"].to_numpy(np.int64), group["n"].to_numpy(np.int64)
    total, target = int(group["mix_source_size"].iloc[0]), float(group["mix_target"].iloc[0])
    passes = min(int(target // total), int(target)) if total else 0
    group["passes"] = passes
    group["extra"] = fit_counts(lengths, counts, int(round(target - passes * total)))
    return group[["_known", "_src", "size", "n", "mix_source_size", "mix_target", "passes", "extra"]]


@apart
def mix_sources(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, max_repeats: int = MAX_REPEATS,
                seed: int = SEED) -> DataFrame:
    """One row per document: its columns and mix_size, mix_source_size,
    mix_target and mix_copies (how often the mix takes it). ``weights`` go
    round the sources in code-point order, null last."""
    group = ["_known", "_src", "_size"]

    def key(df: DataFrame) -> DataFrame:
        return df.withColumns({"_known": F.col("source").isNotNull(), "_src": F.coalesce("source", F.lit("")),
                               "_size": word_count(F.col("text")), "_h": F.xxhash64(F.lit(seed), F.col("doc_id"))})

    narrow = written(key(docs.select("doc_id", "source", "text")).select(*group, "_h"), "mix-sizes")
    histogram = narrow.groupBy(*group).agg(F.count(F.lit(1)).alias("n"))
    sources = (histogram.groupBy("_known", "_src").agg(F.sum(F.col("_size") * F.col("n")).alias("mix_source_size"))
               .withColumn("_order", F.when(F.col("_known"), F.col("_src"))))
    of_place = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod(F.col("_no") - 1, F.lit(len(weights))) + 1).cast("int"))
    numbered = written(global_row_number(sources, ["_order"], "_no").withColumn("_weight", of_place), "mix-sources")
    goal = targets(numbered, max_repeats).select("_known", "_src", "mix_source_size", "mix_target")
    plan = written(
        histogram.withColumnRenamed("_size", "size").join(goal, ["_known", "_src"])
        .groupBy("_known", "_src").applyInPandas(
            _plan, "_known boolean, _src string, size long, n long, mix_source_size long, mix_target double, passes int, extra long")
        .withColumnRenamed("size", "_size"), "mix-plan")
    cuts = _cuts(narrow, plan, group)
    decided = written(plan.join(cuts, group, "left").select(*group, "mix_source_size", "mix_target", "passes", "n", "extra", "_last"),
                      "mix-cuts")
    if decided.count() <= PLAN_ROWS:
        decided = F.broadcast(decided)
    taken = (F.col("extra") >= F.col("n")) | F.coalesce(F.col("_h") <= F.col("_last"), F.lit(False))
    return (key(docs).join(decided, group)
            .withColumns({"mix_size": F.col("_size"), "mix_copies": F.col("passes") + taken.cast("int")})
            .select(*docs.columns, "mix_size", "mix_source_size", "mix_target", "mix_copies"))


def _cuts(narrow: DataFrame, plan: DataFrame, group: list[str]) -> DataFrame:
    """The ``extra``-th smallest hash of every (source, length) that the cut
    divides. Hashes are counted by cell; only the cell of the cut is ranked."""
    some = plan.where((F.col("extra") > 0) & (F.col("extra") < F.col("n"))).select(*group, "n", "extra")
    # About 32 rows a cell; the top bits of the hash keep the cells in its order.
    n_cells = F.least(F.lit(CELLS), F.ceil(F.col("n") / 32)).cast("long")
    top = F.shiftright("_h", 32) + F.lit(1 << 31)
    rows = narrow.join(some, group).withColumn("_cell", F.shiftright(top * n_cells, 32))
    cells = rows.groupBy(*group, "extra", "_cell").agg(F.count(F.lit(1)).alias("_in"))
    before = F.sum("_in").over(Window.partitionBy(*group).orderBy("_cell").rowsBetween(Window.unboundedPreceding, 0)) - F.col("_in")
    cut = (cells.withColumn("_left", F.col("extra") - before)
           .where((F.col("_left") > 0) & (F.col("_left") <= F.col("_in"))).select(*group, "_cell", "_left"))
    rank = F.row_number().over(Window.partitionBy(*group).orderBy("_h"))
    return (rows.join(cut, [*group, "_cell"]).withColumn("_rank", rank).where(F.col("_rank") == F.col("_left"))
            .select(*group, F.col("_h").alias("_last")))
