"""Mixing sources to target weights: subset-sum budget fitting.

Sources in code-point order (null last) weigh 1, 2, 3, repeating, and share 100 % of all words.
A target stops at three times its source's size; the excess goes to the others by weight, until
none is above (water filling). Of a source with target t and size s every document is taken
``floor(t / s)`` times; the remaining budget, rounded to words, is met by a subset that is chosen
by length alone:

1. documents are counted by exact length (source, length);
2. of every length the same share is taken, rounded down, then whole documents of the longest
   fitting lengths, until the open budget is small. Sources of few lengths (``room``) skip this;
3. bounded-knapsack dynamic programming over the documents left finds the subset of lengths whose
   sum comes nearest to the open budget from below (usually it is met exactly);
4. the wanted number of documents of a length are those with the smallest seeded hashes. The hashes
   of a length are dealt into ranges and counted; only the range with the boundary is looked at row
   by row, and what comes out is one cut per length, which every document compares itself with.

Only the counts by length, one row per (source, length), go to the per-source fit; the number of
distinct lengths bounds them, not the number of documents. Where dynamic programming cannot cover
the open budget (lengths above it remain), the distance left from the target is at most half of the
words that it covers, or the shortest document left.

Defined cases: a null text has size 0; documents of size 0 are never taken. Very long texts are one
length like any other. A null source is a source of its own. Repeated rows are separate documents.
Other columns are not read by `mix` and are passed on by `mixed`, whatever their names. Empty tables
give empty results. Reruns agree: the choice depends on the rows and the seed only.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, bounded, written

DP_BUDGET = 1 << 15  # words that dynamic programming fits at least
DP_BITS = 1 << 29  # of its bit sets, where it fits more
BUCKET_ROWS = 4096
SEED = 17


def bounded_subset(lengths: np.ndarray, counts: np.ndarray, budget: int) -> np.ndarray:
    """How many of each length to take so that the sum is as near to ``budget`` from below as can be.

    Bounded knapsack over bit sets: ``reach`` holds the reachable sums as bits of an integer. A
    length available c times is split into binary bundles. The sets before each bundle are kept
    to walk back from the best sum.
    """
    taken = np.zeros(len(lengths), np.int64)
    mask, reach, steps = (1 << (budget + 1)) - 1, 1, []
    for i in np.argsort(lengths, kind="stable"):
        length, left = int(lengths[i]), int(min(counts[i], budget // lengths[i] if lengths[i] else 0))
        bundle = 1
        while left and not reach >> budget & 1:
            n = min(bundle, left)
            steps.append((reach, i, n, n * length))
            reach |= (reach << (n * length)) & mask
            left, bundle = left - n, bundle * 2
    at = reach.bit_length() - 1
    for before, i, n, size in reversed(steps):
        if not before >> at & 1:
            taken[i] += n
            at -= size
    return taken


def room(lengths: np.ndarray, counts: np.ndarray, budget: int) -> int:
    """Words that dynamic programming fits: DP_BUDGET, doubled while its bit sets stay within DP_BITS."""
    words = DP_BUDGET
    while words < budget:
        bundles = sum(int(min(c, 2 * words // n)).bit_length() for n, c in zip(lengths.tolist(), counts.tolist()) if n)
        if 4 * words * bundles > DP_BITS:
            break
        words *= 2
    return words


def fit_lengths(lengths: np.ndarray, counts: np.ndarray, budget: int) -> np.ndarray:
    """Documents to take of each length, at most ``counts``, with a sum near ``budget``."""
    total = int((lengths * counts).sum())
    if budget <= 0 or not total:
        return np.zeros(len(lengths), np.int64)
    if budget >= total:
        return np.where(lengths > 0, counts, 0)
    # leave some budget open: dynamic programming needs room to hit it
    words = room(lengths, counts, budget)
    share = max(0, budget - words // 2) if budget > words else 0
    taken = np.array([int(c) * share // total for c in counts], np.int64)
    taken[lengths == 0] = 0
    open_ = budget - int((lengths * taken).sum())
    for i in np.argsort(-lengths, kind="stable"):
        if open_ <= words:
            break
        if lengths[i]:
            n = int(min(counts[i] - taken[i], (open_ - words // 2) // lengths[i]))
            taken[i] += max(n, 0)
            open_ -= max(n, 0) * int(lengths[i])
    small = np.flatnonzero((lengths > 0) & (lengths <= open_) & (taken < counts))
    if len(small) and open_ > 2 * words:
        # all that is left is longer than open_ - words / 2, so one document more fits: the longest
        taken[small[np.argmax(lengths[small])]] += 1
    elif len(small):
        taken[small] += bounded_subset(lengths[small], (counts - taken)[small], open_)
    return taken


def targets(sizes: DataFrame, most: int = 3) -> DataFrame:
    """(source, source_size, target) for (source, size) rows; one row per source is sorted.

    Water filling: with the sources in order of ``most * size / weight``, the first j are full
    where the level that the others would get lies above their limit.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    weighed = per.withColumn("weight", (place - 1) % 3 + 1)
    limit = F.lit(most) * F.col("source_size")
    order = [limit / F.col("weight"), F.col("source").asc_nulls_last()]
    before = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    level = (
        (F.sum("source_size").over(whole) - F.coalesce(F.sum(limit).over(before), F.lit(0)))
        / (F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0)))
    )  # what a unit of weight gets if all sources before this one are full
    filled = weighed.withColumn("level", level).withColumn("full", F.col("level") * F.col("weight") >= limit)
    last = F.min(F.when(~F.col("full"), F.struct(limit / F.col("weight"), "source", "level"))).over(whole)
    target = F.when(F.col("full"), limit.cast("double")).otherwise(last["level"] * F.col("weight"))
    return filled.select("source", "source_size", target.cast("double").alias("target"))


def sized(docs: DataFrame, text: str = "text", source: str = "source", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, source, size, draw) of every document, written once; whatever is chosen by rows reads this."""
    rows = docs.select(
        F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), _size(text).alias("size"), _draw(doc_id, text).alias("draw")
    )
    return written(rows, "mix")


def _size(text: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def _draw(doc_id: str, text: str) -> Column:
    """The seeded hash that a choice goes by, from 0 to 2^63 - 1: rows of one doc_id and text share it."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(SEED), F.col(doc_id), F.col(text)), 1)


def _cuts(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """The plan (s, z, n, extra, ...) with ``cut``, ``take`` and ``ties``: the ``extra`` smallest draws of a source and size are
    those below ``cut`` and ``take`` of the ``ties`` rows at it.

    Draws are dealt into ranges of about BUCKET_ROWS rows; only the range that holds the cut is looked at row by row, equal draws
    as one.
    """
    open_ = plan.where("extra > 0 AND extra < n").select("s", "z", "extra", F.ceil(F.col("n") / F.lit(BUCKET_ROWS)).alias("many"))
    open_ = written(open_, "open")
    met = F.col("source").eqNullSafe(F.col("s")) & (F.col("size") == F.col("z"))
    bucket = F.shiftright(F.shiftright("draw", 31) * F.col("many"), 32)  # in the order of the draws
    dealt = rows.join(bounded(open_, 64), met).select("s", "z", "extra", "draw", bucket.alias("bucket"))
    key = ["s", "z", "bucket"]
    up_to = Window.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    held = dealt.groupBy(*key).agg(F.count(F.lit(1)).alias("held"), F.first("extra").alias("extra"))
    inside = (
        held.withColumn("reach", F.sum("held").over(up_to.partitionBy("s", "z").orderBy("bucket")))
        .where("reach >= extra AND reach - held < extra")
        .select(*(F.col(c).alias(f"i_{c}") for c in key), (F.col("extra") - F.col("reach") + F.col("held")).alias("need"))
    )
    inside = written(inside, "inside")
    same = [F.col(c).eqNullSafe(F.col(f"i_{c}")) for c in key]
    near = dealt.join(bounded(inside, 64), same).groupBy(*key, "draw").agg(F.count(F.lit(1)).alias("ties"), F.first("need").alias("need"))
    cut = (
        near.withColumn("reach", F.sum("ties").over(up_to.partitionBy(*key).orderBy("draw")))
        .where("reach >= need AND reach - ties < need")
        .select(F.col("s").alias("c_s"), F.col("z").alias("c_z"), F.col("draw").alias("cut"), F.expr("need - reach + ties").alias("take"), "ties")
    )
    joined = plan.join(cut, F.col("s").eqNullSafe(F.col("c_s")) & (F.col("z") == F.col("c_z")), "left").drop("c_s", "c_z")
    everyone = F.when(F.col("extra") > 0, F.lit((1 << 63) - 1)).otherwise(F.lit(-1))
    joined = joined.withColumn("cut", F.coalesce("cut", everyone))
    return written(joined.withColumn("split", F.coalesce(F.col("take") < F.col("ties"), F.lit(False))), "cuts")


_ONE_MORE = "base + CAST(draw <= cut AS LONG)"
_TIED = "split AND draw = cut"


def _repeated(df: DataFrame, n: str) -> DataFrame:
    """Each row ``n`` times, also where n is very large: first in pieces of BUCKET_ROWS, which are dealt to tasks."""
    last = F.expr(f"CAST(({n} - 1) div {BUCKET_ROWS} AS INT)")
    pieces = df.where(f"{n} > 0").withColumn("piece", F.explode(F.sequence(F.lit(0), last))).hint("rebalance")
    held = F.expr(f"CAST(least({BUCKET_ROWS}, {n} - piece * {BUCKET_ROWS}) AS INT)")
    return pieces.withColumn("piece", F.explode(F.array_repeat(F.lit(0), held))).drop("piece")


def mix(
    docs: DataFrame, text: str = "text", source: str = "source", doc_id: str = "doc_id", rows: DataFrame | None = None
) -> DataFrame:
    """Per document: doc_id, source, size, source_size, target, times (copies) and taken (words).

    ``rows`` are those of `sized`, where they are at hand.
    """
    rows = sized(docs, text, source, doc_id) if rows is None else rows
    counted = rows.groupBy("source", "size").agg(F.count(F.lit(1)).alias("n"))
    goals = written(targets(counted.select("source", (F.col("size") * F.col("n")).alias("size"))), "targets")

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("size", kind="stable").reset_index(drop=True)
        total, target = int(pdf["source_size"].iloc[0]), float(pdf["target"].iloc[0])
        base = min(3, int(target // total)) if total else 0
        rest = min(round(target) - base * total, total * (3 - base))
        lengths, counts = pdf["size"].to_numpy(np.int64), pdf["n"].to_numpy(np.int64)
        pdf["base"] = np.where(lengths > 0, base, 0)
        pdf["extra"] = fit_lengths(lengths, counts, rest)
        return pdf[["source", "size", "source_size", "target", "n", "base", "extra"]]

    plan = (
        counted.join(goals, counted["source"].eqNullSafe(goals["source"]))
        .select(counted["source"], "size", "n", "source_size", "target")
        .groupBy("source")
        .applyInPandas(
            fit, "source string, size long, source_size long, target double, n long, base long, extra long"
        )
    )
    plan = written(plan.withColumnRenamed("source", "s").withColumnRenamed("size", "z"), "plan")
    cuts = _cuts(rows, plan)
    joined = rows.join(bounded(cuts, 128), rows["source"].eqNullSafe(cuts["s"]) & (F.col("size") == F.col("z")))
    out = ["doc_id", "source", "size", "source_size", "target"]
    found = joined.where(f"NOT ({_TIED})").selectExpr(*out, f"{_ONE_MORE} AS times")
    if not cuts.where("split").isEmpty():
        # rows of one doc_id and text at the cut: some get a copy more, whichever
        alike = joined.where(_TIED).groupBy(*out, "s", "z", "base", "take").agg(F.count(F.lit(1)).alias("n"))
        ahead = Window.partitionBy("s", "z").orderBy("doc_id").rowsBetween(Window.unboundedPreceding, -1)
        more = F.expr("greatest(0, least(n, take - coalesce(ahead, 0)))")
        alike = alike.withColumn("ahead", F.sum("n").over(ahead)).withColumn("more", more)
        tied = alike.withColumn("part", F.explode(F.array(F.lit(0), F.lit(1)))).selectExpr(
            *out, "base + part AS times", "if(part = 1, more, n - more) AS rows"
        )
        found = found.unionByName(_repeated(tied, "rows").select(*out, "times"))
    return found.withColumn("taken", F.col("times") * F.col("size"))


def mixed(docs: DataFrame, text: str = "text", source: str = "source", doc_id: str = "doc_id") -> DataFrame:
    """The mix itself: every document as often as it is taken, with all columns of ``docs``.

    Texts are not shuffled. What `mix` takes becomes one row per (source, size): copies for all, and the draw up to which a
    document gets one copy more. Each document finds its size and draw in the scan and meets that row, which is
    broadcast while the rows fit in 64 MB of memory; beyond that the documents are merged with them by size. Of rows of one
    doc_id and text at the cut, equal ones are counted and those with the smallest hashes of the row get the copy.
    """
    rows = sized(docs, text, source, doc_id)
    taken = mix(docs, text, source, doc_id, rows).groupBy("source", "size")
    plan = taken.agg(F.count(F.lit(1)).alias("n"), F.min("times").alias("base"), F.sum("times").alias("all"))
    plan = plan.where("all > 0").selectExpr("source AS s", "size AS z", "n", "base", "all - n * base AS extra")
    cuts = _cuts(rows, written(plan, "copies"))
    names = docs.columns
    row = docs.select(F.struct(*(F.col(f"`{c}`") for c in names)).alias("row"), F.col(source).alias("source"), _size(text).alias("size"), _draw(doc_id, text).alias("draw"))
    joined = row.join(bounded(cuts, 128), row["source"].eqNullSafe(cuts["s"]) & (F.col("size") == F.col("z")))
    plain = joined.where(f"NOT ({_TIED})").selectExpr("row", f"CAST({_ONE_MORE} AS INT) AS times")
    found = plain.where("times > 0").select("row", F.explode(F.array_repeat(F.lit(0), F.col("times")))).select("row")
    if not cuts.where("split").isEmpty():
        alike = joined.where(_TIED).groupBy("row", "s", "z", "base", "take").agg(F.count(F.lit(1)).alias("n"))
        order = Window.partitionBy("s", "z").orderBy(F.xxhash64("row"), "row")
        ahead = F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, -1))
        copies = F.expr("n * base + greatest(0, least(n, take - coalesce(ahead, 0)))")
        found = found.unionByName(_repeated(alike.withColumn("ahead", ahead).withColumn("copies", copies), "copies").select("row"))
    return found.select(*(F.col(f"row.`{c}`").alias(c) for c in names))
