"""Mixing sources to target weights by entropy balancing (DataFrame functions only).

Among all document rates r >= 0 the mix takes those closest in relative entropy to one copy each
(least sum of r ln r - r + 1) under one token constraint a source, sum(r * size) = target, and the bound r <= cap. The convex
dual has one multiplier a source and the rates are exponentially tilted, r = min(cap, exp(lambda_source * size)).

The dual is solved by distributed Newton steps on ln(sum r size) over the table of (source, size, number of documents), a
sufficient statistic that Spark pre-aggregates; each step is one aggregation for all sources, kept inside a bracket. Rates are
then rounded systematically: documents of a source stand by falling size, and a document gets as many copies as there are
whole numbers in its stretch of the running sum of rates. The sums of a step are exact decimals, so multipliers, rates and copies do not
depend on how the table is partitioned; a solution that misses its target is an error, never a result. The sum telescopes, so a source misses its target by a part of one
document only; the offset of the whole numbers is the best of `probes` ones. No source or size meets in one task: ranks of
documents alike in source and size are dealt over chunks by a hash.

Nulls and ties: a null text has size 0; a null source is a source of its own, last in order; null ids and repeated rows are
rows like others (rows that are equal in every respect may swap their copies). Sources without words have target 0. An empty
table gives an empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from specspark.llm.shared import chunk_counts, cut, n_words, rank_in_chunk

CHUNKS = 256
MAX_STEPS = 200  # halving alone needs some 60
TOLERANCE = 1e-7


def source_targets(groups: DataFrame, weights: tuple[float, ...], cap: float) -> DataFrame:
    """_s, source_size, target. Sources by code point, null last, weigh `weights`, repeating; a target stops at cap times
    the source's size and the excess goes to the others by weight. One row a source is all that meets in one task."""
    sizes = groups.groupBy("_s").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    place = F.row_number().over(Window.orderBy("_s")) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (place % len(weights) + 1).cast("int"))
    limit = F.lit(float(cap)) * F.col("source_size")
    s = sizes.withColumn("w", weight).withColumn("ratio", limit / F.col("w"))
    every = Window.partitionBy(F.lit(0)).orderBy("ratio", "_s")
    whole = every.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = every.rowsBetween(Window.unboundedPreceding, -1)
    after = every.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    # if the sources before this one stop at their limits, the others get `level` a unit of weight
    level = (F.sum("source_size").over(whole) - F.coalesce(F.sum(limit).over(before), F.lit(0.0))) / F.sum("w").over(after)
    s = s.withColumn("level", level)
    right = F.min(F.when(F.col("ratio") >= F.col("level"), F.struct("ratio", "_s", "level"))).over(whole)
    s = s.withColumn("level", right["level"])
    return s.select("_s", "source_size", F.least(limit, F.col("w") * F.col("level")).alias("target"))


def exact(c: Column, digits: int) -> Column:
    """The sum of doubles, each rounded to so many digits: a decimal sum does not depend on the order of the rows."""
    return F.sum(c.cast(f"decimal(38,{digits})")).cast("double")


def solve_rates(groups: DataFrame, targets: DataFrame, cap: float) -> DataFrame:
    """_s, source_size, target, lam: Newton steps on the dual, all sources at once, until every target is met."""
    top = math.log(cap)
    full = F.col("target") >= F.lit(float(cap)) * F.col("source_size") * (1 - 1e-12)
    state = cut(targets.select(
        "_s", "source_size", "target", F.lit(-64.0).alias("lo"), F.lit(top).alias("hi"),
        F.when(full, top).otherwise(0.0).alias("lam"), F.when(full, 0.0).otherwise(1.0).alias("miss")))
    for _ in range(MAX_STEPS):
        tilt = F.exp(F.col("lam") * F.col("size"))
        rate = F.least(F.lit(float(cap)), tilt)
        words = F.col("n") * F.col("size") * rate
        sums = groups.join(state, "_s").groupBy("_s", "source_size", "target", "lo", "hi", "lam", "miss").agg(
            exact(words, 12).alias("f"), exact(F.when(tilt < cap, words * F.col("size")).otherwise(0.0), 6).alias("slope"))
        over = F.col("f") > F.col("target")
        lo = F.when(over, F.col("lo")).otherwise(F.col("lam"))
        hi = F.when(over, F.col("lam")).otherwise(F.col("hi"))
        step = F.col("lam") - F.log(F.col("f") / F.col("target")) * F.col("f") / F.col("slope")
        inside = F.col("slope").isNotNull() & (F.col("slope") > 0) & (step > lo) & (step < hi)
        miss = F.when(F.col("target") > 0, F.abs(F.col("f") / F.col("target") - 1)).otherwise(0.0)
        open_ = (F.col("miss") > 0) & (miss > TOLERANCE) & (hi - lo > 1e-15)
        state = cut(sums.select(
            "_s", "source_size", "target", F.when(open_, lo).otherwise(F.col("lo")).alias("lo"),
            F.when(open_, hi).otherwise(F.col("hi")).alias("hi"),
            F.when(open_, F.when(inside, step).otherwise((lo + hi) / 2)).otherwise(F.col("lam")).alias("lam"),
            F.when(open_, miss).otherwise(0.0).alias("miss")))
        if not state.agg(F.max("miss")).first()[0]:
            break
    else:
        raise RuntimeError(f"a source misses its target after {MAX_STEPS} steps")
    return state.select("_s", "source_size", "target", "lam")


def mix(docs: DataFrame, carry: list[str] | None = None, size: Column | None = None, weights: tuple[float, ...] = (1, 2, 3),
        cap: int = 3, probes: int = 16) -> DataFrame:
    """row (struct of the columns `carry`, all by default), size, source_size, target, rate, copies: one row a document.
    size: tokens of a document, by default the words of `text`."""
    carry = docs.columns if carry is None else carry
    size = n_words(F.col("text")) if size is None else size
    named = F.when(F.col("source").isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), F.col("source")))
    measured = docs.select(
        F.struct(*carry).alias("row"), size.alias("size"), named.alias("_s"),
        F.xxhash64("doc_id", "text").alias("_h"), F.col("doc_id").alias("_id")).withColumn(
        "_c", F.pmod(F.col("_h"), F.lit(CHUNKS)))
    counts = cut(chunk_counts(measured, ["_s", "size"]))
    groups = cut(counts.groupBy("_s", "size").agg(F.sum("_n").alias("n")))
    solved = solve_rates(groups, source_targets(groups, weights, cap), cap)

    rated = groups.join(solved, "_s").withColumn(
        "rate", F.least(F.lit(float(cap)), F.exp(F.col("lam") * F.col("size"))))
    larger = Window.partitionBy("_s").orderBy(F.desc("size")).rowsBetween(Window.unboundedPreceding, -1)
    rated = cut(rated.withColumn("start", F.coalesce(F.sum(F.col("n") * F.col("rate")).over(larger), F.lit(0.0))))
    ends = F.col("start") + F.col("n") * F.col("rate")
    shifts = [(i + 0.5) / probes for i in range(probes)]
    missed = [F.struct(F.abs(F.sum(F.col("size") * (F.floor(ends + p) - F.floor(F.col("start") + p))) - F.first("target")), F.lit(p).alias("shift"))
              for p in shifts]
    best = rated.groupBy("_s").agg(*[m.alias(f"m{i}") for i, m in enumerate(missed)]).select(
        "_s", F.least(*[F.col(f"m{i}") for i in range(probes)])["shift"].alias("shift"))
    chunks = counts.drop("_n").join(rated.join(best, "_s"), ["_s", "size"]).select(
        "_s", "size", "_c", "source_size", "target", "rate",
        (F.col("start") + F.col("rate") * F.col("_off") + F.col("shift")).alias("_from"))
    ranked = rank_in_chunk(measured, ["_s", "size"], ["_h", "_id"]).join(chunks, ["_s", "size", "_c"])
    first = F.col("_from") + F.col("rate") * F.col("_rank")
    copies = F.least(F.lit(cap), F.floor(first + F.col("rate")) - F.floor(first)).cast("int")
    return ranked.select("row", "size", "source_size", "target", "rate", copies.alias("copies"))


def mixed_documents(docs: DataFrame, **how) -> DataFrame:
    """The mix itself: every document as often as it is taken, columns as they came."""
    return mix(docs, **how).select("row", F.explode(F.array_repeat(F.lit(0), F.col("copies")))).select("row.*")
