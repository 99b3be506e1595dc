"""Ordered series whose keys may be hot.

A plain ``Window.partitionBy(key).orderBy(x)`` puts every row of a key into one
task.  ``arrange`` measures the keys first.  If none holds more than
``rows_per_chunk`` rows the plain window is the best plan (one shuffle).
Otherwise the hot keys are cut into chunks of about that size at quantiles of their
whole order (so neither an outlier nor equal x can fill one chunk), and each
operator here becomes a two-level scan: a window inside (key, chunk), a partial
aggregate per chunk, a window over the few chunk rows, and an equi-join back on
(key, chunk), which the first window has already partitioned.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass, replace

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

from specspark.session import new_folder

ROWS_PER_CHUNK = 1_000_000
ROWS_PER_UNKEYED_CHUNK = 100_000
SAMPLES_PER_CHUNK = 64
MAX_CHUNKS = 8192  # of one key; beyond it chunks grow
MAX_HOT_KEYS = 10_000
MAX_BROADCAST_ROWS = 200_000


def small_table(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """A literal table as a local relation (no Python worker reads it)."""
    names = [f.split()[0] for f in schema.split(",")]
    return spark.createDataFrame(pa.Table.from_pylist([dict(zip(names, r)) for r in rows]), schema=schema)


def fits(df: DataFrame, max_rows: int) -> bool:
    """True when df has at most max_rows rows, by a count that ends at one row more."""
    return df.limit(max_rows + 1).count() <= max_rows


def maybe_broadcast(df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """Broadcast hint behind a row count; larger tables stay shuffle-joined (AQE)."""
    return F.broadcast(df) if fits(df, max_rows) else df


def broadcast_or_merge(df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """The side of a join to broadcast if it has at most max_rows rows; else both sides are sorted. The other side is never broadcast:
    its size is an estimate from the files it was exploded or computed from, which can be far too low."""
    return F.broadcast(df) if fits(df, max_rows) else df.hint("merge")


def written(df: DataFrame) -> DataFrame:
    """df as a table in the shared folder, so that what it comes from is scanned once."""
    folder = new_folder(df.sparkSession)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


@dataclass(frozen=True)
class Layout:
    """A DataFrame with its series key, its total order, and the chunk column if cut."""

    df: DataFrame
    key: tuple[str, ...]
    order: tuple[str, ...]
    split: bool
    added: tuple[str, ...] = ()

    @property
    def part(self) -> list[str]:
        return [*self.key, "_chunk"] if self.split else list(self.key)

    def window(self) -> WindowSpec:
        return Window.partitionBy(*self.part).orderBy(*self.order)

    def chunk_window(self) -> WindowSpec:
        return Window.partitionBy(*self.key).orderBy("_chunk")

    def position(self) -> Column:
        return F.struct(*[F.col(c) for c in self.order])

    def map(self, df: DataFrame) -> Layout:
        return replace(self, df=df)

    def with_columns(self, cols: dict[str, Column]) -> Layout:
        return self.map(self.df.withColumns(cols))

    def done(self, *drop: str) -> DataFrame:
        return self.df.drop("_chunk", *self.added, *drop)


def arrange(df: DataFrame, key: Sequence[str], order: Sequence[str],
            rows_per_chunk: int = ROWS_PER_CHUNK) -> Layout:
    """Choose the layout of a series: plain keys, or hot keys cut into chunks along the order.

    order[0] is not null; the whole of ``order`` is a total order in a key.  Cuts are quantiles of a sample
    by a hash of the order, SAMPLES_PER_CHUNK a chunk, so every evaluation of the plan gives a row the same chunk.
    """
    key, order, added = tuple(key), tuple(order), ()
    if not key:
        # the whole table is one series, so cut it earlier to keep many tasks busy
        df, key, added = df.withColumn("_all", F.lit(0)), ("_all",), ("_all",)
        rows_per_chunk = min(rows_per_chunk, ROWS_PER_UNKEYED_CHUNK)
    chunks = F.least(F.ceil(F.col("_n") / F.lit(rows_per_chunk)), F.lit(MAX_CHUNKS))
    sizes = df.groupBy(*key).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > rows_per_chunk)
    sizes = sizes.withColumn("_rows", F.floor(F.col("_n") / chunks)).select(
        *key, F.greatest(F.floor(F.col("_rows") / SAMPLES_PER_CHUNK), F.lit(1)).alias("_stride"), "_rows", chunks.alias("_chunks"))
    hot = sizes.limit(MAX_HOT_KEYS + 1).collect()
    if not hot:
        return Layout(df, key, order, False, added)
    spark = df.sparkSession
    listed = len(hot) <= MAX_HOT_KEYS
    place = F.struct(*[F.col(c) for c in order])
    if added:
        sampled = df.withColumns({"_stride": F.lit(hot[0]["_stride"]), "_rows": F.lit(hot[0]["_rows"])})
    else:
        sampled = df.join(F.broadcast(spark.createDataFrame(hot, sizes.schema)) if listed else sizes, list(key))
    sampled = sampled.filter(F.pmod(F.xxhash64(*order), F.col("_stride")) == 0)
    every = F.greatest(F.floor(F.col("_rows") / F.col("_stride")), F.lit(1))
    cuts = sampled.groupBy(*key).agg(F.sort_array(F.collect_list(place)).alias("_s"), F.first(every).alias("_every"))
    cuts = cuts.select(*key, F.filter("_s", lambda v, i: (i > 0) & (i % F.col("_every") == 0)).alias("_cuts"))
    most = MAX_CHUNKS
    if listed and sum(r["_chunks"] for r in hot) <= MAX_BROADCAST_ROWS // 4:
        found = cuts.collect()
        most = max((len(r["_cuts"]) for r in found), default=1)
        cuts = F.broadcast(spark.createDataFrame(found, cuts.schema))
    with_cuts = df.withColumn("_cuts", cuts.select("_cuts").scalar()) if added else df.join(cuts, list(key), "left")
    steps = F.array(*[F.lit(2**b) for b in range(most.bit_length(), -1, -1)])  # no deeper than the longest list of cuts
    below = F.aggregate(steps, F.lit(0), lambda n, step: F.when(F.get("_cuts", n + step - 1) <= F.col("_at"), n + step).otherwise(n))
    cut = with_cuts.withColumn("_at", place).withColumn("_chunk", F.coalesce(below, F.lit(0)).cast("bigint")).drop("_cuts", "_at")
    return Layout(cut, key, order, True, added)


def neighbours(lay: Layout, cols: Iterable[str], before: bool = True, after: bool = True,
               suffix: str = "") -> Layout:
    """Add prev_<c> / next_<c>: the value of c on the row before / after in the series."""
    cols, w, df = list(cols), lay.window(), lay.df
    if not lay.split:
        new = {}
        for c in cols:
            if before:
                new[f"prev_{c}{suffix}"] = F.lag(c).over(w)
            if after:
                new[f"next_{c}{suffix}"] = F.lead(c).over(w)
        return lay.with_columns(new)
    row = F.struct(*cols)
    edges = df.groupBy(*lay.part).agg(
        F.min_by(row, lay.position()).alias("_first"), F.max_by(row, lay.position()).alias("_last"))
    cw = lay.chunk_window()
    edges = edges.select(*lay.part, F.lag("_last").over(cw).alias("_pl"), F.lead("_first").over(cw).alias("_nf"))
    df = df.withColumns({"_b": F.lag(F.struct(*cols)).over(w), "_a": F.lead(F.struct(*cols)).over(w)})
    df = df.join(edges, lay.part, "left")
    new = {}
    for c in cols:
        if before:
            new[f"prev_{c}{suffix}"] = F.when(F.col("_b").isNull(), F.col(f"_pl.{c}")).otherwise(F.col(f"_b.{c}"))
        if after:
            new[f"next_{c}{suffix}"] = F.when(F.col("_a").isNull(), F.col(f"_nf.{c}")).otherwise(F.col(f"_a.{c}"))
    return lay.map(df.withColumns(new).drop("_b", "_a", "_pl", "_nf"))


def following(lay: Layout, col: str, n: int, out: str) -> Layout:
    """Array of col on the next n rows of the series (shorter at its end), in one pass."""
    w = lay.window()
    inside = _ahead(lay, col, n)
    if not lay.split:
        return lay.with_columns({out: inside})
    # the first n rows of every chunk; short chunks are continued by the ones after them
    first = lay.df.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= n)
    heads = first.groupBy(*lay.part).agg(F.array_sort(F.collect_list(F.struct("_r", col))).alias("_h"))
    heads = heads.select(*lay.part, _later(lay, col, n).alias("_later"))
    df = lay.df.withColumn("_inside", inside).join(heads, lay.part, "left")
    return lay.map(df.withColumn(out, F.slice(F.concat("_inside", "_later"), 1, n)).drop("_inside", "_later"))


def _ahead(lay: Layout, col: str, n: int) -> Column:
    """Array of col on the next n rows of the series or chunk."""
    w = lay.window()
    leads = [F.struct(F.lead(F.lit(1), i).over(w).alias("there"), F.lead(col, i).over(w).alias("v")) for i in range(1, n + 1)]
    return F.transform(F.filter(F.array(*leads), lambda s: s["there"].isNotNull()), lambda s: s["v"])


def _heads(col: str, n: int) -> Column:
    """The first n rows of a chunk, whose row numbers are _r, as an aggregate."""
    return F.array_sort(F.collect_list(F.when(F.col("_r") <= n, F.struct("_r", col)))).alias("_h")


def _later(lay: Layout, col: str, n: int) -> Column:
    """The first n values of the chunks behind each chunk, from their _heads; short chunks are continued by the ones after them."""
    parts = F.array_compact(F.array(*[F.lead("_h", i).over(lay.chunk_window()) for i in range(1, n + 1)]))
    return F.transform(F.slice(F.flatten(parts), 1, n), lambda s: s[col])


def marked_following(lay: Layout, col: str, n: int, mark: str, number: str, out: str) -> DataFrame:
    """The rows where mark is true: key, col, number (marked rows of the series up to this one) and out, as ``following`` gives it.

    Hot series are sorted once: what a chunk needs from the others is read from the written rows."""
    count = F.col(mark).cast("bigint")
    if not lay.split:
        lay = running_sum(following(lay, col, n, out), count, number)
        return lay.df.filter(mark).select(*lay.key, col, number, out)
    w = lay.window()
    df = lay.df.withColumns({out: _ahead(lay, col, n), number: F.coalesce(F.sum(count).over(w.rowsBetween(Window.unboundedPreceding, 0)), F.lit(0)),
                             "_r": F.row_number().over(w)})
    df = written(df.filter(F.col(mark) | (F.col("_r") <= n)).select(*lay.part, col, mark, number, out, "_r"))
    edges = df.groupBy(*lay.part).agg(_heads(col, n), F.max(number).alias("_t"))
    before = lay.chunk_window().rowsBetween(Window.unboundedPreceding, -1)
    edges = written(edges.select(*lay.part, _later(lay, col, n).alias("_later"), F.coalesce(F.sum("_t").over(before), F.lit(0)).alias("_offset")))
    df = df.filter(mark).join(maybe_broadcast(edges), lay.part, "left")
    return df.select(*lay.key, col, (F.col(number) + F.col("_offset")).alias(number), F.slice(F.concat(out, "_later"), 1, n).alias(out))


def marked_blocks(lay: Layout, col: str, n: int, mark: str, number: str, out: str) -> tuple[DataFrame, DataFrame]:
    """For a series that is cut: its rows (key, col, mark, number, _rn) and of the marked ones key, col, number, _at and out.

    number: marked rows up to this one; _rn and _at: 1-based position in the series; out as ``following`` gives it. The series is
    sorted once and written; everything else is read from there."""
    w, marked = lay.window(), F.coalesce(F.col(mark), F.lit(False))
    count = F.sum(marked.cast("bigint")).over(w.rowsBetween(Window.unboundedPreceding, 0))
    df = lay.df.withColumns({out: _ahead(lay, col, n), number: count, "_r": F.row_number().over(w).cast("bigint")})
    df = written(df.select(*lay.part, col, marked.alias(mark), number, F.when(marked, F.col(out)).alias(out), "_r"))
    edges = df.groupBy(*lay.part).agg(_heads(col, n), F.max(number).alias("_t"), F.max("_r").alias("_n"))
    before = lay.chunk_window().rowsBetween(Window.unboundedPreceding, -1)
    edges = written(edges.select(*lay.part, _later(lay, col, n).alias("_later"), F.coalesce(F.sum("_t").over(before), F.lit(0)).alias("_t"),
                                 F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_n")))
    df = df.join(maybe_broadcast(edges), lay.part).withColumns({number: F.col(number) + F.col("_t"), "_rn": F.col("_r") + F.col("_n")})
    marks = df.filter(mark).select(*lay.key, col, number, F.col("_rn").alias("_at"), F.slice(F.concat(out, "_later"), 1, n).alias(out))
    return df.select(*lay.key, col, mark, number, "_rn"), written(marks)


def running_sum(lay: Layout, value: Column, out: str, include_current: bool = True) -> Layout:
    """Sum of value from the start of the series to this row (or to the row before)."""
    df = lay.df.withColumn("_v", value)
    last = 0 if include_current else -1
    local = F.coalesce(F.sum("_v").over(lay.window().rowsBetween(Window.unboundedPreceding, last)), F.lit(0))
    if not lay.split:
        return lay.map(df.withColumn(out, local).drop("_v"))
    totals = df.groupBy(*lay.part).agg(F.sum("_v").alias("_t"))
    before = lay.chunk_window().rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select(*lay.part, F.coalesce(F.sum("_t").over(before), F.lit(0)).alias("_offset"))
    df = df.withColumn("_local", local).join(totals, lay.part, "left")
    return lay.map(df.withColumn(out, F.col("_local") + F.col("_offset")).drop("_v", "_local", "_offset"))


def row_numbers(lay: Layout, out: str) -> Layout:
    """1-based position of the row in its series."""
    if not lay.split:
        return lay.with_columns({out: F.row_number().over(lay.window()).cast("bigint")})
    return running_sum(lay, F.lit(1).cast("bigint"), out)


def fill(lay: Layout, col: str, out: str, forward: bool = True) -> Layout:
    """Nearest non-null value of col at or before (forward) / at or after the row."""
    # a backward fill is a forward one over the reversed order: frames that end at
    # unboundedFollowing are evaluated in quadratic time
    ahead = (lambda c: F.col(c)) if forward else (lambda c: F.col(c).desc())
    w = Window.partitionBy(*lay.part).orderBy(*[ahead(c) for c in lay.order])
    local = F.last(F.col(col), ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0))
    if not lay.split:
        return lay.with_columns({out: local})
    at = F.when(F.col(col).isNotNull(), lay.position())
    edge = (F.max_by(col, at) if forward else F.min_by(col, at)).alias("_e")
    cw = Window.partitionBy(*lay.key).orderBy(ahead("_chunk")).rowsBetween(Window.unboundedPreceding, -1)
    edges = lay.df.groupBy(*lay.part).agg(edge)
    edges = edges.select(*lay.part, F.last("_e", ignorenulls=True).over(cw).alias("_o"))
    df = lay.df.withColumn("_l", local).join(edges, lay.part, "left")
    return lay.map(df.withColumn(out, F.coalesce("_l", "_o")).drop("_l", "_o"))


def group_total(lay: Layout, agg: Column, out: str) -> Layout:
    """Attach one aggregate per series to every row (partial aggregation, then a key join)."""
    if not lay.split:
        return lay.with_columns({out: agg.over(Window.partitionBy(*lay.key))})
    totals = lay.df.groupBy(*lay.key).agg(agg.alias(out))
    return lay.map(lay.df.join(totals, list(lay.key), "left"))


def first_match(df: DataFrame, key: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """The first row per key in the given order, as a partially aggregated min_by."""
    rest = [c for c in df.columns if c not in key]
    if not rest:
        return df.distinct()
    best = F.min_by(F.struct(*rest), F.struct(*[F.col(c) if isinstance(c, str) else c for c in order]))
    return df.groupBy(*key).agg(best.alias("_row")).select(*key, "_row.*").select(*df.columns)
