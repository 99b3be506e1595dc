"""Operators on ordered series (key, x, y): spectra, depth scales, event traces."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from specspark.operators.layout import (
    MAX_BROADCAST_ROWS, ROWS_PER_CHUNK, Layout, arrange, fill, fits, group_total, neighbours, row_numbers, running_sum,
)

SMALL_TABLE_ROWS = 512


def _lay(df: DataFrame, key: Sequence[str], order: Sequence[str], rows_per_chunk: int) -> Layout:
    return arrange(df, key, order, rows_per_chunk)


# --- steps and differences -------------------------------------------------------------

def steps(df: DataFrame, key: Sequence[str], x: str, rows_per_chunk: int = ROWS_PER_CHUNK) -> DataFrame:
    """step: forward difference (backward on the last row); weight: half-sum of both steps."""
    lay = neighbours(_lay(df, key, [x], rows_per_chunk), [x])
    ahead, behind = F.col(f"next_{x}") - F.col(x), F.col(x) - F.col(f"prev_{x}")
    lay = lay.with_columns({
        "step": F.coalesce(ahead, behind),
        "weight": (F.coalesce(ahead, F.lit(0.0)) + F.coalesce(behind, F.lit(0.0))) / 2,
    })
    return lay.done(f"prev_{x}", f"next_{x}")


def log_diff(df: DataFrame, key: Sequence[str], x: str, value: str, out: str = "dlog",
             rows_per_chunk: int = ROWS_PER_CHUNK) -> DataFrame:
    """ln(value) minus ln(value) of the row before; null on the first row."""
    lay = neighbours(_lay(df, key, [x], rows_per_chunk), [value], after=False)
    return lay.with_columns({out: F.log(F.col(value)) - F.log(F.col(f"prev_{value}"))}).done(f"prev_{value}")


def gradient(df: DataFrame, key: Sequence[str], x: str, y: str, out: str = "slope",
             rows_per_chunk: int = ROWS_PER_CHUNK) -> DataFrame:
    """Difference over both neighbours; one-sided at the two ends."""
    lay = neighbours(_lay(df, key, [x], rows_per_chunk), [x, y])
    dy = F.coalesce(f"next_{y}", y) - F.coalesce(f"prev_{y}", y)
    dx = F.coalesce(f"next_{x}", x) - F.coalesce(f"prev_{x}", x)
    lay = lay.with_columns({out: F.try_divide(dy, dx)})
    return lay.done(f"prev_{x}", f"next_{x}", f"prev_{y}", f"next_{y}")


def every_n(df: DataFrame, key: Sequence[str], x: str, n: int,
            rows_per_chunk: int = ROWS_PER_CHUNK) -> DataFrame:
    """Rows 1, 1+n, 1+2n, ... of each series."""
    lay = row_numbers(_lay(df, key, [x], rows_per_chunk), "_rn")
    return lay.map(lay.df.filter((F.col("_rn") - 1) % n == 0)).done("_rn")


def running_offset(df: DataFrame, key: Sequence[str], order: Sequence[str], n: str, out: str = "offset",
                   rows_per_chunk: int = ROWS_PER_CHUNK) -> DataFrame:
    """Sum of n over the rows before this one."""
    return running_sum(_lay(df, key, order, rows_per_chunk), F.col(n), out, include_current=False).done()


def carry_forward(df: DataFrame, key: Sequence[str], order: Sequence[str], col: str, out: str,
                  rows_per_chunk: int = ROWS_PER_CHUNK) -> DataFrame:
    """Last non-null value of col at or before the row."""
    return fill(_lay(df, key, order, rows_per_chunk), col, out).done()


# --- cumulative integrals --------------------------------------------------------------

def cumulative_trapz(df: DataFrame, key: Sequence[str], x: str, y: str, out: str = "depth",
                     rows_per_chunk: int = ROWS_PER_CHUNK) -> DataFrame:
    """x1*y1 on the first row, then trapezoids added row by row."""
    lay = neighbours(_lay(df, key, [x], rows_per_chunk), [x, y], after=False)
    piece = F.when(F.col(f"prev_{x}").isNull(), F.col(x) * F.col(y)).otherwise(
        (F.col(x) - F.col(f"prev_{x}")) * (F.col(y) + F.col(f"prev_{y}")) / 2)
    return running_sum(lay, piece, out).done(f"prev_{x}", f"prev_{y}")


def first_crossing(df: DataFrame, key: Sequence[str], x: str, value: str, level: float) -> DataFrame:
    """The first row (smallest x) with value >= level; a series that never gets there has no row."""
    rest = [c for c in df.columns if c not in key]
    hit = df.filter(F.col(value) >= level).groupBy(*key).agg(F.min_by(F.struct(*rest), F.col(x)).alias("_row"))
    return hit.select(*key, "_row.*")


def cumulative_parabolic(df: DataFrame, key: Sequence[str], x: str, f: str, out: str = "mass",
                         rows_per_chunk: int = ROWS_PER_CHUNK) -> DataFrame:
    """Running integral of f from x1*f1 on: straight pieces on intervals 1-3 and the last one,
    in between the parabola through the row before, the row and the row after."""
    lay = _lay(df, key, [x], rows_per_chunk)
    lay = row_numbers(neighbours(lay, [x, f]), "_i")
    h, g = F.col(f"next_{x}") - F.col(x), F.col(x) - F.col(f"prev_{x}")
    ahead, behind = (F.col(f"next_{f}") - F.col(f)) / h, (F.col(f) - F.col(f"prev_{f}")) / g
    curve = (ahead - behind) / (h + g)
    lay = lay.with_columns({
        "_straight": (F.col(f) + F.col(f"next_{f}")) * h / 2,
        "_bent": F.col(f) * h + behind * h * h / 2 + curve * (h * h * h / 3 + g * h * h / 2),
    })
    lay = neighbours(lay, ["_straight", "_bent", "_i"], after=False)
    i, is_last = F.col("prev__i"), F.col(f"next_{x}").isNull()
    piece = (
        F.when(i.isNull(), F.col(x) * F.col(f))
        .when((i <= 3) | is_last, F.col("prev__straight"))
        .otherwise(F.col("prev__bent"))
    )
    lay = running_sum(lay, piece, out)
    return lay.done(f"prev_{x}", f"next_{x}", f"prev_{f}", f"next_{f}", "_i", "_straight", "_bent",
                    "prev__straight", "prev__bent", "prev__i")


def formal_intensity(df: DataFrame, key: Sequence[str], tau: str, source: str, mu: float = 1.0,
                     thin: bool = False, rows_per_chunk: int = ROWS_PER_CHUNK) -> DataFrame:
    """Emergent intensity at tau = 0 for a known source function: trapezoids of S*exp(-tau/mu) plus
    the term of the layer below the last point (diffusion form, or the optically thin one)."""
    lay = _lay(df.withColumn("_t", F.col(tau) / F.lit(mu)), key, [tau], rows_per_chunk)
    lay = neighbours(lay, ["_t", source])
    damped, next_damped = F.col(source) * F.exp(-F.col("_t")), F.col(f"next_{source}") * F.exp(-F.col("next__t"))
    last = F.col("next__t").isNull()
    slope = F.try_divide(F.col(source) - F.col(f"prev_{source}"), F.col("_t") - F.col("prev__t"))
    thin_factor = 1 - F.exp(-F.col("_first_t"))
    if thin:
        lay = group_total(lay, F.min("_t"), "_first_t")
        bottom = F.col(source) * thin_factor * F.exp(-F.col("_t"))
    else:
        bottom = (F.col(source) + F.coalesce(slope, F.lit(0.0))) * F.exp(-F.col("_t"))
    piece = F.when(last, bottom).otherwise((damped + next_damped) * 0.5 * (F.col("next__t") - F.col("_t")))
    return lay.df.groupBy(*lay.key).agg(F.sum(piece).alias("intensity")).drop(*lay.added)


# --- interpolation ---------------------------------------------------------------------

def attach_interval(targets: DataFrame, x_t: str, intervals: DataFrame, x: str, key: Sequence[str],
                    payload: Sequence[str], rows_per_chunk: int = ROWS_PER_CHUNK,
                    small: bool | None = None) -> DataFrame:
    """Give every target the interval row whose [x, next x) holds it; the first interval of a series
    also takes targets below it.  ``intervals`` needs ``_hi`` (null on the last) and ``_lowest``.

    A table counted to hold at most SMALL_TABLE_ROWS rows (``small`` says the caller has counted it; without
    a key it is counted here) becomes a sorted array that every target searches by halving.  A larger one without a key that still fits a broadcast
    is hashed on equal-width buckets.  Otherwise table and targets are merged on (key, x) and the last
    table row is carried onto the targets: one shuffle, no pair of rows is ever formed, and hot keys are
    cut by ``arrange``.
    """
    if small is None:
        small = not key and fits(intervals, SMALL_TABLE_ROWS)
    if small:
        return _searched(targets, F.col(x_t), intervals, x, key, payload)
    if not key:
        spread = _bucketed(intervals, x, payload)
        if spread is not None:
            table, bucket = spread
            t, hit = F.col(x_t), targets.withColumn("_bucket", bucket(F.col(x_t)))
            on = (hit["_bucket"] == table["_tb"]) & (t >= F.col("_from")) & ((t < F.col("_to")) | (F.col("_to") == float("inf")))
            return hit.join(F.broadcast(table), on, "left").drop("_bucket", "_tb", "_from", "_to")
    carried = [c for c in targets.columns if c not in key]
    # targets at one x need no order, but a third column lets chunks part them
    hashed = [c for c in carried if "map<" not in dict(targets.dtypes)[c]]
    left = targets.select(*key, F.col(x_t).cast("double").alias("_x"), F.lit(1).alias("_kind"), F.xxhash64(*hashed).alias("_tie"),
                          F.struct(*carried).alias("_t"), F.lit(None).alias("_hit"))
    start = F.when(F.col("_lowest"), F.lit(float("-inf"))).otherwise(F.col(x).cast("double"))
    right = intervals.select(*key, start.alias("_x"), F.lit(0).alias("_kind"), F.lit(0).cast("bigint").alias("_tie"),
                             F.lit(None).alias("_t"), F.struct(*payload).alias("_hit"))
    lay = _lay(right.unionByName(left), key, ["_x", "_kind", "_tie"], rows_per_chunk)
    merged = fill(lay, "_hit", "_at").df.filter("_kind = 1")
    # a null target lies in no interval, whichever way the table is joined
    return merged.select(*key, "_t.*", F.when(F.col("_x").isNotNull(), F.col("_at")).alias("_hit"))


def _searched(targets: DataFrame, t: Column, intervals: DataFrame, x: str, key: Sequence[str], payload: Sequence[str]) -> DataFrame:
    """targets with _hit from one array of the intervals in the order of key and start, a scalar subquery: no target meets more
    rows than a search by halving takes."""
    types = dict(intervals.dtypes)

    def at(start: Column) -> Column:
        return F.struct(*[F.col(k).cast(types[k]).alias(f"k{i}") for i, k in enumerate(key)], start.cast("double").alias("start"))

    start = F.when(F.col("_lowest"), F.lit(float("-inf"))).otherwise(F.col(x).cast("double"))
    row = F.struct(at(start).alias("at"), F.coalesce(F.col("_hi").cast("double"), F.lit(float("inf"))).alias("stop"),
                   F.struct(*payload).alias("hit"))
    # of intervals with one start only the last has any width
    table = intervals.select(row.alias("r")).agg(F.sort_array(F.collect_list("r")).alias("rows"))
    df = targets.withColumns({"_rows": table.scalar(), "_probe": at(t)})
    steps = F.array(*[F.lit(2**b) for b in range(SMALL_TABLE_ROWS.bit_length(), -1, -1)])
    found = F.aggregate(steps, F.lit(0), lambda n, step: F.when(
        F.get("_rows", n + step - 1)["at"] <= F.col("_probe"), n + step).otherwise(n))
    df = df.withColumn("_row", F.get("_rows", found - 1)).drop("_rows", "_probe")
    inside = (t < F.col("_row.stop")) | (F.col("_row.stop") == float("inf"))
    for i, k in enumerate(key):
        inside = inside & (F.col("_row.at")[f"k{i}"] == F.col(k))
    # neither a null target nor a null key lies in an interval
    return df.withColumn("_hit", F.when(inside & t.isNotNull(), F.col("_row.hit"))).drop("_row")


def _bucketed(intervals: DataFrame, x: str, payload: Sequence[str]):
    """(intervals copied to the equal-width buckets they touch, bucket expression), or None when there are too
    many intervals for a broadcast or too many of them in one bucket."""
    ends = intervals.agg(F.min(x).alias("a"), F.max(F.coalesce("_hi", x)).alias("b"), F.count(F.lit(1)).alias("n")).first()
    if not 0 < ends["n"] <= MAX_BROADCAST_ROWS // 2 or not ends["b"] > ends["a"]:
        return None
    width = float((ends["b"] - ends["a"]) / ends["n"])

    def bucket(c: Column) -> Column:
        return F.least(F.greatest(F.floor((c - F.lit(float(ends["a"]))) / F.lit(width)), F.lit(0)), F.lit(int(ends["n"])))

    first = F.when(F.col("_lowest"), F.lit(0)).otherwise(bucket(F.col(x)))
    last = F.when(F.col("_hi").isNull(), F.lit(int(ends["n"]))).otherwise(bucket(F.col("_hi")))
    table = intervals.select(
        F.explode(F.sequence(first.cast("bigint"), last.cast("bigint"))).alias("_tb"),
        F.when(F.col("_lowest"), F.lit(float("-inf"))).otherwise(F.col(x)).alias("_from"),
        F.coalesce(F.col("_hi"), F.lit(float("inf"))).alias("_to"), F.struct(*payload).alias("_hit"))
    fullest = table.groupBy("_tb").agg(F.count(F.lit(1)).alias("m")).agg(F.max("m")).first()[0]
    return (table, bucket) if fullest <= SMALL_TABLE_ROWS else None


def _intervals(lay: Layout, x: str) -> DataFrame:
    """Keep the rows that start an interval; ``lay`` already has prev_/next_ of x."""
    lay = neighbours(lay, [f"next_{x}"], before=False)
    df = lay.df.filter(F.col(f"next_{x}").isNotNull())
    return df.withColumns({
        "_hi": F.when(F.col(f"next_next_{x}").isNotNull(), F.col(f"next_{x}")),
        "_lowest": F.col(f"prev_{x}").isNull(),
    })


def interp_linear(targets: DataFrame, x_t: str, table: DataFrame, x: str, y: str,
                  key: Sequence[str] = (), out: str = "y_interp",
                  rows_per_chunk: int = ROWS_PER_CHUNK) -> DataFrame:
    """Linear value of the table at each target, extrapolated from the end pair and flagged."""
    lay = neighbours(_lay(table.select(*key, x, y), key, [x], rows_per_chunk), [x, y])
    ends = _intervals(lay, x)
    hit = attach_interval(targets, x_t, ends, x, key, [x, y, f"next_{x}", f"next_{y}"], rows_per_chunk)
    t, x0, x1 = F.col(x_t), F.col(f"_hit.{x}"), F.col(f"_hit.next_{x}")
    y0, y1 = F.col(f"_hit.{y}"), F.col(f"_hit.next_{y}")
    return hit.withColumns({
        out: (y1 - y0) * ((t - x0) / (x1 - x0)) + y0,
        "extrapolated": (t < x0) | (t > x1),
    }).drop("_hit")


def nearest_row(targets: DataFrame, x_t: str, table: DataFrame, x: str, payload: Sequence[str],
                key: Sequence[str] = (), rows_per_chunk: int = ROWS_PER_CHUNK) -> DataFrame:
    """The table row closest in x to each target; of two equally close ones the lower."""
    lay = neighbours(_lay(table.select(*key, *dict.fromkeys([x, *payload])), key, [x], rows_per_chunk),
                     list(dict.fromkeys([x, *payload])))
    rows = lay.df.withColumns({"_hi": F.col(f"next_{x}"), "_lowest": F.col(f"prev_{x}").isNull()})
    cols = list(dict.fromkeys([x, *payload]))
    hit = attach_interval(targets, x_t, rows, x, key, cols + [f"next_{c}" for c in cols], rows_per_chunk)
    above = F.col(f"_hit.next_{x}")
    upper = above.isNotNull() & (F.abs(above - F.col(x_t)) < F.abs(F.col(f"_hit.{x}") - F.col(x_t)))
    return hit.withColumns({
        f"near_{c}": F.when(upper, F.col(f"_hit.next_{c}")).otherwise(F.col(f"_hit.{c}")) for c in cols
    }).drop("_hit")


def cubic_slopes(lay: Layout, x: str, y: str, mode: int = 3) -> Layout:
    """Slope ``u`` per row: 1 secant over both neighbours, 2 parabola, 3 parabola limited for monotony."""
    lay = neighbours(lay, [x, y])
    dx, dxm = F.col(f"next_{x}") - F.col(x), F.col(x) - F.col(f"prev_{x}")
    s, sm = (F.col(f"next_{y}") - F.col(y)) / dx, (F.col(y) - F.col(f"prev_{y}")) / dxm
    inner = F.col(f"next_{x}").isNotNull() & F.col(f"prev_{x}").isNotNull()
    if mode == 1:
        u = (F.col(f"next_{y}") - F.col(f"prev_{y}")) / (F.col(f"next_{x}") - F.col(f"prev_{x}"))
    else:
        u = (s * dxm + sm * dx) / (dxm + dx)
    if mode == 3:
        # no steeper than twice the flatter secant, and flat at an extremum
        steepest = F.least(F.abs(u), 2 * F.abs(s), 2 * F.abs(sm))
        u = F.when(F.signum(s) * F.signum(sm) > 0, F.signum(s) * steepest).otherwise(0.0)
    lay = lay.with_columns({"_s": s, "_sm": sm, "_u": F.when(inner, u)})
    lay = neighbours(lay, ["_u"])
    secant, beside = F.coalesce("_s", "_sm"), F.coalesce("next__u", "prev__u")
    overshoot = {1: 0.0, 2: 1.0, 3: 0.5}[mode]
    lay = lay.with_columns({"u": F.coalesce("_u", secant + F.coalesce(overshoot * (secant - beside), F.lit(0.0)))})
    return lay.map(lay.df.drop("_s", "_sm", "_u", "next__u", "prev__u"))


def interp_cubic(targets: DataFrame, x_t: str, table: DataFrame, x: str, y: str, key: Sequence[str] = (),
                 mode: int = 3, out: str = "y_interp", rows_per_chunk: int = ROWS_PER_CHUNK) -> DataFrame:
    """Hermite cubic through the table with the slopes of ``cubic_slopes``; adds the derivative
    ``<out>_slope``; straight continuation outside, flagged."""
    lay = cubic_slopes(_lay(table.select(*key, x, y), key, [x], rows_per_chunk), x, y, mode)
    lay = neighbours(lay, ["u"], before=False)
    ends = _intervals(lay, x)
    hit = attach_interval(targets, x_t, ends, x, key, [x, y, "u", f"next_{x}", f"next_{y}", "next_u"],
                          rows_per_chunk)
    t = F.col(x_t)
    x0, y0, u0 = (F.col(f"_hit.{c}") for c in (x, y, "u"))
    x1, y1, u1 = (F.col(f"_hit.next_{c}") for c in (x, y, "u"))
    d, rise = x1 - x0, y1 - y0
    r = (t - x0) / d
    q = 1 - r
    inside = (1 + 2 * r) * q * q * y0 + (3 - 2 * r) * r * r * y1 + d * r * q * (q * u0 - r * u1)
    slope = 6 * r * q * rise / d + q * (1 - 3 * r) * u0 + r * (3 * r - 2) * u1
    return hit.withColumns({
        out: F.when(t < x0, y0 + u0 * (t - x0)).when(t >= x1, y1 + u1 * (t - x1)).otherwise(inside),
        f"{out}_slope": F.when(t < x0, u0).when(t >= x1, u1).otherwise(slope),
        "extrapolated": (t < x0) | (t > x1),
    }).drop("_hit")


def hermite_area(h: Column, y0: Column, y1: Column, u0: Column, u1: Column) -> Column:
    """Integral over an interval of width h of the Hermite cubic with end values y and end slopes u."""
    return h * ((y0 + y1) / 2 + h * (u0 - u1) / 12)


def cubic_integral(df: DataFrame, key: Sequence[str], x: str, y: str, mode: int = 3, out: str = "integral",
                   rows_per_chunk: int = ROWS_PER_CHUNK) -> DataFrame:
    """Running integral (from 0 on the first row) of the cubic of ``interp_cubic``."""
    lay = cubic_slopes(_lay(df, key, [x], rows_per_chunk), x, y, mode)
    lay = neighbours(lay, ["u"], after=False)
    h = F.col(x) - F.col(f"prev_{x}")
    area = hermite_area(h, F.col(f"prev_{y}"), F.col(y), F.col("prev_u"), F.col("u"))
    piece = F.coalesce(area, F.lit(0.0))
    return running_sum(lay, piece, out).done(f"prev_{x}", f"next_{x}", f"prev_{y}", f"next_{y}", "u", "prev_u")


def _stencil(i: Column, n: Column) -> Column:
    """First row of the 3-point stencil that halving the index range 1..n leaves around interval i."""
    start = F.struct(F.lit(1).cast("bigint").alias("lo"), n.cast("bigint").alias("hi"))

    def halve(s: Column, _: Column) -> Column:
        mid = F.floor((s["lo"] + s["hi"]) / 2)
        wide = s["hi"] - s["lo"] > 2
        return F.struct(
            F.when(wide & (mid <= i), mid).otherwise(s["lo"]).alias("lo"),
            F.when(wide & (mid > i), mid).otherwise(s["hi"]).alias("hi"))

    last = F.aggregate(F.sequence(F.lit(1), F.lit(40)), start, halve)
    return F.greatest(last["hi"] - 2, F.lit(1).cast("bigint"))


def interp_newton3(targets: DataFrame, x_t: str, table: DataFrame, x: str, y: str, key: Sequence[str] = (),
                   out: str = "y_interp", rows_per_chunk: int = ROWS_PER_CHUNK) -> DataFrame:
    """Newton form through three table rows around the target (two when the table has two)."""
    lay = _lay(table.select(*key, x, y), key, [x], rows_per_chunk)
    lay = group_total(row_numbers(neighbours(lay, [x, y]), "_i"), F.count(F.lit(1)), "_n")
    lay = neighbours(lay, [f"next_{x}", f"next_{y}"], before=False)
    first = _stencil(F.col("_i"), F.col("_n")) == F.col("_i")
    ends = lay.df.filter(F.col(f"next_{x}").isNotNull()).withColumns({
        "_hi": F.when(F.col(f"next_next_{x}").isNotNull(), F.col(f"next_{x}")),
        "_lowest": F.col(f"prev_{x}").isNull(),
    })
    for k, (a, b) in enumerate([("", "prev_"), ("next_", ""), ("next_next_", "next_")]):
        ends = ends.withColumns({f"_{c}{k}": F.when(first, F.col(f"{a}{c}")).otherwise(F.col(f"{b}{c}"))
                                 for c in (x, y)})
    names = [f"_{c}{k}" for c in (x, y) for k in range(3)]
    ends = ends.withColumns({"_pair_x0": F.col(x), "_pair_y0": F.col(y), "_pair_x1": F.col(f"next_{x}"),
                             "_pair_y1": F.col(f"next_{y}")})
    hit = attach_interval(targets, x_t, ends, x, key,
                          [*names, "_n", "_pair_x0", "_pair_y0", "_pair_x1", "_pair_y1"], rows_per_chunk)
    t = F.col(x_t)
    x0, x1, x2 = (F.col(f"_hit._{x}{k}") for k in range(3))
    y0, y1, y2 = (F.col(f"_hit._{y}{k}") for k in range(3))
    f1, f2 = F.try_divide(y1 - y0, x1 - x0), F.try_divide(y2 - y1, x2 - x1)
    newton = y0 + (t - x0) * f1 + (t - x0) * (t - x1) * F.try_divide(f2 - f1, x2 - x0)
    pair = F.col("_hit._pair_y0") + (t - F.col("_hit._pair_x0")) * (
        F.col("_hit._pair_y1") - F.col("_hit._pair_y0")) / (F.col("_hit._pair_x1") - F.col("_hit._pair_x0"))
    return hit.withColumn(out, F.when(F.col("_hit._n") == 2, pair).otherwise(newton)).drop("_hit")


def shift_resample(series: DataFrame, key: Sequence[str], x: str, y: str, shift: Column,
                   out: str = "y_shifted", rows_per_chunk: int = ROWS_PER_CHUNK) -> DataFrame:
    """Value of each series at its own grid points moved by ``shift``: Doppler x, then interp_newton3."""
    moved = series.withColumn("x_shifted", F.col(x) + shift)
    return interp_newton3(moved, "x_shifted", series, x, y, key, out, rows_per_chunk)


# --- spline on a common axis (bounded groups only) -------------------------------------

def _second_derivatives(h: np.ndarray, y: np.ndarray, ends: str) -> np.ndarray:
    """Of the spline at every point: one sweep down the tridiagonal system and one back.

    ends="natural": zero at both ends. ends="third": the third derivative of an end interval is that of the cubic through
    the four points nearest to the end (none with three points: one parabola), so the second derivative at the end
    is that of its neighbour and a known step.
    """
    n, slope = len(y), np.diff(y) / h
    bend = 6 * np.diff(slope)
    same, first, last = 0.0, 0.0, 0.0  # whether an end follows its neighbour, and by which steps
    if ends == "third":
        same = 1.0
        if n > 3:
            second = np.diff(slope) / (h[:-1] + h[1:])
            third = np.diff(second) / (h[:-2] + h[1:-1] + h[2:])
            first, last = -6 * h[0] * third[0], 6 * h[-1] * third[-1]
    pivots = 2 * (h[:-1] + h[1:])
    pivots[0] += same * h[0]
    pivots[-1] += same * h[-1]
    bend[0] -= first * h[0]
    bend[-1] -= last * h[-1]
    ratio, m = np.zeros(n), np.zeros(n)
    for i in range(1, n - 1):
        pivot = pivots[i - 1] - h[i - 1] * ratio[i - 1]
        ratio[i] = h[i] / pivot
        m[i] = (bend[i - 1] - h[i - 1] * m[i - 1]) / pivot
    for i in range(n - 3, 0, -1):
        m[i] -= ratio[i] * m[i + 1]
    m[0], m[-1] = same * m[1] + first, same * m[-2] + last
    return m


def cubic_spline(x: np.ndarray, y: np.ndarray, at: np.ndarray, ends: str = "natural") -> np.ndarray:
    """Cubic spline evaluated at ``at``; beyond the ends the outer pieces go on. Two points are a line, one is a constant,
    none is nothing."""
    n = len(x)
    if n < 2:
        return np.full(len(at), y[0] if n else np.nan)
    h = np.diff(x)
    if n == 2:
        return y[0] + (at - x[0]) * (y[1] - y[0]) / h[0]
    m = _second_derivatives(h, y, ends)
    i = np.clip(np.searchsorted(x, at, side="right") - 1, 0, n - 2)
    a, b = x[i + 1] - at, at - x[i]
    return (m[i] * a**3 + m[i + 1] * b**3) / (6 * h[i]) + (y[i] / h[i] - m[i] * h[i] / 6) * a \
        + (y[i + 1] / h[i] - m[i + 1] * h[i] / 6) * b


def resample_spline(packed: DataFrame, key: Sequence[str], x: str, y: str, axis: Sequence[float], ends: str = "natural") -> DataFrame:
    """Spline of every packed series (arrays ``x`` sorted, ``y``) onto one axis, one array per row; ``ends`` is "natural" or
    "third" (see ``_second_derivatives``).

    A row is one depth scale, so its size is fixed by the reader; nothing is grouped.
    """
    if ends not in ("natural", "third"):
        raise ValueError(f"no such ends of a spline: {ends}")
    at = np.asarray(axis, dtype=float)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            values = [cubic_spline(np.asarray(a, float), np.asarray(b, float), at, ends)
                      for a, b in zip(pdf[x], pdf[y])]
            yield pdf[list(key)].assign(axis=[at] * len(pdf), value=values)

    keys = ", ".join(f"`{k}` {dict(packed.dtypes)[k]}" for k in key)
    return packed.select(*key, x, y).mapInPandas(run, f"{keys}, axis array<double>, value array<double>")
