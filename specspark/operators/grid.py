"""Parameter grids: generation, bracketing corners, trilinear blending."""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from specspark.operators.layout import arrange, broadcast_or_merge, maybe_broadcast, row_numbers, small_table, written
from specspark.operators.ranges import bracket, explode_count, tolerance_join


# --- axes and sampling -----------------------------------------------------------------

def axis_length(low: Column, high: Column, step: Column) -> Column:
    """Number of values low, low+step, ... below high+step (so the last may pass high)."""
    return F.ceil((high + step - low) / step)


def axis_values(df: DataFrame, low: str, high: str, step: str, out: str = "value") -> DataFrame:
    """One row per axis value of every row's (low, high, step)."""
    lo, hi, st = (F.col(c).cast("double") for c in (low, high, step))
    long = explode_count(df, axis_length(lo, hi, st), "_i")
    return long.withColumn(out, lo + F.col("_i") * st).drop("_i")


def axis_table(df: DataFrame, column: str) -> DataFrame:
    """i, value: the sorted distinct values of a column, numbered from 0. An axis may be of any length."""
    values = df.select(F.col(column).alias("value")).filter(F.col("value").isNotNull()).distinct()
    return row_numbers(arrange(values, (), ["value"]), "_n").done().select((F.col("_n") - 1).alias("i"), "value")


def _unit(seed: int, *cols: Column) -> Column:
    """Uniform number in [0, 1) from a hash: the same on every recomputation, and in any engine with md5."""
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), *[c.cast("string") for c in cols]).cast("binary"))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def axis_distribution(df: DataFrame, key: Sequence[str], count: str, kind: str = "gaussian", mean: float = 0.0,
                      sigma: float = 0.1, low: float | None = None, high: float | None = None,
                      seed: int = 0, out: str = "value") -> DataFrame:
    """``count`` draws per row of df from a normal or a uniform distribution."""
    if kind == "uniform" and (low is None or high is None):
        raise ValueError("a uniform axis needs low and high")
    if kind not in ("gaussian", "uniform"):
        raise ValueError(f"unsupported distribution {kind}")
    long = explode_count(df, F.col(count), "i")
    cols = [F.col(k) for k in key] + [F.col("i")]
    u = _unit(seed, *cols)
    if kind == "uniform":
        return long.withColumn(out, low + (high - low) * u)
    angle = F.lit(2 * np.pi) * _unit(seed + 1, *cols)
    return long.withColumn(out, mean + sigma * F.sqrt(-2 * F.log(1 - u)) * F.cos(angle))


Axis = Sequence | DataFrame


def _tables(spark: SparkSession, axes: dict[str, Axis]) -> dict[str, tuple[DataFrame, int]]:
    """Each axis as an indexed table and its length: what axis_table gives (written once, so that its source is scanned once),
    or a list of values in their own order."""
    out = {}
    for name, axis in axes.items():
        if isinstance(axis, DataFrame):
            table = written(axis.select("i", "value"))
            out[name] = table, table.count()
        else:
            kind = spark.createDataFrame([(v,) for v in axis], [name]).schema[0].dataType.simpleString()
            out[name] = small_table(spark, list(enumerate(axis)), f"i bigint, value {kind}"), len(axis)
    return out


def _decoded(df: DataFrame, tables: dict[str, tuple[DataFrame, int]], index: dict[str, Column]) -> DataFrame:
    """df with one column an axis: its value at the index, found by a join."""
    df = df.withColumns({f"_i_{name}": c.cast("bigint") for name, c in index.items()})
    for name, (table, _) in tables.items():
        df = df.join(maybe_broadcast(table.select(F.col("i").alias(f"_i_{name}"), F.col("value").alias(name))), f"_i_{name}")
    return df.select("row_id", *tables)


def grid_full(spark: SparkSession, axes: dict[str, Axis], max_rows: int | None = None) -> DataFrame:
    """Cartesian product in axis order (last axis fastest): the digits of the row number, each joined to its axis."""
    tables = _tables(spark, axes)
    total, below, index = math.prod(n for _, n in tables.values()), 1, {}
    for name, (_, n) in reversed(tables.items()):
        index[name] = F.pmod(F.floor(F.call_function("div", F.col("row_id"), F.lit(below).cast("bigint"))), F.lit(n))
        below *= n
    df = spark.range(total if max_rows is None else min(total, max_rows)).withColumnRenamed("id", "row_id")
    return _decoded(df, tables, index)


def grid_random(spark: SparkSession, axes: dict[str, Axis], n: int, seed: int = 0) -> DataFrame:
    """n independent draws per axis, with replacement."""
    tables = _tables(spark, axes)
    index = {name: F.floor(_unit(seed + i, F.col("row_id")) * m) for i, (name, (_, m)) in enumerate(tables.items())}
    return _decoded(spark.range(n).withColumnRenamed("id", "row_id"), tables, index)


ROUNDS, WALK = 6, 64


def permuted(x: Column, n: int, seed: int) -> Column:
    """A permutation of 0 .. n - 1 as an expression: no sort and no shuffle.

    x is split into (left, right) of a x b cells, a * b >= n, and each round adds a hash of the one half to the other, which is a
    bijection of the cells; numbers of n or more (fewer than a) are sent through again until they fall below n."""
    a = math.isqrt(n - 1) + 1 if n > 1 else 1
    b = -(-n // a)
    key = lambda r, half: F.xxhash64(F.lit(seed), r, half)

    def turn(s: Column, r: Column) -> Column:
        left = F.struct(F.pmod(s["l"] + F.pmod(key(r, s["r"]), F.lit(a)), F.lit(a)).alias("l"), s["r"].alias("r"))
        right = F.struct(s["l"].alias("l"), F.pmod(s["r"] + F.pmod(key(r, s["l"]), F.lit(b)), F.lit(b)).alias("r"))
        return F.when(r % 2 == 0, left).otherwise(right)

    def once(v: Column) -> Column:
        halves = F.struct(F.call_function("div", v, F.lit(b).cast("bigint")).alias("l"), F.pmod(v, F.lit(b).cast("bigint")).alias("r"))
        return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), halves, turn, lambda s: s["l"] * F.lit(b).cast("bigint") + s["r"])

    again = F.sequence(F.lit(1), F.lit(WALK))
    return F.aggregate(again, once(x.cast("bigint")), lambda v, _: F.when(v < n, v).otherwise(once(v)))


def grid_lhs(spark: SparkSession, axes: dict[str, Axis], n: int, seed: int = 0) -> DataFrame:
    """Latin hypercube: each axis index is the row number, permuted by the axis's own key, modulo the axis length, so every value
    occurs floor(n/m) or ceil(n/m) times."""
    tables = _tables(spark, axes)
    index = {name: F.pmod(permuted(F.col("row_id"), n, seed + i), F.lit(m)) for i, (name, (_, m)) in enumerate(tables.items())}
    return _decoded(spark.range(n).withColumnRenamed("id", "row_id"), tables, index)


GRID_COLUMNS = ["grid_version", "teff", "logg", "feh", "lam_min", "lam_max", "lam_step", "turbvel", "t_value",
                "a", "c", "n", "o", "r", "s", "output_mode", "mode", "calculation_mode"]
# fixed values: what a grid file holds where the specification is silent
GRID_DEFAULTS = {"grid_version": "unversioned", "lam_min": 6000.0, "lam_max": 6100.0, "lam_step": 0.01,
                 "turbvel": "01", "output_mode": "Flux", "mode": "1D", "calculation_mode": "LTE"}


def format_grid(grid: DataFrame, meta: dict | None = None) -> DataFrame:
    """The 18 output columns: Teff truncated, log g and [Fe/H] to 2 decimals, numeric abundances %+.2f."""
    constants = {**GRID_DEFAULTS, **(meta or {})}
    types = dict(grid.dtypes)

    def column(c: str) -> Column:
        if c in constants and c not in types:
            return F.lit(constants[c]).alias(c)
        if c == "teff":
            return F.col(c).cast("int").alias(c)
        if c in ("logg", "feh"):
            return F.round(F.col(c).cast("double"), 2).alias(c)
        if c in ("a", "c", "n", "o", "r", "s"):
            if c not in types:
                return F.lit("+0.00").alias(c)
            return F.col(c) if types[c] == "string" else F.format_string("%+.2f", F.col(c).cast("double")).alias(c)
        return F.col(c).cast("string").alias(c) if c == "t_value" else F.col(c)

    return grid.select(*[column(c) for c in GRID_COLUMNS])


def wave_grid(df: DataFrame, low: str, high: str, step: str) -> DataFrame:
    """j = 1..int((high-low)/step)+1 and wave = low + (j-1)*step for every row of df."""
    lo, st = F.col(low).cast("double"), F.col(step).cast("double")
    long = explode_count(df, ((F.col(high) - lo) / st).cast("bigint") + 1, "_i")
    return long.withColumns({"j": (F.col("_i") + 1).cast("bigint"), "wave": lo + F.col("_i") * st}).drop("_i")


def wave_grid_segments(segments: DataFrame, resolution: float = 500000.0) -> DataFrame:
    """Per segment a step of (mid wavelength)/R; points run to the first one >= wmax, included."""
    lo, hi = F.col("wmin").cast("double"), F.col("wmax").cast("double")
    step = (lo + hi) / 2.0 / F.lit(resolution)
    long = explode_count(segments.withColumn("_step", step), F.ceil((hi - lo) / step) + 1, "_i")
    return long.withColumns({"j": (F.col("_i") + 1).cast("bigint"), "wave": lo + F.col("_i") * F.col("_step")}) \
        .drop("_i", "_step")


def common_axis(depths: DataFrame, key: Sequence[str], model: str, x: str, n: int) -> DataFrame:
    """n linear points from the largest of the model minima to the smallest of the maxima, per key."""
    per_model = depths.groupBy(*key, model).agg(F.min(x).alias("_a"), F.max(x).alias("_b"))
    ends = per_model.groupBy(*key).agg(F.max("_a").alias("_lo"), F.min("_b").alias("_hi"))
    step = (F.col("_hi") - F.col("_lo")) / F.lit(n - 1)
    long = ends.withColumn("_i", F.explode(F.sequence(F.lit(0), F.lit(n - 1))))
    return long.select(*key, (F.col("_i") + 1).alias("k"), (F.col("_lo") + F.col("_i") * step).alias(x))


def gauss_rule(k: int, a: float = 0.0, b: float = 1.0) -> list[tuple[int, float, float]]:
    """(i, node, weight) of the Gauss-Legendre rule on [a, b], 2 <= k <= 10."""
    if not 2 <= k <= 10:
        raise ValueError("k must be 2..10")
    x, w = np.polynomial.legendre.leggauss(k)
    return [(i + 1, float((b - a) / 2 * x[i] + (a + b) / 2), float((b - a) / 2 * w[i])) for i in range(k)]


def gauss_nodes(spark: SparkSession, k: int, a: float = 0.0, b: float = 1.0) -> DataFrame:
    return small_table(spark, gauss_rule(k, a, b), "i int, node double, weight double")


def integrate_gauss(f, low: Column, high: Column, k: int) -> Column:
    """Integral of f (Column -> Column) from low to high by the k-point rule, as one expression."""
    half, middle = (high - low) / 2, (high + low) / 2
    return reduce(lambda acc, n: acc + F.lit(n[2]) * f(middle + half * n[1]), gauss_rule(k, -1.0, 1.0), F.lit(0.0)) * half


def extend_depths(packed: DataFrame, t_limit: float = 6000.0, max_step: float = 400.0,
                  max_layers: int | None = None) -> DataFrame:
    """Append layers to each packed model (arrays temp, log_pg, rho; deepest last) until T > t_limit.

    The k-th new layer is hotter by min(max_step, dT*2^(k/2)), with dT the last step of the model;
    log Pg and rho continue along their last slope against T.  One model is one row, so the
    recurrence is an array fold inside the row and needs no shuffle.  ``max_layers`` stops a model at so many
    layers; without it the fold runs as long as the growing steps can need.
    """
    last = lambda c, back=1: F.element_at(c, -back)
    dt = last("temp") - last("temp", 2)
    slope_p = F.try_divide(last("log_pg") - last("log_pg", 2), dt)
    slope_r = F.try_divide(last("rho") - last("rho", 2), dt)
    df = packed.withColumns({"_dt": dt, "_sp": slope_p, "_sr": slope_r})

    def grow(state: Column, k: Column) -> Column:
        hot = F.element_at(state, -1) > t_limit
        step = F.least(F.lit(max_step), F.col("_dt") * F.pow(F.lit(2.0), k / F.lit(2.0)))
        full = F.lit(False) if max_layers is None else F.size(state) >= max_layers
        return F.when(hot | full | ~(F.col("_dt") > 0), state).otherwise(
            F.concat(state, F.array(F.element_at(state, -1) + step)))

    # steps double every second layer up to max_step
    turns = F.ceil(2 * F.log2(F.greatest(F.lit(max_step) / F.col("_dt"), F.lit(1.0)))) + F.ceil(
        F.greatest(F.lit(t_limit) - last("temp"), F.lit(0.0)) / max_step) + 2
    turns = F.when(F.col("_dt") > 0, turns).otherwise(1).cast("int")
    df = df.withColumn("_t", F.aggregate(F.sequence(F.lit(1), turns), F.col("temp"), grow))
    tail = F.slice("_t", F.size("temp") + 1, F.greatest(F.size("_t") - F.size("temp"), F.lit(0)))
    along = lambda c, s: F.concat(F.col(c), F.transform(
        tail, lambda t: F.element_at(F.col(c), -1) + F.col(s) * (t - F.element_at(F.col("temp"), -1))))
    return df.withColumns({"log_pg": along("log_pg", "_sp"), "rho": along("rho", "_sr")}) \
        .withColumn("temp", F.col("_t")).drop("_dt", "_sp", "_sr", "_t")


# --- corners ---------------------------------------------------------------------------

AXES = ("teff", "logg", "feh")


def axes(models: DataFrame, turb: str = "turb") -> DataFrame:
    """Sorted distinct values of each axis per microturbulence, as arrays (an axis is short)."""
    return models.groupBy(turb).agg(*[F.array_sort(F.collect_set(a)).alias(f"{a}_axis") for a in AXES])


def bracket_points(points: DataFrame, models: DataFrame, turb: str = "turb") -> DataFrame:
    """<axis>_inf and <axis>_sup of every point among the models of its microturbulence."""
    one = lambda df, a: bracket(df, a, models, a, [turb], f"{a}_inf", f"{a}_sup")
    return reduce(one, AXES, points)


def corners(points: DataFrame, point_id: str, models: DataFrame, turb: str = "turb",
            position: Sequence[str] = ("cat_pos",), tol: float = 0.01) -> DataFrame:
    """The 8 corners of each point (Teff slowest, [Fe/H] fastest) with the first catalogue model at
    each: equal Teff, |dlogg| < tol, |dfeh| < tol.  ``path`` is null where no model exists."""
    b = bracket_points(points, models, turb)
    ends = lambda a, hi: F.col(f"{a}_sup") if hi else F.col(f"{a}_inf")
    options = [F.struct(F.lit(c + 1).alias("corner"), ends("teff", c & 4).alias("c_teff"),
                        ends("logg", c & 2).alias("c_logg"), ends("feh", c & 1).alias("c_feh")) for c in range(8)]
    long = b.withColumn("_c", F.explode(F.array(*options))).select("*", "_c.*").drop("_c")
    # the cells decide how to join; the corners, eight for each point, are never the side that is broadcast
    found = broadcast_or_merge(written(_cells(models, turb, position, tol)))
    return long.join(found, [turb, "c_teff", "c_logg", "c_feh"], "left")


def _cells(models: DataFrame, turb: str, position: Sequence[str], tol: float) -> DataFrame:
    """The first catalogue model at every (turb, Teff, axis log g, axis [Fe/H]) that has one.

    Corner values are axis values of the catalogue itself, so this needs the models only."""
    cat = models.select(turb, "teff", "logg", "feh", F.struct(*position).alias("_pos"), "path")
    for axis in ("logg", "feh"):
        values = models.select(turb, axis).distinct()
        near = F.abs(F.col(f"l.{axis}") - F.col(f"r.{axis}")) < tol
        pairs = tolerance_join(cat, values, [turb], {axis: tol}, near)
        cat = pairs.select(*[F.col(f"l.{c}") for c in cat.columns], F.col(f"r.{axis}").alias(f"c_{axis}"))
    return cat.groupBy(turb, F.col("teff").alias("c_teff"), "c_logg", "c_feh").agg(
        F.min_by("path", "_pos").alias("path"))


def missing_corners(corner_rows: DataFrame, point_id: str) -> DataFrame:
    """Points that lack a corner, with the first one (in corner order) named."""
    text = F.format_string("Missing grid point: Teff=%s, logg=%s, FeH=%s", F.col("c_teff").cast("string"),
                           F.col("c_logg").cast("string"), F.col("c_feh").cast("string"))
    gone = corner_rows.filter(F.col("path").isNull())
    return gone.groupBy(point_id).agg(F.min_by(text, F.col("corner")).alias("message"),
                                      F.count(F.lit(1)).cast("int").alias("n_missing"))


def check_corners(corner_models: DataFrame, point_id: str) -> DataFrame:
    """Per point: do its corner models share geometry and reference wavelength, and depth count?"""
    def differ(c: str) -> Column:
        return F.min(c) != F.max(c)

    agg = corner_models.groupBy(point_id).agg(
        differ("geometry").alias("geometry_differs"), differ("xlr").alias("xlr_differs"),
        differ("ndepth").alias("ndepth_differs"))
    status = F.when(F.col("geometry_differs") | F.col("xlr_differs"), "error") \
        .when(F.col("ndepth_differs"), "resample").otherwise("ok")
    return agg.withColumn("status", status)


# --- trilinear -------------------------------------------------------------------------

# fixed values: departure from linearity per quantity on (Teff, log g); the third entry holds the
# scale temperature and exponent of the [Fe/H] axis, 1 - (Teff/scale)^exponent
LIN_DIF = {
    "temp": (0.15, 0.3, (4000.0, 2.0)),
    "log_pe": (0.15, 0.06, (3500.0, 2.5)),
    "log_pg": (-0.4, 0.06, (4100.0, 4.0)),
    "log_kappa": (-0.15, -0.12, (3700.0, 3.5)),
}
CALIBRATED_SPAN = {"teff": 7000 - 3800, "logg": 5 - 0.0, "feh": 0 - (-4)}


def _coordinate(axis: str) -> Column:
    lo, hi = F.col(f"{axis}_inf"), F.col(f"{axis}_sup")
    return F.when(lo == hi, 0.0).otherwise((F.col(axis) - lo) / (hi - lo))


def _power(quantity: str, axis: str) -> Column:
    """Exponent of the blend coordinate; exactly 1 for quantities that are blended linearly."""
    if quantity not in LIN_DIF:
        return F.lit(1.0)
    entry = LIN_DIF[quantity][AXES.index(axis)]
    dif = 1 - F.pow(F.col("teff") / F.lit(entry[0]), F.lit(entry[1])) if isinstance(entry, tuple) else F.lit(entry)
    span = F.abs(F.col(f"{axis}_sup") - F.col(f"{axis}_inf"))
    return 1 - dif * span / F.lit(float(CALIBRATED_SPAN[axis]))


def _weight(quantity: str, optimize: bool) -> Column:
    """Weight of a corner: product over the axes of c or 1-c; null when c is not a number."""
    weight = F.lit(1.0)
    for axis, bit in zip(AXES, (4, 2, 1)):
        c = _coordinate(axis)
        if optimize and quantity in LIN_DIF:
            c = F.pow(c, _power(quantity, axis))
            c = F.when(F.isnan(c) | (F.abs(c) == float("inf")), F.lit(None)).otherwise(c)
        upper = (F.col("corner") - 1).bitwiseAND(bit) != 0
        weight = weight * F.when(upper, c).otherwise(1 - c)
    return weight


def blend_corners(corner_rows: DataFrame, point_id: str, values: DataFrame, model: str, levels: Sequence[str],
                  quantities: Sequence[str], optimize: bool = True) -> DataFrame:
    """Trilinear blend of ``quantities`` over the 8 corners for every point and level key.

    One join of corners to the model rows and one partial aggregation; a level that any corner lacks
    gives null, ``extrapolated`` marks points outside their cell.
    """
    rows = corner_rows.join(broadcast_or_merge(values.withColumnRenamed(model, "path")), "path")
    outside = F.lit(False)
    for axis in AXES:
        outside = outside | (_coordinate(axis) < 0) | (_coordinate(axis) > 1)
    terms = {f"_w_{q}": _weight(q, optimize) * F.col(q) for q in quantities}
    rows = rows.withColumns({**terms, "_outside": outside})
    blended = rows.groupBy(point_id, *levels).agg(
        F.count(F.lit(1)).alias("_n"), F.bool_or("_outside").alias("extrapolated"),
        *[F.sum(f"_w_{q}").alias(f"_s_{q}") for q in quantities],
        *[F.count(f"_w_{q}").alias(f"_c_{q}") for q in quantities])
    return blended.select(point_id, *levels, "extrapolated", *[
        F.when((F.col("_n") == 8) & (F.col(f"_c_{q}") == 8), F.col(f"_s_{q}")).alias(q) for q in quantities])


# fixed values: largest error per 100 K, per dex in log g, per dex in [Fe/H]
ERROR_COEF = {
    "temp": (0.055 / 32, 0.008 / 5, 0.015 / 4),
    "pe": (0.65 / 32, 0.4 / 5, 0.38 / 4),
    "pg": (0.25 / 32, 0.23 / 5, 0.35 / 4),
    "kappa": (0.8 / 32, 0.36 / 5, 0.38 / 4),
}


def interp_error(points: DataFrame) -> DataFrame:
    """Estimated largest error in per cent for T, Pe, Pg and kappa of bracketed points."""
    near = [F.least(F.col(f"{a}_sup") - F.col(a), F.col(a) - F.col(f"{a}_inf")) for a in AXES]
    near[0] = near[0] / 100
    return points.withColumns({
        f"err_{q}": 100 * (near[0] * c[0] + near[1] * c[1] + near[2] * c[2]) for q, c in ERROR_COEF.items()})


def extent(df: DataFrame, key: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """min_<c> and max_<c> per key."""
    aggs = [f(c).alias(f"{n}_{c}") for c in cols for n, f in (("min", F.min), ("max", F.max))]
    return df.groupBy(*key).agg(*aggs) if key else df.agg(*aggs)
