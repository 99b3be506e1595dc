"""Range, tolerance and nearest joins as equi-joins on buckets plus a residual test."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from specspark.operators.layout import Layout, arrange, fits, maybe_broadcast, neighbours, row_numbers
from specspark.operators.series import SMALL_TABLE_ROWS, _intervals, attach_interval

BLOCK = 65536


def explode_count(df: DataFrame, n: Column, out: str, block: int = BLOCK) -> DataFrame:
    """One row per 0..n-1, in two steps so that no array is longer than ``block``."""
    df = df.withColumn("_n", n.cast("bigint")).filter("_n > 0")
    df = df.withColumn("_b", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("_n") - 1) / block))))
    start, stop = F.col("_b") * block, F.least(F.col("_n"), (F.col("_b") + 1) * block) - 1
    return df.withColumn(out, F.explode(F.sequence(start, stop))).drop("_n", "_b")


def _cover(segments: DataFrame, cuts: DataFrame, seg_id: str, n_cuts: int) -> DataFrame:
    """(i, at, after): lowest seg_id over cut i, and over the open interval behind it.

    segments: seg_id and the cut numbers a..b it spans.  A span is written as a few dyadic blocks
    (level, number), a cut lies in one block per level, and the two meet on (level, number): however many
    segments overlap, no segment is paired with the cuts it covers.
    """
    levels = F.sequence(F.lit(0), F.lit(n_cuts.bit_length() + 1))
    start = F.struct(F.col("lo").alias("l"), F.col("hi").alias("r"), F.array().cast("array<struct<level:int,node:bigint>>").alias("out"))
    block = lambda level, node: F.array(F.struct(level.alias("level"), node.alias("node")))
    none = F.array().cast("array<struct<level:int,node:bigint>>")

    def rise(s: Column, level: Column) -> Column:
        alive = s["l"] < s["r"]
        left, right = alive & (s["l"] % 2 == 1), alive & (s["r"] % 2 == 1)
        out = F.concat(s["out"], F.when(left, block(level, s["l"])).otherwise(none),
                       F.when(right, block(level, s["r"] - 1)).otherwise(none))
        return F.struct(F.floor((s["l"] + left.cast("bigint")) / 2).alias("l"), F.floor(s["r"] / 2).alias("r"), out.alias("out"))

    kinds = F.array(F.struct(F.lit("at").alias("kind"), (F.col("b") + 1).alias("hi")), F.struct(F.lit("after").alias("kind"), F.col("b").alias("hi")))
    spans = segments.withColumn("_k", F.explode(kinds)).select(seg_id, F.col("a").alias("lo"), "_k.kind", "_k.hi")
    blocks = spans.withColumn("_n", F.explode(F.aggregate(levels, start, rise, lambda s: s["out"])))
    best = blocks.groupBy("kind", F.col("_n.level").alias("level"), F.col("_n.node").alias("node")).agg(F.min(seg_id).alias("seg"))
    above = F.transform(levels, lambda level: F.struct(
        level.alias("level"), F.floor(F.col("i") / F.pow(F.lit(2.0), level)).alias("node")))
    met = cuts.select("i", F.inline(above)).join(best, ["level", "node"])
    return met.groupBy("i").agg(F.min(F.when(F.col("kind") == "at", F.col("seg"))).alias("at"),
                                F.min(F.when(F.col("kind") == "after", F.col("seg"))).alias("after"))


def assign_segment(lines: DataFrame, wave: str, segments: DataFrame, seg_id: str = "seg_id",
                   lo: str = "wmin", hi: str = "wmax") -> DataFrame:
    """seg_id of the first (lowest id) segment holding each line, null outside all of them.

    The segment ends cut the axis into points and open intervals that each have one answer, so a line meets
    at most one row and no aggregation over lines is needed.
    """
    ends = segments.select(F.explode(F.array(lo, hi)).alias("cut")).distinct()
    n_cuts = ends.count()
    small = n_cuts <= SMALL_TABLE_ROWS
    lay = Layout(ends, (), ("cut",), False) if small else arrange(ends, (), ["cut"])
    cuts = row_numbers(neighbours(lay, ["cut"]), "i").done()
    number = lambda c, n: cuts.select(F.col("cut").alias(c), F.col("i").alias(n))
    spans = segments.select(seg_id, lo, hi).join(number(lo, "a"), lo).join(number(hi, "b"), hi)
    table = cuts.join(_cover(spans, cuts, seg_id, n_cuts), "i", "left").withColumns(
        {"_hi": F.col("next_cut"), "_lowest": F.col("prev_cut").isNull()})
    hit = attach_interval(lines, wave, table, "cut", (), ["cut", "at", "after"], small=small)
    w = F.col(wave)
    return hit.withColumn(seg_id, F.when(w == F.col("_hit.cut"), F.col("_hit.at"))
                          .when(w > F.col("_hit.cut"), F.col("_hit.after"))).drop("_hit")


def tolerance_join(left: DataFrame, right: DataFrame, equal: Sequence[str], near: dict[str, float],
                   residual: Column | None = None, how: str = "inner") -> DataFrame:
    """Rows with equal keys and |l.c - r.c| <= tol for every near column.  The first two near columns are
    bucketed at their tolerance and the smaller, right side is copied to the buckets it can meet, so only
    rows that nearly match are ever compared."""
    cells = [(f"_bucket{i}", c, t) for i, (c, t) in enumerate(list(near.items())[:2])]
    a, b = left, right
    for name, c, t in cells:
        bucket = F.floor(F.col(c) / F.lit(t))
        a = a.withColumn(name, bucket)
        b = b.withColumn(name, F.explode(F.array(*[bucket + k for k in (-1, 0, 1)])))
    a, b = a.alias("l"), maybe_broadcast(b).alias("r")
    on = F.lit(True)
    for name, _, _ in cells:
        on = on & (F.col(f"l.{name}") == F.col(f"r.{name}"))
    for c in equal:
        on = on & (F.col(f"l.{c}") == F.col(f"r.{c}"))
    for c, t in near.items():
        on = on & (F.abs(F.col(f"l.{c}") - F.col(f"r.{c}")) <= t)
    if residual is not None:
        on = on & residual
    joined = a.join(b, on, how)
    for name, _, _ in cells:
        joined = joined.drop(F.col(f"l.{name}")).drop(F.col(f"r.{name}"))
    return joined


def match_special(lines: DataFrame, line_key: Sequence[str], special: DataFrame, equal: Sequence[str],
                  wave: str = "wave", energy: str = "chi_low", seq: str = "seq",
                  payload: Sequence[str] = ("sigma", "alpha"), wave_tol: float = 0.05,
                  energy_tol: float = 0.02) -> DataFrame:
    """First special row (lowest seq) of the same species with |dwave| <= wave_tol and
    |denergy| < energy_tol; its payload is null where nothing matches."""
    # of special rows at one place only the first can win
    place = [*equal, wave, energy]
    table = special.groupBy(*place).agg(F.min_by(F.struct(seq, *payload), F.col(seq)).alias("_special"))
    pairs = tolerance_join(lines, table, equal, {wave: wave_tol, energy: energy_tol},
                           F.abs(F.col(f"l.{energy}") - F.col(f"r.{energy}")) < energy_tol, "left")
    pairs = pairs.select(*[F.col(f"l.{c}") for c in lines.columns], "_special")
    rest = [c for c in lines.columns if c not in line_key]
    best = pairs.groupBy(*line_key).agg(
        F.first(F.struct(*rest)).alias("_row") if rest else F.lit(None).alias("_row"),
        F.min_by("_special", F.col(f"_special.{seq}")).alias("_special"))
    return best.select(*line_key, *([f"_row.{c}" for c in rest]), *[F.col(f"_special.{p}").alias(p) for p in payload])


def match_catalog(models: DataFrame, catalog: DataFrame, equal: Sequence[str] = ("model_id",),
                  near: dict[str, float] | None = None) -> DataFrame:
    """All catalogue rows of the same model name with Teff, log g and [M/H] inside the tolerances;
    catalogue columns come back as cat_<c>."""
    near = near or {"teff": 1.0, "logg": 0.01, "feh": 0.01}
    pairs = tolerance_join(models, catalog, equal, near)
    return pairs.select(*[F.col(f"l.{c}") for c in models.columns],
                        *[F.col(f"r.{c}").alias(f"cat_{c}") for c in catalog.columns if c not in equal])


def nearest_in_bins(matches: DataFrame, model: str, abundance: str, ref: str, position: Sequence[str],
                    payload: Sequence[str] = (), step: float = 0.049999, bins: int = 5) -> DataFrame:
    """Per model, with the reference value clamped to the range of its matches: the first match in
    catalogue order inside the smallest of the widening windows step*1..bins; null pick if none."""
    limits = matches.groupBy(model).agg(F.min(abundance).alias("_min"), F.max(abundance).alias("_max"))
    df = matches.join(limits, model)
    clamped = F.greatest(F.least(F.col(ref), F.col("_max")), F.col("_min"))
    window = F.array_min(F.filter(
        F.sequence(F.lit(1), F.lit(bins)),
        lambda i: (clamped <= F.col(abundance) + F.lit(step) * i) & (clamped >= F.col(abundance) - F.lit(step) * i)))
    df = df.withColumn("_bin", window)
    order = F.when(F.col("_bin").isNotNull(), F.struct("_bin", *position))
    picked = df.groupBy(model).agg(
        F.min_by(F.struct(abundance, *position, *payload, F.col("_bin").alias("window")), order).alias("_p"))
    return picked.select(model, "_p.*")


def bracket(targets: DataFrame, x_t: str, axis: DataFrame, x: str, key: Sequence[str] = (),
            low: str = "v_inf", high: str = "v_sup") -> DataFrame:
    """The two neighbouring distinct axis values around each target; beyond either end, the end pair."""
    values = axis.select(*key, x).distinct()
    small = fits(values, SMALL_TABLE_ROWS)
    lay = Layout(values, tuple(key), (x,), False) if small else arrange(values, key, [x])
    hit = attach_interval(targets, x_t, _intervals(neighbours(lay, [x]), x), x, key, [x, f"next_{x}"], small=small)
    return hit.withColumns({low: F.col(f"_hit.{x}"), high: F.col(f"_hit.next_{x}")}).drop("_hit")


def check_grids(a: DataFrame, b: DataFrame, key: Sequence[str], value: str, tol: float = 1e-5) -> DataFrame:
    """Rows where two depth scales disagree: missing on one side, or |a/b - 1| > tol."""
    left = a.select(*key, F.col(value).alias("a"))
    right = b.select(*key, F.col(value).alias("b"))
    both = left.join(right, list(key), "full")
    off = F.abs(F.try_divide(F.col("a"), F.col("b")) - 1)
    problem = F.when(F.col("a").isNull(), "missing in a").when(F.col("b").isNull(), "missing in b") \
        .when((off > tol) | off.isNull(), "differs")
    return both.withColumn("problem", problem).filter("problem IS NOT NULL")


def diff_series(a: DataFrame, b: DataFrame, key: Sequence[str], x: str, y: str, scale: float = 1000.0) -> DataFrame:
    """Two spectra on one grid side by side: the join key is x as a scaled integer."""
    k = F.round(F.col(x) * scale).cast("bigint")
    left = a.select(*key, k.alias("_k"), x, F.col(y).alias("a"))
    right = b.select(*key, k.alias("_k"), F.col(y).alias("b"))
    return left.join(right, [*key, "_k"]).drop("_k").withColumns(
        {"diff": F.col("a") - F.col("b"), "ratio": F.try_divide(F.col("a"), F.col("b"))})

