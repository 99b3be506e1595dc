"""From lines, depths and a continuum to opacity on a grid of segments, summed in dense blocks.

The grid is piecewise affine: a segment has a start, a step, a number of points and the number of points before it, so a
wavelength finds its point by arithmetic and a line's walk ends where its segment does. What depends on the species and the
depth alone is computed once for each of those pairs and reaches the lines as arrays. A task holds depth x points accumulators of
the blocks it is working on; a row of output is a sum over lines already.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from specspark.functions.physics import (BOLTZ, C_LIGHT, H_PLANCK, LINE_CONST, damping_a, damping_gamma, voigt_np)
from specspark.operators.layout import arrange, maybe_broadcast, neighbours, running_sum
from specspark.operators.opacity import C_ANGSTROM, _passing
from specspark.operators.ranges import assign_segment
from specspark.operators.series import attach_interval

BLOCK = 2048  # points of an accumulator
PIECE, PAIRS = 4096, 1 << 15  # points of a line, and (line, point) pairs, that are evaluated together
HELD_BYTES = 128 << 20


# --- the grid ----------------------------------------------------------------------------

def segment_index(segments: DataFrame, resolution: float = 500000.0, seg_id: str = "seg_id") -> DataFrame:
    """seg_id, wmin, wmax, step, n, first: every segment as an affine piece of one grid. The step is the mid wavelength over the
    resolution, points run to the first one at or past wmax, and first counts the points of the segments of lower id."""
    lo, hi = F.col("wmin").cast("double"), F.col("wmax").cast("double")
    step = (lo + hi) / 2.0 / F.lit(resolution)
    pieces = segments.select(seg_id, lo.alias("wmin"), hi.alias("wmax"), step.alias("step"),
                             (F.ceil((hi - lo) / step) + 1).cast("bigint").alias("n"))
    return running_sum(arrange(pieces, (), [seg_id]), F.col("n"), "first", include_current=False).done()


def regular_index(lines: DataFrame, start: float, step: float, n: int) -> DataFrame:
    """lines placed on one regular grid, those beyond its ends too."""
    return lines.withColumns({"seg_id": F.lit(0), "start": F.lit(float(start)), "step": F.lit(float(step)),
                              "n": F.lit(n).cast("bigint"), "first": F.lit(0).cast("bigint")})


def place_lines(lines: DataFrame, wave: str, index: DataFrame, seg_id: str = "seg_id") -> DataFrame:
    """lines with their segment (the lowest id that holds them) and its start, step, n, first; lines outside all segments go."""
    held = assign_segment(lines, wave, index, seg_id).filter(F.col(seg_id).isNotNull())
    pieces = index.select(seg_id, F.col("wmin").alias("start"), "step", "n", "first")
    return held.join(maybe_broadcast(pieces), seg_id)


# --- what lines need at each depth ---------------------------------------------------------

def pack_depths(depths: DataFrame, species: DataFrame, species_id: str = "species_id") -> DataFrame:
    """species_id and `depths`, an array by k: everything of (species, depth) that does not depend on the line.

    depths: k, temp, xi, ross, pg, ph, phe, ph2. species: species_id, mass, number and q, the last two arrays by depth (k from 0).
    """
    layer = F.array_sort(F.collect_list(F.struct("k", "temp", "xi", "ross", "pg", "ph", "phe", "ph2")))
    model = depths.agg(layer.alias("_model"))
    one = F.struct("mass", "number", "q").alias("_s")
    # the model is one row: a scalar subquery, not a join
    with_model = species.select(species_id, one).withColumn("_model", model.scalar())

    def pack(d: Column) -> Column:
        k = d["k"].cast("int") + 1
        return F.struct(
            d["k"].alias("k"), d["temp"].alias("temp"), (F.lit(5040) / d["temp"]).alias("theta"), d["ross"].alias("ross"),
            F.sqrt(2 * BOLTZ * d["temp"] / F.col("_s.mass") + d["xi"] * d["xi"]).alias("xi0"),
            (F.element_at("_s.number", k) / F.element_at("_s.q", k)).alias("n_q"),
            d["pg"].alias("pg"), d["ph"].alias("ph"), d["phe"].alias("phe"), d["ph2"].alias("ph2"))

    return with_model.select(species_id, F.col("_s.mass").alias("mass"), F.transform("_model", pack).alias("depths"))


def line_depths(lines: DataFrame, packed: DataFrame, wave: str = "wave", species_id: str = "species_id",
                b_lo: str | None = None, b_up: str | None = None) -> DataFrame:
    """lines with the arrays a, dnud, kappa0, emis0 over depth. lines: gf, chi_low and the columns of damping_gamma (recipe,
    gam_rad, fdamp, log_c6, sigma, alpha); b_lo and b_up name arrays of departure coefficients (1 without them)."""
    joined = lines.join(maybe_broadcast(packed), species_id)
    cm = F.col(wave) * 1e-8
    c = F.col

    def at(d: Column, i: Column) -> Column:
        dnud = d["xi0"] / cm
        stim = 1 - F.exp(-(H_PLANCK * C_LIGHT / BOLTZ) / cm / d["temp"])
        gamma = damping_gamma(c("recipe"), d["temp"], d["pg"], d["ph"], d["phe"], d["ph2"], c("mass"), c("gam_rad"), c("fdamp"),
                              c("log_c6"), c("sigma"), c("alpha"))
        low = F.element_at(b_lo, i + 1) if b_lo else F.lit(1.0)
        up = F.element_at(b_up, i + 1) if b_up else F.lit(1.0)
        base = LINE_CONST * c("gf") * d["n_q"] * F.pow(F.lit(10.0), -c("chi_low") * d["theta"]) / dnud / d["ross"]
        return F.struct(dnud.alias("dnud"), damping_a(gamma, dnud).alias("a"),
                        (base * low * (1 + (stim - 1) * up / low)).alias("kappa0"), (base * stim * up).alias("emis0"))

    z = joined.withColumn("_z", F.transform("depths", at)).drop("depths", "mass")
    return z.withColumns({n: c(f"_z.{n}") for n in ("a", "dnud", "kappa0", "emis0")}).drop("_z")


def continuum_beside(lines: DataFrame, wave: str, continuum: DataFrame, payload: Sequence[str], x: str = "x") -> DataFrame:
    """lines with the payload (arrays over depth) of the continuum row next above the line: the first row for lines at or below it,
    the last for lines at or past that. One search a line, however many depths there are."""
    table = neighbours(arrange(continuum.select(x, *payload), (), [x]), [x, *payload]).done()
    rows = table.withColumns({"_hi": F.col(f"next_{x}"), "_lowest": F.col(f"prev_{x}").isNull()})
    hit = attach_interval(lines, wave, rows, x, (), [x, "_lowest", *payload, *[f"next_{p}" for p in payload]])
    own = (F.col(wave) <= F.col(f"_hit.{x}")) & F.col("_hit._lowest")
    return hit.withColumns({p: F.when(own, F.col(f"_hit.{p}")).otherwise(
        F.coalesce(F.col(f"_hit.next_{p}"), F.col(f"_hit.{p}"))) for p in payload}).drop("_hit")


# --- sums in blocks ------------------------------------------------------------------------

def spans(x0: np.ndarray, n: np.ndarray, red: np.ndarray, blue: np.ndarray, mode: str) -> tuple[np.ndarray, np.ndarray]:
    """First and last point of each line, from its place in steps, the points of its segment, and how many points reach eps on
    either side. symmetric: exactly those. compat: the walk includes the first point that fails; the blue side takes two points more than
    the red one unless that ran into the end, and is then walked itself."""
    base, last = np.floor(x0).astype(np.int64), n - 1
    if mode == "symmetric":
        return np.maximum(base + 1 - blue, 0), np.minimum(base + red, last)
    if mode != "compat":
        raise ValueError(f"unknown mode {mode}")
    first, beyond, left = np.minimum(base + 1, last), base + 1 > last, x0 <= 0
    reached = np.where(red > 0, base + red, np.where((x0 == 0) & (blue > 0), 0, -1))
    ended = np.where(beyond, base - blue + 1 <= last, base + red >= last)
    lo = np.where(ended, np.maximum(np.minimum(base - blue, first - 1), 0), np.maximum(first - np.where(beyond, 1, red + 1) - 2, 0))
    hi = np.where(beyond, last, np.minimum(base + red + 1, last))
    return np.where(left, 0, lo), np.where(left, np.minimum(np.maximum(reached, -1) + 1, last), hi)


class Blocks:
    """Accumulators (points x depths of opacity and emissivity) by (segment, block), the least recently used flushed first."""

    def __init__(self, depths: int):
        self.depths, self.held = depths, {}
        self.most = max(2, HELD_BYTES // (16 * depths * BLOCK))

    def add(self, seg: object, block: int, place: np.ndarray, kappa: np.ndarray, emis: np.ndarray) -> None:
        sums = self.held.pop((seg, block), None)
        if sums is None:
            sums = (np.zeros((2, BLOCK * self.depths)), np.zeros(BLOCK, bool))
        self.held[seg, block] = sums  # last in order: used last
        at = (place[:, None] * self.depths + np.arange(self.depths)).ravel()
        for total, value in zip(sums[0], (kappa, emis)):
            total += np.bincount(at, value.ravel(), BLOCK * self.depths)
        sums[1][place] = True

    def flushed(self, most: int) -> Iterator[tuple[object, np.ndarray, np.ndarray]]:
        """(segment, points, sums of (2, points, depths)) of blocks until no more than `most` are held."""
        while len(self.held) > most:
            (seg, block), (sums, seen) = next(iter(self.held.items()))
            del self.held[seg, block]
            place = np.flatnonzero(seen)
            yield seg, block * BLOCK + place, sums.reshape(2, BLOCK, self.depths)[:, place]


def block_opacity(placed: DataFrame, wave: str, eps: float, mode: str = "symmetric", scattering: float = 0.0,
                  seg_id: str = "seg_id") -> DataFrame:
    """seg_id, j (point of the segment, from 0), k, kappa, sigma, emissivity: line opacity summed over all lines.

    placed: lines with seg_id, start, step, n and equally long arrays a, dnud, ratio (peak over continuum), kappa0, emis0 over
    depth. Lines are dealt by wavelength (equal wavelengths by a hash), so a task adds neighbouring lines into the same few blocks
    and no row is made before lines are summed; blocks at the border of two tasks are added afterwards."""
    arrays = ["a", "dnud", "ratio", "kappa0", "emis0"]
    slim = placed.select(seg_id, F.col(wave).cast("double").alias("wave"), "start", "step", "n", *arrays).dropna()
    spark = placed.sparkSession
    tasks = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    # a number of its own: a line is small and its evaluation long, so tasks are not to be joined by size
    dealt = slim.repartitionByRange(tasks, "wave", F.xxhash64(*arrays)).sortWithinPartitions("wave")
    fields = T.StructType([placed.schema[seg_id]]).add("j", "long").add("k", "integer").add("kappa", "double").add("emissivity", "double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks: Blocks | None = None
        kind = None

        def rows(most: int) -> Iterator[pa.RecordBatch]:
            for seg, points, sums in blocks.flushed(most):
                d = blocks.depths
                yield pa.RecordBatch.from_arrays(
                    [pa.array([seg], kind).take(pa.array(np.zeros(len(points) * d, np.int64))), pa.array(np.repeat(points, d)),
                     pa.array(np.tile(np.arange(d, dtype=np.int32), len(points))), pa.array(sums[0].ravel()), pa.array(sums[1].ravel())],
                    names=fields.names)

        for batch in batches:
            if not batch.num_rows:
                continue
            kind = batch.schema.field(0).type
            seg, numbers = batch.column(0).to_pylist(), {}
            code = np.array([numbers.setdefault(x, len(numbers)) for x in seg], np.int64)
            lam, start, step, n = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(1, 5))
            lengths = batch.column(5).value_lengths().to_numpy()
            depths = int(lengths[0])
            packed = [batch.column(i).flatten().to_numpy(zero_copy_only=False) for i in range(5, 10)]
            if (lengths != depths).any() or any(len(p) != len(lam) * depths for p in packed) or (blocks and blocks.depths != depths):
                raise ValueError("all lines need arrays of the same depths")
            a, dnud, ratio, kappa0, emis0 = (p.reshape(len(lam), depths) for p in packed)
            blocks = blocks or Blocks(depths)
            x0 = (lam - start) / step
            red, blue = _passing(lam, x0, list(a), list(dnud), list(ratio), step, n, eps)
            lo, hi = spans(x0, n, red, blue, mode)
            for li, j in _pairs(lo, hi, max(1, PAIRS // depths)):
                v = (start[li] + j * step[li] - lam[li])[:, None] * (C_ANGSTROM / (lam[li] * lam[li]))[:, None] / dnud[li]
                h = voigt_np(a[li], v)
                kappa, emis, block = kappa0[li] * h, emis0[li] * h, j // BLOCK
                own = code[li] * (block.max() + 1) + block
                for one in np.unique(own):
                    m = np.flatnonzero(own == one)
                    blocks.add(seg[li[m[0]]], int(block[m[0]]), j[m] - block[m] * BLOCK, kappa[m], emis[m])
            yield from rows(blocks.most)
        if blocks:
            yield from rows(0)

    total = dealt.mapInArrow(run, fields).groupBy(seg_id, "j", "k").agg(F.sum("kappa").alias("_k"), F.sum("emissivity").alias("emissivity"))
    return total.select(seg_id, "j", "k", (F.col("_k") * (1.0 - scattering)).alias("kappa"), (F.col("_k") * scattering).alias("sigma"),
                        "emissivity")


def _pairs(lo: np.ndarray, hi: np.ndarray, most: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(line, point) pairs of the spans, about `most` at a time; long spans are cut into pieces first."""
    live = np.flatnonzero(hi >= lo)
    pieces = (hi[live] - lo[live]) // PIECE + 1
    line = np.repeat(live, pieces)
    nth = np.arange(len(line)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    a = lo[line] + nth * PIECE
    size = np.minimum(hi[line] - a + 1, PIECE)
    group = (np.cumsum(size) - size) // most
    edges = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1], [True]))) if len(line) else []
    for s, e in zip(edges[:-1], edges[1:]):
        li = np.repeat(line[s:e], size[s:e])
        j = np.repeat(a[s:e], size[s:e]) + np.arange(len(li)) - np.repeat(np.cumsum(size[s:e]) - size[s:e], size[s:e])
        yield li, j
