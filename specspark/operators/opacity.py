"""Line opacity on a wavelength grid: every line reaches as far as it matters, sums are pre-aggregated."""

from __future__ import annotations

import tempfile
from collections.abc import Iterator, Mapping, Sequence
from functools import reduce
from operator import and_

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from specspark.functions.physics import LINE_CONST, planck, voigt_np, with_voigt

C_ANGSTROM = 2.9979e18  # speed of light in Angstrom per second
REACH_BLOCK = 4096
PEAK_VALUES = 1 << 20  # profiles of points and depths evaluated at once
HELD_BYTES = 1 << 25  # rows of one name that a task holds; more of them wait in a file


def line_strength(df: DataFrame) -> DataFrame:
    """kappa0 and emis0: the factors of the profile in opacity and emissivity (per reference opacity).

    Needs gf, n_low, stim, dnud, ross and optionally b_lo, b_up (1 where missing).
    """
    b_lo = F.col("b_lo") if "b_lo" in df.columns else F.lit(1.0)
    b_up = F.col("b_up") if "b_up" in df.columns else F.lit(1.0)
    base = LINE_CONST * F.col("gf") * F.col("n_low") / F.col("dnud") / F.col("ross")
    return df.withColumns({
        "kappa0": base * b_lo * (1 + (F.col("stim") - 1) * b_up / b_lo),
        "emis0": base * F.col("stim") * b_up,
    })


def _passing(lam0: np.ndarray, x0: np.ndarray, a: list, dnud: list, ratio: list, step: float | np.ndarray,
             n: int | np.ndarray, eps: float) -> tuple[np.ndarray, np.ndarray]:
    """How many grid points in a row, red and blue of each line, have ratio*H(a, v) >= eps at some depth.

    step and n are those of the grid, or of each line's own piece of it; x0 is the line position in grid steps; red starts at floor(x0)+1, blue at floor(x0).  H falls with
    |v|, so the count is found by doubling and halving over the index, for all lines together.
    """
    sizes = np.array([len(v) for v in a])
    return _passing_flat(lam0, x0, sizes, *(np.concatenate([np.asarray(v, float) for v in col]) for col in (a, dnud, ratio)), step, n, eps)


def _passing_flat(lam0: np.ndarray, x0: np.ndarray, sizes: np.ndarray, a_: np.ndarray, d_: np.ndarray, r_: np.ndarray,
                  step: float | np.ndarray, n: int | np.ndarray, eps: float) -> tuple[np.ndarray, np.ndarray]:
    """The same with the arrays of all lines one after another, as many values each as sizes says."""
    line = np.repeat(np.arange(len(sizes)), sizes)
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    scale = np.broadcast_to(step, lam0.shape)[line] * C_ANGSTROM / (lam0[line] ** 2) / d_
    most = np.int64(n + 2) + np.ceil(np.abs(np.where(x0 < 0, x0, np.maximum(x0 - n, 0)))).astype(np.int64)

    def passes(count: np.ndarray, first: np.ndarray, way: int, todo: np.ndarray) -> np.ndarray:
        """Does the count-th point on a side still reach eps?  Only asked for the lines in todo."""
        ok = np.zeros(len(count), bool)
        use = todo[line]
        dist = np.abs(first + way * (count - 1) - x0)[line][use]
        peak = np.full(len(line), -1.0)
        peak[use] = r_[use] * voigt_np(a_[use], dist * scale[use])
        ok[sizes > 0] = np.maximum.reduceat(peak, starts[sizes > 0]) >= eps
        return ok & todo

    out = []
    base = np.floor(x0)
    for first, way in ((base + 1, 1), (base, -1)):
        low, high = np.zeros(len(sizes), np.int64), np.ones(len(sizes), np.int64)
        growing = np.ones(len(sizes), bool)
        while growing.any():
            ok = passes(high, first, way, growing)
            low = np.where(ok, high, low)
            growing = ok & (high < most)
            high = np.where(growing, np.minimum(high * 2, most), high)
        high = np.where(low == high, high + 1, high)
        open_ = high - low > 1
        while open_.any():
            mid = (low + high) // 2
            ok = passes(mid, first, way, open_)
            low, high = np.where(open_ & ok, mid, low), np.where(open_ & ~ok, mid, high)
            open_ = high - low > 1
        out.append(low)
    return out[0], out[1]


def _floats(batch: pa.RecordBatch, name: str) -> np.ndarray:
    """A column as floats; the arrays of a list column one after another.  Nulls are NaN."""
    col = batch.column(name)
    return (col.flatten() if pa.types.is_nested(col.type) else col).cast(pa.float64()).to_numpy(zero_copy_only=False)


def _sizes(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return batch.column(name).value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)


def with_passing(lines: DataFrame, wave: str, start: float, step: float, n: int, eps: float, keep: Sequence[str] = ()) -> DataFrame:
    """Adds n_red and n_blue (see _passing) from the depth arrays a, dnud, ratio.  keep: only these columns are returned beside them."""
    kept = lines.select(*keep) if keep else lines
    names = kept.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                lam0 = _floats(batch, wave)
                counts = _passing_flat(lam0, (lam0 - start) / step, _sizes(batch, "a"), *(_floats(batch, c) for c in ("a", "dnud", "ratio")),
                                       step, n, eps)
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), *map(pa.array, counts)], [*names, "n_red", "n_blue"])

    fields = ", ".join(f"`{c}` {t}" for c, t in kept.dtypes)
    return lines.mapInArrow(run, f"{fields}, n_red bigint, n_blue bigint")


def _cuts(cost: np.ndarray, most: int) -> list[tuple[int, int]]:
    """Neighbours put together: (first, end) of runs that begin within the same `most` of the summed cost."""
    part = (np.cumsum(cost) - cost) // most
    edges = np.flatnonzero(np.concatenate(([True], part[1:] != part[:-1], [True])))
    return list(zip(edges[:-1].tolist(), edges[1:].tolist()))


def _points(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """(row, j) of the points _from to _to of each row."""
    first, last = (batch.column(c).to_numpy() for c in ("_from", "_to"))
    counts = last - first + 1
    row = np.repeat(np.arange(len(counts)), counts)
    return row, np.arange(len(row)) - (np.cumsum(counts) - counts - first)[row]


def _own_peaks(batch: pa.RecordBatch, wave: str, start: float, step: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, j, largest ratio of the row over depth there) as the maximum of ratio_k has it: without nulls, NaN above all."""
    row, j = _points(batch)
    lam0, sizes = _floats(batch, wave), _sizes(batch, "a")
    a, dnud, ratio = (_floats(batch, c) for c in ("a", "dnud", "ratio"))
    null = reduce(np.logical_or, (batch.column(c).flatten().is_null().to_numpy(zero_copy_only=False) for c in ("a", "dnud", "ratio")))
    depths = sizes[row]
    begin = np.cumsum(depths) - depths
    point = np.repeat(np.arange(len(row)), depths)
    at = row[point]
    z = np.arange(len(point)) - (begin - (np.cumsum(sizes) - sizes)[row])[point]
    v = np.abs(start + j[point] * step - lam0[at]) * C_ANGSTROM / (lam0 * lam0)[at] / dnud[z]
    values = np.where(np.isnan(a[z] + v), np.nan, ratio[z] * voigt_np(a[z], v))
    values[null[z]] = -np.inf
    peaks = np.full(len(row), -np.inf)
    if len(values):
        peaks[depths > 0] = np.maximum.reduceat(values, begin[depths > 0])
    return row, j, peaks


class _Name:
    """The rows of one name as they come and the largest ratio at each of their points."""

    def __init__(self) -> None:
        self.rows: list[pa.RecordBatch] = []
        self.held = 0
        self.file = self.writer = None
        self.first, self.best = 0, np.empty(0)

    def add(self, batch: pa.RecordBatch, j: np.ndarray, peaks: np.ndarray) -> None:
        lo, hi = int(j.min()), int(j.max()) + 1
        if len(self.best):
            lo, hi = min(lo, self.first), max(hi, self.first + len(self.best))
        if hi - lo > len(self.best):
            best = np.full(hi - lo, -np.inf)
            best[self.first - lo:self.first - lo + len(self.best)] = self.best
            self.first, self.best = lo, best
        np.maximum.at(self.best, j - self.first, peaks)
        self.rows.append(batch)
        self.held += batch.nbytes
        if self.held > HELD_BYTES:
            if self.file is None:
                self.file = tempfile.TemporaryFile()
                self.writer = pa.ipc.new_stream(self.file, batch.schema, options=pa.ipc.IpcWriteOptions(compression="lz4"))
            for b in self.rows:
                self.writer.write_batch(b)
            self.rows, self.held = [], 0

    def all_rows(self) -> Iterator[pa.RecordBatch]:
        if self.file is not None:
            self.writer.close()
            self.file.seek(0)
            with pa.ipc.open_stream(self.file) as reader:
                yield from reader
            self.file.close()
        yield from self.rows


def with_peaks(lines: DataFrame, wave: str, start: float, step: float, keep: Sequence[str]) -> DataFrame:
    """The columns keep and _from, and _peaks: at each point from _from to _to, the largest ratio over the depths of all rows of the name.

    The rows of a name come one after another with _i = 1 to _m, from arrays a, dnud, ratio.  A task holds those of one name, as far
    as HELD_BYTES, and evaluates about PEAK_VALUES at once.
    """
    names = [*keep, "_from"]

    def result(batch: pa.RecordBatch, peaks: np.ndarray) -> pa.RecordBatch:
        counts = batch.column("_to").to_numpy() - batch.column("_from").to_numpy() + 1
        offsets = pa.array(np.concatenate(([0], np.cumsum(counts))), pa.int32())
        return pa.RecordBatch.from_arrays([*(batch.column(c) for c in names),
                                           pa.ListArray.from_arrays(offsets, pa.array(peaks, mask=np.isneginf(peaks)))], [*names, "_peaks"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name = _Name()
        for batch in batches:
            if not batch.num_rows:
                continue
            i, m = (batch.column(c).to_numpy() for c in ("_i", "_m"))
            cost = (batch.column("_to").to_numpy() - batch.column("_from").to_numpy() + 1) * np.maximum(_sizes(batch, "a"), 1)
            edges = np.unique(np.concatenate(([0], np.flatnonzero(i == 1), [len(i)])))
            first, end = edges[:-1], edges[1:]
            total = np.add.reduceat(cost, first)
            small = (i[first] == 1) & (i[end - 1] == m[end - 1]) & (total <= PEAK_VALUES)
            for s, e in zip(first[~small].tolist(), end[~small].tolist()):  # names that go on over batches, or are large
                if i[s] == 1:
                    name = _Name()
                for x, y in _cuts(cost[s:e], PEAK_VALUES):
                    some = batch.slice(s + x, y - x)
                    name.add(some, *_own_peaks(some, wave, start, step)[1:])
                if i[e - 1] == m[e - 1]:
                    for some in name.all_rows():
                        yield result(some, name.best[_points(some)[1] - name.first])
            if not small.any():
                continue
            whole = batch if small.all() else batch.filter(pa.array(np.repeat(small, end - first)))
            lengths = (end - first)[small]
            borders = np.concatenate(([0], np.cumsum(lengths)))
            for x, y in _cuts(total[small], PEAK_VALUES):
                some = whole.slice(borders[x], borders[y] - borders[x])
                row, j, peaks = _own_peaks(some, wave, start, step)
                twice = np.flatnonzero(np.repeat(lengths[x:y] > 1, lengths[x:y])[row])
                if len(twice):
                    of = np.repeat(np.arange(y - x), lengths[x:y])[row[twice]]
                    _, at = np.unique(of * (int(j.max()) + 1) + j[twice], return_inverse=True)
                    best = np.full(at.max() + 1, -np.inf)
                    np.maximum.at(best, at, peaks[twice])
                    peaks[twice] = best[at]
                yield result(some, peaks)

    fields = ", ".join(f"`{c}` {t}" for c, t in lines.select(*keep).dtypes)
    return lines.mapInArrow(run, f"{fields}, _from bigint, _peaks array<double>")


def line_points(lines: DataFrame, wave: str, start: float, step: float, n: int, eps: float,
                mode: str = "symmetric", cluster: Sequence[str] = (), peak: bool = False,
                depth: Mapping[str, Column] | None = None) -> DataFrame:
    """One row per line and grid point j (wave_j = start + j*step, 0 <= j < n) that the line contributes to.

    symmetric: every point whose largest ratio over depth is >= eps.  compat: the walk outward includes
    the first point below eps; the blue side copies the number of points of the red side plus two unless
    the red side ran into the end of the grid; lines outside the grid are walked from its first or last
    point.  A line never becomes one big row: its range is cut into blocks of REACH_BLOCK points.

    cluster: the columns that name a line, for results by line: its points are then made where its group is.
    peak: adds the largest ratio at the point over the depths of all lines of the name.  It is found where these lines meet, so
    that nothing is shuffled or sorted by point; lines with a null in their name are left out.
    depth: the depth arrays as expressions, if lines don't have them; with peak they are made anew after the shuffle.
    """
    given, depth = lines.columns, dict(depth or {})
    peaked = {c: x for c, x in depth.items() if c in ("a", "dnud", "ratio")}
    if peak and not cluster:
        raise ValueError("peaks are those of a name: cluster is needed")
    lines = lines.filter(reduce(and_, [F.col(c).isNotNull() for c in cluster])).withColumns(peaked) if peak else lines.withColumns(depth)
    if peak:
        df = with_passing(lines, wave, start, step, n, eps, given)
    elif cluster:  # one row a line is shuffled, not one for each of its points
        df = with_passing(lines, wave, start, step, n, eps).repartition(*cluster)
    else:
        # neighbouring lines share a task, so partial sums over the grid collapse; equal wavelengths are
        # spread by the hash
        names = [c for c, t in lines.dtypes if not t.startswith("array")]
        df = lines.repartitionByRange(F.col(wave), F.xxhash64(*names))
        df = with_passing(df, wave, start, step, n, eps)
    base = F.floor((F.col(wave) - start) / step)
    red, blue, last = F.col("n_red"), F.col("n_blue"), n - 1
    whole = (F.col(wave) - start) / step
    if mode == "symmetric":
        lo, hi = F.greatest(base + 1 - blue, F.lit(0)), F.least(base + red, F.lit(last))
    elif mode == "compat":
        first = F.least(base + 1, F.lit(last))
        # left of the grid: from its first point on
        reached = F.when(red > 0, base + red).when((whole == 0) & (blue > 0), 0).otherwise(-1)
        left_hi = F.least(F.greatest(reached, F.lit(-1)) + 1, F.lit(last))
        # the red walk ran into the end: the blue walk is tested point by point
        beyond = base + 1 > last
        hit_end = F.when(beyond, base - blue + 1 <= last).otherwise(base + red >= last)
        walked = F.greatest(F.least(base - blue, first - 1), F.lit(0))
        stop = F.when(beyond, F.lit(last)).otherwise(F.least(base + red + 1, F.lit(last)))
        mirrored = F.greatest(first - F.when(beyond, 1).otherwise(red + 1) - 2, F.lit(0))
        lo = F.when(whole <= 0, 0).when(hit_end, walked).otherwise(mirrored)
        hi = F.when(whole <= 0, left_hi).otherwise(stop)
    else:
        raise ValueError(f"unknown mode {mode}")
    df = df.withColumns({"_lo": lo.cast("bigint"), "_hi": hi.cast("bigint")}).filter("_hi >= _lo")
    blocks = F.sequence(F.floor(F.col("_lo") / REACH_BLOCK), F.floor(F.col("_hi") / REACH_BLOCK))
    df = df.withColumn("_b", F.explode(blocks))
    from_, to = F.greatest("_lo", F.col("_b") * REACH_BLOCK), F.least("_hi", (F.col("_b") + 1) * REACH_BLOCK - 1)
    if peak:
        df = df.select(*given, from_.alias("_from"), to.alias("_to"))
        by = Window.partitionBy(*cluster).orderBy("_from")
        whole_name = by.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        df = df.withColumns({"_i": F.row_number().over(by), "_m": F.count(F.lit(1)).over(whole_name)})
        df = with_peaks(df.withColumns(peaked), wave, start, step, given).withColumns(depth)
        return df.select("*", F.posexplode("_peaks").alias("_p", "peak")).withColumn("j", F.col("_from") + F.col("_p")).drop("_from", "_peaks", "_p")
    return df.withColumn("j", F.explode(F.sequence(from_, to))).drop("_lo", "_hi", "_b", "n_red", "n_blue")


def line_opacity(lines: DataFrame, wave: str, start: float, step: float, n: int, eps: float,
                 mode: str = "symmetric", extra: Sequence[str] = (), cluster: Sequence[str] = (), peak: bool = False,
                 depth: Mapping[str, Column] | None = None) -> DataFrame:
    """Contribution rows (j, k, profile, kappa, ratio_k, emissivity) of every line at its grid points and depths.

    ``lines`` carries one row per line with equally long depth arrays a, dnud, ratio (peak strength over
    continuum), kappa0 and emis0, so a line is multiplied by wavelength first and by depth last.
    cluster (some of extra): see ``line_points``; what groups by these columns and more needs no further shuffle.
    peak, depth: see there too; the column peak is marked with the cluster it holds for, so that ``strength_cut`` knows it.
    """
    pts = line_points(lines, wave, start, step, n, eps, mode, cluster, peak, depth)
    depths = F.posexplode(F.arrays_zip("a", "dnud", "ratio", "kappa0", "emis0")).alias("k", "_z")
    found = ["peak"] if peak else []
    rows = pts.select(*extra, F.col(wave), "j", *found, depths).select(*extra, wave, "j", *found, "k", "_z.*")
    lam = F.lit(start) + F.col("j") * F.lit(step)
    v = (lam - F.col(wave)) * C_ANGSTROM / (F.col(wave) * F.col(wave)) / F.col("dnud")
    rows = with_voigt(rows, F.col("a"), v, "profile")
    found = [F.col(c).alias(c, metadata={"name": sorted(cluster)}) for c in found]
    return rows.select(*extra, "j", *found, "k", "profile", (F.col("kappa0") * F.col("profile")).alias("kappa"),
                       (F.col("ratio") * F.col("profile")).alias("ratio_k"),
                       (F.col("emis0") * F.col("profile")).alias("emissivity"))


def opacity_sum(contrib: DataFrame, key: Sequence[str] = ("k", "j"), scattering: float = 0.0) -> DataFrame:
    """Sum over lines per depth and wavelength, split into absorption and scattering.  The partial sums
    are formed before the shuffle, so a crowded wavelength is as cheap as any other."""
    total = F.sum("kappa")
    return contrib.groupBy(*key).agg((total * (1.0 - scattering)).alias("kappa"),
                                     (total * scattering).alias("sigma"), F.sum("emissivity").alias("emissivity"))


def peak_ratio(contrib: DataFrame, line: Sequence[str], point: str = "j") -> DataFrame:
    """Largest line-to-continuum ratio over depth per line and grid point."""
    return contrib.groupBy(*line, point).agg(F.max("ratio_k").alias("peak"))


def strength_cut(contrib: DataFrame, line: Sequence[str], eps: float = 1e-4, point: str = "j") -> DataFrame:
    """Contributions of the (line, point) pairs whose peak ratio reaches eps; pairs with a null are left out.

    Contributions that carry the peak of their pair (``line_opacity`` with peak, cluster = line) are neither shuffled nor sorted;
    that peak is the one of all of the pair's contributions, also if some have been filtered out since.
    """
    pair = [*line, point]
    named = contrib.filter(reduce(and_, [F.col(c).isNotNull() for c in pair]))
    if any(f.name == "peak" and f.metadata.get("name") == sorted(line) for f in contrib.schema.fields) and point == "j":
        return named.filter(F.col("peak") >= eps).drop("peak")
    # contributions are computed and sorted once, which a join with their peaks would do twice
    return named.withColumn("_peak", F.max("ratio_k").over(Window.partitionBy(*pair))).filter(F.col("_peak") >= eps).drop("_peak")


def total_opacity(line: DataFrame, continuum: DataFrame, key: Sequence[str] = ("k", "j")) -> DataFrame:
    """Line plus continuum, absorption and scattering separately; either may be missing at a point."""
    cols = [*key, "kappa", "sigma"]
    return line.select(*cols).unionByName(continuum.select(*cols)).groupBy(*key).agg(
        F.sum("kappa").alias("kappa"), F.sum("sigma").alias("sigma"))


def source_function(op: DataFrame, temp: Column | None = None, wave: Column | None = None,
                    cont: str | None = None) -> DataFrame:
    """s_line = emissivity*B/kappa (0 where there is no opacity) and, with a continuum column, the mean
    of both source functions weighted by their opacities."""
    b = planck(temp, wave) if temp is not None else F.lit(1.0)
    s_line = F.when(F.col("kappa") > 0, F.col("emissivity") * b / F.col("kappa")).otherwise(0.0)
    df = op.withColumn("s_line", s_line)
    if cont is None:
        return df
    kc = F.col(cont)
    return df.withColumn("s_total", F.try_divide(F.col("s_line") * F.col("kappa") + b * kc, F.col("kappa") + kc))
