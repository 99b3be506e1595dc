"""Spectra: widths, fluxes, photometry, convolution, limb profiles, curve of growth."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from specspark.functions.names import LIGHT_KMS
from specspark.operators.layout import ROWS_PER_CHUNK, arrange, neighbours, small_table
from specspark.operators.series import hermite_area, interp_linear, interp_newton3

PACKED_EW_TAIL = 1e-4
MAX_CHUNK_ROWS = 500_000


# --- equivalent width ------------------------------------------------------------------

def equivalent_width(df: DataFrame, key: Sequence[str], wave: str = "wave", flux: str = "flux",
                     rows_per_chunk: int = ROWS_PER_CHUNK) -> DataFrame:
    """Trapezoids of 1 - flux, starting from 0 one step before the first point and with half a step
    after the last; open_wing warns when the last point is still deeper than 1e-4."""
    lay = neighbours(arrange(df, key, [wave], rows_per_chunk), [wave])
    behind, ahead = F.col(wave) - F.col(f"prev_{wave}"), F.col(f"next_{wave}") - F.col(wave)
    weight = (F.coalesce(behind, ahead) + F.coalesce(ahead, behind)) / 2
    depth = 1 - F.col(flux)
    out = lay.df.groupBy(*lay.key).agg(F.sum(depth * weight).alias("eqw"), F.max_by(depth, F.col(wave)).alias("_last"))
    return out.withColumn("open_wing", F.col("_last") > PACKED_EW_TAIL).drop("_last", *lay.added)


def _step_weights(wave: Column) -> Column:
    """Half-sum of both steps of a packed wavelength array; an end counts its only step twice."""
    def weight(x: Column, i: Column) -> Column:
        behind, ahead = x - F.get(wave, i - 1), F.get(wave, i + 1) - x
        return (F.coalesce(behind, ahead) + F.coalesce(ahead, behind)) / 2
    return F.transform(wave, weight)


def equivalent_width_packed(df: DataFrame, wave: str = "wave", flux: str = "flux") -> DataFrame:
    """The same for one spectrum per row (arrays): no row leaves its partition."""
    parts = F.zip_with(F.transform(flux, lambda f: 1 - f), _step_weights(F.col(wave)), lambda p, w: p * w)
    return df.withColumns({
        "eqw": F.aggregate(parts, F.lit(0.0), lambda acc, v: acc + v),
        "open_wing": 1 - F.element_at(flux, -1) > PACKED_EW_TAIL,
    })


# --- flux ------------------------------------------------------------------------------

def flux_from_intensity(intensity: DataFrame, key: Sequence[str], nodes: DataFrame, node: str = "i",
                        line: str = "i_line", cont: str = "i_cont") -> DataFrame:
    """2 pi * sum of w*mu*I over the Gauss nodes for line and continuum, and their ratio."""
    table = F.broadcast(nodes.select(F.col("i").alias(node), F.col("node").alias("_mu"), F.col("weight").alias("_w")))
    term = lambda c: F.sum(F.col("_w") * F.col("_mu") * F.col(c)) * (2 * np.pi)
    out = intensity.join(table, node).groupBy(*key).agg(term(line).alias("flux_abs"), term(cont).alias("_cont"))
    return out.withColumn("flux_norm", F.try_divide(F.col("flux_abs"), F.col("_cont"))).drop("_cont")


def spline_quadrature(df: DataFrame, key: Sequence[str], x: str, f: str, out: str = "integral",
                      rows_per_chunk: int = ROWS_PER_CHUNK) -> DataFrame:
    """Trapezoids with a slope correction on a non-uniform grid; the slope at the last x is zero and the
    one before it twice the last secant."""
    lay = neighbours(arrange(df, key, [x], rows_per_chunk), [x, f])
    lay = neighbours(lay, [f"next_{x}", f"next_{f}"], before=False)
    nx, px, nf, pf = (F.col(f"{s}_{c}") for c in (x, f) for s in ("next", "prev"))
    nnx, nnf = F.col(f"next_next_{x}"), F.col(f"next_next_{f}")
    secant = (nf - F.col(f)) / (nx - F.col(x))
    bend = ((nnf - nf) / (nnx - nx) - secant) / (nnx - F.col(x))
    three_point = secant - bend * (nx - F.col(x))
    slope = (F.when(nx.isNull(), 0.0).when(px.isNull(), three_point).when(nnx.isNull(), 2 * secant)
             .otherwise((nf - pf) / (nx - px)))
    lay = neighbours(lay.with_columns({"_d": slope}), ["_d"], after=False)
    piece = hermite_area(F.col(x) - px, pf, F.col(f), F.col("prev__d"), F.col("_d"))
    return lay.df.groupBy(*lay.key).agg(F.sum(piece).alias(out)).drop(*lay.added)


# --- photometry ------------------------------------------------------------------------

# fixed values: transmission of each band on 100 Angstrom steps (K on 200) from the given wavelength
BAND_START = {"U": 3000, "B": 3500, "V": 4700, "R": 5300, "I": 6900, "J": 9700, "K": 18100}
BAND_U = (0.145, 0.436, 0.910, 1.385, 1.843, 2.126, 2.305, 2.241, 1.270, 0.360, 0.128, 0.028)
BAND_B = (0.003, 0.026, 0.179, 0.612, 1.903, 2.615, 2.912, 3.005, 2.990, 2.876, 2.681, 2.388, 2.058, 1.725, 1.416,
          1.135, 0.840, 0.568, 0.318, 0.126, 0.019)
BAND_V = (0.006, 0.077, 0.434, 1.455, 2.207, 2.703, 2.872, 2.738, 2.505, 2.219, 1.890, 1.567, 1.233, 0.918, 0.680,
          0.474, 0.312, 0.200, 0.132, 0.096, 0.069, 0.053, 0.037, 0.022, 0.012)
BAND_R = (0.03, 0.06, 0.17, 0.28, 0.39, 0.50, 0.60, 0.69, 0.74, 0.79, 0.84, 0.88, 0.91, 0.94, 0.96, 0.98, 0.99, 1.00,
          0.97, 0.94, 0.90, 0.85, 0.79, 0.73, 0.65, 0.57, 0.50, 0.42, 0.36, 0.31, 0.24, 0.17, 0.14, 0.11, 0.08, 0.06,
          0.05, 0.04, 0.03, 0.02, 0.02, 0.01, 0.01)
BAND_I = (0.01, 0.01, 0.09, 0.17, 0.26, 0.36, 0.46, 0.56, 0.66, 0.76, 0.86, 0.96, 0.97, 0.98, 0.98, 0.99, 0.99, 1.00,
          0.99, 0.98, 0.96, 0.93, 0.88, 0.84, 0.78, 0.71, 0.64, 0.58, 0.52, 0.47, 0.42, 0.36, 0.32, 0.28, 0.24, 0.20,
          0.18, 0.15, 0.12, 0.10, 0.09, 0.08, 0.06, 0.05, 0.04, 0.03, 0.03, 0.02, 0.02, 0.01, 0.01)
BAND_J = (0.01, 0.02, 0.02, 0.03, 0.04, 0.06, 0.11, 0.16, 0.26, 0.35, 0.49, 0.62, 0.78, 0.93, 0.89, 0.85, 0.82, 0.78,
          0.78, 0.78, 0.79, 0.80, 0.82, 0.85, 0.89, 0.93, 0.84, 0.75, 0.70, 0.64, 0.64, 0.63, 0.63, 0.63, 0.64, 0.66,
          0.67, 0.68, 0.69, 0.70, 0.70, 0.70, 0.68, 0.66, 0.63, 0.60, 0.53, 0.46, 0.37, 0.27, 0.20, 0.14, 0.12, 0.09,
          0.08, 0.06, 0.04, 0.02, 0.01)
BAND_K = (0.01, 0.035, 0.17, 0.30, 0.46, 0.65, 0.90, 0.97, 0.995, 1.00, 0.995, 0.985, 0.975, 0.965, 0.96, 0.955, 0.95,
          0.955, 0.965, 0.97, 0.97, 0.965, 0.955, 0.945, 0.94, 0.945, 0.95, 0.95, 0.955, 0.95, 0.93, 0.88, 0.785, 0.62,
          0.46, 0.27, 0.13, 0.05, 0.01)
BANDS = {"U": BAND_U, "B": BAND_B, "V": BAND_V, "R": BAND_R, "I": BAND_I, "J": BAND_J, "K": BAND_K}
# fixed values: the colours and the bands they compare
COLOURS = {"u_b": "UB", "b_v": "BV", "u_v": "UV", "r_i": "RI", "v_r": "VR", "v_i": "VI", "v_j": "VJ", "v_k": "VK"}


def band_table(spark: SparkSession) -> DataFrame:
    """(band, bin, t, upper): one row per band and 100 Angstrom bin.  Ranges are half open, K also takes
    its upper end."""
    rows = []
    for band, values in BANDS.items():
        width = 2 if band == "K" else 1
        start = BAND_START[band] // 100
        rows += [(band, start + i * width + j, t, float("inf")) for i, t in enumerate(values) for j in range(width)]
        if band == "K":
            rows.append((band, start + len(values) * 2, values[-1], 100.0 * (start + len(values) * 2)))
    return small_table(spark, rows, "band string, bin int, t double, upper double")


def band_flux(spectrum: DataFrame, key: Sequence[str], wave: str = "wave", flux: str = "flux",
              weight: str | None = None) -> DataFrame:
    """Weighted mean flux per band; the band table (about 300 rows) is broadcast on the bin number."""
    bands = F.broadcast(band_table(spectrum.sparkSession))
    w = F.col(weight) if weight else F.lit(1.0)
    rows = spectrum.withColumn("bin", F.floor(F.col(wave) / 100).cast("int")).join(bands, "bin")
    rows = rows.filter(F.col(wave) <= F.col("upper"))
    return rows.groupBy(*key, "band").agg(
        F.sum(w * F.col("t") * F.col(flux)).alias("_s"), F.sum(w * F.col("t")).alias("_n")).select(
        *key, "band", F.try_divide(F.col("_s"), F.col("_n")).alias("flux"))


def magnitude_zero(spectrum: DataFrame, key: Sequence[str], wave: str = "wave", flux: str = "flux",
                   pivot: float = 5000.0) -> DataFrame:
    """m0 per spectrum: -2.5 log10 of the flux at the first wavelength above the pivot (else the last)."""
    beyond = F.when(F.col(wave) > pivot, F.col(wave))
    at = spectrum.groupBy(*key).agg(F.min_by(flux, beyond).alias("_f"), F.max_by(flux, wave).alias("_l"))
    return at.select(*key, (-2.5 * F.log10(F.coalesce("_f", "_l"))).alias("m0"))


def flux_magnitude(spectrum: DataFrame, key: Sequence[str], wave: str = "wave", flux: str = "flux",
                   pivot: float = 5000.0) -> DataFrame:
    zero = magnitude_zero(spectrum, key, wave, flux, pivot)
    return spectrum.join(zero, list(key)).withColumn("mag", -2.5 * F.log10(F.col(flux)) - F.col("m0")).drop("m0")


def colours(bands: DataFrame, zero: DataFrame, key: Sequence[str]) -> DataFrame:
    """Magnitude per band and the eight colours; null where a band has no flux."""
    wide = bands.groupBy(*key).agg(*[F.max(F.when(F.col("band") == b, F.col("flux"))).alias(f"_{b}") for b in BANDS])
    wide = wide.join(zero, list(key))
    mags = {f"mag_{b.lower()}": -2.5 * F.log10(F.col(f"_{b}")) - F.col("m0") for b in BANDS}
    wide = wide.withColumns(mags)
    diffs = {n: F.col(f"mag_{p[0].lower()}") - F.col(f"mag_{p[1].lower()}") for n, p in COLOURS.items()}
    return wide.withColumns(diffs).drop("m0", *[f"_{b}" for b in BANDS])


def apply_filter(spectrum: DataFrame, curve: DataFrame, wave: str = "wave", out: str = "trans") -> DataFrame:
    """Transmission at each wavelength: three-point interpolation on the filter curve (wave, trans)."""
    table = curve.select(F.col(curve.columns[0]).alias("fx"), F.col(curve.columns[1]).alias("fy"))
    return interp_newton3(spectrum, wave, table, "fx", "fy", (), out)


def limb_profile(intensity: DataFrame, key: Sequence[str], curve: DataFrame, n_pos: int, wave: str = "wave",
                 mu: str = "mu", value: str = "i_abs", weight: str = "weight") -> DataFrame:
    """Filter-weighted intensity at n_pos equidistant r/R, with the totals at the centre.

    Per wavelength the intensities relative to mu = 1 are interpolated on mu at the positions; the sum
    over wavelengths is a partial aggregation.
    """
    series = [*key, wave]
    centre = intensity.groupBy(*series).agg(
        F.max_by(value, mu).alias("_centre"), F.first(weight).alias("_w"))
    centre = apply_filter(centre, curve, wave, "_trans")
    rows = intensity.join(centre.select(*series, "_centre"), series) \
        .withColumn("_rel", F.col(value) / F.col("_centre")).select(*series, mu, "_rel")
    places = F.array(*[F.struct(F.lit(i + 1).alias("pos"), F.lit((n_pos - i) / n_pos).alias("r")) for i in range(n_pos)])
    targets = centre.withColumn("_p", F.explode(places)).select(
        *series, "_centre", "_w", "_trans", "_p.pos", "_p.r",
        F.sqrt(F.greatest(1 - F.col("_p.r") * F.col("_p.r"), F.lit(0.0))).alias("_mu"))
    at = interp_newton3(targets, "_mu", rows, mu, "_rel", series, "_y")
    gain = F.col("_w") * F.col("_trans")
    return at.groupBy(*key, "pos").agg(
        F.first("r").alias("r"), F.sum(gain * F.col("_centre") * F.col("_y")).alias("intensity"),
        F.sum(gain * F.col("_centre")).alias("total_intensity"), F.sum(gain).alias("total_trans"))


# --- curve of growth -------------------------------------------------------------------

def abundance_from_ew(curve: DataFrame, obs: DataFrame, line: str, obs_id: Sequence[str], ew: str = "ew",
                      log_factor: str = "log_factor", width: str = "obs_ew", error: str = "obs_err") -> DataFrame:
    """log abundance factor for W, W - err (at least 0.1) and W + err from a tabulated curve of growth,
    log-log linear; beyond the curve 'not_converged', and -30 for a width of zero."""
    table = curve.select(line, F.log10(ew).alias("_lw"), F.col(log_factor).alias("_lf"))
    w, e = F.col(width), F.col(error)
    three = F.array(
        F.struct(F.lit(1).alias("which"), F.when((w > 0) & (e > 0), F.greatest(w - e, F.lit(0.1))).alias("w")),
        F.struct(F.lit(2).alias("which"), w.alias("w")),
        F.struct(F.lit(3).alias("which"), F.when((w > 0) & (e > 0), w + e).alias("w")))
    long = obs.withColumn("_o", F.explode(three)).select(line, *obs_id, "_o.which", "_o.w").filter("w IS NOT NULL")
    seen, zero = long.filter("w > 0"), long.filter("w <= 0")
    hit = interp_linear(seen.withColumn("_x", F.log10("w")), "_x", table, "_lw", "_lf", [line], "_v")
    hit = hit.select(line, *obs_id, "which", F.when(~F.col("extrapolated"), F.col("_v")).alias("log_factor"),
                     F.when(F.col("extrapolated") | F.col("_v").isNull(), "not_converged").otherwise("ok").alias("status"))
    return hit.unionByName(zero.select(line, *obs_id, "which", F.lit(-30.0).alias("log_factor"), F.lit("zero").alias("status")))


def shares(components: DataFrame, key: Sequence[str], value: str, kind: str, wave: str, temp: Column) -> DataFrame:
    """Share of every absorber (times stimulated emission) and scatterer in its total per point."""
    totals = components.groupBy(*key, kind).agg(F.sum(value).alias("_total"))
    rows = components.join(totals, [*key, kind])
    stim = 1 - F.exp(-1.438769e8 / F.col(wave) / temp)
    return rows.withColumn("share", F.try_divide(F.col(value), F.col("_total"))
                           * F.when(F.col(kind) == "absorption", stim).otherwise(1.0)).drop("_total")


# --- convolution -----------------------------------------------------------------------

# fixed values: radial-tangential profile at tenths of its width
RADTAN = (1.128, .939, .773, .628, .504, .399, .312, .240, .182, .133, .101, .070, .052, .037, .024, .017, .012, .010,
          .009, .007, .006, .005, .004, .004, .003, .003, .002, .002, .002, .002, .001, .001, .001, .001, .001, .001)
EXP_RATE, GAUSS_RATE, RADTAN_WIDTH, PROFILE_FLOOR = 1.38629, 1.66511, 1.433, 1e-6
# support of each profile in units of its width
SUPPORT = {"exp": -np.log(PROFILE_FLOOR) / EXP_RATE, "gauss": np.sqrt(-np.log(PROFILE_FLOOR)) / GAUSS_RATE,
           "radtan": 3.5 * RADTAN_WIDTH, "rot": 1.0}


def _profile(kind: str, dl: np.ndarray, width: np.ndarray, wave: np.ndarray) -> np.ndarray:
    """Unnormalised profile at distance dl; 0 outside its support."""
    if kind == "exp":
        p = np.exp(-np.abs(dl) * EXP_RATE / width)
        return np.where(p > PROFILE_FLOOR, p, 0.0)
    if kind == "gauss":
        p = np.exp(-(dl * GAUSS_RATE / width) ** 2)
        return np.where(p > PROFILE_FLOOR, p, 0.0)
    if kind == "radtan":
        step = width * RADTAN_WIDTH / 10
        place = np.abs(dl) / step
        value = np.exp(np.interp(place, np.arange(len(RADTAN)), np.log(RADTAN)))
        return np.where(place <= np.where(dl > 0, 34, 35), value, 0.0)
    eps = 1 - 0.3 * wave / 5000
    inside = np.clip(1 - (dl / width) ** 2, 0, None)
    p = (2 * (1 - eps) * np.sqrt(inside) + np.pi * 0.5 * eps * inside) / (np.pi * width * (1 - eps / 3))
    return np.where(np.abs(dl) <= width, p, 0.0)


def _band(x: np.ndarray, y: np.ndarray, own: np.ndarray, fwhm: float, kind: str) -> np.ndarray:
    """Normalised banded product for the rows ``own`` of the sorted points (x, y[col, point]).

    Weights are half-sums of the steps inside the support, so its end points count half.
    """
    at = x[own]
    width = -fwhm * at / LIGHT_KMS if fwhm < 0 else np.full(at.shape, fwhm / 1000.0)
    red = SUPPORT[kind] * width * (34 / 35 if kind == "radtan" else 1.0)
    tiny = 1e-12 * at
    lo = np.searchsorted(x, at - SUPPORT[kind] * width - tiny, "left")
    hi = np.searchsorted(x, at + red + tiny, "right") - 1
    if kind == "rot":
        alone = lo == hi
        lo, hi = np.where(alone, own - 1, lo), np.where(alone, own + 1, hi)
    else:
        lo, hi = np.minimum(lo, own - 1), np.maximum(hi, own + 1)
    out = np.empty((len(y), len(own)))
    rows = max(1, int(4_000_000 // max(1, (hi - lo).max() + 1)))
    for s in range(0, len(own), rows):
        sl = slice(s, s + rows)
        j = lo[sl, None] + np.arange((hi[sl] - lo[sl]).max() + 1)
        used = j <= hi[sl, None]
        j = np.minimum(j, hi[sl, None])
        behind = np.where(j > lo[sl, None], x[j] - x[np.maximum(j - 1, 0)], 0.0)
        ahead = np.where(j < hi[sl, None], x[np.minimum(j + 1, len(x) - 1)] - x[j], 0.0)
        w = _profile(kind, x[j] - at[sl, None], width[sl, None], at[sl, None]) * (behind + ahead) / 2 * used
        total = w.sum(axis=1)
        for c in range(len(y)):
            out[c, sl] = (w * y[c][j]).sum(axis=1) / total
    return out


def _with_ends(x: np.ndarray, y: np.ndarray, fwhm: float, kind: str, before: float | None = None,
               after: float | None = None, at_start: bool = True, at_end: bool = True):
    """Add the points a band may need beyond x: the neighbouring points of the spectrum, and zeros at the
    end step where x reaches the start or the end of the spectrum.  Returns x, y and the number in front."""
    def zeros(edge: float, step: float) -> np.ndarray:
        width = -fwhm * edge / LIGHT_KMS if fwhm < 0 else fwhm / 1000.0
        return step * np.arange(1, int(np.ceil(1.1 * SUPPORT[kind] * width / step)) + 3)

    front = np.array([before]) if before is not None and before < x[0] and not at_start else np.empty(0)
    back = np.array([after]) if after is not None and after > x[-1] and not at_end else np.empty(0)
    full = np.concatenate([front, x, back])
    if at_start:
        front = (full[0] - zeros(full[0], full[1] - full[0]))[::-1] if len(full) > 1 else full[:1] - 1.0
    if at_end:
        back = full[-1] + zeros(full[-1], full[-1] - full[-2]) if len(full) > 1 else full[-1:] + 1.0
    return np.concatenate([front, x, back]), np.pad(y, ((0, 0), (len(front), len(back)))), len(front)


def sorted_groups(batches: Iterator[pd.DataFrame], key: Sequence[str]) -> Iterator[list[pd.DataFrame]]:
    """The groups of a partition sorted by key; a group that runs over a batch is kept until it ends."""
    rest = None
    for pdf in batches:
        pdf = pdf if rest is None else pd.concat([rest, pdf], ignore_index=True)
        ids = pdf[list(key)]
        starts = np.flatnonzero((ids != ids.shift()).any(axis=1).to_numpy())
        rest = pdf.iloc[starts[-1]:] if len(starts) else None
        if len(starts) > 1:
            yield [pdf.iloc[i:j] for i, j in zip(starts[:-1], starts[1:])]
    if rest is not None and len(rest):
        yield [rest]


def convolve_packed(df: DataFrame, key: Sequence[str], cols: Sequence[str], fwhm: float, profile: str = "gauss",
                    wave: str = "wave") -> DataFrame:
    """Convolve one packed spectrum per row (arrays); fwhm < 0 in km/s, > 0 in milli-Angstrom.  No shuffle."""
    keys, cols, types = list(key), list(cols), dict(df.dtypes)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            done = {c: [] for c in cols}
            for i in range(len(pdf)):
                x = np.asarray(pdf[wave].iloc[i], float)
                y = np.vstack([np.asarray(pdf[c].iloc[i], float) for c in cols])
                xe, ye, front = _with_ends(x, y, fwhm, profile)
                for c, v in zip(cols, _band(xe, ye, np.arange(front, front + len(x)), fwhm, profile)):
                    done[c].append(v)
            yield pdf[[*keys, wave]].assign(**done)

    schema = ", ".join([f"`{k}` {types[k]}" for k in keys] + [f"`{c}` array<double>" for c in [wave, *cols]])
    return df.select(*keys, wave, *cols).mapInPandas(run, schema)


def convolve(df: DataFrame, key: Sequence[str], cols: Sequence[str], fwhm: float, profile: str = "gauss",
             wave: str = "wave", chunk_width: float | None = None) -> DataFrame:
    """Convolve spectra stored one row per point, all columns at once.

    Spectra are cut into wavelength chunks; rows within the profile support of a chunk edge are copied to
    the neighbour, so a chunk is convolved on its own and no spectrum has to fit into one task.  The end
    points of the neighbouring chunks come from a small per-chunk aggregate.
    """
    keys, cols, types = list(key), list(cols), dict(df.dtypes)
    w = F.col(wave)
    reach = 1.1 * SUPPORT[profile] * (F.lit(-fwhm / LIGHT_KMS) * w if fwhm < 0 else F.lit(fwhm / 1000.0))
    if chunk_width is None:
        top = df.agg(F.max(reach)).first()[0] or 1.0
        chunk_width = 40.0 * top
        fullest = df.groupBy(*keys, F.floor(w / F.lit(chunk_width)).alias("_c")).count().agg(F.max("count")).first()[0] or 0
        if fullest > MAX_CHUNK_ROWS:
            chunk_width = max(chunk_width * MAX_CHUNK_ROWS / fullest, top)
    size = F.lit(float(chunk_width))
    rows = df.select(*keys, w.cast("double").alias(wave), *[F.col(c).cast("double").alias(c) for c in cols])
    rows = rows.withColumn("_c", F.floor(w / size))
    edges = rows.groupBy(*keys, "_c").agg(F.min(wave).alias("_a"), F.max(wave).alias("_b"))
    cw = Window.partitionBy(*keys).orderBy("_c")
    whole = Window.partitionBy(*keys)
    edges = edges.select(*keys, "_c", F.lag("_b").over(cw).alias("_before"), F.lead("_a").over(cw).alias("_after"),
                         F.min("_a").over(whole).alias("_start"), F.max("_b").over(whole).alias("_end"))
    first, last = F.floor((w - reach) / size), F.floor((w + reach) / size)
    spread = rows.withColumn("_home", F.col("_c")).withColumn("_c", F.explode(F.sequence(first, last)))
    # an inner join: a copy sent to a chunk that has no rows of its own is not needed
    spread = spread.join(edges, [*keys, "_c"])

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        x, y = pdf[wave].to_numpy(float), pdf[cols].to_numpy(float).T
        edge = pdf.iloc[0]
        xe, ye, front = _with_ends(x, y, fwhm, profile, edge["_before"], edge["_after"],
                                   x[0] <= edge["_start"], x[-1] >= edge["_end"])
        own = np.flatnonzero((pdf["_home"] == pdf["_c"]).to_numpy())
        done = dict(zip(cols, _band(xe, ye, own + front, fwhm, profile)))
        return pdf.iloc[own][[*keys, wave]].assign(**done)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for groups in sorted_groups(batches, [*keys, "_c"]):
            yield pd.concat([one(g) for g in groups])

    schema = ", ".join([f"`{k}` {types[k]}" for k in keys] + [f"`{c}` double" for c in [wave, *cols]])
    return spread.repartition(*keys, "_c").sortWithinPartitions(*keys, "_c", wave).mapInPandas(run, schema)


def resolution_to_fwhm(resolution: float) -> float:
    """Signed km/s width of a Gaussian whose sigma is wavelength / R."""
    return -2.0 * float(np.sqrt(2.0 * np.log(2.0))) * LIGHT_KMS / resolution


def convolve_resolution(df: DataFrame, key: Sequence[str], cols: Sequence[str], resolution: float,
                        packed: bool = False, **kw) -> DataFrame:
    run = convolve_packed if packed else convolve
    return run(df, key, cols, resolution_to_fwhm(resolution), "gauss", **kw)
