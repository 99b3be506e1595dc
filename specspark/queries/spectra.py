"""Spectrum operators: each embedding is a spectrum of 64 points."""

from __future__ import annotations

from pyspark.sql import functions as F

from specspark.operators import grid as G
from specspark.operators import spectra as X
from specspark.operators.layout import small_table
from specspark.operators.series import steps
from specspark.queries.common import SPECTRA_SQL, packed_spectra, rnd, spectra, spectra_sql, table
from specspark.registry import query

EW_SQL = f"""WITH {SPECTRA_SQL}, w AS (SELECT *, lead(wave) OVER p - wave AS ahead, wave - lag(wave) OVER p AS behind FROM sp WINDOW p AS (PARTITION BY spec_id ORDER BY wave))
SELECT spec_id, round(sum((1 - flux) * (coalesce(behind, ahead) + coalesce(ahead, behind)) / 2), 4) + 0.0 AS eqw,
  1 - max_by(flux, wave) > 1e-4 AS open_wing FROM w GROUP BY spec_id"""


@query("equivalent_width", EW_SQL)
def equivalent_width(spark, d):
    e = X.equivalent_width_packed(packed_spectra(spark, d))
    return e.select("spec_id", rnd("eqw").alias("eqw"), "open_wing")


@query("equivalent_width_2", EW_SQL)
def equivalent_width_long(spark, d):
    e = X.equivalent_width(spectra(spark, d), ["spec_id"])
    return e.select("spec_id", rnd("eqw").alias("eqw"), "open_wing")


# four Gauss angles for each of 16 wavelengths
NODES_SQL = """no AS (SELECT * FROM (VALUES (1, 0.06943184420297371::DOUBLE, 0.17392742256872692::DOUBLE), (2, 0.33000947820757187, 0.32607257743127307),
  (3, 0.6699905217924281, 0.32607257743127307), (4, 0.9305681557970262, 0.17392742256872692)) t(n, mu, w))"""


@query("flux_quadrature", f"""WITH {SPECTRA_SQL}, {NODES_SQL}
SELECT spec_id, (i // 4)::INTEGER AS j, round(2 * pi() * sum(w * mu * flux), 5) AS flux_abs, round(sum(w * mu * flux) / sum(w * mu * (1 + 0.01 * n)), 6) AS flux_norm
FROM sp JOIN no ON n = i % 4 + 1 GROUP BY 1, 2""")
def flux_quadrature(spark, d):
    rows = spectra(spark, d).select("spec_id", F.floor(F.col("i") / 4).cast("int").alias("j"), (F.col("i") % 4 + 1).alias("n"),
                                    F.col("flux").alias("i_line"), (1 + F.lit(0.01) * (F.col("i") % 4 + 1)).alias("i_cont"))
    f = X.flux_from_intensity(rows, ["spec_id", "j"], G.gauss_nodes(spark, 4), node="n")
    return f.select("spec_id", "j", rnd("flux_abs", 5).alias("flux_abs"), rnd("flux_norm", 6).alias("flux_norm"))


@query("flux_spline_quadrature", f"""WITH {SPECTRA_SQL}, m AS (SELECT spec_id, i // 8 AS j, sqrt(1.0 - (i % 8) / 8.0) AS mu, flux FROM sp),
 n AS (SELECT *, lag(mu) OVER w AS px, lag(flux) OVER w AS pf, lead(mu) OVER w AS nx, lead(flux) OVER w AS nf, lead(mu, 2) OVER w AS nnx, lead(flux, 2) OVER w AS nnf
   FROM m WINDOW w AS (PARTITION BY spec_id, j ORDER BY mu)),
 d AS (SELECT *, CASE WHEN nx IS NULL THEN 0 WHEN px IS NULL THEN -(nx - mu) / (nnx - mu) * (nnf - nf) / (nnx - nx) + (1 + (nx - mu) / (nnx - mu)) * (nf - flux) / (nx - mu)
   WHEN nnx IS NULL THEN 2 * (nf - flux) / (nx - mu) ELSE (nf - pf) / (nx - px) END AS d FROM n),
 p AS (SELECT *, lag(d) OVER w AS pd FROM d WINDOW w AS (PARTITION BY spec_id, j ORDER BY mu))
SELECT spec_id, j::INTEGER AS j, round(sum((mu - px) * (flux + pf) / 2 + (pd - d) * (mu - px) * (mu - px) / 12), 6) AS integral FROM p GROUP BY 1, 2""")
def flux_spline_quadrature(spark, d):
    rows = spectra(spark, d).select("spec_id", F.floor(F.col("i") / 8).cast("int").alias("j"), F.sqrt(1.0 - (F.col("i") % 8) / 8.0).alias("mu"), "flux")
    q = X.spline_quadrature(rows, ["spec_id", "j"], "mu", "flux")
    return q.select("spec_id", "j", rnd("integral", 6).alias("integral"))


# --- photometry --------------------------------------------------------------------------

PHOT_SQL = spectra_sql(3000.0, 363.5)


def _bands_sql() -> str:
    rows = []
    for band, values in X.BANDS.items():
        n = 2 if band == "K" else 1
        rows += [f"('{band}', {X.BAND_START[band] // 100 + i * n + j}, {t}::DOUBLE)" for i, t in enumerate(values) for j in range(n)]
    return f"bt(band, bin, t) AS (VALUES {', '.join(rows)})"


BAND_SQL = f"""{PHOT_SQL}, {_bands_sql()},
 bf AS (SELECT spec_id, band, sum(t * flux) / sum(t) AS flux FROM sp JOIN bt ON floor(wave / 100) = bin GROUP BY 1, 2),
 m0 AS (SELECT spec_id, -2.5 * log10(min_by(flux, wave)) AS m0 FROM sp WHERE wave > 5000 GROUP BY 1)"""


@query("synthetic_photometry", f"WITH {BAND_SQL} SELECT spec_id, band, round(flux, 6) AS flux FROM bf")
def synthetic_photometry(spark, d):
    return X.band_flux(spectra(spark, d, 3000.0, 363.5), ["spec_id"]).select("spec_id", "band", rnd("flux", 6).alias("flux"))


def _mag_sql(b):
    return f"-2.5 * log10(max(CASE WHEN band = '{b}' THEN flux END)) - max(m0)"


@query("colours", f"WITH {BAND_SQL} SELECT spec_id, round({_mag_sql('V')}, 6) + 0.0 AS mag_v, " + ", ".join(
    f"round(({_mag_sql(p[0])}) - ({_mag_sql(p[1])}), 6) + 0.0 AS {n}" for n, p in X.COLOURS.items())
    + " FROM bf JOIN m0 USING (spec_id) GROUP BY 1")
def colours(spark, d):
    sp = spectra(spark, d, 3000.0, 363.5)
    c = X.colours(X.band_flux(sp, ["spec_id"]), X.magnitude_zero(sp, ["spec_id"]), ["spec_id"])
    return c.select("spec_id", rnd("mag_v", 6).alias("mag_v"), *[rnd(n, 6).alias(n) for n in X.COLOURS])


@query("flux_magnitude", f"WITH {BAND_SQL} SELECT spec_id, i, round(-2.5 * log10(flux) - m0, 6) + 0.0 AS mag FROM sp JOIN m0 USING (spec_id)")
def flux_magnitude(spark, d):
    return X.flux_magnitude(spectra(spark, d, 3000.0, 363.5), ["spec_id"]).select("spec_id", "i", rnd("mag", 6).alias("mag"))


CURVE = [(3950.0, 0.0), (4100.0, 0.35), (4220.0, 0.9), (4400.0, 0.8), (4530.0, 0.45), (4700.0, 0.05)]
# interval number -> first row of the three-point stencil that halving leaves on six rows
CURVE_STENCIL = {1: 1, 2: 1, 3: 2, 4: 4, 5: 4}


def _newton_sql(points, x):
    """CASE over the intervals of a literal table with six rows."""
    def value(i):
        (a, fa), (b, fb), (c, fc) = points[CURVE_STENCIL[i] - 1:CURVE_STENCIL[i] + 2]
        f1, f2 = (fb - fa) / (b - a), (fc - fb) / (c - b)
        return f"({fa!r}::DOUBLE + ({x} - {a}) * {f1!r}::DOUBLE + ({x} - {a}) * ({x} - {b}) * {(f2 - f1) / (c - a)!r}::DOUBLE)"
    whens = " ".join(f"WHEN {x} < {points[i][0]} THEN {value(i)}" for i in range(1, 5))
    return f"CASE {whens} ELSE {value(5)} END"


@query("filter_on_spectrum", f"WITH {SPECTRA_SQL} SELECT spec_id, i, round(flux * ({_newton_sql(CURVE, 'wave')}), 6) + 0.0 AS seen FROM sp")
def filter_on_spectrum(spark, d):
    curve = small_table(spark, CURVE, "wave double, trans double")
    s = X.apply_filter(spectra(spark, d), curve)
    return s.select("spec_id", "i", rnd(F.col("flux") * F.col("trans"), 6).alias("seen"))


# eight wavelengths with eight angles mu = (j+1)/8
LIMB_SQL = f"""{SPECTRA_SQL}, it AS (SELECT spec_id, 4000.0::DOUBLE + 80 * (i // 8) AS wave, (i % 8 + 1) / 8.0::DOUBLE AS mu, flux * (0.4 + 0.6 * (i % 8 + 1) / 8.0::DOUBLE) AS v FROM sp),
 ce AS (SELECT spec_id, wave, v AS centre, {_newton_sql(CURVE, 'wave')} AS trans FROM it WHERE mu = 1),
 po AS (SELECT p + 1 AS pos, (5 - p) / 5.0::DOUBLE AS r, sqrt(greatest(1 - ((5 - p) / 5.0::DOUBLE) * ((5 - p) / 5.0::DOUBLE), 0)) AS m FROM (SELECT unnest(range(5)) AS p)),
 iv AS (SELECT *, least(greatest(floor(m * 8)::INTEGER, 1), 7) AS n FROM po)"""


@query("limb_profile", f"""WITH {LIMB_SQL},
 x3 AS (SELECT ce.spec_id, ce.wave, ce.centre, ce.trans, st.pos, st.r, st.m, a.mu AS x0, b.mu AS x1, c.mu AS x2, a.v / centre AS y0, b.v / centre AS y1, c.v / centre AS y2
   FROM ce, (SELECT iv.pos, iv.r, iv.m, h.s FROM iv JOIN (
     WITH RECURSIVE b(i, lo, hi) AS (SELECT unnest(range(1, 8)), 1::BIGINT, 8::BIGINT UNION ALL
       SELECT i, CASE WHEN (lo + hi) // 2 <= i THEN (lo + hi) // 2 ELSE lo END, CASE WHEN (lo + hi) // 2 > i THEN (lo + hi) // 2 ELSE hi END FROM b WHERE hi - lo > 2)
     SELECT i, greatest(min(hi) - 2, 1) AS s FROM b GROUP BY i) h ON h.i = iv.n) st
   JOIN it a ON a.spec_id = ce.spec_id AND a.wave = ce.wave AND a.mu = st.s / 8.0 JOIN it b ON b.spec_id = ce.spec_id AND b.wave = ce.wave AND b.mu = (st.s + 1) / 8.0
   JOIN it c ON c.spec_id = ce.spec_id AND c.wave = ce.wave AND c.mu = (st.s + 2) / 8.0)
SELECT spec_id, pos::INTEGER AS pos, round(any_value(r), 6) AS r, round(sum(10.0 * trans * centre * (y0 + (m - x0) * (y1 - y0) / (x1 - x0) + (m - x0) * (m - x1) * ((y2 - y1) / (x2 - x1) - (y1 - y0) / (x1 - x0)) / (x2 - x0))), 5) AS intensity,
  round(sum(10.0 * trans * centre), 5) AS total_intensity, round(sum(10.0 * trans), 5) AS total_trans FROM x3 GROUP BY 1, 2""")
def limb_profile(spark, d):
    mu = (F.col("i") % 8 + 1) / 8.0
    rows = spectra(spark, d).select(
        "spec_id", (4000.0 + 80 * F.floor(F.col("i") / 8)).alias("wave"), mu.alias("mu"),
        (F.col("flux") * (0.4 + 0.6 * (F.col("i") % 8 + 1) / 8.0)).alias("i_abs"), F.lit(10.0).alias("weight"))
    p = X.limb_profile(rows, ["spec_id"], small_table(spark, CURVE, "wave double, trans double"), 5)
    return p.select("spec_id", "pos", rnd("r", 6).alias("r"), rnd("intensity", 5).alias("intensity"),
                    rnd("total_intensity", 5).alias("total_intensity"), rnd("total_trans", 5).alias("total_trans"))


# --- curve of growth -----------------------------------------------------------------------

@query("curve_of_growth", """WITH cu AS (SELECT l_suppkey AS line, l_linenumber - 4 AS lf, log10(l_linenumber * 1000 + avg(l_quantity)) AS lw FROM lineitem GROUP BY l_suppkey, l_linenumber),
 iv AS (SELECT *, lead(lw) OVER w AS nw, lead(lf) OVER w AS nf, row_number() OVER w AS i, count(*) OVER (PARTITION BY line) AS n FROM cu WINDOW w AS (PARTITION BY line ORDER BY lw)),
 ob AS (SELECT c_custkey, c_custkey % (SELECT count(*) FROM supplier) AS line, c_acctbal AS w, (c_custkey % 7) * 150.0::DOUBLE AS e FROM customer),
 th AS (SELECT c_custkey, line, 2 AS which, w FROM ob UNION ALL SELECT c_custkey, line, 1, greatest(w - e, 0.1) FROM ob WHERE w > 0 AND e > 0
   UNION ALL SELECT c_custkey, line, 3, w + e FROM ob WHERE w > 0 AND e > 0),
 hi AS (SELECT th.*, iv.lw, iv.nw, iv.lf, iv.nf, log10(th.w) AS x FROM th JOIN iv ON iv.line = th.line AND nw IS NOT NULL AND (log10(th.w) >= lw OR i = 1) AND (log10(th.w) < nw OR i = n - 1) WHERE th.w > 0)
SELECT c_custkey, which, CASE WHEN x BETWEEN lw AND nw THEN round((nf - lf) * ((x - lw) / (nw - lw)) + lf, 5) + 0.0 END AS log_factor, CASE WHEN x BETWEEN lw AND nw THEN 'ok' ELSE 'not_converged' END AS status FROM hi
UNION ALL SELECT c_custkey, which, -30.0, 'zero' FROM th WHERE w <= 0""")
def curve_of_growth(spark, d):
    curve = table(spark, d, "lineitem").groupBy(F.col("l_suppkey").alias("line"), "l_linenumber").agg(F.avg("l_quantity").alias("q")).select(
        "line", (F.col("l_linenumber") - 4).cast("double").alias("log_factor"), (F.col("l_linenumber") * 1000 + F.col("q")).alias("ew"))
    n = table(spark, d, "supplier").count()
    obs = table(spark, d, "customer").select(
        (F.col("c_custkey") % n).alias("line"), "c_custkey", F.col("c_acctbal").alias("obs_ew"), ((F.col("c_custkey") % 7) * 150.0).alias("obs_err"))
    a = X.abundance_from_ew(curve, obs, "line", ["c_custkey"])
    return a.select("c_custkey", "which", rnd("log_factor", 5).alias("log_factor"), "status")


@query("absorber_shares", """WITH c AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, (l_linenumber % 3)::INTEGER AS k, floor(l_extendedprice / 50)::BIGINT AS j,
  CASE WHEN l_returnflag = 'A' THEN 'scattering' ELSE 'absorption' END AS kind, l_quantity AS v FROM lineitem)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, round(v / sum(v) OVER (PARTITION BY k, j, kind) * CASE WHEN kind = 'absorption' THEN 1 - exp(-1.438769e8 / l_extendedprice / (4000.0 + 500 * k)) ELSE 1 END, 6) AS share FROM c""")
def absorber_shares(spark, d):
    li = table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", (F.col("l_linenumber") % 3).alias("k"),
        F.floor(F.col("l_extendedprice") / 50).alias("j"), F.when(F.col("l_returnflag") == "A", "scattering").otherwise("absorption").alias("kind"),
        F.col("l_quantity").alias("v"))
    s = X.shares(li, ["k", "j"], "v", "kind", "l_extendedprice", 4000.0 + 500 * F.col("k"))
    return s.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", rnd("share", 6).alias("share"))


# --- convolution ---------------------------------------------------------------------------

def _convolve_sql(support: str, profile: str, width: str, lo_rule: str = "least(lo0, i - 1)", hi_rule: str = "greatest(hi0, i + 1)") -> str:
    """Self-join over the support, with zeros outside the spectrum; 64 points 10 Angstrom apart."""
    return f"""WITH {SPECTRA_SQL},
 pad AS (SELECT spec_id, i, 4000.0::DOUBLE + i * 10.0 AS wave, flux FROM sp UNION ALL
   SELECT vec_id, k, 4000.0::DOUBLE + k * 10.0, 0.0 FROM embeddings, (SELECT unnest(range(-40, 0)) AS k UNION ALL SELECT unnest(range(64, 104))) z),
 b0 AS (SELECT spec_id, i, wave, {width} AS fw FROM sp),
 b1 AS (SELECT *, {support} AS su FROM b0),
 b2 AS (SELECT *, ceil((wave - su - 4000 - 1e-9) / 10)::BIGINT AS lo0, floor((wave + su - 4000 + 1e-9) / 10)::BIGINT AS hi0 FROM b1),
 b3 AS (SELECT *, {lo_rule} AS lo, {hi_rule} AS hi FROM b2),
 jo AS (SELECT b3.spec_id, b3.i, b3.wave, b3.fw, pad.wave - b3.wave AS dl, pad.flux, (CASE WHEN pad.i > lo THEN 10 ELSE 0 END + CASE WHEN pad.i < hi THEN 10 ELSE 0 END) / 2.0 AS w
   FROM b3 JOIN pad ON pad.spec_id = b3.spec_id AND pad.i BETWEEN lo AND hi),
 pr AS (SELECT *, {profile} AS p FROM jo)
SELECT spec_id, wave, round(sum(p * flux * w) / sum(p * w), 6) + 0.0 AS flux FROM pr GROUP BY 1, 2"""


GAUSS = "CASE WHEN exp(-pow(dl * 1.66511 / fw, 2)) > 1e-6 THEN exp(-pow(dl * 1.66511 / fw, 2)) ELSE 0 END"
EXP = "CASE WHEN exp(-abs(dl * 1.38629 / fw)) > 1e-6 THEN exp(-abs(dl * 1.38629 / fw)) ELSE 0 END"
ROT = """CASE WHEN abs(dl) <= fw THEN (2 * (1 - (1 - 0.3 * wave / 5000)) * sqrt(greatest(1 - pow(dl / fw, 2), 0)) + pi() * 0.5 * (1 - 0.3 * wave / 5000) * greatest(1 - pow(dl / fw, 2), 0))
  / (pi() * fw * (1 - (1 - 0.3 * wave / 5000) / 3)) ELSE 0 END"""


def _conv(spark, d, fwhm, profile, **kw):
    c = X.convolve(spectra(spark, d).select("spec_id", "wave", "flux"), ["spec_id"], ["flux"], fwhm, profile, **kw)
    return c.select("spec_id", "wave", rnd("flux", 6).alias("flux"))


@query("convolve", _convolve_sql("fw * sqrt(ln(1e6)) / 1.66511", GAUSS, "25.3::DOUBLE"))
def convolve(spark, d):
    return _conv(spark, d, 25300.0, "gauss", chunk_width=330.0)


def _packed(spark, d, fwhm, profile):
    c = X.convolve_packed(packed_spectra(spark, d), ["spec_id"], ["flux"], fwhm, profile)
    return c.select("spec_id", F.explode(F.arrays_zip("wave", "flux")).alias("p")).select("spec_id", "p.wave", rnd("p.flux", 6).alias("flux"))


@query("convolve_2", _convolve_sql("fw * ln(1e6) / 1.38629", EXP, "900.0::DOUBLE * wave / 2.99792458e5"))
def convolve_exp(spark, d):
    return _packed(spark, d, -900.0, "exp")


@query("convolve_3", _convolve_sql("fw", ROT, "2500.0::DOUBLE * wave / 2.99792458e5", "CASE WHEN lo0 = hi0 THEN i - 1 ELSE lo0 END", "CASE WHEN lo0 = hi0 THEN i + 1 ELSE hi0 END"))
def convolve_rot(spark, d):
    return _packed(spark, d, -2500.0, "rot")


RADTAN_SQL = "[" + ", ".join(f"ln({v})" for v in X.RADTAN) + "]"
RADTAN_PROFILE = f"""exp({RADTAN_SQL}[floor(abs(dl) / (fw * 0.1433))::INTEGER + 1] + ({RADTAN_SQL}[least(floor(abs(dl) / (fw * 0.1433))::INTEGER + 2, 36)] - {RADTAN_SQL}[floor(abs(dl) / (fw * 0.1433))::INTEGER + 1])
  * (abs(dl) / (fw * 0.1433) - floor(abs(dl) / (fw * 0.1433))))"""


@query("convolve_4", _convolve_sql("fw * 0.1433 * 35", RADTAN_PROFILE, "17.7::DOUBLE").replace(
    "floor((wave + su - 4000 + 1e-9) / 10)", "floor((wave + su * 34 / 35 - 4000 + 1e-9) / 10)"))
def convolve_radtan(spark, d):
    return _packed(spark, d, 17700.0, "radtan")


@query("convolve_resolution", _convolve_sql("fw * sqrt(ln(1e6)) / 1.66511", GAUSS, "2 * sqrt(2 * ln(2::DOUBLE)) * wave / 300.0"))
def convolve_resolution(spark, d):
    c = X.convolve_resolution(packed_spectra(spark, d), ["spec_id"], ["flux"], 300.0, packed=True)
    return c.select("spec_id", F.explode(F.arrays_zip("wave", "flux")).alias("p")).select("spec_id", "p.wave", rnd("p.flux", 6).alias("flux"))


@query("step_weights", f"""WITH {SPECTRA_SQL}, w AS (SELECT *, lead(wave) OVER p - wave AS ahead, wave - lag(wave) OVER p AS behind FROM sp WINDOW p AS (PARTITION BY spec_id ORDER BY wave))
SELECT spec_id, round(sum(flux * (coalesce(ahead, 0) + coalesce(behind, 0)) / 2), 4) AS area FROM w GROUP BY 1""")
def step_weights(spark, d):
    s = steps(spectra(spark, d).select("spec_id", "wave", "flux"), ["spec_id"], "wave")
    return s.groupBy("spec_id").agg(rnd(F.sum(F.col("flux") * F.col("weight"))).alias("area"))
