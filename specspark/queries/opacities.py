"""Voigt profiles and line opacity: lineitem is the line list, three depths, a grid of 10 Angstrom."""

from __future__ import annotations

from pyspark.sql import functions as F

from specspark.functions import physics as P
from specspark.operators import opacity as O
from specspark.operators import synthesis as S
from specspark.queries.common import LINE_KEY, rnd, table
from specspark.registry import query

KEY_SQL = "l_orderkey, l_linenumber, l_partkey, species_id, wave"


def _poly_sql(coef, re, im, mod, name):
    """Steps of the real recurrence, one lateral column each."""
    n = len(coef) - 1
    cols = []
    for k in range(n, 0, -1):
        b = repr(float(coef[k])) + "::DOUBLE"
        if k + 1 <= n:
            b += f" + 2.0 * {re} * {name}{k + 1}"
        if k + 2 <= n:
            b += f" - {mod} * {name}{k + 2}"
        cols.append(f"{b} AS {name}{k}")
    real = f"{coef[0]!r}::DOUBLE + {re} * {name}1" + (f" - {mod} * {name}2" if n >= 2 else "")
    cols += [f"{real} AS {name}r", f"{im} * {name}1 AS {name}i"]
    return cols


def voigt_sql(source: str, a: str = "a", v: str = "v") -> str:
    """SELECT *, ..., voigt FROM source, written out with lateral column aliases."""
    cols = [f"abs({v}) AS vv", f"{a} * {a} - vv * vv AS ur", f"-2.0 * {a} * vv AS ui", f"{a} * {a} + vv * vv AS tm", "tm * tm AS um"]
    cols += _poly_sql(P.W_FAR_N, "ur", "ui", "um", "fn") + _poly_sql(P.W_FAR_D, "ur", "ui", "um", "fd")
    cols += _poly_sql(P.W_NEAR_N, a, "(-vv)", "tm", "nn") + _poly_sql(P.W_NEAR_D, a, "(-vv)", "tm", "nd")
    cols += _poly_sql(P.W_CORE_N, "ur", "ui", "um", "cn") + _poly_sql(P.W_CORE_D, "ur", "ui", "um", "cd")
    far = f"((({a}) * fnr + vv * fni) * fdr + (({a}) * fni - vv * fnr) * fdi) / (fdr * fdr + fdi * fdi)"
    near = "(nnr * ndr + nni * ndi) / (ndr * ndr + ndi * ndi)"
    core = f"exp(ur) * cos(ui) - ((({a}) * cnr + vv * cni) * cdr + (({a}) * cni - vv * cnr) * cdi) / (cdr * cdr + cdi * cdi)"
    wing = f"{P.W_WING!r} * ({a} * (ur + 0.5) - vv * ui) / ((ur + 0.5) * (ur + 0.5) + ui * ui)"
    cols.append(f"CASE WHEN {a} + vv >= 15 THEN {wing} WHEN {a} + vv >= 5.5 THEN {far} WHEN {a} >= 0.195 * vv - 0.176 THEN {near} ELSE {core} END AS voigt")
    return f"SELECT *, {', '.join(cols)} FROM {source}"


@query("voigt", f"""WITH av AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey AS species_id, l_extendedprice AS wave,
  pow(10, l_discount * 40 - 3.0) AS a, (l_quantity - 25) * (1 + l_tax * 5) / 2 AS v FROM lineitem), vo AS ({voigt_sql('av')})
SELECT {KEY_SQL}, round(voigt, 7) + 0.0 AS h FROM vo""")
def voigt(spark, d):
    df = table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", F.col("l_suppkey").alias("species_id"), F.col("l_extendedprice").alias("wave"),
        F.pow(F.lit(10.0), F.col("l_discount") * 40 - 3.0).alias("a"),
        ((F.col("l_quantity") - 25) * (1 + F.col("l_tax") * 5) / 2).alias("v"))
    return P.with_voigt(df, F.col("a"), F.col("v"), "h").select(*LINE_KEY, rnd("h", 7).alias("h"))


START, STEP, N, EPS = 1000.0, 10.0, 10401, 1e-3
TEMPS = [4500.0, 5777.0, 7000.0]

# Doppler width of about 8 Angstrom and damping of a few per cent, so a line reaches a few tens of points
DEPTH_SQL = """ld AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey AS species_id, l_extendedprice AS wave, k,
   0.01::DOUBLE * (1 + l_tax * 20) * (1 + 0.2 * k) AS a, 2.9979e18 / (l_extendedprice * l_extendedprice) * (6.0 + 2 * k) AS dnud,
   l_quantity / 500 * (1 + 0.1 * k) AS ratio, l_quantity * (1 + l_discount) / (1 + k) AS kappa0, l_quantity * (1 + l_discount) / (1 + k) * 0.9 AS emis0
   FROM lineitem, (SELECT unnest([0, 1, 2]) AS k))"""
# candidate points: further out than any line can reach (Doppler core or Lorentz wing)
POINTS_SQL = DEPTH_SQL + f""",
 re AS (SELECT l_orderkey, l_linenumber, l_partkey, species_id, wave, 10.0 * greatest(7, 1.3 * max(sqrt(greatest(ratio * a, 0) / {EPS} / 1.7724538509))) AS far FROM ld GROUP BY ALL),
 pt AS (SELECT l_orderkey, l_linenumber, l_partkey, species_id, wave, unnest(range(greatest(ceil((wave - far - {START}) / {STEP}), 0)::BIGINT, least(floor((wave + far - {START}) / {STEP}), {N - 1})::BIGINT + 1)) AS j FROM re),
 pv AS (SELECT ld.*, pt.j, ({START} + pt.j * {STEP} - ld.wave) * 2.9979e18 / (ld.wave * ld.wave) / dnud AS v FROM pt
   JOIN ld USING (l_orderkey, l_linenumber, l_partkey, species_id, wave)),
 vo AS ({voigt_sql('pv')}),
 pk AS (SELECT l_orderkey, l_linenumber, l_partkey, species_id, wave, j, max(ratio * voigt) AS peak FROM vo GROUP BY ALL HAVING max(ratio * voigt) >= {EPS}),
 co AS (SELECT vo.l_orderkey, vo.l_linenumber, vo.l_partkey, vo.species_id, vo.wave, vo.j, vo.k, vo.ratio * voigt AS ratio_k, kappa0 * voigt AS kappa, emis0 * voigt AS emissivity FROM vo
   JOIN pk USING (l_orderkey, l_linenumber, l_partkey, species_id, wave, j))"""


def plain_lines(spark, d):
    """One row per line with what its depth arrays are made of."""
    return table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", F.col("l_suppkey").alias("species_id"), F.col("l_extendedprice").alias("wave"),
        "l_quantity", "l_discount", "l_tax")


def depth_arrays():
    """The depth arrays of a line."""
    w, q = F.col("wave"), F.col("l_quantity")
    arr = lambda f: F.array(*[f(k) for k in range(3)])
    return {"a": arr(lambda k: F.lit(0.01) * (1 + F.col("l_tax") * 20) * (1 + 0.2 * k)),
            "dnud": arr(lambda k: F.lit(2.9979e18) / (w * w) * (6.0 + 2 * k)),
            "ratio": arr(lambda k: q / 500 * (1 + 0.1 * k)),
            "kappa0": arr(lambda k: q * (1 + F.col("l_discount")) / (1 + k)),
            "emis0": arr(lambda k: q * (1 + F.col("l_discount")) / (1 + k) * 0.9)}


def depth_lines(spark, d):
    """One row per line with its depth arrays."""
    return plain_lines(spark, d).select(*LINE_KEY, *[c.alias(n) for n, c in depth_arrays().items()])


def contributions(spark, d, extra=(), cluster=()):
    return O.line_opacity(depth_lines(spark, d), "wave", START, STEP, N, EPS, extra=extra, cluster=cluster)


def peak_contributions(spark, d):
    """Contributions by line with the peak of their point; a line is shuffled without its depth arrays."""
    return O.line_opacity(plain_lines(spark, d), "wave", START, STEP, N, EPS, extra=LINE_KEY, cluster=LINE_KEY, peak=True, depth=depth_arrays())


@query("line_opacity", f"""WITH {POINTS_SQL} SELECT l_suppkey AS species_id, count(*) AS n_points, round(sum(kappa), 3) AS kappa FROM (SELECT species_id AS l_suppkey, kappa FROM co) GROUP BY 1""")
def line_opacity(spark, d):
    c = contributions(spark, d, ["species_id"])
    return c.groupBy("species_id").agg(F.count(F.lit(1)).alias("n_points"), rnd(F.sum("kappa"), 3).alias("kappa"))


@query("opacity_sum", f"WITH {POINTS_SQL} SELECT k, j, round(sum(kappa) * 0.9, 5) AS kappa, round(sum(kappa) * 0.1, 5) AS sigma FROM co GROUP BY 1, 2")
def opacity_sum(spark, d):
    s = O.opacity_sum(contributions(spark, d), scattering=0.1)
    return s.select("k", "j", rnd("kappa", 5).alias("kappa"), rnd("sigma", 5).alias("sigma"))


@query("peak_ratio", f"WITH {POINTS_SQL} SELECT species_id, count(*) AS n, round(sum(peak), 5) AS peak_sum, round(max(peak), 6) AS peak_max FROM pk GROUP BY 1")
def peak_ratio(spark, d):
    p = O.peak_ratio(contributions(spark, d, LINE_KEY, LINE_KEY), LINE_KEY)
    return p.groupBy("species_id").agg(F.count(F.lit(1)).alias("n"), rnd(F.sum("peak"), 5).alias("peak_sum"), rnd(F.max("peak"), 6).alias("peak_max"))


@query("strength_cut", f"""WITH {POINTS_SQL}, pc AS (SELECT * FROM pk WHERE peak >= 0.03)
SELECT co.species_id, count(*) AS n, round(sum(kappa), 3) AS kappa FROM co JOIN pc USING (l_orderkey, l_linenumber, l_partkey, species_id, wave, j) GROUP BY 1""")
def strength_cut(spark, d):
    c = O.strength_cut(peak_contributions(spark, d), LINE_KEY, 0.03)
    return c.groupBy("species_id").agg(F.count(F.lit(1)).alias("n"), rnd(F.sum("kappa"), 3).alias("kappa"))


CONT_SQL = f"""su AS (SELECT k, j, sum(kappa) AS kappa, sum(emissivity) AS emissivity FROM co GROUP BY 1, 2),
 ct AS (SELECT (l_linenumber % 3)::INTEGER AS k, floor((l_extendedprice - {START}) / {STEP})::BIGINT AS j, sum(l_tax) AS kappa, sum(l_discount) AS sigma FROM lineitem GROUP BY 1, 2)"""


def _continuum(spark, d):
    return table(spark, d, "lineitem").groupBy(
        (F.col("l_linenumber") % 3).alias("k"), F.floor((F.col("l_extendedprice") - START) / STEP).alias("j")).agg(
        F.sum("l_tax").alias("kappa"), F.sum("l_discount").alias("sigma"))


@query("total_opacity", f"""WITH {POINTS_SQL}, {CONT_SQL}, un AS (SELECT k, j, kappa, 0.0 AS sigma FROM su UNION ALL SELECT k, j, kappa, sigma FROM ct)
SELECT k, j, round(sum(kappa), 5) AS kappa, round(sum(sigma), 5) + 0.0 AS sigma FROM un GROUP BY 1, 2""")
def total_opacity(spark, d):
    t = O.total_opacity(_sums(spark, d), _continuum(spark, d))
    return t.select("k", "j", rnd("kappa", 5).alias("kappa"), rnd("sigma", 5).alias("sigma"))


B_SQL = f"(1 / ((exp(1.438769e8 / w / temp) - 1) * pow(w, 5) / 1.191044e27))"


@query("source_function", f"""WITH {POINTS_SQL}, {CONT_SQL},
 sw AS (SELECT *, {START} + j * {STEP} AS w, [4500.0, 5777.0, 7000.0][k + 1]::DOUBLE AS temp FROM su),
 sb AS (SELECT *, {B_SQL} AS b FROM sw)
SELECT k, j, round(log10(emissivity * b / kappa), 6) AS s_line, round(log10((emissivity * b + b * 2.5) / (kappa + 2.5)), 6) AS s_total FROM sb""")
def source_function(spark, d):
    op = _sums(spark, d).withColumn("cont", F.lit(2.5))
    temp = F.element_at(F.array(*[F.lit(t) for t in TEMPS]), F.col("k") + 1)
    s = O.source_function(op, temp, F.lit(START) + F.col("j") * STEP, "cont")
    return s.select("k", "j", rnd(F.log10("s_line"), 6).alias("s_line"), rnd(F.log10("s_total"), 6).alias("s_total"))


# --- sums in blocks, segments, and the whole chain ---------------------------------------------

def _sums(spark, d, scattering=0.0):
    """The same sums without a row for each line, point and depth."""
    placed = S.regular_index(depth_lines(spark, d), START, STEP, N)
    return S.block_opacity(placed, "wave", EPS, scattering=scattering).drop("seg_id")


@query("opacity_blocks", f"WITH {POINTS_SQL} SELECT k, j, round(sum(kappa) * 0.9, 5) AS kappa, round(sum(kappa) * 0.1, 5) AS sigma FROM co GROUP BY 1, 2")
def opacity_blocks(spark, d):
    return _sums(spark, d, 0.1).select("k", "j", rnd("kappa", 5).alias("kappa"), rnd("sigma", 5).alias("sigma"))


RESOLUTION, SEG_EPS = 20000.0, 1e-3
SEGMENTS_SQL = f"""sg AS (SELECT seg_id, wmin, wmax, step, (ceil((wmax - wmin) / step) + 1)::BIGINT AS n
   FROM (SELECT *, (wmin + wmax) / 2.0 / {RESOLUTION} AS step FROM (SELECT p_partkey AS seg_id, p_retailprice + 4000 AS wmin, p_retailprice + 4000 + p_size AS wmax FROM part))),
 li AS (SELECT row_number() OVER () AS id, l_suppkey AS species_id, l_extendedprice AS wave, pow(10.0, l_tax * -20) AS gf, l_discount * 50 AS chi_low,
   CASE WHEN l_linenumber % 2 = 0 THEN 'R' ELSE 'U' END AS recipe, 1e8 * l_quantity AS gam_rad, l_quantity / 20 AS fdamp, -30.0 - l_discount * 10 AS log_c6 FROM lineitem),
 pl AS (SELECT id, min(seg_id) AS seg_id FROM li JOIN sg ON wave >= wmin AND wave <= wmax GROUP BY id),
 sl AS (SELECT li.*, sg.seg_id, wmin AS start, step, n FROM li JOIN pl USING (id) JOIN sg USING (seg_id))"""
# five layers from region, one species a supplier, a continuum from nation
LAYERS_SQL = """dp AS (SELECT r_regionkey AS k, 4200.0 + 600 * r_regionkey AS temp, 5e6 * (1 + 0.1 * r_regionkey) AS xi, 0.01 * (1 + r_regionkey) AS ross,
   1e4 * (1 + r_regionkey) AS pg FROM region),
 sp AS (SELECT s_suppkey AS species_id, 1.6735e-24 * (1 + s_nationkey) AS mass, 1e10 * (1 + s_suppkey % 7) AS number, 20.0 + s_nationkey % 3 AS q FROM supplier),
 ct AS (SELECT 4850.0 + 52.0 * n_nationkey AS x, 1e-3 * (1 + n_nationkey / 25.0) AS c FROM nation)"""
BESIDE_SQL = """(SELECT s.id, CASE WHEN s.wave <= (SELECT min(x) FROM ct) THEN (SELECT c FROM ct ORDER BY x LIMIT 1)
   ELSE coalesce(ct.c, (SELECT c FROM ct ORDER BY x DESC LIMIT 1)) END AS c FROM sl s ASOF LEFT JOIN ct ON s.wave < ct.x)"""
CHAIN_SQL = f"""{SEGMENTS_SQL}, {LAYERS_SQL}, be AS {BESIDE_SQL},
 l0 AS (SELECT sl.*, dp.k, dp.temp, sqrt(2 * 1.38066e-16 * dp.temp / sp.mass + dp.xi * dp.xi) / (sl.wave * 1e-8) AS dnud, dp.ross, dp.pg * 0.9 AS ph,
   sp.number * (dp.k + 1) / (sp.q + dp.k) AS n_q, be.c * (1 + dp.k) AS cont,
   1 - exp(-(6.6256e-27 * 2.9979e10 / 1.38066e-16) / (sl.wave * 1e-8) / dp.temp) AS stim FROM sl JOIN sp USING (species_id) JOIN be USING (id), dp),
 l1 AS (SELECT *, gam_rad + CASE WHEN recipe = 'R' THEN 0 ELSE pow(10.0, 8.6735 + 0.7 * log10(5040 / temp) + log10(ph) + 0.4 * log_c6) * 1e8
     * (1 + 0.1 * 0.41336 + 0.01 * 0.85) * fdamp END AS gamma,
   sqrt(pi()) * 4.80298e-10 * 4.80298e-10 / 9.1091e-28 / 2.9979e10 * gf * n_q * pow(10.0, -chi_low * 5040 / temp) / dnud / ross AS strength FROM l0),
 ld AS (SELECT id, seg_id, wave, start, step, n, k, temp, dnud, gamma / (4 * pi() * dnud) AS a, strength * stim AS kappa0, strength * stim AS emis0,
   strength * stim / cont AS ratio FROM l1),
 pt AS (SELECT *, unnest(range(n)) AS j FROM ld),
 pv AS (SELECT *, (start + j * step - wave) * 2.9979e18 / (wave * wave) / dnud AS v FROM pt),
 vo AS ({voigt_sql('pv')}),
 pk AS (SELECT id, j, max(ratio * voigt) >= {SEG_EPS} AS ok FROM vo GROUP BY ALL)"""
#: The walk, told by what it does: out to the red until a point fails, then as far to the blue, or on to the blue point by point.
WALK_SQL = """wf AS (SELECT DISTINCT id, n, (wave - start) / step AS x0, least(floor((wave - start) / step)::BIGINT + 1, n - 1) AS f FROM sl),
 wr AS (SELECT wf.id, wf.n, x0, f, min(pk.j) FILTER (WHERE NOT ok AND pk.j >= f) AS stop, max(pk.j) FILTER (WHERE NOT ok AND pk.j < f) AS down,
   min(pk.j) FILTER (WHERE NOT ok) AS any_stop FROM wf JOIN pk USING (id) GROUP BY ALL),
 wk AS (SELECT id, CASE WHEN x0 <= 0 THEN 0 WHEN stop IS NULL THEN coalesce(down, 0) ELSE greatest(f - (stop - f + 1) - 2, 0) END AS lo,
   CASE WHEN x0 <= 0 THEN coalesce(any_stop, n - 1) ELSE coalesce(stop, n - 1) END AS hi FROM wr)"""


def _segments(spark, d):
    seg = table(spark, d, "part").select(
        F.col("p_partkey").alias("seg_id"), (F.col("p_retailprice") + 4000).alias("wmin"),
        (F.col("p_retailprice") + 4000 + F.col("p_size")).alias("wmax"))
    return S.segment_index(seg, RESOLUTION)


def _line_list(spark, d):
    c = F.col
    return table(spark, d, "lineitem").select(
        c("l_suppkey").alias("species_id"), c("l_extendedprice").alias("wave"), F.pow(F.lit(10.0), c("l_tax") * -20).alias("gf"),
        (c("l_discount") * 50).alias("chi_low"), F.when(c("l_linenumber") % 2 == 0, "R").otherwise("U").alias("recipe"),
        (F.lit(1e8) * c("l_quantity")).alias("gam_rad"), (c("l_quantity") / 20).alias("fdamp"),
        (F.lit(-30.0) - c("l_discount") * 10).alias("log_c6"), F.lit(None).cast("double").alias("sigma"), F.lit(None).cast("double").alias("alpha"))


def _layers(spark, d):
    k = F.col("r_regionkey")
    pg = F.lit(1e4) * (1 + k)
    return table(spark, d, "region").select(
        k.alias("k"), (F.lit(4200.0) + 600 * k).alias("temp"), (F.lit(5e6) * (1 + 0.1 * k)).alias("xi"), (F.lit(0.01) * (1 + k)).alias("ross"),
        pg.alias("pg"), (pg * 0.9).alias("ph"), (pg * 0.9 * 0.1).alias("phe"), (pg * 0.9 * 0.01).alias("ph2"))


def _species(spark, d):
    layers = F.sequence(F.lit(0), F.lit(4))
    return table(spark, d, "supplier").select(
        F.col("s_suppkey").alias("species_id"), (F.lit(1.6735e-24) * (1 + F.col("s_nationkey"))).alias("mass"),
        F.transform(layers, lambda k: F.lit(1e10) * (1 + F.col("s_suppkey") % 7) * (k + 1)).alias("number"),
        F.transform(layers, lambda k: F.lit(20.0) + F.col("s_nationkey") % 3 + k).alias("q"))


def _continuum_rows(spark, d):
    k = F.sequence(F.lit(0), F.lit(4))
    return table(spark, d, "nation").select(
        (F.lit(4850.0) + 52.0 * F.col("n_nationkey")).alias("x"),
        F.transform(k, lambda i: F.lit(1e-3) * (1 + F.col("n_nationkey") / 25.0) * (1 + i)).alias("cont"))


def _chain(spark, d, mode):
    """Lines, segments, populations and continuum to opacity sums."""
    placed = S.place_lines(_line_list(spark, d), "wave", _segments(spark, d))
    strong = S.line_depths(placed, S.pack_depths(_layers(spark, d), _species(spark, d)))
    beside = S.continuum_beside(strong, "wave", _continuum_rows(spark, d), ["cont"])
    ready = beside.withColumn("ratio", F.zip_with("kappa0", "cont", lambda a, b: a / b))
    return S.block_opacity(ready, "wave", SEG_EPS, mode)


@query("segment_index", f"""WITH {SEGMENTS_SQL} SELECT seg_id, round(step, 9) AS step, n,
 coalesce(sum(n) OVER (ORDER BY seg_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS first FROM sg""")
def segment_index(spark, d):
    return _segments(spark, d).select("seg_id", rnd("step", 9).alias("step"), "n", "first")


@query("segment_opacity", f"""WITH {CHAIN_SQL} SELECT seg_id, j, k, round(log10(sum(kappa0 * voigt)), 4) + 0.0 AS kappa FROM vo JOIN pk USING (id, j) WHERE ok GROUP BY 1, 2, 3""")
def segment_opacity(spark, d):
    return _chain(spark, d, "symmetric").select("seg_id", "j", "k", (rnd(F.log10("kappa"), 4) + 0.0).alias("kappa"))


@query("segment_opacity_walk", f"""WITH {CHAIN_SQL}, {WALK_SQL}
SELECT seg_id, j, k, round(log10(sum(kappa0 * voigt)), 4) + 0.0 AS kappa FROM vo JOIN wk USING (id) WHERE j BETWEEN lo AND hi GROUP BY 1, 2, 3""")
def segment_opacity_walk(spark, d):
    return _chain(spark, d, "compat").select("seg_id", "j", "k", (rnd(F.log10("kappa"), 4) + 0.0).alias("kappa"))


@query("lines_to_source_function", f"""WITH {CHAIN_SQL},
 su AS (SELECT seg_id, j, k, any_value(start + j * step) AS w, any_value(temp) AS temp, sum(kappa0 * voigt) AS kappa, sum(emis0 * voigt) AS emissivity
   FROM vo JOIN pk USING (id, j) WHERE ok GROUP BY 1, 2, 3),
 sb AS (SELECT *, {B_SQL} AS b, 1e-3 * (1 + k) AS cont FROM su)
SELECT seg_id, j, k, round(log10(emissivity * b / kappa), 4) + 0.0 AS s_line, round(log10((emissivity * b + b * cont) / (kappa + cont)), 4) + 0.0 AS s_total FROM sb""")
def lines_to_source_function(spark, d):
    op = _chain(spark, d, "symmetric").join(_segments(spark, d).select("seg_id", F.col("wmin").alias("start"), "step"), "seg_id")
    op = op.join(_layers(spark, d).select("k", "temp"), "k").withColumn("cont", F.lit(1e-3) * (1 + F.col("k")))
    s = O.source_function(op, F.col("temp"), F.col("start") + F.col("j") * F.col("step"), "cont")
    return s.select("seg_id", "j", "k", (rnd(F.log10("s_line"), 4) + 0.0).alias("s_line"), (rnd(F.log10("s_total"), 4) + 0.0).alias("s_total"))


@query("continuum_beside", """WITH ct AS (SELECT p_retailprice * 50 AS x, avg(p_size) AS c FROM part GROUP BY 1),
 b AS (SELECT l.*, CASE WHEN l_extendedprice <= (SELECT min(x) FROM ct) THEN (SELECT c FROM ct ORDER BY x LIMIT 1)
   ELSE coalesce(ct.c, (SELECT c FROM ct ORDER BY x DESC LIMIT 1)) END AS c FROM lineitem l ASOF LEFT JOIN ct ON l_extendedprice < ct.x)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey AS species_id, l_extendedprice AS wave, round(c, 6) AS c0, round(c * 1.5, 6) AS c1 FROM b""")
def continuum_beside(spark, d):
    rows = table(spark, d, "part").groupBy((F.col("p_retailprice") * 50).alias("x")).agg(F.avg("p_size").alias("c"))
    rows = rows.select("x", F.array(F.col("c"), F.col("c") * 1.5).alias("cont"))
    li = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", F.col("l_suppkey").alias("species_id"), F.col("l_extendedprice").alias("wave"))
    return S.continuum_beside(li, "wave", rows, ["cont"]).select(*LINE_KEY, rnd(F.col("cont")[0], 6).alias("c0"), rnd(F.col("cont")[1], 6).alias("c1"))
