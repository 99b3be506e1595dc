"""Grid generation, corners and blending.

The catalogue is lineitem: Teff = quantity, log g = 50 discount, [Fe/H] = -50 tax; points come from part.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from specspark.functions import names as N
from specspark.operators import grid as G
from specspark.operators.layout import first_match
from specspark.plans import settings as ST
from specspark.queries.common import SERIES_SQL, rnd, series, table
from specspark.registry import query

SPAN_SQL = """sp AS (SELECT l_suppkey, min(l_extendedprice) AS lo, max(l_extendedprice) AS hi, 170.5::DOUBLE AS step
  FROM lineitem GROUP BY 1)"""


def _spans(spark, d):
    return table(spark, d, "lineitem").groupBy("l_suppkey").agg(
        F.min("l_extendedprice").alias("lo"), F.max("l_extendedprice").alias("hi")).withColumn("step", F.lit(170.5))


@query("axis_values", f"""WITH {SPAN_SQL}, a AS (SELECT *, unnest(range(ceil((hi + step - lo) / step)::BIGINT)) AS i FROM sp)
SELECT l_suppkey, round(lo + i * step, 4) AS value FROM a""")
def axis_values(spark, d):
    return G.axis_values(_spans(spark, d), "lo", "hi", "step").select("l_suppkey", rnd("value").alias("value"))


def _unit_sql(seed, *cols):
    return f"(('0x' || substr(md5(concat_ws(':', {seed}, {', '.join(cols)})), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE)"


@query("axis_distribution", f"""WITH n AS (SELECT c_nationkey, unnest(range(count(*))) AS i FROM customer GROUP BY c_nationkey)
SELECT c_nationkey, i, 'gaussian' AS kind, round(2.0::DOUBLE + 0.5 * sqrt(-2 * ln(1 - {_unit_sql(7, 'c_nationkey', 'i')})) * cos(2 * pi() * {_unit_sql(8, 'c_nationkey', 'i')}), 6) AS value FROM n
UNION ALL SELECT c_nationkey, i, 'uniform', round(1.0::DOUBLE + 2.0 * {_unit_sql(11, 'c_nationkey', 'i')}, 6) FROM n""")
def axis_distribution(spark, d):
    sizes = table(spark, d, "customer").groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("n"))
    gauss = G.axis_distribution(sizes, ["c_nationkey"], "n", "gaussian", 2.0, 0.5, seed=7, out="value")
    flat = G.axis_distribution(sizes, ["c_nationkey"], "n", "uniform", low=1.0, high=3.0, seed=11, out="value")
    both = gauss.withColumn("kind", F.lit("gaussian")).unionByName(flat.withColumn("kind", F.lit("uniform")))
    return both.select("c_nationkey", "i", "kind", rnd("value", 6).alias("value"))


@query("grid_full", """WITH a AS (SELECT DISTINCT p_brand FROM part), b AS (SELECT DISTINCT p_type FROM part), c AS (SELECT DISTINCT p_size FROM part),
g AS (SELECT *, row_number() OVER (ORDER BY p_brand, p_type, p_size) - 1 AS row_id FROM a, b, c)
SELECT row_id, p_brand, p_type, p_size FROM g""")
def grid_full(spark, d):
    part = table(spark, d, "part")
    axes = {c: G.axis_table(part, c) for c in ("p_brand", "p_type", "p_size")}
    return G.grid_full(spark, axes)


@query("grid_random", f"""WITH r AS (SELECT unnest(range(count(*))) AS row_id FROM lineitem),
a AS (SELECT p_brand, row_number() OVER (ORDER BY p_brand) - 1 AS i, count(*) OVER () AS m FROM (SELECT DISTINCT p_brand FROM part)),
b AS (SELECT p_size, row_number() OVER (ORDER BY p_size) - 1 AS i, count(*) OVER () AS m FROM (SELECT DISTINCT p_size FROM part)),
x AS (SELECT row_id, floor({_unit_sql(5, 'row_id')} * (SELECT any_value(m) FROM a))::BIGINT AS ia, floor({_unit_sql(6, 'row_id')} * (SELECT any_value(m) FROM b))::BIGINT AS ib FROM r)
SELECT row_id, p_brand, p_size FROM x JOIN a ON a.i = ia JOIN b ON b.i = ib""")
def grid_random(spark, d):
    part = table(spark, d, "part")
    axes = {c: G.axis_table(part, c) for c in ("p_brand", "p_size")}
    return G.grid_random(spark, axes, table(spark, d, "lineitem").count(), seed=5)


@query("grid_lhs", """WITH b AS (SELECT DISTINCT p_brand AS v FROM part), n AS (SELECT count(*) AS n FROM orders),
k AS (SELECT v, row_number() OVER (ORDER BY v) - 1 AS i, count(*) OVER () AS m FROM b)
SELECT v AS p_brand, n // m + CASE WHEN i < n % m THEN 1 ELSE 0 END AS n FROM k, n""")
def grid_lhs(spark, d):
    part = table(spark, d, "part")
    axes = {"p_size": G.axis_table(part, "p_size"), "p_brand": G.axis_table(part, "p_brand")}
    g = G.grid_lhs(spark, axes, table(spark, d, "orders").count(), seed=3)
    return g.groupBy("p_brand").agg(F.count(F.lit(1)).alias("n"))


@query("format_grid", """SELECT 'v1' AS grid_version, trunc(l_extendedprice / 10)::INTEGER AS teff, l_quantity AS logg,
  l_discount AS feh, 6000.0::DOUBLE AS lam_min, 6100.0::DOUBLE AS lam_max, 0.01::DOUBLE AS lam_step, '01' AS turbvel, '02' AS t_value,
  printf('%+.2f', l_discount) AS a, printf('%+.2f', l_tax) AS c, '+0.00' AS n, l_linestatus AS o, '+0.00' AS r, '+0.00' AS s,
  'Flux' AS output_mode, '1D' AS mode, 'LTE' AS calculation_mode FROM lineitem""")
def format_grid(spark, d):
    g = table(spark, d, "lineitem").select(
        (F.col("l_extendedprice") / 10).alias("teff"), F.col("l_quantity").alias("logg"),
        F.col("l_discount").alias("feh"), F.lit("02").alias("t_value"), F.col("l_discount").alias("a"),
        F.col("l_tax").alias("c"), F.col("l_linestatus").alias("o"))
    return G.format_grid(g, {"grid_version": "v1"})


@query("wave_grid_step", f"""WITH {SPAN_SQL}, a AS (SELECT *, unnest(range(trunc((hi - lo) / step)::BIGINT + 1)) AS i FROM sp)
SELECT l_suppkey, i + 1 AS j, round(lo + i * step, 4) AS wave FROM a""")
def wave_grid_step(spark, d):
    return G.wave_grid(_spans(spark, d), "lo", "hi", "step").select("l_suppkey", "j", rnd("wave").alias("wave"))


@query("wave_grid_segments", """WITH s AS (SELECT p_partkey AS seg_id, p_retailprice + 4000 AS wmin, p_retailprice + 4000 + p_size AS wmax FROM part),
t AS (SELECT *, (wmin + wmax) / 2 / 2100.7::DOUBLE AS step FROM s),
a AS (SELECT *, unnest(range(ceil((wmax - wmin) / step)::BIGINT + 1)) AS i FROM t)
SELECT seg_id, i + 1 AS j, round(wmin + i * step, 4) AS wave FROM a""")
def wave_grid_segments(spark, d):
    seg = table(spark, d, "part").select(
        F.col("p_partkey").alias("seg_id"), (F.col("p_retailprice") + 4000).alias("wmin"),
        (F.col("p_retailprice") + 4000 + F.col("p_size")).alias("wmax"))
    return G.wave_grid_segments(seg, 2100.7).select("seg_id", "j", rnd("wave").alias("wave"))


@query("tau_basis", f"""WITH {SERIES_SQL}, m AS (SELECT event_type, user_id, min(x) AS a, max(x) AS b FROM s GROUP BY 1, 2),
e AS (SELECT event_type, max(a) AS lo, min(b) AS hi FROM m GROUP BY 1),
g AS (SELECT *, unnest(range(25)) AS i FROM e)
SELECT event_type, (i + 1)::INTEGER AS k, round(lo + i * ((hi - lo) / 24), 5) AS x FROM g""")
def tau_basis(spark, d):
    return G.common_axis(series(spark, d), ["event_type"], "user_id", "x", 25).select(
        "event_type", "k", rnd("x", 5).alias("x"))


@query("gauss_nodes", """SELECT p_partkey, round(pow(p_size, 4) / 4 + pow(p_size, 2), 4) AS integral FROM part""")
def gauss_nodes(spark, d):
    size = F.col("p_size").cast("double")
    value = G.integrate_gauss(lambda t: F.pow(t, F.lit(3)) + 2 * t, F.lit(0.0), size, 5)
    return table(spark, d, "part").select("p_partkey", rnd(value).alias("integral"))


@query("depth_extrapolate", """WITH RECURSIVE m AS (SELECT p_partkey, 3000 + p_retailprice AS t1, 3000 + p_retailprice + 20 + p_size AS t2,
  ln(p_size + 10) AS p1, ln(p_size + 10) + 0.1 AS p2 FROM part),
g AS (SELECT p_partkey, 0 AS k, t1, t2, p1, p2, t2 AS t FROM m
  UNION ALL SELECT p_partkey, k + 1, t1, t2, p1, p2, t + least(400, (t2 - t1) * pow(2, (k + 1) / 2.0::DOUBLE)) FROM g WHERE t <= 6000 AND k < 100)
SELECT p_partkey, (k + 2)::INTEGER AS k, round(t, 3) AS temp, round(p2 + (p2 - p1) / (t2 - t1) * (t - t2), 5) AS log_pg FROM g""")
def depth_extrapolate(spark, d):
    t1 = 3000 + F.col("p_retailprice")
    p1 = F.log(F.col("p_size") + F.lit(10.0))
    m = table(spark, d, "part").select(
        "p_partkey", F.array(t1, t1 + 20 + F.col("p_size")).alias("temp"), F.array(p1, p1 + 0.1).alias("log_pg"),
        F.array(F.lit(1.0), F.lit(2.0)).alias("rho"))
    g = G.extend_depths(m, max_layers=102)
    out = g.select("p_partkey", F.posexplode(F.arrays_zip("temp", "log_pg")).alias("i", "v")).filter("i >= 1")
    return out.select("p_partkey", (F.col("i") + 1).alias("k"), rnd("v.temp", 3).alias("temp"),
                      rnd("v.log_pg", 5).alias("log_pg"))


# --- corners -----------------------------------------------------------------------------

CATALOG_SQL = """mo AS (SELECT l_returnflag AS turb, l_quantity AS teff, l_discount * 50 AS logg, l_tax * -50 + 0.0 AS feh, l_orderkey, l_linenumber,
   l_partkey, l_suppkey, l_extendedprice FROM lineitem),
 pt AS (SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN 'A' WHEN 1 THEN 'N' ELSE 'R' END AS turb, p_size + 0.25 AS teff,
   (p_partkey % 60) / 10.0::DOUBLE AS logg, (p_partkey % 45) / -10.0::DOUBLE AS feh FROM part)"""


def _axis_sql(a: str) -> str:
    return f"""ax_{a} AS (SELECT *, lead(v) OVER w AS nv, row_number() OVER w AS i, count(*) OVER (PARTITION BY turb) AS n
   FROM (SELECT DISTINCT turb, {a} AS v FROM mo) WINDOW w AS (PARTITION BY turb ORDER BY v)),
 br_{a} AS (SELECT p_partkey, v AS {a}_inf, nv AS {a}_sup FROM pt JOIN ax_{a} USING (turb) WHERE nv IS NOT NULL
   AND ({a} >= v OR i = 1) AND ({a} < nv OR i = n - 1))"""


BRACKETS_SQL = CATALOG_SQL + ", " + ", ".join(_axis_sql(a) for a in ("teff", "logg", "feh")) + """,
 bp AS (SELECT pt.*, teff_inf, teff_sup, logg_inf, logg_sup, feh_inf, feh_sup FROM pt JOIN br_teff USING (p_partkey)
   JOIN br_logg USING (p_partkey) JOIN br_feh USING (p_partkey)),
 co AS (SELECT bp.*, c + 1 AS corner, CASE WHEN c & 4 > 0 THEN teff_sup ELSE teff_inf END AS c_teff,
   CASE WHEN c & 2 > 0 THEN logg_sup ELSE logg_inf END AS c_logg, CASE WHEN c & 1 > 0 THEN feh_sup ELSE feh_inf END AS c_feh
   FROM bp, (SELECT unnest(range(8)) AS c))"""
CORNERS_SQL = BRACKETS_SQL + """,
 fi AS (SELECT *, row_number() OVER (PARTITION BY turb, teff, logg, feh ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS r FROM mo),
 cr AS (SELECT co.*, concat(fi.l_orderkey, '-', fi.l_linenumber, '-', fi.l_partkey) AS path, fi.l_orderkey IS NOT NULL AS found FROM co
   LEFT JOIN fi ON fi.r = 1 AND co.turb = fi.turb AND c_teff = fi.teff AND c_logg = fi.logg AND c_feh = fi.feh)"""


def catalog(spark, d):
    return table(spark, d, "lineitem").select(
        F.col("l_returnflag").alias("turb"), F.col("l_quantity").alias("teff"),
        (F.col("l_discount") * 50).alias("logg"), (F.col("l_tax") * -50 + F.lit(0.0)).alias("feh"),
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey").alias("path"),
        F.struct("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice").alias("cat_pos"))


def points(spark, d):
    k = F.col("p_partkey")
    return table(spark, d, "part").select(
        "p_partkey", F.when(k % 3 == 0, "A").when(k % 3 == 1, "N").otherwise("R").alias("turb"),
        (F.col("p_size") + 0.25).alias("teff"), ((k % 60) / F.lit(10.0)).alias("logg"),
        ((k % 45) / F.lit(-10.0)).alias("feh"))


def point_corners(spark, d):
    return G.corners(points(spark, d), "p_partkey", catalog(spark, d))


@query("grid_corners", f"""WITH {CORNERS_SQL} SELECT p_partkey, corner::INTEGER AS corner, c_teff, round(c_logg, 4) AS c_logg,
  round(c_feh, 4) + 0.0 AS c_feh, CASE WHEN found THEN path END AS path FROM cr""")
def grid_corners(spark, d):
    c = point_corners(spark, d)
    return c.select("p_partkey", "corner", "c_teff", rnd("c_logg").alias("c_logg"), rnd("c_feh").alias("c_feh"), "path")


@query("missing_corners", f"""WITH {CORNERS_SQL},
mi AS (SELECT *, row_number() OVER (PARTITION BY p_partkey ORDER BY corner) AS k, count(*) OVER (PARTITION BY p_partkey) AS n FROM cr WHERE NOT found)
SELECT p_partkey, n::INTEGER AS n_missing, corner::INTEGER AS corner FROM mi WHERE k = 1""")
def missing_corners(spark, d):
    c = point_corners(spark, d)
    gone = G.missing_corners(c, "p_partkey")
    first = c.filter("path IS NULL").groupBy("p_partkey").agg(F.min("corner").alias("corner"))
    return gone.join(first, "p_partkey").select("p_partkey", "n_missing", "corner")


@query("distinct_axes", """SELECT l_returnflag AS turb, string_agg(DISTINCT l_quantity::INTEGER, ',' ORDER BY l_quantity::INTEGER) AS teff_axis,
  count(DISTINCT l_discount)::INTEGER AS n_logg, count(DISTINCT l_tax)::INTEGER AS n_feh FROM lineitem GROUP BY 1""")
def distinct_axes(spark, d):
    a = G.axes(catalog(spark, d))
    text = F.array_join(F.transform("teff_axis", lambda v: v.cast("int").cast("string")), ",")
    return a.select("turb", text.alias("teff_axis"), F.size("logg_axis").alias("n_logg"),
                    F.size("feh_axis").alias("n_feh"))


@query("extent", """SELECT l_returnflag AS turb, min(l_extendedprice) AS min_wave, max(l_extendedprice) AS max_wave,
  min(l_quantity) AS min_teff, max(l_quantity) AS max_teff FROM lineitem GROUP BY 1""")
def extent(spark, d):
    li = table(spark, d, "lineitem").select(F.col("l_returnflag").alias("turb"), F.col("l_extendedprice").alias("wave"),
                                            F.col("l_quantity").alias("teff"))
    return G.extent(li, ["turb"], ["wave", "teff"])


# models for blending: one per (quantity, discount, tax) cell, depth index = line number parity
CELL_SQL = """ce AS (SELECT l_quantity AS teff, l_discount * 50 AS logg, l_tax * -50 + 0.0 AS feh, (l_linenumber % 2)::INTEGER AS k,
   avg(l_extendedprice) * 0.987654321::DOUBLE AS temp, ln(min(l_extendedprice)) AS log_pe, ln(max(l_extendedprice)) AS log_pg, avg(sqrt(l_partkey + 1)) AS radius
   FROM lineitem GROUP BY 1, 2, 3, 4)"""
BLEND_SQL = BRACKETS_SQL.replace("l_returnflag AS turb", "'all' AS turb").replace(
    "CASE p_partkey % 3 WHEN 0 THEN 'A' WHEN 1 THEN 'N' ELSE 'R' END", "'all'") + ", " + CELL_SQL


def _cells(spark, d):
    li = table(spark, d, "lineitem")
    cell = [F.col("l_quantity").alias("teff"), (F.col("l_discount") * 50).alias("logg"), (F.col("l_tax") * -50 + F.lit(0.0)).alias("feh")]
    depths = li.groupBy(*cell, (F.col("l_linenumber") % 2).alias("k")).agg(
        (F.avg("l_extendedprice") * 0.987654321).alias("temp"), F.log(F.min("l_extendedprice")).alias("log_pe"),
        F.log(F.max("l_extendedprice")).alias("log_pg"), F.avg(F.sqrt(F.col("l_partkey") + 1)).alias("radius"))
    name = F.concat_ws("_", F.col("teff").cast("string"), F.col("logg").cast("string"), F.col("feh").cast("string"))
    depths = depths.withColumn("model_id", name)
    models = depths.select("teff", "logg", "feh", "model_id").distinct().select(
        F.lit("all").alias("turb"), "teff", "logg", "feh", F.col("model_id").alias("path"),
        F.col("model_id").alias("cat_pos"))
    pts = points(spark, d).withColumn("turb", F.lit("all"))
    return G.corners(pts, "p_partkey", models), depths.drop("teff", "logg", "feh")


def _blend_sql(q: str, dif: tuple | None) -> str:
    """Sum of corner weights times q."""
    parts = []
    for n, (a, bit, span) in enumerate((("teff", 4, 3200), ("logg", 2, 5), ("feh", 1, 4))):
        c = f"(CASE WHEN {a}_sup = {a}_inf THEN 0 ELSE ({a} - {a}_inf) / ({a}_sup - {a}_inf) END)"
        if dif:
            e = dif[n] if not isinstance(dif[n], tuple) else f"(1 - pow(teff / {dif[n][0]}, {dif[n][1]}))"
            p = f"pow({c}, 1 - {e} * abs({a}_sup - {a}_inf) / {span}.0)"
            c = f"(CASE WHEN {c} < 0 THEN NULL ELSE CASE WHEN isfinite({p}) THEN {p} END END)"
        parts.append(f"CASE WHEN ((corner - 1) & {bit}) > 0 THEN {c} ELSE 1 - {c} END")
    w = " * ".join(f"({p})" for p in parts)
    return f"CASE WHEN count(*) = 8 AND count({w}) = 8 THEN sum({w} * {q}) END"


JOINED_SQL = BLEND_SQL + """,
 jo AS (SELECT co.*, ce.k, ce.temp, ce.log_pe, ce.log_pg, ce.radius FROM co JOIN ce ON c_teff = ce.teff AND c_logg = ce.logg AND c_feh = ce.feh)"""


@query("trilinear", f"""WITH {JOINED_SQL}
SELECT p_partkey, k, bool_or(teff < teff_inf OR teff > teff_sup OR logg < logg_inf OR logg > logg_sup OR feh < feh_inf OR feh > feh_sup) AS extrapolated,
  round({_blend_sql('temp', None)}, 3) AS temp, round({_blend_sql('log_pe', None)}, 6) AS log_pe,
  round({_blend_sql('radius', None)}, 4) AS radius FROM jo GROUP BY p_partkey, k""")
def trilinear(spark, d):
    corner_rows, depths = _cells(spark, d)
    b = G.blend_corners(corner_rows, "p_partkey", depths, "model_id", ["k"], ["temp", "log_pe", "radius"], optimize=False)
    return b.select("p_partkey", "k", "extrapolated", rnd("temp", 3).alias("temp"), rnd("log_pe", 6).alias("log_pe"),
                    rnd("radius").alias("radius"))


@query("trilinear_2", f"""WITH {JOINED_SQL}
SELECT p_partkey, k, round({_blend_sql('temp', (0.15, 0.3, (4000.0, 2.0)))}, 3) AS temp,
  round({_blend_sql('log_pe', (0.15, 0.06, (3500.0, 2.5)))}, 6) AS log_pe,
  round({_blend_sql('log_pg', (-0.4, 0.06, (4100.0, 4.0)))}, 6) AS log_pg,
  round({_blend_sql('radius', None)}, 4) AS radius FROM jo GROUP BY p_partkey, k""")
def trilinear_optimized(spark, d):
    corner_rows, depths = _cells(spark, d)
    b = G.blend_corners(corner_rows, "p_partkey", depths, "model_id", ["k"], ["temp", "log_pe", "log_pg", "radius"])
    return b.select("p_partkey", "k", rnd("temp", 3).alias("temp"), rnd("log_pe", 6).alias("log_pe"),
                    rnd("log_pg", 6).alias("log_pg"), rnd("radius").alias("radius"))


@query("trilinear_departures", f"""WITH {JOINED_SQL}, un AS (SELECT jo.*, unnest([1, 2]) AS level, unnest([log_pe / log_pg, temp / 100000]) AS b FROM jo)
SELECT p_partkey, k, level, round({_blend_sql('b', None)}, 6) AS b FROM un GROUP BY p_partkey, k, level""")
def trilinear_departures(spark, d):
    corner_rows, depths = _cells(spark, d)
    levels = depths.select("model_id", "k", F.posexplode(F.array(
        F.col("log_pe") / F.col("log_pg"), F.col("temp") / 100000)).alias("level", "b")) \
        .withColumn("level", F.col("level") + 1)
    b = G.blend_corners(corner_rows, "p_partkey", levels, "model_id", ["k", "level"], ["b"], optimize=False)
    return b.select("p_partkey", "k", "level", rnd("b", 6).alias("b"))


def _error_sql(q, c):
    return f"""round(100 * (least(teff_sup - teff, teff - teff_inf) / 100 * ({c[0]}) + least(logg_sup - logg, logg - logg_inf) * ({c[1]})
  + least(feh_sup - feh, feh - feh_inf) * ({c[2]})), 6) + 0.0 AS err_{q}"""


@query("interp_error", f"""WITH {BRACKETS_SQL} SELECT p_partkey,
  {_error_sql('temp', ('0.055::DOUBLE / 32', '0.008::DOUBLE / 5', '0.015::DOUBLE / 4'))},
  {_error_sql('kappa', ('0.8::DOUBLE / 32', '0.36::DOUBLE / 5', '0.38::DOUBLE / 4'))} FROM bp""")
def interp_error(spark, d):
    b = G.interp_error(G.bracket_points(points(spark, d), catalog(spark, d)))
    return b.select("p_partkey", rnd("err_temp", 6).alias("err_temp"), rnd("err_kappa", 6).alias("err_kappa"))


@query("geometry_check", f"""WITH {CORNERS_SQL},
 pa AS (SELECT cr.p_partkey, fi.l_linenumber % 3 AS n, fi.l_orderkey % 20 AS g, fi.l_suppkey % 40 AS x FROM cr JOIN fi ON fi.r = 1 AND cr.turb = fi.turb
   AND c_teff = fi.teff AND c_logg = fi.logg AND c_feh = fi.feh WHERE found)
SELECT p_partkey, CASE WHEN min(CASE WHEN g = 0 THEN 's' ELSE 'p' END) <> max(CASE WHEN g = 0 THEN 's' ELSE 'p' END)
   OR min(CASE WHEN x = 0 THEN 1 ELSE 0 END) <> max(CASE WHEN x = 0 THEN 1 ELSE 0 END) THEN 'error'
   WHEN min(n) <> max(n) THEN 'resample' ELSE 'ok' END AS status FROM pa GROUP BY 1""")
def geometry_check(spark, d):
    c = point_corners(spark, d)
    li = table(spark, d, "lineitem").select(
        F.col("l_returnflag").alias("turb"), F.col("l_quantity").alias("c_teff"), (F.col("l_discount") * 50).alias("c_logg"),
        (F.col("l_tax") * -50 + F.lit(0.0)).alias("c_feh"), "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    cell = ["turb", "c_teff", "c_logg", "c_feh"]
    first = first_match(li, cell, ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"])
    info = first.select(*cell, F.when(F.col("l_orderkey") % 20 == 0, "s").otherwise("p").alias("geometry"),
                        F.when(F.col("l_suppkey") % 40 == 0, 1).otherwise(0).alias("xlr"),
                        (F.col("l_linenumber") % 3).alias("ndepth"))
    return G.check_corners(c.filter("path IS NOT NULL").join(info, cell), "p_partkey").select("p_partkey", "status")


# --- names -------------------------------------------------------------------------------

NAME_SQL = """nm AS (SELECT p_partkey, concat('p', p_size * 100, '_g', printf('%+.1f', p_size / 10.0::DOUBLE), '_m0.0_t', lpad((p_partkey % 7)::VARCHAR, 2, '0'),
  '_st_z', printf('%+.2f', (p_partkey % 45) / -10.0::DOUBLE), '_a+0.00_c+0.00_n+0.00_o+0.00_r+0.00_s+0.00.mod') AS name FROM part)"""


def _named(spark, d):
    k = F.col("p_partkey")
    name = N.format_model_name(F.col("p_size") * 100, F.col("p_size") / F.lit(10.0), (k % 45) / F.lit(-10.0),
                               F.lpad((k % 7).cast("string"), 2, "0"))
    return table(spark, d, "part").select("p_partkey", name.alias("name"))


@query("format_model_name", f"WITH {NAME_SQL} SELECT p_partkey, replace(name, '-0.00', '+0.00') AS name FROM nm")
def format_model_name(spark, d):
    return _named(spark, d).withColumn("name", F.replace("name", F.lit("-0.00"), F.lit("+0.00")))


@query("parse_model_name", """SELECT p_partkey, p_size * 100 AS teff, p_size / 10.0::DOUBLE AS logg,
  lpad((p_partkey % 7)::VARCHAR, 2, '0') AS turb, round((p_partkey % 45) / -10.0::DOUBLE, 2) + 0.0 AS feh FROM part""")
def parse_model_name(spark, d):
    m = _named(spark, d).withColumn("m", N.parse_model_name(F.col("name")))
    return m.select("p_partkey", "m.teff", "m.logg", "m.turb", rnd("m.feh", 2).alias("feh"))


@query("turb_normalise", """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice,
  CASE l_linenumber WHEN 1 THEN l_returnflag WHEN 2 THEN lpad(l_quantity::INTEGER::VARCHAR, 2, '0') ELSE l_tax::VARCHAR END AS label,
  CASE l_linenumber WHEN 1 THEN 1.0 WHEN 2 THEN CASE WHEN l_quantity > 10 THEN l_quantity / 10 ELSE l_quantity END ELSE l_tax END AS value FROM lineitem""")
def turb_normalise(spark, d):
    li = table(spark, d, "lineitem")
    raw = F.when(F.col("l_linenumber") == 1, F.col("l_returnflag")) \
        .when(F.col("l_linenumber") == 2, F.concat(F.lit(" "), F.col("l_quantity").cast("int").cast("string"))) \
        .otherwise(F.col("l_tax").cast("string"))
    return li.withColumn("t", N.turb_normalise(raw)).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "t.label", "t.value")


@query("fwhm_to_wave", """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice,
  round(CASE WHEN l_quantity - 25 < 0 THEN (25 - l_quantity) * l_extendedprice / 2.99792458e5 ELSE (l_quantity - 25) / 1000 END, 6) AS width FROM lineitem""")
def fwhm_to_wave(spark, d):
    return table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice",
        rnd(N.fwhm_to_wave(F.col("l_quantity") - 25, F.col("l_extendedprice")), 6).alias("width"))


@query("limb_radius", """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, round(sqrt(1 - l_quantity / 50 * (l_quantity / 50)), 8) AS r FROM lineitem""")
def limb_radius(spark, d):
    return table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice",
        rnd(N.limb_radius(F.col("l_quantity") / 50), 8).alias("r"))


@query("doppler_shift", """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice,
  round(l_extendedprice * (1 - (l_quantity - 25) / 2.99792458e5), 6) AS shifted FROM lineitem""")
def doppler_shift(spark, d):
    return table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice",
        rnd(N.doppler_shift(F.col("l_extendedprice"), F.col("l_quantity") - 25), 6).alias("shifted"))


@query("case_fold", """SELECT p_partkey, upper(p_name) AS up, lower(p_brand) AS low, length(rtrim(concat(p_name, '   ')))::INTEGER AS sig_len FROM part""")
def case_fold(spark, d):
    return table(spark, d, "part").select(
        "p_partkey", F.upper("p_name").alias("up"), F.lower("p_brand").alias("low"),
        N.sig_len(F.concat("p_name", F.lit("   "))).alias("sig_len"))


@query("config_override", """SELECT event_id, CASE WHEN event_type = 'click' THEN (props->>'$.k')::DOUBLE ELSE 1.5 END AS setting,
  CASE WHEN event_type = 'click' THEN (props->>'$.k')::INTEGER ELSE 26 END AS z, 7.5::DOUBLE AS a FROM events""")
def config_override(spark, d):
    k = F.get_json_object("props", "$.k")
    ev = table(spark, d, "events").withColumn("k", F.when(F.col("event_type") == "click", k))
    text = F.concat(F.lit('{"'), F.coalesce("k", F.lit("26")), F.lit('": 7.5}'))
    ev = ev.withColumn("o", F.element_at(N.parse_overrides(text), 1))
    return ev.select("event_id", N.config_override(F.col("k").try_cast("double"), F.lit(1.5)).alias("setting"),
                     "o.z", "o.a")


NESTED_SQL = """WITH c AS (SELECT c_custkey, c_nationkey AS n, c_mktsegment = 'BUILDING' AS b, c_custkey % 3 AS k, c_acctbal FROM customer),
 sc AS (SELECT c_custkey, 'metallicity' AS item, NULL::INTEGER AS z, NULL::INTEGER AS a, CASE WHEN k = 0 THEN round(c_acctbal / 1000, 3) WHEN b THEN -0.5 ELSE n / 10 END::DOUBLE AS value FROM c
   UNION ALL SELECT c_custkey, 'turbvel', NULL, NULL, CASE WHEN k = 1 THEN 2 ELSE 1 END FROM c),
 ab AS (SELECT c_custkey, 'abundance', 26, NULL, CASE WHEN k = 0 THEN 7.0 ELSE round(7.5 + n / 100, 2) END FROM c UNION ALL SELECT c_custkey, 'abundance', 20, NULL, CASE WHEN b THEN 6.0 ELSE 6.34 END FROM c
   UNION ALL SELECT c_custkey, 'abundance', 8, NULL, 8.69 FROM c WHERE k = 0),
 iso AS (SELECT c_custkey, 'isotope', 6, 12, CASE WHEN b THEN 0.95 ELSE 0.9 END FROM c UNION ALL SELECT c_custkey, 'isotope', 6, 13, CASE WHEN k = 0 THEN 0.05 ELSE 0.1 END FROM c
   UNION ALL SELECT c_custkey, 'isotope', 12, 24, 0.79 FROM c UNION ALL SELECT c_custkey, 'isotope', 3, 7, 1.0 FROM c WHERE k = 0)
SELECT * FROM sc UNION ALL SELECT * FROM ab UNION ALL SELECT * FROM iso"""


@query("nested_overrides", NESTED_SQL)
def nested_overrides(spark, d):
    """Three levels for every customer: defaults, a grid where the segment has one, and the point itself."""
    k = F.col("c_custkey") % 3
    defaults = F.format_string('{"metallicity": %.1f, "turbvel": 1.0, "individual_abundances": [[26, %.2f], [20, 6.34]], "isotopes": [[6.012, 0.9], [6.013, 0.1], [12.024, 0.79]]}',
                               F.col("c_nationkey") / 10, 7.5 + F.col("c_nationkey") / 100)
    grid = F.when(F.col("c_mktsegment") == "BUILDING", '{"metallicity": -0.5, "individual_abundances": [[20, 6.0]], "isotopes": [[6.012, 0.95]]}')
    point = F.when(k == 0, F.format_string('{"metallicity": %.3f, "individual_abundances": [[26, 9.9], [8, 8.69], [26, 7.0]], "isotopes": [[6.013, 0.05], [3.007, 1.0]]}', F.col("c_acctbal") / 1000)) \
        .when(k == 1, '{"turbvel": 2, "individual_abundances": [], "isotopes": null}').otherwise("{}")
    df = table(spark, d, "customer").withColumn("s", ST.merge_settings([defaults, grid, point]))
    none = F.lit(None).cast("int")
    row = lambda item, z, a, v: F.struct(F.lit(item).alias("item"), z.alias("z"), a.alias("a"), v.alias("value"))
    rows = F.concat(F.array(row("metallicity", none, none, F.col("s.metallicity")), row("turbvel", none, none, F.col("s.turbvel"))),
                    F.transform(ST.abundance_rows(F.col("s")), lambda r: row("abundance", r["z"], none, r["a_log"])),
                    F.transform(ST.isotope_rows(F.col("s")), lambda r: row("isotope", r["z"], r["a"], r["frac"])))
    return df.select("c_custkey", F.explode(rows).alias("r")).select("c_custkey", "r.*")
