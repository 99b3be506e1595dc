"""Ordered-series operators on the event traces (one series per user)."""

from __future__ import annotations

from pyspark.sql import functions as F

from specspark.operators import series as S
from specspark.operators.layout import first_match, small_table
from specspark.queries.common import (
    SERIES_SQL, SPECTRA_SQL, packed_spectra, rnd, series, table,
)
from specspark.registry import query

LAGGED = SERIES_SQL + """,
 n AS (SELECT *, lag(x) OVER w AS px, lag(y) OVER w AS py, lead(x) OVER w AS nx, lead(y) OVER w AS ny,
   row_number() OVER w AS i FROM s WINDOW w AS (PARTITION BY user_id ORDER BY x))"""

# purchases are the targets, every other event of the user the table
TABLE_SQL = SERIES_SQL + """,
 t AS (SELECT *, lag(x) OVER w AS px, lag(y) OVER w AS py, lead(x) OVER w AS nx, lead(y) OVER w AS ny,
   lead(x, 2) OVER w AS nx2, lead(y, 2) OVER w AS ny2, row_number() OVER w AS i,
   count(*) OVER (PARTITION BY user_id) AS n
   FROM s WHERE event_type <> 'purchase' WINDOW w AS (PARTITION BY user_id ORDER BY x)),
 q AS (SELECT user_id, event_id, x AS xt FROM s WHERE event_type = 'purchase'),
 m AS (SELECT q.event_id, q.xt, t.* EXCLUDE (event_id) FROM q JOIN t ON q.user_id = t.user_id AND t.nx IS NOT NULL
   AND (q.xt >= t.x OR t.i = 1) AND (q.xt < t.nx OR t.i = t.n - 1))"""


def _targets_and_table(spark, d):
    s = series(spark, d)
    targets = s.filter("event_type = 'purchase'").select("user_id", "event_id", F.col("x").alias("xt"))
    return targets, s.filter("event_type <> 'purchase'").select("user_id", "x", "y")


@query("cumulative_trapz", f"""WITH {LAGGED}
SELECT user_id, event_id, round(sum(CASE WHEN px IS NULL THEN x * y ELSE (x - px) * (y + py) / 2 END)
  OVER (PARTITION BY user_id ORDER BY x), 4) AS depth FROM n""")
def cumulative_trapz(spark, d):
    df = S.cumulative_trapz(series(spark, d), ["user_id"], "x", "y")
    return df.select("user_id", "event_id", rnd("depth").alias("depth"))


@query("first_crossing", f"""WITH {LAGGED},
c AS (SELECT *, sum(CASE WHEN px IS NULL THEN x * y ELSE (x - px) * (y + py) / 2 END)
  OVER (PARTITION BY user_id ORDER BY x) AS depth FROM n),
f AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY x) AS r FROM c WHERE depth >= 500)
SELECT user_id, event_id, round(x, 6) AS x, round(depth, 4) AS depth FROM f WHERE r = 1""")
def first_crossing(spark, d):
    df = S.cumulative_trapz(series(spark, d), ["user_id"], "x", "y")
    hit = S.first_crossing(df, ["user_id"], "x", "depth", 500.0)
    return hit.select("user_id", "event_id", rnd("x", 6).alias("x"), rnd("depth").alias("depth"))


@query("column_mass", f"""WITH {LAGGED},
c AS (SELECT *, max(i) OVER (PARTITION BY user_id) AS cnt, nx - x AS h, x - px AS g FROM n),
p AS (SELECT *, (y + ny) * h / 2 AS straight,
  y * h + (y - py) / g * h * h / 2 + ((ny - y) / h - (y - py) / g) / (h + g) * (h * h * h / 3 + g * h * h / 2) AS bent
  FROM c),
q AS (SELECT user_id, event_id, x, CASE WHEN i = 1 THEN x * y
  WHEN i - 1 <= 3 OR i = cnt THEN lag(straight) OVER w ELSE lag(bent) OVER w END AS piece
  FROM p WINDOW w AS (PARTITION BY user_id ORDER BY x))
SELECT user_id, event_id, round(sum(piece) OVER (PARTITION BY user_id ORDER BY x), 4) AS mass FROM q""")
def column_mass(spark, d):
    df = S.cumulative_parabolic(series(spark, d), ["user_id"], "x", "y")
    return df.select("user_id", "event_id", rnd("mass").alias("mass"))


@query("steps", f"""WITH {LAGGED}
SELECT user_id, event_id, round(coalesce(nx - x, x - px), 8) AS step,
  round((coalesce(nx - x, 0) + coalesce(x - px, 0)) / 2, 8) AS weight FROM n""")
def steps(spark, d):
    df = S.steps(series(spark, d), ["user_id"], "x")
    return df.select("user_id", "event_id", rnd("step", 8).alias("step"), rnd("weight", 8).alias("weight"))


@query("log_diff", f"""WITH {LAGGED} SELECT user_id, event_id, round(ln(y) - ln(py), 6) + 0.0 AS dlog FROM n""")
def log_diff(spark, d):
    df = S.log_diff(series(spark, d), ["user_id"], "x", "y")
    return df.select("user_id", "event_id", rnd("dlog", 6).alias("dlog"))


@query("gradient", f"""WITH {LAGGED} SELECT user_id, event_id,
  round((coalesce(ny, y) - coalesce(py, y)) / (coalesce(nx, x) - coalesce(px, x)), 3) + 0.0 AS slope FROM n""")
def gradient(spark, d):
    df = S.gradient(series(spark, d), ["user_id"], "x", "y")
    return df.select("user_id", "event_id", rnd("slope", 3).alias("slope"))


@query("every_n", f"WITH {LAGGED} SELECT user_id, event_id, y FROM n WHERE (i - 1) % 3 = 0")
def every_n(spark, d):
    return S.every_n(series(spark, d), ["user_id"], "x", 3).select("user_id", "event_id", "y")


@query("carry_forward", f"""WITH {SERIES_SQL}
SELECT user_id, event_id, last_value(CASE WHEN event_type = 'signup' THEN y END IGNORE NULLS)
  OVER (PARTITION BY user_id ORDER BY x ROWS UNBOUNDED PRECEDING) AS header FROM s""")
def carry_forward(spark, d):
    df = series(spark, d).withColumn("mark", F.when(F.col("event_type") == "signup", F.col("y")))
    return S.carry_forward(df, ["user_id"], ["x"], "mark", "header").select("user_id", "event_id", "header")


@query("first_match", f"""WITH {SERIES_SQL},
r AS (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY y DESC, event_id) AS k FROM s)
SELECT user_id, event_type, event_id, y FROM r WHERE k = 1""")
def first_match_(spark, d):
    df = series(spark, d).select("user_id", "event_type", "event_id", "y")
    return first_match(df, ["user_id", "event_type"], [-F.col("y"), "event_id"])


@query("running_offset", """SELECT o_custkey, o_orderkey, CAST(coalesce(sum(n) OVER (PARTITION BY o_custkey ORDER BY o_orderkey
  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS "offset"
FROM (SELECT o_custkey, o_orderkey, count(l_orderkey) AS n FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey
  GROUP BY 1, 2)""")
def running_offset(spark, d):
    sizes = table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count(F.lit(1)).alias("n"))
    blocks = table(spark, d, "orders").select("o_custkey", "o_orderkey").join(sizes, "o_orderkey", "left")
    blocks = blocks.withColumn("n", F.coalesce("n", F.lit(0).cast("bigint")))
    return S.running_offset(blocks, ["o_custkey"], ["o_orderkey"], "n").select("o_custkey", "o_orderkey", "offset")


@query("formal_intensity", f"""WITH {LAGGED},
p AS (SELECT user_id, CASE WHEN nx IS NULL
   THEN (y + coalesce((y - py) / (x / 0.8 - px / 0.8), 0)) * exp(-x / 0.8)
   ELSE (y * exp(-x / 0.8) + ny * exp(-nx / 0.8)) * 0.5 * (nx / 0.8 - x / 0.8) END AS piece FROM n)
SELECT user_id, round(sum(piece), 5) AS intensity FROM p GROUP BY user_id""")
def formal_intensity(spark, d):
    df = S.formal_intensity(series(spark, d), ["user_id"], "x", "y", mu=0.8)
    return df.select("user_id", rnd("intensity", 5).alias("intensity"))


@query("formal_intensity_2", f"""WITH {LAGGED},
p AS (SELECT user_id, CASE WHEN nx IS NULL
   THEN y * (1 - exp(-min(x) OVER (PARTITION BY user_id) / 20.0)) * exp(-x / 20.0)
   ELSE (y * exp(-x / 20.0) + ny * exp(-nx / 20.0)) * 0.5 * (nx / 20.0 - x / 20.0) END AS piece FROM n)
SELECT user_id, round(sum(piece), 5) AS intensity FROM p GROUP BY user_id""")
def formal_intensity_thin(spark, d):
    df = S.formal_intensity(series(spark, d), ["user_id"], "x", "y", mu=20.0, thin=True)
    return df.select("user_id", rnd("intensity", 5).alias("intensity"))


@query("interp_linear", f"""WITH {TABLE_SQL}
SELECT event_id, round((ny - y) * ((xt - x) / (nx - x)) + y, 3) + 0.0 AS y_interp, (xt < x OR xt > nx) AS extrapolated FROM m""")
def interp_linear(spark, d):
    targets, tab = _targets_and_table(spark, d)
    df = S.interp_linear(targets, "xt", tab, "x", "y", ["user_id"])
    return df.select("event_id", rnd("y_interp", 3).alias("y_interp"), "extrapolated")


SMALL_AXIS = [(1000.0, 0.30), (8000.0, 0.42), (20000.0, 0.55), (45000.0, 0.71), (90000.0, 0.80)]


@query("interp_linear_2", """WITH a(x, y) AS (VALUES (1000.0::DOUBLE, 0.30::DOUBLE), (8000.0, 0.42), (20000.0, 0.55), (45000.0, 0.71), (90000.0, 0.80)),
t AS (SELECT *, lead(x) OVER (ORDER BY x) AS nx, lead(y) OVER (ORDER BY x) AS ny, row_number() OVER (ORDER BY x) AS i FROM a)
SELECT l_suppkey, count(*) AS n, round(sum((ny - y) * ((l_extendedprice - x) / (nx - x)) + y), 5) AS total,
  count(*) FILTER (l_extendedprice < x OR l_extendedprice > nx) AS n_extrapolated
FROM lineitem JOIN t ON nx IS NOT NULL AND (l_extendedprice >= x OR i = 1) AND (l_extendedprice < nx OR i = 4)
GROUP BY l_suppkey""")
def interp_linear_small(spark, d):
    axis = small_table(spark, SMALL_AXIS, "x double, y double")
    li = table(spark, d, "lineitem").select("l_suppkey", "l_extendedprice")
    df = S.interp_linear(li, "l_extendedprice", axis, "x", "y")
    return df.groupBy("l_suppkey").agg(
        F.count(F.lit(1)).alias("n"), rnd(F.sum("y_interp"), 5).alias("total"),
        F.count_if("extrapolated").alias("n_extrapolated"))


@query("nearest_row", f"""WITH {TABLE_SQL},
r AS (SELECT q.event_id, t.x, t.y, row_number() OVER (PARTITION BY q.event_id ORDER BY abs(t.x - q.xt), t.x) AS k
  FROM q JOIN t ON q.user_id = t.user_id)
SELECT event_id, round(x, 6) AS near_x, y AS near_y FROM r WHERE k = 1""")
def nearest_row(spark, d):
    targets, tab = _targets_and_table(spark, d)
    df = S.nearest_row(targets, "xt", tab, "x", ["y"], ["user_id"])
    return df.select("event_id", rnd("near_x", 6).alias("near_x"), "near_y")


def _cubic_sql(inner: str, edge: tuple[float, float]) -> str:
    """Slopes of the table rows: ``inner`` in between, straight/curved mix at the two ends."""
    return TABLE_SQL + f""",
 u0 AS (SELECT *, nx - x AS dx, x - px AS dxm, (ny - y) / (nx - x) AS sx, (y - py) / (x - px) AS sxm FROM t),
 u1 AS (SELECT *, CASE WHEN nx IS NOT NULL AND px IS NOT NULL THEN {inner} END AS u FROM u0),
 u2 AS (SELECT * EXCLUDE (u), coalesce(u, {edge[0]} * coalesce(sx, sxm) - {edge[1]} * coalesce(lead(u) OVER w, lag(u) OVER w)) AS u
   FROM u1 WINDOW w AS (PARTITION BY user_id ORDER BY x)),
 u3 AS (SELECT *, lead(u) OVER w AS nu, lag(u) OVER w AS pu FROM u2 WINDOW w AS (PARTITION BY user_id ORDER BY x)),
 h AS (SELECT q.event_id, q.xt, c.* EXCLUDE (event_id), c.nx - c.x AS dd, c.ny - c.y AS rise, (q.xt - c.x) / (c.nx - c.x) AS rr
   FROM q JOIN u3 c ON q.user_id = c.user_id AND c.nx IS NOT NULL
   AND (q.xt >= c.x OR c.i = 1) AND (q.xt < c.nx OR c.i = c.n - 1))"""


CUBIC = {
    1: _cubic_sql("(ny - py) / (nx - px)", (1.0, 0.0)),
    2: _cubic_sql("(sx * dxm + sxm * dx) / (dxm + dx)", (2.0, 1.0)),
    3: _cubic_sql("""2 * (greatest(least((sx * dxm + sxm * dx) / (2 * (dxm + dx)), sx, sxm), 0)
      + least(greatest((sx * dxm + sxm * dx) / (2 * (dxm + dx)), sx, sxm), 0))""", (1.5, 0.5)),
}
CUBIC_SELECT = """SELECT event_id, round(CASE WHEN xt < x THEN y + u * (xt - x) WHEN xt >= nx THEN ny + nu * (xt - nx)
  ELSE ((((u + nu) * dd - 2 * rise) * rr + ((-2 * u - nu) * dd + 3 * rise)) * rr + u * dd) * rr + y END, 3) + 0.0 AS y_interp,
  round(CASE WHEN xt < x THEN u WHEN xt >= nx THEN nu
  ELSE ((3 * u + 3 * nu - 6 * rise / dd) * rr + (-4 * u - 2 * nu + 6 * rise / dd)) * rr + u END, 1) + 0.0 AS slope FROM h"""


def _cubic(mode):
    def run(spark, d):
        targets, tab = _targets_and_table(spark, d)
        df = S.interp_cubic(targets, "xt", tab, "x", "y", ["user_id"], mode)
        return df.select("event_id", rnd("y_interp", 3).alias("y_interp"), rnd("y_interp_slope", 1).alias("slope"))
    return run


query("monotone_cubic", f"WITH {CUBIC[3]} {CUBIC_SELECT}")(_cubic(3))
query("monotone_cubic_2", f"WITH {CUBIC[2]} {CUBIC_SELECT}")(_cubic(2))
query("monotone_cubic_3", f"WITH {CUBIC[1]} {CUBIC_SELECT}")(_cubic(1))


@query("monotone_cubic_4", f"""WITH {CUBIC[3]}
SELECT user_id, round(x, 6) AS x, round(sum(CASE WHEN px IS NULL THEN 0 ELSE (x - px) * (y + py) / 2
  + (x - px) * (x - px) * (pu - u) / 12 END) OVER (PARTITION BY user_id ORDER BY x), 3) AS integral FROM u3""")
def cubic_integral(spark, d):
    _, tab = _targets_and_table(spark, d)
    df = S.cubic_integral(tab, ["user_id"], "x", "y")
    return df.select("user_id", rnd("x", 6).alias("x"), rnd("integral", 3).alias("integral"))


NEWTON_SQL = """,
 halving AS (WITH RECURSIVE b(i, n, lo, hi) AS (
   SELECT DISTINCT i, n, 1::BIGINT, n FROM t WHERE i < n
   UNION ALL
   SELECT i, n, CASE WHEN (lo + hi) // 2 <= i THEN (lo + hi) // 2 ELSE lo END,
     CASE WHEN (lo + hi) // 2 > i THEN (lo + hi) // 2 ELSE hi END FROM b WHERE hi - lo > 2)
   SELECT i, n, greatest(min(hi) - 2, 1) AS s FROM b GROUP BY i, n),
 st AS (SELECT m.*, h.s, CASE WHEN h.s = m.i THEN m.x ELSE m.px END AS x0, CASE WHEN h.s = m.i THEN m.y ELSE m.py END AS y0,
   CASE WHEN h.s = m.i THEN m.nx ELSE m.x END AS x1, CASE WHEN h.s = m.i THEN m.ny ELSE m.y END AS y1,
   CASE WHEN h.s = m.i THEN m.nx2 ELSE m.nx END AS x2, CASE WHEN h.s = m.i THEN m.ny2 ELSE m.ny END AS y2
   FROM m JOIN halving h ON m.i = h.i AND m.n = h.n)"""


@query("newton3", f"""WITH {TABLE_SQL}{NEWTON_SQL}
SELECT event_id, round(CASE WHEN n = 2 THEN (ny - y) / (nx - x) * (xt - x) + y
  ELSE y0 + (xt - x0) * (y1 - y0) / (x1 - x0) + (xt - x0) * (xt - x1)
  * ((y2 - y1) / (x2 - x1) - (y1 - y0) / (x1 - x0)) / (x2 - x0) END, 2) + 0.0 AS y_interp FROM st""")
def newton3(spark, d):
    targets, tab = _targets_and_table(spark, d)
    df = S.interp_newton3(targets, "xt", tab, "x", "y", ["user_id"])
    return df.select("event_id", rnd("y_interp", 2).alias("y_interp"))


SHIFT_SQL = (TABLE_SQL + NEWTON_SQL).replace(
    "q AS (SELECT user_id, event_id, x AS xt FROM s WHERE event_type = 'purchase')",
    "q AS (SELECT user_id, event_id, x + 0.01 * (user_id % 5) AS xt FROM s WHERE event_type <> 'purchase')")


@query("shift_resample", f"""WITH {SHIFT_SQL}
SELECT event_id, round(y0 + (xt - x0) * (y1 - y0) / (x1 - x0) + (xt - x0) * (xt - x1)
  * ((y2 - y1) / (x2 - x1) - (y1 - y0) / (x1 - x0)) / (x2 - x0), 2) + 0.0 AS y_shifted FROM st""")
def shift_resample(spark, d):
    tab = series(spark, d).filter("event_type <> 'purchase'").select("user_id", "event_id", "x", "y")
    shift = F.lit(0.01) * (F.col("user_id") % 5)
    df = S.shift_resample(tab, ["user_id"], "x", "y", shift)
    return df.select("event_id", rnd("y_shifted", 2).alias("y_shifted"))


@query("spline_resample", f"""WITH RECURSIVE {SPECTRA_SQL},
 r AS (SELECT spec_id, i, flux, 6 * (lead(flux) OVER w - 2 * flux + lag(flux) OVER w) / 100 AS rhs FROM sp
   WINDOW w AS (PARTITION BY spec_id ORDER BY i)),
 down AS (
   SELECT spec_id, 0 AS i, 0.0::DOUBLE AS c, 0.0::DOUBLE AS v FROM r WHERE i = 0
   UNION ALL
   SELECT r.spec_id, r.i, 1 / (4 - d.c), (r.rhs - d.v) / (4 - d.c) FROM down d JOIN r ON r.spec_id = d.spec_id AND r.i = d.i + 1 AND r.i < 63),
 up AS (
   SELECT spec_id, 63 AS i, 0.0::DOUBLE AS m FROM r WHERE i = 63
   UNION ALL
   SELECT d.spec_id, d.i, CASE WHEN d.i = 0 THEN 0.0 ELSE d.v - d.c * u.m END FROM up u JOIN down d ON d.spec_id = u.spec_id AND d.i = u.i - 1),
 k AS (SELECT sp.spec_id, sp.i, sp.wave, sp.flux, u.m, lead(sp.flux) OVER w AS nflux, lead(u.m) OVER w AS nm
   FROM sp JOIN up u ON u.spec_id = sp.spec_id AND u.i = sp.i WINDOW w AS (PARTITION BY sp.spec_id ORDER BY sp.i)),
 ax AS (SELECT 4003.0::DOUBLE + 7 * unnest(range(89)) AS xt)
SELECT spec_id, xt AS wave, round((m * pow(wave + 10 - xt, 3) + nm * pow(xt - wave, 3)) / 60
  + (flux / 10 - m * 10 / 6) * (wave + 10 - xt) + (nflux / 10 - nm * 10 / 6) * (xt - wave), 5) AS flux
FROM k JOIN ax ON xt >= wave AND xt < wave + 10 AND i < 63""")
def spline_resample(spark, d):
    axis = [4003.0 + 7 * j for j in range(89)]
    df = S.resample_spline(packed_spectra(spark, d), ["spec_id"], "wave", "flux", axis)
    df = df.select("spec_id", F.explode(F.arrays_zip("axis", "value")).alias("p"))
    return df.select("spec_id", F.col("p.axis").alias("wave"), rnd("p.value", 5).alias("flux"))


@query("spline_resample_2", f"""WITH RECURSIVE {SPECTRA_SQL},
 d3 AS (SELECT spec_id, i, flux - lag(flux) OVER w AS d1, flux - 3 * lag(flux) OVER w + 3 * lag(flux, 2) OVER w - lag(flux, 3) OVER w AS d3 FROM sp WINDOW w AS (PARTITION BY spec_id ORDER BY i)),
 e AS (SELECT spec_id, max(d3) FILTER (i = 3) / 100 AS e0, max(d3) FILTER (i = 63) / 100 AS e1 FROM d3 GROUP BY 1),
 r AS (SELECT spec_id, i, 6 * (lead(flux) OVER w - 2 * flux + lag(flux) OVER w) / 100 AS rhs FROM sp WINDOW w AS (PARTITION BY spec_id ORDER BY i)),
 down AS (
   SELECT spec_id, 1 AS i, 0.2::DOUBLE AS c, (rhs + e0) / 5 AS v FROM r JOIN e USING (spec_id) WHERE i = 1
   UNION ALL
   SELECT r.spec_id, r.i, 1 / (4 + (r.i = 62)::INTEGER - d.c), (r.rhs - d.v - CASE WHEN r.i = 62 THEN e1 ELSE 0 END) / (4 + (r.i = 62)::INTEGER - d.c)
   FROM down d JOIN r ON r.spec_id = d.spec_id AND r.i = d.i + 1 AND r.i < 63 JOIN e ON e.spec_id = r.spec_id),
 up AS (
   SELECT spec_id, 62 AS i, v AS m FROM down WHERE i = 62
   UNION ALL
   SELECT d.spec_id, d.i, d.v - d.c * u.m FROM up u JOIN down d ON d.spec_id = u.spec_id AND d.i = u.i - 1),
 um AS (SELECT * FROM up UNION ALL SELECT spec_id, 0, m - e0 FROM up JOIN e USING (spec_id) WHERE i = 1 UNION ALL SELECT spec_id, 63, m + e1 FROM up JOIN e USING (spec_id) WHERE i = 62),
 k AS (SELECT sp.spec_id, sp.i, sp.wave, sp.flux, um.m, lead(sp.flux) OVER w AS nflux, lead(um.m) OVER w AS nm
   FROM sp JOIN um ON um.spec_id = sp.spec_id AND um.i = sp.i WINDOW w AS (PARTITION BY sp.spec_id ORDER BY sp.i)),
 ax AS (SELECT xt, least(greatest(floor((xt - 4000) / 10), 0), 62)::INTEGER AS nth FROM (SELECT 3990.0::DOUBLE + 7 * unnest(range(95)) AS xt))
SELECT spec_id, xt AS wave, round((m * pow(wave + 10 - xt, 3) + nm * pow(xt - wave, 3)) / 60
  + (flux / 10 - m * 10 / 6) * (wave + 10 - xt) + (nflux / 10 - nm * 10 / 6) * (xt - wave), 5) + 0.0 AS flux
FROM k JOIN ax ON nth = i""")
def spline_resample_2(spark, d):
    """The ends follow the cubics through four points; the axis goes beyond both."""
    axis = [3990.0 + 7 * j for j in range(95)]
    df = S.resample_spline(packed_spectra(spark, d), ["spec_id"], "wave", "flux", axis, ends="third")
    df = df.select("spec_id", F.explode(F.arrays_zip("axis", "value")).alias("p"))
    return df.select("spec_id", F.col("p.axis").alias("wave"), (rnd("p.value", 5) + 0.0).alias("flux"))
