"""Range, tolerance and nearest joins on the line list and the catalogues."""

from __future__ import annotations

from pyspark.sql import functions as F

from specspark.operators import ranges as R
from specspark.operators.layout import small_table
from specspark.queries.common import LINE_KEY, LINES_SQL, SPECTRA_SQL, lines, rnd, spectra, table
from specspark.registry import query

# overlapping windows with a shared end, a gap, and one point
SEGMENTS = [(1, 2000.0, 9000.0), (2, 8000.0, 15000.0), (3, 15000.0, 22000.0), (4, 40000.0, 41000.5),
            (5, 40500.0, 60000.0), (6, 70000.0, 70000.0), (7, 65000.0, 90000.0)]
SEGMENTS_SQL = "seg(seg_id, wmin, wmax) AS (VALUES " + ", ".join(
    f"({i}, {a}::DOUBLE, {b}::DOUBLE)" for i, a, b in SEGMENTS) + ")"


def segments(spark):
    return small_table(spark, SEGMENTS, "seg_id int, wmin double, wmax double")


@query("assign_segment", f"""WITH {LINES_SQL}, {SEGMENTS_SQL}
SELECT l_orderkey, l_linenumber, l_partkey, species_id, wave,
  (SELECT min(seg_id) FROM seg WHERE wave BETWEEN wmin AND wmax) AS seg_id FROM ln""")
def assign_segment(spark, d):
    return R.assign_segment(lines(spark, d).select(*LINE_KEY), "wave", segments(spark)).select(*LINE_KEY, "seg_id")


ORDER_SEGMENTS_SQL = """seg AS (SELECT c_custkey AS seg_id, 9 * (c_acctbal + 1100) AS wmin,
  9 * (c_acctbal + 1100) + 40 AS wmax FROM customer)"""


@query("assign_segment_2", f"""WITH {LINES_SQL}, {ORDER_SEGMENTS_SQL},
m AS (SELECT l_orderkey, l_linenumber, l_partkey, species_id, wave, min(seg_id) AS seg_id
  FROM ln JOIN seg ON wave BETWEEN wmin AND wmax GROUP BY ALL)
SELECT ln.l_orderkey, ln.l_linenumber, ln.l_partkey, ln.species_id, ln.wave, m.seg_id
FROM ln LEFT JOIN m USING (l_orderkey, l_linenumber, l_partkey, species_id, wave)""")
def assign_segment_many(spark, d):
    seg = table(spark, d, "customer").select(
        F.col("c_custkey").alias("seg_id"), (9 * (F.col("c_acctbal") + 1100)).alias("wmin"),
        (9 * (F.col("c_acctbal") + 1100) + 40).alias("wmax"))
    return R.assign_segment(lines(spark, d).select(*LINE_KEY), "wave", seg).select(*LINE_KEY, "seg_id")


SPECIAL_SQL = """w AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey AS species_id, l_extendedprice / 1000 AS wave,
  l_discount * 50 AS chi_low, l_tax, l_quantity, l_extendedprice FROM lineitem),
 sp AS (SELECT species_id, wave, chi_low * 8067 AS cm, l_quantity AS sigma, l_orderkey, l_linenumber, l_partkey FROM w WHERE l_tax = 0)"""


@query("special_lines", f"""WITH {SPECIAL_SQL},
p AS (SELECT w.l_orderkey, w.l_linenumber, w.l_partkey, w.species_id, w.l_extendedprice, sp.sigma,
   row_number() OVER (PARTITION BY w.l_orderkey, w.l_linenumber, w.l_partkey, w.species_id, w.l_extendedprice
     ORDER BY sp.l_orderkey, sp.l_linenumber, sp.l_partkey, sp.wave) AS k
  FROM w LEFT JOIN sp ON w.species_id = sp.species_id AND abs(w.wave - sp.wave) <= 0.05
   AND abs(w.chi_low - sp.cm / 8067) < 0.02)
SELECT l_orderkey, l_linenumber, l_partkey, species_id, l_extendedprice, sigma FROM p WHERE k = 1""")
def special_lines(spark, d):
    w = table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", F.col("l_suppkey").alias("species_id"), "l_extendedprice",
        (F.col("l_extendedprice") / 1000).alias("wave"), (F.col("l_discount") * 50).alias("chi_low"),
        "l_tax", "l_quantity")
    special = w.filter("l_tax = 0").select(
        "species_id", "wave", (F.col("chi_low") * 8067 / 8067).alias("chi_low"), F.col("l_quantity").alias("sigma"),
        F.struct("l_orderkey", "l_linenumber", "l_partkey", "wave").alias("seq"))
    key = ["l_orderkey", "l_linenumber", "l_partkey", "species_id", "l_extendedprice"]
    return R.match_special(w.select(*key, "wave", "chi_low"), key, special, ["species_id"],
                           payload=["sigma"]).select(*key, "sigma")


CATALOG_SQL = """mo AS (SELECT s_suppkey, s_nationkey AS model_id, s_acctbal / 10 AS teff, (s_suppkey % 9) * 0.004 AS logg,
  (s_suppkey % 4) * 0.006 AS feh FROM supplier),
 ca AS (SELECT c_custkey, c_nationkey AS model_id, c_acctbal / 10 AS teff, (c_custkey % 9) * 0.004 AS logg,
  (c_custkey % 4) * 0.006 AS feh FROM customer),
 cm AS (SELECT s_suppkey, c_custkey, mo.teff AS teff, ca.teff AS cat_teff FROM mo JOIN ca ON mo.model_id = ca.model_id
  AND abs(mo.teff - ca.teff) <= 20 AND abs(mo.logg - ca.logg) <= 0.01 AND abs(mo.feh - ca.feh) <= 0.01)"""


def _catalog(spark, d):
    def side(t, p):
        key = F.col(f"{p}_suppkey" if p == "s" else f"{p}_custkey")
        return table(spark, d, t).select(
            key.alias("row_id"), F.col(f"{p}_nationkey").alias("model_id"), (F.col(f"{p}_acctbal") / 10).alias("teff"),
            ((key % 9) * 0.004).alias("logg"), ((key % 4) * 0.006).alias("feh"))
    return R.match_catalog(side("supplier", "s"), side("customer", "c"),
                           near={"teff": 20.0, "logg": 0.01, "feh": 0.01})


@query("catalog_match", f"""WITH {CATALOG_SQL} SELECT s_suppkey, c_custkey, round(teff, 4) AS teff,
  round(cat_teff, 4) AS cat_teff FROM cm""")
def catalog_match(spark, d):
    m = _catalog(spark, d)
    return m.select(F.col("row_id").alias("s_suppkey"), F.col("cat_row_id").alias("c_custkey"),
                    rnd("teff").alias("teff"), rnd("cat_teff").alias("cat_teff"))


ABUNDANCE_SQL = """ma AS (SELECT p_partkey, p_size * 0.02 - 0.0013 AS ref, l_extendedprice / 100000 AS abundance, l_orderkey, l_linenumber,
   l_suppkey FROM lineitem JOIN part ON l_partkey = p_partkey),
 li AS (SELECT p_partkey, min(abundance) AS lo, max(abundance) AS hi FROM ma GROUP BY 1),
 cl AS (SELECT ma.*, greatest(least(ref, hi), lo) AS r FROM ma JOIN li USING (p_partkey)),
 bi AS (SELECT *, CASE WHEN r <= abundance + 0.049999 AND r >= abundance - 0.049999 THEN 1
   WHEN r <= abundance + 0.049999 * 2 AND r >= abundance - 0.049999 * 2 THEN 2
   WHEN r <= abundance + 0.049999 * 3 AND r >= abundance - 0.049999 * 3 THEN 3
   WHEN r <= abundance + 0.049999 * 4 AND r >= abundance - 0.049999 * 4 THEN 4
   WHEN r <= abundance + 0.049999 * 5 AND r >= abundance - 0.049999 * 5 THEN 5 END AS win FROM cl),
 rk AS (SELECT *, row_number() OVER (PARTITION BY p_partkey ORDER BY win NULLS LAST, l_orderkey, l_linenumber, l_suppkey, abundance) AS k FROM bi)"""


@query("nearest_abundance", f"""WITH {ABUNDANCE_SQL}
SELECT p_partkey, CASE WHEN win IS NOT NULL THEN l_orderkey END AS l_orderkey,
  CASE WHEN win IS NOT NULL THEN l_linenumber END AS l_linenumber, win AS "window" FROM rk WHERE k = 1""")
def nearest_abundance(spark, d):
    ref = table(spark, d, "part").select("p_partkey", (F.col("p_size") * F.lit(0.02) - F.lit(0.0013)).alias("ref"))
    li = table(spark, d, "lineitem").select(
        F.col("l_partkey").alias("p_partkey"), (F.col("l_extendedprice") / 100000).alias("abundance"),
        "l_orderkey", "l_linenumber", "l_suppkey")
    out = R.nearest_in_bins(li.join(ref, "p_partkey"), "p_partkey", "abundance", "ref",
                            ["l_orderkey", "l_linenumber", "l_suppkey"])
    return out.select("p_partkey", "l_orderkey", "l_linenumber", "window")


@query("bracket", """WITH ax AS (SELECT DISTINCT l_returnflag AS turb, l_discount * 50 AS v FROM lineitem),
 iv AS (SELECT *, lead(v) OVER w AS nv, row_number() OVER w AS i, count(*) OVER (PARTITION BY turb) AS n FROM ax
   WINDOW w AS (PARTITION BY turb ORDER BY v)),
 t AS (SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN 'A' WHEN 1 THEN 'N' ELSE 'R' END AS turb,
   (p_partkey % 70 - 5) / 10.0::DOUBLE AS x FROM part)
SELECT p_partkey, x, round(v, 6) AS v_inf, round(nv, 6) AS v_sup FROM t JOIN iv ON t.turb = iv.turb AND nv IS NOT NULL
  AND (x >= v OR i = 1) AND (x < nv OR i = n - 1)""")
def bracket(spark, d):
    axis = table(spark, d, "lineitem").select(
        F.col("l_returnflag").alias("turb"), (F.col("l_discount") * 50).alias("v"))
    k = F.col("p_partkey")
    turb = F.when(k % 3 == 0, "A").when(k % 3 == 1, "N").otherwise("R")
    targets = table(spark, d, "part").select("p_partkey", turb.alias("turb"), ((k % 70 - 5) / F.lit(10.0)).alias("x"))
    b = R.bracket(targets, "x", axis, "v", ["turb"])
    return b.select("p_partkey", "x", rnd("v_inf", 6).alias("v_inf"), rnd("v_sup", 6).alias("v_sup"))


@query("spectrum_diff", f"""WITH {SPECTRA_SQL}
SELECT a.spec_id, a.wave, round(a.flux - b.flux, 6) + 0.0 AS diff, round(a.flux / b.flux, 6) AS ratio
FROM sp a JOIN sp b ON b.spec_id = 2 * (a.spec_id // 2) AND a.spec_id <> b.spec_id AND a.i = b.i""")
def spectrum_diff(spark, d):
    sp = spectra(spark, d).select("spec_id", "wave", "flux").withColumn("pair", F.floor(F.col("spec_id") / 2))
    odd, even = sp.filter("spec_id % 2 = 1"), sp.filter("spec_id % 2 = 0")
    out = R.diff_series(odd, even, ["pair"], "wave", "flux")
    return out.select((F.col("pair") * 2 + 1).alias("spec_id"), "wave", rnd("diff", 6).alias("diff"),
                      rnd("ratio", 6).alias("ratio"))


@query("depth_grid_check", """WITH a AS (SELECT l_orderkey, l_linenumber, max(l_extendedprice) AS a FROM lineitem GROUP BY 1, 2),
 b AS (SELECT o_orderkey AS l_orderkey, 1 AS l_linenumber, o_totalprice AS b FROM orders)
SELECT l_orderkey, l_linenumber, a, b, CASE WHEN a IS NULL THEN 'missing in a' WHEN b IS NULL THEN 'missing in b' ELSE 'differs' END AS problem
FROM a FULL JOIN b USING (l_orderkey, l_linenumber) WHERE a IS NULL OR b IS NULL OR b = 0 OR abs(a / b - 1) > 0.9""")
def depth_grid_check(spark, d):
    a = table(spark, d, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.max("l_extendedprice").alias("tau"))
    b = table(spark, d, "orders").select(F.col("o_orderkey").alias("l_orderkey"), F.lit(1).alias("l_linenumber"),
                                         F.col("o_totalprice").alias("tau"))
    return R.check_grids(a, b, ["l_orderkey", "l_linenumber"], "tau", 0.9)
