"""Abundances, isotopes, masses, partition sums and table look-ups."""

from __future__ import annotations

from pyspark.sql import functions as F

from specspark.functions.species import parse_species
from specspark.operators import composition as C
from specspark.operators.layout import small_table
from specspark.queries.common import rnd, table
from specspark.registry import query

# a short solar table for the queries; the operator takes any
SOLAR = [(1, 12.0), (2, 10.93), (6, 8.43), (8, 8.69), (12, 7.60), (20, 6.34), (22, 4.95), (26, 7.50), (38, 2.87), (56, 2.18)]
RFRACT = [(38, 0.11), (56, 0.15)]
SOLAR_SQL = "so(z, a) AS (VALUES " + ", ".join(f"({z}, {a}::DOUBLE)" for z, a in SOLAR) + ")"
MIX_SQL = """mi AS (SELECT p_partkey AS mix_id, p_size / -20.0::DOUBLE AS feh, (p_partkey % 5) * 0.1::DOUBLE AS alpha, CASE WHEN p_size > 40 THEN -0.2 ELSE 0.0 END AS helium,
  (p_partkey % 3) * 0.25::DOUBLE AS r, (p_partkey % 2) * 0.5::DOUBLE AS s, CASE WHEN p_type = 'PROMO' THEN 6.05::DOUBLE WHEN p_type = 'SMALL' THEN 11.9::DOUBLE END AS fixed,
  CASE WHEN p_type = 'PROMO' THEN 26 WHEN p_type = 'SMALL' THEN 1 END AS fixed_z FROM part)"""


@query("abundance_scale", f"""WITH {SOLAR_SQL}, {MIX_SQL},
 b AS (SELECT mi.*, z, so.a + CASE WHEN z >= 3 THEN feh ELSE 0 END + CASE WHEN z IN (8, 10, 12, 14, 16, 18, 20, 22) THEN alpha ELSE 0 END + CASE WHEN z = 2 THEN helium ELSE 0 END AS a,
   CASE z WHEN 38 THEN 0.11::DOUBLE WHEN 56 THEN 0.15::DOUBLE END AS f FROM mi, so),
 c AS (SELECT *, CASE WHEN z >= 31 AND (r <> 0 OR s <> 0) THEN log10(pow(10, r) * f * pow(10, a) + pow(10, s) * (1 - f) * pow(10, a)) ELSE a END AS a2 FROM b),
 d AS (SELECT mix_id, z, CASE WHEN z = fixed_z THEN fixed ELSE a2 END AS a3 FROM c)
SELECT mix_id, z, round(a3 + 12 - max(CASE WHEN z = 1 THEN a3 END) OVER (PARTITION BY mix_id), 6) AS a_log FROM d""")
def abundance_scale(spark, d):
    k, size = F.col("p_partkey"), F.col("p_size")
    part = table(spark, d, "part")
    mixes = part.select(
        k.alias("mix_id"), (size / F.lit(-20.0)).alias("feh"), ((k % 5) * F.lit(0.1)).alias("alpha"),
        F.when(size > 40, -0.2).otherwise(0.0).alias("helium"), ((k % 3) * F.lit(0.25)).alias("r"), ((k % 2) * F.lit(0.5)).alias("s"))
    fixed = part.filter("p_type IN ('PROMO', 'SMALL')").select(
        k.alias("mix_id"), F.when(F.col("p_type") == "PROMO", 26).otherwise(1).alias("z"),
        F.when(F.col("p_type") == "PROMO", 6.05).otherwise(11.9).alias("a_log"))
    a = C.abundances(mixes, small_table(spark, SOLAR, "z int, a_log double"), small_table(spark, RFRACT, "z int, f double"), fixed)
    return a.select("mix_id", "z", rnd("a_log", 6).alias("a_log"))


@query("abundance_number", """SELECT c_custkey, round(CASE WHEN c_nationkey = 1 THEN 1 WHEN c_acctbal < 0 THEN 0 ELSE pow(10, c_acctbal / 1000 - 12) END * 1e6, 4) AS number FROM customer""")
def abundance_number(spark, d):
    a = F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal") / 1000)
    return table(spark, d, "customer").select(
        "c_custkey", rnd(C.abundance_number(a, F.lit(12.0), F.col("c_nationkey")) * 1e6).alias("number"))


ISO_SQL = """iso AS (SELECT l_suppkey AS z, l_linenumber AS a, sum(l_quantity) / 10000 AS frac, avg(l_extendedprice) / 1000 AS mass FROM lineitem GROUP BY 1, 2),
 ch AS (SELECT s_suppkey AS z, 3 AS a, s_acctbal / 10000 AS f FROM supplier WHERE s_acctbal > 6000),
 ov AS (SELECT iso.z, iso.a, coalesce(f, frac) AS frac, mass FROM iso LEFT JOIN ch USING (z, a))"""


def _isotopes(spark, d):
    iso = table(spark, d, "lineitem").groupBy(F.col("l_suppkey").alias("z"), F.col("l_linenumber").alias("a")).agg(
        (F.sum("l_quantity") / 10000).alias("frac"), (F.avg("l_extendedprice") / 1000).alias("mass"))
    changes = table(spark, d, "supplier").filter("s_acctbal > 6000").select(
        F.col("s_suppkey").alias("z"), F.lit(3).alias("a"), (F.col("s_acctbal") / 10000).alias("frac"))
    return C.override_isotopes(iso, changes)


@query("isotope_override", f"WITH {ISO_SQL} SELECT z, a, round(frac, 8) + 0.0 AS frac, round(mass, 5) AS mass FROM ov")
def isotope_override(spark, d):
    return _isotopes(spark, d).select("z", "a", rnd("frac", 8).alias("frac"), rnd("mass", 5).alias("mass"))


@query("isotope_mean_mass", f"""WITH {ISO_SQL}, m AS (SELECT z, sum(frac * mass) AS mix FROM ov GROUP BY 1)
SELECT s_suppkey AS z, round(coalesce(nullif(mix, 0), s_acctbal), 4) AS mass FROM supplier LEFT JOIN m ON s_suppkey = z""")
def isotope_mean_mass(spark, d):
    default = table(spark, d, "supplier").select(F.col("s_suppkey").alias("z"), F.col("s_acctbal").alias("mass"))
    return C.mean_mass(_isotopes(spark, d), default).select("z", rnd("mass").alias("mass"))


@query("molecule_mass", """WITH ma AS (SELECT s_suppkey AS z, 0 AS a, 1 + s_suppkey * 2.0137::DOUBLE AS mass FROM supplier),
 co AS (SELECT DISTINCT p_size AS z1, p_partkey % 40 + 1 AS z2 FROM part)
SELECT concat(z1, lpad(z2::VARCHAR, 2, '0'), '.000') AS code, round(m1.mass + m2.mass, 4) AS mass, round(pow(m1.mass * m2.mass / (m1.mass + m2.mass), 1.5), 4) AS reduced15
FROM co LEFT JOIN ma m1 ON z1 = m1.z LEFT JOIN ma m2 ON z2 = m2.z""")
def molecule_mass(spark, d):
    masses = table(spark, d, "supplier").select(
        F.col("s_suppkey").cast("int").alias("z"), F.lit(0).alias("a"), (1 + F.col("s_suppkey") * 2.0137).alias("mass"))
    code = F.format_string("%d%02d.000", F.col("p_size"), F.col("p_partkey") % 40 + 1)
    s = table(spark, d, "part").select(code.alias("code")).withColumn("s", parse_species(F.col("code"))).select("code", "s.atoms", "s.isotopes")
    return C.species_mass(s, "code", "atoms", "isotopes", masses).select("code", rnd("mass").alias("mass"), rnd("reduced15").alias("reduced15"))


@query("mean_weight", """SELECT l_suppkey, round(sum(l_quantity * l_discount), 4) AS wgt, round(1.008 / sum(l_quantity * l_discount), 8) AS h_fraction FROM lineitem GROUP BY 1""")
def mean_weight(spark, d):
    return C.mean_weight(table(spark, d, "lineitem"), ["l_suppkey"], "l_quantity", "l_discount").select(
        "l_suppkey", rnd("wgt").alias("wgt"), rnd("h_fraction", 8).alias("h_fraction"))


TEMPS = [2500.0, 4000.0, 5777.0, 9000.0]


@query("partition_sum", f"""SELECT l_suppkey, t AS temp, round(sum(l_quantity * exp(-1.43877 * l_extendedprice / t)), 4) AS q
  FROM lineitem, (SELECT unnest({TEMPS}::DOUBLE[]) AS t) GROUP BY 1, 2""")
def partition_sum(spark, d):
    return C.partition_sum(table(spark, d, "lineitem"), ["l_suppkey"], "l_extendedprice", "l_quantity", TEMPS).select(
        "l_suppkey", "temp", rnd("q").alias("q"))


TABLE_SQL = """tb AS (SELECT l_quantity AS x, l_discount * 100 AS t, avg(l_extendedprice) AS v FROM lineitem GROUP BY 1, 2),
 xs AS (SELECT *, lead(x) OVER (ORDER BY x) AS x1, row_number() OVER (ORDER BY x) AS i, count(*) OVER () AS n FROM (SELECT DISTINCT x FROM tb)),
 ts AS (SELECT *, lead(t) OVER (ORDER BY t) AS t1, row_number() OVER (ORDER BY t) AS i, count(*) OVER () AS n FROM (SELECT DISTINCT t FROM tb)),
 tg AS (SELECT o_orderkey, o_totalprice / 9000.3::DOUBLE AS px, (o_custkey % 130 - 10) / 10.0::DOUBLE + 0.013 AS pt FROM orders),
 ce AS (SELECT tg.*, xs.x, xs.x1, ts.t, ts.t1, (px - xs.x) / (xs.x1 - xs.x) AS qx, (pt - ts.t) / (ts.t1 - ts.t) AS qt FROM tg
   JOIN xs ON xs.x1 IS NOT NULL AND (px >= xs.x OR xs.i = 1) AND (px < xs.x1 OR xs.i = xs.n - 1)
   JOIN ts ON ts.t1 IS NOT NULL AND (pt >= ts.t OR ts.i = 1) AND (pt < ts.t1 OR ts.i = ts.n - 1)),
 va AS (SELECT ce.*, qx * c.v + (1 - qx) * a.v AS low, qx * dd.v + (1 - qx) * b.v AS high FROM ce
   LEFT JOIN tb a ON a.x = ce.x AND a.t = ce.t LEFT JOIN tb b ON b.x = ce.x AND b.t = ce.t1
   LEFT JOIN tb c ON c.x = ce.x1 AND c.t = ce.t LEFT JOIN tb dd ON dd.x = ce.x1 AND dd.t = ce.t1)"""


def _lookup(spark, d, mode):
    tb = table(spark, d, "lineitem").groupBy(
        F.col("l_quantity").alias("x"), (F.col("l_discount") * 100).alias("t")).agg(F.avg("l_extendedprice").alias("v"))
    tg = table(spark, d, "orders").select(
        "o_orderkey", (F.col("o_totalprice") / F.lit(9000.3)).alias("px"), ((F.col("o_custkey") % 130 - 10) / F.lit(10.0) + 0.013).alias("pt"))
    return C.interp2d(tg, "px", "pt", tb, mode)


@query("interp2d", f"""WITH {TABLE_SQL} SELECT o_orderkey, round(CASE WHEN px > 50 THEN 0 WHEN low <= 0 OR high <= 0 THEN NULL WHEN qt * ln(high) + (1 - qt) * ln(low) > -70
  THEN exp(qt * ln(high) + (1 - qt) * ln(low)) ELSE 1e-30 END, 2) AS value FROM va""")
def interp2d(spark, d):
    return _lookup(spark, d, "log").select("o_orderkey", rnd("value", 2).alias("value"))


@query("interp2d_2", f"""WITH {TABLE_SQL} SELECT o_orderkey, round(CASE WHEN px BETWEEN 1 AND 50 AND pt BETWEEN (SELECT min(t) FROM tb) AND (SELECT max(t) FROM tb)
  THEN qt * high + (1 - qt) * low ELSE 0 END, 3) AS value FROM va""")
def interp2d_linear(spark, d):
    return _lookup(spark, d, "linear").select("o_orderkey", rnd("value", 3).alias("value"))


@query("partition_functions", f"""WITH io AS (SELECT DISTINCT l_suppkey AS z, l_linenumber AS stage FROM lineitem),
 lv AS (SELECT l_suppkey AS z, l_linenumber AS stage, l_extendedprice AS e, l_quantity AS g FROM lineitem WHERE l_linenumber IN (2, 3)),
 t AS (SELECT unnest({TEMPS}::DOUBLE[]) AS temp),
 sm AS (SELECT z, stage, temp, sum(g * exp(-1.43877 * e / temp)) AS q FROM lv, t GROUP BY 1, 2, 3)
SELECT io.z, io.stage, t.temp, round(coalesce(sm.q, exp(0.6::DOUBLE + 0.02 * io.stage + 0.12 * ln(t.temp) + 0.001 * pow(ln(t.temp), 2))), 4) AS q
FROM io CROSS JOIN t LEFT JOIN sm ON sm.z = io.z AND sm.stage = io.stage AND sm.temp = t.temp""")
def partition_functions(spark, d):
    li = table(spark, d, "lineitem").select(F.col("l_suppkey").alias("z"), F.col("l_linenumber").alias("stage"),
                                            F.col("l_extendedprice").alias("e"), F.col("l_quantity").alias("g"))
    coefs = li.select("z", "stage").distinct().withColumn("coef", F.array(
        F.lit(0.6) + F.lit(0.02) * F.col("stage"), F.lit(0.12), F.lit(0.001)))
    q = C.partition_functions(coefs, TEMPS, li.filter("stage IN (2, 3)"))
    return q.select("z", "stage", "temp", rnd("q").alias("q"))
