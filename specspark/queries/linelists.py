"""Line-list operators: lineitem is the list, one species per supplier."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from specspark.functions import physics as P
from specspark.functions import species as SP
from specspark.operators import lines as L
from specspark.operators.layout import small_table
from specspark.queries.common import LINE_KEY, LINES_SQL, lines, rnd, row_text, table
from specspark.registry import query
from specspark.sources import linelists as LL
from specspark.sources import vald as V

KEY_SQL = "l_orderkey, l_linenumber, l_partkey, species_id, wave"

# a fuller list: elements 1..30 by supplier, two stages, energies in eV
ATOMS_SQL = """la AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey AS species_id, l_extendedprice AS wave,
  (l_suppkey % 30 + 1)::INTEGER AS iel, (l_linenumber % 3 + 1)::INTEGER AS ion, l_discount * 160 AS chi_low, l_discount * 160 + l_tax * 100 AS chi_up,
  l_tax * -20 AS log_gf, l_quantity AS strength FROM lineitem)"""
IONPOT_SQL = """ip AS (SELECT z::INTEGER AS z, i::INTEGER AS ion, 5.01234::DOUBLE + z * 0.3 + (i - 1) * 7 AS chi_ion
  FROM (SELECT unnest(range(1, 31)) AS z), (SELECT unnest(range(1, 4)) AS i))"""


def atoms(spark, d):
    chi = F.col("l_discount") * 160
    return table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", F.col("l_suppkey").alias("species_id"),
        F.col("l_extendedprice").alias("wave"), (F.col("l_suppkey") % 30 + 1).cast("int").alias("iel"),
        (F.col("l_linenumber") % 3 + 1).cast("int").alias("ion"), chi.alias("chi_low"),
        (chi + F.col("l_tax") * 100).alias("chi_up"), (F.col("l_tax") * -20).alias("log_gf"),
        F.col("l_quantity").alias("strength"))


def ionpot(spark):
    rows = [(z, i, 5.01234 + z * 0.3 + (i - 1) * 7) for z in range(1, 31) for i in (1, 2, 3)]
    return small_table(spark, rows, "z int, ion int, chi_ion double")


@query("trim_wave", "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey AS species_id, l_extendedprice AS wave FROM lineitem WHERE l_extendedprice BETWEEN 4800 AND 5200")
def trim_wave(spark, d):
    return L.trim_wave(lines(spark, d), 5200.0, 4800.0).select(*LINE_KEY)


@query("window_margin", "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey AS species_id, l_extendedprice AS wave FROM lineitem WHERE l_extendedprice BETWEEN 4795 AND 5605")
def window_margin(spark, d):
    return L.window_margin(lines(spark, d), 4800.0, 5600.0, 0.0).select(*LINE_KEY)


REJECT_SQL = """re AS (SELECT la.*, chi_ion, CASE WHEN iel < 3 THEN 'H or He' WHEN la.ion NOT IN (1, 2) THEN 'ion' WHEN chi_low >= 15 THEN 'low level'
  WHEN iel <= 92 AND chi_up >= chi_ion THEN 'bound-free' END AS reject_reason FROM la LEFT JOIN ip ON la.iel = ip.z AND la.ion = ip.ion)"""


@query("vald_reject", f"WITH {ATOMS_SQL}, {IONPOT_SQL}, {REJECT_SQL} SELECT {KEY_SQL}, reject_reason FROM re")
def vald_reject(spark, d):
    return L.vald_reject(atoms(spark, d), ionpot(spark)).select(*LINE_KEY, "reject_reason")


@query("count_lines", f"""WITH {ATOMS_SQL}, {IONPOT_SQL}, {REJECT_SQL} SELECT iel, ion, count(*) AS n_read,
  count(*) FILTER (reject_reason IS NULL) AS n_written, count(reject_reason) AS n_skipped FROM re GROUP BY 1, 2""")
def count_lines(spark, d):
    return L.count_lines(L.vald_reject(atoms(spark, d), ionpot(spark)), ["iel", "ion"])


@query("reject_rows", """SELECT 'kept' AS part, count(*) AS n FROM documents WHERE n_chars >= 200 UNION ALL
  SELECT 'short', count(*) FROM documents WHERE n_chars < 200""")
def reject_rows(spark, d):
    ok, bad = L.split_rejects(table(spark, d, "documents").select("doc_id", "n_chars"),
                              F.when(F.col("n_chars") < 200, "short"))
    parts = ok.select(F.lit("kept").alias("part")).unionByName(bad.select(F.col("reject_reason").alias("part")))
    return parts.groupBy("part").agg(F.count(F.lit(1)).alias("n"))


@query("sort_by_species", f"WITH {LINES_SQL} SELECT {KEY_SQL}, l_linenumber AS ion FROM ln")
def sort_by_species(spark, d):
    df = lines(spark, d).withColumn("ion", F.col("l_linenumber"))
    return L.sort_by_species(df, "species_id", "ion", LINE_KEY).select(*LINE_KEY, "ion")


@query("gf_guard", """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey AS species_id, l_extendedprice AS wave,
  lpad(CASE WHEN l_tax * -200 > -10 THEN printf('%.3f', l_tax * -200 + 0.0001) ELSE printf('%.2f', l_tax * -200 + 0.0001) END, 6, ' ') AS gf FROM lineitem""")
def gf_guard(spark, d):
    df = table(spark, d, "lineitem")
    return df.select("l_orderkey", "l_linenumber", "l_partkey", F.col("l_suppkey").alias("species_id"),
                     F.col("l_extendedprice").alias("wave"), L.gf_guard(F.col("l_tax") * -200 + 0.0001).alias("gf"))


@query("abundance_guard", """WITH a AS (SELECT c_custkey, c_nationkey, c_acctbal / 1000 AS a FROM customer),
 b AS (SELECT s_nationkey, max(s_acctbal / 1000) AS a FROM supplier GROUP BY 1)
SELECT c_custkey, round(a.a, 5) AS a_lines, round(b.a, 5) AS a_departures FROM a JOIN b ON c_nationkey = s_nationkey WHERE abs(a.a - b.a) > 2.5""")
def abundance_guard(spark, d):
    a = table(spark, d, "customer").select("c_custkey", F.col("c_nationkey").alias("z"), (F.col("c_acctbal") / 1000).alias("a_log"))
    b = table(spark, d, "supplier").groupBy(F.col("s_nationkey").alias("z")).agg((F.max(F.col("s_acctbal") / 1000)).alias("a_log"))
    b = a.select("c_custkey", "z").join(b, "z")
    out = L.abundance_guard(a, b, ["c_custkey", "z"], 2.5)
    return out.select("c_custkey", rnd("a_lines", 5).alias("a_lines"), rnd("a_departures", 5).alias("a_departures"))


@query("line_derived", """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey AS species_id, l_extendedprice AS wave, round(pow(10, l_tax * -20), 8) AS gf,
  round(l_discount * 50 + 3.40 * 3647.0 / l_extendedprice, 6) AS chi_up,
  round(CASE WHEN l_linenumber = 1 THEN 6.669e15 * pow(10, l_tax * -20) / (l_quantity * l_extendedprice * l_extendedprice) ELSE (l_partkey + 1) * 1000.0 END / 1e6, 3) AS gam_rad FROM lineitem""")
def line_derived(spark, d):
    rad = F.when(F.col("l_linenumber") == 1, 0.0).otherwise((F.col("l_partkey") + 1) * 1000.0)
    df = L.line_derived(lines(spark, d).withColumns({"g_up": F.col("strength"), "gam_rad": rad}))
    return df.select(*LINE_KEY, rnd("gf", 8).alias("gf"), rnd("chi_up", 6).alias("chi_up"),
                     rnd(F.col("gam_rad") / 1e6, 3).alias("gam_rad"))


@query("vald_derived", """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey AS species_id, l_extendedprice AS wave, 2.0::DOUBLE * l_quantity / 2 + 1.0 AS g_up,
  round(CASE WHEN l_discount * 100 > 3 THEN pow(10, l_discount * 100) ELSE 1e5 END / 1e4, 2) AS gam_rad FROM lineitem""")
def vald_derived(spark, d):
    df = table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", F.col("l_suppkey").alias("species_id"), F.col("l_extendedprice").alias("wave"),
        (F.col("l_quantity") / 2).alias("j_up"), (F.col("l_discount") * 100).alias("gam_rad"))
    return L.vald_derived(df).select(*LINE_KEY, "g_up", rnd(F.col("gam_rad") / 1e4, 2).alias("gam_rad"))


@query("default_fdamp", f"""WITH {ATOMS_SQL} SELECT {KEY_SQL}, CASE WHEN strength > 40 THEN strength * -0.1 WHEN l_linenumber = 7 THEN 2.5
  WHEN ion = 1 THEN CASE iel WHEN 11 THEN 2.0 WHEN 14 THEN 1.3 WHEN 20 THEN 1.8 WHEN 26 THEN 1.4 ELSE 2.5 END
  WHEN ion = 2 THEN CASE iel WHEN 20 THEN 1.4 ELSE 2.5 END ELSE 2.5 END::DOUBLE AS fdamp FROM la""")
def default_fdamp(spark, d):
    gamma6 = F.when(F.col("strength") > 40, F.col("strength") * -0.1).otherwise(0.0)
    return atoms(spark, d).select(*LINE_KEY, SP.default_fdamp(
        F.col("ion"), F.col("iel"), F.col("l_linenumber") == 7, gamma6).alias("fdamp"))


RECIPE_SQL = f"""{ATOMS_SQL}, {IONPOT_SQL},
 fd AS (SELECT la.*, ip.chi_ion, CASE WHEN strength > 45 THEN strength * 5.25 + 0.125 WHEN strength > 25 THEN strength * -0.2 ELSE 2.5 END AS fdamp,
   CASE WHEN l_linenumber = 7 THEN 608 ELSE iel END AS el, CASE WHEN l_partkey % 5 = 0 THEN 'B' END AS table_recipe,
   CASE WHEN l_partkey % 5 = 0 THEN strength * 10 END AS ts, CASE WHEN l_partkey % 5 = 0 THEN 0.25::DOUBLE END AS ta
   FROM la JOIN ip ON la.iel = ip.z AND la.ion = ip.ion),
 c6 AS (SELECT *, ion * ion * (1 / pow(chi_ion - chi_up, 2) - 1 / pow(chi_ion - chi_low, 2)) AS xx,
   CASE WHEN el > 92 THEN 'R' WHEN fdamp >= 20 THEN 'S' WHEN table_recipe IS NOT NULL THEN table_recipe WHEN fdamp < 0 THEN 'W' ELSE 'U' END AS recipe FROM fd)"""


def _recipes(spark, d):
    df = atoms(spark, d).join(F.broadcast(ionpot(spark).withColumnRenamed("z", "iel")), ["iel", "ion"])
    s, tab = F.col("strength"), F.col("l_partkey") % 5 == 0
    df = df.withColumns({
        "fdamp": F.when(s > 45, s * 5.25 + 0.125).when(s > 25, s * -0.2).otherwise(2.5),
        "iel": F.when(F.col("l_linenumber") == 7, 608).otherwise(F.col("iel")),
        "table_recipe": F.when(tab, "B"), "table_sigma": F.when(tab, s * 10), "table_alpha": F.when(tab, 0.25)})
    return L.damping_recipe(df)


@query("damping_recipe", f"""WITH {RECIPE_SQL} SELECT {KEY_SQL}, recipe,
  CASE WHEN el <= 92 AND fdamp >= 20 THEN floor(fdamp) WHEN el <= 92 THEN ts END AS sigma,
  CASE WHEN el <= 92 AND fdamp >= 20 THEN round(fdamp - floor(fdamp), 6) WHEN el <= 92 THEN ta END AS alpha,
  CASE WHEN recipe = 'U' AND xx > 0 AND isfinite(xx) THEN round(log10(xx) - 29.7278, 6) END AS log_c6,
  CASE WHEN recipe = 'U' AND NOT coalesce(xx > 0 AND isfinite(xx), false) THEN 'c6' END AS reject_reason FROM c6""")
def damping_recipe(spark, d):
    r = _recipes(spark, d)
    return r.select(*LINE_KEY, "recipe", "sigma", rnd("alpha", 6).alias("alpha"), rnd("log_c6", 6).alias("log_c6"), "reject_reason")


@query("reject_c6", f"""WITH {RECIPE_SQL} SELECT recipe, count(*) AS n FROM c6
  WHERE NOT (recipe = 'U' AND NOT coalesce(xx > 0 AND isfinite(xx), false)) GROUP BY 1""")
def reject_c6(spark, d):
    return L.reject_c6(_recipes(spark, d)).groupBy("recipe").agg(F.count(F.lit(1)).alias("n"))


BROAD_SQL = """tb AS (SELECT r AS recipe, i1, i2, 100.0::DOUBLE + i1 * i2 + k * 7 AS sigma, 0.2::DOUBLE + i1 * 0.001 + i2 * 0.002 AS alpha
   FROM (SELECT unnest(['A', 'B', 'C']) AS r, unnest([1, 2, 3]) AS k), (SELECT unnest(range(10, 51)) AS i1), (SELECT unnest(range(10, 51)) AS i2)),
 bl AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey AS species_id, l_extendedprice AS wave,
   CASE l_linenumber WHEN 1 THEN 's' WHEN 2 THEN 'p' WHEN 3 THEN 'd' WHEN 4 THEN 'p' WHEN 5 THEN 'd' WHEN 6 THEN 'f' ELSE 'x' END AS lo,
   CASE l_linenumber WHEN 1 THEN 'p' WHEN 2 THEN 's' WHEN 3 THEN 'p' WHEN 4 THEN 'd' WHEN 5 THEN 'f' WHEN 6 THEN 'd' ELSE 'x' END AS up,
   8.0 - 5.03 * l_discount * 10 AS chi_low, 8.0 - 3.07 * l_tax * 12.5 - 0.6 AS chi_up FROM lineitem),
 bn AS (SELECT *, CASE WHEN chi_low < 8 THEN 1 / sqrt((8.0 - chi_low) / 13.595) END AS nlo, CASE WHEN chi_up < 8 THEN 1 / sqrt((8.0 - chi_up) / 13.595) END AS nup FROM bl),
 br AS (SELECT *, CASE WHEN lo = 's' AND up = 'p' AND nlo BETWEEN 1.0 AND 3.0 AND nup BETWEEN 1.3 AND 3.0 OR lo = 'p' AND up = 's' AND nup BETWEEN 1.0 AND 3.0 AND nlo BETWEEN 1.3 AND 3.0 THEN 'A'
   WHEN lo = 'p' AND up = 'd' AND nlo BETWEEN 1.3 AND 3.0 AND nup BETWEEN 2.3 AND 4.0 OR lo = 'd' AND up = 'p' AND nup BETWEEN 1.3 AND 3.0 AND nlo BETWEEN 2.3 AND 4.0 THEN 'B'
   WHEN lo = 'd' AND up = 'f' AND nlo BETWEEN 2.3 AND 4.0 AND nup BETWEEN 3.3 AND 5.0 OR lo = 'f' AND up = 'd' AND nup BETWEEN 2.3 AND 4.0 AND nlo BETWEEN 3.3 AND 5.0 THEN 'C' END AS recipe,
   CASE WHEN lo || up IN ('sp', 'pd', 'df') THEN 10 * nlo ELSE 10 * nup END AS n1, CASE WHEN lo || up IN ('sp', 'pd', 'df') THEN 10 * nup ELSE 10 * nlo END AS n2 FROM bn),
 bi AS (SELECT br.*, n1 - trunc(n1) AS f1, n2 - trunc(n2) AS f2, t00.sigma AS s00, t01.sigma AS s01, t10.sigma AS s10, t11.sigma AS s11,
   t00.alpha AS a00, t01.alpha AS a01, t10.alpha AS a10, t11.alpha AS a11 FROM br
   LEFT JOIN tb t00 ON t00.recipe = br.recipe AND t00.i1 = trunc(n1) AND t00.i2 = trunc(n2)
   LEFT JOIN tb t01 ON t01.recipe = br.recipe AND t01.i1 = trunc(n1) AND t01.i2 = trunc(n2) + 1
   LEFT JOIN tb t10 ON t10.recipe = br.recipe AND t10.i1 = trunc(n1) + 1 AND t10.i2 = trunc(n2)
   LEFT JOIN tb t11 ON t11.recipe = br.recipe AND t11.i1 = trunc(n1) + 1 AND t11.i2 = trunc(n2) + 1),
 bv AS (SELECT *, (s00 * (1 - f2) + s01 * f2) * (1 - f1) + (s10 * (1 - f2) + s11 * f2) * f1 AS sigma,
   (a00 * (1 - f2) + a01 * f2) * (1 - f1) + (a10 * (1 - f2) + a11 * f2) * f1 AS alpha FROM bi)"""


def _broadened(spark, d):
    rows = [(r, i1, i2, 100.0 + i1 * i2 + k * 7, 0.2 + i1 * 0.001 + i2 * 0.002)
            for r, k in (("A", 1), ("B", 2), ("C", 3)) for i1 in range(10, 51) for i2 in range(10, 51)]
    tables = small_table(spark, rows, "recipe string, i1 int, i2 int, sigma double, alpha double")
    n = F.col("l_linenumber")
    pick = lambda s: F.when(n <= 6, F.substring(F.lit(s), n, F.lit(1))).otherwise("x")
    df = table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", F.col("l_suppkey").alias("species_id"), F.col("l_extendedprice").alias("wave"),
        pick("spdpdf").alias("lev_lo"), pick("pspdfd").alias("lev_up"),
        (F.lit(8.0) - F.lit(5.03) * F.col("l_discount") * 10).alias("chi_low"),
        (F.lit(8.0) - F.lit(3.07) * F.col("l_tax") * 12.5 - 0.6).alias("chi_up"), F.lit(8.0).alias("chi_ion"), F.lit(1).alias("ion"))
    return L.broadening_table(df, tables)


@query("table_bilinear", f"""WITH {BROAD_SQL} SELECT {KEY_SQL}, CASE WHEN sigma IS NOT NULL THEN recipe END AS recipe,
  round(sigma, 4) AS sigma, round(alpha, 6) AS alpha FROM bv""")
def table_bilinear(spark, d):
    b = _broadened(spark, d)
    return b.select(*LINE_KEY, F.col("table_recipe").alias("recipe"), rnd("table_sigma", 4).alias("sigma"), rnd("table_alpha", 6).alias("alpha"))


@query("p_state_fallback", f"""WITH {BROAD_SQL},
 pf AS (SELECT *, coalesce(sigma IS NULL AND lo = 'd' AND up = 'p' AND nlo < 2.0 AND nup BETWEEN 2.6 AND 3.0, false) AS hit FROM bv)
SELECT {KEY_SQL}, CASE WHEN hit THEN 'S' WHEN sigma IS NOT NULL THEN recipe END AS recipe,
  round(CASE WHEN NOT hit THEN sigma WHEN nup <= 2.7 THEN 762 + 960 * (nup - 2.6) WHEN nup <= 2.8 THEN 858 + 1110 * (nup - 2.7)
    WHEN nup <= 2.9 THEN 969 + 610 * (nup - 2.8) ELSE 1030 + 440 * (nup - 2.9) END, 4) AS sigma,
  round(CASE WHEN NOT hit THEN alpha WHEN nup <= 2.7 THEN 0.270 - 0.04 * (nup - 2.6) WHEN nup <= 2.8 THEN 0.266 + 0.02 * (nup - 2.7)
    WHEN nup <= 2.9 THEN 0.268 - 0.10 * (nup - 2.8) ELSE 0.258 - 0.04 * (nup - 2.9) END, 6) AS alpha FROM pf""")
def p_state_fallback(spark, d):
    b = L.p_state_fallback(_broadened(spark, d))
    return b.select(*LINE_KEY, F.col("table_recipe").alias("recipe"), rnd("table_sigma", 4).alias("sigma"), rnd("table_alpha", 6).alias("alpha"))


# levels per part, coefficients per (supplier nation, level)
@query("level_departures", """WITH de AS (SELECT s_nationkey AS z, (s_suppkey % 5)::INTEGER AS level, avg(s_acctbal) / 9876.54321::DOUBLE + 1 AS b FROM supplier GROUP BY 1, 2),
 nl AS (SELECT z, max(level) AS n FROM de GROUP BY 1),
 li AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey AS species_id, l_extendedprice AS wave, (l_suppkey % 30)::INTEGER AS z,
   (l_linenumber % 4)::INTEGER AS lo, (l_partkey % 7)::INTEGER AS up FROM lineitem),
 zz AS (SELECT *, CASE WHEN lo = 0 OR up = 0 THEN 0 ELSE lo END AS lo2, CASE WHEN lo = 0 OR up = 0 THEN 0 ELSE up END AS up2 FROM li)
SELECT l_orderkey, l_linenumber, l_partkey, species_id, wave, round(CASE WHEN lo2 = 0 THEN 1 ELSE coalesce(a.b, 1) END, 6) AS b_lo,
  round(CASE WHEN up2 = 0 THEN 1 ELSE coalesce(c.b, 1) END, 6) AS b_up, coalesce(greatest(lo2, up2) > nl.n, false) AS level_error
FROM zz LEFT JOIN de a ON zz.z = a.z AND lo2 = a.level LEFT JOIN de c ON zz.z = c.z AND up2 = c.level LEFT JOIN nl ON zz.z = nl.z""")
def level_departures(spark, d):
    dep = table(spark, d, "supplier").groupBy(F.col("s_nationkey").alias("z"), (F.col("s_suppkey") % 5).cast("int").alias("level")) \
        .agg((F.avg("s_acctbal") / 9876.54321 + 1).alias("b"))
    li = table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", F.col("l_suppkey").alias("species_id"), F.col("l_extendedprice").alias("wave"),
        (F.col("l_suppkey") % 30).cast("int").alias("z"), (F.col("l_linenumber") % 4).cast("int").alias("ilev_lo"),
        (F.col("l_partkey") % 7).cast("int").alias("ilev_up"))
    out = L.attach_departures(li, dep, ["z"])
    return out.select(*LINE_KEY, rnd("b_lo", 6).alias("b_lo"), rnd("b_up", 6).alias("b_up"), "level_error")


@query("species_flags", """SELECT d.doc_id, coalesce(l.quality, -1) AS quality FROM documents d LEFT JOIN labels l USING (doc_id)""")
def species_flags(spark, d):
    docs = table(spark, d, "documents").select("doc_id")
    return L.attach_flags(docs, table(spark, d, "labels"), "doc_id", "quality", F.lit(-1))


@query("species_names", """SELECT c_custkey, n_name AS name FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE n_regionkey < 4
UNION ALL SELECT NULL, 'unknown ' || n_nationkey FROM nation WHERE n_regionkey = 4 AND n_nationkey IN (SELECT c_nationkey FROM customer)""")
def species_names(spark, d):
    names = table(spark, d, "nation").filter("n_regionkey < 4").select(F.col("n_nationkey").alias("iel"), F.lit(1).alias("ion"), F.col("n_name").alias("name"))
    cust = table(spark, d, "customer").select("c_custkey", F.col("c_nationkey").alias("iel"), F.lit(1).alias("ion"))
    known, unknown = L.species_name(cust, names)
    return known.select("c_custkey", "name").unionByName(unknown.select(
        F.lit(None).cast("bigint").alias("c_custkey"), F.concat(F.lit("unknown "), F.col("iel").cast("string")).alias("name")))


@query("level_energy_check", """WITH lv AS (SELECT s_suppkey AS level, s_acctbal * 10 AS e FROM supplier),
 li AS (SELECT c_custkey, c_custkey % 100 AS n_lo, (c_custkey + 7) % 100 AS n_up, c_acctbal / 8065.46 * 10 AS e_up FROM customer),
 ch AS (SELECT li.*, a.e AS ea, b.e AS eb FROM li JOIN lv a ON n_lo = a.level JOIN lv b ON n_up = b.level)
SELECT c_custkey, abs(ea * 1.0005 - ea) > 0.001 * abs(ea) AS bad_lo, abs(e_up * 8065.46 - eb) > 0.001 * abs(eb) AS bad_up FROM ch
  WHERE abs(e_up * 8065.46 - eb) > 0.001 * abs(eb)""")
def level_energy_check(spark, d):
    levels = table(spark, d, "supplier").select(F.col("s_suppkey").alias("level"), (F.col("s_acctbal") * 10).alias("e"))
    li = table(spark, d, "customer").select("c_custkey", (F.col("c_custkey") % 100).alias("n_lo"), ((F.col("c_custkey") + 7) % 100).alias("n_up"),
                                            (F.col("c_acctbal") / 8065.46 * 10).alias("e_up"))
    low = levels.select(F.col("level").alias("n_lo"), (F.col("e") * 1.0005 / 8065.46).alias("e_lo"))
    return L.check_levels(li.join(low, "n_lo"), levels).select("c_custkey", "bad_lo", "bad_up")


# --- species text --------------------------------------------------------------------------

@query("parse_species", """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey AS species_id, l_extendedprice AS wave,
  CASE WHEN l_linenumber <= 3 THEN (l_suppkey % 92 + 1) WHEN l_linenumber <= 5 THEN (l_suppkey % 30 + 1) * 100 + l_quantity::INTEGER
   ELSE ((l_suppkey % 30 + 1) * 100 + l_quantity::INTEGER) * 100 + 8 END::BIGINT AS iel,
  CASE WHEN l_linenumber <= 3 THEN 1 WHEN l_linenumber <= 5 THEN 2 ELSE 3 END AS natom,
  (l_partkey % 250)::INTEGER AS first_isotope FROM lineitem""")
def parse_species(spark, d):
    z, q, iso = F.col("species_id") % 30 + 1, F.col("strength").cast("int"), F.col("l_partkey") % 250
    code = F.when(F.col("l_linenumber") <= 3, F.format_string("  %d.%03d            ", F.col("species_id") % 92 + 1, iso)) \
        .when(F.col("l_linenumber") <= 5, F.concat(F.when(z < 10, "00").otherwise(""), F.format_string("%d%02d.%03d016", z, q, iso))) \
        .otherwise(F.format_string("%d%02d08.%03d000001", z, q, iso))
    s = lines(spark, d).withColumn("s", SP.parse_species(code))
    return s.select(*LINE_KEY, "s.iel", F.size("s.atoms").alias("natom"), F.col("s.isotopes")[0].alias("first_isotope"))


SYMBOLS_SQL = "[" + ", ".join(f"'{s}'" for s in SP.SYMBOLS) + "]"


@query("species_from_designation", f"""WITH b AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey AS species_id, l_extendedprice AS wave,
  l_suppkey % 60 + 1 AS z1, l_quantity::INTEGER AS z2, l_partkey % 200 + 1 AS a1, l_orderkey % 90 + 1 AS a2 FROM lineitem)
SELECT l_orderkey, l_linenumber, l_partkey, species_id, wave,
  CASE WHEN l_linenumber <= 2 THEN concat(z1, '.', lpad(a1::VARCHAR, 3, '0')) WHEN z1 <= z2 THEN concat(z1, lpad(z2::VARCHAR, 2, '0'), '.', lpad(a1::VARCHAR, 3, '0'), lpad(CASE WHEN l_linenumber = 4 THEN '0' ELSE a2::VARCHAR END, 3, '0'))
  ELSE concat(z2, lpad(z1::VARCHAR, 2, '0'), '.', lpad(CASE WHEN l_linenumber = 4 THEN '0' ELSE a2::VARCHAR END, 3, '0'), lpad(a1::VARCHAR, 3, '0')) END AS species,
  CASE WHEN l_linenumber IN (1, 5) THEN 2 WHEN l_linenumber = 6 THEN 3 ELSE 1 END AS ion FROM b""")
def species_from_designation(spark, d):
    symbols = F.array(*[F.lit(s) for s in SP.SYMBOLS])
    z1, z2 = F.element_at(symbols, (F.col("species_id") % 60 + 1).cast("int")), F.element_at(symbols, F.col("strength").cast("int"))
    a1, a2 = F.col("l_partkey") % 200 + 1, F.col("l_orderkey") % 90 + 1
    n = F.col("l_linenumber")
    charge = F.when(n.isin(1, 5), "+").when(n == 6, "+2").otherwise("")
    full = F.when(n <= 2, F.format_string("(%d)%s%s", a1, z1, charge)) \
        .when(n == 4, F.format_string("(%d)%s%s%s", a1, z1, z2, charge)) \
        .otherwise(F.format_string("(%d)%s(%d)%s%s", a1, z1, a2, z2, charge))
    return SP.with_species(lines(spark, d), full).select(*LINE_KEY, "species", "ion")


@query("extract_designation", f"""WITH b AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey AS species_id, l_extendedprice AS wave, {SYMBOLS_SQL}[(l_suppkey % 60 + 1)::INTEGER] AS sym FROM lineitem)
SELECT l_orderkey, l_linenumber, l_partkey, species_id, wave, CASE WHEN l_linenumber % 3 = 0 THEN sym || '+' WHEN l_linenumber % 3 = 1 THEN '(' || l_partkey % 99 + 1 || ')' || sym ELSE sym END AS full FROM b""")
def extract_designation(spark, d):
    symbols = F.array(*[F.lit(s) for s in SP.SYMBOLS])
    sym = F.element_at(symbols, (F.col("species_id") % 60 + 1).cast("int"))
    iso = F.format_string("(%d)%s", F.col("l_partkey") % 99 + 1, sym)
    k = F.col("l_linenumber") % 3
    refs = F.when(k == 0, F.format_string("'_   1 wl:K09   1 gf:K09   1 K09   %s+'", sym)) \
        .when(k == 1, F.format_string("'_   13 wl:LBT,iso:K08  13 LBT  13 WLS%s'", iso)) \
        .otherwise(F.format_string("'_   1 wl:MW   1 gf:MW  1 Bell%s'", sym))
    token = F.when(k == 1, iso).otherwise(sym)
    return lines(spark, d).select(*LINE_KEY, SP.extract_designation(refs, token).alias("full"))


LEVELS = ["'  LS 3p6.3d7.(4F).4p y5D*", "'  LS 3p6.3d6.(5D).4s.(6D).5d 7F", "'  JJ 2p6.3s 2S", "'     2s2.2p", "'  LS  5f2.(3H).6d  4K*",
          "'  JK 2p5.(2P).3p 2[5]", "'  __ z3D*", "'  LK 4d 2D", "'  LS  term", "'  LS 2s.2p 3P*"]
LEVELS_SQL = "[" + ", ".join("'" + s.replace("'", "''") + "'" for s in LEVELS) + "]"


def _level(spark, d):
    levels = F.array(*[F.lit(s) for s in LEVELS])
    return lines(spark, d).withColumns({
        "lower": F.element_at(levels, (F.col("l_partkey") % 10 + 1).cast("int")),
        "upper": F.element_at(levels, (F.col("species_id") % 10 + 1).cast("int"))})


LEVEL_SQL = f"""lw AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey AS species_id, l_extendedprice AS wave,
  {LEVELS_SQL}[(l_partkey % 10 + 1)::INTEGER] AS lower, {LEVELS_SQL}[(l_suppkey % 10 + 1)::INTEGER] AS upper FROM lineitem)"""


def _orbit_sql(c: str) -> str:
    """List of l numbers of the configuration, last first."""
    return f"""list_reverse(list_transform(regexp_extract_all(regexp_extract(rtrim(substr({c}, 6)), '^(.*) +[^ ]+$', 1), '[spdfghik]'), lambda x: instr('spdfghik', x) - 1))"""


ORBITS_SQL = f"""{LEVEL_SQL}, ob AS (SELECT *, {_orbit_sql('lower')} AS lo, {_orbit_sql('upper')} AS uo FROM lw),
 ol AS (SELECT *, coalesce(lo[1], -1)::INTEGER AS l1, coalesce(lo[2], -1)::INTEGER AS l2, coalesce(uo[1], -1)::INTEGER AS u1, coalesce(uo[2], -1)::INTEGER AS u2 FROM ob)"""


@query("orbital_letters", f"WITH {ORBITS_SQL} SELECT {KEY_SQL}, l1, l2 FROM ol")
def orbital_letters(spark, d):
    o = _level(spark, d).withColumn("o", SP.orbital_letters(F.col("lower")))
    return o.select(*LINE_KEY, F.col("o")[0].alias("l1"), F.col("o")[1].alias("l2"))


@query("transition_type", f"""WITH {ORBITS_SQL},
 kn AS (SELECT * EXCLUDE (l1, l2, u1, u2), CASE WHEN substr(lower, 4, 2) IN ('LS', 'JJ', 'JK', 'LK') THEN l1 ELSE -1 END AS l1, CASE WHEN substr(lower, 4, 2) IN ('LS', 'JJ', 'JK', 'LK') THEN l2 ELSE -1 END AS l2,
   CASE WHEN substr(upper, 4, 2) IN ('LS', 'JJ', 'JK', 'LK') THEN u1 ELSE -1 END AS u1, CASE WHEN substr(upper, 4, 2) IN ('LS', 'JJ', 'JK', 'LK') THEN u2 ELSE -1 END AS u2 FROM ol),
 ch AS (SELECT *, CASE WHEN l1 = -1 AND u1 = -1 THEN [-1, -1] WHEN l1 >= 3 OR u1 >= 3 THEN [2, 3]
   WHEN l1 >= 0 AND u1 >= 0 AND abs(l1 - u1) <> 1 THEN
     CASE WHEN l2 < 0 THEN CASE WHEN u2 >= 0 AND (u1 = l1 OR abs(l1 - u2) = 1) THEN [l1, u2] ELSE [l1, u1] END
     WHEN u2 < 0 THEN CASE WHEN l1 = u1 OR abs(u1 - l2) = 1 THEN [l2, u1] ELSE [l1, u1] END
     WHEN abs(l1 - u2) = 1 THEN [l1, u2] WHEN abs(l2 - u1) = 1 THEN [l2, u1] WHEN abs(l2 - u2) = 1 THEN [l2, u2] ELSE [l1, u1] END
   WHEN l1 < 0 AND u1 >= 0 THEN [CASE WHEN u1 = 0 THEN 1 ELSE u1 - 1 END, u1] WHEN l1 >= 0 AND u1 < 0 THEN [l1, CASE WHEN l1 = 0 THEN 1 ELSE l1 - 1 END]
   ELSE [l1, u1] END AS c FROM kn)
SELECT {KEY_SQL}, CASE WHEN c[1] < 0 THEN 'X' ELSE substr('spdfghik', c[1] + 1, 1) END AS lower, CASE WHEN c[2] < 0 THEN 'X' ELSE substr('spdfghik', c[2] + 1, 1) END AS upper FROM ch""")
def transition_type(spark, d):
    t = SP.with_transition(_level(spark, d), F.col("lower"), F.col("upper"), "lo", "up")
    return t.select(*LINE_KEY, F.col("lo").alias("lower"), F.col("up").alias("upper"))


@query("shrink_designation", f"""WITH {LEVEL_SQL} SELECT {KEY_SQL}, CASE WHEN substr(lower, 4, 2) = '  ' THEN '__' ELSE substr(lower, 4, 2) END AS coupling,
  trim(regexp_replace(substr(lower, 6), ' +', ' ', 'g')) AS desig FROM lw""")
def shrink_designation(spark, d):
    s = _level(spark, d).withColumn("s", SP.shrink_designation(F.col("lower")))
    return s.select(*LINE_KEY, "s.coupling", "s.desig")


# --- physics -------------------------------------------------------------------------------

@query("planck", """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey AS species_id, l_extendedprice AS wave,
  round(log10(1 / ((exp(1.438769e8 / l_extendedprice / (3000 + l_quantity * 100)) - 1) * pow(l_extendedprice, 5) / 1.191044e27)), 6) AS log_b FROM lineitem""")
def planck(spark, d):
    return lines(spark, d).select(*LINE_KEY, rnd(F.log10(P.planck(3000 + F.col("strength") * 100, F.col("wave"))), 6).alias("log_b"))


DB_SQL = """db AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey AS species_id, l_extendedprice AS wave, 3500 + l_quantity * 60 AS temp,
  (l_suppkey % 60 + 1) * 1.6603e-24 AS mass, 1e5::DOUBLE * (1 + l_discount * 10) AS xi, l_extendedprice * 1e-8 AS wcm, l_discount * 30 AS chi, l_linenumber AS g FROM lineitem)"""


def _depth_rows(spark, d):
    return table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", F.col("l_suppkey").alias("species_id"), F.col("l_extendedprice").alias("wave"),
        (3500 + F.col("l_quantity") * 60).alias("temp"), ((F.col("l_suppkey") % 60 + 1) * 1.6603e-24).alias("mass"),
        (1e5 * (1 + F.col("l_discount") * 10)).alias("xi"), (F.col("l_extendedprice") * 1e-8).alias("wcm"), (F.col("l_discount") * 30).alias("chi"),
        F.col("l_linenumber").alias("g"), "l_tax", "l_quantity")


@query("doppler_boltzmann", f"""WITH {DB_SQL} SELECT {KEY_SQL}, round(sqrt(2 * 1.38066e-16 * temp / mass + xi * xi) / 1e5, 6) AS xi0,
  round(log10(sqrt(2 * 1.38066e-16 * temp / mass + xi * xi) / wcm), 6) AS log_dnud, round(log10(g * 1e20 * pow(10, -chi * (5040 / temp)) / 2.5), 6) AS log_n,
  round(1 - exp(-(6.6256e-27 * 2.9979e10 / 1.38066e-16) / wcm / temp), 6) AS stim FROM db""")
def doppler_boltzmann(spark, d):
    c = P.doppler_boltzmann(F.col("temp"), F.col("mass"), F.col("xi"), F.col("wcm"), F.col("g"), F.lit(1e20), F.col("chi"), F.lit(2.5))
    return _depth_rows(spark, d).select(
        *LINE_KEY, rnd(c["xi0"] / 1e5, 6).alias("xi0"), rnd(F.log10(c["dnud"]), 6).alias("log_dnud"),
        rnd(F.log10(c["n_low"]), 6).alias("log_n"), rnd(c["stim"], 6).alias("stim"))


@query("saha_fraction", f"""WITH {DB_SQL}, sa AS (SELECT *, 2.5 * log10(temp) - log10(chi + 1) - 0.1761 AS base, 5040 / temp AS th FROM db),
 sb AS (SELECT *, pow(10, base + log10(3.0::DOUBLE / 2) - th * 7.6) AS s1, pow(10, base + log10(1.5::DOUBLE / 3) - th * 16.2) AS s2 FROM sa)
SELECT {KEY_SQL}, round(CASE g WHEN 1 THEN 1 / (1 + s1 * (1 + s2)) WHEN 2 THEN s1 / (1 + s1 * (1 + s2)) END, 8) AS share FROM sb""")
def saha_fraction(spark, d):
    s = P.saha_fraction(F.col("temp"), F.col("chi") + 1, F.lit(2.0), F.lit(3.0), F.lit(1.5), F.lit(7.6), F.lit(16.2), F.col("g"))
    return _depth_rows(spark, d).select(*LINE_KEY, rnd(s, 8).alias("share"))


@query("nlte_correct", """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey AS species_id, l_extendedprice AS wave,
  round(l_quantity * (1 + l_tax) * (1 + (0.9 - 1) * (1 - l_discount) / (1 + l_tax)), 6) AS kappa_nlte, round(l_quantity * 0.9 * (1 - l_discount), 6) AS emissivity FROM lineitem""")
def nlte_correct(spark, d):
    c = P.nlte_correct(F.col("l_quantity"), F.lit(0.9), 1 + F.col("l_tax"), 1 - F.col("chi") / 30)
    return _depth_rows(spark, d).select(*LINE_KEY, rnd(c["kappa_nlte"], 6).alias("kappa_nlte"), rnd(c["emissivity"], 6).alias("emissivity"))


GAMMA_SERIES_SQL = " + ".join([repr(P.GAMMA_FIRST)] + [f"{c!r}::DOUBLE / (x + {j + 1})" for j, c in enumerate(P.GAMMA_SERIES)])
WIDTH_SQL = f"""{DB_SQL},
 wa AS (SELECT *, 1e4 * (1 + g) AS pg, 8e3 * (1 + g) AS ph, 900.0::DOUBLE AS phe, 50.0::DOUBLE AS ph2, 5.0 + g AS pe, 250 + 10 * g AS sigma, 0.2::DOUBLE + 0.01 * g AS alpha,
   8 * 1.38066e-16 * 4.0 / (4 * pi()) * (1 / 1.6735e-24::DOUBLE + 1 / mass) AS cb FROM db),
 wb AS (SELECT *, 1 + phe / ph * 0.41336 + ph2 / ph * 0.85 AS pert, sqrt(cb * temp) AS vel, 2 - alpha / 2 AS x FROM wa),
 wc AS (SELECT *, (x + 0.5) * ln(x + 5.5) - (x + 5.5) + ln({P.GAMMA_SCALE!r} * ({GAMMA_SERIES_SQL}) / x) AS lg FROM wb),
 wd AS (SELECT *, 1e8 + CASE g % 5 WHEN 0 THEN 0 WHEN 1 THEN 0.1 * 2.0 * 3.0e10 * sqrt(273.0 / temp) * pg / 1.01325e6
   WHEN 2 THEN pow(10, -7.5) * pow(temp / 10000.0, 0.3) * ph / 1.38066e-16 / temp * pert
   WHEN 3 THEN pow(10, 8.6735 + 0.7 * log10(5040 / temp) + log10(ph) + 0.4 * (-31.2)) * 1e8 * pert * 2.5
   ELSE pow(16.0 / (4 * pi()), alpha / 2) * exp(lg) * vel * sigma * 2.8002e-17 * pow(vel / 1e6, -alpha) * 2 * (ph / 1.38066e-16 / temp) * pert END AS gamma,
   pe / 1.38066e-16 / temp AS xne, 13.598 * pow(1 / (20.0 - (chi + 3.40 * 3647.0 / wave)), 2) AS lev FROM wc),
 we AS (SELECT *, gamma + CASE WHEN g <= 3 THEN pow(10, -5.1) * pow(temp / 10000.0, 1.0::DOUBLE / 6) * xne ELSE 2.26e-7 * lev * xne END AS total,
   sqrt(2 * 1.38066e-16 * temp / mass + xi * xi) / wcm AS dnud FROM wd)"""


@query("damping_width", f"WITH {WIDTH_SQL} SELECT {KEY_SQL}, round(log10(gamma), 6) AS log_gamma, round(log10(total / (4 * pi() * dnud)), 6) AS log_a FROM we")
def damping_width(spark, d):
    r = _depth_rows(spark, d).withColumns({
        "pg": 1e4 * (1 + F.col("g")), "ph": 8e3 * (1 + F.col("g")), "pe": 5.0 + F.col("g"),
        "recipe": F.element_at(F.array(*[F.lit(x) for x in "RTWUS"]), F.col("g") % 5 + 1)})
    fdamp = F.when(F.col("recipe") == "W", -7.5).otherwise(2.5)
    gamma = P.damping_gamma(F.col("recipe"), F.col("temp"), F.col("pg"), F.col("ph"), F.lit(900.0), F.lit(50.0), F.col("mass"), F.lit(1e8), fdamp,
                            F.lit(-31.2), 250 + 10 * F.col("g"), 0.2 + 0.01 * F.col("g"))
    listed = F.when(F.col("g") <= 3, -5.1).otherwise(0.0)
    stark = P.stark_gamma(F.col("temp"), F.col("pe"), F.lit(1), F.lit(20.0), F.col("chi"), F.col("wave"), listed)
    dnud = P.doppler_boltzmann(F.col("temp"), F.col("mass"), F.col("xi"), F.col("wcm"), F.col("g"), F.lit(1.0), F.col("chi"), F.lit(1.0))["dnud"]
    r = r.withColumns({"gamma": gamma, "stark": stark, "dnud": dnud})
    return r.select(*LINE_KEY, rnd(F.log10("gamma"), 6).alias("log_gamma"),
                    rnd(F.log10(P.damping_a(F.col("gamma") + F.col("stark"), F.col("dnud"))), 6).alias("log_a"))


POLY = (0.6, 0.12, -0.03, 0.004, 0.0002, 0.00001)
POLY_SQL = lambda t: " + ".join(f"{c!r}::DOUBLE * pow(ln({t}), {i})" for i, c in enumerate(POLY))


@query("partition_poly", f"""WITH t AS (SELECT o_orderkey, o_totalprice / 20 AS temp FROM orders)
SELECT o_orderkey, round(CASE WHEN o_orderkey % 11 = 0 THEN 0 WHEN temp <= 16000 THEN exp({POLY_SQL('greatest(temp, 1000)')})
  ELSE exp((({POLY_SQL('16000.0::DOUBLE')}) - ({POLY_SQL('10000.0::DOUBLE')})) * (temp - 16000) / 6000 + ({POLY_SQL('16000.0::DOUBLE')})) END, 5) AS q,
  round(exp({POLY_SQL('temp')}), 5) AS q_mol FROM t""")
def partition_poly(spark, d):
    coef = F.array(*[F.lit(c) for c in POLY])
    t = table(spark, d, "orders").select("o_orderkey", (F.col("o_totalprice") / 20).alias("temp"))
    known = F.when(F.col("o_orderkey") % 11 != 0, coef)
    return t.select("o_orderkey", rnd(P.partition_poly(known, F.col("temp")), 5).alias("q"),
                    rnd(P.partition_horner(coef, F.col("temp")), 5).alias("q_mol"))


QVIB_SQL = "[" + ", ".join(f"{float(np.sqrt(q))!r}::DOUBLE" for q in P.Q_VIB) + "]"


@query("partition_sqrt_table", f"""WITH t AS (SELECT o_orderkey, o_totalprice / 40 AS temp FROM orders),
 i AS (SELECT *, least(greatest(floor(temp / 200), 1), 39)::INTEGER AS k FROM t),
 r AS (SELECT *, CASE WHEN temp <= 200 THEN 1 WHEN temp >= 8000 THEN (temp - 8000) / 2000 * ({QVIB_SQL}[40] - {QVIB_SQL}[30]) + {QVIB_SQL}[40]
   ELSE (temp - k * 200) / 200 * ({QVIB_SQL}[k + 1] - {QVIB_SQL}[k]) + {QVIB_SQL}[k] END AS root,
   sqrt(14.52177::DOUBLE * 9.27771) AS bc FROM i),
 w AS (SELECT *, (1 - bc / 27.88063) * bc * 1.43877 / temp AS b, sqrt(3.14159 / (27.88063::DOUBLE * 14.52177 * 9.27771) * pow(temp / 1.43877, 3)) AS cl FROM r)
SELECT o_orderkey, round(root * root, 6) AS q_vib, round(root * root * cl * exp(0.25 * bc * 1.43877 / temp) * (1 + b / 12 + b * b * 7 / 480) * 2, 2) AS q FROM w""")
def partition_sqrt_table(spark, d):
    t = table(spark, d, "orders").select("o_orderkey", (F.col("o_totalprice") / 40).alias("temp"))
    vib = P.partition_sqrt_table(F.col("temp"))
    t = t.withColumn("vib", vib)
    return t.select("o_orderkey", rnd("vib", 6).alias("q_vib"), rnd(F.col("vib") * P.water_rotation(F.col("temp")), 2).alias("q"))


# --- VALD extracts --------------------------------------------------------------------------

# seven layouts by line number: commas, blanks, an empty field, no depth, molecules, hydrogen, a row that ends early
VALD_NAMES = ["Fe 1", "Fe 2", "Ca 1", "TiO 1", "H 1", "Ni 1", "Sr 2"]
VALD_REFS = ["_          Kurucz FeI 2014   1 wl:K14   1 gf:K14   1 K14    Fe", "_          Kurucz FeII 2013   2 wl:K13   2 gf:K13    Fe+",
             "_          BellCa   3 wl:BL   3 gf:BL    BellCa", "_                             3 wl:PPN2012   3 gf:PPN2012    (48)TiO",
             "_          1 wl:H    H", "E 0.06     Sc-Ni Wisconsin   13 wl:LBT,iso:K08  13 gf:WLSCow    (64)Ni", "_          4 wl:R    Sr+"]


def _vald_raw(spark, d):
    """Four rows for each row of lineitem, 31 files."""
    n, q = F.col("l_linenumber"), F.col("l_quantity")
    li = table(spark, d, "lineitem").withColumns({"_chi": F.col("l_discount") * 160, "_v": F.col("l_linenumber") - 1})
    text = lambda names: F.get(F.array(*[F.lit(s) for s in names]), F.col("_v"))
    fixed = lambda c, k: F.format_string(f"%.{k}f", c)
    fields = [fixed("l_extendedprice", 2), fixed(0.25 - F.col("l_tax") * 20, 3), fixed("_chi", 3), F.lit("2.0"), fixed(F.col("_chi") + F.col("l_tax") * 100, 3),
              fixed(F.col("l_suppkey") % 9 / 2, 1), F.lit("1.420"), F.lit("99.000"), F.lit("1.110"), fixed(F.col("l_tax") * 100, 3),
              F.when(n == 6, "").otherwise(fixed(q / -10, 3)), F.when(q > 40, fixed(q * 5.25, 3)).when(q > 30, fixed(q / -7 - 1, 3)).otherwise("0.000")]
    name = F.concat(F.lit("'"), text(VALD_NAMES), F.lit("'"))
    data = F.when(n == 3, F.concat(name, F.lit("  "), F.concat_ws("  ", *fields))).when(n == 7, F.concat(name, F.lit(", "), F.concat_ws(",  ", *fields[:3]))) \
        .when(n == 2, F.concat(name, F.lit(", "), F.concat_ws(", ", *fields))).otherwise(F.concat(name, F.lit(",  "), F.concat_ws(", ", *fields), F.lit(", 0.009,")))
    orbit = lambda shift: F.substring(F.lit("spdf"), (F.col("l_suppkey") % 3 + shift).cast("int"), F.lit(1))
    lower = F.concat(F.when(n == 2, "'       ").otherwise("'  LS   "), F.lit("3d6.(5D).4"), orbit(1), F.lit("  a6D      '"))
    upper = F.concat(F.lit("'  LS                 3d6.(5D).4"), orbit(2), F.lit(" z6F*'"))
    rows = [data, lower, upper, F.concat(F.lit("'"), text(VALD_REFS), F.lit("'")), F.lit("* references follow")]
    order = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_discount", "l_tax"]
    # the number of the row first: its text is made only where it is read
    raw = li.select("*", F.format_string("v%d", F.col("l_suppkey") % 31).alias("file"), F.explode(F.array(*[F.lit(i) for i in range(len(rows))])).alias("i"))
    return raw.select("file", F.col("l_orderkey").alias("block"), F.struct(*order, "i").alias("pos"), row_text(rows).alias("value"))


VALD_SQL = f"""WITH {IONPOT_SQL},
 vr AS (SELECT concat('v', l_suppkey % 31) AS list_id, row_number() OVER (PARTITION BY l_suppkey % 31
    ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_quantity, l_discount, l_tax)::BIGINT AS line_no, l_linenumber AS n, l_suppkey AS s,
   round(l_extendedprice, 2) AS wave, round(l_discount * 160, 3) + 0.0 AS chi_low, round(l_discount * 160 + l_tax * 100, 3) AS chi_up, round(0.25 - l_tax * 20, 3) AS log_gf,
   round(l_tax * 100, 3) AS rad, l_quantity AS q, [26, 26, 20, 822, 1, 28, 38][l_linenumber]::BIGINT AS iel, CASE WHEN l_linenumber IN (2, 7) THEN 2 ELSE 1 END AS ion,
   ['Fe I', 'Fe II', 'Ca I', 'TiO I', 'H I', 'Ni I', 'Sr II'][l_linenumber] AS comment FROM lineitem),
 vm AS (SELECT vr.*, CASE WHEN n = 7 THEN 'fields' WHEN n = 5 THEN 'H or He' WHEN chi_low >= 15 THEN 'low level' WHEN iel <= 92 AND chi_up >= chi_ion THEN 'bound-free' END AS reason
   FROM vr LEFT JOIN ip ON iel = ip.z AND vr.ion = ip.ion)"""


@query("vald_to_lines", VALD_SQL + """ SELECT list_id, line_no, CASE WHEN iel = 822 THEN 8220000001 ELSE iel * 10000000 + ion END AS block_id,
  CASE WHEN iel = 822 THEN '822.000000' ELSE concat(iel, '.000') END AS species, ion, comment, wave, chi_low, log_gf, s % 9 + 1.0::DOUBLE AS g_up,
  round(CASE WHEN q > 40 THEN q * 5.25 WHEN q > 30 THEN q / -7 - 1 WHEN n = 1 THEN 1.4 WHEN n = 3 THEN 1.8 ELSE 2.5 END, 3) AS fdamp, round(CASE WHEN rad > 3 THEN pow(10, rad) ELSE 1e5 END, 1) AS gam_rad,
  CASE WHEN n = 6 THEN 0 ELSE round(q / -10, 3) END::DOUBLE AS gam_stark, CASE WHEN n = 4 THEN 'X' ELSE substr('spd', (s % 3 + 1)::INTEGER, 1) END AS lev_lo,
  CASE WHEN n = 4 THEN 'X' ELSE substr('pdf', (s % 3 + 1)::INTEGER, 1) END AS lev_up,
  concat(comment, CASE WHEN n = 2 THEN ' __' ELSE ' LS' END, ':3d6.(5D).4', substr('spd', (s % 3 + 1)::INTEGER, 1), ' a6D LS:3d6.(5D).4', substr('pdf', (s % 3 + 1)::INTEGER, 1), ' z6F*') AS descr
  FROM vm WHERE reason IS NULL""")
def vald_to_lines(spark, d):
    kept, _ = V.vald_to_lines(_vald_raw(spark, d), ionpot(spark))
    return kept.select("list_id", "line_no", "block_id", "species", "ion", "comment", "wave", "chi_low", "log_gf", "g_up", rnd("fdamp", 3).alias("fdamp"),
                       rnd("gam_rad", 1).alias("gam_rad"), "gam_stark", "lev_lo", "lev_up", "descr")


@query("vald_rejects", VALD_SQL + """ SELECT list_id, line_no, ['Fe', 'Fe', 'Ca', 'TiO', 'H', 'Ni', 'Sr'][n] AS token, reason AS reject_reason FROM vm WHERE reason IS NOT NULL""")
def vald_rejects(spark, d):
    _, rejected = V.vald_to_lines(_vald_raw(spark, d), ionpot(spark))
    return rejected.select("list_id", "line_no", F.regexp_extract("data", r"^'([^\s']+)", 1).alias("token"), "reject_reason")


@query("vald_counts", VALD_SQL + """ SELECT list_id, CASE WHEN iel = 822 THEN '822.000000' ELSE concat(iel, '.000') END AS species, ion, count(*) AS n_read,
  count(*) FILTER (reason IS NULL) AS n_written, count(reason) AS n_skipped FROM vm GROUP BY ALL""")
def vald_counts(spark, d):
    """Read = written + skipped, by file, species and stage."""
    marked = V.vald_marked(LL.parse_vald3(_vald_raw(spark, d)), ionpot(spark))
    return L.count_lines(marked, ["list_id", "species", "ion"])
