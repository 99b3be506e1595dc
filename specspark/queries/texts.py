"""Readers and writers: text is built from the tables, read back, and compared with the source values."""

from __future__ import annotations

from pyspark.sql import functions as F

from specspark.queries.common import SPECTRA_SQL, rnd, row_text, spectra, table
from specspark.registry import query
from specspark.sources import linelists as LL
from specspark.sources import models as M
from specspark.sources import spectra as SS
from specspark.sources import tables as T
from specspark.sources.text import read_saved
from specspark.streaming.ingest import new_folder

# --- spectra -----------------------------------------------------------------------------

MU = [0.1, 0.5, 1.0]
INTENSITY_SQL = f"""{SPECTRA_SQL}, mu AS (SELECT unnest([0.1, 0.5, 1.0])::DOUBLE AS mu),
 it AS (SELECT spec_id, wave, mu, 1e4 * flux * (0.4 + 0.6 * mu) AS i_abs, flux * (0.4 + 0.6 * mu) AS i_norm FROM sp, mu)"""


def _spectrum(spark, d):
    sp = spectra(spark, d)
    return sp.select(F.col("spec_id").cast("string").alias("spec_id"), "wave", F.col("flux").alias("flux_norm"), (F.col("flux") * 1e4).alias("flux_abs"))


def _intensity(spark, d):
    sp = spectra(spark, d).withColumn("mu", F.explode(F.array(*[F.lit(m) for m in MU])))
    limb = F.col("flux") * (0.4 + 0.6 * F.col("mu"))
    return sp.select(F.col("spec_id").cast("string").alias("spec_id"), "wave", "mu", (limb * 1e4).alias("i_abs"), limb.alias("i_norm"))


def _raw_spectra(spark, d):
    rows = SS.render_spectra(_spectrum(spark, d), _intensity(spark, d))
    junk = _spectrum(spark, d).filter("wave = 4000").select(
        "spec_id", F.lit(4005.0).alias("pos"), F.lit("   4005.000   *******  1.0E+00").alias("value"))
    return rows.unionByName(junk).select(F.col("spec_id").alias("file"), F.floor(F.greatest("pos", F.lit(0.0))).alias("block"), "pos", "value")


@query("read_spectra", f"""WITH {INTENSITY_SQL}
SELECT sp.spec_id::VARCHAR AS spec_id, sp.wave, round(flux, 5) AS flux_norm, CASE WHEN flux * 1e4 < 9999.995 THEN round(flux * 1e4, 2) ELSE round(flux * 1e4, 1) END AS flux_abs,
  mu, CASE WHEN i_abs < 9999.995 THEN round(i_abs, 2) ELSE round(i_abs, 1) END AS i_abs, round(i_norm, 5) AS i_norm FROM sp JOIN it ON sp.spec_id = it.spec_id AND sp.wave = it.wave""")
def read_spectra(spark, d):
    rows = SS.spectrum_rows(_raw_spectra(spark, d))
    return rows.select("spec_id", "wave", "flux_norm", "flux_abs", F.inline("points"))


@query("load_all_spectra", f"""WITH {SPECTRA_SQL} SELECT concat(spec_id, '.spec') AS spec_id, count(*) AS n, round(sum(round(flux, 5)), 5) AS total FROM sp GROUP BY 1""")
def load_all_spectra(spark, d):
    rows = SS.render_spectra(_spectrum(spark, d))
    raw = rows.select(F.format_string("file:/runs/a/%s.spec", "spec_id").alias("file"), F.floor("pos").alias("block"), "pos", "value")
    raw = raw.withColumn("file", SS.base_name(F.col("file")))
    spectrum, _ = SS.parse_spectra(raw)
    return spectrum.groupBy("spec_id").agg(F.count(F.lit(1)).alias("n"), rnd(F.sum("flux_norm"), 5).alias("total"))


@query("concat_spectra", f"""WITH {SPECTRA_SQL} SELECT label % 2 AS part, count(*) AS n, count(DISTINCT spec_id) AS n_spec FROM sp GROUP BY 1""")
def concat_spectra(spark, d):
    label = spectra(spark, d).select(F.col("spec_id").cast("string").alias("spec_id"), "label").distinct()
    rows = SS.render_spectra(_spectrum(spark, d)).join(label, "spec_id")
    raw = lambda k: rows.filter(F.col("label") % 2 == k).select(
        F.format_string("dir%d/%s", F.lit(k), "spec_id").alias("file"), F.floor("pos").alias("block"), "pos", "value")
    both, _ = SS.parse_spectra(raw(0).unionByName(raw(1)))
    part = F.substring("spec_id", 4, 1).cast("int")
    return both.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n"), F.countDistinct("spec_id").alias("n_spec"))


@query("write_spectra", f"""WITH {INTENSITY_SQL}, pe AS (SELECT spec_id, wave, string_agg(printf(' %12.5E %8.5f', i_abs, i_norm), '' ORDER BY mu) AS cells FROM it GROUP BY 1, 2)
SELECT sp.spec_id::VARCHAR AS spec_id, sp.wave AS pos, concat(printf('%11.3f %10.5f %12.5E', sp.wave, flux, flux * 1e4), cells) AS value FROM sp JOIN pe ON sp.spec_id = pe.spec_id AND sp.wave = pe.wave
UNION ALL SELECT vec_id::VARCHAR, -1.0, '# mu-points   1.000000E-01  5.000000E-01  1.000000E+00' FROM embeddings""")
def write_spectra(spark, d):
    rows = SS.render_spectra(_spectrum(spark, d), _intensity(spark, d))
    return rows.withColumn("pos", F.greatest("pos", F.lit(-1.0)))


@query("write_depth10", f"""WITH {SPECTRA_SQL}, r AS (SELECT spec_id, i // 10 AS pos, string_agg(printf('%7.4f', 1 - flux), '' ORDER BY i) AS value FROM sp GROUP BY 1, 2)
SELECT spec_id, pos::BIGINT AS pos, value FROM r UNION ALL SELECT vec_id, -1, printf('%10.2f%10.2f%10.2f%10.2f', 4000.0::DOUBLE, 4630.0::DOUBLE, 10.0::DOUBLE, 0.0::DOUBLE) FROM embeddings""")
def write_depth10(spark, d):
    return SS.render_rows_of_n(spectra(spark, d), ["spec_id"], "wave", "flux")


@query("unpack_blocks", """WITH b AS (SELECT label, vec_id, embedding, coalesce(sum(len(embedding)) OVER (PARTITION BY label ORDER BY vec_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM embeddings),
 u AS (SELECT label, before + unnest(range(len(embedding))) AS pixel, unnest(embedding)::DOUBLE AS y FROM b)
SELECT label, pixel::BIGINT AS pixel, round(4000.0::DOUBLE + 0.01::DOUBLE * pixel, 6) AS x, round(y, 6) + 0.0 AS y FROM u""")
def unpack_blocks(spark, d):
    e = table(spark, d, "embeddings").select("label", "vec_id", F.transform("embedding", lambda v: v.cast("double")).alias("v"))
    u = SS.unpack_series(e, ["label"], ["vec_id"], "v", F.lit(4000.0), F.lit(0.01))
    return u.select("label", F.col("pixel").cast("bigint").alias("pixel"), rnd("x", 6).alias("x"), rnd("y", 6).alias("y"))


# --- line lists ----------------------------------------------------------------------------

def _lines(spark, d):
    k = F.col("l_suppkey")
    return table(spark, d, "lineitem").select(
        F.format_string("list%d", k % 31).alias("list_id"), k.alias("block_id"), F.format_string("%d.%03d", k % 92 + 1, k % 7).alias("species"),
        (k % 2 + 1).cast("int").alias("ion"), F.format_string("S%d", k).alias("comment"), "l_orderkey", "l_linenumber", "l_partkey",
        F.col("l_extendedprice").alias("wave"), (F.col("l_discount") * 50).alias("chi_low"), (F.col("l_tax") * -20 + 0.0001).alias("log_gf"),
        (F.col("l_quantity") / 4).alias("fdamp"), F.col("l_linenumber").cast("double").alias("g_up"), F.lit(1.0e5).alias("gam_rad"),
        F.lit(0.0).alias("gam_stark"), F.lower("l_returnflag").alias("lev_lo"), F.lower("l_linestatus").alias("lev_up"), F.lit(0.0).alias("eqw"),
        F.lit(1.0).alias("eqw_err"), F.format_string("S%d x", k).alias("descr"), *_level_columns(k % 2 == 0))


def _level_columns(known):
    """Level numbers and names of the blocks in the layout with levels."""
    n = F.col("l_linenumber")
    values = {"ilev_lo": n, "ilev_up": n + 7, "id_lo": F.format_string("z%dD*", n), "id_up": F.lit("none")}
    return [F.when(known, v).alias(c) for c, v in values.items()]


ORDER = ["l_orderkey", "l_linenumber", "l_partkey", "wave"]


def _raw_lines(spark, d):
    rows = LL.render_linelist(_lines(spark, d), ORDER)
    block = (F.col("block_id") * 3 + F.col("kind")) * F.lit(1 << 40) + F.coalesce("l_orderkey", F.lit(0).cast("bigint"))
    return rows.select(F.col("list_id").alias("file"), block.alias("block"), F.struct(*ORDER[1:]).alias("pos"), "value")


LIST_SQL = """b AS (SELECT concat('list', l_suppkey % 31) AS list_id, l_suppkey, dense_rank() OVER (PARTITION BY l_suppkey % 31 ORDER BY l_suppkey) AS block_id,
  row_number() OVER (PARTITION BY l_suppkey ORDER BY l_orderkey, l_linenumber, l_partkey, l_extendedprice) AS line_no, * EXCLUDE (l_suppkey) FROM lineitem)"""


@query("read_linelist", f"""WITH {LIST_SQL} SELECT list_id, block_id, line_no, concat(l_suppkey % 92 + 1, '.', lpad((l_suppkey % 7)::VARCHAR, 3, '0')) AS species,
  (l_suppkey % 92 + 1)::BIGINT AS iel, (l_suppkey % 2 + 1)::INTEGER AS ion, (l_suppkey % 7)::INTEGER AS isotope, concat('S', l_suppkey) AS comment, l_extendedprice AS wave, round(l_discount * 50, 3) AS chi_low,
  round(l_tax * -20 + 0.0001, 3) + 0.0 AS log_gf, round(l_quantity / 4, 3) AS fdamp, l_linenumber::DOUBLE AS g_up, 1e5::DOUBLE AS gam_rad, 0.0::DOUBLE AS gam_stark, lower(l_returnflag) AS lev_lo, lower(l_linestatus) AS lev_up,
  concat('S', l_suppkey, ' x') AS descr, 0.0::DOUBLE AS eqw, 1.0::DOUBLE AS eqw_err, CASE WHEN l_suppkey % 2 = 0 THEN l_linenumber END AS ilev_lo, CASE WHEN l_suppkey % 2 = 0 THEN l_linenumber + 7 END AS ilev_up,
  CASE WHEN l_suppkey % 2 = 0 THEN concat('z', l_linenumber, 'D*') END AS id_lo, CASE WHEN l_suppkey % 2 = 0 THEN 'none' END AS id_up, CASE WHEN l_suppkey % 2 = 0 THEN 'stark_levels' ELSE 'stark' END AS format FROM b""")
def read_linelist(spark, d):
    ll = LL.parse_linelist(_raw_lines(spark, d))
    return ll.select("list_id", "block_id", "line_no", "species", "iel", "ion", F.element_at("isotopes", 1).alias("isotope"), "comment", "wave", "chi_low",
                     (F.col("log_gf") + 0.0).alias("log_gf"), "fdamp", "g_up", "gam_rad", "gam_stark", "lev_lo", "lev_up", "descr", "eqw", "eqw_err", "ilev_lo", "ilev_up", "id_lo", "id_up", "format")


@query("write_linelist", """SELECT concat('list', l_suppkey % 31) AS list_id, l_suppkey AS block_id, 2 AS kind, concat(printf('%10.3f %6.3f ', l_extendedprice, l_discount * 50), lpad(printf('%.3f', l_tax * -20 + 0.0001), 6, ' '),
  printf(' %8.3f %6.1f %9.2E %7.3f ', l_quantity / 4, l_linenumber::DOUBLE, 1e5::DOUBLE, 0.0::DOUBLE), '''', lower(l_returnflag), ''' ''', lower(l_linestatus), ''' ', printf('%5.1f %6.1f ', 0.0::DOUBLE, 1.0::DOUBLE), '''S', l_suppkey, ' x''',
  CASE WHEN l_suppkey % 2 = 0 THEN concat(printf(' %3d %3d ', l_linenumber, l_linenumber + 7), '''z', l_linenumber, 'D*'' ''none'' ''c'' ''x''') ELSE '' END) AS value FROM lineitem
UNION ALL SELECT concat('list', l_suppkey % 31), l_suppkey, 0, concat('''', rpad(concat(l_suppkey % 92 + 1, '.', lpad((l_suppkey % 7)::VARCHAR, 3, '0')), 20, ' '), ''' ', lpad((l_suppkey % 2 + 1)::VARCHAR, 2, ' '), ' ', lpad(count(*)::VARCHAR, 7, ' ')) FROM lineitem GROUP BY l_suppkey
UNION ALL SELECT DISTINCT concat('list', l_suppkey % 31), l_suppkey, 1, concat('''S', l_suppkey, '''') FROM lineitem""")
def write_linelist(spark, d):
    return LL.render_linelist(_lines(spark, d), ORDER).select("list_id", "block_id", "kind", "value")


FORMATS = ["stark_levels", "stark", "levels", "short", "old", "levels"]


@query("detect_format", """SELECT s_suppkey AS block, CASE s_suppkey % 6 WHEN 0 THEN 'stark_levels' WHEN 1 THEN 'stark' WHEN 2 THEN 'levels' WHEN 3 THEN 'short' WHEN 4 THEN 'old' ELSE 'levels' END AS format FROM supplier""")
def detect_format(spark, d):
    k = F.col("s_suppkey")
    start = F.format_string("  4200.087  3.884 -1.130   -7.420    7.0  %8.2E", F.col("s_acctbal"))
    tail, ids = "'p' 'd'   0.0    1.0 'Fe I, x y'", "  82 0  'z3D3*' 'none'  'c' 'x'"
    value = (F.when(k % 6 == 0, F.concat(start, F.lit(f"  0.000  {tail}{ids}"))).when(k % 6 == 1, F.concat(start, F.lit(f"  0.000  {tail}")))
             .when(k % 6 == 2, F.concat(start, F.lit(f" {tail}{ids}"))).when(k % 6 == 3, F.concat(start, F.lit(f" {tail}")))
             .when(k % 6 == 4, start).otherwise(F.concat(start, F.lit(f" {tail}{ids}"))))
    species = F.when(k % 6 == 5, "608.012016").otherwise("26.000")
    rows = F.array(F.format_string("'%s            '    1       1", species), F.lit("'Fe I    NLTE'"), value)
    raw = table(spark, d, "supplier").select(F.lit("f").alias("file"), k.alias("block"), F.posexplode(rows).alias("pos", "value"))
    fmt = LL.detect_format(raw)
    return fmt.select((F.col("block_id") - 1).alias("block"), "format")


@query("read_manifest", """SELECT p_partkey, CASE WHEN p_size % 5 = 1 THEN concat('/abs/', p_name) ELSE concat('/base/', p_name) END AS path FROM part WHERE p_size % 5 <> 0""")
def read_manifest(spark, d):
    size = F.col("p_size") % 5
    value = F.when(size == 0, F.concat(F.lit("# "), "p_name")).when(size == 1, F.concat(F.lit(" /abs/"), "p_name")).otherwise(F.concat("p_name", F.lit("  ")))
    raw = table(spark, d, "part").select(F.lit("m").alias("file"), F.col("p_partkey").alias("block"), F.lit(0).alias("pos"), value.alias("value"))
    return LL.parse_manifest(raw, "/base/").select(F.col("block").alias("p_partkey"), "path")


@query("read_vald3", """SELECT concat('v', l_suppkey % 31) AS file, l_orderkey, l_linenumber, concat('''Fe 1'',  ', printf('%10.4f', l_extendedprice), ', ', l_partkey) AS data, concat('''  LS lo', l_partkey, '''') AS lower,
  concat('''  LS up', l_suppkey, '''') AS upper, '''_  1 wl:K14 Fe''' AS refs FROM lineitem""")
def read_vald3(spark, d):
    four = [F.lit("* a comment row"), F.concat(F.lit("'Fe 1',  "), F.format_string("%10.4f", "l_extendedprice"), F.format_string(", %d", "l_partkey")),
            F.format_string("'  LS lo%d'", "l_partkey"), F.format_string("'  LS up%d'", "l_suppkey"), F.lit("'_  1 wl:K14 Fe'")]
    raw = table(spark, d, "lineitem").select(
        F.format_string("v%d", F.col("l_suppkey") % 31).alias("file"), F.col("l_orderkey").alias("block"), "l_linenumber", "l_partkey", "l_suppkey",
        "l_extendedprice", F.explode(F.array(*[F.lit(i) for i in range(len(four))])).alias("i"))
    raw = raw.select("file", "block", F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "i").alias("pos"), row_text(four).alias("value"),
                     F.col("block").alias("l_orderkey"), "l_linenumber")
    # every record keeps the keys of its own start row
    v = LL.parse_vald3(raw.select("file", "block", "pos", F.concat_ws("|", "value", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("value")))
    part = lambda c, i: F.split(c, r"\|")[i]
    return v.select("file", part("data", 1).cast("bigint").alias("l_orderkey"), part("data", 2).cast("int").alias("l_linenumber"),
                    *[part(c, 0).alias(c) for c in ("data", "lower", "upper", "refs")])


@query("read_hydrogen_lines", """SELECT l_suppkey AS list_id, count(*) AS n, round(sum(round(l_extendedprice, 3)), 2) AS wave_sum, sum(l_linenumber)::BIGINT AS n_lo_sum, sum(l_linenumber + 3)::BIGINT AS n_up_sum FROM lineitem WHERE l_suppkey % 2 = 0 GROUP BY 1""")
def read_hydrogen_lines(spark, d):
    li = table(spark, d, "lineitem")
    n = li.groupBy("l_suppkey").agg(F.count(F.lit(1)).alias("n"))
    code = F.when(F.col("l_suppkey") % 2 == 0, "01.000000").otherwise("26.000")
    head = n.select("l_suppkey", F.explode(F.array(
        F.struct(F.lit(-2).cast("bigint").alias("block"), F.format_string("'%s                 '    1   %d", code, "n").alias("value")),
        F.struct(F.lit(-1).cast("bigint").alias("block"), F.lit("'H I lam nblo nbup'").alias("value")))).alias("r")) \
        .select("l_suppkey", "r.block", F.struct(F.lit(0).alias("a"), F.lit(0).cast("bigint").alias("b"), F.lit(0.0).alias("c")).alias("pos"), "r.value")
    body = li.select("l_suppkey", F.col("l_orderkey").alias("block"), F.struct(F.col("l_linenumber").alias("a"), F.col("l_partkey").alias("b"), F.col("l_extendedprice").alias("c")).alias("pos"),
                     F.format_string("%10.3f %d %d 0.000 13.462 -2.493 'Ly 10    ' 6.31E+08", "l_extendedprice", "l_linenumber", F.col("l_linenumber") + 3).alias("value"))
    raw = head.unionByName(body).select(F.col("l_suppkey").alias("file"), "block", "pos", "value")
    h = LL.parse_hlines(raw)
    return h.groupBy("list_id").agg(F.count(F.lit(1)).alias("n"), rnd(F.sum("wave"), 2).alias("wave_sum"), F.sum("n_lo").alias("n_lo_sum"), F.sum("n_up").alias("n_up_sum"))


# --- models --------------------------------------------------------------------------------
# one file per embedding with a depth for every four of its 64 values; v(k, j) is its value 4k+j

def _values(spark, d, n=16):
    e = table(spark, d, "embeddings").select(F.col("vec_id").alias("file"), F.transform("embedding", lambda v: v.cast("double")).alias("e"))
    depth = F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda k: F.struct(
        k.alias("k"), (3500 + 250 * k + 100 * F.get("e", 4 * k)).alias("t"), (1 + 0.1 * k + 0.2 * F.get("e", 4 * k + 1)).alias("a"),
        (3 + 0.2 * k + 0.5 * F.get("e", 4 * k + 2)).alias("b"), (F.lit(2.0) + F.get("e", 4 * k + 3)).alias("c")))
    return e.withColumn("z", depth)


VALUES_SQL = """v AS (SELECT vec_id AS file, k, 3500 + 250 * k + 100 * embedding[4 * k + 1]::DOUBLE AS t, 1 + 0.1::DOUBLE * k + 0.2 * embedding[4 * k + 2]::DOUBLE AS a,
  3 + 0.2::DOUBLE * k + 0.5 * embedding[4 * k + 3]::DOUBLE AS b, 2.0::DOUBLE + embedding[4 * k + 4]::DOUBLE AS c FROM embeddings, (SELECT unnest(range(16)) AS k))"""


def _text(spark, d, head, row, mid=None, row2=None, tail=None):
    """(file, text): literal head rows, one formatted row per depth, and optionally a second block."""
    z = _values(spark, d)
    parts = [F.array(*[h if not isinstance(h, str) else F.lit(h) for h in head]), F.transform("z", row)]
    if row2 is not None:
        parts += [F.array(F.lit(mid)), F.transform("z", row2)]
    return z.select("file", F.array_join(F.concat(*parts), "\n").alias("text"))


def _depths(packed, *cols):
    _, rows = M.split_models(packed)
    return rows.select("file", "k", *cols)


@query("read_marcs", f"""WITH {VALUES_SQL} SELECT file, (k + 1)::INTEGER AS k, 'sph' AS geometry, 5777.0::DOUBLE AS teff, round(log10(27542.0), 6) AS logg, -0.25::DOUBLE AS feh, round(t, 2) AS temp, round(a, 4) AS log_tau5000,
  round(log10(round(b, 4)), 6) AS log_pe, round(log10(round(b * 100, 3)), 6) AS log_pg, 1.5::DOUBLE AS xi, round(7e10 - round(c * 1e5, 1), 1) AS radius, round(log10(round(c, 4)), 6) AS log_kappa FROM v""")
def read_marcs(spark, d):
    head = ["s5777_g+4.4_m1.0", "  5777.      Teff [K].", "  9.4E+10 Flux", "  2.7542E+04 Surface gravity", "  1.5   Microturbulence", "  1.0 Mass",
            " -0.25  0.00 Metallicity", "  7.0E+10 Radius [cm]", "  16 Number of depth points", "Model structure", " k lgTauR  lgTau5    Depth     T        Pe          Pg"]
    row = lambda z: F.format_string("%3d %8.4f %8.4f %.1f %9.2f %.4f %.3f 0.0 0.0", z["k"] + 1, z["b"], z["a"], z["c"] * 1e5, z["t"], z["b"], z["b"] * 100)
    row2 = lambda z: F.format_string("%3d %8.4f %.4f %.4E 1.3 0.0 0.0", z["k"] + 1, z["b"], z["c"], z["a"])
    packed = M.parse_marcs(_text(spark, d, head, row, " k lgTauR    KappaRoss   Density   Mu", row2))
    models, rows = M.split_models(packed)
    return rows.join(models, "file").select("file", "k", "geometry", "teff", rnd("logg", 6).alias("logg"), "feh", "temp", "log_tau5000", rnd("log_pe", 6).alias("log_pe"),
                                            rnd("log_pg", 6).alias("log_pg"), "xi", rnd("radius", 1).alias("radius"), rnd("log_kappa", 6).alias("log_kappa"))


def _packed_model(spark, d):
    z = _values(spark, d)
    col = lambda fn: F.transform("z", fn)
    sph = F.col("file") % 2 == 0
    return z.select("file", F.when(sph, "sph").otherwise("pp").alias("geometry"), F.lit(4.44).alias("logg"), F.lit(5000.0).alias("xls"), F.lit("x").alias("code"),
                    col(lambda r: r["a"] - 3).alias("log_tau5000"), col(lambda r: r["t"]).alias("temp"), col(lambda r: r["a"]).alias("log_pe"), col(lambda r: r["b"]).alias("log_pg"),
                    col(lambda r: r["c"]).alias("xi"), col(lambda r: r["c"] * 1e10).alias("radius"), col(lambda r: r["a"] - 2.5).alias("log_tau_ross"), col(lambda r: r["b"] * r["c"]).alias("rhox"))


@query("read_tau_model", f"""WITH {VALUES_SQL} SELECT file, (k + 1)::INTEGER AS k, CASE WHEN file % 2 = 0 THEN 'sph' ELSE 'pp' END AS geometry, round(a - 3, 4) + 0.0 AS log_tau5000, round(t, 2) AS temp, round(a, 4) AS log_pe, round(b, 4) AS log_pg,
  round(c, 4) AS xi, round(a - 2.5, 4) + 0.0 AS log_tau_ross FROM v""")
def read_tau_model(spark, d):
    models, rows = M.split_models(M.parse_tau_model(M.render_tau_model(_packed_model(spark, d))))
    return rows.join(models, "file").select("file", "k", "geometry", (F.col("log_tau5000") + 0.0).alias("log_tau5000"), "temp", "log_pe", "log_pg", "xi", (F.col("log_tau_ross") + 0.0).alias("log_tau_ross"))


@query("write_tau_model", f"""WITH {VALUES_SQL}, r AS (SELECT file, k + 1 AS k, printf('%8.4f %8.2f %8.4f %8.4f %8.4f %15.6E %8.4f', a - 3, t, a, b, c, c * 1e10, a - 2.5) AS value FROM v)
SELECT file, k::INTEGER AS k, value FROM r UNION ALL SELECT vec_id, 0, concat('''', CASE WHEN vec_id % 2 = 0 THEN 'sph' ELSE 'pp' END, 'INTERPOL''  16   5000.  4.44 0 0.00') FROM embeddings""")
def write_tau_model(spark, d):
    return M.render_tau_model(_packed_model(spark, d)).select("file", F.posexplode(F.split("text", "\n")).alias("k", "value"))


@query("write_tau_listing", f"""WITH {VALUES_SQL}, r AS (SELECT file, k + 2 AS k, printf('%5d %8.4f %8.2f %8.4f %8.4f %15.6E', k + 1, a - 3, t, a, b, b * c) AS value FROM v)
SELECT file, k::INTEGER AS k, value FROM r UNION ALL SELECT vec_id, 1, '    k    log(tau)  T    log(Pe)   log(Pg)    rhox' FROM embeddings
UNION ALL SELECT vec_id, 0, concat(CASE WHEN vec_id % 2 = 0 THEN 'sph' ELSE 'pp' END, 'INTERPOL  16   5000.') FROM embeddings""")
def write_tau_listing(spark, d):
    return M.render_tau_listing(_packed_model(spark, d)).select("file", F.posexplode(F.split("text", "\n")).alias("k", "value"))


@query("write_atmos_dscale", f"""WITH {VALUES_SQL} SELECT file, (k + 2)::INTEGER AS k, printf('%11.7f %9.2f %12.5E %9.5f %9.5f', a - 3, t, pow(10, a) / t / 1.38064852e-16, 0.0::DOUBLE, c) AS value FROM v
UNION ALL SELECT vec_id, 0, '4.44' FROM embeddings UNION ALL SELECT vec_id, 1, '16' FROM embeddings""")
def write_atmos_dscale(spark, d):
    return M.render_multi(_packed_model(spark, d)).select("file", F.posexplode(F.split("text", "\n")).alias("k", "value"))


@query("read_kurucz", f"""WITH {VALUES_SQL} SELECT file, (k + 1)::INTEGER AS k, round(t, 1) AS temp, round(c, 5) AS rhox, round(log10(round(b * 1e12, 0) * round(t, 1) * 1.38065e-16), 6) AS log_pe, round(log10(round(b, 4)), 6) AS log_pg FROM v""")
def read_kurucz(spark, d):
    head = ["TEFF   5777.  GRAVITY 4.44000 LTE", "TITLE [0.0]", "READ DECK6 16 RHOX,T,P,XNE,ABROSS"]
    row = lambda z: F.format_string("%.5f %9.1f %.4f %.0f %.4E 0.0", z["c"], z["t"], z["b"], z["b"] * 1e12, z["a"])
    return _depths(M.parse_kurucz(_text(spark, d, head, row)), "temp", "rhox", rnd("log_pe", 6).alias("log_pe"), rnd("log_pg", 6).alias("log_pg"))


@query("read_multi", f"""WITH {VALUES_SQL} SELECT file, (k + 1)::INTEGER AS k, round(a, 4) AS log_tau5000, round(t, 1) AS temp, round(log10(round(b * 1e12, 0) * round(t, 1) * 1.38065e-16), 6) AS log_pe, round(round(c, 3) * 1e5, 2) AS velocity, round(c, 3) AS xi FROM v""")
def read_multi(spark, d):
    head = ["sun model", "* a comment", "  TAU (5000)", "* log g", "4.44", "* NDEP", "16", "* lg tau  T  ne v vturb"]
    row = lambda z: F.format_string("%8.4f %9.1f %.0f %.3f %.3f", z["a"], z["t"], z["b"] * 1e12, z["c"], z["c"])
    return _depths(M.parse_multi(_text(spark, d, head, row)), "log_tau5000", "temp", rnd("log_pe", 6).alias("log_pe"), rnd("velocity", 2).alias("velocity"), "xi")


@query("read_stagger", f"""WITH {VALUES_SQL} SELECT file, (k + 1)::INTEGER AS k, 5768.0::DOUBLE AS teff, round(t, 1) AS temp, round(b, 3) AS radius, round(log10(round(c, 4) * 1.38065e-16 * round(t, 1) / 1.3 / 1.660e-24), 6) AS log_pg FROM v""")
def read_stagger(spark, d):
    row = lambda z: F.format_string("%.3f %9.1f %.4f", z["b"], z["t"], z["c"])
    models, rows = M.split_models(M.parse_stagger(_text(spark, d, ["'Stagger'  16  5000. 4.43770 0 0.0", "  5768.00  4.43770 0.00000 16"], row)))
    return rows.join(models, "file").select("file", "k", "teff", "temp", "radius", rnd("log_pg", 6).alias("log_pg"))


@query("read_hoefner", f"""WITH {VALUES_SQL} SELECT file, (k + 1)::INTEGER AS k, round(t, 1) AS temp, round(a, 4) AS radius, round(log10(round(b, 4)), 6) AS log_pg, round(c, 4) AS rho, 5e5::DOUBLE AS velocity FROM v""")
def read_hoefner(spark, d):
    row = lambda z: F.format_string("%.4f %.4f %9.1f %.4f 0 0 0 0 1.0 0", z["a"], z["c"], z["t"], z["b"])
    return _depths(M.parse_hoefner(_text(spark, d, ["'Hoefner' 16 5000. 0.5 0 0.0", "# r rho T", "# cm"], row)), "temp", "radius", rnd("log_pg", 6).alias("log_pg"), "rho", "velocity")


@query("read_bowe", f"""WITH {VALUES_SQL}, r AS (SELECT *, round(c, 4) * 1.38e-16 * round(t, 1) / 1.26 / 1.67e-24 AS pg FROM v)
SELECT file, (16 - k)::INTEGER AS k, round(t, 1) AS temp, round(a, 4) AS radius, round(log10(pg), 6) AS log_pg, round(log10(round(b, 4) * 0.908 * pg), 6) AS log_pe FROM r""")
def read_bowe(spark, d):
    head = ["'bowe' 16 5000. 0.5 0 0.0"] + [f"header {i}" for i in range(12)]
    row = lambda z: F.format_string("%d %.4f 0.1 %9.1f %.4f 2.0 %.4f", z["k"], z["a"], z["t"], z["c"], z["b"])
    return _depths(M.parse_bowe(_text(spark, d, head, row)), "temp", "radius", rnd("log_pg", 6).alias("log_pg"), rnd("log_pe", 6).alias("log_pe"))


@query("read_alva", f"""WITH {VALUES_SQL} SELECT file, (k + 1)::INTEGER AS k, round(t - 2500, 1) AS temp, round(log10(round(b, 4)), 6) AS log_pg, round(c, 4) AS radius, round(a, 3) AS xi,
  round(CASE WHEN round(t - 2500, 1) < 2000 THEN log10(1e-4 * round(b, 4) * pow(round(t - 2500, 1) / 3000, 30)) ELSE -4 END, 5) AS log_pe FROM v""")
def read_alva(spark, d):
    row = lambda z: F.format_string("%9.1f %.4f %.4f %.3f", z["t"] - 2500, z["b"], z["c"], z["a"])
    return _depths(M.parse_alva(_text(spark, d, ["'alva' 16 5000. 0.5 0 0.0"], row)), "temp", rnd("log_pg", 6).alias("log_pg"), "radius", "xi", rnd("log_pe", 5).alias("log_pe"))


@query("model_kind", """SELECT vec_id AS file, CASE WHEN label % 2 = 0 THEN 'interpolated' ELSE 'marcs' END AS kind FROM embeddings""")
def model_kind(spark, d):
    first = F.when(F.col("label") % 2 == 0, "'ppINTERPOL'  56   5000. 4.44 0 0.00").otherwise("p5777_g+4.4")
    e = table(spark, d, "embeddings").select(F.col("vec_id").alias("file"), F.concat(first, F.lit("\nINTERPOL later rows do not count\n")).alias("text"))
    return e.select("file", M.model_kind(F.col("text")).alias("kind"))


@query("scan_model_catalog", """SELECT p_partkey, p_size * 100 AS teff, p_size / 10.0::DOUBLE AS logg, lpad((p_partkey % 7)::VARCHAR, 2, '0') AS turb FROM part WHERE p_partkey % 4 <> 0""")
def scan_model_catalog(spark, d):
    from specspark.queries.grids import _named
    k = F.col("p_partkey")
    name = F.when(k % 4 == 0, "notes.mod").otherwise(F.col("name"))
    paths = _named(spark, d).select("p_partkey", F.format_string("file:/m/%d/%s", k, name).alias("path"))
    return paths.join(M.parse_catalog(paths), "path").select("p_partkey", "teff", "logg", "turb")


# --- departure coefficients, atoms, flags ----------------------------------------------------

DEP_SQL = """dv AS (SELECT vec_id AS file, k, embedding[k + 1]::DOUBLE * 10 - 2 AS lt, [1.2::DOUBLE + 0.3 * embedding[16 + 3 * k + 1]::DOUBLE, 1.2::DOUBLE + 0.3 * embedding[16 + 3 * k + 2]::DOUBLE, 1.2::DOUBLE + 0.3 * embedding[16 + 3 * k + 3]::DOUBLE] AS b
  FROM embeddings, (SELECT unnest(range(16)) AS k))"""


def _departures(spark, d):
    e = table(spark, d, "embeddings").select(F.col("vec_id").alias("file"), F.transform("embedding", lambda v: v.cast("double")).alias("e"))
    power = F.array(*[F.struct(F.lit(n).alias("name"), F.lit(1.0).alias("x"), F.lit(0.95).alias("y"), F.lit(1.0).alias("z"))
                      for n in ("tau5000", "tauross", "T", "logPe", "logPg", "xit", "rr", "logkappa")])
    return e.select("file", F.lit(7.5).alias("a_log"), F.transform(F.slice("e", 1, 16), lambda v: v * 10 - 2).alias("log_tau"), F.transform(
        F.sequence(F.lit(0), F.lit(15)), lambda k: F.transform(F.sequence(F.lit(0), F.lit(2)), lambda j: 1.2 + 0.3 * F.get("e", 16 + 3 * k + j))).alias("b"), power.alias("powers"))


@query("read_departures", f"""WITH {DEP_SQL}, l AS (SELECT file, k, lt, unnest([1, 2, 3]) AS level, unnest(b) AS b FROM dv UNION ALL SELECT file, k, lt, 0, 1.0 FROM dv)
SELECT file, (k + 1)::INTEGER AS k, round(pow(10, round(lt, 4)), 6) AS tau, level, CASE WHEN level = 0 THEN 1.0 WHEN b < 0.9999995 THEN round(b, 6) ELSE round(b, 5) END AS b FROM l""")
def read_departures(spark, d):
    p = T.parse_departures(T.render_departures(_departures(spark, d)))
    return p.select("file", "k", rnd("tau", 6).alias("tau"), "level", "b")


@query("read_departures_2", f"""WITH {DEP_SQL}, l AS (SELECT file, k, lt, unnest([1, 2, 3]) AS level, unnest(b) AS b FROM dv UNION ALL SELECT file, k, lt, 0, 1.0 FROM dv)
SELECT file, (k + 1)::INTEGER AS k, round(pow(10, round(lt, 4)), 6) AS tau, level, CASE WHEN level = 0 THEN 1.0 ELSE round(b, 5) END AS b FROM l""")
def read_departures_csv(spark, d):
    dep = _departures(spark, d)
    rows = F.zip_with("log_tau", "b", lambda t, b: F.concat(F.format_string("%.4f, ", t), F.array_join(F.transform(b, lambda v: F.format_string("%.5f", v)), ", ")))
    raw = dep.select("file", F.array_join(F.concat(F.array(F.lit("! comment"), F.lit("! tau, b")), rows), "\n").alias("text"))
    p = T.parse_departures_csv(raw)
    return p.select("file", "k", rnd("tau", 6).alias("tau"), "level", "b")


@query("write_departures", f"""WITH {DEP_SQL} SELECT file, (k + 11)::INTEGER AS pos, printf('%8.4f ', lt) AS value FROM dv
UNION ALL SELECT vec_id, i::INTEGER, concat('# ', lpad(['tau5000', 'tauross', 'T', 'logPe', 'logPg', 'xit', 'rr', 'logkappa'][i + 1], 15, ' '), '   1.000000   0.950000   1.000000') FROM embeddings, (SELECT unnest(range(8)) AS i)
UNION ALL SELECT vec_id, i, v FROM embeddings, (SELECT unnest([8, 9, 10]) AS i, unnest(['  7.500000 ', ' 16 ', '   3 ']) AS v)
UNION ALL SELECT file, (k + 27)::INTEGER, concat(printf('%12.5E', b[1]), ' ', printf('%12.5E', b[2]), ' ', printf('%12.5E', b[3]), ' ') FROM dv""")
def write_departures(spark, d):
    return T.render_departures(_departures(spark, d)).select("file", F.posexplode(F.split("text", "\n")).alias("pos", "value"))


@query("read_departure_catalog", """SELECT p_partkey AS file, i::INTEGER AS cat_pos, concat('m', p_partkey, '_', i) AS model_id, 5000.0::DOUBLE + p_size AS teff, 4.5::DOUBLE AS logg, p_size / 10.0::DOUBLE AS abundance, (p_partkey * 1000 + i)::BIGINT AS byte_pos
FROM part, (SELECT unnest([1, 2]) AS i)""")
def read_dep_catalog(spark, d):
    row = lambda i: F.format_string("'m%d_%d' %d. 4.50 -0.5 0.2 1.0 2.0 %.1f %d", "p_partkey", F.lit(i), 5000 + F.col("p_size"), F.col("p_size") / F.lit(10.0), F.col("p_partkey") * 1000 + i)
    raw = table(spark, d, "part").select(F.col("p_partkey").alias("file"), F.array_join(F.array(F.lit("# id teff"), row(1), F.lit("#"), row(2)), "\n").alias("text"))
    return T.parse_dep_catalog(raw).select("file", "cat_pos", "model_id", "teff", "logg", "abundance", "byte_pos")


@query("read_model_atom", """SELECT p_partkey AS file, 'Fe' AS species, i::INTEGER AS level, (p_size * 100 * i)::DOUBLE AS e, (2 * i + 1)::DOUBLE AS g, concat('lev ', i) AS id, (i % 2 + 1)::INTEGER AS ion FROM part, (SELECT unnest(range(1, 5)) AS i)""")
def read_model_atom(spark, d):
    level = lambda i: F.format_string("%d.0 %d.0 'lev %d' %d", F.col("p_size") * 100 * i, F.lit(2 * i + 1), F.lit(i), F.lit(i % 2 + 1))
    rows = F.array(F.lit("* atom"), F.lit(" Fe"), F.lit("* abund mass"), F.lit("  7.50  55.85"), F.lit("*"), F.lit(" 4 0 0 0"), F.lit("* E g"), level(1), level(2), F.lit("* more"), level(3), level(4), F.lit("9 9 'x' 9"))
    raw = table(spark, d, "part").select(F.col("p_partkey").alias("file"), F.array_join(rows, "\n").alias("text"))
    return T.parse_model_atom(raw).select("file", "species", "level", "e", "g", "id", "ion")


@query("read_species_flags", """SELECT s_suppkey AS file, z, CASE WHEN z = 26 THEN s_suppkey % 2 = 0 ELSE false END AS nlte, CASE WHEN z = 26 THEN '/atoms/atom.fe' END AS atom_file, z = 26 AS "binary",
  CASE WHEN z = 20 AND s_suppkey % 5 = 0 THEN 'bad' END AS problem FROM supplier, (SELECT unnest([20, 26]) AS z)""")
def read_species_flags(spark, d):
    k = F.col("s_suppkey")
    rows = F.array(F.lit("# This file"), F.lit("# path for model atom files     ! keep !"), F.lit("/atoms/"), F.lit("#"), F.lit("# path for departure files      ! keep !"), F.lit("/deps/"), F.lit("# setup"),
                   F.format_string("20 'Ca' '%s' '' 'x' 'ascii'", F.when(k % 5 == 0, "bad").otherwise("lte")), F.format_string("26\t'Fe'\t'%s' 'atom.fe' 'dep.bin' 'bin'", F.when(k % 2 == 0, "nlte").otherwise("lte")))
    raw = table(spark, d, "supplier").select(k.alias("file"), F.array_join(rows, "\n").alias("text"))
    return T.parse_species_flags(raw).select("file", "z", "nlte", "atom_file", "binary", "problem")


# --- small tables ------------------------------------------------------------------------------

def _part_text(spark, d, *rows):
    # texts far larger than the rows they are made of: more tasks than the small file has splits
    return table(spark, d, "part").repartition(spark.sparkContext.defaultParallelism, "p_partkey").select(F.col("p_partkey").alias("file"), F.array_join(F.array(*[F.lit(r) if isinstance(r, str) else r for r in rows]), "\n").alias("text"))


@query("read_segments", """SELECT p_partkey AS file, i::INTEGER AS seg_id, 4800.0::DOUBLE + p_size * i AS wmin, 4810.0::DOUBLE + p_size * i AS wmax FROM part, (SELECT unnest([1, 2, 3]) AS i)""")
def read_segments(spark, d):
    row = lambda i: F.format_string("      %.1f       %.2f", 4800.0 + F.col("p_size") * i, 4810.0 + F.col("p_size") * i)
    return T.parse_segments(_part_text(spark, d, "; synthesis segments", "; more", row(1), row(2), row(3)))


@query("read_mu_points", """SELECT p_partkey AS file, i::INTEGER AS i, p_size * i / 1000.0::DOUBLE AS mu FROM part, (SELECT unnest([1, 2, 3]) AS i)""")
def read_mu_points(spark, d):
    mu = lambda i: F.format_string("%.3f", F.col("p_size") * i / F.lit(1000.0))
    return T.parse_mu(_part_text(spark, d, "3", F.concat(mu(1), F.lit(", "), mu(2), F.lit("  "), mu(3), F.lit(", 9.9"))))


@query("read_filter_curve", """SELECT p_partkey AS file, 'band' AS title, 4000.0::DOUBLE + i * 10 AS wave, p_size / 100.0::DOUBLE AS trans FROM part, (SELECT unnest([1, 2]) AS i) WHERE p_size % 2 = 0
UNION ALL SELECT p_partkey, 'too few rows', NULL, NULL FROM part WHERE p_size % 2 = 1""")
def read_filter_curve(spark, d):
    row = lambda i: F.format_string(" %.1f  %.2f", F.lit(4000.0 + i * 10), F.col("p_size") / F.lit(100.0))
    raw = _part_text(spark, d, "band", row(1), F.when(F.col("p_size") % 2 == 0, row(2)).otherwise("end of file"))
    curve, short = T.parse_filter(raw)
    return curve.unionByName(short.select("file", F.lit("too few rows").alias("title"), F.lit(None).cast("double").alias("wave"), F.lit(None).cast("double").alias("trans")))


@query("read_isotope_masses", """SELECT p_partkey AS file, z::INTEGER AS z, a::INTEGER AS a, CASE a WHEN 1 THEN 1.00782503 ELSE z * 2.0141 + p_size / 1000.0 END::DOUBLE AS mass, CASE WHEN a <> 9 THEN p_size / 100.0 END::DOUBLE AS frac, CASE WHEN a = 1 THEN 1.00794 END::DOUBLE AS mix
FROM part, (SELECT unnest([1, 1, 12]) AS z, unnest([1, 2, 9]) AS a)""")
def read_isotope_masses(spark, d):
    size = F.col("p_size")
    value = lambda z: F.format_string("%.4f(10)#", z * 2.0141 + size / F.lit(1000.0))
    raw = _part_text(spark, d, "Isotopes", "header", "_" * 40, F.concat(F.lit("  1 H    1 1.00782503(4)#  "), F.format_string("%.2f(5)", size / F.lit(100.0)), F.lit(" 1.00794(7)")),
                     F.concat(F.lit("    D    2 "), value(1), F.lit("  "), F.format_string("%.2f(5)", size / F.lit(100.0))), "_" * 40, F.concat(F.lit(" 12 Mg   9 "), value(12)), "_" * 40)
    p = T.parse_isotopes(raw)
    return p.select("file", "z", "a", rnd("mass", 8).alias("mass"), "frac", "mix")


@query("read_partition_coeffs", """SELECT p_partkey AS file, s::INTEGER AS z, st::INTEGER AS stage, 7.5::DOUBLE + p_size AS ipot, round(p_size * 0.1 + 0.02, 4)::DOUBLE AS c2 FROM part, (SELECT unnest([26, 26, 92]) AS s, unnest([1, 2, 3]) AS st)""")
def read_partition_coeffs(spark, d):
    row = lambda spec: F.format_string("1 %s 'X I ' %.1f 6 1.0D0 2.0 %.4f 0.1 0.2 0.3", F.lit(spec), 7.5 + F.col("p_size"), F.col("p_size") * 0.1 + 0.02)
    p = T.parse_partition_atoms(_part_text(spark, d, "# Irwin", row("26.00"), row("26.01"), row("92.02"), row("92.04")))
    return p.select("file", "z", "stage", "ipot", F.col("coef")[2].alias("c2"))


@query("read_partition_coeffs_2", """SELECT p_partkey AS file, 'CO' AS name, 608.0::DOUBLE AS code, 11.1::DOUBLE AS d0, p_size / 10.0::DOUBLE AS last, 2 AS n_parts, 8 AS last_z FROM part""")
def read_partition_molecules(spark, d):
    p = T.parse_partition_molecules(_part_text(spark, d, "* molecules", F.format_string("1 608.0 'CO  ' 11.1 3 1.0 2.0 %.1f 2 6 1 8 1", F.col("p_size") / F.lit(10.0))))
    return p.select("file", "name", "code", "d0", F.element_at("coef", -1).alias("last"), F.size("parts").alias("n_parts"), F.element_at("parts", -1)["z"].alias("last_z"))


@query("read_energy_levels", """SELECT p_partkey AS file, i * p_size + 0.25::DOUBLE AS e, (2 * i)::DOUBLE AS g FROM part, (SELECT unnest([1, 2, 3]) AS i)""")
def read_energy_levels(spark, d):
    row = lambda i: F.format_string("  %.6f  %d.", F.col("p_size") * i + 0.25, F.lit(2 * i))
    return T.parse_levels(_part_text(spark, d, "table.dat", row(1), row(2), row(3)))


@query("read_energy_levels_2", """SELECT p_partkey AS file, p_size * 1.5::DOUBLE AS e, (CASE WHEN i <= 2 THEN 1 ELSE 3 END * (2 * p_size + 1))::DOUBLE AS g FROM part, (SELECT unnest([1, 2, 3, 4]) AS i)""")
def read_energy_levels_quantum(spark, d):
    row = lambda i: F.format_string("%d %d %d 1 %.2f", F.lit(i), "p_size", F.lit(i), F.col("p_size") * 1.5)
    return T.parse_levels(_part_text(spark, d, row(1), row(2), row(3), row(4)), quantum=True)


@query("read_grid_table", """SELECT p_partkey AS file, i * 10.0::DOUBLE AS x, t::DOUBLE AS t, p_size * i + t / 1000.0::DOUBLE AS v FROM part, (SELECT unnest([1, 2, 3]) AS i), (SELECT unnest([1000, 1500, 2000]) AS t)""")
def read_grid_table(spark, d):
    row = lambda i: F.format_string(" %.2f %.2E %.3f %.3f", F.lit(i * 10.0), F.col("p_size") * i + 1.0, F.col("p_size") * i + 1.5, F.col("p_size") * i + 2.0)
    raw = _part_text(spark, d, "'H2H ' Data fetched", "67   Ref", "            1000.  1500.   2000. ", " (cm^-1)    1000K  1500K  2000K /BE", "=====", row(1), row(2), row(3))
    return T.parse_table2d(raw.withColumn("text", F.replace("text", F.lit("E+0"), F.lit("D+0")))).withColumn("v", rnd("v", 3))


# --- continuous opacity --------------------------------------------------------------------------

CONT_SQL = """co AS (SELECT vec_id AS file, k, w, 1.5::DOUBLE + embedding[k * 16 + w + 1]::DOUBLE AS kappa, 2.5::DOUBLE + embedding[k * 16 + w + 2]::DOUBLE AS sigma FROM embeddings, (SELECT unnest(range(4)) AS k), (SELECT unnest(range(15)) AS w))"""


def _opacity_tables(spark, d):
    e = table(spark, d, "embeddings").select(F.col("vec_id").alias("file"), F.transform("embedding", lambda v: v.cast("double")).alias("e"))
    waves = F.array(*[F.lit(4000.0 + 100 * w) for w in range(15)])
    point = lambda k, base, shift: F.transform(F.sequence(F.lit(0), F.lit(14)), lambda w: base + F.get("e", k * 16 + w + shift))
    depths = F.transform(F.sequence(F.lit(0), F.lit(3)), lambda k: F.struct(
        F.array(*[k * 10.0 + i + 0.5 for i in range(8)]).alias("scalars"), point(k, 1.5, 0).alias("kappa"), point(k, 2.5, 1).alias("sigma")))
    return e.select("file", F.lit("sun").alias("code"), F.lit(5000.0).alias("xls"), waves.alias("waves"), depths.alias("depths"))


@query("read_cont_opacity", f"""WITH {CONT_SQL} SELECT file, (k + 1)::INTEGER AS k, 4000.0::DOUBLE + 100 * w AS wave, 10.0::DOUBLE * k + 2.5 AS temp, CASE WHEN kappa < 0.99995 THEN round(kappa, 5) ELSE round(kappa, 4) END AS kappa, round(sigma, 4) AS sigma FROM co""")
def read_cont_opacity(spark, d):
    depths, points = T.parse_cont_opacity(T.render_cont_opacity(_opacity_tables(spark, d)))
    return points.join(depths.select("file", "k", "temp"), ["file", "k"]).select("file", "k", "wave", "temp", "kappa", "sigma")


@query("write_cont_opacity", f"""WITH {CONT_SQL}, p AS (SELECT file, k, w, printf('%11.4E%11.4E', kappa, sigma) AS cell FROM co)
SELECT file, (4 + k * 6 + 1 + w // 3)::INTEGER AS pos, concat(' ', string_agg(cell, '' ORDER BY w)) AS value FROM p GROUP BY file, k, w // 3
UNION ALL SELECT vec_id, 0, ' ''sun''    4   5000.00' FROM embeddings UNION ALL SELECT vec_id, 1, '    15' FROM embeddings
UNION ALL SELECT vec_id, (2 + w // 10)::INTEGER, concat(' ', string_agg(printf('%11.3f', 4000.0::DOUBLE + 100 * w), '' ORDER BY w)) FROM embeddings, (SELECT unnest(range(15)) AS w) GROUP BY vec_id, w // 10
UNION ALL SELECT vec_id, (4 + k * 6)::INTEGER, concat(' ', string_agg(printf('%14.7E', k * 10.0::DOUBLE + i + 0.5), '' ORDER BY i)) FROM embeddings, (SELECT unnest(range(4)) AS k), (SELECT unnest(range(8)) AS i) GROUP BY vec_id, k""")
def write_cont_opacity(spark, d):
    return T.render_cont_opacity(_opacity_tables(spark, d)).select("file", F.posexplode(F.split("text", "\n")).alias("pos", "value"))


# --- grid tables -----------------------------------------------------------------------------------

@query("read_grid_csv", """SELECT trunc(l_extendedprice)::INTEGER AS teff, l_quantity AS logg, l_discount AS feh, lpad(l_linenumber::VARCHAR, 2, '0') AS turb FROM lineitem WHERE l_returnflag <> 'A'
UNION ALL SELECT NULL, NULL, NULL, concat('rejected ', count(*)) FROM lineitem WHERE l_returnflag = 'A'""")
def read_grid_csv(spark, d):
    text = table(spark, d, "lineitem").select(
        F.col("l_extendedprice").cast("string").alias("Teff"), F.when(F.col("l_returnflag") == "A", "n/a").otherwise(F.col("l_quantity").cast("string")).alias("logg"),
        F.col("l_discount").cast("string").alias("FE_H"), F.col("l_linenumber").cast("string").alias("t_value"), F.lit("x").alias("other"))
    points, rejects = T.parse_grid(text)
    none = lambda t: F.lit(None).cast(t)
    n = rejects.agg(F.format_string("rejected %d", F.count(F.lit(1))).alias("turb")).select(
        none("int").alias("teff"), none("double").alias("logg"), none("double").alias("feh"), "turb")
    return points.unionByName(n)


@query("write_grid_csv", """SELECT 'v1' AS grid_version, (p_size * 100)::INTEGER AS teff, round(p_size / 10.0::DOUBLE, 2) AS logg, 0.0::DOUBLE AS feh, 6000.0::DOUBLE AS lam_min, 6100.0::DOUBLE AS lam_max,
 0.01::DOUBLE AS lam_step, '01' AS turbvel, '01' AS t_value, printf('%+.2f', (p_partkey % 9) / 10.0::DOUBLE) AS a, '+0.00' AS c, '+0.00' AS n, '+0.00' AS o, '+0.00' AS r, '+0.00' AS s,
 'Flux' AS output_mode, '1D' AS mode, 'LTE' AS calculation_mode FROM part""")
def write_grid_csv(spark, d):
    """The grid written as CSV and read again."""
    from specspark.operators.grid import format_grid
    g = table(spark, d, "part").select((F.col("p_size") * 100).alias("teff"), (F.col("p_size") / F.lit(10.0)).alias("logg"), F.lit(0.0).alias("feh"), F.lit("01").alias("t_value"),
                                       ((F.col("p_partkey") % 9) / F.lit(10.0)).alias("a"))
    folder = f"{new_folder(spark)}/grid"
    out = format_grid(g, {"grid_version": "v1"}).select(*T.GRID_COLUMNS)
    T.write_grid(out, folder)
    return spark.read.schema(out.schema).option("header", True).csv(folder)


@query("concat_linelists", """SELECT CASE WHEN l_linenumber % 2 = 0 THEN 'even' ELSE 'all' END AS list_id, count(*) AS n FROM lineitem GROUP BY 1""")
def concat_linelists(spark, d):
    """The lines as two list files, read as one table."""
    folder = new_folder(spark)
    lines = _lines(spark, d)
    raw = []
    for name, rest in (("all", 1), ("even", 0)):
        LL.write_linelist(lines.filter(F.col("l_linenumber") % 2 == rest).withColumn("list_id", F.lit(name)), f"{folder}/{name}", ORDER)
        raw.append(read_saved(spark, f"{folder}/{name}", "list_id"))
    return LL.parse_linelist(raw[0].unionByName(raw[1])).groupBy("list_id").agg(F.count(F.lit(1)).alias("n"))
