"""Round trips through files, and files cut into many splits."""

import pytest
from pyspark.sql import functions as F

from specspark.operators.layout import arrange
from specspark.queries import texts as Q
from specspark.sources import linelists as LL
from specspark.sources import models as M
from specspark.sources import spectra as SS
from specspark.sources import tables as T
from specspark.sources import vald as V
from specspark.sources.text import read_saved, save_whole
from specspark.streaming import ingest as I


def write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)
    return str(path)


def test_spectra_files(spark, tmp_path):
    write(tmp_path / "s" / "a.spec", "# made today\n# mu-points   1.0E-01  1.0E+00\n 4800.000 0.9 5.0E+04 1.0E+03 0.5 2.0E+03 0.6\n bad row x\n"
                                     " 4800.010 0.8 4.0E+04 1.1E+03 0.4\n# 4800.020 0.7 1 1 1\n")
    write(tmp_path / "s" / "b.spec", " 1.0 2.0 3.0\n 2.0 x 3.0\n")
    write(tmp_path / "s" / "c.txt", " 9.0 9.0 9.0\n")
    spectrum, intensity = SS.load_all_spectra(spark, str(tmp_path / "s"))
    assert sorted(map(tuple, spectrum.collect())) == [("a.spec", 4800.0, 0.9, 5e4), ("a.spec", 4800.01, 0.8, 4e4), ("b.spec", 1.0, 2.0, 3.0)]
    assert sorted(map(tuple, intensity.collect())) == [("a.spec", 4800.0, 0.1, 1e3, 0.5), ("a.spec", 4800.0, 1.0, 2e3, 0.6), ("a.spec", 4800.01, 0.1, 1.1e3, 0.4)]


def test_spectra_round_trip(spark, sf, tmp_path):
    spectrum = Q._spectrum(spark, sf).filter("spec_id IN ('1', '2', '3')")
    SS.write_spectra(spectrum, str(tmp_path / "out"))
    back, _ = SS.parse_spectra(read_saved(spark, str(tmp_path / "out"), "spec_id"))
    joined = spectrum.join(back.withColumnsRenamed({"flux_norm": "f2", "flux_abs": "a2"}), ["spec_id", "wave"])
    assert joined.count() == spectrum.count() == back.count()
    assert joined.filter((F.abs(F.col("flux_norm") - F.col("f2")) > 6e-6)).count() == 0


def test_linelist_cut_into_splits(spark, sf, tmp_path):
    lines = Q._lines(spark, sf).withColumn("list_id", F.lit("one"))
    LL.write_linelist(lines, str(tmp_path / "out"), Q.ORDER)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    open_cost = spark.conf.get("spark.sql.files.openCostInBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        raw = read_saved(spark, str(tmp_path / "out"), "list_id")
        assert raw.rdd.getNumPartitions() > 8
        plain = LL.parse_linelist(raw)
        cut = LL.parse_linelist(raw, rows_per_chunk=500)
        counts = {r["species"]: r["n"] for r in lines.groupBy("species").agg(F.count("*").alias("n")).collect()}
        for got in (plain, cut):
            assert {r["species"]: r["n"] for r in got.groupBy("species").agg(F.count("*").alias("n")).collect()} == counts
            worst = got.groupBy("block_id").agg((F.max("line_no") - F.count("*")).alias("d")).agg(F.max("d")).first()[0]
            assert worst == 0
        cols = ["block_id", "line_no", "species", "wave", "log_gf", "descr"]
        assert sorted(map(tuple, plain.select(*cols).collect())) == sorted(map(tuple, cut.select(*cols).collect()))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
        spark.conf.set("spark.sql.files.openCostInBytes", open_cost)


def test_documented_line_list(spark, tmp_path):
    text = """'  26.000            '    1       2
'Fe I    NLTE'
  4200.087  3.884 -1.130   -7.420    7.0  5.01E+07  0.000  'p' 'd'   0.0    1.0 'Fe I LS:3p6.3d6.(5D).4s.4p.(3P*) z3D*'  82 0  'z3D3*' 'none'  'c' 'x'
  4200.463  4.154 -3.374   -7.290    9.0  2.45E+08  0.000  'p' 'd'   0.0    1.0 'Fe I, y5D*'  90 484  'y5D3*' '6s5F'  'c' 'a'
'608.012016           '    1       1
'CO'
  5000.000  0.5 -4.0 2.5 3.0 1.0D+05 'X' 'X' 0.0 1.0 'co'
"""
    rows = LL.read_linelist(spark, write(tmp_path / "list.dat", text)).orderBy("block_id", "line_no").collect()
    assert [r["format"] for r in rows] == ["stark_levels", "stark_levels", "short"]
    a, b, co = rows
    assert (a["species"], a["iel"], a["ion"], a["ilev_lo"], a["ilev_up"], a["id_lo"], a["gam_stark"]) == ("26.000", 26, 1, 82, 0, "z3D3*", 0.0)
    assert (b["descr"], b["id_up"], b["comment"]) == ("Fe I, y5D*", "6s5F", "Fe I    NLTE")
    assert (co["iel"], co["atoms"], co["isotopes"], co["gam_rad"], co["gam_stark"], co["lev_lo"]) == (608, [6, 8], [12, 16], 1e5, None, "X")


def test_line_lists_come_back_whole(spark, sf, tmp_path):
    """Blocks with level numbers and names, and blocks without."""
    lines = Q._lines(spark, sf).filter("block_id <= 4")
    LL.write_linelist(lines, str(tmp_path / "out"), Q.ORDER)
    back = LL.parse_linelist(Q.read_saved(spark, str(tmp_path / "out"), "list_id"))
    cols = ["wave", "fdamp", "g_up", "lev_lo", "lev_up", "eqw", "eqw_err", "descr", "ilev_lo", "ilev_up", "id_lo", "id_up"]
    got, want = (sorted(map(tuple, df.select(*cols).collect()), key=repr) for df in (back, lines.withColumn("fdamp", F.round("fdamp", 3))))
    assert got == want and {r[0] for r in back.select("format").distinct().collect()} == {"stark", "stark_levels"}


def test_model_files(spark, sf, tmp_path):
    packed = Q._packed_model(spark, sf).filter("file < 4").withColumn("file", F.format_string("m%d", "file"))
    save_whole(M.render_tau_model(packed), str(tmp_path / "m"))
    models, depths = M.read_models(spark, str(tmp_path / "m"), "tau")
    assert models.count() == 4 and depths.count() == 4 * 16
    assert {r["geometry"] for r in models.collect()} == {"sph", "pp"}


def test_catalog_ignores_other_names(spark, tmp_path):
    good = "p2500_g+3.0_m0.0_t01_st_z+0.00_a+0.00_c+0.00_n+0.00_o+0.00_r+0.00_s+0.00.mod"
    for name in (good, "readme.mod", "p2500.txt"):
        write(tmp_path / "cat" / name, "x")
    rows = M.scan_models(spark, str(tmp_path / "cat")).collect()
    assert [(r["teff"], r["logg"], r["turb"], r["feh"], r["alpha"]) for r in rows] == [(2500, 3.0, "01", 0.0, 0.0)]


def test_manifest_and_grid(spark, tmp_path):
    path = write(tmp_path / "lists.txt", "# lists\na.dat\n/abs/b.dat\n\n")
    assert LL.read_manifest(spark, path, "/base") == ["/base/a.dat", "/abs/b.dat"]
    grid = write(tmp_path / "grid.csv", "Teff,LOGG,fe_h,t_value\n2500.7,3.0,-0.5,1\nbad,3,0,01\n3000,4.0,0.0,ab\n")
    points, rejects = T.read_grid(spark, grid)
    assert sorted(map(tuple, points.collect())) == [(2500, 3.0, -0.5, "01"), (3000, 4.0, 0.0, "ab")]
    assert rejects.count() == 1
    with pytest.raises(ValueError):
        T.resolve_columns(["teff", "logg", "turb"])


def test_files_are_ingested_once(spark, tmp_path):
    src, table, ck = str(tmp_path / "in"), str(tmp_path / "t"), str(tmp_path / "ck")
    write(tmp_path / "in" / "a.spec", "1.0 2.0 3.0\n")
    I.ingest_spectra(spark, src, table, ck).awaitTermination()
    I.ingest_spectra(spark, src, table, ck).awaitTermination()
    assert spark.read.parquet(table).count() == 1
    write(tmp_path / "in" / "b.spec", "1.0 2.0 3.0\n2.0 2.0 3.0\n")
    I.ingest_spectra(spark, src, table, ck).awaitTermination()
    assert spark.read.parquet(table).count() == 3


def test_intensities_are_ingested_once(spark, tmp_path):
    src, table, ck = str(tmp_path / "in"), str(tmp_path / "t"), str(tmp_path / "ck")
    for name in ("a", "b"):
        write(tmp_path / "in" / f"{name}.spec", "# mu-points 0.1 1.0\n1.0 2.0 3.0 4.0 5.0 6.0 7.0\n2.0 2.0 3.0 4.5 5.0 6.5 7.0\n")
        for _ in range(2):
            I.ingest_spectra(spark, src, table, ck).awaitTermination()
    assert spark.read.parquet(table).count() == 4
    _, whole = SS.read_spectra(spark, src, "*.spec")
    kept = spark.read.parquet(f"{table}_intensity").select(*whole.columns)
    assert sorted(map(tuple, kept.collect())) == sorted(map(tuple, whole.collect())) and kept.count() == 8


def test_line_lists_are_ingested_once(spark, sf, tmp_path):
    src, table, ck = str(tmp_path / "in"), str(tmp_path / "t"), str(tmp_path / "ck")
    text = "'  26.000            '    1       2\n'Fe I'\n  4200.087  3.884 -1.130 2.5 7.0 1.0E+05 'p' 'd' 0.0 1.0 'Fe I'\n  4200.463  4.154 -3.374 2.5 9.0 1.0E+05 'p' 'd' 0.0 1.0 'Fe I'\n"
    for name in ("a.dat", "b.dat"):
        write(tmp_path / "in" / name, text)
        for _ in range(2):
            I.ingest_linelists(spark, src, table, ck).awaitTermination()
    whole = LL.read_linelist(spark, src)
    kept = spark.read.parquet(table).select(*whole.columns)
    assert sorted(map(str, kept.collect())) == sorted(map(str, whole.collect())) and kept.count() == 4


def test_queries_call_their_operators(spark, sf, monkeypatch):
    from specspark.queries import job_runs

    called = []
    parse, counts = LL.parse_linelist, job_runs.J.status_counts
    monkeypatch.setattr(LL, "parse_linelist", lambda raw: called.append("lines") or parse(raw))
    monkeypatch.setattr(job_runs.J, "status_counts", lambda log: called.append("counts") or counts(log))
    assert {r["list_id"] for r in Q.concat_linelists(spark, sf).collect()} == {"all", "even"} and job_runs.sort_status(spark, sf).count() > 0
    assert called == ["lines", "counts"]


def test_vald_files_become_line_lists(spark, tmp_path):
    def record(data, refs, lower="'  LS   3d6.4s a6D'", upper="'  LS   3d6.4p   z6F*'"):
        return "\n".join([data, lower, upper, f"'_   1 wl:K14  {refs}'"]) + "\n"

    text = "Elm Ion WL_air log gf\n" + record("'Fe 1',  5000.5, -1.5, 1.25, 2.0, 3.729, 3.0, 1.4, 99.0, 1.1, 8.1, -5.9, -7.55, 0.009,", "Fe") + "a row that belongs to nothing\n" \
        + record("'CN 1', 5001.25, -12.25, 0.5, 2.0, 2.9, 3.5,,,,0.0,,0.0,", "(12)C(14)N", "'  Hb   v=1'", "") + record("'Fe 2'  4999.75 -0.5 2.0 1.5 4.4 0.5 1.4 99.0 1.1 0.0 0.0 290.245", "Fe+") \
        + record("'Fe 1', 4000.0, -1.0, 15.0, 2.0, 15.5, 2.0", "Fe") + record("'Qq 1', 4000.0, -1.0, 1.0, 2.0, 2.5, 2.0", "Qq") + record("'Fe 1', 4000.0, x, 1.0, 2.0, 2.5, 2.0", "Fe") \
        + record("'Na 1', 4000.0, -1.0, 1.0, 2.0, 9.5, 2.0", "Na") + record("'Na 3', 4000.0, -1.0, 1.0, 2.0, 9.5, 2.0", "Na+2") + "'He 1', 4000.0\n"
    write(tmp_path / "in" / "a.vald", text)
    ionpot = spark.createDataFrame([(26, 1, 7.9), (26, 2, 16.2), (11, 1, 5.1)], "z int, ion int, chi_ion double")
    kept, rejected = V.read_vald_lines(spark, str(tmp_path / "in"), ionpot)
    assert sorted((r.line_no, r.reject_reason) for r in rejected.collect()) == [(4, "low level"), (5, "species"), (6, "fields"), (7, "bound-free"), (8, "ion"), (9, "fields")]
    LL.write_linelist(kept.withColumn("list_id", F.lit("out")), str(tmp_path / "out"))
    got = [tuple(r) for r in LL.read_linelist(spark, str(tmp_path / "out" / "list_id=out")).orderBy("block_id", "line_no").select(
        "block_id", "species", "ion", "comment", "wave", "chi_low", "log_gf", "fdamp", "g_up", "gam_rad", "gam_stark", "lev_lo", "lev_up", "descr").collect()]
    assert got == [
        (1, "26.000", 1, "Fe I", 5000.5, 1.25, -1.5, -7.55, 7.0, 1.26e8, -5.9, "s", "p", "Fe I LS:3d6.4s a6D LS:3d6.4p z6F*"),
        (2, "26.000", 2, "Fe II", 4999.75, 2.0, -0.5, 290.245, 2.0, 1e5, 0.0, "s", "p", "Fe II LS:3d6.4s a6D LS:3d6.4p z6F*"),
        (3, "607.000000", 1, "CN I", 5001.25, 0.5, -12.25, 2.5, 8.0, 1e5, None, "X", "X", "CN I Hb:v=1 __:")]
    whole, _ = V.read_vald_lines(spark, str(tmp_path / "in"), ionpot)
    raw = V.read_rows(spark, str(tmp_path / "in"))
    cut, _ = V.vald_to_lines(raw, ionpot, rows_per_chunk=7)
    assert sorted(map(str, whole.collect())) == sorted(map(str, cut.collect()))
    assert sum(V.vald_to_lines(raw.limit(0), ionpot)[i].count() for i in (0, 1)) == 0


def test_counts_are_brought_up_to_date_once(spark, tmp_path):
    src, out, ck = str(tmp_path / "in"), str(tmp_path / "t"), str(tmp_path / "ck")
    (tmp_path / "in").mkdir()
    log = spark.readStream.schema("status string, node string").csv(src)
    assert I.job_progress(spark, log, out, ck).count() == 0
    write(tmp_path / "in" / "a.csv", "ok,1\nok,2\nfailed,1\n,3\n")
    first = sorted(map(str, I.job_progress(spark, log, out, ck).collect()))
    assert first == sorted(map(str, I.job_progress(spark, log, out, ck).collect()))
    write(tmp_path / "in" / "b.csv", "ok,1\nskipped,2\n")
    want = {"ok": 3, "failed": 1, "skipped": 1, None: 1}
    assert {r.status: r.n for r in I.job_progress(spark, log, out, ck).collect()} == want
    # the last batch once more, as after a failure: from the version before it, over its own
    commits = sorted((tmp_path / "ck" / "commits").glob("[0-9]*"), key=lambda p: int(p.name))
    commits[-1].unlink()
    commits[-1].with_name(f".{commits[-1].name}.crc").unlink(missing_ok=True)
    assert {r.status: r.n for r in I.job_progress(spark, log, out, ck).collect()} == want


def test_line_lists_keep_their_layout(spark, tmp_path):
    tail, ids = "'p' 'd'   0.0    1.0 'Fe I, x y'", " 82 0 'z3D3*' 'none' 'c' 'x'"
    blocks = [("26.000", f"-5.500 {tail}{ids}"), ("26.000", f"0.000 {tail}"), ("26.000", f"{tail}{ids}"), ("26.000", tail), ("26.000", ""), ("608.012016", tail), ("608.012016", "")]
    text = "".join(f"'{code}            '    1       1\n'name {i}'\n  4200.087  3.884 -1.130 -7.420 7.0 1.00E+05 {end}\n" for i, (code, end) in enumerate(blocks))
    write(tmp_path / "in" / "a.list", text)
    lines = LL.read_linelist(spark, str(tmp_path / "in")).withColumn("list_id", F.lit("out"))
    assert [r["format"] for r in lines.orderBy("block_id").collect()] == ["stark_levels", "stark", "levels", "short", "old", "short", "old"]
    LL.write_linelist(lines, str(tmp_path / "out"))
    back = LL.read_linelist(spark, str(tmp_path / "out" / "list_id=out")).withColumn("list_id", F.lit("out"))
    assert [tuple(r) for r in back.orderBy("block_id").collect()] == [tuple(r) for r in lines.orderBy("block_id").collect()]


def test_records_of_a_hot_file_are_sorted_once(spark):
    """Chunks take what they need of each other from written rows: no window is left in the plan, and the records are those of the whole file."""
    rows = [("f", i, 0, r) for i, r in enumerate(t for k in range(60) for t in (
        [f"'Fe 1',  {k}"] + [f"'  LS lo{k}'", f"'  LS up{k}'", "'_ 1 wl:K14'", "* other"][:k % 5]))]
    raw = spark.createDataFrame(rows, "file string, block bigint, pos int, value string")
    whole, cut = LL.parse_vald3(raw), LL.parse_vald3(raw, 7)
    assert "Window" not in cut._jdf.queryExecution().executedPlan().toString()
    got = [tuple(r) for r in cut.orderBy("rec").collect()]
    assert len(got) == 60 and got == [tuple(r) for r in whole.orderBy("rec").collect()]
    assert got[0][:4] == ("f", 1, "'Fe 1',  0", "'Fe 1',  1")


def test_the_search_for_a_chunk_is_as_deep_as_there_are_cuts(spark):
    lay = arrange(spark.range(1000).select(F.lit(1).alias("k"), "id"), ["k"], ["id"], 300)
    assert lay.split and "8192" not in lay.df._jdf.queryExecution().analyzed().toString()


def test_grid_text_is_taken_apart_once(spark):
    good = "title\n 1000K 1500.  \n 10.0 1.0 2.0\n 20.0 3.0D0 4.0\n"
    raw = spark.createDataFrame([("a", good), ("no row", "title\n 1000K 1500.\n"), ("no axis", "title\n"), ("empty", ""), ("none", None)], "file string, text string")
    table = T.parse_table2d(raw.repartition(1))
    assert table._jdf.queryExecution().optimizedPlan().toString().count("K$") == 1
    assert sorted(map(tuple, table.collect())) == [("a", 10.0, 1000.0, 1.0), ("a", 10.0, 1500.0, 2.0), ("a", 20.0, 1000.0, 3.0), ("a", 20.0, 1500.0, 4.0)]


def test_fields_between_commas_and_blanks(spark):
    data = [("'Fe 1', 4200.5,-1.0 , 2.5  3.0,, 5.0",), ("'Fe 1' 4200.5 -1D0   2.5,3.0 , ,5.0",), ("'Fe 1',  ,x",)]
    got = V.vald_fields(spark.createDataFrame(data, "data string")).select("token", *V.FIELDS[:6]).collect()
    assert [tuple(r) for r in got] == [("Fe", 4200.5, -1.0, 2.5, 3.0, None, 5.0)] * 2 + [("Fe", None, None, None, None, None, None)]


def test_cut_line_lists_are_read_once(spark, tmp_path):
    """Headers at the edges of chunks, a header without rows, rows beyond the announced number, rows before any header."""
    row = "  4200.087  3.884 -1.130 2.5 7.0 1.0E+05 'p' 'd' 0.0 1.0 'x'\n"
    head = lambda k, n: f"'{k:4d}.000            '    1       {n}\n"
    text = row * 2 + head(26, 2) + "'Fe I'\n" + row * 4 + head(20, 1) + head(12, 3) + "'Mg I'\n" + row * 3 + head(11, 1) + "'Na I'\n" + row.replace("2.5 7.0", "2.5 7.0 1E5") + head(3, 9)
    write(tmp_path / "in" / "a.dat", text * 5)
    write(tmp_path / "in" / "b.dat", head(8, 1) + "'O I'\n" + row)
    raw = LL.read_rows(spark, str(tmp_path / "in"))
    odd = raw.withColumn("value", F.when(F.col("value") != "'Mg I'", F.col("value")))  # a comment that is null
    for rows in (raw, odd):
        want = sorted(map(str, LL.parse_linelist(rows).collect()))
        for chunk in (2, 7):
            got = LL.parse_linelist(rows, rows_per_chunk=chunk)
            assert sorted(map(str, got.collect())) == want and len(want) == 35
    plan = LL.parse_linelist(raw, rows_per_chunk=7)._jdf.queryExecution().optimizedPlan().toString()
    assert "text" not in plan.split("Relation")[1][:400] and plan.count("Relation") <= 3, plan
