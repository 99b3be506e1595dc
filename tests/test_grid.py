"""Grid generation invariants and expressions with known answers."""

import pytest
from pyspark.sql import functions as F

from specspark.functions import names as N
from specspark.functions import species as SP
from specspark.operators import grid as G
from specspark.operators import ranges as R


def test_axis_overshoots(spark):
    df = spark.createDataFrame([(0.0, 1.0, 0.4)], "a double, b double, s double")
    got = [r["value"] for r in G.axis_values(df, "a", "b", "s").orderBy("value").collect()]
    assert got == pytest.approx([0.0, 0.4, 0.8, 1.2])


def test_full_grid_order(spark):
    rows = G.grid_full(spark, {"a": [1, 2], "b": ["x", "y", "z"]}, 4).orderBy("row_id").collect()
    assert [(r["a"], r["b"]) for r in rows] == [(1, "x"), (1, "y"), (1, "z"), (2, "x")]


def test_hypercube_counts(spark):
    g = G.grid_lhs(spark, {"a": list(range(7)), "b": [0.5, 1.5, 2.5]}, 100, seed=2)
    for axis, m in (("a", 7), ("b", 3)):
        counts = [r["n"] for r in g.groupBy(axis).agg(F.count("*").alias("n")).collect()]
        assert len(counts) == m and set(counts) <= {100 // m, -(-100 // m)} and sum(counts) == 100
    again = G.grid_lhs(spark, {"a": list(range(7)), "b": [0.5, 1.5, 2.5]}, 100, seed=2)
    assert sorted(map(tuple, g.collect())) == sorted(map(tuple, again.collect()))


@pytest.mark.parametrize("n", [1, 2, 3, 10, 1000, 4097])
def test_permutations(spark, n):
    """Every number once, for every seed, and not in order."""
    ids = spark.range(n)
    for seed in (0, 1, 99):
        got = [r["p"] for r in ids.select(G.permuted(F.col("id"), n, seed).alias("p")).collect()]
        assert sorted(got) == list(range(n)) and (n < 10 or got != sorted(got))


def test_axis_of_a_million_values(spark):
    axis = G.axis_table(spark.range(1_000_000).select((F.col("id") * 3).alias("v")), "v")
    g = G.grid_lhs(spark, {"v": axis, "w": ["a", "b"]}, 2_000_000, seed=4)
    assert g.groupBy("v").count().agg(F.count("*"), F.min("count"), F.max("count")).first()[:] == (1_000_000, 2, 2)
    full = G.grid_full(spark, {"w": ["a", "b"], "v": axis}, 1_500_000)
    assert full.filter(F.col("v") != F.col("row_id") % 1_000_000 * 3).isEmpty() and full.filter("w = 'b'").count() == 500_000


def test_segment_grid_passes_the_end(spark):
    seg = spark.createDataFrame([(1, 4805.0, 4805.1)], "seg_id int, wmin double, wmax double")
    w = [r["wave"] for r in G.wave_grid_segments(seg, 500000.0).orderBy("j").collect()]
    assert w[0] == 4805.0 and w[-2] < 4805.1 <= w[-1]


def test_bracket_opens_both_ends(spark):
    axis = spark.createDataFrame([(v,) for v in (1.0, 2.0, 4.0, 4.0)], "v double")
    t = spark.createDataFrame([(x,) for x in (0.0, 1.0, 1.5, 2.0, 4.0, 9.0)], "x double")
    got = {r["x"]: (r["v_inf"], r["v_sup"]) for r in R.bracket(t, "x", axis, "v").collect()}
    assert got == {0.0: (1, 2), 1.0: (1, 2), 1.5: (1, 2), 2.0: (2, 4), 4.0: (2, 4), 9.0: (2, 4)}


def corner_rows(spark, teff, logg, feh, drop=None):
    rows = [("01", t, g, z, f"{t}/{g}/{z}", i) for i, (t, g, z) in enumerate(
        (t, g, z) for t in (4000.0, 4200.0) for g in (1.0, 1.5) for z in (-1.0, 0.0)) if i != drop]
    models = spark.createDataFrame(rows, "turb string, teff double, logg double, feh double, path string, cat_pos int")
    point = spark.createDataFrame([(1, "01", teff, logg, feh)], "p int, turb string, teff double, logg double, feh double")
    return models, G.corners(point, "p", models)


def test_blend_reproduces_a_linear_field(spark):
    models, c = corner_rows(spark, 4050.0, 1.1, -0.25)
    values = models.select(F.col("path").alias("model_id"), F.lit(1).alias("k"), (F.col("teff") + 10 * F.col("logg") - 3 * F.col("feh")).alias("radius"))
    r = G.blend_corners(c, "p", values, "model_id", ["k"], ["radius"]).first()
    assert r["radius"] == pytest.approx(4050 + 11 + 0.75) and not r["extrapolated"]
    _, outside = corner_rows(spark, 3900.0, 1.1, -0.25)
    values = values.withColumn("temp", F.col("radius"))
    r = G.blend_corners(outside, "p", values, "model_id", ["k"], ["radius", "temp"]).first()
    assert r["extrapolated"] and r["radius"] == pytest.approx(3900 + 11 + 0.75) and r["temp"] is None


def test_missing_corner_is_named(spark):
    _, c = corner_rows(spark, 4050.0, 1.1, -0.25, drop=3)
    r = G.missing_corners(c, "p").first()
    assert (r["message"], r["n_missing"]) == ("Missing grid point: Teff=4000.0, logg=1.5, FeH=0.0", 1)


def test_species_codes(spark):
    df = spark.createDataFrame([(s,) for s in ("608.012016", "  26.000", "0026.056", "1.000", "822.000048", "10108.000")], "s string")
    got = [(r["c"]["iel"], r["c"]["atoms"], r["c"]["isotopes"]) for r in df.select(SP.parse_species(F.col("s")).alias("c")).collect()]
    assert got == [(608, [6, 8], [12, 16]), (26, [26], [0]), (26, [26], [56]), (1, [1], [0]), (822, [8, 22], [0, 48]), (10108, [1, 1, 8], [0, 0, 0])]


def test_designations(spark):
    df = spark.createDataFrame([(s,) for s in ("Fe+", "(48)TiO", "(12)C(13)C", "Ba", "CN+")], "s string")
    got = [(r["species"], r["ion"]) for r in SP.with_species(df, F.col("s")).collect()]
    assert got == [("26.000", 2), ("822.000048", 1), ("606.012013", 1), ("56.000", 1), ("607.000000", 2)]


def test_model_names(spark):
    df = spark.createDataFrame([(2500, 3.0, -0.5, "01")], "t int, g double, z double, v string")
    name = N.format_model_name(F.col("t"), F.col("g"), F.col("z"), F.col("v"))
    r = df.select(name.alias("n"), N.parse_model_name(name).alias("m")).first()
    assert r["n"] == "p2500_g+3.0_m0.0_t01_st_z-0.50_a+0.00_c+0.00_n+0.00_o+0.00_r+0.00_s+0.00.mod"
    assert (r["m"]["teff"], r["m"]["logg"], r["m"]["feh"]) == (2500, 3.0, -0.5)


def test_segments_against_a_loop(spark):
    import random
    random.seed(4)
    seg = [(i, a := round(random.uniform(0, 100), 1), a + round(random.choice([0, 0.5, 3, 30]), 1)) for i in range(700)]
    pts = [(i, round(random.uniform(-5, 140), 1)) for i in range(2000)]
    want = {i: min((s for s, a, b in seg if a <= w <= b), default=None) for i, w in pts}
    lines = spark.createDataFrame(pts, "id int, wave double")
    for n in (700, 40):
        part = seg[:n]
        want = {i: min((s for s, a, b in part if a <= w <= b), default=None) for i, w in pts}
        got = R.assign_segment(lines, "wave", spark.createDataFrame(part, "seg_id int, wmin double, wmax double"))
        assert {r["id"]: r["seg_id"] for r in got.collect()} == want


def test_settings_of_three_levels(spark):
    from specspark.plans import settings as ST

    texts = [('{"abund_source": "magg", "turbvel": 1.0, "isotopes": [[6.012, 0.9], [6.013, 0.1]], "individual_abundances": [[26, 7.5]]}',
              '{"turbvel": null, "isotopes": [[6.01, 0.5], [12.024, 0.8]], "comment": {"any": [1]}}', '{"isotopes": [[6.012, 0.95]], "individual_abundances": [[26, 7.4], [26, 7.3], [20]]}'),
             (None, "not json", "{}"), ("{}", '{"turbvel": "fast", "alpha_fe": 0.4}', None)]
    df = spark.createDataFrame(texts, "a string, b string, c string").select(ST.merge_settings([F.col("a"), F.col("b"), F.col("c")]).alias("s"))
    one, none, two = df.select("s.*", ST.abundance_rows(F.col("s")).alias("ab"), ST.isotope_rows(F.col("s")).alias("iso")).collect()
    assert (one.abund_source, one.turbvel, one.individual_abundances) == ("magg", 1.0, {26: 7.3})
    assert one.isotopes == {6: {12: 0.95, 13: 0.1, 10: 0.5}, 12: {24: 0.8}}
    assert [tuple(r) for r in one.iso] == [(6, 10, 0.5), (6, 12, 0.95), (6, 13, 0.1), (12, 24, 0.8)] and [tuple(r) for r in one.ab] == [(26, 7.3)]
    assert none.turbvel is None and none.isotopes == {} == none.individual_abundances and none.iso == []
    assert two.turbvel is None and two.isotopes == {}
    with pytest.raises(ValueError):
        ST.merge_settings([])


def test_corners_are_never_broadcast(spark, tmp_path):
    """Points from a small file are eight corners each and can be many: the cells and the models are sent to them."""
    spark.range(300).select(F.col("id").alias("p"), F.lit("t").alias("turb"), (F.col("id") % 9 + 0.25).alias("teff"), (F.col("id") % 4 + 0.5).alias("logg"),
                            (F.col("id") % 3 / -2).alias("feh")).write.parquet(str(tmp_path / "points"))
    cells = spark.range(300).select(F.lit("t").alias("turb"), (F.col("id") % 10).cast("double").alias("teff"), (F.floor(F.col("id") / 10) % 6).cast("double").alias("logg"),
                                    (F.floor(F.col("id") / 60) / -2).alias("feh"), F.col("id").cast("string").alias("path"), F.col("id").alias("cat_pos"))
    depths = cells.select(F.col("path").alias("model_id"), F.lit(1).alias("k"), F.col("teff").alias("temp"))
    rows = G.corners(spark.read.parquet(str(tmp_path / "points")), "p", cells)
    blended = G.blend_corners(rows, "p", depths, "model_id", ["k"], ["temp"], optimize=False)
    plan = blended._jdf.queryExecution().executedPlan().toString()
    assert "BuildRight" in plan and "BuildLeft" not in plan
    got = blended.collect()
    assert len(got) == 300 and all(r["temp"] == pytest.approx(r["p"] % 9 + 0.25) for r in got)
