"""Convolution, photometry and width invariants."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from specspark.operators import spectra as X


def long_and_packed(spark, n=400, specs=2):
    rng = np.random.default_rng(3)
    rows = []
    for s in range(specs):
        wave = 5000.0 + np.cumsum(rng.uniform(0.02, 0.06, n))  # an uneven grid
        rows.append((s, wave.tolist(), (1 - 0.5 * rng.random(n)).tolist()))
    packed = spark.createDataFrame(rows, "k int, wave array<double>, flux array<double>")
    long = packed.select("k", F.explode(F.arrays_zip("wave", "flux")).alias("p")).select("k", "p.wave", "p.flux")
    return long, packed


@pytest.mark.parametrize("profile,fwhm", [("gauss", 300.0), ("exp", 60.0), ("radtan", -8.0), ("rot", -10.0), ("gauss", 5.0)])
@pytest.mark.parametrize("width", [3.1, 0.9])
def test_chunks_equal_whole_spectra(spark, profile, fwhm, width):
    long, packed = long_and_packed(spark)
    a = X.convolve(long, ["k"], ["flux"], fwhm, profile, chunk_width=width)
    b = X.convolve_packed(packed, ["k"], ["flux"], fwhm, profile).select("k", F.explode(F.arrays_zip("wave", "flux")).alias("p"))
    left = {(r["k"], r["wave"]): r["flux"] for r in a.collect()}
    right = {(r["k"], r["p"]["wave"]): r["p"]["flux"] for r in b.collect()}
    assert len(left) == len(right) == 800 and left.keys() == right.keys()
    assert max(abs(left[k] - right[k]) for k in left) < 1e-10


@pytest.mark.parametrize("profile", list(X.SUPPORT))
def test_constant_stays_constant_inside(spark, profile):
    _, packed = long_and_packed(spark, 2000, 1)
    flat = packed.withColumn("flux", F.transform("wave", lambda w: F.lit(0.7)))
    r = X.convolve_packed(flat, ["k"], ["flux"], 500.0, profile).first()
    inside = np.array(r["flux"])[300:-300]
    assert np.allclose(inside, 0.7, atol=1e-9)
    assert r["flux"][0] < 0.7  # zeros outside the spectrum


def test_width_of_long_and_packed(spark):
    long, packed = long_and_packed(spark)
    a = {r["k"]: r["eqw"] for r in X.equivalent_width(long, ["k"]).collect()}
    cut = {r["k"]: r["eqw"] for r in X.equivalent_width(long, ["k"], rows_per_chunk=50).collect()}
    b = {r["k"]: r["eqw"] for r in X.equivalent_width_packed(packed).collect()}
    assert a == pytest.approx(b) and cut == pytest.approx(b)


def test_bands_are_half_open_except_k(spark):
    df = spark.createDataFrame([(1, 4200.0, 5.0), (1, 4199.9, 3.0), (1, 25900.0, 2.0), (1, 25900.1, 9.0)], "k int, wave double, flux double")
    got = {r["band"]: r["flux"] for r in X.band_flux(df, ["k"]).collect()}
    assert got["U"] == pytest.approx(3.0) and got["K"] == pytest.approx(2.0)


def test_flux_of_constant_intensity(spark):
    from specspark.operators.grid import gauss_nodes
    rows = spark.createDataFrame([(1, i, 2.0, 4.0) for i in range(1, 7)], "s int, i int, i_line double, i_cont double")
    r = X.flux_from_intensity(rows, ["s"], gauss_nodes(spark, 6)).first()
    assert r["flux_abs"] == pytest.approx(2 * np.pi) and r["flux_norm"] == pytest.approx(0.5)


def test_rejects_are_counted_on_the_way(spark, sf):
    """The counts of one pass equal those of the rejects themselves, and lines outside all segments are counted alike."""
    from specspark.operators import lines as L
    from specspark.operators.ranges import assign_segment
    from specspark.queries.linelists import atoms, ionpot

    marked = L.vald_reject(atoms(spark, sf), ionpot(spark))
    want = {r["reject_reason"]: r["count"] for r in marked.groupBy("reject_reason").count().collect()}
    reasons = sorted(k for k in want if k)
    kept, seen = L.observe_rejects(marked, reasons[1:])
    assert "reject_reason" not in kept.columns and kept.count() == want[None]
    assert seen.get == {"rows": sum(want.values()), **{r: want[r] for r in reasons[1:]}, "other": want[reasons[0]]}

    seg = spark.createDataFrame([(1, 5000.0, 9000.0), (2, 20000.0, 40000.0)], "seg_id int, wmin double, wmax double")
    lines = spark.read.parquet(f"{sf}/lineitem.parquet").select(F.col("l_extendedprice").alias("wave"))
    placed = assign_segment(lines, "wave", seg).withColumn("reject_reason", F.when(F.col("seg_id").isNull(), "outside"))
    inside, seen = L.observe_rejects(placed, ["outside"])
    n = inside.count()
    assert n == lines.filter("wave between 5000 and 9000 or wave between 20000 and 40000").count()
    assert seen.get == {"rows": lines.count(), "outside": lines.count() - n, "other": 0}


def test_spline_ends(spark):
    from specspark.operators.series import cubic_spline, resample_spline

    rng = np.random.default_rng(4)
    x = np.cumsum(rng.uniform(0.3, 2.0, 9))
    at = np.linspace(x[0] - 1, x[-1] + 1, 50)
    cubic = lambda t: 0.3 * t**3 - 2 * t**2 + t - 5
    for n in (4, 5, 9):  # the spline of a cubic is that cubic, beyond the ends too
        assert np.allclose(cubic_spline(x[:n], cubic(x[:n]), at, "third"), cubic(at), rtol=1e-9, atol=1e-7)
    parabola = lambda t: t**2 - 3 * t
    assert np.allclose(cubic_spline(x[:3], parabola(x[:3]), at, "third"), parabola(at))
    y = rng.normal(size=9)
    for ends in ("third", "natural"):  # a dense solution of the same conditions
        h, a, b = np.diff(x), np.zeros((9, 9)), np.zeros(9)
        for i in range(1, 8):
            a[i, i - 1:i + 2] = h[i - 1], 2 * (h[i - 1] + h[i]), h[i]
            b[i] = 6 * ((y[i + 1] - y[i]) / h[i] - (y[i] - y[i - 1]) / h[i - 1])
        a[0, 0] = a[8, 8] = 1
        if ends == "third":
            a[0, 1] = a[8, 7] = -1
            b[0], b[8] = (-6 * h[0] * np.polyfit(x[:4], y[:4], 3)[0], 6 * h[-1] * np.polyfit(x[-4:], y[-4:], 3)[0])
        m = np.linalg.solve(a, b)
        mid = (x[:-1] + x[1:]) / 2
        assert np.allclose(cubic_spline(x, y, mid, ends), (y[:-1] + y[1:]) / 2 - h**2 * (m[:-1] + m[1:]) / 16)
        assert np.allclose(cubic_spline(x, y, x, ends), y)
    assert np.allclose(cubic_spline(np.array([1.0, 2.0]), np.array([1.0, 3.0]), np.array([0.0, 4.0]), "third"), [-1, 7])
    rows = spark.createDataFrame([(1, [], []), (2, [1.0], [5.0])], "k int, x array<double>, y array<double>")
    got = {r.k: r.value for r in resample_spline(rows, ["k"], "x", "y", [0.0, 1.0], "third").collect()}
    assert got[2] == [5.0, 5.0] and got[1] == [None, None]
    with pytest.raises(ValueError):
        resample_spline(rows, ["k"], "x", "y", [0.0], "clamped")
