"""Voigt profile and the walk over grid points against a plain loop."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from specspark.functions.physics import voigt_np, with_voigt
from specspark.operators import opacity as O
from specspark.operators import synthesis as S

START, STEP, N = 5000.0, 0.05, 400
C = O.C_ANGSTROM


def test_voigt_centre_and_area():
    assert voigt_np(0.0, 0.0) == pytest.approx(1.0, abs=1e-4)
    v = np.linspace(-2000, 2000, 800001)
    for a in (0.01, 0.3, 2.0):
        assert np.trapezoid(voigt_np(a, v), v) == pytest.approx(np.sqrt(np.pi), rel=2e-3)


def test_column_form_equals_numpy(spark):
    a, v = np.meshgrid([0.0, 1e-4, 0.01, 0.2, 1.0, 4.0, 20.0], np.linspace(-20, 20, 81))
    df = spark.createDataFrame([(float(x), float(y)) for x, y in zip(a.ravel(), v.ravel())], "a double, v double")
    rows = with_voigt(df, F.col("a"), F.col("v"), "h").collect()
    want = voigt_np(np.array([r["a"] for r in rows]), np.array([r["v"] for r in rows]))
    assert np.allclose([r["h"] for r in rows], want, rtol=1e-9, atol=1e-12)


def make_lines(seed=1, n=60):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        lam = float(rng.uniform(START - 1.5, START + N * STEP + 1.5))
        if i % 12 == 0:
            lam = START + STEP * int(rng.integers(0, N))  # exactly on a grid point
        if i == 1:
            lam = START
        depth = [(float(10 ** rng.uniform(-3, 0)), C / lam**2 * float(rng.uniform(0.05, 0.3)), float(10 ** rng.uniform(-5, 2)))
                 for _ in range(3)]
        rows.append((i, lam, [d[0] for d in depth], [d[1] for d in depth], [d[2] for d in depth]))
    return rows


def peaks(line, j):
    _, lam, a, dnud, ratio = line
    v = abs(START + j * STEP - lam) * C / lam**2 / np.array(dnud)
    return float(np.max(np.array(ratio) * voigt_np(np.array(a), v)))


def walk(line, eps):
    """Outward walk from a line, one point at a time."""
    x = (line[1] - START) / STEP
    points = []
    if x <= 0:
        for j in range(N):
            points.append(j)
            if peaks(line, j) < eps:
                break
        return points
    first, red = min(int(x) + 1, N - 1), 0
    stopped = False
    for j in range(first, N):
        points.append(j)
        red += 1
        if peaks(line, j) < eps:
            stopped = True
            break
    if stopped:
        return points + list(range(max(0, first - red - 2), first))
    for j in range(first - 1, -1, -1):
        points.append(j)
        if peaks(line, j) < eps:
            break
    return points


@pytest.mark.parametrize("mode", ["symmetric", "compat"])
def test_points_of_a_line(spark, mode):
    lines, eps = make_lines(), 1e-4
    df = spark.createDataFrame(lines, "id int, wave double, a array<double>, dnud array<double>, ratio array<double>")
    got = {i: set() for i in range(len(lines))}
    for r in O.line_points(df, "wave", START, STEP, N, eps, mode).select("id", "j").collect():
        assert r["j"] not in got[r["id"]]
        got[r["id"]].add(r["j"])
    for line in lines:
        want = set(walk(line, eps)) if mode == "compat" else {j for j in range(N) if peaks(line, j) >= eps}
        assert got[line[0]] == want, line


def test_departures_of_one_equal_lte(spark):
    row = [(0.5, 1e10, 0.9, 1e10, 1.0, 1.0, 1.0)]
    df = spark.createDataFrame(row, "gf double, n_low double, stim double, dnud double, ross double, b_lo double, b_up double")
    nlte, lte = O.line_strength(df).first(), O.line_strength(df.drop("b_lo", "b_up")).first()
    assert nlte["kappa0"] == pytest.approx(lte["kappa0"]) and nlte["emis0"] == pytest.approx(lte["emis0"])
    assert lte["kappa0"] == pytest.approx(lte["emis0"])


DEEP = "id int, wave double, a array<double>, dnud array<double>, ratio array<double>"


@pytest.mark.parametrize("mode", ["symmetric", "compat"])
@pytest.mark.parametrize("small", [False, True])
def test_blocks_hold_the_sums_of_the_walks(spark, mode, small, monkeypatch):
    """Sums in blocks against one point at a time; small blocks, pieces and memory cut them everywhere."""
    if small:
        for name, value in (("BLOCK", 32), ("PIECE", 7), ("PAIRS", 40), ("HELD_BYTES", 1)):
            monkeypatch.setattr(S, name, value)
    lines, eps = make_lines(), 1e-4
    lines += [(100 + i, lines[5][1], *lines[5][2:]) for i in range(30)]  # many lines at one wavelength
    df = S.regular_index(spark.createDataFrame(lines, DEEP), START, STEP, N).withColumns({"kappa0": F.col("ratio"), "emis0": F.transform("ratio", lambda x: x * 2)})
    got = {(r["j"], r["k"]): (r["kappa"], r["sigma"], r["emissivity"]) for r in S.block_opacity(df, "wave", eps, mode, scattering=0.25).collect()}
    want = {}
    for line in lines:
        _, lam, a, dnud, ratio = line
        points = walk(line, eps) if mode == "compat" else [j for j in range(N) if peaks(line, j) >= eps]
        for j in points:
            for k in range(3):
                v = abs(START + j * STEP - lam) * C / lam**2 / dnud[k]
                want[j, k] = want.get((j, k), 0.0) + ratio[k] * float(voigt_np(np.array([a[k]]), np.array([v]))[0])
    assert got.keys() == want.keys()
    for key, total in want.items():
        assert got[key] == pytest.approx((0.75 * total, 0.25 * total, 2 * total), rel=1e-9)


def test_lines_stay_in_their_segment(spark):
    """Overlapping segments: the lowest id takes the line, and its walk ends where that segment does."""
    seg = spark.createDataFrame([(3, 5000.0, 5004.0), (1, 5002.0, 5006.0), (7, 5010.0, 5010.5)], "seg_id int, wmin double, wmax double")
    index = S.segment_index(seg, 50000.0)
    rows = {r["seg_id"]: r for r in index.collect()}
    assert [rows[i]["first"] for i in (1, 3, 7)] == [0, rows[1]["n"], rows[1]["n"] + rows[3]["n"]]
    for r in rows.values():
        assert r["wmin"] + (r["n"] - 2) * r["step"] < r["wmax"] <= r["wmin"] + (r["n"] - 1) * r["step"] + 1e-9
    deep = ([0.01], [C / 5000.0**2 * 0.2], [5.0])
    lines = [(1, 5003.0, *deep), (2, 5000.5, *deep), (3, 5010.5, *deep), (4, 5008.0, *deep), (5, None, *deep)]
    placed = S.place_lines(spark.createDataFrame(lines, DEEP), "wave", index).withColumns({"kappa0": F.col("ratio"), "emis0": F.col("ratio")})
    assert {r["id"]: r["seg_id"] for r in placed.collect()} == {1: 1, 2: 3, 3: 7}
    ends = S.block_opacity(placed, "wave", 1e-3).groupBy("seg_id").agg(F.min("j").alias("a"), F.max("j").alias("b"))
    for r in ends.collect():
        assert 0 <= r["a"] <= r["b"] < rows[r["seg_id"]]["n"]


def test_continuum_next_above_the_line(spark):
    cont = spark.createDataFrame([(10.0, [1.0, 2.0]), (20.0, [3.0, 4.0]), (30.0, [5.0, 6.0])], "x double, cont array<double>")
    lines = spark.createDataFrame([(w,) for w in (5.0, 10.0, 10.5, 20.0, 29.9, 30.0, 99.0, None)], "wave double")
    got = {r["wave"]: r["cont"] for r in S.continuum_beside(lines, "wave", cont, ["cont"]).collect()}
    one, two, three = [1.0, 2.0], [3.0, 4.0], [5.0, 6.0]
    assert got == {5.0: one, 10.0: one, 10.5: two, 20.0: three, 29.9: three, 30.0: three, 99.0: three, None: None}


def test_peaks_are_found_where_the_points_of_a_line_are(spark):
    """Repeated lines are one, lines with a null in their key have peaks but pass no cut; peaks need no shuffle of points."""
    lines = make_lines(n=40)
    rows = [(i if i < 39 else None, lam, a, dnud, ratio) for i, lam, a, dnud, ratio in lines]
    rows = [*rows, rows[0], rows[0]]
    df = spark.createDataFrame(rows, "id int, wave double, a array<double>, dnud array<double>, ratio array<double>").withColumns(
        {"kappa0": F.col("ratio"), "emis0": F.col("ratio")})
    key = ["id", "wave"]
    near, far = (O.line_opacity(df, "wave", START, STEP, N, 1e-3, extra=key, cluster=c) for c in (key, ()))
    peaks = lambda c: sorted(map(str, O.peak_ratio(c, key).collect()))
    assert peaks(near) == peaks(far) and peaks(near)
    joined = far.join(O.peak_ratio(far, key).filter("peak >= 0.05").drop("peak"), [*key, "j"], "left_semi")
    cut = O.strength_cut(near, key, 0.05)
    assert sorted(map(str, cut.select(*joined.columns).collect())) == sorted(map(str, joined.collect())) and not joined.isEmpty()
    for out, most in ((O.peak_ratio(near, key), 1), (cut, 2)):
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange ") <= most, plan


def peaked_lines(spark):
    """Names that come once, twice alike, twice with other strengths, often, at two wavelengths, and with nulls."""
    lines = make_lines(n=40)
    rows = [*lines, *lines[:5], *[(i, lam, a, dnud, [x * 30 for x in ratio]) for i, lam, a, dnud, ratio in lines[3:20]]]
    rows += [(7, lines[7][1], lines[i][2], lines[7][3], lines[i][4]) for i in range(40)]
    rows += [(8, lines[9][1], *lines[10][2:]), (None, *lines[1][1:]), (None, *lines[2][1:])]
    return spark.createDataFrame(rows, DEEP).withColumns({"kappa0": F.transform("ratio", lambda x: x * 3), "emis0": F.col("ratio")})


@pytest.mark.parametrize("mode, key, small", [("symmetric", ["id", "wave"], False), ("symmetric", ["id"], True), ("compat", ["id"], False),
                                              ("compat", ["id", "wave"], True)])
def test_peaks_carried_by_contributions(spark, mode, key, small, monkeypatch):
    """The cut by carried peaks and the one by a window against a plain loop; small blocks, pieces and memory cut names everywhere."""
    if small:
        for name, value in (("REACH_BLOCK", 16), ("PEAK_VALUES", 60), ("HELD_BYTES", 500)):
            monkeypatch.setattr(O, name, value)
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 3)
    try:
        df = peaked_lines(spark)
        far, near = (O.line_opacity(df, "wave", START, STEP, N, 1e-3, mode, ["id", "wave"], **more) for more in ({}, {"cluster": key, "peak": True}))
        best, rows, names = {}, far.filter("id is not null").collect(), far.columns
        pair = lambda r: (*(r[c] for c in key), r["j"])
        for r in rows:
            best[pair(r)] = max(best.get(pair(r), 0.0), r["ratio_k"] or 0.0)
        want = sorted(str(r) for r in rows if best[pair(r)] >= 0.5)
        for contrib in (far, near):
            cut = O.strength_cut(contrib, key, 0.5)
            assert sorted(cut.columns) == sorted(names)
            assert sorted(map(str, cut.select(names).collect())) == want
        assert 0 < len(want) < len(rows) == near.count()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_peaks_pass_over_nulls():
    """A depth with a null is none; a line without a depth has no peak, and others keep theirs."""
    arrays = pa.list_(pa.float64())
    batch = pa.RecordBatch.from_arrays(
        [pa.array([5000.0] * 4), pa.array([0, 0, 1, 0]), pa.array([1, 1, 1, 0]), pa.array([[0.1, None, 0.3], [None], [], [0.1]], arrays),
         pa.array([[1e10, 1e10, None], [1e10], [], [1e10]], arrays), pa.array([[2.0, 9.0, 9.0], [1.0], [], [2.0]], arrays)],
        ["wave", "_from", "_to", "a", "dnud", "ratio"])
    row, j, peaks = O._own_peaks(batch, "wave", START, STEP)
    want = [2.0 * float(voigt_np(0.1, x * STEP * C / 5000.0**2 / 1e10)) for x in (0, 1)]
    assert row.tolist() == [0, 0, 1, 1, 2, 3] and j.tolist() == [0, 1, 0, 1, 1, 0]
    assert peaks == pytest.approx([*want, -np.inf, -np.inf, -np.inf, want[0]])


def test_peaks_hold_for_their_own_name_only(spark):
    """Peaks of (id, wave) are not those of id: the cut finds the latter itself."""
    df = peaked_lines(spark)
    far, near = (O.line_opacity(df, "wave", START, STEP, N, 1e-3, "symmetric", ["id", "wave"], **more) for more in ({}, {"cluster": ["id", "wave"], "peak": True}))
    rows = lambda c, key: sorted(map(str, O.strength_cut(c, key, 0.5).select(far.columns).collect()))
    assert rows(near, ["id"]) == rows(far, ["id"]) != rows(far, ["id", "wave"])


def test_strength_cut_moves_no_points(spark, sf):
    """Neither points nor the depth arrays of lines are shuffled or sorted."""
    import __spark_entry__ as entry

    plan = entry.queries()["strength_cut"](spark, sf)._jdf.queryExecution().executedPlan().toString()
    moved = [line for line in plan.splitlines() if any(f"- {x} " in line for x in ("Exchange", "Sort", "Window"))]
    assert len(moved) >= 3 and not any(" j#" in line or "ratio_k" in line for line in moved), moved
    below = plan[plan.index("- Sort "):]
    assert "array<double>" not in below and below.index("Exchange hashpartitioning") < below.index("array("), below
