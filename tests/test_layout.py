"""A series cut into chunks gives the same rows as the plain window."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from specspark.operators import series as S
from specspark import queries  # noqa: F401
from specspark.operators.layout import arrange, following, row_numbers
from specspark.queries.common import series

KEY = ["user_id"]


def _halves(df):
    return (df.filter("event_type = 'purchase'").select("user_id", "event_id", F.col("x").alias("xt")),
            df.filter("event_type <> 'purchase'").select("user_id", "x", "y"))


def _interp(fn):
    def run(df, n):
        targets, table = _halves(df)
        return fn(targets, "xt", table, "x", "y", KEY, rows_per_chunk=n)
    return run


def _nearest(df, n):
    targets, table = _halves(df)
    return S.nearest_row(targets, "xt", table, "x", ["y"], KEY, rows_per_chunk=n)


def _unkeyed(df, n):
    targets, table = _halves(df)
    return S.interp_linear(targets, "xt", table, "x", "y", (), rows_per_chunk=n).drop("user_id")


def _following(df, n):
    lay = following(arrange(df.select("user_id", "x", "event_id"), KEY, ["x"], n), "event_id", 3, "after")
    return lay.done().withColumn("after", F.array_join("after", ","))


CASES = {
    "following": _following,
    "steps": lambda df, n: S.steps(df, KEY, "x", n),
    "log_diff": lambda df, n: S.log_diff(df, KEY, "x", "y", rows_per_chunk=n),
    "gradient": lambda df, n: S.gradient(df, KEY, "x", "y", rows_per_chunk=n),
    "every_n": lambda df, n: S.every_n(df, KEY, "x", 3, n),
    "offset": lambda df, n: S.running_offset(df, KEY, ["x"], "y", rows_per_chunk=n),
    "carry": lambda df, n: S.carry_forward(
        df.withColumn("m", F.when(F.col("event_type") == "signup", F.col("y"))), KEY, ["x"], "m", "h", n),
    "trapz": lambda df, n: S.cumulative_trapz(df, KEY, "x", "y", rows_per_chunk=n),
    "parabolic": lambda df, n: S.cumulative_parabolic(df, KEY, "x", "y", rows_per_chunk=n),
    "formal": lambda df, n: S.formal_intensity(df, KEY, "x", "y", rows_per_chunk=n),
    "formal_thin": lambda df, n: S.formal_intensity(df, KEY, "x", "y", thin=True, rows_per_chunk=n),
    "linear": _interp(S.interp_linear),
    "cubic": _interp(S.interp_cubic),
    "newton": _interp(S.interp_newton3),
    "nearest": _nearest,
    "integral": lambda df, n: S.cubic_integral(df, KEY, "x", "y", rows_per_chunk=n),
    "unkeyed": _unkeyed,
}


def _rows(df):
    cols = sorted(df.columns)
    return sorted((tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in df.select(*cols).collect()),
                  key=repr)


@pytest.mark.parametrize("name", list(CASES))
def test_chunks_change_nothing(spark, sf, name):
    # a hot key: one user owns a third of the rows
    df = series(spark, sf).withColumn(
        "user_id", F.when(F.col("event_id") % 3 == 0, F.lit(7).cast("bigint")).otherwise(F.col("user_id")))
    df = df.dropDuplicates(["user_id", "x"])
    plain, cut = _rows(CASES[name](df, 10**9)), _rows(CASES[name](df, 40))
    assert len(plain) == len(cut) > 0
    for a, b in zip(plain, cut):
        for u, v in zip(a, b):
            assert u == pytest.approx(v, rel=1e-6, abs=2e-5) if isinstance(u, float) else u == v


def test_chunks_are_bounded_and_ordered(spark, sf):
    df = series(spark, sf).withColumn("user_id", F.lit(1))
    lay = arrange(df, KEY, ["x"], 50)
    assert lay.split
    spans = lay.df.groupBy("_chunk").agg(F.count("*").alias("n"), F.min("x").alias("a"), F.max("x").alias("b"))
    rows = spans.orderBy("_chunk").collect()
    assert len(rows) > 10 and max(r["n"] for r in rows) <= 100
    assert all(p["b"] < q["a"] for p, q in zip(rows, rows[1:]))


def test_formal_intensity_of_a_linear_source(spark):
    """S = a + b*tau gives I = a + b; the sampling error stays under one per cent."""
    rows = [(1, 10 ** (-6 + 0.05 * i), 2.0 + 3.0 * 10 ** (-6 + 0.05 * i)) for i in range(161)]
    df = spark.createDataFrame(rows, "k int, tau double, s double")
    got = S.formal_intensity(df, ["k"], "tau", "s").first()["intensity"]
    assert got == pytest.approx(5.0, rel=0.01)


def test_following_over_short_chunks(spark):
    df = spark.createDataFrame([(1, float(i), i) for i in range(200)], "user_id int, x double, event_id int")
    lay = following(arrange(df, KEY, ["x"], 2), "event_id", 3, "after")
    assert lay.split
    assert all(r["after"] == list(range(r["event_id"] + 1, min(r["event_id"] + 4, 200))) for r in lay.df.collect())


@pytest.mark.parametrize("shape", ["outlier", "equal", "steps", "even"])
@pytest.mark.parametrize("key", [KEY, []])
def test_no_chunk_holds_twice_its_rows(spark, shape, key):
    """However x is spread, and with the rest of the order alone where x is equal."""
    x = {"outlier": F.when(F.col("id") == 0, 1e15).otherwise(F.col("id") / 1e6), "equal": F.lit(5.0),
         "steps": F.floor(F.col("id") / 25_000) * 1.0, "even": F.col("id") * 1.0}[shape]
    df = spark.range(100_000).select(F.lit(1).alias("user_id"), x.alias("x"), "id")
    lay = arrange(df, key, ["x", "id"], 1000)
    counts = [r["count"] for r in lay.df.groupBy("_chunk").count().collect()]
    assert lay.split and sum(counts) == 100_000 and max(counts) <= 2000 and len(counts) >= 80
    numbered = row_numbers(lay, "place").done()
    assert numbered.agg(F.countDistinct("place"), F.min("place"), F.max("place")).first()[:] == (100_000, 1, 100_000)
    after = F.lead(F.struct("x", "id")).over(Window.orderBy("place"))
    assert numbered.withColumn("after", after).filter(F.struct("x", "id") >= F.col("after")).isEmpty()


NO_PAIRS = ["trilinear", "interp2d", "limb_profile", "assign_segment", "interp_linear_2", "filter_on_spectrum", "bracket"]


@pytest.mark.parametrize("name", NO_PAIRS)
def test_intervals_are_found_without_pairs(spark, sf, name):
    from specspark.registry import QUERIES

    plan = QUERIES[name](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
