"""Targets without a value lie in no interval, whichever way the table is joined."""

import pytest

from specspark.operators import series


@pytest.mark.parametrize("small", [True, False])
def test_null_targets(spark, small):
    from pyspark.sql import Window
    from pyspark.sql import functions as F

    table = spark.createDataFrame([(1, float(i), float(i * i)) for i in range(50)], "k int, x double, y double")
    targets = spark.createDataFrame([(1, 3.5), (1, None), (1, 48.5)], "k int, t double")
    intervals = table.withColumns({"_hi": F.lead("x").over(Window.partitionBy("k").orderBy("x")), "_lowest": F.col("x") == 0})
    out = series.attach_interval(targets, "t", intervals, "x", ["k"], ["y"], small=small)
    assert {r.t: (r._hit.y if r._hit else None) for r in out.collect()} == {3.5: 9.0, None: None, 48.5: 2304.0}
