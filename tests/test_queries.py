"""Every registered query against its SQL on the smallest tables."""

import pytest

import __spark_entry__ as entry
import compare

from specspark.registry import ORACLES, QUERIES


@pytest.fixture(scope="module")
def con(sf):
    return compare.connect(sf)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, sf, name):
    result = compare.check(name, spark, con, sf, QUERIES, ORACLES)
    assert result["ok"], result["why"]


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and set(df.columns) == {"spec_id", "eqw", "open_wing"}


def test_every_query_has_sql():
    assert set(ORACLES) == set(QUERIES)
