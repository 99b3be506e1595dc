"""Views of the driver's tables under the names the operators use."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

START = "2024-01-01 00:00:00"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def rnd(c: Column | str, n: int = 4) -> Column:
    return F.round(F.col(c) if isinstance(c, str) else c, n)


def row_text(rows: Sequence[Column], i: str = "i") -> Column:
    """The i-th of the rows; the others are not evaluated."""
    return reduce(lambda acc, r: acc.when(F.col(i) == r[0], r[1]), enumerate(rows[1:], 1), F.when(F.col(i) == 0, rows[0]))


def series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as one series per user: x in days from the start of the table, y the value."""
    # a difference of two local times: the session time zone does not matter
    days = F.timestamp_diff("MICROSECOND", F.lit(START).cast("timestamp_ntz"), F.col("ts")) / F.lit(8.64e10)
    return table(spark, sf_dir, "events").select("user_id", "event_id", "event_type", days.alias("x"),
                                                 F.col("value").alias("y"))


SERIES_SQL = """s AS (SELECT user_id, event_id, event_type,
  (epoch_us(ts) - 1704067200000000) / 8.64e10 AS x, value AS y FROM events)"""


def packed_spectra(spark: SparkSession, sf_dir: str, wave0: float = 4000.0, step: float = 10.0) -> DataFrame:
    """embeddings as one spectrum per row: arrays wave and flux."""
    e = table(spark, sf_dir, "embeddings")
    wave = F.transform(F.sequence(F.lit(0), F.size("embedding") - 1), lambda i: F.lit(wave0) + i * F.lit(step))
    flux = F.transform("embedding", lambda v: F.lit(1.0) + F.lit(0.2) * v.cast("double"))
    return e.select(F.col("vec_id").alias("spec_id"), "label", wave.alias("wave"), flux.alias("flux"))


def spectra(spark: SparkSession, sf_dir: str, wave0: float = 4000.0, step: float = 10.0) -> DataFrame:
    """The same, one row per point, with its 0-based position."""
    p = packed_spectra(spark, sf_dir, wave0, step)
    return p.select("spec_id", "label", F.posexplode(F.arrays_zip("wave", "flux")).alias("i", "pt")).select(
        "spec_id", "label", "i", "pt.wave", "pt.flux")


def spectra_sql(wave0: float = 4000.0, step: float = 10.0) -> str:
    return f"""sp AS (SELECT vec_id AS spec_id, label, i::INTEGER AS i, {wave0}::DOUBLE + i * {step}::DOUBLE AS wave,
  1.0::DOUBLE + 0.2::DOUBLE * e::DOUBLE AS flux
  FROM (SELECT vec_id, label, unnest(embedding) AS e, unnest(range(len(embedding))) AS i FROM embeddings))"""


SPECTRA_SQL = spectra_sql()


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem as a line list, one species per supplier."""
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", F.col("l_suppkey").alias("species_id"),
        F.col("l_extendedprice").alias("wave"), (F.col("l_discount") * 50).alias("chi_low"),
        (F.col("l_tax") * -20).alias("log_gf"), F.col("l_quantity").alias("strength"))


LINES_SQL = """ln AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey AS species_id,
  l_extendedprice AS wave, l_discount * 50 AS chi_low, l_tax * -20 AS log_gf, l_quantity AS strength FROM lineitem)"""

LINE_KEY = ["l_orderkey", "l_linenumber", "l_partkey", "species_id", "wave"]
