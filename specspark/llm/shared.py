"""Lineage cuts in the cluster's shared folder, and ranks that survive hot keys."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: A word: a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]++"


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir of the session. A local session without the setting gets
    a folder of its own; on a cluster the setting is required."""
    sc = spark.sparkContext
    found = sc.getCheckpointDir()
    if found:
        return found
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        named = tempfile.mkdtemp(prefix="shared-")
    sc.setCheckpointDir(named)
    return sc.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """Write df as a table in the shared folder and read it back: its lineage ends there, and a lost executor costs
    nothing that was finished."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def few(df: DataFrame, rows: int) -> bool:
    """True if df has at most `rows` rows."""
    return df.limit(rows + 1).count() <= rows


def maybe_broadcast(df: DataFrame, rows: int) -> DataFrame:
    """df with a broadcast hint if it has at most `rows` rows."""
    return F.broadcast(df) if few(df, rows) else df


def n_words(text: Column) -> Column:
    """Words of the whole text as a long; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def chunk_counts(df: DataFrame, keys: list[str], chunk: str = "_c") -> DataFrame:
    """Rows of each (keys, chunk), and in _off the rows of the key in the chunks before it. A key has as many rows here
    as chunks, however many rows it has in df."""
    counts = df.groupBy(*keys, chunk).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*keys).orderBy(chunk).rowsBetween(Window.unboundedPreceding, -1)
    return counts.withColumn("_off", F.coalesce(F.sum("_n").over(before), F.lit(0)))


def rank_in_chunk(df: DataFrame, keys: list[str], order: list[str], chunk: str = "_c", out: str = "_rank") -> DataFrame:
    """0-based number of the row in its (keys, chunk)."""
    return df.withColumn(out, F.row_number().over(Window.partitionBy(*keys, chunk).orderBy(*order)) - F.lit(1))


def spread_rank(df: DataFrame, keys: list[str], order: list[str], by: str, salts: int, out: str = "_rank") -> DataFrame:
    """0-based number of the row among the rows equal in keys (not null), dealt over `salts` chunks by the long `by`, so
    that no key meets in one task. df is read twice."""
    dealt = df.withColumn("_c", F.pmod(F.col(by), F.lit(salts)))
    counts = chunk_counts(dealt, keys).drop("_n")
    ranked = rank_in_chunk(dealt, keys, order, out=out).join(counts, [*keys, "_c"])
    return ranked.withColumn(out, F.col(out) + F.col("_off")).drop("_c", "_off")
