"""Incremental ingest of new files, and counts over a growing run log."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from specspark.session import new_folder, shared_folder  # noqa: F401


def incremental_ingest(stream: DataFrame, transform: Callable[[DataFrame], DataFrame], table: str,
                       checkpoint: str) -> StreamingQuery:
    """Append transform(new rows) to ``table`` and stop when nothing is left."""
    return ingest_tables(stream, lambda batch: [transform(batch)], [table], checkpoint)


def ingest_tables(stream: DataFrame, transform: Callable[[DataFrame], Sequence[DataFrame]], tables: Sequence[str],
                  checkpoint: str) -> StreamingQuery:
    """Append each DataFrame of transform(new rows) to its table and stop when nothing is left.

    Each micro-batch overwrites its own batch_id folders, so a batch that is repeated after a failure does
    not add its rows twice.  It counts as done when all its tables are written.
    """
    def append(batch: DataFrame, batch_id: int) -> None:
        batch.persist()  # read once, whatever the number of tables
        try:
            for rows, table in zip(transform(batch), tables, strict=True):
                rows.write.mode("overwrite").parquet(f"{table}/batch_id={batch_id}")
        finally:
            batch.unpersist()

    return (stream.writeStream.foreachBatch(append).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def text_stream(spark: SparkSession, source: str, glob: str) -> DataFrame:
    """New text files as rows (file, block, value); ``with_position`` completes them inside a batch."""
    return spark.readStream.format("text").schema("value string").option("pathGlobFilter", glob).load(source).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value")


def with_position(batch: DataFrame) -> DataFrame:
    return batch.withColumn("pos", F.monotonically_increasing_id())


def ingest_spectra(spark: SparkSession, source: str, table: str, checkpoint: str, intensity: str | None = None,
                   glob: str = "*.spec") -> StreamingQuery:
    """New spectrum files, each file once: spectra into ``table``, intensities into ``intensity`` (by default
    the folder <table>_intensity)."""
    from specspark.sources.spectra import parse_spectra

    return ingest_tables(text_stream(spark, source, glob), lambda b: parse_spectra(with_position(b)),
                         [table, intensity or f"{table.rstrip('/')}_intensity"], checkpoint)


def ingest_linelists(spark: SparkSession, source: str, table: str, checkpoint: str, glob: str = "*") -> StreamingQuery:
    """New line-list files into the table of lines, each file once; duplicate lines are kept."""
    from specspark.sources.linelists import parse_linelist

    return incremental_ingest(text_stream(spark, source, glob), lambda b: parse_linelist(with_position(b)), table, checkpoint)


def _versions(spark: SparkSession, table: str) -> DataFrame:
    return spark.read.schema("version long, rows long").json(f"{table}/finished")


def upsert_counts(stream: DataFrame, key: Sequence[str], table: str, checkpoint: str) -> StreamingQuery:
    """Keep the rows of ``stream`` counted by ``key`` in ``table``, and stop when nothing is left.

    A micro-batch counts its own rows, adds them to the counts of the last finished batch before it, key by key, and writes the
    sums as version <batch_id>; then it marks the version as finished. Only counts move, never rows, and nothing
    passes through the driver. A batch that is repeated after a failure starts from the same earlier version and
    overwrites its own, so it changes nothing. ``read_counts`` gives the last finished version.
    """
    def merge(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        new = batch.groupBy(*key).agg(F.count(F.lit(1)).alias("n"))
        if batch_id > 0:
            last = _versions(spark, table).filter(F.col("version") < batch_id).agg(F.max("version")).first()[0]
            if last is not None:
                old = spark.read.schema(new.schema).parquet(f"{table}/counts/version={last}")
                new = new.unionByName(old).groupBy(*key).agg(F.sum("n").alias("n"))
        path = f"{table}/counts/version={batch_id}"
        new.write.mode("overwrite").parquet(path)
        done = spark.read.schema(new.schema).parquet(path).agg(F.lit(batch_id).cast("long").alias("version"), F.count(F.lit(1)).alias("rows"))
        done.coalesce(1).write.mode("overwrite").json(f"{table}/finished/batch={batch_id}")

    return (stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def read_counts(spark: SparkSession, key_schema: str, table: str) -> DataFrame:
    """The counts of the last finished batch of ``upsert_counts``; no rows before the first."""
    schema = f"{key_schema}, n long"
    try:
        last = _versions(spark, table).agg(F.max("version")).first()[0]
    except AnalysisException:  # nothing has been written yet
        last = None
    return spark.createDataFrame([], schema) if last is None else spark.read.schema(schema).parquet(f"{table}/counts/version={last}")


def job_progress(spark: SparkSession, log: DataFrame, table: str, checkpoint: str) -> DataFrame:
    """Status counts of a streaming run log (column ``status``), brought up to date in ``table``."""
    upsert_counts(log, ["status"], table, checkpoint).awaitTermination()
    return read_counts(spark, "status string", table)
