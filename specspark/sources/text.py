"""Text access: ordered rows of large files, whole small files, and blank-separated tokens."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TOKEN = r"('[^']*'|[^\s,']+)"


def read_rows(spark: SparkSession, paths: str | Sequence[str], glob: str | None = None) -> DataFrame:
    """(file, block, pos, value) for every text row.

    Files stay splittable: a split is read by one task from its start offset (``block``) on, and ``pos``
    grows inside a task, so (block, pos) orders the rows of a file without putting it into one task.
    """
    reader = spark.read.option("pathGlobFilter", glob) if glob else spark.read
    return reader.text(paths).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("pos"), "value")


def read_saved(spark: SparkSession, path: str, file: str) -> DataFrame:
    """Rows written by ``save_rows``: the consecutive parts of one partition directory are one file again."""
    raw = spark.read.text(path).select(
        F.col(file).cast("string").alias("file"),
        F.regexp_extract("_metadata.file_name", r"part-(\d+)", 1).cast("bigint").alias("_part"),
        F.col("_metadata.file_block_start").alias("_start"), F.monotonically_increasing_id().alias("pos"), "value")
    return raw.select("file", (F.col("_part") * F.lit(1 << 40) + F.col("_start")).alias("block"), "pos", "value")


def read_whole(spark: SparkSession, paths: str | Sequence[str], glob: str | None = None) -> DataFrame:
    """(file, text), one row per file, for formats whose files are bounded (one model, one table)."""
    reader = spark.read.option("pathGlobFilter", glob) if glob else spark.read
    return reader.text(paths, wholetext=True).select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("text"))


def rows_of(text: Column) -> Column:
    """The rows of a whole file without a trailing empty one."""
    return F.split(F.regexp_replace(text, r"(\r?\n)+$", ""), r"\r?\n")


def tokens(row: Column) -> Column:
    """Blank- or comma-separated words; a quoted string is one word and keeps its quotes."""
    return F.regexp_extract_all(row, F.lit(TOKEN), 1)


def unquote(word: Column) -> Column:
    return F.trim(F.translate(word, "'", ""))


def number(word: Column) -> Column:
    """A number, also with a D exponent; null if the word is something else."""
    return F.translate(word, "dD", "EE").try_cast("double")


def numbers(row: Column) -> Column:
    return F.transform(tokens(row), number)


def whole(word: Column) -> Column:
    return number(word).cast("int")


def base_name(file: Column) -> Column:
    return F.element_at(F.split(file, "/"), -1)


def save_rows(rows: DataFrame, path: str, file: str, order: Sequence[str], mode: str = "errorifexists") -> None:
    """Write text rows (file, *order, value) under path/<file>=.../, ordered.

    A range partitioning on (file, order) cuts a large file into consecutive parts instead of sending it
    to one task.
    """
    rows.repartitionByRange(file, *order).sortWithinPartitions(file, *order).select(file, "value") \
        .write.mode(mode).partitionBy(file).text(path)


def save_whole(texts: DataFrame, path: str, file: str = "file", mode: str = "errorifexists") -> None:
    """Write (file, text) as one small text file per row."""
    texts.select(file, F.col("text").alias("value")).write.mode(mode).partitionBy(file).text(path)
