"""Documents to packed training sequences: quality, near-duplicates, repeated passages, mix, packing."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from specspark.llm import circulant_minhash, entropy_mix, fit_packing, quality_gam, suffix_dedup
from specspark.llm.registry import table
from specspark.llm.shared import cut

#: A passage that may not repeat: 50 words of 4.8 bytes, separators included.
PASSAGE_BYTES = 240


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go; it learns from the labels of the documents that are there."""
    return quality_gam.accepted(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays: five words, similarity 0.8."""
    return circulant_minhash.deduplicated(docs, width=5, percent=80)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bytes of strings of PASSAGE_BYTES that repeat go; the documents stay."""
    return suffix_dedup.shortened(docs, length=PASSAGE_BYTES)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix of the sources takes it."""
    return entropy_mix.mixed_documents(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of every piece of every document in the sequences."""
    return fit_packing.pack(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality), ("near_duplicates", near_duplicates), ("repeated_passages", repeated_passages), ("mix", mix), ("packing", packing)]

#: SQL can't express the classifier, the suffix arrays or the Newton steps; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
