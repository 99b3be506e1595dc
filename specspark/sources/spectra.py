"""Spectrum files: flux only, or with intensities at the angles named in a header row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from specspark.operators.layout import ROWS_PER_CHUNK, arrange, maybe_broadcast, row_numbers, running_sum
from specspark.sources.text import base_name, read_rows, save_rows


def spectrum_rows(raw: DataFrame) -> DataFrame:
    """(spec_id, wave, flux_norm, flux_abs, points) from text rows (file, block, pos, value); points is null
    for flux spectra and else the array of (mu, i_abs, i_norm).

    The header is the last '#' row before the first data row.  A row whose first three words, or any of
    the intensity words it has, are not numbers is dropped whole; angles a row has no columns for are
    left out.
    """
    at = F.struct("block", "pos")
    text = F.trim("value")
    starts = raw.filter((text != "") & ~F.startswith(text, F.lit("#"))).groupBy("file").agg(F.min(at).alias("_start"))
    marks = raw.filter(F.startswith(text, F.lit("#"))).select("file", at.alias("_at"), "value")
    header = marks.join(starts, "file").filter("_at < _start").groupBy("file").agg(
        F.max_by("value", "_at").alias("_header"))
    words = F.split(F.trim("_header"), r"\s+")
    after = F.array_position(words, F.lit("mu-points")).cast("int")
    angles = F.when(after > 0, F.transform(F.slice(words, after + 1, F.greatest(F.size(words) - after, F.lit(0))),
                                           lambda w: w.try_cast("double")))
    header = header.select("file", angles.alias("_mu"))
    rows = raw.filter((text != "") & ~F.startswith(text, F.lit("#"))).join(maybe_broadcast(header), "file", "left")
    rows = rows.withColumn("_v", F.transform(F.split(text, r"\s+"), lambda w: w.try_cast("double")))
    wanted = F.least(F.size("_v"), 3 + 2 * F.coalesce(F.size("_mu"), F.lit(0)))
    wanted = F.when(F.col("_mu").isNull(), 3).otherwise(wanted)
    rows = rows.filter((F.size("_v") >= 3) & ~F.exists(F.slice("_v", F.lit(1), wanted), lambda v: v.isNull()))
    v = F.col("_v")
    pairs = F.filter(F.transform(F.col("_mu"), lambda m, i: F.struct(
        m.alias("mu"), F.get(v, 3 + 2 * i).alias("i_abs"), F.get(v, 4 + 2 * i).alias("i_norm"))),
        lambda p: p["i_abs"].isNotNull() | p["i_norm"].isNotNull())
    return rows.select(F.col("file").alias("spec_id"), v[0].alias("wave"), v[1].alias("flux_norm"), v[2].alias("flux_abs"),
                       pairs.alias("points"))


def parse_spectra(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(spectrum, intensity) tables from text rows."""
    rows = spectrum_rows(raw)
    return rows.drop("points"), rows.filter("points IS NOT NULL").select("spec_id", "wave", F.inline("points"))


def read_spectra(spark: SparkSession, paths: str | Sequence[str], glob: str | None = None) -> tuple[DataFrame, DataFrame]:
    return parse_spectra(read_rows(spark, paths, glob))


def load_all_spectra(spark: SparkSession, directories: str | Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Every *.spec file of the directories, keyed by file name."""
    raw = read_rows(spark, directories, "*.spec")
    return parse_spectra(raw.withColumn("file", base_name(F.col("file"))))


def render_spectra(spectrum: DataFrame, intensity: DataFrame | None = None) -> DataFrame:
    """Text rows (spec_id, pos, value): an optional '# mu-points' row, then one row per wavelength.

    The angles of one wavelength are few and are collected per (spectrum, wavelength).
    """
    flux = F.format_string("%11.3f %10.5f %12.5E", "wave", "flux_norm", "flux_abs")
    if intensity is None:
        return spectrum.select("spec_id", F.col("wave").alias("pos"), flux.alias("value"))
    per = intensity.groupBy("spec_id", "wave").agg(F.array_sort(F.collect_list(F.struct("mu", "i_abs", "i_norm"))).alias("_i"))
    cells = F.array_join(F.transform("_i", lambda p: F.format_string(" %12.5E %8.5f", p["i_abs"], p["i_norm"])), "")
    rows = spectrum.join(per, ["spec_id", "wave"]).select(
        "spec_id", F.col("wave").alias("pos"), F.concat(flux, cells).alias("value"))
    first = per.groupBy("spec_id").agg(F.min_by("_i", "wave").alias("_i"))
    marks = F.array_join(F.transform("_i", lambda p: F.format_string(" %13.6E", p["mu"])), "")
    head = first.select("spec_id", F.lit(float("-inf")).alias("pos"), F.concat(F.lit("# mu-points "), marks).alias("value"))
    return head.unionByName(rows)


def write_spectra(spectrum: DataFrame, path: str, intensity: DataFrame | None = None) -> None:
    save_rows(render_spectra(spectrum, intensity), path, "spec_id", ["pos"])


def render_rows_of_n(spectrum: DataFrame, key: Sequence[str], wave: str, flux: str, n: int = 10,
                     rows_per_chunk: int = ROWS_PER_CHUNK) -> DataFrame:
    """(key, pos, value): a header row (first wavelength, last, step), then 1 - flux, n numbers per row."""
    lay = row_numbers(arrange(spectrum, key, [wave], rows_per_chunk), "_rn")
    cell = F.struct("_rn", F.format_string("%7.4f", 1 - F.col(flux)).alias("t"))
    body = lay.df.groupBy(*lay.key, F.floor((F.col("_rn") - 1) / n).alias("pos")).agg(
        F.array_sort(F.collect_list(cell)).alias("_c"))
    body = body.select(*key, "pos", F.array_join(F.transform("_c", lambda c: c["t"]), "").alias("value"))
    ends = lay.df.groupBy(*lay.key).agg(F.min(wave).alias("_a"), F.max(wave).alias("_b"),
                                        F.min(F.when(F.col("_rn") == 2, F.col(wave))).alias("_second"))
    head = ends.select(*key, F.lit(-1).cast("bigint").alias("pos"), F.format_string(
        "%10.2f%10.2f%10.2f%10.2f", "_a", "_b", F.col("_second") - F.col("_a"), F.lit(0.0)).alias("value"))
    return head.unionByName(body)


def unpack_series(df: DataFrame, key: Sequence[str], order: Sequence[str], values: str, start: Column, step: Column,
                  rows_per_chunk: int = ROWS_PER_CHUNK) -> DataFrame:
    """Blocks of values on one regular axis: x = start + step*pixel, the pixel count running over the
    blocks of a key in order."""
    lay = running_sum(arrange(df, key, order, rows_per_chunk), F.size(values), "_before", include_current=False)
    rows = lay.df.select(*key, "_before", start.alias("_s"), step.alias("_d"), F.posexplode(values).alias("_i", "y"))
    pixel = F.col("_before") + F.col("_i")
    return rows.select(*key, pixel.alias("pixel"), (F.col("_s") + F.col("_d") * pixel).alias("x"), "y")

