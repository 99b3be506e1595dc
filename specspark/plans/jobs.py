"""Bookkeeping of a grid run as table jobs: what is done, what can run, what must be interpolated."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from specspark.functions.names import format_model_name
from specspark.operators.grid import blend_corners, corners, missing_corners


def base_name(teff: str = "teff", logg: str = "logg", feh: str = "feh", turb: str = "turb") -> Column:
    return format_model_name(F.col(teff), F.col(logg), F.col(feh), F.col(turb), ext="")


def skip_done(jobs: DataFrame, outputs: DataFrame, key: Sequence[str], n_outputs: int = 1, force: bool = False) -> DataFrame:
    """Jobs that still have to run: those for which fewer than ``n_outputs`` distinct outputs exist."""
    if force:
        return jobs
    done = outputs.groupBy(*key).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") >= n_outputs)
    return jobs.join(done.select(*key), list(key), "left_anti")


def pending_jobs(grid: DataFrame, outputs: DataFrame, key: Sequence[str]) -> DataFrame:
    """Distinct grid keys without an output."""
    return grid.select(*key).distinct().join(outputs.select(*key), list(key), "left_anti")


def plan_jobs(grid: DataFrame, models: DataFrame, outputs: DataFrame, force: bool = False) -> DataFrame:
    """run_log(base_name, params, status, message) for every distinct grid point.

    skipped: its output exists (unless forced).  ready: a model of its name exists.  interpolate: all 8
    corner models exist.  error: a corner is missing, and named.
    models needs teff, logg, feh, turb, path, cat_pos; outputs needs base_name.
    """
    points = grid.select("teff", "logg", "feh", "turb").distinct().withColumn("base_name", base_name())
    names = models.select(base_name().alias("base_name")).distinct().withColumn("_model", F.lit(True))
    done = outputs.select("base_name").distinct().withColumn("_done", F.lit(not force))
    state = points.join(done, "base_name", "left").join(names, "base_name", "left")
    lacking = points.join(names, "base_name", "left_anti")
    missing = missing_corners(corners(lacking, "base_name", models), "base_name")
    state = state.join(missing.select("base_name", F.col("message").alias("_missing")), "base_name", "left")
    status = (F.when(F.coalesce("_done", F.lit(False)), "skipped").when(F.col("_model").isNotNull(), "ready")
              .when(F.col("_missing").isNull(), "interpolate").otherwise("error"))
    message = F.when(F.col("status") == "skipped", "Output already exists").when(
        F.col("status") == "error", F.concat(F.lit("Model missing and interpolation failed: "), F.col("_missing"))).otherwise("")
    return state.withColumn("status", status).select(
        "base_name", F.struct("teff", "logg", "feh", "turb").alias("params"), "status", message.alias("message"))


def interpolate_missing(plan: DataFrame, models: DataFrame, depths: DataFrame, quantities: Sequence[str],
                        model: str = "model_id", level: str = "k", optimize: bool = True) -> DataFrame:
    """Blend every point the plan marks 'interpolate' in one job; other points are not touched."""
    points = plan.filter("status = 'interpolate'").select("base_name", "params.*")
    return blend_corners(corners(points, "base_name", models), "base_name", depths, model, [level], quantities, optimize)


def status_counts(run_log: DataFrame) -> DataFrame:
    """Jobs per status, in the order of the status."""
    return run_log.groupBy("status").agg(F.count(F.lit(1)).alias("n")).orderBy("status")


def run_summary(run_log: DataFrame) -> DataFrame:
    """Text rows (pos, base_name, value): two header rows, then one row per job."""
    counts = run_log.groupBy("status").agg(F.count(F.lit(1)).alias("n"))
    # one row per status, so the header list is short whatever the number of jobs
    head = counts.agg(
        F.format_string("Total grid points: %d", F.coalesce(F.sum("n"), F.lit(0).cast("bigint"))).alias("total"),
        F.concat(F.lit("Status counts: "), F.array_join(F.transform(
            F.array_sort(F.collect_list(F.struct("status", "n"))),
            lambda s: F.concat(s["status"], F.lit("="), s["n"].cast("string"))), ", ")).alias("counts"))
    none = F.lit(None).cast("string")
    header = head.select(F.inline(F.array(
        F.struct(F.lit(0).alias("pos"), none.alias("base_name"), F.col("total").alias("value")),
        F.struct(F.lit(1).alias("pos"), none.alias("base_name"), F.col("counts").alias("value")))))
    p = F.col("params")
    line = F.format_string("%s %s (Teff=%s, logg=%s, FeH=%s, turb=%s): %s", F.rpad(F.upper("status"), 9, " "), "base_name",
                           p["teff"].cast("string"), p["logg"].cast("string"), p["feh"].cast("string"), p["turb"].cast("string"), "message")
    return header.unionByName(run_log.select(F.lit(2).alias("pos"), "base_name", line.alias("value")))


def distinct_sorted(df: DataFrame, col: str) -> DataFrame:
    return df.select(col).distinct().orderBy(col)


def unique_values(df: DataFrame, *cols: str) -> DataFrame:
    return df.select(*cols).distinct()


def limit_rows(df: DataFrame, order: Sequence[str], n: int) -> DataFrame:
    """The first n rows of a total order."""
    return df.orderBy(*order).limit(n)


def order_axis(df: DataFrame, key: Sequence[str], x: str) -> DataFrame:
    """Rows of every series by increasing x."""
    return df.orderBy(*key, x)
