"""Run bookkeeping, sorts, set operations and the streaming jobs."""

from __future__ import annotations


from pyspark.sql import functions as F

from specspark.plans import jobs as J
from specspark.queries.common import rnd, spectra, table
from specspark.queries.grids import BLEND_SQL, CORNERS_SQL, _blend_sql
from specspark.registry import query
from specspark.streaming import ingest as I


@query("skip_done", """SELECT o_orderkey, o_orderstatus AS status FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem GROUP BY 1 HAVING count(*) >= 2)""")
def skip_done(spark, d):
    jobs = table(spark, d, "orders").select("o_orderkey", F.col("o_orderstatus").alias("status"))
    outputs = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    return J.skip_done(jobs, outputs, ["o_orderkey"], 2)


@query("pending_jobs", """SELECT DISTINCT o_custkey FROM orders WHERE o_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')""")
def pending_jobs(spark, d):
    o = table(spark, d, "orders")
    return J.pending_jobs(o, o.filter("o_orderstatus = 'F'"), ["o_custkey"])


# Teff in steps of 100 K; every second point lies between two models
PLAN_SQL = CORNERS_SQL.replace("l_quantity AS teff", "l_quantity * 100 AS teff").replace("p_size + 0.25 AS teff", "p_size * 100 + (p_partkey % 2) * 50 AS teff") \
    .replace("(p_partkey % 45) / -10.0::DOUBLE AS feh", "(p_partkey % 45) / -10.0::DOUBLE + 0.0 AS feh") + """,
 na AS (SELECT DISTINCT turb, teff, round(logg * 10) AS g, round(feh * 100) AS z FROM mo),
 mi AS (SELECT p_partkey, arg_min(concat('Missing grid point: Teff=', c_teff::DOUBLE, ', logg=', c_logg, ', FeH=', c_feh + 0.0), corner) AS message FROM cr WHERE NOT found GROUP BY 1),
 st AS (SELECT pt.*, CASE WHEN p_size > 44 THEN 'skipped' WHEN na.turb IS NOT NULL THEN 'ready' WHEN mi.message IS NULL THEN 'interpolate' ELSE 'error' END AS status, mi.message
   FROM pt JOIN part USING (p_partkey) LEFT JOIN na ON na.turb = pt.turb AND na.teff = pt.teff AND na.g = round(pt.logg * 10) AND na.z = round(pt.feh * 100) LEFT JOIN mi USING (p_partkey))"""


def _grid(spark, d):
    k = F.col("p_partkey")
    return table(spark, d, "part").select(
        k, F.col("p_size"), F.when(k % 3 == 0, "A").when(k % 3 == 1, "N").otherwise("R").alias("turb"), (F.col("p_size") * 100 + (k % 2) * 50).cast("double").alias("teff"),
        ((k % 60) / F.lit(10.0)).alias("logg"), ((k % 45) / F.lit(-10.0) + F.lit(0.0)).alias("feh"))


def _models(spark, d):
    return table(spark, d, "lineitem").select(
        F.col("l_returnflag").alias("turb"), (F.col("l_quantity") * 100).alias("teff"), (F.col("l_discount") * 50).alias("logg"),
        (F.col("l_tax") * -50 + F.lit(0.0)).alias("feh"), F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey").alias("path"),
        F.struct("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice").alias("cat_pos"))


def _plan(spark, d):
    grid = _grid(spark, d)
    outputs = grid.filter("p_size > 44").select(J.base_name().alias("base_name"))
    return J.plan_jobs(grid, _models(spark, d), outputs)


@query("plan_jobs", f"""WITH {PLAN_SQL} SELECT DISTINCT turb, teff::DOUBLE AS teff, logg, feh, status, CASE status WHEN 'skipped' THEN 'Output already exists' WHEN 'error' THEN concat('Model missing and interpolation failed: ', message) ELSE '' END AS message FROM st""")
def plan_jobs(spark, d):
    return _plan(spark, d).select("params.turb", "params.teff", "params.logg", "params.feh", "status", "message")


@query("run_summary", f"""WITH {PLAN_SQL}, dj AS (SELECT DISTINCT turb, teff, logg, feh, status FROM st), c AS (SELECT status, count(*) AS n FROM dj GROUP BY 1)
SELECT 0 AS pos, concat('Total grid points: ', sum(n)) AS value, 1::BIGINT AS n FROM c UNION ALL SELECT 1, concat('Status counts: ', string_agg(concat(status, '=', n), ', ' ORDER BY status)), 1 FROM c
UNION ALL SELECT 2, rpad(upper(status), 9, ' '), count(*) FROM dj GROUP BY status""")
def run_summary(spark, d):
    s = J.run_summary(_plan(spark, d))
    value = F.when(F.col("pos") == 2, F.substring("value", 1, 9)).otherwise(F.col("value"))
    return s.groupBy("pos", value.alias("value")).agg(F.count(F.lit(1)).alias("n"))


@query("interpolate_missing", f"""WITH {BLEND_SQL.replace("p_size + 0.25 AS teff", "p_size + (p_partkey % 2) * 0.5 AS teff").replace("(p_partkey % 45) / -10.0::DOUBLE AS feh", "(p_partkey % 45) / -10.0::DOUBLE + 0.0 AS feh")},
 jo AS (SELECT co.*, ce.k, ce.temp FROM co JOIN ce ON c_teff = ce.teff AND c_logg = ce.logg AND c_feh = ce.feh)
SELECT turb, teff::DOUBLE AS teff, logg, feh, k, round({_blend_sql('temp', None)}, 3) AS temp FROM jo WHERE p_partkey % 2 = 1 GROUP BY p_partkey, turb, teff, logg, feh, k""")
def interpolate_missing(spark, d):
    from specspark.queries.grids import _cells
    _, depths = _cells(spark, d)
    grid = _grid(spark, d).withColumn("turb", F.lit("all")).withColumn("teff", F.col("teff") / 100)
    li = table(spark, d, "lineitem")
    name = F.concat_ws("_", F.col("l_quantity").cast("string"), (F.col("l_discount") * 50).cast("string"), (F.col("l_tax") * -50 + F.lit(0.0)).cast("string"))
    models = li.select(F.lit("all").alias("turb"), F.col("l_quantity").alias("teff"), (F.col("l_discount") * 50).alias("logg"),
                       (F.col("l_tax") * -50 + F.lit(0.0)).alias("feh"), name.alias("path"), name.alias("cat_pos")).distinct()
    plan = grid.select(F.col("p_partkey").cast("string").alias("base_name"), F.struct("teff", "logg", "feh", "turb").alias("params"),
                       F.when(F.col("p_partkey") % 2 == 1, "interpolate").otherwise("ready").alias("status"))
    out = J.interpolate_missing(plan, models, depths, ["temp"], optimize=False)
    return out.join(plan.hint("merge"), "base_name").select("params.turb", "params.teff", "params.logg", "params.feh", "k", rnd("temp", 3).alias("temp"))


def _run_log(spark, d):
    return table(spark, d, "orders").select(F.col("o_orderkey").cast("string").alias("base_name"), F.col("o_orderstatus").alias("status"))


COUNTS_SQL = "SELECT o_orderstatus AS status, count(*) AS n FROM orders GROUP BY 1"


@query("status_counts", COUNTS_SQL)
def status_counts(spark, d):
    return J.status_counts(_run_log(spark, d))


@query("sort_status", COUNTS_SQL + " ORDER BY 1")
def sort_status(spark, d):
    return J.status_counts(_run_log(spark, d))


@query("distinct_sorted", "SELECT DISTINCT l_discount FROM lineitem ORDER BY 1")
def distinct_sorted(spark, d):
    return J.distinct_sorted(table(spark, d, "lineitem"), "l_discount")


@query("unique_values", "SELECT DISTINCT l_quantity, l_tax FROM lineitem")
def unique_values(spark, d):
    return J.unique_values(table(spark, d, "lineitem"), "l_quantity", "l_tax")


@query("limit_rows", "SELECT l_extendedprice, l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem ORDER BY ALL LIMIT 100")
def limit_rows(spark, d):
    cols = ["l_extendedprice", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    return J.limit_rows(table(spark, d, "lineitem").select(*cols), cols, 100)


@query("order_axis", "SELECT vec_id AS spec_id, 1 - i / 64.0 AS mu, round(e::DOUBLE, 6) + 0.0 AS y FROM (SELECT vec_id, unnest(embedding) AS e, unnest(range(64)) AS i FROM embeddings)")
def order_axis(spark, d):
    rows = spectra(spark, d).select("spec_id", (1 - F.col("i") / 64.0).alias("mu"), rnd((F.col("flux") - 1) / 0.2, 6).alias("y"))
    return J.order_axis(rows, ["spec_id"], "mu")


@query("incremental_ingest", "SELECT event_type, count(*) AS n, round(sum(value), 2) AS total FROM events GROUP BY 1")
def incremental_ingest(spark, d):
    """Events as spectrum files with one angle, a million ids a file: counts from the spectra, totals from the intensities."""
    folder = I.new_folder(spark)
    number_of = F.coalesce("event_id", F.lit(0).cast("long"))
    number, known = F.coalesce(F.col("value").cast("string"), F.lit("NaN")), F.when(F.col("value").isNull(), "0.0").otherwise("1.0")
    rows = table(spark, d, "events").select(F.concat(F.lit("t"), "event_type").alias("event_type"), F.floor(number_of / 1_000_000).alias("part"), number_of.alias("pos"),
                                            F.concat_ws(" ", number_of, number, number, number, known).alias("value"))
    heads = rows.select("event_type", "part").distinct().withColumns({"pos": F.lit(None).cast("long"), "value": F.lit("# mu-points 1.0")})
    rows.unionByName(heads).repartition("event_type", "part").sortWithinPartitions("event_type", "part", F.col("pos").asc_nulls_first()) \
        .select("event_type", "value").write.partitionBy("event_type").text(f"{folder}/in")
    for _ in range(2):  # the second run finds nothing new
        I.ingest_spectra(spark, f"{folder}/in", f"{folder}/table", f"{folder}/checkpoint", glob="*.txt").awaitTermination()
    inside = F.regexp_extract("spec_id", "event_type=t([^/]*)/", 1)
    event = F.when(F.contains("spec_id", F.lit("event_type=t")), F.url_decode(inside)).alias("event_type")
    counts = spark.read.parquet(f"{folder}/table").groupBy(event).agg(F.count(F.lit(1)).alias("n"))
    totals = spark.read.parquet(f"{folder}/table_intensity").groupBy(event).agg(rnd(F.sum(F.when(F.col("i_norm") == 1, F.col("i_abs"))), 2).alias("total"))
    return counts.alias("c").join(totals.alias("t"), F.expr("c.event_type <=> t.event_type"), "left").select("c.event_type", "n", "total")


@query("job_progress", COUNTS_SQL)
def job_progress(spark, d):
    schema = table(spark, d, "orders").schema
    log = spark.readStream.schema(schema).option("pathGlobFilter", "orders.parquet").parquet(d).select(F.col("o_orderstatus").alias("status"))
    folder = I.new_folder(spark)
    return I.job_progress(spark, log, f"{folder}/progress", f"{folder}/checkpoint")
