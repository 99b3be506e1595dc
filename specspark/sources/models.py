"""Model atmospheres: every layout becomes one packed row per file (arrays over depth), then rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from specspark.functions.names import parse_model_name
from specspark.sources.text import base_name, number, numbers, read_whole, rows_of, save_whole, tokens, unquote, whole

# fixed values: constants of the guesses in files without pressures
BOLTZ, M_H = 1.38065e-16, 1.660e-24
DEPTH_COLUMNS = ["log_tau5000", "log_tau_ross", "temp", "log_pe", "log_pg", "xi", "radius", "log_kappa", "rho",
                 "velocity", "rhox"]


def _packed(df: DataFrame, scalars: dict[str, Column], arrays: dict[str, Column]) -> DataFrame:
    """file, geometry, teff, logg, feh, xls, scalars and one array per depth column (null where absent)."""
    none = F.lit(None).cast("double")
    base = {"geometry": F.lit("pp"), "teff": none, "logg": none, "feh": none, "xls": F.lit(5000.0)}
    cols = {**base, **scalars}
    return df.select("file", *[c.alias(n) for n, c in cols.items()], *[arrays[c].alias(c) for c in DEPTH_COLUMNS if c in arrays])


def split_models(packed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(models, model_depths): one row per model, and one per model and depth (k from 1)."""
    arrays = [c for c in DEPTH_COLUMNS if c in packed.columns]
    models = packed.select("file", "geometry", "teff", "logg", "feh", "xls")
    rows = packed.select("file", F.posexplode(F.arrays_zip(*arrays)).alias("k", "_z"))
    return models, rows.select("file", (F.col("k") + 1).alias("k"), *[f"_z.{c}" for c in arrays])


def _column(rows: Column, i: int) -> Column:
    """Word i of every (already split) row."""
    return F.transform(rows, lambda r: F.get(r, F.lit(i)))


def _table(lines: Column, start: Column, n: Column) -> Column:
    """n rows from the 1-based row ``start`` on, as arrays of numbers."""
    return F.transform(F.slice(lines, start.cast("int"), n.cast("int")), numbers)


def _each(arr: Column, fn) -> Column:
    return F.transform(arr, fn)


def parse_marcs(raw: DataFrame) -> DataFrame:
    """The structured ASCII layout: scalars in rows 2-8, then two depth tables after 'Model structure'."""
    df = raw.withColumn("_l", rows_of(F.col("text")))
    line = F.col("_l")
    df = df.withColumn("_m", F.array_position(F.transform(line, F.trim), F.lit("Model structure")).cast("int"))
    df = df.filter("_m > 2").withColumn("_n", whole(F.get(tokens(F.get(line, F.col("_m") - 2)), F.lit(0))))
    df = df.withColumns({"_a": _table(line, F.col("_m") + 2, F.col("_n")),
                         "_b": _table(line, F.col("_m") + 3 + F.col("_n"), F.col("_n"))})
    first = lambda i: F.get(numbers(F.get(line, F.lit(i))), F.lit(0))
    df = df.withColumns({"_radius": first(7), "_xi": first(4), "_first": F.substring(F.col("text"), 1, 3)})
    geometry = F.when(F.startswith("_first", F.lit("p")) | (F.col("_first") == "sun"), "pp") \
        .when(F.startswith("_first", F.lit("s")), "sph").otherwise("unknown")
    return _packed(df, {"geometry": geometry, "teff": first(1), "logg": F.log10(first(3)), "feh": first(6)}, {
        "log_tau_ross": _column(F.col("_a"), 1), "log_tau5000": _column(F.col("_a"), 2),
        "temp": _column(F.col("_a"), 4), "log_pe": _each(_column(F.col("_a"), 5), F.log10),
        "log_pg": _each(_column(F.col("_a"), 6), F.log10), "xi": _each(F.col("_a"), lambda r: F.col("_xi")),
        "radius": _each(_column(F.col("_a"), 3), lambda d: F.col("_radius") - d),
        "log_kappa": _each(_column(F.col("_b"), 2), F.log10), "rho": _column(F.col("_b"), 3)})


def _headed(raw: DataFrame) -> DataFrame:
    """Rows and the words of the first one: code, depths, reference wavelength, log g, flag, scale."""
    df = raw.withColumn("_l", rows_of(F.col("text"))).withColumn("_h", tokens(F.get("_l", F.lit(0))))
    return df.withColumns({"code": unquote(F.get("_h", F.lit(0))), "_n": whole(F.get("_h", F.lit(1))),
                           "_xls": number(F.get("_h", F.lit(2))), "_g": number(F.get("_h", F.lit(3))),
                           "_scale": F.coalesce(number(F.get("_h", F.lit(5))), F.lit(0.0))})


def parse_tau_model(raw: DataFrame) -> DataFrame:
    """Interpolated and generic layout: log tau, T, log Pe, log Pg, xi, and R (then log tau Ross) when spherical
    or written by the interpolator."""
    df = _headed(raw).withColumn("_a", _table(F.col("_l"), F.lit(2), F.col("_n")))
    a = F.col("_a")
    return _packed(df, {"geometry": F.when(F.startswith("code", F.lit("sph")), "sph").otherwise("pp"),
                        "logg": F.col("_g"), "xls": F.col("_xls")}, {
        "log_tau5000": _column(a, 0), "temp": _each(_column(a, 1), lambda t: (1 + F.col("_scale")) * t),
        "log_pe": _column(a, 2), "log_pg": _column(a, 3), "xi": _column(a, 4), "radius": _column(a, 5),
        "log_tau_ross": _column(a, 6)})


def parse_kurucz(raw: DataFrame) -> DataFrame:
    """First word TEFF; after the row READ (depth count in columns 11-13): rhox, T, Pg, n_e, kappa."""
    df = raw.withColumn("_l", rows_of(F.col("text"))).filter(F.startswith("text", F.lit("TEFF")))
    at = F.array_position(F.transform("_l", lambda r: F.startswith(r, F.lit("READ"))), F.lit(True)).cast("int")
    df = df.withColumn("_at", at).filter("_at > 0").withColumn("_n", F.trim(F.substring(F.get("_l", F.col("_at") - 1), 11, 3)).try_cast("int"))
    df = df.withColumn("_a", _table(F.col("_l"), F.col("_at") + 1, F.col("_n")))
    a = F.col("_a")
    return _packed(df, {}, {
        "temp": _column(a, 1), "log_pe": _each(a, lambda r: F.log10(r[3] * r[1] * BOLTZ)),
        "log_pg": _each(_column(a, 2), F.log10), "log_kappa": _each(_column(a, 4), F.log10), "rhox": _column(a, 0)})


def parse_multi(raw: DataFrame) -> DataFrame:
    """Scale row MASS or TAU, a comment row '* ndep', the count, comment rows, then log scale, T, n_e, v, xi."""
    df = raw.withColumn("_l", rows_of(F.col("text")))
    low = F.transform("_l", lambda r: F.lower(F.trim(r)))
    scale = F.array_position(F.transform(low, lambda r: F.startswith(r, F.lit("mass")) | F.startswith(r, F.lit("tau"))), F.lit(True))
    ndep = F.array_position(F.transform("_l", lambda r: F.startswith(F.lower(F.trim(F.substring(r, 2, 39))), F.lit("ndep"))), F.lit(True))
    df = df.withColumns({"_s": scale.cast("int"), "_d": ndep.cast("int")}).filter("_s > 0 AND _d > 0")
    df = df.withColumns({"_n": F.get(numbers(F.get("_l", F.col("_d"))), F.lit(0)).cast("int"),
                         "_mass": F.startswith(F.lower(F.trim(F.get("_l", F.col("_s") - 1))), F.lit("mass"))})
    rest = F.filter(F.slice("_l", F.col("_d") + 2, F.greatest(F.size("_l") - F.col("_d") - 1, F.lit(0))),
                    lambda r: ~F.startswith(r, F.lit("*")))
    df = df.withColumn("_a", _table(rest, F.lit(1), F.col("_n")))
    a = F.col("_a")
    return _packed(df, {}, {
        "log_tau5000": F.transform(a, lambda r: F.when(~F.col("_mass"), r[0])), "temp": _column(a, 1),
        "log_pe": _each(a, lambda r: F.log10(r[2] * r[1] * BOLTZ)), "xi": _column(a, 4),
        "velocity": _each(_column(a, 3), lambda v: v * 1.0e5),
        "rhox": F.transform(a, lambda r: F.when(F.col("_mass"), F.pow(F.lit(10.0), r[0])))})


def parse_stagger(raw: DataFrame) -> DataFrame:
    """Second row Teff, log g, [M/H], depths; rows depth, T, rho (pressures are guesses)."""
    df = _headed(raw).withColumn("_p", numbers(F.get("_l", F.lit(1))))
    df = df.withColumn("_a", _table(F.col("_l"), F.lit(3), F.get("_p", F.lit(3)).cast("int")))
    a, p = F.col("_a"), F.col("_p")
    return _packed(df, {"teff": p[0], "logg": p[1], "feh": p[2]}, {
        "temp": _column(a, 1), "log_pe": _each(a, lambda r: F.lit(-10.0)),
        "log_pg": _each(a, lambda r: F.log10(r[2] * BOLTZ * r[1] / 1.3 / M_H)), "radius": _column(a, 0), "rho": _column(a, 2)})


def parse_hoefner(raw: DataFrame) -> DataFrame:
    """Rows r, rho, T, Pg, ... after '#' rows; velocity is set to 5 km/s."""
    df = _headed(raw)
    rest = F.filter(F.slice("_l", F.lit(2), F.size("_l")), lambda r: ~F.startswith(r, F.lit("#")))
    df = df.withColumn("_a", _table(rest, F.lit(1), F.col("_n")))
    a = F.col("_a")
    return _packed(df, {"geometry": F.lit("sph"), "logg": F.col("_g"), "xls": F.col("_xls")}, {
        "temp": _column(a, 2), "log_pe": _each(a, lambda r: F.lit(-10.0)), "log_pg": _each(_column(a, 3), F.log10),
        "radius": _column(a, 0), "rho": _column(a, 1), "velocity": _each(a, lambda r: F.lit(5.0e5))})


def parse_bowe(raw: DataFrame) -> DataFrame:
    """Twelve header rows, then rows from the bottom up: i, r, dr, T, rho, v, electron fraction."""
    df = _headed(raw).withColumn("_a", F.reverse(_table(F.col("_l"), F.lit(14), F.col("_n"))))
    a = F.col("_a")
    pg = lambda r: r[4] * 1.38e-16 * r[3] / 1.26 / 1.67e-24
    return _packed(df, {"geometry": F.lit("sph"), "logg": F.col("_g"), "xls": F.col("_xls")}, {
        "temp": _column(a, 3), "log_pe": _each(a, lambda r: F.log10(r[6] * 0.908 * pg(r))),
        "log_pg": _each(a, lambda r: F.log10(pg(r))), "radius": _column(a, 1), "rho": _column(a, 4), "velocity": _column(a, 5)})


def parse_alva(raw: DataFrame, velocity_field: bool = False) -> DataFrame:
    """Rows T, Pg, R and, if present, xi (or the velocity); Pe is a guess that falls steeply below 2000 K."""
    df = _headed(raw).withColumn("_a", _table(F.col("_l"), F.lit(2), F.col("_n")))
    a = F.col("_a")
    pe = lambda r: F.when(r[0] < 2000, 1.0e-4 * r[1] * F.pow(r[0] / 3000.0, F.lit(30.0))).otherwise(1.0e-4)
    return _packed(df, {"geometry": F.lit("sph"), "logg": F.col("_g"), "xls": F.col("_xls")}, {
        "temp": _column(a, 0), "log_pe": _each(a, lambda r: F.log10(pe(r))), "log_pg": _each(_column(a, 1), F.log10),
        "radius": _column(a, 2), "velocity" if velocity_field else "xi": _column(a, 3)})


PARSERS = {"marcs": parse_marcs, "tau": parse_tau_model, "kurucz": parse_kurucz, "multi": parse_multi,
           "stagger": parse_stagger, "hoefner": parse_hoefner, "bowe": parse_bowe, "alva": parse_alva}


def read_models(spark: SparkSession, paths: str | Sequence[str], layout: str) -> tuple[DataFrame, DataFrame]:
    return split_models(PARSERS[layout](read_whole(spark, paths)))


def model_kind(text: Column) -> Column:
    """'interpolated' when the first row says so, else 'marcs'."""
    first = F.element_at(F.split(text, r"\r?\n", 2), 1)
    return F.when(F.contains(first, F.lit("INTERPOL")), "interpolated").otherwise("marcs")


def parse_catalog(paths: DataFrame, path: str = "path") -> DataFrame:
    """(path, teff, logg, turb, feh, alpha, model_id) for the file names that follow the grid pattern."""
    name = base_name(F.col(path))
    df = paths.withColumn("_m", parse_model_name(name)).filter("_m IS NOT NULL")
    return df.select(path, "_m.*", F.regexp_replace(name, r"\.mod$", "").alias("model_id"))


def scan_models(spark: SparkSession, directory: str) -> DataFrame:
    """The catalogue of a directory; only the listing is read, never the file content."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.mod").load(directory).select("path")
    return parse_catalog(files)


def render_tau_model(packed: DataFrame, corners: str | None = None) -> DataFrame:
    """(file, text) of the interpolated layout from packed models, with the corner names at the end."""
    spherical = F.col("geometry") == "sph"
    head = F.format_string("'%s' %3d%7.0f.  %4.2f 0 0.00", F.when(spherical, "sphINTERPOL").otherwise("ppINTERPOL"),
                           F.size("temp"), "xls", "logg")
    z = F.arrays_zip("log_tau5000", "temp", "log_pe", "log_pg", "xi", "radius", "log_tau_ross")
    rows = F.transform(z, lambda r: F.format_string("%8.4f %8.2f %8.4f %8.4f %8.4f %15.6E %8.4f", *[
        r[c] for c in ("log_tau5000", "temp", "log_pe", "log_pg", "xi", "radius", "log_tau_ross")]))
    parts = [F.array(head), rows] + ([F.col(corners)] if corners else [])
    return packed.select("file", F.array_join(F.concat(*parts), "\n").alias("text"))


def render_tau_listing(packed: DataFrame) -> DataFrame:
    """(file, text) of the alternative listing with the column mass rhox."""
    code = F.when(F.col("geometry") == "sph", "sphINTERPOL").otherwise("ppINTERPOL")
    head = F.format_string("%s %3d%7.0f.", code, F.size("temp"), "xls")
    title = F.lit("    k    log(tau)  T    log(Pe)   log(Pg)    rhox")
    z = F.arrays_zip("log_tau5000", "temp", "log_pe", "log_pg", "rhox")
    rows = F.transform(z, lambda r, i: F.format_string(
        "%5d %8.4f %8.2f %8.4f %8.4f %15.6E", i + 1, r["log_tau5000"], r["temp"], r["log_pe"], r["log_pg"], r["rhox"]))
    return packed.select("file", F.array_join(F.concat(F.array(head, title), rows), "\n").alias("text"))


def write_models(packed: DataFrame, path: str, corners: str | None = None) -> None:
    save_whole(render_tau_model(packed, corners), path)


def render_multi(packed: DataFrame) -> DataFrame:
    """(file, text): log g, the depth count, then log tau, T, n_e = Pe/kT, 0, xi per depth."""
    z = F.arrays_zip("log_tau5000", "temp", "log_pe", "xi")
    rows = F.transform(z, lambda r: F.format_string(
        "%11.7f %9.2f %12.5E %9.5f %9.5f", r["log_tau5000"], r["temp"],
        F.pow(F.lit(10.0), r["log_pe"]) / r["temp"] / 1.38064852e-16, F.lit(0.0), r["xi"]))
    head = F.array(F.col("logg").cast("string"), F.size("temp").cast("string"))
    return packed.select("file", F.array_join(F.concat(head, rows), "\n").alias("text"))
