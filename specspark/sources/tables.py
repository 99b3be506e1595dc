"""Small configuration and look-up files, departure coefficients, opacity tables, parameter grids.

Files of these formats are bounded, so one file is one row (file, text) and is taken apart with array
functions; thousands of them spread over the tasks without a shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from specspark.functions.names import turb_normalise
from specspark.operators.grid import GRID_COLUMNS
from specspark.sources.text import number, numbers, read_whole, rows_of, save_whole, tokens, unquote, whole


def _content(text: Column, comment: str) -> Column:
    """The rows that are neither blank nor comments."""
    return F.filter(rows_of(text), lambda r: (F.trim(r) != "") & ~F.startswith(r, F.lit(comment)))


def _explode_rows(raw: DataFrame, rows: Column) -> DataFrame:
    """(file, i, row): rows with their position from 1."""
    long = raw.select("file", F.posexplode(rows).alias("_i", "row"))
    return long.select("file", (F.col("_i") + 1).alias("i"), "row")


def _at(row: str, i: int) -> Column:
    return F.get(tokens(F.col(row)), F.lit(i))


def read(spark: SparkSession, paths: str | Sequence[str], parse, **kw):
    """Parse whole files: read(spark, path, parse_segments)."""
    return parse(read_whole(spark, paths), **kw)


# --- departure coefficients ------------------------------------------------------------

def parse_departures(raw: DataFrame) -> DataFrame:
    """(file, k, tau, level, b): 8 coefficient rows, abundance, depths, levels, log tau per depth, then one
    row of b per depth.  Level 0 is 1 at every depth."""
    df = raw.withColumn("_l", rows_of(F.col("text")))
    count = lambda i: F.get(numbers(F.get("_l", F.lit(i))), F.lit(0))
    df = df.withColumns({"a_log": count(8), "_nk": count(9).cast("int"), "_nl": count(10).cast("int")})
    tau = F.transform(F.slice("_l", F.lit(12), F.col("_nk")), lambda r: F.pow(F.lit(10.0), F.get(numbers(r), F.lit(0))))
    b = F.transform(F.slice("_l", F.col("_nk") + 12, F.col("_nk")), lambda r: F.slice(numbers(r), F.lit(1), F.col("_nl")))
    return _departure_rows(df.select("file", "a_log", tau.alias("_tau"), b.alias("_b")))


def parse_departures_csv(raw: DataFrame) -> DataFrame:
    """The short layout: '!' comments, then rows log tau, b1 ... bn."""
    rows = F.transform(_content(F.col("text"), "!"), numbers)
    df = raw.select("file", F.lit(None).cast("double").alias("a_log"), rows.alias("_r"))
    tau = F.transform("_r", lambda r: F.pow(F.lit(10.0), r[0]))
    b = F.transform("_r", lambda r: F.slice(r, F.lit(2), F.size(r)))
    return _departure_rows(df.select("file", "a_log", tau.alias("_tau"), b.alias("_b")))


def _departure_rows(df: DataFrame) -> DataFrame:
    long = df.select("file", "a_log", F.posexplode(F.arrays_zip("_tau", "_b")).alias("_k", "_z"))
    levels = F.concat(F.array(F.lit(1.0)), F.col("_z._b"))
    return long.select("file", "a_log", (F.col("_k") + 1).alias("k"), F.col("_z._tau").alias("tau"), F.posexplode(levels).alias("level", "b"))


def render_departures(packed: DataFrame) -> DataFrame:
    """(file, text) from packed rows: a_log, log_tau array, b array of arrays, powers 8 x (name, x, y, z)."""
    coef = F.transform("powers", lambda p: F.format_string("# %15s %10.6f %10.6f %10.6f", p["name"], p["x"], p["y"], p["z"]))
    head = F.array(F.format_string("%10.6f ", "a_log"), F.format_string("%3d ", F.size("log_tau")),
                   F.format_string("%4d ", F.size(F.get("b", F.lit(0)))))
    taus = F.transform("log_tau", lambda t: F.format_string("%8.4f ", t))
    rows = F.transform("b", lambda r: F.concat(F.array_join(F.transform(r, lambda v: F.format_string("%12.5E", v)), " "), F.lit(" ")))
    return packed.select("file", F.array_join(F.concat(coef, head, taus, rows), "\n").alias("text"))


def parse_dep_catalog(raw: DataFrame) -> DataFrame:
    """Auxiliary rows: model id, Teff, log g, [M/H], alpha, mass, vturb, abundance, position; '#' rows skipped."""
    rows = _explode_rows(raw, _content(F.col("text"), "#"))
    names = ["teff", "logg", "feh", "alpha", "mass", "vturb", "abundance"]
    return rows.select("file", F.col("i").alias("cat_pos"), unquote(_at("row", 0)).alias("model_id"),
                       *[number(_at("row", j + 1)).alias(n) for j, n in enumerate(names)],
                       number(_at("row", 8)).cast("bigint").alias("byte_pos"))


def parse_model_atom(raw: DataFrame) -> DataFrame:
    """Levels of a model atom: '*' comments; species, (abundance, mass), count, then E, g, id, ion."""
    df = raw.withColumn("_l", _content(F.col("text"), "*"))
    get = lambda i: F.get("_l", F.lit(i))
    df = df.withColumns({"species": F.trim(get(0)), "a_log": F.get(numbers(get(1)), F.lit(0)), "mass": F.get(numbers(get(1)), F.lit(1)),
                         "_n": F.get(numbers(get(2)), F.lit(0)).cast("int")})
    long = df.select("file", "species", "a_log", "mass", F.posexplode(F.slice("_l", F.lit(4), F.col("_n"))).alias("_i", "row"))
    return long.select("file", "species", "a_log", "mass", (F.col("_i") + 1).alias("level"), number(_at("row", 0)).alias("e"),
                       number(_at("row", 1)).alias("g"), unquote(_at("row", 2)).alias("id"), whole(_at("row", 3)).alias("ion"))


def parse_species_flags(raw: DataFrame) -> DataFrame:
    """(z, name, nlte, atom_file, dep_file, binary, problem): two path rows after marker comments, then one
    row per species; problem names a keyword that is not known."""
    lines = rows_of(F.col("text"))
    path = lambda mark: F.trim(F.get(lines, F.array_position(
        F.transform(lines, lambda r: F.startswith(r, F.lit(mark))), F.lit(True)).cast("int")))
    df = raw.select("file", path("# path for model atom files").alias("_atoms"), path("# path for departure files").alias("_deps"),
                    F.posexplode(lines).alias("_i", "row"))
    rows = df.filter(F.regexp_like("row", F.lit(r"^\s*\d+\s+'")))
    word = lambda i: unquote(_at("row", i))
    rows = rows.withColumns({"_flag": word(2), "_bin": word(5)})
    problem = F.when(~F.startswith("_flag", F.lit("nlte")) & ~F.startswith("_flag", F.lit("lte")), F.col("_flag")) \
        .when(~F.startswith("_bin", F.lit("bin")) & ~F.startswith("_bin", F.lit("asc")), F.col("_bin"))
    full = lambda base, name: F.when(name != "", F.concat(base, name))
    return rows.select("file", whole(_at("row", 0)).alias("z"), word(1).alias("name"), F.startswith("_flag", F.lit("nlte")).alias("nlte"),
                       full(F.col("_atoms"), word(3)).alias("atom_file"), full(F.col("_deps"), word(4)).alias("dep_file"),
                       F.startswith("_bin", F.lit("bin")).alias("binary"), problem.alias("problem"))


# --- segments, angles, filters -----------------------------------------------------------

def parse_segments(raw: DataFrame) -> DataFrame:
    """(file, seg_id, wmin, wmax) after the leading ';' rows."""
    rows = _explode_rows(raw, _content(F.col("text"), ";"))
    return rows.select("file", F.col("i").alias("seg_id"), number(_at("row", 0)).alias("wmin"), number(_at("row", 1)).alias("wmax"))


def parse_mu(raw: DataFrame) -> DataFrame:
    """(file, i, mu): the count, then as many values separated by blanks or commas."""
    v = numbers(F.col("text"))
    long = raw.select("file", F.posexplode(F.slice(v, F.lit(2), v[0].cast("int"))).alias("_i", "mu"))
    return long.select("file", (F.col("_i") + 1).alias("i"), "mu")


def parse_filter(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """((file, title, wave, trans), files with fewer than two rows)."""
    df = raw.withColumn("_l", rows_of(F.col("text")))
    rows = F.filter(F.transform(F.slice("_l", F.lit(2), F.size("_l")), numbers), lambda r: r[0].isNotNull() & F.get(r, F.lit(1)).isNotNull())
    df = df.select("file", F.trim(F.get("_l", F.lit(0))).alias("title"), rows.alias("_r"))
    curve = df.filter(F.size("_r") >= 2).select("file", "title", F.explode("_r").alias("r"))
    return curve.select("file", "title", F.col("r")[0].alias("wave"), F.col("r")[1].alias("trans")), \
        df.filter(F.size("_r") < 2).select("file", "title")


# --- atomic data ---------------------------------------------------------------------------

def parse_isotopes(raw: DataFrame) -> DataFrame:
    """(file, z, a, mass, frac, mix): '_' rows separate elements, the first row of an element carries Z in
    columns 1-3, A stands in columns 9-11, values are written value(error)#."""
    df = raw.select("file", F.split("text", r"(?m)^_.*$").alias("_e")).select("file", F.posexplode("_e").alias("_n", "_t"))
    df = df.filter("_n > 0").withColumn("_l", F.filter(F.split("_t", r"\r?\n"), lambda r: F.trim(r) != ""))
    df = df.withColumn("z", F.trim(F.substring(F.get("_l", F.lit(0)), 1, 3)).try_cast("int"))
    df = df.select("file", "z", F.explode("_l").alias("row"))
    value = lambda i: F.get(F.regexp_extract_all(
        F.substring("row", 12, 1 << 30), F.lit(r"([0-9.]+)\([^)]*\)#?"), 1), F.lit(i)).try_cast("double")
    return df.select("file", "z", F.trim(F.substring("row", 9, 3)).try_cast("int").alias("a"), value(0).alias("mass"),
                     value(1).alias("frac"), value(2).alias("mix"))


def parse_partition_atoms(raw: DataFrame) -> DataFrame:
    """(z, stage, name, ipot, coef): rows i, spec, name, potential, n, a0..a5; Z = int(spec), stage from the
    fraction, stages 1-4 kept; '#' rows skipped."""
    rows = _explode_rows(raw, _content(F.col("text"), "#"))
    spec = number(_at("row", 1))
    z = spec.cast("int")
    stage = ((spec - z) * 101.0 + 1e-9).cast("int") + 1
    out = rows.select("file", z.alias("z"), stage.alias("stage"), unquote(_at("row", 2)).alias("name"), number(_at("row", 3)).alias("ipot"),
                      F.transform(F.slice(tokens(F.col("row")), 6, 6), number).alias("coef"))
    return out.filter(F.col("stage") < 5)


def parse_partition_molecules(raw: DataFrame) -> DataFrame:
    """(code, name, d0, coef, parts): rows i, code, name, D0, nq, q1..qnq, m, then m pairs (Z, count); '*' skipped."""
    rows = _explode_rows(raw, _content(F.col("text"), "*")).withColumn("_w", tokens(F.col("row")))
    w = lambda i: F.get("_w", i)
    nq = whole(w(F.lit(4)))
    m = whole(w(nq + 5))
    parts = F.transform(F.sequence(F.lit(0), m - 1), lambda j: F.struct(
        whole(w(nq + 6 + 2 * j)).alias("z"), whole(w(nq + 7 + 2 * j)).alias("n")))
    return rows.select("file", number(w(F.lit(1))).alias("code"), unquote(w(F.lit(2))).alias("name"), number(w(F.lit(3))).alias("d0"),
                       F.transform(F.slice("_w", F.lit(6), nq), number).alias("coef"), parts.alias("parts"))


def parse_levels(raw: DataFrame, quantum: bool = False) -> DataFrame:
    """(file, e, g): a title row and pairs E, g; or rows n, J, symmetry, rank, E with g = spin*(2J+1), the
    spin factor 1 up to symmetry 2 and 3 above."""
    if not quantum:
        df = raw.withColumn("_l", rows_of(F.col("text")))
        rows = df.select("file", F.explode(F.transform(F.slice("_l", F.lit(2), F.size("_l")), numbers)).alias("r"))
        return rows.filter(F.size("r") >= 2).select("file", F.col("r")[0].alias("e"), F.col("r")[1].alias("g"))
    rows = raw.select("file", F.explode(F.transform(_content(F.col("text"), "#"), numbers)).alias("r"))
    r = F.col("r")
    return rows.select("file", r[4].alias("e"), (F.when(r[2] <= 2, 1.0).otherwise(3.0) * (2 * r[1] + 1)).alias("g"))


def parse_table2d(raw: DataFrame) -> DataFrame:
    """(file, x, t, v): the first row of at least two numbers and nothing else is the t axis (a K after a
    temperature is fine); each later row with one number more is x, v(t1) ... v(tn)."""
    rows = F.filter(F.transform(rows_of(F.col("text")), lambda r: F.transform(
        tokens(r), lambda w: number(F.regexp_replace(w, r"K$", "")))),
        lambda r: (F.size(r) > 1) & ~F.exists(r, lambda v: v.isNull()))
    # a file without an axis and a row gives none below; a filter here would take every text apart a second time
    df = raw.select("file", rows.alias("_r")).withColumn("_axis", F.get("_r", F.lit(0)))
    long = df.select("file", "_axis", F.explode(F.slice("_r", F.lit(2), F.size("_r"))).alias("_row"))
    long = long.filter(F.size("_row") == F.size("_axis") + 1)
    cells = F.zip_with("_axis", F.slice("_row", F.lit(2), F.size("_axis")), lambda t, v: F.struct(t.alias("t"), v.alias("v")))
    return long.select("file", F.col("_row")[0].alias("x"), F.inline(cells))


# --- continuous opacity ----------------------------------------------------------------------

CONT_SCALARS = ["radius", "tau", "temp", "pe", "pg", "rho", "xi", "ross"]


def parse_cont_opacity(raw: DataFrame, velocity_field: bool = False) -> tuple[DataFrame, DataFrame]:
    """(depths, opacity): header code/ntau/reference wavelength, the wavelength count and list, then per depth
    8 scalars (9 with a velocity) and pairs (kappa, sigma).  Rows are wrapped, so the numbers count."""
    n_scalar = len(CONT_SCALARS) + int(velocity_field)
    lines = rows_of(F.col("text"))
    df = raw.withColumn("_h", tokens(F.get(lines, F.lit(0)))).withColumn(
        "_v", F.flatten(F.transform(F.slice(lines, F.lit(2), F.size(lines)), numbers)))
    df = df.withColumns({"code": unquote(F.get("_h", F.lit(0))), "_nk": whole(F.get("_h", F.lit(1))),
                         "xls": number(F.get("_h", F.lit(2))), "_nl": F.col("_v")[0].cast("int")})
    per = 2 * F.col("_nl") + n_scalar
    df = df.withColumn("_waves", F.slice("_v", F.lit(2), F.col("_nl")))
    df = df.select("file", "code", "xls", "_nl", "_waves", "_v", F.explode(F.sequence(F.lit(1), F.col("_nk"))).alias("k"), per.alias("_per"))
    df = df.select("file", "code", "xls", "k", "_nl", "_waves", F.slice("_v", 2 + F.col("_nl") + (F.col("k") - 1) * F.col("_per"), F.col("_per")).alias("_z"))
    names = CONT_SCALARS + (["velocity"] if velocity_field else [])
    depths = df.select("file", "code", "xls", "k", *[F.get("_z", F.lit(i)).alias(n) for i, n in enumerate(names)])
    points = F.transform("_waves", lambda w, i: F.struct(
        w.alias("wave"), F.get("_z", 2 * i + n_scalar).alias("kappa"), F.get("_z", 2 * i + n_scalar + 1).alias("sigma")))
    return depths, df.select("file", "k", F.inline(points))


def _wrapped(values: Column, n: int, fmt: str) -> Column:
    """Rows of n formatted values each."""
    count = F.ceil(F.size(values) / F.lit(n)).cast("int")
    return F.transform(F.sequence(F.lit(0), count - 1), lambda i: F.concat(F.lit(" "), F.array_join(F.transform(
        F.slice(values, i * n + 1, F.lit(n)), lambda v: F.format_string(fmt, v)), "")))


def render_cont_opacity(packed: DataFrame) -> DataFrame:
    """(file, text) from packed rows: code, xls, waves array, depths array of (scalars array, kappa, sigma arrays)."""
    head = F.array(F.format_string(" '%s'%5d%10.2f", "code", F.size("depths"), "xls"), F.format_string(" %5d", F.size("waves")))
    block = F.flatten(F.transform("depths", lambda d: F.concat(
        _wrapped(d["scalars"], 8, "%14.7E"),
        _wrapped(F.flatten(F.zip_with(d["kappa"], d["sigma"], lambda a, b: F.array(a, b))), 6, "%11.4E"))))
    rows = F.concat(head, _wrapped(F.col("waves"), 10, "%11.3f"), block)
    return packed.select("file", F.array_join(rows, "\n").alias("text"))


def write_texts(texts: DataFrame, path: str) -> None:
    save_whole(texts, path)


# --- parameter grids -------------------------------------------------------------------------

# fixed values: accepted column names per field, in order of preference
GRID_ALIASES = {"teff": ["teff"], "logg": ["logg"], "feh": ["feh", "fe_h", "metallicity"],
                "turb": ["turbvel", "t_value", "turbulence", "microturb"]}


def resolve_columns(columns: Sequence[str]) -> dict[str, str]:
    """Field -> column: exact names first, then any case; a field without a column is an error."""
    found = {}
    for field, names in GRID_ALIASES.items():
        exact = [n for n in names if n in columns]
        loose = [c for n in names for c in columns if c.lower() == n]
        if not exact and not loose:
            raise ValueError(f"no column for {field}: tried {names}, have {list(columns)}")
        found[field] = (exact or loose)[0]
    return found


def parse_grid(table: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(points, rejects) from a grid table of strings: Teff truncated, turbulence label normalised."""
    at = resolve_columns(table.columns)
    value = lambda f: F.trim(F.col(f"`{at[f]}`")).try_cast("double")
    df = table.withColumn("_p", F.struct(
        value("teff").try_cast("int").alias("teff"), value("logg").alias("logg"), value("feh").alias("feh"),
        turb_normalise(F.col(f"`{at['turb']}`").cast("string"))["label"].alias("turb")))
    bad = F.col("_p.teff").isNull() | F.col("_p.logg").isNull() | F.col("_p.feh").isNull()
    return df.filter(~bad).select("_p.*"), df.filter(bad).drop("_p")


def read_grid(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    return parse_grid(spark.read.option("header", True).csv(path))


def write_grid(grid: DataFrame, path: str, one_file: bool = False) -> None:
    """The 18 columns as CSV with a header; ``one_file`` only for grids that are known to be small."""
    out = grid.select(*GRID_COLUMNS)
    (out.coalesce(1) if one_file else out).write.option("header", True).csv(path)
