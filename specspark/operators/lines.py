"""Line-list operators: filters, derived columns, damping recipes and look-ups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from specspark.operators.layout import maybe_broadcast

MAX_Z = 92


# --- filters ---------------------------------------------------------------------------

def trim_wave(lines: DataFrame, w1: float, w2: float, wave: str = "wave") -> DataFrame:
    """Lines in the closed range, whichever end comes first."""
    return lines.filter(F.col(wave).between(min(w1, w2), max(w1, w2)))


def margin(value: float | None = None, velocity_field: bool = False) -> float:
    """Margin around the window: 2.0 by default, 5.0 if tiny or with a velocity field."""
    value = 2.0 if value is None else value
    return 5.0 if value < 1e-6 or velocity_field else value


def window_margin(lines: DataFrame, w1: float, w2: float, value: float | None = None,
                  velocity_field: bool = False, wave: str = "wave") -> DataFrame:
    m = margin(value, velocity_field)
    return lines.filter(F.col(wave).between(w1 - m, w2 + m))


def vald_reject(vald: DataFrame, ionpot: DataFrame, max_chi: float = 15.0) -> DataFrame:
    """Adds reject_reason: hydrogen or helium, wrong stage, low level too high, upper level beyond the
    ionisation potential (z, ion, chi_ion) of an atom; null = kept.  The first reason counts."""
    table = maybe_broadcast(ionpot.select(F.col("z").alias("iel"), "ion", "chi_ion"))
    reason = (
        F.when(F.col("iel") < 3, "H or He")
        .when(~F.col("ion").isin(1, 2), "ion")
        .when(F.col("chi_low") >= max_chi, "low level")
        .when((F.col("iel") <= MAX_Z) & (F.col("chi_up") >= F.col("chi_ion")), "bound-free"))
    return vald.join(table, ["iel", "ion"], "left").withColumn("reject_reason", reason)


def observe_rejects(df: DataFrame, reasons: Sequence[str], reason: str = "reject_reason") -> tuple[DataFrame, Observation]:
    """The rows without a reason, and an Observation that the first action on them fills: `rows`, one count for each of the
    reasons, and `other`. The counts ride on the same scan, so no rejected row is read a second time."""
    seen, found = F.col(reason), Observation()
    counts = [F.count_if(F.coalesce(seen == r, F.lit(False))).alias(r) for r in reasons]
    rest = F.count_if(F.coalesce(~seen.isin(*reasons), F.lit(False))).alias("other")
    return df.observe(found, F.count(F.lit(1)).alias("rows"), *counts, rest).filter(seen.isNull()).drop(reason), found


def split_rejects(df: DataFrame, reason: Column) -> tuple[DataFrame, DataFrame]:
    """(kept, rejected): rows whose reason is null, and the others with their reason."""
    marked = df.withColumn("reject_reason", reason)
    return marked.filter("reject_reason IS NULL").drop("reject_reason"), marked.filter("reject_reason IS NOT NULL")


def reject_c6(lines: DataFrame) -> DataFrame:
    """Drop lines whose Unsoeld constant is not positive (see damping_recipe)."""
    return lines.filter(F.col("reject_reason").isNull())


def gf_guard(log_gf: Column) -> Column:
    """Text of log gf: three decimals in the usual range, two outside."""
    usual = (log_gf > -10.0) & (log_gf < 100.0)
    return F.when(usual, F.lpad(F.format_string("%.3f", log_gf), 6, " ")).otherwise(
        F.lpad(F.format_string("%.2f", log_gf), 6, " "))


def abundance_guard(abund: DataFrame, departures: DataFrame, key: Sequence[str], tol: float = 1e-4) -> DataFrame:
    """Rows whose abundance differs from the one behind their departure coefficients by more than tol."""
    both = abund.select(*key, F.col("a_log").alias("a_lines")).join(
        departures.select(*key, F.col("a_log").alias("a_departures")).distinct(), list(key))
    return both.filter(F.abs(F.col("a_lines") - F.col("a_departures")) > tol)


# --- derived ---------------------------------------------------------------------------

def line_derived(lines: DataFrame, g_low: float = 1.0) -> DataFrame:
    """gf, upper energy and radiative damping (a default where the list has 0)."""
    gf = F.pow(F.lit(10.0), F.col("log_gf"))
    default = 6.669e15 * g_low * gf / (F.col("g_up") * F.col("wave") * F.col("wave"))
    return lines.withColumns({
        "gf": gf,
        "chi_up": F.col("chi_low") + 3.40 * 3647.0 / F.col("wave"),
        "gam_rad": F.when(F.col("gam_rad") != 0, F.col("gam_rad")).otherwise(default),
    })


def vald_derived(vald: DataFrame) -> DataFrame:
    """Upper weight from J, radiative width from its logarithm (1e5 where there is none)."""
    return vald.withColumns({
        "g_up": 2.0 * F.col("j_up") + 1.0,
        "gam_rad": F.when(F.col("gam_rad") > 3.0, F.pow(F.lit(10.0), F.col("gam_rad"))).otherwise(1.0e5),
    })


def damping_recipe(lines: DataFrame) -> DataFrame:
    """recipe, sigma, alpha, log_c6 and reject_reason.

    Needs fdamp, iel, ion, chi_ion, chi_low, chi_up and the table result (table_recipe, table_sigma,
    table_alpha; null where no table applies).  Order: cross section packed in fdamp, radiative only
    for molecules, table, log gamma in fdamp, Unsoeld.
    """
    packed, atom = F.col("fdamp") >= 20, F.col("iel") <= MAX_Z
    quantum = F.col("table_recipe").isin("A", "B", "C", "S")
    c6 = F.col("ion") * F.col("ion") * (
        F.try_divide(F.lit(1.0), F.pow(F.col("chi_ion") - F.col("chi_up"), F.lit(2)))
        - F.try_divide(F.lit(1.0), F.pow(F.col("chi_ion") - F.col("chi_low"), F.lit(2))))
    recipe = F.when(~atom, "R").when(packed, "S").when(quantum, F.col("table_recipe")) \
        .when(F.col("fdamp") < 0, "W").otherwise("U")
    df = lines.withColumns({"recipe": recipe, "_c6": c6})
    whole = F.col("fdamp").cast("bigint").cast("double")
    by_list, by_table = atom & packed, atom & ~packed & quantum
    unsold = F.col("recipe") == "U"
    return df.withColumns({
        "sigma": F.when(by_list, whole).when(by_table, F.col("table_sigma")),
        "alpha": F.when(by_list, F.col("fdamp") - whole).when(by_table, F.col("table_alpha")),
        "log_c6": F.when(unsold & (F.col("_c6") > 0), F.log10("_c6") - 29.7278),
        "reject_reason": F.when(unsold & ~(F.coalesce("_c6", F.lit(0.0)) > 0), "c6"),
    }).drop("_c6")


# fixed values: (lower, upper) orbitals of a table, recipe letter, and the range of both effective
# quantum numbers for which it is defined
BROADENING = {
    ("s", "p"): ("A", (1.0, 3.0), (1.3, 3.0)),
    ("p", "d"): ("B", (1.3, 3.0), (2.3, 4.0)),
    ("d", "f"): ("C", (2.3, 4.0), (3.3, 5.0)),
}
RYDBERG = 13.595


def effective_n(chi_ion: Column, energy: Column) -> Column:
    return F.when(chi_ion > energy, 1 / F.sqrt((chi_ion - energy) / RYDBERG))


def broadening_cells(tables: DataFrame) -> DataFrame:
    """(recipe, i1, i2, sigma, alpha) points as cells that hold their four corners."""
    point = tables.select("recipe", "i1", "i2", F.struct("sigma", "alpha").alias("v"))
    cells = point.withColumnRenamed("v", "v00")
    for name, d1, d2 in (("v01", 0, 1), ("v10", 1, 0), ("v11", 1, 1)):
        moved = point.select("recipe", (F.col("i1") - d1).alias("i1"), (F.col("i2") - d2).alias("i2"),
                             F.col("v").alias(name))
        cells = cells.join(moved, ["recipe", "i1", "i2"])
    return cells


def broadening_table(lines: DataFrame, tables: DataFrame) -> DataFrame:
    """table_recipe, table_sigma, table_alpha by bilinear interpolation on the 0.1 grid of effective
    quantum numbers, for neutral s-p, p-d and d-f lines (either direction) inside the table limits."""
    lines = lines.withColumns({
        "_lo": F.lower("lev_lo"), "_up": F.lower("lev_up"), "_n_lo": effective_n(F.col("chi_ion"), F.col("chi_low")),
        "_n_up": effective_n(F.col("chi_ion"), F.col("chi_up"))})
    lo, up, n_lo, n_up = (F.col(c) for c in ("_lo", "_up", "_n_lo", "_n_up"))
    hit = F.lit(None)
    for (a, b), (letter, r1, r2) in BROADENING.items():
        for first, second, m1, m2 in ((lo, up, n_lo, n_up), (up, lo, n_up, n_lo)):
            applies = (F.col("ion") == 1) & (first == a) & (second == b) & m1.between(*r1) & m2.between(*r2)
            hit = F.when(applies, F.struct(F.lit(letter).alias("r"), m1.alias("n1"), m2.alias("n2"))).otherwise(hit)
    df = lines.withColumn("_hit", hit).withColumns({
        "_recipe": F.col("_hit.r"), "_n1": 10 * F.col("_hit.n1"), "_n2": 10 * F.col("_hit.n2")})
    df = df.withColumns({"_i1": F.col("_n1").cast("int"), "_i2": F.col("_n2").cast("int")})
    cells = broadening_cells(tables).select(
        F.col("recipe").alias("_recipe"), F.col("i1").alias("_i1"), F.col("i2").alias("_i2"), "v00", "v01", "v10", "v11")
    df = df.join(maybe_broadcast(cells), ["_recipe", "_i1", "_i2"], "left")
    f1, f2 = F.col("_n1") - F.col("_i1"), F.col("_n2") - F.col("_i2")

    def blend(c: str) -> Column:
        low = F.col(f"v00.{c}") * (1 - f2) + F.col(f"v01.{c}") * f2
        high = F.col(f"v10.{c}") * (1 - f2) + F.col(f"v11.{c}") * f2
        return low * (1 - f1) + high * f1

    return df.withColumns({
        "table_sigma": blend("sigma"), "table_alpha": blend("alpha"),
        "table_recipe": F.when(F.col("v00").isNotNull(), F.col("_recipe")),
    }).drop("_lo", "_up", "_n_lo", "_n_up", "_hit", "_recipe", "_n1", "_n2", "_i1", "_i2", "v00", "v01", "v10", "v11")


# fixed values: upper p level alone, from n* on: sigma and its slope, alpha and its slope
P_STATE = [(2.6, 762.0, 960.0, 0.270, -0.04), (2.7, 858.0, 1110.0, 0.266, 0.02),
           (2.8, 969.0, 610.0, 0.268, -0.10), (2.9, 1030.0, 440.0, 0.258, -0.04)]


def p_state_fallback(lines: DataFrame) -> DataFrame:
    """For neutral d-p lines without a table whose lower n* is below 2: sigma and alpha from the upper
    level, piecewise linear on n* in [2.6, 3.0]."""
    nd, np_ = effective_n(F.col("chi_ion"), F.col("chi_low")), effective_n(F.col("chi_ion"), F.col("chi_up"))
    wanted = (F.col("table_recipe").isNull() & (F.col("ion") == 1) & (F.lower("lev_lo") == "d")
              & (F.lower("lev_up") == "p") & (nd < 2.0) & np_.between(2.6, 3.0))
    sigma, alpha = F.lit(None).cast("double"), F.lit(None).cast("double")
    for start, s, ds, a, da in reversed(P_STATE):
        here = np_ <= start + 0.1
        sigma = F.when(here, s + ds * (np_ - start)).otherwise(sigma)
        alpha = F.when(here, a + da * (np_ - start)).otherwise(alpha)
    df = lines.withColumn("_hit", F.coalesce(wanted, F.lit(False)))
    return df.withColumns({
        "table_sigma": F.when(F.col("_hit"), sigma).otherwise(F.col("table_sigma")),
        "table_alpha": F.when(F.col("_hit"), alpha).otherwise(F.col("table_alpha")),
        "table_recipe": F.when(F.col("_hit"), "S").otherwise(F.col("table_recipe")),
    }).drop("_hit")


# --- look-ups --------------------------------------------------------------------------

def attach_departures(lines: DataFrame, departures: DataFrame, key: Sequence[str] = ("z", "k")) -> DataFrame:
    """b_lo and b_up of the two levels of a line at each depth.

    Level 0 (unidentified) on either side makes both 1; so does a species or level without
    coefficients.  ``level_error`` marks a level beyond those the atom has.
    """
    table = departures.select(*key, "level", "b")
    known = departures.groupBy(*key).agg(F.max("level").alias("_n_level"))
    lo, up = F.col("ilev_lo"), F.col("ilev_up")
    both = (lo != 0) & (up != 0)
    df = lines.withColumns({"_lo": F.when(both, lo).otherwise(0), "_up": F.when(both, up).otherwise(0)})
    df = df.join(maybe_broadcast(known), list(key), "left")
    for side in ("lo", "up"):
        df = df.join(maybe_broadcast(table.withColumnsRenamed({"level": f"_{side}", "b": f"_b_{side}"})),
                     [*key, f"_{side}"], "left")
    one = lambda side: F.when(F.col(f"_{side}") == 0, 1.0).otherwise(F.coalesce(f"_b_{side}", F.lit(1.0)))
    return df.withColumns({
        "b_lo": one("lo"), "b_up": one("up"),
        "level_error": F.coalesce(F.greatest("_lo", "_up") > F.col("_n_level"), F.lit(False)),
    }).drop("_lo", "_up", "_b_lo", "_b_up", "_n_level")


def attach_flags(df: DataFrame, flags: DataFrame, key: str, flag: str, default: Column) -> DataFrame:
    """Left join of a flag table; rows it does not know get the default."""
    return df.join(maybe_broadcast(flags.select(key, flag)), key, "left").withColumn(
        flag, F.coalesce(F.col(flag), default))


def species_name(lines: DataFrame, names: DataFrame, key: Sequence[str] = ("iel", "ion")) -> tuple[DataFrame, DataFrame]:
    """(lines with their species name, the distinct species nothing is known about)."""
    table = maybe_broadcast(names.select(*key, "name"))
    return lines.join(table, list(key)), lines.select(*key).distinct().join(table, list(key), "left_anti")


def check_levels(lines: DataFrame, levels: DataFrame, tol: float = 1e-3, per_ev: float = 8065.46) -> DataFrame:
    """Lines whose level energies (eV) differ from the model atom (cm-1) by more than tol, relative."""
    atom = levels.select("level", "e")
    both = lines.join(maybe_broadcast(atom.withColumnsRenamed({"level": "n_lo", "e": "_e_lo"})), "n_lo") \
        .join(maybe_broadcast(atom.withColumnsRenamed({"level": "n_up", "e": "_e_up"})), "n_up")
    off = lambda a, b: F.coalesce(
        F.abs(F.col(a) * per_ev - F.col(b)) > tol * F.abs(F.col(b)), F.lit(False))
    return both.withColumns({"bad_lo": off("e_lo", "_e_lo"), "bad_up": off("e_up", "_e_up")}) \
        .filter("bad_lo OR bad_up").drop("_e_lo", "_e_up")


def sort_by_species(lines: DataFrame, code: str = "species", ion: str = "ion",
                    position: Sequence[str] = ("line_no",)) -> DataFrame:
    """By species code, stage and input position (a total order, since Spark sorts are not stable)."""
    return lines.orderBy(code, ion, *position)


def count_lines(lines: DataFrame, key: Sequence[str] = ("species",)) -> DataFrame:
    """Per species: rows read, written and skipped, from one pass over lines with reject_reason."""
    return lines.groupBy(*key).agg(
        F.count(F.lit(1)).alias("n_read"), F.count_if(F.col("reject_reason").isNull()).alias("n_written"),
        F.count("reject_reason").alias("n_skipped"))
