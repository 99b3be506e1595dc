"""Abundances, isotopes, masses, partition sums and two-dimensional tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from specspark.functions.physics import partition_poly
from specspark.operators.layout import Layout, arrange, fits, maybe_broadcast, neighbours
from specspark.operators.ranges import bracket
from specspark.operators.series import SMALL_TABLE_ROWS

# fixed values: alpha elements, first element of the r/s mix
ALPHA_Z = (8, 10, 12, 14, 16, 18, 20, 22)
FIRST_RS_Z = 31
HC_K = 1.43877  # cm K


def abundance_number(a_log: Column, a_h: Column, z: Column) -> Column:
    """Number ratio to hydrogen: 1 for H, 0 for an absent element."""
    return F.when(z == 1, 1.0).when(a_log.isNull() | (a_log < -28.0), 0.0).otherwise(
        F.pow(F.lit(10.0), a_log - a_h))


def abundances(mixes: DataFrame, solar: DataFrame, rfract: DataFrame | None = None,
               overrides: DataFrame | None = None) -> DataFrame:
    """(mix_id, z, a_log) for every mix and element, on the scale A(H) = 12.

    mixes: mix_id, feh, alpha, helium, r, s.  solar: z, a_log (null = absent); with a column set_id in
    both, each mix is built on its own solar set.  A set without hydrogen is taken to be on that scale.  rfract: z, f.
    overrides: mix_id, z, a_log.  Metals move by feh, alpha elements by alpha, helium by helium;
    from Z = 31 on r and s scale the two process shares; overrides replace the result.
    """
    by = ["set_id", "z"] if "set_id" in solar.columns else ["z"]
    sizes = solar.groupBy(*by).count().agg(F.max("count").alias("rows"), F.max("z").alias("z")).first()
    if (sizes["rows"] or 0) > 1:
        raise ValueError(f"solar has several rows of one {' and '.join(by)}")
    sun = solar.select(*by, F.col("a_log").cast("double").alias("a_sun"))
    if rfract is None:
        sun = sun.withColumn("f", F.lit(None).cast("double"))
    else:
        sun = sun.join(rfract.select("z", F.col("f").cast("double").alias("f")), "z", "left")
    own_h = sun.filter("z = 1").select(*by[:-1], F.col("a_sun").alias("_h"))
    every_z = F.explode(F.sequence(F.lit(1), F.lit(max(sizes["z"] or 1, 1))))
    df = mixes.withColumn("z", every_z).join(maybe_broadcast(sun), by)
    if len(by) > 1:
        df = df.join(maybe_broadcast(own_h), by[:-1], "left").withColumn("_h", F.coalesce("_h", F.lit(12.0)))
    else:
        found = own_h.first()
        df = df.withColumn("_h", F.lit(found["_h"] if found and found["_h"] is not None else 12.0))
    ten, z = F.lit(10.0), F.col("z")
    a = F.col("a_sun") + F.when(z >= 3, F.col("feh")).otherwise(0.0) \
        + F.when(z.isin(*ALPHA_Z), F.col("alpha")).otherwise(0.0) + F.when(z == 2, F.col("helium")).otherwise(0.0)
    mixed = F.log10(F.pow(ten, F.col("r")) * F.col("f") * F.pow(ten, a)
                    + F.pow(ten, F.col("s")) * (1 - F.col("f")) * F.pow(ten, a))
    uses_rs = (z >= FIRST_RS_Z) & ((F.col("r") != 0) | (F.col("s") != 0)) & F.col("f").isNotNull()
    df = df.select("mix_id", "z", F.when(uses_rs, mixed).otherwise(a).alias("a_log"), "_h")
    if overrides is not None:
        fixed = overrides.select("mix_id", "z", F.col("a_log").alias("_fixed"))
        fixed_h = fixed.filter("z = 1").select("mix_id", F.col("_fixed").alias("_fixed_h"))
        df = df.join(maybe_broadcast(fixed), ["mix_id", "z"], "left").join(maybe_broadcast(fixed_h), "mix_id", "left")
        df = df.withColumns({"a_log": F.coalesce("_fixed", "a_log"), "_h": F.coalesce("_fixed_h", "_h")}) \
            .drop("_fixed", "_fixed_h")
    return df.withColumn("a_log", F.col("a_log") + (12.0 - F.col("_h"))).drop("_h")


def override_isotopes(isotopes: DataFrame, changes: DataFrame) -> DataFrame:
    """Isotope fractions with user values replacing (z, a); codes of several atoms are refused upstream."""
    new = maybe_broadcast(changes.select("z", "a", F.col("frac").alias("_frac")))
    return isotopes.join(new, ["z", "a"], "left").withColumn("frac", F.coalesce("_frac", "frac")).drop("_frac")


def mean_mass(isotopes: DataFrame, default: DataFrame) -> DataFrame:
    """Mean mass per element, from the default table where the fractions sum to nothing."""
    mix = isotopes.groupBy("z").agg(F.sum(F.col("frac") * F.col("mass")).alias("_mix"))
    return default.select("z", F.col("mass").alias("_default")).join(mix, "z", "left").select(
        "z", F.coalesce(F.nullif("_mix", F.lit(0.0)), F.col("_default")).alias("mass"))


def species_mass(species: DataFrame, code: str, atoms: str, isotopes: str, masses: DataFrame) -> DataFrame:
    """Per species code: total mass and (product of atom masses / total)^1.5.

    Works on the distinct codes: a list has far fewer species than lines.  masses: z, a, mass with
    a = 0 for the standard mix.
    """
    distinct = species.select(code, atoms, isotopes).distinct()
    atom = distinct.select(code, F.posexplode(F.arrays_zip(atoms, isotopes)).alias("_i", "_p")).select(
        code, F.col(f"_p.{atoms}").alias("z"), F.col(f"_p.{isotopes}").alias("a"))
    joined = atom.join(maybe_broadcast(masses.select("z", "a", "mass")), ["z", "a"], "left")
    out = joined.groupBy(code).agg(
        F.sum("mass").alias("mass"), F.exp(F.sum(F.log("mass"))).alias("_product"),
        F.count(F.when(F.col("mass").isNull(), 1)).alias("_unknown"))
    known = F.col("_unknown") == 0
    return out.select(code, F.when(known, F.col("mass")).alias("mass"),
                      F.when(known, F.pow(F.col("_product") / F.col("mass"), F.lit(1.5))).alias("reduced15"))


def mean_weight(abund: DataFrame, key: Sequence[str], weight: str, number: str, hydrogen: float = 1.008) -> DataFrame:
    """Sum of weight times number per mix, and the hydrogen mass fraction."""
    return abund.groupBy(*key).agg(F.sum(F.col(weight) * F.col(number)).alias("wgt")) \
        .withColumn("h_fraction", F.try_divide(F.lit(hydrogen), F.col("wgt")))


def partition_sum(levels: DataFrame, key: Sequence[str], energy: str, g: str, temps: Sequence[float]) -> DataFrame:
    """Q(T) = sum of g*exp(-E hc/kT) per species, one row per temperature (partial sums before the shuffle)."""
    sums = [F.sum(F.col(g) * F.exp(-HC_K * F.col(energy) / F.lit(float(t)))).alias(f"_q{i}") for i, t in enumerate(temps)]
    wide = levels.groupBy(*key).agg(*sums)
    pairs = F.array(*[F.struct(F.lit(float(t)).alias("temp"), F.col(f"_q{i}").alias("q")) for i, t in enumerate(temps)])
    return wide.select(*key, F.inline(pairs))


def partition_functions(coefs: DataFrame, temps: Sequence[float], levels: DataFrame | None = None) -> DataFrame:
    """(z, stage, temp, q): the polynomial of each ion (coef array), or the level sum of the ions that
    ``levels`` (z, stage, e, g) lists.  The polynomials fail for some heavy ions."""
    long = coefs.select("z", "stage", "coef", F.explode(F.array(*[F.lit(float(t)) for t in temps])).alias("temp"))
    q = partition_poly(F.col("coef"), F.col("temp"))
    if levels is None:
        return long.select("z", "stage", "temp", q.alias("q"))
    sums = partition_sum(levels, ["z", "stage"], "e", "g", temps).withColumnRenamed("q", "_sum")
    return long.join(maybe_broadcast(sums), ["z", "stage", "temp"], "left").select(
        "z", "stage", "temp", F.coalesce(F.col("_sum"), q).alias("q"))


def table_cells(table: DataFrame) -> DataFrame:
    """A table (x, t, v) as cells between neighbouring axis values: x0 x1 t0 t1 v00 v01 v10 v11 (x, t)."""
    def lay(df: DataFrame, key: str, order: str) -> Layout:
        return Layout(df, (key,), (order,), False) if small else arrange(df, [key], [order])

    small = fits(table, SMALL_TABLE_ROWS * 100)
    along_t = neighbours(lay(table.select("x", "t", "v"), "x", "t"), ["t", "v"], before=False).done()
    along_t = along_t.withColumnsRenamed({"next_t": "t1", "next_v": "v01", "v": "v00"})
    both = neighbours(lay(along_t, "t", "x"), ["x", "v00", "v01"], before=False).done()
    return both.filter("t1 IS NOT NULL AND next_x IS NOT NULL").select(
        F.col("x").alias("x0"), F.col("next_x").alias("x1"), F.col("t").alias("t0"), "t1", "v00", "v01",
        F.col("next_v00").alias("v10"), F.col("next_v01").alias("v11"))


def interp2d(df: DataFrame, x: str, t: str, table: DataFrame, mode: str = "log", out: str = "value") -> DataFrame:
    """Two-dimensional table look-up.

    "log": linear in x, then log-linear in t; 0 above the last x, continued at the other ends,
    never below 1e-30.  "linear": bilinear, 0 outside.
    """
    cells = table_cells(table)
    hit = bracket(df, x, table, "x", (), "_x0", "_x1")
    hit = bracket(hit, t, table, "t", (), "_t0", "_t1")
    cells = cells.select(F.col("x0").alias("_x0"), F.col("t0").alias("_t0"), "v00", "v01", "v10", "v11")
    hit = hit.join(maybe_broadcast(cells), ["_x0", "_t0"], "left")
    qx = (F.col(x) - F.col("_x0")) / (F.col("_x1") - F.col("_x0"))
    qt = (F.col(t) - F.col("_t0")) / (F.col("_t1") - F.col("_t0"))
    low, high = (qx * F.col(b) + (1 - qx) * F.col(a) for a, b in (("v00", "v10"), ("v01", "v11")))
    ends = table.agg(F.max("x").alias("x1"), F.min("x").alias("x0"), F.max("t").alias("t1"), F.min("t").alias("t0")).first()
    if mode == "log":
        power = qt * F.log(high) + (1 - qt) * F.log(low)
        value = F.when(F.col(x) > ends["x1"], 0.0).when(power > -70, F.exp(power)).otherwise(1e-30)
    else:
        inside = F.col(x).between(ends["x0"], ends["x1"]) & F.col(t).between(ends["t0"], ends["t1"])
        value = F.when(inside, qt * high + (1 - qt) * low).otherwise(0.0)
    return hit.withColumn(out, value).drop("_x0", "_x1", "_t0", "_t1", "v00", "v01", "v10", "v11")
