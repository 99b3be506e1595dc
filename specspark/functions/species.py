"""Species codes, designations and transition letters as Column expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from specspark.functions.binding import let

# fixed values: chemical symbols in order of atomic number
SYMBOLS = (
    "H He Li Be B C N O F Ne Na Mg Al Si P S Cl Ar K Ca Sc Ti V Cr Mn Fe Co Ni Cu Zn Ga Ge As Se Br Kr Rb Sr Y Zr Nb "
    "Mo Tc Ru Rh Pd Ag Cd In Sn Sb Te I Xe Cs Ba La Ce Pr Nd Pm Sm Eu Gd Tb Dy Ho Er Tm Yb Lu Hf Ta W Re Os Ir Pt Au "
    "Hg Tl Pb Bi Po At Rn Fr Ra Ac Th Pa U"
).split()

# fixed values: default collision factor by (stage, Z); every other species has 2.5
FDAMP = {(1, 11): 2.0, (1, 14): 1.3, (1, 20): 1.8, (1, 26): 1.4, (2, 20): 1.4, (2, 38): 1.8, (2, 56): 3.0}
FDAMP_OTHER = 2.5

ORBITALS = "spdfghik"


def parse_species(code: Column) -> Column:
    """STRUCT<iel, atoms, isotopes> of a code such as 608.012016 (two digits per atom, three per isotope)."""
    number = lambda d: F.coalesce(d.try_cast("int"), F.lit(0))
    halves = F.split(F.regexp_replace(F.trim(code), r"^0+(?=\d)", ""), r"\.", 2)

    def lists(part: Column) -> Column:
        left, right = F.get(part, F.lit(0)), F.coalesce(F.get(part, F.lit(1)), F.lit(""))
        even = F.when(F.length(left) % 2 == 1, F.concat(F.lit("0"), left)).otherwise(left)
        # two digits per atom: the number itself is the sum of 100^(n-i) Z_i
        return F.struct(left.try_cast("bigint").alias("iel"), F.regexp_extract_all(even, F.lit(r"(\d\d)"), 1).alias("z"),
                        F.regexp_extract_all(right, F.lit(r"(\d\d\d)"), 1).alias("a"))

    return let(let(halves, lists), lambda p: F.struct(
        p["iel"].alias("iel"), F.transform(p["z"], number).alias("atoms"),
        F.zip_with(p["z"], F.slice(p["a"], F.lit(1), F.size(p["z"])), lambda z, a: number(a)).alias("isotopes")))


def atomic_number(symbol: Column) -> Column:
    """Z of a chemical symbol, 0 if there is none."""
    return F.array_position(F.array(*[F.lit(s) for s in SYMBOLS]), symbol).cast("int")


def with_species(df: DataFrame, full: Column) -> DataFrame:
    """Adds species, iel, ion, atoms, isotopes of e.g. Fe+, (48)TiO, (12)C(13)C+; smaller Z first.

    Staged in columns, so that each array is made once per row.
    """
    part = r"(?:\((\d+)\))?([A-Z][a-z]?)"
    df = df.withColumn("_f", F.trim(full))
    df = df.withColumns({"_n": F.regexp_extract_all("_f", F.lit(part), 2), "_m": F.regexp_extract_all("_f", F.lit(part), 1),
                         "_q": F.regexp_extract("_f", r"\+(\d*)$", 1), "_plus": F.regexp_like("_f", F.lit(r"\+\d*$"))})
    pairs = F.zip_with("_n", "_m", lambda n, m: F.struct(
        atomic_number(n).alias("z"), F.coalesce(m.try_cast("int"), F.lit(0)).alias("a")))
    df = df.withColumn("_p", pairs)
    # two atoms change places when the first is heavier; equal ones keep the written order
    swap = (F.size("_p") == 2) & (F.get("_p", F.lit(0))["z"] > F.get("_p", F.lit(1))["z"])
    df = df.withColumn("_p", F.when(swap, F.reverse("_p")).otherwise(F.col("_p")))
    df = df.withColumns({"atoms": F.transform("_p", lambda p: p["z"]), "isotopes": F.transform("_p", lambda p: p["a"])})
    digits = lambda c, n: F.array_join(F.transform(c, lambda v: F.lpad(v.cast("string"), n, "0")), "")
    df = df.withColumn("_code", F.regexp_replace(digits("atoms", 2), "^0", ""))
    return df.withColumns({
        "species": F.concat("_code", F.lit("."), digits("isotopes", 3)),
        "iel": F.col("_code").try_cast("bigint"),
        "ion": F.when(F.col("_plus"), F.coalesce(F.col("_q").try_cast("int"), F.lit(1)) + 1).otherwise(1),
    }).drop("_f", "_n", "_m", "_q", "_plus", "_p", "_code")


def extract_designation(refs: Column, data_token: Column) -> Column:
    """Last blank-delimited word of the reference row without text before an isotope; the word of the
    data row wins unless the two agree up to a charge."""
    word = F.element_at(F.split(F.rtrim(F.regexp_replace(refs, r"['\s]+$", "")), r"\s+"), -1)

    def choose(full: Column) -> Column:
        charge = F.substring(full, F.length(data_token) + 1, F.length(full))
        same = F.startswith(full, data_token) & F.regexp_like(charge, F.lit(r"^(\+\d*)?$"))
        return F.when(same, full).otherwise(data_token)

    return let(let(word, lambda w: F.when(F.contains(w, F.lit("(")), F.regexp_extract(w, r"(\(.*)$", 1)).otherwise(w)), choose)


def coupling(designation: Column) -> Column:
    """Columns 4-5 of a level row, '__' when blank."""
    return F.coalesce(F.nullif(F.rpad(F.substring(designation, 4, 2), 2, " "), F.lit("  ")), F.lit("__"))


def shrink_designation(designation: Column) -> Column:
    """STRUCT<coupling, desig>: text from column 6, left-adjusted, blanks collapsed."""
    text = F.trim(F.regexp_replace(F.substring(designation, 6, 1 << 30), r" +", " "))
    return F.struct(coupling(designation).alias("coupling"), text.alias("desig"))


def orbital_letters(designation: Column) -> Column:
    """l of the last and the last but one orbital letter of the configuration, -1 where there is none."""
    config = F.regexp_extract(F.rtrim(F.substring(designation, 6, 1 << 30)), r"^(.*) +\S+$", 1)
    at = lambda letters, back: F.coalesce(
        F.nullif(F.instr(F.lit(ORBITALS), F.try_element_at(letters, F.lit(-back))), F.lit(0)) - 1, F.lit(-1))
    return let(F.regexp_extract_all(config, F.lit(f"([{ORBITALS}])"), 1), lambda found: F.array(at(found, 1), at(found, 2)))


def with_transition(df: DataFrame, lower: Column, upper: Column, out_lower: str = "lev_lo", out_upper: str = "lev_up") -> DataFrame:
    """Adds the orbital letters of a transition, 'X' when unknown, from its two level rows."""
    none = F.array(F.lit(-1), F.lit(-1))
    known = lambda d: F.substring(d, 4, 2).isin("LS", "JJ", "JK", "LK")
    df = df.withColumns({"_lo": F.when(known(lower), orbital_letters(lower)).otherwise(none),
                         "_up": F.when(known(upper), orbital_letters(upper)).otherwise(none)})
    df = df.withColumns({"_l1": F.col("_lo")[0], "_l2": F.col("_lo")[1], "_u1": F.col("_up")[0], "_u2": F.col("_up")[1]})
    l1, l2, u1, u2 = (F.col(c) for c in ("_l1", "_l2", "_u1", "_u2"))
    step = lambda a, b: F.abs(a - b) == 1
    pair = lambda a, b: F.struct(a.alias("l"), b.alias("u"))
    other = (l1 >= 0) & (u1 >= 0) & ~step(l1, u1)
    # first combination with a step of one; the order of the alternatives is fixed
    second = (
        F.when((l2 < 0) & (u2 >= 0) & ((u1 == l1) | step(l1, u2)), pair(l1, u2))
        .when((l2 >= 0) & (u2 < 0) & ((l1 == u1) | step(u1, l2)), pair(l2, u1))
        .when((l2 >= 0) & (u2 >= 0) & step(l1, u2), pair(l1, u2))
        .when((l2 >= 0) & (u2 >= 0) & step(l2, u1), pair(l2, u1))
        .when((l2 >= 0) & (u2 >= 0) & step(l2, u2), pair(l2, u2))
        .otherwise(pair(l1, u1)))
    guess = lambda v: F.when(v == 0, 1).otherwise(v - 1)
    chosen = (
        F.when((l1 == -1) & (u1 == -1), pair(F.lit(-1), F.lit(-1)))
        .when((l1 >= 3) | (u1 >= 3), pair(F.lit(2), F.lit(3)))
        .when(other, second)
        .when((l1 < 0) & (u1 >= 0), pair(guess(u1), u1))
        .when((l1 >= 0) & (u1 < 0), pair(l1, guess(l1)))
        .otherwise(pair(l1, u1)))
    letter = lambda v: F.when(v < 0, "X").otherwise(F.substring(F.lit(ORBITALS), v + 1, F.lit(1)))
    df = df.withColumn("_c", chosen)
    return df.withColumns({out_lower: letter(F.col("_c")["l"]), out_upper: letter(F.col("_c")["u"])}) \
        .drop("_lo", "_up", "_l1", "_l2", "_u1", "_u2", "_c")


def default_fdamp(ion: Column, z: Column, is_molecule: Column, gamma6: Column) -> Column:
    """gamma6 of the list if it is not zero, else the default of the species."""
    atom = reduce(lambda acc, kv: acc.when((ion == kv[0][0]) & (z == kv[0][1]), kv[1]), FDAMP.items(),
                  F.when(is_molecule, FDAMP_OTHER)).otherwise(FDAMP_OTHER)
    return F.when(F.coalesce(gamma6, F.lit(0.0)) != 0, gamma6).otherwise(atom)
