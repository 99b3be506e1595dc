"""Column expressions for model names, microturbulence labels and widths."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed value: the file-name layout of a model on the grid
MODEL_NAME = r"^p(\d+)_g([+\-]\d+\.\d+)_m0\.0_t(\d+)_st_z([+\-]\d+\.\d+)_a([+\-]\d+\.\d+)_.*\.mod"
LIGHT_KMS = 2.99792458e5


def parse_model_name(name: Column) -> Column:
    """STRUCT<teff, logg, turb, feh, alpha>, null where the name has another layout."""
    part = lambda i: F.regexp_extract(name, MODEL_NAME, i)
    return F.when(F.regexp_like(name, F.lit(MODEL_NAME)), F.struct(
        part(1).cast("int").alias("teff"), part(2).cast("double").alias("logg"), part(3).alias("turb"),
        part(4).cast("double").alias("feh"), part(5).cast("double").alias("alpha")))


def format_model_name(teff: Column, logg: Column, feh: Column, turb: Column, ext: str = ".mod") -> Column:
    return F.format_string(
        "p%d_g%+.1f_m0.0_t%s_st_z%+.2f_a+0.00_c+0.00_n+0.00_o+0.00_r+0.00_s+0.00" + ext,
        teff.cast("int"), logg, turb, feh)


def turb_normalise(s: Column) -> Column:
    """STRUCT<label, value>: digits become two characters, values above 10 are tenths, text is 1.0."""
    text = F.trim(s)
    number = text.try_cast("double")
    label = F.when(F.regexp_like(text, F.lit(r"^\d+$")),
                   F.format_string("%02d", text.try_cast("bigint"))).otherwise(text)
    value = F.when(number.isNull(), 1.0).when(number > 10, number / 10).otherwise(number)
    return F.struct(label.alias("label"), value.alias("value"))


def fwhm_to_wave(fwhm: Column, wave: Column) -> Column:
    """Width in Angstrom: negative input is km/s, positive input is milli-Angstrom."""
    return F.when(fwhm < 0, -fwhm * wave / LIGHT_KMS).otherwise(fwhm / 1000.0)


def sig_len(s: Column) -> Column:
    """Length without trailing blanks."""
    return F.length(F.rtrim(s))


def doppler_shift(wave: Column, velocity: Column, light: float = LIGHT_KMS) -> Column:
    return wave * (1 - velocity / light)


def limb_radius(mu: Column) -> Column:
    return F.sqrt(1 - mu * mu)


def config_override(value: Column, default: Column) -> Column:
    return F.coalesce(value, default)


def parse_overrides(text: Column) -> Column:
    """A JSON object {"Z": abundance, ...} as ARRAY<STRUCT<z, a>> ordered by z."""
    entries = F.map_entries(F.from_json(text, "map<string,double>"))
    return F.array_sort(F.transform(entries, lambda e: F.struct(
        e["key"].try_cast("int").alias("z"), e["value"].alias("a"))))
