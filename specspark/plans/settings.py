"""Settings of runs: defaults, and overrides of single values at any level, down to one isotope."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from specspark.functions.binding import let

#: Settings with one value, and their types.
SCALARS = {"abund_source": "string", "metallicity": "double", "alpha_fe": "double", "helium": "double", "r_process": "double", "s_process": "double",
           "turbvel": "double"}
#: Settings that are lists of [code, value].
PAIRS = ("individual_abundances", "isotopes")
SCHEMA = ", ".join([f"{k} {t}" for k, t in SCALARS.items()] + [f"{k} array<array<double>>" for k in PAIRS])


def _pairs(rows: Column) -> Column:
    """The [code, value] rows that are whole."""
    return F.filter(F.coalesce(rows, F.array().cast("array<array<double>>")), lambda p: (F.size(p) >= 2) & F.get(p, F.lit(0)).isNotNull())


def _latest(entries: Column) -> Column:
    """A map of ARRAY<STRUCT<key, value>>; of equal keys the last entry counts."""
    keys = F.array_distinct(F.transform(entries, lambda e: e["key"]))
    value = lambda k: F.element_at(F.filter(entries, lambda e: e["key"] == k), -1)["value"]
    return F.map_from_arrays(keys, F.transform(keys, value))


def _abundances(rows: Column) -> Column:
    """MAP<z, a_log> of [[z, a_log], ...]."""
    entry = lambda p: F.struct(F.get(p, F.lit(0)).cast("int").alias("key"), F.get(p, F.lit(1)).alias("value"))
    return let(F.transform(_pairs(rows), entry), _latest)


def _isotopes(rows: Column) -> Column:
    """MAP<z, MAP<a, fraction>> of [[z.aaa, fraction], ...]."""
    def split(p: Column) -> Column:
        code = F.round(F.get(p, F.lit(0)) * 1000).cast("int")
        return F.struct(F.floor(code / 1000).cast("int").alias("z"), (code % 1000).alias("key"), F.get(p, F.lit(1)).alias("value"))

    def by_element(all_: Column) -> Column:
        elements = F.array_distinct(F.transform(all_, lambda e: e["z"]))
        own = lambda z: F.transform(F.filter(all_, lambda e: e["z"] == z), lambda e: F.struct(e["key"].alias("key"), e["value"].alias("value")))
        return F.map_from_arrays(elements, F.transform(elements, lambda z: let(own(z), _latest)))

    return let(F.transform(_pairs(rows), split), by_element)


def parse_settings(text: Column) -> Column:
    """STRUCT of the SCALARS, individual_abundances MAP<z, a_log> and isotopes MAP<z, MAP<a, fraction>> of one JSON object.

    What is absent, null or of another type is null or an empty map: it overrides nothing. Null and broken texts override nothing.
    """
    return let(F.from_json(text, SCHEMA), lambda p: F.struct(
        *[p[k].alias(k) for k in SCALARS], _abundances(p["individual_abundances"]).alias("individual_abundances"), _isotopes(p["isotopes"]).alias("isotopes")))


def _over(low: Column, high: Column) -> Column:
    """Two settings of one kind: a value of the higher one counts, and maps are merged entry by entry."""
    plain = lambda _, a, b: F.coalesce(b, a)
    none = F.create_map().cast("map<int,double>")
    nested = lambda _, a, b: F.map_zip_with(F.coalesce(a, none), F.coalesce(b, none), plain)
    return F.struct(*[F.coalesce(high[k], low[k]).alias(k) for k in SCALARS],
                    F.map_zip_with(low["individual_abundances"], high["individual_abundances"], plain).alias("individual_abundances"),
                    F.map_zip_with(low["isotopes"], high["isotopes"], nested).alias("isotopes"))


def merge_settings(levels: Sequence[Column]) -> Column:
    """One STRUCT as of ``parse_settings`` from JSON texts, the weakest first (defaults, grid, grid point, ...).

    A stronger level replaces single values: one element of the abundances, one isotope of an element; the others stay.
    """
    if not levels:
        raise ValueError("no level of settings")
    return reduce(lambda low, high: let(F.struct(low.alias("l"), high.alias("h")), lambda p: _over(p["l"], p["h"])), [parse_settings(t) for t in levels])


def abundance_rows(settings: Column) -> Column:
    """ARRAY<STRUCT<z, a_log>> ordered by z: the overrides of ``abundances``."""
    return F.array_sort(F.transform(F.map_entries(settings["individual_abundances"]), lambda e: F.struct(e["key"].alias("z"), e["value"].alias("a_log"))))


def isotope_rows(settings: Column) -> Column:
    """ARRAY<STRUCT<z, a, frac>> ordered by z, a: the changes of ``override_isotopes``."""
    rows = F.transform(F.map_entries(settings["isotopes"]), lambda e: F.transform(
        F.map_entries(e["value"]), lambda i: F.struct(e["key"].alias("z"), i["key"].alias("a"), i["value"].alias("frac"))))
    return F.array_sort(F.flatten(rows))
