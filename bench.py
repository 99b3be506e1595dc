"""Headline queries on local[$BENCH_CPUS] at $BENCH_SF_DIR; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "line_opacity", "opacity_sum", "opacity_blocks", "segment_opacity", "source_function", "voigt", "damping_width", "damping_recipe", "special_lines",
    "assign_segment", "assign_segment_2", "interp_linear", "interp_linear_2", "monotone_cubic", "newton3", "cumulative_trapz",
    "column_mass", "formal_intensity", "grid_corners", "trilinear_2", "plan_jobs", "equivalent_width", "synthetic_photometry",
    "colours", "convolve", "convolve_2", "limb_profile", "curve_of_growth", "interp2d", "abundance_scale", "partition_sum",
    "read_linelist", "read_spectra", "read_marcs", "grid_lhs", "nearest_abundance", "catalog_match",
]


def main() -> None:
    from specspark import queries  # noqa: F401
    from specspark.registry import QUERIES
    from specspark.session import local_session

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    if names == ["all"]:
        names = list(QUERIES)
    spark = local_session(cpus, int(cpus) if cpus.isdigit() else 8, app="bench")
    spark.read.parquet(f"{sf_dir}/lineitem.parquet").groupBy("l_suppkey").count().collect()
    times = {}
    for name in names:
        start = time.time()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - start, 3)
    spark.stop()
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": os.path.basename(sf_dir.rstrip("/")).replace("sf", "")}))


if __name__ == "__main__":
    main()
