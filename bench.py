"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is executed in full with the ``noop`` sink (every row produced,
nothing collected); one warm-up round, then the median of ``$BENCH_RUNS``.
Prints ONE JSON line."""
from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from prepwise.plans import catalog  # noqa: E402
from prepwise.session import local_session  # noqa: E402

HEADLINE = [
    "outlier_iqr_flag", "outlier_zscore_cap", "dup_remove_all", "dup_mark", "dup_keep_first",
    "na_tokens", "type_roles", "to_number", "id_columns", "text_strip_pattern", "text_nfkc",
    "date_standardize", "unit_range", "percent_unify", "decimal_auto", "fill_ffill",
    "fill_interpolate", "missing_auto", "scale_robust", "skew_yeojohnson", "bin_freq",
    "encode_onehot", "corr_spearman", "profile", "top_values", "cell_log", "outlier_forest_flag",
    "clean_events",
]


def run(spark, name, sf_dir):
    t0 = time.perf_counter()
    df = catalog.QUERIES[name](spark, sf_dir)
    df.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    names = sys.argv[1:] or HEADLINE
    spark = local_session(cores=cpus, shuffle_partitions=int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", "16")))
    times = {}
    for n in names:
        run(spark, n, sf_dir)                       # warm-up
        times[n] = round(statistics.median(run(spark, n, sf_dir) for _ in range(runs)), 3)
    sf = sf_dir.rstrip("/").rsplit("sf", 1)[-1]
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
                      "cpus": int(cpus), "runs": runs}))


if __name__ == "__main__":
    main()
