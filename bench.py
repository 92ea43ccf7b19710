"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query runs once untimed (warm-up) and 3 timed times, from the raw tables
into a no-op sink: fixture views and all else it derives are made anew in every
run and are part of its time. The median is reported. One JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = ["interval_onset", "status_flags", "asof_weather", "race_median_fill", "onset_label",
            "two_level_fill", "group_split", "roc_auc", "metrics_row", "score_requests", "lap_risk",
            "fit_stats"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    warmup = int(os.environ.get("BENCH_WARMUP", "1"))
    keys = [k for k in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if k]
    from seqrisk.plans import queries as Q
    from seqrisk.session import get_session
    spark = get_session(master=f"local[{cpus}]", shuffle_partitions=cpus, app="seqrisk-bench",
                        extra={"spark.ui.showConsoleProgress": "false"})
    out = {}
    for k in keys:
        times = []
        for i in range(warmup + runs):
            spark.catalog.clearCache()              # no cached frame survives into the next run
            t0 = time.perf_counter()
            Q.QUERIES[k](spark, sf_dir).write.format("noop").mode("overwrite").save()
            if i >= warmup:                         # warm runs only (JIT, caches of the JVM)
                times.append(time.perf_counter() - t0)
        out[k] = round(statistics.median(times), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "sum_of_median_query_seconds", "value": round(sum(out.values()), 3),
                      "unit": "sec", "queries": out, "sf": sf, "cpus": cpus, "runs": runs}))


if __name__ == "__main__":
    main()
