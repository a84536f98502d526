"""Headline queries, timed; one JSON line.

BENCH_SF_DIR names the data folder and BENCH_CPUS the local cores. Each query runs once to warm
up and once for the clock; the rows go to the ``noop`` sink, so nothing is collected.
"""

from __future__ import annotations

import json
import os
import sys
import time

from tabmill.plans import all_queries
from tabmill.session import local_session

HEADLINE = """fraud_flow fraud_prep split_counts split_chrono split_stratified holdout_fixed label_codes
standardize_clip normalize_all summary_stats mi_top10 lags term_counts tfidf nb_scores weighted_pr aucpr_many_scores
regression_metrics asof_join latest_values snapshot_stats ingest_lines ingest_row_time skew drift_daily hourly_counts
stream_hourly run_metrics lineage_closure instances_parsed csv_round_trip linear_score gbt_scores""".split()


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    spark = local_session(cpus, "bench", spark__sql__shuffle__partitions=cpus, spark__driver__memory="12g")
    spark.sparkContext.setLogLevel("OFF")
    queries = all_queries()[0]
    names = sys.argv[1:] or HEADLINE
    times = {}
    for name in names:
        for _ in range(2):
            start = time.perf_counter()
            queries[name](spark, sf).write.format("noop").mode("overwrite").save()
            times[name] = round(time.perf_counter() - start, 3)
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": os.path.basename(sf.rstrip("/")).removeprefix("sf"),
                      "cpus": int(cpus)}))
    spark.stop()


if __name__ == "__main__":
    main()
