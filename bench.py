"""Time the headline queries.  Prints one JSON line.

BENCH_SF_DIR  folder of the tables (default /root/testdata/sf0.1)
BENCH_CPUS    local cores (default 8)
BENCH_QUERIES comma separated names instead of the headline list
"""

from __future__ import annotations

import json
import os
import sys
import time

HEADLINE = [
    "ds_panel", "panel_densify", "roll_sum", "roll_ratio", "lag_previous", "yoy", "percentile_rank", "prep_winsorize",
    "first_indicators", "repeat_customers", "los_rollup_sil", "los_trend_dia", "downline_rollup", "upline_features",
    "index_vs_average", "promo_response", "award_monthly_yearly", "engagement_features", "commerce_funnel",
    "renewal_label", "renewal_train", "migration_label_3m", "migration_label_6m", "yearly_label", "cohort_summary",
    "feature_table",
]


def main() -> None:
    cpus = os.environ.get("BENCH_CPUS", "8")
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or HEADLINE
    from memberlytics.plans import QUERIES
    from memberlytics.session import build_session, staging_run

    spark = build_session(
        "bench", f"local[{cpus}]", spark__sql__shuffle__partitions=cpus, spark__ui__enabled="false",
        spark__driver__memory=os.environ.get("BENCH_MEMORY", "16g"),
    )
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["dq_profile"](spark, sf).write.format("noop").mode("overwrite").save()  # start-up, not counted
    times = {}
    with staging_run(spark):
        for name in names:
            start = time.time()
            QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()
            times[name] = round(time.time() - start, 3)
            print(f"{name} {times[name]}", file=sys.stderr, flush=True)
    spark.stop()
    total = round(sum(times.values()), 3)
    print(json.dumps({"metric": "total_seconds", "value": total, "unit": "sec", "queries": times, "sf": os.path.basename(sf.rstrip("/"))}))


if __name__ == "__main__":
    main()
