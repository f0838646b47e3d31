"""Headline-query benchmark: prints ONE JSON line.

Runs each headline query on ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1)
with ``local[$BENCH_CPUS]``: one warm-up, then the median of
``$BENCH_RUNS`` (default 5) timed runs.  A run executes the full plan into
Spark's ``noop`` sink (every row produced, nothing collected to the driver).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

from lakeledger.plans import registry  # noqa: E402
from lakeledger.session import build_session  # noqa: E402

HEADLINE = [
    "q_readmission_30d",
    "q_latest_per_key",
    "q_latest_per_key_agg",
    "q_upsert_all",
    "q_upsert_changed_only",
    "q_scd1_delta",
    "q_scd2_history",
    "q_scd2_incremental",
    "q_scd2_incremental_fast",
    "q_scd2_as_of_join",
    "q_auto_cdc_scd2",
    "q_change_feed_diff",
    "q_stream_bronze_to_silver",
    "q_stream_scd2_incremental",
    "q_stream_scd2_fast",
    "q_stream_scd2_two_part",
    "q_medallion_end_to_end",
]


LONG_S = 10  # queries whose warm-up takes longer are timed twice


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "5"))
    names = sys.argv[1:] or HEADLINE
    spark = build_session(f"local[{cpus}]", app="lakeledger-bench", shuffle_partitions=cpus,
                          conf={"spark.driver.memory": "16g"})
    qs = registry.queries()
    times: dict[str, float] = {}
    errors: dict[str, str] = {}
    for name in names:
        def once() -> float:
            t = time.perf_counter()
            qs[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            return time.perf_counter() - t
        try:
            warm_up = once()
            n = runs if warm_up < LONG_S else min(runs, 2)
            times[name] = round(statistics.median(once() for _ in range(n)), 4)
        except Exception as e:  # keep measuring the others; report the failure
            errors[name] = (str(e).splitlines() or [repr(e)])[0][:300]
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({
        "metric": "sum_of_median_query_seconds",
        "value": round(sum(times.values()), 4),
        "unit": "sec",
        "queries": times,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
        "cpus": cpus,
        "shuffle_partitions": cpus,
        "runs": runs,
        **({"errors": errors} if errors else {}),
    }))


if __name__ == "__main__":
    main()
