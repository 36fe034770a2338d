"""Time the headline queries and print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) select data and
cores. Every query runs to a full result (noop sink) after one warm-up query.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "value_recovery", "factor_panel", "domain_price_volume", "domain_moneyflow", "domain_cost_distribution", "domain_fundamental", "domain_intraday",
    "model_panel", "asof_join", "asof_join_time_sliced", "interval_asof_join", "cs_rank_average", "cs_rank_average_split", "quantile_bucket",
    "neutralize_industry_size", "ic_summary", "universe_pool", "column_profile", "dedup_keep_last", "compact_bar_parts",
]


def main() -> None:
    from tidepanel.session import build_session

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "tidepanel-bench", f"local[{cpus}]", spark__sql__shuffle__partitions=cpus, spark__ui__enabled="false", spark__driver__memory="12g"
    )
    spark.sparkContext.setLogLevel("ERROR")
    from suite import QUERIES

    def timed(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return round(time.perf_counter() - start, 3)

    timed("resume_dates")
    times = {name: timed(name) for name in (sys.argv[1:] or HEADLINE)}
    spark.stop()
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")}))


if __name__ == "__main__":
    main()
