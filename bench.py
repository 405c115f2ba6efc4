"""Headline-query benchmark.

Runs the eight requirements (Q1-Q8) over ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) on
``local[$BENCH_CPUS]`` and prints one JSON line. Each query is executed in full through the
``noop`` sink (the whole plan runs, nothing is collected); after a warm-up pass each query is timed
``$BENCH_REPEAT`` times (default 5) and its median is reported. The streaming replay writes its own
input (the ad log as text files) on every run and is timed like the others (default 3 runs).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from clicklens.plans.registry import batch_queries  # noqa: E402
from clicklens.plans.replays import stream_queries  # noqa: E402
from clicklens.session import build_session  # noqa: E402

HEADLINE = {
    "q1_hot_category_top10": "hot_category_top10",
    "q2_hot_category_session_top10": "hot_category_session_top10",
    "q3_page_conversion": "page_conversion",
    "q8_page_avg_dwell": "page_avg_dwell",
    "q4_blacklist_users": "blacklist_users",
    "q4_blacklist_filtered_counts": "blacklist_filtered_counts",
    "q5_ads_click_daily": "ads_click_daily",
    "q6_ads_area_top3_json": "ads_area_top3_json",
    "q7_ads_last_minute": "ads_last_minute",
    "q7_ads_sliding_60s": "ads_sliding_60s",
}
STREAM = {"q5_stream_ads_click_daily": "stream_ads_click_daily"}


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=cpus,
                          extra={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "4g")})
    qs = batch_queries()
    sq = stream_queries()
    # warm-up: JIT, file listing, the streaming engine
    for name in HEADLINE.values():
        run(qs[name](spark, sf_dir))
    for name in STREAM.values():
        run(sq[name](spark, sf_dir))
    repeat = int(os.environ.get("BENCH_REPEAT", "5"))
    times = {}
    for label, name in HEADLINE.items():
        runs = []
        for _ in range(repeat):
            t0 = time.perf_counter()
            run(qs[name](spark, sf_dir))
            runs.append(time.perf_counter() - t0)
        times[label] = round(statistics.median(runs), 3)
    stream_repeat = int(os.environ.get("BENCH_STREAM_REPEAT", "3"))
    for label, name in STREAM.items():
        runs = []
        for _ in range(stream_repeat):
            t0 = time.perf_counter()
            run(sq[name](spark, sf_dir))
            runs.append(time.perf_counter() - t0)
        times[label] = round(statistics.median(runs), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
                      "cpus": cpus}))
    spark.stop()


if __name__ == "__main__":
    main()
