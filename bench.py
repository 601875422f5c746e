"""Headline timings: one JSON line. Each query runs twice; the second run (warm JVM) counts."""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from trackloom.plans.registry import queries  # noqa: E402
from trackloom.session import build_session  # noqa: E402

HEADLINE = (
    "analyze_dirs",
    "bbox_quantiles",
    "tube_lengths",
    "tubes_auto",
    "overlap_by_action",
    "iou_summary",
    "clean_json",
    "fpswin_mask",
    "crop_plan",
    "xds_action_pairs",
    "split_std",
    "hhi_profile",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("bench", cpus)
    spark.sparkContext.setLogLevel("ERROR")
    registered, seconds = queries(), {}
    for name in HEADLINE:
        for _ in range(2):
            start = time.perf_counter()
            registered[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            seconds[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline queries, warm JVM, total wall time",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(sf_dir).name.removeprefix("sf"),
                "cpus": int(cpus),
                "shuffle_partitions": int(cpus),
            }
        )
    )


if __name__ == "__main__":
    main()
