"""Time the headline queries; prints one JSON line.

``BENCH_SF_DIR`` names the data and ``BENCH_CPUS`` the local cores.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tidelog import fixtures as fx  # noqa: E402
from tidelog.plans.queries import QUERIES  # noqa: E402
from tidelog.session import local_session  # noqa: E402

HEADLINE = (
    "envelope_decode",
    "changelog_stream",
    "upsert_kafka_encode",
    "upsert_kafka_table",
    "upsert_kafka_changelog",
    "resequence",
    "cdc_apply",
    "upsert_apply",
    "insert_if_absent",
    "update_by_key",
    "cdc_feed",
    "rolling_text_sink",
    "partitioned_insert",
    "jdbc_scan",
    "cdc_apply_stream",
    "upsert_apply_stream",
    "resequence_stream",
    "job_cdc_upsert",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session("bench", os.environ.get("BENCH_CPUS", "8"))
    events = fx.table(spark, sf_dir, "events").count()
    QUERIES["cdc_apply"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in HEADLINE:
        began = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - began, 3)
    print(
        json.dumps(
            {
                "metric": "total time of headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "events_per_sec": {n: round(events / s) for n, s in seconds.items()},
                "sf": float(os.path.basename(sf_dir.rstrip("/")).removeprefix("sf") or 0),
            }
        )
    )


if __name__ == "__main__":
    main()
