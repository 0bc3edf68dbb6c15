"""Time the headline queries; prints one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the cores, ``BENCH_QUERIES`` (optional,
comma separated) other queries.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from textrisk.plans.catalog import QUERIES  # noqa: E402
from textrisk.session import build_session  # noqa: E402

HEADLINE = (
    "anonymize_text message_view message_features file_counters pseudonymized_messages "
    "dataset_summary feature_describe weak_labels labeling_sample row_cap kfold_assignment "
    "hourly_trend monthly_trend top_users tokens_ngrams vocabulary tfidf roc_points"
).split()


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    chosen = os.environ.get("BENCH_QUERIES")
    names = chosen.split(",") if chosen else HEADLINE
    spark = build_session(
        "bench", f"local[{cores}]", spark__sql__shuffle__partitions=cores,
        spark__ui__enabled="false", spark__driver__memory="12g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    # Start the executor threads and load the code paths once before the clock runs.
    QUERIES["risk_score"](spark, folder).limit(10).collect()
    timings = {}
    for name in names:
        started = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        timings[name] = round(time.perf_counter() - started, 3)
    scale = re.search(r"sf([0-9.]+)", folder)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "sf": float(scale.group(1)) if scale else None,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
