"""Headline queries at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``; prints one JSON line."""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from cohortweave.plans.catalog import QUERIES  # noqa: E402
from cohortweave.session import build_session  # noqa: E402

HEADLINE = (
    "patient_labels",
    "epilepsy_evidence",
    "burden_events",
    "medication_schedules",
    "link_mapping",
    "fused",
    "profile_numeric",
    "profile_categories",
    "profile_missing",
    "recording_features",
    "patient_signal_mean",
    "volume_features",
    "random_split",
    "impute_scale",
    "evaluate_splits",
    "baseline_model",
    "decoded_rows",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{"spark.sql.shuffle.partitions": cpus if cpus.isdigit() else "8", "spark.driver.memory": "16g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{folder}/orders.parquet").groupBy("o_orderstatus").count().collect()  # start the JVM

    def seconds(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    for name in HEADLINE:  # warm-up: compiled code and cached files
        seconds(name)
    timings = {name: round(statistics.median(seconds(name) for _ in range(3)), 3) for name in HEADLINE}
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "sf": os.path.basename(folder.rstrip("/")),
            }
        )
    )


if __name__ == "__main__":
    main()
