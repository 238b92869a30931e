"""Headline queries on local[$BENCH_CPUS] over $BENCH_SF_DIR; prints one JSON line.

Each query is timed from building the plan to the last row of a no-op write. One warm-up round, then the
median of BENCH_ROUNDS (default 3).
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from salestax_spark.plans.job import MERCHANTS, RAW_CHARGES, RAW_ORDERS, RAW_REFUNDS, THRESHOLDS, transform  # noqa: E402
from salestax_spark.session import build_session  # noqa: E402
from salestax_spark.sources import reference_data  # noqa: E402
from salestax_spark.sources.tables import FolderStore  # noqa: E402
from testbed import projection  # noqa: E402
from testbed.queries import QUERIES  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
ROUNDS = int(os.environ.get("BENCH_ROUNDS", "3"))
HEADLINE = (
    "stg_charges",
    "stg_refunds",
    "unified_transactions",
    "data_issues",
    "nexus_exposure",
    "cross_store_duplicates",
    "check_results",
    "merchant_kpis",
)


def timed(action) -> float:
    start = time.perf_counter()
    action()
    return time.perf_counter() - start


def drain(spark, name: str) -> None:
    QUERIES[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()


def raw_tables(spark, location: str) -> dict:
    """Raw Parquet tables for the job, in one file per core as a feed would deliver many."""
    raw = {
        RAW_CHARGES: projection.raw_charges(spark, SF_DIR).repartition(int(CPUS)),
        RAW_ORDERS: projection.raw_orders(spark, SF_DIR).repartition(int(CPUS)),
        RAW_REFUNDS: projection.raw_refunds(spark, SF_DIR).repartition(int(CPUS)),
        THRESHOLDS: reference_data.threshold_table(spark),
        MERCHANTS: reference_data.merchant_table(spark),
    }
    store = FolderStore(spark, location)
    return {name: store.replace(name, df) for name, df in raw.items()}


def main() -> None:
    spark = build_session(
        "bench",
        **{
            "spark.master": f"local[{CPUS}]",
            "spark.sql.shuffle.partitions": CPUS,
            "spark.ui.enabled": "false",
            "spark.driver.memory": "8g",
            "spark.python.sql.dataFrameDebugging.enabled": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    actions = {name: (lambda name=name: drain(spark, name)) for name in HEADLINE}
    with tempfile.TemporaryDirectory(prefix="bench-") as scratch:
        raw = raw_tables(spark, scratch)
        actions["raw_to_marts"] = lambda: transform(raw, FolderStore(spark, scratch), projection.AS_OF)
        for action in actions.values():
            action()
        seconds = {name: statistics.median(timed(action) for _ in range(ROUNDS)) for name, action in actions.items()}
    sf = re.search(r"sf([\d.]+)", SF_DIR)
    print(
        json.dumps(
            {
                "metric": "headline_total_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": {name: round(value, 3) for name, value in seconds.items()},
                "sf": float(sf.group(1)) if sf else None,
                "cpus": CPUS,
                "spark": spark.version,
                "state": "warm, median",
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
