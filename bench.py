"""Times the headline queries and prints one JSON line.

Every query runs twice in one session: ``cold`` holds the first times, ``queries`` the second.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pagesift.plans.queries import QUERIES  # noqa: E402
from pagesift.session import build_session  # noqa: E402

HEADLINE = [
    "page_nodes",
    "page_title",
    "card_extract",
    "card_dedup_first",
    "label_values",
    "contacts",
    "stat_block",
    "learning_list",
    "keyword_cards",
    "profile_merge_detail_first",
    "page_outcome",
    "retry_merge",
    "batch_rows",
    "run_metrics",
    "completeness",
    "csv_round_trip",
    "list_run",
    "stream_distinct",
]


def seconds(spark, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - start, 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        master=f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus if cpus.isdigit() else "8",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "12g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    cold = {name: seconds(spark, name, sf_dir) for name in HEADLINE}
    warm = {name: seconds(spark, name, sf_dir) for name in HEADLINE}
    n_orders = spark.read.parquet(f"{sf_dir}/orders.parquet").count()
    n_pages = -(-n_orders // 48)
    print(
        json.dumps(
            {
                "metric": "total seconds of the headline queries",
                "value": round(sum(warm.values()), 3),
                "unit": "sec",
                "queries": warm,
                "cold": cold,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "cpus": cpus,
                "cards_per_second": round(n_orders / warm["card_dedup_first"]),
                "pages_per_second": round(n_pages / warm["card_dedup_first"]),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
