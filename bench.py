"""Time the registered queries and print one JSON line.

Reads $BENCH_SF_DIR (default /root/testdata/sf0.1) on local[$BENCH_CPUS] and
computes every row of every query without keeping it. A query is built anew for
each run, so planning and any intermediate table count too. All queries run
$BENCH_RUNS times in turn (default 2, as the first round also warms up the JVM)
and the best time of each is reported.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent))

from catalogue.queries import QUERIES  # noqa: E402

HEADLINE = (
    "q1_top_color",
    "q2_lead_time",
    "q1_from_layers",
    "revenue_by_year_color",
    "store_product",
    "store_header",
    "store_detail",
    "publish_product",
    "publish_orders",
    "quality_summary",
    "null_profile_detail",
    "bad_decimals",
    "bad_order_dates",
    "duplicate_product_rows",
    "pk_duplicates_detail",
    "orphans_header",
    "orphans_product",
    "row_reconciliation",
    "read_csv_roundtrip",
    "lineitem_duplicate_rows",
    "lineitem_lead_time",
    "lineitem_orphans_orders",
    "orders_without_lines",
    "documents_without_labels",
    "ranked_colors",
    "q1_from_csv",
)


def session(cpus: str) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def seconds(query, spark: SparkSession, sf_dir: str) -> float:
    start = time.perf_counter()
    query(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = session(os.environ.get("BENCH_CPUS", "8"))
    names = sys.argv[1:] or HEADLINE
    spark.range(1).write.format("noop").mode("overwrite").save()
    rounds = [{name: seconds(QUERIES[name], spark, sf_dir) for name in names} for _ in range(runs)]
    times = {name: round(min(each[name] for each in rounds), 3) for name in names}
    total = round(sum(times.values()), 3)
    sf = sf_dir.rsplit("sf", 1)[-1]
    first = {name: round(rounds[0][name], 3) for name in names}
    print(json.dumps({"metric": "total_query_time", "value": total, "unit": "sec", "queries": times, "first_round": first, "sf": sf}))
    spark.stop()


if __name__ == "__main__":
    main()
