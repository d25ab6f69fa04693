"""Headline queries, timed. Prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) set the
data and the number of local threads. Every query is run to its last row; the
result is thrown away by Spark's "noop" sink, so nothing is collected.
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import SparkSession

from millrace.plans.queries import QUERIES
from millrace.plans.queries.registry import table
from millrace.plans.queries.stored import scratch_database
from millrace.plans.sync import sync
from millrace.session import tune

HEADLINE = (
    "revenue_by_month",
    "revenue_by_segment_year",
    "margin_by_supplier",
    "reporting_union",
    "row_checksum_joined",
    "numeric_coercion",
    "merge_keyed",
    "merge_delta",
    "merge_dedup_source",
    "scd2_snapshot",
    "scd2_version_intervals",
    "event_ingest",
    "event_pending",
    "event_archive",
    "event_log_outcomes",
    "pii_hash_replace",
    "pii_realistic",
    "check_foreign_key",
    "nested_orders",
    "where_relation",
    "entity_fanout",
    "part_list_per_order",
)
LINE_KEYS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]


def timed(job) -> float:
    start = time.perf_counter()
    job()
    return round(time.perf_counter() - start, 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    tune(spark)
    table(spark, sf_dir, "lineitem").write.format("noop").mode("overwrite").save()

    seconds: dict[str, float] = {}
    for name in HEADLINE:
        query = QUERIES[name]
        seconds[name] = timed(
            lambda query=query: query(spark, sf_dir).write.format("noop").mode("overwrite").save()
        )

    # The reference figure: a keyed checksum sync, first load and then a change of
    # every row. Both read the source, merge, rewrite the table and count.
    name = f"{scratch_database(spark)}.lines"
    lines = table(spark, sf_dir, "lineitem")
    changed = lines.withColumn("l_tax", lines["l_tax"] + 1)
    seconds["sync_first_load"] = timed(lambda: sync(lines, name, keys=LINE_KEYS))
    seconds["sync_all_changed"] = timed(lambda: sync(changed, name, keys=LINE_KEYS))
    seconds["stream_event_ingest"] = timed(
        lambda: QUERIES["stream_event_ingest"](spark, sf_dir).count()
    )
    n_lines = lines.count()
    print(
        json.dumps(
            {
                "metric": "total_seconds_headline_queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "sync_rows_per_sec": round(2 * n_lines / (
                    seconds["sync_first_load"] + seconds["sync_all_changed"]
                )),
                "sync_rows": n_lines,
                "local_cores": int(cpus),
                "baseline_sync_rows_per_sec": 4000,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
