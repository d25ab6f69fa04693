"""Merge, deduplication and snapshots over tables derived from the given ones.

The "next delivery" of the customers is derived by their attributes: those with a
negative balance are missing from it, one segment has changed balances, and one
segment is delivered a second time under new keys.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.hashing import SYNC_CHECKSUM, SYNC_UPDATED_AT
from millrace.operators import merge, snapshot
from millrace.plans.queries.registry import iso_second, registered, table
from millrace.session import stored_rows

NEW_KEYS = 1_000_000_000_000

_SOURCE_SQL = f"""
    SELECT c_custkey, c_name, c_nationkey,
           CASE WHEN c_mktsegment = 'BUILDING' THEN c_acctbal + 1 ELSE c_acctbal END AS c_acctbal,
           c_mktsegment
    FROM customer WHERE c_acctbal >= 0
    UNION ALL
    SELECT c_custkey + {NEW_KEYS}, c_name, c_nationkey, c_acctbal, c_mktsegment
    FROM customer WHERE c_mktsegment = 'MACHINERY'
"""

_MERGED_SQL = f"""
    WITH source AS ({_SOURCE_SQL}),
    merged AS (
        SELECT coalesce(s.c_custkey, t.c_custkey) AS c_custkey,
               coalesce(s.c_name, t.c_name) AS c_name,
               coalesce(s.c_acctbal, t.c_acctbal) AS c_acctbal,
               coalesce(s.c_mktsegment, t.c_mktsegment) AS c_mktsegment,
               CASE WHEN s.c_custkey IS NULL THEN 'kept'
                    WHEN t.c_custkey IS NULL THEN 'inserted'
                    WHEN t.c_nationkey = 3 OR s.c_acctbal <> t.c_acctbal THEN 'updated'
                    ELSE 'unchanged' END AS action
        FROM customer t FULL JOIN source s ON s.c_custkey = t.c_custkey
    )
"""


def delivery(spark: SparkSession, sf: str) -> DataFrame:
    customers = table(spark, sf, "customer")
    changed = customers.where("c_acctbal >= 0").withColumn(
        "c_acctbal",
        F.when(F.col("c_mktsegment") == "BUILDING", F.col("c_acctbal") + 1).otherwise(
            F.col("c_acctbal")
        ),
    )
    added = customers.where("c_mktsegment = 'MACHINERY'").withColumn(
        "c_custkey", F.col("c_custkey") + F.lit(NEW_KEYS)
    )
    return merge.with_checksum(changed.unionByName(added))


def stored_customers(spark: SparkSession, sf: str) -> DataFrame:
    """The stored table; one nation's rows date from before checksums were kept."""
    rows = merge.with_checksum(table(spark, sf, "customer"))
    return rows.withColumn(
        SYNC_CHECKSUM, F.when(F.col("c_nationkey") != 3, F.col(SYNC_CHECKSUM))
    ).withColumn(SYNC_UPDATED_AT, F.lit("2024-01-01").cast("timestamp"))


_RUN_TIME = "2024-02-01"


def _merged(spark: SparkSession, sf: str) -> DataFrame:
    return merge.merge_keyed(
        stored_customers(spark, sf),
        delivery(spark, sf),
        ["c_custkey"],
        F.lit(_RUN_TIME).cast("timestamp"),
    )


@registered(
    "merge_keyed",
    f"""
    {_MERGED_SQL}
    SELECT c_custkey, c_name, c_acctbal, c_mktsegment, action,
           CASE WHEN action IN ('inserted', 'updated') THEN '2024-02-01 00:00:00'
                ELSE '2024-01-01 00:00:00' END AS updated_at
    FROM merged
    """,
)
def merge_keyed(spark: SparkSession, sf: str) -> DataFrame:
    return _merged(spark, sf).select(
        "c_custkey", "c_name", "c_acctbal", "c_mktsegment",
        F.col(merge.ACTION).alias("action"),
        iso_second(SYNC_UPDATED_AT).alias("updated_at"),
    )


@registered(
    "merge_action_counts",
    f"""
    {_MERGED_SQL}
    SELECT action, count(*) AS n_rows FROM merged WHERE action <> 'kept' GROUP BY ALL
    """,
)
def merge_action_counts(spark: SparkSession, sf: str) -> DataFrame:
    return merge.action_counts(_merged(spark, sf))


@registered(
    "merge_delta",
    f"""
    {_MERGED_SQL}
    SELECT c_custkey, c_name, c_acctbal, c_mktsegment,
           CASE WHEN action IN ('inserted', 'updated') THEN '2024-02-01 00:00:00'
                ELSE '2024-01-01 00:00:00' END AS updated_at
    FROM merged
    """,
)
def merge_delta(spark: SparkSession, sf: str) -> DataFrame:
    target = stored_customers(spark, sf)
    changes = stored_rows(
        merge.merge_changes(
            target, delivery(spark, sf), ["c_custkey"], F.lit(_RUN_TIME).cast("timestamp")
        )
    )
    return merge.merge_delta(target, changes, ["c_custkey"]).select(
        "c_custkey", "c_name", "c_acctbal", "c_mktsegment",
        iso_second(SYNC_UPDATED_AT).alias("updated_at"),
    )


@registered(
    "merge_checksum_only",
    """
    SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderstatus <> 'F'
    """,
)
def merge_checksum_only(spark: SparkSession, sf: str) -> DataFrame:
    orders = merge.with_checksum(table(spark, sf, "orders"))
    stored = orders.where("o_orderstatus = 'F'")
    delivered = orders.unionByName(orders.where("o_orderstatus = 'P'"))
    return merge.merge_checksum_only(stored, delivered).select(
        "o_orderkey", "o_custkey", "o_totalprice"
    )


@registered(
    "merge_dedup_source",
    """
    SELECT l_orderkey, l_linenumber, l_partkey, strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS l_shipdate
    FROM lineitem
    QUALIFY row_number() OVER (
        PARTITION BY l_orderkey ORDER BY l_shipdate DESC, l_linenumber, l_partkey, l_suppkey,
                     l_extendedprice) = 1
    """,
)
def merge_dedup_source(spark: SparkSession, sf: str) -> DataFrame:
    lines = merge.with_checksum(table(spark, sf, "lineitem"))
    order = [F.desc("l_shipdate"), *map(F.asc, ("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"))]
    return merge.dedupe_source(lines, ["l_orderkey"], order).select(
        "l_orderkey", "l_linenumber", "l_partkey", iso_second("l_shipdate").alias("l_shipdate")
    )


@registered(
    "merge_duplicate_report",
    """
    SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem
    GROUP BY ALL HAVING count(*) > 1
    """,
)
def merge_duplicate_report(spark: SparkSession, sf: str) -> DataFrame:
    return merge.duplicate_keys(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


_DAYS = ("2024-01-01", "2024-01-02", "2024-01-03")


def _customer_days(spark: SparkSession, sf: str) -> list[DataFrame]:
    """Three daily states: part of the nations, then all, then without one segment."""
    customers = table(spark, sf, "customer").select("c_custkey", "c_acctbal", "c_mktsegment")
    nations = table(spark, sf, "customer").where("c_nationkey < 20")
    raised = customers.withColumn(
        "c_acctbal",
        F.when(F.col("c_mktsegment") == "BUILDING", F.col("c_acctbal") + 100).otherwise(
            F.col("c_acctbal")
        ),
    )
    return [
        nations.select("c_custkey", "c_acctbal", "c_mktsegment"),
        raised,
        raised.where("c_mktsegment <> 'MACHINERY'"),
    ]


_SCD2_SQL = """
    WITH states AS (
        SELECT c_custkey, 1 AS d, CASE WHEN c_nationkey < 20 THEN c_acctbal END AS bal FROM customer
        UNION ALL
        SELECT c_custkey, 2, CASE WHEN c_mktsegment = 'BUILDING' THEN c_acctbal + 100 ELSE c_acctbal END
        FROM customer
        UNION ALL
        SELECT c_custkey, 3,
               CASE WHEN c_mktsegment = 'BUILDING' THEN c_acctbal + 100
                    WHEN c_mktsegment <> 'MACHINERY' THEN c_acctbal END
        FROM customer
    ),
    compared AS (
        SELECT *, lag(bal) OVER (PARTITION BY c_custkey ORDER BY d) AS before FROM states
    ),
    breaks AS (SELECT * FROM compared WHERE bal IS DISTINCT FROM before),
    ended AS (
        SELECT *, lead(d) OVER (PARTITION BY c_custkey ORDER BY d) AS next_d FROM breaks
    )
    SELECT c_custkey, bal AS c_acctbal, '2024-01-0' || d AS valid_from,
           '2024-01-0' || next_d AS valid_to
    FROM ended WHERE bal IS NOT NULL
"""


def _history(spark: SparkSession, sf: str) -> DataFrame:
    days = _customer_days(spark, sf)
    history = snapshot.empty_history(spark, days[0].schema)
    for rows, day in zip(days, _DAYS, strict=True):
        run_time = F.lit(day).cast("timestamp")
        history = stored_rows(snapshot.snapshot(rows, history, ["c_custkey"], run_time))
    return history


@registered("scd2_snapshot", _SCD2_SQL)
def scd2_snapshot(spark: SparkSession, sf: str) -> DataFrame:
    return _history(spark, sf).select(
        "c_custkey",
        "c_acctbal",
        F.date_format("valid_from", "yyyy-MM-dd").alias("valid_from"),
        F.date_format("valid_to", "yyyy-MM-dd").alias("valid_to"),
    )


@registered(
    "scd2_current",
    """
    SELECT c_custkey,
           CASE WHEN c_mktsegment = 'BUILDING' THEN c_acctbal + 100 ELSE c_acctbal END AS c_acctbal
    FROM customer WHERE c_mktsegment <> 'MACHINERY'
    """,
)
def scd2_current(spark: SparkSession, sf: str) -> DataFrame:
    return snapshot.current_versions(_history(spark, sf)).select("c_custkey", "c_acctbal")


@registered(
    "scd2_timestamp_strategy",
    """
    SELECT o_custkey,
           strftime(o_orderdate, '%Y-%m-%d') AS valid_from,
           strftime(lead(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderdate), '%Y-%m-%d')
               AS valid_to
    FROM (SELECT o_custkey, min(o_orderdate) AS o_orderdate FROM orders GROUP BY o_custkey
          UNION
          SELECT o_custkey, max(o_orderdate) FROM orders GROUP BY o_custkey)
    """,
)
def scd2_timestamp_strategy(spark: SparkSession, sf: str) -> DataFrame:
    """Each customer's first order as a version, then the latest as the next one."""
    orders = table(spark, sf, "orders").groupBy("o_custkey")
    first = orders.agg(F.min("o_orderdate").alias("ordered_at"))
    last = orders.agg(F.max("o_orderdate").alias("ordered_at"))
    history = snapshot.empty_history(spark, first.schema)
    for rows in (first, last):
        history = stored_rows(
            snapshot.snapshot(
                rows, history, ["o_custkey"], F.lit(_RUN_TIME).cast("timestamp"),
                strategy="timestamp", updated_at="ordered_at",
            )
        )
    return history.select(
        "o_custkey",
        F.date_format("valid_from", "yyyy-MM-dd").alias("valid_from"),
        F.date_format("valid_to", "yyyy-MM-dd").alias("valid_to"),
    )


@registered(
    "scd2_version_intervals",
    """
    WITH log AS (SELECT user_id, event_type, ts FROM events),
    compared AS (
        SELECT *, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts) AS before FROM log
    ),
    kept AS (SELECT * FROM compared WHERE before IS DISTINCT FROM event_type)
    SELECT user_id, event_type, epoch_us(ts) AS valid_from_us,
           epoch_us(lead(ts) OVER (PARTITION BY user_id ORDER BY ts)) AS valid_to_us
    FROM kept
    """,
)
def scd2_version_intervals(spark: SparkSession, sf: str) -> DataFrame:
    log = table(spark, sf, "events").select(
        "user_id", "event_type", F.col("ts").cast("timestamp").alias("ts")
    )
    return snapshot.version_intervals(log, ["user_id"], "ts").select(
        "user_id",
        "event_type",
        F.unix_micros("valid_from").alias("valid_from_us"),
        F.unix_micros("valid_to").alias("valid_to_us"),
    )
