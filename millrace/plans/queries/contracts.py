"""Fit of tables and rows to what a job expects: schemas, keys, partitions, micro-batches."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators.schema import compare_schema
from millrace.operators.snapshot import without_key
from millrace.plans.marts import SnapshotOf, save_snapshot
from millrace.plans.queries.registry import iso_second, registered, table
from millrace.plans.queries.stored import scratch_database
from millrace.plans.sync import sync
from millrace.session import scratch_dir
from millrace.streaming.incremental import sync_stream

_FIRST = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)
_SECOND = dt.datetime(2024, 2, 1, tzinfo=dt.timezone.utc)


@registered(
    "schema_compare",
    """
    SELECT table_name, finding, column_name, n_rows FROM (VALUES
        ('synced', 'extra column', 'c_phone'), ('synced', 'missing column', 'c_rating'),
        ('synced', 'type mismatch', 'c_acctbal'), ('plain', 'missing column', 'c_rating'),
        ('plain', 'type mismatch', 'c_acctbal'), ('plain', 'no checksum', '')) AS f(table_name, finding, column_name),
        (SELECT count(*) AS n_rows FROM customer)
    """,
)
def schema_compare(spark: SparkSession, sf: str) -> DataFrame:
    """Two stored tables against the columns a job expects: one made by a sync, one written plainly."""
    database = scratch_database(spark)
    people = table(spark, sf, "customer").select(
        "c_custkey", "c_name", "c_acctbal", F.lit("-").alias("c_phone")
    )
    sync(people, f"{database}.synced", keys=["c_custkey"])
    people.drop("c_phone").write.format("parquet").saveAsTable(f"{database}.plain")
    expected = T.StructType(
        [
            T.StructField("c_custkey", T.LongType()),
            T.StructField("c_name", T.StringType()),
            T.StructField("c_acctbal", T.DateType()),
            T.StructField("c_rating", T.IntegerType()),
        ]
    )
    rows = []
    for name in ("synced", "plain"):
        stored = spark.table(f"{database}.{name}")
        report, n_rows = compare_schema(stored.schema, expected), stored.count()
        rows += [(name, "extra column", c, n_rows) for c in report.extra_columns]
        rows += [(name, "missing column", c, n_rows) for c in report.missing_columns]
        rows += [(name, "type mismatch", c, n_rows) for c, _, _ in report.type_mismatches]
        rows += [] if report.has_checksum_column else [(name, "no checksum", "", n_rows)]
    return spark.createDataFrame(rows, "table_name string, finding string, column_name string, n_rows long")


@registered(
    "sync_other_partitions",
    """
    SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderstatus = 'O' THEN o_totalprice + 5 ELSE o_totalprice END AS o_totalprice,
           CASE WHEN o_orderstatus = 'F' THEN '2024-01-01 00:00:00' ELSE '2024-02-01 00:00:00' END AS updated_at
    FROM orders
    """,
)
def sync_other_partitions(spark: SparkSession, sf: str) -> DataFrame:
    """A table partitioned by a column that is no key: the successor is complete before it replaces it."""
    name = f"{scratch_database(spark)}.orders"
    orders = table(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    first = orders.where("o_orderstatus <> 'P'")
    first.limit(0).write.partitionBy("o_orderstatus").format("parquet").saveAsTable(name)
    sync(first, name, keys=["o_orderkey"], run_time=_FIRST)
    price = F.col("o_totalprice")
    second = orders.withColumn("o_totalprice", F.when(F.col("o_orderstatus") == "O", price + 5).otherwise(price))
    sync(second, name, keys=["o_orderkey"], strategy="delta", run_time=_SECOND)
    return spark.table(name).select(
        "o_orderkey", "o_orderstatus", "o_totalprice", iso_second("_sync_updated_at").alias("updated_at")
    )


@registered(
    "snapshot_without_key",
    """
    SELECT c_custkey, 1::BIGINT AS n_versions, 'kept' AS outcome FROM customer WHERE c_acctbal >= 0
    UNION ALL
    SELECT NULL, count(*), 'key is null' FROM customer WHERE c_acctbal < 0
    """,
)
def snapshot_without_key(spark: SparkSession, sf: str) -> DataFrame:
    """Three runs over customers of which some lost their key: these get no version and a reason."""
    name = f"{scratch_database(spark)}.history"
    people = table(spark, sf, "customer").select(
        F.when(F.col("c_acctbal") >= 0, F.col("c_custkey")).alias("key"), "c_name"
    )
    for at in (_FIRST, _SECOND, _SECOND):
        save_snapshot(spark, name, SnapshotOf(people, ["key"], on_bad="skip"), at)
    kept = spark.table(name).groupBy(F.col("key").alias("c_custkey")).agg(F.count("*").alias("n_versions"))
    refused = without_key(people, ["key"]).groupBy("_problem").agg(F.count("*").alias("n_versions"))
    return kept.withColumn("outcome", F.lit("kept")).unionByName(
        refused.select(F.lit(None).cast("long").alias("c_custkey"), "n_versions", F.col("_problem").alias("outcome"))
    )


@registered(
    "stream_sync",
    """
    SELECT o_orderkey, o_custkey, o_totalprice FROM orders
    """,
)
def stream_sync(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as a file stream synced by key in micro-batches, the stream run twice."""
    name, checkpoint = f"{scratch_database(spark)}.orders", scratch_dir(spark, "progress")
    rows = (
        spark.readStream.schema(table(spark, sf, "orders").schema)
        .option("pathGlobFilter", "orders.parquet")
        .parquet(sf)
        .select("o_orderkey", "o_custkey", "o_totalprice")
    )
    for _ in range(2):
        sync_stream(rows, name, checkpoint, keys=["o_orderkey"]).awaitTermination()
    return spark.table(name).select("o_orderkey", "o_custkey", "o_totalprice")
