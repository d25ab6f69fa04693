"""Bucketed tables with versions, and the indexed event store."""

from __future__ import annotations

import datetime as dt
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.hashing import event_hash
from millrace.operators.merge import ACTION, merge_keyed, with_checksum
from millrace.plans.bucketed import merge_buckets, replace_rows
from millrace.plans.event_index import EventIndex, ingest_indexed_stream
from millrace.plans.queries.registry import iso_second, registered, table
from millrace.session import scratch_dir
from millrace.sources.versions import BucketStore, compact

_FIRST = dt.datetime(2024, 3, 1, tzinfo=dt.timezone.utc)
_SECOND = dt.datetime(2024, 4, 1, tzinfo=dt.timezone.utc)
_KEYS = ["o_orderkey", "o_orderdate"]


def _orders(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Orders before they were closed, and a later delivery: pending ones, and new prices of urgent ones."""
    orders = table(spark, sf, "orders").select(
        "o_orderkey", "o_orderdate", "o_orderpriority", "o_orderstatus", "o_totalprice"
    )
    price = F.col("o_totalprice")
    urgent = F.col("o_orderpriority") == "1-URGENT"
    late = orders.where(urgent | (F.col("o_orderstatus") == "P")).withColumn(
        "o_totalprice", F.when(urgent, price + 1).otherwise(price)
    )
    return orders.where("o_orderstatus <> 'P'"), late


def _merged(spark: SparkSession, sf: str) -> tuple[str, list]:
    root = scratch_dir(spark, "buckets")
    first, late = _orders(spark, sf)
    made = [
        merge_buckets(rows, root, _KEYS, bucket_on=["o_orderkey"], buckets=32, run_time=at)
        for rows, at in ((first, _FIRST), (late, _SECOND))
    ]
    return root, made


@registered(
    "bucket_merge",
    """
    SELECT o_orderkey, o_orderpriority,
           CASE WHEN o_orderpriority = '1-URGENT' THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice,
           CASE WHEN o_orderpriority = '1-URGENT' OR o_orderstatus = 'P' THEN '2024-04-01 00:00:00'
                ELSE '2024-03-01 00:00:00' END AS updated_at
    FROM orders
    """,
)
def bucket_merge(spark: SparkSession, sf: str) -> DataFrame:
    """The rows after a first load and a delta into buckets."""
    root, _ = _merged(spark, sf)
    return BucketStore(spark, root).read().select(
        "o_orderkey", "o_orderpriority", "o_totalprice", iso_second("_sync_updated_at").alias("updated_at")
    )


@registered(
    "bucket_merge_counts",
    """
    SELECT 1::BIGINT AS step, count(*) AS rows_read, count(*) AS inserted, 0::BIGINT AS updated, 0::BIGINT AS unchanged,
           true AS only_named_buckets
    FROM orders WHERE o_orderstatus <> 'P'
    UNION ALL
    SELECT 2, count(*), count_if(o_orderstatus = 'P')::BIGINT,
           count_if(o_orderpriority = '1-URGENT' AND o_orderstatus <> 'P')::BIGINT, 0, true
    FROM orders WHERE o_orderstatus = 'P' OR o_orderpriority = '1-URGENT'
    """,
)
def bucket_merge_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Counts of both steps, and whether each wrote no bucket but those its source named."""
    _, made = _merged(spark, sf)
    rows = [
        (i + 1, m.result.rows_read, m.result.inserted, m.result.updated, m.result.unchanged,
         set(m.rewritten) <= set(m.looked_at))
        for i, m in enumerate(made)
    ]
    return spark.createDataFrame(
        rows, "step long, rows_read long, inserted long, updated long, unchanged long, only_named_buckets boolean"
    )


@registered(
    "bucket_small_delta",
    """
    WITH biggest AS (SELECT max(o_custkey) AS c FROM orders)
    SELECT true AS few_buckets, count(*) AS updated,
           (SELECT count(*) FROM orders) AS n_rows, 0::BIGINT AS differences
    FROM orders, biggest WHERE o_custkey = c
    """,
)
def bucket_small_delta(spark: SparkSession, sf: str) -> DataFrame:
    """One customer's orders change: buckets by customer, so one of 64 is scanned and written.

    The result is compared with the full keyed merge of the same rows.
    """
    root = scratch_dir(spark, "buckets")
    orders = table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_totalprice")
    keys = ["o_custkey", "o_orderkey"]
    merge_buckets(orders, root, keys, bucket_on=["o_custkey"], run_time=_FIRST)
    store = BucketStore(spark, root)
    before = store.read()
    biggest = orders.agg(F.max("o_custkey").alias("o_custkey"))
    delta = orders.join(biggest, "o_custkey").withColumn("o_totalprice", F.col("o_totalprice") + 1)
    done = merge_buckets(delta, root, keys, run_time=_SECOND)
    whole = merge_keyed(before, with_checksum(delta), keys, F.lit(_SECOND).cast("timestamp")).drop(ACTION)
    after = store.read()
    differences = after.exceptAll(whole).unionByName(whole.exceptAll(after)).count()
    scanned = store.read(buckets=done.looked_at).inputFiles()
    few = len(done.looked_at) == len(done.rewritten) == 1 and all(f"_bucket={done.looked_at[0]}/" in f for f in scanned)
    return spark.createDataFrame(
        [(few, done.result.updated, after.count(), differences)],
        "few_buckets boolean, updated long, n_rows long, differences long",
    )


@registered(
    "bucket_versions",
    """
    SELECT 2::BIGINT AS version, count(*) AS n_rows, sum(CAST(o_totalprice AS DECIMAL(18,2)))::DOUBLE AS total
    FROM orders WHERE o_orderstatus <> 'P'
    UNION ALL
    SELECT 3, count(*), sum(CAST(o_totalprice AS DECIMAL(18,2)) + CASE WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END)::DOUBLE
    FROM orders
    UNION ALL
    SELECT 4, count(*), sum(CAST(o_totalprice AS DECIMAL(18,2)))::DOUBLE FROM orders WHERE o_orderstatus = 'F'
    UNION ALL
    SELECT 5, count(*), sum(CAST(o_totalprice AS DECIMAL(18,2)))::DOUBLE FROM orders WHERE o_orderstatus = 'F'
    """,
)
def bucket_versions(spark: SparkSession, sf: str) -> DataFrame:
    """Each version of a table stays readable: load, delta, replacement, deal into more buckets."""
    root, _ = _merged(spark, sf)
    store = BucketStore(spark, root)
    replace_rows(with_checksum(table(spark, sf, "orders").where("o_orderstatus = 'F'").select(
        "o_orderkey", "o_orderdate", "o_orderpriority", "o_orderstatus", "o_totalprice"
    )).withColumn("_sync_updated_at", F.lit(_SECOND)), root)
    compact(store, rows_per_bucket=1)
    found = None
    for number in (2, 3, 4, 5):
        part = store.read(store.at(number)).agg(
            F.lit(number).cast("long").alias("version"), F.count("*").alias("n_rows"),
            F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("total"),
        )
        found = part if found is None else found.unionByName(part)
    return found


@registered(
    "bucket_two_writers",
    """
    SELECT o_orderkey, CASE WHEN o_orderstatus = 'O' THEN o_totalprice + 2
                            WHEN o_orderstatus = 'F' THEN o_totalprice + 3 ELSE o_totalprice END AS o_totalprice
    FROM orders
    """,
)
def bucket_two_writers(spark: SparkSession, sf: str) -> DataFrame:
    """Two merges into the same buckets at once; the one that comes second merges again."""
    root = scratch_dir(spark, "buckets")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    merge_buckets(orders, root, ["o_orderkey"], buckets=4)
    parts = [
        orders.where(f"o_orderstatus = '{s}'").withColumn("o_totalprice", F.col("o_totalprice") + more)
        for s, more in (("O", 2), ("F", 3))
    ]
    with ThreadPoolExecutor(2) as pool:
        list(pool.map(lambda rows: merge_buckets(rows, root, ["o_orderkey"]), parts))
    return BucketStore(spark, root).read().select("o_orderkey", "o_totalprice")


# Events with a payload whose keys are not in order, in three deliveries that overlap.
_EVENTS_SQL = """
    hashed AS (
        SELECT ts, event_type, sha256(event_type || ':' || '{"k":' || (props ->> '$.k') || ',"user":' || user_id || '}')
               AS event_hash FROM events),
    batches AS (
        SELECT 0 AS batch, * FROM hashed WHERE ts < TIMESTAMP '2024-01-12'
        UNION ALL SELECT 1, * FROM hashed WHERE ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-21'
        UNION ALL SELECT 2, * FROM hashed WHERE ts >= TIMESTAMP '2024-01-20' OR event_type = 'error')
"""


def _deliveries(spark: SparkSession, sf: str) -> list[DataFrame]:
    k = F.get_json_object("props", "$.k")
    payload = F.concat(F.lit('{"user": '), "user_id", F.lit(', "k": '), k, F.lit("}"))
    rows = table(spark, sf, "events").select("event_type", payload.alias("event_data"), "ts")
    parts = (
        "ts < '2024-01-12'", "ts >= '2024-01-10' AND ts < '2024-01-21'", "ts >= '2024-01-20' OR event_type = 'error'",
    )
    return [rows.where(p).drop("ts") for p in parts]


@registered(
    "event_index_counts",
    f"""
    WITH {_EVENTS_SQL},
    first AS (SELECT event_hash, min(batch) AS batch FROM batches GROUP BY event_hash)
    SELECT batch::BIGINT AS batch, count(*) AS total_events,
           count(DISTINCT event_hash) FILTER (WHERE f.batch = b.batch) AS events_created,
           count(*) - count(DISTINCT event_hash) FILTER (WHERE f.batch = b.batch) AS events_duplicate
    FROM batches b JOIN first f USING (event_hash) GROUP BY b.batch
    """.replace("SELECT batch::BIGINT", "SELECT b.batch::BIGINT"),
)
def event_index_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Counts of three overlapping deliveries, each tried twice, compacted in between."""
    index = EventIndex(spark, scratch_dir(spark, "events"), buckets=8)
    rows = []
    for number, delivery in enumerate(_deliveries(spark, sf)):
        done = index.ingest(delivery, stream="deliveries", batch=number)
        again = index.ingest(delivery, stream="deliveries", batch=number)
        if again.outcome is not None or again.version != done.version:
            raise ValueError("a repeated delivery was stored")
        rows.append((number, *(done.outcome[c] for c in ("total_events", "events_created", "events_duplicate"))))
        index.compact(most_parts=1)
    return spark.createDataFrame(
        rows, "batch long, total_events long, events_created long, events_duplicate long"
    )


@registered(
    "event_index_rows",
    f"""
    WITH {_EVENTS_SQL} SELECT DISTINCT event_type, event_hash FROM batches
    """,
)
def event_index_rows(spark: SparkSession, sf: str) -> DataFrame:
    """The stored events after the deliveries and a doubling of the buckets."""
    index = EventIndex(spark, scratch_dir(spark, "events"), buckets=2)
    for delivery in _deliveries(spark, sf):
        index.ingest(delivery)
    index.compact(rows_per_bucket=100)
    return index.read().select("event_type", "event_hash")


@registered(
    "event_index_lookup",
    f"""
    WITH {_EVENTS_SQL},
    known AS (SELECT DISTINCT event_hash FROM batches WHERE batch < 2),
    asked AS (SELECT DISTINCT event_hash FROM batches WHERE batch = 2)
    SELECT event_hash, known.event_hash IS NOT NULL AS is_stored FROM asked LEFT JOIN known USING (event_hash)
    """.replace("SELECT event_hash, known", "SELECT asked.event_hash, known"),
)
def event_index_lookup(spark: SparkSession, sf: str) -> DataFrame:
    """Which hashes of the third delivery are stored: filters first, then the parts that pass."""
    index = EventIndex(spark, scratch_dir(spark, "events"), buckets=8)
    *earlier, last = _deliveries(spark, sf)
    for delivery in earlier:
        index.ingest(delivery)
    asked = last.select(event_hash(F.col("event_type"), F.col("event_data")).alias("event_hash")).distinct()
    version = index.store.latest()
    near = index.parts_that_may_hold(asked, version)
    stored = index.store.read(version, folders=near).select("event_hash").withColumn("_in", F.lit(True))
    return asked.join(stored, "event_hash", "left").select("event_hash", F.col("_in").isNotNull().alias("is_stored"))


@registered(
    "event_index_stream",
    """
    SELECT DISTINCT event_type, sha256(event_type || ':' || json(props)) AS event_hash FROM events
    """,
)
def event_index_stream(spark: SparkSession, sf: str) -> DataFrame:
    """The events table as a file stream into the indexed store, run twice."""
    root, checkpoint = scratch_dir(spark, "events"), scratch_dir(spark, "progress")
    rows = (
        spark.readStream.schema(table(spark, sf, "events").schema)
        .option("pathGlobFilter", "events.parquet")
        .parquet(sf)
        .select("event_type", F.col("props").alias("event_data"))
    )
    for _ in range(2):
        ingest_indexed_stream(rows, root, checkpoint, compact_every=1, most_parts=1).awaitTermination()
    return EventIndex(spark, root).read().select("event_type", "event_hash")
