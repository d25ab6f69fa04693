"""Cases at the edges of the jobs: emptied sources, late events, refused rows, new columns."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.sqltypes import column
from millrace.operators import pii, relations
from millrace.plans import events as event_jobs
from millrace.plans.load import load_file
from millrace.plans.marts import Marts, Seed, SnapshotOf, build_marts, save_snapshot
from millrace.plans.queries.registry import iso_date, registered, table
from millrace.plans.queries.stored import scratch_database
from millrace.plans.sync import SyncResult, sync
from millrace.session import scratch_dir, stored_rows
from millrace.sources import files, writers
from millrace.streaming.incremental import ingest_stream, read_store

_FIRST = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)
_SECOND = dt.datetime(2024, 2, 1, tzinfo=dt.timezone.utc)


def _counted(spark: SparkSession, done: SyncResult) -> DataFrame:
    row = (done.rows_read, done.inserted, done.updated, done.unchanged, done.skipped)
    return spark.createDataFrame(
        [row], "rows_read long, inserted long, updated long, unchanged long, skipped long"
    )


@registered(
    "snapshot_emptied",
    """
    SELECT s_suppkey, '2024-01-01' AS valid_from, '2024-02-01' AS valid_to FROM supplier
    """,
)
def snapshot_emptied(spark: SparkSession, sf: str) -> DataFrame:
    """A source that loses all its rows closes all its versions."""
    name = f"{scratch_database(spark)}.history"
    suppliers = table(spark, sf, "supplier")
    save_snapshot(spark, name, SnapshotOf(suppliers, ["s_suppkey"]), _FIRST)
    save_snapshot(spark, name, SnapshotOf(suppliers.limit(0), ["s_suppkey"]), _SECOND)
    return spark.table(name).select(
        "s_suppkey", iso_date("valid_from").alias("valid_from"), iso_date("valid_to").alias("valid_to")
    )


@registered(
    "stream_late_event",
    """
    SELECT DISTINCT event_type, sha256(event_type || ':' || json(props)) AS event_hash FROM events
    """,
)
def stream_late_event(spark: SparkSession, sf: str) -> DataFrame:
    """Events that arrive newest first: the older ones are new all the same."""
    landed, store, progress = (scratch_dir(spark, n) for n in ("landed", "store", "progress"))
    events = table(spark, sf, "events").select("event_type", F.col("props").alias("event_data"), "ts")
    late = F.dayofmonth("ts") < 15
    schema = events.schema
    for part in (events.where(~late), events.where(late | late.isNull())):
        part.write.mode("append").parquet(landed)
        rows = spark.readStream.schema(schema).parquet(landed)
        ingest_stream(rows, store, progress).awaitTermination()
    return read_store(spark, store).select("event_type", "event_hash")


@registered(
    "sync_rejects",
    """
    SELECT count(*) AS rows_read,
           count_if(o_orderkey IS NOT NULL AND o_orderstatus <> 'P' AND length(o_orderpriority) <= 8)::BIGINT
               AS inserted,
           0::BIGINT AS updated, 0::BIGINT AS unchanged,
           count_if(NOT (o_orderstatus <> 'P' AND length(o_orderpriority) <= 8))::BIGINT AS skipped
    FROM orders
    """,
)
def sync_rejects(spark: SparkSession, sf: str) -> DataFrame:
    """Numbers beyond their type, texts beyond their length and missing keys are refused."""
    contract = T.StructType(
        [column("id", "INT", nullable=False), column("priority", "NVARCHAR(8)"), column("price", "FLOAT")]
    )
    pending = F.col("o_orderstatus") == "P"
    rows = table(spark, sf, "orders").select(
        F.when(pending & (F.col("o_orderkey") % 2 == 0), F.lit(3_000_000_000))
        .when(pending, F.lit(None).cast("long"))
        .otherwise(F.col("o_orderkey").cast("long"))
        .alias("id"),
        F.col("o_orderpriority").alias("priority"),
        F.col("o_totalprice").alias("price"),
    )
    name = f"{scratch_database(spark)}.orders"
    return _counted(spark, sync(rows, name, keys=["id"], contract=contract, on_bad="skip"))


@registered(
    "sync_partitioned_by_other_column",
    """
    SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN 'moved' ELSE o_orderpriority END AS o_orderpriority,
           'o_orderpriority' AS partition_columns
    FROM orders
    """,
)
def sync_partitioned_by_other_column(spark: SparkSession, sf: str) -> DataFrame:
    """A table partitioned by a column that is no key keeps its partitioning; rows move."""
    name = f"{scratch_database(spark)}.orders"
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority", "o_orderstatus")
    spark.sql(
        f"CREATE TABLE {name} (o_orderkey BIGINT, o_orderpriority STRING) "
        "USING parquet PARTITIONED BY (o_orderpriority)"
    )
    sync(orders.drop("o_orderstatus"), name, keys=["o_orderkey"])
    moved = F.when(F.col("o_orderstatus") == "P", F.lit("moved")).otherwise(F.col("o_orderpriority"))
    sync(orders.select("o_orderkey", moved.alias("o_orderpriority")), name, keys=["o_orderkey"])
    parts = ",".join(c.name for c in spark.catalog.listColumns(name) if c.isPartition)
    return spark.table(name).select(
        "o_orderkey", "o_orderpriority", F.lit(parts).alias("partition_columns")
    )


@registered(
    "sync_repeated",
    """
    SELECT count(*) AS rows_read, 0::BIGINT AS inserted, 0::BIGINT AS updated,
           count_if(c_custkey % 10 <> 0)::BIGINT AS unchanged,
           count_if(c_custkey % 10 = 0)::BIGINT AS skipped
    FROM customer
    """,
)
def sync_repeated(spark: SparkSession, sf: str) -> DataFrame:
    """The same rows, some without a key, synced twice with one run time: nothing changes."""
    name = f"{scratch_database(spark)}.customers"
    rows = table(spark, sf, "customer").select(
        F.when(F.col("c_custkey") % 10 != 0, F.col("c_custkey")).alias("id"), "c_name", "c_acctbal"
    )
    for _ in range(2):
        done = sync(rows, name, keys=["id"], on_bad="skip", run_time=_FIRST)
    return _counted(spark, done)


@registered(
    "load_new_column",
    """
    SELECT CAST(p_partkey AS BIGINT) AS id, p_name AS name, CAST(p_size AS INTEGER) AS size FROM part
    """,
)
def load_new_column(spark: SparkSession, sf: str) -> DataFrame:
    """``replace`` with one more column gives the table that column."""
    name = f"{scratch_database(spark)}.parts"
    parts = table(spark, sf, "part").select(
        F.col("p_partkey").cast("long").alias("id"), F.col("p_name").alias("name"), F.col("p_size").alias("size")
    )
    load_file(parts.drop("size"), name)
    target = T.StructType([column("id", "BIGINT"), column("name", "NVARCHAR(200)"), column("size", "INT")])
    load_file(parts, name, target=target, if_exists="replace")
    return spark.table(name).select("id", "name", "size")


@registered(
    "nested_pages",
    """
    SELECT o_custkey, (n - 1) // 3 AS page, list(o_orderkey ORDER BY n)::VARCHAR AS keys
    FROM (SELECT o_custkey, o_orderkey, row_number() OVER (
              PARTITION BY o_custkey ORDER BY o_orderpriority DESC, o_orderkey DESC) AS n
          FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer))
    GROUP BY ALL
    """,
)
def nested_pages(spark: SparkSession, sf: str) -> DataFrame:
    """Orders in pages of three, by a text and a number, both descending."""
    nested = relations.nest_children(
        table(spark, sf, "customer").select("c_custkey"),
        table(spark, sf, "orders"),
        "c_custkey",
        "o_custkey",
        "orders",
        order_by=[F.desc("o_orderpriority"), F.desc("o_orderkey")],
        columns=["o_orderkey"],
        page_size=3,
    )
    keys = F.transform("orders", lambda o: o["o_orderkey"].cast("string"))
    return nested.where(F.size("orders") > 0).select(
        F.col("c_custkey").alias("o_custkey"),
        F.col("orders_page").cast("long").alias("page"),
        F.concat(F.lit("["), F.array_join(keys, ", "), F.lit("]")).alias("keys"),
    )


@registered(
    "pii_realistic_cut",
    """
    SELECT count(DISTINCT lower(c_name)) AS people, count(DISTINCT lower(c_name)) AS texts,
           0::BIGINT AS too_long, field
    FROM customer CROSS JOIN (VALUES ('city'), ('address')) AS f(field) GROUP BY field
    """,
)
def pii_realistic_cut(spark: SparkSession, sf: str) -> DataFrame:
    """Replacements of few characters, added to stored ones, are distinct all the same."""
    people = table(spark, sf, "customer").select("c_custkey", "c_name")
    out = []
    for kind, length in (("city", 8), ("address", 30)):
        config = {"c_name": {"field_type": kind, "max_length": length}}
        first = people.where("c_custkey % 2 = 0")
        stored = stored_rows(pii.anonymize(first, config, "crm", None, pii.empty_mapping(spark))[1])
        more = stored_rows(pii.anonymize(people, config, "crm", None, stored)[1])
        out.append(
            stored.unionByName(more).agg(
                F.count_distinct("hash_value").alias("people"),
                F.count_distinct("replacement_value").alias("texts"),
                F.count_if(F.length("replacement_value") > length).alias("too_long"),
                F.lit(kind).alias("field"),
            )
        )
    return out[0].unionByName(out[1])


@registered(
    "insert_missing_keys",
    """
    SELECT c_custkey AS id, CASE WHEN c_custkey % 3 = 0 THEN 'old' ELSE c_mktsegment END AS v FROM customer
    """,
)
def insert_missing_keys(spark: SparkSession, sf: str) -> DataFrame:
    """Insert-or-ignore: stored keys keep their rows."""
    name = f"{scratch_database(spark)}.ids"
    rows = table(spark, sf, "customer").select(F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("v"))
    writers.write_table(rows.where("id % 3 = 0").withColumn("v", F.lit("old")), name, "fail")
    writers.append_missing(rows.unionByName(rows.limit(5)), name, ["id"])
    return spark.table(name)


@registered(
    "event_jobs",
    """
    WITH found AS (SELECT DISTINCT event_type, sha256(event_type || ':' || json(props)) AS h FROM events)
    SELECT CASE WHEN substr(h, 1, 1) < '8' THEN 'completed' ELSE 'waiting' END AS place,
           event_type, h AS event_hash,
           CASE WHEN substr(h, 1, 1) < '8' THEN 'SUCCESS' WHEN substr(h, 1, 1) < 'c' THEN 'FAILED' END AS outcome
    FROM found
    """,
)
def event_jobs_query(spark: SparkSession, sf: str) -> DataFrame:
    """Ingest twice, log deliveries twice, move twice: the three stored tables."""
    tables = event_jobs.EventTables(scratch_database(spark))
    events = table(spark, sf, "events").select("event_type", F.col("props").alias("event_data"))
    for part in (events.where(F.length("event_data") % 2 == 0), events):
        event_jobs.ingest(part, tables)
    first = F.substring("event_hash", 1, 1)
    delivered = stored_rows(spark.table(tables.store)).where(first < "c")
    ok = first < "8"
    results = delivered.select(
        F.col("id").alias("event_id"),
        F.when(ok, "success").otherwise("error").alias("status"),
        F.lit(200).alias("status_code"),
        F.lit("{}").alias("data"),
        F.when(~ok, "refused").alias("error"),
        F.lit(None).cast("string").alias("response_headers"),
        F.lit("https://example.org/in").alias("integration_url"),
        F.lit("POST").alias("integration_request_method"),
        F.col("event_data").alias("integration_payload"),
    )
    for _ in range(2):
        event_jobs.log_results(results, tables)
    for _ in range(2):
        event_jobs.archive(spark, tables)
    logs = spark.table(tables.logs).select("event_id", "processed_status")
    waiting = spark.table(tables.store).join(logs, F.col("id") == F.col("event_id"), "left")
    return waiting.select(
        F.lit("waiting").alias("place"), "event_type", "event_hash", F.col("processed_status").alias("outcome")
    ).unionByName(
        spark.table(tables.completed).select(
            F.lit("completed").alias("place"),
            "event_type",
            "event_hash",
            F.col("integration_completed_status").alias("outcome"),
        )
    )


@registered(
    "sync_audit",
    """
    SELECT * FROM (VALUES ('running', 0::BIGINT), ('error', 0::BIGINT), ('running', 0::BIGINT)) v(status, records)
    UNION ALL SELECT 'success', count(*) FROM customer
    """,
)
def sync_audit(spark: SparkSession, sf: str) -> DataFrame:
    """Audit rows of a sync that fails and of one that succeeds."""
    database = scratch_database(spark)
    customers = table(spark, sf, "customer").select("c_custkey", "c_name")
    audit = f"{database}.audit"
    try:
        sync(customers, f"{database}.c", keys=["unknown"], audit=audit)
    except ValueError:
        pass
    sync(customers, f"{database}.c", keys=["c_custkey"], audit=audit)
    return spark.table(audit).select(
        F.col("sync_status").alias("status"), F.col("records_synced").alias("records")
    )


@registered(
    "marts_stored_views",
    """
    SELECT r_name AS region, n_name AS nation, count(s_suppkey) AS suppliers
    FROM region JOIN nation ON n_regionkey = r_regionkey
    LEFT JOIN supplier ON s_nationkey = n_nationkey GROUP BY ALL
    """,
)
def marts_stored_views(spark: SparkSession, sf: str) -> DataFrame:
    """A seed joined in a view that is stored in the database, and a report on it."""
    database, seeds = scratch_database(spark), scratch_dir(spark, "seeds")
    table(spark, sf, "region").select("r_regionkey", "r_name").write.option("header", True).csv(seeds)
    writers.write_table(table(spark, sf, "nation"), f"{database}.nation", "fail")
    suppliers = table(spark, sf, "supplier")

    def by_nation(read):
        counts = suppliers.groupBy("s_nationkey").agg(F.count("*").alias("n"))
        nations = read("stg_nations")
        return nations.join(counts, nations["n_nationkey"] == counts["s_nationkey"], "left").select(
            "region", "nation", F.coalesce("n", F.lit(0)).alias("suppliers")
        )

    marts = Marts(
        seeds={"seed_regions": Seed(seeds, files.text_columns(["r_regionkey", "r_name"]))},
        staging={
            "stg_nations": "SELECT n_nationkey, n_name AS nation, r_name AS region "
            "FROM {database}.nation JOIN {database}.seed_regions ON n_regionkey = CAST(r_regionkey AS INT)"
        },
        reporting={"rpt_nations": by_nation},
    )
    build_marts(spark, marts, database, _FIRST)
    return spark.table(f"{database}.rpt_nations")
