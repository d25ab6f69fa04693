"""Jobs that write tables or folders: sync, load, refresh, marts, stream ingest.

Each run uses a database of its own in the scratch folder and returns what the
job stored, so the whole path through the sinks is compared.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.sqltypes import column
from millrace.operators.differences import find_differences, save_with_tree
from millrace.operators.entities import fan_out
from millrace.operators.quality import check_unique, union_all
from millrace.operators.snapshot import current_versions
from millrace.plans.load import copy_table, load_file, refresh_tables
from millrace.plans.marts import Marts, Seed, SnapshotOf, build_marts, save_snapshot
from millrace.plans.queries.registry import as_double, iso_date, iso_second, registered, table
from millrace.plans.queries.related import change_records
from millrace.plans.reporting import Dimension, build_reporting, money, revenue_by
from millrace.plans.staging import stage_dimension
from millrace.plans.sync import sync, sync_all
from millrace.session import scratch_dir
from millrace.sources import files, writers
from millrace.sources.streams import Stream, read_stream
from millrace.streaming.incremental import ingest_stream, read_store

_FIRST = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)
_SECOND = dt.datetime(2024, 2, 1, tzinfo=dt.timezone.utc)


def scratch_database(spark: SparkSession) -> str:
    name = f"mr_{uuid.uuid4().hex[:12]}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{scratch_dir(spark, name)}'")
    return name


@registered(
    "sync_keyed",
    """
    SELECT o_orderkey AS order_id, o_custkey,
           CASE WHEN o_orderstatus = 'O' THEN o_totalprice + 10 ELSE o_totalprice END AS o_totalprice,
           o_orderstatus,
           CASE WHEN o_orderstatus = 'F' THEN '2024-01-01 00:00:00' WHEN o_orderstatus = 'O'
                THEN '2024-02-01 00:00:00' ELSE '2024-02-01 00:00:00' END AS updated_at
    FROM orders
    """,
)
def sync_keyed(spark: SparkSession, sf: str) -> DataFrame:
    """Two syncs: open and finished orders first, then all with changed open ones."""
    name = f"{scratch_database(spark)}.orders"
    orders = table(spark, sf, "orders").select(
        "o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus"
    )
    mapping = {"o_orderkey": "order_id"}
    first = orders.where("o_orderstatus <> 'P'")
    sync(first, name, keys=["order_id"], mapping=mapping, run_time=_FIRST)
    price = F.col("o_totalprice")
    second = orders.withColumn(
        "o_totalprice", F.when(F.col("o_orderstatus") == "O", price + 10).otherwise(price)
    )
    sync(second, name, keys=["order_id"], mapping=mapping, run_time=_SECOND)
    return spark.table(name).select(
        "order_id", "o_custkey", "o_totalprice", "o_orderstatus",
        iso_second("_sync_updated_at").alias("updated_at"),
    )


@registered(
    "sync_result_counts",
    """
    SELECT count(*) AS rows_read, count_if(o_orderstatus = 'P')::BIGINT AS inserted,
           count_if(o_orderstatus = 'O')::BIGINT AS updated,
           count_if(o_orderstatus = 'F')::BIGINT AS unchanged, 0::BIGINT AS skipped
    FROM orders
    """,
)
def sync_result_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Counts of a second sync into a table partitioned by a key column."""
    name = f"{scratch_database(spark)}.orders"
    orders = table(spark, sf, "orders").select(
        "o_orderkey", "o_orderpriority", "o_totalprice", "o_orderstatus"
    )
    keys = ["o_orderkey", "o_orderpriority"]
    first = orders.where("o_orderstatus <> 'P'")
    sync(first, name, keys=keys, partition_by=["o_orderpriority"], run_time=_FIRST)
    price = F.col("o_totalprice")
    second = orders.withColumn(
        "o_totalprice", F.when(F.col("o_orderstatus") == "O", price + 10).otherwise(price)
    )
    done = sync(second, name, keys=keys, strategy="delta", run_time=_SECOND)
    return spark.createDataFrame(
        [(done.rows_read, done.inserted, done.updated, done.unchanged, done.skipped)],
        "rows_read long, inserted long, updated long, unchanged long, skipped long",
    )


@registered(
    "sync_contract",
    """
    SELECT c_custkey, c_name, c_mktsegment FROM customer WHERE c_acctbal >= 0
    """,
)
def sync_contract(spark: SparkSession, sf: str) -> DataFrame:
    """Sync under a declared contract: rows without the required name are left out."""
    name = f"{scratch_database(spark)}.people"
    contract = T.StructType(
        [
            column("c_custkey", "BIGINT", nullable=False),
            column("c_name", "NVARCHAR(100)", nullable=False),
            column("c_mktsegment", "NVARCHAR(MAX)"),
        ]
    )
    people = table(spark, sf, "customer").select(
        "c_custkey",
        F.when(F.col("c_acctbal") >= 0, F.col("c_name")).alias("c_name"),
        "c_mktsegment",
    )
    sync(people, name, keys=["c_custkey"], contract=contract, on_bad="skip")
    return spark.table(name).select("c_custkey", "c_name", "c_mktsegment")


@registered(
    "entity_upsert",
    """
    WITH r AS (
        SELECT 'forge|' || event_type AS owner, 'runner|' || event_type AS runs, event_id, user_id, value,
               'forge|' || event_type || '|repo' || (props ->> '$.k') AS repository,
               'forge|' || event_type || '|repo' || (props ->> '$.k') || '|' || event_id AS artifact,
               'git|' || event_type || '|repo' || (props ->> '$.k') || '|' || md5(event_id::VARCHAR) AS commit,
               props ->> '$.k' AS k
        FROM events
    )
    SELECT DISTINCT entity, id FROM (
        SELECT 'organization' AS entity, owner AS id FROM r
        UNION ALL SELECT 'organization', runs FROM r
        UNION ALL SELECT 'repository', repository FROM r
        UNION ALL SELECT 'pipeline', runs || '|pipe' || user_id FROM r
        UNION ALL SELECT 'build', runs || '|pipe' || user_id || '|' || event_id FROM r WHERE value >= 5
        UNION ALL SELECT 'artifact', artifact FROM r
        UNION ALL SELECT 'artifact_commit_association', artifact || '|' || commit FROM r
        UNION ALL SELECT 'artifact_deployment', artifact || '|fleet|d' || user_id FROM r WHERE value >= 8
        UNION ALL SELECT 'deployment', 'fleet|d' || user_id FROM r WHERE value >= 8
        UNION ALL SELECT 'application', 'app' || k FROM r
    ) WHERE id IS NOT NULL
    """,
)
def entity_upsert(spark: SparkSession, sf: str) -> DataFrame:
    """Entities of the first half of the month, then of all of it, into a table each."""
    database = scratch_database(spark)
    records = change_records(spark, sf)
    for part in (records.where("run_start_time < '2024-01-15'"), records):
        found = fan_out(part)
        sync_all(found, database, ["id"])
    return union_all(
        spark.table(f"{database}.{name}").select(F.lit(name).alias("entity"), "id") for name in found
    )


@registered(
    "difference_tree",
    """
    WITH changed AS (
        SELECT o_orderkey, o_custkey, o_orderstatus,
               CASE WHEN o_totalprice > 300000 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice
        FROM orders WHERE o_totalprice > 2000
        UNION ALL SELECT -o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders WHERE o_totalprice < 3000
    ), before AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders),
    sides AS (
        SELECT o_orderkey, 1 AS l, 0 AS r FROM (SELECT * FROM before EXCEPT ALL SELECT * FROM changed)
        UNION ALL
        SELECT o_orderkey, 0, 1 FROM (SELECT * FROM changed EXCEPT ALL SELECT * FROM before)
    )
    SELECT o_orderkey, sum(l)::BIGINT AS left_rows, sum(r)::BIGINT AS right_rows,
           CASE WHEN sum(r) = 0 THEN 'missing' WHEN sum(l) = 0 THEN 'extra' ELSE 'changed' END AS finding
    FROM sides GROUP BY o_orderkey
    """,
)
def difference_tree(spark: SparkSession, sf: str) -> DataFrame:
    """Orders and a copy with changed, lost and added rows, compared by their trees."""
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    price = F.col("o_totalprice")
    changed = orders.where(price > 2000).withColumn("o_totalprice", F.when(price > 300000, price + 1).otherwise(price))
    added = orders.where(price < 3000).withColumn("o_orderkey", -F.col("o_orderkey"))
    left, right = scratch_dir(spark, "tree"), scratch_dir(spark, "tree")
    save_with_tree(orders, left, ["o_orderkey"], leaves=64)
    save_with_tree(changed.unionByName(added), right, ["o_orderkey"], leaves=64)
    return find_differences(spark, left, right)


@registered(
    "load_file_csv",
    """
    SELECT CAST(p_partkey AS BIGINT) AS item_id, p_name AS item_name,
           CASE WHEN p_type <> 'ECONOMY' THEN p_size END AS size,
           CAST(CAST(p_retailprice AS DECIMAL(18,2)) AS DOUBLE) AS price
    FROM part
    """,
)
def load_file_csv(spark: SparkSession, sf: str) -> DataFrame:
    """Parts written as delimited text, with error texts, and loaded by mapping."""
    folder = scratch_dir(spark, "csv")
    size = F.when(F.col("p_type") == "ECONOMY", "#N/A").otherwise(F.col("p_size").cast("string"))
    raw = table(spark, sf, "part").select(
        F.col("p_partkey").cast("string").alias("Item No"),
        F.col("p_name").alias("Name"),
        size.alias("Size"),
        F.col("p_retailprice").cast("decimal(18,2)").cast("string").alias("Price"),
        F.lit("x").alias("Remark"),
    )
    raw.write.option("header", True).csv(folder)
    target = T.StructType(
        [
            column("item_id", "BIGINT", nullable=False),
            column("item_name", "NVARCHAR(200)"),
            column("size", "INT"),
            column("price", "DECIMAL(18,2)"),
        ]
    )
    name = f"{scratch_database(spark)}.items"
    load_file(
        files.scan_delimited(spark, folder, files.text_columns(raw.columns)),
        name,
        mapping={"item no": "item_id", "Name": "item_name", "Size": "size", "Price": "price"},
        target=target,
    )
    return spark.table(name).drop("_sync_created_at").withColumn("price", as_double("price"))


@registered(
    "refresh_and_copy",
    """
    SELECT 'customer' AS table_name, 'success' AS status, count(*) AS n_rows, count(*) AS n_copied
    FROM customer
    UNION ALL SELECT 'supplier', 'success', count(*), count(*) FROM supplier
    """,
)
def refresh_and_copy(spark: SparkSession, sf: str) -> DataFrame:
    """Full refresh of two tables with a prefix, then a reload of copies of them."""
    source, target = scratch_database(spark), scratch_database(spark)
    wanted = ["customer", "supplier"]
    for name in wanted:
        writers.write_table(table(spark, sf, name), f"{source}.{name}", "fail")
    results = refresh_tables(spark, wanted, source, target, "erp-db")
    copies = []
    for name in wanted:
        refreshed = spark.table(f"{target}.erp_db_{name}")
        copy_table(spark, refreshed, f"{target}.copy_{name}")
        copies.append((name, copy_table(spark, refreshed, f"{target}.copy_{name}")))
    copied = spark.createDataFrame(copies, "table_name string, n_copied long")
    return results.join(copied, "table_name").select("table_name", "status", "n_rows", "n_copied")


@registered(
    "build_marts",
    """
    SELECT CASE WHEN l_returnflag = 'R' THEN 'credit' ELSE 'invoice' END AS record_type,
           CAST(year(l_shipdate) AS INTEGER) AS year, s_name AS seller_name,
           count(*) AS n_rows,
           CAST(sum(CAST(l_extendedprice AS DECIMAL(19,4))) AS DOUBLE) AS revenue
    FROM lineitem LEFT JOIN supplier ON s_suppkey = l_suppkey AND s_acctbal >= 0
    GROUP BY ALL
    """,
)
def build_marts_query(spark: SparkSession, sf: str) -> DataFrame:
    """All layers, run twice: suppliers as a history, of which some leave in between."""
    database = scratch_database(spark)
    seeds = scratch_dir(spark, "seeds")
    table(spark, sf, "region").select("r_regionkey", "r_name").write.option("header", True).csv(seeds)
    suppliers = table(spark, sf, "supplier")
    lines = table(spark, sf, "lineitem")

    def fact(read):
        rows = lines.select(
            F.col("l_suppkey").alias("seller_id"),
            F.col("l_shipdate").alias("posted_date"),
            money(F.col("l_extendedprice")).alias("line_total"),
            "l_returnflag",
        )
        invoices = rows.where("NOT (l_returnflag <=> 'R')").drop("l_returnflag")
        credits = rows.where("l_returnflag = 'R'").drop("l_returnflag")
        sellers = Dimension(read("stg_suppliers"), "s_suppkey", "seller_id", {"s_name": "seller_name"})
        return build_reporting(invoices, credits, [sellers]).withColumn("year", F.year("posted_date"))

    def marts(current: DataFrame) -> Marts:
        return Marts(
            snapshots={"snap_suppliers": SnapshotOf(current, ["s_suppkey"])},
            staging={
                "stg_suppliers": lambda read: stage_dimension(
                    read("snap_suppliers"), trimmed=["s_name"], required=["s_name"]
                )
            },
            seeds={"seed_regions": Seed(seeds, files.text_columns(["r_regionkey", "r_name"]))},
            core={"fct_lines": fact},
            reporting={
                "rpt_sellers": lambda read: revenue_by(
                    read("fct_lines"), ["record_type", "year", "seller_name"], profit=None
                )
            },
            checks={
                "sellers are unique": lambda read: check_unique(
                    read("stg_suppliers"), ["s_suppkey"]
                ),
                "every line has a known date": lambda read: read("fct_lines").where("year IS NULL"),
            },
        )

    build_marts(spark, marts(suppliers), database, _FIRST)
    built = build_marts(spark, marts(suppliers.where("s_acctbal >= 0")), database, _SECOND)
    if any(built.findings.values()):
        raise ValueError(f"data tests failed: {built.findings}")
    return spark.table(f"{database}.rpt_sellers").withColumn("revenue", as_double("revenue"))


@registered(
    "snapshot_table",
    """
    SELECT s_suppkey, s_acctbal < 0 AS is_gone, '2024-01-01' AS valid_from,
           CASE WHEN s_acctbal < 0 THEN '2024-02-01' END AS valid_to
    FROM supplier
    """,
)
def snapshot_table(spark: SparkSession, sf: str) -> DataFrame:
    name = f"{scratch_database(spark)}.history"
    suppliers = table(spark, sf, "supplier")
    save_snapshot(spark, name, SnapshotOf(suppliers, ["s_suppkey"]), _FIRST)
    save_snapshot(spark, name, SnapshotOf(suppliers.where("s_acctbal >= 0"), ["s_suppkey"]), _SECOND)
    stored = spark.table(name)
    open_now = current_versions(stored).select("s_suppkey").withColumn("_open", F.lit(True))
    return stored.join(open_now, "s_suppkey", "left").select(
        "s_suppkey",
        F.col("_open").isNull().alias("is_gone"),
        iso_date("valid_from").alias("valid_from"),
        iso_date("valid_to").alias("valid_to"),
    )


@registered(
    "stream_read_landed",
    """
    SELECT conv_id, turn, role, length(text) AS n_chars FROM conversations
    """,
)
def stream_read_landed(spark: SparkSession, sf: str) -> DataFrame:
    """Conversations landed as JSON documents and read through a stream declaration."""
    folder = scratch_dir(spark, "landed")
    record = F.struct("conv_id", "turn", "role", "text")
    table(spark, sf, "conversations").select(F.array(record).alias("data")).write.json(folder)
    stream = Stream(
        "conversations",
        folder,
        {
            "conv_id": {"type": "integer"},
            "turn": {"type": ["integer", "null"]},
            "role": {"type": "string"},
            "text": {"type": "string"},
        },
        ["data"],
    )
    return read_stream(spark, stream).select(
        "conv_id", "turn", "role", F.length("text").cast("long").alias("n_chars")
    )


@registered(
    "stream_event_ingest",
    """
    SELECT DISTINCT event_type, sha256(event_type || ':' || json(props)) AS event_hash FROM events
    """,
)
def stream_event_ingest(spark: SparkSession, sf: str) -> DataFrame:
    """The events table as a file stream, ingested until nothing is left."""
    store, checkpoint = scratch_dir(spark, "store"), scratch_dir(spark, "progress")
    schema = table(spark, sf, "events").schema
    rows = (
        spark.readStream.schema(schema)
        .option("pathGlobFilter", "events.parquet")
        .parquet(sf)
        .select("event_type", F.col("props").alias("event_data"))
    )
    ingest_stream(rows, store, checkpoint).awaitTermination()
    return read_store(spark, store).select("event_type", "event_hash")
