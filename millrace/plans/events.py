"""Event jobs against stored tables: ingest, delivery log, archive.

Three tables of one database hold events that wait, their delivery logs, and delivered
events. Each job may stop anywhere and be run again: ingest finds what it stored by hash,
the log is replaced in one swap, and a move adds to the archive first, by event id, and
takes away from the other two tables after.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators import events as ops
from millrace.session import Scratch
from millrace.sources import writers


@dataclass(frozen=True)
class EventTables:
    database: str

    @property
    def store(self) -> str:
        return f"{self.database}.event_store"

    @property
    def logs(self) -> str:
        return f"{self.database}.event_processed_logs"

    @property
    def completed(self) -> str:
        return f"{self.database}.event_completed"


@dataclass
class Ingested:
    total: int
    created: int
    duplicate: int
    failed: int
    status: str
    created_ids: DataFrame  # id and event_hash of the stored events
    failures: DataFrame  # the refused rows, with their place in the input and the reason


def create_tables(spark: SparkSession, tables: EventTables) -> None:
    writers.ensure_database(spark, tables.database)
    for name, schema in (
        (tables.store, ops.EVENT_SCHEMA),
        (tables.logs, ops.LOG_SCHEMA),
        (tables.completed, ops.COMPLETED_SCHEMA),
    ):
        writers.recover(spark, name)
        if not spark.catalog.tableExists(name):
            ops.empty(spark, schema).write.format("parquet").saveAsTable(name)


def ingest(
    events: DataFrame, tables: EventTables, *, run_time: Column | None = None, order_by: Column | None = None
) -> Ingested:
    """Store new events under ids of their own; repeated and stored ones are counted.

    An ``index`` column of the input is kept in ``failures``; without one they carry
    ``batch_partition`` and their place in it. The result's frames read stored rows.
    """
    spark = events.sparkSession
    create_tables(spark, tables)
    store = spark.table(tables.store)
    start = ops.next_id(store.select("id").union(spark.table(tables.completed).selectExpr("event_id AS id")))
    with Scratch(spark) as scratch:
        found = ops.ingest_events(
            events, store, spark.table(tables.completed), run_time=run_time, order_by=order_by
        )
        # The archive grows by moves only, so counting before storing is enough.
        counts = found.outcome.first()
        created = scratch.keep(ops.with_ids(found.created, start).select(*store.columns))
        writers.append_rows(created, tables.store)
    stored = spark.table(tables.store).where(F.col("id") >= start).select("id", "event_hash")
    return Ingested(
        counts["total_events"],
        counts["events_created"],
        counts["events_duplicate"],
        counts["events_failed"],
        counts["status"],
        stored,
        found.invalid,
    )


def log_results(results: DataFrame, tables: EventTables, **options) -> DataFrame:
    """Record deliveries in the log table; returns event_id and action, stored."""
    spark = results.sparkSession
    create_tables(spark, tables)
    logged = ops.log_outcomes(results, spark.table(tables.logs), **options)
    actions = writers.stored_result(logged.actions)
    staged = writers.stage(logged.logs, tables.logs)
    writers.swap_in(spark, tables.logs, staged)
    return actions


def archive(spark: SparkSession, tables: EventTables) -> int:
    """Move delivered events to the archive; returns how many were added to it.

    After a stop the next run adds no event twice and takes away what is archived.
    """
    create_tables(spark, tables)
    moved = ops.archive_completed(spark.table(tables.store), spark.table(tables.logs))
    before = spark.table(tables.completed).count()
    known = spark.table(tables.completed).select("event_id")
    with Scratch(spark) as scratch:
        added = scratch.keep(moved.completed.join(known, "event_id", "left_anti"))
        writers.append_rows(added, tables.completed)
    done = spark.table(tables.completed).select("event_id")
    for name, key in ((tables.store, "id"), (tables.logs, "event_id")):
        rows = spark.table(name)
        # The store goes first: a log without its event is taken away by the next run.
        left = rows.join(done, rows[key] == done["event_id"], "left_anti").select(*rows.columns)
        writers.swap_in(spark, name, writers.stage(left, name))
    return spark.table(tables.completed).count() - before
