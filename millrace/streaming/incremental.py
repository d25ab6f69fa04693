"""Event ingestion and checksum sync as micro-batches."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from millrace.operators.events import ingest_events
from millrace.plans.sync import sync

BATCH = "batch_id"
STORE_SCHEMA = (
    "event_type string, event_created_at timestamp, event_data string, event_hash string, "
    "batch_id long"
)


def read_store(spark: SparkSession, store: str) -> DataFrame:
    """Events stored by the stream so far; none before its first batch."""
    try:
        return spark.read.schema(STORE_SCHEMA).parquet(store)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], STORE_SCHEMA)


def ingest_stream(
    events: DataFrame,
    store: str,
    checkpoint: str,
    *,
    completed: Callable[[SparkSession], DataFrame] | None = None,
    order_by: Column | None = None,
    continuous: str | None = None,
) -> StreamingQuery:
    """Ingest a stream of events into the store, each event once.

    Every micro-batch is compared with what earlier batches stored and written
    to a partition of its own, which a repeated batch overwrites: the result is
    the same however often a batch is tried. Nothing is kept in streaming state,
    so an event counts as new however late it comes.

    By default it takes what is there and stops (for a run from outside, say
    hourly); ``continuous`` is a trigger interval for a standing query.
    """
    def take(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        earlier = read_store(spark, store).where(F.col(BATCH) < batch_id)
        done = completed(spark) if completed else earlier.limit(0)
        created = ingest_events(batch, earlier, done, order_by=order_by).created
        created.withColumn(BATCH, F.lit(batch_id).cast("long")).write.mode("overwrite").option(
            "partitionOverwriteMode", "dynamic"
        ).partitionBy(BATCH).parquet(store)

    return _start(events, take, checkpoint, continuous)


def sync_stream(
    rows: DataFrame,
    table: str,
    checkpoint: str,
    *,
    keys: Sequence[str] = (),
    order_by: Sequence[Column] = (),
    continuous: str | None = None,
) -> StreamingQuery:
    """Checksum sync of every micro-batch; a repeated batch changes nothing."""
    caller = rows.sparkSession

    def take(batch: DataFrame, batch_id: int) -> None:
        sync(
            batch, table, keys=keys, order_by=order_by, strategy="delta",
            run_time=dt.datetime.now(dt.timezone.utc),
        )
        # A micro-batch has a session of its own; the caller's remembers old files.
        caller.catalog.refreshTable(table)

    return _start(rows, take, checkpoint, continuous)


def _start(
    rows: DataFrame,
    take: Callable[[DataFrame, int], None],
    checkpoint: str,
    continuous: str | None,
) -> StreamingQuery:
    writer = rows.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint)
    if continuous:
        return writer.trigger(processingTime=continuous).start()
    return writer.trigger(availableNow=True).start()
