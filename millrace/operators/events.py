"""Event store: ingest with deduplication, pending selection, outcome log, archive."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.hashing import canonical_json, hash_of_canonical
from millrace.operators.merge import first_per_key
from millrace.operators.skew import one_row_per_key
from millrace.session import stored_rows

EVENT_SCHEMA = (
    "id long, event_type string, event_created_at timestamp, event_data string, event_hash string"
)
LOG_SCHEMA = (
    "id long, event_id long, processed_at timestamp, processed_status string, "
    "processed_result string, processed_result_error string, integration_url string, "
    "integration_request_method string, integration_payload string"
)
COMPLETED_SCHEMA = (
    "event_id long, event_type string, event_created_at timestamp, event_data string, "
    "event_hash string, integration_completed_at timestamp, integration_completed_status string, "
    "integration_url string, integration_request_method string, integration_payload string, "
    "integration_response string"
)
RESULT_KEYS = ("status", "status_code", "data", "error", "response_headers")

SUCCESS, FAILED = "SUCCESS", "FAILED"


def empty(spark: SparkSession, schema: str) -> DataFrame:
    return spark.createDataFrame([], schema)


def next_id(table: DataFrame) -> int:
    """One more than the highest id stored."""
    return (table.agg(F.max("id")).first()[0] or 0) + 1


def with_ids(rows: DataFrame, start: int) -> DataFrame:
    """Number rows from ``start`` on: unique, not gapless, and without a shuffle.

    The ids follow the partition layout, so write the result once and read ids
    back from the table.
    """
    return rows.withColumn("id", F.lit(start) + F.monotonically_increasing_id())


def batch_numbers(rows: DataFrame, batch_size: int, index: Column | None = None) -> DataFrame:
    """Number slices of ``batch_size`` rows in input order.

    With a gapless ``index`` the number counts over the whole input. Without one
    it counts within ``batch_partition``, the input partition: a count over all
    rows would need every row in one task.
    """
    if batch_size <= 0:
        raise ValueError("batch_size must be positive")
    if index is not None:
        return rows.withColumn("batch_no", F.floor(index / batch_size) + 1)
    place = F.monotonically_increasing_id()
    return (
        rows.withColumn("_place", place)
        .withColumn("batch_partition", F.shiftright("_place", 33))
        .withColumn(
            "batch_no",
            F.floor((F.col("_place").bitwiseAND(F.lit((1 << 33) - 1))) / batch_size) + 1,
        )
        .drop("_place")
    )


def checked_events(events: DataFrame) -> DataFrame:
    """Add ``_problem`` (null for a valid event) and ``event_hash``.

    Any JSON value is a payload, an object or not, and any text is a type, the empty one too.
    """
    for name in ("event_type", "event_data"):
        if name not in events.columns:
            events = events.withColumn(name, F.lit(None).cast("string"))
    problem = (
        F.when(F.col("event_type").isNull(), "missing event_type")
        .when(F.col("event_data").isNull(), "missing event_data")
        .when(F.col("_canonical").isNull(), "event_data is not JSON")
    )
    # The canonical text is a column of its own so that it is made once per row.
    return (
        events.withColumn("_canonical", canonical_json(F.col("event_data")))
        .withColumn("_problem", problem)
        .withColumn(
            "event_hash",
            F.when(
                F.col("_problem").isNull(),
                hash_of_canonical(F.col("event_type"), F.col("_canonical")),
            ),
        )
        .drop("_canonical")
    )


def known_hashes(store: DataFrame, completed: DataFrame) -> DataFrame:
    """Distinct hashes of pending and completed events."""
    return store.select("event_hash").union(completed.select("event_hash")).distinct()


def stored_hashes_of(batch: DataFrame, store: DataFrame, completed: DataFrame) -> DataFrame:
    """Distinct hashes of the history that the batch has too; only the batch may be shuffled."""
    history = store.select("event_hash").union(completed.select("event_hash"))
    return history.join(batch, "event_hash", "left_semi").distinct()


def stored_hashes(hashes: DataFrame, store: DataFrame, completed: DataFrame) -> DataFrame:
    """Those of the given hashes that are stored already."""
    known = store.select("event_hash").union(completed.select("event_hash"))
    return hashes.join(known, "event_hash", "left_semi")


def unstored_hashes(hashes: DataFrame, store: DataFrame, completed: DataFrame) -> DataFrame:
    known = store.select("event_hash").union(completed.select("event_hash"))
    return hashes.join(known, "event_hash", "left_anti")


@dataclass
class Ingest:
    created: DataFrame     # rows to append to the store, without ids
    duplicates: DataFrame  # event_hash, n_rows, reason
    invalid: DataFrame | None  # rejected input rows with _problem
    outcome: DataFrame     # one row of counts and the overall status


def ingest_events(
    events: DataFrame,
    store: DataFrame,
    completed: DataFrame,
    *,
    run_time: Column | None = None,
    order_by: Column | None = None,
    batch_size: int = 1000,
) -> Ingest:
    """Deduplicate incoming events against themselves, the store and the archive.

    Equal events are folded to one row and a count before the first shuffle, so
    an event sent a billion times costs one row per input partition. Of equal
    events the first in ``order_by`` is stored; every other one counts as a
    duplicate, row by row.
    """
    checked = checked_events(events)
    found = judge_events(fold_events(checked, order_by), store, completed, run_time=run_time, batch_size=batch_size)
    return replace(found, invalid=checked.where("_problem IS NOT NULL"))


def fold_events(checked: DataFrame, order_by: Column | None = None) -> DataFrame:
    """One stored row for each hash of checked events: its count and the event to store."""
    order = order_by if order_by is not None else F.col("event_data")
    # Invalid rows have no hash and form the group of the null hash, so one scan
    # gives the stored events as well as all the counts. Validity is an aggregate:
    # a filter on the hash itself would be pushed down and parse every event twice.
    per_hash = (
        checked.groupBy("event_hash")
        .agg(
            F.count("*").alias("n_rows"),
            F.bool_or(F.col("_problem").isNull()).alias("_valid"),
            F.min_by(F.struct("event_type", "event_data"), order).alias("first"),
        )
        .select("event_hash", "n_rows", "_valid", "first.*")
    )
    return stored_rows(per_hash)


def judge_events(
    per_hash: DataFrame,
    store: DataFrame,
    completed: DataFrame,
    *,
    run_time: Column | None = None,
    batch_size: int = 1000,
) -> Ingest:
    """Which events of a folded batch are new; refused rows are known by their number only."""
    # The folded batch is stored: it is read twice, and history meets its hashes first, so
    # that a small batch is broadcast and history is neither shuffled nor made distinct.
    met = stored_hashes_of(per_hash.select("event_hash"), store, completed)
    known = met.withColumn("_known", F.lit(True))
    judged = per_hash.join(known, "event_hash", "left")
    valid = F.col("_valid")
    fresh = valid & F.col("_known").isNull()
    created = judged.where(fresh).select(
        "event_type",
        (run_time if run_time is not None else F.current_timestamp()).alias("event_created_at"),
        "event_data",
        "event_hash",
    )
    surplus = F.when(fresh, F.col("n_rows") - 1).otherwise(F.col("n_rows"))
    duplicates = judged.where(valid & (surplus > 0)).select(
        "event_hash",
        surplus.alias("n_rows"),
        F.when(fresh, "duplicate_in_batch").otherwise("already_stored").alias("reason"),
    )

    def total(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, F.col("n_rows"))), F.lit(0).cast("long"))

    summed = judged.agg(
        total(F.lit(True)).alias("total_events"),
        F.count_if(fresh).alias("events_created"),
        (total(valid) - F.count_if(fresh)).alias("events_duplicate"),
        total(~valid).alias("events_failed"),
    )
    outcome = summed.withColumn("status", batch_status()).withColumn(
        "batches",
        F.ceil((F.col("total_events") - F.col("events_failed")) / F.lit(batch_size)).cast("long"),
    )
    return Ingest(created, duplicates, None, outcome)


def batch_status() -> Column:
    """success, partial or error from the three counts of an ingest."""
    stored = (F.col("events_created") + F.col("events_duplicate")) > 0
    return (
        F.when(stored & (F.col("events_failed") == 0), "success")
        .when(stored, "partial")
        .otherwise("error")
    )


def latest_logs(logs: DataFrame) -> DataFrame:
    """The latest log of each event."""
    return first_per_key(logs, ["event_id"], [F.desc("processed_at"), F.desc("id")])


def pending_events(
    store: DataFrame,
    logs: DataFrame,
    event_type: str | None = None,
    *,
    any_failed: bool = False,
    ordered: bool = True,
) -> DataFrame:
    """Events without a log, or whose latest log failed; the latest log is attached.

    ``any_failed`` selects an event as soon as one of its logs failed, even if a
    later one succeeded.
    """
    fields = ["id", "processed_at", "processed_status", "processed_result", "processed_result_error"]
    state = logs.groupBy("event_id").agg(
        F.max_by(F.struct(*fields), F.struct("processed_at", "id")).alias("latest_log"),
        F.max(F.col("processed_status") == FAILED).alias("_any_failed"),
    )
    wanted = store if event_type is None else store.where(F.col("event_type") == event_type)
    joined = wanted.join(state, wanted["id"] == state["event_id"], "left")
    failed = (
        F.col("_any_failed")
        if any_failed
        else F.col("latest_log.processed_status") == FAILED
    )
    out = joined.where(F.col("event_id").isNull() | failed).drop("event_id", "_any_failed")
    return out.orderBy("event_created_at", "id") if ordered else out


def check_results(results: DataFrame) -> DataFrame:
    """Add ``_problem`` for delivery results that must not be logged."""
    missing = [k for k in RESULT_KEYS if k not in results.columns]
    if missing:
        raise ValueError(f"delivery results lack columns: {missing}")
    code = F.col("status_code")
    whole = F.lit(True)
    if not isinstance(results.schema["status_code"].dataType, T.IntegralType):
        whole = code.try_cast("int").isNotNull() & (code.try_cast("double") == code.try_cast("int"))
    problem = (
        F.when(F.col("event_id").isNull() | (F.col("event_id") <= 0), "event_id is not positive")
        .when(F.col("status").isNull() | ~F.col("status").isin("success", "error"), "bad status")
        .when(code.isNotNull() & ~F.coalesce(whole, F.lit(False)), "status_code is not an integer")
    )
    return results.withColumn("_problem", problem)


def log_rows(results: DataFrame, run_time: Column) -> DataFrame:
    """Delivery results in log form, without ids."""
    payload = F.to_json(F.struct(*RESULT_KEYS), {"ignoreNullFields": "false"})
    optional = [
        F.col(c) if c in results.columns else F.lit(None).cast("string").alias(c)
        for c in ("integration_url", "integration_request_method", "integration_payload")
    ]
    ok = F.col("status") == "success"
    return results.select(
        F.col("event_id").cast("long").alias("event_id"),
        run_time.alias("processed_at"),
        F.when(ok, SUCCESS).otherwise(FAILED).alias("processed_status"),
        payload.alias("processed_result"),
        F.when(~ok, F.coalesce("error", F.lit("Unknown error"))).alias("processed_result_error"),
        *optional,
    )


@dataclass
class Logged:
    logs: DataFrame     # the whole log table after the upsert
    actions: DataFrame  # event_id, action
    invalid: DataFrame  # results that were refused, with _problem


def log_outcomes(
    results: DataFrame,
    logs: DataFrame,
    *,
    run_time: Column | None = None,
    order_by: Column | None = None,
    start_id: int | None = None,
) -> Logged:
    """Record delivery results: update the event's latest log, else insert one.

    Several results for one event in one call leave the last in ``order_by``.
    """
    checked = check_results(results)
    stamp = run_time if run_time is not None else F.current_timestamp()
    valid = checked.where("_problem IS NULL")
    content = F.to_json(F.struct(*RESULT_KEYS))
    order = [F.desc(order_by) if order_by is not None else content, content]
    fresh = log_rows(first_per_key(valid, ["event_id"], order), stamp)
    current = logs.groupBy("event_id").agg(
        F.max_by("id", F.struct("processed_at", "id")).alias("_log_id")
    )
    judged = fresh.join(current, "event_id", "left")
    values = [c for c in logs.columns if c not in ("id", "event_id")]
    known = F.col("_log_id").isNotNull()
    # New logs get a join key that matches none (ids are positive) and differs from
    # row to row, so that they do not all meet in the shuffle partition of null.
    changes = judged.select(
        F.coalesce(F.col("_log_id"), -F.col("event_id")).alias("_at"),
        known.alias("_known"),
        F.col("event_id").alias("_new_event_id"),
        *[F.col(c).alias(f"_new_{c}") for c in values],
    )
    start = next_id(logs) if start_id is None else start_id
    changed = F.col("_known").isNotNull()
    merged = logs.join(changes, logs["id"] == changes["_at"], "full_outer").select(
        F.coalesce(F.col("id"), F.lit(start) + F.monotonically_increasing_id()).alias("id"),
        F.coalesce("event_id", "_new_event_id").alias("event_id"),
        *[F.when(changed, F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c) for c in values],
    )
    actions = judged.select(
        "event_id", F.when(known, "updated").otherwise("inserted").alias("action")
    )
    return Logged(
        merged.select(*logs.columns), actions, checked.where("_problem IS NOT NULL")
    )


@dataclass
class Archive:
    completed: DataFrame  # rows to append to the archive
    store: DataFrame      # events that stay
    logs: DataFrame       # logs that stay


def archive_completed(store: DataFrame, logs: DataFrame) -> Archive:
    """Move delivered events to the archive.

    An event moves when its latest successful log names the integration it went
    to (address, method and payload); otherwise event and logs stay.
    """
    delivered = logs.where(
        (F.col("processed_status") == SUCCESS)
        & F.col("integration_url").isNotNull()
        & F.col("integration_request_method").isNotNull()
        & F.col("integration_payload").isNotNull()
    )
    final = latest_logs(delivered).drop("id")
    event = store.withColumnRenamed("id", "event_id")
    completed = final.join(event, "event_id").select(
        "event_id",
        "event_type",
        "event_created_at",
        "event_data",
        "event_hash",
        F.col("processed_at").alias("integration_completed_at"),
        F.col("processed_status").alias("integration_completed_status"),
        "integration_url",
        "integration_request_method",
        "integration_payload",
        F.col("processed_result").alias("integration_response"),
    )
    # Membership needs neither the latest log nor any payload, only the ids.
    candidates = delivered.select("event_id")
    moved = one_row_per_key(
        candidates.join(event.select("event_id"), "event_id", "left_semi"), ["event_id"]
    )
    return Archive(
        completed,
        event.join(candidates, "event_id", "left_anti")
        .withColumnRenamed("event_id", "id")
        .select(*store.columns),
        logs.join(moved, "event_id", "left_anti").select(*logs.columns),
    )
