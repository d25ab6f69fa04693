"""Event ingest, pending selection, outcome log and archive."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.cleanse import delivery_outcome
from millrace.functions.hashing import event_hash
from millrace.operators import events as ev
from millrace.plans.queries.registry import iso_second, registered, table

# One incoming event per row of `events`, and those of one type a second time.
# Half of the month is stored already, its first days are archived.
_INCOMING_SQL = """
    raw AS (
        SELECT event_id, event_type, ts,
               CASE WHEN value > 40 THEN 'not json' ELSE '' END AS junk,
               '{"k":' || (props ->> '$.k') || ',"user":' || user_id || '}' AS canonical
        FROM events
    ),
    hashed AS (SELECT *, sha256(event_type || ':' || canonical) AS event_hash FROM raw),
    incoming AS (
        SELECT * FROM hashed UNION ALL SELECT * FROM hashed WHERE event_type = 'error'
    ),
    known AS (
        SELECT DISTINCT event_hash FROM hashed WHERE ts < TIMESTAMP '2024-01-15' AND junk = ''
    )
"""


def _documents(spark: SparkSession, sf: str) -> DataFrame:
    """Events with a JSON payload whose keys are not in sorted order."""
    k = F.get_json_object("props", "$.k")
    payload = F.concat(F.lit('{"user": '), "user_id", F.lit(', "k": '), k, F.lit("}"))
    return table(spark, sf, "events").select(
        "event_id", "event_type", "ts", "value", payload.alias("event_data")
    )


def _stored(rows: DataFrame) -> DataFrame:
    return rows.where("value <= 40").select(
        F.col("event_id").alias("id"),
        "event_type",
        F.col("ts").cast("timestamp").alias("event_created_at"),
        "event_data",
        event_hash(F.col("event_type"), F.col("event_data")).alias("event_hash"),
    )


def _ingest(spark: SparkSession, sf: str) -> ev.Ingest:
    rows = _documents(spark, sf)
    archived = _stored(rows.where("ts < '2024-01-05'"))
    store = _stored(rows.where("ts >= '2024-01-05' AND ts < '2024-01-15'"))
    sent = rows.withColumn(
        "event_data", F.when(F.col("value") > 40, "not json").otherwise(F.col("event_data"))
    )
    incoming = sent.unionByName(sent.where("event_type = 'error'"))
    return ev.ingest_events(incoming, store, archived, order_by=F.col("event_id"))


@registered(
    "event_ingest",
    f"""
    WITH {_INCOMING_SQL}
    SELECT DISTINCT event_type, canonical, event_hash FROM incoming
    WHERE junk = '' AND event_hash NOT IN (SELECT event_hash FROM known)
    """,
)
def event_ingest(spark: SparkSession, sf: str) -> DataFrame:
    created = _ingest(spark, sf).created
    return created.select(
        "event_type",
        F.to_json(F.parse_json("event_data")).alias("canonical"),
        "event_hash",
    )


@registered(
    "event_ingest_outcome",
    f"""
    WITH {_INCOMING_SQL},
    tally AS (
        SELECT count(*) AS total, count_if(junk <> '') AS failed,
               count(DISTINCT event_hash) FILTER (
                   junk = '' AND event_hash NOT IN (SELECT event_hash FROM known)) AS created
        FROM incoming
    )
    SELECT total AS total_events, created AS events_created,
           CAST(total - failed - created AS BIGINT) AS events_duplicate, CAST(failed AS BIGINT) AS events_failed,
           CASE WHEN failed = 0 THEN 'success' WHEN failed < total THEN 'partial' ELSE 'error' END
               AS status,
           CAST(ceil((total - failed) / 1000.0) AS BIGINT) AS batches
    FROM tally
    """,
)
def event_ingest_outcome(spark: SparkSession, sf: str) -> DataFrame:
    return _ingest(spark, sf).outcome


@registered(
    "event_duplicates",
    f"""
    WITH {_INCOMING_SQL},
    per_hash AS (
        SELECT event_hash, count(*) AS n, event_hash IN (SELECT event_hash FROM known) AS stored
        FROM incoming WHERE junk = '' GROUP BY event_hash
    )
    SELECT event_hash, n - CASE WHEN stored THEN 0 ELSE 1 END AS n_rows,
           CASE WHEN stored THEN 'already_stored' ELSE 'duplicate_in_batch' END AS reason
    FROM per_hash WHERE stored OR n > 1
    """,
)
def event_duplicates(spark: SparkSession, sf: str) -> DataFrame:
    return _ingest(spark, sf).duplicates


@registered(
    "event_hash_lookup",
    f"""
    WITH {_INCOMING_SQL}
    SELECT event_id, event_hash IN (SELECT event_hash FROM known) AS is_stored
    FROM hashed WHERE junk = ''
    """,
)
def event_hash_lookup(spark: SparkSession, sf: str) -> DataFrame:
    rows = _documents(spark, sf)
    archived = _stored(rows.where("ts < '2024-01-05'"))
    store = _stored(rows.where("ts >= '2024-01-05' AND ts < '2024-01-15'"))
    asked = _stored(rows).select(F.col("id").alias("event_id"), "event_hash")
    yes = ev.stored_hashes(asked, store, archived).withColumn("is_stored", F.lit(True))
    no = ev.unstored_hashes(asked, store, archived).withColumn("is_stored", F.lit(False))
    return yes.unionByName(no).select("event_id", "is_stored")


@registered(
    "known_event_hashes",
    f"WITH {_INCOMING_SQL} SELECT event_hash FROM known",
)
def known_event_hashes(spark: SparkSession, sf: str) -> DataFrame:
    rows = _documents(spark, sf)
    archived = _stored(rows.where("ts < '2024-01-05'"))
    store = _stored(rows.where("ts < '2024-01-15'"))
    return ev.known_hashes(store, archived)


# Delivery history by the event's value: small ones were never tried, middle ones
# failed once, larger ones failed and then succeeded, the largest lack an address.
_LOGS_SQL = """
    store AS (SELECT event_id AS id, event_type, ts, value FROM events),
    logs AS (
        SELECT id * 2 AS log_id, id AS event_id, ts + INTERVAL 1 HOUR AS processed_at,
               'FAILED' AS status, 'https://target.example/' || event_type AS url
        FROM store WHERE value >= 5
        UNION ALL
        SELECT id * 2 + 1, id, ts + INTERVAL 2 HOUR, 'SUCCESS',
               CASE WHEN value < 30 THEN 'https://target.example/' || event_type END
        FROM store WHERE value >= 12
    )
"""


def _event_store(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").select(
        F.col("event_id").alias("id"),
        "event_type",
        F.col("ts").cast("timestamp").alias("event_created_at"),
        F.col("props").alias("event_data"),
        event_hash(F.col("event_type"), F.col("props")).alias("event_hash"),
        "value",
    )


def _logs(store: DataFrame) -> DataFrame:
    url = F.concat(F.lit("https://target.example/"), "event_type")

    def log(rows: DataFrame, offset: int, hours: int, status: str, address) -> DataFrame:
        return rows.select(
            (F.col("id") * 2 + offset).alias("id"),
            F.col("id").alias("event_id"),
            (F.col("event_created_at") + F.expr(f"INTERVAL {hours} HOUR")).alias("processed_at"),
            F.lit(status).alias("processed_status"),
            F.lit("{}").alias("processed_result"),
            F.when(F.lit(status == "FAILED"), "HTTP 500: error").alias("processed_result_error"),
            address.alias("integration_url"),
            F.lit("POST").alias("integration_request_method"),
            F.col("event_data").alias("integration_payload"),
        )

    failed = log(store.where("value >= 5"), 0, 1, "FAILED", url)
    done = log(
        store.where("value >= 12"), 1, 2, "SUCCESS", F.when(F.col("value") < 30, url)
    )
    return failed.unionByName(done)


@registered(
    "event_pending",
    f"""
    WITH {_LOGS_SQL}
    SELECT id AS event_id, event_type,
           CASE WHEN value >= 5 THEN 'FAILED' END AS latest_status,
           CASE WHEN value >= 5 THEN id * 2 END AS latest_log_id
    FROM store WHERE value < 12
    """,
)
def event_pending(spark: SparkSession, sf: str) -> DataFrame:
    store = _event_store(spark, sf)
    pending = ev.pending_events(store.drop("value"), _logs(store))
    return pending.select(
        F.col("id").alias("event_id"),
        "event_type",
        F.col("latest_log.processed_status").alias("latest_status"),
        F.col("latest_log.id").alias("latest_log_id"),
    )


@registered(
    "event_pending_any_failed",
    f"""
    WITH {_LOGS_SQL}
    SELECT id AS event_id, CASE WHEN value >= 12 THEN 'SUCCESS' WHEN value >= 5 THEN 'FAILED' END
               AS latest_status
    FROM store s WHERE event_type = 'click'
      AND (NOT EXISTS (SELECT 1 FROM logs l WHERE l.event_id = s.id)
           OR EXISTS (SELECT 1 FROM logs l WHERE l.event_id = s.id AND l.status = 'FAILED'))
    """,
)
def event_pending_any_failed(spark: SparkSession, sf: str) -> DataFrame:
    store = _event_store(spark, sf)
    pending = ev.pending_events(store.drop("value"), _logs(store), "click", any_failed=True)
    return pending.select(
        F.col("id").alias("event_id"),
        F.col("latest_log.processed_status").alias("latest_status"),
    )


@registered(
    "event_archive",
    f"""
    WITH {_LOGS_SQL}
    SELECT s.id AS event_id, s.event_type,
           sha256(s.event_type || ':' || json(e.props)) AS event_hash,
           strftime(l.processed_at, '%Y-%m-%d %H:%M:%S') AS completed_at, l.url AS integration_url
    FROM store s JOIN logs l ON l.event_id = s.id JOIN events e ON e.event_id = s.id
    WHERE l.status = 'SUCCESS' AND l.url IS NOT NULL
    """,
)
def event_archive(spark: SparkSession, sf: str) -> DataFrame:
    store = _event_store(spark, sf)
    completed = ev.archive_completed(store.drop("value"), _logs(store)).completed
    return completed.select(
        "event_id",
        "event_type",
        "event_hash",
        iso_second("integration_completed_at").alias("completed_at"),
        "integration_url",
    )


@registered(
    "event_archive_remainders",
    f"""
    WITH {_LOGS_SQL},
    moved AS (SELECT event_id FROM logs WHERE status = 'SUCCESS' AND url IS NOT NULL)
    SELECT 'event_store' AS table_name, id AS row_id FROM store
    WHERE id NOT IN (SELECT event_id FROM moved)
    UNION ALL
    SELECT 'event_processed_logs', log_id FROM logs
    WHERE event_id NOT IN (SELECT event_id FROM moved)
    """,
)
def event_archive_remainders(spark: SparkSession, sf: str) -> DataFrame:
    store = _event_store(spark, sf)
    archive = ev.archive_completed(store.drop("value"), _logs(store))
    return archive.store.select(
        F.lit("event_store").alias("table_name"), F.col("id").alias("row_id")
    ).unionByName(
        archive.logs.select(
            F.lit("event_processed_logs").alias("table_name"), F.col("id").alias("row_id")
        )
    )


def _deliveries(spark: SparkSession, sf: str) -> DataFrame:
    """One delivery attempt per event: its code, reason, body and connection error."""
    kind = F.col("event_type")
    code = (
        F.when(kind == "click", 200)
        .when(kind == "view", 204)
        .when(kind == "purchase", 302)
        .when(kind == "error", 500)
    )
    return table(spark, sf, "events").select(
        "event_id",
        code.alias("code"),
        F.when(code == 302, "Found").when(code == 500, "Server Error").alias("reason"),
        F.when(code == 500, "plain text").when(code.isNotNull(), F.col("props")).alias("body"),
        F.when(code.isNull(), "Timeout connecting").alias("lost"),
    )


_DELIVERY_SQL = """
    sent AS (
        SELECT event_id, props,
               CASE event_type WHEN 'click' THEN 200 WHEN 'view' THEN 204
                               WHEN 'purchase' THEN 302 WHEN 'error' THEN 500 END AS code
        FROM events
    ),
    judged AS (
        SELECT event_id, code,
               CASE WHEN code BETWEEN 200 AND 299 THEN 'success' ELSE 'error' END AS status,
               CASE WHEN code = 500 THEN '{"text":"plain text"}' WHEN code IS NOT NULL THEN props END
                   AS data,
               CASE WHEN code IS NULL THEN 'Timeout connecting' WHEN code = 302 THEN 'HTTP 302: Found'
                    WHEN code = 500 THEN 'HTTP 500: Server Error' END AS error
        FROM sent
    )
"""


@registered(
    "event_delivery_class",
    f"WITH {_DELIVERY_SQL} SELECT event_id, status, code AS status_code, data, error FROM judged",
)
def event_delivery_class(spark: SparkSession, sf: str) -> DataFrame:
    sent = _deliveries(spark, sf)
    judged = delivery_outcome(F.col("code"), F.col("reason"), F.col("body"), F.col("lost"))
    return sent.select("event_id", judged.alias("o")).select("event_id", "o.*")


@registered(
    "event_log_outcomes",
    f"""
    WITH {_DELIVERY_SQL}
    SELECT j.event_id,
           CASE WHEN j.status = 'success' THEN 'SUCCESS' ELSE 'FAILED' END AS processed_status,
           CASE WHEN j.status = 'error' THEN j.error END AS processed_result_error,
           CASE WHEN e.value >= 5 THEN 'updated' ELSE 'inserted' END AS action,
           CASE WHEN e.value >= 5 THEN j.event_id * 2 END AS kept_log_id
    FROM judged j JOIN events e ON e.event_id = j.event_id
    WHERE j.event_id > 0
    """,
)
def event_log_outcomes(spark: SparkSession, sf: str) -> DataFrame:
    """Log a delivery of every event; those of larger value have a log already.

    Event 0 is refused: an event id must be positive.
    """
    store = _event_store(spark, sf)
    logs = _logs(store).where("processed_status = 'FAILED'")
    sent = _deliveries(spark, sf)
    judged = delivery_outcome(F.col("code"), F.col("reason"), F.col("body"), F.col("lost"))
    results = sent.select("event_id", judged.alias("o")).select(
        "event_id", "o.*", F.lit(None).cast("string").alias("response_headers")
    )
    new_from = 1 << 40
    logged = ev.log_outcomes(
        results, logs, run_time=F.lit("2024-03-01").cast("timestamp"), start_id=new_from
    )
    rows = logged.logs.where("processed_at = TIMESTAMP '2024-03-01 00:00:00'")
    return rows.join(logged.actions, "event_id").select(
        "event_id",
        "processed_status",
        "processed_result_error",
        "action",
        F.when(F.col("id") < new_from, F.col("id")).alias("kept_log_id"),
    )
