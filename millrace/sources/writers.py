"""Table sinks and the staged swap that replaces a table with its successor."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.hashing import SYNC_CHECKSUM, SYNC_CREATED_AT, SYNC_UPDATED_AT
from millrace.operators import merge
from millrace.operators.mapping import clean_column_names, quoted
from millrace.session import stored_rows

_MODES = {"append": "append", "replace": "overwrite", "fail": "errorifexists"}

SYNC_TYPES = {
    SYNC_CHECKSUM: T.StringType(),
    SYNC_UPDATED_AT: T.TimestampType(),
    SYNC_CREATED_AT: T.TimestampType(),
}


def _database_of(spark: SparkSession, table: str) -> str:
    return table.rsplit(".", 1)[0] if "." in table else spark.catalog.currentDatabase()


def require_database(spark: SparkSession, table: str) -> None:
    database = _database_of(spark, table)
    if not spark.catalog.databaseExists(database):
        raise ValueError(f"database {database!r} does not exist")


def ensure_database(spark: SparkSession, name: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {quoted(name)}")


def write_table(df: DataFrame, table: str, if_exists: str = "append") -> None:
    """One write; ``fail`` refuses before anything is written."""
    if if_exists not in _MODES:
        raise ValueError(f"if_exists must be one of {sorted(_MODES)}")
    require_database(df.sparkSession, table)
    if if_exists == "append" and df.sparkSession.catalog.tableExists(table):
        append_rows(df, table)
        return
    df.write.mode(_MODES[if_exists]).format("parquet").saveAsTable(table)


def append_rows(df: DataFrame, table: str) -> None:
    """Add rows to a table, partitioned or not, by column name; unknown columns are an error."""
    columns = df.sparkSession.table(table).columns
    unknown = [c for c in df.columns if c not in columns]
    if unknown:
        raise ValueError(f"columns not in {table}: {unknown}")
    with _setting(df.sparkSession, "spark.sql.sources.partitionOverwriteMode", "dynamic"):
        df.select(*[quoted(c) for c in columns]).write.insertInto(table)


def refresh_table(df: DataFrame, table: str) -> None:
    """Full refresh: new schema, new rows, cleaned column names."""
    require_database(df.sparkSession, table)
    clean_column_names(df).write.mode("overwrite").format("parquet").saveAsTable(table)


def reload_table(df: DataFrame, table: str) -> None:
    """Replace the rows and keep the table itself, so that views on it stay valid."""
    columns = df.sparkSession.table(table).columns
    df.select(*[quoted(c) for c in columns]).write.insertInto(table, overwrite=True)


def append_missing(source: DataFrame, table: str, keys: Sequence[str]) -> None:
    """Insert-or-ignore on a unique key."""
    target = source.sparkSession.table(table)
    write_table(merge.insert_or_ignore(target, source, keys), table, "append")


def create_table(
    spark: SparkSession,
    table: str,
    schema: T.StructType,
    *,
    partition_by: Sequence[str] = (),
    sync_columns: Sequence[str] = (SYNC_CHECKSUM, SYNC_UPDATED_AT),
) -> None:
    """An empty table with these columns and the sync columns behind them."""
    fields = [f for f in schema if f.name not in SYNC_TYPES]
    fields += [T.StructField(n, SYNC_TYPES[n], True) for n in sync_columns]
    writer = spark.createDataFrame([], T.StructType(fields)).write.format("parquet")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.saveAsTable(table)


def add_sync_columns(spark: SparkSession, table: str) -> list[str]:
    """Add checksum and time columns where the table lacks them."""
    have = spark.table(table).columns
    lacking = [n for n in (SYNC_CHECKSUM, SYNC_UPDATED_AT) if n not in have]
    if lacking:
        listed = ", ".join(f"{quoted(n)} {SYNC_TYPES[n].simpleString()}" for n in lacking)
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({listed})")
    return lacking


def staged_name(table: str) -> str:
    return f"{table}__staged_{uuid.uuid4().hex[:12]}"


def stage(df: DataFrame, table: str) -> str:
    """Write next to ``table`` under a name of its own; returns that name."""
    spark = df.sparkSession
    staged = staged_name(table)
    if spark.catalog.tableExists(table) and df.columns == spark.table(table).columns:
        # The successor keeps the table's format, partitioning and properties.
        spark.sql(f"CREATE TABLE {staged} LIKE {table}{_properties_of(spark, table)}")
        append_rows(df, staged)
    else:
        df.write.mode("errorifexists").format("parquet").saveAsTable(staged)
    return staged


def _properties_of(spark: SparkSession, table: str) -> str:
    """A TBLPROPERTIES clause with the user's properties of the table."""
    rows = spark.sql(f"SHOW TBLPROPERTIES {table}").collect()
    own = {r["key"]: r["value"] for r in rows if "." not in r["key"] and r["key"] != "transient_lastDdlTime"}
    quote = lambda text: "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"
    listed = ", ".join(f"{quote(k)} = {quote(v)}" for k, v in sorted(own.items()))
    return f" TBLPROPERTIES ({listed})" if listed else ""


def swap_in(spark: SparkSession, table: str, staged: str) -> None:
    """Put a staged table in the place of ``table``.

    Spark cannot overwrite a table that it reads, so the successor is written in
    full first. A crash between the two renames leaves the old rows under
    ``<table>__old``; ``recover`` puts them back. One writer per table at a time.
    """
    old = f"{table}__old"
    recover(spark, table)
    spark.sql(f"DROP TABLE IF EXISTS {old}")
    spark.sql(f"ALTER TABLE {table} RENAME TO {old}")
    spark.sql(f"ALTER TABLE {staged} RENAME TO {table}")
    spark.sql(f"DROP TABLE {old}")


def recover(spark: SparkSession, table: str) -> bool:
    """Undo a swap, or finish a replacement, that was cut short; true if there was one."""
    old = f"{table}__old"
    if finish_replacement(spark, table):
        return True
    if spark.catalog.tableExists(table) or not spark.catalog.tableExists(old):
        return False
    spark.sql(f"ALTER TABLE {old} RENAME TO {table}")
    return True


_COMPLETE = "successor_is_complete"


def replace_partitioned(df: DataFrame, table: str) -> None:
    """Replace all rows of a table whose partitions a rename would leave behind.

    The successor is a table of its own, marked when it is complete, and only then written
    over the table. A stop before the mark leaves the old rows; after it the successor stays
    until ``recover``, which every job calls first, has written it in full. Between the two
    the table may be read half written: a table that is read meanwhile is better kept in
    buckets (``plans.bucketed``).
    """
    spark = df.sparkSession
    successor = f"{table}__next"
    spark.sql(f"DROP TABLE IF EXISTS {successor}")
    df.write.mode("errorifexists").format("parquet").saveAsTable(successor)
    spark.sql(f"ALTER TABLE {successor} SET TBLPROPERTIES ('{_COMPLETE}' = 'true')")
    finish_replacement(spark, table)


def finish_replacement(spark: SparkSession, table: str) -> bool:
    """Write a complete successor over the table, drop any other; true if rows were replaced."""
    successor = f"{table}__next"
    if not spark.catalog.tableExists(successor):
        return False
    properties = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {successor}").collect()}
    whole = properties.get(_COMPLETE) == "true" and spark.catalog.tableExists(table)
    if whole:
        reload_table(spark.table(successor), table)
    spark.sql(f"DROP TABLE {successor}")
    return whole


@contextmanager
def _setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def replace_partitions(df: DataFrame, table: str) -> None:
    """Replace only the partitions that ``df`` holds rows of.

    Unlike a whole-table overwrite this may read the table it writes: new files
    become visible when the job commits. The mode is a session setting because
    ``insertInto`` does not take it as a writer option.
    """
    spark = df.sparkSession
    columns = spark.table(table).columns
    with _setting(spark, "spark.sql.sources.partitionOverwriteMode", "dynamic"):
        df.select(*[quoted(c) for c in columns]).write.insertInto(table, overwrite=True)


def merge_rows(source: DataFrame, table: str, keys: Sequence[str]) -> None:
    """Keyed checksum merge done by the table format; needs row-level support.

    Plain file tables do not have it, and Spark refuses this for them.
    """
    on = reduce(
        lambda a, b: a & b,
        [F.col(f"source.{quoted(k)}") == F.col(f"{table}.{quoted(k)}") for k in keys],
    )
    same = F.col(f"source.{SYNC_CHECKSUM}").eqNullSafe(F.col(f"{table}.{SYNC_CHECKSUM}"))
    columns = source.sparkSession.table(table).columns
    values = {c: F.col(f"source.{quoted(c)}") for c in columns if c in source.columns}
    (
        source.alias("source")
        .mergeInto(table, on)
        .whenMatched(~same)
        .update(values)
        .whenNotMatched()
        .insert(values)
        .merge()
    )


def batch_size_for(columns: int) -> int:
    """Rows per JDBC batch: 3000, fewer for wide rows (65000 bound values)."""
    return max(1, min(3000, 65000 // max(columns, 1)))


def write_jdbc(
    df: DataFrame, jdbc: Mapping[str, str], table: str, if_exists: str = "append"
) -> None:
    """Write to a database; the connection comes from the options alone."""
    (
        df.write.format("jdbc")
        .options(**jdbc)
        .option("dbtable", table)
        .option("batchsize", batch_size_for(len(df.columns)))
        .mode(_MODES[if_exists])
        .save()
    )


AUDIT_SCHEMA = (
    "connector_name string, schema_name string, sync_started_at timestamp, "
    "sync_completed_at timestamp, sync_status string, records_synced long, "
    "error_message string, created_at timestamp"
)


def record_sync(
    spark: SparkSession,
    table: str,
    connector: str,
    schema: str,
    started_at,
    *,
    completed_at=None,
    status: str = "running",
    records: int = 0,
    error: str | None = None,
) -> None:
    """Append one audit row; the table is made on first use."""
    row = spark.createDataFrame(
        [(connector, schema, started_at, completed_at, status, records, error)],
        "connector_name string, schema_name string, sync_started_at timestamp, "
        "sync_completed_at timestamp, sync_status string, records_synced long, "
        "error_message string",
    ).withColumn("created_at", F.current_timestamp())
    row.write.mode("append").format("parquet").saveAsTable(table)


@contextmanager
def audited(
    spark: SparkSession, table: str | None, connector: str, schema: str
) -> Iterator[dict[str, int]]:
    """Audit rows around a job: running, then success with its ``records``, or error.

    Without a table nothing is written.
    """
    started = dt.datetime.now(dt.timezone.utc)
    outcome: dict[str, int] = {"records": 0}
    if not table:
        yield outcome
        return
    record_sync(spark, table, connector, schema, started)

    def ended(status: str, error: str | None = None) -> None:
        record_sync(
            spark, table, connector, schema, started,
            completed_at=dt.datetime.now(dt.timezone.utc), status=status,
            records=outcome["records"], error=error,
        )

    try:
        yield outcome
    except Exception as error:
        ended("error", str(error).splitlines()[0][:500])
        raise
    ended("success")


def stored_result(df: DataFrame) -> DataFrame:
    """Rows that outlive what they were computed from, such as a table about to be replaced."""
    return stored_rows(df)


def latest_syncs(audit: DataFrame) -> DataFrame:
    """The newest audit row of each connector and schema."""
    return merge.first_per_key(
        audit, ["connector_name", "schema_name"], [F.desc("created_at"), F.desc("sync_completed_at")]
    )
