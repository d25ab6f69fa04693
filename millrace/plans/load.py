"""File loads, full table refreshes and table copies."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.cleanse import drop_sheet_errors
from millrace.functions.hashing import SYNC_CREATED_AT
from millrace.operators import pii, quality, schema
from millrace.operators.mapping import map_columns, quoted, table_name
from millrace.plans.sync import replace_personal_data
from millrace.session import Scratch
from millrace.sources import tables, writers


@dataclass
class LoadResult:
    status: str
    rows_written: int
    rows_rejected: int
    error_rate: float
    errors: list[dict]
    table_created: bool


class LoadFailed(Exception):
    """More rows were rejected than loaded, or none could be loaded."""


def cleansed(df: DataFrame) -> DataFrame:
    """Spreadsheet error texts in any text column become null."""
    return df.select(
        *[
            drop_sheet_errors(F.col(quoted(f.name))).alias(f.name)
            if isinstance(f.dataType, T.StringType)
            else F.col(quoted(f.name))
            for f in df.schema
        ]
    )


def prepared_rows(
    df: DataFrame, target: T.StructType, mapping: Mapping[str, str] | None = None
) -> DataFrame:
    """Cleansed, mapped and coerced rows, each with its reject reasons."""
    mapped = map_columns(cleansed(df), mapping or {})
    return schema.coerce(schema.conform(mapped, target), target)


def load_file(
    df: DataFrame,
    table: str,
    *,
    mapping: Mapping[str, str] | None = None,
    target: T.StructType | None = None,
    pii_config: Mapping[str, object] | Sequence[str] | None = None,
    source_system: str | None = None,
    pii_context: str | None = None,
    pii_table: str | None = None,
    if_exists: str = "append",
    auto_create: bool = True,
    rejects: str | None = None,
    pii_switch: str | None = None,
    audit: str | None = None,
) -> LoadResult:
    """Load tabular rows into a table, with audit rows where ``audit`` names a table.

    All options but ``audit`` and ``pii_switch`` (as for ``sync``) are those of ``load_rows``.
    """
    if not pii.switched_on(pii_switch):
        pii_config = None
    database, _, name = table.rpartition(".")
    with writers.audited(df.sparkSession, audit, source_system or name, database) as outcome:
        done = load_rows(
            df, table, mapping=mapping, target=target, pii_config=pii_config,
            source_system=source_system, pii_context=pii_context, pii_table=pii_table,
            if_exists=if_exists, auto_create=auto_create, rejects=rejects,
        )
        outcome["records"] = done.rows_written
    return done


def load_rows(
    df: DataFrame,
    table: str,
    *,
    mapping: Mapping[str, str] | None = None,
    target: T.StructType | None = None,
    pii_config: Mapping[str, object] | Sequence[str] | None = None,
    source_system: str | None = None,
    pii_context: str | None = None,
    pii_table: str | None = None,
    if_exists: str = "append",
    auto_create: bool = True,
    rejects: str | None = None,
) -> LoadResult:
    """Load tabular rows into a table; bad rows are told apart one by one.

    A missing table is created, after its database, from ``target`` or from the
    data with sized text columns, and gets a column for the time of loading.
    Columns the target fills itself are left out unless mapped. ``rejects`` names a table for the refused rows
    and their reasons. ``append`` refuses columns that the table lacks; ``replace`` with
    other columns or types gives the table that shape.
    """
    spark = df.sparkSession
    exists = spark.catalog.tableExists(table)
    if exists and if_exists == "fail":
        raise ValueError(f"table {table} exists already")
    if not exists and not auto_create:
        raise ValueError(f"table {table} does not exist")
    with Scratch(spark) as scratch:
        source = map_columns(cleansed(df), mapping or {})
        if pii_config:
            source = replace_personal_data(
                source, scratch, pii_config, source_system or table, pii_context, pii_table
            )
        if target is None:
            known = spark.table(table).schema if exists else None
            target = known or schema.infer_schema(source, sized=True)
        elif exists and if_exists == "append":
            stored = spark.table(table).columns
            unknown = [n for n in schema.data_fields(target) if n not in stored]
            if unknown:
                raise ValueError(f"columns not in {table}: {unknown}")
        source = schema.drop_generated(source, target, list((mapping or {}).values()))
        tagged = scratch.keep(schema.coerce(schema.conform(source, target), target))
        outcome = quality.load_outcome(tagged).first()
        bad = schema.rejected(tagged)
        content = F.to_json(F.struct(*bad.columns))
        errors = [r.asDict(recursive=True) for r in bad.orderBy(content).limit(10).collect()]
        if rejects and outcome["rows_rejected"]:
            writers.write_table(bad.withColumn("table_name", F.lit(table)), rejects, "append")
        if outcome["failed"] or outcome["status"] == "error":
            raise LoadFailed(f"{outcome['rows_rejected']} rows were rejected, first: {errors[:1]}")
        if not exists:
            if "." in table:
                writers.ensure_database(spark, table.rsplit(".", 1)[0])
            writers.create_table(spark, table, target, sync_columns=[SYNC_CREATED_AT])
        rows = schema.accepted(tagged)
        into = table
        if exists and if_exists == "replace" and _changed(spark.table(table).schema, target):
            # Other columns or types: the successor is made new and put in the table's place.
            into = writers.staged_name(table)
            writers.create_table(spark, into, target, sync_columns=[SYNC_CREATED_AT])
        for f in spark.table(into).schema:
            if f.name not in rows.columns:
                filled = F.current_timestamp() if f.name == SYNC_CREATED_AT else F.lit(None)
                rows = rows.withColumn(f.name, filled.cast(f.dataType))
        if into != table:
            writers.append_rows(rows, into)
            writers.swap_in(spark, table, into)
        elif if_exists == "replace":
            writers.reload_table(rows, table)
        else:
            writers.write_table(rows, table, "append")
    return LoadResult(
        outcome["status"], outcome["rows_written"], outcome["rows_rejected"],
        outcome["error_rate"], errors, not exists,
    )


def _changed(stored: T.StructType, target: T.StructType) -> bool:
    own = {f.name: f.dataType for f in stored if f.name != SYNC_CREATED_AT}
    return own != {n: f.dataType for n, f in schema.data_fields(target).items() if n != SYNC_CREATED_AT}


def refresh_tables(
    spark: SparkSession,
    wanted: Sequence[str],
    source_db: str | None,
    target_db: str,
    prefix: str = "",
    declared: Mapping[str, T.StructType] | None = None,
) -> DataFrame:
    """Full refresh of several tables; one result row per table.

    A missing source table stops the run before anything is written. A table
    that fails is reported and the others go on.
    """
    tables.require_tables(spark, wanted, source_db)
    writers.ensure_database(spark, target_db)
    results = []
    for name in wanted:
        source = f"{source_db}.{name}" if source_db else name
        target = f"{target_db}.{table_name(prefix, name)}"
        try:
            rows = tables.scan_table(spark, source, (declared or {}).get(name))
            writers.refresh_table(rows, target)
            before, after = quality.table_counts(spark, source, target)
            status = "success" if before == after else "warning"
            results.append((name, target, status, after, None))
        except Exception as error:  # one table must not stop the others
            results.append((name, target, "error", 0, str(error).splitlines()[0]))
    return spark.createDataFrame(
        results,
        "table_name string, target string, status string, n_rows long, error string",
    )


def copy_table(spark: SparkSession, source: DataFrame, table: str) -> int:
    """Copy rows into a table that stays in place; created if absent."""
    if spark.catalog.tableExists(table):
        writers.reload_table(source, table)
    else:
        writers.write_table(source, table, "fail")
    return spark.table(table).count()
