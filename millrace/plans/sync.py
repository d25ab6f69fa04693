"""Keyed and checksum-only sync of a source into a table."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.hashing import SYNC_CHECKSUM, SYNC_COLUMNS, SYNC_UPDATED_AT
from millrace.operators import merge, pii, schema
from millrace.operators.mapping import check_merge_keys, quoted, rename_columns
from millrace.session import Scratch
from millrace.sources import writers


@dataclass
class SyncResult:
    status: str
    rows_read: int
    inserted: int
    updated: int
    unchanged: int
    skipped: int
    duplicates: int
    table_created: bool
    errors: list[dict] = field(default_factory=list)


def prepare_source(
    source: DataFrame,
    *,
    mapping: Mapping[str, str] | None = None,
    keys: Sequence[str] = (),
) -> DataFrame:
    check_merge_keys(keys, mapping)
    return rename_columns(source, mapping or {})


def sync(
    source: DataFrame,
    table: str,
    *,
    keys: Sequence[str] = (),
    mapping: Mapping[str, str] | None = None,
    pii_config: Mapping[str, object] | Sequence[str] | None = None,
    source_system: str = "",
    pii_context: str | None = None,
    pii_table: str | None = None,
    mode: str = "auto",
    on_bad: str = "fail",
    order_by: Sequence[Column] = (),
    partition_by: Sequence[str] = (),
    strategy: str = "full",
    contract: T.StructType | None = None,
    run_time: dt.datetime | None = None,
    pii_switch: str | None = None,
    audit: str | None = None,
) -> SyncResult:
    """Sync a source into a table, with audit rows around it where ``audit`` names a table.

    All options but ``audit`` and ``pii_switch`` (the text of the global switch for
    personal-data replacement; false, 0 or no turn it off) are those of ``sync_rows``.
    """
    if not pii.switched_on(pii_switch):
        pii_config = None
    database, _, name = table.rpartition(".")
    with writers.audited(source.sparkSession, audit, source_system or name, database) as outcome:
        done = sync_rows(
            source, table, keys=keys, mapping=mapping, pii_config=pii_config,
            source_system=source_system, pii_context=pii_context, pii_table=pii_table,
            mode=mode, on_bad=on_bad, order_by=order_by, partition_by=partition_by,
            strategy=strategy, contract=contract, run_time=run_time,
        )
        outcome["records"] = done.inserted + done.updated
    return done


def sync_rows(
    source: DataFrame,
    table: str,
    *,
    keys: Sequence[str] = (),
    mapping: Mapping[str, str] | None = None,
    pii_config: Mapping[str, object] | Sequence[str] | None = None,
    source_system: str = "",
    pii_context: str | None = None,
    pii_table: str | None = None,
    mode: str = "auto",
    on_bad: str = "fail",
    order_by: Sequence[Column] = (),
    partition_by: Sequence[str] = (),
    strategy: str = "full",
    contract: T.StructType | None = None,
    run_time: dt.datetime | None = None,
) -> SyncResult:
    """Bring a table up to date with a source and say what changed.

    With ``keys`` a row whose checksum differs is updated and an unknown key is
    inserted; without, rows with an unknown checksum are appended. ``mode='auto'``
    creates a missing table with wide nullable columns; ``'existing'`` demands a
    table that fits. ``contract`` declares columns that file tables cannot keep:
    bounded types and NOT NULL. A row is refused, with its reasons, if it lacks a
    required value or a merge key, or if a value does not fit its column's type or
    length; ``on_bad='skip'`` leaves such rows out, ``'fail'`` stops before anything is
    written.

    The prepared source is written once to the scratch folder, so a remote
    source is read once and every count is taken from stored rows, exact even if
    tasks are repeated. (With ``pii_config`` it is read once more for the new
    replacements: raw personal data is never stored on the way.) ``strategy='delta'`` suits a source much smaller than the
    table: only its changed keys meet the table. A table partitioned by columns
    of the merge key is rewritten in the touched partitions only.
    """
    if mode not in ("auto", "existing") or on_bad not in ("fail", "skip"):
        raise ValueError("mode is auto or existing; on_bad is fail or skip")
    if strategy not in ("full", "delta", "merge_into"):
        raise ValueError("strategy is full, delta or merge_into")
    if set(partition_by) - set(keys):
        raise ValueError("partition columns must be part of the merge key")
    spark = source.sparkSession
    writers.require_database(spark, table)
    writers.recover(spark, table)
    prepared = prepare_source(source, mapping=mapping, keys=keys)
    missing = [k for k in keys if k not in prepared.columns]
    if missing:
        raise ValueError(f"merge keys not in the source: {missing}")
    created = not spark.catalog.tableExists(table)
    if created and mode == "existing":
        raise ValueError(f"table {table} does not exist")
    with Scratch(spark) as scratch:
        if pii_config:
            prepared = replace_personal_data(
                prepared, scratch, pii_config, source_system or table, pii_context, pii_table
            )
        if created:
            wide = contract or schema.widen(prepared.schema)
            writers.create_table(spark, table, wide, partition_by=partition_by)
        else:
            spark.catalog.refreshTable(table)
            writers.add_sync_columns(spark, table)
        target = spark.table(table)
        staged = scratch.keep(checked_rows(prepared, contract or target.schema, keys))
        skipped, errors = count_rejects(staged, on_bad)
        good = merge.with_checksum(schema.accepted(staged))
        rows_read = staged.count()
        stamp = F.lit(run_time or dt.datetime.now(dt.timezone.utc)).cast("timestamp")
        if keys:
            # Only the keys are shuffled to see whether any comes twice; most sources have none.
            distinct = merge.distinct_keys(good, keys)
            single = good if distinct == rows_read - skipped else merge.dedupe_source(good, keys, order_by)
            inserted, updated = _merge_into(
                scratch, table, target, good, single, keys, stamp, partition_by, strategy
            )
        else:
            before = target.count()
            fresh = merge.merge_checksum_only(target, good).withColumn(SYNC_UPDATED_AT, stamp)
            writers.write_table(complete_rows(fresh, target), table, "append")
            inserted, updated = spark.table(table).count() - before, 0
            distinct = inserted
            if distinct < rows_read - skipped:
                distinct = good.select(SYNC_CHECKSUM).distinct().count()
    return SyncResult(
        status="success" if not skipped else ("partial" if skipped < rows_read else "error"),
        rows_read=rows_read,
        inserted=inserted,
        updated=updated,
        unchanged=distinct - inserted - updated,
        skipped=skipped,
        duplicates=rows_read - skipped - distinct,
        table_created=created,
        errors=errors,
    )


def sync_all(
    frames: Mapping[str, DataFrame], database: str, keys: Sequence[str], **options
) -> dict[str, SyncResult]:
    """Keyed sync of several frames into tables of the same names, such as entities."""
    return {
        name: sync(df, f"{database}.{name}", keys=keys, **options) for name, df in frames.items()
    }


def replace_personal_data(
    rows: DataFrame,
    scratch: Scratch,
    config: Mapping[str, object] | Sequence[str],
    source_system: str,
    context: str | None,
    mapping_table: str | None,
) -> DataFrame:
    """Anonymised rows; new replacements are added to the mapping table first."""
    spark = rows.sparkSession
    made_up = [n for n, c in config.items() if isinstance(c, Mapping) and c.get("field_type")] if isinstance(
        config, Mapping
    ) else []
    if made_up and not mapping_table:
        # Realistic texts are numbered by who came before, which only the table remembers.
        raise ValueError(f"realistic replacements of {made_up} need a mapping table")
    if not mapping_table:
        return pii.anonymize(rows, config, source_system, context)[0]
    exists = spark.catalog.tableExists(mapping_table)
    stored = spark.table(mapping_table) if exists else pii.empty_mapping(spark)
    _, new_rows = pii.anonymize(rows, config, source_system, context, stored)
    writers.write_table(scratch.keep(new_rows), mapping_table, "append")
    return pii.anonymize(rows, config, source_system, context, spark.table(mapping_table))[0]


def checked_rows(prepared: DataFrame, target: T.StructType, keys: Sequence[str]) -> DataFrame:
    """Source rows in the target's columns and types, with their reject reasons."""
    data = schema.data_fields(target)
    shaped = schema.conform(prepared, target, on_extra="drop")
    report = schema.validate_frame(shaped.limit(0), target)
    if not report.is_valid:
        raise ValueError("source does not fit the table: " + "; ".join(report.issues))
    values, reasons = [], [F.lit(None).cast("string")]
    for name, f in data.items():
        if name not in shaped.columns:
            continue
        raw, kept = F.col(quoted(name)), shaped.schema[name].dataType == f.dataType
        value = raw if kept else raw.try_cast(f.dataType)
        values.append(value.alias(name))
        if not f.nullable or name in keys:
            reasons.append(F.when(raw.isNull(), F.lit(f"{name} is null")))
        if not kept:
            misfit = raw.isNotNull() & value.isNull()
            reasons.append(F.when(misfit, F.lit(f"{name} does not fit {f.dataType.simpleString()}")))
        bound = (f.metadata or {}).get("max_length")
        if bound and isinstance(f.dataType, T.StringType):
            reasons.append(
                F.when(F.length(value) > bound, F.lit(f"{name} is longer than {bound} characters"))
            )
    listed = F.array_compact(F.array(*reasons)).alias(schema.REJECT_REASONS)
    return shaped.select(*values, listed)


def count_rejects(staged: DataFrame, on_bad: str) -> tuple[int, list[dict]]:
    """How many rows are refused, and the first ten of them."""
    bad = schema.rejected(staged)
    skipped = bad.count()
    content = F.to_json(F.struct(*bad.columns))
    errors = [r.asDict(recursive=True) for r in bad.orderBy(content).limit(10).collect()]
    if skipped and on_bad == "fail":
        raise ValueError(f"{skipped} rows lack required values, first: {errors[0]}")
    return skipped, errors


def _merge_into(
    scratch: Scratch,
    table: str,
    target: DataFrame,
    good: DataFrame,
    single: DataFrame,
    keys: Sequence[str],
    stamp: Column,
    partition_by: Sequence[str],
    strategy: str,
) -> tuple[int, int]:
    """Merge and count; returns inserted and updated rows. ``single`` has a row for each key of ``good``."""
    spark = scratch.spark
    if not partition_by:
        partition_by = [
            c.name for c in spark.catalog.listColumns(table) if c.isPartition and c.name in keys
        ]
    scope = target
    pruned = bool(partition_by) and strategy != "merge_into"
    if pruned:
        scope = _touched(target, good, partition_by)
    before = scope.count()
    complete = complete_rows(single, target)
    if strategy == "merge_into":
        writers.merge_rows(complete.withColumn(SYNC_UPDATED_AT, stamp), table, keys)
        written = spark.table(table).where(F.col(SYNC_UPDATED_AT) == stamp).count()
        inserted = spark.table(table).count() - before
        return inserted, written - inserted
    counted = None
    if strategy == "delta":
        changes = scratch.keep(merge.merge_changes(scope, complete, keys, stamp))
        counted = changes
        merged = merge.merge_delta(scope, changes, keys)
    elif not before:
        merged = merge.all_new(target.schema, complete, stamp).drop(merge.ACTION)
    else:
        if not scope.where(F.col(SYNC_UPDATED_AT) == stamp).isEmpty():
            # An earlier run had this run time, so the time does not tell what this one wrote.
            slim = [quoted(k) for k in keys]
            counted = merge.merge_keyed(
                scope.select(*slim, SYNC_CHECKSUM, SYNC_UPDATED_AT),
                single.select(*slim, SYNC_CHECKSUM),
                keys,
                stamp,
            )
        merged = merge.merge_keyed(scope, complete, keys, stamp).drop(merge.ACTION)
    actions = dict(merge.action_counts(counted).collect()) if counted is not None else None
    merged = merged.select(*[quoted(c) for c in target.columns])
    if pruned:
        writers.replace_partitions(merged, table)
        after = _touched(spark.table(table), good, partition_by)
    elif any(c.isPartition for c in spark.catalog.listColumns(table)):
        writers.replace_partitioned(merged, table)
        after = spark.table(table)
    else:
        staged = writers.stage(merged, table)
        writers.swap_in(spark, table, staged)
        after = spark.table(table)
    if actions is not None:
        return actions.get(merge.INSERTED, 0), actions.get(merge.UPDATED, 0)
    written = after.where(F.col(SYNC_UPDATED_AT) == stamp).count()
    inserted = after.count() - before
    return inserted, written - inserted


# Up to this many values of a partition column are listed in a predicate; beyond, its
# range is, and the join below leaves only the partitions that are touched.
LISTED_PARTITIONS = 5_000


def _touched(target: DataFrame, source: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """The rows of the partitions the source has rows in.

    Listed values, or their range, prune the file listing. Partition columns are merge
    keys, so none of the source's values is null.
    """
    names = [quoted(n) for n in partition_by]
    wanted = source.select(*names).distinct()
    for name in names:
        column = F.col(name)
        found = source.select(column).distinct().limit(LISTED_PARTITIONS + 1).collect()
        if len(found) <= LISTED_PARTITIONS:
            target = target.where(column.isin(*[r[0] for r in found]) if found else F.lit(False))
        else:
            low, high = source.agg(F.min(column), F.max(column)).first()
            target = target.where(column.between(F.lit(low), F.lit(high)))
    return target.join(wanted, list(partition_by), "left_semi").select(*[quoted(c) for c in target.columns])


def complete_rows(rows: DataFrame, target: DataFrame) -> DataFrame:
    """Add target columns that the source does not deliver, as nulls."""
    for f in target.schema:
        if f.name not in rows.columns and f.name not in SYNC_COLUMNS:
            rows = rows.withColumn(f.name, F.lit(None).cast(f.dataType))
    return rows
