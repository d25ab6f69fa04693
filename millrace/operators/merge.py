"""Checksum merge: which rows of a source are new, changed or already stored."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.hashing import SYNC_CHECKSUM, SYNC_COLUMNS, SYNC_UPDATED_AT, row_checksum
from millrace.operators.mapping import quoted

ACTION = "_action"
INSERTED, UPDATED, UNCHANGED, KEPT = "inserted", "updated", "unchanged", "kept"


def with_checksum(df: DataFrame, columns: Sequence[str] | None = None, **options) -> DataFrame:
    """Add ``_sync_checksum`` over all data columns (or the named ones)."""
    return df.withColumn(SYNC_CHECKSUM, row_checksum(df.schema, columns, **options))


def _any_null(keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(quoted(k)).isNull() for k in keys])


def first_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[Column]) -> DataFrame:
    """One row per key, the first in the given order.

    Written as ``row_number() = 1`` because Spark then keeps only one candidate
    per key in each input partition *before* the shuffle, so a key that holds a
    third of all rows sends at most one row per partition.
    """
    window = Window.partitionBy(*[quoted(k) for k in keys]).orderBy(*order_by)
    return df.withColumn("_rank", F.row_number().over(window)).where("_rank = 1").drop("_rank")


def dedupe_source(
    source: DataFrame, keys: Sequence[str], order_by: Sequence[Column] | None = None
) -> DataFrame:
    """One row per merge key; rows with a null key are all kept, as they match nothing.

    Without an order the smallest checksum wins, which is arbitrary but repeatable.
    """
    order = list(order_by or []) + [F.col(SYNC_CHECKSUM)]
    keyed = first_per_key(source.where(~_any_null(keys)), keys, order)
    return keyed.unionByName(source.where(_any_null(keys)))


def distinct_keys(source: DataFrame, keys: Sequence[str]) -> int:
    """Rows left after ``dedupe_source``, counted from the key columns alone."""
    names = [quoted(k) for k in keys]
    keyed = source.where(~_any_null(keys)).select(*names).distinct().count()
    return keyed + source.where(_any_null(keys)).count()


def duplicate_keys(source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their row counts."""
    return (
        source.where(~_any_null(keys))
        .groupBy(*keys)
        .agg(F.count("*").alias("n_rows"))
        .where("n_rows > 1")
    )


def _compared(source: DataFrame, target: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    # Rows with a null key match nothing but must all come out of an outer join: a number
    # of their own deals them out, so that they do not meet in the task of null.
    lonely = F.when(_any_null(keys), F.xxhash64(SYNC_CHECKSUM)).otherwise(F.lit(0))
    left = target.withColumn("_spread", lonely).alias("t")
    right = source.withColumn("_spread", lonely).alias("s")
    on = reduce(
        lambda a, b: a & b,
        [F.col(f"t.{quoted(k)}") == F.col(f"s.{quoted(k)}") for k in keys],
    )
    return left.join(right, on & (F.col("t._spread") == F.col("s._spread")), how)


def merge_keyed(
    target: DataFrame, source: DataFrame, keys: Sequence[str], run_time: Column
) -> DataFrame:
    """The merged table, each row with its ``_action``; one shuffle of either side.

    A matching row with another checksum (a missing one included) takes all
    source values. ``source`` must hold one row per key. Suits a source that is
    a good part of the target; for a small one see ``merge_delta``.
    """
    data = [c for c in target.columns if c not in SYNC_COLUMNS]
    joined = _compared(
        source.select(*[quoted(c) for c in data], SYNC_CHECKSUM, F.lit(True).alias("_in_s")),
        target.withColumn("_in_t", F.lit(True)),
        keys,
        "full_outer",
    )
    same = F.col(f"t.{SYNC_CHECKSUM}").eqNullSafe(F.col(f"s.{SYNC_CHECKSUM}"))
    action = (
        F.when(F.col("_in_s").isNull(), KEPT)
        .when(F.col("_in_t").isNull(), INSERTED)
        .when(same, UNCHANGED)
        .otherwise(UPDATED)
    )
    take_source = F.col("_in_s").isNotNull() & (F.col("_in_t").isNull() | ~same)

    def value(name: str) -> Column:
        if name == SYNC_UPDATED_AT or name not in [*data, SYNC_CHECKSUM]:
            fresh = run_time.cast(target.schema[name].dataType)
            if name != SYNC_UPDATED_AT:
                fresh = F.coalesce(F.col(f"t.{quoted(name)}"), fresh)
        else:
            fresh = F.col(f"s.{quoted(name)}").cast(target.schema[name].dataType)
        return F.when(take_source, fresh).otherwise(F.col(f"t.{quoted(name)}")).alias(name)

    return joined.select(*[value(c) for c in target.columns], action.alias(ACTION))


def all_new(target: T.StructType, source: DataFrame, run_time: Column) -> DataFrame:
    """What ``merge_keyed`` gives for a target without rows, without a join."""
    kept = [c for c in source.columns if c == SYNC_CHECKSUM or c not in SYNC_COLUMNS]
    values = [
        (F.col(quoted(f.name)) if f.name in kept else run_time).cast(f.dataType).alias(f.name) for f in target
    ]
    return source.select(*values, F.lit(INSERTED).alias(ACTION))


def merge_changes(
    target: DataFrame, source: DataFrame, keys: Sequence[str], run_time: Column
) -> DataFrame:
    """Only the source rows to insert or update, with ``_action``.

    Reads no more of the target than its keys and checksum, and of these joins only those
    the source names: a small source is broadcast, and the target is not shuffled.
    """
    wanted = source.select(*[quoted(k) for k in keys])
    slim = target.join(wanted, list(keys), "left_semi")
    slim = slim.select(*[quoted(k) for k in keys], SYNC_CHECKSUM).withColumn(
        "_in_t", F.lit(True)
    )
    joined = _compared(source, slim, keys, "right_outer")
    same = F.col(f"t.{SYNC_CHECKSUM}").eqNullSafe(F.col(f"s.{SYNC_CHECKSUM}"))
    action = F.when(F.col("_in_t").isNull(), INSERTED).when(~same, UPDATED).otherwise(UNCHANGED)

    def value(name: str) -> Column:
        if name in source.columns:
            return F.col(f"s.{quoted(name)}").cast(target.schema[name].dataType).alias(name)
        return run_time.cast(target.schema[name].dataType).alias(name)

    return joined.select(*[value(c) for c in target.columns], action.alias(ACTION)).where(
        F.col(ACTION) != UNCHANGED
    )


def merge_delta(target: DataFrame, changes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The merged table from ``merge_changes``: untouched target rows plus the changes.

    The anti join needs only the changed keys. When these turn out small at run
    time, adaptive execution broadcasts them and the target is never shuffled.
    """
    touched = changes.where(F.col(ACTION) == UPDATED).select(*[quoted(k) for k in keys])
    return target.join(touched, list(keys), "left_anti").unionByName(changes.drop(ACTION))


def merge_checksum_only(target: DataFrame, source: DataFrame) -> DataFrame:
    """Source rows whose checksum the target does not hold, each once."""
    return source.dropDuplicates([SYNC_CHECKSUM]).join(
        target.select(SYNC_CHECKSUM), SYNC_CHECKSUM, "left_anti"
    ).select(*source.columns)


def insert_or_ignore(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Source rows with a key the target does not hold, one per key.

    Which of several source rows with one key is taken is decided by their whole
    content, so a retried task takes the same one.
    """
    content = F.struct(*[quoted(c) for c in source.columns])
    return first_per_key(source, keys, [content]).join(
        target.select(*keys), list(keys), "left_anti"
    ).select(*source.columns)


def action_counts(merged: DataFrame) -> DataFrame:
    """Rows per action, without the rows the source does not name."""
    return (
        merged.where(F.col(ACTION) != KEPT)
        .groupBy(F.col(ACTION).alias("action"))
        .agg(F.count("*").alias("n_rows"))
    )
