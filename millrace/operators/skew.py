"""Keys that hold so many rows that one task should not take them alone."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.operators.mapping import quoted
from millrace.session import stored_rows

def same_key(left: str, right: str, keys: Sequence[str]) -> Column:
    return reduce(
        lambda a, b: a & b,
        [F.col(f"{left}.{quoted(k)}").eqNullSafe(F.col(f"{right}.{quoted(k)}")) for k in keys],
    )


def with_position(df: DataFrame, keys: Sequence[str], order_by: Sequence[Column]) -> DataFrame:
    """Add ``_position``: the row's number in the order of its key, from 1.

    The rows are range-partitioned by key and order and stored, so a key that holds
    most rows is sorted in many tasks; a row's number is its number in its range plus
    the rows of the key in the ranges before it.
    """
    names = [quoted(k) for k in keys]
    ranged = stored_rows(
        df.repartitionByRange(*names, *order_by).withColumn("_range", F.spark_partition_id())
    )
    within = Window.partitionBy(*names, "_range").orderBy(*order_by)
    before = Window.partitionBy(*names).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        ranged.groupBy(*names, "_range")
        .agg(F.count("*").alias("_n"))
        .withColumn("_start", F.coalesce(F.sum("_n").over(before), F.lit(0)))
        .drop("_n")
    )
    on = same_key("r", "s", [*keys, "_range"])
    numbered = ranged.withColumn("_turn", F.row_number().over(within)).alias("r")
    return numbered.join(starts.alias("s"), on).select(
        *[F.col(f"r.{quoted(c)}") for c in df.columns],
        (F.col("r._turn") + F.col("s._start")).alias("_position"),
    )


def one_row_per_key(df: DataFrame, keys: Sequence[str], *aggregates: Column) -> DataFrame:
    """Aggregate per key for the small side of a join with a skewed large side.

    Adaptive execution splits a skewed join partition only if both sides come
    straight from a shuffle. Grouping by the keys as one struct hides the
    grouping's partitioning, so the join shuffles this side, which is small.
    """
    packed = F.struct(*[F.col(quoted(k)).alias(k) for k in keys]).alias("_key")
    measures = aggregates or (F.count("*").alias("_rows"),)
    grouped = df.groupBy(packed).agg(*measures)
    kept = [c for c in grouped.columns if c != "_key" and (aggregates or c != "_rows")]
    return grouped.select(*[F.col(f"_key.{quoted(k)}").alias(k) for k in keys], *kept)
