"""Neighbours in an ordered key, exact even where one key holds most rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.operators.mapping import quoted
from millrace.operators.skew import same_key
from millrace.session import stored_rows


def in_ranges(df: DataFrame, keys: Sequence[str], order_by: Sequence[Column]) -> DataFrame:
    """The rows range-partitioned by key and order and stored, with ``_range`` and ``_turn``.

    Borders are sampled from the rows, so a key that holds most rows, be it within a second, lies
    in many ranges of like size. ``_turn`` tells apart rows that are equal in key and order.
    """
    numbered = df.withColumn("_turn", F.monotonically_increasing_id())
    ranged = numbered.repartitionByRange(*[quoted(k) for k in keys], *order_by, "_turn")
    return stored_rows(ranged.withColumn("_range", F.spark_partition_id()))


def with_neighbour(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[Column],
    value: Column,
    out: str,
    *,
    following: bool,
) -> DataFrame:
    """Add the value of the next (or previous) row of the same key.

    A plain ``lead`` sorts all rows of a key in one task. Here each range of the order finds
    its neighbours by itself, and the value at the edge of a range is carried into the range
    beside it. ``order_by`` are ascending columns; among rows equal in them any order is taken.
    """
    group = [quoted(k) for k in keys]
    named = in_ranges(df, keys, order_by).withColumn("_value", F.struct(value.alias("v")))
    local = Window.partitionBy(*group, "_range").orderBy(*order_by, "_turn")
    step = F.lead("_value") if following else F.lag("_value")
    marked = named.withColumn("_near", step.over(local))
    place = F.struct(*[o.alias(f"o{i}") for i, o in enumerate(order_by)], F.col("_turn").alias("turn"))
    pick = F.min_by if following else F.max_by
    edges = named.groupBy(*group, "_range").agg(pick("_value", place).alias("_edge"))
    across = Window.partitionBy(*group).orderBy("_range")
    jump = F.lead("_edge") if following else F.lag("_edge")
    beyond = edges.withColumn("_beyond", jump.over(across)).where("_beyond IS NOT NULL")
    # Only one key can lie on both sides of a border, so these rows are fewer than the ranges.
    beyond = F.broadcast(beyond.drop("_edge"))
    joined = marked.alias("m").join(beyond.alias("e"), same_key("m", "e", [*keys, "_range"]), "left")
    return joined.select(
        *[F.col(f"m.{quoted(c)}") for c in df.columns],
        F.coalesce("m._near", "e._beyond")["v"].alias(out),
    )
