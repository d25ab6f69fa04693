"""Reporting layer: the joint invoice and credit fact and its totals."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.mapping import quoted
from millrace.operators.schema import narrow

INVOICE, CREDIT = "invoice", "credit"


@dataclass(frozen=True)
class Dimension:
    """A dimension, its key, the fact's key and the attributes to take over."""

    df: DataFrame
    key: str
    fact_key: str
    attributes: Mapping[str, str]


def union_records(invoices: DataFrame, credits: DataFrame) -> DataFrame:
    """Both record kinds in one frame, told apart by ``record_type``.

    A column that one kind lacks is null there.
    """
    return invoices.withColumn("record_type", F.lit(INVOICE)).unionByName(
        credits.withColumn("record_type", F.lit(CREDIT)), allowMissingColumns=True
    )


def with_dimension(fact: DataFrame, dim: Dimension) -> DataFrame:
    """Left join of one dimension.

    No broadcast is forced: Spark broadcasts the dimension if its size allows,
    planned or measured, and otherwise shuffles and splits skewed keys.
    """
    looked_up = dim.df.select(
        F.col(quoted(dim.key)).alias(dim.fact_key),
        *[F.col(quoted(source)).alias(target) for source, target in dim.attributes.items()],
    )
    kept = [c for c in fact.columns if c not in dim.attributes.values()]
    return fact.select(*[quoted(c) for c in kept]).join(looked_up, dim.fact_key, "left")


def build_reporting(
    invoices: DataFrame,
    credits: DataFrame,
    dims: Sequence[Dimension] = (),
    *,
    narrowed: bool = False,
) -> DataFrame:
    fact = reduce(with_dimension, dims, union_records(invoices, credits))
    return narrow(fact) if narrowed else fact


def money(value: Column, precision: int = 19, scale: int = 4) -> Column:
    """A money value as a decimal, so that totals are exact in any order."""
    return value.cast(f"decimal({precision},{scale})")


def revenue_by(
    fact: DataFrame,
    keys: Sequence[str],
    *,
    revenue: str = "line_total",
    profit: str | None = "gross_profit",
    quantity: str | None = None,
) -> DataFrame:
    """Totals per key: rows, revenue and, where given, profit, margin and quantity."""
    measures = [F.count("*").alias("n_rows"), F.sum(revenue).alias("revenue")]
    if profit:
        measures += [F.sum(profit).alias("profit")]
    if quantity:
        measures += [F.sum(quantity).alias("quantity")]
    totals = fact.groupBy(*keys).agg(*measures)
    if profit:
        share = F.col("profit").cast("double") / F.nullif(
            F.col("revenue").cast("double"), F.lit(0.0)
        )
        totals = totals.withColumn("margin", share)
    return totals


def revenue_by_dimension(
    fact: DataFrame,
    dim: Dimension,
    keys: Sequence[str],
    *,
    revenue: str = "line_total",
    fact_keys: Sequence[str] = (),
) -> DataFrame:
    """Totals by dimension attributes, with the fact summed up before the join.

    The fact is first folded to one row per dimension key (and ``fact_keys``),
    within each input partition already. So a key that holds a third of all rows
    joins as one row, and the join shuffles totals in place of fact rows.
    """
    totals = folded(fact, [dim.fact_key, *fact_keys], revenue=revenue)
    return refolded(with_dimension(totals, dim), keys)


def folded(fact: DataFrame, keys: Sequence[str], *, revenue: str = "line_total") -> DataFrame:
    """One row for each value of the keys, with its rows and revenue, to be joined further."""
    return fact.groupBy(*keys).agg(F.count("*").alias("n_rows"), F.sum(revenue).alias("revenue"))


def refolded(totals: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Totals by fewer, or joined, keys."""
    return totals.groupBy(*keys).agg(
        F.sum("n_rows").alias("n_rows"), F.sum("revenue").alias("revenue")
    )
