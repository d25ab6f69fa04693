"""Data tests and reconciliations. Each gives a DataFrame of findings."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from millrace.operators.mapping import quoted


def check_not_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``column, n_failed`` for every column, from one pass."""
    counted = df.agg(*[F.count_if(F.col(quoted(c)).isNull()).alias(c) for c in columns])
    return counted.unpivot([], [quoted(c) for c in columns], "column", "n_failed")


def check_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys held by more than one row. Rows with a null key are not compared."""
    keyed = reduce(lambda a, k: a.where(F.col(quoted(k)).isNotNull()), keys, df)
    return keyed.groupBy(*keys).agg(F.count("*").alias("n_rows")).where("n_rows > 1")


def check_foreign_key(child: DataFrame, fk: str, parent: DataFrame, pk: str) -> DataFrame:
    """Foreign keys without a parent, and the rows that hold each.

    Child rows are counted per key before the join, so a key with a huge number
    of children meets the parent as one row.
    """
    held = (
        child.where(F.col(quoted(fk)).isNotNull())
        .groupBy(F.col(quoted(fk)).alias(fk))
        .agg(F.count("*").alias("n_rows"))
    )
    known = parent.select(F.col(quoted(pk)).alias(fk))
    return held.join(known, fk, "left_anti")


def orphan_rows(child: DataFrame, fk: str, parent: DataFrame, pk: str) -> DataFrame:
    """The child rows themselves whose parent is missing."""
    known = parent.select(F.col(quoted(pk)).alias(fk))
    return child.where(F.col(quoted(fk)).isNotNull()).join(known, fk, "left_anti").select(
        *child.columns
    )


def cascade_delete(child: DataFrame, fk: str, deleted: DataFrame, pk: str) -> DataFrame:
    """Child rows that remain after these parents are deleted."""
    gone = deleted.select(F.col(quoted(pk)).alias(fk))
    return child.join(gone, fk, "left_anti").select(*child.columns)


def check_counts(pairs: Mapping[str, tuple[DataFrame, DataFrame]]) -> DataFrame:
    """``table_name, source_rows, target_rows, matches`` for every named pair."""

    def counted(name: str, side: str, df: DataFrame) -> DataFrame:
        return df.agg(F.count("*").alias("n")).select(
            F.lit(name).alias("table_name"), F.lit(side).alias("side"), "n"
        )

    parts = [
        counted(name, side, df)
        for name, (source, target) in pairs.items()
        for side, df in (("source", source), ("target", target))
    ]
    both = reduce(DataFrame.union, parts).groupBy("table_name").agg(
        F.max(F.when(F.col("side") == "source", F.col("n"))).alias("source_rows"),
        F.max(F.when(F.col("side") == "target", F.col("n"))).alias("target_rows"),
    )
    return both.withColumn("matches", F.col("source_rows") == F.col("target_rows"))


def table_counts(spark: SparkSession, source: str, target: str) -> tuple[int, int]:
    """Row counts of two tables, ``(-1, -1)`` if one cannot be read."""
    try:
        return spark.table(source).count(), spark.table(target).count()
    except AnalysisException:
        return -1, -1


def outcome_status(succeeded: Column, failed: Column) -> Column:
    """success without failures, error without successes, else partial."""
    return (
        F.when(failed == 0, "success").when(succeeded == 0, "error").otherwise("partial")
    )


def load_outcome(tagged: DataFrame, reasons: str = "_reject_reasons") -> DataFrame:
    """One row: rows accepted and rejected, error rate in percent, status, verdict.

    ``failed`` is true when nothing was accepted or more rows failed than passed.
    """
    bad = F.size(reasons) > 0
    counted = tagged.agg(
        F.count_if(~bad).alias("rows_written"), F.count_if(bad).alias("rows_rejected")
    )
    good, poor = F.col("rows_written"), F.col("rows_rejected")
    return counted.select(
        "rows_written",
        "rows_rejected",
        F.round(F.coalesce(poor * 100 / F.nullif(good + poor, F.lit(0)), F.lit(0.0)), 1).alias(
            "error_rate"
        ),
        outcome_status(good, poor).alias("status"),
        (poor > good).alias("failed"),
    )


def first_errors(tagged: DataFrame, order_by: str, reasons: str = "_reject_reasons") -> DataFrame:
    """The first ten rejected rows, for a report."""
    return tagged.where(F.size(reasons) > 0).orderBy(order_by).limit(10)


def sync_summary(results: DataFrame) -> DataFrame:
    """One row over per-table results: rows, tables that succeeded and that failed."""
    failed = F.col("status") == "error"
    return results.agg(
        F.count("*").alias("tables"),
        F.count_if(~failed).alias("tables_synced"),
        F.count_if(failed).alias("tables_failed"),
        F.coalesce(F.sum("n_rows"), F.lit(0)).cast("long").alias("total_rows"),
    ).withColumn("status", outcome_status(F.col("tables_synced"), F.col("tables_failed")))


def union_all(frames: Iterable[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)
