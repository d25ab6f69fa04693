"""Staging layer: typed, trimmed current rows of dimensions and facts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.cleanse import dotted_date, flag_to_boolean, month_end, trimmed_or_null
from millrace.operators.mapping import quoted
from millrace.operators.snapshot import VALID_TO, VERSION_COLUMNS

# Flag columns of the customer and product dimensions.
CUSTOMER_FLAGS = (
    "is_inactive", "is_deleted", "is_active", "ic_synchronize", "edi_active", "frakttillegg",
    "fakturagebyr", "feature_7", "feature_1",
)
PRODUCT_FLAGS = (
    "feature_1", "additional_id", "ply_rating", "ic_synchronize", "feature_5", "is_active",
    "is_sales_item", "feature_22", "feature_6", "feature_7", "no_discounts",
)


def stage_dimension(
    snapshot: DataFrame,
    *,
    flags: Sequence[str] = (),
    trimmed: Sequence[str] = (),
    required: Sequence[str] = (),
) -> DataFrame:
    """Current versions with flags as booleans and trimmed texts.

    Rows whose required column is empty or null are left out.
    """
    current = snapshot
    if VALID_TO in snapshot.columns:
        current = snapshot.where(F.col(VALID_TO).isNull()).drop(*VERSION_COLUMNS)

    def value(name: str) -> Column:
        column = F.col(quoted(name))
        if name in flags:
            return flag_to_boolean(column).alias(name)
        if name in trimmed:
            return trimmed_or_null(column).alias(name)
        return column

    staged = current.select(*[value(c) for c in current.columns])
    for name in required:
        staged = staged.where(F.length(F.trim(F.col(quoted(name)).cast("string"))) > 0)
    return staged


def stage_fact(raw: DataFrame, date_column: str) -> DataFrame:
    """Dotted date text to a date, plus ``year`` and ``eom_bucket``."""
    dated = raw.withColumn(date_column, dotted_date(F.col(quoted(date_column))))
    day = F.col(quoted(date_column))
    return dated.withColumn("year", F.year(day)).withColumn("eom_bucket", month_end(day))


def stage_projection(
    raw: DataFrame,
    key: str,
    casts: Mapping[str, str],
    *,
    trimmed: Sequence[str] = (),
    loaded_at: Column | None = None,
) -> DataFrame:
    """Cast the named columns, blank texts to null, rows without a key left out."""
    rows = raw.where(F.col(quoted(key)).isNotNull())
    values = []
    for name, sql_type in casts.items():
        column = F.col(quoted(name))
        if name in trimmed:
            column = trimmed_or_null(column)
        values.append(column.cast(sql_type).alias(name))
    stamp = loaded_at if loaded_at is not None else F.current_timestamp()
    return rows.select(*values, stamp.alias("loaded_at"))
