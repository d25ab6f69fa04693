"""Schema contracts: infer, compare, validate, conform and coerce."""

from __future__ import annotations

import warnings
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions import cleanse
from millrace.functions.hashing import SYNC_CHECKSUM, SYNC_COLUMNS
from millrace.functions.sqltypes import (
    column,
    field_sql_type,
    sized_text_type,
    types_compatible,
    wide_sql_type,
)
from millrace.operators.mapping import quoted

REJECT_REASONS = "_reject_reasons"


def data_fields(schema: T.StructType) -> dict[str, T.StructField]:
    """Fields by name, without the sync columns."""
    return {f.name: f for f in schema if f.name not in SYNC_COLUMNS}


def widen(schema: T.StructType) -> T.StructType:
    """Integers to long, floats to double, everything nullable; decimals stay."""

    def wide(dtype: T.DataType) -> T.DataType:
        if isinstance(dtype, (T.ByteType, T.ShortType, T.IntegerType)):
            return T.LongType()
        if isinstance(dtype, T.FloatType):
            return T.DoubleType()
        return dtype

    return T.StructType([T.StructField(f.name, wide(f.dataType), True, f.metadata) for f in schema])


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row with the number of nulls per column, from one pass."""
    return df.agg(*[F.count_if(F.col(quoted(c)).isNull()).alias(c) for c in columns])


def string_lengths(df: DataFrame) -> DataFrame:
    """One row with the longest text per string column, from one pass."""
    names = [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]
    return df.agg(*[F.max(F.length(quoted(c))).alias(c) for c in names])


def infer_schema(
    df: DataFrame, *, force_nullable: bool = True, sized: bool = False
) -> T.StructType:
    """SQL schema of a frame.

    By default every column gets its widest type and is nullable, which needs no
    data. ``force_nullable=False`` looks for nulls and ``sized=True`` for string
    lengths; the two share one aggregation.
    """
    strings = [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]
    measures: list[Column] = []
    if sized:
        measures += [F.max(F.length(quoted(c))).alias(f"len:{c}") for c in strings]
    if not force_nullable:
        measures += [
            F.max(F.col(quoted(c)).isNull()).alias(f"null:{c}") for c in df.columns
        ]
    seen = df.agg(*measures).first().asDict() if measures else {}
    fields = []
    for f in df.schema:
        sized_text = sized and f.name in strings
        sql_type = sized_text_type(seen.get(f"len:{f.name}")) if sized_text else wide_sql_type(
            f.dataType
        )
        fields.append(column(f.name, sql_type, force_nullable or bool(seen[f"null:{f.name}"])))
    return T.StructType(fields)


@dataclass
class SchemaReport:
    missing_columns: list[str] = field(default_factory=list)
    extra_columns: list[str] = field(default_factory=list)
    type_mismatches: list[tuple[str, str, str]] = field(default_factory=list)
    has_checksum_column: bool = True
    critical_missing: list[str] = field(default_factory=list)
    null_violations: dict[str, int] = field(default_factory=dict)
    issues: list[str] = field(default_factory=list)
    is_valid: bool = True


def _mismatches(
    have: dict[str, T.StructField], want: dict[str, T.StructField]
) -> list[tuple[str, str, str]]:
    found = []
    for name in have:
        if name in want:
            a, b = field_sql_type(have[name]), field_sql_type(want[name])
            if not types_compatible(a, b):
                found.append((name, a, b))
    return found


def _mismatch_text(found: list[tuple[str, str, str]]) -> str:
    return "type mismatches: " + ", ".join(f"{n} (has {a}, gets {b})" for n, a, b in found)


def compare_schema(existing: T.StructType, expected: T.StructType) -> SchemaReport:
    """Is the existing table fit for the expected columns and for checksum sync?"""
    have, want = data_fields(existing), data_fields(expected)
    report = SchemaReport(
        missing_columns=[n for n in want if n not in have],
        extra_columns=[n for n in have if n not in want],
        type_mismatches=_mismatches(have, want),
        has_checksum_column=SYNC_CHECKSUM in existing.names,
    )
    if report.missing_columns:
        report.issues.append(f"missing columns: {', '.join(report.missing_columns)}")
    if report.extra_columns:
        report.issues.append(f"extra columns, ignored: {', '.join(report.extra_columns)}")
    if report.type_mismatches:
        report.issues.append(_mismatch_text(report.type_mismatches))
    if not report.has_checksum_column:
        report.issues.append(f"no {SYNC_CHECKSUM} column")
    report.is_valid = not (report.missing_columns or report.type_mismatches) and (
        report.has_checksum_column
    )
    return report


def validate_frame(df: DataFrame, existing: T.StructType) -> SchemaReport:
    """Can this frame be inserted into the existing table? All issues at once.

    Types and names are compared on the driver; the null counts of all NOT NULL
    columns come from one aggregation.
    """
    have, want = data_fields(existing), data_fields(df.schema)
    report = SchemaReport(
        missing_columns=[n for n in have if n not in want],
        extra_columns=[n for n in want if n not in have],
        type_mismatches=_mismatches(have, want),
        has_checksum_column=SYNC_CHECKSUM in existing.names,
    )
    report.critical_missing = [n for n in report.missing_columns if not have[n].nullable]
    required = [n for n in have if n in want and not have[n].nullable]
    if required:
        counts = null_counts(df, required).first().asDict()
        report.null_violations = {n: c for n, c in counts.items() if c}
    if report.critical_missing:
        report.issues.append(f"required columns missing: {', '.join(report.critical_missing)}")
    if report.extra_columns:
        report.issues.append(f"extra columns, ignored: {', '.join(report.extra_columns)}")
    if report.type_mismatches:
        report.issues.append(_mismatch_text(report.type_mismatches))
    report.issues += [f"{n} is NOT NULL but has {c} nulls" for n, c in report.null_violations.items()]
    report.is_valid = not (
        report.critical_missing or report.type_mismatches or report.null_violations
    )
    return report


def _generated(f: T.StructField) -> bool:
    meta = f.metadata or {}
    return bool(meta.get("identity") or meta.get("has_default"))


def drop_generated(
    df: DataFrame, target: T.StructType, mapped: Sequence[str] = ()
) -> DataFrame:
    """Leave out columns the target fills itself, unless they were mapped on purpose."""
    return df.drop(*[f.name for f in target if _generated(f) and f.name not in mapped])


def conform(df: DataFrame, target: T.StructType, *, on_extra: str = "fail") -> DataFrame:
    """Bring the columns into the target's set and order, without casting values.

    A missing nullable column becomes null; a missing generated or defaulted one
    is left out; a missing NOT NULL column is an error. Columns unknown to the
    target are an error, or dropped with a warning (``on_extra='drop'``).
    """
    fields = data_fields(target)
    extra = [c for c in df.columns if c not in fields and c not in SYNC_COLUMNS]
    if extra and on_extra == "fail":
        raise ValueError(f"columns not in the target: {extra}")
    if extra:
        warnings.warn(f"columns not in the target are ignored: {extra}", stacklevel=2)
    selected = []
    for name, f in fields.items():
        if name in df.columns:
            selected.append(F.col(quoted(name)))
        elif _generated(f):
            continue
        elif f.nullable:
            selected.append(F.lit(None).cast(f.dataType).alias(name))
        else:
            raise ValueError(f"column {name!r} is NOT NULL, has no default and is not in the data")
    return df.select(*selected)


def coerced(value: Column, f: T.StructField) -> Column:
    """A value read as the field's type; null where it cannot be read."""
    dtype = f.dataType
    if isinstance(dtype, T.StringType):
        return cleanse.clipped(value, (f.metadata or {}).get("max_length"))
    if isinstance(dtype, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return cleanse.to_integer(value, dtype)
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        return cleanse.to_number(value).cast(dtype)
    if isinstance(dtype, T.DecimalType):
        return value.try_cast(dtype)
    if isinstance(dtype, T.BooleanType):
        return cleanse.flag_to_boolean(value)
    if isinstance(dtype, T.DateType):
        return cleanse.to_date(value)
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return cleanse.to_datetime(value).cast(dtype)
    return value.try_cast(dtype)


def _fits_as_is(dtype: T.DataType, want: T.StructField) -> bool:
    """Typed values need no reading; only long texts and infinite numbers do."""
    if isinstance(dtype, T.StringType):
        return isinstance(want.dataType, T.StringType) and "max_length" not in want.metadata
    return dtype == want.dataType and not isinstance(dtype, (T.FloatType, T.DoubleType))


def coerce(df: DataFrame, target: T.StructType) -> DataFrame:
    """Cast every column to its target type and say per row why it is not acceptable.

    ``_reject_reasons`` lists the NOT NULL columns left without a value, and the
    integer columns that held fractional text. It is empty for a good row.
    """
    fields = data_fields(target)
    values, reasons = [], []
    for f in df.schema:
        want = fields.get(f.name)
        if want is None:
            values.append(F.col(quoted(f.name)))
            continue
        raw = F.col(quoted(f.name))
        value = raw if _fits_as_is(f.dataType, want) else coerced(raw, want)
        values.append(value.alias(f.name))
        if not want.nullable:
            reasons.append(F.when(value.isNull(), F.lit(f"{f.name}: no usable value")))
        elif isinstance(want.dataType, T.IntegralType) and not isinstance(
            f.dataType, T.IntegralType
        ):
            number = cleanse.to_number(raw)
            reasons.append(
                F.when(number.isNotNull() & value.isNull(), F.lit(f"{f.name}: not an integer"))
            )
    listed = F.array_compact(F.array(*reasons)) if reasons else F.array().cast("array<string>")
    return df.select(*values, listed.alias(REJECT_REASONS))


def accepted(tagged: DataFrame) -> DataFrame:
    return tagged.where(F.size(REJECT_REASONS) == 0).drop(REJECT_REASONS)


def rejected(tagged: DataFrame) -> DataFrame:
    return tagged.where(F.size(REJECT_REASONS) > 0)


# Recommended column types of the reporting fact.
REPORTING_TYPES = {
    "customer_name": "NVARCHAR(200)",
    "item_code": "NVARCHAR(50)",
    "seller_name": "NVARCHAR(200)",
    "quantity": "DECIMAL(18,3)",
    "line_total": "DECIMAL(19,4)",
    "gross_profit": "DECIMAL(19,4)",
    "items_group_name": "NVARCHAR(255)",
    "posted_date": "DATE",
    "end_of_month_bucket": "DATE",
    "item_category": "NVARCHAR(255)",
    "year": "SMALLINT",
    "customer_group": "NVARCHAR(255)",
    "ipc": "NVARCHAR(100)",
    "dim": "NVARCHAR(400)",
    "record_type": "NVARCHAR(10)",
}


def narrow(df: DataFrame, types: dict[str, str] | None = None) -> DataFrame:
    """Cast to the narrow reporting types.

    Texts are not cut: a text beyond its bound is an error when the row is read,
    because silently shortening a key would merge distinct values.
    """
    types = REPORTING_TYPES if types is None else types
    values = []
    for name in df.columns:
        value = F.col(quoted(name))
        if name in types:
            f = column(name, types[name])
            bound = (f.metadata or {}).get("max_length")
            if bound:
                message = F.lit(f"{name} is longer than {bound} characters")
                value = F.when(
                    F.length(value) > bound, F.raise_error(message).cast("string")
                ).otherwise(value)
            else:
                value = value.cast(f.dataType)
        values.append(value.alias(name))
    return df.select(*values)
