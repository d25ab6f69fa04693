"""Cleansing and coercion expressions. A value that cannot be read becomes null."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Error texts a spreadsheet leaves in a cell.
SHEET_ERRORS = ("#N/A", "#VALUE!", "#REF!", "#DIV/0!", "#NAME?", "#NULL!", "#NUM!")

TRUE_TOKENS = ("y", "yes", "true", "1", "t")
FALSE_TOKENS = ("n", "no", "false", "0", "f")


def drop_sheet_errors(value: Column) -> Column:
    """Spreadsheet error texts become null."""
    return F.when(~value.isin(*SHEET_ERRORS), value)


def trimmed_or_null(value: Column) -> Column:
    """``NULLIF(TRIM(x), '')``."""
    return F.nullif(F.trim(value), F.lit(""))


def flag_to_boolean(
    value: Column,
    true_tokens: Sequence[str] = TRUE_TOKENS,
    false_tokens: Sequence[str] = FALSE_TOKENS,
) -> Column:
    """Flag text to boolean by token list; anything else, and null, stays null."""
    token = F.lower(F.trim(value.cast("string")))
    return F.when(token.isin(*true_tokens), True).when(token.isin(*false_tokens), False)


def bit_to_boolean(value: Column, dtype: T.DataType) -> Column:
    """BIT as number or as bytes: true if any bit is set; null stays null."""
    if isinstance(dtype, T.BinaryType):
        return F.hex(value).rlike("[1-9A-F]")
    return value.cast("int") != 0


def dotted_date(value: Column) -> Column:
    """``dd.MM.yy`` text to a date in 2000-2099; unreadable text becomes null."""
    return F.try_to_date(value, "dd.MM.yy")


def year_of(value: Column) -> Column:
    return F.year(value)


def month_end(value: Column) -> Column:
    """Last day of the month."""
    return F.last_day(value)


def iso_timestamp(value: Column) -> Column:
    """ISO text with zone (``...Z``) to a timestamp."""
    return F.try_to_timestamp(value)


def json_text(value: Column, path: str) -> Column:
    """Text found at a JSON path, as ``->>`` gives it."""
    return F.get_json_object(value, path if path.startswith("$") else f"$.{path}")


def is_json(value: Column) -> Column:
    return F.try_parse_json(value).isNotNull()


def to_number(value: Column) -> Column:
    """Double; unreadable, NaN and infinite values become null."""
    number = value.try_cast("double")
    finite = ~F.isnan(number) & (F.abs(number) != float("inf"))
    return F.when(finite, number)


def to_integer(value: Column, dtype: T.DataType | None = None) -> Column:
    """Integer only where the value is integral (``12.0``) and in range, else null."""
    exact = value.try_cast(T.DecimalType(38, 18))
    return F.when(exact == F.floor(exact), exact.try_cast(dtype or T.LongType()))


def to_decimal(value: Column, precision: int, scale: int) -> Column:
    return value.try_cast(T.DecimalType(precision, scale))


def to_datetime(value: Column) -> Column:
    return F.try_to_timestamp(value.cast("string"))


def to_date(value: Column) -> Column:
    """A date from date or date-time text, or from a timestamp."""
    return F.coalesce(value.try_cast("date"), F.try_to_timestamp(value.cast("string")).cast("date"))


def clipped(value: Column, max_length: int | None) -> Column:
    text = value.cast("string")
    return F.substring(text, 1, max_length) if max_length else text


def within_last_days(value: Column, as_of: Column, days: int) -> Column:
    """True for values not older than ``days`` before ``as_of``."""
    return value >= F.date_sub(as_of, days)


def month_of(value: Column) -> Column:
    return F.date_trunc("month", value)


def year_start(value: Column) -> Column:
    return F.date_trunc("year", value)


def delivery_outcome(
    status_code: Column, reason: Column, body: Column, connection_error: Column
) -> Column:
    """Struct ``status, status_code, data, error`` of one delivery attempt.

    2xx is a success; any other code is ``HTTP code: reason``; no code at all is
    a connection error. A body that is not JSON is wrapped as ``{"text": body}``.
    """
    success = status_code.between(200, 299)
    data = F.when(
        status_code.isNotNull(),
        F.when(is_json(body), body).otherwise(F.to_json(F.struct(body.alias("text")))),
    )
    error = F.when(status_code.isNull(), F.coalesce(connection_error, F.lit("Unknown error"))).when(
        ~success,
        F.concat(F.lit("HTTP "), status_code.cast("string"), F.lit(": "), reason),
    )
    return F.struct(
        F.when(success, "success").otherwise("error").alias("status"),
        status_code.alias("status_code"),
        data.alias("data"),
        error.alias("error"),
    )
