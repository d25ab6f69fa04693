"""SQL type names, their Spark types, and the compatibility rule between them."""

from __future__ import annotations

import re
import warnings
from dataclasses import dataclass

from pyspark.sql import types as T

# SQL type names per Spark type, for both source dialects.
_SIMPLE = {
    "int": T.IntegerType(),
    "integer": T.IntegerType(),
    "mediumint": T.IntegerType(),
    "year": T.IntegerType(),
    "bigint": T.LongType(),
    "smallint": T.ShortType(),
    "tinyint": T.ShortType(),
    "bit": T.BooleanType(),
    "boolean": T.BooleanType(),
    "bool": T.BooleanType(),
    "float": T.DoubleType(),
    "double": T.DoubleType(),
    "double precision": T.DoubleType(),
    "real": T.FloatType(),
    "money": T.DecimalType(19, 4),
    "smallmoney": T.DecimalType(10, 4),
    "datetime": T.TimestampNTZType(),
    "datetime2": T.TimestampNTZType(),
    "smalldatetime": T.TimestampNTZType(),
    "timestamp": T.TimestampNTZType(),
    "datetimeoffset": T.TimestampType(),
    "timestamp with time zone": T.TimestampType(),
    "date": T.DateType(),
    "time": T.StringType(),
    "uniqueidentifier": T.StringType(),
    "uuid": T.StringType(),
    "json": T.StringType(),
    "jsonb": T.StringType(),
    "xml": T.StringType(),
    "enum": T.StringType(),
    "set": T.StringType(),
    "text": T.StringType(),
    "ntext": T.StringType(),
    "tinytext": T.StringType(),
    "mediumtext": T.StringType(),
    "longtext": T.StringType(),
    "binary": T.BinaryType(),
    "varbinary": T.BinaryType(),
    "image": T.BinaryType(),
    "blob": T.BinaryType(),
    "tinyblob": T.BinaryType(),
    "mediumblob": T.BinaryType(),
    "longblob": T.BinaryType(),
    "bytea": T.BinaryType(),
}
_SIZED_TEXT = {"char", "nchar", "varchar", "nvarchar", "character varying"}
_DECIMAL = {"decimal", "numeric"}

# Type families within which a value can be stored.
NUMERIC_FAMILY = {
    "TINYINT", "SMALLINT", "INT", "INTEGER", "BIGINT",
    "FLOAT", "REAL", "DOUBLE", "NUMERIC", "DECIMAL", "MONEY", "SMALLMONEY",
}
TEMPORAL_FAMILY = {"DATETIME", "DATETIME2", "SMALLDATETIME", "DATE", "TIME"}
VARIABLE_TEXT = {"VARCHAR", "NVARCHAR"}
SIZED_TEXT = {"NVARCHAR", "VARCHAR", "NCHAR", "CHAR"}

WIDEST_DECIMAL = T.DecimalType(38, 10)


@dataclass(frozen=True)
class SqlType:
    """A parsed type: upper-case base name and its arguments; ``(-1,)`` means MAX."""

    base: str
    args: tuple[int, ...] = ()

    @property
    def unbounded(self) -> bool:
        return self.args[:1] == (-1,)

    def __str__(self) -> str:
        if not self.args:
            return self.base
        inner = ",".join("MAX" if a == -1 else str(a) for a in self.args)
        return f"{self.base}({inner})"


def parse_sql_type(text: str) -> SqlType:
    """``'nvarchar(max)'`` -> ``SqlType('NVARCHAR', (-1,))``."""
    match = re.fullmatch(r"\s*([A-Za-z][A-Za-z0-9_ ]*?)\s*(?:\(([^)]*)\))?\s*", text)
    if not match:
        raise ValueError(f"not a SQL type: {text!r}")
    base, inner = match.group(1).upper(), match.group(2)
    if inner is None or not inner.strip():
        return SqlType(base)
    args = tuple(-1 if a.strip().upper() == "MAX" else int(a) for a in inner.split(","))
    return SqlType(base, args)


def sql_type_text(
    name: str,
    length: int | None = None,
    precision: int | None = None,
    scale: int | None = None,
) -> str:
    """Full type text from catalogue parts; length -1 means MAX."""
    base = name.strip().upper()
    if base in SIZED_TEXT | {"BINARY", "VARBINARY"} and length is not None:
        return str(SqlType(base, (length,)))
    if base in {"DECIMAL", "NUMERIC"} and precision is not None:
        return str(SqlType(base, (precision, scale or 0)))
    return base


def sql_type_to_spark(
    name: str,
    length: int | None = None,
    precision: int | None = None,
    scale: int | None = None,
) -> T.DataType:
    """Spark type of a SQL type; an unknown name becomes a string, with a warning."""
    parsed = parse_sql_type(name)
    base = parsed.base.lower()
    if base in _SIZED_TEXT:
        return T.StringType()
    if base in _DECIMAL:
        args = parsed.args or (() if precision is None else (precision, scale or 0))
        return T.DecimalType(*args) if args else WIDEST_DECIMAL
    if base in _SIMPLE:
        return _SIMPLE[base]
    warnings.warn(f"unknown SQL type {name!r} is read as string", stacklevel=2)
    return T.StringType()


def column(
    name: str,
    sql_type: str,
    nullable: bool = True,
    *,
    has_default: bool = False,
    identity: bool = False,
) -> T.StructField:
    """A schema field that remembers its SQL type, length bound, default and identity."""
    parsed = parse_sql_type(sql_type)
    meta: dict[str, object] = {"sql_type": str(parsed)}
    if parsed.base in SIZED_TEXT and parsed.args and not parsed.unbounded:
        meta["max_length"] = parsed.args[0]
    if has_default:
        meta["has_default"] = True
    if identity:
        meta["identity"] = True
    return T.StructField(name, sql_type_to_spark(sql_type), nullable, meta)


def wide_sql_type(dtype: T.DataType) -> str:
    """The widest SQL type for a Spark type, so that no later row can overflow it."""
    if isinstance(dtype, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return "BIGINT"
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        return "FLOAT"
    if isinstance(dtype, T.DecimalType):
        return "DECIMAL(38,10)"
    if isinstance(dtype, T.BooleanType):
        return "BIT"
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return "DATETIME2"
    if isinstance(dtype, T.DateType):
        return "DATE"
    if isinstance(dtype, T.BinaryType):
        return "VARBINARY(MAX)"
    if isinstance(dtype, (T.DayTimeIntervalType, T.YearMonthIntervalType)):
        return "NVARCHAR(100)"
    return "NVARCHAR(MAX)"


def field_sql_type(field: T.StructField) -> str:
    """The declared SQL type of a field, else the wide one for its Spark type."""
    return (field.metadata or {}).get("sql_type") or wide_sql_type(field.dataType)


def types_compatible(existing: str, new: str) -> bool:
    """Can values of type ``new`` be stored in a column of type ``existing``?"""
    have, want = parse_sql_type(existing), parse_sql_type(new)
    if have.base == want.base:
        if have.base not in SIZED_TEXT or have.unbounded or want.unbounded:
            return True
        return (have.args or (0,))[0] >= (want.args or (0,))[0]
    pair = {have.base, want.base}
    return pair <= NUMERIC_FAMILY or pair <= TEMPORAL_FAMILY or pair <= VARIABLE_TEXT


def sized_text_type(max_length: int | None) -> str:
    """Room for 50 more characters, at least 255; beyond 4000 unbounded."""
    size = max((max_length or 0) + 50, 255)
    return "NVARCHAR(MAX)" if size > 4000 else f"NVARCHAR({size})"
