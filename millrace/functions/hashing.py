"""Checksums, event hashes and personal-data hashes as column expressions."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

SYNC_CHECKSUM = "_sync_checksum"
SYNC_UPDATED_AT = "_sync_updated_at"
SYNC_CREATED_AT = "_sync_created_at"
SYNC_COLUMNS = (SYNC_CHECKSUM, SYNC_UPDATED_AT, SYNC_CREATED_AT)

HASH_ALGORITHMS = ("SHA256", "SHA1", "MD5")


def decimal_text(value: Column) -> Column:
    """Shortest decimal text of a double, as other engines print it.

    Plain digits for magnitudes in [1e-4, 1e16), else ``1.5e-07`` form. Spark's
    own cast switches to exponents much earlier (``1.23456789E7``). The digits are
    the JVM's; before Java 19 a value of 17 significant digits may get one more
    than the shortest text has.
    """
    value = value + F.lit(0.0)  # minus zero becomes zero
    text = value.cast("string")
    plain = F.regexp_replace(
        value.try_cast(T.DecimalType(38, 22)).cast("string"), r"(\.\d+?)0+$", "$1"
    )
    mantissa = F.regexp_replace(F.substring_index(text, "E", 1), r"\.0$", "")
    power = F.substring_index(text, "E", -1).try_cast("int")
    exponent = F.concat(
        F.when(power < 0, "e-").otherwise("e+"),
        F.lpad(F.abs(power).cast("string"), 2, "0"),
    )
    size = F.abs(value)
    return F.when(
        F.contains(text, F.lit("E")),
        F.when((size >= 1e-4) & (size < 1e16), plain).otherwise(F.concat(mantissa, exponent)),
    ).otherwise(text)


def iso_text(value: Column) -> Column:
    """``2024-01-31T10:00:00``, with microseconds only where they are not zero."""
    text = value.cast("string")
    fraction = F.when(F.length(text) > 19, F.rpad(F.substring(text, 20, 7), 7, "0"))
    return F.concat(
        F.substring(text, 1, 10), F.lit("T"), F.substring(text, 12, 8), F.coalesce(fraction, F.lit(""))
    )


def _bits_text(value: Column) -> Column:
    """A number for a value of at most eight bytes, as text.

    xxHash64 of a single such value is a bijection of its bits (every step of it
    can be undone), so different values get different numbers, without the cost
    of formatting a double or a time.
    """
    return F.when(value.isNotNull(), F.xxhash64(value)).cast("string")


def _holds_map(dtype: T.DataType) -> bool:
    if isinstance(dtype, T.StructType):
        return any(_holds_map(f.dataType) for f in dtype)
    return isinstance(dtype, T.MapType) or (
        isinstance(dtype, T.ArrayType) and _holds_map(dtype.elementType)
    )


def _in_key_order(value: Column, dtype: T.DataType) -> Column:
    """Maps, at any depth, as entries sorted by key: their order has no meaning."""
    if not _holds_map(dtype):
        return value
    if isinstance(dtype, T.ArrayType):
        return F.transform(value, lambda x: _in_key_order(x, dtype.elementType))
    if isinstance(dtype, T.StructType):
        inner = F.struct(
            *[_in_key_order(value.getField(f.name), f.dataType).alias(f.name) for f in dtype]
        )
        return F.when(value.isNotNull(), inner)
    keys = F.array_sort(F.map_keys(value))
    return F.transform(
        keys,
        lambda k: F.struct(
            k.alias("key"), _in_key_order(F.element_at(value, k), dtype.valueType).alias("value")
        ),
    )


def canonical_text(value: Column, dtype: T.DataType, *, portable: bool = False) -> Column:
    """One text per value, decided by the declared type; null stays null.

    ``portable`` gives texts other engines print the same way. The default
    takes the cheapest text that still differs for different values.
    """
    if isinstance(dtype, T.StringType):
        return value
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        return decimal_text(value.cast("double")) if portable else _bits_text(value)
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return iso_text(value) if portable else _bits_text(value)
    if isinstance(dtype, T.BinaryType):
        return F.lower(F.hex(value))
    if isinstance(dtype, (T.ArrayType, T.StructType, T.MapType)):
        return F.to_json(_in_key_order(value, dtype), {"ignoreNullFields": "false"})
    return value.cast("string")


_FREE_TEXT = (T.StringType, T.ArrayType, T.StructType, T.MapType)


def _marked_text(value: Column, dtype: T.DataType) -> Column:
    text = canonical_text(value, dtype)
    if isinstance(dtype, _FREE_TEXT):
        return F.concat(F.length(text).cast("string"), F.lit(":"), text)
    return text


def row_checksum(
    schema: T.StructType,
    columns: Sequence[str] | None = None,
    *,
    legacy: bool = False,
    on_missing: str = "fail",
) -> Column:
    """SHA-256 over the named columns (default: all but the sync columns).

    Values are joined by ``;``, null as ``~``; free text carries its length in
    front and no other text contains a ``;``, so two rows get one digest only if
    all their values are equal. ``legacy`` joins portable texts by ``|`` with null
    as an empty text, which is not injective.
    ``on_missing='null'`` gives a null digest for an unknown column.
    """
    names = list(columns) if columns else [f.name for f in schema if f.name not in SYNC_COLUMNS]
    missing = [n for n in names if n not in schema.names]
    if missing:
        if on_missing == "null":
            return F.lit(None).cast("string")
        raise ValueError(f"checksum columns not found: {missing}")
    if legacy:
        texts = [canonical_text(F.col(f"`{n}`"), schema[n].dataType, portable=True) for n in names]
        joined = F.concat_ws("|", *[F.coalesce(t, F.lit("")) for t in texts])
    else:
        marked = [_marked_text(F.col(f"`{n}`"), schema[n].dataType) for n in names]
        joined = F.concat_ws(";", *[F.coalesce(t, F.lit("~")) for t in marked])
    return F.sha2(joined, 256)


def event_hash(event_type: Column, event_data: Column) -> Column:
    """SHA-256 of ``type:json``; the JSON text is key-sorted at every level."""
    return hash_of_canonical(event_type, canonical_json(event_data))


def hash_of_canonical(event_type: Column, canonical: Column) -> Column:
    return F.sha2(F.concat(event_type, F.lit(":"), canonical), 256)


def canonical_json(text: Column) -> Column:
    """Compact, key-sorted JSON text; null where the text is not JSON."""
    return F.to_json(F.try_parse_json(text))


def pii_normal_form(value: Column, dtype: T.DataType) -> Column:
    """Text that is hashed: null as '', trimmed of any white space, lower case."""
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType, T.BinaryType)):
        text = canonical_text(value, dtype, portable=True)
    else:
        text = canonical_text(value, dtype, portable=True)
        text = F.lower(F.regexp_replace(text, r"(?U)^\s+|\s+$", ""))
    return F.coalesce(text, F.lit(""))


def one_way_hash(text: Column, algorithm: str = "SHA256") -> Column:
    """Hex digest by SHA256, SHA1 or MD5."""
    name = algorithm.upper()
    if name not in HASH_ALGORITHMS:
        raise ValueError(f"unsupported hash algorithm: {algorithm}")
    if name == "SHA256":
        return F.sha2(text, 256)
    return F.sha1(text) if name == "SHA1" else F.md5(text)


def composite_id(*parts: Column) -> Column:
    """``a|b|c``; null as soon as one part is null."""
    filled: Iterable[Column] = [p.isNotNull() for p in parts]
    present = None
    for flag in filled:
        present = flag if present is None else present & flag
    return F.when(present, F.concat_ws("|", *parts))
