"""Types, hashes and cleansing expressions."""

from __future__ import annotations

import datetime as dt
import hashlib
import json
import warnings

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions import cleanse, hashing, sqltypes


@pytest.mark.parametrize(
    ("existing", "new", "fits"),
    [
        ("INT", "INT", True),
        ("BIGINT", "INT", True),
        ("INT", "SMALLINT", True),
        ("FLOAT", "REAL", True),
        ("NVARCHAR(200)", "NVARCHAR(100)", True),
        ("NVARCHAR(50)", "NVARCHAR(100)", False),
        ("NVARCHAR(MAX)", "NVARCHAR(1000)", True),
        ("NVARCHAR(1000)", "NVARCHAR(MAX)", True),
        ("DATETIME2", "DATETIME", True),
        ("DATETIME", "SMALLDATETIME", True),
        ("INT", "NVARCHAR(50)", False),
        ("DATETIME", "INT", False),
        ("BIT", "FLOAT", False),
        ("VARCHAR(10)", "NVARCHAR(99)", True),
    ],
)
def test_compatibility(existing, new, fits):
    assert sqltypes.types_compatible(existing, new) is fits


def test_types():
    assert sqltypes.sql_type_to_spark("decimal(10,3)") == T.DecimalType(10, 3)
    assert sqltypes.sql_type_to_spark("numeric") == T.DecimalType(38, 10)
    assert sqltypes.sql_type_to_spark("money") == T.DecimalType(19, 4)
    assert sqltypes.sql_type_to_spark("datetimeoffset") == T.TimestampType()
    assert sqltypes.sql_type_to_spark("datetime2(7)") == T.TimestampNTZType()
    assert sqltypes.sql_type_to_spark("varbinary(max)") == T.BinaryType()
    assert sqltypes.sql_type_text("nvarchar", -1) == "NVARCHAR(MAX)"
    assert sqltypes.sql_type_text("decimal", precision=18, scale=2) == "DECIMAL(18,2)"
    assert str(sqltypes.parse_sql_type(" nvarchar( max )")) == "NVARCHAR(MAX)"
    assert sqltypes.column("a", "NVARCHAR(20)").metadata["max_length"] == 20
    assert sqltypes.sized_text_type(3) == "NVARCHAR(255)"
    assert sqltypes.sized_text_type(300) == "NVARCHAR(350)"
    assert sqltypes.sized_text_type(4000) == "NVARCHAR(MAX)"
    with warnings.catch_warnings(record=True) as seen:
        warnings.simplefilter("always")
        assert sqltypes.sql_type_to_spark("geography") == T.StringType()
    assert seen
    with pytest.raises(ValueError):
        sqltypes.parse_sql_type("(3)")


@pytest.mark.parametrize(
    ("dtype", "sql_type"),
    [
        (T.LongType(), "BIGINT"),
        (T.IntegerType(), "BIGINT"),
        (T.DoubleType(), "FLOAT"),
        (T.BooleanType(), "BIT"),
        (T.TimestampType(), "DATETIME2"),
        (T.StringType(), "NVARCHAR(MAX)"),
        (T.DecimalType(5, 1), "DECIMAL(38,10)"),
        (T.DayTimeIntervalType(), "NVARCHAR(100)"),
    ],
)
def test_wide_types(dtype, sql_type):
    assert sqltypes.wide_sql_type(dtype) == sql_type


MIXED = "id long, name string, amount double, at timestamp"


def digest(spark, row, schema, columns=None, **options):
    df = spark.createDataFrame([row], schema)
    return df.select(hashing.row_checksum(df.schema, columns, **options)).first()[0]


def test_checksum_repeats_and_differs(spark):
    row = (1, "test", 100.5, dt.datetime(2024, 1, 1))
    first = digest(spark, row, MIXED)
    assert first == digest(spark, row, MIXED) and len(first) == 64
    assert digest(spark, (1, None, None, None), MIXED) is not None
    assert first != digest(spark, (1, "other", 100.5, dt.datetime(2024, 1, 1)), MIXED)
    people = "id long, name string, age int"
    a, b = (1, "x", 30), (1, "x", 31)
    assert digest(spark, a, people, ["id", "name"]) == digest(spark, b, people, ["id", "name"])
    assert digest(spark, a, people) != digest(spark, b, people)


def test_checksum_unknown_column(spark):
    with pytest.raises(ValueError, match="not found"):
        digest(spark, (1, "a"), "id long, name string", ["nope"])
    assert digest(spark, (1, "a"), "id long, name string", ["nope"], on_missing="null") is None


def test_legacy_checksum_text(spark):
    schema = "i int, f double, b boolean, s string, t timestamp, n string, x binary"
    row = (7, 12345678.9, True, "a|b", dt.datetime(2024, 1, 31, 10, 0, 0, 500), None, b"\x0f")
    text = "7|12345678.9|true|a|b|2024-01-31T10:00:00.000500||0f"
    assert digest(spark, row, schema, legacy=True) == hashlib.sha256(text.encode()).hexdigest()


def test_checksum_is_injective(spark):
    rows = [("a|b", "c"), ("a", "b|c"), ("a;1:b", "c"), ("a", "b"), (None, ""), ("", None), ("~", "")]
    df = spark.createDataFrame(rows, "p string, q string")
    assert df.select(hashing.row_checksum(df.schema)).distinct().count() == len(rows)
    values = [0.1, 0.2, 1e300, 5e-324, -1.0, 1.0, float("nan"), None]
    df = spark.createDataFrame([(v,) for v in values], "p double")
    assert df.select(hashing.row_checksum(df.schema)).distinct().count() == len(values)
    zeros = spark.createDataFrame([(0.0,), (-0.0,)], "p double")
    assert zeros.select(hashing.row_checksum(zeros.schema)).distinct().count() == 1


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.floats(min_value=-1e12, max_value=1e12).map(lambda x: round(x, 3)), min_size=5, max_size=80))
def test_decimal_text_is_plain(spark, values):
    df = spark.createDataFrame([(v, repr(v + 0.0)) for v in values if v], "v double, want string")
    wrong = df.where(hashing.decimal_text(F.col("v")) != F.col("want"))
    assert wrong.count() == 0


def test_event_hash_ignores_key_order(spark):
    df = spark.createDataFrame(
        [("t", '{"a": 1, "b": {"d": 2, "c": [1, 2]}}'), ("t", '{"b":{"c":[1,2],"d":2},"a":1}'),
         ("t", '{"a": 2}'), ("u", '{"a": 2}')],
        "k string, d string",
    )
    got = [r[0] for r in df.select(hashing.event_hash(F.col("k"), F.col("d"))).collect()]
    assert got[0] == got[1] and len(set(got)) == 3 and all(len(h) == 64 for h in got)
    plain = json.dumps({"a": 2}, separators=(",", ":"))
    assert got[2] == hashlib.sha256(f"t:{plain}".encode()).hexdigest()


def test_pii_normal_form(spark):
    df = spark.createDataFrame([("\t John ",), ("JOHN",), (None,), ("",)], "v string")
    got = [r[0] for r in df.select(hashing.pii_normal_form(F.col("v"), T.StringType())).collect()]
    assert got == ["john", "john", "", ""]
    with pytest.raises(ValueError):
        hashing.one_way_hash(F.lit("x"), "CRC")


def one(spark, expression, value, dtype="string"):
    return spark.createDataFrame([(value,)], f"v {dtype}").select(expression(F.col("v"))).first()[0]


@pytest.mark.parametrize(
    ("text", "number", "integer"),
    [("12", 12.0, 12), ("12.0", 12.0, 12), ("12.7", 12.7, None), ("1e3", 1000.0, 1000),
     ("abc", None, None), ("inf", None, None), ("NaN", None, None), (None, None, None),
     ("9007199254740993", 9007199254740992.0, 9007199254740993), ("1e30", 1e30, None)],
)
def test_numbers(spark, text, number, integer):
    assert one(spark, cleanse.to_number, text) == number
    assert one(spark, cleanse.to_integer, text) == integer


def test_dates_flags_and_bits(spark):
    assert one(spark, cleanse.dotted_date, "31.01.24") == dt.date(2024, 1, 31)
    assert one(spark, cleanse.dotted_date, "01.01.70") == dt.date(2070, 1, 1)
    assert one(spark, cleanse.dotted_date, "31.02.24") is None
    assert one(spark, cleanse.month_end, dt.date(2024, 2, 3), "date") == dt.date(2024, 2, 29)
    assert one(spark, cleanse.flag_to_boolean, " YES ") is True
    assert one(spark, cleanse.flag_to_boolean, "0") is False
    assert one(spark, cleanse.flag_to_boolean, "maybe") is None
    assert one(spark, cleanse.to_date, "2024-02-03 10:11:12") == dt.date(2024, 2, 3)
    assert one(spark, cleanse.to_date, "soon") is None
    assert one(spark, cleanse.drop_sheet_errors, "#DIV/0!") is None
    assert one(spark, cleanse.drop_sheet_errors, "fine") == "fine"
    for raw, want in [(b"\x00\x00", False), (b"\x00\x01", True), (None, None)]:
        got = one(spark, lambda c: cleanse.bit_to_boolean(c, T.BinaryType()), raw, "binary")
        assert got is want
    zoned = one(spark, lambda c: cleanse.iso_timestamp(c).cast("string"), "2031-02-28T23:59:01Z")
    assert zoned == "2031-02-28 23:59:01"


def test_delivery_outcome(spark):
    df = spark.createDataFrame(
        [(200, None, '{"a":1}', None), (404, "Not Found", "nope", None), (None, None, None, "refused")],
        "code int, reason string, body string, lost string",
    )
    got = df.select(
        cleanse.delivery_outcome(*[F.col(c) for c in df.columns]).alias("o")
    ).select("o.*").collect()
    assert [tuple(r) for r in got] == [
        ("success", 200, '{"a":1}', None),
        ("error", 404, '{"text":"nope"}', "HTTP 404: Not Found"),
        ("error", None, None, "refused"),
    ]


def test_composite_id(spark):
    df = spark.createDataFrame([("a", "b"), ("a", None)], "x string, y string")
    got = [r[0] for r in df.select(hashing.composite_id(F.col("x"), F.col("y"))).collect()]
    assert got == ["a|b", None]
