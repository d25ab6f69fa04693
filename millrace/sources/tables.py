"""Table sources: queries, whole tables, JDBC, schema discovery, inventory."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.cleanse import bit_to_boolean
from millrace.functions.sqltypes import field_sql_type, parse_sql_type
from millrace.operators.mapping import quoted
from millrace.operators.quality import union_all


def checked_query(query: str) -> str:
    """The query, if it reads: not empty and starting with SELECT or WITH."""
    text = (query or "").strip().rstrip(";")
    if not text:
        raise ValueError("the source query is empty")
    if not re.match(r"(?i)(select|with)\b", text):
        raise ValueError("the source query must start with SELECT or WITH")
    return text


def scan_query(spark: SparkSession, query: str, jdbc: Mapping[str, str] | None = None) -> DataFrame:
    """Rows of a query, run by Spark or pushed whole to a database."""
    text = checked_query(query)
    if jdbc is None:
        return spark.sql(text)
    return spark.read.format("jdbc").options(**jdbc).option("query", text).load()


def jdbc_table(
    spark: SparkSession,
    jdbc: Mapping[str, str],
    table: str,
    *,
    partition_column: str | None = None,
    bounds: tuple[object, object] | None = None,
    partitions: int = 1,
) -> DataFrame:
    """A database table, read in parallel ranges of ``partition_column``.

    Without a partition column one task reads everything, so name one for any
    table that is not small.
    """
    reader = spark.read.format("jdbc").options(**jdbc).option("dbtable", table)
    if partition_column:
        if bounds is None:
            raise ValueError("bounds are needed to split the read")
        reader = reader.options(
            partitionColumn=partition_column,
            lowerBound=str(bounds[0]),
            upperBound=str(bounds[1]),
            numPartitions=str(partitions),
        )
    return reader.load()


def typed_values(df: DataFrame, declared: T.StructType) -> DataFrame:
    """Bring raw database values to their declared types.

    BIT numbers or bytes become booleans, identifiers and times become text;
    other columns are cast. Nulls stay null.
    """
    fields = {f.name: f for f in declared}

    def value(f: T.StructField) -> Column:
        raw = F.col(quoted(f.name))
        want = fields.get(f.name)
        if want is None or want.dataType == f.dataType:
            return raw
        if isinstance(want.dataType, T.BooleanType):
            return bit_to_boolean(raw, f.dataType).alias(f.name)
        if parse_sql_type(field_sql_type(want)).base == "TIME" and isinstance(
            f.dataType, (T.TimestampType, T.TimestampNTZType)
        ):
            return F.date_format(raw, "HH:mm:ss").alias(f.name)
        return raw.cast(want.dataType).alias(f.name)

    return df.select(*[value(f) for f in df.schema])


def scan_table(spark: SparkSession, table: str, declared: T.StructType | None = None) -> DataFrame:
    df = spark.table(table)
    return typed_values(df, declared) if declared else df


def split_existing(
    spark: SparkSession, tables: Sequence[str], database: str | None = None
) -> tuple[list[str], list[str]]:
    """Requested tables that exist, and those that do not."""
    full = {t: f"{database}.{t}" if database else t for t in tables}
    existing = [t for t in tables if spark.catalog.tableExists(full[t])]
    return existing, [t for t in tables if t not in existing]


def require_tables(
    spark: SparkSession, tables: Sequence[str], database: str | None = None
) -> list[str]:
    existing, missing = split_existing(spark, tables, database)
    if missing:
        raise ValueError(f"tables not found: {missing}")
    return existing


def column_catalogue(spark: SparkSession, tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per table and column: name, position, type, nullability."""
    rows = [
        (name, f.name, i, f.dataType.simpleString(), field_sql_type(f), f.nullable)
        for name, df in tables.items()
        for i, f in enumerate(df.schema, 1)
    ]
    return spark.createDataFrame(
        rows,
        "table_name string, column_name string, position int, data_type string, "
        "sql_type string, is_nullable boolean",
    )


def inventory(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per table: row count, number of columns and the column list."""

    def described(name: str, df: DataFrame) -> DataFrame:
        columns = [
            F.struct(
                F.lit(f.name).alias("name"),
                F.lit(f.dataType.simpleString()).alias("type"),
                F.lit(f.nullable).alias("nullable"),
            )
            for f in df.schema
        ]
        return df.agg(F.count("*").alias("n_rows")).select(
            F.lit(name).alias("table_name"),
            "n_rows",
            F.lit(len(columns)).alias("n_columns"),
            F.array(*columns).alias("columns"),
        )

    return union_all(described(name, df) for name, df in tables.items())


def database_inventory(spark: SparkSession, database: str) -> DataFrame:
    """Inventory of all tables of a database."""
    names = [t.name for t in spark.catalog.listTables(database) if not t.isTemporary]
    return inventory({n: spark.table(f"{database}.{n}") for n in sorted(names)})
