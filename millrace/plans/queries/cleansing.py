"""Mapping, cleansing, coercion and checksums of rows."""

from __future__ import annotations

import warnings

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions import cleanse
from millrace.functions.hashing import row_checksum
from millrace.functions.sqltypes import column
from millrace.operators import schema as contracts
from millrace.operators.mapping import (
    clean_column_names,
    map_columns,
    rename_columns,
    snake_case_columns,
)
from millrace.operators.quality import load_outcome
from millrace.operators.sheets import split_wide
from millrace.plans.load import cleansed
from millrace.plans.queries.registry import as_double, iso_date, iso_second, registered, table
from millrace.sources.streams import counts_by_stream, extract_records
from millrace.sources.tables import scan_query, typed_values


@registered(
    "mapping_projection",
    """
    SELECT c_custkey AS customer_code, c_name AS customer_name,
           CAST(NULL AS VARCHAR) AS customer_group
    FROM customer
    """,
)
def mapping_projection(spark: SparkSession, sf: str) -> DataFrame:
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        return map_columns(
            table(spark, sf, "customer"),
            {"c_custkey": "customer_code", "C_NAME": "customer_name", "c_group": "customer_group"},
        )


@registered(
    "strict_rename",
    """
    SELECT s_suppkey AS seller_id, s_name AS seller_name, s_nationkey, s_acctbal FROM supplier
    """,
)
def strict_rename(spark: SparkSession, sf: str) -> DataFrame:
    return rename_columns(
        table(spark, sf, "supplier"), {"s_suppkey": "seller_id", "s_name": "seller_name"}
    )


@registered(
    "error_token_cleanse",
    """
    SELECT p_partkey, CASE WHEN p_size >= 20 THEN CAST(p_size AS DOUBLE) END AS size_value,
           CASE WHEN p_type <> 'ECONOMY' THEN p_type END AS p_type
    FROM part
    """,
)
def error_token_cleanse(spark: SparkSession, sf: str) -> DataFrame:
    size = F.col("p_size")
    kind = F.col("p_type")
    raw = table(spark, sf, "part").select(
        "p_partkey",
        F.when(size < 10, "#N/A").when(size < 20, "#DIV/0!").otherwise(size.cast("string")).alias(
            "size_text"
        ),
        F.when(kind == "ECONOMY", "#REF!").otherwise(kind).alias("p_type"),
    )
    return cleansed(raw).select(
        "p_partkey", cleanse.to_number(F.col("size_text")).alias("size_value"), "p_type"
    )


_QUANTITY_TEXT_SQL = """
    SELECT l_orderkey, l_linenumber,
           CASE WHEN l_returnflag = 'A' THEN CAST(CAST(l_quantity AS INTEGER) AS VARCHAR)
                WHEN l_linestatus = 'O' THEN CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) || '.5'
                WHEN l_tax > 0.04 THEN CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) || '.0'
                ELSE 'n/a' END AS t
    FROM lineitem
"""


def _quantity_text(spark: SparkSession, sf: str) -> DataFrame:
    whole = F.col("l_quantity").cast("int").cast("string")
    return table(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.when(F.col("l_returnflag") == "A", whole)
        .when(F.col("l_linestatus") == "O", F.concat(whole, F.lit(".5")))
        .when(F.col("l_tax") > 0.04, F.concat(whole, F.lit(".0")))
        .otherwise("n/a")
        .alias("t"),
    )


@registered(
    "numeric_coercion",
    f"""
    WITH raw AS ({_QUANTITY_TEXT_SQL})
    SELECT l_orderkey, l_linenumber, TRY_CAST(t AS DOUBLE) AS number_value,
           CASE WHEN TRY_CAST(t AS DOUBLE) = floor(TRY_CAST(t AS DOUBLE))
                THEN CAST(TRY_CAST(t AS DOUBLE) AS BIGINT) END AS integer_value
    FROM raw
    """,
)
def numeric_coercion(spark: SparkSession, sf: str) -> DataFrame:
    return _quantity_text(spark, sf).select(
        "l_orderkey",
        "l_linenumber",
        cleanse.to_number(F.col("t")).alias("number_value"),
        cleanse.to_integer(F.col("t")).alias("integer_value"),
    )


@registered(
    "coerce_rejects",
    f"""
    WITH raw AS ({_QUANTITY_TEXT_SQL})
    SELECT CASE WHEN TRY_CAST(t AS DOUBLE) IS NULL
                  OR TRY_CAST(t AS DOUBLE) <> floor(TRY_CAST(t AS DOUBLE))
                THEN 'quantity: no usable value' ELSE '' END AS reasons,
           count(*) AS n_rows
    FROM raw GROUP BY ALL
    """,
)
def coerce_rejects(spark: SparkSession, sf: str) -> DataFrame:
    target = T.StructType(
        [
            column("l_orderkey", "BIGINT"),
            column("l_linenumber", "INT"),
            column("quantity", "INT", nullable=False),
        ]
    )
    tagged = contracts.coerce(
        _quantity_text(spark, sf).withColumnRenamed("t", "quantity"), target
    )
    return tagged.groupBy(F.array_join(contracts.REJECT_REASONS, "; ").alias("reasons")).agg(
        F.count("*").alias("n_rows")
    )


@registered(
    "load_outcome",
    f"""
    WITH raw AS ({_QUANTITY_TEXT_SQL}),
    judged AS (
        SELECT coalesce(TRY_CAST(t AS DOUBLE) = floor(TRY_CAST(t AS DOUBLE)), false) AS good FROM raw
    ),
    tally AS (SELECT count_if(good)::BIGINT AS g, count_if(NOT good)::BIGINT AS b FROM judged)
    SELECT g AS rows_written, b AS rows_rejected, round(b * 100 / (g + b), 1) AS error_rate,
           CASE WHEN b = 0 THEN 'success' WHEN g = 0 THEN 'error' ELSE 'partial' END AS status,
           b > g AS failed
    FROM tally
    """,
)
def load_outcome_query(spark: SparkSession, sf: str) -> DataFrame:
    target = T.StructType([column("t", "INT", nullable=False)])
    return load_outcome(contracts.coerce(_quantity_text(spark, sf).select("t"), target))


@registered(
    "coerce_values",
    """
    SELECT o_orderkey, substr(o_orderpriority, 1, 4) AS priority,
           CASE WHEN o_orderstatus = 'F' THEN NULL ELSE strftime(o_orderdate, '%Y-%m-%d') END
               AS ordered_on,
           CASE o_orderstatus WHEN 'O' THEN true WHEN 'P' THEN false END AS is_open,
           CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) AS total
    FROM orders
    """,
)
def coerce_values(spark: SparkSession, sf: str) -> DataFrame:
    status = F.col("o_orderstatus")
    raw = table(spark, sf, "orders").select(
        "o_orderkey",
        F.col("o_orderpriority").alias("priority"),
        F.when(status == "F", "unknown")
        .when(status == "O", iso_second("o_orderdate"))
        .otherwise(iso_date("o_orderdate"))
        .alias("ordered_on"),
        F.when(status == "O", "Yes").when(status == "P", "0").otherwise("-").alias("is_open"),
        F.col("o_totalprice").cast("decimal(18,2)").cast("string").alias("total"),
    )
    target = T.StructType(
        [
            column("o_orderkey", "BIGINT", nullable=False),
            column("priority", "NVARCHAR(4)"),
            column("ordered_on", "DATE"),
            column("is_open", "BIT"),
            column("total", "DECIMAL(18,2)"),
        ]
    )
    rows = contracts.accepted(contracts.coerce(contracts.conform(raw, target), target))
    return rows.withColumn("ordered_on", iso_date("ordered_on")).withColumn(
        "total", as_double("total")
    )


@registered(
    "typed_values",
    """
    SELECT p_partkey, CASE WHEN p_size < 40 THEN p_size > 25 END AS is_large,
           CAST(p_partkey AS VARCHAR) AS code, '09:' || lpad(CAST(p_size AS VARCHAR), 2, '0') || ':00'
               AS packed_at
    FROM part
    """,
)
def typed_values_query(spark: SparkSession, sf: str) -> DataFrame:
    """Raw database values: BIT as bytes, an identifier, a time with a date in front."""
    size = F.col("p_size")
    raw = table(spark, sf, "part").select(
        "p_partkey",
        F.when(size < 40, F.when(size > 25, F.unhex(F.lit("0001"))).otherwise(F.unhex(F.lit("0000"))))
        .alias("is_large"),
        F.col("p_partkey").alias("code"),
        F.concat(F.lit("2024-01-01 09:"), F.lpad(size.cast("string"), 2, "0"), F.lit(":00"))
        .cast("timestamp")
        .alias("packed_at"),
    )
    declared = T.StructType(
        [column("is_large", "BIT"), column("code", "UNIQUEIDENTIFIER"), column("packed_at", "TIME")]
    )
    return typed_values(raw, declared)


@registered(
    "identifier_cleanup",
    """
    SELECT s_suppkey AS supplier_id, s_name AS supplier_name, s_acctbal AS account_balance FROM supplier
    """,
)
def identifier_cleanup(spark: SparkSession, sf: str) -> DataFrame:
    raw = table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("Supplier-ID"),
        F.col("s_name").alias("SupplierName"),
        F.col("s_acctbal").alias("Account Balance"),
    )
    return snake_case_columns(clean_column_names(raw))


@registered(
    "query_scan",
    """
    SELECT o_orderstatus, count(*) AS n_orders FROM orders WHERE o_totalprice > 100000 GROUP BY ALL
    """,
)
def query_scan(spark: SparkSession, sf: str) -> DataFrame:
    return scan_query(
        spark,
        "WITH large AS (SELECT o_orderstatus FROM "
        f"parquet.`{sf}/orders.parquet` WHERE o_totalprice > 100000) "
        "SELECT o_orderstatus, count(*) AS n_orders FROM large GROUP BY o_orderstatus;",
    )


@registered(
    "row_checksum",
    """
    SELECT c_custkey,
           sha256(concat_ws(';', c_custkey, length(c_name) || ':' || c_name,
                            CASE WHEN c_acctbal < 0 THEN '~' ELSE CAST(c_nationkey AS VARCHAR) END,
                            length(c_mktsegment) || ':' || c_mktsegment)) AS row_checksum
    FROM customer
    """,
)
def row_checksum_query(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "customer").select(
        "c_custkey",
        "c_name",
        F.when(F.col("c_acctbal") >= 0, F.col("c_nationkey")).alias("c_nationkey"),
        "c_mktsegment",
    )
    return rows.select("c_custkey", row_checksum(rows.schema).alias("row_checksum"))


@registered(
    "row_checksum_joined",
    """
    SELECT l_orderkey, l_linenumber,
           sha256(concat_ws('|', l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity,
                            l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus,
                            strftime(l_shipdate, '%Y-%m-%dT%H:%M:%S'))) AS row_checksum
    FROM lineitem
    """,
)
def row_checksum_joined(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "lineitem")
    return rows.select(
        "l_orderkey", "l_linenumber", row_checksum(rows.schema, legacy=True).alias("row_checksum")
    )


@registered(
    "json_path_text",
    """
    SELECT event_id, props ->> '$.k' AS k_text, CAST(props ->> '$.k' AS INTEGER) AS k_number,
           props ->> '$.missing' AS missing_text
    FROM events
    """,
)
def json_path_text(spark: SparkSession, sf: str) -> DataFrame:
    props = F.col("props")
    return table(spark, sf, "events").select(
        "event_id",
        cleanse.json_text(props, "k").alias("k_text"),
        cleanse.json_text(props, "$.k").cast("int").alias("k_number"),
        cleanse.json_text(props, "missing").alias("missing_text"),
    )


@registered(
    "record_extract",
    """
    WITH lines AS (
        SELECT doc_id, generate_subscripts(string_split(text, chr(10)), 1) AS line_no,
               unnest(string_split(text, chr(10))) AS line
        FROM documents
    )
    SELECT doc_id, CAST(line_no AS INTEGER) AS line_no, line FROM lines
    """,
)
def record_extract(spark: SparkSession, sf: str) -> DataFrame:
    lines = F.split("text", "\n")
    packed = table(spark, sf, "documents").select(
        F.to_json(
            F.struct(
                F.struct(
                    F.transform(
                        lines,
                        lambda line, i: F.struct(
                            F.col("doc_id"), (i + 1).alias("line_no"), line.alias("line")
                        ),
                    ).alias("records")
                ).alias("data")
            )
        ).alias("document")
    )
    schema = "data struct<records: array<struct<doc_id: bigint, line_no: int, line: string>>>"
    return extract_records(
        packed.select(F.from_json("document", schema).alias("d")).select("d.*"),
        ["data", "records"],
    )


@registered(
    "stream_counts",
    "SELECT event_type AS stream, count(*) AS n_records FROM events GROUP BY ALL",
)
def stream_counts(spark: SparkSession, sf: str) -> DataFrame:
    return counts_by_stream(table(spark, sf, "events"), "event_type")


@registered(
    "wide_split",
    """
    SELECT 'sheet_table_1' AS table_name, CAST(o_orderkey AS VARCHAR) AS first_value,
           o_orderpriority AS second_value
    FROM orders
    UNION ALL
    SELECT 'sheet_table_2', CAST(o_custkey AS VARCHAR), strftime(o_orderdate, '%Y-%m-%d')
    FROM orders WHERE o_orderstatus <> 'P'
    """,
)
def wide_split(spark: SparkSession, sf: str) -> DataFrame:
    shown = F.col("o_orderstatus") != "P"
    wide = table(spark, sf, "orders").select(
        F.col("o_orderkey").cast("string").alias("key"),
        F.col("o_orderpriority").alias("priority"),
        F.lit(None).cast("string").alias("Unnamed: 2"),
        F.lit(None).cast("string").alias("Unnamed: 3"),
        F.when(shown, F.col("o_custkey").cast("string")).alias("key.1"),
        F.when(shown, iso_date("o_orderdate")).alias("date"),
        F.lit(None).cast("string").alias("Unnamed: 6"),
        F.lit(None).cast("string").alias("note"),
    )
    found = split_wide(wide, "sheet")
    if set(found) != {"sheet_table_1", "sheet_table_2"}:
        raise ValueError(f"unexpected tables: {sorted(found)}")
    first, second = found["sheet_table_1"], found["sheet_table_2"]
    return first.select(
        F.lit("sheet_table_1").alias("table_name"),
        F.col("key").alias("first_value"),
        F.col("priority").alias("second_value"),
    ).unionByName(
        second.select(
            F.lit("sheet_table_2").alias("table_name"),
            F.col("key").alias("first_value"),
            F.col("date").alias("second_value"),
        )
    )
