"""Data tests, profiles, reconciliations and inventories."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators import quality
from millrace.operators import schema as contracts
from millrace.operators.events import batch_numbers
from millrace.plans.queries.registry import registered, table
from millrace.sources.tables import inventory

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


@registered(
    "frame_validation",
    """
    SELECT count_if(p_size < 10)::BIGINT AS p_name, 0::BIGINT AS p_type,
           count_if(p_retailprice > 1000)::BIGINT AS p_size
    FROM part
    """,
)
def frame_validation(spark: SparkSession, sf: str) -> DataFrame:
    part = table(spark, sf, "part").select(
        F.when(F.col("p_size") >= 10, F.col("p_name")).alias("p_name"),
        "p_type",
        F.when(F.col("p_retailprice") <= 1000, F.col("p_size")).alias("p_size"),
    )
    return contracts.null_counts(part, ["p_name", "p_type", "p_size"])


@registered(
    "string_length_profile",
    """
    SELECT 'part' AS table_name, 'p_name' AS column_name, max(length(p_name)) AS longest FROM part
    UNION ALL SELECT 'part', 'p_brand', max(length(p_brand)) FROM part
    UNION ALL SELECT 'part', 'p_type', max(length(p_type)) FROM part
    UNION ALL SELECT 'documents', 'text', max(length(text)) FROM documents
    UNION ALL SELECT 'documents', 'lang', max(length(lang)) FROM documents
    UNION ALL SELECT 'documents', 'source', max(length(source)) FROM documents
    """,
)
def string_length_profile(spark: SparkSession, sf: str) -> DataFrame:
    def profile(name: str) -> DataFrame:
        lengths = contracts.string_lengths(table(spark, sf, name))
        return lengths.unpivot([], lengths.columns, "column_name", "longest").select(
            F.lit(name).alias("table_name"), "column_name", F.col("longest").cast("long").alias("longest")
        )

    return profile("part").unionByName(profile("documents"))


@registered(
    "distinct_values",
    """
    SELECT DISTINCT c_name AS value FROM customer WHERE c_acctbal >= 0
    """,
)
def distinct_values(spark: SparkSession, sf: str) -> DataFrame:
    names = table(spark, sf, "customer").select(
        F.when(F.col("c_acctbal") >= 0, F.col("c_name")).alias("value")
    )
    return names.where("value IS NOT NULL").distinct()


@registered(
    "check_foreign_key",
    """
    SELECT 'lineitem' AS child, l_orderkey AS missing_key, count(*) AS n_rows
    FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P')
    GROUP BY ALL
    UNION ALL
    SELECT 'orders', o_custkey, count(*)
    FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal >= 0)
    GROUP BY ALL
    """,
)
def check_foreign_key(spark: SparkSession, sf: str) -> DataFrame:
    orders, customers = table(spark, sf, "orders"), table(spark, sf, "customer")
    lines = quality.check_foreign_key(
        table(spark, sf, "lineitem"), "l_orderkey", orders.where("o_orderstatus <> 'P'"), "o_orderkey"
    )
    bought = quality.check_foreign_key(
        orders, "o_custkey", customers.where("c_acctbal >= 0"), "c_custkey"
    )
    return lines.select(
        F.lit("lineitem").alias("child"), F.col("l_orderkey").alias("missing_key"), "n_rows"
    ).unionByName(
        bought.select(F.lit("orders").alias("child"), F.col("o_custkey").alias("missing_key"), "n_rows")
    )


@registered(
    "cascade_delete",
    """
    SELECT o_orderkey, o_custkey FROM orders
    WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')
    """,
)
def cascade_delete(spark: SparkSession, sf: str) -> DataFrame:
    deleted = table(spark, sf, "customer").where("c_mktsegment = 'BUILDING'")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    return quality.cascade_delete(orders, "o_custkey", deleted, "c_custkey")


@registered(
    "orphan_rows",
    """
    SELECT o_orderkey, o_custkey FROM orders
    WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal >= 0)
    """,
)
def orphan_rows(spark: SparkSession, sf: str) -> DataFrame:
    customers = table(spark, sf, "customer").where("c_acctbal >= 0")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    return quality.orphan_rows(orders, "o_custkey", customers, "c_custkey")


@registered(
    "check_unique",
    """
    SELECT o_custkey, CAST(o_orderdate AS VARCHAR)[1:10] AS order_date, count(*) AS n_rows
    FROM orders GROUP BY ALL HAVING count(*) > 1
    """,
)
def check_unique(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").select(
        "o_custkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("order_date")
    )
    return quality.check_unique(orders, ["o_custkey", "order_date"])


@registered(
    "check_not_null",
    """
    SELECT 'o_orderkey' AS "column", count_if(o_orderkey IS NULL)::BIGINT AS n_failed FROM orders
    UNION ALL
    SELECT 'o_totalprice', count_if(o_totalprice > 200000)::BIGINT FROM orders
    """,
)
def check_not_null(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").select(
        "o_orderkey",
        F.when(F.col("o_totalprice") <= 200000, F.col("o_totalprice")).alias("o_totalprice"),
    )
    return quality.check_not_null(orders, ["o_orderkey", "o_totalprice"])


@registered(
    "count_reconcile",
    """
    WITH n AS (
        SELECT 'orders' AS table_name, count(*) AS source_rows, count(*) AS target_rows FROM orders
        UNION ALL
        SELECT 'customer', count(*), count_if(c_acctbal >= 0) FROM customer
        UNION ALL
        SELECT 'events', count(*), count_if(event_type <> 'error') FROM events
    )
    SELECT table_name, source_rows, CAST(target_rows AS BIGINT) AS target_rows,
           source_rows = target_rows AS matches
    FROM n
    """,
)
def count_reconcile(spark: SparkSession, sf: str) -> DataFrame:
    orders, customers, events = (table(spark, sf, n) for n in ("orders", "customer", "events"))
    return quality.check_counts(
        {
            "orders": (orders, orders.select("o_orderkey")),
            "customer": (customers, customers.where("c_acctbal >= 0")),
            "events": (events, events.where("event_type <> 'error'")),
        }
    )


@registered(
    "table_inventory",
    " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS n_rows, "
        f"(SELECT count(*) FROM pragma_table_info('{t}'))::INTEGER AS n_columns, "
        f"(SELECT string_agg(name, ',' ORDER BY cid) FROM pragma_table_info('{t}')) AS columns FROM {t}"
        for t in TABLES
    ),
)
def table_inventory(spark: SparkSession, sf: str) -> DataFrame:
    found = inventory({name: table(spark, sf, name) for name in TABLES})
    names = F.array_join(F.transform("columns", lambda c: c["name"]), ",")
    return found.withColumn("columns", names)


@registered(
    "batch_report",
    """
    SELECT CAST(floor(event_id / 1000) AS BIGINT) + 1 AS batch_no, count(*) AS n_rows,
           min(event_id) AS first_index, max(event_id) AS last_index
    FROM events GROUP BY ALL
    """,
)
def batch_report(spark: SparkSession, sf: str) -> DataFrame:
    numbered = batch_numbers(table(spark, sf, "events"), 1000, F.col("event_id"))
    return numbered.groupBy("batch_no").agg(
        F.count("*").alias("n_rows"),
        F.min("event_id").alias("first_index"),
        F.max("event_id").alias("last_index"),
    )
