"""Reporting: the joint fact, its dimensions and totals; staging of raw rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.cleanse import month_end, month_of, within_last_days, year_of, year_start
from millrace.operators.schema import narrow
from millrace.plans.queries.registry import as_double, iso_date, registered, table
from millrace.plans.reporting import (
    CREDIT,
    INVOICE,
    Dimension,
    build_reporting,
    folded,
    money,
    refolded,
    revenue_by,
    revenue_by_dimension,
    union_records,
    with_dimension,
)
from millrace.plans.staging import stage_dimension, stage_fact, stage_projection

_LINE_TOTAL_SQL = (
    "CAST(CAST(l_extendedprice AS DECIMAL(15,2)) * "
    "(CAST(1 AS DECIMAL(3,2)) - CAST(l_discount AS DECIMAL(3,2))) AS DECIMAL(19,4))"
)


def line_total():
    price = money(F.col("l_extendedprice"), 15, 2)
    return (price * (F.lit(1).cast("decimal(3,2)") - money(F.col("l_discount"), 3, 2))).cast(
        "decimal(19,4)"
    )


def invoice_lines(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Returned lines are the credits, all others the invoices."""
    lines = table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("invoice_number"),
        F.col("l_partkey").alias("item_code"),
        F.col("l_suppkey").alias("seller_id"),
        money(F.col("l_quantity"), 18, 3).alias("quantity"),
        line_total().alias("line_total"),
        "l_returnflag",
    )
    invoices = lines.where("NOT (l_returnflag <=> 'R')").drop("l_returnflag")
    credits = lines.where("l_returnflag = 'R'").drop("l_returnflag", "seller_id")
    return invoices, credits


def typed_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Both record kinds from one scan, for totals that need no other column."""
    kind = F.when(F.col("l_returnflag") == "R", F.lit(CREDIT)).otherwise(F.lit(INVOICE))
    return table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("invoice_number"),
        kind.alias("record_type"),
        line_total().alias("line_total"),
    )


@registered(
    "revenue_by_customer",
    f"""
    SELECT c.c_name AS customer_name,
           CASE WHEN l.l_returnflag = 'R' THEN 'credit' ELSE 'invoice' END AS record_type,
           count(*) AS n_rows,
           CAST(sum({_LINE_TOTAL_SQL}) AS DOUBLE) AS revenue
    FROM lineitem l
    LEFT JOIN orders o ON o.o_orderkey = l.l_orderkey
    LEFT JOIN customer c ON c.c_custkey = o.o_custkey
    GROUP BY ALL
    """,
)
def revenue_by_customer(spark: SparkSession, sf: str) -> DataFrame:
    orders = Dimension(
        table(spark, sf, "orders"), "o_orderkey", "invoice_number", {"o_custkey": "customer_code"}
    )
    customers = Dimension(
        table(spark, sf, "customer"), "c_custkey", "customer_code", {"c_name": "customer_name"}
    )
    by_order = folded(typed_lines(spark, sf), ["invoice_number", "record_type"])
    by_customer = refolded(with_dimension(by_order, orders), ["customer_code", "record_type"])
    totals = refolded(with_dimension(by_customer, customers), ["customer_name", "record_type"])
    return totals.withColumn("revenue", as_double("revenue"))


@registered(
    "revenue_by_month",
    f"""
    SELECT CASE WHEN l.l_returnflag = 'R' THEN 'credit' ELSE 'invoice' END AS record_type,
           CAST(year(o.o_orderdate) AS INTEGER) AS year,
           strftime(last_day(CAST(o.o_orderdate AS DATE)), '%Y-%m-%d') AS month_end,
           c.c_mktsegment AS customer_group,
           count(*) AS n_rows,
           CAST(sum({_LINE_TOTAL_SQL}) AS DOUBLE) AS revenue
    FROM lineitem l
    LEFT JOIN orders o ON o.o_orderkey = l.l_orderkey
    LEFT JOIN customer c ON c.c_custkey = o.o_custkey
    GROUP BY ALL
    """,
)
def revenue_by_month(spark: SparkSession, sf: str) -> DataFrame:
    orders = Dimension(
        table(spark, sf, "orders"),
        "o_orderkey",
        "invoice_number",
        {"o_custkey": "customer_code", "o_orderdate": "posted_date"},
    )
    customers = Dimension(
        table(spark, sf, "customer"), "c_custkey", "customer_code", {"c_mktsegment": "customer_group"}
    )
    # Folded before each join: the lines to one row an order, these to one a customer and month.
    by_order = folded(typed_lines(spark, sf), ["invoice_number", "record_type"])
    dated = with_dimension(by_order, orders).select(
        "customer_code",
        "record_type",
        "n_rows",
        "revenue",
        year_of(F.col("posted_date")).alias("year"),
        month_end(F.col("posted_date")).alias("end_of_month_bucket"),
    )
    own_keys = ["record_type", "year", "end_of_month_bucket"]
    by_customer = refolded(dated, ["customer_code", *own_keys])
    totals = refolded(with_dimension(by_customer, customers), [*own_keys, "customer_group"])
    return totals.select(
        "record_type",
        "year",
        iso_date("end_of_month_bucket").alias("month_end"),
        "customer_group",
        "n_rows",
        as_double("revenue").alias("revenue"),
    )


@registered(
    "revenue_by_segment_year",
    """
    SELECT c.c_mktsegment AS segment, CAST(year(o.o_orderdate) AS INTEGER) AS year,
           count(*) AS n_rows,
           CAST(sum(CAST(o.o_totalprice AS DECIMAL(19,4))) AS DOUBLE) AS revenue
    FROM orders o LEFT JOIN customer c ON c.c_custkey = o.o_custkey
    GROUP BY ALL
    """,
)
def revenue_by_segment_year(spark: SparkSession, sf: str) -> DataFrame:
    fact = table(spark, sf, "orders").select(
        "o_custkey",
        year_of(F.col("o_orderdate")).alias("year"),
        money(F.col("o_totalprice")).alias("line_total"),
    )
    customers = Dimension(
        table(spark, sf, "customer"), "c_custkey", "o_custkey", {"c_mktsegment": "segment"}
    )
    totals = revenue_by_dimension(fact, customers, ["segment", "year"], fact_keys=["year"])
    return totals.withColumn("revenue", as_double("revenue"))


@registered(
    "margin_by_supplier",
    f"""
    SELECT s.s_name AS seller_name, n.n_name AS nation,
           count(*) AS n_rows,
           CAST(sum({_LINE_TOTAL_SQL}) AS DOUBLE) AS revenue,
           CAST(sum({_LINE_TOTAL_SQL}
                - CAST(CAST(l_quantity AS DECIMAL(18,3)) * CAST(p_retailprice AS DECIMAL(15,2))
                       AS DECIMAL(19,4))) AS DOUBLE) AS profit
    FROM lineitem l
    LEFT JOIN part p ON p.p_partkey = l.l_partkey
    LEFT JOIN supplier s ON s.s_suppkey = l.l_suppkey
    LEFT JOIN nation n ON n.n_nationkey = s.s_nationkey
    GROUP BY ALL
    """,
)
def margin_by_supplier(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "lineitem").select(
        F.col("l_partkey").alias("item_code"),
        F.col("l_suppkey").alias("seller_id"),
        money(F.col("l_quantity"), 18, 3).alias("quantity"),
        line_total().alias("line_total"),
    )
    # Summed per item and seller first: the item's price is the same in each such
    # group, and a bestseller meets the item table as a few rows, not millions.
    folded = lines.groupBy("item_code", "seller_id").agg(
        F.count("*").alias("n_rows"),
        F.sum("quantity").alias("quantity"),
        F.sum("line_total").alias("line_total"),
    )
    items = Dimension(table(spark, sf, "part"), "p_partkey", "item_code", {"p_retailprice": "price"})
    priced = with_dimension(folded, items).withColumn(
        "gross_profit",
        F.col("line_total")
        - (F.col("quantity").cast("decimal(21,3)") * money(F.col("price"), 15, 2)),
    )
    per_seller = priced.groupBy("seller_id").agg(
        F.sum("n_rows").alias("n_rows"),
        F.sum("line_total").alias("line_total"),
        F.sum("gross_profit").alias("gross_profit"),
    )
    sellers = Dimension(
        table(spark, sf, "supplier"), "s_suppkey", "seller_id",
        {"s_name": "seller_name", "s_nationkey": "nation_key"},
    )
    nations = Dimension(table(spark, sf, "nation"), "n_nationkey", "nation_key", {"n_name": "nation"})
    named = narrow(
        with_dimension(with_dimension(per_seller, sellers), nations),
        {"seller_name": "NVARCHAR(200)"},
    )
    totals = named.groupBy("seller_name", "nation").agg(
        F.sum("n_rows").alias("n_rows"),
        F.sum("line_total").alias("revenue"),
        F.sum("gross_profit").alias("profit"),
    )
    return totals.select(
        "seller_name",
        "nation",
        "n_rows",
        as_double("revenue").alias("revenue"),
        as_double("profit").alias("profit"),
    )


@registered(
    "reporting_union",
    f"""
    SELECT CASE WHEN l_returnflag = 'R' THEN 'credit' ELSE 'invoice' END AS record_type,
           l_orderkey AS invoice_number, l_partkey AS item_code,
           CASE WHEN l_returnflag <> 'R' THEN l_suppkey END AS seller_id,
           CAST(CAST(l_quantity AS DECIMAL(18,3)) AS DOUBLE) AS quantity,
           CAST({_LINE_TOTAL_SQL} AS DOUBLE) AS line_total
    FROM lineitem
    """,
)
def reporting_union(spark: SparkSession, sf: str) -> DataFrame:
    rows = narrow(union_records(*invoice_lines(spark, sf)), {
        "quantity": "DECIMAL(18,3)", "line_total": "DECIMAL(19,4)", "record_type": "NVARCHAR(10)",
    })
    return rows.withColumn("quantity", as_double("quantity")).withColumn(
        "line_total", as_double("line_total")
    )


@registered(
    "revenue_by_item_category",
    f"""
    SELECT p.p_type AS item_category, p.p_brand AS items_group_name, count(*) AS n_rows,
           CAST(sum({_LINE_TOTAL_SQL}) AS DOUBLE) AS revenue
    FROM lineitem l LEFT JOIN part p ON p.p_partkey = l.l_partkey
    GROUP BY ALL
    """,
)
def revenue_by_item_category(spark: SparkSession, sf: str) -> DataFrame:
    items = Dimension(
        table(spark, sf, "part"), "p_partkey", "item_code",
        {"p_type": "item_category", "p_brand": "items_group_name"},
    )
    fact = union_records(*invoice_lines(spark, sf))
    totals = revenue_by_dimension(fact, items, ["item_category", "items_group_name"])
    return totals.withColumn("revenue", as_double("revenue"))


@registered(
    "revenue_by_seller_record",
    f"""
    SELECT CASE WHEN l_returnflag = 'R' THEN 'credit' ELSE 'invoice' END AS record_type,
           CASE WHEN l_returnflag <> 'R' THEN l_suppkey END AS seller_id,
           count(*) AS n_rows,
           CAST(sum({_LINE_TOTAL_SQL}) AS DOUBLE) AS revenue,
           CAST(sum(CAST(l_quantity AS DECIMAL(18,3))) AS DOUBLE) AS quantity
    FROM lineitem GROUP BY ALL
    """,
)
def revenue_by_seller_record(spark: SparkSession, sf: str) -> DataFrame:
    fact = union_records(*invoice_lines(spark, sf))
    totals = revenue_by(fact, ["record_type", "seller_id"], profit=None, quantity="quantity")
    return totals.withColumn("revenue", as_double("revenue")).withColumn(
        "quantity", as_double("quantity")
    )


@registered(
    "stage_fact_dates",
    """
    WITH dated AS (
        SELECT o_orderkey,
               make_date(2000 + CAST(strftime(o_orderdate, '%y') AS INTEGER),
                         CAST(month(o_orderdate) AS INTEGER),
                         CAST(day(o_orderdate) AS INTEGER)) AS d
        FROM orders
    )
    SELECT o_orderkey, strftime(d, '%Y-%m-%d') AS posted_date,
           CAST(year(d) AS INTEGER) AS year, strftime(last_day(d), '%Y-%m-%d') AS eom_bucket
    FROM dated
    """,
)
def stage_fact_dates(spark: SparkSession, sf: str) -> DataFrame:
    raw = table(spark, sf, "orders").select(
        "o_orderkey", F.date_format("o_orderdate", "dd.MM.yy").alias("posted_date")
    )
    staged = stage_fact(raw, "posted_date")
    return staged.select(
        "o_orderkey",
        iso_date("posted_date").alias("posted_date"),
        "year",
        iso_date("eom_bucket").alias("eom_bucket"),
    )


@registered(
    "stage_dimension_flags",
    """
    SELECT c_custkey,
           CASE c_mktsegment WHEN 'BUILDING' THEN true WHEN 'AUTOMOBILE' THEN false
                             WHEN 'MACHINERY' THEN true WHEN 'HOUSEHOLD' THEN false END AS is_active,
           c_name AS account
    FROM customer WHERE c_acctbal >= 0
    """,
)
def stage_dimension_flags(spark: SparkSession, sf: str) -> DataFrame:
    segment = F.col("c_mktsegment")
    raw = table(spark, sf, "customer").select(
        "c_custkey",
        F.when(segment == "BUILDING", " Yes ")
        .when(segment == "AUTOMOBILE", "N")
        .when(segment == "MACHINERY", "TRUE")
        .when(segment == "HOUSEHOLD", "0")
        .otherwise("perhaps")
        .alias("is_active"),
        F.when(F.col("c_acctbal") >= 0, F.concat(F.lit("  "), "c_name", F.lit(" ")))
        .otherwise("   ")
        .alias("account"),
    )
    return stage_dimension(raw, flags=["is_active"], trimmed=["account"], required=["account"])


@registered(
    "staging_projection",
    """
    SELECT CAST(o_orderkey AS INTEGER) AS order_id,
           CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderpriority END AS priority,
           CAST(CAST(o_totalprice AS DECIMAL(10,2)) AS DOUBLE) AS total_amount,
           strftime(date_trunc('month', o_orderdate), '%Y-%m-%d') AS order_month,
           strftime(date_trunc('year', o_orderdate), '%Y-%m-%d') AS order_year
    FROM orders WHERE o_orderstatus <> 'P'
    """,
)
def staging_projection(spark: SparkSession, sf: str) -> DataFrame:
    priority = F.col("o_orderpriority")
    raw = table(spark, sf, "orders").select(
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderkey").cast("string")).alias("order_id"),
        F.when(priority == "5-LOW", "  ").otherwise(F.concat(F.lit(" "), priority)).alias("priority"),
        F.col("o_orderdate").alias("order_date"),
        F.col("o_totalprice").alias("total_amount"),
    )
    staged = stage_projection(
        raw,
        "order_id",
        {"order_id": "int", "priority": "string", "order_date": "timestamp",
         "total_amount": "decimal(10,2)"},
        trimmed=["priority"],
    )
    return staged.select(
        "order_id",
        "priority",
        as_double("total_amount").alias("total_amount"),
        iso_date(month_of(F.col("order_date"))).alias("order_month"),
        iso_date(year_start(F.col("order_date"))).alias("order_year"),
    )


@registered(
    "rolling_window_filter",
    """
    SELECT o_orderkey, o_custkey, strftime(o_orderdate, '%Y-%m-%d') AS order_date
    FROM orders WHERE o_orderdate >= DATE '1998-08-02' - INTERVAL 30 DAY
    """,
)
def rolling_window_filter(spark: SparkSession, sf: str) -> DataFrame:
    as_of = F.lit("1998-08-02").cast("date")
    recent = table(spark, sf, "orders").where(within_last_days(F.col("o_orderdate"), as_of, 30))
    return recent.select("o_orderkey", "o_custkey", iso_date("o_orderdate").alias("order_date"))
