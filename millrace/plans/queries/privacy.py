"""Personal-data replacement: stateless, with stored mappings, and realistic."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.hashing import one_way_hash, pii_normal_form
from millrace.operators import pii
from millrace.plans.queries.registry import registered, table


def _people(spark: SparkSession, sf: str) -> DataFrame:
    """Customers; names in odd spelling, missing for negative balances."""
    name = F.when(F.col("c_nationkey") < 10, F.concat(F.lit("  "), F.upper("c_name"))).otherwise(
        F.col("c_name")
    )
    return table(spark, sf, "customer").select(
        "c_custkey",
        "c_nationkey",
        F.when(F.col("c_acctbal") >= 0, name).alias("c_name"),
        "c_mktsegment",
    )


@registered(
    "pii_hash_replace",
    """
    SELECT c_custkey,
           CASE WHEN c_acctbal >= 0 THEN 'C_NAME_' || substr(sha256(lower(c_name)), 1, 57) END AS c_name,
           'SEG-' || substr(md5(lower(c_mktsegment)), 1, 16) AS c_mktsegment
    FROM customer
    """,
)
def pii_hash_replace(spark: SparkSession, sf: str) -> DataFrame:
    replaced, _ = pii.anonymize(
        _people(spark, sf),
        {
            "c_name": True,
            "c_mktsegment": {
                "hash_algorithm": "md5", "replacement_prefix": "SEG-", "max_length": 20,
            },
            "not_there": True,
        },
        "crm",
    )
    return replaced.select("c_custkey", "c_name", "c_mktsegment")


def _seeded(spark: SparkSession, sf: str) -> DataFrame:
    """A mapping table that knows the people of five nations already."""
    known = table(spark, sf, "customer").where("c_nationkey < 5")
    hashed = one_way_hash(pii_normal_form(F.col("c_name"), T.StringType()))
    stamp = F.lit("2024-01-01").cast("timestamp")
    return known.select(
        F.lit("crm").alias("source_system"),
        F.lit("c_name").alias("field_name"),
        F.lit("").alias("context"),
        F.lit("SHA256").alias("hash_algorithm"),
        hashed.alias("hash_value"),
        F.concat(F.lit("PERSON-"), "c_custkey").alias("replacement_value"),
        stamp.alias("created_at"),
        stamp.alias("updated_at"),
    )


@registered(
    "pii_stored_mapping",
    """
    SELECT c_custkey,
           CASE WHEN c_acctbal < 0 THEN NULL
                WHEN c_nationkey < 5 THEN 'PERSON-' || c_custkey
                ELSE 'C_NAME_' || substr(sha256(lower(c_name)), 1, 57) END AS c_name
    FROM customer
    """,
)
def pii_stored_mapping(spark: SparkSession, sf: str) -> DataFrame:
    replaced, _ = pii.anonymize(
        _people(spark, sf), ["c_name"], "crm", "  ", _seeded(spark, sf)
    )
    return replaced.select("c_custkey", "c_name")


@registered(
    "pii_mapping_new",
    """
    SELECT DISTINCT 'crm' AS source_system, 'c_name' AS field_name, '' AS context,
           'SHA256' AS hash_algorithm, sha256(lower(c_name)) AS hash_value,
           'C_NAME_' || substr(sha256(lower(c_name)), 1, 57) AS replacement_value
    FROM customer WHERE c_acctbal >= 0 AND c_nationkey >= 5
    """,
)
def pii_mapping_new(spark: SparkSession, sf: str) -> DataFrame:
    _, rows = pii.anonymize(_people(spark, sf), ["c_name"], "crm", None, _seeded(spark, sf))
    return rows.drop("created_at", "updated_at")


def _digits(slot: int, size: int) -> str:
    return f"(('0x' || substr(h, {1 + 5 * slot}, 5))::BIGINT % {size})"


def _word(words: tuple[str, ...], slot: int) -> str:
    listed = ", ".join(f"'{w}'" for w in words)
    return f"([{listed}])[{_digits(slot, len(words))} + 1]"


_US = pii.POOLS["en_US"]


@registered(
    "pii_realistic",
    f"""
    WITH hashed AS (
        SELECT c_custkey, CASE WHEN c_acctbal >= 0 THEN sha256(lower(c_name)) END AS h FROM customer
    ),
    drawn AS (
        SELECT DISTINCT h, {_word(_US.city_start, 4)} || {_word(_US.city_end, 5)} AS city
        FROM hashed WHERE h IS NOT NULL
    ),
    numbered AS (SELECT *, row_number() OVER (PARTITION BY city ORDER BY h) AS n FROM drawn)
    SELECT c_custkey, city || CASE WHEN n > 1 THEN ' ' || n ELSE '' END AS c_name
    FROM hashed LEFT JOIN numbered USING (h)
    """,
)
def pii_realistic(spark: SparkSession, sf: str) -> DataFrame:
    replaced, _ = pii.anonymize(
        _people(spark, sf), {"c_name": {"field_type": "city"}}, "crm", None, None
    )
    return replaced.select("c_custkey", "c_name")


@registered(
    "pii_realistic_people",
    f"""
    WITH hashed AS (SELECT s_suppkey, sha256(lower(s_name)) AS h FROM supplier),
    drawn AS (
        SELECT DISTINCT h,
               {_word(_US.first, 0)} || ' ' || chr(CAST(65 + {_digits(2, 26)} AS INTEGER)) || '. '
               || {_word(_US.last, 1)} AS person
        FROM hashed
    ),
    numbered AS (SELECT *, row_number() OVER (PARTITION BY person ORDER BY h) AS n FROM drawn)
    SELECT s_suppkey, person || CASE WHEN n > 1 THEN ' ' || n ELSE '' END AS s_name
    FROM hashed LEFT JOIN numbered USING (h)
    """,
)
def pii_realistic_people(spark: SparkSession, sf: str) -> DataFrame:
    replaced, _ = pii.anonymize(
        table(spark, sf, "supplier").select("s_suppkey", "s_name"),
        {"s_name": {"field_type": "name"}},
        "erp",
    )
    return replaced
