"""The registry and the readers the registered queries share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.session import tune

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def registered(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(query: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name!r} is registered twice")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return query(tune(spark), sf_dir)

        QUERIES[name] = run
        if sql is not None:
            SQL[name] = sql.strip()
        return query

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def as_double(value: Column | str) -> Column:
    return (F.col(value) if isinstance(value, str) else value).cast("double")


def iso_date(value: Column | str) -> Column:
    return F.date_format(value, "yyyy-MM-dd")


def iso_second(value: Column | str) -> Column:
    return F.date_format(value, "yyyy-MM-dd HH:mm:ss")
