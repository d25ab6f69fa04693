"""Type-2 snapshots: every version of a row with the interval it was valid in."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.hashing import row_checksum
from millrace.operators.mapping import quoted
from millrace.operators.ordered import with_neighbour
from millrace.session import stored_rows

VALID_FROM, VALID_TO, VERSION_CHECKSUM = "valid_from", "valid_to", "version_checksum"
VERSION_COLUMNS = (VALID_FROM, VALID_TO, VERSION_CHECKSUM)


def empty_history(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """A history without rows, for the first snapshot of a table."""
    fields = [
        *schema.fields,
        T.StructField(VALID_FROM, T.TimestampType()),
        T.StructField(VALID_TO, T.TimestampType()),
        T.StructField(VERSION_CHECKSUM, T.StringType()),
    ]
    return spark.createDataFrame([], T.StructType(fields))


def without_key(current: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows that lack a key, with ``_problem``. No version can be told to be theirs."""
    lacking = F.array_compact(
        F.array(*[F.when(F.col(quoted(k)).isNull(), F.lit(f"{k} is null")) for k in keys])
    )
    return current.where(F.size(lacking) > 0).withColumn("_problem", F.array_join(lacking, "; "))


def snapshot_step(
    current: DataFrame,
    history: DataFrame,
    keys: Sequence[str],
    run_time: Column,
    *,
    strategy: str = "check",
    updated_at: str | None = None,
) -> DataFrame:
    """The open versions after this run and the versions this run closes.

    Versions closed earlier are not read, so the cost follows the size of the
    current data, not of the history. A changed row yields its closed old version
    and its new one; a row that is gone is closed; one that comes back opens anew.
    ``check`` compares checksums; ``timestamp`` trusts the column ``updated_at``.
    Rows that lack a key get no version (see ``without_key``); open versions without a key,
    as earlier releases wrote them, are closed once.
    """
    if strategy not in ("check", "timestamp"):
        raise ValueError(f"unknown snapshot strategy: {strategy}")
    if strategy == "timestamp" and not updated_at:
        raise ValueError("the timestamp strategy needs updated_at")
    data = current.columns
    keyed = reduce(lambda a, b: a & b, [F.col(quoted(k)).isNotNull() for k in keys])
    stamped = current.where(keyed).withColumn(VERSION_CHECKSUM, row_checksum(current.schema))
    opened = history.where(F.col(VALID_TO).isNull())
    on = reduce(
        lambda a, b: a & b, [F.col(f"o.{quoted(k)}") == F.col(f"c.{quoted(k)}") for k in keys]
    )
    joined = (
        opened.withColumn("_old", F.lit(True))
        .alias("o")
        .join(stamped.withColumn("_new", F.lit(True)).alias("c"), on, "full_outer")
    )
    if strategy == "check":
        starts = run_time
        changed = ~F.col(f"o.{VERSION_CHECKSUM}").eqNullSafe(F.col(f"c.{VERSION_CHECKSUM}"))
    else:
        starts = F.col(f"c.{quoted(updated_at)}").cast("timestamp")
        changed = starts > F.col(f"o.{VALID_FROM}")

    def version(side: str, valid_from: Column, valid_to: Column) -> Column:
        fields = [F.col(f"{side}.{quoted(c)}").alias(c) for c in data]
        return F.struct(
            *fields,
            valid_from.cast("timestamp").alias(VALID_FROM),
            valid_to.cast("timestamp").alias(VALID_TO),
            F.col(f"{side}.{VERSION_CHECKSUM}").alias(VERSION_CHECKSUM),
        )

    never = F.lit(None).cast("timestamp")
    began = F.col(f"o.{VALID_FROM}")
    same = F.array(version("o", began, never))
    renewed = F.array(version("o", began, starts), version("c", starts, never))
    gone = F.array(version("o", began, run_time))
    first = F.array(version("c", starts, never))
    outcome = (
        F.when(F.col("_old").isNull(), first)
        .when(F.col("_new").isNull(), gone)
        .when(F.coalesce(changed, F.lit(False)), renewed)
        .otherwise(same)
    )
    return joined.select(F.explode(outcome).alias("v")).select("v.*")


def snapshot(
    current: DataFrame,
    history: DataFrame,
    keys: Sequence[str],
    run_time: Column,
    *,
    strategy: str = "check",
    updated_at: str | None = None,
) -> DataFrame:
    """The whole history after this run."""
    step = snapshot_step(
        current, history, keys, run_time, strategy=strategy, updated_at=updated_at
    )
    closed = history.where(F.col(VALID_TO).isNotNull())
    return closed.unionByName(step)


def current_versions(history: DataFrame) -> DataFrame:
    """Rows valid now."""
    return history.where(F.col(VALID_TO).isNull())


def version_intervals(versions: DataFrame, keys: Sequence[str], at: str) -> DataFrame:
    """History of a change log that states every version with its time.

    A version equal to the one before it is left out; the interval of each ends
    where the next begins. Equal times are ordered by checksum. Rows are stored in the
    scratch folder on the way, sorted by ranges of key and time.
    """
    payload = [c for c in versions.columns if c != at]
    stamped = versions.withColumn(VERSION_CHECKSUM, row_checksum(versions.schema, payload))
    order = [F.col(quoted(at)), F.col(VERSION_CHECKSUM)]
    compared = with_neighbour(
        stamped, keys, order, F.col(VERSION_CHECKSUM), "_before", following=False
    )
    kept = compared.where(~F.col("_before").eqNullSafe(F.col(VERSION_CHECKSUM))).drop("_before")
    ended = with_neighbour(kept, keys, order, F.col(quoted(at)), VALID_TO, following=True)
    return ended.withColumnRenamed(at, VALID_FROM)
