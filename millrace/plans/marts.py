"""The layered build: snapshot, staging, core, reporting, in this order."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators.snapshot import VALID_FROM, VALID_TO, empty_history, snapshot_step, without_key
from millrace.session import Scratch
from millrace.sources import writers
from millrace.sources.files import load_seed

OPEN = "is_open"


@dataclass(frozen=True)
class SnapshotOf:
    """A dimension whose history is kept."""

    source: DataFrame
    keys: Sequence[str]
    strategy: str = "check"
    updated_at: str | None = None
    #: Rows that lack a key: ``fail`` stops before anything is written, ``skip`` leaves them out.
    on_bad: str = "fail"


@dataclass(frozen=True)
class Seed:
    """A small reference table kept as a delimited file."""

    path: str
    schema: T.StructType


Reader = Callable[[str], DataFrame]
Model = Callable[[Reader], DataFrame]


@dataclass
class Marts:
    """What to build. Later layers get a reader of what was built before them."""

    snapshots: Mapping[str, SnapshotOf] = field(default_factory=dict)
    seeds: Mapping[str, Seed] = field(default_factory=dict)
    staging: Mapping[str, Model | str] = field(default_factory=dict)
    core: Mapping[str, Model] = field(default_factory=dict)
    reporting: Mapping[str, Model] = field(default_factory=dict)
    checks: Mapping[str, Model] = field(default_factory=dict)


@dataclass
class Built:
    """Names in the order they were built, and the number of findings per check."""

    names: list[str]
    findings: dict[str, int]


def save_snapshot(
    spark: SparkSession, table: str, spec: SnapshotOf, run_time: dt.datetime
) -> None:
    """Advance a stored history by one run.

    The history is partitioned by ``is_open``. Closed versions are only ever
    added to, so their files are not read or rewritten however long the history
    gets. A run repeated with its run time after a crash adds no version twice.
    """
    stamp = F.lit(run_time).cast("timestamp")
    if spec.on_bad not in ("fail", "skip"):
        raise ValueError("on_bad is fail or skip")
    if spec.on_bad == "fail":
        lacking = without_key(spec.source, spec.keys).select("_problem").limit(1).collect()
        if lacking:
            raise ValueError(f"rows of {table} cannot be kept: {lacking[0][0]}")
    if not spark.catalog.tableExists(table):
        blank = empty_history(spark, spec.source.schema).withColumn(OPEN, F.lit(True))
        blank.write.partitionBy(OPEN).format("parquet").saveAsTable(table)
    stored = spark.table(table)
    opened = stored.where(F.col(OPEN)).drop(OPEN)
    advanced = snapshot_step(
        spec.source, opened, spec.keys, stamp, strategy=spec.strategy, updated_at=spec.updated_at
    )
    with Scratch(spark) as scratch:
        step = scratch.keep(advanced)
        version = [*spec.keys, VALID_FROM, VALID_TO]
        known = stored.where(~F.col(OPEN))
        if spec.strategy == "check":
            known = known.where(F.col(VALID_TO) >= stamp)
        closing = step.where(F.col(VALID_TO).isNotNull())
        newly = closing.join(known.select(*version), version, "left_anti")
        newly.withColumn(OPEN, F.lit(False)).select(*stored.columns).write.insertInto(table)
        still_open = step.where(F.col(VALID_TO).isNull()).withColumn(OPEN, F.lit(True))
        if still_open.isEmpty():
            # Overwriting with no rows touches no partition, so the open one is dropped by name.
            spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({OPEN} = true)")
        else:
            writers.replace_partitions(still_open, table)


def build_marts(
    spark: SparkSession,
    marts: Marts,
    database: str,
    run_time: dt.datetime,
) -> Built:
    """Build all layers in order: snapshots, seeds, staging, core, reporting, checks.

    Staging is made of views: a model given as SQL text, with ``{database}`` for the
    database, becomes a view stored there; one given as a function lives as long as the
    session. Core and reporting are tables. The first failure
    stops the build; the layers after it stay as they were. A check is a query
    for offending rows; findings are reported and do not stop anything.
    """
    writers.ensure_database(spark, database)
    names: list[str] = []

    def read(name: str) -> DataFrame:
        if name in marts.staging and not isinstance(marts.staging[name], str):
            return spark.table(name)
        rows = spark.table(f"{database}.{name}")
        return rows.drop(OPEN) if name in marts.snapshots else rows

    for name, spec in marts.snapshots.items():
        save_snapshot(spark, f"{database}.{name}", spec, run_time)
        names.append(name)
    for name, seed in marts.seeds.items():
        load_seed(spark, seed.path, seed.schema, f"{database}.{name}")
        names.append(name)
    for name, make in marts.staging.items():
        if isinstance(make, str):
            sql = make.format(database=database)
            spark.sql(f"CREATE OR REPLACE VIEW {database}.{name} AS {sql}")
        else:
            make(read).createOrReplaceTempView(name)
        names.append(name)
    for layer in (marts.core, marts.reporting):
        for name, make in layer.items():
            writers.refresh_table(make(read), f"{database}.{name}")
            names.append(name)
    return Built(names, {name: make(read).count() for name, make in marts.checks.items()})
