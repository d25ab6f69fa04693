"""Session settings the operators rely on, and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

# Runtime SQL settings. Each matters for skewed or very large inputs:
# adaptive execution measures shuffle output before it picks broadcast joins and
# splits skewed join partitions; "force" lets it split them even when a later
# aggregation then needs one more (small) exchange.
RUNTIME_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # The JVM does not compile methods beyond this size; wide checksum rows are
    # faster without whole-stage code than in an interpreted method.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.session.timeZone": "UTC",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings above. Memory and partition counts stay the caller's."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder for intermediate tables.

    On a cluster it lies below ``spark.checkpoint.dir``, which every executor
    can reach. Only where that is unset *and* the master is local does it fall
    back to a temporary folder of this machine.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="millrace-")
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def has_rows(df: DataFrame) -> bool:
    return bool(df.take(1))


def stored_rows(
    df: DataFrame, path: str | None = None, partition_by: Sequence[str] = (), options: Mapping[str, str] | None = None
) -> DataFrame:
    """The rows, written once to the scratch folder and read back. ``options``: more of the writer's.

    This cuts the plan: what follows neither repeats the work before it nor
    depends on executors that held it, and can count and prune the stored rows.
    """
    spark = df.sparkSession
    path = path or scratch_dir(spark, "rows")
    # Small row groups: the rows are read once or twice more, and even a single
    # file, as an unpartitioned source gives, is then read by several tasks.
    writer = df.write.mode("errorifexists").option("parquet.block.size", 8 << 20).options(**options or {})
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


class Scratch:
    """Stored rows that are deleted when the ``with`` block ends."""

    def __init__(self, spark: SparkSession) -> None:
        self.spark = spark
        self.paths: list[str] = []

    def __enter__(self) -> Scratch:
        return self

    def keep(self, df: DataFrame, options: Mapping[str, str] | None = None) -> DataFrame:
        path = scratch_dir(self.spark, "rows")
        self.paths.append(path)
        return stored_rows(df, path, options=options)

    def __exit__(self, *_: object) -> None:
        hadoop = self.spark._jvm.org.apache.hadoop.fs
        for path in self.paths:
            folder = hadoop.Path(path)
            folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(folder, True)
