"""Differences between two copies of a table, found without reading the rows that are equal.

A copy is stored in leaves, by the hash of its keys, beside a tree of digests over them. Two
trees are compared from the root: a node with equal digests ends the search below it, and of
the rows only the leaves that differ are opened.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.hashing import SYNC_COLUMNS, row_checksum
from millrace.operators.mapping import quoted
from millrace.sources.versions import bucket_of

LEAF, CHECKSUM = "_leaf", "_row_checksum"
FAN_OUT = 16

_NODE = "node int, n_rows long, digest string"
_ABOUT = "keys array<string>, leaves int, columns array<string>, stored string"


def leaf_digests(rows: DataFrame) -> DataFrame:
    """(node, n_rows, digest) of rows with ``_leaf`` and ``_row_checksum``.

    Row checksums are added up as whole numbers, so their order does not matter, equal
    rows do not cancel out, and each task adds up its own before the shuffle.
    """
    parts = [F.sum(F.xxhash64(CHECKSUM, F.lit(n)).cast("decimal(20,0)")).alias(f"s{n}") for n in (0, 1)]
    summed = rows.groupBy(F.col(LEAF).alias("node")).agg(F.count("*").alias("n_rows"), *parts)
    text = F.concat_ws("|", *[F.col(c).cast("string") for c in ("n_rows", "s0", "s1")])
    return summed.select("node", "n_rows", F.sha2(text, 256).alias("digest"))


def _parents(nodes: DataFrame) -> DataFrame:
    """A level up: at most ``FAN_OUT`` children meet in a node."""
    children = F.array_sort(F.collect_list(F.struct("node", "digest")))
    text = F.to_json(F.col("children"))
    return (
        nodes.groupBy(F.floor(F.col("node") / FAN_OUT).cast("int").alias("parent"))
        .agg(F.sum("n_rows").alias("n_rows"), children.alias("children"))
        .select(F.col("parent").alias("node"), "n_rows", F.sha2(text, 256).alias("digest"))
    )


def _levels(leaves: int) -> int:
    level, width = 0, leaves
    while width > 1:
        level, width = level + 1, -(-width // FAN_OUT)
    return level


def save_with_tree(rows: DataFrame, root: str, keys: Sequence[str], *, leaves: int = 4096) -> None:
    """Store the rows and their tree in a new folder ``root``.

    Choose ``leaves`` for some 100 MB of rows each. A leaf that one key makes large is written by
    several tasks. ``about`` is written last; a folder without it was cut short and is not read.
    """
    if leaves < 1 or not keys:
        raise ValueError("a tree needs keys and at least one leaf")
    spark = rows.sparkSession
    data = sorted(c for c in rows.columns if c not in SYNC_COLUMNS)
    marked = rows.select(*[quoted(c) for c in data]).withColumns(
        {CHECKSUM: row_checksum(rows.schema, data), LEAF: bucket_of(keys, leaves)}
    )
    dealt = marked.hint("rebalance", F.col(LEAF))
    dealt.write.mode("errorifexists").partitionBy(LEAF).parquet(f"{root}/rows")
    stored = spark.read.schema(dealt.schema).parquet(f"{root}/rows")
    top = _levels(leaves)
    for level in range(top + 1):
        nodes = leaf_digests(stored) if level == 0 else _parents(_level(spark, root, level - 1))
        nodes.write.mode("errorifexists").parquet(f"{root}/tree/level={level}")
    columns = [f"{c} {rows.schema[c].dataType.simpleString()}" for c in data]
    about = spark.createDataFrame([(list(keys), leaves, columns, dealt.schema.json())], _ABOUT)
    about.write.mode("errorifexists").parquet(f"{root}/about")


def _level(spark: SparkSession, root: str, level: int) -> DataFrame:
    return spark.read.schema(_NODE).parquet(f"{root}/tree/level={level}")


def _about(spark: SparkSession, root: str) -> Row:
    return spark.read.schema(_ABOUT).parquet(f"{root}/about").first()


def _shape(spark: SparkSession, left: str, right: str) -> Row:
    """What the trees are about; only trees of one shape can be compared."""
    a, b = _about(spark, left), _about(spark, right)
    if a[:3] != b[:3]:
        raise ValueError(f"the trees differ in keys, leaves or columns: {a[:3]} and {b[:3]}")
    return a


def differing_leaves(spark: SparkSession, left: str, right: str) -> DataFrame:
    """``node``: the leaves with other rows on either side. Equal roots end it at once."""
    below = None
    for level in range(_levels(_shape(spark, left, right)["leaves"]), -1, -1):
        sides = [_level(spark, root, level) for root in (left, right)]
        if below is not None:
            parents = below.select(F.col("node").alias("_parent"))
            under = F.floor(F.col("node") / FAN_OUT) == F.col("_parent")
            sides = [side.join(parents, under, "left_semi") for side in sides]
        a, b = (side.select("node", F.col("digest").alias(name)) for side, name in zip(sides, "ab", strict=True))
        below = a.join(b, "node", "full_outer").where(~F.col("a").eqNullSafe(F.col("b"))).select("node")
    return below


def opened_rows(spark: SparkSession, root: str, leaves: Sequence[int]) -> DataFrame:
    """The stored rows of these leaves; the scan opens no other folder."""
    schema = T.StructType.fromJson(json.loads(_about(spark, root)["stored"]))
    rows = spark.read.schema(schema).parquet(f"{root}/rows")
    return rows.where(F.col(LEAF).isin([int(n) for n in leaves])) if leaves else rows.where(F.lit(False))


def find_differences(spark: SparkSession, left: str, right: str) -> DataFrame:
    """The keys whose rows differ: ``finding``, and how many rows only one side has.

    ``missing``: only left has rows that right has not; ``extra``: only right; ``changed``: both.
    Repeated rows count as often as they are there, null keys are equal. The numbers of the
    leaves that differ pass through the driver, at most as many as the tree has leaves.
    """
    keys = [quoted(k) for k in _shape(spark, left, right)["keys"]]
    nodes = sorted(r["node"] for r in differing_leaves(spark, left, right).collect())
    sides = [
        opened_rows(spark, root, nodes).select(*keys, CHECKSUM, F.lit(sign).alias("_n"))
        for root, sign in ((left, 1), (right, -1))
    ]
    # Equal rows of the two sides cancel before the keys meet, within each task first.
    unequal = (
        sides[0].unionByName(sides[1]).groupBy(*keys, CHECKSUM).agg(F.sum("_n").alias("_n")).where("_n <> 0")
    )
    found = unequal.groupBy(*keys).agg(
        F.sum(F.greatest(F.col("_n"), F.lit(0))).alias("left_rows"),
        F.sum(F.greatest(-F.col("_n"), F.lit(0))).alias("right_rows"),
    )
    finding = (
        F.when(F.col("right_rows") == 0, "missing").when(F.col("left_rows") == 0, "extra").otherwise("changed")
    )
    return found.withColumn("finding", finding)
