"""Bounded samples of labelled documents, the only rows labels are learned from."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def held_out(doc_id: Column | str = "doc_id") -> Column:
    """True for the rows whose labels are never learned from (fixed rule)."""
    key = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def sample(docs: DataFrame, labels: DataFrame, label: str, per_class: int) -> DataFrame:
    """(doc_id, label, text) of at most ``per_class`` documents of either label.

    Documents are chosen by the hash of their id, so the choice neither depends on order
    nor changes between runs. Null ids and null labels are left out; of an id with two
    labels the greater counts, of an id with several texts the least one.
    """
    known = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("label"))
        .where(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1) & ~held_out())
        .groupBy("doc_id")
        .agg(F.max("label").alias("label"))
    )
    turn = F.xxhash64(F.col("doc_id"), F.lit(label))
    chosen = [known.where(F.col("label") == c).orderBy(turn, "doc_id").limit(per_class) for c in (0, 1)]
    # Two numbers for each of at most 2 * per_class rows: small enough to send to every task.
    few = F.broadcast(chosen[0].union(chosen[1]))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    # An id may be on any number of rows: they are folded in each task, so one row of an id is left.
    return texts.join(few, "doc_id").groupBy("doc_id", "label").agg(F.min("text").alias("text"))
