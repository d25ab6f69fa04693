"""Mixing sources to target weights by Sainte-Laguë apportionment of equal blocks.

Sizes are words. Every source has a target; blocks of equal size are given to the sources
by the highest quotients target / (2k - 1), then each source's blocks to its shards in the
same way. A shard is a bounded part of one source, so a hot source is many tasks. In a
shard the documents lie in seeded order on a ring, and its blocks are taken from a seeded
start on: only the two documents at the ends are cut, and no word comes more than twice.
A block is at most a 64th of the least target, down to one word, so that rounding to whole
blocks leaves a small source near its target too; all blocks of a mix are equal.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millrace.llm.common import WORD, fresh, text_digest, unit_hash
from millrace.session import stored_rows


@dataclass(frozen=True)
class Mix:
    """``weights`` repeat over the sources by code point, null last."""

    weights: tuple[int, ...] = (3, 1, 2)
    share: float = 1.5  # of all sizes
    most: float = 2.0  # times a source's size
    block: int = 32  # words; fewer if it is more than the least target's ``parts``-th part
    parts: int = 64
    shard: int = 1_000_000  # words
    shards: int = 4096  # of one source at most
    seed: int = 7


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, mix: Mix) -> DataFrame:
    """(source, source_size, weight, target): one row for each source.

    Raising all sources together, weight by weight, until one after another reaches its
    cap is the same as sharing out the excess again and again. Sorted by cap / weight,
    the capped sources come first, so running sums show where the level ends. The table
    has a row for each source, the list a mixture is stated over.
    """
    by_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    rank = F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*map(F.lit, mix.weights)), (rank % len(mix.weights) + 1).cast("int"))
    weighed = by_source.withColumn("weight", weight.cast("double")).withColumn(
        "cap", F.col("source_size") * F.lit(float(mix.most))
    )
    everything = W.partitionBy()
    before = W.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last()).rowsBetween(
        W.unboundedPreceding, -1
    )
    total = F.sum("source_size").over(everything) * F.lit(float(mix.share))
    level = (total - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / (
        F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    )
    # While the sources before one are rightly taken as capped the level rises; from the
    # first open one on it falls, so the greatest is the one that holds.
    leveled = weighed.withColumn("level", level)
    open_level = F.max("level").over(everything)
    return leveled.select(
        "source",
        "source_size",
        "weight",
        F.least("cap", F.coalesce(F.col("weight") * open_level, F.col("cap"))).alias("target"),
    )


def apportion(parties: DataFrame, group: list[str], claim: str, seats: str, most: str, tie: list[str]) -> DataFrame:
    """``parties`` with ``quota``: their share of the group's ``seats`` by Sainte-Laguë.

    The seats go to the highest quotients claim / (2k - 1), so a party's k-th seat is won
    if its quotient is among them. With n parties, every divisor at or above
    claims / (seats - n/2 - 1) gives too few seats and one at claims / (seats + n/2 + 1)
    too many; between the two lie about three quotients a party, which alone are ranked.
    Ties go by ``tie``. No party gets more than ``most``.
    """
    k, lo, hi, quotient, turn = fresh(parties, "k", "lo", "hi", "quotient", "turn")
    over = W.partitionBy(*group)
    claims, n = F.sum(claim).over(over), F.count(F.lit(1)).over(over)
    few = F.col(seats) - n / 2 - 1
    many = F.col(seats) + n / 2 + 1
    sure = F.when((few > 0) & (claims > 0), F.floor(F.col(claim) * few / claims - 0.5)).otherwise(F.lit(0))
    reach = F.when(claims > 0, F.ceil(F.col(claim) * many / claims + 0.5)).otherwise(F.lit(0))
    bounded = parties.withColumn(lo, F.greatest(sure.cast("long"), F.lit(0).cast("long"))).withColumn(
        hi, reach.cast("long")
    )
    ranked = (
        bounded.withColumn(
            k, F.explode_outer(F.when(F.col(hi) > F.col(lo), F.sequence(F.col(lo) + 1, F.col(hi))))
        )
        .withColumn(quotient, F.col(claim) / (2 * F.col(k) - 1))
        .withColumn(
            turn,
            F.row_number().over(
                over.orderBy(F.col(quotient).desc_nulls_last(), *[F.col(t).asc_nulls_last() for t in tie])
            ),
        )
    )
    # The k-th seats are ranked above the (k+1)-th, so the winners of a party are its first ones.
    open_seats = F.col(seats) - F.sum(F.when(F.coalesce(F.col(k), F.col(lo) + 1) == F.col(lo) + 1, F.col(lo))).over(over)
    won = ranked.withColumn("won_", (F.col(k).isNotNull() & (F.col(turn) <= open_seats)).cast("long"))
    keys = [F.col(c) for c in parties.columns]
    return won.groupBy(*keys).agg(
        F.least(F.max(lo) + F.sum("won_"), F.greatest(F.first(most), F.lit(0))).cast("long").alias("quota")
    )


def plan(docs: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """What the mix takes of each document, a row for each row of ``docs``.

    ``docs`` has doc_id, text and source. Returns doc_id, digest, size, source,
    source_size, target, taken, and for the copies ``spans``: an array of (copy, from,
    until) in words. A null text has size 0; a null source is a source; null doc_ids sort
    first in a shard; repeated rows count each for itself; an empty table gives no rows.
    """
    sizes = stored_rows(
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            F.col("source").cast("string").alias("source"),
            text_digest().alias("digest"),
            word_count(F.col("text")).alias("size"),
        )
    )
    targets = source_targets(sizes, mix)
    everything = W.partitionBy()
    least = F.min(F.when(F.col("target") > 0, F.col("target"))).over(everything)
    fitting = F.least(F.floor(F.coalesce(least, F.lit(0.0)) / mix.parts), F.lit(mix.block).cast("long"))
    targets = targets.withColumn("block", F.greatest(fitting, F.lit(1).cast("long")))
    block = F.col("block")
    seats = F.round(F.sum("target").over(everything) / block).cast("long")
    by_source = apportion(
        targets.withColumn("seats", seats).withColumn(
            "most", F.floor(F.lit(mix.most) * F.col("source_size") / block)
        ),
        [],
        "target",
        "seats",
        "most",
        ["source"],
    ).withColumnRenamed("quota", "blocks")
    by_source = stored_rows(
        by_source.select(
            F.col("source").alias("of_source"),
            "source_size",
            "target",
            "blocks",
            "block",
            F.least(F.greatest(F.ceil(F.col("source_size") / mix.shard), F.lit(1)), F.lit(mix.shards))
            .cast("long")
            .alias("shards"),
        )
    )
    dealt = sizes.join(by_source, F.col("source").eqNullSafe(F.col("of_source"))).withColumn(
        "shard",
        F.pmod(F.xxhash64(F.lit(mix.seed), "doc_id", "digest"), F.col("shards")),
    )
    shards = dealt.groupBy("of_source", "blocks", "block", "shard").agg(F.sum("size").alias("shard_size"))
    quotas = apportion(
        shards.withColumn("most", F.floor(F.lit(mix.most) * F.col("shard_size") / block)),
        ["of_source"],
        "shard_size",
        "blocks",
        "most",
        ["shard"],
    ).select(
        F.col("of_source").alias("s"), F.col("shard").alias("h"), "shard_size", "quota", F.col("block").alias("words")
    )
    # The seeded start and the length of the run of blocks on the shard's ring.
    quotas = quotas.withColumn("length", F.col("quota") * F.col("words")).withColumn(
        "start",
        F.floor(unit_hash(F.lit(mix.seed), "s", "h") * F.greatest(F.ceil(F.col("shard_size") / F.col("words")), F.lit(1)))
        * F.col("words"),
    )
    order = W.partitionBy("source", "shard").orderBy(
        F.xxhash64("doc_id", "digest", F.lit(mix.seed + 1)), "doc_id", "digest"
    )
    placed = dealt.withColumn("until", F.sum("size").over(order.rowsBetween(W.unboundedPreceding, 0)))
    placed = placed.join(
        quotas, F.col("source").eqNullSafe(F.col("s")) & (F.col("shard") == F.col("h"))
    ).withColumn("from_", F.col("until") - F.col("size"))

    def span(copy: int) -> Column:
        begin = F.col("from_") + copy * F.col("shard_size")
        low = F.greatest(begin, F.col("start")) - begin
        high = F.least(begin + F.col("size"), F.col("start") + F.col("length")) - begin
        return F.struct(
            F.lit(copy).alias("copy"), low.cast("long").alias("low"), high.cast("long").alias("high")
        )

    spans = F.filter(F.array(span(0), span(1), span(2)), lambda s: s["high"] > s["low"])
    taken = F.aggregate("spans", F.lit(0).cast("long"), lambda total, s: total + s["high"] - s["low"])
    return placed.withColumn("spans", spans).select(
        "doc_id", "digest", "size", "source", "source_size", "target", taken.alias("taken"), "spans"
    )


def mix_documents(docs: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """The mixed corpus, in the columns of ``docs``: a row for each copy of a document.

    A document taken in part keeps the words of its part with the white space between
    them; one that is not taken goes. Where n_chars is a column it is counted anew.
    """
    d, t, i, s = fresh(docs, "mix_id", "mix_digest", "mix_source", "mix_span")
    taken = (
        plan(docs, mix)
        .where("taken > 0")
        .select(
            F.col("doc_id").alias(d), F.col("digest").alias(t), F.col("source").alias(i), F.col("spans").alias(s), "size"
        )
        .withColumn("turn_", F.row_number().over(W.partitionBy(d, t, i).orderBy("size")))
    )
    turn, size = fresh(docs, "mix_turn", "mix_size")
    taken = taken.withColumnRenamed("turn_", turn).withColumnRenamed("size", size)
    key, digest, source = fresh(docs, "own_id", "own_digest", "own_source")
    marked = docs.withColumns(
        {key: F.col("doc_id").cast("long"), digest: text_digest(), source: F.col("source").cast("string")}
    )
    own_turn = fresh(marked, "own_turn")[0]
    marked = marked.withColumn(
        own_turn, F.row_number().over(W.partitionBy(key, digest, source).orderBy(F.lit(0)))
    )
    joined = marked.join(
        taken,
        F.col(key).eqNullSafe(F.col(d))
        & (F.col(digest) == F.col(t))
        & F.col(source).eqNullSafe(F.col(i))
        & (F.col(own_turn) == F.col(turn)),
    ).withColumn(s, F.explode(s))
    low, high = F.col(s)["low"], F.col(s)["high"]
    # The words of the span with what stands between them: drop `low` words, keep the rest.
    gap = "[\\x20\\x09-\\x0D]"
    whole = (low == 0) & (high == F.col(size))
    words = F.regexp_extract_all("text", F.lit(f"({WORD}{gap}*)"), 1)
    part = F.rtrim(F.array_join(F.slice(words, (low + 1).cast("int"), (high - low).cast("int")), ""))
    text = F.when(whole, F.col("text")).otherwise(part)
    out = joined.withColumn("text", text)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)
