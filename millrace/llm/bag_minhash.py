"""Near-duplicate documents by BagMinHash over multisets of word shingles.

A document is the multiset of its five-word shingles. For every shingle the weights up to
its count are cut into dyadic intervals, and each interval has a Poisson process of its
own: points in time that fall on a random component and, by halving the interval again
and again, on one unit of weight. The signature holds each component's first point below
the shingle's weight; two documents agree in a component with a probability equal to their
weighted Jaccard similarity, whatever the weights. Points beyond a time bound can't be
first, so few are drawn for a shingle of a long document.

Signatures are banded; in a bucket members are compared with leaders, never all with all.
Texts of a bucket that this leaves in different classes are compared where they share one of
their rarest shingles. Every link is verified on the texts' multisets. Equal texts are one vertex.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millrace.llm.common import Memo, arrow_rows, fresh, has_rows, ship, text_digest, text_or_empty
from millrace.llm.graph import components
from millrace.session import Scratch, stored_rows


@dataclass(frozen=True)
class Near:
    """A pair at 0.8 shares a bucket with probability 1 - (1 - 0.8**rows)**bands: 0.999996."""

    similarity: float = 0.8
    shingle: int = 5
    bands: int = 24
    rows: int = 4
    leaders: int = 1  # of a bucket


#: Shingles that a task holds at once, beyond those of one text: it bounds the memory of a Python worker.
TOGETHER = 50_000

_GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer (splitmix): every bit of the input moves every bit of the output."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _times(n: int, factor: int = 0x9E3779B97F4A7C15) -> np.uint64:
    return np.uint64(n * factor % (1 << 64))


def word_hash(word: str) -> int:
    return xxhash.xxh3_64_intdigest(word.encode("utf-8", "surrogatepass"))


def shingle_hashes(words: np.ndarray, shingle: int) -> np.ndarray:
    """Hashes of the word runs; a text of fewer words is one run of all its words."""
    n = max(len(words) - shingle + 1, 1)
    total = np.full(n, len(words) if len(words) < shingle else shingle, dtype=np.uint64)
    for k in range(min(shingle, len(words))):
        total = _mix(total * _GOLDEN + words[k : k + n])
    return total


def bag_of(text: str, memo: Memo, shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes, ascending, and their counts."""
    words = text.split()
    hashes = np.fromiter(map(memo.__getitem__, words), dtype=np.uint64, count=len(words))
    return np.unique(shingle_hashes(hashes, shingle), return_counts=True)


def signatures(items: np.ndarray, weights: np.ndarray, of: np.ndarray, docs: int, size: int) -> np.ndarray:
    """BagMinHash signatures of ``docs`` documents at once.

    ``items``: shingle hashes with ``weights`` (counts), each belonging to document ``of``.
    """
    signature = np.full((docs, size), np.inf)
    mass = np.bincount(of, weights, docs)
    todo = np.arange(docs)
    bound = (np.log(size) + 3.0) / np.maximum(mass, 1e-9)
    while len(todo):
        chosen = np.zeros(docs, dtype=bool)
        chosen[todo] = True
        live = chosen[of]
        _draw(signature, items[live], weights[live], of[live], bound, size)
        # A component without a point yet may have its first beyond the bound: look further.
        todo = todo[np.isinf(signature[todo]).any(axis=1)]
        signature[todo] = np.inf
        bound[todo] *= 2.0
    return signature


def _draw(signature, items, weights, of, bound, size) -> None:
    """Marks the points up to each document's time bound."""
    base, wide, level = 0, 1, 0  # the weight interval (base, base + wide]
    while len(items):
        stream = _mix(items + _times(level))
        time = np.zeros(len(items))
        own, step = np.arange(len(items)), 0
        while len(own):
            step += 1
            drawn = _mix(stream[own] + _times(step))
            unit = ((drawn >> np.uint64(11)).astype(np.float64) + 0.5) / float(1 << 53)
            time[own] -= np.log(unit) / (size * wide)
            own = own[time[own] <= bound[of[own]]]
            if not len(own):
                break
            more = _mix(stream[own] ^ _times(step, 0xD6E8FEB86659FD93))
            place = (more % np.uint64(size)).astype(np.int64)
            if wide > 1:
                # Halving the interval level times is reading level bits: the unit the point falls on.
                unit_at = base + ((more >> np.uint64(40)) % np.uint64(wide)).astype(np.int64)
                below = unit_at < weights[own]
                np.minimum.at(signature, (of[own][below], place[below]), time[own][below])
            else:
                np.minimum.at(signature, (of[own], place), time[own])
        base += wide
        wide = 1 if level == 0 else wide * 2
        level += 1
        keep = weights > base
        items, weights, of = items[keep], weights[keep], of[keep]


def _bands(signature: np.ndarray, near: Near) -> np.ndarray:
    """One hash for each band, with the band's number in it."""
    bits = signature.view(np.uint64).reshape(len(signature), near.bands, near.rows)
    total = np.broadcast_to(np.arange(1, near.bands + 1, dtype=np.uint64), bits.shape[:2]) * _GOLDEN
    for k in range(near.rows):
        total = _mix(total ^ bits[:, :, k]) + _GOLDEN
    return total.view(np.int64)


def signature_bands(texts: DataFrame, near: Near) -> DataFrame:
    """(v, bands) for (v, text); a text that a task has just seen is passed over."""
    size = near.bands * near.rows

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        memo, seen = Memo(word_hash, 100_000), set()

        def signed(keys: list, bags: list) -> pd.DataFrame:
            of = np.repeat(np.arange(len(bags)), [len(b[0]) for b in bags])
            items = np.concatenate([b[0] for b in bags])
            weights = np.concatenate([b[1] for b in bags])
            found = _bands(signatures(items, weights, of, len(bags), size), near)
            return pd.DataFrame({"v": keys, "bands": list(found)})

        for batch in batches:
            keys, bags, held = [], [], 0
            for v, text in zip(batch["v"], batch["text"], strict=True):
                v = bytes(v)
                if v in seen:
                    continue
                if len(seen) >= 20_000:
                    seen.clear()
                seen.add(v)
                keys.append(v)
                bags.append(bag_of(text, memo, near.shingle))
                held += len(bags[-1][0])
                # Texts are signed together up to so many shingles, since long ones take much memory.
                if held >= TOGETHER or len(keys) >= 200:
                    yield signed(keys, bags)
                    keys, bags, held = [], [], 0
            if keys:
                yield signed(keys, bags)

    return texts.mapInPandas(run, "v binary, bands array<long>")


def overlap(a: Counter, b: Counter) -> float:
    """Weighted Jaccard similarity of two multisets."""
    if len(a) > len(b):
        a, b = b, a
    both = sum(min(n, b[x]) for x, n in a.items() if x in b)
    return both / (a.total() + b.total() - both)


def _shingles(text: str, shingle: int) -> Counter:
    words = text.split()
    return Counter(zip(*(words[k:] for k in range(shingle)), strict=False)) if len(words) >= shingle else Counter([tuple(words)])


def verified(pairs: DataFrame, texts: DataFrame, near: Near) -> DataFrame:
    """(a, b, similarity) of all ``pairs``, on the whole texts."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bags: dict[str, Counter] = {}

        def bag(text: str) -> Counter:
            if text not in bags:
                if sum(map(len, bags.values())) >= TOGETHER:
                    bags.clear()
                bags[text] = _shingles(text, near.shingle)
            return bags[text]

        for batch in batches:
            found = [
                overlap(bag(x), _shingles(y, near.shingle))
                for x, y in zip(batch["text_a"], batch["text_b"], strict=True)
            ]
            yield pd.DataFrame({"a": batch["a"], "b": batch["b"], "similarity": found})

    first = pairs.join(texts.select(F.col("v").alias("b"), F.col("text").alias("text_b")), "b")
    both = first.join(texts.select(F.col("v").alias("a"), F.col("text").alias("text_a")), "a")
    return both.mapInPandas(run, "a binary, b binary, similarity double")


def solitary(texts: DataFrame, near: Near) -> DataFrame:
    """(v) of the texts too much of which no other of ``texts`` has for any pair to reach the similarity.

    Shingles found in one text alone are no overlap with any other, so the similarity of a text
    to all others is at most the rest of its weight over its weight. Hashes that collide only
    make a shingle look shared. Counts are folded in each task before the shuffle.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        memo = Memo(word_hash, 100_000)
        for batch in batches:
            for v, text in zip(batch["v"], batch["text"], strict=True):
                items, weights = bag_of(text, memo, near.shingle)
                for k in range(0, len(items), 100_000):
                    part = slice(k, k + 100_000)
                    yield pd.DataFrame(
                        {"item": items[part].view(np.int64), "v": [v] * len(items[part]), "weight": weights[part]}
                    )

    def weigh(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            total = [max(len(text.split()) - near.shingle + 1, 1) for text in batch["text"]]
            yield pd.DataFrame({"v": batch["v"], "total": total})

    shingles = texts.mapInPandas(run, "item long, v binary, weight long")
    own = (
        shingles.groupBy("item")
        .agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("v"), F.min("weight").alias("weight"))
        .where("n = 1")
        .groupBy("v")
        .agg(F.sum("weight").alias("own"))
    )
    total = texts.mapInPandas(weigh, "v binary, total long")
    return own.join(total, "v").where(1 - F.col("own") / F.col("total") < near.similarity - 1e-9).select("v")


def tokens(texts: DataFrame, near: Near) -> DataFrame:
    """(token, v, size): a row for each unit of a text's weight, so that texts are sets; size is their number."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        memo = Memo(word_hash, 100_000)
        for batch in batches:
            for v, text in zip(batch["v"], batch["text"], strict=True):
                items, weights = bag_of(text, memo, near.shingle)
                ends = np.cumsum(weights)
                size = int(ends[-1])
                for k in range(0, size, 100_000):
                    at = np.arange(k, min(k + 100_000, size))
                    which = np.searchsorted(ends, at, side="right")
                    copy = (at - (ends - weights)[which]).astype(np.uint64)
                    found = np.where(copy == 0, items[which], _mix(items[which] ^ (copy * _GOLDEN)))
                    yield pd.DataFrame({"token": found.view(np.int64), "v": [v] * len(at), "size": size})

    return texts.mapInPandas(run, "token long, v binary, size long")


def links(docs: DataFrame, near: Near = Near()) -> DataFrame:
    """``_links``, with few rows at once sent to Python workers: all of it is run before this returns."""
    with arrow_rows(docs.sparkSession, 500, 4 << 20), Scratch(docs.sparkSession) as scratch:
        return stored_rows(_links(docs, near, scratch))


def _links(docs: DataFrame, near: Near, scratch: Scratch) -> DataFrame:
    """Verified links (a, b) that join all vertices of a class; vertices are text digests.

    The members of a bucket are compared with its leaders, which joins most of a group at
    once. What may still link texts of one bucket but of different classes is found by
    ``_across``, which does not depend on how many members a bucket has. Texts that can have
    no link are set aside beforehand.
    """
    ship(docs.sparkSession)
    texts = docs.select(text_digest().alias("v"), text_or_empty().alias("text"))
    banded = signature_bands(texts, near)
    buckets = banded.groupBy("v").agg(F.min("bands").alias("bands")).select("v", F.explode("bands").alias("bucket"))
    buckets = scratch.keep(buckets)
    shared = buckets.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    sized = scratch.keep(buckets.join(shared, "bucket"))
    # A text that others are copies of meets more of them than they meet each other, so it
    # leads its buckets and takes them all; led by a copy, a group would fall to pieces.
    met = sized.groupBy("v").agg(F.sum("n").alias("met"))
    members = scratch.keep(sized.join(met, "v").select("bucket", "v", "met"))
    needed = scratch.keep(
        texts.join(members.select("v").distinct(), "v", "left_semi").groupBy("v").agg(F.min("text").alias("text"))
    )
    alone = scratch.keep(solitary(needed, near))
    members = members.join(alone, "v", "left_anti").withColumn("root", F.col("v"))
    members = scratch.keep(_of_several_classes(members))
    # Each task keeps as many rows of a bucket as there are leaders, before the shuffle.
    turn = F.row_number().over(W.partitionBy("bucket").orderBy(F.desc("met"), F.xxhash64("v", "bucket"), "v"))
    heads = members.withColumn("turn", turn).where(F.col("turn") <= near.leaders)
    heads = heads.select("bucket", F.col("v").alias("a"))
    faced = members.select("bucket", "v").join(heads, "bucket").where("v != a")
    pairs = faced.select(F.least("a", "v").alias("a"), F.greatest("a", "v").alias("b")).distinct()
    done = scratch.keep(verified(pairs, needed, near))
    close = done.where(F.col("similarity") >= near.similarity).select("a", "b")
    root = components(close)
    rest = members.select("bucket", "v").join(root, F.col("v") == F.col("node"), "left").select(
        "bucket", "v", F.coalesce("component", "v").alias("root")
    )
    rest = scratch.keep(_of_several_classes(rest).select("v", "root").distinct())
    if not has_rows(rest):
        return close
    pairs = _across(rest, needed, near, scratch).join(done.select("a", "b"), ["a", "b"], "left_anti")
    news = verified(pairs, needed, near).where(F.col("similarity") >= near.similarity)
    return close.unionByName(news.select("a", "b"))


def _of_several_classes(members: DataFrame) -> DataFrame:
    """The members of the buckets that do not lie in one class as a whole."""
    mixed = members.groupBy("bucket").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low != high")
    return members.join(mixed.select("bucket"), "bucket", "left_semi")


#: Sizes are told apart in steps of two per cent.
_STEPS = 50


def _across(rooted: DataFrame, texts: DataFrame, near: Near, scratch: Scratch) -> DataFrame:
    """Pairs (a, b) of texts of different classes, among them all that are near; ``rooted`` is (v, root).

    Tokens are ordered from rare to common. The overlap of two texts is at most what either
    has from their first common token on, and has to be a given part of both sizes, so only
    the rarest tokens of a text can be the first ones of a near pair: what a group has in
    common brings none of it together, only what few have. Hashes that collide make
    an overlap look larger, never smaller.
    """
    least = near.similarity
    grown = (1 + least) / least  # a near pair's overlap times this is at least the sum of its sizes
    found = scratch.keep(tokens(texts.join(rooted.select("v"), "v", "left_semi"), near))
    counts = found.groupBy("token").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    # Tokens of one text alone come before all others, so those from a token on need no count of them.
    onward = F.row_number().over(W.partitionBy("v").orderBy(F.desc("n"), F.desc("token")))
    prefix = found.join(counts, "token").withColumn("onward", onward).where(F.col("onward") >= least * F.col("size") - 1e-6)
    # The largest size of another text whose first common token with this one may be the token.
    prefix = prefix.withColumn("reach", grown * F.col("onward") - F.col("size") + 1e-6)
    prefix = scratch.keep(prefix.join(rooted, "v").select("token", "v", "root", "size", "reach"))
    # The smaller text of a pair reaches its own size, as the larger one has at least that.
    smaller = F.col("reach") >= F.col("size")
    classes = prefix.groupBy("token", "root").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.when(smaller, F.col("size"))).alias("low")
    )
    classes = classes.groupBy("token").agg(
        F.count(F.lit(1)).alias("classes"), F.max_by("root", F.struct("n", "root")).alias("main"), F.min("low").alias("low")
    )
    classes = classes.where("classes > 1").select("token", "main", "low")
    # Most texts of a token are of one class, and these are not compared with each other.
    kept = prefix.join(classes, "token").where("reach >= low").withColumn("main", F.col("root") == F.col("main"))
    kept = scratch.keep(kept.drop("low"))

    def step(size: Column) -> Column:
        return F.floor(F.log(size) * _STEPS)

    small = kept.where(smaller).withColumn("step", step(F.col("size")))
    small = small.select("token", "step", *[F.col(n).alias(f"a_{n}") for n in ("v", "root", "size", "reach", "main")])
    steps = F.sequence(step(least * F.col("size") - 1e-6), step(F.least("reach", "size")))
    large = kept.withColumn("step", F.explode(steps))

    def met(small: DataFrame, large: DataFrame) -> DataFrame:
        both = small.join(large, ["token", "step"]).where(
            "root != a_root AND a_size <= size AND size <= a_reach AND a_size <= reach"
        )
        return both.select(F.least("a_v", "v").alias("a"), F.greatest("a_v", "v").alias("b"))

    return met(small.where("NOT a_main"), large).union(met(small.where("a_main"), large.where("NOT main"))).distinct()


def _classed(docs: DataFrame, near: Near) -> DataFrame:
    """(v, root, class_id) of every distinct text."""
    root = components(links(docs, near))
    own = docs.select(text_digest().alias("v"), F.col("doc_id").cast("long").alias("doc_id"))
    own = own.groupBy("v").agg(F.min("doc_id").alias("doc_id"))
    own = own.join(root, F.col("v") == F.col("node"), "left").select(
        "v", "doc_id", F.coalesce("component", "v").alias("root")
    )
    own = stored_rows(own)
    classes = own.groupBy("root").agg(F.min("doc_id").alias("class_id"))
    return own.join(classes, "root").select("v", "root", "class_id")


def near_duplicates(docs: DataFrame, near: Near = Near()) -> DataFrame:
    """doc_id, class_id and kept, a row for each row of ``docs``.

    class_id is the least doc_id of all documents that links join, directly or over
    others; kept says whether it is the document's own. Null and empty texts are equal
    texts; texts of fewer words than a shingle have one shingle, all their words. A class
    without a doc_id has a null class_id. An empty table gives no rows.
    """
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_digest().alias("v"))
    return own.join(_classed(docs, near), "v").select(
        "doc_id", "class_id", F.col("doc_id").eqNullSafe(F.col("class_id")).alias("kept")
    )


def keep_one(docs: DataFrame, near: Near = Near()) -> DataFrame:
    """One row of each class, that of the least doc_id, in the columns of ``docs``."""
    v, own, root, least, turn = fresh(docs, "near_v", "near_own", "near_root", "near_class", "near_turn")
    classed = _classed(docs, near).select(
        F.col("v").alias(v), F.col("root").alias(root), F.col("class_id").alias(least)
    )
    first = docs.withColumn(own, text_digest()).join(classed, F.col(own) == F.col(v)).where(
        F.col("doc_id").cast("long").eqNullSafe(F.col(least))
    )
    # Only rows that share the least doc_id meet here.
    return (
        first.withColumn(turn, F.row_number().over(W.partitionBy(root).orderBy(own, *docs.columns[:1])))
        .where(F.col(turn) == 1)
        .select(*docs.columns)
    )
