"""Bottom-k fingerprints of documents: the k least hashes of their word shingles.

Two fingerprints of parts merge into that of the whole by keeping the k least of their
union, and estimate resemblance, containment and the number of distinct shingles. All of
it is built from Spark's own functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millrace.llm.common import fresh, text_or_empty
from millrace.session import stored_rows

K = 128
SHINGLE = 5  # words


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(text, "\\s+"), "")


def sketch_of_words(words: Column, k: int = K, shingle: int = SHINGLE) -> Column:
    """Ascending distinct hashes, k at most. Up to ``shingle`` words, none included, are one shingle.

    ``words`` is looked up for every shingle: pass a column that holds them.
    """
    last = F.greatest(F.size(words) - F.lit(shingle - 1), F.lit(1))
    hashes = F.transform(F.sequence(F.lit(1), last), lambda i: F.xxhash64(F.slice(words, i, shingle)))
    return F.slice(F.sort_array(F.array_distinct(hashes)), 1, k)


def with_sketch(df: DataFrame, text: str, out: str) -> DataFrame:
    """``df`` with the fingerprint of a text column as one more column."""
    words = fresh(df, "words_")[0]
    split = df.withColumn(words, words_of(F.col(text)))
    return split.withColumn(out, sketch_of_words(F.col(words))).drop(words)


def merged(a: Column, b: Column, k: int = K) -> Column:
    """The fingerprint of two parts together."""
    return F.slice(F.sort_array(F.array_union(a, b)), 1, k)


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """Estimated Jaccard similarity of the shingle sets: the share of the k least of the union in both."""
    union = merged(a, b, k)
    shared = F.size(F.array_intersect(union, F.array_intersect(a, b)))
    return F.when(F.size(union) == 0, F.lit(1.0)).otherwise(shared / F.size(union))


def distinct_shingles(a: Column, k: int = K) -> Column:
    """Estimated number of distinct shingles; exact below k."""
    place = (F.element_at(a, k).cast("double") + F.lit(2.0**63)) / F.lit(2.0**64)
    return F.when(F.size(a) < k, F.size(a).cast("double")).otherwise((k - 1) / place)


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of a's shingles that b has too."""
    r = resemblance(a, b, k)
    both = distinct_shingles(merged(a, b, k), k) * r
    return F.least(both / F.greatest(distinct_shingles(a, k), F.lit(1.0)), F.lit(1.0))


def as_text(sketch: Column) -> Column:
    """The fingerprint as base64 of its hashes, big-endian."""
    return F.base64(F.unhex(F.array_join(F.transform(sketch, lambda h: F.lpad(F.hex(h), 16, "0")), "")))


def merge_sketches(df: DataFrame, keys: list[str], sketch: str, k: int = K) -> DataFrame:
    """One fingerprint for each key from those of its parts.

    Each task first keeps the k least hashes it has of a key, so a key with very many
    parts sends k hashes a task.
    """
    hashes = df.select(*keys, F.explode(sketch).alias("hash_")).distinct()
    least = W.partitionBy(*keys).orderBy("hash_")
    return (
        hashes.withColumn("turn_", F.row_number().over(least))
        .where(F.col("turn_") <= k)
        .groupBy(*keys)
        .agg(F.sort_array(F.collect_list("hash_")).alias(sketch))
    )


def with_next(docs: DataFrame, rows: int = 2000, most_parts: int = 2000) -> DataFrame:
    """doc_id, text, fingerprint and those of the next row by doc_id (after the last: the first).

    Rows are cut by doc_id into parts of about ``rows`` (``most_parts`` parts at most, then
    parts grow); the order is kept within parts and stitched together at their first rows.
    Null ids come last, equal ids in the order of their texts.
    """
    own = stored_rows(docs.select(F.col("doc_id").cast("long").alias("doc_id")))
    n = max(1, min(most_parts, own.count() // rows))
    cuts = own.approxQuantile("doc_id", [i / n for i in range(1, n)], 0.1 / n) if n > 1 else []
    # Sorted cuts of bounded number; the last part is for null ids.
    edges = F.array(*[F.lit(int(c)).cast("long") for c in sorted(set(cuts))]).cast("array<long>")
    part = F.when(F.col("doc_id").isNull(), F.lit(n + 1)).otherwise(
        F.size(F.filter(edges, lambda e: e <= F.col("doc_id")))
    )
    dealt = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text")
    ).withColumn("part", part)
    in_part = W.partitionBy("part").orderBy("doc_id", "text")
    heads = (
        dealt.withColumn("turn", F.row_number().over(in_part))
        .where("turn = 1")
        .select("part", F.col("text").alias("head"))
    )
    heads = stored_rows(heads)
    # At most most_parts + 1 numbers, in one task: which part follows which.
    ring = heads.select("part").select(
        F.col("part").alias("of"),
        F.coalesce(F.lead("part").over(W.orderBy("part")), F.min("part").over(W.partitionBy())).alias("then"),
    )
    after = ring.join(heads, F.col("then") == F.col("part")).select("of", F.col("head").alias("after"))
    sketched = with_sketch(dealt.repartition("part"), "text", "sketch")
    followed = sketched.withColumns(
        {"next_text": F.lead("text").over(in_part), "next_sketch": F.lead("sketch").over(in_part)}
    )
    after = with_sketch(after, "after", "after_sketch")
    return followed.join(after, F.col("part") == F.col("of"), "left").select(
        "doc_id",
        "text",
        "sketch",
        F.coalesce("next_text", "after").alias("next_text"),
        F.coalesce("next_sketch", "after_sketch").alias("next_sketch"),
    )


def fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprints of all texts and of their edited texts, a row for each row of ``docs``.

    The edited text has its last floor(n / 2) code points replaced by the first as many of
    the next document. A null text is an empty one, whose one shingle has no words; a null
    doc_id comes last; an empty table gives no rows. Only doc_id and text are read.
    """
    rows = with_next(docs).withColumn("n_chars", F.length("text"))
    half = F.floor(F.col("n_chars") / 2).cast("int")
    edited = F.concat(
        F.substring(F.col("text"), F.lit(1), F.col("n_chars") - half), F.substring(F.col("next_text"), F.lit(1), half)
    )
    rows = with_sketch(rows.withColumn("edited", edited), "edited", "edited_sketch")
    return rows.select(
        "doc_id",
        F.col("n_chars").cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        as_text(F.col("sketch")).alias("fingerprint"),
        as_text(F.col("edited_sketch")).alias("edited_fingerprint"),
        resemblance(F.col("sketch"), F.col("edited_sketch")).alias("near_edited"),
        resemblance(F.col("sketch"), F.col("next_sketch")).alias("near_next"),
        distinct_shingles(F.col("sketch")).alias("shingles"),
        containment(F.col("sketch"), F.col("edited_sketch")).alias("contained_in_edited"),
    )
