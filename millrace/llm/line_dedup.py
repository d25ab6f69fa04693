"""Removal of lines that repeat across sites.

A HyperLogLog sketch per line hash holds the sites a line was seen on; sketches merge by
aggregation, in each task before the shuffle. A line whose estimate lies near its
threshold is counted exactly. Lines on as many sites or more are cross-site boilerplate:
one holder keeps the line, all others lose it.

Short lines come up on several sites by chance (a heading, a bracket, a greeting), so they
need more sites. A line of ``long_line`` characters does not: three sites that hold it
have copied it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import fresh, text_digest, text_or_empty
from millrace.session import stored_rows


@dataclass(frozen=True)
class Spread:
    """``log_k``: 2**log_k registers, a relative error of 1.04 / sqrt(2**log_k).
    ``margin``: estimates within this part of the threshold are counted exactly.
    Lines of ``long_line`` characters or more count from ``long_sites`` sites, if that is fewer."""

    min_sites: int = 10
    long_sites: int = 3
    long_line: int = 100
    log_k: int = 8
    margin: float = 0.25


def line_key(line: Column, long_line: int = Spread.long_line) -> Column:
    """Lines are compared trimmed; 0 stands for an empty line, which is never counted.

    The lowest bit tells long lines, so that the threshold follows from the key.
    """
    trimmed = F.btrim(line, F.lit(" \t\r"))
    is_long = (F.length(trimmed) >= long_line).cast("long")
    marked = F.shiftleft(F.shiftright(F.xxhash64(trimmed), 1), 1).bitwiseOR(is_long)
    return F.when(F.length(trimmed) == 0, F.lit(0).cast("long")).otherwise(marked)


def _lines(docs: DataFrame, spread: Spread = Spread()) -> DataFrame:
    """(doc_id, digest, site, hashes): the hashes of a document's lines, in order."""
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        text_digest().alias("digest"),
        # Sketches pass over empty texts, so no site is one.
        F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit("-")).alias("site"),
        F.transform(F.split(text_or_empty(), "\n"), lambda x: line_key(x, spread.long_line)).alias("hashes"),
    )


def site_spread(lines: DataFrame, spread: Spread = Spread()) -> DataFrame:
    """(line, sites) of the lines on enough sites; sites is exact near the threshold."""
    seen = lines.select(F.explode(F.array_distinct("hashes")).alias("line"), "site").where("line != 0")
    # A sketch a line is built in each task, whatever number of rows holds the line there.
    sketched = seen.groupBy("line").agg(F.hll_sketch_agg("site", F.lit(spread.log_k)).alias("sketch"))
    long_sites = min(spread.long_sites, spread.min_sites)
    needed = F.when(F.col("line").bitwiseAND(F.lit(1)) == 1, long_sites).otherwise(spread.min_sites)
    guess = sketched.select("line", F.hll_sketch_estimate("sketch").alias("sites")).where(
        F.col("sites") >= needed * (1 - spread.margin)
    )
    guess = stored_rows(guess)
    sure = guess.where(F.col("sites") > needed * (1 + spread.margin))
    near = guess.where(F.col("sites") <= needed * (1 + spread.margin)).select("line")
    exact = (
        seen.join(near, "line", "left_semi")
        .distinct()
        .groupBy("line")
        .agg(F.count(F.lit(1)).alias("sites"))
        .where(F.col("sites") >= needed)
    )
    return sure.unionByName(exact)


def boilerplate(docs: DataFrame, spread: Spread = Spread()) -> DataFrame:
    """(doc_id, digest, dropped): positions, from 0, of the lines a document loses.

    The one that keeps a line is its first place in the document with the lowest
    (doc_id, digest). Rows with equal doc_id and text are one document.
    """
    lines = stored_rows(_lines(docs, spread))
    spread_lines = stored_rows(site_spread(lines, spread).select("line"))
    places = lines.select(
        F.coalesce("doc_id", F.lit(-(1 << 63))).alias("doc_id"), "digest", F.posexplode("hashes").alias("at", "line")
    )
    held = places.join(spread_lines, "line").groupBy("line", "doc_id", "digest").agg(
        F.array_sort(F.collect_set("at")).alias("places")
    )
    held = stored_rows(held)
    keeper = held.groupBy("line").agg(F.min(F.struct("doc_id", "digest")).alias("keeper"))
    lost = held.join(keeper, "line").select(
        "doc_id",
        "digest",
        F.when(
            F.struct("doc_id", "digest") == F.col("keeper"), F.expr("slice(places, 2, size(places))")
        ).otherwise(F.col("places")).alias("places"),
    )
    return (
        lost.where(F.size("places") > 0)
        .groupBy("doc_id", "digest")
        .agg(F.flatten(F.collect_list("places")).alias("dropped"))
    )


def dedup_lines(docs: DataFrame, spread: Spread = Spread()) -> DataFrame:
    """``docs`` without cross-site boilerplate lines, in the same columns and rows.

    A site is a source (null: one of its own). Needs doc_id, text and source. A null text
    stays null, a text without boilerplate stays as it is, and a text that is all
    boilerplate becomes empty. Rows with equal doc_id and text are one document; null
    doc_ids come first when the keeper is chosen. Where n_chars is a column it is counted
    anew for changed texts. An empty table gives no rows.
    """
    i, t, d, own_i, own_t = fresh(docs, "ld_id", "ld_digest", "ld_dropped", "ld_own_id", "ld_own_digest")
    gone = boilerplate(docs, spread).select(
        F.col("doc_id").alias(i), F.col("digest").alias(t), F.col("dropped").alias(d)
    )
    marked = docs.withColumns(
        {own_i: F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))), own_t: text_digest()}
    )
    joined = marked.join(gone, (F.col(own_i) == F.col(i)) & (F.col(own_t) == F.col(t)), "left")
    kept = F.filter(F.split("text", "\n"), lambda _, at: ~F.array_contains(F.col(d), at))
    changed = F.col(d).isNotNull() & F.col("text").isNotNull()
    out = joined.withColumn("text", F.when(changed, F.array_join(kept, "\n")).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn(
            "n_chars", F.when(changed, F.length("text").cast(kind)).otherwise(F.col("n_chars"))
        )
    return out.select(*docs.columns)


#: DuckDB SQL for the columns doc_id and text, at the default thresholds.
ORACLE = r"""
WITH lines AS (
    SELECT d.doc_id, d.text, coalesce('=' || d.source, '-') AS site,
           unnest(string_split(d.text, chr(10))) AS raw,
           generate_subscripts(string_split(d.text, chr(10)), 1) AS place
    FROM documents d WHERE d.text IS NOT NULL
), keyed AS (
    SELECT *, trim(raw, ' ' || chr(9) || chr(13)) AS line FROM lines
), wide AS (
    SELECT line FROM keyed WHERE line <> '' GROUP BY line
    HAVING count(DISTINCT site) >= CASE WHEN length(line) >= 100 THEN 3 ELSE 10 END
), ranked AS (
    SELECT k.doc_id, k.text, k.place,
           row_number() OVER (PARTITION BY line ORDER BY doc_id NULLS FIRST, md5(text), place) AS turn
    FROM keyed k JOIN wide USING (line)
), gone AS (
    SELECT doc_id, text, place FROM ranked WHERE turn > 1
), kept AS (
    SELECT k.doc_id, k.text, string_agg(k.raw, chr(10) ORDER BY k.place) AS left_over
    FROM keyed k ANTI JOIN gone g ON k.doc_id = g.doc_id AND k.text = g.text AND k.place = g.place
    GROUP BY k.doc_id, k.text
)
SELECT d.doc_id, CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(k.left_over, '') END AS text
FROM documents d LEFT JOIN kept k ON k.doc_id = d.doc_id AND k.text = d.text
"""
