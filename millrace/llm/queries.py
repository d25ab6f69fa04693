"""The registered queries of this subpackage, and the SQL that checks them where SQL can."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from millrace.llm import (
    bag_minhash,
    bottom_k,
    crf_quality,
    grid_join,
    html_text,
    line_dedup,
    mixing,
    packing,
    phrases,
    surrogates,
    toxicity,
    warc,
    whitening,
)
from millrace.session import tune


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return tune(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_lines(_table(spark, sf_dir, "documents")).select("doc_id", "text")


def op2_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.plan(_table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken", "source"
    )


def op3_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return surrogates.replace_entities(docs, key="millrace")


def op4_crf_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return crf_quality.classify(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op6_vector_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(_table(spark, sf_dir, "documents"), corpus_pipeline.tokenizer_path())


def op7_bottom_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bottom_k.fingerprints(_table(spark, sf_dir, "documents"))


def op8_bag_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bag_minhash.near_duplicates(_table(spark, sf_dir, "documents"))


def op9_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract_text(_table(spark, sf_dir, "pages"))


def op10_grid_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grid_join.near_vectors(_table(spark, sf_dir, "embeddings"))


def op11_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_pages(_table(spark, sf_dir, "pages"))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(_table(spark, sf_dir, "embeddings"))


def op13_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(_table(spark, sf_dir, "documents")).drop("doc_id")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    q.__name__: q
    for q in (
        op1_line_dedup,
        op2_source_mixing,
        op3_surrogates,
        op4_crf_quality,
        op5_toxicity,
        op6_vector_packing,
        op7_bottom_k,
        op8_bag_minhash,
        op9_html_text,
        op10_grid_join,
        op11_warc,
        op12_whitening,
        op13_phrases,
    )
} | {"pipeline": corpus_pipeline.run}

SQL: dict[str, str] = {
    "op1_line_dedup": line_dedup.ORACLE.strip(),
    "op11_warc": warc.ORACLE.strip(),
    "op13_phrases": phrases.ORACLE.strip(),
}
if corpus_pipeline.ORACLE_SQL:
    SQL["pipeline"] = corpus_pipeline.ORACLE_SQL
