"""From raw documents to packed training sequences, stage by stage.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; its result is written as
Parquet and read again as the next one's ``docs``. All but the last return documents in
the columns they came in.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from millrace.llm import bag_minhash, crf_quality, line_dedup, mixing, packing
from millrace.session import stored_rows, tune


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose lines a conditional random field takes for good."""
    return crf_quality.keep_good(docs, tune(spark).read.parquet(f"{sf_dir}/labels.parquet"))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without lines that repeat across sources."""
    tune(spark)
    return line_dedup.dedup_lines(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    tune(spark)
    return bag_minhash.keep_one(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at their target weights; a document taken twice is two rows."""
    tune(spark)
    return mixing.mix_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents, placed in sequences."""
    tune(spark)
    return packing.pack_documents(docs, tokenizer_path())


STAGES = [("quality", quality), ("line_dedup", lines), ("near_dedup", near), ("mixing", mix), ("packing", pack)]

#: SQL can express neither the random field nor the tokens.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = tune(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = stored_rows(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
