"""Landed connector streams: record extraction, selection and counts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators.mapping import quoted
from millrace.operators.quality import union_all

# JSON schema type names.
_JSON_TYPES = {
    "string": T.StringType(),
    "integer": T.LongType(),
    "number": T.DoubleType(),
    "boolean": T.BooleanType(),
}


def json_schema_type(spec: Mapping[str, object]) -> T.DataType:
    """Spark type of a JSON schema node; ``[type, "null"]`` pairs are understood."""
    kind = spec.get("type", "string")
    if isinstance(kind, (list, tuple)):
        kind = next((k for k in kind if k != "null"), "string")
    if kind == "object":
        return properties_schema(spec.get("properties", {}))
    if kind == "array":
        return T.ArrayType(json_schema_type(spec.get("items", {})))
    return _JSON_TYPES.get(kind, T.StringType())


def properties_schema(properties: Mapping[str, Mapping[str, object]]) -> T.StructType:
    return T.StructType(
        [T.StructField(name, json_schema_type(spec)) for name, spec in properties.items()]
    )


@dataclass(frozen=True)
class Stream:
    """A named record stream: where it landed, its fields, the path to its records."""

    name: str
    path: str
    properties: Mapping[str, Mapping[str, object]] = field(default_factory=dict)
    field_path: Sequence[str] = ()

    def document_schema(self) -> T.StructType:
        record: T.DataType = properties_schema(self.properties)
        if not self.field_path:
            return record
        node: T.DataType = T.ArrayType(record)
        for name in reversed(self.field_path):
            node = T.StructType([T.StructField(name, node)])
        return node


def select_streams(streams: Sequence[Stream], wanted: Sequence[str] | None = None) -> list[Stream]:
    """All streams, or the named ones; an unknown name is an error."""
    if wanted is None:
        return list(streams)
    unknown = set(wanted) - {s.name for s in streams}
    if unknown:
        raise ValueError(f"unknown streams: {sorted(unknown)}")
    return [s for s in streams if s.name in wanted]


def extract_records(documents: DataFrame, field_path: Sequence[str]) -> DataFrame:
    """One row per record of the array at ``field_path``."""
    if not field_path:
        return documents
    path = ".".join(quoted(p) for p in field_path)
    return documents.select(F.explode(F.col(path)).alias("r")).select("r.*")


def read_stream(spark: SparkSession, stream: Stream) -> DataFrame:
    documents = spark.read.schema(stream.document_schema()).json(stream.path)
    return extract_records(documents, stream.field_path)


def record_counts(records: Mapping[str, DataFrame]) -> DataFrame:
    """``stream, n_records`` for every stream, empty ones included."""
    return union_all(
        df.agg(F.count("*").alias("n_records")).select(F.lit(name).alias("stream"), "n_records")
        for name, df in records.items()
    )


def counts_by_stream(records: DataFrame, stream: str) -> DataFrame:
    """Counts of a frame that holds several streams, told apart by a column."""
    return records.groupBy(F.col(quoted(stream)).alias("stream")).agg(
        F.count("*").alias("n_records")
    )


def total_processed(counts: DataFrame) -> DataFrame:
    return counts.agg(F.sum("n_records").alias("total_processed"))
