"""File sources: columnar, delimited, seeds and spreadsheet bytes."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

SheetParser = Callable[[bytes, str, Sequence[str] | None], Iterable[tuple[str, pd.DataFrame]]]


def scan_columnar(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def text_columns(names: Sequence[str]) -> T.StructType:
    """All-text schema, for files whose values are coerced later."""
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


def scan_delimited(
    spark: SparkSession, path: str, schema: T.StructType, *, separator: str = ","
) -> DataFrame:
    """Delimited text with one header line per file.

    A short line is filled up with nulls and surplus fields are dropped. The
    schema is given, so the files are read once, and in splits.
    """
    return spark.read.csv(
        path, schema=schema, header=True, sep=separator, mode="PERMISSIVE", enforceSchema=True
    )


def load_seed(
    spark: SparkSession, path: str, schema: T.StructType, table: str
) -> DataFrame:
    """Replace a reference table by a delimited file."""
    scan_delimited(spark, path, schema).write.mode("overwrite").saveAsTable(table)
    return spark.table(table)


def scan_sheets(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    parser: SheetParser,
    sheets: Sequence[str] | None = (),
) -> DataFrame:
    """Rows of spreadsheet files, with ``file`` and ``sheet`` columns.

    ``sheets``: names to read, ``None`` for all, empty for the first one. Files
    are spread over tasks and each is parsed by one; ``parser(data, path, names)``
    yields a sheet name and a frame at a time, so one sheet is in memory.
    """
    names = [f.name for f in schema]
    out = T.StructType(
        [T.StructField("file", T.StringType()), T.StructField("sheet", T.StringType()), *schema]
    )
    wanted = None if not sheets else list(sheets)
    first_only = sheets is not None and not sheets

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for file, content in zip(batch["path"], batch["content"], strict=True):
                for sheet, frame in parser(bytes(content), file, wanted):
                    if wanted is None or sheet in wanted:
                        kept = frame.reindex(columns=names)
                        kept.insert(0, "sheet", sheet)
                        kept.insert(0, "file", file)
                        yield kept.astype(object)
                    if first_only:
                        break

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInPandas(rows, out)


def first_rows(df: DataFrame, n: int) -> DataFrame:
    """A preview."""
    return df.limit(n)
