"""Splitting wide sheets into the tables that lie side by side in them."""

from __future__ import annotations

import re
from collections import Counter
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators.mapping import quoted

UNNAMED = "Unnamed:"


def table_columns(columns: list[str]) -> dict[int, list[str]]:
    """Column names per table, numbered from 1; blank columns separate tables."""
    tables: dict[int, list[str]] = {}
    open_table = False
    for name in columns:
        if name.startswith(UNNAMED):
            open_table = False
        elif open_table:
            tables[len(tables)].append(name)
        else:
            tables[len(tables) + 1] = [name]
            open_table = True
    return tables


def plain_names(columns: list[str]) -> dict[str, str]:
    """Names without the number that told repeated headings apart, where that leaves them distinct."""
    plain = {c: re.sub(r"\.\d+$", "", c) for c in columns}
    times = Counter(plain.values())
    return {c: p if times[p] == 1 else c for c, p in plain.items()}


def split_wide(df: DataFrame, sheet: str = "", *, keep_empty: bool = False) -> dict[str, DataFrame]:
    """Tables of a sheet as ``{sheet}_table_{n}``.

    Rows that are blank in all columns of a table are dropped. A table without
    rows is left out; looking for its first row costs one short job per table.
    A sheet without blank columns is one table, returned as it is.
    """
    if not any(c.startswith(UNNAMED) for c in df.columns):
        return {f"{sheet}_table_1": df}
    found = {}
    for number, columns in table_columns(df.columns).items():
        names = plain_names(columns)
        filled = reduce(lambda a, b: a | b, [F.col(quoted(c)).isNotNull() for c in columns])
        table = df.where(filled).select(*[F.col(quoted(c)).alias(names[c]) for c in columns])
        if keep_empty or not table.isEmpty():
            found[f"{sheet}_table_{number}"] = table
    return found
