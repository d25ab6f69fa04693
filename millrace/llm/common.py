"""Small helpers the operators of this subpackage share."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.session import has_rows  # noqa: F401

# White space of the word count that sizes are stated in (fixed: space, tab to carriage return).
WORD = "[^\\x20\\x09-\\x0D]+"


def fresh(df: DataFrame, *names: str) -> list[str]:
    """The names, lengthened by underscores until none is a column of ``df``."""
    taken = {c.lower() for c in df.columns}
    found = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        found.append(name)
    return found


def text_or_empty(column: str | Column = "text") -> Column:
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def text_digest(column: str | Column = "text") -> Column:
    """16 bytes that stand for the text; a null text is the empty text."""
    return F.unhex(F.md5(text_or_empty(column)))


def unit_hash(*parts: Column | str) -> Column:
    """A number in [0, 1) from 52 bits of the parts' hash; the same on every machine."""
    return F.shiftrightunsigned(F.xxhash64(*parts), 12) / F.lit(float(1 << 52))


class Memo(dict):
    """Results by key, computed on first use; emptied when it holds ``limit`` keys.

    Python workers keep it between tasks, so its size is what bounds their memory.
    """

    def __init__(self, make: Callable, limit: int = 300_000) -> None:
        super().__init__()
        self.make, self.limit = make, limit

    def __missing__(self, key):
        if len(self) >= self.limit:
            self.clear()
        value = self[key] = self.make(key)
        return value


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Sends this package to the session's Python workers, once for each application.

    Functions that run in tasks are found by module name there, also where the package is
    not installed on the machines.
    """
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    import millrace

    top = os.path.dirname(os.path.abspath(millrace.__file__))
    folder = tempfile.mkdtemp(prefix="millrace-code-")
    path = os.path.join(folder, "millrace_code.zip")
    with zipfile.ZipFile(path, "w") as archive:
        for where, _, names in os.walk(top):
            for name in sorted(n for n in names if n.endswith(".py")):
                file = os.path.join(where, name)
                archive.write(file, os.path.relpath(file, os.path.dirname(top)))
    context.addPyFile(path)
    _SHIPPED.add(context.applicationId)


@contextmanager
def settings(spark: SparkSession, keys: dict[str, str]) -> Iterator[None]:
    """Runtime settings that hold within the ``with`` block."""
    before = {key: spark.conf.get(key) for key in keys}
    for key, value in keys.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def arrow_rows(spark: SparkSession, rows: int, bytes_: int = 32 << 20):
    """Sends at most so many rows at once to Python workers, and about so many bytes."""
    return settings(
        spark,
        {
            "spark.sql.execution.arrow.maxRecordsPerBatch": str(rows),
            "spark.sql.execution.arrow.maxBytesPerBatch": str(bytes_),
        },
    )
