"""Helper the test modules share; not in ``conftest``, a name that the folders below use too."""

from __future__ import annotations


def as_set(df, *columns):
    rows = df.select(*columns) if columns else df
    return {tuple(r) for r in rows.collect()}
