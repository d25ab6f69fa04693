"""Column mapping: renames, projections and identifier clean-up."""

from __future__ import annotations

import re
import warnings
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


@dataclass
class MappingReport:
    missing_sources: list[str] = field(default_factory=list)
    duplicate_targets: list[str] = field(default_factory=list)
    unmapped: list[str] = field(default_factory=list)
    conflicts: list[str] = field(default_factory=list)

    @property
    def is_valid(self) -> bool:
        return not (self.missing_sources or self.duplicate_targets or self.conflicts)

    @property
    def issues(self) -> list[str]:
        texts = {
            "source columns not found": self.missing_sources,
            "duplicate target columns": self.duplicate_targets,
            "unmapped columns clash with targets": self.conflicts,
        }
        return [f"{label}: {', '.join(names)}" for label, names in texts.items() if names]


def check_mapping(mapping: Mapping[str, str], source_columns: Sequence[str]) -> MappingReport:
    """Which parts of a rename mapping cannot work on these columns."""
    targets = list(mapping.values())
    unmapped = [c for c in source_columns if c not in mapping]
    return MappingReport(
        missing_sources=[c for c in mapping if c not in source_columns],
        duplicate_targets=[t for i, t in enumerate(targets) if t in targets[:i]],
        unmapped=unmapped,
        conflicts=[c for c in unmapped if c in set(targets)],
    )


def rename_columns(df: DataFrame, mapping: Mapping[str, str], *, strict: bool = True) -> DataFrame:
    """Rename by mapping; other columns pass through.

    Strict mode rejects an invalid mapping. Lenient mode warns and applies the
    entries whose source column exists.
    """
    if not mapping:
        return df
    report = check_mapping(mapping, df.columns)
    if not report.is_valid:
        message = "invalid column mapping: " + "; ".join(report.issues)
        if strict:
            raise ValueError(message)
        warnings.warn(message, stacklevel=2)
    return df.withColumnsRenamed({s: t for s, t in mapping.items() if s in df.columns})


def check_merge_keys(keys: Sequence[str], mapping: Mapping[str, str] | None) -> None:
    """Merge keys are named as after the mapping."""
    stale = [k for k in keys if mapping and k in mapping and k not in mapping.values()]
    if stale:
        raise ValueError(
            f"merge keys must use mapped names: {', '.join(f'{k} -> {mapping[k]}' for k in stale)}"
        )


def map_columns(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Project to the mapping's targets; unmapped columns are dropped.

    A source name matches exactly, else regardless of case; several matches of
    the second kind are an error. A name with no match gives a null column. An
    empty mapping leaves the frame as it is.
    """
    if not mapping:
        return df
    report = check_mapping(mapping, df.columns)
    if report.duplicate_targets:
        raise ValueError(f"duplicate target columns: {report.duplicate_targets}")
    selected = []
    for source, target in mapping.items():
        found = [source] if source in df.columns else [
            c for c in df.columns if c.lower() == source.lower()
        ]
        if len(found) > 1:
            raise ValueError(f"column {source!r} is ambiguous: {found}")
        if found:
            selected.append(F.col(quoted(found[0])).alias(target))
        else:
            warnings.warn(f"column {source!r} not found; {target!r} is null", stacklevel=2)
            selected.append(F.lit(None).cast("string").alias(target))
    return df.select(*selected)


def clean_identifier(name: str) -> str:
    return re.sub(r"[- ]", "_", name)


def clean_column_names(df: DataFrame) -> DataFrame:
    """``-`` and space become ``_``; a clash that this creates is an error."""
    names = [clean_identifier(c) for c in df.columns]
    clashes = sorted({n for n in names if names.count(n) > 1})
    if clashes:
        raise ValueError(f"column names clash after clean-up: {clashes}")
    return df.toDF(*names)


def snake_case(name: str) -> str:
    """``CustomerName`` -> ``customer_name``."""
    name = re.sub(r"([a-z0-9])([A-Z])", r"\1_\2", clean_identifier(name))
    return re.sub(r"([A-Z]+)([A-Z][a-z])", r"\1_\2", name).lower()


def snake_case_columns(df: DataFrame) -> DataFrame:
    return df.withColumnsRenamed({c: snake_case(c) for c in df.columns})


def table_name(prefix: str, name: str) -> str:
    """Prefixed, cleaned table name."""
    return clean_identifier(f"{prefix}_{name}" if prefix else name)
