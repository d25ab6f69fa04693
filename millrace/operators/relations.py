"""Relationship queries: condition trees, nested parents and nested child lists."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.operators.mapping import quoted
from millrace.operators.skew import one_row_per_key, with_position

_COMPARE: dict[str, Callable[[Column, object], Column]] = {
    "_eq": lambda c, v: c == v,
    "_neq": lambda c, v: c != v,
    "_gt": lambda c, v: c > v,
    "_gte": lambda c, v: c >= v,
    "_lt": lambda c, v: c < v,
    "_lte": lambda c, v: c <= v,
    "_in": lambda c, v: c.isin(*v) if v else F.lit(False),
    "_is_null": lambda c, v: c.isNull() if v else c.isNotNull(),
}


@dataclass
class Relation:
    """Rows of ``df`` that belong to a row: ``df.theirs == row.ours``."""

    df: DataFrame
    theirs: str
    ours: str
    relations: Mapping[str, Relation] = field(default_factory=dict)


def compare(value: Column, condition: Mapping[str, object]) -> Column:
    """``{"_gte": 3, "_lt": 9}`` on one column."""
    unknown = set(condition) - set(_COMPARE)
    if unknown:
        raise ValueError(f"unknown comparison: {sorted(unknown)}")
    return _all([_COMPARE[op](value, operand) for op, operand in condition.items()])


def _all(parts: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a & b, parts, F.lit(True))


def where(
    df: DataFrame,
    tree: Mapping[str, object],
    relations: Mapping[str, Relation] | None = None,
) -> DataFrame:
    """Filter by a condition tree.

    Column conditions stay plain predicates, which reach the file scan. A
    relation that all rows must satisfy becomes a semi join. Below ``_or`` and
    ``_not``, and for ``<name>_aggregate`` counts, related rows are counted per
    key first and joined as one row per key.
    """
    relations = relations or {}
    plain: dict[str, object] = {}
    out = df
    for name, condition in _conjuncts(tree):
        if name in relations:
            rel = relations[name]
            related = where(rel.df, condition, rel.relations)
            keys = related.select(F.col(quoted(rel.theirs)).alias(rel.ours))
            out = out.join(keys, rel.ours, "left_semi").select(*df.columns)
        else:
            plain.setdefault("_and", []).append({name: condition})
    flags: dict[str, DataFrame] = {}
    predicate, out = _predicate(out, plain, relations, flags)
    return out.where(predicate).select(*[quoted(c) for c in df.columns])


def _conjuncts(tree: Mapping[str, object]) -> list[tuple[str, object]]:
    parts: list[tuple[str, object]] = []
    for name, condition in tree.items():
        if name == "_and":
            for branch in condition:
                parts += _conjuncts(branch)
        else:
            parts.append((name, condition))
    return parts


def _predicate(
    df: DataFrame,
    tree: Mapping[str, object],
    relations: Mapping[str, Relation],
    flags: dict[str, DataFrame],
) -> tuple[Column, DataFrame]:
    parts: list[Column] = []
    for name, condition in tree.items():
        if name in ("_and", "_or"):
            branches = []
            for branch in condition:
                part, df = _predicate(df, branch, relations, flags)
                branches.append(part)
            empty = F.lit(name == "_and")
            parts.append(
                reduce((lambda a, b: a & b) if name == "_and" else (lambda a, b: a | b), branches)
                if branches
                else empty
            )
        elif name == "_not":
            part, df = _predicate(df, condition, relations, flags)
            parts.append(~part)
        elif name in relations:
            count, df = _related_count(df, relations[name], condition, flags)
            parts.append(count > 0)
        elif name.endswith("_aggregate") and name.removesuffix("_aggregate") in relations:
            spec = condition["count"]
            rel = relations[name.removesuffix("_aggregate")]
            count, df = _related_count(df, rel, spec.get("filter", {}), flags)
            parts.append(compare(count, spec["predicate"]))
        else:
            if name not in df.columns:
                raise ValueError(f"no column or relation {name!r}")
            parts.append(compare(F.col(quoted(name)), condition))
    return _all(parts), df


def _related_count(
    df: DataFrame, rel: Relation, condition: Mapping[str, object], flags: dict[str, DataFrame]
) -> tuple[Column, DataFrame]:
    name = f"_n_related_{len(flags)}"
    related = where(rel.df, condition, rel.relations).select(
        F.col(quoted(rel.theirs)).alias(rel.ours)
    )
    counted = one_row_per_key(related, [rel.ours], F.count("*").alias(name))
    flags[name] = counted
    return F.coalesce(F.col(name), F.lit(0)), df.join(counted, rel.ours, "left")


def count_where(
    df: DataFrame,
    tree: Mapping[str, object],
    relations: Mapping[str, Relation] | None = None,
) -> DataFrame:
    """One row ``count`` of the rows that satisfy the tree."""
    return where(df, tree, relations).agg(F.count("*").alias("count"))


def embed_parent(
    child: DataFrame, parent: DataFrame, fk: str, pk: str, name: str, *, how: str = "inner"
) -> DataFrame:
    """Attach the parent to each child as a struct column."""
    whole = parent.select(F.col(quoted(pk)).alias(fk), F.struct(*parent.columns).alias(name))
    return child.join(whole, fk, how).select(*[quoted(c) for c in child.columns], name)


def nest_children(
    parent: DataFrame,
    child: DataFrame,
    pk: str,
    fk: str,
    name: str,
    *,
    order_by: Sequence[Column],
    columns: Sequence[str] | None = None,
    limit: int | None = None,
    page_size: int | None = None,
) -> DataFrame:
    """Attach the children of each parent as an ordered array column.

    Each parent is one row, with all its children, or the first ``limit``; Spark drops
    the others before the shuffle. One row and one task then hold the children of a
    parent. With ``page_size`` every parent is laid out in pages instead, numbered from
    0 in ``<name>_page``: consecutive pieces of the order of that many children, the
    last one shorter; a parent without children has one empty page. Ties in the order
    go by the children's content.
    """
    if page_size is not None and page_size < 1:
        raise ValueError("page_size must be positive")
    fields = [quoted(c) for c in (columns or child.columns)]
    key = quoted(fk)
    whole = F.struct(*fields).alias("v")
    rows = child.where(F.col(key).isNotNull()).withColumn("_fk", F.col(key))
    order = [*order_by, F.xxhash64(*[quoted(c) for c in child.columns])]
    if page_size is None:
        turn = F.row_number().over(Window.partitionBy("_fk").orderBy(*order))
        placed = rows.withColumn("_position", turn)
        page = F.lit(0)
    else:
        placed = with_position(rows, ["_fk"], order)
        page = F.floor((F.col("_position") - 1) / page_size)
    if limit is not None:
        placed = placed.where(F.col("_position") <= limit)
    lists = (
        placed.select("_fk", page.cast("int").alias("_page"), F.struct("_position", whole).alias("_item"))
        .groupBy("_fk", "_page")
        .agg(F.collect_list("_item").alias("_items"))
    )
    ordered = F.transform(F.array_sort("_items"), lambda x: x["v"])
    empty = F.array().cast(_array_type(child, fields))
    joined = parent.join(lists, parent[quoted(pk)] == F.col("_fk"), "left")
    return joined.select(
        *[parent[quoted(c)] for c in parent.columns],
        F.coalesce("_page", F.lit(0)).alias(f"{name}_page"),
        F.coalesce(ordered, empty).alias(name),
    )


def _array_type(child: DataFrame, fields: Sequence[str]) -> str:
    return f"array<{child.select(*fields).schema.simpleString()}>"


@dataclass(frozen=True)
class ForeignKey:
    child_table: str
    column: str
    parent_table: str
    parent_column: str = "id"


def relationship_graph(
    tables: Mapping[str, DataFrame], foreign_keys: Sequence[ForeignKey]
) -> dict[str, dict[str, Relation]]:
    """Relations per table as its foreign keys give them.

    The child sees its parent under the key's name without ``_id``; the parent
    sees its children under the child table's name.
    """
    graph: dict[str, dict[str, Relation]] = {name: {} for name in tables}
    for fk in foreign_keys:
        single = fk.column.removesuffix("_id") if fk.column.endswith("_id") else fk.parent_table
        graph[fk.child_table][single] = Relation(
            tables[fk.parent_table], fk.parent_column, fk.column
        )
        many = fk.child_table
        if many in graph[fk.parent_table]:
            many = f"{fk.child_table}_by_{fk.column}"
        graph[fk.parent_table][many] = Relation(tables[fk.child_table], fk.column, fk.parent_column)
    return graph


def joined_text(
    df: DataFrame,
    keys: Sequence[str],
    value: Column,
    separator: str,
    out: str,
    *,
    part_rows: int | None = None,
) -> DataFrame:
    """The values of each key in one text, in order (``string_agg``).

    Each key is one row, ``part`` 0. With ``part_rows`` every key is laid out in parts
    instead: consecutive pieces of the order of that many values, to be joined by the
    separator in the order of ``part``.
    """
    named = df.select(*keys, value.cast("string").alias("_value"), value.alias("_order"))
    if part_rows is None:
        turn = F.row_number().over(Window.partitionBy(*keys).orderBy("_order"))
        placed = named.withColumn("_position", turn).withColumn("part", F.lit(0))
    else:
        placed = with_position(named, keys, [F.col("_order")])
        placed = placed.withColumn("part", F.floor((F.col("_position") - 1) / part_rows).cast("int"))
    items = F.array_sort(F.collect_list(F.struct("_position", "_value")))
    text = F.array_join(F.transform(items, lambda x: x["_value"]), separator)
    return placed.groupBy(*keys, "part").agg(text.alias(out)).select(*keys, "part", out)
