"""Role policies: which rows and columns a role may read or write."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators.mapping import quoted
from millrace.operators.relations import Relation, where

SESSION_PREFIX = "x-"

Policy = Mapping[str, Mapping[str, Mapping[str, object]]]


class NotPermitted(Exception):
    """The role may not do this at all."""


def bound(rule: object, session: Mapping[str, object]) -> object:
    """A condition tree with the session's values in place of its variables.

    A variable is a text that starts with ``X-``, in any case. One the session
    lacks makes the request fail rather than match by accident.
    """
    values = {k.lower(): v for k, v in session.items()}
    if isinstance(rule, Mapping):
        return {k: bound(v, session) for k, v in rule.items()}
    if isinstance(rule, (list, tuple)):
        return [bound(v, session) for v in rule]
    if isinstance(rule, str) and rule.lower().startswith(SESSION_PREFIX):
        if rule.lower() not in values:
            raise NotPermitted(f"session has no {rule}")
        return values[rule.lower()]
    return rule


def _rule(policy: Policy, role: str, action: str) -> Mapping[str, object]:
    rule = policy.get(role, {}).get(action)
    if rule is None:
        raise NotPermitted(f"role {role!r} has no {action} permission")
    return rule


def _allowed(df: DataFrame, rule: Mapping[str, object]) -> list[str]:
    columns = rule.get("columns", "*")
    return df.columns if columns == "*" else [c for c in df.columns if c in columns]


def secure_view(
    df: DataFrame,
    policy: Policy,
    role: str,
    session: Mapping[str, object],
    relations: Mapping[str, Relation] | None = None,
    order_by: Sequence[Column] = (),
) -> DataFrame:
    """What the role may see: filtered rows, allowed columns, at most ``limit`` rows.

    A role without a read permission gets no rows and no columns. The row cap
    applies after the filter.
    """
    rule = policy.get(role, {}).get("select")
    if rule is None:
        return df.sparkSession.createDataFrame([], T.StructType([]))
    seen = where(df, bound(rule.get("filter", {}), session), relations)
    if order_by:
        seen = seen.orderBy(*order_by)
    seen = seen.select(*[quoted(c) for c in _allowed(df, rule)])
    return seen.limit(int(rule["limit"])) if rule.get("limit") else seen


def secure_aggregate(
    df: DataFrame,
    policy: Policy,
    role: str,
    session: Mapping[str, object],
    *aggregates: Column,
    relations: Mapping[str, Relation] | None = None,
) -> DataFrame:
    """Aggregates over the rows the role may see, where it may aggregate."""
    rule = _rule(policy, role, "select")
    if not rule.get("allow_aggregations"):
        raise NotPermitted(f"role {role!r} may not aggregate")
    seen = where(df, bound(rule.get("filter", {}), session), relations)
    return seen.select(*[quoted(c) for c in _allowed(df, rule)]).agg(*aggregates)


def _split(df: DataFrame, tree: object, flag: str = "_permitted") -> DataFrame:
    """Tag rows by a condition on their own columns; unknown counts as no."""
    return df.withColumn(flag, F.coalesce(_condition(df, tree), F.lit(False)))


def _condition(df: DataFrame, tree: object) -> Column:
    from millrace.operators.relations import _predicate

    predicate, _ = _predicate(df, tree or {}, {}, {})
    return predicate


def _refuse_columns(df: DataFrame, rule: Mapping[str, object], keys: Sequence[str] = ()) -> None:
    extra = [c for c in df.columns if c not in _allowed(df, rule) and c not in keys]
    if extra:
        raise NotPermitted(f"columns not permitted: {extra}")


def check_insert(
    rows: DataFrame, policy: Policy, role: str, session: Mapping[str, object]
) -> DataFrame:
    """Tag the rows to be inserted with ``_permitted``."""
    rule = _rule(policy, role, "insert")
    _refuse_columns(rows, rule)
    return _split(rows, bound(rule.get("check", {}), session))


def check_update(
    target: DataFrame,
    changes: DataFrame,
    keys: Sequence[str],
    policy: Policy,
    role: str,
    session: Mapping[str, object],
) -> DataFrame:
    """Tag changes with ``_permitted``.

    The stored row must pass the filter and the changed row the check. ``changes``
    holds the keys and the new values of the columns to be set.
    """
    rule = _rule(policy, role, "update")
    _refuse_columns(changes, rule, keys)
    before = _split(target, bound(rule.get("filter", {}), session), "_visible")
    after = before.alias("t").join(
        changes.withColumn("_change", F.lit(True)).alias("c"), list(keys), "right"
    )
    result = after.select(
        *[
            (F.col(f"c.{quoted(c)}") if c in changes.columns and c not in keys else F.col(quoted(c)))
            .alias(c)
            for c in target.columns
        ],
        F.coalesce("_visible", F.lit(False)).alias("_visible"),
    )
    checked = _split(result, bound(rule.get("check", {}), session))
    return checked.withColumn("_permitted", F.col("_permitted") & F.col("_visible")).drop(
        "_visible"
    )


def check_delete(
    target: DataFrame, policy: Policy, role: str, session: Mapping[str, object]
) -> DataFrame:
    """Tag the stored rows the role may delete with ``_permitted``."""
    rule = _rule(policy, role, "delete")
    return _split(target, bound(rule.get("filter", {}), session))


def permitted(tagged: DataFrame) -> DataFrame:
    return tagged.where("_permitted").drop("_permitted")


def refused(tagged: DataFrame) -> DataFrame:
    return tagged.where("NOT _permitted").drop("_permitted")
