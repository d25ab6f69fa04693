"""Registered queries: each a Spark job over the given tables, with SQL to check it."""

from __future__ import annotations

from millrace.plans.queries.registry import QUERIES, SQL

# Importing the modules fills the registry.
from millrace.plans.queries import cleansing  # noqa: F401
from millrace.plans.queries import contracts  # noqa: F401
from millrace.plans.queries import edges  # noqa: F401
from millrace.plans.queries import event_store  # noqa: F401
from millrace.plans.queries import integrity  # noqa: F401
from millrace.plans.queries import merging  # noqa: F401
from millrace.plans.queries import privacy  # noqa: F401
from millrace.plans.queries import related  # noqa: F401
from millrace.plans.queries import reports  # noqa: F401
from millrace.plans.queries import stored  # noqa: F401
from millrace.plans.queries import versions  # noqa: F401

__all__ = ["QUERIES", "SQL"]
