"""What the plans must look like, and random merges against plain Python."""

from __future__ import annotations

import random
import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_module
from row_sets import as_set
from millrace.operators import events, merge, relations
from millrace.plans.queries import stored

SF = "/root/testdata/sf0.001"
EAGER = {
    name
    for name, query in entry_module.queries().items()
    if query.__closure__
    and any(getattr(c.cell_contents, "__module__", "") == stored.__name__ for c in query.__closure__)
}
LAZY = sorted(set(entry_module.queries()) - EAGER)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_query_pairs_all_rows(spark):
    bad = {}
    for name in LAZY:
        plan = plan_of(entry_module.queries()[name](spark, SF))
        if re.search(r"CartesianProduct|NestedLoopJoin|BatchEvalPython|ArrowEvalPython", plan):
            bad[name] = plan
    assert not bad, sorted(bad)
    assert len(LAZY) > 70 and len(EAGER) > 8


@pytest.mark.parametrize(
    ("name", "table", "pushed"),
    [
        ("rolling_window_filter", "orders", "GreaterThanOrEqual(o_orderdate"),
        ("where_tree", "events", "In(event_type, [click,error])"),
        ("secure_view_user", "orders", "EqualTo(o_orderpriority,1-URGENT)"),
        ("query_scan", "orders", "GreaterThan(o_totalprice,100000.0)"),
    ],
)
def test_filters_reach_the_scan(spark, name, table, pushed):
    plan = plan_of(entry_module.queries()[name](spark, SF))
    assert pushed in plan and f"{table}.parquet" in plan


def test_scans_read_needed_columns_only(spark):
    plan = plan_of(entry_module.queries()["revenue_by_month"](spark, SF))
    assert "l_orderkey" in plan and "l_shipdate" not in plan and "l_comment" not in plan
    assert "c_acctbal" not in plan


def test_merge_shuffles_each_side_once(spark):
    target = merge.with_checksum(spark.range(1000).withColumn("v", F.lit("a")))
    target = target.withColumn("_sync_updated_at", F.current_timestamp())
    source = merge.with_checksum(spark.range(500, 1500).withColumn("v", F.lit("b")))
    merged = merge.merge_keyed(target, source, ["id"], F.current_timestamp())
    assert len(re.findall(r"Exchange hashpartitioning", plan_of(merged))) == 2


def test_ingest_parses_each_event_once(spark):
    rows = spark.range(10).select(F.lit("t").alias("event_type"), F.lit("{}").alias("event_data"))
    none = spark.createDataFrame([], "event_hash string")
    plan = plan_of(events.ingest_events(rows, none, none).created)
    assert plan.count("parseJson") <= 1


def test_random_merges(spark):
    random.seed(7)
    for _ in range(4):
        keys = range(30)
        old = {k: random.choice("abc") for k in random.sample(keys, 18)}
        new = {k: random.choice("abc") for k in random.sample(keys, 12)}
        target = merge.with_checksum(spark.createDataFrame(list(old.items()), "k int, v string"))
        target = target.withColumn("_sync_updated_at", F.lit("2024-01-01").cast("timestamp"))
        source = merge.with_checksum(spark.createDataFrame(list(new.items()), "k int, v string"))
        now = F.lit("2024-02-01").cast("timestamp")
        merged = merge.merge_keyed(target, source, ["k"], now)
        assert as_set(merged, "k", "v") == set({**old, **new}.items())
        want = {
            "inserted": sum(k not in old for k in new),
            "updated": sum(k in old and old[k] != v for k, v in new.items()),
            "unchanged": sum(old.get(k) == v for k, v in new.items()),
        }
        got = dict(merge.action_counts(merged).collect())
        assert got == {k: n for k, n in want.items() if n}
        changes = merge.merge_changes(target, source, ["k"], now)
        assert as_set(merge.merge_delta(target, changes, ["k"])) == as_set(merged.drop(merge.ACTION))


def test_one_key_with_a_third_of_all_rows(spark):
    """Counts and joins of a skewed child agree with arithmetic."""
    n = 30_000
    child = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 1000).alias("fk"), F.col("id").alias("v")
    )
    parent = spark.range(900).withColumnRenamed("id", "pk")
    hot = n // 3 + sum(1 for i in range(n) if i % 3 and i % 1000 == 7)
    relation = {"kids": relations.Relation(child, "fk", "pk")}
    many = {"kids_aggregate": {"count": {"predicate": {"_gt": 5000}}}}
    assert as_set(relations.where(parent, many, relation)) == {(7,)}
    nested = relations.nest_children(
        parent, child, "pk", "fk", "kids", order_by=[F.col("v")], columns=["v"], page_size=500
    )
    sizes = nested.where("pk = 7").select(F.size("kids").alias("n"), "kids_page").collect()
    assert sum(r.n for r in sizes) == hot and len(sizes) == -(-hot // 500)
    assert len({r.kids_page for r in sizes}) == len(sizes)
    total = nested.agg(F.sum(F.size("kids"))).first()[0]
    assert total == child.where("fk < 900").count()
    up = {"mum": relations.Relation(parent, "pk", "fk")}
    tree = {"_or": [{"mum": {"pk": {"_eq": 7}}}, {"v": {"_lt": 10}}]}
    want = sum(1 for i in range(n) if (7 if i % 3 == 0 else i % 1000) == 7 or i < 10)
    assert relations.where(child, tree, up).count() == want


def test_nothing_is_kept_on_executors_only():
    root = Path(__file__).parents[1] / "millrace"
    for path in root.rglob("*.py"):
        text = path.read_text()
        assert not re.search(r"localCheckpoint|\.persist\(|\.cache\(|crossJoin|\.rdd\b", text), path
