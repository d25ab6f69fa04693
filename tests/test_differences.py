"""Differences by a tree of digests against plain comparison."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from millrace.operators import differences
from row_sets import as_set


def save(df, tmp_path, name, **options):
    root = str(tmp_path / name)
    differences.save_with_tree(df, root, ["k"], **options)
    return root


def test_ten_changed_rows_are_found_in_few_leaves(spark, tmp_path):
    rows = spark.range(20_000).select(F.col("id").alias("k"), F.md5(F.col("id").cast("string")).alias("v"))
    changed = rows.withColumn("v", F.when(F.col("k") % 2000 == 7, "other").otherwise(F.col("v")))
    left, right = (save(df, tmp_path, n, leaves=512) for df, n in ((rows, "a"), (changed, "b")))
    nodes = [r.node for r in differences.differing_leaves(spark, left, right).collect()]
    opened = differences.opened_rows(spark, left, nodes)
    assert opened.count() < 0.05 * 20_000
    assert len(opened.inputFiles()) > len(nodes)  # listed, but the scan below prunes them
    plan = opened._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "_leaf" in plan.split("PartitionFilters: ")[1].split("\n")[0]
    got = differences.find_differences(spark, left, right)
    want = {r.k for r in rows.exceptAll(changed).collect()}
    assert {r.k for r in got.collect()} == want and len(want) == 10
    assert as_set(got.select("finding", "left_rows", "right_rows").distinct()) == {("changed", 1, 1)}


def test_repeats_nulls_and_one_hot_key(spark, tmp_path):
    hot = [(1, "a")] * 300 + [(1, "b")] * 300
    a = [*hot, (2, "x"), (2, "x"), (3, "y"), (None, "n"), (None, None), (4, "z")]
    b = [*hot[1:], (1, "c"), (2, "w"), (2, "w"), (3, "y"), (None, "n"), (5, "new")]
    left, right = (
        save(spark.createDataFrame(rows, "k int, v string"), tmp_path, n, leaves=40) for rows, n in ((a, "a"), (b, "b"))
    )
    got = differences.find_differences(spark, left, right)
    assert as_set(got, "k", "left_rows", "right_rows", "finding") == {
        (1, 1, 1, "changed"), (2, 2, 2, "changed"), (None, 1, 0, "missing"), (4, 1, 0, "missing"), (5, 0, 1, "extra"),
    }
    assert differences.find_differences(spark, left, left).count() == 0


@pytest.mark.parametrize("leaves", [1, 16, 17])
def test_empty_and_small_trees(spark, tmp_path, leaves):
    rows = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    full, none = save(rows, tmp_path, "full", leaves=leaves), save(rows.limit(0), tmp_path, "none", leaves=leaves)
    assert as_set(differences.find_differences(spark, none, full), "k", "finding") == {(1, "extra"), (2, "extra")}
    assert differences.find_differences(spark, none, none).count() == 0


def test_trees_of_another_shape_are_refused(spark, tmp_path):
    rows = spark.createDataFrame([(1, "a")], "k int, v string")
    one, two = save(rows, tmp_path, "one", leaves=4), save(rows, tmp_path, "two", leaves=8)
    other = save(rows.withColumn("w", F.lit(1)), tmp_path, "three", leaves=4)
    for right in (two, other):
        with pytest.raises(ValueError, match="differ in keys"):
            differences.find_differences(spark, one, right)
    # Columns in another order, and when a row was synced, make no difference.
    turned = rows.select("v", "k").withColumn("_sync_updated_at", F.current_timestamp())
    assert differences.find_differences(spark, one, save(turned, tmp_path, "four", leaves=4)).count() == 0
