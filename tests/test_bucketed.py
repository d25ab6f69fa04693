"""Bucketed tables: deltas, stops between any two steps, writers side by side, compaction."""

from __future__ import annotations

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F
from row_sets import as_set

from millrace.operators.snapshot import empty_history, snapshot, without_key
from millrace.plans import bucketed
from millrace.plans.bucketed import merge_buckets, replace_rows
from millrace.plans.marts import SnapshotOf, save_snapshot
from millrace.plans.sync import sync
from millrace.sources import versions, writers
from millrace.sources.versions import BucketStore, Conflict, bucket_of, compact

DAY = dt.datetime(2030, 5, 1, tzinfo=dt.timezone.utc)
SCHEMA = "id long, grp string, v double"


def rows(spark, ids, v=1.0):
    return spark.createDataFrame([(i, f"g{i % 5}", v) for i in ids], SCHEMA)


def test_delta_reads_and_rewrites_its_buckets_only(spark, tmp_path):
    root = str(tmp_path / "t")
    first = merge_buckets(rows(spark, range(2_000)), root, ["id"], buckets=50)
    assert (first.result.inserted, first.result.table_created, len(first.rewritten)) == (2_000, True, 50)
    store = BucketStore(spark, root)
    before = store.latest()
    delta = rows(spark, [3, 4], 9.0).union(rows(spark, [5], 1.0)).union(rows(spark, [90_000]))
    done = merge_buckets(delta, root, ["id"])
    assert (done.result.inserted, done.result.updated, done.result.unchanged) == (1, 2, 1)
    of = {r["id"]: r["b"] for r in delta.select("id", bucket_of(["id"], 50).alias("b")).collect()}
    assert set(done.looked_at) == set(of.values())
    assert set(done.rewritten) == {of[3], of[4], of[90_000]}
    after = store.latest()
    assert {b for b in range(50) if after.parts[b] != before.parts[b]} == set(done.rewritten)
    # The scan of a delta opens files of its buckets alone.
    files = store.read(after, buckets=done.looked_at).inputFiles()
    assert files and all(any(f"_bucket={b}/" in f for b in done.looked_at) for f in files)
    assert as_set(store.read(), "id", "v") == {(i, 9.0 if i in (3, 4) else 1.0) for i in [*range(2_000), 90_000]}
    assert after.rows() == store.read().count() == 2_001
    # Time travel, and nothing to publish for a delta that changes nothing.
    assert store.read(before).where("v = 9").count() == 0
    assert merge_buckets(delta, root, ["id"]).version == after.number == store.latest().number


def test_counts_and_rows_equal_the_full_merge(spark, database, tmp_path):
    root = str(tmp_path / "t")
    steps = [
        (rows(spark, range(100)), DAY),
        (rows(spark, range(50, 130), 2.0).union(rows(spark, range(60, 70), 2.0)), DAY + dt.timedelta(days=1)),
        (rows(spark, range(120, 140), 2.0), DAY + dt.timedelta(days=2)),
    ]
    for source, at in steps:
        ours = merge_buckets(source, root, ["id", "grp"], bucket_on=["grp"], buckets=8, run_time=at).result
        theirs = sync(source, f"{database}.t", keys=["id", "grp"], run_time=at)
        assert ours == theirs
    columns = ["id", "grp", "v", "_sync_checksum", "_sync_updated_at"]
    assert as_set(BucketStore(spark, root).read(), *columns) == as_set(spark.table(f"{database}.t"), *columns)


def test_rejects_mapping_and_bad_calls(spark, tmp_path):
    root = str(tmp_path / "t")
    source = spark.createDataFrame([(1, "a", 1.0), (None, "b", 2.0)], SCHEMA)
    with pytest.raises(ValueError, match="lack required"):
        merge_buckets(source, root, ["key"], mapping={"id": "key"})
    done = merge_buckets(source, root, ["key"], mapping={"id": "key"}, on_bad="skip")
    assert (done.result.skipped, done.result.inserted, done.result.status) == (1, 1, "partial")
    with pytest.raises(ValueError, match="merge keys"):
        merge_buckets(source, root, [])
    with pytest.raises(ValueError, match="no table"):
        replace_rows(source, str(tmp_path / "none"))
    assert merge_buckets(rows(spark, []), str(tmp_path / "empty"), ["id"]).result.inserted == 0
    assert BucketStore(spark, str(tmp_path / "empty")).read().count() == 0


# A stop before or after a step; what lies between two of these does not touch the store.
STEPS = [("write", False), ("write", True), ("put_new", False), ("_take_name", True)]


@pytest.mark.parametrize(("step", "after"), STEPS)
@pytest.mark.parametrize("job", ["merge", "replace", "compact"])
def test_a_stop_anywhere_leaves_old_or_new_rows(spark, tmp_path, monkeypatch, job, step, after):
    root = str(tmp_path / "t")
    merge_buckets(rows(spark, range(40)), root, ["id"], buckets=3)
    store = BucketStore(spark, root)
    run = {
        "merge": lambda: merge_buckets(rows(spark, range(20, 60), 2.0), root, ["id"]),
        "replace": lambda: replace_rows(BucketStore(spark, root).read().where("id < 7"), root),
        "compact": lambda: compact(BucketStore(spark, root), most_parts=0, rows_per_bucket=5),
    }[job]
    old = as_set(store.read(), "id", "v")
    new = {
        "merge": {(i, 1.0 if i < 20 else 2.0) for i in range(60)}, "replace": {(i, 1.0) for i in range(7)}, "compact": old,
    }[job]
    real = getattr(BucketStore, step)

    def stop(self, *args, **options):
        if after:
            real(self, *args, **options)
        raise RuntimeError("stopped")

    monkeypatch.setattr(BucketStore, step, stop)
    with pytest.raises(RuntimeError, match="stopped"):
        run()
    monkeypatch.undo()
    assert as_set(store.read(), "id", "v") in (old, new)
    run()
    assert as_set(store.read(), "id", "v") == new
    assert not [n for n in os.listdir(f"{root}/_versions") if not n.endswith(".json") and "draft" not in n]
    store.vacuum(keep=1)
    assert as_set(store.read(), "id", "v") == new and len(store.numbers()) == 1
    assert store.read().count() == store.latest().rows()


def interleave(monkeypatch, other):
    """Runs ``other`` when the first writer is about to commit."""
    real, ran = BucketStore.commit, []

    def commit(self, *args, **options):
        if not ran:
            ran.append(1)
            other()
        return real(self, *args, **options)

    monkeypatch.setattr(BucketStore, "commit", commit)


def test_two_writers_of_the_same_rows(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "t")
    merge_buckets(rows(spark, range(30)), root, ["id"], buckets=4)
    interleave(monkeypatch, lambda: merge_buckets(rows(spark, range(25, 40), 2.0), root, ["id"]))
    done = merge_buckets(rows(spark, range(35, 50), 3.0), root, ["id"])
    assert done.attempts == 2 and (done.result.inserted, done.result.updated) == (10, 5)
    want = {(i, 1.0 if i < 25 else 2.0 if i < 35 else 3.0) for i in range(50)}
    assert as_set(BucketStore(spark, root).read(), "id", "v") == want


def test_two_writers_of_other_buckets_need_no_second_turn(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "t")
    merge_buckets(rows(spark, range(50)), root, ["id", "grp"], bucket_on=["grp"], buckets=64)
    interleave(monkeypatch, lambda: merge_buckets(rows(spark, [100], 2.0), root, ["id", "grp"]))
    done = merge_buckets(rows(spark, [101], 3.0), root, ["id", "grp"])
    assert done.attempts == 1 and done.version == 4
    assert BucketStore(spark, root).read().count() == 52


def test_a_writer_that_always_comes_second_gives_up(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "t")
    merge_buckets(rows(spark, range(5)), root, ["id"], buckets=1)
    monkeypatch.setattr(BucketStore, "commit", lambda *_, **__: None)
    with pytest.raises(Conflict):
        merge_buckets(rows(spark, range(9)), root, ["id"], retries=2)


def test_a_taken_number_is_refused(spark, tmp_path):
    store = BucketStore(spark, str(tmp_path / "t"))
    assert store.put_new("_versions/a.json", "1") and not store.put_new("_versions/a.json", "2")
    assert store._read_text("_versions/a.json") == "1" and store._names("_versions") == ["a.json"]
    # The way for shared file systems, tried on the local one.
    for name, want in (("b.json", True), ("a.json", False)):
        fs, source = store._fs(f"{store.root}/draft")
        fs.create(source).close()
        assert store._rename_new(fs.makeQualified(source), fs.makeQualified(store._fs(f"{store.root}/_versions/{name}")[1])) is want


def test_compaction_beside_a_writer(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "t")
    store = BucketStore(spark, root)
    base = store.create(rows(spark, []).schema, ["id"], 2)
    for i in range(6):
        base = store.latest()
        store.commit(base, (), "append", added=store.write(rows(spark, range(i * 10, i * 10 + 10)), base))
    assert max(len(ps) for ps in store.latest().parts.values()) == 6
    late = rows(spark, range(900, 910))

    def append():
        now = store.latest()
        BucketStore.commit(store, now, (), "append", added=store.write(late, now))

    interleave(monkeypatch, append)
    made = compact(store, most_parts=3)
    assert {len(ps) for ps in made.parts.values()} == {2}
    assert as_set(store.read(), "id") == {(i,) for i in [*range(60), *range(900, 910)]}
    wide = compact(store, rows_per_bucket=5)
    assert wide.buckets == 16 and store.read().count() == 70
    assert [r["operation"] for r in store.history().orderBy("version").collect()][-2:] == ["compact", "deal anew"]


def test_one_key_group_of_most_rows_is_split_into_files(spark, tmp_path):
    # Buckets by a column where one value has nearly all rows: still right, several tasks may write it.
    root = str(tmp_path / "t")
    source = spark.range(5_000).select("id", F.lit("hot").alias("grp"), F.lit(1.0).alias("v"))
    done = merge_buckets(source, root, ["id", "grp"], bucket_on=["grp"], buckets=16)
    assert len(done.rewritten) == 1 and BucketStore(spark, root).read().count() == 5_000
    assert bucketed.merge_buckets(source, root, ["id", "grp"]).result.unchanged == 5_000


@pytest.mark.parametrize("stop_at", ["reload_table", "after"])
def test_a_partitioned_table_survives_a_stop(spark, database, monkeypatch, stop_at):
    table = f"{database}.t"
    rows(spark, range(20)).write.partitionBy("grp").format("parquet").saveAsTable(table)
    sync(rows(spark, range(20)), table, keys=["id"], run_time=DAY)
    real = writers.reload_table

    def stop(*args, **_):
        if stop_at == "reload_table":
            # The worst moment: the old rows are gone, the new ones not there yet.
            real(spark.createDataFrame([], spark.table(table).schema), table)
        if stop_at == "after":
            real(*args)
        raise RuntimeError("stopped")

    monkeypatch.setattr(writers, "reload_table", stop)
    with pytest.raises(RuntimeError, match="stopped"):
        sync(rows(spark, range(10, 30), 2.0), table, keys=["id"], run_time=DAY + dt.timedelta(days=1))
    monkeypatch.undo()
    assert writers.recover(spark, table) and not writers.recover(spark, table)
    assert as_set(spark.table(table), "id", "v") == {(i, 1.0 if i < 10 else 2.0) for i in range(30)}
    assert not spark.catalog.tableExists(f"{table}__next")


def test_an_incomplete_successor_is_dropped(spark, database):
    table = f"{database}.t"
    rows(spark, range(5)).write.partitionBy("grp").format("parquet").saveAsTable(table)
    rows(spark, range(2)).write.format("parquet").saveAsTable(f"{table}__next")
    assert not writers.recover(spark, table)
    assert spark.table(table).count() == 5 and not spark.catalog.tableExists(f"{table}__next")


def test_rows_without_a_key_get_no_version(spark, database):
    people = spark.createDataFrame([(1, "a"), (None, "b")], "id long, name string")
    with pytest.raises(ValueError, match="id is null"):
        save_snapshot(spark, f"{database}.h", SnapshotOf(people, ["id"]), DAY)
    for day in range(3):
        save_snapshot(spark, f"{database}.h", SnapshotOf(people, ["id"], on_bad="skip"), DAY + dt.timedelta(days=day))
    assert as_set(spark.table(f"{database}.h"), "id", "is_open") == {(1, True)}
    assert [tuple(r) for r in without_key(people, ["id", "name"]).collect()] == [(None, "b", "id is null")]
    # Versions without a key that an earlier release left open are closed once.
    old = snapshot(people.where("id = 1"), empty_history(spark, people.schema), ["id"], F.lit(DAY))
    stale = old.withColumn("id", F.lit(None).cast("long"))
    for day in (1, 2):
        stale = snapshot(people, stale, ["id"], F.lit(DAY + dt.timedelta(days=day)))
    assert stale.where("id IS NULL").count() == 1 and stale.where("valid_to IS NULL").count() == 1


def test_very_many_buckets_share_folders(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(versions, "MOST_BUCKETS", 8)
    root = str(tmp_path / "t")
    merge_buckets(rows(spark, range(300)), root, ["id"], buckets=4)
    store = BucketStore(spark, root)
    made = compact(store, rows_per_bucket=1)
    # As many as 512 buckets, in eight folders: a version does not grow with the rows.
    assert (made.buckets, made.slices, sum(map(len, made.parts.values()))) == (8, 64, 8)
    assert store.at(made.number) == made
    assert as_set(store.read(), "id", "v") == {(i, 1.0) for i in range(300)}
    fine = rows(spark, range(300)).select("id", bucket_of(["id"], 8).alias("b"), bucket_of(["id"], 512).alias("fine"))
    want = {r["id"] for r in fine.where("b = 3").collect() if 5 <= r["fine"] // 8 < 40}
    assert want and {r["id"] for r in store.read(made, buckets=[3], slices=range(5, 40)).collect()} == want
    # Merges go on in the slices, and a compaction that has nothing to do publishes nothing.
    assert merge_buckets(rows(spark, [7, 900], 2.0), root, ["id"]).result.updated == 1
    assert as_set(store.read(), "id", "v") == {(i, 2.0 if i in (7, 900) else 1.0) for i in [*range(300), 900]}
    assert store.read(slices=range(64)).count() == 301
    assert compact(store, rows_per_bucket=1).number == store.latest().number


def test_a_large_source_is_not_stored_again(spark, tmp_path, monkeypatch):
    stored, real = [], bucketed.Scratch.keep
    monkeypatch.setattr(bucketed.Scratch, "keep", lambda self, df: stored.append(df) or real(self, df))
    root = str(tmp_path / "t")
    merge_buckets(rows(spark, range(100)), root, ["id"], buckets=4)
    # A row for each key: only the checked rows are staged, neither deduplicated rows nor changes are.
    done = merge_buckets(rows(spark, range(50, 110), 2.0), root, ["id"], run_time=DAY)
    assert len(stored) == 2 and (done.result.inserted, done.result.updated) == (10, 50)
    store = BucketStore(spark, root)
    assert as_set(store.read(), "id", "v") == {(i, 1.0 if i < 50 else 2.0) for i in range(110)}
    assert {len(c) for (c,) in as_set(store.read(), "_sync_checksum")} == {64}
    # A whole merge that finds nothing publishes nothing; a key that comes twice still counts once.
    assert merge_buckets(rows(spark, range(110), 2.0).where("id >= 50"), root, ["id"]).rewritten == []
    twice = merge_buckets(rows(spark, [7, 7], 3.0).union(rows(spark, range(90))), root, ["id"]).result
    assert (twice.duplicates, twice.rows_read) == (3 - 1, 92)


def test_hashes_are_packed_and_other_texts_kept(spark):
    texts = ["00ff", "ABCD", "abc", "", "xy", None]
    frame = spark.createDataFrame([(t,) for t in texts], "c string")
    assert [r["c"] for r in versions.unpacked(versions.packed(frame, ["c"]), ["c"]).collect()] == texts
