"""The indexed event store: what a batch opens, repeated batches, writers and compaction."""

from __future__ import annotations

from pyspark.sql import functions as F
from row_sets import as_set

from millrace.operators.events import ingest_events
from millrace.plans.event_index import EventIndex, ingest_indexed_stream
from millrace.sources.versions import BucketStore


def events(spark, ids):
    return spark.createDataFrame([(f"t{i % 3}", f'{{"k": {i}}}') for i in ids], "event_type string, event_data string")


def numbers(index):
    return sorted(r[0] for r in index.read().select(F.get_json_object("event_data", "$.k").cast("int")).collect())


def bytes_of(spark, root, folders):
    paths = [f"{root}/{f}" for f in folders]
    if not paths:
        return 0
    return spark.read.format("binaryFile").load(paths).agg(F.sum("length")).first()[0]


def test_a_batch_opens_only_parts_that_may_hold_its_hashes(spark, tmp_path):
    root = str(tmp_path / "i")
    index = EventIndex(spark, root, buckets=4)
    read = []
    for turn in range(4):
        # A hundred new events, and one that the first batch had.
        batch = events(spark, [*range(turn * 100 + 1, turn * 100 + 101), 1])
        done = index.ingest(batch)
        want = (101, 100, 1, 0)
        got = tuple(done.outcome[c] for c in ("total_events", "events_created", "events_duplicate", "events_failed"))
        assert got == want
        read.append(done.opened)
    version = index.store.latest()
    # Only the part that holds event 1; the history has grown threefold meanwhile.
    assert read[0] == [] and all(len(r) == 1 for r in read[1:]) and len({r[0] for r in read[1:]}) == 1
    assert sum(map(len, version.parts.values())) == 16
    assert bytes_of(spark, root, read[1]) == bytes_of(spark, root, read[3])
    assert numbers(index) == list(range(1, 401))


def test_equal_to_the_plain_ingest(spark, tmp_path):
    index = EventIndex(spark, str(tmp_path / "i"), buckets=2)
    first, second = events(spark, [1, 2, 2, 3]), events(spark, [3, 4, 5, 5, 1])
    odd = spark.createDataFrame([(None, "{}"), ("t", None), ("t", "no json")], first.schema)
    completed = ingest_events(events(spark, [5]), index.read(), index.read()).created
    index.ingest(first.union(odd), completed=completed)
    stored = index.read()
    plain = ingest_events(second.union(odd), stored, completed)
    done = index.ingest(second.union(odd), completed=completed)
    assert done.outcome == plain.outcome.first().asDict()
    assert numbers(index) == [1, 2, 3, 4]
    assert index.ingest(second, completed=completed).outcome["events_created"] == 0
    assert index.ingest(events(spark, [])).outcome["total_events"] == 0


def test_a_repeated_batch_changes_nothing(spark, tmp_path):
    index = EventIndex(spark, str(tmp_path / "i"))
    first = index.ingest(events(spark, range(5)), stream="s", batch=0)
    again = index.ingest(events(spark, range(9)), stream="s", batch=0)
    assert again.outcome is None and again.version == first.version
    index.ingest(events(spark, [1]), stream="s", batch=1)
    assert index.store.latest().info["streams"] == {"s": 1}
    index.ingest(events(spark, range(7)), stream="other", batch=0)
    assert numbers(index) == list(range(7))


def test_two_writers_store_an_event_once(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "i")
    index, ran, real = EventIndex(spark, root, buckets=2), [], BucketStore.commit

    def commit(self, *args, **options):
        if not ran:
            ran.append(1)
            EventIndex(spark, root).ingest(events(spark, [1, 2]))
        return real(self, *args, **options)

    monkeypatch.setattr(BucketStore, "commit", commit)
    done = index.ingest(events(spark, [2, 3]))
    assert done.outcome["events_created"] == 1 and done.outcome["events_duplicate"] == 1
    assert numbers(index) == [1, 2, 3]


def test_compaction_keeps_rows_filters_and_older_readers(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "i")
    index = EventIndex(spark, root, buckets=2)
    for i in range(5):
        index.ingest(events(spark, range(i * 20, i * 20 + 20)), stream="s", batch=i)
    before = index.store.latest()
    made = index.compact(most_parts=2, rows_per_bucket=10**9)
    assert {len(ps) for ps in made.parts.values()} == {1} and made.info["streams"] == {"s": 4}
    assert all(p.blocks for ps in made.parts.values() for p in ps)
    assert index.read(before).count() == 100 and numbers(index) == list(range(100))
    assert index.ingest(events(spark, [200])).opened == []
    wide = index.compact(rows_per_bucket=10)
    assert wide.buckets == 16 and numbers(index) == [*range(100), 200]
    assert index.ingest(events(spark, [5, 300])).outcome["events_duplicate"] == 1
    index.store.vacuum(keep=1)
    assert numbers(index) == [*range(100), 200, 300]


def test_filters_have_no_false_negatives_and_few_false_hits(spark, tmp_path):
    index = EventIndex(spark, str(tmp_path / "i"), buckets=1)
    index.ingest(events(spark, range(3_000)))
    version = index.store.latest()
    assert version.parts[0][0].blocks == 2
    assert index.passing(index.read(), version).count() == 3_000
    strange = spark.range(4_000).select(F.sha2(F.col("id").cast("string"), 256).alias("event_hash"))
    assert index.passing(strange, version).count() < 40


def test_stream(spark, tmp_path):
    folder, root = str(tmp_path / "in"), str(tmp_path / "i")
    for i in range(5):
        events(spark, range(i * 5, i * 5 + 10)).coalesce(1).write.mode("append").parquet(folder)
    rows = spark.readStream.schema(events(spark, [0]).schema).option("maxFilesPerTrigger", 1).parquet(folder)
    for _ in range(2):
        ingest_indexed_stream(rows, root, str(tmp_path / "c"), buckets=2, most_parts=1, compact_every=2).awaitTermination()
    index = EventIndex(spark, root)
    assert numbers(index) == list(range(30))
    version = index.store.latest()
    assert version.info["streams"] == {"events": 4} and sum(map(len, version.parts.values())) <= 4
    assert as_set(index.store.history(), "operation") >= {("ingest",), ("compact",)}


def test_events_are_hashed_and_folded_once(spark, tmp_path, monkeypatch):
    from millrace.plans import event_index

    folds, real = [], event_index.fold_events
    monkeypatch.setattr(event_index, "fold_events", lambda *a: folds.append(1) or real(*a))
    index = EventIndex(spark, str(tmp_path / "i"), buckets=2)
    index.ingest(events(spark, [1, 2, 2]))
    done = index.ingest(events(spark, [2, 3, 4]), completed=ingest_events(events(spark, [4]), index.read(), index.read()).created)
    assert len(folds) == 2 and done.outcome["events_created"] == 1 and numbers(index) == [1, 2, 3]
