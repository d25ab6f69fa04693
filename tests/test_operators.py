"""Operators on small frames."""

from __future__ import annotations

import datetime as dt
import json
import warnings

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from row_sets import as_set
from millrace.functions.sqltypes import column
from millrace.operators import (
    access,
    entities,
    events,
    mapping,
    merge,
    ordered,
    pii,
    quality,
    relations,
    schema,
    sheets,
    snapshot,
)
from millrace.plans import staging
from millrace.session import stored_rows

def now():
    return F.lit("2024-05-01").cast("timestamp")


# ---- mapping -------------------------------------------------------------

def test_mapping_checks(spark):
    report = mapping.check_mapping({"a": "x", "b": "x", "z": "c"}, ["a", "b", "c"])
    assert report.missing_sources == ["z"]
    assert report.duplicate_targets == ["x"]
    assert report.conflicts == ["c"]
    df = spark.createDataFrame([(1, 2, 3)], "a int, b int, c int")
    with pytest.raises(ValueError):
        mapping.rename_columns(df, {"z": "y"})
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        assert mapping.rename_columns(df, {"z": "y", "a": "k"}, strict=False).columns == ["k", "b", "c"]
    with pytest.raises(ValueError, match="mapped names"):
        mapping.check_merge_keys(["a"], {"a": "k"})
    mapping.check_merge_keys(["k"], {"a": "k"})


def test_map_columns(spark):
    df = spark.createDataFrame([(1, "n", "drop")], "Id int, Name string, Rest string")
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        out = mapping.map_columns(df, {"ID": "key", "Name": "label", "gone": "extra"})
    assert out.columns == ["key", "label", "extra"]
    assert tuple(out.first()) == (1, "n", None)
    assert mapping.map_columns(df, {}).columns == df.columns
    assert mapping.table_name("erp-db", "Order Item") == "erp_db_Order_Item"
    assert mapping.snake_case("CustomerName") == "customer_name"
    with pytest.raises(ValueError, match="clash"):
        mapping.clean_column_names(spark.createDataFrame([(1, 2)], ["a-b", "a b"]))


# ---- schema --------------------------------------------------------------

DESTINATION = T.StructType(
    [
        column("id", "INT", nullable=False),
        column("name", "NVARCHAR(100)", nullable=False),
        column("amount", "DECIMAL(18,2)"),
        column("created_at", "DATETIME2"),
        column("_sync_checksum", "VARCHAR(64)"),
        column("_sync_updated_at", "DATETIME2"),
    ]
)


@pytest.mark.parametrize(
    ("ddl", "rows", "valid", "issue"),
    [
        ("id int, name string, amount double, created_at timestamp", [(1, "a", 1.0, None)], True, None),
        ("id int, amount double", [(1, 1.0)], False, "required columns missing: name"),
        ("id int, name string", [(1, "a")], True, None),
        ("id int, name string, more int", [(1, "a", 2)], True, "ignored: more"),
        ("id string, name string", [("x", "a")], False, "type mismatches: id"),
        ("id int, name string", [(1, "a"), (2, None)], False, "name is NOT NULL but has 1 nulls"),
        ("id int, name string, _sync_checksum string", [(1, "a", None)], True, None),
    ],
)
def test_validate_frame(spark, ddl, rows, valid, issue):
    report = schema.validate_frame(spark.createDataFrame(rows, ddl), DESTINATION)
    assert report.is_valid is valid
    if issue:
        assert any(issue in text for text in report.issues)


def test_validate_reports_all(spark):
    df = spark.createDataFrame([("x", 1)], "id string, more int")
    assert len(schema.validate_frame(df, DESTINATION).issues) == 3


def test_compare_schema():
    expected = T.StructType([column("id", "BIGINT"), column("other", "BIT")])
    report = schema.compare_schema(DESTINATION, expected)
    assert not report.is_valid
    assert report.missing_columns == ["other"]
    assert report.extra_columns == ["name", "amount", "created_at"]
    bare = T.StructType([column("id", "INT")])
    assert not schema.compare_schema(bare, T.StructType([column("id", "INT")])).has_checksum_column


def test_infer_schema(spark):
    df = spark.createDataFrame(
        [(1, 1.5, "abc", True, None), (2, 2.5, "x" * 300, False, None)],
        "i int, f float, s string, b boolean, n string",
    )
    wide = schema.infer_schema(df)
    assert [f.metadata["sql_type"] for f in wide] == [
        "BIGINT", "FLOAT", "NVARCHAR(MAX)", "BIT", "NVARCHAR(MAX)",
    ]
    assert all(f.nullable for f in wide)
    sized = schema.infer_schema(df, sized=True, force_nullable=False)
    assert sized["s"].metadata["sql_type"] == "NVARCHAR(350)"
    assert [f.nullable for f in sized] == [False, False, False, False, True]


def test_conform_and_coerce(spark):
    target = T.StructType(
        [
            column("id", "INT", nullable=False),
            column("serial", "BIGINT", nullable=False, identity=True),
            column("label", "NVARCHAR(3)"),
            column("day", "DATE"),
            column("flag", "BIT"),
            column("note", "NVARCHAR(50)"),
        ]
    )
    raw = spark.createDataFrame(
        [("1", "abcdef", "2024-01-02", "yes"), ("2.5", "b", "never", "?"), (None, "c", None, None)],
        "id string, label string, day string, flag string",
    )
    tagged = schema.coerce(schema.conform(raw, target), target)
    assert as_set(schema.accepted(tagged)) == {(1, "abc", dt.date(2024, 1, 2), True, None)}
    assert schema.rejected(tagged).count() == 2
    assert [r.note for r in quality.first_errors(tagged, "label").collect()] == [None, None]
    outcome = quality.load_outcome(tagged).first()
    assert (outcome.status, outcome.rows_written, outcome.rows_rejected, outcome.failed) == (
        "partial", 1, 2, True,
    )
    with pytest.raises(ValueError, match="not in the target"):
        schema.conform(raw.withColumn("zz", F.lit(1)), target)
    with pytest.raises(ValueError, match="NOT NULL"):
        schema.conform(raw.drop("id"), target)
    assert schema.drop_generated(raw.withColumn("serial", F.lit(1)), target).columns == raw.columns


def test_narrow_refuses_long_text(spark):
    df = spark.createDataFrame([("x" * 11,)], "record_type string")
    with pytest.raises(Exception, match="longer than 10"):
        schema.narrow(df).collect()


# ---- merge ---------------------------------------------------------------

def table_of(spark, rows, at="2024-01-01"):
    df = merge.with_checksum(spark.createDataFrame(rows, "k int, v string"))
    return df.withColumn("_sync_updated_at", F.lit(at).cast("timestamp"))


def test_merge_updates_changed_rows(spark):
    target = table_of(spark, [(1, "a"), (2, "b"), (3, "c")]).withColumn(
        "_sync_checksum", F.when(F.col("k") != 3, F.col("_sync_checksum"))
    )
    source = merge.with_checksum(
        spark.createDataFrame([(1, "a"), (2, "B"), (3, "c"), (4, "d"), (4, "dd")], "k int, v string")
    )
    single = merge.dedupe_source(source, ["k"], [F.desc("v")])
    merged = merge.merge_keyed(target, single, ["k"], now())
    assert as_set(merged, "k", "v", merge.ACTION) == {
        (1, "a", "unchanged"), (2, "B", "updated"), (3, "c", "updated"), (4, "dd", "inserted"),
    }
    changes = merge.merge_changes(target, single, ["k"], now())
    delta = merge.merge_delta(target, changes, ["k"])
    assert as_set(delta) == as_set(merged.drop(merge.ACTION))
    assert as_set(merge.duplicate_keys(source, ["k"])) == {(4, 2)}
    assert merge.distinct_keys(source, ["k"]) == 4


def test_null_keys_match_nothing(spark):
    source = merge.with_checksum(
        spark.createDataFrame([(None, "a"), (None, "b"), (1, "c")], "k int, v string")
    )
    target = table_of(spark, [(None, "a"), (1, "x")])
    merged = merge.merge_keyed(target, merge.dedupe_source(source, ["k"]), ["k"], now())
    assert sorted((r.v, r[merge.ACTION]) for r in merged.collect()) == [
        ("a", "inserted"), ("a", "kept"), ("b", "inserted"), ("c", "updated"),
    ]


def test_first_per_key_filters_before_the_shuffle(spark):
    df = spark.range(1000).select(
        F.when(F.col("id") < 990, 0).otherwise(F.col("id")).alias("k"), F.col("id").alias("v")
    )
    plan = merge.first_per_key(df, ["k"], [F.desc("v")])._jdf.queryExecution().toString()
    assert plan.count("WindowGroupLimit") >= 2
    assert merge.first_per_key(df, ["k"], [F.desc("v")]).where("k = 0").first().v == 989


def test_checksum_only_and_insert_or_ignore(spark):
    target = table_of(spark, [(1, "a")])
    source = merge.with_checksum(
        spark.createDataFrame([(1, "a"), (2, "b"), (2, "b"), (1, "z")], "k int, v string")
    )
    assert as_set(merge.merge_checksum_only(target, source), "k", "v") == {(2, "b"), (1, "z")}
    assert as_set(merge.insert_or_ignore(target, source, ["k"]), "k", "v") == {(2, "b")}


# ---- personal data -------------------------------------------------------

PEOPLE = [(1, "Ann"), (2, " ann "), (3, "BOB"), (4, None), (5, "")]


def people(spark):
    return spark.createDataFrame(PEOPLE, "id int, name string")


def test_pii_defaults(spark):
    out, rows = pii.anonymize(people(spark), ["name", "absent"], "crm")
    got = dict(out.collect())
    assert got[1] == got[2] and got[1].startswith("NAME_") and len(got[1]) == 64
    assert got[4] is None and got[5].startswith("NAME_")
    assert rows.count() == 3
    same, none = pii.anonymize(people(spark), ["name"], "crm", enabled=False)
    assert as_set(same) == set(PEOPLE) and none.count() == 0


def test_pii_stored_wins_and_is_scoped(spark):
    _, rows = pii.anonymize(people(spark), {"name": {"replacement_prefix": "OLD_"}}, "crm")
    stored = rows.unionByName(rows.withColumn("source_system", F.lit("other")))
    out, new = pii.anonymize(people(spark), ["name"], "crm", None, stored)
    assert all(v is None or v.startswith("OLD_") for _, v in out.collect())
    assert new.count() == 0
    _, elsewhere = pii.anonymize(people(spark), ["name"], "crm", "other context", stored)
    assert elsewhere.count() == 3


def test_every_field_type_gives_a_text(spark):
    df = spark.range(50).select(F.sha2(F.col("id").cast("string"), 256).alias("h"))
    for locale in pii.POOLS:
        texts = [pii.realistic_text(F.col("h"), k, locale).alias(k) for k in pii.FIELD_TYPES]
        rows = df.select(*texts).collect()
        assert all(v and v.strip() == v for r in rows for v in r)
        assert all(len({r[k] for r in rows}) > 20 for k in pii.FIELD_TYPES)


@pytest.mark.parametrize("kind", ["city", "email", "postcode"])
def test_realistic_values_are_unique_and_repeat(spark, kind):
    df = spark.range(400).select(F.concat(F.lit("p"), "id").alias("v"))
    cfg = {"v": {"field_type": kind, "max_length": 40}}
    first, rows = pii.anonymize(df, cfg, "s")
    stored = spark.createDataFrame(rows.collect(), rows.schema)
    texts = as_set(first)
    assert len(texts) == 400 and all(len(t) <= 40 for (t,) in texts)
    again, none = pii.anonymize(df, cfg, "s", None, stored)
    assert none.count() == 0 and as_set(again) == texts


def test_realistic_continues_after_stored(spark):
    cfg = {"v": {"field_type": "city", "locale": "de_DE"}}
    old = spark.range(300).select(F.concat(F.lit("p"), "id").alias("v"))
    _, rows = pii.anonymize(old, cfg, "s")
    more = spark.range(200, 600).select(F.concat(F.lit("p"), "id").alias("v"))
    out, new = pii.anonymize(more, cfg, "s", None, rows)
    assert new.count() == 300
    texts = rows.unionByName(new).select("replacement_value")
    assert texts.distinct().count() == 600 and out.distinct().count() == 400


def test_pii_bad_options(spark):
    assert [pii.switched_on(t) for t in (None, "", "yes", " False ", "0", "no")] == [
        True, True, True, False, False, False,
    ]
    with pytest.raises(ValueError):
        pii.prefixed_text(F.lit("ab"), "f", max_length=0)
    with pytest.raises(ValueError):
        pii.realistic_text(F.lit("ab"), "shoe size")
    with pytest.raises(ValueError, match="locale"):
        pii.realistic_text(F.lit("ab"), "name", "xx_XX")


# ---- events --------------------------------------------------------------

def incoming(spark, *rows):
    return spark.createDataFrame(list(rows), "event_type string, event_data string")


def stored(spark, *rows):
    df = events.checked_events(incoming(spark, *rows)) if rows else None
    if df is None:
        return spark.createDataFrame([], "event_hash string")
    return df.select("event_hash")


@pytest.mark.parametrize(
    ("new", "in_store", "archived", "want"),
    [
        ([1, 2], [1], [], (1, 1, 0, "success")),
        ([1, 2], [1, 2], [], (0, 2, 0, "success")),
        ([1, 2, 3], [1], [2], (1, 2, 0, "success")),
        ([1, 1, 1, 2], [], [], (2, 2, 0, "success")),
        ([1, 2, None], [], [], (2, 0, 1, "partial")),
        ([None, None], [], [], (0, 0, 2, "error")),
    ],
)
def test_ingest(spark, new, in_store, archived, want):
    def rows(ids):
        return [("t", "broken {" if i is None else json.dumps({"id": i})) for i in ids]

    got = events.ingest_events(
        incoming(spark, *rows(new)), stored(spark, *rows(in_store)), stored(spark, *rows(archived))
    )
    o = got.outcome.first()
    assert (o.events_created, o.events_duplicate, o.events_failed, o.status) == want
    assert got.created.count() == want[0]
    assert got.invalid.count() == want[2]
    total = got.duplicates.agg(F.coalesce(F.sum("n_rows"), F.lit(0))).first()[0]
    assert total == want[1]


def test_ingest_missing_fields_and_batches(spark):
    none = stored(spark)
    got = events.ingest_events(
        incoming(spark, (None, "{}"), ("t", None), ("t", '{"a":1}'), ("t", '{"a":2}'), ("t", '{"a":3}'),
                 ("t", '{"a":4}'), ("t", '{"a":5}')),
        none, none, batch_size=2,
    )
    assert as_set(got.invalid, "_problem") == {("missing event_type",), ("missing event_data",)}
    assert got.outcome.first().batches == 3
    df = spark.createDataFrame([("t",)], "event_type string")
    assert events.ingest_events(df, none, none).outcome.first().status == "error"


def test_batch_numbers(spark):
    df = spark.range(0, 10, 1, 2)
    whole = events.batch_numbers(df, 3, F.col("id"))
    assert [r.batch_no for r in whole.orderBy("id").collect()] == [1, 1, 1, 2, 2, 2, 3, 3, 3, 4]
    split = events.batch_numbers(df, 3)
    assert split.groupBy("batch_partition", "batch_no").count().where("count > 3").count() == 0
    assert split.groupBy("batch_partition", "batch_no").count().count() == 4


def day(n):
    return dt.datetime(2024, 1, n)


def log(i, event, at, status, url="u", method="POST", payload="{}"):
    return (i, event, at, status, "{}", None if status == "SUCCESS" else "HTTP 500", url, method, payload)


@pytest.fixture()
def event_tables(spark):
    store = spark.createDataFrame(
        [(i, "t" if i < 5 else "u", day(10 - i), "{}", f"h{i}") for i in range(1, 6)],
        events.EVENT_SCHEMA,
    )
    logs = spark.createDataFrame(
        [
            log(11, 2, day(1), "FAILED"),
            log(12, 3, day(1), "FAILED"),
            log(13, 3, day(2), "SUCCESS"),
            log(14, 4, day(2), "SUCCESS", url=None),
        ],
        events.LOG_SCHEMA,
    )
    return store, logs


def test_pending(event_tables):
    store, logs = event_tables
    got = [(r.id, r.latest_log.id if r.latest_log else None)
           for r in events.pending_events(store, logs, "t").collect()]
    assert got == [(2, 11), (1, None)]
    loose = [r.id for r in events.pending_events(store, logs, "t", any_failed=True).collect()]
    assert loose == [3, 2, 1]


def test_archive(event_tables):
    store, logs = event_tables
    got = events.archive_completed(store, logs)
    row = got.completed.first()
    assert got.completed.count() == 1 and len(got.completed.columns) == 11
    assert (row.event_id, row.event_hash, row.integration_completed_status) == (3, "h3", "SUCCESS")
    assert as_set(got.store, "id") == {(1,), (2,), (4,), (5,)}
    assert as_set(got.logs, "id") == {(11,), (14,)}


RESULT = (
    "event_id long, status string, status_code int, data string, error string, "
    "response_headers map<string,string>"
)


def test_log_outcomes(spark, event_tables):
    _, logs = event_tables
    results = spark.createDataFrame(
        [
            (1, "success", 200, "{}", None, None),
            (3, "error", None, None, "refused", None),
            (0, "success", 200, None, None, None),
            (2, "done", 200, None, None, None),
        ],
        RESULT,
    )
    got = events.log_outcomes(results, logs, run_time=now())
    assert as_set(got.actions) == {(1, "inserted"), (3, "updated")}
    assert as_set(got.invalid, "event_id", "_problem") == {
        (0, "event_id is not positive"), (2, "bad status"),
    }
    rows = {r.id: r for r in got.logs.collect()}
    assert rows[13].processed_status == "FAILED" and rows[13].processed_result_error == "refused"
    assert rows[12].processed_at == day(1)
    assert {r.event_id for r in rows.values()} == {1, 2, 3, 4} and len(rows) == 5
    with pytest.raises(ValueError, match="lack columns"):
        events.log_outcomes(results.drop("error"), logs)
    texts = results.withColumn("status_code", F.lit("20x"))
    assert "status_code is not an integer" in {r._problem for r in events.check_results(texts).collect()}


# ---- snapshots -----------------------------------------------------------

def test_snapshot_life_of_rows(spark):
    def state(rows):
        return spark.createDataFrame(rows, "k int, v string")

    history = snapshot.empty_history(spark, T.StructType(
        [T.StructField("k", T.IntegerType()), T.StructField("v", T.StringType())]
    ))
    for n, rows in enumerate([[(1, "a"), (2, "b")], [(1, "A")], [(1, "A"), (2, "b")]], 1):
        history = snapshot.snapshot(state(rows), history, ["k"], F.lit(day(n)))
    assert as_set(history, "k", "v", "valid_from", "valid_to") == {
        (1, "a", day(1), day(2)), (1, "A", day(2), None),
        (2, "b", day(1), day(2)), (2, "b", day(3), None),
    }
    assert snapshot.current_versions(history).count() == 2
    with pytest.raises(ValueError):
        snapshot.snapshot(state([(1, "a")]), history, ["k"], now(), strategy="guess")
    with pytest.raises(ValueError):
        snapshot.snapshot(state([(1, "a")]), history, ["k"], now(), strategy="timestamp")


def test_version_intervals_of_one_hot_key(spark):
    start = F.lit("2024-01-01").cast("timestamp")
    minutes = spark.range(3000).select(
        F.lit(1).alias("k"),
        (F.floor(F.col("id") / 7) % 5).alias("v"),
        (start + F.make_dt_interval(mins=F.col("id").cast("int"))).alias("at"),
    )
    got = snapshot.version_intervals(minutes, ["k"], "at")
    rows = sorted((r.valid_from, r.valid_to, r.v) for r in got.collect())
    assert len(rows) == -(-3000 // 7)
    assert all(a[1] == b[0] and a[2] != b[2] for a, b in zip(rows, rows[1:]))
    assert rows[-1][1] is None


def test_neighbour_matches_plain_window(spark):
    df = spark.range(500).select(
        (F.col("id") % 3).alias("k"), ((F.col("id") * 37) % 501).alias("o"), F.col("id").alias("v")
    )
    got = ordered.with_neighbour(df, ["k"], [F.col("o")], F.col("v"), "n", following=True)
    df.createOrReplaceTempView("neighbours")
    want = spark.sql("SELECT k, o, lead(v) OVER (PARTITION BY k ORDER BY o) FROM neighbours")
    assert as_set(got, "k", "o", "n") == as_set(want)


def test_neighbours_of_one_key_within_one_hour(spark):
    """Nine rows in ten are of one key and one hour, a third of them of one instant."""
    n = 90_000
    instant = F.when(F.col("id") % 3 == 0, 1800).otherwise(F.col("id") * 7919 % 3600)
    df = spark.range(n).select(
        F.when(F.col("id") % 10 == 1, F.col("id")).when(F.col("id") % 10 == 2, None).otherwise(0).alias("k"),
        instant.alias("o"), F.col("id").alias("v"),
    )
    # Rows this few would be put together in one range again.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        ranged = ordered.in_ranges(df, ["k"], [F.col("o")])
        spread = sorted(r["count"] for r in ranged.groupBy("_range").count().collect())
        assert len(spread) > 4 and spread[-1] <= 2 * spread[len(spread) // 2]
        _same_as_plain_window(spark, df, n)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def _same_as_plain_window(spark, df, n):
    order = [F.col("o"), F.col("v")]
    for following, name in ((True, "lead"), (False, "lag")):
        got = ordered.with_neighbour(df, ["k"], order, F.col("v"), "n", following=following)
        df.createOrReplaceTempView("one_hour")
        want = spark.sql(f"SELECT k, v, {name}(v) OVER (PARTITION BY k ORDER BY o, v) AS n FROM one_hour")
        assert got.count() == n and got.select("k", "v", "n").exceptAll(want).count() == 0


# ---- quality -------------------------------------------------------------

def test_quality(spark):
    child = spark.createDataFrame([(1, 1), (2, 9), (3, 9), (4, None)], "id int, fk int")
    parent = spark.createDataFrame([(1,), (2,)], "id int")
    assert as_set(quality.check_foreign_key(child, "fk", parent, "id")) == {(9, 2)}
    assert as_set(quality.orphan_rows(child, "fk", parent, "id"), "id") == {(2,), (3,)}
    assert as_set(quality.cascade_delete(child, "fk", parent.where("id = 1"), "id"), "id") == {
        (2,), (3,), (4,),
    }
    assert as_set(quality.check_unique(child, ["fk"])) == {(9, 2)}
    assert as_set(quality.check_not_null(child, ["id", "fk"])) == {("id", 0), ("fk", 1)}
    assert quality.table_counts(spark, "no_such_table", "no_such_table") == (-1, -1)
    results = spark.createDataFrame(
        [("a", "success", 5), ("b", "error", 0)], "table_name string, status string, n_rows long"
    )
    assert tuple(quality.sync_summary(results).first()) == (2, 1, 1, 5, "partial")


# ---- relations -----------------------------------------------------------

def test_nesting_in_pages_keeps_every_child(spark):
    parent = spark.createDataFrame([(1,), (2,), (3,)], "id int")
    child = spark.range(1000).select(
        F.when(F.col("id") < 990, 1).otherwise(2).alias("fk"), F.col("id").alias("v")
    )
    whole = relations.nest_children(parent, child, "id", "fk", "kids", order_by=[F.col("v")])
    sizes = {r.id: (r.kids_page, [k.v for k in r.kids]) for r in whole.collect()}
    assert sizes[1] == (0, list(range(990))) and sizes[2][1] == list(range(990, 1000))
    assert sizes[3] == (0, [])
    paged = relations.nest_children(
        parent, child, "id", "fk", "kids", order_by=[F.col("v")], columns=["v"], page_size=100
    ).collect()
    first = [[k.v for k in r.kids] for r in sorted(paged, key=lambda r: r.kids_page) if r.id == 1]
    assert [len(p) for p in first] == [100] * 9 + [90]
    assert [v for p in first for v in p] == list(range(990))
    down = relations.nest_children(parent, child, "id", "fk", "kids", order_by=[F.desc("v")], columns=["v"])
    assert [k.v for k in down.where("id = 1").first().kids] == list(range(989, -1, -1))
    text = child.withColumn("t", F.lpad(F.col("v").cast("string"), 4, "0"))
    down = relations.nest_children(parent, text, "id", "fk", "kids", order_by=[F.desc("t")], columns=["t"], page_size=7)
    pages = sorted(down.where("id = 2").collect(), key=lambda r: r.kids_page)
    assert [k.t for p in pages for k in p.kids] == [f"{v:04}" for v in range(999, 989, -1)]
    top = relations.nest_children(
        parent, child, "id", "fk", "kids", order_by=[F.desc("v")], limit=2
    )
    assert {r.id: [k.v for k in r.kids] for r in top.collect()} == {1: [989, 988], 2: [999, 998], 3: []}


def test_text_in_parts_of_the_order(spark):
    df = spark.range(600).select(
        F.when(F.col("id") < 300, "a").when(F.col("id") < 500, "b").otherwise("c").alias("k"),
        F.col("id").alias("v"),
    )
    rows = relations.joined_text(df, ["k"], F.col("v"), ",", "t", part_rows=100).collect()
    parts = {k: [r for r in rows if r.k == k] for k in "abc"}
    assert len(parts["a"]) == 3 and len(parts["b"]) == 2 and len(parts["c"]) == 1
    ordered = [r.t for k in "abc" for r in sorted(parts[k], key=lambda r: r.part)]
    assert ",".join(ordered) == ",".join(map(str, range(600)))
    assert all(sorted(r.part for r in p) == list(range(len(p))) for p in parts.values())


def test_joined_text_in_parts(spark):
    df = spark.range(50).select(F.lit("a").alias("k"), F.col("id").alias("v"))
    assert relations.joined_text(df, ["k"], F.col("v"), ",", "t").first().t == ",".join(
        map(str, range(50))
    )
    parts = relations.joined_text(df, ["k"], F.col("v"), ",", "t", part_rows=10).collect()
    assert sorted(int(v) for p in parts for v in p.t.split(",")) == list(range(50))


def test_where(spark, event_tables):
    store, logs = event_tables
    graph = relations.relationship_graph(
        {"event_store": store, "event_processed_logs": logs},
        [relations.ForeignKey("event_processed_logs", "event_id", "event_store")],
    )
    tree = {
        "_and": [
            {"event_type": {"_eq": "t"}},
            {"_or": [
                {"event_processed_logs_aggregate": {"count": {"predicate": {"_eq": 0}}}},
                {"event_processed_logs": {"processed_status": {"_eq": "FAILED"}}},
            ]},
        ]
    }
    assert as_set(relations.where(store, tree, graph["event_store"]), "id") == {(1,), (2,), (3,)}
    up = {"event": {"event_type": {"_eq": "t"}}, "processed_status": {"_in": ["FAILED"]}}
    assert as_set(relations.where(logs, up, graph["event_processed_logs"]), "id") == {(11,), (12,)}
    assert relations.where(store, {"_not": {"id": {"_gt": 2}}}).count() == 2
    assert relations.where(store, {"id": {"_in": []}}).count() == 0
    assert relations.count_where(store, {}).first()["count"] == 5
    with pytest.raises(ValueError):
        relations.where(store, {"nope": {"_eq": 1}})
    with pytest.raises(ValueError):
        relations.where(store, {"id": {"_like": "x"}})
    nested = relations.embed_parent(logs, store, "event_id", "id", "event")
    assert as_set(nested, "id", "event.event_hash") == {(11, "h2"), (12, "h3"), (13, "h3"), (14, "h4")}


# ---- access --------------------------------------------------------------

def test_access(spark):
    rows = spark.createDataFrame([(1, 7, "x"), (2, 8, "y")], "id int, user_id int, secret string")
    policy = {
        "User": {
            "select": {"columns": ["id"], "filter": {"user_id": {"_eq": "X-User-Id"}}},
            "insert": {"columns": ["id", "user_id"], "check": {"user_id": {"_eq": "X-User-Id"}}},
        },
    }
    seen = access.secure_view(rows, policy, "User", {"x-user-id": "7"})
    assert seen.columns == ["id"] and as_set(seen) == {(1,)}
    nobody = access.secure_view(rows, policy, "Stranger", {})
    assert nobody.columns == [] and nobody.count() == 0
    with pytest.raises(access.NotPermitted, match="session"):
        access.secure_view(rows, policy, "User", {})
    with pytest.raises(access.NotPermitted, match="aggregate"):
        access.secure_aggregate(rows, policy, "User", {"X-User-Id": 7}, F.count("*"))
    with pytest.raises(access.NotPermitted, match="columns"):
        access.check_insert(rows, policy, "User", {"X-User-Id": 7})
    tagged = access.check_insert(rows.drop("secret"), policy, "User", {"X-User-Id": 7})
    assert as_set(access.permitted(tagged), "id") == {(1,)}
    assert as_set(access.refused(tagged), "id") == {(2,)}
    with pytest.raises(access.NotPermitted):
        access.check_delete(rows, policy, "User", {})


# ---- entities ------------------------------------------------------------

RUN = {"data_run_source": "s", "data_run_organization": "o", "data_run_pipeline": "p", "data_run_id": "r"}
ART = {
    "data_artifact_source": "as", "data_artifact_organization": "ao",
    "data_artifact_repository": "ar", "data_artifact_id": "ai",
}


@pytest.mark.parametrize(
    ("record", "entity", "want"),
    [
        ({"data_artifact_source": "as", "data_artifact_organization": "ao"}, "organization",
         {"id": "as|ao", "uid": "ao", "source": "as"}),
        ({"data_run_source": "s", "data_run_organization": "o"}, "organization",
         {"id": "s|o", "uid": "o", "source": "s"}),
        (ART, "repository", {"id": "as|ao|ar", "organization": "as|ao", "uid": "ar"}),
        (RUN, "pipeline", {"id": "s|o|p", "organization": "s|o", "uid": "p"}),
        ({**RUN, "run_status": {"category": "A", "detail": "B"}}, "build",
         {"id": "s|o|p|r", "pipeline": "s|o|p", "statusCategory": "A", "statusDetail": "B",
          "startedAt": None}),
        ({**RUN, "run_start_time": "2031-02-28T23:59:01Z", "run_end_time": "2031-03-01T00:07:40Z"},
         "build", {"startedAt": dt.datetime(2031, 2, 28, 23, 59, 1),
                   "endedAt": dt.datetime(2031, 3, 1, 0, 7, 40)}),
        (ART, "artifact", {"id": "as|ao|ar|ai", "repository": "as|ao|ar", "build": None, "uid": "ai"}),
        ({**ART, **RUN}, "artifact", {"build": "s|o|p|r"}),
        ({**ART, "data_commit_source": "cs", "data_commit_organization": "co",
          "data_commit_repository": "cr", "data_commit_sha": "sha"}, "artifact_commit_association",
         {"id": "as|ao|ar|ai|cs|co|cr|sha", "commit": "cs|co|cr|sha", "artifact": "as|ao|ar|ai"}),
        ({**ART, "data_deploy_source": "ds", "data_deploy_id": "di"}, "artifact_deployment",
         {"id": "as|ao|ar|ai|ds|di", "deployment": "ds|di"}),
        ({"uid": "u", "name": "n", "platform": "pl"}, "application",
         {"id": "u", "name": "n", "platform": "pl"}),
    ],
)
def test_entities(spark, record, entity, want):
    rows = spark.createDataFrame([{**record, "data_origin": "test"}], entities.RECORD_SCHEMA)
    found = entities.fan_out(rows, only=[entity])[entity].collect()
    assert len(found) == 1
    got = found[0].asDict()
    assert {k: got[k] for k in want} == want and got["origin"] == "test"


def test_entities_once_per_id(spark):
    rows = spark.createDataFrame([ART, {**ART, **RUN}, ART], entities.RECORD_SCHEMA)
    found = entities.fan_out(rows)
    artifact = found["artifact"].collect()
    assert len(artifact) == 1 and artifact[0].build == "s|o|p|r"
    assert found["organization"].count() == 2 and found["application"].count() == 0


def test_entities_in_one_pass(spark, tmp_path):
    rows = [{**ART, **RUN, "data_artifact_id": str(k), "uid": "u", "data_origin": "test"} for k in range(40)]
    spark.createDataFrame(rows, entities.RECORD_SCHEMA).write.parquet(str(tmp_path / "records"))
    every = entities.entity_rows(spark.read.parquet(str(tmp_path / "records")))
    plan = every._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("Exchange hashpartitioning") == 1
    assert {r["entity"]: r["count"] for r in every.groupBy("entity").count().collect()} == {
        "organization": 2, "repository": 1, "pipeline": 1, "build": 1, "artifact": 40, "application": 1,
    }


def test_equal_records_are_dealt_to_many_tasks(spark):
    rows = spark.createDataFrame([{**ART, **RUN}] * 2000, entities.RECORD_SCHEMA).coalesce(1)
    tasks = entities.dealt(rows, 100).groupBy(F.spark_partition_id().alias("task")).count().collect()
    assert sum(r["count"] for r in tasks) == 2000 and max(r["count"] for r in tasks) < 200
    assert entities.entity_rows(entities.dealt(rows, 100)).count() == 6
    assert entities.dealt(rows, 2000) is rows and entities.dealt(rows.limit(0)).count() == 0


def test_entities_are_sorted_without_a_second_copy_of_their_columns(spark):
    every = entities.entity_rows(spark.createDataFrame([ART], entities.RECORD_SCHEMA))
    plan = every._jdf.queryExecution().executedPlan().toString()
    sort = next(line for line in plan.splitlines() if "Sort [" in line)
    assert "fields" in sort and "struct(" not in sort and "statusCategory" not in sort


# ---- sheets and staging --------------------------------------------------

def test_split_wide(spark):
    columns = ["id", "x.1", "Unnamed: 2", "Unnamed: 3", "id.1", "y", "y.1", "Unnamed: 7", "z"]
    ddl = ", ".join(f"`{c}` string" for c in columns)
    rows = [("1", "a", None, None, None, None, None, None, None),
            ("2", None, None, None, "5", "b", "c", None, None)]
    found = sheets.split_wide(spark.createDataFrame(rows, ddl), "s")
    assert set(found) == {"s_table_1", "s_table_2"}
    assert found["s_table_1"].columns == ["id", "x"] and found["s_table_1"].count() == 2
    assert found["s_table_2"].columns == ["id", "y", "y.1"] and found["s_table_2"].count() == 1
    plain = spark.createDataFrame([("1", None)], "`a.1` string, b string")
    assert sheets.split_wide(plain, "s")["s_table_1"].columns == ["a.1", "b"]
    assert sheets.table_columns(["Unnamed: 0", "a", "Unnamed: 2", "b"]) == {1: ["a"], 2: ["b"]}


def test_staging(spark):
    history = spark.createDataFrame(
        [(1, "Y", " a ", None), (2, "n", "  ", None), (3, "y", "c", day(1))],
        "id int, is_active string, account string, valid_to timestamp",
    )
    staged = staging.stage_dimension(
        history, flags=["is_active"], trimmed=["account"], required=["account"]
    )
    assert as_set(staged) == {(1, True, "a")}
    assert len(staging.CUSTOMER_FLAGS) == 9 and len(staging.PRODUCT_FLAGS) == 11


def test_equal_maps_have_one_checksum(spark):
    a = spark.sql("SELECT map('x', 1, 'y', 2) AS m, array(map(2, 'b', 1, 'a')) AS n")
    b = spark.sql("SELECT map('y', 2, 'x', 1) AS m, array(map(1, 'a', 2, 'b')) AS n")
    c = spark.sql("SELECT map('y', 2, 'x', 3) AS m, array(map(1, 'a', 2, 'b')) AS n")
    sums = [merge.with_checksum(d).first()["_sync_checksum"] for d in (a, b, c)]
    assert sums[0] == sums[1] != sums[2]


def test_sheet_names_lose_only_their_number(spark):
    names = sheets.plain_names(["Price incl. VAT", "No. of items.1", "a.1", "b", "b.1"])
    assert names == {"Price incl. VAT": "Price incl. VAT", "No. of items.1": "No. of items", "a.1": "a", "b": "b", "b.1": "b.1"}


@pytest.mark.parametrize("kind, length", [("city", 8), ("address", 30), ("name", 12)])
def test_realistic_texts_stay_distinct_when_cut(spark, kind, length):
    people = spark.range(3000).select(F.concat(F.lit("p"), "id").alias("v"))
    config = {"v": {"field_type": kind, "max_length": length}}
    _, first = pii.anonymize(people.where("substr(v, 2) < 1500"), config, "crm", None, pii.empty_mapping(spark))
    stored = stored_rows(first)
    out, more = pii.anonymize(people, config, "crm", None, stored)
    values = [r.v for r in out.collect()]
    assert len(set(values)) == 3000 and max(map(len, values)) <= length
    assert stored.join(more, "replacement_value").count() == 0
    with pytest.raises(Exception, match="distinct"):
        pii.anonymize(people, {"v": {"field_type": kind, "max_length": 1}}, "crm", None, pii.empty_mapping(spark))[0].collect()
