"""Jobs that write: sync, load, refresh, marts, sinks, streams."""

from __future__ import annotations

import datetime as dt
import json

import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from row_sets import as_set
from millrace.functions.sqltypes import column
from millrace.operators.events import checked_events
from millrace.operators.quality import check_unique
from millrace.plans.load import LoadFailed, copy_table, load_file, refresh_tables
from millrace.plans.marts import Marts, SnapshotOf, build_marts, save_snapshot
from millrace.plans.reporting import revenue_by
from millrace.plans.sync import sync
from millrace.session import scratch_dir
from millrace.sources import files, streams, tables, writers
from millrace.streaming.incremental import ingest_stream, read_store, sync_stream

DAY = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)


def frame(spark, rows, ddl="k int, v string"):
    return spark.createDataFrame(rows, ddl)


def counts(result):
    return result.inserted, result.updated, result.unchanged, result.duplicates, result.skipped


@pytest.mark.parametrize("strategy", ["full", "delta"])
def test_keyed_sync(spark, database, strategy):
    name = f"{database}.t"
    first = sync(frame(spark, [(1, "a"), (2, "b"), (2, "b")]), name, keys=["k"], run_time=DAY)
    assert first.table_created and counts(first) == (2, 0, 0, 1, 0)
    again = sync(frame(spark, [(1, "a"), (2, "b")]), name, keys=["k"], strategy=strategy)
    assert counts(again) == (0, 0, 2, 0, 0)
    third = sync(
        frame(spark, [(2, "B"), (3, "c")]), name, keys=["k"], strategy=strategy,
        run_time=DAY + dt.timedelta(days=1),
    )
    assert counts(third) == (1, 1, 0, 0, 0)
    assert as_set(spark.table(name), "k", "v") == {(1, "a"), (2, "B"), (3, "c")}
    assert not spark.catalog.tableExists(f"{name}__old")


def test_partitioned_sync_leaves_other_partitions_alone(spark, database):
    name = f"{database}.p"
    rows = [(1, "a", "x"), (2, "a", "y"), (3, "b", "z")]
    ddl = "k int, p string, v string"
    sync(frame(spark, rows, ddl), name, keys=["k", "p"], partition_by=["p"])
    untouched = {f for f in spark.table(name).inputFiles() if "p=b" in f}
    done = sync(frame(spark, [(1, "a", "X"), (4, "a", "n")], ddl), name, keys=["k", "p"])
    assert counts(done) == (1, 1, 0, 0, 0)
    assert {f for f in spark.table(name).inputFiles() if "p=b" in f} == untouched
    assert as_set(spark.table(name), "k", "v") == {(1, "X"), (2, "y"), (3, "z"), (4, "n")}
    with pytest.raises(ValueError, match="part of the merge key"):
        sync(frame(spark, rows, ddl), name, keys=["k"], partition_by=["p"])


def test_checksum_sync(spark, database):
    name = f"{database}.c"
    assert counts(sync(frame(spark, [(1, "a"), (1, "a"), (2, "b")]), name)) == (2, 0, 0, 1, 0)
    assert counts(sync(frame(spark, [(1, "a"), (1, "A")]), name)) == (1, 0, 1, 0, 0)
    assert spark.table(name).count() == 3


def test_sync_options(spark, database):
    name = f"{database}.o"
    with pytest.raises(ValueError, match="does not exist"):
        sync(frame(spark, [(1, "a")]), name, mode="existing")
    with pytest.raises(ValueError, match="mapped names"):
        sync(frame(spark, [(1, "a")]), name, keys=["k"], mapping={"k": "id"})
    target = T.StructType([column("id", "BIGINT", nullable=False), column("v", "NVARCHAR(MAX)")])
    spark.sql(f"CREATE TABLE {name} (id BIGINT, v STRING) USING parquet")
    done = sync(
        frame(spark, [(1, "a", 0)], "k int, v string, extra int"), name,
        keys=["id"], mapping={"k": "id"}, mode="existing",
    )
    assert counts(done) == (1, 0, 0, 0, 0)
    assert spark.table(name).columns == ["id", "v", "_sync_checksum", "_sync_updated_at"]
    assert target["id"].nullable is False
    with pytest.raises(Exception, match="MERGE|row-level|UNSUPPORTED"):
        sync(frame(spark, [(1, "b")], "id int, v string"), name, keys=["id"], strategy="merge_into")
    with pytest.raises(ValueError, match="does not fit"):
        sync(frame(spark, [("x", "a")], "id string, v string"), name, keys=["id"])


def test_sync_contract(spark, database):
    contract = T.StructType([column("k", "INT", nullable=False), column("v", "NVARCHAR(9)", nullable=False)])
    rows = frame(spark, [(1, "a"), (2, None), (3, "c")])
    with pytest.raises(ValueError, match="1 rows lack required values"):
        sync(rows, f"{database}.strict", keys=["k"], contract=contract)
    done = sync(rows, f"{database}.t", keys=["k"], contract=contract, on_bad="skip")
    assert counts(done) == (2, 0, 0, 0, 1) and done.status == "partial"
    assert done.errors[0]["k"] == 2 and done.errors[0]["_reject_reasons"] == ["v is null"]
    with pytest.raises(ValueError, match="NOT NULL"):
        sync(rows.select("k"), f"{database}.t", keys=["k"], contract=contract)


def test_sync_replaces_personal_data(spark, database):
    name, people = f"{database}.s", f"{database}.pii"
    rows = frame(spark, [(1, "Ann"), (2, "Bob")])
    for _ in range(2):
        done = sync(rows, name, keys=["k"], pii_config=["v"], source_system="crm", pii_table=people)
    assert counts(done) == (0, 0, 2, 0, 0)
    assert spark.table(people).count() == 2
    assert all(r.v.startswith("V_") for r in spark.table(name).collect())


def test_swap_that_was_cut_short(spark, database):
    name = f"{database}.w"
    writers.write_table(frame(spark, [(1, "a")]), name, "fail")
    spark.sql(f"ALTER TABLE {name} RENAME TO {name}__old")
    assert writers.recover(spark, name) and not writers.recover(spark, name)
    assert spark.table(name).count() == 1


def test_write_modes(spark, database):
    name = f"{database}.m"
    rows = frame(spark, [(1, "a")])
    writers.write_table(rows, name, "fail")
    with pytest.raises(Exception, match="exists"):
        writers.write_table(rows, name, "fail")
    writers.write_table(rows.select("v", "k"), name, "append")
    assert as_set(spark.table(name)) == {(1, "a")} and spark.table(name).count() == 2
    writers.write_table(rows, name, "replace")
    assert spark.table(name).count() == 1
    with pytest.raises(ValueError, match="does not exist"):
        writers.write_table(rows, "no_such_db.t")
    with pytest.raises(ValueError):
        writers.write_table(rows, name, "merge")
    assert writers.add_sync_columns(spark, name) == ["_sync_checksum", "_sync_updated_at"]
    assert writers.add_sync_columns(spark, name) == []
    writers.reload_table(
        rows.withColumn("_sync_checksum", F.lit("c")).withColumn(
            "_sync_updated_at", F.current_timestamp()
        ),
        name,
    )
    assert spark.table(name).first()._sync_checksum == "c"
    plain = f"{database}.u"
    writers.write_table(rows, plain, "fail")
    writers.append_missing(frame(spark, [(1, "z"), (2, "b"), (2, "b")]), plain, ["k"])
    assert as_set(spark.table(plain)) == {(1, "a"), (2, "b")}
    assert writers.batch_size_for(10) == 3000 and writers.batch_size_for(100) == 650


def test_audit_rows(spark, database):
    name = f"{database}.audit"
    writers.record_sync(spark, name, "shop", "cache", DAY)
    writers.record_sync(
        spark, name, "shop", "cache", DAY, completed_at=DAY, status="completed", records=5
    )
    assert spark.table(name).count() == 2
    latest = writers.latest_syncs(spark.table(name)).first()
    assert (latest.sync_status, latest.records_synced) == ("completed", 5)


def test_load_file(spark, database):
    name, rejects = f"{database}.items", f"{database}.rejects"
    target = T.StructType([column("id", "INT", nullable=False), column("size", "INT")])
    raw = frame(spark, [("1", "5"), ("2", "#N/A"), ("#REF!", "1")], "No string, Size string")
    mapping = {"no": "id", "size": "size"}
    done = load_file(raw, name, mapping=mapping, target=target, rejects=rejects)
    assert (done.status, done.rows_written, done.rows_rejected, done.table_created) == (
        "partial", 2, 1, True,
    )
    assert done.error_rate == 33.3 and done.errors[0]["_reject_reasons"] == ["id: no usable value"]
    assert spark.table(rejects).count() == 1
    load_file(raw.limit(1), name, mapping=mapping, target=target, if_exists="replace")
    assert as_set(spark.table(name), "id", "size") == {(1, 5)}
    assert spark.table(name).where("_sync_created_at IS NULL").count() == 0
    with pytest.raises(ValueError, match="exists already"):
        load_file(raw, name, mapping=mapping, if_exists="fail")
    with pytest.raises(LoadFailed):
        load_file(frame(spark, [("x", "1")], "No string, Size string"), name, mapping=mapping, target=target)
    with pytest.raises(ValueError, match="does not exist"):
        load_file(raw, f"{database}.none", auto_create=False)
    fresh = load_file(raw, f"{database}_new.made")
    assert fresh.table_created and spark.table(f"{database}_new.made").count() == 3
    spark.sql(f"DROP DATABASE {database}_new CASCADE")


def test_refresh_and_copy(spark, database):
    writers.write_table(frame(spark, [(1, "a")], "`a-b` int, v string"), f"{database}.src", "fail")
    with pytest.raises(ValueError, match="not found"):
        refresh_tables(spark, ["src", "nope"], database, database, "x")
    got = refresh_tables(spark, ["src"], database, database, "erp-x").collect()
    assert [(r.status, r.n_rows) for r in got] == [("success", 1)]
    assert spark.table(f"{database}.erp_x_src").columns == ["a_b", "v"]
    writers.write_table(frame(spark, [(1, 2)], "`a-b` int, `a b` int"), f"{database}.bad", "fail")
    assert refresh_tables(spark, ["bad"], database, database, "x").first().status == "error"
    assert copy_table(spark, spark.table(f"{database}.src"), f"{database}.cp") == 1
    assert copy_table(spark, spark.table(f"{database}.src"), f"{database}.cp") == 1


def test_typed_scan(spark):
    declared = T.StructType(
        [column("b", "BIT"), column("u", "UNIQUEIDENTIFIER"), column("t", "TIME"), column("d", "DECIMAL(10,2)")]
    )
    raw = spark.createDataFrame(
        [(b"\x01", "x", dt.datetime(2024, 1, 1, 9, 8, 7), 1.5), (None, None, None, None)],
        "b binary, u string, t timestamp, d double",
    )
    rows = tables.typed_values(raw, declared).collect()
    assert (rows[0].b, rows[0].t, str(rows[0].d)) == (True, "09:08:07", "1.50")
    assert tuple(rows[1]) == (None, None, None, None)


def test_query_guard(spark):
    assert tables.scan_query(spark, " SELECT 1 AS a; ").first().a == 1
    assert tables.scan_query(spark, "WITH x AS (SELECT 2 AS a) SELECT * FROM x").first().a == 2
    for text in ("", "  ", "DELETE FROM t", "SELECTED"):
        with pytest.raises(ValueError):
            tables.scan_query(spark, text)
    with pytest.raises(ValueError, match="bounds"):
        tables.jdbc_table(spark, {}, "t", partition_column="id")


def test_catalogue(spark, database):
    rows = {"a": frame(spark, [(1, "x")]), "b": frame(spark, [])}
    got = {r.table_name: r for r in tables.inventory(rows).collect()}
    assert got["a"].n_rows == 1 and got["b"].n_rows == 0
    assert [c.name for c in got["a"].columns] == ["k", "v"]
    assert tables.column_catalogue(spark, rows).count() == 4
    writers.write_table(rows["a"], f"{database}.one", "fail")
    assert as_set(tables.database_inventory(spark, database), "table_name", "n_rows") == {("one", 1)}


def test_ragged_text_and_seed(spark, database, tmp_path):
    (tmp_path / "a.csv").write_text("a,b,c\n1,2,3\n4\n5,6,7,8\n")
    got = files.scan_delimited(spark, str(tmp_path), files.text_columns(["a", "b", "c"]))
    assert as_set(got) == {("1", "2", "3"), ("4", None, None), ("5", "6", "7")}
    schema = T.StructType([T.StructField(n, T.IntegerType()) for n in "abc"])
    for _ in range(2):
        files.load_seed(spark, str(tmp_path), schema, f"{database}.seed")
    assert spark.table(f"{database}.seed").count() == 3


def test_sheets_from_bytes(spark, tmp_path):
    book = {"first": [{"a": "1"}, {"a": "2"}], "second": [{"a": "3"}]}
    for name in ("x.book", "y.book"):
        (tmp_path / name).write_text(json.dumps(book))

    def parse(data, path, wanted):
        for sheet, rows in json.loads(data).items():
            yield sheet, pd.DataFrame(rows)

    schema = files.text_columns(["a", "b"])
    path = str(tmp_path)
    assert files.scan_sheets(spark, path, schema, parse).count() == 4
    assert files.scan_sheets(spark, path, schema, parse, None).count() == 6
    named = files.scan_sheets(spark, path, schema, parse, ["second"])
    assert as_set(named, "sheet", "a", "b") == {("second", "3", None)}


def test_streams(spark, tmp_path):
    (tmp_path / "orders.json").write_text(
        json.dumps({"data": [{"order_id": 1.0, "customer_name": "a"}, {"order_id": 2.0}]})
    )
    orders = streams.Stream(
        "sales_orders", str(tmp_path),
        {"order_id": {"type": "number"}, "customer_name": {"type": ["null", "string"]}}, ["data"],
    )
    other = streams.Stream("other", "x")
    assert [s.name for s in streams.select_streams([orders, other], ["other"])] == ["other"]
    assert len(streams.select_streams([orders, other])) == 2
    with pytest.raises(ValueError, match="unknown"):
        streams.select_streams([orders], ["nope"])
    rows = streams.read_stream(spark, orders)
    assert as_set(rows) == {(1.0, "a"), (2.0, None)}
    tally = streams.record_counts({"sales_orders": rows, "none": rows.limit(0)})
    assert as_set(tally) == {("sales_orders", 2), ("none", 0)}
    assert streams.total_processed(tally).first()[0] == 2


def test_snapshot_table_is_repeatable(spark, database):
    name = f"{database}.hist"
    first = SnapshotOf(frame(spark, [(1, "a"), (2, "b")]), ["k"])
    second = SnapshotOf(frame(spark, [(1, "A")]), ["k"])
    save_snapshot(spark, name, first, DAY)
    for _ in range(2):
        save_snapshot(spark, name, second, DAY + dt.timedelta(days=1))
    closed = spark.table(name).where("valid_to IS NOT NULL")
    assert as_set(closed, "k", "v") == {(1, "a"), (2, "b")} and closed.count() == 2
    assert as_set(spark.table(name).where("is_open"), "k", "v") == {(1, "A")}


def test_build_stops_at_first_failure(spark, database):
    rows = frame(spark, [(1, "a", 5)], "k int, v string, line_total int")

    def broken(read):
        raise RuntimeError("core is broken")

    marts = Marts(
        snapshots={"snap": SnapshotOf(rows, ["k"])},
        staging={"stg": lambda read: read("snap").where("valid_to IS NULL")},
        core={"fct": broken},
        reporting={"rpt": lambda read: revenue_by(read("fct"), ["v"], profit=None)},
    )
    with pytest.raises(RuntimeError):
        build_marts(spark, marts, database, DAY)
    assert spark.catalog.tableExists(f"{database}.snap")
    assert not spark.catalog.tableExists(f"{database}.rpt")
    good = Marts(
        snapshots=marts.snapshots, staging=marts.staging, core={"fct": lambda read: read("stg")},
        reporting=marts.reporting,
        checks={"none": lambda read: check_unique(read("fct"), ["k"]), "all": lambda read: read("fct")},
    )
    built = build_marts(spark, good, database, DAY)
    assert built.names == ["snap", "stg", "fct", "rpt"] and built.findings == {"none": 0, "all": 1}
    assert spark.table(f"{database}.rpt").first().revenue == 5


def land(spark, folder, rows):
    spark.createDataFrame(rows, "event_type string, event_data string").coalesce(1).write.mode(
        "append"
    ).parquet(folder)


def test_event_stream_takes_each_event_once(spark):
    landed, store, progress = (scratch_dir(spark, n) for n in ("in", "store", "progress"))
    done = checked_events(frame(spark, [("t", '{"n":9}')], "event_type string, event_data string"))
    archive = scratch_dir(spark, "archive")
    done.select("event_hash").write.parquet(archive)

    def run():
        rows = spark.readStream.schema("event_type string, event_data string").parquet(landed)
        ingest_stream(
            rows, store, progress, completed=lambda s: s.read.parquet(archive)
        ).awaitTermination()
        return read_store(spark, store).count()

    land(spark, landed, [("t", '{"n":1}'), ("t", '{"n": 1}'), ("t", '{"n":2}'), ("t", "junk")])
    assert run() == 2
    assert run() == 2
    land(spark, landed, [("t", '{"n":2}'), ("t", '{"n":3}'), ("t", '{"n":9}')])
    assert run() == 3


def test_events_count_as_new_however_late(spark):
    landed, store, progress = (scratch_dir(spark, n) for n in ("in", "store", "progress"))
    ddl = "event_type string, event_data string, at timestamp"
    rows = spark.readStream.schema(ddl).parquet
    day = dt.timedelta(days=1)
    for batch in ([("t", "1", DAY + 31 * day)], [("t", "2", DAY + 32 * day)], [("t", "3", DAY), ("t", "4", DAY + 33 * day)]):
        spark.createDataFrame(batch, ddl).coalesce(1).write.mode("append").parquet(landed)
        ingest_stream(rows(landed), store, progress).awaitTermination()
    assert as_set(read_store(spark, store), "event_data") == {("1",), ("2",), ("3",), ("4",)}


def test_row_stream_sync(spark, database):
    landed, progress = scratch_dir(spark, "in"), scratch_dir(spark, "progress")
    name = f"{database}.rows"

    def run(rows):
        frame(spark, rows).coalesce(1).write.mode("append").parquet(landed)
        stream = spark.readStream.schema("k int, v string").parquet(landed)
        sync_stream(stream, name, progress, keys=["k"]).awaitTermination()
        return as_set(spark.table(name), "k", "v")

    assert run([(1, "a"), (2, "b")]) == {(1, "a"), (2, "b")}
    assert run([(2, "B"), (3, "c")]) == {(1, "a"), (2, "B"), (3, "c")}


# ---- what a sync refuses, keeps and counts ----------------------------------

def test_sync_refuses_rows_with_reasons(spark, database):
    contract = T.StructType([column("k", "INT"), column("v", "NVARCHAR(3)")])
    rows = frame(spark, [(1, "abc"), (3_000_000_000, "a"), (2, "abcdefgh"), (None, "x")], "k long, v string")
    done = sync(rows, f"{database}.r", keys=["k"], contract=contract, on_bad="skip")
    assert counts(done) == (1, 0, 0, 0, 3)
    reasons = sorted(r for e in done.errors for r in e["_reject_reasons"])
    assert reasons == ["k does not fit int", "k is null", "v is longer than 3 characters"]
    assert as_set(spark.table(f"{database}.r"), "k", "v") == {(1, "abc")}
    with pytest.raises(ValueError, match="3 rows"):
        sync(rows, f"{database}.r", keys=["k"], contract=contract)


def test_sync_repeated_with_its_run_time(spark, database):
    rows = frame(spark, [(k, "a") for k in range(10)])
    for want in ((10, 0, 0, 0, 0), (0, 0, 10, 0, 0)):
        assert counts(sync(rows, f"{database}.t", keys=["k"], run_time=DAY)) == want
    changed = frame(spark, [(k, "b" if k < 3 else "a") for k in range(11)])
    assert counts(sync(changed, f"{database}.t", keys=["k"], run_time=DAY)) == (1, 3, 7, 0, 0)
    assert counts(sync(changed, f"{database}.t", keys=["k"], run_time=DAY, strategy="delta")) == (0, 0, 11, 0, 0)


def test_sync_keeps_the_shape_of_the_table(spark, database):
    name = f"{database}.p"
    spark.sql(f"CREATE TABLE {name} (k INT, v STRING) USING parquet PARTITIONED BY (v) TBLPROPERTIES ('owner_team' = 'x')")
    sync(frame(spark, [(1, "a"), (2, "b")]), name, keys=["k"])
    sync(frame(spark, [(2, "c")]), name, keys=["k"])
    assert [c.name for c in spark.catalog.listColumns(name) if c.isPartition] == ["v"]
    assert as_set(spark.table(name), "k", "v") == {(1, "a"), (2, "c")}
    assert as_set(spark.sql(f"SHOW TBLPROPERTIES {name} ('owner_team')")) == {("owner_team", "x")}
    appended = f"{database}.q"
    spark.sql(f"CREATE TABLE {appended} (k INT, v STRING) USING parquet PARTITIONED BY (v)")
    sync(frame(spark, [(1, "a")]), appended)
    assert counts(sync(frame(spark, [(1, "a"), (2, "b")]), appended))[0] == 1
    assert as_set(spark.table(appended), "k", "v") == {(1, "a"), (2, "b")}


def test_realistic_replacements_need_a_mapping_table(spark, database):
    rows = frame(spark, [(1, "Ann")])
    config = {"v": {"field_type": "name"}}
    with pytest.raises(ValueError, match="mapping table"):
        sync(rows, f"{database}.s", keys=["k"], pii_config=config)
    people = f"{database}.people"
    for n in (200, 400):
        before = as_set(spark.table(f"{database}.s"), "k", "v") if n > 200 else set()
        sync(frame(spark, [(k, f"p{k}") for k in range(n)]), f"{database}.s", keys=["k"], pii_config=config, pii_table=people)
        assert before <= as_set(spark.table(f"{database}.s"), "k", "v")


def test_load_of_new_columns(spark, database):
    name = f"{database}.l"
    ddl = "id int, v string"
    load_file(spark.createDataFrame([(1, "a")], ddl), name)
    wide = T.StructType([column("id", "INT"), column("v", "NVARCHAR(9)"), column("w", "INT")])
    more = spark.createDataFrame([(2, "b", 3)], "id int, v string, w int")
    with pytest.raises(ValueError, match="'w'"):
        load_file(more, name, target=wide)
    assert load_file(more, name, target=wide, if_exists="replace").rows_written == 1
    assert as_set(spark.table(name), "id", "v", "w") == {(2, "b", 3)}


def test_snapshot_of_an_emptied_source(spark, database):
    name = f"{database}.h"
    rows = frame(spark, [(1, "a"), (2, "b")])
    save_snapshot(spark, name, SnapshotOf(rows, ["k"]), DAY)
    for _ in range(2):
        save_snapshot(spark, name, SnapshotOf(rows.limit(0), ["k"]), DAY + dt.timedelta(days=1))
    stored = spark.table(name)
    assert stored.count() == 2 and stored.where("valid_to IS NULL OR is_open").count() == 0


# ---- event jobs ---------------------------------------------------------------

def test_a_move_that_stops_between_its_writes(spark, database, monkeypatch):
    from millrace.plans import events as jobs

    tables = jobs.EventTables(database)
    rows = spark.createDataFrame([("t", '{"n":1}'), ("t", '{"n":2}'), ("t", "junk"), ("t", '{"n":1}')], "event_type string, event_data string")
    done = jobs.ingest(rows, tables)
    assert (done.total, done.created, done.duplicate, done.failed, done.status) == (4, 2, 1, 1, "partial")
    assert done.created_ids.count() == 2 and done.failures.count() == 1
    assert jobs.ingest(rows, tables).created == 0
    ids = [r.id for r in spark.table(tables.store).orderBy("event_data").collect()]
    result = (ids[0], "success", 200, "{}", None, None, "u", "POST", "{}")
    ddl = "event_id long, status string, status_code int, data string, error string, response_headers string, integration_url string, integration_request_method string, integration_payload string"
    for want in ("inserted", "updated"):
        assert as_set(jobs.log_results(spark.createDataFrame([result], ddl), tables), "action") == {(want,)}
    swap, calls = writers.swap_in, []

    def stops(*args):
        calls.append(args)
        raise RuntimeError("stopped")

    monkeypatch.setattr(writers, "swap_in", stops)
    with pytest.raises(RuntimeError):
        jobs.archive(spark, tables)
    monkeypatch.setattr(writers, "swap_in", swap)
    assert spark.table(tables.completed).count() == 1 and spark.table(tables.store).count() == 2
    assert jobs.archive(spark, tables) == 0
    assert (spark.table(tables.completed).count(), spark.table(tables.store).count(), spark.table(tables.logs).count()) == (1, 1, 0)
    assert jobs.ingest(rows, tables).created == 0


def test_switch_and_audit(spark, database):
    rows = frame(spark, [(1, "Ann")])
    sync(rows, f"{database}.off", keys=["k"], pii_config=["v"], pii_switch="false", audit=f"{database}.audit")
    assert spark.table(f"{database}.off").first().v == "Ann"
    load_file(rows, f"{database}.on", pii_config=["v"], pii_switch="yes", audit=f"{database}.audit")
    assert spark.table(f"{database}.on").first().v.startswith("V_")
    assert sorted(r.sync_status for r in spark.table(f"{database}.audit").collect()) == ["running", "running", "success", "success"]


def test_a_source_of_single_keys_is_not_deduplicated(spark, database, monkeypatch):
    from millrace.operators import merge

    ran, joined = [], []
    real, real_join = merge.dedupe_source, merge.merge_keyed
    monkeypatch.setattr(merge, "dedupe_source", lambda *a: ran.append(1) or real(*a))
    monkeypatch.setattr(merge, "merge_keyed", lambda *a: joined.append(1) or real_join(*a))
    rows = spark.createDataFrame([(i, f"v{i}") for i in range(20)], "id long, v string")
    first = sync(rows, f"{database}.single", keys=["id"])
    # Nor is an empty table joined with it.
    assert (first.inserted, ran, joined) == (20, [], [])
    again = sync(rows.union(rows.where("id < 5")), f"{database}.single", keys=["id"])
    assert (again.inserted, again.unchanged, again.duplicates, ran, joined) == (0, 20, 5, [1], [1])
    assert spark.table(f"{database}.single").where("_sync_updated_at IS NOT NULL").count() == 20
