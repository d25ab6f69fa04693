from __future__ import annotations

import glob
import hashlib
import os

import pytest
from pyspark.sql import functions as F

from millrace.llm import warc

SMALL = warc.Archive(file_bytes=1_500, shard_bytes=2_000)
SCHEMA = "page_id long, url string, html string"


def pages(spark, parts=3):
    rows = [(i, f"http://h{i % 4}.org/{i}", f"<p>{'text ' * (i % 40)}{i % 23}</p>") for i in range(120)]
    rows += [(None, None, None), (None, "http://x.org/\r\nX: y", "<p>none</p>"), (200, "http://e.org/ä b", ""), (201, None, "")]
    rows += [(7, "http://h3.org/7", rows[7][2])] * 2 + [(7, "http://other.org", "different")]
    return spark.createDataFrame(rows, SCHEMA).withColumns(
        {c: F.lit(1) for c in ("id", "tie", "kind", "shard", "digest", "size", "payload", "leader_id", "name", "k")}
    ).repartition(parts)


def files_of(folder):
    return {os.path.basename(f): hashlib.sha256(open(f, "rb").read()).hexdigest() for f in glob.glob(f"{folder}/*.warc.gz")}


def test_same_files_whatever_the_partitioning(spark, tmp_path):
    found = []
    for parts in (1, 7):
        folder = str(tmp_path / f"a{parts}")
        listed = warc.write_archive(pages(spark, parts), folder, SMALL).collect()
        found.append(files_of(folder))
        assert {r["name"]: r["sha256"] for r in listed} == found[-1]
        assert not os.path.exists(f"{folder}/_temporary")
    assert found[0] == found[1] and len(found[0]) > 5
    # Some shard is more than one file, each closed soon after it reached its size.
    assert max(r["seq"] for r in listed) > 0
    assert all(r["bytes"] < SMALL.file_bytes + 1_200 for r in listed)


def test_records_read_back(spark, tmp_path):
    folder = str(tmp_path / "a")
    rows = pages(spark)
    warc.write_archive(rows, folder, SMALL)
    back = warc.read_archive(spark, folder).collect()
    given = [(r["page_id"], r["html"] or "") for r in rows.collect()]
    assert len(back) == len(given)
    # A null id ranks below all others.
    leader = {}
    for page_id, html in given:
        if html not in leader or (leader[html] is None) or (page_id is not None and page_id > leader[html]):
            leader[html] = page_id if page_id is not None else leader.get(html)
    responses = {r["record_id"]: r for r in back if r["record_type"] == "response"}
    assert len(responses) == len(leader)
    text = {d["payload_digest"]: bytes(d["payload"]).decode() for d in responses.values()}
    assert sorted(text.values()) == sorted(leader)
    for r in back:
        html = text[r["payload_digest"]]
        assert r["payload_bytes"] == len(html.encode())
        if r["record_type"] == "revisit":
            assert r["payload"] is None and r["refers_to_row"] == leader[html]
            assert responses[r["refers_to"]]["payload_digest"] == r["payload_digest"]
        else:
            assert r["row_id"] == leader[html] and r["refers_to_row"] is None
    assert sorted((r["row_id"] or -1, text[r["payload_digest"]]) for r in back) == sorted((i or -1, h) for i, h in given)
    assert all("\r" not in r["target_uri"] and "\n" not in r["target_uri"] for r in back)
    assert len({r["record_id"] for r in back}) == len(back)


def test_smaller_payloads_are_never_revisits(spark):
    rows = spark.createDataFrame([(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abc"), (4, "u", "abc")], SCHEMA)
    got = warc.archive_pages(rows, warc.Archive(least_bytes=3)).collect()
    assert {(r["page_id"], r["record_type"], r["refers_to"]) for r in got} == {
        (1, "response", None), (2, "response", None), (3, "revisit", 4), (4, "response", None),
    }


def test_empty_table_and_no_ids(spark):
    empty = warc.archive_pages(spark.createDataFrame([], SCHEMA))
    assert empty.count() == 0
    assert empty.columns == ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    got = warc.archive_pages(spark.createDataFrame([(None, "a", "x"), (None, "b", "x")], SCHEMA)).collect()
    assert sorted(r["record_type"] for r in got) == ["response", "revisit"]
    assert {(r["page_id"], r["refers_to"]) for r in got} == {(None, None)}


def test_a_stop_leaves_no_archive_and_a_second_run_completes_it(spark, tmp_path, monkeypatch):
    folder = str(tmp_path / "a")

    def stop(*_):
        raise RuntimeError("stopped")

    monkeypatch.setattr(warc, "_commit", stop)
    with pytest.raises(RuntimeError, match="stopped"):
        warc.write_archive(pages(spark), folder, SMALL)
    assert files_of(folder) == {} and not os.path.exists(f"{folder}/manifest")
    monkeypatch.undo()
    warc.write_archive(pages(spark), folder, SMALL)
    assert warc.read_archive(spark, folder).count() == pages(spark).count()
    with pytest.raises(FileExistsError):
        warc.write_archive(pages(spark), folder, SMALL)


def test_files_of_lost_attempts_are_not_listed(spark, tmp_path):
    folder = str(tmp_path / "a")
    os.makedirs(f"{folder}/_temporary")
    open(f"{folder}/_temporary/pages-00000-00000.warc.gz.lost", "wb").write(b"half a rec")
    warc.write_archive(pages(spark), folder, SMALL)
    assert warc.read_archive(spark, folder).count() == pages(spark).count()


def test_damage_is_found(spark, tmp_path):
    folder = str(tmp_path / "a")
    rows = spark.createDataFrame([(1, "u", "some text here")], SCHEMA)
    name = warc.write_archive(rows, folder).first()["name"]
    data = open(f"{folder}/{name}", "rb").read()
    open(f"{folder}/{name}", "wb").write(data[:-20])
    with pytest.raises(Exception, match="breaks off"):
        warc.read_archive(spark, folder).count()
    parts = list(warc.members(open_bytes(data)))
    with pytest.raises(ValueError, match="damaged"):
        warc.parse_record(parts[1].replace(b"some", b"same"))


def open_bytes(data):
    import io

    return io.BytesIO(data)


def test_very_long_page(spark):
    rows = spark.createDataFrame([(1, "u", "é" * 3_000_000), (2, "u", "x")], SCHEMA)
    got = {r["page_id"]: r["payload_bytes"] for r in warc.archive_pages(rows).collect()}
    assert got == {1: 6_000_000, 2: 1}
