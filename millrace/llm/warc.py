"""Deterministic sharded WARC writer, and a reader of what it wrote.

Records are range-sorted by row id into shards. Shard borders come from a sample chosen by
the hash of the rows, so they, the order in a shard and every header are functions of the
rows alone: the same table gives the same files, byte for byte, however it is partitioned.
A task streams its shard, one gzip member a record, and begins a new file when the one it
writes has reached its compressed size. Digests, lengths and record ids are made anew from
the payload.

A task writes under a temporary name of its own. Spark's commit decides which attempt of a
task counts, since the list of files is the task's result; only listed files are renamed,
and the manifest is written last. Without a manifest there is no archive.

Payloads that occur more than once become one ``response``, of the greatest id, and
``revisit`` records that refer to it.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote

import numpy as np
import pandas as pd
import pyarrow as pa
from pyarrow import fs as arrow_fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import arrow_rows, ship, unit_hash
from millrace.session import scratch_dir, stored_rows


@dataclass(frozen=True)
class Archive:
    """``file_bytes``: compressed size at which a file is closed. ``shard_bytes``: payload of
    a shard, until there are ``most_shards``; then shards grow, still cut into files.
    ``sample``: rows looked at for each border. ``least_bytes``: smaller payloads are never
    revisits. ``date`` stands in all records, as the rows have none."""

    file_bytes: int = 1 << 30
    shard_bytes: int = 16 << 20
    most_shards: int = 10_000
    sample: int = 64
    least_bytes: int = 0
    prefix: str = "pages"
    date: str = "1970-01-01T00:00:00Z"


MANIFEST_SCHEMA = "shard int, seq int, name string, part string, records long, bytes long, sha256 string"
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


# ---------------------------------------------------------------- files on any store

def qualified(spark: SparkSession, folder: str) -> str:
    """The folder with its scheme, so that tasks find the same store as the driver."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    full = path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toString()
    return "file://" + full[5:] if full.startswith("file:/") and not full.startswith("file://") else full


def store_of(uri: str) -> tuple[arrow_fs.FileSystem, str]:
    return arrow_fs.FileSystem.from_uri("s3" + uri[3:] if uri.startswith("s3a:") else uri)


def _delete(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


# ---------------------------------------------------------------- records

def digest_text(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(row_id: int | None, tie: int, turn: int) -> str:
    """The same for the same row in any run; ``turn`` tells repeated rows apart."""
    seed = hashlib.sha1(f"{row_id}/{tie}/{turn}".encode()).digest()[:16]
    return f"<urn:uuid:{uuid.UUID(bytes=seed, version=5)}>"


def target_uri(url: str | None, row_id: int | None) -> str:
    """The address without anything that could end a header line; a made-up one for none."""
    return quote(url, safe="!#$%&'()*+,/:;=?@[]~-._") if url else f"urn:row:{'' if row_id is None else row_id}"


def _http(payload_bytes: int) -> bytes:
    return (
        f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {payload_bytes}\r\n\r\n"
    ).encode()


def record(headers: list[tuple[str, str]], block: bytes) -> bytes:
    """One record as a gzip member without a time in it."""
    listed = [*headers, ("WARC-Block-Digest", f"sha1:{digest_text(block)}"), ("Content-Length", str(len(block)))]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in listed) + "\r\n"
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(head.encode()) + packer.compress(block) + packer.compress(b"\r\n\r\n") + packer.flush()


def page_record(row_id, tie: int, turn: int, url, payload: bytes, refers: tuple | None, date: str) -> bytes:
    """``refers`` is (row id, tie, address) of the response that a revisit stands for."""
    headers = [
        ("WARC-Type", "revisit" if refers else "response"),
        ("WARC-Record-ID", record_id(row_id, tie, turn)),
        ("WARC-Date", date),
        ("WARC-Target-URI", target_uri(url, row_id)),
        ("WARC-Payload-Digest", f"sha1:{digest_text(payload)}"),
        ("Content-Type", "application/http;msgtype=response"),
    ]
    if row_id is not None:
        headers.append(("X-Row-ID", str(row_id)))
    if refers:
        leader, leader_tie, leader_url = refers
        headers += [
            ("WARC-Profile", REVISIT),
            ("WARC-Refers-To", record_id(leader, leader_tie, 0)),
            ("WARC-Refers-To-Target-URI", target_uri(leader_url, leader)),
            ("WARC-Refers-To-Date", date),
        ]
        if leader is not None:
            headers.append(("X-Refers-To-Row-ID", str(leader)))
    # A revisit keeps the response's own headers, and with them the payload's length.
    return record(headers, _http(len(payload)) + (b"" if refers else payload))


class ShardFile:
    """One archive file under a temporary name; closing gives its line of the manifest."""

    def __init__(self, part_folder: str, shard: int, seq: int, how: Archive) -> None:
        self.shard, self.seq = shard, seq
        self.name = f"{how.prefix}-{shard:05d}-{seq:05d}.warc.gz"
        store, path = store_of(part_folder)
        store.create_dir(path, recursive=True)
        self.part = f"{self.name}.{uuid.uuid4().hex}"
        self.out = store.open_output_stream(f"{path}/{self.part}", compression=None)
        self.records, self.bytes, self.sum = 0, 0, hashlib.sha256()
        seed = hashlib.sha1(self.name.encode()).digest()[:16]
        self.add(
            record(
                [
                    ("WARC-Type", "warcinfo"),
                    ("WARC-Record-ID", f"<urn:uuid:{uuid.UUID(bytes=seed, version=5)}>"),
                    ("WARC-Date", how.date),
                    ("WARC-Filename", self.name),
                    ("Content-Type", "application/warc-fields"),
                ],
                b"software: millrace\r\nformat: WARC File Format 1.1\r\n",
            )
        )
        self.records = 0

    def add(self, member: bytes) -> None:
        self.out.write(member)
        self.sum.update(member)
        self.records += 1
        self.bytes += len(member)

    def close(self) -> tuple:
        self.out.close()
        return (self.shard, self.seq, self.name, self.part, self.records, self.bytes, self.sum.hexdigest())


# ---------------------------------------------------------------- shards

def order_key(known, ids, ties) -> np.ndarray:
    """Fixed-width byte strings in the order of (id known, id, tie); an unknown id comes as 0."""
    flip = np.int64(-(1 << 63))
    parts = np.empty((len(ids), 17), dtype=np.uint8)
    parts[:, 0] = np.asarray(known, dtype=np.uint8)
    for at, values in ((1, ids), (9, ties)):
        numbers = np.asarray(values, dtype=np.int64) ^ flip
        parts[:, at : at + 8] = numbers.astype(">i8").view(np.uint8).reshape(-1, 8)
    return parts.reshape(-1).view("S17")


def key_columns() -> list[Column]:
    known, number = F.col("id").isNotNull(), F.coalesce("id", F.lit(0).cast("long"))
    return [known.alias("known"), number.alias("number"), F.col("tie")]


def shard_borders(slim: DataFrame, how: Archive) -> tuple[int, np.ndarray]:
    """Number of shards, and the first key of each but the first.

    About ``sample`` rows a shard, chosen by their hash, are looked at on the driver: at most
    ``sample * most_shards`` in the mean, whatever the table.
    """
    rows, size = slim.agg(F.count("*"), F.sum("size")).first()
    shards = max(1, min(how.most_shards, -(-(size or 0) // how.shard_bytes), rows))
    if shards == 1:
        return 1, np.zeros(0, dtype="S17")
    share = min(1.0, how.sample * shards / rows)
    few = slim.where(unit_hash("id", "tie") < share).select(*key_columns(), "size").toArrow()
    keys = order_key(*(few[c].to_numpy() for c in ("known", "number", "tie")))
    order = np.argsort(keys)
    load = np.cumsum(few["size"].to_numpy()[order] + 1)
    cuts = np.searchsorted(load, np.arange(1, shards) * (load[-1] / shards), side="left") if len(load) else []
    return shards, keys[order][np.minimum(cuts, len(order) - 1)] if len(load) else np.zeros(0, dtype="S17")


def _copies(slim: DataFrame, how: Archive) -> DataFrame:
    """(id, tie, leader_id, leader_tie, leader_url) of the rows whose payload occurs again."""
    # The least of this struct has the greatest id, then the least tie; no id comes last.
    place = F.struct(F.col("id").isNull(), F.bitwise_not("id"), F.col("tie"), F.col("id"), F.col("url"))
    groups = (
        slim.where(F.col("size") >= how.least_bytes)
        .groupBy(F.struct("digest").alias("k"))
        .agg(F.count("*").alias("copies"), F.min(place).alias("first"))
        .where("copies > 1")
        .select(
            F.col("k.digest").alias("digest"),
            F.col("first.id").alias("leader_id"),
            F.col("first.tie").alias("leader_tie"),
            F.col("first.url").alias("leader_url"),
        )
    )
    return slim.select("id", "tie", "digest").join(groups, "digest").drop("digest").distinct()


def write_archive(
    rows: DataFrame, folder: str, how: Archive = Archive(), key: str = "page_id", url: str = "url", payload: str = "html"
) -> DataFrame:
    """Write the rows to ``folder``; returns the manifest. A folder with a manifest is an error.

    A null payload is an empty one, a null address a made-up one, and a null id sorts first.
    Rows that are equal in all three columns are records of their own. All records of one id
    and payload lie in one shard; other repeats of an id may lie in several. An empty table
    gives an empty manifest.
    """
    spark = rows.sparkSession
    ship(spark)
    home = qualified(spark, folder)
    store, path = store_of(home)
    if store.get_file_info(f"{path}/manifest/_SUCCESS").type != arrow_fs.FileType.NotFound:
        raise FileExistsError(f"{folder} holds an archive")
    parts = f"{home}/_temporary"
    content = F.coalesce(F.col(payload).cast("string"), F.lit("")).cast("binary")
    named = rows.select(
        F.col(key).cast("long").alias("id"), F.col(url).cast("string").alias("url"), content.alias("payload")
    )
    digest = F.unhex(F.sha1("payload"))
    slim = stored_rows(
        named.select("id", "url", digest.alias("digest"), F.length("payload").cast("long").alias("size")).withColumn(
            "tie", F.xxhash64("digest", "url")
        )
    )
    shards, borders = shard_borders(slim, how)

    @F.pandas_udf("int")
    def shard_of(known: pd.Series, ids: pd.Series, ties: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(borders, order_key(known, ids, ties), side="right").astype(np.int32))

    # What is known of a row comes just before it in the order, so no join meets a payload.
    blank = [F.lit(None).cast(t).alias(n) for n, t in
             (("leader_id", "long"), ("leader_tie", "long"), ("leader_url", "string"))]
    pages = named.withColumn("tie", F.xxhash64(digest, F.col("url"))).select(
        "id", "tie", F.lit(1).alias("kind"), "url", "payload", *blank
    )
    notes = _copies(slim, how).select(
        "id", "tie", F.lit(0).alias("kind"), F.lit(None).cast("string").alias("url"),
        F.lit(None).cast("binary").alias("payload"), "leader_id", "leader_tie", "leader_url",
    )
    both = notes.unionByName(pages).withColumn("shard", shard_of(*key_columns()))
    dealt = both.repartitionById(shards, "shard").sortWithinPartitions(
        "shard", F.asc_nulls_first("id"), "tie", "kind"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [f.split()[0] for f in MANIFEST_SCHEMA.split(", ")]
        done: list[tuple] = []
        file, at, refers, turn = None, None, None, 0
        for batch in batches:
            columns = {n: batch.column(n) for n in batch.schema.names}
            for i in range(batch.num_rows):
                shard, row_id, tie, kind, address, body, leader, leader_tie, leader_url = (
                    columns[c][i].as_py()
                    for c in ("shard", "id", "tie", "kind", "url", "payload", "leader_id", "leader_tie", "leader_url")
                )
                if at != (shard, row_id, tie):
                    at, refers, turn = (shard, row_id, tie), None, 0
                if kind == 0:
                    refers = (leader, leader_tie, leader_url)
                    continue
                if file is None or file.shard != shard or file.bytes >= how.file_bytes:
                    seq = file.seq + 1 if file is not None and file.shard == shard else 0
                    if file is not None:
                        done.append(file.close())
                    file = ShardFile(parts, shard, seq, how)
                own = refers is None or (refers[:2] == (row_id, tie) and turn == 0)
                file.add(page_record(row_id, tie, turn, address, body, None if own else refers, how.date))
                turn += 1
        if file is not None:
            done.append(file.close())
        kinds = [pa.int32(), pa.int32(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string()]
        lists = list(zip(*done, strict=True)) if done else [[] for _ in kinds]
        yield pa.record_batch([pa.array(c, t) for c, t in zip(lists, kinds, strict=True)], names=names)

    with arrow_rows(spark, 1_000, 8 << 20):
        written = stored_rows(dealt.mapInArrow(run, MANIFEST_SCHEMA))
    return _commit(spark, written, home)


def _commit(spark: SparkSession, written: DataFrame, home: str) -> DataFrame:
    """Give the listed files their names, then write the manifest; each step may be repeated."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, path = store_of(home)
        for batch in batches:
            for line in batch.itertuples():
                source, target = f"{path}/_temporary/{line.part}", f"{path}/{line.name}"
                if store.get_file_info(source).type != arrow_fs.FileType.NotFound:
                    store.move(source, target)
                if store.get_file_info(target).size != line.bytes:
                    raise OSError(f"{line.name} is not the file that was written")
            yield batch

    named = written.mapInPandas(run, MANIFEST_SCHEMA)
    named.write.mode("overwrite").parquet(f"{home}/manifest")
    _delete(spark, f"{home}/_temporary")
    return spark.read.schema(MANIFEST_SCHEMA).parquet(f"{home}/manifest")


# ---------------------------------------------------------------- reading

def members(stream, chunk: int = 1 << 18) -> Iterator[bytes]:
    """The gzip members of a stream, one in memory at a time."""
    unpack, parts, data = zlib.decompressobj(31), [], stream.read(chunk)
    while data:
        parts.append(unpack.decompress(data))
        if unpack.eof:
            yield b"".join(parts)
            data = unpack.unused_data or stream.read(chunk)
            unpack, parts = zlib.decompressobj(31), []
        else:
            data = stream.read(chunk)
    if any(parts):
        raise ValueError("the archive breaks off inside a record")


def parse_record(data: bytes) -> tuple[dict[str, str], bytes]:
    """Headers in lower case and the block, both checked for their form, length and digest."""
    head, found, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not found or not lines[0].startswith("WARC/"):
        raise ValueError("no WARC record")
    headers = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines[1:])}
    size = int(headers["content-length"])
    if rest[size:] != b"\r\n\r\n" or headers["warc-block-digest"] != f"sha1:{digest_text(rest[:size])}":
        raise ValueError(f"record {headers.get('warc-record-id')} is damaged")
    return headers, rest[:size]


READ_SCHEMA = (
    "name string, place long, record_type string, record_id string, target_uri string, row_id long, "
    "payload_digest string, payload_bytes long, refers_to string, refers_to_row long, payload binary"
)


def _page(name: str, place: int, data: bytes, payloads: bool) -> dict | None:
    headers, block = parse_record(data)
    if headers["warc-type"] not in ("response", "revisit"):
        return None
    http, _, payload = block.partition(b"\r\n\r\n")
    length = next(int(x.split(b":")[1]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:"))
    digest = headers["warc-payload-digest"].removeprefix("sha1:")
    whole = headers["warc-type"] == "response"
    if whole and (len(payload) != length or digest_text(payload) != digest):
        raise ValueError(f"payload of {headers['warc-record-id']} is damaged")
    number = lambda k: int(headers[k]) if k in headers else None
    return {
        "name": name, "place": place, "record_type": headers["warc-type"], "record_id": headers["warc-record-id"],
        "target_uri": headers["warc-target-uri"], "row_id": number("x-row-id"), "payload_digest": digest,
        "payload_bytes": length, "refers_to": headers.get("warc-refers-to"),
        "refers_to_row": number("x-refers-to-row-id"), "payload": payload if whole and payloads else None,
    }


def read_archive(spark: SparkSession, folder: str, payloads: bool = True) -> DataFrame:
    """The records of an archive, a file after the other in each task; every digest is checked."""
    ship(spark)
    home = qualified(spark, folder)
    manifest = spark.read.schema(MANIFEST_SCHEMA).parquet(f"{home}/manifest").select("name", "records")
    schema = pa.schema(
        [
            (n, {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}[t])
            for n, t in (f.split() for f in READ_SCHEMA.split(", "))
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, path = store_of(home)
        for batch in batches:
            for name, records in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                out, size, place = [], 0, 0
                with store.open_input_stream(f"{path}/{name}", compression=None) as stream:
                    for data in members(stream):
                        page = _page(name, place, data, payloads)
                        if page is None:
                            continue
                        out.append(page)
                        place, size = place + 1, size + len(data)
                        if size > 8 << 20:
                            yield pa.RecordBatch.from_pylist(out, schema=schema)
                            out, size = [], 0
                if place != records:
                    raise ValueError(f"{name} holds {place} of {records} records")
                yield pa.RecordBatch.from_pylist(out, schema=schema)

    # A line is a whole file, so the number of tasks follows the lines.
    files = manifest.repartition(max(1, min(10_000, manifest.count())), "name")
    return files.mapInArrow(run, READ_SCHEMA)


def archive_pages(pages: DataFrame, how: Archive = Archive(), folder: str | None = None) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type and refers_to as read back from the
    archive of the pages; a row for each page."""
    spark = pages.sparkSession
    folder = folder or scratch_dir(spark, "warc")
    write_archive(pages, folder, how)
    return read_archive(spark, folder, payloads=False).select(
        F.col("row_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        F.col("refers_to_row").alias("refers_to"),
    )


#: Base 32 is written out over the digits of the digest: five hexadecimal digits are four of base 32.
ORACLE = """
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS hex FROM pages),
g AS (SELECT hex, max(page_id) AS leader, count(*) AS copies FROM p GROUP BY hex)
SELECT page_id, payload_bytes::BIGINT AS payload_bytes,
    array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
        ((('0x' || substr(hex, (5 * (i // 4) + 1)::INTEGER, 5))::INTEGER >> (5 * (3 - i % 4))::INTEGER) & 31) + 1, 1)
        FOR i IN range(0, 32)], '')
        AS payload_digest,
    CASE WHEN page_id = leader THEN 'response' ELSE 'revisit' END AS record_type,
    CASE WHEN page_id <> leader THEN leader END AS refers_to
FROM p JOIN g USING (hex)
"""
