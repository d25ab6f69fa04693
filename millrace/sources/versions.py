"""Tables in hash buckets whose versions are published by one atomic step.

A table is a folder. Rows lie below ``data`` in a folder for each run and bucket; which of
these folders make up the table is said by the newest file in ``_versions``. A version is
written after its rows, under a number that must not be taken, so a reader sees all of a
change or nothing of it, a stop at any moment leaves the version before, and of two writers
one is told that it came second. Folders that no kept version names are swept by ``vacuum``.

A version names as many folders as there are buckets, times the parts a bucket may have
before it is compacted; it grows with the number of buckets, not with rows. Compaction makes
no more buckets than ``MOST_BUCKETS``: a table that needs finer ones has its buckets cut into
slices, which lie in order in the files of a bucket and are told by a column of these.
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Collection, Mapping, Sequence
from dataclasses import dataclass, field, replace

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators.mapping import quoted

BUCKET = "_bucket"
SLICE = "_slice"
MARK = "_mark"
#: Columns that hold digests as hexadecimal text.
HEX = ("_sync_checksum", "event_hash")
#: Folders that compaction deals a table into; each costs a file or more for every run.
MOST_BUCKETS = 256


@dataclass(frozen=True)
class Part:
    """A folder of rows of one bucket. ``blocks``: size of its filter; 0 where it has none."""

    folder: str
    rows: int
    blocks: int = 0


@dataclass(frozen=True)
class Version:
    number: int
    schema: T.StructType
    on: tuple[str, ...]
    buckets: int
    parts: Mapping[int, tuple[Part, ...]] = field(default_factory=dict)
    #: The version that last changed the rows of a bucket; putting its parts together does not.
    changed: Mapping[int, int] = field(default_factory=dict)
    #: What the step was, and the last batch of each stream.
    info: Mapping[str, object] = field(default_factory=dict)
    #: Into how many slices the rows of a bucket are dealt, in files written since.
    slices: int = 1

    def rows(self) -> int:
        return sum(p.rows for parts in self.parts.values() for p in parts)

    def to_text(self) -> str:
        return json.dumps(
            {
                "number": self.number, "schema": self.schema.jsonValue(), "on": list(self.on),
                "buckets": self.buckets, "slices": self.slices, "info": dict(self.info),
                "parts": {b: [[p.folder, p.rows, p.blocks] for p in ps] for b, ps in sorted(self.parts.items())},
                "changed": dict(sorted(self.changed.items())),
            }
        )

    @staticmethod
    def of_text(text: str) -> Version:
        v = json.loads(text)
        return Version(
            v["number"], T.StructType.fromJson(v["schema"]), tuple(v["on"]), v["buckets"],
            {int(b): tuple(Part(*p) for p in ps) for b, ps in v["parts"].items()},
            {int(b): n for b, n in v["changed"].items()}, v["info"], v.get("slices", 1),
        )


def bucket_of(on: Sequence[str], buckets: int) -> Column:
    """The bucket of a row; equal values of equal types meet in one bucket."""
    return F.pmod(F.xxhash64(*[F.col(quoted(c)) for c in on]), F.lit(buckets)).cast("int")


_HEX = "^([0-9a-f][0-9a-f])*$"


def packed(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Hexadecimal texts as bytes, half as many to shuffle; other texts stay as they are."""
    for c in columns:
        hexed = F.col(quoted(c)).rlike(_HEX)
        rows = rows.withColumn(f"_hex_{c}", F.when(hexed, F.unhex(quoted(c)))).withColumn(
            c, F.when(~hexed, F.col(quoted(c)))
        )
    return rows


def unpacked(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    for c in columns:
        rows = rows.withColumn(c, F.coalesce(F.col(quoted(c)), F.lower(F.hex(f"_hex_{c}")))).drop(f"_hex_{c}")
    return rows


def slice_of(on: Sequence[str], buckets: int, slices: int) -> Column:
    """The slice of a row in its bucket: both together are its bucket among ``buckets * slices``."""
    finer = F.pmod(F.xxhash64(*[F.col(quoted(c)) for c in on]), F.lit(buckets * slices))
    return F.floor(finer / F.lit(buckets)).cast("int")


class Conflict(Exception):
    """Other writers changed the same buckets again and again."""


class BucketStore:
    """Reads and publishes versions of the table in ``root``, and writes folders for new ones."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")

    # ------------------------------------------------------------ files

    def _fs(self, path: str):
        at = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return at.getFileSystem(self.spark._jsc.hadoopConfiguration()), at

    def _names(self, folder: str) -> list[str]:
        fs, path = self._fs(f"{self.root}/{folder}")
        return [s.getPath().getName() for s in fs.listStatus(path)] if fs.exists(path) else []

    def _read_text(self, name: str) -> str:
        fs, path = self._fs(f"{self.root}/{name}")
        stream = fs.open(path)
        try:
            return self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def put_new(self, name: str, text: str) -> bool:
        """Write a file in one step, unless there is one of that name."""
        draft = f"{name}.{uuid.uuid4().hex}.draft"
        fs, source = self._fs(f"{self.root}/{draft}")
        out = fs.create(source)
        out.write(bytearray(text.encode()))
        out.close()
        try:
            return self._take_name(fs, source, f"{self.root}/{name}")
        finally:
            fs.delete(source, False)

    def _take_name(self, fs, source, target: str) -> bool:
        jvm = self.spark._jvm
        goal = fs.makeQualified(jvm.org.apache.hadoop.fs.Path(target))
        if goal.toUri().getScheme() == "file":
            # A local rename would replace the other file; a second link to it is refused.
            try:
                os.link(fs.makeQualified(source).toUri().getPath(), goal.toUri().getPath())
            except FileExistsError:
                return False
            return True
        return self._rename_new(fs.makeQualified(source), goal)

    def _rename_new(self, source, goal) -> bool:
        """Rename without replacing, which shared file systems do in one step."""
        jvm = self.spark._jvm
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
            goal.toUri(), self.spark._jsc.hadoopConfiguration()
        )
        rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
        try:
            context.rename(source, goal, self.spark.sparkContext._gateway.new_array(rename, 0))
        except Py4JJavaError as error:
            if "FileAlreadyExistsException" not in str(error.java_exception.getClass().getName()):
                raise
            return False
        return True

    # ------------------------------------------------------------ versions

    def numbers(self) -> list[int]:
        return sorted(int(n[:-5]) for n in self._names("_versions") if n.endswith(".json"))

    def latest(self) -> Version | None:
        numbers = self.numbers()
        return self.at(numbers[-1]) if numbers else None

    def at(self, number: int) -> Version:
        return Version.of_text(self._read_text(f"_versions/{number:012d}.json"))

    def publish(self, version: Version) -> bool:
        """Make this the newest version; false if its number was taken in the meantime."""
        return self.put_new(f"_versions/{version.number:012d}.json", version.to_text())

    def create(self, schema: T.StructType, on: Sequence[str], buckets: int) -> Version:
        """The first version, without rows, or the table's newest one where it exists."""
        if buckets < 1 or set(on) - set(schema.names) or not on:
            raise ValueError("a table needs buckets, and columns of its own to deal rows by")
        made = Version(1, schema, tuple(on), buckets, info={"operation": "create"})
        return self.latest() or (made if self.publish(made) else self.latest())

    # ------------------------------------------------------------ rows

    def read(
        self, version: Version | None = None, *, buckets: Collection[int] | None = None,
        folders: Collection[str] | None = None, slices: Collection[int] | None = None,
    ) -> DataFrame:
        """The rows of a version, or of some of its buckets or folders: no other file is opened.

        Of ``slices`` alone only the row groups are read that may hold some of them.
        """
        version = version or self.latest()
        wanted = set(folders) if folders is not None else None
        paths = [
            f"{self.root}/{p.folder}"
            for b in (version.parts if buckets is None else sorted(set(buckets) & set(version.parts)))
            for p in version.parts[b]
            if wanted is None or p.folder in wanted
        ]
        if not paths:
            return self.spark.createDataFrame([], version.schema)
        if slices is None:
            return self.spark.read.schema(version.schema).parquet(*paths)
        marked = T.StructType([*version.schema, T.StructField(SLICE, T.IntegerType())])
        # A table of one slice has no such column.
        found = self.spark.read.schema(marked).parquet(*paths).withColumn(SLICE, F.coalesce(SLICE, F.lit(0)))
        return found.where(F.col(SLICE).isin(*slices)).drop(SLICE)

    def write(
        self, rows: DataFrame, version: Version, mark: Column | None = None, counted: dict | None = None
    ) -> dict[int, Part]:
        """Write rows below a folder of their own; the parts are no one's before they are published.

        With a mark of few values beside the rows, ``counted`` takes their numbers by bucket and mark.
        """
        mark = F.lit(None).cast("string") if mark is None else mark
        counted = {} if counted is None else counted
        run = f"data/{uuid.uuid4().hex}"
        names, hexed = version.schema.names, [c for c in HEX if c in version.schema.names]
        dealt = rows.select(
            *[quoted(c) for c in names], bucket_of(version.on, version.buckets).alias(BUCKET), mark.alias(MARK)
        )
        # Adaptive execution splits large buckets and puts small ones together.
        dealt = unpacked(packed(dealt, hexed).hint("rebalance", BUCKET), hexed)
        if version.slices > 1:
            dealt = dealt.withColumn(SLICE, slice_of(version.on, version.buckets, version.slices))
            dealt = dealt.sortWithinPartitions(BUCKET, SLICE)
        dealt.write.partitionBy(BUCKET).option("compression", "zstd").parquet(f"{self.root}/{run}")
        if not [n for n in self._names(run) if n.startswith(BUCKET)]:
            return {}
        # The bucket is in the folder's name, so the count reads the mark alone.
        stored = self.spark.read.schema(f"{MARK} string, {BUCKET} int").parquet(f"{self.root}/{run}")
        counted |= {(r[BUCKET], r[MARK]): r["count"] for r in stored.groupBy(BUCKET, MARK).count().collect()}
        rows_in: dict[int, int] = {}
        for (b, _), n in counted.items():
            rows_in[b] = rows_in.get(b, 0) + n
        return {b: Part(f"{run}/{BUCKET}={b}", n) for b, n in rows_in.items()}

    def history(self) -> DataFrame:
        """version, operation, n_rows, n_parts, n_changed: a row for each version kept."""
        rows = []
        for v in map(self.at, self.numbers()):
            changed = sum(n == v.number for n in v.changed.values())
            rows.append((v.number, v.info.get("operation"), v.rows(), sum(map(len, v.parts.values())), changed))
        return self.spark.createDataFrame(
            rows, "version long, operation string, n_rows long, n_parts long, n_changed long"
        )

    def vacuum(self, keep: int = 10) -> int:
        """Delete all but the newest versions and the folders that none of these names.

        A reader of an older version fails, and so does a writer that began before it and
        has not published; keep as many versions as either may take. Returns the number of
        runs that were deleted.
        """
        numbers = self.numbers()
        started = set(self._names("data"))
        kept = [self.at(n) for n in numbers[-max(keep, 1):]]
        used = {p.folder.split("/")[1] for v in kept for ps in v.parts.values() for p in ps}
        for number in numbers[: -max(keep, 1)]:
            fs, path = self._fs(f"{self.root}/_versions/{number:012d}.json")
            fs.delete(path, False)
        for run in started - used:
            for top in ("data", "filters"):
                fs, path = self._fs(f"{self.root}/{top}/{run}")
                fs.delete(path, True)
        return len(started - used)

    # ------------------------------------------------------------ changes

    def commit(
        self, base: Version, touched: Collection[int], operation: str, *,
        added: Mapping[int, Part] | None = None, dropped: Mapping[int, Collection[str]] | None = None,
        rows_change: bool = True, info: Mapping[str, object] | None = None,
    ) -> Version | None:
        """Publish parts written on top of ``base``; None if the work has to be done again.

        Versions of others in between are no matter as long as they left the rows of the
        ``touched`` buckets alone and the dropped parts in place: the same step then follows
        the newest version.
        """
        added, dropped = added or {}, dropped or {}
        while True:
            now = self.latest()
            if (now.buckets, now.slices) != (base.buckets, base.slices) or now.schema != base.schema:
                return None
            if any(now.changed.get(b, 0) > base.number for b in touched):
                return None
            parts = dict(now.parts)
            for b in set(added) | set(dropped):
                gone, have = set(dropped.get(b, ())), parts.get(b, ())
                if gone - {p.folder for p in have}:
                    return None
                parts[b] = tuple(p for p in have if p.folder not in gone) + ((added[b],) if b in added else ())
            number = now.number + 1
            fresh = {b: number for b in set(added) | set(dropped)} if rows_change else {}
            streams = {**now.info.get("streams", {}), **(info or {}).get("streams", {})}
            made = replace(
                now, number=number, parts={b: ps for b, ps in parts.items() if ps}, changed={**now.changed, **fresh},
                info={**(info or {}), "operation": operation, "streams": streams},
            )
            if self.publish(made):
                return made


def compact(store: BucketStore, *, most_parts: int = 4, rows_per_bucket: int | None = None, retries: int = 5) -> Version:
    """Put together the parts of every bucket that has more than ``most_parts``.

    With ``rows_per_bucket`` the number of buckets is doubled, and all rows dealt anew,
    until a bucket holds no more in the mean, so what a lookup opens stays as large as it
    was however long the table has grown. From ``MOST_BUCKETS`` on the buckets are cut into
    slices instead, until a slice holds no more in the mean. Writers may go on meanwhile:
    what they add stays, and only a doubling makes them start again.
    """
    for _ in range(retries):
        base = store.latest()
        buckets, slices = base.buckets, base.slices
        while rows_per_bucket and base.rows() > rows_per_bucket * buckets * slices:
            if 2 * buckets <= MOST_BUCKETS:
                buckets *= 2
            else:
                slices *= 2
        if (buckets, slices) != (base.buckets, base.slices):
            wider = replace(base, buckets=buckets, slices=slices)
            parts = store.write(store.read(base), wider)
            number = base.number + 1
            made = replace(
                wider, number=number, parts={b: (p,) for b, p in parts.items()},
                changed=dict.fromkeys(parts, number), info={**base.info, "operation": "deal anew"},
            )
            # Every row is dealt anew, so any version in between means another turn.
            if store.publish(made):
                return made
            continue
        many = [b for b, ps in base.parts.items() if len(ps) > most_parts]
        if not many:
            return base
        added = store.write(store.read(base, buckets=many), base)
        dropped = {b: [p.folder for p in base.parts[b]] for b in many}
        made = store.commit(base, (), "compact", added=added, dropped=dropped, rows_change=False)
        if made:
            return made
    raise Conflict("the table could not be compacted beside its writers")
