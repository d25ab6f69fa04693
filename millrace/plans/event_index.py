"""Events in hash buckets with filters, so that a batch opens only what may hold its hashes.

The store is a bucketed table dealt by event hash. Beside every part lies a blocked Bloom
filter, made by aggregation: a hash sets a few bits of one block of 32,768, and a block is a
row. A batch joins its hashes with those blocks alone and opens the parts that pass. A hash
that is not stored opens a part in about one of a thousand cases; one that is stored opens
its own. Compaction bounds the parts of a bucket and doubles the buckets as the table grows,
so what a batch reads depends on the batch and not on the history.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from millrace.operators.events import checked_events, fold_events, judge_events
from millrace.session import Scratch
from millrace.sources.versions import BUCKET, BucketStore, Conflict, Part, Version, bucket_of, compact

HASH = "event_hash"
SCHEMA = T.StructType(
    [
        T.StructField("event_type", T.StringType()),
        T.StructField("event_created_at", T.TimestampType()),
        T.StructField("event_data", T.StringType()),
        T.StructField(HASH, T.StringType()),
    ]
)

BLOCK_BITS = 32_768  # of the bitmap that Spark's aggregate builds (fixed value)
BITS_PER_HASH = 16
PROBES = 5


def _block(blocks: Column) -> Column:
    return F.pmod(F.xxhash64(F.col(HASH), F.lit(-1)), blocks)


def _places() -> Column:
    """The bits of a hash in its block."""
    return F.array(*[F.pmod(F.xxhash64(F.col(HASH), F.lit(i)), F.lit(BLOCK_BITS)) for i in range(PROBES)])


def _bit(bitmap: Column, place: Column) -> Column:
    """Whether a bit is set; one character in hexadecimal is looked at, not the whole bitmap."""
    byte = F.conv(F.hex(F.substring(bitmap, (place / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.getbit(byte, F.pmod(place, F.lit(8)).cast("int")) == 1


class EventIndex:
    """The indexed store in ``root``. Any number of writers may ingest into it."""

    def __init__(self, spark: SparkSession, root: str, buckets: int = 16) -> None:
        self.spark, self.store = spark, BucketStore(spark, root)
        self.store.create(SCHEMA, [HASH], buckets)

    def read(self, version: Version | None = None) -> DataFrame:
        return self.store.read(version)

    # ------------------------------------------------------------ filters

    def with_filters(self, parts: dict[int, Part]) -> dict[int, Part]:
        """Write the filters of parts of one run; returns the parts with the size of theirs.

        All filters of a run have as many blocks as its largest part needs. Positions are
        folded into bitmaps before the shuffle.
        """
        if not parts:
            return parts
        run = next(iter(parts.values())).folder.split("/")[1]
        blocks = max(1, -(-max(p.rows for p in parts.values()) * BITS_PER_HASH // BLOCK_BITS))
        rows = self.spark.read.schema(f"{HASH} string, {BUCKET} int").parquet(f"{self.store.root}/data/{run}")
        bits = rows.select(BUCKET, _block(F.lit(blocks)).alias("block"), F.explode(_places()).alias("place"))
        bits.groupBy(BUCKET, "block").agg(F.bitmap_construct_agg("place").alias("bits")).write.partitionBy(
            BUCKET
        ).parquet(f"{self.store.root}/filters/{run}")
        return {b: replace(p, blocks=blocks) for b, p in parts.items()}

    def passing(self, hashes: DataFrame, version: Version) -> DataFrame:
        """(event_hash, folder): the parts of which the filter has a hash, or that have no filter."""
        asked = hashes.select(HASH).where(F.col(HASH).isNotNull()).distinct()
        asked = asked.withColumn(BUCKET, bucket_of([HASH], version.buckets))
        hit = sorted(r[0] for r in asked.select(BUCKET).distinct().collect())
        # At most the parts of the buckets that are asked for: a list that compaction keeps short.
        near = [(b, p.folder, p.blocks) for b in hit for p in version.parts.get(b, ())]
        listed = self.spark.createDataFrame(near, f"{BUCKET} int, folder string, blocks int")
        pairs = asked.join(listed, BUCKET)
        unfiltered = pairs.where("blocks = 0").select(HASH, "folder")
        paths = [f"{self.store.root}/{f.replace('data/', 'filters/', 1)}" for _, f, blocks in near if blocks]
        if not paths:
            return unfiltered
        # The folder of a filter is told by its file's name, so the blocks need not carry it.
        name = F.regexp_extract(F.input_file_name(), rf"filters/([0-9a-f]+/{BUCKET}=\d+)/", 1)
        stored = self.spark.read.schema("block long, bits binary").parquet(*paths)
        stored = stored.select("block", "bits", F.concat(F.lit("data/"), name).alias("folder"))
        wanted = pairs.where("blocks > 0").select(HASH, "folder", _block(F.col("blocks")).alias("block"), _places().alias("at"))
        passed = wanted.join(stored, ["folder", "block"]).where(F.forall("at", lambda p: _bit(F.col("bits"), p)))
        return passed.select(HASH, "folder").unionByName(unfiltered)

    def parts_that_may_hold(self, hashes: DataFrame, version: Version) -> list[str]:
        """Folders to open for a batch; no more than the version has parts."""
        if not version.parts:
            return []
        return sorted(r[0] for r in self.passing(hashes, version).select("folder").distinct().collect())

    # ------------------------------------------------------------ ingest

    def ingest(
        self, events: DataFrame, *, completed: DataFrame | None = None, order_by: Column | None = None,
        run_time: Column | None = None, stream: str | None = None, batch: int = 0, retries: int = 5,
    ) -> IndexedIngest:
        """Store the events that are not stored yet and count the others, in one published step.

        A ``stream`` names a source of numbered batches: a batch whose number is not above
        the last one stored for it is a repetition and leaves the table alone.
        """
        done = completed if completed is not None else self._nothing()
        folded = None
        for _ in range(retries):
            base = self.store.latest()
            last = base.info.get("streams", {}).get(stream, -1) if stream else -1
            if stream and batch <= last:
                return IndexedIngest(None, [], base.number)
            # The events are read, hashed and folded once, whatever number of turns follows.
            folded = folded or fold_events(checked_events(events), order_by)
            with Scratch(self.spark) as scratch:
                fresh = folded.where("_valid").select(HASH)
                if completed is not None:
                    fresh = scratch.keep(fresh.join(done.select(HASH), HASH, "left_anti"))
                opened = self.parts_that_may_hold(fresh, base)
                stored = self.store.read(base, folders=opened)
                found = judge_events(folded, stored, done, run_time=run_time)
                created = found.created.select(*SCHEMA.names)
                added = self.with_filters(self.store.write(created, base))
                outcome = found.outcome.first()
                # The hashes that were looked for must still be missing when these are published.
                touched = sorted(
                    r[0] for r in fresh.select(bucket_of([HASH], base.buckets)).distinct().collect()
                )
            info = {"streams": {stream: batch}} if stream else {}
            if not added and not stream:
                return IndexedIngest(outcome.asDict(), opened, base.number)
            made = self.store.commit(base, touched, "ingest", added=added, info=info)
            if made:
                return IndexedIngest(outcome.asDict(), opened, made.number)
        raise Conflict(f"other writers changed the same buckets {retries} times")

    def _nothing(self) -> DataFrame:
        return self.spark.createDataFrame([], f"{HASH} string")

    def compact(self, *, most_parts: int = 4, rows_per_bucket: int = 5_000_000) -> Version:
        """Few parts a bucket, and buckets of bounded size; safe beside a running stream.

        Readers of an older version keep its folders until ``vacuum``. Putting the parts of
        a bucket together changes none of its rows, so an ingest that began before it stands.
        """
        made = compact(self.store, most_parts=most_parts, rows_per_bucket=rows_per_bucket)
        return self.add_filters(made)

    def add_filters(self, version: Version) -> Version:
        """Filters for parts that lack them; until then such parts are opened for every batch."""
        for run in sorted({p.folder.split("/")[1] for ps in version.parts.values() for p in ps if not p.blocks}):
            lacking = {b: p for b, ps in version.parts.items() for p in ps if p.folder.split("/")[1] == run}
            made = self.with_filters(lacking)
            while True:
                now = self.store.latest()
                parts = {
                    b: tuple(made[b] if b in made and p.folder == made[b].folder else p for p in ps)
                    for b, ps in now.parts.items()
                }
                version = replace(
                    now, number=now.number + 1, parts=parts, info={**now.info, "operation": "add filters"}
                )
                if self.store.publish(version):
                    break
        return version


@dataclass
class IndexedIngest:
    outcome: dict | None  # counts as of ``ingest_events``; None for a repeated batch
    opened: list[str]     # parts of the history that were read
    version: int


def ingest_indexed_stream(
    events: DataFrame,
    root: str,
    checkpoint: str,
    *,
    stream: str = "events",
    buckets: int = 16,
    completed: Callable[[SparkSession], DataFrame] | None = None,
    order_by: Column | None = None,
    most_parts: int = 4,
    rows_per_bucket: int = 5_000_000,
    compact_every: int = 16,
    continuous: str | None = None,
) -> StreamingQuery:
    """Ingest a stream into an indexed store, each event once, and compact it on the way.

    The number of a batch is published with its events, so a repeated batch finds itself
    done. By default it takes what is there and stops; ``continuous`` is a trigger interval.
    """

    def take(rows: DataFrame, batch_id: int) -> None:
        spark = rows.sparkSession
        index = EventIndex(spark, root, buckets)
        done = completed(spark) if completed else None
        index.ingest(rows, completed=done, order_by=order_by, stream=stream, batch=batch_id)
        if batch_id % compact_every == compact_every - 1:
            index.compact(most_parts=most_parts, rows_per_bucket=rows_per_bucket)

    writer = events.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint)
    return (writer.trigger(processingTime=continuous) if continuous else writer.trigger(availableNow=True)).start()
