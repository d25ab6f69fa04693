"""Keyed sync into a bucketed table: only the buckets a delta changes are read in full and rewritten."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.hashing import SYNC_CHECKSUM, SYNC_UPDATED_AT
from millrace.operators import merge, schema
from millrace.operators.mapping import quoted
from millrace.plans.sync import SyncResult, checked_rows, complete_rows, count_rejects, prepare_source
from millrace.session import Scratch, has_rows
from millrace.sources.versions import BUCKET, BucketStore, Conflict, Version, bucket_of
from millrace.sources.writers import SYNC_TYPES


@dataclass
class Merged:
    result: SyncResult
    version: int         # the version that holds the merge
    looked_at: list[int]  # buckets of which keys and checksums were read
    rewritten: list[int]  # buckets that were written anew
    attempts: int


def _stored_schema(data: T.StructType) -> T.StructType:
    fields = [f for f in data if f.name not in SYNC_TYPES]
    return T.StructType(fields + [T.StructField(n, SYNC_TYPES[n], True) for n in (SYNC_CHECKSUM, SYNC_UPDATED_AT)])


def _buckets_in(rows: DataFrame) -> list[int]:
    """At most as many numbers as the table has buckets."""
    return sorted(r[0] for r in rows.select(BUCKET).distinct().collect())


_LARGE = 4  # a source of this share of the rows in its buckets is merged in one join


def _merge_small(store, base, single, keys, stamp, looked_at, scratch) -> tuple[int, int, list[int], dict]:
    """The changes first, then the buckets that have some: keys and checksums of the others are read."""
    changes = scratch.keep(merge.merge_changes(store.read(base, buckets=looked_at), single, keys, stamp))
    actions = dict(merge.action_counts(changes).collect())
    rewritten = _buckets_in(changes.withColumn(BUCKET, bucket_of(base.on, base.buckets)))
    added = {}
    if rewritten:
        merged = merge.merge_delta(store.read(base, buckets=rewritten), changes, keys)
        added = store.write(merged.select(*[quoted(c) for c in base.schema.names]), base)
    return actions.get(merge.INSERTED, 0), actions.get(merge.UPDATED, 0), rewritten, added


def _merge_whole(store, base, single, keys, stamp, looked_at, scratch) -> tuple[int, int, list[int], dict]:
    """One join of the buckets with the source, written at once; buckets found unchanged are not published."""
    if not any(base.parts.get(b) for b in looked_at):
        merged = merge.all_new(base.schema, single, stamp)
    else:
        merged = merge.merge_keyed(store.read(base, buckets=looked_at), single, keys, stamp)
    counted: dict = {}
    added = store.write(merged, base, F.col(merge.ACTION), counted)
    of = {action: sum(n for (_, a), n in counted.items() if a == action) for action in (merge.INSERTED, merge.UPDATED)}
    rewritten = sorted({b for b, a in counted if a in of})
    return of[merge.INSERTED], of[merge.UPDATED], rewritten, {b: p for b, p in added.items() if b in rewritten}


def merge_buckets(
    source: DataFrame,
    root: str,
    keys: Sequence[str],
    *,
    buckets: int = 64,
    bucket_on: Sequence[str] | None = None,
    mapping: Mapping[str, str] | None = None,
    contract: T.StructType | None = None,
    order_by: Sequence[Column] = (),
    on_bad: str = "fail",
    run_time: dt.datetime | None = None,
    retries: int = 5,
) -> Merged:
    """Bring the bucketed table in ``root`` up to date with a source, as ``sync`` does a table.

    The source names the buckets it has keys in; of these the keys and checksums are read,
    and the buckets with a new or changed row are written anew and published together. A
    delta without changes publishes nothing. ``bucket_on`` may name some of the keys (a day,
    a customer), so that deltas that hang together meet in few buckets. Number and columns
    of the buckets are settled when the table is made.

    Beside other writers the merge is published if they left its buckets alone, and done
    again on their version if not, up to ``retries`` times.
    """
    if not keys or set(bucket_on or keys) - set(keys):
        raise ValueError("a bucketed table needs merge keys, and buckets by some of these")
    spark = source.sparkSession
    store = BucketStore(spark, root)
    prepared = prepare_source(source, mapping=mapping, keys=keys)
    base = store.latest()
    created = base is None
    if created:
        shape = _stored_schema(contract or schema.widen(prepared.schema))
        base = store.create(shape, list(bucket_on or keys), buckets)
    stamp = F.lit(run_time or dt.datetime.now(dt.timezone.utc)).cast("timestamp")
    with Scratch(spark) as scratch:
        staged = scratch.keep(checked_rows(prepared, contract or base.schema, keys))
        skipped, errors = count_rejects(staged, on_bad)
        rows_read = staged.count()
        good = merge.with_checksum(schema.accepted(staged))
        # Only the keys are shuffled to see whether any comes twice; most sources have none.
        single, distinct = good, rows_read - skipped
        if has_rows(merge.duplicate_keys(good, keys)):
            single = scratch.keep(merge.dedupe_source(good, keys, order_by))
            distinct = single.count()
        single = complete_rows(single, spark.createDataFrame([], base.schema))
        for attempt in range(1, retries + 1):
            base = store.latest()
            looked_at = _buckets_in(single.withColumn(BUCKET, bucket_of(base.on, base.buckets)))
            held = sum(p.rows for b in looked_at for p in base.parts.get(b, ()))
            step = _merge_whole if distinct * _LARGE >= held else _merge_small
            inserted, updated, rewritten, added = step(store, base, single, keys, stamp, looked_at, scratch)
            made: Version | None = base
            if rewritten:
                dropped = {b: [p.folder for p in base.parts.get(b, ())] for b in rewritten}
                # Looked-at buckets count as well: a row found unchanged or missing must still be so.
                made = store.commit(
                    base, looked_at, "merge", added=added, dropped=dropped,
                    info={"inserted": inserted, "updated": updated},
                )
            if made is not None:
                break
        else:
            raise Conflict(f"{root}: other writers changed the same buckets {retries} times")
    result = SyncResult(
        status="success" if not skipped else ("partial" if skipped < rows_read else "error"),
        rows_read=rows_read, inserted=inserted, updated=updated, unchanged=distinct - inserted - updated,
        skipped=skipped, duplicates=rows_read - skipped - distinct, table_created=created, errors=errors,
    )
    return Merged(result, made.number, looked_at, rewritten, attempt)


def replace_rows(rows: DataFrame, root: str, *, retries: int = 5) -> Version:
    """Replace all rows of a bucketed table in one step; the old ones stay readable until it."""
    store = BucketStore(rows.sparkSession, root)
    for _ in range(retries):
        base = store.latest()
        if base is None:
            raise ValueError(f"no table in {root}")
        added = store.write(rows, base)
        dropped = {b: [p.folder for p in ps] for b, ps in base.parts.items()}
        made = store.commit(base, range(base.buckets), "replace", added=added, dropped=dropped)
        if made:
            return made
    raise Conflict(f"{root}: other writers changed the table {retries} times")
