"""Near-duplicate vectors by an epsilon grid order join.

Cosine at or above a threshold is a distance of at most epsilon between unit vectors. A
rotation to principal dimensions, fitted on a bounded sample, keeps all distances and puts
the spread in front. Vectors are sorted by their grid cells of width epsilon on the leading
dimensions; the sequence is cut into runs of blocks with bounding boxes, and pairs of sequence
intervals are split again and again, leaving out those whose boxes are further than epsilon
apart. Only pairs that are left are compared: by an upper bound from the leading dimensions,
and what passes it exactly, in double precision.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import FloatType

from millrace.llm.common import arrow_rows, settings, ship
from millrace.llm.graph import components
from millrace.session import Scratch, stored_rows


@dataclass(frozen=True)
class Grid:
    """``sample``: vectors the rotation is fitted on. ``block``: vectors compared at once;
    ``fan``: intervals an interval is split into, and blocks in a run; ``leaf``: the blocks inside a task."""

    cosine: float = 0.9
    sample: int = 5_000
    dims: int = 8
    block: int = 1024
    fan: int = 8
    leaf: int = 128


_SLACK = 1e-9  # of cosines, far above rounding, when blocks are skipped
_VAGUE = 1e-4  # share of a sample's pairs that leading dimensions may leave in doubt
_RUN = 4 << 20  # bytes of vectors in a run of blocks, at most where a block is smaller
_LINKED = 1 << 16  # pairs a task looks at before it counts them
_PARTNERS = 2  # pairs for each run up to which runs are shuffled
# The writer looks at the size after each row, as a row is large; of a part that is read for
# each run of another, more rows than these are held in memory that can spill.
_SPLIT = {"parquet.page.size.row.check.min": "1"}
_HELD = {"spark.sql.cartesianProductExec.buffer.in.memory.threshold": "4"}


def valid(vector: str = "embedding"):
    """Not null, not zero, all components present and finite."""
    return (
        F.col(vector).isNotNull()
        & ~F.exists(vector, lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")))
        & F.exists(vector, lambda x: x != 0)
    )


def unit_rows(vectors) -> np.ndarray:
    """The vectors at length 1, in double precision; scaled first, so that squares stay finite."""
    if isinstance(vectors, np.ndarray) and vectors.ndim == 2:
        x = vectors.astype(np.float64)
    else:
        x = np.array([np.asarray(v, dtype=np.float64) for v in vectors])
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def rotation(vectors: DataFrame, grid: Grid) -> np.ndarray:
    """Leading principal axes (columns) of a sample chosen by the hash of the id; none for no vectors.

    At least ``grid.dims``, and as many as tell nearly all pairs of the sample apart.
    """
    rows = vectors.orderBy(F.xxhash64("id"), "id").limit(grid.sample).select("vector").toPandas()
    if not len(rows):
        return np.zeros((0, 0))
    x = unit_rows(rows["vector"])
    _, axes = np.linalg.eigh(np.cov(x - x.mean(axis=0), rowvar=False).reshape(x.shape[1], x.shape[1]))
    axes, some = axes[:, ::-1], x[:1000]
    near, n = np.count_nonzero(some @ some.T >= grid.cosine), grid.dims
    while n < len(axes):
        head = heads(some, axes[:, :n])
        if np.count_nonzero(head @ head.T >= grid.cosine) <= 2 * near + _VAGUE * len(some) ** 2:
            break
        n = min(n + 8, len(axes))
    return np.ascontiguousarray(axes[:, :n])


def heads(units: np.ndarray, axes: np.ndarray) -> np.ndarray:
    """Leading dimensions and the length of the rest; products of these are at least the cosines."""
    lead = units @ axes
    rest = np.sqrt(np.maximum(1 - (lead * lead).sum(axis=1), 0))
    return np.column_stack([lead, rest]).astype(np.float32)


def _placed(vectors: DataFrame, axes: np.ndarray, kind: np.dtype, grid: Grid) -> DataFrame:
    """(id, cells, lead, vector): the vectors as bytes, and their cells on the leading dimensions."""
    width = np.sqrt(2 - 2 * grid.cosine)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                turned = unit_rows(batch["vector"]) @ axes[:, : grid.dims]
                cells = np.floor(turned / width).astype(np.int32)
                yield pd.DataFrame(
                    {
                        "id": batch["id"].to_numpy(),
                        "cells": list(cells),
                        "lead": list(turned.astype(np.float32)),
                        "vector": [np.asarray(v, dtype=kind).tobytes() for v in batch["vector"]],
                    }
                )

    return vectors.mapInPandas(run, "id long, cells array<int>, lead array<float>, vector binary")


def _blocks(placed: DataFrame, axes: np.ndarray, kind: np.dtype, grid: Grid) -> DataFrame:
    """(block, low, high, ids, vectors): the sequence by cells, cut into runs of blocks with their boxes.

    Range partitioning gives the intervals of the top; each is sorted in its task and cut into
    runs of ``fan`` blocks, fewer where vectors are long. Runs are numbered interval after
    interval, so the number is the place in the order.
    """
    # The vector itself breaks ties, so a cell with very many vectors is many intervals.
    ordered = placed.repartitionByRange("cells", "lead", "id").sortWithinPartitions("cells", "lead", "id")
    size = max(grid.block, min(grid.block * grid.fan, _RUN // (kind.itemsize * max(len(axes), 1))))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        base, n, kept, held = TaskContext.get().partitionId() << 32, 0, [], 0

        def cut(part: pd.DataFrame) -> pd.DataFrame:
            vectors = b"".join(part["vector"])
            lead = unit_rows(np.frombuffer(vectors, kind).reshape(len(part), -1)) @ axes[:, : grid.dims]
            return pd.DataFrame(
                {
                    "block": [base + n],
                    "low": [lead.min(axis=0)],
                    "high": [lead.max(axis=0)],
                    "ids": [part["id"].to_numpy().tobytes()],
                    "vectors": [vectors],
                }
            )

        for batch in batches:
            kept.append(batch[["id", "vector"]])
            held += len(batch)
            if held >= size:
                whole = pd.concat(kept, ignore_index=True)
                while len(whole) >= size:
                    yield cut(whole.iloc[:size])
                    n += 1
                    whole = whole.iloc[size:]
                kept, held = [whole], len(whole)
        if held:
            yield cut(pd.concat(kept, ignore_index=True))

    return ordered.mapInPandas(run, "block long, low array<double>, high array<double>, ids binary, vectors binary")


def _apart(a: str, b: str):
    """Squared distance between two boxes."""
    gaps = F.zip_with(
        F.zip_with(f"{a}_low", f"{b}_high", lambda x, y: F.greatest(x - y, F.lit(0.0))),
        F.zip_with(f"{b}_low", f"{a}_high", lambda x, y: F.greatest(x - y, F.lit(0.0))),
        lambda x, y: F.greatest(x, y),
    )
    return F.aggregate(gaps, F.lit(0.0), lambda s, g: s + g * g)


def block_pairs(boxes: DataFrame, grid: Grid) -> DataFrame:
    """(a, b), a <= b: the block pairs within epsilon, found by splitting interval pairs.

    ``boxes`` has block, low and high. On each level an interval is ``fan`` intervals of the
    level below; pairs are joined to the parts of both sides by equality and thinned out.
    """
    turn = F.row_number().over(W.orderBy("block")) - 1
    # One row for each block: the sequence numbers of blocks, not vectors, meet in a task.
    level = stored_rows(boxes.select("block", "low", "high", turn.cast("long").alias("at")))
    top = level.count()
    levels = [level]
    while top > 1:
        below = levels[-1]
        dims = range(grid.dims)
        up = below.groupBy(F.floor(F.col("at") / grid.fan).alias("at")).agg(
            F.array(*[F.min(F.get("low", F.lit(d))) for d in dims]).alias("low"),
            F.array(*[F.max(F.get("high", F.lit(d))) for d in dims]).alias("high"),
        )
        up = stored_rows(
            up.select(
                "at", F.filter("low", lambda x: x.isNotNull()).alias("low"), F.filter("high", lambda x: x.isNotNull()).alias("high")
            )
        )
        levels.append(up)
        top = (top + grid.fan - 1) // grid.fan
    reach = (2 - 2 * grid.cosine) + _SLACK
    pairs = levels[-1].select(F.col("at").alias("a"), F.col("at").alias("b"))
    for below in reversed(levels[:-1]):
        def side(s: str, below=below):
            return below.select(
                F.floor(F.col("at") / grid.fan).alias(f"{s}_up"),
                F.col("at").alias(f"{s}_at"),
                F.col("low").alias(f"{s}_low"),
                F.col("high").alias(f"{s}_high"),
            )

        split = pairs.join(side("a"), F.col("a") == F.col("a_up")).join(side("b"), F.col("b") == F.col("b_up"))
        pairs = stored_rows(
            split.where((F.col("a_at") <= F.col("b_at")) & (_apart("a", "b") <= reach)).select(
                F.col("a_at").alias("a"), F.col("b_at").alias("b")
            )
        )
    names = levels[0].select("at", "block")
    return (
        pairs.join(names.select(F.col("at").alias("a"), F.col("block").alias("block_a")), "a")
        .join(names.select(F.col("at").alias("b"), F.col("block").alias("block_b")), "b")
        .select("block_a", "block_b")
    )


class _Run:
    """The vectors of a run, and the boxes of its leaves."""

    def __init__(self, ids: bytes, vectors: bytes, kind: np.dtype, axes: np.ndarray, grid: Grid) -> None:
        self.ids = np.frombuffer(ids, dtype=np.int64)
        self.units = unit_rows(np.frombuffer(vectors, kind).reshape(len(self.ids), -1))
        self.heads = heads(self.units, axes)
        lead, at = self.units @ axes[:, : grid.dims], np.arange(0, len(self.ids), grid.leaf)
        self.low, self.high = np.minimum.reduceat(lead, at), np.maximum.reduceat(lead, at)


def _candidates(a: _Run, b: _Run, same: bool, grid: Grid) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places in both runs of pairs that may be near, with all that are; at most a leaf by a block at once."""
    reach = (2 - 2 * grid.cosine) + _SLACK
    # Single precision errs by less than its unit for each product and sum.
    least = np.float32(grid.cosine - (a.heads.shape[1] + 8) * 2.0**-23)
    width = max(grid.block // grid.leaf, 1)
    # One piece of memory for all products; fresh pages cost as much as the products.
    room = np.empty(grid.leaf * width * grid.leaf, dtype=np.float32)
    for i in range(len(a.low)):
        gap = np.maximum(np.maximum(a.low[i] - b.high, b.low - a.high[i]), 0)
        close = (gap * gap).sum(axis=1) <= reach
        close[: i if same else 0] = False
        rows = slice(i * grid.leaf, (i + 1) * grid.leaf)
        for j in range(0, len(close), width):
            leaves = np.flatnonzero(close[j : j + width]) + j
            if not len(leaves):
                continue
            cols = (leaves[:, None] * grid.leaf + np.arange(grid.leaf)).ravel()
            cols = cols[: np.searchsorted(cols, len(b.ids))]
            whole = cols[-1] - cols[0] + 1 == len(cols)
            right = b.heads[cols[0] : cols[-1] + 1] if whole else b.heads[cols]
            left = a.heads[rows]
            bound = np.matmul(left, right.T, out=room[: len(left) * len(right)].reshape(len(left), len(right)))
            hits = np.flatnonzero(bound >= least)
            if not len(hits):
                continue
            x, y = np.divmod(hits, len(cols))
            x, y = x + rows.start, cols[y]
            if same:
                x, y = x[x < y], y[x < y]
            if len(x):
                yield x, y


def _near(a: _Run, b: _Run, x: np.ndarray, y: np.ndarray, grid: Grid) -> np.ndarray:
    """Which of the pairs are near, in double precision."""
    (rows, at_x), (cols, at_y) = np.unique(x, return_inverse=True), np.unique(y, return_inverse=True)
    if 8 * len(x) > len(rows) * len(cols):
        return (a.units[rows] @ b.units[cols].T)[at_x, at_y] >= grid.cosine
    step = max(_RUN // (16 * a.units.shape[1]), 1)
    return np.concatenate(
        [
            np.einsum("ij,ij->i", a.units[x[k : k + step]], b.units[y[k : k + step]]) >= grid.cosine
            for k in range(0, len(x), step)
        ]
    )


def _compare(a: _Run, b: _Run, same: bool, grid: Grid):
    """Links of each vector within a pair of runs, and edges that tie the linked ones together."""
    count_a, count_b = np.zeros(len(a.ids), dtype=np.int64), np.zeros(len(b.ids), dtype=np.int64)
    edges, kept, held = [], [], 0

    def link() -> None:
        x, y = (np.concatenate(side) for side in zip(*kept, strict=True))
        near = _near(a, b, x, y, grid)
        x, y = x[near], y[near]
        if not len(x):
            return
        count_a[:] += np.bincount(x, minlength=len(count_a))
        count_b[:] += np.bincount(y, minlength=len(count_b))
        # A spanning forest of the links: sweep by sweep, each vector takes the least label it touches.
        label_a, label_b = a.ids.copy(), b.ids.copy()
        while True:
            new_a, new_b = label_a.copy(), label_b.copy()
            np.minimum.at(new_a, x, new_b[y])
            np.minimum.at(new_b, y, new_a[x])
            if (new_a == label_a).all() and (new_b == label_b).all():
                break
            label_a, label_b = new_a, new_b
        for ids, label in ((a.ids, label_a), (b.ids, label_b)):
            moved = ids != label
            edges.append(np.column_stack([ids[moved], label[moved]]))

    for found in _candidates(a, b, same, grid):
        kept.append(found)
        held += len(found[0])
        if held >= _LINKED:
            link()
            kept, held = [], 0
    if kept:
        link()
    tied = np.concatenate(edges) if edges else np.zeros((0, 2), dtype=np.int64)
    return count_a, count_b, np.unique(tied, axis=0)


def _paired(pairs: DataFrame, blocks: DataFrame, grid: Grid) -> DataFrame:
    """Both runs of every pair, as ids and vectors of a and b.

    Where runs have few partners, they are shuffled to them. Elsewhere that would copy a run
    for each partner, with the square of the table: tasks then read two parts of the stored
    runs each, and meet the same pairs by their boxes.
    """

    def side(s: str, *more: str) -> DataFrame:
        kept = [F.col(c).alias(f"{c}_{s}") for c in ("block", "ids", "vectors")]
        return blocks.select(*kept, *[F.col(c).alias(f"{s}_{c}") for c in more])

    if pairs.count() <= _PARTNERS * blocks.count():
        return pairs.join(side("a"), "block_a").join(side("b"), "block_b")
    a, b = F.col("block_a"), F.col("block_b")
    # Half of the pairs of two parts are met by the one task, half by the other.
    even = (F.shiftright(a, 32) + a + F.shiftright(b, 32) + b) % 2 == 0
    once = (a == b) | ((a != b) & ((a < b) == even))
    close = _apart("a", "b") <= (2 - 2 * grid.cosine) + _SLACK
    met = side("a", "low", "high").join(side("b", "low", "high"), once & close)
    return met.drop("a_low", "a_high", "b_low", "b_high")


def _linked(pairs: DataFrame, blocks: DataFrame, axes: np.ndarray, kind: np.dtype, grid: Grid) -> DataFrame:
    """(id, other, n): n links of a vector found in a task (other null), or an edge (n 0)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, a = None, None
        for batch in batches:
            for row in batch.itertuples(index=False):
                if row.block_a != held:  # it mostly meets many in succession
                    held, a = row.block_a, _Run(row.ids_a, row.vectors_a, kind, axes, grid)
                same = row.block_a == row.block_b
                b = a if same else _Run(row.ids_b, row.vectors_b, kind, axes, grid)
                count_a, count_b, tied = _compare(a, b, same, grid)
                out = [
                    pd.DataFrame({"id": i[c > 0], "other": pd.array([None] * int((c > 0).sum()), "Int64"), "n": c[c > 0]})
                    for i, c in ((a.ids, count_a), (b.ids, count_b))
                ]
                out.append(pd.DataFrame({"id": tied[:, 0], "other": pd.array(tied[:, 1], "Int64"), "n": np.zeros(len(tied), np.int64)}))
                yield pd.concat(out, ignore_index=True)

    return _paired(pairs, blocks, grid).mapInPandas(run, "id long, other long, n long")


def near_vectors(vectors: DataFrame, grid: Grid = Grid(), key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """vec_id, n_links, component_id and kept, a row for each row of ``vectors``.

    Vectors that are null, empty, zero or hold null or non-finite components link with
    nothing, nor do vectors of different lengths. Equal vectors link. Rows that share an id
    are one vertex, whose links are counted over its rows; a row without an id links with
    nothing. An empty table gives no rows.
    """
    ship(vectors.sparkSession)
    rows = vectors.select(F.col(key).cast("long").alias("id"), F.col(vector).alias("vector"))
    sound = rows.where(F.col("id").isNotNull() & valid("vector")).withColumn("length", F.size("vector"))
    spark, found = vectors.sparkSession, None
    # Single precision is kept as it is in stored rows, and takes half the room.
    single = isinstance(rows.schema["vector"].dataType.elementType, FloatType)
    kind, like = (np.dtype("float32"), "array<float>") if single else (np.dtype("float64"), "array<double>")
    # Lengths are few: a column of embeddings has one, and each is a join of its own.
    for (length,) in sound.select("length").distinct().orderBy("length").collect():
        own = sound.where(F.col("length") == length).select("id", F.col("vector").cast(like).alias("vector"))
        shape = Grid(**{**grid.__dict__, "dims": min(grid.dims, length)})
        axes = rotation(own, shape)
        with Scratch(spark) as scratch:
            blocks = scratch.keep(_blocks(_placed(own, axes, kind, shape), axes, kind, shape), _SPLIT)
            # A row of a pair holds two runs, so few rows go to Python at once.
            with arrow_rows(spark, 8), settings(spark, _HELD):
                part = stored_rows(_linked(block_pairs(blocks, shape), blocks, axes, kind, shape))
        found = part if found is None else found.unionByName(part)
    ids = rows.select("id")
    if found is None:
        return ids.select(
            F.col("id").alias("vec_id"), F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"),
            F.col("id").isNotNull().alias("kept"),
        )
    counts = found.where("other IS NULL").groupBy("id").agg(F.sum("n").alias("n_links"))
    root = components(found.where("other IS NOT NULL").select(F.col("id").alias("a"), F.col("other").alias("b")))
    return (
        ids.join(counts, "id", "left")
        .join(root.withColumnRenamed("node", "id"), "id", "left")
        .select(
            F.col("id").alias("vec_id"),
            F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
            F.coalesce("component", "id").alias("component_id"),
        )
        .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
    )
