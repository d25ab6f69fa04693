"""Vector bin packing of examples into training sequences.

A sequence has three limits at once: tokens, segments and loss-bearing tokens. The
dot-product rule fills the open sequence: among the pieces that fit, take the one whose
demand vector has the largest dot product with what is left of the limits, each dimension
relative to its limit. Work is done window by window inside each task, without a shuffle;
a task holds at most one window of remainders, whatever the length of a document.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import Memo, ship, text_or_empty

WINDOW = 4096  # remainders packed together
PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
    "sequence_id long, offset long, loss_tokens long"
)


@dataclass(frozen=True)
class Limits:
    tokens: int = 1024
    segments: int = 32
    loss: int = 1024


def dot_product_bins(demand: np.ndarray, limits: np.ndarray) -> list[list[int]]:
    """Bins of item numbers; ``demand`` is items × dimensions, none above its limit.

    Items with equal demands are one class, so a choice costs one product over the
    classes that are left. Ties go to the class with the larger demand, then to the
    earlier item.
    """
    if not len(demand):
        return []
    classes, of_item = np.unique(demand, axis=0, return_inverse=True)
    order = np.argsort(of_item.ravel(), kind="stable")
    counts = np.bincount(of_item.ravel(), minlength=len(classes))
    ends = np.cumsum(counts)
    next_item = ends - counts
    share = classes / np.maximum(limits, 1)
    bins: list[list[int]] = []
    left = len(demand)
    while left:
        room, own = limits.astype(np.int64).copy(), []
        while left:
            fits = (next_item < ends) & (classes <= room).all(axis=1)
            if not fits.any():
                break
            score = share @ (room / np.maximum(limits, 1))
            score[~fits] = -1.0
            pick = len(score) - 1 - int(np.argmax(score[::-1]))
            own.append(int(order[next_item[pick]]))
            next_item[pick] += 1
            room -= classes[pick]
            left -= 1
        bins.append(own)
    return bins


class _Tokens:
    """Token ids of texts, as little-endian unsigned 32-bit bytes.

    Words that begin at a single space never merge with what is before them in a
    byte-level vocabulary with this split pattern, so their ids are looked up once and
    kept. Texts with runs of spaces, where the pattern looks further, are encoded whole, and
    those with very long runs of white space, on which tiktoken breaks off, by tokenizers.
    So are texts that spell out an added token, which is that token's id, as tokenizers has it.
    """

    def __init__(self, path: str) -> None:
        import json

        import tiktoken
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        to_byte = _byte_of_char()
        special = {t["content"] for t in spec.get("added_tokens", [])}
        ranks = {
            bytes(to_byte[c] for c in token): rank
            for token, rank in spec["model"]["vocab"].items()
            if token not in special
        }
        self.plain = Tokenizer.from_file(path)
        self.added = re.compile("|".join(map(re.escape, sorted(special)))) if special else None
        self.encoding = tiktoken.Encoding(
            "vocabulary", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={}
        )
        self.first = Memo(self._ids)
        self.rest = Memo(lambda word: self._ids(" " + word))

    def _ids(self, text: str) -> bytes:
        return np.array(self.encoding.encode_ordinary(text), dtype="<u4").tobytes()

    def __call__(self, text: str) -> bytes:
        if not text:
            return b""
        if self.added and self.added.search(text):
            return np.array(self.plain.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()
        if len(text) >= LONG_SPACE and any(m.end() - m.start() >= LONG_SPACE for m in _SPACES.finditer(text)):
            return np.array(self.plain.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()
        if "  " in text:
            return self._ids(text)
        words = text.split(" ")
        head = self._ids(words[0])
        return head + b"".join(map(self.rest.__getitem__, words[1:]))


# The published split pattern of the byte-level vocabulary.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

LONG_SPACE = 100_000  # characters of white space in a row that tiktoken is not given
_SPACES = re.compile(r"\s{2,}")


def _byte_of_char() -> dict[str, int]:
    """The byte-level alphabet: printable bytes stand for themselves, the rest follow at 256."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    table = {chr(b): b for b in shown}
    hidden = [b for b in range(256) if b not in set(shown)]
    return table | {chr(256 + i): b for i, b in enumerate(hidden)}


_LOADED: dict[str, _Tokens] = {}


def tokens_of(path: str) -> _Tokens:
    if path not in _LOADED:
        _LOADED[path] = _Tokens(path)
    return _LOADED[path]


def _pack_window(waiting: list[tuple], limits: Limits, first_bin: int, last: bool):
    """Rows of one window of remainders (doc, start, ids, doc_tokens, loss tokens).

    Returns rows, the number of bins used, and the remainders of the last, unfilled bin,
    which go on into the next window unless it is the ``last``.
    """
    demand = np.array([[len(w[2]) // 4, 1, w[4]] for w in waiting], dtype=np.int64).reshape(-1, 3)
    bins = dot_product_bins(demand, np.array([limits.tokens, limits.segments, limits.loss]))
    spare: list[int] = []
    if not last and len(bins) > 1:
        spare = bins.pop()
    # What the fullest bins still lack is cut from the pieces of the emptiest: cutting is free.
    size = [int(demand[b, 0].sum()) for b in bins]
    loss = [int(demand[b, 2].sum()) for b in bins]
    parts = [[(i, 0, int(demand[i, 0])) for i in b] for b in bins]
    order = sorted(range(len(bins)), key=lambda k: -size[k])
    low = len(order) - 1
    for k in order:
        while size[k] < limits.tokens and len(parts[k]) < limits.segments:
            while low >= 0 and not parts[order[low]]:
                low -= 1
            donor = order[low] if low >= 0 else k
            if donor == k:
                break
            i, a, b = parts[donor][-1]
            # A document bears loss on all of its tokens or, as a prompt, on none.
            bears = bool(demand[i, 2])
            take = min(b - a, limits.tokens - size[k], limits.loss - loss[k] if bears else b - a)
            if take <= 0:
                break
            parts[donor].pop()
            if b - a > take:
                parts[donor].append((i, a + take, b))
            parts[k].append((i, a, a + take))
            for n, sign in ((k, 1), (donor, -1)):
                size[n] += sign * take
                loss[n] += sign * take * bears
        if low >= 0 and order[low] == k:
            break
    rows, used = [], 0
    for own in parts:
        offset = 0
        for i, a, b in own:
            doc, start, ids, total, bears = waiting[i]
            piece = ids[4 * a : 4 * b]
            rows.append(
                (doc, start + a, b - a, zlib.crc32(piece), total, first_bin + used, offset, (b - a) * bool(bears))
            )
            offset += b - a
        used += bool(own)
    return rows, used, [waiting[i] for i in spare]


def pack_documents(
    docs: DataFrame,
    tokenizer_path: str,
    limits: Limits = Limits(),
    end_id: int = 0,
    loss: Column | None = None,
) -> DataFrame:
    """Pieces of all documents, placed in sequences within the limits.

    ``docs`` has doc_id and text; a document is its token ids and then ``end_id``. Whole
    sequences are cut from long documents; the remainders meet in windows of ``WINDOW``
    and are packed by the dot-product rule; then gaps are filled by cutting pieces of the
    emptiest sequences, so only the last sequence of a task has room left. ``loss`` says
    whether a document's tokens bear loss (default: all do).

    A null text is an empty one: its piece is ``end_id`` alone. A null doc_id stays null;
    repeated rows are packed each for itself; an empty table gives no rows. Further
    columns of ``docs`` are not read. sequence_id is the task's number times 2**36 plus a
    counter: a lost task gives the same ids when it runs again.
    """
    if min(limits.tokens, limits.segments) < 1 or limits.loss < 1:
        raise ValueError("limits must be positive")
    most = min(limits.tokens, limits.loss)
    ship(docs.sparkSession)

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = tokens_of(tokenizer_path)
        end = np.array([end_id], dtype="<u4").tobytes()
        base = TaskContext.get().partitionId() << 36
        used, waiting = 0, []
        columns = [c.split()[0] for c in PIECES.split(", ")]
        kinds = {c: "Int64" if c == "doc_id" else "int64" for c in columns}

        def frame(rows):
            return pd.DataFrame(rows, columns=columns).astype(kinds)

        for batch in batches:
            rows = []
            for doc, text, bears in zip(batch["doc_id"], batch["text"], batch["bears"], strict=True):
                doc = None if pd.isna(doc) else int(doc)
                ids = encode(text) + end
                total = len(ids) // 4
                whole = most if bears else limits.tokens
                at = 0
                while total - at >= whole:
                    piece = ids[4 * at : 4 * (at + whole)]
                    rows.append(
                        (doc, at, whole, zlib.crc32(piece), total, base + used, 0, whole * bool(bears))
                    )
                    used += 1
                    at += whole
                if at < total:
                    waiting.append((doc, at, ids[4 * at :], total, (total - at) * bool(bears)))
                if len(waiting) >= WINDOW:
                    more, n, waiting = _pack_window(waiting, limits, base + used, False)
                    rows += more
                    used += n
            if rows:
                yield frame(rows)
        if waiting:
            yield frame(_pack_window(waiting, limits, base + used, True)[0])

    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        text_or_empty().alias("text"),
        (F.lit(True) if loss is None else F.coalesce(loss.cast("boolean"), F.lit(False))).alias("bears"),
    ).mapInPandas(pack, PIECES)
