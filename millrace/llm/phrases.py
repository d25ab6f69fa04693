"""Phrase collocation mining by Rabin-Karp fingerprints of word sequences.

A window of text is a byte array; numpy prefix polynomials over its bytes give the hash of
every word, and prefix polynomials over the words the fingerprint of every n-gram, with no
Python object for either. Lengths are mined one after another. A scan for length L counts
fingerprints of L words whose two parts of L - 1 words are frequent, and, for length L - 1,
reads the frequent phrases back from the text: equal fingerprints of a window are compared
byte by byte, and the shuffle sums counts and keeps an occurrence pointer for each
fingerprint *and* text. So a collision costs rows in the shuffle, never a wrong count, and
only phrases that can be frequent are ever written out as text.

What is frequent reaches the tasks as a bitmap of fixed size: a fingerprint whose bit is
clear is not frequent. Wrongly set bits let more rows into the shuffle and change no result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millrace.llm.common import arrow_rows, ship
from millrace.session import stored_rows


@dataclass(frozen=True)
class Mining:
    """``shortest`` to ``longest``: words of a candidate. ``least``: occurrences of a candidate.
    ``inside_percent``: a candidate is dropped inside a longer one with this share of its count.
    ``top``: phrases returned for a language, the feature's own limit. ``window``: bytes taken
    at once in a task. ``bits``: two to this power is the size of the bitmap in bits."""

    shortest: int = 2
    longest: int = 5
    least: int = 100
    inside_percent: int = 100
    top: int = 2_000
    window: int = 1 << 21
    bits: int = 27


# Odd bases for bytes and for words, and an odd factor that mixes bits.
# All arithmetic is modulo 2^64, where odd numbers have inverses and numpy wraps by itself.
BYTE_BASE = 0x9E3779B97F4A7C15
WORD_BASE = 0xC2B2AE3D27D4EB4F
MIX = 0xFF51AFD7ED558CCD

DELIMITERS = b".,;:!?\x0a\x0b\x0c\x0d"
SPACES = b" \t"

_KIND = np.zeros(256, dtype=np.uint8)
_KIND[list(SPACES)] = 1
_KIND[list(DELIMITERS)] = 2
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


class Powers:
    """Powers of a base and of its inverse modulo 2^64, as many as were asked for."""

    def __init__(self, base: int) -> None:
        self.steps = (base, pow(base, -1, 1 << 64))
        self.tables = [np.ones(1, dtype=np.uint64) for _ in self.steps]

    def first(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        for k, step in enumerate(self.steps):
            table = self.tables[k]
            while len(table) < n:
                table = np.concatenate([table, table * np.uint64(pow(step, len(table), 1 << 64))])
            self.tables[k] = table
        return self.tables[0][:n], self.tables[1][:n]


def prefix_sums(digits: np.ndarray, powers: Powers) -> np.ndarray:
    """S[i]: the polynomial of the first i digits."""
    up, _ = powers.first(len(digits))
    sums = np.zeros(len(digits) + 1, dtype=np.uint64)
    np.cumsum(digits * up, out=sums[1:])
    return sums


def span_hashes(sums: np.ndarray, start: np.ndarray, end: np.ndarray, powers: Powers) -> np.ndarray:
    """Hashes of the spans [start, end), the same wherever a span lies."""
    _, down = powers.first(len(sums))
    return mixed((sums[end] - sums[start]) * down[start])


def mixed(hashes: np.ndarray) -> np.ndarray:
    """One to one; low bits of a polynomial modulo 2^64 know only the low bits of its digits."""
    hashes = (hashes ^ hashes >> np.uint64(32)) * np.uint64(MIX)
    return hashes ^ hashes >> np.uint64(29)


_BYTES, _WORDS = Powers(BYTE_BASE), Powers(WORD_BASE)
# Case folding and the digit of a byte in one table.
_DIGIT = _LOWER.astype(np.uint64) + np.uint64(1)


class Window:
    """The words of a stretch of bytes, in lower case, and the fingerprints of their n-grams.

    ``doc_at`` is where documents begin, the first at 0; ``doc_code`` a number for the
    language of each. Words of one piece of one document have equal ``piece``.
    """

    def __init__(self, data: np.ndarray, doc_at: np.ndarray, doc_code: np.ndarray) -> None:
        self.data = _LOWER[data]
        kind = _KIND[data]
        # Whether a word goes on over the place before a byte; it never does where documents meet.
        inner = np.zeros(len(data) + 2, dtype=bool)
        inner[1:-1] = kind == 0
        over = inner[:-1] & inner[1:]
        over[doc_at] = False
        self.start = np.flatnonzero(inner[1:] & ~over)
        self.end = np.flatnonzero(inner[:-1] & ~over)
        bounds = np.searchsorted(self.start, np.append(doc_at, len(data)))
        self.doc = np.repeat(np.arange(len(doc_at)), np.diff(bounds))
        self.code = doc_code[self.doc].astype(np.uint64)
        self.piece = np.cumsum(kind == 2, dtype=np.int32)[self.start] + self.doc if len(data) else self.doc
        words = span_hashes(prefix_sums(_DIGIT[data], _BYTES), self.start, self.end, _BYTES)
        self.sums = prefix_sums(words | np.uint64(1), _WORDS)

    def grams(self, n: int) -> np.ndarray:
        """First words of the n-grams that lie in one piece."""
        last = len(self.start) - n + 1
        if last <= 0:
            return np.zeros(0, dtype=np.int64)
        return np.flatnonzero(self.piece[:last] == self.piece[n - 1 : n - 1 + last])

    def fingerprints(self, first: np.ndarray, n: int) -> np.ndarray:
        """64-bit fingerprints of n words from each of ``first`` on, by language."""
        return mixed(span_hashes(self.sums, first, first + n, _WORDS) + self.code[first])

    def phrases(self, first: np.ndarray, n: int) -> list[str]:
        raw = self.data.tobytes()
        spans = [
            [raw[a:b] for a, b in zip(self.start[first + i].tolist(), self.end[first + i].tolist(), strict=True)]
            for i in range(n)
        ]
        return [b" ".join(words).decode("utf-8", "replace") for words in zip(*spans, strict=True)]

    def same_text(self, a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
        """Whether the n words from ``a`` and from ``b`` on are equal, byte by byte."""
        same = self.code[a] == self.code[b]
        for i in range(n):
            sa, sb = self.start[a + i], self.start[b + i]
            size = self.end[a + i] - sa
            same &= size == self.end[b + i] - sb
            # All bytes of the words still equal, laid end to end.
            todo = np.flatnonzero(same & (sa != sb))
            spans = size[todo]
            ends = np.cumsum(spans)
            step = np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - spans, spans)
            left, right = np.repeat(sa[todo], spans) + step, np.repeat(sb[todo], spans) + step
            differ = np.flatnonzero(self.data[left] != self.data[right])
            same[todo[np.searchsorted(ends, differ, side="right")]] = False
        return same


def windows(data: np.ndarray, offsets: np.ndarray, size: int) -> Iterator[tuple[int, int]]:
    """Cuts the bytes of a batch into stretches of about ``size``, at ends of documents or pieces.

    No phrase crosses such a place, so nothing is lost; a piece of more than ``size`` bytes
    is a stretch of its own.
    """
    start, end = int(offsets[0]), int(offsets[-1])
    while start < end:
        stop = start + size
        if stop >= end:
            stop = end
        else:
            docs = offsets[np.searchsorted(offsets, stop, side="right") - 1]
            marks = np.flatnonzero(_KIND[data[start:stop]] == 2)
            best = max(int(docs), start + int(marks[-1]) + 1 if len(marks) else start)
            while best <= start:
                later = int(offsets[np.searchsorted(offsets, stop, side="right")])
                marks = np.flatnonzero(_KIND[data[stop : min(stop + size, later)]] == 2)
                if len(marks):
                    best = stop + int(marks[0]) + 1
                elif stop + size >= later:
                    best = later
                stop += size
            stop = best
        yield start, stop
        start = stop


def language_code(lang: str) -> int:
    """A number below 2^61 for the language, for the fingerprints."""
    value = 0
    for byte in lang.encode():
        value = (value * 1_000_003 + byte + 1) % ((1 << 61) - 1)
    return value


def _frequent(bitmap: np.ndarray, prints: np.ndarray, bits: int) -> np.ndarray:
    at = bit_place(prints, bits)
    return bitmap[at >> np.uint64(6)] >> (at & np.uint64(63)) & np.uint64(1) != 0


def bit_place(prints: np.ndarray, bits: int) -> np.ndarray:
    return prints & np.uint64((1 << bits) - 1)


# lang and phrase are set in rows of texts; words 0 counts all words of a language.
ROWS = "lang string, words int, print long, phrase string, n long, doc_id long"


def _read_back(w: Window, n: int, first: np.ndarray, prints: np.ndarray):
    """(first words, fingerprints, counts) of the different texts among the n-grams."""
    order = np.argsort(prints, kind="stable")
    first, prints = first[order], prints[order]
    while len(first):
        new = np.r_[True, prints[1:] != prints[:-1]]
        heads, group = np.flatnonzero(new), np.cumsum(new) - 1
        same = w.same_text(first[heads][group], first, n)
        yield first[heads], prints[heads], np.bincount(group[same], minlength=len(heads))
        # Other texts under the same fingerprint take another turn.
        first, prints = first[~same], prints[~same]


def _scan(docs: DataFrame, length: int, bitmap, mining: Mining) -> DataFrame:
    """Counts of fingerprints of ``length`` words, and of texts of ``length - 1`` words."""

    def batch_of(lang, words: int, prints, phrase, n, doc_id) -> pa.RecordBatch:
        size = len(n)
        columns = [
            pa.nulls(size, pa.string()) if lang is None else pa.array(lang, pa.string()),
            pa.array(np.full(size, words, np.int32)),
            pa.array(np.asarray(prints).view(np.int64)),
            pa.nulls(size, pa.string()) if phrase is None else pa.array(phrase, pa.string()),
            pa.array(np.asarray(n).astype(np.int64)),
            pa.nulls(size, pa.int64()) if doc_id is None else pa.array(doc_id, pa.int64()),
        ]
        return pa.record_batch(columns, names=names)

    def rows(data: np.ndarray, starts: np.ndarray, langs: list[str], ids: list) -> Iterator[pa.RecordBatch]:
        w = Window(data, starts, np.array([language_code(x) for x in langs], dtype=np.int64))
        if length == 1:
            kinds = sorted(set(langs))
            totals = [int((w.code == np.uint64(language_code(x))).sum()) for x in kinds]
            yield batch_of(kinds, 0, np.zeros(len(kinds), np.int64), None, totals, None)
            first = w.grams(1)
        else:
            shorter = w.grams(length - 1)
            prints = w.fingerprints(shorter, length - 1)
            wanted = _frequent(bitmap.value, prints, mining.bits)
            shorter, prints = shorter[wanted], prints[wanted]
            for heads, found, n in _read_back(w, length - 1, shorter, prints):
                docs_of = w.doc[heads].tolist()
                yield batch_of(
                    [langs[d] for d in docs_of], length - 1, found, w.phrases(heads, length - 1), n,
                    [ids[d] for d in docs_of],
                )
            if length > mining.longest:
                return
            known = np.zeros(len(w.start) + 1, dtype=bool)
            known[shorter] = True
            first = w.grams(length)
            first = first[known[first] & known[first + 1]]
        prints, n = np.unique(w.fingerprints(first, length), return_counts=True)
        yield batch_of(None, length, prints, None, n, None)

    names = ["lang", "words", "print", "phrase", "n", "doc_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            text = pa.chunked_array([batch.column("text")]).combine_chunks().cast(pa.large_binary())
            _, places, content = text.buffers()
            offsets = np.frombuffer(places, dtype=np.int64)[text.offset : text.offset + len(text) + 1]
            data = np.frombuffer(content, dtype=np.uint8) if content else np.zeros(0, dtype=np.uint8)
            langs, ids = batch.column("lang").to_pylist(), batch.column("doc_id").to_pylist()
            for start, stop in windows(data, offsets, mining.window):
                low = int(np.searchsorted(offsets, start, side="right")) - 1
                high = int(np.searchsorted(offsets, stop, side="left"))
                begins = np.maximum(offsets[low:high] - start, 0)
                yield from rows(data[start:stop], begins, langs[low:high], ids[low:high])

    return docs.mapInArrow(run, ROWS)


def bitmap_of(prints: DataFrame, bits: int) -> np.ndarray:
    """A bit for each place that a fingerprint falls on; at most 2^bits / 64 numbers reach the driver."""
    place = F.col("print").bitwiseAND(F.lit((1 << bits) - 1))
    rows = (
        prints.select(place.alias("place"))
        .groupBy(F.shiftright("place", 6).alias("word"))
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(place & 63 AS int))")).alias("value"))
        .toArrow()
    )
    bitmap = np.zeros(max(1, (1 << bits) >> 6), dtype=np.int64)
    bitmap[rows["word"].to_numpy()] = rows["value"].to_numpy()
    return bitmap.view(np.uint64)


def frequent_phrases(docs: DataFrame, mining: Mining = Mining()) -> DataFrame:
    """(lang, words, phrase, n, doc_id): every phrase with its exact count, at least ``least``;
    doc_id is that of an occurrence. A row with words 0 and no phrase counts all words of a language.

    Null texts are empty and a null language is ``und``; repeated rows count each time; an
    empty table gives no rows.
    """
    spark = docs.sparkSession
    ship(spark)
    texts = docs.select(
        F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"),
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    bitmap, found = None, None
    for length in range(1, mining.longest + 2):
        with arrow_rows(spark, 1_000):
            counted = stored_rows(
                _scan(texts, length, bitmap, mining)
                .groupBy("lang", "words", "print", "phrase")
                .agg(F.sum("n").alias("n"), F.min("doc_id").alias("doc_id"))
                .where((F.col("words") == 0) | (F.col("n") >= mining.least))
            )
        part = counted.where("lang IS NOT NULL").select("lang", "words", "phrase", "n", "doc_id")
        found = part if found is None else found.unionByName(part)
        if length <= mining.longest:
            if bitmap is not None:
                bitmap.unpersist()
            bitmap = spark.sparkContext.broadcast(bitmap_of(counted.where("lang IS NULL"), mining.bits))
    return found


def _words_of(phrase: str | Column, start: int | Column, length: int | Column) -> Column:
    return F.array_join(F.slice(phrase, start, length), " ")


def collocations(docs: DataFrame, mining: Mining = Mining()) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score and doc_id, the ``top`` phrases of each language.

    a, l and r count the phrase, its first part and its rest; n all words of the language;
    score is floor(1000 * a * n / (l * r)) at the cut where it is lowest, ties to the
    earliest. Products are decimals of 38 digits, an error beyond, and quotients exact.
    """
    found = frequent_phrases(docs, mining)
    phrases = found.where("words > 0")
    totals = found.where("words = 0").groupBy("lang").agg(F.sum("n").alias("n"))
    candidates = phrases.where(F.col("words").between(mining.shortest, mining.longest)).select(
        "lang", "phrase", F.col("n").alias("a"), "doc_id", "words", F.split("phrase", " ").alias("w")
    )
    inner = candidates.select(
        "lang", "a", "words", "w", F.explode(F.sequence(F.lit(mining.shortest), F.col("words"))).alias("size")
    ).where("size < words")
    inner = inner.select(
        "lang", "a", "w", "size", F.explode(F.sequence(F.lit(1), F.expr("words - size + 1"))).alias("at")
    ).select("lang", _words_of("w", F.col("at"), F.col("size")).alias("phrase"), "a")
    longer = inner.groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    kept = candidates.join(longer, ["lang", "phrase"], "left").where(
        "longer IS NULL OR 100 * longer < a * %d" % mining.inside_percent
    )
    cut = kept.select(
        "lang", "phrase", "a", "doc_id", "w", "words", F.explode(F.sequence(F.lit(1), F.expr("words - 1"))).alias("k")
    ).select(
        "lang", "phrase", "a", "doc_id", "k",
        _words_of("w", 1, F.col("k")).alias("left"),
        _words_of("w", F.expr("k + 1"), F.expr("words - k")).alias("right"),
    )
    left = phrases.select("lang", F.col("phrase").alias("left"), F.col("n").alias("l"))
    right = phrases.select("lang", F.col("phrase").alias("right"), F.col("n").alias("r"))
    # One row for each language: as few as there are languages.
    whole = cut.join(left, ["lang", "left"]).join(right, ["lang", "right"]).join(totals, "lang")
    exact = F.expr(
        "(1000 * CAST(a AS DECIMAL(16,0)) * CAST(n AS DECIMAL(18,0)))"
        " div (CAST(l AS DECIMAL(19,0)) * CAST(r AS DECIMAL(19,0)))"
    )
    lowest = whole.withColumn("score", exact).groupBy("lang", "phrase").agg(
        F.min_by(F.struct("a", "l", "r", "n", "score", "doc_id"), F.struct("score", "k")).alias("best")
    )
    order = W.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return (
        lowest.select("lang", "phrase", "best.*")
        .withColumn("rank", F.row_number().over(order).cast("long"))
        .where(F.col("rank") <= mining.top)
        .select("lang", "rank", "phrase", "a", "l", "r", "n", "score", "doc_id")
    )


#: The same result in SQL; n-grams of 1 to 5 words are written out.
ORACLE = r"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents),
words AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
grams AS (
    SELECT lang, size, array_to_string(w[i : i + size - 1], ' ') AS phrase, count(*) AS f
    FROM words, range(1, 6) AS s(size), LATERAL (SELECT unnest(range(1, len(w) - size + 2)) AS i)
    GROUP BY ALL),
totals AS (SELECT lang, sum(f)::BIGINT AS n FROM grams WHERE size = 1 GROUP BY lang),
candidates AS (SELECT lang, size, phrase, f AS a, string_split(phrase, ' ') AS w FROM grams WHERE size > 1 AND f >= 100),
inside AS (
    SELECT lang, array_to_string(w[i : i + part - 1], ' ') AS phrase, max(a) AS longer
    FROM candidates, range(2, 5) AS p(part), LATERAL (SELECT unnest(range(1, size - part + 2)) AS i)
    WHERE part < size GROUP BY ALL),
kept AS (
    SELECT c.* FROM candidates c LEFT JOIN inside USING (lang, phrase) WHERE longer IS NULL OR 100 * longer < 100 * a),
cuts AS (
    SELECT k.lang, k.phrase, k.a, x.f AS l, y.f AS r, t.n, c.cut,
           (1000::HUGEINT * k.a * t.n) // (x.f::HUGEINT * y.f) AS score
    FROM kept k JOIN range(1, 5) AS c(cut) ON c.cut < k.size
    JOIN grams x ON x.lang = k.lang AND x.phrase = array_to_string(k.w[1 : c.cut], ' ')
    JOIN grams y ON y.lang = k.lang AND y.phrase = array_to_string(k.w[c.cut + 1 : k.size], ' ')
    JOIN totals t ON t.lang = k.lang),
best AS (
    SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1)
SELECT lang, rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n, score::BIGINT AS score
FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank FROM best)
WHERE rank <= 2000
"""
