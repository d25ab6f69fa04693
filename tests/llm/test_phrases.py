from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from millrace.llm import phrases
from millrace.llm.phrases import Mining, Window, collocations, frequent_phrases


def pieces(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [re.findall(r"[^\x20\x09]+", p) for p in re.split(r"[.,;:!?\x0A-\x0D]", lower)]


def named(lang):
    return "und" if lang is None else lang


def by_hand(rows, mining):
    counts, totals = Counter(), Counter()
    for lang, text in rows:
        for words in pieces(text):
            totals[named(lang)] += len(words)
            for size in range(1, mining.longest + 1):
                for i in range(len(words) - size + 1):
                    counts[named(lang), tuple(words[i : i + size])] += 1
    found = {k: n for k, n in counts.items() if len(k[1]) >= mining.shortest and n >= mining.least}
    out = []
    for (lang, p), a in found.items():
        if any(
            q_lang == lang and len(q) > len(p) and 100 * n >= mining.inside_percent * a
            and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))
            for (q_lang, q), n in found.items()
        ):
            continue
        cuts = []
        for k in range(1, len(p)):
            left, right = counts[lang, p[:k]], counts[lang, p[k:]]
            cuts.append((1000 * a * totals[lang] // (left * right), k, left, right))
        score, _, left, right = min(cuts)
        out.append((lang, -score, -a, " ".join(p).encode(), left, right, totals[lang]))
    rank, result = Counter(), []
    for lang, score, a, p, left, right, n in sorted(out):
        rank[lang] += 1
        if rank[lang] <= mining.top:
            result.append((lang, rank[lang], p.decode(), -a, left, right, n, -score))
    return result


def random_rows(seed, docs=60):
    rng = random.Random(seed)
    vocabulary = ["a", "B", "cc", "dé", "日本", "e-e", "\x00", "f g", "hh"]
    gaps = [" ", " ", " ", "\t", "  ", ", ", ".\n", "\r", "?"]
    rows = []
    for _ in range(docs):
        text = "".join(rng.choice(vocabulary) + rng.choice(gaps) for _ in range(rng.randint(0, 120)))
        rows.append((rng.choice(["en", "de", None, ""]), text))
    return rows + [("en", None), (None, ""), ("en", "a B cc. " * 30)] * 2


def frame(spark, rows):
    listed = [(i % 7 or None, text, lang, 1, 2, 3) for i, (lang, text) in enumerate(rows)]
    return spark.createDataFrame(
        listed, "doc_id long, text string, lang string, words int, print long, n long"
    ).repartition(4)


@pytest.mark.parametrize(
    ("seed", "mining"),
    [
        (1, Mining(least=4, window=200)),
        (2, Mining(least=3, window=1 << 20, bits=5, top=11)),
        (3, Mining(least=2, longest=3, inside_percent=60, window=64)),
    ],
)
def test_brute_force(spark, seed, mining):
    rows = random_rows(seed)
    got = [tuple(r)[:8] for r in collocations(frame(spark, rows), mining).collect()]
    assert sorted(got, key=lambda r: (r[0], r[1])) == by_hand(rows, mining)
    assert any(len(r[2].split(" ")) > 2 for r in got)


def test_colliding_fingerprints_change_no_count():
    rows = random_rows(4, 20)
    texts = [(0, text or "") for _, text in rows]
    data = "".join(t for _, t in texts).encode()
    at = np.cumsum([0] + [len(t.encode()) for _, t in texts[:-1]])
    w = Window(np.frombuffer(data, dtype=np.uint8), at, np.zeros(len(at), dtype=np.int64))
    for n in (1, 2, 3):
        first = w.grams(n)
        got = Counter()
        # One fingerprint for all: texts are told apart by their bytes alone.
        for places, _, counts in phrases._read_back(w, n, first, np.zeros(len(first), dtype=np.uint64)):
            for phrase, count in zip(w.phrases(places, n), counts.tolist(), strict=True):
                got[phrase] += count
        want = Counter(
            " ".join(p[i : i + n]) for _, t in rows for p in pieces(t) for i in range(len(p) - n + 1)
        )
        assert got == want


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet="abZ .,\t\né日", max_size=40), min_size=1, max_size=6), st.integers(1, 30))
def test_windows_keep_every_phrase(texts, size):
    data = np.frombuffer("".join(texts).encode(), dtype=np.uint8)
    offsets = np.cumsum([0] + [len(t.encode()) for t in texts]).astype(np.int64)
    got = Counter()
    for start, stop in phrases.windows(data, offsets, size):
        low = int(np.searchsorted(offsets, start, side="right")) - 1
        high = int(np.searchsorted(offsets, stop, side="left"))
        begins = np.maximum(offsets[low:high] - start, 0)
        w = Window(data[start:stop], begins, np.zeros(high - low, dtype=np.int64))
        for n in (1, 2, 4):
            got.update(w.phrases(w.grams(n), n))
    want = Counter(
        " ".join(p[i : i + n]) for t in texts for p in pieces(t) for n in (1, 2, 4) for i in range(len(p) - n + 1)
    )
    assert got == want


def test_equal_phrases_have_equal_fingerprints_anywhere():
    def prints(text, n):
        data = np.frombuffer(text.encode(), dtype=np.uint8)
        w = Window(data, np.zeros(1, dtype=np.int64), np.array([phrases.language_code("en")]))
        return w.fingerprints(w.grams(n), n).tolist()

    assert prints("x  y\tz", 3)[0] == prints("A b c. d X y  Z", 3)[-1]
    assert len(set(prints("a b c d e f ab bc", 2))) == 7


def test_empty_table_and_one_long_text(spark):
    empty = collocations(frame(spark, [("en", "x")]).limit(0))
    assert empty.count() == 0
    assert empty.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score", "doc_id"]
    # One piece far longer than a window.
    text = "one two three " * 20_000
    got = frequent_phrases(frame(spark, [("en", text)]), Mining(longest=2, window=1_000)).collect()
    assert {(r["phrase"], r["n"]) for r in got if r["words"] == 2} == {
        ("one two", 20_000), ("two three", 20_000), ("three one", 19_999),
    }
    assert [r["n"] for r in got if r["words"] == 0] == [60_000]
