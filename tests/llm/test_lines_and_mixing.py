"""Line dedup and mixing against brute force."""

from __future__ import annotations

from collections import Counter, defaultdict
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from millrace.llm import line_dedup, mixing
from millrace.llm.line_dedup import Spread
from millrace.llm.mixing import Mix


def brute_lines(rows, least):
    sites, places = defaultdict(set), defaultdict(list)
    for doc, text, source in rows:
        for at, line in enumerate(text.split("\n")):
            line = line.strip(" \t\r")
            if line:
                sites[line].add(source or "")
                places[line].append((doc, at))
    gone = {p for line, own in places.items() if len(sites[line]) >= least for p in sorted(own)[1:]}
    return {
        doc: "\n".join(x for at, x in enumerate(text.split("\n")) if (doc, at) not in gone) for doc, text, _ in rows
    }


@pytest.mark.parametrize("least", [2, 3, 6])
def test_line_dedup_brute_force(spark, least):
    rows = []
    for k in range(60):
        own = [f"own {k}", "common to all", f"pair {k % 7}", "", " common to all\t"]
        rows.append((k, "\n".join(own[k % 3 :] + [f"site {k % 4}"]), f"s{k % 8}" if k % 9 else None))
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = line_dedup.dedup_lines(docs, Spread(min_sites=least))
    assert {r.doc_id: r.text for r in got.collect()} == brute_lines(rows, least)


def test_line_spread_is_exact_near_the_threshold(spark):
    rows = [(k, f"line {n}", f"site{k}") for n in (8, 9, 10, 11, 12, 40) for k in range(n)]
    lines = line_dedup._lines(spark.createDataFrame(rows, "doc_id long, text string, source string"))
    got = line_dedup.site_spread(lines, Spread(min_sites=10))
    near = sorted(r.sites for r in got.collect())
    assert near[:3] == [10, 11, 12] and len(near) == 4 and abs(near[3] - 40) <= 8


def test_long_passages_need_fewer_sites(spark):
    passage = " ".join(f"word{k}" for k in range(60))
    rows = [(k, f"own {k}\n{passage}\nshort line", f"site{k % 3}") for k in range(300)]
    rows += [(k, f"own {k}\n{passage.upper()}", f"site{k % 2}") for k in range(300, 310)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = {r.doc_id: r.text for r in line_dedup.dedup_lines(docs).collect()}
    assert got == {
        k: t if k == 0 or k >= 300 else f"own {k}\nshort line" for k, t, _ in rows
    }
    few = {r.doc_id: r.text for r in line_dedup.dedup_lines(docs, Spread(min_sites=2)).collect()}
    assert few[0] == rows[0][1] and few[1] == "own 1" and few[300] == rows[300][1] and few[301] == "own 301"


def test_line_dedup_odd_rows(odd_docs, no_docs):
    got = line_dedup.dedup_lines(odd_docs, Spread(min_sites=2))
    assert got.columns == odd_docs.columns and got.count() == odd_docs.count()
    text = [(r.doc_id, r.text, r.n_chars) for r in got.collect()]
    whole = "A plain line of text here.\nAnother line follows it."
    assert text.count((1, whole, 50)) == 2 and (6, "", 0) in text
    assert (2, None, None) in text and (3, "", 0) in text and (4, " \n\t\n ", 5) in text
    assert line_dedup.dedup_lines(no_docs).count() == 0


def sainte_lague(claims, seats, most):
    won = Counter()
    for _ in range(seats):
        best = max(claims, key=lambda c: (Fraction(claims[c], 2 * won[c] + 1), [-ord(x) for x in c]))
        won[best] += 1
    return {c: min(won[c], most[c]) for c in claims}


@pytest.mark.parametrize("seats", [0, 1, 5, 17, 100])
def test_apportion(spark, seats):
    claims = {"a": 53, "b": 24, "c": 23, "d": 0, "e": 1, "f": 7, "g": 7}
    most = dict.fromkeys(claims, 40)
    table = spark.createDataFrame([(p, c, seats, 40) for p, c in claims.items()], "party string, claim long, seats long, most long")
    got = mixing.apportion(table, [], "claim", "seats", "most", ["party"])
    assert {r.party: r.quota for r in got.collect()} == sainte_lague(claims, seats, most)


def brute_targets(sizes, mix):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: mix.weights[k % len(mix.weights)] for k, s in enumerate(names)}
    total = mix.share * sum(sizes.values())
    capped = set()
    while True:
        left = total - sum(mix.most * sizes[s] for s in capped)
        open_ = [s for s in names if s not in capped]
        mass = sum(weight[s] for s in open_)
        target = {s: left * weight[s] / mass for s in open_} | {s: mix.most * sizes[s] for s in capped}
        above = {s for s in open_ if target[s] > mix.most * sizes[s]}
        if not above:
            return target
        capped |= above


def test_mixing(spark, documents):
    mix = Mix(block=8, shard=2000)
    rows = mixing.plan(documents, mix).collect()
    assert len(rows) == documents.count()
    size, taken, target = Counter(), Counter(), {}
    for r in rows:
        size[r.source] += r.size
        taken[r.source] += r.taken
        target[r.source] = r.target
        assert 0 <= r.taken <= 2 * r.size and r.taken == sum(s.high - s.low for s in r.spans)
    want = brute_targets(size, mix)
    for s, t in want.items():
        assert abs(target[s] - t) < 1e-6 * max(t, 1)
        assert abs(taken[s] - t) <= 8 * 4
    again = mixing.plan(documents, mix).collect()
    assert sorted(map(str, rows)) == sorted(map(str, again))


@pytest.mark.parametrize("large", [0, 40_000])
def test_small_sources_come_near_their_targets(spark, large):
    words = {f"s{k:02d}": 12 + k % 3 for k in range(50)} | ({"zz": large} if large else {})
    rows = [(k, " ".join(["w"] * n), s) for k, (s, n) in enumerate(words.items())] + [(99, "", "empty"), (100, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixing.plan(docs).collect()
    want = brute_targets(words | {"empty": 0, None: 0}, Mix())
    assert len(got) == len(rows)
    for r in got:
        assert abs(r.target - want[r.source]) < 1e-6 * max(r.target, 1)
        # Rounding to whole words, and never above twice the size.
        assert abs(r.taken - r.target) <= 1.0 + 1e-6 and r.taken <= 2 * r.size


def test_mixed_documents_hold_the_taken_words(documents):
    mix = Mix(block=8, shard=2000)
    planned = mixing.plan(documents, mix).agg(F.sum("taken")).first()[0]
    mixed = mixing.mix_documents(documents, mix)
    assert mixed.columns == documents.columns
    assert mixed.agg(F.sum(mixing.word_count(F.col("text")))).first()[0] == planned
    assert mixed.where("n_chars <> length(text)").count() == 0


def test_mixing_odd_rows(odd_docs, no_docs):
    rows = mixing.plan(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    assert all(r.taken <= 2 * r.size for r in rows)
    assert {r.size for r in rows if r.doc_id in (2, 3, 4)} == {0}
    assert mixing.mix_documents(odd_docs).columns == odd_docs.columns
    assert mixing.mix_documents(odd_docs).count() > 0
    assert mixing.plan(no_docs).count() == 0 and mixing.mix_documents(no_docs).count() == 0
