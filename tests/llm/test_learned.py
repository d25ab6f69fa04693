"""The line field and the boosted trees: their mathematics, and held-out accuracy."""

from __future__ import annotations

import itertools

import numpy as np
import pytest

from millrace.llm import crf_quality, toxicity
from millrace.llm.common import Memo
from millrace.llm.labelled import sample


def test_marginals_against_enumeration():
    rng = np.random.default_rng(3)
    per_text = np.array([1, 4, 2, 5])
    good, ties = rng.normal(size=per_text.sum()), rng.normal(size=(2, 2))
    chance, pairs, total = crf_quality.marginals(good, ties, per_text)
    want, want_pairs, want_total, at = [], np.zeros((2, 2)), 0.0, 0
    for n in per_text:
        score = good[at : at + n]
        weights = {}
        for y in itertools.product((0, 1), repeat=int(n)):
            weights[y] = np.exp(score @ np.array(y) + sum(ties[a, b] for a, b in zip(y, y[1:], strict=False)))
        z = sum(weights.values())
        want += [sum(w for y, w in weights.items() if y[k]) / z for k in range(n)]
        for y, w in weights.items():
            for a, b in zip(y, y[1:], strict=False):
                want_pairs[a, b] += w / z
        want_total += np.log(z)
        at += n
    assert np.allclose(chance, want) and np.allclose(pairs, want_pairs) and np.isclose(total, want_total)


def test_isotonic_is_monotone_and_pools():
    x, y = np.array([1.0, 2, 3, 4, 5, 6]), np.array([0.0, 1, 0, 0, 1, 1])
    at, value = toxicity.isotonic(x, y, np.ones(6))
    assert (np.diff(at) >= 0).all() and (np.diff(value) >= 0).all() and 0 <= value.min() and value.max() <= 1
    assert np.isclose(np.interp(3, at, value), 1 / 3)


def test_trees_learn_an_interaction():
    rng = np.random.default_rng(5)
    x = rng.random((2000, 3))
    y = ((x[:, 0] > 0.5) & (x[:, 1] > 0.5)).astype(float)
    base, trees = toxicity.grow(x, y, toxicity.Fit(rounds=20))
    margin = base + sum(t(x) for t in trees)
    assert ((margin > 0) == y).mean() > 0.98


def test_disguised_words_and_person():
    memo = Memo(lambda w: toxicity._kinds(w, frozenset()))
    plain, near, hidden = toxicity.text_features(["an idiot there", "you idiot there", "an 1d10t there"], memo)
    assert plain[1] > 0 and plain[9] == 0 and near[9] > 0 and hidden[3] > 0 and hidden[1] == 0


def test_sample_holds_one_row_of_a_repeated_id(spark):
    docs = spark.range(600).selectExpr("id % 3 AS doc_id", "concat('text ', id) AS text")
    docs = docs.union(spark.createDataFrame([(5, None)], "doc_id long, text string"))
    labels = spark.createDataFrame([(0, 1), (1, 0), (2, 1), (5, 0), (5, 0)], "doc_id long, quality int")
    rows = sample(docs, labels, "quality", 10).collect()
    assert len(rows) == len({r.doc_id for r in rows}) and rows
    assert all(r.text == ("" if r.doc_id == 5 else min(f"text {i}" for i in range(r.doc_id, 600, 3))) for r in rows)


def test_sample_keeps_to_training_rows(documents, labels):
    import zlib

    rows = sample(documents, labels, "quality", 7).collect()
    assert rows and all(zlib.crc32(str(r.doc_id).encode()) % 3 != 1 for r in rows)
    assert max(sum(r.label == c for r in rows) for c in (0, 1)) <= 7


@pytest.mark.parametrize("operator, label, least", [(crf_quality, "quality", 0.95), (toxicity, "toxic", 0.9)])
def test_held_out_accuracy(spark, operator, label, least):
    folder = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    got = operator.classify(docs, labels)
    assert got.count() == docs.count()
    held = got.where("held_out").join(labels, "doc_id").select("predicted", "score", label).collect()
    assert all(0 <= r.score <= 1 for r in held)
    assert np.mean([r.predicted == r[label] for r in held]) >= least


@pytest.mark.parametrize("operator", [crf_quality, toxicity])
def test_odd_rows(spark, operator, odd_docs, no_docs, labels, documents):
    got = operator.classify(odd_docs, labels)
    assert got.count() == odd_docs.count()
    rows = got.collect()
    assert all(0 <= r.score <= 1 for r in rows)
    assert len({r.score for r in rows if r.doc_id in (2, 3)}) == 1
    assert operator.classify(no_docs, labels).count() == 0
    none = labels.limit(0)
    assert {r.score for r in operator.classify(documents.limit(5), none).collect()} == {0.5}


def test_keep_good(documents, labels, odd_docs):
    kept = crf_quality.keep_good(documents, labels)
    assert kept.columns == documents.columns
    good = crf_quality.classify(documents, labels).where("predicted = 1")
    assert kept.count() == good.count() < documents.count()
    assert crf_quality.keep_good(odd_docs, labels).columns == odd_docs.columns


def test_quality_learns_from_long_documents(spark):
    def text(k):
        if k % 2:
            return f"This is the plain text of page {k}, which a person wrote.\nIt has a second line as well."
        junk = f"$$ {k} || ## 0{k} %% BUY!!! || BUY!!! <<>> 77 88 99"
        return "\n".join([junk] * 300) if k % 4 else junk * 600

    docs = spark.createDataFrame([(k, text(k)) for k in range(80)], "doc_id long, text string")
    labels = spark.createDataFrame([(k, k % 2) for k in range(80)], "doc_id long, quality int")
    got = {r.doc_id: r.predicted for r in crf_quality.classify(docs, labels).collect()}
    assert got == {k: k % 2 for k in range(80)}


def test_runs_of_lines():
    fit = crf_quality.Fit(most_lines=3, most_chars=10)
    assert crf_quality.run_of_lines(1, "ab\ncd", fit) == "ab\ncd"
    assert crf_quality.run_of_lines(1, "x" * 30, fit) == "x" * 10
    for k in range(20):
        part = crf_quality.run_of_lines(k, "a\nb\nc\nd\ne\nf", fit)
        assert len(part.split("\n")) == 3 and part in "a\nb\nc\nd\ne\nf"
