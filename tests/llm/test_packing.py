from __future__ import annotations

import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from corpus_pipeline import tokenizer_path
from millrace.llm import packing
from millrace.llm.packing import Limits


def brute_bins(demand, limits):
    left, bins = list(range(len(demand))), []
    while left:
        room, own = limits.astype(float).copy(), []
        while True:
            fits = [i for i in left if (demand[i] <= room).all()]
            if not fits:
                break
            pick = max(fits, key=lambda i: ((demand[i] / limits) @ (room / limits), tuple(demand[i]), -i))
            own.append(pick)
            left.remove(pick)
            room -= demand[pick]
        bins.append(own)
    return bins


def test_dot_product_rule_against_brute_force():
    rng = np.random.default_rng(2)
    limits = np.array([100, 8, 60])
    demand = np.column_stack([rng.integers(1, 80, 70), np.ones(70, dtype=int), rng.integers(0, 40, 70)])
    demand[:, 2] = np.minimum(demand[:, 2], demand[:, 0])
    got = packing.dot_product_bins(demand, limits)
    assert sorted(i for b in got for i in b) == list(range(70))
    assert all((demand[b].sum(axis=0) <= limits).all() for b in got)
    assert [sorted(map(tuple, demand[b])) for b in got] == [sorted(map(tuple, demand[b])) for b in brute_bins(demand, limits)]


def whole(docs, rows, limits):
    """Checks an exact round trip; returns the sequences' sizes."""
    plain = Tokenizer.from_file(tokenizer_path())
    want = {}
    for r in docs.collect():
        ids = plain.encode(r.text or "", add_special_tokens=False).ids + [0]
        want.setdefault(r.doc_id, []).append(np.array(ids, dtype="<u4"))
    pieces, sequences = {}, {}
    for r in rows:
        pieces.setdefault(r.doc_id, []).append(r)
        sequences.setdefault(r.sequence_id, []).append(r)
    assert set(pieces) == set(want)
    for doc, texts in want.items():
        assert sum(r.length for r in pieces[doc]) == sum(map(len, texts))
        if len(texts) > 1:
            continue
        at = 0
        for r in sorted(pieces[doc], key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(texts[0])
            at += r.length
            assert r.ids_crc32 == zlib.crc32(texts[0][r.start : at].tobytes())
    for own in sequences.values():
        at = 0
        for r in sorted(own, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= limits.tokens and len(own) <= limits.segments
        assert sum(r.loss_tokens for r in own) <= limits.loss
    return [sum(r.length for r in own) for own in sequences.values()]


def test_round_trip(documents):
    rows = packing.pack_documents(documents, tokenizer_path()).collect()
    sizes = whole(documents, rows, Limits())
    assert sum(1024 - s for s in sizes) <= 1024 * rows[0].asDict().get("tasks", 8)


@pytest.mark.parametrize("limits", [Limits(64, 3, 40), Limits(16, 1, 16), Limits(1, 1, 1)])
def test_limits(spark, documents, limits):
    docs = documents.limit(25)
    rows = packing.pack_documents(docs, tokenizer_path(), limits, loss=docs.doc_id % 2 == 0).collect()
    whole(docs, rows, limits)


def test_words_and_spaces(spark):
    texts = ["", None, " ", "  ", " a", "a ", "a  b", "a \n b", "a\n\n b", "x's I'm", "a\tb \t c", "é 日本 🙂", "<|endoftext|> x", "<|endoftext|", "a \xa0 b"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    whole(docs, packing.pack_documents(docs, tokenizer_path()).collect(), Limits())


def test_added_token_in_a_text():
    encode = packing.tokens_of(tokenizer_path())
    assert np.frombuffer(encode("a <|endoftext|> b"), dtype="<u4").tolist() == [64, 220, 50256, 275]


@pytest.mark.parametrize("space", [" ", "\n", "\t", " \u2003", "\x85"])
@pytest.mark.parametrize("times", [packing.LONG_SPACE - 1, packing.LONG_SPACE, 1_000_000])
def test_long_runs_of_white_space(space, times):
    text = f"some words{space * times}and the end"
    want = Tokenizer.from_file(tokenizer_path()).encode(text, add_special_tokens=False).ids
    got = np.frombuffer(packing.tokens_of(tokenizer_path())(text), dtype="<u4")
    assert np.array_equal(got, want)


def test_odd_rows(odd_docs, no_docs):
    rows = packing.pack_documents(odd_docs, tokenizer_path()).collect()
    whole(odd_docs, rows, Limits())
    assert sum(r.doc_id == 2 for r in rows) == 1 and [r.length for r in rows if r.doc_id == 2] == [1]
    assert packing.pack_documents(no_docs, tokenizer_path()).count() == 0
    with pytest.raises(ValueError, match="positive"):
        packing.pack_documents(no_docs, tokenizer_path(), Limits(0))
