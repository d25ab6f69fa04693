"""Fingerprints, near-duplicates, vectors and components against brute force."""

from __future__ import annotations

import base64
import hashlib
import itertools
import random
import struct

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from millrace.llm import bag_minhash, bottom_k, grid_join
from millrace.llm.common import Memo
from millrace.llm.graph import components
from millrace.llm.grid_join import Grid


def joined(nodes, links):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            root[n] = root[root[n]]
            n = root[n]
        return n

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    return {n: find(n) for n in nodes}


def test_components(spark):
    random.seed(4)
    links = [(random.randrange(300), random.randrange(300)) for _ in range(170)]
    links += [(1000 + k, 1001 + k) for k in range(60)] + [(2000, 2001 + k) for k in range(80)] + [(5, 5), (5, None)]
    got = components(spark.createDataFrame(links, "a long, b long"))
    real = [(a, b) for a, b in links if b is not None and a != b]
    nodes = {n for link in real for n in link}
    rows = got.collect()
    assert len(rows) == len(nodes) and {r.node: r.component for r in rows} == joined(nodes, real)
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


# Fingerprints


def shingles(text):
    words = text.split()
    return {tuple(words[i : i + 5]) for i in range(max(len(words) - 4, 1))}


def jaccard(a, b):
    return len(a & b) / len(a | b)


def test_fingerprints(spark, documents):
    rows = sorted(bottom_k.fingerprints(documents).collect(), key=lambda r: r.doc_id)
    texts = [r.text for r in documents.orderBy("doc_id").collect()]
    assert len(rows) == len(texts)
    for k, (r, text) in enumerate(zip(rows, texts, strict=True)):
        after = texts[(k + 1) % len(texts)]
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        assert r.n_chars == len(text)
        assert r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert abs(r.near_edited - jaccard(shingles(text), shingles(edited))) < 0.2
        assert abs(r.near_next - jaccard(shingles(text), shingles(after))) < 0.2
        n = len(shingles(text))
        assert r.shingles == n if n < bottom_k.K else abs(r.shingles / n - 1) < 0.4
        hashes = struct.unpack(f">{min(n, bottom_k.K)}q", base64.b64decode(r.fingerprint))
        assert list(hashes) == sorted(set(hashes))
    same = {}
    for r, text in zip(rows, texts, strict=True):
        assert same.setdefault(text, r.fingerprint) == r.fingerprint


def test_next_across_parts(spark):
    ids = [3, 3, 7, 8, 20, 21, 400, 401, 402, None]
    docs = spark.createDataFrame([(i, f"text {k}") for k, i in enumerate(ids)], "doc_id long, text string")
    rows = bottom_k.with_next(docs, rows=2).collect()
    assert {(r.text, r.next_text) for r in rows} == {(f"text {k}", f"text {(k + 1) % 10}") for k in range(10)}


def test_merged_parts_give_the_fingerprint_of_the_whole(spark):
    words = [f"w{(i * i) % 977}" for i in range(1500)]
    parts = [(1, " ".join(words[i : i + 104])) for i in range(0, 1500, 100)]
    whole = spark.createDataFrame([(" ".join(words),)], "text string")
    whole = bottom_k.with_sketch(whole, "text", "s")
    parts = bottom_k.with_sketch(spark.createDataFrame(parts, "k long, text string"), "text", "s")
    got = bottom_k.merge_sketches(parts.select("k", "s"), ["k"], "s")
    assert got.first().s == whole.first().s
    assert whole.select(bottom_k.containment(F.col("s"), F.col("s")).alias("c")).first().c == pytest.approx(1.0)


def test_fingerprints_of_odd_rows(odd_docs, no_docs):
    rows = bottom_k.fingerprints(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    assert len({r.fingerprint for r in rows if r.doc_id in (2, 3, 4)}) == 1
    assert all(0 <= r.near_next <= 1 and 0 <= r.near_edited <= 1 for r in rows)
    assert bottom_k.fingerprints(no_docs).count() == 0


# BagMinHash


def bags(texts):
    memo = Memo(bag_minhash.word_hash)
    found = [bag_minhash.bag_of(t, memo, 5) for t in texts]
    of = np.repeat(np.arange(len(found)), [len(b[0]) for b in found])
    return np.concatenate([b[0] for b in found]), np.concatenate([b[1] for b in found]), of


@pytest.mark.parametrize("times", [(6, 3), (1, 1), (40, 1), (300, 170)])
def test_signatures_are_unbiased(times):
    own = [f"w{i}" for i in range(200)]
    texts = [" ".join(own + ["r s t u v w x"] * times[0]), " ".join(own[:120] + ["r s t u v w x"] * times[1] + own[150:])]
    signature = bag_minhash.signatures(*bags(texts), 2, 4096)
    want = bag_minhash.overlap(*(bag_minhash._shingles(t, 5) for t in texts))
    assert abs((signature[0] == signature[1]).mean() - want) < 4 * np.sqrt(want * (1 - want) / 4096) + 0.002


def test_signature_does_not_depend_on_company():
    texts = ["a b c d e f g h", "one two", "", " ".join(map(str, range(3000)))]
    together = bag_minhash.signatures(*bags(texts), 4, 96)
    assert np.isfinite(together).all()
    for k, text in enumerate(texts):
        assert (bag_minhash.signatures(*bags([text]), 1, 96)[0] == together[k]).all()


def brute_classes(rows):
    bag = {doc: bag_minhash._shingles(text or "", 5) for doc, text in rows}
    return joined(bag, [(a, b) for a, b in itertools.combinations(bag, 2) if bag_minhash.overlap(bag[a], bag[b]) >= 0.8])


def test_near_duplicates_brute_force(spark):
    random.seed(7)
    rows = []
    for group in range(12):
        words = [f"g{group}w{i}" for i in range(90)]
        for _ in range(9):
            rows.append((len(rows) * 3, " ".join(words)))
            at = random.randrange(85)
            words = words[:at] + [f"n{random.random()}"] + words[at + 1 :]  # a chain: ends are far apart
    rows += [(900, "short"), (901, "short"), (902, ""), (903, None), (904, "short text")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.class_id, r.kept) for r in bag_minhash.near_duplicates(docs).collect()}
    want = brute_classes(rows)
    assert {d: c for d, (c, _) in got.items()} == want
    assert all(kept == (d == want[d]) for d, (_, kept) in got.items())


def test_near_copies_on_both_sides_of_the_threshold(spark):
    """A large group of copies of one text: some linked to it, some to each other only, some to none."""
    rng = random.Random(11)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for doc in range(150):
        words = list(base)
        for at in rng.sample(range(120), rng.choice([1, 2, 3, 4, 5, 6, 9])):
            words[at] = f"n{rng.random()}" if doc % 3 else f"m{at}"
        rows.append((doc, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.class_id for r in bag_minhash.near_duplicates(docs).collect()}
    assert got == brute_classes(rows)
    near = bag_minhash.Near()
    texts = docs.selectExpr("unhex(md5(text)) AS v", "text")
    alone = {bytes(r.v) for r in bag_minhash.solitary(texts, near).collect()}
    own = {hashlib.md5(t.encode()).digest(): bag_minhash._shingles(t, near.shingle) for _, t in rows}
    shared = {v: max(bag_minhash.overlap(bag, own[w]) for w in own if w != v) for v, bag in own.items()}
    assert alone and all(shared[v] < near.similarity for v in alone)


def test_copies_too_far_apart_are_not_compared_in_pairs(spark, monkeypatch):
    """Copies of one text that link with nothing, though none has too much of its own to be near to any."""
    rng = random.Random(5)
    rows = [(0, " ".join(f"w{i}" for i in range(146)))]
    for doc in range(1, 300):
        words = rows[0][1].split()
        for k, at in enumerate(rng.sample(range(8, 132, 6), 4)):
            words[at] = f"n{doc}x{k}"
        rows.append((doc, " ".join(words)))
    compared, real = [], bag_minhash.verified

    def counted(pairs, texts, near):
        compared.append(pairs.count())
        return real(pairs, texts, near)

    monkeypatch.setattr(bag_minhash, "verified", counted)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.class_id for r in bag_minhash.near_duplicates(docs).collect()}
    assert got == brute_classes(rows)
    assert sum(compared) < 8 * len(rows)  # of 44,850 pairs


def test_links_beside_the_leader(spark):
    """Texts of several lengths near to each other but not to the text that leads their buckets."""
    rng = random.Random(23)
    base = [f"w{i}" for i in range(150)]
    rows = [(doc, " ".join(base[: 150 - doc])) for doc in range(6)]
    for pair in range(60):
        words = list(base)
        for at in rng.sample(range(150), 5):
            words[at] = f"n{pair}x{at}"
        rows.append((len(rows), " ".join(words)))
        cut = words[: rng.randrange(112, 150)]
        if pair % 2:
            cut[rng.randrange(110)] = f"m{pair}"
        rows.append((len(rows), " ".join(cut + ["r s"] * rng.choice([0, 3]))))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.class_id for r in bag_minhash.near_duplicates(docs).collect()}
    assert got == brute_classes(rows)


@pytest.mark.parametrize("seed", [1, 2])
def test_all_near_pairs_of_two_classes_are_candidates(spark, seed):
    rng = random.Random(seed)
    texts = ["", "a b", "a  b", "a b c", " ".join(["x y"] * 40), " ".join(["x y"] * 36), " ".join(["x y"] * 30)]
    for length in (9, 30, 60):
        for _ in range(50):
            words = [f"w{i}" for i in range(length - rng.randrange(length // 6 + 1))]
            for _ in range(rng.randrange(4)):
                at = rng.randrange(len(words))
                words[at : at + 1] = rng.choice([[], [words[at]] * 2, [f"n{rng.randrange(6)}"], ["x y"]])
            texts.append(" ".join(words))
    own = {hashlib.md5(t.encode()).digest(): t for t in texts}
    root = {v: rng.choice([v, min(own)]) for v in own}
    frame = spark.createDataFrame([(bytearray(v), t) for v, t in own.items()], "v binary, text string")
    rooted = spark.createDataFrame([(bytearray(v), bytearray(r)) for v, r in root.items()], "v binary, root binary")
    with bag_minhash.Scratch(spark) as scratch:
        found = {(bytes(r.a), bytes(r.b)) for r in bag_minhash._across(rooted, frame, bag_minhash.Near(), scratch).collect()}
    bag = {v: bag_minhash._shingles(t, 5) for v, t in own.items()}
    apart = [(a, b) for a, b in itertools.combinations(sorted(own), 2) if root[a] != root[b]]
    near = {p for p in apart if bag_minhash.overlap(bag[p[0]], bag[p[1]]) >= 0.8}
    assert len(near) > 20 and near <= found <= set(apart)


def test_near_duplicates_of_documents(documents):
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    got = {r.doc_id: r.class_id for r in bag_minhash.near_duplicates(documents).collect()}
    assert got == brute_classes(rows)


def test_near_duplicates_of_odd_rows(odd_docs, no_docs):
    rows = bag_minhash.near_duplicates(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    assert {r.class_id for r in rows if r.doc_id in (1, 6)} == {1}
    assert {r.class_id for r in rows if r.doc_id in (2, 3, 4)} == {2}
    kept = bag_minhash.keep_one(odd_docs)
    assert kept.columns == odd_docs.columns
    assert [r.doc_id for r in kept.orderBy(F.col("doc_id").asc_nulls_first()).collect()] == [None, 1, 2, 5, 7]
    assert bag_minhash.near_duplicates(no_docs).count() == 0 and bag_minhash.keep_one(no_docs).count() == 0


# Vectors


def brute_vectors(rows, least=0.9):
    good = {
        i: np.array(v, dtype=float) for i, v in rows
        if v and all(x is not None and np.isfinite(x) for x in v) and any(v)
    }
    good = {i: v / np.linalg.norm(v) for i, v in good.items()}
    links = [(a, b) for a, b in itertools.combinations(good, 2) if len(good[a]) == len(good[b]) and good[a] @ good[b] >= least]
    return joined([i for i, _ in rows], links), links


@pytest.mark.parametrize("grid", [Grid(), Grid(block=16, leaf=4, fan=2), Grid(block=7, leaf=3, fan=3, dims=2)])
def test_grid_join_brute_force(spark, grid):
    rng = np.random.default_rng(9)
    centers = rng.normal(size=(25, 12))
    rows = [(k * 2, list(map(float, centers[k % 25] + 0.25 * rng.normal(size=12)))) for k in range(220)]
    rows += [(1001 + k, rows[3][1]) for k in range(40)]
    nan, inf = float("nan"), float("inf")
    rows += [(2001, None), (2002, [0.0] * 12), (2003, [nan] + [1.0] * 11), (2004, [inf] + [1.0] * 11), (2005, []), (2006, [None] * 12)]
    rows += [(2007, [1.0, 2.0]), (2008, [2.0, 4.1]), (2009, [1e-30] * 12), (2010, [1e30] * 12)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    got = {r.vec_id: r for r in grid_join.near_vectors(table, grid).collect()}
    roots, links = brute_vectors(rows)
    count = {i: 0 for i, _ in rows}
    for a, b in links:
        count[a] += 1
        count[b] += 1
    assert {i: r.n_links for i, r in got.items()} == count
    assert {i: r.component_id for i, r in got.items()} == roots
    assert all(r.kept == (i == r.component_id) for i, r in got.items())


def _linked_plans(monkeypatch):
    """The plans of what is stored of the compared pairs, as they ran."""
    plans, real = [], grid_join.stored_rows

    def stored(df, *args, **options):
        if df.columns == ["id", "other", "n"]:
            plans.append(df._jdf.queryExecution().executedPlan().toString())
        return real(df, *args, **options)

    monkeypatch.setattr(grid_join, "stored_rows", stored)
    return plans


def test_grid_join_copies_no_vector_for_each_partner(spark, monkeypatch):
    # Spread evenly, so no box tells vectors apart and every block meets every other.
    rng = np.random.default_rng(11)
    vectors = rng.normal(size=(300, 16))
    vectors[200:] = vectors[:100] + 0.1 * rng.normal(size=(100, 16))
    rows = [(k, list(map(float, v))) for k, v in enumerate(vectors)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    plans, least = _linked_plans(monkeypatch), spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = {r.vec_id: (r.n_links, r.component_id) for r in grid_join.near_vectors(table, Grid(block=8, leaf=4, fan=2)).collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", least)
    roots, links = brute_vectors(rows)
    assert len(links) >= 100 and {i: c for i, (_, c) in got.items()} == roots
    assert sum(n for n, _ in got.values()) == 2 * len(links)
    assert len(plans) == 1 and "Exchange" not in plans[0]


@pytest.mark.parametrize("partners", [0, 1 << 30])
@pytest.mark.parametrize("kind", ["float", "double"])
def test_grid_join_shuffled_or_read_in_parts(spark, monkeypatch, partners, kind):
    rng = np.random.default_rng(12)
    rows = []
    for length, n in ((10, 90), (3, 40)):
        base = rng.normal(size=(n // 3, length)).astype(np.float32)
        near = base[rng.integers(0, len(base), n)] * (1 + rng.random((n, 1))) + 0.12 * rng.normal(size=(n, length))
        rows += [(None if k == 5 else len(rows) + k, list(map(float, v.astype(np.float32)))) for k, v in enumerate(near)]
    rows += [(7_000 + k, rows[0][1]) for k in range(60)]  # more copies than a block holds
    rows += [(2, rows[20][1]), (7_003, None), (3, [0.0] * 10)]
    table = spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>").repartition(4)
    monkeypatch.setattr(grid_join, "_PARTNERS", partners)
    got = grid_join.near_vectors(table, Grid(block=8, leaf=3, fan=3)).collect()
    good = [(i, np.array(v) / np.linalg.norm(v)) for i, v in rows if i is not None and v and any(v)]
    count, links = dict.fromkeys({i for i, _ in rows}, 0), []
    for (a, x), (b, y) in itertools.combinations(good, 2):
        if len(x) == len(y) and x @ y >= 0.9:
            links.append((a, b))
            count[a] += 1
            count[b] += 1
    roots = joined({i for i, _ in rows if i is not None}, links)
    assert len(got) == len(rows) and {r.vec_id: r.n_links for r in got} == count
    assert {r.vec_id: r.component_id for r in got} == roots | {None: None}


def test_grid_join_bound_passes_every_near_pair():
    rng = np.random.default_rng(13)
    x = rng.normal(size=(400, 24))
    x[200:] = x[:200] + 0.09 * rng.normal(size=(200, 24)) * rng.random((200, 1)) * 3
    x[300:320] = x[0]
    units, axes = grid_join.unit_rows(x), np.linalg.qr(rng.normal(size=(24, 24)))[0]
    near = {(i, j) for i, j in zip(*np.nonzero(units @ units.T >= 0.9), strict=True) if i < j}
    for n in (1, 8, 24):
        run = grid_join._Run(np.arange(400).tobytes(), x.tobytes(), np.dtype("float64"), axes[:, :n], Grid(dims=1, leaf=16))
        found = list(grid_join._candidates(run, run, True, Grid(dims=1, leaf=16, block=64)))
        pairs = [p for a, b in found for p in zip(a, b, strict=True)]
        assert len(pairs) == len(set(pairs)) and near <= set(pairs) and (n < 24 or len(pairs) < 2 * len(near))


def test_grid_join_odd_tables(spark):
    schema = "vec_id long, embedding array<float>, id long, block long"
    assert grid_join.near_vectors(spark.createDataFrame([], schema)).count() == 0
    rows = [(None, [1.0, 0.0], 1, 1), (1, None, 1, 1), (2, [1.0, 0.0], 1, 1), (2, [1.0, 0.0], 1, 1)]
    got = grid_join.near_vectors(spark.createDataFrame(rows, schema)).collect()
    assert len(got) == 4 and {r.n_links for r in got if r.vec_id == 1} == {0}


def test_long_texts_are_signed_in_small_lots(spark, monkeypatch):
    from millrace.llm import bag_minhash

    sizes, real = [], bag_minhash.signatures
    monkeypatch.setattr(bag_minhash, "signatures", lambda items, *a: sizes.append(len(items)) or real(items, *a))

    class Rows:
        def mapInPandas(self, run, schema):  # the function itself, in this process
            texts = [" ".join(f"w{i}x{k}" for k in range(20_004)) for i in range(8)]
            frame = pd.DataFrame({"v": [bytes([i]) * 16 for i in range(8)], "text": texts})
            return pd.concat(run(iter([frame])))

    found = bag_minhash.signature_bands(Rows(), bag_minhash.Near())
    assert [v[0] for v in found["v"]] == list(range(8)) and len(sizes) > 1
    assert max(sizes) <= bag_minhash.TOGETHER + 20_000 and sum(sizes) == 160_000
