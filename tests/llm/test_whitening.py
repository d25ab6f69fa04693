from __future__ import annotations

import numpy as np
import pytest

from millrace.llm.whitening import Whitening, whiten

SCHEMA = "vec_id long, embedding array<float>, at long, x int, c string"


def frame(spark, vectors):
    return spark.createDataFrame([(i, v, 1, 2, "c") for i, v in vectors], SCHEMA).repartition(5)


def by_hand(vectors, k):
    x = np.floor(1024 * np.array(vectors, dtype=np.float32).astype(float)).astype(np.int64) + 100_000
    n, s = len(x), x.sum(axis=0)
    c = (n * x - s) / n
    e, v = np.linalg.eigh(c.T @ c / n)
    e, v = e[::-1], v[:, ::-1]
    return ((n * x - s) ** 2).sum(axis=1), c @ v[:, :k] / np.sqrt(e[:k]), e[:k] / e.sum()


@pytest.mark.parametrize(("n", "d", "block"), [(300, 12, 1), (150, 3, 1 << 21)])
def test_brute_force(spark, n, d, block):
    rng = np.random.default_rng(n)
    vectors = [[float(x) for x in v] for v in rng.normal(size=(n, d)) * np.arange(1, d + 1)]
    k = min(8, d)
    rows = whiten(frame(spark, list(enumerate(vectors))), Whitening(block_bytes=block)).collect()
    assert len(rows) == n * k and {r["n"] for r in rows} == {n}
    deviation, white, explained = by_hand(vectors, k)
    got = np.zeros((n, k))
    for r in rows:
        assert r["deviation"] == deviation[r["vec_id"]]
        assert abs(r["explained"] / explained[r["component"] - 1] - 1) < 1e-9
        got[r["vec_id"], r["component"] - 1] = r["whitened"]
    assert np.abs(got * np.sign((got * white).sum(axis=0)) - white).max() < 1e-8
    (error,) = {r["identity_error"] for r in rows}
    assert error < 1e-9


def test_left_out_vectors_repeats_and_null_ids(spark):
    nan, inf = float("nan"), float("inf")
    good = [(1, [0.5, 1.0]), (1, [0.5, 1.0]), (None, [0.25, -1.0]), (2, [2.0, 3.0])]
    bad = [(3, None), (4, [nan, 1.0]), (5, [1.0, -inf]), (6, [None, 1.0]), (7, []), (8, [1.0, 2.0, 3.0])]
    rows = whiten(frame(spark, good + bad)).collect()
    assert sorted((r["vec_id"] or -1, r["component"]) for r in rows) == sorted(
        (i or -1, c) for i, _ in good for c in (1, 2)
    )
    deviation, _, _ = by_hand([v for _, v in good], 2)
    assert {r["deviation"] for r in rows} == set(deviation.tolist()) and {r["n"] for r in rows} == {4}


def test_nothing_to_whiten(spark):
    for vectors in ([], [(1, None)], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])]):
        got = whiten(frame(spark, vectors))
        assert got.count() == 0 and got.columns[0] == "vec_id"


def test_directions_without_spread_are_no_components(spark):
    rows = whiten(frame(spark, [(i, [float(i), 5.0, 2.0 * i]) for i in range(20)])).collect()
    assert {r["component"] for r in rows} == {1} and rows[0]["explained"] == pytest.approx(1.0)


def test_too_large_to_be_exact_is_an_error(spark):
    with pytest.raises(Exception, match="(?i)overflow"):
        whiten(frame(spark, [(1, [1e30, 1.0]), (2, [1.0, 2.0])])).count()
