"""Document quality from a linear-chain conditional random field over lines.

Every line is good or bad. Its features are its own measures and those of the lines
before and after it; transition weights tie neighbours. Forward-backward gives each line
its marginal probability of being good, and the length-weighted mean of these, put
through a logistic curve fitted on labelled documents, is the document's score.

The field is fitted on the driver from a bounded sample (``Fit``); scoring runs in tasks,
a batch of documents at a time, all lines of all texts.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import ship, text_or_empty
from millrace.llm.labelled import held_out, sample


@dataclass(frozen=True)
class Fit:
    """``per_class``: documents of either label learned from; of those with more than
    ``most_lines`` lines or ``most_chars`` characters, a run of lines within both (all lines
    of all documents are scored)."""

    per_class: int = 1500
    most_lines: int = 200
    most_chars: int = 20_000
    rounds: int = 150


@dataclass(frozen=True)
class Field:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray  # of a line's features for "good" over "bad", the last the bias
    ties: np.ndarray  # 2 x 2: from label to label
    curve: np.ndarray  # bias, mean marginal
    constant: float | None = None  # the score of every document where labels can't tell


OWN = 13
# Byte classes (fixed): 0 other symbol, 1 lower, 2 upper, 3 digit, 4 white space, 5 sentence mark, 6 pipe, 7 beyond ASCII.
_CLASS = np.zeros(256, dtype=np.int64)
_CLASS[97:123], _CLASS[65:91], _CLASS[48:58] = 1, 2, 3
_CLASS[[9, 11, 12, 13, 32]] = 4
_CLASS[[ord(c) for c in ".,;:?!'\"()-"]] = 5
_CLASS[ord("|")] = 6
_CLASS[128:] = 7
_SHOUT = ord("!")


def line_features(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features of all lines, their lengths in bytes, and each text's number of lines."""
    lines: list[str] = []
    per_text = np.empty(len(texts), dtype=np.int64)
    for k, text in enumerate(texts):
        own = text.split("\n")
        per_text[k] = len(own)
        lines += own
    joined = ("\n".join(lines)).encode("utf-8", "replace")
    raw = np.frombuffer(joined, dtype=np.uint8)
    breaks = raw == 10
    of_line = np.cumsum(breaks)
    n = len(lines)
    counts = np.bincount(of_line[~breaks] * 8 + _CLASS[raw[~breaks]], minlength=8 * n).reshape(n, 8).astype(float)
    shouts = np.bincount(of_line[raw == _SHOUT], minlength=n).astype(float)
    size = counts.sum(axis=1)
    at = np.maximum(size, 1.0)
    words = np.zeros((n, 3))
    for k, line in enumerate(lines):
        own = line.split()
        if own:
            words[k] = len(own), sum(map(eq, own, own[1:])), len(set(own))
    per_word = np.maximum(words[:, 0], 1.0)
    letters = np.maximum(counts[:, 1] + counts[:, 2] + counts[:, 7], 1.0)
    own = np.column_stack(
        [
            np.log1p(size),
            counts[:, 2] / letters,
            counts[:, 3] / at,
            counts[:, 0] / at,
            np.minimum(counts[:, 0] / per_word, 4.0),
            np.minimum(counts[:, 6] / per_word, 2.0),
            counts[:, 7] / at,
            counts[:, 5] / per_word,
            shouts / per_word,
            np.minimum(size / per_word, 40.0),
            words[:, 1] / per_word,
            words[:, 2] / per_word,
            (size == 0).astype(float),
        ]
    )
    first = np.zeros(n, dtype=bool)
    first[np.cumsum(per_text) - per_text] = True
    last = np.zeros(n, dtype=bool)
    last[np.cumsum(per_text) - 1] = True
    before = np.roll(own, 1, axis=0)
    before[first] = own[first]
    after = np.roll(own, -1, axis=0)
    after[last] = own[last]
    return np.hstack([own, before, after]), size, per_text


def _by_step(per_text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Texts by falling number of lines, and how many of them have a k-th line."""
    order = np.argsort(-per_text, kind="stable")
    alive = np.searchsorted(-per_text[order], -np.arange(1, per_text.max() + 1), side="right") if len(order) else order
    return order, alive


def marginals(good: np.ndarray, ties: np.ndarray, per_text: np.ndarray):
    """Forward-backward over many chains at once.

    ``good``: each line's score for good over bad. Returns P(good) of each line, the summed
    2 x 2 pair marginals, and the summed log of the partition functions.
    """
    first = np.cumsum(per_text) - per_text
    order, alive = _by_step(per_text)
    start = first[order]
    unary = np.column_stack([np.zeros(len(good)), good])
    forward = np.empty_like(unary)
    backward = np.zeros_like(unary)
    for k, n in enumerate(alive):
        at = start[:n] + k
        if k:
            came = forward[at - 1][:, :, None] + ties
            forward[at] = np.logaddexp(came[:, 0], came[:, 1]) + unary[at]
        else:
            forward[at] = unary[at]
    pairs = np.zeros((2, 2))
    ends = first + per_text - 1
    total = np.logaddexp(forward[ends, 0], forward[ends, 1])
    whole = total[order]
    for k in range(len(alive) - 1, 0, -1):
        n = alive[k]
        at = start[:n] + k
        goes = ties + (unary[at] + backward[at])[:, None, :]
        backward[at - 1] = np.logaddexp(goes[:, :, 0], goes[:, :, 1])
        pairs += np.exp(forward[at - 1][:, :, None] + goes - whole[:n, None, None]).sum(axis=0)
    chance = np.exp(forward[:, 1] + backward[:, 1] - np.repeat(total, per_text))
    return np.clip(chance, 0.0, 1.0), pairs, float(total.sum())


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float) -> np.ndarray:
    """Newton's method; the last column of ``x`` is the bias and is not shrunk."""
    w = np.zeros(x.shape[1])
    shrink = np.full(x.shape[1], ridge)
    shrink[-1] = 1e-6
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (weight * (p - y)) + shrink * w
        curvature = (x * (weight * p * (1 - p))[:, None]).T @ x + np.diag(shrink)
        step = np.linalg.solve(curvature, gradient)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    return w


def _doc_mean(chance: np.ndarray, size: np.ndarray, per_text: np.ndarray) -> np.ndarray:
    """Length-weighted mean of the marginals; every line weighs one byte at least."""
    start = np.cumsum(per_text) - per_text
    weight = size + 1.0
    return np.add.reduceat(chance * weight, start) / np.add.reduceat(weight, start)


def fit_field(texts: list[str], labels: list[int], fit: Fit = Fit()) -> Field:
    """The field of labelled texts, by gradient ascent on the conditional likelihood.

    Lines of good documents are good. Lines of bad documents start as bad; those that a
    line model fitted first takes for good are relabelled, but the worst stays bad.
    """
    label = np.array(labels, dtype=float)
    width = 3 * OWN + 1
    if not len(label) or label.min() == label.max():
        only = float(label.mean()) if len(label) else 0.5
        return Field(np.zeros(width - 1), np.ones(width - 1), np.zeros(width), np.zeros((2, 2)), np.zeros(2), only)
    x, size, per_text = line_features(texts)
    mean, scale = x.mean(axis=0), np.maximum(x.std(axis=0), 1e-3)
    x = np.hstack([np.clip((x - mean) / scale, -8, 8), np.ones((len(x), 1))])
    of_text = np.repeat(np.arange(len(per_text)), per_text)
    start = np.cumsum(per_text) - per_text
    y = label[of_text].copy()
    bad = label[of_text] == 0
    for _ in range(3):
        weight = np.where(y == 1, 0.5 / max(y.sum(), 1), 0.5 / max((1 - y).sum(), 1)) * len(y)
        line = _logistic(x, y, weight, 1.0)
        raw = x @ line
        worst = np.minimum.reduceat(raw, start)[of_text]
        y = np.where(bad, ((raw > 0) & (raw > worst)).astype(float), 1.0)
    now, was = y[1:].astype(int), y[:-1].astype(int)
    inner = of_text[1:] == of_text[:-1]
    seen = np.zeros((2, 2))
    np.add.at(seen, (was[inner], now[inner]), 1)
    w, ties = line.copy(), np.zeros((2, 2))
    moment = [np.zeros(w.size + 4), np.zeros(w.size + 4)]
    for k in range(1, fit.rounds + 1):
        chance, pairs, _ = marginals(x @ w, ties, per_text)
        gradient = np.concatenate([x.T @ (y - chance), (seen - pairs).ravel()]) / len(y)
        gradient -= 1e-3 * np.concatenate([w, ties.ravel()])
        moment[0] = 0.9 * moment[0] + 0.1 * gradient
        moment[1] = 0.99 * moment[1] + 0.01 * gradient**2
        step = 0.1 * moment[0] / (1 - 0.9**k) / (np.sqrt(moment[1] / (1 - 0.99**k)) + 1e-8)
        w = w + step[: w.size]
        ties = ties + step[w.size :].reshape(2, 2)
    chance, _, _ = marginals(x @ w, ties, per_text)
    level = _doc_mean(chance, size, per_text)
    even = np.where(label == 1, 0.5 / label.sum(), 0.5 / (1 - label).sum()) * len(label)
    curve = _logistic(np.column_stack([level, np.ones(len(level))]), label, even, 0.05)
    return Field(mean, scale, w, ties, curve)


def score_texts(field: Field, texts: list[str]) -> np.ndarray:
    if field.constant is not None:
        return np.full(len(texts), field.constant)
    x, size, per_text = line_features(texts)
    x = np.hstack([np.clip((x - field.mean) / field.scale, -8, 8), np.ones((len(x), 1))])
    chance, _, _ = marginals(x @ field.weights, field.ties, per_text)
    level = _doc_mean(chance, size, per_text)
    return 1 / (1 + np.exp(-(field.curve[0] * level + field.curve[1])))


# Characters whose features are held at once, about 64 bytes for each; a longer text is a part of its own.
CHARACTERS_AT_ONCE = 1 << 20


def score_in_parts(field: Field, texts: list[str], most: int = CHARACTERS_AT_ONCE) -> np.ndarray:
    """``score_texts``, part after part of at most so many characters."""
    scores, start, size = [], 0, 0
    for i, text in enumerate(texts):
        if i > start and size + len(text) > most:
            scores.append(score_texts(field, texts[start:i]))
            start, size = i, 0
        size += len(text) + 1
    if start < len(texts):
        scores.append(score_texts(field, texts[start:]))
    return np.concatenate(scores) if scores else np.zeros(0)


def run_of_lines(doc_id: int, text: str, fit: Fit) -> str:
    """The text, or of a long one the consecutive whole lines within the bounds of ``fit``
    around a line chosen by the id; of a line that alone is too long, what fits."""
    lines = text.split("\n")
    if len(text) <= fit.most_chars and len(lines) <= fit.most_lines:
        return text
    low = zlib.crc32(str(doc_id).encode()) % len(lines)
    high, room = low + 1, fit.most_chars - len(lines[low])
    while high < len(lines) and high - low < fit.most_lines and len(lines[high]) < room:
        room -= len(lines[high]) + 1
        high += 1
    while low and high - low < fit.most_lines and len(lines[low - 1]) < room:
        low -= 1
        room -= len(lines[low]) + 1
    return "\n".join(lines[low:high])[: fit.most_chars]


def train(docs: DataFrame, labels: DataFrame, fit: Fit = Fit()) -> Field:
    """The field of the sampled labelled documents; the sample is bounded by ``fit``."""
    ship(docs.sparkSession)

    def bounded(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = [run_of_lines(i, t, fit) for i, t in zip(batch["doc_id"], batch["text"], strict=True)]
            yield batch.assign(text=texts)

    rows = (
        sample(docs, labels, "quality", fit.per_class)
        .mapInPandas(bounded, "doc_id long, label int, text string")
        .orderBy("doc_id", "text")
        .select("label", "text")
        .toPandas()
    )
    return fit_field(rows["text"].tolist(), rows["label"].tolist(), fit)


def score(docs: DataFrame, field: Field, keep: list[str] | None = None) -> DataFrame:
    """``keep`` (default doc_id) and ``score``, a row for each row of ``docs``.

    Null and empty texts are one empty line and get its score. Null ids and repeated rows
    stay; an empty table gives no rows. Only ``text`` is an input of the score.
    """
    ship(docs.sparkSession)
    keep = keep or ["doc_id"]
    schema = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep) + ", score double"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch[keep].assign(score=score_in_parts(field, batch["text"].fillna("").tolist()))

    return docs.select(*keep, text_or_empty().alias("text")).mapInPandas(run, schema)


def classify(docs: DataFrame, labels: DataFrame, fit: Fit = Fit()) -> DataFrame:
    """doc_id, held_out, score, predicted for every document."""
    scored = score(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), train(docs, labels, fit))
    return scored.select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


def keep_good(docs: DataFrame, labels: DataFrame, fit: Fit = Fit()) -> DataFrame:
    """The rows of ``docs`` whose text scores 0.5 or more, in the same columns.

    Equal texts have equal scores, so rows are judged one by one in their task.
    """
    ship(docs.sparkSession)
    field = train(docs, labels, fit)

    @F.pandas_udf("double")
    def chance(text: pd.Series) -> pd.Series:
        return pd.Series(score_in_parts(field, text.fillna("").tolist()))

    return docs.where(chance(text_or_empty()) >= 0.5)
