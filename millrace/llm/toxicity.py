"""Toxicity from gradient-boosted trees over dense features, with isotonic calibration.

Features of a whole text: densities of lexicon words, plain, learned and disguised, how
near they stand to the second person, capitals, punctuation and disguise rates. The
lexicon is a short fixed list and word beginnings that labelled documents show to go with
toxic text. Lexicon, trees and calibration are learned from separate parts of a bounded
sample (``Fit``); scoring runs in tasks over all texts.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import compress

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import Memo, ship, text_or_empty
from millrace.llm.labelled import held_out, sample

# Common insults, and words that address the reader, in four languages.
INSULTS = frozenset(
    """
    idiot idiots loser losers pathetic scum worthless moron morons trash clown clowns disgusting stupid
    dumb jerk fool filth filthy garbage imbecile cretin vermin ugly liar coward freak hate
    dumm dummkopf trottel abschaum arschloch wertlos ekelhaft versager schwein
    crétin connard salaud ordure minable dégoûtant abruti raté
    estúpido imbécil basura asqueroso inútil escoria payaso cretino
    """.split()
)
SECOND_PERSON = frozenset(
    """
    you your yours yourself du dich dir dein deine ihr euch euer tu te toi ton ta tes vous votre vos
    tú ti usted ustedes tus vosotros
    """.split()
)
# Signs that stand in for letters in disguised words.
DISGUISE = str.maketrans("013457@$!|", "oieastasil")
BEGINNINGS = (4, 5, 6)
NEAR = 6  # words


@dataclass(frozen=True)
class Fit:
    """``per_class``: documents of either label learned from."""

    per_class: int = 3000
    rounds: int = 60
    depth: int = 3
    rate: float = 0.2
    beginnings: int = 400


@dataclass(frozen=True)
class Tree:
    feature: np.ndarray
    cut: np.ndarray
    value: np.ndarray
    depth: int

    def __call__(self, x: np.ndarray) -> np.ndarray:
        node = np.zeros(len(x), dtype=np.int64)
        rows = np.arange(len(x))
        for _ in range(self.depth):
            right = x[rows, self.feature[node]] > self.cut[node]
            node = 2 * node + 1 + right
        return self.value[node - (2**self.depth - 1)]


@dataclass(frozen=True)
class Model:
    learned: frozenset = frozenset()
    base: float = 0.0
    trees: list = field(default_factory=list)
    knots: tuple = (np.array([0.0]), np.array([0.5]))  # raw margins and calibrated chances

    def chance(self, features: np.ndarray) -> np.ndarray:
        margin = np.full(len(features), self.base)
        for tree in self.trees:
            margin += tree(features)
        return np.interp(margin, *self.knots)


_PLAIN, _THRICE, _EDGE = re.compile(r"\W+"), re.compile(r"(.)\1{2,}"), ".,;:?!'\"()-*_"
FIXED, LEARNED, DISGUISED, PERSON, CAPS, MARKED = 1, 2, 4, 8, 16, 32


def _kinds(word: str, learned: frozenset) -> int:
    """What a word is, as a sum of the kinds above."""
    edge = word.lower().strip(_EDGE)
    kinds = CAPS if len(word) > 2 and word.isupper() else 0
    bare = edge
    if not edge.isalpha() and edge:
        bare = _PLAIN.sub("", edge)
        plain = _PLAIN.sub("", edge.translate(DISGUISE)).replace("_", "")
        kinds |= MARKED | (DISGUISED if plain in INSULTS and edge != plain else 0)
    elif len(edge) > 4 and _THRICE.search(edge) and _THRICE.sub(r"\1", edge) in INSULTS:
        kinds |= DISGUISED
    if bare in INSULTS:
        kinds |= FIXED
    if bare[:4] in learned or bare[:5] in learned or bare[:6] in learned:
        kinds |= LEARNED
    if bare in SECOND_PERSON:
        kinds |= PERSON
    return kinds


FEATURES = 13


def text_features(texts: list[str], memo: Memo) -> np.ndarray:
    """Dense features, a row for each text. ``memo`` maps a word to its kinds."""
    out = np.zeros((len(texts), FEATURES))
    look = memo.__getitem__
    for k, text in enumerate(texts):
        words = text.split()
        n = len(words)
        if not n:
            continue
        kinds = bytes(map(look, words))
        row = out[k]
        row[0] = np.log1p(n)
        if any(kinds):
            found = np.frombuffer(kinds, dtype=np.uint8)
            bad = (found & (FIXED | LEARNED | DISGUISED)) > 0
            hits = int(bad.sum())
            row[1] = (found & FIXED > 0).sum() / n
            row[2] = (found & LEARNED > 0).sum() / n
            row[3] = (found & DISGUISED > 0).sum() / n
            row[4] = np.log1p(hits)
            row[5] = (found & PERSON > 0).sum() / n
            row[6] = (found & CAPS > 0).sum() / n
            row[7] = (found & MARKED > 0).sum() / n
            row[8] = hits / n
            if hits:
                person = np.flatnonzero(found & PERSON)
                at = np.flatnonzero(bad)
                if len(person):
                    next_ = np.searchsorted(person, at)
                    gap = np.minimum(
                        np.abs(at - person[np.minimum(next_, len(person) - 1)]),
                        np.abs(at - person[np.maximum(next_ - 1, 0)]),
                    )
                    row[9] = (gap <= NEAR).sum() / n
                row[10] = np.log1p(len(set(compress(words, bad))))
        row[11] = text.count("!") / n
        row[12] = (text.count("?") + text.count("*") + text.count("#")) / n
    return out


def count_beginnings(texts: list[str], label: np.ndarray) -> tuple[Counter, Counter]:
    """In how many toxic and in how many clean texts each word beginning occurs."""
    toxic, clean = Counter(), Counter()
    for text, y in zip(texts, label, strict=True):
        words = {w.strip(_EDGE) for w in text.lower().split()}
        (toxic if y else clean).update({w[:n] for w in words for n in BEGINNINGS if len(w) >= n})
    return toxic, clean


def learned_beginnings(toxic: Counter, clean: Counter, share: float, most: int) -> frozenset:
    """Word beginnings that go with toxic texts more than chance allows.

    With base rate p, a beginning in n texts of which a part a is toxic has a chance of at
    most exp(-n KL(a, p)); it must be small against the number of beginnings looked at.
    """
    p = min(max(share, 1e-3), 1 - 1e-3)
    need = np.log(len(toxic) + len(clean) + 1) + 4
    found = []
    for begin, a in toxic.items():
        n = a + clean[begin]
        q = min(a / n, 1 - 1e-9)
        if q < max(0.8, p):
            continue
        weight = n * (q * np.log(q / p) + (1 - q) * np.log((1 - q) / (1 - p)))
        if weight >= need:
            found.append((-weight, begin))
    return frozenset(b for _, b in sorted(found)[:most])


def grow(x: np.ndarray, y: np.ndarray, fit: Fit) -> tuple[float, list[Tree]]:
    """Boosted trees for the logistic loss, splits on up to 32 quantiles of a feature."""
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, 33)[1:-1])) for j in range(x.shape[1])]
    cuts = [np.unique(np.append(c, 1e-9)) for c in cuts]
    bins = np.column_stack([np.searchsorted(c, x[:, j], side="left") for j, c in enumerate(cuts)])
    width = max(len(c) for c in cuts) + 1
    p = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    base = float(np.log(p / (1 - p)))
    margin, trees = np.full(len(y), base), []
    inner = 2**fit.depth - 1
    for _ in range(fit.rounds):
        chance = 1 / (1 + np.exp(-margin))
        gradient, curve = y - chance, chance * (1 - chance)
        feature, cut = np.zeros(inner, dtype=np.int64), np.full(inner, np.inf)
        node = np.zeros(len(y), dtype=np.int64)
        for at in range(inner):
            own = np.flatnonzero(node == at)
            best = 1e-6
            g, h = gradient[own].sum(), curve[own].sum()
            for j, c in enumerate(cuts):
                gs = np.cumsum(np.bincount(bins[own, j], gradient[own], width))[: len(c)]
                hs = np.cumsum(np.bincount(bins[own, j], curve[own], width))[: len(c)]
                gain = gs**2 / (hs + 1) + (g - gs) ** 2 / (h - hs + 1) - g**2 / (h + 1)
                gain[(hs < 0.5) | (h - hs < 0.5)] = 0
                if len(gain) and gain.max() > best:
                    best, feature[at], cut[at] = gain.max(), j, c[int(gain.argmax())]
            node[own] = 2 * at + 1 + (x[own, feature[at]] > cut[at])
        leaf = node - inner
        g = np.bincount(leaf, gradient, 2**fit.depth)
        h = np.bincount(leaf, curve, 2**fit.depth)
        tree = Tree(feature, cut, fit.rate * g / (h + 1), fit.depth)
        margin += tree(x)
        trees.append(tree)
    return base, trees


def isotonic(margin: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Knots of the non-decreasing fit of ``y`` on ``margin`` (pooling adjacent violators).

    Two rows of weight 1/2, a clean one below and a toxic one above all margins, keep the ends off
    0 and 1 by as much as the sample is small.
    """
    order = np.argsort(margin, kind="stable")
    low, high = margin[order[0]], margin[order[-1]]
    m = np.concatenate([[low], margin[order], [high]])
    v = np.concatenate([[0.0], y[order], [1.0]])
    w = np.concatenate([[0.5], weight[order], [0.5]])
    pools: list[list[float]] = []  # value, weight, first and last margin
    for value, mass, at in zip(v, w, m, strict=True):
        pools.append([value, mass, at, at])
        while len(pools) > 1 and (pools[-2][0] >= pools[-1][0] or pools[-2][3] >= pools[-1][2]):
            b, a = pools.pop(), pools.pop()
            mass = a[1] + b[1]
            pools.append([(a[0] * a[1] + b[0] * b[1]) / mass, mass, a[2], b[3]])
    return np.array([x for p in pools for x in (p[2], p[3])]), np.array([p[0] for p in pools for _ in (0, 1)])


def fit_model(texts: list[str], labels: list[int], part: list[int], fit: Fit = Fit()) -> Model:
    """``part`` (0 to 4) deals the sample: 0, 1 for the lexicon, 2, 3 for the trees, 4 to calibrate.

    The lexicon is then learned once more from all parts. With labels of one kind, or
    none, every score is the share of toxic labels (none: 0.5).
    """
    y, of = np.array(labels, dtype=float), np.array(part)
    if not len(y) or y.min() == y.max():
        return Model(knots=(np.array([0.0]), np.array([float(y.mean()) if len(y) else 0.5])))
    lexicon, trees, last = of < 2, (of == 2) | (of == 3), of == 4
    if any(len(set(y[k])) < 2 for k in (lexicon, trees, last)):
        lexicon = trees = last = np.ones(len(y), dtype=bool)
    pick = lambda mask: list(compress(texts, mask))
    toxic, clean = count_beginnings(pick(lexicon), y[lexicon])
    first = learned_beginnings(toxic, clean, float(y[lexicon].mean()), fit.beginnings)
    x = text_features(texts, Memo(lambda word: _kinds(word, first)))
    base, grown = grow(x[trees], y[trees], fit)
    raw = np.full(int(last.sum()), base)
    for tree in grown:
        raw += tree(x[last])
    knots = isotonic(raw, y[last], np.ones(len(raw)))
    if not lexicon.all():
        more = count_beginnings(pick(~lexicon), y[~lexicon])
        toxic, clean = toxic + more[0], clean + more[1]
    return Model(learned_beginnings(toxic, clean, float(y.mean()), fit.beginnings), base, grown, knots)


def train(docs: DataFrame, labels: DataFrame, fit: Fit = Fit()) -> Model:
    rows = (
        sample(docs, labels, "toxic", fit.per_class)
        .withColumn("part", F.pmod(F.xxhash64("doc_id", F.lit("part")), F.lit(5)))
        .orderBy("doc_id", "text")
        .select("label", "part", "text")
        .toPandas()
    )
    return fit_model(rows["text"].tolist(), rows["label"].tolist(), rows["part"].tolist(), fit)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id and score, a row for each row of ``docs``.

    Null and empty texts have the score of a text without words. Null ids and repeated
    rows stay; an empty table gives no rows. Only ``text`` is an input of the score.
    """
    ship(docs.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        memo = Memo(lambda word: _kinds(word, model.learned))
        for batch in batches:
            chance = model.chance(text_features(batch["text"].tolist(), memo))
            yield pd.DataFrame({"doc_id": batch["doc_id"], "score": chance})

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text")).mapInPandas(
        run, "doc_id long, score double"
    )


def classify(docs: DataFrame, labels: DataFrame, fit: Fit = Fit(), threshold: float = 0.7) -> DataFrame:
    """doc_id, held_out, score, predicted for every document."""
    return score(docs, train(docs, labels, fit)).select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted")
    )
