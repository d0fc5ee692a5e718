"""Toxicity: a convolutional text classifier over hashed word embeddings, trained in numpy.

A word's embedding is the mean of hashed vectors of the word, its beginnings and its endings, so that unseen forms of
a known stem are placed near it. Filters of several widths run over the word sequence; each filter keeps its largest
response in the whole text and a logistic layer judges these. Training reads a bounded sample of labelled documents; a
part of the sample that the weights do not see calibrates the score (so that ``THRESHOLD`` is the best cut) and one
threshold per language. The language is never an input of a score.

Nulls, empty texts and texts without words get the score of a text of padding alone. Repeated rows and ids are scored
row by row. Without labels of both classes the model is untrained and every text scores alike.
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import held_out, labelled_sample, per_text, with_fields

WORD = re.compile(r"[^\W\d_]+")
BUCKETS = 1 << 20
SIZE = 12
WIDTHS = (1, 2, 3)
_MARGIN = max(WIDTHS)
FILTERS = 12
#: Labelled documents that training reads at most.
SAMPLE = 6000
THRESHOLD = 0.3
_STARTS, _ENDS = (3, 4, 5, 6, 7, 8), (4, 6, 8)
_KEPT_WORDS = 300_000
#: A bucket has a vector if it occurs in so many training documents and its share of the toxic ones differs from its
#: share of the others by so many standard errors; all else in a text is alike to the filters.
_LEAST, _APART = 8, 5.0


def parts_of(word: str) -> list[int]:
    """Hash buckets of a lower-cased word, its beginnings and its endings."""
    size = len(word)
    names = [f"<{word}>"] + [f"<{word[:n]}" for n in _STARTS if size > n] + [f"{word[-n:]}>" for n in _ENDS if size > n]
    return [zlib.crc32(name.encode("utf-8", "replace")) % BUCKETS for name in names]


class _Words(dict):
    """Word to number of its set of known buckets. Set 0 is empty: the filters see such words as alike."""

    def __init__(self, known: dict[int, int]):
        super().__init__()
        self.known = known
        self.sets: dict[tuple[int, ...], int] = {(): 0}

    def __missing__(self, word: str) -> int:
        if len(self) >= _KEPT_WORDS:
            self.clear()
        rows = tuple(self.known[p] for p in parts_of(word) if p in self.known)
        self[word] = at = self.sets.setdefault(rows, len(self.sets))
        return at

    def sequence(self, words: list[str]) -> np.ndarray:
        """Set numbers of a text with margins of zeros; longer runs of zeros are cut to what windows can tell apart."""
        ids = np.fromiter(map(self.__getitem__, words), np.int32, len(words))
        near = np.zeros(len(ids) + 2 * _MARGIN, bool)
        at = np.flatnonzero(ids)
        for k in range(2 * _MARGIN + 1):
            near[at + k] = True
        near[:_MARGIN] = near[len(near) - _MARGIN:] = True
        return np.concatenate([np.zeros(_MARGIN, np.int32), ids, np.zeros(_MARGIN, np.int32)])[near]


@dataclass
class Net:
    known: dict[int, int]  # bucket to row of ``embed``
    embed: np.ndarray
    filters: list[np.ndarray]  # per width: (width * SIZE, FILTERS)
    shift: list[np.ndarray]
    out: np.ndarray
    bias: float
    scale: tuple[float, float] = (1.0, 0.0)
    by_lang: dict[str, float] = field(default_factory=dict)

    def vectors(self, sets: list[tuple[int, ...]]) -> np.ndarray:
        return np.array([self.embed[list(rows)].mean(0) if rows else np.zeros(SIZE, np.float32) for rows in sets], np.float32)

    def pooled(self, vectors: np.ndarray, ids: np.ndarray):
        """Largest response of every filter over one text and the place of it."""
        rows = vectors[ids]
        best, place = [], []
        for width, weights, shift in zip(WIDTHS, self.filters, self.shift):
            n = len(ids) - width + 1
            got = rows[:n] @ weights[:SIZE]
            for k in range(1, width):
                got += rows[k:k + n] @ weights[k * SIZE:(k + 1) * SIZE]
            at = got.argmax(0)
            best.append(np.maximum(got[at, np.arange(FILTERS)] + shift, 0))
            place.append(at)
        return np.concatenate(best), place

    def raw(self, vectors: np.ndarray, ids: np.ndarray) -> float:
        return float(self.bias + self.pooled(vectors, ids)[0] @ self.out)

    def calibrated(self, raw: np.ndarray) -> np.ndarray:
        a, b = self.scale
        return 1 / (1 + np.exp(-np.clip(a * raw + b, -30, 30)))


def train_net(texts: list[list[str]], labels: np.ndarray, langs: list[str], epochs: int = 6, seed: int = 5) -> Net:
    """Adagrad over single documents in random order; the largest responses alone carry gradients."""
    rng = np.random.default_rng(seed)
    fold = rng.random(len(texts)) < 0.2
    known, apart = _telling([w for w, held in zip(texts, fold) if not held], labels[~fold])
    net = Net(
        {int(b): i for i, b in enumerate(known)}, rng.normal(0, 0.1, (len(known), SIZE)).astype(np.float32),
        [rng.normal(0, 0.4, (w * SIZE, FILTERS)).astype(np.float32) for w in WIDTHS],
        [np.zeros(FILTERS, np.float32) for _ in WIDTHS],
        rng.normal(0, 0.2, len(WIDTHS) * FILTERS).astype(np.float32), 0.0,
    )
    net.embed[:, 0] = np.clip(apart / 5, -3, 3)
    if len(labels) < 2 or labels.min() == labels.max():
        net.out[:] = 0
        return net
    index = _Words(net.known)
    docs = [index.sequence(words) for words in texts]
    sets = list(index.sets)
    train = np.flatnonzero(~fold)
    share = max(labels[train].mean(), 1e-3)
    weigh = {1: min(0.5 / share, 5.0), 0: 0.5 / max(1 - share, 1e-3)}
    sums = [np.full_like(net.embed, 1e-2), [np.full_like(f, 1e-2) for f in net.filters], [np.full_like(s, 1e-2) for s in net.shift], np.full_like(net.out, 1e-2), 1e-2]
    rate = 0.05

    def step(weights, total, at, grad, lr):
        total[at] += grad * grad
        weights[at] -= lr * grad / np.sqrt(total[at])

    for epoch in range(epochs):
        lr = rate / (1 + 0.5 * epoch)
        for d in rng.permutation(train):
            words, ids = np.unique(docs[d], return_inverse=True)
            vectors = net.vectors([sets[w] for w in words])
            pooled, place = net.pooled(vectors, ids)
            p = 1 / (1 + np.exp(-np.clip(net.bias + pooled @ net.out, -30, 30)))
            g = float((p - labels[d]) * weigh[int(labels[d])])
            if abs(g) < 1e-3:
                continue
            back = np.where(pooled > 0, g * net.out, 0).reshape(len(WIDTHS), FILTERS)
            grad_words = np.zeros_like(vectors)
            for i, width in enumerate(WIDTHS):
                spots = ids[place[i][:, None] + np.arange(width)]  # FILTERS x width
                seen = vectors[spots].reshape(FILTERS, -1)
                grad_f = (back[i][:, None] * seen).T
                np.add.at(grad_words, spots, back[i][:, None, None] * net.filters[i].T.reshape(FILTERS, width, SIZE))
                step(net.filters[i], sums[1][i], slice(None), grad_f, lr)
                step(net.shift[i], sums[2][i], slice(None), back[i], lr)
            step(net.out, sums[3], slice(None), g * pooled + 1e-4 * net.out, lr)
            sums[4] += g * g
            net.bias -= lr * g / np.sqrt(sums[4])
            for w, grad in zip(words, grad_words):
                if rows := list(sets[w]):
                    step(net.embed, sums[0], rows, np.broadcast_to(grad / len(rows), (len(rows), SIZE)), lr)
    table = net.vectors(sets)
    test = np.flatnonzero(fold)
    raw = np.array([net.raw(table, docs[d]) for d in test])
    net.scale = _calibration(raw, labels[test])
    scores = net.calibrated(raw)
    for lang in sorted({langs[d] for d in test}):
        own = np.array([langs[d] == lang for d in test])
        net.by_lang[lang] = _best_cut(scores[own], labels[test][own], THRESHOLD)
    return net


def _telling(texts: list[list[str]], labels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets that tell the classes apart and by how many standard errors; equal texts count once."""
    times, n, seen = np.zeros((2, BUCKETS)), np.zeros(2), set()
    for words, label in zip(texts, labels):
        some = frozenset(words)
        if some not in seen:
            seen.add(some)
            times[label, list({p for w in some for p in parts_of(w)})] += 1
            n[label] += 1
    n = np.maximum(n, 1)
    share = times.sum(0) / n.sum()
    apart = (times[1] / n[1] - times[0] / n[0]) / np.sqrt(np.maximum(share * (1 - share), 1e-9) * (1 / n[0] + 1 / n[1]))
    known = np.flatnonzero((times.sum(0) >= _LEAST) & (np.abs(apart) >= _APART))
    return known, apart[known]


def _best_cut(scores: np.ndarray, labels: np.ndarray, default: float) -> float:
    """The cut with the best F1, in the middle of the gap it lies in; ``default`` when a class is missing."""
    if len(labels) < 2 or labels.min() == labels.max():
        return default
    order = np.argsort(-scores, kind="stable")
    s, hits = scores[order], np.cumsum(labels[order])
    ends = np.append(s[1:] != s[:-1], True)
    f1 = np.where(ends, 2 * hits / (np.arange(1, len(s) + 1) + labels.sum()), -1)
    best = int(f1.argmax())
    return float((s[best] + s[best + 1]) / 2 if best + 1 < len(s) else s[best] - 1e-6)


def _calibration(raw: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and shift of a logistic curve that follows the labels and meets ``THRESHOLD`` at the best cut."""
    if len(labels) < 2 or labels.min() == labels.max():
        return 1.0, 0.0
    if np.ptp(raw) < 1e-9:  # nothing tells the classes apart: the score is their share
        return 1.0, float(np.log(labels.mean() / (1 - labels.mean())) - raw[0])
    cut = _best_cut(raw, labels, 0.0)
    spread = max(float(np.std(raw)), 1e-6)
    slopes = np.geomspace(0.3, 10, 40) / spread
    goal = np.log(THRESHOLD / (1 - THRESHOLD))
    loss = [np.logaddexp(0, np.where(labels > 0, -1, 1) * np.clip(a * (raw - cut) + goal, -30, 30)).mean() for a in slopes]
    a = float(slopes[int(np.argmin(loss))])
    return a, goal - a * cut


class Scorer:
    """Scores slices of texts; keeps the sets of the words met so far, up to a bound."""

    def __init__(self, net: Net):
        self.net, self.words, self.vectors = net, _Words(net.known), net.vectors([()])

    def __call__(self, texts: list[str]) -> np.ndarray:
        docs = [self.words.sequence(WORD.findall(text.lower())) for text in texts]
        sets = self.words.sets
        if len(sets) > len(self.vectors):
            self.vectors = np.concatenate([self.vectors, self.net.vectors(list(sets)[len(self.vectors):])])
        return self.net.calibrated(np.array([self.net.raw(self.vectors, ids) for ids in docs]))


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", sample: int = SAMPLE) -> Net:
    """A model from at most ``sample`` labelled documents that are not held out."""
    rows = labelled_sample(docs, labels, label, sample, ("lang",))
    first = F.min(F.struct("text", F.coalesce("lang", F.lit("")).alias("lang"), "label")).alias("row")
    found = rows.groupBy("doc_id").agg(first).select("doc_id", "row.*").collect()
    found.sort(key=lambda r: r.doc_id)
    return train_net([WORD.findall(r.text.lower()) for r in found], np.array([int(r.label > 0) for r in found], np.int64), [r.lang for r in found])


def score(docs: DataFrame, net: Net, threshold: float = THRESHOLD, text: str = "text") -> DataFrame:
    """``docs`` with ``score`` (0 to 1) and ``predicted`` (1 from ``threshold`` on)."""
    shared = docs.sparkSession.sparkContext.broadcast(net)

    def make():
        scorer = Scorer(shared.value)
        return lambda texts: [pa.array(scorer(texts).astype(float), pa.float64())]

    scored = with_fields(docs, per_text("score double", make)(F.col(text)), ["score"])
    return scored.drop("predicted").withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def flagged(scored: DataFrame, net: Net, lang: str = "lang") -> DataFrame:
    """``flagged``: the score reaches the threshold calibrated for the row's language, else the common one."""
    cuts = F.create_map(*[F.lit(x) for pair in net.by_lang.items() for x in pair]) if net.by_lang else F.create_map().cast("map<string,double>")
    cut = F.coalesce(F.try_element_at(cuts, F.coalesce(F.col(lang), F.lit(""))), F.lit(THRESHOLD))
    return scored.withColumn("flagged", F.col("score") >= cut)


def judged(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted and the verdict by language (flagged) for every document."""
    net = train(docs, labels)
    scored = flagged(score(docs.select("doc_id", "text", "lang"), net), net)
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted", "flagged")
