"""Quality classifier: hashed word n-gram logistic regression trained with follow-the-regularised-leader updates.

A text is a sequence of words, numbers and runs of signs. Its features are hashed n-grams of the lower-cased tokens
(one and two) and of their shapes (two and three; a shape says letters' case, digits or which signs, and whether the
token repeats the one before). A feature's value is its share of the text's tokens, so a score is a sparse dot product
that does not depend on length. Labels come from a bounded sample; scoring reads every whole text.

Nulls and empty texts have no features and get the score of the intercept. Repeated rows and ids are scored row by row.
An empty label table gives an untrained model (0.5 for every text).
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import held_out, labelled_sample, per_text, with_fields

BITS = 20
TOKEN = re.compile(r"[^\W\d_]+|\d+|[^\w\s]+|_+|\n")
#: Labelled documents that training reads at most.
SAMPLE = 6000
THRESHOLD = 0.7
_KEPT_TOKENS = 100_000
#: A text takes some 60 times its size while its n-grams are hashed.
_SLICE = 1 << 18
_MIX = np.uint64(0x9E3779B97F4A7C15)


def _shape(token: str) -> int:
    if token.isalpha():
        kind = "a" if token.islower() else "A" if len(token) > 1 and token.isupper() else "Aa" if token[1:].islower() else "aA"
        return zlib.crc32(kind.encode()) & 0xFFFF
    if token[0].isdigit():
        return 7
    return zlib.crc32(token[:4].encode()) & 0xFFFF


class _Tokens(dict):
    """Token to word hash (low 32 bits) and shape (above); forgets all when it holds too many."""

    def __missing__(self, token: str) -> int:
        if len(self) >= _KEPT_TOKENS:
            self.clear()
        value = zlib.crc32(token.lower().encode("utf-8", "replace")) | _shape(token) << 32
        self[token] = value
        return value


def _mixed(*parts: np.ndarray) -> np.ndarray:
    """Feature numbers below 2**BITS from columns of hashes."""
    h = np.zeros(len(parts[0]), np.uint64)
    for part in parts:
        h = (h ^ part) * _MIX
        h ^= h >> np.uint64(29)
    return (h >> np.uint64(64 - BITS)).astype(np.int32)


def features(texts: list[str], tokens: _Tokens) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Feature numbers of all n-grams, the text each belongs to, and the token count of each text."""
    found = [TOKEN.findall(text) for text in texts]
    counts = np.fromiter(map(len, found), np.int64, len(found))
    flat = np.fromiter((tokens[t] for some in found for t in some), np.uint64, int(counts.sum()))
    of = np.repeat(np.arange(len(found)), counts)
    word, shape = flat & np.uint64(0xFFFFFFFF), flat >> np.uint64(32)
    one = np.uint64(1)
    before = np.concatenate([[False], of[1:] == of[:-1]]) if len(of) else np.zeros(0, bool)
    two = before & np.concatenate([[False], before[:-1]]) if len(of) else before
    prev_w, prev_s = np.roll(word, 1), np.roll(shape, 1)
    same = ((word == prev_w) & before).astype(np.uint64)
    kinds = shape * np.uint64(2) + same
    prev_k = np.roll(kinds, 1)
    grams = [
        (_mixed(word + one), of),
        (_mixed(prev_w[before] + one, word[before]), of[before]),
        (_mixed(prev_k[before], kinds[before], np.full(before.sum(), 3, np.uint64)), of[before]),
        (_mixed(np.roll(kinds, 2)[two], prev_k[two], kinds[two]), of[two]),
    ]
    return np.concatenate([g for g, _ in grams]), np.concatenate([o for _, o in grams]), counts


@dataclass(frozen=True)
class Model:
    weights: np.ndarray
    bias: float
    #: Number of texts it was trained on.
    rows: int = 0

    def score(self, texts: list[str], tokens: _Tokens) -> np.ndarray:
        grams, of, counts = features(texts, tokens)
        total = np.bincount(of, self.weights[grams], len(texts))
        return 1 / (1 + np.exp(-np.clip(self.bias + total / np.maximum(counts, 1), -30, 30)))


def train_ftrl(rows: list[tuple[np.ndarray, np.ndarray, int]], epochs: int = 4, alpha: float = 2.0, beta: float = 1.0,
               l1: float = 0.02, l2: float = 0.01) -> Model:
    """Weights from (feature numbers, values, label) rows, one row at a time; both classes weigh the same."""
    z, n = np.zeros(1 << BITS), np.zeros(1 << BITS)
    ones = sum(label for _, _, label in rows)
    weigh = {1: len(rows) / (2 * max(ones, 1)), 0: len(rows) / (2 * max(len(rows) - ones, 1))}
    zb = nb = bias = 0.0

    def weights_at(index):
        zi = z[index]
        return np.where(np.abs(zi) <= l1, 0.0, -(zi - np.sign(zi) * l1) / ((beta + np.sqrt(n[index])) / alpha + l2))

    order = np.random.default_rng(7)
    for _ in range(epochs):
        for at in order.permutation(len(rows)):
            index, value, label = rows[at][0], rows[at][1].astype(float), rows[at][2]
            w = weights_at(index)
            p = 1 / (1 + np.exp(-np.clip(bias + w @ value, -30, 30)))
            error = (p - label) * weigh[label]
            g = error * value
            z[index] += g - (np.sqrt(n[index] + g * g) - np.sqrt(n[index])) / alpha * w
            n[index] += g * g
            zb += error - (np.sqrt(nb + error * error) - np.sqrt(nb)) / alpha * bias
            nb += error * error
            bias = -zb / ((beta + np.sqrt(nb)) / alpha)
    return Model(weights_at(np.arange(1 << BITS)).astype(np.float32), float(bias), len(rows))


def _counted():
    tokens = _Tokens()

    def work(texts):
        grams, of, counts = features(texts, tokens)
        out = []
        ends = np.searchsorted(np.sort(of, kind="stable"), np.arange(len(texts) + 1))
        grams = grams[np.argsort(of, kind="stable")]
        for i in range(len(texts)):
            index, times = np.unique(grams[ends[i]:ends[i + 1]], return_counts=True)
            out.append((index.astype("<i4").tobytes(), (times / max(counts[i], 1)).astype("<f4").tobytes()))
        return [pa.array([a for a, _ in out], pa.binary()), pa.array([b for _, b in out], pa.binary())]

    return work


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", sample: int = SAMPLE) -> Model:
    """A model from at most ``sample`` labelled documents that are not held out."""
    chosen = labelled_sample(docs, labels, label, sample).withColumn("h", F.xxhash64("text"))
    found = (
        chosen.withColumn("f", per_text("grams binary, share binary", _counted, _SLICE)("text"))
        .groupBy("doc_id").agg(F.min(F.struct("h", "label", "f")).alias("row"))
        .select("doc_id", "row.label", "row.f.grams", "row.f.share").toArrow().sort_by("doc_id").combine_chunks()
    )
    # The rows are views of the fetched table, which is the one copy of the sample that the driver holds.
    grams, shares, marks = (found[c].combine_chunks() for c in ("grams", "share", "label"))
    return train_ftrl([(np.frombuffer(grams[i].as_buffer(), "<i4"), np.frombuffer(shares[i].as_buffer(), "<f4"), int(marks[i].as_py() > 0)) for i in range(len(marks))])


def score(self, texts: list[str], tokens: _Tokens) -> np.ndarray:
        grams, of, counts = features(texts, tokens)
        total = np.bincount(of, self.weights[grams], len(texts))
        return 1 / (1 + np.exp(-np.clip(self.bias + total / np.maximum(counts, 1), -30, 30)))


def train_ftrl(rows: list[tuple[np.ndarray, np.ndarray, int]], epochs: int = 4, alpha: float = 2.0, beta: float = 1.0,
               l1: float = 0.02, l2: float = 0.01) -> Model:
    """Weights from (feature numbers, values, label) rows, one row at a time; both classes weigh the same."""
    z, n = np.zeros(1 << BITS), np.zeros(1 << BITS)
    ones = sum(label for _, _, label in rows)
    weigh = {1: len(rows) / (2 * max(ones, 1)), 0: len(rows) / (2 * max(len(rows) - ones, 1))}
    zb = nb = bias = 0.0

    def weights_at(index):
        zi = z[index]
        return np.where(np.abs(zi) <= l1, 0.0, -(zi - np.sign(zi) * l1) / ((beta + np.sqrt(n[index])) / alpha + l2))

    order = np.random.default_rng(7)
    for _ in range(epochs):
        for at in order.permutation(len(rows)):
            index, value, label = rows[at][0], rows[at][1].astype(float), rows[at][2]
            w = weights_at(index)
            p = 1 / (1 + np.exp(-np.clip(bias + w @ value, -30, 30)))
            error = (p - label) * weigh[label]
            g = error * value
            z[index] += g - (np.sqrt(n[index] + g * g) - np.sqrt(n[index])) / alpha * w
            n[index] += g * g
            zb += error - (np.sqrt(nb + error * error) - np.sqrt(nb)) / alpha * bias
            nb += error * error
            bias = -zb / ((beta + np.sqrt(nb)) / alpha)
    return Model(weights_at(np.arange(1 << BITS)).astype(np.float32), float(bias), len(rows))


def _counted():
    tokens = _Tokens()

    def work(texts):
        grams, of, counts = features(texts, tokens)
        out = []
        ends = np.searchsorted(np.sort(of, kind="stable"), np.arange(len(texts) + 1))
        grams = grams[np.argsort(of, kind="stable")]
        for i in range(len(texts)):
            index, times = np.unique(grams[ends[i]:ends[i + 1]], return_counts=True)
            out.append((index.astype("<i4").tobytes(), (times / max(counts[i], 1)).astype("<f4").tobytes()))
        return [pa.array([a for a, _ in out], pa.binary()), pa.array([b for _, b in out], pa.binary())]

    return work


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", sample: int = SAMPLE) -> Model:
    """A model from at most ``sample`` labelled documents that are not held out."""
    chosen = labelled_sample(docs, labels, label, sample).withColumn("h", F.xxhash64("text"))
    found = (
        chosen.withColumn("f", per_text("grams binary, share binary", _counted, _SLICE)("text"))
        .groupBy("doc_id").agg(F.min(F.struct("h", "label", "f")).alias("row"))
        .select("row.label", "row.f.grams", "row.f.share", "doc_id").collect()
    )
    found.sort(key=lambda r: r.doc_id)
    return train_ftrl([(np.frombuffer(r.grams, "<i4"), np.frombuffer(r.share, "<f4").astype(float), int(r.label > 0)) for r in found])


def score(docs: DataFrame, model: Model, threshold: float = THRESHOLD, text: str = "text") -> DataFrame:
    """``docs`` with ``score`` (0 to 1) and ``predicted`` (1 from ``threshold`` on)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        tokens = _Tokens()
        return lambda texts: [pa.array(shared.value.score(texts, tokens), pa.float64())]

    scored = with_fields(docs, per_text("score double", make, _SLICE)(F.col(text)), ["score"])
    return scored.drop("predicted").withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def judged(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted for every document."""
    scored = score(docs.select("doc_id", "text"), train(docs, labels))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")
