"""Quality and toxicity: held-out accuracy, odd rows, and what a score may depend on."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.llm import quality, toxicity
from strata.llm.common import held_out, labelled_sample, table

FOLDER = "/root/testdata/sf0.1"
CASES = {"quality": (quality, "quality", 0.99), "toxicity": (toxicity, "toxic", 0.96)}


def auc(scores, labels):
    ones, zeros = scores[labels == 1], scores[labels == 0]
    return np.mean([(ones > z).mean() + 0.5 * (ones == z).mean() for z in zeros])


@pytest.mark.parametrize("name", CASES)
def test_held_out(spark, name):
    module, label, least = CASES[name]
    docs, labels = table(spark, FOLDER, "documents"), table(spark, FOLDER, "labels")
    rows = module.judged(docs, labels).join(labels, "doc_id").where("held_out").toPandas()
    assert auc(rows.score.to_numpy(), rows[label].to_numpy()) >= least
    assert rows.score.between(0, 1).all()
    said, right = rows.predicted.to_numpy() == 1, rows[label].to_numpy() == 1
    assert (said & right).sum() >= 0.9 * right.sum()
    assert (said & ~right).sum() <= 0.05 * (~right).sum()


@pytest.mark.parametrize("name", CASES)
def test_odd_rows(spark, name):
    module, label, *_ = CASES[name]
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    labels = table(spark, "/root/testdata/sf0.001", "labels")
    odd = spark.createDataFrame([(None, "some text", "en"), (1, None, None), (1, "", "en"), (1, "word " * 50_000, "xx"), (2, "same", "en"), (2, "same", "de")], "doc_id long, text string, lang string")
    both = docs.select("doc_id", "text", "lang").unionByName(odd)
    got = module.judged(both, labels.unionByName(spark.createDataFrame([(None, 1, 1), (3, None, None), (2, 0, 0), (2, 1, 1)], labels.schema)))
    assert got.count() == docs.count() + 6
    assert got.where("score is null or score < 0 or score > 1 or predicted is null or held_out is null").count() == 0
    same = got.where("doc_id = 2").select("score").collect()
    assert same[-1] == same[-2]
    assert module.judged(docs.where(F.lit(False)), labels).count() == 0
    assert module.judged(docs, labels.where(F.lit(False))).count() == docs.count()


@pytest.mark.parametrize("name", CASES)
def test_clashing_columns(spark, name):
    module, *_ = CASES[name]
    model = quality.Model(np.zeros(1 << quality.BITS, np.float32), 0.0) if name == "quality" else toxicity.train_net([], np.zeros(0, np.int64), [])
    docs = spark.createDataFrame([(1, "x", "old", 7)], "doc_id long, text string, score string, predicted int")
    assert [tuple(r) for r in module.score(docs, model).collect()] == [(1, "x", 0.5, int(0.5 >= module.THRESHOLD))]


def test_no_label_leaks(spark):
    """Changing held-out labels, languages and sources changes no score."""
    docs, labels = table(spark, "/root/testdata/sf0.001", "documents"), table(spark, "/root/testdata/sf0.001", "labels")
    turned = labels.select("doc_id", *[F.when(held_out(F.col("doc_id")), 1 - F.col(c)).otherwise(F.col(c)).alias(c) for c in ("quality", "toxic")])
    other = docs.withColumn("lang", F.lit("zz")).withColumn("source", F.lit("s"))
    for module in (quality, toxicity):
        a = {r.doc_id: r.score for r in module.judged(docs, labels).collect()}
        assert a == {r.doc_id: r.score for r in module.judged(other, turned).collect()}


def test_sample_is_bounded(spark):
    docs, labels = table(spark, FOLDER, "documents"), table(spark, FOLDER, "labels")
    rows = labelled_sample(docs, labels, "quality", 20).collect()
    assert len({r.doc_id for r in rows}) == 20


def test_sparse_dot_product():
    """A score is the intercept and the sum of weights over the share of each n-gram."""
    rng = np.random.default_rng(1)
    model = quality.Model(rng.normal(0, 1, 1 << quality.BITS).astype(np.float32), 0.25)
    texts = ["one two two", "", "### a ###", "A\nB 12"]
    tokens = quality._Tokens()
    for text, score in zip(texts, model.score(texts, tokens)):
        grams, _, counts = quality.features([text], tokens)
        z = 0.25 + sum(float(model.weights[g]) for g in grams) / max(counts[0], 1)
        assert abs(score - 1 / (1 + np.exp(-z))) < 1e-6


def test_language_thresholds(spark):
    net = toxicity.train_net([[w, f"filler{i}"] for i in range(200) for w in ("good", "bad")], np.array([0, 1] * 200), ["en", "en", "de", "de"] * 100)
    docs = spark.createDataFrame([(1, "bad bad", "en"), (2, "good", "de"), (3, "bad", None), (4, "good", "xx")], "doc_id long, text string, lang string")
    got = {r.doc_id: (r.predicted, r.flagged) for r in toxicity.flagged(toxicity.score(docs, net), net).collect()}
    assert set(net.by_lang) == {"en", "de"}
    assert got == {1: (1, True), 2: (0, False), 3: (1, True), 4: (0, False)}
