"""The pipeline's stages against brute force, on the smallest tables and on planted rows."""

from __future__ import annotations

import hashlib
import json

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline as pipeline
from strata.llm import quality, simhash
from strata.llm.common import table
from strata.llm.decontam import words_of

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def staged(spark):
    docs = table(spark, FOLDER, "documents").select(*pipeline.COLUMNS)
    rows = {"start": docs.collect()}
    for name, stage in pipeline.STAGES:
        docs = pipeline.written(stage(spark, docs, FOLDER), "test")
        rows[name] = docs.collect()
        if name != pipeline.STAGES[-1][0]:
            assert docs.columns == pipeline.COLUMNS
    return rows


def test_names_and_order(staged):
    assert [n for n, _ in pipeline.STAGES] == ["quality classifier", "SimHash near-dedup", "benchmark decontamination", "secret scan", "BPE encoding"]


def test_quality(spark, staged):
    model = quality.train(table(spark, FOLDER, "documents"), table(spark, FOLDER, "labels"))
    tokens = quality._Tokens()
    wanted = {r.doc_id for r in staged["start"] if model.score([r.text or ""], tokens)[0] >= quality.THRESHOLD}
    assert {r.doc_id for r in staged["quality classifier"]} == wanted
    labels = {r.doc_id: r.quality for r in table(spark, FOLDER, "labels").collect()}
    good = [i for i in labels if labels[i] == 1]
    assert len(wanted & set(good)) >= 0.97 * len(good)


def test_near_duplicates(staged):
    rows = staged["quality classifier"]
    prints = [simhash.fingerprint(r.text or "") for r in rows]
    root = list(range(len(rows)))
    order = sorted(root, key=lambda i: rows[i].doc_id)
    for i in order:
        for j in order:
            if (prints[i] ^ prints[j]).bit_count() <= 2:
                a, b = root[i], root[j]
                root = [min(a, b, key=lambda k: rows[k].doc_id) if r in (a, b) else r for r in root]
    assert {r.doc_id for r in staged["SimHash near-dedup"]} == {rows[k].doc_id for k in set(root)}


def test_benchmark(spark, staged):
    windows = set()
    for row in table(spark, FOLDER, "benchmark").collect():
        words = words_of(row.text or "")
        windows |= {tuple(words[i:i + 10]) for i in range(max(len(words) - 10, 0) + 1 if words else 0)}
    sizes = {len(w) for w in windows}
    wanted = set()
    for row in staged["SimHash near-dedup"]:
        words = words_of(row.text or "")
        if not any(tuple(words[i:i + n]) in windows for n in sizes for i in range(len(words) - n + 1)):
            wanted.add(row.doc_id)
    assert {r.doc_id for r in staged["benchmark decontamination"]} == wanted


def test_secrets(staged):
    before = {r.doc_id: r for r in staged["benchmark decontamination"]}
    after = {r.doc_id: r for r in staged["secret scan"]}
    assert before.keys() == after.keys()
    for key, row in after.items():
        if row.text != before[key].text:
            assert "[SECRET]" in row.text and row.n_chars == len(row.text)
        assert 'token = "' not in (row.text or "")


def test_tokens(staged):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    tokenizer.no_truncation()
    tokenizer.no_padding()
    texts = {r.doc_id: r.text for r in staged["secret scan"]}
    assert len(staged["BPE encoding"]) == len(texts)
    for row in staged["BPE encoding"]:
        ids = tokenizer.encode(texts[row.doc_id] or "", add_special_tokens=False).ids
        assert row.ids == ids and row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()


def test_run(spark, staged):
    got = pipeline.run(spark, FOLDER)
    assert sorted(json.dumps(r.asDict()) for r in got.collect()) == sorted(json.dumps(r.asDict()) for r in staged["BPE encoding"])


def test_keep_one_of_repeated_and_null_rows(spark):
    rows = [(5, "a b c", "x"), (5, "a b c", "y"), (7, "a b c", "x"), (None, "a b c", "x"), (5, "other text than that", "x"), (None, None, "n"), (None, "", "m"), (2, "z z z z", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n string")
    kept = sorted(map(tuple, simhash.keep_one(docs).collect()), key=str)
    assert (5, "a b c", "x") in kept and (2, "z z z z", "x") in kept and (5, "other text than that", "x") in kept
    assert len(kept) == 4


def test_keep_one_with_clashing_and_unordered_columns(spark):
    rows = [(1, "a b c", 9, {"k": 2}), (1, "a b c", 9, {"k": 1}), (4, "a b c", 9, {"k": 0}), (6, "w " * 60_000, 1, {})]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _id int, _hash map<string,int>").withColumnRenamed("_hash", "_Hash")
    kept = sorted(simhash.keep_one(docs).collect(), key=lambda r: r.doc_id)
    assert [tuple(r) for r in kept] == [rows[1], rows[3]]
