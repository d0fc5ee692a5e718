"""Lexical search against plain scoring of every document."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import pytest

from strata.llm import lexical


def words(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lowered)


def plain(docs, items, top):
    found = [(i, Counter(words(t))) for i, t, *_ in docs]
    found = [(i, c, sum(c.values())) for i, c in found if c]
    n_docs, all_terms = len(found), sum(n for *_, n in found)
    df = Counter(t for _, c, _ in found for t in c)
    asked = {}
    for item, text, *_ in items:
        asked.setdefault(item, set()).update(words(text))
    out = []
    for item, terms in asked.items():
        scored = []
        for i, c, n in found:
            m = 100 - 50 + 50 * n * n_docs // all_terms
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 20 * m)) for t in terms if t in c)
            if score > 0:
                scored.append((-score, i is None, i or 0, i))
        scored.sort()
        out += [(item, rank, row[3], -row[0]) for rank, row in enumerate(scored[:top], 1)]
    return sorted(out, key=str)


def run(spark, docs, items, **options):
    left = spark.createDataFrame([(*d, 1, 2) for d in docs], "doc_id long, text string, item int, term int").repartition(3)
    right = spark.createDataFrame([(*i, 5) for i in items], "item_id string, text string, doc_id int")
    got = lexical.ranked(left, right, **options)
    assert dict(got.dtypes) == {"item_id": "string", "rank": "int", "doc_id": "bigint", "score": "bigint"}
    return sorted(map(tuple, got.collect()), key=str)


def corpus(seed, n):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(600)]
    draw = lambda k: " ".join(vocabulary[int(600 * rng.random() ** 3)] for _ in range(k))
    docs = [(i, draw(rng.randrange(1, 60))) for i in range(n)]
    docs += [(n + i, "same Text about w3 and w500, w500!") for i in range(n // 3)]
    docs += [(None, "w500 null id"), (7, "w500 again"), (7, "w500 again"), (n * 2, None), (n * 2 + 1, " .,-"), (n * 2 + 2, "w0 " * 40_000 + "W599 Äé_É9")]
    items = [(f"i{i}", draw(rng.randrange(1, 12))) for i in range(20)]
    items += [("common", "w0 w1 w2"), ("none", "absent"), ("empty", ""), ("null", None), (None, "w500 W500"), ("twice", "w3 w3"), ("twice", "w599 äé_É9"), ("rare", "w599 w500 w0 w1 w2 w3")]
    return docs, items


@pytest.mark.parametrize("options", [{"top": 5}, {"top": 5, "shard": 40, "bundle": 4}, {}])
def test_against_every_document(spark, options):
    docs, items = corpus(5, 300)
    assert run(spark, docs, items, **options) == plain(docs, items, options.get("top", lexical.TOP))


def test_few_documents_and_empty_tables(spark):
    docs, items = [(1, "a b"), (2, "b c"), (3, None)], [("x", "A c"), ("y", "b")]
    assert run(spark, docs, items) == plain(docs, items, 50)
    assert run(spark, [], items) == [] and run(spark, docs, []) == [] and run(spark, [(1, None)], items) == []
    assert run(spark, docs, [("z", "nothing here")]) == []


def test_every_bit_may_collide(spark, monkeypatch):
    """The bit table only spares work."""
    docs, items = corpus(8, 60)
    monkeypatch.setattr(lexical, "SLOTS", 8)
    assert run(spark, docs, items, top=3) == plain(docs, items, 3)
