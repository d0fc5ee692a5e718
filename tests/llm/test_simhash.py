"""SimHash fingerprints, links and components against brute force."""

from __future__ import annotations

import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from strata.llm import simhash
from strata.llm.components import components


def plain_fingerprint(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_groups(values, distance=2):
    """Smallest index reachable over values within the distance."""
    root = list(range(len(values)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(values)):
        for j in range(i):
            if (values[i] ^ values[j]).bit_count() <= distance:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(values))]


@pytest.mark.parametrize("text", [None, "", " \t\n\x0b", "one", "One two", "a b c", "É a B c d\x1ce \xa0 f", "x " * 50, "w" * 3000 + " tail of it"])
def test_fingerprint(text):
    assert simhash.fingerprint(text or "") == plain_fingerprint(text)


def test_long_text_in_parts():
    text = " ".join(random.Random(1).choice("abcdefgh") for _ in range(40000))
    assert simhash.fingerprint(text) == plain_fingerprint(text)


def check(spark, values, bucket):
    rows = [(v - (1 << 64) if v >> 63 else v,) for v in values]
    distinct = spark.createDataFrame(rows, "fp long").repartition(3)
    n, both = simhash.joint_counts(distinct)
    assert n == len(values)
    found = simhash.plan(n, both)
    edges = simhash.links(distinct, found.masks(), bucket=bucket)
    roots = {r.v % (1 << 64): r.root for r in components(edges).where("node.r = 0").select("node.v", "root").collect()}
    plain = plain_groups(values)
    groups = {}
    for value, group in zip(values, plain):
        groups.setdefault(group, set()).add(roots.get(value, value))
    assert all(len(g) == 1 for g in groups.values())
    assert len({str(next(iter(g))) for g in groups.values()}) == len(groups)


def clustered(seed, centres, members, flips):
    rng, values = random.Random(seed), set()
    for _ in range(centres):
        centre = rng.getrandbits(64)
        for _ in range(members):
            value = centre
            for bit in rng.sample(range(64), rng.randint(0, flips)):
                value ^= 1 << bit
            values.add(value)
    return sorted(values)


@pytest.mark.parametrize("bucket", [2, 64])
def test_links_match_all_pairs(spark, bucket):
    check(spark, clustered(3, 12, 25, 4), bucket)


def test_planning_covers_every_distance():
    rng = np.random.default_rng(5)
    for n in (2, 1000, 10**9):
        share = rng.uniform(0.1, 0.9, 64)
        both = np.outer(share, share) * n
        np.fill_diagonal(both, share * n)
        found = simhash.plan(n, both.astype(np.int64))
        assert sum(found.thresholds) == 2 - len(found.parts) + 1
        assert sorted(b for part in found.parts for b in part) == list(range(64))
        masks = found.masks()
        for _ in range(300):
            flipped = sum(1 << int(b) for b in rng.choice(64, 2, replace=False))
            assert any(flipped & mask == 0 for mask in masks)


def test_documents(spark):
    rng = random.Random(11)
    base = [" ".join(f"w{rng.randrange(400)}" for _ in range(120)) for _ in range(12)]
    texts = [None, "", "one", "One", "one two"]
    for text in base:
        words = text.split()
        for _ in range(4):
            copy = list(words)
            copy[rng.randrange(len(copy))] = "changed"
            texts.append(" ".join(copy))
        texts += [text, text.upper()]
    docs = spark.createDataFrame([(i * 3, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, fp string")
    prints = [plain_fingerprint(t) for t in texts]
    groups = plain_groups(prints)
    found = {r.doc_id: r for r in simhash.near_duplicates(docs).collect()}
    assert {i * 3: (f"{p:016x}", g * 3) for i, (p, g) in enumerate(zip(prints, groups))} == {k: (r.fingerprint, r.component_id) for k, r in found.items()}


def test_nulls_repeats_and_empty(spark):
    docs = spark.createDataFrame([(None, "a b c"), (7, "a b c"), (7, "a b c"), (3, "q r s t"), (None, "lone text here now")], "doc_id long, text string")
    rows = [(r.doc_id, r.component_id) for r in simhash.near_duplicates(docs).collect()]
    assert sorted(rows, key=str) == sorted([(None, 7), (7, 7), (7, 7), (3, 3), (None, None)], key=str)
    assert simhash.near_duplicates(docs.where(F.lit(False))).count() == 0
