"""The conversation trie against a plain trie, and the tree contraction against plain sums."""

from __future__ import annotations

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from strata.llm import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string"


def plain_trie(rows):
    original = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            original.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    original = {c: [t[2:] for t in sorted(turns)] for c, turns in original.items()}
    members, ends = {}, {}
    for conv in sorted(original):
        h = zlib.crc32(str(conv).encode()) % 6
        base = conv - (abs(conv) % 100) * (1 if conv >= 0 else -1)
        full = original.get(base, [])[:h] + original[conv][h:]
        for d in range(len(full) + 1):
            members.setdefault(tuple(full[:d]), []).append(conv)
        ends.setdefault(tuple(full), []).append(conv)
    children = {}
    for node in members:
        if node:
            children.setdefault(node[:-1], []).append(node)

    found = {}
    for node in sorted(members, key=len, reverse=True):
        below = [found[c] for c in children.get(node, [])]
        saved = (len(members[node]) - 1) * len(node[-1][1]) if node else 0
        found[node] = (sum(b[0] for b in below) or 1, saved + sum(b[1] for b in below))
    return sorted((
        members[n][0], len(n), members[n[:-1]][0] if n else -1, len(members[n]), len(children.get(n, [])), *found[n],
        hashlib.sha256(",".join(map(str, ends.get(n, []))).encode()).hexdigest()) for n in members)


def got(df):
    return sorted((r.conv_id, r.depth, -1 if r.parent_conv_id is None else r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens, r.ends_sha256) for r in df.collect())


def test_rows_of_every_kind(spark):
    rng = random.Random(4)
    rows = [(None, 1, "user", "x"), (7, None, None, None), (7, None, None, None), (7, 3, "a", "tie"), (7, 3, "a", "Tie"), (-105, 1, "u", "negative"), (-100, 0, "u", "base")]
    for conv in [*range(200, 240), *range(301, 330), 1000, 1001, 1002]:
        for turn in range(rng.randrange(0, 9)):
            rows.append((conv, turn, rng.choice(["user", "assistant", None]), rng.choice(["a", "b", None, "long é" * 50])))
    rows += [(5000 + i, t, "u", f"t{t}") for i in range(300) for t in range(7)]
    rows += [(6001, t, "u", "deep" if t % 2 else None) for t in range(700)]
    rows += [(6002, 1, "u", "w" * 300_000)] * 2
    rng.shuffle(rows)
    docs = spark.createDataFrame([(*r, 1) for r in rows], SCHEMA + ", depth int").repartition(3)
    assert got(prefix_trie.trie(docs)) == plain_trie(rows)


def test_small_ranges(spark):
    rows = [(c, t, "u", str(t * c % 3)) for c in (100, 101, 102, 150, 177) for t in range(40)]
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        assert got(prefix_trie.trie(spark.createDataFrame(rows, SCHEMA))) == plain_trie(rows)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_empty(spark):
    assert prefix_trie.trie(spark.createDataFrame([], SCHEMA)).collect() == []


@pytest.mark.parametrize("shape", ["path", "star", "random", "caterpillar"])
def test_contraction(spark, shape):
    rng, n = random.Random(shape), 400
    parent = {"path": lambda i: i - 1, "star": lambda i: 0, "random": lambda i: rng.randrange(i), "caterpillar": lambda i: i - 1 if i % 2 else max(i - 2, 0)}[shape]
    up = [None] + [parent(i) for i in range(1, n)]
    own = [rng.randrange(100) for _ in range(n)]
    total = list(own)
    for i in range(n - 1, 0, -1):
        total[up[i]] += total[i]
    nodes = spark.createDataFrame([(i, up[i], own[i]) for i in range(n)], "id long, parent long, x long")
    found = {r.id: r.x for r in prefix_trie.subtree_totals(nodes, ("x",)).collect()}
    assert found == dict(enumerate(total))
    assert prefix_trie.subtree_totals(nodes.where(F.lit(False)), ("x",)).collect() == []
