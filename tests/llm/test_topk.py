"""Exact top-k search against all distances."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from strata.llm import topk


def vector(code):
    return [1.0 if code >> (63 - b) & 1 else -0.5 for b in range(64)]


def plain(items, queries, k):
    items, out = sorted(set(items)), {}
    for qi, qc in sorted(set(queries)):
        ranked = sorted(((qc ^ c).bit_count(), i) for i, c in items if (i, c) != (qi, qc))
        out.setdefault(qi, []).extend((n + 1, i, d) for n, (d, i) in enumerate(ranked[:k]))
    return {q: sorted(v) for q, v in out.items()}


def found(df):
    out = {}
    for r in df.collect():
        out.setdefault(r.query_id, []).append((r["rank"], r.neighbour_id, r.distance))
    return {q: sorted(v) for q, v in out.items()}


@pytest.mark.parametrize("kind", ["random", "clustered", "copies", "tiny"])
def test_search(spark, kind):
    rng = random.Random(kind)
    centres = [rng.getrandbits(64) for _ in range(5)]
    if kind == "random":
        codes = [rng.getrandbits(64) for _ in range(300)]
    elif kind == "clustered":
        codes = [rng.choice(centres) ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(6))) for _ in range(300)]
    elif kind == "copies":
        codes = [rng.choice(centres[:2] + [rng.getrandbits(64)]) for _ in range(300)]
    else:
        codes = centres[:3]
    items = list(enumerate(codes))
    df = spark.createDataFrame([(i, vector(c)) for i, c in items], "vec_id long, embedding array<float>").repartition(3)
    got = found(topk.search(df, df.where("vec_id % 20 = 0"), k=4))
    assert got == plain(items, [x for x in items if x[0] % 20 == 0], 4)


def test_odd_rows(spark):
    rows = [(0, vector(0)), (0, vector(0)), (1, vector(1)), (2, None), (3, [1.0]), (None, vector(1)), (20, vector(3)), (4, [None] * 64), (0, vector(7))]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("code", F.lit("clash"))
    items = [(0, 0), (1, 1), (20, 3), (4, 0), (0, 7)]
    assert found(topk.searched(df)) == plain(items, [(0, 0), (20, 3), (0, 7)], 10)
    assert topk.searched(df.where(F.lit(False))).count() == 0


def test_wide_segments_leave_the_plan_small(spark, monkeypatch):
    """As with millions of codes: the keys at a radius are rows, not expressions that the driver holds."""
    rng, sizes, write = random.Random(3), [], topk.written
    monkeypatch.setattr(topk, "_segments", lambda n, bits: [(0, 21), (21, 22), (43, 21)])
    monkeypatch.setattr(topk, "written", lambda df, purpose: sizes.append(len(df._jdf.queryExecution().logical().toJSON())) or write(df, purpose))
    centre = rng.getrandbits(64)
    codes = [centre ^ sum(1 << b for b in rng.sample(range(64), 5)) for _ in range(60)]
    items = list(enumerate(codes))
    df = spark.createDataFrame([(i, vector(c)) for i, c in items], "vec_id long, embedding array<float>").repartition(3)
    asked = df.where("vec_id % 20 = 0")
    assert found(topk.search(df, asked, k=8)) == plain(items, [x for x in items if x[0] % 20 == 0], 8)
    assert max(sizes) < 200_000
