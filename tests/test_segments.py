"""The segmented index against a fresh index over the same chunks."""

from __future__ import annotations

import os
import random

import pytest

from strata.operators import retrieval
from strata.operators.segments import SegmentedIndex
from strata.settings import Settings
from strata.sources.tables import Store

CHUNK = "doc_id int, chunk_id string, text string"


def files(root):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(root) for f in names
            if "_manifest" not in d}


def hits(index, queries):
    found = retrieval.search(index, queries, 4).collect()
    return sorted((r.query_id, r["rank"], r.doc_id, r.chunk_id, r.text, round(r.score, 3)) for r in found)


def test_updates_equal_a_fresh_index(spark, tmp_path):
    rng = random.Random(5)
    words = ["everywhere"] * 10 + [f"w{i}" for i in range(25)]
    text = lambda: " ".join(rng.choice(words) for _ in range(rng.randrange(2, 12)))
    queries = spark.createDataFrame([(i, text()) for i in range(6)], "query_id int, text string")
    index = SegmentedIndex(Store(spark, Settings(root=str(tmp_path))), "t", ["the"], fanout=3)
    living: dict[int, list[str]] = {}
    merged = False
    for step in range(5):
        new = {d: [text() for _ in range(rng.randrange(1, 3))] for d in rng.sample(range(14), 7)}
        gone = rng.sample(range(16), 3)  # some are new, some unknown
        before = files(tmp_path)
        rows = [(d, f"{d}#{i}", t) for d, ts in new.items() for i, t in enumerate(ts)]
        index.update(spark.createDataFrame(rows, CHUNK) if step != 2 else None, spark.createDataFrame([(d,) for d in gone], "doc_id int"))
        after = files(tmp_path)
        assert all(after[f] == at for f, at in before.items())  # no earlier table is touched
        living = {d: ts for d, ts in living.items() if d not in gone}
        if step != 2:
            living |= new
        state = index._state()
        assert state.total == sum(map(len, living.values()))
        merged |= len(state.segments) < step + 1
        if step in (2, 4):
            chunks = spark.createDataFrame([(d, f"{d}#{i}", t) for d, ts in living.items() for i, t in enumerate(ts)], CHUNK)
            assert hits(index.current(), queries) == hits(retrieval.tfidf_index(chunks, ["the"]), queries)
            assert index._state().ready
    assert merged
    wanted = hits(index.current(), queries)
    index.vacuum()
    assert hits(index.current(), queries) == wanted
    left = {name.split("_")[1] for name in os.listdir(tmp_path / "index") if name.startswith("t_s")}
    assert left == {f"s{s.id}" for s in index._state().segments}


def test_an_update_that_died_leaves_no_trace(spark, tmp_path, monkeypatch):
    index = SegmentedIndex(Store(spark, Settings(root=str(tmp_path))), "t", [])
    index.update(spark.createDataFrame([(1, "1#0", "old words"), (2, "2#0", "other words")], CHUNK))
    monkeypatch.setattr(index, "_commit", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        index.update(spark.createDataFrame([(1, "1#0", "half done")], CHUNK))
    monkeypatch.undo()
    asked = spark.createDataFrame([(1, "old half new")], "query_id int, text string")
    assert [h[3:5] for h in hits(index.current(), asked)] == [("1#0", "old words")]
    index.update(spark.createDataFrame([(1, "1#0", "new")], CHUNK))
    assert [h[3:5] for h in hits(index.current(), asked)] == [("1#0", "new")]


def test_an_index_without_chunks_is_an_error(spark, tmp_path):
    index = SegmentedIndex(Store(spark, Settings(root=str(tmp_path))), "t")
    with pytest.raises(ValueError, match="no chunks"):
        index.current()
    index.update(spark.createDataFrame([(1, "1#0", "a word"), (None, "n#0", None)], CHUNK))
    index.update(gone=spark.createDataFrame([(1,), (None,)], "doc_id int"))
    assert index._state().total == 1
