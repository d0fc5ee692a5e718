"""Edit-aware token counts against encoding the edited text anew."""

from __future__ import annotations

import random
import re

import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from strata.llm import token_counts as tc

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def encoding():
    return tc.encoder(open(RANKS).read(), PATTERN)


PARTS = ["the", " ", "  ", "\n", "'", "'s", "'re", "ll", "é", "🙂", " ", "\x1c", "1", "23", "!", "...", "word", " word", "\t", "x" * 40, "中文", "́", "don't"]


def some_text(rng, most):
    return "".join(rng.choice(PARTS) for _ in range(rng.randrange(most)))


@pytest.mark.parametrize("leaf", [1, 5, 64])
def test_random_edits(encoding, leaf):
    rng = random.Random(leaf)
    for _ in range(1500):
        text = some_text(rng, 60)
        tree = tc.build(text, encoding, leaf)
        assert tree.total == len(encoding.encode_ordinary(text)), ascii(text)
        for _ in range(2):  # edits upon edits
            edits = []
            for _ in range(rng.randrange(4)):
                a = rng.randrange(len(text) + 1)
                edits.append({"start": a, "stop": min(len(text), a + rng.choice([0, 0, 1, 2, 10])), "text": some_text(rng, 4)})
            todo = tc.usable(edits, len(text))
            plain, at = "", 0
            for a, b, new in todo:
                plain, at = plain + text[at:a] + new, b
            plain += text[at:]
            before = text
            text, tree, _ = tc.edited(text, tree, todo, encoding, leaf)
            assert text == plain
            assert tree.total == len(encoding.encode_ordinary(plain)), (ascii(before), todo)
            assert tree.chars[1] == len(plain)
            again = tc.Tree(tree.chars[tree.width:tree.width + tree.leaves], tree.tokens[tree.width:tree.width + tree.leaves])
            assert (again.chars == tree.chars).all() and (again.tokens == tree.tokens).all()


def test_little_is_encoded_again(encoding):
    text = "some words of a long text " * 20_000
    tree = tc.build(text, encoding)
    new, tree, encoded = tc.edited(text, tree, [(250_000, 250_004, "other")], encoding)
    assert encoded < 3000 and tree.total == len(encoding.encode_ordinary(new))


def test_query_matches_plain_encoding(spark, encoding):
    texts = [None, "", "mail a.b@example.com and 1234567890, 12345", "x" * 5000 + " 999999999 " + "y z " * 3000, "1234567", "a@b.co 5555555555@c.de"]
    docs = spark.createDataFrame([*enumerate(texts), (2, texts[2]), (None, "z")], "doc_id long, text string")
    rows = tc.counted(docs, RANKS, PATTERN).collect()
    assert len(rows) == len(texts) + 2
    for row in rows:
        text = "z" if row.doc_id is None else texts[row.doc_id] or ""
        assert row.n_tokens == len(encoding.encode_ordinary(text))
        if row.doc_id == 2:
            assert row.n_tokens_edited == len(encoding.encode_ordinary("mail <mail> and 0, 12345"))
        if row.n_edits == 0:
            assert row.n_tokens_edited == row.n_tokens and row.encoded_chars == 0
    assert tc.counted(docs.where(F.lit(False)), RANKS, PATTERN).count() == 0


def test_documents(spark, encoding):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    got = {r.doc_id: r for r in tc.counted(docs, RANKS, PATTERN).collect()}
    for row in docs.select("doc_id", "text").collect():
        edits = [{"start": m.start(), "stop": m.end(), "text": "<mail>"} for m in re.finditer(r"[A-Za-z0-9._%+-]{1,64}@[A-Za-z0-9.-]{1,255}\.[A-Za-z]{2,24}", row.text)]
        edits += [{"start": m.start(), "stop": m.end(), "text": "0"} for m in re.finditer(r"[0-9]{6,}", row.text)]
        plain, at = "", 0
        for a, b, new in tc.usable(edits, len(row.text)):
            plain, at = plain + row.text[at:a] + new, b
        assert got[row.doc_id].n_tokens_edited == len(encoding.encode_ordinary(plain + row.text[at:]))


def test_edit_table_and_odd_edits(spark, encoding):
    docs = spark.createDataFrame([(1, "one two three", "k"), (2, None, "k"), (3, "left alone", "k")], "doc_id long, text string, chars string")
    edits = spark.createDataFrame([(1, 4, 7, "2"), (1, 5, 6, "over"), (1, None, 3, "x"), (1, 9, 8, "x"), (1, 13, 99, None), (2, 0, 5, "new text"), (9, 0, 0, "no document")], "doc_id long, start int, stop int, text string")
    trees = tc.with_trees(docs, RANKS, PATTERN)
    got = {r.doc_id: r for r in tc.apply_edits(tc.join_edits(trees, edits), RANKS, PATTERN).collect()}
    assert {k: (r.text, r.n_edits) for k, r in got.items()} == {1: ("one 2 three", 1), 2: ("new text", 1), 3: ("left alone", 0)}
    assert all(r.n_tokens == len(encoding.encode_ordinary(r.text)) for r in got.values())


def test_patterns_without_certain_cuts_are_refused(spark):
    tc.require_cuts(PATTERN)
    trailing = r"[^\s\p{L}\p{N}]+[\r\n]*|\p{L}+|\p{N}|\s+"  # signs take the line feeds that follow
    for pattern in (trailing, r"\p{L}+ ?|\S|\s"):
        with pytest.raises(ValueError, match="pre-tokens"):
            tc.require_cuts(pattern)
    docs = spark.createDataFrame([(1, "text")], "doc_id int, text string")
    with pytest.raises(ValueError, match="pre-tokens"):
        tc.with_trees(docs, RANKS, trailing)


def test_slices_by_bytes_keep_all_rows_in_order():
    texts = ["a" * 100, None, "", "b" * 5000, "c", *["d" * 30] * 40, "é" * 400]
    rows = pa.StructArray.from_arrays([pa.array(texts)], names=["text"])
    parts = list(tc._by_bytes(rows, 1000))
    assert [r["text"].as_py() for part in parts for r in part] == texts
    assert all(sum(len((r["text"].as_py() or "").encode()) + 64 for r in part) <= 1000 or len(part) == 1 for part in parts)
    assert list(tc._by_bytes(rows.slice(0, 0))) == []
