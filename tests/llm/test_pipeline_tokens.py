"""The pipeline's last stage decodes what it encodes."""

from __future__ import annotations

import hashlib

import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline as pipeline


def test_decoded_digest(spark):
    texts = [None, "", "Plain words, and Ünïcode 漢字 42", "lower\n\nlines  <b>x</b>"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    rows = pipeline.encode_tokens(spark, docs, "").collect()
    assert len(rows) == len(texts)
    for row in rows:
        ids = tokenizer.encode(texts[row.doc_id] or "", add_special_tokens=False).ids
        assert row.ids == ids
        assert row.decoded_sha256 == hashlib.sha256(tokenizer.decode(ids, skip_special_tokens=False).encode()).hexdigest()
