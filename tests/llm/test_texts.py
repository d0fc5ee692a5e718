"""Decontamination, BPE and URL filters against brute force."""

from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from strata.llm import bpe, decontam, url_filter
from strata.llm.common import table

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def plain_words(text):
    return WORD.findall((text or "").translate(LOWER))


def plain_hits(text, items, size):
    words, hit, names = plain_words(text), set(), set()
    for item, body in items:
        own = plain_words(body)
        windows = [own[i:i + size] for i in range(max(len(own) - size, 0) + 1)] if own else []
        for window in windows:
            for at in range(len(words) - len(window) + 1):
                if words[at:at + len(window)] == window:
                    hit |= set(range(at, at + len(window)))
                    if item is not None:
                        names.add(str(item))
    joined = ",".join(sorted(names))
    return len(words), len(hit), len(names), hashlib.sha256(joined.encode()).hexdigest(), bool(hit)


@pytest.mark.parametrize("block", [5, 1 << 20])
def test_decontamination(spark, block):
    rng = random.Random(2)
    some = lambda n: "".join(rng.choice(["a", "b", "É", "c1"]) + rng.choice([" ", ", ", "\n", "\x00", "-"]) for _ in range(n))
    items = [(i, some(rng.randrange(1, 9))) for i in range(8)] + [(10, None), (11, ""), (12, "!!"), (3, "a b c1"), (None, "b b b b"), (9, "A")]
    docs = [(i, some(rng.randrange(0, 40))) for i in range(60)] + [(None, "a b"), (5, None), (5, "x" * 100_000), (5, "x" * 100_000)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    given_docs = spark.createDataFrame(docs, "doc_id long, text string").withColumn("n_hit", F.lit("clash"))
    got = decontam.decontaminate(given_docs, bench, window=4, block_bytes=block).collect()
    found = sorted(str((r.doc_id, r.text, r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated)) for r in got)
    assert found == sorted(str((i, t, *plain_hits(t, items, 4))) for i, t in docs)
    for row in got:
        covered = [w for a, b in ((s.start, s.end) for s in row.spans) for w in plain_words(row.text[a:b])]
        assert len(covered) == row.n_hit


def test_decontamination_of_nothing(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    bench = spark.createDataFrame([], "item_id long, text string")
    assert [tuple(r) for r in decontam.judged(docs, bench).collect()] == [(1, 2, 0, 0, hashlib.sha256(b"").hexdigest(), False)]
    assert decontam.judged(docs.where(F.lit(False)), bench).count() == 0


PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


@pytest.fixture(scope="module")
def encoder():
    return bpe.Encoder(bpe.Vocabulary(open(PATH, encoding="utf-8").read()))


ALPHABET = st.sampled_from(["<|endoftext|>", "<|startoftext|>", "<|", "Σ", "İ", "'s", "'LL", " ", "\t", "\x85", "\xa0", "\x1c", "\x00", "e\u0301", "é", "ß", "中", "½", "٣", "🙂", "aa", "ab", "!!", "the", "12", "_", "ẞ", "ﬁ"])


@settings(max_examples=400, deadline=None)
@given(texts=st.lists(st.lists(ALPHABET, max_size=25).map("".join), max_size=5))
def test_bpe_like_the_library(texts):
    tokenizer = test_bpe_like_the_library.tokenizer
    got = test_bpe_like_the_library.encoder(texts)
    for text, ids in zip(texts, got):
        want = tokenizer.encode(text, add_special_tokens=False).ids
        assert ids.tolist() == want
        assert test_bpe_like_the_library.encoder.v.decode(ids) == tokenizer.decode(want, skip_special_tokens=False)


test_bpe_like_the_library.tokenizer = Tokenizer.from_file(PATH)
test_bpe_like_the_library.encoder = bpe.Encoder(bpe.Vocabulary(open(PATH, encoding="utf-8").read()))


def test_bpe_documents(spark, library):
    docs = table(spark, "/root/testdata/sf0.001", "documents").select("doc_id", "text")
    odd = spark.createDataFrame([(None, None), (-1, ""), (-2, "a" * 20_000), (-2, "a" * 20_000), (-3, "<|endoftext|>x<|startoftext|>")], "doc_id long, text string")
    both = docs.unionByName(odd)
    texts = [(r.doc_id, r.text or "") for r in both.collect()]

    def want(text):
        ids = library.encode(text, add_special_tokens=False).ids
        return len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()

    got = sorted(map(str, (tuple(r) for r in bpe.digests(both, PATH).collect())))
    assert got == sorted(str((i, *want(t))) for i, t in texts)
    decoded = bpe.decode(bpe.encode(both, PATH), PATH)
    assert decoded.where(F.sha2("decoded", 256) == F.sha2(F.lit(""), 256)).count() == 2
    assert bpe.digests(docs.where(F.lit(False)), PATH).count() == 0


URLS = [
    None, "", "no scheme", "//porn.example.org/", "casino-win.example.org/x", "http://a/c%61sin%6F", "http://a/c%2561sino", "http://a/%63%41sino%", "http://a/win-win-deal",
    "http://a/free-deal-prize", "http://a/poker?bet", "http://a/poker-deal", "http://a/%zz%7b%41dult%2Dbet", "http://", "HTTP://A.Net/x", "http://net/", "http://net", "http://a.net?x=/y", "http://aNET/", "http://x.example.net/en/1", "http://example.net/EN/",
    "http://example.com/de/", "http://b.example.com/de", "http://u.org/fr/a#b", "http://org/fr/", "http://a.net:80/", "http://free-bets.example.com/a", "http://free.example.com/free",
    "http://ok.example.com/en/Casino-x", "http://ok.example.com/casinos", "http://a.b/?q=porn", "http://a/#cheap-win", "http://é.net/é", "a://b://c.net/x", "http://x.net\n/y", "ftp://" + "a." * 5000 + "net/" + "p/" * 5000,
]


def plain_url(url):
    m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)(.*)", url or "")
    host, path = (m.group(1).translate(LOWER), m.group(2)) if m else ("", "")
    rest = "".join(m.groups()) if m else url or ""
    rest = re.sub("%[0-9A-Fa-f]{2}", lambda e: c if (c := chr(int(e[0][1:], 16))).isascii() and c.isalnum() else e[0], rest).translate(LOWER)
    fits = [r for r in url_filter.RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    rule = max(fits, key=lambda r: len(r.name), default=None)
    count = lambda terms: sum(re.search(f"(?<![a-z0-9]){t}(?![a-z0-9])", rest) is not None for t in terms)
    strict, soft = count(url_filter.STRICT), count(url_filter.SOFT_TERMS)
    weight = sum(w * count([t]) for t, w in url_filter.SOFT_TERMS.items())
    return host, path, rule and rule.name, rule.verdict if rule else "block" if strict or weight >= 3 else "allow", strict, soft


def test_urls(spark):
    rows = list(enumerate(URLS)) + [(None, URLS[5]), (5, URLS[5])]
    pages = spark.createDataFrame(rows, "page_id long, url string").withColumn("html", F.lit("x"))
    got = sorted(str(tuple(r)) for r in url_filter.judged(pages).collect())
    assert got == sorted(str((i, *plain_url(u))) for i, u in rows)
    assert url_filter.judged(pages.where(F.lit(False))).count() == 0


def test_longest_rule_and_block_before_allow():
    rules = [url_filter.Rule("allow", "a.b", "/"), url_filter.Rule("block", "a.b", "/"), url_filter.Rule("allow", "b", "/long/path/")]
    judge = url_filter.Judge(rules, (), {}, 2)
    assert judge("http://x.a.b/long/path/1")[2:4] == ("b/long/path/", "allow")
    assert judge("http://x.a.b/")[2:4] == ("a.b/", "block")
    assert judge("http://c/")[3] == "allow"


def test_a_vocabulary_of_thousands():
    strict, soft = [f"strict{i}" for i in range(5000)], {f"soft{i}": 1 + i % 3 for i in range(5000)}
    judge = url_filter.Judge((), strict, soft, 4)
    assert judge("http://a/strict4999")[3:] == ("block", 1, 0) and judge("http://a/strict49990")[3:] == ("allow", 0, 0)
    assert judge("http://a/soft2-soft5")[3:] == ("block", 0, 2) and judge("http://a/soft0-soft3-soft6")[3:] == ("allow", 0, 3)
