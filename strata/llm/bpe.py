"""BPE encoding and decoding with a public vocabulary file: merges run as numpy rounds over many words at once.

A text is split at special tokens, normalised and cut into words. The distinct new words of a slice of texts become one
flat array of symbols. In each round the rank of every adjacent pair is found by binary search over the sorted pair
keys, each word's lowest rank is merged wherever it occurs in that word (left to right), and the words without a known
pair leave. Encoded words are kept in a bounded memory, so frequent words are merged once per task.

The vocabulary is a file of the tokenizers library with BPE merges, an end-of-word suffix and byte-level symbols; its
path is a parameter and must be readable on the executors, or its content is given. Decoding joins the tokens with a
space, as that library does for files without a decoder.

Null and empty texts have no tokens; unknown symbols are dropped (there is no unknown token). Repeated rows and ids are
encoded row by row. An empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
import json
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import per_text, with_fields

#: White space as the tokenizer's expressions see it.
_SPACE = r"\t\n\v\f\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_KEPT_WORDS = 200_000
_RESULT = "ids array<int>, n_tokens long, ids_sha256 string"


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte: itself where printable, else the next from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = iter(range(0x100, 0x200))
    return [chr(b) if b in plain else chr(next(rest)) for b in range(256)]


class Vocabulary:
    """Symbols, pair ranks and special tokens of a vocabulary file's JSON text."""

    def __init__(self, content: str):
        data = json.loads(content)
        model = data["model"]
        self.suffix = model["end_of_word_suffix"] or ""
        self.ids: dict[str, int] = model["vocab"]
        self.special = {t["content"]: t["id"] for t in data["added_tokens"]}
        tokens = {i: t for t, i in {**self.ids, **self.special}.items()}
        self.tokens = [tokens.get(i, "") for i in range(max(tokens) + 1)]
        pattern = next(p["pattern"]["Regex"] for p in data["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.word = regex.compile(pattern.replace(r"\s", _SPACE))
        self.cut = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        self.width = len(self.tokens)
        keys = np.array([self.ids[a] * self.width + self.ids[b] for a, b in merges], np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks = keys[order], order
        self.made = np.array([self.ids[a + b] for a, b in merges], np.int64)
        symbols = byte_symbols()
        self.inner = np.array([self.ids.get(s, -1) for s in symbols], np.int64)
        self.last = np.array([self.ids.get(s + self.suffix, -1) for s in symbols], np.int64)

    def normalised(self, text: str) -> str:
        """Composed and lower-cased by character (no final form of sigma). White space only parts words: it can stay."""
        return unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()

    def ranked(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, or the number of merges for none."""
        pair = left * self.width + right
        at = np.minimum(np.searchsorted(self.keys, pair), len(self.keys) - 1)
        return np.where(self.keys[at] == pair, self.ranks[at], len(self.keys))

    def encode_words(self, words: list[str]) -> list[np.ndarray]:
        """Token ids of each word."""
        raw = [w.encode("utf-8") for w in words]
        sizes = np.fromiter(map(len, raw), np.int64, len(raw))
        flat = np.frombuffer(b"".join(raw), np.uint8)
        symbols = self.inner[flat]
        ends = np.cumsum(sizes) - 1
        symbols[ends] = self.last[flat[ends]]
        of = np.repeat(np.arange(len(raw)), sizes)
        known = symbols >= 0
        symbols, of = symbols[known], of[known]
        done_ids, done_of = [], []
        none = len(self.keys)
        rank = self._pairs(symbols, of)
        while len(symbols):
            head = np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1]]))
            best = np.repeat(np.minimum.reduceat(rank, head), np.diff(np.append(head, len(of))))
            active = best < none
            done_ids.append(symbols[~active])
            done_of.append(of[~active])
            symbols, of, rank, best = symbols[active], of[active], rank[active], best[active]
            if not len(symbols):
                break
            hit = rank == best
            # In a run of equal symbols the same pair overlaps itself: take every second from the run's start.
            if (hit[1:] & hit[:-1]).any():
                first = hit & ~np.concatenate([[False], hit[:-1]])
                start = np.maximum.accumulate(np.where(first, np.arange(len(hit)), 0))
                hit &= (np.arange(len(hit)) - start) % 2 == 0
            at = np.flatnonzero(hit)
            symbols[at] = self.made[rank[at]]
            keep = np.ones(len(symbols), bool)
            keep[at + 1] = False
            symbols, of = symbols[keep], of[keep]
            rank = self._pairs(symbols, of)
        ids, where = np.concatenate(done_ids or [symbols]), np.concatenate(done_of or [of])
        ids = ids[np.argsort(where, kind="stable")].astype(np.uint32)
        cuts = np.cumsum(np.bincount(where, minlength=len(raw)))
        return np.split(ids, cuts[:-1])

    def _pairs(self, symbols, of):
        rank = np.full(len(symbols), len(self.keys), np.int64)
        if len(symbols) > 1:
            same = of[1:] == of[:-1]
            rank[:-1][same] = self.ranked(symbols[:-1][same], symbols[1:][same])
        return rank

    def decode(self, ids: np.ndarray) -> str:
        return " ".join(map(self.tokens.__getitem__, ids.tolist()))


class Encoder:
    """Encodes lists of texts; remembers the words met so far, up to a bound."""

    def __init__(self, vocabulary: Vocabulary):
        self.v = vocabulary
        self.known: dict[str, np.ndarray] = {}

    def pieces(self, text: str) -> list[str]:
        """Words and special tokens in order; a special token is marked by the character 0 before it."""
        v = self.v
        if v.cut is None or not (parts := v.cut.split(text))[1:]:
            return v.word.findall(v.normalised(text))
        return [w for i, part in enumerate(parts) for w in ([f"\0{part}"] if i % 2 else v.word.findall(v.normalised(part)))]

    def __call__(self, texts: list[str]) -> list[np.ndarray]:
        pieces = [self.pieces(text) for text in texts]
        if len(self.known) > _KEPT_WORDS:
            self.known.clear()
        new = list({w for words in pieces for w in words}.difference(self.known))
        special = [w for w in new if w[0] == "\0" and w[1:] in self.v.special]
        self.known.update((w, np.array([self.v.special[w[1:]]], np.uint32)) for w in special)
        plain = [w for w in new if w not in self.known]
        if plain:
            self.known.update(zip(plain, self.v.encode_words(plain)))
        none, get = np.zeros(0, np.uint32), self.known.__getitem__
        return [np.concatenate(list(map(get, words))) if words else none for words in pieces]


def _loaded(spark, path: str):
    """The vocabulary file's text, sent to the executors once. The file's size does not depend on the corpus."""
    with open(path, encoding="utf-8") as file:
        return spark.sparkContext.broadcast(file.read())


def encode(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """``docs`` with ids (array of int), n_tokens and ids_sha256 (of the ids as little-endian unsigned 32-bit)."""
    shared = _loaded(docs.sparkSession, path)

    def make():
        encoder = Encoder(Vocabulary(shared.value))

        def work(texts):
            found = encoder(texts)
            return [pa.array([f.astype(np.int32) for f in found], pa.list_(pa.int32())), pa.array([len(f) for f in found], pa.int64()),
                    pa.array([hashlib.sha256(f.astype("<u4").tobytes()).hexdigest() for f in found])]

        return work

    return with_fields(docs, per_text(_RESULT, make)(F.col(text)), ["ids", "n_tokens", "ids_sha256"])


def decode(encoded: DataFrame, path: str, ids: str = "ids") -> DataFrame:
    """``encoded`` with ``decoded``, the tokens joined by spaces; null ids give an empty text."""
    shared = _loaded(encoded.sparkSession, path)

    def run(batches):
        vocabulary = Vocabulary(shared.value)
        for batch in batches:
            yield pa.array([vocabulary.decode(np.asarray(row.values)) if row.is_valid else "" for row in batch], pa.string())

    run.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return encoded.withColumn("decoded", F.arrow_udf(run, "string").asNondeterministic()(F.col(ids)))


def round_trip(docs: DataFrame, path: str, text: str = "text", with_ids: bool = False) -> DataFrame:
    """``docs`` with n_tokens, ids_sha256 and decoded_sha256; the decoded text, and ids unless asked for, stay within the task."""
    shared = _loaded(docs.sparkSession, path)

    def make():
        vocabulary = Vocabulary(shared.value)
        encoder = Encoder(vocabulary)

        def work(texts):
            found = encoder(texts)
            ids = [pa.array([f.astype(np.int32) for f in found], pa.list_(pa.int32()))] if with_ids else []
            return [
                *ids,
                pa.array([len(f) for f in found], pa.int64()),
                pa.array([hashlib.sha256(f.astype("<u4").tobytes()).hexdigest() for f in found]),
                pa.array([hashlib.sha256(vocabulary.decode(f).encode()).hexdigest() for f in found]),
            ]

        return work

    fields = [*["ids"] * with_ids, "n_tokens", "ids_sha256", "decoded_sha256"]
    return with_fields(docs, per_text(f"{_RESULT if with_ids else 'n_tokens long, ids_sha256 string'}, decoded_sha256 string", make)(F.col(text)), fields)


def digests(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 for every document."""
    return round_trip(docs.select("doc_id", "text"), path).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
