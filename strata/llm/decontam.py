"""Benchmark decontamination: one Aho-Corasick automaton over normalised benchmark windows.

Text is lower-cased (A-Z only) and read as words: runs of ASCII letters and digits and of all characters beyond ASCII.
A window is ``window`` consecutive words of a benchmark item; an item of fewer words is one window. Each text is
scanned once; matched positions are mapped to word numbers and to offsets in the original text.

The benchmark is read to the driver in blocks of bounded size and each block is one automaton. Almost always one block
holds everything. With more, the documents pass once per block through a table in the scratch folder, so a task never
holds more than one block's automaton, however large the benchmark is.

Defined results: a null or empty text has no words and no hits. Items that are null or have no words are ignored.
Repeated items are one; an item with a null id marks words as hit but is not listed. Repeated documents are judged
each by itself. An empty benchmark hits nothing. Extra columns are kept; columns of the results' names are replaced.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from strata.llm.common import free_names, with_fields, written

WINDOW = 10
#: Bytes of item text in one automaton (some 40 times as much memory with overlapping windows).
BLOCK_BYTES = 1 << 20
_SPACED = bytes(c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
_SPANS = "array<struct<start:long,end:long>>"
_RESULT = (f"n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean, items array<string>, "
           f"spans {_SPANS}, hits {_SPANS}")
FIELDS = ["n_words", "n_hit", "n_items", "items_sha256", "contaminated", "items", "spans"]
_WORD = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def words_of(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").lower().translate(_SPACED).split()


def _spaced(words: list[bytes]) -> str:
    """`` w1 w2 ... `` as one character per byte, so that a window matches whole words only."""
    return (b" " + b" ".join(words) + b" ").decode("latin-1")


class Windows:
    """The automaton of a block of (item id, text) rows."""

    def __init__(self, items: list[tuple[str | None, str]], window: int):
        import ahocorasick

        found: dict[str, tuple[int, set[str]]] = {}
        for item, text in items:
            words = words_of(text)
            for at in range(max(len(words) - window, 0) + 1 if words else 0):
                some = words[at:at + window]
                _, names = found.setdefault(_spaced(some), (len(some), set()))
                if item is not None:
                    names.add(item)
        self.automaton = ahocorasick.Automaton()
        for key, value in found.items():
            self.automaton.add_word(key, value)
        if found:
            self.automaton.make_automaton()
        self.empty = not found

    def scan(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """(first word, words) of every window that occurs, and the items these windows are from."""
        if self.empty or not words:
            return [], set()
        spaced, hits, items, starts = _spaced(words), [], set(), None
        for end, (n, names) in self.automaton.iter(spaced):
            if starts is None:
                sizes = np.fromiter(map(len, words), np.int64, len(words))
                starts = np.cumsum(sizes + 1) - sizes - 1  # place of the space before each word
            last = int(np.searchsorted(starts, end)) - 1
            hits.append((last - n + 1, n))
            items |= names
        return hits, items


def _merged(hits: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for at, n in sorted(hits):
        if out and at <= out[-1][0] + out[-1][1]:
            out[-1][1] = max(out[-1][1], at + n - out[-1][0])
        else:
            out.append([at, n])
    return [(a, n) for a, n in out]


def _blocks(benchmark: DataFrame, item: str, text: str, limit: int) -> Iterator[list[tuple[str | None, str]]]:
    """The distinct items in lists of at most ``limit`` characters (a longer item is alone); one empty list for none."""
    rows = benchmark.select(F.col(item).cast("string").alias("i"), F.col(text).alias("t")).where("t is not null").distinct()
    block, size, any_yet = [], 0, False
    for row in rows.toLocalIterator():
        if block and size + len(row.t) > limit:
            yield block
            block, size, any_yet = [], 0, True
        block.append((row.i, row.t))
        size += len(row.t)
    if block or not any_yet:
        yield block


def offsets(text: str, hits: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Code point spans of (first word, words) passages of a text."""
    places = [m.span() for m in _WORD.finditer(text)]
    return [(places[at][0], places[at + n - 1][1]) for at, n in hits]


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, text: str = "text", item_id: str = "item_id",
                  item_text: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` with the columns ``FIELDS``: n_words, n_hit, n_items, items_sha256, contaminated, items (sorted ids)
    and spans ((start, end) code points of the hit passages in the original text)."""
    spark, kept = docs.sparkSession, docs.columns
    nothing = F.struct(F.array().cast(_SPANS).alias("hits"), F.array().cast("array<string>").alias("items"))
    so_far, = free_names(docs.columns, "so_far")
    out = docs.withColumn(so_far, nothing)
    for turn, block in enumerate(_blocks(benchmark, item_id, item_text, block_bytes)):
        if turn:
            out = written(out, "decontam")
        scan = _scanner(spark.sparkContext.broadcast(block), window)
        found = scan(F.struct(F.col(text).alias("text"), F.col(f"{so_far}.hits").alias("hits"), F.col(f"{so_far}.items").alias("items")))
        out = out.withColumn(so_far, found)
    return with_fields(out, F.col(so_far), FIELDS).select(*[f"`{c}`" for c in kept if c.lower() not in FIELDS], *FIELDS)


def _scanner(block: Broadcast, window: int):
    """A column function that adds one block's hits to those found before."""
    kind = T._parse_datatype_string(_RESULT)

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        windows = Windows(block.value, window)
        arrow = to_arrow_type(kind)
        for batch in batches:
            # One text at a time leaves Arrow memory; only the few hits are kept.
            yield pa.array([_result(windows, row["text"].as_py() or "", row) for row in batch], arrow)

    run.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(run, kind).asNondeterministic()


def _result(windows: Windows, text: str, before: pa.StructScalar) -> dict:
    words = words_of(text)
    hits, items = windows.scan(words)
    hits = _merged(hits + [(h["start"], h["end"] - h["start"]) for h in before["hits"].as_py()])
    names = sorted(items | set(before["items"].as_py()))
    return {
        "n_words": len(words), "n_hit": sum(n for _, n in hits), "n_items": len(names),
        "items_sha256": hashlib.sha256(",".join(names).encode()).hexdigest(), "contaminated": bool(hits), "items": names,
        "spans": [{"start": a, "end": b} for a, b in offsets(text, hits)] if hits else [],
        "hits": [{"start": a, "end": a + n} for a, n in hits],
    }


def judged(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id and the digest columns for every document."""
    found = decontaminate(docs.select("doc_id", "text"), benchmark)
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def oracle(window: int = WINDOW) -> str:
    """The same digest in SQL over whole tables."""
    words = "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
    return f"""
with d as (select row_number() over () as r, doc_id, {words} as w from documents),
b as (select item_id, {words} as w from benchmark),
windows as (
  select distinct item_id, least(len(w), {window}) as n, array_to_string(w[i:i + least(len(w), {window}) - 1], ' ') as s
  from (select item_id, w, unnest(range(1, greatest(len(w) - {window}, 0) + 2)) as i from b where len(w) > 0)
),
sizes as (select distinct n from windows),
places as (select r, w, n, unnest(range(1, len(w) - n + 2)) as i from d, sizes where len(w) >= n),
found as (
  select p.r, p.i, p.n, x.item_id
  from (select r, i, n, array_to_string(w[i:i + n - 1], ' ') as s from places) p join windows x on x.n = p.n and x.s = p.s
),
hit as (select r, count(distinct i + k) as n_hit from (select r, i, unnest(range(0, n)) as k from found) group by r),
items as (
  select r, count(*) as n_items, string_agg(item, ',' order by item) as names
  from (select distinct r, cast(item_id as varchar) as item from found where item_id is not null) group by r
)
select doc_id, cast(len(w) as bigint) as n_words, cast(coalesce(n_hit, 0) as bigint) as n_hit,
       cast(coalesce(n_items, 0) as bigint) as n_items, sha256(coalesce(names, '')) as items_sha256,
       coalesce(n_hit, 0) > 0 as contaminated
from d left join hit using (r) left join items using (r)
"""
