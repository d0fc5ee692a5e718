"""Token counts that follow edits: a segment tree per document, of which only touched regions are encoded again.

A document's leaves are runs of whole pre-tokens of about ``LEAF`` characters with their token counts; above them stands
a complete binary tree of sums of characters and tokens, kept as two arrays (``chars`` and ``tokens``; node i has the
children 2i and 2i + 1, the root is node 1). Leaves begin at an ASCII space or line feed that follows a character that
is no white space. The pattern must always cut there, so that leaf counts add up to the count of the text; patterns that
do not, such as those where signs take the line feeds that follow, are refused (``require_cuts``).

An edit replaces code points [start, stop) of the original text. The tree leads to the leaves it touches; the region
from the leaf that holds the two characters before it is cut and encoded anew, until a leaf beginning behind the edit is
a certain cut of the new text as well. Only counts on the path from the changed leaves to the root change; when edits
change the number of leaves, inner sums are rebuilt from the leaf counts, without encoding.

Nulls and empty texts have a tree without tokens and take edits at position 0. Edits are applied in order of start and
stop; an edit that overlaps an earlier one, or has a null or reversed position, is left out; positions are cut to the
text's length; a null replacement is empty. Repeated rows are counted row by row. An empty table gives an empty table.
"""

from __future__ import annotations

import base64
import re
import sys
import unicodedata
from collections.abc import Iterator
from functools import cache
from itertools import product

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
import tiktoken
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from strata.llm.common import SLICE_BYTES, with_fields

LEAF = 256
#: A place where the pre-tokenizer cuts whatever comes before and after, see ``require_cuts``.
_CUT = re.compile(r"(?<=\S)[ \n]")
_EDITS = "array<struct<start:int,stop:int,text:string>>"
_TREE = "n_tokens long, leaves int, chars array<int>, tokens array<int>"
_AFTER = "text string, n_tokens long, leaves int, chars array<int>, tokens array<int>, n_edits long, encoded_chars long"


def encoder(ranks: str, pattern: str) -> tiktoken.Encoding:
    """A byte-level encoding from the text of a rank file."""
    pairs = (line.split() for line in ranks.splitlines() if line)
    return tiktoken.Encoding("corpus", pat_str=pattern, mergeable_ranks={base64.b64decode(a): int(b) for a, b in pairs}, special_tokens={})


@cache
def require_cuts(pattern: str) -> None:
    """Refuse a pattern whose pre-tokens may run on over a leaf's start, as leaf counts would not add up then.

    Tried around signs of every general category of Unicode, with what may stand before and after them.
    """
    kinds: dict[str, list[str]] = {}
    for code in range(sys.maxunicode + 1):
        some = kinds.setdefault(unicodedata.category(chr(code)), [])
        if len(some) < 3 and not chr(code).isspace() and unicodedata.category(chr(code)) != "Cs":
            some.append(chr(code))
    signs = [*dict.fromkeys([*"aZ19!.'-_", "'s", "'ll", *(c for some in kinds.values() for c in some)])]
    compiled = regex.compile(pattern)
    for before, sign, cut, after in product(("", "a", "1", "!", " "), signs, " \n", ("", "a", "1", "!", " ", "\n", "\n\n")):
        head = before + sign
        text = head + cut + after
        if any(m.start() < len(head) < m.end() for m in compiled.finditer(text)):
            raise ValueError(f"pre-tokens of this pattern do not always end before a space or line feed: {ascii(text)}")


def leaf_starts(text: str, begin: int = 0, end: int | None = None, leaf: int = LEAF) -> list[int]:
    """Starts of the leaves of text[begin:end]; ``begin`` is one itself."""
    end = len(text) if end is None else end
    starts, at = [], begin
    while at < end:
        starts.append(at)
        found = _CUT.search(text, at + leaf, end)
        at = found.start() if found else end
    return starts


class Tree:
    """Leaf sizes and token counts with their sums."""

    def __init__(self, chars: list[int], tokens: list[int]):
        self.leaves = len(chars)
        self.width = 1 << max(self.leaves - 1, 0).bit_length()
        self.chars = self._summed(chars)
        self.tokens = self._summed(tokens)

    def _summed(self, values) -> np.ndarray:
        nodes = np.zeros(2 * self.width, np.int32)
        nodes[self.width:self.width + len(values)] = values
        low = self.width
        while low > 1:
            nodes[low // 2:low] = nodes[low:2 * low:2] + nodes[low + 1:2 * low:2]
            low //= 2
        return nodes

    @classmethod
    def of_arrays(cls, leaves: int, chars, tokens) -> Tree:
        tree = cls.__new__(cls)
        tree.leaves, tree.width, tree.chars, tree.tokens = leaves, len(chars) // 2, np.array(chars, np.int32), np.array(tokens, np.int32)
        return tree

    @property
    def total(self) -> int:
        return int(self.tokens[1])

    def find(self, at: int) -> tuple[int, int]:
        """Leaf that holds a character and the leaf's start; the last leaf for places behind the text."""
        node, start = 1, 0
        while node < self.width:
            node *= 2
            if at - start >= self.chars[node] and self.chars[node + 1]:
                start += int(self.chars[node])
                node += 1
        return node - self.width, start

    def put(self, leaf: int, chars: int, tokens: int) -> None:
        """Change one leaf and the sums above it."""
        node = leaf + self.width
        more_chars, more_tokens = chars - self.chars[node], tokens - self.tokens[node]
        while node:
            self.chars[node] += more_chars
            self.tokens[node] += more_tokens
            node //= 2


def build(text: str, encoding: tiktoken.Encoding, leaf: int = LEAF) -> Tree:
    starts = leaf_starts(text, leaf=leaf)
    parts = [text[a:b] for a, b in zip(starts, [*starts[1:], len(text)])]
    return Tree([len(p) for p in parts], [len(encoding.encode_ordinary(p)) for p in parts])


def usable(edits, size: int) -> list[tuple[int, int, str]]:
    out, behind = [], 0
    rows = ((e["start"], e["stop"], e["text"] or "") for e in edits or () if e and e["start"] is not None and e["stop"] is not None)
    for start, stop, text in sorted(rows):
        start, stop = min(max(start, 0), size), min(stop, size)
        if stop >= start >= behind and (text or stop > start):
            out.append((start, stop, text))
            behind = stop
    return out


def edited(text: str, tree: Tree, edits: list[tuple[int, int, str]], encoding: tiktoken.Encoding, leaf: int = LEAF) -> tuple[str, Tree, int]:
    """New text and tree, and how many characters were encoded. ``edits`` are in order and do not overlap."""
    if not edits:
        return text, tree, 0
    pieces, at, moved = [], 0, []
    for start, stop, new in edits:
        pieces += [text[at:start], new]
        moved.append((start, stop, len(new)))
        at = stop
    changed = "".join([*pieces, text[at:]])
    # Regions in old places: from the leaf before the first edit to a leaf start behind the last one that joins it.
    regions: list[list[int]] = []  # first leaf, its start, end leaf (exclusive), its start, shift before, shift after
    shift = 0
    for start, stop, size in moved:
        first, begin = tree.find(max(start - 2, 0))
        before, shift = shift, shift + size - (stop - start)
        last, end = tree.find(stop)
        # The leaf that holds the first character behind the edit belongs to the region.
        if tree.leaves:
            end, last = end + int(tree.chars[tree.width + last]), last + 1
        # The text at the next leaf's start is still a certain cut only if the character before it is unchanged.
        while last < tree.leaves and end <= stop + 1:
            end, last = end + int(tree.chars[tree.width + last]), last + 1
        if regions and first <= regions[-1][2]:
            regions[-1][2:4], regions[-1][5] = [max(last, regions[-1][2]), max(end, regions[-1][3])], shift
        else:
            regions.append([first, begin, last, end, before, shift])
    encoded, same = 0, True
    fresh = []
    for first, begin, last, end, before, after in regions:
        new_begin, new_end = begin + before, end + after
        starts = leaf_starts(changed, new_begin, new_end, leaf)
        parts = [changed[a:b] for a, b in zip(starts, [*starts[1:], new_end])]
        encoded += new_end - new_begin
        fresh.append((first, last, [len(p) for p in parts], [len(encoding.encode_ordinary(p)) for p in parts]))
        same &= len(parts) == last - first
    if same:
        for first, _, chars, tokens in fresh:
            for k, (c, n) in enumerate(zip(chars, tokens)):
                tree.put(first + k, c, n)
        return changed, tree, encoded
    chars, tokens = (nodes[tree.width:tree.width + tree.leaves].tolist() for nodes in (tree.chars, tree.tokens))
    for first, last, new_chars, new_tokens in reversed(fresh):
        chars[first:last], tokens[first:last] = new_chars, new_tokens
    return changed, Tree(chars, tokens), encoded


def _fields(tree: Tree) -> dict:
    return {"n_tokens": tree.total, "leaves": tree.leaves, "chars": tree.chars, "tokens": tree.tokens}


def _shared(spark, ranks_path: str):
    """The rank file's text for the executors; its size does not depend on the corpus."""
    with open(ranks_path, encoding="ascii") as file:
        return spark.sparkContext.broadcast(file.read())


def _by_bytes(rows: pa.StructArray, limit: int = SLICE_BYTES) -> Iterator[pa.StructArray]:
    """Rows in order, in slices of about ``limit`` bytes of text; a longer text makes a slice of its own."""
    sizes = pc.fill_null(pc.binary_length(rows.field("text")), 0).to_numpy(zero_copy_only=False).astype(np.int64) + 64
    ends = np.cumsum(sizes)
    at = 0
    while at < len(rows):
        stop = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + limit, side="right")))
        yield rows.slice(at, stop - at)
        at = stop


def _per_row(kind: str, ranks, pattern: str, one):
    """A column function over structs: ``one`` makes a dict of the result from a row and the encoding."""
    parsed = T._parse_datatype_string(kind)
    require_cuts(pattern)

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoding, arrow = encoder(ranks.value, pattern), to_arrow_type(parsed)
        for batch in batches:
            parts = [pa.array([one(row, encoding) for row in some], arrow) for some in _by_bytes(batch)]
            yield pa.chunked_array(parts, arrow).combine_chunks()

    run.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(run, parsed).asNondeterministic()


def with_trees(docs: DataFrame, ranks_path: str, pattern: str, text: str = "text") -> DataFrame:
    """``docs`` with n_tokens and the tree (leaves, chars, tokens)."""
    tree = _per_row(_TREE, _shared(docs.sparkSession, ranks_path), pattern, lambda row, encoding: _fields(build(row["text"].as_py() or "", encoding)))
    return with_fields(docs, tree(F.struct(F.col(text).alias("text"))), ["n_tokens", "leaves", "chars", "tokens"])


def apply_edits(trees: DataFrame, ranks_path: str, pattern: str, text: str = "text", edits: str = "edits") -> DataFrame:
    """``trees`` with edited text, counts and trees, and n_edits and encoded_chars (characters encoded again)."""
    def one(row, encoding):
        old = row["text"].as_py() or ""
        todo = usable(row["edits"].as_py(), len(old))
        tree = Tree.of_arrays(row["leaves"].as_py(), row["chars"].values, row["tokens"].values)
        new, tree, encoded = edited(old, tree, todo, encoding)
        return {"text": new, **_fields(tree), "n_edits": len(todo), "encoded_chars": encoded}

    after = _per_row(_AFTER, _shared(trees.sparkSession, ranks_path), pattern, one)
    given = F.struct(F.col(text).alias("text"), F.col(edits).cast(_EDITS).alias("edits"), *[F.col(c) for c in ("leaves", "chars", "tokens")])
    names = T._parse_datatype_string(_AFTER).fieldNames()
    return with_fields(trees, after(given), names).withColumnRenamed("text", text)


def join_edits(docs: DataFrame, edits: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """``docs`` with the column ``edits``, gathered from (doc_id, start, stop, text) rows; a document's own only."""
    own = edits.groupBy(doc_id).agg(F.collect_list(F.struct("start", "stop", "text")).cast(_EDITS).alias("edits"))
    return docs.join(own, doc_id, "left")


def masking_edits(text: Column) -> Column:
    """Edits that mask mail addresses and long numbers, as a cleaning step of a corpus would ask for."""
    from strata.llm.secrets import matches

    found = F.concat(
        F.transform(matches(text, r"[A-Za-z0-9._%+-]{1,64}@[A-Za-z0-9.-]{1,255}\.[A-Za-z]{2,24}"), lambda m: F.struct(m["start"].alias("start"), m["stop"].alias("stop"), F.lit("<mail>").alias("text"))),
        F.transform(matches(text, r"[0-9]{6,}"), lambda m: F.struct(m["start"].alias("start"), m["stop"].alias("stop"), F.lit("0").alias("text"))),
    )
    return F.when(text.rlike("@|[0-9]{6}"), found).otherwise(F.array().cast(_EDITS))


def counted(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """Counts before and after the masking edits for every document, with how much was encoded again."""
    planned = docs.select("doc_id", "text").withColumn("edits", masking_edits(F.col("text")))
    trees = with_trees(planned, ranks_path, pattern).withColumn("n_before", F.col("n_tokens"))
    after = apply_edits(trees, ranks_path, pattern)
    return after.select("doc_id", F.col("n_before").alias("n_tokens"), "n_edits", F.col("n_tokens").alias("n_tokens_edited"), "encoded_chars", F.sha2("text", 256).alias("edited_sha256"))
