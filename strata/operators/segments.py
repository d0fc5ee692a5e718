"""A text index that follows its documents: immutable segments, tombstones and additive document frequencies."""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from strata.operators import retrieval
from strata.operators.retrieval import TfidfIndex
from strata.sources.tables import Store

TABLES = ("shards", "dead", "less")
#: The parts that terms are added up in; a store's segments must agree in it.
PARTS = 512
_MANIFEST = "version long, next_id long, segments array<struct<id:long,chunks:long>>, total long, ready boolean"
_DEAD = "shard long, chunk_no int"
_LESS = "shard long, part int, terms binary, df binary, sign int"
_ABSENT = ("PATH_NOT_FOUND", "TABLE_OR_VIEW_NOT_FOUND")


def _union(tables: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, tables)


class SegmentedIndex:
    """Segments of a TF-IDF index in the layer ``index`` of a store; one writer at a time.

    An update writes one segment and touches no other: its ``shards`` (as in ``retrieval.inverted``), the chunks of
    earlier segments that it replaces or removes (``dead``), and their terms (``less``), which count negatively. The terms
    listed in the shards and in ``less`` add up to the frequencies of the living chunks. ``fanout`` segments of about one
    size are merged into one, so a chunk is indexed again a logarithmic number of times.

    A list holds no idf, so it stays as it is when frequencies change. ``current`` sums up frequencies and norms for the
    newest version when it is first asked for, which reads all blocks once; then it is a table like any other.

    A commit is one row appended to the manifest after all else is written. An update that dies before leaves tables
    that nothing refers to; the next one takes the same number and replaces them. Tables of merged segments stay for
    searches that still read them, until ``vacuum``.
    """

    def __init__(self, store: Store, name: str = "documents", stop_words: Sequence[str] | None = None, fanout: int = 8,
                 parts: int = PARTS):
        if fanout < 2:
            raise ValueError("fanout must be at least 2")
        self.store, self.name, self.stop_words = store, name, retrieval._listed(stop_words)
        self.fanout, self.parts = fanout, parts

    # -- tables ------------------------------------------------------------------------------------------------------

    def _state(self) -> Row:
        """The newest row of the manifest."""
        try:
            rows = self.store.read("index", f"{self.name}_manifest")
            newest = rows.orderBy(F.col("version").desc(), F.col("ready").desc()).first()
        except AnalysisException as error:
            if error.getCondition() not in _ABSENT:
                raise
            newest = None
        return newest or Row(version=0, next_id=0, segments=[], total=0, ready=False)

    def _commit(self, version: int, next_id: int, segments: Sequence, total: int, ready: bool = False) -> None:
        row = (version, next_id, [(s.id, s.chunks) for s in segments], total, ready)
        spark = self.store.spark
        self.store.write(spark.createDataFrame([row], _MANIFEST).coalesce(1), "index", f"{self.name}_manifest", "append")

    def _kept(self, df: DataFrame, table: str) -> DataFrame:
        kinds = "kind" in df.columns
        retrieval.write_index(self.store, df, f"{self.name}_{table}")
        return self.store.read("index", f"{self.name}_{table}", df.schema if kinds else None)

    def _indexed(self, chunks: DataFrame, this: int) -> int:
        """Write the shards of a segment; how many chunks it has. Without any it has no such table."""
        size = retrieval._size(chunks)
        if not size[0]:
            return 0
        rows = retrieval.inverted(chunks, size, self.stop_words, this, self.parts)
        return retrieval.part(self._kept(rows, f"s{this}_shards"), "chunks").count()

    def _all(self, segments: Sequence, table: str) -> DataFrame:
        return _union([self.store.read("index", f"{self.name}_s{s.id}_{table}") for s in segments])

    def _shards(self, segments: Sequence, kind: str) -> DataFrame:
        """The rows of one kind of all segments that have chunks, of which there is at least one."""
        return _union([retrieval.part(self._all([s], "shards"), kind) for s in segments if s.chunks])

    def _living(self, segments: Sequence, every: Sequence) -> DataFrame:
        """The chunks of ``segments`` that no segment of ``every`` has declared dead."""
        return self._shards(segments, "chunks").join(self._all(every, "dead"), ["shard", "chunk_no"], "left_anti")

    # -- updates -----------------------------------------------------------------------------------------------------

    def update(self, chunks: DataFrame | None = None, gone: DataFrame | None = None) -> None:
        """Add ``chunks`` (doc_id, chunk_id, text), in place of all earlier ones of the same documents, and remove the
        documents in ``gone`` (doc_id) that are not among those.

        Documents that the index does not hold may be removed; rows with a null doc_id are added and never replaced.
        Which chunks die is found by ids alone; texts are read only in segments that hold some of them.
        """
        if chunks is None and gone is None:
            return
        state, spark = self._state(), self.store.spark
        this = state.next_id
        if chunks is None:
            chunks = spark.createDataFrame([], "doc_id string, chunk_id string, text string")
            held = [s for s in state.segments if s.chunks]
            if held:
                chunks = self._shards(held[:1], "chunks").select("doc_id", "chunk_id", "text").limit(0)
        texts = self._kept(chunks.select("doc_id", "chunk_id", "text"), f"s{this}_texts")
        count, killed = self._indexed(texts, this), 0
        less = spark.createDataFrame([], _LESS)
        if any(s.chunks for s in state.segments):
            ids = texts.select("doc_id")
            if gone is not None:
                ids = ids.unionByName(gone.select("doc_id"))
            doomed = self._living(state.segments, state.segments).join(ids.distinct(), "doc_id", "left_semi")
            dead = self._kept(doomed.select("shard", "chunk_no"), f"s{this}_dead")
            hit = {r[0] for r in dead.select(F.shiftright("shard", 32)).distinct().collect()}  # segment numbers
            touched = [s for s in state.segments if s.id in hit]
            killed = dead.count()
            if touched:
                lost = self._shards(touched, "chunks").join(dead, ["shard", "chunk_no"]).select("shard", "text")
                sent = retrieval.together(lost, "shard", self.stop_words)
                less = retrieval.listed(sent.select("shard", "words"), self.parts, sign=-1)
        else:
            self._kept(spark.createDataFrame([], _DEAD), f"s{this}_dead")
        self._kept(less, f"s{this}_less")
        self.store.drop("index", f"{self.name}_s{this}_texts")
        segments = [*state.segments, Row(id=this, chunks=count)]
        self._commit(state.version + 1, this + 1, segments, state.total + count - killed)
        self._merge()

    def _tier(self, segment) -> int:
        return int(math.log(max(segment.chunks, 1), self.fanout))

    def _merge(self) -> None:
        """Merge segments as long as ``fanout`` of them are of one tier of size."""
        while True:
            state = self._state()
            tiers: dict[int, list] = {}
            for s in state.segments:
                tiers.setdefault(self._tier(s), []).append(s)
            full = next((tiers[t] for t in sorted(tiers) if len(tiers[t]) >= self.fanout), None)
            if full is None:
                return
            this, numbers = state.next_id, [s.id for s in full]
            elsewhere = ~F.shiftright("shard", 32).isin(numbers)
            count = 0
            if any(s.chunks for s in full):
                count = self._indexed(self._living(full, state.segments).select("doc_id", "chunk_id", "text"), this)
            for table in ("dead", "less"):
                self._kept(self._all(full, table).where(elsewhere), f"s{this}_{table}")
            rest = [s for s in state.segments if s.id not in numbers]
            self._commit(state.version + 1, this + 1, [*rest, Row(id=this, chunks=count)], state.total)

    # -- searching ---------------------------------------------------------------------------------------------------

    def current(self) -> TfidfIndex:
        """The index of all living chunks, for ``retrieval.search``."""
        state = self._state()
        if not state.total:
            raise ValueError("no chunks to index")
        dead = self._all(state.segments, "dead")
        names = f"v{state.version}_counted", f"v{state.version}_norms"
        if state.ready:
            added = self.store.read("index", f"{self.name}_{names[0]}", StructType.fromDDL(retrieval.COUNTED))
            norms = self.store.read("index", f"{self.name}_{names[1]}")
        else:
            # What was taken from segments that are merged by now is not in the merged one either.
            here = F.shiftright("shard", 32).isin([s.id for s in state.segments])
            entries = self._shards(state.segments, "entries")
            less = self._all(state.segments, "less").where(here)
            listed = retrieval.listed_again(entries, self.parts).unionByName(less)
            added = self._kept(retrieval.counted(listed, state.total), names[0])
            norms = self._kept(retrieval.norms(entries, retrieval.part(added, "shards"), state.total, dead), names[1])
            self._commit(state.version, state.next_id, state.segments, state.total, ready=True)
        living, entries = self._living(state.segments, state.segments), self._shards(state.segments, "entries")
        return TfidfIndex(living, entries, norms, added, self.stop_words)

    def vacuum(self) -> None:
        """Drop the tables of merged segments and of older versions; no search may still read them."""
        state = self._state()
        used = {s.id for s in state.segments}
        for number in set(range(state.next_id)) - used:
            for table in TABLES:
                self.store.drop("index", f"{self.name}_s{number}_{table}")
        for version in range(state.version):
            for table in ("counted", "norms"):
                self.store.drop("index", f"{self.name}_v{version}_{table}")
