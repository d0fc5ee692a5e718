"""Ranked lexical search by pipelined term partitioning.

**Scores.** Terms are maximal runs of digits, letters and non-ASCII characters, A-Z lower-cased. N documents hold a term,
L terms in all; a document of n terms has m = 50 + (50 n N) div L, a term in df documents the weight w = floor(1000
ln((2 N + 2) / (2 df + 1))). A document's score for an item is the sum of w ((10^9 tf) div (1000 tf + 20 m)) over the
item's distinct terms, in 64-bit integers. The ``TOP`` best are ranked, equal scores by ascending id.

**Pipeline.** The terms are dealt to owner stages by how many documents hold them, the rarest first (``SHARES``). Postings
carry their finished contribution and lie in parts of about ``SHARD`` documents, so a frequent term's postings are spread
over all parts. Items travel in bundles of about ``BUNDLE``. A bundle carries, for each part, sparse accumulators (document
and score so far) from stage to stage; a stage is a cogroup of the bundles with the postings that its terms own, which
adds their contributions and sends the bundle on.

**What is carried.** Between stages the ``TOP``-th best score so far of an item, over all parts, is its floor. A document
whose score and the greatest contributions of all later stages stay below the floor leaves the accumulators; once the
greatest contributions of the coming stages together are below it, documents not yet carried are not taken up. Scores
only grow, so the result is exact. Nothing is cut off otherwise.

Terms of documents that no item holds are dropped early by a bit table of fixed size over term checksums; what passes it
by chance is dropped by the join with the items' terms.

Defined results: a null text has no terms; repeated rows are documents of their own; rows of one item_id are one item
with the terms of all; a null doc_id is ranked after the others of its score (the greatest 64-bit integer stands for it
inside, and reads as null); an item without terms, or without a document that scores, has no rows; empty tables give an
empty table. Other columns are not looked at, whatever their names. Documents of any length are read whole.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import per_text, spread_join, written
from strata.session import fits_broadcast, scratch_dir

TOP = 50
#: A term's stage is the number of these shares of all documents that it is above.
SHARES = (1 / 1000, 1 / 100, 1 / 10)
SHARD = 8192
BUNDLE = 256
#: Bits of the table that tells which terms no item holds.
SLOTS = 1 << 20
_TERM = re.compile(rb"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
_LAST = (1 << 63) - 1
_KEPT_TERMS = 200_000


def terms_of(text: str) -> list[bytes]:
    """The terms in order, as UTF-8; bytes of characters beyond ASCII are none of the separators."""
    return _TERM.findall(text.encode("utf-8", "replace").lower())


class _Wanted(dict):
    """Term to whether its bit is set; forgets all when it holds too many."""

    def __init__(self, bits: bytes):
        super().__init__()
        self.bits, self.mask = bits, len(bits) * 8 - 1

    def __missing__(self, term: bytes) -> bool:
        if len(self) >= _KEPT_TERMS:
            self.clear()
        slot = zlib.crc32(term) & self.mask
        found = self[term] = bool(self.bits[slot >> 3] >> (slot & 7) & 1)
        return found


def _counted(text: str, bits=None) -> Column:
    """Struct of n (all terms, with repeats), terms (distinct ones whose bit is set) and tfs."""
    def make():
        wanted = _Wanted(b"\xff" if bits is None else bits.value)

        def work(texts):
            sizes, terms, tfs, ends = [], [], [], [0]
            for one in texts:
                found = terms_of(one)
                sizes.append(len(found))
                for term, tf in Counter(found).items():
                    if wanted[term]:
                        terms.append(term)
                        tfs.append(tf)
                ends.append(len(terms))
            ends = pa.array(ends, pa.int32())
            return [pa.array(sizes, pa.int64()), pa.ListArray.from_arrays(ends, pa.array(terms, pa.binary()).cast(pa.string())),
                    pa.ListArray.from_arrays(ends, pa.array(tfs, pa.int64()))]

        return work

    return per_text("n long, terms array<string>, tfs array<long>", make)(F.col(f"`{text}`"))


def _joined(many: DataFrame, one: DataFrame, key: str, vary: str) -> DataFrame:
    """Inner join with a table of one row per key: broadcast if it fits, else with frequent keys spread."""
    return many.join(F.broadcast(one), key) if fits_broadcast(one) else spread_join(many, one, [key], [vary])


def _bit_table(terms: DataFrame):
    """A broadcast bit table of the terms' checksums; its size is fixed."""
    slots = terms.select(F.crc32("term").bitwiseAND(F.lit(SLOTS - 1)).cast("int").alias("slot")).distinct().toArrow()["slot"].to_numpy()
    set_ = np.zeros(SLOTS, bool)
    set_[slots] = True
    return terms.sparkSession.sparkContext.broadcast(np.packbits(set_, bitorder="little").tobytes())


_CARRIED = "part long, item long, docs array<long>, ids array<long>, scores array<long>, best array<long>"


def _advance(top: int, last: bool):
    """The function of a stage: (bundle rows of a part, postings of the part) to the bundle's next rows."""
    schema = pa.schema([("part", pa.int64()), ("item", pa.int64()), *[(n, pa.list_(pa.int64())) for n in ("docs", "ids", "scores", "best")]])

    def lists(table: pa.Table, name: str):
        column = table[name].combine_chunks()
        flat, ends = column.values.to_numpy(), column.offsets.to_numpy()
        return lambda i: flat[ends[i]:ends[i + 1]]

    def stage(bundle: pa.Table, postings: pa.Table) -> pa.Table:
        if not bundle.num_rows:
            return schema.empty_table()
        number = lambda table, name: table[name].to_numpy()
        term, doc, ident, add = (number(postings, n) for n in ("term_no", "doc", "id", "add"))
        order = np.argsort(term, kind="stable")
        term, doc, ident, add = term[order], doc[order], ident[order], add[order]
        docs_of, ids_of, scores_of, terms_of_row = (lists(bundle, n) for n in ("docs", "ids", "scores", "terms"))
        asks = number(bundle, "asks")
        carried = {int(i): at for at, i in enumerate(number(bundle, "item")) if not asks[at]}
        known = np.unique(np.concatenate([doc, *[docs_of(at) for at in carried.values()]]))
        ids = np.zeros(len(known), np.int64)
        place = np.searchsorted(known, doc)
        ids[place] = ident
        out = {name: [] for name in schema.names}
        floors, here, after = (number(bundle, n) for n in ("floor", "here", "after"))
        part = number(bundle, "part")
        for at in np.flatnonzero(asks):
            item = int(bundle["item"][int(at)].as_py())
            total, met = np.zeros(len(known), np.int64), np.zeros(len(known), bool)
            if item in carried:
                row = carried[item]
                where = np.searchsorted(known, docs_of(row))
                total[where], met[where], ids[where] = scores_of(row), True, ids_of(row)
            for one in terms_of_row(at):
                begin, end = np.searchsorted(term, one), np.searchsorted(term, one, "right")
                total[place[begin:end]] += add[begin:end]
            allowed = total > 0 if here[at] >= floors[at] else met
            some = np.flatnonzero(allowed)
            scores = total[some]
            # This part's own TOP best so far are a floor as well.
            floor = max(int(floors[at]), int(np.partition(scores, len(scores) - top)[len(scores) - top]) if len(scores) >= top else 1)
            some = some[scores + after[at] >= floor]
            if last:
                some = some[np.lexsort((known[some], ids[some], -total[some]))[:top]]
            if len(some):
                scores = total[some]
                out["part"].append(int(part[at]))
                out["item"].append(item)
                out["docs"].append(known[some])
                out["ids"].append(ids[some])
                out["scores"].append(scores)
                out["best"].append(np.sort(scores)[-top:])
        return pa.table([pa.array(out[f.name], f.type) for f in schema], schema=schema)

    return stage


def ranked(docs: DataFrame, items: DataFrame, top: int = TOP, doc_id: str = "doc_id", item_id: str = "item_id", text: str = "text",
           shard: int = SHARD, bundle: int = BUNDLE) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``top`` best documents (doc_id, text) of each item (item_id, text)."""
    spark = docs.sparkSession
    rows = items.select(F.col(f"`{item_id}`").alias("item_id"), _counted(text)["terms"].alias("terms"))
    pairs = written(rows.select("item_id", F.explode("terms").alias("term")).distinct(), "item-terms")
    named = written(pairs.select("item_id").distinct().withColumn("item", F.monotonically_increasing_id()), "items")
    asked_terms = pairs.select("term").distinct()
    counted = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), _counted(text, _bit_table(asked_terms)).alias("c"))
    counted = written(counted.select(F.monotonically_increasing_id().alias("doc"), F.coalesce("doc_id", F.lit(_LAST)).alias("id"), "c.*"), "counted")
    stats = counted.agg(F.count_if(F.col("n") > 0).alias("docs"), F.sum("n").alias("terms"), F.count(F.lit(1)).alias("rows")).first()
    empty = spark.createDataFrame([], f"item_id {named.schema['item_id'].dataType.simpleString()}, rank int, doc_id long, score long")
    if not stats.docs:
        return empty

    # The vocabulary: document frequencies over all documents, weights and owner stages.
    found = counted.select("doc", "id", "n", F.explode(F.arrays_zip("terms", "tfs")).alias("t")).select("doc", "id", "n", F.col("t.terms").alias("term"), F.col("t.tfs").alias("tf"))
    df = found.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    weight = F.floor(F.lit(1000.0) * F.ln(F.lit(2.0 * stats.docs + 2) / (2.0 * F.col("df") + 1))).cast("long")
    stage = sum(((F.col("df") > share * stats.docs).cast("int") for share in SHARES), F.lit(0))
    vocabulary = written(
        df.join(asked_terms, "term").select("term", F.monotonically_increasing_id().alias("term_no"), weight.alias("w"), stage.alias("stage")).where("w > 0"), "vocabulary")
    n_bundles = max(1, math.ceil(named.count() / bundle))
    of_name = named.select(F.col("item_id").alias("name"), "item")  # a null name is a name here
    asked = pairs.join(of_name, F.col("item_id").eqNullSafe(F.col("name"))).join(vocabulary, "term").select("item", F.pmod(F.xxhash64("item"), F.lit(n_bundles)).alias("bundle"), "term_no", "stage")
    asked = written(asked, "asked")

    # Postings with their contributions, by stage; a part is a bundle and a shard of the documents.
    n_shards = max(1, math.ceil(stats.rows / shard))
    m = 100 - 50 + F.expr(f"(50 * n * {stats.docs}L) div {stats.terms}L")
    priced = _joined(found.withColumn("m", m), vocabulary, "term", "doc")
    add = F.col("w") * F.expr("(1000000000 * tf) div (1000 * tf + 20 * m)")
    postings = priced.select("stage", "term_no", F.pmod(F.xxhash64("doc"), F.lit(n_shards)).alias("shard"), "doc", "id", add.alias("add"))
    if n_bundles > 1:
        of = asked.groupBy("term_no").agg(F.collect_set("bundle").alias("bundles"))
        postings = _joined(postings, written(of, "bundles"), "term_no", "doc").withColumn("bundle", F.explode("bundles"))
    else:
        postings = postings.withColumn("bundle", F.lit(0).cast("long"))
    path_schema = "part long, term_no long, doc long, id long, add long, stage int"
    postings = _by_stage(postings.select((F.col("bundle") * n_shards + F.col("shard")).alias("part"), "term_no", "doc", "id", "add", "stage"), path_schema)
    peaks = postings.groupBy("term_no").agg(F.max("add").alias("peak"))
    # An item is one text, so its terms are one row.
    of_item = asked.join(peaks, "term_no").groupBy("item", "bundle").agg(F.collect_list(F.struct("stage", "term_no", "peak")).alias("asked"))
    of_item = written(of_item, "item-rows")
    stages = sorted(r.stage for r in vocabulary.select("stage").distinct().collect())  # one for each share at most

    none = F.array().cast("array<long>")
    carried = floors = None
    for at, own in enumerate(stages):
        peak_sum = lambda test: F.aggregate(F.filter("asked", lambda t: test(t["stage"])), F.lit(0).cast("long"), lambda a, t: a + t["peak"])
        orders = of_item if floors is None else of_item.join(floors, "item", "left")
        floor = F.lit(1) if floors is None else F.coalesce("floor", F.lit(1))
        orders = orders.select(
            F.explode(F.transform(F.sequence(F.lit(0), F.lit(n_shards - 1)), lambda s: F.col("bundle") * n_shards + s)).alias("part"), "item",
            F.transform(F.filter("asked", lambda t: t["stage"] == own), lambda t: t["term_no"]).alias("terms"), floor.cast("long").alias("floor"),
            peak_sum(lambda s: s >= own).alias("here"), peak_sum(lambda s: s > own).alias("after"), F.lit(True).alias("asks"), none.alias("docs"), none.alias("ids"), none.alias("scores"))
        if carried is not None:
            zero = F.lit(0).cast("long")
            orders = orders.unionByName(carried.select(
                "part", "item", none.alias("terms"), zero.alias("floor"), zero.alias("here"), zero.alias("after"), F.lit(False).alias("asks"), "docs", "ids", "scores"))
        owned = postings.where(F.col("stage") == own).drop("stage")
        moved = orders.groupBy("part").cogroup(owned.groupBy("part")).applyInArrow(_advance(top, at == len(stages) - 1), _CARRIED)
        carried = written(moved, "carried")
        best = Window.partitionBy("item").orderBy(F.col("score").desc())
        tops = carried.select("item", F.explode("best").alias("score")).withColumn("at", F.row_number().over(best)).where(F.col("at") <= top)
        floors = tops.groupBy("item").agg(F.max("at").alias("n"), F.min("score").alias("floor")).where(F.col("n") == top).select("item", "floor")
    if carried is None:
        return empty
    scored = carried.select("item", F.explode(F.arrays_zip("docs", "ids", "scores")).alias("d")).select("item", "d.docs", "d.ids", "d.scores")
    order = Window.partitionBy("item").orderBy(F.col("scores").desc(), "ids", "docs")
    final = scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return final.join(named, "item").select("item_id", "rank", F.nullif(F.col("ids"), F.lit(_LAST)).alias("doc_id"), F.col("scores").alias("score"))


def _by_stage(postings: DataFrame, schema: str) -> DataFrame:
    """The postings as a table that lies by stage, so that each stage reads its own alone."""
    path = scratch_dir(postings.sparkSession, "postings")
    postings.write.mode("overwrite").partitionBy("stage").parquet(path)
    return postings.sparkSession.read.schema(schema).parquet(path)


ORACLE = rf"""
with texts as (select row_number() over () as k, doc_id, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as text from documents),
split as (select k, doc_id, regexp_extract_all(text, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') as ts from texts where text is not null),
sizes as (select k, doc_id, ts, cast(len(ts) as bigint) as n from split where len(ts) > 0),
total as (select count(*) as n_docs, cast(sum(n) as bigint) as n_terms from sizes),
asked as (
  select distinct item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term from benchmark where text is not null),
tfs as (select k, term, count(*) as tf from (select k, unnest(ts) as term from sizes) where term in (select term from asked) group by 1, 2),
weights as (select term, cast(floor(1000 * ln((2 * n_docs + 2) / (2 * df + 1))) as bigint) as w
            from (select term, count(*) as df from tfs group by term), total),
added as (
  select item_id, k, doc_id, w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * n * n_docs) // n_terms))) as points
  from asked join tfs using (term) join weights using (term) join sizes using (k), total),
scored as (select item_id, k, doc_id, cast(sum(points) as bigint) as score from added group by 1, 2, 3 having sum(points) > 0),
placed as (select *, cast(row_number() over (partition by item_id order by score desc, doc_id nulls last) as int) as rank from scored)
select item_id, rank, doc_id, score from placed where rank <= {TOP}
"""
