"""Exact top-k search: incremental multi-index hashing of binary codes, in rounds of joins.

A vector's code has one bit per dimension: set if the value is above zero. Codes are cut into segments and indexed once
per segment. Round by round the search radius grows, segment after segment; a probe is a key at exactly the radius from
the query's segment, and each code under it is verified by its whole Hamming distance. With radius r searched in the
first a segments and r - 1 in the others, every code within (segments * r + a - 1) is found. A query is answered when
its k-th verified distance is no more than that; the others go on. A pair is verified at one key only: that of the first
segment with the smallest partial distance. Once a query has k hits, candidates beyond its k-th distance do not leave
the join.

Items are distinct (id, code) pairs. Only distinct codes are indexed and only distinct query codes searched; a code
carries its k + 1 smallest ids, which is all that ranks can need (distance, then id, without the query's own item). So
copies, however many, cost nothing in the search. No query is ever compared with all codes unless the radius has to grow
that far.

Rows with a null id or a vector of another length than ``bits`` are left out; null values count as not above zero.
Fewer than k other items give fewer rows. An empty table gives no rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.llm.common import written

BITS = 64
K = 10
EVERY = 20
#: Codes that share a key on average; verifying one is much cheaper than a further probe.
BUCKET = 4


def code_of(vector: Column, bits: int = BITS) -> Column:
    """Signs of a vector as a signed 64-bit integer, the first value in the highest bit."""
    return F.aggregate(F.slice(vector, 1, bits), F.lit(0).cast("long"), lambda a, x: F.shiftleft(a, 1).bitwiseOR(F.when(x > 0, 1).otherwise(0).cast("long")))


def _segments(n: int, bits: int) -> list[tuple[int, int]]:
    """(lowest bit, width) of each segment, so that about ``BUCKET`` codes share a key."""
    width = min(max(math.log2(max(n, 2) / BUCKET), 4), 20)
    m = max(1, min(round(bits / width), bits))
    edges = [round(i * bits / m) for i in range(m + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:])]


def _key(code: Column, segment: tuple[int, int]) -> Column:
    at, width = segment
    return F.shiftrightunsigned(code, at).bitwiseAND(F.lit((1 << width) - 1 if width < 64 else -1)).cast("long")


def _steps(segments: list[tuple[int, int]]):
    """(radius, segments, distance covered afterwards), small radii in one step and larger ones in two."""
    m = len(segments)
    for r in range(max(w for _, w in segments) + 1):
        cuts = [0, m] if r < 2 else sorted({0, (m + 1) // 2, m})
        for a, b in zip(cuts, cuts[1:]):
            yield r, range(a, b), m * r + b - 1


def _flips(spark: SparkSession, width: int, r: int) -> DataFrame:
    """(flip): every number of ``width`` bits of which ``r`` are set.

    They are rows, as there are tens of thousands for wide segments; as expressions of a plan they fill the driver.
    """
    return spark.range(1 << width).where(F.bit_count("id") == r).select(F.col("id").alias("flip"))


def search(items: DataFrame, queries: DataFrame, k: int = K, bits: int = BITS, item_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """query_id, rank (from 1), neighbour_id and distance of the ``k`` nearest items of every query row."""
    def coded(rows: DataFrame) -> DataFrame:
        whole = rows.where(F.col(item_id).isNotNull() & (F.size(vector) == bits))
        return whole.select(F.col(item_id).alias("id"), code_of(F.col(vector), bits).alias("code")).distinct()

    asked = written(coded(queries), "asked")
    first = F.row_number().over(Window.partitionBy("code").orderBy("id"))
    ids = coded(items).withColumn("n", first).where(F.col("n") <= k + 1)
    codes = written(ids.groupBy("code").agg(F.sort_array(F.collect_list("id")).alias("ids")), "codes")
    n = codes.count()
    segments = _segments(n, bits)
    keyed = F.explode(F.array(*[F.struct(F.lit(i).alias("segment"), _key(F.col("code"), s).alias("key")) for i, s in enumerate(segments)]))
    index = written(codes.select("code", "ids", keyed.alias("k")).select("k.segment", "k.key", "code", "ids"), "index")
    none = F.array().cast("array<struct<d:int,id:bigint>>")
    open_, done = asked.select(F.col("code").alias("q")).distinct().withColumn("best", none), []
    for r, chosen, covered in _steps(segments):
        state = written(_round(open_, index, segments, r, chosen, k), "state")
        kth = F.try_element_at("best", F.lit(k + 1))["d"]
        done.append(state.where(kth <= covered))
        open_ = state.where(kth.isNull() | (kth > covered))
        if open_.isEmpty():
            break
    done.append(open_)  # all radii are searched: nothing is left to find
    answers = done[0]
    for more in done[1:]:
        answers = answers.unionByName(more)
    # Copies of a query may take any share of the rows; both sides of this join come straight from their shuffles.
    found = asked.join(answers, F.col("code") == F.col("q"))
    others = F.slice(F.filter("best", lambda b: (b["d"] > 0) | (b["id"] != F.col("id"))), 1, k)
    ranked = found.select(F.col("id").alias("query_id"), F.posexplode(others).alias("at", "b"))
    return ranked.select("query_id", (F.col("at") + 1).alias("rank"), F.col("b.id").alias("neighbour_id"), F.col("b.d").alias("distance"))


def _round(open_: DataFrame, index: DataFrame, segments, r: int, chosen, k: int) -> DataFrame:
    """(q, best) after the probes at one radius in the chosen segments."""
    limit = F.coalesce(F.try_element_at("best", F.lit(k + 1))["d"], F.lit(64))
    own = [(i, s) for i, s in enumerate(segments) if i in chosen and r <= s[1]]
    if not own:
        return open_
    keys = F.array(*[F.struct(F.lit(i).alias("segment"), _key(F.col("q"), s).alias("key"), F.lit(1 << s[1]).cast("long").alias("end")) for i, s in own])
    asked = open_.select("q", limit.alias("most"), F.explode(keys).alias("s")).select("q", "most", "s.*")
    flips = F.broadcast(_flips(open_.sparkSession, max(width for _, (_, width) in own), r))
    probes = asked.join(flips, F.col("flip") < F.col("end")).select("q", "most", "segment", F.col("key").bitwiseXOR(F.col("flip")).alias("key"))
    differ = F.col("q").bitwiseXOR(F.col("code"))
    # The pair belongs to the first segment with the smallest partial distance.
    elsewhere = F.lit(False)
    for j, s in enumerate(segments):
        apart = F.bit_count(_key(differ, s))
        elsewhere = elsewhere | (apart < r) | ((apart == r) & (F.lit(j) < F.col("p.segment")))
    on = (F.col("p.segment") == F.col("x.segment")) & (F.col("p.key") == F.col("x.key")) & (F.bit_count(differ) <= F.col("most")) & ~elsewhere
    hits = probes.alias("p").join(index.alias("x"), on).select("q", F.bit_count(differ).cast("int").alias("d"), F.explode("ids").alias("id"))
    rows = hits.unionByName(open_.select("q", F.explode_outer("best").alias("b")).select("q", "b.d", "b.id"))
    rank = F.row_number().over(Window.partitionBy("q").orderBy(F.col("d").asc_nulls_last(), "id"))
    top = rows.withColumn("n", rank).where(F.col("n") <= k + 1)
    return top.groupBy("q").agg(F.sort_array(F.collect_list(F.when(F.col("id").isNotNull(), F.struct("d", "id")))).alias("best"))


def searched(embeddings: DataFrame) -> DataFrame:
    """Every row with an id divisible by ``EVERY`` is a query against all rows."""
    rows = embeddings.select("vec_id", "embedding")
    return search(rows, rows.where(F.col("vec_id") % EVERY == 0))


ORACLE = f"""
with v as (
  select distinct vec_id as id, list_transform(embedding, lambda x: coalesce(x > 0, false)) as code
  from embeddings where vec_id is not null and len(embedding) = {BITS}
),
d as (
  select q.id as query_id, v.id as neighbour_id,
         list_sum(list_transform(range(1, {BITS + 1}), lambda i: case when q.code[i] = v.code[i] then 0 else 1 end)) as distance
  from v q, v where q.id % {EVERY} = 0 and not (q.id = v.id and q.code = v.code)
),
r as (select *, row_number() over (partition by query_id order by distance, neighbour_id) as rank from d)
select query_id, cast(rank as int) as rank, neighbour_id, cast(distance as int) as distance from r where rank <= {K}
"""
