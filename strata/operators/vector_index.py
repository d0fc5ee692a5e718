"""Exact vector search over stored clusters, of which those that cannot reach a query's k-th score are skipped."""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from strata.operators.retrieval import NEAR, VECTOR_BYTES, _Nearest, _top_k, _unit_rows
from strata.session import scratch_dir
from strata.sources.tables import Store

#: Centres are fitted on a sample of at most this many vectors (and ``VECTOR_BYTES``); every vector is assigned.
SAMPLE_ROWS = 20_000
SAMPLE_PER_CLUSTER = 10
ROUNDS = 8
#: Products of vectors and centres that are held at once.
AT_ONCE = 4_000_000
#: Vectors of a part, about: the unit of work in a cluster of any size.
PART_ROWS = 8192
#: The cluster of vectors of length zero, whose cosine is 0.
ZERO = -1


def _centres(sample: np.ndarray, count: int) -> np.ndarray:
    """Centres of ``count`` clusters of a sample: far points first, then rounds of nearest centre and mean."""
    rows = sample[sample.any(axis=1)]
    if not len(rows):
        return np.zeros((1, sample.shape[1]))  # zero vectors only
    chosen, closeness = [0], np.full(len(rows), -np.inf)
    while len(chosen) < min(count, len(rows)):
        closeness = np.maximum(closeness, rows @ rows[chosen[-1]])  # of unit vectors, so the far ones have the least
        if closeness.min() >= 1 - NEAR:
            break
        chosen.append(int(closeness.argmin()))
    centres = rows[chosen]
    for _ in range(ROUNDS):
        half = (centres ** 2).sum(axis=1) / 2
        slices = np.array_split(rows, math.ceil(rows.shape[0] * len(centres) / AT_ONCE))
        own = np.concatenate([(part @ centres.T - half).argmax(axis=1) for part in slices])
        sums = np.zeros_like(centres)
        np.add.at(sums, own, rows)
        sizes = np.bincount(own, minlength=len(centres))[:, None]
        centres = np.divide(sums, sizes, out=centres.copy(), where=sizes > 0)
    return centres


@dataclass(frozen=True)
class VectorIndex:
    """``vectors`` (item, embedding, cluster, part), with embeddings as unit vectors of doubles.

    ``clusters`` (cluster, centre, radius, n, parts): the mean of a cluster, the greatest distance of a member from it,
    its members and the parts that they are dealt to by hash. There are at most ``SAMPLE_ROWS / SAMPLE_PER_CLUSTER`` clusters.
    """

    vectors: DataFrame
    clusters: DataFrame
    item: str

    @staticmethod
    def build(vectors: DataFrame, store: Store, name: str = "vectors", item: str = "vec_id", clusters: int | None = None) -> VectorIndex:
        """Written with ``store``. ``vectors`` is (item, embedding); null embeddings are left out, copies and ties kept.

        By default there are about as many clusters as the square root of the vectors, within the sample's bound.
        The sample is the first vectors by a hash of the item, so it is the same in every run.
        """
        given = vectors.select(item, "embedding").where("embedding is not null")
        measure = given.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("embedding")).alias("width")).first()
        if not measure.n or not measure.width:
            raise ValueError("no vectors to index")
        bound = min(SAMPLE_ROWS, max(1, VECTOR_BYTES // (8 * measure.width)))
        sample = given.orderBy(F.xxhash64(item)).limit(bound).select("embedding").toArrow().combine_chunks()
        wanted = clusters or math.ceil(math.sqrt(measure.n))
        centres = _centres(_unit_rows(sample["embedding"].combine_chunks()), min(wanted, max(1, bound // SAMPLE_PER_CLUSTER)))
        shared = vectors.sparkSession.sparkContext.broadcast(centres)
        kind = given.schema[item].dataType
        names = [item, "embedding", "cluster", "distance"]

        def assign(batches):
            centres = shared.value
            half = (centres ** 2).sum(axis=1) / 2
            for batch in batches:
                step = max(1, AT_ONCE // len(centres))
                for part in (batch.slice(start, step) for start in range(0, batch.num_rows, step)):
                    rows = _unit_rows(part.column(1))
                    own = (rows @ centres.T - half).argmax(axis=1)
                    distance = np.linalg.norm(rows - centres[own], axis=1)
                    zero = ~rows.any(axis=1)
                    own[zero], distance[zero] = ZERO, 0
                    lists = pa.FixedSizeListArray.from_arrays(pa.array(rows.ravel()), rows.shape[1]).cast(pa.list_(pa.float64()))
                    columns = [part.column(0), lists, pa.array(own.astype(np.int32)), pa.array(distance)]
                    yield pa.RecordBatch.from_arrays(columns, names=names)

        schema = f"{item} {kind.simpleString()}, embedding array<double>, cluster int, distance double"
        store.write(given.mapInArrow(assign, schema), "index", f"{name}_assigned")
        assigned = store.read("index", f"{name}_assigned")
        sizes = assigned.groupBy("cluster").agg(F.max("distance").alias("radius"), F.count(F.lit(1)).alias("n"))
        found = sizes.withColumn("parts", F.ceil(F.col("n") / PART_ROWS).cast("int"))
        places = [(i, c.tolist()) for i, c in enumerate(centres)]
        known = vectors.sparkSession.createDataFrame([*places, (ZERO, [0.0] * measure.width)], "cluster int, centre array<double>")
        store.write(found.join(F.broadcast(known), "cluster"), "index", f"{name}_clusters")
        table = store.read("index", f"{name}_clusters")
        part = F.pmod(F.xxhash64(item), F.col("parts")).cast("int").alias("part")
        dealt = assigned.join(F.broadcast(table.select("cluster", "parts")), "cluster").select(item, "embedding", "cluster", part)
        store.write(dealt, "index", f"{name}_vectors")
        store.drop("index", f"{name}_assigned")
        return VectorIndex.read(store, name, item)

    @staticmethod
    def read(store: Store, name: str = "vectors", item: str = "vec_id") -> VectorIndex:
        return VectorIndex(store.read("index", f"{name}_vectors"), store.read("index", f"{name}_clusters"), item)


class _Bounds:
    """What the vectors of a cluster can score at most against unit queries.

    For a unit vector x at most r from the centre c, |q - x| >= |q - c| - r and q.x = 1 - |q - x|^2 / 2; also
    q.x <= q.c + |q| r. The smaller of the two counts; of zero vectors every score is 0.
    """

    def __init__(self, clusters: pa.Table):
        self.cluster = clusters["cluster"].to_numpy()
        self.n, self.radius = clusters["n"].to_numpy(), clusters["radius"].to_numpy()
        column = clusters["centre"].combine_chunks()
        self.centre = column.flatten().to_numpy().reshape(len(column), -1)

    def of(self, queries: np.ndarray) -> np.ndarray:
        if queries.shape[1] != self.centre.shape[1]:
            raise ValueError(f"query vectors have {queries.shape[1]} dimensions, stored ones {self.centre.shape[1]}")
        inner = queries @ self.centre.T
        size = np.linalg.norm(queries, axis=1, keepdims=True)
        square = np.maximum(size ** 2 - 2 * inner + (self.centre ** 2).sum(axis=1), 0)
        apart = np.maximum(np.sqrt(square) - self.radius, 0)
        by_distance = (1 + size ** 2 - apart ** 2) / 2
        bounds = np.minimum(by_distance, inner + size * self.radius)
        bounds[:, self.cluster == ZERO] = 0
        return bounds

    def first(self, bounds: np.ndarray, k: int) -> np.ndarray:
        """True for the clusters of the highest bounds that together hold k vectors."""
        order = np.argsort(-bounds, axis=1, kind="stable")
        before = np.cumsum(self.n[order], axis=1) - self.n[order]
        take = np.zeros(bounds.shape, bool)
        np.put_along_axis(take, order, before < k, axis=1)
        return take


def nearest(index: VectorIndex, queries: DataFrame, k: int = 3, query_bytes: int = VECTOR_BYTES) -> tuple[DataFrame, DataFrame]:
    """The k nearest vectors by exact cosine, (query_id, rank, item, score), and the visits, (query_id, cluster, n).

    ``queries`` is (query_id, embedding), a row a query; null embeddings are left out. First each query visits the
    clusters of the highest bounds that hold k vectors. Its k-th score there is a floor, and a second round visits the
    other clusters whose bound reaches it. The visits tell how many products were computed, of all queries by all vectors.

    Only visited clusters leave the index. A task holds one part of a cluster and the queries that visit it, in groups
    of about ``query_bytes`` where they are more, and hands on its k best of each query.
    """
    spark, item = queries.sparkSession, index.item

    def kept(df: DataFrame) -> DataFrame:
        path = scratch_dir(spark, "vectors")
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    asked = queries.select("query_id", "embedding").where("embedding is not null")
    query_type, item_type = asked.schema["query_id"].dataType, index.vectors.schema[item].dataType
    bounds = spark.sparkContext.broadcast(_Bounds(index.clusters.toArrow()))
    visit_names = ["query_id", "embedding", "floor", "cluster", "n"]

    def visits(choose):
        def run(batches):
            known = bounds.value
            for batch in batches:
                step = max(1, AT_ONCE // len(known.n))
                for part in (batch.slice(start, step) for start in range(0, batch.num_rows, step)):
                    rows = _unit_rows(part.column(1))
                    floor = part.column(2).to_numpy(zero_copy_only=False)
                    at, cluster = np.nonzero(choose(known, known.of(rows), floor))
                    some = max(1, VECTOR_BYTES // (64 * rows.shape[1]))
                    for own, of in ((at[i:i + some], cluster[i:i + some]) for i in range(0, len(at), some)):
                        columns = part.take(pa.array(own)).columns
                        yield pa.RecordBatch.from_arrays([*columns, pa.array(known.cluster[of]), pa.array(known.n[of])], names=visit_names)
        return run

    schema = f"query_id {query_type.simpleString()}, embedding array<double>, floor double, cluster int, n long"
    found_schema = f"query_id {query_type.simpleString()}, {item} {item_type.simpleString()}, score double"
    empty = pa.schema([("query_id", to_arrow_type(query_type)), (item, to_arrow_type(item_type)), ("score", pa.float64())])

    def product(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return empty.empty_table()
        wanted = _unit_rows(left["embedding"].combine_chunks())
        part = _Nearest(left["query_id"].combine_chunks(), wanted, k, empty.names)
        part.floor = left["floor"].to_numpy()[:, None]
        return pa.Table.from_batches([part.block(right[item].combine_chunks(), _unit_rows(right["embedding"].combine_chunks()))]).cast(empty)

    def scored(visiting: DataFrame) -> DataFrame:
        """The k best of every visited part; a cluster's queries are split into groups by their bytes."""
        weight = F.sum(F.size("embedding") * F.lit(8).cast("long"))
        loads = visiting.groupBy("cluster").agg(F.ceil(weight / query_bytes).cast("int").alias("groups"))
        loads = F.broadcast(loads.join(index.clusters.select("cluster", "parts"), "cluster"))  # a row a cluster
        of_group = F.pmod(F.xxhash64("query_id"), F.col("groups")).cast("int").alias("group")
        every = lambda count, name: F.explode(F.sequence(F.lit(0), F.col(count) - 1)).alias(name)
        left = visiting.join(loads, "cluster").select("query_id", "embedding", "floor", "cluster", of_group, every("parts", "part"))
        right = index.vectors.join(loads, "cluster").select(item, "embedding", "cluster", "part", every("groups", "group"))
        keys = ["cluster", "part", "group"]
        return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(product, found_schema)

    doubles = asked.select("query_id", F.col("embedding").cast("array<double>").alias("embedding"))
    opened = doubles.withColumn("floor", F.lit(float("-inf")))
    first = kept(opened.mapInArrow(visits(lambda known, bound, _: known.first(bound, k)), schema))
    found = kept(_top_k(scored(first), k, item))
    reached = found.where(F.col("rank") == k).select("query_id", F.round("score", 9).alias("floor"))
    lowest = F.coalesce("floor", F.lit(float("-inf"))).alias("floor")
    again = doubles.join(reached, "query_id", "left").select("query_id", "embedding", lowest)
    open_ = lambda known, bound, floor: (bound >= floor[:, None] - NEAR) & ~known.first(bound, k)
    second = kept(again.mapInArrow(visits(open_), schema))
    more = scored(second).unionByName(found.select("query_id", item, "score"))
    return _top_k(more, k, item), first.unionByName(second).select("query_id", "cluster", "n")
