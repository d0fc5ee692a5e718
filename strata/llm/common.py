"""Helpers that the operators of this package share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.session import scratch_dir

#: Bytes of text that a task takes apart at a time; a longer text makes a slice of its own.
SLICE_BYTES = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` as a Parquet table below the shared scratch folder; later work starts from the files."""
    path = scratch_dir(df.sparkSession, purpose)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def slices(texts: pa.Array, limit: int = SLICE_BYTES) -> Iterator[list[str]]:
    """The texts in order, null as empty, in lists of about ``limit`` bytes."""
    some, size = [], 0
    for value in texts:
        text = value.as_py() or ""
        some.append(text)
        size += len(text) + 64
        if size >= limit:
            yield some
            some, size = [], 0
    if some:
        yield some


def per_text(kind: str | T.DataType, make: Callable[[], Callable[[list[str]], list[pa.Array]]], limit: int = SLICE_BYTES):
    """A column function over text: ``make`` runs once in a task and gives the function of a slice of texts.

    That function returns the fields of the result struct as arrays. Spark evaluates the column once for each row.
    """
    kind = T._parse_datatype_string(kind) if isinstance(kind, str) else kind
    names = kind.fieldNames()

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        work = make()
        for texts in batches:
            parts = [pa.StructArray.from_arrays(work(some), names=names) for some in slices(texts, limit)]
            yield pa.chunked_array(parts).combine_chunks() if len(parts) > 1 else parts[0] if parts else _none(kind)

    # The annotations are read by Spark at run time, so they cannot stay strings.
    run.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(run, kind).asNondeterministic()


def _none(kind: T.StructType) -> pa.Array:
    from pyspark.sql.pandas.types import to_arrow_type

    return pa.array([], to_arrow_type(kind))


def with_fields(df: DataFrame, struct: Column, fields: list[str]) -> DataFrame:
    """``df`` with the fields of a struct column; a column of the same name is replaced."""
    inner = "_fields_of_result"
    kept = [c for c in df.columns if c.lower() not in {f.lower() for f in fields}]
    return df.withColumn(inner, struct).select(*[F.col(f"`{c}`") for c in kept], *[F.col(inner)[f].alias(f) for f in fields])


def free_names(columns: list[str], *stems: str) -> list[str]:
    """A column name for each stem that none of ``columns`` has, whatever their case."""
    taken, mark = {c.lower() for c in columns}, "_"
    while any(f"{mark}{stem}".lower() in taken for stem in stems):
        mark += "_"
    return [f"{mark}{stem}" for stem in stems]


def ordered(kind: T.DataType) -> bool:
    """True if values of this type have an order in Spark."""
    if isinstance(kind, T.StructType):
        return all(ordered(f.dataType) for f in kind.fields)
    return ordered(kind.elementType) if isinstance(kind, T.ArrayType) else not isinstance(kind, (T.MapType, T.VariantType))


#: Keys that ``spread_join`` deals over several tasks: at most so many, of at least so many rows each, in so many shares.
HOT_KEYS, HOT_ROWS, SALTS = 10_000, 64, 64


def spread_join(many: DataFrame, one: DataFrame, keys: list[str], vary: list[str], how: str = "inner") -> DataFrame:
    """``many`` joined with ``one``, which has at most one row for each key; no key's rows stay in one task.

    The most frequent keys of ``many`` are dealt by ``vary`` and their rows of ``one`` repeated for each share. The list
    of those keys is broadcast; its size is fixed, and a key outside it has less than 1 / ``HOT_KEYS`` of all rows.
    """
    mark, salt = free_names([*many.columns, *one.columns], "hot", "salt")
    counts = many.groupBy(*keys).agg(F.count(F.lit(1)).alias(mark)).where(F.col(mark) >= HOT_ROWS)
    hot = written(counts.orderBy(F.col(mark).desc(), *keys).limit(HOT_KEYS).select(*keys, F.lit(True).alias(mark)), "hot")
    share = F.when(F.col(mark), F.pmod(F.xxhash64(*vary), F.lit(SALTS)).cast("int")).otherwise(0)
    dealt = many.join(F.broadcast(hot), keys, "left").withColumn(salt, share).drop(mark)
    shares = F.when(F.col(mark), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    repeated = one.join(F.broadcast(hot), keys, "left").withColumn(salt, F.explode(shares)).drop(mark)
    return dealt.join(repeated, [*keys, salt], how).drop(salt)


def held_out(doc_id: Column) -> Column:
    """True for the quarter of rows whose labels no model may see; false for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


#: Longer texts are not learnt from, so that the sample's size is bounded as well as its number of rows.
SAMPLE_CHARS = 50_000


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, bound: int, columns: tuple[str, ...] = (), most_chars: int = SAMPLE_CHARS) -> DataFrame:
    """(doc_id, text, further columns, label) of at most ``bound`` labelled ids that are not held out, chosen by hash.

    Only ids of documents that can be learnt from are counted, whatever else is labelled. Rows with a null id, text or label and texts of over ``most_chars`` characters are left out. A repeated label row
    counts once with its largest label; repeated rows of a document are reduced to one by the caller's aggregation.
    """
    usable = docs.select("doc_id", "text", *columns).where(F.length("text") <= most_chars)
    ids = (
        labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy("doc_id").agg(F.max(label).cast("int").alias("label"))
        .join(usable.select("doc_id"), "doc_id", "left_semi")
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(bound)
    )
    return usable.join(F.broadcast(ids), "doc_id")
