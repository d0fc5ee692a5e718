"""A corpus pipeline: quality, SimHash near-duplicates, benchmark passages, secrets, tokens.

Each stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept. All but the last return the columns
of ``documents``; ``run`` writes every stage's rows and reads them again for the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import bpe, decontam, quality, secrets, simhash
from strata.llm.common import table, written
from strata.llm.queries import WORD_BPE

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: Models and fingerprints have no SQL counterpart; tests compare the stages with brute force.
ORACLE_SQL = None


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts. It is trained on the labelled ones among the incoming documents.

    Without any of those it is an error: an untrained model would drop every document.
    """
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    if not model.rows and not docs.isEmpty():
        raise ValueError("no labelled document to train the quality classifier on")
    return quality.score(docs, model).where(F.col("predicted") == 1).select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: the one with the smallest doc_id.

    Three-word shingles and fingerprints at most two bits apart, as in op8_simhash.
    """
    return simhash.keep_one(docs).select(*COLUMNS)


def drop_benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of a benchmark item."""
    found = decontam.decontaminate(docs, table(spark, sf_dir, "benchmark"))
    return found.where(~F.col("contaminated")).select(*COLUMNS)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with the secrets in their texts masked and ``n_chars`` as the new length."""
    masked = secrets.redacted(secrets.scan(docs, secrets.cuts(docs)))
    changed = F.size("found") > 0
    return masked.withColumn("n_chars", F.when(changed, F.length("text").cast("long")).otherwise(F.col("n_chars"))).select(*COLUMNS)


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id with the token ids of the whole text, their number, and digests of the ids and of the text decoded from them."""
    encoded = bpe.round_trip(docs.select("doc_id", "text"), WORD_BPE, with_ids=True)
    return encoded.select("doc_id", "ids", "n_tokens", "ids_sha256", "decoded_sha256")


STAGES = [
    ("quality classifier", keep_good),
    ("SimHash near-dedup", drop_near_duplicates),
    ("benchmark decontamination", drop_benchmark_passages),
    ("secret scan", mask_secrets),
    ("BPE encoding", encode_tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(*COLUMNS)
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), "pipeline")
    return docs
