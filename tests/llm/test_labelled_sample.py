"""The training sample is drawn from the documents at hand, whatever else is labelled."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as pipeline
from strata.llm.common import held_out, labelled_sample


def test_labels_of_other_documents_take_no_place(spark):
    docs = spark.range(200).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 10 == 0, F.lit("x" * 60)).when(F.col("id") % 10 != 1, F.lit("some text")).alias("text"))
    labels = spark.range(20_000).select(F.col("id").alias("doc_id"), (F.col("id") % 2).alias("quality"))
    usable = {r.doc_id for r in docs.where(~held_out(F.col("doc_id")) & (F.length("text") <= 50)).collect()}
    got = [r.doc_id for r in labelled_sample(docs, labels, "quality", 1000, most_chars=50).collect()]
    assert sorted(got) == sorted(usable)
    few = [r.doc_id for r in labelled_sample(docs, labels, "quality", 20, most_chars=50).collect()]
    assert len(set(few)) == len(few) == 20 and set(few) < usable


def test_nothing_to_train_on(spark, tmp_path):
    spark.createDataFrame([(10**6, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs = spark.createDataFrame([(1, "a good text", "en", "s", 11)], "doc_id long, text string, lang string, source string, n_chars long")
    with pytest.raises(ValueError, match="no labelled document"):
        pipeline.keep_good(spark, docs, str(tmp_path))
    assert pipeline.keep_good(spark, docs.where("false"), str(tmp_path)).count() == 0
