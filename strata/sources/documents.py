"""Document folders and the golden question files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

GOLDEN_SCHEMA = (
    "id string, type string, question string, expected_values array<string>, expected_doc string"
)


def read_documents(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, text) of every Markdown file; the id is the file name without its suffix."""
    files = spark.read.text(folder, wholetext=True, pathGlobFilter="*.md")
    return files.select(
        F.regexp_replace(F.col("_metadata.file_name"), r"\.md$", "").alias("doc_id"), F.col("value").alias("text")
    )


def read_golden(spark: SparkSession, path: str) -> DataFrame:
    """Golden questions from JSON lines; blank lines are skipped, a broken line is an error."""
    return spark.read.schema(GOLDEN_SCHEMA).option("mode", "FAILFAST").json(path)


def write_golden(golden: DataFrame, path: str) -> None:
    golden.select("id", "type", "question", "expected_values", "expected_doc").write.mode("overwrite").json(path)
