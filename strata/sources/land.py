"""Landing: scans that read every field as text, and the lineage columns each landed row carries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

CORRUPT = "_corrupt_record"
LINEAGE = ("_source_file", "_ingested_at", "_batch_id")


def string_schema(columns: Sequence[str]) -> StructType:
    return StructType([StructField(name, StringType(), True) for name in columns])


def _configured(reader, columns: Sequence[str], fmt: str):
    """The same scan for batch and stream readers. A line that is no record keeps its text in ``_corrupt_record``;
    a CSV header that differs from the declared columns is an error, not a silent swap."""
    if fmt not in ("csv", "json"):
        raise ValueError(f"extracts are csv or json, not {fmt!r}")
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    if fmt == "csv":
        options.update(header="true", enforceSchema="false")
    return reader.format(fmt).schema(string_schema([*columns, CORRUPT])).options(**options)


def with_lineage(df: DataFrame, batch_id: str) -> DataFrame:
    """Stamp the file a row came from, the time of landing and the batch, for batch and streaming frames alike."""
    return df.select(
        "*",
        F.col("_metadata.file_path").alias("_source_file"),
        F.current_timestamp().alias("_ingested_at"),
        F.lit(batch_id).alias("_batch_id"),
    )


def read_strings(spark: SparkSession, path: str, columns: Sequence[str], fmt: str, batch_id: str) -> DataFrame:
    return with_lineage(_configured(spark.read, columns, fmt).load(path), batch_id)


def stream_strings(spark: SparkSession, path: str, columns: Sequence[str], fmt: str, batch_id: str) -> DataFrame:
    """The files of a folder as a stream; ``path`` is a folder or a glob of folders."""
    return with_lineage(_configured(spark.readStream, columns, fmt).load(path), batch_id)
