"""Layered tables: where a (layer, name) pair is written and read."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from strata.settings import Settings


#: The partition of a table's file without rows.
NO_ROWS = -2


class Store:
    def __init__(self, spark: SparkSession, settings: Settings):
        self.spark = spark
        self.settings = settings

    def path(self, layer: str, name: str) -> str:
        return f"{self.settings.root.rstrip('/')}/{layer}/{name}"

    def table(self, layer: str, name: str) -> str:
        parts = [self.settings.catalog, self.settings.schema, f"{layer}_{name}"]
        return ".".join(f"`{p}`" for p in parts if p)

    @property
    def by_path(self) -> bool:
        return self.settings.mode == "path"

    def write(
        self, df: DataFrame, layer: str, name: str, mode: str = "overwrite", partition_by: Sequence[str] = ()
    ) -> None:
        writer = df.write.format(self.settings.provider).mode(mode).option("compression", "zstd")
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        if self.by_path:
            writer.save(self.path(layer, name))
        else:
            writer.saveAsTable(self.table(layer, name))

    def replace_partitions(self, df: DataFrame, layer: str, name: str, partition: str) -> None:
        """The rows of ``df`` replace the partitions they fall in; all others stay.

        Adaptive execution brings a partition's rows together and splits what is large, so there are few files.
        """
        ordered = df.select(*[c for c in df.columns if c != partition], partition).hint("rebalance", F.col(partition))
        writer = ordered.write.format(self.settings.provider).mode("overwrite").option("partitionOverwriteMode", "dynamic")
        self.with_a_file(df, layer, name, partition)
        if self.by_path:
            writer.partitionBy(partition).save(self.path(layer, name))
        elif self.spark.catalog.tableExists(self.table(layer, name)):
            writer.insertInto(self.table(layer, name))
        else:
            writer.partitionBy(partition).saveAsTable(self.table(layer, name))

    def _hadoop(self, path: str):
        hadoop_path = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return hadoop_path.getFileSystem(self.spark._jsc.hadoopConfiguration()), hadoop_path

    def with_a_file(self, df: DataFrame, layer: str, name: str, partition: str) -> None:
        """A new partitioned table gets a file without rows, so that it can be read before it has any."""
        if not self.by_path:
            return
        files, path = self._hadoop(self.path(layer, name))
        if not files.exists(path):
            columns = df.drop(partition).schema
            empty = self.spark.createDataFrame([], columns).coalesce(1)
            empty.write.format(self.settings.provider).save(f"{self.path(layer, name)}/{partition}={NO_ROWS}")

    def drop_partitions(self, layer: str, name: str, partition: str, values: Sequence[int]) -> None:
        """Remove partitions, if there are any of these."""
        for value in values:
            if self.by_path:
                files, path = self._hadoop(f"{self.path(layer, name)}/{partition}={value}")
                files.delete(path, True)
            else:
                self.spark.sql(f"alter table {self.table(layer, name)} drop if exists partition ({partition} = {value})")

    def drop(self, layer: str, name: str) -> None:
        """Remove a table, if there is one."""
        if self.by_path:
            files, path = self._hadoop(self.path(layer, name))
            files.delete(path, True)
        else:
            self.spark.sql(f"drop table if exists {self.table(layer, name)}")

    def read(self, layer: str, name: str, schema: StructType | None = None) -> DataFrame:
        """``schema`` is needed for files only where the table may be empty and partitioned: it then has no file."""
        if self.by_path:
            reader = self.spark.read.format(self.settings.provider)
            return (reader.schema(schema) if schema else reader).load(self.path(layer, name))
        return self.spark.table(self.table(layer, name))

    def append_stream(self, df: DataFrame, layer: str, name: str, checkpoint: str) -> None:
        """Append what is new in a stream and stop.

        The checkpoint remembers the files already taken, so each is landed exactly once however often this runs.
        """
        writer = (
            df.writeStream.format(self.settings.provider)
            .outputMode("append")
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
        )
        query = writer.start(self.path(layer, name)) if self.by_path else writer.toTable(self.table(layer, name))
        query.awaitTermination()
