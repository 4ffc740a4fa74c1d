"""Tables that a stream writes together, batch by batch, each batch once.

A micro-batch may be run again after a failure. Every table's rows of a batch
go to the table's own folder ``batch_id=<n>``, overwritten by a repeated run,
and a marker is written last; readers see committed batches only. So a batch
that failed between two tables leaves nothing behind that is read, and one
that is run again changes nothing.
"""

from __future__ import annotations

import os
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class BatchTables:
    """Tables under one folder; ``schemas`` has their columns (without batch_id)."""

    def __init__(self, spark: SparkSession, base: str, schemas: Mapping[str, str]):
        self.spark, self.base, self.schemas = spark, base, dict(schemas)

    def _fs(self):
        jvm = self.spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(self.base)
        return path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), jvm.org.apache.hadoop.fs.Path

    def folder(self, name: str, batch_id: int) -> str:
        return os.path.join(self.base, name, f"batch_id={batch_id}")

    def last_committed(self) -> int:
        """Number of the newest committed batch, -1 before the first. Batches
        come in order, so all before it are committed too."""
        fs, path = self._fs()
        root = path(os.path.join(self.base, "_commits"))
        if not fs.exists(root):
            return -1
        return max((int(s.getPath().getName()) for s in fs.listStatus(root)), default=-1)

    def read(self, name: str) -> DataFrame:
        """The table's committed rows with their batch_id (an empty frame before the first)."""
        fs, path = self._fs()
        schema = f"{self.schemas[name]}, batch_id bigint"
        last, root = self.last_committed(), os.path.join(self.base, name)
        if last < 0 or not fs.exists(path(root)):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(root).filter(F.col("batch_id") <= last)

    def write(self, name: str, batch_id: int, rows: DataFrame, by: str | None = None) -> DataFrame:
        """Write (or overwrite) a batch's rows of one table, in a folder for each
        value of ``by``; returns them read back."""
        writer = rows.write.mode("overwrite")
        (writer.partitionBy(by) if by else writer).parquet(self.folder(name, batch_id))
        return self.spark.read.schema(self.schemas[name]).parquet(self.folder(name, batch_id))

    def commit(self, batch_id: int) -> None:
        fs, path = self._fs()
        fs.create(path(os.path.join(self.base, "_commits", str(batch_id))), True).close()

    def once(self, work: Callable[[DataFrame, int], None]) -> Callable[[DataFrame, int], None]:
        """A ``foreachBatch`` function: ``work`` writes the batch's tables, then
        the batch is committed; a batch committed before is left alone."""
        def run(batch: DataFrame, batch_id: int) -> None:
            if batch_id > self.last_committed():
                work(batch, batch_id)
                self.commit(batch_id)
        return run
