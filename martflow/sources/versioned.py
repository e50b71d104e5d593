"""Replacing a stored table as a whole: the new rows are written beside the old ones, then a pointer moves.

A reader sees all old rows or all new ones. A writer that fails leaves the pointer where it was, and what it
left behind is never read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from martflow.operators.ingest import MarkStore


class VersionedTable:
    """Rows in folders ``data/run=<n>`` below ``path``; ``pointer`` tells which one holds.

    The pointer is a one-row file that appears in one step, after all rows are there.
    """

    def __init__(self, spark: SparkSession, path: str, schema: StructType, fmt: str = "parquet", **options: str):
        self.spark, self.path, self.schema, self.fmt, self.options = spark, path.rstrip("/"), schema, fmt, options
        self.pointer = MarkStore(spark, f"{self.path}/pointer", "run bigint")

    def _folder(self, run: int) -> str:
        return f"{self.path}/data/run={run}"

    def _write(self, rows: DataFrame) -> int:
        known = self.pointer.load()
        run = 0 if known is None else known["run"] + 1
        named = rows.select(*[f"`{c}`" for c in self.schema.fieldNames()])
        named.write.mode("overwrite").format(self.fmt).options(**self.options).save(self._folder(run))
        return run

    def replace(self, rows: DataFrame) -> None:
        """Put ``rows`` (by column name) in the place of what is stored. They may come from the table itself."""
        self.pointer.save(run=self._write(rows))

    def replace_if_any(self, rows: DataFrame) -> bool:
        """The same, but no rows at all leave the table as it is. Tells whether it was replaced."""
        run = self._write(rows)
        if self._at(run).isEmpty():
            return False
        self.pointer.save(run=run)
        return True

    def _at(self, run: int) -> DataFrame:
        return self.spark.read.format(self.fmt).schema(self.schema).options(**self.options).load(self._folder(run))

    def read(self) -> DataFrame:
        known = self.pointer.load()
        if known is None:
            return self.spark.createDataFrame([], self.schema)
        return self._at(known["run"])


def replace_partitions(rows: DataFrame, path: str, partition_by: Sequence[str]) -> None:
    """Replace the partitions that ``rows`` has, and no others (each file of one appears whole or not at all)."""
    writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*partition_by).parquet(path)
