"""New files only: a folder that grows is read as a file stream that stops when it has seen everything.

The stream's checkpoint knows which files were read, so a run lists the folder but opens new files
only. Each run's files are stored in a folder of their own; a run repeated after a failure replaces it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from martflow.operators.ledger import not_loaded
from martflow.streaming.changes import start

SOURCE_FILE = "source_file"


def new_files(
    spark: SparkSession, path: str, schema: StructType | str, files_a_batch: int | None = None, **options: str
) -> DataFrame:
    """CSV files below ``path`` as they come, with the name of each row's file. A schema must be given."""
    reader = spark.readStream.schema(schema).option("header", True).option("recursiveFileLookup", True)
    if files_a_batch:
        reader = reader.option("maxFilesPerTrigger", files_a_batch)
    return reader.options(**options).csv(path).withColumn(SOURCE_FILE, F.col("_metadata.file_path"))


def stored_rows(spark: SparkSession, target: str, schema: StructType) -> DataFrame:
    """What was stored, with the number of its batch."""
    return spark.read.schema(StructType(list(schema.fields)).add("batch", "long")).parquet(target)


def load_new_files(
    rows: DataFrame, target: str, checkpoint: str, key: str | None = None, until_done: bool = True, every: str = "1 minute"
) -> StreamingQuery:
    """Store the rows of new files as ``batch=<n>`` below ``target``.

    With ``key``, rows whose key an earlier batch stored are left out, and of rows of one batch with the
    same key one stays (of the first file, by name). Batches are numbered by the checkpoint.
    """
    schema = rows.schema

    def store(batch: DataFrame, number: int) -> None:
        if key is not None:
            others = [c for c in batch.columns if c not in (key, SOURCE_FILE)]
            first = F.min(F.struct(SOURCE_FILE, *others)).alias("_first")
            one = batch.groupBy(key).agg(first)
            batch = one.select(*[key if c == key else F.col(f"_first.`{c}`").alias(c) for c in schema.names])
            batch = batch.filter(F.col(key).isNotNull())
            if number:
                before = stored_rows(batch.sparkSession, target, schema).filter(F.col("batch") < number)
                batch = not_loaded(batch, before, key)
        batch.write.mode("overwrite").parquet(f"{target}/batch={number}")

    return start(rows.writeStream.foreachBatch(store), checkpoint, until_done, every)
