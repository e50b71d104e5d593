"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import pickle

from pyspark import Broadcast, cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martflow.session import materialize, run_folder

__all__ = [
    "bound_batches",
    "fresh",
    "materialize",
    "places",
    "received",
    "remainder",
    "run_folder",
    "sent",
    "table",
    "utf8",
]

def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One of the given tables, whole."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have, whatever its case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def remainder(key: Column, parts: int) -> Column:
    """crc32 of the key as text, modulo ``parts`` (a null key counts as 0)."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % F.lit(parts), F.lit(0).cast("long"))


def utf8(text: Column) -> Column:
    """The text's bytes; null stays null."""
    return text.cast("string").cast("binary")


def places(n: int) -> list[str]:
    """Names for the columns of a task's result, which Spark takes by place."""
    return [f"c{i}" for i in range(n)]


def bound_batches(spark: SparkSession, rows: int = 1_000) -> None:
    """Texts are large rows: have at most ``rows`` of them in what a task is handed at once.

    Spark's default of 10,000 rows holds tens of megabytes several times over, in the executor and in
    the task. The setting stays for the session; a smaller one of its own is left as it is.
    """
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= rows:
        spark.conf.set(name, str(rows))


def sent(spark: SparkSession, value: object) -> Broadcast:
    """``value`` for every executor, classes included. Callers state why its size is bounded."""
    bound_batches(spark)
    return spark.sparkContext.broadcast(cloudpickle.dumps(value))


def received(shared: Broadcast):
    return pickle.loads(shared.value)
