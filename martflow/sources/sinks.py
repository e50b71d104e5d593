"""File and message sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame

from martflow.functions.messages import as_message
from martflow.session import materialize


def write_csv(
    df: DataFrame,
    path: str,
    mode: str = "errorifexists",
    header: bool = True,
    single_file: bool = False,
    separator: str = ",",
) -> None:
    """CSV folder. ``single_file`` sends all rows through one task: small results only."""
    out = df.coalesce(1) if single_file else df
    out.write.mode(mode).option("header", header).option("sep", separator).csv(path)


def write_csv_if_any(df: DataFrame, path: str, **kwargs) -> bool:
    """Replace the folder unless there is nothing to write; tells whether it wrote.

    The rows are computed once: they are stored first, and the folder is replaced from there, so
    that rows may also come from the folder itself.
    """
    rows = materialize(df, "csv")
    if rows.isEmpty():
        return False
    write_csv(rows, path, mode="overwrite", **kwargs)
    return True


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).json(path)


def publish(df: DataFrame, fmt: str = "kafka", **options: str) -> None:
    """Send every row as one JSON message, straight from the executors.

    ``fmt="kafka"`` needs ``kafka.bootstrap.servers`` and ``topic``; ``fmt="text"`` with
    ``path`` appends the same messages to files.
    """
    writer = as_message(df).write.format(fmt).options(**options)
    (writer.mode("append") if fmt != "kafka" else writer).save()

