"""Change feed: capture rows past a mark, publish them, consume, decode and store them.

The consumer is one streaming query per sink. Offsets live in its checkpoint, so a restart
continues where it stopped on every partition; batches are written under their batch id, so
a batch repeated after a failure replaces itself.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from martflow.functions.dates import STAMP_FORMAT, leading_date, utc_stamp
from martflow.functions.messages import as_message, is_readable, parse_message
from martflow.operators.ingest import MarkStore, fetch_since, high_water_mark
from martflow.schemas import CHANGE_MESSAGE, SALES_CHANGES

# Message fields and the columns they become.
CHANGE_NAMES = {
    "Store": "store_id",
    "Dept": "dept",
    "Date": "date",
    "Weekly_Sales": "weekly_sales",
    "IsHoliday": "isholiday",
    "last_modified": "last_modified",
}


# -- producer ------------------------------------------------------------------------


def change_messages(sales: DataFrame) -> DataFrame:
    """Rows of ``sales_changes`` shape as JSON messages with ISO-8601 texts."""
    names = {new: old for old, new in CHANGE_NAMES.items()}
    named = sales.select(*[F.col(c).alias(names[c]) for c in SALES_CHANGES.fieldNames()])
    texts = {
        "Date": F.date_format("Date", STAMP_FORMAT),
        "last_modified": F.date_format("last_modified", STAMP_FORMAT),
    }
    return as_message(named.withColumns(texts))


def capture_changes(
    table: DataFrame,
    outbox: str,
    marks: MarkStore,
    mark: str = "last_modified",
    key: str | None = None,
    start=None,
    encode: Callable[[DataFrame], DataFrame] = as_message,
    send: Callable[[DataFrame], None] | None = None,
) -> DataFrame:
    """One polling step: write the rows past the mark to a batch, send it, then move the mark.

    Rows and new mark come from the same written batch, so nothing that arrives in between
    is lost. A step that dies before the mark moves is repeated: its batch folder is named
    after the old mark and gets replaced, and its messages are sent again (``unique_changes``
    removes them). Returns the messages of the batch; without ``send`` the caller answers for them.
    """
    spark = table.sparkSession
    known = marks.load() or {"step": 0, mark: start, **({key: None} if key else {})}
    step = known["step"] + 1
    news = fetch_since(table, mark, known[mark], None, key, known.get(key) if key else None)
    folder = f"{outbox.rstrip('/')}/step={step}"
    news.write.mode("overwrite").parquet(folder)
    batch = spark.read.schema(table.schema).parquet(folder)
    messages = encode(batch)
    if send:
        send(messages)
    last = high_water_mark(batch, mark, key).first().asDict()
    if last[mark] is not None:
        marks.save(step=step, **last)
    return messages


def poll(
    spark: SparkSession, step: Callable[[], object], checkpoint: str, every: str = "5 seconds"
) -> StreamingQuery:
    """Repeat a capture step, which sends its messages itself, at every tick until stopped."""
    ticks = spark.readStream.format("rate").option("rowsPerSecond", 1).load()

    def tick(_: DataFrame, __: int) -> None:
        step()

    return start(ticks.writeStream.foreachBatch(tick), checkpoint, False, every)


# -- consumer ------------------------------------------------------------------------


def read_changes(spark: SparkSession, fmt: str, options: dict[str, str]) -> DataFrame:
    """Streaming message texts in a column ``value``.

    Kafka: all partitions of the topic from the earliest offset. ``fmt="text"`` reads
    message files, one message per line, as they arrive.
    """
    reader = spark.readStream.format(fmt)
    if fmt == "kafka":
        reader = reader.option("startingOffsets", "earliest")
    stream = reader.options(**options).load()
    return stream.select(F.col("value").cast("string").alias("value"))


def decode(messages: DataFrame, schema: StructType, value: str = "value") -> DataFrame:
    """Message texts (encoded once or twice) to typed columns; works on batch and stream."""
    return messages.select(parse_message(value, schema).alias("m")).select("m.*")


def readable(messages: DataFrame, value: str = "value") -> DataFrame:
    """The messages that are JSON objects; works on batch and stream."""
    return messages.filter(is_readable(value))


def unreadable(messages: DataFrame, value: str = "value") -> DataFrame:
    """``(value, times)``: every other message text (NULL too), with how often it came."""
    odd = messages.filter(~is_readable(value))
    return odd.groupBy(value).agg(F.count("*").alias("times"))


def decode_changes(messages: DataFrame, value: str = "value") -> DataFrame:
    """Messages to ``sales_changes`` rows. Unreadable dates and stamps become NULL."""
    rows = decode(messages, CHANGE_MESSAGE, value)
    rows = rows.withColumns(
        {"Date": leading_date("Date"), "last_modified": utc_stamp("last_modified")}
    )
    return rows.withColumnsRenamed(CHANGE_NAMES)


def without_replays(
    stream: DataFrame, keys: Sequence[str], event_time: str, delay: str = "1 day"
) -> DataFrame:
    """Drop messages sent again within the delay.

    For live feeds: a message more than ``delay`` behind the newest one is dropped as late.
    Backfills of unordered files go through ``unique_changes`` on the stored table instead.
    """
    return stream.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(list(keys))


def unique_changes(stored: DataFrame, keys: Sequence[str], mark: str) -> DataFrame:
    """The latest version of each key of a stored table, however often a message was sent.

    Versions are ordered by ``mark``, versions of one mark by their other columns. Rows without a key
    are no changes and are left out: ``unreadable`` tells of them.
    """
    others = [c for c in stored.columns if c not in (mark, *keys)]
    newest = F.max(F.struct(mark, *others)).alias("_newest")
    known = stored.dropna(subset=list(keys))
    latest = known.groupBy(*keys).agg(newest)
    return latest.select(
        *[F.col(c) if c in keys else F.col(f"_newest.`{c}`").alias(c) for c in stored.columns]
    )


def to_table(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    fmt: str = "parquet",
    until_done: bool = True,
    every: str = "5 seconds",
    mode: str = "append",
) -> StreamingQuery:
    """Store every batch in its own folder ``batch=<id>`` of a table.

    Written with ``foreachBatch`` and overwrite, so repeating a batch cannot add rows twice.
    """

    def store(batch: DataFrame, batch_id: int) -> None:
        batch.write.format(fmt).mode("overwrite").save(f"{path}/batch={batch_id}")

    writer = stream.writeStream.outputMode(mode).foreachBatch(store)
    return start(writer, checkpoint, until_done, every)


def keep_latest(
    stream: DataFrame,
    keys: Sequence[str],
    mark: str,
    path: str,
    checkpoint: str,
    until_done: bool = True,
    every: str = "5 seconds",
) -> StreamingQuery:
    """Keep the latest version of each key as keyed state, and log what each batch brought.

    The state knows the version of every key, so a batch looks at its own keys only, however long the
    table is, and a late version changes nothing. ``path`` gets the versions that hold after a batch for
    the keys it touched, as ``batch=<id>``; ``current_versions`` reads the whole table. Versions are ordered
    as in ``unique_changes``; rows without a key are left out.

    The number of state partitions is that of ``spark.sql.shuffle.partitions`` at the first start. For more
    keys than executors can hold in memory set ``spark.sql.streaming.stateStore.providerClass`` to Spark's
    RocksDB provider.
    """
    latest = unique_changes(stream, keys, mark)
    return to_table(latest, path, checkpoint, until_done=until_done, every=every, mode="update")


def current_versions(spark: SparkSession, checkpoint: str, columns: Sequence[str]) -> DataFrame:
    """The table that ``keep_latest`` keeps, read from its state: no version is compared again."""
    state = spark.read.format("statestore").option("path", checkpoint).load()
    keys = state.schema["key"].dataType.names
    return state.select(
        *[(F.col(f"key.`{c}`") if c in keys else F.col(f"value.max.`{c}`")).alias(c) for c in columns]
    )


def to_jdbc(
    stream: DataFrame,
    write: Callable[[DataFrame], None],
    done_batches: MarkStore,
    checkpoint: str,
    until_done: bool = True,
    every: str = "5 seconds",
) -> StreamingQuery:
    """Append every batch to a relational table with ``write``.

    The id of the last stored batch is kept as a mark; a batch that was stored but not yet
    committed to the checkpoint is recognised by it after a restart. A job that dies between
    ``write`` and the mark writes that batch again: let ``write`` be a transaction or an
    upsert where that matters.
    """

    def store(batch: DataFrame, batch_id: int) -> None:
        last = done_batches.load({"batch": -1})["batch"]
        if batch_id > last:
            write(batch)
            done_batches.save(batch=batch_id)

    return start(stream.writeStream.foreachBatch(store), checkpoint, until_done, every)


def to_json_files(
    stream: DataFrame, path: str, checkpoint: str, until_done: bool = True, every: str = "5 seconds"
) -> StreamingQuery:
    """JSON files with exactly-once semantics of the file sink."""
    writer = stream.writeStream.format("json").option("path", path).outputMode("append")
    return start(writer, checkpoint, until_done, every)


def start(writer, checkpoint: str, until_done: bool, every: str) -> StreamingQuery:
    writer = writer.option("checkpointLocation", checkpoint)
    writer = (
        writer.trigger(availableNow=True) if until_done else writer.trigger(processingTime=every)
    )
    return writer.start()


def stop(query: StreamingQuery) -> None:
    """Stop a query; an error it ended with is raised here instead of being lost."""
    query.stop()
    if query.exception():
        raise query.exception()
