"""Change feed: decode, store, stop and restart, capture."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from martflow.operators.ingest import MarkStore
from martflow.streaming import changes

ONCE = '{"Store":1,"Dept":2,"Date":"2010-02-05T00:00:00.000Z","Weekly_Sales":1.5,"IsHoliday":true,"last_modified":"2024-10-22T01:02:03.400Z"}'
TWICE = '"' + ONCE.replace('"', '\\"').replace(":1,", ":3,") + '"'
PARTIAL = '{"Store":4,"Date":"nonsense"}'
BROKEN = "{not json"


def test_decode_changes(spark, rows):
    df = spark.createDataFrame([(m,) for m in (ONCE, TWICE, PARTIAL, BROKEN)], "value string")
    stamp = datetime(2024, 10, 22, 1, 2, 3, 400000)
    assert rows(changes.decode_changes(df)) == [
        (1, 2, date(2010, 2, 5), 1.5, True, stamp),
        (3, 2, date(2010, 2, 5), 1.5, True, stamp),
        (4, None, None, None, None, None),
        (None, None, None, None, None, None),
    ]


def test_messages_survive_the_round_trip(spark, rows):
    df = spark.createDataFrame([(ONCE,)], "value string")
    decoded = changes.decode_changes(df)
    assert rows(changes.decode_changes(changes.change_messages(decoded))) == rows(decoded)


@pytest.fixture
def feed(tmp_path):
    folder = tmp_path / "feed"
    folder.mkdir()

    def add(name, *messages):
        (folder / name).write_text("\n".join(messages) + "\n")

    return str(folder), add


def test_restart_adds_no_row_twice(spark, feed, tmp_path):
    folder, add = feed
    table, checkpoint = str(tmp_path / "table"), str(tmp_path / "checkpoint")

    def run():
        stream = changes.decode_changes(changes.read_changes(spark, "text", {"path": folder}))
        query = changes.to_table(stream, table, checkpoint)
        query.awaitTermination()
        changes.stop(query)
        return spark.read.parquet(table)

    add("a.txt", ONCE, TWICE)
    assert run().count() == 2
    assert run().count() == 2
    add("b.txt", ONCE, PARTIAL)  # the first message sent again
    assert run().count() == 4
    assert changes.unique_changes(run(), ["store_id"], "last_modified").count() == 3


def test_the_latest_version_of_a_key_stays(spark, rows):
    stored = spark.createDataFrame(
        [(1, 5, "new"), (1, 3, "old"), (1, 5, "new"), (2, None, "x"), (None, 9, "lost")], "k int, m int, v string"
    )
    assert rows(changes.unique_changes(stored, ["k"], "m")) == [(1, 5, "new"), (2, None, "x")]


def test_unreadable_messages_are_kept_apart(spark, rows):
    texts = [ONCE, TWICE, PARTIAL, BROKEN, BROKEN, "", "7", '"text"', None]
    df = spark.createDataFrame([(m,) for m in texts], "value string")
    assert rows(changes.readable(df)) == sorted([(ONCE,), (TWICE,), (PARTIAL,)])
    assert rows(changes.unreadable(df)) == [("", 1), ('"text"', 1), ("7", 1), (BROKEN, 2), (None, 1)]


@pytest.mark.parametrize("digits", ["4", "40", "400000", "4000000"])
def test_stamps_have_one_to_six_digits(spark, digits):
    text = ONCE.replace(".400Z", f".{digits}Z")
    got = changes.decode_changes(spark.createDataFrame([(text,)], "value string")).first().last_modified
    assert got == (None if len(digits) > 6 else datetime(2024, 10, 22, 1, 2, 3, 400000))


def test_stamps_do_not_depend_on_the_session_zone(spark):
    df = changes.decode_changes(spark.createDataFrame([(ONCE,)], "value string")).selectExpr("unix_micros(last_modified)")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert df.first()[0] == 1_729_558_923_400_000
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_json_sink_appends(spark, feed, tmp_path):
    folder, add = feed
    out, checkpoint = str(tmp_path / "json"), str(tmp_path / "checkpoint")
    for name in ("a.txt", "b.txt"):
        add(name, ONCE)
        stream = changes.decode_changes(changes.read_changes(spark, "text", {"path": folder}))
        changes.to_json_files(stream, out, checkpoint).awaitTermination()
    assert spark.read.json(out).count() == 2


def test_repeated_batch_is_not_stored_again(spark, feed, tmp_path):
    folder, add = feed
    add("a.txt", ONCE)
    stored = []
    marks = MarkStore(spark, str(tmp_path / "batches"), "batch bigint")

    def run(checkpoint):
        stream = changes.decode_changes(changes.read_changes(spark, "text", {"path": folder}))
        changes.to_jdbc(
            stream, lambda df: stored.append(df.count()), marks, str(tmp_path / checkpoint)
        ).awaitTermination()

    run("one")
    run("two")  # a lost commit: batch 0 comes again
    assert stored == [1]


def test_replays_are_dropped_within_the_delay(spark, feed, tmp_path):
    folder, add = feed
    add("a.txt", ONCE, ONCE, TWICE)
    stream = changes.decode_changes(changes.read_changes(spark, "text", {"path": folder}))
    unique = changes.without_replays(stream, ["store_id", "dept", "date"], "last_modified")
    changes.to_table(unique, str(tmp_path / "t"), str(tmp_path / "c")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "t")).count() == 2


def test_a_failing_sink_is_reported(spark, feed, tmp_path):
    folder, add = feed
    add("a.txt", ONCE)

    def fail(df):
        raise RuntimeError("database is away")

    stream = changes.decode_changes(changes.read_changes(spark, "text", {"path": folder}))
    marks = MarkStore(spark, str(tmp_path / "batches"), "batch bigint")
    query = changes.to_jdbc(stream, fail, marks, str(tmp_path / "c"))
    with pytest.raises(Exception, match="database is away"):
        query.awaitTermination()
    with pytest.raises(Exception):
        changes.stop(query)


def test_capture_moves_the_mark_with_the_rows(spark, tmp_path):
    def table(n):
        return spark.range(n).select(
            "id", (F.lit("2024-01-01").cast("timestamp") + F.make_dt_interval(hours=F.col("id").cast("int"))).alias("last_modified")
        )

    marks = MarkStore(spark, str(tmp_path / "marks"), "step int, last_modified timestamp, id bigint")

    def step(n):
        sent = changes.capture_changes(
            table(n), str(tmp_path / "outbox"), marks, key="id", start=datetime(2024, 1, 1, 1)
        )
        return sorted(r.id for r in changes.decode(sent, "id bigint").collect())

    assert step(4) == [2, 3]  # from the start mark on
    assert step(4) == []
    assert step(6) == [4, 5]
    assert marks.load()["id"] == 5


def test_a_batch_that_was_not_sent_comes_again(spark, tmp_path):
    table = spark.range(3).select("id", F.lit("2024-01-01").cast("timestamp").alias("last_modified"))
    marks = MarkStore(spark, str(tmp_path / "marks"), "step int, last_modified timestamp, id bigint")

    def step(send):
        changes.capture_changes(table, str(tmp_path / "outbox"), marks, key="id", send=send)

    def fail(messages):
        raise RuntimeError("receiver is away")

    with pytest.raises(RuntimeError):
        step(fail)
    sent = []
    for _ in range(2):
        step(lambda messages: sent.append(messages.count()))
    assert sent == [3, 0]


def test_polling_sends_each_change_once(spark, tmp_path):
    import time

    table = spark.range(3).select("id", F.lit("2024-01-01").cast("timestamp").alias("last_modified"))
    marks = MarkStore(spark, str(tmp_path / "marks"), "step int, last_modified timestamp, id bigint")
    sent = []
    query = changes.poll(
        spark,
        lambda: changes.capture_changes(
            table, str(tmp_path / "outbox"), marks, key="id", send=lambda m: sent.append(m.count())
        ),
        str(tmp_path / "c"),
        every="1 second",
    )
    try:
        for _ in range(300):
            if len(sent) >= 2:
                break
            time.sleep(0.2)
    finally:
        changes.stop(query)
    assert sum(sent) == 3 and sent[0] == 3


def message(k, day, store):
    stamp = f"2024-10-{day:02}T00:00:00.000Z"
    return ONCE.replace('"Store":1', f'"Store":{store}').replace('"Dept":2', f'"Dept":{k}').replace("2024-10-22T01:02:03.400Z", stamp)


def test_versions_are_kept_by_key(spark, feed, tmp_path, rows):
    """Late and repeated versions change nothing; a batch looks at the state of its own keys only."""
    folder, add = feed
    log, checkpoint = str(tmp_path / "log"), str(tmp_path / "checkpoint")

    def run():
        stream = changes.decode_changes(changes.read_changes(spark, "text", {"path": folder}))
        query = changes.keep_latest(stream, ["dept"], "last_modified", log, checkpoint)
        query.awaitTermination()
        changes.stop(query)
        return [s["numRowsUpdated"] for p in query.recentProgress for s in p["stateOperators"]]

    def current():
        found = changes.current_versions(spark, checkpoint, ["dept", "store_id", "last_modified"])
        return {r.dept: (r.store_id, r.last_modified.day) for r in found.collect()}

    add("a.txt", *[message(k, 5, 1) for k in range(200)], PARTIAL)
    assert sum(run()) == 200
    add("b.txt", message(3, 4, 2), message(4, 6, 3), message(4, 5, 9), message(900, 1, 4))
    assert sum(run()) == 3
    assert run() in ([], [0])
    got = current()
    assert len(got) == 201 and got[3] == (1, 5) and got[4] == (3, 6) and got[900] == (4, 1)
    logged = spark.read.parquet(log).filter("batch > 0").select("dept", "store_id")
    assert rows(logged) == [(3, 1), (4, 3), (900, 4)]
