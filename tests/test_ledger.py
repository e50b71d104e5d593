"""Loaded keys by range, late keys, and files that are read once."""

import pytest
from pyspark.sql import functions as F

from martflow.operators import ingest, ledger
from martflow.sources import sinks
from martflow.streaming import discovery


def ids(df, c="id"):
    return sorted(r[0] for r in df.select(c).collect())


@pytest.fixture
def job(spark, tmp_path):
    """A source file, its stored table and a run of the incremental job over them."""
    target, schema = str(tmp_path / "target"), "id bigint, v string, last_modified timestamp"
    spark.createDataFrame([], schema).write.parquet(target)
    marks = ingest.MarkStore(spark, str(tmp_path / "marks"), "last_modified timestamp, id bigint")
    known = ledger.Ledger(spark, str(tmp_path / "ledger"), "id", width=10)

    def stored():
        return spark.read.schema(schema).parquet(target)

    def append(df):
        df.select("id", "v", "last_modified").write.mode("append").parquet(target)

    def run(keys, append=append, with_ledger=True):
        source = spark.createDataFrame([(k, f"v{k}") for k in keys], "id bigint, v string")
        sinks.write_csv(source, str(tmp_path / "src"), "overwrite")
        feed = ingest.Feed(
            "t", str(tmp_path / "src"), stored, append, str(tmp_path / "x"), ["id"], marks=marks,
            ledger=known if with_ledger else None,
        )
        return ingest.run_incremental(spark, [feed])["t"]

    return run, stored, append, known


@pytest.mark.parametrize("with_ledger", [True, False])
def test_late_keys_are_loaded(job, with_ledger):
    run, stored, _, _ = job
    assert run([5, 50, 51, 90], with_ledger=with_ledger)
    assert run([1, 5, 50, 51, 52, 90, -7], with_ledger=with_ledger)
    assert not run([1, 5, 50, 51, 52, 90, -7], with_ledger=with_ledger)
    assert ids(stored()) == [-7, 1, 5, 50, 51, 52, 90]


def test_only_ranges_that_differ_are_open(spark, job):
    run, stored, _, known = job
    run(range(100))
    source = spark.createDataFrame([(k,) for k in [*range(100), 100, 205]], "id bigint")
    opened = known.open_spans(source)
    assert ids(opened, "span") == [10, 20]
    near = ledger.in_spans(stored(), "id", opened, 10)
    text = near._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(id,100)" in text and near.count() == 0


def test_a_run_that_died_after_the_append_adds_nothing_twice(job):
    run, stored, append, known = job
    run([1, 2, 3])

    def stop_after(df):
        append(df)
        raise RuntimeError("stopped")

    with pytest.raises(RuntimeError):
        run([1, 2, 3, 4, 40], stop_after)
    assert run([1, 2, 3, 4, 40])  # extracts what the first try stored
    assert ids(stored()) == [1, 2, 3, 4, 40]
    assert sum(r["keys"] for r in known.load().collect()) == 5


def test_stamps_must_grow(spark, tmp_path, job):
    from datetime import datetime

    marks = ingest.MarkStore(spark, str(tmp_path / "m"), "last_modified timestamp, id bigint")
    marks.save(last_modified=datetime(2024, 1, 1), id=4)
    _, stored, append, _ = job
    feed = ingest.Feed("t", "nowhere", stored, append, str(tmp_path / "x"), ["id"], marks=marks)
    with pytest.raises(ValueError):
        ingest.run_incremental(spark, [feed], datetime(2024, 1, 1))


def test_keys_of_other_kinds_and_rows_without_one(spark):
    source = spark.createDataFrame([("a", 1), ("b", 2), (None, 3), ("c", 4)], "k string, v int")
    stored = spark.createDataFrame([("a",), (None,)], "k string")
    opened = ledger.spans(source, "k").select("span")
    assert ids(ledger.not_loaded(source, stored, "k", opened), "v") == [2, 4]
    assert ids(ledger.not_loaded(source, stored, "k"), "v") == [2, 4]
    extreme = spark.createDataFrame([(2**63 - 1,), (-(2**63),)], "id bigint")
    assert ledger.spans(extreme, "id").count() == 2


@pytest.mark.parametrize("spread", [1, 3])
def test_islands(spark, spread):
    opened = spark.range(0, 100 * spread, spread).withColumnRenamed("id", "span")
    assert ledger.islands(opened) == ([(0, 99)] if spread == 1 else None)


def test_files_are_read_once(spark, tmp_path, monkeypatch):
    """Each run sees the rows of new files only; keys of earlier batches stay out, late ones come in."""
    source, target, checkpoint = (str(tmp_path / n) for n in ("source", "target", "checkpoint"))
    schema = "id bigint, v string"

    def run(name, *keys):
        if keys:
            sinks.write_csv(spark.createDataFrame([(k, name) for k in keys], schema).coalesce(1), f"{source}/{name}")
        query = discovery.load_new_files(discovery.new_files(spark, source, schema), target, checkpoint, "id")
        query.awaitTermination()
        return sum(p["numInputRows"] for p in query.recentProgress)

    assert run("one", 10, 20, 30) == 3
    assert run("two", 5, 20, 20, 25, None) == 5
    assert run("three") == 0
    assert run("four", 1) == 1
    stored = discovery.stored_rows(spark, target, discovery.new_files(spark, source, schema).schema)
    got = {r.id: (r.v, r.batch) for r in stored.collect()}
    assert got == {10: ("one", 0), 20: ("one", 0), 30: ("one", 0), 5: ("two", 1), 25: ("two", 1), 1: ("four", 2)}
    assert stored.select(F.countDistinct(discovery.SOURCE_FILE)).first()[0] == 3
