"""The table that grows by increments equals cleaning everything at once."""

import random
import statistics

import pytest
from pyspark.sql import functions as F

from martflow.operators import clean, curated

SCHEMA = "id int, who string, kind string, amount string, day string"
RULES = curated.Rules(["amount"], ["kind"], "day", ["id"], ["who"])


def some(seed, n=240):
    rng = random.Random(seed)
    rows = [
        (
            i,
            rng.choice(["a", "b", "c", None]),
            rng.choice(["x", "y", "NA", None]),
            rng.choice(["1", "2.5", "NA", "nonsense", "40"]),
            rng.choice([None, "na", f"2024-01-{rng.randrange(10, 28)}"]),
        )
        for i in range(n)
    ]
    return rows


def once(spark, rows, rules=RULES):
    df = spark.createDataFrame(rows, SCHEMA)
    return clean.clean_impute(df, rules.numeric, rules.categorical, rules.date, rules.order_by, rules.partition_by)


def rounded(rows, df):
    return rows(df.withColumn("amount", F.round("amount", 9)))


def grown(spark, path, parts, rules=RULES):
    df = spark.createDataFrame([], SCHEMA)
    store = curated.Curated(spark, str(path), df.schema, rules)
    added = [store.append(spark.createDataFrame(p, SCHEMA)) for p in parts]
    return store, added


@pytest.mark.parametrize("seed,order", [(1, "mixed"), (3, "backwards")])
def test_increments_equal_one_pass(spark, tmp_path, rows, seed, order):
    found = some(seed)
    if order == "mixed":
        random.Random(seed).shuffle(found)
    if order == "backwards":
        found.reverse()
    parts = [found[:90], found[90:150], [], found[150:] + found[40:60] + found[200:210]]
    store, added = grown(spark, tmp_path / "t", parts)
    assert added == [90, 60, 0, 90]
    assert rounded(rows, store.read()) == rounded(rows, once(spark, found))


def test_without_groups_late_rows_find_the_date_before_them(spark, tmp_path, rows):
    rules = curated.Rules((), (), "day", ["id"])
    found = [(1, None, None, None, "2024-01-01"), (5, None, None, None, "2024-01-05"), (9, None, None, None, None)]
    late = [(3, None, None, None, None), (7, None, None, None, "2024-01-07")]
    store, _ = grown(spark, tmp_path / "t", [found, late], rules)
    got = {r.id: r.day.day for r in store.read().collect()}
    assert got == {1: 1, 3: 1, 5: 5, 7: 7, 9: 7}


def test_numbers_are_merged(spark, tmp_path):
    found = some(9)
    store, _ = grown(spark, tmp_path / "t", [found[:50], found[50:51], found[51:]])
    known = [float(r[3]) for r in found if r[3] not in ("NA", "nonsense")]
    m = store._moments(store.marks.load())["amount"]
    assert m.n == len(known) and m.mean == pytest.approx(statistics.mean(known))
    assert m.bounds(1)[1] - m.mean == pytest.approx(statistics.stdev(known))
    kept = store.read(outliers=1.0).count()
    low, high = m.bounds(1)
    assert kept == sum(low <= (float(r[3]) if r[3] not in ("NA", "nonsense") else m.mean) <= high for r in found)


def test_a_step_that_died_counts_for_nothing(spark, tmp_path, rows, monkeypatch):
    found = some(4)
    store, _ = grown(spark, tmp_path / "t", [found[:100]])
    before = rounded(rows, store.read())
    with monkeypatch.context() as m:
        m.setattr(curated.Curated, "_store_dates", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            store.append(spark.createDataFrame(found[100:], SCHEMA))
    assert rounded(rows, store.read()) == before
    assert store.append(spark.createDataFrame(found[100:], SCHEMA)) == 140
    assert rounded(rows, store.read()) == rounded(rows, once(spark, found))


def test_an_empty_table_and_rules_without_dates(spark, tmp_path, rows):
    store, _ = grown(spark, tmp_path / "t", [])
    assert store.read().count() == 0
    rules = curated.Rules(["amount"], ["kind"])
    found = some(6)
    store, _ = grown(spark, tmp_path / "u", [[], found[:20], found[10:]], rules)
    want = clean.clean_impute(spark.createDataFrame(found, SCHEMA), ["amount"], ["kind"])
    assert rounded(rows, store.read()) == rounded(rows, want)


def test_reading_scans_the_rows_once_and_moves_nothing(spark, tmp_path):
    store, _ = grown(spark, tmp_path / "t", [some(7)[:100], some(7)[100:]])
    text = store.read()._jdf.queryExecution().executedPlan().toString()
    assert text.count("FileScan") == 2 and "Exchange" not in text  # the rows, and those without a date
    assert text.count("/rows") == 1


def test_stored_rows_beside_an_increment_are_not_read(spark, tmp_path):
    """Rows in order: the look for copies is cut down to ids of the increment by the file statistics."""
    store, _ = grown(spark, tmp_path / "t", [some(8)[:100]])
    near = store._rows(0).filter(F.col("id").between(100, 200))
    text = near._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(id,100)" in text and "LessThanOrEqual(id,200)" in text
