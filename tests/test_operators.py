"""Picks, buckets, mapping, cleaning and quality."""

import random
from collections import Counter
from datetime import date

import pytest
from pyspark.sql import functions as F

from martflow.operators import buckets, clean, picks, quality
from martflow.operators.mapping import apply_mapping, typed


def test_nth_and_leaders(spark, rows):
    df = spark.createDataFrame(
        [("a", 3, 1), ("a", 3, 2), ("a", 1, 3), ("b", 5, 4)], "g string, v int, id int"
    )
    order = [F.desc("v"), F.asc("id")]
    assert rows(picks.nth_per_group(df, ["g"], order, 2)) == [("a", 3, 2)]  # b has no second
    assert rows(picks.leaders_per_group(df, ["g"], [F.desc("v")])) == [
        ("a", 3, 1),
        ("a", 3, 2),
        ("b", 5, 4),
    ]
    assert rows(picks.top_k(df, [F.desc("v"), F.asc("id")], 2)) == [("a", 3, 1), ("b", 5, 4)]


@pytest.mark.parametrize("parts", [1, 3, 7])
def test_dense_ids_number_a_skewed_table_without_gaps(spark, parts):
    rng = random.Random(5)
    data = {(1 if rng.random() < 0.4 else rng.randint(2, 30), rng.randint(0, 10_000)) for _ in range(600)}
    data |= {(None, n) for n in range(7)}
    df = spark.createDataFrame(list(data), "s int, n int")
    got = buckets.dense_ids(df, ["s", "n"], "id", start_after=10, parts=parts).collect()
    ordered = sorted(data, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    assert {(r.s, r.n): r.id for r in got} == {k: i + 11 for i, k in enumerate(ordered)}


@pytest.mark.parametrize("order", ["day", "number"])
def test_ranges_follow_the_rows_whatever_their_values(spark, order):
    """Dates of some years, and numbers spread over 64 bits, both come in ranges of about the same size."""
    df = spark.range(4000).select(
        F.expr("date_add(DATE '1990-01-01', cast(id as int) % 4000)").alias("day"),
        F.xxhash64("id").alias("number"),
    )
    sizes = [r[1] for r in buckets.ranged(df, [order], "sizes", 8).groupBy("_part").count().collect()]
    assert len(sizes) == 8 and max(sizes) < 3 * min(sizes)
    ids = buckets.dense_ids(df, [order], "id", parts=8).orderBy(order).collect()
    assert [r.id for r in ids] == list(range(1, 4001))


@pytest.mark.parametrize("parts", [1, 5])
@pytest.mark.parametrize("by", [["k"], []])
def test_forward_fill_across_ranges(spark, by, parts):
    rng = random.Random(2)
    keys = ["hot"] * 6 + ["b", None]
    data = [
        (rng.choice(keys), n, rng.randint(1, 99) if rng.random() < 0.08 else None)
        for n in range(800)
    ]
    df = spark.createDataFrame(data, "k string, n int, v int")
    got = buckets.forward_fill(df, "v", ["n"], by, parts)
    last, want = {}, {}
    for k, n, v in data:
        group = k if by else 0
        last[group] = v if v is not None else last.get(group)
        want[n] = (k, last[group])
    assert {r.n: (r.k, r.v) for r in got.collect()} == want
    assert got.columns == df.columns


def test_mapping_renames_types_and_drops(spark):
    df = spark.createDataFrame([("1", "2.5", "x")], "a string, b string, c string")
    out = apply_mapping(df, [("a", "string", "aa", "bigint"), ("b", "string", "b", "int")])
    assert out.dtypes == [("aa", "bigint"), ("b", "int")]
    assert out.first().aa == 1


def test_typed_goes_by_name_not_position(spark):
    df = spark.createDataFrame([("x", "3"), ("y", "bad")], "t string, n string")
    from pyspark.sql.types import IntegerType, StringType, StructType

    schema = StructType().add("n", IntegerType()).add("t", StringType())
    assert sorted(map(tuple, typed(df, schema).collect()), key=str) == [(3, "x"), (None, "y")]


RAW = [
    (1, "a", "1.0", "2024-01-01"),
    (1, "a", "1.0", "2024-01-01"),  # copy
    (2, "NA", "na", None),
    (3, "b", "3.0", "NA"),
    (4, None, None, "2024-01-04"),
    (5, "Na", "", "2024-01-05"),
]
RAW_SCHEMA = "id int, kind string, value string, date string"


def test_clean_drop_is_idempotent(spark, rows):
    once = clean.clean_drop(spark.createDataFrame(RAW, RAW_SCHEMA))
    assert [r[0] for r in rows(once)] == [1, 1, 5]
    assert rows(clean.clean_drop(once)) == rows(once)


def test_impute_mean_treats_bad_numbers_as_missing(spark):
    df = spark.createDataFrame([("1",), ("3",), ("x",), (None,)], "v string")
    assert sorted(r.v for r in clean.impute_mean(df, ["v"]).collect()) == [1.0, 2.0, 2.0, 3.0]
    empty = spark.createDataFrame([(None,), (None,)], "v string")
    assert [r.v for r in clean.impute_mean(empty, ["v"]).collect()] == [None, None]


def test_mode_ignores_nulls_and_takes_the_lowest_of_a_tie(spark):
    df = spark.createDataFrame(
        [("b", None), ("a", None), ("b", None), ("a", "z"), (None, None), (None, None), (None, None)],
        "x string, y string",
    )
    assert tuple(clean.modes(df, ["x", "y"]).first()) == ("a", "z")
    filled = clean.impute_mode(df, ["x", "y"])
    assert filled.filter("x is null or y is null").isEmpty()


@pytest.mark.parametrize("buckets, first", [(1, 1), (2, 1), (7, 2), (1 << 16, 16)])
def test_modes_are_exact_whatever_the_buckets(spark, buckets, first):
    """A winner in a bucket that is not the fullest; a column whose values are all rare; one that is empty."""
    rng = random.Random(buckets)
    # 40 light values fill buckets together, one heavier value stands against them.
    light = [f"v{rng.randrange(40)}" for _ in range(400)]
    rows = [(v, f"u{i:04}", None) for i, v in enumerate(light + ["heavy"] * 25)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "a string, `odd.b` string, c string")
    counts = Counter(r[0] for r in rows)
    best = min(counts, key=lambda v: (-counts[v], v))
    assert tuple(clean.modes(df, ["a", "`odd.b`", "c"], buckets, first).first()) == (best, "u0000", None)


def test_modes_count_only_buckets_that_may_win(spark, monkeypatch):
    """One clear winner: the other values are never counted one by one."""
    asked = []
    real = clean.materialize
    monkeypatch.setattr(clean, "materialize", lambda df, label: asked.append(label) or real(df, label))
    rows = [("top",)] * 500 + [(f"v{i}",) for i in range(1000)]
    df = spark.createDataFrame(rows, "a string")
    assert clean.modes(df, ["a"]).first()[0] == "top"
    assert asked.count("mode-winners") == 1
    asked.clear()
    rare = spark.createDataFrame([(f"v{i:04}",) for i in range(1000)], "a string")
    assert clean.modes(rare, ["a"]).first()[0] == "v0000"
    assert asked.count("mode-winners") == 2


def test_modes_of_an_empty_table(spark):
    df = spark.createDataFrame([], "a string, b string")
    assert tuple(clean.modes(df, ["a", "b"]).first()) == (None, None)


def test_clean_impute_order_of_steps(spark, rows):
    df = spark.createDataFrame(RAW, RAW_SCHEMA)
    out = clean.clean_impute(df, ["value"], ["kind"], "date", order_by=["id"])
    got = rows(out)
    # mean of 1.0 and 3.0 (copy dropped first; '' is not a number); mode 'Na' < 'a' < 'b' on a tie
    assert got == [
        (1, "a", 1.0, date(2024, 1, 1)),
        (2, "Na", 2.0, date(2024, 1, 1)),
        (3, "b", 3.0, date(2024, 1, 1)),
        (4, "Na", 2.0, date(2024, 1, 4)),
        (5, "Na", 2.0, date(2024, 1, 5)),
    ]


def test_copies_made_by_imputation_stay_until_the_next_pass(spark):
    df = spark.createDataFrame([("a", "1"), ("a", "1"), (None, "1")], "k string, v string")
    once = clean.clean_impute(df, categorical=["k"])
    assert once.count() == 2
    assert clean.clean_impute(once, categorical=["k"]).count() == 1


def test_leading_missing_date_has_nothing_to_fill_from(spark):
    df = spark.createDataFrame([(1, None), (2, "2024-01-02"), (3, None)], "id int, date string")
    got = clean.fill_dates(df, "date", ["id"]).orderBy("id").collect()
    assert [r.date for r in got] == [None, date(2024, 1, 2), date(2024, 1, 2)]


def test_outliers_use_bounds_of_the_whole_input(spark):
    df = spark.createDataFrame(
        [(float(i % 5), 1.0) for i in range(40)] + [(500.0, 1.0), (2.0, 90.0), (None, 1.0)],
        "x double, y double",
    )
    kept = clean.drop_outliers(df, ["x", "y"])
    assert kept.count() == 40
    one = spark.createDataFrame([(1.0,)], "x double")
    assert clean.drop_outliers(one, ["x"]).count() == 0  # no deviation from a single value


def test_merge_increment_goes_by_name(spark, rows):
    history = spark.createDataFrame([(1, "a"), (2, "NA")], "id int, k string")
    increment = spark.createDataFrame([("b", 3), ("NA", 4)], "k string, id int")
    assert rows(clean.merge_increment(history, increment, clean.clean_drop)) == [(1, "a"), (3, "b")]


def test_profile_counts_rows_copies_and_missing(spark):
    df = spark.createDataFrame(RAW, RAW_SCHEMA)
    got = {(r.metric, r.column): r.value for r in quality.profile(df).collect()}
    assert got == {
        ("rows", ""): 6,
        ("duplicates", ""): 1,
        ("missing", "id"): 0,
        ("missing", "kind"): 2,
        ("missing", "value"): 2,
        ("missing", "date"): 2,
    }
    assert tuple(quality.missing_counts(df).first()) == (0, 2, 2, 2)
    assert tuple(quality.duplicate_counts(df).first()) == (6, 1)
    none = quality.profile(df.limit(0)).collect()
    assert {r.value for r in none} == {0}


def test_validation_and_verdict(spark):
    good = spark.createDataFrame([(i, float(i)) for i in range(20)], "id int, x double")
    checks = quality.validate(good, ["x"])
    assert checks.filter("not passed").isEmpty()
    assert tuple(quality.verdict(checks).first()) == (0, True)
    bad = good.unionByName(spark.createDataFrame([(1, 1.0), (99, 1e6)], "id int, x double"))
    failed = {(r.check, r.column) for r in quality.validate(bad, ["x"]).filter("not passed").collect()}
    assert failed == {("duplicates", ""), ("outliers", "x")}
    assert tuple(quality.verdict(quality.validate(bad, ["x"])).first()) == (2, False)


def test_constraints(spark, rows):
    df = spark.createDataFrame([(1, "a"), (1, "x"), (2, None), (None, "a")], "id int, ref string")
    parent = spark.createDataFrame([("a",), ("b",)], "key string")
    got = quality.check_constraints(
        df, not_null=["id", "ref"], unique=[["id"]], foreign={"ref": (parent, "key")}
    )
    assert rows(got) == [
        ("foreign_key", "ref", 1),
        ("not_null", "id", 1),
        ("not_null", "ref", 1),
        ("unique", "id", 1),
    ]
