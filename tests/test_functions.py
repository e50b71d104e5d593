"""Scalar functions on edge values."""

from datetime import date

from pyspark.sql import functions as F

from martflow.functions import dates, messages, missing, rules, text


def column(spark, values, kind, expr):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
    return [r[0] for r in df.orderBy("i").select(expr.alias("y")).collect()]


def test_missing_counts_sentinels_but_not_other_spellings(spark):
    got = column(spark, ["NA", "na", "Na", "", None], "string", missing.is_missing("x"))
    assert got == [True, True, False, False, True]


def test_key_parts_without_separator_or_with_two(spark):
    values = ["s1_p1", "s1", "a_b_c", "", None]
    assert column(spark, values, "string", text.part_at("x", "_", 0)) == ["s1", "s1", "a", "", None]
    assert column(spark, values, "string", text.part_at("x", "_", 1)) == ["p1", None, "b", None, None]


def test_separator_is_not_a_pattern(spark):
    assert column(spark, ["a.b|c"], "string", text.part_at("x", ".", 1)) == ["b|c"]
    assert column(spark, ["a.b|c"], "string", text.part_at("x", "|", 1)) == ["c"]


def test_year_is_the_first_run_of_exactly_four_digits(spark):
    values = ["car 1999", "12345 pen", "1990 and 2001", "none", None]
    assert column(spark, values, "string", text.four_digit_year("x")) == ["1999", "", "1990", "", None]
    assert column(spark, values, "string", text.four_digit_year("x", True))[1] is None


def test_trailing_empty_fields_do_not_count(spark):
    sizes = F.size(text.fields("x"))
    assert column(spark, ["a,b,c", "a,b,", "a,b,c,,", "a,,c"], "string", sizes) == [3, 2, 3, 3]


def test_dates_accept_only_real_days(spark):
    values = ["2010-02-05", "2010-2-5", "2010-13-45", "", "NA", None, "2010-02-05x"]
    want = [date(2010, 2, 5)] + [None] * 6
    assert column(spark, values, "string", dates.guarded_date("x")) == want
    assert column(spark, ["2010-02-05T01:02:03.000Z"], "string", dates.leading_date("x")) == [
        date(2010, 2, 5)
    ]


def test_stamps_keep_milliseconds_and_reject_other_shapes(spark):
    values = ["2010-02-05T01:02:03.456Z", "2010-02-05 01:02:03", "2010-99-05T01:02:03.456Z", None]
    got = column(spark, values, "string", dates.utc_stamp("x").cast("string"))
    assert got == ["2010-02-05 01:02:03.456", None, None, None]
    zoned = ["2010-02-05T23:00:00.000Z", "2010-02-05T23:00:00.000-02", "junk"]
    assert column(spark, zoned, "string", dates.stamp_date("x")) == [
        date(2010, 2, 5),
        date(2010, 2, 6),
        None,
    ]


def test_size_class_limits(spark):
    values = [999.99, 1000.0, 2000.0, 2000.01, 3000.0, 3000.01, None]
    assert column(spark, values, "double", rules.size_class("x")) == [
        "Small",
        "Medium",
        "Medium",
        "Large",
        "Large",
        "Extra Large",
        "Extra Large",
    ]


def test_delivery_charge_limits(spark):
    values = [0.0, 15.0, 15.01, 30.0, 30.01, -1.0, None]
    got = column(spark, values, "double", rules.delivery_charge("x").cast("int"))
    assert got == [50, 50, 100, 100, None, 50, None]
    assert column(spark, values, "double", rules.valid_distance("x")) == [True] * 5 + [False, False]


def test_messages_decode_from_one_or_two_layers(spark):
    once = '{"a":1,"b":"x \\"q\\""}'
    twice = '"{\\"a\\":2,\\"b\\":\\"y\\"}"'
    parsed = messages.parse_message("x", "a int, b string")
    got = column(spark, [once, twice, "{broken", '{"a":3}', None], "string", parsed)
    assert [(r.a, r.b) if r else None for r in got] == [
        (1, 'x "q"'),
        (2, "y"),
        (None, None),
        (3, None),
        None,
    ]


def test_null_fields_are_left_out_of_messages(spark):
    df = spark.createDataFrame([(1, None)], "a int, b string")
    assert messages.as_message(df).first()[0] == '{"a":1}'
