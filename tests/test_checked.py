"""Cells that do not fit are kept, and types stay pinned."""

import pytest
from pyspark.sql.types import StructType

from martflow.sources import checked

SCHEMA = StructType().add("id", "integer").add("day", "date").add("amount", "double").add("name", "string")


@pytest.fixture
def csv(tmp_path):
    def write(name, text):
        folder = tmp_path / name
        folder.mkdir(exist_ok=True)
        (folder / "a.csv").write_text(text)
        return str(folder)

    return write


TEXT = """id,day,amount,name
1,2024-01-01,1.5,one
x,2024-02-30,2,"a, b"
3,,,
4,2024-01-02
5,2024-01-03,1,five,more
99999999999,2024-01-04,NaN,six
"""


def test_rejects_are_told_by_column_and_text(spark, rows, csv):
    found = checked.read_csv_checked(spark, csv("f", TEXT), SCHEMA)
    assert [r.id for r in checked.fitting(found).collect()] == [1, 3]
    assert rows(checked.quarantine(found)) == [
        ("arity", "", "4,2024-01-02"),
        ("arity", "", "5,2024-01-03,1,five,more"),
        ("type", "day", "2024-02-30"),
        ("type", "id", "99999999999"),
        ("type", "id", "x"),
    ]
    assert rows(checked.reject_summary(found)) == [("arity", "", 2), ("none", "", 2), ("type", "day", 1), ("type", "id", 2)]
    # Also where only some columns are asked for.
    assert checked.fitting(found).select("name").count() == 2


def test_cells_that_must_not_be_empty(spark, rows, csv):
    strict = StructType(SCHEMA.fields[:2]).add("amount", "double", nullable=False).add("name", "string")
    found = checked.read_csv_checked(spark, csv("f", TEXT), strict)
    assert ("type", "amount", None) in rows(checked.quarantine(found))


@pytest.mark.parametrize(
    "old,new,change",
    [
        ("a int", "a int", None),
        ("a int", "a bigint", "wider"),
        ("a bigint", "a int", "narrower"),
        ("a int", "a double", "wider"),
        ("a bigint", "a double", "conflict"),
        ("a int", "a string", "conflict"),
        ("a string", "a date", "narrower"),
        ("a date", "a timestamp", "wider"),
        ("a int", "b int", "missing"),
    ],
)
def test_kinds_of_drift(spark, old, new, change):
    found = checked.drift(StructType.fromDDL(old), StructType.fromDDL(new))
    assert [r[1] for r in found][:1] == ([change] if change else [])
    if change == "missing":
        assert found[1] == ("b", "new", None, "int")


def test_types_stay_pinned_and_widen_where_that_is_safe(spark, rows, csv, tmp_path):
    pins = checked.PinnedSchema(spark, str(tmp_path / "pins"))
    one, none = pins.read(csv("one", "id,amount\n1,2\n2,\n"))
    assert none.isEmpty() and rows(checked.fitting(one)) == [(1, 2), (2, None)]
    two, found = pins.read(csv("two", "amount,extra,id\n2.5,x,3\n1,y,four\n"))
    assert rows(found) == [("amount", "wider", "int", "double"), ("extra", "new", None, "string"), ("id", "conflict", "int", "string")]
    assert rows(checked.fitting(two)) == [(3, 2.5, "x")]
    assert rows(checked.quarantine(two)) == [("type", "id", "four")]
    assert pins.load().simpleString() == "struct<id:int,amount:double,extra:string>"
    three, found = pins.read(csv("three", "id\n7\n"))
    assert [r[1] for r in rows(found)] == ["missing", "missing"] and rows(checked.fitting(three)) == [(7, None, None)]
    assert len(list((tmp_path / "pins").glob("version=*"))) == 2  # nothing new to pin the third time
