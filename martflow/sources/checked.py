"""CSV under a declared or pinned schema, with every cell that does not fit kept and counted.

Cells are read as text and cast here, so a cell that does not fit is known by its column and its text
instead of silently turning into NULL. Records of a wrong length are kept whole.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from martflow.operators.ingest import MarkStore

RECORD, REJECTS = "_record", "_rejects"


def read_csv_checked(
    spark: SparkSession, path: str | list[str], schema: StructType, header: bool = True, separator: str = ",", **options: str
) -> DataFrame:
    """The columns of ``schema``, by position, and ``_record`` and ``_rejects``.

    ``_record`` is the whole text of a record that has too few or too many fields, NULL for others;
    ``_rejects`` an array of ``(column, text)``: the cells of a record of right length that do not
    fit their type. An empty cell is a NULL, and no reject unless its column must not be NULL.
    """
    texts = StructType([StructField(f.name, StringType()) for f in schema.fields]).add(RECORD, StringType())
    reader = spark.read.schema(texts).option("header", header).option("sep", separator)
    # Without all columns the parser cannot tell how many fields a record has.
    reader = reader.option("columnNameOfCorruptRecord", RECORD).option("columnPruning", False)
    return with_rejects(reader.options(**options).csv(path), schema)


def with_rejects(texts: DataFrame, schema: StructType) -> DataFrame:
    """Text columns cast to ``schema``, by name; columns that ``texts`` does not have are NULL."""
    whole = F.col(RECORD).isNull() if RECORD in texts.columns else F.lit(True)
    record = F.col(RECORD) if RECORD in texts.columns else F.lit(None).cast("string")
    typed: list[Column] = []
    bad: list[Column] = []
    for f in schema.fields:
        if f.name not in texts.columns:
            typed.append(F.lit(None).cast(f.dataType).alias(f.name))
            continue
        text = F.col(f"`{f.name}`")
        value = F.when(whole, text.try_cast(f.dataType))
        typed.append(value.alias(f.name))
        unfit = text.isNotNull() & value.isNull()
        if not f.nullable:
            unfit = value.isNull()
        bad.append(F.when(unfit, F.struct(F.lit(f.name).alias("column"), text.alias("text"))))
    cells = F.array_compact(F.array(*bad)) if bad else F.array().cast("array<struct<column:string,text:string>>")
    none = F.array().cast("array<struct<column:string,text:string>>")
    return texts.select(*typed, record.alias(RECORD), F.when(whole, cells).otherwise(none).alias(REJECTS))


def fitting(checked: DataFrame) -> DataFrame:
    """The rows without any reject."""
    return checked.filter(F.col(RECORD).isNull() & (F.size(REJECTS) == 0)).drop(RECORD, REJECTS)


def quarantine(checked: DataFrame) -> DataFrame:
    """``(kind, column, text)``: one row for each cell of a wrong type and each record of a wrong length."""
    cells = F.transform(
        REJECTS, lambda x: F.struct(F.lit("type").alias("kind"), x["column"].alias("column"), x["text"].alias("text"))
    )
    record = F.array(F.struct(F.lit("arity").alias("kind"), F.lit("").alias("column"), F.col(RECORD).alias("text")))
    return checked.select(F.inline(F.when(F.col(RECORD).isNotNull(), record).otherwise(cells)))


def reject_summary(checked: DataFrame) -> DataFrame:
    """``(kind, column, cells)`` in one pass; rows that fit are counted under 'none'."""
    fits = F.col(RECORD).isNull() & (F.size(REJECTS) == 0)
    none = F.array(F.struct(F.lit("none").alias("kind"), F.lit("").alias("column")))
    arity = F.array(F.struct(F.lit("arity").alias("kind"), F.lit("").alias("column")))
    cells = F.transform(REJECTS, lambda x: F.struct(F.lit("type").alias("kind"), x["column"].alias("column")))
    found = F.when(fits, none).when(F.col(RECORD).isNotNull(), arity).otherwise(cells)
    return checked.select(F.inline(found)).groupBy("kind", "column").agg(F.count("*").alias("cells"))


# -- pinned types ----------------------------------------------------------------------

# Types that hold every value of another type exactly.
SAFE = {
    ("int", "bigint"),
    ("int", "double"),
    ("date", "timestamp"),
    ("date", "timestamp_ntz"),
}
DRIFT = "column string, change string, pinned string, found string"


def drift(pinned: StructType, found: StructType) -> list[tuple[str, str, str | None, str | None]]:
    """``(column, change, pinned type, found type)`` for every column that is not as pinned.

    Changes: ``new``, ``missing``, ``wider`` (the found type holds all pinned values), ``narrower`` (the
    pinned type holds all found values) and ``conflict``.
    """
    old = {f.name: f.dataType.simpleString() for f in pinned.fields}
    new = {f.name: f.dataType.simpleString() for f in found.fields}
    rows = []
    for name in [*old, *(n for n in new if n not in old)]:
        a, b = old.get(name), new.get(name)
        if a == b:
            continue
        if a is None:
            change = "new"
        elif b is None:
            change = "missing"
        elif (a, b) in SAFE:
            change = "wider"
        elif (b, a) in SAFE or a == "string":
            change = "narrower"
        else:
            change = "conflict"
        rows.append((name, change, a, b))
    return rows


def widened(pinned: StructType, found: StructType) -> StructType:
    """The pinned columns, wider where that is safe, then the new ones. Conflicts stay as pinned."""
    wider = {name for name, change, _, _ in drift(pinned, found) if change == "wider"}
    types = {f.name: f.dataType for f in found.fields}
    kept = [StructField(f.name, types[f.name] if f.name in wider else f.dataType) for f in pinned.fields]
    known = set(pinned.fieldNames())
    return StructType(kept + [StructField(f.name, f.dataType) for f in found.fields if f.name not in known])


class PinnedSchema:
    """The types of a source, inferred once and then kept; changes are reported, not followed blindly."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.marks = spark, MarkStore(spark, path, "types string")

    def load(self) -> StructType | None:
        known = self.marks.load()
        return None if known is None else StructType.fromDDL(known["types"])

    def read(self, path: str | Sequence[str], **options: str) -> tuple[DataFrame, DataFrame]:
        """A headered CSV under the pinned types, with ``_record`` and ``_rejects``, and its drift as a table.

        The first file pins its inferred types. Later ones may add columns and widen types; those are pinned
        then. Cells that do not fit the pinned type are rejects. Files read at once must have one header.
        """
        reader = self.spark.read.option("header", True).options(**options)
        found = reader.option("inferSchema", True).csv(path).schema
        pinned = self.load()
        rows = [] if pinned is None else drift(pinned, found)
        types = found if pinned is None else widened(pinned, found)
        if types != pinned:
            self.marks.save(types=", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in types.fields))
        texts = self.spark.read.option("header", True).options(**options).csv(path)
        return with_rejects(texts, types), self.spark.createDataFrame(rows, DRIFT)
