"""Sharding with a k-d tree over metadata: shards of equal bytes, near in language, length and the like.

A node holds rows and a number of shards to be made of them. It is cut along the dimension in which its
rows spread widest, at the weighted median (the weighted quantile, where the shards do not halve), until
every leaf is one shard of the target size. Only built-in functions are used.

Medians are found on counts. Rows are first folded to cells (one for each set of coordinates); a cut is
narrowed down by histograms of the cells of all nodes of a level at once. Where one value alone is too
heavy, the cut goes on inside it by a hash of the text, and inside equal texts by a hash of the id. So
equal texts stay in one shard unless a cut must pass through a group that is heavier than the tolerance.
The tree is a short list of bounds, and a row's shard an expression of its own columns: rows are not
moved while the tree grows.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martflow.llm.common import fresh, materialize, utf8
from martflow.operators.buckets import dense_ids

BINS = 1024  # of a histogram; nodes x bins numbers come to the driver at once
FAR = 1 << 60  # coordinates are cut off here, so that differences fit 64 bits
OVERHEAD = 8  # bytes that a row takes besides its text
DIMENSIONS = ("lang", "n_chars")
TOLERANCE = 0.005  # of a shard
MOST_SHARDS = 4096


@dataclass
class Node:
    """Rows for shards ``first`` to ``first + shards - 1``, and where they are cut."""

    first: int
    shards: int
    axis: int = 0
    bound: tuple[int, ...] = ()  # coordinate, text hash, id hash: smaller rows go left
    children: list[Node] = field(default_factory=list)

    def leaves(self) -> list[Node]:
        return [leaf for c in self.children for leaf in c.leaves()] if self.children else [self]

    def place(self, axes: Sequence[Column], ties: Sequence[Column]) -> Column:
        """The first shard of the leaf that a row is in."""
        if not self.children:
            return F.lit(self.first)
        left, right = self.children
        test = F.lit(False)
        for c, v in reversed(list(zip((axes[self.axis], *ties), self.bound))):
            test = (c < F.lit(v)) | ((c == F.lit(v)) & test)
        return F.when(test, left.place(axes, ties)).otherwise(right.place(axes, ties))


def coordinate(df: DataFrame, name: str) -> Column:
    """A column as a number of the same order: texts by their first six bytes, times and days by their
    number, others as whole numbers. Null counts as 0, as does a number that is none."""
    c, kind = F.col(f"`{name}`"), df.schema[name].dataType
    if isinstance(kind, (T.StringType, T.BinaryType)):
        start = F.rpad(F.hex(F.substring(c.cast("binary"), 1, 6)), 12, "0")
        number = F.conv(start, 16, 10).cast("bigint")
    elif isinstance(kind, T.TimestampType):
        number = F.unix_micros(c)
    elif isinstance(kind, T.TimestampNTZType):
        number = F.unix_micros(c.cast("timestamp"))
    elif isinstance(kind, T.DateType):
        number = F.unix_date(c).cast("bigint")
    elif isinstance(kind, (T.FloatType, T.DoubleType)):
        number = F.nanvl(c.cast("double"), F.lit(0.0))
    else:
        number = c.cast("decimal(38,0)")
    number = F.coalesce(number, F.lit(0))  # before the limits, which look past nulls
    return F.greatest(F.least(number, F.lit(FAR)), F.lit(-FAR)).cast("bigint")


# -- weighted medians ------------------------------------------------------------------


@dataclass
class Search:
    """The cut of one node: bounds fixed so far, and the range that its next number lies in."""

    node: Node
    aim: float  # weight that should go left
    low: int
    high: int  # exclusive
    fixed: tuple[int, ...] = ()
    before: int = 0  # weight known to go left


def narrowed(s: Search, bins: list, tolerance: float) -> bool:
    """Go on in the bin that the aim falls into; True once the node's bound is known.

    ``bins``: rows (lowest value, highest value, weight, rows) in order.
    """
    total = s.before
    for low, high, weight, rows in bins:
        if total + weight < s.aim:
            total += weight
            continue
        if low == high and len(s.fixed) < 2 and weight > tolerance and rows > 1:
            s.fixed, s.low, s.high, s.before = (*s.fixed, low), 0, 1 << (32, 60)[len(s.fixed)], total
            return False
        if low == high or weight <= tolerance or rows == 1:
            nearest = low if s.aim - total <= total + weight - s.aim else high + 1
            s.node.bound = (*s.fixed, nearest)
            return True
        s.low, s.high, s.before = low, high + 1, total
        return False
    s.node.bound = (*s.fixed, s.high)  # nothing is left: all rows go left
    return True


def histograms(rows: DataFrame, root: Node, searches: Sequence[Search], axes: list[str], used: list[str], count: str | None, ties: Sequence[str] = ()) -> dict[int, list]:
    """For each search, (lowest, highest, weight, rows) of each bin of its range, in order.

    ``used``: the ties that bounds of the tree look at. ``count``: the column that tells how many rows a row is.
    """
    leaf = root.place([F.col(c) for c in axes], [F.col(c) for c in used])
    value, slot = F.lit(None).cast("bigint"), F.lit(None).cast("bigint")
    for s in searches:
        path = [axes[s.node.axis], *ties]
        x = F.col(path[len(s.fixed)])
        mine = (F.col("leaf") == s.node.first) & (x >= F.lit(s.low)) & (x < F.lit(s.high))
        for c, v in zip(path, s.fixed):
            mine = mine & (F.col(c) == F.lit(v))
        step = max(1, -(-(s.high - s.low) // BINS))
        value = F.when(mine, x).otherwise(value)
        slot = F.when(mine, F.floor((x - F.lit(s.low)) / F.lit(step))).otherwise(slot)
    one = F.col(count) if count else F.lit(1)
    grouped = (
        rows.withColumn("leaf", leaf)
        .select("leaf", value.alias("value"), slot.alias("bin"), F.col("size").alias("w"), one.alias("n"))
        .where("bin IS NOT NULL")
        .groupBy("leaf", "bin")
        .agg(F.min("value").alias("low"), F.max("value").alias("high"), F.sum("w").alias("w"), F.sum("n").alias("n"))
    )
    found: dict[int, list] = {s.node.first: [] for s in searches}
    for r in sorted(grouped.collect(), key=lambda r: r["bin"]):
        found[r["leaf"]].append((r["low"], r["high"], r["w"], r["n"]))
    return found


def grow(points: DataFrame, shards: int, axes: list[str], ties: list[str], tolerance: float = TOLERANCE) -> Node:
    """The tree over ``points`` (a stored table with ``axes``, ``ties`` and ``size``).

    A cut may miss its aim by half of ``tolerance`` shards, or half a row if that is more.
    """
    cells = materialize(points.groupBy(*axes).agg(F.sum("size").alias("size"), F.count("*").alias("rows")), "cells")
    root = Node(0, shards)
    spread, allowed = None, 0.0
    while level := [leaf for leaf in root.leaves() if leaf.shards > 1]:
        # A cut among ties goes through a cell: from then on, rows are looked at instead of cells.
        by_rows = any(len(n.bound) > 1 for n in inner(root))
        source, used = (points, ties) if by_rows else (cells, [])
        leaf = root.place([F.col(c) for c in axes], [F.col(c) for c in used])
        stats = source.groupBy(leaf.alias("leaf")).agg(
            F.sum("size").alias("weight"),
            *[F.min(c).alias(f"low{i}") for i, c in enumerate(axes)],
            *[F.max(c).alias(f"high{i}") for i, c in enumerate(axes)],
        )
        known = {r["leaf"]: r for r in stats.collect()}  # one row for each leaf
        searches = []
        for n in level:
            r = known.get(n.first)
            if r is None:  # no rows: any cut will do
                n.bound = (0,)
                continue
            widths = [r[f"high{i}"] - r[f"low{i}"] for i in range(len(axes))]
            if spread is None:
                spread, allowed = widths, tolerance * r["weight"] / shards
            n.axis = max(range(len(axes)), key=lambda i: (widths[i] / max(spread[i], 1), -i))
            aim = r["weight"] * (n.shards // 2) / n.shards
            searches.append(Search(n, aim, r[f"low{n.axis}"], r[f"high{n.axis}"] + 1))
        while searches:
            bins: dict[int, list] = {}
            ahead = [s for s in searches if not s.fixed and not by_rows]
            within = [s for s in searches if s.fixed or by_rows]
            if ahead:
                bins |= histograms(cells, root, ahead, axes, [], "rows")
            if within:
                bins |= histograms(points, root, within, axes, ties if by_rows else [], None, ties)
            searches = [s for s in searches if not narrowed(s, bins[s.node.first], allowed)]
        for n in level:
            half = n.shards // 2
            n.children = [Node(n.first, half), Node(n.first + half, n.shards - half)]
    return root


def inner(node: Node) -> list[Node]:
    """All nodes that are cut."""
    return [node, *[x for c in node.children for x in inner(c)]] if node.children else []


# -- the operator ----------------------------------------------------------------------


def measured(docs: DataFrame, text: str, doc_id: str, dimensions: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """The columns ``keep`` as ``k0, k1, ...``, the coordinates ``a0, a1, ...``, the ties ``hash`` (crc32 of the
    text) and ``id`` (60 bits of the id's hash), and ``size``."""
    body = utf8(F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")))
    return docs.select(
        *[F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(keep)],
        *[coordinate(docs, c).alias(f"a{i}") for i, c in enumerate(dimensions)],
        F.crc32(body).alias("hash"),
        F.shiftrightunsigned(F.xxhash64(F.col(f"`{doc_id}`").cast("string")), 4).alias("id"),
        (F.length(body) + OVERHEAD).cast("bigint").alias("size"),
    )


def count_of(total: int, shards: int | None, target_bytes: int | None) -> int:
    if (shards is None) == (target_bytes is None):
        raise ValueError("give either the number of shards or their target size")
    n = shards if shards is not None else max(1, -(-total // target_bytes))
    if not 1 <= n <= MOST_SHARDS:
        raise ValueError(f"{n} shards: 1 to {MOST_SHARDS} are possible, as the tree is an expression")
    return n


def assign(docs: DataFrame, shards: int | None = None, target_bytes: int | None = None, text: str = "text", doc_id: str = "doc_id", dimensions: Sequence[str] = DIMENSIONS, tolerance: float = TOLERANCE, into: str = "place", keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` (all) of ``docs`` with a struct ``into``: ``size`` (bytes of the text, plus 8),
    ``text_crc32``, ``shard`` (0, 1, 2, ...) and ``slot`` (0, 1, 2, ... within the shard).

    Give the number of shards or their ``target_bytes``. Bytes of shards differ from the mean by some
    ``tolerance`` of it and about half a row of those at the cuts. Equal texts have equal places among the ties,
    and with the given dimensions (which follow from the text) share a shard, unless a cut must go through a
    group of them that is heavier than the tolerance. A null text counts as empty, a null coordinate as 0. Rows
    of equal id and text stay in one shard, each with a slot of its own. With fewer rows than shards, or an empty
    table, some shards are empty.

    What is moved is one narrow row for each row (with the columns ``keep``), once, to number the slots.
    """
    keep, into = keep or list(docs.columns), fresh(docs, into)
    rows = measured(docs, text, doc_id, dimensions, keep)
    points = materialize(rows.withColumn("row", F.monotonically_increasing_id()), "points")
    axes, ties = [f"a{i}" for i in range(len(dimensions))], ["hash", "id"]
    total = points.agg(F.sum("size")).first()[0] or 0
    n = count_of(total, shards, target_bytes)
    tree = grow(points, n, axes, ties, tolerance)
    placed = points.withColumn("shard", tree.place([F.col(c) for c in axes], [F.col(c) for c in ties]).cast("int"))
    held = {r["shard"]: r["n"] for r in placed.groupBy("shard").agg(F.count("*").alias("n")).collect()}
    starts = [sum(held.get(j, 0) for j in range(k)) for k in range(n)]
    slim = placed.select(*[f"k{i}" for i in range(len(keep))], "shard", "id", "hash", "row", "size")
    numbered = dense_ids(slim, ["shard", "id", "hash", "row"], "number")
    begin = F.get(F.array(*[F.lit(x).cast("bigint") for x in starts]), F.col("shard"))
    return numbered.select(
        *[F.col(f"k{i}").alias(c) for i, c in enumerate(keep)],
        F.struct("size", F.col("hash").alias("text_crc32"), "shard", (F.col("number") - 1 - begin).alias("slot")).alias(into),
    )


def write_shards(docs: DataFrame, path: str, shards: int | None = None, target_bytes: int | None = None, files: int = 1, text: str = "text", doc_id: str = "doc_id", dimensions: Sequence[str] = DIMENSIONS, tolerance: float = TOLERANCE) -> DataFrame:
    """Write ``docs`` as Parquet folders ``shard=0, shard=1, ...`` below ``path`` and read them back.

    Shards are those of ``assign``, with rows of each file ordered by the hash of their ids. ``files`` is the number
    of files of a shard; whole texts are moved once, a shard's rows to as many tasks. ``docs`` must have no
    column ``shard``.
    """
    points = materialize(measured(docs, text, doc_id, dimensions, []), "points")
    axes, ties = [f"a{i}" for i in range(len(dimensions))], ["hash", "id"]
    total = points.agg(F.sum("size")).first()[0] or 0
    n = count_of(total, shards, target_bytes)
    tree = grow(points, n, axes, ties, tolerance)
    rows = measured(docs, text, doc_id, dimensions, docs.columns)
    place = tree.place([F.col(c) for c in axes], [F.col(c) for c in ties]).cast("int")
    dealt = rows.select("*", place.alias("shard"), F.pmod("id", F.lit(files)).alias("file"))
    dealt = dealt.repartition(n * files, "shard", "file").sortWithinPartitions("shard", "file", "id", "hash")
    named = dealt.select(*[F.col(f"k{i}").alias(c) for i, c in enumerate(docs.columns)], "shard")
    named.write.partitionBy("shard").parquet(path)
    return docs.sparkSession.read.schema(named.schema).parquet(path)
