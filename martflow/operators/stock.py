"""Stock requests settled in order: accept what fits, refuse the rest.

Whether a request fits depends on all earlier answers of its key, so a key is sequential by
nature. Requests are therefore cut into ranges of (key, order), of about as many rows each
whatever the keys are (``buckets.ranged``); a hot key lies in several of them.

1. Every part of a key that goes on into another range is summarised as a function "quantity
   held before -> quantity held after", a short list of steps (at most one per unit of stock).
2. Functions of neighbouring ranges are chained in a tree of ``fan_in`` children per node,
   then the known start quantity is handed down the same tree to each part.
3. With its start quantity known, a range is settled in order, one request of each of its keys at
   a time.

The answers are exactly those of settling each key from front to back, for every cut.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, LongType, StructField, StructType

from martflow.operators.buckets import ranged
from martflow.session import materialize

# Executors need not have this package installed: its task functions travel with the job.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

FAN_IN = 64


def settle(
    requests: DataFrame,
    stock: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str],
    quantity: str = "quantity",
    opening: str = "opening",
    fan_in: int = FAN_IN,
    parts: int | None = None,
) -> DataFrame:
    """Answer signed requests in the order of ``order_by`` (unique within a key; NULLs first).

    A positive quantity takes from the stock of the key if that much is left; a negative
    one gives back if that much is held. NULL quantities, and keys that are unknown, NULL or of
    NULL opening, are refused. Adds ``accepted`` and ``held`` (units held after the request) to
    the requests; no request is lost. ``parts`` sets the number of ranges (Spark chooses).
    """
    limits = stock.select(*keys, F.col(opening).cast("bigint").alias("_opening"))
    asked = requests.withColumn("_qty", F.col(quantity).cast("bigint"))
    rows = ranged(asked.join(limits, list(keys), "left"), [*keys, *order_by], "requests", parts)
    # Keys that lie in several ranges: no more of them than ranges.
    spans = rows.filter("_opening IS NOT NULL").groupBy(*keys).agg(
        F.min("_part").alias("_first"), F.max("_part").alias("_last")
    )
    spans = materialize(spans.filter("_first < _last").select(*keys), "spans")
    zero = F.lit(0).cast("bigint")
    if spans.isEmpty():
        return _replay(rows.withColumn("_held", zero), requests, keys)
    starts = materialize(_part_starts(rows.join(spans, list(keys)), keys, fan_in), "starts")
    begun = rows.join(starts, [*keys, "_part"], "left").withColumn("_held", F.coalesce("_held", zero))
    return _replay(begun, requests, keys)


def _replay(rows: DataFrame, requests: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Settle each range, every part of a key from its start quantity."""
    ordered = rows.repartition("_part").sortWithinPartitions("_part", "_at")
    names = list(requests.columns)
    schema = StructType(
        requests.schema.fields
        + [StructField("accepted", BooleanType()), StructField("held", LongType())]
    )
    inputs = ("_part", *keys, "_qty", "_opening", "_held")

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last_key, last_held = None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            column = {c: batch.column(c) for c in inputs}
            begin = _run_starts([column[c] for c in ("_part", *keys)])
            held = column["_held"].to_numpy()[begin].copy()
            first, last = ([column[c][i].as_py() for c in ("_part", *keys)] for i in (0, batch.num_rows - 1))
            if first == last_key:  # the run goes on from the batch before
                held[0] = last_held
            accepted, after = _replay_runs(begin, held, column["_qty"], column["_opening"])
            last_key, last_held = last, int(after[-1])
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in names] + [pa.array(accepted), pa.array(after)],
                names=[*names, "accepted", "held"],
            )

    return ordered.mapInArrow(answer, schema)


def _run_starts(columns: Sequence[pa.Array]) -> np.ndarray:
    """Positions at which any of the columns changes (NULL equals NULL), the first included."""
    n = len(columns[0])
    change = np.zeros(n, bool)
    change[0] = True
    for c in columns:
        codes = c.dictionary_encode().indices.fill_null(-1).to_numpy(zero_copy_only=False)
        change[1:] |= codes[1:] != codes[:-1]
    return np.flatnonzero(change)


LANES = 16  # below so many runs at once, single steps cost less than arrays


def _replay_runs(
    begin: np.ndarray, held: np.ndarray, quantity: pa.Array, opening: pa.Array
) -> tuple[np.ndarray, np.ndarray]:
    """Settle runs of requests that do not depend on each other, one request of every run at a time.

    A run goes from its start to the next one; ``held`` is what each begins with. The longest runs are left
    to single steps once few others are as long.
    """
    n = len(quantity)
    known = quantity.is_valid().to_numpy(zero_copy_only=False) & opening.is_valid().to_numpy(zero_copy_only=False)
    qty = quantity.fill_null(0).to_numpy()
    limit = opening.fill_null(-1).to_numpy()
    accepted, after = np.zeros(n, bool), np.zeros(n, np.int64)
    length = np.diff(np.append(begin, n))
    order = np.argsort(-length, kind="stable")
    begin, length, held = begin[order], length[order], held[order]
    step, active = 0, len(begin)
    while active >= LANES:
        at = begin[:active] + step
        then = held[:active] + qty[at]
        fits = known[at] & (then >= 0) & (then <= limit[at])
        held[:active] = np.where(fits, then, held[:active])
        accepted[at], after[at] = fits, held[:active]
        step += 1
        active = int(np.searchsorted(-length, -step))  # runs that are longer than ``step``
    for k in range(active):
        rows = slice(int(begin[k]) + step, int(begin[k] + length[k]))
        now, answers, left = int(held[k]), [], []
        for ok, q, most in zip(known[rows].tolist(), qty[rows].tolist(), limit[rows].tolist()):
            ok = ok and 0 <= now + q <= most
            if ok:
                now += q
            answers.append(ok)
            left.append(now)
        accepted[rows], after[rows] = answers, left
    return accepted, after


# -- chunk functions -----------------------------------------------------------------
# A function is a pair of arrays: for held quantities from ``low[i]`` up to the next low,
# the quantity afterwards is ``held + shift[i]``.


Step = tuple[np.ndarray, np.ndarray]
BLOCK = 64


def _chunk_function(qty: np.ndarray, opening: int) -> Step:
    """The function of a run of requests: short blocks first, then chained pairwise."""
    blocks = [qty[i : i + BLOCK] for i in range(0, len(qty), BLOCK)] or [qty]
    return _chain_all([_block_function(b, opening) for b in blocks], opening)


def _block_function(qty: np.ndarray, opening: int) -> Step:
    low, shift = np.zeros(1, np.int64), np.zeros(1, np.int64)
    for q in qty:
        if q == 0 or abs(q) > opening:
            continue
        high = np.append(low[1:] - 1, opening)
        # The first start quantity on the other side of "fits" / "does not fit".
        cut = (opening - q + 1 if q > 0 else -q) - shift
        inside = (cut > low) & (cut <= high)
        if inside.any():
            low = np.concatenate([low, cut[inside]])
            shift = np.concatenate([shift, shift[inside]])
            order = np.argsort(low)
            low, shift = low[order], shift[order]
        after = low + shift + q
        low, shift = _merged(low, np.where((after >= 0) & (after <= opening), shift + q, shift))
    return low, shift


def _merged(low: np.ndarray, shift: np.ndarray) -> Step:
    """Neighbouring steps with the same shift become one."""
    keep = np.append(True, shift[1:] != shift[:-1])
    return low[keep], shift[keep]


def _chain(first: Step, second: Step, opening: int) -> Step:
    """The function that applies ``first`` and then ``second``."""
    if opening < 0:
        return first
    (low1, shift1), (low2, shift2) = first, second
    high1 = np.append(low1[1:] - 1, opening)
    # Steps of ``second`` that begin strictly inside the image of each step of ``first``.
    begin = np.searchsorted(low2, low1 + shift1, side="right")
    count = np.searchsorted(low2, high1 + shift1, side="right") - begin
    before = np.cumsum(count) - count
    position = np.arange(count.sum()) + np.repeat(begin - before, count)
    low = np.sort(np.concatenate([low1, low2[position] - np.repeat(shift1, count)]))
    s1 = shift1[np.searchsorted(low1, low, side="right") - 1]
    s2 = shift2[np.searchsorted(low2, low + s1, side="right") - 1]
    return _merged(low, s1 + s2)


def _chain_all(steps: list[Step], opening: int) -> Step:
    while len(steps) > 1:
        pairs = [_chain(a, b, opening) for a, b in zip(steps[::2], steps[1::2])]
        steps = pairs + steps[len(pairs) * 2 :]
    return steps[0]


def _apply(function, held: int) -> int:
    low, shift = function
    return int(held + shift[np.searchsorted(low, held, side="right") - 1])


def _part_starts(rows: DataFrame, keys: Sequence[str], fan_in: int) -> DataFrame:
    """``(keys, _part, _held)``: the quantity held when each part of a key begins."""
    key_fields = [rows.schema[k] for k in keys]
    fn_schema = StructType(
        key_fields
        + [StructField("_part", LongType()), StructField("_opening", LongType())]
    )
    for c in ("_low", "_shift"):
        fn_schema = fn_schema.add(c, ArrayType(LongType()))
    start_schema = StructType(
        key_fields + [StructField("_part", LongType()), StructField("_held", LongType())]
    )
    key_names = list(keys)

    def summarise(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_at")
        opening = int(pdf["_opening"].iloc[0])
        function = _chunk_function(pdf["_qty"].fillna(0).to_numpy(np.int64), opening)
        return _function_row(pdf.iloc[0], key_names, int(pdf["_part"].iloc[0]), opening, function)

    def chain(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_part")
        opening = int(pdf["_opening"].iloc[0])
        function = _chain_all(list(_functions(pdf)), opening)
        node = int(pdf["_part"].iloc[0]) // fan_in
        return _function_row(pdf.iloc[0], key_names, node, opening, function)

    def hand_down(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_part")
        held, starts = int(pdf["_held"].iloc[0]), []
        for step in _functions(pdf):
            starts.append(held)
            held = _apply(step, held)
        return pdf[[*key_names, "_part"]].assign(_held=starts)

    node = F.floor(F.col("_part") / F.lit(fan_in)).cast("bigint")
    needed = rows.select(*key_names, "_part", "_at", "_opening", "_qty")
    leaves = needed.groupBy(*key_names, "_part").applyInPandas(summarise, fn_schema)
    # Every tier is read twice, by the next one and on the way down: store each.
    tiers = [materialize(leaves, "chunks")]
    last = tiers[0].agg(F.max("_part")).first()[0] or 0
    while last >= fan_in:
        parents = tiers[-1].groupBy(*key_names, node.alias("_node"))
        tiers.append(materialize(parents.applyInPandas(chain, fn_schema), "chunks"))
        last //= fan_in

    # The top tier is one sequence per key; below it, each node starts where its parent says.
    top = tiers[-1].withColumn("_held", F.lit(0).cast("bigint"))
    starts = top.groupBy(*key_names).applyInPandas(hand_down, start_schema)
    for tier in reversed(tiers[:-1]):
        parents = starts.withColumnRenamed("_part", "_node")
        children = tier.withColumn("_node", node).join(parents, [*key_names, "_node"])
        starts = children.groupBy(*key_names, "_node").applyInPandas(hand_down, start_schema)
    return starts


def _functions(pdf: pd.DataFrame):
    for low, shift in zip(pdf["_low"], pdf["_shift"]):
        yield np.asarray(low, np.int64), np.asarray(shift, np.int64)


def _function_row(first, key_names, part, opening, function) -> pd.DataFrame:
    low, shift = function
    row = {k: first[k] for k in key_names}
    row |= {"_part": part, "_opening": opening, "_low": low, "_shift": shift}
    return pd.DataFrame([row])
