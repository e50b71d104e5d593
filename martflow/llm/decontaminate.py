"""Benchmark decontamination with a suffix automaton of the test items.

The automaton knows every run of words of every item. A document's words are streamed through it:
after each word, the state tells the longest run of words ending here that some item has. A run
of at least a window's length, or a whole shorter item, is a hit.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce
from itertools import chain, repeat

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast, cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martflow.llm.common import bound_batches, fresh, materialize, places, received, sent, utf8
from martflow.llm.words import LETTERS_AND_DIGITS, plain_words

WINDOW = 13
BLOCK_BYTES = 2_000_000  # of item text in one automaton: some 170 MB in each task, one automaton at a time
SPAN_TYPE = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


class Automaton:
    """Generalised suffix automaton of word sequences, with the items of each window."""

    def __init__(self, items: list[tuple[object, list[bytes]]], window: int = WINDOW):
        self.window = window
        self.words: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link: list[int] = [-1]
        self.length: list[int] = [0]
        coded = [(item, [self.words.setdefault(w, len(self.words) + 1) for w in words]) for item, words in items if words]
        for _, ids in coded:
            state = 0
            for w in ids:
                state = self._extend(state, w)
        self.owners: dict[int, set] = {}  # state of a window -> its items
        self.short: dict[int, list[tuple[int, object]]] = {}  # state of a whole shorter item -> (words, item)
        for item, ids in coded:
            if len(ids) < window:
                state = 0
                for w in ids:
                    state = self.next[state][w]
                self.short.setdefault(state, []).append((len(ids), item))
                continue
            for state, matched in self._walk(ids):
                if matched >= window:
                    self.owners.setdefault(self._suffix(state), set()).add(item)
        self.shortest = min([min(len(ids), window) for _, ids in coded], default=0)
        # Nearest state along the links, itself included, that is a whole shorter item.
        self.marked: dict[int, int] = {}
        for state in sorted(range(len(self.link)), key=self.length.__getitem__):
            if state in self.short:
                self.marked[state] = state
            elif self.link[state] in self.marked:
                self.marked[state] = self.marked[self.link[state]]
        size = len(self.words) + 1
        pairs = {a * size + b for _, ids in coded for a, b in zip(ids, ids[1:])}
        self.pairs = np.array(sorted(pairs), np.int64)

    def _extend(self, last: int, w: int) -> int:
        nxt, link, length = self.next, self.link, self.length
        if w in nxt[last]:
            known = nxt[last][w]
            return known if length[known] == length[last] + 1 else self._clone(last, w, known)
        state = len(nxt)
        nxt.append({})
        link.append(0)
        length.append(length[last] + 1)
        at = last
        while at >= 0 and w not in nxt[at]:
            nxt[at][w] = state
            at = link[at]
        if at >= 0:
            known = nxt[at][w]
            link[state] = known if length[known] == length[at] + 1 else self._clone(at, w, known)
        return state

    def _clone(self, at: int, w: int, known: int) -> int:
        nxt, link = self.next, self.link
        state = len(nxt)
        nxt.append(dict(nxt[known]))
        link.append(link[known])
        self.length.append(self.length[at] + 1)
        link[known] = state
        while at >= 0 and nxt[at].get(w) == known:
            nxt[at][w] = state
            at = link[at]
        return state

    def _suffix(self, state: int) -> int:
        """The state that stands for the last ``window`` words of this state's run."""
        while self.length[self.link[state]] >= self.window:
            state = self.link[state]
        return state

    def _walk(self, ids: list[int]) -> Iterator[tuple[int, int]]:
        """After each word: the state, and the length of the longest run ending here."""
        nxt, link, length = self.next, self.link, self.length
        state = matched = 0
        for w in ids:
            while state and w not in nxt[state]:
                state = link[state]
                matched = length[state]
            if w in nxt[state]:
                state = nxt[state][w]
                matched += 1
            yield state, matched

    def hits(self, ids: list[int]) -> Iterator[tuple[int, int, list]]:
        """(start, end, items) of each window or whole shorter item within ``ids``."""
        for at, (state, matched) in enumerate(self._walk(ids), 1):
            if matched >= self.window:
                yield at - self.window, at, list(self.owners[self._suffix(state)])
            mark = self.marked.get(state)
            while mark is not None:
                for size, item in self.short[mark]:
                    if size <= matched:
                        yield at - size, at, [item]
                mark = self.marked.get(self.link[mark])

    def scan(self, ids: np.ndarray) -> list[tuple[int, int, list]]:
        """Hits within a long sequence of word numbers, 0 for words that no item has.

        Words next to each other in a hit are so in an item: only stretches whose neighbours all
        are, and which are long enough, need to be streamed.
        """
        if not self.shortest or len(ids) < self.shortest:
            return []
        size = len(self.words) + 1
        near = np.flatnonzero((ids[:-1] > 0) & (ids[1:] > 0))
        key = ids[near].astype(np.int64) * size + ids[near + 1]
        place = np.searchsorted(self.pairs, key)
        place[place == len(self.pairs)] = 0
        joined = np.zeros(len(ids) + 1, bool)  # joined[i]: words i - 1 and i are neighbours in an item
        if len(self.pairs):
            joined[near[self.pairs[place] == key] + 1] = True
        known = ids > 0
        starts = np.flatnonzero(known & ~joined[:-1])
        ends = np.flatnonzero(known & ~joined[1:]) + 1
        out = []
        for s, e in zip(starts, ends):
            if e - s >= self.shortest:
                out += [(int(s) + a, int(s) + b, items) for a, b, items in self.hits(ids[s:e].tolist())]
        return out


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def find_hits(batches: Iterator[pa.RecordBatch], shared) -> Iterator[pa.RecordBatch]:
    """(..., text, words, spans, items) -> the same, with what the automaton finds added."""
    automaton: Automaton = received(shared)
    for whole in batches:
        for first in range(0, whole.num_rows, 512):
            batch = whole.slice(first, 512)
            texts, spans, items = (batch.column(batch.num_columns - k) for k in (4, 2, 1))
            split = [plain_words(data or b"") for data in texts.to_pylist()]
            counts = np.array([len(words) for words in split], np.int64)
            # One sequence for the batch, with an unknown word after each text.
            flat = chain.from_iterable(chain(map(automaton.words.get, words, repeat(0)), (0,)) for words in split)
            ids = np.fromiter(flat, np.int32, int(counts.sum()) + len(split))
            starts = np.cumsum(counts + 1) - counts - 1
            old = spans.to_pylist()
            ranges = [[(s["start"], s["end"]) for s in x] for x in old]
            names = [set(x) for x in items.to_pylist()]
            for a, b, owners in automaton.scan(ids):
                row = int(np.searchsorted(starts, a, "right")) - 1
                ranges[row].append((a - int(starts[row]), b - int(starts[row])))
                names[row].update(owners)
            made = [[{"start": a, "end": b} for a, b in merged(x)] for x in ranges]
            columns = batch.columns[:-3]
            columns += [
                pa.array(counts, pa.int64()),
                pa.array(made, SPAN_TYPE),
                pa.array([sorted(x) for x in names], items.type),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=places(batch.num_columns))


def merge_spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(row, spans, items) -> the same with overlapping spans made one."""
    for batch in batches:
        made = [[{"start": a, "end": b} for a, b in merged([(s["start"], s["end"]) for s in x])] for x in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(made, SPAN_TYPE), batch.column(2)], names=places(3))


def blocks(bench: DataFrame, text: str, item_id: str, window: int, block_bytes: int) -> Iterator[Broadcast]:
    """Automata of the benchmark's items, each of a part of bounded size, one after the other for all executors.

    They are built in tasks, one for each part, and stored; the driver passes one on at a time.
    """
    items = bench.select(F.col(f"`{item_id}`").alias("item"), utf8(F.col(f"`{text}`")).alias("text"))
    items = items.where("item is not null and text is not null")
    size = items.agg(F.sum(F.length("text"))).first()[0] or 0
    parts = int(size // block_bytes) + 1
    items = items.withColumn("part", F.pmod(F.xxhash64("item", "text"), F.lit(parts)).cast("int"))

    def build(rows: pd.DataFrame) -> pd.DataFrame:
        made = Automaton([(i, plain_words(bytes(t))) for i, t in zip(rows["item"], rows["text"])], window)
        return pd.DataFrame({"part": [rows["part"].iloc[0]], "data": [cloudpickle.dumps(made)]})

    spark = bench.sparkSession
    made = materialize(items.groupBy("part").applyInPandas(build, "part int, data binary"), "automata")
    for part in sorted(r["part"] for r in made.select("part").collect()):
        yield spark.sparkContext.broadcast(bytes(made.where(F.col("part") == part).first()["data"]))


def find(docs: DataFrame, bench: DataFrame, text: str = "text", item_text: str = "text", item_id: str = "item_id", into: str = "hits", keep: list[str] | None = None, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The columns ``keep`` (all) of ``docs`` with a struct ``into``: ``n_words``, ``spans`` (merged word
    ranges that lie in occurring windows), ``n_hit`` (words in them), ``items`` (ids with an occurring
    window, sorted).

    Words are runs of letters, digits and characters beyond ASCII, A-Z lower-cased. A window is
    ``WINDOW`` consecutive words of an item, or the whole of a shorter one. Null and empty texts have
    no words; items without id or words have no windows; rows of items that repeat add nothing.

    Items are worked on in blocks of ``block_bytes``, one automaton in each task at a time. With one block the
    words are passed over once and nothing is moved. With more, each block is a pass of its own over the
    stored texts whose hits are stored, and the hits of a document are put together by its row.
    """
    keep = keep or list(docs.columns)
    into = fresh(docs, into)
    own, n, spans, items, row = (fresh(docs, x) for x in ("_text", "_words", "_spans", "_items", "_row"))
    item_kind = bench.schema[item_id].dataType.simpleString()
    nothing = [
        F.lit(0).cast("long").alias(n),
        F.array().cast("array<struct<start:bigint,end:bigint>>").alias(spans),
        F.array().cast(f"array<{item_kind}>").alias(items),
    ]
    bound_batches(docs.sparkSession)
    df = docs.select(*[f"`{c}`" for c in keep], utf8(F.col(f"`{text}`")).alias(own))
    automata = blocks(bench, item_text, item_id, WINDOW, block_bytes)
    first = next(automata, None) or sent(docs.sparkSession, Automaton([]))
    second = next(automata, None)

    def passed(rows: DataFrame, shared: Broadcast) -> DataFrame:
        rows = rows.select("*", *nothing)
        return rows.mapInArrow(lambda b: find_hits(b, shared), rows.schema)

    if second is None:
        df = passed(df, first)
    else:
        df = materialize(df.withColumn(row, F.monotonically_increasing_id()), "documents")
        narrow = df.select(row, own)
        counted = materialize(passed(narrow, first).drop(own), "hits")  # the words of every row
        found = [counted.where(F.size(spans) > 0).select(row, spans, items)]
        for shared in chain([second], automata):
            hits = passed(narrow, shared).where(F.size(spans) > 0).select(row, spans, items)
            found.append(materialize(hits, "hits"))
            shared.unpersist()
        union = reduce(DataFrame.unionAll, found).groupBy(row).agg(
            F.flatten(F.collect_list(spans)).alias(spans), F.array_sort(F.array_distinct(F.flatten(F.collect_list(items)))).alias(items)
        )
        schema = union.schema
        union = union.select(row, spans, items).mapInArrow(merge_spans, schema)
        none = [F.coalesce(F.col(x), nothing[k + 1]).alias(x) for k, x in enumerate((spans, items))]
        words = counted.select(row, n).join(union, row, "left").select(row, n, *none)
        df = df.drop(own).join(words, row).drop(row)
    covered = F.aggregate(spans, F.lit(0).cast("long"), lambda total, x: total + x["end"] - x["start"])
    return df.select(
        *[f"`{c}`" for c in keep],
        F.struct(
            F.col(n).alias("n_words"),
            F.col(spans).alias("spans"),
            covered.alias("n_hit"),
            F.col(items).alias("items"),
        ).alias(into),
    )


def contaminated(into: str, percent: int = 5):
    """Whether the share of hit words reaches the coverage limit."""
    return (F.col(into)["n_hit"] > 0) & (100 * F.col(into)["n_hit"] >= percent * F.col(into)["n_words"])


WORD = re.compile(rb"[^ ]+")


def cut(texts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(..., text, spans) -> (..., text without the spans' words)."""
    for batch in texts:
        out = []
        for data, spans in zip(batch.column(batch.num_columns - 2).to_pylist(), batch.column(batch.num_columns - 1).to_pylist()):
            if data is not None and spans:
                words = [m.span() for m in WORD.finditer(data.translate(LETTERS_AND_DIGITS))]
                parts, at = [], 0
                for s in spans:
                    parts.append(data[at : words[s["start"]][0]])
                    at = words[s["end"] - 1][1]
                data = b"".join([*parts, data[at:]])
            out.append(None if data is None else data.decode())
        yield pa.RecordBatch.from_arrays([*batch.columns[:-2], pa.array(out, pa.string())], names=places(batch.num_columns - 1))


def remove_spans(docs: DataFrame, bench: DataFrame, text: str = "text", min_words: int = WINDOW, **options) -> DataFrame:
    """``docs`` without the hit spans of at least ``min_words`` words in ``text``; all rows stay."""
    into = fresh(docs, "hits")
    found = find(docs, bench, text, into=into, **options)
    body, spans = fresh(found, "_text"), fresh(found, "_spans")
    long_spans = F.filter(F.col(into)["spans"], lambda x: x["end"] - x["start"] >= min_words)
    others = [c for c in docs.columns if c != text]
    found = found.select(*[f"`{c}`" for c in others], utf8(F.col(f"`{text}`")).alias(body), long_spans.alias(spans))
    schema = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in others) + f", `{body}` string"
    done = found.mapInArrow(cut, schema.removeprefix(", "))
    return done.select(*[F.col(body).alias(c) if c == text else F.col(f"`{c}`") for c in docs.columns])


def clean_documents(docs: DataFrame, bench: DataFrame, text: str = "text", percent: int = 5, **options) -> DataFrame:
    """The rows of ``docs`` whose share of hit words stays below the coverage limit, unchanged."""
    into = fresh(docs, "hits")
    return find(docs, bench, text, into=into, **options).where(~contaminated(into, percent)).drop(into)
