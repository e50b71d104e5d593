"""Document quality from a conditional random field over lines, trained in numpy.

Every line is good or bad. What a line says about that is counted from its bytes and from those of
its neighbours; a chain ties neighbouring lines. The probability that a line is good, given the whole
document, comes from the forward-backward recursion; a document's quality is the mean over its lines,
weighted by their length.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martflow.llm.common import fresh, places, received, remainder, sent, utf8
from martflow.llm.words import U, mix

# Byte classes that features count, as the bytes they hold.
CLASSES = {
    "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "digit": b"0123456789",
    "sentence": b".,;:'\"()-",
    "emphasis": b"!?",
    "symbol": b"#*$%&<>@^~_=+\\/[]{}`",
    "pipe": b"|",
}
# Limits of the steps that a ratio is cut into; the same for all ratios but the last two.
RATIO_STEPS = (0.005, 0.02, 0.05, 0.1, 0.2, 0.4)
LENGTH_STEPS = (1, 3, 8, 20, 60, 200)  # words
WORD_STEPS = (2.5, 4.0, 5.0, 6.0, 7.5, 10.0)  # letters a word
RATIOS = (*CLASSES, "beyond_ascii", "repeated_words", "equal_neighbours")
STEPS = len(RATIO_STEPS) + 1
WIDTH = (len(RATIOS) + 3) * STEPS + 2  # ratios, two lengths, distinct words; repeated line, constant
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
CLASS_OF = np.zeros(256, np.uint8)
for _k, _held in enumerate(CLASSES.values(), 1):
    CLASS_OF[list(_held)] = _k
CLASS_OF[128:] = len(CLASSES) + 1


def sums(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Sum of values[start:end] for each range."""
    total = np.concatenate(([0], np.cumsum(values, dtype=np.int64)))
    return total[ends] - total[starts]


def line_features(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(features as 0 or 1, bytes of each line, number of lines of each text) of the texts' lines."""
    data = b"\n".join(texts) + b"\n"
    buf = np.frombuffer(data, np.uint8)
    ends = np.flatnonzero(buf == 10)
    starts = np.concatenate(([0], ends[:-1] + 1))
    counts = np.array([t.count(b"\n") + 1 for t in texts], np.int64)
    doc = np.repeat(np.arange(len(texts)), counts)
    n = len(starts)
    length = ends - starts

    # Words, each named by a hash of its bytes.
    inside = ~SPACE[buf]
    edge = np.diff(np.concatenate(([0], inside.view(np.int8), [0])))
    w_start, w_end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    line_of_word = np.searchsorted(ends, w_start)
    if len(w_start):
        at = np.arange(len(buf))
        place = at - np.maximum.accumulate(np.where(edge[:-1] == 1, at, 0))
        power = mix(np.arange(64, dtype=U) + U(1)) | U(1)
        weighted = np.where(inside, (buf.astype(U) + U(1)) * power[place & 63], U(0))
        word = mix(np.add.reduceat(weighted, w_start) + (w_end - w_start).astype(U))
    else:
        word = np.empty(0, U)
    words = np.bincount(line_of_word, minlength=n)
    letters = np.bincount(line_of_word, w_end - w_start, minlength=n)

    same = np.zeros(len(word), bool)
    if len(word):
        same[1:] = (word[1:] == word[:-1]) & (line_of_word[1:] == line_of_word[:-1])
    mark = mix(word ^ mix(line_of_word.astype(U)))
    order = np.argsort(mark, kind="stable")
    again = np.zeros(len(word), bool)
    again[order[1:]] = mark[order[1:]] == mark[order[:-1]]
    repeated = np.bincount(line_of_word, again, minlength=n)
    equal = np.bincount(line_of_word, same, minlength=n)

    # A line that its document has had before.
    code = np.zeros(n, U)
    if len(word):
        where = word * mix(np.arange(len(word), dtype=U) - np.searchsorted(line_of_word, line_of_word).astype(U) + U(1))
        np.add.at(code, line_of_word, where)
    key = mix(code ^ mix(doc.astype(U) + U(1)))
    order = np.argsort(key, kind="stable")
    before = np.zeros(n, bool)
    before[order[1:]] = key[order[1:]] == key[order[:-1]]
    before &= words > 0

    kind = CLASS_OF[buf]
    ratios = [sums(kind == k, starts, ends) / np.maximum(letters, 1) for k in range(1, len(CLASSES) + 2)]
    ratios += [repeated / np.maximum(words, 1), equal / np.maximum(words, 1)]
    out = np.zeros((n, WIDTH), np.uint8)
    rows = np.arange(n)
    steps = [np.searchsorted(RATIO_STEPS, r, "right") for r in ratios]
    steps.append(np.searchsorted(LENGTH_STEPS, words, "right"))
    steps.append(np.searchsorted(WORD_STEPS, letters / np.maximum(words, 1), "right"))
    steps.append(np.searchsorted(LENGTH_STEPS, words - repeated, "right"))
    for f, step in enumerate(steps):
        out[rows, f * STEPS + step] = 1
    out[:, -2] = before
    out[:, -1] = 1
    return out, length, counts


@dataclass
class Field:
    """Weights for a line being good, from its own features and those of the lines before and after;
    scores of two labels next to each other, of the first and of the last label."""

    own: np.ndarray
    before: np.ndarray
    after: np.ndarray
    pair: np.ndarray
    ends: np.ndarray

    @classmethod
    def zero(cls) -> Field:
        return cls(np.zeros(WIDTH), np.zeros(WIDTH), np.zeros(WIDTH), np.zeros((2, 2)), np.zeros((2, 2)))

    def local(self, x: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """What speaks for each line being good, without its label's neighbours."""
        own, left, right = (x @ np.stack([self.own, self.before, self.after], 1).astype(np.float32)).T.astype(float)
        first = np.cumsum(counts) - counts
        last = first + counts - 1
        out = own
        inner = np.ones(len(x), bool)
        inner[first] = False
        out[inner] += left[np.flatnonzero(inner) - 1]
        inner[first] = True
        inner[last] = False
        out[inner] += right[np.flatnonzero(inner) + 1]
        return out

    def marginals(self, u: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
        """(probability of good for each line, expected counts of label pairs, sum of log partition functions).

        Documents go side by side, one line each a step, the longest first, so that a step is a prefix.
        """
        order = np.argsort(-counts, kind="stable")
        first = (np.cumsum(counts) - counts)[order]
        size = counts[order]
        score = np.stack([np.zeros(len(u)), u], 1)
        score[first] += self.ends[0]
        score[first + size - 1] += self.ends[1]
        alpha, beta = np.empty_like(score), np.zeros_like(score)
        alpha[first] = score[first]
        active = [np.searchsorted(-size, -t, "left") for t in range(int(size[0]) + 1)]  # documents with over t lines
        for t in range(1, int(size[0])):
            at = first[: active[t]] + t
            into = alpha[at - 1][:, :, None] + self.pair
            alpha[at] = np.logaddexp(into[:, 0], into[:, 1]) + score[at]
        for t in range(int(size[0]) - 1, 0, -1):
            at = first[: active[t]] + t
            out = (score[at] + beta[at])[:, None, :] + self.pair
            beta[at - 1] = np.logaddexp(out[:, :, 0], out[:, :, 1])
        last = first + size - 1
        z = np.logaddexp(alpha[last, 0], alpha[last, 1])
        total = np.empty(len(counts))
        total[order] = z
        each = np.repeat(total, counts)
        good = np.exp(np.minimum(alpha[:, 1] + beta[:, 1] - each, 0))
        inner = np.ones(len(u), bool)
        inner[first] = False
        at = np.flatnonzero(inner)
        joint = alpha[at - 1][:, :, None] + self.pair + (score[at] + beta[at])[:, None, :] - each[at][:, None, None]
        return good, np.exp(np.minimum(joint, 0)).sum(axis=0), float(z.sum())

    def train(self, x: np.ndarray, counts: np.ndarray, labels: np.ndarray, rounds: int = 250, rate: float = 0.05, decay: float = 1e-4) -> Field:
        """Adam on the likelihood of the documents' labels, which all their lines take."""
        y = np.repeat(labels, counts).astype(float)
        first = np.cumsum(counts) - counts
        last = first + counts - 1
        has_before, has_after = np.ones(len(x), bool), np.ones(len(x), bool)
        has_before[first] = False
        has_after[last] = False
        before, after = np.flatnonzero(has_before), np.flatnonzero(has_after)
        true_pair = np.zeros((2, 2))
        np.add.at(true_pair, (y[before - 1].astype(int), y[before].astype(int)), 1)
        x32 = x.astype(np.float32)
        names = ("own", "before", "after", "pair", "ends")
        m = {n: np.zeros_like(getattr(self, n)) for n in names}
        v = {n: np.zeros_like(getattr(self, n)) for n in names}
        for step in range(1, rounds + 1):
            good, pairs, _ = self.marginals(self.local(x32, counts), counts)
            d = (y - good).astype(np.float32)
            ends = np.zeros((2, 2))
            for k, at in enumerate((first, last)):
                ends[k] = [-d[at].sum(), d[at].sum()]
            grads = {"own": x32.T @ d, "before": x32[before - 1].T @ d[before], "after": x32[after + 1].T @ d[after], "pair": true_pair - pairs, "ends": ends}
            for n, g in grads.items():
                g = g / len(x) - decay * getattr(self, n)
                m[n] += 0.1 * (g - m[n])
                v[n] += 0.01 * (g * g - v[n])
                setattr(self, n, getattr(self, n) + rate * (m[n] / (1 - 0.9**step)) / (np.sqrt(v[n] / (1 - 0.99**step)) + 1e-9))
        return self

    def quality(self, texts: list[bytes]) -> np.ndarray:
        """Share of good text, 0 to 1: the marginals of a text's lines weighted by their bytes (one at least)."""
        x, length, counts = line_features(texts)
        good, _, _ = self.marginals(self.local(x.astype(np.float32), counts), counts)
        weight = np.maximum(length, 1).astype(float)
        first = np.cumsum(counts) - counts
        return np.clip(np.add.reduceat(good * weight, first) / np.add.reduceat(weight, first), 0.0, 1.0)


def feature_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(order, label, text) -> (order, label, lines, features)."""
    for batch in batches:
        made = [line_features([t or b""]) for t in batch.column(2).to_pylist()]
        packed = [np.packbits(x, axis=1).tobytes() for x, _, _ in made]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array([int(c[0]) for *_, c in made], pa.int64()), pa.array(packed, pa.binary())],
            names=["order", "label", "lines", "features"],
        )


def score_batches(batches: Iterator[pa.RecordBatch], shared, limit: int = 1_000_000) -> Iterator[pa.RecordBatch]:
    """(..., text) -> (..., score); works on some million bytes at once, or one longer text."""
    model: Field = received(shared)
    for batch in batches:
        scores: list[float] = []
        held: list[bytes] = []
        size = 0
        for text in batch.column(batch.num_columns - 1).to_pylist():
            held.append(text or b"")
            size += len(held[-1])
            if size >= limit:
                scores += model.quality(held).tolist()
                held, size = [], 0
        if held:
            scores += model.quality(held).tolist()
        yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(scores, pa.float64())], names=places(batch.num_columns))


def learn(docs: DataFrame, labels: DataFrame, text: str, doc_id: str, label: str, max_documents: int = 6000, max_lines: int = 1000) -> Field:
    """A field trained on a bounded sample: the ``max_documents`` labelled documents whose hashed ids are
    least, leaving out those of over ``max_lines`` lines. Without labelled documents all weights are 0."""
    chosen = labels.select(F.col(f"`{doc_id}`").alias("id"), F.col(f"`{label}`").cast("int").alias("label"))
    chosen = chosen.where("id is not null and label in (0, 1)").select(F.xxhash64("id").alias("order"), "id", "label")
    chosen = chosen.orderBy("order", "id", "label").limit(max_documents)
    rows = docs.select(F.col(f"`{doc_id}`").alias("id"), F.col(f"`{text}`").cast("string").alias("text"))
    ends = F.length("text") - F.length(F.replace(F.col("text"), F.lit("\n"), F.lit("")))
    rows = rows.where(F.coalesce(ends, F.lit(0)) < max_lines).join(F.broadcast(chosen), "id")
    made = rows.select("order", "label", utf8(F.col("text")).alias("text")).mapInArrow(
        feature_batches, "order bigint, label int, lines bigint, features binary"
    )
    found = sorted((r["order"], r["label"], r["lines"], bytes(r["features"])) for r in made.collect())
    if not found:
        return Field.zero()
    counts = np.array([f[2] for f in found], np.int64)
    packed = np.frombuffer(b"".join(f[3] for f in found), np.uint8).reshape(int(counts.sum()), -1)
    return Field.zero().train(np.unpackbits(packed, axis=1, count=WIDTH), counts, np.array([f[1] for f in found]))


def score(docs: DataFrame, labelled: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id", label: str = "quality", into: str = "score", keep: list[str] | None = None, **sample) -> DataFrame:
    """The columns ``keep`` (all) of ``docs`` with a column ``into``: the quality of ``text``, 0 to 1.

    The field learns from the rows of ``labelled`` that ``labels`` has a label (0 or 1) for (see
    ``learn``) and sees nothing but the lines of a text, all of them. Null counts as empty; an empty
    text is one empty line and has a score too. No shuffle.
    """
    keep = keep or list(docs.columns)
    body, into = fresh(docs, "_text"), fresh(docs, into)
    shared = sent(docs.sparkSession, learn(labelled, labels, text, doc_id, label, **sample))  # some 2 kB
    rows = docs.select(*[f"`{c}`" for c in keep], utf8(F.col(f"`{text}`")).alias(body))
    kinds = "".join(f"`{c.name}` {c.dataType.simpleString()}, " for c in rows.drop(body).schema)
    done = rows.mapInArrow(lambda b: score_batches(b, shared), f"{kinds}`{into}` double")
    return done.select(*[f"`{c}`" for c in keep], into)


def training_part(rows: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """The rows that may be learnt from: two thirds by a checksum of the id."""
    return rows.where(remainder(F.col(f"`{doc_id}`"), 3) != 1)
