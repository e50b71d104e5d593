"""Language identification with a convolutional network over bytes, trained in numpy.

A text is cut into windows of a fixed number of bytes. Filters of several widths slide over the
bytes' embeddings; the greatest response of each filter in a window goes through a softmax layer.
A text's probabilities are the mean of its windows', weighted by their bytes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from martflow.llm.common import fresh, places, received, remainder, sent, utf8

WINDOW = 256  # bytes
UNKNOWN = "und"


@dataclass
class Network:
    """Byte embeddings, filters by width, and the softmax layer."""

    languages: list[str]
    widths: tuple[int, ...] = (2, 3, 4)
    size: int = 8
    filters: int = 16
    seed: int = 7
    weights: dict[str, np.ndarray] = field(default_factory=dict)
    tables: dict[int, list[np.ndarray]] = field(default_factory=dict)

    def __post_init__(self):
        rng = np.random.default_rng(self.seed)
        w = self.weights
        w["embed"] = rng.normal(0, 0.5, (256, self.size)).astype(np.float32)
        for k in self.widths:
            w[f"filter{k}"] = rng.normal(0, (k * self.size) ** -0.5, (k, self.size, self.filters)).astype(np.float32)
            w[f"bias{k}"] = np.zeros(self.filters, np.float32)
        w["out"] = rng.normal(0, 0.1, (len(self.widths) * self.filters, len(self.languages))).astype(np.float32)
        w["out_bias"] = np.zeros(len(self.languages), np.float32)

    def prepare(self) -> None:
        """Responses of filter positions to each byte, or to each pair of bytes: a filter's response
        is then a sum of table rows."""
        w = self.weights
        self.tables = {}
        for k in self.widths:
            each = [w["embed"] @ w[f"filter{k}"][j] for j in range(k)]
            each[0] = each[0] + w[f"bias{k}"]
            pairs = [(each[j][:, None, :] + each[j + 1][None, :, :]).reshape(65536, -1) for j in range(0, k - 1, 2)]
            self.tables[k] = [*pairs, *([each[-1]] if k % 2 else [])]

    def responses(self, data: np.ndarray, k: int) -> np.ndarray:
        """(windows, positions, filters) of the filters of width ``k`` over windows of bytes."""
        n = data.shape[1] - k + 1
        pair = data[:, :-1].astype(np.int32) * 256 + data[:, 1:]
        out = None
        for j, table in enumerate(self.tables[k]):
            at = 2 * j
            part = table[pair[:, at : at + n]] if len(table) == 65536 else table[data[:, at : at + n]]
            out = part if out is None else np.add(out, part, out=out)
        return out

    def pooled(self, data: np.ndarray) -> np.ndarray:
        return np.concatenate([np.maximum(self.responses(data, k).max(axis=1), 0) for k in self.widths], axis=1)

    def probabilities(self, data: np.ndarray) -> np.ndarray:
        z = self.pooled(data) @ self.weights["out"] + self.weights["out_bias"]
        z = np.exp(z - z.max(axis=1, keepdims=True))
        return z / z.sum(axis=1, keepdims=True)

    def train(self, data: np.ndarray, labels: np.ndarray, epochs: int = 6, batch: int = 64, rate: float = 0.004) -> Network:
        """Adam on the cross entropy; only the position that won the pooling passes a gradient back."""
        w = self.weights
        rng = np.random.default_rng(self.seed)
        first = {n: np.zeros_like(v) for n, v in w.items()}
        second = {n: np.zeros_like(v) for n, v in w.items()}
        step = 0
        for _ in range(epochs):
            order = rng.permutation(len(data))
            for at in range(0, len(order), batch):
                x, y = data[order[at : at + batch]], labels[order[at : at + batch]]
                n = len(x)
                grads = {}
                winners, values = {}, []
                for k in self.widths:
                    patches = np.lib.stride_tricks.sliding_window_view(x, k, axis=1)
                    flat = w["embed"][patches].reshape(n, patches.shape[1], k * self.size)
                    r = flat @ w[f"filter{k}"].reshape(k * self.size, self.filters) + w[f"bias{k}"]
                    best = r.argmax(axis=1)
                    winners[k] = np.take_along_axis(patches, best[:, :, None], axis=1)  # (n, filters, k)
                    values.append(np.take_along_axis(r, best[:, None, :], axis=1)[:, 0])
                raw = np.concatenate(values, axis=1)
                hidden = np.maximum(raw, 0)
                z = hidden @ w["out"] + w["out_bias"]
                p = np.exp(z - z.max(axis=1, keepdims=True))
                p /= p.sum(axis=1, keepdims=True)
                p[np.arange(n), y] -= 1
                p /= n
                grads["out"], grads["out_bias"] = hidden.T @ p, p.sum(axis=0)
                back = (p @ w["out"].T) * (raw > 0)
                grads["embed"] = np.zeros_like(w["embed"])
                for i, k in enumerate(self.widths):
                    d = back[:, i * self.filters : (i + 1) * self.filters]
                    won = winners[k]
                    grads[f"bias{k}"] = d.sum(axis=0)
                    grads[f"filter{k}"] = np.einsum("nf,nfke->kef", d, w["embed"][won])
                    np.add.at(grads["embed"], won, np.einsum("nf,kef->nfke", d, w[f"filter{k}"]))
                step += 1
                for name, g in grads.items():
                    first[name] += 0.1 * (g - first[name])
                    second[name] += 0.001 * (g * g - second[name])
                    w[name] -= (rate * (first[name] / (1 - 0.9**step)) / (np.sqrt(second[name] / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
        return self


def windows(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All windows of the texts, the last of each filled up with zeros, and the text of each. A-Z are lower-cased."""
    counts = np.array([-(-len(t) // WINDOW) for t in texts], np.int64)
    data = b"".join(t + bytes(-len(t) % WINDOW) for t in texts).lower()
    return np.frombuffer(data, np.uint8).reshape(-1, WINDOW), np.repeat(np.arange(len(texts)), counts)


def predict_texts(network: Network, texts: list[bytes], chunk: int = 512) -> np.ndarray:
    """Mean probabilities of each text; zeros for an empty one."""
    out = np.zeros((len(texts), len(network.languages)))
    data, owner = windows(texts)
    for at in range(0, len(data), chunk):
        part = data[at : at + chunk]
        weight = np.count_nonzero(part, axis=1).astype(float)
        np.add.at(out, owner[at : at + chunk], network.probabilities(part) * weight[:, None])
    return out / np.maximum(out.sum(axis=1, keepdims=True), 1e-300)


def predict_batches(batches: Iterator[pa.RecordBatch], shared) -> Iterator[pa.RecordBatch]:
    """(..., text or null) -> (..., language, score); null is of unknown language."""
    network: Network = received(shared)
    if network.languages:
        network.prepare()
    for whole in batches:
        for first in range(0, whole.num_rows, 256):
            batch = whole.slice(first, 256)
            texts = batch.column(batch.num_columns - 1).to_pylist()
            names: list[str] = [UNKNOWN] * len(texts)
            scores = np.zeros(len(texts))
            some = [i for i, t in enumerate(texts) if t] if network.languages else []
            if some:
                p = predict_texts(network, [texts[i] for i in some])
                for i, best, row in zip(some, p.argmax(axis=1), p):
                    names[i], scores[i] = network.languages[best], min(1.0, float(row[best]))
            columns = [*batch.columns[:-1], pa.array(names, pa.string()), pa.array(scores, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, names=places(len(columns)))


def cut_windows(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """(lang, text) -> (lang, window): at most ``most`` windows of each text, evenly spread over it."""
    for batch in batches:
        langs, out = [], []
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            starts = range(0, len(text), WINDOW)
            for k in np.unique(np.linspace(0, len(starts) - 1, min(most, len(starts))).astype(int)):
                langs.append(lang)
                out.append(text[starts[k] : starts[k] + WINDOW].lower().ljust(WINDOW, b"\0"))
        yield pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(out, pa.binary())], names=["lang", "window"])


def learn(labelled: DataFrame, doc_id: str, text: str, lang: str, per_language: int = 400, windows_each: int = 8) -> Network:
    """A network trained on a bounded sample: of each language, the ``per_language`` rows whose hashed ids
    are least, ``windows_each`` windows of each. Rows without language or letters are left out.

    A first pass counts hashes by their length in bits, which tells for each language below which length
    there are enough; only texts of such rows, about twice as many as wanted, are moved to be ranked. Equal
    ids are ranked by their texts.
    """
    rows = labelled.select(
        F.col(f"`{lang}`").cast("string").alias("lang"), F.col(f"`{text}`").cast("string").alias("text"),
        F.xxhash64(F.col(f"`{doc_id}`")).alias("order"),
    ).where("lang is not null").where(F.col("text").rlike(r"\p{L}"))
    above_least = F.shiftrightunsigned(F.col("order").bitwiseXOR(F.lit(-(1 << 63))), 1)
    rows = rows.withColumn("bits", F.length(F.bin(above_least)))
    counts: dict[str, dict[int, int]] = {}
    for r in rows.groupBy("lang", "bits").agg(F.count("*").alias("n")).collect():  # 64 rows for each language
        counts.setdefault(r["lang"], {})[r["bits"]] = r["n"]
    enough = []
    for name, by_bits in counts.items():
        found = 0
        for bits in sorted(by_bits):
            found += by_bits[bits]
            if found >= per_language or bits == max(by_bits):
                enough.append((name, bits))
                break
    limits = labelled.sparkSession.createDataFrame(enough, "lang string, most int")
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("order", "text"))
    rows = rows.join(F.broadcast(limits), "lang").where("bits <= most")  # one row for each language
    rows = rows.withColumn("rank", rank).where(F.col("rank") <= per_language)
    cut = rows.select("lang", utf8(F.col("text")).alias("text")).mapInArrow(lambda b: cut_windows(b, windows_each), "lang string, window binary")
    found = sorted((r["lang"], bytes(r["window"])) for r in cut.collect())
    names = sorted({name for name, _ in found})
    network = Network(names)
    if len(names) > 1:
        data = np.frombuffer(b"".join(w for _, w in found), np.uint8).reshape(-1, WINDOW)
        network.train(data, np.array([names.index(name) for name, _ in found]))
    return network


def identify(docs: DataFrame, labelled: DataFrame, text: str = "text", lang: str = "lang", doc_id: str = "doc_id", into: str = "language", keep: list[str] | None = None, **sample) -> DataFrame:
    """The columns ``keep`` (all) of ``docs`` with a struct ``into``: ``lang``, ``score`` (0 to 1).

    The network learns from ``labelled`` (see ``learn``), and sees nothing but the bytes of a text, all
    of them. Texts that are null or have no letter are ``und`` with score 0, as are all if there is
    nothing to learn from. No shuffle.
    """
    keep = keep or list(docs.columns)
    body, into = fresh(docs, "_text"), fresh(docs, into)
    shared = sent(docs.sparkSession, learn(labelled, doc_id, text, lang, **sample))  # some 50 kB
    own = F.col(f"`{text}`").cast("string")
    rows = docs.select(*[f"`{c}`" for c in keep], F.when(own.rlike(r"\p{L}"), utf8(own)).alias(body))
    one, two = fresh(rows, "_lang"), fresh(rows, "_score")
    kinds = "".join(f"`{c.name}` {c.dataType.simpleString()}, " for c in rows.drop(body).schema)
    done = rows.mapInArrow(lambda b: predict_batches(b, shared), f"{kinds}`{one}` string, `{two}` double")
    return done.select(*[f"`{c}`" for c in keep], F.struct(F.col(one).alias("lang"), F.col(two).alias("score")).alias(into))


def training_part(docs: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """The documents that may be learnt from: four fifths by a checksum of the id."""
    return docs.where(remainder(F.col(f"`{doc_id}`"), 5) != 0)
