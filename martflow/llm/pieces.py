"""SentencePiece models run by the tokenizers library: encoding, decoding, and a check of both.

The model file is parsed here; its normaliser, white-space marker, scores and byte fallback are
rebuilt as a ``Tokenizer``. Texts are cut where no piece can reach across (before a run of markers),
so that the parts of a text can be encoded on their own; parts that return are encoded once.
"""

from __future__ import annotations

import gc
import os
import struct
from array import array
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cached_property
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martflow.llm.common import fresh, places, received, sent

MARK = "▁"  # fixed value: stands for a space in pieces
DEFAULT_MODEL = "/opt/tokenizers/piece_bpe_32k.model"

# Fixed values of the model format.
UNIGRAM, BPE = 1, 2
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6


def varint(data: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        byte = data[at]
        at += 1
        value |= (byte & 0x7F) << shift
        if byte < 0x80:
            return value, at
        shift += 7


def fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of each field of a protobuf message; messages and texts stay bytes."""
    at = 0
    while at < len(data):
        key, at = varint(data, at)
        kind = key & 7
        if kind == 0:
            value, at = varint(data, at)
        else:
            if kind == 2:
                size, at = varint(data, at)
            elif kind in (1, 5):
                size = 8 if kind == 1 else 4
            else:
                raise ValueError(f"field of unknown wire type {kind}")
            value, at = data[at : at + size], at + size
        yield key >> 3, value


@dataclass
class Model:
    """What a model file says."""

    pieces: list[tuple[str, float, int]] = field(default_factory=list)  # text, score, type
    kind: int = UNIGRAM
    byte_fallback: bool = False
    unk_id: int = 0
    charsmap: bytes = b""
    dummy_prefix: bool = True
    squeeze: bool = True
    escape: bool = True

    @classmethod
    def parse(cls, data: bytes) -> Model:
        out = cls()
        for number, value in fields(data):
            if number == 1:
                piece = dict(fields(value))
                score = struct.unpack("<f", piece[2])[0] if 2 in piece else 0.0
                out.pieces.append((piece.get(1, b"").decode(), score, piece.get(3, NORMAL)))
            elif number == 2:
                spec = dict(fields(value))
                out.kind = spec.get(3, UNIGRAM)
                out.byte_fallback = bool(spec.get(35, 0))
                out.unk_id = spec.get(40, 0)
                if spec.get(24, 0):
                    raise ValueError("markers at word ends are not supported")
            elif number == 3:
                spec = dict(fields(value))
                out.charsmap = spec.get(2, b"")
                out.dummy_prefix = bool(spec.get(3, 1))
                out.squeeze = bool(spec.get(4, 1))
                out.escape = bool(spec.get(5, 1))
        return out

    @cached_property
    def cuttable(self) -> bool:
        """Whether no piece has a marker behind another character."""
        return self.escape and not any(MARK in text.lstrip(MARK) for text, _, kind in self.pieces if kind != CONTROL)

    def tokenizer(self, normalise: bool = True, like=None):
        """``like``: a tokenizer of this model, whose tables are shared."""
        from tokenizers import AddedToken, Regex, Tokenizer, decoders, models, normalizers

        if like is not None:
            out = Tokenizer(like.model)
        elif self.kind == UNIGRAM:
            scored = [(text, score) for text, score, _ in self.pieces]
            out = Tokenizer(models.Unigram(scored, self.unk_id, self.byte_fallback))
        elif self.kind == BPE:
            ids = {text: i for i, (text, _, _) in enumerate(self.pieces)}
            usable = {text for text, _, kind in self.pieces if kind in (NORMAL, USER_DEFINED)}
            ranked = []
            for text, score, kind in self.pieces:
                if kind == NORMAL:
                    halves = [(text[:k], text[k:]) for k in range(1, len(text))]
                    ranked += [(-score, ids[a], ids[b], (a, b)) for a, b in halves if a in usable and b in usable]
            merges = [pair for *_, pair in sorted(ranked)]
            unk = self.pieces[self.unk_id][0]
            out = Tokenizer(models.BPE(ids, merges, unk_token=unk, fuse_unk=True, byte_fallback=self.byte_fallback))
        else:
            raise ValueError(f"model type {self.kind} is not supported")
        own = [AddedToken(text, normalized=False) for text, _, kind in self.pieces if kind == USER_DEFINED]
        if own:
            out.add_tokens(own)
        steps = [normalizers.Precompiled(self.charsmap)] if self.charsmap else []
        if self.squeeze:
            steps += [normalizers.Strip(), normalizers.Replace(Regex(" {2,}"), " ")]
        if self.dummy_prefix:
            steps.append(normalizers.Prepend(" "))
        if self.escape:
            steps.append(normalizers.Replace(" ", MARK))
        if normalise and steps:
            out.normalizer = normalizers.Sequence(steps)
        back = [decoders.ByteFallback(), decoders.Fuse(), decoders.Replace(MARK, " ")]  # once for the joined text
        if self.dummy_prefix:
            back.append(decoders.Strip(" ", 1, 0))  # of the whole text, after all is joined
        out.decoder = decoders.Sequence(back)
        return out


class Codec:
    """Encodes and decodes batches of texts; made from a model file's bytes, once for each task.

    A part of a text is what follows a space, up to the next one; further spaces before it belong
    to it. Where no piece has a line end, a text is also cut before each, and such a part begins
    with it. ``learn`` runs the tokenizers library on parts not seen lately; the reference library
    encodes every text whole, so that the cutting is compared as well.
    """

    REMEMBER = 500_000  # parts of at most LONG characters, some 130 MB
    LONG = 48
    GROUP = 1_000_000  # characters of texts that are worked on at once
    ROW = 256  # words that are encoded as one text

    def __init__(self, data: bytes, threads: int = 2):
        # Read when the library first encodes; a thread for every core of the machine would be too many.
        os.environ.setdefault("RAYON_NUM_THREADS", str(threads))
        import sentencepiece
        from tokenizers import decoders

        self.model = model = Model.parse(data)
        self.whole = model.tokenizer()
        self.plain = model.tokenizer(normalise=False, like=self.whole)
        self.plain.decoder = decoders.Sequence([decoders.ByteFallback(), decoders.Fuse()])  # see decode
        self.other = sentencepiece.SentencePieceProcessor(model_proto=data)
        self.cut = model.cuttable and model.dummy_prefix
        self.lines = self.cut and not any("\n" in text for text, _, _ in model.pieces)
        self.simple = not (model.charsmap or model.squeeze)
        self.known: dict[str, bytes] = {}
        self.begins = np.array([text.startswith(MARK) for text, _, _ in model.pieces])
        self.bytes = [
            bytes([int(text[1:-1], 16)]) if kind == BYTE else text.replace(MARK, " ").encode()
            for text, _, kind in model.pieces
        ]

    def parts(self, text: str) -> list[str]:
        """The parts of a text, each without its first marker."""
        if not self.cut:
            return [text]
        if not self.simple:
            text = self.whole.normalizer.normalize_str(text).removeprefix(MARK).replace(MARK, " ")
        text = text.replace(MARK, " ")  # both are a marker to the model
        found = (text.replace("\n", " \n") if self.lines else text).split(" ")
        if "" not in found:
            return found
        out, spaces = [], 0
        for k, part in enumerate(found):
            if part == "" and k < len(found) - 1 and not (self.lines and found[k + 1].startswith("\n")):
                spaces += 1
            else:
                out.append(" " * spaces + part)
                spaces = 0
        return out

    def learn(self, parts: list[str]) -> dict[str, bytes]:
        """The ids of each part, as bytes.

        Parts that are one word go to the library in rows of ``ROW``: as no piece reaches across a marker, a
        row's ids are those of its words, and a new word begins wherever a piece begins with the marker.
        """
        if not self.cut:
            return dict(zip(parts, map(self._ids, self.whole.encode_batch_fast(parts, add_special_tokens=False))))
        words = [p for p in parts if p and " " not in p and not (self.lines and p.startswith("\n"))]
        rows = [words[k : k + self.ROW] for k in range(0, len(words), self.ROW)]
        coded = self.plain.encode_batch_fast([MARK + MARK.join(row) for row in rows], add_special_tokens=False)
        known: dict[str, bytes] = {}
        for row, c in zip(rows, coded):
            ids = np.array(c.ids, np.int32)
            begin = np.flatnonzero(self.begins[ids])
            if len(begin) == len(row) and begin[0] == 0:
                flat, ends = ids.tobytes(), [*(begin * 4).tolist(), len(ids) * 4]
                known.update(zip(row, [flat[a:b] for a, b in zip(ends, ends[1:])]))
        others = [p for p in parts if p not in known]
        texts = [p if self.lines and p.startswith("\n") else MARK + p.replace(" ", MARK) for p in others]
        known.update(zip(others, map(self._ids, self.plain.encode_batch_fast(texts, add_special_tokens=False))))
        return known

    @staticmethod
    def _ids(coded) -> bytes:
        return np.array(coded.ids, np.int32).tobytes()

    def encode(self, texts: list[str]) -> list[tuple[np.ndarray, bool]]:
        """(ids, parity) of each text. Empty texts have no ids."""
        if len(self.known) > self.REMEMBER:
            self.known.clear()
        cut = [self.parts(t) if t else [] for t in texts]
        missing = set(chain.from_iterable(cut)).difference(self.known)
        self.known.update(self.learn(list(missing)))
        found = [b"".join(map(self.known.__getitem__, parts)) for parts in cut]
        for p in missing:
            if len(p) > self.LONG:
                del self.known[p]
        other = self.other.encode(texts, num_threads=1)
        return [(np.frombuffer(x, np.int32), array("i", theirs).tobytes() == x) for x, theirs in zip(found, other)]

    def decode(self, ids: list[np.ndarray]) -> list[str]:
        """The texts of ids by the tokenizers library; markers become spaces in each text as a whole."""
        texts = self.plain.decode_batch([x.tolist() for x in ids], skip_special_tokens=False)
        texts = [t.replace(MARK, " ") for t in texts]
        return [t.removeprefix(" ") for t in texts] if self.model.dummy_prefix else texts

    def text(self, ids: np.ndarray) -> str:
        """The same by the pieces' own bytes, for long sequences."""
        data = b"".join(map(self.bytes.__getitem__, ids.tolist()))
        if self.model.dummy_prefix:
            data = data.removeprefix(b" ")
        return data.decode(errors="replace")


def groups(batch: pa.RecordBatch, column: int, limit: int) -> Iterator[tuple[pa.RecordBatch, list]]:
    """The batch in runs of rows whose texts have about ``limit`` bytes or ids, or of one long text."""
    values = batch.column(column)
    sizes = pc.list_value_length(values) if pa.types.is_list(values.type) else pc.binary_length(values)
    total = np.cumsum(sizes.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64))
    first = 0
    while first < len(values):
        held = total[first - 1] if first else 0
        end = max(first + 1, int(np.searchsorted(total, held + limit, "right")))
        yield batch.slice(first, end - first), values.slice(first, end - first).to_pylist()
        first = end


def tidy() -> None:
    """Give freed memory back: the task's process stays for other tasks, beside the executor's heap."""
    gc.collect()
    pa.default_memory_pool().release_unused()


def encode_batches(batches: Iterator[pa.RecordBatch], shared) -> Iterator[pa.RecordBatch]:
    """(..., text) -> (..., ids, parity)."""
    codec = Codec(received(shared))
    for whole in batches:
        for batch, texts in groups(whole, whole.num_columns - 1, codec.GROUP):
            coded = codec.encode([t or "" for t in texts])
            ids = pa.array([None if t is None else x for t, (x, _) in zip(texts, coded)], pa.list_(pa.int32()))
            parity = pa.array([same for _, same in coded], pa.bool_())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], ids, parity], names=places(batch.num_columns + 1))
    del codec
    tidy()


def decode_batches(batches: Iterator[pa.RecordBatch], shared) -> Iterator[pa.RecordBatch]:
    """(..., ids) -> (..., text)."""
    codec = Codec(received(shared))
    for whole in batches:
        for batch, ids in groups(whole, whole.num_columns - 1, codec.GROUP):
            texts = codec.decode([np.array([] if x is None else x, np.int32) for x in ids])
            texts = [None if x is None else t for x, t in zip(ids, texts)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(texts, pa.string())], names=places(batch.num_columns))
    del codec
    tidy()


def digest_batches(batches: Iterator[pa.RecordBatch], shared) -> Iterator[pa.RecordBatch]:
    """(..., text) -> (..., ids, parity, same): as ``encode_batches``, with whether the ids decode to the text."""
    codec = Codec(received(shared))
    for whole in batches:
        for batch, texts in groups(whole, whole.num_columns - 1, codec.GROUP):
            texts = [t or "" for t in texts]
            coded = codec.encode(texts)
            back = codec.decode([x for x, _ in coded])
            columns = [
                pa.array([x.tobytes() for x, _ in coded], pa.binary()),
                pa.array([p for _, p in coded], pa.bool_()),
                pa.array([a == b for a, b in zip(texts, back)], pa.bool_()),
            ]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *columns], names=places(batch.num_columns + 2))
    del codec
    tidy()


def model_bytes(path: str) -> bytes:
    """The model file, read by the driver (some 500 kB) and sent along."""
    with open(path, "rb") as f:
        return f.read()


def _schema(df: DataFrame) -> str:
    return "".join(f"`{c.name}` {c.dataType.simpleString()}, " for c in df.schema)


def encode(docs: DataFrame, text: str = "text", model: str = DEFAULT_MODEL, into: str = "ids") -> DataFrame:
    """``docs`` with the ids of ``text`` (array<int>; null for null, empty for empty)."""
    into, body = fresh(docs, into), fresh(docs, "_text")
    shared = sent(docs.sparkSession, model_bytes(model))
    kept = docs.select("*", F.col(f"`{text}`").cast("string").alias(body))
    names = [c for c in docs.columns]
    done = kept.mapInArrow(lambda b: encode_batches(b, shared), f"{_schema(docs)} `{into}` array<int>, `{into}_parity` boolean")
    return done.select(*[f"`{c}`" for c in names], into)


def decode(rows: DataFrame, ids: str = "ids", model: str = DEFAULT_MODEL, into: str = "decoded") -> DataFrame:
    """``rows`` with the text that ``ids`` (array<int>) stands for; null for null."""
    into, body = fresh(rows, into), fresh(rows, "_ids")
    shared = sent(rows.sparkSession, model_bytes(model))
    kept = rows.select("*", F.col(f"`{ids}`").alias(body))
    return kept.mapInArrow(lambda b: decode_batches(b, shared), f"{_schema(rows)} `{into}` string")


def checked(docs: DataFrame, text: str = "text", model: str = DEFAULT_MODEL, keep: list[str] | None = None, into: str = "coded") -> DataFrame:
    """The columns ``keep`` (all) of ``docs`` with a struct ``into``: ``n_tokens``, ``ids`` (binary, 32-bit
    little-endian), ``parity`` (the reference library gives the same ids), ``round_trip`` (the ids decode
    to the text).

    Null and empty texts have no ids; both hold for them. A text that has the marker character itself
    decodes to a space there. No shuffle; a task holds some million characters at once, or one text.
    """
    keep = keep or list(docs.columns)
    into, body = fresh(docs, into), fresh(docs, "_text")
    shared = sent(docs.sparkSession, model_bytes(model))
    rows = docs.select(*[f"`{c}`" for c in keep], F.col(f"`{text}`").cast("string").alias(body))
    ids, parity, same = fresh(rows, "_ids"), fresh(rows, "_parity"), fresh(rows, "_same")
    done = rows.mapInArrow(
        lambda b: digest_batches(b, shared),
        f"{_schema(rows.drop(body))} `{ids}` binary, `{parity}` boolean, `{same}` boolean",
    )
    counted: Column = (F.length(F.col(ids)) / 4).cast("long")
    return done.select(
        *[f"`{c}`" for c in keep],
        F.struct(
            counted.alias("n_tokens"),
            F.col(ids).alias("ids"),
            F.col(parity).alias("parity"),
            F.col(same).alias("round_trip"),
        ).alias(into),
    )
