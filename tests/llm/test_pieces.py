import struct
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
from pyspark import cloudpickle

from martflow.llm import pieces


def field(number, value):
    """One protobuf field."""

    def varint(n):
        out = b""
        while True:
            n, low = n >> 7, n & 0x7F
            out += bytes([low | (0x80 if n else 0)])
            if not n:
                return out

    if isinstance(value, float):
        return varint(number << 3 | 5) + struct.pack("<f", value)
    if isinstance(value, int):
        return varint(number << 3) + varint(value)
    return varint(number << 3 | 2) + varint(len(value)) + value


def unigram_model():
    """A small model of scored pieces with byte fallback, written field by field."""
    out = b""
    known = [("<unk>", 0.0, 2), ("<s>", 0.0, 3), ("</s>", 0.0, 3)]
    known += [(f"<0x{b:02X}>", 0.0, 6) for b in range(256)]
    known += [(p, -float(k + 1) / 3, 1) for k, p in enumerate(["▁", "e", "t", "h", "▁the", "he", "▁t", "n", "en", "▁then", "a"])]
    for text, score, kind in known:
        out += field(1, field(1, text.encode()) + field(2, score) + field(3, kind))
    out += field(2, field(3, 1) + field(35, 1) + field(40, 0) + field(41, 1) + field(42, 2))
    out += field(3, field(1, b"identity") + field(3, 1) + field(4, 0) + field(5, 1))
    return out


TEXTS = [
    "The quick brown fox, then the end.",
    " two  spaces   and\ta tab \n\n new line\n",
    "\n",
    "   ",
    "naïve café – 東京 \U0001f600\x00",
    "a" * 3000,
    "x\n y\n\n  z",
    "then then the hen",
]


def codec(data):
    return pieces.Codec(data)


@pytest.mark.parametrize("data", [pieces.model_bytes(pieces.DEFAULT_MODEL), unigram_model()], ids=["merges", "scores"])
def test_codec_equals_the_reference_library(data):
    own, other = codec(data), sentencepiece.SentencePieceProcessor(model_proto=data)
    for _ in range(2):  # the second time from memory
        coded = own.encode(TEXTS)
        assert [x.tolist() for x, _ in coded] == other.encode(TEXTS)
        assert all(same for _, same in coded)
    assert [c.ids for c in own.whole.encode_batch(TEXTS, add_special_tokens=False)] == other.encode(TEXTS)
    ids = [x for x, _ in coded]
    assert own.decode(ids) == [own.text(x) for x in ids] == TEXTS


@pytest.mark.parametrize("data", [pieces.model_bytes(pieces.DEFAULT_MODEL), unigram_model()], ids=["merges", "scores"])
def test_any_ids_decode_as_by_the_full_decoder_and_markers_are_replaced_once_for_a_text(data):
    own = codec(data)
    rng = np.random.default_rng(5)
    ids = [rng.integers(0, len(own.model.pieces), n).astype(np.int32) for n in (0, 1, 2, 7, 40, 300)]
    ids += [rng.integers(0, 262, 50).astype(np.int32)]  # mostly bytes, which are no text
    ids += [x for x, _ in own.encode(TEXTS)]
    whole = own.whole.decode_batch([x.tolist() for x in ids], skip_special_tokens=False)
    assert own.decode(ids) == whole
    assert own.plain.decode(own.encode(["a b"])[0][0].tolist()) == pieces.MARK + "a" + pieces.MARK + "b"  # the library leaves them


def test_long_parts_are_not_remembered_and_short_ones_are_learnt_once(monkeypatch):
    own = codec(pieces.model_bytes(pieces.DEFAULT_MODEL))
    learn, seen = own.learn, []
    monkeypatch.setattr(own, "learn", lambda parts: seen.extend(parts) or learn(parts))
    long = "x" * (own.LONG + 1)
    texts = [f"one two {long} one", f"two {long} three", ""]
    first = own.encode(texts)
    assert sorted(seen) == sorted({"one", "two", "three", long}) and long not in own.known
    seen.clear()
    again = own.encode(texts)
    assert seen == [long] and [x.tolist() for x, _ in first] == [x.tolist() for x, _ in again] and all(s for _, s in again)


def test_documents_survive_the_round_trip(spark, documents):
    data = pieces.model_bytes(pieces.DEFAULT_MODEL)
    other = sentencepiece.SentencePieceProcessor(model_proto=data)
    df = spark.createDataFrame(documents, "doc_id bigint, text string")
    done = {r.doc_id: r.coded for r in pieces.checked(df, into="coded").collect()}
    for i, text in documents:
        want = np.array(other.encode(text or ""), np.int32)
        assert (done[i].n_tokens, bytes(done[i].ids), done[i].parity, done[i].round_trip) == (len(want), want.tobytes(), True, True)
    back = pieces.decode(pieces.encode(df), into="again")
    assert all(r.text == r.again for r in back.collect())


def test_odd_rows(odd, none):
    rows = pieces.checked(odd, into="coded").collect()
    assert all(r["coded_"].parity for r in rows)
    assert [r["coded_"].n_tokens for r in rows if not r.text] == [0, 0]
    assert [r.doc_id for r in rows if not r["coded_"].round_trip] == [9]  # has the marker itself
    assert {r.doc_id: r.ids for r in pieces.encode(odd).collect()}[1] is None
    assert pieces.checked(none).count() == 0


def test_unknown_models_are_refused():
    with pytest.raises(ValueError):
        pieces.Model.parse(field(2, field(3, 3))).tokenizer()
    with pytest.raises(ValueError):
        pieces.Model.parse(field(2, field(24, 1)))


def test_checks_see_a_wrong_cut_and_a_wrong_decoder(monkeypatch):
    data = pieces.model_bytes(pieces.DEFAULT_MODEL)
    batch = pa.RecordBatch.from_arrays([pa.array(["some words of a text", "", None])], names=["text"])
    shared = SimpleNamespace(value=cloudpickle.dumps(data))

    def checks():
        done = next(pieces.digest_batches(iter([batch]), shared))
        return done.column(1).to_pylist(), done.column(2).to_pylist()

    assert checks() == ([True] * 3, [True] * 3)
    with monkeypatch.context() as m:
        m.setattr(pieces.Codec, "parts", lambda self, text: text.split(" ")[:-1])
        assert checks() == ([False, True, True], [False, True, True])
    monkeypatch.setattr(pieces.Codec, "decode", lambda self, ids: ["another"] * len(ids))
    assert checks() == ([True] * 3, [False] * 3)
