"""The trained operators: scores on rows held out, and the parts of their arithmetic."""

import math
import random
from collections import Counter
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from martflow.llm import attention, langid, line_crf, lm
from martflow.llm.queries import QUERIES

MEDIUM = "/root/testdata/sf0.01"


def remainder(key, n):
    import zlib

    return zlib.crc32(str(key).encode()) % n


# -- language --------------------------------------------------------------------------


def test_languages_of_held_out_documents(spark):
    named = QUERIES["op5_langid"](spark, MEDIUM).collect()
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{MEDIUM}/documents.parquet").select("doc_id", "lang").collect()}
    assert len(named) == len(lang)
    assert all(r.held_out == (remainder(r.doc_id, 5) == 0) and 0 <= r.score <= 1 for r in named)
    held = [r for r in named if r.held_out]
    assert sum(r.lang_pred == lang[r.doc_id] for r in held) > 0.97 * len(held)


def test_the_byte_network_learns_a_planted_run():
    rng = np.random.default_rng(1)
    data, labels = rng.integers(1, 9, (40, langid.WINDOW)).astype(np.uint8), rng.integers(0, 2, 40)
    data[labels == 1, 100:103] = 77
    network = langid.Network(["a", "b"])
    network.prepare()
    before = network.probabilities(data)[np.arange(40), labels].mean()
    network.train(data, labels, epochs=80, rate=0.01).prepare()
    assert network.probabilities(data)[np.arange(40), labels].mean() > max(0.9, before)


def test_tables_give_the_responses_of_the_filters():
    network = langid.Network(["a", "b"])
    network.prepare()
    data = np.random.default_rng(2).integers(0, 256, (3, langid.WINDOW)).astype(np.uint8)
    for k in network.widths:
        w = network.weights
        patches = np.lib.stride_tricks.sliding_window_view(data, k, axis=1)
        want = np.einsum("npke,kef->npf", w["embed"][patches], w[f"filter{k}"]) + w[f"bias{k}"]
        assert np.allclose(network.responses(data, k), want, atol=1e-4)


def test_language_of_odd_rows(spark, odd, none):
    got = langid.identify(odd, odd, into="language").collect()
    assert [r.language.lang for r in got if not (r.text or "").strip()] == ["und"] * 3
    assert {r.language.lang for r in got} == {"und", "en"}
    assert {tuple(r.language) for r in langid.identify(odd, none, into="language").collect()} == {("und", 0.0)}
    assert langid.identify(none, odd).count() == 0


# -- quality ---------------------------------------------------------------------------


def test_quality_of_held_out_documents(spark):
    scored = {r.doc_id: r for r in QUERIES["op2_line_crf"](spark, MEDIUM).collect()}
    labels = spark.read.parquet(f"{MEDIUM}/labels.parquet").collect()
    assert all(r.held_out == (remainder(i, 3) == 1) and 0 <= r.score <= 1 for i, r in scored.items())
    held = [r for r in labels if scored[r.doc_id].held_out]
    assert sum(scored[r.doc_id].predicted == r.quality for r in held) > 0.96 * len(held)


def test_marginals_equal_the_sum_over_all_labels():
    rng = np.random.default_rng(3)
    field = line_crf.Field.zero()
    field.pair, field.ends = rng.normal(size=(2, 2)), rng.normal(size=(2, 2))
    counts = np.array([1, 4, 2, 4])
    u = rng.normal(size=counts.sum())
    good, pairs, z = field.marginals(u, counts)
    want, total, want_pairs, start = np.zeros(len(u)), 0.0, np.zeros((2, 2)), 0
    for n in counts:
        weights = {}
        for code in range(2**n):
            y = [(code >> k) & 1 for k in range(n)]
            s = field.ends[0, y[0]] + field.ends[1, y[-1]] + sum(u[start + k] * y[k] for k in range(n))
            weights[tuple(y)] = math.exp(s + sum(field.pair[a, b] for a, b in zip(y, y[1:])))
        mass = sum(weights.values())
        total += math.log(mass)
        for y, w in weights.items():
            want[start : start + n] += np.array(y) * w / mass
            for a, b in zip(y, y[1:]):
                want_pairs[a, b] += w / mass
        start += n
    assert np.allclose(good, want) and np.allclose(pairs, want_pairs) and math.isclose(z, total)


def test_features_do_not_depend_on_the_batch():
    texts = [b"One line.\nOne line.\n\n| a | b |", b"", "é è\n!!! WHAT".encode(), b" \t", b"x x x x y"]
    together, lengths, counts = line_crf.line_features(texts)
    alone = [line_crf.line_features([t]) for t in texts]
    assert (together == np.concatenate([a[0] for a in alone])).all()
    assert lengths.tolist() == [n for a in alone for n in a[1]] and counts.tolist() == [4, 1, 2, 1, 1]
    assert together[:4, -2].tolist() == [0, 1, 0, 0]


def test_quality_of_odd_rows(spark, odd, none):
    labels = spark.createDataFrame([(5, 1), (4, 0), (7, 1), (None, 1), (8, None)], "doc_id bigint, quality int")
    got = line_crf.score(odd, odd, labels, into="score").collect()
    assert len(got) == odd.count() and all(0 <= r.score <= 1 for r in got)
    assert all(abs(r.score - 0.5) < 1e-9 for r in line_crf.score(odd, odd, labels.limit(0), into="score").collect())
    assert line_crf.score(none, odd, labels).count() == 0


# -- language model --------------------------------------------------------------------


def brute_base(rows, training):
    tokens = {k: [*(t or "").encode().lower().split(), b""] for k, t in rows}
    counts = Counter(w for k in training for w in tokens[k])
    n, v = sum(counts.values()), len(counts)
    return {
        k: (len(ws), sum(w in counts for w in ws), n, sum(math.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in ws))
        for k, ws in tokens.items()
    }


@pytest.mark.parametrize("top_words", [lm.TOP_WORDS, 300])
def test_base_scores_equal_brute_force(spark, documents, top_words):
    docs = spark.createDataFrame(documents, "doc_id bigint, text string")
    training = {k for k, _ in documents if remainder(k, 5) != 1}
    scored = lm.score(docs, docs.where(F.col("doc_id").isin(*training)), into="lm", top_words=top_words, rounds=1)
    got = {r.doc_id: r.lm for r in scored.collect()}
    want = brute_base(documents, training)
    assert got.keys() == want.keys()
    for k, (tokens, known, n, base) in want.items():
        assert (got[k].n_tokens, got[k].n_known, got[k].train_tokens) == (tokens, known, n)
        assert math.isclose(got[k].base_score, base, rel_tol=1e-9)
        assert got[k].attention_score < 0


def test_scores_do_not_depend_on_how_many_words_are_sent(spark, documents):
    docs = spark.createDataFrame(documents, "doc_id bigint, text string").coalesce(1)
    training = docs.where(F.col("doc_id") % 5 != 1)
    got = [{r.doc_id: r.lm for r in lm.score(docs, training, top_words=n, rounds=1).collect()} for n in (lm.TOP_WORDS, 300, 0)]
    assert len(got[0]) == len(documents)
    for other in got[1:]:
        for k, one in got[0].items():
            assert (other[k].n_known, other[k].n_tokens) == (one.n_known, one.n_tokens)
            for name in ("score", "base_score", "attention_score"):
                assert math.isclose(other[k][name], one[name], rel_tol=1e-9), name


def test_scores_do_not_depend_on_how_rows_are_dealt(spark, documents, monkeypatch):
    """Several blocks, copies and an order turned round: 1, 8 and 32 partitions give the same scores."""
    monkeypatch.setattr(lm, "BLOCK_WORDS", 10_000)
    rows = documents + [(k + 10**6, t) for k, t in documents[:20]]
    got = []
    for n, some in ((1, rows), (8, rows[::-1]), (32, rows)):
        docs = spark.createDataFrame(some, "doc_id bigint, text string").repartition(n)
        got.append({r.doc_id: r.lm for r in lm.score(docs, docs.where(F.col("doc_id") % 5 != 1), rounds=2).collect()})
    assert len(got[0]) == len(rows)
    for other in got[1:]:
        for k, one in got[0].items():
            for name in ("score", "base_score", "attention_score"):
                assert math.isclose(other[k][name], one[name], rel_tol=1e-5), name


def test_a_block_lies_in_one_partition(spark, monkeypatch):
    monkeypatch.setattr(lm, "BLOCK_WORDS", 100)
    runs = spark.range(1000).select(F.col("id").cast("string").cast("binary").alias("run"), F.xxhash64("id").alias("h"))
    placed = lm.in_blocks(runs, 950).select("block", F.spark_partition_id().alias("p"))
    assert placed.distinct().count() == placed.select("block").distinct().count() == 10
    assert lm.in_blocks(runs, 0).select("block").distinct().count() == 1


def test_scores_of_held_out_documents_beat_the_counts(spark):
    got = [r for r in QUERIES["op1_lm_score"](spark, MEDIUM).collect() if r.held_out]
    assert all(remainder(r.doc_id, 5) == 1 for r in got)
    assert sum(r.score for r in got) > sum(r.base_score for r in got)
    assert sum(r.score > r.base_score for r in got) > 0.8 * len(got)


def test_every_word_of_every_training_text_is_trained_on():
    data = lm.model_bytes(lm.DEFAULT_MODEL)
    class_of = np.arange(len(lm.Model.parse(data).pieces)) % 100 + 1
    texts = [b"a short text", None, b"", b"one two " * 700, b"another short text"]
    batch = pa.RecordBatch.from_arrays([pa.array(texts, pa.binary())], names=["text"])
    sent = [SimpleNamespace(value=cloudpickle.dumps(x)) for x in (data, class_of)]
    codes = lm.PieceCodes(data)
    codes.learn([w for t in texts for w in (t or b"").split()])
    want = [bytes(class_of[i] for w in (t or b"").split() for i in codes[w]) + b"\0" for t in texts]
    for limit in (1_000_000, 10):
        got = [r for b in lm.training_runs(iter([batch]), *sent, limit=limit) for r in b.column(0).to_pylist()]
        assert got == want


def counted(codes, taken):
    """``codes`` with a tokenizer that also notes how many texts it is given."""
    library = codes.tokenizer
    codes.tokenizer = SimpleNamespace(encode_batch_fast=lambda texts, **b: taken.append(len(texts)) or library.encode_batch_fast(texts, **b))
    return codes


def test_words_go_to_the_library_in_rows_and_have_the_ids_they_have_alone():
    data, rnd = lm.model_bytes(lm.DEFAULT_MODEL), random.Random(4)
    words = {"".join(rnd.choices("abcdeinorst", k=rnd.randint(1, 12))).encode() for _ in range(1500)}
    words |= {"été".encode(), "日本語".encode(), "a😀b".encode(), b"\xff\xfe", b"a\x00b", b"x" * 300}
    marked = [x.encode() for x in ("▁", "▁▁", "a▁", "▁a", "b▁▁c", "▁the▁")]
    some = sorted(words)
    for k, w in enumerate(marked):  # between others
        some.insert(100 * k, w)
    taken = []
    codes = counted(lm.PieceCodes(data), taken)
    codes.learn([*some, *some[:50]])
    alone = codes.tokenizer.encode_batch_fast([lm.MARK + w.decode(errors="replace") for w in some])
    assert {w: list(codes[w]) for w in codes} == {w: c.ids for w, c in zip(some, alone)}
    assert sum(taken[:-1]) < len(some) / 10
    codes.clear()
    codes.learn([])
    assert not codes


def test_words_of_a_model_with_pieces_across_markers_go_alone(monkeypatch):
    monkeypatch.setattr(lm.Model, "cuttable", False)
    taken = []
    codes = counted(lm.PieceCodes(lm.model_bytes(lm.DEFAULT_MODEL)), taken)
    codes.learn([b"one", b"two", b"three"])
    assert sum(taken) == 3 and set(codes) == {b"one", b"two", b"three"}


@pytest.mark.parametrize("limit", [10, 1_000_000])
def test_frequent_words_are_not_coded_again_in_training(monkeypatch, limit):
    data = lm.model_bytes(lm.DEFAULT_MODEL)
    class_of = np.arange(len(lm.Model.parse(data).pieces)) % 100 + 1
    learnt, learn = [], lm.PieceCodes.learn
    monkeypatch.setattr(lm.PieceCodes, "learn", lambda self, words: learnt.extend(words) or learn(self, words))
    monkeypatch.setattr(lm.PieceCodes.__init__, "__defaults__", (3,))  # others are soon forgotten
    texts = [b"often rare%d often the other%d" % (k, k) for k in range(20)]
    batch = pa.RecordBatch.from_arrays([pa.array(texts, pa.binary())], names=["text"])
    sent = [SimpleNamespace(value=cloudpickle.dumps(x)) for x in (data, class_of, ([b"often", b"the", b""], [b"\x07\x08", b"\x09", b"\0"]))]
    got = [r for b in lm.training_runs(iter([batch]), *sent, limit=limit) for r in b.column(0).to_pylist()]
    assert {b"often", b"the", b""}.isdisjoint(learnt)
    codes = lm.PieceCodes(data)
    codes.limit = 1_000_000
    codes.learn([w for t in texts for w in t.split()])
    own = {w: bytes(class_of[i] for i in ids) for w, ids in codes.items()} | {b"often": b"\x07\x08", b"the": b"\x09"}
    assert got == [b"".join(own[w] for w in t.split()) + b"\0" for t in texts]


def test_scores_are_the_same_when_rare_words_are_forgotten():
    data, texts = lm.model_bytes(lm.DEFAULT_MODEL), [b"the end of the %d days" % (k % 7) for k in range(30)]
    n = len(lm.Model.parse(data).pieces)
    corpus = lm.Corpus(100, 50, 10, np.arange(n) % 192, np.linspace(-5, -1, n), model().pairs, {b"the": 30, lm.END: 10, b"of": 9})
    got = []
    for limit in (0, 1_000_000):
        scorer = lm.Scorer(corpus, model(), data).with_frequent()
        scorer.prepare()
        scorer.codes.limit = limit
        got.append([r for t in texts for r in scorer.score([t])])
        assert scorer.frequent == 3 and len(scorer.number) == len(scorer.coded) == len(scorer.size) == len(scorer.inner)
    for one, other in zip(*got):
        assert one[:2] == other[:2] == (7, 4) and one[5] == other[5] and len(one[5]) == len(one[6]) == 3
        assert np.allclose([*one[2:5], *one[6]], [*other[2:5], *other[6]], rtol=1e-12)


def test_the_network_has_its_full_size_and_half_the_weight():
    names = [lm.MARK + "a", "b", "é", lm.MARK + "é"] * 100
    found = lm.classes(np.arange(400, 0, -1.0), names)
    assert sum(n == 1 for n in Counter(found.tolist()).values()) >= 159 and found.max() < 192
    weights = attention.Attention.fresh(np.zeros((attention.CLASSES, attention.CLASSES))).weights
    assert weights["place"].shape[0] == 2 and weights["out"].shape == (40, 192)
    likely, unlikely = np.array([-2.0]), np.array([-50.0])
    assert np.isclose(lm.mixture(likely, unlikely), -2 + math.log10(0.5)) and np.isclose(lm.mixture(unlikely, likely), -2 + math.log10(0.5))


def model():
    rng = np.random.default_rng(6)
    out = attention.Attention.fresh(rng.normal(size=(attention.CLASSES, attention.CLASSES)))
    out.weights["out"] = rng.normal(0, 0.3, out.weights["out"].shape).astype(np.float32)
    return out


def test_each_class_is_scored_once_from_what_is_before_it():
    m, rng = model(), np.random.default_rng(7)
    seqs = [rng.integers(0, attention.CLASSES, n).astype(np.uint8) for n in (1, 5, 16, 17, 33, 100)]
    parts = m.log10(seqs, [np.arange(1, len(s) + 1) for s in seqs], chunk=3)
    whole = m.log10(seqs, [np.array([len(s)]) for s in seqs])
    for s, each, total in zip(seqs, parts, whole):
        assert len(each) == len(s) and np.isclose(each.sum(), total[0])
        cut = m.log10([s[: len(s) // 2 + 1]], [np.arange(1, len(s) // 2 + 2)])[0]
        assert np.allclose(each[: len(cut)], cut, atol=1e-5)  # what comes later does not matter


def test_probabilities_of_the_next_class_sum_to_one():
    m = model()
    begin = np.random.default_rng(8).integers(0, attention.CLASSES, 20).astype(np.uint8)
    seqs = [np.append(begin, k).astype(np.uint8) for k in range(attention.CLASSES)]
    last = [x[-1] for x in m.log10(seqs, [np.arange(1, 22)] * len(seqs))]
    assert np.isclose(sum(10.0**x for x in last), 1, atol=1e-4)


def by_loops(m, seq):
    """log10 of the probability of each class of the sequence, position by position in double precision."""
    w, size = {k: v.astype(float) for k, v in m.weights.items()}, attention.BLOCK
    given, out = np.concatenate(([0], seq[:-1])).astype(int), []
    for t in range(len(seq)):
        block = t - t % size
        seen = np.arange(max(0, block - size), t + 1)
        heads = []
        for h in range(attention.HEADS):
            part = slice(h * attention.HEAD, (h + 1) * attention.HEAD)
            s = w["key"][given[seen], part] @ w["query"][given[t], part] / attention.HEAD**0.5
            s += w["place"][h][t - block, seen - (block - size)]
            a = np.exp(s - s.max())
            heads.append(a @ w["value"][given[seen], part] / a.sum())
        hidden = np.maximum(np.concatenate(heads) @ w["mix"] + w["own"][given[t]] + w["bias"], 0)
        y = hidden @ w["out"] + m.pairs[given[t]]
        out.append((y[seq[t]] - y.max() - np.log(np.exp(y - y.max()).sum())) / np.log(10))
    return np.array(out)


@pytest.mark.parametrize("scale", [1, 5, 30])
def test_scores_equal_those_by_loops_however_large_the_affinities(scale):
    m, rng = model(), np.random.default_rng(10)
    m.weights["query"] = m.weights["query"] * np.float32(scale)
    m.weights["key"] = m.weights["key"] * np.float32(scale)
    seqs = [rng.integers(0, attention.CLASSES, n).astype(np.uint8) for n in (1, 17, 90)]
    for s, got in zip(seqs, m.log10(seqs, [np.arange(1, len(s) + 1) for s in seqs], chunk=2)):
        assert np.allclose(got, by_loops(m, s), atol=1e-4 * scale)
    blocks = attention.blocks(seqs)
    loss = m.gradients(*blocks[:-1], blocks[-1] < 0)[1]
    assert math.isclose(loss, -np.mean(np.concatenate([by_loops(m, s) for s in seqs])) * np.log(10), rel_tol=1e-4 * scale)


def test_scoring_takes_the_powers_of_affinities_once(monkeypatch):
    """At each position only those of the classes to predict are taken."""
    m, taken, exp = model(), [], np.exp
    monkeypatch.setattr(np, "exp", lambda x, *a, **b: taken.append(np.size(x)) or exp(x, *a, **b))
    n = 20_000
    m.log10([np.random.default_rng(12).integers(0, attention.CLASSES, n).astype(np.uint8)], [np.array([n])])
    assert n * attention.CLASSES <= sum(taken) < n * attention.CLASSES + 100_000


def test_gradients_of_attention_equal_differences():
    m, rng = model(), np.random.default_rng(9)
    given, wanted, scored, earlier, owner = attention.blocks([rng.integers(0, 12, 40).astype(np.uint8)])
    m.weights = {k: v.astype(np.float64) for k, v in m.weights.items()}
    m.pairs = m.pairs.astype(np.float64)
    g, _ = m.gradients(given, wanted, scored, earlier, owner < 0)
    rnd = random.Random(1)
    for name, w in m.weights.items():
        for _ in range(6):
            at = tuple(rnd.randrange(min(n, 12)) for n in w.shape)
            old, step, loss = w[at], 1e-4, []
            for sign in (1, -1):
                w[at] = old + sign * step
                loss.append(m.gradients(given, wanted, scored, earlier, owner < 0)[1])
            w[at] = old
            assert math.isclose(g[name][at], (loss[0] - loss[1]) / (2 * step), rel_tol=0.03, abs_tol=2e-5), name


def test_scores_of_odd_rows(spark, odd, none):
    got = lm.score(odd, odd, into="lm", rounds=1).collect()
    assert len(got) == odd.count()
    assert [r.lm.n_tokens for r in got if not (r.text or "").strip()] == [1, 1, 1]
    assert all(r.lm.n_known == r.lm.n_tokens and r.lm.score < 0 for r in got)
    new = lm.score(odd, none, into="lm").collect()
    assert {(r.lm.n_known, r.lm.train_tokens, r.lm.base_score) for r in new} == {(0, 0, 0.0)}
    assert lm.score(none, odd, rounds=1).count() == 0


def test_the_sample_of_a_language_is_that_of_its_least_hashed_ids(spark, monkeypatch):
    """Few and many rows a language, ids that repeat, and a hot language: the same windows as by ranking all."""
    rows = [(i, f"text number {i} " * 3, "en") for i in range(3000)]
    rows += [(i % 7, f"petit texte {i}", "fr") for i in range(900)] + [(5, "ein Text", "de")] * 4 + [(None, "x", "es"), (1, None, "es")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    seen = []
    monkeypatch.setattr(langid.Network, "train", lambda self, data, labels: seen.append((self.languages, data, labels)))
    langid.learn(docs, "doc_id", "text", "lang", per_language=50, windows_each=1)
    (names, data, labels) = seen[0]
    assert names == ["de", "en", "es", "fr"] and [int((labels == k).sum()) for k in range(4)] == [4, 50, 1, 50]
    hashes = {r.i: r.h for r in spark.range(3000).selectExpr("id i", "xxhash64(id) h").collect()}
    least = sorted((hashes[i], t) for i, t, name in rows if name == "en")[:50]
    want = sorted(t.lower().encode().ljust(langid.WINDOW, b"\0")[: langid.WINDOW] for _, t in least)
    assert sorted(bytes(w) for w in data[labels == 1]) == want
