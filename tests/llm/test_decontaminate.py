import random
import re
from collections import defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from martflow.llm import decontaminate as dc

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(texts, items, window=13):
    known = defaultdict(set)
    for item, text in items:
        w = words(text)
        for k in range(max(1, len(w) - window + 1) if w else 0):
            known[tuple(w[k : k + window])].add(item)
    out = []
    for text in texts:
        w, hit, found = words(text), set(), set()
        for n in {len(k) for k in known}:
            for k in range(len(w) - n + 1):
                if tuple(w[k : k + n]) in known:
                    hit.update(range(k, k + n))
                    found |= known[tuple(w[k : k + n])]
        out.append((len(w), len(hit), sorted(found)))
    return out


def test_short_items_overlaps_and_shared_windows(spark):
    rng = random.Random(3)
    vocabulary = [f"v{i}" for i in range(6)]

    def some(n):
        return " ".join(rng.choices(vocabulary, k=n))

    items = [(i, some(rng.choice([1, 2, 5, 12, 13, 14, 30]) if i else 3)) for i in range(12)]
    items = [(i, t) for i, t in items if len(t.split()) > 1] + [(50, ""), (51, None), (52, "..."), (3, items[3][1])]
    texts = [some(rng.randrange(80)) for _ in range(60)]
    texts += [some(20) + ", " + (items[k][1] or "") + "!! " + some(9) for k in range(len(items))]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    for block in (dc.BLOCK_BYTES, 60):  # one automaton, and several passes
        got = dc.find(docs, bench, into="h", block_bytes=block).orderBy("doc_id").collect()
        assert [(r.h.n_words, r.h.n_hit, r.h["items"]) for r in got] == brute(texts, items)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(1, 3), max_size=9), min_size=1, max_size=4), st.lists(st.integers(0, 4), max_size=40))
def test_automaton_equals_brute_force(items, text):
    known = [(k, [b"%d" % x for x in w]) for k, w in enumerate(items)]
    automaton = dc.Automaton(known, window=4)
    ids = [automaton.words.get(b"%d" % x, 0) for x in text]
    import numpy as np

    got = {(a, b, i) for a, b, owners in automaton.scan(np.array(ids, np.int32)) for i in owners}
    want = set()
    for k, w in enumerate(items):
        size = min(4, len(w))
        for s in range(max(1, len(w) - 3) if w else 0):
            for a in range(len(text) - size + 1):
                if text[a : a + size] == w[s : s + size]:
                    want.add((a, a + size, k))
    assert got == want


def test_odd_rows(spark, odd, none):
    bench = spark.createDataFrame([(1, "the same line again and again")], "item_id bigint, text string")
    got = dc.find(odd, bench, into="hits").collect()
    want = brute([r.text for r in got], [(1, "the same line again and again")])
    assert [(r["hits_"].n_words, r["hits_"].n_hit, r["hits_"]["items"]) for r in got] == want
    assert dc.find(none, bench).count() == 0
    assert dc.find(odd, bench.limit(0), into="h").selectExpr("sum(h.n_hit)").first()[0] == 0
    assert dc.clean_documents(odd, bench).columns == odd.columns


@pytest.mark.parametrize("text,left", [("Start. A b-c, D e! End", "Start. ! End"), ("a b c", "a b c"), (None, None)])
def test_spans_are_cut_out(spark, text, left):
    docs = spark.createDataFrame([(1, text)], "doc_id bigint, text string")
    bench = spark.createDataFrame([(1, "a B c d E")], "item_id bigint, text string")
    assert dc.remove_spans(docs, bench, min_words=5).first().text == left


def test_a_task_holds_one_automaton_however_many_blocks_there_are(spark):
    """Many blocks give the result of one, and no plan has more than one of their passes."""
    items = [(i, " ".join(f"w{i}x{k}" for k in range(20))) for i in range(12)]
    texts = [f"start {items[i][1]} and {items[(i * 5 + 1) % 12][1]} end" for i in range(12)] + ["none of them", None, ""]
    docs = spark.createDataFrame(list(enumerate(texts)) + [(3, texts[3])], "doc_id bigint, text string")
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    one = dc.find(docs, bench, into="h")
    many = dc.find(docs, bench, into="h", block_bytes=150)
    plans = [df._jdf.queryExecution().executedPlan().toString() for df in (one, many)]
    assert [text.count("MapInArrow") for text in plans] == [1, 1]  # in the second, to put spans together

    def rows(df):
        return sorted(((r.doc_id, r.h.n_words, r.h.n_hit, r.h["items"], r.h.spans) for r in df.collect()), key=str)

    assert rows(one) == rows(many) and sum(r[2] for r in rows(one)) > 400
    assert dc.remove_spans(docs, bench, block_bytes=150).exceptAll(dc.remove_spans(docs, bench)).count() == 0
