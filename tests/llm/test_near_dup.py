import random
from collections import defaultdict

import numpy as np
import pytest

from martflow.llm import near_dup as nd
from martflow.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.001"


def sets(rows):
    out = {}
    for i, text in rows:
        w = (text or "").encode().lower().split()
        out[i] = frozenset(b" ".join(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset()
    return out


def brute(rows):
    known, up = sets(rows), {}

    def find(a):
        while up.setdefault(a, a) != a:
            a = up[a]
        return a

    holds = defaultdict(list)
    for i in sorted(known):
        met = defaultdict(int)
        for g in known[i]:
            for j in holds[g]:
                met[j] += 1
            holds[g].append(i)
        for j, n in met.items():
            if 100 * n >= 75 * (len(known[i]) + len(known[j]) - n):
                a, b = find(i), find(j)
                up[max(a, b)] = min(a, b)
    return {i: (len(known[i]), find(i), find(i) == i) for i in known}


def answers(df):
    return {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in df.collect()}


def test_query_equals_brute_force(spark, documents):
    assert answers(QUERIES["op4_near_dup"](spark, SMALL)) == brute(documents)


def edited(rng, words, changes):
    words = list(words)
    for _ in range(changes):
        words[rng.randrange(len(words))] = f"n{rng.randrange(10**9)}"
    return words


def test_a_family_of_edited_copies(spark):
    """Copies of copies: chains of links, many pairs just above or below the limit."""
    rng = random.Random(8)
    base = [f"w{rng.randrange(500)}" for _ in range(160)]
    family = [base]
    while len(family) < 160:
        family.append(edited(rng, rng.choice(family), rng.randrange(1, 12)))
    order = rng.sample(range(10_000), len(family))
    rows = [(i, " ".join(w)) for i, w in zip(order, family)]
    rows += [(20_000 + k, " ".join(base)) for k in range(40)]  # exact copies
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert answers(nd.group(df)) == brute(rows)


def test_odd_rows(odd, none):
    got = sorted((tuple(r) for r in nd.group(odd).collect()), key=str)
    assert (1, 0, 1, True) in got and (2, 0, 2, True) in got and (3, 0, 3, True) in got
    assert (4, 1, 4, True) in got  # three words are one shingle
    assert [r for r in got if r[0] == 6] == [(6, 10, 5, False)] * 2
    assert [r[2:] for r in got if r[0] is None] == [(None, True)]
    kept = nd.kept_documents(odd)
    assert kept.columns == odd.columns and kept.count() == odd.count() - 2
    assert nd.group(none).count() == 0


def test_rows_that_repeat_an_id_share_its_component(spark):
    one, two = (" ".join(f"{c}{i}" for i in range(30)) for c in "ab")
    rows = [(5, one), (5, two), (7, one), (9, two)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert {(r.doc_id, r.component_id) for r in nd.group(df).collect()} == {(5, 5), (7, 5), (9, 5)}


@pytest.mark.parametrize("size", [1, 2, 7, 60, 400, 5000])
def test_every_slot_fills(size):
    elements = np.random.default_rng(size).integers(0, 2**63, size).astype(np.uint64)
    assert (nd.sketch(np.unique(elements)) != 0).all()


def test_sketches_agree_as_sets_do():
    rng = np.random.default_rng(5)
    for share in (0.5, 0.75, 0.9):
        agree = []
        for _ in range(60):
            n = 300
            both = int(n * 2 * share / (1 + share))
            pool = rng.integers(0, 2**63, 2 * n - both).astype(np.uint64)
            agree.append((nd.sketch(pool[:n]) == nd.sketch(pool[n - both :])).mean())
        assert abs(np.mean(agree) - share) < 0.02
