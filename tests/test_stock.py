"""Settling requests: sequential semantics, and hot keys cut into chunks."""

import random

import pytest
from pyspark.sql import functions as F

from martflow.operators.stock import _apply, _chain, _chunk_function, settle
from martflow.plans import orders
import numpy as np


def one_by_one(requests, openings):
    """Answers of a plain loop: ``(key, seq) -> (accepted, held)``."""
    held, out = {}, {}
    for key, seq, q in sorted(requests, key=lambda r: (str(r[0]), r[1])):
        have, limit = held.get(key, 0), openings.get(key)
        ok = q is not None and limit is not None and 0 <= have + q <= limit
        if ok:
            have += q
            held[key] = have
        out[(key, seq)] = (ok, have)
    return out


def answers(df):
    return {(r.k, r.seq): (r.accepted, r.held) for r in df.collect()}


def frames(spark, requests, openings):
    return (
        spark.createDataFrame(requests, "k string, seq bigint, quantity int"),
        spark.createDataFrame(list(openings.items()), "k string, opening int"),
    )


def test_refused_request_leaves_stock_for_a_smaller_one(spark):
    req = [("a", 1, 6), ("a", 2, 5), ("a", 3, 4), ("a", 4, 1), ("b", 1, 3), ("b", 2, 4)]
    got = answers(settle(*frames(spark, req, {"a": 10, "b": 3}), ["k"], ["seq"]))
    assert got[("a", 1)] == (True, 6)
    assert got[("a", 2)] == (False, 6)
    assert got[("a", 3)] == (True, 10)
    assert got[("a", 4)] == (False, 10)
    assert got[("b", 1)] == (True, 3)  # exactly the stock
    assert got[("b", 2)] == (False, 3)  # one above


def test_removals_give_back_only_what_is_held(spark):
    req = [("a", 1, 4), ("a", 2, -5), ("a", 3, -4), ("a", 4, 10), ("a", 5, -1)]
    got = answers(settle(*frames(spark, req, {"a": 10}), ["k"], ["seq"]))
    assert [got[("a", i)] for i in range(1, 6)] == [
        (True, 4),
        (False, 4),
        (True, 0),
        (True, 10),
        (True, 9),
    ]


def test_unknown_keys_and_null_quantities_are_refused(spark):
    req = [("x", 1, 1), (None, 1, 1), (None, 2, 1), ("a", 1, None), ("a", 2, 2)]
    got = answers(settle(*frames(spark, req, {"a": 2}), ["k"], ["seq"]))
    assert not got[("x", 1)][0] and not got[(None, 1)][0] and not got[("a", 1)][0]
    assert got[("a", 2)] == (True, 2)
    assert len(got) == 5


@pytest.mark.parametrize("parts", [1, 2, 5, 13])
@pytest.mark.parametrize("signed", [False, True])
def test_every_cut_equals_the_loop(spark, signed, parts):
    rng = random.Random(7 + signed)
    req = []
    for key, n in (("hot", 900), ("warm", 150), ("cold", 5), ("idle", 1)):
        for seq in rng.sample(range(5_000), n):
            q = rng.randint(1, 9)
            req.append((key, seq, -q if signed and rng.random() < 0.45 else q))
    req += [("lost", s, 1) for s in range(200)]  # many, but without stock
    req += [("blank", s, 1) for s in range(60)] + [(None, s, 1) for s in range(60)]
    req += [("gaps", s, None if s % 3 else 2) for s in range(90)]
    openings = {"hot": 60, "warm": 500, "cold": 10, "idle": 1, "blank": None, "gaps": 9}
    requests, stock = frames(spark, req, openings)
    got = settle(
        requests,
        stock,
        ["k"],
        ["seq"],
        fan_in=3,
        parts=parts,
    )
    assert answers(got) == one_by_one(req, openings)


@pytest.mark.parametrize("parts", [1, 4])
def test_requests_without_an_order_come_first(spark, parts):
    req = [("a", None, 3)] + [("a", s, 1) for s in range(40)]
    got = answers(settle(*frames(spark, req, {"a": 10}), ["k"], ["seq"], parts=parts))
    assert got[("a", None)] == (True, 3)
    assert [got[("a", s)] for s in (6, 7, 39)] == [(True, 10), (False, 10), (False, 10)]


def test_chunk_functions_agree_with_every_start():
    rng = random.Random(3)
    for _ in range(30):
        opening = rng.randint(0, 25)
        qs = [rng.randint(-8, 8) for _ in range(40)]

        def loop(h, part):
            for q in part:
                if 0 <= h + q <= opening:
                    h += q
            return h

        first = _chunk_function(np.array(qs[:17]), opening)
        second = _chunk_function(np.array(qs[17:]), opening)
        both = _chain(first, second, opening)
        for h in range(opening + 1):
            assert _apply(first, h) == loop(h, qs[:17])
            assert _apply(both, h) == loop(h, qs)
        assert len(both[0]) <= opening + 1


def test_cart_contents_drop_emptied_entries(spark):
    req = [("a", 1, 2), ("a", 2, -2), ("b", 1, 3)]
    settled = settle(*frames(spark, req, {"a": 5, "b": 5}), ["k"], ["seq"])
    assert [tuple(r) for r in orders.cart_contents(settled, ["k"]).collect()] == [("b", 3)]


def test_stock_is_never_negative_or_above_opening(spark):
    rng = random.Random(1)
    req = [("a", i, rng.randint(-5, 5)) for i in range(500)]
    out = settle(*frames(spark, req, {"a": 12}), ["k"], ["seq"])
    low, high = out.agg(F.min("held"), F.max("held")).first()
    assert low >= 0 and high <= 12


@pytest.mark.parametrize("seed", range(6))
def test_runs_side_by_side_equal_runs_one_by_one(seed):
    """Short and long runs, missing quantities and limits, with more and fewer runs than lanes."""
    import random

    import numpy as np
    import pyarrow as pa

    from martflow.operators import stock

    rng = random.Random(seed)
    lengths = [rng.choice([1, 2, 5, 40]) for _ in range(rng.choice([1, 15, 16, 60]))]
    begin = np.cumsum([0, *lengths[:-1]])
    n = sum(lengths)
    qty = [rng.choice([None, 0, 1, 3, 9, -1, -4]) for _ in range(n)]
    opening = [o for k in lengths for o in [rng.choice([None, 0, 5, 12])] * k]
    held = np.array([rng.randrange(3) for _ in lengths])
    want_ok, want_held = [], []
    for b, k, h in zip(begin, lengths, held):
        for i in range(b, b + k):
            ok = qty[i] is not None and opening[i] is not None and 0 <= h + qty[i] <= opening[i]
            h += qty[i] if ok else 0
            want_ok.append(ok)
            want_held.append(h)
    got = stock._replay_runs(begin, held.copy(), pa.array(qty, pa.int64()), pa.array(opening, pa.int64()))
    assert got[0].tolist() == want_ok and got[1].tolist() == want_held


def test_run_starts_treat_nulls_as_equal():
    import pyarrow as pa

    from martflow.operators import stock

    a = pa.array([1, 1, None, None, 2, 2, 2])
    b = pa.array(["x", "x", "x", "x", "x", None, None])
    assert stock._run_starts([a, b]).tolist() == [0, 2, 4, 5]
