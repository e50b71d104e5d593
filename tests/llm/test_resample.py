import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from martflow.llm import resample as rs


def words(text):
    low = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def features(text, most):
    w = words(text)
    return [" ".join(w[i : i + size]) for size in range(1, most + 1) for i in range(len(w) - size + 1)]


def brute(docs, target, draw):
    """(doc_id, n_words, n_features, weight, score, rank) of every row."""
    def bucket(f):
        return zlib.crc32(f.encode()) % draw.buckets

    raw = Counter(bucket(f) for _, t in docs for f in features(t, draw.max_run))
    want = Counter(bucket(f) for t in target for f in features(t, draw.max_run))
    s_all, t_all, b = sum(raw.values()), sum(want.values()), draw.buckets

    def gain(k):
        return math.floor(1000 * math.log((want[k] + 1) * (s_all + b) / ((raw[k] + 1) * (t_all + b))))

    out = []
    for i, t in docs:
        f = features(t, draw.max_run)
        weight = sum(gain(bucket(x)) for x in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"{draw.seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([i, len(words(t)), len(f), weight, score, None])
    fit = sorted((r for r in out if r[1] >= draw.min_words), key=lambda r: (-r[4], r[0] is None, r[0] or 0))
    for k, r in enumerate(fit[: draw.percent * len(fit) // 100], 1):
        r[5] = k
    return sorted(map(tuple, out), key=str)


def got(df):
    rows = df.select("doc_id", "drawn.n_words", "drawn.n_features", "drawn.weight", "drawn.score", "drawn.rank").collect()
    return sorted(map(tuple, rows), key=str)


@pytest.mark.parametrize("draw", [rs.Draw(), rs.Draw(percent=37, min_words=3, max_run=2, buckets=50, seed=3), rs.Draw(percent=100)])
def test_equals_brute_force(spark, draw):
    rng = random.Random(4)
    names = [f"Wort{i}" for i in range(40)] + ["é", "中文", "A-b"]
    docs = [(i, " ".join(rng.choices(names, k=rng.randrange(60)))) for i in range(400)]
    docs += [(1000, None), (1001, ""), (1002, "... !")]
    target = [" ".join(rng.choices(names[:9], k=30)) for _ in range(20)] + [None]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    t = spark.createDataFrame([(x,) for x in target], "text string")
    assert got(rs.resample(d, t, draw=draw)) == brute(docs, target, draw)


def test_ties_and_repeated_rows_are_drawn_one_by_one(spark):
    text = "same words " * 20
    docs = [(7, text)] * 30 + [(None, text)] * 5 + [(8, text), (9, "few")]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    t = spark.createDataFrame([("words",)], "text string")
    assert got(rs.resample(d, t, draw=rs.Draw(percent=50))) == brute(docs, ["words"], rs.Draw(percent=50))


def test_odd_rows(spark, odd, none):
    docs = odd.withColumn("drawn", F.lit(1)).withColumn("_id", F.lit(2)).withColumn("weight", F.lit(3))
    target = spark.createDataFrame([("the same text",)], "text string")
    out = rs.resample(docs, target, draw=rs.Draw(percent=60, min_words=5))
    assert out.columns == [*docs.columns, "drawn_"]
    raw = [(r.doc_id, r.text) for r in docs.collect()]
    found = out.withColumn("drawn", F.col("drawn_"))
    assert got(found) == brute(raw, ["the same text"], rs.Draw(percent=60, min_words=5))
    assert rs.resample(none, target).count() == 0
    assert rs.resample(odd, target.limit(0)).count() == odd.count()
    assert rs.drawn_documents(odd, target, draw=rs.Draw(percent=0)).count() == 0
    kept = rs.drawn_documents(odd, target, draw=rs.Draw(percent=100, min_words=1))
    assert kept.columns == odd.columns and kept.count() == 7


@pytest.mark.parametrize("k", [1, 2, 250, 999, 1000])
def test_kth_key(spark, k):
    rng = random.Random(k)
    keys = [(rng.randrange(5), rng.randrange(3), i) for i in range(1000)]
    rows = spark.createDataFrame(keys, "a long, b long, c long")
    assert rs.kth_key(rows, ["a", "b", "c"], k, pivots=3) == sorted(keys)[k - 1]


def test_kth_key_of_none(spark):
    rows = spark.createDataFrame([(1,)], "a long")
    assert rs.kth_key(rows, ["a"], 0) is None
    with pytest.raises(ValueError):
        rs.kth_key(rows, ["a"], 2)
