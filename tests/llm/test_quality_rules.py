import math
import re
from collections import Counter

from martflow.llm import quality_rules as q

SPACE = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    words = SPACE.findall(text or "")
    lines = [x for x in (text or "").split("\n") if SPACE.search(x)]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    times, hit = Counter(windows), set()
    for i, w in enumerate(windows):
        if times[w] > 1:
            hit.update((i, i + 1, i + 2))
    return (
        len(words),
        sum(map(len, words)),
        sum(c in "#*$%&|<>" for w in words for c in w),
        len(lines) - len(set(lines)),
        len(hit),
        len(words) < 50 or 100 * len(hit) > 50 * len(words),
    )


COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def test_counts_equal_brute_force(spark, documents):
    more = [(10**6, "a b c a b c a b"), (10**6 + 1, "x\nx\n \n \ny x y x y x"), (10**6 + 2, "z " * 500)]
    rows = documents + more
    got = q.judge(spark.createDataFrame([(i, t, "en") for i, t in rows], "doc_id bigint, text string, lang string")).collect()
    assert {r.doc_id: tuple(r.rules[c] for c in COUNTS) for r in got} == {i: brute(t) for i, t in rows}


def test_odd_rows(spark, odd, none):
    got = q.judge(odd, into="rules").collect()
    assert len(got) == odd.count()
    for r in got:
        assert r["rules"] == "y" and tuple(r["rules_"][c] for c in COUNTS) == brute(r.text)
    assert q.judge(none).count() == 0
    assert q.kept_documents(odd).columns == odd.columns


def test_distance_is_jensen_shannon(spark):
    x, ref = [0.5, 0.5, 0.0], [0.2, 0.3, 0.5]

    def half(a, b):
        return sum(p * math.log2(p / ((p + r) / 2)) for p, r in zip(a, b) if p > 0)

    want = math.sqrt((half(x, ref) + half(ref, x)) / 2)
    df = spark.createDataFrame([([500_000, 500_000, 0],)], "s array<bigint>")
    assert abs(df.select(q.distance("s", ref)).first()[0] - want) < 1e-12
    assert df.select(q.distance("s", x)).first()[0] == 0


def test_junk_goes_and_prose_stays(spark):
    import random

    rng = random.Random(4)
    common = q.COMMON_WORDS["en"]

    def prose(n):
        return " ".join(rng.choice(common) if rng.random() < 0.5 else "".join(rng.choices(["ter", "on", "ba", "lo"], k=3)) for _ in range(n)) + "."

    rows = [(i, prose(200), "en") for i in range(60)]
    rows.append((100, " ".join(w.upper() + "!!" for w in prose(200).split()), "en"))
    rows.append((101, " ".join(w + "###" for w in prose(200).split()), "en"))
    rows.append((102, " | ".join("".join(rng.choices(["ter", "on", "ba", "lo"], k=3)) for _ in range(200)), "en"))
    kept = q.kept_documents(spark.createDataFrame(rows, "doc_id bigint, text string, lang string"))
    assert sorted(r.doc_id for r in kept.collect()) == list(range(60))
