import hashlib
from collections import defaultdict

from martflow.llm import line_dedup
from martflow.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.001"


def key(line):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line.strip(" \t\n\x0b\x0c\r"))


def brute(rows):
    held = defaultdict(set)
    for i, text in rows:
        for line in (text or "").split("\n"):
            if i is not None and len(key(line)) >= 10:
                held[key(line)].add(i)
    out = []
    for i, text in rows:
        lines = (text or "").split("\n")
        stay = [x for x in lines if i is None or len(held[key(x)]) < 2 or min(held[key(x)]) == i]
        out.append((i, len(lines), len(lines) - len(stay), "\n".join(stay)))
    return sorted(out, key=str)


def test_query_equals_brute_force(spark, documents):
    want = [(i, n, d, hashlib.sha256(t.encode()).hexdigest()) for i, n, d, t in brute(documents)]
    assert sorted((tuple(r) for r in QUERIES["op8_line_dedup"](spark, SMALL).collect()), key=str) == want


def test_odd_rows(odd, none):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    done = line_dedup.drop_repeated_lines(odd, into="lines")
    got = sorted(((r.doc_id, r["lines_"]["n_lines"], r["lines_"]["n_dropped"], r["lines_"]["kept"]) for r in done.collect()), key=str)
    assert got == brute(rows)
    assert line_dedup.drop_repeated_lines(none).count() == 0
    assert line_dedup.replace_text(odd).columns == odd.columns


def test_lines_of_ten_code_points(spark):
    rows = [(1, "é" * 9 + "\n" + "é" * 10 + "\n A line twice\nA LINE twice \n"), (2, "é" * 9 + "\n" + "é" * 10 + "\na line twice")]
    rows.append((3, "É" * 10 + "\nonly here, twice\nonly here, twice"))
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r.doc_id: r.text for r in line_dedup.replace_text(df).collect()}
    assert got == {1: rows[0][1], 2: "é" * 9, 3: rows[2][1]}


def test_a_higher_threshold_counts_documents(spark):
    df = spark.createDataFrame([(i, "a shared line here\nown line of number %d" % i) for i in (1, 2, 3)], "doc_id bigint, text string")
    assert line_dedup.drop_repeated_lines(df, min_docs=4, into="l").selectExpr("sum(l.n_dropped)").first()[0] == 0
    assert line_dedup.drop_repeated_lines(df, min_docs=3, into="l").selectExpr("sum(l.n_dropped)").first()[0] == 2
