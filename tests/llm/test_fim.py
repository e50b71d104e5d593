import hashlib
import re

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from martflow.llm import fim


def brute(doc_id, text):
    text = text or ""
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    n = len(units)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return n, "plain", text, None, None
    if h[3] % 100 < 20:
        return n, "spm", f"<S>{s}<P>{p}<M>{m}", len(p), len(m)
    return n, "psm", f"<P>{p}<S>{s}<M>{m}", len(p), len(m)


def checked(df):
    rows = df.withColumn("back", fim.restored(F.col("fim.output"), F.col("fim.form"))).collect()
    for r in rows:
        f = r.fim
        assert (f.n, f.form, f.output, f.prefix_chars, f.middle_chars) == brute(r.doc_id, r.text)
        assert r.back == (r.text or "")
    return rows


def test_equals_brute_force(spark):
    texts = ["", " ", "a", "abc def", "é😀 ź\n\x00\t<", "<", "<P", "ab<P>c", "<S>", "x<M>", "<S<M<P", "a<S", "1 2 3" * 50]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts * 20)], "doc_id long, text string")
    rows = checked(fim.rearrange(docs))
    assert {r.fim.form for r in rows} == {"plain", "psm", "spm"}


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="aB<PSM> \né😀0", max_size=40))
def test_every_repetition_is_kept(text):
    import regex

    ends = regex.compile(f"({fim.UNIT})*", regex.DOTALL).fullmatch(text).ends(1)
    assert ends == [m.end() for m in re.finditer(r"[A-Za-z]+|[^A-Za-z]", text)]


def test_odd_rows(spark, odd, none):
    docs = odd.withColumn("_body", F.lit(1)).withColumn("_cuts", F.lit(2))
    rows = checked(fim.rearrange(docs))
    assert len(rows) == docs.count()
    assert fim.rearrange(docs).columns == [*docs.columns, "fim"]
    assert fim.rearrange(docs.withColumn("fim", F.lit(1))).columns[-1] == "fim_"
    assert fim.rearrange(none).count() == 0


def test_very_long_text(spark):
    docs = spark.range(1).select(F.col("id").alias("doc_id"), F.repeat(F.lit("ab c\n"), 400_000).alias("text"))
    got = fim.rearrange(docs).select("fim.n", F.length("fim.output").alias("m"), (fim.restored(F.col("fim.output"), F.col("fim.form")) == F.col("text")).alias("same")).first()
    assert got.n == 1_600_000 and got.same and got.m in (2_000_000, 2_000_009)


def test_other_shares_and_texts_in_place(spark):
    docs = spark.createDataFrame([(i, f"some text {i}") for i in range(50)], "doc_id long, text string")
    never = fim.training_texts(docs, forms=fim.Forms(changed=0))
    assert never.exceptAll(docs).count() == 0
    always = fim.training_texts(docs, forms=fim.Forms(seed=7, changed=100, suffix_first=100))
    assert always.columns == docs.columns
    assert always.where(~F.col("text").startswith("<S>")).count() == 0


def test_one_python_step_and_no_shuffle(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    plan = fim.rearrange(docs)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1 and "Exchange" not in plan
