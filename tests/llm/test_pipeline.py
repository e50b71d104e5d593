"""The pipeline against the same steps by hand, for the parts that are not a model's verdict."""

import duckdb
import sentencepiece
from pyspark.sql import functions as F
from test_decontaminate import brute as hits
from test_line_dedup import brute as lines
from test_near_dup import brute as groups

import corpus_pipeline
from martflow.llm import pieces
from martflow.llm.common import materialize, table

SMALL = "/root/testdata/sf0.001"


def test_every_stage_works_on_what_the_one_before_kept(spark):
    docs = table(spark, SMALL, "documents")
    before = {r.doc_id: r.text for r in docs.collect()}
    items = duckdb.connect().execute(f"SELECT item_id, text FROM read_parquet('{SMALL}/benchmark.parquet')").fetchall()
    other = sentencepiece.SentencePieceProcessor(model_file=pieces.DEFAULT_MODEL)
    for name, stage in corpus_pipeline.STAGES:
        done = materialize(stage(spark, docs, SMALL), "test-stage")
        if name != corpus_pipeline.STAGES[-1][0]:
            assert done.columns == docs.columns
            after = {r.doc_id: r.text for r in done.collect()}
        if name == "quality rules":
            assert after.items() <= before.items() and 0.5 * len(before) < len(after) < len(before)
        elif name == "line dedup":
            assert after == {i: t for i, _, _, t in lines(sorted(before.items()))}
            assert done.where(F.col("n_chars") != F.length("text")).isEmpty()
        elif name == "MinHash near-dedup":
            assert after == {i: before[i] for i, (_, _, kept) in groups(sorted(before.items())).items() if kept}
        elif name == "benchmark decontamination":
            found = hits(list(before.values()), items)
            assert after == {i: t for (i, t), (n, hit, _) in zip(before.items(), found) if not (hit and 20 * hit >= n)}
        else:
            got = {r.doc_id: (r.n_tokens, bytes(r.ids), r.parity, r.round_trip) for r in done.collect()}
            import numpy as np

            want = {i: np.array(other.encode(t), np.int32).tobytes() for i, t in before.items()}
            assert got == {i: (len(x) // 4, x, True, True) for i, x in want.items()}
        docs, before = done, after


def test_run_gives_the_last_stage(spark):
    rows = corpus_pipeline.run(spark, SMALL)
    assert rows.columns == ["doc_id", "lang", "source", "n_tokens", "ids", "parity", "round_trip"]
    assert rows.count() > 0
