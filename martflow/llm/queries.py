"""The numbered queries ``opN_<name>`` over the given tables: name -> f(spark, folder)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martflow.llm import (
    decontaminate,
    extract,
    fim,
    langid,
    line_crf,
    line_dedup,
    lm,
    near_dup,
    pieces,
    quality_rules,
    resample,
    shards,
    warc,
)
from martflow.llm.common import remainder, table
from martflow.llm.oracles import SQL

__all__ = ["QUERIES", "SQL"]

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(f):
    QUERIES[f.__name__] = f
    return f


@query
def op3_quality_rules(spark, folder):
    judged = quality_rules.judge(table(spark, folder, "documents"), into="rules", keep=["doc_id"])
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
    return judged.select("doc_id", *[F.col("rules")[n].alias(n) for n in names])


@query
def op4_near_dup(spark, folder):
    return near_dup.group(table(spark, folder, "documents"))


@query
def op8_line_dedup(spark, folder):
    lines = line_dedup.drop_repeated_lines(table(spark, folder, "documents"), into="lines", keep=["doc_id"])
    return lines.select("doc_id", "lines.n_lines", "lines.n_dropped", F.sha2("lines.kept", 256).alias("kept_sha256"))


@query
def op10_decontaminate(spark, folder):
    hits = decontaminate.find(
        table(spark, folder, "documents"), table(spark, folder, "benchmark"), into="hits", keep=["doc_id"]
    )
    names = F.array_sort(F.transform(F.col("hits.items"), lambda x: x.cast("string")))
    return hits.select(
        "doc_id",
        "hits.n_words",
        "hits.n_hit",
        F.size("hits.items").cast("long").alias("n_items"),
        F.sha2(F.array_join(names, ","), 256).alias("items_sha256"),
        decontaminate.contaminated("hits").alias("contaminated"),
    )


@query
def op7_sentencepiece(spark, folder):
    coded = pieces.checked(table(spark, folder, "documents"), keep=["doc_id"], into="coded")
    return coded.select(
        "doc_id",
        "coded.n_tokens",
        F.sha2("coded.ids", 256).alias("ids_sha256"),
        "coded.parity",
        "coded.round_trip",
    )


@query
def op6_warc(spark, folder):
    records = warc.archive(table(spark, folder, "pages"))
    return records.select(
        F.col("key").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


@query
def op9_extract(spark, folder):
    found = extract.extract(table(spark, folder, "pages"), keep=["page_id", "url"])
    return found.withColumn("n_chars", F.length("text").cast("long"))


@query
def op2_line_crf(spark, folder):
    docs = table(spark, folder, "documents")
    labels = line_crf.training_part(table(spark, folder, "labels"))
    scored = line_crf.score(docs, line_crf.training_part(docs), labels, into="score", keep=["doc_id"])
    held_out = (remainder(F.col("doc_id"), 3) == 1).alias("held_out")
    return scored.select("doc_id", held_out, "score", F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))


@query
def op5_langid(spark, folder):
    docs = table(spark, folder, "documents")
    named = langid.identify(docs, langid.training_part(docs), into="language", keep=["doc_id"])
    held_out = (remainder(F.col("doc_id"), 5) == 0).alias("held_out")
    return named.select("doc_id", held_out, F.col("language.lang").alias("lang_pred"), F.col("language.score").alias("score"))


@query
def op1_lm_score(spark, folder):
    docs = table(spark, folder, "documents")
    held_out = remainder(F.col("doc_id"), 5) == 1
    scored = lm.score(docs, docs.where(~held_out), into="lm", keep=["doc_id"])
    return scored.select("doc_id", held_out.alias("held_out"), "lm.*")


@query
def op11_kd_shards(spark, folder):
    placed = shards.assign(table(spark, folder, "documents"), shards=24, keep=["doc_id"])
    return placed.select(
        "doc_id",
        "place.size",
        "place.text_crc32",
        F.lit("bytes").alias("law"),
        "place.shard",
        "place.slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query
def op12_fill_in_middle(spark, folder):
    cut = fim.rearrange(table(spark, folder, "documents"), keep=["doc_id"])
    output, form = F.col("fim.output"), F.col("fim.form")
    return cut.select(
        "doc_id",
        "fim.n",
        "fim.form",
        "fim.prefix_chars",
        "fim.middle_chars",
        F.sha2(output, 256).alias("output_sha256"),
        F.sha2(fim.restored(output, form), 256).alias("restored_sha256"),
    )


@query
def op13_resample(spark, folder):
    docs, bench = table(spark, folder, "documents"), table(spark, folder, "benchmark")
    drawn = resample.resample(docs, bench, keep=["doc_id"])
    return drawn.select("doc_id", "drawn.n_features", "drawn.weight", "drawn.score", "drawn.rank")
