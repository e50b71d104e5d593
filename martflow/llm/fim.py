"""Fill-in-the-middle: a text is cut at two places and written with its middle last.

A text is a sequence of units. One match of "any number of units" against the whole text remembers
where every repetition ended, so the number of units and both cuts are looked up in that list. Hashes
of the document's id choose the cuts and the form; the text is put together and taken apart again by
built-in functions.
"""

from __future__ import annotations

from dataclasses import dataclass

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martflow.llm.common import bound_batches, fresh

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
UNIT = "[A-Za-z]+|[^A-Za-z]"
CUTS = "n bigint, first int, second int"


@dataclass(frozen=True)
class Forms:
    """Shares of the forms, in percent, and the seed that precedes the id in the hash."""

    seed: int = 1
    changed: int = 90  # of all texts
    suffix_first: int = 20  # of the changed ones
    unit: str = UNIT  # must match every text when repeated


def draws(doc_id: Column, seed: int) -> list[Column]:
    """Four unsigned 32-bit numbers from the SHA-256 of ``seed:id`` (a null id is an empty one)."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    digest = F.sha2(key, 256)
    return [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("bigint") for k in range(4)]


def cutter(unit: str):
    """(texts, numbers, numbers) -> units of each text, and the ends of its prefix and its middle."""

    def cut(texts: pa.Array, one: pa.Array, two: pa.Array) -> pa.Array:
        whole = regex.compile(f"({unit})*", regex.DOTALL)
        made = []
        for k in range(len(texts)):  # one text at a time: only its own match is held
            ends = whole.fullmatch(texts[k].as_py()).ends(1)
            n = len(ends)
            low, high = sorted((one[k].as_py() % (n + 1), two[k].as_py() % (n + 1)))
            made.append({"n": n, "first": ends[low - 1] if low else 0, "second": ends[high - 1] if high else 0})
        kind = pa.struct([("n", pa.int64()), ("first", pa.int32()), ("second", pa.int32())])
        return pa.array(made, kind)

    return F.arrow_udf(cut, CUTS)


def rearrange(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", forms: Forms | None = None, into: str = "fim", keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` (all) of ``docs`` with a struct ``into``: ``n`` (units), ``form``, ``output``, and
    ``prefix_chars``, ``middle_chars`` (code points; null if plain).

    ``form`` is ``plain`` (the text itself), ``psm`` (prefix, suffix, middle) or ``spm`` (suffix, prefix,
    middle), each part behind its mark. Empty texts and texts that hold a mark are plain; so a null text, which
    counts as empty, has an empty output. Rows of equal id and text get equal results; a null id is hashed as
    an empty one. One row for each row, no shuffle. A task holds the match of one text at a time, some 60 bytes
    for each of its units.
    """
    forms = forms or Forms()
    bound_batches(docs.sparkSession)
    keep = keep or list(docs.columns)
    into = fresh(docs, into)
    body, chance, cuts = (fresh(docs, x) for x in ("_body", "_chance", "_cuts"))
    one, two, change, order = draws(F.col(f"`{doc_id}`"), forms.seed)
    rows = docs.select(
        *[f"`{c}`" for c in keep],
        F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias(body),
        F.struct(one.alias("one"), two.alias("two"), (change % 100).alias("change"), (order % 100).alias("order")).alias(chance),
    )
    rows = rows.withColumn(cuts, cutter(forms.unit)(F.col(body), F.col(chance)["one"], F.col(chance)["two"]))
    whole, at, drawn = F.col(body), F.col(cuts), F.col(chance)
    marked = F.lit(False)
    for mark in (PREFIX, SUFFIX, MIDDLE):
        marked = marked | F.contains(whole, F.lit(mark))
    form = (
        F.when((whole == "") | marked | (drawn["change"] >= forms.changed), F.lit("plain"))
        .when(drawn["order"] < forms.suffix_first, F.lit("spm"))
        .otherwise(F.lit("psm"))
    )
    kind = fresh(rows, "_form")
    rows = rows.withColumn(kind, form)
    span = at["second"] - at["first"]
    prefix = F.substring(whole, F.lit(1), at["first"])
    middle = F.substring(whole, at["first"] + 1, span)
    suffix = F.substring(whole, at["second"] + 1, F.length(whole))
    changed = F.col(kind) != "plain"
    output = (
        F.when(~changed, whole)
        .when(F.col(kind) == "psm", F.concat(F.lit(PREFIX), prefix, F.lit(SUFFIX), suffix, F.lit(MIDDLE), middle))
        .otherwise(F.concat(F.lit(SUFFIX), suffix, F.lit(PREFIX), prefix, F.lit(MIDDLE), middle))
    )
    return rows.select(
        *[f"`{c}`" for c in keep],
        F.struct(
            at["n"].alias("n"),
            F.col(kind).alias("form"),
            output.alias("output"),
            F.when(changed, at["first"].cast("long")).alias("prefix_chars"),
            F.when(changed, span.cast("long")).alias("middle_chars"),
        ).alias(into),
    )


def restored(output: Column, form: Column) -> Column:
    """The text that ``rearrange`` was given, from its output and form alone."""
    parts = F.split(output, "|".join((PREFIX, SUFFIX, MIDDLE)))
    first, second, middle = (F.get(parts, F.lit(k)) for k in (1, 2, 3))
    return (
        F.when(form == "psm", F.concat(first, middle, second))
        .when(form == "spm", F.concat(second, middle, first))
        .otherwise(output)
    )


def training_texts(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", forms: Forms | None = None) -> DataFrame:
    """``docs`` with the rearranged text in place of ``text``; other columns and all rows stay."""
    into = fresh(docs, "fim")
    done = rearrange(docs, text, doc_id, forms, into)
    return done.select(*[F.col(into)["output"].alias(c) if c == text else F.col(f"`{c}`") for c in docs.columns])
