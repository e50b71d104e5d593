"""Quality rules: divergence of a text's histograms from those of known languages.

Two histograms describe a text: the share of each character class, and the share of each
common word. A language's reference is the mean of both over the documents of that language.
The Jensen-Shannon distance to the nearest language decides; texts too short for a histogram
to mean anything are not judged by it. Only built-in functions are used.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martflow.llm.common import fresh, materialize

# Frequent function words, by language.
COMMON_WORDS = {
    "en": ["the", "of", "and", "to", "in", "is", "that", "for", "it", "with", "as", "was", "on", "be", "by", "this", "are", "from"],
    "fr": ["de", "la", "le", "et", "les", "des", "en", "un", "une", "du", "que", "qui", "dans", "pour", "par", "sur", "au", "est"],
    "de": ["der", "die", "und", "in", "den", "von", "zu", "das", "mit", "sich", "des", "auf", "für", "ist", "im", "dem", "nicht", "ein"],
    "es": ["de", "la", "que", "el", "en", "y", "a", "los", "se", "del", "las", "un", "por", "con", "no", "una", "su", "para"],
}

# Character classes, as Java patterns of what they do not hold.
CHAR_CLASSES = {
    "lower": r"[^a-z]",
    "upper": r"[^A-Z]",
    "digit": r"[^0-9]",
    "sentence": r"[^.,;:'\"()-]",
    "emphasis": r"[^!?]",
    "symbol": r"[^#*$%&|<>]",
    "beyond_ascii": r"[\x00-\x7F]",
}

SCALE = 1_000_000  # shares are whole millionths, so that sums do not depend on their order


@dataclass(frozen=True)
class Rules:
    """Limits of the verdict. Distances are square roots of divergences in bits (0 to 1)."""

    min_words: int = 50
    max_repeat_percent: int = 50
    char_limit: float = 0.30  # far from every language by its characters alone
    char_guard: int = 200  # word characters below which the class histogram is not judged
    word_limit: float = 0.45  # far from every language by its words alone
    char_near: float = 0.118  # far by both
    word_near: float = 0.245
    word_guard: int = 90  # words below which the word histogram is not judged


def vocabulary() -> list[str]:
    return sorted({w for words in COMMON_WORDS.values() for w in words})


def features(docs: DataFrame, text: str = "text", into: str = "rules") -> DataFrame:
    """``docs`` with a struct column of counts and histograms. Narrow: no shuffle.

    The struct has ``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words`` and the two
    histograms ``chars, words`` (shares in millionths; the last entry holds the rest). Null or
    empty text counts nothing. Equal three-word windows are recognised by 64-bit hashes.
    """
    codes = vocabulary()
    listed = ", ".join("'" + w + "'" for w in codes)
    letters = "".join(chr(ord("0") + i) for i in range(len(codes)))  # one letter for each word
    kept = list(docs.columns)
    hold = {k: fresh(docs, f"_{k}") for k in ("t", "w", "h", "s", "k", "c", "p", "d", "g", "j", "n", "r")}
    t, w, h, s, k, c, p, d, g, j, n, rest = hold.values()

    def step(df: DataFrame, **more: str) -> DataFrame:
        return df.select("*", *[F.expr(e).alias(hold[name]) for name, e in more.items()])

    df = docs.select("*", F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias(t))
    spaced = F.col(t)
    for other in "\t\n\x0b\x0c\r":  # one separator, as splitting at a single letter needs no pattern
        spaced = F.replace(spaced, F.lit(other), F.lit(" "))
    df = df.select("*", F.array_remove(F.split(spaced, " "), "").alias(w))
    df = step(df, n=f"size({w})", j=f"array_join({w}, '')")
    df = step(
        df,
        s=f"coalesce(cast(ceil(log2({n} + 2)) as int), 1)",
        h=f"if({n} < 3, array(), transform(sequence(0, greatest({n} - 3, 0)),"
        f" i -> xxhash64(get({w}, i), get({w}, i + 1), get({w}, i + 2))))",
        # the common words of the text, one letter for each
        g=f"array_join(transform(filter({w}, x -> x in ({listed})),"
        f" x -> substring('{letters}', cast(array_position(array({listed}), x) as int), 1)), '')",
        r=f"regexp_replace({j}, '[a-z]+', '')",
    )
    # Sorting (hash bits, position) packed into one number brings likely repeats together ...
    df = step(df, k=f"sort_array(transform({h}, (x, i) -> shiftleft(x, {s}) | cast(i as bigint)))")
    df = step(
        df,
        c=f"if(size({k}) < 2, array(), filter(sequence(1, greatest(size({k}) - 1, 1)),"
        f" i -> shiftright(get({k}, i), {s}) = shiftright(get({k}, i - 1), {s})))",
    )
    df = step(
        df,
        p=f"transform(array_union({c}, transform({c}, i -> i - 1)),"
        f" i -> cast(get({k}, i) & (shiftleft(1L, {s}) - 1L) as int))",
    )
    # ... and only those are compared by the whole hash.
    df = df.select(
        *[x for x in df.columns if x not in (c, p)],
        F.expr(f"sort_array(transform({p}, i -> struct(get({h}, i) as h, i as i)))").alias(p),
    )
    df = step(
        df,
        d=f"sort_array(transform(filter({p}, (x, i) -> x.h <=> get({p}, i - 1).h"
        f" or x.h <=> get({p}, i + 1).h), x -> x.i))",
    )
    repeat = (
        f"aggregate({d}, named_struct('n', 0L, 'end', 0), (a, x) ->"
        f" named_struct('n', a.n + cast(x + 3 - greatest(a.end, x) as bigint), 'end', x + 3), a -> a.n)"
    )
    joined, whole = F.col(j), F.col(t)
    # Lower-case letters are most of a text: the other classes are counted in what is left.
    chars = [F.length(joined) - F.length(F.col(rest))]
    chars += [F.length(F.regexp_replace(F.col(rest), f"{not_in}+", "")) for not_in in list(CHAR_CLASSES.values())[1:]]
    words = [F.length(F.col(g)) - F.length(F.replace(F.col(g), F.lit(x), F.lit(""))) for x in letters]
    lines = F.filter(F.split(whole, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))

    # Counts as columns first, shares of them after.
    df = df.select(
        "*",
        F.array(*chars).alias(fresh(docs, "_a")),
        F.array(*words).alias(fresh(docs, "_b")),
        lines.alias(fresh(docs, "_l")),
    )
    a, b, ln = fresh(docs, "_a"), fresh(docs, "_b"), fresh(docs, "_l")

    def shares(counts: str, total: str) -> Column:
        return F.expr(
            f"transform(concat({counts}, array({total} - aggregate({counts}, 0, (s, x) -> s + x))),"
            f" x -> cast(round(x * {SCALE}.0D / greatest({total}, 1)) as bigint))"
        )

    return df.select(
        *[f"`{x}`" for x in kept],
        F.struct(
            F.col(n).cast("long").alias("n_words"),
            F.length(joined).cast("long").alias("word_chars"),
            F.get(F.col(a), F.lit(list(CHAR_CLASSES).index("symbol"))).cast("long").alias("n_symbols"),
            (F.size(ln) - F.size(F.array_distinct(ln))).cast("long").alias("n_dup_lines"),
            F.expr(repeat).alias("n_repeat_words"),
            shares(a, f"length({j})").alias("chars"),
            shares(b, n).alias("words"),
        ).alias(into),
    )


def references(rows: DataFrame, lang: str, into: str, rules: Rules) -> dict[str, tuple[list[float], list[float]]]:
    """Mean histograms of each language of ``COMMON_WORDS`` over all its documents that are
    long enough and not mostly repeats. At most one row for each such language is collected."""
    sizes = {"chars": len(CHAR_CLASSES) + 1, "words": len(vocabulary()) + 1}
    own = F.col(f"`{lang}`")
    r = F.col(into)
    sums = [
        F.sum(F.get(r[part], F.lit(i))).alias(f"{part}{i}") for part, m in sizes.items() for i in range(m)
    ]
    found = (
        rows.where(own.isin(*COMMON_WORDS) & (r["n_words"] >= rules.min_words))
        .where(100 * r["n_repeat_words"] <= rules.max_repeat_percent * r["n_words"])
        .groupBy(own.alias("lang"))
        .agg(*sums)
        .collect()
    )
    out = {}
    for row in found:
        parts = []
        for part, m in sizes.items():
            counts = [row[f"{part}{i}"] for i in range(m)]
            parts.append([x / max(sum(counts), 1) for x in counts])
        out[row["lang"]] = (parts[0], parts[1])
    return dict(sorted(out.items()))


def distance(shares: str, reference: list[float]) -> Column:
    """Jensen-Shannon distance (base 2) of a histogram in millionths from a reference."""
    values = ", ".join(f"{q!r}D" for q in reference)
    return F.expr(
        f"sqrt(greatest(aggregate(zip_with({shares}, array({values}), (x, q) ->"
        f" if(x > 0, x / {SCALE}D * log2(2 * (x / {SCALE}D) / (x / {SCALE}D + q)), 0D)"
        f" + if(q > 0, q * log2(2 * q / (x / {SCALE}D + q)), 0D)), 0D, (s, y) -> s + y) / 2, 0D))"
    )


def judge(docs: DataFrame, text: str = "text", lang: str = "lang", rules: Rules | None = None, into: str = "rules", keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` (all) of ``docs`` with a struct ``into``: the counts of ``features``, the distances
    ``char_distance`` and ``word_distance`` to the nearest language, ``base_failed``, ``kept``.

    One row for each row. Null text counts as empty and fails the base rules. Languages not listed
    give no reference; with no reference at all nothing is judged by distance. The counts are stored
    once in the shared folder, then read by the references and by the verdict.
    """
    rules = rules or Rules()
    keep = keep or list(docs.columns)
    into = fresh(docs, into)
    own = fresh(docs, "_lang")
    source = docs.withColumn(own, F.col(f"`{lang}`"))
    rows = materialize(features(source, text, into).select(*[f"`{c}`" for c in keep], own, into), "quality-rules")
    known = references(rows, own, into, rules)
    r = F.col(into)
    base = (r["n_words"] < rules.min_words) | (100 * r["n_repeat_words"] > rules.max_repeat_percent * r["n_words"])
    char_far = [distance(f"{into}.chars", c) for c, _ in known.values()]
    word_far = [distance(f"{into}.words", w) for _, w in known.values()]

    def nearest(parts: list[Column]) -> Column:
        return F.least(*parts) if len(parts) > 1 else parts[0] if parts else F.lit(0.0)

    one, two = fresh(rows, "_chars"), fresh(rows, "_words")
    rows = rows.select("*", nearest(char_far).alias(one), nearest(word_far).alias(two))
    long_chars, long_words = r["word_chars"] >= rules.char_guard, r["n_words"] >= rules.word_guard
    odd = (
        (long_chars & (F.col(one) > rules.char_limit))
        | (long_words & (F.col(two) > rules.word_limit))
        | (long_chars & long_words & (F.col(one) > rules.char_near) & (F.col(two) > rules.word_near))
    )
    counts = [r[x].alias(x) for x in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]
    return rows.select(
        *[f"`{c}`" for c in keep],
        F.struct(
            *counts,
            F.col(one).alias("char_distance"),
            F.col(two).alias("word_distance"),
            base.alias("base_failed"),
            (~base & ~odd).alias("kept"),
        ).alias(into),
    )


def kept_documents(docs: DataFrame, text: str = "text", lang: str = "lang", rules: Rules | None = None) -> DataFrame:
    """The rows of ``docs`` that pass, with their columns unchanged."""
    into = fresh(docs, "rules")
    return judge(docs, text, lang, rules, into).where(F.col(into)["kept"]).drop(into)
