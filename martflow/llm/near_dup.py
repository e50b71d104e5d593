"""Near-duplicate detection by fast similarity sketches, banding and exact verification.

A document is the set of its five-word shingles. Its sketch has ``SLOTS`` coordinates: in rounds,
every element is hashed to one slot and a value, an empty slot takes the least value that falls
into it, and rounds go on until no slot is empty; after ``SLOTS`` rounds, each further round hashes
all elements into one slot, so that every slot is filled after twice as many. Two sets agree in a
coordinate with a probability of their Jaccard similarity, concentrated as in independent trials.
Sets that agree in a whole band of coordinates are compared in full.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martflow.llm.common import bound_batches, materialize, utf8
from martflow.llm.words import U, WordHashes, mix, shingle_set, space_words

SHINGLE = 5
SLOT_BITS = 7
SLOTS = 1 << SLOT_BITS  # 128
BAND = 4  # coordinates of a band: a pair at similarity 0.75 meets in no band once in 180,000
LONG_BITS = 11  # a longer sketch, kept as one bit a slot, estimates the similarity of candidates
LONG_SLOTS = 1 << LONG_BITS
# The share of bits that agree is (1 + J) / 2; an estimate 0.07 below a similarity of 0.75 comes about once
# in a million times.
MARGIN = 0.07
SEEDS = mix(np.arange(1, 2 * LONG_SLOTS + 1, dtype=U) * U(0x9E3779B97F4A7C15))


def sketch(elements: np.ndarray, slot_bits: int = SLOT_BITS) -> np.ndarray:
    """The coordinates of a non-empty set of 64-bit hashes, 2 ** ``slot_bits`` of them."""
    slots = 1 << slot_bits
    out = np.zeros(slots, U)
    empty = np.ones(slots, bool)
    top, step = U(64 - slot_bits), max(1, min(slots, 4 * slots // len(elements)))
    low = U(64 - 2 * slot_bits - 1)  # bits left for a value beside slot and round
    done = 0
    while done < slots and empty.any():
        rounds = np.arange(done, min(slots, done + step), dtype=U)
        h = mix(elements[None, :] ^ SEEDS[done : done + len(rounds), None])
        # slot, round and value in one number: the least one of a slot comes first
        key = ((h >> top) << top) | (rounds[:, None] << low) | (h & ((U(1) << low) - U(1)))
        key = np.sort(key, axis=None)
        slot = (key >> top).astype(np.intp)
        first = np.flatnonzero(np.concatenate(([True], slot[1:] != slot[:-1])))
        first = first[empty[slot[first]]]
        out[slot[first]] = key[first]
        empty[slot[first]] = False
        done += len(rounds)
    for s in np.flatnonzero(empty):
        out[s] = mix(elements ^ SEEDS[slots + s]).min()
    return out


def bands(coordinates: np.ndarray) -> np.ndarray:
    """One number for each band of coordinates, which its position is part of."""
    parts = coordinates.reshape(-1, BAND)
    out = np.arange(1, len(parts) + 1, dtype=U)
    for k in range(BAND):
        out = mix(out * U(0x9E3779B97F4A7C15) + parts[:, k])
    return out.view(np.int64)


def sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc, text) -> (doc, n, s1, s2, bands); a set is named by the 128-bit hash s1, s2 of its elements."""
    hashes = WordHashes()
    for batch in batches:
        size, s1, s2, banded = [], [], [], []
        for data in batch.column(1).to_pylist():
            elements = shingle_set(space_words(data or b""), hashes, SHINGLE)
            size.append(len(elements))
            digest = xxhash.xxh3_128_digest(elements.tobytes())
            s1.append(int.from_bytes(digest[:8], "big", signed=True))
            s2.append(int.from_bytes(digest[8:], "big", signed=True))
            banded.append(bands(sketch(elements)) if len(elements) else None)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(size, pa.int64()), pa.array(s1, pa.int64()), pa.array(s2, pa.int64()), pa.array(banded, pa.list_(pa.int64()))],
            names=["doc", "n", "s1", "s2", "bands"],
        )


def element_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, text) -> (node, elements): whole sets."""
    hashes = WordHashes()
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            sets = [shingle_set(space_words(data or b""), hashes, SHINGLE).view(np.int64) for data in part.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(sets, pa.list_(pa.int64()))], names=["node", "elements"])


def sets_of(nodes: DataFrame, docs: DataFrame) -> DataFrame:
    """(node, elements): whole sets of documents, made anew from their texts.

    Texts meet the ids by a shuffled join, whose hash table holds the ids of one partition: ``nodes`` grow
    with the corpus, so they are sent neither to the driver nor to all tasks. An id with several texts
    has a row for each.
    """
    kind = docs.schema["doc"].dataType.simpleString()
    texts = docs.where("doc is not null").select(F.col("doc").alias("node"), utf8(F.col("text")).alias("text"))
    texts = texts.join(nodes.hint("shuffle_hash"), "node", "left_semi")
    return materialize(texts.mapInArrow(element_sets, f"node {kind}, elements array<bigint>"), "near-dup-sets")


def long_sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, elements) -> (node, bits): one bit of each coordinate of a long sketch."""
    for batch in batches:
        sets = [np.array(x, np.int64).view(U) for x in batch.column(1).to_pylist()]
        bits = [np.packbits((mix(sketch(x, LONG_BITS)) & U(1)).astype(bool)).view(np.int64) if len(x) else None for x in sets]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(bits, pa.list_(pa.int64()))], names=["node", "bits"])


def linked_pairs(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those of ``pairs`` (a, b) whose whole sets are similar enough."""
    both = pairs.join(sets.select(F.col("node").alias("a"), F.col("elements").alias("of_a")), "a")
    both = both.join(sets.select(F.col("node").alias("b"), F.col("elements").alias("of_b")), "b")
    met, either = F.size(F.array_intersect("of_a", "of_b")), F.size("of_a") + F.size("of_b")
    return both.where(100 * met >= percent * (either - met)).select("a", "b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of ``edges`` (a, b): the least node reachable.

    Labels spread along edges and jump to the label of their label; both are joins of rows, each
    round is stored, and rounds go on until nothing changes.
    """
    both = materialize(edges.union(edges.select("b", "a")).where("a <> b").distinct(), "near-dup-edges")
    labels = both.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("node"), F.least("a", "b").alias("component"))
    labels = materialize(labels, "near-dup-labels")
    while True:
        heard = both.join(labels, both["b"] == labels["node"]).groupBy(F.col("a").alias("node")).agg(F.min("component").alias("heard"))
        spread = materialize(
            labels.join(heard, "node", "left").select(
                "node", F.least("component", "heard").alias("component"), F.col("component").alias("before")
            ),
            "near-dup-labels",
        )
        parent = spread.select(F.col("node").alias("component"), F.col("component").alias("up"))
        after = materialize(
            spread.join(parent, "component", "left").select(
                "node", F.least("component", "up").alias("component"), "before"
            ),
            "near-dup-labels",
        )
        labels = after.select("node", "component")
        if after.where("component <> before").isEmpty():
            return labels


def similar_size(one: str, two: str, percent: int) -> Column:
    return 100 * F.least(one, two) >= percent * F.greatest(one, two)


def class_links(classes: DataFrame, docs: DataFrame, percent: int, stars: int, filters: int = 3) -> DataFrame:
    """Edges (a, b) between classes that span all links found in any band.

    First, every member of a bucket is compared with one centre of the bucket, a number of pairs in
    proportion to its members. The centre is the member with the most company in all its buckets: of a
    text and its edited copies, that is the one the others are closest to. What then still lies in one
    bucket but in different components goes through a filter (see ``supported``); of the rest, members
    of different components whose long sketches are close enough are compared. Members of one
    component need no comparison.
    """
    rows = classes.select("node", "n", F.posexplode("bands").alias("band", "h")).drop("band")
    sizes = rows.groupBy("h").agg(F.count("*").alias("members")).where("members > 1")
    rows = materialize(rows.join(sizes, "h"), "near-dup-buckets")
    company = materialize(rows.groupBy("node").agg(F.sum("members").alias("company")), "near-dup-company")
    rows = materialize(rows.join(company, "node").select("h", "node", "n", "company"), "near-dup-buckets")
    sets = sets_of(company.select("node"), docs)
    found: list[DataFrame] = []
    tested: list[DataFrame] = []

    def compare(pairs: DataFrame) -> None:
        pairs = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        for before in tested:
            pairs = pairs.join(before, ["a", "b"], "left_anti")
        pairs = materialize(pairs, "near-dup-pairs")
        tested.append(pairs)
        found.append(materialize(linked_pairs(pairs, sets, percent), "near-dup-links"))

    for k in range(stars):
        some = rows if k == 0 else rows.join(centres(rows).select("h", F.col("component").alias("main")), "h").where("component <> main")
        heads = materialize(centres(some).select("h", F.col("node").alias("a"), F.col("n").alias("na")), "near-dup-centres")
        pairs = rows.join(heads, "h").where("a <> node").where(similar_size("n", "na", percent))
        compare(pairs.select("a", F.col("node").alias("b")))
        rows = unresolved(rows, components(reduce(DataFrame.union, found)))
        if rows.isEmpty():
            return reduce(DataFrame.union, found)

    rows = supported(rows, sets, percent, filters)
    # A pair is made in one of the buckets that both lie in.
    every = classes.groupBy("node").agg(F.flatten(F.collect_list("bands")).alias("bands"))
    rows = rows.join(every, "node")
    one, two = (
        rows.select("h", *[F.col(c).alias(c + end) for c in ("n", "component", "support", "bits", "bands")], F.col("node").alias(end))
        for end in "ab"
    )
    differ = reduce(lambda x, y: x + y, [F.bit_count(F.get("bitsa", F.lit(k)).bitwiseXOR(F.get("bitsb", F.lit(k)))) for k in range(LONG_SLOTS // 64)])
    able = similar_size("na", "nb", percent)
    able &= (100 + percent) * F.least("supporta", "supportb") >= percent * (F.col("na") + F.col("nb"))
    able &= F.array_min(F.array_intersect("bandsa", "bandsb")) == F.col("h")
    able &= F.coalesce(differ <= int(LONG_SLOTS * (1 - percent / 100 + MARGIN) / 2), F.lit(True))
    compare(one.join(two, "h").where("a < b and componenta <> componentb").where(able).select("a", "b"))
    return reduce(DataFrame.union, found)


def centres(rows: DataFrame) -> DataFrame:
    """Of each bucket, the member with the most company."""
    order = ["company", "node", "n", *[c for c in rows.columns if c == "component"]]
    return rows.groupBy("h").agg(F.max(F.struct(*order)).alias("top")).select("h", "top.*")


def unresolved(rows: DataFrame, labels: DataFrame | None) -> DataFrame:
    """The rows of buckets whose members lie in several components."""
    if labels is not None:
        rows = rows.select("h", "node", "n", "company").join(labels, "node", "left")
        rows = rows.withColumn("component", F.coalesce("component", "node"))
        rows = materialize(rows, "near-dup-buckets")
    split = rows.groupBy("h").agg(F.min("component").alias("c1"), F.max("component").alias("c2")).where("c1 <> c2")
    split = materialize(split.select("h"), "near-dup-split")
    return materialize(rows.join(split, "h", "left_semi"), "near-dup-buckets")


def supported(rows: DataFrame, sets: DataFrame, percent: int, rounds: int) -> DataFrame:
    """The rows that can still have a link, with their ``support`` and the ``bits`` of a long sketch.

    A set's support is the number of its elements that a set of another component among these rows
    has. Two sets meet in no more elements than either's support, so a set of little support is similar
    to none. Without it, others lose support: rounds go on while rows go. Exact: no link is lost.
    """
    while True:
        nodes = rows.groupBy("node").agg(F.first("component").alias("component"), F.first("n").alias("n"))
        least = rows.groupBy("h").agg(F.min("n").alias("least"))
        partner = rows.select("h", "node").join(least, "h").groupBy("node").agg(F.min("least").alias("least"))
        each = sets.join(nodes, "node").select("node", "component", F.explode("elements").alias("element"))
        shared = each.groupBy("element").agg(F.min("component").alias("c1"), F.max("component").alias("c2"))
        shared = materialize(shared.where("c1 <> c2").select("element"), "near-dup-shared")
        support = each.join(shared, "element", "left_semi").groupBy("node").agg(F.count("*").alias("support"))
        keep = nodes.join(support, "node").join(partner, "node")
        # A partner has at least the least size of the buckets, and of those that are similar enough.
        size = F.greatest("least", F.ceil(F.col("n") * percent / 100))
        keep = keep.where((100 + percent) * F.col("support") >= percent * (F.col("n") + size))
        keep = materialize(keep.select("node", "support"), "near-dup-support")
        before = rows.count()
        rows = unresolved(rows.drop("support").join(keep, "node"), None)
        after = rows.count()
        rounds -= 1
        if not after or not rounds or after > 0.9 * before:
            break
    left = sets.join(rows.select("node").distinct(), "node", "left_semi").select("node", "elements")
    kind = sets.schema["node"].dataType.simpleString()
    bits = left.mapInArrow(long_sketches, f"node {kind}, bits array<bigint>")
    # An id with several texts has no one sketch and is compared in full.
    bits = bits.groupBy("node").agg(F.count("*").alias("texts"), F.first("bits").alias("bits"))
    bits = materialize(bits.select("node", F.when(F.col("texts") == 1, F.col("bits")).alias("bits")), "near-dup-bits")
    return rows.join(bits, "node")


def group(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", percent: int = 75, stars: int = 1) -> DataFrame:
    """One row (``doc_id``, ``n_shingles``, ``component_id``, ``kept``) for each row of ``docs``.

    Words are separated by ASCII white space, A-Z lower-cased. Documents are linked where their sets
    have a similarity of ``percent`` or more; the component is the smallest id reachable. Documents
    without words are linked with nothing. A row without an id has no component and is kept. Rows that
    repeat an id share its component. Shingles are compared by 64-bit hashes, sets equal in all by a
    128-bit hash. Equal sets become one class first, so copies cost one row each.
    """
    bound_batches(docs.sparkSession)
    own, words = F.col(f"`{doc_id}`").alias("doc"), F.col(f"`{text}`").cast("string").alias("text")
    plain = docs.select(own, words)
    kind = plain.schema["doc"].dataType.simpleString()
    made = plain.select("doc", utf8(F.col("text")).alias("text")).mapInArrow(
        sketches, f"doc {kind}, n bigint, s1 bigint, s2 bigint, bands array<bigint>"
    )
    made = materialize(made, "near-dup-sketches")
    able = made.where("n > 0 and doc is not null")
    classes = able.groupBy("s1", "s2").agg(
        F.min("doc").alias("node"), F.first("n").alias("n"), F.first("bands").alias("bands")
    )
    classes = materialize(classes, "near-dup-classes")
    edges = class_links(classes, plain, percent, stars)
    # An id that several rows carry joins the classes of all of them.
    repeated = able.select("doc", "s1", "s2").distinct().groupBy("doc").agg(F.count("*").alias("rows")).where("rows > 1")
    repeated = able.join(repeated.select("doc"), "doc").join(classes.select("s1", "s2", "node"), ["s1", "s2"])
    edges = edges.union(repeated.select(F.col("doc").alias("a"), F.col("node").alias("b")))
    labels = components(edges)
    named = classes.join(labels, "node", "left").select("s1", "s2", F.coalesce("component", "node").alias("component"))
    lone = F.when((F.col("n") == 0) & F.col("doc").isNotNull(), F.col("doc"))
    found = made.join(named, ["s1", "s2"], "left").select(
        F.col("doc").alias(doc_id),
        F.col("n").alias("n_shingles"),
        F.when(F.col("doc").isNull(), None).otherwise(F.coalesce(lone, F.col("component"))).alias("component_id"),
    )
    return found.withColumn("kept", F.coalesce(F.col(f"`{doc_id}`") == F.col("component_id"), F.lit(True)))


def kept_documents(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", **options) -> DataFrame:
    """One document of each group: the rows of ``docs`` whose id is their component's, and those without an id."""
    gone = group(docs, text, doc_id, **options).where("not kept").select(F.col(doc_id).alias("gone")).distinct()
    # Sorted and merged at every size: the list grows with the corpus.
    return docs.join(gone.hint("merge"), docs[f"`{doc_id}`"] == gone["gone"], "left_anti")
