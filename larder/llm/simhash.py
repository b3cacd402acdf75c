"""Near duplicates by SimHash, with pigeonring filtering of the candidates.

Fingerprints are cut into ``m`` segments in a ring. If two of them differ in at most ``t`` bits,
some segment starts a chain of which every prefix of ``l`` segments differs in at most
``floor(l*t/m)`` bits (the pigeonring principle, Qin and Xiao 2018). The prefixes with a
budget of zero are equal, so they serve as a join key; the longer prefixes prune what the
join meets before the full Hamming distance is taken.

A key that many distinct fingerprints share would make the join quadratic. Such fingerprints
leave the join and meet at *hubs* instead: two fingerprints within two bits of each other are
equal, or one flipped bit of the one is the other, or one flipped bit of each gives the same
value. Every fingerprint goes to 65 hubs and every hub has at most 65 members, whatever the
data. So no link is lost and the work stays linear.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larder.llm.common import LOWER, column_of, lookup, slices, spaced_words, utf8, word_spans
from larder.llm.components import components
from larder.session import stage

#: Distinct fingerprints that may share a chain key before they go to hubs.
HOT_KEY = 64

BITS = 64


def fingerprints_of(data: np.ndarray, offsets: np.ndarray, words: int, seed: int = 42) -> np.ndarray:
    """SimHash of each text: a bit is 1 if set in over half the hashes of its word shingles.

    A text with fewer words than a shingle is one shingle; one without words has fingerprint 0.
    """
    n = len(offsets) - 1
    starts, ends, doc = word_spans(data, offsets)
    result = np.zeros(n, np.uint64)
    if not len(starts):
        return result
    text, begin, stop = spaced_words(data, starts, ends)
    count = np.bincount(doc, minlength=n)
    first = np.zeros(n + 1, np.int64)
    np.cumsum(count, out=first[1:])
    shingles = np.where(count > 0, np.maximum(count - words + 1, 1), 0)
    owner = np.repeat(np.arange(n), shingles)
    inside = np.arange(len(owner)) - np.repeat(np.cumsum(shingles) - shingles, shingles)
    from_word = first[owner] + inside
    to_word = np.minimum(from_word + words, first[owner + 1]) - 1
    digest = xxhash.xxh64_intdigest
    # A part at a time: the bits of all hashes at once would take 64 bytes a shingle.
    ones = np.zeros((n, BITS), np.int64)
    for at in range(0, len(owner), 1 << 18):
        part = slice(at, at + (1 << 18))
        hashes = np.fromiter(
            (digest(text[a:b], seed) for a, b in zip(begin[from_word[part]].tolist(), stop[to_word[part]].tolist())),
            np.uint64,
            len(from_word[part]),
        )
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        edges = np.flatnonzero(np.diff(owner[part], prepend=-1))
        ones[owner[part][edges]] += np.add.reduceat(bits, edges, axis=0, dtype=np.int32)
    majority = (2 * ones > shingles[:, None]).astype(np.uint8)
    return np.packbits(majority, axis=1, bitorder="little").view(np.uint64).ravel()


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5) -> DataFrame:
    """``doc_id, fp`` (64 bits as a long) of every row; a null text counts as empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            data, offsets = utf8(batch.column("text"))
            fp = fingerprints_of(LOWER[data], offsets, words).view(np.int64)
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), "fp": pa.array(fp)})

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "doc_id long, fp long")


def segment_masks(segments: int) -> list[int]:
    """Bit masks of the segments, as even as they can be."""
    cut = [BITS * k // segments for k in range(segments + 1)]
    return [((1 << (b - a)) - 1) << a for a, b in zip(cut, cut[1:])]


def chain_masks(segments: int, distance: int, start: int) -> list[tuple[int, int]]:
    """(mask, budget) for every prefix of the chain that begins at segment ``start``."""
    masks, chain, mask = segment_masks(segments), [], 0
    for k in range(segments):
        mask |= masks[(start + k) % segments]
        chain.append((mask, (k + 1) * distance // segments))
    return chain


def _long(mask: int) -> Column:
    return F.lit(mask - (1 << 64) if mask >> 63 else mask).cast("long")


def links(prints: DataFrame, distance: int = 2, segments: int = 8) -> DataFrame:
    """Edges ``a, b`` between distinct fingerprints (column ``fp``) whose closure joins exactly those within ``distance``.

    Fingerprints of crowded keys get edges to a hub's smallest member in place of edges to each other;
    the hubs need ``distance`` to be 2, otherwise crowded keys are joined like others.
    """
    keys = []
    for start in range(segments):
        zero = max((mask for mask, budget in chain_masks(segments, distance, start) if budget == 0), key=int.bit_count, default=0)
        keys.append(F.struct(F.lit(start).alias("start"), F.col("fp").bitwiseAND(_long(zero)).alias("key")))
    keyed = stage(prints.select("fp", F.inline(F.array(*keys))), "simhash-keys")
    crowd = keyed.groupBy("start", "key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    crowd = stage(crowd, "simhash-crowd")
    calm = crowd.filter(F.col("n") <= HOT_KEY) if distance == 2 else crowd
    side = keyed.join(calm.select("start", "key"), ["start", "key"])
    a, b = side.select("start", "key", F.col("fp").alias("a")), side.select("start", "key", F.col("fp").alias("b"))
    differ = F.col("a").bitwiseXOR(F.col("b"))
    ring = F.lit(False)
    for start in range(segments):
        chain = F.lit(True)
        for mask, budget in chain_masks(segments, distance, start):
            if budget:
                chain = chain & (F.bit_count(differ.bitwiseAND(_long(mask))) <= budget)
        ring = ring | ((F.col("start") == start) & chain)
    near = a.join(b, ["start", "key"]).filter((F.col("a") < F.col("b")) & ring).select("a", "b")
    if distance != 2:
        return near
    crowded = keyed.join(crowd.filter(F.col("n") > HOT_KEY).select("start", "key"), ["start", "key"], "left_semi")
    crowded = stage(crowded.select("fp").distinct(), "simhash-crowded")
    if crowded.isEmpty():
        return near
    flips = F.array(F.lit(0).cast("long"), *(_long(1 << k) for k in range(BITS)))
    hubs = crowded.select("fp", F.explode(F.transform(flips, lambda x: x.bitwiseXOR(F.col("fp")))).alias("hub"))
    hubs = stage(hubs, "simhash-hubs")
    first = hubs.groupBy("hub").agg(F.min("fp").alias("b"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    across = hubs.join(first, "hub").filter("fp != b").select(F.col("fp").alias("a"), "b")
    return near.unionByName(across).distinct()


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, distance: int = 2, segments: int = 8
) -> DataFrame:
    """One row per document: ``doc_id, fp, component_id``.

    ``component_id`` is the smallest ``doc_id`` reachable over links between fingerprints that differ in
    at most ``distance`` bits. Null ids are passed over; a component of null ids has a null ``component_id``.
    Empty texts have fingerprint 0 and link like others. Repeated rows get equal results.
    """
    thin = stage(fingerprints(docs, id_col, text_col, words), "simhash-prints")
    prints = thin.groupBy("fp").agg(F.min("doc_id").alias("first_id"), F.count(F.lit(1)).alias("copies"))
    prints = stage(prints, "simhash-distinct")
    labels = components(stage(links(prints, distance, segments), "simhash-links"))
    joined = prints.join(labels, prints["fp"] == labels["node"], "left").withColumn("root", F.coalesce("label", "fp"))
    joined = stage(joined.select("fp", "copies", "first_id", "root"), "simhash-roots")
    linked = joined.join(labels.select(F.col("label").alias("root")).distinct(), "root", "left_semi")
    smallest = linked.groupBy("root").agg(F.min("first_id").alias("linked_id"))
    ids = joined.join(smallest, "root", "left").select("fp", "copies", F.coalesce("linked_id", "first_id").alias("component_id"))
    ids = stage(ids, "simhash-ids")
    return lookup(thin, ids, "fp", "copies", thin.count()).select("doc_id", "fp", "component_id")


def _with_prints(docs: DataFrame, text_col: str, words: int) -> DataFrame:
    """``_row, fp``: whole rows and their fingerprints."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text):
            data, offsets = utf8(column_of(batch, text))
            fp = fingerprints_of(LOWER[data], offsets, words).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("_row"), pa.array(fp)], ["_row", "fp"])

    text = f"_row.{docs.columns.index(text_col)}"
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_row"))
    return rows.mapInArrow(run, T.StructType([rows.schema["_row"], T.StructField("fp", T.LongType())]))


def distinct_documents(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, distance: int = 2, segments: int = 8
) -> DataFrame:
    """The documents without near duplicates, all columns kept: of each component one row stays, that with the smallest id.

    Null ids come last. Rows are told apart by their place in the stored input, so repeated ids do no harm: of rows alike in
    every respect one stays. Texts come back as they are, null ones as null. Whole rows are written once, with their fingerprints.
    """
    rows = _with_prints(docs, text_col, words).withColumn("_n", F.monotonically_increasing_id())
    rows = stage(rows, "simhash-rows")
    doc_id = F.col("_row")[id_col]
    thin = rows.select("fp", "_n", F.struct(doc_id.isNull().alias("none"), doc_id.alias("id"), F.col("_n").alias("n")).alias("who"))
    prints = stage(thin.groupBy("fp").agg(F.min("who").alias("who"), F.count(F.lit(1)).alias("copies")), "simhash-distinct")
    labels = components(stage(links(prints, distance, segments), "simhash-links"))
    rooted = prints.join(labels, prints["fp"] == labels["node"], "left").withColumn("root", F.coalesce("label", "fp"))
    rooted = stage(rooted.select("fp", "copies", "who", "root"), "simhash-roots")
    first = rooted.groupBy("root").agg(F.min("who")["n"].alias("stays"))
    stays = stage(rooted.join(first, "root").select("fp", "copies", "stays"), "simhash-stays")
    gone = lookup(thin.select("fp", "_n"), stays, "fp", "copies", thin.count()).filter("_n != stays").select("_n")
    return rows.join(gone, "_n", "left_anti").select("_row.*")
