"""Exact duplicates: owners kept in Patricia tries.

Texts are dealt by length and content hash; all texts of such a partition go with their full bytes
into one compressed radix trie whose terminal nodes hold the owner. Equality is thus
decided on the bytes themselves, the hash only deals.

Copies are folded twice. Before the shuffle each task folds its own texts, in one trie per length class and leading hash bits, so a
group with a third of all rows leaves a task as one row. After it, rows arrive sorted by text, so that a subtree is complete
as soon as the path moves on. When a trie has grown to ``RESIDENT_BYTES``, completed subtrees
are spilled to the output; what stays is the path of the current text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larder.llm.common import lookup
from larder.session import stage

#: Bytes of labels a task keeps before it spills subtrees.
RESIDENT_BYTES = 16 << 20
#: Leading bits of the hash that tell the tries of a task apart before the shuffle.
FOLD_BITS = 4


class Owner:
    """What a terminal node knows: the owning id, how many rows carry it, all rows, and the owner's other columns."""

    __slots__ = ("id", "top", "rows", "carried")

    def __init__(self, key: int | None, top: int, rows: int, carried: Any):
        self.id, self.top, self.rows, self.carried = key, top, rows, carried

    def merge(self, other: Owner, largest: bool) -> None:
        """Fold in another row, or the fold of other rows, of the same text."""
        self.rows += other.rows
        if self.id == other.id:
            self.top += other.top
        elif other.id is not None and (self.id is None or (other.id > self.id) == largest):
            self.id, self.top, self.carried = other.id, other.top, other.carried


class Node:
    """A node of the trie: the bytes of its edge, its children by first byte, and an owner if a text ends here."""

    __slots__ = ("label", "children", "owner")

    def __init__(self, label: bytes, owner: Owner | None = None):
        self.label, self.children, self.owner = label, {}, owner


def shared_prefix(a: bytes, b: bytes, at: int) -> int:
    """Length of the common prefix of ``a`` and ``b[at:]``, by bisection on slices."""
    low, high = 0, min(len(a), len(b) - at)
    while low < high:
        mid = (low + high + 1) // 2
        if a[:mid] == b[at : at + mid]:
            low = mid
        else:
            high = mid - 1
    return low


class Patricia:
    """A compressed radix trie from byte strings to owners."""

    def __init__(self, largest: bool):
        self.root, self.largest, self.bytes, self.splits = Node(b""), largest, 0, 0

    def insert(self, text: bytes, owner: Owner) -> None:
        """Add ``text``, or merge ``owner`` into the one it has."""
        node, at = self.root, 0
        while True:
            if at == len(text):
                if node.owner is None:
                    node.owner = owner
                else:
                    node.owner.merge(owner, self.largest)
                return
            child = node.children.get(text[at])
            if child is None:
                node.children[text[at]] = Node(text[at:], owner)
                self.bytes += len(text) - at
                return
            if not text.startswith(child.label, at):
                same = shared_prefix(child.label, text, at)
                upper = Node(child.label[:same])
                child.label = child.label[same:]
                upper.children[child.label[0]] = child
                node.children[upper.label[0]] = child = upper
                self.splits += 1
            at += len(child.label)
            node = child

    def spill(self, path: bytes | None = None) -> Iterator[tuple[bytes, Owner]]:
        """Remove and yield every subtree off ``path``: texts that, in sorted input, cannot come again."""
        stack, keep = [(self.root, b"")], set()
        node, at = self.root, 0
        while path is not None and node is not None:
            keep.add(id(node))
            node = node.children.get(path[at]) if at < len(path) else None
            at += len(node.label) if node else 0
        while stack:
            node, prefix = stack.pop()
            text = prefix + node.label
            if node.owner and not (id(node) in keep and text == path):
                yield text, node.owner
                node.owner = None
            for first, child in list(node.children.items()):
                stack.append((child, text))
                if id(child) not in keep:
                    self.bytes -= len(child.label)
                    del node.children[first]


def _fold(id_col: str, text_col: str, carry: list[str], largest: bool, resident: int = RESIDENT_BYTES):
    """Per task: rows of equal texts become one. Unsorted input, so what is spilled may come again; the reducer folds it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forest: dict[tuple[int, int], Patricia] = {}
        held = 0
        out: list[tuple[bytes, Owner]] = []

        def rows() -> pa.RecordBatch:
            fields = {
                "_text": pa.array([text for text, _ in out], pa.binary()),
                "_id": pa.array([o.id for _, o in out], pa.int64()),
                "_top": pa.array([o.top for _, o in out], pa.int64()),
                "_rows": pa.array([o.rows for _, o in out], pa.int64()),
            }
            for k, name in enumerate(carry):
                fields[f"_c{k}"] = pa.array([o.carried[k] for _, o in out], kinds[name])
            out.clear()
            return pa.RecordBatch.from_pydict(fields)

        kinds: dict[str, pa.DataType] = {}
        for batch in batches:
            kinds = {name: batch.schema.field(name).type for name in carry}
            carried = zip(*(batch.column(name).to_pylist() for name in carry)) if carry else (() for _ in range(batch.num_rows))
            lengths, hashes, ids = (batch.column(x).to_pylist() for x in ("_len", "_hash", id_col))
            texts = batch.column(text_col).cast(pa.binary())
            for k, extra in enumerate(carried):
                trie = forest.setdefault((lengths[k].bit_length(), hashes[k] >> (64 - FOLD_BITS)), Patricia(largest))
                held -= trie.bytes
                trie.insert(texts[k].as_py() or b"", Owner(ids[k], 1, 1, extra))
                held += trie.bytes
                if held > resident:
                    # Texts of one row so far go first: one that has been seen again is worth keeping.
                    for trie in forest.values():
                        for text, owner in list(trie.spill()):
                            if owner.rows > 1:
                                trie.insert(text, owner)
                            else:
                                out.append((text, owner))
                        if len(out) >= 1000:
                            yield rows()
                    if sum(trie.bytes for trie in forest.values()) > resident // 2:
                        for trie in forest.values():
                            out.extend(trie.spill())
                    held = sum(trie.bytes for trie in forest.values())
                    if out:
                        yield rows()
        for trie in forest.values():
            out.extend(trie.spill())
            if len(out) >= 1000:
                yield rows()
        if out:
            yield rows()

    return run


def _own(carry: list[str], largest: bool, with_text: bool, resident: int = RESIDENT_BYTES):
    """Per task, over rows sorted by text: the final owner of each text, from one trie."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds: dict[str, pa.DataType] = {}
        out: list[tuple[bytes, Owner]] = []

        def rows() -> Iterator[pa.RecordBatch]:
            for at in range(0, len(out), 1000):
                part = out[at : at + 1000]
                fields = {
                    "text_sha256": pa.array([hashlib.sha256(text).hexdigest() for text, _ in part], pa.string()),
                    "keep_id": pa.array([o.id for _, o in part], pa.int64()),
                    "top_rows": pa.array([o.top for _, o in part], pa.int64()),
                    "group_size": pa.array([o.rows for _, o in part], pa.int64()),
                }
                if with_text:
                    fields["_text"] = pa.array([text for text, _ in part], pa.binary())
                for k in range(len(carry)):
                    fields[f"_c{k}"] = pa.array([o.carried[k] for _, o in part], kinds[f"_c{k}"])
                yield pa.RecordBatch.from_pydict(fields)
            out.clear()

        trie = Patricia(largest)
        for batch in batches:
            kinds = {f"_c{k}": batch.schema.field(f"_c{k}").type for k in range(len(carry))}
            carried = zip(*(batch.column(k).to_pylist() for k in kinds)) if carry else (() for _ in range(batch.num_rows))
            columns = (batch.column(x).to_pylist() for x in ("_id", "_top", "_rows"))
            texts = batch.column("_text")
            for k, (key, top, count, extra) in enumerate(zip(*columns, carried)):
                text = texts[k].as_py()
                trie.insert(text, Owner(key, top, count, extra))
                if trie.bytes > resident:
                    out.extend(trie.spill(text))
                    yield from rows()
        out.extend(trie.spill())
        yield from rows()

    return run


def _owners(docs: DataFrame, id_col: str, text_col: str, largest: bool, carry: list[str], with_text: bool, resident: int = RESIDENT_BYTES) -> DataFrame:
    """:func:`owners`, with the text as ``_text`` and the k-th carried column of the owning row as ``_ck``."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    extra = [f"_c{k}" for k in range(len(carry))]
    keyed = docs.select(
        F.octet_length(text).cast("long").alias("_len"),
        F.xxhash64(text).alias("_hash"),
        F.col(id_col).cast("long").alias("_key"),
        text.alias("_body"),
        *(F.col(c).alias(name) for c, name in zip(carry, extra)),
    )
    carried = [keyed.schema[name] for name in extra]
    long = lambda *names: [T.StructField(x, T.LongType()) for x in names]
    folded = keyed.mapInArrow(
        _fold("_key", "_body", extra, largest, resident),
        T.StructType([T.StructField("_text", T.BinaryType()), *long("_id", "_top", "_rows"), *carried]),
    )
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = folded.repartition(partitions, F.octet_length("_text"), F.xxhash64("_text"))
    kept = [T.StructField("_text", T.BinaryType())] if with_text else []
    schema = T.StructType([T.StructField("text_sha256", T.StringType()), *long("keep_id", "top_rows", "group_size"), *kept, *carried])
    return dealt.sortWithinPartitions("_text").mapInArrow(_own(extra, largest, with_text, resident), schema)


def owners(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", largest: bool = False) -> DataFrame:
    """One row per distinct text: ``text_sha256, keep_id, top_rows, group_size``.

    ``keep_id`` is the smallest id of the text's rows (``largest``: the largest); a null id yields
    to any other. ``top_rows`` counts the rows that carry it, ``group_size`` all rows. A null text
    is the empty text. An empty table gives no rows.
    """
    return _owners(docs, id_col, text_col, largest, [], with_text=False)


def duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", largest: bool = False) -> DataFrame:
    """One row per document: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Exactly one row of each group of equal texts is kept: the one with ``keep_id``; if several rows
    carry that id (repeated rows, or only null ids), one of them.
    """
    found = stage(owners(docs, id_col, text_col, largest), "exact-owners")
    thin = stage(
        docs.select(
            F.col(id_col).alias("doc_id"),
            F.sha2(F.coalesce(F.col(text_col), F.lit("")).cast("binary"), 256).alias("text_sha256"),
            F.monotonically_increasing_id().alias("_row"),
        ),
        "exact-rows",
    )
    both = lookup(thin, found, "text_sha256", "group_size", thin.count())
    # Where several rows carry the owning id, the first written stays.
    shared = found.filter("top_rows > 1").withColumnsRenamed({"keep_id": "_keep", "group_size": "_size"}).drop("top_rows")
    first = (
        lookup(thin, shared, "text_sha256", "_size", thin.count())
        .filter(F.col("doc_id").eqNullSafe(F.col("_keep")))
        .groupBy("text_sha256")
        .agg(F.min("_row").alias("_row"))
        .select("_row", F.lit(True).alias("_first"))
    )
    kept = F.when(F.col("top_rows") == 1, F.col("doc_id").eqNullSafe(F.col("keep_id"))).otherwise(F.coalesce("_first", F.lit(False)))
    return both.join(first, "_row", "left").select("doc_id", "keep_id", "group_size", kept.alias("kept"), "text_sha256")


def distinct_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", largest: bool = False) -> DataFrame:
    """The documents without their exact copies, with all columns: the owner's row of each text. A null text becomes the empty one."""
    carry = [c for c in docs.columns if c not in (id_col, text_col)]
    found = _owners(docs, id_col, text_col, largest, carry, with_text=True)
    own = {id_col: F.col("keep_id").cast(docs.schema[id_col].dataType), text_col: F.col("_text").cast("string")}
    return found.select(*(own.get(c, F.col(f"_c{carry.index(c)}") if c in carry else None).alias(c) for c in docs.columns))
