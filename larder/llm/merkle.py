"""Merkle manifest of a dataset, and inclusion proofs for all leaves at once (octopus multiproofs).

Leaves of a group are ordered and hashed together in runs of ``ARITY``, level by level, until one node remains.
Leaves are dealt into blocks of ``ARITY ** k`` neighbours, which are the partitions of the proof:

1. a block folds its own leaves to one node; the few nodes above are aggregated in Spark, a level at a time;
2. a block lists the coordinates of all nodes that the proofs of its leaves need and that it cannot derive itself:
   the minimal union, since each is named once however many leaves need it;
3. these are fetched in one join;
4. the block derives the interior nodes its leaves share, and expands every leaf's own proof from both.

No task holds more than a block. A group may hold any share of the leaves, and so may a repeated row: leaves
that agree in order and hash take their places in any order, which gives the same set of results.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.operators.sweep import swept
from larder.session import stage

#: Nodes hashed together, and the height of a block at most (4096 leaves).
ARITY, BLOCK_LEVELS = 8, 4

#: Characters of a digest.
HEX = 64


def field(value: Column) -> Column:
    """A value as it enters a leaf: ``-`` if NULL, else its length in UTF-8 bytes, a colon, and itself."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def digest(*parts: Column) -> Column:
    """SHA-256 of the parts after one another, in lower-case hex."""
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def group_key(value: Column) -> Column:
    """A text that sorts as the group does, NULL first and never NULL itself."""
    return F.coalesce(F.concat(F.lit("="), value.cast("string")), F.lit(""))


def parents_of(nodes: bytes) -> bytes:
    """The level above: digests of runs of ``ARITY`` digests."""
    step = HEX * ARITY
    return b"".join(hashlib.sha256(nodes[a : a + step]).hexdigest().encode() for a in range(0, len(nodes), step))


def level_sizes(n: int) -> list[int]:
    """Number of nodes per level of a tree over ``n`` leaves, the root last."""
    sizes = [n]
    while sizes[-1] > 1:
        sizes.append(-(-sizes[-1] // ARITY))
    return sizes


def missing_nodes(positions: np.ndarray, n: int) -> list[tuple[int, np.ndarray]]:
    """Per level the nodes that proofs of the leaves at ``positions`` need and that cannot be derived from these leaves.

    Of every run with a node on some leaf's way, the others are needed; those on a way themselves are derived.
    """
    own, found = np.unique(positions), []
    for level, size in enumerate(level_sizes(n)[:-1]):
        runs = np.unique(own // ARITY)
        needed = (runs[:, None] * ARITY + np.arange(ARITY)).ravel()
        needed = np.setdiff1d(needed[needed < size], own, assume_unique=True)
        if len(needed):
            found.append((level, needed))
        own = runs
    return found


def expanded(first: int, leaves: bytes, n: int, fetched: dict[tuple[int, int], bytes]) -> tuple[list[list[str]], list[list[str]]]:
    """Left and right siblings per level, for the neighbouring leaves that begin at place ``first`` of a tree over ``n``."""
    sizes = level_sizes(n)
    lefts: list[list[str]] = []
    rights: list[list[str]] = []
    if len(sizes) == 1:
        return [[]], [[]]
    # From the leaves up: the runs that hold own nodes, completed by fetched ones.
    runs, own, start = [], leaves, first
    for level, size in enumerate(sizes[:-1]):
        count = len(own) // HEX
        low, high = start // ARITY * ARITY, min(-(-(start + count) // ARITY) * ARITY, size)
        before = b"".join(fetched[level, k] for k in range(low, start))
        after = b"".join(fetched[level, k] for k in range(start + count, high))
        whole = before + own + after
        runs.append((low, whole.decode()))
        own, start = parents_of(whole), low // ARITY

    def siblings(level: int, place: int) -> tuple[list[str], list[str]]:
        """Of a node and all above it."""
        left, right = [], []
        for low, text in runs[level:]:
            k = place - low
            a, b = k // ARITY * ARITY * HEX, (k // ARITY + 1) * ARITY * HEX
            left.append(text[a : k * HEX])
            right.append(text[(k + 1) * HEX : b])
            place //= ARITY
        return left, right

    low, text = runs[0]
    parent = -1
    for place in range(first, first + len(leaves) // HEX):
        if place // ARITY != parent:
            parent = place // ARITY
            above = siblings(1, parent) if len(runs) > 1 else ([], [])
        k = place - low
        a, b = k // ARITY * ARITY * HEX, (k // ARITY + 1) * ARITY * HEX
        lefts.append([text[a : k * HEX], *above[0]])
        rights.append([text[(k + 1) * HEX : b], *above[1]])
    return lefts, rights


def _text_lists(values: list[list[str]]) -> pa.Array:
    stops = np.cumsum([0, *map(len, values)])
    return pa.ListArray.from_arrays(pa.array(stops, pa.int32()), pa.array([x for v in values for x in v], pa.string()))


class Manifest:
    """Trees over the leaves of each group.

    ``leaves`` has a digest ``leaf`` and any other columns. ``group`` is a column (NULL is a group, the first one),
    ``order`` names columns (NULL last); ties go by the digest. ``roots`` has one row per group: ``key``, ``n``, ``root``.
    Runs jobs when made. Other columns are carried, but for those with the name of a result. Repeated rows are leaves of their own.
    """

    def __init__(self, leaves: DataFrame, group: Column, order: list[str]):
        self.spark, self.carried = leaves.sparkSession, leaves.columns
        keyed = leaves.select(F.struct(*(F.col(f"`{c}`") for c in leaves.columns)).alias("row"), group_key(group).alias("key"))
        keyed = stage(keyed.select("row", "key", F.col("row.leaf").alias("leaf"), *(F.col("row")[c].alias(f"_o{k}") for k, c in enumerate(order))), "merkle-leaves")
        ties = [f"_o{k}" for k in range(len(order))]
        placed = swept(keyed.withColumn("_each", F.lit(1)), ["key"], [*ties, "leaf"], totals={"n": "_each"}, position="at")
        rows, parts = keyed.count(), int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        self.height = 1
        while self.height < BLOCK_LEVELS and rows // ARITY ** (self.height + 1) >= 2 * parts:
            self.height += 1
        width = ARITY**self.height
        at = F.col("at") - 1
        member = F.struct(at.alias("at"), "leaf", "row")
        blocks = placed.groupBy("key", "n", F.floor(at / F.lit(width)).cast("long").alias("block"))
        self.blocks = stage(blocks.agg(F.array_sort(F.collect_list(member)).alias("members")), "merkle-blocks")
        self.nodes = self._nodes()
        top = F.col("level") == self._height_of(F.col("n"))
        self.roots = stage(self.nodes.filter(top).select("key", "n", F.col("hash").alias("root")), "merkle-roots")

    def _height_of(self, n: Column) -> Column:
        """Level of the root: the least at which one node remains."""
        return reduce(lambda found, k: F.when(n <= ARITY**k, F.lit(k)).otherwise(found), range(20, -1, -1), F.lit(21))

    def _nodes(self) -> DataFrame:
        """``key, n, level, idx, hash`` of the blocks' own nodes and of all above them."""
        height = self.height

        def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                levels, hashes = [], []
                stops = batch.column("leaves").offsets.to_pylist()
                digests = batch.column("leaves").values.to_pylist()
                for n, a, b in zip(batch.column("n").to_pylist(), stops, stops[1:]):
                    nodes, level = "".join(digests[a:b]).encode(), 0
                    top = min(height, len(level_sizes(n)) - 1)
                    while level < top:
                        nodes, level = parents_of(nodes), level + 1
                    levels.append(level)
                    hashes.append(nodes.decode())
                columns = [batch.column(c) for c in ("key", "n", "block")]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(levels, pa.int32()), pa.array(hashes, pa.string())], ["key", "n", "idx", "level", "hash"])

        slim = self.blocks.select("key", "n", "block", F.col("members.leaf").alias("leaves"))
        level = stage(slim.mapInArrow(fold, "key string, n long, idx long, level int, hash string"), "merkle-nodes")
        every = [level]
        most = self.blocks.agg(F.max("n")).first()[0] or 0
        for k in range(height, len(level_sizes(most)) - 1):
            # Eight digests at most.
            inner = level.filter((F.col("level") == k) & (F.col("n") > ARITY**k)).withColumn("up", F.floor(F.col("idx") / F.lit(ARITY)).cast("long"))
            run = inner.groupBy("key", "n", "up").agg(F.array_sort(F.collect_list(F.struct("idx", "hash"))).alias("run"))
            level = run.select("key", "n", F.col("up").alias("idx"), F.lit(k + 1).alias("level"), digest(F.array_join(F.col("run.hash"), "")).alias("hash"))
            level = stage(level, "merkle-nodes")
            every.append(level)
        return reduce(DataFrame.unionByName, every)

    def proofs(self, above: DataFrame | None = None) -> DataFrame:
        """The leaves' columns, with ``position`` (from 0), ``root`` of the group, and ``lefts``, ``rights``: the siblings on either side
        at each level of the way up, as digests after one another.

        ``above`` continues the way: ``key, lefts, rights, root`` with one row per group, whose levels follow those of the group
        and whose ``root`` takes the place of the group's, which is then ``subroot``.
        """
        width = ARITY**self.height

        def coordinates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                row, level, idx = [], [], []
                for k, (n, block, count) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("n", "block", "count")))):
                    for depth, nodes in missing_nodes(np.arange(block * width, block * width + count), n):
                        row.extend([k] * len(nodes))
                        level.extend([depth] * len(nodes))
                        idx.extend(nodes.tolist())
                take = pa.array(row, pa.int64())
                columns = [batch.column(c).take(take) for c in ("key", "block")]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(level, pa.int32()), pa.array(idx, pa.int64())], ["key", "block", "level", "idx"])

        counted = self.blocks.select("key", "n", "block", F.size("members").alias("count"))
        wanted = counted.mapInArrow(coordinates, "key string, block long, level int, idx long")
        fetched = wanted.join(self.nodes.select("key", "level", "idx", "hash"), ["key", "level", "idx"])
        # At most seven nodes a level.
        fetched = fetched.groupBy("key", "block").agg(F.collect_list(F.struct("level", "idx", "hash")).alias("nodes"))
        ends, ending = self.roots.select("key", "root"), ["root"]
        if above is not None:
            more = above.select("key", F.col("root").alias("top"), F.col("lefts").alias("more_lefts"), F.col("rights").alias("more_rights"))
            ends, ending = ends.join(more, "key").withColumnsRenamed({"root": "subroot", "top": "root"}), ["root", "subroot"]
        frame = counted.select("key", "block").join(fetched, ["key", "block"], "left").join(ends, "key")
        rows = self.blocks.join(frame, ["key", "block"])

        def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for k, n in enumerate(batch.column("n").to_pylist()):
                    first = batch.column("first")[k].as_py()
                    leaves = "".join(batch.column("leaves")[k].as_py()).encode()
                    nodes = {(x["level"], x["idx"]): x["hash"].encode() for x in batch.column("nodes")[k].as_py() or ()}
                    lefts, rights = expanded(first, leaves, n, nodes)
                    one = batch.slice(k, 1)
                    yield pa.RecordBatch.from_arrays(
                        [one.column(c) for c in kept] + [_nested(lefts), _nested(rights)], [*kept, "lefts", "rights"]
                    )

        kept = ["members", *ending, *(("more_lefts", "more_rights") if above is not None else ())]
        slim = rows.select("n", *kept, F.col("members.leaf").alias("leaves"), (F.col("members")[0]["at"]).alias("first"), "nodes")
        kinds = ", ".join(f"{c} {slim.schema[c].dataType.simpleString()}" for c in kept)
        found = slim.mapInArrow(expand, f"{kinds}, lefts array<array<string>>, rights array<array<string>>")
        each = found.select(*kept[1:], F.inline(F.arrays_zip("members", "lefts", "rights")))
        lefts, rights = F.col("lefts"), F.col("rights")
        if above is not None:
            lefts, rights = F.concat(lefts, "more_lefts"), F.concat(rights, "more_rights")
        results = {*ending, "position", "lefts", "rights"}
        carried = [F.col("members.row")[c].alias(c) for c in self.carried if c not in results]
        return each.select(*carried, F.col("members.at").alias("position"), *ending, lefts.alias("lefts"), rights.alias("rights"))


def _nested(values: list[list[str]]) -> pa.Array:
    """One list of lists of texts."""
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), _text_lists(values))


def folded(leaf: Column, lefts: Column, rights: Column) -> Column:
    """The root that follows from a leaf and its siblings."""
    steps = F.arrays_zip(lefts.alias("a"), rights.alias("b"))
    return F.aggregate(steps, leaf, lambda node, step: digest(step["a"], node, step["b"]))


def siblings_digest(lefts: Column, rights: Column) -> Column:
    """SHA-256 of all siblings, level by level, left to right."""
    return digest(F.array_join(F.zip_with(lefts, rights, lambda a, b: F.concat(a, b)), ""))
