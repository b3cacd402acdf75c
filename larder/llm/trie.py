"""Prefix trie of conversations by ROLLUP over positional turn columns.

A turn is known by a digest of its role and text. A conversation is cut into blocks of ``WIDTH`` turns; a block
is a row with one column per position. ``GROUP BY ROLLUP`` over these columns aggregates the prefixes of every length
in a block together, and ``grouping_id`` tells their length. A longer conversation continues in a further block,
grouped by ``prior``: the node at which the block before ends, as the sum of the digests of all blocks up to it. Sums
run along sorted partitions, so neither the number of turns of a conversation nor the number of conversations
below a node is bounded by a task.

What a subtree sums up comes from a second ROLLUP: a node's own value is put at its smallest member, whose path
leads through the node, and what lies at or below a depth is added up along that conversation first.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.llm.common import lookup
from larder.operators.sweep import swept
from larder.session import stage

#: Turns per block, and ids per piece of what is hashed for a node.
WIDTH, PIECE = 8, 2048

_PLACES = range(1, WIDTH + 1)
_TURNS = [f"t{k}" for k in _PLACES]
_LIMBS = [f"p{k}" for k in range(4)]


def turn_digest(role: Column, text: Column) -> Column:
    """128 bits of SHA-256 as hex. The role's length keeps its end apart from the text's beginning."""
    return F.substring(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256), 1, 32)


def turns(conversations: DataFrame) -> DataFrame:
    """``conv_id, place, n, turn_id, words``: the turns of each conversation from 1, and how many it has.

    Turns ascend, NULL first; equal ones (also repeated rows, which all count) go by their digests. NULL roles
    and texts are empty; rows without ``conv_id`` belong to no conversation.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    thin = conversations.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").isNotNull().alias("_known"),
        F.col("turn").alias("_turn"),
        turn_digest(role, text).alias("turn_id"),
        F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("words"),
        F.lit(1).alias("_each"),
    )
    placed = swept(stage(thin, "trie-turns"), ["conv_id"], ["_known", "_turn", "turn_id"], totals={"n": "_each"}, position="place")
    return placed.select("conv_id", "place", "n", "turn_id", "words")


def with_shared_beginnings(placed: DataFrame, donor: Column, shared: Column) -> DataFrame:
    """``conv_id, depth, turn_id, words`` of rebuilt conversations; depth 0 without a turn for every conversation.

    The first ``shared`` turns are those of conversation ``donor`` (fewer if it has fewer), then come its own turns after its first
    ``shared``. Both columns depend on ``conv_id`` alone. At most ``MOST_SHARED`` turns are taken.
    """
    first = placed.filter(F.col("place") == 1).select("conv_id", shared.alias("h"), donor.alias("donor"))
    given = placed.filter(F.col("place") <= MOST_SHARED).groupBy(F.col("conv_id").alias("donor"))
    given = given.agg(F.array_sort(F.collect_list(F.struct("place", "turn_id", "words"))).alias("given"))
    # A donor's turns are three at most, and the rows of both sides are one per conversation.
    heads = stage(first.join(given, "donor", "left").select("conv_id", "h", F.slice("given", 1, F.col("h").cast("int")).alias("given")), "trie-heads")
    taken = heads.select("conv_id", F.inline("given")).withColumnRenamed("place", "depth")
    moved = heads.select("conv_id", "h", F.greatest(F.size("given"), F.lit(0)).alias("m"))
    own = placed.join(moved, "conv_id").filter(F.col("place") > F.col("h"))
    own = own.select("conv_id", (F.col("place") - F.col("h") + F.col("m")).cast("long").alias("depth"), "turn_id", "words")
    none = heads.select("conv_id", F.lit(0).cast("long").alias("depth"), F.lit(None).cast("string").alias("turn_id"), F.lit(0).cast("long").alias("words"))
    return own.unionByName(taken.select(own.columns)).unionByName(none)


#: Turns that may be taken from a donor.
MOST_SHARED = 3


def _limbs(text: Column) -> list[Column]:
    """Four 32-bit numbers of the text's digest."""
    hexed = F.sha2(text.cast("binary"), 256)
    return [F.conv(F.substring(hexed, 8 * k + 1, 8), 16, 10).cast("long") for k in range(4)]


def blocks(sequences: DataFrame) -> DataFrame:
    """``conv_id, block, size, t1..t8, p0..p3`` from ``conv_id, depth, turn_id, words``; block 0 is there for every conversation.

    A turn column holds digest and words; ``size`` counts the turns of the block; the limbs are those of the node before the block.
    """
    place = F.pmod(F.col("depth") - 1, F.lit(WIDTH)) + 1
    block = F.when(F.col("depth") > 0, F.floor((F.col("depth") - 1) / F.lit(WIDTH))).otherwise(0).cast("long").alias("block")
    turn = F.concat("turn_id", F.col("words").cast("string"))
    rows = sequences.groupBy("conv_id", block).agg(
        F.count("turn_id").cast("int").alias("size"),
        *(F.max(F.when((F.col("depth") > 0) & (place == k), turn)).alias(t) for k, t in zip(_PLACES, _TURNS)),
    )
    whole = F.concat_ws(",", F.col("block").cast("string"), *_TURNS)
    rows = rows.withColumns({f"own{k}": limb for k, limb in enumerate(_limbs(whole))})
    rows = swept(rows, ["conv_id"], ["block"], running={f"upto{k}": (f"own{k}", False) for k in range(4)})
    priors = {p: F.col(f"upto{k}") - F.col(f"own{k}") for k, p in enumerate(_LIMBS)}
    return rows.select("conv_id", "block", "size", *_TURNS, *(c.alias(p) for p, c in priors.items()), *(f"upto{k}" for k in range(4)))


def _key(depth: Column, prior: list[Column], turns_of: Column) -> Column:
    """Identity of a node: its depth, the node before its block, and the turns in the block (none at a block's end)."""
    return F.substring(F.sha2(F.concat_ws("|", depth.cast("string"), *(p.cast("string") for p in prior), turns_of).cast("binary"), 256), 1, 32)


def _node_keys(depth: Column, size: Column) -> tuple[Column, Column]:
    """Keys of the node after ``size`` turns of a block, and of its parent."""
    prior = [F.col(p) for p in _LIMBS]
    after = _limbs(F.concat_ws(",", F.col("block").cast("string"), *_TURNS))
    after = [a + b for a, b in zip(prior, after)]
    cut = lambda n: F.array_join(F.slice(F.array(*_TURNS), 1, n), ",")
    inside = _key(depth, prior, cut(size.cast("int")))
    at_end = _key(depth, after, F.lit(""))
    start = _key(depth, prior, F.lit(""))
    own = F.when(size == WIDTH, at_end).when(size == 0, start).otherwise(inside)
    parent = F.when(size == 1, _key(depth - 1, prior, F.lit(""))).when(size > 1, _key(depth - 1, prior, cut((size - 1).cast("int"))))
    return own, parent


def _rolled(rows: DataFrame, sums: dict[str, str]) -> DataFrame:
    """All nodes of all blocks: one ROLLUP over the turn columns, keyed by block and prior node."""
    view = "trie_blocks"
    rows.createOrReplaceTempView(view)
    groups, columns = ", ".join(["block", *_LIMBS]), ", ".join(_TURNS)
    extra = "".join(f", {sql} AS {name}" for name, sql in sums.items())
    rolled = rows.sparkSession.sql(
        f"SELECT {groups}, {columns}, {WIDTH} - bit_count(grouping_id()) AS inner_depth, min(conv_id) AS conv_id, count(*) AS n_convs{extra} "
        f"FROM {view} GROUP BY {groups}, ROLLUP ({columns})"
    )
    rows.sparkSession.catalog.dropTempView(view)
    inner = F.col("inner_depth")
    last = F.element_at(F.array(*_TURNS), F.greatest(inner, F.lit(1)).cast("int"))
    # A prefix that is longer than the conversation is none; the node before a later block is that of the block before.
    real = F.when(inner == 0, F.col("block") == 0).otherwise(last.isNotNull())
    depth = F.col("block") * WIDTH + inner
    own, parent = _node_keys(depth, inner)
    words = F.when(inner == 0, F.lit(0)).otherwise(F.substring(last, 33, 20)).cast("long")
    return rolled.filter(real).select(
        own.alias("key"), parent.alias("parent"), depth.cast("long").alias("depth"), "conv_id", "n_convs", words.alias("words"), *sums, "block", "inner_depth"
    )


def _ends(rows: DataFrame) -> DataFrame:
    """``key, ends_sha256``: per node the SHA-256 of the ids of the conversations that end there, ascending, comma-joined.

    Sorted partitions are cut into pieces, and a node's pieces run through one hash, a batch at a time.
    """
    later = rows.select("conv_id", F.col("block") - 1).filter("block >= 0")
    last = rows.join(later.toDF("conv_id", "block"), ["conv_id", "block"], "left_anti")
    depth = F.col("block") * WIDTH + F.col("size")
    ends = last.select(_node_keys(depth, F.col("size"))[0].alias("key"), "conv_id")
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ends = stage(ends, "trie-ends").repartitionByRange(parts, "key", "conv_id").sortWithinPartitions("key", "conv_id")
    ends = stage(ends.withColumn("at", F.monotonically_increasing_id()), "trie-ends")
    # A piece lies within a partition: these begin at multiples of 2 ** 33.
    piece = F.floor(F.col("at") / F.lit(PIECE)).alias("piece")
    joined = F.array_join(F.array_sort(F.collect_list("conv_id")).cast("array<string>"), ",")
    pieces = ends.groupBy("key", piece).agg(joined.alias("ids"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state = None, None
        for batch in batches:
            keys, found = [], []
            for key, ids in zip(batch.column("key").to_pylist(), batch.column("ids").to_pylist()):
                if key == now:
                    state.update(b"," + ids.encode())
                    continue
                if now is not None:
                    keys.append(now)
                    found.append(state.hexdigest())
                now, state = key, hashlib.sha256(ids.encode())
            yield pa.RecordBatch.from_pydict({"key": pa.array(keys, pa.string()), "ends_sha256": pa.array(found, pa.string())})
        if now is not None:
            yield pa.RecordBatch.from_pydict({"key": pa.array([now], pa.string()), "ends_sha256": pa.array([state.hexdigest()], pa.string())})

    ordered = pieces.repartition("key").sortWithinPartitions("key", "piece").select("key", "ids")
    return ordered.mapInArrow(run, "key string, ends_sha256 string")


def prefix_trie(sequences: DataFrame) -> DataFrame:
    """One row per distinct prefix of the sequences (``conv_id, depth, turn_id, words`` as :func:`with_shared_beginnings` gives them).

    ``conv_id`` smallest member; ``depth``; ``parent_conv_id``; ``n_convs`` members; ``n_children``; ``n_leaves`` childless nodes in the
    subtree; ``saved_tokens`` sum over the subtree of ``(n_convs - 1) * words``; ``ends_sha256``. The root has depth 0 and a NULL parent.
    Without conversations there is no row. Runs jobs when called.
    """
    rows = blocks(sequences)
    base = _rolled(rows, {})
    nodes = stage(base, "trie-nodes")
    children = nodes.filter(F.col("parent").isNotNull()).groupBy(F.col("parent").alias("key")).agg(F.count(F.lit(1)).alias("n_children"))
    family = stage(nodes.join(children, "key", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("long"))), "trie-family")

    # Each node's value at its smallest member: that conversation's row of the block, by position.
    value = (F.col("n_convs") - 1) * F.col("words")
    at = F.col("inner_depth")
    worth = family.groupBy("conv_id", "block").agg(
        *(F.coalesce(F.max(F.when(at == k, value)), F.lit(0)).alias(f"v{k}") for k in (0, *_PLACES)),
        F.max((F.col("n_children") == 0).cast("long")).alias("leaf"),
    )
    filled = rows.join(worth, ["conv_id", "block"], "left").fillna(0, [f"v{k}" for k in (0, *_PLACES)] + ["leaf"])
    filled = filled.withColumn("whole", sum((F.col(f"v{k}") for k in _PLACES), F.col("v0")))
    filled = swept(filled, ["conv_id"], ["block"], running={"rest": ("whole", True)}, totals={"is_leaf": "leaf"})
    # What the conversation holds at or below each depth of the block.
    below = {"s0": F.col("rest")} | {f"s{k}": F.col("rest") - sum((F.col(f"v{j}") for j in range(1, k)), F.col("v0")) for k in _PLACES}
    filled = stage(filled.select("conv_id", "block", "size", *_TURNS, *_LIMBS, "is_leaf", *(c.alias(s) for s, c in below.items())), "trie-filled")
    sums = {f"s{k}": f"sum(s{k})" for k in (0, *_PLACES)} | {"n_leaves": "sum(is_leaf)"}
    summed = _rolled(filled, sums)
    saved = F.element_at(F.array(*(F.col(f"s{k}") for k in (0, *_PLACES))), (F.col("inner_depth") + 1).cast("int"))
    summed = summed.select("key", "n_leaves", saved.alias("saved_tokens"))

    empty = hashlib.sha256(b"").hexdigest()
    whole = family.join(summed, "key").join(_ends(rows), "key", "left").withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(empty)))
    whole = stage(whole.drop("block", "inner_depth", "words"), "trie-whole")
    # One row per parent, with the number of rows that look it up: the root may have a third of all nodes as children.
    parents = family.filter("n_children > 0").select(F.col("key").alias("parent"), F.col("conv_id").alias("parent_conv_id"), F.col("n_children").alias("_copies"))
    inner = lookup(whole.filter(F.col("parent").isNotNull()), parents, "parent", "_copies", nodes.count())
    root = whole.filter(F.col("parent").isNull()).withColumn("parent_conv_id", F.lit(None).cast("long"))
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return inner.select(columns).unionByName(root.select(columns))
