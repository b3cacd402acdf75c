"""Mixing sources to target weights as a min-cost flow.

A document may belong to several sources. Documents are aggregated by membership pattern, so the
flow sees patterns, not documents: each source sends its quota to the patterns it belongs to,
and a pattern takes its size once at cost 0, once more at cost 1, and so on: repetition
gets dearer with every copy, so it is spread before it is stacked. The flow says how many words each
pattern gives; whole copies follow from it, and what remains is filled with documents in
the order of a seeded hash.

What the driver holds is one row per pattern (``max_patterns``, else an error). Documents are
compared with a cut in hash order that is found from sums per hash bucket; only the bucket
that holds the cut is looked at document by document.
"""

from __future__ import annotations

from collections import defaultdict, deque
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larder.llm.common import column_of, per_doc, slices, utf8, word_spans
from larder.session import stage

#: Distinct patterns, and distinct sources, that a mix may have.
MAX_PATTERNS = 10_000

#: Documents that the bucket with the cut should hold, and how many buckets a pattern may have.
CUT_DOCS, MAX_BUCKETS = 4_000, 1 << 16

#: Documents chosen at the cuts up to which their table (three numbers each) is broadcast; beyond, it is joined by shuffle.
CHOSEN_ROWS = 500_000


class Flow:
    """A network with unit costs on its arcs; ``push`` sends as much as it can at the least cost."""

    def __init__(self) -> None:
        self.arcs: dict[str | tuple, list[list]] = defaultdict(list)

    def arc(self, a, b, room: int, cost: int) -> list:
        """An arc and its reverse: [to, room, cost, reverse]."""
        there, back = [b, room, cost, None], [a, 0, -cost, None]
        there[3], back[3] = back, there
        self.arcs[a].append(there)
        self.arcs[b].append(back)
        return there

    def push(self, start, end) -> None:
        """Successive cheapest paths until ``end`` is cut off."""
        while True:
            cost, via, queue, waiting = {start: 0}, {}, deque([start]), {start}
            while queue:
                node = queue.popleft()
                waiting.discard(node)
                for arc in self.arcs[node]:
                    if arc[1] > 0 and cost[node] + arc[2] < cost.get(arc[0], float("inf")):
                        cost[arc[0]], via[arc[0]] = cost[node] + arc[2], arc
                        if arc[0] not in waiting:
                            waiting.add(arc[0])
                            queue.append(arc[0])
            if end not in via:
                return
            path, node = [], end
            while node != start:
                path.append(via[node])
                node = via[node][3][0]
            amount = min(arc[1] for arc in path)
            for arc in path:
                arc[1] -= amount
                arc[3][1] += amount


def route(patterns: dict[tuple, int], quotas: dict, repeats: int) -> dict[tuple, int]:
    """Words each pattern gives. ``patterns``: sources to size; ``quotas``: words wanted per source.

    Patterns without a source in common, directly or through others, are solved apart.
    """
    parent: dict = {s: s for s in quotas}

    def top(s):
        while parent[s] != s:
            parent[s] = s = parent[parent[s]]
        return s

    for members in patterns:
        for s in members[1:]:
            parent[top(s)] = top(members[0])
    parts: dict = defaultdict(list)
    for members in patterns:
        if members:
            parts[top(members[0])].append(members)
    given = dict.fromkeys(patterns, 0)
    for part in parts.values():
        net, out = Flow(), defaultdict(list)
        for s in sorted({s for members in part for s in members}, key=str):
            net.arc("from", ("source", s), quotas[s], 0)
        for members in part:
            for s in members:
                net.arc(("source", s), ("pattern", members), quotas[s], 0)
            for k in range(repeats):
                out[members].append(net.arc(("pattern", members), "to", patterns[members], k))
        net.push("from", "to")
        for members, arcs in out.items():
            given[members] = sum(arc[3][1] for arc in arcs)
    return given


def capped_shares(sizes: dict, weights: dict, total: float, most: float) -> dict:
    """``total`` shared by weight; a share stops at ``most`` times its size and what is over is shared anew."""
    shares, open_ = dict.fromkeys(sizes, 0.0), set(sizes)
    left = float(total)
    while open_:
        weight = sum(weights[s] for s in open_)
        over = {s for s in open_ if left * weights[s] / weight > most * sizes[s]}
        if not over:
            return shares | {s: left * weights[s] / weight for s in open_}
        for s in over:
            shares[s] = float(most * sizes[s])
            left -= shares[s]
        open_ -= over
    return shares


def sized(docs: DataFrame, sources: Column, id_col: str, text_col: str, keep: bool) -> DataFrame:
    """``_id, _members, _size``: each row's sources in order and the words of its text (null: none); ``keep``: its columns as ``_row``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text):
            _, _, doc = word_spans(*utf8(column_of(batch, text)))
            columns = [batch.column(c) for c in names] + [pa.array(per_doc(doc, batch.num_rows), pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, [*names, "_size"])

    members = F.array_sort(F.array_distinct(sources)).cast("array<string>").alias("_members")
    whole = F.struct(*docs.columns).alias("_row") if keep else F.col(text_col).alias("_text")
    text = f"_row.{docs.columns.index(text_col)}" if keep else "_text"
    rows = docs.select(whole, F.col(id_col).cast("long").alias("_id"), members)
    names = [c for c in rows.columns if c != "_text"]
    schema = T.StructType([rows.schema[c] for c in names] + [T.StructField("_size", T.LongType())])
    return rows.mapInArrow(run, schema)


def by_code_point(sources) -> list:
    """Sources in code-point order, null last."""
    return sorted((s for s in sources if s is not None)) + [None] * (None in sources)


def cyclic_weights(sources: list, cycle: tuple[int, ...] = (1, 2, 3)) -> dict:
    """1, 2, 3, 1, 2, 3, ... over the sources in the order given."""
    return {s: cycle[k % len(cycle)] for k, s in enumerate(sources)}


def _greedy(group: pd.DataFrame) -> pd.DataFrame:
    """In hash order, every document that still fits; if over half is wanted, every one that may be left out is."""
    group = group[group["_size"] > 0].sort_values(["_at", "_id", "_size"])
    words = (group["_size"] * group["rows"]).tolist()
    room = int(group["room"].iloc[0]) if words else 0
    most = 2 * room > sum(words)
    room, picked = sum(words) - room if most else room, []
    for size in words:
        picked.append(size <= room)
        room -= size if picked[-1] else 0
    return group.loc[[p != most for p in picked], ["_pattern", "_id", "_size"]]


class Mix:
    """The decisions of a mix: a plan per pattern, the cut in each, and the documents chosen at the cut."""

    def __init__(self, thin: DataFrame, weights, total_share: float, repeats: int, seed: int, max_patterns: int):
        spark, self.repeats, self.seed = thin.sparkSession, repeats, seed
        seen = thin.groupBy("_members").agg(F.sum("_size").alias("size"), F.count(F.lit(1)).alias("docs"))
        seen = seen.limit(max_patterns + 1).collect()
        if len(seen) > max_patterns:
            raise ValueError(f"more than {max_patterns} combinations of sources")
        patterns = {tuple(r["_members"]): r["size"] for r in seen}
        sizes: dict = defaultdict(int)
        for members, words in patterns.items():
            for s in members:
                sizes[s] += words
        targets = capped_shares(sizes, weights(by_code_point(sizes)), total_share * sum(patterns.values()), repeats)
        given = route(patterns, {s: round(t) for s, t in targets.items()}, repeats)
        plan = []
        for r in seen:
            members = tuple(r["_members"])
            whole, rest = divmod(given[members], r["size"]) if r["size"] else (0, 0)
            buckets = max(1, min(MAX_BUCKETS, r["docs"] // CUT_DOCS))
            first = members[0] if members else None
            plan.append((len(plan), list(members), sizes.get(first, 0), float(targets.get(first, 0.0)), whole, rest, buckets))
        kinds = "_pattern int, _of array<string>, source_size long, target double, _whole long, _rest long, _buckets int"
        self.plan = F.broadcast(spark.createDataFrame(plan, kinds))
        sums = self._dealt(thin).groupBy("_pattern", "_bucket", "_rest").agg(F.sum("_size").alias("words"))
        upto = F.sum("words").over(Window.partitionBy("_pattern").orderBy("_bucket"))
        # The bucket in which the remainder is reached; those before it are taken whole.
        cut = sums.withColumn("upto", upto).filter("upto > _rest and upto - words <= _rest")
        cut = cut.select("_pattern", F.col("_bucket").alias("_cut"), F.expr("_rest - upto + words").alias("room"))
        self.cut = F.broadcast(stage(cut, "mix-cuts"))
        edge = self._dealt(thin).join(self.cut, "_pattern").filter("_bucket = _cut")
        edge = edge.groupBy("_pattern", "_id", "_size", "_at", "room").agg(F.count(F.lit(1)).alias("rows"))
        chosen = edge.groupBy("_pattern").applyInPandas(_greedy, "_pattern int, _id long, _size long")
        self.chosen = stage(chosen, "mix-chosen")
        if self.chosen.count() <= CHOSEN_ROWS:
            self.chosen = F.broadcast(self.chosen)  # else whole documents would be shuffled for a few numbers each

    def _dealt(self, rows: DataFrame) -> DataFrame:
        """The rows with their pattern's plan and their place in hash order."""
        unit = F.shiftrightunsigned(F.xxhash64(F.lit(self.seed), F.coalesce("_id", F.lit(-1))), 11).cast("double") / float(1 << 53)
        found = rows.join(self.plan, F.col("_members").eqNullSafe(F.col("_of")))
        return found.withColumn("_at", unit).withColumn("_bucket", F.floor(F.col("_at") * F.col("_buckets")).cast("int"))

    def decide(self, rows: DataFrame) -> DataFrame:
        """The rows with ``source_size, target, copies``."""
        fits = self.chosen.select(F.col("_pattern").alias("_p"), F.col("_id").alias("_i"), F.col("_size").alias("_s"), F.lit(1).alias("_fits"))
        on = (F.col("_pattern") == F.col("_p")) & F.col("_id").eqNullSafe(F.col("_i")) & (F.col("_size") == F.col("_s"))
        found = self._dealt(rows).join(self.cut, "_pattern", "left").join(fits, on, "left")
        extra = F.when((F.col("_size") > 0) & ((F.col("_bucket") < F.col("_cut")) | F.col("_fits").isNotNull()), 1).otherwise(0)
        return found.withColumn("copies", F.least(F.col("_whole") + extra, F.lit(self.repeats)).cast("int"))


def _prepared(docs, sources, id_col, text_col, weights, total_share, repeats, seed, max_patterns) -> tuple[DataFrame, Column, Mix]:
    sources = F.array(F.col("source")) if sources is None else F.coalesce(sources, F.array())
    thin = stage(sized(docs, sources, id_col, text_col, keep=False), "mix-sizes")
    return thin, sources, Mix(thin, weights, total_share, repeats, seed, max_patterns)


def mix(
    docs: DataFrame,
    sources: Column | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    weights=cyclic_weights,
    total_share: float = 1.0,
    repeats: int = 3,
    seed: int = 7,
    max_patterns: int = MAX_PATTERNS,
) -> DataFrame:
    """One row per document: ``doc_id, members, size, source_size, target, copies, taken``.

    ``sources`` is an array column (default: the column ``source`` alone); a null source is a source of its
    own, a row without sources is never taken. ``weights`` maps the ordered sources to their weights; they share
    ``total_share`` of all words, each at most ``repeats`` times its size. ``source_size`` and ``target`` are those
    of the row's first source. ``copies`` is how often the mix holds the document (0: not at all), ``taken`` is
    ``size * copies``. The choice depends on ``seed``, id and size only, so reruns agree and repeated rows share
    a fate. A null id is an id. Empty texts have size 0 and take nothing. An empty table gives no rows.
    """
    thin, _, plan = _prepared(docs, sources, id_col, text_col, weights, total_share, repeats, seed, max_patterns)
    return plan.decide(thin).select(
        F.col("_id").alias("doc_id"),
        F.col("_members").alias("members"),
        F.col("_size").alias("size"),
        "source_size",
        "target",
        "copies",
        (F.col("_size") * F.col("copies")).alias("taken"),
    )


def mixed_documents(
    docs: DataFrame,
    sources: Column | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    weights=cyclic_weights,
    total_share: float = 1.0,
    repeats: int = 3,
    seed: int = 7,
    max_patterns: int = MAX_PATTERNS,
) -> DataFrame:
    """The mix itself: all columns of the documents, each row as often as :func:`mix` holds it."""
    _, sources, plan = _prepared(docs, sources, id_col, text_col, weights, total_share, repeats, seed, max_patterns)
    found = plan.decide(sized(docs, sources, id_col, text_col, keep=True))
    return found.select("_row", F.explode(F.array_repeat(F.lit(0), F.col("copies")))).select("_row.*")
