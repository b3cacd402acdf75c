"""Exact histogram of encoded lengths, and what it answers for every context limit.

Documents are aggregated by their length in tokens. Sums from the longest length downwards then say, for a limit, how
many documents exceed it, how many tokens are kept if every document is cut there, and so on. The
histogram has a row per distinct length, not per document; its running sums are taken within blocks of
lengths first and over the blocks' totals after, so that no task sorts it whole.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from larder.llm.common import slices
from larder.session import stage

#: Lengths per block of running sums.
BLOCK = 1024

_encoders: dict[int, tiktoken.Encoding] = {}


def encoded_lengths(docs: DataFrame, path: str, pattern: str, text_col: str = "text") -> DataFrame:
    """``tokens`` of every row's whole text, by the byte-level vocabulary in a rank file; a null text has none."""
    with open(path, "rb") as file:
        ranks = docs.sparkSession.sparkContext.broadcast(file.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = hash((path, pattern))
        if key not in _encoders:
            table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.value.splitlines())}
            _encoders[key] = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=table, special_tokens={})
        encode = _encoders[key].encode_ordinary
        for batch in slices(batches, "text"):
            lengths = [len(encode(t)) if t else 0 for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_pydict({"tokens": pa.array(lengths, pa.int64())})

    return docs.select(F.col(text_col).alias("text")).mapInArrow(run, "tokens long")


def histogram(lengths: DataFrame) -> DataFrame:
    """``tokens, docs``: the number of documents per length."""
    return lengths.groupBy("tokens").agg(F.count(F.lit(1)).alias("docs"))


def limits(hist: DataFrame) -> DataFrame:
    """One row per length in the histogram, read as a context limit.

    ``docs``, ``docs_longer``, ``tokens_longer``: documents of this length, and the longer ones with their tokens.
    ``docs_within``, ``tokens_within``: those that fit. ``truncated_total``: tokens left if every document is cut at
    the limit. ``quantile``: share of documents that fit. An empty histogram gives no rows.
    """
    hist = stage(hist.withColumn("block", F.floor(F.col("tokens") / BLOCK)), "length-histogram")
    blocks = hist.groupBy("block").agg(F.sum("docs").alias("d"), F.sum(F.col("docs") * F.col("tokens")).alias("t"))
    later = Window.orderBy(F.col("block").desc()).rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select(
        "block", F.coalesce(F.sum("d").over(later), F.lit(0)).alias("block_docs"), F.coalesce(F.sum("t").over(later), F.lit(0)).alias("block_tokens")
    )
    all_docs, all_tokens = (F.lit(x or 0) for x in hist.agg(F.sum("docs"), F.sum(F.col("docs") * F.col("tokens"))).first())
    longer = Window.partitionBy("block").orderBy(F.col("tokens").desc()).rowsBetween(Window.unboundedPreceding, -1)
    found = hist.join(blocks, "block")
    docs = F.col("block_docs") + F.coalesce(F.sum("docs").over(longer), F.lit(0))
    tokens = F.col("block_tokens") + F.coalesce(F.sum(F.col("docs") * F.col("tokens")).over(longer), F.lit(0))
    found = found.withColumn("docs_longer", docs).withColumn("tokens_longer", tokens)
    within = all_docs - F.col("docs_longer")
    return found.select(
        "tokens",
        "docs",
        "docs_longer",
        "tokens_longer",
        within.alias("docs_within"),
        (all_tokens - F.col("tokens_longer")).alias("tokens_within"),
        (all_tokens - F.col("tokens_longer") + F.col("tokens") * F.col("docs_longer")).alias("truncated_total"),
        (within / all_docs).alias("quantile"),
    )


def at_limit(found: DataFrame, limit: int) -> DataFrame:
    """One row for any limit, also one that no document has: ``docs_longer, tokens_longer, truncated_total`` from the suffix sums."""
    longer = F.col("tokens") > limit
    docs, tokens = F.sum(F.when(longer, F.col("docs"))), F.sum(F.when(longer, F.col("docs") * F.col("tokens")))
    kept = F.sum(F.when(~longer, F.col("docs") * F.col("tokens")))
    zero = F.lit(0)
    return found.agg(
        F.coalesce(docs, zero).alias("docs_longer"),
        F.coalesce(tokens, zero).alias("tokens_longer"),
        (F.coalesce(kept, zero) + limit * F.coalesce(docs, zero)).alias("truncated_total"),
    )


def length_at(found: DataFrame, quantile: float) -> DataFrame:
    """The smallest length at which at least ``quantile`` of the documents fit."""
    return found.filter(F.col("quantile") >= quantile).agg(F.min("tokens").alias("tokens"))
