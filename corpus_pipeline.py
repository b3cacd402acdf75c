"""From raw documents to training tokens: toxicity, exact and near duplicates, source mix, encoding.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; :func:`run` writes it as Parquet
and reads it back as the next stage's input, so a lost executor costs one stage at most. All stages
but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.llm import bpe, exactdup, mixing, simhash, toxicity
from larder.llm.common import modest_batches, table
from larder.llm.queries import VOCABULARY
from larder.session import staged_files_removed, work_path


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents below the toxicity threshold of their language, learnt from all labels."""
    net = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.clean_documents(docs, net)


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the row with the largest id."""
    modest_batches(spark)
    return exactdup.distinct_documents(docs, largest=True)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of texts whose SimHash of 3-word shingles differs in two bits or fewer, the document with the smallest id."""
    modest_batches(spark)
    return simhash.distinct_documents(docs, words=3, distance=2)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at their target weights; a document may be repeated, or left out by the seeded choice."""
    modest_batches(spark)
    return mixing.mixed_documents(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, and a digest of what they decode to."""
    modest_batches(spark)
    found = bpe.encoded(docs, VOCABULARY, packed=False)
    return found.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256")
    )


STAGES = [
    ("toxicity", without_toxic),
    ("exact dedup", without_copies),
    ("SimHash near-dedup", without_near_copies),
    ("source mix", mixed),
    ("bpe", tokens),
]

#: SQL has no word for the first, third and last stage.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``. What a stage put aside for itself is removed once it is written."""
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES:
        target = work_path(spark, "pipeline-" + name.replace(" ", "-"))
        with staged_files_removed(spark):
            step(spark, docs, sf_dir).write.parquet(target)
        docs = spark.read.parquet(target)
    return docs
