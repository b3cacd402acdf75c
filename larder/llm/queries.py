"""The operators as queries over whole test tables, and SQL where it can state them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.llm import bpe, bytebpe, exactdup, hmm, langid, lengths, merkle, mixing, quality, simhash, templates, toxicity, trie
from larder.llm.common import crc_mod, table

#: Ranks that lengths are counted with, and the pattern that splits a text before its merges (fixed values of the file).
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
RANK_PATTERN = public_tokenizers.PATTERN

#: Vocabulary of the encoder; another file of the same kind may take its place.
VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts and the verdict of the perplexity bands for every document."""
    found = quality.judged(table(spark, sf_dir, "documents"))
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    # The contract's bound in whole numbers.
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    bands = [f"{r}{c}" for r in quality.READINGS for c in ("log_ppl", "low", "high")]
    return found.select("doc_id", *counts, failed.alias("base_failed"), (F.col("kept") & ~failed).alias("kept"), *bands)


def op2_lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Histogram of token counts over all documents with its suffix sums."""
    found = lengths.encoded_lengths(table(spark, sf_dir, "documents"), RANKS, RANK_PATTERN)
    return lengths.limits(lengths.histogram(found))


def op3_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every text, learnt outside the held-out fifth."""
    docs = table(spark, sf_dir, "documents")
    found = langid.identified(docs, crc_mod(F.col("doc_id"), 5) != 0)
    return found.select("doc_id", (crc_mod(F.col("doc_id"), 5) == 0).alias("held_out"), "lang_pred", "score")


def op4_hmm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log probability of every text under the hidden Markov model and under a unigram model."""
    docs = table(spark, sf_dir, "documents")
    held_out = crc_mod(F.col("doc_id"), 7) == 2
    found = hmm.scored(docs, ~held_out)
    return found.withColumn("held_out", held_out)


def op5_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mix of all documents by source, weights 1, 2, 3 in turn."""
    found = mixing.mix(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "size", "source_size", "target", "taken")


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text as tokens and back, as digests."""
    found = bpe.encoded(table(spark, sf_dir, "documents"), VOCABULARY)
    return found.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of equal texts; the row with the largest id stays."""
    return exactdup.duplicates(table(spark, sf_dir, "documents"), largest=True)


OP7_SQL = """
SELECT doc_id,
       max(doc_id) OVER same AS keep_id,
       count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents
WINDOW same AS (PARTITION BY coalesce(text, ''))
"""


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose fingerprints differ in two bits or fewer."""
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), words=3, distance=2)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learnt from labels outside the held-out fifth."""
    docs = table(spark, sf_dir, "documents")
    net = toxicity.fit(docs, table(spark, sf_dir, "labels"), crc_mod(F.col("doc_id"), 5) != 0)
    found = toxicity.scored(docs.select("doc_id", "text", "lang"), net)
    return found.select(
        "row.doc_id",
        (crc_mod(F.col("row.doc_id"), 5) == 0).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
        "threshold",
    )


def op10_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    found = templates.extracted(table(spark, sf_dir, "pages"))
    return found.withColumn("n_chars", F.length("text").cast("long"))


def op11_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text as ranks and back, as digests."""
    found = bytebpe.encoded(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return found.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " ").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op12_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prefix trie of all conversations, each begun with up to three turns of the first of its twenty."""
    placed = trie.turns(table(spark, sf_dir, "conversations"))
    conv = F.col("conv_id")
    return trie.prefix_trie(trie.with_shared_beginnings(placed, conv - conv % 20, crc_mod(conv, 4)))


def _trie_sql() -> str:
    word = r"[^\x20\x09-\x0D]+"
    return f"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
d AS (SELECT *, sha256(octet_length(encode(role))::VARCHAR || ':' || role || text) AS tid FROM c),
t AS (SELECT conv_id, tid, len(regexp_extract_all(text, '{word}')) AS words,
        row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, tid) AS p FROM d),
ids AS (SELECT conv_id, conv_id - conv_id % 20 AS donor, {crc_sql('conv_id::VARCHAR')} % 4 AS h FROM (SELECT DISTINCT conv_id FROM c)),
rebuilt AS (SELECT ids.conv_id, 0 AS part, p, tid, words FROM ids JOIN t ON t.conv_id = donor AND p <= h
  UNION ALL SELECT ids.conv_id, 1, p, tid, words FROM ids JOIN t ON t.conv_id = ids.conv_id AND p > h),
paths AS (SELECT conv_id, row_number() OVER w AS depth, string_agg('/' || tid, '') OVER w AS path, words FROM rebuilt WINDOW w AS (PARTITION BY conv_id ORDER BY part, p)
  UNION ALL SELECT conv_id, 0, '', 0 FROM ids),
nodes AS (SELECT path, depth, min(conv_id) AS conv_id, count(*) AS n_convs, max(words) AS words, CASE WHEN depth > 0 THEN left(path, length(path) - 65) END AS up FROM paths GROUP BY path, depth),
ends AS (SELECT path, string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) AS ids
  FROM (SELECT conv_id, path FROM paths QUALIFY depth = max(depth) OVER (PARTITION BY conv_id)) GROUP BY path),
kids AS (SELECT up, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY up),
family AS (SELECT nodes.*, coalesce(kids.n, 0) AS n_children FROM nodes LEFT JOIN kids ON kids.up = nodes.path),
above AS (SELECT f.path, f.n_children, (f.n_convs - 1) * f.words AS worth, UNNEST(generate_series(0, f.depth)) AS k FROM family f),
sums AS (SELECT left(path, (65 * k)::INT) AS path, sum((n_children = 0)::INT) AS n_leaves, sum(worth) AS saved FROM above GROUP BY 1)
SELECT f.conv_id, f.depth, parent.conv_id AS parent_conv_id, f.n_convs, f.n_children, n_leaves::BIGINT AS n_leaves, saved::BIGINT AS saved_tokens,
  sha256(coalesce(ends.ids, '')) AS ends_sha256
FROM family f JOIN sums USING (path) LEFT JOIN ends USING (path) LEFT JOIN nodes parent ON parent.path = f.up
"""


#: A-Z, and what they become.
CAPITALS, SMALL_LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A Merkle tree per language and one over these, with every document's proof checked against a tampered third."""
    docs = table(spark, sf_dir, "documents")
    lowered = F.translate("text", CAPITALS, SMALL_LETTERS)
    given, tampered = (
        merkle.digest(*(merkle.field(c) for c in (F.col("doc_id"), F.col("source"), F.col("lang"), F.col("n_chars"), text)))
        for text in (F.col("text"), lowered)
    )
    shown = F.when(crc_mod(F.col("doc_id"), 3) == 0, tampered)
    trees = merkle.Manifest(docs.select("doc_id", "lang", given.alias("leaf"), shown.alias("shown")), F.col("lang"), ["doc_id"])
    subroots = trees.roots.select("key", F.col("root").alias("leaf"))
    found = trees.proofs(merkle.Manifest(subroots, F.lit("all"), ["key"]).proofs())
    folded = merkle.folded(F.coalesce("shown", "leaf"), F.col("lefts"), F.col("rights"))
    found = found.withColumn("folded_root", folded)
    return found.select(
        "doc_id",
        "leaf",
        "subroot",
        "root",
        merkle.siblings_digest(F.col("lefts"), F.col("rights")).alias("proof_sha256"),
        "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )


def crc_sql(text: str) -> str:
    """CRC-32 (reflected, polynomial EDB88320) of an ASCII text."""
    step = "list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)"
    codes = f"list_transform(string_split({text}, ''), lambda d: ascii(d)::BIGINT)"
    return f"(CASE WHEN {text} = '' THEN 0 ELSE xor(list_reduce(list_prepend(4294967295::BIGINT, {codes}), lambda c, b: {step}), 4294967295) END)"


def _merkle_sql(levels: int = 7, top_levels: int = 3) -> str:
    """The trees level by level; the number of levels bounds a language at 8 ** levels documents."""

    def field(value: str) -> str:
        return f"coalesce(octet_length(encode(({value})::VARCHAR))::VARCHAR || ':' || ({value})::VARCHAR, '-')"

    def leaf(text: str) -> str:
        return "sha256(" + " || ".join(map(field, ("doc_id", "source", "lang", "n_chars", text))) + ")"

    run = "PARTITION BY key, i // 8 ORDER BY i ROWS BETWEEN"

    def tree(name: str, first: str, depth: int) -> list[str]:
        made = [f"{name}0 AS ({first})"]
        for k in range(depth):
            made.append(
                f"{name}{k + 1} AS (SELECT key, i // 8 AS i, (any_value(n) + 7) // 8 AS n, sha256(string_agg(h, '' ORDER BY i)) AS h "
                f"FROM {name}{k} WHERE n > 1 GROUP BY key, i // 8)"
            )
        for k in range(depth):
            left, right = (
                f"coalesce(string_agg(h, '') OVER ({run} {rows}), '')"
                for rows in ("UNBOUNDED PRECEDING AND 1 PRECEDING", "1 FOLLOWING AND UNBOUNDED FOLLOWING")
            )
            made.append(f"{name}s{k} AS (SELECT key, i, {left} AS a, {right} AS b FROM {name}{k} WHERE n > 1)")
        ends = " UNION ALL ".join(f"SELECT key, h FROM {name}{k} WHERE n = 1" for k in range(depth + 1))
        return [*made, f"{name}_root AS ({ends})"]

    def climb(rows: str, name: str, depth: int, key: str, place: str) -> str:
        for k in range(depth):
            rows = (
                f"SELECT r.* EXCLUDE (proof, f), proof || coalesce(s.a || s.b, '') AS proof, CASE WHEN s.a IS NULL THEN f ELSE sha256(s.a || f || s.b) END AS f "
                f"FROM ({rows}) r LEFT JOIN {name}s{k} s ON s.key = r.{key} AND s.i = r.{place} // {8**k}"
            )
        return rows

    lowered = f"translate(text, '{CAPITALS}', '{SMALL_LETTERS}')"
    crc = crc_sql("coalesce(doc_id::VARCHAR, '')")
    parts = [
        f"d AS (SELECT doc_id, coalesce('=' || lang, '') AS key, {leaf('text')} AS leaf, CASE WHEN {crc} % 3 = 0 THEN {leaf(lowered)} ELSE {leaf('text')} END AS shown FROM documents)",
        "placed AS (SELECT *, row_number() OVER (PARTITION BY key ORDER BY doc_id, leaf) - 1 AS i, count(*) OVER (PARTITION BY key) AS n FROM d)",
        *tree("l", "SELECT key, i, n, leaf AS h FROM placed", levels),
        "subs AS (SELECT key, h, row_number() OVER (ORDER BY key) - 1 AS place FROM l_root)",
        *tree("t", "SELECT 'all' AS key, place AS i, (SELECT count(*) FROM subs) AS n, h FROM subs", top_levels),
        f"way AS ({climb('SELECT *, shown AS f, chr(32) AS proof FROM placed', 'l', levels, 'key', 'i')})",
        "whole AS (SELECT way.*, subs.h AS subroot, subs.place, 'all' AS top FROM way JOIN subs USING (key))",
        f"done AS ({climb('SELECT * FROM whole', 't', top_levels, 'top', 'place')})",
    ]
    return (
        "WITH " + ", ".join(parts) + " SELECT doc_id, leaf, subroot, root.h AS root, sha256(proof[2:]) AS proof_sha256, f AS folded_root, f = root.h AS verified "
        "FROM done CROSS JOIN t_root root"
    )


QUERIES = {
    "op1_quality": op1_quality,
    "op2_lengths": op2_lengths,
    "op3_langid": op3_langid,
    "op4_hmm": op4_hmm,
    "op5_mix_sources": op5_mix_sources,
    "op6_bpe": op6_bpe,
    "op7_exact_dedup": op7_exact_dedup,
    "op8_simhash": op8_simhash,
    "op9_toxicity": op9_toxicity,
    "op10_templates": op10_templates,
    "op11_byte_bpe": op11_byte_bpe,
    "op12_trie": op12_trie,
    "op13_merkle": op13_merkle,
}

SQL = {
    "op7_exact_dedup": OP7_SQL,
    "op12_trie": _trie_sql(),
    "op13_merkle": _merkle_sql(),
}
