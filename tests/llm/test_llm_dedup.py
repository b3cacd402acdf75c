"""Exact and near duplicates against brute force."""

from __future__ import annotations

import hashlib
import random
import re

import pyarrow as pa
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from larder.llm import exactdup, simhash
from larder.llm.components import components

ODD = "doc_id long, text string, lang string, source string, keep_id long, fp string, _row string, copies int"


def odd(spark, rows):
    """Documents with columns whose names operators use themselves."""
    return spark.createDataFrame([(*r[:2], "en", "s", 7, "x", "y", 1) for r in rows], ODD)


ROWS = [(1, "a"), (2, "b"), (3, "a"), (4, None), (5, ""), (None, "a"), (None, None), (6, "a" * 70_000), (7, "a" * 70_000), (7, "a" * 70_000), (8, "ab")]


@pytest.mark.parametrize("largest", [False, True])
def test_groups(spark, largest):
    groups: dict[str, list] = {}
    for i, t in ROWS:
        groups.setdefault(t or "", []).append(i)
    pick = max if largest else min
    found = exactdup.duplicates(odd(spark, ROWS), largest=largest).collect()
    assert len(found) == len(ROWS)
    for r in found:
        text = next(t for t in groups if hashlib.sha256(t.encode()).hexdigest() == r["text_sha256"])
        ids = [i for i in groups[text] if i is not None]
        assert r["keep_id"] == pick(ids)
        assert r["group_size"] == len(groups[text])
    kept = [r for r in found if r["kept"]]
    assert sorted(r["keep_id"] for r in kept) == sorted(pick(i for i in g if i is not None) for g in groups.values())
    assert all(r["doc_id"] == r["keep_id"] for r in kept)


def test_documents_keep_their_columns(spark):
    docs = odd(spark, ROWS)
    found = exactdup.distinct_documents(docs, largest=True)
    assert found.columns == docs.columns
    assert found.schema["doc_id"].dataType == docs.schema["doc_id"].dataType
    got = sorted((r["doc_id"], r["text"], r["keep_id"]) for r in found.collect())
    assert got == sorted([(3, "a", 7), (2, "b", 7), (5, "", 7), (7, "a" * 70_000, 7), (8, "ab", 7)])


def test_only_null_ids_and_empty_table(spark):
    found = exactdup.duplicates(odd(spark, [(None, "x"), (None, "x")])).collect()
    assert [r["keep_id"] for r in found] == [None, None] and sum(r["kept"] for r in found) == 1
    empty = odd(spark, ROWS).limit(0)
    assert exactdup.duplicates(empty).count() == 0
    assert exactdup.distinct_documents(empty).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.binary(max_size=6), st.integers(0, 5)), max_size=40), st.booleans())
def test_trie_holds_what_was_inserted(items, largest):
    trie, want = exactdup.Patricia(largest), {}
    for text, key in items:
        trie.insert(text, exactdup.Owner(key, 1, 1, ()))
        want.setdefault(text, []).append(key)
    pick = max if largest else min
    got = {text: (o.id, o.rows, o.top) for text, o in trie.spill()}
    assert got == {t: (pick(k), len(k), k.count(pick(k))) for t, k in want.items()}
    assert trie.bytes == 0 and not list(trie.spill())


def test_trie_spills_all_but_the_path():
    trie = exactdup.Patricia(True)
    for k, text in enumerate([b"car", b"cart", b"cat", b"dog", b"do"]):
        trie.insert(text, exactdup.Owner(k, 1, 1, ()))
    assert {t for t, _ in trie.spill(b"cart")} == {b"car", b"cat", b"dog", b"do"}
    assert {t for t, _ in trie.spill()} == {b"cart"}


def owned(found) -> set[tuple]:
    return {(r["text_sha256"], r["keep_id"], r["top_rows"], r["group_size"]) for r in found.collect()}


def test_small_memory_gives_the_same(spark):
    """Tries that may hold next to nothing spill all the time, on both sides of the shuffle."""
    docs = spark.createDataFrame([(i, f"text {i % 7} " * 50) for i in range(300)], "doc_id long, text string").repartition(3)
    want = {(k, len(range(k, 300, 7))) for k in range(7)}
    assert {(r["keep_id"], r["group_size"]) for r in exactdup.owners(docs).collect()} == want
    documents = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    for table in (docs, documents, odd(spark, ROWS)):
        plain, tight = (exactdup._owners(table, "doc_id", "text", True, [], False, resident=n) for n in (exactdup.RESIDENT_BYTES, 500))
        assert owned(plain) == owned(tight)


def test_one_trie_holds_a_partition_splits_edges_and_spills_subtrees(spark):
    """The texts of one partition of the given table, through the reducer: the trie branches, and complete subtrees leave before the end."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", F.encode(F.coalesce("text", F.lit("")), "UTF-8").alias("_text"))
    # How Spark deals rows to two partitions.
    dealt = F.pmod(F.hash(F.octet_length("_text"), F.xxhash64("_text")), F.lit(2))
    part = docs.filter(dealt == 0).toPandas().sort_values("_text")
    one = [1] * len(part)
    table = pa.table({"_text": pa.array(part["_text"], pa.binary()), "_id": pa.array(part["doc_id"], pa.int64()), "_top": one, "_rows": one})
    trie = exactdup.Patricia(True)
    for text in part["_text"]:
        trie.insert(bytes(text), exactdup.Owner(1, 1, 1, ()))
    assert trie.splits > 100 and max(len(n.children) for n in trie.root.children.values()) > 1
    assert trie.bytes < sum(len(t) for t in set(map(bytes, part["_text"])))
    whole = pa.Table.from_batches(exactdup._own([], True, False)(iter(table.to_batches())))
    small = list(exactdup._own([], True, False, resident=50_000)(iter(table.to_batches())))
    assert len(small) > 10 and pa.Table.from_batches(small).sort_by("text_sha256") == whole.sort_by("text_sha256")
    groups = part.groupby(part["_text"].map(lambda t: hashlib.sha256(t).hexdigest()))["doc_id"].agg(["max", "size"])
    got = whole.to_pandas().set_index("text_sha256")
    assert got["keep_id"].to_dict() == groups["max"].to_dict() and got["group_size"].to_dict() == groups["size"].to_dict()


def brute_print(text: str | None, words: int) -> int:
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    found = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not found:
        return 0
    shingles = [" ".join(found[i : i + words]) for i in range(len(found) - words + 1)] or [" ".join(found)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprints(spark):
    texts = [None, "", " \t", "One", "one TWO", "a b c d e f\na b c", "É x\x0bÜ z é", "w " * 5000, "the quick  brown\tfox jumps"]
    rows = odd(spark, list(enumerate(texts)))
    got = {r["doc_id"]: r["fp"] % (1 << 64) for r in simhash.fingerprints(rows, words=3).collect()}
    assert got == {i: brute_print(t, 3) for i, t in enumerate(texts)}


def flip(random_, value: int, bits: int) -> int:
    for b in random_.sample(range(64), bits):
        value ^= 1 << b
    return value


def signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


@pytest.mark.parametrize("hot", [0, 4, 64])
def test_links_close_to_the_same_components(spark, monkeypatch, hot):
    monkeypatch.setattr(simhash, "HOT_KEY", hot)
    r = random.Random(3)
    prints = {r.getrandbits(64) for _ in range(60)}
    for base in list(prints)[:20]:
        for _ in range(6):
            prints.add(flip(r, base, r.randint(1, 4)))
    prints = sorted(prints)
    parent = {p: p for p in prints}

    def top(p):
        while parent[p] != p:
            p = parent[p]
        return p

    for i, a in enumerate(prints):
        for b in prints[i + 1 :]:
            if (a ^ b).bit_count() <= 2:
                parent[top(a)] = top(b)
    want = {frozenset(signed(q) for q in prints if top(q) == top(p)) for p in prints}
    frame = spark.createDataFrame([(signed(p),) for p in prints], "fp long")
    labels = {x["node"]: x["label"] for x in components(simhash.links(frame)).collect()}
    groups: dict = {}
    for p in map(signed, prints):
        groups.setdefault(labels.get(p, p), set()).add(p)
    assert {frozenset(g) for g in groups.values()} == want
    assert all(min(g) == k for k, g in groups.items())


@pytest.mark.parametrize("segments", [3, 6, 8, 16])
def test_every_close_pair_has_a_chain(segments):
    r = random.Random(segments)
    for _ in range(500):
        differ = flip(r, 0, r.randint(0, 2))
        assert any(
            all((differ & mask).bit_count() <= budget for mask, budget in simhash.chain_masks(segments, 2, start)) for start in range(segments)
        )


def test_near_duplicates(spark):
    text = " ".join(f"w{i}" for i in range(400))
    rows = [(5, text), (3, text), (None, text), (9, text.replace("w7 ", "w7x ")), (1, "quite another text here"), (2, None), (4, ""), (4, "")]
    found = simhash.near_duplicates(odd(spark, rows), words=3).collect()
    assert len(found) == len(rows)
    prints = {i: brute_print(t, 3) for i, t in rows}
    near = (prints[9] ^ prints[5]).bit_count() <= 2
    want = {5: 3, 3: 3, None: 3, 9: 3 if near else 9, 1: 1, 2: 2, 4: 2}
    assert all(r["component_id"] == want[r["doc_id"]] for r in found)
    kept = simhash.distinct_documents(odd(spark, rows), words=3)
    assert kept.columns == odd(spark, rows).columns
    stay = [3, 1, 2] + ([] if near else [9])
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(stay)
    assert simhash.near_duplicates(odd(spark, rows).limit(0)).count() == 0


def test_components_of_a_path(spark):
    edges = spark.createDataFrame([(i + 1, i) for i in range(40)] + [(100, 101), (101, 100)], "a long, b long")
    labels = {r["node"]: r["label"] for r in components(edges).collect()}
    assert labels == {i: 0 for i in range(41)} | {100: 100, 101: 100}


def test_stage_keeps_one_row_of_each_group(spark):
    """Repeated ids with other texts, ids that are missing, rows alike in all, empty texts."""
    import corpus_pipeline

    text = " ".join(f"w{i}" for i in range(400))
    edited = text.replace("w7 ", "w7x ")
    near = (brute_print(text, 3) ^ brute_print(edited, 3)).bit_count() <= 2
    rows = [(5, text), (7, edited), (7, "other text with id seven"), (9, "short text here"), (9, "Short  text HERE"), (None, "short text here"), (3, ""), (4, None)]
    rows += [(8, "all of it again")] * 3 + [(None, "no id at all"), (None, "no id at all")]
    kept = corpus_pipeline.without_near_copies(spark, odd(spark, rows), "")
    assert kept.columns == odd(spark, rows).columns
    want = [(5, text), (7, "other text with id seven"), (3, ""), (8, "all of it again"), (None, "no id at all")] + ([] if near else [(7, edited)])
    got = [(r["doc_id"], r["text"]) for r in kept.collect()]
    nine = [r for r in got if r[0] == 9]
    assert len(nine) == 1 and sorted((r for r in got if r[0] != 9), key=str) == sorted(want, key=str)
    assert corpus_pipeline.without_near_copies(spark, odd(spark, rows).limit(0), "").count() == 0
