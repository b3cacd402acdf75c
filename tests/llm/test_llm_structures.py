"""Byte-level encoding, conversation trie and Merkle manifest against brute force."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from larder.llm import bytebpe, merkle, trie
from larder.llm.common import Memory

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
ODD = "doc_id long, text string, lang string, source string, n_chars long, leaf string, root string, at long, key string, ids string, n int"


def odd(spark, rows):
    """Documents with columns whose names the operators use themselves."""
    return spark.createDataFrame([(i, t, g, "s", None if t is None else len(t), "x", "y", 2, "z", "w", 5) for i, t, g in rows], ODD)


# byte-level encoding


@pytest.fixture(scope="module")
def model():
    with open(RANKS, "rb") as file:
        return bytebpe.ByteBpe(file.read())


@pytest.fixture(scope="module")
def reference(model):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=model.rank, special_tokens={})


def encode(model, texts):
    raw = [t.encode() for t in texts]
    ids, counts = model.encode(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)]))
    stops = np.cumsum(counts)
    return [ids[a:b].tolist() for a, b in zip([0, *stops], stops)]


def odd_texts(n: int = 3000):
    r = random.Random(7)
    parts = ["'", "s", "t", "re", "ve", "ll", "m", "d", "S", " ", "  ", "\n", "\t", " ", "a", "B", "é", "中", "1", "²", "!", ".", "—", "😀", "́", "'ll", "'re", "xyz" * 20, "\r\n", "\x85", "​", "\x1c", "　", "<|endoftext|>"]
    made = ["".join(r.choice(parts) for _ in range(r.randint(0, 30))) for _ in range(n)]
    return made + ["", "a" * 3000, "中" * 900, " " * 500, "'" * 200, "ab1" * 900, "'s's'll'x"]


def test_texts_are_cut_and_merged_as_the_library_does(model, reference):
    texts = odd_texts()
    assert encode(model, texts) == [reference.encode_ordinary(t) for t in texts]


def test_every_code_point_has_the_library_s_class():
    """A toy rank file tells which class the library gives: its only merges join a code point's last byte to a letter, digit or sign."""
    ranks = {bytes([k]): k for k in range(256)}
    for k in range(0x80, 0xC0):
        for sign in b"a1!":
            ranks[bytes([k, sign])] = len(ranks)
    toy = tiktoken.Encoding("toy", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    points = [k for k in range(0x80, 0x110000) if not 0xD800 <= k < 0xE000]
    table, kinds = bytebpe._class_table(), (bytebpe.LETTER, bytebpe.NUMBER, bytebpe.SIGN)
    joined = [[ids[-1] >= 256 for ids in toy.encode_ordinary_batch([chr(k) + sign for k in points], num_threads=4)] for sign in "a1!"]
    for k, *together in zip(points, *joined):
        want = next((kind for kind, yes in zip(kinds, together) if yes), bytebpe.INNER)
        assert table[k] == want, hex(k)


def test_scan_does_not_depend_on_how_it_is_cut(model):
    r = random.Random(3)
    step, _ = bytebpe._automaton()
    for n in (1, 2, 5, 17, 100, 1001):
        classes = np.array([r.randrange(2 * bytebpe.CLASSES) for _ in range(n)], np.uint8)
        state, want = bytebpe.OUT, []
        for c in classes.tolist():
            want.append(state)
            state = int(step[bytebpe.OUT if c >= bytebpe.CLASSES else state, c % bytebpe.CLASSES])
        assert bytebpe.MONOID.states_before(classes).tolist() == want


def test_rows_and_heap_merge_alike(model):
    r = random.Random(4)
    pieces = ["".join(r.choice("abcdeinorst ") for _ in range(r.randint(2, 32))).encode() for _ in range(200)]
    width = max(map(len, pieces))
    symbols = np.full((len(pieces), width), -1, np.int64)
    for k, p in enumerate(pieces):
        symbols[k, : len(p)] = model.single[list(p)]
    assert model.merge_rows(symbols) == [model.merge_long(p) for p in pieces]


def test_forgetting_changes_no_id(reference):
    with open(RANKS, "rb") as file:
        small = bytebpe.ByteBpe(file.read())
    small.memory = Memory(20)
    texts = odd_texts(200)
    for k in range(0, len(texts), 20):
        assert encode(small, texts[k : k + 20]) == [reference.encode_ordinary(t) for t in texts[k : k + 20]]


def test_encoded_documents(spark, reference):
    texts = [None, *odd_texts(60), "long text " * 30_000]
    rows = odd(spark, [(i, t, "en") for i, t in enumerate(texts)] + [(None, "it's", None), (5, texts[5], "en")])
    got = bytebpe.encoded(rows, RANKS).collect()
    assert len(got) == len(texts) + 2
    for r in got:
        text = "it's" if r["doc_id"] is None else texts[r["doc_id"]] or ""
        assert r["ids"] == reference.encode_ordinary(text) and bytes(r["decoded"]) == text.encode()
        lengths = [len(reference.decode_single_token_bytes(k)) for k in r["ids"]]
        assert r["offsets"] == [sum(lengths[:k]) for k in range(min(len(lengths), 500))] + r["offsets"][500:]
    assert bytebpe.encoded(rows.limit(0), RANKS).count() == 0


# conversation trie


def brute_trie(rows):
    """The nodes by walking every prefix of every rebuilt conversation."""
    by_conv = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            tid = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()
            by_conv.setdefault(conv, []).append((turn is not None, turn or 0, tid, role, text))
    own = {c: [t[3:] for t in sorted(turns)] for c, turns in by_conv.items()}
    rebuilt = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        rebuilt[c] = own.get(c - (abs(c) % 20 if c >= 0 else -(abs(c) % 20)), [])[:h] + turns[h:]
    members, ends = {}, {}
    for c, turns in rebuilt.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
        ends.setdefault(tuple(turns), []).append(c)
    children = {}
    for path in members:
        if path:
            children.setdefault(path[:-1], []).append(path)

    def worth(path):
        words = len(re.findall(r"[^\x20\x09-\x0D]+", path[-1][1])) if path else 0
        return (len(members[path]) - 1) * words

    below = {}
    for path in sorted(members, key=len, reverse=True):
        kids = children.get(path, [])
        leaves = sum(below[k][0] for k in kids) if kids else 1
        below[path] = (leaves, worth(path) + sum(below[k][1] for k in kids))
    out = []
    for path, convs in members.items():
        sha = hashlib.sha256(",".join(map(str, sorted(ends.get(path, [])))).encode()).hexdigest()
        parent = min(members[path[:-1]]) if path else None
        out.append((min(convs), len(path), parent, len(convs), len(children.get(path, [])), *below[path], sha))
    return sorted(out, key=str)


def trie_of(spark, rows):
    df = spark.createDataFrame([(*r, "k", 9) for r in rows], "conv_id long, turn long, role string, text string, key string, depth int")
    conv = F.col("conv_id")
    found = trie.prefix_trie(trie.with_shared_beginnings(trie.turns(df), conv - conv % 20, F.crc32(conv.cast("string").cast("binary")) % 4))
    return sorted(map(tuple, found.collect()), key=str)


def test_trie_matches_brute_force(spark):
    r = random.Random(2)
    texts = [None, "", "hello  there", "yes", "no\tthanks\n", "été à la mer"]
    rows = []
    for conv in [*range(0, 90, 3), -40, -23]:
        n = r.choice([1, 1, 2, 3, 5, 8, 9, 16, 17, 26])
        same = r.random() < 0.5
        for k in range(n):
            rows.append((conv, r.choice([k, k, None]) if conv == 3 else k, r.choice(["user", None]) if not same else "user", r.choice(texts) if not same else texts[k % 4]))
    rows += [(200 + k, 0, "user", "hello  there") for k in range(30)]  # many equal ones
    rows += [(300, k, "u", "w") for k in range(70)] + [(301, k, "u", "w") for k in range(70)]  # long ones that agree
    rows += [(7, 1, "u", "twice")] * 2 + [(None, 1, "u", "no conversation")]
    assert trie_of(spark, rows) == brute_trie(rows)


def test_pieces_of_a_crowded_end(spark, monkeypatch):
    monkeypatch.setattr(trie, "PIECE", 4)
    rows = [(20 * k, 0, "user", "same") for k in range(60)]
    assert trie_of(spark, rows) == brute_trie(rows)


def test_trie_of_nothing(spark):
    assert trie_of(spark, []) == [] and trie_of(spark, [(None, 1, "a", "b")]) == []


def test_ends_of_a_conversation_without_turns(spark):
    lone = next(c for c in range(1, 200) if c % 20 and zlib.crc32(str(c).encode()) % 4 > 0)
    assert trie_of(spark, [(lone, 1, "u", "gone")]) == brute_trie([(lone, 1, "u", "gone")])


# Merkle manifest


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def brute_tree(leaves):
    """Levels from the leaves up."""
    levels = [leaves]
    while len(levels[-1]) > 1:
        now = levels[-1]
        levels.append([H(*now[k : k + 8]) for k in range(0, len(now), 8)])
    return levels


def brute_way(levels, k):
    way = []
    for level in levels[:-1]:
        a = k // 8 * 8
        way.append(("".join(level[a:k]), "".join(level[k + 1 : a + 8])))
        k //= 8
    return way


def manifest_rows(rows):
    field = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    groups = {}
    for doc_id, text, lang in rows:
        leaf = H(field(doc_id), field(text))
        shown = H(field(doc_id), field(text.lower())) if text is not None else leaf
        groups.setdefault(lang, []).append((doc_id is None, doc_id or 0, leaf, doc_id, shown))
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: brute_tree([x[2] for x in sorted(groups[g])]) for g in order}
    top = brute_tree([trees[g][-1][0] for g in order])
    out = []
    for place, g in enumerate(order):
        for k, (_, _, leaf, doc_id, shown) in enumerate(sorted(groups[g])):
            way = brute_way(trees[g], k) + brute_way(top, place)
            node = shown
            for a, b in way:
                node = H(a, node, b)
            out.append((doc_id, leaf, trees[g][-1][0], top[-1][0], H(*(a + b for a, b in way)), node))
    return sorted(out, key=str)


def found_rows(spark, rows):
    docs = odd(spark, rows)
    leaf, shown = (merkle.digest(merkle.field(F.col("doc_id")), merkle.field(t)) for t in (F.col("text"), F.lower("text")))
    trees = merkle.Manifest(docs.select("doc_id", "lang", "root", "at", "n", leaf.alias("leaf"), shown.alias("shown")), F.col("lang"), ["doc_id"])
    top = merkle.Manifest(trees.roots.select("key", F.col("root").alias("leaf")), F.lit("all"), ["key"]).proofs()
    proofs = trees.proofs(top)
    lefts, rights = F.col("lefts"), F.col("rights")
    picked = proofs.select("doc_id", "leaf", "subroot", "root", merkle.siblings_digest(lefts, rights), merkle.folded(F.col("shown"), lefts, rights))
    return sorted(map(tuple, picked.collect()), key=str)


@pytest.mark.parametrize("height", [1, 4])
def test_manifest_matches_brute_force(spark, monkeypatch, height):
    monkeypatch.setattr(merkle, "BLOCK_LEVELS", height)
    r = random.Random(height)
    rows = [(r.randrange(5000), r.choice(["One", "two", "", None, "Ünï" * 40]), r.choice(["en"] * 6 + [None, "", "de", "fr"])) for _ in range(700)]
    rows += [(42, "Copy", "en")] * 90 + [(None, "no id", "en"), (None, None, None), (1, "x", "lone")]
    # Carried columns may have the names of results: those of the leaves give way.
    docs = manifest_rows(rows)
    assert found_rows(spark, rows) == docs


def test_manifest_of_nothing_and_of_one_leaf(spark):
    assert found_rows(spark, [(5, "Alone", "en")]) == manifest_rows([(5, "Alone", "en")])
    assert found_rows(spark, []) == []


def test_missing_nodes_are_the_least_that_is_needed():
    r = random.Random(1)
    for n in (1, 2, 8, 9, 64, 65, 700):
        for count in (1, 3, n):
            own = np.array(sorted(r.sample(range(n), min(count, n))))
            have = {(0, int(k)) for k in own}
            missing = {(level, int(k)) for level, nodes in merkle.missing_nodes(own, n) for k in nodes}
            assert not have & missing
            sizes, needed = merkle.level_sizes(n), set()
            now = set(own.tolist())
            for level, size in enumerate(sizes[:-1]):
                runs = {k // 8 for k in now}
                needed |= {(level, k) for run in runs for k in range(8 * run, min(8 * run + 8, size)) if k not in now}
                now = runs
            assert missing == needed
