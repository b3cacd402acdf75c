"""Encoding, mixing, page text and length histogram, and the pipeline as a whole."""

from __future__ import annotations

import collections
import hashlib
import itertools
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from larder.llm import bpe, lengths, mixing, templates
from larder.llm.common import Memory
from larder.llm.queries import QUERIES, RANK_PATTERN, RANKS, SQL, VOCABULARY

SF = "/root/testdata/sf0.001"
ODD = "doc_id long, text string, lang string, source string, copies int, _size string, target string, _row int, ids string, _id int"


def odd(spark, rows):
    """Documents with columns whose names operators use themselves."""
    return spark.createDataFrame([(i, t, "en", s, 1, "x", "y", 2, "z", 3) for i, t, s in rows], ODD)


# encoding


@pytest.fixture(scope="module")
def model():
    return bpe.Bpe(open(VOCABULARY, encoding="utf-8").read())


@pytest.fixture(scope="module")
def reference():
    return Tokenizer.from_file(VOCABULARY)


def samples():
    r = random.Random(5)
    pool = [chr(c) for c in [*range(0x250), *range(0x300, 0x330), 0x1680, *range(0x2000, 0x2030), 0x3000, 0x130, 0x3A3, 0x4E00, 0x1F600, 0x660, 0x2160]]
    texts = ["", "it's <|endoftext|>x<|startoftext|> ΑΣ", "z" * 3000, "ab" * 70, "a\x85b\x1cc", "I'LL we've", "é é"]
    return texts + ["".join(r.choice(pool) for _ in range(r.randint(1, 80))) for _ in range(400)]


def test_tokens_are_the_librarys(model, reference):
    for text in samples():
        ids = reference.encode(text, add_special_tokens=False).ids
        assert model.encode(text) == ids
        assert model.decode(ids) == reference.decode(ids, skip_special_tokens=False)


def brute_merges(model, symbols: list[int]) -> list[int]:
    ranks = model.rank_of
    while True:
        pairs = [(ranks.get(a * model.size + b), k) for k, (a, b) in enumerate(zip(symbols, symbols[1:]))]
        pairs = [p for p in pairs if p[0] is not None]
        if not pairs:
            return symbols
        rank, k = min(pairs)
        symbols = symbols[:k] + [int(model.merged[rank])] + symbols[k + 2 :]


def test_both_trees_take_the_leftmost_lowest_rank(model):
    r = random.Random(9)
    words = ["".join(r.choice("aeinorst") for _ in range(r.randint(1, 64))).encode() for _ in range(300)]
    many = model.encode_pieces(words)
    for word, got in zip(words, many):
        symbols = [*model.inner[list(word[:-1])].tolist(), int(model.last[word[-1]])]
        assert got == brute_merges(model, list(symbols)) == model.encode_long(list(symbols))


def test_encoded_documents(spark, reference):
    texts = [None, *samples()[:60], "long text " * 30_000]
    rows = odd(spark, [(i, t, "s") for i, t in enumerate(texts)] + [(None, "x", None)])
    got = bpe.encoded(rows, VOCABULARY, packed=False).collect()
    assert len(got) == len(texts) + 1
    for r in got:
        text = (texts[r["doc_id"]] or "") if r["doc_id"] is not None else "x"
        ids = reference.encode(text, add_special_tokens=False).ids
        assert r["ids"] == ids and r["decoded"] == reference.decode(ids, skip_special_tokens=False)
    assert bpe.encoded(rows.limit(0), VOCABULARY).count() == 0


def test_memory_keeps_what_is_common(reference):
    model = bpe.Bpe(open(VOCABULARY, encoding="utf-8").read())
    model.memory = Memory(4)
    words = [b"hello", b"world", b"again", b"there", b"12ab,", b"x" * 90]
    for batch in (words[:2], words[:2], words[2:], [b"hello", b"other"], words):
        ids, each = model.encode_words(np.arange(len(batch)), batch)
        stops = np.cumsum(each)
        for word, a, b in zip(batch, [0, *stops], stops):
            assert ids[a:b].tolist() == reference.encode(word.decode(), add_special_tokens=False).ids
    # Long words are not kept; of the others the commonest half stays when the limit is passed.
    assert b"x" * 90 not in model.memory.place and {b"hello", b"world"} <= set(model.memory.place)
    assert len(model.memory.place) <= 4 + len(words)


# mixing


def test_shares_stop_at_the_cap():
    shares = mixing.capped_shares({"a": 10, "b": 100, "c": 1000}, {"a": 1, "b": 2, "c": 3}, 1110, 3)
    assert shares == {"a": 30, "b": 300, "c": 780}
    assert mixing.capped_shares({}, {}, 0, 3) == {}
    assert mixing.capped_shares({"a": 0}, {"a": 1}, 0, 3) == {"a": 0}


def brute_cost(patterns, quotas, repeats):
    """Most words, then least cost, over all whole flows of a tiny network."""
    pairs = [(p, s) for p in patterns for s in p]
    best = None
    for flow in itertools.product(*(range(min(quotas[s], patterns[p] * repeats) + 1) for p, s in pairs)):
        sent, got = collections.Counter(), collections.Counter()
        for (p, s), f in zip(pairs, flow):
            sent[s] += f
            got[p] += f
        if any(sent[s] > quotas[s] for s in quotas) or any(got[p] > repeats * patterns[p] for p in patterns):
            continue
        cost = sum(max(0, min(got[p], (k + 1) * patterns[p]) - k * patterns[p]) * k for p in patterns for k in range(repeats))
        best = min(best or (1, 1), (-sum(flow), cost)) if best else (-sum(flow), cost)
    return best


@pytest.mark.parametrize("seed", range(6))
def test_flow_is_the_cheapest(seed):
    r = random.Random(seed)
    quotas = {s: r.randint(0, 4) for s in "ab"}
    patterns = {p: r.randint(1, 2) for p in [("a",), ("b",), ("a", "b")] if r.random() < 0.8} or {("a", "b"): 1}
    given = mixing.route(patterns, quotas, 3)
    cost = sum(max(0, min(given[p], (k + 1) * n) - k * n) * k for p, n in patterns.items() for k in range(3))
    assert (-sum(given.values()), cost) == brute_cost(patterns, quotas, 3)


def mixed_rows():
    r = random.Random(2)
    rows = [(i, " ".join(["w"] * r.randint(1, 40)), r.choice(["a", "a", "a", "b", "c", None])) for i in range(600)]
    return rows + [(600, None, "a"), (601, "", "b"), (None, "x y z", "c"), (5, rows[5][1], rows[5][2]), (602, "w " * 3, "a")]


def test_mix(spark):
    rows = mixed_rows()
    docs = odd(spark, rows)
    got = mixing.mix(docs).collect()
    assert len(got) == len(rows)
    sizes = collections.Counter()
    for _, t, s in rows:
        sizes[s] += len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    order = ["a", "b", "c", None]
    targets = mixing.capped_shares(sizes, dict(zip(order, (1, 2, 3, 1))), sum(sizes.values()), 3)
    taken = collections.Counter()
    for r in got:
        source = r["members"][0]
        assert r["source_size"] == sizes[source] and abs(r["target"] - targets[source]) < 1e-6
        assert r["taken"] == r["size"] * r["copies"] and 0 <= r["copies"] <= 3
        taken[source] += r["taken"]
    assert all(abs(taken[s] - targets[s]) <= 3 for s in order)
    again = mixing.mix(docs.repartition(7)).collect()
    assert sorted(map(str, again)) == sorted(map(str, got))
    whole = mixing.mixed_documents(docs)
    assert whole.columns == docs.columns
    assert whole.count() == sum(r["copies"] for r in got)
    assert mixing.mix(docs.limit(0)).count() == 0 and mixing.mixed_documents(docs.limit(0)).count() == 0


def test_documents_in_several_sources(spark):
    rows = spark.createDataFrame([(i, "w " * 10 if x else None, x) for i, x in enumerate([["a"]] * 50 + [["a", "b"]] * 50 + [["b"]] * 10 + [None])], "doc_id long, text string, tags array<string>")
    got = mixing.mix(rows, F.col("tags"), weights=lambda order: dict.fromkeys(order, 1)).collect()
    taken = collections.Counter()
    for r in got:
        taken[tuple(r["members"])] += r["taken"]
    # 1100 words, 550 for each source: all of them once, which needs no repeats.
    assert taken == {("a",): 500, ("a", "b"): 500, ("b",): 100, (): 0}
    with pytest.raises(ValueError):
        mixing.mix(rows, F.col("tags"), max_patterns=2)


def test_large_buckets(spark, monkeypatch):
    monkeypatch.setattr(mixing, "CUT_DOCS", 10)
    got = mixing.mix(odd(spark, mixed_rows())).groupBy("members").agg(F.sum("taken").alias("t"), F.first("target").alias("x")).collect()
    assert all(abs(r["t"] - r["x"]) <= 40 for r in got)


# pages


def test_page_text():
    page = """<!DOCTYPE html><head><title>t</title><style>p{}</style></head><body class="home"><header><h1>Site</h1></header>
    <nav><ul><li>a<li>b</ul></nav><div class="cookie-notice">We use cookies</div><div id="sidebar"><p>side</div>
    <article class="post"><header><h1>Ti&amp;tle</h1></header><script>var a="<p>no</p>";</script><p>One <b>two<br>three&nbsp;&lt;x&gt;
    <p>a < b &copy; <a href="x>y">link</a><!-- <p>hidden</p> --><ul><li>i<li>j</ul><div class="share-buttons">Share!</div>
    <table><tr><td>1<td>2<tr><td>3</table><form><p>Your name<input></form><div class="advert">Buy</div></article>
    <section class="comments"><h2>Comments</h2><article class="comment"><p>First!</article></section><aside>x</aside><footer>&copy; y</footer>"""
    assert templates.main_text(page) == "Ti&tle\nOne two three <x>\na < b © link\ni\nj\n1 2\n3"


@pytest.mark.parametrize("page", ["", "plain text", "<p>plain text", "<div>plain <span>text</span></div>", "<body><p>plain text</p></body>", "<p>plain text<a href='x"])
def test_pages_without_structure(page):
    assert templates.main_text(page) == ("plain text" if page else "")


def test_deep_and_broken_pages():
    assert templates.main_text("<div>" * 300 + "x" + "</div>" * 10) == "x"
    # No recursion, and no search down the stack.
    assert templates.main_text("<div>" * 100_000 + "x" + "</div>" * 10) == "x"
    assert templates.main_text("<p>a<b>" + "<div><i>" * 50_000 + "x" + "</i></div>" * 50_000 + "y") == "a\nx\ny"
    assert templates.main_text("<article>" * 50_000 + "x") == "x"
    assert templates.main_text("</p></div><table><tr><td>x</div></td></table></b>") == "x"
    assert templates.main_text('<p class="a>b" d=c>x</p><p>y') == "x\ny"


def site(k: int, body: str, url: str = "https://a.example/{}") -> tuple:
    return (k, url.format(k), f"<body><div><span>Welcome</span> to our site</div><div><p>{body}</p></div><div>All rights</div></body>", "x", 1)


def test_recurring_subtrees_go(spark):
    rows = [site(k, f"Story number {k} with its own words") for k in range(30)]
    rows += [site(100 + k, "The same page many times", "https://a.example/copy") for k in range(40)]
    rows += [site(200 + k, f"Small {k}", "http://b.example/{}") for k in range(3)]
    rows += [(300, None, None, "x", 1), (301, "nonsense", "", "x", 1), (None, None, "<p>z", "x", 1)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, host string, hash int")
    got = {(r["page_id"], r["url"]): r["text"] for r in templates.extracted(pages).collect()}
    assert len(got) == len(rows)
    for k in range(30):
        assert got[k, f"https://a.example/{k}"] == f"Story number {k} with its own words"
        assert got[100 + k, "https://a.example/copy"] == "The same page many times"
    # Three pages are no proof of a template.
    assert got[200, "http://b.example/200"] == "Welcome to our site\nSmall 0\nAll rights"
    assert got[300, None] == got[301, "nonsense"] == "" and got[None, None] == "z"
    assert templates.extracted(pages.limit(0)).count() == 0


def html_of(node) -> str:
    """A page part: a text, or a list whose members lie in one element each."""
    return node if isinstance(node, str) else "".join(f"<div>{html_of(n)}</div>" for n in node)


def subtrees_of(node):
    """All members of a page part, the members' members as well."""
    for n in () if isinstance(node, str) else node:
        yield n
        yield from subtrees_of(n)


def made_pages():
    """Sites of plain ``div`` elements. Part of the blocks belong to a host or section, part recur too seldom; some pages are there twice."""
    r = random.Random(4)
    rows = []
    for host, n in (("tiny.example", 3), ("small.example", 12), ("large.example", 150)):
        for k in range(n):
            section = f"s{k % 3}"
            parts: list = [[f"Welcome to {host}", ["About", "Terms"]], f"Section {section} of {host}"]
            if r.random() < 0.2:
                parts.append(["Read also", f"Offer {r.randrange(4)} of {host}"])
            parts.append([f"Story {host} {k} " + "word " * 60, f"More {k}"])
            if r.random() < 0.5:
                parts[-1].append(f"Quote {r.randrange(30)}")
            parts.append(f"Rights of {host}")
            rows += [(host, section, parts)] * (2 if k % 5 == 0 else 1)
    return rows


@pytest.mark.parametrize("broadcast", [templates.MOST_BROADCAST, 0])
def test_templates_alone_against_brute_force(spark, monkeypatch, broadcast):
    """Without a word from tags or classes: what goes is what counting subtrees page by page says."""
    monkeypatch.setattr(templates, "MOST_BROADCAST", broadcast)
    rows = made_pages()
    seen = collections.defaultdict(set)
    pages_of = collections.defaultdict(set)
    for host, section, parts in rows:
        for scope in ((host, None), (host, section)):
            pages_of[scope].add(html_of(parts))
            for n in subtrees_of(parts):
                seen[scope, html_of(n)].add(html_of(parts))

    def text(host, section, node) -> list[str]:
        if isinstance(node, str):
            return [" ".join(node.split())]
        keep = []
        for n in node:
            counts = [(len(seen[s, html_of(n)]), len(pages_of[s])) for s in ((host, None), (host, section))]
            if not any(c >= templates.LEAST_PAGES and c * c >= of for c, of in counts):
                keep += text(host, section, n)
        return keep

    frame = spark.createDataFrame(
        [(k, f"https://{host}/{section}/{k}", html_of(parts)) for k, (host, section, parts) in enumerate(rows)], "page_id long, url string, html string"
    )
    want = {k: "\n".join(text(*row)) for k, row in enumerate(rows)}
    got = {r["page_id"]: r["text"] for r in templates.extracted(frame, declared=False).collect()}
    assert got == want
    # The sites come out clean: no word of their frames where there are pages enough to tell.
    assert not any("Rights" in want[k] or "Welcome" in want[k] or "Section" in want[k] for k, row in enumerate(rows) if row[0] != "tiny.example")
    assert sum("Quote" in t for t in want.values()) > 40 and all("Story" in t for t in want.values())


def test_quoted_paragraphs_stay(spark):
    rows = [(k, f"https://a.example/{k}", f"<body><div>menu of all</div><article><p>Everyone quotes this.</p><p>Own {k}</p><div>Read on</div></article>") for k in range(30)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert {r["text"] for r in templates.extracted(pages).collect()} == {f"Everyone quotes this.\nOwn {k}" for k in range(30)}


def test_small_hosts_take_the_join(spark, monkeypatch):
    monkeypatch.setattr(templates, "MOST_BROADCAST", 0)
    rows = [site(k, f"Story number {k} with its own words") for k in range(30)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, host string, hash int")
    assert {r["text"] for r in templates.extracted(pages).collect()} == {f"Story number {k} with its own words" for k in range(30)}


# lengths


def test_limits(spark, monkeypatch):
    monkeypatch.setattr(lengths, "BLOCK", 8)
    r = random.Random(1)
    values = [int(r.paretovariate(0.7)) for _ in range(400)] + [0, 0, 100_000]
    found = lengths.limits(lengths.histogram(spark.createDataFrame([(v,) for v in values], "tokens long")))
    rows = found.collect()
    assert sorted(x["tokens"] for x in rows) == sorted(set(values))
    for x in rows:
        limit = x["tokens"]
        longer = [v for v in values if v > limit]
        assert (x["docs"], x["docs_longer"], x["tokens_longer"]) == (values.count(limit), len(longer), sum(longer))
        assert x["docs_within"] == len(values) - len(longer) and x["tokens_within"] == sum(values) - sum(longer)
        assert x["truncated_total"] == sum(min(v, limit) for v in values)
        assert abs(x["quantile"] - (len(values) - len(longer)) / len(values)) < 1e-12
    for limit in (0, 7, 1234, 10**6):
        x = lengths.at_limit(found, limit).first()
        assert x["truncated_total"] == sum(min(v, limit) for v in values) and x["docs_longer"] == sum(v > limit for v in values)
    assert lengths.length_at(found, 0.5).first()[0] == sorted(values)[(len(values) - 1) // 2]


def test_encoded_lengths(spark):
    texts = [None, "", "Hello world", "a " * 20_000, "é ß 漢字 <|endoftext|>", "Hello world"]
    reference = Tokenizer.from_file(RANKS.replace(".tiktoken", ".json"))
    reference.encode_special_tokens = True
    got = lengths.encoded_lengths(odd(spark, [(i, t, "s") for i, t in enumerate(texts)]), RANKS, RANK_PATTERN).collect()
    assert sorted(r[0] for r in got) == sorted(len(reference.encode(t or "", add_special_tokens=False).ids) for t in texts)
    assert lengths.limits(lengths.histogram(odd(spark, []).select(F.lit(1).alias("tokens")))).count() == 0


# all together


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names = docs.columns
    for name, step in corpus_pipeline.STAGES[:-1]:
        before, docs = docs.count(), step(spark, docs, SF).cache()
        assert docs.columns == names and docs.count() <= 3 * before
        if "dedup" in name:
            assert docs.select("text").distinct().count() == docs.count()
    found = corpus_pipeline.run(spark, SF)
    assert found.count() == docs.count()
    assert {r["doc_id"] for r in found.select("doc_id").collect()} == {r["doc_id"] for r in docs.select("doc_id").collect()}


def test_stages_take_empty_tables(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, step in corpus_pipeline.STAGES:
        assert step(spark, docs, SF).count() == 0


@pytest.mark.parametrize("name", list(SQL))
def test_sql(spark, name):
    from compare import compare, duck

    from larder.catalog.entry import Entry

    assert compare(spark, duck(SF), name, Entry(name, QUERIES[name], SQL[name]), SF) is None


def test_digests(spark):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    reference = Tokenizer.from_file(VOCABULARY)
    for r in QUERIES["op6_bpe"](spark, SF).collect():
        ids = reference.encode(docs[r["doc_id"]] or "", add_special_tokens=False).ids
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(reference.decode(ids, skip_special_tokens=False).encode()).hexdigest()
