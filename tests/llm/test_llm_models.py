"""Learnt operators: brute force where there is one, otherwise identities and held-out accuracy."""

from __future__ import annotations

import collections
import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from larder.llm import hmm, langid, quality, toxicity

SF = "/root/testdata/sf0.01"
ODD = "doc_id long, text string, lang string, source string, score double, row int, ids string, h int"


def odd(spark, rows):
    """Documents with columns whose names operators use themselves."""
    return spark.createDataFrame([(*r, "s", 0.5, 1, "x", 2) for r in rows], ODD)


# quality


def brute_counts(text: str) -> tuple[int, int, int, int, int]:
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = collections.defaultdict(list)
    for k in range(len(words) - 7):
        windows[tuple(words[k : k + 8])].append(k)
    inside = {k + j for ks in windows.values() if len(ks) > 1 for k in ks for j in range(8)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(inside)


def test_base_counts(spark):
    r = random.Random(4)
    texts = [None, "", " \n ", "a", "# é|<> a\nb\n# é|<> a\n\n", "a b c d e f g h a b c d e f g h", "x " * 3000]
    texts += ["".join(r.choice(["a ", "b ", "é\t", "c\n", "| ", "a\x0b"]) for _ in range(r.randint(1, 120))) for _ in range(150)]
    rows = odd(spark, [(i, t, None if i % 3 else "en") for i, t in enumerate(texts)])
    got = quality.judged(rows).collect()
    assert len(got) == len(texts)
    for x in got:
        n, chars, symbols, lines, repeats = brute_counts(texts[x["doc_id"]] or "")
        assert (x["n_words"], x["word_chars"], x["n_symbols"], x["n_dup_lines"], x["n_repeat_words"]) == (n, chars, symbols, lines, repeats)
        assert x["base_failed"] == (n < 20 or 10 * repeats > 3 * n)
        assert not (x["kept"] and x["base_failed"])
    assert quality.judged(rows.limit(0)).count() == 0


def test_probabilities_sum_to_one(spark):
    docs = spark.createDataFrame([(1, "the cat sat on the mat, the cat ran", "en"), (2, "a cat in a hat", "en"), (3, "le chat", "fr")], "doc_id long, text string, lang string")
    found = quality.models(quality.gram_counts(docs, "text", "lang"))
    assert set(found) == {"en", "fr"}
    rng = np.random.default_rng(1)
    for model in found.values():
        contexts = rng.integers(0, quality.CLASSES ** (quality.ORDER - 1), 50)
        seen = quality.grams(np.frombuffer(b"the cat in le ch", np.uint8), np.array([0, 16]))[0] // quality.CLASSES
        for context in [*contexts.tolist(), *seen.tolist()]:
            codes = context * quality.CLASSES + np.arange(quality.CLASSES)
            assert abs(np.exp(model.log_probabilities(codes)).sum() - 1) < 1e-4


def test_hash_array_finds_what_it_has():
    keys = np.unique(np.random.default_rng(2).integers(0, 1 << 40, 5000))
    held = quality.HashArray.build(keys[::2], np.arange(len(keys[::2])))
    value, there = held.find(keys)
    assert there[::2].all() and not there[1::2].any()
    assert (value[::2] == np.arange(len(keys[::2]))).all()


def test_junk_leaves_and_prose_stays(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "quality")
    rows = quality.judged(docs).join(labels, "doc_id").filter("not base_failed").groupBy("quality").agg(F.avg(F.col("kept").cast("int"))).collect()
    share = dict(map(tuple, rows))
    assert share[1] > 0.97 and share[0] < 0.8


def brute_grams(text: bytes) -> list[tuple[int, ...]]:
    """Four symbols that end at each byte and at the text's end; 0 is the edge."""
    symbols = [0, 0, 0, *(b + 1 for b in text), 0]
    return [tuple(symbols[k - 3 : k + 1]) for k in range(3, len(symbols))] if text else []


def brute_perplexity(texts: list[bytes], text: bytes) -> float:
    """Log perplexity a symbol under the interpolated modified Kneser-Ney model of all texts."""
    counts = {4: collections.Counter(g for t in texts for g in brute_grams(t))}
    for k in (3, 2, 1):
        counts[k] = collections.Counter(g[1:] for g in counts[k + 1])
    cuts, after = {}, collections.defaultdict(list)
    for k, found in counts.items():
        n = [sum(c == m for c in found.values()) for m in (1, 2, 3, 4)]
        y = n[0] / (n[0] + 2 * n[1]) if n[0] else 0
        cuts[k] = [min(max(m - (m + 1) * y * n[m] / n[m - 1], 0.05), m - 0.05) if n[m - 1] and n[m] else 0.5 for m in (1, 2, 3)]
        for g, c in found.items():
            after[g[:-1]].append(c)

    def p(g: tuple[int, ...]) -> float:
        if not g:
            return 1 / 257
        found, cut, rest = counts[len(g)][g], cuts[len(g)], after[g[:-1]]
        taken = sum(cut[min(c, 3) - 1] for c in rest)
        return (found - cut[min(found, 3) - 1] + taken * p(g[1:])) / sum(rest)

    logs = [math.log(p(g)) for g in brute_grams(text)]
    return -sum(logs) / len(logs)


def test_grams_are_of_whole_texts():
    texts = ["", "Ab", "", "aB", "a1 #\u00e9", "a2 $\u00e8\x00\n", "x", "", "\u4f60"]
    raw = [t.encode() for t in texts]
    offsets = np.cumsum([0, *map(len, raw)])
    code, doc = quality.grams(np.frombuffer(b"".join(raw), np.uint8), offsets)
    code_of = [[sum(s * quality.CLASSES ** (3 - k) for k, s in enumerate(g)) for g in brute_grams(t)] for t in raw]
    assert code.tolist() == [c for codes in code_of for c in codes]
    assert doc.tolist() == [k for k, codes in enumerate(code_of) for _ in codes]
    # Another byte anywhere is another n-gram, and so is an earlier end.
    seen = [tuple(quality.grams(np.array([65, b, 66], np.uint8), np.array([0, 3]))[0]) for b in range(256)]
    assert len(set(seen)) == 256
    table = quality.READINGS["folded_"]
    assert (table[list(b"Az9 \n.#&")] == list(b"az0  .##")).all() and table[0xE9 - 0x40] != table[0xE8 - 0x40]
    assert len(set(table.tolist())) == 48


def test_perplexity_is_that_of_counting_by_hand(spark, monkeypatch):
    r = random.Random(11)
    texts = [None, "", "a", "\x00", "Ab aB", "AB ab"] + ["".join(r.choice("abAB 1#\u00e9\u00e8\n") for _ in range(r.randint(1, 25))) for _ in range(20)]
    # Keys repeat and are null, and so are languages.
    rows = [(None if i % 5 == 0 else i // 2, t, (None, "en", "fr")[i % 3]) for i, t in enumerate(texts)]
    docs = odd(spark, rows)
    read = {"": lambda t: (t or "").encode(), "folded_": lambda t: (t or "").encode().translate(quality.READINGS["folded_"].tobytes())}
    expected = []
    for i, t, lang in rows:
        same = [x for _, x, other in rows if other == lang]
        expected.append((i, lang or "", *(brute_perplexity([*map(f, same)], f(t)) if t else None for f in read.values())))
    order = lambda x: [(v is not None, round(v, 3) if isinstance(v, float) else v) for v in x]
    for part, held in ((1 << 21, 1 << 20), (120, 60)):
        monkeypatch.setattr(quality, "PART", part)
        monkeypatch.setattr(quality, "HELD", held)
        got = [tuple(x) for x in quality.scored(docs).select("doc_id", "lang", "log_ppl", "folded_log_ppl").collect()]
        assert len(got) == len(expected)
        # The small figures need several parts, and several rows of a task for one n-gram.
        for a, b in zip(sorted(got, key=order), sorted(expected, key=order)):
            assert a[:2] == b[:2]
            assert a[2:] == (pytest.approx(b[2:], abs=1e-5) if b[2] is not None else (None, None))


def test_parts_hold_each_context_once():
    sizes = {("", "a"): 10, ("", "b"): 25, ("", "c"): 3, ("folded_", "a"): 4, ("folded_", "b"): 9}
    found = quality.shares(sizes, 10)
    assert all(sum(-(-sizes[key] // k) for key, (k, _) in part.items()) <= 10 for part in found)
    for key in sizes:
        taken = [part[key] for part in found if key in part]
        assert taken and sorted(j for _, j in taken) == list(range(taken[0][0]))
    assert quality.shares({}, 10) == []


def test_capitals_and_other_digits_leave(spark):
    r = random.Random(12)
    words = ["".join(r.choice("aeinorstdlc") for _ in range(r.randint(2, 7))) for _ in range(300)] + ["10", "100"]
    texts = [" ".join(r.choice(words) for _ in range(80)) + "." for _ in range(200)]
    odd_ones = [texts[0].upper(), texts[1].replace(" ", "\x01"), texts[2].translate(str.maketrans("aeino", "áéíñó"))]
    docs = spark.createDataFrame([(i, t, "en") for i, t in enumerate(texts + odd_ones)], "doc_id long, text string, lang string")
    kept = {x["doc_id"]: x["kept"] for x in quality.judged(docs).collect()}
    assert sum(kept[i] for i in range(200)) >= 198
    assert not any(kept[200 + k] for k in range(len(odd_ones)))


# language


def brute_phrases(sample: str, text: str) -> int:
    count = at = 0
    while at < len(text):
        end = at + 1
        while end < len(text) and text[at : end + 1] in sample:
            end += 1
        count, at = count + 1, end
    return count


def test_phrases_are_longest_matches():
    r = random.Random(6)
    samples = {"x": "".join(r.choice("abc ") for _ in range(300)), "y": "".join(r.choice("abd ") for _ in range(200))}
    parser = langid.Parser.build(samples)
    texts = ["".join(r.choice("abcde") for _ in range(r.randint(0, 60))) for _ in range(80)] + ["", "eee", "ABC"]
    got, letters = parser.phrases(texts)
    for text, row, n in zip(texts, got, letters):
        assert n == len(text)
        for k, lang in enumerate(parser.languages):
            assert row[k] == brute_phrases(re.sub(" +", " ", samples[lang]), text.lower())


def test_long_texts_are_parsed_in_blocks():
    parser = langid.Parser.build({"x": "ab" * 40, "y": "ba c"})
    got, _ = parser.phrases(["ab" * langid.BLOCK, "a"])
    assert got[0][0] == 2 * math.ceil(langid.BLOCK / 80) and got[1][0] == 1


def test_languages(spark):
    rows = [(1, None, "en"), (2, "", "en"), (3, "12 %", None), (None, "the house and the garden", None), (5, "the " * 60_000, "en")]
    rows += [(10 + i, "the house and the garden are here " * 3, "en") for i in range(5)] + [(20 + i, "das Haus und der Garten sind hier " * 3, "de") for i in range(5)]
    got = {r["doc_id"]: r for r in langid.identified(odd(spark, rows)).collect()}
    assert len(got) == len(rows)
    assert [got[i]["lang_pred"] for i in (1, 2, 3)] == ["und"] * 3 and got[None]["lang_pred"] == "en"
    assert all(got[20 + i]["lang_pred"] == "de" and 0.5 <= got[20 + i]["score"] <= 1 for i in range(5))
    assert langid.identified(odd(spark, rows).limit(0)).count() == 0
    assert {r["lang_pred"] for r in langid.identified(odd(spark, rows), F.lit(False)).collect()} == {"und"}


def test_language_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    usable = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 != 0
    found = langid.identified(docs, usable).join(docs.filter(~usable).select("doc_id", "lang"), "doc_id")
    right, total = found.agg(F.sum((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*")).first()
    assert right / total > 0.98


# hidden Markov model


def brute_likelihood(model, ids) -> float:
    state = model.start * model.emit[:, ids[0]]
    for k in ids[1:]:
        state = (state @ model.move) * model.emit[:, k]
    return math.log(state.sum())


def small_model(seed=3, states=3, classes=7):
    rng = np.random.default_rng(seed)
    norm = lambda x: x / x.sum(axis=-1, keepdims=True)
    start = norm(rng.random(states))
    return hmm.Model(start, start, norm(rng.random((states, states))), norm(rng.random((states, classes))))


def test_forward_recursion_is_exact():
    model, rng = small_model(), np.random.default_rng(1)
    sizes = np.array([5, 1, 12, 3])
    flat = rng.integers(0, 7, sizes.sum())
    want = [brute_likelihood(model, x) for x in np.split(flat, np.cumsum(sizes)[:-1])]
    assert np.allclose(hmm.log_likelihoods(model, flat, sizes), want)


def test_expected_counts_are_those_of_all_paths():
    from itertools import product

    model, ids = small_model(), np.array([2, 5, 1, 1])
    start, move, emit = np.zeros(3), np.zeros((3, 3)), np.zeros((3, 7))
    for path in product(range(3), repeat=4):
        p = model.start[path[0]] * model.emit[path[0], ids[0]]
        for a, b, k in zip(path, path[1:], ids[1:]):
            p *= model.move[a, b] * model.emit[b, k]
        start[path[0]] += p
        for a, b in zip(path, path[1:]):
            move[a, b] += p
        for s, k in zip(path, ids):
            emit[s, k] += p
    total = start.sum()
    got = hmm.expected_counts(model, ids, np.array([4]), np.array([True]))
    for x, y in zip(got, (start, move, emit)):
        assert np.allclose(x, y / total)


def test_iterations_raise_the_likelihood():
    rng, model = np.random.default_rng(2), small_model()
    sizes = rng.integers(2, 40, 60)
    flat = rng.integers(0, 7, sizes.sum()) // rng.integers(1, 3, sizes.sum())
    unigram, last = np.full(7, 1 / 7), -np.inf
    for _ in range(6):
        now = hmm.log_likelihoods(model, flat, sizes).sum()
        assert now > last - 1e-3
        last = now
        model = model.updated(*hmm.expected_counts(model, flat, sizes, np.ones(60, bool)), unigram)


def test_scores(spark):
    texts = {1: "The cat sat", 2: None, 3: "the dog\tsat  zebra", 4: "é ab abc a", 5: "the the the", 6: "new words here", None: "the cat", 7: "a b " * 20_000}
    rows = odd(spark, [(i, t, "en") for i, t in texts.items()] + [(1, texts[1], "en")])
    training = ~F.col("doc_id").isin(3, 6)
    settings = hmm.Settings(states=2, own=3, endings=4, warm_docs=5)
    got = hmm.scored(rows, training, settings).collect()
    split = lambda t: re.findall(r"[^\x20\x09-\x0D]+", (t or "").lower()) + ["\n"]
    # A null id makes the condition null: such a row is not learnt from.
    counts = collections.Counter(w for i, t in [*texts.items(), (1, texts[1])] if i is not None and i not in (3, 6) for w in split(t))
    n, v = sum(counts.values()), len(counts)
    assert len(got) == len(texts) + 1
    for r in got:
        words = split(texts[r["doc_id"]])
        assert r["n_tokens"] == len(words) and r["train_tokens"] == n
        assert r["n_known"] == sum(counts[w] > 0 for w in words)
        assert abs(r["base_score"] - sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in words)) < 1e-6 * len(words)
        assert r["score"] < 0
    assert hmm.scored(rows.limit(0), training, settings).count() == 0
    assert hmm.scored(rows, F.lit(False), settings).filter("train_tokens = 0 and base_score = 0 and score < 0").count() == len(got)


def test_hidden_markov_start_reads_no_sample():
    unigram = np.array([0.5, 0.3, 0.2])
    settings = hmm.Settings()
    start, fresh = hmm.warm_model(None, unigram, settings), hmm.Model.fresh(settings.states, unigram, settings.seed)
    assert np.array_equal(start.emit, fresh.emit) and np.array_equal(start.move, fresh.move)


def test_endings_agree_between_spark_and_python(spark):
    import zlib

    settings = hmm.Settings()
    words = ["a", "ab", "abc", "abcd", "é", "straße", "\n"]
    rows = spark.createDataFrame([(w.encode(),) for w in words], "word binary").select("word", hmm.ending_class(settings).alias("e")).collect()
    assert all(r["e"] == zlib.crc32(bytes(r["word"])[-3:]) % settings.endings for r in rows)


def test_model_beats_the_unigrams_on_held_out_text(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2
    found = hmm.scored(docs, ~held).filter(held).agg(F.sum("score"), F.sum("base_score"), F.sum("n_tokens")).first()
    assert (found[0] - found[1]) / found[2] > 0.1


# toxicity


def test_toxicity(spark):
    r = random.Random(8)
    plain = ["alpha", "beta", "gamma", "delta", "omega", "kappa"]
    rows, labels = [], []
    for i in range(400):
        words = [r.choice(plain) for _ in range(r.randint(3, 60))]
        if i % 3 == 0:
            words.insert(r.randrange(len(words)), r.choice(["vilest", "vilely", "vileness"]))
        rows.append((i, " ".join(words) + f" {i}", "en" if i % 2 else None))
        labels.append((i, int(i % 3 == 0), "extra"))
    rows += [(1000, None, "en"), (1001, "", None), (None, "vileness! alpha", "en"), (1002, "alpha " * 60_000 + "VILEST.", "de"), (0, rows[0][1], None)]
    docs, marks = odd(spark, rows), spark.createDataFrame(labels, "doc_id long, toxic int, text string")
    net = toxicity.fit(docs, marks, F.col("doc_id") < 300)
    got = {x["row"]["doc_id"]: x["score"] for x in toxicity.scored(docs, net).collect()}
    assert all((got[i] >= 0.5) == (i % 3 == 0) for i in range(300, 400))
    assert got[None] >= 0.5 and got[1002] >= 0.5 and got[1000] < 0.5 and got[1000] == got[1001]
    kept = toxicity.clean_documents(docs, net)
    assert kept.columns == docs.columns
    assert {x["doc_id"] for x in kept.collect()} == {i for i in range(400) if i % 3} | {1000, 1001}
    assert toxicity.scored(docs.limit(0), net).count() == 0


@pytest.mark.parametrize("value", [None, 0, 1])
def test_toxicity_with_nothing_to_learn(spark, value):
    docs = odd(spark, [(1, "a b", "en"), (2, None, None)])
    marks = spark.createDataFrame([(1, value)], "doc_id long, toxic int")
    scores = [x["score"] for x in toxicity.scored(docs, toxicity.fit(docs, marks)).collect()]
    assert len(scores) == 2 and scores[0] == scores[1] and 0 <= scores[0] <= 1


def test_toxicity_held_out(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    usable = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 != 0
    net = toxicity.fit(docs, labels, usable)
    held = docs.join(labels.filter(~usable).select("doc_id", "toxic"), "doc_id")
    rows = toxicity.scored(held, net).select("row.toxic", "score").collect()
    score, toxic = np.array([r["score"] for r in rows]), np.array([r["toxic"] for r in rows])
    assert (score[toxic == 1] >= 0.5).mean() > 0.8 and (score[toxic == 0] >= 0.5).mean() < 0.02


def test_toxicity_thresholds_of_languages_come_from_all_labels(spark):
    r = random.Random(5)
    rows = []
    for i in range(1200):
        toxic, lang = int(i % 3 == 0), "en" if i % 2 else "de"
        words = [r.choice(["alpha", "beta", "gamma", "delta"]) for _ in range(12)]
        if toxic or lang == "de" and r.random() < 0.2:
            words[3] = "vilest"
        rows.append((i, " ".join(words) + f" {i}", lang, toxic))
    docs = spark.createDataFrame([x[:3] for x in rows], "doc_id long, text string, lang string")
    marks = spark.createDataFrame([(x[0], x[3]) for x in rows], "doc_id long, toxic int")
    net = toxicity.fit(docs, marks, sample=toxicity.Sample(rows=20))
    assert set(net.thresholds) == {None, "en", "de"}
    assert len(set(net.thresholds.values())) > 1
    counts = toxicity.score_counts(docs, marks, F.lit(True), net, [], toxicity.Sample(), "doc_id", "text", "lang").collect()
    assert sum(x["n"] for x in counts) == sum(x["fresh"] for x in counts) == 1200


def test_toxicity_thresholds_do_not_follow_what_was_sampled():
    # Nine in ten toxic rows were learnt from, and few of the others.
    few = [("en", 1, 64, 1000, 100), ("en", 1, -64, 1000, 100), ("en", 0, -64, 1500, 1400), ("en", 0, -640, 9000, 8900)]
    all_ = [(lang, toxic, step, n, n) for lang, toxic, step, n, _ in few]
    got = toxicity.thresholds(few)
    assert got == pytest.approx(toxicity.thresholds(all_)) and got["en"] == got[None] < 0.27
    assert toxicity.thresholds([("en", 1, 5, 3, 0), ("en", 0, 5, 3, 3)]) == {None: 0.5}
