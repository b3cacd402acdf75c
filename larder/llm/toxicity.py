"""Toxicity by a convolutional text classifier over hashed words.

A word is a run of letters, digits and non-ASCII bytes, in lower case; its embedding is the sum of
those found under the hashes of the word and of its first four and five bytes, so that inflected forms
of a stem share what is learnt. Filters of several widths slide over the embeddings of a text, each keeps its largest
response, and a logistic layer reads those. One strong place in a long text is thus enough.

Training runs in numpy on the driver, over a bounded sample of labelled rows (``Sample``). Words and
beginnings too rare in the sample to say anything share one embedding, which keeps the filters from
learning single documents by heart. Thresholds come from all labelled rows: a quarter is never learnt from, Spark
scores every labelled text that the network has not seen, and counts them by language, label and score. Scoring is distributed: each filter tap is applied once to
each distinct word of a batch, and a convolution is then a sum of look-ups.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larder.llm.common import LOWER, column_of, slices, utf8, word_array

#: Bytes inside words: letters, digits, everything beyond ASCII.
WORD = np.zeros(256, bool)
WORD[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True

WIDTHS = (1, 2, 3)


@dataclass(frozen=True)
class Sample:
    """Bounds of what is learnt from: rows per class, tokens per text, rows a word must appear in; hash buckets (2**21 at most)."""

    rows: int = 3_000
    tokens: int = 8_192
    least_rows: int = 5
    buckets: int = 1 << 18


#: One in so many labelled ids is kept out of training.
KEPT_OUT = 4

#: Toxic rows outside training that a language needs for a threshold of its own.
LEAST_TOXIC = 30

#: Steps of a score's log odds that are counted apart.
STEPS = 64

#: Lengths in bytes of the beginnings that have embeddings of their own.
STEMS = (4, 5)


def word_hashes(data: np.ndarray, offsets: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of every distinct word and its beginnings (one row each), the row of every word in order, and its document."""
    data = LOWER[data]
    starts = ends = np.zeros(0, np.int64)
    if len(data):
        inside = WORD[data]
        edge = np.zeros(len(data) + 1, bool)
        edge[offsets] = True
        starts = np.flatnonzero(inside & (~np.append(False, inside[:-1]) | edge[:-1]))
        ends = np.flatnonzero(inside & (~np.append(inside[1:], False) | edge[1:])) + 1
    coded = word_array(data, starts, ends).dictionary_encode()
    crc = zlib.crc32
    hashed = [(crc(w), *(crc(w[:k], k) for k in STEMS)) for w in coded.dictionary.to_pylist()]
    hashed = np.array(hashed, np.int64).reshape(-1, 1 + len(STEMS)) % buckets
    return hashed, coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), np.searchsorted(offsets, starts, side="right") - 1


@dataclass
class Network:
    """Embeddings (row 0: padding, row 1: rare words), filters per width, the last layer, and a row per known bucket."""

    known: np.ndarray
    embedding: np.ndarray
    filters: list[np.ndarray]
    last: np.ndarray
    bias: float
    thresholds: dict[str | None, float] = field(default_factory=dict)

    def rows(self, hashed: np.ndarray) -> np.ndarray:
        """Embedding rows of hashed words."""
        if not len(self.known):
            return np.ones(hashed.shape, np.int64)
        at = np.minimum(np.searchsorted(self.known, hashed), len(self.known) - 1)
        return np.where(self.known[at] == hashed, at + 2, 1)

    def tables(self, hashed: np.ndarray) -> list[list[np.ndarray]]:
        """Responses of words, given by their buckets, to every tap of every filter width; row 0 is padding."""
        words = self.embedding[self.rows(hashed)].sum(axis=1)
        words = np.concatenate([np.zeros((1, words.shape[1]), words.dtype), words])
        return [[words @ tap for tap in taps] for taps in self.filters]


def padded(rows: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The texts (words from 1 on) after one another with padding behind each, and where each begins."""
    gap = max(WIDTHS)
    starts = np.cumsum(sizes + gap) - sizes - gap
    out = np.zeros(int((sizes + gap).sum()) + gap, np.int64)
    out[np.repeat(starts - (np.cumsum(sizes) - sizes), sizes) + np.arange(len(rows))] = rows
    return out, starts


def pooled(tables: list[list[np.ndarray]], ids: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Largest response per text and filter, never below 0. A window begins at a word of its text or right behind the last."""
    parts = []
    edges = np.column_stack([starts, starts + sizes + 1]).ravel()
    n = len(ids) - max(WIDTHS)
    for taps in tables:
        response = taps[0][ids[:n]]
        for j, tap in enumerate(taps[1:], 1):
            response += tap[ids[j : n + j]]
        parts.append(np.maximum(np.maximum.reduceat(response, edges, axis=0)[::2], 0))
    return np.concatenate(parts, axis=1)


def _adam(state: dict, name: str, value: np.ndarray, grad: np.ndarray, rate: float) -> None:
    m, v, t = state.setdefault(name, [np.zeros_like(value), np.zeros_like(value), 0])
    t += 1
    m *= 0.9
    m += 0.1 * grad
    v *= 0.999
    v += 0.001 * grad * grad
    state[name][2] = t
    value -= rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)


def train(
    hashed: np.ndarray,
    texts: list[np.ndarray],
    toxic: np.ndarray,
    sample: Sample = Sample(),
    size: int = 8,
    kinds: int = 6,
    epochs: int = 5,
    steps: int = 300,
    seed: int = 11,
) -> Network:
    """Fit a network to texts, given as rows of ``hashed``; small samples get more epochs, for ``steps`` batches at least.

    Without both classes the network scores every text with the share of class 1.
    """
    random = np.random.default_rng(seed)
    share = (toxic.sum() + 0.5) / (len(toxic) + 1)
    # In how many texts of either class each bucket appears.
    buckets, at = np.unique(hashed, return_inverse=True)
    at = at.reshape(hashed.shape)
    total, ones = np.zeros(len(buckets)), np.zeros(len(buckets))
    for text, label in zip(texts, toxic.tolist()):
        some = np.unique(at[text])
        total[some] += 1
        ones[some] += label
    often = total >= sample.least_rows
    known, total, ones = buckets[often], total[often], ones[often]
    embedding = (random.standard_normal((len(known) + 2, size)) * 0.05).astype(np.float32)
    # The first dimension begins as the shrunken log odds, so that training refines a sensible start.
    odds = np.log((ones + 4 * share) / (total - ones + 4 * (1 - share))) - np.log(share / (1 - share))
    embedding[:, 0] = 0
    embedding[2:, 0] = odds / hashed.shape[1] if len(texts) else 0
    embedding[0] = 0
    filters = [(random.standard_normal((w, size, kinds)) * 0.2).astype(np.float32) for w in WIDTHS]
    for taps in filters:
        taps[:, 0, 0] += 1.0 / len(taps)
    last = np.full(len(WIDTHS) * kinds, 0.1, np.float32)
    bias = np.array([np.log(share / (1 - share))], np.float32)
    net = Network(known, embedding, filters, last, float(bias[0]))
    if not 0 < toxic.sum() < len(toxic):
        last[:] = 0
        return net
    rows = net.rows(hashed)
    sizes = np.array([len(t) for t in texts])
    weight = np.where(toxic == 1, 0.5 / toxic.mean(), 0.5 / (1 - toxic.mean())) ** 0.5
    state: dict = {}
    epochs = max(epochs, -(-steps * 64 // len(texts)))
    for epoch in range(epochs):
        order = random.permutation(len(texts))
        rate = 0.01 * (1 - epoch / epochs)
        for k in range(0, len(order), 64):
            batch = order[k : k + 64]
            ids, starts = padded(np.concatenate([texts[b] for b in batch]) + 1, sizes[batch])
            words, ids = np.unique(ids, return_inverse=True)
            features_of = np.where(words[:, None] > 0, rows[words - 1], 0)
            vectors = embedding[features_of].sum(axis=1)
            n = len(ids) - max(WIDTHS)
            best, where = [], []
            for taps in filters:
                response = sum((vectors @ tap)[ids[j : n + j]] for j, tap in enumerate(taps))
                place = np.array([a + response[a:b].argmax(axis=0) for a, b in zip(starts, starts + sizes[batch] + 1)])
                where.append(place)
                best.append(np.take_along_axis(response, place, axis=0))
            features = np.concatenate(best, axis=1)
            active = features > 0
            keep = (random.random(features.shape) > 0.2) / 0.8
            features = np.where(active, features, 0) * keep
            error = (1 / (1 + np.exp(-(features @ last + bias[0]))) - toxic[batch]) * weight[batch] / len(batch)
            back = (error[:, None] * last[None, :] * keep * active).astype(np.float32)
            toward = np.zeros_like(vectors)
            for w, taps in enumerate(filters):
                mine = back[:, w * kinds : (w + 1) * kinds]
                slope = np.zeros_like(taps)
                for j in range(len(taps)):
                    hit = ids[where[w] + j]
                    np.add.at(toward, hit.ravel(), (mine[:, :, None] * taps[j].T[None]).reshape(-1, size))
                    slope[j] = np.einsum("nf,nfs->sf", mine, vectors[hit])
                _adam(state, f"taps{w}", taps, slope + 1e-4 * taps, rate)
            moved = np.flatnonzero(np.abs(toward).sum(axis=1))
            grad = np.zeros_like(embedding)
            for row in features_of.T:
                np.add.at(grad, row[moved], toward[moved])
            grad[0] = 0
            _adam(state, "embedding", embedding, grad, rate)
            _adam(state, "last", last, (features * error[:, None]).sum(axis=0).astype(np.float32) + 1e-4 * last, rate)
            _adam(state, "bias", bias, np.array([error.sum()], np.float32), rate)
    net.bias = float(bias[0])
    return net


def scores(net: Network, hashed: np.ndarray, words: np.ndarray, doc: np.ndarray, n: int) -> np.ndarray:
    """Score of each of ``n`` texts; a text without words has that of no response at all."""
    sizes = np.bincount(doc, minlength=n)
    ids, starts = padded(words + 1, sizes)
    return 1 / (1 + np.exp(-(pooled(net.tables(hashed), ids, starts, sizes) @ net.last + net.bias).astype(float)))


def packed_words(hashed: np.ndarray, words: np.ndarray, doc: np.ndarray, n: int, sample: Sample) -> Iterator[bytes]:
    """The words of each of ``n`` texts, eight bytes a word."""
    stops = np.searchsorted(doc, np.arange(n), side="right")
    packed = (hashed[:, 0] * sample.buckets + hashed[:, 1]) * sample.buckets + hashed[:, 2]
    return (packed[words[a:b]].tobytes() for a, b in zip([0, *stops], stops))


def labelled_sample(docs: DataFrame, labels: DataFrame, usable: Column, sample: Sample, id_col: str, text_col: str, lang_col: str) -> list:
    """Hashed words, label and language of at most ``sample.rows`` labelled documents per class, drawn by a hash of the id.

    One in ``KEPT_OUT`` ids is never drawn.
    """
    mark = F.xxhash64("doc_id")
    learnt = F.pmod(F.xxhash64("doc_id", F.lit("threshold")), F.lit(KEPT_OUT)) != 0
    known = labels.filter(usable & F.col("toxic").isin(0, 1) & learnt).select("doc_id", F.col("toxic").cast("int").alias("toxic")).withColumn("_h", mark)
    counts = dict(known.groupBy("toxic").count().collect())
    drawn = None
    for value, count in sorted(counts.items()):
        # Twice as many as wanted by threshold first, so that the exact cut sees few rows.
        share = min(1.0, 2.0 * sample.rows / count)
        some = known.filter((F.col("toxic") == value) & (F.pmod("_h", F.lit(1_000_000)) < share * 1_000_000))
        some = some.orderBy("_h", "doc_id").limit(sample.rows)
        drawn = some if drawn is None else drawn.unionByName(some)
    if drawn is None:
        return []
    drawn = F.broadcast(drawn.groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang")).join(drawn, "doc_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            hashed, words, doc = word_hashes(*utf8(batch.column("text")), sample.buckets)
            parts = [p if len(p) <= 8 * sample.tokens else None for p in packed_words(hashed, words, doc, batch.num_rows, sample)]
            yield pa.RecordBatch.from_pydict(
                {"doc_id": batch.column("doc_id").cast(pa.int64()), "toxic": batch.column("toxic"), "lang": batch.column("lang"), "words": pa.array(parts, pa.binary())}
            )

    found = rows.mapInArrow(run, "doc_id long, toxic int, lang string, words binary").filter("words is not null")
    # A text that many rows share counts once, and so does a repeated id.
    one = found.groupBy(F.xxhash64("words").alias("_w")).agg(F.min(F.struct("doc_id", "toxic", "lang", "words")).alias("r")).select("r.*")
    return sorted(one.collect())


def fit(
    docs: DataFrame,
    labels: DataFrame,
    usable: Column | None = None,
    sample: Sample = Sample(),
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
) -> Network:
    """A network learnt from ``labels`` (``doc_id, toxic``) where ``usable`` holds, with a threshold per language.

    A language's threshold is the score that separates its labelled rows best (F1), see :func:`score_counts`; languages with
    fewer than ``LEAST_TOXIC`` toxic rows outside training get that of all rows, and labels without both classes get 0.5.
    """
    usable = F.lit(True) if usable is None else usable
    rows = labelled_sample(docs, labels, usable, sample, id_col, text_col, lang_col)
    toxic = np.array([r["toxic"] for r in rows], np.int64)
    sizes = [len(r["words"]) // 8 for r in rows]
    packed = np.frombuffer(b"".join(r["words"] for r in rows), np.int64)
    empty = not rows
    seen = sorted({xxhash.xxh64_intdigest(r["words"]) - (1 << 63) for r in rows})
    del rows
    packed, flat = np.unique(packed, return_inverse=True)
    rest, third = np.divmod(packed, sample.buckets)
    hashed = np.stack([*np.divmod(rest, sample.buckets), third], axis=1)
    texts = [] if empty else np.split(flat, np.cumsum(sizes)[:-1])
    net = train(hashed, texts, toxic, sample)
    if not 0 < toxic.sum() < len(toxic):
        net.thresholds = {None: 0.5}
        return net
    net.thresholds = thresholds(score_counts(docs, labels, usable, net, seen, sample, id_col, text_col, lang_col).collect())
    return net


def score_counts(
    docs: DataFrame, labels: DataFrame, usable: Column, net: Network, seen: list[int], sample: Sample, id_col: str, text_col: str, lang_col: str
) -> DataFrame:
    """``lang, toxic, step, n, fresh``: labelled rows by step of their score's log odds, and how many have texts not in ``seen``.

    Only ids and steps meet the labels, texts stay where they are.
    """
    model = docs.sparkSession.sparkContext.broadcast(net)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            hashed, words, doc = word_hashes(*utf8(batch.column("text")), sample.buckets)
            score = np.clip(scores(model.value, hashed, words, doc, batch.num_rows), 1e-12, 1 - 1e-12)
            step = np.floor(np.log(score / (1 - score)) * STEPS).astype(np.int32)
            known = np.array([xxhash.xxh64_intdigest(p) - (1 << 63) for p in packed_words(hashed, words, doc, batch.num_rows, sample)], np.int64)
            fresh = ~np.isin(known, seen)
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), "lang": batch.column("lang"), "step": pa.array(step), "fresh": pa.array(fresh)})

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), F.coalesce(F.col(lang_col).cast("string"), F.lit("")).alias("lang"))
    marks = labels.filter(usable & F.col("toxic").isin(0, 1)).groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    found = rows.filter("doc_id is not null").mapInArrow(run, "doc_id long, lang string, step int, fresh boolean").join(marks, "doc_id")
    return found.groupBy("lang", "toxic", "step").agg(F.count(F.lit(1)).alias("n"), F.count_if("fresh").alias("fresh"))


def thresholds(counts: list) -> dict[str | None, float]:
    """The threshold of all rows (None) and of each language with enough toxic rows, from ``lang, toxic, step, n, fresh``.

    Scores are distributed as those outside training, classes as in all labelled rows, whatever share of a class was learnt from.
    """

    def best(rows: list) -> float | None:
        steps = sorted({step for _, _, step, _, fresh in rows if fresh}, reverse=True)
        at = {step: k for k, step in enumerate(steps)}
        total, found = np.zeros(2), np.zeros((2, len(steps)))
        for _, toxic, step, n, fresh in rows:
            total[toxic] += n
            if fresh:
                found[toxic, at[step]] += fresh
        unseen = found.sum(axis=1)
        if not unseen.all():
            return None
        false, true = np.cumsum(found * (total / unseen)[:, None], axis=1)
        k = int((2 * true / (true + false + total[1])).argmax())
        # In the middle of the gap below the lowest step that counts as toxic.
        low = 1 / (1 + np.exp(-(steps[k + 1] + 1) / STEPS)) if k + 1 < len(steps) else 0.0
        return float((1 / (1 + np.exp(-steps[k] / STEPS)) + low) / 2)

    whole = best(counts)
    result: dict[str | None, float] = {None: 0.5 if whole is None else whole}
    by_lang: dict[str, list] = {}
    for row in counts:
        by_lang.setdefault(row[0], []).append(row)
    for lang, rows in sorted(by_lang.items()):
        if sum(fresh for _, toxic, _, _, fresh in rows if toxic) >= LEAST_TOXIC and (own := best(rows)) is not None:
            result[lang] = own
    return result


def scored(docs: DataFrame, net: Network, sample: Sample = Sample(), text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``row, score, threshold``: all columns of each document as a struct, its score, and the threshold of its language.

    A null or empty text has the score of a text without words. The score depends on the text alone.
    """
    model = docs.sparkSession.sparkContext.broadcast(net)
    text = f"row.{docs.columns.index(text_col)}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text):
            found = word_hashes(*utf8(column_of(batch, text)), sample.buckets)
            score = pa.array(scores(model.value, *found, batch.num_rows), pa.float64())
            yield pa.RecordBatch.from_arrays([batch.column("row"), score], ["row", "score"])

    rows = docs.select(F.struct(*docs.columns).alias("row"))
    found = rows.mapInArrow(run, T.StructType([rows.schema["row"], T.StructField("score", T.DoubleType())]))
    cut = F.lit(net.thresholds[None])
    for name, value in net.thresholds.items():
        if name is not None:
            cut = F.when(F.coalesce(F.col("row").getField(lang_col).cast("string"), F.lit("")) == name, F.lit(value)).otherwise(cut)
    return found.withColumn("threshold", cut)


def clean_documents(docs: DataFrame, net: Network, sample: Sample = Sample(), text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The documents whose score lies below their language's threshold, all columns kept."""
    return scored(docs, net, sample, text_col, lang_col).filter("score < threshold").select("row.*")
