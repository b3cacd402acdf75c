"""A hidden Markov language model: Baum-Welch counts from all partitions, exact likelihood by the scaled forward recursion.

Hidden states emit *classes*. The commonest ``Settings.own`` words (and the end of a text) are classes of
their own; every other word belongs to one of ``Settings.endings`` classes by its last bytes, and a class emits its
words in proportion to their count plus one, with one more for a word never seen. The state matrices
are thus bounded while the vocabulary is not:

    log P(text) = log P(class sequence)  +  sum over words of shared classes (log(c + 1) - log Z(class))

Counts ``c`` cover the whole training corpus. A word with at least ``Settings.share`` of all tokens is *common*:
there are at most ``1 / share`` of them, so their counts are broadcast. The others are rare, hence no
hot keys, and meet their counts in a join.

Texts are tokenised once; class sequences and rare words are staged. Each iteration is one pass in which
tasks sum expected counts and Spark adds them up per class; the driver holds the bounded
matrices only. The iterations start from the unigram distribution over all training tokens; a start from a model fitted to a
bounded sample is to be had with ``Settings.warm_docs``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from math import log10

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zlib
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.llm.common import LOWER, coded_words, per_doc, slices, utf8
from larder.session import stage

#: Stands for the end of a text among the words; no word has white space.
END = b"\n"

#: Tokens after which training cuts a text into pieces (scoring never does), and bytes of class ids held at once.
PIECE, ID_BYTES = 1024, 2 << 20

LN10 = np.log(10.0)


@dataclass(frozen=True)
class Settings:
    """States; words with a class of their own; classes of other words and the bytes that decide; share that makes a
    word common; iterations over everything; texts (0: none), tokens per text and iterations of a warm start; seed."""

    states: int = 8
    own: int = 8192
    endings: int = 1024
    ending_bytes: int = 3
    share: float = 2.5e-7
    rounds: int = 4
    warm_docs: int = 0
    warm_tokens: int = 4096
    warm_rounds: int = 8
    seed: int = 5


@dataclass
class Vocabulary:
    """Common words by sorted hash with count and class; totals."""

    hashes: np.ndarray
    counts: np.ndarray
    classes: np.ndarray
    own: int
    tokens: int
    distinct: int

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place of each hash, and whether it is there."""
        if not len(self.hashes):
            return np.zeros(len(hashes), np.int64), np.zeros(len(hashes), bool)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return at, self.hashes[at] == hashes


@dataclass
class Model:
    """Start, marginal, transition and emission probabilities."""

    start: np.ndarray
    marginal: np.ndarray
    move: np.ndarray
    emit: np.ndarray

    @staticmethod
    def fresh(states: int, unigram: np.ndarray, seed: int) -> Model:
        """The unigram distribution, disturbed a little differently in each state; states stay for about a hundred tokens,
        so that they soon tell languages and subjects apart."""
        random = np.random.default_rng(seed)
        emit = unigram * np.exp(random.standard_normal((states, len(unigram))))
        move = np.full((states, states), 0.01 / max(states - 1, 1))
        np.fill_diagonal(move, 0.99 if states > 1 else 1.0)
        even = np.full(states, 1.0 / states)
        return Model(even, even, move, emit / emit.sum(axis=1, keepdims=True))

    def updated(self, start: np.ndarray, move: np.ndarray, emit: np.ndarray, unigram: np.ndarray) -> Model:
        """The model that the expected counts call for, with a little of the unigram so that nothing becomes impossible."""
        emit = emit + (1e-6 * emit.sum() + 1e-9) * unigram
        move, start = move + 1e-3 + 1e-6 * move.sum(), start + 1e-3
        marginal = emit.sum(axis=1)
        return Model(start / start.sum(), marginal / marginal.sum(), move / move.sum(axis=1, keepdims=True), emit / emit.sum(axis=1, keepdims=True))


class Lockstep:
    """Sequences side by side, longest first, one column per sequence and one row per step."""

    def __init__(self, flat: np.ndarray, sizes: np.ndarray):
        self.order = np.argsort(-sizes, kind="stable")
        ordered = sizes[self.order]
        steps = int(ordered[0]) if len(ordered) else 0
        self.active = np.searchsorted(-ordered, -np.arange(steps), side="left")
        first = (np.cumsum(sizes) - sizes)[self.order]
        self.begin = np.concatenate([[0], np.cumsum(self.active)])
        # Where the token of each step and sequence lies in the flat array.
        self.where = np.concatenate([first[:m] + t for t, m in enumerate(self.active.tolist())]) if steps else np.zeros(0, np.int64)
        self.obs = flat[self.where]

    def spans(self) -> Iterator[tuple[int, int, int]]:
        """Begin, end and width of each step."""
        return zip(self.begin[:-1].tolist(), self.begin[1:].tolist(), self.active.tolist())


def log_likelihoods(model: Model, flat: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Natural log probability of each class sequence."""
    result = np.zeros(len(sizes))
    lock = Lockstep(flat, sizes)
    emit = np.ascontiguousarray(model.emit.T)
    state, total = None, np.zeros(len(sizes))
    scale = np.empty(len(lock.obs))
    for a, b, m in lock.spans():
        state = (model.start if state is None else state[:m] @ model.move) * emit[lock.obs[a:b]]
        norm = state.sum(axis=1)
        scale[a:b] = norm
        state /= norm[:, None]
    np.add.at(total, np.repeat(np.arange(len(sizes)), sizes)[lock.where], np.log(scale))
    result[:] = total
    return result


def expected_counts(model: Model, flat: np.ndarray, sizes: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Expected starts, transitions and emissions of class sequences; ``first`` marks those that begin a text."""
    states, lock = len(model.start), Lockstep(flat, sizes)
    emit = np.ascontiguousarray(model.emit.T)
    forward, scale = np.empty((len(lock.obs), states)), np.empty(len(lock.obs))
    begin = np.where(first[lock.order, None], model.start, model.marginal)
    last = None
    for a, b, m in lock.spans():
        now = (begin if last is None else last[:m] @ model.move) * emit[lock.obs[a:b]]
        scale[a:b] = now.sum(axis=1)
        now /= scale[a:b, None]
        forward[a:b] = last = now
    move = np.zeros((states, states))
    backward = np.ones((lock.active[-1] if len(lock.active) else 0, states))
    back = model.move.T
    spans = list(lock.spans())
    for k in range(len(spans) - 1, 0, -1):
        a, b, m = spans[k]
        here = emit[lock.obs[a:b]] * backward / scale[a:b, None]
        forward_at = spans[k - 1][0]
        move += forward[forward_at : forward_at + m].T @ here
        forward[a:b] *= backward
        wide = np.ones((spans[k - 1][2], states))
        wide[:m] = here @ back
        backward = wide
    if spans:
        forward[: spans[0][1]] *= backward
    move *= model.move
    start = forward[: len(sizes)][first[lock.order]].sum(axis=0) if spans else np.zeros(states)
    emissions = np.stack([np.bincount(lock.obs, forward[:, s], minlength=model.emit.shape[1]) for s in range(states)])
    return start, move, emissions


def pieces(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sizes of the training pieces of texts, and whether each begins its text."""
    count = -(-sizes // PIECE)
    inside = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    return np.minimum(np.repeat(sizes, count) - inside * PIECE, PIECE), inside == 0


def lower_words(batch: pa.RecordBatch) -> tuple[np.ndarray, list[bytes], np.ndarray]:
    """Words of a batch: numbers into the distinct words, those, and the document of each."""
    data, offsets = utf8(batch.column("text"))
    code, words, doc = coded_words(LOWER[data], offsets)
    return code, words.to_pylist(), doc


def word_counts(docs: DataFrame) -> DataFrame:
    """``word`` (bytes), ``n`` over the texts, ends of texts included."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            code, words, _ = lower_words(batch)
            counts = np.bincount(code, minlength=len(words))
            yield pa.RecordBatch.from_pydict({"word": pa.array([*words, END], pa.binary()), "n": pa.array([*counts.tolist(), batch.num_rows], pa.int64())})

    return docs.mapInArrow(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


def ending_class(settings: Settings) -> Column:
    """Class among the shared ones, by the last bytes of the word."""
    return F.pmod(F.crc32(F.substring("word", -settings.ending_bytes, settings.ending_bytes)), F.lit(settings.endings)).cast("int")


def vocabulary(counts: DataFrame, settings: Settings) -> tuple[Vocabulary, np.ndarray, np.ndarray]:
    """Common words; unigram probability per class; log10 of what the words of each class share (0 for a class of one)."""
    total = counts.agg(F.sum("n"), F.count(F.lit(1))).first()
    tokens, distinct = total[0] or 0, total[1]
    bar = max(int(np.ceil(tokens * settings.share)), 2)
    top = counts.filter(F.col("n") >= bar).orderBy(F.col("n").desc(), "word").limit(settings.own).collect()
    own = {bytes(r["word"]): k for k, r in enumerate(top) if bytes(r["word"]) != END}
    least = top[-1] if top else None
    # Classes: the end, the words of their own, the endings.
    classes = 1 + settings.own + settings.endings
    mass = np.zeros(classes)
    for r in top:
        mass[0 if bytes(r["word"]) == END else 1 + own[bytes(r["word"])]] = r["n"]
    shared = counts
    if least is not None:
        beyond = (F.col("n") < least["n"]) | ((F.col("n") == least["n"]) & (F.col("word") > F.lit(bytes(least["word"]))))
        shared = counts.filter(beyond)
    shared = shared.filter(F.col("word") != F.lit(END))
    sums = shared.groupBy(ending_class(settings).alias("e")).agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("words")).collect()
    room = np.ones(classes)
    for r in sums:
        k = 1 + settings.own + r["e"]
        mass[k], room[k] = r["n"], r["n"] + r["words"] + 1
    ends = [r for r in top if bytes(r["word"]) == END]
    if not ends:  # so few tokens that not even the end is among them
        mass[0] = 1
    unigram = (mass + 0.5) / (mass + 0.5).sum()
    common = counts.filter(F.col("n") >= bar).select(F.xxhash64("word").alias("h"), "n", ending_class(settings).alias("e"), "word").toPandas()
    places = np.array([0 if bytes(w) == END else 1 + own[bytes(w)] if bytes(w) in own else 1 + settings.own + e for w, e in zip(common["word"], common["e"])], np.int64)
    hashes = common["h"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(hashes)
    found = Vocabulary(hashes[order], common["n"].to_numpy(np.int64)[order], places[order], settings.own, tokens, distinct)
    return found, unigram, np.log10(room)


def sequences(docs: DataFrame, shared, settings: Settings) -> DataFrame:
    """Per document: class ids, tokens, known common tokens, sum of log10(c + 1) over common tokens in all and in shared classes, rare words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, room = shared.value
        for batch in slices(batches, "text"):
            n = batch.num_rows
            code, words, doc = lower_words(batch)
            words = [*words, END]
            hashes = np.array([xxhash.xxh64_intdigest(w, 42) for w in words], np.uint64)
            at, common = vocabulary.find(hashes)
            count = np.where(common, vocabulary.counts[at], 0) if len(vocabulary.hashes) else np.zeros(len(words), np.int64)
            tail = settings.ending_bytes
            ending = np.array([zlib.crc32(w[-tail:]) % settings.endings for w in words], np.int64) + 1 + settings.own
            kind = np.where(common, vocabulary.classes[at], ending) if len(vocabulary.hashes) else ending
            kind[-1] = 0
            logs = np.log10(count + 1.0)
            # An end after the words of each text.
            sizes = per_doc(doc, n) + 1
            stops = np.cumsum(sizes)
            token = np.full(int(stops[-1]), len(words) - 1, np.int64)
            inner = np.ones(len(token), bool)
            inner[stops - 1] = False
            token[inner] = code
            of = np.repeat(np.arange(n), sizes)
            kinds = kind[token]
            is_shared = kinds > settings.own
            # Rare words once per document, with their number.
            rare = np.flatnonzero(~common[token] & inner)
            pair, times = np.unique(of[rare] * len(words) + token[rare], return_counts=True)
            rare_doc = pair // len(words)
            offsets = np.searchsorted(rare_doc, np.arange(n + 1))
            items = pa.StructArray.from_arrays(
                [pa.array([words[k] for k in (pair % len(words)).tolist()], pa.binary()), pa.array(times, pa.int32())], ["word", "times"]
            )
            ids = kinds.astype("<i4").tobytes()
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": batch.column("doc_id"),
                    "training": batch.column("training"),
                    "ids": pa.array([ids[4 * a : 4 * b] for a, b in zip([0, *stops[:-1].tolist()], stops.tolist())], pa.binary()),
                    "n_tokens": pa.array(sizes, pa.int64()),
                    "known": pa.array(per_doc(of, n, count[token] > 0).astype(np.int64)),
                    "common_logs": pa.array(per_doc(of, n, logs[token])),
                    "shared_logs": pa.array(per_doc(of, n, np.where(is_shared, logs[token] - room[kinds], 0.0))),  # rare words: log10(0 + 1) so far
                    "rare": pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), items),
                }
            )

    schema = (
        "doc_id long, training boolean, ids binary, n_tokens long, known long, common_logs double, shared_logs double, "
        "rare array<struct<word: binary, times: int>>"
    )
    return docs.mapInArrow(run, schema)


def flat_ids(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """All class ids of a batch after one another, and the size of each sequence."""
    ids = batch.column("ids")
    return np.frombuffer(b"".join(ids.to_pylist()), "<i4"), pc.binary_length(ids).to_numpy(zero_copy_only=False).astype(np.int64) // 4


def iterate(texts: DataFrame, model: Model, unigram: np.ndarray) -> Model:
    """One Baum-Welch iteration over all training texts."""
    states = len(model.start)
    shared = texts.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        start, move, emit = np.zeros(states), np.zeros((states, states)), np.zeros(shared.value.emit.shape)
        for batch in slices(batches, "ids", ID_BYTES):
            flat, sizes = flat_ids(batch)
            part, first = pieces(sizes)
            one = expected_counts(shared.value, flat, part, first)
            start, move, emit = start + one[0], move + one[1], emit + one[2]
        rows = np.concatenate([start[None], move, emit.T])
        seen = np.flatnonzero(rows.sum(axis=1))
        yield pa.RecordBatch.from_pydict({"row": pa.array(seen)} | {f"s{k}": pa.array(rows[seen, k]) for k in range(states)})

    columns = [f"s{k}" for k in range(states)]
    parts = texts.filter("training").select("ids").mapInArrow(run, "row long, " + ", ".join(f"{c} double" for c in columns))
    sums = parts.groupBy("row").agg(*(F.sum(c).alias(c) for c in columns)).toPandas()
    rows = np.zeros((1 + states + model.emit.shape[1], states))
    rows[sums["row"].to_numpy(np.int64)] = sums[columns].to_numpy()
    return model.updated(rows[0], rows[1 : 1 + states], rows[1 + states :].T, unigram)


def warm_model(texts: DataFrame, unigram: np.ndarray, settings: Settings) -> Model:
    """Where the iterations start: the unigram distribution, or with ``warm_docs`` a model fitted on the driver to so many training
    texts, drawn by a hash of the id."""
    model = Model.fresh(settings.states, unigram, settings.seed)
    if not settings.warm_docs:
        return model
    usable = texts.filter(F.col("training") & (F.col("n_tokens") <= settings.warm_tokens)).select(F.xxhash64("doc_id").alias("h"), "ids")
    count = usable.count()
    if not count:
        return model
    share = min(1.0, 3.0 * settings.warm_docs / count)
    drawn = usable.filter(F.pmod("h", F.lit(1 << 30)) < share * (1 << 30)).groupBy("h").agg(F.min("ids").alias("ids"))
    rows = drawn.orderBy("h").limit(settings.warm_docs).collect()
    sizes = np.array([len(r["ids"]) // 4 for r in rows])
    flat = np.frombuffer(b"".join(bytes(r["ids"]) for r in rows), "<i4")
    part, first = pieces(sizes)
    for _ in range(settings.warm_rounds):
        model = model.updated(*expected_counts(model, flat, part, first), unigram)
    return model


def scored(
    docs: DataFrame, training: Column, settings: Settings = Settings(), id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per document: ``doc_id, n_tokens, n_known, train_tokens, base_score, score``.

    Learnt from the rows where ``training`` holds. ``score`` is the log10 probability of the whole text and its end,
    ``base_score`` that of a unigram model with one added to every count. A null text is the empty text: only its
    end is a token. Repeated rows are rows of the corpus like others and get equal scores. Without training rows
    the base score is 0 and the model knows nothing.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), F.coalesce(training, F.lit(False)).alias("training"))
    counts = stage(word_counts(rows.filter("training")), "hmm-counts")
    known, unigram, room = vocabulary(counts, settings)
    texts = sequences(rows, spark.sparkContext.broadcast((known, room)), settings)
    texts = stage(texts.withColumn("row", F.monotonically_increasing_id()), "hmm-texts")
    model = warm_model(texts, unigram, settings)
    for _ in range(settings.rounds):
        model = iterate(texts, model, unigram)
    shared = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "ids", ID_BYTES):
            logs = log_likelihoods(shared.value, *flat_ids(batch)) / LN10
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in kept] + [pa.array(logs)], [*kept, "path"])

    kept = ["row", "doc_id", "n_tokens", "known", "common_logs", "shared_logs"]
    paths = texts.select(*kept, "ids").mapInArrow(run, "row long, doc_id long, n_tokens long, known long, common_logs double, shared_logs double, path double")
    # Rare words meet their counts; a word that was never seen adds log10(0 + 1) = 0.
    rare = texts.select("row", F.inline("rare"))
    bar = max(int(np.ceil(known.tokens * settings.share)), 2)
    seen = rare.join(counts.filter(F.col("n") < bar), "word").groupBy("row").agg(
        F.sum(F.col("times") * F.log10(F.col("n") + F.lit(1.0))).alias("rare_logs"), F.sum("times").alias("rare_known")
    )
    each = log10(known.tokens + known.distinct + 1)
    found = paths.join(seen, "row", "left")
    common, rare_logs = F.col("common_logs"), F.coalesce("rare_logs", F.lit(0.0))
    return found.select(
        "doc_id",
        "n_tokens",
        (F.col("known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
        F.lit(known.tokens).cast("long").alias("train_tokens"),
        (common + rare_logs - F.lit(each) * F.col("n_tokens")).alias("base_score"),
        (F.col("path") + F.col("shared_logs") + rare_logs).alias("score"),
    )
