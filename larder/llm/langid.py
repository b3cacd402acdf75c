"""Language identification by cross-parsing entropy (Ziv and Merhav 1993).

For each language a suffix automaton holds all substrings of a sample of labelled text. A text is
parsed against it from left to right into longest matches; a phrase costs the logarithm of the
sample's length, and the language with the lowest cost a character, that is with the fewest
normalised phrases, wins.

The parse needs the automaton's transitions only: each character moves on, or ends a phrase and
starts the next at the root. Both are folded into one table, so many blocks of text are
parsed against all languages side by side, one look-up a character and language. Samples are
bounded (``Sample``), hence the tables are, and they are broadcast.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larder.llm.common import slices

#: Characters that a parsed block has at most; a phrase ends where its block ends.
BLOCK = 2048

#: Character classes: 0 is white space and everything that is no letter, the last one any letter outside the samples.
CLASSES = 64


@dataclass(frozen=True)
class Sample:
    """Bounds of what is learnt from: characters and documents per language, characters per document, languages."""

    chars: int = 40_000
    docs: int = 64
    doc_chars: int = 8_192
    languages: int = 200


@cache
def letters() -> np.ndarray:
    """For every code point whether it is a letter."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def code_points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts after one another, and the offset of each."""
    sizes = np.array([len(t) for t in texts], np.int64)
    flat = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    return flat, np.concatenate([[0], np.cumsum(sizes)])


def class_table(sample: str) -> np.ndarray:
    """Class of every code point: the commonest letters of the sample have their own, upper case goes with lower."""
    table = np.where(letters(), CLASSES - 1, 0).astype(np.uint8)
    flat = np.frombuffer(sample.lower().encode("utf-32-le"), np.uint32)
    seen, counts = np.unique(flat[letters()[flat]], return_counts=True)
    for k, c in enumerate(seen[np.argsort(-counts, kind="stable")][: CLASSES - 2].tolist(), 1):
        table[c] = k
        upper = chr(c).upper()
        if len(upper) == 1:
            table[ord(upper)] = k
    return table


def squeezed(classes: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Runs of class 0 become one, within each text."""
    keep = np.ones(len(classes), bool)
    keep[1:] = (classes[1:] != 0) | (classes[:-1] != 0)
    keep[offsets[:-1][offsets[:-1] < len(classes)]] = True
    before = np.concatenate([[0], np.cumsum(keep)])
    return classes[keep], before[offsets]


def suffix_automaton(text: np.ndarray) -> np.ndarray:
    """Transitions of the automaton, a row per state and a column per class; 0 is none (nothing leads to the root)."""
    size = 2 * len(text) + 2
    step = np.zeros((size, CLASSES), np.int32)
    rows = [step[0]]
    length, link, last, count = [0], [-1], 0, 1
    for c in text.tolist():
        new = count
        count += 1
        rows.append(step[new])
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and not rows[p][c]:
            rows[p][c] = new
            p = link[p]
        if p >= 0:
            q = int(rows[p][c])
            if length[q] == length[p] + 1:
                link[new] = q
            else:
                copy = count
                count += 1
                rows.append(step[copy])
                rows[copy][:] = rows[q]
                length.append(length[p] + 1)
                link.append(link[q])
                while p >= 0 and rows[p][c] == q:
                    rows[p][c] = copy
                    p = link[p]
                link[q] = link[new] = copy
        last = new
    return step[:count]


@dataclass
class Parser:
    """All languages' automata as one table; ``entry`` is where each begins, ``cost`` what a phrase costs."""

    languages: list[str]
    classes: np.ndarray
    moves: np.ndarray
    entry: np.ndarray
    cost: np.ndarray

    @staticmethod
    def build(samples: dict[str, str]) -> Parser:
        """From sample text per language."""
        languages = sorted(samples)
        classes = class_table("".join(samples[x] for x in languages))
        moves, entry, cost, base = [], [], [], 0
        for language in languages:
            flat, offsets = code_points([samples[language]])
            text, _ = squeezed(classes[flat], offsets)
            # A letter of no class of its own matches nothing.
            step = suffix_automaton(text[text != CLASSES - 1])
            missing = step == 0
            state = np.where(missing, step[0], step)
            ended = missing.astype(np.int32)
            ended += missing & (step[0] == 0)  # not even at the root: the character is a phrase
            ended[0] -= missing[0]  # at the root no phrase is open
            # Where to go on, in steps of the table's rows, and the phrases that ended, in the two low bits.
            moves.append(((base + state.astype(np.int64)) * CLASSES << 2 | ended).ravel())
            entry.append(base * CLASSES)
            cost.append(np.log2(max(len(text), 2)))
            base += len(step)
        flat = np.concatenate(moves) if moves else np.zeros(0, np.int64)
        return Parser(languages, classes, flat.astype(np.int32 if not len(flat) or flat.max() < 1 << 31 else np.int64), np.array(entry, np.int64), np.array(cost))

    def phrases(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Phrases of each text against each language, and the text's letters."""
        flat, offsets = code_points(texts)
        n, count = len(texts), np.zeros((len(texts), len(self.languages)), np.int64)
        letter = np.concatenate([[0], np.cumsum(self.classes[flat] != 0)])[offsets]
        codes, offsets = squeezed(self.classes[flat], offsets)
        sizes = np.diff(offsets)
        blocks = -(-sizes // BLOCK)
        owner = np.repeat(np.arange(n), blocks)
        inside = np.arange(len(owner)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
        length = np.minimum(sizes[owner] - inside * BLOCK, BLOCK)
        if not len(owner) or not self.languages:
            return count, np.diff(letter)
        order = np.argsort(-length, kind="stable")
        grid = np.zeros((len(owner), int(length.max())), np.uint8)
        grid[np.arange(grid.shape[1]) < length[:, None]] = codes
        grid = np.ascontiguousarray(grid[order].T)
        active = np.searchsorted(-length[order], -np.arange(grid.shape[0]), side="left")
        at = np.tile(self.entry.astype(self.moves.dtype), (len(owner), 1))
        found = np.zeros(at.shape, np.int32)
        for row, m in zip(grid, active.tolist()):
            move = self.moves.take(at[:m] + row[:m, None])
            found[:m] += move & 3
            np.right_shift(move, 2, out=at[:m])
        found += at != self.entry  # the phrase that is still open
        np.add.at(count, owner[order], found)
        return count, np.diff(letter)

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        """Language and score of each text; ``und`` and 0 without a letter.

        The score weighs the best language's cost against the second best's: 0.5 if equal, towards 1 the further apart.
        """
        count, letter = self.phrases(texts)
        if not self.languages:
            return ["und"] * len(texts), np.zeros(len(texts))
        cost = count * self.cost
        best = cost.argmin(axis=1)
        if cost.shape[1] > 1:
            first, second = np.partition(cost, 1, axis=1)[:, :2].T
            score = 1 / (1 + (first / np.maximum(second, 1e-9)) ** 4)
        else:
            score = np.ones(len(texts))
        some = letter > 0
        return [self.languages[k] if s else "und" for k, s in zip(best.tolist(), some.tolist())], np.where(some, score, 0.0)


def sample_texts(docs: DataFrame, sample: Sample, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> dict[str, str]:
    """Sample text per language: whole documents in the order of a hash of their id, up to ``sample.chars`` characters.

    Documents longer than ``sample.doc_chars`` are not learnt from.
    """
    lang = F.col(lang_col).cast("string")
    known = docs.filter(lang.isNotNull() & F.col(text_col).isNotNull() & (F.length(text_col) <= sample.doc_chars))
    known = known.select(lang.alias("lang"), F.col(text_col).alias("text"), F.xxhash64(id_col).alias("_h"))
    counts = known.groupBy("lang").count().limit(sample.languages + 1).collect()
    if len(counts) > sample.languages:
        raise ValueError(f"more than {sample.languages} languages")
    if not counts:
        return {}
    # About twice the documents wanted, by a threshold per language, so that the order is taken over few rows.
    share = F.lit(0.0)
    for r in counts:
        share = F.when(F.col("lang") == r["lang"], F.lit(2.0 * sample.docs / r["count"])).otherwise(share)
    drawn = known.filter(F.pmod("_h", F.lit(1 << 20)) < share * (1 << 20))
    drawn = drawn.groupBy("lang", "_h").agg(F.min("text").alias("text"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy("_h"))
    chosen: dict[str, str] = {}
    for r in sorted(drawn.withColumn("place", place).filter(F.col("place") <= sample.docs).collect(), key=lambda r: (r["lang"], r["place"])):
        text = chosen.get(r["lang"], "")
        if len(text) < sample.chars:
            chosen[r["lang"]] = text + r["text"] + " "
    return {lang: text[: sample.chars] for lang, text in chosen.items()}


def identified(
    docs: DataFrame,
    usable: Column | None = None,
    sample: Sample = Sample(),
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
) -> DataFrame:
    """``doc_id, lang_pred, score`` for every row, learnt from rows where ``usable`` holds and the language is known.

    A null text, and one without letters, gets ``und`` and 0; so does every text if there is nothing to learn
    from. Ties go to the language that comes first. Language and id are never used to predict.
    """
    known = docs if usable is None else docs.filter(usable)
    parser = Parser.build(sample_texts(known, sample, id_col, text_col, lang_col))
    model = docs.sparkSession.sparkContext.broadcast(parser)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            texts = [t or "" for t in batch.column("text").to_pylist()]
            lang, score = model.value.predict(texts)
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), "lang_pred": pa.array(lang, pa.string()), "score": pa.array(score, pa.float64())})

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "doc_id long, lang_pred string, score double")
