"""Byte-pair encoding with a segment tree over adjacent pair ranks.

A piece of text starts as single symbols. A segment tree over its adjacent pairs holds for each the
rank of its merge and its place; the root is the leftmost pair of lowest rank. A merge changes three
leaves at most, each with a walk to the root, until the root holds no merge.

Pieces of up to ``WIDE`` symbols are encoded many at a time, their trees side by side in numpy
arrays; longer ones have a tree of their own. Spark spreads the documents; a worker keeps the
ids of the words it meets, in flat arrays and from task to task (bounded by ``MEMORY_WORDS``, the commonest
stay), so a word costs its tree once. Decoded text is taken from the ids by one gather.

The vocabulary file is read on the driver and broadcast: it has a fixed size.
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Iterator
from functools import cached_property
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.llm.common import Memory, coded_words, ranges, slices, utf8

#: Symbols up to which pieces share arrays; words that a worker remembers, and how long these may be.
WIDE, MEMORY_WORDS, MEMORY_LENGTH = 64, 400_000, 64

#: No merge: above every rank.
NONE = np.int64(1) << 60


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    symbol = {b: chr(b) for b in plain}
    for k, b in enumerate(b for b in range(256) if b not in symbol):
        symbol[b] = chr(256 + k)
    return [symbol[b] for b in range(256)]


class Bpe:
    """An encoder made from a ``tokenizers`` file with a byte-level BPE model, NFC and lower case.

    Special tokens in a text become their ids; other white space than inside them is dropped.
    """

    def __init__(self, definition: str):
        spec = json.loads(definition)
        model = spec["model"]
        self.vocab: dict[str, int] = model["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.names = {i: t for t, i in self.vocab.items()} | {i: t for t, i in self.special.items()}
        split = spec["pre_tokenizer"]["pretokenizers"][0]
        self.pieces = regex.compile(split["pattern"]["Regex"])
        # Then a word of letters alone is one piece.
        self.letter_runs = r"[\p{L}]+" in split["pattern"]["Regex"]
        self.specials = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None
        end = model["end_of_word_suffix"] or ""
        symbols = byte_symbols()
        self.inner = np.array([self.vocab[s] for s in symbols])
        self.last = np.array([self.vocab[s + end] for s in symbols])
        size = max(self.vocab.values()) + 1
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        keys = np.array([self.vocab[a] * size + self.vocab[b] for a, b in pairs], np.int64)
        order = np.argsort(keys, kind="stable")
        self.size, self.keys, self.ranks = size, keys[order], order.astype(np.int64)
        self.merged = np.array([self.vocab[a + b] for a, b in pairs], np.int64)
        self.memory = Memory(MEMORY_WORDS)
        # The text of each id with a space after it, as it is decoded.
        texts = [(self.names[i] + " ").encode() if i in self.names else b"" for i in range(max(self.names) + 1)]
        self.text_lengths = np.array([len(t) for t in texts], np.int64)
        self.text_starts = np.cumsum(self.text_lengths) - self.text_lengths
        self.text_bytes = np.frombuffer(b"".join(texts), np.uint8)

    @cached_property
    def rank_of(self) -> dict[int, int]:
        """Rank by pair key, for trees of their own."""
        return dict(zip(self.keys.tolist(), self.ranks.tolist()))

    def pair_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of the pairs' merges, ``NONE`` where there is none (a side of -1 is no symbol)."""
        key = left * self.size + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where((self.keys[at] == key) & (left >= 0) & (right >= 0), self.ranks[at], NONE)

    def encode_long(self, symbols: list[int]) -> list[int]:
        """One piece with a tree of its own."""
        n = len(symbols)
        width = 1
        while width < n - 1:
            width *= 2
        none, rank_of, size = (int(NONE), -1), self.rank_of, self.size
        rank = lambda a, b: rank_of.get(symbols[a] * size + symbols[b], int(NONE))
        tree = [none] * (2 * width)
        for k in range(n - 1):
            tree[width + k] = (rank(k, k + 1), k)
        for k in range(width - 1, 0, -1):
            tree[k] = min(tree[2 * k], tree[2 * k + 1])
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))

        def put(place: int, value: tuple[int, int]) -> None:
            place += width
            tree[place] = value
            while place > 1:
                place //= 2
                tree[place] = min(tree[2 * place], tree[2 * place + 1])

        while n > 1 and tree[1][0] < NONE:
            lowest, k = tree[1]
            gone = after[k]
            symbols[k], after[k] = int(self.merged[lowest]), after[gone]
            if after[k] < n:
                before[after[k]] = k
            put(gone, none) if gone < n - 1 else None
            put(k, (rank(k, after[k]), k) if after[k] < n else none)
            if before[k] >= 0:
                put(before[k], (rank(before[k], k), before[k]))
        out, k = [], 0
        while k < n:
            out.append(symbols[k])
            k = after[k]
        return out

    def encode_many(self, symbols: np.ndarray) -> list[list[int]]:
        """Pieces as rows of symbols, padded with -1: all trees take a step together."""
        rows, width = symbols.shape[0], 1
        while width < symbols.shape[1] - 1:
            width *= 2
        n = symbols.shape[1]
        place = np.arange(n)
        after = np.tile(np.append(place[1:], n), (rows, 1))
        before = np.tile(place - 1, (rows, 1))
        room = np.full((rows, n + 1), -1, np.int64)  # a last column that never holds a symbol
        room[:, :n] = symbols
        tree = np.full((rows, 2 * width), NONE, np.int64)
        code = lambda ranks, at: np.where(ranks < NONE, ranks << 7 | at, NONE)
        if n > 1:
            tree[:, width : width + n - 1] = code(self.pair_ranks(room[:, : n - 1], room[:, 1:n]), place[: n - 1])
        for k in range(width - 1, 0, -1):
            np.minimum(tree[:, 2 * k], tree[:, 2 * k + 1], out=tree[:, k])

        def put(row: np.ndarray, at: np.ndarray, value: np.ndarray) -> None:
            at = at + width
            tree[row, at] = value
            while len(at) and at[0] > 1:  # all leaves are equally deep
                at = at >> 1
                tree[row, at] = np.minimum(tree[row, 2 * at], tree[row, 2 * at + 1])

        row = np.flatnonzero(tree[:, 1] < NONE)
        while len(row):
            root = tree[row, 1]
            k = root & 127
            gone = after[row, k]
            far = after[row, gone]
            room[row, k] = self.merged[root >> 7]
            room[row, gone] = -1
            after[row, k] = far
            has = far < n
            before[row[has], far[has]] = k[has]
            leaf = gone < n - 1
            put(row[leaf], gone[leaf], np.full(int(leaf.sum()), NONE))
            put(row, k, code(self.pair_ranks(room[row, k], room[row, far]), k))
            prior = before[row, k]
            has = prior >= 0
            put(row[has], prior[has], code(self.pair_ranks(room[row[has], prior[has]], room[row[has], k[has]]), prior[has]))
            row = row[tree[row, 1] < NONE]
        room = room[:, :n]
        kept = room >= 0
        flat, stops = room[kept].tolist(), np.cumsum(kept.sum(axis=1)).tolist()
        return [flat[a:b] for a, b in zip([0, *stops], stops)]

    def encode_pieces(self, pieces: list[bytes]) -> list[list[int]]:
        """Ids of each piece."""
        out: list[list[int]] = [[]] * len(pieces)
        sizes = np.array([len(p) for p in pieces])
        low = 0
        for high in (1, 2, 3, 5, 9, 17, 33, WIDE):
            some = np.flatnonzero((sizes > low) & (sizes <= high))
            low = high
            if len(some):
                data = np.frombuffer(b"".join(pieces[k] for k in some), np.uint8)
                stops = np.cumsum(sizes[some])
                symbols = np.full((len(some), high), -1, np.int64)
                symbols[np.arange(high) < sizes[some][:, None]] = self.inner[data]
                symbols[np.arange(len(some)), sizes[some] - 1] = self.last[data[stops - 1]]
                for k, ids in zip(some.tolist(), self.encode_many(symbols)):
                    out[k] = ids
        for k in np.flatnonzero(sizes > WIDE).tolist():
            data = np.frombuffer(pieces[k], np.uint8)
            out[k] = self.encode_long([*self.inner[data[:-1]].tolist(), int(self.last[data[-1]])])
        return out

    def split(self, text: str) -> list[bytes | int]:
        """Pieces of a text in order; a special token is its id."""
        out: list[bytes | int] = []
        for part in self.specials.split(text) if self.specials else [text]:
            if part in self.special:
                out.append(self.special[part])
            else:
                # Lower case goes character by character: no final form of sigma.
                part = unicodedata.normalize("NFC", part).replace("Σ", "σ").lower()
                out.extend(p.encode() for p in self.pieces.findall(part))
        return out

    def split_words(self, words: list[bytes]) -> list[list[str | int]]:
        """:meth:`split` of words, normalised together: a line break composes with nothing. Words with ``<`` may hold special tokens."""
        plain = [w for w in words if b"<" not in w]
        text = b"\n".join(plain).decode()
        if not text.isascii():
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
        find = self.pieces.findall
        if self.letter_runs:
            found = iter([[w] if w.isalpha() else find(w) for w in text.lower().split("\n")])
        else:
            found = map(find, text.lower().split("\n"))
        return [next(found) if b"<" not in w else [p if isinstance(p, int) else p.decode() for p in self.split(w.decode())] for w in words]

    def word_ids(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words after one another, and how many each has."""
        split = self.split_words(words)
        count = np.fromiter(map(len, split), np.int64, len(split))
        place = {p: k for k, p in enumerate(dict.fromkeys(chain.from_iterable(split)))}
        texts = [p for p in place if isinstance(p, str)]
        encoded_texts = iter(self.encode_pieces([p.encode() for p in texts]))
        ids = [next(encoded_texts) if isinstance(p, str) else [p] for p in place]
        each = np.fromiter(map(len, ids), np.int64, len(ids))
        flat = np.fromiter(chain.from_iterable(ids), np.int32, int(each.sum()))
        code = np.fromiter(map(place.__getitem__, chain.from_iterable(split)), np.int64, int(count.sum()))
        lengths = np.bincount(np.repeat(np.arange(len(split)), count), each[code], minlength=len(split)).astype(np.int64)
        return flat[ranges((np.cumsum(each) - each)[code], each[code])], lengths

    def encode_words(self, code: np.ndarray, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of a sequence of words, given as numbers in the distinct ``words``; and how many each member of the sequence has."""
        number = self.memory.find(words)
        new = np.flatnonzero(number < 0)
        fresh = [words[k] for k in new.tolist()]
        flat, lengths = self.word_ids(fresh)
        # Long words are encoded, not remembered.
        keep = np.fromiter(map(len, fresh), np.int64, len(fresh)) <= MEMORY_LENGTH
        number[new[keep]] = self.memory.add([w for w, k in zip(fresh, keep.tolist()) if k], flat[np.repeat(keep, lengths)], lengths[keep])
        first, count = self.memory.start[number], self.memory.length[number]
        spare = flat[np.repeat(~keep, lengths)]
        first[new[~keep]] = self.memory.filled + np.cumsum(lengths[~keep]) - lengths[~keep]
        count[new[~keep]] = lengths[~keep]
        table = np.concatenate([self.memory.flat[: self.memory.filled], spare]) if len(spare) else self.memory.flat
        return table[ranges(first[code], count[code])], count[code]

    def encode(self, text: str) -> list[int]:
        """Ids of one text."""
        found, parts = [], self.split(text)
        for part in parts:
            found.extend(self.encode_pieces([part])[0] if isinstance(part, bytes) else [part])
        return found

    def decode(self, ids: list[int]) -> str:
        """The tokens of the ids, spaced: the vocabulary has no decoder of its own."""
        return " ".join(self.names[i] for i in ids if i in self.names)


_loaded: dict[int, Bpe] = {}


def encoded(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", packed: bool = True) -> DataFrame:
    """``doc_id, ids, decoded`` of every whole text: ids as little-endian unsigned 32-bit integers in one binary value.

    Without ``packed`` the ids are an array. A null text counts as empty and has no ids; repeated rows get equal
    results. White space separates words, so words are encoded one by one.
    """
    with open(path, encoding="utf-8") as file:
        definition = docs.sparkSession.sparkContext.broadcast(file.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = hash(path)
        if key not in _loaded:
            _loaded[key] = Bpe(definition.value)
        model = _loaded[key]
        for batch in slices(batches, "text"):
            code, words, doc = coded_words(*utf8(batch.column("text")))
            ids, each = model.encode_words(code, words.to_pylist())
            counts = np.bincount(doc, each, minlength=batch.num_rows).astype(np.int64)
            stops = np.concatenate([[0], np.cumsum(counts)])
            lengths = model.text_lengths[ids]
            data = model.text_bytes[ranges(model.text_starts[ids], lengths)]
            text_stops = np.concatenate([[0], np.cumsum(lengths)])[stops]
            # The space after a text's last token goes.
            kept = np.ones(len(data), bool)
            kept[text_stops[1:][counts > 0] - 1] = False
            text_stops = text_stops - np.concatenate([[0], np.cumsum(counts > 0)])
            decoded = pa.LargeStringArray.from_buffers(batch.num_rows, pa.py_buffer(text_stops), pa.py_buffer(data[kept])).cast(pa.string())
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), "ids": _packed(ids, stops) if packed else _lists(ids, stops), "decoded": decoded})

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, f"doc_id long, ids {'binary' if packed else 'array<int>'}, decoded string")


def _packed(ids: np.ndarray, stops: np.ndarray) -> pa.Array:
    """Ids of each text as little-endian unsigned 32-bit integers in one value."""
    data = pa.py_buffer(ids.astype("<u4"))
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(stops) - 1, [None, pa.py_buffer(4 * stops), data]).cast(pa.binary())


def _lists(ids: np.ndarray, stops: np.ndarray) -> pa.Array:
    """Ids of each text as a list."""
    return pa.ListArray.from_arrays(pa.array(stops, pa.int32()), pa.array(ids.astype(np.int32)))
