"""Text and join helpers shared by the operators of this package.

Texts reach Python as Arrow batches. The helpers work on the UTF-8 buffers of a whole
batch at once, so that a word costs a few numpy steps and no Python call. ``slices``
bounds how much text one step holds: a batch is cut by bytes, between documents only.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The six white space bytes that end a word: everything outside ``[^\x20\x09-\x0D]``.
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True

#: A-Z to a-z, every other byte as it is.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

#: Text that one vectorised step holds, in bytes; a longer document is a step of its own.
SLICE_BYTES = 2 << 20


def modest_batches(spark: SparkSession) -> None:
    """Hand whole texts to Python 2000 rows at a time, unless the session says otherwise: the usual 10,000 may be 100 MB."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(name) == "10000":
        spark.conf.set(name, "2000")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the test folder."""
    modest_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def crc_mod(doc_id: Column, n: int) -> Column:
    """crc32 of the id written as text, modulo ``n``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % n


def column_of(batch: pa.RecordBatch, path: str) -> pa.Array:
    """A column, or with a dot and a number that field of a struct column."""
    name, _, place = path.partition(".")
    return batch.column(name).field(int(place)) if place else batch.column(name)


def slices(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches, cut between rows so that each holds about ``limit`` bytes of ``column``."""
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(column_of(batch, column)), 0).to_numpy(zero_copy_only=False)
        part = np.cumsum(lengths, dtype=np.int64) // limit
        cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            if b > a:
                yield batch.slice(a, b - a)


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts after one another, and the offset at which each begins (and the end). Null is empty."""
    column = pc.fill_null(column, "").cast(pa.large_string())
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and document of every word; a word never crosses documents."""
    n = len(data)
    if not n:
        empty = np.zeros(0, np.int64)
        return empty, empty, empty
    inside = ~SPACE[data]
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    before = np.empty(n, bool)
    before[0], before[1:] = True, ~inside[:-1]
    after = np.empty(n, bool)
    after[-1], after[:-1] = True, ~inside[1:]
    starts = np.flatnonzero(inside & (before | edge[:-1]))
    ends = np.flatnonzero(inside & (after | edge[1:])) + 1
    return starts, ends, np.searchsorted(offsets, starts, side="right") - 1


def word_array(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The words as one Arrow array of binary values."""
    lengths = ends - starts
    offsets = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(lengths, out=offsets[1:])
    marks = np.zeros(len(data) + 1, np.int8)
    marks[starts] += 1
    np.subtract.at(marks, ends, 1)
    kept = data[np.cumsum(marks[:-1], dtype=np.int8).astype(bool)]
    return pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(kept))]
    )


def coded_words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """Per word its number in the dictionary of distinct words; the dictionary; the document of each word."""
    starts, ends, doc = word_spans(data, offsets)
    coded = word_array(data, starts, ends).dictionary_encode()
    return coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary, doc


def spaced_words(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[bytes, np.ndarray, np.ndarray]:
    """The words with exactly one space after each, and where each then starts and ends."""
    lengths = ends - starts
    stop = np.cumsum(lengths + 1) - 1
    out = np.full(int(stop[-1]) + 1 if len(stop) else 0, 0x20, np.uint8)
    room = np.ones(len(out), bool)
    room[stop] = False
    words = word_array(data, starts, ends)
    raw = words.buffers()[2]
    out[room] = np.frombuffer(raw, np.uint8) if len(starts) else 0
    return out.tobytes(), stop - lengths, stop


def per_doc(doc: np.ndarray, n: int, weights: np.ndarray | None = None) -> np.ndarray:
    """Sum per document."""
    return np.bincount(doc, weights, minlength=n)


def lookup(left: DataFrame, right: DataFrame, key: str, copies: str, total: int) -> DataFrame:
    """Inner join on ``key`` where ``right`` has one row per key, with the number of left rows in ``copies``.

    A key with at least a thousandth of all ``total`` rows is hot; there are at most a thousand,
    so those rows of ``right`` are broadcast. What remains is spread evenly enough for a shuffle.
    """
    bar = max(total // 1000, 1000)
    hot, rest = right.filter(F.col(copies) >= bar), right.filter(F.col(copies) < bar)
    keys = F.broadcast(hot.select(key))
    return left.join(F.broadcast(hot), key).unionByName(left.join(keys, key, "left_anti").join(rest, key))


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The numbers of all ranges after one another."""
    stops = np.cumsum(lengths)
    return np.arange(int(stops[-1]) if len(stops) else 0) + np.repeat(starts - stops + lengths, lengths)


class Memory:
    """Runs of ids by piece of text, in flat arrays. When it is full, the half that was met in the fewest batches goes."""

    def __init__(self, limit: int):
        self.limit, self.place = limit, {}
        self.start, self.length, self.met = (np.zeros(1024, np.int64) for _ in range(3))
        self.flat, self.filled = np.zeros(4096, np.int32), 0

    def find(self, pieces: list[bytes]) -> np.ndarray:
        """Number of each piece, -1 for new ones. Pieces are distinct."""
        if len(self.place) > self.limit:
            self._forget()
        found = np.fromiter(map(self.place.get, pieces, repeat(-1)), np.int64, len(pieces))
        self.met[found[found >= 0]] += 1
        return found

    def add(self, pieces: list[bytes], flat: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Numbers of new pieces; their ids lie after one another in ``flat``."""
        n, more = len(self.place), len(pieces)
        while n + more > len(self.start):
            self.start, self.length, self.met = (np.concatenate([a, np.zeros_like(a)]) for a in (self.start, self.length, self.met))
        while self.filled + len(flat) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        self.place.update(zip(pieces, range(n, n + more)))
        self.start[n : n + more] = self.filled + np.cumsum(lengths) - lengths
        self.length[n : n + more], self.met[n : n + more] = lengths, 1
        self.flat[self.filled : self.filled + len(flat)] = flat
        self.filled += len(flat)
        return np.arange(n, n + more)

    def ids(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the pieces after one another, and how many each has."""
        lengths = self.length[numbers]
        return self.flat[ranges(self.start[numbers], lengths)], lengths

    def _forget(self) -> None:
        n, names = len(self.place), list(self.place)
        kept = np.sort(np.argpartition(-self.met[:n], self.limit // 2)[: self.limit // 2])
        flat, lengths = self.ids(kept)
        met = self.met[kept]
        self.__init__(self.limit)
        self.add([names[k] for k in kept.tolist()], flat, lengths)
        self.met[: len(met)] = met // 2
