"""Byte-level BPE with vectorised pre-tokenisation.

A text is cut into pieces (a contraction; letters, digits or other signs with a space before them; white space) without
a regular expression. Each code point has a class, in which what must be known of the next two code points is already
folded. A class is a function from the states of an automaton to its states; functions compose associatively, so the
texts of a whole batch are cut into stretches that are scanned side by side: the function of each prefix of a stretch
is a number in the automaton's transition monoid, whose composition table is small and built once. Where a piece
begins follows from the state before a code point and its class.

Pieces then lie end to end in the batch's bytes, so they are slices of it. Equal ones are folded, and only pieces
that the worker has not met are merged: many at a time as rows of arrays, long ones with a heap. Token lengths
give the offsets from which ids are decoded.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.llm.common import Memory, ranges, slices, utf8

#: Symbols of a piece that is merged as a row of an array; pieces that a worker remembers, and how long these may be.
WIDE, MEMORY_PIECES, MEMORY_LENGTH = 32, 400_000, 64

#: Above every rank.
NONE = np.int64(1) << 40

# Classes of code points. An apostrophe is CUT_1 or CUT_2 if the one or two letters after it make a contraction; white space
# is INNER unless something else follows, then SPACE (the plain one) or OTHER_SPACE.
LETTER, NUMBER, SIGN, CUT_1, CUT_2, INNER, SPACE, OTHER_SPACE = range(8)
CLASSES = 8

# States: between pieces; in letters, numbers, signs; after a space that the next piece takes; in white space; one or two letters of a
# contraction to come.
OUT, IN_LETTERS, IN_NUMBERS, IN_SIGNS, AFTER_SPACE, IN_SPACE, ONE_MORE, TWO_MORE = range(8)
STATES = 8

#: Code points that the ``regex`` module's Unicode tables hold as letters or numbers and those of the rank file's library (Unicode 16)
#: do not (fixed values).
NEWER = """
558 58b-58c 88f c5c cdc 208f 209d-209f a7ce-a7cf a7d2 a7d4 a7dd a7e2 a7f1 ab6c-ab6d 107bb-107bf 10940-10959 10ec5-10ec7 10ed9-10eee
11b0a 11db0-11ddb 11de0-11de9 11df1 1246f 12475-1247f 12550-12686 16ea0-16eb8 16ebb-16ed3 16ff2-16ff3 16ff4-16ff6 187f8-187ff
18cd6-18cda 18d09-18d20 18d80-18df2 18e00-19191 191a0-191d2 1b123-1b128 1b168 1d6a6 1df1f-1df24 1df2b-1df81 1df90-1df96
1dfcd-1dfff 1e6c0-1e6de 1e6e0-1e6e2 1e6e4-1e6e5 1e6e7-1e6ed 1e6f0-1e6f4 1e6fe-1e6ff 2b73a-2b73f 2b81e 2cea2-2cead 323b0-33479
3d000-3fc3f
"""

#: Letters after an apostrophe (fixed values of the pattern).
SHORT_ENDINGS, LONG_ENDINGS = ("s", "t", "m", "d"), ("re", "ve", "ll")


def _automaton() -> tuple[np.ndarray, np.ndarray]:
    """Next state and whether a piece begins, by state and class."""
    step, begins = np.zeros((STATES, CLASSES), np.int64), np.ones((STATES, CLASSES), bool)
    step[:, LETTER], step[:, NUMBER], step[:, SIGN] = IN_LETTERS, IN_NUMBERS, IN_SIGNS
    step[:, CUT_1], step[:, CUT_2] = ONE_MORE, TWO_MORE
    step[:, INNER], step[:, SPACE], step[:, OTHER_SPACE] = IN_SPACE, AFTER_SPACE, OUT
    for state, kind in ((IN_LETTERS, LETTER), (IN_NUMBERS, NUMBER), (IN_SPACE, INNER)):
        begins[state, kind] = False
    begins[AFTER_SPACE, [LETTER, NUMBER]] = False
    for state in (IN_SIGNS, AFTER_SPACE):  # an apostrophe among signs opens no contraction
        begins[state, [SIGN, CUT_1, CUT_2]] = False
        step[state, [CUT_1, CUT_2]] = IN_SIGNS
    step[TWO_MORE, LETTER], step[ONE_MORE, LETTER] = ONE_MORE, OUT
    begins[[TWO_MORE, ONE_MORE], LETTER] = False
    return step, begins


class Monoid:
    """The functions that sequences of classes make of the states, as numbers, and how they compose.

    A class with ``CLASSES`` added is one that begins a text: whatever the state, it acts as from ``OUT``.
    """

    def __init__(self) -> None:
        step, begins = _automaton()
        self.begins = begins
        acts = [tuple(step[:, c].tolist()) for c in range(CLASSES)] + [(int(step[OUT, c]),) * STATES for c in range(CLASSES)]
        known = {tuple(range(STATES)): 0}
        order, table = [tuple(range(STATES))], []
        for f in order:  # grows while new functions turn up
            row = []
            for act in acts:
                g = tuple(act[s] for s in f)
                if g not in known:
                    known[g] = len(order)
                    order.append(g)
                row.append(known[g])
            table.append(row)
        #: Function number and class to the number of the function that does both.
        self.then = np.array(table, np.int16)
        #: Function number and state to state.
        self.value = np.array(order, np.int8)
        self.compose = np.array([[known[tuple(g[s] for s in f)] for g in order] for f in order], np.int16)

    def states_before(self, classes: np.ndarray) -> np.ndarray:
        """State before each class of the sequence, from ``OUT`` on."""
        n = len(classes)
        width = max(int(n**0.5), 1)
        rows = -(-n // width)
        # Stretches are columns: a step of the scan is one row of the array.
        padded = np.zeros(rows * width, np.uint8)
        padded[:n] = classes
        side = np.ascontiguousarray(padded.reshape(rows, width).T)
        prefix = np.zeros((width + 1, rows), np.int16)
        for k in range(width):
            prefix[k + 1] = self.then[prefix[k], side[k]]
        # The stretches' own functions, composed in doubling steps.
        entry, gap = prefix[width].copy(), 1
        while gap < rows:
            entry[gap:] = self.compose[entry[:-gap], entry[gap:]]
            gap *= 2
        start = np.zeros(rows, np.int16)
        start[1:] = entry[:-1]
        state = self.value[prefix[:width], self.value[start, OUT][None, :]]
        return state.T.ravel()[:n]


MONOID = Monoid()


def _class_table() -> np.ndarray:
    """LETTER, NUMBER, SIGN or INNER for every code point."""
    table = np.full(0x110000, SIGN, np.uint8)
    points = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    for kind, name in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+")):
        for m in regex.finditer(name, points):
            a, b = ord(points[m.start()]), ord(points[m.end() - 1])
            table[a : b + 1] = kind
    for span in NEWER.split():
        first, _, last = span.partition("-")
        table[int(first, 16) : int(last or first, 16) + 1] = SIGN
    table[0xD800:0xE000] = SIGN
    for k in [*range(9, 14), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]:
        table[k] = INNER  # the White_Space property (fixed values)
    return table


_tables: dict[str, np.ndarray] = {}


def classes_of(points: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Class of every code point of texts after one another; ``first`` marks where texts begin, which adds ``CLASSES``."""
    if "classes" not in _tables:
        _tables["classes"] = _class_table()
    kind = _tables["classes"][points]
    n = len(points)
    ends = np.ones(n, bool)  # nothing of the same text follows
    ends[:-1] = first[1:]
    space = kind == INNER
    followed = np.zeros(n, bool)
    followed[:-1] = ~space[1:]
    last = np.flatnonzero(space & followed & ~ends)
    kind[last] = np.where(points[last] == 0x20, SPACE, OTHER_SPACE)
    mark = np.flatnonzero(points == 0x27)
    if len(mark):
        one, two = np.minimum(mark + 1, n - 1), np.minimum(mark + 2, n - 1)
        has_one = ~ends[mark]
        has_two = has_one & ~ends[one]
        short = has_one & np.isin(points[one], [ord(x) for x in SHORT_ENDINGS])
        long = np.zeros(len(mark), bool)
        for a, b in LONG_ENDINGS:
            long |= has_two & (points[one] == ord(a)) & (points[two] == ord(b))
        kind[mark[short]], kind[mark[long]] = CUT_1, CUT_2
    return kind + CLASSES * first.astype(np.uint8)


def piece_starts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Byte places at which pieces begin in texts after one another."""
    if not len(data):
        return np.zeros(0, np.int64)
    place = np.flatnonzero((data & 0xC0) != 0x80)
    if len(place) == len(data):
        points = data
    else:
        points = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32)
    begin = np.zeros(len(data) + 1, bool)
    begin[offsets] = True
    classes = classes_of(points, begin[place])
    state = MONOID.states_before(classes)
    kind = classes % CLASSES
    return place[MONOID.begins[state, kind] | (classes >= CLASSES)]


class ByteBpe:
    """Ranks of byte strings, as a rank file lists them: base64 and rank per line."""

    def __init__(self, lines: bytes):
        self.rank = {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines.splitlines() if line)}
        size = max(self.rank.values()) + 1
        token = [b""] * size
        for text, k in self.rank.items():
            token[k] = text
        self.lengths = np.array([len(t) for t in token], np.int64)
        self.offsets = np.cumsum(self.lengths) - self.lengths
        self.bytes = np.frombuffer(b"".join(token), np.uint8)
        self.single = np.array([self.rank[bytes([k])] for k in range(256)], np.int64)
        self.size = size
        # Any two tokens that make a token merge to it, and the token's number is the merge's rank.
        keys, merged = [], []
        rank = self.rank
        for text, k in rank.items():
            for cut in range(1, len(text)):
                a, b = rank.get(text[:cut]), rank.get(text[cut:])
                if a is not None and b is not None:
                    keys.append(a * size + b)
                    merged.append(k)
        order = np.argsort(keys)
        self.keys, self.merged = np.array(keys, np.int64)[order], np.array(merged, np.int64)[order]
        self.memory = Memory(MEMORY_PIECES)

    @cached_property
    def merge_of(self) -> dict[int, int]:
        """Merge by pair key, for long pieces."""
        return dict(zip(self.keys.tolist(), self.merged.tolist()))

    def pair_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of the pairs' merges, ``NONE`` where there is none (-1 is no symbol)."""
        key = left * self.size + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where((self.keys[at] == key) & (left >= 0) & (right >= 0), self.merged[at], NONE)

    def merge_rows(self, symbols: np.ndarray) -> list[tuple[int, ...]]:
        """Rows of symbols, padded with -1: each step merges the leftmost pair of lowest rank in every row that has one."""
        rows, width = symbols.shape
        out = symbols.copy()
        now = np.arange(rows)
        pairs = self.pair_ranks(symbols[:, :-1], symbols[:, 1:]) if width > 1 else np.zeros((rows, 0), np.int64)
        place = np.arange(width)
        while len(now) and pairs.shape[1]:
            best = pairs.argmin(axis=1)
            lowest = pairs[np.arange(len(now)), best]
            go = lowest < NONE
            out[now[~go]] = symbols[~go]
            now, symbols, pairs, best, lowest = now[go], symbols[go], pairs[go], best[go], lowest[go]
            if not len(now):
                return _rows(out)
            line = np.arange(len(now))
            symbols[line, best] = lowest
            # The symbol after the merged one goes; what is right of it moves up.
            from_place = np.minimum(place + (place > best[:, None]), width - 1)
            symbols = np.take_along_axis(symbols, from_place, axis=1)
            symbols[:, -1] = -1
            pairs = np.take_along_axis(pairs, np.minimum(place[:-1] + (place[:-1] > best[:, None]), width - 2), axis=1)
            pairs[:, -1] = NONE
            right = np.minimum(best + 1, width - 1)
            pairs[line, np.minimum(best, width - 2)] = np.where(
                best < width - 1, self.pair_ranks(symbols[line, best], np.where(best < width - 1, symbols[line, right], -1)), NONE
            )
            has = best > 0
            pairs[line[has], best[has] - 1] = self.pair_ranks(symbols[line[has], best[has] - 1], symbols[line[has], best[has]])
        out[now] = symbols
        return _rows(out)

    def merge_long(self, piece: bytes) -> tuple[int, ...]:
        """One piece with a heap of pairs; what a merge has overtaken is passed over when it comes up."""
        symbols = self.single[np.frombuffer(piece, np.uint8)].tolist()
        n, size, merge = len(symbols), self.size, self.merge_of
        after, before, alive = list(range(1, n + 1)), list(range(-1, n - 1)), [True] * n
        heap = [(merge[key], k) for k in range(n - 1) if (key := symbols[k] * size + symbols[k + 1]) in merge]
        heapq.heapify(heap)
        while heap:
            rank, k = heapq.heappop(heap)
            gone = after[k]
            if not alive[k] or gone >= n or merge.get(symbols[k] * size + symbols[gone]) != rank:
                continue
            symbols[k], alive[gone], after[k] = rank, False, after[gone]
            if after[k] < n:
                before[after[k]] = k
            for a, b in ((before[k], k), (k, after[k])):
                if a >= 0 and b < n and (found := merge.get(symbols[a] * size + symbols[b])) is not None:
                    heapq.heappush(heap, (found, a))
        return tuple(s for s, there in zip(symbols, alive) if there)

    def merged_ids(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the pieces after one another, and how many each has. A piece that is a token is one id."""
        found: list[tuple[int, ...]] = [()] * len(pieces)
        sizes = np.array(list(map(len, pieces)), np.int64)
        whole = np.fromiter((self.rank.get(p, -1) for p in pieces), np.int64, len(pieces))
        for k in np.flatnonzero(whole >= 0).tolist():
            found[k] = (int(whole[k]),)
        low = 0
        for high in (4, 8, 12, 16, 24, WIDE):
            some = np.flatnonzero((whole < 0) & (sizes > low) & (sizes <= high))
            low = high
            for at in range(0, len(some), 1 << 14):
                part = some[at : at + (1 << 14)]
                data = self.single[np.frombuffer(b"".join(pieces[k] for k in part.tolist()), np.uint8)]
                symbols = np.full((len(part), high), -1, np.int64)
                symbols[np.arange(high) < sizes[part][:, None]] = data
                for k, ids in zip(part.tolist(), self.merge_rows(symbols)):
                    found[k] = ids
        for k in np.flatnonzero((whole < 0) & (sizes > WIDE)).tolist():
            found[k] = self.merge_long(pieces[k])
        lengths = np.fromiter(map(len, found), np.int64, len(found))
        return np.fromiter((i for ids in found for i in ids), np.int32, int(lengths.sum())), lengths

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts after one another, and the number of ids of each text."""
        texts = len(offsets) - 1
        starts = piece_starts(data, offsets)
        if not len(starts):
            return np.zeros(0, np.int32), np.zeros(texts, np.int64)
        bounds = np.append(starts, len(data))
        slices_ = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(bounds), pa.py_buffer(np.ascontiguousarray(data))])
        coded = slices_.dictionary_encode()
        code, pieces = coded.indices.to_numpy(zero_copy_only=False), coded.dictionary.to_pylist()
        number = self.memory.find(pieces)
        new = np.flatnonzero(number < 0)
        fresh = [pieces[k] for k in new.tolist()]
        flat, lengths = self.merged_ids(fresh)
        # Long pieces are encoded, not remembered.
        keep = np.fromiter(map(len, fresh), np.int64, len(fresh)) <= MEMORY_LENGTH
        number[new[keep]] = self.memory.add([p for p, k in zip(fresh, keep.tolist()) if k], flat[np.repeat(keep, lengths)], lengths[keep])
        first, count = self.memory.start[number], self.memory.length[number]
        spare = flat[np.repeat(~keep, lengths)]
        first[new[~keep]] = self.memory.filled + np.cumsum(lengths[~keep]) - lengths[~keep]
        count[new[~keep]] = lengths[~keep]
        table = np.concatenate([self.memory.flat[: self.memory.filled], spare]) if len(spare) else self.memory.flat
        ids = table[ranges(first[code], count[code])]
        doc = np.searchsorted(offsets, starts, side="right") - 1
        return ids, np.bincount(doc, count[code], minlength=texts).astype(np.int64)

    def decode(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bytes of the ids, and how many each has."""
        lengths = self.lengths[ids]
        return self.bytes[ranges(self.offsets[ids], lengths)], lengths


def _rows(symbols: np.ndarray) -> list[tuple[int, ...]]:
    kept = symbols >= 0
    flat, stops = symbols[kept].tolist(), np.cumsum(kept.sum(axis=1)).tolist()
    return [tuple(flat[a:b]) for a, b in zip([0, *stops], stops)]


_loaded: dict[str, ByteBpe] = {}


def encoded(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, ids, offsets, decoded`` of every whole text.

    ``ids`` are the ranks of its tokens, ``offsets`` the byte at which each begins in the text, ``decoded`` the bytes that
    the ids stand for. A NULL text counts as empty and has no ids; repeated rows get equal results; other columns
    play no part. The rank file is read by the driver; its size is fixed.
    """
    with open(path, "rb") as file:
        lines = docs.sparkSession.sparkContext.broadcast(file.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if path not in _loaded:
            _loaded[path] = ByteBpe(lines.value)
        model = _loaded[path]
        for batch in slices(batches, "text"):
            ids, counts = model.encode(*utf8(batch.column("text")))
            decoded, lengths = model.decode(ids)
            stops = np.concatenate([[0], np.cumsum(counts)])
            upto = np.concatenate([[0], np.cumsum(lengths)])
            text_stops = upto[stops]
            places = upto[:-1] - np.repeat(text_stops[:-1], counts)
            bounds = pa.array(stops, pa.int32())
            columns = [
                batch.column("doc_id"),
                pa.ListArray.from_arrays(bounds, pa.array(ids, pa.int32())),
                pa.ListArray.from_arrays(bounds, pa.array(places, pa.int32())),
                pa.LargeBinaryArray.from_buffers(
                    pa.large_binary(), batch.num_rows, [None, pa.py_buffer(text_stops), pa.py_buffer(np.ascontiguousarray(decoded))]
                ).cast(pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "ids", "offsets", "decoded"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "doc_id long, ids array<int>, offsets array<int>, decoded binary")
