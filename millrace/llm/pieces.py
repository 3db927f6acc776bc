"""Sampled segmentations into sentence pieces, and the way back to the text.

All ways to cut a text into pieces form a lattice. Forward filtering adds up the weight
of all paths to each node; backward sampling then walks from the end, taking each edge with its
share of that sum, so a segmentation comes out with the probability of its pieces' product.
The draws depend on the seed, the row's key and the place in the text only, not on
partitions or batches.

A piece has the space mark at its start or nowhere else (or is a run of marks), so none crosses the end of
a word and the lattice falls apart into words. Inside a word it falls apart again wherever no piece crosses, as between most
characters of writing without spaces. Forward sums are computed for the distinct words of a slice
of texts, all parts at once, one character after another; the few parts that are much longer than the others, one by one from there on.
The vocabulary's scores are merge ranks; a
piece of rank r weighs (r + 1) ** -power, and a character that has no piece is spelled by its bytes.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import slices

MARK = "▁"
BYTE_WEIGHT = 1e-12
SLICE = 512 << 10  # bytes of text whose lattices are held at a time, about 190 bytes for each character of distinct words
TINY = 1e-200
FULL = np.uint32(0xFFFFFFFF)
ONES = (1 << 64) - 1
STRIDE = 0x9E3779B97F4A7C15
FEW = 16  # parts of a lattice that are gone through one by one
CHUNK = 1 << 15  # characters of such a part whose sums are held at a time


class Vocabulary:
    """Ids, weights and bytes of a sentencepiece model's pieces, and a trie over their characters.

    The trie's steps lie in an open hash table, so that many positions can take a step at once.
    """

    def __init__(self, path: str, power: float):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        self.bytes_of: list[bytes] = []
        self.byte_ids = np.full(256, -1, np.int32)
        normal = []
        for i in range(size):
            piece = model.id_to_piece(i)
            if model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
                self.bytes_of.append(b"")
            elif model.is_byte(i):
                self.byte_ids[int(piece[3:5], 16)] = i
                self.bytes_of.append(bytes([int(piece[3:5], 16)]))
            else:
                if MARK in piece.lstrip(MARK):
                    raise ValueError(f"piece {piece!r} has a space mark inside")
                self.bytes_of.append(piece.replace(MARK, " ").encode())
                normal.append((-model.get_score(i), i, piece))
        if (self.byte_ids < 0).any():
            raise ValueError("the vocabulary needs a piece for every byte")
        best = min((x[0] for x in normal), default=0.0)
        self.longest = max((len(x[2]) for x in normal), default=1)
        letters = sorted({c for _, _, piece in normal for c in piece})
        self.letter = np.full(0x110000, -1, np.int32)
        self.letter[[ord(c) for c in letters]] = np.arange(len(letters))
        self.width = len(letters)
        code = {c: i for i, c in enumerate(letters)}
        steps: dict[int, int] = {}
        ends: dict[int, tuple[int, float]] = {}
        for rank, i, piece in normal:
            state = 0
            for c in piece:
                state = steps.setdefault(state * self.width + code[c], len(steps) + 1)
            ends[state] = (i, (rank - best + 1.0) ** -power)
        self.piece = np.full(len(steps) + 1, -1, np.int32)
        self.weight = np.zeros(len(steps) + 1)
        for state, (i, weight) in ends.items():
            self.piece[state], self.weight[state] = i, weight
        bits = max(4, (4 * len(steps)).bit_length())
        self.shift = np.uint64(64 - bits)
        self.keys = np.full((1 << bits) + 64, -1, np.int64)
        self.next = np.zeros((1 << bits) + 64, np.int32)
        for key, state in steps.items():
            slot = int(self._slot(np.array([key]))[0])
            while self.keys[slot] >= 0:
                slot += 1
            self.keys[slot], self.next[slot] = key, state

    def _slot(self, key: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return ((key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def step(self, state: np.ndarray, letter: np.ndarray) -> np.ndarray:
        """The states reached, -1 where there is no such step."""
        key = state.astype(np.int64) * self.width + letter
        slot = self._slot(key)
        out = np.full(len(key), -1, np.int32)
        on = np.arange(len(key))
        while len(on):
            held = self.keys[slot]
            hit = held == key
            out[on[hit]] = self.next[slot[hit]]
            go = np.flatnonzero(~hit & (held >= 0))
            on, key, slot = on[go], key[go], slot[go] + 1
        return out


@lru_cache(maxsize=2)
def _vocabulary(path: str, power: float) -> Vocabulary:
    return Vocabulary(path, power)


class Lattices:
    """The lattices of distinct words, given with spaces where the model has marks.

    Node j of a word stands before its j-th character. For each node but the first, `shares` holds the summed
    share of the edges into it by length, in 32 bits, and `pieces` their pieces; -1 spells the character.
    """

    def __init__(self, vocabulary: Vocabulary, words: list[str]):
        v = vocabulary
        self.points = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
        self.sizes = np.fromiter(map(len, words), np.int64, len(words))
        self.first = np.cumsum(self.sizes) - self.sizes
        n, longest = len(self.points), v.longest
        # A mark that stands in the text itself is spelled, a space is a mark.
        letter = v.letter[np.where(self.points == 0x20, ord(MARK), self.points)]
        letter[self.points == ord(MARK)] = -1
        # Row i is for the node behind character i.
        weights = np.zeros((n, longest), np.float32)
        self.pieces = np.full((n, longest), -1, np.int32)
        crossing = np.zeros(n + 1, np.int64)
        depth = np.arange(n) - np.repeat(self.first, self.sizes)
        left = np.repeat(self.sizes, self.sizes) - depth
        on, state = np.flatnonzero(letter >= 0), None
        for length in range(1, longest + 1):
            at = on + length - 1
            state = v.step(np.zeros(len(on), np.int32) if state is None else state, letter[at])
            go = state >= 0
            on, at, state = on[go], at[go], state[go]
            ids = v.piece[state]
            hit = ids >= 0
            weights[at[hit], length - 1] = v.weight[state[hit]]
            self.pieces[at[hit], length - 1] = ids[hit]
            if length > 1:
                behind = at[hit][weights[at[hit], length - 1] > 0]
                crossing += np.bincount(behind - (length - 2), minlength=n + 1)
                crossing -= np.bincount(behind + 1, minlength=n + 1)
            go = left[on] > length
            on, state = on[go], state[go]
            go = letter[on + length] >= 0
            on, state = on[go], state[go]
            if not len(on):
                break
        # Pieces that cross the place before a character; where there are none, a part of its own begins.
        begins = (np.cumsum(crossing[:-1]) == 0) | (depth == 0)
        alone = weights[:, 0] == 0
        weights[alone, 0] = BYTE_WEIGHT
        self.begin = np.flatnonzero(begins)
        self.length = np.diff(np.r_[self.begin, n])
        # The parts of word i are those from `part[i]` up to `part[i + 1]`.
        self.part = np.searchsorted(self.begin, np.r_[self.first, n])
        self.shares = self._forward(weights, self.begin, self.length)

    def _forward(self, weights: np.ndarray, start: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        n, longest = weights.shape
        shares = np.empty((n, longest), np.uint32)
        total = np.zeros(n)  # of the node behind character i
        by_size = np.argsort(-sizes, kind="stable")
        start, sizes = start[by_size], sizes[by_size]
        # From this depth on there are but a few parts.
        common = int(sizes[FEW - 1]) if len(sizes) >= FEW else 0
        for d in range(common):
            at = start[: int(np.searchsorted(-sizes, -d, side="left"))] + d
            reach = min(longest, d + 1)
            sums = np.zeros((len(at), longest))
            run = np.zeros(len(at))
            for length in range(1, reach + 1):
                own = weights[at, length - 1]
                run = run + (own if length == d + 1 else own * total[at - length])
                sums[:, length - 1] = run
            sums[:, reach:] = run[:, None]
            small = run < TINY
            total[at] = run
            shares[at] = np.minimum(sums / run[:, None] * 4294967296.0, 4294967295.0).astype(np.uint32)
            if small.any():  # only the ratios within reach of a piece matter
                for i in at[small]:
                    total[max(i - d, i - longest) : i + 1] /= total[i]
        for begin, size in zip(start[:FEW].tolist(), sizes[:FEW].tolist(), strict=True):
            if size > common:
                self._along(weights, total, shares, begin, common, size)
        # A draw is below the full share, so it never passes the last edge.
        last = longest - 1 - (weights[:, ::-1] > 0).argmax(axis=1)
        shares[np.arange(longest)[None, :] >= last[:, None]] = FULL
        return shares


    @staticmethod
    def _along(weights: np.ndarray, total: np.ndarray, shares: np.ndarray, begin: int, depth: int, size: int) -> None:
        """The shares of one part from a depth on."""
        longest = weights.shape[1]
        past = total[max(begin, begin + depth - longest) : begin + depth].tolist()
        for lo in range(depth, size, CHUNK):
            hi = min(size, lo + CHUNK)
            sums = []
            for d, row in zip(range(lo, hi), weights[begin + lo : begin + hi].tolist(), strict=True):
                run, found = 0.0, []
                for length in range(1, min(longest, d + 1) + 1):
                    own = row[length - 1]
                    if own:
                        run += own if length == d + 1 else own * past[-length]
                    found.append(run)
                sums.append(found + [run] * (longest - len(found)))
                past.append(run)
                if len(past) > longest:
                    del past[0]
                if run < TINY:
                    past = [x / run for x in past]
            got = np.array(sums)
            shares[begin + lo : begin + hi] = np.minimum(got / got[:, -1:] * 4294967296.0, 4294967295.0).astype(np.uint32)


def _mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer; spreads counters over all bits."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def _mix_one(x: int) -> int:
    """The same of one number."""
    x &= ONES
    x = (x ^ (x >> 30)) * 0xBF58476D1CE4E5B9 & ONES
    x = (x ^ (x >> 27)) * 0x94D049BB133111EB & ONES
    return x ^ (x >> 31)


def _walk(held: Lattices, parts: np.ndarray, streams: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, ...]:
    """For each part of a lattice in turn its pieces, the characters of those, and how many pieces it has.

    `streams` and `places` (of a part's first character in its text) seed the draws. The few parts that are still under way when the others
    are done are walked one by one.
    """
    base = held.begin[parts]
    node = held.length[parts].copy()
    on = np.arange(len(parts))
    rounds = []
    counts = np.zeros(len(parts), np.int64)
    while len(on) > FEW:
        at = base[on] + node[on] - 1
        with np.errstate(over="ignore"):
            draw = _mix(streams[on] + (places[on] + node[on]).astype(np.uint64) * np.uint64(STRIDE))
        draw = np.minimum((draw >> np.uint64(32)).astype(np.uint32), FULL - np.uint32(1))
        length = (held.shares[at] <= draw[:, None]).sum(axis=1)
        rounds.append((on, held.pieces[at, length], at))
        node[on] -= length + 1
        counts[on] += 1
        on = on[node[on] > 0]
    alone = []
    for i in on.tolist():
        found, left, begin, place, stream = [], int(node[i]), int(base[i]), int(places[i]), int(streams[i])
        while left > 0:
            draw = min(_mix_one(stream + (place + left) * STRIDE) >> 32, int(FULL) - 1)
            found.append(begin + left - 1)
            left -= int(held.shares[begin + left - 1].searchsorted(draw, side="right")) + 1
        at = np.array(found, np.int64)
        length = at - np.r_[at[1:], begin - 1] - 1
        alone.append((i, int(counts[i]), held.pieces[at, length], at))
        counts[i] += len(found)
    ends = np.cumsum(counts)
    out = np.empty(int(ends[-1]) if len(ends) else 0, np.int32)
    char = np.empty(len(out), np.int64)
    for step, (rows, found, at) in enumerate(rounds):
        out[ends[rows] - 1 - step] = found
        char[ends[rows] - 1 - step] = at
    for i, step, found, at in alone:
        where = ends[i] - 1 - step - np.arange(len(at))
        out[where], char[where] = found, at
    return out, char, counts


def _spell(v: Vocabulary, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Byte pieces of characters one after another, and how many each has."""
    text = points.astype("<u4").tobytes().decode("utf-32-le", "surrogatepass")
    data = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    sizes = 1 + (points >= 0x80).astype(np.int64) + (points >= 0x800) + (points >= 0x10000)
    return v.byte_ids[data], sizes


def _cut(texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Distinct words of non-empty texts, the word of each place, and the number of words per text.

    A word keeps the spaces before it; each text is given one space in front, as the model's own encoder does.
    """
    parts = pc.split_pattern(texts, " ")
    flat = parts.flatten()
    sizes = np.diff(np.asarray(parts.offsets)).astype(np.int64)
    coded = flat.dictionary_encode()
    distinct = coded.dictionary.to_pylist()
    codes = np.asarray(coded.indices).astype(np.int64)
    plain = [" " + w for w in distinct]
    if "" not in distinct:
        return plain, codes, sizes
    # Runs of spaces: an empty part lends its space to the next part of its text.
    empty = codes == distinct.index("")
    of = np.repeat(np.arange(len(sizes)), sizes)
    last = np.zeros(len(codes), bool)
    last[np.cumsum(sizes) - 1] = True
    keep = np.flatnonzero(~(empty & ~last))
    before = np.diff(np.r_[-1, keep]) - 1
    index: dict[tuple[int, int], int] = {}
    out = codes[keep]
    for i in np.flatnonzero(before):
        key = (int(before[i]), int(out[i]))
        if key not in index:
            index[key] = len(plain)
            plain.append(" " * key[0] + plain[key[1]])
        out[i] = index[key]
    return plain, out, np.bincount(of[keep], minlength=len(sizes))


def sample(texts: pa.Array, keys: np.ndarray, path: str, seed: int, power: float) -> tuple[np.ndarray, np.ndarray]:
    """Piece ids of all texts one after another, and how many each text has. Null and empty texts have none.

    `keys` are the rows' keys as unsigned 64-bit numbers.
    """
    sizes = np.asarray(pc.fill_null(pc.binary_length(texts), 0))
    some = np.flatnonzero(sizes > 0)
    counts = np.zeros(len(texts), np.int64)
    if not len(some):
        return np.zeros(0, np.int32), counts
    v = _vocabulary(path, power)
    distinct, words, per = _cut(texts.take(pa.array(some)))
    held = Lattices(v, distinct)
    spans = held.sizes[words]
    before = np.cumsum(spans) - spans
    starts = np.cumsum(per) - per
    places = before - np.repeat(before[starts], per)
    with np.errstate(over="ignore"):
        own = _mix(keys[some] * np.uint64(STRIDE) + _mix(np.array([seed], np.uint64)))
    n = (held.part[1:] - held.part[:-1])[words]
    parts = np.arange(int(n.sum())) + np.repeat(held.part[words] - (np.cumsum(n) - n), n)
    places = np.repeat(places - held.first[words], n) + held.begin[parts]
    per = np.add.reduceat(n, starts)
    starts = np.cumsum(per) - per
    ids, chars, lengths = _walk(held, parts, np.repeat(own, per), places)
    spelled = np.flatnonzero(ids < 0)
    if len(spelled):
        by, n = _spell(v, held.points[chars[spelled]])
        each = np.ones(len(ids), np.int64)
        each[spelled] = n
        begin = np.cumsum(each) - each
        lengths = np.add.reduceat(each, np.cumsum(lengths) - lengths)
        out = np.repeat(ids, each)
        out[np.repeat(begin[spelled] - (np.cumsum(n) - n), n) + np.arange(len(by))] = by
        ids = out
    counts[some] = np.add.reduceat(lengths, starts)
    return ids, counts


def decode(ids: np.ndarray, path: str, power: float = 1.0) -> str:
    """The text of a sequence of ids that `sample` gave, exactly."""
    spelled = _vocabulary(path, power).bytes_of
    return b"".join([spelled[i] for i in ids.tolist()])[1:].decode("utf-8", "surrogatepass")


def encoded(docs: DataFrame, path: str, seed: int = 42, power: float = 1.0) -> DataFrame:
    """`doc_id`, `ids` (array of int), `n_ids`, `ids_crc32` and `lossless` for each row.

    A null text gives null ids and an empty one none; a null doc_id draws like key 0. Equal rows get equal ids.
    `lossless` says that the decoded ids are the text, which is checked on every row.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text", SLICE):
            texts = part.column("text")
            keys = np.asarray(pc.fill_null(part.column("doc_id"), 0)).astype(np.int64).view(np.uint64)
            ids, counts = sample(texts, keys, path, seed, power)
            ends = np.r_[0, np.cumsum(counts)]
            checks, same = [], []
            for i, text in enumerate(texts.to_pylist()):
                own = ids[ends[i] : ends[i + 1]]
                checks.append(zlib.crc32(own.astype("<u4").tobytes()))
                same.append(decode(own, path, power) == (text or ""))
            null = np.asarray(pc.is_null(texts))
            listed = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(ids), mask=pa.array(null))
            columns = [part.column("doc_id"), listed, pa.array(counts), pa.array(checks, pa.int64()), pa.array(same)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "ids", "n_ids", "ids_crc32", "lossless"])

    thin = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return thin.mapInArrow(run, "doc_id long, ids array<int>, n_ids long, ids_crc32 long, lossless boolean")
