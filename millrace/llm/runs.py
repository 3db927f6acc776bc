"""Words of UTF-8 text as numpy arrays: where they begin and end, whose they are, and a 64-bit hash of each.

A word is a run of bytes of one class inside one text. Its hash is a polynomial over random values of its bytes, all words of a
block at once from one running sum; words of more than LONG bytes are hashed one by one.
"""

from __future__ import annotations

from functools import cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash

from millrace.llm.common import string_parts

BLOCK = 1 << 17
LONG = 1 << 12
BASE = 0x9E3779B97F4A7C55 | 1
LOWER = np.array([c + 32 if 65 <= c <= 90 else c for c in range(256)], np.uint8)


class Words(NamedTuple):
    data: np.ndarray  # the bytes of all texts, A-Z in lower case
    ends: np.ndarray  # offsets of the texts, from 0
    start: np.ndarray
    end: np.ndarray
    doc: np.ndarray
    hash: np.ndarray


@cache
def _values() -> np.ndarray:
    return np.random.default_rng(97).integers(0, 1 << 64, 256, dtype=np.uint64, endpoint=False)


@cache
def _powers(base: int) -> np.ndarray:
    out = np.ones(BLOCK, np.uint64)
    done, factor = 1, base
    with np.errstate(over="ignore"):
        while done < BLOCK:
            out[done : 2 * done] = out[:done] * np.uint64(factor)
            done, factor = 2 * done, factor * factor % (1 << 64)
    return out


def mixed(x: np.ndarray) -> np.ndarray:
    """The hashes with all bits of each spread over its whole width."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def paired(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A hash of each ordered pair."""
    with np.errstate(over="ignore"):
        return mixed(a * np.uint64(0x9E3779B97F4A7C15) + (b ^ np.uint64(0x632BE59BD9B4E019)))


def hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    values, powers, inverse = _values(), _powers(BASE), _powers(pow(BASE, -1, 1 << 64))
    out = np.zeros(len(start), np.uint64)
    at = 0
    with np.errstate(over="ignore"):
        while at < len(start):
            origin = int(start[at])
            to = max(at + 1, int(np.searchsorted(end, origin + BLOCK - 1, side="right")))
            block = data[origin : int(end[to - 1])]
            if len(block) < BLOCK:
                run = np.zeros(len(block) + 1, np.uint64)
                np.cumsum(values[block] * powers[: len(block)], out=run[1:])
                s = start[at:to] - origin
                out[at:to] = (run[end[at:to] - origin] - run[s]) * inverse[s]
            at = to
    for i in np.flatnonzero(end - start > LONG).tolist():
        out[i] = xxhash.xxh64_intdigest(data[start[i] : end[i]].tobytes())
    return mixed(out)


def words(texts: pa.Array | pa.ChunkedArray, inside: np.ndarray) -> Words:
    """The runs of bytes of which `inside` (one flag per byte value, A-Z as a-z) holds."""
    held, ends = string_parts(texts)
    data = LOWER[held]
    member = inside[data]
    before, after = np.zeros(len(data), bool), np.zeros(len(data), bool)
    before[1:], after[:-1] = member[:-1], member[1:]
    edges = np.unique(ends)
    before[edges[edges < len(data)]] = False
    after[edges[edges > 0] - 1] = False
    start, end = np.flatnonzero(member & ~before), np.flatnonzero(member & ~after) + 1
    doc = np.searchsorted(ends, start, side="right") - 1
    return Words(data, ends, start, end, doc, hashes(data, start, end))


def strings(found: Words, at: np.ndarray) -> pa.Array:
    """The words at these places, as strings."""
    s, n = found.start[at], found.end[at] - found.start[at]
    offsets = np.zeros(len(at) + 1, np.int64)
    np.cumsum(n, out=offsets[1:])
    place = np.arange(offsets[-1]) - np.repeat(offsets[:-1], n) + np.repeat(s, n)
    return pa.LargeStringArray.from_buffers(len(at), pa.py_buffer(offsets), pa.py_buffer(found.data[place].tobytes())).cast(pa.string())
