"""Token files of length-delimited binary records, with an offset index for shuffled reads.

A record is the framed form of one sequence: its length (8 bytes, little-endian), the masked checksum of
those 8 bytes, the sequence, and the masked checksum of the sequence. A sequence is the document's id (8 bytes,
signed, with a byte before it that is 0 for a null id) followed by the token ids, in 2 bytes each where the vocabulary fits, in 4 otherwise.
Checksums are CRC-32 rotated right by 15 bits plus a constant, so a checksum of data that holds
checksums stays sound. Beside every data file lies an index of its records' offsets.
"""

from __future__ import annotations

import os
import random
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import fresh_folder, slices, written

# The mask of checksums, and the file marks.
MASK = 0xA282EAD8
DATA_MARK, INDEX_MARK = b"MLRREC1\n", b"MLROFF1\n"
HEAD = "<QI"
HELD_WORDS = 600_000  # distinct words whose ids a worker keeps


def masked(data: bytes) -> int:
    crc = zlib.crc32(data)
    return ((crc >> 15 | crc << 17) + MASK) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    size = struct.pack("<Q", len(payload))
    return b"".join((size, struct.pack("<I", masked(size)), payload, struct.pack("<I", masked(payload))))


def unframe(data: bytes | memoryview, at: int) -> tuple[bytes, int]:
    """The payload of the record at `at`, and where the next one begins; fails on damage."""
    size, check = struct.unpack_from(HEAD, data, at)
    if masked(bytes(data[at : at + 8])) != check:
        raise ValueError(f"damaged length at {at}")
    body = bytes(data[at + 12 : at + 12 + size])
    if len(body) != size or struct.unpack_from("<I", data, at + 12 + size)[0] != masked(body):
        raise ValueError(f"damaged record at {at}")
    return body, at + 16 + size


class WordEncoder:
    """Token ids of texts by the tokenizers library, which is asked once for each distinct word.

    The library splits a text before it merges, and a space after a solid character always begins a new
    part, so a text's ids are those of its words, each with the space before it. A text where
    words end in white space, or are empty (runs of spaces), goes to the library whole.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark runs a worker for each core
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.size = self.library.get_vocab_size()
        lengths = np.zeros(self.size, np.int64)
        for token, i in self.library.get_vocab().items():
            lengths[i] = len(token)  # one character stands for one byte
        self.lengths = lengths
        self.kind = np.dtype("<u2" if self.size <= 1 << 16 else "<u4")
        self.clear()

    def clear(self) -> None:
        self.index: dict[str, int] = {}
        self.starts = [np.zeros(0, np.int64)]
        self.counts = [np.zeros(0, np.int64)]
        self.ids = [np.zeros(0, self.kind)]
        self.total = 0

    def whole(self, text: str) -> np.ndarray:
        # A batch of one: its form without offsets is the quicker one.
        return np.array(self.library.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.int64)

    def _learn(self, words: list[str]) -> None:
        """New words go to the library in one text; the ids' byte lengths tell where each word ends.

        A word that would run into its neighbours there, or may hold a special token, goes alone.
        """
        alone = [w for w in words if w[0] != " " or "<|" in w or w[-1].isspace()]
        if alone:
            found = [self.whole(w) for w in alone]
            self._keep(alone, np.concatenate(found), np.array([len(x) for x in found], np.int64))
            left = set(alone)
            words = [w for w in words if w not in left]
        if words:
            ids = self.whole("".join(words))
            ends = np.cumsum(np.fromiter((len(w.encode()) for w in words), np.int64, len(words)))
            cut = np.searchsorted(np.cumsum(self.lengths[ids]), ends, side="left") + 1
            self._keep(words, ids, np.diff(np.r_[0, cut]))

    def _keep(self, words: list[str], ids: np.ndarray, sizes: np.ndarray) -> None:
        begin = len(self.index)
        self.index.update(zip(words, range(begin, begin + len(words)), strict=True))
        self.starts.append(self.total + np.cumsum(sizes) - sizes)
        self.counts.append(sizes)
        self.ids.append(ids.astype(self.kind))
        self.total += len(ids)

    def _places(self, words: list[str]) -> np.ndarray:
        """Where each word's ids are kept; unknown words are learnt."""
        found = list(map(self.index.get, words))
        new = [w for w, at in zip(words, found, strict=True) if at is None]
        if new:
            self._learn(list(dict.fromkeys(new)))
            found = list(map(self.index.get, words))
        return np.array(found, np.int64)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, each followed by id 0, and how many each has with that."""
        if len(self.index) > HELD_WORDS:
            self.clear()
        filled = pc.fill_null(texts, "")
        parts = pc.split_pattern(filled, " ")
        sizes = np.diff(np.asarray(parts.offsets)).astype(np.int64)
        first = np.cumsum(sizes) - sizes
        coded = parts.flatten().dictionary_encode()
        codes = np.asarray(coded.indices).astype(np.int64)
        solid = np.asarray(pc.binary_length(pc.utf8_rtrim_whitespace(coded.dictionary)))
        odd = (solid == 0) | (solid != np.asarray(pc.binary_length(coded.dictionary)))
        of = np.repeat(np.arange(len(sizes)), sizes)
        inner = np.ones(len(codes), bool)
        inner[first] = False
        final = np.zeros(len(codes), bool)
        final[first + sizes - 1] = True
        slow = np.zeros(len(sizes), bool)
        slow[of[odd[codes] & ~(final & inner)]] = True
        names = coded.dictionary.to_pylist()
        # A text's first word has no space before it.
        place, leads = np.full((2, len(names)), -1, np.int64)
        seen = np.zeros(len(names), bool)
        seen[codes[inner & ~slow[of]]] = True
        used = np.flatnonzero(seen)
        place[used] = self._places([" " + names[i] for i in used.tolist()])
        bare = np.unique(codes[first[~slow]])
        leads[bare] = self._places([names[i] for i in bare.tolist()])
        starts, counts, ids = (np.concatenate(x) for x in (self.starts, self.counts, self.ids))
        self.starts, self.counts, self.ids = [starts], [counts], [ids]
        fast = ~slow[of]
        at = np.where(inner, place[codes], leads[codes])[fast]
        n = counts[at]
        out_counts = np.bincount(of[fast], weights=n, minlength=len(sizes)).astype(np.int64)
        wholes = {int(i): self.whole(filled[int(i)].as_py()) for i in np.flatnonzero(slow)}
        for i, own in wholes.items():
            out_counts[i] = len(own)
        out_counts += 1
        ends = np.cumsum(out_counts)
        out = np.zeros(int(ends[-1]), self.kind)
        keep = np.ones(len(out), bool)
        keep[ends - 1] = False
        for i, own in wholes.items():
            out[ends[i] - 1 - len(own) : ends[i] - 1] = own
            keep[ends[i] - 1 - len(own) : ends[i] - 1] = False
        if len(at):
            step = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
            out[keep] = ids[np.repeat(starts[at], n) + step]
        return out, out_counts


@lru_cache(maxsize=2)
def _encoder(path: str) -> WordEncoder:
    return WordEncoder(path)


def write_records(docs: DataFrame, tokenizer: str, folder: str, parts: int) -> DataFrame:
    """Writes `docs` in ascending doc_id order as `parts` data files; returns one row per record, as a stored table.

    The rows are `part`, `row` (within the part), `file`, `offset`, `size`, `doc_id`, `n_tokens`; the stored rows name only
    files of attempts that ended well. Null ids come first; rows of one id are ordered by their texts.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        part = context.partitionId()
        name = f"{folder}/part-{part:06d}-{context.taskAttemptId()}"
        store, path = fs.FileSystem.from_uri(name)
        store.create_dir(path.rpartition("/")[0], recursive=True)
        encoder = _encoder(tokenizer)
        row, at, offsets = 0, len(DATA_MARK) + 1, []
        with store.open_output_stream(path + ".rec") as out:
            out.write(DATA_MARK + bytes([encoder.kind.itemsize]))
            for piece in slices(batches, "text"):
                ids, counts = encoder.encode(piece.column("text"))
                ends = np.cumsum(counts)
                keys = piece.column("doc_id").to_pylist()
                frames, sizes = [], []
                for key, end, n in zip(keys, ends.tolist(), counts.tolist(), strict=True):
                    body = struct.pack("<?q", key is not None, key or 0) + ids[end - n : end].tobytes()
                    frames.append(frame(body))
                    sizes.append(len(frames[-1]))
                out.write(b"".join(frames))
                begins = at + np.cumsum(sizes) - sizes
                at += sum(sizes)
                offsets.append(begins)
                k = len(keys)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(k, part, np.int32)),
                        pa.array(np.arange(row, row + k)),
                        pa.array([name] * k, pa.string()),
                        pa.array(begins),
                        pa.array(np.array(sizes, np.int64)),
                        piece.column("doc_id"),
                        pa.array(counts),
                    ],
                    ["part", "row", "file", "offset", "size", "doc_id", "n_tokens"],
                )
                row += k
        with store.open_output_stream(path + ".off") as out:
            out.write(INDEX_MARK)
            for own in offsets:
                out.write(own.astype("<u8").tobytes())

    ordered = (
        docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
        .repartitionByRange(parts, "doc_id")
        .sortWithinPartitions("doc_id", "text")
    )
    schema = "part int, row long, file string, offset long, size long, doc_id long, n_tokens long"
    return written(ordered.mapInArrow(run, schema), "record-index")


def read_offsets(name: str) -> np.ndarray:
    """Where each record of a data file begins."""
    store, path = fs.FileSystem.from_uri(name)
    with store.open_input_stream(path + ".off") as source:
        data = source.read()
    if data[: len(INDEX_MARK)] != INDEX_MARK:
        raise ValueError(f"no offset index at {name}.off")
    return np.frombuffer(data, "<u8", offset=len(INDEX_MARK)).astype(np.int64)


def parse(body: bytes, width: int) -> tuple[int | None, np.ndarray]:
    """Document id and token ids of a record's payload."""
    known, key = struct.unpack_from("<?q", body)
    return (key if known else None), np.frombuffer(body, f"<u{width}", offset=9)


def shuffled(name: str, seed: int, reads: int = 1 << 16) -> Iterator[tuple[int | None, np.ndarray]]:
    """All records of one data file, in a seeded random order, each by one seek."""
    offsets = read_offsets(name).tolist()
    random.Random(seed).shuffle(offsets)
    store, path = fs.FileSystem.from_uri(name)
    with store.open_input_file(path + ".rec") as source:
        source.seek(len(DATA_MARK))
        width = source.read(1)[0]
        for at in offsets:
            source.seek(at)
            head = source.read(12)
            size = struct.unpack(HEAD, head)[0]
            body, _ = unframe(head + source.read(size + 4), 0)
            yield parse(body, width)


def read_records(index: DataFrame) -> DataFrame:
    """`part`, `row`, `doc_id`, `before`, `n_tokens`, `ids_crc32` of every record, read from the files themselves.

    `before` counts the tokens before the record in its file.
    """
    files = index.select("part", "file").distinct()
    n = max(1, files.count())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, name in zip(batch.column("part").to_pylist(), batch.column("file").to_pylist(), strict=True):
                expected = read_offsets(name)
                store, path = fs.FileSystem.from_uri(name)
                rows: list[tuple[int | None, int, int, int]] = []
                done = before = 0
                with store.open_input_stream(path + ".rec", buffer_size=1 << 20) as source:
                    start = source.read(len(DATA_MARK) + 1)
                    if start[:-1] != DATA_MARK:
                        raise ValueError(f"no records at {name}.rec")
                    width, at = start[-1], len(start)
                    while head := source.read(12):
                        if expected[done + len(rows)] != at:
                            raise ValueError(f"the index of {name} does not fit its records")
                        body, used = unframe(head + source.read(struct.unpack(HEAD, head)[0] + 4), 0)
                        key, ids = parse(body, width)
                        rows.append((key, before, len(ids), zlib.crc32(ids.astype("<u4").tobytes())))
                        at += used
                        before += len(ids)
                        if len(rows) == 8192:
                            yield _rows(part, done, rows)
                            done, rows = done + len(rows), []
                if done + len(rows) != len(expected):
                    raise ValueError(f"{name} has {done + len(rows)} records, its index {len(expected)}")
                if rows:
                    yield _rows(part, done, rows)

    schema = "part int, row long, doc_id long, before long, n_tokens long, ids_crc32 long"
    # A task per file. Dealt by name it would count as the partitioning of distinct(), whose few bytes go to one task.
    return files.repartition(n).mapInArrow(run, schema)


def _rows(part: int, done: int, rows: list[tuple[int | None, int, int, int]]) -> pa.RecordBatch:
    keys, before, sizes, checks = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays(
        [
            pa.array([part] * len(rows), pa.int32()),
            pa.array(np.arange(done, done + len(rows))),
            pa.array(keys, pa.int64()),
            pa.array(before, pa.int64()),
            pa.array(sizes, pa.int64()),
            pa.array(checks, pa.int64()),
        ],
        ["part", "row", "doc_id", "before", "n_tokens", "ids_crc32"],
    )


def round_trip(docs: DataFrame, tokenizer: str, parts: int) -> DataFrame:
    """Writes the records, reads them back, and gives `doc_id`, `start`, `n_tokens`, `ids_crc32` of each document."""
    index = write_records(docs, tokenizer, fresh_folder(docs.sparkSession, "records"), parts)
    read = written(read_records(index), "records-read")
    # One row per file: what all files before it hold.
    totals = read.groupBy("part").agg(F.sum("n_tokens").alias("own"))
    earlier = totals.select("part", (F.sum("own").over(Window.orderBy("part")) - F.col("own")).alias("earlier"))
    return read.join(F.broadcast(earlier), "part").select(
        "doc_id", (F.col("earlier") + F.col("before")).alias("start"), "n_tokens", "ids_crc32"
    )
