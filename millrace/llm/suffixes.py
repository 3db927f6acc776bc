"""Repeated strings of a corpus by suffix order and longest-previous-factor arrays.

Text of `least` bytes or more that also starts elsewhere is found in three steps, none of which takes the corpus to one task.

Cut: every window of `least` bytes is named by the smallest hash of the GRAM-byte strings in it. Neighbouring windows mostly have the
same name; a run of them is a stretch. Equal windows have equal names, so a window can only be found again in a stretch
of the same name. Counted by name first, most stretches turn out to be alone and are done. Names whose stretches are
all equal are done too: all windows in them repeat. (A stretch that holds its name's string twice may repeat in itself, and is looked into.)

Sort: distinct stretches of a name that has several go to one task, many names at a time. There, the suffixes of their bytes are
put in order by doubling ranks up to `least` bytes. Suffixes that agree so far are next to each other, in order of
position, and the longest previous factor of a position, capped at `least`, comes from its previous and
next smaller positions in that order: at least `least` if and only if it isn't the first of its kind. Those are later copies;
seen from the other end (previous and next larger positions) they are the earlier ones.

Join: what repeats is told to all texts that hold the stretch, and each text is left without the bytes so covered.

A name with more than `crowd` stretches, such as the edge of a passage that a third of all documents hold, isn't sorted in one task: its
windows are counted by a 128-bit hash instead, which Spark adds up before the shuffle.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import slices, string_parts, written

GRAM = 32
SORTED_BYTES = 1 << 21  # bytes of stretches whose suffixes a task sorts at a time; a name's stretches stay together
CROWD = 8192
TOP = np.uint64(0xFFFFFFFFFFFFFFFF)


@cache
def _values() -> np.ndarray:
    return np.random.default_rng(61).integers(0, 1 << 64, 256, dtype=np.uint64, endpoint=False)


def gram_hashes(data: np.ndarray, size: int) -> np.ndarray:
    """A hash of the `size` bytes from each position; `size` is a power of two."""
    h, have, factor = _values()[data], 1, 0x9E3779B97F4A7C55
    with np.errstate(over="ignore"):
        while have < size:
            h = h[:-have] * np.uint64(factor) + h[have:]
            have, factor = 2 * have, factor * factor % (1 << 64)
        h ^= h >> np.uint64(31)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(29)
    return h


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """The smallest of each `width` neighbouring values, from running minima of blocks to both sides."""
    n = len(values)
    blocks = np.concatenate([values, np.full(-n % width, TOP)]).reshape(-1, width)
    left = np.minimum.accumulate(blocks, axis=1).ravel()
    right = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(right[: n - width + 1], left[width - 1 : n])


def stretches(data: np.ndarray, ends: np.ndarray, least: int) -> tuple[np.ndarray, ...]:
    """Text, place in `data`, windows and name of every stretch, and if its string of least hash is in it twice.

    Texts shorter than `least` bytes have none.
    """
    none = np.zeros(0, np.int64)
    if len(data) < least:
        return none, none, none, none.view(np.uint64), none > 0
    grams, width = gram_hashes(data, GRAM), least - GRAM + 1
    name = sliding_least(grams, width)
    windows = np.diff(ends) - least + 1
    live = np.flatnonzero(windows > 0)
    begin, stop = ends[:-1][live], ends[:-1][live] + windows[live]
    cut = np.zeros(len(name) + 1, bool)
    cut[1:-1] = name[1:] != name[:-1]
    cut[begin] = True
    cut[stop] = True
    at = np.flatnonzero(cut)
    of = np.searchsorted(begin, at, side="right") - 1
    inside = (of >= 0) & (at < stop[np.maximum(of, 0)])
    after = np.append(at[1:], len(name))
    at, of, after = at[inside], of[inside], after[inside]
    # Strings that are the least of any window: the largest name around them is their own hash.
    edge = np.full(width - 1, TOP)
    chosen = np.flatnonzero(~sliding_least(np.concatenate([edge, ~name, edge]), width) == grams)
    first, last = np.searchsorted(chosen, at), np.searchsorted(chosen, after + width - 1)
    n = last - first
    stretch = np.repeat(np.arange(len(at)), n)
    hit = grams[chosen[np.arange(len(stretch)) - np.repeat(np.cumsum(n) - n, n) + first[stretch]]] == name[at][stretch]
    return live[of], at, after - at, name[at], np.bincount(stretch[hit], minlength=len(at)) > 1


def suffix_ranks(data: np.ndarray, ends: np.ndarray, depth: int) -> np.ndarray:
    """Rank of each position among all by its next `depth` bytes, equal ones alike. Beyond its piece's end a position has zeros.

    Ranks for 8 bytes come from the bytes read as a number; each step after that doubles the length by ranking pairs of ranks.
    """
    n = len(data)
    left = np.repeat(ends[1:], np.diff(ends)) - np.arange(n)
    key = np.zeros(n, np.uint64)
    for k in range(8):
        shifted = np.zeros(n, np.uint64)
        shifted[: n - k] = data[k:]
        key = (key << np.uint64(8)) | np.where(left > k, shifted, 0)
    have = 8

    def ranked(key: np.ndarray) -> np.ndarray:
        order = np.argsort(key)
        held = key[order]
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(np.r_[True, held[1:] != held[:-1]])
        return rank

    rank = ranked(key)
    while have < depth:
        step = min(have, depth - have)
        later = np.zeros(n, np.int64)
        later[: n - step] = rank[step:]
        later[left <= step] = 0
        rank = ranked(rank * (n + 1) + later)
        have += step
    return rank


def previous_factors(data: np.ndarray, ends: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """For each position with `least` bytes to its piece's end: the earlier and the later position with the same ones, else -1.

    In suffix order capped at `least` bytes, with ties in order of position, the nearest smaller position of the same factor is the one
    before, if it agrees that far, and the nearest larger the one after; any other agrees in fewer bytes.
    """
    n = len(data)
    rank = suffix_ranks(data, ends, least)
    whole = np.flatnonzero(np.repeat(ends[1:], np.diff(ends)) - np.arange(n) >= least)
    order = whole[np.argsort(rank[whole], kind="stable")]
    same = rank[order[1:]] == rank[order[:-1]]
    earlier, later = np.full(n, -1), np.full(n, -1)
    earlier[order[1:][same]] = order[:-1][same]
    later[order[:-1][same]] = order[1:][same]
    return earlier, later


def spans(starts: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs covered by `least` bytes from each of the ascending positions."""
    if not len(starts):
        return starts, starts
    gap = np.flatnonzero(np.diff(starts) > least)
    return starts[np.r_[0, gap + 1]], starts[np.r_[gap, len(starts) - 1]] + least


def _keyed(docs: DataFrame) -> DataFrame:
    """Null ids and texts made plain: `id`, `t` (hash of text and of the id's being null), `text`."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    own = F.col("doc_id").cast("long")
    return docs.select(own.alias("doc_id"), F.coalesce(own, F.lit(0)).alias("id"), F.xxhash64(text, own.isNull()).alias("t"), text.alias("text"))


def named_stretches(keyed: DataFrame, least: int, placed: bool) -> DataFrame:
    """`name` and, if `placed`, `id`, `t`, `at`, `windows` of each stretch, otherwise its content's hash `same` and whether it may repeat in itself."""
    kind = "name long, id long, t long, at long, windows long" if placed else "name long, same long, again boolean"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            data, ends = string_parts(part.column("text"))
            of, at, windows, name, again = stretches(data, ends, least)
            if placed:
                keys = [np.asarray(part.column(c))[of] for c in ("id", "t")]
                columns = [name.view(np.int64), *keys, at - ends[of], windows]
            else:
                held = memoryview(data.tobytes())
                to = at + windows + least - 1
                same = [xxhash.xxh64_intdigest(held[a:b]) for a, b in zip(at.tolist(), to.tolist(), strict=True)]
                columns = [name.view(np.int64), np.array(same, np.uint64).view(np.int64), again]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], [f.split()[0] for f in kind.split(", ")])

    columns = ["id", "t", "text"] if placed else ["text"]
    return keyed.select(*columns).mapInArrow(run, kind)


def packed(keyed: DataFrame, *columns: str) -> DataFrame:
    """The rows with their texts compressed, to be shuffled."""
    kept = [c for c in columns if c != "text"]
    kind = ", ".join(f"{c} long" for c in kept) + ", packed binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=1).compress
        for part in slices(batches, "text"):
            data, ends = string_parts(part.column("text"))
            held = memoryview(data.tobytes())
            texts = pa.array([squeeze(held[a:b]) for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)], pa.binary())
            yield pa.RecordBatch.from_arrays([*[part.column(c) for c in kept], texts], [*kept, "packed"])

    return keyed.select(*kept, "text").mapInArrow(run, kind)


def unpacked(packed: pa.Array) -> Iterator[bytes]:
    open_up = zstandard.ZstdDecompressor().decompress
    for x in packed:
        yield open_up(x.as_py())


def cut_out(texts: DataFrame, least: int) -> DataFrame:
    """`name`, `same`, `id`, `t`, `at`, `times`, `crowded` and `stretch` of the listed stretches of each text.

    The bytes come with the first of equal stretches of a slice alone, with how often the slice has it; the others have none.
    """
    kind = "name long, same long, id long, t long, at long, crowded boolean, times long, stretch binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("open")
            out, seen = [], {}
            for i, (key, t, text) in enumerate(zip(batch.column("id").to_pylist(), batch.column("t").to_pylist(), unpacked(batch.column("packed")), strict=True)):
                for s in lists[i].as_py():
                    stretch = text[s["at"] : s["at"] + s["windows"] + least - 1]
                    same = xxhash.xxh64_intdigest(stretch)
                    known = seen.get((s["name"], same))
                    if known is None:
                        seen[s["name"], same] = len(out)
                        out.append([s["name"], same - (1 << 64) if same >> 63 else same, key, t, s["at"], s["crowded"], 1, stretch])
                    else:
                        out[known][6] += 1
                        out.append([s["name"], same - (1 << 64) if same >> 63 else same, key, t, s["at"], s["crowded"], 0, None])
            fields = [f.split() for f in kind.split(", ")]
            types = {"long": pa.int64(), "boolean": pa.bool_(), "binary": pa.binary()}
            columns = zip(*out, strict=True) if out else [[]] * len(fields)
            yield pa.RecordBatch.from_arrays([pa.array(c, types[k]) for c, (_, k) in zip(columns, fields, strict=True)], [n for n, _ in fields])

    return texts.mapInArrow(run, kind)


def sorted_matches(cut: DataFrame, least: int) -> DataFrame:
    """`name`, `same` and `spans` (begin, end) of what repeats in the stretches, by suffix order."""
    kind = "name long, same long, spans array<struct<a:long,b:long>>"

    def judged(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        name, same = (np.asarray(rows.column(c).combine_chunks()) for c in ("name", "same"))
        order = np.lexsort((same, name))
        first = np.flatnonzero(np.r_[True, (name[order][1:] != name[order][:-1]) | (same[order][1:] != same[order][:-1])])
        times = np.add.reduceat(np.asarray(rows.column("times").combine_chunks())[order], first)
        one = rows.take(pa.array(order[first]))
        held = b"".join(one.column("stretch").to_pylist())
        sizes = np.fromiter(map(len, one.column("stretch").to_pylist()), np.int64, len(one))
        ends = np.r_[0, np.cumsum(sizes)]
        earlier, later = previous_factors(np.frombuffer(held, np.uint8), ends, least)
        found = (earlier >= 0) | (later >= 0)
        # Of an equal stretch elsewhere, every window is one that repeats.
        for i in np.flatnonzero(times > 1).tolist():
            found[ends[i] : ends[i + 1] - least + 1] = True
        at = np.flatnonzero(found)
        of = np.searchsorted(ends, at, side="right") - 1
        lists = []
        each = np.searchsorted(of, np.arange(len(one) + 1))
        for i in range(len(one)):
            a, b = spans(at[each[i] : each[i + 1]] - ends[i], least)
            lists.append([{"a": x, "b": y} for x, y in zip(a.tolist(), b.tolist(), strict=True)])
        kept = np.flatnonzero(np.diff(each) > 0)
        columns = [one.column("name").combine_chunks().take(pa.array(kept)), one.column("same").combine_chunks().take(pa.array(kept))]
        told = pa.array([lists[i] for i in kept.tolist()], pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())])))
        yield pa.RecordBatch.from_arrays([*columns, told], ["name", "same", "spans"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come in order of name; a name's rows are judged together."""
        held, size = [], 0
        for batch in batches:
            held.append(batch)
            size += batch.nbytes
            if size < SORTED_BYTES:
                continue
            rows = pa.Table.from_batches(held).combine_chunks()
            name = np.asarray(rows.column("name").combine_chunks())
            last = int(np.searchsorted(name, name[-1], side="left"))
            if last:
                yield from judged(rows.slice(0, last))
                held = rows.slice(last).to_batches()
                size = sum(b.nbytes for b in held)
        if held and sum(map(len, held)):
            yield from judged(pa.Table.from_batches(held).combine_chunks())

    parts = int(cut.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    thin = cut.where(~F.col("crowded") & F.col("stretch").isNotNull()).select("name", "same", "times", "stretch")
    return thin.repartition(parts, "name").sortWithinPartitions("name").mapInArrow(run, kind)


def counted_matches(cut: DataFrame, least: int) -> DataFrame:
    """The same for crowded names, by counting the windows' hashes."""
    kind = "name long, same long, times long, k long, w1 long, w2 long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                held, n = memoryview(r["stretch"]), len(r["stretch"]) - least + 1
                digests = np.frombuffer(b"".join([xxhash.xxh128_digest(held[k : k + least]) for k in range(n)]), "<i8").reshape(-1, 2)
                same = [np.full(n, r[c], np.int64) for c in ("name", "same", "times")]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (*same, np.arange(n), digests[:, 0], digests[:, 1])], [f.split()[0] for f in kind.split(", ")])

    thin = cut.where(F.col("crowded") & F.col("stretch").isNotNull()).select("name", "same", "times", "stretch")
    # One row of equal stretches of different slices.
    one = thin.groupBy("name", "same").agg(F.sum("times").alias("times"), F.max("stretch").alias("stretch"))
    windows = one.mapInArrow(run, kind)
    often = windows.groupBy("w1", "w2").agg(F.sum("times").alias("_n")).where(F.col("_n") > 1).drop("_n")
    return windows.join(often, ["w1", "w2"]).groupBy("name", "same").agg(
        F.transform(F.collect_list("k"), lambda k: F.struct(k.alias("a"), (k + least).alias("b"))).alias("spans")
    )


def without_repeats(docs: DataFrame, least: int = 200, crowd: int = CROWD) -> DataFrame:
    """Each document without the bytes that a string of `least` bytes covers which also starts anywhere else.

    Returns `doc_id`, `n_bytes`, `n_removed`, `n_spans` (maximal removed runs), `kept_sha256`, `kept` (the bytes that stay) for every row. Null texts are empty; equal rows
    are copies of each other; columns of the input's own play no part. Matches never cross texts, and overlaps count.
    """
    keyed = _keyed(docs)
    found = [F.count("*").alias("n"), F.min("same").alias("lo"), F.max("same").alias("hi"), F.max("again").alias("again")]
    names = named_stretches(keyed, least, False).groupBy("name").agg(*found)
    differ = (F.col("lo") != F.col("hi")) | F.col("again")
    several = names.where((F.col("n") > 1) | F.col("again")).select("name", differ.alias("differ"), (F.col("n") > crowd).alias("crowded"))
    there = named_stretches(keyed, least, True).join(several, "name")
    entry = F.struct("at", "windows", "name", "crowded", "differ")
    # Equal rows have equal lists, so a set holds a list once.
    lists = written(there.groupBy("id", "t").agg(F.collect_set(entry).alias("found")), "stretches")
    open_lists = lists.select("id", "t", F.filter("found", lambda s: s["differ"]).alias("open")).where(F.size("open") > 0)
    cut = written(cut_out(packed(keyed, "id", "t", "text").join(open_lists, ["id", "t"]), least), "stretch-bytes")
    matches = sorted_matches(cut, least).unionByName(counted_matches(cut, least))
    placed = cut.select("name", "same", "id", "t", "at").join(matches, ["name", "same"])
    placed = placed.select("id", "t", F.transform("spans", lambda s: F.struct((s["a"] + F.col("at")).alias("a"), (s["b"] + F.col("at")).alias("b"))).alias("spans"))
    sure = lists.select("id", "t", F.transform(F.filter("found", lambda s: ~s["differ"]), lambda s: F.struct(s["at"].alias("a"), (s["at"] + s["windows"] + (least - 1)).alias("b"))).alias("spans"))
    covered = placed.unionByName(sure).groupBy("id", "t").agg(F.flatten(F.collect_list("spans")).alias("spans"))
    joined = packed(keyed, "doc_id", "id", "t", "text").join(covered, ["id", "t"], "left").select("doc_id", "packed", "spans")
    return joined.mapInArrow(_left_over, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")


def _left_over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sizes, removed, runs, digests, rests = [], [], [], [], []
        for text, found in zip(unpacked(batch.column("packed")), batch.column("spans"), strict=True):
            kept, at, taken, count = [], 0, 0, 0
            end = -1
            for s in sorted((s["a"], s["b"]) for s in found.as_py() or []):
                if s[0] > end:
                    if end >= 0:
                        taken, count = taken + end - begin, count + 1  # noqa: F821
                        kept.append(text[at:begin])  # noqa: F821
                        at = end
                    begin, end = s
                else:
                    end = max(end, s[1])
            if end >= 0:
                taken, count = taken + end - begin, count + 1
                kept.append(text[at:begin])
                at = end
            rest = b"".join([*kept, text[at:]])
            sizes.append(len(text))
            removed.append(taken)
            runs.append(count)
            digests.append(hashlib.sha256(rest).hexdigest())
            rests.append(rest)
        columns = [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()), pa.array(runs, pa.int64()), pa.array(digests, pa.string()), pa.array(rests, pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])
