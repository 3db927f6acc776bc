"""Near-duplicate groups by SimHash fingerprints, with candidates from the pigeonring filter.

A 64-bit fingerprint is cut into five segments that form a ring. If two fingerprints
differ in at most four bits, then from some segment on every chain of consecutive
segments stays within its share of the budget: 0 differing bits in the first one, 1 in the first
two, 2 in three, 3 in four. The first two conditions are the blocking key: segment i as it is, and
segment i + 1 with one of its bits masked out, for each bit in turn. Pairs that meet under a
key are held against the longer chains and then the full distance.

Only distinct fingerprints are compared, so copies cost nothing. A key group gives the
links of a spanning forest and never all its pairs. Groups above `group` rows are not
compared in one task: their rows are dealt in blocks, and each pair of blocks is a task's work.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import aside, slices, string_parts, written

P1, P2, P3 = np.uint64(11400714785074694791), np.uint64(14029467366897019727), np.uint64(1609587929392839161)
P4, P5 = np.uint64(9650029242287828579), np.uint64(2870177450012600261)
LONG = 4096  # bytes; longer shingles are hashed one by one

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32
LOWER[SPACE] = 0x20


def _turn(x: np.ndarray, r: int) -> np.ndarray:
    return (x << np.uint64(r)) | (x >> np.uint64(64 - r))


def _round(acc: np.ndarray, word: np.ndarray) -> np.ndarray:
    return _turn(acc + word * P2, 31) * P1


def xxh64(data: np.ndarray, start: np.ndarray, size: np.ndarray, seed: int = 42) -> np.ndarray:
    """XXH64 of many byte ranges of one array at once."""
    if not len(start):
        return np.zeros(0, np.uint64)
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    words = np.ndarray((len(padded) - 7,), "<u8", padded, strides=(1,))
    halves = np.ndarray((len(padded) - 3,), "<u4", padded, strides=(1,))
    with np.errstate(over="ignore"):
        first = np.uint64(seed)
        h = np.full(len(start), first + P5, np.uint64)
        whole = np.where(size <= LONG, size >> 5, 0)
        big = np.flatnonzero(whole)
        if len(big):
            lanes = [np.full(len(big), x, np.uint64) for x in (first + P1 + P2, first + P2, first, first - P1)]
            at, left = start[big].copy(), whole[big].copy()
            on = np.arange(len(big))
            while len(on):
                for k in range(4):
                    lanes[k][on] = _round(lanes[k][on], words[at[on] + 8 * k])
                at[on] += 32
                left[on] -= 1
                on = on[left[on] > 0]
            acc = _turn(lanes[0], 1) + _turn(lanes[1], 7) + _turn(lanes[2], 12) + _turn(lanes[3], 18)
            for lane in lanes:
                acc = (acc ^ _round(np.zeros_like(lane), lane)) * P1 + P4
            h[big] = acc
        h += size.astype(np.uint64)
        at, rest = start + (whole << 5), size & 31
        on = np.flatnonzero(rest >= 8)
        while len(on):
            h[on] = _turn(h[on] ^ _round(np.uint64(0), words[at[on]]), 27) * P1 + P4
            at[on] += 8
            rest[on] -= 8
            on = on[rest[on] >= 8]
        on = np.flatnonzero(rest >= 4)
        if len(on):
            h[on] = _turn(h[on] ^ (halves[at[on]].astype(np.uint64) * P1), 23) * P2 + P3
            at[on] += 4
            rest[on] -= 4
        on = np.flatnonzero(rest > 0)
        while len(on):
            h[on] = _turn(h[on] ^ (padded[at[on]].astype(np.uint64) * P5), 11) * P1
            at[on] += 1
            rest[on] -= 1
            on = on[rest[on] > 0]
        h = (h ^ (h >> np.uint64(33))) * P2
        h = (h ^ (h >> np.uint64(29))) * P3
        h ^= h >> np.uint64(32)
    for i in np.flatnonzero(size > LONG):
        h[i] = xxhash.xxh64_intdigest(data[start[i] : start[i] + size[i]].tobytes(), seed)
    return h


def _shingles(data: np.ndarray, ends: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Normal bytes, and text, start and size of each shingle; texts of fewer words give one."""
    low = LOWER[data]
    solid = ~SPACE[low]
    edge = np.zeros(len(low) + 1, bool)
    edge[ends[:-1]] = True  # an empty last text points past the end
    edge = edge[: len(low)]
    before = np.empty_like(solid)
    before[:1] = False
    before[1:] = solid[:-1]
    before &= ~edge
    starts = np.flatnonzero(solid & ~before)
    stops = np.empty_like(solid)
    stops[-1:] = True
    stops[:-1] = ~solid[1:] | edge[1:]
    lasts = np.flatnonzero(solid & stops)
    keep = solid | before  # a word and the one space after it
    place = np.cumsum(keep) - 1
    compact = low[keep]
    first, last = place[starts], place[lasts] + 1
    of = np.searchsorted(ends, starts, side="right") - 1
    counts = np.bincount(of, minlength=len(ends) - 1)
    lead = np.cumsum(counts) - counts
    n = np.arange(len(starts)) - lead[of]
    full = n + words <= counts[of]
    i = np.flatnonzero(full)
    few = np.flatnonzero((counts > 0) & (counts < words))
    text = np.concatenate([of[i], few])
    start = np.concatenate([first[i], first[lead[few]]])
    stop = np.concatenate([last[i + words - 1], last[lead[few] + counts[few] - 1]])
    order = np.argsort(text, kind="stable")
    return compact, text[order], start[order], (stop - start)[order]


def hash_texts(texts: pa.Array, words: int, seed: int = 42) -> np.ndarray:
    """The fingerprints of texts; a null text is like an empty one."""
    data, ends = string_parts(texts)
    out = np.zeros(len(texts), np.uint64)
    if not len(data):
        return out
    compact, text, start, size = _shingles(data, ends, words)
    if not len(text):
        return out
    hashes = xxh64(compact, start, size, seed)
    counts = np.bincount(text, minlength=len(texts))
    step = 1 << 16
    ones = np.zeros((len(texts), 64), np.int64)
    for at in range(0, len(hashes), step):
        bits = np.unpackbits(hashes[at : at + step].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        own = text[at : at + step]
        cut = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
        ones[own[cut]] += np.add.reduceat(bits, cut, axis=0, dtype=np.int32)
    over = (2 * ones > counts[:, None]).astype(np.uint8)
    return np.packbits(over, axis=1, bitorder="little").view(np.uint64).ravel()


def fingerprints(docs: DataFrame, words: int = 4) -> DataFrame:
    """`doc_id`, `text_key` (a hash of the text) and `fp`, the fingerprint as a signed long, of each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            fp = hash_texts(part.column("text"), words).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("text_key"), pa.array(fp)], ["doc_id", "text_key", "fp"]
            )

    thin = docs.select(F.col("doc_id").cast("long"), _text_key().alias("text_key"), F.col("text").cast("string"))
    return thin.mapInArrow(run, "doc_id long, text_key long, fp long")


def _text_key() -> Column:
    return F.xxhash64(F.col("text").cast("string"))


class Ring:
    """Segments, budgets and masks for a largest distance over 64 bits."""

    def __init__(self, distance: int):
        if not 1 <= distance <= 15:
            raise ValueError("the distance must lie between 1 and 15")
        self.distance, self.segments = distance, distance + 1
        edges = [round(64 * i / self.segments) for i in range(self.segments + 1)]
        self.masks = [((1 << edges[i + 1]) - 1) & ~((1 << edges[i]) - 1) for i in range(self.segments)]
        # What the first 1, 2, ... segments of a chain may differ by; the quota of one is below 1.
        self.budgets = [(n * distance) // self.segments for n in range(1, self.segments + 1)]
        self.keys = []
        for i in range(self.segments):
            second = self.masks[(i + 1) % self.segments]
            self.keys += [(i, self.masks[i] | (second & ~(1 << b))) for b in range(64) if second >> b & 1]
        self.starts = np.array([i for i, _ in self.keys])

    def chains(self, i: int) -> list[tuple[np.uint64, int]]:
        """Masks and budgets of the chains from segment `i`, longest last."""
        out, mask = [], 0
        for n in range(self.segments):
            mask |= self.masks[(i + n) % self.segments]
            out.append((np.uint64(mask), self.budgets[n]))
        return out

    def linked(self, start: int, difference: np.ndarray) -> np.ndarray:
        """Where a difference passes each chain from `start`, the last of which is the full distance."""
        ok = np.ones(difference.shape, bool)
        for mask, most in self.chains(start)[1:]:
            ok &= np.bitwise_count(difference & mask) <= most
        return ok


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def _forest(ring: Ring, start: int, fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect what a group's fingerprints connect, one per fingerprint at most."""
    left = fps.view(np.uint64)
    a, b = [], []
    while len(left) > 1:
        front, left = left[:1], left[1:]
        while len(front) and len(left):
            block, front = front[: max(1, (1 << 20) // len(left))], front[max(1, (1 << 20) // len(left)) :]
            hit = ring.linked(start, block[:, None] ^ left[None, :])
            found = hit.any(axis=0)
            if found.any():
                a.append(block[hit[:, found].argmax(axis=0)])
                b.append(left[found])
                front = np.concatenate([front, left[found]])
                left = left[~found]
    none = np.zeros(0, np.uint64)
    return np.concatenate(a or [none]).view(np.int64), np.concatenate(b or [none]).view(np.int64)


SMALL = 24
OUT = "deferred boolean, tag int, val long, a long, b long"


def _emit(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    n = len(a)
    none = pa.nulls(n, pa.int64())
    return pa.RecordBatch.from_arrays(
        [pa.array(np.zeros(n, bool)), pa.nulls(n, pa.int32()), none, pa.array(a), pa.array(b)],
        ["deferred", "tag", "val", "a", "b"],
    )


def _defer(tag: int, val: int, fps: np.ndarray) -> pa.RecordBatch:
    n = len(fps)
    cells = [pa.array(np.ones(n, bool)), pa.array(np.full(n, tag, np.int32)), pa.array(np.full(n, val)), pa.array(fps)]
    return pa.RecordBatch.from_arrays([*cells, pa.nulls(n, pa.int64())], ["deferred", "tag", "val", "a", "b"])


def _groups(ring: Ring, batches: Iterator[pa.RecordBatch], group: int | None) -> Iterator[pa.RecordBatch]:
    """Links within groups of rows that come sorted by key; rows of groups above `group` come out as they are."""
    names = ["tag", "val", "cell", "fp"]
    held = [np.zeros(0, k) for k in (np.int32, np.int64, np.int64, np.int64)]
    skipping = None

    def work(cols: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        tag, val, cell, fp = cols
        new = np.r_[True, (tag[1:] != tag[:-1]) | (val[1:] != val[:-1]) | (cell[1:] != cell[:-1])]
        at = np.flatnonzero(new)
        size = np.diff(np.r_[at, len(fp)])
        of = np.cumsum(new) - 1
        bits = fp.view(np.uint64)
        rows = np.flatnonzero((size[of] > 1) & (size[of] <= SMALL))
        starts = ring.starts[tag]
        for step in range(1, SMALL):
            rows = rows[rows + step < len(fp)]
            rows = rows[of[rows] == of[rows + step]]
            if not len(rows):
                break
            for s in range(ring.segments):
                own = rows[starts[rows] == s]
                hit = own[ring.linked(s, bits[own] ^ bits[own + step])]
                if len(hit):
                    yield _emit(fp[hit], fp[hit + step])
        for g in np.flatnonzero(size > SMALL):
            own = slice(at[g], at[g] + size[g])
            if group is not None and size[g] > group:
                yield _defer(int(tag[at[g]]), int(val[at[g]]), fp[own])
            else:
                a, b = _forest(ring, int(ring.starts[tag[at[g]]]), fp[own])
                if len(a):
                    yield _emit(a, b)

    waiting: list[list[np.ndarray]] = []
    count = 0
    for batch in batches:
        cols = [np.asarray(batch.column(n)) for n in names]
        waiting.append(cols)
        count += len(batch)
        if count < 200_000:
            continue
        held = [np.concatenate([h, *(w[i] for w in waiting)]) for i, h in enumerate(held)]
        waiting, count = [], 0
        if skipping is not None:
            other = (held[0] != skipping[0]) | (held[1] != skipping[1])
            to = int(other.argmax()) if other.any() else len(other)
            yield _defer(*skipping, held[3][:to])
            held = [h[to:] for h in held]
            skipping = skipping if not len(held[0]) else None
            if not len(held[0]):
                continue
        last = (held[0] == held[0][-1]) & (held[1] == held[1][-1]) & (held[2] == held[2][-1])
        cut = int(last.argmax())
        if cut:
            yield from work([h[:cut] for h in held])
        held = [h[cut:] for h in held]
        if group is not None and len(held[0]) > group:
            skipping = (int(held[0][0]), int(held[1][0]))
            yield _defer(*skipping, held[3])
            held = [h[:0] for h in held]
    held = [np.concatenate([h, *(w[i] for w in waiting)]) for i, h in enumerate(held)]
    if skipping is not None and len(held[0]):
        other = (held[0] != skipping[0]) | (held[1] != skipping[1])
        to = int(other.argmax()) if other.any() else len(other)
        yield _defer(*skipping, held[3][:to])
        held = [h[to:] for h in held]
    if len(held[0]):
        yield from work(held)


def links(distinct: DataFrame, distance: int = 4, group: int = 4096) -> DataFrame:
    """Pairs (`a`, `b`) of distinct fingerprints `fp` that connect all those within `distance` bits."""
    ring = Ring(distance)
    masked = F.array(*[F.col("fp").bitwiseAND(F.lit(_signed(m))) for _, m in ring.keys])
    keyed = distinct.select(F.posexplode(masked).alias("tag", "val"), "fp").withColumn("cell", F.lit(0).cast("long"))
    found = written(
        keyed.repartition("tag", "val")
        .sortWithinPartitions("tag", "val")
        .mapInArrow(lambda batches: _groups(ring, batches, group), OUT),
        "links",
    )
    rest = found.where("deferred").select("tag", "val", F.col("a").alias("fp"))
    out = found.where(~F.col("deferred")).select("a", "b")
    if rest.isEmpty():
        return out
    # Each pair of blocks of a large group meets in one cell.
    blocks = written(
        rest.groupBy("tag", "val").agg(F.ceil(F.count("*") / F.lit(group)).alias("blocks")), "blocks"
    )
    own = F.pmod(F.xxhash64("fp"), F.col("blocks"))
    cells = (
        rest.join(blocks, ["tag", "val"])
        .withColumn("own", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
        .withColumn("cell", F.least("own", "other") * F.col("blocks") + F.greatest("own", "other"))
        .select("tag", "val", "cell", "fp")
    )
    more = (
        cells.repartition("tag", "val", "cell")
        .sortWithinPartitions("tag", "val", "cell")
        .mapInArrow(lambda batches: _groups(ring, batches, None), OUT)
        .select("a", "b")
    )
    return out.unionAll(written(more, "links-large"))


def components(edges: DataFrame) -> DataFrame:
    """`node` and `root`, the smallest node it is connected with, for each node of the edges.

    Each round takes the smallest root among the neighbours and then the root's root, so that
    long chains shorten by half; a round's table is written to the shared folder.
    """
    both = written(
        edges.select("a", "b").unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges"
    )
    roots = written(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("root")), "roots")
    while True:
        near = both.join(roots.select(F.col("node").alias("b"), "root"), "b").select(F.col("a").alias("node"), "root")
        best = written(near.unionAll(roots).groupBy("node").agg(F.min("root").alias("root")), "best")
        up = best.select(F.col("node").alias("root"), F.col("root").alias("up"))
        jumped = written(best.join(up, "root").select("node", F.col("up").alias("root")), "roots")
        old = roots.select("node", F.col("root").alias("old"))
        if jumped.join(old, "node").where("root < old").isEmpty():
            return jumped
        roots = jumped


def grouped(docs: DataFrame, words: int = 4, distance: int = 4, group: int = 4096) -> DataFrame:
    """Per row `doc_id`, `text_key`, `fp` and `first`, the (doc_id, text_key) that stands for its group.

    Null and empty texts have fingerprint zero. Among a group's rows that with the smallest doc_id
    stands for it, a null doc_id after all others, then the smallest hash of the text.
    """
    prints = written(fingerprints(docs, words), "prints")
    rank = F.struct(F.col("doc_id").isNull().alias("lost"), "doc_id", "text_key")
    firsts = written(prints.groupBy("fp").agg(F.min(rank).alias("first")), "firsts")
    roots = components(links(firsts.select("fp"), distance, group)).withColumnRenamed("node", "fp")
    known = firsts.join(roots, "fp", "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    per_root = known.groupBy("root").agg(F.min("first").alias("top"))
    top = written(known.join(per_root, "root").select("fp", F.col("top").alias("first")), "tops")
    return prints.join(top, "fp").select("doc_id", "text_key", "fp", "first")


def near_duplicates(docs: DataFrame, words: int = 4, distance: int = 4) -> DataFrame:
    """`doc_id`, `fingerprint` (16 hex digits) and `component_id`, one row per row of `docs`."""
    hexed = F.lpad(F.lower(F.hex("fp")), 16, "0")
    return grouped(docs, words, distance).select(
        "doc_id", hexed.alias("fingerprint"), F.col("first.doc_id").alias("component_id")
    )


def keep_first(docs: DataFrame, words: int = 4, distance: int = 4) -> DataFrame:
    """`docs` with one row of each group, all columns kept; of equal rows of one doc_id one stays."""
    stays = grouped(docs, words, distance).where(
        F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("text_key") == F.col("first.text_key"))
    )
    stays = stays.select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key")).distinct()
    id_, key = F.col("doc_id").cast("long"), _text_key()
    held, back = aside(docs, "doc_id", "text")
    marked = held.withColumns({"_row_id": id_, "_row_key": key})
    found = marked.join(stays, F.col("_row_id").eqNullSafe(F.col("_id")) & (F.col("_row_key") == F.col("_key")))
    return found.dropDuplicates(["_row_id", "_row_key"]).select(*held.columns).withColumnsRenamed(back)
