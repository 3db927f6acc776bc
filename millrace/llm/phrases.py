"""Phrases of two to five words that occur often, by direct-address tiling.

Words are ranked by frequency over the corpus. A map task turns neighbouring words into pairs of ranks; the plane of
pairs is cut into tiles, small ones where the ranks are low and pairs are many, and the task sends each tile it has counts in as one
block of cells and counts. The task that has a tile adds its blocks: tiles of at most DENSE cells into a dense array with
bincount, larger ones, where most cells are empty, as sorted coordinate lists. Pairs found often enough are ranked
in turn, and neighbouring pairs are counted the same way as pairs of pairs, which are phrases of three words, and so on.

A word's identity is a 64-bit hash of language and bytes, a phrase's the hash of its two halves that overlap. At most HEAD
words or phrases of a level have a rank, so the table of ranks that tasks get has a fixed size. Those beyond are
counted exactly all the same, as lists of hash pairs in tiles of their own; a bit map of fixed size tells most of the
rare ones beforehand, which takes no part in what is counted. Every part of a phrase is at least as frequent as the phrase, so pairs of
rare halves need no count.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import slices, written
from millrace.llm.runs import Words, paired, strings, words

LONGEST = 5
HEAD = 1 << 18
BITS = 1 << 26  # of the bit map of what has no rank
DENSE = 1 << 20
HELD = 1 << 21  # pairs that a task holds before it adds equal ones
WORD_SLICES = 8  # slices whose words are added before they are sent
UNKNOWN = "und"

# Ranks up to the bound are cut into bands of so many.
BANDS = ((1 << 10, 1 << 6), (1 << 14, 1 << 10), (HEAD, 1 << 13))

_CUTS = b".,;:!?\n\x0b\x0c\r"
_INSIDE = np.array([c not in b" \t" + _CUTS for c in range(256)])
_ENDS = np.array([c in _CUTS for c in range(256)])


def _edges() -> np.ndarray:
    """First rank of each band, and the end of the last."""
    out, at = [], 0
    for to, side in BANDS:
        out += range(at, to, side)
        at = to
    return np.array([*out, at], np.int64)


EDGES = _edges()
SIDES = np.diff(EDGES)


def _pieces(part: pa.RecordBatch) -> tuple[Words, np.ndarray, np.ndarray]:
    """The words of a slice, their hashes with the language in them, and the piece each is of."""
    found = words(part.column("text"), _INSIDE)
    langs = part.column("lang").dictionary_encode()
    names = np.array([xxhash.xxh64_intdigest(x.encode()) for x in langs.dictionary.to_pylist()] or [0], np.uint64)
    of = np.asarray(langs.indices).astype(np.int64)
    cut = _ENDS[found.data]
    cut[found.ends[:-1][found.ends[:-1] < len(cut)]] = True
    return found, paired(found.hash, names[of[found.doc]]), np.cumsum(cut)[found.start]


def _added(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, with their summed counts."""
    if not keys:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    key, count = np.concatenate(keys), np.concatenate(counts)
    order = np.argsort(key, kind="stable")
    key = key[order]
    first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, np.int64)
    return key[first], np.add.reduceat(count[order], first) if len(first) else count


def word_counts(docs: DataFrame) -> DataFrame:
    """`lang`, `word`, `h` and `n` of every word, and a row without a word for each language's total."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        totals: dict[str, int] = {}

        def sent() -> Iterator[pa.RecordBatch]:
            whole = pa.concat_tables(held).combine_chunks()
            h = np.asarray(whole.column("h")).view(np.uint64)
            _, first, back = np.unique(h, return_index=True, return_inverse=True)
            n = np.zeros(len(first), np.int64)
            np.add.at(n, back, np.asarray(whole.column("n")))
            out = whole.take(first)
            yield from out.set_column(out.schema.get_field_index("n"), "n", pa.array(n)).to_batches()

        for part in slices(batches, "text"):
            found, h, _ = _pieces(part)
            one, first, n = np.unique(h, return_index=True, return_counts=True)
            langs = part.column("lang").take(pa.array(found.doc[first]))
            columns = [langs, strings(found, first), pa.array(one.view(np.int64)), pa.array(n)]
            held.append(pa.table(columns, ["lang", "word", "h", "n"]))
            of = part.column("lang").dictionary_encode()
            each = np.bincount(np.asarray(of.indices)[found.doc], minlength=len(of.dictionary))
            for name, k in zip(of.dictionary.to_pylist(), each.tolist(), strict=True):
                totals[name] = totals.get(name, 0) + k
            if len(held) == WORD_SLICES:
                yield from sent()
                held = []
        if held:
            yield from sent()
        names = list(totals)
        empty = [pa.nulls(len(names), pa.string()), pa.nulls(len(names), pa.int64())]
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), *empty, pa.array(list(totals.values()), pa.int64())], ["lang", "word", "h", "n"])

    kind = "lang string, word string, h long, n long"
    return docs.mapInArrow(run, kind).groupBy("lang", "word", "h").agg(F.sum("n").alias("n"))


class Ranks:
    """Hashes by rank, and a bit map of those that have none."""

    def __init__(self, by_rank: np.ndarray, bits: np.ndarray | None, tail_tiles: int):
        self.by_rank, self.bits, self.tail_tiles = by_rank, bits, tail_tiles
        self.rank_of = np.argsort(by_rank, kind="stable")
        self.sorted = by_rank[self.rank_of]

    def find(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ranks (-1: none), and which hashes may be of a frequent one."""
        at = np.searchsorted(self.sorted, h)
        at[at == len(self.sorted)] = 0
        rank = np.where(self.sorted[at] == h, self.rank_of[at], -1)
        may = rank >= 0
        if self.bits is not None:
            bit = h & np.uint64(BITS - 1)
            may |= (self.bits[(bit >> np.uint64(3)).astype(np.int64)] >> (bit & np.uint64(7)).astype(np.uint8)) & 1 == 1
        return rank, may


def ranked(level: DataFrame, head: int = HEAD) -> Ranks | None:
    """Ranks of a level's phrases by falling frequency; None if there are none. Only `head` hashes and the bit map reach the driver."""
    top = level.select("h", "n").orderBy(F.desc("n"), "h").limit(head).toArrow()
    by_rank = np.asarray(top.column("h").combine_chunks()).view(np.uint64)
    if not len(by_rank):
        return None
    rest, bits = level.count() - len(by_rank), None
    if rest > 0:
        last = top.slice(len(by_rank) - 1).to_pylist()[0]
        beyond = (F.col("n") < last["n"]) | ((F.col("n") == last["n"]) & (F.col("h") > last["h"]))
        bit = F.col("h").bitwiseAND(F.lit(BITS - 1))
        at = level.where(beyond).select((bit / 8).cast("int").alias("byte"), (bit % 8).cast("int").alias("bit"))
        rows = at.groupBy("byte").agg(F.bit_or(F.expr("shiftleft(1, bit)")).alias("held")).toArrow()
        bits = np.zeros(BITS >> 3, np.uint8)
        bits[np.asarray(rows.column("byte"))] = np.asarray(rows.column("held")).astype(np.uint8)
    return Ranks(by_rank, bits, 256 * -(-max(0, rest) // head))


def pair_counts(docs: DataFrame, size: int, ranks: Ranks, least: int) -> DataFrame:
    """`a`, `b`, `h` and `n` of all phrases of `size` words found `least` times or more; `a` and `b` are the hashes of their halves."""
    tail = len(SIDES) ** 2

    def blocks(keys: np.ndarray, counts: np.ndarray) -> Iterator[pa.RecordBatch]:
        r1, r2 = (keys >> np.uint64(32)).astype(np.int64), (keys & np.uint64(0xFFFFFFFF)).astype(np.int64)
        i, j = np.searchsorted(EDGES, r1, side="right") - 1, np.searchsorted(EDGES, r2, side="right") - 1
        tile = i * len(SIDES) + j
        cell = ((r1 - EDGES[i]) * SIDES[j] + (r2 - EDGES[j])).astype("<u4")
        yield from rows(tile, [cell], counts)

    def rows(tile: np.ndarray, cells: list[np.ndarray], counts: np.ndarray) -> Iterator[pa.RecordBatch]:
        order = np.argsort(tile, kind="stable")
        tile, counts = tile[order], counts[order].astype("<u4")
        ends = np.r_[np.flatnonzero(np.r_[True, tile[1:] != tile[:-1]]), len(tile)].astype(np.int32)
        packed = [pa.py_buffer(x[order].tobytes()) for x in cells] + [pa.py_buffer(counts.tobytes())]
        widths = [x.dtype.itemsize for x in cells] + [4]
        n = len(ends) - 1
        columns = [pa.BinaryArray.from_buffers(pa.binary(), n, [None, pa.py_buffer(ends * w), p]) for p, w in zip(packed, widths, strict=True)]
        if len(cells) == 1:
            columns.insert(1, pa.nulls(n, pa.binary()))
        yield pa.RecordBatch.from_arrays([pa.array(tile[ends[:-1]]), *columns], ["tile", "x", "y", "counts"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts, held = [], [], 0
        for part in slices(batches, "text"):
            _, h, piece = _pieces(part)
            for _ in range(size - 2):
                h = paired(h[:-1], h[1:])
            if len(h) < 2:
                continue
            rank, may = ranks.find(h)
            good = may[:-1] & may[1:] & (piece[size - 1 :] == piece[: len(piece) - size + 1])
            both = good & (rank[:-1] >= 0) & (rank[1:] >= 0)
            at = np.flatnonzero(both)
            keys.append((rank[at].astype(np.uint64) << np.uint64(32)) | rank[at + 1].astype(np.uint64))
            counts.append(np.ones(len(at), np.int64))
            held += len(at)
            if held > HELD:
                key, n = _added(keys, counts)
                keys, counts, held = [key], [n], len(key)
                if held > HELD // 2:
                    yield from blocks(key, n)
                    keys, counts, held = [], [], 0
            odd = np.flatnonzero(good & ~both)
            if len(odd):
                a, b, n = _added_pairs(h[odd], h[odd + 1], np.ones(len(odd), np.int64))
                where = tail + (paired(a, b) % np.uint64(ranks.tail_tiles)).astype(np.int64)
                yield from rows(where, [a, b], n)
        key, n = _added(keys, counts)
        if len(key):
            yield from blocks(key, n)

    def found(a: np.ndarray, b: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        columns = [a.view(np.int64), b.view(np.int64), paired(a, b).view(np.int64), n]
        return pa.RecordBatch.from_arrays([pa.array(x) for x in columns], ["a", "b", "h", "n"])

    def ended(tile: int, dense: np.ndarray | None, lists: list) -> pa.RecordBatch:
        if tile >= tail:
            a, b, n = _added_pairs(*(np.concatenate(x) for x in zip(*lists, strict=True)))
            often = n >= least
            return found(a[often], b[often], n[often])
        i, j = divmod(tile, len(SIDES))
        if dense is None:
            cell, n = _added([x for x, _ in lists], [n for _, n in lists])
        else:
            cell, n = np.arange(len(dense)), dense
        often = n >= least
        cell, n = cell[often].astype(np.int64), n[often]
        return found(ranks.by_rank[EDGES[i] + cell // SIDES[j]], ranks.by_rank[EDGES[j] + cell % SIDES[j]], n)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Blocks come in order of their tiles, so one tile is open at a time."""
        tile, dense, lists, held = None, None, [], 0
        for batch in batches:
            for row in batch.to_pylist():
                if row["tile"] != tile:
                    if tile is not None:
                        yield ended(tile, dense, lists)
                    tile, dense, lists, held = row["tile"], None, [], 0
                    if tile < tail and SIDES[tile // len(SIDES)] * SIDES[tile % len(SIDES)] <= DENSE:
                        dense = np.zeros(SIDES[tile // len(SIDES)] * SIDES[tile % len(SIDES)], np.int64)
                n = np.frombuffer(row["counts"], "<u4").astype(np.int64)
                if tile >= tail:
                    lists.append((np.frombuffer(row["x"], np.uint64), np.frombuffer(row["y"], np.uint64), n))
                elif dense is not None:
                    cell = np.frombuffer(row["x"], "<u4")
                    if len(cell) * 8 < len(dense):
                        dense[cell] += n  # a block names a cell once
                    else:
                        dense += np.bincount(cell, weights=n, minlength=len(dense)).astype(np.int64)
                else:
                    lists.append((np.frombuffer(row["x"], "<u4"), n))
                held += len(n)
                if dense is None and held > HELD:
                    lists = [_added_pairs(*(np.concatenate(x) for x in zip(*lists, strict=True)))] if tile >= tail else [_added(*map(list, zip(*lists, strict=True)))]
                    held = -len(lists[0][-1])
        if tile is not None:
            yield ended(tile, dense, lists)

    sent = docs.mapInArrow(run, "tile long, x binary, y binary, counts binary")
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return sent.repartition(parts, "tile").sortWithinPartitions("tile").mapInArrow(add, "a long, b long, h long, n long")


def _added_pairs(a: np.ndarray, b: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    order = np.lexsort((b, a))
    a, b, n = a[order], b[order], n[order]
    first = np.flatnonzero(np.r_[True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])])
    return a[first], b[first], np.add.reduceat(n, first)


def levels(docs: DataFrame, least: int, head: int = HEAD) -> tuple[DataFrame, list[DataFrame]]:
    """Word totals by language (`lang`, `total`), and for each length the frequent phrases: `lang`, `phrase`, `last`, `h`, `n`."""
    lang, text = F.coalesce(F.col("lang").cast("string"), F.lit(UNKNOWN)), F.coalesce(F.col("text").cast("string"), F.lit(""))
    thin = docs.select(lang.alias("lang"), text.alias("text"))
    counted = written(word_counts(thin).where(F.col("word").isNull() | (F.col("n") >= least)), "words")
    totals = counted.where(F.col("word").isNull()).select("lang", F.col("n").alias("total"))
    one = counted.where(F.col("word").isNotNull()).select("lang", F.col("word").alias("phrase"), F.col("word").alias("last"), "h", "n")
    out = [one]
    for size in range(2, LONGEST + 1):
        ranks = ranked(out[-1], head)
        if ranks is None:
            break
        pairs = pair_counts(thin, size, ranks, least)
        left = out[-1].select(F.col("h").alias("a"), "lang", F.col("phrase").alias("_first"))
        right = out[-1].select(F.col("h").alias("b"), "last")
        phrase = F.concat_ws(" ", "_first", "last").alias("phrase")
        out.append(written(pairs.join(left, "a").join(right, "b").select("lang", phrase, "last", "h", "n"), f"phrases-{size}"))
    return totals, out


def collocations(docs: DataFrame, least: int = 100, top: int = 2000, head: int = HEAD) -> DataFrame:
    """Each language's `top` phrases by `score`: `lang`, `rank`, `phrase`, `a`, `l`, `r`, `n`, `score`.

    A score is floor(1000 * a * n / (l * r)) at the cut of the phrase that gives the least (ties: the first cut); a is the
    phrase's count, l and r those of its two sides, n the words of the language. A phrase inside a longer one that is as frequent is left out.
    Null texts are empty, a null lang is `und`; equal rows each count; a corpus without frequent phrases gives no rows.
    """
    totals, found = levels(docs, least, head)
    spark = docs.sparkSession
    if len(found) < 2:
        kind = "lang string, rank int, phrase string, a long, l long, r long, n long, score long"
        return spark.createDataFrame([], kind)
    every = found[0].select("lang", "phrase", "n")
    for level in found[1:]:
        every = every.unionByName(level.select("lang", "phrase", "n"))
    several = found[1].select("lang", "phrase", F.col("n").alias("a"))
    for level in found[2:]:
        several = several.unionByName(level.select("lang", "phrase", F.col("n").alias("a")))
    parts = F.split("phrase", " ")
    longer = (
        several.where(F.size(parts) > 2)
        .select("lang", "a", F.explode(F.array(F.array_join(F.slice(parts, F.lit(1), F.size(parts) - 1), " "), F.array_join(F.slice(parts, F.lit(2), F.size(parts) - 1), " "))).alias("phrase"))
        .groupBy("lang", "phrase")
        .agg(F.max("a").alias("_longer"))
    )
    kept = several.join(longer, ["lang", "phrase"], "left").where(F.col("_longer").isNull() | (F.col("_longer") < F.col("a"))).drop("_longer")
    cuts = kept.select("lang", "phrase", "a", F.explode(F.sequence(F.lit(1), F.size(parts) - 1)).alias("k"))
    first, rest = F.slice(parts, F.lit(1), F.col("k")), F.slice(parts, F.col("k") + 1, F.size(parts) - F.col("k"))
    cuts = cuts.select("lang", "phrase", "a", "k", F.array_join(first, " ").alias("_first"), F.array_join(rest, " ").alias("_rest"))
    cuts = cuts.join(every.select("lang", F.col("phrase").alias("_first"), F.col("n").alias("l")), ["lang", "_first"])
    cuts = cuts.join(every.select("lang", F.col("phrase").alias("_rest"), F.col("n").alias("r")), ["lang", "_rest"]).join(totals, "lang")
    exact = {c: F.col(c).cast("decimal(19,0)") for c in ("a", "l", "r", "total")}
    scored = cuts.withColumns({f"_{c}": x for c, x in exact.items()}).withColumn("score", F.expr("cast((1000 * (_a * _total)) div (_l * _r) as bigint)"))
    least_cut = scored.groupBy("lang", "phrase", "a", "total").agg(F.min(F.struct("score", "k", "l", "r")).alias("c"))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    out = least_cut.select("lang", "phrase", "a", F.col("c.l"), F.col("c.r"), F.col("total").alias("n"), F.col("c.score").alias("score"))
    out = out.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return out.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def sql(least: int = 100, top: int = 2000) -> str:
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return rf"""
WITH pieces AS (
  SELECT coalesce(lang, '{UNKNOWN}') AS lang,
         unnest(string_split_regex(translate(coalesce(text, ''), '{upper}', '{lower}'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
), worded AS (
  SELECT lang, row_number() OVER () AS p, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces
), totals AS (
  SELECT lang, CAST(sum(len(w)) AS HUGEINT) AS n FROM worded GROUP BY lang
), words AS (
  SELECT lang, p, unnest(w) AS w1, generate_subscripts(w, 1) AS i FROM worded
), runs AS (
  SELECT lang, w1, lead(w1, 1) OVER o AS w2, lead(w1, 2) OVER o AS w3, lead(w1, 3) OVER o AS w4, lead(w1, 4) OVER o AS w5
  FROM words WINDOW o AS (PARTITION BY p ORDER BY i)
), grams AS (
  SELECT lang, 1 AS m, w1 AS phrase FROM runs
  UNION ALL SELECT lang, 2, w1 || ' ' || w2 FROM runs WHERE w2 IS NOT NULL
  UNION ALL SELECT lang, 3, w1 || ' ' || w2 || ' ' || w3 FROM runs WHERE w3 IS NOT NULL
  UNION ALL SELECT lang, 4, w1 || ' ' || w2 || ' ' || w3 || ' ' || w4 FROM runs WHERE w4 IS NOT NULL
  UNION ALL SELECT lang, 5, w1 || ' ' || w2 || ' ' || w3 || ' ' || w4 || ' ' || w5 FROM runs WHERE w5 IS NOT NULL
), counted AS (
  SELECT lang, m, phrase, count(*) AS f FROM grams GROUP BY ALL HAVING count(*) >= {least}
), inner_parts AS (
  SELECT lang, f, unnest([array_to_string(string_split(phrase, ' ')[: m - 1], ' '), array_to_string(string_split(phrase, ' ')[2 :], ' ')]) AS phrase
  FROM counted WHERE m > 2
), covered AS (
  SELECT lang, phrase, max(f) AS f FROM inner_parts GROUP BY ALL
), kept AS (
  SELECT c.* FROM counted c LEFT JOIN covered d ON c.lang = d.lang AND c.phrase = d.phrase
  WHERE c.m > 1 AND coalesce(d.f, 0) < c.f
), cuts AS (
  SELECT k.*, unnest(range(1, m)) AS k FROM kept k
), scored AS (
  SELECT c.lang, c.phrase, c.f AS a, c.k, x.f AS l, y.f AS r, t.n,
         (1000::HUGEINT * c.f * t.n) // (x.f::HUGEINT * y.f) AS score
  FROM cuts c
  JOIN counted x ON x.lang = c.lang AND x.phrase = array_to_string(string_split(c.phrase, ' ')[: c.k], ' ')
  JOIN counted y ON y.lang = c.lang AND y.phrase = array_to_string(string_split(c.phrase, ' ')[c.k + 1 :], ' ')
  JOIN totals t ON t.lang = c.lang
), best AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
)
SELECT lang, CAST(row_number() OVER w AS BIGINT) AS rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l,
       CAST(r AS BIGINT) AS r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM best
WINDOW w AS (PARTITION BY lang ORDER BY score DESC, a DESC, phrase)
QUALIFY row_number() OVER w <= {top}
"""
