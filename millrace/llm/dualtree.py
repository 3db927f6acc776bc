"""Exact ranked lexical search for many items at once, by two trees.

A document's coordinate for a term is what an occurrence there is worth; an item's is the term's weight. Documents come in shards. Over the
documents of a shard, put in order of the terms they are strongest in, and over the items stands a tree; each node holds
the largest coordinate of each term below it. What a node of items and one of documents can score together at most
is the sum over the items' terms of the products. If that is below the weakest k-th best score of the node's items, no pair below
it can be in a result, and the pair of nodes is dropped with all that is under it. Pairs of leaves that are left
are scored exactly, best bound first, so the k-th scores rise early.

The k-th scores start from a bounded sample of documents, searched first: those of any subset are bounds for
the whole. Items come in blocks of bounded size, each searched over all documents; only a block and its terms reach the driver.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import slices, written
from millrace.llm.runs import words

BLOCK = 512  # items that are searched at a time
SHARD = 4096  # documents under one tree
LEAF, FAN = 16, 8  # documents of a leaf, nodes under a node
ITEM_LEAF, ITEM_FAN = 8, 4
SEED_DOCS = 32_768  # documents of the sample that the first k-th scores come from
INSIDE = np.array([48 <= c <= 57 or 97 <= c <= 122 or c >= 128 for c in range(256)])


class Items:
    """A block of items: the sorted hashes of their terms, and of each item the places of its terms there."""

    def __init__(self, texts: list[str | None]):
        found = words(pa.array([t or "" for t in texts], pa.string()), INSIDE)
        self.vocabulary, place = np.unique(found.hash, return_inverse=True)
        ends = np.searchsorted(found.doc, np.arange(len(texts) + 1))
        self.terms = [np.unique(place[a:b]) for a, b in zip(ends[:-1], ends[1:], strict=True)]


def matched(docs: DataFrame, items: Items) -> DataFrame:
    """`doc_id`, `n` and the items' terms found (`terms`, `tf`, int32) of every document that has a term at all."""
    vocabulary = items.vocabulary

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            found = words(part.column("text"), INSIDE)
            n = np.bincount(found.doc, minlength=len(part))
            if len(vocabulary):
                at = np.searchsorted(vocabulary, found.hash)
                at[at == len(vocabulary)] = 0
                hit = np.flatnonzero(vocabulary[at] == found.hash)
            else:
                at, hit = np.zeros(0, np.int64), np.zeros(0, np.int64)
            key, tf = np.unique(found.doc[hit] * max(1, len(vocabulary)) + at[hit], return_counts=True)
            ends = (np.searchsorted(key, np.arange(len(part) + 1) * max(1, len(vocabulary))) * 4).astype(np.int32)
            term = (key % max(1, len(vocabulary))).astype("<i4")
            lists = [pa.BinaryArray.from_buffers(pa.binary(), len(part), [None, pa.py_buffer(ends), pa.py_buffer(x.tobytes())]) for x in (term, tf.astype("<i4"))]
            whole = pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(n, pa.int64()), *lists], ["doc_id", "n", "terms", "tf"])
            yield whole.filter(pa.array(n > 0))

    thin = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).where(F.col("text").isNotNull())
    return thin.mapInArrow(run, "doc_id long, n long, terms binary, tf binary")


def document_counts(found: DataFrame, terms: int) -> np.ndarray:
    """In how many documents each term is."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(terms, np.int64)
        for batch in batches:
            held = b"".join(batch.column("terms").to_pylist())
            total += np.bincount(np.frombuffer(held, "<i4"), minlength=terms)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["term", "df"])

    got = found.select("terms").mapInArrow(run, "term long, df long").groupBy("term").agg(F.sum("df").alias("df")).toArrow()
    out = np.zeros(terms, np.int64)
    out[np.asarray(got.column("term"))] = np.asarray(got.column("df"))
    return out


class Tree:
    """Nodes by level, root first: each has its range of nodes in the level below."""

    def __init__(self, leaves: int, fan: int):
        sizes = [leaves]
        while sizes[-1] > 1:
            sizes.append(-(-sizes[-1] // fan))
        self.sizes, self.fan = sizes[::-1], fan

    def below(self, level: int, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Nodes of the next level under each of `nodes`, and which of `nodes` they are under; the last level's are themselves."""
        if level + 1 >= len(self.sizes):
            return nodes, np.arange(len(nodes))
        first = nodes * self.fan
        n = np.minimum(first + self.fan, self.sizes[level + 1]) - first
        of = np.repeat(np.arange(len(nodes)), n)
        return np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n) + first[of], of


def _clustered(strength: np.ndarray) -> np.ndarray:
    """Order of rows by the two coordinates that are largest in each."""
    if strength.shape[1] < 2:
        return np.arange(len(strength))
    two = np.argpartition(-strength, 1, axis=1)[:, :2]
    value = np.take_along_axis(strength, two, 1)
    swap = value[:, 0] < value[:, 1]
    two[swap] = two[swap][:, ::-1]
    return np.lexsort((two[:, 1], two[:, 0]))


class ItemTree:
    """The items in order of their weightiest terms, and the terms under each node."""

    def __init__(self, items: Items, weight: np.ndarray):
        self.weight = weight
        some = np.array([i for i, t in enumerate(items.terms) if len(t)], np.int64)
        first = [items.terms[i][np.lexsort((items.terms[i], -weight[items.terms[i]]))][:3].tolist() for i in some]
        self.order = some[sorted(range(len(some)), key=lambda k: first[k])] if len(some) else some
        self.tree = Tree(max(1, -(-len(self.order) // ITEM_LEAF)), ITEM_FAN)
        groups = [[items.terms[i] for i in self.order[k : k + ITEM_LEAF]] for k in range(0, len(self.order), ITEM_LEAF)]
        self.terms = [[np.unique(np.concatenate(g)) for g in groups]]
        for size in self.tree.sizes[-2::-1]:
            below = self.terms[0]
            self.terms.insert(0, [np.unique(np.concatenate(below[k * ITEM_FAN : (k + 1) * ITEM_FAN])) for k in range(size)])
        self.leaves = []
        for k, terms in enumerate(self.terms[-1]):
            own = np.zeros((len(terms), len(groups[k])))
            for j, t in enumerate(groups[k]):
                own[np.searchsorted(terms, t), j] = weight[t]
            self.leaves.append(own)


class Best:
    """The k best documents of each item so far, and the scores below which none can enter."""

    def __init__(self, n: int, k: int, floor: np.ndarray):
        self.k, self.floor = k, floor.copy()
        self.score, self.id = [np.zeros(0)] * n, [np.zeros(0, np.int64)] * n

    def add(self, item: int, score: np.ndarray, ids: np.ndarray) -> None:
        good = (score > 0) & (score >= self.floor[item])
        if not good.any():
            return
        score, ids = np.concatenate([self.score[item], score[good]]), np.concatenate([self.id[item], ids[good]])
        order = np.lexsort((ids, -score))[: self.k]
        self.score[item], self.id[item] = score[order], ids[order]
        if len(order) == self.k:
            self.floor[item] = max(self.floor[item], score[order[-1]])


def search_shard(tree: ItemTree, ids: np.ndarray, ends: np.ndarray, term: np.ndarray, impact: np.ndarray, best: Best) -> tuple[int, int]:
    """Adds the shard's documents to `best`; returns how many pairs of leaves there are, and how many were scored.

    Documents are given by their ids, and by terms and impacts with the ends of each document's.
    """
    width = len(tree.weight)
    n = len(ids)
    dense = np.zeros((n, width), np.float32)  # impacts are below a million, so exact
    dense[np.repeat(np.arange(n), np.diff(ends)), term] = impact
    order = _clustered(dense * tree.weight.astype(np.float32))
    dense, ids = dense[order], ids[order]
    docs = Tree(-(-n // LEAF), FAN)
    most = [np.maximum.reduceat(dense, np.arange(0, n, LEAF), axis=0)]
    for size in docs.sizes[-2::-1]:
        most.insert(0, np.maximum.reduceat(most[0], np.arange(size) * FAN, axis=0))
    pairs = np.zeros((1, 2), np.int64)
    floor = [np.array([best.floor[tree.order[k : k + ITEM_LEAF]].min() for k in range(0, len(tree.order), ITEM_LEAF)])]
    for size in tree.tree.sizes[-2::-1]:
        floor.insert(0, np.minimum.reduceat(floor[0], np.arange(size) * ITEM_FAN))
    bounds = np.zeros(1)
    for level in range(max(len(tree.tree.sizes), len(docs.sizes))):
        up, down = min(level, len(tree.tree.sizes) - 1), min(level, len(docs.sizes) - 1)
        if level:
            node, of = tree.tree.below(level - 1, pairs[:, 0])
            pairs = np.stack([node, pairs[of, 1]], axis=1)
            node, of = docs.below(level - 1, pairs[:, 1])
            pairs = np.stack([pairs[of, 0], node], axis=1)
        pairs = pairs[np.argsort(pairs[:, 0], kind="stable")]
        bounds = np.zeros(len(pairs))
        edge = np.searchsorted(pairs[:, 0], np.arange(tree.tree.sizes[up] + 1))
        for k in range(tree.tree.sizes[up]):
            if edge[k] < edge[k + 1]:
                terms = tree.terms[up][k]
                bounds[edge[k] : edge[k + 1]] = most[down][np.ix_(pairs[edge[k] : edge[k + 1], 1], terms)].astype(np.float64) @ tree.weight[terms]
        alive = (bounds > 0) & (bounds >= floor[up][pairs[:, 0]])
        pairs, bounds = pairs[alive], bounds[alive]
    scored = 0
    for k in np.unique(pairs[:, 0]).tolist():
        own = np.flatnonzero(pairs[:, 0] == k)
        own = own[np.argsort(-bounds[own], kind="stable")]
        items = tree.order[k * ITEM_LEAF : (k + 1) * ITEM_LEAF]
        terms = tree.terms[-1][k]
        for at in range(0, len(own), FAN):
            some = own[at : at + FAN]
            some = some[bounds[some] >= best.floor[items].min()]
            if not len(some):
                break
            scored += len(some)
            rows = (pairs[some, 1][:, None] * LEAF + np.arange(LEAF)).ravel()
            rows = rows[rows < n]
            score = dense[np.ix_(rows, terms)].astype(np.float64) @ tree.leaves[k]
            for j, item in enumerate(items.tolist()):
                best.add(item, score[:, j], ids[rows])
    return len(docs.sizes) and docs.sizes[-1] * tree.tree.sizes[-1], scored


def searched(found: DataFrame, tree: ItemTree, n_items: int, k: int, n_docs: int, n_terms: int, floor: np.ndarray) -> DataFrame:
    """`item`, `doc_id` and `score` of each task's best documents for each item."""
    none = np.iinfo(np.int64).max  # a null id comes after all others

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = Best(n_items, k, floor)
        for batch in batches:
            for at in range(0, len(batch), SHARD):
                part = batch.slice(at, SHARD)
                lists = part.column("terms").to_pylist()
                ends = np.r_[0, np.cumsum([len(x) // 4 for x in lists])]
                term = np.frombuffer(b"".join(lists), "<i4").astype(np.int64)
                tf = np.frombuffer(b"".join(part.column("tf").to_pylist()), "<i4").astype(np.int64)
                m = 100 - 50 + (50 * np.asarray(part.column("n")) * n_docs) // n_terms
                impact = (1_000_000_000 * tf) // (1000 * tf + 20 * np.repeat(m, np.diff(ends)))
                ids = part.column("doc_id").fill_null(none)
                search_shard(tree, np.asarray(ids), ends, term, impact, best)
        for item in range(n_items):
            if len(best.id[item]):
                ids = pa.array(best.id[item], mask=best.id[item] == none)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(ids), item)), ids, pa.array(best.score[item].astype(np.int64))], ["item", "doc_id", "score"])

    return found.mapInArrow(run, "item long, doc_id long, score long")


def _best(rows: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _block(docs: DataFrame, rows: list, kind: str, k: int) -> DataFrame | None:
    items = Items([r["text"] for r in rows])
    if not len(items.vocabulary):
        return None
    spark = docs.sparkSession
    found = written(matched(docs, items), "matched-terms")
    total = found.agg(F.count("*").alias("docs"), F.sum("n").alias("terms")).first()
    if not total["docs"]:
        return None
    df = document_counts(found, len(items.vocabulary))
    weight = np.array([math.floor(1000 * math.log((2 * total["docs"] + 2) / (2 * x + 1))) for x in df.tolist()], np.float64)
    tree = ItemTree(items, weight)
    floor = np.zeros(len(rows))
    if total["docs"] > 2 * SEED_DOCS:
        part = int(2**63 * 2 * min(1.0, SEED_DOCS / total["docs"])) - 2**63
        sample = found.where(F.xxhash64("doc_id", "terms", "n") < F.lit(part)).limit(2 * SEED_DOCS)
        first = _best(searched(sample, tree, len(rows), k, total["docs"], total["terms"], floor), k)
        for r in first.where(F.col("rank") == k).select("item", "score").collect():
            floor[r["item"]] = r["score"]
    best = _best(searched(found, tree, len(rows), k, total["docs"], total["terms"], floor), k)
    names = spark.createDataFrame([(i, r["item_id"]) for i, r in enumerate(rows)], f"item long, item_id {kind}")
    return best.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score")


def search(docs: DataFrame, items: DataFrame, k: int = 50, block: int = BLOCK) -> DataFrame:
    """The `k` best documents for each item: `item_id`, `rank` (from 1), `doc_id`, `score`.

    Every row of `docs` is a document of its own, also one that repeats another; equal scores go by ascending doc_id, a null
    one last. Null and empty texts have no terms and are in no result; an item without terms has no rows. Each row of `items` is
    an item, repeated ids too. Other columns of the inputs are not looked at.
    """
    kind = items.schema["item_id"].dataType.simpleString()
    thin = items.select("item_id", F.col("text").cast("string").alias("text"))
    blocks = max(1, -(-thin.count() // block))
    out = docs.sparkSession.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long")
    for i in range(blocks):
        own = thin.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == i) if blocks > 1 else thin
        got = _block(docs, own.collect(), kind, k)
        out = out if got is None else got if i == 0 else out.unionByName(got)
    return out


def sql(k: int = 50) -> str:
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    term = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
    return f"""
WITH d AS (
  SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(translate(text, '{upper}', '{lower}'), '{term}') AS w
  FROM documents WHERE text IS NOT NULL
), i AS (
  SELECT row_number() OVER () AS item, item_id, list_distinct(regexp_extract_all(translate(text, '{upper}', '{lower}'), '{term}')) AS w
  FROM benchmark WHERE text IS NOT NULL
), wanted AS (
  SELECT item, item_id, unnest(w) AS term FROM i
), totals AS (
  SELECT count(*) AS n, CAST(sum(len(w)) AS BIGINT) AS l FROM d WHERE len(w) > 0
), tfs AS (
  SELECT row, term, count(*) AS tf FROM (SELECT row, unnest(w) AS term FROM d) WHERE term IN (SELECT term FROM wanted) GROUP BY ALL
), weights AS (
  SELECT term, CAST(floor(1000 * ln((2 * n + 2) / (2 * count(*) + 1))) AS BIGINT) AS weight FROM tfs, totals GROUP BY term, n
), scored AS (
  SELECT item, item_id, doc_id, d.row,
         CAST(sum(weight * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * len(d.w) * n) // l)))) AS BIGINT) AS score
  FROM wanted JOIN tfs USING (term) JOIN weights USING (term) JOIN d ON d.row = tfs.row, totals
  GROUP BY ALL
)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank, doc_id, score
FROM scored WHERE score > 0
QUALIFY row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS LAST) <= {k}
"""
