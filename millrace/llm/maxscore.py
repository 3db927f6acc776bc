"""Exact top-k search by inner product over integer vectors, by MaxScore.

A query's terms are its components; a term's postings in a shard are the rows whose component has the query's sign there, so
that it adds to the score. Its bound is the most it adds to any row of the shard. With a threshold, the k-th best
score so far, the terms fall in two: the non-essential ones, whose bounds together stay below the threshold, and the
essential rest. A row in no essential posting cannot reach the threshold. Rows of the essential
postings are scored on those terms, then on the others in order of their bounds, and dropped as soon as
the score and the bounds still open fall below the threshold.

Rows are dealt in shards and queries in blocks of bounded size; each pair of them is a task's work and gives k rows
per query, which are merged at the end.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import written

SHARD, BLOCK = 8192, 1024
FIRST = 256  # rows that are scored in full for a first threshold
GROUP = 8  # non-essential terms probed between two prunings


def integer_vectors(rows: DataFrame) -> DataFrame:
    """`vec_id` and `v`, floor(256 * x) of each component; vectors null or with null or non-finite parts are left out."""
    x = F.col("embedding").cast("array<double>")
    bad = F.exists(x, lambda e: e.isNull() | F.isnan(e) | (F.abs(e) == float("inf")))
    return rows.where(F.col("vec_id").isNotNull() & x.isNotNull() & ~bad).select(
        F.col("vec_id").cast("long").alias("vec_id"), F.transform(x, lambda e: F.floor(e * 256)).alias("v")
    )


def _matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    """Vectors as rows; shorter ones have no terms at the end."""
    lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    sizes = np.diff(np.asarray(lists.offsets)).astype(np.int64)
    out = np.zeros((len(sizes), width), np.int64)
    at = np.repeat(np.arange(len(sizes)), sizes)
    place = np.arange(len(at)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    out[at, place] = np.asarray(lists.flatten())
    return out


class Shard:
    """Rows with their postings: for each term the rows with a positive and with a negative component."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, exact = ids[order], vectors[order]
        self.top, self.low = exact.max(axis=0, initial=0), exact.min(axis=0, initial=0)
        self.postings = {1: (exact > 0).T.copy(), -1: (exact < 0).T.copy()}
        self.exact = exact

    def search(self, own: int, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the k best rows but those of the id `own`; more where the last ones tie."""
        largest = int(np.abs(query).max(initial=0)) * int(max(self.top.max(initial=0), -self.low.min(initial=0)))
        # Sums of whole numbers below 2 ** 53 are exact as floats, which multiply faster.
        kind = np.float64 if largest * max(1, len(query)) < 1 << 53 else np.int64
        rows, q = (self.floats if kind is np.float64 else self.exact), query.astype(kind)
        bound = np.maximum(np.maximum(q * self.top, q * self.low), 0)
        other = self.ids != own
        seeds = np.flatnonzero(other[:FIRST])
        first = rows[seeds] @ q
        threshold = np.partition(first, len(first) - k)[len(first) - k] if len(first) >= k else None
        terms = np.argsort(-bound, kind="stable")
        open_ = np.cumsum(bound[terms][::-1])[::-1]  # what the terms from here on may add
        if threshold is None or threshold <= 0:
            essential = len(terms)
            at = np.flatnonzero(other)
        else:
            essential = int((open_ >= threshold).sum())
            hit = np.zeros(len(self.ids), bool)
            for t in terms[:essential]:
                if query[t]:
                    hit |= self.postings[1 if query[t] > 0 else -1][t]
            at = np.flatnonzero(hit & other)
        score = rows[np.ix_(at, terms[:essential])] @ q[terms[:essential]]
        for n in range(essential, len(terms), GROUP):
            best = max(threshold, np.partition(score, len(score) - k)[len(score) - k] + self._least(q, terms[n:])) if len(score) >= k else threshold
            keep = score + open_[n] >= best
            at, score = at[keep], score[keep]
            group = terms[n : n + GROUP]
            score = score + rows[np.ix_(at, group)] @ q[group]
        if len(at) > k:
            keep = score >= np.partition(score, len(score) - k)[len(score) - k]
            at, score = at[keep], score[keep]
        best = np.lexsort((self.ids[at], -score))[:k]
        return self.ids[at[best]], score[best].astype(np.int64)

    @property
    def floats(self) -> np.ndarray:
        if not hasattr(self, "_floats"):
            self._floats = self.exact.astype(np.float64)
        return self._floats

    def _least(self, q: np.ndarray, terms: np.ndarray) -> float:
        """The least that terms may add to a row."""
        return np.minimum(np.minimum(q[terms] * self.top[terms], q[terms] * self.low[terms]), 0).sum()


def top_k(rows: DataFrame, every: int = 50, k: int = 5) -> DataFrame:
    """`query_id`, `rank`, `vec_id`, `score`: the k best rows for each row whose id is divisible by `every`.

    Scores that tie go to the smaller vec_id. Rows of the query's own id are no candidates. An id has k
    rows, however often it is repeated: of several vectors of one id, the k best pairs of one of them and a row count, equal ones once.
    """
    vectors = written(integer_vectors(rows), "vectors")
    asked = written(vectors.where(F.pmod("vec_id", F.lit(every)) == 0).distinct(), "queries")
    # Rows are numbered, not hashed by id, so that no id can fill a shard.
    shards, blocks = (max(1, -(-d.count() // n)) for d, n in ((vectors, SHARD), (asked, BLOCK)))
    width = vectors.agg(F.coalesce(F.max(F.size("v")), F.lit(0))).first()[0]
    number = F.monotonically_increasing_id()
    spread = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = vectors.withColumn("shard", F.pmod(number, F.lit(shards)).cast("int")).withColumn("block", spread(blocks))
    right = asked.withColumn("block", F.pmod(number, F.lit(blocks)).cast("int")).withColumn("shard", spread(shards))
    cells = ["shard", "block"]
    schema = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])

    def work(held: pa.Table, wanted: pa.Table) -> pa.Table:
        out: list[list[np.ndarray]] = [[], [], []]
        if len(held) and len(wanted):
            shard = Shard(np.asarray(held.column("vec_id")), _matrix(held.column("v"), width))
            queries = _matrix(wanted.column("v"), width)
            for own, query in zip(np.asarray(wanted.column("vec_id")).tolist(), queries, strict=True):
                ids, scores = shard.search(own, query, k)
                for cell, part in zip(out, (np.full(len(ids), own), ids, scores), strict=True):
                    cell.append(part)
        none = np.zeros(0, np.int64)
        return pa.table([np.concatenate([none, *c]) for c in out], schema=schema)

    found = left.groupBy(*cells).cogroup(right.groupBy(*cells)).applyInArrow(work, "query_id long, vec_id long, score long")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def sql(every: int = 50, k: int = 5) -> str:
    return f"""
    WITH v AS (
        SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
        WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
          AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    ), s AS (
        SELECT q.vec_id AS query_id, d.vec_id, list_inner_product(q.v, d.v)::BIGINT AS score
        FROM (SELECT DISTINCT * FROM v) q JOIN v d ON q.vec_id <> d.vec_id WHERE q.vec_id % {every} = 0
    )
    SELECT query_id, rank::INT AS rank, vec_id, score
    FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= {k}
    """
