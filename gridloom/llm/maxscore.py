"""Exact top-k inner products with MaxScore over shards of impact-ordered posting lists with block bounds."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Rows of a shard, about: they bound a task's memory, no result depends on them.
SHARD_ROWS = 16384
#: Postings of a block, terms whose first blocks give the first scores, and terms that are probed at once.
BLOCK, HEADS, PROBED = 64, 8, 16
_NONE = np.empty(0, np.int64)


def _valid(embedding: str):
    bad = F.exists(embedding, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.col(embedding).isNotNull() & ~F.coalesce(bad, F.lit(True))


def _matrix(lists: pa.Array) -> np.ndarray:
    """Integer components, a row for each vector; shorter vectors are padded with zeros."""
    width = np.asarray(pc.list_value_length(lists)).astype(np.int64)
    out = np.zeros((len(lists), int(width.max(initial=0))), np.int64)
    at = np.arange(out.shape[1]) < width[:, None]
    out[at] = np.floor(256.0 * np.asarray(lists.flatten()).astype(np.float64)).astype(np.int64)
    return out


def _fit(parts: np.ndarray, width: int) -> np.ndarray:
    """``parts`` with ``width`` columns: zeros are added; columns beyond meet zeros only and are cut."""
    return np.pad(parts[:, :width], ((0, 0), (0, max(0, width - parts.shape[1]))))


class Shard:
    """The postings of some vectors.

    A term is a component with a sign. Its posting list holds the shard's rows by falling product with the term, in
    blocks of BLOCK; a block's bound is its first value. One order of a component's values serves both signs: a
    positive term reads it from the top, a negative one from the bottom. ``seen`` counts the rows that
    queries met in essential lists, ``products`` the multiplications made for them.
    """

    def __init__(self, ids: np.ndarray, parts: np.ndarray) -> None:
        order = np.argsort(ids, kind="stable")
        self.ids, self.n, self.width = ids[order], len(ids), parts.shape[1]
        self.terms = np.ascontiguousarray(parts[order].T)
        self.exact = self.terms.astype(np.float64)
        self.largest = float(np.abs(self.exact).max(initial=0.0))
        self.norms = np.sqrt((self.exact**2).sum(0))
        self.lists = np.argsort(self.terms, axis=1, kind="stable").astype(np.int32)
        values = np.take_along_axis(self.exact, self.lists.astype(np.int64), 1)
        self.low, self.high = values[:, ::BLOCK], values[:, ::-1][:, ::BLOCK]
        self.seen = self.products = 0

    def postings(self, term: int, positive: bool, depth: int) -> np.ndarray:
        return self.lists[term, self.n - depth :] if positive else self.lists[term, :depth]

    def top(self, query: np.ndarray, own: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        """The k best rows but those of id ``own``, ties to smaller ids.

        The first blocks of the heaviest terms give a floor: the k-th score among them. Terms are taken by rising
        bound as long as all of them together stay below the floor, by the sum of their largest products or by
        Cauchy-Schwarz: these are non-essential. What they leave of the floor is shared by the essential terms, whose
        lists are read down to the first block with a bound below the share: a row in none of the blocks read can't
        reach the floor. Where these blocks have more postings than the shard has rows, all rows are taken. Rows are
        probed for the essential terms and then for the others, the heaviest first, while they can reach the floor.
        """
        if not self.n:
            return _NONE, _NONE
        # doubles hold these sums of integers exactly; longs are used where they might not
        small = self.largest * float(np.abs(query.astype(np.float64)).max(initial=0.0)) * max(self.width, 1) < 2.0**52
        terms, factor = (self.exact, query.astype(np.float64)) if small else (self.terms, query)
        weight = query.astype(np.float64)
        heads = np.where(weight[:, None] > 0, weight[:, None] * self.high, weight[:, None] * self.low)
        bound = np.maximum(heads[:, 0], 0.0)
        order = np.argsort(bound, kind="stable")
        rows = np.arange(self.n)
        floor, margin, essential, rest = -np.inf, 0.0, order, order[:0]
        if len(order):
            first = [self.postings(c, weight[c] > 0, min(BLOCK, self.n)) for c in order[-HEADS:]]
            first = np.unique(np.concatenate(first))
            first = first[self.ids[first] != own]
            if len(first) >= k:
                score = factor @ terms[:, first]
                floor = float(np.partition(score, len(score) - k)[len(score) - k])
        if floor > 0:
            margin = 1e-9 * (bound.sum() + floor)  # of rounding: bounds are doubles, scores may be larger longs
            reach = np.minimum(np.cumsum(bound[order]), np.sqrt(np.cumsum(weight[order] ** 2)) * self.norms.max()) + margin
            cut = int(np.searchsorted(reach, floor - margin, "left"))
            essential, rest = order[cut:], order[:cut][::-1]
            share = (floor - margin - (reach[cut - 1] if cut else 0.0)) / max(1, len(essential))
            depth = np.minimum(self.n, BLOCK * (heads[essential] >= share).sum(1))
            if depth.sum() < self.n:
                read = [self.postings(c, weight[c] > 0, m) for c, m in zip(essential, depth, strict=True)]
                rows = np.unique(np.concatenate(read)) if read else rows[:0]
        self.seen += len(rows)
        score, left = np.zeros(len(rows), terms.dtype), np.concatenate([essential[::-1], rest])
        while len(left):
            some, left = left[:PROBED], left[PROBED:]
            self.products += len(some) * len(rows)
            score = score + factor[some] @ (terms[some] if len(rows) == self.n else terms[np.ix_(some, rows)])
            most = np.minimum(bound[left].sum(), np.sqrt((weight[left] ** 2).sum()) * self.norms[rows])
            keep = np.flatnonzero(score + most + margin >= floor)
            if 2 * len(keep) < len(rows) or not len(left):  # fewer copies
                rows, score = rows[keep], score[keep]
        keep = np.flatnonzero((score >= floor) & (self.ids[rows] != own))
        rows, score = rows[keep], score[keep].astype(np.int64)
        best = np.lexsort((self.ids[rows], -score))[:k]
        return self.ids[rows[best]], score[best]


def _answer(k: int):
    """Rows come by shard, a shard's own vectors before the queries that meet it."""

    def answers(shard: Shard, own: np.ndarray, queries: np.ndarray) -> pa.RecordBatch:
        found = [shard.top(q, int(i), k) for q, i in zip(_fit(queries, shard.width), own, strict=True)]
        asked = np.repeat(own, [len(ids) for ids, _ in found])
        ids, scores = (np.concatenate([f[i] for f in found]) for i in range(2))
        return pa.RecordBatch.from_arrays([pa.array(asked), pa.array(ids), pa.array(scores)], names=["query_id", "vec_id", "score"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, held, shard = -1, [], None
        for batch in batches:
            code = 2 * batch.column(0).to_numpy().astype(np.int64) + batch.column(1).to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(code)) + 1), batch.num_rows] if batch.num_rows else []
            for start, stop in zip(cuts[:-1], cuts[1:], strict=True):
                key, asks = divmod(int(code[start]), 2)
                if key != current:
                    current, held, shard = key, [], None
                part = batch.slice(start, stop - start)
                ids, parts = part.column(2).to_numpy().astype(np.int64), _matrix(part.column(3))
                if not asks:
                    held.append((ids, parts))
                    continue
                if shard is None:
                    width = max((p.shape[1] for _, p in held), default=0)
                    joined = [np.concatenate(x) for x in zip(*((i, _fit(p, width)) for i, p in held), strict=True)]
                    shard, held = Shard(*joined) if joined else Shard(_NONE, _NONE.reshape(0, 0)), []
                yield answers(shard, ids, parts)

    return run


def top_k(vectors: DataFrame, k: int = 5, every: int = 50) -> DataFrame:
    """query_id, rank, vec_id, score: for each row whose vec_id is divisible by ``every`` the k best other rows.

    Components become floor(256 x); the score is the integer inner product, ties go to the smaller vec_id. Vectors that
    are null or hold null or non-finite components, and rows without vec_id, take no part. A shorter vector counts as
    padded with zeros; an empty one scores 0. Of rows with one vec_id each counts, but none is its own query's
    result. Scores must fit a long. Empty table: empty result. Other columns are ignored.

    Rows are dealt to shards of about SHARD_ROWS by a hash of their id; a copy of the queries goes to each shard and is
    answered batch by batch once the shard's postings are built, so a task holds one shard and one batch of queries.
    The shards' k best are merged by query.
    """
    valid = vectors.where(F.col("vec_id").isNotNull() & _valid("embedding"))
    rows = valid.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    parts = max(1, -(-rows.count() // SHARD_ROWS))
    shard = F.pmod(F.xxhash64("vec_id", "embedding"), F.lit(parts)).cast("int")
    own = rows.select(shard.alias("shard"), F.lit(0).alias("asks"), "vec_id", "embedding")
    asked = rows.where(F.col("vec_id") % every == 0).dropDuplicates(["vec_id", "embedding"])
    asked = asked.select(F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("shard"), F.lit(1).alias("asks"), "vec_id", "embedding")
    met = own.unionByName(asked).repartitionById(parts, F.col("shard")).sortWithinPartitions("shard", "asks")
    found = met.mapInArrow(_answer(k), "query_id long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def op5_maxscore(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(range(1, 1 + least(len(q.e), len(c.e))), lambda i: q.e[i] * c.e[i])) AS BIGINT) AS score
      FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s
QUALIFY rank <= 5
"""
