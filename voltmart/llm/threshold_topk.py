"""Exact top-k inner products by the threshold algorithm over sorted per-dimension lists.

Vectors are quantised to integers. Queries and candidates are dealt by hash into blocks of bounded size; every pair of
a query block and a candidate block is one task's work. There each dimension's list is sorted once, each query walks
its lists from their best end, scores every vector it meets in full, and stops when the bound (the best score an unseen
vector could still have) is below its k-th score. The per-block winners (at most k a block) are merged by a window.

Defined results: vectors that are null, empty or hold a null or non-finite component, and rows with a null vec_id, take
no part; vectors meet only vectors of their own length; equal scores go to the smaller vec_id; a repeated query row
(same vec_id and vector) asks once, a repeated candidate row can fill several ranks, and rows with the query's own id
are no candidates; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common

SCALE = 1024
K = 10
QUERY_BLOCK = 256
CANDIDATE_BLOCK = 8192
STEP = 32  # list entries taken from every dimension in the first step


def quantised(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """vec_id and v (array<long>): floor(scale * x), x as double."""
    x = F.col("embedding")
    sound = F.col("vec_id").isNotNull() & x.isNotNull() & (F.size(x) > 0) & F.forall(
        x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double")) < F.lit(float("inf"))))
    return vectors.where(F.coalesce(sound, F.lit(False))).select(
        F.col("vec_id").cast("long").alias("vec_id"), F.transform(x, lambda c: F.floor(c.cast("double") * scale)).alias("v"))


def threshold_topk(queries: np.ndarray, query_ids: np.ndarray, vectors: np.ndarray, ids: np.ndarray, k: int):
    """(query number, vec_id, score) of each query's k best vectors of one block, ties to the smaller id.

    Steps double in depth: a query that can stop early stops early, one that can't takes few steps.
    """
    n, dims = vectors.shape
    order = np.argsort(vectors.T, axis=1, kind="stable")  # one ascending list per dimension
    lists = np.take_along_axis(np.ascontiguousarray(vectors.T), order, axis=1)
    largest = float(np.abs(vectors).max(initial=0)) * float(np.abs(queries).max(initial=0)) * dims
    exact = vectors.astype(np.float64) if largest < 2 ** 53 else vectors  # sums of such products are whole doubles
    found = []
    for number, (query, own) in enumerate(zip(queries, query_ids, strict=True)):
        weights = query.astype(exact.dtype)
        up, down = np.flatnonzero(query < 0), np.flatnonzero(query > 0)  # read from the smallest, from the largest value
        seen = ids == own  # the own rows are no candidates
        best_ids, best = np.empty(0, np.int64), np.empty(0, exact.dtype)
        depth, step = 0, STEP
        while depth < n:
            end = min(depth + step, n) if len(up) or len(down) else n
            met = np.zeros(n, dtype=bool)
            met[order[up, depth:end]] = True
            met[order[down, n - end:n - depth]] = True
            if end == n:
                met[:] = True
            met &= ~seen
            seen |= met
            rows = np.flatnonzero(met)
            scores = (exact[rows] if len(rows) < n else exact) @ weights
            if len(best) == k:  # only scores that reach the k-th can enter
                strong = scores >= best[-1]
                rows, scores = rows[strong], scores[strong]
            elif len(rows) > k:
                strong = scores >= np.partition(scores, -k)[-k]
                rows, scores = rows[strong], scores[strong]
            best_ids, best = np.concatenate([best_ids, ids[rows]]), np.concatenate([best, scores])
            top = np.lexsort((best_ids, -best))[:k]
            best_ids, best = best_ids[top], best[top]
            depth, step = end, step * 2
            if depth < n and len(best) == k:
                bound = lists[up, depth - 1] @ query[up] + lists[down, n - depth] @ query[down]
                if best[-1] > bound:
                    break
        found.append((np.full(len(best), number), best_ids, best.astype(np.int64)))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True)) if found else (np.empty(0, np.int64),) * 3


def _matrix(column) -> np.ndarray:
    return np.stack([np.asarray(v, dtype=np.int64) for v in column])


RESULT = "query_id long, query_key long, vec_id long, score long"


def _block(left: pd.DataFrame, right: pd.DataFrame, k: int) -> pd.DataFrame:
    if left.empty or right.empty:
        return pd.DataFrame({c: pd.Series(dtype="int64") for c in ("query_id", "query_key", "vec_id", "score")})
    at, ids, scores = threshold_topk(_matrix(left["v"]), left["vec_id"].to_numpy(), _matrix(right["v"]), right["vec_id"].to_numpy(), k)
    return pd.DataFrame({"query_id": left["vec_id"].to_numpy()[at], "query_key": left["query_key"].to_numpy()[at], "vec_id": ids, "score": scores})


def exact_topk(queries: DataFrame, candidates: DataFrame, k: int = K, query_block: int = QUERY_BLOCK,
               candidate_block: int = CANDIDATE_BLOCK) -> DataFrame:
    """query_id, rank, vec_id, score from two frames of vec_id and v (see quantised)."""
    asked = queries.select("vec_id", "v").distinct().withColumn("query_key", F.xxhash64("vec_id", "v"))
    n_query = -(-max(asked.count(), 1) // query_block)
    n_candidate = -(-max(candidates.count(), 1) // candidate_block)
    each = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = (asked.withColumn("d", F.size("v")).withColumn("qb", F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(n_query)).cast("int"))
            .withColumn("cb", each(n_candidate)))
    # dealt by row, so that repeated ids or vectors spread over the blocks too
    right = (candidates.withColumn("d", F.size("v"))
             .withColumn("cb", F.pmod(F.xxhash64("vec_id", F.monotonically_increasing_id()), F.lit(n_candidate)).cast("int"))
             .withColumn("qb", each(n_query)))
    winners = (left.groupBy("qb", "cb", "d").cogroup(right.groupBy("qb", "cb", "d"))
               .applyInPandas(lambda a, b: _block(a, b, k), RESULT))
    first = Window.partitionBy("query_id", "query_key").orderBy(F.desc("score"), F.asc("vec_id"))
    return (winners.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def op5_threshold_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = quantised(common.table(spark, sf_dir, "embeddings"))
    return exact_topk(vectors.where(F.col("vec_id") % 100 == 0), vectors)


ORACLE = """
WITH q AS (
  SELECT vec_id, generate_subscripts(embedding, 1) AS d, CAST(floor(1024 * CAST(unnest(embedding) AS DOUBLE)) AS BIGINT) AS x
  FROM embeddings WHERE vec_id IS NOT NULL
), s AS (
  SELECT a.vec_id AS query_id, b.vec_id AS vec_id, CAST(sum(a.x * b.x) AS BIGINT) AS score
  FROM q a JOIN q b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id AND a.d = b.d
  GROUP BY a.vec_id, b.vec_id
), r AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""
