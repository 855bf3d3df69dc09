"""Exact top-k search by pivot-table elimination."""

from __future__ import annotations

import functools
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import arrow_map, staged, table

PIVOTS = 24
#: Rows, spread by a hash of vec_id, from which pivots and first thresholds come.
SAMPLE = 4096
#: Components of the queries broadcast at a time: 26 MB, 50,000 queries of 64.
QUERY_BLOCK = 3_200_000
CANDIDATE_BLOCK = 4096
STEP = 256


def scaled(rows: DataFrame, factor: float = 256.0) -> DataFrame:
    """vec_id and v, the components as floor(factor * x).

    Left out: vectors that are null or empty or hold null or non-finite components, rows without a vec_id, and vectors whose
    length is not the table's most frequent one (of equals, the longest).
    """
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    good = rows.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & (F.size("embedding") > 0)).where(finite)
    v = F.transform("embedding", lambda x: F.floor(x.cast("double") * F.lit(factor)).cast("long"))
    good = good.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v"))
    usual = good.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).limit(1).collect()
    return good.where(F.size("v") == usual[0].n) if usual else good


def _matrix(column: pa.Array, n: int) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(n, -1) if n else np.empty((0, 0), np.int64)


def _pivots(sample: np.ndarray, many: int) -> np.ndarray:
    """Rows of the sample, each the farthest from those chosen before."""
    chosen, near = [int(np.argmax((sample * sample).sum(1)))], None
    for _ in range(min(many, len(sample)) - 1):
        d = ((sample - sample[chosen[-1]]) ** 2).sum(1)
        near = d if near is None else np.minimum(near, d)
        chosen.append(int(near.argmax()))
    return sample[chosen]


def _distances(rows: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    d = (rows * rows).sum(1)[:, None] + (pivots * pivots).sum(1)[None, :] - 2 * rows @ pivots.T
    return np.sqrt(np.maximum(d, 0))


def _better(ids: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((ids, -scores))[:k]
    return ids[order], scores[order]


def top_k(rows: DataFrame, queries: DataFrame, k: int = 5, pivots: int = PIVOTS) -> DataFrame:
    """The k rows of highest inner product for each query, ties to the smaller vec_id: query_id, rank, vec_id, score.

    ``rows`` and ``queries`` are frames of ``scaled``. Distances to pivots are held for queries and rows; the triangle
    inequality makes the largest difference over the pivots a lower bound of the distance, and so an upper bound of the inner
    product, (|q|^2 + |c|^2 - bound^2) / 2. In each block of rows the candidates of a query are evaluated in the order of
    their bounds, until the next bound is below the query's k-th score so far: exact. First thresholds come from the sample.

    The queries are a stated share of the rows and grow with them, so they are taken in blocks of about ``QUERY_BLOCK`` components; each
    block is broadcast, passes once over all rows, writes its k rows per query to the shared folder and is let go before the
    next one, so driver and executors hold one block at a time. A task returns at most k rows per query.

    A row with the query's own vec_id is no candidate; a repeated query counts once, and repeated rows are candidates each.
    Rows that ``scaled`` leaves out take no part. Equal scores: the smaller vec_id is first. No queries or no rows: no result.
    """
    spark = rows.sparkSession
    asked = queries.dropDuplicates(["vec_id", "v"])
    n, width = asked.agg(F.count("*"), F.max(F.size("v"))).first()
    blocks = max(1, -(-n * (width or 1) // QUERY_BLOCK))
    total = rows.count()
    share = 1.0 if total <= SAMPLE else SAMPLE / total
    part = rows.where(F.pmod(F.xxhash64("vec_id"), F.lit(1 << 32)) < int(share * (1 << 32))).limit(2 * SAMPLE).toArrow()
    if not part.num_rows:  # all rows share a few ids, none of them in the sample
        part = rows.limit(2 * SAMPLE).toArrow()
    seen_ids, seen = part.column("vec_id").to_numpy(), _matrix(part.column("v").combine_chunks(), part.num_rows).astype(np.float64)
    schema = "query_id bigint, vec_id bigint, score bigint"
    if not n or not len(seen):
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score bigint")
    pivot = _pivots(seen, pivots)
    place = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    found = []
    for b in range(blocks):
        block = asked.where(F.pmod(F.xxhash64("vec_id"), F.lit(blocks)) == b).toArrow() if blocks > 1 else asked.toArrow()
        ids, q = block.column("vec_id").to_numpy(), _matrix(block.column("v").combine_chunks(), block.num_rows).astype(np.float64)
        if len(ids):
            sent = spark.sparkContext.broadcast((ids, q, pivot, _distances(q, pivot), _thresholds(ids, q, seen_ids, seen, k)))
            best = arrow_map(rows, functools.partial(_search, sent, k), schema).withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= k)
            found.append(staged(best.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"), "nearest"))
            sent.destroy()
    return functools.reduce(DataFrame.unionAll, found)


def _thresholds(ids: np.ndarray, q: np.ndarray, seen_ids: np.ndarray, seen: np.ndarray, k: int) -> np.ndarray:
    """A score that k rows reach, for each query."""
    out = np.full(len(ids), -np.inf)
    if len(seen) > k:
        for a in range(0, len(ids), 1024):
            s = q[a : a + 1024] @ seen.T
            s[ids[a : a + 1024, None] == seen_ids[None, :]] = -np.inf
            out[a : a + 1024] = np.partition(s, len(seen) - k, axis=1)[:, len(seen) - k]
    return out


def _search(sent, k: int, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    ids, q, pivot, q_far, least = sent.value
    norm = (q * q).sum(1)
    best: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    least = least.copy()
    for whole in batches:
        for at in range(0, whole.num_rows, CANDIDATE_BLOCK):
            batch = whole.slice(at, CANDIDATE_BLOCK)
            own = batch.column(0).to_numpy(zero_copy_only=False)
            ints = _matrix(batch.column(1), batch.num_rows)
            c = ints.astype(np.float64)
            # products of whole numbers are exact in doubles as long as they stay below 2 ** 53
            exact = np.abs(c).max(initial=0) * np.abs(q).max(initial=0) * c.shape[1] < 2**53
            c_norm, c_far = (c * c).sum(1), _distances(c, pivot)
            for a in range(0, len(ids), 128):
                bound = np.zeros((len(ids[a : a + 128]), len(own)))
                for p in range(len(pivot)):
                    np.maximum(bound, np.abs(q_far[a : a + 128, p, None] - c_far[None, :, p]), out=bound)
                top = norm[a : a + 128, None] + c_norm[None, :]
                upper = (top - bound * bound) / 2 + 1e-9 * top + 1  # room for rounding
                for j, row in enumerate(upper, a):
                    alive = np.flatnonzero(row >= least[j])
                    alive = alive[own[alive] != ids[j]]
                    if not len(alive):
                        continue
                    alive = alive[np.argsort(-row[alive])]
                    have_ids, have = best.get(j, (np.empty(0, np.int64), np.empty(0, np.int64)))
                    for s in range(0, len(alive), STEP):
                        if row[alive[s]] < least[j]:
                            break  # no later candidate can reach the k-th score
                        now = alive[s : s + STEP]
                        score = (c[now] @ q[j]).astype(np.int64) if exact else ints[now] @ q[j].astype(np.int64)
                        have_ids, have = _better(np.concatenate([have_ids, own[now]]), np.concatenate([have, score]), k)
                        if len(have) == k:
                            least[j] = max(least[j], have[-1])
                    best[j] = (have_ids, have)
    for j, (have_ids, have) in best.items():
        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(have), ids[j])), pa.array(have_ids), pa.array(have)], ["query_id", "vec_id", "score"])


def op1_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``top_k`` of all embeddings for the rows whose vec_id is divisible by 50; ``scaled`` and ``top_k`` tell what odd rows give."""
    rows = scaled(table(spark, sf_dir, "embeddings"))
    return top_k(rows, rows.where("vec_id % 50 = 0"))


OP1_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.v, c.v)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0
), r AS (
  SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank, vec_id, score FROM s
)
SELECT * FROM r WHERE rank <= 5
"""
