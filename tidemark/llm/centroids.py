"""Centroid clustering by weighted deduplication: Lloyd's rounds over distinct quantised vectors with multiplicities."""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import arrow_map, drop_staged, staged, table

CENTROIDS, ROUNDS, COMPONENTS, SCALE = 16, 3, 64, 64
#: Components below this keep squared distances of up to 256 components within 64 bits.
FARTHEST = 1 << 26
_CHUNK = 4096


def quantised(vectors: DataFrame, components: int = COMPONENTS, scale: int = SCALE) -> DataFrame:
    """vec_id and v, the components as floor(scale * x), of vectors with exactly ``components`` of them, none null or non-finite.

    A vector with a component of ``FARTHEST`` or more after scaling is left out: its squared distances need not fit 64 bits.
    """
    within = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double") * scale) < FARTHEST))
    good = vectors.where(F.col("embedding").isNotNull() & (F.size("embedding") == components)).where(within)
    return good.select(F.col("vec_id").cast("long").alias("vec_id"), F.transform("embedding", lambda x: F.floor(x.cast("double") * scale).cast("int")).alias("v"))


def clusters(vectors: DataFrame, many: int = CENTROIDS, rounds: int = ROUNDS, components: int = COMPONENTS, scale: int = SCALE) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia and centroid_sha256 of the quantised vectors of ``vectors``.

    Equal quantised vectors are grouped once, with their number (partial sums before the shuffle, so copies cost nothing). Each round
    assigns every distinct vector to the nearest centroid, squared Euclidean distance, ties to the smaller number, and sums
    components and numbers per cluster, in tasks first, in whole numbers; centroids become the floor of the means, empty ones stay.
    After the last round the distinct vectors are assigned again and joined back to the vec_ids by the vector. The first
    centroids are the ``many`` vectors with the smallest sha256 of ``1:<vec_id>``; fewer vectors give fewer centroids.

    The driver holds the centroids and a row of sums of each. A vector that a third of the rows share is one row in the rounds; in
    the join its rows are split by Spark's skew handling, since the other side holds it once.

    Vectors of another length, null or with null or non-finite components take no part and have no row. Rows without a vec_id are
    clustered and counted but come last as first centroids. Repeated rows and ids count each. Other columns are not read. No vector: no rows.
    """
    if components > 256:
        raise ValueError("distances of more than 256 components may pass 64 bits")
    spark = vectors.sparkSession
    kept = quantised(vectors, components, scale)
    seeds = kept.orderBy(F.sha2(F.concat(F.lit("1:"), F.col("vec_id").cast("string")), 256).asc_nulls_last(), "v").limit(many).toArrow()
    schema = "vec_id bigint, cluster int, distance bigint, cluster_inertia bigint, inertia bigint, centroid_sha256 string"
    if not seeds.num_rows:
        return spark.createDataFrame([], schema)
    centres = np.array(seeds.column("v").to_pylist(), np.int64)
    distinct = staged(kept.groupBy("v").agg(F.count("*").alias("n")), "distinct")
    names = [f"s{k}" for k in range(components)]
    sums = "cluster int, n bigint, " + ", ".join(f"{c} bigint" for c in names)
    for _ in range(rounds):
        parts = arrow_map(distinct, functools.partial(_sums, centres), sums)
        centres = centres.copy()
        for row in parts.groupBy("cluster").agg(F.sum("n").alias("n"), *[F.sum(c).alias(c) for c in names]).collect():
            centres[row.cluster] = [row[c] // row.n for c in names]
    assigned = staged(arrow_map(distinct, functools.partial(_assigned, centres), "v array<int>, n bigint, cluster int, distance bigint"), "assigned")
    of_cluster = assigned.groupBy("cluster").agg(F.sum(F.col("distance") * F.col("n")).alias("cluster_inertia"))
    told = spark.createDataFrame([(k, hashlib.sha256(",".join(map(str, c)).encode()).hexdigest()) for k, c in enumerate(centres.tolist())], "cluster int, centroid_sha256 string")
    whole = of_cluster.agg(F.sum("cluster_inertia").alias("inertia"))
    card = of_cluster.join(F.broadcast(told), "cluster").crossJoin(F.broadcast(whole))  # a row for each centroid; one row
    out = kept.join(assigned.drop("n"), "v").join(F.broadcast(card), "cluster")
    out = staged(out.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"), "clusters")
    for done in (distinct, assigned):
        drop_staged(done)
    return out


def _rows(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, width)


def _nearest(rows: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest centroid of each row, the first of equals, and the squared distance, in whole numbers."""
    far = np.stack([((rows - c) ** 2).sum(1) for c in centres], axis=1)
    best = far.argmin(1)
    return best, far[np.arange(len(rows)), best]


def _sums(centres: np.ndarray, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The number and the summed components of each cluster in this task."""
    many, total = np.zeros(len(centres), np.int64), np.zeros_like(centres)
    for whole in batches:
        for at in range(0, whole.num_rows, _CHUNK):
            batch = whole.slice(at, _CHUNK)
            rows, n = _rows(batch.column(0), centres.shape[1]), batch.column(1).to_numpy()
            best, _ = _nearest(rows, centres)
            np.add.at(many, best, n)
            np.add.at(total, best, rows * n[:, None])
    some = np.flatnonzero(many)
    columns = [pa.array(some.astype(np.int32)), pa.array(many[some]), *(pa.array(total[some, k]) for k in range(centres.shape[1]))]
    yield pa.RecordBatch.from_arrays(columns, ["cluster", "n", *(f"s{k}" for k in range(centres.shape[1]))])


def _assigned(centres: np.ndarray, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for at in range(0, whole.num_rows, _CHUNK):
            batch = whole.slice(at, _CHUNK)
            best, far = _nearest(_rows(batch.column(0), centres.shape[1]), centres)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(best.astype(np.int32)), pa.array(far)], ["v", "n", "cluster", "distance"])


def op12_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``clusters`` of all embeddings, which tells what odd rows give."""
    return clusters(table(spark, sf_dir, "embeddings"))


def _sql() -> str:
    parts = [
        """WITH kept AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), c0 AS (
  SELECT row_number() OVER (ORDER BY h NULLS LAST, v) - 1 AS cluster, v AS c
  FROM (SELECT v, sha256('1:' || vec_id) AS h FROM kept ORDER BY h NULLS LAST, v LIMIT 16)
)"""
    ]
    near = """SELECT vec_id, v, d AS distance, cluster FROM (
    SELECT *, row_number() OVER (PARTITION BY place ORDER BY d, cluster) AS nth FROM (
      SELECT vec_id, v, place, cluster, list_sum(list_transform(list_zip(v, c), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::BIGINT AS d
      FROM (SELECT *, row_number() OVER () AS place FROM kept), c%d)) WHERE nth = 1"""
    for k in range(ROUNDS):
        parts.append(f"a{k} AS ({near % k})")
        parts.append(
            f"""m{k} AS (
  SELECT cluster, list(m ORDER BY i) AS c FROM (
    SELECT cluster, i, (s - ((s % n) + n) % n) // n AS m
    FROM (SELECT cluster, i, sum(x) AS s, count(*)::HUGEINT AS n FROM (SELECT cluster, unnest(v) AS x, unnest(range(1, 65)) AS i FROM a{k}) GROUP BY cluster, i)
  ) GROUP BY cluster
), c{k + 1} AS (SELECT cluster, coalesce(m.c, o.c)::BIGINT[] AS c FROM c{k} o LEFT JOIN m{k} m USING (cluster))"""
        )
    parts.append(f"last AS ({near % ROUNDS})")
    return (
        ",\n".join(parts)
        + f"""
SELECT vec_id, cluster::INT AS cluster, distance, sum(distance) OVER (PARTITION BY cluster)::BIGINT AS cluster_inertia, sum(distance) OVER ()::BIGINT AS inertia,
       sha256(array_to_string(c, ',')) AS centroid_sha256
FROM last JOIN c{ROUNDS} USING (cluster)
"""
    )


OP12_SQL = _sql()
