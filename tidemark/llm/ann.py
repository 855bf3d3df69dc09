"""Approximate nearest neighbours: a hierarchical k-means tree, searched best bin first as widely as calibrated recall needs."""

from __future__ import annotations

import functools
import heapq
import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import arrow_map, drop_staged, staged, table
from tidemark.llm.neardup_pq import _column, _kmeans, _nearest, _stream

NEAREST = 20
#: Children of a node; rows and components of a sample, spread by a hash of vec_id, on which trees are fitted: every row is indexed.
BRANCHES, SAMPLE, SAMPLE_VALUES = 12, 65_536, 1 << 23
#: Rows that a leaf should hold; fewest and most leaves, since the tree is broadcast.
LEAF_ROWS, LEAST_LEAVES, MOST_LEAVES = 64, 8, 16_384
#: Queries by which the number of visited leaves is calibrated, and the recall that they must reach.
TRIALS, RECALL = 256, 0.96
#: Rows of leaves that are searched in one task, and queries put to them in one task.
BLOCK_ROWS, BLOCK_QUERIES = 8192, 1024


class Tree:
    """Nodes in depth-first order: children of each, centroids, and the number of the leaf that a node is, else -1."""

    def __init__(self, sample: np.ndarray, leaves: int):
        self.children: list[list[int]] = []
        self.leaf: list[int] = []
        self.leaves = 0
        centres: list[np.ndarray] = []
        rng = np.random.default_rng(11)

        def grow(rows: np.ndarray, wanted: int) -> int:
            node = len(self.children)
            self.children.append([])
            centres.append(rows.mean(0))
            near = None
            if wanted > 1 and len(rows) > 1:
                means = _kmeans(rows, min(BRANCHES, wanted, len(rows)), rng)
                near = _nearest(rows, means, 1)[:, 0]
            if near is None or (near == near[0]).all():  # one leaf, or rows that can't be told apart
                self.leaf.append(self.leaves)
                self.leaves += 1
            else:
                self.leaf.append(-1)
                for k in np.unique(near).tolist():
                    own = rows[near == k]
                    self.children[node].append(grow(own, round(wanted * len(own) / len(rows))))
            return node

        grow(sample, leaves)
        self.centres = np.array(centres)
        self.norms = (self.centres**2).sum(1)
        self.node_of_leaf = np.flatnonzero(np.array(self.leaf) >= 0)

    def place(self, rows: np.ndarray) -> np.ndarray:
        """The leaf of each row, by the nearest child at each node."""
        out = np.empty(len(rows), np.int64)
        todo = [(0, np.arange(len(rows)))]
        while todo:
            node, at = todo.pop()
            if self.leaf[node] >= 0:
                out[at] = self.leaf[node]
            elif len(at):
                kids = self.children[node]
                near = _nearest(rows[at], self.centres[kids], 1)[:, 0]
                todo.extend((kid, at[near == k]) for k, kid in enumerate(kids))
        return out

    def far(self, queries: np.ndarray) -> np.ndarray:
        """Squared distances, less the query's own square, of queries to all nodes."""
        return self.norms[None, :] - 2 * queries @ self.centres.T

    def visit(self, far: np.ndarray, most: int) -> list[int]:
        """The first ``most`` leaves of a query in best-bin-first order: always the nearest node seen so far is opened."""
        queue, out = [(0.0, 0)], []
        while queue and len(out) < most:
            _, node = heapq.heappop(queue)
            if self.leaf[node] >= 0:
                out.append(self.leaf[node])
            for kid in self.children[node]:
                heapq.heappush(queue, (far[kid], kid))
        return out


class Forest:
    """A tree for each vector length in the sample. Rows of other lengths lie in one leaf of their length.

    Inner products are turned into distances by one more component, sqrt(most**2 - |x|**2), 0 for queries.
    """

    def __init__(self, samples: dict[int, np.ndarray], counts: dict[int, int], most: float):
        self.most = most if most < 1e150 else 0.0  # beyond, squares are no numbers
        self.trees = {n: Tree(self.lifted(rows), max(1, min(MOST_LEAVES, max(LEAST_LEAVES, counts[n] // LEAF_ROWS), len(rows)))) for n, rows in samples.items()}
        self.visits: dict[int, int] = {}
        self.blocks: dict[tuple[int, int], tuple[int, int]] = {}

    def lifted(self, rows: np.ndarray) -> np.ndarray:
        return np.concatenate([rows, np.sqrt(np.maximum(self.most**2 - (rows * rows).sum(1), 0))[:, None]], axis=1)

    def place(self, rows: np.ndarray) -> np.ndarray:
        tree = self.trees.get(rows.shape[1])
        return np.zeros(len(rows), np.int64) if tree is None else tree.place(self.lifted(rows))

    def visit(self, queries: np.ndarray, most: int | None = None) -> list[list[int]]:
        tree = self.trees.get(queries.shape[1])
        if tree is None:
            return [[0]] * len(queries)
        far = tree.far(np.concatenate([queries, np.zeros((len(queries), 1))], axis=1))
        return [tree.visit(row.tolist(), most or self.visits[queries.shape[1]]) for row in far]


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id, size and v (doubles) of vectors that are not null, empty or zero and hold no null or non-finite component."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    good = vectors.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull()).where(finite & F.exists("embedding", lambda x: x != 0))
    return good.select(F.col("vec_id").cast("long").alias("vec_id"), F.size("embedding").alias("size"), F.transform("embedding", lambda x: x.cast("double")).alias("v"))


def _by_size(batch: pa.RecordBatch, size: str, v: str) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows of equal length: their places in the batch and their vectors."""
    sizes = batch.column(size).to_numpy()
    for n in np.unique(sizes).tolist():
        at = np.flatnonzero(sizes == n)
        rows = batch.column(v) if len(at) == len(sizes) else batch.column(v).take(pa.array(at))
        yield at, rows.flatten().to_numpy(zero_copy_only=False).reshape(-1, n)


def nearest(rows: DataFrame, queries: DataFrame, k: int = NEAREST, recall: float = RECALL) -> DataFrame:
    """query_id, rank, vec_id and score: of each query the ``k`` rows found with the largest inner products, ties to the smaller vec_id.

    ``rows`` and ``queries`` are frames of ``usable``.

    1. A hierarchical k-means tree is fitted on about ``SAMPLE`` rows of each length; all rows go down to their leaf.
    2. ``TRIALS`` queries are answered from all rows. Their trees are walked best bin first, and the number of visited leaves is
       widened until the leaves hold ``recall`` of all those answers.
    3. Leaves are packed into blocks of about ``BLOCK_ROWS`` rows, larger leaves are cut by a hash of vec_id, and every query goes
       to the blocks of the leaves that it visits, with the numbers of these leaves. A block with more than ``BLOCK_QUERIES``
       queries is searched by several tasks. Each keeps ``k`` rows of a query; the best of all are taken at the end.

    The tree is bounded (``MOST_LEAVES``) and broadcast. Scores are sums of products in the order of the components, so equal vectors
    have equal scores wherever they lie. A query whose leaves hold fewer than ``k`` rows while there are more is answered from all leaves.

    A row with the query's own vec_id is no candidate; candidates have the query's length. A repeated query counts once, repeated
    rows are candidates each. Vectors that ``usable`` leaves out take no part. No queries or no rows: no result.
    """
    spark = rows.sparkSession
    schema = "query_id bigint, rank int, vec_id bigint, score double"
    square = F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x)
    known = rows.groupBy("size").agg(F.count("*").alias("n"), F.max(square).alias("square")).orderBy(F.desc("n"), "size").limit(64).collect()
    if not known:
        return spark.createDataFrame([], schema)
    share = min(1.0, SAMPLE / sum(r.n for r in known), SAMPLE_VALUES / sum(r.n * r["size"] for r in known))
    part = rows.where(F.pmod(F.xxhash64("vec_id"), F.lit(1 << 32)) < int(share * (1 << 32))).limit(2 * SAMPLE).toArrow().combine_chunks()
    sample = {v.shape[1]: v for batch in part.to_batches() for _, v in _by_size(batch, "size", "v")}
    forest = Forest(sample, {n: len(v) for n, v in sample.items()} | {r["size"]: r.n for r in known}, math.sqrt(max(r.square for r in known)))

    sent = spark.sparkContext.broadcast(forest)
    placed = staged(arrow_map(rows, functools.partial(_place, sent), "size int, leaf int, vec_id bigint, v array<double>"), "placed")
    asked = queries.groupBy("vec_id").agg(F.min(F.struct("size", "v")).alias("q")).select("vec_id", "q.size", "q.v")
    forest.visits = _calibrated(forest, placed, asked, k, recall)
    forest.blocks = _blocks(placed)
    sent = spark.sparkContext.broadcast(forest)
    held = staged(arrow_map(placed, functools.partial(_held, sent), "block bigint, leaf int, vec_id bigint, v array<double>"), "held")
    found = _searched(held, arrow_map(asked, functools.partial(_visits, sent, False), _VISITS), k)
    enough = found.groupBy("query_id").count().where(F.col("count") >= k)
    few = staged(asked.join(enough.select(F.col("query_id").alias("vec_id")), "vec_id", "left_anti"), "few")
    if few.limit(1).count():
        again = _searched(held, arrow_map(few, functools.partial(_visits, sent, True), _VISITS), k)
        found = found.join(few.select(F.col("vec_id").alias("query_id")), "query_id", "left_anti").unionByName(again)
    place = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    best = found.withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= k)
    out = staged(best.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"), "nearest")
    for done in (placed, held, found, few):
        drop_staged(done)
    return out


def _place(sent, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        leaf = np.zeros(batch.num_rows, np.int32)
        for at, v in _by_size(batch, "size", "v"):
            leaf[at] = sent.value.place(v)
        yield pa.RecordBatch.from_arrays([batch.column("size"), pa.array(leaf), batch.column("vec_id"), batch.column("v")], ["size", "leaf", "vec_id", "v"])


def _products(v: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Inner products, summed in the order of the components."""
    out = np.zeros(len(v))
    for j in range(v.shape[1]):
        out += v[:, j] * query[j]
    return out


def _best(v: np.ndarray, ids: np.ndarray, at: np.ndarray, query: np.ndarray, own: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Of the rows ``at``, the places of the ``k`` nearest, ties to the smaller id, and their scores."""
    at = at[ids[at] != own]
    if len(at) > 2 * k:
        rough = v[at] @ query
        least = np.partition(rough, len(at) - k)[len(at) - k]
        at = at[rough >= least - 1e-9 * (1 + abs(least)) - 1e-12 * np.abs(rough).max()]
    score = _products(v[at], query)
    order = np.lexsort((ids[at], -score))[:k]
    return at[order], score[order]


def _calibrated(forest: Forest, placed: DataFrame, asked: DataFrame, k: int, recall: float) -> dict[int, int]:
    """For each length with a tree, how many leaves hold ``recall`` of the ``k`` nearest of some queries."""
    spark = placed.sparkSession
    trials = asked.where(F.col("size").isin(list(forest.trees))).orderBy(F.xxhash64("vec_id"), "vec_id").limit(TRIALS).toArrow().combine_chunks()
    if not trials.num_rows:
        return dict.fromkeys(forest.trees, 1)
    own = trials.to_batches()[0]
    sent = spark.sparkContext.broadcast([(at, own.column("vec_id").to_numpy()[at], v) for at, v in _by_size(own, "size", "v")])
    near = arrow_map(placed, functools.partial(_truths, sent, k), "trial int, size int, leaf int, vec_id bigint, score double")
    place = Window.partitionBy("trial").orderBy(F.desc("score"), "vec_id")
    truths = near.withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= k).select("trial", "size", "leaf").collect()
    out = dict.fromkeys(forest.trees, 1)
    for at, v in _by_size(own, "size", "v"):
        n = v.shape[1]
        order = {int(a): {leaf: rank for rank, leaf in enumerate(visited, 1)} for a, visited in zip(at, forest.visit(v, forest.trees[n].leaves))}
        ranks = sorted(order[r.trial][r.leaf] for r in truths if r.trial in order)
        if ranks:
            out[n] = ranks[min(len(ranks) - 1, math.ceil(recall * len(ranks)) - 1)]
    return out


def _truths(sent, k: int, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The ``k`` nearest rows of each trial among those of this task (size, leaf, vec_id, v)."""
    kept: dict[int, tuple[int, np.ndarray, np.ndarray, np.ndarray]] = {}
    for batch in batches:
        ids, leaf = batch.column("vec_id").to_numpy(), batch.column("leaf").to_numpy()
        for at, v in _by_size(batch, "size", "v"):
            for trial, own, queries in sent.value:
                if queries.shape[1] == v.shape[1]:
                    for t, q, query in zip(trial.tolist(), own.tolist(), queries):
                        best, score = _best(v, ids[at], np.arange(len(at)), query, q, k)
                        now = ids[at[best]], leaf[at[best]], score
                        if t in kept:
                            now = tuple(np.concatenate(x) for x in zip(kept[t][1:], now))
                            first = np.lexsort((now[0], -now[2]))[:k]
                            now = tuple(x[first] for x in now)
                        kept[t] = v.shape[1], *now
    for t, (size, ids, leaf, score) in kept.items():
        n = len(ids)
        yield pa.RecordBatch.from_arrays([pa.array(np.full(n, t, np.int32)), pa.array(np.full(n, size, np.int32)), pa.array(leaf), pa.array(ids), pa.array(score)], ["trial", "size", "leaf", "vec_id", "score"])


def _blocks(placed: DataFrame) -> dict[tuple[int, int], tuple[int, int]]:
    """First block of each leaf (size, leaf) and in how many its rows lie. One entry for each leaf; their number is bounded."""
    out, block, room = {}, 0, 0
    for r in placed.groupBy("size", "leaf").count().orderBy("size", "leaf").collect():
        cut = -(-r["count"] // BLOCK_ROWS)
        if cut > 1 or r["count"] > room:
            block, room = block + 1, BLOCK_ROWS
        out[r["size"], r["leaf"]] = block, cut
        room -= r["count"]
        if cut > 1:
            block, room = block + cut - 1, 0
    return out


def _held(sent, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The block of each row; rows of a leaf that lies in several are dealt by vec_id."""
    for batch in batches:
        keys = zip(batch.column("size").to_pylist(), batch.column("leaf").to_pylist())
        first, cut = np.array([sent.value.blocks[key] for key in keys], np.int64).reshape(-1, 2).T
        mixed = (batch.column("vec_id").to_numpy().view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)
        block = first + mixed.astype(np.int64) % np.maximum(cut, 1)
        yield pa.RecordBatch.from_arrays([pa.array(block), batch.column("leaf"), batch.column("vec_id"), batch.column("v")], ["block", "leaf", "vec_id", "v"])


_VISITS = "block bigint, query_id bigint, v array<double>, leaves array<int>"


def _visits(sent, whole: bool, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each block that a query visits, with the leaves that it visits there; ``whole``: all leaves of its length."""
    forest = sent.value
    for much in batches:
        for start in range(0, much.num_rows, 256):
            batch = much.slice(start, 256)
            row, block, leaves = [], [], []
            for at, v in _by_size(batch, "size", "v"):
                size = v.shape[1]
                most = forest.trees[size].leaves if whole and size in forest.trees else None
                for q, visited in zip(at.tolist(), forest.visit(v, most)):
                    meets: dict[int, list[int]] = {}
                    for leaf in sorted(visited):
                        first, cut = forest.blocks.get((size, leaf), (0, 0))  # a leaf may hold no row
                        for b in range(first, first + cut):
                            meets.setdefault(b, []).append(leaf)
                    row.extend([q] * len(meets))
                    block.extend(meets)
                    leaves.extend(meets.values())
            take = batch.take(pa.array(row, pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(block, pa.int64()), take.column("vec_id"), take.column("v"), pa.array(leaves, pa.list_(pa.int32()))], ["block", "query_id", "v", "leaves"])


def _searched(held: DataFrame, visits: DataFrame, k: int) -> DataFrame:
    """query_id, vec_id and score of the ``k`` best rows of each query in each block that it visits."""
    asks = staged(visits, "asks")
    tasks = asks.groupBy("block").agg(F.ceil(F.count("*") / BLOCK_QUERIES).alias("tasks"))
    mine = asks.join(tasks, "block").select("block", F.pmod(F.xxhash64("query_id"), F.col("tasks")).alias("task"), F.lit(1).alias("role"), F.col("query_id").alias("vec_id"), "v", F.lit(-1).alias("leaf"), "leaves")
    theirs = held.join(tasks, "block").select("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("tasks") - 1)).alias("task"), F.lit(0).alias("role"), "vec_id", "v", "leaf", F.lit(None).cast("array<int>").alias("leaves"))
    both = theirs.unionAll(mine).repartition("block", "task").sortWithinPartitions("block", "task", "role", "leaf", "vec_id")
    found = staged(arrow_map(both, functools.partial(_search, k), "query_id bigint, vec_id bigint, score double"), "found")
    drop_staged(asks)
    return found


def _search(k: int, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of a block, sorted by leaf, then the queries that visit some of its leaves. Rows of a block may differ in length."""
    for _, t in _stream(batches, 2):
        n = int((_column(t, "role").to_numpy() == 0).sum())
        if not n or n == t.num_rows:
            continue
        ids, leaf = _column(t, "vec_id").to_numpy(), _column(t, "leaf").to_numpy()[:n]
        lists = _column(t, "v")
        ends = np.concatenate([[0], np.cumsum(np.diff(np.asarray(lists.offsets)))])
        flat = lists.flatten().to_numpy(zero_copy_only=False)
        sizes = np.diff(ends)
        visited = _column(t, "leaves")
        by_size = {}
        for s in np.unique(sizes[:n]).tolist():
            at = np.flatnonzero(sizes[:n] == s)
            by_size[s] = at, flat[(ends[at][:, None] + np.arange(s)).ravel()].reshape(-1, s)
        for q in range(n, t.num_rows):
            if sizes[q] in by_size:
                at, v = by_size[sizes[q]]
                wanted = np.asarray(visited[q].values)
                a, b = np.searchsorted(leaf[at], wanted), np.searchsorted(leaf[at], wanted, "right")
                spots = np.concatenate([np.arange(x, y) for x, y in zip(a.tolist(), b.tolist())])
                best, score = _best(v, ids[at], spots, flat[ends[q] : ends[q + 1]], ids[q], k)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(best), ids[q])), pa.array(ids[at[best]]), pa.array(score)], ["query_id", "vec_id", "score"])


def op13_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``nearest`` of all embeddings for the rows whose vec_id is divisible by 20; ``usable`` and ``nearest`` tell what odd rows give."""
    rows = usable(table(spark, sf_dir, "embeddings"))
    return nearest(rows, rows.where("vec_id % 20 = 0"))
