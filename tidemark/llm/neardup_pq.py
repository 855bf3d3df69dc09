"""Embedding near-duplicates by product quantisation: inverted lists, residual codes, table-lookup distances, exact rerank."""

from __future__ import annotations

import functools
import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import arrow_map, components, drop_staged, staged, table

#: Rows, spread by a hash of vec_id, on which the quantiser is fitted; more if lists are many; every row is indexed.
SAMPLE = 16_384
#: Rows that a list should hold, fewest lists, most lists that have a centroid each. More lists are pairs of centroids of halves.
LIST_ROWS, LEAST_LISTS, FLAT_LISTS = 256, 8, 1024
#: Nearest lists that each vector probes: of lists with a centroid each, of pairs.
PROBES, PAIR_PROBES = 8, 48
#: As many rows of a number per list are broadcast; more are joined by a shuffle.
LISTS_SENT = 200_000
#: Residual subspaces, and codes in each.
SUBSPACES, CODES = 16, 64
#: A block of a list; larger lists are split by a hash of vec_id.
BLOCK = 4096
ROUNDING = 1e-9


class Quantiser:
    """Coarse lists of unit vectors and, per subspace, codes of what remains.

    Up to ``FLAT_LISTS`` lists have a centroid each. More are the pairs of centroids of both halves of the vectors, so their number
    grows with the table while what is fitted and sent grows with its square root.
    """

    def __init__(self, sample: np.ndarray, lists: int):
        rng = np.random.default_rng(7)
        self.mid = sample.shape[1] // 2 if lists > FLAT_LISTS else 0
        if self.mid:
            each = math.isqrt(lists - 1) + 1
            self.halves = [_kmeans(x, each, rng) for x in (sample[:, : self.mid], sample[:, self.mid :])]
            self.probes = PAIR_PROBES
        else:
            self.centres, self.probes = _kmeans(sample, lists, rng), PROBES
        near = self.near(sample, 1)[:, 0]
        rest = sample - np.stack([self.centre(k) for k in near.tolist()])
        self.cuts = np.linspace(0, sample.shape[1], min(SUBSPACES, sample.shape[1]) + 1).astype(int)
        self.books = [_kmeans(rest[:, a:b], CODES, rng) for a, b in zip(self.cuts, self.cuts[1:])]

    def centre(self, at: int) -> np.ndarray:
        if not self.mid:
            return self.centres[at]
        a, b = self.halves
        return np.concatenate([a[at // len(b)], b[at % len(b)]])

    def near(self, rows: np.ndarray, many: int) -> np.ndarray:
        """The nearest lists of each row, nearest first."""
        if not self.mid:
            return _nearest(rows, self.centres, many)
        a, b = self.halves
        many = min(many, len(a) * len(b))
        out = np.empty((len(rows), many), np.int64)
        for k in range(0, len(rows), 256):
            parts = [rows[k : k + 256, : self.mid], rows[k : k + 256, self.mid :]]
            # a pair is among the nearest ``many`` only if either part is among the nearest ``many`` of its half
            d = [(c * c).sum(1)[None, :] - 2 * x @ c.T for x, c in zip(parts, (a, b))]
            best = [np.argsort(x, axis=1, kind="stable")[:, :many] for x in d]
            far = [np.take_along_axis(x, o, 1) for x, o in zip(d, best)]
            both = (far[0][:, :, None] + far[1][:, None, :]).reshape(len(parts[0]), -1)
            pick = np.argsort(both, axis=1, kind="stable")[:, :many]
            width = best[1].shape[1]
            out[k : k + 256] = np.take_along_axis(best[0], pick // width, 1) * len(b) + np.take_along_axis(best[1], pick % width, 1)
        return out

    def encode(self, rest: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Codes of residuals and the length of what the codes leave."""
        codes = np.empty((len(rest), len(self.books)), np.uint8)
        left = np.zeros(len(rest))
        for m, (a, b) in enumerate(zip(self.cuts, self.cuts[1:])):
            codes[:, m] = _nearest(rest[:, a:b], self.books[m], 1)[:, 0]
            left += ((rest[:, a:b] - self.books[m][codes[:, m]]) ** 2).sum(1)
        return codes, np.sqrt(left)

    def distances(self, query: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """Squared distances of a query's residual to coded residuals: a sum of looked-up parts."""
        total = np.zeros(len(codes))
        for m, (a, b) in enumerate(zip(self.cuts, self.cuts[1:])):
            total += ((self.books[m] - query[a:b]) ** 2).sum(1)[codes[:, m]]
        return total


def _nearest(rows: np.ndarray, centres: np.ndarray, many: int) -> np.ndarray:
    out = np.empty((len(rows), min(many, len(centres))), np.int64)
    norm = (centres * centres).sum(1)
    for a in range(0, len(rows), 4096):
        d = norm[None, :] - 2 * rows[a : a + 4096] @ centres.T
        if many == 1:
            out[a : a + 4096, 0] = d.argmin(1)
        else:
            out[a : a + 4096] = np.argsort(d, axis=1, kind="stable")[:, : out.shape[1]]
    return out


def _kmeans(rows: np.ndarray, k: int, rng: np.random.Generator, rounds: int = 8) -> np.ndarray:
    centres = rows[np.sort(rng.choice(len(rows), min(k, len(rows)), replace=False))].copy()
    for _ in range(rounds):
        near = _nearest(rows, centres, 1)[:, 0]
        size = np.bincount(near, minlength=len(centres))
        for j in range(rows.shape[1]):
            mean = np.bincount(near, weights=rows[:, j], minlength=len(centres)) / np.maximum(size, 1)
            centres[:, j] = np.where(size > 0, mean, centres[:, j])
    return centres


def _units(column: pa.Array, n: int) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    rows = flat.reshape(n, -1) if n else np.empty((0, 1))
    return rows / np.sqrt((rows * rows).sum(1))[:, None]


def _stream(batches: Iterable[pa.RecordBatch], keys: int) -> Iterator[tuple[tuple, pa.Table]]:
    """Rows that stand together and agree in the first ``keys`` columns, one table at a time."""
    held: list[pa.RecordBatch] = []
    key = None
    for batch in batches:
        listed = list(zip(*(batch.column(k).to_pylist() for k in range(keys))))
        a = 0
        for b in range(1, len(listed) + 1):
            if b == len(listed) or listed[b] != listed[a]:
                if listed[a] != key and held:
                    yield key, pa.Table.from_batches(held).combine_chunks()
                    held = []
                key = listed[a]
                held.append(batch.slice(a, b - a))
                a = b
    if held:
        yield key, pa.Table.from_batches(held).combine_chunks()


def _column(t: pa.Table, name: str) -> pa.Array:
    c = t.column(name).combine_chunks()
    return c.chunk(0) if isinstance(c, pa.ChunkedArray) else c


def near_duplicates(vectors: DataFrame, cosine: float = 0.9) -> DataFrame:
    """vec_id, n_links, component_id and kept for each row of ``vectors`` (vec_id, embedding).

    Vectors link at a cosine, in double precision, of ``cosine`` or more.

    1. A quantiser is fitted on a bounded sample. Every vector goes to the list of its nearest centroid; lists are cut into
       blocks by a hash.
    2. Within a block, vectors within half the linking angle of a leader form a ball: all of them link with each other, which
       is known without testing pairs. A group of copies of any size so becomes a few balls of one list.
    3. A ball probes the ``PROBES`` (of pairs of half centroids ``PAIR_PROBES``) nearest lists of its leader. In a list the codes' table-lookup distance, less what the
       code leaves out, is a lower bound of the distance to a leader; balls whose bound allows a link are reranked by the
       exact angle of the leaders. The radii tell whether all members link, none do, or members must be compared.
    4. Links of balls give the components, and member counts the number of links.

    No link below ``cosine`` is reported; a link is missed only if the leaders of the two vectors' balls, the vectors themselves
    for most, do not probe each other's list, either of them. Vectors that are null, empty, zero or hold null or non-finite
    components link with nothing, those of different length not with each other. Rows that repeat a vec_id count as one vector (the
    least embedding). Null vec_id: no links, component_id null, kept. Other columns are not read. Empty table: no rows.
    """
    spark = vectors.sparkSession
    ids = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
    wide = F.transform("embedding", lambda x: x.cast("double"))
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))) & F.exists("embedding", lambda x: x != 0)
    good = ids.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull()).where(finite)
    good = good.groupBy("vec_id").agg(F.min("embedding").alias("embedding")).select("vec_id", wide.alias("v"))
    usual = good.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).collect()  # a row for each length
    base = ids.select("vec_id")
    if len(usual) > 1:  # vectors of different length never link: each length is a table of its own
        of_length = [near_duplicates(good.where(F.size("v") == r.n).select("vec_id", F.col("v").alias("embedding")), cosine) for r in usual]
        linked = functools.reduce(DataFrame.unionAll, of_length)
        out = base.join(linked, "vec_id", "left")
        component = F.coalesce("component_id", "vec_id")
        return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"))
    if not usual:
        return base.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    total = usual[0]["count"]
    lists = max(LEAST_LISTS, total // LIST_ROWS)
    wanted = SAMPLE if lists <= FLAT_LISTS else max(SAMPLE, 16 * math.isqrt(lists))
    share = 1.0 if total <= wanted else wanted / total
    part = good.where(F.pmod(F.xxhash64("vec_id"), F.lit(1 << 32)) < int(share * (1 << 32))).limit(2 * wanted).toArrow()
    sample = _units(_column(part, "v"), part.num_rows)
    lists = max(1, min(lists, len(sample)) if lists <= FLAT_LISTS or usual[0].n < 2 else lists)
    angle = math.acos(cosine)
    sent = spark.sparkContext.broadcast(Quantiser(sample if len(sample) else np.eye(1, usual[0].n), lists))

    placed = arrow_map(good, functools.partial(_place, sent), "list int, vec_id bigint, v array<double>")
    placed = staged(placed, "placed")
    small = (lambda df: F.broadcast(df)) if lists <= LISTS_SENT else (lambda df: df)
    counts = placed.groupBy("list").count()  # one row per list
    blocks = placed.join(small(counts), "list").withColumn("block", F.pmod(F.xxhash64("vec_id"), F.ceil(F.col("count") / BLOCK)))
    blocks = blocks.select("list", "block", "vec_id", "v").repartition("list", "block").sortWithinPartitions("list", "block", "vec_id")
    members = staged(arrow_map(blocks, functools.partial(_balls, angle), "ball bigint, vec_id bigint, radius double, list int, v array<double>"), "balls")
    size = members.groupBy("ball").agg(F.count("*").alias("n"), F.max("radius").alias("radius"))
    leaders = members.where("ball = vec_id").select("ball", "list", "v").join(size, "ball")
    leaders = staged(leaders.select("ball", "list", "v", "n", "radius"), "leaders")

    asked = arrow_map(leaders.select("ball", "v", "radius", "list"), functools.partial(_probe, sent), "list int, role int, ball bigint, v array<double>, radius double")
    spots = leaders.groupBy("list").agg(F.ceil(F.count("*") / BLOCK).alias("blocks"))
    held = leaders.select("list", F.lit(0).alias("role"), "ball", "v", "radius").join(small(spots), "list")
    asked = asked.join(small(spots), "list")
    # blocks of held leaders meet blocks of probing ones, each pair in a task of its own
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))
    chunk = F.pmod(F.xxhash64("ball"), F.col("blocks"))
    held = held.select("list", chunk.alias("i"), other.alias("j"), "role", "ball", "v", "radius")
    asked = asked.select("list", other.alias("i"), chunk.alias("j"), "role", "ball", "v", "radius")
    both = held.unionAll(asked).repartition("list", "i", "j").sortWithinPartitions("list", "i", "j", "role", "ball")
    pairs = staged(arrow_map(both, functools.partial(_rerank, sent, angle), "a bigint, b bigint, whole boolean").distinct(), "pairs")

    weight = size.select(F.col("ball").alias("b"), "n")
    whole = pairs.where("whole")
    ways = whole.select("a", "b").unionAll(whole.select(F.col("b").alias("a"), F.col("a").alias("b")))
    full = ways.join(weight, "b").groupBy(F.col("a").alias("ball")).agg(F.sum("n").alias("links"))
    partial = pairs.where("not whole").select("a", "b")
    left = partial.join(members.select(F.col("ball").alias("a"), "vec_id", "v"), "a").select("a", "b", F.lit(0).alias("role"), "vec_id", "v")
    right = partial.join(members.select(F.col("ball").alias("b"), "vec_id", "v"), "b").select("a", "b", F.lit(1).alias("role"), "vec_id", "v")
    met = left.unionAll(right).repartition("a", "b").sortWithinPartitions("a", "b", "role", "vec_id")
    exact = staged(arrow_map(met, functools.partial(_members, cosine), "a bigint, b bigint, vec_id bigint, links bigint"), "exact")
    some = exact.groupBy("vec_id").agg(F.sum("links").alias("some"))
    edges = whole.select("a", "b").unionAll(exact.select("a", "b").distinct())
    labels = components(edges)
    joined = labels.withColumnRenamed("id", "ball")
    found = (
        members.select("vec_id", "ball")
        .join(size.select("ball", "n"), "ball")
        .join(full, "ball", "left")
        .join(joined, "ball", "left")
        .join(some, "vec_id", "left")
        .select("vec_id", (F.col("n") - 1 + F.coalesce("links", F.lit(0)) + F.coalesce("some", F.lit(0))).alias("n_links"), F.coalesce("comp", "ball").alias("component_id"))
    )
    out = base.join(found, "vec_id", "left")
    component = F.coalesce("component_id", "vec_id")
    out = staged(out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept")), "linked")
    for done in (placed, members, leaders, pairs, exact, labels):
        drop_staged(done)
    return out


def _place(sent, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            near = sent.value.near(_units(batch.column(1), batch.num_rows), 1)[:, 0]
            yield pa.RecordBatch.from_arrays([pa.array(near.astype(np.int32)), batch.column(0), batch.column(1)], ["list", "vec_id", "v"])


def _balls(angle: float, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Balls of half the linking angle around leaders, the least vec_id first."""
    half = angle / 2 - ROUNDING
    for (_list, _), t in _stream(batches, 2):
        ids, n = _column(t, "vec_id").to_numpy(), t.num_rows
        unit = _units(_column(t, "v"), n)
        ball, radius = np.full(n, -1), np.zeros(n)
        for a in range(0, n, 1024):
            sims = unit[a : a + 1024] @ unit.T
            for k in range(a, min(n, a + 1024)):
                if ball[k] < 0:
                    ball[k] = k
                    take = np.flatnonzero((sims[k - a] >= math.cos(half)) & (ball < 0))
                    take = take[np.arccos(np.clip(sims[k - a][take], -1, 1)) <= half]
                    ball[take] = k
                    radius[take] = np.arccos(np.clip(sims[k - a][take], -1, 1))
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids[ball]), pa.array(ids), pa.array(radius), pa.array(np.full(n, _list, np.int32)), _column(t, "v")], ["ball", "vec_id", "radius", "list", "v"]
        )


def _probe(sent, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        n = batch.num_rows
        if n:
            near = sent.value.near(_units(batch.column(1), n), sent.value.probes)
            row = np.repeat(np.arange(n), near.shape[1])
            take = batch.take(pa.array(row))
            yield pa.RecordBatch.from_arrays(
                [pa.array(near.ravel().astype(np.int32)), pa.array(np.ones(len(row), np.int32)), take.column(0), take.column(1), take.column(2)], ["list", "role", "ball", "v", "radius"]
            )


def _rerank(sent, angle: float, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    own = sent.value
    for (at, _, _), t in _stream(batches, 3):
        role, ids, radius = (_column(t, c).to_numpy() for c in ("role", "ball", "radius"))
        unit = _units(_column(t, "v"), t.num_rows)
        held, asks = np.flatnonzero(role == 0), np.flatnonzero(role == 1)
        if not len(held) or not len(asks):
            continue
        centre = own.centre(at)
        codes, left = own.encode(unit[held] - centre)
        a, b, whole = [], [], []
        for q in asks:
            reach = np.minimum(math.pi, angle + radius[q] + radius[held])
            far = np.sqrt(own.distances(unit[q] - centre, codes))
            near = held[far <= 2 * np.sin(reach / 2) + left + 1e-7]
            near = near[ids[near] != ids[q]]
            if len(near):
                between = np.arccos(np.clip(unit[near] @ unit[q], -1, 1))
                spread = radius[q] + radius[near]
                ok = between - spread <= angle + ROUNDING
                a.append(np.minimum(ids[near[ok]], ids[q]))
                b.append(np.maximum(ids[near[ok]], ids[q]))
                whole.append((between + spread)[ok] <= angle - ROUNDING)
        if a:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (a, b, whole)], ["a", "b", "whole"])


def _members(cosine: float, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many members of the other ball each member links with, by exact cosines; balls have at most BLOCK members."""
    for (a, b), t in _stream(batches, 2):
        role, ids = _column(t, "role").to_numpy(), _column(t, "vec_id").to_numpy()
        unit = _units(_column(t, "v"), t.num_rows)
        links = unit[role == 0] @ unit[role == 1].T >= cosine
        many = np.concatenate([links.sum(1), links.sum(0)])
        who = np.concatenate([ids[role == 0], ids[role == 1]])[many > 0]
        many = many[many > 0]
        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(who), a)), pa.array(np.full(len(who), b)), pa.array(who), pa.array(many.astype(np.int64))], ["a", "b", "vec_id", "links"])


def op3_embedding_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``near_duplicates`` of all embeddings, which tells what odd rows give."""
    return near_duplicates(table(spark, sf_dir, "embeddings"))
