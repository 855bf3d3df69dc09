"""N-gram Jaccard join: count-vector R-trees over documents that a lossless partition of the n-grams brings together."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import arrow_map, components, drop_staged, only, staged, table

#: Bytes of text hashed at a time; a longer document is taken alone.
CHUNK = 1 << 20
#: Size classes: the largest size of a class is about so many times its smallest.
RATIO = 1.25
#: Parts of the n-gram space beyond the largest difference of two linked sets.
SLACK = 0.35
#: N-grams that so many of about this many sampled documents hold count as frequent; at most so many of them.
SAMPLE_DOCS, SAMPLE_HAVE, FREQUENT_KEPT = 16_000, 4, 500_000
#: Coordinates of a count vector, points in a leaf of the R-tree.
GROUPS, LEAF = 32, 16
#: A task verifies blocks of at most so many sets and n-grams against each other.
BLOCK_SETS, BLOCK_NGRAMS = 2048, 4_000_000
#: As many rows of two or three numbers may be broadcast; more are joined by a shuffle.
IDS_SENT = 1_000_000
#: Places of the hash that tells, beyond that, which texts are likely to be wanted: for each that is, and as a power of two at most.
PLACES, MOST_PLACES = 16, 30
#: Signatures of a task that are packed together at most, and for each bucket; bits of each that are written, and that their bucket adds
#: for so many n-grams; a map of signatures has two to this power of places at most.
PACKED, PARCEL, PACKED_BITS, SPARE_BITS, MOST_MET = 1 << 20, 256, 24, 6, 28

_U = np.uint64
_BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_POWERS: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS[0]) < n:
        for k, base in enumerate((_BASE, _BASE_INVERSE)):
            steps = np.full(n, base, np.uint64)
            steps[0] = 1
            _POWERS[k] = np.cumprod(steps, dtype=np.uint64)
    return _POWERS[0], _POWERS[1]


def forget_powers() -> None:
    _POWERS[:] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column and the offsets of its rows in them."""
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    if column.buffers()[2] is None:
        return np.empty(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    data = np.frombuffer(column.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def ngram_sets(column: pa.Array, width: int) -> list[np.ndarray]:
    """For each text the sorted distinct 64-bit hashes of its word n-grams.

    Words are maximal runs of bytes that are no white space, A-Z lower-cased. With fewer words than ``width`` the whole
    sequence is the one n-gram; without words the set is empty.
    """
    data, offsets = _bytes_of(column)
    out: list[np.ndarray] = []
    row = 0
    while row < len(column):
        last = max(row + 1, int(np.searchsorted(offsets, offsets[row] + CHUNK, "right")) - 1)
        out.extend(_chunk_sets(data[offsets[row] : offsets[last]], offsets[row : last + 1] - offsets[row], width))
        row = last
    return out


def _chunk_sets(data: np.ndarray, offsets: np.ndarray, width: int) -> list[np.ndarray]:
    rows = len(offsets) - 1
    none = np.empty(0, np.uint64)
    if not len(data):
        return [none] * rows
    blank = _SPACE[data]
    first = ~blank
    first[1:] &= blank[:-1]
    last = ~blank
    last[:-1] &= blank[1:]
    cut = offsets[1:-1]
    cut = cut[(cut > 0) & (cut < len(data))]
    first[cut] = ~blank[cut]
    last[cut - 1] = ~blank[cut - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    if not len(starts):
        return [none] * rows
    up, down = _powers(len(data) + 1)
    running = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((_LOWER[data].astype(np.uint64) + _U(1)) * up[: len(data)], out=running[1:])
    words = _mix((running[ends] - running[starts]) * down[starts] + (ends - starts).astype(np.uint64))
    bound = np.searchsorted(starts, offsets)
    n = len(words) - width + 1
    grams = np.zeros(max(n, 0), np.uint64)
    for k in range(width):
        if n > 0:
            grams += words[k : k + n] * _U((0xD1B54A32D192ED03 * (2 * k + 3)) & 0xFFFFFFFFFFFFFFFF)
    grams = _mix(grams)
    out = []
    for a, b in zip(bound.tolist(), bound[1:].tolist()):
        if b - a >= width:
            out.append(np.unique(grams[a : b - width + 1]))
        elif b > a:
            whole = sum(int(w) * (0xA0761D6478BD642F * (2 * k + 5)) for k, w in enumerate(words[a:b])) + (b - a)
            out.append(_mix(np.array([whole & 0xFFFFFFFFFFFFFFFF], np.uint64)))
        else:
            out.append(none)
    return out


class Parts:
    """The lossless partition: which signatures two sets of Jaccard similarity >= num / den must share.

    Their symmetric difference is at most (a + b) (den - num) / (den + num). In the size class of the larger set, the n-gram
    space is cut into more parts than that bound, so at least ``parts - bound`` parts hold the same n-grams in both. A part is
    the stronger, the more n-grams outside ``frequent`` it holds, then the more n-grams. A set leaves out its weakest parts,
    fewer than ``parts - bound`` of them and never one of two equally strong ones: then the strongest part that two linked
    sets share is left out by neither. A set also gives the signatures of each higher class in which a partner can lie.
    ``frequent`` only decides what is left out; any choice of it loses nothing.
    """

    def __init__(self, num: int, den: int, frequent: np.ndarray | None = None):
        self.num, self.den = num, den
        self.frequent = np.empty(0, np.uint64) if frequent is None else frequent
        self.lows = [1]
        self.bounds: dict[int, np.ndarray] = {}

    def _class(self, n: int) -> int:
        while self.lows[-1] <= n:
            self.lows.append(max(self.lows[-1] + 1, int(self.lows[-1] * RATIO)))
        return int(np.searchsorted(self.lows, n, "right")) - 1

    def signatures(self, grams: np.ndarray) -> np.ndarray:
        n = len(grams)
        if not n:
            return np.empty(0, np.uint64)
        own, top = self._class(n), self._class(n * self.den // self.num)
        running = np.zeros(n + 1, np.uint64)
        np.cumsum(_mix(grams ^ _U(0x5851F42D4C957F2D)), out=running[1:])
        rare = np.zeros(n + 1, np.int64)
        if len(self.frequent):
            spot = np.minimum(np.searchsorted(self.frequent, grams), len(self.frequent) - 1)
            np.cumsum(self.frequent[spot] != grams, out=rare[1:])
        else:
            rare[:] = np.arange(n + 1)
        out = []
        for band in range(own, top + 1):
            most = self.lows[band + 1] - 1
            apart = 2 * most * (self.den - self.num) // (self.den + self.num)
            parts = int(np.ceil((1 + SLACK) * apart)) + 1 if apart else 1
            if parts not in self.bounds:
                self.bounds[parts] = np.array([(k << 64) // parts for k in range(1, parts)], np.uint64)
            at = np.concatenate([[0], np.searchsorted(grams, self.bounds[parts]), [n]])
            size = np.diff(at)
            tag = _mix(np.arange(parts, dtype=np.uint64) + _U(band << 32))
            found = _mix((running[at[1:]] - running[at[:-1]]) ^ tag) + size.astype(np.uint64)
            spare = parts - apart - 1
            if spare:
                strength = np.diff(rare[at]) * (n + 1) + size
                ranked = np.sort(strength)
                found = found[strength > ranked[spare - 1]] if ranked[spare] > ranked[spare - 1] else found[strength >= ranked[spare - 1]]
            out.append(found)
        return np.concatenate(out)


class RTree:
    """Count vectors of sets, packed by size into leaves, with the largest coordinates and smallest size of each node."""

    def __init__(self, points: np.ndarray, sizes: np.ndarray):
        self.points, self.sizes = points, sizes
        self.levels: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []  # highest coordinates, least and most size
        high, low, top = points, sizes, sizes
        while len(high) > LEAF:
            edge = np.arange(0, len(high), LEAF)
            high, low, top = np.maximum.reduceat(high, edge), np.minimum.reduceat(low, edge), np.maximum.reduceat(top, edge)
            self.levels.append((high, low, top))

    def near(self, point: np.ndarray, size: int, end: int, num: int, den: int) -> tuple[np.ndarray, np.ndarray]:
        """Points before ``end`` whose summed coordinate minima allow the similarity num / den, and those sums."""
        least = -(-size * num // den)

        def fits(high: np.ndarray, low: np.ndarray, top: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            overlap = np.minimum(high, point).sum(axis=1, dtype=np.int64)
            return (overlap * (den + num) >= num * (size + np.maximum(low, least))) & (top >= least), overlap

        at = None
        for high, low, top in reversed(self.levels):
            at = np.arange(len(high)) if at is None else (at[:, None] * LEAF + np.arange(LEAF)).ravel()
            at = at[at < len(high)]
            at = at[fits(high[at], low[at], top[at])[0]]
        at = np.arange(len(self.points)) if at is None else (at[:, None] * LEAF + np.arange(LEAF)).ravel()
        at = at[at < min(end, len(self.points))]
        good, overlap = fits(self.points[at], self.sizes[at], self.sizes[at])
        return at[good], overlap[good]


def linked(sets: list[np.ndarray], num: int, den: int) -> list[tuple[int, int]]:
    """Pairs (i, j) that link and join all sets that links connect; pairs within what is already joined are not tested."""
    order = sorted(range(len(sets)), key=lambda i: len(sets[i]))
    sizes = np.array([len(sets[i]) for i in order], np.int64)
    points = np.stack([np.bincount((sets[i] & _U(GROUPS - 1)).astype(np.int64), minlength=GROUPS) for i in order])
    tree = RTree(points, sizes)
    root = list(range(len(order)))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    out = []
    for i in range(1, len(order)):
        near, overlap = tree.near(points[i], int(sizes[i]), i, num, den)
        for j in near[np.argsort(-overlap, kind="stable")].tolist():
            a, b = find(i), find(j)
            if a != b:
                x, y = sets[order[j]], sets[order[i]]
                spot = np.minimum(np.searchsorted(y, x), len(y) - 1)
                both = int((y[spot] == x).sum())
                if den * both >= num * (len(x) + len(y) - both):
                    root[a] = b
                    out.append((order[i], order[j]))
    return out


def jaccard_components(docs: DataFrame, width: int, num: int, den: int) -> DataFrame:
    """doc_id, n_shingles and component_id for each row of ``docs`` (doc_id, text).

    Sets of ``width``-word n-grams link at Jaccard similarity num / den or more; component_id is the smallest doc_id
    reachable by links. Equal sets (told by two 64-bit hashes and their size) are one class, named by its smallest doc_id; only
    that document goes on, once however many rows it has, so copies give one row each and are never paired. Classes that share a signature of
    ``Parts`` are candidates; the candidates that signatures connect come together in blocks of bounded size, each pair of
    blocks once, and are verified exactly through an R-tree.

    Null and empty texts, and texts without words: size 0, linked with nothing. Null doc_id: linked with nothing, component_id
    null. Repeated rows: one row each. Different texts under one doc_id: each row has the component of its text's class, and
    classes named by the same doc_id are one. Very long texts are hashed alone. Other columns are not read. Empty table: no rows.
    """
    slim = staged(_fingerprints(docs, width), "ngrams")
    known = slim.where("doc_id is not null and n > 0")
    classes = known.groupBy("f", "g", "n").agg(F.min(F.struct("doc_id", "t")).alias("c")).select("f", "g", "n", F.col("c.doc_id").alias("id"), "c.t")
    classes = staged(classes, "classes")
    repeated = staged(known.groupBy("doc_id", "t").count().where("count > 1").drop("count"), "repeated")
    named = classes.select(F.col("id").alias("doc_id"), "t")
    # beyond IDS_SENT no text is shuffled for its signatures: those of a few others, copies or not, join no sets
    texts = _once(docs, named, repeated) if classes.count() <= IDS_SENT else _likely(docs, named)
    grams = classes.agg(F.sum("n")).first()[0] or 0
    marks = staged(_signatures(docs, texts, width, num, den, grams), "signatures")
    edges = _candidates(marks)
    groups = components(edges, "id", "low")
    # the classes of each group of candidates, with the group's size
    sized = staged(classes.select("id", "t", "n").join(groups, "id"), "sized")
    blocks = sized.groupBy("comp").agg(F.count("*").alias("sets"), F.sum("n").alias("grams"))
    many = F.greatest(F.ceil(F.col("sets") / BLOCK_SETS), F.ceil(F.col("grams") / BLOCK_NGRAMS)).cast("int")
    wanted = staged(sized.join(blocks.where("sets > 1").select("comp", many.alias("blocks")), "comp").select(F.col("id").alias("doc_id"), "t", "comp", "blocks"), "wanted")
    for done in (marks, edges, groups):
        drop_staged(done)
    texts = _once(docs, wanted, repeated) if wanted.count() <= IDS_SENT else _once(_likely(docs, wanted), wanted, repeated)
    own = F.pmod(F.hash("doc_id", "t"), F.col("blocks"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    # a class lies in block ``own`` and meets every block of its group
    placed = texts.select("comp", "doc_id", "text", own.alias("own"), other).select("comp", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "doc_id", "text")
    grouped = placed.repartition("comp", "i", "j").sortWithinPartitions("comp", "i", "j")
    edges = staged(_verified(grouped, width, num, den), "links")
    joined = components(edges)
    of_class = classes.join(joined.withColumnRenamed("comp", "low"), "id", "left").select("f", "g", "n", F.coalesce("low", "id").alias("least"))
    found = slim.join(of_class, ["f", "g", "n"], "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("least", "doc_id"))
    out = staged(found.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id")), "groups")
    for done in (slim, classes, repeated, sized, wanted, edges, joined):
        drop_staged(done)
    return out


def _once(docs: DataFrame, wanted: DataFrame, repeated: DataFrame) -> DataFrame:
    """The texts of ``wanted`` (doc_id, t, a hash of the text, and what goes with them), each once; ``repeated``: those that several rows have."""
    key = ["doc_id", "t"]
    each = docs.where("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("t"), "text")
    texts = _beside(each, wanted, key)
    many = repeated.count()
    if not many:
        return texts
    repeated = F.broadcast(repeated) if many <= IDS_SENT else repeated
    return texts.join(repeated, key, "left_anti").unionByName(texts.join(repeated, key, "left_semi").dropDuplicates(key))


def _likely(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """doc_id and text of the rows of ``docs`` that are in ``wanted`` (doc_id, t), and of about a sixteenth of the others.

    A projection: what is sent is a bit for each place of a hash, ``PLACES`` of them for a row of ``wanted``.
    """
    places = 1 << min(max(10, (wanted.count() * PLACES).bit_length()), MOST_PLACES)
    place = F.pmod(F.xxhash64("doc_id", "t"), F.lit(places))
    sent = docs.sparkSession.sparkContext.broadcast(_bits(wanted.select(place.alias("p")), places))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        only("ngrams", forget_powers)
        for batch in batches:
            p = batch.column(2).to_numpy()
            yield batch.select([0, 1]).filter(pa.array((sent.value[p >> 6] >> (p & 63).astype(np.uint64) & _U(1)).astype(bool)))

    each = _texts(docs.where("doc_id is not null")).withColumn("t", F.xxhash64("text")).select("doc_id", "text", place.alias("p"))
    return arrow_map(each, run, "doc_id bigint, text string")


def _bits(rows: DataFrame, places: int) -> np.ndarray:
    """A bit for each of ``places``, set where ``rows`` (p) has it."""
    words = rows.groupBy(F.shiftright("p", 6).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(p & 63 as int))")).alias("bits")).toArrow()
    bits = np.zeros(places >> 6, np.uint64)
    bits[words.column("word").to_numpy()] = words.column("bits").to_numpy().view(np.uint64)
    return bits


def _beside(docs: DataFrame, side: DataFrame, key: list[str]) -> DataFrame:
    """``docs`` with the rows of ``side``: broadcast if they are few, else by a shuffle."""
    return docs.join(F.broadcast(side) if side.count() <= IDS_SENT else side, key)


def _candidates(marks: DataFrame) -> DataFrame:
    """Edges (id, low) that connect all classes with a signature in common.

    Signatures are sorted by range over all tasks, with the ids: a signature of any number of ids is spread over as many tasks as
    it takes. In each task the ids of a signature are linked with the first of them; across tasks these firsts are, in a table of
    two rows per task.
    """
    spark = marks.sparkSession
    each = marks.select(F.explode("signatures").alias("signature"), "id")
    ordered = each.repartitionByRange("signature", "id").sortWithinPartitions("signature", "id")
    chained = arrow_map(ordered, _chained, "signature bigint, id bigint, low bigint")
    rows = "spark.sql.execution.arrow.maxRecordsPerBatch"
    usual = spark.conf.get(rows)
    spark.conf.set(rows, str(1 << 16))  # rows of two numbers
    try:
        links = staged(chained, "chained")
    finally:
        spark.conf.set(rows, usual)
    met = links.where("low is null").select("id", F.lag("id").over(Window.partitionBy("signature").orderBy("id")).alias("low"))
    star = links.where("low is not null").select("id", "low").unionAll(met.where("id <> low")).distinct()
    # a class has as many rows here as signatures at most; its lows are tied to the least of them, not each to the class
    star = star.withColumn("root", F.min("low").over(Window.partitionBy("id")))
    edges = staged(star.select(F.explode(F.array("id", "low")).alias("id"), F.col("root").alias("low")).where("id <> low").distinct(), "candidates")
    drop_staged(links)
    return edges


def _chained(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of sorted rows (signature, id): id and low, the first of its signature in this task; and, without low, where the task begins
    and the first id of the signature it ends with."""
    names, kind = ["signature", "id", "low"], pa.int64()
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        sign, ids = (batch.column(k).to_numpy() for k in range(2))
        if last is None:
            yield pa.RecordBatch.from_arrays([pa.array(sign[:1]), pa.array(ids[:1]), pa.nulls(1, kind)], names)
        else:  # the row before is that of the first id of its signature
            sign, ids = np.concatenate([last[0], sign]), np.concatenate([last[1], ids])
        begins = np.concatenate([[True], sign[1:] != sign[:-1]])
        low = ids[np.maximum.accumulate(np.where(begins, np.arange(len(ids)), 0))]
        last = sign[-1:], low[-1:]
        more = np.flatnonzero(low != ids)
        pairs = np.unique(np.stack([ids[more], low[more]], axis=1), axis=0)
        yield pa.RecordBatch.from_arrays([pa.nulls(len(pairs), kind), pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names)
    if last is not None:
        yield pa.RecordBatch.from_arrays([pa.array(last[0]), pa.array(last[1]), pa.nulls(1, kind)], names)


def _class_of(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Two hashes of each set."""
    pairs = np.zeros((len(sets), 2), np.uint64)
    for k, s in enumerate(sets):
        if len(s):
            pairs[k] = _mix(s).sum(dtype=np.uint64), np.bitwise_xor.reduce(_mix(s ^ _U(0xABCDEF)))
    pairs = _mix(pairs)
    return pairs[:, 0].view(np.int64), pairs[:, 1].view(np.int64)


def _fingerprints(docs: DataFrame, width: int) -> DataFrame:
    """doc_id, n, f and g (hashes of the set) and t (a hash of the text) of each row."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        only("ngrams", forget_powers)
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                batch = whole.slice(at, 512)
                sets = ngram_sets(batch.column(1), width)
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([len(s) for s in sets], pa.int64()), *map(pa.array, _class_of(sets)), batch.column(2)], ["doc_id", "n", "f", "g", "t"])

    return arrow_map(_texts(docs).withColumn("t", F.xxhash64("text")), run, "doc_id bigint, n bigint, f bigint, g bigint, t bigint")


def _frequent(docs: DataFrame, width: int) -> np.ndarray:
    """N-grams that many documents of a bounded sample hold, sorted; they steer which signatures are given, not what links."""
    n = docs.count()
    share = 1.0 if n <= SAMPLE_DOCS else SAMPLE_DOCS / n
    sample = docs.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 32)) < int(share * (1 << 32)))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        only("ngrams", forget_powers)
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                sets = ngram_sets(whole.slice(at, 512).column(1), width)
                grams, many = np.unique(np.concatenate(sets), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(grams.view(np.int64)), pa.array(many)], ["gram", "n"])

    counted = arrow_map(_texts(sample), run, "gram bigint, n bigint").groupBy("gram").agg(F.sum("n").alias("n"))
    rows = counted.where(F.col("n") >= SAMPLE_HAVE).orderBy(F.desc("n"), "gram").limit(FREQUENT_KEPT).select("gram").toArrow()
    return np.sort(rows.column(0).to_numpy().view(np.uint64))


def _signatures(docs: DataFrame, texts: DataFrame, width: int, num: int, den: int, grams: int) -> DataFrame:
    """id and the signatures of each of ``texts``, of documents that stand for a class of ``docs``; those with ``grams`` n-grams in all.

    Most signatures are of one text and connect nothing, so they are worked out twice: first some bits of each are shuffled, packed,
    to tell which are met again; then those, and the few others that share their place in a map of bits, go on with their ids.
    """
    context = docs.sparkSession.sparkContext
    sent = context.broadcast(_frequent(docs.where("doc_id is not null"), width))
    texts = _texts(texts)
    spread = min(max((grams << SPARE_BITS).bit_length() - PACKED_BITS, 0), 16)
    enough = min(PACKED, max(PARCEL << spread, 1 << 14))

    def signed(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[pa.Array, list[np.ndarray]]]:
        only("ngrams", forget_powers)
        parts = Parts(num, den, sent.value)
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                yield batch.column(0), [parts.signatures(s) for s in ngram_sets(batch.column(1), width)]

    def packed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for _, signs in signed(batches):
            held.append(np.concatenate(signs) >> _U(64 - PACKED_BITS - spread))
            n += len(held[-1])
            if n >= enough:
                yield from _packed(np.concatenate(held))
                held, n = [], 0
        if n:
            yield from _packed(np.concatenate(held))

    parcels = arrow_map(texts, packed, "bucket int, parcel binary").repartition("bucket").sortWithinPartitions("bucket")
    met = staged(arrow_map(parcels, _met_again, "p bigint"), "met")
    places = 1 << min(max(10, (met.count() * PLACES).bit_length()), MOST_MET)
    bits = context.broadcast(_bits(met.select(F.col("p").bitwiseAND(F.lit(places - 1)).alias("p")), places))
    drop_staged(met)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, signs in signed(batches):
            every = np.concatenate(signs)
            p = _mix(every >> _U(64 - PACKED_BITS - spread)) & _U(places - 1)
            again = (bits.value[p >> _U(6)] >> (p & _U(63)) & _U(1)).astype(bool)
            upto = np.concatenate([[0], np.cumsum(again)])
            ends = upto[np.concatenate([[0], np.cumsum([len(x) for x in signs])])].astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(every[again].view(np.int64)))
            yield pa.RecordBatch.from_arrays([ids, lists], ["id", "signatures"])

    return arrow_map(texts, run, "id bigint, signatures array<bigint>").where(F.size("signatures") > 0)


def _packed(keys: np.ndarray) -> Iterator[pa.RecordBatch]:
    """The leading bits of signatures, each at most twice: the last three bytes stand in a parcel, those before them name its bucket."""
    keys.sort()
    keys = keys[np.concatenate([np.ones(min(2, len(keys)), bool), keys[2:] != keys[:-2]])]
    each = keys.astype("<u8").view(np.uint8).reshape(-1, 8)[:, : PACKED_BITS // 8].tobytes()
    buckets, starts = np.unique(keys >> _U(PACKED_BITS), return_index=True)
    ends = np.concatenate([starts, [len(keys)]]).astype(np.int32) * (PACKED_BITS // 8)
    parcels = pa.Array.from_buffers(pa.binary(), len(buckets), [None, pa.py_buffer(ends), pa.py_buffer(each)])
    whole = pa.RecordBatch.from_arrays([pa.array(buckets.astype(np.int32)), parcels], ["bucket", "parcel"])
    for at in range(0, len(buckets), 512):
        yield whole.slice(at, 512)


def _met_again(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of parcels that stand together by bucket: hashes of what occurs more than once in a bucket."""
    key, held = None, []

    def told() -> Iterator[pa.RecordBatch]:
        each = np.frombuffer(b"".join(held), np.uint8).reshape(-1, PACKED_BITS // 8)
        values = np.zeros((len(each), 4), np.uint8)
        values[:, : PACKED_BITS // 8] = each
        values = np.sort(values.view("<u4").ravel())
        again = np.unique(values[1:][values[1:] == values[:-1]]).astype(np.uint64)
        if len(again):
            yield pa.RecordBatch.from_arrays([pa.array(_mix(again | _U(key << PACKED_BITS)).view(np.int64))], ["p"])

    for batch in batches:
        for bucket, parcel in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if bucket != key and held:
                yield from told()
                held.clear()
            key = bucket
            held.append(parcel)
    if held:
        yield from told()


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))


def _verified(grouped: DataFrame, width: int, num: int, den: int) -> DataFrame:
    """Links (a, b) within each group of rows (comp, i, j, doc_id, text), which stand together."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, ids, sets = None, [], []

        def links() -> Iterator[pa.RecordBatch]:
            if len(ids) > 1:
                found = linked(sets, num, den)
                yield pa.RecordBatch.from_arrays([pa.array([ids[a] for a, _ in found], pa.int64()), pa.array([ids[b] for _, b in found], pa.int64())], ["a", "b"])

        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                batch = whole.slice(at, 512)
                keys = list(zip(*(batch.column(k).to_pylist() for k in range(3))))
                for k, own, s in zip(keys, batch.column(3).to_pylist(), ngram_sets(batch.column(4), width)):
                    if k != key:
                        yield from links()
                        key, ids, sets = k, [], []
                    ids.append(own)
                    sets.append(s)
        yield from links()

    return arrow_map(grouped, run, "a bigint, b bigint")


def op6_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``jaccard_components`` of the whole texts of all documents, three words and 0.9; it tells what odd rows give."""
    return jaccard_components(table(spark, sf_dir, "documents"), 3, 9, 10)
