"""Removal of byte strings that occur more than once anywhere in a corpus."""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, LongType, StringType, StructField, StructType

from tidemark.llm import bwt
from tidemark.llm.common import arrow_map, drop_staged, only, staged, table, unused
from tidemark.llm.ngram_join import _bytes_of, _mix, _powers, forget_powers

SPAN = 400
#: A passage is a repeated run of so many words, told by strings of so many bytes: less than 50 words of prose take.
PASSAGE_WORDS, PASSAGE = 50, 200
#: Bytes hashed for an anchor, for a span of 400 (in proportion for others); offsets of a window from its anchor that share a core.
GRAM, BLOCK = 64, 64
#: A document is read in stretches of so many window starts.
STRETCH = 1 << 19
#: A core that more pieces share is decided by counting window hashes over all tasks.
HOT = 4096
#: Symbols of a shard, and shards merged at a time: whole groups of pieces that share a core.
SHARD_SYMBOLS, SHARDS = 8_192, 16
#: As many rows and array elements together, some 40 bytes each, may be broadcast; more are joined by a shuffle.
ITEMS_SENT = 250_000
_U = np.uint64
_BYTES = _mix(np.arange(1, 257, dtype=np.uint64) * _U(0x9E3779B97F4A7C15))


class Reader:
    """Hashes of all parts of a byte string, and its anchors."""

    def __init__(self, data: np.ndarray):
        self.n = len(data)
        self.data = data
        self.up, self.down = _powers(self.n + 1)
        self.running = np.zeros(self.n + 1, np.uint64)
        np.cumsum(_BYTES[data] * self.up[: self.n], out=self.running[1:])

    def hash(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Hashes of the parts [a, b)."""
        return _mix((self.running[b] - self.running[a]) * self.down[a] + (b - a).astype(np.uint64))

    def anchors(self, span: int, gram: int, within: list[tuple[int, int]] | None = None) -> tuple[np.ndarray, ...]:
        """Hash, position, first and last window of each anchor; only of windows inside the parts ``within``, if they are given.

        The anchor of a window of ``span`` bytes is its leftmost part of ``gram`` bytes with the least hash, so equal windows
        have equal anchors at equal offsets, and every window has one. Neighbouring windows with the same anchor are a run.
        """
        parts = [(0, self.n)] if within is None else within
        found = [self._stretch(a, min(stop, a + STRETCH + span - 1), span, gram) for start, stop in parts for a in range(start, max(start, stop - span + 1), STRETCH)]
        return tuple(np.concatenate([f[k] for f in found]) for k in range(4)) if found else (np.empty(0, np.uint64), *[np.empty(0, np.int64)] * 3)

    def _stretch(self, start: int, stop: int, span: int, gram: int) -> tuple[np.ndarray, ...]:
        at = np.arange(start, stop - gram + 1)
        h = self.hash(at, at + gram)
        # the least of the upper bits, then the leftmost
        packed = (h >> _U(20) << _U(20)) | np.arange(len(h), dtype=np.uint64)
        least, size, width = packed, 1, span - gram + 1
        while size * 2 <= width:
            least = np.minimum(least[:-size], least[size:])
            size *= 2
        count = len(packed) - width + 1
        least = np.minimum(least[:count], least[width - size : width - size + count])
        spot = (least & _U(0xFFFFF)).astype(np.int64)
        cut = np.flatnonzero(np.diff(spot)) + 1
        first = np.concatenate([[0], cut])
        last = np.concatenate([cut - 1, [len(spot) - 1]])
        return h[spot[first]], spot[first] + start, first + start, last + start


def _keyed(docs: DataFrame) -> DataFrame:
    """text (null: empty) with k1, k2, by which a row's findings are joined to it; equal rows share them."""
    k1, k2 = _keys()
    return docs.select(F.coalesce(F.col("text"), F.lit("")).alias("text"), k1.alias("k1"), k2.alias("k2"))


def _keys() -> tuple[Column, Column]:
    return F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 62))), F.xxhash64(F.coalesce(F.col("text"), F.lit("")))


def repeated_spans(keyed: DataFrame, span: int = SPAN, gram: int | None = None, block: int = BLOCK, hot: int = HOT) -> DataFrame:
    """k1, k2 and the maximal runs [starts, ends) of bytes that a ``span``-byte string covers which also starts elsewhere.

    1. Every window of ``span`` bytes belongs to an anchor inside it, chosen by content. A run of windows with one anchor is
       a context; equal contexts, counted over the corpus, are repeated as a whole. This settles copies and the inside of
       long passages; an anchor that occurs once settles its windows as not repeated.
    2. Contexts that differ but share an anchor (the edges of passages, edited copies) are cut into pieces of ``block``
       windows. All windows of a piece share a core of span - block + 1 bytes; only pieces whose core occurs in another context
       go on.
    3. Pieces that share a core come together. With the core as one symbol a piece is a string of under 2 * block symbols, and
       a window is repeated if ``block`` symbols from its start also begin elsewhere. Shards of pieces get transforms of
       their own, which are merged by interleave refinement to that depth; the blocks left are the repeated windows.
    4. A core that more than ``hot`` pieces share is not gathered: its window hashes are counted by a partial aggregation.

    No step drops a window unread, so the result is that of a byte-level merge of the whole corpus. If ``keyed`` has parts
    (array of start and end), only windows inside them are read: the caller knows that no other is repeated. The result is a
    staged table; the tables in between are removed.
    """
    gram = gram or max(8, span * GRAM // SPAN)
    schema = "k1 bigint, k2 bigint, a bigint, c bigint, at int, lo int, hi int"
    read = keyed.where(F.octet_length("text") >= span).select("k1", "k2", "text", *[c for c in keyed.columns if c == "parts"])
    contexts = arrow_map(read, functools.partial(_contexts, span, gram), schema)
    contexts = staged(contexts, "contexts")
    counts = staged(contexts.groupBy("a", "c").agg(F.count("*").alias("n"), F.min(F.struct("k1", "k2", "at", "lo", "hi")).alias("one")), "counts")
    whole = contexts.join(counts.where("n > 1").select("a", "c"), ["a", "c"]).select("k1", "k2", F.col("lo").alias("p"), F.col("hi").alias("q"))
    several = counts.groupBy("a").agg(F.count("*").alias("m")).where("m > 1").select("a")
    unlike = counts.join(several, "a").select("a", "c", "one.*")
    # the contexts to cut, by document; a document has no more of them than it has windows
    asked = staged(unlike.groupBy("k1", "k2").agg(F.collect_list(F.struct("a", "c", "at", "lo", "hi")).alias("asked")), "unlike")
    # the same plan at every size: what is asked grows with the texts
    texts = keyed.select("k1", "k2", "text").join(asked, ["k1", "k2"])
    piece = "a bigint, core bigint, c bigint, k1 bigint, k2 bigint, p int, q int, left_ binary, right_ binary"
    pieces = staged(arrow_map(texts.select("k1", "k2", "text", "asked"), functools.partial(_pieces, span, block), piece), "pieces")
    shared = pieces.groupBy("a", "core").agg(F.count("*").alias("m"), F.min("c").alias("x"), F.max("c").alias("y")).where("x <> y").select("a", "core", "m")
    shared = staged(shared, "cores")
    often = shared.where(F.col("m") > hot).select("a", "core")
    rare = shared.where(F.col("m") <= hot).select("a", "core")
    # pieces with a frequent core leave first, so that no task of the next join reads them all
    near = _beside(pieces, often, ["a", "core"], "left_anti").join(rare, ["a", "core"]).repartition("a", "core").sortWithinPartitions("a", "core")
    merged = arrow_map(near, functools.partial(_merged, block), "k1 bigint, k2 bigint, p int, q int")
    live = _beside(pieces, often, ["a", "core"], "inner")
    windows = arrow_map(live.select(pieces.columns), functools.partial(_windows, block), "a bigint, core bigint, w bigint, c bigint, k1 bigint, k2 bigint, p int")
    windows = staged(windows, "windows")
    again = windows.groupBy("a", "core", "w").agg(F.min("c").alias("x"), F.max("c").alias("y")).where("x <> y").select("a", "core", "w")
    counted = windows.join(again, ["a", "core", "w"]).select("k1", "k2", "p", F.col("p").alias("q"))
    ranges = whole.unionAll(merged).unionAll(counted)
    ranges = ranges.repartition("k1", "k2").sortWithinPartitions("k1", "k2", "p")
    spans = staged(arrow_map(ranges, functools.partial(_runs, span), "k1 bigint, k2 bigint, starts array<int>, ends array<int>"), "spans")
    for done in (contexts, counts, asked, pieces, shared, windows):
        drop_staged(done)
    return spans


def _beside(docs: DataFrame, side: DataFrame, keys: list[str], how: str, items: str | None = None) -> DataFrame:
    """``docs`` joined with rows of a staged table: broadcast if its rows and the elements of ``items`` are few, else by a shuffle."""
    many = F.count("*") if items is None else F.count("*") + F.coalesce(F.sum(F.size(items)), F.lit(0))
    few = side.agg(many.alias("n")).first().n <= ITEMS_SENT
    return docs.join(F.broadcast(side) if few else side, keys, how)


def _contexts(span: int, gram: int, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    only("suffixes", forget_powers)
    names = ["k1", "k2", "a", "c", "at", "lo", "hi"]
    for whole in batches:
        for start in range(0, whole.num_rows, 512):
            batch = whole.slice(start, 512)
            data, offsets = _bytes_of(batch.column(2))
            within = [[(x["start"], x["end"]) for x in p] for p in batch.column(3).to_pylist()] if batch.num_columns > 3 else [None] * batch.num_rows
            rows, parts = [], []
            for k in range(batch.num_rows):
                own = Reader(data[offsets[k] : offsets[k + 1]])
                a, at, lo, hi = own.anchors(span, gram, within[k])
                parts.append((a.view(np.int64), own.hash(lo, hi + span).view(np.int64), at.astype(np.int32), lo.astype(np.int32), hi.astype(np.int32)))
                rows.append(len(a))
            keys = [pa.array(np.repeat(batch.column(k).to_numpy(zero_copy_only=False), rows)) for k in (0, 1)]
            yield pa.RecordBatch.from_arrays([*keys, *(pa.array(np.concatenate([p[k] for p in parts])) for k in range(5))], names)


def _pieces(span: int, block: int, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for start in range(0, whole.num_rows, 256):
            batch = whole.slice(start, 256)
            data, offsets = _bytes_of(batch.column(2))
            out: list[list] = [[] for _ in range(9)]
            for k, (k1, k2, asked) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(3).to_pylist())):
                text = data[offsets[k] : offsets[k + 1]]
                own = Reader(text)
                raw = text.tobytes()
                for x in asked:
                    at, lo, hi = x["at"], x["lo"], x["hi"]
                    j = np.arange((at - hi) // block, (at - lo) // block + 1)
                    p, q = np.maximum(lo, at - j * block - block + 1), np.minimum(hi, at - j * block)
                    s = at - j * block
                    e = s - block + 1 + span
                    core = _mix(own.hash(s, e) + j.astype(np.uint64)).view(np.int64)
                    for i in range(len(j)):
                        row = (x["a"], int(core[i]), x["c"], k1, k2, int(p[i]), int(q[i]), raw[p[i] : s[i]], raw[e[i] : q[i] + span])
                        for column, value in zip(out, row):
                            column.append(value)
            kinds = [*[pa.int64()] * 5, pa.int32(), pa.int32(), pa.binary(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, kinds)], ["a", "core", "c", "k1", "k2", "p", "q", "left_", "right_"])


def _merged(block: int, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Repeated windows of pieces that stand together by their core, as ranges [p, q] of window starts."""
    groups: dict[tuple[int, int], int] = {}
    pieces: dict[tuple[int, bytes, bytes], list[tuple]] = {}
    symbols = 0

    def settle() -> Iterator[pa.RecordBatch]:
        keys = list(pieces)
        shards, strings, size, first = [], [], 0, [0]
        for g, left, right in keys:
            s = np.empty(len(left) + 1 + len(right), np.uint16)
            s[: len(left)] = np.frombuffer(left, np.uint8)
            s[len(left) + 1 :] = np.frombuffer(right, np.uint8)
            s += 1
            s[len(left)] = 257 + g  # the core
            strings.append(s)
            size += len(s)
            if size >= SHARD_SYMBOLS:
                shards.append(bwt.Shard(strings))
                first.append(first[-1] + len(strings))
                strings, size = [], 0
        if strings:
            shards.append(bwt.Shard(strings))
        shard, string, offset = bwt.repeated(shards, block)
        found: dict[int, list[int]] = {}
        for k, o in zip((np.array(first)[shard] + string).tolist(), offset.tolist()):
            found.setdefault(k, []).append(o)
        rows = []
        for k, key in enumerate(keys):
            owners = pieces[key]
            hit = sorted(found.get(k, ()))
            many = len({c for c, *_ in owners}) > 1
            for _, k1, k2, p, q in owners:
                if many:
                    rows.append((k1, k2, p, q))
                else:
                    a = 0
                    own = [o for o in hit if o <= q - p]
                    for b in range(1, len(own) + 1):
                        if b == len(own) or own[b] != own[b - 1] + 1:
                            rows.append((k1, k2, p + own[a], p + own[b - 1]))
                            a = b
        if rows:
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32()]
            yield pa.RecordBatch.from_arrays([pa.array([r[n] for r in rows], kinds[n]) for n in range(4)], ["k1", "k2", "p", "q"])

    last = None
    for batch in batches:
        for a, core, c, k1, k2, p, q, left, right in zip(*(batch.column(n).to_pylist() for n in range(9))):
            if (a, core) != last:
                # only between groups, so that pieces with one core are merged together
                if symbols >= SHARDS * SHARD_SYMBOLS or len(groups) >= 60_000:
                    yield from settle()
                    groups, pieces, symbols = {}, {}, 0
                last = (a, core)
            g = groups.setdefault(last, len(groups))
            owners = pieces.setdefault((g, left, right), [])
            if not owners:
                symbols += len(left) + len(right) + 2
            owners.append((c, k1, k2, p, q))
    if pieces:
        yield from settle()


def _windows(block: int, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A hash of what each window of a piece holds beside the core."""
    names = ["a", "core", "w", "c", "k1", "k2", "p"]
    for batch in batches:
        out: list[list] = [[] for _ in names]
        for a, core, c, k1, k2, p, q, left, right in zip(*(batch.column(n).to_pylist() for n in range(9))):
            for o in range(q - p + 1):
                digest = hashlib.blake2b(left[o:] + b"|" + right[: block - 1 - (len(left) - o)] + len(left[o:]).to_bytes(4, "big"), digest_size=8).digest()
                for column, value in zip(out, (a, core, int.from_bytes(digest, "big", signed=True), c, k1, k2, p + o)):
                    column.append(value)
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.int32() if n == "p" else pa.int64()) for x, n in zip(out, names)], names)


def _runs(span: int, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Maximal runs of bytes that ranges of windows cover, for each document; its ranges stand together, by p."""
    key, starts, ends = None, [], []
    done: list[tuple] = []

    def batch_of() -> pa.RecordBatch:
        lists = [pa.array([d[n] for d in done], pa.list_(pa.int32())) for n in (1, 2)]
        return pa.RecordBatch.from_arrays([pa.array([d[0][0] for d in done], pa.int64()), pa.array([d[0][1] for d in done], pa.int64()), *lists], ["k1", "k2", "starts", "ends"])

    for batch in batches:
        for k1, k2, p, q in zip(*(batch.column(n).to_pylist() for n in range(4))):
            if (k1, k2) != key:
                if key is not None:
                    done.append((key, starts, ends))
                key, starts, ends = (k1, k2), [], []
            if ends and p <= ends[-1]:
                ends[-1] = max(ends[-1], q + span)
            else:
                starts.append(p)
                ends.append(q + span)
        if len(done) >= 4096:
            yield batch_of()
            done = []
    if key is not None:
        done.append((key, starts, ends))
    if done:
        yield batch_of()


def remove_repeats(docs: DataFrame, span: int = SPAN, keep: list[str] | None = None, least_words: int = 0, passage: int | None = None, **how) -> DataFrame:
    """``keep`` columns (doc_id and text, if none are named) with n_bytes, starts and ends of the removed runs, and kept.

    ``kept`` is what is left of the text's UTF-8 bytes, as binary; ``kept_text`` the same as text, without the parts of
    characters that a cut left. Strings are judged on the input. A run with fewer than ``least_words`` words and than
    ``SPAN`` bytes stays. With ``passage``, a shorter span, n_passage tells how many bytes lie in runs of at least
    ``PASSAGE_WORDS`` words or ``SPAN`` bytes that strings of that length cover; they are not removed. Then only where such
    strings cover ``span`` bytes on end is searched for ``span``-byte strings: all parts of a repeated string are repeated.

    Null text: empty. Null doc_id: a document like any other. Equal rows count as often as they occur, so all their windows
    are repeated. Texts shorter than ``span`` lose nothing; very long ones are read in stretches. Empty table: no rows. Names
    that clash with the added columns are those of ``keep``, which win where the caller selects; inner names are lengthened.
    """
    keyed = _keyed(docs)
    names = keep or ["doc_id", "text"]
    text, k1, k2 = (unused(names, n) for n in ("text__", "k1", "k2"))
    again = docs.select(*names, F.expr("coalesce(text, '')").alias(text), *[c.alias(n) for c, n in zip(_keys(), (k1, k2))])
    short = None
    if passage is None:
        spans = repeated_spans(keyed, span, **how)
    else:
        short = repeated_spans(keyed, passage, **how)
        runs = F.filter(F.zip_with("starts", "ends", lambda a, b: F.struct(a.alias("start"), b.alias("end"))), lambda x: x["end"] - x["start"] >= span)
        wide = staged(short.select("k1", "k2", runs.alias("parts")).where(F.size("parts") > 0), "wide")
        spans = repeated_spans(_beside(keyed, wide, ["k1", "k2"], "inner", "parts"), span, **how)
        both = staged(short.withColumnsRenamed({"starts": "from_", "ends": "to_"}).join(spans, ["k1", "k2"], "left"), "both")
        for done in (wide, short, spans):
            drop_staged(done)
        spans = both
    found = spans.select(F.col("k1").alias(k1), F.col("k2").alias(k2), *[F.col(c).alias(unused(names, f"{c}__")) for c in spans.columns[2:]])
    joined = _beside(again, found, [k1, k2], "left", found.columns[2]).drop(k1, k2)
    added = [StructField("n_bytes", LongType()), StructField("starts", ArrayType(IntegerType())), StructField("ends", ArrayType(IntegerType())), StructField("kept", BinaryType()), StructField("kept_text", StringType())]
    if told := short is not None:
        added.append(StructField("n_passage", LongType()))

    def long_enough(raw: bytes, a: int, b: int, words: int) -> bool:
        return b - a >= SPAN or len(raw[a:b].split()) >= words

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, 512):
                batch = whole.slice(start, 512)
                data, offsets = _bytes_of(batch.column(len(names)))
                kept, cuts, held = [], [], []
                runs = [[list(zip(x or (), y or ())) for x, y in zip(batch.column(n).to_pylist(), batch.column(n + 1).to_pylist())] for n in range(len(names) + 1, batch.num_columns, 2)]
                for k, found in enumerate(runs[-1]):
                    raw = data[offsets[k] : offsets[k + 1]].tobytes()
                    if least_words:
                        found = [(a, b) for a, b in found if long_enough(raw, a, b, least_words)]
                    cuts.append(found)
                    kept.append(b"".join(raw[a:b] for a, b in zip([0, *(b for _, b in found)], [*(a for a, _ in found), len(raw)])))
                    if told:
                        held.append(sum(b - a for a, b in runs[0][k] if long_enough(raw, a, b, PASSAGE_WORDS)))
                columns = [pa.array(np.diff(offsets).astype(np.int64)), *(pa.array([[x[n] for x in c] for c in cuts], pa.list_(pa.int32())) for n in (0, 1)), pa.array(kept, pa.binary()), pa.array([x.decode("utf-8", "ignore") for x in kept], pa.string())]
                if told:
                    columns.append(pa.array(held, pa.int64()))
                yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in range(len(names))), *columns], [*names, *(f.name for f in added)])

    return arrow_map(joined, run, StructType([*docs.select(*names).schema.fields, *added]))


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contract's columns; n_passage are the bytes in repeated passages of at least 50 words, shorter than 400 bytes or not."""
    found = remove_repeats(table(spark, sf_dir, "documents"), keep=["doc_id"], passage=PASSAGE)
    removed = F.aggregate(F.zip_with("starts", "ends", lambda a, b: (b - a).cast("long")), F.lit(0).cast("long"), lambda x, y: x + y)
    return found.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("starts").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"), "n_passage")
