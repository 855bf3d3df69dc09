"""Phrase collocation mining: position bitmaps per word and shard, extended depth-first by shift, AND and popcount."""

from __future__ import annotations

import functools
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import arrow_map, drop_staged, staged, table

#: Words of the longest phrase, occurrences that a candidate has at least, phrases reported of each language.
LONGEST, LEAST, REPORTED = 5, 100, 2000
#: Positions of a container of a bitmap, and of a shard: container numbers fit 16 bits.
WIDTH, SHARD = 16, 1 << 20
#: Positions that one worker holds of all languages, bytes that it splits at a time.
HELD, SLICE = 1 << 22, 1 << 22
#: As many frequent words, and as many frequent phrases of two or three, are broadcast; more come to their shards by a shuffle.
WORDS_SENT, PHRASES_SENT = 1_000_000, 2_000_000
#: Longer phrases, and pairs or triples, that a task counts before it gives them out; shards that it is given at a time.
COUNTED, DEALT, SHARDS_READ = 200_000, 3_000_000, 4
#: Words of the corpus for each bucket in which pairs and triples are added up.
BUCKET = 1_000_000
#: Containers of prefixes that are extended together; their branch is followed to its end before the next one is begun.
BRANCH = 1 << 15

_GAP, _NONE = b"\n", b""
_FOLD = bytes.maketrans(bytes(range(65, 91)) + b".,;:!?\x0b\x0c\r\t", bytes(range(97, 123)) + b"\n" * 9 + b" ")


class _Ids(dict):
    """Ids of words as they come: 0 is the gap between pieces, -1 nothing."""

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self) - 1
        return n


class Positions:
    """The words of one language in the order of the texts, with a gap between pieces, given out in shards."""

    def __init__(self):
        self.clear()

    def clear(self) -> None:
        self.ids = _Ids({_NONE: -1, _GAP: 0})
        self.parts: list[np.ndarray] = [np.zeros(1, np.int32)]
        self.size = 1

    def add(self, text: bytes) -> Iterator[tuple[list[bytes], np.ndarray, int]]:
        """The shards that a text fills; a phrase that goes on in the next one belongs to the shard in which it begins."""
        text = text.translate(_FOLD) + _GAP
        at = 0
        while at < len(text):
            end = at + SLICE
            if end < len(text):  # cut before a blank
                blank = max(text.rfind(b" ", at, end), text.rfind(_GAP, at, end))
                if blank <= at:
                    blank = min((x for x in (text.find(b" ", end), text.find(_GAP, end)) if x >= 0), default=len(text))
                end = blank
            words = text[at:end].replace(_GAP, b" \n ").split(b" ")
            got = np.fromiter(map(self.ids.__getitem__, words), np.int32, len(words))
            got = got[got >= 0]
            self.parts.append(got)
            self.size += len(got)
            at = end
            while self.size >= SHARD:
                yield self._shard(SHARD - LONGEST + 1, SHARD)

    def rest(self) -> Iterator[tuple[list[bytes], np.ndarray, int]]:
        if self.size > 1:
            yield self._shard(self.size, self.size)
        self.clear()

    def _shard(self, own: int, end: int) -> tuple[list[bytes], np.ndarray, int]:
        """Words of a shard, the word at each of its positions from 1 (0: gap), and how many positions are its own."""
        whole = np.concatenate(self.parts)
        names = list(self.ids)[1:]
        have, at = np.unique(np.concatenate([np.zeros(1, np.int32), whole[:end]]), return_inverse=True)
        words = [names[k] for k in have.tolist()]
        left = whole[own:]
        if len(left):
            kept, again = np.unique(np.concatenate([np.zeros(1, np.int32), left]), return_inverse=True)
            self.ids = _Ids({_NONE: -1} | {names[k]: n for n, k in enumerate(kept.tolist())})
            left = again[1:].astype(np.int32)
        self.parts, self.size = [left], len(left)
        return words, at[1:], own


def bitmaps(at: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of the words 1, 2, ... at the positions: containers in order of word and number, as ends by word, numbers and bits."""
    order = np.argsort(at, kind="stable")
    order = order[at[order] > 0]
    word, number = at[order], order // WIDTH
    first = np.ones(len(order), bool)
    first[1:] = (word[1:] != word[:-1]) | (number[1:] != number[:-1])
    begin = np.flatnonzero(first)
    bits = np.bitwise_or.reduceat(np.left_shift(1, order % WIDTH).astype(np.uint16), begin) if len(begin) else np.empty(0, np.uint16)
    ends = np.searchsorted(word[begin], np.arange(words), "right")
    return ends, number[begin].astype(np.uint16), bits


def _own(number: np.ndarray, bits: np.ndarray, own: np.ndarray | int) -> np.ndarray:
    """The bits of positions before ``own``."""
    room = np.clip(np.asarray(own, np.int64) - number.astype(np.int64) * WIDTH, 0, WIDTH)
    return bits & ((1 << room) - 1).astype(np.uint16)


def _shards(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each shard: lang, shard, own, its words, n (their occurrences at own positions), ends and packed bitmaps."""
    task, made = TaskContext.get().partitionId(), 0
    by_lang: dict[str, Positions] = {}

    def rows(lang: str, shards: Iterable) -> Iterator[pa.RecordBatch]:
        nonlocal made
        for words, at, own in shards:
            ends, number, bits = bitmaps(at, len(words))
            if len(bits):
                counts = np.add.reduceat(np.bitwise_count(_own(number, bits, own)).astype(np.int64), ends[:-1])
                names = pa.array(words[1:], pa.binary()).cast(pa.string())
                one = [pa.array([x], kind) for x, kind in ((lang, pa.string()), (task << 32 | made, pa.int64()), (own, pa.int32()))]
                lists = [pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x) for x in (names, pa.array(counts), pa.array(ends.astype(np.int32)))]
                yield pa.RecordBatch.from_arrays([*one, *lists, pa.array([pack(number, bits)], pa.binary())], ["lang", "shard", "own", "words", "n", "ends", "maps"])
                made += 1

    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            held = by_lang.setdefault(lang, Positions())
            yield from rows(lang, held.add(text.as_buffer().to_pybytes()))
        if sum(x.size for x in by_lang.values()) > HELD:
            for lang, held in by_lang.items():
                yield from rows(lang, held.rest())
            by_lang.clear()
    for lang, held in by_lang.items():
        yield from rows(lang, held.rest())


def pack(number: np.ndarray, bits: np.ndarray) -> bytes:
    """Containers compressed: numbers as steps from the one before, low and high bytes apart."""
    steps = np.diff(number.astype(np.uint16), prepend=np.uint16(0))
    planes = np.stack([steps, bits.astype(np.uint16)]).astype("<u2").view(np.uint8).reshape(2, -1, 2)
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(planes.transpose(0, 2, 1)).tobytes())


def unpack(maps: bytes) -> tuple[np.ndarray, np.ndarray]:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(maps), np.uint8).reshape(2, 2, -1)
    steps, bits = np.ascontiguousarray(planes.transpose(0, 2, 1)).view("<u2")[:, :, 0]
    return np.cumsum(steps, dtype=np.uint16), bits.astype(np.uint16)


class Shard:
    """The bitmaps of a shard's frequent words, by word and by container."""

    def __init__(self, own: int, ends: np.ndarray, number: np.ndarray, bits: np.ndarray):
        """Word k has the containers ``ends[k] : ends[k + 1]``."""
        self.ends, self.words = ends, len(ends) - 1
        self.first = _own(number, bits, own).astype(np.uint32)
        self.number, self.bits = number.astype(np.int64), bits.astype(np.uint32)
        self.word = np.repeat(np.arange(self.words), np.diff(ends))
        order = np.argsort(self.number, kind="stable")
        self.at_word, self.at_bits = self.word[order], self.bits[order]
        self.start = np.searchsorted(self.number[order], np.arange(SHARD // WIDTH + 2))

    def branches(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """First words with their containers: last word of each prefix, prefix, number and bits of each container."""
        a = 0
        while a < self.words:
            b = max(a + 1, int(np.searchsorted(self.ends, self.ends[a] + BRANCH, "right")) - 1)
            at = slice(self.ends[a], self.ends[b])
            yield np.arange(a, b), self.word[at] - a, self.number[at], self.first[at]
            a = b

    def extend(self, state: np.ndarray, prefix: np.ndarray, number: np.ndarray, bits: np.ndarray, allowed: np.ndarray | None = None):
        """Each prefix by each word that stands after it: parent, last word and count of the longer ones, and their containers.

        The bitmap of a prefix, one position on, meets the bitmaps of all words in the same container; what both hold is the
        bitmap of the longer one, on its last position. ``allowed``: sorted codes (state of the prefix * words + word) to keep.
        """
        moved = bits << 1
        over = np.flatnonzero(moved >> WIDTH)
        prefix, number, moved = np.concatenate([prefix, prefix[over]]), np.concatenate([number, number[over] + 1]), np.concatenate([moved & 0xFFFF, moved[over] >> WIDTH])
        some = np.flatnonzero(moved)
        prefix, number, moved = prefix[some], number[some], moved[some]
        many = self.start[number + 1] - self.start[number]
        row = np.repeat(np.arange(len(number)), many)
        spot = np.arange(len(row)) + np.repeat(self.start[number] - np.concatenate([[0], np.cumsum(many)[:-1]]), many) if len(row) else row
        both = moved[row] & self.at_bits[spot]
        hit = np.flatnonzero(both)
        row, spot, both = row[hit], spot[hit], both[hit]
        word = self.at_word[spot]
        if allowed is not None:
            good = np.flatnonzero(_place(allowed, state[prefix[row]] * self.words + word) >= 0)
            row, word, both = row[good], word[good], both[good]
        key, child = np.unique(prefix[row] * self.words + word, return_inverse=True)
        count = np.bincount(child, weights=np.bitwise_count(both), minlength=len(key)).astype(np.int64)
        return key // self.words, key % self.words, count, (child, number[row], both)


def _place(codes: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """The place of each wanted code among sorted ones, -1 if it isn't there."""
    if not len(codes):
        return np.full(len(wanted), -1)
    at = np.minimum(np.searchsorted(codes, wanted), len(codes) - 1)
    return np.where(codes[at] == wanted, at, -1)


class _Steered:
    """A shard with the frequent words, pairs and triples that it holds, by columns of its row or of what is sent to all.

    ``sent``: by language the ids of words, and the frequent pairs and triples as arrays of ids; a part that is None is in the row,
    as the columns ``known`` (place of a word in the shard and its id), ``pairs`` and ``triples``.
    """

    def __init__(self, row: dict, sent: dict):
        self.number, self.lang = row["shard"], row["lang"]
        if sent["words"] is None:
            known = sorted((k["id"], k["at"]) for k in row["known"] or ())
        else:
            of_lang = sent["words"].get(self.lang, {})
            known = sorted((of_lang[w], k) for k, w in enumerate(row["words"]) if w in of_lang)
        self.ids = np.array([i for i, _ in known], np.int64)
        place = np.array([k for _, k in known], np.int64)
        ends, (number, bits) = np.array(row["ends"], np.int64), unpack(row["maps"])
        size = ends[place + 1] - ends[place]
        at = np.repeat(ends[place] - np.concatenate([[0], np.cumsum(size)[:-1]]), size) + np.arange(size.sum()) if len(place) else place
        self.names = [row["words"][k] for k in place.tolist()]
        self.shard = Shard(row["own"], np.concatenate([[0], np.cumsum(size)]), number[at], bits[at])
        words = self.shard.words
        a, b = (_place(self.ids, x) for x in self._level(row, sent, "pairs"))
        self.pairs = np.sort((a * words + b)[(a >= 0) & (b >= 0)])
        a, b, c = (_place(self.ids, x) for x in self._level(row, sent, "triples"))
        first = _place(self.pairs, a * words + b)
        self.triples = np.sort((first * words + c)[(a >= 0) & (b >= 0) & (c >= 0) & (first >= 0)])

    def _level(self, row: dict, sent: dict, name: str) -> tuple[np.ndarray, ...]:
        parts = _PARTS[: 2 if name == "pairs" else 3]
        if sent[name] is None:
            held = row.get(name) or ()
            return tuple(np.array([x[c] for x in held], np.int64) for c in parts)
        return sent[name].get(self.lang, (np.empty(0, np.int64),) * len(parts))

    def pairs_of(self, branch: tuple):
        """The frequent pairs that begin with the first words of a branch."""
        parent, last, _, maps = self.shard.extend(*branch, self.pairs)
        return branch[0][parent], last, maps


def _read(sent, batches: Iterable[pa.RecordBatch]) -> Iterator[_Steered]:
    for batch in batches:
        for k in range(batch.num_rows):
            yield _Steered(batch.slice(k, 1).to_pylist()[0], sent.value)


_PARTS = ("id", "next", "third")


def _pairs(own: _Steered) -> Iterator[tuple[list[np.ndarray], np.ndarray]]:
    """The ids of two frequent words and how often the second follows the first in a shard."""
    for branch in own.shard.branches():
        parent, word, count, _ = own.shard.extend(*branch)
        yield [own.ids[branch[0][parent]], own.ids[word]], count


def _triples(own: _Steered) -> Iterator[tuple[list[np.ndarray], np.ndarray]]:
    """The ids and counts of phrases of three words whose pairs are both frequent."""
    for branch in own.shard.branches() if len(own.pairs) else ():
        first, last, maps = own.pairs_of(branch)
        parent, word, count, _ = own.shard.extend(last, *maps, own.pairs)
        yield [own.ids[first[parent]], own.ids[last[parent]], own.ids[word]], count


def _by_shard(found, parts: int, sent, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """shard, ids and n of what ``found`` counts."""
    for own in _read(sent, batches):
        for ids, count in found(own):
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(count), own.number)), *map(pa.array, ids), pa.array(count)], ["shard", *_PARTS[:parts], "n"])


def _merged(rows: np.ndarray) -> np.ndarray:
    """Columns (ids ..., n), those of equal ids added up, in order of the ids."""
    rows = rows[:, np.lexsort(rows[-2::-1])]
    first = np.ones(rows.shape[1], bool)
    first[1:] = (rows[:-1, 1:] != rows[:-1, :-1]).any(0)
    at = np.flatnonzero(first)
    return np.concatenate([rows[:-1, at], np.add.reduceat(rows[-1], at)[None]]) if len(at) else rows


def _by_bucket(found, parts: int, buckets: int, sent, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """bucket and packed counts: what ``found`` counts in the shards of a task, added up and dealt by a hash of the ids."""
    held: list[np.ndarray] = []

    def dealt() -> pa.RecordBatch:
        rows = _merged(np.concatenate(held, axis=1))
        mixed = np.zeros(rows.shape[1], np.uint64)
        for ids in rows[:-1]:
            mixed = (mixed ^ ids.view(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
            mixed ^= mixed >> np.uint64(29)
        bucket = (mixed % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        ends = np.searchsorted(bucket[order], np.arange(buckets + 1))
        some = np.flatnonzero(np.diff(ends))
        packer = zstandard.ZstdCompressor(level=1)
        packed = []
        for k in some.tolist():
            own = rows[:, order[ends[k] : ends[k + 1]]].copy()
            own[0] = np.diff(own[0], prepend=0)
            packed.append(packer.compress(np.ascontiguousarray(own.astype("<i8").view(np.uint8).reshape(len(own), -1, 8).transpose(0, 2, 1)).tobytes()))
        held.clear()
        return pa.RecordBatch.from_arrays([pa.array(some), pa.array(packed, pa.binary())], ["bucket", "packed"])

    for own in _read(sent, batches):
        for ids, count in found(own):
            if len(count):
                held.append(np.stack([*ids, count]))
        if sum(x.shape[1] for x in held) > DEALT:
            yield dealt()
    if held:
        yield dealt()


def _summed(parts: int, least: int, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """ids and n of what occurs ``least`` times or more, of the buckets in a task, the rows of a bucket together."""
    held: list[np.ndarray] = []
    at = None

    def often() -> pa.RecordBatch:
        rows = _merged(np.concatenate(held, axis=1))
        rows = rows[:, rows[-1] >= least]
        held.clear()
        return pa.RecordBatch.from_arrays([pa.array(x) for x in rows], [*_PARTS[:parts], "n"])

    for batch in batches:
        for bucket, packed in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if bucket != at and held:
                yield often()
            at = bucket
            planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(packed), np.uint8).reshape(parts + 1, 8, -1)
            rows = np.ascontiguousarray(planes.transpose(0, 2, 1)).view("<i8")[:, :, 0].astype(np.int64)
            rows[0] = np.cumsum(rows[0])
            held.append(rows)
            if len(held) > 64:
                held[:] = [_merged(np.concatenate(held, axis=1))]
    if held:
        yield often()


def _longer(longest: int, sent, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """lang, phrase, words and n of phrases of four words and more whose triples are all frequent, branch by branch to the end.

    Counts of a task's shards are added up first.
    """
    total: Counter = Counter()

    def rows() -> pa.RecordBatch:
        lang, phrase, words = zip(*total)
        return pa.RecordBatch.from_arrays([pa.array(lang, pa.string()), pa.array(phrase, pa.string()), pa.array(words, pa.int32()), pa.array(list(total.values()), pa.int64())], ["lang", "phrase", "words", "n"])

    for own in _read(sent, batches):
        for branch in own.shard.branches() if len(own.triples) else ():
            before, last, maps = own.pairs_of(branch)
            phrase = [f"{own.names[a]} {own.names[b]}" for a, b in zip(before.tolist(), last.tolist())]
            for n in range(3, longest + 1):
                state = _place(own.pairs, before * own.shard.words + last)
                parent, word, count, maps = own.shard.extend(state, *maps, own.triples)
                if not len(word):
                    break
                phrase = [f"{phrase[p]} {own.names[w]}" for p, w in zip(parent.tolist(), word.tolist())]
                before, last = last[parent], word
                if n > 3:
                    for p, c in zip(phrase, count.tolist()):
                        total[own.lang, p, n] += c
        if len(total) > COUNTED:
            yield rows()
            total.clear()
    if total:
        yield rows()


def collocations(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, within: int = 100, reported: int | None = REPORTED) -> DataFrame:
    """lang, rank, phrase, a, l, r, n and score of the phrases of ``docs`` (text, lang) that stand out, by language.

    Texts, A-Z lower-cased, are cut at ``[.,;:!?\\x0A-\\x0D]`` into pieces and those at blanks and tabs into words. Candidates are
    phrases of 2 to ``longest`` words that occur ``least`` times or more. A cut after k words gives l and r, the occurrences of both
    parts, and the score floor(1000 * a * n / (l * r)); the lowest counts. Candidates inside a longer one that has at least
    ``within`` percent of their occurrences are dropped. ``reported``: so many of each language; None: all.

    1. Each task cuts its texts into shards of at most ``SHARD`` positions, a free position between pieces. A shard is written as one
       row with the compressed bitmaps of its words' positions; later passes read it where it lies. Word counts are popcounts, summed.
    2. Of frequent words each shard extends each by every word that follows: the bitmap moved by one, AND, popcount. The counts of
       pairs are summed over all shards.
    3. In each shard the frequent pairs are extended by words that are frequent after their last one, and counted in the same way.
    4. From there each shard goes on depth-first to the longest phrases: a phrase goes on only by a word that makes a frequent triple
       with its last two. Popcounts are summed over all shards.

    Every part of a candidate is at least as frequent as the candidate, so nothing is lost, and all counts of parts are at hand. Frequent
    words, pairs and triples come to the shards by a broadcast up to ``WORDS_SENT`` and ``PHRASES_SENT``, beyond by joins. A shard is
    bounded, whatever the length of a text or piece: phrases that go past its end are read from the first words of the next, repeated at its end.

    Null lang: ``und``, one with a lang of that name. Null and empty texts have no words. Repeated rows and doc_ids: each row counts.
    Other columns are not read. Equal scores: the larger a, then the phrase in the order of its bytes; equal cuts: the smaller k.
    Empty table, or no candidate: no rows.
    """
    if longest > LONGEST:
        raise ValueError(f"phrases have at most {LONGEST} words")  # a shard repeats no more words of the next one
    texts = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), "text").where("length(text) > 0")
    shards = staged(arrow_map(texts, _shards, "lang string, shard bigint, own int, words array<string>, n array<bigint>, ends array<int>, maps binary"), "shards")
    spark = docs.sparkSession
    rows = "spark.sql.execution.arrow.maxRecordsPerBatch"
    usual = spark.conf.get(rows)
    spark.conf.set(rows, str(SHARDS_READ))  # a row is a shard
    try:
        return _mined(shards, least, longest, within, reported)
    finally:
        spark.conf.set(rows, usual)
        drop_staged(shards)


def _mined(shards: DataFrame, least: int, longest: int, within: int, reported: int | None) -> DataFrame:
    each = shards.select("lang", F.explode(F.arrays_zip("words", "n")).alias("w")).select("lang", F.col("w.words").alias("word"), F.col("w.n").alias("n"))
    counted = each.groupBy("lang", "word").agg(F.sum("n").alias("n"))
    words = staged(counted.where(F.col("n") >= least).withColumn("id", F.monotonically_increasing_id()), "words")
    total = each.groupBy("lang").agg(F.sum("n").alias("n"))
    few = words.count() <= WORDS_SENT

    buckets = 1 + sum(r.n for r in total.collect()) // BUCKET  # a row for each language

    def frequent(found, parts: int, held: DataFrame, sent) -> tuple[DataFrame, DataFrame]:
        """The phrases that ``found`` counts ``least`` times or more, and the counts of each shard, worked out only if they are asked for."""
        dealt = arrow_map(held, functools.partial(_by_bucket, found, parts, buckets, sent), "bucket bigint, packed binary")
        together = dealt.repartition("bucket").sortWithinPartitions("bucket")
        ids = ", ".join(f"{c} bigint" for c in _PARTS[:parts])
        often = staged(arrow_map(together, functools.partial(_summed, parts, least), f"{ids}, n bigint"), "often")
        return often, arrow_map(held, functools.partial(_by_shard, found, parts, sent), f"shard bigint, {ids}, n bigint")

    two, pairs = frequent(_pairs, 2, *_steered(shards, words, few))
    three, triples = frequent(_triples, 3, *_steered(shards, words, few, (two, pairs)))
    held, sent = _steered(shards, words, few, (two, pairs), (three, triples))
    longer = arrow_map(held, functools.partial(_longer, longest, sent), "lang string, phrase string, words int, n bigint")
    found = longer.groupBy("lang", "phrase", "words").agg(F.sum("n").alias("a")).where(F.col("a") >= least)
    found = staged(_named(two, words, 2).unionAll(_named(three, words, 3)).unionAll(found).where(F.col("words") <= longest), "phrases")

    out = staged(_scored(found, words, total, within, reported), "collocations")
    for done in (words, two, three, found):
        drop_staged(done)
    return out


def _steered(shards: DataFrame, words: DataFrame, few: bool, *levels: tuple[DataFrame, DataFrame]) -> tuple[DataFrame, object]:
    """The shards, and what is sent to all of them: ids of frequent words, frequent pairs, frequent triples (each with all that were
    counted). What is too much to be sent is joined to the shard that holds it, a list no longer than the shard."""
    sent = {"words": None, "pairs": {}, "triples": {}}
    if few:
        rows = words.select("lang", "word", "id").toArrow()
        sent["words"] = {}
        for lang, word, id_ in zip(*(rows.column(c).to_pylist() for c in ("lang", "word", "id"))):
            sent["words"].setdefault(lang, {})[word] = id_
    else:
        each = shards.select("shard", "lang", F.posexplode("words").alias("at", "word")).join(words.select("lang", "word", "id"), ["lang", "word"])
        shards = shards.join(each.groupBy("shard").agg(F.collect_list(F.struct("at", "id")).alias("known")), "shard", "left")
    for name, (often, counted) in zip(("pairs", "triples"), levels):
        parts = [c for c in _PARTS if c in often.columns]
        if often.count() <= PHRASES_SENT:
            rows = often.join(words.select("id", "lang"), "id").groupBy("lang").agg(*[F.collect_list(c).alias(c) for c in parts]).toArrow()
            sent[name] = {lang: tuple(x.values.to_numpy() for x in lists) for lang, *lists in zip(rows.column("lang").to_pylist(), *(rows.column(c) for c in parts))}
        else:
            sent[name] = None
            held = counted.drop("n").join(often.drop("n"), parts).groupBy("shard").agg(F.collect_list(F.struct(*parts)).alias(name))
            shards = shards.join(held, "shard", "left")
    return shards, shards.sparkSession.sparkContext.broadcast(sent)


def _named(level: DataFrame, words: DataFrame, many: int) -> DataFrame:
    """lang, phrase, words and a of phrases told by ids."""
    for k, c in enumerate(_PARTS[:many]):
        level = level.join(words.select(F.col("id").alias(c), F.col("word").alias(f"w{k}"), *(["lang"] if not k else [])), c)
    return level.select("lang", F.concat_ws(" ", *[f"w{k}" for k in range(many)]).alias("phrase"), F.lit(many).alias("words"), F.col("n").alias("a"))


def _scored(found: DataFrame, words: DataFrame, total: DataFrame, within: int, reported: int | None) -> DataFrame:
    """The candidates (lang, phrase, words, a) that no longer one stands for, by their lowest cut, ranked."""
    parts = found.select("lang", "phrase", "a").unionAll(words.select("lang", F.col("word").alias("phrase"), F.col("n").alias("a")))
    shorter = F.array(F.expr("substring(phrase, instr(phrase, ' ') + 1)"), F.expr("substring_index(phrase, ' ', words - 1)"))
    inside = found.where("words > 2").select("lang", F.explode(shorter).alias("phrase"), "a").groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    alone = found.join(inside, ["lang", "phrase"], "left").where(F.col("longer").isNull() | (100 * F.col("longer") < within * F.col("a")))
    cuts = alone.select("lang", "phrase", "words", "a", F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k"))
    cuts = cuts.withColumns({"first": F.expr("substring_index(phrase, ' ', k)"), "rest": F.expr("substring_index(phrase, ' ', k - words)")})
    cuts = cuts.join(parts.select("lang", F.col("phrase").alias("first"), F.col("a").alias("l")), ["lang", "first"])
    cuts = cuts.join(parts.select("lang", F.col("phrase").alias("rest"), F.col("a").alias("r")), ["lang", "rest"]).join(total, "lang")
    exact = "(1000 * cast(a as decimal(19, 0)) * cast(n as decimal(19, 0))) div (cast(l as decimal(19, 0)) * cast(r as decimal(19, 0)))"
    lowest = cuts.withColumn("score", F.expr(exact)).groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    place = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = lowest.select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score").withColumn("rank", F.row_number().over(place))
    if reported is not None:
        ranked = ranked.where(F.col("rank") <= reported)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def op11_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``collocations`` of the whole texts of documents, which tells what odd rows give."""
    return collocations(table(spark, sf_dir, "documents"))


OP11_SQL = """
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(string_split_regex(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece
  FROM documents WHERE length(text) > 0
), w AS (
  SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM p
), g AS (
  SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS phrase
  FROM w, (SELECT unnest([1, 2, 3, 4, 5]) AS k) WHERE len(w) >= k
), f AS (
  SELECT lang, phrase, k, count(*) AS f FROM g GROUP BY ALL
), total AS (
  SELECT lang, sum(f) AS n FROM f WHERE k = 1 GROUP BY lang
), c AS (
  SELECT lang, phrase, k AS words, f AS a, string_split(phrase, ' ') AS w FROM f WHERE k > 1 AND f >= 100
), gone AS (
  SELECT DISTINCT s.lang, s.phrase FROM c s JOIN (
    SELECT lang, words, a, unnest([array_to_string(w[2:], ' '), array_to_string(w[:-2], ' ')]) AS phrase FROM c
  ) b ON b.lang = s.lang AND b.phrase = s.phrase AND 100 * b.a >= 100 * s.a
), cut AS (
  SELECT c.*, unnest(range(1, words)) AS cutat FROM c ANTI JOIN gone USING (lang, phrase)
), scored AS (
  SELECT cut.lang, cut.phrase, a, x.f AS l, y.f AS r, n, cutat, (1000 * a::HUGEINT * n::HUGEINT) // (x.f::HUGEINT * y.f::HUGEINT) AS score
  FROM cut JOIN f x ON x.lang = cut.lang AND x.phrase = array_to_string(w[:cutat], ' ')
  JOIN f y ON y.lang = cut.lang AND y.phrase = array_to_string(w[cutat + 1:], ' ') JOIN total ON total.lang = cut.lang
), lowest AS (
  SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cutat) AS place FROM scored
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM lowest WHERE place = 1
)
SELECT lang, rank::BIGINT AS rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score
FROM ranked WHERE rank <= 2000
"""
