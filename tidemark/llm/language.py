"""Language identification by n-gram filters that hold a language bitmask at each position."""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from tidemark.llm.common import arrow_map, only, table, unused

#: Letters (and the blanks around words) of an n-gram.
GRAM = 4
#: Training reads about so many documents of each language, spread by a hash of doc_id, and all of a language that has no more;
#: n-grams are taken from the whole text of each.
SAMPLE_DOCS = 12_000
#: A language of fewer sampled documents has all their n-grams counted, others those of two documents or more. When languages
#: are compared, so many documents without the n-gram are added, so that a handful does not take n-grams from the others.
FEW_DOCS = 20
#: N-grams that a worker holds before it counts them.
HELD = 2_000_000
#: The most frequent n-grams of each language enter the filter.
GRAMS_KEPT = 8_000
#: A language holds an n-gram if it is in this share of the documents, against the language that has it most often.
OWN_SHARE = 0.25
HASHES = 3
SLOTS_PER_GRAM = 16
UND = "und"
ROWS = 64


def _grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """64-bit codes of all n-grams of the lower-cased texts, the row of each, and per row whether it has a letter.

    Runs of other characters count as one blank; n-grams without a letter are left out.
    """
    joined = "\0".join(texts).lower()
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    # a lower-cased text may hold more characters than before; rows are found by the separators
    kind = _letters()[np.minimum(points, _LIMIT)]
    if (points >= _LIMIT).any():
        far = np.flatnonzero(points >= _LIMIT)
        kind[far] = [chr(c).isalpha() for c in points[far]]
    ends = points == 0
    keep = kind | ends
    keep[1:] |= kind[:-1]  # the first blank behind a letter
    row = np.cumsum(ends)
    own = np.where(kind, points, 32).astype(np.uint64)
    own, at, cut = own[keep], row[keep], ends[keep]
    lettered = np.zeros(len(texts), bool)
    lettered[row[kind]] = True
    # a blank before the first word of each text
    own = np.concatenate([np.array([32], np.uint64), own])
    at = np.concatenate([np.zeros(1, at.dtype), at])
    cut = np.concatenate([np.zeros(1, bool), cut])
    n = len(own) - GRAM + 1
    if n <= 0:
        return np.empty(0, np.uint64), np.empty(0, np.int64), lettered
    code = np.zeros(n, np.uint64)
    for k in range(GRAM):
        code = code * np.uint64(0x9E3779B97F4A7C15) + own[k : k + n]
    whole = at[:n] == at[GRAM - 1 :]
    # a separator belongs to the text behind it and stands for the blank before its first word
    code, at = code[whole], at[:n][whole]
    return code, at, lettered


_LIMIT = 0x3000
_TABLE: list[np.ndarray] = []


def _letters() -> np.ndarray:
    if not _TABLE:
        _TABLE.append(np.array([chr(c).isalpha() for c in range(_LIMIT + 1)]))
    return _TABLE[0]


def _mixed(code: np.ndarray, seed: int) -> np.ndarray:
    x = code ^ np.uint64((seed * 0xD6E8FEB86659FD93) & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0x9FB21C651E98DF25)
    return x ^ (x >> np.uint64(32))


class LanguageFilter:
    """A Bloom filter sliced by language: each slot is a row of bits, one per language.

    The rows at an n-gram's ``HASHES`` slots, and-ed, are all languages that hold it. A language whose slots are filled to the
    share f answers wrongly for a foreign n-gram at the rate f ** HASHES; hits are corrected for that.
    """

    def __init__(self, languages: list[str], grams: list[np.ndarray]):
        self.languages = languages
        self.words = max(1, (len(languages) + 63) // 64)
        most = max([len(g) for g in grams], default=1)
        self.slots = 1 << max(10, math.ceil(math.log2(max(1, most) * SLOTS_PER_GRAM)))
        self.bits = np.zeros((self.words, self.slots), np.uint64)
        for k, own in enumerate(grams):
            for seed in range(HASHES):
                np.bitwise_or.at(self.bits[k // 64], self._slot(own, seed), np.uint64(1) << np.uint64(k % 64))
        filled = [float(np.mean(self.bits[k // 64] >> np.uint64(k % 64) & np.uint64(1))) for k in range(len(languages))]
        self.wrong = np.array([f**HASHES for f in filled])

    def _slot(self, code: np.ndarray, seed: int) -> np.ndarray:
        return (_mixed(code, seed + 1) & np.uint64(self.slots - 1)).astype(np.int64)

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language, score and coverage (share of n-grams that the language holds) of each text.

        The score is the language's share of all corrected hits times a shrinkage for short texts. No letter: und, 0, 0.
        """
        n, many = len(texts), len(self.languages)
        code, row, lettered = _grams(texts)
        total = np.bincount(row, minlength=n).astype(float)
        hits = np.zeros((n, many))
        spots = [self._slot(code, seed) for seed in range(HASHES)]
        for w in range(self.words):
            mask = self.bits[w][spots[0]]
            for s in spots[1:]:
                mask &= self.bits[w][s]
            for k in range(64 * w, min(many, 64 * w + 64)):
                hits[:, k] = np.bincount(row, weights=(mask >> np.uint64(k % 64) & np.uint64(1)).astype(float), minlength=n)
        if not many:
            return [UND] * n, np.zeros(n), np.zeros(n)
        true = np.clip((hits - total[:, None] * self.wrong) / (1 - self.wrong), 0, None)
        best = true.argmax(axis=1)  # ties: the first language by code point
        top = true[np.arange(n), best]
        share = top / np.maximum(true.sum(axis=1), 1e-9) * total / (total + 1)
        cover = np.minimum(1.0, top / np.maximum(total, 1))
        names = [self.languages[b] if ok else UND for b, ok in zip(best, lettered)]
        return names, np.where(lettered, share, 0.0), np.where(lettered, cover, 0.0)


def _counted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """lang, gram and n, the documents that hold it, of rows (lang, text)."""
    only("language")
    held: dict[str, list[np.ndarray]] = {}
    size = 0

    def counts() -> Iterator[pa.RecordBatch]:
        for lang, parts in held.items():
            grams, times = np.unique(np.concatenate(parts), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(grams), pa.string()), pa.array(grams.view(np.int64)), pa.array(times, pa.int64())], ["lang", "gram", "n"])
        held.clear()

    for whole in batches:
        for at in range(0, whole.num_rows, ROWS):
            batch = whole.slice(at, ROWS)
            langs = np.array(batch.column(0).to_pylist(), object)
            code, row, _ = _grams([t.replace("\0", " ") for t in batch.column(1).to_pylist()])
            cuts = np.searchsorted(row, np.arange(len(langs) + 1))
            for k, lang in enumerate(langs):
                own = np.unique(code[cuts[k] : cuts[k + 1]])
                if len(own):
                    held.setdefault(lang, []).append(own)
                    size += len(own)
            if size >= HELD:
                yield from counts()
                size = 0
    yield from counts()


def train(docs: DataFrame, sample_docs: int = SAMPLE_DOCS, grams_kept: int = GRAMS_KEPT) -> LanguageFilter:
    """A filter of the n-grams most frequent in each language of ``docs`` (text, non-null lang), by document frequency.

    An n-gram that a language has far less often than another (quotations, mixed texts) is not counted as its own.

    Fitted on a bounded, documented sample: about ``sample_docs`` rows of each language, chosen by a hash of doc_id (without one,
    of the text), and every row of a language with no more. So each language with an n-gram in its rows is learned at any input
    size. What comes to the driver is ``grams_kept`` n-grams per language.
    """
    known = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    large = known.groupBy("lang").count().where(F.col("count") > sample_docs).collect()  # one row per large language
    bounds = docs.sparkSession.createDataFrame([(r.lang, int(sample_docs / r["count"] * (1 << 32))) for r in large], "lang string, bound long")
    spot = F.pmod(F.when(F.col("doc_id").isNull(), F.xxhash64("text")).otherwise(F.xxhash64("doc_id")), F.lit(1 << 32))
    sample = known.select("lang", "text", spot.alias("spot")).join(F.broadcast(bounds), "lang", "left")
    sample = sample.where(F.col("bound").isNull() | (F.col("spot") < F.col("bound"))).select("lang", "text")

    counted = arrow_map(sample, _counted, "lang string, gram bigint, n bigint").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    docs_of = sample.groupBy("lang").agg(F.count("*").alias("docs"))
    rate = counted.join(F.broadcast(docs_of), "lang").where((F.col("n") > 1) | (F.col("docs") < FEW_DOCS))  # one row per language
    rate = rate.withColumn("rate", F.col("n") / F.col("docs")).withColumn("sure", F.col("n") / (F.col("docs") + FEW_DOCS))
    rate = rate.withColumn("most", F.max("sure").over(Window.partitionBy("gram"))).where(F.col("rate") >= OWN_SHARE * F.col("most"))
    best = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    kept = rate.withColumn("place", F.row_number().over(best)).where(F.col("place") <= grams_kept)
    found = kept.groupBy("lang").agg(F.array_sort(F.collect_list("gram")).alias("grams")).collect()
    found = sorted(found, key=lambda r: r.lang)
    return LanguageFilter([r.lang for r in found], [np.array(r.grams, np.int64).view(np.uint64) for r in found])


def identify(docs: DataFrame, model: LanguageFilter, keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns (all, if none are named) with lang_pred, lang_score and lang_cover for each whole text.

    A projection: no shuffle. Null text, or one without a letter: und with score 0. Very long texts are read whole; repeated
    rows and rows without doc_id are told like any other. Columns of these names are replaced. Empty table: no rows.
    """
    spark = docs.sparkSession
    names = [c for c in (keep or docs.columns) if c not in ("lang_pred", "lang_score", "lang_cover")]
    source = docs.select(*names, F.col("text").alias(unused(names, "text__")))
    sent = spark.sparkContext.broadcast(model)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        only("language")
        own = sent.value
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS):
                batch = whole.slice(at, ROWS)
                pred, score, cover = own.predict([(t or "").replace("\0", " ") for t in batch.column(len(names)).to_pylist()])
                yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), pa.array(pred, pa.string()), pa.array(score), pa.array(cover)], [*names, "lang_pred", "lang_score", "lang_cover"])

    extra = [StructField("lang_pred", StringType()), StructField("lang_score", DoubleType()), StructField("lang_cover", DoubleType())]
    return arrow_map(source, run, StructType([*source.select(*names).schema.fields, *extra]))


def remainder(by: int) -> Column:
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(by))


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``identify`` of the whole texts of all documents, with what ``train`` learns from those that are not held out."""
    docs = table(spark, sf_dir, "documents")
    model = train(docs.where(remainder(5) != 0))
    found = identify(docs, model, ["doc_id"])
    return found.select("doc_id", F.coalesce(remainder(5) == 0, F.lit(False)).alias("held_out"), "lang_pred", F.col("lang_score").alias("score"))
