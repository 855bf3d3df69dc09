"""Inputs of the risk models: categorical levels, text components, pooled embeddings."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import PCA, RegexTokenizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import ship_package
from tidemark.staging import pinned, unpin

#: Columns that are never inputs.
NOT_INPUTS = frozenset("nct_id trial_id label label_enrollment label_safety split start_date end_date text status completion_date sponsor_name stop_reason brief_title sponsor".split())


def inputs(df: DataFrame, drop: tuple[str, ...] = ()) -> list[str]:
    return [c for c in df.columns if c not in NOT_INPUTS and c not in drop]


def kinds(df: DataFrame, columns: list[str]) -> tuple[list[str], list[str]]:
    """Numeric (booleans too) and categorical columns."""
    words = [c for c in columns if dict(df.dtypes)[c] == "string"]
    return [c for c in columns if c not in words], words


#: A column with more levels is no category: the levels come to the driver.
MOST_LEVELS = 10_000


def learned_levels(df: DataFrame, columns: list[str]) -> dict[str, list[str]]:
    """Levels of each categorical column, with 'missing' for null; an error if a column has more than ``MOST_LEVELS``."""
    many = df.agg(*[F.count_distinct(c).alias(c) for c in columns]).first() if columns else {}
    wide = [c for c in columns if many[c] > MOST_LEVELS]
    if wide:
        raise ValueError(f"more than {MOST_LEVELS} levels: {', '.join(wide)}")
    row = df.agg(*[F.array_sort(F.collect_set(F.coalesce(c, F.lit("missing")))).alias(c) for c in columns]).first() if columns else {}
    return {c: list(row[c]) for c in columns}


def leveled(df: DataFrame, levels: dict[str, list[str]]) -> DataFrame:
    """Null is the level 'missing'; a level that was not learned is null."""
    out = df
    for c, known in levels.items():
        word = F.coalesce(F.col(c), F.lit("missing"))
        out = out.withColumn(c, F.when(word.isin(known), word))
    return out


#: Vectors of a block of the search for components, most vectors of all blocks, when it ends; slices in which a block is summed.
BLOCK, MOST_VECTORS, SETTLED, SLICES = 16, 1280, 1e-7, 32
#: Texts whose weights are spread over all components at a time, and words that a task counts before it hands them on.
CHUNK, COUNTED = 64, 2_000_000


def placed(words: pa.Array, ends: np.ndarray) -> tuple[np.ndarray, pa.Array, np.ndarray, np.ndarray]:
    """Of the words of texts, one after another, that end at ``ends``: each one's text, distinct words, each one's number among these, and
    the places of words that another follows in the same text."""
    coded = words.dictionary_encode()
    text = np.repeat(np.arange(len(ends)), np.diff(ends, prepend=0))
    return text, coded.dictionary, coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), np.flatnonzero(text[1:] == text[:-1])


def counted_terms(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """term, n and df of texts given by their words, summed over some ``COUNTED`` words of a task."""

    def told(chunk: pa.ChunkedArray) -> pa.RecordBatch:
        lists = chunk.combine_chunks()
        text, words, ids, first = placed(lists.flatten(), np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False)))
        size = len(words) + 1
        code = np.concatenate([ids * size, ids[first] * size + ids[first + 1] + 1])  # a word, or a pair of words
        order = np.lexsort([np.concatenate([text, text[first]]), code])
        code, text = code[order], np.concatenate([text, text[first]])[order]
        begin = np.flatnonzero(np.diff(code, prepend=-1))
        df = np.add.reduceat((np.diff(code, prepend=-1) != 0) | (np.diff(text, prepend=-1) != 0), begin, dtype=np.int64) if len(begin) else begin
        a, b = words.take(pa.array(code[begin] // size)), pa.array(code[begin] % size - 1)
        term = pc.if_else(pc.less(b, 0), a, pc.binary_join_element_wise(a, words.take(pc.max_element_wise(b, 0)), " "))
        return pa.RecordBatch.from_arrays([term, pa.array(np.diff(begin, append=len(code))), pa.array(df)], ["term", "n", "df"])

    kept, size = [], 0
    for batch in batches:
        kept, size = [*kept, batch.column(0)], size + len(batch.column(0).flatten())
        if size >= COUNTED:
            yield told(pa.chunked_array(kept))
            kept, size = [], 0
    if size:
        yield told(pa.chunked_array(kept))


class Vocabulary:
    """Terms by number, looked up for all words of a batch at once."""

    def __init__(self, terms: list[str]):
        cut = [t.split(" ") for t in terms]  # a word holds no space
        words = {w: k for k, w in enumerate(dict.fromkeys(w for ws in cut for w in ws))}
        code = np.array([words[ws[0]] * (len(words) + 1) + (words[ws[1]] + 1 if len(ws) > 1 else 0) for ws in cut], np.int64)
        self.words, self.number = list(words), np.argsort(code)
        self.code = code[self.number]

    def found(self, lists) -> tuple[np.ndarray, np.ndarray]:
        """(text, term) of each occurrence of a known term."""
        text, words, ids, first = placed(pa.array([w for ws in lists for w in ws], pa.string()), np.cumsum([len(x) for x in lists], dtype=np.int64))
        known = pc.fill_null(pc.index_in(words, value_set=pa.array(self.words)), -1).to_numpy(zero_copy_only=False).astype(np.int64)
        ids, size = known[ids] if len(known) else ids, len(self.words) + 1
        both = first[(ids[first] >= 0) & (ids[first + 1] >= 0)]
        code, text = np.concatenate([ids * size, ids[both] * size + ids[both + 1] + 1]), np.concatenate([text, text[both]])
        at = np.minimum(np.searchsorted(self.code, code), len(self.code) - 1)
        hit = self.code[at] == code
        return text[hit], self.number[at[hit]]


def term_weights(lists, known: Vocabulary, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, term, weight) of the known terms of texts, in that order: (1 + log tf) * idf, each text of unit length."""
    row, term = known.found(lists)
    key, tf = np.unique(row * len(idf) + term, return_counts=True)
    row, term = key // len(idf), key % len(idf)
    weight = (1.0 + np.log(tf)) * idf[term]
    return row, term, weight / np.sqrt(np.bincount(row, weight * weight, len(lists)))[row]


def spread(row: np.ndarray, term: np.ndarray, weight: np.ndarray, texts: int, v: np.ndarray) -> np.ndarray:
    """(texts, components): weights times the rows of ``v``."""
    out = np.zeros((texts, v.shape[1]))
    for a in range(0, texts, CHUNK):
        lo, hi = np.searchsorted(row, [a, a + CHUNK])
        if hi > lo:
            begin = np.flatnonzero(np.r_[True, row[lo + 1 : hi] != row[lo : hi - 1]])
            out[row[lo:hi][begin]] = np.add.reduceat(weight[lo:hi, None] * v[term[lo:hi]], begin)
    return out


def right_vectors(rows: DataFrame, terms: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The first k right singular vectors (terms x k) and singular values of sparse ``rows`` (term and weight as bytes of int32 and double).

    A block Lanczos method: every pass over the rows multiplies a narrow block of vectors by the rows and by their transpose, inside
    the tasks; the driver holds all blocks, which depend on the vocabulary and not on the number of rows. It ends when every
    residual is ``SETTLED`` of the largest value, so the vectors are those of an exact decomposition.
    """
    block = np.linalg.qr(np.random.default_rng(0).normal(size=(terms, min(terms, BLOCK))))[0]
    basis, inner = np.empty((terms, 0)), np.empty((0, 0))
    while True:
        image, old = _gram_times(rows, block), basis.shape[1]
        basis = np.concatenate([basis, block], axis=1)
        new = basis.T @ image
        inner = np.block([[inner, new[:old]], [new[:old].T, (new[old:] + new[old:].T) / 2]])
        values, turn = np.linalg.eigh(inner)
        values, turn = values[::-1][:k], turn[:, ::-1][:, :k]
        for _ in range(2):
            image = image - basis @ (basis.T @ image)
        block, size = np.linalg.qr(image)
        more = np.abs(np.diag(size)) > 1e-10 * max(values[0], 1e-300)
        if basis.shape[1] >= k and (np.linalg.norm(size @ turn[old:], axis=0).max() <= SETTLED * max(values[0], 1e-300) or basis.shape[1] >= MOST_VECTORS):
            break
        block = block[:, more]
        if not more.all():  # the rows span little more: go on from other vectors
            fill = np.random.default_rng(basis.shape[1]).normal(size=(terms, min(terms - basis.shape[1], BLOCK) - block.shape[1]))
            known = np.concatenate([basis, block], axis=1)
            for _ in range(2):
                fill = fill - known @ (known.T @ fill)
            block = np.concatenate([block, np.linalg.qr(fill)[0]], axis=1)
        if not block.shape[1]:
            break
    return basis @ turn, np.sqrt(np.maximum(values, 0))


def _gram_times(rows: DataFrame, block: np.ndarray) -> np.ndarray:
    """Rows transposed, times rows, times ``block``: summed per task, then per slice of the terms over the tasks."""
    context = ship_package(rows.sparkSession).sparkContext
    sent = context.broadcast(block)

    def multiplied(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = sent.value
        total = np.zeros_like(v)
        for batch in batches:
            for term, weight in zip(batch.column(0), batch.column(1)):
                term, weight = np.frombuffer(term.as_buffer(), np.int32), np.frombuffer(weight.as_buffer())
                total[term] += np.multiply.outer(weight, weight @ v[term])  # a text has a term once
        parts = np.array_split(total, SLICES)
        yield pa.RecordBatch.from_arrays([pa.array(range(SLICES)), pa.array([x.tobytes() for x in parts], pa.binary())], ["slice", "x"])

    def added(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for at, x in zip(batch.column(0).to_pylist(), batch.column(1)):
                total[at] = total.get(at, 0.0) + np.frombuffer(x.as_buffer())
        if total:
            yield pa.RecordBatch.from_arrays([pa.array(list(total)), pa.array([x.tobytes() for x in total.values()], pa.binary())], ["slice", "x"])

    # as many sums as tasks run at once, whatever the number of files
    parts = rows.coalesce(context.defaultParallelism).mapInArrow(multiplied, "slice bigint, x binary").repartition("slice")
    found = dict(parts.mapInArrow(added, "slice bigint, x binary").collect())  # a block
    sent.unpersist()
    return np.concatenate([np.frombuffer(found[at]).reshape(-1, block.shape[1]) for at in range(SLICES)]) if found else np.zeros_like(block)


class TextComponents:
    """TF-IDF of one- and two-word terms (sublinear, smoothed, unit length), then an exact SVD of the fitted rows."""

    def __init__(self, components: int = 64, min_df: int = 20, terms: int = 50_000):
        self.components, self.min_df, self.terms = components, min_df, terms

    def _words(self, texts: DataFrame) -> DataFrame:
        return RegexTokenizer(inputCol="text", outputCol="w_", pattern=r"\b\w\w+\b", gaps=False, toLowercase=True).transform(texts.withColumn("text", F.coalesce("text", F.lit(""))))

    def fit(self, texts: DataFrame) -> TextComponents:
        ship_package(texts.sparkSession)
        words = self._words(texts.select("text")).select("w_")
        held = words.mapInArrow(counted_terms, "term string, n bigint, df bigint").groupBy("term").agg(F.sum("n").alias("n"), F.sum("df").alias("df"))
        kept = held.where(F.col("df") >= self.min_df).orderBy(F.desc("n"), "term").limit(self.terms).collect()  # ties by the term: the same on every run
        if not kept:
            raise ValueError(f"no term is in {self.min_df} texts")
        self.known = {r.term: k for k, r in enumerate(kept)}
        self.idf = np.log((1.0 + texts.count()) / (1.0 + np.array([r.df for r in kept]))) + 1.0
        sent = texts.sparkSession.sparkContext.broadcast((Vocabulary(list(self.known)), self.idf))

        @F.pandas_udf("term binary, weight binary")
        def weighted(lists: pd.Series) -> pd.DataFrame:
            row, term, weight = term_weights(lists, *sent.value)
            ends = np.searchsorted(row, np.arange(len(lists) + 1))
            made = [(term[a:b].astype(np.int32).tobytes(), weight[a:b].tobytes()) for a, b in zip(ends, ends[1:])]
            return pd.DataFrame(made, columns=["term", "weight"])

        rows = pinned(words.select(weighted("w_").alias("w")).select("w.*").where(F.length("term") > 0))
        v, self.values = right_vectors(rows, len(self.idf), max(1, min(self.components, len(self.idf) - 1)))
        unpin(rows)
        sign = np.sign(v[np.abs(v).argmax(axis=0), np.arange(v.shape[1])])  # a sign that does not depend on row order
        self.v = v * np.where(sign == 0, 1, sign)
        return self

    def transform(self, texts: DataFrame) -> DataFrame:
        """``texts`` with txt_0 ... txt_{k-1}, in batches: what is sent is the vocabulary and its components."""
        sent = ship_package(texts.sparkSession).sparkContext.broadcast((Vocabulary(list(self.known)), self.idf, self.v))

        @F.pandas_udf("array<double>")
        def projected(lists: pd.Series) -> pd.Series:
            known, idf, v = sent.value
            return pd.Series(list(spread(*term_weights(lists, known, idf), len(lists), v)))

        out = self._words(texts).withColumn("p_", projected("w_"))
        return out.select(*texts.columns, *[F.col("p_")[k].alias(f"txt_{k}") for k in range(self.v.shape[1])])


def windows(ids: list[int], window: int = 510, most: int = 4) -> list[list[int]]:
    return [ids[k : k + window] for k in range(0, min(len(ids), window * most), window)]


def pooled(vectors: DataFrame, id: str, vector: str, length: str) -> DataFrame:
    """One unit vector per id: the mean of its windows' vectors, weighted by their lengths."""
    long = vectors.select(id, length, F.posexplode(vector).alias("i", "x"))
    mean = long.groupBy(id, "i").agg((F.sum(F.col("x") * F.col(length)) / F.sum(length)).alias("x"))
    size = F.sqrt(F.aggregate("v_", F.lit(0.0), lambda a, x: a + x * x))
    out = mean.groupBy(id).agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "x"))), lambda s: s["x"]).alias("v_"))
    return out.select(id, F.transform("v_", lambda x: x / F.nullif(size, F.lit(0.0))).alias("embedding"))


def components_of(vectors: DataFrame, vector: str, k: int = 64) -> tuple[PipelineModel, DataFrame]:
    """Principal components of an array column, as emb_0 ..."""
    from pyspark.ml.functions import array_to_vector, vector_to_array

    prepared = vectors.withColumn("v_", array_to_vector(F.transform(vector, lambda x: x.cast("double"))))
    model = Pipeline(stages=[PCA(k=k, inputCol="v_", outputCol="c_")]).fit(prepared)
    out = model.transform(prepared).withColumn("a_", vector_to_array("c_"))
    return model, out.select(*vectors.columns, *[F.col("a_")[j].alias(f"emb_{j}") for j in range(k)])


