"""SentencePiece merge-type encoding by backtracking, and decoding."""

from __future__ import annotations

import heapq
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from tidemark.llm.common import arrow_map, only, table, unused

SPACE = "▁"
#: Words whose ids a Python worker remembers; the memory is emptied when full.
WORDS_KEPT = 300_000
PAIRS_KEPT = 500_000
#: Characters without a piece count as ids from here on.
CHAR = 1 << 19
ROWS = 256


class PieceEncoder:
    """Ids as the sentencepiece library gives them for a merge-type model with identity normalization, and back.

    A text is cut before each space mark that follows another character: no piece of the vocabulary holds a mark behind
    another character (checked when the model is read), so no merge crosses such a cut. Each unit is encoded by
    backtracking: an Aho-Corasick automaton gives all pieces that match at each position, longest first; a piece is taken if
    re-merging it with the piece before gives back the same two pieces; a position from which nothing fits is marked in a
    bitfield and not tried again. Units with runs of spaces, whose pieces share one score so that ties count, are merged
    pair by pair. Characters without a piece become byte pieces.
    """

    def __init__(self, model: bytes):
        import ahocorasick
        import sentencepiece

        own = sentencepiece.SentencePieceProcessor(model_proto=model)
        size = own.get_piece_size()
        plain = [i for i in range(size) if not (own.is_control(i) or own.is_unknown(i) or own.is_byte(i) or own.is_unused(i))]
        self.ids = {own.id_to_piece(i): i for i in plain}
        self.score = {own.id_to_piece(i): own.get_score(i) for i in plain}
        if any(SPACE in p.lstrip(SPACE) for p in self.ids):
            raise ValueError("a piece holds a space mark behind another character")
        self.unknown = own.unk_id()
        self.byte_ids = [own.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.byte_of = {i: b for b, i in enumerate(self.byte_ids) if own.is_byte(i)}
        self.surface = [""] * size
        for i in plain:
            self.surface[i] = own.id_to_piece(i).replace(SPACE, " ")
        self.surface[self.unknown] = " ⁇ "
        self.machine = ahocorasick.Automaton()
        for p in self.ids:
            self.machine.add_word(p, (len(p) - 1, self.ids[p]))
        self.machine.make_automaton()
        self.piece = [own.id_to_piece(i) for i in range(size)]
        self.pairs: dict[int, bool] = {}
        self.words: dict[str, bytes] = {}

    def merged(self, unit: str) -> list[str]:
        """Pieces by merging the best-scored adjacent pair first, the leftmost of equals."""
        n = len(unit)
        part: list[str | None] = list(unit)
        left, right = list(range(-1, n - 1)), [*range(1, n), -1]
        score, queue = self.score, []

        def offer(i: int, j: int) -> None:
            if i >= 0 and j >= 0:
                both = part[i] + part[j]
                if both in score:
                    heapq.heappush(queue, (-score[both], i, j, both))

        for i in range(n - 1):
            offer(i, i + 1)
        while queue:
            _, i, j, both = heapq.heappop(queue)
            if part[i] is None or part[j] is None or right[i] != j or part[i] + part[j] != both:
                continue
            part[i], part[j] = both, None
            right[i] = right[j]
            if right[j] >= 0:
                left[right[j]] = i
            offer(left[i], i)
            offer(i, right[i])
        return [p for p in part if p is not None]

    def fits(self, first: int, second: int) -> bool:
        """Whether the two pieces stay apart, and whole, when their text is merged anew; ``first`` 0: the piece alone."""
        if len(self.pairs) >= PAIRS_KEPT:
            self.pairs.clear()
        name = self.name
        parts = [name(second)] if not first else [name(first), name(second)]
        known = self.pairs[first << 21 | second] = self.merged("".join(parts)) == parts
        return known

    def name(self, i: int) -> str:
        """Text of a piece, or of a character without one, which counts as ``CHAR`` plus its code point."""
        return self.piece[i] if i < CHAR else chr(i - CHAR)

    def backtracked(self, unit: str) -> list[int]:
        """Ids of one unit; a character without a piece is ``CHAR`` plus its code point."""
        n = len(unit)
        ways: list[list[tuple[int, int]]] = [[] for _ in range(n)]
        for end, (size, i) in self.machine.iter(unit):
            ways[end - size].append((end + 1, i))
        pairs, fits = self.pairs, self.fits
        failed, at, before, tries = 0, 0, 0, ways[0]
        taken: list[tuple[int, int, list[tuple[int, int]]]] = []  # id, start and the shorter ways left there
        if not tries or tries[0][0] != 1:
            tries.insert(0, (1, CHAR + ord(unit[0])))
        tries = tries[:]
        while True:
            while tries:
                end, i = tries.pop()
                if failed and failed >> end & 1:
                    continue
                if not before and end < n:  # a first piece is checked together with its successor
                    break
                good = pairs.get(before << 21 | i)
                if good or good is None and fits(before, i):
                    break
            else:
                failed |= 1 << at
                _, at, tries = taken.pop()
                before = taken[-1][0] if taken else 0
                continue
            taken.append((i, at, tries))
            if end == n:
                return [t[0] for t in taken]
            before, at, tries = i, end, ways[end]
            if not tries or tries[0][0] != at + 1:
                tries.insert(0, (at + 1, CHAR + ord(unit[at])))
            tries = tries[:]

    def unit_ids(self, unit: str) -> list[int]:
        if SPACE * 2 in unit:
            found = [self.ids.get(p, -1 if len(p) > 1 else CHAR + ord(p)) for p in self.merged(unit)]
        else:
            found = self.backtracked(unit)
        if max(found) < CHAR:
            return found
        out: list[int] = []
        for i in found:
            if i < CHAR:
                out.append(i)
            else:
                out.extend(self.byte_ids[b] for b in chr(i - CHAR).encode("utf-8"))
        return out

    def _word(self, unit: str) -> bytes:
        packed = array("i", self.unit_ids(unit)).tobytes()
        if len(unit) <= 64:
            if len(self.words) >= WORDS_KEPT:
                self.words.clear()
            self.words[unit] = packed
        return packed

    def encode(self, text: str) -> np.ndarray:
        """Ids (int32) of the whole text, without begin or end ids."""
        if not text:
            return np.empty(0, np.int32)
        known, make = self.words.get, self._word
        units = text.replace(SPACE, " ").split(" ")
        if "" not in units:
            return np.frombuffer(b"".join([known(SPACE + u) or make(SPACE + u) for u in units]), np.int32)
        out, marks = [], SPACE
        for u in units:
            if u:
                key = marks + u
                out.append(known(key) or make(key))
                marks = SPACE
            else:
                marks += SPACE
        if len(marks) > 1:  # spaces at the end
            out.append(make(marks[1:]))
        return np.frombuffer(b"".join(out), np.int32)

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids: pieces joined, marks as spaces, the one put in front gone, runs of byte pieces as UTF-8."""
        if not len(ids):
            return ""
        listed = ids.tolist()
        if self.byte_of and (np.isin(ids, self._bytes_array())).any():
            out, run = [], bytearray()
            for i in listed:
                b = self.byte_of.get(i)
                if b is not None:
                    run.append(b)
                    continue
                if run:
                    out.append(_utf8(bytes(run)))
                    run.clear()
                out.append(self.surface[i])
            out.append(_utf8(bytes(run)))
            text = "".join(out)
            return text[1:] if listed[0] not in self.byte_of and text[:1] == " " else text
        text = "".join(map(self.surface.__getitem__, listed))
        return text[1:] if text[:1] == " " else text

    def _bytes_array(self) -> np.ndarray:
        if not hasattr(self, "_bytes"):
            self._bytes = np.array(sorted(self.byte_of), np.int32)
        return self._bytes


def _utf8(run: bytes) -> str:
    """Each byte that is part of no character becomes one replacement character."""
    try:
        return run.decode("utf-8")
    except UnicodeDecodeError:
        out, at = [], 0
        while at < len(run):
            for size in (1, 2, 3, 4):
                try:
                    out.append(run[at : at + size].decode("utf-8"))
                    at += size
                    break
                except UnicodeDecodeError:
                    continue
            else:
                out.append("�")
                at += 1
        return "".join(out)


_READY: dict[int, PieceEncoder] = {}


def _encoder(model: bytes) -> PieceEncoder:
    key = hash(model)
    if key not in _READY:
        _READY[key] = PieceEncoder(model)
    return _READY[key]


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def tokenize(docs: DataFrame, model_path: str | None = None, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns, ids (array<int>) and decoded (string) for each row; null and empty texts have no ids and decode to ''.

    The model file is read on the driver and sent to the workers (half a megabyte). A projection: no shuffle, texts of any
    length whole, memory bounded by a batch of ``ROWS`` texts and the worker's word memory. Repeated rows and rows without
    doc_id are encoded like any other; columns not in ``keep`` are left out, so none clashes. Empty table: no rows.
    """
    spark = docs.sparkSession
    with open(model_path or default_model(), "rb") as f:
        sent = spark.sparkContext.broadcast(f.read())
    source = docs.select(*keep, F.col(text).alias(unused(list(keep), "text_")))
    schema = StructType([*source.select(*keep).schema.fields, StructField("ids", ArrayType(IntegerType())), StructField("decoded", StringType())])
    names = list(keep)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        only("pieces", _READY.clear)
        own = _encoder(sent.value)
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS):
                batch = whole.slice(at, ROWS)
                ids = [own.encode(t or "") for t in batch.column(len(names)).to_pylist()]
                ends = np.zeros(len(ids) + 1, np.int32)
                np.cumsum([len(x) for x in ids], out=ends[1:])
                lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(ids) if ids else np.empty(0, np.int32)))
                texts = pa.array([own.decode(x) for x in ids], pa.string())
                yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), lists, texts], [*names, "ids", "decoded"])

    return arrow_map(source, run, schema)


def digests(tokens: DataFrame) -> DataFrame:
    """Adds n_tokens, ids_sha256 and decoded_sha256, and drops ids and decoded."""
    joined = F.concat_ws(",", F.col("ids").cast("array<string>"))
    return tokens.select(
        *[c for c in tokens.columns if c not in ("ids", "decoded")],
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(joined.cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``tokenize`` and ``digests`` of the whole texts of all documents, which tell what odd rows give."""
    return digests(tokenize(table(spark, sf_dir, "documents")))
