"""Token ids in a binary store: one zstandard frame per document under a shared dictionary, with an offset index.

A store is a folder with two Parquet tables, so that Spark's committer makes writes whole or not at all on any file system:

``dictionary``  one row: dict_id (SHA-256 of the dictionary's bytes), dictionary, dtype of the ids, end id.
``blocks``      one row per up to ``BLOCK_DOCS`` documents: shard and block (rising with doc_id), dict_id, doc_ids, n_tokens,
                offsets (byte at which each document's frame begins in the payload, and the payload's end), start (ids in the
                shard before the block), tokens (ids in the block) and payload (the frames, one after the other).

A short document is read by its block's row and one frame, not by unpacking the block.
"""

from __future__ import annotations

import hashlib
import json
import os
import uuid
import zlib
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import arrow_map, only, shared_dir, table

BLOCK_DOCS = 256
BLOCK_BYTES = 4 << 20
#: The dictionary is trained on about so many documents, spread by a hash of doc_id, of at most so many characters.
SAMPLE_DOCS = 1000
SAMPLE_CHARS = 32_768
DICT_BYTES = 64 << 10
LEVEL = 3
#: Chunks whose ids a Python worker remembers; the memory is emptied when full.
CHUNKS_KEPT = 600_000
ROWS = 2048
END_ID = 2

BLOCKS = (
    "shard int, block int, dict_id string, doc_ids array<bigint>, n_tokens array<bigint>, offsets array<bigint>, start bigint, tokens bigint, payload binary"
)


class Tokens:
    """Ids of the tokenizers library, remembered by chunk.

    Byte-level merges never cross the library's pre-tokens, and a single space between two characters that are not white
    space always begins one; so a text may be cut there and each distinct chunk be encoded once, by the library itself: a
    chunk of letters by its model alone, since it is one pre-token, anything else by the whole chain. Texts in which a space
    stands beside other white space go to the library whole.
    """

    def __init__(self, spec: bytes, dtype: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import tokenizers

        self.own = tokenizers.Tokenizer.from_buffer(spec)
        self.code = {"uint16": "H", "uint32": "I"}[dtype]
        parts = json.loads(spec)
        pre = parts.get("pre_tokenizer") or {}
        #: Whether the shortcuts hold: byte-level pre-tokens by the usual pattern, and no normalizer.
        self.plain = parts.get("normalizer") is None and pre.get("type") == "ByteLevel" and pre.get("use_regex") and not pre.get("add_prefix_space")
        shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
        hidden = [b for b in range(256) if b not in shown]
        self.bytes_shown = {b: chr(b) for b in shown} | {b: chr(256 + k) for k, b in enumerate(hidden)}
        self.mark, self.model = self.bytes_shown[32], self.own.model
        self.parts: dict[str, tuple[bytes, int]] = {}
        self.spaced: dict[str, bytes] = {}  # chunks behind a space
        self.bare: dict[str, bytes] = {}

    def _library(self, text: str) -> bytes:
        return array(self.code, self.own.encode(text, add_special_tokens=False).ids).tobytes()

    def _letters(self, word: str) -> bytes:
        """One pre-token of a space and letters, or of letters, by the library's model."""
        if word.isascii():
            word = word.replace(" ", self.mark)
        else:
            word = word.encode("utf-8").decode("latin-1").translate(self.bytes_shown)
        return array(self.code, [t.id for t in self.model.tokenize(word)]).tobytes()

    def _chunk(self, chunk: str, known: dict[str, bytes], before: str) -> bytes:
        found = known.get(chunk)
        if found is not None:
            return found
        if not self.plain:
            found = self._library(before + chunk)
        elif chunk.isalpha() and (chunk.isascii() or max(chunk) < "\u0250"):
            found = self._letters(before + chunk)
        elif (core := chunk.rstrip(".,;:!?")) != chunk and core.isalpha() and max(core) < "\u0250":
            found = self._chunk(core, known, before) + self._chunk(chunk[len(core) :], self.bare, "")
        else:
            lines = chunk.split("\n")
            if len(lines) > 1 and all(lines) and not any(c.isspace() for c in "".join(lines)):
                newline = self.bare.get("\n") or self.bare.setdefault("\n", self._library("\n"))
                rest = [self._chunk(x, self.bare, "") for x in lines[1:]]
                return newline.join([self._chunk(lines[0], known, before), *rest])
            found = self._library(before + chunk)
        if len(chunk) <= 64:
            known[chunk] = found
        return found

    def encode(self, text: str | None) -> bytes:
        """The ids of the whole text as little-endian integers."""
        if not text:
            return b""
        if len(self.spaced) + len(self.bare) >= CHUNKS_KEPT // 4:
            self.spaced.clear()
            self.bare.clear()
        return self._chunks(text)

    def _part(self, part: str) -> tuple[bytes, int]:
        """Ids of a part of ``encode_all`` and marks: 1 begins with a stop, 2 ends with a letter or digit, 4 can't stand alone."""
        bare = part[1:] if part[:1] == " " else part
        if part != "\n" and bare.split(None, 1) != [bare]:
            found = b"", 4
        else:
            marks = (1 if part[0] in ",." else 0) | (2 if part[-1].isalnum() and part[-1] < "\u0250" else 0)
            letters = bare.isalpha() and (bare.isascii() or max(bare) < "\u0250")
            found = self._letters(part) if letters else self._library(part), marks
        if len(part) <= 64:
            self.parts[part] = found
        return found

    def encode_all(self, texts: pa.Array) -> list[bytes]:
        """``encode`` of each text, sharing the work on words.

        Texts are cut before each space, comma and full stop and around each newline. A cut at a single space between other
        characters, at a stop behind a letter or digit, and at a newline between other characters is one that the library makes
        too; texts with any other cut go one by one. Distinct parts are looked up once for all texts.
        """
        if not self.plain or not len(texts):
            return [self.encode(t) for t in texts.to_pylist()]
        cut = texts.fill_null("")
        alone = np.array(pc.match_substring(cut, "\0").to_pylist(), bool)
        for x in (" ", ",", "."):
            cut = pc.replace_substring(cut, x, "\0" + x)
        cut = pc.split_pattern(pc.replace_substring(cut, "\n", "\0\n\0"), "\0")
        coded = cut.flatten().dictionary_encode()
        words, index = coded.dictionary.to_pylist(), coded.indices.to_numpy()
        bounds = cut.offsets.to_numpy() - cut.offsets[0].as_py()
        if len(self.parts) >= CHUNKS_KEPT:
            self.parts.clear()
        found = list(map(self.parts.get, words))
        if None in found:
            tokenize, code, mark, parts = self.model.tokenize, self.code, self.mark, self.parts
            for k, f in enumerate(found):
                if f is None:
                    w = words[k]
                    if w.isascii() and len(w) <= 64 and w[1:].isalpha() and (w[0] == " " or w[0].isalpha()):
                        # most new parts: letters, which the model takes as they are
                        ids = tokenize(mark + w[1:] if w[0] == " " else w)
                        found[k] = parts[w] = array(code, [t.id for t in ids]).tobytes(), 2
                    else:
                        found[k] = self._part(w)
        kind = np.dtype({"H": "<u2", "I": "<u4"}[self.code])
        marks = np.array([f[1] for f in found], np.uint8)[index]
        size = np.array([len(f[0]) for f in found], np.int64) // kind.itemsize
        odd = (marks & 4) > 0
        odd[1:] |= ((marks[1:] & 1) > 0) & ((marks[:-1] & 2) == 0)
        row = np.repeat(np.arange(len(texts)), np.diff(bounds))
        alone |= np.bincount(row[odd], minlength=len(texts)) > 0
        pool = np.frombuffer(b"".join([f[0] for f in found]), kind)
        first = np.concatenate([[0], np.cumsum(size)[:-1]])
        many = size[index]
        ends = np.concatenate([[0], np.cumsum(many)])
        whole = pool[np.repeat(first[index] - ends[:-1], many) + np.arange(ends[-1])].tobytes()
        at = (ends[bounds] * kind.itemsize).tolist()
        return [self.encode(t.as_py()) if m else whole[x:y] for t, m, x, y in zip(texts, alone.tolist(), at, at[1:])]

    def _chunks(self, text: str) -> bytes:
        first, *rest = text.split(" ")
        known, at = self.spaced, -1
        out = list(map(known.get, rest))
        missing = out.count(None)
        for _ in range(missing):
            at = out.index(None, at + 1)
            chunk = rest[at]
            # a chunk that is remembered neither begins nor ends with white space
            if not chunk or chunk[0].isspace() or chunk[-1].isspace():
                return self._library(text)
            out[at] = self._chunk(chunk, known, " ")
        if not first:
            return b"".join(out)
        if first[-1].isspace():
            return self._library(text)
        return self._chunk(first, self.bare, "") + b"".join(out)


_READY: dict[tuple, Tokens] = {}


def _tokens(spec: bytes, dtype: str) -> Tokens:
    key = (hash(spec), dtype)
    if key not in _READY:
        _READY[key] = Tokens(spec, dtype)
    return _READY[key]


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def train_dictionary(docs: DataFrame, spec: bytes, dtype: str, end_id: int) -> bytes:
    """A zstandard dictionary trained on the serialized ids of a bounded sample; empty if the table is too small for one."""
    import zstandard

    n = docs.count()
    share = 1.0 if n <= SAMPLE_DOCS else SAMPLE_DOCS / n
    spot = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 32))
    sample = docs.where((spot < int(share * (1 << 32))) & (F.length("text") <= SAMPLE_CHARS)).select("text").limit(2 * SAMPLE_DOCS).collect()
    end = np.array([end_id], np.dtype(dtype).newbyteorder("<")).tobytes()
    own = Tokens(spec, dtype)
    packed = [own.encode(t) + end for t in sorted(r.text for r in sample)]
    try:
        return zstandard.train_dictionary(DICT_BYTES, packed).as_bytes()
    except zstandard.ZstdError:
        return b""


def write_store(docs: DataFrame, path: str, tokenizer: str | None = None, end_id: int = END_ID) -> None:
    """Encode every whole text and write it, in ascending doc_id order, as a store at ``path``.

    Null and empty texts: only the end id. Null doc_ids come first; rows with the same doc_id stand side by side, in the order
    of their texts. Empty table: a store without blocks. Documents are dealt by ranges of doc_id, one shuffle of doc_id and
    text; each task packs its range in order, so that only one block is held.
    """
    spark = docs.sparkSession
    with open(tokenizer or default_tokenizer(), "rb") as f:
        spec = f.read()
    import tokenizers

    dtype = "uint16" if tokenizers.Tokenizer.from_buffer(spec).get_vocab_size(with_added_tokens=True) <= 1 << 16 else "uint32"
    trained = train_dictionary(docs, spec, dtype, end_id)
    dict_id = hashlib.sha256(trained).hexdigest()
    spark.createDataFrame([(dict_id, trained, dtype, end_id)], "dict_id string, dictionary binary, dtype string, end_id long").coalesce(1).write.parquet(f"{path}/dictionary")
    sent = spark.sparkContext.broadcast((spec, trained))

    def pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard
        from pyspark import TaskContext

        only("tokens", _READY.clear)
        spec, trained = sent.value
        own = _tokens(spec, dtype)
        kind = np.dtype(dtype).newbyteorder("<")
        end = np.array([end_id], kind).tobytes()
        if trained:
            shared = zstandard.ZstdCompressionDict(trained)
            shared.precompute_compress(level=LEVEL)  # else every document would digest the dictionary anew
            press = zstandard.ZstdCompressor(level=LEVEL, dict_data=shared)
        else:
            press = zstandard.ZstdCompressor(level=LEVEL)
        shard, block, start = TaskContext.get().partitionId(), 0, 0
        ids: list[int | None] = []
        frames: list[bytes] = []
        counts: list[int] = []
        held = 0

        def full() -> pa.RecordBatch:
            offsets = np.cumsum([0, *map(len, frames)]).tolist()
            row = [[shard], [block], [dict_id], [ids], [counts], [offsets], [start], [sum(counts)], [b"".join(frames)]]
            kinds = [pa.int32(), pa.int32(), pa.string(), *[pa.list_(pa.int64())] * 3, pa.int64(), pa.int64(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(row, kinds)], [x.split()[0] for x in BLOCKS.split(", ")])

        for whole in batches:
            for at in range(0, whole.num_rows, ROWS):
                batch = whole.slice(at, ROWS)
                for i, packed in zip(batch.column(0).to_pylist(), own.encode_all(batch.column(1))):
                    packed += end
                    ids.append(i)
                    frames.append(press.compress(packed))
                    counts.append(len(packed) // kind.itemsize)
                    held += len(frames[-1])
                    if len(ids) >= BLOCK_DOCS or held >= BLOCK_BYTES:
                        yield full()
                        block, start, held = block + 1, start + sum(counts), 0
                        ids, frames, counts = [], [], []
        if ids:
            yield full()

    ordered = docs.select("doc_id", "text").repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    arrow_map(ordered, pack, BLOCKS).write.parquet(f"{path}/blocks")


def _dictionary(spark: SparkSession, path: str) -> tuple[str, bytes, str, int]:
    row = spark.read.parquet(f"{path}/dictionary").collect()[0]
    if hashlib.sha256(row.dictionary).hexdigest() != row.dict_id:
        raise ValueError("the dictionary does not match its hash")
    return row.dict_id, bytes(row.dictionary), row.dtype, row.end_id


def _opener(trained: bytes):
    import zstandard

    return zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(trained)) if trained else zstandard.ZstdDecompressor()


def read_store(spark: SparkSession, path: str, digest: bool = False) -> DataFrame:
    """All documents of a store: doc_id, start (ids of all documents before it), n_tokens, ids (array<int>).

    ``digest``: ids_crc32 (of the ids as little-endian unsigned 32-bit integers) in place of ids. The starts of the shards are
    running sums over one row per shard; every frame is unpacked by the dictionary whose hash its block names.
    """
    dict_id, trained, dtype, _ = _dictionary(spark, path)
    blocks = spark.read.schema(BLOCKS).parquet(f"{path}/blocks")
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    # one row per shard, that is per task of the writing stage
    base = blocks.groupBy("shard").agg(F.sum("tokens").alias("all")).select("shard", F.coalesce(F.sum("all").over(before), F.lit(0)).alias("base"))
    sent = spark.sparkContext.broadcast(trained)

    def unpack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opener = _opener(sent.value)
        kind = np.dtype(dtype).newbyteorder("<")
        for batch in batches:
            for row in batch.to_pylist():
                if row["dict_id"] != dict_id:
                    raise ValueError("a block was written with another dictionary")
                payload, offsets, counts = row["payload"], row["offsets"], row["n_tokens"]
                starts = row["base"] + row["start"] + np.cumsum([0, *counts])[:-1]
                got = [np.frombuffer(opener.decompress(payload[a:b]), kind) for a, b in zip(offsets, offsets[1:])]
                if [len(x) for x in got] != counts:
                    raise ValueError("a frame does not hold as many ids as the index says")
                first = [pa.array(row["doc_ids"], pa.int64()), pa.array(starts, pa.int64()), pa.array(counts, pa.int64())]
                if digest:
                    last = pa.array([zlib.crc32(x.astype("<u4").tobytes()) for x in got], pa.int64())
                else:
                    last = pa.array([x.astype(np.int32) for x in got], pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([*first, last], ["doc_id", "start", "n_tokens", "ids_crc32" if digest else "ids"])

    out = "doc_id bigint, start bigint, n_tokens bigint, " + ("ids_crc32 bigint" if digest else "ids array<int>")
    return arrow_map(blocks.join(F.broadcast(base), "shard"), unpack, out)


def fetch(spark: SparkSession, path: str, doc_id: int) -> list[np.ndarray]:
    """The ids of one document (of each row with that doc_id), reading one frame each."""
    _, trained, dtype, _ = _dictionary(spark, path)
    blocks = spark.read.schema(BLOCKS).parquet(f"{path}/blocks").where(F.array_contains("doc_ids", doc_id))
    spot = F.explode(F.filter(F.sequence(F.lit(0), F.size("doc_ids") - 1), lambda i: F.get("doc_ids", i) == doc_id)).alias("i")
    cut = blocks.select(spot, "offsets", "payload").select(
        F.expr("substring(payload, int(offsets[i]) + 1, int(offsets[i + 1] - offsets[i]))").alias("frame")
    )
    opener = _opener(trained)
    return [np.frombuffer(opener.decompress(bytes(r.frame)), np.dtype(dtype).newbyteorder("<")) for r in cut.collect()]


def op7_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents' ids, written as a store and read back; ``write_store`` and ``read_store`` tell what odd rows give."""
    path = f"{shared_dir(spark)}/tidemark/tokens-{uuid.uuid4().hex}"
    write_store(table(spark, sf_dir, "documents"), path)
    return read_store(spark, path, digest=True)
