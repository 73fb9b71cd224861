"""Token-id files: shards of separately compressed id arrays with a shared dictionary.

Documents are range-partitioned and sorted by ``doc_id``, encoded with the
``tokenizers`` library, closed with an end id, and packed into shards. A shard is
one row of a Parquet table in the target folder, so that Spark's commit protocol
covers lost executors and any store that Spark reaches will do: the ids of its
documents, a byte offset for each, and their zstandard frames one after the
other. All frames use one dictionary trained on serialized id arrays of a bounded
sample; its bytes lie beside the shards and each shard names its SHA-256.

Ids are little-endian, two bytes each where the vocabulary allows it, else four.

Defined results: a null text counts as empty (the end id alone); a null
``doc_id`` sorts first; rows with the same ``doc_id`` follow each other in the
order of their texts; an empty table gives an empty file; extra columns are
ignored, whatever their names; a text of any length is one frame.
"""

from __future__ import annotations

import hashlib
import json
import zlib
from array import array
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bpe import _MEMO, encode_batch, tokenizer_file
from .shared import shuffle_partitions

#: About so many slices (expected) of so many ids, drawn from all of the texts, train the dictionary.
SLICES, SLICE_IDS, DICT_BYTES = 1000, 4096, 64 << 10
SHARD_DOCS, SHARD_BYTES, LEVEL = 512, 4 << 20, 3
_SHARD = "part int, shard int, base long, n_ids long, dict_sha256 string, width int, doc_ids array<long>, frame_offsets array<long>, frames binary"


@dataclass(frozen=True)
class Encoder:
    """Encodes pre-tokens, or whole texts where only that gives what the library gives."""

    size: int
    special: tuple[str, ...]
    words: Callable[[list[str]], list[bytes]] | None
    texts: Callable[[list[str]], list[bytes]]


def _byte_signs() -> dict[int, str]:
    """Latin-1 characters to the signs of the byte-level alphabet: printable bytes stand for themselves, others follow from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(0x100 + i) for i, b in enumerate(rest)}


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    from tokenizers import Tokenizer

    file = tokenizer_file(path)
    tokenizer = Tokenizer.from_file(file)
    with open(file, encoding="utf-8") as f:
        said = json.load(f)
    plain = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}
    by_word = said["normalizer"] is None and {k: v for k, v in said["pre_tokenizer"].items() if k in plain} == plain and said["model"]["type"] == "BPE" and not said["model"]["dropout"]
    by_word = by_word and not any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in said["added_tokens"])
    special = {t["content"]: np.array([t["id"]], "<u4").tobytes() for t in said["added_tokens"]}
    signs, tokenize = _byte_signs(), tokenizer.model.tokenize

    def words(pieces: list[str]) -> list[bytes]:
        return [special.get(w) or array("I", [t.id for t in tokenize(w.encode().decode("latin-1").translate(signs))]).tobytes() for w in pieces]

    def texts(whole: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in tokenizer.encode_batch_fast(whole, add_special_tokens=False)]

    return Encoder(tokenizer.get_vocab_size(), tuple(special), words if by_word else None, texts)


def _ids(column: pa.Array, path: str) -> Iterator[np.ndarray]:
    """Ids of each text. The library's model sees each distinct pre-token once; added tokens count as in the library's own call."""
    e = encoder(path)
    if e.words is None:
        for text in column.to_pylist():
            yield np.frombuffer(e.texts([text or ""])[0], "<u4")
        return
    for first, last, ids, tops in encode_batch(column, e.words, _MEMO.setdefault(path, {}), e.special):
        for i in range(last - first):
            yield ids[tops[i] : tops[i + 1]]


def _width(path: str, end_id: int) -> int:
    return 2 if max(encoder(path).size, end_id + 1) <= 1 << 16 else 4


def _dictionary(data: bytes) -> zstandard.ZstdCompressionDict | None:
    return zstandard.ZstdCompressionDict(data) if data else None


def train_dictionary(docs: DataFrame, tokenizer_path: str, end_id: int) -> bytes:
    """Dictionary bytes; empty where the sample is too small to train one."""
    text = F.coalesce("text", F.lit(""))
    slices = F.floor(F.octet_length(text) / (4 * SLICE_IDS)) + 1
    every = docs.agg(F.sum(slices)).first()[0] or 1
    # a longer text is drawn more often in its proportion, and gives one slice at a random place
    some = docs.filter(F.rand(29) < slices * (SLICES / every)).select(text.alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kind, found = f"<u{_width(tokenizer_path, end_id)}", []
            for ids in _ids(batch.column("text"), tokenizer_path):
                ids = np.append(ids, end_id).astype(kind)
                at = zlib.crc32(ids) % -(-len(ids) // SLICE_IDS) * SLICE_IDS
                found.append(ids[at : at + SLICE_IDS].tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.binary())], ["ids"])

    samples = [bytes(r["ids"]) for r in some.mapInArrow(run, "ids binary").collect()]
    try:
        return zstandard.train_dictionary(DICT_BYTES, sorted(samples)).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b""


def write_token_files(docs: DataFrame, path: str, tokenizer_path: str, end_id: int) -> None:
    """Write the shards under ``path/shards`` and the dictionary under ``path/dictionary``."""
    spark = docs.sparkSession
    trained = train_dictionary(docs, tokenizer_path, end_id)
    sha = hashlib.sha256(trained).hexdigest()
    spark.createDataFrame([(sha, bytearray(trained))], "dict_sha256 string, data binary").coalesce(1).write.parquet(f"{path}/dictionary")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, shard, base, width = TaskContext.get().partitionId(), 0, 0, _width(tokenizer_path, end_id)
        d = _dictionary(trained)
        packer = zstandard.ZstdCompressor(level=LEVEL, dict_data=d) if d else zstandard.ZstdCompressor(level=LEVEL)
        docs_, frames, n, size = [], [], 0, 0

        def flush() -> pa.RecordBatch:
            offsets = np.concatenate([[0], np.cumsum([len(f) for f in frames])]).tolist()
            row = {"part": part, "shard": shard, "base": base, "n_ids": n, "dict_sha256": sha, "width": width, "doc_ids": docs_, "frame_offsets": offsets, "frames": b"".join(frames)}
            return pa.RecordBatch.from_pylist([row], schema=_arrow_shard())

        for batch in batches:
            for doc, ids in zip(batch.column("doc_id").to_pylist(), _ids(batch.column("text"), tokenizer_path), strict=True):
                frame = packer.compress(np.append(ids, end_id).astype(f"<u{width}").tobytes())
                docs_.append(doc)
                frames.append(frame)
                n += len(ids) + 1
                size += len(frame)
                if len(docs_) >= SHARD_DOCS or size >= SHARD_BYTES:
                    yield flush()
                    shard, base, n, size, docs_, frames = shard + 1, base + n, 0, 0, [], []
        if docs_:
            yield flush()

    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
    # the splitters are sampled from the plain scan; encoding comes after the shuffle and runs once
    rows.repartitionByRange(shuffle_partitions(spark), "doc_id").sortWithinPartitions("doc_id", "text").mapInArrow(pack, _SHARD).write.parquet(f"{path}/shards")


def _arrow_shard() -> pa.Schema:
    return pa.schema([("part", pa.int32()), ("shard", pa.int32()), ("base", pa.int64()), ("n_ids", pa.int64()), ("dict_sha256", pa.string()), ("width", pa.int32()), ("doc_ids", pa.list_(pa.int64())), ("frame_offsets", pa.list_(pa.int64())), ("frames", pa.binary())])


def read_dictionary(spark: SparkSession, path: str) -> tuple[str, bytes]:
    row = spark.read.parquet(f"{path}/dictionary").first()
    data = bytes(row["data"])
    if hashlib.sha256(data).hexdigest() != row["dict_sha256"]:
        raise ValueError("the dictionary does not match its hash")
    return row["dict_sha256"], data


def _frames(batch: pa.RecordBatch, sha: str, opener: zstandard.ZstdDecompressor, only: set | None = None) -> Iterator[tuple[int, int, np.ndarray | None]]:
    """Row number, doc_id and ids of each document; frames of others stay packed."""
    for r in range(batch.num_rows):
        if batch.column("dict_sha256")[r].as_py() != sha:
            raise ValueError("a shard was packed with another dictionary")
        at, frames, width = batch.column("frame_offsets")[r].as_py(), batch.column("frames")[r].as_buffer(), batch.column("width")[r].as_py()
        view = memoryview(frames)
        for k, doc in enumerate(batch.column("doc_ids")[r].as_py()):
            if only is None or doc in only:
                yield r, doc, np.frombuffer(opener.decompress(view[at[k] : at[k + 1]]), f"<u{width}").astype("<u4")


def _opener(data: bytes) -> zstandard.ZstdDecompressor:
    d = _dictionary(data)
    return zstandard.ZstdDecompressor(dict_data=d) if d else zstandard.ZstdDecompressor()


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of each document, from the files."""
    sha, data = read_dictionary(spark, path)
    shards = spark.read.parquet(f"{path}/shards")
    sums = sorted((r["part"], r["n"]) for r in shards.groupBy("part").agg(F.sum("n_ids").alias("n")).collect())  # a row for each write task
    starts, total = {}, 0
    for part, n in sums:
        starts[part] = total
        total += n

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opener = _opener(data)
        for batch in batches:
            docs, start, n, crc = [], [], [], []
            at, row = 0, -1
            for r, doc, ids in _frames(batch, sha, opener):
                if r != row:
                    at, row = starts[batch.column("part")[r].as_py()] + batch.column("base")[r].as_py(), r
                docs.append(doc)
                start.append(at)
                n.append(len(ids))
                crc.append(zlib.crc32(ids))
                at += len(ids)
            yield pa.RecordBatch.from_arrays([pa.array(docs, pa.int64()), pa.array(start, pa.int64()), pa.array(n, pa.int64()), pa.array(crc, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])

    return shards.select("part", "base", "dict_sha256", "width", "doc_ids", "frame_offsets", "frames").mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def read_token_ids(spark: SparkSession, path: str, doc_ids: list[int]) -> DataFrame:
    """``doc_id, ids`` of a few documents: only their frames are unpacked."""
    sha, data = read_dictionary(spark, path)
    wanted = set(doc_ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opener = _opener(data)
        for batch in batches:
            found = [(doc, ids.tolist()) for _, doc, ids in _frames(batch, sha, opener, wanted)]
            yield pa.RecordBatch.from_arrays([pa.array([d for d, _ in found], pa.int64()), pa.array([i for _, i in found], pa.list_(pa.int64()))], ["doc_id", "ids"])

    shards = spark.read.parquet(f"{path}/shards").filter(F.arrays_overlap("doc_ids", F.array(*[F.lit(x).cast("long") for x in wanted])))
    return shards.select("part", "base", "dict_sha256", "width", "doc_ids", "frame_offsets", "frames").mapInArrow(run, "doc_id long, ids array<long>")
