"""Token-id files: documents compressed one by one with a shared zstandard dictionary, with an offset index.

A folder holds ``dictionary.zdict`` and shards. A shard is a header (magic, id width, SHA-256 of the dictionary), one
zstandard frame per document over its serialized id array, and an index (doc_id, has_id, n_tokens, frame offset) with a
footer, so that one document is read by one seek and one small frame. Documents lie in ascending doc_id order over the
shards. The dictionary is trained on the id arrays of a bounded sample: the SAMPLE_DOCS documents of smallest id hash, of
whatever length; an id array above PIECE_IDS gives SAMPLE_PIECES pieces of that size, evenly spaced, so that a long document does
not outweigh the others. Every document is encoded and written whole.

One shuffle of the texts (by range of doc_id), one pass that encodes, compresses and writes. Shard names carry the task
attempt and only the shards named by finished tasks are listed, so a lost executor or a repeated task leaves no trace in
the result. A shard is closed at SHARD_BYTES, which bounds what a reader holds.

Defined cases: null and empty texts have the end id only. Rows without doc_id come first. Rows that share a doc_id are
documents of their own, in the order of their texts. With too little data for a dictionary, frames have none and the hash
is zero.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from folioforge.llm.common import in_arrow, ship, staged
from folioforge.llm.encoders import encoder
from folioforge.llm.words import parts
from folioforge.session import scratch_path

MAGIC = b"FOLIOTK1"
SAMPLE_DOCS, PIECE_IDS, SAMPLE_PIECES, DICTIONARY_BYTES = 2000, 4096, 4, 64 << 10
SHARD_BYTES, LEVEL = 32 << 20, 3
INDEX = np.dtype([("doc_id", "<i8"), ("has_id", "u1"), ("n_tokens", "<u4"), ("offset", "<u8")])
FOOTER = struct.Struct("<QQ8s")


def qualified(spark: SparkSession, path: str) -> str:
    """The path with the scheme of its file system, in the form that file-system clients take."""
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    whole = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(place).toString()
    return whole.removeprefix("file://").removeprefix("file:")


def spaced(ids: np.ndarray) -> list[np.ndarray]:
    """The array, or SAMPLE_PIECES pieces of PIECE_IDS of a longer one."""
    if len(ids) <= PIECE_IDS:
        return [ids]
    starts = np.linspace(0, len(ids) - PIECE_IDS, SAMPLE_PIECES).astype(int)
    return [ids[a : a + PIECE_IDS] for a in sorted(set(starts.tolist()))]


def train_dictionary(docs: DataFrame, tokenizer: str, end: int) -> bytes:
    """Dictionary bytes; empty if the sample is too small to train on."""
    # Rows that share an id are told apart by their text, so reruns take the same ones.
    rows = docs.select("doc_id", F.xxhash64("text").alias("print"))
    ids = rows.orderBy(F.xxhash64("doc_id"), "doc_id", "print").limit(SAMPLE_DOCS).distinct()
    same = docs["doc_id"].eqNullSafe(ids["doc_id"]) & (F.xxhash64(docs["text"]) == ids["print"])
    sample = docs.join(F.broadcast(ids), same, "left_semi").dropDuplicates(["doc_id", "text"])

    def serialized(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(tokenizer)
        for batch in batches:
            for part in parts(batch):
                flat, sizes = coder.encode(part["text"], end)
                numbers, pieces = [], []
                for doc_id, ids in zip(part["doc_id"].to_pylist(), np.split(flat, np.cumsum(sizes)[:-1])):
                    for piece in spaced(ids):
                        numbers.append(doc_id)
                        pieces.append(piece.tobytes())
                yield pa.RecordBatch.from_arrays([pa.array(numbers, pa.int64()), pa.array(pieces, pa.binary())], names=["doc_id", "ids"])

    rows = in_arrow(sample.select("doc_id", "text"), serialized, "doc_id long, ids binary").orderBy("doc_id", "ids").collect()
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, [bytes(r["ids"]) for r in rows]).as_bytes()
    except zstandard.ZstdError:
        return b""


def _digest(dictionary: bytes) -> bytes:
    return hashlib.sha256(dictionary).digest() if dictionary else bytes(32)


def _open(folder: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(folder)


class ShardWriter:
    """Collects one shard in memory (SHARD_BYTES and one document at most) and writes it as one file."""

    def __init__(self, width: int, dictionary: bytes):
        self.header = MAGIC + struct.pack("<I", width) + _digest(dictionary)
        self.frames, self.index, self.size = [self.header], [], len(self.header)

    def add(self, doc_id: int | None, n_tokens: int, frame: bytes) -> None:
        self.index.append((doc_id or 0, doc_id is not None, n_tokens, self.size))
        self.frames.append(frame)
        self.size += len(frame)

    def write(self, system: fs.FileSystem, path: str) -> None:
        table = np.array(self.index, INDEX).tobytes()
        with system.open_output_stream(path) as out:
            for piece in (*self.frames, table, FOOTER.pack(self.size, len(self.index), MAGIC)):
                out.write(piece)


class ShardReader:
    """Documents of a shard, one by one without reading the others."""

    def __init__(self, folder: str, name: str):
        system, base = _open(folder)
        self.file = system.open_input_file(f"{base}/{name}")
        size = self.file.size()
        start, count, magic = FOOTER.unpack(self.file.read_at(FOOTER.size, size - FOOTER.size))
        head = self.file.read_at(len(MAGIC) + 36, 0)
        if magic != MAGIC or head[: len(MAGIC)] != MAGIC:
            raise ValueError(f"{name} is no token file")
        self.end, self.width, digest = start, *struct.unpack("<I", head[8:12]), head[12:44]
        self.index = np.frombuffer(self.file.read_at(count * INDEX.itemsize, start), INDEX)
        options = {}
        if any(digest):
            with system.open_input_stream(f"{base}/dictionary.zdict") as f:
                dictionary = f.read()
            if _digest(dictionary) != digest:
                raise ValueError(f"{name} was written with another dictionary")
            options["dict_data"] = zstandard.ZstdCompressionDict(dictionary)
        self.unpack = zstandard.ZstdDecompressor(**options).decompress

    def ids(self, i: int) -> np.ndarray:
        """Ids of the i-th document of the shard."""
        a = int(self.index["offset"][i])
        b = int(self.index["offset"][i + 1]) if i + 1 < len(self.index) else self.end
        return np.frombuffer(self.unpack(self.file.read_at(b - a, a)), f"<u{self.width}")

    def find(self, doc_id: int) -> np.ndarray | None:
        """Ids of the first document with this id, by binary search."""
        first = int(np.count_nonzero(self.index["has_id"] == 0))  # rows without id come first
        i = first + int(np.searchsorted(self.index["doc_id"][first:], doc_id))
        return self.ids(i) if i < len(self.index) and self.index["doc_id"][i] == doc_id else None


def write_tokens(docs: DataFrame, folder: str, tokenizer: str, end: int) -> DataFrame:
    """Write ``docs`` (doc_id, text); returns the list of shards: shard, name, n_docs, n_tokens, start."""
    spark = docs.sparkSession
    ship(spark)
    docs = docs.select("doc_id", "text")
    dictionary = train_dictionary(docs, tokenizer, end)
    folder = qualified(spark, folder)
    system, base = _open(folder)
    system.create_dir(base, recursive=True)
    with system.open_output_stream(f"{base}/dictionary.zdict") as out:
        out.write(dictionary)

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, task = encoder(tokenizer), TaskContext.get()
        options = {"dict_data": zstandard.ZstdCompressionDict(dictionary)} if dictionary else {}
        pack = zstandard.ZstdCompressor(level=LEVEL, **options).compress
        place, root = _open(folder)
        writer, done = ShardWriter(coder.dtype.itemsize, dictionary), 0

        def close() -> pa.RecordBatch:
            name = f"shard-{task.partitionId():06d}-{done:04d}-{task.taskAttemptId()}.tok"
            writer.write(place, f"{root}/{name}")
            tokens = sum(x[2] for x in writer.index)
            row = [[task.partitionId() * 1_000_000 + done], [name], [len(writer.index)], [tokens]]
            return pa.RecordBatch.from_arrays([pa.array(x) for x in row], names=["shard", "name", "n_docs", "n_tokens"])

        for batch in batches:
            for part in parts(batch):
                flat, sizes = coder.encode(part["text"], end)
                stops = np.cumsum(sizes).tolist()
                for doc_id, n, b in zip(part["doc_id"].to_pylist(), sizes.tolist(), stops):
                    writer.add(doc_id, n, pack(flat[b - n : b].tobytes()))
                    if writer.size >= SHARD_BYTES:
                        yield close()
                        writer, done = ShardWriter(coder.dtype.itemsize, dictionary), done + 1
        if writer.index:
            yield close()

    ranged = docs.repartitionByRange("doc_id").sortWithinPartitions("doc_id", F.xxhash64("text"))
    listed = staged(in_arrow(ranged, shards, "shard long, name string, n_docs long, n_tokens long"), "shards")
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # one row per shard
    return listed.withColumn("start", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))


def read_tokens(shards: DataFrame, folder: str) -> DataFrame:
    """Every document of the listed shards: doc_id, start, n_tokens, ids_crc32 (of the ids as 32-bit integers)."""
    folder = qualified(shards.sparkSession, folder)

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                shard = ShardReader(folder, row["name"])
                n = shard.index["n_tokens"].astype(np.int64)
                crc = [zlib.crc32(shard.ids(i).astype("<u4").tobytes()) for i in range(len(n))]
                ids = pa.array(shard.index["doc_id"], mask=shard.index["has_id"] == 0)
                columns = [ids, pa.array(row["start"] + np.cumsum(n) - n), pa.array(n), pa.array(crc, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "start", "n_tokens", "ids_crc32"])

    spread = shards.repartition("shard")
    return in_arrow(spread.select("name", "start"), documents, "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_folder(spark: SparkSession) -> str:
    return scratch_path(spark, "token-files")
