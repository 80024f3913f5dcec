"""Token-id files: fixed-width bit packing with block offsets.

A file holds, little-endian and without gaps:

    magic      8 bytes, MAGIC
    bits       u32, bits of an id: as many as the largest id of the vocabulary needs
    per_block  u32, ids of a block, a multiple of 64; each block begins at a whole 64-bit word
    n_ids      u64
    n_docs     u64
    offsets    u64 per block, and the end: where its words begin, in bytes from the start of the words
    known      u8 per document: 0 where its id is null
    doc_ids    i64 per document
    starts     u64 per document, and the end: the place of its first id in this file
    words      u64, ids from the low bits upward
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import col, new_folder, table, text_bytes
from .encoding import encoder, vocabulary_path

MAGIC, PER_BLOCK = b"TESSBITS", 4096
_HEAD = struct.Struct("<8sIIQQ")
#: Bytes of text that one file takes, about.
FILE_BYTES = 16 << 20


def pack(ids: np.ndarray, bits: int) -> np.ndarray:
    """The words of so many ids, a multiple of 64, all groups of 64 at once."""
    groups = ids.astype(np.uint64).reshape(-1, 64)
    out = np.zeros((len(groups), bits), np.uint64)
    for i in range(64):
        at, shift = divmod(i * bits, 64)
        out[:, at] |= groups[:, i] << np.uint64(shift)
        if shift + bits > 64:
            out[:, at + 1] |= groups[:, i] >> np.uint64(64 - shift)
    return out.ravel()


def unpack(words: np.ndarray, bits: int) -> np.ndarray:
    """The ids of whole groups of 64."""
    groups, mask = words.reshape(-1, bits), np.uint64((1 << bits) - 1)
    out = np.empty((len(groups), 64), np.uint32)
    for i in range(64):
        at, shift = divmod(i * bits, 64)
        x = groups[:, at] >> np.uint64(shift)
        if shift + bits > 64:
            x = x | (groups[:, at + 1] << np.uint64(64 - shift))
        out[:, i] = x & mask
    return out.ravel()


def to_bytes(doc_ids: list[int | None], documents: list[bytes], bits: int, per_block: int = PER_BLOCK) -> bytes:
    """A file of documents, each the bytes of its ids as little-endian unsigned 32-bit integers."""
    ids = np.frombuffer(b"".join(documents), "<u4")
    if len(ids) and int(ids.max()) >> bits:
        raise ValueError(f"an id needs more than {bits} bits")
    padded = np.zeros(-(-len(ids) // 64) * 64, np.uint32)
    padded[: len(ids)] = ids
    blocks = -(-len(ids) // per_block)
    offsets = np.minimum(np.arange(blocks + 1, dtype=np.uint64) * np.uint64(per_block // 64 * bits * 8), np.uint64(len(padded) // 64 * bits * 8))
    starts = np.concatenate([[0], np.cumsum([len(d) // 4 for d in documents])]).astype("<u8")
    known = np.array([x is not None for x in doc_ids], np.uint8)
    numbers = np.array([x or 0 for x in doc_ids], "<i8")
    return b"".join([_HEAD.pack(MAGIC, bits, per_block, len(ids), len(documents)), offsets.astype("<u8").tobytes(), known.tobytes(), numbers.tobytes(), starts.tobytes(), pack(padded, bits).tobytes()])


@dataclass
class Reader:
    """A file of ids, in memory or mapped. ids(a, b) reads the blocks between alone."""

    raw: bytes | memoryview

    def __post_init__(self) -> None:
        magic, self.bits, self.per_block, self.n_ids, self.n_docs = _HEAD.unpack_from(self.raw)
        if magic != MAGIC:
            raise ValueError("not a file of token ids")
        at = _HEAD.size
        parts = []
        for kind, n in (("<u8", -(-self.n_ids // self.per_block) + 1), ("u1", self.n_docs), ("<i8", self.n_docs), ("<u8", self.n_docs + 1)):
            parts.append(np.frombuffer(self.raw, kind, n, at))
            at += parts[-1].nbytes
        self.offsets, self.known, self.doc_ids, self.starts = parts
        self.base = at

    def ids(self, start: int, stop: int) -> np.ndarray:
        if stop <= start:
            return np.zeros(0, np.uint32)
        first, last = start // self.per_block, (stop - 1) // self.per_block + 1
        a, b = int(self.offsets[first]), int(self.offsets[last])
        words = np.frombuffer(self.raw, "<u8", (b - a) // 8, self.base + a)
        return unpack(words, self.bits)[start - first * self.per_block : stop - first * self.per_block]

    def document(self, i: int) -> np.ndarray:
        return self.ids(int(self.starts[i]), int(self.starts[i + 1]))

    def documents(self) -> Iterator[tuple[int | None, np.ndarray]]:
        every, ends = self.ids(0, self.n_ids), self.starts.tolist()
        for i, (known, number) in enumerate(zip(self.known.tolist(), self.doc_ids.tolist(), strict=True)):
            yield (number if known else None), every[ends[i] : ends[i + 1]]


def _put(folder: str, name: str, raw: bytes) -> None:
    """A whole file under its name, or none: a task that is tried again replaces it."""
    system, at = fs.FileSystem.from_uri(folder if "://" in folder or not folder.startswith("file:/") else "file://" + folder[5:])
    temporary = f"{at}/.{name}.{TaskContext.get().taskAttemptId()}"
    with system.open_output_stream(temporary) as out:
        out.write(raw)
    system.move(temporary, f"{at}/{name}")


def write_id_files(docs: DataFrame, folder: str, path: str, end_id: int, bits: int, id_col: str = "doc_id", text_col: str = "text", file_bytes: int = FILE_BYTES) -> DataFrame:
    """Encodes every text, appends end_id and writes the ids into files under folder, ascending by id_col over the files in the order of their names.

    Returns the list of files: file, start (ids of all files before), n_docs, n_ids; the driver holds one small row for each file.
    A null text counts as empty; null ids come first; rows of equal id stand in the order of a hash of their text; an empty table
    gives no files.
    """
    spark = docs.sparkSession
    files = max(1, -(-text_bytes(docs, text_col) // file_bytes))
    ident, text = col(id_col).cast("long"), F.coalesce(col(text_col), F.lit(""))
    rows = docs.select(ident.alias("_id"), F.xxhash64(text).alias("_tie"), text.alias("_text")).repartitionByRange(files, "_id", "_tie").sortWithinPartitions("_id", "_tie").select("_id", "_text")
    system, at = fs.FileSystem.from_uri(folder if "://" in folder else "file://" + folder.removeprefix("file:"))
    system.create_dir(at, recursive=True)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end = encoder(path).ids, struct.pack("<I", end_id)
        numbers, documents = [], []
        for batch in batches:
            numbers += batch.column(0).to_pylist()
            documents += [encode(x) + end for x in batch.column(1).to_pylist()]
        if documents:
            name = f"ids-{TaskContext.get().partitionId():08d}.bits"
            _put(folder, name, to_bytes(numbers, documents, bits))
            yield pa.RecordBatch.from_pylist([{"file": name, "n_docs": len(documents), "n_ids": sum(map(len, documents)) // 4}])

    found = sorted(rows.mapInArrow(write, "file string, n_docs long, n_ids long").collect())
    start, out = 0, []
    for r in found:
        out.append((r["file"], start, r["n_docs"], r["n_ids"]))
        start += r["n_ids"]
    return spark.createDataFrame(out, "file string, start long, n_docs long, n_ids long")


def read_id_files(files: DataFrame, folder: str, id_col: str = "doc_id") -> DataFrame:
    """id_col, start, n_tokens and ids (little-endian unsigned 32-bit integers) of each document of the files."""
    spark = files.sparkSession
    if files.isEmpty():
        return spark.createDataFrame([], f"`{id_col}` long, start long, n_tokens long, ids binary")
    raw = spark.read.format("binaryFile").option("pathGlobFilter", "*.bits").load(folder).select(F.element_at(F.split("path", "/"), -1).alias("file"), "content")
    rows = raw.join(F.broadcast(files.select("file", "start")), "file").select("start", "content")  # one small row for each file

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [id_col, "start", "n_tokens", "ids"]
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary()]
        for batch in batches:
            for i in range(batch.num_rows):
                base, rows = batch.column(0)[i].as_py(), ([], [], [], [])
                for number, ids in Reader(batch.column(1)[i].as_buffer()).documents():
                    for out, x in zip(rows, (number, base, len(ids), ids.astype("<u4").tobytes()), strict=True):
                        out.append(x)
                    base += len(ids)
                for a in range(0, len(rows[0]), 1000):
                    yield pa.RecordBatch.from_arrays([pa.array(x[a : a + 1000], k) for x, k in zip(rows, kinds, strict=True)], names)

    schema = T.StructType([T.StructField(id_col, T.LongType()), T.StructField("start", T.LongType()), T.StructField("n_tokens", T.LongType()), T.StructField("ids", T.BinaryType())])
    return rows.mapInArrow(read, schema)


def op4_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark, "token-ids")
    files = write_id_files(table(spark, sf_dir, "documents"), folder, vocabulary_path("word_bpe_49k.json"), end_id=1, bits=(49_408 - 1).bit_length())
    return read_id_files(files, folder).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
