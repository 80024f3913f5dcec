"""What the operators of this subpackage share: tables, the shared folder, text buffers and chunks."""

from __future__ import annotations

import atexit
import contextlib
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Bytes of text that one chunk holds, and the fewest chunks.
CHUNK_BYTES, LEAST_CHUNKS = 4 << 20, 64


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def col(name: str) -> Column:
    """A column by its name, whatever characters that has."""
    return F.col("`" + name.replace("`", "``") + "`")


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors see: spark.checkpoint.dir, or on one machine a temporary one where that is unset."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found and not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    if not found:
        found = f"file://{tempfile.mkdtemp(prefix='tesserae-')}"
        spark.sparkContext.setCheckpointDir(found)
        found = spark.sparkContext.getCheckpointDir()
    return found.rstrip("/")


_written: list[tuple[SparkSession, str]] = []


def new_folder(spark: SparkSession, label: str) -> str:
    """The URI of a folder of its own under the shared one; release() or the end of the process removes it."""
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex[:12]}"
    _written.append((spark, path))
    return path


def written(df: DataFrame, label: str) -> DataFrame:
    """The rows of df from a Parquet table in the shared folder: cuts the lineage, so that a lost executor costs no recomputation."""
    spark = df.sparkSession
    path = new_folder(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def made() -> int:
    """How many folders there are now."""
    return len(_written)


def forget(before: int, *labels: str) -> None:
    """Removes the folders of these labels that were made since there were so many: what an operator needs no more once its last table is written."""
    release(paths=[path for _, path in _written[before:] if path.rsplit("/", 1)[-1].rsplit("-", 1)[0] in labels])


def release(kept: int = 0, paths: list[str] | None = None) -> None:
    """Removes what written() and new_folder() have left in the shared folder, but for the first so many, or those paths alone; DataFrames over it end then."""
    going = _written[kept:] if paths is None else [x for x in _written if x[1] in paths]
    _written[:] = [x for x in _written if x not in going]
    for spark, path in going:
        with contextlib.suppress(Exception):
            jvm = spark.sparkContext._jvm
            at = jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


atexit.register(release)


@contextlib.contextmanager
def passing(spark: SparkSession) -> Iterator[None]:
    """Removes at its end what was written meanwhile: for work whose result is kept elsewhere by then."""
    before = made()
    try:
        yield
    finally:
        release(before)


def file_in(folder: str, name: str) -> tuple[fs.FileSystem, str]:
    """A file system and the path in it of a file under a folder's URI."""
    system, at = fs.FileSystem.from_uri("file://" + folder[5:] if folder.startswith("file:/") and "://" not in folder else folder)
    return system, f"{at}/{name}"


def put_rows(folder: str, name: str, rows: pa.Table) -> None:
    """Writes rows as an Arrow file compressed by zstandard. Its name must belong to this attempt of a task alone, so that no other replaces it."""
    system, at = file_in(folder, name)
    with system.open_output_stream(at) as out, pa.ipc.new_file(out, rows.schema, options=pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", compression_level=1))) as file:
        file.write_table(rows)


def spare() -> None:
    """Gives back to the machine what Arrow and the C library hold of memory that is free, so that a worker's size is that of the chunk at hand."""
    pa.default_memory_pool().release_unused()
    pa.system_memory_pool().release_unused()


#: What operators keep in a worker from task to task, by the operator's name.
kept: dict[str, dict] = {}


def keep_only(*names: str) -> None:
    """Drops what other operators keep in this process: a worker is handed from one operator to the next, and lives on while it waits."""
    going = [x for name, x in kept.items() if x and name not in names]
    for held in going:
        held.clear()
    if going:
        spare()


def get_rows(folder: str, name: str) -> pa.Table:
    spare()
    system, at = file_in(folder, name)
    with system.open_input_file(at) as raw, pa.ipc.open_file(raw) as file:
        return file.read_all()


def make_folder(folder: str) -> None:
    system, at = file_in(folder, "")
    system.create_dir(at, recursive=True)


def chunks_of(batches: Iterator[pa.RecordBatch], text: int) -> Iterator[pa.Table]:
    """The rows of a task in tables of CHUNK_BYTES of their column text at most, or one row."""
    held, size = [], 0
    for batch in batches:
        ends, a = np.cumsum(pc.binary_length(batch.column(text)).to_numpy(zero_copy_only=False).astype(np.int64)), 0
        while a < batch.num_rows:
            base = int(ends[a - 1]) if a else 0
            b = int(np.searchsorted(ends, base + CHUNK_BYTES - size, "right"))
            if b <= a and held:
                yield pa.Table.from_batches(held).combine_chunks()
                held, size = [], 0
                spare()
                continue
            b = max(b, a + 1)
            held.append(batch.slice(a, b - a))
            size, a = size + int(ends[b - 1]) - base, b
    if held:
        yield pa.Table.from_batches(held).combine_chunks()
    spare()


def text_bytes(docs: DataFrame, text_col: str) -> int:
    """Bytes of all texts: one scan of that column, from which the numbers of chunks and buckets follow."""
    return int(docs.select(F.sum(F.octet_length(col(text_col)).cast("long")).alias("n")).first()[0] or 0)


def chunk_count(total: int) -> int:
    return max(LEAST_CHUNKS, -(-total // CHUNK_BYTES))


def chunked(docs: DataFrame, id_col: str, text_col: str, chunks: int, carried: list[str] | None = None) -> DataFrame:
    """(_chunk, _id, _text), the texts' UTF-8 compressed by zstandard, null texts empty; and if columns are carried, their struct _rest.

    A chunk depends on a row's id and text alone, so each recomputation deals alike.
    """
    ident, text = col(id_col), F.coalesce(col(text_col), F.lit(""))
    rows = docs.select(F.pmod(F.xxhash64(ident, text), F.lit(chunks)).alias("_chunk"), ident.alias("_id"), text.alias("_text"), *([F.struct(*[col(c) for c in carried]).alias("_rest")] if carried else []))

    return squeezed(rows)


def squeezed(rows: DataFrame) -> DataFrame:
    """rows with their column _text, never null, as UTF-8 compressed by zstandard: a shuffle then moves a third less than otherwise."""
    names = rows.columns
    at = names.index("_text")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=1).compress
        for batch in batches:
            packed = pa.array([squeeze(x.encode()) for x in batch.column(at).to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([packed if i == at else c for i, c in enumerate(batch.columns)], names)

    return rows.mapInArrow(pack, T.StructType([T.StructField("_text", T.BinaryType()) if f.name == "_text" else f for f in rows.schema.fields]))


def texts_of(column: pa.ChunkedArray | pa.Array) -> list[bytes]:
    """The texts that squeezed() has compressed."""
    expand = zstandard.ZstdDecompressor().decompress
    return [expand(x) for x in column.to_pylist()]


def end_to_end(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts, one after the other, and len + 1 offsets."""
    return np.frombuffer(b"".join(texts), np.uint8), np.concatenate([np.zeros(1, np.int64), np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)))])
