"""Document fingerprints from closed syncmers."""

from __future__ import annotations

import base64
import hashlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import col, squeezed, table, text_bytes, texts_of, written
from .words import joined, mix

#: Bytes of a k-mer and of the substrings within it, and anchors that a fingerprint keeps.
K, S, ANCHORS = 16, 8, 64
#: Bytes of text that a task takes, about.
TASK_BYTES = 16 << 20
_GOLD = np.uint64(0x9E3779B97F4A7C15)
_ROW = np.dtype([("hash", "<u4"), ("at", "u1", 3)])


def closed_syncmers(raw: bytes, k: int = K, s: int = S) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of the k-mers of bytes whose minimal s-mer lies at an edge. k is a multiple of s, which is 8.

    Whether a k-mer is chosen depends on its own bytes alone.
    """
    if len(raw) < k:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    words = np.ndarray((len(raw) - s + 1,), "<u8", raw, strides=(1,))
    h = mix(words * _GOLD)
    span = k - s + 1
    low, width = h, 1
    while width < span:
        step = min(width, span - width)
        low = np.minimum(low[: len(low) - step], low[step:])
        width += step
    at = np.flatnonzero((h[: len(low)] == low) | (h[span - 1 :] == low))
    whole = h[at]
    for i in range(s, k, s):
        whole = joined(whole, h[at + i], i)
    return at, whole


def fingerprint(raw: bytes) -> np.ndarray:
    """The anchors with the smallest hashes, ascending, each hash once at its first place; a text shorter than a k-mer is one anchor."""
    if not raw:
        return np.zeros(0, _ROW)
    at, whole = closed_syncmers(raw)
    if not len(at):
        at, whole = np.zeros(1, np.int64), np.array([int.from_bytes(hashlib.blake2b(raw, digest_size=8).digest(), "little")], np.uint64)
    short = (whole >> np.uint64(32)).astype("<u4")
    if len(short) > 4 * ANCHORS:  # of the smallest alone, with room for repeats
        limit = np.partition(short, 4 * ANCHORS - 1)[4 * ANCHORS - 1]
        near = short <= limit
        if len(np.unique(short[near])) >= ANCHORS:
            short, at = short[near], at[near]
    values, first = np.unique(short, return_index=True)
    out = np.zeros(min(len(values), ANCHORS), _ROW)
    out["hash"] = values[:ANCHORS]
    out["at"] = np.minimum(at[first[:ANCHORS]], 2**24 - 1).astype("<u4").view(np.uint8).reshape(-1, 4)[:, :3]
    return out


def text_of(mark: np.ndarray) -> str:
    return base64.b64encode(mark.tobytes()).decode()


def mark_of(text: str) -> np.ndarray:
    return np.frombuffer(base64.b64decode(text), _ROW)


def _places(mark: np.ndarray) -> np.ndarray:
    return mark["at"].astype(np.int64) @ np.array([1, 1 << 8, 1 << 16])


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """The share of the smallest anchors of both together that both hold in like order; 1 if both are empty."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    union = np.union1d(a["hash"], b["hash"])[: max(len(a), len(b))]
    both, i, j = np.intersect1d(a["hash"], b["hash"], assume_unique=True, return_indices=True)
    if not len(both):
        return 0.0
    counted = both <= union[-1]
    x, y = _places(a)[i][counted], _places(b)[j][counted]
    tails: list[int] = []
    for place in y[np.argsort(x, kind="stable")].tolist():  # the longest run of anchors whose places ascend in both
        k = bisect_left(tails, place)
        tails[k : k + 1] = [place]
    return len(tails) / len(union)


_FIELDS = [("n_chars", T.LongType()), ("edited_sha256", T.StringType()), ("fingerprint", T.StringType()), ("edited_fingerprint", T.StringType()), ("near_edited", T.DoubleType()), ("near_next", T.DoubleType())]


def _row(text: str, mark: np.ndarray, after: str, after_mark: np.ndarray) -> tuple:
    tail = len(text) // 4
    edited = (text[: len(text) - tail] + after[:tail]).encode()
    edited_mark = fingerprint(edited)
    return len(text), hashlib.sha256(edited).hexdigest(), text_of(mark), text_of(edited_mark), likeness(mark, edited_mark), likeness(mark, after_mark)


def fingerprints_with_edits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints every text and its edited text: the last quarter of its code points replaced by the next row's first as many.

    Rows are in ascending order of id_col, null ids first, rows of equal id in the order of a hash of their text; the first follows
    the last. A fingerprint is the base64 of up to 64 anchors (4 bytes of hash, 3 of place), equal for equal texts. near_edited and
    near_next are likenesses from 0 to 1: to the edited text, and to the next row's text.

    A null text counts as empty, whose fingerprint is the empty string; a single row follows itself; an empty table gives an empty
    one; other columns are ignored. Rows are dealt by ranges of id and tie, so many rows of one id are split; only the last row of
    each range is completed afterwards, by a join on the numbers of the ranges.
    """
    parts = max(1, -(-text_bytes(docs, text_col) // TASK_BYTES))
    text = F.coalesce(col(text_col), F.lit(""))
    rows = squeezed(docs.select(col(id_col).alias("_id"), F.xxhash64(text).alias("_tie"), text.alias("_text"))).repartitionByRange(parts, "_id", "_tie").sortWithinPartitions("_id", "_tie")
    kinds = {"n_chars": pa.int64(), "near_edited": pa.float64(), "near_next": pa.float64()}

    def table_of(ids: list, id_type: pa.DataType, found: list[tuple], extra: dict) -> pa.RecordBatch:
        columns = list(zip(*found, strict=True)) if found else [()] * len(_FIELDS)
        arrays = [pa.array(ids, id_type)] + [pa.array(list(c), kinds.get(n, pa.string())) for (n, _), c in zip(_FIELDS, columns, strict=True)]
        return pa.RecordBatch.from_arrays([*arrays, *extra.values()], ["_id", *(n for n, _ in _FIELDS), *extra])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        first = last = None  # of a task's range: (id, text, fingerprint)
        for batch in batches:
            ids, found, kind = [], [], batch.schema.field(0).type
            for ident, text in zip(batch.column(0).to_pylist(), texts_of(batch.column(2)), strict=True):
                mark, text = fingerprint(text), text.decode()
                if last:
                    ids.append(last[0])
                    found.append(_row(last[1], last[2], text, mark))
                last = (ident, text, mark)
                first = first or last
            none = pa.array([None] * len(ids), pa.string())
            yield table_of(ids, kind, found, {"_part": pa.array([None] * len(ids), pa.int64()), "_first": none, "_last": none})
        if last:
            yield table_of([last[0]], kind, [(None,) * len(_FIELDS)], {"_part": pa.array([part], pa.int64()), "_first": pa.array([first[1]]), "_last": pa.array([last[1]])})

    ident = T.StructField("_id", docs.schema[id_col].dataType)
    schema = T.StructType([ident, *(T.StructField(n, k) for n, k in _FIELDS), T.StructField("_part", T.LongType()), T.StructField("_first", T.StringType()), T.StructField("_last", T.StringType())])
    made = written(rows.mapInArrow(run, schema), "fingerprints")
    ends = made.where("_part is not null")
    whole = Window.orderBy("_part")  # one small row for each range
    order = ends.select("_part", F.lead("_part").over(whole).alias("_next"), F.min("_part").over(Window.partitionBy()).alias("_head")).select(F.col("_part").alias("_from"), F.coalesce("_next", "_head").alias("_to"))
    pairs = ends.select("_id", "_part", "_last").join(order, F.col("_part") == F.col("_from")).join(ends.select(F.col("_part").alias("_then"), F.col("_first").alias("_after")), F.col("_to") == F.col("_then"))

    def complete(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for text, after in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                found.append(_row(text, fingerprint(text.encode()), after, fingerprint(after.encode())))
            yield table_of(batch.column(0).to_pylist(), batch.schema.field(0).type, found, {})

    rest = pairs.select("_id", "_last", "_after").mapInArrow(complete, T.StructType([ident, *(T.StructField(n, k) for n, k in _FIELDS)]))
    return made.where("_part is null").select("_id", *(n for n, _ in _FIELDS)).unionByName(rest).withColumnRenamed("_id", id_col)


def op9_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints_with_edits(table(spark, sf_dir, "documents"))
