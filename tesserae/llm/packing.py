"""Hierarchical packing of documents into sequences of several context sizes."""

from __future__ import annotations

import heapq
import struct
from bisect import bisect_right, insort
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import col, table
from .encoding import encoder, vocabulary_path

#: Ids that wait in a task before they are packed, and those of a step group.
POOL_IDS, STEP_IDS = 1 << 20, 1 << 16


def tiers(longest: int, shortest: int) -> list[int]:
    """Context sizes from the longest down, each half the one before."""
    out = [longest]
    while out[-1] // 2 >= shortest:
        out.append(out[-1] // 2)
    return out


class Pool:
    """Remainders of documents that wait, each (length, key) with key = (document, start), in the tier that is the shortest to hold them."""

    def __init__(self, sizes: list[int]):
        self.sizes = sizes
        self.waiting: dict[int, list[tuple[int, tuple[int, int]]]] = {s: [] for s in sizes}

    def add(self, length: int, key: tuple[int, int]) -> None:
        if length:
            insort(self.waiting[min(s for s in self.sizes if s >= length)], (length, key))

    def take(self, room: int, below: int) -> tuple[int, tuple[int, int]] | None:
        """The longest of the shorter tiers that fits, or else a cut of one that doesn't."""
        shorter = [s for s in self.sizes if s < below]
        for size in shorter:
            rows = self.waiting[size]
            at = bisect_right(rows, (room, (1 << 62, 0)))
            if at:
                return rows.pop(at - 1)
        for size in reversed(shorter):
            if rows := self.waiting[size]:
                length, (doc, start) = rows.pop()
                self.add(length - room, (doc, start + room))
                return room, (doc, start)
        return None

    def sequences(self, everything: bool) -> Iterator[tuple[int, list[tuple[int, tuple[int, int]]]]]:
        """(size, pieces) of full sequences, from the longest tier down: a remainder, and its gap filled from shorter tiers.

        What does not fill a sequence waits on, or if everything is to go, is cut at powers of two.
        """
        for size in self.sizes:
            rows = self.waiting[size]
            while rows:
                pieces, room = [rows.pop()], 0
                room = size - pieces[0][0]
                while room and (more := self.take(room, size)):
                    pieces.append(more)
                    room -= more[0]
                while room and rows:  # the shorter tiers are empty: cut one of this tier
                    length, (doc, start) = rows.pop(0)
                    cut = min(length, room)
                    pieces.append((cut, (doc, start)))
                    room -= cut
                    self.add(length - cut, (doc, start + cut))
                if not room:
                    yield size, pieces
                    continue
                if everything:
                    yield from powers(pieces)
                else:
                    for length, key in pieces:
                        self.add(length, key)
                    return


def powers(pieces: list[tuple[int, tuple[int, int]]]) -> Iterator[tuple[int, list[tuple[int, tuple[int, int]]]]]:
    """The pieces, end to end, cut into sequences whose sizes are the powers of two of their sum."""
    total = sum(p[0] for p in pieces)
    while total:
        size = 1 << (total.bit_length() - 1)
        out, room = [], size
        while room:
            length, (doc, start) = pieces[0]
            cut = min(length, room)
            out.append((cut, (doc, start)))
            room -= cut
            pieces[0] = (length - cut, (doc, start + cut))
            if not pieces[0][0]:
                pieces = pieces[1:]
        total -= size
        yield size, out


def step_groups(sizes: list[int], step: int) -> list[int]:
    """A group for each sequence: the longest first, each into the group with the fewest ids, so that all hold a like mix and sum."""
    heap = [(0, i) for i in range(max(1, round(sum(sizes) / step)))]
    out = [0] * len(sizes)
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        held, group = heapq.heappop(heap)
        out[i] = group
        heapq.heappush(heap, (held + sizes[i], group))
    return out


def pack(docs: DataFrame, path: str, end_id: int = 0, longest: int = 1024, shortest: int = 64, id_col: str = "doc_id", text_col: str = "text", pool: int = POOL_IDS, step: int = STEP_IDS) -> DataFrame:
    """Packs the ids of all texts, each followed by end_id, into sequences of `longest` ids and of its halves down to `shortest`.

    Whole windows of a long document become sequences of their own. What remains is routed to the shortest tier that holds it; each
    tier is packed, from the longest down, and the gap that a remainder leaves is filled with documents of shorter tiers, the last
    one cut to fit. A task's last remainders are cut at powers of two. So no sequence needs padding: all are powers of two long.
    Sequences are dealt to step groups of about `step` ids, alike in their mix of tiers.

    Returns a row for each piece: id_col, start (the document's ids before it), length, ids (little-endian unsigned 32-bit integers),
    doc_tokens, sequence_id, offset (of the piece in the sequence), context (the sequence's size), step_group. A null or empty
    text is end_id alone; null and repeated ids are kept, and each row is packed for itself; an empty table gives an empty one;
    other columns are ignored. No row is shuffled: each task packs its own documents in pools of `pool` ids.
    """
    sizes = tiers(longest, shortest)
    names = ["_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset", "context", "step_group"]
    kinds = [pa.int64()] * 2 + [pa.binary()] + [pa.int64()] * 3 + [pa.int32(), pa.int64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end = encoder(path).ids, struct.pack("<I", end_id)
        task = TaskContext.get().partitionId() << 33
        waiting, whole = Pool(sizes), []
        held: dict[int, tuple] = {}  # id, ids and ids that are not yet packed, by number
        sequence, group, arrived, number = task, task, 0, 0

        def flush(everything: bool) -> Iterator[pa.RecordBatch]:
            nonlocal sequence, group, whole
            made = whole + list(waiting.sequences(everything))
            whole = []
            groups = step_groups([s for s, _ in made], step)
            out: list[list] = [[] for _ in range(9)]
            for (size, pieces), g in zip(made, groups, strict=True):
                at = 0
                for length, (doc, start) in pieces:
                    ident, ids, left = held[doc]
                    for x, v in zip(out, (ident, start, length, ids[4 * start : 4 * (start + length)], len(ids) // 4, sequence, at, size, group + g), strict=True):
                        x.append(v)
                    at += length
                    if left == length:
                        del held[doc]
                    else:
                        held[doc] = (ident, ids, left - length)
                sequence += 1
            group += max(groups, default=-1) + 1
            for a in range(0, len(out[0]), 2000):
                yield pa.RecordBatch.from_arrays([pa.array(out[0][a : a + 2000], kind), *(pa.array(x[a : a + 2000], k) for x, k in zip(out[1:], kinds, strict=True))], names)

        kind = None
        for batch in batches:
            kind = batch.schema.field(0).type
            for ident, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids = encode(text or "") + end
                n = len(ids) // 4
                held[number] = (ident, ids, n)
                full = n - n % longest
                whole += [(longest, [(longest, (number, a))]) for a in range(0, full, longest)]
                waiting.add(n - full, (number, full))
                number += 1
                arrived += n
                if arrived >= pool:
                    yield from flush(False)
                    arrived = 0
        if kind is not None:
            yield from flush(True)

    fields = [T.LongType(), T.LongType(), T.BinaryType(), T.LongType(), T.LongType(), T.LongType(), T.IntegerType(), T.LongType()]
    schema = T.StructType([T.StructField("_id", docs.schema[id_col].dataType), *(T.StructField(n, k) for n, k in zip(names[1:], fields, strict=True))])
    return docs.select(col(id_col).alias("_id"), col(text_col).alias("_text")).mapInArrow(run, schema).withColumnRenamed("_id", id_col)


def pieces(docs: DataFrame) -> DataFrame:
    """The packing of the public byte-level BPE's ids, with a checksum for each piece's ids."""
    got = pack(docs, vocabulary_path("byte_bpe_50k.json"))
    return got.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "context", "step_group")


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces(table(spark, sf_dir, "documents"))
