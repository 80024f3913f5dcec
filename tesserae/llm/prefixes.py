"""What the set-similarity joins share: how frequent tokens are, and which sets of a token's list may be similar."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Slots of the table of frequencies: tokens share one by the leading bits of their hash, which changes the work and never the result.
SLOT_BITS, PIECE_BITS = 24, 16
#: Rows of a run that are compared whole at once, and candidates that a row of a longer run looks for before these are verified.
SHORT, KEPT = 32, 3
#: Tables of counts that one task adds up before they are added again.
ADDED = 4096
COUNTS = "piece int, part long, slots binary, counts binary"
_EPS = 1e-9


class Counter:
    """Counts of tokens by slot, in one task."""

    def __init__(self) -> None:
        self.n = np.zeros(1 << SLOT_BITS, np.uint32)

    def add(self, slots: np.ndarray) -> None:
        slots = np.sort(slots)
        at = np.flatnonzero(np.diff(slots, prepend=np.uint64(2**64 - 1)))
        self.n[slots[at].astype(np.int64)] += np.diff(at, append=len(slots)).astype(np.uint32)

    def rows(self, part: int) -> pa.RecordBatch:
        return _packed({int(p): self.n[int(p) << PIECE_BITS : (int(p) + 1) << PIECE_BITS] for p in np.unique(np.flatnonzero(self.n) >> PIECE_BITS)}, part)


def _packed(pieces: dict[int, np.ndarray], part: int) -> pa.RecordBatch:
    slots, counts = [], []
    for n in pieces.values():
        at = np.flatnonzero(n)
        slots.append(planes(np.diff(at, prepend=0).astype("<u2")))
        counts.append(planes(n[at].astype("<u4")))
    return pa.RecordBatch.from_arrays([pa.array(list(pieces), pa.int32()), pa.array([part] * len(pieces), pa.int64()), pa.array(slots, pa.binary()), pa.array(counts, pa.binary())], ["piece", "part", "slots", "counts"])


def _added(batches: Iterator[pa.RecordBatch]) -> dict[int, np.ndarray]:
    pieces: dict[int, np.ndarray] = {}
    for batch in batches:
        for piece, _, slots, counts in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            at = np.cumsum(records(slots, np.dtype("<u2")).astype(np.int64))
            pieces.setdefault(piece, np.zeros(1 << PIECE_BITS, np.uint64))[at] += records(counts, np.dtype("<u4"))
    return pieces


def frequencies(counts: DataFrame) -> np.ndarray:
    """For each slot the logarithm of how many tokens fell on it, in eighths, 0 for one or none: a byte each, so of one size for any corpus.

    counts are the rows of the tasks' Counter. They are added up as a stream, in two steps where there are many.
    """

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield _packed({p: np.minimum(n, 2**32 - 1) for p, n in _added(batches).items()}, 0)

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece, n in _added(batches).items():
            steps = np.round(8 * np.log2(np.maximum(n, 1).astype(np.float64)))
            yield pa.RecordBatch.from_arrays([pa.array([piece], pa.int32()), pa.array([np.minimum(steps, 255).astype(np.uint8).tobytes()], pa.binary())], ["piece", "logs"])

    parts = -(-counts.select("part").distinct().count() // ADDED)
    if parts > 1:
        counts = counts.withColumn("part", F.pmod(F.xxhash64("part"), F.lit(parts))).repartition("piece", "part").mapInArrow(add, COUNTS)
    found = counts.repartition("piece").mapInArrow(finish, "piece int, logs binary").toArrow()  # a byte a slot: 16 MB
    logs = np.zeros(1 << SLOT_BITS, np.uint8)
    for piece, raw in zip(found["piece"].to_pylist(), found["logs"].to_pylist(), strict=True):
        logs[piece << PIECE_BITS : (piece + 1) << PIECE_BITS] = np.frombuffer(raw, np.uint8)
    return logs


def blocks(logs: np.ndarray, run: int) -> np.ndarray:
    """Over how many blocks the rows of tokens so frequent are dealt."""
    return np.maximum(1, np.ceil(np.exp2(logs / 8) / run)).astype(np.int64)


def meetings(own: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows of n blocks each, of block own: which row goes to which pair of blocks, so that any two rows meet in one pair at least."""
    which = np.repeat(np.arange(len(n)), n)
    j = np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n)
    own, n = own[which], n[which]
    return which, np.minimum(j, own) * n + np.maximum(j, own)


def planes(rows: np.ndarray) -> bytes:
    """Records, byte by byte of each kind side by side, compressed by zstandard: most planes are nearly constant, which LZ4 of the shuffle cannot use."""
    return zstandard.compress(np.ascontiguousarray(rows.view(np.uint8).reshape(len(rows), rows.itemsize).T).tobytes(), 1)


def records(raw: bytes, kind: np.dtype) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(zstandard.decompress(raw), np.uint8).reshape(kind.itemsize, -1).T).view(kind).ravel()


def meet(n: np.ndarray, pos: np.ndarray, run: np.ndarray, least: float, kept: int | None, parities: tuple[np.ndarray, ...] = (), group: np.ndarray | None = None, asks: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs (y, x) of rows of one run, x before y, that may be of similarity `least`; and which rows had more than `kept`.

    A row is a set of n tokens whose token of this run stands at pos in the common order. Two similar sets meet at the first token
    that they share, with no more in common than what follows there: that is the positional filter. Two sets differ in at least as
    many tokens as their parities differ in bits. run ascends. In a run of over SHORT rows a row stops once it has found more than
    `kept`. Given groups, pairs within a group are left out; given asks, only rows that ask are y.
    """
    found, more = [(np.zeros(0, np.int64),) * 2], np.zeros(len(n), bool)
    n, pos = n.astype(np.int64), pos.astype(np.int64)
    left = n - pos

    def fit(y: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        both, ok = n[y] + n[x], (1 + least) * np.minimum(left[y], left[x]) + _EPS
        ok = ok >= least * both
        y, x, both = y[ok], x[ok], both[ok]  # length follows: what is left is no more than the smaller
        if parities and len(y):
            apart = sum(np.bitwise_count(p[y] ^ p[x]).astype(np.int64) for p in parities)
            ok = (1 + least) * apart <= (1 - least) * both + _EPS
            y, x = y[ok], x[ok]
        if group is not None:
            ok = group[y] != group[x]
            y, x = y[ok], x[ok]
        return y, x

    _, first, size = np.unique(run, return_index=True, return_counts=True)
    length = np.repeat(size, size)
    for d in range(1, SHORT):
        y = np.flatnonzero((run[d:] == run[:-d]) & (length[d:] <= SHORT)) + d if len(run) > d else found[0][0]
        if not len(y):
            break
        y = y if asks is None else y[asks[y]]
        found.append(fit(y, y - d))
    for a, m in zip(first[size > SHORT].tolist(), size[size > SHORT].tolist(), strict=True):
        had, waiting = np.zeros(m, np.int64), np.arange(m)
        waiting = waiting if asks is None else waiting[asks[a : a + m]]
        for s in range(0, m, 64):
            waiting = waiting[waiting > s]
            for t in range(0, len(waiting), 4096):
                rows = waiting[t : t + 4096]
                y, x = np.repeat(rows, min(64, m - s)), np.tile(np.arange(s, min(m, s + 64)), len(rows))
                y, x = fit(a + y[x < y], a + x[x < y])
                if kept is not None and len(y):
                    nth = np.arange(len(y)) - np.searchsorted(y, y) + had[y - a]
                    more[y[nth >= kept]] = True
                    np.add.at(had, y - a, 1)
                    y, x = y[nth < kept], x[nth < kept]
                found.append((y, x))
            waiting = waiting[had[waiting] <= kept] if kept is not None else waiting
    return (*(np.concatenate(c) for c in zip(*found, strict=True)), more)
