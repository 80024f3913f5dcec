"""Counting keys across chunks: each chunk asks once for each of its keys, and hears which are frequent in the corpus.

Rows of keys travel as packed bytes, one row for each chunk and bucket of the key space, so a shuffle moves a few bytes for
each key and no key, however frequent, arrives more often than twice from a chunk.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

ASKS = "_chunk long, _bucket long, _keys binary, _counts binary"
HEARD = "_of long, _keys binary, _counts binary"


@dataclass(frozen=True)
class Keys:
    """How keys travel: 2**bits buckets, and below them width bytes of a key's 64 bits; wide: and 32 bits of a second hash."""

    bits: int
    width: int
    wide: bool = False

    def cut(self, key: np.ndarray) -> np.ndarray:
        """The leading bits of each key that are kept."""
        drop = 64 - self.bits - 8 * self.width
        return key >> np.uint64(drop) if drop > 0 else key

    @property
    def low(self) -> int:
        return min(8 * self.width, 64 - self.bits)

    def rows(self, chunk: int, cut: np.ndarray, second: np.ndarray | None = None, counts: np.ndarray | None = None) -> pa.Table:
        """One row for each bucket. cut is in ascending order."""
        at = np.flatnonzero(np.diff(cut >> np.uint64(self.low), prepend=np.uint64(2**64 - 1)) != 0) if len(cut) else np.zeros(0, np.int64)
        ends = [*at[1:].tolist(), len(cut)] if len(cut) else []
        raw = np.ascontiguousarray(np.ascontiguousarray(cut, "<u8").view(np.uint8).reshape(-1, 8)[:, : self.width]) if len(cut) else np.zeros((0, self.width), np.uint8)
        if self.wide:
            raw = np.hstack([raw, np.ascontiguousarray(second, "<u4").view(np.uint8).reshape(-1, 4)]) if len(cut) else raw
        spans = list(zip(at.tolist(), ends, strict=True))
        return pa.table(
            {
                "_chunk": pa.array([chunk] * len(spans), pa.int64()),
                "_bucket": pa.array((cut[at] >> np.uint64(self.low)).astype(np.int64).tolist() if len(cut) else [], pa.int64()),
                "_keys": pa.array([raw[a:b].tobytes() for a, b in spans], pa.binary()),
                "_counts": pa.array([b"" if counts is None else np.minimum(counts[a:b], 65535).astype("<u2").tobytes() for a, b in spans], pa.binary()),
            }
        )

    def unpack(self, bucket: int, raw: bytes) -> tuple[np.ndarray, np.ndarray | None]:
        rows = np.frombuffer(raw, np.uint8).reshape(-1, self.width + 4 * self.wide)
        low = np.zeros((len(rows), 8), np.uint8)
        low[:, : self.width] = rows[:, : self.width]
        key = low.view("<u8").ravel()
        if self.low < 8 * self.width:
            key = key & np.uint64((1 << self.low) - 1)
        second = np.ascontiguousarray(rows[:, self.width :]).view("<u4").ravel() if self.wide else None
        return key | np.uint64(bucket << self.low), second


def sizes(total_bytes: int, spare: int = 10) -> tuple[int, int]:
    """Bits for the buckets, about 16 MB of text each, and bytes for a key, so that one key in 2**spare is taken for another."""
    bits = max(3, (max(1, total_bytes >> 24) - 1).bit_length())
    need = max(1, total_bytes // 6).bit_length() + spare - bits
    return bits, min(8, max(2, -(-need // 8)))


def scaled(n: np.ndarray) -> np.ndarray:
    """Numbers from 1 on by their logarithm, in order, within 16 bits; 0 for 1 alone."""
    return np.minimum(1600 * np.log2(n), 65535).astype(np.int64)


def unscaled(n: np.ndarray) -> np.ndarray:
    return np.exp2(n / 1600)


def tally(asks: DataFrame, keys: Keys, least: int = 2) -> DataFrame:
    """For each chunk that asked: its keys that all chunks together have least times or more, and where counts were given (up to 65535 of a chunk) that number, scaled().

    Without counts a key counts once for each time that it is sent. Second hashes are counted by, but not sent back.
    """
    back = replace(keys, wide=False)

    def heard(key: tuple, group: pa.Table) -> pa.Table:
        bucket = key[0].as_py()
        parts = [keys.unpack(bucket, x) for x in group["_keys"].to_pylist()]
        sent = group["_counts"].to_pylist()
        one = np.concatenate([x[0] for x in parts])
        weight = np.concatenate([np.frombuffer(c, "<u2") if c else np.ones(len(p[0]), np.uint16) for c, p in zip(sent, parts, strict=True)]).astype(np.int64)
        if keys.wide:
            two = np.concatenate([x[1] for x in parts])
            order = np.lexsort((two, one))
            new = np.diff(one[order], prepend=one[order][:1]) != 0
            new[1:] |= two[order][1:] != two[order][:-1]
        else:
            order = np.argsort(one, kind="stable")
            new = np.diff(one[order], prepend=one[order][:1]) != 0
        group_of = np.cumsum(new)
        total = np.zeros(len(one), np.int64)
        total[order] = np.bincount(group_of, weights=weight[order]).astype(np.int64)[group_of]
        out: dict[str, list] = {"_of": [], "_keys": [], "_counts": []}
        at = 0
        for chunk, part, counts in zip(group["_chunk"].to_pylist(), parts, sent, strict=True):
            mine = total[at : at + len(part[0])]
            keep = mine >= least
            at += len(mine)
            if keep.any():
                kept = back.rows(chunk, part[0][keep])
                out["_of"].append(chunk)
                out["_keys"].append(bucket.to_bytes(8, "little") + kept["_keys"][0].as_py())
                out["_counts"].append(scaled(mine[keep]).astype("<u2").tobytes() if counts else b"")
        return pa.table(out, pa.schema([("_of", pa.int64()), ("_keys", pa.binary()), ("_counts", pa.binary())]))

    return asks.groupBy("_bucket").applyInArrow(heard, HEARD)


def read_heard(group: pa.Table, keys: Keys) -> tuple[np.ndarray, np.ndarray]:
    """The keys that a chunk hears of in ascending order, and the scaled numbers where counts were given."""
    back = replace(keys, wide=False)
    parts = [(back.unpack(int.from_bytes(x[:8], "little"), x[8:])[0], np.frombuffer(c, "<u2")) for x, c in zip(group["_keys"].to_pylist(), group["_counts"].to_pylist(), strict=True)]
    if not parts:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint16)
    one, count = np.concatenate([x[0] for x in parts]), np.concatenate([x[1] for x in parts])
    order = np.argsort(one, kind="stable")
    return one[order], count[order] if len(count) else count


def among(key: np.ndarray, heard: np.ndarray) -> np.ndarray:
    """Whether each key is one of those heard, which ascend."""
    if not len(heard):
        return np.zeros(len(key), bool)
    return heard[np.minimum(np.searchsorted(heard, key), len(heard) - 1)] == key
