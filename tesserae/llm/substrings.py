"""Substring deduplication by level-wise doubling."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import words as W
from .common import chunk_count, chunked, end_to_end, table, text_bytes, texts_of
from .tally import ASKS, Keys, among, read_heard, sizes, tally


def lengths(window: int, first: int) -> list[int]:
    """The lengths at which windows are counted, each at most twice the one before: 9, 18, 35 for 35."""
    out = [window]
    while out[-1] > first and out[-1] > 1:
        out.append(-(-out[-1] // 2))
    return out[::-1]


def _chain(length: int) -> list[int]:
    return lengths(length, 1)


def window_hashes(h: np.ndarray, length: int) -> np.ndarray:
    """The hash of each window of so many words: two overlapping windows of half the length make one."""
    at = 1
    for n in _chain(length)[1:]:
        h, at = W.joined(h[: max(0, len(h) - (n - at))], h[n - at :], n), n
    return h


def _text_words(texts: list[bytes], window: int, seeds: tuple[int, ...]) -> tuple:
    data, offsets = end_to_end(texts)
    starts, ends, doc = W.spans(data, offsets)
    long = np.bincount(doc, minlength=len(offsets) - 1) >= window
    return [W.hashes(data, starts, ends, s) for s in seeds], doc, long


def _valid(doc: np.ndarray, long: np.ndarray, length: int) -> np.ndarray:
    """Whether a window of so many words from here stays in one document that is long enough for the last level."""
    if len(doc) < length:
        return np.zeros(0, bool)
    return (doc[: len(doc) - length + 1] == doc[length - 1 :]) & long[doc[: len(doc) - length + 1]]


def _sent(chunk: int, keys: Keys, one: np.ndarray, two: np.ndarray | None = None) -> pa.Table:
    """Asks for each different key once, or twice if the chunk itself repeats it."""
    cut = keys.cut(one)
    order = np.lexsort((two, cut)) if keys.wide else np.argsort(cut, kind="stable")
    cut = cut[order]
    second = two[order] if keys.wide else None
    same = np.zeros(len(cut), bool)
    if len(cut) > 1:
        same[1:] = cut[1:] == cut[:-1]
        if keys.wide:
            same[1:] &= second[1:] == second[:-1]
    third = np.zeros(len(cut), bool)
    third[2:] = same[2:] & same[1:-1]
    return keys.rows(chunk, cut[~third], second[~third] if keys.wide else None)


def substring_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 35, first: int = 9) -> DataFrame:
    """Removes each word that lies in a window of `window` words whose sequence also starts elsewhere in the corpus.

    Windows of about `first` words are counted over the corpus; those that are repeated are extended to twice that length and
    counted again, up to `window`. Only windows whose two halves are repeated are counted at the next length. The last count is
    on 96 bits of hash. Words are unchanged; all windows are judged on the input.

    Returns id_col, n_words, n_removed and text (the kept words joined by one space), a row for each row of docs. A null or
    empty text has no words and gives an empty text; a text shorter than a window keeps all; equal texts remove each other's
    windows, so of a repeated row no copy stays; a null or repeated id is kept as it is; an empty table gives an empty one.
    Other columns are ignored. No word is looked up beyond its own chunk but through the counts, so no key gathers its rows.
    """
    total = text_bytes(docs, text_col)
    parts = chunked(docs, id_col, text_col, chunk_count(total))
    steps = lengths(window, first)
    bits, width = sizes(total)
    kinds = [Keys(bits, 8, wide=True) if i == len(steps) - 1 else Keys(bits, width) for i in range(len(steps))]
    seeds = (1, 2)

    def windows(texts: list[bytes], level: int, heard: np.ndarray | None) -> tuple:
        """Hashes at a level, both kinds if they are needed, and which windows' halves are repeated."""
        n, keys = steps[level], kinds[level]
        (h, *more), doc, long = _text_words(texts, window, seeds if keys.wide else seeds[:1])
        ok = _valid(doc, long, n)
        if level:
            back = steps[level - 1]
            half = window_hashes(h, back)
            repeated = among(kinds[level - 1].cut(half), heard)
            ok = ok & repeated[: len(ok)] & repeated[n - back : n - back + len(ok)] if len(ok) else ok
        return ok, window_hashes(h, n), window_hashes(more[0], n) if keys.wide else None, doc

    def asked(level: int):
        def ask(key: tuple, group: pa.Table, told: pa.Table | None = None) -> pa.Table:
            heard = read_heard(told, kinds[level - 1])[0] if level else None
            ok, one, two, _ = windows(texts_of(group["_text"]), level, heard)
            return _sent(key[0].as_py(), kinds[level], one[ok], (two[ok] >> np.uint64(32)).astype(np.uint32) if two is not None else None)

        return ask if level else lambda key, group: ask(key, group)

    def kept(key: tuple, group: pa.Table, told: pa.Table) -> pa.Table:
        n, texts = steps[-1], texts_of(group["_text"])
        (h,), doc, _ = _text_words(texts, window, seeds[:1])
        hit = np.flatnonzero(among(kinds[-1].cut(window_hashes(h, n)), read_heard(told, kinds[-1])[0])) if len(doc) >= n else np.zeros(0, np.int64)
        at = hit[doc[hit] == doc[hit + n - 1]]
        steps_up = np.zeros(len(doc) + 1, np.int64)
        np.add.at(steps_up, at, 1)
        np.add.at(steps_up, at + n, -1)
        gone = np.cumsum(steps_up[:-1]) > 0
        n_words, n_gone = np.bincount(doc, minlength=len(texts)), np.bincount(doc[gone], minlength=len(texts))
        ends = np.cumsum(n_words)
        left = []
        for i, text in enumerate(texts):
            own = text.split()
            if n_gone[i]:
                mask = gone[ends[i] - n_words[i] : ends[i]]
                own = [w for w, out in zip(own, mask.tolist(), strict=True) if not out]
            left.append(b" ".join(own).decode())
        return pa.table({id_col: group["_id"], "n_words": pa.array(n_words, pa.int64()), "n_removed": pa.array(n_gone, pa.int64()), "text": pa.array(left, pa.string())})

    told = tally(parts.groupBy("_chunk").applyInArrow(asked(0), ASKS), kinds[0])
    for level in range(1, len(steps)):
        told = tally(parts.groupBy("_chunk").cogroup(told.groupBy("_of")).applyInArrow(asked(level), ASKS), kinds[level])
    out = T.StructType([T.StructField(id_col, docs.schema[id_col].dataType), T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()), T.StructField("text", T.StringType())])
    return parts.groupBy("_chunk").cogroup(told.groupBy("_of")).applyInArrow(kept, out)


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = substring_dedup(table(spark, sf_dir, "documents"))
    return got.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))
