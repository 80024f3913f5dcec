"""Approximate nearest neighbours by multiprobe p-stable hashing."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from math import erf, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import col, table, written

#: Rows of the fit's sample, rows of a block, queries of a group.
SAMPLE, BLOCK_ROWS, GROUP_QUERIES = 4096, 8192, 20_000
#: Tables, functions of each, cells of a function, and the recall on the sample that probing is set to.
TABLES, FUNCTIONS, CELLS, AIM = 2, 6, 4, 0.97

_erf = np.frompyfunc(erf, 1, 1)


def normal(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + _erf(x / sqrt(2)).astype(float))


@dataclass(frozen=True)
class Index:
    """p-stable functions floor((a . x + b) / w), the outer cells open; how a neighbour's projection follows from a query's; and until what estimated success a query visits cells."""

    a: np.ndarray  # dimensions x (tables * functions)
    edges: np.ndarray  # (tables * functions) x (CELLS - 1)
    slope: np.ndarray
    spread: np.ndarray
    until: float
    tables: int

    @property
    def per_table(self) -> int:
        return CELLS ** (self.a.shape[1] // self.tables)

    def cells(self, x: np.ndarray) -> np.ndarray:
        """rows x tables: the number of the cell, over all tables."""
        p = x @ self.a
        digits = np.stack([np.searchsorted(e, p[:, i], "right") for i, e in enumerate(self.edges)], 1)
        m = digits.shape[1] // self.tables
        base = CELLS ** np.arange(m)
        return np.stack([digits[:, t * m : (t + 1) * m] @ base + t * self.per_table for t in range(self.tables)], 1)

    def success(self, q: np.ndarray) -> list[np.ndarray]:
        """For each table: the estimated probability that a neighbour of q lies in each cell."""
        mean = (q @ self.a) * self.slope
        bounds = normal((self.edges - mean[:, None]) / self.spread[:, None])
        p = np.diff(np.hstack([np.zeros((len(bounds), 1)), bounds, np.ones((len(bounds), 1))]), axis=1)
        m = len(p) // self.tables
        out = []
        for t in range(self.tables):
            all_of = np.ones(1)
            for i in range(m):
                all_of = (p[t * m + i][:, None] * all_of[None, :]).ravel()
            out.append(all_of)
        return out

    def visited(self, q: np.ndarray, until: float | None = None) -> np.ndarray:
        """The cells that q visits, of each table the likeliest first until their success adds up."""
        until, out = self.until if until is None else until, []
        for t, p in enumerate(self.success(q)):
            order = np.argsort(-p, kind="stable")
            n = len(p) if until >= 1 else int(np.searchsorted(np.cumsum(p[order]), until)) + 1
            out.append(order[:n] + t * self.per_table)
        return np.concatenate(out)


def fit(x: np.ndarray, k: int, seed: int = 7) -> Index:
    """An index for vectors like those of the sample x; probing is the least that finds AIM of the sample's own neighbours."""
    rng = np.random.default_rng(seed)
    a = rng.standard_normal((x.shape[1], TABLES * FUNCTIONS))
    p = x @ a
    width = np.maximum(p.std(0) * 1.1, 1e-12)
    middle = np.median(p, 0) + (rng.random(p.shape[1]) - 0.5) * width
    edges = middle[:, None] + width[:, None] * (np.arange(CELLS - 1) - (CELLS - 2) / 2)[None, :]
    q = x[: min(256, len(x))]
    d = (q**2).sum(1)[:, None] + (x**2).sum(1)[None, :] - 2 * q @ x.T
    d[np.arange(len(q)), np.arange(len(q))] = np.inf
    near = np.argsort(d, 1)[:, : min(k, len(x) - 1)]
    if not near.size:
        return Index(a, edges, np.ones(p.shape[1]), np.ones(p.shape[1]), 1.0, TABLES)
    mine, theirs = p[: len(q)].repeat(near.shape[1], 0), p[near.ravel()]
    slope = (mine * theirs).sum(0) / np.maximum((mine**2).sum(0), 1e-300)
    spread = np.maximum((theirs - slope * mine).std(0), 1e-9 + width * 1e-3)
    for until in (0.3, 0.4, 0.5, 0.6, 0.7, 0.75, 0.8, 0.85, 0.9, 0.93, 0.95, 0.97, 0.99):
        index = Index(a, edges, slope, spread, until, TABLES)
        cells = index.cells(x)
        found = 0
        for i in range(len(q)):
            seen = np.zeros(TABLES * index.per_table, bool)
            seen[index.visited(q[i])] = True
            found += seen[cells[near[i]]].any(1).sum()
        if found >= AIM * near.size:
            return index
    return Index(a, edges, slope, spread, 1.0, TABLES)


def usable(vector: Column, size: int) -> Column:
    finite = F.forall(vector, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < F.lit(float("inf"))))
    return vector.isNotNull() & (F.size(vector) == size) & finite & F.exists(vector, lambda e: e != 0)


def _matrix(column: pa.ChunkedArray | pa.Array, size: int) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, size)


def search_block(ids: np.ndarray, x: np.ndarray, cells: np.ndarray, query_ids: list[int], q: np.ndarray, visits: list[np.ndarray], k: int) -> list[tuple[int, int, float]]:
    """The k nearest of a block's rows that lie in a query's cells, by exact distance, ties to the smaller id."""
    out = []
    known, at = np.unique(cells, return_inverse=True)
    squares = (x**2).sum(1)
    for i, ident in enumerate(query_ids):
        seen = np.isin(known, visits[i])[at] & (ids != ident)
        rows = np.flatnonzero(seen)
        if not len(rows):
            continue
        about = squares[rows] - 2 * (x[rows] @ q[i]) + q[i] @ q[i]
        if len(rows) > k:
            limit = np.partition(about, k - 1)[k - 1]
            rows = rows[about <= limit + 1e-9 * (squares[rows] + q[i] @ q[i])]
        d = np.sqrt(((x[rows] - q[i]) ** 2).sum(1))
        for j in np.lexsort((ids[rows], d))[:k].tolist():
            out.append((ident, int(ids[rows[j]]), float(d[j])))
    return out


def nearest(rows: DataFrame, queries: DataFrame, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """For each row of queries its k nearest rows by Euclidean distance: query_id, rank from 1, vec_id, score.

    Two tables of p-stable functions, fitted on a sample of up to 4096 rows, hash every row. A query visits each table's cells in
    the order of their estimated success, until it adds up to what found 97 % of the neighbours within the sample, and the
    candidates of both tables are ranked by exact distance. A query that found fewer than k in its cells is compared with all rows. Rows are dealt in blocks of about 8192, crowded cells over several.

    Distance is in double precision on the original vectors, ties go to the smaller id, and a query's own id is no candidate. Of
    equal vectors only the k + 1 smallest ids are indexed, as no other can be among the nearest. Vectors that are null, all zero,
    of another length than most, or hold null or non-finite components take no part, nor do rows with a null id; rows of equal
    id count as one; a query with fewer candidates gets all; empty tables give no rows. Other columns are ignored.
    """
    spark = rows.sparkSession
    size = rows.where(col(vector_col).isNotNull() & col(id_col).isNotNull()).agg(F.mode(F.size(col(vector_col)))).first()[0]
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    if not size:
        return empty

    def plain(df: DataFrame) -> DataFrame:
        v = col(vector_col)
        return df.where(usable(v, size) & col(id_col).isNotNull()).select(col(id_col).cast("long").alias("_id"), v.cast("array<double>").alias("_v"))

    copies = Window.partitionBy("_v").orderBy("_id")
    indexed = plain(rows).withColumn("_copy", F.row_number().over(copies)).where(F.col("_copy") <= k + 1).drop("_copy")
    sample = indexed.orderBy(F.xxhash64("_id"), "_id").limit(SAMPLE).collect()
    n_queries = plain(queries).count()
    if not sample or not n_queries:
        return empty
    index = fit(np.array([r["_v"] for r in sample]), k)

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells = index.cells(_matrix(batch.column(1), size))
            for t in range(index.tables):
                yield pa.RecordBatch.from_arrays([pa.array(cells[:, t], pa.int64()), batch.column(0), batch.column(1)], ["_cell", "_id", "_v"])

    in_cells = indexed.mapInArrow(hashed, "_cell long, _id long, _v array<double>")
    held = dict(in_cells.groupBy("_cell").count().collect())  # at most tables * CELLS ** FUNCTIONS rows
    first, salts, block, filled, before = {}, {}, 0, 0, -1
    for cell in sorted(held):
        n = -(-held[cell] // BLOCK_ROWS)
        if n > 1 or filled + held[cell] > BLOCK_ROWS or cell // index.per_table != before:  # a block holds a row once
            block, filled, before = block + (filled > 0), 0, cell // index.per_table
        first[cell], salts[cell] = block, n
        block, filled = (block + n, 0) if n > 1 else (block, filled + held[cell])
    def searched(asked: DataFrame, n: int, everywhere: bool) -> DataFrame:
        """(query_id, vec_id, score): what the queries find in the cells that they visit, or among all rows, which are all in the first table."""
        groups = -(-n // GROUP_QUERIES)
        all_cells = np.arange(index.per_table)
        left = in_cells.where(F.col("_cell") < index.per_table) if everywhere else in_cells
        left = left.mapInArrow(to_blocks(groups), "_block long, _group long, _cell long, _id long, _v array<double>")
        right = asked.mapInArrow(probes(groups, (lambda v: all_cells) if everywhere else index.visited), "_at long, _of long, _query long, _q array<double>, _cells binary")
        return left.groupBy("_block", "_group").cogroup(right.groupBy("_at", "_of")).applyInArrow(search, "query_id long, vec_id long, score double")

    def to_blocks(groups: int):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                cell, ids = batch.column(0).to_pylist(), batch.column(1).to_pylist()
                where = pa.array([first[c] + (i * 2654435761 >> 16) % salts[c] for c, i in zip(cell, ids, strict=True)], pa.int64())
                for g in range(groups):
                    yield pa.RecordBatch.from_arrays([where, pa.array([g] * len(ids), pa.int64()), *batch.columns], ["_block", "_group", "_cell", "_id", "_v"])

        return run

    def probes(groups: int, visited):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for ident, v in zip(batch.column(0).to_pylist(), _matrix(batch.column(1), size), strict=True):
                    to: dict[int, list[int]] = {}
                    for c in visited(v).tolist():
                        if c in first:
                            for b in range(first[c], first[c] + salts[c]):
                                to.setdefault(b, []).append(c)
                    out = [(b, ident % groups, ident, v, np.array(cells, "<i4").tobytes()) for b, cells in to.items()]
                    for a in range(0, len(out), 1000):
                        b, g, i, q, c = zip(*out[a : a + 1000], strict=True)
                        yield pa.RecordBatch.from_arrays([pa.array(b, pa.int64()), pa.array(g, pa.int64()), pa.array(i, pa.int64()), pa.array(list(q), pa.list_(pa.float64())), pa.array(c, pa.binary())], ["_at", "_of", "_query", "_q", "_cells"])

        return run

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        found = []
        if len(left) and len(right):
            visits = [np.frombuffer(c, "<i4") for c in right["_cells"].to_pylist()]
            found = search_block(left["_id"].to_numpy(), _matrix(left["_v"], size), left["_cell"].to_numpy(), right["_query"].to_pylist(), _matrix(right["_q"], size), visits, k)
        q, v, s = zip(*found, strict=True) if found else ((), (), ())
        return pa.table({"query_id": pa.array(q, pa.int64()), "vec_id": pa.array(v, pa.int64()), "score": pa.array(s, pa.float64())})

    found = written(searched(plain(queries), n_queries, False), "found")
    enough = found.groupBy("query_id").agg(F.count_distinct("vec_id").alias("_n")).where(F.col("_n") >= k)
    short = written(plain(queries).join(enough, F.col("_id") == F.col("query_id"), "left_anti"), "short-lists")
    n_short = short.count()
    if n_short:
        found = found.unionByName(searched(short, n_short, True))
    best = found.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return best.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op10_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    return nearest(rows, rows.where(F.col("vec_id") % 100 == 0))
