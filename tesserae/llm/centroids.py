"""Centroid clustering by Yinyang grouping: exact k-means over integer vectors that scans few centroids."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import col, get_rows, make_folder, new_folder, put_rows, table, written

#: Vectors of one block; centroids of one group; rounds of grouping.
BLOCK, GROUP_SIZE, GROUPING_ROUNDS = 1 << 12, 10, 5
#: Blocks of one task, from where on all cores have some.
TASK_BLOCKS = 64
#: Integer components are held within these, so that a squared distance of 64 components fits a long.
LIMIT = 1 << 27
#: What rounding may do to a bound, as a part of it: a bound filters only where it holds by more.
SLACK = 1e-9
STATE = "_file string, _state binary, _moved array<long>, _scans long"


@dataclass
class Clusters:
    """Rows of the id, cluster and distance; the final centroids; the sum of distances of each cluster; the distances computed in each pass."""

    rows: DataFrame
    centroids: np.ndarray
    inertia: list[int]
    scans: list[int]


@dataclass
class Start:
    """What a task needs of the centroids: now and before, and the group of each."""

    now: np.ndarray
    before: np.ndarray | None
    group: np.ndarray

    @property
    def groups(self) -> int:
        return int(self.group.max()) + 1 if len(self.group) else 0


def squared(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact squared distances of integer rows x to integer rows c: through floating point while all sums stay below 2^53."""
    if max(int(np.abs(x).max(initial=0)), int(np.abs(c).max(initial=0))) ** 2 * 4 * max(x.shape[1], 1) < 1 << 53:
        a, b = x.astype(np.float64), c.astype(np.float64)
        return ((a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2 * (a @ b.T)).astype(np.int64)
    return np.stack([((x - y) ** 2).sum(1) for y in c], 1) if len(c) else np.zeros((len(x), 0), np.int64)


def groups_of(centroids: np.ndarray, size: int = GROUP_SIZE) -> np.ndarray:
    """The group of each centroid: the centroids themselves clustered, once, into one group for so many of them."""
    k = len(centroids)
    heads = centroids[: max(1, k // size)].astype(np.float64)
    for _ in range(GROUPING_ROUNDS):
        near = ((centroids[:, None, :] - heads[None]) ** 2).sum(2).argmin(1)
        heads = np.stack([centroids[near == g].mean(0) if (near == g).any() else heads[g] for g in range(len(heads))])
    return np.unique(near, return_inverse=True)[1] if k else np.zeros(0, np.int64)


@dataclass
class State:
    """For each vector of a block its centroid, an upper bound of its distance to that, and for each group a lower bound of the distance to the group's other centroids."""

    near: np.ndarray
    upper: np.ndarray
    lower: np.ndarray

    def packed(self) -> bytes:
        return self.near.astype("<i4").tobytes() + self.upper.astype("<f8").tobytes() + self.lower.astype("<f8").tobytes()

    @staticmethod
    def of(data: bytes, groups: int) -> State:
        n = len(data) // (4 + 8 + 8 * groups)
        return State(np.frombuffer(data, "<i4", n).astype(np.int64), np.frombuffer(data, "<f8", n, 4 * n).copy(), np.frombuffer(data, "<f8", n * groups, 12 * n).reshape(n, groups).copy())


def assigned(x: np.ndarray, held: State | None, start: Start) -> tuple[State, int]:
    """Each row of x with its nearest centroid (ties: the smaller number), by the bounds of the round before; and the number of distances computed."""
    n, groups = len(x), start.groups
    members = [np.flatnonzero(start.group == g) for g in range(groups)]
    if held is None:
        near, best = np.zeros(n, np.int64), np.full(n, np.iinfo(np.int64).max)
        lower, todo, scans = np.zeros((n, groups)), np.ones((n, groups), bool), 0
        kept = np.arange(n)
        was, was_at = None, None
    else:
        near, lower = held.near.copy(), held.lower
        drift = np.sqrt(squared(start.now, start.before).diagonal().astype(np.float64)) * (1 + SLACK)
        upper = (held.upper + drift[near]) * (1 + SLACK)
        lower = np.maximum(0, (lower - np.array([drift[m].max() for m in members])[None, :]) * (1 - SLACK))
        # the global filter, first by the bound and then by the distance itself
        kept = np.flatnonzero(upper * (1 + SLACK) >= lower.min(1))
        best = np.zeros(n, np.int64)
        rows = x[kept]
        best[kept] = ((rows - start.now[near[kept]]) ** 2).sum(1)
        scans = len(kept)
        upper[kept] = np.sqrt(best[kept].astype(np.float64)) * (1 + SLACK)
        kept = kept[upper[kept] * (1 + SLACK) >= lower[kept].min(1)]
        # the group filter
        todo = np.zeros((n, groups), bool)
        todo[kept] = upper[kept, None] * (1 + SLACK) >= lower[kept]
        was, was_at = best.copy(), near.copy()
    far = np.full((n, groups), np.inf)
    for g, m in enumerate(members):
        rows = np.flatnonzero(todo[:, g])
        if not len(rows):
            continue
        d = squared(x[rows], start.now[m])
        scans += d.size
        first = d.argmin(1)
        least = d[np.arange(len(rows)), first]
        second = np.partition(d, 1, axis=1)[:, 1] if len(m) > 1 else None
        # of each scanned group the least distance and the next; which of them bounds depends on where the vector ends
        better = (least < best[rows]) | ((least == best[rows]) & (m[first] < near[rows]))
        # what was the best until now becomes an other centroid of its group
        lost = rows[better & (best[rows] < np.iinfo(np.int64).max)]
        np.minimum.at(far, (lost, start.group[near[lost]]), np.sqrt(best[lost].astype(np.float64)))
        here = start.group[near[rows]] == g
        stays = ~better & here  # the assigned one is in this group and stays: its own distance is the least
        bound = least.astype(np.float64)
        use_second = better | stays
        bound[use_second] = second[use_second] if second is not None else np.inf
        far[rows, g] = np.minimum(far[rows, g], np.sqrt(bound))
        near[rows[better]], best[rows[better]] = m[first[better]], least[better]
    lower[todo] = far[todo] * (1 - SLACK)
    if held is None:
        upper = np.sqrt(best.astype(np.float64)) * (1 + SLACK)
    else:
        # the old centroid of a vector that moved is an other one of its group, which may not have been scanned
        moved = np.flatnonzero(near != was_at)
        np.minimum.at(lower, (moved, start.group[was_at[moved]]), np.sqrt(was[moved].astype(np.float64)) * (1 - SLACK))
        upper[kept] = np.sqrt(best[kept].astype(np.float64)) * (1 + SLACK)
    return State(near, upper, lower), scans


def _integers(values: pa.Array, dims: int, scale: int) -> np.ndarray:
    flat = values.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dims)
    return np.clip(np.floor(flat * scale), -LIMIT, LIMIT).astype(np.int64)


def _blocks(rows: DataFrame, folder: str, dims: int, scale: int) -> DataFrame:
    """The names of files of at most BLOCK vectors each, (id, x), written by the tasks that read the vectors: nothing is shuffled."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, BLOCK):
                part = batch.slice(a, BLOCK)
                x = _integers(part.column(1), dims, scale)
                name = f"{uuid.uuid4().hex}.arrow"
                kept = pa.array(x.astype("<i4").ravel())
                put_rows(folder, name, pa.table({"id": part.column(0), "x": pa.FixedSizeListArray.from_arrays(kept, dims)}))
                yield pa.RecordBatch.from_pydict({"_file": pa.array([name])})

    return rows.mapInArrow(write, "_file string")


def _matrix(folder: str, name: str, dims: int) -> tuple[pa.ChunkedArray, np.ndarray]:
    held = get_rows(folder, name)
    return held["id"], held["x"].combine_chunks().flatten().to_numpy().reshape(-1, dims).astype(np.int64)


def _pass(blocks: DataFrame, folder: str, dims: int, start: Start, first: bool, final: bool) -> DataFrame:
    """One assignment of all blocks. _moved adds up to what changes: for each centroid its count and the sums of its vectors, or at the end its sum of distances."""
    k = len(start.now)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                _, x = _matrix(folder, row["_file"], dims)
                held = None if first else State.of(row["_state"], start.groups)
                state, scans = assigned(x, held, start)
                if final:
                    d = ((x - start.now[state.near]) ** 2).sum(1)
                    moved = np.zeros(k, object)
                    np.add.at(moved, state.near, d.astype(object))
                else:
                    moved = np.zeros((k, dims + 1), np.int64)
                    changed = np.flatnonzero(state.near != held.near) if held else np.arange(len(x))
                    ones = np.concatenate([np.ones((len(changed), 1), np.int64), x[changed]], 1)
                    np.add.at(moved, state.near[changed], ones)
                    if held:
                        np.subtract.at(moved, held.near[changed], ones)
                yield pa.RecordBatch.from_pydict({"_file": [row["_file"]], "_state": pa.array([state.packed()], pa.binary()), "_moved": pa.array([[int(v) for v in moved.ravel()]], pa.list_(pa.int64())), "_scans": pa.array([scans], pa.int64())})

    return blocks.mapInArrow(assign, STATE)


def _sums(state: DataFrame, size: int) -> list[int]:
    """The sums of _moved over all blocks: each task adds its own up first, and the driver gets one number for each place."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, object)
        for batch in batches:
            if batch.num_rows:
                total += batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, size).astype(object).sum(0)
        at = [i for i in range(size) if total[i]]
        yield pa.RecordBatch.from_pydict({"at": pa.array(at, pa.int32()), "v": pa.array([str(total[i]) for i in at], pa.string())})

    found = state.select("_moved").mapInArrow(add, "at int, v string").groupBy("at").agg(F.sum(F.col("v").cast("decimal(38,0)")).alias("v")).collect()
    out = [0] * size
    for r in found:
        out[r["at"]] = int(r["v"])
    return out


def yinyang(
    vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", k: int = 40, rounds: int = 5, dims: int = 64, scale: int = 256, salt: str = "2:", group_size: int = GROUP_SIZE
) -> Clusters:
    """Clusters vectors around k centroids exactly.

    Components are floor(scale * x), held within 2^27 on either side. Vectors of another length than dims, null, or with null or non-finite
    components take no part. Centroids start as the k vectors whose salted id has the smallest sha256 (equal ones: the smaller vector first; null
    ids last), fewer if there are fewer vectors. Each round gives every vector to the nearest centroid, ties to the smaller number, and moves each
    that has any to the floor of their mean; then all are assigned once more. Repeated rows are vectors of their own; other columns are ignored; no
    vectors give no rows.

    The centroids are put into groups once. A vector keeps an upper bound of the distance to its centroid and a lower bound for each group. A centroid's
    move shifts the bounds; where the least lower bound lies above the upper one the vector stays without a look at it, else only groups
    whose bound does not lie above are scanned. Bounds are kept with a margin beyond all rounding and comparisons are of integers, so results are those of the plain method.
    Vectors are written once, in blocks; a round reads them and writes 12 bytes and 8 for each group for a vector; sums change by the vectors that moved.
    The driver sees k centroids.
    """
    spark = vectors.sparkSession
    v = col(vec_col).cast("array<double>")
    broken = F.exists("_v", lambda e: e.isNull() | F.isnan(e) | (F.abs(e) == float("inf")))
    rows = vectors.select(col(id_col).alias("_id"), v.alias("_v")).where((F.size("_v") == dims) & ~broken)
    text = F.sha2(F.concat(F.lit(salt), F.coalesce(F.col("_id").cast("string"), F.lit(""))).cast("binary"), 256)
    chosen = rows.orderBy(F.col("_id").isNull(), text, "_v").limit(k).select("_v").collect()
    start = np.clip(np.floor(np.array([r["_v"] for r in chosen], np.float64).reshape(-1, dims) * scale), -LIMIT, LIMIT).astype(np.int64)
    k = len(start)
    out_type = f"`{id_col.replace('`', '``')}` {rows.schema['_id'].dataType.simpleString()}, cluster int, distance long"
    if not k:
        return Clusters(spark.createDataFrame([], out_type), start, [], [])
    folder = new_folder(spark, "vectors")
    make_folder(folder)
    state, group = written(_blocks(rows, folder, dims, scale), "blocks"), groups_of(start, group_size)
    state = state.repartition(max(spark.sparkContext.defaultParallelism, state.count() // TASK_BLOCKS), "_file")  # names alone are moved
    now, before, sums, scans = start, None, [0] * (k * (dims + 1)), []
    for r in range(rounds + 1):
        state = written(_pass(state, folder, dims, Start(now, before, group), r == 0, r == rounds), "assigned")
        scans.append(state.agg(F.sum("_scans")).first()[0])
        if r < rounds:
            sums = [a + b for a, b in zip(sums, _sums(state, len(sums)), strict=True)]
            totals = np.array(sums, object).reshape(k, dims + 1)
            before, now = now, np.array([[s // t[0] for s in t[1:]] if t[0] else list(c) for t, c in zip(totals, now, strict=True)], np.int64)
    name, groups = id_col, int(group.max()) + 1

    def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids, x = _matrix(folder, row["_file"], dims)
                near = State.of(row["_state"], groups).near
                d = ((x - now[near]) ** 2).sum(1)
                yield pa.RecordBatch.from_arrays([pc.cast(ids.combine_chunks(), ids.type), pa.array(near, pa.int32()), pa.array(d, pa.int64())], [name, "cluster", "distance"])

    return Clusters(state.select("_file", "_state").mapInArrow(rows_of, out_type), now, _sums(state, k), scans)


def clustered(vectors: DataFrame, **given) -> DataFrame:
    """The rows of yinyang() with cluster_inertia and inertia (null beyond a long) and centroid_sha256, the digest of the final centroid's components in decimal, joined by commas."""
    found = yinyang(vectors, **given)
    if not found.inertia:
        return found.rows.withColumns({"cluster_inertia": F.lit(None).cast("long"), "inertia": F.lit(None).cast("long"), "centroid_sha256": F.lit(None).cast("string")})
    fits = lambda n: F.lit(n if n < 1 << 63 else None).cast("long")
    at = F.col("cluster") + 1
    digests = [hashlib.sha256(",".join(map(str, map(int, c))).encode()).hexdigest() for c in found.centroids]
    return found.rows.withColumns({"cluster_inertia": F.element_at(F.array(*map(fits, found.inertia)), at), "inertia": fits(sum(found.inertia)), "centroid_sha256": F.element_at(F.array(*map(F.lit, digests)), at)})


def op12_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clustered(table(spark, sf_dir, "embeddings"))


def op12_sql() -> str:
    """The plain method for DuckDB, its rounds unrolled."""
    nearest = "(SELECT x.n, arg_min(c.i, list_sum(list_transform(list_zip(x.x, c.x), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) * 1000 + c.i) AS a FROM v x, {c} c GROUP BY x.n)"
    with_ = ["""v AS MATERIALIZED (SELECT row_number() OVER () AS n, vec_id, list_transform(embedding, lambda e: floor(256 * e::DOUBLE)::HUGEINT) AS x FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda e: e IS NULL OR NOT isfinite(e))) = 0)""",
             "c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256('2:' || vec_id), x) - 1 AS i, x FROM (SELECT vec_id, x FROM v ORDER BY sha256('2:' || vec_id), x LIMIT 40))"]
    for r in range(5):
        with_ += [
            f"a{r} AS MATERIALIZED {nearest.format(c=f'c{r}')}",
            f"m{r} AS (SELECT a AS i, list(q ORDER BY d) AS x FROM (SELECT a, d, (sum(e) - ((sum(e) % count(*)) + count(*)) % count(*)) // count(*) AS q FROM (SELECT a, unnest(x) AS e, unnest(range(64)) AS d FROM v JOIN a{r} USING (n)) GROUP BY a, d) GROUP BY a)",
            f"c{r + 1} AS MATERIALIZED (SELECT c{r}.i, coalesce(m{r}.x, c{r}.x) AS x FROM c{r} LEFT JOIN m{r} USING (i))",
        ]
    with_.append(f"a5 AS MATERIALIZED {nearest.format(c='c5')}")
    return f"""WITH {", ".join(with_)},
d AS (SELECT vec_id, a, list_sum(list_transform(list_zip(v.x, c5.x), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS distance, sha256(array_to_string(c5.x, ',')) AS s FROM v JOIN a5 USING (n) JOIN c5 ON c5.i = a)
SELECT vec_id, a::INTEGER AS cluster, distance, sum(distance) OVER (PARTITION BY a)::BIGINT AS cluster_inertia, sum(distance) OVER ()::BIGINT AS inertia, s AS centroid_sha256 FROM d"""
