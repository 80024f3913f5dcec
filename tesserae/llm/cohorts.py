"""Cohort retention by an embedded engine: clients are dealt by hash to files, DuckDB runs SQL over each file, Spark adds the cells up."""

from __future__ import annotations

import contextlib
import shutil
import tempfile
import urllib.parse
from collections.abc import Iterator

import duckdb
import pandas as pd
import pyarrow.dataset as ds
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import col, file_in, new_folder, table, written

#: Rows that one file shall hold, and the fewest buckets.
FILE_ROWS, LEAST_BUCKETS = 1 << 20, 24
#: A client with more than this part of all rows is dealt over several files; so there are at most as many such clients.
SPLIT_SHARE = 1024
#: Memory of one DuckDB; beyond it, it spills.
MEMORY = "256MB"
#: Rows of one batch that DuckDB reads.
BATCH = 1 << 14

_CLICKS = "SELECT DISTINCT click_id, ts, arrives, client_id, client_crc, kind, value, rest FROM clicks"
_STARTS = "SELECT client_id, min(ts) FILTER (arrives < $cut) AS start0, min(ts) AS start1 FROM clicks WHERE kind = $kind GROUP BY client_id"
#: The clicks that count: in state 0 those that arrive before the cut, each from the client's start of that state on.
_KNOWN = """
SELECT 0 AS state, c.*, s.start0 AS start, s.start1 AS other FROM known c JOIN starts s USING (client_id) WHERE c.arrives < $cut AND c.ts >= s.start0
UNION ALL
SELECT 1, c.*, s.start1, s.start0 FROM known c JOIN starts s USING (client_id) WHERE c.ts >= s.start1
"""
_DAY = 86_400_000_000
_BY_CLIENT = f"""
SELECT state, client_id, any_value(client_crc) AS client_crc, any_value(cohort) AS cohort, any_value(moved) AS moved, period, sum(cents) AS cents FROM (
  SELECT state, client_id, client_crc, floor(date_diff('day', DATE '1970-01-01', CAST(start AS DATE)) / $days)::BIGINT AS cohort,
    CASE WHEN other IS NULL THEN 0 ELSE (floor(date_diff('day', DATE '1970-01-01', CAST(start AS DATE)) / $days) <> floor(date_diff('day', DATE '1970-01-01', CAST(other AS DATE)) / $days))::BIGINT END AS moved,
    (epoch_us(ts) - epoch_us(start)) // ($width * {_DAY}) AS period, coalesce(try_cast(floor(100 * value + 0.5) AS BIGINT), 0) AS cents
  FROM ({_KNOWN})) GROUP BY state, client_id, period
"""
_CELLS = f"""
SELECT state, coalesce(city, '') AS segment, cohort, period, count(*) AS users, sum(client_crc) AS users_crc32, sum(moved) AS moved, sum(cents) AS cents
FROM ({_BY_CLIENT}) LEFT JOIN cities USING (client_id) GROUP BY ALL
"""
CELL_TYPE = "state int, segment string, cohort long, period long, users long, users_crc32 long, moved long, cents decimal(38,0)"


def _scratch(folder: str) -> str:
    """A folder for what one DuckDB spills: under the shared folder if that is a path of this machine's file system, else the task's own; its user removes it."""
    if folder.startswith("file:"):
        system, at = file_in(folder, "")
        system.create_dir(at, recursive=True)
        return tempfile.mkdtemp(prefix="spill-", dir=at)
    return tempfile.mkdtemp(prefix="spill-")


@contextlib.contextmanager
def _engine(folder: str, memory: str) -> Iterator[duckdb.DuckDBPyConnection]:
    spill = _scratch(folder)
    con = duckdb.connect(config={"threads": 1, "memory_limit": memory, "temp_directory": spill, "preserve_insertion_order": False})
    try:
        yield con
    finally:
        con.close()
        shutil.rmtree(spill, ignore_errors=True)


def _file_rows(con: duckdb.DuckDBPyConnection, folder: str, bucket: int, name: str, make: str) -> None:
    """Runs make, which reads a view of that name, over the files of a bucket, batch by batch; a bucket without files is an empty table."""
    system, at = file_in(folder, f"_bucket={bucket}")
    files = [f.path for f in system.get_file_info(fs.FileSelector(at, allow_not_found=True)) if f.is_file and f.path.endswith(".parquet")]
    if not files:
        system, at = file_in(folder, "_bucket=-1")
        files = [f.path for f in system.get_file_info(fs.FileSelector(at)) if f.is_file and f.path.endswith(".parquet")]
    reader = ds.dataset(files, filesystem=system, format="parquet").scanner(batch_size=BATCH, batch_readahead=1, fragment_readahead=1, use_threads=False).to_reader()
    con.register(name, reader)
    con.execute(make)
    con.unregister(name)


def _per_bucket(buckets: DataFrame, run, schema: str) -> DataFrame:
    """run(bucket) for each bucket, which yields pandas frames; one task for each bucket."""

    def task(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for bucket in frame["id"]:
                yield from run(int(bucket))

    return buckets.mapInPandas(task, schema)


def _dealt(rows: DataFrame, label: str, buckets: int) -> str:
    """Writes rows by their column _bucket; bucket -1, which nothing is dealt to, holds an empty file with the same columns."""
    folder = new_folder(rows.sparkSession, label)
    rows.repartition(buckets, "_bucket").write.partitionBy("_bucket").parquet(folder)
    rows.limit(0).drop("_bucket").coalesce(1).write.parquet(f"{folder}/_bucket=-1")
    return folder


def _ntz(c: Column) -> Column:
    return c.cast("timestamp_ntz")


def retention(
    clicks: DataFrame, clients: DataFrame, cut: str = "2024-03-01 00:00:00", kind: str = "purchase", days: int = 3, late_modulus: int = 3, late_days: int = 100,
    file_rows: int = FILE_ROWS, split_share: int = SPLIT_SHARE, memory: str = MEMORY,
) -> DataFrame:
    """The retention matrix (state, segment, cohort, period, users, users_crc32, moved, cents) of clicks (click_id, ts, arrived_at, client_id, kind, value, ...) and clients (client_id, city, ...).

    Rows of clicks that are equal in all columns, whatever these are, count once; rows without ts or client_id count not at all. A click
    whose id's crc32 divides by late_modulus arrives so many days later as that crc32 leaves modulo late_days. State 0 knows the clicks that
    arrive before cut, state 1 all. A client's start is the earliest known ts of that kind; cohorts and periods are so many days long.

    Clients are dealt by hash to as many buckets as keep a bucket near file_rows rows, each a folder of files. DuckDB deduplicates a bucket, finds
    the starts and makes cells, in memory up to a limit and spilling beyond. A client with more than 1 / split_share of all rows (there are at most
    split_share of these) is dealt by its rows over files of its own: DuckDB reduces each to the client's starts, Spark takes the least, and DuckDB
    then reduces each file to the client's sums by period. Spark adds all cells up. No more than the list of these few clients reaches the driver.

    A null click_id delays nothing; a null arrived_at is known to state 1 alone; a null, infinite or NaN value, or one whose cents exceed a long, has 0
    cents. A client with several rows has the smallest of its cities; null or none is ''. Empty clicks give no rows. A total of cents beyond a long is null.
    """
    spark = clicks.sparkSession
    late = F.crc32(col("click_id").cast("string").cast("binary"))
    delay = F.when(late % late_modulus == 0, late % late_days).otherwise(F.lit(0)).cast("int")
    arrives = _ntz(col("arrived_at")) + F.make_dt_interval(F.coalesce(delay, F.lit(0)))
    known = ["click_id", "ts", "arrived_at", "client_id", "kind", "value"]
    others = [c for c in clicks.columns if c not in known]
    rest = F.unhex(F.sha2(F.to_json(F.struct(*[col(c).alias(f"c{i}") for i, c in enumerate(others)]), {"ignoreNullFields": "false"}), 256)) if others else F.lit(None).cast("binary")
    rows = clicks.where(col("ts").isNotNull() & col("client_id").isNotNull()).select(
        col("click_id").alias("click_id"), _ntz(col("ts")).alias("ts"), F.struct(_ntz(col("arrived_at")).alias("at"), arrives.alias("arrives")).alias("_at"), col("client_id").alias("client_id"),
        F.crc32(col("client_id").cast("string").cast("binary")).alias("client_crc"), col("kind").alias("kind"), col("value").cast("double").alias("value"), rest.alias("rest"),
    ).select("click_id", "ts", F.col("_at.arrives").alias("arrives"), "client_id", "client_crc", "kind", "value", "rest")

    counts = written(rows.groupBy("client_id").agg(F.count(F.lit(1)).alias("n")), "clients")
    total = counts.agg(F.sum("n")).first()[0] or 0
    buckets = max(LEAST_BUCKETS, -(-total // file_rows))
    share = max(1, -(-total // buckets))
    split = counts.where(F.col("n") * split_share > total).select("client_id", F.ceil(F.col("n") / share).cast("int").alias("_pieces"))
    split = written(split.where("_pieces > 1") if total else split.limit(0), "split")
    few = F.broadcast(split)  # at most split_share rows

    # pieces of a split client follow each other from a place of its hash; their buckets come after those of the whole clients
    own = F.pmod(F.xxhash64("client_id"), F.lit(buckets))
    piece = F.pmod(F.xxhash64("client_id", F.lit(1)) + F.pmod(F.xxhash64("click_id", "ts", "rest"), F.col("_pieces")), F.lit(buckets))
    dealt = rows.join(few, "client_id", "left").withColumn("_bucket", F.when(F.col("_pieces").isNull(), own).otherwise(piece + buckets)).drop("_pieces")
    at = _dealt(dealt, "clicks", 2 * buckets)
    cities = clients.where(col("client_id").isNotNull()).select(col("client_id").cast(clicks.schema["client_id"].dataType).alias("client_id"), col("city").alias("city"))
    cities = cities.groupBy("client_id").agg(F.min("city").alias("city"))
    cities_at = _dealt(cities.withColumn("_bucket", own), "cities", buckets)
    spill_at = new_folder(spark, "spill")
    given, cutting = {"cut": cut, "days": float(days), "width": days}, {"cut": cut, "kind": kind}
    tasks = lambda a, b: spark.range(a, b, 1, b - a)

    def first(con: duckdb.DuckDBPyConnection, bucket: int) -> None:
        _file_rows(con, at, bucket, "clicks", f"CREATE TEMP TABLE known AS {_CLICKS}")

    def cells_of(bucket: int) -> Iterator[pd.DataFrame]:
        with _engine(spill_at, memory) as con:
            first(con, bucket)
            con.execute("CREATE TEMP TABLE starts AS " + _STARTS.replace("FROM clicks", "FROM known"), cutting)
            _file_rows(con, cities_at, bucket, "dealt", "CREATE TEMP TABLE cities AS SELECT * FROM dealt")
            yield from _frames(con, _CELLS, given)

    def starts_of(bucket: int) -> Iterator[pd.DataFrame]:
        with _engine(spill_at, memory) as con:
            _file_rows(con, at, bucket, "clicks", "CREATE TEMP TABLE known AS SELECT client_id, ts, arrives, kind FROM clicks")
            yield from _frames(con, _STARTS.replace("FROM clicks", "FROM known"), cutting)

    whole = _per_bucket(tasks(0, buckets), cells_of, CELL_TYPE.replace("decimal(38,0)", "string")).withColumn("cents", F.col("cents").cast("decimal(38,0)"))
    key = clicks.schema["client_id"].dataType.simpleString()
    partial = _per_bucket(tasks(buckets, 2 * buckets), starts_of, f"client_id {key}, start0 timestamp_ntz, start1 timestamp_ntz")
    starts = partial.groupBy("client_id").agg(F.min("start0").alias("start0"), F.min("start1").alias("start1")).toPandas() if split.head(1) else None  # at most split_share rows
    parts = whole
    if starts is not None:

        def sums_of(bucket: int) -> Iterator[pd.DataFrame]:
            with _engine(spill_at, memory) as con:
                con.register("few", starts)
                con.execute("CREATE TEMP TABLE starts AS SELECT * FROM few")
                first(con, bucket)
                yield from _frames(con, _BY_CLIENT, given)

        sums = _per_bucket(tasks(buckets, 2 * buckets), sums_of, f"state int, client_id {key}, client_crc long, cohort long, moved long, period long, cents string")
        one = sums.groupBy("state", "client_id", "client_crc", "cohort", "moved", "period").agg(F.sum(F.col("cents").cast("decimal(38,0)")).alias("cents"))
        city = cities.join(few, "client_id").select("client_id", "city")
        one = one.join(F.broadcast(city), "client_id", "left")  # no more rows than few has
        parts = whole.unionByName(one.select("state", F.coalesce("city", F.lit("")).alias("segment"), "cohort", "period", F.lit(1).cast("long").alias("users"), F.col("client_crc").alias("users_crc32"), "moved", "cents"))
    total_of = parts.groupBy("state", "segment", "cohort", "period").agg(*[F.sum(c).alias(c) for c in ("users", "users_crc32", "moved", "cents")])
    return total_of.withColumn("cents", F.expr("try_cast(cents AS bigint)"))


def _frames(con: duckdb.DuckDBPyConnection, sql: str, given: dict) -> Iterator[pd.DataFrame]:
    """The rows of sql in frames of a bounded size; sums beyond 64 bits as text."""
    used = {k: v for k, v in given.items() if f"${k}" in sql}
    found = con.sql(f"SELECT * REPLACE (CAST(cents AS VARCHAR) AS cents) FROM ({sql})" if "cents" in sql else sql, params=used)
    for batch in found.to_arrow_reader(BATCH):
        if batch.num_rows:
            yield batch.to_pandas()


def op11_cohorts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return retention(table(spark, sf_dir, "clicks"), table(spark, sf_dir, "clients"))


def _crc32_sql(text: str) -> str:
    """The CRC-32 of a text of ASCII characters in DuckDB, byte by byte over a table that the query makes itself."""
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split({text}, ''), lambda x: ascii(x)::BIGINT)), lambda c, b: xor(c >> 8, crc[xor(c & 255, b) + 1])), 4294967295)"


def op11_sql() -> str:
    """The same matrix for DuckDB over whole tables."""
    day = lambda x: f"floor(date_diff('day', DATE '1970-01-01', CAST({x} AS DATE)) / 3.0)::BIGINT"
    return f"""
WITH RECURSIVE bits AS (SELECT k, 0 AS step, k::BIGINT AS z FROM range(256) r(k) UNION ALL SELECT k, step + 1, CASE WHEN z & 1 = 1 THEN xor(z >> 1, 3988292384) ELSE z >> 1 END FROM bits WHERE step < 8),
t AS MATERIALIZED (SELECT list(z ORDER BY k) AS crc FROM bits WHERE step = 8),
d AS (SELECT DISTINCT * FROM clicks WHERE ts IS NOT NULL AND client_id IS NOT NULL),
h AS (SELECT d.*, {_crc32_sql("CAST(click_id AS VARCHAR)")} AS h FROM d, t),
c AS MATERIALIZED (SELECT client_id, ts, kind, CASE WHEN h % 3 = 0 THEN arrived_at + to_days((h % 100)::INTEGER) ELSE arrived_at END AS arrives, coalesce(floor(100 * value + 0.5)::BIGINT, 0) AS cents FROM h),
s AS (SELECT client_id, min(ts) FILTER (arrives < TIMESTAMP '2024-03-01') AS a, min(ts) AS b FROM c WHERE kind = 'purchase' GROUP BY 1),
u AS (SELECT s.*, {_crc32_sql("CAST(client_id AS VARCHAR)")} AS crc32, (SELECT min(city) FROM clients x WHERE x.client_id = s.client_id) AS city,
  CASE WHEN a IS NOT NULL AND {day("a")} <> {day("b")} THEN 1 ELSE 0 END AS moved FROM s, t),
k AS (SELECT 0 AS state, c.ts, c.cents, u.*, u.a AS start FROM c JOIN u USING (client_id) WHERE c.arrives < TIMESTAMP '2024-03-01' AND c.ts >= u.a
  UNION ALL SELECT 1, c.ts, c.cents, u.*, u.b FROM c JOIN u USING (client_id) WHERE c.ts >= u.b),
p AS (SELECT state, client_id, crc32, coalesce(city, '') AS segment, moved, {day("start")} AS cohort, (epoch_us(ts) - epoch_us(start)) // {3 * _DAY} AS period, sum(cents) AS cents FROM k GROUP BY ALL)
SELECT state::INTEGER AS state, segment, cohort, period, count(*)::BIGINT AS users, sum(crc32)::BIGINT AS users_crc32, sum(moved)::BIGINT AS moved, sum(cents)::BIGINT AS cents FROM p GROUP BY state, segment, cohort, period
"""
