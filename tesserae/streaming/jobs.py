"""Jobs from a stream: at least once, bad ones set aside, work repeated without effect."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.versions import VersionedTable


JOB = "job string, source_id string, entity string, entities array<string>, origin_source_id string"


def parse(messages: DataFrame, body: str = "body") -> DataFrame:
    """The fields of each message's job and problem: null where the job is sound, else what is wrong with it."""
    got = messages.withColumn("_j", F.from_json(body, JOB))
    j = F.col("_j")
    named = F.coalesce(F.size(j["entities"]) > 0, F.lit(False))
    problem = (
        F.when(j.isNull() | j["job"].isNull(), "unreadable")
        .when(~j["job"].isin("link", "consolidate", "generate", "materialise"), "unknown job")
        .when((j["job"] == "link") & j["source_id"].isNull(), "no source")
        .when((j["job"] == "consolidate") & ~named, "no entities")
        .when((j["job"] == "generate") & ~named & j["entity"].isNull(), "no entity")
    )
    return got.select(*messages.columns, "_j.*", problem.alias("problem"))


def follow_ons(jobs: DataFrame, touched: DataFrame, undecided: DataFrame, size: int = 25) -> DataFrame:
    """(job, entities, origin_source_id): what link jobs lead to, in batches of `size` entities.

    touched (source_id, entity) are generated anew; undecided (entity) of them are consolidated.
    """
    from ..operators.measures import batches

    links = jobs.where("job = 'link'").select("source_id", F.coalesce("origin_source_id", "source_id").alias("origin_source_id"))
    rows = links.join(touched, "source_id").select("origin_source_id", "entity").distinct()
    both = rows.withColumn("job", F.lit("generate")).unionByName(rows.join(undecided.select("entity"), "entity", "left_semi").withColumn("job", F.lit("consolidate")))
    keyed = both.withColumn("_k", F.struct("job", "origin_source_id"))
    return batches(keyed, "entity", size, within="_k").groupBy("job", "origin_source_id", "batch").agg(F.array_sort(F.collect_set("entity")).alias("entities"))


def run_stream(messages: DataFrame, work: Callable[[DataFrame, int], None], dead: str, checkpoint: str, seconds: float | None = None):
    """Hands each micro-batch's sound jobs to work, and writes the others to the table at dead, by batch; ends when what is there is done.

    work gets the same jobs again after a failure, so it skips what its own watermark says is done; a batch that is repeated writes its
    bad jobs in the same place. After so many seconds the query is stopped; what a batch has not finished comes again with the next run.
    """

    def each(batch: DataFrame, number: int) -> None:
        rows = parse(batch).persist()
        bad = rows.where("problem is not null")
        if not bad.isEmpty():
            bad.write.mode("overwrite").parquet(f"{dead}/batch={number}")
        good = rows.where("problem is null").drop("problem")
        if not good.isEmpty():
            work(good, number)
        rows.unpersist()

    q = messages.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    if seconds is None:
        q.awaitTermination()
    elif not q.awaitTermination(seconds):
        q.stop()
    return q


def versions(spark: SparkSession, path: str) -> list[int]:
    """The numbers of the whole versions of a table that settle_into() keeps at a path, ascending."""
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    system = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not system.exists(at):
        return []
    found = [s.getPath() for s in system.listStatus(at)]
    return sorted(int(p.getName()) for p in found if p.getName().isdigit() and system.exists(jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS")))


def settled(spark: SparkSession, path: str) -> DataFrame:
    """The newest version of a table that settle_into() keeps."""
    return spark.read.parquet(f"{path}/{versions(spark, path)[-1]:06d}")


def settle_into(path: str, keys: list[str], order: list[str]) -> Callable[[DataFrame, int], None]:
    """A batch function that keeps each key's last row by an order, however late it arrives, in a table at a path.

    Each batch writes a new version of the table beside the last one before it, whichever number that has; readers take settled().
    """

    def work(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        new = batch.select(*batch.columns)
        last = max((v for v in versions(spark, path) if v < number), default=None)
        if last is not None:
            new = new.unionByName(spark.read.parquet(f"{path}/{last:06d}"))
        rest = [c for c in new.columns if c not in keys]
        got = new.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_r")).select(*keys, "_r.*")
        got.write.mode("overwrite").parquet(f"{path}/{number:06d}")

    return work


def settle_changes(table: VersionedTable, order: list[str]) -> Callable[[DataFrame, int], None]:
    """A batch function as settle_into()'s for a table with one writer: a batch writes only the keys that it changes, and repeated writes nothing."""

    def work(batch: DataFrame, number: int) -> None:
        rest = [c for c in batch.columns if c not in table.keys]
        new = batch.groupBy(*table.keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_r")).select(*table.keys, "_r.*").persist()
        known = lambda rows: rows.select(*table.keys, F.struct(*order).alias("_had"))
        table.update(lambda rows: new.join(known(rows), table.keys, "left").where(F.col("_had").isNull() | (F.struct(*order) > F.col("_had"))).drop("_had"))
        new.unpersist()

    return work


def windows(events: DataFrame, time: str, length: str, slide: str | None = None, late: str | None = None, *by: str) -> DataFrame:
    """Counts and sums over tumbling or sliding windows; with late, rows behind the watermark are dropped by a stream. An addition."""
    rows = events.withWatermark(time, late) if late else events
    w = F.window(time, length, slide) if slide else F.window(time, length)
    return rows.groupBy(w.alias("w"), *by).agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total")).select(F.col("w.start").alias("start"), *by, "n", "total")


def sessions(events: DataFrame, time: str, gap: str, key: str) -> DataFrame:
    """Sessions of a key that end after a gap. An addition."""
    return events.groupBy(F.session_window(time, gap).alias("w"), key).agg(F.count(F.lit(1)).alias("n")).select(key, F.col("w.start").alias("start"), "n")


