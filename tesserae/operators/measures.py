"""How well supported an entity is, and counts for reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .closure import cut


def support(statements: DataFrame, references: DataFrame) -> DataFrame:
    """entity, sources (different ones, null counting as one), references, weight and thin (one of each at most).

    statements (entity, source), references (entity, n). Entities of either table are returned.
    """
    s = statements.groupBy("entity").agg((F.countDistinct("source") + F.max(F.when(F.col("source").isNull(), 1).otherwise(0))).alias("sources"))
    r = references.groupBy("entity").agg(F.sum("n").alias("references"))
    got = s.join(r, "entity", "full_outer").select("entity", F.coalesce("sources", F.lit(0)).cast("long").alias("sources"), F.coalesce("references", F.lit(0)).cast("long").alias("references"))
    return got.select("*", (F.col("sources") + F.col("references")).alias("weight"), ((F.col("sources") <= 1) & (F.col("references") <= 1)).alias("thin"))


def quality(entities: DataFrame, statements: DataFrame, related: DataFrame) -> DataFrame:
    """For each kind: entities, thin (without statements), single_source and isolated (in no relation)."""
    s = statements.groupBy("entity").agg(F.countDistinct("source").alias("_n"))
    rel = related.select(F.col("entity").alias("_r")).distinct()
    rows = entities.join(s, entities["id"] == s["entity"], "left").join(rel, entities["id"] == rel["_r"], "left")
    count = lambda c: F.sum(F.when(c, 1).otherwise(0)).cast("long")
    return rows.groupBy("kind").agg(F.count(F.lit(1)).alias("entities"), count(F.col("_n").isNull()).alias("thin"), count(F.coalesce(F.col("_n") == 1, F.lit(False))).alias("single_source"), count(F.col("_r").isNull()).alias("isolated"))


def capped_evidence(rows: DataFrame, caps: dict[str, int], key: str = "key", date: str = "date") -> DataFrame:
    """Rows (entity, role, date, key) with sent: the newest of each entity and role up to its cap; and covered: sent, or of role refers.

    Own statements beyond the cap stay pending; mentions beyond it count as seen.
    """
    rn = F.row_number().over(Window.partitionBy("entity", "role").orderBy(F.desc_nulls_last(date), F.desc(key)))
    cap = F.coalesce(*[F.when(F.col("role") == r, n) for r, n in caps.items()])
    return rows.withColumn("sent", rn <= cap).withColumn("covered", F.col("sent") | (F.col("role") == "refers"))


def round_robin(rows: DataFrame, stratum: str, key: str, n: int, seed: str = "") -> DataFrame:
    """A sample of n rows that takes turns among the strata, in the order of a hash of the key. The limit is what it is for."""
    h = F.md5(F.concat(F.lit(seed), F.col(key).cast("string")))
    turn = F.row_number().over(Window.partitionBy(stratum).orderBy(h, key))
    return rows.withColumn("turn", turn.cast("long")).where(F.col("turn") <= n).orderBy("turn", stratum).limit(n)


def batches(rows: DataFrame, order: str, size: int, within: str | None = None) -> DataFrame:
    """batch: the number of a row's batch of `size` rows, in an order within a group (all rows are one group if there is none)."""
    if within:
        rn = F.row_number().over(Window.partitionBy(within).orderBy(order))
        return rows.withColumn("batch", F.floor((rn - 1) / size).cast("long"))
    # a global number without a single task: ranges, their sizes, and a place within each, all from one written copy, since ranges are sampled anew for each plan
    dealt = cut(rows.repartitionByRange(order).withColumn("_p", F.spark_partition_id()))
    place = F.row_number().over(Window.partitionBy("_p").orderBy(order))
    sizes = dealt.groupBy("_p").count()
    before = sizes.select(F.col("_p").alias("_q"), (F.sum("count").over(Window.orderBy("_p")) - F.col("count")).alias("_b"))  # a row for each range
    return dealt.withColumn("_r", place).join(F.broadcast(before), F.col("_p") == F.col("_q")).withColumn("batch", F.floor((F.col("_b") + F.col("_r") - 1) / size).cast("long")).drop("_p", "_q", "_b", "_r")


def cost(rows: DataFrame, by: str, price_in: float, price_out: float) -> DataFrame:
    """Sums of a log of model calls (input, output, cache_read, cache_write tokens) and its cost: reads at a tenth, writes at 1.25 of the input price, per million."""
    got = rows.groupBy(by).agg(F.count(F.lit(1)).alias("calls"), *[F.sum(c).alias(c) for c in ("input", "output", "cache_read", "cache_write")])
    dollars = (F.col("input") * price_in + F.col("cache_read") * price_in * 0.1 + F.col("cache_write") * price_in * 1.25 + F.col("output") * price_out) / 1e6
    return got.withColumn("cost", F.round(dollars, 6))
