"""Settling claims: the newest word wins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampType

#: Before any date, and even.
OLDEST = -(2**61)
ALIAS, DISTINCT, FACET = {"alias_of", "same_as"}, {"distinct_from", "not_alias_of"}, {"facet_of", "aspect_of", "detail_of"}


def newest(rows: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key in an order."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return rows.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def overlay(events: DataFrame, keys: tuple[str, str] = ("subj", "tgt"), date: str = "d", deny: str = "deny", asserts: str | None = None) -> DataFrame:
    """Pairs whose newest event is an assertion, with n, the number of all their assertions. asserts, if given, is how many an event stands for.

    On the same date a denial wins; a null date is the oldest. One hash aggregation, combined before the shuffle: date and denial are
    one number, whose lowest bit is the denial.
    """
    at = F.unix_micros(date) if isinstance(events.schema[date].dataType, TimestampType) else F.unix_date(F.col(date).cast("date")).cast("long")
    when = F.coalesce(at, F.lit(OLDEST)) * 2 + F.col(deny)
    got = events.groupBy(*keys).agg(F.max(when).alias("_last"), F.sum(asserts or 1 - F.col(deny)).cast("long").alias("n"))
    return got.where(F.col("_last") % 2 == 0).select(*keys, "n")


def claims(events: DataFrame) -> DataFrame:
    """Of events (frm, dst, kind, d, ord) the newest of each unordered pair: by date (null oldest), then keeping apart before merging, then the first seen."""
    rank = F.when(F.col("kind").isin(*DISTINCT), 1).otherwise(0)
    rows = events.where("frm <> dst").withColumns({"lo": F.least("frm", "dst"), "hi": F.greatest("frm", "dst"), "rank": rank})
    first = F.min("ord").over(Window.partitionBy("lo", "hi")).alias("pair_ord")
    rows = rows.select("*", first)
    return newest(rows, ["lo", "hi"], [F.col("d").desc_nulls_last(), F.col("rank").desc(), F.col("ord").asc()])


def fold_edges(settled: DataFrame) -> DataFrame:
    """The newest fold of each node among settled claims: frm, dst, listed; of a full tie the pair that was seen last."""
    folds = settled.where(F.col("kind").isin(*ALIAS, *FACET))
    got = newest(folds, ["frm"], [F.col("d").desc_nulls_last(), F.col("rank").desc(), F.col("pair_ord").desc()])
    return got.select("frm", "dst", F.col("kind").isin(*FACET).alias("listed"))


def with_model_folds(edges: DataFrame, settled: DataFrame, folds: DataFrame) -> DataFrame:
    """edges and the folds (frm, dst, listed) on whose node no edge and on whose pair no claim stands."""
    free = folds.where("frm <> dst").join(edges.select("frm"), "frm", "left_anti").withColumns({"lo": F.least("frm", "dst"), "hi": F.greatest("frm", "dst")})
    return edges.unionByName(free.join(settled.select("lo", "hi"), ["lo", "hi"], "left_anti").select("frm", "dst", "listed"))


def both_directions(edges: DataFrame, a: str, b: str, *carried: str) -> DataFrame:
    """Each edge seen from either end; a loop twice."""
    return edges.select(F.col(a).alias("e"), F.col(b).alias("other"), *carried).unionByName(edges.select(F.col(b).alias("e"), F.col(a).alias("other"), *carried))
