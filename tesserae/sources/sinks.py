"""Writing state and documents: whole, only what differs, in chunks, or not at all."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..operators import diff as D
from .tables import unknown_fields


class UnknownFieldsError(ValueError):
    """Rows hold fields that the table does not have."""


class StateMismatchError(ValueError):
    """Two copies of a state differ."""


def write_state(df: DataFrame, path: str, key: str, form: str = "parquet") -> None:
    """The whole table in the order of its key."""
    df.repartitionByRange(key).sortWithinPartitions(key).write.mode("overwrite").format(form).save(path)


def write_delta(old: DataFrame, new: DataFrame, path: str, keys: list[str]) -> int:
    """Appends the rows that are new or differ; how many."""
    seen = Observation()
    D.delta(old, new, keys).observe(seen, F.count(F.lit(1)).alias("n")).write.mode("append").parquet(path)
    return seen.get["n"]


def import_state(rows: DataFrame, table: DataFrame, path: str, keys: list[str]) -> None:
    """Upserts rows into a table, and refuses fields that it does not have before anything is written."""
    if extra := unknown_fields(table.schema, rows.schema):
        raise UnknownFieldsError(", ".join(extra))
    D.upsert(table, rows, keys).write.mode("overwrite").parquet(path)


def verify(local: DataFrame, remote: DataFrame, keys: list[str]) -> None:
    """Raises if two copies differ in a row."""
    if rows := D.snapshot_diff(local, remote, keys).limit(20).collect():
        raise StateMismatchError(", ".join(f"{r[keys[0]]}: {r['state']}" for r in rows))


def save_pages(old: DataFrame, new: DataFrame, key: str, put: Callable[[Iterable], None], remove: Callable[[Iterable], None]) -> DataFrame:
    """Classifies pages against stored ones; puts created and changed ones partition by partition, and only then removes the rest. How many of each."""
    states = D.snapshot_diff(old, new, [key], unchanged=True).persist()
    new.join(states.where(F.col("state").isin("created", "changed")).select(key), key, "left_semi").foreachPartition(put)
    states.where("state = 'removed'").select(key).foreachPartition(remove)
    return states.groupBy("state").count()


def write_bundle(pages: DataFrame, folder: str) -> None:
    """(path, text) as a table of a folder, partitioned by the first part of the path."""
    pages.withColumn("section", F.substring_index("path", "/", 1)).write.mode("overwrite").partitionBy("section").parquet(folder)


def append_log(line: DataFrame, path: str) -> None:
    line.write.mode("append").text(path)


def dry_run(df: DataFrame) -> None:
    """Computes everything and writes nothing."""
    df.write.format("noop").mode("overwrite").save()
