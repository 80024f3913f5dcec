"""References that lead nowhere."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as X


def dangling(rows: DataFrame, key: str, checks: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """(key, side, missing): a row for each id that its table does not hold; checks gives for each column the table and its id."""
    out = None
    for column, (table, id_col) in checks.items():
        known = table.select(F.col(id_col).alias("_id"))
        lost = rows.where(F.col(column).isNotNull()).join(known, rows[column] == F.col("_id"), "left_anti").select(key, F.lit(column).alias("side"), F.col(column).cast("string").alias("missing"))
        out = lost if out is None else out.unionByName(lost)
    return out


def broken_links(pages: DataFrame, path: str, text: str, existing: DataFrame | None = None) -> DataFrame:
    """(path, pos, target): every wiki link whose target is neither a page nor among the existing paths."""
    known = pages.select(X.page_key(F.col(path)).alias("_k"))
    known = known.unionByName(existing.select(X.page_key(F.col(path)).alias("_k"))) if existing is not None else known
    found = pages.select(path, F.posexplode(X.links(F.col(text))).alias("pos", "target"))
    return found.join(known.distinct(), X.page_key(F.col("target")) == F.col("_k"), "left_anti")


def collisions(rows: DataFrame, slug: str, order: str) -> DataFrame:
    """Rows whose slug an earlier row owns, with that row; the last of a slug is the one that is used."""
    w = Window.partitionBy(slug)
    own = F.min(order).over(w)
    return rows.select("*", own.alias("owner"), (F.max(order).over(w) == F.col(order)).alias("used")).where(F.col(order) > F.col("owner"))


def stale_paths(existing: DataFrame, expected: DataFrame, path: str = "path") -> DataFrame:
    return existing.join(expected.select(path), path, "left_anti")
