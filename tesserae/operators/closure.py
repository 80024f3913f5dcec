"""Closure over parent pointers by pointer doubling."""

from __future__ import annotations

import atexit
import contextlib
import tempfile
import uuid

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

_cuts: list[tuple] = []


def cut(df: DataFrame) -> DataFrame:
    """The rows of df from a table in the shared folder of the session, so that rounds do not grow the plan and a lost executor costs no round. It goes with the process."""
    spark = df.sparkSession
    sc = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not folder and not sc.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    if not folder:
        sc.setCheckpointDir(f"file://{tempfile.mkdtemp(prefix='tesserae-')}")
        folder = sc.getCheckpointDir()
    path = f"{folder.rstrip('/')}/cut-{uuid.uuid4().hex}"
    _cuts.append((spark, path))
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@atexit.register
def _drop_cuts() -> None:
    for spark, path in _cuts:
        with contextlib.suppress(Exception):
            at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def fold_closure(edges: DataFrame) -> DataFrame:
    """(frm, root) of edges (frm, dst), one for each frm: where a node's pointers end. Nodes on a cycle, or leading into one, are left out.

    Each round doubles the steps of the nodes that have not reached an end and sets those aside that then have. A node that is still on
    its way after s steps has as many such nodes before it as steps beyond s, so once s is no less than the nodes on their way one more round ends
    all but those that lead into a cycle: rounds grow with the logarithm of the longest chain, or of the nodes that never end.
    """
    heads = edges.select(F.col("frm").alias("_h")).distinct()
    way = cut(edges.join(heads, F.col("dst") == F.col("_h"), "left").select("frm", F.col("dst").alias("at"), F.col("_h").isNull().alias("_done")))
    done, way, steps = way.where("_done"), way.where("not _done"), 1
    n = way.count()
    while n:
        onward = way.unionByName(done).select(F.col("frm").alias("_via"), F.col("at").alias("_to"), F.col("_done").alias("_end"))
        step = cut(way.join(onward, way["at"] == onward["_via"]).select("frm", F.col("_to").alias("at"), F.col("_end").alias("_done")))
        done, way = done.unionByName(step.where("_done")), step.where("not _done")
        if steps >= n:
            break
        n, steps = way.count(), 2 * steps
    return done.select("frm", F.col("at").alias("root"))


def on_cycle(edges: DataFrame) -> DataFrame:
    """(frm) of the nodes that lie on a cycle of edges (frm, dst), one for each frm, all of which lead on without end.

    After as many steps as there are nodes each stands on a cycle, and on each cycle the steps lead all its nodes to different ones: so
    where the nodes stand is all of the cycles. The steps are doubled.
    """
    at = cut(edges.select("frm", F.col("dst").alias("at")))
    for _ in range(at.count().bit_length()):
        onward = at.select(F.col("frm").alias("_via"), F.col("at").alias("_to"))
        at = cut(at.join(onward, at["at"] == onward["_via"]).select("frm", F.col("_to").alias("at")))
    return at.select(F.col("at").alias("frm")).distinct()


def fold_paths(edges: DataFrame) -> DataFrame:
    """(frm, root, path) for the nodes of fold_closure; path is an array of (node, listed), from frm on, the root left out."""
    closed = fold_closure(edges)
    p = edges.join(closed.select("frm"), "frm", "left_semi").select("frm", F.col("dst").alias("at"), F.array(F.struct(F.col("frm").alias("node"), "listed")).alias("path"))
    p = cut(p)
    for _ in range(64):
        onward = p.select(F.col("frm").alias("_via"), F.col("at").alias("_to"), F.col("path").alias("_more"))
        step = cut(p.join(onward, p["at"] == onward["_via"], "left").select("frm", F.coalesce("_to", "at").alias("at"), F.concat("path", F.coalesce("_more", F.array().cast(p.schema["path"].dataType))).alias("path"), F.col("_to").isNotNull().alias("_moved")))
        moved = step.where("_moved").limit(1).count()
        p = step.drop("_moved")
        if not moved:
            break
    return p.select("frm", F.col("at").alias("root"), "path")


def path_flags(paths: DataFrame) -> DataFrame:
    """(frm, root, same, listed, under, depth): same if no step is listed, listed if its own is, under the next listed node before the root."""
    later = F.filter(F.slice("path", 2, 1 << 30), lambda s: s["listed"])
    return paths.select("frm", "root", (~F.exists("path", lambda s: s["listed"])).alias("same"), F.col("path")[0]["listed"].alias("listed"), F.try_element_at(later, F.lit(1))["node"].alias("under"), F.size("path").alias("depth"))


def tree_order(paths: DataFrame, names: DataFrame) -> DataFrame:
    """(root, frm, depth, pos): each root's listed nodes in preorder, children by lower-case name and node.

    names holds (node, name). A listed node hangs under the next listed node on its path.
    """
    steps = paths.where("path[0].listed").select("root", "frm", F.posexplode(F.reverse(F.filter("path", lambda s: s["listed"]))).alias("_i", "_s"))
    keyed = steps.join(names, steps["_s.node"] == names["node"]).groupBy("root", "frm").agg(F.array_sort(F.collect_list(F.struct("_i", F.lower("name").alias("_l"), F.col("_s.node").alias("_n")))).alias("_k"))
    keyed = keyed.select("root", "frm", F.size("_k").alias("depth"), F.transform("_k", lambda s: F.struct(s["_l"], s["_n"])).alias("_k"))
    return keyed.select("root", "frm", "depth", F.row_number().over(Window.partitionBy("root").orderBy("_k")).cast("long").alias("pos"))


def repoint(rows: DataFrame, closed: DataFrame, *columns: str) -> DataFrame:
    """rows with these columns led to their roots."""
    for c in columns:
        to = closed.select(F.col("frm").alias("_from"), F.col("root").alias("_root"))
        rows = rows.join(to, rows[c] == F.col("_from"), "left").withColumn(c, F.coalesce("_root", c)).drop("_from", "_root")
    return rows
