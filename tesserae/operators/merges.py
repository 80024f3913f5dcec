"""Merging folded entities into the ones that they lead to, and what follows for references and names."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as X
from .closure import cut, fold_closure, on_cycle, repoint

#: Keys with more than this share of all rows are broadcast, so at most as many keys as its inverse.
OFTEN = 1 / 1024


def apply_merges(tables: dict[str, DataFrame], closed: DataFrame, keys: dict[str, list[str]]) -> dict[str, DataFrame]:
    """The tables with each folded entity led to its root: keys names the columns of a table that hold entities.

    Of `entities` (id, name, aliases, ...) folded ones go, and their names and aliases are added to the root's aliases, each once, in the
    order of the folded ids; of `relations` those go that then lead from an entity to itself. closed holds (frm, root).
    """
    out = {n: repoint(t, closed, *keys.get(n, [])) for n, t in tables.items() if n != "entities"}
    if "relations" in out:
        a, b = keys["relations"]
        out["relations"] = out["relations"].where(F.col(a) != F.col(b))
    e = tables["entities"]
    gone = e.join(closed, F.col("id") == F.col("frm")).select("root", F.struct("frm", F.concat(F.array("name"), F.coalesce("aliases", F.array().cast("array<string>"))).alias("names")).alias("_s"))
    added = gone.groupBy("root").agg(F.flatten(F.transform(F.array_sort(F.collect_list("_s")), lambda s: s["names"])).alias("_more"))
    kept = e.join(closed.select("frm"), F.col("id") == F.col("frm"), "left_anti").join(added, F.col("id") == F.col("root"), "left")
    own = F.coalesce("aliases", F.array().cast("array<string>"))
    new = F.array_distinct(F.filter("_more", lambda a: a.isNotNull() & (a != "") & ~F.array_contains(own, a)))
    out["entities"] = kept.withColumn("aliases", F.when(F.col("root").isNull(), F.col("aliases")).otherwise(F.concat(own, new))).drop("root", "_more")
    return out


def hidden_names(flags: DataFrame, names: DataFrame) -> DataFrame:
    """(root, slug): forms of names that lead to a root by a listed step, but for those that the root or what is the same as it has too.

    flags are those of path_flags(); names (entity, name), a row for each name or alias.
    """
    forms = names.where("trim(name) <> ''").select(F.col("entity").alias("_e"), X.slugify(F.col("name")).alias("slug"))
    by = flags.join(forms, F.col("frm") == F.col("_e"))
    own = flags.select("root").distinct().join(forms, F.col("root") == F.col("_e")).select("root", "slug")
    keep = own.unionByName(by.where("same").select("root", "slug"))
    return by.where("not same").select("root", "slug").distinct().join(keep, ["root", "slug"], "left_anti")


def review_pages(edges: DataFrame) -> DataFrame:
    """(frm, page): where a node's fold ends; a node on a cycle is its own page, one that leads into another's cycle has none."""
    closed = fold_closure(edges)
    stuck = edges.join(closed.select("frm"), "frm", "left_anti").select("frm", "dst")
    ring = on_cycle(stuck)
    own = stuck.join(ring.select(F.col("frm").alias("_r")), F.col("frm") == F.col("_r"), "left")
    return closed.select("frm", F.col("root").alias("page")).unionByName(own.select("frm", F.when(F.col("_r").isNotNull(), F.col("frm")).alias("page")))


def look_up(rows: DataFrame, keys: list[str], find: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """rows with what find adds to their keys: find takes each different key once and returns the keys with more columns, one row for each.

    However many rows share a key, no task gets them all: what is found of keys with more than OFTEN of all rows is broadcast, and rows of other keys meet it by a
    shuffle, through which those that are done are dealt by all their columns. Keys may be null. Lazy but for the counts and what is found.
    """
    counts = cut(rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")))
    total = counts.agg(F.sum("_n")).first()[0] or 0
    found = cut(counts.select("_n", F.struct(*keys).alias("_key"), *keys).join(find(counts.select(*keys)).select(F.struct(*keys).alias("_of"), F.struct("*").alias("_to")), F.col("_key") == F.col("_of"), "left").select("_n", "_key", "_to"))
    names = [c for c in found.schema["_to"].dataType.names if c not in keys]
    mine = F.struct(*keys)
    often = found.where(F.col("_n") > total * OFTEN).select(F.col("_key").alias("_often"), F.col("_to").alias("_1"))
    got = rows.join(F.broadcast(often), mine == F.col("_often"), "left")
    rest = found.where(F.col("_n") <= total * OFTEN).select(F.col("_key").alias("_seldom"), F.col("_to").alias("_2"), F.lit(0).cast("long").alias("_zero"))
    if rest.isEmpty():
        return got.select(*rows.columns, *[F.col("_1")[c].alias(c) for c in names])
    dealt = got.withColumn("_deal", F.when(F.col("_often").isNull(), F.lit(0).cast("long")).otherwise(F.xxhash64(*rows.columns)))
    both = dealt.join(rest, (mine == F.col("_seldom")) & (F.col("_deal") == F.col("_zero")), "left")
    return both.select(*rows.columns, *[F.coalesce(F.col("_1")[c], F.col("_2")[c]).alias(c) for c in names])


def resolve_targets(events: DataFrame, entities: DataFrame, merged: DataFrame | None = None) -> DataFrame:
    """events (subj, target_id, target_slug, ...) with tgt, the id of the entity meant, and proposed, a slug that no entity has.

    By id, else by slug; ids and slugs of merged entities (frm, root) lead to their roots. Events of an entity to itself go. Each target is looked up once.
    """
    ids = entities.select(F.col("id").alias("_i"), "slug")
    if merged is not None:
        led = merged.select(F.col("frm").alias("_f"), F.col("root").alias("_t"))
        ids = ids.join(led, F.col("_i") == F.col("_f"), "left").select("_i", "slug", F.coalesce("_t", "_i").alias("_to"))
    else:
        ids = ids.withColumn("_to", F.col("_i"))
    by_id = ids.select(F.col("_i").alias("_1"), F.col("_to").alias("_a"))
    by_slug = ids.groupBy(F.col("slug").alias("_2")).agg(F.max("_to").alias("_b"))

    def find(targets: DataFrame) -> DataFrame:
        led = targets.join(by_id, F.col("target_id") == F.col("_1"), "left").join(by_slug, F.col("target_slug") == F.col("_2"), "left")
        return led.select("target_id", "target_slug", F.coalesce("_a", "_b").alias("tgt"))

    got = look_up(events, ["target_id", "target_slug"], find)
    got = got.withColumn("proposed", F.when(F.col("tgt").isNull(), F.col("target_slug"))).drop("target_id", "target_slug")
    return got.where(F.col("tgt").isNull() | (F.col("tgt") != F.col("subj")))


def referring(rows: DataFrame, settled: DataFrame, entities: DataFrame) -> DataFrame:
    """Of statements' references (subj, target_slug, deny, ...) those that count as evidence for their target: asserted, found by slug alone, and kept by the settled overlay (subj, tgt)."""
    ids = entities.groupBy(F.col("slug").alias("target_slug")).agg(F.max("id").alias("tgt"))
    told = look_up(rows.where("deny = 0"), ["target_slug"], lambda slugs: slugs.join(ids, "target_slug")).where("subj <> tgt")
    return told.join(settled.select("subj", "tgt"), ["subj", "tgt"], "left_semi")


def sources_of_pages(own: DataFrame, refers: DataFrame) -> DataFrame:
    """(entity, sources): how many different sources a page's own statements and those that refer to it have; null counts for none."""
    return own.select("entity", "source").unionByName(refers.select("entity", "source")).groupBy("entity").agg(F.countDistinct("source").alias("sources"))


def pending_by_group(pending: DataFrame, group: Column, groups: list[str]) -> DataFrame:
    """(grp, n): how many are pending in each group, none included."""
    every = pending.sparkSession.createDataFrame([(g,) for g in groups], "grp string")
    return every.join(pending.groupBy(group.alias("_g")).agg(F.count(F.lit(1)).alias("_n")), F.col("grp") == F.col("_g"), "left").select("grp", F.coalesce("_n", F.lit(0)).alias("n"))
