"""Linking in waves: later batches see the names that earlier ones proposed."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as X
from .closure import cut
from .measures import batches
from .passes import Client, answer, link_answers

#: Characters of names that a prompt is told at most; names beyond it, in their order, are not told but still found in answers.
TOLD = 200_000
PROPOSED = "slug string, name string"


def names_in_use(proposed: DataFrame, most: int = TOLD) -> str:
    """The names of proposed (slug, name) as a JSON array in their order, as many as fit: what a wave's prompts are told.

    The names are cut to at most `most` rows by their order before the driver sees any: a name has a character at least.
    """
    rows = proposed.where("name is not null and name <> ''").select("name").distinct().orderBy("name").limit(most)
    told, size = [], 0
    for r in rows.toLocalIterator():
        size += len(r["name"])
        if size > most:
            break
        told.append(r["name"])
    return rows.sparkSession.createDataFrame([(told,)], "n array<string>").select(F.to_json("n")).first()[0]


def link(statements: DataFrame, keys: DataFrame, proposed: DataFrame, client: Callable[[], Client], version: str, model: str, size: int = 50, waves: int = 4, answered: list[DataFrame] | None = None) -> tuple[DataFrame, DataFrame]:
    """(links, proposed): links (statement, name, entity, target, polarity, version, model) of statements (id, subject, text), and proposed (slug, name) with what was proposed besides.

    Statements are batched in the order of their ids, and the batches dealt in that order over a bounded number of waves. A wave's prompts hold
    its statements and the names proposed until then. A name that is no entity's leads to the slug proposed first that it or its singular has, or else is a new
    proposal, called by the first name that says it. Batches whose call fails link nothing and stay pending; the ids of the others are added to
    answered, where it is given, as one table.
    """
    rows = cut(batches(statements, "id", size))
    last = rows.agg(F.max("batch")).first()[0]
    if last is None:
        return link_answers(rows.select(F.lit("{}").alias("answer")), rows, keys, version, model).select("statement", "name", "entity", F.lit(None).cast("string").alias("target"), "polarity", "version", "model"), proposed
    per_wave = -(-(last + 1) // waves)
    links = read = None
    for first in range(0, last + 1, per_wave):
        own = rows.where(F.col("batch").between(first, first + per_wave - 1))
        told = names_in_use(proposed)
        asked = own.groupBy("batch").agg(F.array_sort(F.collect_list(F.struct("id", "subject", "text"))).alias("s"))
        asked = asked.select("batch", F.to_json(F.struct(F.col("s").alias("statements"), F.from_json(F.lit(told), "array<string>").alias("names"))).alias("prompt"))
        replies = cut(answer(asked, client))
        heard = own.join(replies.where("answer is not null").select("batch"), "batch", "left_semi").select("id")
        read = heard if read is None else read.unionByName(heard)
        got = cut(link_answers(replies, own, keys, version, model))
        new = got.where("entity is null").withColumn("slug", X.api_slugify(F.col("name"))).where("slug <> ''")
        probes = new.select("slug").distinct().select("slug", F.posexplode(F.array("slug", X.depluralise(F.col("slug")))).alias("_p", "_k"))
        known = probes.join(proposed.select(F.col("slug").alias("_k")), "_k").groupBy("slug").agg(F.min_by("_k", "_p").alias("_to"))
        # among the new ones of a wave a plural follows a singular that another statement says
        within = probes.where("_p = 1").join(new.select(F.col("slug").alias("_k")).distinct(), "_k").select("slug", F.col("_k").alias("_single"))
        led = cut(new.select("slug").distinct().join(known, "slug", "left").join(within, "slug", "left").select("slug", F.coalesce("_to", "_single", "slug").alias("target")))
        wave = got.withColumn("slug", F.when(F.col("entity").isNull(), X.api_slugify(F.col("name")))).join(led, "slug", "left").select("statement", "name", "entity", "target", "polarity", "version", "model")
        fresh = wave.where("target is not null").groupBy(F.col("target").alias("slug")).agg(F.min_by(F.lower(X.strip(F.col("name"))), F.struct("statement", "name")).alias("name"))
        proposed = cut(proposed.unionByName(fresh.join(proposed.select("slug"), "slug", "left_anti")))
        links = wave if links is None else links.unionByName(wave)
    if answered is not None:
        answered.append(read)
    return links, proposed
