"""Wiki links in texts: led to the pages that there are, by joins; and generated texts on pages."""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as X


def repair_links(rows: DataFrame, columns: list[str], catalog: DataFrame, key: str = "slug") -> DataFrame:
    """rows with the wiki links in these columns led to the catalog (slug, path): kept where they name a path, re-pointed where they name a known slug, else their label or the slug in words.

    The links of a row are looked up by a join, each target once, and put back as a map that is no larger than what the row links to; the catalog is never
    held in one place. key tells rows apart; rows with a null key, and texts without links, are left alone but for links, which then count as unknown. Of
    several paths of a slug the smallest counts.
    """
    targets = F.array_distinct(F.flatten(F.array(*[F.coalesce(X.links(F.col(c)), F.array().cast("array<string>")) for c in columns])))
    asked = rows.where(F.col(key).isNotNull()).select(F.col(key).alias("_k"), F.explode(targets).alias("_t")).select("_k", F.element_at(F.split(X.page_key(F.col("_t")), "/"), -1).alias("_s")).distinct()
    known = catalog.where("slug is not null and path is not null").groupBy(F.col("slug").alias("_s")).agg(F.min(X.page_key(F.col("path"))).alias("_p"))
    found = asked.join(known, "_s").groupBy("_k").agg(F.map_from_entries(F.collect_list(F.struct("_s", "_p"))).alias("_to"))
    none = F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>"))
    led = rows.join(found, F.col(key) == F.col("_k"), "left").withColumn("_to", F.coalesce("_to", none))
    return led.select(*[X.rewrite_links(F.col(c), F.col("_to")).alias(c) if c in columns else F.col(c) for c in rows.columns])


def repairer(catalog: DataFrame):
    """repair_links() over a catalog, as generate() and condense() take it."""
    return partial(repair_links, catalog=catalog)


def texts_on_pages(entities: DataFrame, prose: DataFrame, catalog: DataFrame, version: str) -> DataFrame:
    """entities (slug, overview, ...) with the generated definition of the version in overview where there is one, and context, what is done in practice, or null.

    Links of both are repaired and citations brought into the one form, so a text from before a page moved has no broken link.
    """
    now = prose.where((F.col("version") == version) & F.col("slug").isNotNull()).select("slug", "definition", X.normalise_citations(F.col("context")).alias("context"))
    now = repair_links(now, ["definition", "context"], catalog).select("slug", F.nullif("definition", F.lit("")).alias("_d"), F.nullif("context", F.lit("")).alias("context"))
    rows = entities.drop("context").join(now, "slug", "left")
    return rows.select(*[F.coalesce("_d", c).alias(c) if c == "overview" else F.col(c) for c in entities.columns if c != "context"], "context")


def details(facets: DataFrame, prose: DataFrame, catalog: DataFrame, version: str) -> DataFrame:
    """(root, pos, name, gist, depth) of facets (root, slug, name, overview, pos, depth), as tree_order() has them: the first sentence of a facet's generated definition, or else of its overview, links repaired."""
    now = prose.where(F.col("version") == version).select("slug", F.col("definition").alias("_d"))
    told = facets.join(now, "slug", "left").withColumn("gist", X.gist(F.coalesce(F.nullif("_d", F.lit("")), "overview", F.lit(""))))
    return repair_links(told, ["gist"], catalog).select("root", "pos", "name", "gist", "depth")
