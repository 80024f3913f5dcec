"""Reports for people to read: what is thin, and what was folded where, as rows whose order makes a document."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import squeeze, strip
from .documents import nest

QUOTES = "array<struct<text:string,source:string,day:string,title:string>>"


def thin_list(entities: DataFrame, support: DataFrame, decided: DataFrame, closed: DataFrame, quotes: DataFrame, kinds: list[str]) -> DataFrame:
    """Each thin entity that was decided on and is of one of these kinds: where it went, and all that was said of it, in input order.

    entities (entity, name, kind, definition), support as measures.support() has it, decided (entity, same), closed (frm, root), quotes (entity, text, source, day,
    title, ord). page is what a fold ends on, or the entity itself where it is not folded, ends on a cycle or on what is no entity; same tells folded ones that
    are another name. Quotes are gathered for thin entities only. Null keys are nobody's; a null definition is empty; one row for each entity, of repeated
    decisions the one that says same.
    """
    thin = support.where("thin").select("entity", "sources", "references").join(decided.groupBy("entity").agg(F.max(F.coalesce("same", F.lit(False))).alias("_same")), "entity")
    rows = entities.where(F.col("kind").isin(kinds)).dropDuplicates(["entity"]).join(thin, "entity")
    known = entities.select(F.col("entity").alias("_root")).distinct()
    to = closed.select(F.col("frm").alias("entity"), F.col("root").alias("_root")).join(known, "_root")
    item = {"text": strip(F.coalesce("text", F.lit(""))), "source": F.col("source").cast("string"), "day": F.col("day").cast("string"), "title": F.coalesce("title", F.lit(""))}
    said = nest(quotes.join(thin.select("entity"), "entity", "left_semi"), "entity", [F.col("ord")], item, "quotes").drop("quotes_count")
    got = rows.join(to, "entity", "left").join(said, "entity", "left").withColumn("folded", F.col("_root").isNotNull())
    definition = squeeze(F.coalesce("definition", F.lit("")))
    return got.select("entity", "name", "kind", "sources", "references", F.coalesce("_root", "entity").alias("page"), "folded", (F.col("folded") & F.col("_same")).alias("same"), definition.alias("definition"), F.coalesce("quotes", F.array().cast(QUOTES)).alias("quotes"))


def thin_report(thin: DataFrame, names: DataFrame) -> DataFrame:
    """(folded, entity, name, block): what thin_list() has as markdown, one block for each; in the order of folded, lower(name) and entity it is the report.

    names (page, page_name, path) of all pages. Those on their own page come first, since they are the likeliest to be asides.
    """
    where = F.when(F.col("folded"), F.concat(F.lit("folded into **"), F.coalesce("page_name", F.lit("")), F.lit("**"), F.when(F.col("same"), " as another name").otherwise(""))).otherwise("own page")
    link = F.concat(F.lit(" · ["), F.col("path"), F.lit("](../"), F.col("path"), F.lit(")"))
    facts = F.concat(where, F.coalesce(link, F.lit("")), F.lit(" · "), F.col("kind"), F.lit(" · "), F.col("sources").cast("string"), F.lit(" source, "), F.col("references").cast("string"), F.lit(" references"))
    quote = lambda q: F.concat(F.lit("\n\n> "), F.when(q["text"] == "", "_(named without elaboration)_").otherwise(q["text"]), F.lit("\n> — "), F.coalesce(q["day"], F.lit("undated")), F.lit(" · "), F.coalesce(F.nullif(q["title"], F.lit("")), F.lit("untitled")))
    block = F.concat(F.lit("### "), F.col("name"), F.lit("\n\n"), facts, F.when(F.col("definition") != "", F.concat(F.lit("\n\n**Definition.** "), F.col("definition"))).otherwise(""), F.array_join(F.transform("quotes", quote), ""), F.lit("\n"))
    return thin.join(names.dropDuplicates(["page"]), "page", "left").select("folded", "entity", "name", block.alias("block"))


def fold_report(folds: DataFrame, closed: DataFrame, names: DataFrame, support: DataFrame) -> DataFrame:
    """(folds, page, entity, line): each page with what folds into it, one row a line; in the order of folds descending, page, and entity with null first it is the report.

    folds (frm, dst, same, reason), closed (frm, root): those that end on a cycle are in neither a heading nor a line. names (entity, name), support as
    measures.support() has it. A fold over others names the one it goes by. No page's folds are gathered: its lines are rows.
    """
    shown = names.dropDuplicates(["entity"]).join(support.select("entity", "sources", "references"), "entity", "left")
    known = shown.select("entity", "name", F.concat(F.lit(" `"), F.col("sources").cast("string"), F.lit("s/"), F.col("references").cast("string"), F.lit("r`")).alias("evidence"))
    lines = closed.join(folds, "frm").select(F.col("root").alias("page"), F.col("frm").alias("entity"), "dst", "same", "reason")
    counts = lines.groupBy("page").agg(F.count(F.lit(1)).alias("folds"))
    none = lambda c: F.coalesce(c, F.lit(""))
    label = lambda key: F.concat(F.coalesce("name", F.col(key).cast("string")), none(F.col("evidence")))
    heads = counts.join(known.withColumnRenamed("entity", "page"), "page", "left").select("folds", "page", F.lit(None).cast(closed.schema["frm"].dataType).alias("entity"), F.concat(F.lit("## "), label("page"), F.lit(" ("), F.col("folds").cast("string"), F.lit(")")).alias("line"))
    over = known.select(F.col("entity").alias("dst"), F.col("name").alias("_by"))
    rows = lines.join(known, "entity", "left").join(over, "dst", "left").join(counts, "page")
    by = F.when(F.col("dst") != F.col("page"), F.concat(F.lit(" (via "), F.coalesce("_by", F.col("dst").cast("string")), F.lit(")")))
    tail = F.concat(F.lit(" — "), F.nullif("reason", F.lit("")))
    same = F.when(F.col("same"), " _(same; another name)_")
    return heads.unionByName(rows.select("folds", "page", "entity", F.concat(F.lit("- "), label("entity"), none(by), none(same), none(tail)).alias("line")))


def as_lines(report: DataFrame, order: list[Column], text: str) -> DataFrame:
    """A report's text column in its order, sorted over ranges, as write.text() takes it: part after part is the document."""
    return report.orderBy(*order).select(F.col(text).alias("value"))
