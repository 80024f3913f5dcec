"""Comparing, merging and syncing keyed snapshots."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def fingerprint(df: DataFrame, keys: list[str]) -> Column:
    """A hash of a row's other columns as JSON in the order of their names; a null column is as if absent."""
    return F.sha2(F.to_json(F.struct(*sorted(c for c in df.columns if c not in keys))), 256)


def snapshot_diff(old: DataFrame, new: DataFrame, keys: list[str], unchanged: bool = False) -> DataFrame:
    """keys and state: created, changed, removed, and if asked for unchanged. One full outer join of keys and hashes."""
    a = old.select(*keys, fingerprint(old, keys).alias("_a"))
    b = new.select(*keys, fingerprint(new, keys).alias("_b"))
    state = F.when(F.col("_a").isNull(), "created").when(F.col("_b").isNull(), "removed").when(F.col("_a") == F.col("_b"), "unchanged").otherwise("changed")
    got = a.join(b, keys, "full_outer").select(*keys, state.alias("state"))
    return got if unchanged else got.where("state <> 'unchanged'")


def leaves(schema: T.StructType, at: str = "") -> list[str]:
    """The paths of a schema's fields, structs walked to any depth; arrays and maps are one field."""
    out = []
    for f in schema:
        path = f"{at}`{f.name.replace('`', '``')}`"
        out += leaves(f.dataType, f"{path}.") if isinstance(f.dataType, T.StructType) else [path]
    return out


def field_diff(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """keys, path, old and new: a row for each field that differs between two copies of a keyed table, headers as well as entries.

    Structs are compared field by field, whichever of the copies has the field; a null, a missing field and a struct of nulls are alike. Values are
    text, arrays and maps JSON. A key of one copy alone has one row, with the path * and the row as JSON on its side. Keys are null-safe: a
    null key meets a null key. Keys that repeat are compared each with each.
    """
    paths = {p: None for t in (old, new) for p in leaves(T.StructType([f for f in t.schema if f.name not in keys]))}
    text = lambda t, p: _text_of(t, p) if p in have[id(t)] else F.lit(None).cast("string")
    have = {id(t): set(leaves(t.schema)) for t in (old, new)}
    row = lambda t: F.to_json(F.struct(*[F.col(f"`{c}`") for c in t.columns if c not in keys]))
    a = old.select(*[F.col(f"`{k}`").alias(f"_a{i}") for i, k in enumerate(keys)], F.array(*[text(old, p) for p in paths]).alias("_a"), row(old).alias("_old"), F.lit(True).alias("_ina"))
    b = new.select(*[F.col(f"`{k}`").alias(f"_b{i}") for i, k in enumerate(keys)], F.array(*[text(new, p) for p in paths]).alias("_b"), row(new).alias("_new"), F.lit(True).alias("_inb"))
    on = [F.col(f"_a{i}").eqNullSafe(F.col(f"_b{i}")) for i in range(len(keys))]
    names = F.array(*[F.lit(p.replace("`", "")) for p in paths])
    each = F.zip_with(names, F.arrays_zip("_a", "_b"), lambda n, v: F.struct(n.alias("path"), v["_a"].alias("old"), v["_b"].alias("new")))
    alone = F.array(F.struct(F.lit("*").alias("path"), F.col("_old").alias("old"), F.col("_new").alias("new")))
    both = F.col("_ina").isNotNull() & F.col("_inb").isNotNull()
    rows = a.join(b, on, "full_outer").withColumn("_f", F.explode(F.when(both, F.filter(each, lambda f: ~f["old"].eqNullSafe(f["new"]))).otherwise(alone)))
    return rows.select(*[F.coalesce(f"_a{i}", f"_b{i}").alias(k) for i, k in enumerate(keys)], "_f.path", "_f.old", "_f.new")


def _text_of(t: DataFrame, path: str) -> Column:
    kind = t.select(F.col(path)).schema[0].dataType
    return F.to_json(F.col(path)) if isinstance(kind, (T.ArrayType, T.MapType)) else F.col(path).cast("string")


def upsert(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """old with the rows of new in place of those with the same keys."""
    return old.join(new.select(*keys), keys, "left_anti").unionByName(new, allowMissingColumns=True)


def delta(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """The rows of new that are not in old as they are."""
    mark = new.withColumn("_b", fingerprint(new, keys))
    known = old.select(*keys, fingerprint(old, keys).alias("_b"))
    return mark.join(known, [*keys, "_b"], "left_anti").drop("_b").select(*new.columns)


def pending(rows: DataFrame, done: DataFrame, keys: list[str], version: str | None = None) -> DataFrame:
    """Rows whose keys were not done, at the version if one is given: the watermark of incremental runs."""
    seen = done.where(F.col("version") == version) if version is not None else done
    return rows.join(seen.select(*keys), keys, "left_anti")


def latest(events: DataFrame, key: str, *order: str) -> DataFrame:
    """Each key's last event by an order: one aggregation."""
    return events.groupBy(key).agg(F.max_by(F.struct(*[c for c in events.columns if c != key]), F.struct(*order)).alias("_r")).select(key, "_r.*")


PROSE = "slug string, version string, model string, generated_at string, definition string, context string, integrated array<string>, revisions array<struct<by:string,at:string,model:string,statements:int,definition:string,context:string>>"


def current(state: DataFrame, version: str) -> DataFrame:
    """The texts of one version; what another wrote counts as absent."""
    return state.where(F.col("version") == version)


def record_revision(state: DataFrame, answers: DataFrame, model: str, at: str, version: str) -> DataFrame:
    """state (PROSE) with answers (slug, definition, context, keys) as its texts and as one more revision by llm each.

    keys are the statements that an answer took in, covered those seen besides, if there is such a column: both count as integrated,
    together with earlier ones of the same version. The history stays across versions.
    """
    covered = F.coalesce("_covered", F.array().cast("array<string>")) if "covered" in answers.columns else F.array().cast("array<string>")
    a = answers.select("slug", *[F.col(c).alias(f"_{c}") for c in ("definition", "context", "keys", "covered") if c in answers.columns], F.lit(True).alias("_told"))
    keys = F.coalesce("_keys", F.array().cast("array<string>"))
    before = F.when(F.col("version") == version, F.col("integrated")).otherwise(F.array().cast("array<string>"))
    entry = F.struct(F.lit("llm").alias("by"), F.lit(at).alias("at"), F.lit(model).alias("model"), F.size(keys).alias("statements"), F.col("_definition").alias("definition"), F.col("_context").alias("context"))
    history = F.coalesce("revisions", F.array().cast(state.schema["revisions"].dataType))
    new = {
        "version": F.lit(version), "model": F.lit(model), "generated_at": F.lit(at), "definition": F.col("_definition"), "context": F.col("_context"),
        "integrated": F.array_sort(F.array_distinct(F.concat(F.coalesce(before, F.array().cast("array<string>")), keys, covered))), "revisions": F.array_append(history, entry),
    }
    both = state.join(a, "slug", "full_outer")
    return both.select("slug", *[F.when(F.col("_told"), v).otherwise(F.col(n)).alias(n) for n, v in new.items()])


def human_chosen(revisions: Column) -> Column:
    """Whether a person chose the text last: by an edit on the page, or by taking a rewrite back."""
    return F.coalesce(F.try_element_at(revisions, F.lit(-1))["by"] == "page", F.lit(False))


def written_by_us(revisions: Column, definition: Column, context: Column) -> Column:
    """Whether any revision by llm has this text."""
    return F.coalesce(F.exists(revisions, lambda r: (r["by"] == "llm") & (F.coalesce(r["definition"], F.lit("")) == definition) & (F.coalesce(r["context"], F.lit("")) == context)), F.lit(False))


def page_as_base(state: DataFrame, pages: DataFrame, at: str, version: str | None = None, normalise: Callable[[Column], Column] | None = None) -> DataFrame:
    """state with the texts of pages (slug, definition, context) that no revision by llm has: an edit by a person, taken as text and as a revision by page.

    A page with text and without an entry gets one of the version, with that revision and nothing integrated. Texts are compared as normalise makes
    them, on both sides, where it is given: a link that was repaired since is no edit. A page without text, or whose text a person's revision already
    holds last, changes nothing; nor do entries without a page.
    """
    same_form = normalise or (lambda c: c)
    p = pages.where("slug is not null").groupBy("slug").agg(F.first(F.struct("definition", "context")).alias("_p")).select("slug", F.coalesce("_p.definition", F.lit("")).alias("_d"), F.coalesce("_p.context", F.lit("")).alias("_c"))
    rows = state.withColumn("_had", F.lit(True)).join(p, "slug", "full_outer")
    d, c = same_form(F.col("_d")), same_form(F.col("_c"))
    ours = F.coalesce(F.exists("revisions", lambda r: (r["by"] == "llm") & (same_form(F.coalesce(r["definition"], F.lit(""))) == d) & (same_form(F.coalesce(r["context"], F.lit(""))) == c)), F.lit(False))
    same = (F.coalesce("definition", F.lit("")) == F.col("_d")) & (F.coalesce("context", F.lit("")) == F.col("_c"))
    edited = F.coalesce((F.col("_d") != "") | (F.col("_c") != ""), F.lit(False)) & ~ours & ~(human_chosen(F.col("revisions")) & same)
    history = F.coalesce("revisions", F.array().cast(state.schema["revisions"].dataType))
    new = {"definition": F.col("_d"), "context": F.col("_c"), "revisions": F.array_append(history, _by_page(at, F.col("_d"), F.col("_c"))), "integrated": F.coalesce("integrated", F.array().cast("array<string>")), "version": F.coalesce("version", F.lit(version).cast("string"))}
    rows = rows.where(F.col("_had") | edited)
    return rows.select(*[F.when(edited, new[n]).otherwise(F.col(n)).alias(n) if n in new else F.col(n) for n in state.columns])


def _by_page(at: str, definition: Column, context: Column) -> Column:
    return F.struct(F.lit("page").alias("by"), F.lit(at).alias("at"), F.lit(None).cast("string").alias("model"), F.lit(None).cast("int").alias("statements"), definition.alias("definition"), context.alias("context"))


def revert(state: DataFrame, at: str) -> DataFrame:
    """state with the last text taken back where that was a rewrite, a revision by llm that took in no statements; result says reverted or why not.

    The text before it becomes one more revision, by page, so that it counts as chosen by a person.
    """
    last, before = F.try_element_at("revisions", F.lit(-1)), F.try_element_at("revisions", F.lit(-2))
    why = (
        F.when(before.isNull(), "nothing before")
        .when(last["by"] == "page", "chosen by a person")
        .when((last["by"] != "llm") | ~F.coalesce(last["statements"] == 0, F.lit(False)), "took in evidence")
        .otherwise("reverted")
    )
    ok = why == "reverted"
    old = {c: F.coalesce(before[c], F.lit("")) for c in ("definition", "context")}
    entry = _by_page(at, old["definition"], old["context"])
    return state.select(*[F.when(ok, old[c]).otherwise(F.col(c)).alias(c) if c in old else F.when(ok, F.array_append(c, entry)).otherwise(F.col(c)).alias(c) if c == "revisions" else F.col(c) for c in state.columns], why.alias("result"))
