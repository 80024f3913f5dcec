"""Queries on pages that are written as markdown, edited and read back, and on reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import markdown as MD
from ..operators import closure as C
from ..operators import documents as P
from ..operators import measures as M
from ..operators import reports as T
from ..operators import settle as S
from . import adapters as A
from .registry import query


@query("""SELECT doc_id, md5(text) AS title, lang || coalesce(',' || source, '') AS tags, md5(coalesce(lang, '-')) AS body FROM documents""")
def markdown_round_trip(spark, d):
    """Whole texts as a value of the frontmatter of a page that is written and read back, beside a list."""
    rows = A.table(spark, d, "documents").select("doc_id", MD.page_of({"title": F.col("text"), "tags": [F.col("lang"), F.col("source")]}, F.lit(""), {"Language": F.coalesce("lang", F.lit("-"))}).alias("page"))
    back = rows.select("doc_id", MD.read_page(MD.write_page(F.col("page"))).alias("page"))
    title, tags = MD.fact(F.col("page"), "title"), MD.fact(F.col("page"), "tags")
    return back.select("doc_id", F.md5(F.get(title, F.lit(0))).alias("title"), F.array_join(tags, ",").alias("tags"), F.md5(MD.section(F.col("page"), "Language")).alias("body"))


@query(f"""WITH x AS (SELECT *, kind || ',' || brand AS tags FROM {A.ENTITIES}),
p AS (SELECT entity, coalesce(s_name, 'Unknown') AS part, string_agg('- ' || key, chr(10) ORDER BY position, key) AS text FROM {A.STATEMENTS} t LEFT JOIN supplier ON s_suppkey = t.teacher WHERE t.kind <> 'mistake' GROUP BY 1, 2)
SELECT slug, tags, 'Definition' AS section, NULL AS part, brand AS text FROM x UNION ALL SELECT slug, tags, 'By teacher', part, text FROM p JOIN x ON id = entity
UNION ALL SELECT slug, tags, 'By teacher', 'Checked', 'yes' FROM x""")
def page_outline(spark, d):
    """Pages with what each teacher said, edited (two tags, one of them twice, and a part more), written, and read back by section and part."""
    names = A.table(spark, d, "supplier").select(F.col("s_suppkey").alias("teacher"), "s_name")
    told = A.statements(spark, d).where("kind <> 'mistake'").join(names, "teacher", "left").withColumn("name", F.coalesce("s_name", F.lit("Unknown")))
    by = told.groupBy(F.col("entity").alias("id"), "name").agg(F.array_sort(F.collect_list(F.struct("position", "key"))).alias("_k"))
    by = by.withColumn("body", F.array_join(F.transform("_k", lambda s: F.concat(F.lit("- "), s["key"])), "\n"))
    parts = P.nest(by, "id", [F.col("name")], {"name": F.col("name"), "body": F.concat(F.lit("\n"), F.col("body"))}, "parts")
    e = A.entities(spark, d).join(parts, "id", "left")
    page = F.col("page")
    rows = e.select("slug", "kind", "brand", MD.page_of({"slug": F.col("slug"), "tags": F.col("kind")}, F.col("name"), {"Definition": F.col("brand"), "By teacher": MD.join_parts(F.col("parts"))}).alias("page"))
    for tag in ("brand", "kind"):
        rows = rows.withColumn("page", MD.add_unique(page, "tags", F.col(tag)))
    rows = rows.withColumn("page", MD.with_part(page, "By teacher", "Checked", F.lit("yes")))
    back = rows.select("slug", MD.read_page(MD.write_page(page)).alias("page")).select("slug", F.array_join(MD.fact(page, "tags"), ",").alias("tags"), F.explode_outer("page.sections").alias("s"))
    # explode() would first ask whether there is a section, and so write and read each page again for the answer
    got = back.where("s is not null").select("slug", "tags", F.col("s.name").alias("section"), F.explode(MD.split_parts(F.col("s.body"))).alias("p"))
    return got.select("slug", "tags", "section", F.col("p.name").alias("part"), F.regexp_replace("p.body", r"\A\n+", "").alias("text")).where("part is not null or text <> ''")


_SEVENTH = f"(SELECT * FROM {A.STATEMENTS} WHERE position = 7)"
_SUPPORT = f"""(SELECT coalesce(s.entity, r.entity) AS entity, coalesce(n, 0) AS sources, CAST(coalesce(m, 0) AS BIGINT) AS refs FROM (SELECT entity, count(DISTINCT source) AS n FROM {_SEVENTH} GROUP BY entity) s
  FULL JOIN (SELECT tgt AS entity, sum(n) AS m FROM {A.OVERLAY} GROUP BY tgt) r ON s.entity = r.entity)"""
_THIN = f"""closed1 AS (SELECT DISTINCT frm, root FROM closed WHERE root IN (SELECT id FROM {A.ENTITIES})),
q AS (SELECT entity, string_agg(key || '@' || source || '@' || coalesce(CAST(day AS VARCHAR), '') || '@' || coalesce(session, ''), ' ' ORDER BY source, key) AS quotes, count(*) AS n FROM {_SEVENTH} t LEFT JOIN {A.SOURCES} s ON s.id = t.source GROUP BY entity),
thin AS (SELECT x.id AS entity, x.name, x.kind, sources, refs, coalesce(root, x.id) AS page, root IS NOT NULL AS folded, root IS NOT NULL AND size % 2 = 0 AS same, brand AS definition, coalesce(quotes, '') AS quotes
  FROM {A.ENTITIES} x JOIN {_SUPPORT} s ON s.entity = x.id LEFT JOIN closed1 ON frm = x.id LEFT JOIN q ON q.entity = x.id WHERE sources <= 1 AND refs <= 1 AND x.kind <> 'drill' AND size % 7 <> 0)"""


def _support(spark, d):
    """Support by what is said in the seventh place, which most entities have little of."""
    s = A.statements(spark, d).where("position = 7")
    return M.support(s.select("entity", "source"), S.overlay(A.events(spark, d)).select(F.col("tgt").alias("entity"), "n"))


def _thin(spark, d):
    e = A.entities(spark, d)
    s = A.sources(spark, d).select(F.col("id").alias("source"), "day", F.col("session").alias("title"))
    quotes = A.statements(spark, d).where("position = 7").join(s, "source", "left").select("entity", F.col("key").alias("text"), "source", "day", "title", F.struct("source", "key").alias("ord"))
    decided = e.where("size % 7 <> 0").select(F.col("id").alias("entity"), (F.col("size") % 2 == 0).alias("same"))
    known = e.select(F.col("id").alias("entity"), "name", "kind", F.col("brand").alias("definition"))
    return T.thin_list(known, _support(spark, d), decided, C.fold_closure(A.folds(spark, d)), quotes, ["concept", "technique", "pattern"])


@query(f"""WITH RECURSIVE {A.CLOSURE}, {_THIN} SELECT entity, name, kind, sources, refs AS "references", page, folded, same, definition, quotes FROM thin""")
def thin_entities(spark, d):
    """Thin entities with where they went and each quote as text, source, day and title."""
    quote = lambda q: F.concat_ws("@", q["text"], q["source"], F.coalesce(q["day"], F.lit("")), q["title"])
    return _thin(spark, d).withColumn("quotes", F.array_join(F.transform("quotes", quote), " "))


@query(f"""WITH RECURSIVE {A.CLOSURE}, {_THIN},
b AS (SELECT entity, string_agg(chr(10) || chr(10) || '> ' || key || chr(10) || '> — ' || coalesce(CAST(day AS VARCHAR), 'undated') || ' · ' || coalesce(session, 'untitled'), '' ORDER BY source, key) AS said FROM {_SEVENTH} t LEFT JOIN {A.SOURCES} s ON s.id = t.source GROUP BY entity)
SELECT t.folded, t.entity, t.name, '### ' || t.name || chr(10) || chr(10) || CASE WHEN folded THEN 'folded into **' || x.name || '**' || CASE WHEN same THEN ' as another name' ELSE '' END ELSE 'own page' END || ' · [' || x.kind || 's/' || x.slug || '.md](../' || x.kind || 's/' || x.slug || '.md) · '
  || t.kind || ' · ' || sources || ' source, ' || refs || ' references' || chr(10) || chr(10) || '**Definition.** ' || definition || coalesce(said, '') || chr(10) AS block
FROM thin t JOIN {A.ENTITIES} x ON x.id = t.page LEFT JOIN b ON b.entity = t.entity""")
def thin_review(spark, d):
    """The report of thin entities, a block each."""
    names = A.entities(spark, d).select(F.col("id").alias("page"), F.col("name").alias("page_name"), F.concat(F.col("kind"), F.lit("s/"), F.col("slug"), F.lit(".md")).alias("path"))
    return T.thin_report(_thin(spark, d), names)


@query(f"""WITH RECURSIVE {A.CLOSURE}, l AS (SELECT DISTINCT root AS page, c.frm AS entity, f.dst, f.listed FROM closed c JOIN {A.FOLDS} f ON f.frm = c.frm), n AS (SELECT page, count(*) AS folds FROM l GROUP BY page),
k AS (SELECT id, name || coalesce(' `' || sources || 's/' || refs || 'r`', '') AS label, name FROM {A.ENTITIES} LEFT JOIN {_SUPPORT} s ON s.entity = id)
SELECT folds, n.page, NULL AS entity, '## ' || coalesce(label, CAST(n.page AS VARCHAR)) || ' (' || folds || ')' AS line FROM n LEFT JOIN k ON k.id = n.page
UNION ALL SELECT folds, l.page, l.entity, '- ' || k.label || CASE WHEN l.dst <> l.page THEN ' (via ' || coalesce(v.name, CAST(l.dst AS VARCHAR)) || ')' ELSE '' END || CASE WHEN l.listed THEN ' _(same; another name)_' ELSE '' END || ' — seen ' || l.dst AS line
FROM l JOIN n ON n.page = l.page JOIN k ON k.id = l.entity LEFT JOIN k v ON v.id = l.dst""")
def fold_review(spark, d):
    """The report of folds, a line each."""
    folds = A.folds(spark, d).select("frm", "dst", F.col("listed").alias("same"), F.concat(F.lit("seen "), F.col("dst").cast("string")).alias("reason"))
    names = A.entities(spark, d).select(F.col("id").alias("entity"), "name")
    return T.fold_report(folds, C.fold_closure(A.folds(spark, d)), names, _support(spark, d))
