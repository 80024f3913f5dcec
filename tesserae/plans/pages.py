"""Queries on pages of sources, teachers and views, and on what is to be written or removed."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as X
from ..operators import closure as C
from ..operators import documents as P
from ..operators import integrity as I
from ..operators import resolve as R
from . import adapters as A
from .measures import CREDITED, _credited
from .registry import query


def _line(*names: str) -> dict:
    """The payload of a list of lines; they are made of rows, and not of what is gathered."""
    return {"line": F.concat(F.lit("- "), F.concat_ws(" ", *names))}


def _lines(column: str):
    return F.coalesce(F.col(column)["line"], F.array().cast("array<string>"))


def _page(rows: DataFrame, folder: str, slug: str, title: str, facts: dict, sections: dict) -> DataFrame:
    path = F.concat(F.lit(f"{folder}/"), F.col(slug).cast("string"), F.lit(".md"))
    return rows.select(path.alias("path"), P.markdown(F.col(title).cast("string"), facts, sections).alias("text"))


@query(f"""SELECT id, CAST(day AS VARCHAR) || '-' || coalesce(nullif(trim(regexp_replace(session, '[^a-z0-9]+', '-', 'g'), '-'), ''), 'unknown') AS slug, count(key) AS n, count(DISTINCT entity) AS entities
FROM {A.SOURCES} s LEFT JOIN {A.STATEMENTS} t ON t.source = s.id GROUP BY id, day, session""")
def source_index(spark, d):
    """Each source's slug and what was said in it, in (entity, position, key) order for its page."""
    s = A.sources(spark, d).select("id", F.concat_ws("-", F.date_format("day", "yyyy-MM-dd"), F.coalesce(F.nullif(X.api_slugify(F.col("session")), F.lit("")), F.lit("unknown"))).alias("slug"))
    t = A.statements(spark, d).groupBy("source").agg(F.count("key").alias("n"), F.countDistinct("entity").alias("entities"))
    return s.join(t, s["id"] == t["source"], "left").select("id", "slug", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("entities", F.lit(0)).alias("entities"))


def _source_pages(spark, d):
    told = A.statements(spark, d).join(A.entities(spark, d).select(F.col("id").alias("entity"), "slug", F.col("kind").alias("of")), "entity")
    order, line = [F.col("entity"), F.col("position"), F.col("key")], _line("slug", "key")
    said = P.lists(told.withColumnRenamed("source", "id"), "id", {"taught": (F.col("kind") == "taught", order, line), "mistakes": (F.col("kind") == "mistake", order, line)})
    pages = A.sources(spark, d).select("id", "day", "session", "public")
    got = P.assemble(pages, "id", [said])
    return _page(got, "sources", "id", "session", {"date": F.col("day"), "public": F.col("public")}, {"Taught": _lines("taught"), "Mistakes": _lines("mistakes")})


@query(f"""WITH t AS (SELECT source, t.kind, entity, position, key, slug FROM {A.STATEMENTS} t JOIN {A.ENTITIES} x ON x.id = entity),
l AS (SELECT source, {A.lines_sql("slug || ' ' || key", "entity, position, key", "kind = 'taught'")} AS taught, {A.lines_sql("slug || ' ' || key", "entity, position, key", "kind = 'mistake'")} AS wrong FROM t GROUP BY source)
SELECT 'sources/' || id || '.md' AS path, {A.page_sql("session", {"date": "CAST(day AS VARCHAR)", "public": "CAST(public AS VARCHAR)"}, {"Taught": "taught", "Mistakes": "wrong"})} AS text FROM {A.SOURCES} LEFT JOIN l ON source = id""")
def source_pages(spark, d):
    return _source_pages(spark, d)


@query(f"""SELECT credited, kind, count(DISTINCT entity) AS entities, count(DISTINCT source) AS sources FROM (SELECT c.credited, c.entity, c.source, x.kind FROM {CREDITED} c JOIN {A.ENTITIES} x ON x.id = c.entity) GROUP BY credited, kind""")
def instructor_kinds(spark, d):
    e = A.entities(spark, d).select(F.col("id").alias("entity"), F.col("kind").alias("of"))
    return _credited(spark, d).join(e, "entity").groupBy("credited", F.col("of").alias("kind")).agg(F.countDistinct("entity").alias("entities"), F.countDistinct("source").alias("sources"))


def _instructor_pages(spark, d):
    """Ids are shuffled by source, by entity and by teacher; a slug goes with each of an entity's teachers once, and lines are made where they are gathered."""
    tasks, kinds = A.order_tasks(spark, d), ("concept", "technique", "pattern", "drill")
    of = F.array_position(F.array(*map(F.lit, kinds)), F.col("kind")).cast("tinyint").alias("of")
    e = A.entities(spark, d).select(F.col("id").alias("entity"), "slug", of).repartition(tasks, "entity").distinct()
    s = A.own(A.statements(spark, d))
    each = R.credited(s, ["entity"], tasks=tasks).repartition(tasks, "entity").select("entity", F.explode("credited").alias("credited")).distinct()
    taught = each.join(e, "entity").select("credited", "slug", "of")
    day = A.sources(spark, d).select(F.col("id").alias("source"), "day").repartition(tasks, "source")
    seen = R.credited_in(s, tasks=tasks).join(day, "source")
    line = {"line": F.concat(F.lit("- "), F.concat_ws(" ", F.date_format("day", "yyyy-MM-dd"), "source"))}
    when = P.nest(seen, "credited", [F.col("day"), F.col("source")], line, "seen")
    pages = A.table(spark, d, "supplier").select(F.col("s_suppkey").alias("credited"), "s_name")
    got = P.assemble(pages, "credited", [P.lists(taught, "credited", {k: (F.col("of") == i, [F.lower("slug")], _line("slug")) for i, k in enumerate(kinds, 1)}), when])
    return _page(got, "instructors", "credited", "s_name", {"sources": F.col("seen_count")}, {**{k.title(): _lines(k) for k in kinds}, "Sources": _lines("seen")})


_KIND_LINES = ", ".join(A.lines_sql("slug", "lower(slug), slug", f"kind = '{k}'") + f" AS {k}" for k in ("concept", "technique", "pattern", "drill"))


@query(f"""WITH c AS (SELECT credited, entity, source FROM {CREDITED}), k AS (SELECT credited, {_KIND_LINES} FROM (SELECT DISTINCT credited, slug, x.kind FROM c JOIN {A.ENTITIES} x ON x.id = entity) GROUP BY credited),
w AS (SELECT credited, count(*) AS n, {A.lines_sql("day || ' ' || source", "day, source")} AS seen FROM (SELECT DISTINCT credited, source, CAST(day AS VARCHAR) AS day FROM c JOIN {A.SOURCES} s ON s.id = source) GROUP BY credited)
SELECT 'instructors/' || s_suppkey || '.md' AS path, {A.page_sql("s_name", {"sources": "coalesce(n, 0)"}, {"Concept": "concept", "Technique": "technique", "Pattern": "pattern", "Drill": "drill", "Sources": "seen"})} AS text
FROM supplier LEFT JOIN k ON k.credited = s_suppkey LEFT JOIN w ON w.credited = s_suppkey""")
def instructor_pages(spark, d):
    return _instructor_pages(spark, d)


VIEWS = {"urgent": ["urgent"], "high": ["high"], "building-high": ["Building", "high"]}


def _view_sources(spark, d):
    rows = A.table(spark, d, "orders").join(A.table(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    names = F.array("c_mktsegment", "o_orderpriority")
    return reduce(DataFrame.unionByName, [R.in_view(rows, names, F.array(*map(F.lit, w))).select(F.lit(v).alias("view"), F.col("o_orderkey").alias("source"), F.to_date("o_orderdate").alias("day")) for v, w in VIEWS.items()])


@query(f"""WITH v AS (SELECT CASE n WHEN 0 THEN 'urgent' WHEN 1 THEN 'high' ELSE 'building-high' END AS view, o_orderkey AS source FROM orders JOIN customer ON c_custkey = o_custkey, (SELECT unnest([0, 1, 2]) AS n)
  WHERE (n = 0 AND contains(lower(o_orderpriority), 'urgent')) OR (n = 1 AND contains(lower(o_orderpriority), 'high')) OR (n = 2 AND contains(lower(o_orderpriority), 'high') AND contains(lower(c_mktsegment), 'building')))
SELECT view, kind, count(DISTINCT entity) AS touched, count(DISTINCT v.source) AS sources FROM v JOIN (SELECT source, entity, x.kind FROM {A.STATEMENTS} t JOIN {A.ENTITIES} x ON x.id = t.entity) t ON t.source = v.source GROUP BY view, kind""")
def view_touched(spark, d):
    e = A.entities(spark, d).select(F.col("id").alias("entity"), F.col("kind").alias("of"))
    told = A.statements(spark, d).select("source", "entity").distinct().join(e, "entity")
    return _view_sources(spark, d).join(told, "source").groupBy("view", F.col("of").alias("kind")).agg(F.countDistinct("entity").alias("touched"), F.countDistinct("source").alias("sources"))


def _view_pages(spark, d):
    sources = _view_sources(spark, d).withColumn("text", F.date_format("day", "yyyy-MM-dd"))
    seen = P.nest(sources, "view", [F.col("text"), F.col("source")], _line("text", "source"), "seen")
    pages = spark.createDataFrame([(v,) for v in VIEWS], "view string")
    return _page(P.assemble(pages, "view", [seen]), "views", "view", "view", {"sources": F.col("seen_count")}, {"Sources": _lines("seen")})


@query(f"""WITH v AS (SELECT ['urgent', 'high', 'building-high'][n + 1] AS view, o_orderkey AS source, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS day FROM orders JOIN customer ON c_custkey = o_custkey, (SELECT unnest([0, 1, 2]) AS n)
  WHERE contains(lower(o_orderpriority), CASE n WHEN 0 THEN 'urgent' ELSE 'high' END) AND (n < 2 OR contains(lower(c_mktsegment), 'building'))),
l AS (SELECT view, count(*) AS n, {A.lines_sql("day || ' ' || source", "day, source")} AS seen FROM v GROUP BY view)
SELECT 'views/' || x.view || '.md' AS path, {A.page_sql("x.view", {"sources": "coalesce(n, 0)"}, {"Sources": "seen"})} AS text FROM (SELECT unnest(['urgent', 'high', 'building-high']) AS view) x LEFT JOIN l ON l.view = x.view""")
def view_pages(spark, d):
    return _view_pages(spark, d)


@query("SELECT 'sources' AS section, count(*) AS pages FROM orders UNION ALL SELECT 'instructors', count(*) FROM supplier UNION ALL SELECT 'views', 3")
def bundle_sections(spark, d):
    """The bundle is the union of all kinds of pages by path."""
    return bundle(spark, d).groupBy(F.substring_index("path", "/", 1).alias("section")).agg(F.count(F.lit(1)).alias("pages"))


def bundle(spark, d) -> DataFrame:
    return _source_pages(spark, d).unionByName(_instructor_pages(spark, d)).unionByName(_view_pages(spark, d))


@query("SELECT 'instructors/' || (s_suppkey + 1000) || '.md' AS path FROM supplier WHERE s_suppkey + 1000 NOT IN (SELECT s_suppkey FROM supplier)")
def stale_paths(spark, d):
    """Paths of a folder that holds each teacher's page and one more for each, which no page expects."""
    s = A.table(spark, d, "supplier")
    path = lambda k: F.concat(F.lit("instructors/"), F.expr(k).cast("string"), F.lit(".md")).alias("path")
    have = s.select(path("s_suppkey")).unionByName(s.select(path("s_suppkey + 1000")))
    return I.stale_paths(have, s.select(path("s_suppkey")))


@query(f"""WITH RECURSIVE {A.CLOSURE}, asked AS (SELECT l_partkey AS id FROM lineitem WHERE l_returnflag = 'R'), t AS (SELECT DISTINCT coalesce(root, id) AS id FROM asked LEFT JOIN closed ON frm = id)
SELECT id, 'write' AS act FROM t UNION ALL SELECT frm, 'remove' FROM closed WHERE root IN (SELECT id FROM t) AND frm NOT IN (SELECT id FROM t)""")
def materialise_sets(spark, d):
    """Which pages the entities of mistakes lead to, and which folded ones are removed with them."""
    closed = C.cut(C.fold_closure(A.folds(spark, d)))  # one table: Spark makes a semi- or anti-join with a union anew for each part of it, here for each round
    asked = A.table(spark, d, "lineitem").where("l_returnflag = 'R'").select(F.col("l_partkey").alias("id")).distinct()
    to = C.repoint(asked, closed, "id").distinct()
    gone = closed.join(to, closed["root"] == to["id"], "left_semi").select(F.col("frm").alias("id")).join(to, "id", "left_anti")
    return to.withColumn("act", F.lit("write")).unionByName(gone.withColumn("act", F.lit("remove")))


_PROMPTS = """(SELECT conv_id, repeat('{"id":1}', CAST(turn % 3 AS INT)) || text AS prompt FROM conversations)"""


@query(f"""SELECT conv_id, CAST(sum(length(prompt) // 4) AS BIGINT) AS input, CAST(sum(CASE WHEN contains(prompt, '"id":') THEN 50 * ((length(prompt) - length(replace(prompt, '"id":', ''))) // 5) ELSE 300 END) AS BIGINT) AS output FROM {_PROMPTS} GROUP BY conv_id""")
def dry_run_estimate(spark, d):
    """Turns as prompts that ask for none, one or two entries by id."""
    c = A.table(spark, d, "conversations").select("conv_id", F.concat(F.repeat(F.lit('{"id":1}'), (F.col("turn") % 3).cast("int")), "text").alias("prompt"))
    return c.groupBy("conv_id").agg(F.sum(X.tokens(F.col("prompt"))).alias("input"), F.sum(X.output_tokens(F.col("prompt"))).alias("output"))


@query(f"SELECT id, row_number() OVER (PARTITION BY kind ORDER BY lower(name), id) AS pos, kind FROM {A.ENTITIES}")
def case_insensitive_order(spark, d):
    rn = F.row_number().over(Window.partitionBy("kind").orderBy(F.lower("name"), "id"))
    return A.entities(spark, d).select("id", rn.cast("long").alias("pos"), "kind")
