"""Queries on text, links and JSON."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as X
from ..operators import integrity as I
from . import adapters as A
from .registry import query

_SLUG = r"trim(regexp_replace(regexp_replace(regexp_replace(lower(trim({0})), '[\s_]+', '-', 'g'), '[^a-z0-9-]', '', 'g'), '-+', '-', 'g'), '-')"


@query(rf"""WITH t AS (SELECT doc_id AS id, {_SLUG.format("replace(text, chr(10), ' ')")} AS s FROM documents)
SELECT id, CASE WHEN length(s) <= 80 THEN s WHEN contains(left(s, 80), '-') THEN regexp_replace(left(s, 80), '-[^-]*$', '') ELSE left(s, 80) END AS slug FROM t""")
def slugify_text(spark, d):
    return A.table(spark, d, "documents").select(F.col("doc_id").alias("id"), X.slugify(F.col("text")).alias("slug"))


@query("SELECT p_partkey AS id, trim(regexp_replace(regexp_replace(lower(trim(p_name || ' & ''' || p_type)), '[''’]', '', 'g'), '[^a-z0-9]+', '-', 'g'), '-') AS slug FROM part")
def api_slugify_text(spark, d):
    return A.table(spark, d, "part").select(F.col("p_partkey").alias("id"), X.api_slugify(F.concat("p_name", F.lit(" & '"), "p_type")).alias("slug"))


_TOKEN = "(SELECT DISTINCT unnest(string_split(lower(left_), ' ')) AS w FROM (SELECT replace(text, chr(10), ' ') AS left_ FROM documents))"


@query(f"""SELECT w, CASE WHEN w LIKE '%ies' AND length(w) > 4 THEN left(w, -3) || 'y' WHEN w LIKE '%es' AND length(w) > 3 THEN left(w, -2)
  WHEN w LIKE '%s' AND w NOT LIKE '%ss' AND contains(w, '-') AND length(w) > 2 THEN left(w, -1) ELSE w END AS one FROM {_TOKEN}""")
def depluralise(spark, d):
    w = A.table(spark, d, "documents").select(F.explode(F.split(F.lower(F.replace(F.col("text"), F.lit("\n"), F.lit(" "))), " ")).alias("w")).distinct()
    return w.select("w", X.depluralise(F.col("w")).alias("one"))


@query()
def sentence_stats(spark, d):
    t = F.col("text")
    return A.table(spark, d, "documents").select("doc_id", X.words(t).alias("words"), X.sentences(t).alias("sentences"), X.longest_sentence(t).alias("longest"), X.over_shape(F.lit(""), t).alias("over"), F.size(X.shape_problems(F.lit(""), t)).alias("problems"))


@query()
def gist(spark, d):
    return A.table(spark, d, "documents").select("doc_id", X.gist(F.col("text")).alias("gist"))


_ALIASES = f"""(SELECT id, a, i, lower(trim(name)) AS own, name, {_SLUG.format('a')} AS form FROM (SELECT p_partkey AS id, p_name AS name, unnest([upper(p_name), p_type, p_brand, lower(p_type), upper(p_brand), replace(lower(p_brand), '#', ''), p_brand || ' ' || p_type]) AS a, unnest([1, 2, 3, 4, 5, 6, 7]) AS i FROM part))"""


@query(f"""WITH a AS {_ALIASES}, f AS (SELECT DISTINCT id, form FROM a WHERE a <> form UNION SELECT p_partkey, {_SLUG.format('p_name')} FROM part),
k AS (SELECT id, a, i, row_number() OVER (PARTITION BY id, lower(a) ORDER BY i) AS rn FROM a WHERE lower(a) <> own AND NOT (a = form AND (id, form) IN (SELECT id, form FROM f)))
SELECT p_partkey AS id, (SELECT string_agg(a, ',' ORDER BY i) FROM k WHERE k.id = p_partkey AND rn = 1) AS aliases FROM part""")
def alias_display(spark, d):
    """Of a part's names in several spellings those that are to be shown."""
    p = A.table(spark, d, "part").select("p_partkey", "p_name", "p_type", "p_brand").repartition(4 * spark.sparkContext.defaultParallelism)  # the work is in the rows, of which few bytes hold many
    given = F.array(F.upper("p_name"), F.col("p_type"), F.col("p_brand"), F.lower("p_type"), F.upper("p_brand"), F.replace(F.lower("p_brand"), F.lit("#"), F.lit("")), F.concat_ws(" ", "p_brand", "p_type"))
    return p.select(F.col("p_partkey").alias("id"), F.array_join(X.display_aliases(F.col("p_name"), given), ",").alias("aliases"))


@query(r"SELECT p_partkey AS id, array_to_string(list_transform(string_split(p_name || ' mAcro x', ' '), lambda w: upper(left(w, 1)) || substr(w, 2)), ' ') AS title FROM part")
def title_case(spark, d):
    return A.table(spark, d, "part").select(F.col("p_partkey").alias("id"), X.title_case(F.concat("p_name", F.lit("  mAcro x "))).alias("title"))


@query()
def citation_normalise(spark, d):
    """Citations of several malformed kinds, injected into each whole text after 40 characters and at its end, come out in one form, once."""
    t, n = F.col("text"), (F.col("doc_id") % 7).cast("string")
    dirty = F.concat(F.substring(t, 1, 40), F.lit(" [sources/a-"), n, F.lit("] [citation needed]"), F.substr(t, F.lit(41)), F.lit(" ([[ sources/a-"), n, F.lit(" ]])"))
    return A.table(spark, d, "documents").select("doc_id", X.tidy_citations(dirty).alias("context"))


@query(f"""SELECT slug, left(h, 8) || '-' || substr(h, 9, 4) || '-5' || substr(h, 14, 3) || '-' || ['8', '9', 'a', 'b'][('0x' || substr(h, 17, 1))::INT % 4 + 1] || substr(h, 18, 3) || '-' || substr(h, 21, 12) AS id
FROM (SELECT slug, sha1(unhex('6ba7b8119dad11d180b400c04fd430c8') || encode(slug)) AS h FROM {A.ENTITIES})""")
def uuid5_ids(spark, d):
    return A.entities(spark, d).select("slug", X.uuid5("6ba7b811-9dad-11d1-80b4-00c04fd430c8", F.col("slug")).alias("id"))


@query("SELECT event_type, CAST(json_extract(props, '$.k') AS BIGINT) AS k, count(*) AS n FROM events GROUP BY 1, 2")
def json_props(spark, d):
    got = F.from_json("props", "k long, _corrupt string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"})
    return A.table(spark, d, "events").groupBy("event_type", got["k"].alias("k")).agg(F.count(F.lit(1)).alias("n"))


_HREF = "(SELECT page_id, unnest(regexp_extract_all(html, 'href=\"([^\"#?]+)', 1)) AS target FROM pages)"


@query(f"SELECT page_id, target, count(*) AS n FROM {_HREF} WHERE target NOT IN (SELECT url FROM pages) GROUP BY 1, 2")
def broken_links(spark, d):
    p = A.table(spark, d, "pages")
    found = p.select("page_id", F.explode(F.regexp_extract_all("html", F.lit('href="([^"#?]+)'), F.lit(1))).alias("target"))
    return found.join(p.select(F.col("url").alias("target")), "target", "left_anti").groupBy("page_id", "target").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT p_partkey AS path, 0 AS pos, 'p/' || (p_partkey + 1) AS target FROM part WHERE p_partkey + 1 NOT IN (SELECT p_partkey FROM part)")
def broken_wiki_links(spark, d):
    """Each part's page links to the next part's, which the last has not."""
    k = F.col("p_partkey")
    pages = A.table(spark, d, "part").select(F.concat(F.lit("p/"), k.cast("string"), F.lit(".md")).alias("path"), F.concat(F.lit("see [[p/"), (k + 1).cast("string"), F.lit("|next]] and [[p/0#top]]")).alias("text"))
    return I.broken_links(pages, "path", "text").select(F.regexp_extract("path", r"(\d+)", 1).cast("long").alias("path"), "pos", "target")


@query(f"""WITH s AS (SELECT p_partkey AS id, {_SLUG.format('p_name')} AS slug FROM part), w AS (SELECT id, slug, min(id) OVER (PARTITION BY slug) AS owner, max(id) OVER (PARTITION BY slug) = id AS used FROM s)
SELECT * FROM w WHERE id > owner""")
def slug_collisions(spark, d):
    rows = A.table(spark, d, "part").select(F.col("p_partkey").alias("id"), X.slugify(F.col("p_name")).alias("slug"))
    return I.collisions(rows, "slug", "id")


@query("""SELECT l_orderkey AS key, 'l_partkey' AS side, CAST(l_partkey AS VARCHAR) AS missing FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_partkey % 10 <> 3)
UNION ALL SELECT l_orderkey, 'l_suppkey', CAST(l_suppkey AS VARCHAR) FROM lineitem WHERE l_suppkey NOT IN (SELECT s_suppkey FROM supplier WHERE s_suppkey % 10 <> 4)""")
def dangling_refs(spark, d):
    i = A.table(spark, d, "lineitem").withColumn("key", F.col("l_orderkey"))
    return I.dangling(i, "key", {"l_partkey": (A.table(spark, d, "part").where("p_partkey % 10 <> 3"), "p_partkey"), "l_suppkey": (A.table(spark, d, "supplier").where("s_suppkey % 10 <> 4"), "s_suppkey")})
