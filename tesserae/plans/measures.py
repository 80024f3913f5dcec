"""Queries on support, credit, resolution and evidence."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as X
from ..operators import measures as M
from ..operators import resolve as R
from ..operators import settle as S
from . import adapters as A
from .registry import query


@query(f"""SELECT kind, key, entity, text FROM (
  SELECT 'attribution' AS kind, key, entity, concat_ws(' — ', kind, key) AS text FROM {A.STATEMENTS}
  UNION ALL SELECT 'definition', CAST(p_partkey AS VARCHAR), p_partkey, concat_ws(' — ', p_name, p_brand) FROM part
  UNION ALL SELECT 'relation', ord, frm, concat_ws(' — ', kind, ord) FROM {A.RELATIONS}) WHERE entity IN (SELECT p_partkey FROM part WHERE p_size > 10)""")
def statements_union(spark, d):
    s = A.statements(spark, d).select(F.lit("attribution").alias("kind"), "key", "entity", X.joined(F.col("kind"), F.col("key")).alias("text"))
    p = A.table(spark, d, "part").select(F.lit("definition").alias("kind"), F.col("p_partkey").cast("string").alias("key"), F.col("p_partkey").alias("entity"), X.joined(F.col("p_name"), F.col("p_brand")).alias("text"))
    r = A.relations(spark, d).select(F.lit("relation").alias("kind"), F.col("ord").alias("key"), F.col("frm").alias("entity"), X.joined(F.col("kind"), F.col("ord")).alias("text"))
    known = A.table(spark, d, "part").where("p_size > 10").select(F.col("p_partkey").alias("entity"))
    return s.unionByName(p).unionByName(r).where(F.length("text") > 0).join(known, "entity", "left_semi").select("kind", "key", "entity", "text")


@query(f"""WITH s AS (SELECT entity, count(DISTINCT coalesce(CAST(CASE WHEN position > 1 THEN source END AS VARCHAR), '-')) AS sources FROM {A.STATEMENTS} GROUP BY entity),
r AS (SELECT tgt AS entity, sum(n) AS "references" FROM {A.OVERLAY} GROUP BY tgt)
SELECT coalesce(s.entity, r.entity) AS entity, coalesce(sources, 0) AS sources, CAST(coalesce("references", 0) AS BIGINT) AS "references", CAST(coalesce(sources, 0) + coalesce("references", 0) AS BIGINT) AS weight,
  coalesce(sources, 0) <= 1 AND coalesce("references", 0) <= 1 AS thin FROM s FULL JOIN r ON s.entity = r.entity""")
def support_counts(spark, d):
    s = A.statements(spark, d).select("entity", F.when(F.col("position") > 1, F.col("source")).alias("source"))
    return M.support(s, S.overlay(A.events(spark, d)).select(F.col("tgt").alias("entity"), "n"))


@query(f"""WITH s AS (SELECT entity, count(DISTINCT source) AS n FROM {A.STATEMENTS} GROUP BY entity), r AS (SELECT DISTINCT frm AS e FROM {A.RELATIONS} UNION SELECT dst FROM {A.RELATIONS})
SELECT kind, count(*) AS entities, count(*) FILTER (n IS NULL) AS thin, count(*) FILTER (n = 1) AS single_source, count(*) FILTER (r.e IS NULL) AS isolated
FROM {A.ENTITIES} x LEFT JOIN s ON s.entity = x.id LEFT JOIN r ON r.e = x.id GROUP BY kind""")
def corpus_quality(spark, d):
    rel = S.both_directions(A.relations(spark, d), "frm", "dst").select(F.col("e").alias("entity"))
    return M.quality(A.entities(spark, d), A.statements(spark, d), rel)


@query(f"SELECT coalesce(kind, 'all') AS kind, count(*) AS n, count(DISTINCT brand) AS brands FROM {A.ENTITIES} GROUP BY GROUPING SETS ((kind), ())")
def kind_counts(spark, d):
    return A.entities(spark, d).rollup("kind").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("brand").alias("brands")).select(F.coalesce("kind", F.lit("all")).alias("kind"), "n", "brands")


SOURCE_PEOPLE = f"(SELECT DISTINCT source, raw AS person FROM {A.STATEMENTS})"
CREDITED = f"""(SELECT key, entity, source, kind, teacher AS credited FROM {A.STATEMENTS} WHERE teacher IS NOT NULL
  UNION ALL SELECT s.key, s.entity, s.source, s.kind, p.person FROM {A.STATEMENTS} s JOIN {SOURCE_PEOPLE} p ON p.source = s.source WHERE s.teacher IS NULL)"""


def _credited(spark, d):
    s = A.statements(spark, d)
    return R.credits(s, s.select("source", F.col("raw").alias("person")), tasks=A.order_tasks(spark, d))


@query(f"SELECT entity, list(DISTINCT s_name ORDER BY s_name) AS teachers FROM {CREDITED} JOIN supplier ON s_suppkey = credited GROUP BY entity")
def teachers_per_entity(spark, d):
    names = A.table(spark, d, "supplier").select(F.col("s_suppkey").alias("credited"), "s_name")
    return _credited(spark, d).select("entity", "credited").distinct().join(names, "credited").groupBy("entity").agg(F.array_sort(F.collect_set("s_name")).alias("teachers"))


@query(f"SELECT entity, list(DISTINCT id ORDER BY id) AS sources FROM (SELECT entity, source FROM {A.STATEMENTS} UNION ALL SELECT frm, CAST(split_part(ord, '-', 1) AS BIGINT) // 8 FROM {A.RELATIONS}) JOIN {A.SOURCES} ON id = source GROUP BY entity")
def sources_per_entity(spark, d):
    r = A.relations(spark, d).select(F.col("frm").alias("entity"), F.floor(F.split("ord", "-")[0].cast("long") / 8).alias("source"))
    both = A.statements(spark, d).select("entity", "source").unionByName(r).distinct()
    return both.join(A.sources(spark, d).select(F.col("id").alias("source")), "source").groupBy("entity").agg(F.array_sort(F.collect_set("source")).alias("sources"))


@query(f"""SELECT entity, teacher, array_to_string(list(key ORDER BY position, key), ',') AS statements, count(*) AS n FROM (SELECT entity, position, key, coalesce(s_name, 'Unknown') AS teacher
  FROM {A.STATEMENTS} LEFT JOIN supplier ON s_suppkey = teacher WHERE kind <> 'mistake') GROUP BY entity, teacher""")
def by_teacher_nested(spark, d):
    names = A.table(spark, d, "supplier").select(F.col("s_suppkey").alias("teacher"), "s_name")
    rows = A.statements(spark, d).where("kind <> 'mistake'").join(names, "teacher", "left").select("entity", F.coalesce("s_name", F.lit("Unknown")).alias("teacher"), "position", "key")
    got = rows.groupBy("entity", "teacher").agg(F.array_sort(F.collect_list(F.struct("position", "key"))).alias("_s"))
    return got.select("entity", "teacher", F.array_join(F.transform("_s", lambda s: s["key"]), ",").alias("statements"), F.size("_s").cast("long").alias("n"))


@query(f"SELECT entity, key, concat_ws(' → ', key, CASE WHEN position > 3 THEN 'line ' || position END) AS text FROM {A.STATEMENTS} WHERE kind = 'mistake'")
def mistakes_list(spark, d):
    fix = F.when(F.col("position") > 3, F.concat(F.lit("line "), F.col("position").cast("string")))
    return A.statements(spark, d).where("kind = 'mistake'").select("entity", "key", X.mistake(F.col("key"), fix).alias("text")).where("text is not null")


@query(f"SELECT credited, count(*) AS n, count(DISTINCT entity) AS entities, count(*) FILTER (kind = 'mistake') AS mistakes FROM {CREDITED} GROUP BY credited")
def instructor_credit_union(spark, d):
    return _credited(spark, d).groupBy("credited").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("entity").alias("entities"), F.count_if(F.col("kind") == "mistake").alias("mistakes"))


API_SLUG = "trim(regexp_replace(regexp_replace(lower(trim({0})), '[''’]', '', 'g'), '[^a-z0-9]+', '-', 'g'), '-')"
SINGULAR = "CASE WHEN {0} LIKE '%ies' AND length({0}) > 4 THEN left({0}, -3) || 'y' WHEN {0} LIKE '%es' AND length({0}) > 3 THEN left({0}, -2) WHEN {0} LIKE '%s' AND {0} NOT LIKE '%ss' AND {0} LIKE '%-%' AND length({0}) > 2 THEN left({0}, -1) ELSE {0} END"


@query(f"""WITH names AS (SELECT DISTINCT name FROM (SELECT p_name || 's' AS name FROM part UNION ALL SELECT p_brand FROM part UNION ALL SELECT c_name FROM customer)),
probes AS (SELECT name, 0 AS cand, {API_SLUG.format('name')} AS key FROM names UNION ALL SELECT name, 1, {SINGULAR.format('(' + API_SLUG.format('name') + ')')} FROM names),
keys AS (SELECT p_partkey AS entity, 0 AS prio, {API_SLUG.format('p_name')} AS key FROM part UNION ALL SELECT p_partkey, 1, {API_SLUG.format('p_brand')} FROM part),
hits AS (SELECT name, entity, row_number() OVER (PARTITION BY name ORDER BY cand, prio, entity) AS rn FROM probes JOIN keys USING (key) WHERE key <> '')
SELECT n.name, h.entity FROM names n LEFT JOIN (SELECT * FROM hits WHERE rn = 1) h ON h.name = n.name""")
def resolve_prioritised(spark, d):
    p = A.table(spark, d, "part")
    keys = R.keys_of(p, "p_partkey", X.api_slugify(F.col("p_name")), X.api_slugify(F.col("p_brand")))
    names = p.select(F.concat("p_name", F.lit("s")).alias("name")).unionByName(p.select(F.col("p_brand").alias("name"))).unionByName(A.table(spark, d, "customer").select(F.col("c_name").alias("name")))
    return R.prioritised(names, "name", keys)


@query("""WITH raw AS (SELECT DISTINCT lower(c_name) AS k, right(c_name, 4) AS name FROM customer UNION SELECT DISTINCT lower(s_name), s_name FROM supplier),
n AS (SELECT DISTINCT name, lower(trim(name)) AS k FROM raw), p AS (SELECT s_suppkey AS id, 's' || s_suppkey AS slug, lower(s_name) AS nm FROM supplier),
e AS (SELECT n.name, min(p.id) AS person FROM n JOIN p ON n.k = p.slug OR n.k = p.nm GROUP BY n.name),
c AS (SELECT n.name, min(p.id) AS person FROM n JOIN p ON contains(p.slug, n.k) OR contains(p.nm, n.k) WHERE n.name NOT IN (SELECT name FROM e) AND n.k <> '' GROUP BY n.name)
SELECT name, person, 'exact' AS how FROM e UNION ALL SELECT n.name, c.person, CASE WHEN c.person IS NOT NULL THEN 'contains' END FROM n LEFT JOIN c ON c.name = n.name WHERE n.name NOT IN (SELECT name FROM e) AND n.k <> ''""")
def resolve_raw_exact_then_contains(spark, d):
    s = A.table(spark, d, "supplier")
    people = s.select(F.col("s_suppkey").alias("id"), F.concat(F.lit("s"), F.col("s_suppkey").cast("string")).alias("slug"), F.col("s_name").alias("nm"))
    raw = A.table(spark, d, "customer").select(F.right("c_name", F.lit(4)).alias("name")).unionByName(s.select(F.col("s_name").alias("name")))
    return R.exact_then_contains(raw, "name", people, "id", "slug", "nm")


@query("""SELECT o_orderkey AS id FROM orders JOIN customer ON c_custkey = o_custkey WHERE (lower(c_mktsegment) = 'building' OR contains(lower(c_mktsegment), 'building')) AND contains(lower(o_orderpriority), 'high')""")
def view_membership(spark, d):
    rows = A.table(spark, d, "orders").join(A.table(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    return R.in_view(rows, F.array("c_mktsegment", "o_orderpriority"), F.array(F.lit("Building"), F.lit("high"))).select(F.col("o_orderkey").alias("id"))


OWN = f"""(SELECT entity, 'about' AS role, key, day FROM {A.STATEMENTS} JOIN {A.SOURCES} ON id = source UNION ALL
  SELECT entity % 50, 'refers', key, day FROM {A.STATEMENTS} JOIN {A.SOURCES} ON id = source)"""


@query(f"""SELECT entity, role, key, rn <= CASE role WHEN 'about' THEN 12 ELSE 80 END AS sent, rn <= CASE role WHEN 'about' THEN 12 ELSE 80 END OR role = 'refers' AS covered
FROM (SELECT *, row_number() OVER (PARTITION BY entity, role ORDER BY day DESC, key DESC) AS rn FROM {OWN})""")
def evidence_topk(spark, d):
    s = A.statements(spark, d).join(A.sources(spark, d).select(F.col("id").alias("source"), "day"), "source")
    own = s.select("entity", F.lit("about").alias("role"), "key", "day")
    refers = s.select((F.col("entity") % 50).alias("entity"), F.lit("refers").alias("role"), "key", "day")
    return M.capped_evidence(own.unionByName(refers), {"about": 12, "refers": 80}, date="day").select("entity", "role", "key", "sent", "covered")


@query("""SELECT doc_id, lang, turn FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY md5('7' || doc_id), doc_id) AS turn FROM documents) ORDER BY turn, lang LIMIT 100""")
def round_robin_sample(spark, d):
    return M.round_robin(A.table(spark, d, "documents").select("doc_id", "lang"), "lang", "doc_id", 100, "7")


@query("SELECT doc_id, (row_number() OVER (ORDER BY doc_id) - 1) // 50 AS batch FROM documents")
def batch_ids(spark, d):
    return M.batches(A.table(spark, d, "documents").select("doc_id"), "doc_id", 50)


@query("SELECT doc_id, lang FROM (SELECT *, row_number() OVER (PARTITION BY md5(text), lang ORDER BY doc_id) AS rn FROM documents) WHERE rn = 1")
def dedupe_keep_first(spark, d):
    return A.table(spark, d, "documents").groupBy(F.md5("text").alias("_k"), "lang").agg(F.min("doc_id").alias("doc_id")).select("doc_id", "lang")


@query("""SELECT role, count(*) AS calls, sum(length(text) // 4)::BIGINT AS input, (50 * count(*))::BIGINT AS output, sum(turn)::BIGINT AS cache_read, sum(turn * 2)::BIGINT AS cache_write,
  round((sum(length(text) // 4) * 3.0 + sum(turn) * 3.0 * 0.1 + sum(turn * 2) * 3.0 * 1.25 + 50 * count(*) * 15.0) / 1e6, 6) AS cost FROM conversations GROUP BY role""")
def cost_rollup(spark, d):
    c = A.table(spark, d, "conversations")
    log = c.select("role", X.tokens(F.col("text")).alias("input"), F.lit(50).cast("long").alias("output"), F.col("turn").alias("cache_read"), (F.col("turn") * 2).alias("cache_write"))
    return M.cost(log, "role", 3.0, 15.0)
