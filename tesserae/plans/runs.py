"""Queries on runs over state: evidence taken in, texts on pages, catalogs in their order, differences by field."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from ..functions import text as X
from ..operators import diff as D
from ..operators import generate as GEN
from ..operators import links as L
from ..operators import resolve as R
from . import adapters as A
from .registry import query


class EveryFifthFails:
    """Answers for all entities but those whose number divides by five."""

    def generate_json(self, prompt: str) -> str:
        slug = json.loads(prompt)["slug"]
        if int(slug) % 5 == 0:
            raise RuntimeError(slug)
        return json.dumps({"definition": f"About {slug}.", "context": "Said once."})


@query(f"""SELECT CAST(entity AS VARCHAR) AS entity, key FROM (SELECT entity, key, kind, row_number() OVER (PARTITION BY entity, kind = 'mistake' ORDER BY shipped DESC NULLS LAST, key DESC) AS n FROM {A.STATEMENTS}) s
WHERE entity % 5 <> 0 AND (kind = 'mistake' OR n <= 6)""")
def integrated_after_two_runs(spark, d):
    """What two runs take in of every entity's statements, three of its own each; mistakes count as mentions, all of which one run covers. No statement twice."""
    s = A.statements(spark, d)
    role = F.when(F.col("kind") == "mistake", "refers").otherwise("about")
    evidence = s.select(F.col("entity").cast("string").alias("entity"), role.alias("role"), "key", F.col("shipped").alias("date"), F.col("kind").alias("text"))
    prose, seen = spark.createDataFrame([], D.PROSE), spark.createDataFrame([], GEN.SEEN)
    for day in ("2026-01-01", "2026-01-02"):
        run = GEN.generate(prose, seen, evidence, EveryFifthFails, "m", day, "1", {"about": 3, "refers": 2})
        prose, seen = run.prose, run.seen
    return seen.select("entity", "key")


@query("""WITH c AS (SELECT p_partkey AS k FROM part WHERE p_partkey % 7 <> 0)
SELECT 'part-' || p.p_partkey AS slug, CASE WHEN p.p_partkey % 5 = 0 THEN p.p_name WHEN c.k IS NULL THEN 'About part ' || (p.p_partkey + 1) || ' and Label.' ELSE 'About [[concepts/part-' || c.k || ']] and Label.' END AS overview,
  CASE WHEN p.p_partkey % 5 = 0 THEN NULL WHEN o.k IS NULL THEN 'Then this.' ELSE 'Then [[concepts/part-' || o.k || '#top|this]].' END AS context
FROM part p LEFT JOIN c ON c.k = p.p_partkey + 1 LEFT JOIN c o ON o.k = p.p_partkey""")
def texts_on_pages(spark, d):
    """Every part's generated text on its page, its links led to the pages that there are; every fifth has no text of this version, every seventh no page."""
    k = F.col("p_partkey")
    p = A.table(spark, d, "part").select(k, F.concat(F.lit("part-"), k.cast("string")).alias("slug"), F.col("p_name").alias("overview"))
    catalog = p.where("p_partkey % 7 <> 0").select("slug", F.concat(F.lit("concepts/"), "slug", F.lit(".md")).alias("path"))
    definition = F.concat(F.lit("About [[part-"), (k + 1).cast("string"), F.lit("]] and [[gone/x-y|Label]]."))
    context = F.concat(F.lit("Then [[old/part-"), k.cast("string"), F.lit("#top|this]]."))
    prose = p.select("slug", F.when(k % 5 == 0, "0").otherwise("1").alias("version"), definition.alias("definition"), context.alias("context"))
    return L.texts_on_pages(p.select("slug", "overview"), prose, catalog, "1")


@query("""WITH e AS (SELECT 's-' || p_size AS s, min(p_partkey) AS o, max(p_partkey) AS id FROM part GROUP BY p_size),
n AS (SELECT e.o, e.id, unnest([1, 2]) AS i, unnest([p_brand, p_type]) AS a FROM e JOIN part ON p_partkey = e.id),
k AS (SELECT o, id, i, trim(regexp_replace(lower(a), '[^a-z0-9]+', '-', 'g'), '-') AS key FROM n)
SELECT s AS key, id AS entity, 0 AS prio FROM e UNION ALL SELECT key, arg_min(id, o * 10 + i), 1 FROM k GROUP BY key""")
def catalog_in_input_order(spark, d):
    """A catalog of parts whose sizes serve as slugs: the last of a slug counts, and of an alias the first."""
    p = A.table(spark, d, "part").select("p_partkey", F.concat(F.lit("s-"), F.col("p_size").cast("string")).alias("slug"), F.array("p_brand", "p_type").alias("aliases"))
    return R.catalog_keys(p, "p_partkey", "slug", "aliases", "p_partkey")


@query("""WITH a AS (SELECT c_custkey AS k, c_name AS n, c_mktsegment AS p, c_nationkey AS t FROM customer WHERE c_custkey % 11 <> 0),
b AS (SELECT c_custkey AS k, CASE WHEN c_custkey % 3 = 0 THEN upper(c_name) ELSE c_name END AS n, CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE c_mktsegment END AS p, c_nationkey + CASE WHEN c_custkey % 7 = 0 THEN 1 ELSE 0 END AS t FROM customer WHERE c_custkey % 13 <> 0),
j AS (SELECT a.k, a.n AS n1, b.n AS n2, a.p AS p1, b.p AS p2, a.t AS t1, b.t AS t2 FROM a JOIN b USING (k))
SELECT k, 'head.name' AS path, n1 AS old, n2 AS new FROM j WHERE n1 IS DISTINCT FROM n2 UNION ALL SELECT k, 'head.reach.segment', p1, p2 FROM j WHERE p1 IS DISTINCT FROM p2
UNION ALL SELECT k, 'nations', '[' || t1 || ']', '[' || t2 || ']' FROM j WHERE t1 <> t2
UNION ALL SELECT k, '*', CASE WHEN in_a THEN 'old' END, CASE WHEN in_a THEN NULL ELSE 'new' END FROM (SELECT k, true AS in_a FROM a WHERE k NOT IN (SELECT k FROM b) UNION ALL SELECT k, false FROM b WHERE k NOT IN (SELECT k FROM a))""")
def state_field_diff(spark, d):
    """Two copies of all customers, field by field through nested structs; of a key of one copy only the side is named here."""
    c = A.table(spark, d, "customer")
    k = F.col("c_custkey")

    def copy(name, segment, nation):
        return c.select(k.alias("k"), F.struct(name.alias("name"), F.struct(segment.alias("segment")).alias("reach")).alias("head"), F.array(nation).alias("nations"))

    old = copy(F.col("c_name"), F.col("c_mktsegment"), F.col("c_nationkey")).where("k % 11 <> 0")
    new = copy(F.when(k % 3 == 0, F.upper("c_name")).otherwise(F.col("c_name")), F.when(k % 5 != 0, F.col("c_mktsegment")), F.col("c_nationkey") + F.when(k % 7 == 0, 1).otherwise(0)).where("k % 13 <> 0")
    side = lambda n: F.when((F.col("path") == "*") & F.col(n).isNotNull(), n).otherwise(F.col(n)).alias(n)
    return D.field_diff(old, new, ["k"]).select("k", "path", side("old"), side("new"))


@query("""WITH n AS (SELECT right(p_name, 5) AS name FROM part UNION SELECT right(c_name, 4) FROM customer), k AS (SELECT name, lower(trim(name)) AS k FROM n WHERE trim(name) <> ''),
p AS (SELECT c_custkey AS id, 'c-' || c_custkey AS slug, lower(c_name || ' ' || c_mktsegment) AS nm FROM customer)
SELECT name, min(id) AS person FROM k JOIN p ON contains(slug, k) OR contains(nm, k) GROUP BY name""")
def names_within_names(spark, d):
    """The ends of parts' and customers' names within the names and segments of all customers, by the index of substrings."""
    c = A.table(spark, d, "customer").select(F.col("c_custkey").alias("person"), F.col("c_custkey").alias("at"), F.explode(F.array(F.concat(F.lit("c-"), F.col("c_custkey").cast("string")), F.lower(F.concat_ws(" ", "c_name", "c_mktsegment")))).alias("text"))
    ends = A.table(spark, d, "part").select(F.right("p_name", F.lit(5)).alias("name")).unionByName(A.table(spark, d, "customer").select(F.right("c_name", F.lit(4)).alias("name")))
    names = ends.distinct().withColumn("k", F.lower(X.strip(F.col("name")))).where("k <> ''")
    return names.join(R.first_containing(names.select("k").distinct(), "k", c, "person", "at", "text"), "k").select("name", "person")
