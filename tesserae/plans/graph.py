"""Queries on settling, closure and merging."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import closure as C
from ..operators import merges as R
from ..operators import settle as S
from . import adapters as A
from .registry import query


@query(f"SELECT * FROM {A.OVERLAY}")
def settle_overlay(spark, d):
    return S.overlay(A.events(spark, d))


@query(f"SELECT subj, tgt, n, row_number() OVER (PARTITION BY subj ORDER BY n DESC, tgt) AS pos, count(*) OVER (PARTITION BY subj) > 25 AS only_count FROM {A.OVERLAY}")
def overlay_mentions_ranked(spark, d):
    w = Window.partitionBy("subj")
    return S.overlay(A.events(spark, d)).select("subj", "tgt", "n", F.row_number().over(w.orderBy(F.desc("n"), "tgt")).cast("long").alias("pos"), (F.count(F.lit(1)).over(w) > 25).alias("only_count"))


@query(f"""SELECT e, other, CAST(sum(n) AS BIGINT) AS n FROM (SELECT tgt AS e, subj AS other, n FROM {A.OVERLAY}
  UNION ALL SELECT dst, frm, 1 FROM {A.RELATIONS} WHERE frm <> dst) GROUP BY e, other""")
def referenced_by_with_relations(spark, d):
    edges = S.overlay(A.events(spark, d)).select(F.col("tgt").alias("e"), F.col("subj").alias("other"), "n")
    incoming = A.relations(spark, d).where("frm <> dst").select(F.col("dst").alias("e"), F.col("frm").alias("other"), F.lit(1).cast("long").alias("n"))
    return edges.unionByName(incoming).groupBy("e", "other").agg(F.sum("n").alias("n"))


@query(f"SELECT lo, hi, kind, frm, dst, d FROM {A.CLAIMS}")
def claims_newest_unordered_pair(spark, d):
    return S.claims(A.relations(spark, d)).select("lo", "hi", "kind", "frm", "dst", "d")


FOLD_EDGES = f"""(SELECT frm, dst, kind = 'facet_of' AS listed FROM (SELECT *, row_number() OVER (PARTITION BY frm ORDER BY d DESC NULLS LAST, rank DESC, pair_ord DESC) AS rn2
  FROM {A.CLAIMS} WHERE kind <> 'distinct_from') WHERE rn2 = 1)"""


@query(f"SELECT * FROM {FOLD_EDGES}")
def fold_edges_newest(spark, d):
    return S.fold_edges(S.claims(A.relations(spark, d)))


@query(f"""WITH c AS {A.CLAIMS}, e AS {FOLD_EDGES}, m AS (SELECT frm, dst, bool_and(listed) AS listed FROM {A.FOLDS} WHERE frm <> dst GROUP BY 1, 2)
SELECT * FROM e UNION ALL SELECT frm, dst, listed FROM m WHERE frm NOT IN (SELECT frm FROM e)
  AND NOT EXISTS (SELECT 1 FROM c WHERE c.lo = least(m.frm, m.dst) AND c.hi = greatest(m.frm, m.dst))""")
def fold_edges_with_model(spark, d):
    settled = S.claims(A.relations(spark, d))
    return S.with_model_folds(S.fold_edges(settled), settled, A.folds(spark, d))


@query(f"WITH RECURSIVE {A.CLOSURE} SELECT frm, root FROM closed")
def fold_closure(spark, d):
    return C.fold_closure(A.folds(spark, d))


@query(f"""WITH RECURSIVE w AS (SELECT frm, dst AS ptr, NOT listed AS same, listed, CAST(NULL AS BIGINT) AS under, 1 AS depth FROM {A.FOLDS}
  UNION ALL SELECT w.frm, f.dst, w.same AND NOT f.listed, w.listed, coalesce(w.under, CASE WHEN f.listed THEN w.ptr END), w.depth + 1 FROM w JOIN {A.FOLDS} f ON w.ptr = f.frm WHERE w.depth < 64)
SELECT frm, ptr AS root, same, listed, under, CAST(depth AS INT) AS depth FROM w WHERE ptr NOT IN (SELECT frm FROM {A.FOLDS})""")
def fold_closure_flags(spark, d):
    return C.path_flags(C.fold_paths(A.folds(spark, d)))


@query(f"""WITH RECURSIVE {A.CLOSURE}, steps AS (
  SELECT frm AS start, frm AS node, listed, dst AS ptr, 1 AS i FROM {A.FOLDS} WHERE listed AND frm IN (SELECT frm FROM closed)
  UNION ALL SELECT s.start, f.frm, f.listed, f.dst, s.i + 1 FROM steps s JOIN {A.FOLDS} f ON s.ptr = f.frm WHERE s.i < 64),
k AS (SELECT start, list([lower(p_name), lpad(CAST(node AS VARCHAR), 12, '0')] ORDER BY i DESC) AS key, count(*) AS depth FROM steps JOIN part ON p_partkey = node WHERE listed GROUP BY start)
SELECT root, frm, CAST(depth AS INT) AS depth, row_number() OVER (PARTITION BY root ORDER BY key) AS pos FROM k JOIN closed ON frm = start""")
def facet_tree_order(spark, d):
    names = A.entities(spark, d).select(F.col("id").alias("node"), "name")
    return C.tree_order(C.fold_paths(A.folds(spark, d)), names)


@query(f"WITH RECURSIVE {A.CLOSURE} SELECT root, count(*) AS folds, min(frm) AS first FROM closed GROUP BY root")
def fold_review_groups(spark, d):
    return C.fold_closure(A.folds(spark, d)).groupBy("root").agg(F.count(F.lit(1)).alias("folds"), F.min("frm").alias("first"))


@query(f"""WITH RECURSIVE {A.CLOSURE}, r AS (SELECT frm % 2000 AS a, dst AS b, kind, ord FROM {A.RELATIONS})
SELECT ra AS a, rb AS b, count(*) AS n FROM (SELECT coalesce(x.root, a) AS ra, coalesce(y.root, b) AS rb FROM r LEFT JOIN closed x ON x.frm = a LEFT JOIN closed y ON y.frm = b) WHERE ra <> rb GROUP BY 1, 2""")
def repoint_and_drop_self(spark, d):
    rows = A.relations(spark, d).select(F.col("frm").alias("a"), F.col("dst").alias("b"))
    return C.repoint(rows, C.fold_closure(A.folds(spark, d)), "a", "b").where("a <> b").groupBy("a", "b").agg(F.count(F.lit(1)).alias("n"))


@query("""SELECT e, count(DISTINCT other) AS n, min(other) AS first FROM (SELECT a.l_partkey AS e, b.l_partkey AS other FROM lineitem a JOIN lineitem b ON a.l_orderkey = b.l_orderkey AND a.l_partkey <> b.l_partkey) GROUP BY e""")
def related_slugs(spark, d):
    i = A.table(spark, d, "lineitem").select("l_orderkey", "l_partkey").repartition(A.order_tasks(spark, d), "l_orderkey").distinct()
    pairs = i.select("l_orderkey", F.col("l_partkey").alias("e")).join(i.select("l_orderkey", F.col("l_partkey").alias("other")), "l_orderkey").where("e <> other")
    return pairs.groupBy("e").agg(F.countDistinct("other").alias("n"), F.min("other").alias("first"))


@query(f"SELECT tgt, CAST(sum(n) AS BIGINT) AS n, count(*) AS subjects FROM {A.OVERLAY} GROUP BY tgt ORDER BY n DESC, tgt LIMIT 25")
def top_targets(spark, d):
    return S.overlay(A.events(spark, d)).groupBy("tgt").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("subjects")).orderBy(F.desc("n"), "tgt").limit(25)


_RESOLVED = f"""(SELECT subj, r AS tgt, CASE WHEN r IS NULL THEN 'new-' || t END AS proposed, d, deny
  FROM (SELECT subj, tgt AS t, CASE WHEN tgt % 10 <> 3 AND tgt IN (SELECT p_partkey FROM part) THEN coalesce(root, tgt) END AS r, d, deny FROM {A.EVENTS} LEFT JOIN closed ON frm = tgt) WHERE r IS NULL OR r <> subj)"""


def _targets(spark, d):
    """Events whose target is named by id (even), by slug (odd), or by a slug that no part has (3 in the last place)."""
    known = A.entities(spark, d).select(F.col("id").alias("_k"), "slug")
    e = A.events(spark, d).join(F.broadcast(known.where("_k < 50 and _k % 10 <> 3")), F.col("tgt") == F.col("_k"), "left")  # targets are parts by 50, so this is a row for each number below
    slug = F.coalesce("slug", F.concat(F.lit("new-"), F.col("tgt").cast("string")))
    return e.select("subj", F.when(F.col("tgt") % 2 == 0, F.col("_k")).alias("target_id"), slug.alias("target_slug"), "d", "deny")


@query(f"WITH RECURSIVE {A.CLOSURE} SELECT subj, tgt, proposed, count(*) AS n, CAST(sum(deny) AS BIGINT) AS denials FROM {_RESOLVED} GROUP BY subj, tgt, proposed")
def overlay_targets(spark, d):
    """Targets of references by id, else by slug, redirected to what they are folded into, else proposed."""
    got = R.resolve_targets(_targets(spark, d), A.entities(spark, d), C.fold_closure(A.folds(spark, d)))
    return got.groupBy("subj", "tgt", "proposed").agg(F.count(F.lit(1)).alias("n"), F.sum("deny").cast("long").alias("denials"))


@query(f"""WITH RECURSIVE {A.CLOSURE}, k AS (SELECT subj, proposed, CAST(sum(1 - deny) AS BIGINT) AS n FROM (SELECT *, max(epoch(d) * 2 + deny) OVER (PARTITION BY subj, proposed) % 2 AS gone FROM {_RESOLVED} WHERE proposed IS NOT NULL) WHERE gone = 0 GROUP BY 1, 2)
SELECT proposed AS slug, count(*) AS subjects, CAST(sum(n) AS BIGINT) AS n FROM k GROUP BY 1""")
def proposed_nodes(spark, d):
    """Targets that no entity has become nodes if a kept pair uses them."""
    got = R.resolve_targets(_targets(spark, d), A.entities(spark, d), C.fold_closure(A.folds(spark, d))).where("proposed is not null")
    return S.overlay(got, ("subj", "proposed")).groupBy(F.col("proposed").alias("slug")).agg(F.count(F.lit(1)).alias("subjects"), F.sum("n").alias("n"))


@query(f"SELECT e.tgt, e.subj, e.d, count(*) AS n FROM {A.EVENTS} e JOIN {A.OVERLAY} o ON o.subj = e.subj AND o.tgt = e.tgt WHERE e.deny = 0 AND e.tgt IN (SELECT p_partkey FROM part) GROUP BY 1, 2, 3")
def referring_evidence(spark, d):
    """Asserting references as evidence for their target, by slug, where the settled overlay kept the pair."""
    known = A.entities(spark, d)
    e = A.events(spark, d)
    rows = e.join(F.broadcast(known.where("id < 50").select(F.col("id").alias("tgt"), F.col("slug").alias("target_slug"))), "tgt").select("subj", "target_slug", "d", "deny")
    return R.referring(rows, S.overlay(e), known).groupBy("tgt", "subj", "d").agg(F.count(F.lit(1)).alias("n"))


@query(f"""WITH RECURSIVE {A.CLOSURE}, a AS (SELECT coalesce(root, frm_) AS frm, coalesce(y, dst_) AS dst FROM (SELECT r.frm AS frm_, r.dst AS dst_, c.root, e.root AS y FROM {A.RELATIONS} r LEFT JOIN closed c ON c.frm = r.frm LEFT JOIN closed e ON e.frm = r.dst))
SELECT 'relations' AS part, frm AS id, count(*) AS n, CAST(NULL AS VARCHAR) AS aliases FROM a WHERE frm <> dst GROUP BY frm
UNION ALL SELECT 'attributions', coalesce(root, entity), count(*), NULL FROM {A.STATEMENTS} LEFT JOIN closed ON frm = entity GROUP BY 2
UNION ALL SELECT 'entities', p_partkey, 1, p_brand || coalesce((SELECT string_agg(a, '|' ORDER BY f, i) FROM (SELECT a, min(f) AS f, min(i) AS i, min(f * 2 + i) FROM (SELECT x.p_name AS a, x.p_partkey AS f, 0 AS i FROM closed JOIN part x ON x.p_partkey = frm WHERE root = p.p_partkey UNION ALL SELECT x.p_brand, x.p_partkey, 1 FROM closed JOIN part x ON x.p_partkey = frm WHERE root = p.p_partkey) WHERE a <> p.p_brand GROUP BY a)), '') FROM part p WHERE p_partkey NOT IN (SELECT frm FROM closed)""")
def merged_corpus(spark, d):
    """Every folded entity merged into its root: statements and relations led there, names and aliases added, folded entities gone."""
    e = A.entities(spark, d).select("id", "name", F.array("brand").alias("aliases"))
    got = R.apply_merges({"entities": e, "attributions": A.statements(spark, d), "relations": A.relations(spark, d)}, C.fold_closure(A.folds(spark, d)), {"attributions": ["entity"], "relations": ["frm", "dst"]})
    none = F.lit(None).cast("string").alias("aliases")
    count = lambda name, key: got[name].groupBy(F.col(key).alias("id")).agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("part"), "id", "n", none)
    own = got["entities"].select(F.lit("entities").alias("part"), "id", F.lit(1).cast("long").alias("n"), F.concat(F.col("aliases")[0], F.array_join(F.slice("aliases", 2, 1 << 20), "|")).alias("aliases"))
    return count("relations", "frm").unionByName(count("attributions", "entity")).unionByName(own)


@query(f"""WITH RECURSIVE {A.CLOSURE}, w AS (SELECT frm AS start, dst AS ptr, 1 AS hops FROM {A.FOLDS} UNION ALL SELECT w.start, f.dst, w.hops + 1 FROM w JOIN {A.FOLDS} f ON w.ptr = f.frm WHERE w.hops < 64)
SELECT frm, CASE WHEN frm IN (SELECT frm FROM closed) THEN (SELECT root FROM closed c WHERE c.frm = f.frm) WHEN frm IN (SELECT start FROM w WHERE ptr = start) THEN frm END AS page FROM {A.FOLDS} f""")
def review_closure(spark, d):
    return R.review_pages(A.folds(spark, d))


@query(f"""WITH s AS (SELECT DISTINCT entity, source FROM {A.STATEMENTS} UNION SELECT entity % 50, source FROM {A.STATEMENTS}) SELECT entity, count(DISTINCT source) AS sources FROM s GROUP BY entity""")
def sources_of_pages(spark, d):
    own = A.statements(spark, d).select("entity", "source")
    return R.sources_of_pages(own, own.withColumn("entity", F.col("entity") % 50))


@query(f"""SELECT g AS grp, count(k.kind) AS n FROM (VALUES ('concept'), ('technique'), ('drill'), ('stance')) v(g) LEFT JOIN (SELECT kind FROM {A.ENTITIES} WHERE id % 3 <> 0 AND kind <> 'drill') k ON k.kind = g GROUP BY g""")
def pending_groups(spark, d):
    """Entities that are not decided yet, by group; a group without any counts none."""
    rest = A.entities(spark, d).where("id % 3 <> 0 and kind <> 'drill'")
    return R.pending_by_group(rest, F.col("kind"), ["concept", "technique", "drill", "stance"])
