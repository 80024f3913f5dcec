"""Queries on snapshots, watermarks, documents, jobs and streams."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import closure as C
from ..operators import diff as D
from ..operators import documents as P
from ..operators import passes
from ..operators import resolve as R
from ..operators import settle as S
from ..streaming import jobs as J
from . import adapters as A
from .measures import CREDITED
from .registry import query

_NEW = "(SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN 'X' ELSE o_orderstatus END AS status FROM orders WHERE o_orderkey % 11 <> 3 UNION ALL SELECT -o_orderkey - 1, o_orderstatus FROM orders WHERE o_orderkey % 50 = 1)"


def _snapshots(spark, d):
    o = A.table(spark, d, "orders").select("o_orderkey", F.col("o_orderstatus").alias("status"))
    new = o.where("o_orderkey % 11 <> 3").select("o_orderkey", F.when(F.col("o_orderkey") % 7 == 0, "X").otherwise(F.col("status")).alias("status"))
    return o, new.unionByName(o.where("o_orderkey % 50 = 1").select((-F.col("o_orderkey") - 1).alias("o_orderkey"), "status"))


@query(f"""SELECT coalesce(a.o_orderkey, b.o_orderkey) AS o_orderkey, CASE WHEN a.o_orderkey IS NULL THEN 'created' WHEN b.o_orderkey IS NULL THEN 'removed' WHEN a.o_orderstatus = b.status THEN 'unchanged' ELSE 'changed' END AS state
FROM orders a FULL JOIN {_NEW} b ON a.o_orderkey = b.o_orderkey""")
def snapshot_diff(spark, d):
    return D.snapshot_diff(*_snapshots(spark, d), ["o_orderkey"], unchanged=True)


@query(f"SELECT o_orderkey, o_orderstatus AS status FROM orders WHERE o_orderkey NOT IN (SELECT o_orderkey FROM {_NEW}) UNION ALL SELECT * FROM {_NEW}")
def upsert_snapshot(spark, d):
    return D.upsert(*_snapshots(spark, d), ["o_orderkey"])


@query(f"SELECT n.* FROM {_NEW} n LEFT JOIN orders o ON o.o_orderkey = n.o_orderkey AND o.o_orderstatus = n.status WHERE o.o_orderkey IS NULL")
def delta_rows(spark, d):
    return D.delta(*_snapshots(spark, d), ["o_orderkey"])


@query("SELECT user_id, ts, event_type, event_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1")
def upsert_latest(spark, d):
    e = A.table(spark, d, "events").select("user_id", "ts", "event_type", "event_id")
    return D.latest(e, "user_id", "ts", "event_id").select("user_id", "ts", "event_type", "event_id")


@query("""SELECT event_id FROM events WHERE event_id NOT IN (SELECT event_id FROM events WHERE event_id % 3 = 0)""")
def watermark_pending(spark, d):
    """Events not done under version 2, where every third was, and others under version 1 only."""
    e = A.table(spark, d, "events").select("event_id")
    done = e.select("event_id", F.when(F.col("event_id") % 3 == 0, "2").otherwise("1").alias("version")).where("event_id % 3 <> 1")
    return D.pending(e, done, ["event_id"], "2")


@query("""SELECT coalesce(a.k, b.k) AS k, CASE WHEN a.k IS NULL THEN 'put' ELSE 'remove' END AS act FROM (SELECT c_custkey AS k FROM customer WHERE c_custkey % 5 <> 0) a FULL JOIN (SELECT c_custkey AS k FROM customer WHERE c_custkey % 3 <> 0) b ON a.k = b.k WHERE a.k IS NULL OR b.k IS NULL""")
def mirror_sync_sets(spark, d):
    c = A.table(spark, d, "customer").select(F.col("c_custkey").alias("k"))
    diff = D.snapshot_diff(c.where("k % 5 <> 0").withColumn("x", F.lit(1)), c.where("k % 3 <> 0").withColumn("x", F.lit(1)), ["k"])
    return diff.select("k", F.when(F.col("state") == "removed", "remove").otherwise("put").alias("act"))


def _pages(spark, d, refer):
    """refer makes (entity, referenced_by, referenced_by_count) of the rows (entity, target, count) and their order."""
    s = A.statements(spark, d)
    names = A.table(spark, d, "supplier").select(F.col("s_suppkey").alias("credited"), "s_name")
    day = A.sources(spark, d).select(F.col("id").alias("source"), "day", "public")
    said = s.select("source", "entity", "position", "raw", "shipped", (F.col("kind") == "mistake").alias("mistake"))
    told = said.join(day, "source", "left").withColumn("public", F.coalesce("public", F.lit(False)))  # a source that is missing is not public
    told = told.repartition("entity").withColumn("key", A.statement_key())  # a key is longer than what it is made of
    said = P.lists(told, "entity", {
        "statements": (~F.col("mistake"), [F.col("position"), F.col("key")], {"key": F.col("key"), "source": F.col("source"), "day": F.col("day"), "public": F.col("public")}),
        "mistakes": (F.col("mistake"), [F.col("day"), F.col("key")], {"key": F.col("key"), "day": F.col("day")})}, dealt=True)
    each = R.credited(A.own(s), ["entity"], tasks=A.order_tasks(spark, d)).repartition("entity").select("entity", F.explode("credited").alias("credited")).distinct()
    who = P.nest(each.join(names, "credited"), "entity", [F.col("s_name")], {"name": F.col("s_name")}, "teachers", dealt=True)
    edges = C.cut(S.overlay(A.order_events(spark, d), asserts="n"))  # for three readers, each of which would join and aggregate all events
    mentions = P.nest(edges.select(F.col("subj").alias("entity"), "tgt", "n"), "entity", [-F.col("n"), F.col("tgt")], {"target": F.col("tgt"), "count": F.col("n")}, "mentions")
    refs = refer(edges.select(F.col("tgt").alias("entity"), F.col("subj").alias("target"), F.col("n").alias("count")), [-F.col("count"), F.col("target")])
    pages = A.entities(spark, d).select(F.col("id").alias("entity"), "slug", "name", "kind")
    return P.assemble(pages, "entity", [said, who, mentions, refs])


@query(f"""WITH s AS (SELECT entity, count(*) FILTER (kind = 'taught') AS t, count(*) FILTER (kind = 'mistake') AS m FROM {A.STATEMENTS} GROUP BY entity), o AS {A.OVERLAY},
a AS (SELECT subj, count(*) AS n FROM o GROUP BY subj), b AS (SELECT tgt, count(*) AS n FROM o GROUP BY tgt)
SELECT id AS entity, slug, coalesce(t, 0) AS statements_count, coalesce(m, 0) AS mistakes_count, coalesce(a.n, 0) AS mentions_count, coalesce(b.n, 0) AS referenced_by_count, coalesce(b.n, 0) BETWEEN 1 AND 25 AS listed
FROM {A.ENTITIES} x LEFT JOIN s ON s.entity = id LEFT JOIN a ON a.subj = id LEFT JOIN b ON b.tgt = id""")
def page_document_counts(spark, d):
    """The sizes of the lists of page documents, counted without gathering them."""
    count = lambda k: F.count(F.when(F.col("kind") == k, 1))
    s = A.statements(spark, d).groupBy("entity").agg(count("taught").alias("statements_count"), count("mistake").alias("mistakes_count"))
    edges = S.overlay(A.events(spark, d))
    ends = edges.select(F.explode(F.array(F.struct(F.col("subj").alias("entity"), F.lit(1).alias("out")), F.struct(F.col("tgt").alias("entity"), F.lit(0).alias("out")))).alias("z")).select("z.*")
    n = ends.groupBy("entity").agg(F.sum("out").alias("mentions_count"), F.sum(1 - F.col("out")).alias("referenced_by_count"))
    pages = A.entities(spark, d).select(F.col("id").alias("entity"), "slug").join(s, "entity", "left").join(n, "entity", "left")
    zero = {c: F.coalesce(c, F.lit(0)).cast("long") for c in ("statements_count", "mistakes_count", "mentions_count", "referenced_by_count")}
    return pages.select("entity", "slug", *[v.alias(c) for c, v in zero.items()], zero["referenced_by_count"].between(1, P.REFERENCED_LIMIT).alias("listed"))


@query()
def page_documents(spark, d):
    return _pages(spark, d, lambda rows, order: P.nest(rows, "entity", order, {"target": F.col("target"), "count": F.col("count")}, "referenced_by", P.PIECE))


@query(f"""WITH o AS {A.OVERLAY}, t AS (SELECT entity, {A.lines_sql("key", "position, key", "kind = 'taught'")} AS taught, {A.lines_sql("key", "day, key", "kind = 'mistake'")} AS wrong FROM {A.STATEMENTS} t LEFT JOIN {A.SOURCES} s ON s.id = t.source GROUP BY entity),
w AS (SELECT entity, {A.lines_sql("s_name", "s_name")} AS who FROM (SELECT DISTINCT entity, credited, s_name FROM {CREDITED} JOIN supplier ON s_suppkey = credited) GROUP BY entity),
m AS (SELECT subj, {A.lines_sql("'[[' || tgt || ']] (' || n || ')'", "n DESC, tgt")} AS mentions FROM o GROUP BY subj),
r AS (SELECT tgt, {A.lines_sql("'[[' || subj || ']] (' || n || ')'", "n DESC, subj")} AS refs FROM o GROUP BY tgt)
SELECT kind || '/' || slug || '.md' AS path, {A.page_sql("name", {"kind": "kind", "slug": "slug"}, {"Statements": "taught", "Mistakes": "wrong", "Taught by": "who", "Mentions": "mentions", "Referenced by": "refs"})} AS text
FROM {A.ENTITIES} x LEFT JOIN t ON t.entity = x.id LEFT JOIN w ON w.entity = x.id LEFT JOIN m ON m.subj = x.id LEFT JOIN r ON r.tgt = x.id""")
def markdown_pages(spark, d):
    told = F.concat(F.lit("- [["), F.col("target").cast("string"), F.lit("]] ("), F.col("count").cast("string"), F.lit(")"))
    p = _pages(spark, d, lambda rows, order: P.texts(rows, "entity", order, told, "referenced_by", P.PIECE))
    line = lambda c, name: F.transform(c, lambda s: F.concat(F.lit("- "), s[name].cast("string")))
    counted = lambda c: F.transform(c, lambda s: F.concat(F.lit("- [["), s["target"].cast("string"), F.lit("]] ("), s["count"].cast("string"), F.lit(")")))
    lines = {"Statements": line(F.col("statements"), "key"), "Mistakes": line(F.col("mistakes"), "key"), "Taught by": line(F.col("teachers"), "name"), "Mentions": counted(F.col("mentions")), "Referenced by": F.col("referenced_by")}
    p = p.select("kind", "slug", "name", *[c.alias(n) for n, c in lines.items()])  # markdown() uses each twice
    text = P.markdown(F.col("name"), {"kind": F.col("kind"), "slug": F.col("slug")}, {n: F.col(f"`{n}`") for n in lines})
    return p.select(F.concat_ws("/", F.col("kind"), F.concat("slug", F.lit(".md"))).alias("path"), text.alias("text"))


@query("""SELECT section, array_to_string(list(name ORDER BY lower(name), name), '; ') AS entries, count(*) AS n FROM (SELECT DISTINCT 'part' AS section, p_name AS name FROM part UNION SELECT 'supplier', s_name FROM supplier) GROUP BY section""")
def index_listing(spark, d):
    rows = A.table(spark, d, "part").select(F.lit("part").alias("section"), F.col("p_name").alias("name")).unionByName(A.table(spark, d, "supplier").select(F.lit("supplier").alias("section"), F.col("s_name").alias("name"))).distinct()
    got = rows.groupBy("section").agg(F.array_sort(F.collect_list(F.struct(F.lower("name").alias("l"), "name"))).alias("_a"))
    return got.select("section", F.array_join(F.transform("_a", lambda s: s["name"]), "; ").alias("entries"), F.size("_a").cast("long").alias("n"))


def _followons(spark, d, items):
    o = items.select("l_orderkey").distinct()
    jobs = J.parse(o.select(F.to_json(F.struct(F.lit("link").alias("job"), F.col("l_orderkey").cast("string").alias("source_id"))).alias("body"))).where("problem is null")
    touched = A.table(spark, d, "lineitem").select(F.col("l_orderkey").cast("string").alias("source_id"), F.col("l_partkey").alias("entity")).distinct()
    return J.follow_ons(jobs, touched, A.table(spark, d, "part").where("p_partkey % 4 = 0").select(F.col("p_partkey").alias("entity")), 3)


@query("""WITH t AS (SELECT DISTINCT l_orderkey AS o, l_partkey AS e FROM lineitem),
j AS (SELECT 'generate' AS job, o, e FROM t UNION ALL SELECT 'consolidate', o, e FROM t WHERE e % 4 = 0),
b AS (SELECT *, (row_number() OVER (PARTITION BY job, o ORDER BY e) - 1) // 3 AS batch FROM j)
SELECT job, CAST(o AS VARCHAR) AS origin_source_id, batch, list(e ORDER BY e) AS entities FROM b GROUP BY job, o, batch""")
def job_followons(spark, d):
    """The follow-on jobs of every order."""
    return _followons(spark, d, A.table(spark, d, "lineitem"))


@query("""SELECT body, CASE WHEN event_id % 4 = 0 THEN 'unreadable' WHEN event_id % 4 = 1 THEN 'unknown job' WHEN event_id % 4 = 2 THEN 'no source' END AS problem FROM
(SELECT event_id, CASE event_id % 4 WHEN 0 THEN '{' || event_id WHEN 1 THEN '{"job":"x' || event_id || '"}' WHEN 2 THEN '{"job":"link"}' ELSE '{"job":"link","source_id":"' || event_id || '"}' END AS body FROM events)""")
def job_validation(spark, d):
    k = F.col("event_id").cast("string")
    body = F.when(F.col("event_id") % 4 == 0, F.concat(F.lit("{"), k)).when(F.col("event_id") % 4 == 1, F.concat(F.lit('{"job":"x'), k, F.lit('"}'))).when(F.col("event_id") % 4 == 2, F.lit('{"job":"link"}')).otherwise(F.concat(F.lit('{"job":"link","source_id":"'), k, F.lit('"}')))
    return J.parse(A.table(spark, d, "events").select(body.alias("body"))).select("body", "problem")


@query("""SELECT p_partkey AS id, CASE WHEN p_partkey % 5 = 0 THEN 'its own' WHEN p_partkey % 3 = 0 THEN p_type ELSE p_name END AS definition,
  1 + CASE WHEN p_partkey % 2 = 0 THEN 1 ELSE 0 END + CASE WHEN p_partkey % 3 = 0 THEN 1 ELSE 0 END + CASE WHEN p_partkey % 5 = 0 OR (p_partkey % 2 = 0 AND p_partkey % 3 <> 0) THEN 1 ELSE 0 END AS revisions,
  1 + CASE WHEN p_partkey % 3 = 0 THEN 1 ELSE 0 END AS integrated,
  CASE WHEN p_partkey % 5 = 0 THEN 'chosen by a person' WHEN p_partkey % 3 = 0 THEN 'took in evidence' WHEN p_partkey % 2 = 0 THEN 'reverted' ELSE 'nothing before' END AS result FROM part""")
def revisions(spark, d):
    """Texts from one statement each; every second rewritten, every third with new evidence, every fifth edited on its page; then all are to be taken back."""
    p = A.table(spark, d, "part").select(F.col("p_partkey").cast("string").alias("slug"), "p_partkey", "p_name", "p_brand", "p_type")
    answer = lambda text, key: (F.col(text).alias("definition"), F.lit("").alias("context"), (F.array(F.concat(F.lit(key), "slug")) if key else F.array().cast("array<string>")).alias("keys"))
    state = D.record_revision(spark.createDataFrame([], D.PROSE), p.select("slug", *answer("p_name", "a")), "m", "2026-01-01", "1")
    state = D.record_revision(state, p.where("p_partkey % 2 = 0").select("slug", *answer("p_brand", "")), "m", "2026-01-02", "1")
    state = D.record_revision(state, p.where("p_partkey % 3 = 0").select("slug", *answer("p_type", "b")), "m", "2026-01-03", "1")
    state = D.page_as_base(state, p.select("slug", F.when(F.col("p_partkey") % 5 == 0, "its own").otherwise(F.col("p_name")).alias("definition"), F.lit("").alias("context")), "2026-01-04")
    back = D.revert(state, "2026-01-05")
    return back.select(F.col("slug").cast("long").alias("id"), "definition", F.size("revisions").alias("revisions"), F.size("integrated").alias("integrated"), "result")


@query("""SELECT p_partkey AS child, p_partkey - p_partkey % 10 AS parent, p_size % 2 = 0 AS same FROM part WHERE p_partkey % 10 <> 0 AND p_partkey % 10 > 4 AND (p_partkey // 100 % 2 = 0 OR p_size % 2 = 0)""")
def model_folds(spark, d):
    """Folds that a replayed model answers: onto the next lower ten, whose weight is 5, from a part that weighs its last digit less 10's complement; by hundreds the group is pattern or not."""
    p = A.table(spark, d, "part").select(F.col("p_partkey").alias("k"), "p_size")
    ids = p.select(F.col("k").cast("string").alias("id"))
    grp = F.when(F.floor(F.col("id").cast("long") / 100) % 2 == 0, "idea").otherwise("pattern")
    weights = ids.select("id", F.when(F.col("id").cast("long") % 10 == 0, 5).otherwise(10 - F.col("id").cast("long") % 10).alias("weight"))
    rows = p.where("k % 10 <> 0").select(F.floor(F.col("k") / 50).alias("batch"), F.struct(F.col("k").cast("string").alias("id"), F.lit(True).alias("fold"), (F.col("k") - F.col("k") % 10).cast("string").alias("parent"), (F.col("p_size") % 2 == 0).alias("same")).alias("e"))
    answers = rows.groupBy("batch").agg(F.to_json(F.struct(F.collect_list("e").alias("entries"))).alias("answer"))
    got = passes.fold_answers(answers, ids.select("id", grp.alias("grp")), weights)
    return got.select(F.col("child").cast("long").alias("child"), F.col("parent").cast("long").alias("parent"), "same")


@query("SELECT CAST(floor(epoch(ts) / 3600) * 3600 AS BIGINT) AS start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1, 2")
def event_windows(spark, d):
    got = J.windows(A.table(spark, d, "events"), "ts", "1 hour", None, None, "event_type")
    return got.select(F.unix_timestamp("start").alias("start"), "event_type", "n", F.round("total", 4).alias("total"))


@query("""SELECT user_id, CAST(min(floor(epoch(ts))) AS BIGINT) AS start, count(*) AS n FROM (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS s FROM
 (SELECT *, CASE WHEN lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) > ts - INTERVAL 6 HOUR THEN 0 ELSE 1 END AS fresh FROM events)) GROUP BY user_id, s""")
def event_sessions(spark, d):
    return J.sessions(A.table(spark, d, "events"), "ts", "6 hours", "user_id").select("user_id", F.unix_timestamp("start").alias("start"), "n")
