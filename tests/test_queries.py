import decimal
import glob
import os
import re

import duckdb
import pytest

import __spark_entry__ as entry
from tesserae.operators import settle as S
from tesserae.plans import adapters as A
from tesserae.queries import ORACLE, QUERIES

from .conftest import SF


def plain(v):
    if isinstance(v, (float, decimal.Decimal)):
        return round(float(v), 6)
    if isinstance(v, (list, tuple)):
        return tuple(map(plain, v))
    return v


@pytest.fixture(scope="module")
def db():
    c = duckdb.connect()
    for f in glob.glob(f"{SF}/*.parquet"):
        c.sql(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return c


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, db, name):
    df = QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    rows = sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=str)
    if name not in ORACLE:
        assert rows
        return
    got = db.sql(ORACLE[name])
    assert sorted(got.columns) == columns
    at = [got.columns.index(c) for c in columns]
    assert rows == sorted((tuple(plain(r[i]) for i in at) for r in got.fetchall()), key=str)


def test_entry(spark):
    assert entry.entry(spark).columns == ["subj", "tgt", "n"]
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_followons_of_every_order(spark, db):
    got = {r[0] for r in QUERIES["job_followons"](spark, SF).select("origin_source_id").distinct().collect()}
    assert got == {str(r[0]) for r in db.sql("SELECT DISTINCT l_orderkey FROM lineitem").fetchall()}


def test_all_model_folds_reach_the_operator(spark, db):
    got = {r["frm"] for r in QUERIES["fold_edges_with_model"](spark, SF).collect()}
    beyond = {r[0] for r in db.sql(f"SELECT frm FROM {A.FOLDS} WHERE frm >= 200").fetchall()}  # relations are between ids below 200
    assert beyond <= got and (beyond or SF.endswith("sf0.001"))
    more = spark.createDataFrame([(900, 450, True), (901, 3, False)], "frm long, dst long, listed boolean")
    settled = S.claims(A.relations(spark, SF))
    assert {900, 901} <= {r["frm"] for r in S.with_model_folds(S.fold_edges(settled), settled, more).collect()}


def test_citations_in_whole_texts(spark, db):
    """Against a plain version: the text as it was but for blanks before the markers, and one citation before its last full stop."""
    rows = db.sql("SELECT doc_id, text FROM documents").fetchall()
    want = []
    for i, t in rows:
        if t is None:
            want.append((i, None))
            continue
        s = re.sub(r"(?i)\s*\[\(?(?:source|citation(?: needed)?)\)?\]", "", re.sub(r"\s*\(\s*\)", "", t[:40].rstrip() + t[40:]))
        cite = f"([[sources/a-{i % 7}]])"
        want.append((i, (f"{s[:-1]} {cite}{s[-1]}" if s[-1:] in tuple(".!?") else f"{s.rstrip()} {cite}").strip()))
    got = [tuple(r) for r in QUERIES["citation_normalise"](spark, SF).collect()]
    assert len(got) == len(rows) and sorted(got) == sorted(want)


def test_page_documents_settle_events_once(spark):
    """The overlay is written once for its three readers: no plan of a page document joins orders with themselves again."""
    plan = QUERIES["page_documents"](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert "_last" not in plan


def test_materialise_sets_joins_do_not_grow_with_rounds(spark):
    """What the closure's rounds end is one table: a semi- or anti-join with their union would stand in the plan, and in one task, once for each round."""
    plan = QUERIES["materialise_sets"](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join LeftSemi") == 1 and plan.count("Join LeftAnti") == 1


def test_long_lists_of_references_are_whole(spark, db):
    """A page that more than 25 others refer to lists every one of them, as a document and in its text."""
    want = dict(db.sql(f"SELECT tgt, count(*) FROM {A.OVERLAY} WHERE tgt IN (SELECT p_partkey FROM part) GROUP BY tgt").fetchall())
    assert max(want.values()) > 25
    docs = {r["entity"]: (r["referenced_by_count"], len(r["referenced_by"] or ()), r["slug"]) for r in QUERIES["page_documents"](spark, SF).collect()}
    assert {e: n for e, (n, _, _) in docs.items() if n} == want == {e: n for e, (_, n, _) in docs.items() if n}
    pages = {r["path"].split("/")[1][:-3]: r["text"] for r in QUERIES["markdown_pages"](spark, SF).collect()}
    assert {e: pages[docs[e][2]].split("\n## Referenced by\n\n")[1].count("- [[") for e in want} == want


@pytest.mark.parametrize("name", ["instructor_pages", "page_documents", "markdown_pages"])
def test_items_are_made_where_they_are_gathered(spark, name):
    """What is shuffled are columns: a partial aggregation below a shuffle would send each item with its order beside its line."""
    plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" in plan and not re.search(r"Exchange [^\n]*\n[^\n]*partial_collect_list", plan)


def test_order_events_settle_like_events(spark, tmp_path):
    """Parts that occur twice in an order, a negative and a null one, flags and dates that are null, orders that are missing; and line items are shuffled, not their pairs."""
    lines = [(o, p, f) for o in range(40) for p, f in ((o % 7, "R"), (o * 3 % 130, "A"), (o * 3 % 130, "R" if o % 3 else None), (-o, "N"), (51 + o % 2, "A"), (None, "A"))]
    spark.createDataFrame(lines, "l_orderkey long, l_partkey long, l_returnflag string").write.parquet(f"{tmp_path}/lineitem.parquet")
    orders = [(o, None if o % 11 == 3 else f"2024-01-{o % 5 + 1:02}") for o in range(38)]
    spark.createDataFrame(orders, "o_orderkey long, day string").selectExpr("o_orderkey", "CAST(day AS TIMESTAMP) AS o_orderdate").write.parquet(f"{tmp_path}/orders.parquet")
    dealt = A.order_events(spark, str(tmp_path))
    got = sorted(map(tuple, S.overlay(dealt, asserts="n").collect()))
    assert got == sorted(map(tuple, S.overlay(A.events(spark, str(tmp_path))).collect())) and len(got) > 100
    assert dealt.agg({"n": "sum"}).first()[0] == A.events(spark, str(tmp_path)).where("deny = 0").count()
