import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tesserae.operators import closure as C
from tesserae.operators import diff as D
from tesserae.operators import documents as P
from tesserae.operators import integrity as I
from tesserae.operators import measures as M
from tesserae.operators import merges as G
from tesserae.operators import passes
from tesserae.operators import resolve as R
from tesserae.operators import settle as S


def rows(df, *order):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_overlay(spark):
    d = dt.date(2026, 1, 1)
    e = spark.createDataFrame([(1, 2, d, 0), (1, 2, d, 1), (1, 3, d, 1), (1, 3, d + dt.timedelta(1), 0), (1, 3, None, 0), (4, 5, None, 0)], "subj long, tgt long, d date, deny int")
    assert rows(S.overlay(e)) == [(1, 3, 2), (4, 5, 1)]


def test_claims_and_edges(spark):
    d = dt.date(2026, 1, 1)
    e = spark.createDataFrame([(1, 2, "alias_of", d, 1), (2, 1, "distinct_from", d, 2), (3, 4, "facet_of", d, 3), (4, 3, "alias_of", d, 4), (3, 5, "alias_of", None, 5), (6, 6, "alias_of", d, 6)], "frm long, dst long, kind string, d date, ord long")
    settled = S.claims(e)
    assert rows(settled.select("lo", "hi", "kind")) == [(1, 2, "distinct_from"), (3, 4, "facet_of"), (3, 5, "alias_of")]
    edges = S.fold_edges(settled)
    assert rows(edges) == [(3, 4, True)]
    model = spark.createDataFrame([(2, 1, True), (3, 9, True), (7, 8, False)], "frm long, dst long, listed boolean")
    assert rows(S.with_model_folds(edges, settled, model)) == [(3, 4, True), (7, 8, False)]


def chain(spark):
    return spark.createDataFrame([(1, 2, False), (2, 3, True), (3, 4, False), (5, 6, True), (6, 5, True), (7, 5, False), (8, 9, True), (9, 9 + 1, False), (10, 8, False), (11, 2, True)], "frm long, dst long, listed boolean")


def test_closure(spark):
    assert rows(C.fold_closure(chain(spark))) == [(1, 4), (11, 4), (2, 4), (3, 4)]
    flags = {r[0]: tuple(r[1:]) for r in C.path_flags(C.fold_paths(chain(spark))).collect()}
    assert flags == {1: (4, False, False, 2, 3), 2: (4, False, True, None, 2), 3: (4, True, False, None, 1), 11: (4, False, True, 2, 3)}
    names = spark.createDataFrame([(2, "B"), (11, "a")], "node long, name string")
    assert rows(C.tree_order(C.fold_paths(chain(spark)), names)) == [(4, 11, 2, 2), (4, 2, 1, 1)]
    assert C.fold_closure(chain(spark).limit(0)).count() == 0
    got = C.repoint(spark.createDataFrame([(1, 3), (1, 9)], "a long, b long"), C.fold_closure(chain(spark)), "a", "b")
    assert rows(got.select("a", "b")) == [(4, 4), (4, 9)]


def test_resolve(spark):
    cat = spark.createDataFrame([(1, "Anchor Step", ["base"]), (2, "Body", [])], "id long, name string, aliases array<string>")
    from tesserae.functions import text as X

    keys = R.keys_of(cat, "id", X.api_slugify(F.col("name")), F.try_element_at("aliases", F.lit(1)))
    names = spark.createDataFrame([("anchor steps",), ("Base",), ("bodies",), ("none",)], "name string")
    assert rows(R.prioritised(names, "name", keys)) == [("Base", 1), ("anchor steps", 1), ("bodies", 2), ("none", None)]
    people = spark.createDataFrame([(1, "ann-lee", "Ann Lee"), (2, "bo", "Bo")], "id long, slug string, name string")
    raw = spark.createDataFrame([("BO",), ("lee",), ("zed",)], "raw string")
    assert rows(R.exact_then_contains(raw, "raw", people, "id", "slug", "name")) == [("BO", 2, "exact"), ("lee", 1, "contains"), ("zed", None, None)]


def test_support_counts_null_source(spark):
    s = spark.createDataFrame([(1, 10), (1, None), (2, None)], "entity long, source long")
    r = spark.createDataFrame([(1, 5), (3, 1)], "entity long, n long")
    assert rows(M.support(s, r)) == [(1, 2, 5, 7, False), (2, 1, 0, 1, True), (3, 0, 1, 1, True)]


def test_evidence_and_samples(spark):
    e = spark.createDataFrame([(1, r, f"k{i}", dt.date(2026, 1, 1 + i)) for r in ("about", "refers") for i in range(5)], "entity long, role string, key string, date date")
    got = M.capped_evidence(e, {"about": 2, "refers": 1})
    assert got.where("sent").count() == 3 and got.where("covered").count() == 7
    many = spark.range(40_000).select((F.col("id") * 7919 % 40_009).alias("id"), F.lit("x").alias("a"), F.col("id").alias("b"))
    assert sorted(r["batch"] for r in M.batches(many, "id", 1).select("batch").collect()) == list(range(40_000))  # with further columns
    assert [r["batch"] for r in M.batches(spark.range(7), "id", 3).orderBy("id").collect()] == [0, 0, 0, 1, 1, 1, 2]
    a = M.round_robin(spark.createDataFrame([("x", i) for i in range(9)] + [("y", 99)], "s string, k long"), "s", "k", 4, "1")
    assert sorted(r["s"] for r in a.collect()) == ["x", "x", "x", "y"]


def test_diff(spark):
    old = spark.createDataFrame([(1, "a", None), (2, "b", 1), (3, "c", 1)], "k long, v string, n int")
    new = spark.createDataFrame([(1, "a", None), (2, "x", 1), (4, "d", 1)], "k long, v string, n int")
    assert rows(D.snapshot_diff(old, new, ["k"])) == [(2, "changed"), (3, "removed"), (4, "created")]
    assert rows(D.upsert(old, new, ["k"]).select("k", "v")) == [(1, "a"), (2, "x"), (3, "c"), (4, "d")]
    assert rows(D.delta(old, new, ["k"]).select("k")) == [(2,), (4,)]
    again = D.upsert(D.upsert(old, new, ["k"]), new, ["k"])
    assert rows(again) == rows(D.upsert(old, new, ["k"]))


def test_revisions(spark):
    said = "slug string, definition string, context string, keys array<string>"
    one = D.record_revision(spark.createDataFrame([], D.PROSE), spark.createDataFrame([("s", "old", "c", ["k1"])], said), "m", "1", "v1")
    two = D.record_revision(one, spark.createDataFrame([("s", "new", "d", [])], said), "m", "2", "v1")
    back = D.revert(two, "3")
    r = back.first()
    assert (r["definition"], r["context"], r["result"], len(r["revisions"]), r["integrated"]) == ("old", "c", "reverted", 3, ["k1"])
    assert back.select(D.human_chosen(F.col("revisions"))).first()[0] and D.revert(back.drop("result"), "4").first()["result"] == "chosen by a person"
    assert D.revert(one, "3").first()["result"] == "nothing before"
    more = D.record_revision(two, spark.createDataFrame([("s", "third", "e", ["k2"])], said), "m", "3", "v1")
    assert D.revert(more, "4").first()["result"] == "took in evidence" and more.first()["integrated"] == ["k1", "k2"]
    other = D.record_revision(two, spark.createDataFrame([("s", "x", "y", ["k9"])], said), "m", "3", "v2").first()
    assert other["integrated"] == ["k9"] and len(other["revisions"]) == 3
    page = lambda d, c: spark.createDataFrame([("s", d, c)], "slug string, definition string, context string")
    assert D.page_as_base(two, page("old", "c"), "5").first()["definition"] == "new"  # written by us
    edited = D.page_as_base(two, page("mine", "c"), "5")
    assert edited.first()["definition"] == "mine" and D.page_as_base(edited, page("mine", "c"), "6").first()["revisions"] == edited.first()["revisions"]


def test_integrity(spark):
    pages = spark.createDataFrame([("a.md", "[[b]] [[c]] [[c]]"), ("b.md", "[[a|x]]")], "path string, text string")
    assert rows(I.broken_links(pages, "path", "text").select("path", "target")) == [("a.md", "c"), ("a.md", "c")]
    assert I.broken_links(pages, "path", "text", spark.createDataFrame([("c.md",)], "path string")).count() == 0
    facts = spark.createDataFrame([(1, 7, None), (2, 8, 5)], "key long, a long, b long")
    known = spark.createDataFrame([(7,)], "id long")
    assert rows(I.dangling(facts, "key", {"a": (known, "id"), "b": (known, "id")})) == [(2, "a", "8"), (2, "b", "5")]


def test_documents(spark):
    pages = spark.createDataFrame([(1, "One"), (2, "Two")], "e long, name string")
    items = spark.createDataFrame([(1, 2, "b"), (1, 1, "a")], "e long, pos int, t string")
    got = P.assemble(pages, "e", [P.nest(items, "e", [F.col("pos")], {"t": F.col("t")}, "things", 5)])
    text = got.select("e", P.markdown(F.col("name"), {"kind": F.lit("x")}, {"Things": F.transform("things", lambda s: s["t"])}).alias("m"))
    by = {r["e"]: r["m"] for r in text.collect()}
    assert by[1] == "---\nkind: x\n---\n\n# One\n\n## Things\n\na\nb\n" and "##" not in by[2]
    parsed = text.where("e = 1").select(P.parse_markdown(F.col("m")).alias("p")).first()["p"]
    assert (parsed["frontmatter"], parsed["title"], [(s["name"], s["body"]) for s in parsed["sections"]]) == ({"kind": "x"}, "One", [("Things", "a\nb")])


def test_passes(spark):
    asked = spark.createDataFrame([("s1", 1, 0), ("s2", 2, 0)], "id string, subject long, batch long")
    batches = passes.prompts(asked, "batch", "id", "subject")
    prompt = batches.first()["prompt"]
    reply = '{"statements": [{"id": "s1", "references": [{"name": "Body", "polarity": "assert"}, {"name": "bodies", "polarity": "assert"}, {"name": "New Thing"}]}, {"id": "zz", "references": [{"name": "Body"}]}, {"id": "s2", "references": [{"name": "body"}]}]}'
    got = passes.answer(batches, lambda: passes.Replay({prompt: reply}))
    keys = spark.createDataFrame([("body", 2, 0)], "key string, entity long, prio int")
    linked = passes.link_answers(got, asked, keys, "v1", "m")
    assert rows(linked.select("statement", "name", "entity", "polarity")) == [("s1", "Body", 2, "assert"), ("s1", "New Thing", None, "assert")]


def test_condense(spark):
    old = spark.createDataFrame([("a", "d", "c"), ("b", "d", "c")], "slug string, definition string, context string")
    new = spark.createDataFrame([("a", "short", "Fine."), ("b", "w " * 60, "Fine.")], "slug string, definition string, context string")
    got = {r["slug"]: (r["definition"], r["problems"]) for r in passes.condense(old, new).collect()}
    assert got == {"a": ("short", []), "b": ("d", ["definition words"])}


@pytest.mark.parametrize("bad", ["frm", "dst"])
def test_null_ends_of_edges(spark, bad):
    e = spark.createDataFrame([(1, 2)], "frm long, dst long").withColumn("listed", F.lit(True)).withColumn(bad, F.lit(None).cast("long"))
    assert C.fold_closure(e).count() <= 1


def test_merges(spark):
    edges = spark.createDataFrame([(2, 1, False), (3, 2, True), (4, 1, True), (7, 8, False), (8, 7, False), (9, 7, True)], "frm long, dst long, listed boolean")
    names = spark.createDataFrame([(1, "Front Step"), (2, "Big Step"), (3, "big step"), (3, "Heel"), (4, "Front step"), (4, "Toe"), (4, " ")], "entity long, name string")
    flags = C.path_flags(C.fold_paths(edges))
    assert sorted(tuple(r) for r in G.hidden_names(flags, names).collect()) == [(1, "heel"), (1, "toe")]
    assert {r["frm"]: r["page"] for r in G.review_pages(edges.select("frm", "dst")).collect()} == {2: 1, 3: 1, 4: 1, 7: 7, 8: 8, 9: None}
    entities = spark.createDataFrame([(1, "a", ["x"]), (2, "b", ["x", "y", ""]), (3, "a", None)], "id long, name string, aliases array<string>")
    got = G.apply_merges({"entities": entities, "relations": spark.createDataFrame([(1, 2), (3, 1), (2, 5)], "f long, t long")}, spark.createDataFrame([(2, 1), (3, 1)], "frm long, root long"), {"relations": ["f", "t"]})
    assert [tuple(r) for r in got["entities"].collect()] == [(1, "a", ["x", "b", "y", "a"])]
    assert [tuple(r) for r in got["relations"].collect()] == [(1, 5)]


def test_names_in_other_names(spark):
    """Against a plain version that looks through the people in their order; no nested loop."""
    rng = random.Random(6)
    word = lambda n: "".join(rng.choice("ab c") for _ in range(n))
    people = [(i, rng.random(), word(rng.randint(1, 9)).replace(" ", "-"), word(rng.randint(0, 30)).title(), [word(4)] if i % 3 else None) for i in range(300)]
    names = sorted({word(rng.randint(0, 16)) for _ in range(400)} | {"", "a", "Ab", people[0][3], people[1][2]})

    def plain(raw):
        k = raw.strip().lower()
        order = sorted(people, key=lambda p: (p[1], p[0]))
        if k:
            for p in order:
                if k in (p[2].lower(), p[3].lower().strip()) or k in [a.strip().lower() for a in p[4] or []]:
                    return (raw, p[0], "exact")
            for p in order:
                if k in p[2] or k in p[3].lower():
                    return (raw, p[0], "contains")
        return (raw, None, None)

    df = spark.createDataFrame(people, "id long, place double, slug string, name string, aliases array<string>")
    got = R.exact_then_contains(spark.createDataFrame([(n,) for n in names], "raw string"), "raw", df, "id", "slug", "name", "place", "aliases")
    assert sorted(map(tuple, got.collect())) == sorted(map(plain, names))
    assert "NestedLoop" not in got._jdf.queryExecution().executedPlan().toString() and "Cartesian" not in got._jdf.queryExecution().executedPlan().toString()


def test_long_tails_into_cycles_and_ends(spark):
    tail = [(i, i + 1) for i in range(10_000)]
    loop = [(10_000, 10_001), (10_001, 10_002), (10_002, 10_000)]
    ends = [(20_000 + i, 20_001 + i) for i in range(3_000)]
    edges = spark.createDataFrame(tail + loop + ends + [(50_000, 50_000)], "frm long, dst long")
    pages = {r["frm"]: r["page"] for r in G.review_pages(edges).collect()}
    assert all(pages[i] is None for i in range(10_000)) and all(pages[i] == i for i in (10_000, 10_001, 10_002, 50_000))
    assert all(pages[20_000 + i] == 23_000 for i in range(3_000)) and len(pages) == 13_004
    assert C.fold_closure(spark.createDataFrame([(1, 2), (2, 1), (3, 1)], "frm long, dst long")).collect() == []


def test_field_differences(spark):
    a = spark.createDataFrame([(1, ("x", (1, None)), [1], "old"), (2, ("y", (2, "b")), None, "same"), (None, ("n", (0, "n")), [], "m"), (4, None, None, None)], "k int, h struct<n: string, in: struct<i: int, s: string>>, l array<int>, v string")
    b = spark.createDataFrame([(1, ("x", (2, None)), [1, 2], "old"), (2, ("y", (2, "b")), None, "same"), (None, ("n", (0, "n")), [], "z"), (5, None, None, None)], "k int, h struct<n: string, in: struct<i: int, more: string>>, l array<int>, v string")
    got = {(r["k"], r["path"], r["old"], r["new"]) for r in D.field_diff(a, b, ["k"]).collect()}
    assert got == {(1, "h.in.i", "1", "2"), (1, "l", "[1]", "[1,2]"), (2, "h.in.s", "b", None), (2, "h.in.more", None, "b"), (None, "h.in.s", "n", None), (None, "h.in.more", None, "n"), (None, "v", "m", "z"), (4, "*", "{}", None), (5, "*", None, "{}")}
    assert D.field_diff(a, a, ["k"]).collect() == [] and D.field_diff(a.limit(0), a.limit(0), ["k"]).collect() == []


def test_a_page_without_an_entry_becomes_one(spark):
    state = spark.createDataFrame([("a", "1", "m", "d", "Ours [[x]].", "", ["k"], [("llm", "d", "m", 1, "Ours [[x]].", "")])], D.PROSE)
    pages = spark.createDataFrame([("a", "Ours [[c/x]].", ""), ("new", "Typed.", None), ("empty", "", None), (None, "nobody", "")], "slug string, definition string, context string")
    got = {r["slug"]: r for r in D.page_as_base(state, pages, "2", "1").collect()}
    assert set(got) == {"a", "new"} and got["new"]["version"] == "1" and got["new"]["integrated"] == [] and [r["by"] for r in got["new"]["revisions"]] == ["page"]
    assert got["a"]["definition"] == "Ours [[c/x]]."  # an edit, as long as links are not brought into one form
    form = lambda c: F.regexp_replace(c, r"\[\[c/", "[[")
    same = {r["slug"]: r for r in D.page_as_base(state, pages, "2", "1", form).collect()}
    assert same["a"]["definition"] == "Ours [[x]]." and len(same["a"]["revisions"]) == 1


def test_links_are_led_to_pages_by_joins(spark):
    from tesserae.operators import links as L

    rows = spark.createDataFrame([("p", "[[a]] [[c/a|A]] [[gone-now]] [[old/b#top|B]] [[none|Label]]", "no link"), ("q", None, "[[a]]"), (None, "[[a]]", "")], "slug string, d string, c string")
    catalog = spark.createDataFrame([("a", "c/a.md"), ("b", "t/b"), ("a", "z/a"), (None, "x"), ("y", None)], "slug string, path string")
    got = {r["slug"]: (r["d"], r["c"]) for r in L.repair_links(rows, ["d", "c"], catalog).collect()}
    assert got == {"p": ("[[c/a]] [[c/a|A]] gone now [[t/b#top|B]] Label", "no link"), "q": (None, "[[c/a]]"), None: ("a", "")}
    facets = spark.createDataFrame([("r", "f1", "Limits", "Own. More.", 1, 0), ("r", "f2", "Depth", None, 2, 1)], "root string, slug string, name string, overview string, pos int, depth int")
    prose = spark.createDataFrame([("f2", "1", "See [[a]] first. Then.")], "slug string, version string, definition string")
    assert rows_of(L.details(facets, prose, catalog, "1")) == [("r", 1, "Limits", "Own.", 0), ("r", 2, "Depth", "See [[c/a]] first.", 1)]


def rows_of(df):
    return sorted(map(tuple, df.collect()))


def test_catalog_in_its_order(spark):
    cat = spark.createDataFrame([(0, 1, "a", ["Old Name"]), (1, 2, "b", ["Shared", None, ""]), (2, 3, "a", ["Shared", "third"])], "o int, id long, slug string, aliases array<string>")
    assert rows_of(R.catalog_keys(cat, "id", "slug", "aliases", "o")) == [("a", 3, 0), ("b", 2, 0), ("shared", 3, 1), ("third", 3, 1)]


def test_look_up_of_keys_that_most_rows_share(spark):
    """A key of half the rows, one that is null and many seldom ones come out as by a plain join, and no task is dealt all rows of one key."""
    rows = spark.range(6000).select("id", F.when(F.col("id") % 2 == 0, F.lit("often")).when(F.col("id") % 3 != 0, F.col("id").cast("string")).alias("k"))
    known = rows.where("k is not null").select("k", F.length("k").alias("n")).distinct().where("k not like '%7'")
    got = G.look_up(rows, ["k"], lambda keys: keys.join(known, "k"))
    assert got.columns == ["id", "k", "n"]
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, rows.join(known, "k", "left").select("id", "k", "n").collect()))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "_deal" in plan and "BroadcastHashJoin" in plan
    few = G.look_up(rows.where("k = 'often'"), ["k"], lambda keys: keys.join(known, "k"))
    assert few.where("n = 5").count() == 3000 and "SortMergeJoin" not in few._jdf.queryExecution().executedPlan().toString()
    assert G.look_up(rows.limit(0), ["k"], lambda keys: keys.join(known, "k")).collect() == []


def test_lists_of_one_aggregation(spark):
    """Several lists of a key from one pass, sorted without an interpreted comparator, a page without rows of a list as one without any rows."""
    items = spark.createDataFrame([(1, "b", 2, "x"), (1, "a", 1, None), (1, "c", None, "z"), (2, "b", 1, "y")], "e int, kind string, pos int, t string")
    got = P.lists(items, "e", {"low": (F.col("kind") != "b", [F.col("pos")], {"t": F.col("t")}), "b": (F.col("kind") == "b", [F.col("pos")], {"t": F.col("t")})})
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "lambda" not in plan and plan.count("Exchange hashpartitioning") == 1
    pages = P.assemble(spark.range(1, 4).select(F.col("id").cast("int").alias("e")), "e", [got])
    assert pages.columns == ["e", "low", "low_count", "b", "b_count"]
    assert sorted((r["e"], [x["t"] for x in r["low"]], r["low_count"], [x["t"] for x in r["b"]], r["b_count"]) for r in pages.collect()) == [(1, ["z", None], 2, ["x"], 1), (2, [], 0, ["y"], 1), (3, [], 0, [], 0)]


def test_credited_sources_are_those_of_credits(spark):
    rows_ = spark.createDataFrame([(1, 7, 7), (1, None, 8), (2, 9, 9), (2, 9, 9), (3, None, None), (4, None, 5)], "source int, teacher int, raw int")
    people = rows_.select("source", F.col("raw").alias("person"))
    for tasks in (None, 3):
        want = R.credits(rows_, people, tasks=tasks).select("credited", "source").distinct()
        assert rows(R.credited_sources(rows_, people, tasks=tasks)) == rows(want) and want.count() == 5


def test_lists_in_pieces_are_whole_and_in_order(spark):
    items = spark.createDataFrame([(1, i, f"t{i}") for i in range(23, 0, -1)] + [(2, 5, "x"), (None, 1, "n")], "e long, pos int, t string")
    order, line = [F.col("pos")], {"t": F.col("t")}
    whole = P.nest(items, "e", order, line, "things").collect()
    assert sorted(whole, key=str) == sorted(P.nest(items, "e", order, line, "things", 4).collect(), key=str) and len(whole) == 3
    texts = {r["e"]: ("\n".join(r["things"]), len(r["things"]), r["things_count"]) for r in P.texts(items, "e", order, F.col("t"), "things", 4).collect()}
    assert texts[1] == ("\n".join(f"t{i}" for i in range(1, 24)), 6, 23) and texts[2] == ("x", 1, 1)


def test_credited_is_credits_in_arrays(spark):
    """A row of its own teacher, open ones, a source of which all have their own, nobody named, and a source that is null."""
    rows_ = spark.createDataFrame([(1, 10, 7, True), (1, 11, 8, False), (1, 12, 7, False), (2, 13, 9, True), (3, 14, None, False), (None, 15, 5, True), (None, 16, 6, False)], "source long, key long, raw long, own boolean")
    plain = rows_.withColumn("teacher", F.when(F.col("own"), F.col("raw")))
    want = R.credits(plain, rows_.select("source", F.col("raw").alias("person"))).where("credited is not null")
    for tasks in (None, 3):
        got = R.credited(rows_, ["key"], tasks=tasks).select("key", F.explode("credited").alias("credited"))
        assert rows(got.distinct()) == rows(want.select("key", "credited").distinct()) and got.count() == 7
        assert sorted(R.credited_in(rows_, tasks=tasks).collect(), key=str) == sorted(want.select("credited", "source").distinct().collect(), key=str)
