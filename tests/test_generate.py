"""Runs over state: evidence across runs, rewrites with a second try, names between waves."""

import datetime as dt
import json


from tesserae.operators import diff as D
from tesserae.operators import generate as GEN
from tesserae.operators import waves

V = "v2"
EVIDENCE = "entity string, role string, key string, date date, text string"


class Writer:
    """Writes a text that names how much it was sent; fails for some pages."""

    def __init__(self, fails=()):
        self.fails = fails

    def generate_json(self, prompt):
        p = json.loads(prompt)
        if p.get("slug") in self.fails:
            raise RuntimeError("no answer")
        if "evidence" not in p:  # a rewrite
            return json.dumps({"definition": "Short.", "context": "Tight enough. See [[sources/a]]."})
        if p["slug"] == "long":
            return json.dumps({"definition": "word " * 60, "context": "word " * 120})
        return json.dumps({"definition": f"About {p['slug']}.", "context": " ".join([p["context"], *[e["key"] for e in p["evidence"]]]).strip() + " ([[sources/a]])."})


def prose_of(spark, *rows):
    return spark.createDataFrame(rows, D.PROSE)


def test_evidence_beyond_the_cap_waits_and_is_taken_in_once(spark):
    day = dt.date(2026, 1, 1)
    rows = [("hub", "about", f"o{i}", day + dt.timedelta(days=i), "x") for i in range(5)] + [("hub", "refers", f"r{i}", day + dt.timedelta(days=i), "x") for i in range(4)]
    rows += [("shy", "about", "s0", None, "x"), ("bad", "about", "b0", day, "x"), (None, "about", "n", day, "x"), ("hub", "about", "o0", day, "x")]
    evidence = spark.createDataFrame(rows, EVIDENCE)
    prose, seen = prose_of(spark), spark.createDataFrame([("hub", "o4", "v1")], GEN.SEEN)
    sent = []
    for day_ in range(4):
        run = GEN.generate(prose, seen, evidence, lambda: Writer({"bad"}), "m", f"day {day_}", V, {"about": 2, "refers": 3})
        report = {r["slug"]: (r["state"], r["statements"]) for r in run.report.collect()}
        sent.append(report)
        prose, seen = GEN.cut(run.prose), GEN.cut(run.seen)
    assert sent[0] == {"hub": ("made", 5), "shy": ("made", 1), "bad": ("failed", 1)}
    assert [s.get("hub") for s in sent[1:]] == [("made", 2), ("made", 1), None] and all(s["bad"] == ("failed", 1) for s in sent)
    hub = prose.where("slug = 'hub'").first()
    assert [r["statements"] for r in hub["revisions"]] == [5, 2, 1] and hub["integrated"] == ["o0", "o1", "o2", "o3", "o4", "r1", "r2", "r3"]
    assert {r["key"] for r in seen.where("entity = 'hub' and version = 'v2'").collect()} == {f"o{i}" for i in range(5)} | {f"r{i}" for i in range(4)}
    assert hub["context"].count("o3") == 1  # no statement is sent twice
    assert prose.where("slug = 'bad'").isEmpty() and seen.where("entity = 'bad'").isEmpty()


def test_an_answer_out_of_shape_is_condensed_and_tidied(spark):
    evidence = spark.createDataFrame([("long", "about", "k", dt.date(2026, 1, 1), "x")], EVIDENCE)
    got = GEN.generate(prose_of(spark), spark.createDataFrame([], GEN.SEEN), evidence, Writer, "m", "d", V).prose.first()
    assert got["definition"] == "Short." and got["context"] == "Tight enough. See ([[sources/a]])." and got["revisions"][0]["statements"] == 1


def test_another_version_reads_all_evidence_again(spark):
    evidence = spark.createDataFrame([("a", "about", "k", dt.date(2026, 1, 1), "x")], EVIDENCE)
    old = prose_of(spark, ("a", "v1", "m", "d", "Old.", "Old.", ["k"], [("llm", "d", "m", 1, "Old.", "Old.")]))
    run = GEN.generate(old, spark.createDataFrame([("a", "k", "v1")], GEN.SEEN), evidence, Writer, "m", "d", V)
    got = run.prose.first()
    assert got["version"] == V and "Old" not in got["context"] and len(got["revisions"]) == 2


class Stubborn:
    """Refuses at first to be short; page "never" always; page "down" has no answer."""

    def generate_json(self, prompt):
        p = json.loads(prompt)
        if p["definition"].startswith("down"):
            raise RuntimeError
        if p["definition"].startswith("never") or (p["definition"].startswith("second") and "refused" not in p):
            return json.dumps({"context": "still — long"})
        if "refused" in p:
            assert p["problems"] and p["refused"] == "still — long"
        return json.dumps({"definition": "other", "context": "Fits now."})


def test_only_refused_rewrites_go_again(spark):
    long = "word " * 120
    page = lambda slug, by="llm", context=long: (slug, V, "m", "d", f"{slug} text.", context, [], [(by, "d", "m", 3, f"{slug} text.", context)])
    rows = [page("first"), page("second"), page("never"), page("down"), page("person", by="page"), page("fine", context="Short."), ("other", "v1", "m", "d", "x", long, [], [])]
    prose, report = GEN.condense(prose_of(spark, *rows), Stubborn, "m2", "d2", V)
    got = {r["slug"]: (r["tries"], r["state"], r["problems"], r["context"]) for r in report.collect()}
    assert got == {"first": (1, "condensed", [], None), "second": (2, "condensed", [], None), "never": (2, "not kept", ["long dash"], "still — long"), "down": (1, "failed", [], None)}
    texts = {r["slug"]: (r["context"], len(r["revisions"]), r["definition"]) for r in prose.collect()}
    assert texts["first"] == texts["second"][:1] + (2, "first text.") == ("Fits now.", 2, "first text.")
    assert all(texts[s][1] == 1 for s in ("never", "down", "person", "fine")) and texts["never"][0] == long
    again, report = GEN.condense(prose, Stubborn, "m2", "d3", V, only=["first", "fine"])
    assert report.isEmpty() and again.count() == prose.count()


class Namer:
    """Links each statement to the word it holds; and notes in a link's name which names it was told."""

    def generate_json(self, prompt):
        p = json.loads(prompt)
        out = []
        for s in p["statements"]:
            refs = [{"name": s["text"]}]
            if s["text"] == "Frame":
                refs.append({"name": "told " + "+".join(p["names"])})
            out.append({"id": s["id"], "references": refs})
        return json.dumps({"statements": out})


def test_later_waves_see_and_resolve_to_earlier_proposals(spark):
    rows = [("s1", "x", "Soft Hand"), ("s2", "x", "Anchor"), ("s3", "x", "Soft Hands"), ("s4", "x", "Frame"), ("s5", "x", "soft  hand"), ("s6", "x", "ANCHOR")]
    statements = spark.createDataFrame(rows, "id string, subject string, text string")
    keys = spark.createDataFrame([("anchor", "e1", 0)], "key string, entity string, prio int")
    proposed = spark.createDataFrame([("old-idea", "old idea")], waves.PROPOSED)
    links, after = waves.link(statements, keys, proposed, Namer, "v", "m", size=2, waves=3)
    got = {(r["statement"], r["name"]): (r["entity"], r["target"]) for r in links.collect()}
    assert got["s1", "Soft Hand"] == got["s3", "Soft Hands"] == got["s5", "soft  hand"] == (None, "soft-hand")
    assert got["s2", "Anchor"] == got["s6", "ANCHOR"] == ("e1", None)
    assert ("s4", "told old idea+soft hand") in got  # the second wave was told what the first proposed
    names = {r["slug"]: r["name"] for r in after.collect()}
    assert names["soft-hand"] == "soft hand" and names["old-idea"] == "old idea" and len(names) == 4
    none, same = waves.link(statements.limit(0), keys, proposed, Namer, "v", "m")
    assert none.isEmpty() and same.count() == 1
    assert waves.names_in_use(after, 9) == '["frame"]'


def test_pending_evidence_is_shuffled_once(spark):
    """Statements are told apart and put in order after one shuffle, beside that of a join that is not broadcast."""
    from tesserae.operators import generate as GEN

    rows = [("a", "about", f"k{i % 5}", f"2020-01-0{i % 5 + 1}", "t") for i in range(10)] + [("a", "refers", "k9", None, "t"), (None, "about", "k", None, "t"), ("b", "about", "s", None, "t")]
    evidence = spark.createDataFrame(rows, "entity string, role string, key string, date string, text string").repartition(3).cache()
    seen = spark.createDataFrame([("b", "s", "1"), ("a", "k4", "1"), ("a", "k3", "0")], GEN.SEEN)
    got = GEN.pending_evidence(evidence, seen, "1", {"about": 2, "refers": 0})
    assert got._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 3  # two of the join
    assert sorted((r["entity"], r["key"], r["sent"], r["covered"]) for r in got.collect()) == [("a", "k0", False, False), ("a", "k1", False, False), ("a", "k2", True, True), ("a", "k3", True, True), ("a", "k9", False, True)]
