"""The modes over one folder, from a source to the pages that it should lead to."""

import json

import pytest

from tesserae import modes as M
from tesserae.sources import tables as T


class Curator:
    def generate_json(self, prompt):
        p = json.loads(prompt)
        if "statements" in p:
            return json.dumps({"statements": [{"id": s["id"], "references": [{"name": w} for w in ("Anchor", "Soft Hand") if w.lower() in s["text"].lower()]} for s in p["statements"]]})
        if "broken" in p["slug"]:
            raise RuntimeError
        return json.dumps({"definition": f"About {p['slug']}, see [[anchor]].", "context": " ".join(e["key"] for e in p["evidence"])})


@pytest.fixture
def ws(spark, tmp_path):
    make = lambda name, *rows: spark.createDataFrame([{**r} for r in rows], T.SCHEMAS[name]) if rows else spark.createDataFrame([], T.SCHEMAS[name])
    corpus = {n: make(n) for n in T.SCHEMAS}
    corpus["entities"] = make("entities", *[{"id": f"e{i}", "slug": s, "canonical_name": s.title(), "kind": k, "aliases": []} for i, (s, k) in enumerate([("anchor", "concept"), ("frame", "pattern"), ("broken", "drill"), ("lonely", "odd")])])
    corpus["sources"] = make("sources", {"id": "s1", "title": "A"}, {"id": "s2", "title": "B"})
    corpus["attributions"] = make("attributions", {"id": "a1", "source_id": "s1", "entity_id": "e1", "prose": "the frame needs an anchor and a soft hand"}, {"id": "a2", "source_id": "s1", "entity_id": "e2", "prose": "it is broken"}, {"id": "a3", "source_id": "s2", "entity_id": "e0", "prose": "anchor first"}, {"id": "a4", "source_id": "s2", "entity_id": "e9", "prose": "nobody"}, {"id": "a5", "source_id": "s2", "entity_id": "e0", "prose": " "})
    return M.Workspace(spark, corpus, f"file://{tmp_path}/state", "v1", "m")


def test_a_link_job_ends_in_the_pages_it_should(ws):
    steps = M.run_job(ws, Curator, "s1", "today")
    assert steps == [("link", 2), ("generate", 2), ("generate", 0), ("materialise", 2)]
    links = {(r["statement"], r["entity"], r["target"]) for r in ws.table("links").read()[0].collect()}
    assert links == {("a1", "anchor", None), ("a1", None, "soft-hand")}
    pages = {r["slug"]: r for r in ws.table("pages").read()[0].collect()}
    assert set(pages) == {"anchor", "frame"} and pages["frame"]["overview"] == "About frame, see [[concepts/anchor]]." and pages["frame"]["sources"] == ["s1"]
    assert pages["anchor"]["context"] == "a1 a3" or pages["anchor"]["context"] == "a3 a1"  # its own statement and the mention
    before = {n: ws.table(n).versions() for n in ("links", "linked", "proposed", "prose", "seen", "pages")}
    assert M.run_job(ws, Curator, "s1", "later") == [("link", 0), ("generate", 0)]
    assert {n: ws.table(n).versions() for n in before} == before  # repeated, it does nothing


def test_modes_over_the_whole_corpus(ws):
    assert M.link(ws, Curator).count() == 3 and M.link(ws, Curator).isEmpty()
    report = {r["slug"]: r["state"] for r in M.generate(ws, Curator, "today").collect()}
    assert report == {"anchor": "made", "frame": "made", "broken": "failed"}
    assert {r["state"] for r in M.materialise(ws).collect()} == {"created"} and M.materialise(ws).isEmpty()
    assert M.condense(ws, Curator, "today").isEmpty()
    ws.corpus["entities"] = ws.corpus["entities"].where("slug <> 'lonely'")
    assert [tuple(r) for r in M.materialise(ws).collect()] == [("lonely", "removed")]
    assert ws.table("pages").read()[0].count() == 3
    with pytest.raises(T.EmptyCorpusError):
        M.Workspace(ws.spark, {**ws.corpus, "sources": ws.corpus["sources"].limit(0)}, ws.folder)
