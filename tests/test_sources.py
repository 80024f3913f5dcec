"""The corpus over HTTP, chunked sinks and tables with one writer, against a server of this process."""

import json
import threading
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer

import pytest

from tesserae.sources import http
from tesserae.sources.versions import StaleVersionError, VersionedTable
from tesserae.streaming import jobs as J


@pytest.fixture
def server():
    class Handler(BaseHTTPRequestHandler):
        def do_GET(self):
            path, _, query = self.path.partition("?")
            name = path.strip("/")
            tag = f'"{name}-{state["revision"]}-{query}"'
            same = self.headers.get("If-None-Match") == tag
            state["asked"].append((name, query, 304 if same else 200))
            rows = state["tables"].get(name, [])
            if query:
                part, parts = (int(x.split("=")[1]) for x in query.split("&"))
                rows = rows[part::parts]
            self.send_response(304 if same else 200)
            self.send_header("ETag", tag)
            self.end_headers()
            if not same:
                self.wfile.write("\n".join(json.dumps(r) for r in rows).encode())

        def do_PUT(self):
            rows = json.loads(self.rfile.read(int(self.headers["Content-Length"])))
            refused = any(r.get("slug") == state["refuse"] for r in rows)
            if not refused:
                state["put"].append((self.path, rows))
            self.send_response(500 if refused else 200)
            self.end_headers()

        def log_message(self, *a):
            pass

    state = {"revision": 1, "asked": [], "put": [], "refuse": None, "tables": {
        "entities": [{"id": str(i), "slug": f"e{i}", "aliases": ["é", None], "external_origin": {"a": "b"}, "more": 1} for i in range(5)],
        "sources": [{"id": "s", "session_date": "2026-01-02", "created_at": "2026-01-02T03:04:05Z", "is_default_visible": True}],
    }}
    s = ThreadingHTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=s.serve_forever, daemon=True).start()
    yield state, f"http://127.0.0.1:{s.server_port}"
    s.shutdown()


def test_unchanged_tables_are_read_from_their_copy(spark, server, tmp_path):
    state, url = server
    read = lambda: http.read_corpus(spark, url, f"file://{tmp_path}/copies")
    assert sorted(r["slug"] for r in read()["entities"].collect()) == [f"e{i}" for i in range(5)]
    assert read()["entities"].where("aliases[0] = 'é' and aliases[1] is null and external_origin['a'] = 'b'").count() == 5
    assert [x[2] for x in state["asked"]] == [200, 304]
    source = read()["sources"].first()
    assert str(source["session_date"]) == "2026-01-02" and source["is_default_visible"] and source["title"] is None
    state["tables"]["entities"].append({"id": "9", "slug": "e9"})
    assert read()["entities"].count() == 5  # the server says that nothing has changed
    state["revision"] = 2
    assert read()["entities"].count() == 6
    assert read()["relations"].collect() == []


def test_a_table_in_parts_and_without_copies(spark, server):
    state, url = server
    assert http.read_corpus(spark, url, parts=3)["entities"].count() == 5
    assert sorted(q for _, q, _ in state["asked"]) == [f"part={i}&parts=3" for i in range(3)]


def test_pages_go_in_chunks_and_before_removals(spark, server):
    state, url = server
    old = spark.createDataFrame([(f"p{i:03}", 1) for i in range(200)] + [(f"gone{i:03}", 1) for i in range(7)], "slug string, n int")
    new = spark.createDataFrame([(f"p{i:03}", 1 if i < 20 else 2) for i in range(230)], "slug string, n int")
    counts = {r["state"]: r["count"] for r in http.post_pages(old, new, "slug", url, removals=3).collect()}
    assert counts == {"unchanged": 20, "changed": 180, "created": 30, "removed": 7}
    paths = [p for p, _ in state["put"]]
    assert paths == sorted(paths) and set(paths) == {"/pages", "/removals"}
    assert max(len(r) for p, r in state["put"] if p == "/pages") <= 50 and max(len(r) for p, r in state["put"] if p == "/removals") <= 3
    assert sorted(r["slug"] for p, rows in state["put"] if p == "/pages" for r in rows) == [f"p{i:03}" for i in range(20, 230)]
    state["put"].clear()
    http.post_pages(new, new, "slug", url)
    assert state["put"] == []  # a second run changes nothing


def test_a_refused_chunk_leaves_what_was_sent_and_removes_nothing(spark, server):
    state, url = server
    state["refuse"] = "p170"
    old, new = spark.createDataFrame([("gone", 1)], "slug string, n int"), spark.createDataFrame([(f"p{i:03}", 1) for i in range(200)], "slug string, n int")
    with pytest.raises(Exception, match="500"):
        http.post_pages(old, new, "slug", url)
    assert state["put"] and all(p == "/pages" for p, _ in state["put"])
    state["refuse"] = None
    http.post_pages(old, new, "slug", url)
    assert {r["slug"] for p, rows in state["put"] if p == "/pages" for r in rows} == {f"p{i:03}" for i in range(200)} and state["put"][-1] == ("/removals", [{"slug": "gone"}])


def test_a_delta_is_flushed_at_its_limits(spark, server):
    state, url = server
    old = spark.createDataFrame([(f"k{i:04}", 1) for i in range(300)], "slug string, n int")
    new = spark.createDataFrame([(f"k{i:04}", 1 + i % 2) for i in range(1000)], "slug string, n int")
    http.post_delta(old, new, ["slug"], url)
    assert sum(len(r) for _, r in state["put"]) == 150 + 700 and max(len(r) for _, r in state["put"]) <= 100
    state["put"].clear()
    http.post_state(new, "slug", url)
    assert sum(len(r) for _, r in state["put"]) == 1000 and max(len(r) for _, r in state["put"]) <= 250
    rows = [type("R", (), {"asDict": lambda self, recursive: {"slug": "x"}})() for _ in range(5)]
    http.PostWriter({"url": url, "seconds": "0", "flush": "100"}).write(iter(rows))
    assert [len(r) for _, r in state["put"][-5:]] == [1] * 5  # after so many seconds whatever is held goes


def test_one_writer_for_a_version(spark, tmp_path):
    table = VersionedTable(spark, f"file://{tmp_path}/t", "k string, n int", ["k"])
    rows, version = table.read()
    assert rows.isEmpty() and version == 0
    df = lambda *r: spark.createDataFrame(r, "k string, n int")
    assert table.commit(df(("a", 1), ("b", 1)), 0) == 1
    with pytest.raises(StaleVersionError):
        table.commit(df(("a", 9)), 0)
    seen = []

    def change(rows):
        if not seen:  # another writer comes between reading and writing
            table.commit(df(("c", 5)), 1)
        seen.append(1)
        return rows.where("k = 'a'").selectExpr("k", "n + 1 AS n")

    assert table.update(change) == 3 and len(seen) == 2
    assert sorted(map(tuple, table.read()[0].collect())) == [("a", 2), ("b", 1), ("c", 5)]
    assert table.commit(spark.createDataFrame([("b", None, True)], "k string, n int, _gone boolean"), 3) == 4
    assert sorted(map(tuple, table.read()[0].collect())) == [("a", 2), ("c", 5)] and sorted(map(tuple, table.read(1)[0].collect())) == [("a", 1), ("b", 1)]
    assert table.compact(4) == 5 and len(table._folders(5)) == 1 and table.read()[0].count() == 2
    assert table.update(lambda rows: rows.limit(0)) == 5


def test_late_rows_write_only_the_keys_that_they_change(spark, tmp_path):
    table = VersionedTable(spark, f"file://{tmp_path}/t", "k string, d int, v string", ["k"])
    work = J.settle_changes(table, ["d"])
    batch = lambda *r: spark.createDataFrame(r, "k string, d int, v string")
    work(batch(("a", 5, "new"), ("b", 1, "x")), 0)
    work(batch(("a", 3, "late"), ("b", 2, "y")), 1)
    work(batch(("a", 3, "late"), ("b", 2, "y")), 1)
    assert table.versions() == [1, 2] and sorted(map(tuple, table.read()[0].collect())) == [("a", 5, "new"), ("b", 2, "y")]
    assert spark.read.parquet(f"{tmp_path}/t/{table._folders(2)[1]}").count() == 1
