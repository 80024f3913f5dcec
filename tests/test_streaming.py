import pytest

from tesserae.sources import sinks, tables
from tesserae.streaming import jobs as J


def test_stream_sets_bad_jobs_aside(spark, tmp_path):
    (tmp_path / "in").mkdir()
    spark.createDataFrame([('{"job": "link", "source_id": "s1"}',), ("{",), ('{"job": "generate"}',)], "body string").write.parquet(str(tmp_path / "in/a"))
    seen = []
    stream = spark.readStream.schema("body string").parquet(str(tmp_path / "in/*"))
    J.run_stream(stream, lambda df, n: seen.extend(r["source_id"] for r in df.collect()), str(tmp_path / "dead"), str(tmp_path / "cp"), 60)
    assert seen == ["s1"]
    assert sorted(r["problem"] for r in spark.read.parquet(str(tmp_path / "dead")).collect()) == ["no entity", "unreadable"]


def test_late_rows_are_settled_by_their_date(spark, tmp_path):
    work = J.settle_into(str(tmp_path / "state"), ["k"], ["d"])
    work(spark.createDataFrame([("a", 5, "new")], "k string, d int, v string"), 0)
    work(spark.createDataFrame([("a", 3, "late"), ("b", 1, "x")], "k string, d int, v string"), 1)
    work(spark.createDataFrame([("a", 3, "late")], "k string, d int, v string"), 4)  # batches without sound jobs write nothing
    assert J.versions(spark, str(tmp_path / "state")) == [0, 1, 4]
    assert sorted(tuple(r) for r in J.settled(spark, str(tmp_path / "state")).collect()) == [("a", 5, "new"), ("b", 1, "x")]


def test_state(spark, tmp_path):
    path = str(tmp_path / "t")
    assert tables.read_state(spark, path, "slug string, n int").count() == 0
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        tables.read_state(spark, path, "slug string, n int", required=True)
    df = spark.createDataFrame([("b", 1), ("a", 2)], "slug string, n int")
    sinks.write_state(df, path, "slug")
    got = tables.read_state(spark, path, "slug string, n int")
    sinks.verify(df, got, ["slug"])
    with pytest.raises(sinks.StateMismatchError):
        sinks.verify(df.limit(1), got, ["slug"])
    with pytest.raises(sinks.UnknownFieldsError, match="x"):
        sinks.import_state(df.selectExpr("*", "1 AS x"), got, path + "2", ["slug"])
    assert sinks.write_delta(got, df.selectExpr("slug", "if(slug = 'a', 3, n) AS n"), path, ["slug"]) == 1
    sinks.dry_run(df)


def test_export(spark, tmp_path):
    (tmp_path / "e.json").write_text('{"exported_at": "2026-01-01T00:00:00Z", "entities": [{"id": "1", "slug": "a", "aliases": ["x"]}, {"id": "2", "slug": "b"}], "sources": []}')
    got = tables.read_export(spark, str(tmp_path / "e.json"))
    assert [(r["slug"], r["_ord"]) for r in got["entities"].orderBy("_ord").collect()] == [("a", 0), ("b", 1)]
    with pytest.raises(tables.EmptyCorpusError):
        tables.require_corpus(got)


def test_pages_sink(spark):
    old = spark.createDataFrame([("a", 1), ("b", 1), ("c", 1)], "slug string, n int")
    new = spark.createDataFrame([("a", 1), ("b", 2), ("d", 1)], "slug string, n int")
    counts = sinks.save_pages(old, new, "slug", lambda rows: list(rows), lambda rows: list(rows))
    assert {r["state"]: r["count"] for r in counts.collect()} == {"unchanged": 1, "changed": 1, "created": 1, "removed": 1}
