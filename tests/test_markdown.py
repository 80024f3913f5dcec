"""Pages read, edited and written; frontmatter as a YAML reader has it."""

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tesserae.functions import markdown as MD

PAGE = """---
title: 'It''s: a page'
kind: concept
note: "a \\"b\\" \\u00e9"
empty:
none: []
sources:
- a b
- "c: d"
- 'e # f'
tags: [x, y z]
flow: ["p, q", "r"]
origin:
  system: one
  id: 2
long: words that
  go on
# a remark
last: 3
---

Before.

## Definition

What it is.

## By teacher

Some words.

### Ana

- one

- two
### Bo
- three


## Empty
"""


def read(spark, *texts):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i long, t string")
    return [r["p"] for r in rows.select("i", MD.read_page(F.col("t")).alias("p")).orderBy("i").collect()]


def written(spark, *texts):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i long, t string")
    return [r["t"] for r in rows.select("i", MD.write_page(MD.read_page(F.col("t"))).alias("t")).orderBy("i").collect()]


def test_forms_of_frontmatter(spark):
    facts = [tuple(f) for f in read(spark, PAGE)[0]["facts"]]
    assert facts == [
        ("title", "text", ["It's: a page"]), ("kind", "text", ["concept"]), ("note", "text", ['a "b" é']), ("empty", "text", []), ("none", "list", []),
        ("sources", "list", ["a b", "c: d", "e # f"]), ("tags", "list", ["x", "y z"]), ("flow", "list", ["p, q", "r"]), ("origin", "raw", ["origin:\n  system: one\n  id: 2"]),
        ("long", "text", ["words that go on"]), ("last", "text", ["3"]),
    ]


def test_outline(spark):
    page = read(spark, PAGE)[0]
    assert page["preamble"] == "Before."
    assert [tuple(s) for s in page["sections"]] == [("Definition", "\nWhat it is."), ("By teacher", "\nSome words.\n\n### Ana\n\n- one\n\n- two\n### Bo\n- three"), ("Empty", "")]
    rows = spark.createDataFrame([(PAGE,)], "t string").select(MD.read_page(F.col("t")).alias("p"))
    got = rows.select(MD.split_parts(MD.section(F.col("p"), "By teacher")).alias("s"), MD.fact(F.col("p"), "tags").alias("tags"), MD.fact(F.col("p"), "origin").alias("origin"), MD.section(F.col("p"), "Nowhere").alias("no")).first()
    assert [tuple(p) for p in got["s"]] == [(None, "Some words."), ("Ana", "\n- one\n\n- two"), ("Bo", "- three")]
    assert got["tags"] == ["x", "y z"] and got["origin"] is None and got["no"] is None


def test_edits_leave_the_rest(spark):
    p = F.col("p")
    rows = spark.createDataFrame([(PAGE,)], "t string").select(MD.read_page(F.col("t")).alias("p"))
    edited = rows.withColumn("p", MD.with_section(p, "Definition", F.lit("New."))).withColumn("p", MD.with_part(p, "By teacher", "Bo", F.lit("- four")))
    text = edited.select(MD.write_page(p).alias("t")).first()["t"]
    assert text == written(spark, PAGE)[0].replace("What it is.", "New.").replace("\n### Bo\n- three", "\n\n### Bo\n\n- four")
    rows = rows.withColumn("p", MD.with_section(p, "Last", F.lit("z"))).withColumn("p", MD.with_part(p, "Empty", "Cy", F.lit("- five")))
    for key, value in (("tags", "x"), ("tags", "w"), ("kind", "k"), ("new", "v"), ("new", "v"), ("origin", "o"), ("empty", "e"), ("last", None)):
        rows = rows.withColumn("p", MD.add_unique(p, key, F.lit(value).cast("string")))
    page = rows.select(MD.read_page(MD.write_page(p)).alias("p")).first()["p"]
    facts = {f["key"]: f["values"] for f in page["facts"]}
    assert (facts["tags"], facts["kind"], facts["new"], facts["empty"]) == (["x", "y z", "w"], ["concept", "k"], ["v"], ["e"])
    assert facts["origin"] == ["origin:\n  system: one\n  id: 2"]
    assert [s["name"] for s in page["sections"]] == ["Definition", "By teacher", "Empty", "Last"] and page["sections"][2]["body"] == "\n### Cy\n\n- five"


def test_null_empty_long_and_broken(spark):
    broken = "---\nno entry here\nkey: 1\n---\n\ntext\n"
    long = "---\nk: " + "'\"\\ # : " * 30000 + "\n---\n" + "## \n### x\n" * 30000
    none, empty, only, bad, unclosed, crlf, deep = read(spark, None, "", "---\n---\n", broken, "---\na: 1\n", "---\r\na: 1\r\n---\r\n## B\r\nc\r\n", long)
    assert none is None
    assert empty == only and tuple(empty) == ([], "", [])
    assert [tuple(f) for f in bad["facts"]] == [(None, "raw", ["no entry here\nkey: 1"])] and bad["preamble"] == "text"
    assert unclosed["facts"] == [] and unclosed["preamble"] == "---\na: 1"
    assert tuple(crlf["facts"][0]) == ("a", "text", ["1"]) and tuple(crlf["sections"][0]) == ("B", "c")
    assert len(deep["facts"]) == 1
    assert written(spark, None, "", broken) == [None, "\n", broken]


def test_written_pages_are_yaml(spark):
    yaml = pytest.importorskip("yaml")
    values = ["plain", "a: b", "- x", "#no", "x #y", "it's", 'say "so"', "é ü 漢", "", "~", "back\\slash", "two\nlines", " edge ", "[[link]]", "{a}", "*", "&b", "%", "@", "`", "end:", "?", "-", "null", "tab\there"]
    front = yaml.safe_dump({"one": values, "long": "word " * 60, "quoted": "it's: " * 40, "none": [], "nested": {"a": [1, 2]}, "date": "x"}, sort_keys=False, allow_unicode=True)
    page = read(spark, f"---\n{front}---\n")[0]
    facts = {f["key"]: (f["form"], f["values"]) for f in page["facts"]}
    assert facts["long"] == ("text", [("word " * 60).strip()]) or facts["long"][1] == ["word " * 60]
    assert facts["quoted"][1] == ["it's: " * 40] and facts["none"] == ("list", []) and facts["nested"][0] == "raw"
    rows = spark.createDataFrame([(values,)], "v array<string>").select(MD.page_of({"one": F.lit("x"), "many": [F.lit(v) for v in values]}, F.lit(""), {"S": F.lit("b")}).alias("p"))
    text = rows.select(MD.write_page(F.col("p")).alias("t")).first()["t"]
    assert yaml.safe_load(text.split("---\n")[1])["many"] == values
    assert {f["key"]: f["values"] for f in read(spark, text)[0]["facts"]} == {"one": ["x"], "many": values}


#: Texts that look like pages, from pieces that mean something to a reader.
PIECES = st.lists(st.sampled_from(["---\n", "key: ", "a", " ", "\n", "- ", "## H\n", "### P\n", "'", '"', "\\", "[", "]", ",", ": ", "#", "é", "|", "\r\n", "\t", "{", "null"]), max_size=24).map("".join)


@settings(max_examples=5, deadline=None)
@given(st.lists(PIECES, min_size=60, max_size=60))
def test_reading_and_writing_are_inverse(spark, texts):
    rows = spark.createDataFrame([(t,) for t in texts] + [("---\n" + t + "\n---\n" + t,) for t in texts], "t string")
    once = rows.select("t", MD.read_page(F.col("t")).alias("p"))
    got = once.select("t", "p", MD.read_page(MD.write_page(F.col("p"))).alias("q")).collect()
    assert [(r["t"], r["p"]) for r in got] == [(r["t"], r["q"]) for r in got]


def test_each_page_is_read_once(spark):
    """Neither a null check nor a filter that is inferred from explode() makes a page anew."""
    import __spark_entry__

    from .conftest import SF

    plan = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    spark.conf.set("spark.sql.maxPlanStringLength", 1 << 30)
    try:
        rows = spark.createDataFrame([(1, "a")], "i long, t string")
        assert plan(rows.repartition(2).select(MD.read_page(F.reverse("t")).alias("p"))).count("reverse(") == 1
        assert plan(__spark_entry__.queries()["page_outline"](spark, SF)).count(r"\r\n?") == 1
    finally:
        spark.conf.unset("spark.sql.maxPlanStringLength")
