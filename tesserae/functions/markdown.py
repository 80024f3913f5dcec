"""Markdown pages as columns: read into frontmatter and an outline of two levels, edited, and written again.

A page is a struct of

* facts, the frontmatter in its order: key, form and values. form is "text" (one value, or none where nothing stands), "list", or "raw": what this reader
  does not take apart (nested mappings, block scalars, anchors, comments beside values) is kept as it stands, key included, and written back so. Frontmatter
  with a line that is no entry is one raw fact without a key. Values are texts; whether a number or date stood in quotes is not kept.
* preamble, what stands before the first heading of level two,
* sections: name and body, the lines below a heading as they stand but for white space at the end.

write_page() and read_page() are inverse on what read_page() gives. A null text is a null page, an empty one a page of nothing. Of a key or a heading that
occurs twice, the last fact and the first section count. Headings in fenced code are headings. Edits nest deeply in a plan: give each its own withColumn().
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import strip

FACTS = "array<struct<key:string,form:string,values:array<string>>>"
SECTIONS = "array<struct<name:string,body:string>>"

_FRONT = r"\A---[ \t]*\n((?s:.*?\n)?)---[ \t]*(?:\n|\z)"
_KEY = r"""\A("[^"\n\\]*"|'[^'\n]*'|[^\s:#"'\[\]{}&*!|>%@`,?\-][^:\n]*):(?=\s|\z)"""


def _no_texts() -> Column:
    return F.array().cast("array<string>")


def _let(c: Column, f) -> Column:
    """f of a column that is evaluated once, and stands in the plan once, however often f uses it."""
    return F.transform(F.array(c), f)[0]


def _unquote(c: Column) -> Column:
    """What a scalar says, over one line or several; null where it is not one that this reader takes apart."""
    folded = F.regexp_replace(F.regexp_replace(c, r"(?<!\\)\\\n[ \t]*\\?", ""), r"[ \t]*\n[ \t]*", " ")
    return F.when(~c.rlike(r"\n[ \t]*\n"), _let(folded, _unfolded))


def _unfolded(c: Column) -> Column:
    double = _let(F.from_json(F.concat(F.lit("["), c, F.lit("]")), "array<string>", {"allowSingleQuotes": "false"}), lambda v: F.when(F.endswith(c, F.lit('"')) & (F.size(v) == 1), v[0]))
    inner = F.replace(F.substring(c, F.lit(2), F.length(c) - 2), F.lit("''"), F.lit("\0"))
    single = _let(inner, lambda v: F.when((F.length(c) > 1) & F.endswith(c, F.lit("'")) & ~F.contains(v, F.lit("'")), F.replace(v, F.lit("\0"), F.lit("'"))))
    plain = F.when(~c.rlike(r"\A[\[\]{}&*!|>%@`,#]|\A[-?](?:\s|\z)|:\s|:\z|\s#"), c)
    return F.when(F.startswith(c, F.lit('"')), double).when(F.startswith(c, F.lit("'")), single).otherwise(plain)


def _flow(c: Column) -> Column:
    """The items of a list in brackets, or null."""
    return _let(F.trim(F.substring(c, F.lit(2), F.length(c) - 2)), lambda inner: _items(c, inner))


def _items(c: Column, inner: Column) -> Column:
    quoted = F.contains(inner, F.lit('"'))
    items = F.transform(F.split(inner, ","), lambda x: F.trim(x))
    texts = F.when(quoted, F.from_json(c, "array<string>", {"allowSingleQuotes": "false"})).otherwise(F.transform(items, _unquote))
    return F.when(~F.endswith(c, F.lit("]")) | F.contains(inner, F.lit("'")) | inner.rlike(r"[\[\]{}\n]"), None).when(inner == "", _no_texts()).otherwise(texts)


def _fact(chunk: Column) -> Column:
    key = F.regexp_replace(F.regexp_replace(F.regexp_extract(chunk, _KEY, 1), r"\s+\z", ""), r"""\A(["'])(.*)\1\z""", "$2")
    return _let(F.regexp_replace(chunk, _KEY, ""), lambda rest: _let(_valued(rest), lambda v: F.struct(
        key.alias("key"), F.when(v["values"].isNull(), "raw").otherwise(v["form"]).alias("form"), F.coalesce(v["values"], F.array(chunk)).alias("values"))))


def _valued(rest: Column) -> Column:
    """The form and the values of what follows a key; null values where it is not taken apart."""
    indent = F.regexp_extract(rest, r"\A[ \t]*\n( *)-(?:\s|\z)", 1)
    items = F.split(F.regexp_replace(rest, r"\A[ \t]*", ""), F.concat(F.lit("\n"), indent, F.lit(r"-(?=\s|\z)")))
    block = F.transform(F.slice(items, 2, 1 << 30), lambda x: _let(strip(x), _unquote))
    one = lambda said: F.when(said.isin("", "~", "null", "Null", "NULL"), _no_texts()).otherwise(F.array(_unquote(said)))
    form = lambda name, values: F.struct(F.lit(name).alias("form"), _let(values, lambda v: F.when(~F.exists(v, lambda x: x.isNull()), v)).alias("values"))
    inline = lambda said: F.when(F.startswith(said, F.lit("[")), form("list", _flow(said))).otherwise(form("text", one(said)))
    return F.when(rest.rlike(r"\A[ \t]*\n *-(?:\s|\z)"), form("list", block)).otherwise(_let(strip(rest), inline))


def read_facts(front: Column) -> Column:
    """The facts of what stands between the marks of a frontmatter."""
    lines = F.regexp_replace(front, r"(?m)^#.*(?:\n|\z)", "")
    chunks = F.filter(F.transform(F.split(lines, r"\n(?=[^\s\-#])"), lambda x: F.regexp_replace(x, r"\s+\z|\A\n+", "")), lambda x: x != "")
    unread = F.array(F.struct(F.lit(None).cast("string").alias("key"), F.lit("raw").alias("form"), F.array(F.regexp_replace(front, r"\n+\z", "")).alias("values")))
    return _let(chunks, lambda z: F.when(F.exists(z, lambda x: ~x.rlike(_KEY)), unread).otherwise(F.transform(z, _fact)))


def _cut(text: Column, marks: str) -> Column:
    """What stands before the first heading with these marks, then each heading with what is below it."""
    return F.split(F.concat(F.lit("\n"), text), rf"\n{marks}[ \t]+(?=\S)")


def _below(chunk: Column) -> Column:
    name = F.regexp_replace(F.substring_index(chunk, "\n", 1), r"\s+\z", "")
    return F.struct(name.alias("name"), F.regexp_replace(F.regexp_replace(chunk, r"\A[^\n]*\n?", ""), r"\s+\z", "").alias("body"))


def read_page(text: Column) -> Column:
    """The page of a text; line ends of other systems are read as \\n."""
    facts = lambda t: F.when(t.rlike(_FRONT), _let(F.regexp_extract(t, _FRONT, 1), read_facts)).otherwise(F.array().cast(FACTS))
    outline = lambda t, cut: F.struct(facts(t).alias("facts"), F.regexp_replace(cut[0], r"\A\n+|\s+\z", "").alias("preamble"), F.transform(F.slice(cut, 2, 1 << 30), _below).alias("sections"))
    page = lambda t: _let(_cut(F.regexp_replace(t, _FRONT, ""), "##"), lambda cut: outline(t, cut))
    return _let(F.regexp_replace(text, r"\r\n?", "\n"), lambda t: F.when(t.isNotNull(), page(t)))  # the text is made once


def _scalar(c: Column) -> Column:
    """A value as it is written: plain where that reads the same, else in double quotes."""
    risky = c.rlike(r"""\A[\s\-?:,\[\]{}#&*!|>'"%@`]|\s\z|:\s|:\z|\s#|[\x00-\x1F\x7F]""") | c.isin("", "~", "null", "Null", "NULL")
    quoted = F.to_json(F.array(c))
    return F.when(risky, F.substring(quoted, F.lit(2), F.length(quoted) - 2)).otherwise(c)


def write_facts(facts: Column) -> Column:
    """The lines of a frontmatter, without its marks."""

    def line(f: Column) -> Column:
        mark = F.when(F.contains(f["key"], F.lit("'")), '"').otherwise("'")
        key = F.when(F.concat(f["key"], F.lit(":")).rlike(_KEY) & ~f["key"].rlike(r"\s\z"), f["key"]).otherwise(F.concat(mark, f["key"], mark))
        items = F.array_join(F.transform(f["values"], lambda v: F.concat(F.lit("\n- "), _scalar(v))), "")
        text = F.when(F.size(f["values"]) > 0, F.concat(F.lit(" "), _scalar(F.element_at(f["values"], 1)))).otherwise("")
        rest = F.when(f["form"] == "text", text).when(F.size(f["values"]) == 0, " []").otherwise(items)
        return F.when(f["form"] == "raw", f["values"][0]).otherwise(F.concat(key, F.lit(":"), rest))

    return F.array_join(F.transform(facts, line), "\n")


def write_page(page: Column) -> Column:
    """The text of a page: blocks with an empty line between them, and one line end at the end."""
    return _let(page, lambda p: F.when(p.isNotNull(), _let(_blocks(p), lambda b: F.when(F.size(b) > 0, F.array_join(b, "\n")).otherwise("\n"))))


def _blocks(page: Column) -> Column:
    front = F.when(F.size(page["facts"]) > 0, F.concat(F.lit("---\n"), write_facts(page["facts"]), F.lit("\n---\n")))
    said = lambda c: F.when(c != "", F.concat(c, F.lit("\n"))).otherwise("")
    sections = F.transform(page["sections"], lambda s: F.concat(F.lit("## "), s["name"], F.lit("\n"), said(s["body"])))
    apart = F.when(front.isNull() & F.startswith(page["preamble"], F.lit("---")), "\n").otherwise("")  # else it would be read as frontmatter
    return F.filter(F.concat(F.array(F.coalesce(front, F.lit("")), F.concat(apart, said(page["preamble"]))), sections), lambda b: b != "")


def page_of(facts: dict[str, Column], preamble: Column, sections: dict[str, Column]) -> Column:
    """A new page: a fact for each text or array of texts, and a section for each body that is not null."""
    entries = [F.struct(F.lit(k).alias("key"), F.lit(form).alias("form"), values.alias("values")) for k, form, values in map(_entry, facts.items())]
    bodies = [F.when(body.isNotNull(), F.struct(F.lit(n).alias("name"), _body(body).alias("body"))) for n, body in sections.items()]
    listed = F.filter(F.array(*bodies), lambda s: s.isNotNull()) if bodies else F.array()
    return F.struct(F.array(*entries).cast(FACTS).alias("facts"), F.coalesce(preamble, F.lit("")).alias("preamble"), listed.cast(SECTIONS).alias("sections"))


def _entry(fact: tuple[str, Column | list[Column]]) -> tuple[str, str, Column]:
    key, value = fact
    if isinstance(value, list):
        return key, "list", F.array_compact(F.array(*value)) if value else _no_texts()
    return key, "text", F.array_compact(F.array(value.cast("string")))


def _body(text: Column) -> Column:
    """A body that write_page() sets apart from its heading."""
    return _let(F.regexp_replace(text, r"\A\n+|\s+\z", ""), lambda said: F.when(said == "", said).otherwise(F.concat(F.lit("\n"), said)))


def fact(page: Column, key: str) -> Column:
    """The values of a fact, or null where there is none or it was not taken apart."""
    of = F.filter(page["facts"], lambda f: (f["key"] == key) & (f["form"] != "raw"))
    return _let(of, lambda z: F.when(F.size(z) > 0, F.element_at(z, -1)["values"]))


def section(page: Column, name: str) -> Column:
    """The body of a section without white space around it, or null."""
    of = F.filter(page["sections"], lambda s: s["name"] == name)
    return _let(of, lambda z: F.when(F.size(z) > 0, strip(z[0]["body"])))


def _put(items: Column, name: str, body: Column) -> Column:
    """items with this body in the first of the name, or one more at the end."""
    at = F.array_position(F.transform(items, lambda s: F.coalesce(s["name"], F.lit(""))), F.lit(name))
    new = F.struct(F.lit(name).alias("name"), body.alias("body"))
    return _let(at, lambda k: F.when(k > 0, F.transform(items, lambda s, i: F.when(i + 1 == k, new).otherwise(s))).otherwise(F.concat(items, F.array(new))))


def with_section(page: Column, name: str, body: Column) -> Column:
    """page with this body in place of the section's, the section at the end if there was none; a null body changes nothing."""
    put = lambda p, text: F.when(text.isNull() | p.isNull(), p).otherwise(_page(p["facts"], p["preamble"], _put(p["sections"], name, text)))
    return _let(page, lambda p: _let(_body(body), lambda text: put(p, text)))


def _page(facts: Column, preamble: Column, sections: Column) -> Column:
    return F.struct(facts.alias("facts"), preamble.alias("preamble"), sections.alias("sections"))


def split_parts(body: Column) -> Column:
    """A section's body by its headings of level three: name and body, first what stands before them, of which the name is null."""
    first = lambda cut: F.struct(F.lit(None).cast("string").alias("name"), F.regexp_replace(cut[0], r"\A\n+|\s+\z", "").alias("body"))
    return _let(_cut(body, "###"), lambda cut: F.concat(F.array(first(cut)), F.transform(F.slice(cut, 2, 1 << 30), _below)))


def join_parts(parts: Column) -> Column:
    """The body of parts, an empty line between them."""
    below = lambda p: F.when(p["body"] != "", F.concat(F.lit("\n"), p["body"])).otherwise("")
    blocks = F.transform(parts, lambda p: F.when(p["name"].isNull(), p["body"]).otherwise(F.concat(F.lit("### "), p["name"], below(p))))
    return F.array_join(F.filter(blocks, lambda b: b != ""), "\n\n")


def with_part(page: Column, name: str, part: str, body: Column) -> Column:
    """page with this body in a part of a section; both are made where they are missing."""
    put = lambda p: _let(split_parts(F.coalesce(section(p, name), F.lit(""))), lambda parts: join_parts(_put(parts, part, _body(body))))
    return _let(page, lambda p: with_section(p, name, F.when(body.isNotNull(), put(p))))


def add_unique(page: Column, key: str, value: Column) -> Column:
    """page with a value in the list of a fact unless it holds it; a text becomes a list of itself, a missing fact a list of the value. A raw fact, and a null value, are left alone."""
    added = lambda f: F.when(F.array_contains(f["values"], value), f["values"]).otherwise(F.concat(f["values"], F.array(value)))
    listed = lambda f: F.struct(f["key"].alias("key"), F.lit("list").alias("form"), added(f).alias("values"))
    put = lambda facts: F.transform(facts, lambda f: F.when((f["key"] == key) & (f["form"] != "raw"), listed(f)).otherwise(f))
    new = F.array(F.struct(F.lit(key).alias("key"), F.lit("list").alias("form"), F.array(value).alias("values")))
    has = lambda facts: F.exists(facts, lambda f: F.coalesce(f["key"] == key, F.lit(False)))
    facts = lambda z: F.when(has(z), put(z)).otherwise(F.concat(z, new))
    return _let(page, lambda p: F.when(value.isNull() | p.isNull(), p).otherwise(_page(_let(p["facts"], facts), p["preamble"], p["sections"])))
