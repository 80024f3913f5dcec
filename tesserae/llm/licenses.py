"""Licence scans by sentence rules, in DataFrame functions alone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import col, table

#: Known sentences, lower case and without punctuation, by identifier.
SENTENCES: dict[str, tuple[str, ...]] = {
    "mit-ref": ("released under the mit license", "licensed under the mit license", "this project is licensed under the mit license", "distributed under the mit license"),
    "mit-grant": ("permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions",),
    "keep-notice": ("the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software",),
    "as-is": ("the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement",),
    "apache-2-ref": ("licensed under the apache license version 2 0", "licensed under the apache license version 2 0 the license", "released under the apache license version 2 0"),
    "apache-comply": ("you may not use this file except in compliance with the license",),
    "gpl-3-ref": ("this work is licensed under the gnu general public license version 3", "licensed under the gnu general public license version 3", "released under the gnu general public license version 3"),
    "gpl-free": ("this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version",),
    "gpl-2-free": ("this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version",),
    "agpl-free": ("this program is free software you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation either version 3 of the license or at your option any later version",),
    "lgpl-3-free": ("this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 3 of the license or at your option any later version", "this program is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 3 of the license or at your option any later version"),
    "lgpl-2-1-free": ("this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 2 1 of the license or at your option any later version",),
    "lgpl-nowarranty": ("this library is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose",),
    "epl-2-ref": ("this program and the accompanying materials are made available under the terms of the eclipse public license 2 0 which is available at https www eclipse org legal epl 2 0",),
    "gpl-nowarranty": ("this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose",),
    "lgpl-ref": ("licensed under the gnu lesser general public license version 3",),
    "cc-by-nc-ref": ("licensed under cc by nc 4 0", "this work is licensed under cc by nc 4 0", "this work is licensed under a creative commons attribution noncommercial 4 0 international license"),
    "cc-by-sa-ref": ("licensed under cc by sa 4 0", "this work is licensed under a creative commons attribution sharealike 4 0 international license"),
    "cc-by-ref": ("licensed under cc by 4 0", "this work is licensed under a creative commons attribution 4 0 international license"),
    "cc0-ref": ("released under cc0 1 0", "licensed under cc0 1 0", "this work is dedicated to the public domain under the cc0 1 0 license"),
    "bsd-head": ("redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",),
    "bsd-source": ("redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer",),
    "bsd-binary": ("redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution",),
    "bsd-endorse": ("neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",),
    "isc-grant": ("permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies",),
    "mpl-2-ref": ("this source code form is subject to the terms of the mozilla public license v 2 0",),
    "unlicense": ("this is free and unencumbered software released into the public domain",),
    "reserved": ("all rights reserved copyright",),
}
#: Rules in the order in which they are tried; each takes its identifiers, in a row, out of the sequence.
RULES: tuple[tuple[str, tuple[str, ...]], ...] = (
    ("MIT", ("mit-grant", "keep-notice", "as-is")),
    ("MIT", ("mit-grant", "keep-notice")),
    ("BSD-3-Clause", ("bsd-head", "bsd-source", "bsd-binary", "bsd-endorse")),
    ("BSD-2-Clause", ("bsd-head", "bsd-source", "bsd-binary")),
    ("AGPL-3.0-or-later", ("agpl-free", "gpl-nowarranty")),
    ("LGPL-3.0-or-later", ("lgpl-3-free", "lgpl-nowarranty")),
    ("LGPL-3.0-or-later", ("lgpl-3-free", "gpl-nowarranty")),
    ("LGPL-2.1-or-later", ("lgpl-2-1-free", "lgpl-nowarranty")),
    ("GPL-3.0-or-later", ("gpl-free", "gpl-nowarranty")),
    ("GPL-2.0-or-later", ("gpl-2-free", "gpl-nowarranty")),
    ("AGPL-3.0-or-later", ("agpl-free",)),
    ("LGPL-3.0-or-later", ("lgpl-3-free",)),
    ("LGPL-2.1-or-later", ("lgpl-2-1-free",)),
    ("GPL-3.0-or-later", ("gpl-free",)),
    ("GPL-2.0-or-later", ("gpl-2-free",)),
    ("Apache-2.0", ("apache-2-ref", "apache-comply")),
    ("Apache-2.0", ("apache-2-ref",)),
    ("MIT", ("mit-ref",)),
    ("GPL-3.0-only", ("gpl-3-ref",)),
    ("LGPL-3.0-only", ("lgpl-ref",)),
    ("CC-BY-NC-4.0", ("cc-by-nc-ref",)),
    ("CC-BY-SA-4.0", ("cc-by-sa-ref",)),
    ("CC-BY-4.0", ("cc-by-ref",)),
    ("CC0-1.0", ("cc0-ref",)),
    ("ISC", ("isc-grant",)),
    ("MPL-2.0", ("mpl-2-ref",)),
    ("EPL-2.0", ("epl-2-ref",)),
    ("Unlicense", ("unlicense",)),
)
#: Every known sentence holds one of these; what holds none is not looked at further.
ANCHORS = "licen|copyright|permission|warrant|redistribut|software|cc0"
_OTHER = "[^a-z0-9]+"
#: Where a text ends a sentence, but not within "v. 2"; and where what is not known as a whole is cut further, in turn.
_STOP, _PARAGRAPH, _CLAUSE, _LINE = r"(?:\.(?!(?<=\bv\.)[ \t\r\n]+[0-9])|[!?])[ \t\r\n]+", r"\n[ \t\r]*\n", r"[;:][ \t\r\n]+", r"\n"


def _patterns(sequence: tuple[str, ...]) -> str:
    return "".join(f"<{x}>" for x in sequence)


def _identifiers(text: Column) -> Column:
    """The identifiers of the known sentences of a text, in their order, as one string."""
    known = F.create_map(*[F.lit(x) for name, texts in SENTENCES.items() for t in texts for x in (t, f"<{name}>")])

    def within(s: Column, cuts: tuple[str, ...]) -> Column:
        near = F.filter(F.split(s, cuts[0]), lambda x: x.rlike(ANCHORS))
        return F.array_join(F.transform(near, lambda x: found(x, cuts[1:])), "")

    def found(s: Column, cuts: tuple[str, ...]) -> Column:
        whole = F.try_element_at(known, F.trim(F.regexp_replace(s, _OTHER, " ")))
        return F.coalesce(whole, within(s, cuts) if cuts else F.lit(""))

    def sentence(s: Column) -> Column:
        whole = F.try_element_at(known, F.trim(F.regexp_replace(s, _OTHER, " ")))
        return F.coalesce(whole, F.nullif(within(s, (_PARAGRAPH, _CLAUSE, _LINE)), F.lit("")), within(s, (_CLAUSE, _LINE)))

    return F.array_join(F.transform(F.filter(F.split(text, _STOP), lambda x: x.rlike(ANCHORS)), sentence), "")


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Recognises licences in each text.

    A text, lower-cased, is cut into sentences after . ! or ?, which may run over lines; what is not known as a whole is cut
    at blank lines, then after ; or : and then at newlines, until it is known. So each place of a text is read in the way that fits
    it. Sentences, reduced to letters a-z, digits and single blanks, are mapped to identifiers, and the rules are tried on the
    sequence in their order.

    Returns id_col, licenses (names in the order of the rules, each once, joined by commas), sentences (the sequence) and rest
    (what no rule took), a row for each row of docs. A null or empty text, or one without a known sentence, has empty strings;
    null and repeated ids are kept as they are; an empty table gives an empty one; other columns are ignored. No row is shuffled.
    """
    text = F.lower(F.coalesce(col(text_col), F.lit("")))
    rows = docs.select(col(id_col).alias(id_col), F.when(text.rlike(ANCHORS), _identifiers(text)).otherwise("").alias("sentences"))
    rules = F.array(*[F.struct(F.lit(_patterns(s)).alias("take"), F.lit(name).alias("name")) for name, s in RULES])
    start = F.struct(F.col("sentences").alias("rest"), F.array().cast("array<string>").alias("found"))
    tried = F.aggregate(rules, start, lambda a, r: F.struct(F.replace(a["rest"], r["take"], F.lit("")).alias("rest"), F.when(F.contains(a["rest"], r["take"]), F.array_append(a["found"], r["name"])).otherwise(a["found"]).alias("found")))
    tried = F.when(F.col("sentences") != "", tried)
    return rows.withColumn("_tried", tried).select(id_col, F.coalesce(F.array_join(F.array_distinct(F.col("_tried.found")), ","), F.lit("")).alias("licenses"), "sentences", F.coalesce("_tried.rest", F.lit("")).alias("rest"))


def op5_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"))


def op5_sql() -> str:
    """The same scan for DuckDB, its rules unrolled."""
    keys = ", ".join(f"'{t}'" for texts in SENTENCES.values() for t in texts)
    values = ", ".join(f"'<{name}>'" for name, texts in SENTENCES.items() for _ in texts)
    known = lambda x: f"m[trim(regexp_replace({x}, '{_OTHER}', ' ', 'g'))]"

    def within(x: str, *cuts: str) -> str:
        depth = len(cuts)
        inner = f"coalesce({known(f'x{depth}')}, {within(f'x{depth}', *cuts[1:])})" if depth > 1 else f"coalesce({known('x1')}, '')"
        near = f"list_filter(string_split_regex({x}, '{cuts[0]}'), lambda y{depth}: regexp_matches(y{depth}, '{ANCHORS}'))"
        return f"coalesce(list_aggregate(list_transform({near}, lambda x{depth}: {inner}), 'string_agg', ''), '')"

    # "v. 2" is no end of a sentence: its full stop is taken out first, and is no letter or digit anyway
    parts = r"string_split_regex(regexp_replace(x, '\bv\.([ \t\r\n]+[0-9])', 'v \1', 'g'), '[.!?][ \t\r\n]+')"
    sentence = f"coalesce({known('s')}, nullif({within('s', _PARAGRAPH, _CLAUSE, _LINE)}, ''), {within('s', _CLAUSE, _LINE)})"
    steps, rest, found = [], "sentences", []
    for i, (name, sequence) in enumerate(RULES):
        steps.append(f"s{i} AS (SELECT *, contains({rest}, '{_patterns(sequence)}') AS f{i}, replace({rest}, '{_patterns(sequence)}', '') AS r{i} FROM {f's{i - 1}' if i else 'chosen'})")
        found.append((i, name))
        rest = f"r{i}"
    first: dict[str, list[int]] = {}
    for i, name in found:
        first.setdefault(name, []).append(i)
    # a name stands where its first rule that matched stands
    items = ", ".join(f"CASE WHEN f{i}" + "".join(f" AND NOT f{j}" for j in first[name] if j < i) + f" THEN '{name}' END" for i, name in found)
    return rf"""
WITH t AS (SELECT doc_id, row_number() OVER () AS n, lower(coalesce(text, '')) AS x FROM documents),
p AS (SELECT n, unnest({parts}) AS s, unnest(range(len({parts}))) AS i FROM t WHERE regexp_matches(x, '{ANCHORS}')),
q AS (SELECT n, i, {sentence} AS v FROM p, (SELECT map([{keys}], [{values}]) AS m) WHERE regexp_matches(s, '{ANCHORS}')),
chosen AS (SELECT t.doc_id, coalesce(q.ids, '') AS sentences FROM t LEFT JOIN (SELECT n, string_agg(v, '' ORDER BY i) AS ids FROM q GROUP BY n) q ON q.n = t.n),
{", ".join(steps)}
SELECT doc_id, concat_ws(',', {items}) AS licenses, sentences, {rest} AS rest FROM s{len(RULES) - 1}
"""
