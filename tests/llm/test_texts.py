"""Operators on texts against plain versions of themselves."""

import collections
import hashlib
import zlib

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tesserae.llm import idfiles, licenses, lines, packing, prefixes, simhash, substrings, syncmers
from tesserae.llm.common import new_folder
from tesserae.llm.encoding import Encoder, vocabulary_path

SENTENCES_OF = licenses.SENTENCES
NAMES = ["byte_bpe_50k.json", "word_bpe_49k.json"]


def bag(rows):
    return collections.Counter(rows)


@pytest.mark.parametrize("name", NAMES)
def test_encoding_is_the_librarys(name):
    whole, own = Tokenizer.from_file(vocabulary_path(name)), Encoder(vocabulary_path(name), 50)

    @settings(max_examples=400, deadline=None)
    @given(st.one_of(st.text(alphabet=[chr(i) for i in range(256)], max_size=40), st.text(max_size=20), st.text(alphabet="aA 's\n\t1.é<|endoftext|>", max_size=40)))
    def same(text):
        assert np.frombuffer(own.ids(text), np.uint32).tolist() == whole.encode(text, add_special_tokens=False).ids

    same()


def test_substring_dedup(docs, all_rows, none):
    window = 12
    words = [(i, (t or "").encode().split()) for i, t in all_rows]
    seen = collections.Counter(b" ".join(w[j : j + window]) for _, w in words for j in range(len(w) - window + 1))
    want = []
    for i, w in words:
        gone = [False] * len(w)
        for j in range(len(w) - window + 1):
            if seen[b" ".join(w[j : j + window])] > 1:
                gone[j : j + window] = [True] * window
        want.append((i, len(w), sum(gone), b" ".join(x for x, g in zip(w, gone, strict=True) if not g).decode()))
    got = substrings.substring_dedup(docs, window=window, first=3)
    assert bag(map(tuple, got.collect())) == bag(want)
    assert sum(w[2] for w in want) > 100
    assert substrings.substring_dedup(none, window=window).collect() == []


def test_substring_dedup_of_one_word(spark):
    df = spark.createDataFrame([(1, "a " * 50), (2, "a " * 34), (3, "b " * 35)], "doc_id long, text string")
    got = {r["doc_id"]: r["n_removed"] for r in substrings.substring_dedup(df).collect()}
    assert got == {1: 50, 2: 0, 3: 0}  # a window that starts twice in one text; too short; once


def line_rule(rows):
    """Each line against all earlier ones."""
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    before, out = [], []
    for i, t in order:
        left = []
        for line in (t or "").split("\n"):
            w = set(line.encode().split())
            if not w or not any(9 * len(w & x) >= 4 * (len(w) + len(x)) for x in before):
                left.append(line)
            if w:
                before.append(w)
        out.append((i, (t or "").count("\n") + 1, (t or "").count("\n") + 1 - len(left), "\n".join(left)))
    return out


def test_line_dedup(docs, all_rows, none):
    got = lines.line_dedup(docs).select("doc_id", "n_lines", "n_removed", "text")
    want = line_rule(all_rows)
    assert bag(map(tuple, got.collect())) == bag(want)
    assert sum(w[2] for w in want) > 5
    assert lines.line_dedup(none).collect() == []
    kept = lines.dedup_documents(docs)
    assert kept.columns == docs.columns and kept.where("doc_id is null").count() == 1


def test_dedup_documents_keeps_a_copy_of_every_line(spark):
    old = [f"old{i} a{i} b{i} c{i} d{i}" for i in range(30)]
    new = "a new passage that later documents share"
    rows = [(1, "\n".join(old)), (2, "\n".join([*old, new])), (3, f"{new}\nits own line here"), (4, "\n".join(old[:9]))]
    got = {r["doc_id"]: r["text"] for r in lines.dedup_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: rows[0][1], 2: new, 3: "its own line here"}


def test_line_dedup_of_many_near_lines(spark, monkeypatch):
    monkeypatch.setattr(lines, "RUN", 40)  # crowded tokens are dealt over pairs of blocks
    base = [f"w{i}" for i in range(10)]
    rows = [(i, " ".join([*base[: i % 10], f"x{i}", *base[i % 10 + 1 :]])) for i in range(150)] + [(200, " ".join(base))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = lines.line_dedup(df).select("doc_id", "n_lines", "n_removed", "text")
    assert bag(map(tuple, got.collect())) == bag(line_rule(rows))


def test_lines_whose_words_share_forty_bits_stay(spark):
    given_ = ["x1428028", "x3772239", "x2924678", "x2866954", "x1428028", "a b c x1428028 x3772239", "a b c x3772239"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(given_)], "doc_id long, text string")
    got = {r["doc_id"]: r["n_removed"] for r in lines.line_dedup(df).collect()}
    assert got == {0: 0, 1: 0, 2: 0, 3: 0, 4: 1, 5: 0, 6: 1}


def test_line_dedup_of_equal_ids(spark):
    """Lines of equal ids are in the order of a hash of their texts, whichever row comes first."""
    texts = ["a b c d e\nu v w x y", "a b c d e f\nq", "a b c d e f g"]
    for order in (texts, texts[::-1]):
        df = spark.createDataFrame([(1, t) for t in order], "doc_id long, text string")
        ties = {r["text"]: r["tie"] for r in df.select("text", F.expr("cast(shiftright(xxhash64(text), 32) as int) as tie")).collect()}
        got = {r["n_lines"] * 10 + len(r["text"]) for r in lines.line_dedup(df).collect()}
        want = {r[1] * 10 + len(r[3]) for r in line_rule([(ties[t], t) for t in texts])}
        assert got == want


def test_meet_loses_nothing():
    """Against all pairs of random sets that meet on the first token that they share."""
    rng = np.random.default_rng(1)
    sets = [np.sort(rng.choice(26, rng.integers(4, 14), replace=False)) for _ in range(260)]
    rows = [(t, i, pos, len(s), sum(1 << int(x) for x in s)) for i, s in enumerate(sets) for pos, t in enumerate(s) if pos < lines.prefix(np.array([len(s)]))[0]]
    rows.sort()
    run, i, pos, n, bits = (np.array(c) for c in zip(*rows, strict=True))
    bits = bits.astype(np.uint64)
    want = {(a, b) for a in range(len(sets)) for b in range(a) if 9 * len(np.intersect1d(sets[a], sets[b])) >= 4 * (len(sets[a]) + len(sets[b]))}
    y, x, _ = prefixes.meet(n, pos, run, 0.8, None, (bits,))
    assert want and set(zip(i[y].tolist(), i[x].tolist(), strict=True)) >= want
    ky, kx, more = prefixes.meet(n, pos, run, 0.8, 1, (bits,))
    full, some = collections.Counter(y.tolist()), collections.Counter(ky.tolist())
    assert all(some[r] >= 1 and (some[r] == c or more[r]) for r, c in full.items())
    asks = more & (rng.random(len(n)) < 0.5)
    ay, _, _ = prefixes.meet(n, pos, run, 0.8, None, (bits,), asks=asks)
    assert collections.Counter(ay.tolist()) == {r: c for r, c in full.items() if asks[r]}


def plain_mark(text, size):
    import re

    import xxhash

    w = re.findall(rb"[^\x20\x09-\x0d]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode()))
    got = [b" ".join(w[i : i + size]) for i in range(len(w) - size + 1)] or ([b" ".join(w)] if w else [])
    h = [xxhash.xxh64_intdigest(x, 42) for x in got]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_simhash(docs, all_rows, none):
    marks = [(i, plain_mark(t, 3)) for i, t in all_rows]
    group = list(range(len(marks)))
    for a in range(len(marks)):
        for b in range(a):
            if (marks[a][1] ^ marks[b][1]).bit_count() <= 2:
                group = [group[b] if g == group[a] else g for g in group]
    least = {g: min((i for (i, _), h in zip(marks, group, strict=True) if h == g and i is not None), default=None) for g in group}
    want = bag((i, format(m, "016x"), least[g]) for (i, m), g in zip(marks, group, strict=True))
    assert bag(map(tuple, simhash.simhash_components(docs).collect())) == want
    assert simhash.simhash_components(none).collect() == []


def test_links_find_every_pair_in_radius(spark):
    rng = np.random.default_rng(3)
    seeds = rng.integers(0, 2**62, 20).tolist()
    marks = sorted({s ^ (1 << int(a)) ^ (1 << int(b)) for s in seeds for a, b in rng.integers(0, 62, (12, 2))} | set(seeds))
    got = simhash.links(spark.createDataFrame([(m,) for m in marks], "_mark long"), 2).collect()
    parent = {m: m for m in marks}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for r in got:
        assert (r["a"] ^ r["b"]).bit_count() <= 2
        parent[top(r["a"])] = top(r["b"])
    assert all(top(a) == top(b) for a in marks for b in marks if (a ^ b).bit_count() <= 2)


def test_one_of_each(docs, all_rows, none):
    kept = simhash.one_of_each(docs)
    ids = bag(r["doc_id"] for r in kept.collect())
    assert kept.columns == docs.columns and max(ids.values()) == 1
    shingled = [set(simhash.shingles(t or "", 5)) for _, t in all_rows]
    for (i, _), s in zip(all_rows, shingled, strict=True):
        if i not in ids:  # what goes is like something smaller
            assert any(j is not None and (i is None or j <= i) and (s == x or len(s & x) >= 0.8 * len(s | x)) for (j, _), x in zip(all_rows, shingled, strict=True))
        else:
            assert not any(j in ids and j != i and s == x and s for (j, _), x in zip(all_rows, shingled, strict=True))
    assert simhash.one_of_each(none).collect() == []


def brute_groups(texts, size=5, least=0.8):
    """Pairs of texts that are alike, and each text's group by comparing all with all."""
    sets = [set(simhash.shingles(t, size)) for t in texts]
    alike = [(a, b) for a in range(len(texts)) for b in range(a) if len(sets[a] & sets[b]) >= least * len(sets[a] | sets[b]) > 0]
    group = list(range(len(texts)))
    for a, b in alike:
        if group[a] != group[b]:
            group = [group[b] if g == group[a] else g for g in group]
    return alike, group


def groups_of(spark, texts):
    got = {}
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    named = df.select("doc_id", F.xxhash64("text").alias("_text_hash")).join(simhash.similar_groups(df), "_text_hash").collect()
    for r in named:
        got.setdefault(r["_group"], set()).add(r["doc_id"])
    return {frozenset(g) for g in got.values()}


def sets_of(group):
    return {frozenset(s) for s in ([i for i, g in enumerate(group) if g == k] for k in set(group)) if len(s) > 1}


def test_similar_groups_find_every_pair_at_the_limit(spark):
    rng = np.random.default_rng(11)
    texts = []
    for n in rng.integers(60, 600, 150).tolist():  # pairs at 0.80 to 0.83: the first so many shingles are shared
        j = float(rng.uniform(0.80, 0.83))
        words = [f"w{x}" for x in rng.integers(0, 10**9, n + 4)]
        shared = int(np.ceil(2 * n * j / (1 + j)))
        texts += [" ".join(words), " ".join([*words[: shared + 4], *[f"v{x}" for x in rng.integers(0, 10**9, n - shared)]])]
    texts += ["a b", "A  b", "one two three four five six", "", " "]
    alike, group = brute_groups(texts)
    assert len(alike) > 150
    assert groups_of(spark, texts) == sets_of(group)


def test_similar_groups_of_texts_that_share_nothing(spark):
    assert groups_of(spark, [" ".join(f"w{i}x{j}" for j in range(30)) for i in range(5)]) == set()


@pytest.mark.parametrize("run", [20_000, 40])
def test_similar_groups_of_a_large_family(spark, monkeypatch, run):
    monkeypatch.setattr(simhash, "RUN", run)  # 40: a crowded shingle is dealt over pairs of blocks
    rng = np.random.default_rng(12)
    base = [f"w{x}" for x in range(300)]

    def edited(words, edits):
        words = list(words)
        for at in rng.choice(len(words), edits, replace=False).tolist():
            words[at] = f"x{rng.integers(0, 10**9)}"
        return words

    members = [edited(base, 8) for _ in range(160)]  # alike to about 0.6, a few more
    texts = [" ".join(w) for w in members] + [" ".join(edited(w, 5)) for w in members[::2]] + [" ".join(edited(base, 1)) for _ in range(40)]
    texts = [texts[i] for i in rng.permutation(len(texts))]
    alike, group = brute_groups(texts)
    assert len(alike) > 80 and 20 < len(sets_of(group)) < len(texts)
    assert groups_of(spark, texts) == sets_of(group)


def test_packing(docs, all_rows, none):
    path = vocabulary_path(NAMES[0])
    tk = Tokenizer.from_file(path)
    got = packing.pack(docs, path, longest=64, shortest=8, pool=500, step=256).collect()
    pieces, sequences = collections.defaultdict(list), collections.defaultdict(list)
    for r in got:
        pieces[r["doc_id"]].append(r)
        sequences[r["sequence_id"]].append(r)
    for own in sequences.values():
        own.sort(key=lambda r: r["offset"])
        size = own[0]["context"]
        assert size <= 64 and size & (size - 1) == 0 and sum(r["length"] for r in own) == size
        assert [r["offset"] for r in own] == [sum(x["length"] for x in own[:i]) for i in range(len(own))]
    copies = bag(i for i, _ in all_rows)
    for i, t in all_rows:
        ids = [*tk.encode(t or "", add_special_tokens=False).ids, 0]
        seen = collections.Counter()
        for r in pieces[i]:
            assert np.frombuffer(r["ids"], "<u4").tolist() == ids[r["start"] : r["start"] + r["length"]] and r["doc_tokens"] == len(ids)
            seen.update(range(r["start"], r["start"] + r["length"]))
        assert seen == {k: copies[i] for k in range(len(ids))}
    assert packing.pack(none, path).collect() == []


def test_step_groups():
    groups = packing.step_groups([8] * 10 + [4] * 7 + [1] * 3, 16)
    sums = collections.Counter()
    for g, n in zip(groups, [8] * 10 + [4] * 7 + [1] * 3, strict=True):
        sums[g] += n
    assert max(sums.values()) - min(sums.values()) <= 8


@pytest.mark.parametrize("bits", [1, 7, 13, 16, 17, 31, 32])
def test_id_file(bits):
    rng = np.random.default_rng(bits)
    parts = [rng.integers(0, 2**bits, n).astype("<u4") for n in (0, 3, 700, 64, 1)]
    r = idfiles.Reader(idfiles.to_bytes([None, 1, 2, 3, -4], [x.tobytes() for x in parts], bits, 128))
    assert all((r.document(i) == x).all() for i, x in enumerate(parts)) and [n for n, _ in r.documents()] == [None, 1, 2, 3, -4]
    every = np.concatenate(parts)
    assert (r.ids(100, 300) == every[100:300]).all() and len(r.ids(5, 5)) == 0
    if bits < 32:
        with pytest.raises(ValueError, match="bits"):
            idfiles.to_bytes([1], [np.array([2**bits], "<u4").tobytes()], bits)


def test_token_files(spark, docs, all_rows, none):
    path = vocabulary_path(NAMES[1])
    tk = Tokenizer.from_file(path)
    folder = new_folder(spark, "test")
    files = idfiles.write_id_files(docs, folder, path, 1, 16, file_bytes=4000)
    assert files.count() > 3
    got = idfiles.read_id_files(files, folder).orderBy("start").collect()
    start, want = 0, []
    for i, t in sorted(all_rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = [*tk.encode(t or "", add_special_tokens=False).ids, 1]
        want.append((i, start, len(ids), np.array(ids, "<u4").tobytes()))
        start += len(ids)
    assert [tuple(r) for r in got] == want
    folder = new_folder(spark, "test")
    assert idfiles.read_id_files(idfiles.write_id_files(none, folder, path, 1, 16), folder).collect() == []


def test_licenses(spark, none):
    rows = [
        (1, "Words.\nReleased under the MIT License.\nmore"),
        (2, "x. Licensed under the Apache License,\nVersion 2.0. You may not use this file except in compliance with the License."),
        (3, "# This work is licensed under CC BY-NC 4.0.\n# Released under the MIT license! Released under the MIT license!"),
        (4, "the license is unknown software"),
        (5, None),
        (None, "All rights reserved. Copyright"),
    ]
    got = {r["doc_id"]: tuple(r[1:]) for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1] == ("MIT", "<mit-ref>", "")
    assert got[2] == ("Apache-2.0", "<apache-2-ref><apache-comply>", "")
    assert got[3] == ("MIT,CC-BY-NC-4.0", "<cc-by-nc-ref><mit-ref><mit-ref>", "")
    assert got[4] == got[5] == got[None] == ("", "", "")
    assert licenses.scan(none).collect() == []


MPL = "/* This Source Code Form is subject to the terms of the Mozilla Public\n * License, v. 2.0. If a copy of the MPL was not distributed with this\n * file, You can obtain one at https://mozilla.org/MPL/2.0/. */"
GPL = "This program is free software{} you can redistribute it and/or modify\nit under the terms of the GNU General Public License as published by\nthe Free Software Foundation; either version {} of the License, or\n(at your option) any later version.\n\nThis program is distributed in the hope that it will be useful,\nbut WITHOUT ANY WARRANTY; without even the implied warranty of\nMERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the\nGNU General Public License for more details."
MIT = """MIT License

Copyright (c) 2020 Someone

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT."""


def test_licenses_of_canonical_texts(spark):
    texts = [(MPL, "MPL-2.0"), (GPL.format(":", 3), "GPL-3.0-or-later"), (GPL.format(";", 2), "GPL-2.0-or-later"), (MIT, "MIT"), (f"Licences\nReleased under the CC0 1.0\n{GPL.format(':', 3)}\n\n{MIT}\n\n# Part\nLicensed under the Apache License, Version 2.0\nend", None)]
    texts += [("\n".join(SENTENCES_OF[x][0] + "." for x in sequence), name) for name, sequence in licenses.RULES]
    texts += [("\n".join(SENTENCES_OF[x][0].replace(" ", "\n", 1) + "." for x in sequence), name) for name, sequence in licenses.RULES]
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(texts)], "doc_id long, text string")
    rows = sorted(tuple(r) for r in licenses.scan(df).collect())
    db = duckdb.connect()
    documents = df.toArrow()  # noqa: F841, what the SQL reads
    assert sorted(db.sql(f"SELECT doc_id, licenses, sentences, rest FROM ({licenses.op5_sql()})").fetchall()) == rows
    got = {r["doc_id"]: r["licenses"] for r in licenses.scan(df).collect()}
    assert [got[i] for i, (_, name) in enumerate(texts) if name] == [name for _, name in texts if name]
    assert {"MIT", "Apache-2.0"} <= set(got[4].split(","))  # one notice over lines, one on a line of its own
    assert licenses.scan(spark.createDataFrame([(1, "Smith v. Jones. See option v. Released under the MIT License.")], "doc_id long, text string")).first()["licenses"] == "MIT"


def test_syncmers_are_free_of_context():
    rng = np.random.default_rng(0)
    a, b, c = (rng.integers(97, 123, n).astype(np.uint8).tobytes() for n in (100, 300, 50))
    alone = dict(zip(*(x.tolist() for x in syncmers.closed_syncmers(b)), strict=True))
    within = dict(zip(*(x.tolist() for x in syncmers.closed_syncmers(a + b + c)), strict=True))
    assert {k + 100: v for k, v in alone.items()}.items() <= within.items()
    for at in alone:
        k, s = syncmers.K, syncmers.S
        inner = [int(syncmers.mix(np.frombuffer(b[at + i : at + i + s], "<u8") * syncmers._GOLD)[0]) for i in range(k - s + 1)]
        assert min(inner) in (inner[0], inner[-1])


def test_fingerprints(docs, all_rows, none, monkeypatch):
    monkeypatch.setattr(syncmers, "TASK_BYTES", 4000)
    got = syncmers.fingerprints_with_edits(docs).collect()
    assert len(got) == len(all_rows)
    by = collections.defaultdict(list)
    for r in got:
        by[r["doc_id"]].append(r)
    order = sorted(((i, t or "") for i, t in all_rows), key=lambda r: (r[0] is not None, r[0] or 0))
    for (i, t), (_, after) in zip(order, [*order[1:], order[0]], strict=True):
        n = len(t) // 4
        edited = t[: len(t) - n] + after[:n]
        match = [r for r in by[i] if r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()]
        assert match and match[0]["n_chars"] == len(t)
        assert match[0]["fingerprint"] == syncmers.text_of(syncmers.fingerprint(t.encode()))
        assert 0 <= match[0]["near_edited"] <= 1 and 0 <= match[0]["near_next"] <= 1
        if len(t) > 600:
            assert match[0]["near_edited"] > 0.3
    assert syncmers.fingerprints_with_edits(none).collect() == []
    assert len(syncmers.fingerprints_with_edits(docs.limit(1)).collect()) == 1
    assert syncmers.likeness(syncmers.fingerprint(b"ab"), syncmers.fingerprint(b"ab")) == 1.0


def test_crc_is_unsigned(spark):
    assert spark.range(1).select(F.crc32(F.lit(b"abc"))).first()[0] == zlib.crc32(b"abc")
