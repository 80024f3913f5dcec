"""Cohorts, centroids and personal data against plain versions."""

import datetime as dt
import hashlib
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tesserae.llm import boosting, centroids, cohorts, pii

CUT, EPOCH = dt.datetime(2024, 3, 1), dt.datetime(1970, 1, 1)
CLICKS = "click_id long, ts timestamp_ntz, arrived_at timestamp_ntz, client_id long, kind string, value double, props string, start string, cents int"
CLIENTS = "client_id long, city string, state int"


def plain_retention(clicks, clients):
    rows = {r for r in clicks if r[1] is not None and r[3] is not None}
    known = defaultdict(list)
    for i, ts, at, who, kind, value, *_ in rows:
        h = zlib.crc32(str(i).encode()) if i is not None else 1
        at = at + dt.timedelta(days=h % 100) if at and h % 3 == 0 else at
        cents = int(np.floor(100 * value + 0.5)) if value is not None and np.isfinite(value) else 0
        known[who].append((ts, at, kind, cents))
    city = {}
    for who, where, _ in clients:
        if where is not None:
            city[who] = min(where, city.get(who, where))
    cells = defaultdict(lambda: [0, 0, 0, 0])
    for who, got in known.items():
        states = [[x for x in got if x[1] is not None and x[1] < CUT], got]
        starts = [min((x[0] for x in s if x[2] == "purchase"), default=None) for s in states]
        days = [None if s is None else (s - EPOCH).days // 3 for s in starts]
        for state in (0, 1):
            sums = defaultdict(int)
            for ts, _, _, cents in states[state]:
                if starts[state] is not None and ts >= starts[state]:
                    sums[(ts - starts[state]) // dt.timedelta(days=3)] += cents
            for period, cents in sums.items():
                c = cells[state, city.get(who, ""), days[state], period]
                for i, v in enumerate((1, zlib.crc32(str(who).encode()), int(None not in days and days[0] != days[1]), cents)):
                    c[i] += v
    return sorted((*k, *v) for k, v in cells.items())


@pytest.fixture(scope="module")
def shop(spark):
    rng = random.Random(3)
    begin = dt.datetime(2024, 2, 10)
    when = lambda: begin + dt.timedelta(seconds=rng.randrange(40 * 86400), microseconds=rng.randrange(10**6))
    clicks = []
    for i in range(900):
        ts = when()
        who = 7 if i % 3 == 0 else rng.randrange(60)
        clicks.append((i, ts, ts + dt.timedelta(seconds=rng.randrange(3 * 86400)), who, rng.choice(["purchase", "view", None]), rng.choice([None, 1.005, -2.5, 19.99, float(rng.randrange(100))]), rng.choice([None, "", "{}"]), "x", 5))
    ts = clicks[0][1]
    clicks += clicks[:50] + [(None, ts, ts, 3, "purchase", 1.0, None, "x", 5), (1, None, ts, 3, "purchase", 1.0, None, "x", 5), (2, ts, None, 4, "purchase", 1.0, None, "x", 5), (3, ts, ts, None, "purchase", 1.0, None, "x", 5), (4, ts, ts, 5, "purchase", float("nan"), None, "x", 5), (5, ts, ts, 5, "view", float("inf"), None, "x", 5), (-6, dt.datetime(1969, 12, 30), ts, 61, "purchase", 1e300, None, "x", 5)]
    # one row differs from another only in a column that the matrix does not read
    clicks.append((*clicks[900 - 1][:8], 6))
    clients = [(i, rng.choice([None, "Ülm", "Bo", ""]), 1) for i in range(50)] + [(7, "Aa", 2), (None, "Zz", 1)]
    return clicks, clients, spark.createDataFrame(clicks, CLICKS).repartition(5), spark.createDataFrame(clients, CLIENTS)


@pytest.mark.parametrize("given", [{}, {"split_share": 40, "file_rows": 20, "memory": "64MB"}])
def test_retention(shop, given):
    clicks, clients, a, b = shop
    clicks = [(*r[:5], None if r[5] is not None and abs(r[5]) > 1e200 else r[5], *r[6:]) for r in clicks]
    got = cohorts.retention(a, b, **given)
    assert got.columns == ["state", "segment", "cohort", "period", "users", "users_crc32", "moved", "cents"]
    assert sorted(map(tuple, got.collect())) == plain_retention(clicks, clients)


def test_retention_of_nothing(shop):
    _, _, a, b = shop
    assert cohorts.retention(a.limit(0), b).collect() == []
    assert {r["segment"] for r in cohorts.retention(a, b.limit(0)).collect()} == {""}


def plain_means(vectors, k, rounds, scale=256):
    x = np.array([[int(np.floor(scale * float(e))) for e in v] for _, v in vectors], dtype=object)
    order = sorted(range(len(x)), key=lambda i: (hashlib.sha256(f"2:{vectors[i][0]}".encode()).hexdigest(), list(vectors[i][1])))
    c = [list(x[i]) for i in order[:k]]
    near = lambda: [min(range(len(c)), key=lambda j: (sum((a - b) ** 2 for a, b in zip(v, c[j], strict=True)), j)) for v in x]
    for _ in range(rounds):
        at = near()
        for j in range(len(c)):
            mine = [v for v, a in zip(x, at, strict=True) if a == j]
            c[j] = [sum(col) // len(mine) for col in zip(*mine, strict=True)] if mine else c[j]
    at = near()
    return sorted((v[0], a, sum((p - q) ** 2 for p, q in zip(row, c[a], strict=True))) for v, row, a in zip(vectors, x, at, strict=True)), c


@pytest.mark.parametrize("kind", ["spread", "ties", "few", "large"])
def test_yinyang(spark, kind):
    rng = np.random.default_rng(4)
    n, k, dims = {"spread": (700, 25, 8), "ties": (500, 21, 3), "few": (9, 40, 4), "large": (200, 12, 4)}[kind]
    v = {"ties": rng.integers(-2, 3, (n, dims)) / 256, "large": rng.normal(size=(n, dims)) * 1e5}.get(kind, rng.normal(size=(n, dims)) + rng.integers(0, 12, (n, 1)) * 3)
    v = v.astype(np.float32)
    rows = [(int(i), [float(e) for e in r]) for i, r in enumerate(v)]
    rows += rows[:5]
    bad = [(1000, None), (1001, []), (1002, [1.0] * (dims + 1)), (1003, [None] + [1.0] * (dims - 1)), (1004, [float("nan")] + [1.0] * (dims - 1)), (1005, [float("inf")] + [1.0] * (dims - 1))]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows + bad], "vec_id long, embedding array<float>, cluster string, _file int").repartition(3)
    got = centroids.yinyang(df, k=k, rounds=4, dims=dims)
    want, c = plain_means(rows, k, 4)
    assert sorted(map(tuple, got.rows.collect())) == want
    assert [list(map(int, x)) for x in got.centroids] == c
    assert got.inertia == [sum(d for _, a, d in want if a == j) for j in range(len(c))]
    if kind == "spread":
        assert got.scans[-1] < 0.5 * len(rows) * k  # the bounds spare most distances
    full = centroids.clustered(df, k=k, rounds=4, dims=dims).collect()
    assert {(r["cluster"], r["centroid_sha256"]) for r in full} == {(a, hashlib.sha256(",".join(map(str, c[a])).encode()).hexdigest()) for _, a, _ in want}


def test_yinyang_of_nothing(spark):
    none = spark.createDataFrame([(1, None)], "vec_id long, embedding array<float>")
    assert centroids.clustered(none).collect() == [] and len(centroids.clustered(none).columns) == 6


def test_null_ids_start_no_centroid_before_others(spark):
    df = spark.createDataFrame([(None, [0.0, 0.0]), (1, [1.0, 1.0]), (2, [5.0, 5.0])], "vec_id long, embedding array<float>")
    got = centroids.yinyang(df, k=2, rounds=1, dims=2)
    assert got.rows.count() == 3 and all(tuple(c) != (0, 0) for c in got.centroids)


PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def plain_luhn(digits):
    return sum(sum(divmod(int(c) * (2 if i % 2 else 1), 10)) for i, c in enumerate(reversed(digits))) % 10 == 0


def plain_spans(text):
    out = []
    for kind, p in PATTERNS.items():
        for m in re.finditer(p, text):
            digits = re.sub("[^0-9]", "", m.group())
            good = {"email": True, "ip": kind != "ip" or all(int(x) <= 255 for x in m.group().split(".")), "card": kind == "card" and 16 <= len(digits) <= 19 and plain_luhn(digits), "phone": 8 <= len(digits) <= 15}[kind]
            if good:
                out.append((kind, m.start(), m.end()))
    return out


def card(rng, n=16):
    head = "".join(str(rng.randrange(10)) for _ in range(n - 1))
    return next(head + str(c) for c in range(10) if plain_luhn(head + str(c)))


@pytest.fixture(scope="module")
def letters():
    """(doc_id, text): prose with personal data written by the rules, and words without any."""
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 8)))
    prose = lambda n: " ".join(word() + rng.choice(["", "", ".", " at", ","]) for _ in range(n))
    say = {"email": lambda: f"{word()}.{rng.randrange(99)}@{word()}.example.com", "ip": lambda: ".".join(str(rng.randrange(256)) for _ in range(4)), "card": lambda: card(rng), "phone": lambda: f"+{rng.randrange(1, 99)} ({rng.randrange(100, 999)}) 555-{rng.randrange(1000, 9999)}"}
    docs = [(i, f"{prose(rng.randint(1, 30))} {say[kind]()} {prose(5)}" if i % 2 else prose(30)) for i in range(800) for kind in [rng.choice(list(say))]]
    odd = [None, "", "a@b c@d.e+f@g.h..i@j.k", "x@y@z.w", "1.2.3.4.5.6.7.8 256.1.1.1 001.02.3.255", f"{card(rng)} {card(rng)}", f"{card(rng)[:4]}-{card(rng)}", "+1 (222) 333-4444+5 66 777 8888) +1", "😀😀 é" + "+49 170 1234567 😀 me@x.org", "a@" + "b." * 20000 + "c", "1" * 30000 + "." + "2 " * 9000, "+" + "1 " * 20000, ("q@r.s " + "9.9.9.9 ") * 3000]
    return docs + [(1000 + i, t) for i, t in enumerate(odd)]


@pytest.fixture(scope="module")
def letter_rows(spark, letters):
    return spark.createDataFrame([(i, t, 1, "x") for i, t in [*letters, letters[1], (None, "me@here.org")]], "doc_id long, text string, spans int, _base string").repartition(4)


@pytest.fixture(scope="module")
def detector(letter_rows):
    return pii.fit(letter_rows)


def test_rules_are_those_of_the_contract(letter_rows, letters, detector):
    got = defaultdict(list)
    for r in detector.find(letter_rows).collect():
        got[r["doc_id"]].append([(s["kind"], s["start"], s["end"]) for s in r["spans"] if s["base"]])
    assert len(got[1]) == 2 and got[None] == [[("email", 0, 11)]]
    for i, text in letters:
        assert got[i][0] == plain_spans(text or ""), (i, (text or "")[:80])


def test_candidates_add_other_ways_of_writing(spark, detector):
    rng = random.Random(2)
    hidden = [f"abc de fgh jan.{i} (at) mail.example (dot) com, ghi" for i in range(10)] + [f"abcd fghi 0049 (170) 555-{1234 + i} efg hij" for i in range(10)] + [f"abcd. {'.'.join(re.findall('....', card(rng)))} gfe" for _ in range(10)]
    clean = ["we met at noon. then we left at ten. it was", "in 2024 and 1999, 12 of 30", "page 12/34, 5:30", "version 1.2.3 at home. ok"] * 5
    df = spark.createDataFrame([(i, t) for i, t in enumerate(hidden + clean)], "doc_id int, text string")
    found = {r["doc_id"]: [s for s in r["spans"] if not s["base"]] for r in detector.find(df).collect()}
    assert sum(bool(found[i]) for i in range(30)) >= 25
    assert not any(found[i] for i in range(30, 50))
    assert all(t is not None for t in detector.thresholds.values())
    for spans in found.values():  # what is added does not overlap
        assert all(a["end"] <= b["start"] or b["end"] <= a["start"] for a in spans for b in spans if a != b)
    clear = {r["doc_id"]: r["text"] for r in pii.redact(detector.find(df)).collect()}
    assert clear[30] == clean[0] and "[EMAIL]" in clear[next(i for i in range(10) if found[i])]


def test_redaction(spark, detector):
    df = spark.createDataFrame([(1, "é 😀 me@x.org, 9.8.7.6 end"), (2, None), (3, "+1.2.3.4567 8")], "doc_id int, text string")
    got = {r["doc_id"]: r["text"] for r in pii.redact(detector.find(df)).collect()}
    assert got == {1: "é 😀 [EMAIL], [IP] end", 2: "", 3: got[3]} and got[3].count("[") == 1


def test_nothing_to_learn_from(spark):
    empty = spark.createDataFrame([], "doc_id int, text string")
    d = pii.fit(empty)
    assert d.find(empty).collect() == []
    some = spark.createDataFrame([(1, "write to a@b.cd"), (2, "nothing")], "doc_id int, text string")
    assert [len(r["spans"]) for r in pii.fit(some).find(some).orderBy("doc_id").collect()] == [1, 0]


def test_a_name_of_any_length_is_a_candidate(spark):
    """The rule has no longest name before the @, so neither has what is written otherwise."""
    texts = [f"write to {'x' * n}{at}host{dot}example soon" for n in (1, 64, 65, 5000) for at, dot in ((" (at) ", " (dot) "), (" @ ", "."), (" at ", " dot "))]
    rows = pii._candidates(pii._based(spark.createDataFrame(list(enumerate(texts)), "doc_id long, _text string")))
    got = {r["doc_id"]: [c["span"] for c in r["_c"] if c["kind"] == "email"] for r in rows.collect()}
    assert got == {i: [t[len("write to ") : -len(" soon")]] for i, t in enumerate(texts)}


def test_boosted_trees_as_columns(spark):
    rng = np.random.default_rng(1)
    x = rng.integers(0, 6, (400, 3)).astype(float)
    y = ((x[:, 0] > 2) ^ (x[:, 1] > 3)).astype(float)
    model = boosting.fit(x, y)
    assert ((model.margins(x) > 0) == (y > 0)).mean() > 0.98
    df = spark.createDataFrame([tuple(map(float, r)) for r in x], "a double, b double, c double")
    got = [r[0] for r in df.select(model.margin([F.col("a"), F.col("b"), F.col("c")])).collect()]
    assert np.allclose(got, model.margins(x))
    assert boosting.fit(x, np.ones(400)).trees == []


def test_native(letter_rows, detector):
    plan = detector.find(letter_rows)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow|MapIn", plan)
