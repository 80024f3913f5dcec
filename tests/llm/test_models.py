"""Operators that fit something: toxicity, mixing, neighbours; components; and the pipeline."""

import collections
import random
import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from tesserae.llm import mixing, neighbours, toxicity
from tesserae.llm.components import connected_components


def test_components(spark):
    rng = random.Random(2)
    edges = [(rng.randint(0, 400), rng.randint(0, 400)) for _ in range(250)] + [(1000 + i, 1001 + i) for i in range(60)] + [(5, 5), (None, 3)]
    got = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    group = {}
    for a, b in edges:
        if a is None or a == b:
            continue
        x, y = group.setdefault(a, {a}), group.setdefault(b, {b})
        if x is not y:
            x |= y
            for n in y:
                group[n] = x
    assert got == {n: min(g) for n, g in group.items()}
    assert connected_components(spark.createDataFrame([], "a long, b long")).collect() == []


@pytest.fixture(scope="module")
def labelled(spark):
    rng = random.Random(4)
    syllables = ["ka", "lo", "mi", "ne", "su", "ti", "vo", "ra"]
    bad = ["wretchling", "gloomster", "fouldrone", "nastigar", "bleakmonger"]
    rows = []
    for i in range(1200):
        words = ["".join(rng.choices(syllables, k=rng.randint(1, 4))) for _ in range(rng.randint(20, 80))]
        toxic = i % 5 == 0
        if toxic:
            for _ in range(max(3, len(words) // 8)):
                words.insert(rng.randrange(len(words)), rng.choice(bad))
        rows.append((i, " ".join(words), int(toxic)))
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows] + [(5000, None), (5001, ""), (5002, "x " * 30_000)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1, t) for i, _, t in rows] + [(9999, 1, 1), (3, None, None), (None, 0, 1)], "doc_id long, quality int, toxic int")
    return docs, labels, {i: t for i, _, t in rows}


def test_toxicity(labelled):
    docs, labels, truth = labelled
    got = toxicity.toxicity(docs, labels).withColumn("h", toxicity.held_out()).collect()
    score = {r["doc_id"]: r["_score"] for r in got}
    held = [r["doc_id"] for r in got if r["h"] and r["doc_id"] in truth]
    assert len(held) > 200 and all(0 <= s <= 1 for s in score.values())
    assert np.mean([(score[i] >= 0.3) == bool(truth[i]) for i in held]) > 0.95
    assert score[5000] == score[5001] < 0.3
    again = docs.where("doc_id in (5, 5, 6, 5000)").withColumns({"_score": F.lit("its own"), "_toxic": F.lit(1), "label": F.lit(0)})
    again = toxicity.toxicity(again.unionByName(again), labels)  # repeated rows and clashing names
    assert again.columns == ["doc_id", "text", "_toxic", "label", "_score"] and again.count() == 6
    assert again.groupBy("doc_id").agg(F.countDistinct("_score").alias("n")).where("n <> 1").isEmpty()


def test_one_wrong_label_takes_no_word_away():
    texts, others = [b"the fool came", b"a fool went", b"fool is he", b"some fool said"] * 30, [b"the man came"] * 400
    assert any(b"fool" in x for x in toxicity.distinctive(texts, others, 3)) and any(b"fool" in x for x in toxicity.distinctive(texts, [*others, b"a fool spoke"], 3))


def test_toxicity_without_labels(labelled, none):
    docs, labels, _ = labelled
    few = docs.limit(5)
    assert {r["_score"] for r in toxicity.toxicity(few, labels.limit(0)).collect()} == {0.0}
    assert {r["_score"] for r in toxicity.toxicity(few, labels.where("toxic = 1")).collect()} == {1.0}
    assert toxicity.toxicity(none, labels).collect() == []


PLAIN, ODD = [f"word{i}" for i in range(40)], [f"b!!{i}" for i in range(40)]


def plain_posteriors(rows, labels):
    """Each text's posteriors by loops over words, for the domains high and low."""
    part = lambda i: zlib.crc32(str(i).encode()) % 5
    domain = {i: bool(q) for i, q, _ in labels if i is not None}
    words = {i: [xxhash.xxh64_intdigest(w, 42) for w in (t or "").lower().split()] for i, t in rows}
    words = {i: [(h - 2**64 if h >= 2**63 else h) % mixing.BUCKETS for h in w] for i, w in words.items()}
    learnt = [i for i in words if i in domain and part(i) in mixing.WORDS]
    held = collections.Counter((b, domain[i]) for i in learnt for b in set(words[i]))
    n = collections.Counter(domain[i] for i in learnt)
    odds = {b: round(float(np.log((held[b, True] + 0.5) / (n[True] + 1) / ((held[b, False] + 0.5) / (n[False] + 1)))), 2) for b, _ in held if held[b, True] + held[b, False] >= mixing.SEEN}
    ordinary = {b: round(float(np.log(0.5 / (0 + 1) / ((held[b, True] + held[b, False] + 0.5) / (n[True] + n[False] + 1)))), 2) for b in odds}

    def seen(w):
        q, t, m = [odds.get(b, 0.0) for b in w], [ordinary.get(b, 0.0) for b in w], max(1, len(w))
        return [np.log1p(len(w)), sum(q) / m, min(q, default=0), max(q, default=0), sum(t) / m, max(t, default=0), (sum(x > 2 for x in t) / m) ** 0.5]

    x = {i: np.array(seen(w)) for i, w in words.items()}
    fit = [i for i in words if i in domain and part(i) in mixing.FIT]
    means = {d: np.mean([x[i] for i in fit if domain[i] == d], axis=0) for d in (True, False)}
    within = sum(np.outer(x[i] - means[domain[i]], x[i] - means[domain[i]]) for i in fit) / len(fit)
    inverse = np.linalg.inv(within + np.eye(mixing.WIDTH) * (1e-9 + 1e-6 * np.trace(within) / mixing.WIDTH))
    out = []
    for i, _ in rows:
        z = np.array([means[d] @ inverse @ x[i] - means[d] @ inverse @ means[d] / 2 + np.log(sum(domain[j] == d for j in fit) / len(fit)) for d in (True, False)])
        out.append(np.exp(z - z.max()) / np.exp(z - z.max()).sum())
    return out


def test_mixing(spark, none):
    rng = random.Random(6)
    rows = [(i, " ".join(rng.choice(PLAIN if rng.random() < (0.9 if i % 4 else 0.4) else ODD) for _ in range(rng.randint(9, 90)))) for i in range(300)] + [(900, None), (901, "  ")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 4 > 0), 0) for i in range(0, 300, 3)] + [(None, 1, 0)], "doc_id long, quality int, toxic int")
    got = mixing.mix(docs, labels, {"high": 0.5, "low": 0.5}).collect()
    p, n, r = np.array([x["posteriors"] for x in got]), np.array([x["tokens"] for x in got], float), np.array([x["rate"] for x in got])
    names, w = got[0]["domains"], n / n.sum()
    assert (r >= 0).all() and np.allclose(p.sum(1), 1) and {x["tokens"] for x in got if x["doc_id"] >= 900} == {0}
    assert np.abs((w * r) @ p - 0.5).max() < 0.01 < np.abs(w @ p - 0.5).max()
    plain = dict(zip([i for i, _ in rows], plain_posteriors(rows, [tuple(x) for x in labels.collect()]), strict=True))
    assert max(np.abs(np.array(x["posteriors"]) - plain[x["doc_id"]]).max() for x in got) < 1e-6
    # a plain projected gradient ends at the same rates
    q, step = np.ones(len(n)), 1 / (np.linalg.eigvalsh((p.T * w) @ p).max() + mixing.PULL)
    for _ in range(20_000):
        q = np.maximum(0, q - step * (p @ ((w * q) @ p - 0.5) + mixing.PULL * (q - 1)))
    assert np.abs(q - r).max() < 1e-4 and names == ["high", "low"]
    assert {x["rate"] for x in mixing.mix(docs, labels.limit(0), {"high": 1.0}).collect()} == {1.0}
    assert mixing.mix(none, labels, {"high": 1.0}).collect() == []


def test_pipeline_mixing_meets_the_targets(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(mixing, "TARGETS", {"high": 0.88, "low": 0.12})
    rng = random.Random(7)
    rows = [(i, " ".join(rng.choice(PLAIN if i % 4 else ODD) for _ in range(rng.randint(9, 90))), "its own") for i in range(3000)]
    rows += [(1, rows[1][1], "again"), (None, "word1 word2", None), (5001, None, None)]
    spark.createDataFrame([(i, int(i % 4 > 0), 0) for i in range(0, 3000, 3)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    docs = spark.createDataFrame(rows, "doc_id long, text string, _of string")
    taken = corpus_pipeline.mixed(spark, docs, str(tmp_path))
    assert taken.columns == docs.columns
    got = collections.Counter((r["doc_id"], r["text"]) for r in taken.collect())
    size = {(i, t): len((t or "").split()) * got[i, t] for i, t, _ in rows}
    assert abs(sum(n for (i, _), n in size.items() if i is not None and i % 4 == 0) / sum(size.values()) - 0.12) < 0.01
    assert all(got[i, t] >= 1 for i, t, _ in rows if i is not None and i % 4)  # what is to be more frequent stays
    assert corpus_pipeline.mixed(spark, docs.limit(0), str(tmp_path)).collect() == []


def test_pipeline_toxicity_of_odd_rows(spark, labelled, tmp_path):
    docs, labels, truth = labelled
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    docs = docs.select("*", F.lit("x").alias("_score"), F.lit(1).alias("_rest"))
    docs = docs.unionByName(docs.where("doc_id < 9"))
    kept = corpus_pipeline.without_toxic(spark, docs, str(tmp_path))
    assert kept.columns == docs.columns
    n = collections.Counter(r["doc_id"] for r in kept.collect())
    assert n[5000] == n[5001] == n[5002] == 1 and n[1] == 2 and n[0] == 0
    assert sum(n[i] == 0 for i, t in truth.items() if not t) < 10 and corpus_pipeline.without_toxic(spark, docs.limit(0), str(tmp_path)).collect() == []


def test_neighbours(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "BLOCK_ROWS", 300)
    rng = np.random.default_rng(8)
    x = rng.standard_normal((1500, 16)).astype(np.float32)
    x[700:1100] = x[3]  # a vector that a quarter of the rows share
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(2000, None), (2001, [0.0] * 16), (2002, [float("nan")] * 16), (2003, [1.0] * 15 + [None]), (None, [1.0] * 16), (2100, [1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = neighbours.nearest(df, df.where("vec_id % 100 = 0"))
    by = collections.defaultdict(list)
    for r in got.orderBy("query_id", "rank").collect():
        by[r["query_id"]].append((r["vec_id"], r["score"]))
    hits = 0
    for q in range(0, 1500, 100):
        d = np.sqrt(((x.astype(float) - x[q].astype(float)) ** 2).sum(1))
        d[q] = np.inf
        want = np.lexsort((np.arange(1500), d))[:10].tolist()
        assert [s for _, s in by[q]] == sorted(s for _, s in by[q]) and all(s == d[v] for v, s in by[q])
        hits += len(set(want) & {v for v, _ in by[q]})
        if 700 <= q < 1100:
            assert [v for v, _ in by[q]] == want
    assert set(by) == set(range(0, 1500, 100)) and hits >= 0.9 * 150
    assert len(neighbours.nearest(df.where("vec_id < 5"), df.where("vec_id = 0")).collect()) == 4
    assert neighbours.nearest(df.limit(0), df).collect() == []


def exact(rows, queries, k):
    out = []
    for q, v in queries:
        d = sorted((float(np.sqrt(((np.array(x) - np.array(v)) ** 2).sum())), i) for i, x in rows if i != q)
        out += [(q, r + 1, i) for r, (_, i) in enumerate(d[:k])]
    return sorted(out)


def test_every_query_gets_as_many_neighbours_as_there_are(spark):
    schema = "vec_id long, embedding array<double>"
    rng = np.random.default_rng(11)
    rows = [(i, [float(e) for e in v]) for i, v in enumerate(rng.normal(size=(7, 8)))]
    df = spark.createDataFrame(rows, schema)
    assert sorted((r["query_id"], r["rank"], r["vec_id"]) for r in neighbours.nearest(df, df).collect()) == exact(rows, rows, 10)
    near = rng.normal(size=(3000, 8))
    far = rng.normal(size=(30, 8)) * 40 + rng.choice([-300, 300], (30, 8))
    rows = [(i, [float(e) for e in v]) for i, v in enumerate(np.concatenate([near, far]))]
    df = spark.createDataFrame(rows, schema).repartition(4)
    got = sorted((r["query_id"], r["rank"], r["vec_id"]) for r in neighbours.nearest(df, df.where("vec_id % 20 = 0 or vec_id >= 3000")).collect())
    want = exact(rows, [r for r in rows if r[0] % 20 == 0 or r[0] >= 3000], 10)
    assert len(got) == len(want) and len(set(got) & set(want)) >= 0.9 * len(want)


def test_stages_leave_each_other_and_the_session_alone(spark):
    def docs(words):
        return spark.createDataFrame([(i, f"{w} one two\nshared line of words\nanother {w}", "en", "s", 9) for i, w in enumerate(words)], "doc_id long, text string, lang string, source string, n_chars long")

    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    was = spark.conf.get(name)
    for stage in (corpus_pipeline.without_repeated_lines, corpus_pipeline.one_of_each_group):
        one = stage(spark, docs(["abc", "def", "ghi"]), "")
        two = stage(spark, docs(["xyz", "uvw"]), "")
        assert two.count() == 2 and one.count() == 3 and one.where("doc_id = 0").count() == 1
        assert spark.conf.get(name) == was


def test_pipeline(spark, tmp_path):
    from ..conftest import SF

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    now, kept = docs, [set(texts)]
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, now, SF).write.parquet(str(tmp_path / str(i)))
        now = spark.read.parquet(str(tmp_path / str(i)))
        kept.append({r["doc_id"] for r in now.select("doc_id").distinct().collect()})
        if i < 4:
            assert now.columns == docs.columns
    assert kept[0] >= kept[1] >= kept[2] >= kept[3] >= kept[4] == kept[5]
    mixed = collections.Counter(r["doc_id"] for r in spark.read.parquet(str(tmp_path / "3")).collect())
    whole = now.groupBy("doc_id").agg(F.sum("length").alias("n"), F.max("doc_tokens").alias("t")).collect()
    assert all(r["n"] == r["t"] * mixed[r["doc_id"]] for r in whole)
    assert corpus_pipeline.ORACLE_SQL is None and [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "line dedup", "near dedup", "mixing", "packing"]


def test_pipeline_near_dedup_goes_by_fingerprints(spark):
    """Texts whose repeats outweigh their few other words have one fingerprint, though their sets of shingles are little alike."""
    same = "alpha beta gamma delta eps " * 60
    texts = [(7, same + " ".join(f"x{i}" for i in range(10))), (3, same + " ".join(f"y{i}" for i in range(10))), (5, "something else entirely that stands alone"), (5, "something else entirely that stands alone"), (None, same), (None, "nobody knows whose")]
    docs = spark.createDataFrame([(i, t, "en", "s", 9) for i, t in texts], "doc_id long, text string, lang string, source string, n_chars long")
    kept = corpus_pipeline.one_of_each_group(spark, docs, "")
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"] or 0, r["text"][:9]) for r in kept.collect()) == [(0, "nobody kn"), (3, "alpha bet"), (5, "something")]
    assert corpus_pipeline.one_of_each_group(spark, docs.limit(0), "").collect() == []


def test_pipeline_packs_in_small_batches(spark, monkeypatch):
    """Batches are cut when rows are made: pieces that were only planned meanwhile would be made of 10,000 rows at once."""
    import pyarrow as pa

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows], pa.int64())], ["n"])

    monkeypatch.setattr(corpus_pipeline.packing, "pieces", lambda docs: docs.mapInArrow(sizes, "n long"))
    got = [r["n"] for r in corpus_pipeline.packed(spark, spark.range(0, 5000, 1, 1), "").collect()]
    assert sum(got) == 5000 and max(got) <= corpus_pipeline.ROWS_AT_ONCE


def test_workers_drop_what_other_operators_keep(spark):
    """A worker that has encoded for the packing goes on to other operators, and no longer holds the vocabulary then."""
    from tesserae.llm import common, simhash
    from tesserae.llm.encoding import encoder, vocabulary_path

    path = vocabulary_path("byte_bpe_50k.json")
    assert encoder(path) is encoder(path)
    common.keep_only("encoding")
    assert path in common.kept["encoding"]
    common.keep_only()
    assert not common.kept["encoding"]

    def held(batches):
        from tesserae.llm.encoding import encoder

        for b in batches:
            encoder(path)
            yield b

    def left(batches):
        from tesserae.llm import common

        for b in batches:
            yield b if common.kept.get("encoding") else b.slice(0, 0)

    # one task after the other, so that they meet the same worker
    rows = spark.range(0, 4, 1, 1)
    rows.mapInArrow(held, "id long").collect()
    simhash.fingerprints(rows.select(rows["id"].alias("doc_id"), rows["id"].cast("string").alias("text")), "doc_id", "text", 3).collect()
    assert rows.mapInArrow(left, "id long").count() == 0
