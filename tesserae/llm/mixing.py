"""Mixing to target weights with soft domain membership, in DataFrame functions alone."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import col, table, written

#: Rounds of the projected gradient at most, the residual (share of all tokens) at which it ends, and the pull of rates towards 1.
ROUNDS, ENOUGH, PULL = 30, 1e-7, 1e-3
#: Buckets into which words are hashed, documents of a label that a bucket needs to count, and features of a text.
BUCKETS, SEEN, WIDTH = 1 << 15, 2, 7
#: Labelled documents that are learnt from at most, chosen by a hash of their ids; few enough for every task to hold.
LEARNT = 200_000
#: Of five parts of the labelled documents, by a hash of their ids: those that weigh words, those that fit the discriminant. The last is never learnt.
WORDS, FIT = (0, 1), (2, 3)
#: What each domain of the labels is called, by quality and toxicity.
DOMAINS = {(0, 0): "low", (0, 1): "low_toxic", (1, 0): "high", (1, 1): "high_toxic"}


def part(ident: Column) -> Column:
    """Which of the five parts of the labelled documents an id is of."""
    return F.crc32(ident.cast("string")) % 5


def _words(text: Column) -> Column:
    """The words of a text, A-Z lower-cased, by bucket."""
    words = F.split(F.translate(F.lower(F.coalesce(text, F.lit(""))), "\t\n\x0b\x0c\r", " " * 5), " ")
    return F.transform(F.filter(words, lambda w: w != ""), lambda w: (F.pmod(F.xxhash64(w), F.lit(BUCKETS)) + 1).cast("int"))


def labelled(labels: DataFrame, label_id: str = "doc_id") -> DataFrame:
    """(_of, _domain) of the labels with a quality, LEARNT at most; a null toxicity counts as none, of several labels of an id the first name counts."""
    name = F.coalesce(*[F.when((col("quality") == q) & (F.coalesce(col("toxic"), F.lit(0)) == t), n) for (q, t), n in DOMAINS.items()])
    return labels.where(col(label_id).isNotNull()).groupBy(col(label_id).alias("_of")).agg(F.min(name).alias("_domain")).where("_domain is not null").orderBy(F.xxhash64("_of"), "_of").limit(LEARNT)


def word_weights(docs: DataFrame, known: DataFrame, id_col: str, text_col: str) -> list[list[float]]:
    """For quality and for toxicity the log odds of each bucket: how much more often documents of that label hold its words than others do."""
    rows = docs.select(col(id_col).alias("_id"), col(text_col).alias("_t")).join(F.broadcast(known.where(part(F.col("_of")).isin(*WORDS))), F.col("_id") == F.col("_of"))
    good, bad = F.col("_domain").isin("high", "high_toxic"), F.col("_domain").isin("low_toxic", "high_toxic")
    sums = [F.sum(x.cast("long")).alias(n) for n, x in (("good", good), ("bad", bad))]
    all_ = rows.agg(F.count(F.lit(1)).alias("n"), *sums).first()
    found = rows.select(F.explode(F.array_distinct(_words(F.col("_t")))).alias("b"), "_domain").groupBy("b").agg(F.count(F.lit(1)).alias("n"), *sums).where(F.col("n") >= SEEN).collect()  # a row for each bucket
    out = []
    for flag in ("good", "bad"):
        weights = [0.0] * BUCKETS
        for r in found:
            one, two = (r[flag] + 0.5) / ((all_[flag] or 0) + 1), (r["n"] - r[flag] + 0.5) / (all_["n"] - (all_[flag] or 0) + 1)
            weights[r["b"] - 1] = round(float(np.log(one / two)), 2)
        out.append(weights)
    return out


def features(docs: DataFrame, weights: list[list[float]], id_col: str, text_col: str) -> DataFrame:
    """_id, _tokens (words) and _x, what the discriminant sees of a text: how long it is, and the mean and extremes of its words' weights."""
    listed = [F.split(F.lit(",".join(f"{x:g}" for x in w)), ",").cast("array<double>") for w in weights]
    looked_up = lambda a: F.transform("_w", lambda i: F.element_at(a, i))
    rows = docs.select(col(id_col).alias("_id"), _words(col(text_col)).alias("_w"))
    rows = rows.select("_id", F.size("_w").cast("long").alias("_tokens"), *[looked_up(a).alias(n) for n, a in zip(("_q", "_p"), listed, strict=True)])
    n = F.greatest(F.col("_tokens"), F.lit(1)).cast("double")
    mean = lambda x: F.aggregate(x, F.lit(0.0), lambda s, v: s + v) / n
    none = F.lit(0.0)
    marked = F.sqrt(F.aggregate("_p", F.lit(0.0), lambda s, v: s + F.when(v > 2, 1.0).otherwise(0.0)) / n)
    x = [F.log1p(F.col("_tokens").cast("double")), mean("_q"), F.coalesce(F.array_min("_q"), none), F.coalesce(F.array_max("_q"), none), mean("_p"), F.coalesce(F.array_max("_p"), none), marked]
    return rows.select("_id", "_tokens", F.array(*x).alias("_x"))


@dataclass
class Classifier:
    """A linear discriminant: for each domain a constant and weights, from which posteriors follow by a softmax."""

    names: list[str]
    constant: np.ndarray
    weights: np.ndarray

    def posterior(self, x: Column) -> Column:
        """An array of the domains' probabilities."""
        dot = lambda w: F.aggregate(F.zip_with(x, F.array(*map(F.lit, w)), lambda a, b: a * b), F.lit(0.0), lambda s, v: s + v)
        scores = F.array(*[F.lit(float(c)) + dot([float(v) for v in w]) for c, w in zip(self.constant, self.weights, strict=True)])
        raised = F.transform(scores, lambda s: F.exp(s - F.array_max(scores)))
        return F.transform(raised, lambda e: e / F.aggregate(raised, F.lit(0.0), lambda s, v: s + v))


def classify(seen: DataFrame, known: DataFrame) -> Classifier | None:
    """Fits the discriminant by one aggregation over the labelled rows: counts, means and the common covariance of the domains."""
    rows = seen.join(F.broadcast(known), F.col("_id") == F.col("_of"))
    m = WIDTH
    sums = [F.sum(F.col("_x")[i]).alias(f"s{i}") for i in range(m)] + [F.sum(F.col("_x")[i] * F.col("_x")[j]).alias(f"q{i}_{j}") for i in range(m) for j in range(i, m)]
    found = rows.groupBy("_domain").agg(F.count(F.lit(1)).alias("n"), *sums).orderBy("_domain").collect()  # a row for each domain
    if not found:
        return None
    n = np.array([r["n"] for r in found], float)
    mean = np.array([[r[f"s{i}"] for i in range(m)] for r in found]) / n[:, None]
    square = np.zeros((m, m))
    for i in range(m):
        for j in range(i, m):
            square[i, j] = square[j, i] = sum(r[f"q{i}_{j}"] for r in found)
    within = (square - (mean.T * n) @ mean) / n.sum()
    weights = np.linalg.solve(within + np.eye(m) * (1e-9 + 1e-6 * np.trace(within) / m), mean.T).T
    return Classifier([r["_domain"] for r in found], np.log(n / n.sum()) - 0.5 * (weights * mean).sum(1), weights)


def rate_of(p: Column, v: np.ndarray, least: float = 0.0) -> Column:
    """A document's rate: a step against the residuals of its domains from 1 on, projected onto what is not under `least`."""
    return F.greatest(F.lit(float(least)), 1 - F.aggregate(F.zip_with(p, F.array(*[F.lit(float(x)) for x in v]), lambda a, b: a * b), F.lit(0.0), lambda s, x: s + x))


@dataclass
class Mix:
    """What was fitted: the weights of words, the classifier, and by how much each domain's rate is off 1."""

    weights: list[list[float]]
    model: Classifier | None
    pull: np.ndarray
    least: float

    def rate(self, x: Column) -> Column:
        """A text's rate from what the classifier sees of it."""
        return rate_of(self.model.posterior(x), self.pull, self.least) if self.model else F.lit(1.0)

    def rated(self, docs: DataFrame, text_col: str = "text") -> DataFrame:
        """_row, the columns of docs, and _rate; computed where the row is, without a shuffle."""
        rows = docs.select(F.struct(*[col(c) for c in docs.columns]).alias("_row"))
        seen = features(rows.select("_row", F.col("_row").getField(text_col).alias("_t")), self.weights, "_row", "_t")
        return seen.select(F.col("_id").alias("_row"), self.rate(F.col("_x")).alias("_rate"))


def mix(docs: DataFrame, labels: DataFrame, targets: dict[str, float], id_col: str = "doc_id", text_col: str = "text", least: float = 0.0) -> DataFrame:
    """Rates at which documents are to be taken so that each domain's expected tokens are its target's share of all tokens.

    A classifier of the labelled documents gives each document its domain posteriors p: words are hashed into buckets, each weighed by
    its log odds in two parts of the labelled documents, and a linear discriminant of a text's weights is fitted on two others. The rates r, none under `least`, minimise
    the squares of sum(r * tokens * p) - target, as shares of all tokens, and PULL times the tokens' mean of (r - 1) ** 2. Each
    round of the projected gradient is one aggregation over the written posteriors: the residual of each domain, scaled by the Gram
    matrix of the documents whose rate is above `least`; the driver sees the sums for the domains alone. A target's weight goes by the name of its domain; names without labels are left out, domains without a weight
    get 0, and the weights are scaled to 1.

    Returns id_col, tokens, domains and posteriors (arrays, in the same order) and rate, a row for each row of docs. A null or blank
    text has no tokens, still posteriors and a rate; equal texts have equal rates; null and repeated ids are kept; without labels,
    domains and posteriors are empty and rates 1; an empty table gives an empty one; other columns are ignored.
    """
    return fit(docs, labels, targets, id_col, text_col, least)[1]


def fit(docs: DataFrame, labels: DataFrame, targets: dict[str, float], id_col: str = "doc_id", text_col: str = "text", least: float = 0.0) -> tuple[Mix, DataFrame]:
    """What mix() fits, and what it returns."""
    known = written(labelled(labels), "labelled")
    weights = word_weights(docs, known, id_col, text_col)
    seen = written(features(docs, weights, id_col, text_col), "features")
    model = classify(seen, known.where(part(F.col("_of")).isin(*FIT))) or classify(seen, known)
    if model is None:
        return Mix(weights, None, np.zeros(0), least), seen.select(F.col("_id").alias(id_col), F.col("_tokens").alias("tokens"), F.array().cast("array<string>").alias("domains"), F.array().cast("array<double>").alias("posteriors"), F.lit(1.0).alias("rate"))
    d = len(model.names)
    rows = written(seen.select("_id", "_tokens", model.posterior(F.col("_x")).alias("_p")), "posteriors")
    p = F.col("_p")

    def sums(v: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        """All tokens, each domain's expected tokens at the rates of v, and the Gram matrix of the documents with a rate above the least."""
        r = rows.select("_tokens", "_p", rate_of(p, v, least).alias("_r"))
        gram = [F.sum(F.when(F.col("_r") > least, F.col("_tokens") * p[i] * p[j]).otherwise(0.0)) for i in range(d) for j in range(i, d)]
        got = [float(x or 0) for x in r.agg(F.sum("_tokens"), *[F.sum(F.col("_tokens") * F.col("_r") * p[i]) for i in range(d)], *gram).first()]
        g = np.zeros((d, d))
        g[np.triu_indices(d)] = got[1 + d :]
        return got[0], np.array(got[1 : 1 + d]), np.maximum(g, g.T)

    v = np.zeros(d)
    total, held, gram = sums(v)
    if total:
        weight = np.array([max(0.0, targets.get(n, 0.0)) for n in model.names])
        goal = weight / weight.sum() if weight.sum() else np.full(d, 1 / d)
        off = held / total - goal - PULL * v  # zero where no rate would move
        for _ in range(ROUNDS):
            if np.abs(off).max() < ENOUGH:
                break
            move = np.linalg.solve(gram / total + PULL * np.eye(d), off)
            for _ in range(8):  # half as far until it is nearer
                _, held, gram = sums(v + move)
                then = held / total - goal - PULL * (v + move)
                if np.linalg.norm(then) < np.linalg.norm(off):
                    break
                move = move / 2
            v, off = v + move, then
    rate = rate_of(p, v, least)
    return Mix(weights, model, v, least), rows.select(F.col("_id").alias(id_col), F.col("_tokens").alias("tokens"), F.array(*map(F.lit, model.names)).alias("domains"), p.alias("posteriors"), rate.alias("rate"))


#: Shares of all tokens that the query and the pipeline aim at.
TARGETS = {"high": 0.88, "high_toxic": 0.07, "low": 0.05}


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), TARGETS)
