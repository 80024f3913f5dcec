"""Toxicity by compression distance: what a dictionary of toxic text saves on each window of a text."""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import col, keep_only, table

#: Labelled documents of each class that a fit uses at most.
TOXIC_SAMPLE, ORDINARY_SAMPLE = 1500, 4000
#: How much larger a share of toxic than of ordinary texts must hold a word of the toxic dictionary, and windows that train a dictionary at most.
RATIO, TRAINED = 30, 40_000
#: Bytes of the two dictionaries, of a window and of the start that every window is given.
TOXIC_BYTES, ORDINARY_BYTES, WINDOW, LEAD = 4096, 8192, 64, 24


def windows(raw: bytes, size: int = WINDOW) -> list[bytes]:
    """The words of a text in runs of so many bytes or a word more; one empty window if there are none."""
    out, own = [], b""
    for word in raw.split():
        own += b" " + word
        if len(own) >= size:
            out.append(own + b" ")
            own = b""
    if own or not out:
        out.append(own + b" ")
    return out


def _train(size: int, samples: list[bytes], d: int, k: int) -> bytes:
    """The content of a dictionary trained by zstandard, on samples from all over where there are more than TRAINED; the samples' own end where they are too few."""
    samples = samples[:: -(-len(samples) // TRAINED) or 1]
    try:
        content = zstandard.train_dictionary(size, samples, d=d, k=k).as_bytes()
        return content[-(size - 256) :]  # without the header and its entropy tables
    except zstandard.ZstdError:
        return b"".join(samples)[-size:]


def distinctive(texts: list[bytes], others: list[bytes], contexts: int) -> list[bytes]:
    """Of each text the words that stand before so many different words in texts, and that RATIO times as large a share of texts as of others hold."""
    held = Counter(w for x in texts for w in set(x.split()))
    known = Counter(w for x in others for w in set(x.split()))
    after: dict[bytes, set] = defaultdict(set)
    for x in texts:
        own = x.split()
        for a, b in zip(own, [*own[1:], b""], strict=True):
            if held[a] * (len(others) + 1) >= RATIO * known[a] * (len(texts) + 1) and len(after[a]) < contexts:
                after[a].add(b)
    kept = {w for w, s in after.items() if len(s) >= contexts}
    rows = [b" ".join(w for w in x.split() if w in kept) for x in texts]
    return [b" " + r + b" " for r in rows if r]


@dataclass
class Model:
    """Two dictionaries, trained on toxic and on ordinary text; and the calibration of what the first saves beyond the second."""

    toxic: bytes
    ordinary: bytes
    weights: np.ndarray
    centre: np.ndarray
    scale: np.ndarray
    bar: int = 3  # bytes that mark a window
    _pair: tuple = field(default=(), repr=False, compare=False)

    def saved(self, raw: bytes) -> np.ndarray:
        """By how many bytes each window is shorter where the toxic dictionary stands before the ordinary one, and not as many zeros."""
        if not self._pair:
            plain, both = (zstandard.ZstdCompressor(level=3, dict_data=zstandard.ZstdCompressionDict(x, dict_type=zstandard.DICT_TYPE_RAWCONTENT), write_content_size=False) for x in (bytes(len(self.toxic)) + self.ordinary, self.toxic + self.ordinary))
            self._pair = (plain.compress, both.compress)
        lead = self.ordinary[-LEAD:]  # so that a block has a match and its headers are paid for
        plain, both = self._pair
        return np.array([len(plain(lead + w)) - len(both(lead + w)) for w in windows(raw)], np.float64)

    def features(self, raw: bytes) -> np.ndarray:
        d = self.saved(raw.lower())
        marked = int((d >= self.bar).sum())
        return np.array([d.mean(), d.max(), np.sort(d)[-3:].mean(), marked / len(d), np.log1p(marked), np.log(len(d))])

    def score(self, raw: bytes) -> float:
        x = (self.features(raw) - self.centre) / self.scale
        return float(1 / (1 + np.exp(-np.clip(self.weights[0] + x @ self.weights[1:], -30, 30))))

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_pair": ()}


def _logistic(x: np.ndarray, y: np.ndarray, w: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Weights of a logistic regression, the first for the constant, by Newton's method."""
    x = np.hstack([np.ones((len(x), 1)), x])
    b = np.zeros(x.shape[1])
    penalty = ridge * np.diag([1e-6, *np.ones(x.shape[1] - 1)])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        step = np.linalg.solve((x.T * (w * p * (1 - p) + 1e-9)) @ x + penalty, x.T @ (w * (y - p)) - penalty @ b)
        b += np.clip(step, -3, 3)
        if np.abs(step).max() < 1e-8:
            break
    return b


def fit(rows: list[tuple[bytes, int]], share: float) -> Model | float:
    """A model from labelled texts, of which share are toxic where they come from; that share alone if a class has no text.

    Two thirds train the dictionaries, the rest calibrates what they save into a probability.
    """
    lowered = list(dict.fromkeys((x.lower(), int(y)) for x, y in rows))
    parts = [[x for i, (x, y) in enumerate(lowered) if y == k and (i % 3 < 2) == train] for k in (1, 0) for train in (True, False)]
    toxic, toxic_rest, ordinary, ordinary_rest = parts
    toxic_rest, ordinary_rest = toxic_rest or toxic, ordinary_rest or ordinary
    if not toxic or not ordinary:
        return share
    own = distinctive(toxic, ordinary, max(4, min(8, len(toxic) // 125))) or toxic
    cut = lambda texts, n: [x[i : i + n] for x in texts for i in range(0, len(x), n)]
    model = Model(_train(TOXIC_BYTES, cut(own, 256), 6, 32), _train(ORDINARY_BYTES, cut(ordinary, 128), 8, 64) or b" ", np.zeros(0), np.zeros(0), np.ones(0))
    x = np.array([model.features(t) for t in [*toxic_rest, *ordinary_rest]])
    y = np.array([1.0] * len(toxic_rest) + [0.0] * len(ordinary_rest))
    w = np.where(y == 1, share / len(toxic_rest), (1 - share) / len(ordinary_rest)) * len(y)
    model.centre, model.scale = x.mean(0), np.maximum(x.std(0), 1e-9)
    model.weights = _logistic((x - model.centre) / model.scale, y, w)
    return model


def held_out(id_col: str = "doc_id"):
    """Whether a row's label is never learnt from: crc32 of its id as text leaves 2 by 4."""
    return F.coalesce(F.crc32(col(id_col).cast("string")) % 4 == 2, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Model | float:
    """Fits on up to TOXIC_SAMPLE toxic and ORDINARY_SAMPLE ordinary documents whose labels are not held out, chosen by a hash of their ids.

    Only the ids of the sample are broadcast, a bounded number. Labels that are null count for nothing; of several labels of a
    document the largest counts.
    """
    known = labels.where(col("toxic").isNotNull() & col(id_col).isNotNull() & ~held_out(id_col)).groupBy(col(id_col).alias("_of")).agg(F.max(F.when(col("toxic") == 1, 1).otherwise(0)).alias("_toxic"))
    share = known.agg(F.avg("_toxic")).first()[0]
    if share is None:
        return 0.0
    by_hash = [F.xxhash64("_of"), F.col("_of")]
    sample = known.where("_toxic = 1").orderBy(*by_hash).limit(TOXIC_SAMPLE).unionByName(known.where("_toxic = 0").orderBy(*by_hash).limit(ORDINARY_SAMPLE))
    rows = docs.select(col(id_col).alias("_id"), col(text_col).alias("_text")).join(F.broadcast(sample), F.col("_id") == F.col("_of")).select("_id", "_text", "_toxic").collect()
    rows.sort(key=lambda r: (r["_id"], r["_text"] or ""))
    return fit([((r["_text"] or "").encode(), r["_toxic"]) for r in rows], share)


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The columns of docs and `_score`, in place of any so named, from 0 to 1: the calibrated probability that a text's label would be toxic.

    A text is cut into windows of words; the zstandard dictionary trained on the toxic texts' distinctive words stands before the
    one trained on ordinary texts, and how many bytes that saves on each window makes the score. Nothing but the text is scored.
    A null or empty text has one empty window and the score of a text on which nothing is saved; equal texts have equal scores, repeated rows are scored each;
    without labels of both classes every score is the share of toxic labels (0 without labels); an empty table gives an empty one.
    """
    docs = docs.select(*[col(c) for c in docs.columns if c != "_score"])
    model = train(docs, labels, id_col, text_col)
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep_only()
        for batch in batches:
            texts = batch.column(names.index(text_col)).to_pylist()
            scores = [model if isinstance(model, float) else model.score((x or "").encode()) for x in texts]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores, pa.float64())], [*names, "_score"])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField("_score", T.DoubleType())]))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    got = toxicity(docs, table(spark, sf_dir, "labels"))
    return got.select("doc_id", held_out().alias("held_out"), F.col("_score").alias("score"), (F.col("_score") >= 0.3).cast("int").alias("predicted"))
