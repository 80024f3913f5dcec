"""Model passes: batches of rows to a client that answers in JSON, and its answers as rows.

The client is the only part that is not deterministic; tests replay stored answers.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Protocol

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as X
from . import resolve as R


class Client(Protocol):
    def generate_json(self, prompt: str) -> str: ...


class Replay:
    """Answers from a dictionary of prompts, or an empty answer."""

    def __init__(self, answers: dict[str, str]):
        self.answers = answers

    def generate_json(self, prompt: str) -> str:
        return self.answers.get(prompt, "{}")


def prompts(rows: DataFrame, batch: str, *columns: str) -> DataFrame:
    """(batch, prompt): a batch's rows as a JSON array in the order of the first column."""
    return rows.groupBy(batch).agg(F.to_json(F.array_sort(F.collect_list(F.struct(*columns)))).alias("prompt"))


def answer(batches: DataFrame, client: Callable[[], Client], attempts: int = 2) -> DataFrame:
    """Each batch's answer, null where all attempts failed; made in the tasks, a client for each."""
    names = batches.columns

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = client()
        for frame in frames:
            out = []
            for prompt in frame["prompt"]:
                got = None
                for _ in range(attempts):
                    try:
                        got = own.generate_json(prompt)
                        break
                    except Exception:  # a failed call leaves its batch pending
                        continue
                out.append(got)
            yield frame.assign(answer=out)

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in batches.schema) + ", answer string"
    return batches.mapInPandas(run, schema).select(*names, "answer")


def link_answers(answers: DataFrame, asked: DataFrame, keys: DataFrame, version: str, model: str) -> DataFrame:
    """(statement, name, entity, polarity, version, model): what answers link asked statements (id, subject) to.

    Ids that were not asked, links to the subject itself and repeats of a target go; names without an entity stay as proposals.
    """
    form = "statements array<struct<id string, references array<struct<name string, polarity string>>>>"
    z = answers.select(F.explode(F.from_json("answer", form)["statements"]).alias("s")).select(F.col("s.id").alias("statement"), F.posexplode("s.references").alias("pos", "r"))
    rows = z.join(asked.select(F.col("id").alias("statement"), "subject"), "statement").select("statement", "subject", "pos", F.col("r.name").alias("name"), F.coalesce("r.polarity", F.lit("assert")).alias("polarity"))
    found = rows.join(R.prioritised(rows, "name", keys), "name").withColumn("target", F.coalesce(F.col("entity").cast("string"), X.api_slugify(F.col("name"))))
    kept = R.first_by(found.where("entity is null or entity <> subject"), ["statement", "target", "polarity"], [F.col("pos")])
    return kept.select("statement", "name", "entity", "polarity", F.lit(version).alias("version"), F.lit(model).alias("model"))


def fold_answers(answers: DataFrame, groups: DataFrame, weights: DataFrame) -> DataFrame:
    """(child, parent, same) of the folds that hold: said outright, both in one group, no pattern but as the same, the parent not of less support."""
    z = answers.select(F.explode(F.from_json("answer", "entries array<struct<id string, fold boolean, parent string, same boolean>>")["entries"]).alias("e"))
    rows = z.where("e.fold and e.parent is not null").select(F.col("e.id").alias("child"), F.col("e.parent").alias("parent"), F.coalesce("e.same", F.lit(False)).alias("same"))
    a = groups.select(F.col("id").alias("child"), F.col("grp").alias("_g"))
    b = groups.select(F.col("id").alias("parent"), F.col("grp").alias("_h"))
    w, v = weights.select(F.col("id").alias("child"), F.col("weight").alias("_w")), weights.select(F.col("id").alias("parent"), F.col("weight").alias("_v"))
    ok = rows.where("child <> parent").join(a, "child").join(b, "parent").join(w, "child").join(v, "parent")
    return ok.where("_g = _h and _v >= _w and (_g <> 'pattern' or same)").select("child", "parent", "same")


def condense(prose: DataFrame, rewritten: DataFrame) -> DataFrame:
    """Of rewrites (slug, definition, context) those in shape, as the new text; the rest keep the old with the problems named."""
    new = rewritten.select("slug", F.col("definition").alias("_d"), X.tidy_citations(F.col("context")).alias("_c"))
    problems = X.shape_problems(F.col("_d"), F.col("_c"))
    fits = F.col("_d").isNotNull() & (F.size(problems) == 0)
    return prose.join(new, "slug", "left").select("slug", F.when(fits, F.col("_d")).otherwise(F.col("definition")).alias("definition"), F.when(fits, F.col("_c")).otherwise(F.col("context")).alias("context"), F.when(F.col("_d").isNull(), F.array().cast("array<string>")).otherwise(problems).alias("problems"))
