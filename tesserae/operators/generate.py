"""Texts of pages: which evidence is pending, what a run takes in, and rewrites of texts that are out of shape.

What was taken in is a table of its own, (entity, key, version), a row for each statement: it grows with the statements and is joined,
never held in one row.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as X
from . import diff as D
from .closure import cut
from .measures import capped_evidence
from .passes import Client, answer

#: Statements of each role that one call is sent.
CAPS = {"about": 120, "refers": 80}
SEEN = "entity string, key string, version string"
_ANSWER = "definition string, context string"
Repair = Callable[[DataFrame, list[str]], DataFrame]


@dataclass
class Run:
    """The texts and what they have taken in after a run, and a row for each page: (slug, state, statements), made or failed."""

    prose: DataFrame
    seen: DataFrame
    report: DataFrame


def pending_evidence(evidence: DataFrame, seen: DataFrame, version: str, caps: dict[str, int] | None = None) -> DataFrame:
    """Statements (entity, role, key, date, ...) that a version has not taken in, with sent and covered as capped_evidence() has them.

    Statements about an entity beyond the cap wait for the next run; those that only mention it count as seen at once. A statement that is
    listed twice in a role counts once; one without entity or key is none; one without a date is the oldest.
    """
    done = seen.where(F.col("version") == version).select("entity", "key")
    left = evidence.where("entity is not null and key is not null").join(done, ["entity", "key"], "left_anti")
    once = left.repartition("entity").dropDuplicates(["entity", "role", "key"])  # one shuffle, which the caps' order uses too
    return capped_evidence(once, caps or CAPS)


def condense_prompt(definition: Column, context: Column, refused: Column, problems: Column) -> Column:
    """What a rewrite is asked: the text, and if an earlier answer was refused that and what is wrong with it."""
    return F.to_json(F.struct(definition.alias("definition"), context.alias("context"), refused.alias("refused"), problems.alias("problems")))


def _told(answers: DataFrame) -> DataFrame:
    """answers with _d and _c, what they say, and _ok, whether they can be read at all."""
    got = F.from_json("answer", _ANSWER)
    rows = answers.withColumn("_a", got)
    return rows.select(*answers.columns, X.strip(F.col("_a.definition")).alias("_d"), X.strip(F.col("_a.context")).alias("_c"), F.coalesce(F.col("_a.definition").isNotNull() | F.col("_a.context").isNotNull(), F.lit(False)).alias("_ok"))


def _tightened(rows: DataFrame, client: Callable[[], Client]) -> DataFrame:
    """rows (slug, definition, context, refused, problems) with _d and _c, what one call makes of them, and _ok.

    A definition within its length is kept, but for sentences about the word itself.
    """
    asked = rows.withColumn("prompt", condense_prompt(*map(F.col, ("definition", "context", "refused", "problems"))))
    got = _told(cut(answer(asked, client)))
    d = F.when(X.words(F.col("definition")) <= X.DEFINITION_WORDS, X.without_word_talk(F.col("definition"))).otherwise(F.coalesce("_d", "definition"))
    return got.withColumn("_d", d).withColumn("_c", F.coalesce("_c", "context"))


def generate(prose: DataFrame, seen: DataFrame, evidence: DataFrame, client: Callable[[], Client], model: str, at: str, version: str, caps: dict[str, int] | None = None, repair: Repair | None = None) -> Run:
    """Takes in the pending evidence of each page by one call, as far as the caps go: prose (diff.PROSE), seen (SEEN), evidence (entity, role, key, date, text).

    A prompt holds the page's text of this version and its evidence, newest first, at most as much as the caps allow. An answer over its limits is
    condensed by a second call; links are repaired, citations tidied. A page whose call fails or cannot be read keeps its text and its evidence, which the
    next run sends again. Repeated with the same tables it does the same; repeated with those that it returns it sends what is left, and nothing in the end.
    """
    chosen = cut(pending_evidence(evidence, seen, version, caps).where("covered"))  # what is sent is covered; the rest waits, and is not written
    sent = chosen.where("sent").groupBy(F.col("entity").alias("slug")).agg(F.sort_array(F.collect_list(F.struct("date", "key", "role", "text")), asc=False).alias("evidence"))
    now = D.current(prose, version).select("slug", F.col("definition").alias("_was_d"), F.col("context").alias("_was_c"))
    text = F.struct("slug", F.coalesce("_was_d", F.lit("")).alias("definition"), F.coalesce("_was_c", F.lit("")).alias("context"), "evidence")
    asked = sent.join(now, "slug", "left").select("slug", F.transform("evidence", lambda e: e["key"]).alias("keys"), F.to_json(text).alias("prompt"))
    got = _told(cut(answer(asked, client))).select("slug", "keys", X.without_word_talk(F.coalesce("_d", F.lit(""))).alias("definition"), F.coalesce("_c", F.lit("")).alias("context"), "_ok")
    long = got.where(F.col("_ok") & X.over_shape(F.col("definition"), F.col("context"))).select("slug", "definition", "context", F.lit(None).cast("string").alias("refused"), F.lit(None).cast("array<string>").alias("problems"))
    short = _tightened(long, client).select("slug", F.col("_d"), F.col("_c"), F.col("_ok").alias("_again"))
    both = got.join(short, "slug", "left").select("slug", "keys", F.coalesce("_d", "definition").alias("definition"), F.coalesce("_c", "context").alias("context"), (F.col("_ok") & F.coalesce("_again", F.lit(True))).alias("_ok"))
    made = both.where("_ok").drop("_ok")
    made = repair(made, ["definition", "context"]) if repair else made
    made = cut(made.withColumn("context", X.tidy_citations(F.col("context"))))
    covered = chosen.where("covered").join(made.select(F.col("slug").alias("entity")), "entity", "left_semi").select("entity", "key", F.lit(version).alias("version"))
    report = both.select("slug", F.when(F.col("_ok"), "made").otherwise("failed").alias("state"), F.size("keys").alias("statements"))
    return Run(D.record_revision(prose, made, model, at, version), seen.unionByName(covered).distinct(), report)


def condense(prose: DataFrame, client: Callable[[], Client], model: str, at: str, version: str, only: list[str] | None = None, tries: int = 2, repair: Repair | None = None) -> tuple[DataFrame, DataFrame]:
    """Rewrites the texts of a version that are over their limits: (prose, report).

    Texts that a person chose last stay. Only what a try refuses goes into the next one, with the refused context and what is wrong with it; what the
    last one refuses keeps its old text, and so does a page whose call fails. A rewrite takes in nothing. report (slug, tries, state, problems, context)
    has the state condensed, not kept (with the refused context) or failed.
    """
    todo = D.current(prose, version).where(~D.human_chosen(F.col("revisions")) & X.over_shape(F.col("definition"), F.col("context")))
    todo = todo.where(F.col("slug").isin(only)) if only is not None else todo
    todo = cut(todo.select("slug", "definition", "context", F.lit(None).cast("string").alias("refused"), F.lit(None).cast("array<string>").alias("problems")))
    rounds = []
    for n in range(1, tries + 1):
        got = _tightened(todo, client)
        new = got.select("slug", "_ok", F.col("_d").alias("new_d"), F.col("_c").alias("new_c"))
        new = repair(new, ["new_d", "new_c"]) if repair else new
        new = new.withColumn("new_c", X.tidy_citations(F.col("new_c"))).withColumn("wrong", X.shape_problems(F.col("new_d"), F.col("new_c")))
        state = F.when(~F.col("_ok"), "failed").when(F.size("wrong") == 0, "condensed").otherwise("not kept")
        new = cut(new.select("slug", state.alias("state"), "new_d", "new_c", "wrong", F.lit(n).alias("tries")))
        again = new.where("state = 'not kept'") if n < tries else new.limit(0)
        rounds.append(new.join(again.select("slug"), "slug", "left_anti"))
        todo = todo.select("slug", "definition", "context").join(again.select("slug", F.col("new_c").alias("refused"), F.col("wrong").alias("problems")), "slug")
        if again.isEmpty():
            break
    done = rounds[0]
    for more in rounds[1:]:
        done = done.unionByName(more)
    kept = done.where("state = 'condensed'").select("slug", F.col("new_d").alias("definition"), F.col("new_c").alias("context"), F.array().cast("array<string>").alias("keys"))
    report = done.select("slug", "tries", "state", F.when(F.col("state") == "not kept", F.col("wrong")).otherwise(F.array().cast("array<string>")).alias("problems"), F.when(F.col("state") == "not kept", F.col("new_c")).alias("context"))
    return D.record_revision(prose, kept, model, at, version), report
