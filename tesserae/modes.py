"""The modes of a curator as functions over one folder: link, generate, condense, materialise, and the jobs that lead from one to the next.

Each reads the state that it needs, does what is pending, and commits what changed as one version of each table; a mode that is repeated finds
nothing to do. Two writers of one table never overwrite each other: the later one is refused (versions.StaleVersionError) and repeats its mode.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import text as X
from .operators import diff as D
from .operators import generate as GEN
from .operators import links as L
from .operators import resolve as R
from .operators import waves
from .operators.closure import cut
from .operators.passes import Client
from .sources.tables import require_corpus
from .sources.versions import VersionedTable

LINKS = "statement string, source_id string, subject string, name string, entity string, target string, polarity string, version string, model string"
LINKED = "statement string, version string"
PAGES = "slug string, name string, kind string, overview string, context string, sources array<string>"


@dataclass
class Workspace:
    """A corpus (tables of sources.tables, each row with _ord or in the order of ids) and the folder of its state, which all executors see."""

    spark: SparkSession
    corpus: dict[str, DataFrame]
    folder: str
    version: str = "1"
    model: str = ""

    def __post_init__(self) -> None:
        require_corpus(self.corpus)

    def table(self, name: str) -> VersionedTable:
        schema, keys = {
            "links": (LINKS, ["statement", "name", "polarity"]), "linked": (LINKED, ["statement", "version"]), "proposed": (waves.PROPOSED, ["slug"]), "prose": (D.PROSE, ["slug"]),
            "seen": (GEN.SEEN, ["entity", "key", "version"]), "pages": (PAGES, ["slug"]),
        }[name]
        return VersionedTable(self.spark, f"{self.folder}/{name}", schema, keys)

    def entities(self) -> DataFrame:
        e = self.corpus["entities"].where("id is not null and slug is not null")
        order = F.col("_ord") if "_ord" in e.columns else F.col("id")
        return R.first_by(e.withColumn("_o", order), ["slug"], [F.desc("_o")])

    def catalog(self) -> DataFrame:
        return self.entities().select("slug", F.concat(folder_of(F.col("kind")), F.lit("/"), "slug").alias("path"))

    def statements(self) -> DataFrame:
        """(id, source_id, entity, text, date): attributions of known entities with a text; the date is the session's or else the day the source came."""
        a = self.corpus["attributions"].where("id is not null")
        ids = self.entities().select(F.col("id").alias("entity_id"), F.col("slug").alias("entity"))
        s = self.corpus["sources"].select(F.col("id").alias("source_id"), day_of(F.col("session_date"), F.col("created_at")).alias("date"))
        rows = a.withColumn("text", X.strip(F.coalesce("prose", F.lit("")))).where("text <> ''").join(ids, "entity_id").join(s, "source_id", "left")
        return R.first_by(rows.select("id", "source_id", "entity", "text", "date"), ["id"], [F.col("source_id")])


def folder_of(kind):
    """The folder of a kind's pages; technique where the kind is none of these."""
    return F.when(kind.isin("concept", "drill", "pattern"), F.concat(kind, F.lit("s"))).otherwise(F.lit("techniques"))


def day_of(session_date, created_at):
    """When a source was: its session's date, or else the day it was made."""
    return F.coalesce(session_date, created_at.cast("date"))


def link(ws: Workspace, client: Callable[[], Client], sources: list[str] | None = None, size: int = 50, wave_count: int = 4) -> DataFrame:
    """Links the statements that this version has not read, of these sources or of all: (source_id, subject), the subjects whose statements were linked.

    A statement counts as read once its batch was answered; those of a failed batch stay pending.
    """
    linked, at = ws.table("linked").read()
    todo = D.pending(ws.statements().withColumnRenamed("id", "statement"), linked, ["statement"], ws.version)
    todo = cut(todo.where(F.col("source_id").isin(sources)) if sources is not None else todo)
    e = ws.entities()
    order = "_ord" if "_ord" in e.columns else "id"
    keys = R.catalog_keys(e, "slug", "slug", "aliases", order)
    proposed, proposed_at = ws.table("proposed").read()
    asked = todo.select(F.col("statement").alias("id"), F.col("entity").alias("subject"), "text")
    answered: list[DataFrame] = []
    got, names = waves.link(asked, keys, proposed, client, ws.version, ws.model, size, wave_count, answered)
    read = todo.join(answered[0].select(F.col("id").alias("statement")), "statement", "left_semi") if answered else todo.limit(0)
    got = cut(got.join(todo.select("statement", "source_id", F.col("entity").alias("subject")), "statement"))
    if not read.isEmpty():
        ws.table("links").update(lambda _: got.select(*[f.split(" ")[0] for f in LINKS.split(", ")]))
        fresh = names.join(proposed.select("slug"), "slug", "left_anti")
        if not fresh.isEmpty():
            ws.table("proposed").commit(fresh, proposed_at)
        ws.table("linked").commit(read.select("statement", F.lit(ws.version).alias("version")), at)
    return cut(read.select("source_id", F.col("entity").alias("subject")).distinct())


def evidence(ws: Workspace) -> DataFrame:
    """Own statements of each entity, and those that links assert to mention it."""
    s = ws.statements()
    own = s.select("entity", F.lit("about").alias("role"), F.col("id").alias("key"), "date", "text")
    links, _ = ws.table("links").read()
    told = links.where((F.col("version") == ws.version) & (F.col("polarity") == "assert") & F.col("entity").isNotNull()).select(F.col("statement").alias("id"), F.col("entity").alias("_to")).distinct()
    refers = s.join(told, "id").where("entity <> _to").select(F.col("_to").alias("entity"), F.lit("refers").alias("role"), F.col("id").alias("key"), "date", "text")
    return own.unionByName(refers)


def generate(ws: Workspace, client: Callable[[], Client], at: str, slugs: list[str] | None = None, caps: dict[str, int] | None = None) -> DataFrame:
    """Takes in the pending evidence of these pages or of all: the report of generate.generate()."""
    (prose, read), (seen, seen_at) = ws.table("prose").read(), ws.table("seen").read()
    rows = evidence(ws)
    rows = rows.where(F.col("entity").isin(slugs)) if slugs is not None else rows
    run = GEN.generate(prose, seen, rows, client, ws.model, at, ws.version, caps, L.repairer(ws.catalog()))
    report = cut(run.report)
    made = report.where("state = 'made'").select("slug")
    if not made.isEmpty():
        ws.table("prose").commit(run.prose.join(made, "slug", "left_semi"), read)
        ws.table("seen").commit(run.seen.join(seen, ["entity", "key", "version"], "left_anti"), seen_at)
    return report


def condense(ws: Workspace, client: Callable[[], Client], at: str, only: list[str] | None = None) -> DataFrame:
    """Rewrites texts that are over their limits: the report of generate.condense()."""
    prose, read = ws.table("prose").read()
    new, report = GEN.condense(prose, client, ws.model, at, ws.version, only, repair=L.repairer(ws.catalog()))
    report = cut(report)
    done = report.where("state = 'condensed'").select("slug")
    if not done.isEmpty():
        ws.table("prose").commit(new.join(done, "slug", "left_semi"), read)
    return report


def pages(ws: Workspace) -> DataFrame:
    """The page of every entity: its text, what is done in practice, and its sources."""
    (prose, _), s = ws.table("prose").read(), ws.statements()
    told = s.groupBy(F.col("entity").alias("slug")).agg(F.array_sort(F.collect_set("source_id")).alias("sources"))
    e = ws.entities().select("slug", F.col("canonical_name").alias("name"), "kind", F.col("overview_md").alias("overview"))
    return L.texts_on_pages(e.join(told, "slug", "left"), prose, ws.catalog(), ws.version).select("slug", "name", "kind", "overview", "context", F.coalesce("sources", F.array().cast("array<string>")).alias("sources"))


def materialise(ws: Workspace, slugs: list[str] | None = None) -> DataFrame:
    """Stores the pages that are new or differ and removes those without an entity, or looks at these pages alone: (slug, state)."""
    stored, read = ws.table("pages").read()
    new = pages(ws)
    if slugs is not None:
        stored, new = stored.where(F.col("slug").isin(slugs)), new.where(F.col("slug").isin(slugs))
    new = cut(new)
    states = cut(D.snapshot_diff(stored, new, ["slug"]))
    if not states.isEmpty():
        gone = states.where("state = 'removed'").select("slug", F.lit(True).alias("_gone"))
        put = new.join(states.where("state <> 'removed'").select("slug"), "slug").withColumn("_gone", F.lit(False))
        ws.table("pages").commit(put.unionByName(gone, allowMissingColumns=True), read)
    return states


def run_job(ws: Workspace, client: Callable[[], Client], source: str, at: str, rounds: int = 8) -> list[tuple[str, int]]:
    """What a source leads to, to its end: its statements are linked, the pages that they are about or mention generated until nothing waits, and those pages stored.

    (mode, how many) in order. Rounds are bounded; evidence beyond the cap of the last one waits for the next job. Repeated, a job does nothing.
    """
    touched = link(ws, client, [source])
    steps = [("link", touched.count())]
    links, _ = ws.table("links").read()
    named = links.where((F.col("source_id") == source) & (F.col("version") == ws.version) & F.col("entity").isNotNull()).select(F.col("entity").alias("slug"))
    own = ws.statements().where(F.col("source_id") == source).select(F.col("entity").alias("slug"))
    slugs = sorted(r["slug"] for r in own.unionByName(named).distinct().collect())  # the pages of one source
    made: set[str] = set()
    for _ in range(rounds):
        report = generate(ws, client, at, slugs)
        now = {r["slug"] for r in report.where("state = 'made'").collect()}
        steps.append(("generate", len(now)))
        made |= now
        if not now:
            break
    if made:
        steps.append(("materialise", materialise(ws, sorted(made)).count()))
    return steps
