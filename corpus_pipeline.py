"""A corpus pipeline of five stages, each over all that the one before has kept."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tesserae.llm import lines, mixing, packing, simhash, toxicity
from tesserae.llm.common import col, new_folder, passing, table, written

#: The score from which a document counts as toxic here: higher than for the query, to leave ordinary documents alone.
TOXIC = 0.5
#: Rows of texts that Spark hands to Python at once: its default of 10,000 holds a batch of long texts several times over in each worker.
ROWS_AT_ONCE = 1_000
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Meanwhile Spark hands ROWS_AT_ONCE rows to Python at once; afterwards as many as before."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    was = spark.conf.get(name)
    spark.conf.set(name, ROWS_AT_ONCE)
    try:
        yield
    finally:
        spark.conf.set(name, was)


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is under TOXIC."""
    rest = [c for c in docs.columns if c not in ("doc_id", "text")]
    rows = docs.select("doc_id", "text", F.struct(F.lit(0).alias("_"), *map(col, rest)).alias("_rest"))
    kept = toxicity.toxicity(rows, table(spark, sf_dir, "labels")).where(F.col("_score") < TOXIC)
    return kept.select(*[F.col("_rest").getField(c).alias(c) if c in rest else F.col(c) for c in docs.columns])


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that resemble an earlier line; those of which no word is left go."""
    with small_batches(spark):
        return lines.dedup_documents(docs)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of SimHash fingerprints at two differing bits or fewer, those of op8_simhash."""
    with small_batches(spark):
        return simhash.one_of_each_component(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their rate says: what is to be rarer than it is goes in part, what is to be more frequent is repeated.

    A rate's fraction is rounded by a hash of the document's id, so that the expected tokens of each domain are its target.
    """
    with small_batches(spark):
        rated = mixing.fit(docs, table(spark, sf_dir, "labels"), mixing.TARGETS)[0].rated(docs)
    dice = F.pmod(F.xxhash64(F.col("_row").getField("doc_id"), F.lit("mixing")), F.lit(1_000_000)) / 1_000_000
    times = F.floor(F.col("_rate") + dice).cast("int")
    taken = rated.select("_row", F.explode(F.when(times > 0, F.sequence(F.lit(1), times)).otherwise(F.array().cast("array<int>"))))
    return taken.select(*[F.col("_row").getField(c).alias(c) for c in docs.columns])


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the packed sequences; written here, since the size of batches is what it is when rows are made."""
    with small_batches(spark):
        return written(packing.pieces(docs), "pieces")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", without_toxic),
    ("line dedup", without_repeated_lines),
    ("near dedup", one_of_each_group),
    ("mixing", mixed),
    ("packing", packed),
]
#: Tokenizers and compressors are beyond SQL; the stages are tested against plain versions of themselves.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to documents; what a stage returns is written to the shared folder and read again for the next."""
    docs = table(spark, sf_dir, "documents").select(*map(col, COLUMNS))
    for name, stage in STAGES[:-1]:
        folder = new_folder(spark, "stage-" + name.replace(" ", "-"))
        with passing(spark), small_batches(spark):  # what the stage left in the shared folder goes once its rows are written
            docs = stage(spark, docs, sf_dir)
            docs.write.parquet(folder)
        docs = spark.read.schema(docs.schema).parquet(folder)
    return STAGES[-1][1](spark, docs, sf_dir)
