"""Reading a corpus: nine tables as Parquet or as one JSON export, markdown folders, and state that may not exist yet."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: The corpus tables' columns.
SCHEMAS: dict[str, str] = {
    "entities": "id string, slug string, canonical_name string, kind string, overview_md string, status string, external_origin map<string,string>, aliases array<string>",
    "instructors": "id string, slug string, canonical_name string, background_md string, teaching_themes_md string, notable_framings_md string, aliases array<string>",
    "sources": "id string, transcript_id string, title string, session_date date, session_type string, instructors_raw array<string>, students_raw array<string>, organization string, visibility string, is_default_visible boolean, created_at timestamp",
    "attributions": "id string, source_id string, entity_id string, instructor_id string, attribution_kind string, prose string, raw_term string, position int, drill_goal string, drill_steps array<string>, mistake_text string, correction_text string, origin string",
    "definitions": "id string, entity_id string, source_id string, instructor_id string, term string, definition string, position int, origin string",
    "relations": "id string, from_entity_id string, to_entity_id string, source_id string, relation_kind string, prose string, origin string",
    "drill_purposes": "id string, drill_entity_id string, source_id string, skill_name string, skill_slug string, prose string, focus_context string, origin string",
    "technique_requirements": "id string, technique_entity_id string, source_id string, skill_name string, skill_slug string, prose string, origin string",
    "references": "id string, source_id string, referenced_name string, context string, ref_type string, origin string, created_at timestamp",
}


class EmptyCorpusError(ValueError):
    """The corpus has no entities or no sources, so nothing may be written from it."""


def read_export(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """The tables of one JSON export, each with _ord, a row's place in its array."""
    schema = ", ".join(f"`{name}` array<struct<{', '.join(f'{f.name}: {f.dataType.simpleString()}' for f in T.StructType.fromDDL(ddl))}>>" for name, ddl in SCHEMAS.items())
    raw = spark.read.schema(f"exported_at timestamp, {schema}").json(path, multiLine=True)
    return {name: raw.select(F.posexplode_outer(name).alias("_ord", "_r")).where("_r is not null").select("_r.*", F.col("_ord").cast("long").alias("_ord")) for name in SCHEMAS}


def read_tables(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The tables of a folder of Parquet, empty where a table is missing."""
    return {name: read_state(spark, f"{folder}/{name}.parquet", ddl) for name, ddl in SCHEMAS.items()}


def read_state(spark: SparkSession, path: str, ddl: str, required: bool = False, form: str = "parquet") -> DataFrame:
    """A table, or an empty one of this schema if there is none and it is not required."""
    try:
        return spark.read.format(form).schema(ddl).load(path)
    except AnalysisException as e:
        if required or "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], ddl)


def require_corpus(tables: dict[str, DataFrame]) -> None:
    """Refuses a corpus without entities or sources, before anything is written."""
    for name in ("entities", "sources"):
        if tables[name].isEmpty():
            raise EmptyCorpusError(f"the corpus has no {name}")


def read_pages(spark: SparkSession, folder: str) -> DataFrame:
    """(path, text) of all markdown files under a folder."""
    return spark.read.text(folder, wholetext=True, pathGlobFilter="*.md", recursiveFileLookup=True).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text"))


def unknown_fields(wanted: T.StructType, found: T.StructType, at: str = "") -> list[str]:
    """Paths of the fields that found has and wanted has not, at any depth."""
    out = []
    known = {f.name: f.dataType for f in wanted}
    for f in found:
        path = f"{at}{f.name}"
        if f.name not in known:
            out.append(path)
            continue
        a, b = known[f.name], f.dataType
        while isinstance(a, (T.ArrayType, T.MapType)) and type(a) is type(b):
            a, b = (a.elementType, b.elementType) if isinstance(a, T.ArrayType) else (a.valueType, b.valueType)
        if isinstance(a, T.StructType) and isinstance(b, T.StructType):
            out += unknown_fields(a, b, f"{path}.")
    return out
