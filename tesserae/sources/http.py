"""A corpus over HTTP: tables as JSON lines, read again only if they have changed; and a sink that posts rows in chunks.

Both are Spark data sources: register(spark), then spark.read.format("tesserae_http") and df.write.format("tesserae_post").
"""

from __future__ import annotations

import datetime as dt
import hashlib
import json
import time
import urllib.error
import urllib.request
import uuid
from collections.abc import Iterator

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, InputPartition, WriterCommitMessage
from pyspark.sql.types import Row, StructType

from ..operators import diff as D
from .tables import SCHEMAS

#: Rows of one request: pages, removals and entries of a state; and after how many entries or seconds these are sent.
PAGES, REMOVALS, ENTRIES, FLUSH_ENTRIES, FLUSH_SECONDS = 50, 500, 250, 100, 20.0
TIMEOUT = 60


def _folder(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri("file://" + uri[5:] if uri.startswith("file:/") and "://" not in uri else uri)


def _value(v, kind: str):
    if v is None or kind not in ("date", "timestamp"):
        return v
    at = dt.datetime.fromisoformat(v)
    return at.date() if kind == "date" else at


class HttpReader(DataSourceReader):
    """Reads url/table, or where it is served in parts url/table?part=i&parts=n, a part in a task, line by line.

    With a cache folder, which all executors see, the stored copy's tag is sent along; where the server answers 304 the copy is read.
    """

    def __init__(self, schema: StructType, options: dict):
        self.fields, self.options = [(f.name, f.dataType.typeName()) for f in schema.fields], dict(options)

    def partitions(self) -> list[InputPartition]:
        return [InputPartition(i) for i in range(int(self.options.get("parts", 1)))]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        for line in self._lines(partition.value):
            if line.strip():
                row = json.loads(line)
                yield tuple(_value(row.get(n), kind) for n, kind in self.fields)

    def _lines(self, part: int) -> Iterator[bytes]:
        o, parts = self.options, int(self.options.get("parts", 1))
        url = f"{o['url'].rstrip('/')}/{o['table']}" + (f"?part={part}&parts={parts}" if parts > 1 else "")
        if "cache" not in o:
            with urllib.request.urlopen(url, timeout=TIMEOUT) as got:
                yield from got
            return
        system, root = _folder(o["cache"])
        base = f"{root}/{hashlib.sha256(url.encode()).hexdigest()[:24]}"
        system.create_dir(root, recursive=True)
        tag, copy = self._stored(system, base)
        try:
            with urllib.request.urlopen(urllib.request.Request(url, headers={"If-None-Match": tag} if tag else {}), timeout=TIMEOUT) as got:
                # a copy of its own name first, and only then the file that points to it: another reader never sees half of one
                new, copy = got.headers.get("ETag"), f"{base}-{uuid.uuid4().hex}.jsonl"
                with system.open_output_stream(copy) as out:
                    while block := got.read(1 << 20):
                        out.write(block)
            if new:
                written = f"{base}-{uuid.uuid4().hex}.tmp"
                with system.open_output_stream(written) as out:
                    out.write(json.dumps({"tag": new, "copy": copy}).encode())
                system.move(written, f"{base}.json")
        except urllib.error.HTTPError as e:
            if e.code != 304 or copy is None:
                raise
        with system.open_input_file(copy) as file:
            yield from _split(file)

    @staticmethod
    def _stored(system: fs.FileSystem, base: str) -> tuple[str | None, str | None]:
        if system.get_file_info(f"{base}.json").type == fs.FileType.NotFound:
            return None, None
        with system.open_input_file(f"{base}.json") as file:
            kept = json.loads(file.read())
        there = system.get_file_info(kept["copy"]).type == fs.FileType.File
        return (kept["tag"], kept["copy"]) if there else (None, None)


def _split(file) -> Iterator[bytes]:
    rest = b""
    while block := file.read(1 << 20):
        *lines, rest = (rest + block).split(b"\n")
        yield from lines
    yield rest


class HttpSource(DataSource):
    """Options: url, table, and optionally parts and cache."""

    @classmethod
    def name(cls) -> str:
        return "tesserae_http"

    def schema(self) -> str:
        return SCHEMAS[self.options["table"]]

    def reader(self, schema: StructType) -> DataSourceReader:
        return HttpReader(schema, self.options)


class PostWriter(DataSourceWriter):
    """Posts rows as JSON arrays of at most `chunk` rows, as soon as `flush` are held or `seconds` have passed; what a refused chunk's task had sent stays."""

    def __init__(self, options: dict):
        self.options = dict(options)

    def write(self, rows: Iterator[Row]) -> WriterCommitMessage:
        o = self.options
        chunk, flush, seconds = int(o.get("chunk", ENTRIES)), int(o.get("flush", FLUSH_ENTRIES)), float(o.get("seconds", FLUSH_SECONDS))
        held, last = [], time.monotonic()
        for row in rows:
            held.append(row.asDict(recursive=True))
            if len(held) >= flush or time.monotonic() - last >= seconds:
                self._post(held, chunk)
                held, last = [], time.monotonic()
        self._post(held, chunk)
        return WriterCommitMessage()

    def _post(self, rows: list[dict], chunk: int) -> None:
        for i in range(0, len(rows), chunk):
            body = json.dumps(rows[i : i + chunk], default=str, ensure_ascii=False).encode()
            ask = urllib.request.Request(self.options["url"], body, {"Content-Type": "application/json"}, method=self.options.get("method", "PUT"))
            with urllib.request.urlopen(ask, timeout=TIMEOUT) as got:
                got.read()


class PostSink(DataSource):
    """Options: url, and optionally chunk, flush, seconds and method."""

    @classmethod
    def name(cls) -> str:
        return "tesserae_post"

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceWriter:
        return PostWriter(self.options)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(HttpSource)
    spark.dataSource.register(PostSink)


def read_corpus(spark: SparkSession, url: str, cache: str | None = None, parts: int = 1) -> dict[str, DataFrame]:
    """The corpus tables at a URL, one reader for each part of each."""
    register(spark)
    options = {"url": url, "parts": str(parts)} | ({"cache": cache} if cache else {})
    return {name: spark.read.format("tesserae_http").options(table=name, **options).load() for name in SCHEMAS}


def _post(rows: DataFrame, url: str, key: str, chunk: int, flush: int, seconds: float) -> None:
    sorted_rows = rows.repartitionByRange(F.col(key)).sortWithinPartitions(key)
    sorted_rows.write.format("tesserae_post").mode("append").options(url=url, chunk=str(chunk), flush=str(flush), seconds=str(seconds)).save()


def post_pages(old: DataFrame, new: DataFrame, key: str, url: str, pages: int = PAGES, removals: int = REMOVALS) -> DataFrame:
    """Puts created and changed pages to url/pages, and only once all of these are taken the keys of removed ones to url/removals: (state, count).

    A refused chunk fails the job; what was sent before stays sent, nothing is removed then, and a page that is sent again is the same page.
    """
    register(old.sparkSession)
    states = D.snapshot_diff(old, new, [key], unchanged=True).persist()
    try:
        changed = new.join(states.where(F.col("state").isin("created", "changed")).select(key), key, "left_semi")
        _post(changed, f"{url}/pages", key, pages, pages, FLUSH_SECONDS)
        _post(states.where("state = 'removed'").select(key), f"{url}/removals", key, removals, removals, FLUSH_SECONDS)
        counts = states.groupBy("state").count().collect()  # four rows at most
    finally:
        states.unpersist()
    return old.sparkSession.createDataFrame(counts, "state string, count long")


def post_delta(old: DataFrame, new: DataFrame, keys: list[str], url: str) -> None:
    """Puts the entries of a state that are new or differ, flushed at 100 of them or after 20 seconds, 250 to a request at most."""
    register(old.sparkSession)
    _post(D.delta(old, new, keys), url, keys[0], ENTRIES, FLUSH_ENTRIES, FLUSH_SECONDS)


def post_state(rows: DataFrame, key: str, url: str) -> None:
    """Puts a whole table in the order of its key, 250 rows to a request: a bulk import, which may be repeated."""
    register(rows.sparkSession)
    _post(rows, url, key, ENTRIES, ENTRIES, FLUSH_SECONDS)
