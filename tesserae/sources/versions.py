"""Tables with versions, one writer each: a write says which version it has read, and is refused if another came first.

A version is a small file of the table's log that names the folders of rows it consists of; the file is created only if it is not
there, which file systems do atomically. A write adds the rows that changed; compact() makes one folder of all.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Folders of changes from which on a write compacts the table.
CHANGES = 16


class StaleVersionError(RuntimeError):
    """Another writer has committed since this one has read."""


class VersionedTable:
    """Rows by key at a path, which all executors see. Readers get whole versions; a row with _gone true removes its key."""

    def __init__(self, spark: SparkSession, path: str, schema: str, keys: list[str]):
        self.spark, self.path, self.schema, self.keys = spark, path.rstrip("/"), schema, keys

    def _at(self, name: str):
        at = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        return at, at.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def versions(self) -> list[int]:
        at, system = self._at("log")
        return sorted(int(s.getPath().getName().split(".")[0]) for s in system.listStatus(at) if s.getPath().getName().endswith(".json")) if system.exists(at) else []

    def _folders(self, version: int) -> list[str]:
        if not version:
            return []
        return json.loads(self.spark.read.text(f"{self.path}/log/{version:09d}.json", wholetext=True).first()["value"])

    def read(self, version: int | None = None) -> tuple[DataFrame, int]:
        """The rows of a version, the newest if none is given, and its number; no rows and 0 where nothing was written. Each key's last change counts."""
        version = max(self.versions(), default=0) if version is None else version
        folders = self._folders(version)
        columns = self.spark.createDataFrame([], self.schema)
        if not folders:
            return columns, version
        parts = [self.spark.read.schema(f"{self.schema}, _gone boolean").parquet(f"{self.path}/{f}").withColumn("_v", F.lit(i)) for i, f in enumerate(folders)]
        if len(parts) == 1:
            return parts[0].where("not _gone").drop("_v", "_gone"), version
        rows = parts[0]
        for more in parts[1:]:
            rows = rows.unionByName(more)
        rest = [c for c in rows.columns if c not in self.keys]
        last = rows.groupBy(*self.keys).agg(F.max_by(F.struct(*rest), "_v").alias("_r"))
        return last.select(*self.keys, "_r.*").where("not _gone").select(*columns.columns), version

    def commit(self, changed: DataFrame, read: int, whole: bool = False) -> int:
        """Writes changed rows as the version after the one that was read, or all rows if whole; StaleVersionError if another has written that. Its number.

        Rows that a refused writer has written belong to no version, and do no harm.
        """
        folder = f"rows-{uuid.uuid4().hex}"
        rows = changed if "_gone" in changed.columns else changed.withColumn("_gone", F.lit(False))
        rows.select(*self.spark.createDataFrame([], self.schema).columns, "_gone").write.parquet(f"{self.path}/{folder}")
        folders = [folder] if whole else [*self._folders(read), folder]
        at, system = self._at(f"log/{read + 1:09d}.json")
        try:
            out = system.create(at, False)
        except Py4JJavaError as e:
            if "AlreadyExists" in str(e.java_exception):
                gone, files = self._at(folder)
                files.delete(gone, True)
                raise StaleVersionError(f"version {read + 1} was written by another") from e
            raise
        out.write(bytearray(json.dumps(folders).encode()))
        out.close()
        return self.compact(read + 1) if len(folders) > CHANGES else read + 1

    def compact(self, read: int) -> int:
        """One folder of all rows as the next version; the version that was read if another has written meanwhile."""
        try:
            return self.commit(self.read(read)[0], read, whole=True)
        except StaleVersionError:
            return read

    def update(self, change: Callable[[DataFrame], DataFrame], attempts: int = 5) -> int:
        """Commits what change makes of the rows; where another was first, reads again and repeats. Nothing is written where nothing changes."""
        for _ in range(attempts):
            rows, version = self.read()
            changed = change(rows)
            if changed.isEmpty():
                return version
            try:
                return self.commit(changed, version)
            except StaleVersionError:
                continue
        raise StaleVersionError(f"{attempts} attempts were all too late")
