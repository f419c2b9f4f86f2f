"""Versioned tables: data in folders of their own, and numbered commit files that say which folders make up a version.

A writer writes a new folder first and its commit last. A commit file is created only if none of its number
exists, so of two writers that began from one version the later fails, and a writer that dies before its commit leaves
the table as it was. A reader is bound to the folders of the version it asked for, whatever is committed later.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


class ConflictError(RuntimeError):
    """Another writer committed the next version first."""


@dataclass(frozen=True)
class Version:
    number: int
    folders: tuple[str, ...]  # relative to the table's path
    runs: dict[str, str | None] = field(default_factory=dict)  # runs that were appended, and their folder (None: no rows)
    batches: dict[str, int] = field(default_factory=dict)  # per stream the last batch applied


EMPTY = Version(0, ())


class VersionedTable:
    """A table at ``path`` (any file system Spark reads) with rows of ``schema``."""

    def __init__(self, spark: SparkSession, path: str, schema: StructType) -> None:
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema
        jvm = spark._jvm
        self._at = jvm.org.apache.hadoop.fs.Path
        self._files = self._at(self.path).getFileSystem(spark._jsc.hadoopConfiguration())

    def _commit_path(self, number: int):
        return self._at(f"{self.path}/_commits/{number:012d}.json")

    def versions(self) -> list[int]:
        """Committed numbers, the oldest first."""
        where = self._at(f"{self.path}/_commits")
        if not self._files.exists(where):
            return []
        names = [s.getPath().getName() for s in self._files.listStatus(where)]
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())

    def version(self, number: int | None = None) -> Version:
        """The version of that number; the newest by default, and the empty version 0 before any commit."""
        if number is None:
            number = max(self.versions(), default=0)
        if number == 0:
            return EMPTY
        stream = self._files.open(self._commit_path(number))
        try:
            text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        said = json.loads(text)
        return Version(number, tuple(said["folders"]), said["runs"], said["batches"])

    def read(self, version: Version | None = None) -> DataFrame:
        """The rows of a version, the newest by default."""
        return self._read((version or self.version()).folders)

    def _read(self, folders) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*[f"{self.path}/{f}" for f in folders])

    def read_run(self, run: str) -> DataFrame:
        """The rows that a run appended."""
        folder = self.version().runs[run]
        return self._read([folder] if folder else [])

    def _write(self, rows: DataFrame) -> str:
        folder = f"data/{uuid.uuid4().hex}"
        rows.select(*self.schema.fieldNames()).write.mode("errorifexists").parquet(f"{self.path}/{folder}")
        return folder

    def _commit(self, version: Version) -> Version:
        body = {"folders": list(version.folders), "runs": version.runs, "batches": version.batches}
        try:
            out = self._files.create(self._commit_path(version.number), False)
        except Py4JJavaError as error:
            if self._files.exists(self._commit_path(version.number)):
                raise ConflictError(f"Version {version.number} of {self.path} exists.") from error
            raise
        out.write(json.dumps(body).encode())
        out.close()
        return version

    def replace(self, rows: DataFrame, base: Version | None = None, batches: dict[str, int] | None = None) -> Version:
        """Commit ``rows`` as the state that follows ``base``, the newest version by default."""
        base = base or self.version()
        return self._commit(Version(base.number + 1, (self._write(rows),), base.runs, base.batches | (batches or {})))

    def update(self, change: Callable[[DataFrame], DataFrame]) -> Version:
        """Commit ``change(current rows)``; a conflict raises, and then nothing was changed."""
        base = self.version()
        return self.replace(change(self.read(base)), base)

    def append(self, rows: DataFrame, run: str) -> Version:
        """Commit ``rows`` beside the present ones, once per ``run``: a run names the input it read, and one that has been
        committed is not written again."""
        base = self.version()
        if run in base.runs:
            return base
        folder = self._write(rows)
        empty = self._read([folder]).isEmpty()
        folders = base.folders if empty else (*base.folders, folder)
        return self._commit(Version(base.number + 1, folders, base.runs | {run: None if empty else folder}, base.batches))

    def apply_batch(self, stream: str, batch_id: int, change: Callable[[DataFrame], DataFrame]) -> Version:
        """``update`` by a numbered batch of a stream, once: a batch that has been applied is left out when it is replayed."""
        base = self.version()
        if base.batches.get(stream, -1) >= batch_id:
            return base
        return self.replace(change(self.read(base)), base, {stream: batch_id})
