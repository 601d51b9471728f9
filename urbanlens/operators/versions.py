"""A log of a dataset's versions.

Each version is one small JSON file named by its number. A writer that started from
version n publishes n + 1 by renaming a finished file to that name, which fails if the
name is taken: numbers grow without a clock, readers see whole versions only, and of two
writers that started from the same version one is told to start again.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark.sql import SparkSession


class VersionConflict(RuntimeError):
    """Another writer has published the next version first."""


@dataclass(frozen=True)
class Version:
    number: int
    body: dict


class VersionLog:
    def __init__(self, spark: SparkSession, path: str):
        self.path = path.rstrip("/")
        self._jvm = spark.sparkContext._jvm
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()
        self._gateway = spark.sparkContext._gateway
        self._fs = self._at("").getFileSystem(self._conf)

    def _at(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)

    def numbers(self) -> list[int]:
        if not self._fs.exists(self._at("")):
            return []
        names = [s.getPath().getName() for s in self._fs.listStatus(self._at(""))]
        return sorted(int(n) for n in names if n.isdigit())

    def read(self, number: int) -> Version:
        stream = self._fs.open(self._at(f"{number:012d}"))
        try:
            return Version(number, json.loads(self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")))
        finally:
            stream.close()

    def newest(self) -> Version | None:
        numbers = self.numbers()
        return self.read(numbers[-1]) if numbers else None

    def append(self, body: dict, after: int) -> Version:
        """Publish version ``after + 1``; ``VersionConflict`` if it exists."""
        draft, final = self._at(f".draft-{uuid.uuid4().hex}"), self._at(f"{after + 1:012d}")
        stream = self._fs.create(draft, False)
        stream.write(json.dumps(body).encode())
        stream.close()
        context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._fs.getUri(), self._conf)
        options = self._gateway.new_array(getattr(self._jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
        try:  # without options a rename never replaces what is there
            context.rename(self._fs.makeQualified(draft), self._fs.makeQualified(final), options)
        except Exception as exc:
            self._fs.delete(draft, False)
            if after + 1 in self.numbers():
                raise VersionConflict(f"{self.path}: version {after + 1} exists") from exc
            raise
        return Version(after + 1, body)

    def push(self, body: dict) -> Version:
        """Publish ``body`` behind whatever is newest: for content that replaces all before it."""
        while True:
            try:
                return self.append(body, (self.numbers() or [0])[-1])
            except VersionConflict:
                continue
