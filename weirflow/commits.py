"""Numbered states in one folder, each created at once by a rename."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import SparkSession


class CommitLog:
    """Small JSON states ``0000000001.json``, ``0000000002.json``, ... Readers see
    a state whole or not at all."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder
        self._paths = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._paths(folder).getFileSystem(spark._jsc.hadoopConfiguration())

    def _file(self, version: int):
        return self._paths(f"{self.folder}/{version:010d}.json")

    def versions(self) -> list[int]:
        folder = self._paths(self.folder)
        if not self._fs.exists(folder):
            return []
        names = [status.getPath().getName() for status in self._fs.listStatus(folder)]
        return sorted(int(name[:-5]) for name in names if name.endswith(".json"))

    def last(self) -> int:
        """The number of the last state; 0 before the first."""
        return max(self.versions(), default=0)

    def read(self, version: int) -> dict:
        stream = self._fs.open(self._file(version))
        try:
            text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return json.loads(text)

    def commit(self, version: int, state: dict) -> None:
        """One of two writers of the same version fails here."""
        final = self._file(version)
        draft = self._paths(f"{self.folder}/_{uuid.uuid4().hex}")
        stream = self._fs.create(draft)
        try:
            stream.write(bytearray(json.dumps(state).encode()))
        finally:
            stream.close()
        if self._fs.exists(final) or not self._fs.rename(draft, final):
            self._fs.delete(draft, False)
            raise RuntimeError(f"another merge or load has written version {version} of {self.folder}")

    def remove(self, version: int) -> None:
        self._fs.delete(self._file(version), False)
