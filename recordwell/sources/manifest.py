"""Numbered states of a folder: small files that appear whole or not at all.

A state is one JSON file. It is written under a name of its own and then renamed, without overwriting, to the
next number: readers see the last complete state, and of two writers that started from the same state one fails.
Whatever a job wrote before its state was committed is invisible if the job dies.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import SparkSession


class Conflict(RuntimeError):
    """Another writer committed the state first."""


class Manifest:
    """The states in ``path``, any folder that Spark can reach."""

    def __init__(self, spark: SparkSession, path: str):
        sc = spark.sparkContext
        self._jvm, self._gateway = sc._jvm, sc._gateway
        self._conf = sc._jsc.hadoopConfiguration()
        self._folder = self._jvm.org.apache.hadoop.fs.Path(path)
        self._fs = self._folder.getFileSystem(self._conf)

    def _file(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(self._folder, name)

    def numbers(self) -> list[int]:
        """The committed states, oldest first."""
        if not self._fs.exists(self._folder):
            return []
        names = [status.getPath().getName() for status in self._fs.listStatus(self._folder)]
        return sorted(int(name.removesuffix(".json")) for name in names if name.endswith(".json") and name[0].isdigit())

    def read(self, number: int) -> dict:
        stream = self._fs.open(self._file(f"{number:012d}.json"))
        try:
            return json.loads(self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def latest(self) -> tuple[int, dict]:
        """The number and content of the last state; 0 and nothing before the first."""
        numbers = self.numbers()
        return (numbers[-1], self.read(numbers[-1])) if numbers else (0, {})

    def commit(self, number: int, content: dict) -> None:
        """Make ``content`` state ``number``; fails if that state is there."""
        self._fs.mkdirs(self._folder)
        own = self._file(f"_{uuid.uuid4().hex}")
        stream = self._fs.create(own, False)
        try:
            stream.write(bytearray(json.dumps(content).encode()))
        finally:
            stream.close()
        files = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._folder.toUri(), self._conf)
        plain = self._gateway.new_array(self._jvm.org.apache.hadoop.fs.Options.Rename, 0)
        try:
            files.rename(own, self._file(f"{number:012d}.json"), plain)
        except Exception as problem:
            self._fs.delete(own, False)
            if number in self.numbers():
                raise Conflict(f"state {number} is committed already") from problem
            raise

    def remove(self, path: str) -> None:
        """Delete a folder that no state names any more."""
        self._fs.delete(self._jvm.org.apache.hadoop.fs.Path(path), True)
