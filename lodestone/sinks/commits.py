"""Small numbered records that appear whole or not at all: what readers look at to find the last finished run."""

from __future__ import annotations

import json
import re
import uuid
from typing import Any

from pyspark.sql import SparkSession


class ConcurrentRunError(RuntimeError):
    """Another run has published since this one began."""


class CommitLog:
    """Records `<number>.json` in a folder of any file system Spark reaches. A record is written under another name and renamed, so
    a run that dies before leaves nothing a reader would see. Renaming onto a number that is there fails: on HDFS in one step, on
    file systems that would replace it after a check."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self._jvm = spark.sparkContext._jvm
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()
        self._folder = self._path(folder)
        self._files = self._folder.getFileSystem(self._conf)

    def _path(self, name: str) -> Any:
        return self._jvm.org.apache.hadoop.fs.Path(name)

    def _record(self, number: int) -> Any:
        return self._path(f"{self._folder}/{number:012d}.json")

    def numbers(self) -> list[int]:
        if not self._files.exists(self._folder):
            return []
        names = [status.getPath().getName() for status in self._files.listStatus(self._folder)]
        return sorted(int(name[:-5]) for name in names if re.fullmatch(r"\d{12}\.json", name))

    def read(self, number: int) -> dict:
        stream = self._files.open(self._record(number))
        try:
            return json.loads(self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def latest(self) -> tuple[int, dict] | None:
        numbers = self.numbers()
        return (numbers[-1], self.read(numbers[-1])) if numbers else None

    def commit(self, number: int, record: dict) -> None:
        """Publish `record` as `number`; `ConcurrentRunError` if some run already has."""
        waiting = self._path(f"{self._folder}/.{uuid.uuid4().hex}")
        stream = self._files.create(waiting)
        try:
            stream.write(bytearray(json.dumps(record, ensure_ascii=False).encode()))
        finally:
            stream.close()
        target = self._record(number)
        if self._files.exists(target) or not self._files.rename(waiting, target):
            self._files.delete(waiting, False)
            raise ConcurrentRunError(f"{target} is there already")
