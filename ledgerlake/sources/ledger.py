"""Numbered entries of a folder, each number taken once: what concurrent jobs agree by.

An entry is a small JSON file ``000000000007.json``. It is written under another name first
and then put in place in one step that fails if the number is taken: a hard link on a local
file system, a rename (which never replaces a file there) on HDFS. Readers therefore see
whole entries only, and of two writers that want the same number one gets it; the other
builds its entry anew on what is there now. Object stores without such a step need a
file system in front that has one.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


class Ledger:
    def __init__(self, spark: SparkSession, folder: str):
        self.jvm = spark.sparkContext._jvm
        self.folder = self.jvm.org.apache.hadoop.fs.Path(folder)
        self.fs = self.folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(self.folder, name)

    def _numbers(self) -> list[int]:
        if not self.fs.exists(self.folder):
            return []
        names = [s.getPath().getName() for s in self.fs.listStatus(self.folder)]
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())

    def _read(self, number: int) -> dict:
        stream = self.fs.open(self._path(f"{number:012d}.json"))
        try:
            return json.loads(bytes(stream.readAllBytes()))
        finally:
            stream.close()

    def last(self) -> tuple[int, dict | None]:
        """(number, entry) of the newest entry; (0, None) of an empty ledger."""
        numbers = self._numbers()
        return (numbers[-1], self._read(numbers[-1])) if numbers else (0, None)

    def entry(self, number: int) -> dict:
        return self._read(number)

    def entries(self) -> list[dict]:
        return [self._read(n) for n in self._numbers()]

    def _take(self, number: int, entry: dict) -> bool:
        """Put ``entry`` under ``number``; False if that number is taken."""
        draft, final = self._path(f".draft-{uuid.uuid4().hex}"), self._path(f"{number:012d}.json")
        out = self.fs.create(draft, False)
        out.write(bytearray(json.dumps(entry).encode()))
        out.close()
        try:
            if self.fs.getUri().getScheme() != "file":
                return not self.fs.exists(final) and self.fs.rename(draft, final)
            place = lambda p: self.jvm.java.io.File(p.toUri().getPath()).toPath()
            self.jvm.java.nio.file.Files.createLink(place(final), place(draft))
            return True
        except Py4JJavaError as e:
            if "FileAlreadyExists" in e.java_exception.getClass().getName():
                return False
            raise
        finally:
            if self.fs.exists(draft):
                self.fs.delete(draft, False)

    def append(self, build: Callable[[dict | None], dict | None]) -> tuple[int, dict]:
        """Add the entry that ``build`` makes of the newest one (None: nothing to add, the newest one is
        returned). Where another writer was faster, ``build`` is asked again with its entry."""
        while True:
            number, newest = self.last()
            entry = build(newest)
            if entry is None:
                return number, newest
            if self._take(number + 1, entry):
                return number + 1, entry
