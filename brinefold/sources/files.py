"""Small files on whatever file system Spark reaches."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar

from pyspark.sql import SparkSession

A, B = TypeVar("A"), TypeVar("B")
#: Calls to the file system that are under way at once where many are needed.
AT_ONCE = 16


class Files:
    def __init__(self, spark: SparkSession):
        self._jvm, self._conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()

    def _at(self, path: str):
        where = self._jvm.org.apache.hadoop.fs.Path(path)
        return where.getFileSystem(self._conf), where

    @staticmethod
    def each(call: Callable[[A], B], items: Iterable[A]) -> list[B]:
        """What ``call`` gives for each item, in their order; calls wait for the file system side by side."""
        held = list(items)
        if len(held) < 2:
            return [call(x) for x in held]
        with ThreadPoolExecutor(min(AT_ONCE, len(held))) as pool:
            return list(pool.map(call, held))

    def exists(self, path: str) -> bool:
        system, where = self._at(path)
        return system.exists(where)

    def read(self, path: str) -> str | None:
        system, where = self._at(path)
        if not system.exists(where):
            return None
        stream = system.open(where)
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def create(self, path: str, text: str) -> bool:
        """Write a file unless it is there; whether this call made it.

        Between two writers at once the file system decides: it needs a rename that refuses an existing target, as
        HDFS has. Object stores without one need a table format or a lock in front of them.
        """
        system, where = self._at(path)
        if system.exists(where):
            return False
        spare = self._jvm.org.apache.hadoop.fs.Path(f"{path}.{self._jvm.java.util.UUID.randomUUID()}")
        stream = system.create(spare, False)
        stream.write(bytearray(text.encode()))
        stream.close()
        if not system.exists(where) and system.rename(spare, where):
            return True
        system.delete(spare, False)
        return False

    def replace(self, path: str, text: str) -> None:
        system, where = self._at(path)
        stream = system.create(where, True)
        stream.write(bytearray(text.encode()))
        stream.close()

    def make(self, path: str) -> None:
        system, where = self._at(path)
        system.mkdirs(where)

    def names(self, path: str) -> list[str]:
        system, where = self._at(path)
        return sorted(s.getPath().getName() for s in system.listStatus(where)) if system.exists(where) else []

    def delete(self, path: str) -> None:
        system, where = self._at(path)
        system.delete(where, True)

    def move(self, source: str, target: str) -> None:
        system, where = self._at(source)
        there = self._jvm.org.apache.hadoop.fs.Path(target)
        system.mkdirs(there.getParent())
        if not system.rename(where, there):
            raise OSError(f"{source} can't be moved to {target}")
