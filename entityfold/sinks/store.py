"""Small files and folders in whatever store a path names, and work that is done step by step."""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping

from pyspark.sql import SparkSession

from entityfold.operators.gates import GateError


class Store:
    """The file system of a path, through Spark's own connectors."""

    def __init__(self, spark: SparkSession, path: str):
        self._jvm = spark.sparkContext._jvm
        self._fs = self._path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _path(self, path: str):
        return self._jvm.org.apache.hadoop.fs.Path(path)

    def exists(self, path: str) -> bool:
        return self._fs.exists(self._path(path))

    def changed(self, path: str) -> int | None:
        """When a file or folder was last changed; None if there is none."""
        return self._fs.getFileStatus(self._path(path)).getModificationTime() if self.exists(path) else None

    def delete(self, path: str) -> None:
        self._fs.delete(self._path(path), True)

    def rename(self, path: str, target: str) -> None:
        parent = self._path(target).getParent()
        self._fs.mkdirs(parent)
        if self.exists(target) or not self._fs.rename(self._path(path), self._path(target)):
            raise GateError(f"{target} can't be put in place")

    def write(self, path: str, content: str) -> None:
        """A small text file, replaced if it is there."""
        stream = self._fs.create(self._path(path), True)
        try:
            stream.write(bytearray(content.encode("utf-8")))
        finally:
            stream.close()

    def read(self, path: str) -> str | None:
        """The content of a small text file; None if there is none."""
        if not self.exists(path):
            return None
        stream = self._fs.open(self._path(path))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()


class Steps:
    """Steps that write under one folder. A step that is marked as done, with the same settings and
    after the same steps, is not done again; what an unmarked step left behind is dropped.
    """

    def __init__(self, store: Store, folder: str, settings: Mapping[str, object]):
        self.store, self.folder = store, folder
        self.seen = [dict(settings)]
        self.redo = False

    def _mark(self, name: str) -> str:
        return f"{self.folder}/_steps/{name}.json"

    def run(self, name: str, target: str, write: Callable[[], object], **settings: object) -> None:
        """Have ``write`` fill ``target``, unless that is done already."""
        self.seen.append({"step": name, "target": target, **settings})
        wanted = json.dumps(self.seen, sort_keys=True, default=str)
        done = self.store.read(self._mark(name)) == wanted and self.store.exists(target)
        self.redo = self.redo or not done
        if self.redo:
            self.store.delete(self._mark(name))
            self.store.delete(target)
            write()
            self.store.write(self._mark(name), wanted)
