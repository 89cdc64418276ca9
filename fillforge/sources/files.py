"""Small files in the table folders: listing, and writes of which one of several rivals succeeds."""

from __future__ import annotations

import json
import os
import uuid

from pyspark.errors import PySparkException
from pyspark.sql import SparkSession


class Taken(Exception):
    """Another writer was first."""


class Folder:
    """A folder of a Hadoop file system, reached through the driver."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._hadoop = spark._jvm.org.apache.hadoop.fs
        self._conf = spark._jsc.hadoopConfiguration()
        self._fs = self._hadoop.Path(self.path).getFileSystem(self._conf)

    def at(self, name: str = ""):
        return self._hadoop.Path(f"{self.path}/{name}" if name else self.path)

    def exists(self, name: str = "") -> bool:
        return self._fs.exists(self.at(name))

    def names(self, name: str = "") -> list[str]:
        """The entries of a subfolder, none if it is missing; drafts and hidden files are left out."""
        if not self.exists(name):
            return []
        return sorted(n for s in self._fs.listStatus(self.at(name)) if not (n := s.getPath().getName()).startswith((".", "_")))

    def delete(self, name: str) -> None:
        self._fs.delete(self.at(name), True)

    def read(self, name: str) -> dict:
        stream = self._fs.open(self.at(name))
        try:
            return json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()

    def write(self, name: str, value: dict, replace: bool = False) -> None:
        """Writes value as a whole or not at all. Without replace, of several writers of one name one succeeds and the others
        get Taken: by a hard link on a local disk, elsewhere by the file system's rename, which refuses an existing name."""
        parent, _, leaf = name.rpartition("/")
        draft = f"{parent}/.{leaf}-{uuid.uuid4().hex}" if parent else f".{leaf}-{uuid.uuid4().hex}"
        stream = self._fs.create(self.at(draft), False)
        try:
            stream.write(bytearray(json.dumps(value, sort_keys=True).encode()))
        finally:
            stream.close()
        try:
            if self._fs.getUri().getScheme() == "file" and not replace:
                local = lambda n: self.at(n).toUri().getPath()
                try:
                    os.link(local(draft), local(name))
                except FileExistsError:
                    raise Taken(name) from None
                return
            rename = self._hadoop.Options.Rename
            how = self.spark.sparkContext._gateway.new_array(rename, 1)
            how[0] = rename.OVERWRITE if replace else rename.NONE
            try:
                self._hadoop.FileContext.getFileContext(self._fs.getUri(), self._conf).rename(self.at(draft), self.at(name), how)
            except Exception as e:  # the gateway's error wraps the file system's
                if self.exists(name) and not replace and not isinstance(e, PySparkException):
                    raise Taken(name) from None
                raise
        finally:
            self.delete(draft)
