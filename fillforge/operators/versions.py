"""A table as immutable versions and a pointer that moves by compare-and-swap."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from fillforge.operators.mutate import snapshot_changes
from fillforge.sources.files import Folder, Taken


class Conflict(Exception):
    """The table has moved on since the version that a write was based on."""


class Versions:
    """Snapshots below one folder: data/<id> holds the rows of a version and never changes, commits/<n> names the folder of
    version n, pins/ the versions that readers hold. The newest commit is the pointer; 0 is the table before any.

    A commit's name can be taken once, so of two writers that both build on version n one makes n + 1 and the other gets
    Conflict; it may read again and retry (update()). Rows are written before the pointer moves: a writer that dies leaves a
    folder that no commit names (see orphans()).
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.folder = spark, Folder(spark, path)

    def numbers(self) -> list[int]:
        return [int(n) for n in self.folder.names("commits")]

    def current(self) -> int:
        return max(self.numbers(), default=0)

    def info(self, number: int) -> dict:
        """data, rows and base of a version; KeyError if it is unknown or removed."""
        if not self.folder.exists(f"commits/{number:012d}"):
            raise KeyError(f"version {number}")
        return self.folder.read(f"commits/{number:012d}")

    def read(self, number: int | None = None) -> DataFrame:
        """A version's rows, of the current one by default. The DataFrame stays at that version whatever is committed."""
        return self.spark.read.parquet(f"{self.folder.path}/data/{self.info(self.current() if number is None else number)['data']}")

    def commit(self, rows: DataFrame, base: int, unless_empty: bool = True) -> int:
        """Writes rows as the version after base and returns its number. An empty result leaves the table at base, unless
        unless_empty is False. The rows are counted by the write itself."""
        data, seen = uuid.uuid4().hex, Observation()
        rows.observe(seen, F.count(F.lit(1)).alias("n")).write.parquet(f"{self.folder.path}/data/{data}")
        n = seen.get.get("n", 0)
        if not n and unless_empty:
            self.folder.delete(f"data/{data}")
            return base
        if self.current() == base:
            try:
                self.folder.write(f"commits/{base + 1:012d}", {"data": data, "rows": n, "base": base})
                return base + 1
            except Taken:
                pass
        self.folder.delete(f"data/{data}")
        raise Conflict(f"version {base} is not the newest any more")

    def update(self, change: Callable[[DataFrame | None], DataFrame], attempts: int = 5) -> int:
        """Commits change(current rows, or None before any), anew from the newest version after each conflict."""
        for left in reversed(range(attempts)):
            base = self.current()
            with self.pinned(base) as old:
                try:
                    return self.commit(change(old), base)
                except Conflict:
                    if not left:
                        raise
        raise ValueError("attempts must be 1 or more")

    @contextmanager
    def pinned(self, number: int | None = None) -> Iterator[DataFrame | None]:
        """A version's rows for as long as the block runs: clean() leaves it alone."""
        number = self.current() if number is None else number
        pin = f"pins/{number:012d}-{uuid.uuid4().hex}"
        self.folder.write(pin, {})
        try:
            yield self.read(number) if number else None
        finally:
            self.folder.delete(pin)

    def changes(self, old: int, new: int, key: str) -> DataFrame:
        """The change feed from one version to another."""
        return snapshot_changes(self.read(old), self.read(new), key)

    def clean(self, keep: int = 2) -> list[int]:
        """Removes all but the newest `keep` versions and those that are pinned. Returns the removed ones."""
        numbers = self.numbers()
        held = {int(p.split("-")[0]) for p in self.folder.names("pins")}
        gone = [n for n in numbers[: max(0, len(numbers) - max(1, keep))] if n not in held]
        for n in gone:
            data = self.info(n)["data"]
            self.folder.delete(f"commits/{n:012d}")
            self.folder.delete(f"data/{data}")
        return gone

    def orphans(self) -> list[str]:
        """Data folders that no commit names: of writers that died, or of such as are still writing."""
        named = {self.info(n)["data"] for n in self.numbers()}
        return [d for d in self.folder.names("data") if d not in named]
