"""Replacing a range of partitions of an external table as one step.

New partitions are written beside the table, where no reader looks. A journal entry, put in
place by one rename, is the commit: it names the new location of every replaced partition and
the partitions to drop. Switching locations in the catalog comes after it and can be repeated:
whoever finds an entry, the writer, the next writer or a reader, carries it out and removes it.
A crash before the rename leaves the old partitions, a crash after it the new ones.

Entries are carried out in the order of their commits, one at a time within a driver.
"""

from __future__ import annotations

import json
import threading
import time
import uuid
from collections import defaultdict
from dataclasses import dataclass, field

from pyspark.sql import SparkSession

_LOCKS: dict[str, threading.RLock] = defaultdict(threading.RLock)


@dataclass(frozen=True)
class Switch:
    """New locations by partition value, and partition values to drop."""

    locations: dict[str, str] = field(default_factory=dict)
    dropped: list[str] = field(default_factory=list)


class Folder:
    """Files of a shared folder, through the file system that Spark uses for it."""

    def __init__(self, spark: SparkSession, path: str):
        self.jvm, self.path = spark.sparkContext._jvm, path.rstrip("/")
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        self.fs = self._at("").getFileSystem(conf)

    def _at(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)

    def names(self) -> list[str]:
        if not self.fs.exists(self._at("")):
            return []
        return sorted(s.getPath().getName() for s in self.fs.listStatus(self._at("")))

    def write(self, name: str, text: str) -> None:
        """All of the text or nothing: written aside, then renamed."""
        aside = self._at(f"_{name}.{uuid.uuid4().hex}")
        out = self.fs.create(aside, True)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()
        if not self.fs.rename(aside, self._at(name)):
            raise OSError(f"{self.path}/{name} could not be put in place")

    def read(self, name: str) -> str:
        stream = self.fs.open(self._at(name))
        try:
            return bytes(self.jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
        finally:
            stream.close()

    def remove(self, name: str = "") -> None:
        self.fs.delete(self._at(name), True)

    def take(self, name: str, other: Folder) -> None:
        """Move ``other`` here under ``name``."""
        self.fs.mkdirs(self._at(""))
        if not self.fs.rename(other._at(""), self._at(name)):
            raise OSError(f"{other.path} could not be moved to {self.path}/{name}")


def values_in(folder: Folder, column: str) -> list[str]:
    """Partition values that have a folder."""
    mark = f"{column}="
    return [n[len(mark):] for n in folder.names() if n.startswith(mark)]


class Journal:
    """The commits of a table that are still to be carried out."""

    def __init__(self, spark: SparkSession, table: str, column: str, location: str):
        self.spark, self.table, self.column = spark, table, column
        self.folder = Folder(spark, f"{location.rstrip('/')}-journal")
        self.lock = _LOCKS[self.folder.path]

    def commit(self, switch: Switch) -> None:
        with self.lock:
            self.folder.write(f"{time.time_ns():020d}.json", json.dumps(
                {"locations": switch.locations, "dropped": switch.dropped}, sort_keys=True))

    def carry_out(self, after=lambda step: None) -> None:
        """Every entry in order; safe to repeat after a crash at any place."""
        with self.lock:
            for name in [n for n in self.folder.names() if n.endswith(".json") and n[0] != "_"]:
                entry = json.loads(self.folder.read(name))
                there, locations = set(self.values()), entry["locations"]
                for value in sorted(there & locations.keys()):
                    self.spark.sql(
                        f"ALTER TABLE {self.table} PARTITION {self._partition(value)} "
                        f"SET LOCATION '{locations[value]}'")
                    after(f"switched {value}")
                if new := sorted(locations.keys() - there):
                    self.spark.sql(f"ALTER TABLE {self.table} ADD IF NOT EXISTS " + " ".join(
                        f"PARTITION {self._partition(v)} LOCATION '{locations[v]}'" for v in new))
                    after("added")
                if gone := sorted(there & set(entry["dropped"])):
                    self.spark.sql(f"ALTER TABLE {self.table} DROP IF EXISTS " + ", ".join(
                        f"PARTITION {self._partition(v)}" for v in gone))
                    after("dropped")
                self.folder.remove(name)
                self.spark.catalog.refreshTable(self.table)

    def values(self) -> list[str]:
        """Values of the partitions that the catalog has now."""
        rows = self.spark.sql(f"SHOW PARTITIONS {self.table}").collect()
        return [r[0].split("=", 1)[1] for r in rows]

    def _partition(self, value: str) -> str:
        return f"(`{self.column}` = DATE '{value}')"
