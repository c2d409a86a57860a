"""Upserts kept as batches and merged level by level.

Every batch stores the rows it changed in a folder of its own. When a level has ``fanout``
folders they are merged into one of the next level: the newest row of every key, clustered by
key. A reader so opens at most ``fanout`` - 1 folders a level, of about log(batches) levels, and
a row is rewritten once a level.

Which folders count is told by the newest state file, put in place by one rename. A crash during
a merge leaves the old state and an unused folder, one during a batch nothing but that folder; a
batch that is replayed replaces its own.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from palimpsest.operators.latest import latest_by
from palimpsest.sources.publish import Folder

FANOUT = 4


class UpsertLog:
    def __init__(
        self, spark: SparkSession, root: str, schema: str, keys: Sequence[str], newest: Sequence[Column],
        fanout: int = FANOUT,
    ):
        """``newest`` orders the rows of a key, the one that counts first."""
        self.spark, self.root, self.schema = spark, root.rstrip("/"), schema
        self.keys, self.newest, self.fanout = list(keys), list(newest), fanout
        self.states = Folder(spark, f"{self.root}/_state")

    def levels(self) -> list[list[str]]:
        """Folder names by level, the youngest level first."""
        found = [n for n in self.states.names() if n.endswith(".json") and n[0] != "_"]
        return json.loads(self.states.read(found[-1])) if found else []

    def _publish(self, levels: list[list[str]]) -> None:
        old = [n for n in self.states.names() if n.endswith(".json") and n[0] != "_"]
        number = int(old[-1].split(".")[0]) + 1 if old else 0
        self.states.write(f"{number:012d}.json", json.dumps(levels))
        for name in old[:-1]:  # the one before stays, for a reader that has just listed it
            self.states.remove(name)

    def _rows(self, folders: Sequence[str]) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(*[f"{self.root}/{f}" for f in folders])

    def add(self, batch: DataFrame, batch_id: int, after: Callable[[str], None] = lambda step: None) -> None:
        """Store a batch, then merge the levels that are full. ``after`` is told of each step:
        tests raise in it."""
        name, levels = f"batch-{batch_id:012d}", self.levels() or [[]]
        batch.write.mode("overwrite").parquet(f"{self.root}/{name}")
        after("written")
        if name not in levels[0]:  # a replayed batch that was merged is merged again: the same rows win
            levels[0] = [*levels[0], name]
            self._publish(levels)
        after("added")
        depth = 0
        while len(levels[depth]) >= self.fanout:
            merged = f"level-{depth + 1}-{uuid.uuid4().hex}"
            rows = latest_by(self._rows(levels[depth]), self.keys, *self.newest)
            rows.sortWithinPartitions(*self.keys).write.parquet(f"{self.root}/{merged}")
            after("merged")
            gone, above = levels[depth], levels[depth + 1] if depth + 1 < len(levels) else []
            levels = [*levels[:depth], [], [*above, merged], *levels[depth + 2:]]
            self._publish(levels)
            after("published")
            for folder in gone:
                Folder(self.spark, f"{self.root}/{folder}").remove()
            depth += 1

    def folders(self) -> list[str]:
        return [f for level in self.levels() for f in level]

    def read(self) -> DataFrame:
        """The newest row of every key."""
        folders = self.folders()
        if not folders:
            return self.spark.createDataFrame([], self.schema)
        return latest_by(self._rows(folders), self.keys, *self.newest)
