"""The record of a load that is being published, and of those that were.

Pointers of tables move one by one. Before the first one moves, a record of all of them is written:
which folder each table leaves and which it goes to. It is renamed when the last one has moved. So
whoever finds a record of a load that is not finished knows that a driver died in between, and can
bring the load to its end, or back.
"""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession

from martloom.sources.staging import hadoop_path

_HISTORY = "load string, published_at string, tables map<string, struct<before string, after string>>"


@dataclass(frozen=True)
class Move:
    before: str
    after: str


@dataclass(frozen=True)
class Load:
    """One load: an id, and the folders that each of its tables moves between."""

    load: str
    tables: dict[str, Move]

    @staticmethod
    def from_json(text: str) -> Load:
        held = json.loads(text)
        return Load(held["load"], {name: Move(**move) for name, move in held["tables"].items()})


class LoadLog:
    """Records in a folder of a warehouse: `open.json` while a load is being published, then one
    file per load under `done`. A file comes into being by a rename, whole or not at all."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark = spark
        self.folder = folder
        self._open = f"{folder}/open.json"

    def _write(self, path: str, text: str) -> None:
        system, draft = hadoop_path(self.spark, f"{path}.draft")
        stream = system.create(draft, True)
        stream.write(bytearray(text.encode()))
        stream.close()
        self._rename(f"{path}.draft", path)

    def _rename(self, source: str, target: str) -> None:
        system, old = hadoop_path(self.spark, source)
        _, new = hadoop_path(self.spark, target)
        system.mkdirs(new.getParent())
        if not system.rename(old, new):
            raise OSError(f"{source} could not be renamed to {target}")

    def unfinished(self) -> Load | None:
        """The load that is being published, or was when its driver died."""
        system, where = hadoop_path(self.spark, self._open)
        if not system.exists(where):
            return None
        return Load.from_json(self.spark.read.text(self._open, wholetext=True).first()[0])

    def begin(self, load: Load) -> None:
        if self.unfinished() is not None:
            raise ValueError("another load is being published")
        self._write(self._open, json.dumps(asdict(load)))

    def finish(self, load: Load) -> None:
        """Keep the record of a load that is published as a whole."""
        # the driver may have died between the two steps below
        if not any(name.endswith(f"-{load.load}.json") for name in self.published()):
            at = datetime.now(UTC).isoformat(timespec="microseconds")
            line = json.dumps({"published_at": at, **asdict(load)})
            self._write(f"{self.folder}/done/{at.replace(':', '')}-{load.load}.json", line)
        self.forget()

    def forget(self) -> None:
        """Drop the record of a load that was taken back, or is kept elsewhere."""
        system, where = hadoop_path(self.spark, self._open)
        system.delete(where, False)

    def published(self) -> list[str]:
        """Names of the records of all published loads, in order."""
        system, where = hadoop_path(self.spark, f"{self.folder}/done")
        if not system.exists(where):
            return []
        names = [status.getPath().getName() for status in system.listStatus(where)]
        return sorted(n for n in names if n.endswith(".json"))

    def history(self) -> DataFrame:
        """(load, published_at, tables) of the loads that were published, in order."""
        if not self.published():
            return self.spark.createDataFrame([], _HISTORY)
        done = self.spark.read.schema(_HISTORY).json(f"{self.folder}/done/*.json")
        return done.orderBy("published_at")
