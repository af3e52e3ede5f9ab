"""Merging what a window stream has written, while it goes on.

A stream in `parts` mode writes a folder for each batch (`batch_id=N`), with many small rows for the same windows. `merge` adds up the
parts of finished batches into folders by day and names them in a new version file; `read` takes the newest version and the batches after
it. Data folders are never changed. Days that are closed end up as one folder each; parts that come for them later make a further
folder, which the next run merges again.

A run that ends at any point leaves the old version in force, and the next one starts anew. What a version no longer needs is deleted one
version later, so that a reader who has just listed its files can finish. There must be one merging run at a time.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FOLDER = "_merged"
#: Folder for parts of windows without a time.
NO_DAY = "none"


@dataclass(frozen=True)
class Version:
    """What has been merged: batches up to `upto`, and the folders that hold them by day."""

    number: int = 0
    upto: int = -1
    days: dict[str, list[str]] = field(default_factory=dict)

    def folders(self) -> set[str]:
        return {folder for folders in self.days.values() for folder in folders}


class _Files:
    """The file system that a folder lies in, as Spark sees it."""

    def __init__(self, spark: SparkSession, path: str):
        self.path = path.rstrip("/")
        self._new = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._new(self.path).getFileSystem(spark._jsc.hadoopConfiguration())
        self._jvm = spark._jvm

    def names(self, folder: str = "") -> list[str]:
        at = self._new(f"{self.path}/{folder}" if folder else self.path)
        return [entry.getPath().getName() for entry in self._fs.listStatus(at)] if self._fs.exists(at) else []

    def read(self, name: str) -> str:
        stream = self._fs.open(self._new(f"{self.path}/{name}"))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def publish(self, name: str, text: str) -> None:
        """Writes a file aside and renames it, so that it is there as a whole or not at all. An existing one stays."""
        aside = self._new(f"{self.path}/{FOLDER}/_{uuid.uuid4().hex}")
        stream = self._fs.create(aside, True)
        stream.write(bytearray(text.encode()))
        stream.close()
        target = self._new(f"{self.path}/{name}")
        if self._fs.exists(target) or not self._fs.rename(aside, target):
            self._fs.delete(aside, False)
            raise RuntimeError(f"{name} exists: another run is merging the same folder")

    def delete(self, name: str) -> None:
        self._fs.delete(self._new(f"{self.path}/{name}"), True)


def _versions(files: _Files) -> list[Version]:
    """The newest two versions, the newest first."""
    names = sorted((name for name in files.names(FOLDER) if name.endswith(".json")), reverse=True)[:2]
    return [Version(**json.loads(files.read(f"{FOLDER}/{name}"))) for name in names]


def current(spark: SparkSession, path: str) -> Version:
    return next(iter(_versions(_Files(spark, path))), Version())


def _batches(files: _Files) -> list[int]:
    """Batches that have been written as a whole."""
    found = [int(name.split("=")[1]) for name in files.names() if name.startswith("batch_id=")]
    return sorted(batch for batch in found if "_SUCCESS" in files.names(f"batch_id={batch}"))


def read(spark: SparkSession, path: str) -> DataFrame:
    """All parts: those of the newest version, and those of later batches."""
    files = _Files(spark, path)
    version = current(spark, path)
    paths = [f"{path}/{FOLDER}/{folder}/day={day}" for day, folders in version.days.items() for folder in folders]
    paths += [f"{path}/batch_id={batch}" for batch in _batches(files) if batch > version.upto]
    return spark.read.parquet(*paths) if paths else spark.read.parquet(path)


def merge(
    spark: SparkSession, path: str, add_up: Callable[[DataFrame], DataFrame], grace: str = "1 day", batches: int = 2
) -> Version:
    """Merges finished batches, if there are at least `batches` new ones, and days that have closed. Gives the version in force.

    `add_up` makes parts of parts, such as `summaries.added_metric_parts`. A day is closed `grace` after its end, by the newest
    window that has been written. The newest batch is left out, as it may be one that the stream repeats.
    """
    files = _Files(spark, path)
    versions = _versions(files)
    old = versions[0] if versions else Version()
    _clean(files, versions)
    new = [batch for batch in _batches(files)[:-1] if batch > old.upto]
    if len(new) < batches:
        return old

    rows = spark.read.parquet(*[f"{path}/batch_id={batch}" for batch in new])
    day = F.coalesce(F.date_format("window_start", "yyyy-MM-dd"), F.lit(NO_DAY))
    days = {name: list(folders) for name, folders in old.days.items()}
    # One row for each day that the new batches hold.
    added = {row.day for row in rows.select(day.alias("day")).distinct().collect()}
    newest = max([name for name in added | set(days) if name != NO_DAY], default=None)
    whole = set()
    if newest is not None:
        ends = spark.createDataFrame([(name,) for name in added | set(days) if name != NO_DAY], "day string")
        closed = ends.where(F.expr(f"to_timestamp(day) + INTERVAL 1 DAY + INTERVAL {grace} <= to_timestamp('{newest}')"))
        whole = {row.day for row in closed.collect()}
    # A closed day becomes one folder: what it has been merged to before is added to its new parts.
    again = {name for name in whole if len(days.get(name, [])) + (name in added) > 1}
    before = [f"{path}/{FOLDER}/{folder}/day={name}" for name in sorted(again) for folder in days.get(name, [])]
    if before:
        rows = rows.unionByName(spark.read.schema(rows.schema).parquet(*before))
    folder = f"parts-{uuid.uuid4().hex}"
    summed = add_up(rows).withColumn("day", day)
    # A day's windows go to one task each; it writes one file.
    summed.repartition("day").write.partitionBy("day").parquet(f"{path}/{FOLDER}/{folder}")
    for name in added | again:
        days[name] = [folder] if name in again else [*days.get(name, []), folder]
    version = Version(old.number + 1, new[-1], days)
    files.publish(f"{FOLDER}/{version.number:010d}.json", json.dumps(version.__dict__))
    return version


def _clean(files: _Files, versions: list[Version]) -> None:
    """Deletes what neither of the newest two versions reads, and what a run that ended early has left."""
    if not versions:
        return
    used = set().union(*(version.folders() for version in versions))
    for name in files.names(FOLDER):
        if (name.startswith("parts-") and name not in used) or name.startswith("_"):
            files.delete(f"{FOLDER}/{name}")
        elif name.endswith(".json") and int(name[:-5]) < versions[-1].number:
            files.delete(f"{FOLDER}/{name}")
    if len(versions) > 1:
        for batch in _batches(files):
            if batch <= versions[1].upto:
                files.delete(f"batch_id={batch}")
