"""Closed windows that lose no row: each window is written once, and what comes too late for it goes to a side table.

A batch adds its samples to the windows that are still open, which are kept as one small Parquet folder for each batch. Windows that
end `delay` before the newest sample are written as closed. A sample whose window has been closed before its batch
began, one without a time and one from a clock that runs ahead go to the side table, with the cause. So closed windows, open ones
and the side table together hold every sample once.

All folders are named by batch, and the file that completes a batch is written last. A batch that is repeated replaces what it had
written from the open windows of the batch before, so it gives the same again.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators import summaries
from .parts import FOLDER, _Files

LATE, TIMELESS, AHEAD = "late", "timeless", "ahead"


def _done(files: _Files) -> list[int]:
    return sorted(int(name[:-5]) for name in files.names(FOLDER) if name.endswith(".json"))


def _micros(spark: SparkSession, newest: int, delay: str) -> int:
    """The watermark in microseconds."""
    times = spark.range(1).select(F.unix_micros(F.timestamp_micros(F.lit(newest)) - F.expr(f"INTERVAL {delay}")))
    return times.first()[0]


def closing(
    parts_of: Callable[..., DataFrame],
    add_up: Callable[[DataFrame], DataFrame],
    path: str,
    late_path: str,
    delay: str,
    ahead: str,
    seconds: int = 5,
) -> Callable[[DataFrame, int], None]:
    """A function for each micro-batch of samples with `at` and `broker_time`.

    Closed windows are written to `path` as parts, one for each window, so that `summaries.merged_metrics` or `merged_logs` give
    their figures; the side table to `late_path`, also as parts, with `cause`. Open windows are kept beside the closed ones.
    """
    state = f"{path.rstrip('/')}/_open"

    def write(rows: DataFrame, batch: int) -> None:
        spark = rows.sparkSession
        files = _Files(spark, state)
        run = spark.sparkContext.getLocalProperty("sql.streaming.queryId") or ""
        done = [number for number in _done(files) if number < batch]
        before = json.loads(files.read(f"{FOLDER}/{done[-1]:010d}.json")) if done else {"run": run, "watermark": None}
        if before["run"] != run or (not done and _done(files) and not _same_run(files, batch, run)):
            raise RuntimeError(f"{path} holds the windows of another run: a new checkpoint needs a new folder")

        # What the batch holds, by window: read once, and small.
        fast = F.coalesce(F.expr(f"at > broker_time + INTERVAL {ahead}"), F.lit(False))
        newest = Observation()
        marked = rows.withColumn("ahead", fast).observe(newest, F.max(F.when(~fast, F.unix_micros("at"))).alias("newest"))
        new = _kept(parts_of(marked, seconds, also=("ahead",)), f"{state}/new/batch_id={batch}")
        # A plan without rows may leave the observation without a value.
        seen, watermark = None if new.isEmpty() else newest.get["newest"], before["watermark"]

        end = F.unix_micros("window_start") + seconds * 1_000_000
        late = F.lit(False) if watermark is None else end <= watermark
        cause = F.when(F.col("window_start").isNull(), TIMELESS).when(F.col("ahead"), AHEAD).when(late, LATE)
        new = new.withColumn("cause", cause).drop("ahead")
        _kept(new.where("cause IS NOT NULL"), f"{late_path.rstrip('/')}/batch_id={batch}")

        mine = new.where("cause IS NULL").drop("cause")
        if done:
            mine = mine.unionByName(spark.read.schema(mine.schema).parquet(f"{state}/batch_id={done[-1]}"))
        opened = add_up(mine)
        if seen is not None:
            watermark = max(_micros(spark, seen, delay), watermark if watermark is not None else -(1 << 62))
        closes = F.lit(False) if watermark is None else end <= watermark
        _kept(opened.where(closes), f"{path.rstrip('/')}/batch_id={batch}")
        _kept(opened.where(~closes), f"{state}/batch_id={batch}")
        if f"{batch:010d}.json" in files.names(FOLDER):
            files.delete(f"{FOLDER}/{batch:010d}.json")
        files.publish(f"{FOLDER}/{batch:010d}.json", json.dumps({"run": run, "watermark": watermark}))
        for number in done[:-1]:
            files.delete(f"{FOLDER}/{number:010d}.json")
            for folder in (f"batch_id={number}", f"new/batch_id={number}"):
                files.delete(folder)

    return write


def _same_run(files: _Files, batch: int, run: str) -> bool:
    """Whether a batch that has been completed before was this run's, so that it may be repeated."""
    name = f"{FOLDER}/{batch:010d}.json"
    return name.split("/")[1] in files.names(FOLDER) and json.loads(files.read(name))["run"] == run


def _kept(rows: DataFrame, path: str) -> DataFrame:
    rows.write.mode("overwrite").parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def open_parts(spark: SparkSession, path: str) -> DataFrame | None:
    """Parts of the windows that are still open; None before the first batch."""
    state = f"{path.rstrip('/')}/_open"
    done = _done(_Files(spark, state))
    return spark.read.parquet(f"{state}/batch_id={done[-1]}") if done else None


def closing_metrics(path: str, late_path: str, delay: str, ahead: str) -> Callable[[DataFrame, int], None]:
    return closing(summaries.metric_parts, summaries.added_metric_parts, path, late_path, delay, ahead)


def closing_logs(path: str, late_path: str, delay: str, ahead: str) -> Callable[[DataFrame, int], None]:
    return closing(summaries.log_parts, summaries.added_log_parts, path, late_path, delay, ahead)
