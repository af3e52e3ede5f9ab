"""Merging window parts while the stream goes on, and after runs that ended early."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from hostpulse.operators import summaries
from hostpulse.streaming import parts, streams

START = dt.datetime(2024, 1, 1)
SAMPLES = "at timestamp, cpu_percent double, available_memory bigint, percent_memory double"


def batch(spark, number, days=3):
    """Samples all over the days so far, some without a time or a figure, one beyond what a decimal holds."""
    rows = [
        (START + dt.timedelta(days=(number * i) % days, seconds=i % 40), None if i % 9 == 0 else i / 7, i, float(i % 5))
        for i in range(60)
    ]
    rows += [(None, 1.0, 2, 3.0), (START, 1e300 if number == 2 else 1.0, 1, 1.0)]
    return spark.createDataFrame(rows, SAMPLES).repartition(2)


def merged(frame):
    return sorted((tuple(row) for row in summaries.merged_metrics(frame).collect()), key=repr)


def same(a, b):
    """Equal but for the last bits of floating sums, which groups with huge values have."""
    def close(x, y):
        return x == y or (isinstance(x, float) and math.isclose(x, y, rel_tol=1e-12))

    return len(a) == len(b) and all(close(x, y) for r, s in zip(a, b) for x, y in zip(r, s))


def test_sums_stay_equal_and_files_get_few(spark, tmp_path):
    path, everything = str(tmp_path / "out"), []
    sink = streams.parts_sink(summaries.metric_parts, streams.Sink(path=path), summaries.added_metric_parts, merge_every=3)
    for number in range(13):
        rows = batch(spark, number)
        everything.append(summaries.metric_parts(rows))
        sink.batch(rows, number)
        whole = everything[0]
        for one in everything[1:]:
            whole = whole.unionByName(one)
        if number % 4 == 0:
            assert same(merged(parts.read(spark, path)), merged(whole))
    version = parts.current(spark, path)
    assert version.upto >= 8 and parts.NO_DAY in version.days
    # The first day has been closed by the third one: all its parts are in one folder.
    assert len(version.days["2024-01-01"]) == 1
    left = {int(p.name.split("=")[1]) for p in (tmp_path / "out").glob("batch_id=*")}
    assert min(left) > 2 and max(left) == 12
    files = [p for f in version.days["2024-01-01"] for p in (tmp_path / "out" / parts.FOLDER / f / "day=2024-01-01").glob("*.parquet")]
    assert len(files) == 1


def test_run_that_ends_before_the_swap_is_repeated(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "out")
    sink = streams.parts_sink(summaries.metric_parts, streams.Sink(path=path))
    for number in range(5):
        sink.batch(batch(spark, number), number)
    before = merged(parts.read(spark, path))

    def stop(*_):
        raise KeyboardInterrupt

    with monkeypatch.context() as patched:
        patched.setattr(parts._Files, "publish", stop)
        with pytest.raises(KeyboardInterrupt):
            parts.merge(spark, path, summaries.added_metric_parts)
    assert parts.current(spark, path) == parts.Version()
    assert same(merged(parts.read(spark, path)), before)
    first = parts.merge(spark, path, summaries.added_metric_parts)
    assert first.upto == 3 and same(merged(parts.read(spark, path)), before)
    # Nothing new: nothing happens, and the folder that the first run left is gone.
    assert parts.merge(spark, path, summaries.added_metric_parts) == first
    names = {p.name for p in (tmp_path / "out" / parts.FOLDER).iterdir() if not p.name.startswith(".")}
    assert names == first.folders() | {"0000000001.json"}


def test_two_runs_at_once(spark, tmp_path):
    path = str(tmp_path / "out")
    sink = streams.parts_sink(summaries.metric_parts, streams.Sink(path=path))
    for number in range(3):
        sink.batch(batch(spark, number), number)
    files = parts._Files(spark, path)
    parts.merge(spark, path, summaries.added_metric_parts)
    with pytest.raises(RuntimeError, match="another run"):
        files.publish(f"{parts.FOLDER}/0000000001.json", "{}")
    assert parts.current(spark, path).upto == 1


def test_a_new_checkpoint_does_not_overwrite_merged_batches(spark, tmp_path):
    path = str(tmp_path / "out")
    sink = streams.parts_sink(summaries.metric_parts, streams.Sink(path=path))
    for number in range(4):
        sink.batch(batch(spark, number), number)
    sink.batch(batch(spark, 3), 3)
    parts.merge(spark, path, summaries.added_metric_parts)
    with pytest.raises(RuntimeError, match="new checkpoint needs a new folder"):
        sink.batch(batch(spark, 0), 0)


def test_log_parts_and_an_empty_folder(spark, tmp_path):
    path = str(tmp_path / "out")
    rows = spark.range(50).select(
        F.timestamp_seconds(F.col("id") * 3600).alias("at"), F.concat(F.lit("c"), F.col("id") % 3).alias("category")
    )
    sink = streams.parts_sink(summaries.log_parts, streams.Sink(path=path), summaries.added_log_parts, merge_every=2)
    assert parts.merge(spark, path, summaries.added_log_parts) == parts.Version()
    for number in range(6):
        sink.batch(rows, number)
    found = summaries.merged_logs(parts.read(spark, path))
    assert found.agg(F.sum("n")).first()[0] == 300 and found.count() == 50
