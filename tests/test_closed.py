"""Closed windows and their side table hold every sample once, whatever the order and whichever batches are repeated."""

import collections
import datetime as dt
import json
import random

import pytest
from pyspark.sql import functions as F

from hostpulse.operators import summaries
from hostpulse.streaming import closed, streams

START = dt.datetime(2024, 1, 1)
SAMPLES = "at timestamp, category string, broker_time timestamp"


def samples(seed=2, count=600):
    """Ten minutes of samples in no order; some without a time, some from a clock that runs ahead."""
    rng = random.Random(seed)
    rows = []
    for _ in range(count):
        at = START + dt.timedelta(seconds=rng.randrange(600))
        rows.append((at, rng.choice("abc"), at + dt.timedelta(seconds=1)))
    rows += [(None, "a", START)] * 5
    rows += [(START + dt.timedelta(days=400), "b", START)] * 7
    rng.shuffle(rows)
    return rows


def window(at):
    return at and at - dt.timedelta(seconds=at.second % 5)


def expected(batches, delay):
    """By the rules, batch by batch."""
    watermark, opened, done, aside = None, collections.Counter(), collections.Counter(), collections.Counter()
    for rows in batches:
        good = []
        for at, category, broker in rows:
            key = (window(at), category)
            if at is None:
                aside[(*key, "timeless")] += 1
            elif at > broker + dt.timedelta(minutes=10):
                aside[(*key, "ahead")] += 1
            elif watermark and key[0] + dt.timedelta(seconds=5) <= watermark:
                aside[(*key, "late")] += 1
            else:
                opened[key] += 1
            if at is not None and at <= broker + dt.timedelta(minutes=10):
                good.append(at)
        watermark = max([at - delay for at in good] + ([watermark] if watermark else []), default=None)
        for key in [k for k in opened if watermark and k[0] + dt.timedelta(seconds=5) <= watermark]:
            done[key] += opened.pop(key)
    return done, aside, opened


def counted(frame, *also):
    found = collections.Counter()
    for row in frame.collect():
        found[(row["window_start"], row["category"], *(row[name] for name in also))] += row["n"]
    return found


@pytest.mark.parametrize("delay", [0, 60])
def test_equals_the_rules_on_shuffled_input(spark, tmp_path, delay):
    path, late = str(tmp_path / "out"), str(tmp_path / "late")
    rows = samples()
    batches = [rows[k : k + 90] for k in range(0, len(rows), 90)]
    write = closed.closing_logs(path, late, f"{delay} seconds", "10 minutes")
    for number, batch in enumerate(batches):
        write(spark.createDataFrame(batch, SAMPLES), number)
        if number in (0, 3):
            # The stream repeats a batch whose commit it has lost.
            write(spark.createDataFrame(batch, SAMPLES), number)
    done, aside, opened = expected(batches, dt.timedelta(seconds=delay))
    assert done and opened and aside
    assert counted(spark.read.parquet(path)) == done
    assert counted(spark.read.parquet(late), "cause") == aside
    assert counted(closed.open_parts(spark, path)) == opened
    assert sum((done + opened).values()) + sum(aside.values()) == len(rows)
    # Each window is written once.
    assert spark.read.parquet(path).groupBy("window_start", "category").count().where("count > 1").count() == 0


def test_a_batch_that_ended_half_way_is_repeated(spark, tmp_path, monkeypatch):
    path, late = str(tmp_path / "out"), str(tmp_path / "late")
    rows = samples(3, 200)
    batches = [rows[:80], rows[80:160], rows[160:]]
    write = closed.closing_logs(path, late, "30 seconds", "10 minutes")
    write(spark.createDataFrame(batches[0], SAMPLES), 0)
    with monkeypatch.context() as patched:
        patched.setattr(closed._Files, "publish", lambda *_: (_ for _ in ()).throw(KeyboardInterrupt()))
        with pytest.raises(KeyboardInterrupt):
            write(spark.createDataFrame(batches[1], SAMPLES), 1)
    for number in (1, 2):
        write(spark.createDataFrame(batches[number], SAMPLES), number)
    done, aside, opened = expected(batches, dt.timedelta(seconds=30))
    assert (counted(spark.read.parquet(path)), counted(spark.read.parquet(late), "cause")) == (done, aside)
    assert counted(closed.open_parts(spark, path)) == opened


def test_empty_batches_and_another_run(spark, tmp_path):
    path, late = str(tmp_path / "out"), str(tmp_path / "late")
    assert closed.open_parts(spark, path) is None
    write = closed.closing_logs(path, late, "0 seconds", "10 minutes")
    empty = spark.createDataFrame([], SAMPLES)
    write(empty, 0)
    write(spark.createDataFrame([(None, "a", None)], SAMPLES), 1)
    assert counted(spark.read.parquet(late), "cause") == {(None, "a", "timeless"): 1}
    spark.sparkContext.setLocalProperty("sql.streaming.queryId", "another")
    try:
        with pytest.raises(RuntimeError, match="another run"):
            write(empty, 2)
        with pytest.raises(RuntimeError, match="another run"):
            write(empty, 0)
    finally:
        spark.sparkContext.setLocalProperty("sql.streaming.queryId", None)


def test_metrics_keep_their_figures(spark, tmp_path):
    path, late = str(tmp_path / "out"), str(tmp_path / "late")
    rows = spark.range(400).select(
        F.timestamp_micros(F.lit(1704067200000000) + F.pmod(F.col("id") * 7919, F.lit(300)) * 1000000).alias("at"),
        (F.col("id") / 4).alias("cpu_percent"),
        F.col("id").alias("available_memory"),
        F.col("id").cast("double").alias("percent_memory"),
        F.timestamp_seconds(F.lit(1704067300)).alias("broker_time"),
    )
    write = closed.closing_metrics(path, late, "20 seconds", "10 minutes")
    for number in range(4):
        write(rows.where(F.col("available_memory") % 4 == number), number)
    names = summaries.metric_parts(rows).columns
    found = spark.read.parquet(path).select(*names)
    for more in (spark.read.parquet(late), closed.open_parts(spark, path)):
        found = found.unionByName(more.select(*names))
    got, want = (sorted(map(tuple, f.collect())) for f in (summaries.merged_metrics(found), summaries.metrics_by_window(rows)))
    assert got == want and spark.read.parquet(late).count() > 0


def test_only_folders(spark):
    with pytest.raises(ValueError, match="Parquet folder"):
        streams._folder(streams.Sink(table="x"))


def test_watermark_file_names_the_run(spark, tmp_path):
    write = closed.closing_logs(str(tmp_path / "o"), str(tmp_path / "l"), "1 hour", "10 minutes")
    write(spark.createDataFrame([(START, "a", START)], SAMPLES), 0)
    kept = json.loads((tmp_path / "o" / "_open" / closed.FOLDER / "0000000000.json").read_text())
    assert kept == {"run": "", "watermark": int((START - dt.timedelta(hours=1) - dt.datetime(1970, 1, 1)).total_seconds()) * 10**6}
