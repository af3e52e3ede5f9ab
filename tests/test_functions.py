"""Text cleaning, broker time, collection rules."""

import datetime as dt
import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from hostpulse.functions import text, times
from hostpulse.operators import collect

CLEANED = [
    (
        '"eventMessage" : "disk7: 12 blocks moved"',
        '"disk7: 12 blocks moved"',
        "disk7: 12 blocks moved",
    ),
    ('  "eventMessage" : "a, b, \\"c\\"",', '  "a, b, \\"c\\"",', "  a b \\c\\"),
    (
        '"timestamp" : "2026-01-01 00:00:00.1+0200",',
        '"timestamp" : "2026-01-01 00:00:00.1+0200",',
        "timestamp : 2026-01-01 00:00:00.1+0200",
    ),
    ('"eventMessage":"x"', '"eventMessage":"x"', "x"),
    (None, None, None),
]


def test_golden_cleaning(spark):
    rows = spark.createDataFrame([(raw,) for raw, _, _ in CLEANED], "raw string")
    got = rows.select(text.strip_prefix(F.col("raw")), text.strip_noise(F.col("raw"))).collect()
    assert [tuple(row) for row in got] == [(prefix, full) for _, prefix, full in CLEANED]


pieces = st.sampled_from(['"eventMessage"', '"', "eventMessage", ":", " ", "\t", ",", '"eventMessage" : "', "x"])


@settings(max_examples=25, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.lists(pieces, max_size=12).map("".join), min_size=1, max_size=30))
def test_full_cleaning_equals_one_pattern(spark, raws):
    rows = spark.createDataFrame([(raw,) for raw in raws], "raw string")
    got = [row[0] for row in rows.select(text.strip_noise(F.col("raw"))).collect()]
    assert got == [re.sub(r'"eventMessage"\s*:\s*|["\,]', "", raw) for raw in raws]


strings = st.lists(st.text(st.characters(exclude_categories=("Cs",))), min_size=1, max_size=30)


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(strings)
def test_full_cleaning_is_idempotent(spark, raws):
    rows = spark.createDataFrame([(raw,) for raw in raws], "raw string")
    once = text.strip_noise(F.col("raw"))
    for row in rows.select(once.alias("a"), text.strip_noise(once).alias("b")).collect():
        assert row["a"] == row["b"]
        assert '"' not in row["a"] and "," not in row["a"]


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(strings)
def test_blanks_are_trimmed_like_str_strip(spark, raws):
    padded = [f" \t{raw}\x1f　\n" for raw in raws]
    rows = spark.createDataFrame([(raw,) for raw in padded], "raw string")
    got = [row[0] for row in rows.select(text.strip_blanks(F.col("raw"))).collect()]
    assert got == [raw.strip() for raw in padded]


def test_blanks_are_all_of_them():
    import sys

    assert text.BLANKS == "".join(c for c in map(chr, range(sys.maxunicode + 1)) if c.isspace())


def test_useful_lines(spark):
    lines = ['\t"eventMessage" : "a" ', "eventMessage", '"category"', "", None, '"Timestamp"', ' "timestamp"\n']
    rows = spark.createDataFrame([(line,) for line in lines], "line string")
    got = [row["line"] for row in collect.useful_lines(rows).collect()]
    assert got == ['"eventMessage" : "a"', '"category"', '"timestamp"']
    own = collect.useful_lines(rows, keywords=("Timestamp",))
    assert [row["line"] for row in own.collect()] == ['"Timestamp"']
    # The blank behind the first line is gone when the line is tested.
    assert collect.useful_lines(rows, keywords=('"a" ',)).count() == 0


def test_categories(spark):
    rows = spark.createDataFrame(
        [
            (1, "com.apple.wifi", "kernel woke"),
            (2, "com.apple.WIFI", "Kernel woke"),
            (3, "com.apple.bluetooth", None),
            (4, None, "a kernel"),
            (5, None, None),
        ],
        "id int, subsystem string, event_message string",
    )
    got = {(row["id"], row["category"]) for row in collect.by_category(rows).collect()}
    assert got == {(1, "wifi"), (1, "kernel"), (3, "bluetooth"), (4, "kernel")}


def test_topics(spark):
    rows = spark.createDataFrame([("log",), ("metrics",), ("x",), (None,)], "type string")
    assert [row["topic"] for row in collect.addressed(rows).collect()] == [
        "system-logs",
        "system-metrics",
        None,
        None,
    ]


def test_wall_time(spark):
    pairs = [
        ("2024-01-01 12:00:00", "2024-01-01 13:00:00"),
        ("2024-07-01 12:00:00", "2024-07-01 14:00:00"),
        ("2024-10-27 00:30:00", "2024-10-27 02:30:00"),
        ("2024-10-27 01:30:00", "2024-10-27 02:30:00"),
    ]
    rows = spark.createDataFrame(pairs, "utc string, berlin string")
    shifted = times.to_wall_time(F.col("utc").cast("timestamp")).cast("string")
    assert rows.where(shifted != F.col("berlin")).count() == 0


def test_time_text_keeps_microseconds(spark):
    moment = dt.datetime(2024, 1, 1, 0, 0, 7, 179575)
    row = spark.createDataFrame([(moment,)], "t timestamp").select(
        times.iso_text(F.col("t")).alias("text"),
        (times.broker_time(times.iso_text(F.col("t"))) == F.col("t")).alias("same"),
    ).first()
    assert row["text"] == "2024-01-01T00:00:07.179575" and row["same"]


def test_odd_seconds_give_null_times(spark):
    odd = [float("nan"), float("inf"), -float("inf"), 1e300, 9.2e12, -9.2e12, None]
    rows = spark.createDataFrame([(value,) for value in odd], "s double")
    assert [row[0] for row in rows.select(times.epoch_micros(F.col("s"))).collect()] == [None] * 7
    now = F.lit("2024-01-01").cast("timestamp")
    lags = rows.select(times.lag_micros(now, F.col("s"))).collect()
    assert [row[0] for row in lags] == [None] * 7
