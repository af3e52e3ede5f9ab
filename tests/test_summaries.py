"""Percentiles and windows against plain Python."""

import datetime as dt
import math
import re
from collections import Counter
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from hostpulse.operators.summaries import column_of, logs_by_window, metrics_by_window, percentiles

POINTS = ("0", "0.5", "0.95", "0.999", "1")


def expected(values):
    ordered = sorted(values)
    return [ordered[max(math.ceil(Decimal(p) * len(ordered)), 1) - 1] for p in POINTS]


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.lists(
        st.tuples(
            st.sampled_from(["a", "b", None]),
            st.integers(-5000, 5000) | st.integers(-(2**63), 2**63 - 1) | st.none(),
        ),
        min_size=1,
        max_size=120,
    ),
    st.sampled_from([1, 4, 21]),
)
def test_percentiles_equal_sorting(spark, rows, parts):
    frame = spark.createDataFrame(rows, "g string, v bigint")
    got = {
        row["g"]: row for row in percentiles(frame, ["g"], "v", POINTS, parts=parts).collect()
    }
    groups = {}
    for name, value in rows:
        if value is not None:
            groups.setdefault(name, []).append(value)
    assert got.keys() == groups.keys()
    for name, values in groups.items():
        row = got[name]
        assert [row[column_of(point)] for point in POINTS] == expected(values)
        assert (row["n"], row["min"], row["max"]) == (len(values), min(values), max(values))
        assert math.isclose(row["mean"], sum(values) / len(values), rel_tol=1e-12, abs_tol=1e-9)


def test_one_value_holds_most_rows(spark):
    frame = spark.range(30000).select(
        F.lit("g").alias("g"),
        F.when(F.col("id") % 3 == 0, F.col("id")).otherwise(F.lit(12345)).alias("v"),
    )
    values = [i if i % 3 == 0 else 12345 for i in range(30000)]
    row = percentiles(frame, ["g"], "v", POINTS, parts=5).first()
    assert [row[column_of(point)] for point in POINTS] == expected(values)


def test_nulls_are_counted(spark):
    rows = [("a", None), ("a", 3), ("b", None), ("b", None), (None, None), ("c", 1), ("c", 1), (None, 5)]
    frame = spark.createDataFrame(rows, "g string, v bigint")
    for parts in (1, 2, 9):
        got = {r["g"]: r for r in percentiles(frame, ["g"], "v", ("0.5",), parts=parts, missing="unknown").collect()}
        assert {g: (r["n"], r["unknown"], r["p50"], r["min"]) for g, r in got.items()} == {
            "a": (1, 1, 3, 3), "b": (0, 2, None, None), "c": (2, 0, 1, 1), None: (1, 1, 5, 5)
        }
    assert percentiles(frame.limit(0), ["g"], "v", ("0.5",), missing="unknown").collect() == []


def test_many_groups_within_and_across_ranges(spark):
    frame = spark.range(20000).select((F.col("id") % 97).alias("g"), (F.col("id") % 2).alias("h"), (F.col("id") * 7919 % 5003).alias("v"))
    frame = frame.union(spark.range(30000).select(F.lit(5), F.lit(1), F.col("id")))
    groups = {}
    for g, h, v in frame.collect():
        groups.setdefault((g, h), []).append(v)
    for row in percentiles(frame, ["g", "h"], "v", POINTS, parts=7).collect():
        values = groups.pop((row["g"], row["h"]))
        assert [row[column_of(point)] for point in POINTS] == expected(values) and row["n"] == len(values)
    assert not groups


def test_input_of_percentiles_is_read_once(spark, small):
    frame = spark.read.parquet(f"{small}/events.parquet").withColumn("v", F.col("user_id"))
    result = percentiles(frame, ["event_type"], "v", ("0.5",))
    result.collect()
    final = result._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    # The counts by value, their ranges, the ends of the ranges and the result; the ranges serve twice and are printed twice.
    assert final.count("FileScan") == 1 and final.count("ReusedExchange") == 1
    assert len(re.findall(r"(?<!Reused)(?<!Broadcast)Exchange ", final)) - 1 == 4


@pytest.mark.parametrize(
    ("point", "name"), [("0.5", "p50"), ("0.999", "p99_9"), ("1", "p100"), ("0", "p0")]
)
def test_column_names(point, name):
    assert column_of(point) == name


def test_windows(spark):
    at = lambda second: dt.datetime(2024, 1, 1, 0, 0, 0) + dt.timedelta(seconds=second)
    rows = spark.createDataFrame(
        [
            (at(0), 1.5, 10, 50.0),
            (at(4.999999), 2.5, 5, None),
            (at(5), None, None, None),
            (at(5), float("nan"), 7, 1.0),
            (at(-0.000001), 9.0, 1, 2.0),
            (None, 3.0, 1, 1.0),
        ],
        "at timestamp, cpu_percent double, available_memory bigint, percent_memory double",
    )
    got = {row["window_start"]: row for row in metrics_by_window(rows).collect()}
    assert set(got) == {at(0), at(5), at(-5)}
    first = got[at(0)]
    assert (first["n"], first["min_cpu"], first["max_cpu"], first["avg_cpu"]) == (2, 1.5, 2.5, 2.0)
    assert (first["max_memory"], first["avg_memory"], first["min_available"]) == (50.0, 50.0, 5)
    assert got[at(5)]["n"] == 2 and math.isnan(got[at(5)]["avg_cpu"])


def test_stray_figures_do_not_end_the_job(spark):
    start = dt.datetime(2024, 1, 1)
    rows = spark.createDataFrame(
        [(start, value, 1, 50.0) for value in (9e12, 9e12, 9e12, 1e300, float("inf"))],
        "at timestamp, cpu_percent double, available_memory bigint, percent_memory double",
    )
    row = metrics_by_window(rows).first()
    assert row["avg_cpu"] == math.inf and row["avg_memory"] == 50.0
    assert row["n"] == 5 and row["max_cpu"] == float("inf")


def test_log_counts(spark):
    start = dt.datetime(2024, 1, 1)
    raw = [(start + dt.timedelta(seconds=i // 3), "ab"[i % 2]) for i in range(60)]
    rows = spark.createDataFrame(raw, "at timestamp, category string")
    got = {(r["window_start"], r["category"]): r["n"] for r in logs_by_window(rows).collect()}
    floor = lambda t: t - dt.timedelta(seconds=t.second % 5)
    assert got == Counter((floor(t), c) for t, c in raw)


@pytest.mark.parametrize("values", [(1e13, 3e13, 1.0), (1e-7, 1e-7), (1e-15, 3e-15), (0.1, 0.2, 0.3), (1e300, 1.0)])
def test_mean_leaves_no_row_out(spark, values):
    start = dt.datetime(2024, 1, 1)
    rows = spark.createDataFrame(
        [(start, value, 1, 50.0) for value in values],
        "at timestamp, cpu_percent double, available_memory bigint, percent_memory double",
    )
    row = metrics_by_window(rows).first()
    assert row["n"] == len(values) and math.isclose(row["avg_cpu"], math.fsum(values) / len(values))
