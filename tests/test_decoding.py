"""Decoding and routing: the golden edge table, and properties of it."""

import json

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Observation
from pyspark.sql import functions as F

from hostpulse.functions import payload
from hostpulse.operators import route
from hostpulse.schemas import ENVELOPE, PAYLOAD
from hostpulse.sources.files import normalise_files
from hostpulse.sources.kafka import normalise_kafka

# value, branch that keeps it, fields it must have there
GOLDEN = [
    (None, None, {}),
    ("", None, {}),
    ("not json", None, {}),
    ("{}", None, {}),
    ('{"type":"log"', None, {}),
    ('{"type":"log","log_raw":"cut', None, {}),
    ('[{"type":"log","log_raw":"a"},{"type":"log","log_raw":"b"}]', None, {}),
    ('{"type":"LOG"}', None, {}),
    ('{"Type":"log"}', None, {}),
    ('{"type":"catalog"}', None, {}),
    ('{"type":null,"log_raw":"log"}', None, {}),
    (
        '{"timestamp":"oops","type":"metrics","cpu_percent":1.0}',
        "metrics",
        {"timestamp": None, "cpu_percent": 1.0},
    ),
    (
        '{"type":"log","timestamp":"bad","log_raw":"k"}',
        "log",
        {"timestamp": None, "log_raw": "k"},
    ),
    (
        '{"type":"metrics","memory":{"total":1.5,"available":2}}',
        "metrics",
        {"total_memory": None, "available_memory": 2, "percent_memory": None},
    ),
    ('{"type":"metrics","cpu_percent":"7.5"}', "metrics", {"cpu_percent": None}),
    ('{"type":"metrics","cpu_percent":3,"timestamp":1}', "metrics", {"cpu_percent": 3.0}),
    ('{"type":"metrics","disk_io":5,"cpu_percent":2.0}', "metrics", {"cpu_percent": 2.0}),
    ('{"type":"log","log_raw":{"a":1}}', "log", {"log_raw": "{a:1}"}),
    ('{"type":"\\u006cog","log_raw":"escaped"}', "log", {"log_raw": "escaped"}),
    ('{"type":"metri\\u0063s","cpu_percent":4.0}', "metrics", {"cpu_percent": 4.0}),
    ("{'type':'log','log_raw':'single'}", "log", {"log_raw": "single"}),
]


def envelopes(spark, values):
    rows = [(value, None, f"t{i}", i % 4, str(i), "2024-01-01T00:00:00") for i, value in enumerate(values)]
    return normalise_files(spark.createDataFrame(rows, ENVELOPE))


@pytest.mark.parametrize("audit", [None, "audit"])
@pytest.mark.parametrize("kind", ["log", "metrics"])
def test_golden_rows(spark, kind, audit):
    rows = envelopes(spark, [value for value, _, _ in GOLDEN])
    build = route.logs if kind == "log" else route.metrics
    found = {row["topic"]: row.asDict() for row in build(rows, audit=audit).collect()}
    expected = {f"t{i}": fields for i, (_, branch, fields) in enumerate(GOLDEN) if branch == kind}
    assert found.keys() == expected.keys()
    for topic, fields in expected.items():
        assert {name: found[topic][name] for name in fields} == fields


def test_audit_counts_what_is_dropped(spark):
    observation = Observation("audit")
    rows = route.decoded(envelopes(spark, [value for value, _, _ in GOLDEN]))
    route.counted(rows, observation).where("payload.type = 'log'").collect()
    branches = [branch for _, branch, _ in GOLDEN]
    counts = observation.get
    assert counts["messages"] == len(GOLDEN)
    assert counts["logs"] == branches.count("log")
    assert counts["metrics"] == branches.count("metrics")
    # `LOG` and `catalog` are readable, though they belong to no branch.
    assert counts["unreadable"] == branches.count(None) - 2


def test_bytes_decode_like_text(spark):
    values = [value for value, _, _ in GOLDEN]
    text = spark.createDataFrame([(value,) for value in values], "value string")
    both = text.select(
        payload.decode(F.col("value")).alias("a"),
        payload.decode(F.col("value").cast("binary")).alias("b"),
    )
    assert both.where(~F.col("a").eqNullSafe(F.col("b"))).count() == 0


def test_narrow_parse_equals_full_parse(spark):
    """A field that is not asked for must not change those that are."""
    values = [value for value, _, _ in GOLDEN] + [
        '{"type":"metrics","memory":7,"cpu_percent":1.0,"timestamp":2.0}',
        '{"type":"metrics","disk_io":{"read_bytes":"x"},"cpu_percent":1.0}',
        '{"type":"log","category":["a"],"log_raw":"x","unknown":{"deep":[1,2]}}',
        '{"type":"log","type":"metrics","cpu_percent":1.0}',
        '{"type":"log","log_raw":"x"} trailing',
    ]
    rows = spark.createDataFrame([(value,) for value in values], "value string")
    for fields in (route.LOG_FIELDS, route.METRICS_FIELDS, ("timestamp", "type")):
        both = rows.select(
            "value",
            payload.decode(F.col("value")).alias("full"),
            payload.decode(F.col("value"), *fields).alias("part"),
        )
        for name in fields:
            same = F.col(f"full.{name}").eqNullSafe(F.col(f"part.{name}"))
            assert both.where(~same).collect() == []


def test_bad_broker_time_becomes_null(spark):
    rows = spark.createDataFrame(
        [('{"type":"log"}', None, "t", 0, "x1", "yesterday")], ENVELOPE
    )
    row = normalise_files(rows).first()
    assert row["broker_time"] is None and row["offset"] is None


def test_rows_of_the_kafka_source(spark):
    """A static table of the connector's schema: bytes, long offset, real timestamp."""
    rows = spark.createDataFrame(
        [
            (None, b'{"type":"log","log_raw":"\\"eventMessage\\" : \\"a, b\\"","timestamp":1.5}', "t", 3, 7, "2024-07-01 12:00:00", 0),
            (b"k", b'{"type":"metrics","cpu_percent":2.5,"memory":{"total":8}}', "t", 0, 8, "2024-01-01 12:00:00", 0),
            (None, b"\xff\xfe broken", "t", 0, 9, "2024-01-01 12:00:00", 0),
            (None, None, "t", 0, 10, "2024-01-01 12:00:00", 0),
        ],
        "key binary, value binary, topic string, partition int, offset bigint, timestamp string, timestampType int",
    ).withColumn("timestamp", F.col("timestamp").cast("timestamp"))
    normalised = normalise_kafka(rows)
    assert normalised.schema == normalise_files(spark.createDataFrame([], ENVELOPE)).schema
    logs = route.logs(normalised, zone="Europe/Berlin").collect()
    assert [(str(r["eventhub_timestamp"]), r["log_raw"]) for r in logs] == [
        ("2024-07-01 14:00:00", "a b")
    ]
    metrics = route.metrics(normalised, zone="Europe/Berlin").collect()
    assert [(str(r["eventhub_timestamp"]), r["cpu_percent"], r["total_memory"]) for r in metrics] == [
        ("2024-01-01 13:00:00", 2.5, 8)
    ]


text = st.text(st.characters(exclude_categories=("Cs",)), max_size=30)
number = st.floats(-1e9, 1e9, allow_nan=False)
whole = st.integers(-(2**62), 2**62)
message = st.one_of(
    st.fixed_dictionaries(
        {"timestamp": number, "type": st.just("log"), "category": text, "log_raw": text}
    ),
    st.fixed_dictionaries(
        {
            "timestamp": number,
            "type": st.just("metrics"),
            "cpu_percent": number,
            "memory": st.fixed_dictionaries({"total": whole, "available": whole, "percent": number}),
            "disk_io": st.fixed_dictionaries({"read_bytes": whole, "write_bytes": whole}),
        }
    ),
)


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(message, min_size=1, max_size=20))
def test_decoding_gives_back_what_was_sent(spark, sent):
    values = [json.dumps(m) for m in sent]
    rows = envelopes(spark, values)
    decoded = {
        int(row["topic"][1:]): row["payload"].asDict(recursive=True)
        for row in route.of_type(rows, "log", "metrics").collect()
    }
    assert sorted(decoded) == list(range(len(sent)))
    for position, original in enumerate(sent):
        got = {k: v for k, v in decoded[position].items() if v is not None}
        assert got == original


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(number, text, text), min_size=1, max_size=20))
def test_encoding_then_decoding_is_the_identity(spark, originals):
    rows = spark.createDataFrame(originals, "s double, c string, l string")
    value = payload.log_payload(F.col("s"), F.col("c"), F.col("l"))
    back = rows.select("*", payload.decode(value).alias("p"))
    assert {name for name in back.schema["p"].dataType.names} == set(PAYLOAD.names)
    for row in back.collect():
        assert (row["p"]["timestamp"], row["p"]["category"], row["p"]["log_raw"]) == (
            row["s"],
            row["c"],
            row["l"],
        )
        assert row["p"]["type"] == "log"
