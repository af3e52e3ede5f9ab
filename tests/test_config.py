"""Parameters, option maps and names. No broker or database is reached."""

import pytest
from pyspark.sql import functions as F

from hostpulse.__main__ import parse, sink_for
from hostpulse.config import Config, Secret, Target
from hostpulse.sinks import jdbc
from hostpulse.sinks.kafka import delivering, records, write_options
from hostpulse.sources.kafka import connection_options, read_options
from hostpulse.streaming import streams

SECRET = 'Endpoint=sb://x/;Key="a\\b"'


@pytest.fixture
def config():
    return Config(namespace="example-space", connection=Secret(lambda: SECRET))


def test_logs_options(config):
    options = read_options(config, "logs")
    assert options["kafka.bootstrap.servers"] == "example-space.servicebus.windows.net:9093"
    assert options["subscribe"] == "system_data"
    assert options["startingOffsets"] == "latest"
    assert options["maxOffsetsPerTrigger"] == "100"
    assert options["kafka.request.timeout.ms"] == "60000"
    assert options["kafka.session.timeout.ms"] == "30000"
    assert options["failOnDataLoss"] == "true"
    assert options["kafka.security.protocol"] == "SASL_SSL"
    assert options["kafka.sasl.mechanism"] == "PLAIN"
    assert options["kafka.sasl.jaas.config"] == (
        "org.apache.kafka.common.security.plain.PlainLoginModule required "
        'username="$ConnectionString" password="Endpoint=sb://x/;Key=\\"a\\\\b\\"";'
    )


def test_metrics_options(config):
    options = read_options(config, "metrics")
    assert options["startingOffsets"] == "earliest"
    assert options["maxOffsetsPerTrigger"] == "10000"
    assert "kafka.request.timeout.ms" not in options
    lenient = Config(namespace="example-space", topics="a,b", fail_on_data_loss=False).for_backlog()
    options = read_options(lenient, "metrics")
    assert options["failOnDataLoss"] == "false" and options["subscribe"] == "a,b"
    assert "maxOffsetsPerTrigger" not in options
    assert options["maxRecordsPerPartition"] == "1000000"


def test_no_login_without_secret():
    assert connection_options("ns", None) == {
        "kafka.bootstrap.servers": "ns.servicebus.windows.net:9093"
    }


def test_delivery_options(config):
    options = write_options("ns", config.connection)
    assert options["kafka.acks"] == "all"
    assert options["kafka.retries"] == "3"
    assert options["kafka.max.in.flight.requests.per.connection"] == "1"
    assert "password" in options["kafka.sasl.jaas.config"]


def test_records_go_to_the_topic_of_their_type(spark):
    rows = spark.createDataFrame([("log", "a"), ("metrics", "b")], "type string, value string")
    got = {tuple(row) for row in records(rows).collect()}
    assert got == {("system-logs", "a"), ("system-metrics", "b")}


def test_what_cannot_be_sent_is_kept(spark, tmp_path):
    """Sent and dead rows are the input, also after a repeated batch."""
    rows = [(1, "log", "a"), (2, "metrics", None), (3, "other", "c"), (4, None, "d"), (5, "log", "é" * 6), (6, "metrics", "f" * 10)]
    frame = spark.createDataFrame(rows, "id int, type string, value string").withColumn("reason", F.lit("of the sender"))
    sent = []
    write = delivering(lambda records: sent.append({tuple(r) for r in records.collect()}), str(tmp_path / "dead"), most=10)
    for batch in (0, 0, 1):
        write(frame, batch)
    assert sent == [{("system-logs", "a"), ("system-metrics", "f" * 10)}] * 3
    dead = spark.read.parquet(str(tmp_path / "dead"))
    expected = {(2, "no value"), (3, "no topic"), (4, "no topic"), (5, "too large")}
    assert {(r.id, r.reason) for r in dead.collect()} == expected and dead.count() == 8
    write(frame.limit(0), 2)
    assert sent[-1] == set() and spark.read.parquet(str(tmp_path / "dead")).count() == 8


def test_secret_is_not_printed(config):
    database = jdbc.Database("jdbc:x", password=Secret(lambda: SECRET))
    assert SECRET not in repr(config) + repr(database) + str(config.connection)
    assert database.write_options("t")["password"] == SECRET


def test_checkpoints_and_environments_are_apart():
    paths = {
        Config(mode=mode, environment=environment).checkpoint(stream)
        for mode in ("kafka", "files")
        for environment in ("dev", "main")
        for stream in ("logs", "metrics")
    }
    assert len(paths) == 8
    path = Config(environment="main").checkpoint("logs")
    assert path.startswith("/Volumes/main/default/streaming_data/_checkpoints/")


def test_only_broker_times_are_shifted():
    assert Config().zone == "Europe/Berlin"
    assert Config(mode="files").zone is None and Config(broker_zone=None).zone is None


def test_sink_does_not_print_its_options():
    assert SECRET not in repr(streams.Sink(format="kafka", options={"password": SECRET}))


def test_target_name():
    assert Target().table("enriched_logs") == "workspace.default.enriched_logs"
    assert Target("", "s").table("parsed_metrics") == "s.parsed_metrics"


def test_parameters_from_environment():
    config = Config.from_env(
        {"HOSTPULSE_MODE": "files", "HOSTPULSE_TOPICS": "t", "HOSTPULSE_SCHEMA": "s"}
    )
    assert (config.mode, config.topics, config.target.schema) == ("files", "t", "s")
    assert config.namespace is None and config.connection is None
    with pytest.raises(ValueError, match="namespace"):
        connection_options(config.namespace, None)


def test_command_line():
    given, config = parse(["--streams", "metrics", "--mode", "files", "--catalog", "c", "--wait", "5"])
    assert given.streams == ["metrics"] and given.wait == 5 and config.mode == "files"
    assert sink_for(given, config, "parsed_metrics").table == "c.default.parsed_metrics"
    given, config = parse(["--output", "/out"])
    assert sink_for(given, config, "parsed_metrics").path == "/out/parsed_metrics"
    given, config = parse(["--jdbc-url", "jdbc:postgresql://h/d", "--schema", "s"])
    sink = sink_for(given, config, "parsed_metrics")
    assert sink.batch is not None and sink.table is None


def test_triggers():
    assert streams.WINDOWS_TRIGGER == {"processingTime": "5 seconds"}
    assert streams.LOGS_TRIGGER == {"processingTime": "100 milliseconds"}
    assert streams.DRAIN == {"availableNow": True}


def test_jdbc_options():
    database = jdbc.Database("jdbc:postgresql://h/d", user="u", connections=4)
    options = database.write_options("s.t")
    assert options["url"] == "jdbc:postgresql://h/d" and options["dbtable"] == "s.t"
    assert options["driver"] == "org.postgresql.Driver" and options["user"] == "u"
    assert options["numPartitions"] == "4" and options["reWriteBatchedInserts"] == "true"
