"""Times of batches by part, the size and time of encoder calls, file options and further run parameters."""

import time

import pytest
from pyspark.sql import functions as F

from hostpulse.__main__ import parse, sink_for, trigger_for
from hostpulse.config import Config
from hostpulse.functions import embedding
from hostpulse.plans import tables
from hostpulse.sinks.files import write_envelopes
from hostpulse.streaming import streams
from hostpulse.streaming.latency import Latencies, percentile


@pytest.fixture
def slow_encoder():
    """Made here, so that it travels to the workers, which cannot import this file."""

    def open_encoder():
        import time

        def encode(texts):
            time.sleep(0.02)
            return [[float(len(text))] for text in texts]

        return encode

    return open_encoder


def test_percentiles_of_times():
    values = [float(v) for v in range(1, 201)]
    assert (percentile(values, 0.5), percentile(values, 0.99), percentile([3.0], 0.99)) == (100.0, 198.0, 3.0)


def test_size_and_time_of_calls(spark, slow_encoder):
    calls = embedding.Calls(spark.sparkContext)
    rows = spark.range(0, 250, 1, 1).select(F.col("id").cast("string").alias("text"))
    rows.select(embedding.embed(F.col("text"), slow_encoder, calls=calls)).collect()
    number, texts, seconds = calls.figures()
    assert (number, texts) == (3, 250)
    assert 0.06 <= seconds < 5 and 0.02 <= calls.longest <= seconds


@pytest.fixture
def events(spark, small, tmp_path):
    rows = tables.file_envelopes(tables.table(spark, small, "events"))
    config = Config(mode="files", volume_root=str(tmp_path / "in"))
    write_envelopes(rows.repartition(20), config.base_path, rows_per_file=1_000_000)
    return config


def test_batches_of_the_logs_stream(spark, events, tmp_path, slow_encoder):
    calls = embedding.Calls(spark.sparkContext)
    listener = Latencies({"logs": calls})
    spark.streams.addListener(listener)
    try:
        query = streams.start_logs(
            spark, events, streams.Sink(path=str(tmp_path / "out")), streams.DRAIN, open_encoder=slow_encoder, calls=calls
        )
        with streams.stopping(query):
            streams.wait(query, None)
        end = time.monotonic() + 20
        while len(listener.call_figures(spark).collect()) < 2 and time.monotonic() < end:
            time.sleep(0.1)
    finally:
        spark.streams.removeListener(listener)
    found = {part: (batches, rows, median, late) for name, part, batches, rows, median, late, _ in listener.summary() if name == "logs"}
    assert found["triggerExecution"][0] == 2 and found["triggerExecution"][1] == 1000
    assert 0 < found["addBatch"][2] <= found["triggerExecution"][3]
    by_batch = listener.call_figures(spark).collect()
    logs = spark.read.parquet(str(tmp_path / "out")).count()
    assert sum(row["texts"] for row in by_batch) == logs == calls.figures()[1]
    assert all(row["calls"] >= 1 and row["seconds"] >= 0.02 * row["calls"] for row in by_batch)
    assert listener.frame(spark).count() == len(listener.summary())


def test_times_of_batches_without_rows_do_not_count():
    listener = Latencies()
    listener.add("q", 0, 0, {"addBatch": 1})
    listener.add("q", 1, 5, {"addBatch": 7, "walCommit": 2})
    assert listener.summary() == [("q", "addBatch", 1, 5, 7.0, 7.0, 7.0), ("q", "walCommit", 1, 5, 2.0, 2.0, 2.0)]


def test_files_that_were_read_are_moved_away(spark, events, tmp_path):
    from dataclasses import replace

    config = replace(events, clean_source="archive")
    assert config.file_options["sourceArchiveDir"].endswith("streaming_data_archive")
    query = streams.start_metrics(spark, config, streams.Sink(path=str(tmp_path / "out")))
    with streams.stopping(query):
        streams.wait(query, None)
    source = tmp_path / "in" / "dev" / "default"
    left = len(list((source / "streaming_data").rglob("*.json")))
    moved = len(list((source / "streaming_data_archive").rglob("*.json")))
    # Files of the last batch are moved after the next one.
    assert moved >= 10 and left + moved == 20


def test_file_options(spark, events):
    from dataclasses import replace

    assert events.file_options == {}
    config = replace(events, file_glob="nothing-*", max_file_age="7d", clean_source="delete")
    assert config.file_options == {"pathGlobFilter": "nothing-*", "maxFileAge": "7d", "cleanSource": "delete"}


def test_further_run_parameters(capsys):
    given, config = parse(
        "--start earliest --max-offsets 7 --max-files 3 --trigger once --partition-by topic --output /o --late /l --merge-every 4".split()
    )
    assert (config.logs.starting_offsets, config.metrics.starting_offsets) == ("earliest", "earliest")
    assert (config.logs.max_offsets, config.metrics.max_files, config.merge_every) == (7, 3, 4)
    assert trigger_for(given) == {"trigger": streams.DRAIN} and sink_for(given, config, "t").partition_by == ("topic",)
    given, config = parse(["--trigger", "2 seconds", "--backlog", "--max-bytes", "99"])
    assert trigger_for(given) == {"trigger": {"processingTime": "2 seconds"}}
    assert config.logs.max_bytes == 99 and config.logs.max_offsets is None
    given, config = parse([])
    assert trigger_for(given) == {} and config.logs == Config().logs
    with pytest.raises(SystemExit):
        parse(["--streams", "logs", "metrics", "--clean-source", "delete"])
    assert "other streams" in capsys.readouterr().err
