"""The two streams over JSON files: batches, restarts, hidden folders, waiting, failing."""

import shutil
import subprocess
import sys
from dataclasses import replace
from pathlib import Path

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from hostpulse.__main__ import main
from hostpulse.config import Config, Target
from hostpulse.functions.embedding import HashingEncoder
from hostpulse.operators import route, summaries
from hostpulse.plans import tables
from hostpulse.schemas import ENVELOPE
from hostpulse.session import shared_dir
from hostpulse.sinks.files import write_envelopes
from hostpulse.sources import read_files, stream_envelopes
from hostpulse.streaming import streams
from hostpulse.streaming.streams import Sink, drain, start_logs, start_metrics, stopping, wait


@pytest.fixture
def envelopes(spark, small):
    return tables.file_envelopes(tables.table(spark, small, "events")).repartition(5)


@pytest.fixture
def config(tmp_path):
    return Config(mode="files", volume_root=str(tmp_path))


def bag(rows):
    return sorted(map(repr, rows.collect()))


def finish(query):
    with stopping(query):
        assert wait(query, 120)
    return query


def test_stream_equals_batch(spark, envelopes, config, tmp_path):
    write_envelopes(envelopes, config.base_path)
    logs = finish(start_logs(spark, config, Sink(path=f"{tmp_path}/l"), streams.DRAIN))
    metrics = finish(start_metrics(spark, config, Sink(path=f"{tmp_path}/m")))
    static = read_files(spark, config.base_path)
    assert bag(spark.read.parquet(f"{tmp_path}/l")) == bag(route.enriched(route.logs(static)))
    assert bag(spark.read.parquet(f"{tmp_path}/m")) == bag(route.metrics(static))
    total = static.count()
    assert logs.lastProgress.observedMetrics["logs_input"]["messages"] == total
    seen = metrics.lastProgress.observedMetrics["metrics_input"]
    assert seen["logs"] + seen["metrics"] == total and seen["unreadable"] == 0


def test_file_limit_and_hidden_folders(spark, envelopes, config, tmp_path):
    write_envelopes(envelopes.limit(250).repartition(1), config.base_path, rows_per_file=10)
    hidden = Path(config.base_path, "_schemas")
    hidden.mkdir()
    shutil.copy(next(Path(config.base_path).glob("part-*.json")), hidden / "x.json")
    raw = stream_envelopes(spark, config, "metrics")
    query = drain(raw, Sink(path=f"{tmp_path}/raw"), config.checkpoint("raw"))
    assert [p.numInputRows for p in query.recentProgress if p.numInputRows] == [100, 100, 50]
    assert spark.read.parquet(f"{tmp_path}/raw").count() == 250
    sizes = [path.stat().st_size for path in Path(config.base_path).glob("part-*.json")]
    half = config.for_backlog(sum(sizes) // 2)
    query = drain(
        stream_envelopes(spark, half, "logs"), Sink(path=f"{tmp_path}/b"), half.checkpoint("b")
    )
    batches = [p.numInputRows for p in query.recentProgress if p.numInputRows]
    assert sum(batches) == 250 and len(batches) in (2, 3)


def test_restart_repeats_and_loses_nothing(spark, envelopes, config, tmp_path):
    sink = Sink(path=f"{tmp_path}/m")
    wide = config.for_backlog()
    first, second = envelopes.randomSplit([0.5, 0.5], seed=1)
    write_envelopes(first, config.base_path)
    finish(start_metrics(spark, wide, sink))
    finish(start_metrics(spark, wide, sink))
    once = bag(route.metrics(read_files(spark, config.base_path)))
    assert bag(spark.read.parquet(sink.path)) == once
    write_envelopes(second, config.base_path)
    finish(start_metrics(spark, wide, sink))
    both = bag(route.metrics(read_files(spark, config.base_path)))
    assert bag(spark.read.parquet(sink.path)) == both and len(both) > len(once)


def test_streams_have_checkpoints_of_their_own(spark, envelopes, config, tmp_path):
    write_envelopes(envelopes, config.base_path)
    finish(start_metrics(spark, config, Sink(path=f"{tmp_path}/m")))
    assert Path(config.checkpoint("metrics")).exists()
    assert not Path(config.checkpoint("logs")).exists()
    finish(start_logs(spark, config, Sink(path=f"{tmp_path}/l"), streams.DRAIN))
    assert spark.read.parquet(f"{tmp_path}/l").count() > 0


def test_folder_formats(spark, envelopes, config, tmp_path):
    """Partitioned Parquet, and envelopes that go through as JSON lines and are read again."""
    write_envelopes(envelopes, config.base_path)
    static = read_files(spark, config.base_path)
    finish(start_metrics(spark, config, Sink(path=f"{tmp_path}/m", partition_by=("topic",))))
    assert Path(f"{tmp_path}/m/topic=system_data").exists()
    stored = spark.read.parquet(f"{tmp_path}/m")
    expected = route.metrics(static)
    assert bag(stored.select(expected.columns)) == bag(expected)
    raw = spark.readStream.schema(ENVELOPE).json(config.base_path)
    drain(raw, Sink(path=f"{tmp_path}/copy", format="json"), f"{tmp_path}/cp")
    assert bag(read_files(spark, f"{tmp_path}/copy")) == bag(static)


def test_table_by_name(spark, envelopes, config):
    spark.sql("CREATE DATABASE IF NOT EXISTS monitoring")
    write_envelopes(envelopes, config.base_path)
    target = Target("spark_catalog", "monitoring")
    config = replace(config, target=target)
    name = target.table("parsed_metrics")
    finish(start_metrics(spark, config, Sink(table=name)))
    expected = route.metrics(read_files(spark, config.base_path))
    assert bag(spark.table(name)) == bag(expected)


def test_command_line_run(spark, envelopes, config, tmp_path):
    write_envelopes(envelopes, config.base_path)
    out = f"{tmp_path}/out"
    main(
        ["--streams", "metrics", "--mode", "files", "--volume-root", str(tmp_path), "--output", out]
    )
    expected = route.metrics(read_files(spark, config.base_path))
    assert bag(spark.read.parquet(f"{out}/parsed_metrics")) == bag(expected)


def test_waiting_is_bounded(spark, envelopes, config, tmp_path):
    write_envelopes(envelopes, config.base_path)
    query = start_logs(spark, config, Sink(path=f"{tmp_path}/l"))
    with stopping(query):
        assert wait(query, 1) is False
        assert query.isActive
    assert not query.isActive


def test_a_failure_reaches_the_caller_and_a_restart_goes_on(spark, envelopes, config, tmp_path):
    write_envelopes(envelopes, config.base_path)
    config = config.for_backlog()
    sink = Sink(path=f"{tmp_path}/l")

    def broken():
        raise ConnectionError("no model")

    query = start_logs(spark, config, sink, streams.DRAIN, broken)
    with pytest.raises(StreamingQueryException, match="no model"), stopping(query):
        wait(query, None)
    finish(start_logs(spark, config, sink, streams.DRAIN, HashingEncoder))
    static = read_files(spark, config.base_path)
    assert spark.read.parquet(sink.path).count() == route.logs(static).count()


def test_filter_comes_before_the_encoder(spark, config, envelopes):
    write_envelopes(envelopes, config.base_path)
    static = read_files(spark, config.base_path)
    plan = route.enriched(route.logs(static))._jdf.queryExecution().executedPlan().toString()
    assert plan.index("ArrowEvalPython") < plan.index("IN (log)" if "IN (log)" in plan else "= log)")
    assert plan.count("from_json") == 1
    assert "Exchange" not in plan
    assert "ReadSchema: struct<value:string,topic:string,timestamp:string>" in plan
    metrics = route.metrics(static)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in metrics and "Exchange" not in metrics


def test_windows_come_out_once_they_are_closed(spark, config, tmp_path):
    """On time, late but within the delay, too late; and the state survives a restart."""

    def send(*seconds):
        rows = [(1704067200.0 + s, float(i)) for i, s in enumerate(seconds)]
        payloads = spark.createDataFrame(rows, "s double, cpu double").select(
            F.to_json(
                F.struct(F.col("s").alias("timestamp"), F.lit("metrics").alias("type"), F.col("cpu").alias("cpu_percent"))
            ).alias("value"),
            *[F.lit(None).cast("string").alias(name) for name in ("key", "topic", "offset", "timestamp")],
            F.lit(0).alias("partition"),
        )
        write_envelopes(payloads.coalesce(1), config.base_path)

    config = replace(config, windows="closed")
    sink = Sink(path=f"{tmp_path}/w")
    run = lambda: finish(streams.start_metric_windows(spark, config, sink, streams.DRAIN))
    counts = lambda: {
        row["window_start"].second: row["n"] for row in spark.read.parquet(sink.path).collect()
    }
    send(1, 2, 7, 16)
    run()
    assert counts() == {0: 2}
    send(8, 3, 30)  # 8 s is within ten seconds of 16 s, 3 s belongs to a closed window
    run()
    assert counts() == {0: 2, 5: 2, 15: 1}
    logs = streams.start_log_windows(spark, config, Sink(path=f"{tmp_path}/l"), streams.DRAIN)
    finish(logs)
    assert spark.read.parquet(f"{tmp_path}/l").count() == 0


def test_shared_folder_follows_the_session(spark):
    one, two = shared_dir(spark, "x"), shared_dir(spark, "x")
    context = spark.sparkContext
    base = context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()
    assert one != two and one.startswith(base) and two.startswith(base)


def test_workers_need_no_installed_package(tmp_path, small):
    """From another folder and without a path to the package on the workers."""
    root = Path(__file__).resolve().parents[1]
    code = (
        "import sys; sys.path.insert(0, sys.argv[1])\n"
        "from hostpulse.session import session\n"
        "from hostpulse.plans.queries import embed_text, vector_topk\n"
        "s = session(**{'spark.master': 'local[2]', 'spark.sql.shuffle.partitions': '2'})\n"
        "assert embed_text(s, sys.argv[2]).count() and vector_topk(s, sys.argv[2]).count()\n"
    )
    done = subprocess.run(
        [sys.executable, "-c", code, str(root), small], cwd=tmp_path, capture_output=True, timeout=240
    )
    assert done.returncode == 0, done.stderr[-2000:]


def test_any_failed_stream_is_noticed(spark, tmp_path):
    """The first stream goes on for ever; the second fails at once."""
    rates = spark.readStream.format("rate").load()
    steady = rates.writeStream.format("noop").option("checkpointLocation", str(tmp_path / "a")).start()
    bad = rates.selectExpr("raise_error('broken') AS x").writeStream.format("noop")
    broken = bad.option("checkpointLocation", str(tmp_path / "b")).start()
    with streams.stopping(steady, broken):
        with pytest.raises(Exception, match="broken"):
            streams.wait_all([steady, broken], 60)


def test_a_failed_stream_starts_again_while_the_other_goes_on(spark, envelopes, config, tmp_path):
    write_envelopes(envelopes, config.base_path)
    config = replace(config, metrics=replace(config.metrics, max_files=1))
    tries, started = [], []

    def write(rows, batch):
        tries.append(batch)
        if len(tries) in (2, 3):
            raise ConnectionError("no database")
        rows.write.mode("overwrite").parquet(f"{tmp_path}/m/batch_id={batch}")

    def metrics():
        return start_metrics(spark, config, Sink(batch=write))

    def logs():
        started.append(start_logs(spark, config, Sink(path=f"{tmp_path}/l")))  # goes on for ever
        return started[-1]

    with pytest.raises(StreamingQueryException, match="no database"):
        streams.supervise({"metrics": metrics, "logs": logs}, restarts=1, pause=0.01, seconds=120)
    assert len(started) == 1 and not started[0].isActive and tries == [0, 1, 1]
    assert not streams.supervise({"metrics": metrics, "logs": logs}, restarts=1, pause=0.01, seconds=15)
    assert tries == [0, 1, 1, *range(1, tries[-1] + 1)]  # resumed where it failed
    static = read_files(spark, config.base_path)
    assert bag(spark.read.parquet(f"{tmp_path}/m").drop("batch_id")) == bag(route.metrics(static))
    assert spark.read.parquet(f"{tmp_path}/l").count() == route.logs(static).count()


def test_a_stream_that_cannot_start_is_tried_again(spark, tmp_path):
    tries = []

    def start():
        tries.append(1)
        if len(tries) < 3:
            raise ConnectionError("no broker")
        rows = spark.readStream.format("rate").load().writeStream.format("noop")
        return rows.option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()

    assert streams.supervise({"x": start}, restarts=2, pause=0.01, seconds=60)
    tries.clear()
    with pytest.raises(ConnectionError):
        streams.supervise({"x": start}, restarts=1, pause=0.01, seconds=60)


def _samples(spark, config, times):
    """Metrics messages as files: sample time in seconds, broker time equal to it unless given."""
    rows = spark.createDataFrame(times, "s double, cpu double, broker string")
    body = F.struct(F.col("s").alias("timestamp"), F.lit("metrics").alias("type"), F.col("cpu").alias("cpu_percent"))
    rows = rows.select(
        F.to_json(body).alias("value"),
        *[F.lit(None).cast("string").alias(name) for name in ("key", "topic", "offset")],
        F.lit(0).alias("partition"),
        F.col("broker").alias("timestamp"),
    )
    write_envelopes(rows.repartition(25), config.base_path)


@pytest.mark.parametrize("windows", ["parts", "closed"])
def test_one_wrong_clock_costs_no_other_row(spark, config, tmp_path, windows):
    start, broker = 1704067200.0, "2024-01-01T00:10:00Z"
    times = [(start + i, 1.0, broker) for i in range(500)]
    config = replace(config, windows=windows, window_delay="10 minutes")
    _samples(spark, config, times + [(start + 366 * 86400.0, 1.0, broker), (None, 1.0, broker)])
    sink = Sink(path=f"{tmp_path}/w")
    query = finish(streams.start_metric_windows(spark, config, sink, streams.DRAIN))
    if windows == "parts":
        found = summaries.merged_metrics(spark.read.parquet(sink.path))
        counts = {row["window_start"]: row["n"] for row in found.collect()}
        assert sum(counts.values()) == 502 and counts[None] == 1 and len(counts) == 102
    else:
        seen = [p.observedMetrics["metrics_5s_input"] for p in query.recentProgress if p.observedMetrics]
        assert sum(row["ahead"] for row in seen) == 1 and sum(row["timeless"] for row in seen) == 1
        late = [(start + i, 1.0, broker) for i in range(500, 1500)]
        _samples(spark, config, late)
        finish(streams.start_metric_windows(spark, config, sink, streams.DRAIN))
        found = spark.read.parquet(sink.path).where(F.col("window_start") < F.timestamp_seconds(F.lit(start + 500)))
        assert found.agg(F.sum("n")).first()[0] == 500


def test_parts_add_up_to_the_windows(spark, config, tmp_path):
    """Values that no decimal holds, nulls and a repeated run; into a folder and a table."""
    start = 1704067200.0
    values = [1e13, 3e13, 1.0, 1e-7, 1e-7, 0.1, 0.2, None]
    _samples(spark, config, [(start + 5 * (i // 8), values[i % 8] if i // 8 else 0.1, None) for i in range(80)])
    whole = bag(summaries.metrics_by_window(route.metric_samples(read_files(spark, config.base_path))))
    sink = Sink(path=f"{tmp_path}/w")
    for _ in range(2):
        finish(streams.start_metric_windows(spark, config, sink, streams.DRAIN))
        assert bag(summaries.merged_metrics(spark.read.parquet(sink.path))) == whole
    spark.sql("CREATE DATABASE IF NOT EXISTS monitoring")
    name = "spark_catalog.monitoring.metrics_parts"
    write = streams.parts_sink(summaries.metric_parts, Sink(table=name)).batch
    rows = route.metric_samples(read_files(spark, config.base_path))
    for batch in (0, 1, 1):
        write(rows, batch)
    assert spark.table(name).agg(F.sum("n")).first()[0] == 160
    spark.sql(f"DROP TABLE {name}")
