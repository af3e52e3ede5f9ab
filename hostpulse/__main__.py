"""Runs the streams: `python -m hostpulse --streams logs metrics --mode files --volume-root DIR`."""

import argparse
import importlib
import os
import sys
from dataclasses import replace
from functools import partial

from pyspark.sql import SparkSession

from .config import Config, Secret, Target
from .functions.embedding import Calls
from .session import session
from .sinks.jdbc import Database, jdbc_writer
from .streaming import streams
from .streaming.latency import Latencies

# Stream, what starts it, and the table it fills.
STREAMS = {
    "logs": (streams.start_logs, "enriched_logs"),
    "metrics": (streams.start_metrics, "parsed_metrics"),
    "logs-5s": (streams.start_log_windows, "log_counts_5s"),
    "metrics-5s": (streams.start_metric_windows, "metrics_5s"),
}


def parse(arguments: list[str] | None = None) -> tuple[argparse.Namespace, Config]:
    defaults = Config.from_env()
    parser = argparse.ArgumentParser(prog="hostpulse")
    parser.add_argument("--streams", nargs="+", choices=[*STREAMS], default=["logs", "metrics"])
    parser.add_argument("--mode", choices=["kafka", "files"], default=defaults.mode)
    parser.add_argument("--environment", default=defaults.environment)
    parser.add_argument("--volume-root", default=defaults.volume_root)
    parser.add_argument("--namespace", default=defaults.namespace)
    parser.add_argument("--topics", default=defaults.topics)
    parser.add_argument("--input", help="scanned folder in file mode; default: made of root and environment")
    parser.add_argument("--clean", choices=["full", "prefix"], default=defaults.clean)
    parser.add_argument("--broker-zone", default=defaults.broker_zone, help="empty: broker times stay in UTC")
    parser.add_argument("--tolerate-data-loss", action="store_true", help="go on if offsets are gone")
    parser.add_argument("--backlog", action="store_true", help="batches as wide as the cluster")
    parser.add_argument("--start", help="first offsets of all streams: earliest, latest or a JSON text of offsets")
    parser.add_argument("--max-offsets", type=int, help="Kafka messages in a batch")
    parser.add_argument("--max-files", type=int, help="files in a batch")
    parser.add_argument("--max-bytes", type=int, help="bytes of files in a batch, instead of a number of files")
    parser.add_argument("--trigger", help="an interval such as '5 seconds', or `once` to end when all is read")
    parser.add_argument("--partition-by", nargs="+", default=[], metavar="COLUMN", help="folders or table partitions of the output")
    parser.add_argument("--clean-source", choices=["archive", "delete", "off"], default=defaults.clean_source)
    parser.add_argument("--max-file-age", default=defaults.max_file_age, metavar="AGE", help="pass over older files, such as 7d")
    parser.add_argument("--file-glob", default=defaults.file_glob, metavar="PATTERN", help="read only matching files")
    parser.add_argument("--latency", action="store_true", help="print the times of batches at the end")
    parser.add_argument("--windows", choices=["parts", "closed"], default=defaults.windows)
    parser.add_argument("--merge-every", type=int, metavar="BATCHES", help="merge the parts of windows in a folder")
    parser.add_argument("--window-delay", default=defaults.window_delay)
    parser.add_argument("--late", metavar="FOLDER", help="closed windows: keep late samples here instead of losing them")
    parser.add_argument("--clock-ahead", default=defaults.clock_ahead)
    parser.add_argument("--encoder", metavar="MODULE:NAME", help="function that opens the encoder of a task")
    parser.add_argument("--catalog", default=defaults.target.catalog)
    parser.add_argument("--schema", default=defaults.target.schema)
    parser.add_argument("--output", help="folder for Parquet output; default: tables")
    parser.add_argument("--jdbc-url", help="write to this database instead of tables")
    parser.add_argument("--jdbc-user")
    parser.add_argument(
        "--run-name", default="run", help="change it for the database after deleting a checkpoint"
    )
    parser.add_argument("--restarts", type=int, default=0, help="start a failed stream again, so often in ten minutes")
    parser.add_argument("--wait", type=float, help="seconds to run; default: until the streams end")
    given = parser.parse_args(arguments)
    config = replace(
        defaults,
        mode=given.mode,
        environment=given.environment,
        volume_root=given.volume_root,
        namespace=given.namespace,
        topics=given.topics,
        target=Target(given.catalog, given.schema),
        input_path=given.input,
        clean=given.clean,
        broker_zone=given.broker_zone or None,
        fail_on_data_loss=not given.tolerate_data_loss,
        windows=given.windows,
        merge_every=given.merge_every,
        window_delay=given.window_delay,
        clock_ahead=given.clock_ahead,
        clean_source=given.clean_source,
        max_file_age=given.max_file_age,
        file_glob=given.file_glob,
    )
    if config.clean_source != "off" and len(given.streams) > 1:
        parser.error("--clean-source takes files away from the other streams that read the same folder")
    if given.backlog:
        config = config.for_backlog()
    limits = {
        "starting_offsets": given.start,
        "max_offsets": given.max_offsets,
        "max_files": given.max_files,
        "max_bytes": given.max_bytes,
    }
    limits = {name: value for name, value in limits.items() if value is not None}
    return given, replace(config, logs=replace(config.logs, **limits), metrics=replace(config.metrics, **limits))


def trigger_for(given: argparse.Namespace) -> dict:
    """The trigger, if one is given; each stream has its own otherwise."""
    if not given.trigger:
        return {}
    return {"trigger": streams.DRAIN if given.trigger == "once" else {"processingTime": given.trigger}}


def encoder_for(given: argparse.Namespace) -> dict:
    """The encoder of the logs stream, if one is named."""
    if not given.encoder:
        return {}
    module, _, name = given.encoder.partition(":")
    return {"open_encoder": getattr(importlib.import_module(module), name)}


def sink_for(
    given: argparse.Namespace, config: Config, table: str, spark: SparkSession | None = None
) -> streams.Sink:
    if given.output:
        return streams.Sink(path=f"{given.output}/{table}", partition_by=tuple(given.partition_by))
    if given.jdbc_url:
        # The URL names the database, so the table needs only its schema.
        name = Target("", config.target.schema).table(table)
        password = (
            Secret.from_env("HOSTPULSE_JDBC_PASSWORD")
            if "HOSTPULSE_JDBC_PASSWORD" in os.environ
            else None
        )
        database = Database(given.jdbc_url, user=given.jdbc_user, password=password)
        query = f"{given.run_name}_{config.mode}_{table}"
        folder = f"{config.base_path}/_staging"
        return streams.Sink(batch=jdbc_writer(spark, database, query, name, folder))
    return streams.Sink(table=config.target.table(table), partition_by=tuple(given.partition_by))


def main(arguments: list[str] | None = None) -> None:
    given, config = parse(arguments)
    spark = session()
    calls = Calls(spark.sparkContext)
    latencies = Latencies({"logs": calls})
    if given.latency:
        spark.streams.addListener(latencies)
    starts = {}
    for name in given.streams:
        start, table = STREAMS[name]
        more = encoder_for(given) | {"calls": calls} if name == "logs" else {}
        if name.endswith("-5s") and given.late:
            more = {"late": f"{given.late}/{table}"}
        sink = sink_for(given, config, table, spark)
        starts[name] = partial(start, spark, config, sink, **trigger_for(given), **more)
    try:
        streams.supervise(starts, given.restarts, seconds=given.wait)
    except KeyboardInterrupt:
        print("stopped", file=sys.stderr)
    if given.latency:
        for query, part, batches, _, median, late, longest in latencies.summary():
            print(f"{query} {part}: {batches} batches, median {median:.0f} ms, 99th percentile {late:.0f} ms, longest {longest:.0f} ms")
        number, texts, seconds = calls.figures()
        print(f"encoder: {number} calls, {texts} texts, {seconds:.1f} s, longest {calls.longest:.2f} s")


if __name__ == "__main__":
    main()
