"""The logs and the metrics stream. Each has its own scan and checkpoint, so each restarts alone."""

import logging
import time
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.readwriter import DataStreamWriter

from ..config import Config
from ..functions.embedding import Calls, HashingEncoder
from ..operators import route, summaries
from ..sources import stream_envelopes
from . import closed
from . import parts as written

log = logging.getLogger(__name__)

LOGS_TRIGGER = {"processingTime": "100 milliseconds"}
DRAIN = {"availableNow": True}
WINDOWS_TRIGGER = {"processingTime": "5 seconds"}


@dataclass(frozen=True)
class Sink:
    """Where a stream writes: a folder, a table, or a function per micro-batch."""

    path: str | None = None
    format: str = "parquet"
    table: str | None = None
    batch: Callable[[DataFrame, int], None] | None = None
    # For other formats, such as the options of the Kafka sink with its password.
    options: dict[str, str] = field(default_factory=dict, repr=False)
    partition_by: tuple[str, ...] = ()

    def start(self, writer: DataStreamWriter) -> StreamingQuery:
        if self.batch is not None:
            return writer.foreachBatch(self.batch).start()
        if self.partition_by:
            writer = writer.partitionBy(*self.partition_by)
        writer = writer.format(self.format).options(**self.options)
        return writer.toTable(self.table) if self.table else writer.start(self.path)


def logs_frame(
    spark: SparkSession, config: Config, open_encoder=HashingEncoder, calls: Calls | None = None
) -> DataFrame:
    envelopes = stream_envelopes(spark, config, "logs")
    rows = route.logs(envelopes, config.clean, config.zone, audit="logs_input")
    return route.enriched(rows, open_encoder, calls=calls)


def metrics_frame(spark: SparkSession, config: Config) -> DataFrame:
    envelopes = stream_envelopes(spark, config, "metrics")
    return route.metrics(envelopes, config.zone, audit="metrics_input")


def _watermarked(samples: DataFrame, config: Config, delay: str | None, audit: str) -> DataFrame:
    """Samples with a watermark that no wrong clock moves. Rows left out are in `observedMetrics[audit]`."""
    ahead = F.coalesce(F.expr(f"at > broker_time + INTERVAL {config.clock_ahead}"), F.lit(False))
    seen = samples.observe(
        audit,
        F.count(F.lit(1)).alias("samples"),
        F.count_if(F.col("at").isNull()).alias("timeless"),
        F.count_if(ahead).alias("ahead"),
    )
    return summaries.streamed(seen.where(~ahead), delay or config.window_delay)


def metric_windows_frame(spark: SparkSession, config: Config, delay: str | None = None) -> DataFrame:
    samples = route.metric_samples(stream_envelopes(spark, config, "metrics"), "broker_time")
    return summaries.metrics_by_window(_watermarked(samples, config, delay, "metrics_5s_input"))


def log_windows_frame(spark: SparkSession, config: Config, delay: str | None = None) -> DataFrame:
    samples = route.log_samples(stream_envelopes(spark, config, "logs"), "broker_time")
    return summaries.logs_by_window(_watermarked(samples, config, delay, "logs_5s_input"))


def parts_sink(
    aggregate: Callable[[DataFrame], DataFrame],
    sink: Sink,
    add_up: Callable[[DataFrame], DataFrame] | None = None,
    merge_every: int | None = None,
) -> Sink:
    """Writes what each batch adds to its windows, with its `batch_id`; a repeated batch replaces what it wrote.

    No state is kept and no row is late. `summaries.merged_metrics` and `merged_logs` add the parts up. With `merge_every`, a
    folder's finished batches are merged by `add_up` after every so many; `parts.read` reads them.
    """

    def write(rows: DataFrame, batch: int) -> None:
        parts = aggregate(rows).withColumn("batch_id", F.lit(batch).cast("bigint"))
        if sink.batch is not None:
            return sink.batch(parts, batch)
        if sink.table is None:
            if batch <= (upto := written.current(rows.sparkSession, sink.path).upto):
                raise RuntimeError(f"{sink.path} holds batches up to {upto}: a new checkpoint needs a new folder")
            writer = parts.drop("batch_id").write.mode("overwrite").format(sink.format)
            writer.options(**sink.options).save(f"{sink.path}/batch_id={batch}")
            if merge_every and add_up:
                written.merge(rows.sparkSession, sink.path, add_up, batches=merge_every)
            return None
        spark = rows.sparkSession
        if not spark.catalog.tableExists(sink.table):
            empty = parts.limit(0).write.format(sink.format).options(**sink.options)
            empty.partitionBy("batch_id").saveAsTable(sink.table)
        spark.sql(
            f"INSERT OVERWRITE TABLE {sink.table} PARTITION (batch_id = {batch}) SELECT * FROM {{parts}}",
            parts=parts.drop("batch_id"),
        )

    return Sink(batch=write)


def _folder(sink: Sink) -> str:
    if sink.path is None or sink.format != "parquet":
        raise ValueError("closed windows with a side table are written to a Parquet folder")
    return sink.path


def start(
    rows: DataFrame, sink: Sink, checkpoint: str, trigger: dict, name: str | None = None
) -> StreamingQuery:
    writer = (
        rows.writeStream.outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
    )
    return sink.start(writer.queryName(name) if name else writer)


def start_logs(
    spark: SparkSession,
    config: Config,
    sink: Sink,
    trigger: dict = LOGS_TRIGGER,
    open_encoder=HashingEncoder,
    calls: Calls | None = None,
) -> StreamingQuery:
    rows = logs_frame(spark, config, open_encoder, calls)
    return start(rows, sink, config.checkpoint("logs"), trigger, "logs")


def start_metrics(
    spark: SparkSession, config: Config, sink: Sink, trigger: dict = DRAIN
) -> StreamingQuery:
    return start(metrics_frame(spark, config), sink, config.checkpoint("metrics"), trigger, "metrics")


def start_metric_windows(
    spark: SparkSession, config: Config, sink: Sink, trigger: dict = WINDOWS_TRIGGER, late: str | None = None
) -> StreamingQuery:
    """CPU and memory per five seconds, as parts of each batch or, if so configured, as closed windows.

    With a folder for `late` samples, closed windows and that folder lose no sample (see `closed`); otherwise late ones are dropped.
    """
    if config.windows == "parts":
        rows = route.metric_samples(stream_envelopes(spark, config, "metrics"))
        sink = parts_sink(summaries.metric_parts, sink, summaries.added_metric_parts, config.merge_every)
        return start(rows, sink, config.checkpoint("metrics_5s_parts"), trigger, "metrics-5s")
    if late is not None:
        rows = route.metric_samples(stream_envelopes(spark, config, "metrics"), "broker_time")
        write = closed.closing_metrics(_folder(sink), late, config.window_delay, config.clock_ahead)
        return start(rows, Sink(batch=write), config.checkpoint("metrics_5s_closed"), trigger, "metrics-5s")
    rows = metric_windows_frame(spark, config)
    return start(rows, sink, config.checkpoint("metrics_5s"), trigger, "metrics-5s")


def start_log_windows(
    spark: SparkSession, config: Config, sink: Sink, trigger: dict = WINDOWS_TRIGGER, late: str | None = None
) -> StreamingQuery:
    """Logs per category and five seconds, in the same two ways."""
    if config.windows == "parts":
        rows = route.log_samples(stream_envelopes(spark, config, "logs"))
        sink = parts_sink(summaries.log_parts, sink, summaries.added_log_parts, config.merge_every)
        return start(rows, sink, config.checkpoint("logs_5s_parts"), trigger, "logs-5s")
    if late is not None:
        rows = route.log_samples(stream_envelopes(spark, config, "logs"), "broker_time")
        write = closed.closing_logs(_folder(sink), late, config.window_delay, config.clock_ahead)
        return start(rows, Sink(batch=write), config.checkpoint("logs_5s_closed"), trigger, "logs-5s")
    rows = log_windows_frame(spark, config)
    return start(rows, sink, config.checkpoint("logs_5s"), trigger, "logs-5s")


def wait(query: StreamingQuery, seconds: float | None = 10) -> bool:
    """True once the query has ended. After `seconds` it goes on and False is returned.

    A failed query raises its exception here.
    """
    if seconds is None:
        query.awaitTermination()
        return True
    ended = bool(query.awaitTermination(seconds))
    if not ended:
        log.warning("query %s is still running after %s s", query.name or query.id, seconds)
    return ended


def wait_all(queries: list[StreamingQuery], seconds: float | None = None) -> bool:
    """True once all queries have ended, False after `seconds`. Raises as soon as any of them has failed."""
    end = None if seconds is None else time.monotonic() + seconds
    while True:
        active = [query for query in queries if query.isActive]
        for query in queries:
            if query not in active:
                query.awaitTermination()  # raises if it failed
        if not active:
            return True
        if end is not None and time.monotonic() >= end:
            return False
        active[0].awaitTermination(min(1.0, max(0.1, end - time.monotonic())) if end is not None else 1.0)


def supervise(
    starts: dict[str, Callable[[], StreamingQuery]],
    restarts: int = 3,
    pause: float = 1.0,
    forget: float = 600.0,
    seconds: float | None = None,
) -> bool:
    """Runs all streams and starts one that fails again, from its checkpoint, while the others go on.

    A stream that fails for the `restarts` + 1st time within `forget` seconds ends the run with its error. Before each new start it
    rests for `pause` seconds, twice as long each time. True once all have ended by themselves, False after `seconds`; all are
    stopped on the way out.
    """
    end = None if seconds is None else time.monotonic() + seconds
    running: dict[str, StreamingQuery] = {}
    due = {name: 0.0 for name in starts}  # names to start, and not before when
    failed: dict[str, list[float]] = {name: [] for name in starts}

    def failure(name: str, error: Exception) -> None:
        now = time.monotonic()
        failed[name] = [at for at in failed[name] if now - at < forget] + [now]
        if len(failed[name]) > restarts:
            raise error
        due[name] = now + pause * 2 ** (len(failed[name]) - 1)
        log.warning("stream %s failed (%s of %s restarts): %s", name, len(failed[name]), restarts, error)

    try:
        while running or due:
            for name in [name for name, at in due.items() if at <= time.monotonic()]:
                del due[name]
                try:
                    running[name] = starts[name]()
                except Exception as error:  # a source that can't be reached fails here already
                    failure(name, error)
            for name, query in [*running.items()]:
                if not query.isActive:
                    del running[name]
                    if (error := query.exception()) is not None:
                        failure(name, error)
            if end is not None and time.monotonic() >= end:
                return not (running or due)
            if running or due:
                time.sleep(0.1)
        return True
    finally:
        for query in running.values():
            query.stop()


@contextmanager
def stopping(*queries: StreamingQuery) -> Iterator[None]:
    """Stops the queries on the way out, whatever happened inside."""
    try:
        yield
    finally:
        for query in queries:
            query.stop()


def drain(rows: DataFrame, sink: Sink, checkpoint: str) -> StreamingQuery:
    """Processes what is there, then ends. Raises if the query failed."""
    query = start(rows, sink, checkpoint, DRAIN)
    with stopping(query):
        wait(query, None)
    return query
