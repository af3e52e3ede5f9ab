"""One query per operator, over the whole of its tables. Times leave as zone-free UTC."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import Config
from ..functions import embedding, payload, text, times
from ..operators import collect, retrieve, route, summaries
from ..schemas import LOG, METRICS
from ..session import shared_dir
from ..sinks import kafka
from ..sinks.files import write_envelopes
from ..sources import read_files
from ..streaming import closed, parts, streams
from . import tables
from .tables import table, zoneless

NEIGHBOURS = 10
WINDOW_DELAY = "1 hour"
BATCH_BYTES = 1 << 40
SMALL_FILES = 40


def _utc(spark: SparkSession) -> None:
    """The test tables hold zone-free UTC times, and they become instants in the session's zone."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def _events(spark: SparkSession, folder: str) -> DataFrame:
    _utc(spark)
    return table(spark, folder, "events")


def _envelopes(spark: SparkSession, folder: str) -> DataFrame:
    return tables.envelopes(_events(spark, folder))


def decode_payload(spark: SparkSession, folder: str) -> DataFrame:
    """All payload fields, read from the bytes of the value as they come from a broker."""
    rows = _envelopes(spark, folder).withColumn("value", F.col("value").cast("binary"))
    return route.decoded(rows).select(
        F.col("offset").alias("event_id"),
        "payload.timestamp",
        "payload.type",
        "payload.cpu_percent",
        F.col("payload.memory.total").alias("total_memory"),
        F.col("payload.memory.available").alias("available_memory"),
        F.col("payload.memory.percent").alias("percent_memory"),
        "payload.disk_io.read_bytes",
        "payload.disk_io.write_bytes",
        "payload.category",
        "payload.log_raw",
    )


def encode_payload(spark: SparkSession, folder: str) -> DataFrame:
    """Columns to payload to envelope and back: what comes out is what went in."""
    rows = _envelopes(spark, folder)
    return route.decoded(rows).select(
        F.col("offset").alias("event_id"),
        "topic",
        "partition",
        zoneless(F.col("broker_time")).alias("broker_time"),
        zoneless(times.payload_instant(F.col("payload.timestamp"))).alias("taken"),
        "payload.type",
        "payload.cpu_percent",
        F.col("payload.disk_io.write_bytes").alias("write_bytes"),
        "payload.log_raw",
    )


def payload_audit(spark: SparkSession, folder: str) -> DataFrame:
    """Messages by outcome when plain documents, which are no payloads, arrive among the events."""
    strays = table(spark, folder, "documents").select(F.col("text").alias("value"))
    values = _envelopes(spark, folder).select("value").unionByName(strays)
    kind = payload.payload_type(F.col("value"))
    return (
        values.select(F.coalesce(kind, F.lit("unreadable")).alias("outcome"))
        .groupBy("outcome")
        .agg(F.count(F.lit(1)).alias("messages"))
    )


def _zone_free(rows: DataFrame) -> DataFrame:
    return rows.withColumn("eventhub_timestamp", zoneless(F.col("eventhub_timestamp")))


def route_logs(spark: SparkSession, folder: str) -> DataFrame:
    return _zone_free(route.logs(_envelopes(spark, folder)))


def route_metrics(spark: SparkSession, folder: str) -> DataFrame:
    return _zone_free(route.metrics(_envelopes(spark, folder), zone="Europe/Berlin"))


def clean_log_text(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents").select(
        "doc_id", text.strip_noise(F.col("text")).alias("log_raw")
    )


def clean_log_prefix(spark: SparkSession, folder: str) -> DataFrame:
    return _zone_free(route.logs(_envelopes(spark, folder), clean="prefix"))


def shift_broker_time(spark: SparkSession, folder: str) -> DataFrame:
    """Event times, all in winter, and order dates, which fall into every season."""
    events = _events(spark, folder).select(
        F.lit("event").alias("source"), F.col("event_id").alias("id"), F.col("ts").alias("utc")
    )
    orders = table(spark, folder, "orders").select(
        F.lit("order").alias("source"),
        F.col("o_orderkey").alias("id"),
        F.col("o_orderdate").cast("timestamp_ntz").alias("utc"),
    )
    both = events.unionByName(orders)
    shifted = times.to_wall_time(F.col("utc").cast("timestamp"))
    return both.select("source", "id", "utc", zoneless(shifted).alias("berlin"))


def _weights(rows: DataFrame, vector: str) -> DataFrame:
    """The vectors in long form, without their zeros."""
    keys = [name for name in rows.columns if name != vector]
    return (
        rows.select(*keys, F.posexplode(vector).alias("dim", "weight"))
        .where(F.col("weight") != 0)
        .withColumn("weight", F.round("weight", 6))
    )


def embed_text(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "conversations").select(
        "conv_id", "turn", embedding.embed(F.col("text")).alias("vector")
    )
    return _weights(rows, "vector")


def filter_log_lines(spark: SparkSession, folder: str) -> DataFrame:
    return collect.useful_lines(tables.host_lines(table(spark, folder, "documents")))


def route_categories(spark: SparkSession, folder: str) -> DataFrame:
    return collect.by_category(tables.host_records(_events(spark, folder)))


def assign_topic(spark: SparkSession, folder: str) -> DataFrame:
    rows = _envelopes(spark, folder).select(
        F.col("offset").alias("event_id"), payload.payload_type(F.col("value")).alias("type")
    )
    return collect.addressed(rows)


def deliver_messages(spark: SparkSession, folder: str) -> DataFrame:
    """Events drained in two batches: clicks as metrics and errors as logs are sent, what has no topic is kept beside it."""
    rows = _events(spark, folder).select(
        "event_id",
        F.when(F.col("event_type") == "click", METRICS).when(F.col("event_type") == "error", LOG)
        .otherwise(F.col("event_type")).alias("type"),
        F.to_json(F.struct("event_id", F.when(F.col("user_id") % 50 == 0, F.repeat("props", 20)).otherwise(F.col("props")).alias("props"))).alias("value"),
    )
    target = shared_dir(spark, "delivered")

    def send(records: DataFrame) -> None:
        records.write.mode("append").parquet(f"{target}/sent")

    write = kafka.delivering(send, f"{target}/dead", most=200)
    for batch in (0, 1):
        write(rows.where(F.col("event_id") % 2 == batch), batch)
    sent = spark.read.schema("topic string, value string").parquet(f"{target}/sent")
    dead = spark.read.schema("event_id bigint, type string, value string, reason string").parquet(f"{target}/dead")
    return sent.select(
        F.get_json_object("value", "$.event_id").cast("bigint").alias("event_id"), "topic", F.lit(None).cast("string").alias("reason")
    ).unionByName(dead.select("event_id", F.lit(None).cast("string").alias("topic"), "reason"))


def _zone_free_windows(rows: DataFrame) -> DataFrame:
    return rows.withColumn("window_start", zoneless(F.col("window_start")))


def metrics_5s(spark: SparkSession, folder: str) -> DataFrame:
    rows = route.metric_samples(_envelopes(spark, folder))
    return _zone_free_windows(summaries.metrics_by_window(rows))


def log_counts_5s(spark: SparkSession, folder: str) -> DataFrame:
    rows = route.log_samples(_envelopes(spark, folder))
    return _zone_free_windows(summaries.logs_by_window(rows))


def ingest_lag(spark: SparkSession, folder: str) -> DataFrame:
    return summaries.ingest_lag(route.arrivals(_envelopes(spark, folder)))


def vector_topk(spark: SparkSession, folder: str) -> DataFrame:
    """For each label the vectors nearest to the mean of all vectors with that label."""
    vectors = table(spark, folder, "embeddings")
    dims = retrieve.width_of(vectors, "embedding") or 0
    # One row of sums per label and task goes into the shuffle; long form would shuffle each number.
    means = vectors.groupBy("label").agg(
        F.array(*[F.avg(F.col("embedding")[i].cast("double")) for i in range(dims)]).alias(
            "query_vector"
        )
    )
    queries = means.withColumnRenamed("label", "query_id")
    return retrieve.nearest(vectors, queries, NEIGHBOURS, dims, id_cols=["vec_id"], strict=True)


def _questions(spark: SparkSession, folder: str) -> DataFrame:
    """One question per event type: the user with the highest number among its events."""
    users = _events(spark, folder).groupBy("event_type").agg(F.max("user_id").alias("user"))
    words = F.concat(F.lit("user "), F.col("user").cast("string"))
    return users.select(F.col("event_type").alias("query_id"), embedding.embed(words).alias("query_vector"))


def retrieve_logs(spark: SparkSession, folder: str) -> DataFrame:
    """The logs nearest to a question in words, which is embedded like the logs."""
    rows = _envelopes(spark, folder)
    found = route.of_type(rows, LOG, fields=route.LOG_FIELDS).select(
        F.col("offset").alias("event_id"),
        embedding.embed(text.strip_noise(F.col("payload.log_raw"))).alias("embedding"),
    )
    return retrieve.nearest(found, _questions(spark, folder), NEIGHBOURS, id_cols=["event_id"], strict=True)


def _file_run(spark: SparkSession, folder: str) -> Config:
    """A configuration whose source folder holds all events as JSON envelopes, written anew for each run."""
    config = Config(mode="files", volume_root=shared_dir(spark, "envelopes"))
    write_envelopes(tables.file_envelopes(_events(spark, folder)), config.base_path)
    _utc(spark)
    return config


def _stored(spark: SparkSession, rows: DataFrame, name: str) -> DataFrame:
    """Drains a stream into a Parquet folder and reads that back. Each run has its own checkpoint."""
    run = shared_dir(spark, name)
    streams.drain(rows, streams.Sink(path=f"{run}/out"), f"{run}/checkpoint")
    return spark.read.schema(rows.schema).parquet(f"{run}/out")


def envelope_files(spark: SparkSession, folder: str) -> DataFrame:
    """All events written as JSON-lines files and read back through the file source."""
    path = shared_dir(spark, "envelope-files")
    write_envelopes(tables.file_envelopes(_events(spark, folder)), path)
    rows = read_files(spark, path)
    return rows.select(
        "topic",
        "partition",
        F.col("offset").alias("event_id"),
        zoneless(F.col("broker_time")).alias("broker_time"),
        payload.payload_type(F.col("value")).alias("type"),
    )


def stream_logs(spark: SparkSession, folder: str) -> DataFrame:
    """JSON files, decoding, routing, cleaning, embedding, Parquet: the whole logs stream."""
    config = _file_run(spark, folder).for_backlog(BATCH_BYTES)
    stored = _stored(spark, streams.logs_frame(spark, config), "stream-logs")
    return _weights(_zone_free(stored), "embedding_vector")


def stream_metrics(spark: SparkSession, folder: str) -> DataFrame:
    config = _file_run(spark, folder).for_backlog(BATCH_BYTES)
    return _zone_free(_stored(spark, streams.metrics_frame(spark, config), "stream-metrics"))


def stream_metrics_5s(spark: SparkSession, folder: str) -> DataFrame:
    """The windows that are closed when the input ends."""
    config = _file_run(spark, folder).for_backlog()
    windows = streams.metric_windows_frame(spark, config, WINDOW_DELAY)
    return _zone_free_windows(_stored(spark, windows, "stream-metrics-5s"))


def stream_log_counts_5s(spark: SparkSession, folder: str) -> DataFrame:
    config = _file_run(spark, folder).for_backlog()
    windows = streams.log_windows_frame(spark, config, WINDOW_DELAY)
    return _zone_free_windows(_stored(spark, windows, "stream-log-counts-5s"))


def _small_batches(spark: SparkSession, folder: str, **more) -> Config:
    """All events in files in no order of time, for the small batches of the usual limits."""
    config = Config(mode="files", volume_root=shared_dir(spark, "small-batches"), **more)
    events = tables.file_envelopes(_events(spark, folder)).repartition(SMALL_FILES)
    write_envelopes(events, config.base_path, rows_per_file=1_000_000)
    return config


def stream_metrics_5s_merged(spark: SparkSession, folder: str) -> DataFrame:
    """The same windows, their parts merged by day while the stream runs."""
    config = _small_batches(spark, folder, merge_every=2)
    out = shared_dir(spark, "stream-metrics-5s-merged")
    query = streams.start_metric_windows(spark, config, streams.Sink(path=out), streams.DRAIN)
    with streams.stopping(query):
        streams.wait(query, None)
    return _zone_free_windows(summaries.merged_metrics(parts.read(spark, out)))


def stream_log_counts_5s_late(spark: SparkSession, folder: str) -> DataFrame:
    """Closed windows of files in no order of time, with the samples that came too late for theirs and the windows still open."""
    config = _small_batches(spark, folder, windows="closed", window_delay=WINDOW_DELAY)
    out, late = shared_dir(spark, "stream-log-counts-5s-closed"), shared_dir(spark, "stream-log-counts-5s-late")
    query = streams.start_log_windows(spark, config, streams.Sink(path=out), streams.DRAIN, late=late)
    with streams.stopping(query):
        streams.wait(query, None)
    columns = ("window_start", "category", "n")
    found = spark.read.parquet(out).select(*columns).unionByName(spark.read.parquet(late).select(*columns))
    return _zone_free_windows(summaries.merged_logs(found.unionByName(closed.open_parts(spark, out).select(*columns))))


def stream_metrics_5s_small_batches(spark: SparkSession, folder: str) -> DataFrame:
    """All windows of files in no order of time, taken in the small batches of the usual limits."""
    config = _small_batches(spark, folder)
    out = shared_dir(spark, "stream-metrics-5s-parts")
    query = streams.start_metric_windows(spark, config, streams.Sink(path=out), streams.DRAIN)
    with streams.stopping(query):
        streams.wait(query, None)
    return _zone_free_windows(summaries.merged_metrics(spark.read.parquet(out)))


def retrieve_stored_logs(spark: SparkSession, folder: str) -> DataFrame:
    """The nearest logs by the vectors that the logs stream has stored; time and text name a log."""
    config = _file_run(spark, folder).for_backlog(BATCH_BYTES)
    found = _stored(spark, streams.logs_frame(spark, config), "stored-logs")
    return retrieve.nearest(
        found,
        _questions(spark, folder),
        NEIGHBOURS,
        id_cols=["timestamp", "log_raw"],
        vector="embedding_vector",
        strict=True,
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    query.__name__: query
    for query in (
        decode_payload,
        encode_payload,
        payload_audit,
        route_logs,
        route_metrics,
        clean_log_text,
        clean_log_prefix,
        shift_broker_time,
        embed_text,
        filter_log_lines,
        route_categories,
        assign_topic,
        deliver_messages,
        metrics_5s,
        log_counts_5s,
        ingest_lag,
        vector_topk,
        retrieve_logs,
        envelope_files,
        stream_logs,
        stream_metrics,
        stream_metrics_5s,
        stream_log_counts_5s,
        stream_metrics_5s_small_batches,
        stream_metrics_5s_merged,
        stream_log_counts_5s_late,
        retrieve_stored_logs,
    )
}
