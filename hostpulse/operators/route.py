"""Splitting decoded envelopes into logs and metrics. Row-wise work only: nothing here shuffles."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import embedding, payload
from ..functions.text import CLEANERS
from ..functions.times import payload_instant, to_wall_time
from ..schemas import ENRICHED_LOGS, LOG, METRICS


LOG_FIELDS = ("timestamp", "type", "category", "log_raw")
METRICS_FIELDS = ("timestamp", "type", "cpu_percent", "memory")


def decoded(envelopes: DataFrame, *fields: str) -> DataFrame:
    """Adds the payload struct with all or the given fields."""
    return envelopes.withColumn("payload", payload.decode(F.col("value"), *fields))


def decoded_once(envelopes: DataFrame, *fields: str) -> DataFrame:
    """The same for use under filters.

    The payload is generated rather than projected: every filter on a field of a projected payload
    moves below the projection and parses the text once more for itself. The optimizer does not see
    through that which fields are used, so they are named.
    """
    value = payload.decode(F.col("value"), *fields)
    return envelopes.withColumn("payload", F.explode(F.array(value)))


def of_type(
    envelopes: DataFrame, *kinds: str, fields: Sequence[str] = (), audit: str | None = None
) -> DataFrame:
    """Decoded rows of the given types, case-sensitive. Rows without a readable type belong to none.

    Most other rows are gone before the parse. With `audit`, all rows are parsed and counted.
    """
    if audit is None:
        envelopes = envelopes.where(payload.may_have_type(F.col("value"), *kinds))
        rows = decoded_once(envelopes, *fields)
    else:
        rows = counted(decoded_once(envelopes, *fields), audit)
    return rows.where(F.col("payload.type").isin(*kinds))


def counted(rows: DataFrame, name: str) -> DataFrame:
    """Counts messages by outcome as they pass: a malformed one leaves a trace though it is dropped.

    The counts are in `StreamingQueryProgress.observedMetrics[name]`, or in an `Observation`.
    """
    kind = F.col("payload.type")
    return rows.observe(
        name,
        F.count(F.lit(1)).alias("messages"),
        F.count_if(kind == LOG).alias("logs"),
        F.count_if(kind == METRICS).alias("metrics"),
        F.count_if(kind.isNull()).alias("unreadable"),
    )


def broker_column(zone: str | None) -> Column:
    time = F.col("broker_time")
    return time if zone is None else to_wall_time(time, zone)


def logs(
    envelopes: DataFrame, clean: str = "full", zone: str | None = None, audit: str | None = None
) -> DataFrame:
    """Log messages with cleaned text."""
    return of_type(envelopes, LOG, fields=LOG_FIELDS, audit=audit).select(
        broker_column(zone).alias("eventhub_timestamp"),
        "topic",
        F.col("payload.timestamp").alias("timestamp"),
        F.col("payload.category").alias("category"),
        CLEANERS[clean](F.col("payload.log_raw")).alias("log_raw"),
    )


def enriched(
    log_rows: DataFrame,
    open_encoder=embedding.HashingEncoder,
    chunk_size: int = embedding.CHUNK_SIZE,
    calls: embedding.Calls | None = None,
) -> DataFrame:
    """Logs with the vector of their cleaned text, in the column order of the table."""
    vector = embedding.embed(F.col("log_raw"), open_encoder, chunk_size, calls=calls)
    return log_rows.withColumn("embedding_vector", vector).select(*ENRICHED_LOGS)


def metrics(
    envelopes: DataFrame, zone: str | None = None, audit: str | None = None
) -> DataFrame:
    """Metrics messages with the memory figures as columns."""
    return of_type(envelopes, METRICS, fields=METRICS_FIELDS, audit=audit).select(
        broker_column(zone).alias("eventhub_timestamp"),
        "topic",
        F.col("payload.timestamp").alias("timestamp"),
        F.col("payload.cpu_percent").alias("cpu_percent"),
        F.col("payload.memory.total").alias("total_memory"),
        F.col("payload.memory.available").alias("available_memory"),
        F.col("payload.memory.percent").alias("percent_memory"),
    )


def log_samples(envelopes: DataFrame, *also: str) -> DataFrame:
    """Time and category of logs, for the summaries, and columns of the envelope."""
    return of_type(envelopes, LOG, fields=("timestamp", "type", "category")).select(
        payload_instant(F.col("payload.timestamp")).alias("at"),
        F.col("payload.category").alias("category"),
        *also,
    )


def metric_samples(envelopes: DataFrame, *also: str) -> DataFrame:
    """Time and figures of metrics, for the summaries, and columns of the envelope."""
    return of_type(envelopes, METRICS, fields=METRICS_FIELDS).select(
        payload_instant(F.col("payload.timestamp")).alias("at"),
        F.col("payload.cpu_percent").alias("cpu_percent"),
        F.col("payload.memory.available").alias("available_memory"),
        F.col("payload.memory.percent").alias("percent_memory"),
        *also,
    )


def arrivals(envelopes: DataFrame) -> DataFrame:
    """Type, sample time and unshifted broker time of all messages, in one pass."""
    return of_type(envelopes, LOG, METRICS, fields=("timestamp", "type")).select(
        F.col("payload.type").alias("type"),
        F.col("payload.timestamp").alias("timestamp"),
        "broker_time",
    )
