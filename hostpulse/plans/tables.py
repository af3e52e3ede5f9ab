"""Messages and host records derived from the shared test tables, every row of them."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.payload import log_payload, metrics_payload
from ..operators.collect import envelope
from ..schemas import LOG, METRICS
from ..sources.files import normalise_files

MEMORY_TOTAL = 24000000000


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def zoneless(time: Column) -> Column:
    return time.cast("timestamp_ntz")


def messages(events: DataFrame) -> DataFrame:
    """One payload per event, its fields still as columns: errors are logs, the rest are metrics."""
    events = events.withColumn("k", F.get_json_object("props", "$.k").cast("bigint")).withColumn(
        "taken", F.unix_micros(F.col("ts").cast("timestamp"))
    )
    number, taken = F.col("k"), F.col("taken")
    is_log = F.col("event_type") == "error"
    user = F.col("user_id")
    line = F.concat(
        F.lit('"eventMessage" : "user '), user.cast("string"), F.lit(", props "), "props", F.lit('",')
    )
    return events.select(
        "event_id",
        F.when(is_log, F.lit(LOG)).otherwise(F.lit(METRICS)).alias("type"),
        (taken / F.lit(1e6)).alias("timestamp"),
        F.timestamp_micros(taken + F.col("event_id") % 997 * 1000).alias("broker_time"),
        F.when(~is_log, F.col("value")).alias("cpu_percent"),
        F.when(~is_log, F.lit(MEMORY_TOTAL)).alias("total_memory"),
        F.when(~is_log, user * 1000000).alias("available_memory"),
        F.when(~is_log, number.cast("double")).alias("percent_memory"),
        F.when(~is_log, number * 1000).alias("read_bytes"),
        F.when(~is_log, number * 2000).alias("write_bytes"),
        F.when(
            is_log,
            F.when(user % 3 == 0, F.lit("kernel"))
            .when(user % 3 == 1, F.lit("system"))
            .otherwise(F.lit("wifi")),
        ).alias("category"),
        F.when(is_log, line).alias("log_raw"),
    )


def file_envelopes(events: DataFrame) -> DataFrame:
    """The events as JSON envelopes, in the form of the JSON-lines files."""
    payload = F.when(
        F.col("type") == LOG,
        log_payload(F.col("timestamp"), F.col("category"), F.col("log_raw")),
    ).otherwise(
        metrics_payload(
            F.col("timestamp"),
            F.col("cpu_percent"),
            F.col("total_memory"),
            F.col("available_memory"),
            F.col("percent_memory"),
            F.col("read_bytes"),
            F.col("write_bytes"),
        )
    )
    columns = envelope(
        payload, F.lit("system_data"), F.col("event_id") % 4, F.col("event_id"), F.col("broker_time")
    )
    # Generated rather than projected: a filter on the payload would move below a projection and
    # build the same JSON once more for itself.
    return messages(events).select(F.inline(F.array(F.struct(*columns))))


def envelopes(events: DataFrame) -> DataFrame:
    """The events as the envelopes that every source gives."""
    return normalise_files(file_envelopes(events))


def host_records(events: DataFrame) -> DataFrame:
    """The events as structured host log records; some match no category, some match two."""
    source = F.col("user_id") % 5
    subsystem = (
        F.when(source == 0, F.lit("com.apple.system"))
        .when(source == 1, F.lit("com.apple.power"))
        .when(source == 2, F.lit("com.apple.wifi"))
        .when(source == 3, F.lit("com.apple.bluetooth"))
        .otherwise(F.lit("com.example.other"))
    )
    message = F.when(
        F.col("event_type").isin("error", "click"), F.concat(F.lit("kernel "), "props")
    ).otherwise(F.concat("event_type", F.lit(" "), "props"))
    return events.select(
        "event_id", subsystem.alias("subsystem"), message.alias("event_message")
    )


def host_lines(documents: DataFrame) -> DataFrame:
    """Each line of each document as the host log would print it, with blanks around it.

    By line number: a quoted message key, the key without quotes, no key, a quoted category key.
    """
    lines = documents.select(
        "doc_id", F.posexplode(F.split("text", "\n", -1)).alias("line_no", "text")
    )
    shape = F.col("line_no") % 4
    line = (
        F.when(shape == 0, F.concat(F.lit('\t"eventMessage" : "'), "text", F.lit('",  ')))
        .when(shape == 1, F.concat(F.lit("eventMessage : "), "text"))
        .when(shape == 2, F.concat(F.lit("  "), "text"))
        .otherwise(F.concat(F.lit('  "category" : "'), "text", F.lit('"\t ')))
    )
    return lines.select("doc_id", "line_no", line.alias("line"))
