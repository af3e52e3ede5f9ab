"""Schemas of the messages and of the two tables they end up in. Every field may be null."""

from pyspark.sql import types as T

# Field names and types of the message format.
ENVELOPE = T.StructType(
    [
        T.StructField("value", T.StringType()),
        T.StructField("key", T.StringType()),
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.StringType()),
        T.StructField("timestamp", T.StringType()),
    ]
)

PAYLOAD = T.StructType(
    [
        T.StructField("timestamp", T.DoubleType()),
        T.StructField("type", T.StringType()),
        T.StructField("cpu_percent", T.DoubleType()),
        T.StructField(
            "memory",
            T.StructType(
                [
                    T.StructField("total", T.LongType()),
                    T.StructField("available", T.LongType()),
                    T.StructField("percent", T.DoubleType()),
                ]
            ),
        ),
        T.StructField(
            "disk_io",
            T.StructType(
                [
                    T.StructField("read_bytes", T.LongType()),
                    T.StructField("write_bytes", T.LongType()),
                ]
            ),
        ),
        T.StructField("category", T.StringType()),
        T.StructField("log_raw", T.StringType()),
    ]
)

LOG = "log"
METRICS = "metrics"

ENRICHED_LOGS = [
    "eventhub_timestamp",
    "topic",
    "timestamp",
    "category",
    "log_raw",
    "embedding_vector",
]
PARSED_METRICS = [
    "eventhub_timestamp",
    "topic",
    "timestamp",
    "cpu_percent",
    "total_memory",
    "available_memory",
    "percent_memory",
]
