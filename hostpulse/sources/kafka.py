"""Envelopes from Kafka. Needs the spark-sql-kafka-0-10 package on the session."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import Config, Secret, StreamName, event_hubs_servers

LOGIN_MODULE = "org.apache.kafka.common.security.plain.PlainLoginModule"


def connection_options(namespace: str | None, connection: Secret | None) -> dict[str, str]:
    """Broker address and, with a secret, SASL PLAIN over TLS. Shared by source and sink."""
    options = {"kafka.bootstrap.servers": event_hubs_servers(namespace)}
    if connection is not None:
        # A quote or backslash would end the quoted value early.
        password = connection.reveal().replace("\\", "\\\\").replace('"', '\\"')
        options |= {
            "kafka.security.protocol": "SASL_SSL",
            "kafka.sasl.mechanism": "PLAIN",
            "kafka.sasl.jaas.config": (
                f'{LOGIN_MODULE} required username="$ConnectionString" password="{password}";'
            ),
        }
    return options


def read_options(config: Config, stream: StreamName) -> dict[str, str]:
    limits = config.limits(stream)
    options = connection_options(config.namespace, config.connection) | {
        "subscribe": config.topics,
        "startingOffsets": limits.starting_offsets,
        "failOnDataLoss": str(config.fail_on_data_loss).lower(),
    }
    optional = {
        "maxOffsetsPerTrigger": limits.max_offsets,
        "minPartitions": limits.min_partitions,
        "maxRecordsPerPartition": limits.max_records_per_partition,
        "kafka.request.timeout.ms": limits.request_timeout_ms,
        "kafka.session.timeout.ms": limits.session_timeout_ms,
    }
    return options | {key: str(value) for key, value in optional.items() if value is not None}


def normalise_kafka(rows: DataFrame) -> DataFrame:
    return rows.select(
        F.col("value").cast("string").alias("value"),
        "topic",
        "partition",
        "offset",
        F.col("timestamp").alias("broker_time"),
    )


def stream_kafka(spark: SparkSession, config: Config, stream: StreamName) -> DataFrame:
    options = read_options(config, stream)
    return normalise_kafka(spark.readStream.format("kafka").options(**options).load())
