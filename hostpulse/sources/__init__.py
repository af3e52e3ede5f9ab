"""Readers. Whatever the source, they give one normalised envelope:

value STRING, topic STRING, partition INT, offset BIGINT, broker_time TIMESTAMP.
"""

from pyspark.sql import DataFrame, SparkSession

from ..config import Config, StreamName
from .files import read_files, stream_files
from .kafka import stream_kafka

__all__ = ["read_files", "stream_envelopes", "stream_files", "stream_kafka"]


def stream_envelopes(spark: SparkSession, config: Config, stream: StreamName) -> DataFrame:
    """The streaming envelopes of the configured source. What follows does not depend on it."""
    if config.mode == "files":
        limits = config.limits(stream)
        return stream_files(spark, config.base_path, limits.max_files, limits.max_bytes, config.file_options)
    return stream_kafka(spark, config, stream)
