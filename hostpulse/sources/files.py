"""Envelopes as JSON-lines files."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.times import broker_time
from ..schemas import ENVELOPE


def normalise_files(rows: DataFrame) -> DataFrame:
    return rows.select(
        "value",
        "topic",
        "partition",
        F.col("offset").try_cast("bigint").alias("offset"),
        broker_time(F.col("timestamp")).alias("broker_time"),
    )


def stream_files(
    spark: SparkSession,
    path: str,
    max_files: int | None = 10,
    max_bytes: int | None = None,
    options: dict[str, str] | None = None,
) -> DataFrame:
    """New files of a folder. The given schema spares an inference pass; `_*` paths are not read."""
    reader = spark.readStream.schema(ENVELOPE).options(**(options or {}))
    if max_bytes is not None:
        reader = reader.option("maxBytesPerTrigger", max_bytes)
    elif max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return normalise_files(reader.json(path))


def read_files(spark: SparkSession, path: str) -> DataFrame:
    """The same folder as a static table."""
    return normalise_files(spark.read.schema(ENVELOPE).json(path))
