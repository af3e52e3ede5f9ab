"""Envelopes and result tables as files."""

from pyspark.sql import DataFrame


def write_envelopes(envelopes: DataFrame, path: str, rows_per_file: int | None = None) -> None:
    """JSON lines that the file source can pick up. Each task writes its own files."""
    writer = envelopes.write.mode("append")
    if rows_per_file is not None:
        writer = writer.option("maxRecordsPerFile", rows_per_file)
    writer.option("ignoreNullFields", "false").json(path)
