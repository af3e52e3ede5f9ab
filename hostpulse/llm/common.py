"""Helpers that the operators share: row keys, bounded slices of Arrow batches, written intermediate tables."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hostpulse.session import remove_dir, shared_dir

#: Text that a task handles at a time, so that working arrays stay bounded whatever the size of an Arrow batch.
SLICE_BYTES = 4 << 20
SLICE_ROWS = 4096


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


#: Lets Spark drop the shuffle files of a query when it has ended; what `stored` writes is read from its files alone.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored(rows: DataFrame, label: str) -> DataFrame:
    """The rows, written to the shared folder and read back: computed once, and safe when an executor is lost."""
    spark = rows.sparkSession
    path = shared_dir(spark, label)
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        rows.write.parquet(path)
    finally:
        spark.conf.unset(_CLEANUP) if before is None else spark.conf.set(_CLEANUP, before)
    found = spark.read.schema(rows.schema).parquet(path)
    found._stored_at = path
    return found


def release(*tables: DataFrame) -> None:
    """Drops the files of tables made by `stored` that nothing reads any more."""
    for rows in tables:
        remove_dir(rows.sparkSession, rows._stored_at)


def row_key(id_col: str, text_col: str) -> list[Column]:
    """Two columns, never null, that tell rows apart: rows that share both are the same document repeated."""
    number = F.col(id_col).cast("long")
    return [
        F.coalesce(number, F.lit(0)).alias("k1"),
        F.xxhash64(F.coalesce(F.col(text_col), F.lit("")), number.isNull()).alias("k2"),
    ]


def remainder(id_col: str, divisor: int) -> Column:
    """crc32 of the id as text, modulo `divisor`; a null id counts as an empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % divisor


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Consecutive rows of about `limit` bytes of text, at most `SLICE_ROWS`; a longer text stands alone."""
    sizes = pc.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False)
    start, total = 0, 0
    for row, size in enumerate(sizes.tolist()):
        if row > start and (total + size > limit or row - start == SLICE_ROWS):
            yield batch.slice(start, row - start)
            start, total = row, 0
        total += size
    if batch.num_rows > start:
        yield batch.slice(start)


def texts_of(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    return [text or "" for text in batch.column(column).to_pylist()]


def bytes_of(batch: pa.RecordBatch, column: str = "text") -> list[bytes]:
    """The texts in UTF-8, null as empty."""
    values = batch.column(column)
    return [text or b"" for text in values.cast(pa.large_binary()).to_pylist()]


class WordHashes(dict):
    """64-bit hashes of words, remembered as long as there are at most `limit` of them."""

    def __init__(self, limit: int):
        self.limit = limit

    def __missing__(self, word: bytes) -> int:
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        if len(self) > self.limit:
            self.clear()
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def differing(x: Column, y: Column) -> Column:
    """Sum of the differences of two arrays of counts."""
    return F.aggregate(F.zip_with(x, y, lambda a, b: F.abs(a - b)), F.lit(0), lambda total, v: total + v)


def mixed(values: np.ndarray) -> np.ndarray:
    """A bijection on 64-bit integers that spreads every input bit."""
    values = values.astype(np.uint64)
    values ^= values >> np.uint64(30)
    values *= np.uint64(0xBF58476D1CE4E5B9)
    values ^= values >> np.uint64(27)
    values *= np.uint64(0x94D049BB133111EB)
    values ^= values >> np.uint64(31)
    return values
