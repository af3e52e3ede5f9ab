"""From raw documents to packed training sequences, in five stages.

Every stage is written as Parquet to the shared folder and read again by the next one. All but the last return the
columns of `documents`; where a stage changes a text, `n_chars` follows it. A document that loses its last word to a
stage goes with it; one that came without words is the first stage's to reject.
"""

from __future__ import annotations

import sys
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The driver may load this file by its path alone.
if str(Path(__file__).resolve().parent) not in sys.path:
    sys.path.insert(0, str(Path(__file__).resolve().parent))

from hostpulse.llm import near_lines, packing, passages, quality, shingles  # noqa: E402
from hostpulse.llm.common import stored  # noqa: E402
from hostpulse.llm.queries import END_ID, labels, vocabulary  # noqa: E402


def _changed(rows: DataFrame, lost: str, columns: list[str]) -> DataFrame:
    """Sets `n_chars` anew and leaves out what has lost (`lost` > 0) all its words."""
    if "n_chars" in columns:
        rows = rows.withColumn("n_chars", F.length("text").cast(rows.schema["n_chars"].dataType))
    return rows.where((F.col(lost) == 0) | F.col("text").rlike(r"[^ \t\n\x0b\f\r]")).select(*columns)


def _others(docs: DataFrame):
    """The columns besides the text as one, so that they clash with none that an operator adds."""
    return F.struct(*(F.col(name) for name in docs.columns if name != "text")).alias("others")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that fail the base rules or consist mostly of boilerplate lines."""
    field = quality.train(docs, labels(spark, sf_dir))
    marked = quality.assess(docs.select("doc_id", "text", _others(docs)), field, keep=("others", "text"))
    kept = marked.where("kept")
    return kept.select(*("text" if name == "text" else f"others.`{name}`" for name in docs.columns))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops lines that nearly repeat an earlier line of any document."""
    rows = near_lines.dedup(docs.select("doc_id", "text", _others(docs)), short=True)
    rows = rows.select(*("text" if name == "text" else f"others.`{name}`" for name in docs.columns), "n_removed")
    return _changed(rows, "n_removed", docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group whose five-word shingles have a Jaccard similarity of at least 0.8."""
    return shingles.dedup(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts out strings of 50 words that occur anywhere else, so that no passage of more words is left in two documents."""
    rows = passages.remove(docs.select("doc_id", "text", _others(docs)), keep=("others",), with_text=True, words=True)
    texts = F.col("kept_text").alias("text")
    rows = rows.select(*(texts if name == "text" else f"others.`{name}`" for name in docs.columns), "n_removed")
    return _changed(rows, "n_removed", docs.columns)


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs the tokens of all documents into full sequences of several context sizes."""
    return packing.pack(docs, vocabulary(), END_ID)


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("near duplicates", near_duplicates),
    ("repeated passages", repeated_passages),
    ("packing", packed_sequences),
]

#: SQL can express none of the learned, iterative and tokenizing stages; tests compare them with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed pieces of the documents in `sf_dir`."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
