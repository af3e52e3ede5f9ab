"""Toxicity: a linear classifier of character n-grams whose features are scaled by naive Bayes log-count ratios.

The n-grams are those of the lower-cased words with a blank at either end, hashed into `SLOTS`; the value of a
feature is the number of distinct words of the text that have it. Each feature is scaled by the log ratio of its
smoothed counts in toxic and other documents, and logistic regression is fitted on the scaled values. As the
result is linear in the words, a worker computes the weight of a word once and a text is a sum over its words.

The fit uses at most `TRAINING_PER_CLASS` labelled documents of each class, those with the smallest hash of the id,
weighted back to the true share of the classes, and only the texts' features reach the driver. Scores depend on the text alone. Null and
empty texts get the score of the intercept. Repeated rows give repeated results; other columns are ignored. Without
labelled documents of both classes, all scores are 0.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hostpulse.llm import common

SLOTS = 1 << 18
SIZES = (3, 4, 5)
TRAINING_PER_CLASS = 1500
THRESHOLD = 0.7
#: Words whose weights a worker remembers; beyond it, it forgets all and goes on.
CACHED_WORDS = 300_000
#: Features with a log-count ratio nearer to zero than this tell the classes apart no better than chance and are left out.
LEAST_RATIO = 0.3


def slots(word: bytes) -> list[int]:
    """The hashed n-grams of a word, between blanks."""
    padded = b" " + word + b" "
    return [
        zlib.crc32(padded[start : start + size]) % SLOTS
        for size in SIZES
        for start in range(max(1, len(padded) - size + 1))
    ]


def features(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The features of a text and their values."""
    found = [slot for word in set(text.lower().split()) for slot in slots(word)]
    return np.unique(np.array(found, np.int64), return_counts=True)


class Model:
    def __init__(self, weights: np.ndarray, intercept: float):
        self.weights, self.intercept = weights, intercept
        self.known: dict[bytes, float] = {}

    def __getstate__(self):
        return {"weights": self.weights, "intercept": self.intercept, "known": {}}

    def _word(self, word: bytes) -> float:
        weight = self.known.get(word)
        if weight is None:
            weight = self.known[word] = float(self.weights[slots(word)].sum())
        return weight

    def score(self, text: bytes) -> float:
        """Between 0 and 1; higher means that toxic is likelier."""
        if len(self.known) > CACHED_WORDS:
            self.known.clear()
        total = self.intercept + sum(map(self._word, sorted(set(text.lower().split()))))
        return float(1 / (1 + np.exp(-np.clip(total, -500, 500))))


def fit(rows: list[tuple[np.ndarray, np.ndarray]], marks: np.ndarray, weight: np.ndarray, rounds: int = 200) -> Model:
    """Logistic regression on scaled features, by Adam. `weight`: of each document."""
    docs = np.repeat(np.arange(len(rows)), [len(r[0]) for r in rows])
    index = np.concatenate([r[0] for r in rows])
    values = np.concatenate([r[1] for r in rows]).astype(float)
    toxic = marks[docs] == 1
    ones = np.bincount(index[toxic], minlength=SLOTS) + 1.0
    zeros = np.bincount(index[~toxic], minlength=SLOTS) + 1.0
    ratio = np.log(ones / (marks.sum() + 2)) - np.log(zeros / ((1 - marks).sum() + 2))
    ratio[ones + zeros < 2 + 3] = 0
    ratio[np.abs(ratio) < LEAST_RATIO] = 0
    used = np.flatnonzero(ratio)
    column = np.full(SLOTS, -1)
    column[used] = np.arange(len(used))
    inside = column[index] >= 0
    docs, index, values = docs[inside], column[index[inside]], values[inside]
    values = values * ratio[used][index]
    u, bias = np.zeros(len(used)), 0.0
    first, second = np.zeros(len(used) + 1), np.zeros(len(used) + 1)
    weight = weight / weight.sum()
    for turn in range(1, rounds + 1):
        total = np.bincount(docs, values * u[index], len(rows)) + bias
        error = weight * (marks - 1 / (1 + np.exp(-np.clip(total, -500, 500))))
        slope = np.r_[np.bincount(index, values * error[docs], len(used)) - 1e-5 * u, error.sum()]
        first = 0.9 * first + 0.1 * slope
        second = 0.99 * second + 0.01 * slope**2
        step = 0.05 * (first / (1 - 0.9**turn)) / (np.sqrt(second / (1 - 0.99**turn)) + 1e-9)
        u, bias = u + step[:-1], bias + float(step[-1])
    weights = np.zeros(SLOTS)
    weights[used] = u * ratio[used]
    return Model(weights, bias)


def train(
    docs: DataFrame,
    labels: DataFrame,
    may_learn: Column | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    limit: int = TRAINING_PER_CLASS,
) -> Model:
    """A model fitted on labelled rows where `may_learn` holds, at most `limit` of each class."""
    usable = labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull())
    if may_learn is not None:
        usable = usable.where(may_learn)
    usable = usable.groupBy(id_col).agg(F.max(label_col).cast("int").alias("mark"))
    chosen = [usable.where(F.col("mark") == m).orderBy(F.xxhash64(id_col), id_col).limit(limit) for m in (0, 1)]
    totals = {row.mark: row["count"] for row in usable.groupBy("mark").count().collect()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [features(text) for text in common.bytes_of(batch, text_col)]
            columns = [
                batch.column("mark"),
                pa.array([r[0].astype("<u4").tobytes() for r in rows], pa.binary()),
                pa.array([r[1].astype("<u4").tobytes() for r in rows], pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["mark", "slots", "counts"])

    # At most twice `limit` ids: a bounded broadcast.
    found = (
        docs.select(id_col, text_col)
        .join(F.broadcast(chosen[0].union(chosen[1])), id_col)
        .orderBy(F.xxhash64(id_col), id_col)
        .select("mark", text_col)
        .mapInArrow(run, "mark int, slots binary, counts binary")
        .collect()
    )
    marks = np.array([row.mark for row in found], float)
    if len(set(marks.tolist())) < 2:
        return Model(np.zeros(SLOTS), -500.0)
    weight = np.where(marks == 1, totals[1] / marks.sum(), totals[0] / (1 - marks).sum())
    rows = [(np.frombuffer(r.slots, "<u4").astype(np.int64), np.frombuffer(r.counts, "<u4")) for r in found]
    return fit(rows, marks, weight)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The id, `score` and `predicted` of each row."""
    from hostpulse.llm.bpe import _Sent

    sent = _Sent(docs.sparkSession, model)
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        for batch in batches:
            scores = np.array([model.score(text) for text in common.bytes_of(batch, text_col)], float)
            predicted = (scores >= THRESHOLD).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column(id_col), pa.array(scores), pa.array(predicted)], [id_col, "score", "predicted"]
            )

    return docs.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, score double, predicted int")
