"""The embedding function with encoders that show how it calls them."""

import math

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from hostpulse.functions.embedding import HashingEncoder, PredictEncoder, embed, embed_batches


class Recorder:
    """Gives each text a vector of its own, of varying length, and notes the calls."""

    def __init__(self):
        self.opened = 0
        self.calls = []

    def open(self):
        self.opened += 1
        return self

    def __call__(self, texts):
        self.calls.append(list(texts))
        return [[float(len(text)), *map(float, map(ord, text[:2]))] for text in texts]


@pytest.mark.parametrize("rows", [0, 1, 99, 100, 101, 250])
def test_chunks_and_order(rows):
    recorder = Recorder()
    texts = [f"{i}" * (i % 7) for i in range(rows)]
    (got,) = embed_batches(iter([pa.array(texts, pa.string())]), recorder.open)
    assert [len(call) for call in recorder.calls] == [100] * (rows // 100) + [rows % 100] * bool(
        rows % 100
    )
    assert got.to_pylist() == Recorder()(texts)


def test_one_client_for_all_batches():
    recorder = Recorder()
    list(embed_batches(iter([pa.array(["a"]), pa.array(["b"]), pa.array(["c"])]), recorder.open))
    assert recorder.opened == 1 and len(recorder.calls) == 3


def test_null_is_embedded_as_empty_text():
    recorder = Recorder()
    list(embed_batches(iter([pa.array([None, "a"], pa.string())]), recorder.open))
    assert recorder.calls == [["", "a"]]


def test_too_few_vectors_fail():
    with pytest.raises(ValueError, match="1 vectors for 2 texts"):
        list(embed_batches(iter([pa.array(["a", "b"])]), lambda: lambda texts: [[1.0]]))


def test_bounded_retry():
    calls = []

    def flaky(texts):
        calls.append(texts)
        if len(calls) < 3:
            raise ConnectionError("busy")
        return [[1.0]] * len(texts)

    (got,) = embed_batches(iter([pa.array(["a"])]), lambda: flaky, attempts=3, wait_seconds=0)
    assert got.to_pylist() == [[1.0]] and len(calls) == 3

    def broken(texts):
        calls.append(texts)
        raise ConnectionError("down")

    calls.clear()
    with pytest.raises(ConnectionError):
        list(embed_batches(iter([pa.array(["a"])]), lambda: broken, attempts=2, wait_seconds=0))
    assert len(calls) == 2


def test_endpoint_client():
    class Client:
        def predict(self, endpoint, inputs):
            assert endpoint == "model"
            return {"data": [{"embedding": [len(text), 1]} for text in inputs["input"]]}

    assert PredictEncoder(Client(), "model")(["ab", ""]).tolist() == [[2.0, 1.0], [0.0, 1.0]]


def test_hashing_encoder():
    same, other, empty, twice = HashingEncoder()(["disk full", "wifi up", "", "disk full disk full"])
    assert math.isclose(np.linalg.norm(same), 1)
    assert not empty.any()
    assert np.allclose(same, twice)
    assert not np.allclose(same, other)
    assert (HashingEncoder(cached_words=1)(["disk full"])[0] == same).all()


def test_column_on_spark(spark):
    rows = spark.createDataFrame([(i, f"word{i}") for i in range(250)] + [(250, None)], "id int, t string")
    got = rows.repartition(3).select("id", embed(F.col("t")).alias("v")).collect()
    assert len(got) == 251
    expected = HashingEncoder()([f"word{i}" for i in range(250)] + [""])
    for row in got:
        assert row["v"] == expected[row["id"]].tolist()
