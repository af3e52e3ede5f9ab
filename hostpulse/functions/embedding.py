"""Text embedding as an Arrow UDF around a pluggable encoder.

An encoder takes a list of texts and gives one vector per text. `open_encoder` runs once per task, so
that a client is opened there and not for every row or batch.
"""

import hashlib
import time
from collections.abc import Callable, Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import SparkContext
from pyspark.accumulators import AccumulatorParam
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

Encoder = Callable[[list[str]], Sequence[Sequence[float]]]

CHUNK_SIZE = 100  # texts per encoder call; the model service takes at most 150


class HashingEncoder:
    """Word counts hashed into signed buckets and scaled to length one.

    The default, because it needs no service and gives the same vector everywhere. It compares
    words, not meaning.
    """

    def __init__(self, dims: int = 64, cached_words: int = 1 << 16):
        self.dims = dims
        self._slot = lru_cache(cached_words)(self._hash)

    def _hash(self, word: bytes) -> int:
        digest = hashlib.md5(word, usedforsecurity=False).digest()
        bucket = int.from_bytes(digest[:4], "big") % self.dims
        return bucket if digest[4] % 2 == 0 else bucket + self.dims

    def __call__(self, texts: list[str]) -> np.ndarray:
        words = [text.encode().split() for text in texts]
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        slots = np.fromiter((self._slot(word) for text in words for word in text), np.int64, sizes.sum())
        cells = np.repeat(np.arange(len(words)), sizes) * 2 * self.dims + slots
        counts = np.bincount(cells, minlength=2 * self.dims * len(words)).reshape(-1, 2, self.dims)
        vectors = (counts[:, 0] - counts[:, 1]).astype(np.float64)
        norms = np.linalg.norm(vectors, axis=1, keepdims=True)
        return np.divide(vectors, norms, out=vectors, where=norms > 0)


class PredictEncoder:
    """A model endpoint behind a client with `predict(endpoint=..., inputs=...)`."""

    def __init__(self, client, endpoint: str):
        self._client = client
        self._endpoint = endpoint

    def __call__(self, texts: list[str]) -> np.ndarray:
        answer = self._client.predict(endpoint=self._endpoint, inputs={"input": texts})
        vectors = [np.asarray(entry["embedding"], dtype=np.float64) for entry in answer["data"]]
        if not vectors:
            return np.zeros((0, 0))
        widths = {vector.shape for vector in vectors}
        if len(widths) > 1:
            raise ValueError(f"the model gave vectors of different lengths: {sorted(widths)}")
        return np.stack(vectors)


class Calls:
    """What encoder calls of all tasks add up to. The longest call is found among those of finished tasks."""

    def __init__(self, context: SparkContext):
        self._calls = context.accumulator(0)
        self._texts = context.accumulator(0)
        self._seconds = context.accumulator(0.0)
        self._longest = context.accumulator(0.0, _Largest())

    def add(self, texts: int, seconds: float) -> None:
        self._calls.add(1)
        self._texts.add(texts)
        self._seconds.add(seconds)
        self._longest.add(seconds)

    def figures(self) -> tuple[int, int, float]:
        """Calls, texts and seconds so far."""
        return self._calls.value, self._texts.value, self._seconds.value

    @property
    def longest(self) -> float:
        return self._longest.value


class _Largest(AccumulatorParam):
    def zero(self, value: float) -> float:
        return 0.0

    def addInPlace(self, a: float, b: float) -> float:
        return max(a, b)


def encode_chunk(encode: Encoder, texts: list[str], attempts: int, wait_seconds: float, calls: Calls | None = None):
    """One encoder call with a bounded number of retries. A wrong number of vectors is an error."""
    for attempt in range(1, attempts + 1):
        begun = time.perf_counter()
        try:
            vectors = encode(texts)
            if calls is not None:
                calls.add(len(texts), time.perf_counter() - begun)
            break
        except Exception:
            if attempt == attempts:
                raise
            time.sleep(wait_seconds * 2 ** (attempt - 1))
    if len(vectors) != len(texts):
        raise ValueError(f"the encoder gave {len(vectors)} vectors for {len(texts)} texts")
    return vectors


def to_arrow(vectors) -> pa.Array:
    """Vectors as a list array; a matrix goes over without a Python object per number."""
    kind = pa.list_(pa.float64())
    if isinstance(vectors, np.ndarray) and vectors.ndim == 2:
        rows, dims = vectors.shape
        offsets = pa.array(np.arange(rows + 1, dtype=np.int32) * dims)
        flat = pa.array(np.ascontiguousarray(vectors, dtype=np.float64).reshape(-1))
        return pa.ListArray.from_arrays(offsets, flat).cast(kind)
    return pa.array([[float(x) for x in vector] for vector in vectors], type=kind)


def embed_batches(
    batches: Iterator[pa.Array],
    open_encoder: Callable[[], Encoder],
    chunk_size: int = CHUNK_SIZE,
    attempts: int = 3,
    wait_seconds: float = 0.5,
    calls: Calls | None = None,
) -> Iterator[pa.Array]:
    """One array of vectors per array of texts, in the same order. Null is embedded as empty text."""
    encode = open_encoder()
    for batch in batches:
        texts = ["" if text is None else text for text in batch.to_pylist()]
        chunks = [
            to_arrow(encode_chunk(encode, texts[i : i + chunk_size], attempts, wait_seconds, calls))
            for i in range(0, len(texts), chunk_size)
        ]
        yield pa.concat_arrays(chunks) if chunks else pa.array([], pa.list_(pa.float64()))


def embed(
    text: Column,
    open_encoder: Callable[[], Encoder] = HashingEncoder,
    chunk_size: int = CHUNK_SIZE,
    attempts: int = 3,
    calls: Calls | None = None,
) -> Column:
    """Vectors of a text column. `calls` is told the size and the time of each encoder call."""

    @F.arrow_udf(T.ArrayType(T.DoubleType()))
    def embedding(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        yield from embed_batches(batches, open_encoder, chunk_size, attempts, calls=calls)

    return embedding(text)
