"""How long the batches of a stream take, part by part, and what its encoder calls cost.

Figures come from the progress that Spark reports for each batch and from accumulators that the encoder's tasks add to. The last
`kept` batches of each query are remembered.
"""

from __future__ import annotations

import threading
from collections import defaultdict, deque

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQueryListener

from ..functions.embedding import Calls

SCHEMA = "query string, part string, batches bigint, rows bigint, p50_ms double, p99_ms double, longest_ms double"
CALLS_SCHEMA = "query string, batch bigint, calls bigint, texts bigint, seconds double"


def percentile(ordered: list[float], share: float) -> float:
    """The value at rank ceil(share * n) of values in order."""
    return ordered[max(1, -int(-share * len(ordered) // 1)) - 1]


class Latencies(StreamingQueryListener):
    """Times of batches that had rows. Add it with `spark.streams.addListener` before a query starts, under a name.

    `calls` are the figures that a query's encoder adds to, by the name of the query.
    """

    def __init__(self, calls: dict[str, Calls] | None = None, kept: int = 10_000):
        super().__init__()
        self._lock = threading.Lock()
        self._times = defaultdict(lambda: deque(maxlen=kept))
        self._calls = calls or {}
        self._seen = {name: (0, 0, 0.0) for name in self._calls}
        self._by_batch = deque(maxlen=kept)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        self.add(event.progress.name or str(event.progress.id), event.progress.batchId, event.progress.numInputRows, event.progress.durationMs)

    def add(self, name: str, batch: int, rows: int, times: dict[str, int]) -> None:
        if not rows:
            return
        with self._lock:
            self._times[name].append((rows, dict(times)))
            if name in self._calls:
                now = self._calls[name].figures()
                self._by_batch.append((name, batch, *(b - a for a, b in zip(self._seen[name], now))))
                self._seen[name] = now

    def summary(self) -> list[tuple]:
        """For each query and part (`triggerExecution` is the whole batch): batches, rows, median, 99th percentile and longest time."""
        out = []
        with self._lock:
            for name, batches in sorted(self._times.items()):
                for part in sorted({part for _, times in batches for part in times}):
                    found = sorted((float(times[part]), rows) for rows, times in batches if part in times)
                    values = [value for value, _ in found]
                    out.append((name, part, len(found), sum(rows for _, rows in found), percentile(values, 0.5), percentile(values, 0.99), values[-1]))
        return out

    def frame(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.summary(), SCHEMA)

    def call_figures(self, spark: SparkSession) -> DataFrame:
        """Encoder calls, texts and seconds of each batch; attempts that were repeated count as often as they called."""
        with self._lock:
            return spark.createDataFrame(list(self._by_batch), CALLS_SCHEMA)
