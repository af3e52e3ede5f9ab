"""Hierarchical packing of documents into sequences of several context sizes.

Every task packs the rows of its own partition, so nothing is shuffled and a lost task is packed again as a whole.
Within a task, a window of documents is held at a time (`WINDOW_TOKENS`). Documents longer than the longest context
give full sequences; what remains of them and every other document goes to the tier with the smallest context
that holds it. Tiers are packed from long to short: a sequence is opened by the longest item of its tier, its gap
is filled by the longest fitting item of any shorter tier, and where nothing fits, the shortest item is cut. So
every sequence is exactly full and an item is cut only to close a gap. Items that no sequence could be filled
with wait for the next window; at the end of the partition they fill contexts that are powers of two, down to one.
Hence no sequence is padded. Sequences of one length form step groups of equal tokens, dealt in order of their
attention cost (the sum of squared piece lengths), forth and back, so that groups cost about the same.

Null texts count as empty: such a document consists of the end id alone. Repeated rows are packed as often as they
occur. An empty table gives no pieces.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from hostpulse.llm import bpe, common

#: Context sizes, each a power of two.
TIERS = (512, 1024, 2048, 4096)
#: Tokens that a task holds before it packs them.
WINDOW_TOKENS = 2 << 20
#: Tokens of a step group.
STEP_TOKENS = 8 * TIERS[-1]

SCHEMA = (
    "start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, "
    "context int, step_group long"
)
_NAMES = [part.split()[0] for part in SCHEMA.split(", ")]


def fill(lengths: list[int], last: bool, tiers: tuple[int, ...] = TIERS):
    """Packs items of these lengths into exactly full sequences.

    Returns (context, [(item, start, length), ...]) for each sequence and [(item, start, length), ...] for what waits.
    With `last`, nothing waits: the rest fills sequences of descending powers of two.
    """
    longest, sequences = tiers[-1], []
    pool: list[tuple[int, int, int]] = []  # (length, item, start), in order
    for item, length in enumerate(lengths):
        full = length // longest
        sequences += [(longest, [(item, k * longest, longest)]) for k in range(full)]
        if length % longest:
            pool.append((length % longest, item, full * longest))
    pool.sort()
    left = sum(entry[0] for entry in pool)

    def close(context: int) -> None:
        nonlocal left
        gap, pieces = context, []
        while gap:
            place = bisect_right(pool, (gap, len(lengths), 0))
            if place:
                length, item, start = pool.pop(place - 1)
            else:
                length, item, start = pool.pop(0)
                insort(pool, (length - gap, item, start + gap))
                length = gap
            pieces.append((item, start, length))
            gap -= length
        left -= context
        sequences.append((context, pieces))

    for shorter, context in reversed(list(zip((0, *tiers), tiers))):
        while pool and pool[-1][0] > shorter and left >= context:
            close(context)
    if last:
        for power in range(longest.bit_length() - 1, -1, -1):
            while left >= 1 << power:
                close(1 << power)
    return sequences, [(item, start, length) for length, item, start in pool]


class _Packer:
    """Packs the documents of one task; `base` keeps its sequence numbers apart from those of other tasks."""

    def __init__(self, base: int, tiers: tuple[int, ...], step_tokens: int):
        self.base, self.tiers, self.step = base, tiers, step_tokens
        self.items: list[tuple] = []  # (id, ids, start, tokens of the document)
        self.tokens = self.sequences = self.groups = 0

    def add(self, key, ids: np.ndarray) -> None:
        self.items.append((key, ids, 0, len(ids)))
        self.tokens += len(ids)

    def pack(self, last: bool) -> list[tuple]:
        sequences, rest = fill([len(item[1]) for item in self.items], last, self.tiers)
        rows, tiers = [], {}
        for context, pieces in sequences:
            number, offset, cost = self.base + self.sequences, 0, 0
            self.sequences += 1
            own = []
            for item, start, length in pieces:
                key, ids, before, total = self.items[item]
                crc = zlib.crc32(ids[start : start + length].tobytes())
                own.append((key, before + start, length, crc, total, number, offset, context))
                offset += length
                cost += length * length
            tiers.setdefault(context, []).append((cost, number, own))
        for context in sorted(tiers, reverse=True):
            ordered = sorted(tiers[context], key=lambda entry: (-entry[0], entry[1]))
            groups = -(-len(ordered) * context // self.step)
            for place, (_, _, own) in enumerate(ordered):
                turn, slot = divmod(place, groups)
                group = self.base + self.groups + (groups - 1 - slot if turn % 2 else slot)
                rows += [(*piece, group) for piece in own]
            self.groups += groups
        self.items = [
            (self.items[item][0], self.items[item][1][start : start + length].copy(), self.items[item][2] + start, self.items[item][3])
            for item, start, length in rest
        ]
        self.tokens = sum(len(item[1]) for item in self.items)
        return rows


def pack(
    docs: DataFrame,
    path: str,
    end_id: int,
    tiers: tuple[int, ...] = TIERS,
    id_col: str = "doc_id",
    text_col: str = "text",
    window_tokens: int = WINDOW_TOKENS,
    step_tokens: int = STEP_TOKENS,
) -> DataFrame:
    """One row per piece: where it lies in its document and in its sequence, the sequence's context and step group."""
    if any(size & (size - 1) for size in tiers) or list(tiers) != sorted(set(tiers)):
        raise ValueError("tiers must be ascending powers of two")
    sent = bpe._Sent(docs.sparkSession, bpe.Vocabulary(path))
    field = docs.schema[id_col]
    arrow = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}[field.dataType.simpleString()]
    types = [arrow, *(pa.int32() if name == "context" else pa.int64() for name in _NAMES)]
    end = np.array([end_id], "<u4").tobytes()

    def table(rows: list[tuple]) -> pa.RecordBatch:
        columns = zip(*rows) if rows else [[]] * len(types)
        return pa.RecordBatch.from_arrays(
            [pa.array(column, kind) for column, kind in zip(columns, types)], [id_col, *_NAMES]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = bpe.worker_encoder(sent)
        packer = _Packer(TaskContext.get().partitionId() << 33, tiers, step_tokens)
        for batch in batches:
            for part in common.slices(batch, text_col):
                encoded = encoder.encode(common.texts_of(part, text_col))
                for key, ids in zip(part.column(id_col).to_pylist(), encoded):
                    packer.add(key, np.frombuffer(ids + end, "<u4"))
                if packer.tokens >= window_tokens:
                    yield table(packer.pack(last=False))
        yield table(packer.pack(last=True))

    kind = field.dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, {SCHEMA}")
