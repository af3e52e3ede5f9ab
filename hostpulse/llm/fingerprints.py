"""SimHash fingerprints and the search for near ones by permuted block tables.

The terms of a text are its runs of three words (all words as one run if there are fewer), each counted as often as
it occurs. A term's hash votes with its sign in each of the `BITS` places; the fingerprint holds the majority, 0
where votes are even. Texts without a word have the fingerprint of no votes, all zeros.

Permuted block tables find all fingerprints within a Hamming radius: `classes` gives every document its class of documents
that are connected by near fingerprints, `near` all pairs of a small set. `beside` pairs each document with the one that follows it in
the order of ids, without a window over the whole table: ids are dealt into ranges, one to a task, and the first
document of each range is sent to the range before it as well. Null texts count as empty; null ids come first; repeated
rows follow each other. Other columns are ignored, and an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hostpulse.llm import common, links

BITS = 128
RUN = 3
#: Likeness from which on two fingerprints are near, and the number of differing bits that stands for it.
LIKENESS = 0.985
RADIUS = int(BITS * np.arccos(LIKENESS) / np.pi)
#: Further pivots that the search compares large buckets with.
ROUNDS = 3
CACHED_WORDS = 300_000


class Hasher:
    """Fingerprints of texts; remembers the hashes of words, within `CACHED_WORDS`."""

    def __init__(self):
        self.known = common.WordHashes(CACHED_WORDS)

    def _hashes(self, text: bytes) -> np.ndarray:
        """One 64-bit hash for each term occurrence."""
        codes = self.known.of(text.split())
        run = min(RUN, len(codes))
        if not run:
            return codes
        total = np.zeros(len(codes) - run + 1, np.uint64)
        for k in range(run):
            total = common.mixed(total + codes[k : len(codes) - run + 1 + k] + np.uint64(k + 1))
        return total

    def fingerprint(self, text: bytes) -> np.ndarray:
        """BITS / 8 bytes. A long text is voted on in parts, so that the matrix of votes stays small."""
        hashes, ones = self._hashes(text), np.zeros(BITS, np.int64)
        for start in range(0, len(hashes), 4096):
            part = hashes[start : start + 4096]
            words = np.empty((len(part), BITS // 64), np.uint64)
            for k in range(BITS // 64):
                words[:, k] = common.mixed(part + np.uint64(0x9E3779B97F4A7C15 * (k + 1) & (1 << 64) - 1))
            votes = np.unpackbits(words.view(np.uint8), axis=1)
            ones += np.add.reduce(votes, axis=0, dtype=np.uint16)
        return np.packbits(2 * ones > len(hashes))

    def fingerprints(self, texts: list[bytes]) -> np.ndarray:
        """One row for each text."""
        return np.array([self.fingerprint(text) for text in texts], np.uint8).reshape(-1, BITS // 8)


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The cosine that the share of differing bits stands for, not below 0; equal fingerprints have 1."""
    differing = np.unpackbits(a ^ b, axis=1).sum(axis=1)
    return np.maximum(0.0, np.cos(np.pi * differing / BITS))


def fingerprint(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The id and `fingerprint` (hexadecimal) of each row; null texts count as empty."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for batch in batches:
            found = [row.tobytes().hex() for row in hasher.fingerprints(common.bytes_of(batch, text_col))]
            yield pa.RecordBatch.from_arrays([batch.column(id_col), pa.array(found, pa.string())], [id_col, "fingerprint"])

    return docs.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, fingerprint string")


def beside(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each row with the text of the next one in ascending order of id, after the last the first again.

    Rows of one id follow each other in the order of their texts; null ids come first. A table of one row is its
    own next. Columns: the id, `text`, `next_text`; null texts become empty.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    bounds = rows.select("id").where("id IS NOT NULL").approxQuantile("id", [k / parts for k in range(1, parts)], 0.25 / parts)
    bounds = sorted({int(b) for b in bounds})
    part = _range_of(F.col("id"), bounds)
    placed = rows.withColumn("part", part)
    # One row for each range: its smallest row, as (is the id known, id).
    order = F.struct(F.col("id").isNotNull().alias("known"), F.coalesce("id", F.lit(0)).alias("low"))
    firsts = sorted((r.part, r.least.known, r.least.low) for r in placed.groupBy("part").agg(F.min(order).alias("least")).collect())
    # The first range comes after the last one. At most one row for each task of the shuffle: a bounded broadcast.
    heads = [(*first, firsts[k - 1][0]) for k, first in enumerate(firsts)]
    heads = spark.createDataFrame(heads, "part int, known boolean, low long, before int")
    opens = (F.col("id").isNotNull() == F.col("known")) & (F.coalesce("id", F.lit(0)) == F.col("low"))
    own = F.struct(F.col("part").alias("to"), F.lit(False).alias("extra"))
    guest = F.struct(F.col("before").alias("to"), F.lit(True).alias("extra"))
    sent = placed.join(F.broadcast(heads), "part").select(
        "id", "text", F.explode(F.when(opens, F.array(own, guest)).otherwise(F.array(own))).alias("copy")
    ).select("id", "text", "copy.to", "copy.extra")
    # Range k goes to task k: dealt by hash, some tasks would get several ranges and others none.
    ordered = sent.repartitionById(parts, "to").sortWithinPartitions("to", "extra", F.col("id").asc_nulls_first(), "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the last own row: (id, text, range)
        paired = False
        for batch in batches:
            ids, texts, nexts = [], [], []
            for number, text, to, extra in zip(*(batch.column(k).to_pylist() for k in range(4))):
                if held is not None and held[2] == to and not paired:
                    ids.append(held[0]), texts.append(held[1]), nexts.append(text)
                    paired = extra
                if not extra:
                    held, paired = (number, text, to), False
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(texts, pa.string()), pa.array(nexts, pa.string())],
                ["id", "text", "next_text"],
            )

    paired = ordered.mapInArrow(run, "id long, text string, next_text string")
    return paired.withColumnRenamed("id", id_col)


def _range_of(number, bounds: list[int]):
    """The number of bounds that are at most the value, found by halving in one constant array; null lies below all."""
    if not bounds:
        return F.lit(0)
    table = F.split(F.lit(",".join(map(str, bounds))), ",").cast("array<bigint>")
    steps = F.array(*(F.lit(1 << k) for k in reversed(range(len(bounds).bit_length()))))

    def advance(found, step):
        return F.when(F.get(table, found + step - 1) <= number, found + step).otherwise(found)

    return F.aggregate(steps, F.lit(0), advance)


def compare_with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of each text and of its edited form, whose second half is the beginning of the next document.

    Columns: id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for batch in batches:
            for part in common.slices(batch, "text"):
                texts, nexts = common.texts_of(part, "text"), common.texts_of(part, "next_text")
                edited = [
                    (text[: len(text) - len(text) // 2] + following[: len(text) // 2]).encode()
                    for text, following in zip(texts, nexts)
                ]
                own = hasher.fingerprints([text.encode() for text in texts])
                other = hasher.fingerprints(edited)
                # The next text is mostly that of the next row.
                known = [k + 1 < len(texts) and nexts[k] == texts[k + 1] for k in range(len(texts))]
                follow = np.array(
                    [own[k + 1] if known[k] else hasher.fingerprint(nexts[k].encode()) for k in range(len(texts))],
                    np.uint8,
                ).reshape(-1, BITS // 8)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(id_col),
                        pa.array([len(text) for text in texts], pa.int64()),
                        pa.array([hashlib.sha256(text).hexdigest() for text in edited], pa.string()),
                        pa.array([row.tobytes().hex() for row in own], pa.string()),
                        pa.array([row.tobytes().hex() for row in other], pa.string()),
                        pa.array(likeness(own, other)),
                        pa.array(likeness(own, follow)),
                    ],
                    [id_col, "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
                )

    schema = (
        f"`{id_col}` long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double"
    )
    return beside(docs, id_col, text_col).mapInArrow(run, schema)


def _entries(prints: DataFrame, radius: int) -> DataFrame:
    """The distinct fingerprints as `node`, halves `high`, `low` and `keys`, one for each block table.

    The bits are cut into `radius` + 2 blocks. Two near fingerprints agree in at least two blocks, so each table has one pair
    of blocks permuted to the front and holds together what shares that front. Keys are hashes of table and front.
    """
    blocks = radius + 2
    edges = [BITS * k // blocks for k in range(blocks + 1)]
    tables = list(combinations(range(blocks), 2))
    if blocks > BITS:
        raise ValueError(f"a radius of {radius} leaves blocks without bits")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data = np.frombuffer(bytes.fromhex("".join(batch.column("fingerprint").to_pylist())), np.uint8).reshape(-1, BITS // 8)
            bits, fronts = np.unpackbits(data, axis=1), []
            for a, b in zip(edges, edges[1:]):
                wide = np.zeros((len(data), 64), np.uint8)
                wide[:, 64 - (b - a) :] = bits[:, a:b]
                fronts.append(np.packbits(wide, axis=1).view(">u8")[:, 0].astype(np.uint64))
            keys = np.empty((len(data), len(tables)), np.int64)
            for number, (i, j) in enumerate(tables):
                keys[:, number] = common.mixed(common.mixed(fronts[i] + np.uint64(number << 56)) + fronts[j]).view(np.int64)
            ends = pa.array(np.arange(len(data) + 1) * len(tables), pa.int32())
            halves = data.view(">i8").astype(np.int64)
            columns = [batch.column("fingerprint"), pa.array(halves[:, 0]), pa.array(halves[:, 1])]
            columns.append(pa.ListArray.from_arrays(ends, pa.array(keys.ravel())))
            yield pa.RecordBatch.from_arrays(columns, ["fingerprint", "high", "low", "keys"])

    known = prints.select("fingerprint").where("fingerprint IS NOT NULL").distinct()
    entries = known.mapInArrow(run, "fingerprint string, high long, low long, keys array<long>")
    return entries.withColumn("node", F.monotonically_increasing_id())


def _distance(x, y):
    return sum(F.bit_count(x[half].bitwiseXOR(y[half])) for half in ("high", "low"))


def classes(prints: DataFrame, radius: int = RADIUS, id_col: str = "doc_id") -> DataFrame:
    """The rows of `prints` with `near_class`: the smallest id that a chain of fingerprints, each within `radius` bits of the next, leads to.

    Rows without a fingerprint have no class; rows without an id count as members but name no class. Equal fingerprints are one
    entry of the tables, and members of a bucket that are connected already are never compared, so that large groups of
    near copies don't cost all their pairs. No link is lost. A column named `near_class` gives way.
    """
    prints = prints.drop("near_class")
    entries = common.stored(_entries(prints, radius), "fingerprints")  # fixes the numbers
    halves = entries.select("node", F.struct("high", "low").alias("about"))

    parts = links.linked(
        entries.select(F.explode("keys").alias("key"), "node", F.lit(0).cast("long").alias("info")),
        lambda info: info,
        lambda x, y: F.lit(True),
        lambda active: halves,
        lambda x, y: _distance(x, y) <= radius,
        lambda pairs: pairs,  # the comparison of the whole fingerprints has been exact
        rounds=ROUNDS,
        hot=True,
    )
    parts = entries.select("fingerprint", "node").join(parts, "node", "left")
    parts = common.stored(parts.select("fingerprint", F.coalesce("component", "node").alias("part")), "classes")
    # The smallest id of each fingerprint first, then of each class.
    lowest = prints.groupBy("fingerprint").agg(F.min(id_col).alias("least")).join(parts, "fingerprint")
    lowest = lowest.groupBy("part").agg(F.min("least").alias("near_class"))
    named = parts.join(lowest, "part").select("fingerprint", "near_class")
    return prints.join(named, "fingerprint", "left").select(*prints.columns, "near_class")


def near(prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """All pairs of distinct fingerprints that differ in at most `radius` bits: `a`, `b` (a < b) and `distance`.

    Meant for sets whose groups are small, as a group of near copies gives all its pairs; `classes` is for any others.
    """
    entries = _entries(prints, radius).select("fingerprint", F.struct("high", "low").alias("about"), F.explode("keys").alias("key"))
    left, right = (entries.toDF(name, f"{name}_about", "key") for name in "ab")
    both = left.join(right, "key").where(F.col("a") < F.col("b"))
    both = both.withColumn("distance", _distance(F.col("a_about"), F.col("b_about")))
    return both.where(F.col("distance") <= radius).select("a", "b", "distance").distinct()
