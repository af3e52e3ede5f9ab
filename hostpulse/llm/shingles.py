"""N-gram Jaccard join: documents whose sets of word n-grams are similar, and the components they form.

A set is ordered rare-first: by the counts of all n-grams of the corpus in `SLOTS` hashed slots, then by hash. Any
common order is right; this one keeps frequent n-grams out of the prefixes. Similar sets share an n-gram of their
prefixes, so these are the buckets. Lengths and positions rule out pairs within a bucket, the suffix filter
rules out pairs by the counts of their n-grams in ranges of the hash, a parity bitmap more of them, and each pair left is verified once on the
whole sets. Documents with equal sets are one item throughout.

N-grams are compared by 64-bit hashes of 64-bit word hashes. A text with fewer words than the n-gram has its whole sequence as the only element; a text
without words, null included, has an empty set and is linked with nothing. Rows that share an id keep their own
sets; rows without an id are compared like all others, but no component is named after them. Columns besides the id
and the text are ignored, and an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hostpulse.llm import common, links
from hostpulse.llm.bpe import _Sent

#: Slots of the frequency table, which is sent to every task.
SLOT_BITS = 14
SLOTS = 1 << SLOT_BITS
_BELOW = np.uint64((1 << (64 - SLOT_BITS)) - 1)
#: Ranges of the suffix filter, and bits of the parity filter (32 words of 64).
RANGES = 16
PARITY_WORDS = 32
CACHED_WORDS = 300_000
#: Pivots that a bucket may get beyond its first before pairs are compared; results do not depend on it.
ROUNDS = 4


def _place() -> Column:
    return F.struct(F.col("id").isNull().alias("unknown"), F.col("k1"), F.col("k2"))


class Shingler:
    """Sets of n-grams as sorted distinct hashes.

    The highest bits of a hash are its slot in the frequency table; with `ranks`, the slot gives way to its rank, rare first. So
    sorted hashes are in rare-first order, and no two n-grams change places in different texts.
    """

    def __init__(self, width: int, ranks: np.ndarray | None = None):
        self.width, self.ranks = width, ranks
        self.known = common.WordHashes(CACHED_WORDS)

    def grams(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The hashes of all n-grams of all texts, and where those of each text begin and end."""
        words, ends = [], [0]
        for text in texts:
            words += text.lower().split()
            ends.append(len(words))
        codes = np.r_[self.known.of(words), np.zeros(self.width, np.uint64)]
        total = np.zeros(len(words), np.uint64)
        sizes = np.diff(ends)
        # Texts shorter than an n-gram end it at their last word.
        runs = np.repeat(np.minimum(sizes, self.width), sizes)
        for k in range(self.width):
            following = common.mixed(total * np.uint64(0x9E3779B97F4A7C15) + codes[k : len(words) + k])
            total = np.where(k < runs, following, total)
        total = common.mixed(total + runs.astype(np.uint64))
        if self.ranks is not None:
            total = self.ranks[_slot(total)] << np.uint64(64 - SLOT_BITS) | total & _BELOW
        counts = np.where(sizes > 0, np.maximum(sizes - self.width + 1, 1), 0)
        starts = np.asarray(ends[:-1])
        return total, np.stack([starts, starts + counts], axis=1)

    def sets(self, texts: list[bytes]) -> list[np.ndarray]:
        total, places = self.grams(texts)
        return [np.unique(total[start:end]) for start, end in places.tolist()]


def _slot(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - SLOT_BITS)).astype(np.int64)


def ranks(docs: DataFrame, text_col: str, width: int) -> np.ndarray:
    """Ranks of the slots by how many n-grams of all documents fall into them; each n-gram counts once for a document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, counts = Shingler(width), np.zeros(SLOTS, np.int64)
        for batch in batches:
            for part in common.slices(batch, text_col):
                for found in shingler.sets(common.bytes_of(part, text_col)):
                    np.add.at(counts, _slot(found), 1)
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(counts[used])], ["slot", "n"])

    rows = docs.select(text_col).mapInArrow(run, "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n"))
    table = np.zeros(SLOTS, np.int64)
    for row in rows.collect():  # at most SLOTS rows
        table[row.slot] = row.n
    order = np.empty(SLOTS, np.uint64)
    order[np.argsort(table, kind="stable")] = np.arange(SLOTS, dtype=np.uint64)
    return order


def _profiles(docs: DataFrame, order, text_col: str, width: int, percent: int) -> DataFrame:
    """For each row its key, id, set size, set hash, prefix in rare-first order and counts by range."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(width, order.value)
        for batch in batches:
            for part in common.slices(batch, text_col):
                found = shingler.sets(common.bytes_of(part, text_col))
                sizes = np.array([len(s) for s in found], np.int64)
                digests = b"".join(xxhash.xxh3_128_digest(s.tobytes()) for s in found)
                digests = np.frombuffer(digests, np.int64).reshape(-1, 2)
                keep = np.where(sizes > 0, sizes - (percent * sizes + 99) // 100 + 1, 0)
                prefixes = np.concatenate([s[:k] for s, k in zip(found, keep.tolist())]).view(np.int64)
                owner = np.repeat(np.arange(len(found)), sizes)
                classes = (np.concatenate(found) & np.uint64(RANGES - 1)).astype(np.int64)
                counts = np.bincount(owner * RANGES + classes, minlength=RANGES * len(found)).astype(np.int32)
                # Bit k: whether an odd number of the set's n-grams have k as their lowest bits.
                bits = np.zeros((len(found), PARITY_WORDS * 64), np.uint8)
                lowest = (np.concatenate(found) & np.uint64(PARITY_WORDS * 64 - 1)).astype(np.int64)
                np.bitwise_xor.at(bits.reshape(-1), owner * PARITY_WORDS * 64 + lowest, 1)
                parity = np.packbits(bits, axis=1).reshape(-1).view(np.int64)
                ends = np.cumsum(np.r_[0, keep]).astype(np.int32)
                steps = np.arange(0, RANGES * len(found) + 1, RANGES, dtype=np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        *(part.column(name) for name in ("k1", "k2", "id")),
                        pa.array(sizes, pa.int32()),
                        pa.array(digests[:, 0]),
                        pa.array(digests[:, 1]),
                        pa.ListArray.from_arrays(pa.array(ends), pa.array(prefixes)),
                        pa.ListArray.from_arrays(pa.array(steps), pa.array(counts)),
                        pa.ListArray.from_arrays(pa.array(steps // RANGES * PARITY_WORDS), pa.array(parity)),
                    ],
                    ["k1", "k2", "id", "n", "s1", "s2", "prefix", "ranges", "parity"],
                )

    schema = "k1 long, k2 long, id long, n int, s1 long, s2 long, prefix array<long>, ranges array<int>, parity array<long>"
    return docs.mapInArrow(run, schema)


def _classes(docs: DataFrame, width: int, percent: int, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """The profiles of all rows, and for each distinct set its component's smallest id and first row (`head`)."""
    rows = docs.select(*common.row_key(id_col, text_col), F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    order = _Sent(docs.sparkSession, ranks(rows, "text", width))
    full = common.stored(_profiles(rows, order, "text", width, percent), "profiles-with-prefixes")
    # One item for each distinct set.
    items = (
        full.where("n > 0")
        .groupBy("s1", "s2")
        .agg(
            F.min("id").alias("low"),
            F.min(_place()).alias("row"),
            *(F.any_value(c).alias(c) for c in ("n", "prefix", "ranges", "parity")),
        )
        .select("s1", "s2", "low", "row", "row.k1", "row.k2", "n", "prefix", "ranges", "parity")
        .withColumn("node", F.monotonically_increasing_id())
    )
    whole = common.stored(items, "items-with-prefixes")  # fixes the numbers
    items = common.stored(whole.drop("prefix"), "items")
    profiles = common.stored(full.drop("prefix", "ranges", "parity"), "profiles")
    common.release(full)
    # A member's info: the size of its set, and the place of the bucket's n-gram in it.
    members = whole.select(F.posexplode("prefix").alias("pos", "key"), "node", "n").select(
        "key", "node", (F.shiftleft(F.col("n").cast("long"), 32) + F.col("pos")).alias("info")
    )

    def need(a: Column, b: Column) -> Column:
        """Least intersection: 100 i >= p (a + b - i)."""
        return F.floor((percent * (a + b) + (99 + percent)) / F.lit(100 + percent))

    def fits(x: Column, y: Column) -> Column:
        nx, ny = F.shiftright(x, 32), F.shiftright(y, 32)
        rest = F.least(nx - x.bitwiseAND(0xFFFFFFFF), ny - y.bitwiseAND(0xFFFFFFFF))
        return (F.least(nx, ny) * 100 >= F.greatest(nx, ny) * percent) & (rest >= need(nx, ny))

    def profile(active: DataFrame) -> DataFrame:
        common.release(whole)
        return common.stored(items.join(active, "node").select("node", F.struct("n", "ranges", "parity").alias("about")), "about")

    def close(x: Column, y: Column) -> Column:
        """Whether the sets may differ in few enough n-grams.

        The suffix filter adds up the differences of their counts by range; the parity filter counts the bits in which an
        odd number of n-grams has to differ. Neither exceeds the true number.
        """
        most = x.n + y.n - 2 * need(x.n, y.n)
        odd = F.aggregate(
            F.zip_with(x.parity, y.parity, lambda p, q: F.bit_count(p.bitwiseXOR(q))), F.lit(0), lambda total, v: total + v
        )
        return (common.differing(x.ranges, y.ranges) <= most) & (odd <= most)

    def verify(pairs: DataFrame) -> DataFrame:
        """Compares the whole sets, which are made for the documents in these pairs alone."""
        nodes = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
        wanted = items.join(nodes, "node").select("k1", "k2", "node", "n")

        def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            shingler = Shingler(width)
            for batch in batches:
                found = [s.tobytes() for s in shingler.sets(common.bytes_of(batch, "text"))]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("node"), batch.column("n"), pa.array(found, pa.binary())], ["node", "n", "grams"]
                )

        texts = rows.select("k1", "k2", "text").join(wanted, ["k1", "k2"]).select("node", "n", "text")
        sets = common.stored(texts.mapInArrow(make, "node long, n int, grams binary"), "sets")

        def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                good = []
                for least, x, y in zip(*(batch.column(c).to_pylist() for c in ("least", "x", "y"))):
                    both = np.frombuffer(x + y, np.uint64).copy()
                    both.sort()
                    good.append(int((both[1:] == both[:-1]).sum()) >= least)
                mask = pa.array(good, pa.bool_())
                yield pa.RecordBatch.from_arrays([batch.column(c).filter(mask) for c in ("a", "b")], ["a", "b"])

        both = pairs.join(sets.toDF("a", "a_n", "x"), "a").join(sets.toDF("b", "b_n", "y"), "b")
        least = need(F.col("a_n"), F.col("b_n")).alias("least")
        return both.select("a", "b", least, "x", "y").mapInArrow(compare, "a long, b long").distinct()

    parts = links.linked(members, lambda info: F.lit(0), fits, profile, close, verify, ROUNDS)
    named = items.join(parts, "node", "left").select(
        "s1", "s2", "low", "row", F.coalesce("component", "node").alias("part")
    )
    lowest = named.groupBy("part").agg(F.min("low").alias("component_id"), F.min("row").alias("head"))
    return profiles, named.join(lowest, "part").select("s1", "s2", "component_id", "head")


def similar(
    docs: DataFrame, width: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The id, `n_shingles` and `component_id` of each row.

    Two documents are linked if 100 * intersection >= percent * union of their sets of `width`-word n-grams; a
    component's id is the smallest id in it.
    """
    profiles, classes = _classes(docs, width, percent, id_col, text_col)
    return profiles.select("id", "n", "s1", "s2").join(classes, ["s1", "s2"], "left").select(
        F.col("id").alias(id_col),
        F.col("n").cast("long").alias("n_shingles"),
        F.coalesce("component_id", "id").alias("component_id"),
    )


def dedup(
    docs: DataFrame, width: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row of each component, with all its columns: that with the smallest id, rows without one last.

    Rows that agree in id and text are copies too, and one of them stays; so does every row without words.
    """
    profiles, classes = _classes(docs, width, percent, id_col, text_col)
    heads = profiles.join(classes, ["s1", "s2"], "left").where((F.col("n") == 0) | (_place() == F.col("head")))
    others = F.struct(F.lit(0).alias("none"), *(F.col(name) for name in docs.columns if name != text_col))
    packed = docs.select(*common.row_key(id_col, text_col), others.alias("row"), F.col(text_col).alias("text"))
    left = packed.join(heads.select("k1", "k2"), ["k1", "k2"], "left_semi").dropDuplicates(["k1", "k2"])
    return left.select(
        *(F.col("text").alias(n) if n == text_col else F.col(f"row.`{n}`").alias(n) for n in docs.columns)
    )
