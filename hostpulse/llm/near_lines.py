"""Line dedup: a segment-partition edit join over all lines of a corpus.

Two lines within `EDITS` edits agree, unchanged and nearly in place, in at least one of `EDITS` + 1 segments of the shorter one. So each
distinct line is indexed by its segments and probes, for each length that a partner may have, the substrings that can
stand for a segment of that length. Candidates whose letter counts differ by more than the edits allow are
dropped, and the rest is verified with banded bit-parallel edit distance. Where more than `links.FULL` lines that are not
connected share a segment, as those of a template do, they are compared only if they also share one of their rarest strings
of `GRAM` letters, which all linked lines do; so lines that share nothing else don't cost all their pairs. Lines that are linked, directly or through
others, form a component.

A line is removed if an earlier one, in the order of id, text and line number, is in its component: exact repeats are components of their
own. Lines of fewer than `LEAST` letters are not compared for edits: their segments would be shorter than ten letters and two edits a
large part of them. With `short`, as the query and the pipeline have it, those of them that hold a word still go
if an earlier line equals them; without, they stay as they are. Lines without a word and of fewer than `LEAST` letters always stay.
Letters are code points. Null texts count as empty, stay null, and lose nothing. Rows that agree in id and text are one document, treated alike. Columns
besides the id and the text are kept by `dedup` and never looked at. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hostpulse.llm import common, links

EDITS = 2
LEAST = 30
#: Classes of letters that are counted before verification.
RANGES = 16
#: Letters of the strings by which the lines of a full bucket are told apart, and the slots of their frequency table.
GRAM = 4
SLOTS = 1 << 16
#: Lengths of lines whose places are remembered by a task.
LENGTHS = 4096
#: What stands between words, besides the line's end.
BLANKS = " \t\x0b\f\r"


def segments(length: int, edits: int) -> list[tuple[int, int]]:
    """Start and size of the edits + 1 segments of a line; the later ones take what does not divide evenly."""
    parts = edits + 1
    size, more = divmod(length, parts)
    out, start = [], 0
    for number in range(parts):
        own = size + (number >= parts - more)
        out.append((start, own))
        start += own
    return out


def _spots(n: int, edits: int) -> list[tuple[int, int, int]]:
    """Number, beginning and end, in bytes, of what is hashed of a line of `n` letters: first its own segments."""
    own = [(n * 31 + i, start, size) for i, (start, size) in enumerate(segments(n, edits))]
    others = []
    for length in range(max(0, n - edits), n + 1):
        shift = n - length
        for i, (start, size) in enumerate(segments(length, edits)):
            # Of the edits, at most i lie before segment i and at most edits - i behind it, if it is the first that agrees.
            low = max(0, start - i, start + shift - (edits - i))
            high = min(n - size, start + i, start + shift + (edits - i))
            others += [(length * 31 + i, at, size) for at in range(low, high + 1) if shift or at != start]
    return [(number, 4 * at, 4 * (at + size)) for number, at, size in own + others]


def keys(line: str, edits: int, known: dict | None = None) -> list[int]:
    """Hashes of the line's own segments, then of the other substrings with which it probes lines no longer than itself.

    `known` remembers the places by length, for up to `LENGTHS` lengths.
    """
    data, digest = line.encode("utf-32-le", "surrogatepass"), xxhash.xxh3_64_intdigest
    known = {} if known is None else known
    if (spots := known.get(len(line))) is None:
        if len(known) >= LENGTHS:
            known.clear()
        spots = known[len(line)] = _spots(len(line), edits)
    found = [digest(data[start:end], number) - (1 << 63) for number, start, end in spots]
    own = found[: edits + 1]
    return own + sorted(set(found).difference(own))


def grams(line: str) -> np.ndarray:
    """Hashes of the line's strings of `GRAM` letters, repeats numbered, so that all are different."""
    letters = np.frombuffer(line.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    count = max(0, len(letters) - GRAM + 1)
    value = np.zeros(count, np.uint64)
    for k in range(GRAM):
        value = common.mixed(value + letters[k : k + count] + np.uint64(1))
    value.sort()
    starts = np.flatnonzero(np.r_[True, value[1:] != value[:-1]]) if count else np.zeros(0, np.int64)
    turn = np.arange(count) - np.repeat(starts, np.diff(np.r_[starts, count]))
    return np.where(turn == 0, value, common.mixed(value + turn.astype(np.uint64)))


def rarest(found: np.ndarray, times: np.ndarray, edits: int) -> np.ndarray:
    """The `GRAM` * `edits` + 1 first grams by one order for all lines, rare slots first.

    An edit changes at most `GRAM` grams, so two lines that are linked share one of these, if they have as many.
    """
    order = np.lexsort((found, times[found % np.uint64(SLOTS)]))
    return found[order[: GRAM * edits + 1]]


def within(a: str, b: str, edits: int) -> bool:
    """Whether the edit distance of two texts is at most `edits`. Equal beginnings and ends are set aside first."""
    if abs(len(a) - len(b)) > edits:
        return False
    start = _agree(min(len(a), len(b)), lambda n: a[:n] == b[:n])
    a, b = a[start:], b[start:]
    end = _agree(min(len(a), len(b)), lambda n: a[len(a) - n :] == b[len(b) - n :])
    a, b = a[: len(a) - end], b[: len(b) - end]
    if not a or not b:
        return True
    return _banded(a, b, edits)


def _agree(most: int, equal) -> int:
    """The largest length at most `most` for which `equal` holds, by halving."""
    low, high = 0, most
    while low < high:
        middle = (low + high + 1) // 2
        low, high = (middle, high) if equal(middle) else (low, middle - 1)
    return low


def _banded(a: str, b: str, edits: int) -> bool:
    """Bit-parallel edit distance over a band of 2 * edits + 1 diagonals.

    Rows are the letters of `a`, columns those of `b`. In column j (from 0), bit k stands for row j - edits + k. `rise` and
    `fall` hold the rows whose value is one more or one less than that of the row above. The distance is followed down the
    band's lower edge until the last row, then along that row. Of each letter only the rows of the band at its last place are
    kept, with the band's first row there.
    """
    m, width = len(a), 2 * edits + 1
    full, lowest = (1 << width) - 1, 1 << (width - 1)
    rows: dict[str, tuple[int, int]] = {}
    for row in range(min(m, edits)):
        rows[a[row]] = (rows.get(a[row], (0, 0))[0] | 1 << (row + edits), -edits)
    rise, fall, distance = (full << edits) & full, 0, min(m, edits)
    for column, letter in enumerate(b):
        base, row = column - edits, column + edits
        if row < m:
            mask, since = rows.get(a[row], (0, base))
            rows[a[row]] = (mask >> min(base - since, width) | lowest, base)
        mask, since = rows.get(letter, (0, base))
        hit = mask >> min(base - since, width)
        same = ((((hit & rise) + rise) ^ rise) | hit | fall) & full  # no more than the cell one up and one left
        right_rise = fall | (full & ~(same | rise))
        right_fall = same & rise
        if column < m - edits:
            distance += not same & lowest
            if distance > 3 * edits:  # it falls by at most 2 * `edits` along the last row
                return False
        else:
            last = 1 << (m - 1 + edits - column)
            distance += bool(right_rise & last) - bool(right_fall & last)
        rise = right_fall | (full & ~((same >> 1) | right_rise))
        fall = (same >> 1) & right_rise
    return distance <= edits


def _occurrences(rows: DataFrame, edits: int, least: int, short: bool) -> DataFrame:
    """Each line of at least `least` letters: where it stands, its digest and its keys; with `short` also lines with a
    word below that, without keys.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict = {}
        for batch in batches:
            for part in common.slices(batch, "text"):
                owners, numbers, digests, flat, ends = [], [], [], [], [0]
                for owner, text in enumerate(common.texts_of(part)):
                    for number, line in enumerate(text.split("\n")):
                        long = len(line) >= least
                        if long or (short and line.strip(BLANKS)):
                            owners.append(owner), numbers.append(number)
                            digests.append(xxhash.xxh3_128_digest(line.encode()))
                            if long:
                                flat += keys(line, edits, known)
                            ends.append(len(flat))
                both = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
                columns = [part.column(name).take(pa.array(owners, pa.int64())) for name in ("k1", "k2", "known")]
                columns += [pa.array(numbers, pa.int32()), pa.array(both[:, 0]), pa.array(both[:, 1])]
                columns.append(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.int64())))
                yield pa.RecordBatch.from_arrays(columns, ["k1", "k2", "known", "number", "l1", "l2", "keys"])

    return rows.mapInArrow(
        run, "k1 long, k2 long, known boolean, number int, l1 long, l2 long, keys array<long>"
    )


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(
        *common.row_key(id_col, text_col), F.col(id_col).isNotNull().alias("known"), F.col(text_col).alias("text")
    )


def _by_grams(lines: DataFrame, edits: int) -> DataFrame:
    """Buckets of the lines by their rarest grams, for lines of which too many share a segment: `key`, `node`, `info` 0."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(SLOTS, np.int64)
        for batch in batches:
            for part in common.slices(batch, "line"):
                found = np.concatenate([grams(line) for line in common.texts_of(part, "line")])
                total += np.bincount((found % np.uint64(SLOTS)).astype(np.int64), minlength=SLOTS)
        slots = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(slots), pa.array(total[slots])], ["slot", "times"])

    lines = common.stored(lines, "full-lines")
    times = np.zeros(SLOTS, np.int64)
    # At most `SLOTS` rows, whatever the number of lines.
    for row in lines.mapInArrow(count, "slot long, times long").groupBy("slot").agg(F.sum("times").alias("times")).collect():
        times[row.slot] = row.times

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in common.slices(batch, "line"):
                found = [rarest(grams(line), times, edits) for line in common.texts_of(part, "line")]
                nodes = np.repeat(part.column("node").to_numpy(), [len(own) for own in found])
                flat = np.concatenate(found).view(np.int64)
                columns = [pa.array(flat), pa.array(nodes, pa.int64()), pa.array(np.zeros(len(flat), np.int64))]
                yield pa.RecordBatch.from_arrays(columns, ["key", "node", "info"])

    return lines.mapInArrow(run, "key long, node long, info long")


def removals(
    docs: DataFrame,
    edits: int = EDITS,
    least: int = LEAST,
    id_col: str = "doc_id",
    text_col: str = "text",
    short: bool = False,
) -> DataFrame:
    """The numbers of the lines to remove, for each document that loses any: `k1`, `k2` (see `row_key`), `numbers`."""
    rows = _rows(docs, id_col, text_col)
    found = common.stored(_occurrences(rows, edits, least, short), "lines")
    place = F.struct("known", "k1", "k2", "number")
    whole = (
        found.groupBy("l1", "l2")
        .agg(F.min(place).alias("first"), F.count("*").alias("times"), F.any_value("keys").alias("keys"))
        # A short line that stands once is neither repeated nor compared.
        .where((F.col("times") > 1) | (F.size("keys") > 0))
        .withColumn("node", F.monotonically_increasing_id())
    )
    whole = common.stored(whole, "lines-with-keys")  # fixes the numbers
    items = common.stored(whole.drop("keys"), "distinct-lines")
    places = common.stored(found.drop("keys"), "places")
    common.release(found)
    # A member's info: 0 for a line's own segments, which others probe, and 1 for what it probes with.
    members = whole.select(F.posexplode("keys").alias("pos", "key"), "node").select(
        "key", "node", (F.col("pos") > edits).cast("long").alias("info")
    )

    lines: list[DataFrame] = []

    def profile(active: DataFrame) -> DataFrame:
        """Counts of the letters by class of the lines that share a bucket; their texts are kept for `verify`."""
        common.release(whole)
        wanted = items.join(active, "node").groupBy("first.k1", "first.k2").agg(
            F.collect_list(F.struct("first.number", "node")).alias("wanted")
        )

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                nodes, texts, counts = [], [], []
                for text, wanted in zip(common.texts_of(batch), batch.column("wanted").to_pylist()):
                    split = text.split("\n")
                    for entry in wanted:
                        line = split[entry["number"]]
                        letters = np.frombuffer(line.encode("utf-32-le"), np.uint32) % RANGES
                        nodes.append(entry["node"]), texts.append(line)
                        counts.append(np.bincount(letters, minlength=RANGES).tolist())
                data = [pa.array(nodes, pa.int64()), pa.array(texts, pa.string()), pa.array(counts, pa.list_(pa.int32()))]
                yield pa.RecordBatch.from_arrays(data, ["node", "line", "ranges"])

        picked = rows.select("k1", "k2", "text").join(wanted, ["k1", "k2"]).select("text", "wanted")
        lines.append(common.stored(picked.mapInArrow(run, "node long, line string, ranges array<int>"), "texts"))
        return lines[0].select("node", F.col("ranges").alias("about"))

    def close(x: Column, y: Column) -> Column:
        return common.differing(x, y) <= 2 * edits

    def verify(pairs: DataFrame) -> DataFrame:
        texts = lines[0].select("node", "line")
        both = pairs.join(texts.toDF("a", "x"), "a").join(texts.toDF("b", "y"), "b")

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                good = [within(x, y, edits) for x, y in zip(batch.column("x").to_pylist(), batch.column("y").to_pylist())]
                mask = pa.array(good, pa.bool_())
                yield pa.RecordBatch.from_arrays([batch.column(c).filter(mask) for c in ("a", "b")], ["a", "b"])

        return both.select("a", "b", "x", "y").mapInArrow(run, "a long, b long").distinct()

    def fits(x: Column, y: Column) -> Column:
        return F.least(x, y) == 0

    def split(nodes: DataFrame) -> DataFrame:
        return _by_grams(lines[0].join(nodes, "node").select("node", "line"), edits)

    # Lines with fewer grams than an edit join needs can't be told apart by them.
    finer = split if least - GRAM >= GRAM * edits else None
    parts = links.linked(members, lambda info: info, fits, profile, close, verify, barren=lambda info: info > 0, split=finer)
    small = items.select("l1", "l2", "first", "times", "node")
    named = small.join(parts, "node", "left").withColumn("part", F.coalesce("component", "node"))
    heads = named.where("component IS NOT NULL").groupBy("part").agg(F.min("first").alias("head"))
    decided = (
        named.where("times > 1 OR component IS NOT NULL")
        .join(heads, "part", "left")
        .select("l1", "l2", F.coalesce("head", "first").alias("head"))
    )
    gone = places.join(decided, ["l1", "l2"]).where(place != F.col("head"))
    return gone.groupBy("k1", "k2").agg(F.collect_set("number").alias("numbers"))


def dedup(
    docs: DataFrame,
    edits: int = EDITS,
    least: int = LEAST,
    id_col: str = "doc_id",
    text_col: str = "text",
    short: bool = False,
) -> DataFrame:
    """The rows with all their columns; `text_col` without the removed lines, and how many lines there were and went.

    The two counts are `n_lines` and `n_removed`; columns of `docs` with these names give way to them.
    """
    gone = removals(docs, edits, least, id_col, text_col, short)
    keep = [name for name in docs.columns if name not in ("n_lines", "n_removed")]
    others = F.struct(F.lit(0).alias("none"), *(F.col(name) for name in keep if name != text_col))
    packed = docs.select(*common.row_key(id_col, text_col), others.alias("row"), F.col(text_col).alias("text"))
    joined = packed.join(gone, ["k1", "k2"], "left")
    lines = F.split("text", "\n", -1)
    left = F.array_join(F.filter(lines, lambda line, at: ~F.array_contains("numbers", at)), "\n")
    text = F.when(F.col("numbers").isNull(), F.col("text")).otherwise(left)
    return joined.select(
        *(text.alias(name) if name == text_col else F.col(f"row.`{name}`").alias(name) for name in keep),
        F.when(F.col("text").isNull(), F.lit(0)).otherwise(F.size(lines)).cast("long").alias("n_lines"),
        F.greatest(F.coalesce(F.size("numbers"), F.lit(0)), F.lit(0)).cast("long").alias("n_removed"),
    )
