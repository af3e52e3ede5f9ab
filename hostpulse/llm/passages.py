"""Suffix-array dedup: removes every byte of a string of `LENGTH` bytes that also starts anywhere else.

The suffixes of the corpus are never sorted as a whole, since only the question whether a suffix shares its first
`LENGTH` bytes with another matters. Bucket-pointer refinement is applied to that question: suffixes are put into
buckets by their first `GRAM` bytes, and only buckets with more than one suffix are refined by what stands at later offsets.

- Each string of `LENGTH` bytes is represented by one suffix within it, its anchor: the place where the hash of 8 bytes is smallest, among
  the places that leave `GRAM` bytes up to the string's end. Equal strings have their anchor in the same place, and all
  strings with one anchor start side by side, so a document has few anchors.
- First bucket: the hash of the `GRAM` bytes at the anchor. Anchors that are alone in their bucket have no repeated string.
- Second bucket: the digest of all bytes that the anchor's strings cover. In a bucket of two or more, all strings are repeated.
- Where one first bucket holds several second buckets, one member of each is refined down to the single strings: the pointer to a place's
  bucket of 8 bytes and that of the place 8 bytes on make the pointer to its bucket of 16, and so on up to `LENGTH`, each length made from the
  pointers of the one before at a later offset. First buckets with more than `GROUP` second buckets are refined by digests
  of the single strings, dealt over all tasks.

The parts that are compared are then mapped back to all members of their buckets. The same is done with words in the place of bytes
(`words=True`): then strings of `WORDS` words that also start anywhere else are found, whatever blanks stand between the words, and go with the
blanks inside. Words are compared by 64-bit hashes.

Null texts count as empty. Rows that agree in id and text are one row repeated, so all their strings are repeated. Columns besides the
id and the text are ignored; an empty table gives an empty result. Long texts are worked through in overlapping pieces. Equality
is that of 128-bit digests, or of 64-bit pointers within one bucket.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hostpulse.llm import common

LENGTH = 400
GRAM = 100
#: The same in words.
WORDS = 50
WORD_GRAM = 8
#: Second buckets of one first bucket that one task refines together; they hold at most `GROUP` times 2 * LENGTH bytes.
GROUP = 4096
#: Bytes, of several first buckets, that are refined at a time, and bytes or words of a text whose anchors are sought at a time.
REFINED = 1 << 20
PIECE = 1 << 20
_PLACE = np.uint64((1 << 32) - 1)
_ODD = np.uint64(0x9E3779B97F4A7C15)
_BLANK = re.compile(rb"[ \t-\r]")
_WORD = re.compile(rb"[^ \t-\r]+")


def sequence(text: bytes, words: bool) -> bytes:
    """The text itself or, in 8 bytes each, the hashes of its words."""
    if not words:
        return text
    parts = (text,) if len(text) <= PIECE else _at_blanks(text)
    return b"".join(_hashed(part.split()) for part in parts)


def _hashed(words: list[bytes]) -> bytes:
    return b"".join(map(xxhash.xxh3_64_digest, words))


def _at_blanks(text: bytes) -> Iterator[bytes]:
    """A long text in parts that end where a word does."""
    start = 0
    while start < len(text):
        blank = _BLANK.search(text, min(start + PIECE, len(text)))
        end = blank.end() if blank else len(text)
        yield text[start:end]
        start = end


def _units(data: bytes, unit: int) -> tuple[np.ndarray, int]:
    """One number for each place, and how many bytes or words it stands for: 8 bytes from there on, or a word."""
    if unit == 8:
        return np.frombuffer(data, np.uint64), 1
    eight = np.frombuffer(data + bytes(8), np.uint8).astype(np.uint64)
    for width in (1, 2, 4):
        eight = eight[:-width] | eight[width:] << np.uint64(8 * width)
    return eight[: len(data)], 8


def _pieces(texts: list[bytes], unit: int, length: int) -> Iterator[list[tuple[int, int, bytes]]]:
    """Groups of (number of the text, start, piece). Pieces of one text share `length` - 1 places, so that no string is cut or seen twice."""
    held, size = [], 0
    for number, text in enumerate(texts):
        for start in range(0, max(1, len(text) // unit - length + 1), PIECE):
            piece = text[start * unit : (start + PIECE + length - 1) * unit]
            if held and size + len(piece) > PIECE * unit:
                yield held
                held, size = [], 0
            held.append((number, start, piece))
            size += len(piece)
    if held:
        yield held


def anchors(texts: list[bytes], length: int = LENGTH, gram: int = GRAM, unit: int = 1):
    """For each anchor: number of the text, place in it, places from its first string's start to it, and strings less one."""
    sizes = np.array([len(text) // unit for text in texts], np.int64)
    starts = np.cumsum(np.r_[0, sizes])[:-1]
    empty = np.zeros(0, np.int64)
    total = int(sizes.sum())
    if total < length:
        return empty, empty, empty, empty
    units, _ = _units(b"".join(texts), unit)
    if unit == 8:  # two words each
        units = units * _ODD + np.r_[units[1:], np.zeros(1, np.uint64)]
    key = common.mixed(units) & ~_PLACE | np.arange(total, dtype=np.uint64)
    # Sliding minimum over the places that a string may have its anchor at, from running minima within blocks.
    reach = length - gram + 1
    blocks = -(-total // reach)
    padded = np.full(blocks * reach, ~np.uint64(0))
    padded[:total] = key
    padded = padded.reshape(blocks, reach)
    ahead = np.minimum.accumulate(padded, axis=1).ravel()
    behind = np.minimum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()
    count = total - length + 1
    place = (np.minimum(behind[:count], ahead[reach - 1 : reach - 1 + count]) & _PLACE).astype(np.int64)
    first = np.repeat(starts, np.maximum(sizes - length + 1, 0))
    owner = np.repeat(np.arange(len(texts)), np.maximum(sizes - length + 1, 0))
    if not len(owner):
        return empty, empty, empty, empty
    offsets = np.arange(len(owner)) - np.repeat(
        np.cumsum(np.r_[0, np.maximum(sizes - length + 1, 0)])[:-1], np.maximum(sizes - length + 1, 0)
    )
    place = place[first + offsets] - first  # in the text; within one text the anchor never moves back
    turn = np.flatnonzero(np.r_[True, (place[1:] != place[:-1]) | (owner[1:] != owner[:-1])])
    end = np.r_[turn[1:], len(owner)] - 1
    return owner[turn], place[turn], place[turn] - offsets[turn], offsets[end] - offsets[turn]


def _digest(data: bytes, seed: int = 0) -> tuple[int, int]:
    a, b = np.frombuffer(xxhash.xxh3_128_digest(data, seed=seed), np.int64).tolist()
    return a, b


def _signed(number: int) -> int:
    return number - (1 << 63)


def _found(rows: DataFrame, length: int, gram: int, unit: int) -> DataFrame:
    """The anchors of all rows with their first and second bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in common.slices(batch, "text"):
                texts = [sequence(text, unit == 8) for text in common.bytes_of(part, "text")]
                for group in _pieces(texts, unit, length):
                    yield of(part, texts, group)

    def of(part: pa.RecordBatch, texts: list[bytes], group: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
        owner, place, back, more = anchors([piece for *_, piece in group], length, gram, unit)
        numbers, starts, _ = zip(*group)
        owner, place = np.array(numbers)[owner], place + np.array(starts)[owner]
        first, second_a, second_b = [], [], []
        at, low, high = place * unit, (place - back) * unit, (place - back + more + length) * unit
        for o, p, k, start, end in zip(owner.tolist(), at.tolist(), back.tolist(), low.tolist(), high.tolist()):
            text = texts[o]
            first.append(_signed(xxhash.xxh3_64_intdigest(text[p : p + gram * unit])))
            a, b = _digest(text[start:end], k)
            second_a.append(a), second_b.append(b)
        keys = [part.column(k).take(pa.array(owner)) for k in ("k1", "k2")]
        spread = place << 20 | back << 10 | more
        numbers = [pa.array(x, pa.int64()) for x in (spread, first, second_a, second_b)]
        return pa.RecordBatch.from_arrays([*keys, *numbers], ["k1", "k2", "spread", "first", "a", "b"])

    return rows.mapInArrow(run, "k1 long, k2 long, spread long, first long, a long, b long")


def _unpack(spread: int) -> tuple[int, int, int]:
    """Place, bytes back to the first string, strings less one."""
    return spread >> 20, spread >> 10 & 1023, spread & 1023


def refine(contexts: list[tuple[int, bytes, int, bool]], length: int = LENGTH, unit: int = 1) -> list[np.ndarray]:
    """Which strings of each context occur in another context of its first bucket, or in one that stands for several.

    A context is (first bucket, bytes, strings, several). The pointer of a place to its bucket is a hash made from the pointers
    of two places to buckets of half the length; the last step joins two that overlap, as `length` need be no power of two.
    """
    pointers, width = _units(b"".join(c[1] for c in contexts), unit)
    if width > length:
        pointers, width = pointers & np.uint64((1 << 8 * length) - 1), length
    pointers = common.mixed(pointers)
    while width < length:
        offset = min(width, length - width)
        pointers = common.mixed(pointers[:-offset] * _ODD + pointers[offset:])
        width += offset
    sizes = np.array([len(c[1]) // unit for c in contexts], np.int64)
    starts = np.cumsum(np.r_[0, sizes])[:-1]
    counts = np.array([c[2] for c in contexts], np.int64)
    places = np.repeat(starts, counts) + np.arange(counts.sum()) - np.repeat(np.cumsum(np.r_[0, counts])[:-1], counts)
    own, bucket = pointers[places], np.repeat(np.array([c[0] for c in contexts], np.int64), counts)
    weight = 1 + np.repeat(np.array([c[3] for c in contexts], np.int64), counts)
    order = np.lexsort((own, bucket))
    own, bucket = own[order], bucket[order]
    turns = np.flatnonzero(np.r_[True, (own[1:] != own[:-1]) | (bucket[1:] != bucket[:-1])])
    sums = np.add.reduceat(weight[order], turns)
    marks = np.empty(len(order), bool)
    marks[order] = np.repeat(sums > 1, np.diff(np.r_[turns, len(order)]))
    return np.split(marks, np.cumsum(counts)[:-1])


def _runs(marks: np.ndarray) -> list[int]:
    """Starts and ends (exclusive) of the runs of true marks, alternating."""
    return np.flatnonzero(np.diff(np.r_[False, marks, False].astype(np.int8))).tolist()


def spans(
    docs: DataFrame,
    length: int | None = None,
    gram: int | None = None,
    group: int = GROUP,
    id_col: str = "doc_id",
    text_col: str = "text",
    words: bool = False,
) -> DataFrame:
    """`k1`, `k2` (see `row_key`) and `runs`: pairs of start and end, in bytes or words, unordered and overlapping, that are repeated."""
    length, gram, unit = length or (WORDS if words else LENGTH), gram or (WORD_GRAM if words else GRAM), 8 if words else 1
    rows = docs.select(*common.row_key(id_col, text_col), F.col(text_col).cast("binary").alias("text"))
    all_anchors = common.stored(_found(rows, length, gram, unit), "anchors")
    # Written, so that the join deals its rows out anew and a frequent bucket can be split among tasks.
    shared = common.stored(all_anchors.groupBy("first").agg(F.count("*").alias("n")).where("n > 1").select("first"), "shared")
    kept = common.stored(all_anchors.join(shared, "first"), "shared-anchors")
    common.release(all_anchors, shared)

    classes = kept.groupBy("first", "a", "b").agg(
        F.count("*").alias("n"), F.min(F.struct("k1", "k2", "spread")).alias("at")
    )
    classes = common.stored(classes, "classes")
    several = common.stored(
        classes.groupBy("first").agg(F.count("*").alias("members")).where("members > 1"), "several"
    )
    open_ones = classes.join(several, "first").select("first", "a", "b", "n", "members", "at.*")
    work = open_ones.groupBy("k1", "k2").agg(
        F.collect_list(F.struct("first", "a", "b", "n", "members", "spread")).alias("work")
    )
    picked = rows.join(work, ["k1", "k2"]).select("k1", "k2", "text", "work")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["first", "a", "b", "several", "members", "strings", "context"]
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.int32(), pa.binary()]
        for batch in batches:
            for number in range(batch.num_rows):
                text = batch.column("text")[number].as_py() or b""
                units = text.split() if words else text
                out = []
                for e in batch.column("work")[number].as_py():
                    place, back, more = _unpack(e["spread"])
                    context = units[place - back : place - back + more + length]
                    context = _hashed(context) if words else context
                    out.append((e["first"], e["a"], e["b"], e["n"] > 1, e["members"], more + 1, context))
                data = list(zip(*out)) if out else [[]] * len(kinds)
                yield pa.RecordBatch.from_arrays([pa.array(d, k) for d, k in zip(data, kinds)], names)

    schema = (
        "first long, a long, b long, several boolean, members long, strings int, context binary"
    )
    contexts = common.stored(picked.mapInArrow(cut, schema).dropDuplicates(["first", "a", "b"]), "contexts")

    def together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by first bucket; complete buckets are refined, as many as make some bytes at a time."""
        held: list[tuple] = []
        size = 0

        def close() -> pa.RecordBatch:
            out = []
            if held:
                marks = refine([(first, c, n, several) for first, _, _, several, n, c in held], length, unit)
                out = [(h[0], h[1], h[2], _runs(m)) for h, m in zip(held, marks) if m.any()]
            data = list(zip(*out)) if out else [[]] * 4
            kinds = [pa.int64()] * 3 + [pa.list_(pa.int32())]
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(d, k) for d, k in zip(data, kinds)], ["first", "a", "b", "found"])

        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in columns)):
                if size > REFINED and held[-1][0] != row[0]:
                    yield close()
                    size = 0
                held.append(row)
                size += len(row[-1])
        yield close()

    columns = ["first", "a", "b", "several", "strings", "context"]
    small = contexts.where(F.col("members") <= group).select(*columns)
    ordered = small.repartition("first").sortWithinPartitions("first")
    refined = ordered.mapInArrow(together, "first long, a long, b long, found array<int>")

    def single(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["first", "a", "b", "several", "string", "x", "y"]
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.int32(), pa.int64(), pa.int64()]
        for batch in batches:
            for number in range(batch.num_rows):
                row = {c: batch.column(c)[number].as_py() for c in ("first", "a", "b", "several", "strings", "context")}
                out = [
                    (row["first"], row["a"], row["b"], row["several"], k, *_digest(row["context"][k * unit : (k + length) * unit]))
                    for k in range(row["strings"])
                ]
                yield pa.RecordBatch.from_arrays([pa.array(d, k) for d, k in zip(zip(*out), kinds)], names)

    large = contexts.where(F.col("members") > group).mapInArrow(
        single, "first long, a long, b long, several boolean, string int, x long, y long"
    )
    often = large.groupBy("x", "y").agg((F.count("*") + F.sum(F.col("several").cast("int"))).alias("n")).where("n > 1")
    dealt = (
        large.join(often, ["x", "y"])
        .groupBy("first", "a", "b")
        .agg(F.flatten(F.collect_list(F.array(F.col("string"), F.col("string") + 1))).alias("found"))
    )
    whole = classes.where("n > 1").select(
        "first", "a", "b", F.array(F.lit(0), (F.col("at.spread").bitwiseAND(1023) + 1).cast("int")).alias("found")
    )
    # A second bucket of several members is repeated as a whole, whatever refining found.
    parts = refined.union(dealt).join(whole.select("first", "a", "b"), ["first", "a", "b"], "left_anti").union(whole)
    start = F.shiftright("spread", 20) - F.shiftright("spread", 10).bitwiseAND(1023)
    marked = kept.join(parts, ["first", "a", "b"]).select(
        "k1",
        "k2",
        F.transform(
            "found", lambda at, k: start + at + F.when(k % 2 == 1, F.lit(length - 1)).otherwise(F.lit(0))
        ).alias("run"),
    )
    found = common.stored(marked.groupBy("k1", "k2").agg(F.flatten(F.collect_list("run")).alias("runs")), "runs")
    common.release(kept, classes, several, contexts)
    return found


def merged(runs: np.ndarray) -> np.ndarray:
    """Overlapping and touching runs made one; rows of start and end."""
    runs = runs.reshape(-1, 2)
    if not len(runs):
        return runs
    runs = runs[np.argsort(runs[:, 0], kind="stable")]
    reach = np.maximum.accumulate(runs[:, 1])
    opens = np.r_[True, runs[1:, 0] > reach[:-1]]
    starts = runs[opens, 0]
    ends = reach[np.r_[np.flatnonzero(opens)[1:] - 1, len(runs) - 1]]
    return np.stack([starts, ends], axis=1)


def _bytes(text: bytes, places: np.ndarray) -> np.ndarray:
    """Starts and ends of runs of words as bytes of the text."""
    edges = np.array([found.span() for found in _WORD.finditer(text)], np.int64).reshape(-1, 2)
    return np.stack([edges[places[:, 0], 0], edges[places[:, 1] - 1, 1]], axis=1)


def remove(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep: tuple[str, ...] = (),
    with_text: bool = False,
    words: bool = False,
    with_passages: bool = False,
    **how: int,
) -> DataFrame:
    """The id (and the columns in `keep`), `n_bytes`, `n_removed`, `n_spans` and `kept_sha256` of each row.

    With `words`, strings of words are removed instead of strings of bytes. With `with_passages`, also `n_passages` and `n_passage_words`: the
    runs of words that strings of `WORDS` repeated words make, though not removed, and their words. With `with_text`, also
    `spans` (start and end bytes) and `kept_text`: the bytes that remain, without the letters that a span's edge cuts in two.
    """
    names = list(dict.fromkeys([id_col, *keep]))
    rows = docs.select(
        *common.row_key(id_col, text_col), F.struct(*names).alias("row"), F.col(text_col).cast("binary").alias("text")
    )
    found = spans(docs, id_col=id_col, text_col=text_col, words=words, **how)
    if with_passages:
        found = found.join(
            spans(docs, id_col=id_col, text_col=text_col, words=True).withColumnRenamed("runs", "passages"), ["k1", "k2"], "full"
        )
    joined = rows.join(found, ["k1", "k2"], "left").drop("k1", "k2")
    added = ["n_bytes long", "n_removed long", "n_spans long", "kept_sha256 string"]
    added += ["n_passages long", "n_passage_words long"] if with_passages else []
    added += ["spans array<long>", "kept_text string"] if with_text else []
    kinds = {"long": pa.int64(), "string": pa.string(), "array<long>": pa.list_(pa.int64())}

    def runs_of(column: pa.Array, number: int) -> np.ndarray:
        own = column[number].values
        return np.zeros((0, 2), np.int64) if own is None else merged(own.to_numpy(zero_copy_only=False))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in common.slices(batch, "text"):
                out = []
                for number, text in enumerate(common.bytes_of(part, "text")):
                    places = runs_of(part.column("runs"), number)
                    if words and len(places):
                        places = _bytes(text, places)
                    left, at = [], 0
                    for start, end in places.tolist():
                        left.append(text[at:start])
                        at = end
                    rest = b"".join([*left, text[at:]])
                    row = [len(text), len(text) - len(rest), len(places), hashlib.sha256(rest).hexdigest()]
                    if with_passages:
                        passages = runs_of(part.column("passages"), number)
                        row += [len(passages), int((passages[:, 1] - passages[:, 0]).sum())]
                    if with_text:
                        pieces = [piece.decode(errors="ignore") for piece in (*left, text[at:])]
                        row += [places.ravel().tolist(), "".join(pieces)]
                    out.append(row)
                columns = [pa.array(d, kinds[a.split()[1]]) for d, a in zip(zip(*out), added)]
                yield pa.RecordBatch.from_arrays(
                    [part.column("row"), *columns], ["row", *(a.split()[0] for a in added)]
                )

    kind = rows.schema["row"].dataType.simpleString()
    counted = joined.mapInArrow(run, f"row {kind}, " + ", ".join(added))
    return counted.select(*(F.col(f"row.`{n}`").alias(n) for n in names), *(a.split()[0] for a in added))
