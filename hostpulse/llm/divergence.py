"""Source divergence audit: how far the word counts of sources of one language lie apart, by hash-consed segment trees.

- Terms are runs of ASCII letters (A-Z lower-cased) and of all characters from U+0080 on. A language keeps the terms that
  stand in `LEAST_DOCS` of its rows or more. Kept terms get ids: a block, by hash, of about `BLOCK` terms, and a place in it.
- A group's counts in a block are the leaves of a segment tree. Trees are hash-consed: from the leaves up, equal counts, then equal pairs
  of children, are one node, whichever group and place they stand in; so all stretches without occurrences of one length are one node.
- Two trees are walked down together. At each level the equal pairs of nodes of a pair of groups are one, with the number of times it occurs, so
  each is priced once; at the leaves a pair of counts is priced by integers and added as often as it occurs.
- Groups are cut into tiles of `TILE`. A cell is a block and two tiles, so no task holds more than 2 `TILE` groups of one block, however many
  sources or terms there are. What cells yield is added up by Spark.

Null text, language and source count as ''. Every row counts as a document, repeated ones too. A group without terms is priced with counts
of 0; a language that keeps no term has value 0 between its sources and no `term` rows. An empty table gives an empty
result. Other columns are ignored. Very long texts are cut in pieces at separators, so nothing but the piece's words is held.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hostpulse.llm.common import SLICE_BYTES, bytes_of, release, stored

#: Rows of a language that a kept term stands in.
LEAST_DOCS = 10
#: Terms that a block has on average, and groups that a tile has at most.
BLOCK = 1800
TILE = 32
#: Shares that a language's rows are dealt out in.
SALTS = 64
#: Parts per unit that shares are counted in, and what is added to each count.
UNIT = 1_000_000_000
ADDED = 2
#: Best terms reported for each group.
TERMS = 10
#: Entries that a task counts before it passes them on.
ENTRIES = 300_000

#: Lower-cases A-Z and makes a blank of every ASCII character that is no letter. Bytes from 0x80 on belong to terms.
_LETTERS = bytes(b if b >= 0x80 or 97 <= b <= 122 else b + 32 if 65 <= b <= 90 else 32 for b in range(256))

#: What `bytes.split` cuts at after `_LETTERS`.
_BLANK = b" "


def _pieces(text: bytes) -> Iterator[bytes]:
    """The translated text, cut at blanks into pieces of about `SLICE_BYTES`; a longer term stays whole."""
    start = 0
    while len(text) - start > SLICE_BYTES:
        end = text.find(_BLANK, start + SLICE_BYTES)
        if end < 0:
            break
        yield text[start:end]
        start = end
    yield text[start:] if start else text


def counted(docs: DataFrame, lang: str = "lang", source: str = "source", text: str = "text") -> DataFrame:
    """`lang`, `source`, `term`, `n` occurrences and the `docs` that hold it; a null term for each group, with its rows."""
    rows = docs.select(
        F.coalesce(F.col(lang), F.lit("")).alias("lang"),
        F.coalesce(F.col(source), F.lit("")).alias("source"),
        F.col(text).alias("text"),
    )

    def batch_of(times: dict, places: dict, seen: Counter) -> pa.RecordBatch:
        columns = [[], [], [], [], []]
        for group, terms in times.items():
            found = places[group]
            columns[0] += [group[0]] * len(terms)
            columns[1] += [group[1]] * len(terms)
            columns[2] += terms.keys()
            columns[3] += terms.values()
            columns[4] += map(found.__getitem__, terms)
        for group, number in seen.items():
            for column, value in zip(columns, (*group, None, 0, number)):
                column.append(value)
        kinds = (pa.string(), pa.string(), pa.binary(), pa.int64(), pa.int64())
        arrays = [pa.array(values, kind) for values, kind in zip(columns, kinds)]
        arrays[2] = arrays[2].cast(pa.string())
        return pa.record_batch(arrays, names=["lang", "source", "term", "n", "docs"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        times, places, seen, held = {}, {}, Counter(), 0
        for batch in batches:
            groups = zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist())
            for group, text in zip(groups, bytes_of(batch)):
                seen[group] += 1
                here, found = times.setdefault(group, Counter()), places.setdefault(group, Counter())
                before, distinct = len(here), set()
                for piece in _pieces(text.translate(_LETTERS)):
                    words = piece.split()
                    here.update(words)
                    distinct.update(words)
                found.update(distinct)
                held += len(here) - before
                if held > ENTRIES:
                    yield batch_of(times, places, seen)
                    times, places, seen, held = {}, {}, Counter(), 0
        yield batch_of(times, places, seen)

    # Tasks have counted their own rows; Spark's partial sums merge what a task passed on in several parts.
    parts = rows.mapInArrow(count, "lang string, source string, term string, n bigint, docs bigint")
    return parts.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def _spread(large: DataFrame, by: Column, small: DataFrame) -> DataFrame:
    """Joins on the language, which may hold a third of all rows, with `small` copied for each of `SALTS` shares of `large`."""
    shares = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
    salted = large.withColumn("salt", F.pmod(by, F.lit(SALTS)).cast("int"))
    return salted.join(small.withColumn("salt", shares), ["lang", "salt"]).drop("salt")


def _numbered(counts: DataFrame, least_docs: int) -> DataFrame:
    """Kept terms: `lang`, `term`, `total` occurrences, `block` and `place` in it, `width` of the block, `v` terms of the language."""
    terms = counts.where(F.col("term").isNotNull()).groupBy("lang", "term")
    terms = terms.agg(F.sum("docs").alias("docs"), F.sum("n").alias("total")).where(F.col("docs") >= least_docs).drop("docs")
    sizes = terms.groupBy("lang").agg(F.count(F.lit(1)).alias("v"))
    block = F.pmod(F.xxhash64("term"), F.ceil(F.col("v") / BLOCK).cast("bigint")).alias("block")
    rows = _spread(terms, F.xxhash64("term"), sizes).select("lang", "term", "total", "v", block)
    # A window holds one block.
    inside = Window.partitionBy("lang", "block")
    place = (F.row_number().over(inside.orderBy("term")) - 1).alias("place")
    return rows.select("*", place, F.count(F.lit(1)).over(inside).cast("int").alias("width"))


def shares(counts: list[int], total: int, v: int) -> list[int]:
    """Smoothed shares in billionths, never 0."""
    return [1 + UNIT * (count + ADDED) // (total + ADDED * v) for count in counts]


def price(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """floor((p - q)^2 / (p + q)); shares are at most a billion and one, so squares stay within 64 bits."""
    return (p - q) ** 2 // (p + q)


class Forest:
    """Hash-consed segment trees over the rows of a matrix of leaf numbers: equal subtrees are one node."""

    def __init__(self, leaves: np.ndarray):
        self.levels = []  # of each level above the leaves: the left and the right child of every node
        nodes = leaves.astype(np.int64)
        while nodes.shape[1] > 1:
            base = int(nodes.max(initial=0)) + 1
            pairs, nodes_of = np.unique(nodes[:, 0::2] * base + nodes[:, 1::2], return_inverse=True)
            nodes = nodes_of.reshape(len(leaves), -1)
            self.levels.append((pairs // base, pairs % base))
        self.roots = nodes[:, 0]

    def walk(self, first: np.ndarray, second: np.ndarray):
        """Walks down the trees of rows `first[i]` and `second[i]` together: walk, leaf, leaf, and how often they meet.

        At every level a pair of nodes that a walk meets again is the same entry, with a larger number of times.
        """
        walks, a, b = np.arange(len(first)), self.roots[first], self.roots[second]
        times = np.ones(len(first), np.int64)
        for left, right in reversed(self.levels):
            walks, times = np.tile(walks, 2), np.tile(times, 2)
            a, b = np.concatenate([left[a], right[a]]), np.concatenate([left[b], right[b]])
            base_a, base_b = int(a.max(initial=0)) + 1, int(b.max(initial=0)) + 1
            codes, place = np.unique((walks * base_a + a) * base_b + b, return_inverse=True)
            times = np.bincount(place, times, len(codes)).astype(np.int64)
            codes, b = np.divmod(codes, base_b)
            walks, a = np.divmod(codes, base_a)
        return walks, a, b, times


def _matrix(rows: list[dict], width: int) -> np.ndarray:
    """Counts of each row's group by place, as wide as a whole tree; -1 where the block has no term."""
    size = 1 << max(0, (width - 1).bit_length())
    matrix = np.zeros((len(rows), size), np.int64)
    for number, row in enumerate(rows):
        if row["places"] is not None:
            matrix[number, np.asarray(row["places"], np.int64)] = row["counts"]
    matrix[:, width:] = -1
    return matrix


def _cell(rows: list[dict], low: int, high: int):
    """Prices of one block between the groups of two tiles: `(first, second, value)` of each pair, and, if the tiles are one, the
    best `(group, place, value)` of each group against the whole language, whose row has the number -1."""
    v, width = rows[0]["v"], rows[0]["width"]
    matrix = _matrix(rows, width)
    values, leaves = np.unique(matrix, return_inverse=True)
    leaves = leaves.reshape(matrix.shape)
    forest = Forest(leaves)
    real = values >= 0
    p = np.ones((len(rows), len(values)), np.int64)
    for number, row in enumerate(rows):
        p[number, real] = shares(values[real].tolist(), row["total"], v)

    def priced(first: np.ndarray, second: np.ndarray):
        walks, a, b, times = forest.walk(first, second)
        p_a, p_b = p[first[walks], a], p[second[walks], b]
        return walks, a, b, times, np.where(real[a], price(p_a, p_b), 0), p_a > p_b

    numbers = np.array([row["number"] for row in rows])
    tiles = np.where(numbers < 0, -1, numbers // TILE)
    own = np.flatnonzero(tiles == low)
    if low == high:
        first, second = (own[side] for side in np.triu_indices(len(own), 1))
    else:
        other = np.flatnonzero(tiles == high)
        first, second = np.repeat(own, len(other)), np.tile(other, len(own))
    pairs, best = [], []
    if len(first):
        walks, _, _, times, value, _ = priced(first, second)
        sums = np.zeros(len(first), np.int64)
        np.add.at(sums, walks, times * value)
        a, b = np.minimum(numbers[first], numbers[second]), np.maximum(numbers[first], numbers[second])
        pairs = list(zip(a.tolist(), b.tolist(), sums.tolist()))
    whole = np.flatnonzero(numbers < 0)
    if len(whole) and len(own):
        walks, a, b, _, value, above = priced(own, np.repeat(whole, len(own)))
        value = np.where(above & real[a] & (values[a] > 0), value, -1)
        codes = (walks * len(values) + a) * len(values) + b
        for number, row in enumerate(own.tolist()):
            wanted = (number * len(values) + leaves[row, :width]) * len(values) + leaves[whole[0], :width]
            found = value[np.searchsorted(codes, wanted)]
            order = np.argsort(-found, kind="stable")[:TERMS]
            best += [(int(numbers[row]), place, int(found[place])) for place in order.tolist() if found[place] >= 0]
    return pairs, best


def _cells(groups: DataFrame, kept: DataFrame, own: DataFrame) -> DataFrame:
    """A row for each group and block and cell that it takes part in, with the group's counts in the block."""
    blocks = kept.groupBy("lang", "block").agg(
        F.first("width").alias("width"), F.first("v").alias("v"), F.collect_list(F.struct("place", "total")).alias("entries")
    )
    lists = own.groupBy("lang", "block", "source").agg(F.collect_list(F.struct("place", "n")).alias("entries"))
    tiles = groups.groupBy("lang").agg(
        (F.floor(F.max("number") / TILE) + 1).cast("int").alias("tiles"), F.sum("total").alias("total")
    )
    tile, facts = F.floor(F.col("number") / TILE).cast("int"), ("lang", "block", "number", "total", "width", "v")
    sources = (
        _spread(blocks.drop("entries"), F.col("block"), groups.join(tiles.drop("total"), "lang"))
        .join(lists, ["lang", "block", "source"], "left")
        .select(*facts, F.col("entries.place").alias("places"), F.col("entries.n").alias("counts"), tile.alias("tile"),
                F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("other"))
    )
    whole = blocks.join(tiles, "lang").select(
        *(name if name != "number" else F.lit(-1).alias(name) for name in facts),
        F.col("entries.place").alias("places"),
        F.col("entries.total").alias("counts"),
        F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("tile"),
    )
    rows = sources.unionByName(whole.withColumn("other", F.col("tile")))
    ends = F.least("tile", "other").alias("low"), F.greatest("tile", "other").alias("high")
    return rows.select(*facts, "places", "counts", *ends)


def _prices(cells: DataFrame) -> DataFrame:
    """`lang`, `block`, `kind` 0 with the numbers of two groups or 1 with a group's number and a place, and `value`."""

    def work(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        pairs, best = _cell(rows, rows[0]["low"], rows[0]["high"])
        found = [(0, *pair) for pair in pairs] + [(1, *one) for one in best]
        columns = list(zip(*found)) if found else [(), (), (), ()]
        kinds = (pa.int32(), pa.int32(), pa.int32(), pa.int64())
        arrays = [pa.array([rows[0][name]] * len(found), kind) for name, kind in (("lang", pa.string()), ("block", pa.int64()))]
        arrays += [pa.array(column, kind) for column, kind in zip(columns, kinds)]
        return pa.Table.from_arrays(arrays, names=["lang", "block", "kind", "a", "b", "value"])

    schema = "lang string, block bigint, kind int, a int, b int, value bigint"
    return cells.groupBy("lang", "block", "low", "high").applyInArrow(work, schema)


def audit(docs: DataFrame, lang: str = "lang", source: str = "source", text: str = "text", least_docs: int = LEAST_DOCS) -> DataFrame:
    """`lang`, `source`, `part`, `item`, `value` and `rank`: distances to the other sources, and the terms a source has most above its language."""
    counts = stored(counted(docs, lang, source, text), "counts")
    kept = stored(_numbered(counts, least_docs), "terms")
    own = counts.where("term IS NOT NULL").join(kept.drop("total"), ["lang", "term"]).select("lang", "source", "block", "place", "n")
    totals = own.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    number = (F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1).alias("number")
    groups = (
        counts.where("term IS NULL")
        .select("lang", "source", number)
        .join(totals, ["lang", "source"], "left")
        .select("lang", "source", "number", F.coalesce("total", F.lit(0)).alias("total"))
    )
    groups = stored(groups, "groups")
    prices = stored(_prices(_cells(groups, kept, own)), "prices")
    release(counts)

    names = groups.select("lang", "source", "number")
    others = names.select("lang", F.col("source").alias("item"), F.col("number").alias("other"))
    sums = prices.where("kind = 0").groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    pairs = (
        _spread(names, F.col("number"), others)
        .where("number <> other")
        .select("lang", "source", "item", F.least("number", "other").alias("a"), F.greatest("number", "other").alias("b"))
        .join(sums, ["lang", "a", "b"], "left")
        .select("lang", "source", F.lit("pair").alias("part"), "item", F.coalesce("value", F.lit(0)).alias("value"))
    )
    best = (
        prices.where("kind = 1")
        .select("lang", "block", F.col("a").alias("number"), F.col("b").alias("place"), "value")
        .join(kept.select("lang", "block", "place", F.col("term").alias("item")), ["lang", "block", "place"])
        .join(names, ["lang", "number"])
        .select("lang", "source", F.lit("term").alias("part"), "item", "value")
    )
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    rank = F.row_number().over(order).alias("rank")
    return pairs.select("*", rank).unionByName(best.select("*", rank).where(F.col("rank") <= TERMS))
