"""The nearest rows to one or many query vectors by cosine similarity, exactly.

Every task keeps the best k of its rows for each query and passes on only those, so no pair of query and
row leaves the task that made it.
"""

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import remove_dir, shared_dir

# Query vectors go to every task as long as they take no more than this.
MAX_QUERY_BYTES = 32 << 20
# More than rounding can move a similarity of unit vectors.
MARGIN = 1e-9
# Decimals that rows rank by: all that a sum of products in double precision can be trusted in.
RANK_DIGITS = 12
# Rows are scored in groups of about this size: each group costs a merge per query.
SCORED_BYTES = 16 << 20
# Tasks whose best rows are merged before the query's: no task gets more than k rows of each of so many.
MERGED_TASKS = 64


def _matrix(vectors: pa.Array, dims: int) -> np.ndarray:
    """Unit rows of a list array whose lists all have `dims` elements. Null gives NaN."""
    flat = vectors.flatten().to_numpy(zero_copy_only=False)
    rows = np.asarray(flat, dtype=np.float64).reshape(-1, dims)
    with np.errstate(invalid="ignore", divide="ignore"):
        return rows / np.linalg.norm(rows, axis=1, keepdims=True)


class _Best:
    """The best k rows seen so far for each query of a block."""

    def __init__(self, unit_queries: np.ndarray, k: int, ties: list[str], vector: str, digits: int):
        self.queries = unit_queries
        self.k = k
        self.ties = ties
        self.vector = vector
        self.digits = digits
        self.order = [("similarity", "descending"), *[(name, "ascending") for name in ties]]
        self.rows: list[pa.Table | None] = [None] * len(unit_queries)
        self.floor = np.full(len(unit_queries), -np.inf)
        self.waiting: list[pa.Table] = []
        self.units = np.empty((0, unit_queries.shape[1]))
        self.filled = 0
        self.group = max(1, SCORED_BYTES // (8 * unit_queries.shape[1]))

    def add(self, rows: pa.Table) -> None:
        """Only unit rows and ids wait for their group, and in one copy: a batch is let go as soon as it is read."""
        dims = self.queries.shape[1]
        end = self.filled + len(rows)
        if end > len(self.units):
            units = np.empty((self.group + len(rows), dims))
            units[: self.filled] = self.units[: self.filled]
            self.units = units
        self.units[self.filled : end] = _matrix(rows.column(self.vector).combine_chunks(), dims)
        self.filled = end
        # Taken, since columns of a batch share one buffer and ids by reference would hold its vectors.
        self.waiting.append(rows.select(self.ties).take(pa.array(np.arange(len(rows)))))
        if self.filled >= self.group:
            self._score()

    def _score(self) -> None:
        waiting, self.waiting = self.waiting, []
        units, self.filled = self.units[: self.filled], 0
        if not len(units) or not len(self.queries):
            return
        ties = pa.concat_tables(waiting).combine_chunks()
        # A million similarities at a time, whatever the number of queries.
        step = max(1, 1_000_000 // len(units))
        for start in range(0, len(self.queries), step):
            scores = self.queries[start : start + step] @ units.T
            scores[np.isnan(scores)] = -np.inf
            top = scores.max(axis=1)
            promising = (top >= self.floor[start : start + step] - MARGIN) & (top > -np.inf)
            for offset in np.flatnonzero(promising).tolist():
                self._offer(start + offset, scores[offset], units, ties)

    def _offer(self, query: int, scores: np.ndarray, units: np.ndarray, ties: pa.Table) -> None:
        # The last bits of a matrix product depend on its shape. So it only picks candidates, with a margin, and
        # their similarity is added up again in the order of the dimensions.
        chosen = np.flatnonzero((scores >= self.floor[query] - MARGIN) & (scores > -np.inf))
        if len(chosen) > 4 * self.k:
            good = scores[chosen]
            chosen = chosen[good >= np.partition(good, -self.k)[-self.k] - MARGIN]
        exact = np.zeros(len(chosen))
        for number, weight in enumerate(self.queries[query]):
            exact += weight * units[chosen, number]
        new = ties.take(pa.array(chosen)).append_column("similarity", pa.array(np.round(exact, RANK_DIGITS) + 0.0))
        old = self.rows[query]
        both = new if old is None else pa.concat_tables([old, new])
        best = both.take(pc.sort_indices(both, sort_keys=self.order)[: self.k])
        self.rows[query] = best.combine_chunks()
        if len(best) == self.k:
            self.floor[query] = best.column("similarity")[-1].as_py()

    def results(self, query_ids: pa.Array, query_id: str) -> Iterator[pa.RecordBatch]:
        self._score()
        for number, rows in enumerate(self.rows):
            if rows is not None:
                ids = pa.array([query_ids[number].as_py()] * len(rows), query_ids.type)
                yield from rows.append_column(query_id, ids).select(
                    [query_id, *self.ties, "similarity"]
                ).to_batches()


def _made_once(rows: DataFrame, vector: str) -> DataFrame:
    """The vector generated rather than projected.

    A filter on a projected vector moves below the projection, and the encoder runs once more there.
    """
    return rows.withColumn(vector, F.explode(F.array(vector)))


def width_of(rows: DataFrame, vector: str) -> int | None:
    """Width of the vectors, read from one of them; None if there is none. `nearest` checks the others as it reads them."""
    first = rows.where(F.col(vector).isNotNull()).select(F.size(vector).alias("width")).first()
    return first.width if first else None


def _query_width(queries: DataFrame, query_vector: str) -> int | None:
    """Width of the query vectors. Different ones are an error, since no row could be compared with all of them."""
    found = queries.where(F.col(query_vector).isNotNull()).agg(
        F.min(F.size(query_vector)).alias("least"), F.max(F.size(query_vector)).alias("most")
    ).first()
    if found.least != found.most:
        raise ValueError(f"query vectors are {found.least} to {found.most} wide")
    return found.most


def nearest(
    vectors: DataFrame,
    queries: DataFrame,
    k: int,
    dims: int | None = None,
    *,
    id_cols: list[str],
    vector: str = "embedding",
    query_id: str = "query_id",
    query_vector: str = "query_vector",
    digits: int = 6,
    max_query_bytes: int = MAX_QUERY_BYTES,
    audit: str | Observation | None = None,
    strict: bool = False,
) -> DataFrame:
    """`query_id`, `id_cols`, `similarity` and `rank` of the k best rows of `vectors` per query.

    Rows rank by their similarity to `RANK_DIGITS` decimals, beyond which lie only errors of
    summation; equal ones rank by `id_cols`, which have to name a row; only the output is rounded to `digits`. So the result does
    not depend on how the rows are spread.

    The width is that of the queries, unless `dims` names one that only a part of them has. Vectors of another width, of length
    zero or with nulls have no similarity and no rank. `audit` counts all rows and those without a similarity, by cause, as an observation;
    with `strict` a vector of another width is an error.

    Queries that take no more than `max_query_bytes` go to every task in one pass over the vectors, more of them in as many passes
    as they fill. Vectors are never shuffled. What the tasks pass on is merged for each query in two steps, by groups of tasks first.
    """
    vectors, queries = _made_once(vectors, vector), _made_once(queries, query_vector)
    if dims is None:
        dims = _query_width(queries, query_vector) or 0
    usable = queries.where(F.size(query_vector) == dims).select(query_id, query_vector)
    rows = _compared(vectors, dims, id_cols, vector, audit, strict)
    schema = T.StructType(
        [
            usable.schema[query_id],
            *[rows.schema[name] for name in id_cols],
            T.StructField("similarity", T.DoubleType()),
            T.StructField("_tasks", T.IntegerType(), False),
        ]
    )

    def passing(block: pa.Table) -> DataFrame:
        return _one_pass(rows, block, schema, k, dims, id_cols, vector, query_id, digits)

    # The limit bounds what reaches the driver; one row above it shows that there are too many.
    most = max(1, max_query_bytes // (8 * max(dims, 1)))
    head = usable.limit(most + 1).toArrow()
    if not head.num_rows:
        candidates = rows.sparkSession.createDataFrame([], schema)
    elif head.num_rows <= most and (head.nbytes <= max_query_bytes or head.num_rows <= 1):
        candidates = passing(head)
    else:
        candidates = _in_passes(usable, passing, schema, head, max_query_bytes)
    order = [F.desc("similarity"), *id_cols]
    for group in ([query_id, "_tasks"], [query_id]):
        rank = F.row_number().over(Window.partitionBy(*group).orderBy(*order))
        candidates = candidates.withColumn("rank", rank).where(F.col("rank") <= k)
    return candidates.select(query_id, *id_cols, (F.round("similarity", digits) + F.lit(0.0)).alias("similarity"), "rank")


def _compared(vectors: DataFrame, dims: int, id_cols: list[str], vector: str, audit, strict: bool) -> DataFrame:
    """Ids and vectors of the right width; the others are counted, or end the job."""
    size = F.size(vector)
    if strict:
        problem = F.concat(F.lit("a vector is "), size.cast("string"), F.lit(f" wide, the queries {dims}"))
        vectors = vectors.withColumn(vector, F.when(size != dims, F.raise_error(problem)).otherwise(F.col(vector)))
    if audit is not None:
        square = F.aggregate(vector, F.lit(0.0), lambda total, x: total + x.cast("double") * x.cast("double"))
        right = size == dims
        vectors = vectors.observe(
            audit,
            F.count(F.lit(1)).alias("rows"),
            F.count_if(F.col(vector).isNull()).alias("without_vector"),
            F.count_if(size != dims).alias("other_width"),
            F.count_if(right & (square.isNull() | F.isnan(square) | (square == float("inf")))).alias("without_number"),
            F.count_if(right & (square == 0)).alias("without_length"),
        )
    return vectors.where(size == dims).select(*id_cols, vector)


def _one_pass(rows, block, schema, k, dims, id_cols, vector, query_id, digits) -> DataFrame:
    """All queries of a block to every task; the best rows of each task for each query."""
    ids = block.column(0).combine_chunks()
    units = _matrix(block.column(1).combine_chunks(), dims)
    shared = rows.sparkSession.sparkContext.broadcast((ids, units))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, units = shared.value
        best = _Best(units, k, id_cols, vector, digits)
        group = TaskContext.get().partitionId() // MERGED_TASKS
        for batch in batches:
            best.add(pa.Table.from_batches([batch]))
        for found in best.results(ids, query_id):
            yield found.append_column("_tasks", pa.array([group] * found.num_rows, pa.int32()))

    return rows.mapInArrow(search, schema)


def _in_passes(usable: DataFrame, passing: Callable, schema: T.StructType, head: pa.Table, limit: int) -> DataFrame:
    """A pass over the vectors for each block of queries. The driver holds one block, and the best rows are written down."""
    spark = usable.sparkSession
    asked, found = shared_dir(spark, "queries"), shared_dir(spark, "nearest")
    usable.withColumn("_row", F.monotonically_increasing_id()).write.parquet(asked)
    stored = spark.read.parquet(asked)
    blocks = math.ceil(stored.count() * head.nbytes / head.num_rows / limit)
    for number in range(blocks):
        block = stored.where(F.pmod(F.xxhash64("_row"), F.lit(blocks)) == number).drop("_row").toArrow()
        # A hash does not fill the blocks evenly, and ids may be of any length.
        step = max(1, min(block.num_rows, int(block.num_rows * limit / max(block.nbytes, 1))))
        for start in range(0, block.num_rows, step):
            passing(block.slice(start, step)).write.mode("append").parquet(found)
    remove_dir(spark, asked)
    return spark.read.schema(schema).parquet(found)
