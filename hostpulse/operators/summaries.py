"""Five-second figures and ingest lag.

All group-bys combine on the map side first, so a window, category or value that holds most of the
rows still costs one row per task in the shuffle.
"""

from collections.abc import Iterator, Sequence
from decimal import Decimal
from fractions import Fraction
from functools import reduce
from operator import and_

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.times import lag_micros

#: Values that this type holds as they are get added up exactly, in whatever order tasks deliver them.
EXACT = "decimal(28,9)"


def _held(value: str) -> tuple[Column, Column]:
    """The value as `EXACT`, and how many of a group that type cannot hold."""
    held = F.col(value).try_cast(EXACT)
    same = F.coalesce(held.cast("double") == F.col(value), F.lit(False))
    return held, F.count_if(F.col(value).isNotNull() & ~same)


def _mean(value: str) -> Column:
    """Mean of all values. Where a group has one that `EXACT` cannot hold, the whole group is averaged in floating point."""
    held, misfits = _held(value)
    exact = F.try_sum(held).cast("double") / F.count(F.col(value))
    return F.when(misfits == 0, F.coalesce(exact, F.avg(value))).otherwise(F.avg(value))


def metrics_by_window(rows: DataFrame, width: str = "5 seconds", time: str = "at") -> DataFrame:
    """CPU and memory per tumbling window."""
    return (
        rows.groupBy(F.window(time, width))
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.min("cpu_percent").alias("min_cpu"),
            F.max("cpu_percent").alias("max_cpu"),
            _mean("cpu_percent").alias("avg_cpu"),
            F.max("percent_memory").alias("max_memory"),
            _mean("percent_memory").alias("avg_memory"),
            F.min("available_memory").alias("min_available"),
        )
        .select(
            F.col("window.start").alias("window_start"),
            "n",
            "min_cpu",
            "max_cpu",
            "avg_cpu",
            "max_memory",
            "avg_memory",
            "min_available",
        )
    )


def logs_by_window(rows: DataFrame, width: str = "5 seconds", time: str = "at") -> DataFrame:
    """Number of logs per tumbling window and category."""
    return (
        rows.groupBy(F.window(time, width), "category")
        .agg(F.count(F.lit(1)).alias("n"))
        .select(F.col("window.start").alias("window_start"), "category", "n")
    )


def _start(time: str, seconds: int) -> Column:
    """Start of the window; null, unlike with `window`, for rows without a time."""
    micros = F.unix_micros(F.col(time))
    return F.timestamp_micros(micros - F.pmod(micros, F.lit(seconds * 1_000_000))).alias("window_start")


def _mean_parts(value: str, name: str) -> list[Column]:
    held, misfits = _held(value)
    return [
        F.count(value).alias(f"{name}_count"),
        F.try_sum(held).alias(f"{name}_exact"),
        F.sum(value).alias(f"{name}_sum"),
        misfits.alias(f"{name}_misfits"),
    ]


def _mean_of_parts(name: str) -> Column:
    """The same mean as `_mean`: a part that has values but no exact sum makes it a floating one."""
    count, exact, total, misfits = (F.col(f"{name}_{part}") for part in ("count", "exact", "sum", "misfits"))
    inexact = F.count_if((misfits > 0) | ((count > 0) & exact.isNull()))
    plain = F.try_divide(F.sum(total), F.sum(count))
    added = F.try_divide(F.try_sum(exact).cast("double"), F.sum(count))
    return F.when(inexact == 0, F.coalesce(added, plain)).otherwise(plain)


def metric_parts(rows: DataFrame, seconds: int = 5, time: str = "at", also: Sequence[str] = ()) -> DataFrame:
    """What a batch adds to `merged_metrics`. Rows without a time are kept, under a window of null. `also`: further groups."""
    return rows.groupBy(_start(time, seconds), *also).agg(
        F.count(F.lit(1)).alias("n"),
        F.min("cpu_percent").alias("min_cpu"),
        F.max("cpu_percent").alias("max_cpu"),
        *_mean_parts("cpu_percent", "cpu"),
        F.max("percent_memory").alias("max_memory"),
        *_mean_parts("percent_memory", "memory"),
        F.min("available_memory").alias("min_available"),
    )


def log_parts(rows: DataFrame, seconds: int = 5, time: str = "at", also: Sequence[str] = ()) -> DataFrame:
    return rows.groupBy(_start(time, seconds), "category", *also).agg(F.count(F.lit(1)).alias("n"))


def merged_metrics(parts: DataFrame) -> DataFrame:
    """The columns of `metrics_by_window` from the parts of any number of batches, in any order."""
    return parts.groupBy("window_start").agg(
        F.sum("n").alias("n"),
        F.min("min_cpu").alias("min_cpu"),
        F.max("max_cpu").alias("max_cpu"),
        _mean_of_parts("cpu").alias("avg_cpu"),
        F.max("max_memory").alias("max_memory"),
        _mean_of_parts("memory").alias("avg_memory"),
        F.min("min_available").alias("min_available"),
    )


def _added_mean(name: str) -> list[Column]:
    """Parts of a mean from such parts. Once a part has values but no exact sum, their sum has none either."""
    count, exact, total, misfits = (F.col(f"{name}_{part}") for part in ("count", "exact", "sum", "misfits"))
    without = F.count_if((count > 0) & exact.isNull())
    return [
        F.sum(count).alias(f"{name}_count"),
        F.when(without == 0, F.try_sum(exact)).cast("decimal(38,9)").alias(f"{name}_exact"),
        F.sum(total).alias(f"{name}_sum"),
        F.sum(misfits).alias(f"{name}_misfits"),
    ]


def added_metric_parts(parts: DataFrame) -> DataFrame:
    """Fewer parts with the same `merged_metrics`."""
    return parts.groupBy("window_start").agg(
        F.sum("n").alias("n"),
        F.min("min_cpu").alias("min_cpu"),
        F.max("max_cpu").alias("max_cpu"),
        *_added_mean("cpu"),
        F.max("max_memory").alias("max_memory"),
        *_added_mean("memory"),
        F.min("min_available").alias("min_available"),
    )


def added_log_parts(parts: DataFrame) -> DataFrame:
    return parts.groupBy("window_start", "category").agg(F.sum("n").alias("n"))


def merged_logs(parts: DataFrame) -> DataFrame:
    return parts.groupBy("window_start", "category").agg(F.sum("n").alias("n"))


def streamed(rows: DataFrame, delay: str, time: str = "at") -> DataFrame:
    """Rows with a watermark: windows close `delay` after the newest time seen, later rows are lost."""
    return rows.withWatermark(time, delay)


def percentiles(
    rows: DataFrame,
    by: list[str],
    value: str,
    points: Sequence[str],
    parts: int | None = None,
    missing: str | None = None,
) -> DataFrame:
    """Exact percentiles of a whole-number column, as columns `p<point>`, plus n, min, max and mean.

    Spark's `percentile` holds all values of a group in one task. Here equal values are counted
    first, and the counts are dealt out in ranges of group and value. A group that lies within one of the `parts`
    ranges is finished there. At most two groups of a range go beyond it: of those only the number of rows in each range is
    added up, which shows in which range each wanted rank lies and how many rows of the group come before it.

    `points` are decimal texts, so that a rank such as 95 % of 2000 is not moved by binary fractions.
    The value at rank ceil(point * n) is taken, without interpolation. With `missing`, a column of
    that name counts the nulls, and groups that have nothing else stay; without, nulls are left out.
    """
    parts = parts or int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counts = rows.groupBy(*by, F.col(value).cast("bigint").alias("_at")).agg(F.count(F.lit(1)).alias("_n"))
    # A fixed number of ranges: both uses below have to see the same ones.
    placed = (
        counts.repartitionByRange(parts, *by, "_at")
        .sortWithinPartitions(*by, "_at")
        .withColumn("_part", F.spark_partition_id())
    )
    keys = [placed.schema[name] for name in by]
    part = [T.StructField("_part", T.IntegerType())]
    figures = [T.StructField(name, T.LongType()) for name in ("_n", "_missing", "_min", "_max")]
    figures.append(T.StructField("_total", T.DecimalType(38, 0)))
    ends = placed.mapInArrow(_range_ends(by), T.StructType(keys + part + figures))
    found = [T.StructField("_point", T.StringType()), T.StructField("_at", T.LongType()), T.StructField("_upto", T.LongType())]
    inside = placed.mapInArrow(_range_ranks(by, tuple(points)), T.StructType(keys + part + found + figures))

    group = Window.partitionBy(*by)
    before = F.coalesce(F.sum("_n").over(group.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    whole = [how(name).over(group).alias(name) for name, how in _ADDED.items()]
    ranks = [
        F.struct(F.lit(point).alias("point"), F.greatest(_rank(F.col("_n"), point), F.lit(1)).alias("rank"))
        for point in points
    ]
    nothing = F.array(F.struct(F.lit("").alias("point"), F.lit(0).cast("bigint").alias("rank")))
    wanted = (
        ends.select(*by, "_part", before.alias("_before"), F.col("_n").alias("_here"), *whole)
        .select("*", F.inline(F.when(F.col("_n") > 0, F.array(*ranks)).otherwise(nothing)).alias("_wanted", "_rank"))
        .withColumn("_rank", F.col("_rank") - F.col("_before"))
        .where((F.col("_n") == 0) | F.col("_rank").between(F.lit(1), F.col("_here")))
        .select(*[F.col(name).alias(f"_by_{name}") for name in by], F.col("_part").alias("_in"), "_wanted", "_rank",
                *[F.col(name).alias(f"_all{name}") for name in _ADDED])
    )
    # Bounded: two groups of each range, with one row for each point.
    same = reduce(and_, [F.col(name).eqNullSafe(F.col(f"_by_{name}")) for name in by], F.col("_part") == F.col("_in"))
    hit = F.col("_point").isNull() & (F.col("_rank") <= F.col("_upto")) & (F.col("_rank") > F.col("_upto") - F.col("_n"))
    chosen = inside.join(F.broadcast(wanted), same & hit, "left").where("_point IS NOT NULL OR _wanted IS NOT NULL")
    either = {name: F.coalesce(F.col(f"_all{name}"), F.col(name)) for name in _ADDED}
    point = F.coalesce("_wanted", "_point")
    out = chosen.groupBy(*by).agg(
        F.first(either["_n"]).alias("n"),
        F.first(either["_min"]).alias("min"),
        F.first(either["_max"]).alias("max"),
        F.first(F.try_divide(either["_total"].cast("double"), either["_n"])).alias("mean"),
        *([F.first(either["_missing"]).alias(missing)] if missing else []),
        *[F.max(F.when(point == name, F.col("_at"))).alias(column_of(name)) for name in points],
    )
    return out if missing else out.where("n > 0")


#: How the figures of a group's ranges make those of the group.
_ADDED = {"_n": F.sum, "_missing": F.sum, "_min": F.min, "_max": F.max, "_total": F.sum}


def _rank(n: Column, point: str) -> Column:
    return F.ceil(n * F.lit(Decimal(point)).cast("decimal(9,8)")).cast("bigint")


def _groups(batches: Iterator[pa.RecordBatch], by: list[str]) -> Iterator[tuple]:
    """Key columns, values, their counts and the number of nulls of each group of a sorted range, and if it is the first or last one.

    No more than one group is held, as arrays of its values in this range.
    """

    def finished(last: bool) -> tuple:
        table = pa.concat_tables(held).combine_chunks()
        at, n = table.column("_at"), table.column("_n").to_numpy()
        known = at.is_valid().to_numpy()
        values = at.filter(at.is_valid()).to_numpy()
        return table.select([*by, "_part"]).slice(0, 1), values, n[known], int(n[~known].sum()), first, last

    held, key, first = [], None, True
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        turns = np.zeros(len(table) - 1, bool)
        for name in by:
            codes = table.column(name).combine_chunks().dictionary_encode(null_encoding="encode").indices.to_numpy()
            turns |= codes[1:] != codes[:-1]
        edges = [0, *(np.flatnonzero(turns) + 1).tolist(), len(table)]
        for start, end in zip(edges, edges[1:]):
            here = tuple(table.column(name)[start] for name in by)
            if held and here != key:
                yield finished(False)
                held, first = [], False
            held.append(table.slice(start, end - start))
            key = here
    if held:
        yield finished(True)


def _figures(values: np.ndarray, n: np.ndarray, missing: int) -> dict[str, list]:
    """Number, nulls, smallest, largest and sum of a group's values, the sum in whole numbers of any size."""
    low = values & 0xFFFF_FFFF
    total = (sum((values >> 32).astype(object) * n.astype(object)) << 32) + sum(low.astype(object) * n.astype(object))
    edges = (int(values[0]), int(values[-1])) if len(values) else (None, None)
    return dict(zip(_ADDED, ([int(n.sum())], [missing], [edges[0]], [edges[1]], [Decimal(int(total))])))


_KINDS = {name: pa.decimal128(38) if name == "_total" else pa.int64() for name in _ADDED}


def _repeated(key: pa.Table, count: int, columns: dict[str, pa.Array]) -> Iterator[pa.RecordBatch]:
    table = key.take(pa.array(np.zeros(count, np.int64)))
    for name, column in columns.items():
        table = table.append_column(name, column)
    yield from table.combine_chunks().to_batches()


def _range_ends(by: list[str]):
    """Figures of the first and the last group of each range, which may go on in its neighbours."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, values, n, missing, first, last in _groups(batches, by):
            if first or last:
                figures = _figures(values, n, missing)
                yield from _repeated(key, 1, {name: pa.array(v, _KINDS[name]) for name, v in figures.items()})

    return run


def _range_ranks(by: list[str], points: tuple[str, ...]):
    """The values wanted of the groups that lie within a range; of its first and last group all values, with running counts."""
    shares = [Fraction(point) for point in points]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, values, n, missing, first, last in _groups(batches, by):
            upto = np.cumsum(n)
            if first or last:
                # The row without a value stands for rank 0, by which groups of nulls alone are found.
                at = pa.concat_arrays([pa.array([None], pa.int64()), pa.array(values, pa.int64())])
                count = len(at)
                found = {
                    "_point": pa.nulls(count, pa.string()),
                    "_at": at,
                    "_upto": pa.array(np.r_[0, upto].astype(np.int64)),
                    "_n": pa.array(np.r_[1, n].astype(np.int64)),
                }
                more = {name: pa.nulls(count, kind) for name, kind in _KINDS.items() if name != "_n"}
            else:
                total = int(n.sum())
                ranks = [max(1, -(-total * s.numerator // s.denominator)) for s in shares]
                count = len(points) if total else 1
                at = [int(values[np.searchsorted(upto, rank)]) for rank in ranks] if total else [None]
                found = {
                    "_point": pa.array(points if total else [""]),
                    "_at": pa.array(at, pa.int64()),
                    "_upto": pa.nulls(count, pa.int64()),
                }
                more = {name: pa.array(v * count, _KINDS[name]) for name, v in _figures(values, n, missing).items()}
            columns = found | more
            order = ["_point", "_at", "_upto", *_ADDED]
            yield from _repeated(key, count, {name: columns[name] for name in order})

    return run


def column_of(point: str) -> str:
    """`0.5` -> `p50`, `0.999` -> `p99_9`."""
    percent = (Decimal(point) * 100).normalize()
    return "p" + f"{percent:f}".replace(".", "_")


def ingest_lag(
    samples: DataFrame,
    by: Sequence[str] = ("type",),
    points: Sequence[str] = ("0.5", "0.95", "0.99"),
) -> DataFrame:
    """Distribution of the time, in microseconds, between taking a sample and its arrival; `unknown` counts samples without one of the two."""
    rows = samples.select(
        *by, lag_micros(F.col("broker_time"), F.col("timestamp")).alias("lag_us")
    )
    return percentiles(rows, list(by), "lag_us", points, missing="unknown")
