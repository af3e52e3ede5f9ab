"""Runs a query on Spark and its SQL on DuckDB and compares the rows as bags."""

import math
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def database(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        if Path(f"{folder}/{name}.parquet").exists():
            connection.execute(
                f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')"
            )
    return connection


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    if isinstance(value, list):
        return tuple(_plain(item) for item in value)
    return value


def _bag(table) -> list[tuple]:
    names = sorted(table.column_names)
    columns = [[_plain(v) for v in table.column(name).to_pylist()] for name in names]
    return sorted(zip(*columns), key=repr)


def difference(frame, sql: str, folder: str) -> str | None:
    """None if both agree, else what differs."""
    ours = frame.toArrow()
    theirs = database(folder).sql(sql).to_arrow_table()
    if sorted(ours.column_names) != sorted(theirs.column_names):
        return f"columns {sorted(ours.column_names)} != {sorted(theirs.column_names)}"
    if ours.num_rows != theirs.num_rows:
        return f"rows {ours.num_rows} != {theirs.num_rows}"
    kinds = {
        name: (str(ours.schema.field(name).type), str(theirs.schema.field(name).type))
        for name in ours.column_names
    }
    uneven = {
        name: pair
        for name, pair in kinds.items()
        if pair[0].replace("large_", "") != pair[1].replace("large_", "")
    }
    if uneven:
        return f"types {uneven}"
    for mine, other in zip(_bag(ours), _bag(theirs)):
        if mine != other:
            return f"first difference {mine} != {other}"
    return None
