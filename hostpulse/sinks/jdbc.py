"""Streaming rows into a database table without duplicates after a replay or a lost executor.

Spark's JDBC writer commits once per task, so a task that is run again may insert its rows twice, and
a micro-batch that is run again would insert all of them twice. Each batch therefore goes

1. to Parquet in the shared folder, where Spark's commit protocol drops the output of lost attempts
   (this also runs the embedding at full width, before the few database connections);
2. from there, each row numbered, to a staging table through a bounded number of connections;
3. from staging to the target in one transaction, which first checks that staging holds every row
   exactly once and removes what an earlier run of the same batch left.

Staged rows name the query and batch that they are for. The transaction that publishes a batch also deletes what is staged
for it and for earlier ones: by attempts that failed, and by tasks that went on after theirs was given up.

A new checkpoint starts its batch ids at zero again, so it needs a new `query_name`.
"""

import logging
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import Secret

log = logging.getLogger(__name__)

Statement = tuple[str, tuple]
# Runs the count query, gives its single row to the check, then runs the rest and commits.
Transaction = Callable[[Statement, Callable[[tuple], None], list[Statement]], None]


class IncompleteStaging(Exception):
    """Staging lost or repeated rows; the batch has to be staged again."""


@dataclass(frozen=True)
class Database:
    url: str
    driver: str = "org.postgresql.Driver"
    user: str | None = None
    password: Secret | None = None
    # The database, not the cluster, sets how many tasks may write at a time.
    connections: int = 16
    rows_per_insert: int = 5000
    arrays_as_json: bool = False
    extra: dict[str, str] = field(default_factory=lambda: {"reWriteBatchedInserts": "true"})

    def properties(self) -> dict[str, str]:
        login = {"user": self.user} if self.user else {}
        if self.password is not None:
            login["password"] = self.password.reveal()
        return {"driver": self.driver, **self.extra, **login}

    def write_options(self, table: str) -> dict[str, str]:
        return self.properties() | {
            "url": self.url,
            "dbtable": table,
            "batchsize": str(self.rows_per_insert),
            "numPartitions": str(self.connections),
            "isolationLevel": "READ_COMMITTED",
        }


def storable(rows: DataFrame, arrays_as_json: bool) -> DataFrame:
    """Array columns as JSON text for databases that have no array type."""
    if not arrays_as_json:
        return rows
    return rows.select(
        *[
            F.to_json(column.name).alias(column.name)
            if isinstance(column.dataType, T.ArrayType)
            else F.col(column.name)
            for column in rows.schema
        ]
    )


def staged_rows(
    rows: DataFrame, attempt: str, connections: int, query_name: str = "", batch_id: int = 0
) -> DataFrame:
    """Rows with their number and the attempt, query and batch they belong to.

    The number follows from the files read and the position in them, so a task that runs again gives
    its rows the same numbers.
    """
    numbered = rows.select(
        "*",
        F.monotonically_increasing_id().alias("row_no"),
        F.lit(attempt).alias("attempt"),
        F.lit(query_name).alias("for_query"),
        F.lit(batch_id).cast("bigint").alias("for_batch"),
    )
    return numbered.coalesce(connections)


def count_statement(staging: str, attempt: str) -> Statement:
    return (
        f"SELECT COUNT(*), COUNT(DISTINCT row_no) FROM {staging} WHERE attempt = ?",
        (attempt,),
    )


def _listed(columns: list[str]) -> str:
    return ", ".join(f'"{name}"' for name in columns)


def target_statements(table: str, staging: str, columns: list[str]) -> list[Statement]:
    """Makes the target; needed once for each writer."""
    names = _listed(columns)
    index = f"{table.rsplit('.', 1)[-1]}_by_batch"
    return [
        (
            f"CREATE TABLE IF NOT EXISTS {table} AS SELECT {names}, "
            "CAST('' AS VARCHAR(255)) AS query_name, CAST(0 AS BIGINT) AS batch_id "
            f"FROM {staging} WHERE 1 = 0",
            (),
        ),
        # Without it the delete below would read the whole table for every micro-batch.
        (f"CREATE INDEX IF NOT EXISTS {index} ON {table} (query_name, batch_id)", ()),
    ]


def publish_statements(
    table: str, staging: str, columns: list[str], query_name: str, batch_id: int, attempt: str
) -> list[Statement]:
    names = _listed(columns)
    return [
        (f"DELETE FROM {table} WHERE query_name = ? AND batch_id = ?", (query_name, batch_id)),
        (
            f"INSERT INTO {table} ({names}, query_name, batch_id) "
            f"SELECT {names}, CAST(? AS VARCHAR(255)), CAST(? AS BIGINT) "
            f"FROM {staging} WHERE attempt = ?",
            (query_name, batch_id, attempt),
        ),
        # One batch of a query is in flight at a time, so nothing still needs what is staged up to this one.
        (f"DELETE FROM {staging} WHERE for_query = ? AND for_batch <= ?", (query_name, batch_id)),
    ]


def jdbc_transaction(spark: SparkSession, database: Database) -> Transaction:
    """Transactions over one connection of the driver, which carries statements and no rows."""

    def run(count: Statement, check: Callable[[tuple], None], rest: list[Statement]) -> None:
        jvm = spark._jvm
        loader = jvm.java.lang.Thread.currentThread().getContextClassLoader()
        driver = loader.loadClass(database.driver).newInstance()
        properties = jvm.java.util.Properties()
        for key, value in database.properties().items():
            properties.setProperty(key, value)
        connection = driver.connect(database.url, properties)
        try:
            connection.setAutoCommit(False)
            connection.setTransactionIsolation(
                jvm.java.sql.Connection.TRANSACTION_REPEATABLE_READ
            )
            found = _prepared(connection, count).executeQuery()
            found.next()
            check((found.getLong(1), found.getLong(2)))
            for statement in rest:
                _prepared(connection, statement).executeUpdate()
            connection.commit()
        except BaseException:
            connection.rollback()
            raise
        finally:
            connection.close()

    return run


def _prepared(connection, statement: Statement):
    text, values = statement
    prepared = connection.prepareStatement(text)
    for position, value in enumerate(values, start=1):
        prepared.setObject(position, value)
    return prepared


def jdbc_stage(database: Database) -> Callable[[DataFrame, str], None]:
    def write(rows: DataFrame, staging: str) -> None:
        options = database.write_options(staging)
        rows.write.format("jdbc").mode("append").options(**options).save()

    return write


def batch_writer(
    query_name: str,
    table: str,
    folder: str,
    stage: Callable[[DataFrame, str], None],
    transaction: Transaction,
    connections: int = 16,
    arrays_as_json: bool = False,
    attempts: int = 3,
) -> Callable[[DataFrame, int], None]:
    """The function for `foreachBatch`. `stage` and `transaction` are what touches the database."""
    staging = f"{table}_staging"
    made = False

    def write(batch: DataFrame, batch_id: int) -> None:
        nonlocal made
        spark = batch.sparkSession
        # One batch of a query is in flight at a time, so each may overwrite the one before.
        path = f"{folder}/{query_name}"
        columns = batch.columns
        ready = storable(batch, arrays_as_json)
        ready.write.mode("overwrite").parquet(path)
        rows = spark.read.schema(ready.schema).parquet(path)
        expected = rows.count()

        def complete(found: tuple) -> None:
            if tuple(found) != (expected, expected):
                raise IncompleteStaging(f"{found} rows and row numbers, expected {expected}")

        for left in reversed(range(attempts)):
            attempt = uuid.uuid4().hex
            stage(staged_rows(rows, attempt, connections, query_name, batch_id), staging)
            publish = [] if made else target_statements(table, staging, columns)
            publish += publish_statements(table, staging, columns, query_name, batch_id, attempt)
            try:
                transaction(count_statement(staging, attempt), complete, publish)
                made = True
                return
            except IncompleteStaging:
                if left == 0:
                    raise
                log.warning("%s: staging batch %d again", query_name, batch_id)

    return write


def jdbc_writer(
    spark: SparkSession, database: Database, query_name: str, table: str, folder: str
) -> Callable[[DataFrame, int], None]:
    return batch_writer(
        query_name,
        table,
        folder,
        jdbc_stage(database),
        jdbc_transaction(spark, database),
        database.connections,
        database.arrays_as_json,
    )
