"""The batch writer with its two database steps replaced by a table engine inside this process.

What is tested is the order of steps, the SQL and the behaviour after replays and repeated tasks, not
the connection to a database.
"""

import duckdb
import pytest
from pyspark.sql import functions as F

from hostpulse.config import Secret
from hostpulse.sinks.jdbc import Database, IncompleteStaging, batch_writer, jdbc_transaction, staged_rows, storable


class Engine:
    def __init__(self):
        self.connection = duckdb.connect()
        self.repeat_next = 0
        self.fail_next_publish = False
        self.texts = []

    def stage(self, rows, staging):
        arrow = rows.toArrow()  # noqa: F841
        self.connection.execute(
            f"CREATE TABLE IF NOT EXISTS {staging} AS SELECT * FROM arrow WHERE 1 = 0"
        )
        self.connection.execute(f"INSERT INTO {staging} SELECT * FROM arrow")
        if self.repeat_next:
            # A task that had committed runs again.
            self.repeat_next -= 1
            self.connection.execute(f"INSERT INTO {staging} SELECT * FROM arrow LIMIT 3")

    def transaction(self, count, check, rest):
        self.connection.execute("BEGIN")
        try:
            check(self.connection.execute(*count).fetchone())
            for text, values in rest:
                self.texts.append(text)
                self.connection.execute(text, values)
                if self.fail_next_publish and text.startswith("DELETE"):
                    self.fail_next_publish = False
                    raise ConnectionError("lost")
            self.connection.execute("COMMIT")
        except BaseException:
            self.connection.execute("ROLLBACK")
            raise

    def staged(self):
        return self.connection.execute("SELECT count(*) FROM t_staging").fetchone()[0]

    def rows(self, columns="*"):
        return self.connection.execute(f"SELECT {columns} FROM t ORDER BY ALL").fetchall()


@pytest.fixture
def engine():
    return Engine()


@pytest.fixture
def writer(engine, tmp_path):
    return batch_writer("q", "t", str(tmp_path), engine.stage, engine.transaction, connections=2)


def batch(spark, start, end):
    return spark.range(start, end, numPartitions=3).select(
        "id", F.concat(F.lit("log "), F.col("id") % 4).alias("line")
    )


def test_batches_add_up_and_replays_do_not(spark, engine, writer):
    writer(batch(spark, 0, 50), 0)
    writer(batch(spark, 50, 80), 1)
    first = engine.rows()
    assert len(first) == 80
    writer(batch(spark, 50, 80), 1)
    writer(batch(spark, 0, 50), 0)
    assert engine.rows() == first
    assert engine.connection.execute("SELECT count(*) FROM t_staging").fetchone() == (0,)


def test_equal_rows_are_all_kept(spark, engine, writer):
    rows = spark.range(100).select(F.lit(1).alias("id"), F.lit("same").alias("line"))
    writer(rows, 0)
    assert len(engine.rows()) == 100


def test_repeated_task_is_staged_again(spark, engine, writer):
    engine.repeat_next = 2
    writer(batch(spark, 0, 50), 0)
    assert engine.rows("id") == [(i,) for i in range(50)]


def test_it_gives_up_rather_than_publish_wrong_rows(spark, engine, writer):
    writer(batch(spark, 0, 10), 0)
    engine.repeat_next = 3
    with pytest.raises(IncompleteStaging):
        writer(batch(spark, 10, 30), 1)
    assert engine.rows("id") == [(i,) for i in range(10)]
    writer(batch(spark, 10, 30), 1)
    assert engine.rows("id") == [(i,) for i in range(30)]


def test_a_publish_that_fails_midway_changes_nothing(spark, engine, writer):
    writer(batch(spark, 0, 10), 0)
    engine.fail_next_publish = True
    with pytest.raises(ConnectionError):
        writer(batch(spark, 0, 10), 0)
    assert engine.rows("id") == [(i,) for i in range(10)]


def test_staging_is_empty_after_failures(spark, engine, writer):
    engine.repeat_next = 3
    with pytest.raises(IncompleteStaging):
        writer(batch(spark, 0, 10), 0)
    assert engine.staged() == 39
    writer(batch(spark, 0, 10), 0)
    assert engine.staged() == 0
    engine.fail_next_publish = True
    with pytest.raises(ConnectionError):
        writer(batch(spark, 10, 20), 1)
    assert engine.staged() == 10
    writer(batch(spark, 10, 20), 1)
    assert engine.staged() == 0 and engine.rows("id") == [(i,) for i in range(20)]


def test_a_task_that_goes_on_after_its_batch_leaves_nothing(spark, engine, writer):
    writer(batch(spark, 0, 10), 0)
    engine.stage(staged_rows(batch(spark, 0, 3), "old", 2, "q", 0), "t_staging")
    engine.stage(staged_rows(batch(spark, 0, 4), "own", 2, "another", 0), "t_staging")
    writer(batch(spark, 10, 20), 1)
    assert engine.rows("id") == [(i,) for i in range(20)]
    assert engine.connection.execute("SELECT DISTINCT for_query FROM t_staging").fetchall() == [("another",)]
    assert engine.staged() == 4


def test_the_target_is_made_once(spark, engine, writer):
    engine.fail_next_publish = True
    with pytest.raises(ConnectionError):
        writer(batch(spark, 0, 5), 0)
    engine.texts.clear()
    for number in range(3):
        writer(batch(spark, 0, 5), number)
    assert sum(text.startswith("CREATE") for text in engine.texts) == 2
    assert len(engine.rows()) == 15


class Recorder:
    """Stands in for the classes of a database driver and notes what is called on them."""

    def __init__(self, found=(5, 5), failing=None):
        self.calls, self.found, self.failing = [], found, failing

    def __getattr__(self, name):
        if name in ("java", "lang", "util", "sql", "Thread", "Connection"):
            return self
        if name == "TRANSACTION_REPEATABLE_READ":
            return 4

        def call(*values):
            self.calls.append((name, *values))
            if name == "getLong":
                return self.found[values[0] - 1]
            if name == "prepareStatement" and values[0] == self.failing:
                raise ConnectionError("lost")
            return self

        return call


def transacted(recorder, check):
    class Session:
        _jvm = recorder

    database = Database("jdbc:x", driver="a.Driver", user="u", password=Secret(lambda: "p"), extra={})
    jdbc_transaction(Session, database)(("COUNT ?", ("a",)), check, [("ONE ?, ?", (1, "x")), ("TWO", ())])


def test_driver_calls_of_a_transaction():
    recorder, seen = Recorder(), []
    transacted(recorder, seen.append)
    assert seen == [(5, 5)]
    assert [call for call in recorder.calls if call[0] == "setProperty"] == [
        ("setProperty", "driver", "a.Driver"),
        ("setProperty", "user", "u"),
        ("setProperty", "password", "p"),
    ]
    names = [call[0] for call in recorder.calls]
    assert recorder.calls[names.index("setAutoCommit") :] == [
        ("setAutoCommit", False),
        ("setTransactionIsolation", 4),
        ("prepareStatement", "COUNT ?"),
        ("setObject", 1, "a"),
        ("executeQuery",),
        ("next",),
        ("getLong", 1),
        ("getLong", 2),
        ("prepareStatement", "ONE ?, ?"),
        ("setObject", 1, 1),
        ("setObject", 2, "x"),
        ("executeUpdate",),
        ("prepareStatement", "TWO"),
        ("executeUpdate",),
        ("commit",),
        ("close",),
    ]


@pytest.mark.parametrize("failing", ["COUNT ?", "ONE ?, ?", "TWO", None])
def test_a_failed_transaction_is_rolled_back_and_closed(failing):
    def check(found):
        if failing is None:
            raise IncompleteStaging("rows missing")

    recorder = Recorder(failing=failing)
    with pytest.raises((ConnectionError, IncompleteStaging)):
        transacted(recorder, check)
    names = [call[0] for call in recorder.calls]
    assert names[-2:] == ["rollback", "close"] and "commit" not in names


def test_empty_batch(spark, engine, writer):
    writer(batch(spark, 0, 10), 0)
    writer(batch(spark, 0, 0), 1)
    assert len(engine.rows()) == 10


def test_row_numbers_repeat_exactly(spark, tmp_path):
    batch(spark, 0, 1000).write.parquet(str(tmp_path / "p"))
    read = lambda: staged_rows(spark.read.parquet(str(tmp_path / "p")), "a", 2)
    first = sorted(tuple(row) for row in read().collect())
    assert first == sorted(tuple(row) for row in read().collect())
    assert len({row[2] for row in first}) == 1000
    assert read().rdd.getNumPartitions() <= 2


def test_arrays_as_text(spark):
    rows = spark.createDataFrame([([1.5, 2.0], "x")], "v array<double>, l string")
    assert storable(rows, False).schema == rows.schema
    assert storable(rows, True).first()["v"] == "[1.5,2.0]"


def test_as_a_stream(spark, engine, writer, tmp_path):
    from hostpulse.streaming.streams import Sink, drain

    source = str(tmp_path / "in")
    batch(spark, 0, 40).write.json(source)
    stream = spark.readStream.schema("id long, line string").json(source)
    drain(stream, Sink(batch=writer), str(tmp_path / "checkpoint"))
    batch(spark, 40, 60).write.mode("append").json(source)
    drain(stream, Sink(batch=writer), str(tmp_path / "checkpoint"))
    assert engine.rows("id") == [(i,) for i in range(60)]
