"""Nearest rows against brute force, on both ways of bringing queries and rows together."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from hostpulse.functions.embedding import Calls, embed
from hostpulse.operators import retrieve
from hostpulse.operators.retrieve import nearest

DIMS = 8


def cosine(a, b):
    with np.errstate(invalid="ignore", divide="ignore"):
        return round(float(np.dot(a, b) / np.linalg.norm(a) / np.linalg.norm(b)), 6) + 0.0


def brute_force(vectors, queries, k):
    rows = []
    for query_id, query in queries:
        scored = [
            (-cosine(vector, query), row_id)
            for row_id, vector in vectors
            if len(vector) == DIMS and None not in vector and any(vector)
        ]
        for rank, (score, row_id) in enumerate(sorted(scored)[:k], start=1):
            rows.append((query_id, row_id, -score + 0.0, rank))
    return sorted(rows)


@pytest.fixture(scope="module")
def vectors():
    random = np.random.default_rng(7)
    rows = [(i, random.normal(size=DIMS).tolist()) for i in range(400)]
    # A third of all rows are copies of one vector: the ids have to decide among them.
    rows += [(400 + i, rows[5][1]) for i in range(200)]
    rows += [(600, [0.0] * DIMS), (601, [1.0]), (602, []), (603, [None] + [1.0] * (DIMS - 1))]
    return rows


@pytest.fixture(scope="module")
def queries(vectors):
    random = np.random.default_rng(8)
    near = [(f"near{i}", vectors[i][1]) for i in (0, 5, 17)]
    return near + [(f"q{i}", random.normal(size=DIMS).tolist()) for i in range(40)]


# One pass with all queries at every task; or several passes, for a limit of 2 or of 16 queries per task.
@pytest.mark.parametrize("limit", [1 << 20, 2 * 8 * DIMS, 16 * 8 * DIMS])
@pytest.mark.parametrize("k", [1, 7])
@pytest.mark.parametrize("parts", [1, 5])
def test_nearest_equals_brute_force(spark, vectors, queries, limit, k, parts):
    rows = spark.createDataFrame(vectors, "vec_id bigint, embedding array<double>").repartition(parts)
    asked = spark.createDataFrame(queries, "query_id string, query_vector array<double>")
    got = nearest(rows, asked, k, DIMS, id_cols=["vec_id"], max_query_bytes=limit)
    found = sorted(tuple(row) for row in got.collect())
    expected = brute_force(vectors, queries, k)
    assert [(q, i, rank) for q, i, _, rank in found] == [(q, i, rank) for q, i, _, rank in expected]
    assert np.allclose([row[2] for row in found], [row[2] for row in expected], atol=2e-6)


@pytest.mark.parametrize("limit", [1 << 20, 8 * DIMS])
def test_more_wanted_than_there_are(spark, limit):
    rows = spark.createDataFrame([(1, [1.0] * DIMS)], "vec_id bigint, embedding array<float>")
    asked = spark.createDataFrame(
        [(i, [1.0 + i] * DIMS) for i in range(3)], "query_id int, query_vector array<double>"
    )
    got = nearest(rows, asked, 10, DIMS, id_cols=["vec_id"], max_query_bytes=limit).collect()
    assert sorted(tuple(row) for row in got) == [(i, 1, 1.0, 1) for i in range(3)]


def test_no_queries_no_rows(spark):
    rows = spark.createDataFrame([(1, [1.0] * DIMS)], "vec_id bigint, embedding array<double>")
    none = spark.createDataFrame([], "query_id int, query_vector array<double>")
    assert nearest(rows, none, 3, DIMS, id_cols=["vec_id"]).collect() == []


def test_many_groups_of_rows(monkeypatch):
    """Merging over many small groups gives what one large group gives."""
    random = np.random.default_rng(3)
    units = random.normal(size=(5, DIMS))
    units /= np.linalg.norm(units, axis=1, keepdims=True)
    rows = pa.table(
        {
            "id": list(range(1000)),
            "v": pa.array((np.round(random.normal(size=(1000, DIMS)) * 2) / 2).tolist()),
        }
    )
    found = []
    for size in (1, 8 * DIMS * 7, 1 << 20):
        monkeypatch.setattr(retrieve, "SCORED_BYTES", size)
        best = retrieve._Best(units, 9, ["id"], "v", 2)
        for start in range(0, 1000, 13):
            best.add(rows.slice(start, 13))
        found.append([b.to_pydict() for b in best.results(pa.array(range(5)), "q")])
    assert found[0] == found[1] == found[2]


def test_waiting_rows_do_not_hold_their_batches(tmp_path):
    random = np.random.default_rng(4)
    schema = pa.schema([("id", pa.int64()), ("v", pa.list_(pa.float64()))])
    with pa.OSFile(str(tmp_path / "rows"), "wb") as file, pa.ipc.new_stream(file, schema) as out:
        for start in range(0, 10_000, 1000):
            ids = pa.array(range(start, start + 1000))
            out.write(pa.record_batch([ids, pa.array(list(random.normal(size=(1000, 64))), schema.field("v").type)], schema=schema))
    best = retrieve._Best(np.eye(64)[:2], 5, ["id"], "v", 6)
    before = pa.total_allocated_bytes()
    with pa.OSFile(str(tmp_path / "rows")) as file:
        for batch in pa.ipc.open_stream(file):
            best.add(pa.Table.from_batches([batch]))
    del batch
    # Ids of ten batches take 80 KB, their vectors 5 MB.
    assert pa.total_allocated_bytes() - before < 1 << 20
    assert sum(b.num_rows for b in best.results(pa.array([0, 1]), "q")) == 10


@pytest.mark.parametrize("audit", [None, "audit"])
def test_each_text_is_embedded_once(spark, audit):
    """The checks of the vectors do not call the encoder again."""
    logs, questions = Calls(spark.sparkContext), Calls(spark.sparkContext)
    rows = spark.createDataFrame([(i, f"user {i}") for i in range(250)], "id int, t string").repartition(3)
    asked = spark.createDataFrame([(0, "user 7"), (1, "user 8")], "query_id int, t string")
    found = rows.select("id", embed(F.col("t"), calls=logs).alias("embedding"))
    wanted = asked.select("query_id", embed(F.col("t"), calls=questions).alias("query_vector"))
    got = nearest(found, wanted, 1, id_cols=["id"], audit=audit, strict=True).collect()
    assert sorted((q, i, s) for q, i, s, _ in got) == [(0, 7, 1.0), (1, 8, 1.0)]
    assert logs.figures()[1] == 250
    # Their width is read in one job, they themselves in another.
    assert questions.figures()[1] <= 2 * 2


def test_text_ids_and_two_id_columns(spark):
    rows = spark.createDataFrame(
        [("b", 1, [1.0] * DIMS), ("a", 2, [1.0] * DIMS), ("a", 1, [1.0] * DIMS)],
        "topic string, at bigint, embedding array<double>",
    )
    asked = spark.createDataFrame([(0, [1.0] * DIMS)], "query_id int, query_vector array<double>")
    got = nearest(rows, asked, 2, DIMS, id_cols=["topic", "at"]).orderBy("rank").collect()
    assert [(row["topic"], row["at"]) for row in got] == [("a", 1), ("a", 2)]


def test_tasks_pass_on_only_the_best(spark, vectors, queries):
    """What leaves the first stage is at most k rows per query and task."""
    rows = spark.createDataFrame(vectors, "vec_id bigint, embedding array<double>").repartition(3)
    asked = spark.createDataFrame(queries, "query_id string, query_vector array<double>")
    plan = nearest(rows, asked, 4, DIMS, id_cols=["vec_id"])._jdf.queryExecution().toString()
    assert "MapInArrow" in plan
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    assert "WindowGroupLimit" in plan


def test_near_ties_rank_by_similarity(spark):
    """Similarities that agree in six digits, the best with the largest id."""
    rows = [(k, [1.0, 1e-4 * (7 - k)]) for k in range(1, 7)]
    vectors = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    queries = spark.createDataFrame([(1, [1.0, 0.0])], "query_id int, query_vector array<double>")
    found = nearest(vectors, queries, 3, 2, id_cols=["vec_id"]).orderBy("rank").collect()
    assert [row["vec_id"] for row in found] == [6, 5, 4]


def test_width_comes_from_the_queries(spark):
    rows = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 1.0, 0.0]), (3, [0.0, 1.0])], "vec_id bigint, embedding array<double>")
    one = spark.createDataFrame([(0, [0.0, 2.0])], "query_id int, query_vector array<double>")
    assert [r["vec_id"] for r in nearest(rows, one, 5, id_cols=["vec_id"]).orderBy("rank").collect()] == [3, 1]
    assert retrieve.width_of(rows.where("vec_id = 2"), "embedding") == 3 and retrieve.width_of(rows.limit(0), "embedding") is None
    two = one.union(spark.createDataFrame([(1, [1.0])], one.schema))
    with pytest.raises(ValueError, match="1 to 2 wide"):
        nearest(rows, two, 5, id_cols=["vec_id"])
    with pytest.raises(Exception, match="a vector is 3 wide, the queries 2"):
        nearest(rows, one, 5, id_cols=["vec_id"], strict=True).collect()
    assert nearest(rows, one.limit(0), 5, id_cols=["vec_id"]).collect() == []


def test_unusable_rows_are_counted(spark, vectors):
    rows = spark.createDataFrame(vectors + [(700, None), (701, [float("nan")] * DIMS)], "vec_id bigint, embedding array<double>")
    asked = spark.createDataFrame([(0, vectors[0][1])], "query_id int, query_vector array<double>")
    seen = Observation()
    assert nearest(rows, asked, 3, id_cols=["vec_id"], audit=seen).count() == 3
    assert seen.get == {"rows": 606, "without_vector": 1, "other_width": 2, "without_number": 2, "without_length": 1}


def test_size_check_counts_the_ids(spark, vectors):
    """Three queries whose vectors fit but whose ids do not."""
    rows = spark.createDataFrame(vectors, "vec_id bigint, embedding array<double>")
    queries = [(f"{i}" * 5000, vectors[i][1]) for i in range(3)]
    asked = spark.createDataFrame(queries, "query_id string, query_vector array<double>")
    got = nearest(rows, asked, 2, id_cols=["vec_id"], max_query_bytes=6000)
    assert sorted((q[0], i, r) for q, i, _, r in got.collect()) == sorted(
        (q[0], i, r) for q, i, _, r in brute_force(vectors, queries, 2)
    )


def test_two_steps_of_merging(spark, vectors, queries, monkeypatch):
    monkeypatch.setattr(retrieve, "MERGED_TASKS", 2)
    rows = spark.createDataFrame(vectors, "vec_id bigint, embedding array<double>").repartition(7)
    asked = spark.createDataFrame(queries, "query_id string, query_vector array<double>")
    got = nearest(rows, asked, 6, id_cols=["vec_id"])
    assert sorted((q, i, r) for q, i, _, r in got.collect()) == [(q, i, r) for q, i, _, r in brute_force(vectors, queries, 6)]
    plan = got._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1]
    # The vectors are below the first exchange of the merge, so none is shuffled.
    assert "_tasks" in plan and plan.index("MapInArrow") > plan.rindex("Exchange hashpartitioning(query_id")


def test_vectors_are_read_once_for_each_block(spark, vectors, queries):
    rows = spark.createDataFrame(vectors, "vec_id bigint, embedding array<double>").repartition(3)
    asked = spark.createDataFrame(queries, "query_id string, query_vector array<double>")
    passes = []
    keep = retrieve._one_pass
    retrieve._one_pass = lambda rows, block, *rest: passes.append((block.num_rows, block.nbytes)) or keep(rows, block, *rest)
    try:
        nearest(rows, asked, 2, id_cols=["vec_id"], max_query_bytes=1500).collect()
    finally:
        retrieve._one_pass = keep
    assert sum(n for n, _ in passes) == len(queries) and 3 <= len(passes) <= 12
    assert all(size <= 2500 for _, size in passes)
