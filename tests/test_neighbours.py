"""Search and recommendation against comparisons with all rows."""

import contextlib
import io
import re
import tracemalloc

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from quillset.operators import neighbours

SF = "/root/testdata/sf0.01/embeddings.parquet"


def exact(ids, vectors, asked, k, itself=True):
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    near = np.round(unit[asked] @ unit.T, 9)
    found = {}
    for row, q in enumerate(asked):
        order = np.lexsort((ids, -near[row]))
        order = order[order != q] if not itself else order
        found[int(ids[q])] = [(int(ids[i]), float(near[row, i])) for i in order[:k]]
    return found


def table(spark):
    rows = spark.read.parquet(SF).collect()
    return np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows], float)


def as_lists(rows, key):
    found = {}
    for r in sorted(rows, key=lambda r: (r[key], r["rank"])):
        assert r["rank"] == len(found.setdefault(r[key], [])) + 1
        found[r[key]].append((r["neighbour_id" if key == "id" else "id"], round(r["similarity"], 9)))
    return found


@pytest.mark.parametrize(("rows_", "queries_", "fan"), [(4096, 1024, 64), (7, 3, 2)])
def test_all_probes_are_exact(spark, monkeypatch, rows_, queries_, fan):
    monkeypatch.setattr(neighbours, "BLOCK_ROWS", rows_)
    monkeypatch.setattr(neighbours, "BLOCK_QUERIES", queries_)
    monkeypatch.setattr(neighbours, "FAN", fan)
    ids, vectors = table(spark)
    frame = spark.read.parquet(SF)
    index = neighbours.build_index(frame, "vec_id", "embedding")
    got = neighbours.search(index, frame.filter("vec_id % 20 = 0"), "vec_id", "embedding", 10, len(index.centres))
    assert as_lists(got.collect(), "query_id") == exact(ids, vectors, np.flatnonzero(ids % 20 == 0), 10)


def test_recall_of_probed_cells(spark):
    db = duckdb.connect()
    db.execute(f"CREATE VIEW embeddings AS SELECT vec_id, list_transform(embedding, lambda x: x::double) AS v FROM '{SF}'")
    best = db.execute(
        """SELECT query_id, id FROM (
             SELECT q.vec_id AS query_id, r.vec_id AS id, row_number() OVER (
               PARTITION BY q.vec_id ORDER BY round(list_cosine_similarity(q.v, r.v), 9) DESC, r.vec_id) AS rank
             FROM embeddings q JOIN embeddings r ON q.vec_id % 20 = 0) WHERE rank <= 10"""
    ).fetchall()
    frame = spark.read.parquet(SF)
    index = neighbours.build_index(frame, "vec_id", "embedding")
    assert 1 < index.probes < len(index.centres)
    found = neighbours.search(index, frame.filter("vec_id % 20 = 0"), "vec_id", "embedding").collect()
    assert len({(r.query_id, r.id) for r in found} & set(best)) >= 0.9 * len(best)


def test_recall_of_the_graph(spark):
    ids, vectors = table(spark)
    want = exact(ids, vectors, np.arange(len(ids)), 10, itself=False)
    got = as_lists(neighbours.neighbour_graph(spark.read.parquet(SF), "vec_id", "embedding").collect(), "id")
    assert all(len(x) == 10 and q not in dict(x) for q, x in got.items())
    hits = sum(len(dict(got[q]).keys() & dict(want[q]).keys()) for q in want)
    assert hits >= 0.9 * 10 * len(want)


def test_blocks_that_split_all_cells_do_not_split_the_graph(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "START_ROWS", 12)
    ids, vectors = table(spark)
    want = exact(ids, vectors, np.arange(len(ids)), 10, itself=False)
    got = as_lists(neighbours.neighbour_graph(spark.read.parquet(SF), "vec_id", "embedding").collect(), "id")
    assert sum(len(dict(got[q]).keys() & dict(want[q]).keys()) for q in want) >= 0.85 * 10 * len(want)


def test_rounds_are_few_and_shuffle_no_vectors_of_doubles(spark, monkeypatch):
    vectors = np.random.default_rng(6).normal(size=(3000, 32))
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "id long, embedding array<double>")
    plans, staged = [], neighbours.stage

    def seen(df, name):
        text = io.StringIO()
        with contextlib.redirect_stdout(text):
            df.explain("formatted")
        plans.append((name, re.findall(r"\) Exchange\nInput \[\d+\]: \[([^\]]*)\]", text.getvalue())))
        return staged(df, name)

    monkeypatch.setattr(neighbours, "stage", seen)
    monkeypatch.setattr(neighbours, "GRAPH_ROUNDS", 2)
    graph = as_lists(neighbours.neighbour_graph(frame, "id", "embedding").collect(), "id")
    exchanges = [columns for name, columns in plans if name == "neighbours"]
    assert exchanges and not any("vector" in columns for some in exchanges for columns in some)
    want = exact(np.arange(3000), vectors, np.arange(3000), 10, itself=False)
    assert sum(len(dict(graph[q]).keys() & dict(want[q]).keys()) for q in want) >= 0.95 * 10 * len(want)
    assert all(abs(dict(graph[q])[i] - x) < 1e-8 for q in want for i, x in want[q] if i in dict(graph[q]))


def test_rows_that_share_an_id_are_one_row_of_the_graph(spark):
    rows = [(1, [1.0, 0.0]), (1, [1.0, 1.0]), (2, [0.0, 1.0]), (3, [1.0, 0.0]), (3, [1.0, 0.0])]
    frame = spark.createDataFrame(rows, "id long, embedding array<double>")
    half = round(0.5**0.5, 9)
    found = as_lists(neighbours.neighbour_graph(frame, "id", "embedding", 3).collect(), "id")
    assert found == {1: [(3, 1.0), (1, half), (2, half)], 2: [(1, half), (3, 0.0)], 3: [(1, 1.0), (3, 1.0), (2, 0.0)]}


def test_unusable_vectors_copies_and_ties(spark):
    rng = np.random.default_rng(4)
    vectors = rng.normal(size=(40, 5))
    vectors[10:30] = vectors[9]  # a group of copies that holds half of the rows
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)]
    odd = [(90, None), (91, []), (92, [0.0] * 5), (93, [1.0, None, 0.0, 0.0, 0.0]), (94, [float("nan")] * 5), (95, [float("inf")] * 5)]
    frame = spark.createDataFrame(rows + odd + [(None, [1.0] * 5)], "id long, embedding array<double>")
    index = neighbours.build_index(frame, "id", "embedding")
    got = neighbours.search(index, frame.filter("id >= 0"), "id", "embedding", 6, len(index.centres)).collect()
    assert as_lists(got, "query_id") == exact(np.arange(40), vectors, np.arange(40), 6)
    graph = as_lists(neighbours.neighbour_graph(frame, "id", "embedding", 6).collect(), "id")
    want = exact(np.arange(40), vectors, np.arange(40), 6, itself=False)
    assert graph[9] == want[9] and graph.keys() == want.keys()
    scaled = spark.createDataFrame([(1, [1e300, 0.0]), (2, [3e-300, 0.0])], "id long, embedding array<double>")
    index = neighbours.build_index(scaled, "id", "embedding")
    got = neighbours.search(index, scaled, "id", "embedding", 2, 99).collect()
    assert {(r.query_id, r.id): r.similarity for r in got} == dict.fromkeys([(1, 1), (1, 2), (2, 1), (2, 2)], 1.0)


def test_empty_tables_and_other_lengths(spark):
    schema = "id long, embedding array<float>"
    none, one = spark.createDataFrame([], schema), spark.createDataFrame([(1, [1.0, 2.0])], schema)
    for rows, queries in ((none, one), (one, none), (none, none)):
        index = neighbours.build_index(rows, "id", "embedding")
        assert neighbours.search(index, queries, "id", "embedding").collect() == []
    assert neighbours.neighbour_graph(none, "id", "embedding").collect() == []
    assert neighbours.neighbour_graph(one, "id", "embedding").collect() == []
    mixed = spark.createDataFrame([(1, [1.0]), (2, [1.0, 2.0])], schema)
    with pytest.raises(Exception, match="cannot be compared"):
        neighbours.build_index(mixed, "id", "embedding").rows.collect()


def test_no_cross_join(spark):
    frame = spark.read.parquet(SF)
    index = neighbours.build_index(frame, "vec_id", "embedding")
    found = neighbours.search(index, frame, "vec_id", "embedding")
    plan = found._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_many_cells_and_rows_take_little_memory():
    rng = np.random.default_rng(9)
    vectors, centres = rng.normal(size=(10_000, 4)), rng.normal(size=(4096, 4))
    kind = pa.list_(pa.float64())
    ids = pa.array(np.arange(len(vectors)))
    batch = pa.RecordBatch.from_arrays([ids, ids, pa.array(vectors.tolist(), kind)], names=["row", "id", "vector"])
    for cells in (1, 3):
        tracemalloc.start()
        parts = list(neighbours.placed(iter([batch]), centres, cells))
        assert tracemalloc.get_traced_memory()[1] < 60e6
        tracemalloc.stop()
        found = pa.Table.from_batches(parts)
        near = np.argsort(-(vectors @ centres.T), axis=1, kind="stable")[:, :cells]
        assert sorted(zip(found["row"].to_pylist(), found["cell"].to_pylist())) == sorted(
            (i, int(c)) for i, some in enumerate(near) for c in some
        )
