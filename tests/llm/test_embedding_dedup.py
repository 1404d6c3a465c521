"""Embedding near-dedup against all pairs."""

import numpy as np
import pytest

from quillset.llm import embedding_dedup
from quillset.llm.queries import op3_embedding_dedup


def slow(vectors, similarity=0.9):
    n = len(vectors)
    links = np.zeros((n, n), bool)
    for i, a in enumerate(vectors):
        for j, b in enumerate(vectors):
            fine = all(
                v is not None and len(v) and all(c is not None and np.isfinite(c) for c in v) and np.any(v) for v in (a, b)
            )
            if i != j and fine and len(a) == len(b):
                x, y = np.array(a, float), np.array(b, float)
                links[i, j] = x @ y / np.sqrt((x @ x) * (y @ y)) >= similarity
    root = list(range(n))
    for _ in range(n):
        root = [min([root[i], *[root[j] for j in np.flatnonzero(links[i])]]) for i in range(n)]
    return links.sum(1), root


@pytest.mark.parametrize("cap", [256, 4])
def test_equals_all_pairs(spark, monkeypatch, cap):
    monkeypatch.setattr(embedding_dedup, "BLOCK_ROWS", cap)
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(12, 16))
    vectors = [(centres[i % 12] + rng.normal(size=16) * (0.02 if i % 3 else 0.28)).tolist() for i in range(150)]
    vectors += [vectors[0], vectors[0], [2 * x for x in vectors[0]], [0.0] * 16, None, [], [float("nan")] * 16]
    vectors += [[None] + [1.0] * 15, [float("inf")] + [1.0] * 15, [1.0, 1.0], [1.0, 1.01], [1e300] * 16, [-0.0, 1.0]]
    rows = [(i, v, "z") for i, v in enumerate(vectors)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, kept string")
    got = {r.vec_id: r for r in embedding_dedup.near_duplicates(frame).collect()}
    links, root = slow(vectors)
    assert [got[i].n_links for i in range(len(vectors))] == links.tolist()
    assert [got[i].component_id for i in range(len(vectors))] == root
    assert all(got[i].kept == (root[i] == i) for i in range(len(vectors)))
    assert embedding_dedup.near_duplicates(frame.limit(0)).count() == 0


def test_recall_at_the_threshold():
    rng = np.random.default_rng(0)
    a = embedding_dedup.unit(rng.normal(size=(4000, 64)))
    b = rng.normal(size=a.shape)
    b = embedding_dedup.unit(b - (b * a).sum(1)[:, None] * a)
    near = 0.9 * a + np.sqrt(1 - 0.81) * b
    buckets = embedding_dedup.CrossPolytope(64).buckets(np.concatenate([a, near]))
    met = embedding_dedup.meetings(buckets, np.arange(4000), np.arange(4000) + 4000) < embedding_dedup.TABLES
    assert met.mean() >= 0.99


def test_query_on_whole_table(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()
    got = {r.vec_id: r for r in op3_embedding_dedup(spark, sf_dir).collect()}
    assert len(got) == len(rows)
    links, _ = slow([r.embedding for r in rows[:150]])
    assert all(got[r.vec_id].n_links >= n for r, n in zip(rows, links))
