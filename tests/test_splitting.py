import hashlib

import pytest
from pyspark.sql import functions as F

from quillset.operators import splitting
from quillset.operators.splitting import assign_splits, count_splits, split_sizes

GOLDEN = {
    0: (0, 0, 0), 1: (1, 0, 0), 2: (2, 0, 0), 4: (4, 0, 0), 5: (4, 0, 1), 9: (7, 1, 1), 10: (8, 1, 1), 11: (8, 1, 2),
    20: (16, 2, 2), 100: (80, 10, 10),
}


def numbered(spark, n):
    return spark.range(n).select(F.col("id").cast("string").alias("id"), F.concat(F.lit("t"), "id").alias("title"))


def sizes(df):
    found = {r.split: r.rows for r in count_splits(df).collect()}
    return tuple(found.get(s, 0) for s in ("train", "val", "test"))


def test_golden_sizes(spark):
    df = spark.createDataFrame([(n,) for n in GOLDEN], "n long")
    found = df.select("n", *[c.alias(s) for s, c in split_sizes(F.col("n")).items()]).collect()
    assert {r.n: (r.train, r.val, r.test) for r in found} == GOLDEN


def test_one_sided_and_empty_shares(spark):
    df = spark.createDataFrame([(10,)], "n long")

    def computed(test, val):
        return tuple(df.select(*split_sizes(F.col("n"), test, val).values()).first())

    assert computed(0.0, 0.0) == (10, 0, 0)
    assert computed(0.2, 0.0) == (8, 0, 2)
    assert computed(0.0, 0.2) == (8, 2, 0)


@pytest.mark.parametrize("n", [0, 2, 5, 11, 1000])
def test_assignment_is_exact(spark, n):
    split = assign_splits(numbered(spark, n))
    assert sizes(split) == GOLDEN.get(n, (800, 100, 100))
    assert split.select("id").distinct().count() == n


def test_assignment_is_the_rank_by_seeded_hash(spark):
    ranked = sorted(range(200), key=lambda i: hashlib.md5(f"7/{len(str(i))}:{i}{len(str(i)) + 1}:t{i}".encode()).hexdigest())
    expected = {str(i): "train" if r < 160 else "val" if r < 180 else "test" for r, i in enumerate(ranked)}
    for partitions in (1, 7):
        shuffled = numbered(spark, 200).repartition(partitions).orderBy(F.rand())
        assert {r.id: r.split for r in assign_splits(shuffled, seed=7).collect()} == expected


def test_crowded_prefixes_are_refined(spark, monkeypatch):
    expected = {r.id: r.split for r in assign_splits(numbered(spark, 3000)).collect()}
    monkeypatch.setattr(splitting, "PREFIX_CHARS", 1)
    monkeypatch.setattr(splitting, "SORTABLE_ROWS", 3)
    assert {r.id: r.split for r in assign_splits(numbered(spark, 3000)).collect()} == expected


def test_seed_changes_members_only(spark):
    one, two = (assign_splits(numbered(spark, 100), seed=s) for s in (1, 2))
    assert sizes(one) == sizes(two) == (80, 10, 10)
    assert {r.id for r in one.where("split = 'test'").collect()} != {r.id for r in two.where("split = 'test'").collect()}


def test_repeated_key_is_refused(spark, monkeypatch):
    same = spark.range(10).select(F.lit("x").alias("id"), F.lit("t").alias("title"))
    with pytest.raises(ValueError):
        assign_splits(same)
    monkeypatch.setattr(splitting, "SORTABLE_ROWS", 3)
    with pytest.raises(ValueError):
        assign_splits(same)


def test_parts_of_the_key_do_not_run_together(spark):
    rows = [("a:b", "c"), ("a", "b:c"), ("a", None), (None, "a"), ("", "a"), ("a", ""), ("1:a", "x"), ("1", ":ax")]
    keyed = spark.createDataFrame(rows, "id string, title string")
    hashes = keyed.select(splitting._split_hash(1, ["id", "title"]).alias("h"))
    assert hashes.distinct().count() == len(rows)
