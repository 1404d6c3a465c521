"""Examples for several tasks, reports on lengths, and totals over splits."""

import math
import random

import pytest

from quillset.operators.examples import Task, multitask_examples, token_lengths
from quillset.operators.stats import generation_stats

SCHEMA = "id int, abstract string, summary string, methods string, results string, split string"


def labelled(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def test_one_row_per_paper_and_target(spark):
    rows = [(1, "text", "s", "m", None, "train"), (2, None, "", None, "r", "val"), (3, "x", None, None, None, None)]
    got = sorted(tuple(r) for r in multitask_examples(labelled(spark, rows)).collect())
    assert got == [
        (1, "method_extraction", "extract methods: text", "m", 0.5),
        (1, "summarization", "text", "s", 1.0),
        (2, "result_extraction", "extract results: ", "r", 0.5),
        (2, "summarization", "", "", 1.0),
    ]


def test_task_tables(spark):
    papers = labelled(spark, [(1, "text", "s", "m", "r", "train")])
    off = [Task("a", "summary"), Task("b", "absent", enabled=False)]
    assert [r.task for r in multitask_examples(papers, off).collect()] == ["a"]
    assert multitask_examples(papers, [Task("b", "absent", enabled=False)]).count() == 0
    with pytest.raises(ValueError, match="absent"):
        multitask_examples(papers, [Task("b", "absent")])
    with pytest.raises(ValueError, match="one name"):
        multitask_examples(papers, [Task("a", "summary"), Task("a", "methods")])


def test_a_paper_is_read_once(spark, tmp_path):
    path = str(tmp_path / "papers")
    labelled(spark, [(1, "text", "s", "m", "r", "train")]).write.parquet(path)
    plan = multitask_examples(spark.read.parquet(path))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Exchange" not in plan


def test_lengths_against_sorted_lists(spark):
    rng = random.Random(3)
    rows = []
    for i in range(400):
        split = rng.choice(["train", "train", "val", None])
        texts = [rng.choice([None, "", "w " * rng.randint(0, 30), "w, " * 300]) for _ in range(2)]
        rows.append((i, texts[0], texts[1], None, None, split))
    got = {(r.split, r.side): r for r in token_lengths(labelled(spark, rows), max_input=20, max_target=10).collect()}
    assert len(got) == 6
    for (split, side), r in got.items():
        texts = [row[1 if side == "input" else 2] or "" for row in rows if row[5] == split]
        sizes = sorted(t.count("w") + t.count(",") for t in texts)
        assert (r.examples, r.longest) == (len(sizes), sizes[-1])
        assert math.isclose(r.mean_length, sum(sizes) / len(sizes))
        for p in (50, 90, 95, 99):
            assert r[f"p{p}"] == sizes[math.ceil(len(sizes) * p / 100) - 1]
        most = 20 if side == "input" else 10
        assert r.truncated == sum(n > most for n in sizes) and math.isclose(r.truncation_rate, r.truncated / len(sizes))


def test_lengths_sort_no_rows(spark):
    plan = token_lengths(labelled(spark, []))._jdf.queryExecution().executedPlan().toString()
    first = plan[plan.rindex("HashAggregate") :]
    assert "partial_count" in first and "Sort " not in first
    assert token_lengths(labelled(spark, [])).collect() == []


def test_totals_and_expected_splits(spark):
    rows = [(i, "x", "a b c" if i % 3 else None, "m" if i % 2 else "", None, ["train", "val", None][i % 3]) for i in range(30)]
    got = {r.split: r for r in generation_stats(labelled(spark, rows), expected=["train", "test"]).collect()}
    assert got.keys() == {"train", "val", None, "test", "all"}
    assert (got["test"].total_papers, got["test"].summary_success_rate, got["test"].avg_summary_length) == (0, 0.0, 0.0)
    assert (got["all"].total_papers, got["all"].valid_summaries, got["all"].avg_summary_length) == (30, 20, 3.0)
    assert sum(got[s].valid_methods for s in ("train", "val", None)) == got["all"].valid_methods == 15
    empty = generation_stats(labelled(spark, []), expected=["train"]).collect()
    assert {r.split: r.total_papers for r in empty} == {"train": 0, "all": 0}
    with pytest.raises(ValueError, match="all"):
        generation_stats(labelled(spark, rows), expected=["all"])
