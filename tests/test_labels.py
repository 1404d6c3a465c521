import os

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quillset.operators.examples import training_examples
from quillset.operators.labels import (
    HELD_BYTES,
    _rows_at_once,
    attach_labels,
    fill_fallback,
    filter_labelled,
    filter_labelled_stats,
    label_papers,
)
from quillset.operators.stats import generation_stats

LONG = "One two three four five six. Seven eight nine ten eleven. Twelve thirteen! Never part of it."


def papers(spark, *abstracts):
    return spark.createDataFrame([(str(i), a) for i, a in enumerate(abstracts)], "id string, abstract string")


def by_id(df):
    return {r.id: r for r in df.collect()}


def test_native_labels(spark):
    found = by_id(label_papers(papers(spark, LONG, "x" * 49, "x" * 60)))
    assert found["0"].summary == "One two three four five six. Seven eight nine ten eleven. Twelve thirteen."
    assert found["0"].methods.startswith("One two")
    assert found["0"].results.startswith("One two")
    for i in ("1", "2"):
        assert (found[i].summary, found[i].methods, found[i].results) == (None, None, None)


def test_skipped_fields_leave_no_column(spark):
    labelled = label_papers(papers(spark, LONG), include_methods=False, include_results=False)
    assert labelled.columns == ["id", "abstract", "summary", "label_error"]


def counting_model(folder):
    """A factory whose model logs every text it sees, fails on some, and pads its output."""

    def load():
        def predict(texts):
            if any("bad" in t for t in texts):
                raise RuntimeError("cannot")
            for t in texts:
                with open(os.path.join(folder, "seen"), "a") as log:
                    log.write(t + "\n")
            return [" " + " ".join(t.split()[:12]) + " " for t in texts]

        return predict

    return load


def test_model_labels_survive_bad_rows_and_run_once(spark, tmp_path):
    bad = "bad " + LONG
    labelled = label_papers(papers(spark, LONG, bad, "short", LONG + " again"), counting_model(str(tmp_path)), 4)
    found = by_id(labelled.where("id is not null"))
    assert found["0"].summary == " ".join(LONG.split()[:12])
    assert found["0"].methods == "Extract the research methods used: " + " ".join(LONG.split()[:7])
    assert (found["1"].summary, found["1"].label_error) == (None, "RuntimeError: cannot")
    assert (found["2"].summary, found["2"].label_error) == (None, None)
    assert found["3"].label_error is None
    seen = (tmp_path / "seen").read_text().splitlines()
    assert len(seen) == len(set(seen)) == 6


def test_model_of_wrong_arity_is_an_error(spark):
    labelled = label_papers(papers(spark, LONG), lambda: lambda texts: [])
    assert by_id(labelled)["0"].label_error.startswith("ValueError")


def test_fallback_fills_null_and_empty_but_not_blank(spark):
    df = spark.createDataFrame([("a", "A. B.", None), ("b", "A. B.", ""), ("c", "A. B.", " ")], "id string, abstract string, summary string")
    assert {k: r.summary for k, r in by_id(fill_fallback(df)).items()} == {"a": "A. B.", "b": "A. B.", "c": " "}


def labelled(spark):
    return spark.createDataFrame(
        [("a", "x", "one two three", "m", None), ("b", "x", None, None, None), ("c", "x", " ", "", "r"), ("d", "y", "", None, None)],
        "id string, split string, summary string, methods string, results string",
    )


def test_label_filter_and_counts(spark):
    assert set(by_id(filter_labelled(labelled(spark)))) == {"a"}
    stats = {r.split: (r.total, r.kept) for r in filter_labelled_stats(labelled(spark)).collect()}
    assert stats == {"x": (3, 1), "y": (1, 0)}


def test_generation_stats(spark):
    stats = {r.split: r.asDict() for r in generation_stats(labelled(spark)).collect()}
    assert stats["x"] == {
        "split": "x", "total_papers": 3, "valid_summaries": 2, "valid_methods": 1, "valid_results": 1,
        "avg_summary_length": 1.5, "summary_success_rate": 2 / 3,
    }
    assert (stats["y"]["summary_success_rate"], stats["y"]["avg_summary_length"]) == (0.0, 0.0)
    assert generation_stats(labelled(spark).drop("methods")).where("valid_methods > 0").count() == 0


def test_attach_labels(spark):
    stored = spark.createDataFrame([("a", "s")], "id string, summary string")
    found = by_id(attach_labels(labelled(spark).select("id"), stored))
    assert {k: r.summary for k, r in found.items()} == {"a": "s", "b": None, "c": None, "d": None}


def test_training_examples(spark):
    df = spark.createDataFrame([("1", "a b, c", "x.", 5), ("2", "w " * 600, None, 5)], "id string, abstract string, summary string, extra int")
    found = by_id(training_examples(df))
    assert found["1"].asDict() == {
        "id": "1", "input_ids": ["a", "b", ",", "c"], "attention_mask": [1, 1, 1, 1], "labels": ["x", "."],
        "input_len": 4, "target_len": 2, "truncated": False,
    }
    assert (found["2"].input_len, found["2"].target_len, found["2"].truncated) == (512, 0, True)
    with pytest.raises(ValueError):
        training_examples(df.drop("summary"))


def test_training_examples_with_tokenizer(spark):
    df = spark.createDataFrame([("1", "aa b ccc", "dd")], "id string, abstract string, summary string")
    found = training_examples(df, lambda: lambda texts: [[len(w) for w in t.split()] for t in texts], max_input=2).first()
    assert (found.input_ids, found.labels, found.truncated) == ([2, 1], [2], True)


def test_filters_do_not_run_the_model_again(spark, tmp_path):
    labelled_papers = label_papers(papers(spark, LONG), counting_model(str(tmp_path)), include_results=False)
    kept = filter_labelled(labelled_papers).where(F.col("methods").isNotNull())
    assert kept.count() == 1
    assert len((tmp_path / "seen").read_text().splitlines()) == 2


def test_few_texts_of_a_batch_are_held_at_once():
    rows = pa.array([["a" * (HELD_BYTES // 3), None]] * 7 + [[None], [], ["b" * (2 * HELD_BYTES)], None, ["c"]])
    sizes = []
    while len(rows):
        sizes.append(_rows_at_once(rows))
        rows = rows.slice(sizes[-1])
    assert sizes == [3, 3, 3, 1, 2]
    assert _rows_at_once(pa.array([[None], []], pa.list_(pa.string()))) == 2
