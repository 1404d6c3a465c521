"""The stages one after another, through files."""

from pyspark.sql import functions as F

from quillset.plans.label import filter_dataset, label_dataset, tokenize_split
from quillset.plans.prepare import prepare_dataset
from quillset.schemas import RAW_PAPER
from quillset.sources.jsonl import write_snapshot
from quillset.sources.splits import load_split


def test_from_snapshot_to_tokens(spark, tmp_path):
    raw_dir, out = str(tmp_path / "raw"), str(tmp_path / "out")
    body = "First sentence of this paper has words. Second one too, with more of them. Third! Rest. " + "w " * 60
    rows = [(str(i), f"t{i % 50}", body, ["A"], ["c"], f"2024-01-{i % 28 + 1:02d}", None) for i in range(60)]
    rows += [("e", "", body, None, None, None, None), ("s", "short", "few words", None, None, None, None)]
    rows += [("n", "no sentence", "w " * 150, None, None, None, None)]
    write_snapshot(spark.createDataFrame(rows, RAW_PAPER), raw_dir)

    stats = prepare_dataset(spark, raw_dir, out).first().asDict()
    assert stats == {"input_rows": 63, "raw": 62, "after_filters": 51, "train": 40, "val": 5, "test": 6}
    assert {s: load_split(spark, out, s).count() for s in ("train", "val", "test")} == {"train": 40, "val": 5, "test": 6}

    stats = label_dataset(spark, out)
    totals = stats.where("split = 'all'").select("total_papers", "valid_summaries", "valid_methods").first()
    assert tuple(totals) == (51, 50, 50)
    assert stats.first().output_file.startswith(f"{out}/papers_with_summaries.jsonl/split=")

    kept = filter_dataset(spark, out).agg(F.sum("total"), F.sum("kept")).first()
    assert tuple(kept) == (51, 50)
    tokens = tokenize_split(spark, out, "train")
    assert tokens.where("input_len > 60 and target_len > 10").count() == tokens.count() >= 39


def test_fallback_comes_after_the_counts(spark, tmp_path):
    raw_dir, out = str(tmp_path / "raw"), str(tmp_path / "out")
    rows = [(str(i), f"t{i}", "w " * 150, None, None, None, None) for i in range(10)]
    write_snapshot(spark.createDataFrame(rows, RAW_PAPER), raw_dir)
    prepare_dataset(spark, raw_dir, out)
    stats = label_dataset(spark, out, fallback_extractive=True)
    assert stats.agg(F.sum("valid_summaries")).first()[0] == 0
    assert load_split(spark, out, "train", "_with_summaries").where("length(summary) > 100").count() == 8
