"""Latest raw snapshot to stored splits."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quillset.operators.papers import prepare_papers
from quillset.operators.splitting import assign_splits
from quillset.operators.stats import prep_stats
from quillset.schemas import MIN_ABSTRACT_WORDS, SEED, TEST_SIZE, VAL_SIZE
from quillset.sources.jsonl import latest_snapshot, read_jsonl
from quillset.sources.splits import save_splits


def prepare_dataset(
    spark: SparkSession,
    raw_dir: str,
    out_dir: str,
    date_range: str | None = None,
    min_words: int = MIN_ABSTRACT_WORDS,
    test_size: float = TEST_SIZE,
    val_size: float = VAL_SIZE,
    seed: int = SEED,
) -> DataFrame:
    """Write the splits and return the counts as a lazy one-row table."""
    raw = read_jsonl(spark, latest_snapshot(spark, raw_dir))
    papers = prepare_papers(raw, date_range, min_words)
    save_splits(assign_splits(papers, test_size, val_size, seed), out_dir)
    return prep_stats(raw, date_range, min_words, test_size, val_size)
