"""Stored splits to labelled splits, and on to those that have a label."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillset.operators.examples import TokenizerFactory, training_examples
from quillset.operators.labels import (
    BATCH_SIZE,
    PredictorFactory,
    fill_fallback,
    filter_labelled,
    filter_labelled_stats,
    label_papers,
)
from quillset.operators.stats import generation_stats
from quillset.schemas import PREPARED_PAPER, SPLITS
from quillset.session import stage
from quillset.sources.splits import load_splits, load_training_splits, save_splits, split_path


def label_dataset(
    spark: SparkSession,
    out_dir: str,
    splits: list[str] = SPLITS,
    predictor: PredictorFactory | None = None,
    batch_size: int = BATCH_SIZE,
    include_methods: bool = True,
    include_results: bool = True,
    fallback_extractive: bool = False,
) -> DataFrame:
    """Label the given splits in one job and return the counts per split.

    Predictions are stored before they are counted and completed, so a model sees each paper once.
    """
    papers = load_splits(spark, {s: split_path(out_dir, s) for s in splits}, PREPARED_PAPER)
    labelled = stage(
        label_papers(papers, predictor, batch_size, include_methods, include_results), "labels"
    )
    completed = fill_fallback(labelled) if fallback_extractive else labelled
    save_splits(completed.drop("label_error"), out_dir, "_with_summaries")
    return generation_stats(labelled).withColumn(
        "output_file", F.concat(F.lit(f"{out_dir}/papers_with_summaries.jsonl/split="), F.col("split"))
    )


def filter_dataset(spark: SparkSession, out_dir: str) -> DataFrame:
    """Keep papers with a summary, write them as the filtered stage, and return the counts per split."""
    labelled = load_splits(spark, {s: split_path(out_dir, s, "_with_summaries") for s in SPLITS})
    save_splits(filter_labelled(labelled), out_dir, "_filtered")
    return filter_labelled_stats(labelled)


def tokenize_split(
    spark: SparkSession, out_dir: str, split: str, tokenizer: TokenizerFactory | None = None
) -> DataFrame:
    """Training examples of one split of the most refined stage on disk."""
    return training_examples(load_training_splits(spark, out_dir).where(F.col("split") == split), tokenizer)
