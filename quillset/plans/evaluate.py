"""Predictions and references to corpus scores."""

from __future__ import annotations

from pyspark.sql import DataFrame

from quillset.operators.rouge import corpus_scores, eval_pairs, rouge_scores


def evaluate_predictions(predictions: DataFrame, references: DataFrame, key: str = "id") -> DataFrame:
    """Mean F1 per metric times 100, with stemming."""
    return corpus_scores(rouge_scores(eval_pairs(predictions, references, key), stemmed=True, key=key))
