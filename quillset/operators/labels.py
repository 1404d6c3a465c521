"""Silver labels: summaries, methods and results, generated in batches or extracted natively."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillset.functions.text import (
    MAX_SUMMARY_WORDS,
    MIN_SUMMARY_WORDS,
    extractive_summary,
    is_valid_summary,
    long_enough,
    methods_prompt,
    results_prompt,
    strip,
    strip_to_null,
)
from quillset.session import with_computed

# A predictor factory runs once per Python worker and returns the batch function.
Predict = Callable[[list[str]], list[str | None]]
PredictorFactory = Callable[[], Predict]

BATCH_SIZE = 4

# Bytes of texts that a worker holds as Python texts at once; a batch of Arrow may be longer.
HELD_BYTES = 1 << 20
ANSWERS = pa.struct([("texts", pa.list_(pa.string())), ("errors", pa.list_(pa.string()))])


def _predict_batch(predict: Predict, texts: list[str]) -> list[tuple[str | None, str | None]]:
    """(text, error) per input. When a batch fails, its rows are retried alone so that only bad ones fail."""
    try:
        outputs = predict(texts)
        if len(outputs) != len(texts):
            raise ValueError(f"predictor returned {len(outputs)} texts for {len(texts)}")
        return [(text, None) for text in outputs]
    except Exception as error:
        if len(texts) == 1:
            return [(None, f"{type(error).__name__}: {error}")]
        return [_predict_batch(predict, [text])[0] for text in texts]


def _rows_at_once(rows: pa.Array) -> int:
    """How many of the first rows become Python texts at once: about ``HELD_BYTES``, one at least."""
    flat = rows.flatten()
    if not len(flat):
        return len(rows)
    ends = np.cumsum(pc.fill_null(pc.binary_length(flat), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    texts = int(np.searchsorted(ends, HELD_BYTES, side="right"))
    held = np.cumsum(pc.fill_null(pc.list_value_length(rows), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    return max(1, int(np.searchsorted(held, texts, side="right")))


def _predicted(predict: Predict, rows: list[list[str | None]], batch_size: int) -> pa.Array:
    """What the model says to some rows of texts, and what it raised."""
    texts = [text for row in rows for text in row]
    outputs: list[tuple[str | None, str | None]] = [(None, None)] * len(texts)
    wanted = [i for i, text in enumerate(texts) if text is not None]
    for start in range(0, len(wanted), batch_size):
        chunk = wanted[start : start + batch_size]
        for i, output in zip(chunk, _predict_batch(predict, [texts[i] for i in chunk])):
            outputs[i] = output
    remaining = iter(outputs)
    answers = [[next(remaining) for _ in row] for row in rows]
    return pa.array(
        [{"texts": [text for text, _ in row], "errors": [error for _, error in row]} for row in answers], ANSWERS
    )


def predictor_column(factory: PredictorFactory, batch_size: int = BATCH_SIZE) -> Callable[[Column], Column]:
    """A column function running the model over arrays of texts in Arrow batches; nulls are not sent to it."""

    @F.arrow_udf("texts array<string>, errors array<string>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        predict = factory()
        for batch in batches:
            done = []
            while len(batch):
                size = _rows_at_once(batch)
                done.append(_predicted(predict, batch.slice(0, size).to_pylist(), batch_size))
                batch = batch.slice(size)
            yield pa.concat_arrays(done) if done else pa.array([], ANSWERS)

    # Marked nondeterministic so that no optimisation runs the model twice on a row.
    return run.asNondeterministic()


def extractive_column(texts: Column) -> Column:
    """The native stand-in for a model: same shape, never an error."""
    no_errors = F.transform(texts, lambda _: F.lit(None).cast("string"))
    return F.struct(F.transform(texts, lambda text: extractive_summary(text)).alias("texts"), no_errors.alias("errors"))


def label_papers(
    papers: DataFrame,
    predictor: PredictorFactory | None = None,
    batch_size: int = BATCH_SIZE,
    include_methods: bool = True,
    include_results: bool = True,
    min_words: int = MIN_SUMMARY_WORDS,
    max_words: int = MAX_SUMMARY_WORDS,
) -> DataFrame:
    """Add ``summary``, ``methods`` and ``results``.

    Short abstracts get no summary, invalid summaries become null, and the other two are only asked for,
    together, where the summary is valid. Without a predictor the first sentences of the abstract are extracted for all of
    them, no prompt is among them, and no Python worker starts. With one, ``label_error`` holds what it raised for a row; store the result
    before deriving anything from it, or the model runs again.
    """
    source = F.col("abstract")
    guarded = F.array(F.when(long_enough(source), source))
    if predictor is None:
        predict = extractive_column
        drafted = with_computed(papers, _draft=predict(guarded))
    else:
        predict = predictor_column(predictor, batch_size)
        drafted = papers.withColumn("_draft", predict(guarded))
    draft = F.col("_draft.texts")[0]
    summary = F.when(is_valid_summary(draft, min_words, max_words), strip(draft))
    labelled = drafted.withColumn("summary", summary)
    error = F.col("_draft.errors")[0]

    prompts = {}
    if include_methods:
        prompts["methods"] = methods_prompt(source)
    if include_results:
        prompts["results"] = results_prompt(source)
    if prompts:
        questions = prompts.values() if predictor is not None else [source] * len(prompts)  # sentences answer no prompt
        asked = F.array(*[F.when(F.col("summary").isNotNull(), question) for question in questions])
        labelled = labelled.withColumn("_answers", predict(asked))
        for i, name in enumerate(prompts):
            labelled = labelled.withColumn(name, strip_to_null(F.col("_answers.texts")[i]))
            error = F.coalesce(error, F.col("_answers.errors")[i])
    return labelled.select(*papers.columns, "summary", *prompts, error.alias("label_error"))


def fill_fallback(labelled: DataFrame) -> DataFrame:
    """Extract a summary where there is none. A blank one counts as present; the result is not validated."""
    missing = F.col("summary").isNull() | (F.col("summary") == "")
    filled = F.when(missing, extractive_summary(F.col("abstract"))).otherwise(F.col("summary"))
    return labelled.withColumn("summary", filled)


def attach_labels(papers: DataFrame, labels: DataFrame, key: str = "id") -> DataFrame:
    """Labels stored apart, joined back by key; papers without one keep nulls."""
    return papers.join(labels, key, "left")


def has_label() -> Column:
    return F.coalesce(strip(F.col("summary")) != "", F.lit(False))


def filter_labelled(labelled: DataFrame) -> DataFrame:
    return labelled.where(has_label())


def filter_labelled_stats(labelled: DataFrame, by: str = "split") -> DataFrame:
    """Papers before and after the label filter; ``kept`` of 0 is a split that would be empty."""
    return labelled.groupBy(by).agg(F.count(F.lit(1)).alias("total"), F.count_if(has_label()).alias("kept"))
