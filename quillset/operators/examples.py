"""Training examples: token arrays cut to the lengths a model accepts."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillset.session import with_computed

# The lengths a training job uses and the default tokens, words or single other signs.
MAX_INPUT_TOKENS = 512
MAX_TARGET_TOKENS = 128
TOKEN = r"[\p{L}\p{N}_]+|[^\p{L}\p{N}_\s]"


@dataclass(frozen=True)
class Task:
    """What a model is taught: a target column, what is put before the input, and how much an example counts."""

    name: str
    target: str
    prefix: str = ""
    weight: float = 1.0
    enabled: bool = True


# Names, target columns, prefixes and weights of the tasks.
TASKS = [
    Task("summarization", "summary"),
    Task("method_extraction", "methods", "extract methods: ", 0.5),
    Task("result_extraction", "results", "extract results: ", 0.5),
]

TokenizerFactory = Callable[[], Callable[[list[str]], list[list[int]]]]


def word_tokens(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(TOKEN), F.lit(0))


def tokenizer_column(factory: TokenizerFactory) -> Callable[[Column], Column]:
    """A column function over Arrow batches; the tokenizer is built once per Python worker."""

    @F.pandas_udf("array<int>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encode = factory()
        for batch in batches:
            yield pd.Series(encode(batch.tolist()), index=batch.index, dtype=object)

    return run


def training_examples(
    labelled: DataFrame,
    tokenizer: TokenizerFactory | None = None,
    max_input: int = MAX_INPUT_TOKENS,
    max_target: int = MAX_TARGET_TOKENS,
    input_column: str = "abstract",
    target_column: str = "summary",
    key: str = "id",
) -> DataFrame:
    """Key, truncated input and target tokens, attention mask and lengths; all other columns go.

    A missing text has no tokens.
    """
    absent = [c for c in (input_column, target_column) if c not in labelled.columns]
    if absent:
        raise ValueError(f"missing {absent}: label the papers first")
    tokens = word_tokens if tokenizer is None else tokenizer_column(tokenizer)
    texts = labelled.select(
        key,
        F.coalesce(F.col(input_column), F.lit("")).alias("_input"),
        F.coalesce(F.col(target_column), F.lit("")).alias("_target"),
    )
    tokenized = with_computed(texts, _input=tokens(F.col("_input")), _target=tokens(F.col("_target")))
    cut = tokenized.select(
        key,
        F.slice("_input", 1, max_input).alias("input_ids"),
        F.slice("_target", 1, max_target).alias("labels"),
        ((F.size("_input") > max_input) | (F.size("_target") > max_target)).alias("truncated"),
    )
    return cut.select(
        key,
        "input_ids",
        F.transform("input_ids", lambda _: F.lit(1)).alias("attention_mask"),
        "labels",
        F.size("input_ids").alias("input_len"),
        F.size("labels").alias("target_len"),
        "truncated",
    )


def multitask_examples(
    labelled: DataFrame, tasks: Sequence[Task] = TASKS, input_column: str = "abstract", key: str = "id"
) -> DataFrame:
    """(key, task, input, target, weight): a row per paper and enabled task whose target is there.

    One pass: each paper generates its rows in place. Blank targets are targets; null inputs are empty.
    """
    used = [t for t in tasks if t.enabled]
    absent = sorted({input_column, *(t.target for t in used)} - set(labelled.columns))
    if absent:
        raise ValueError(f"missing {absent}: label the papers first")
    if len({t.name for t in used}) < len(used):
        raise ValueError("two enabled tasks have one name")
    source = F.coalesce(F.col(input_column), F.lit(""))
    rows = [
        F.struct(
            F.lit(t.name).alias("task"),
            F.concat(F.lit(t.prefix), source).alias("input"),
            F.col(t.target).cast("string").alias("target"),
            F.lit(float(t.weight)).alias("weight"),
        )
        for t in used
    ]
    kind = "array<struct<task: string, input: string, target: string, weight: double>>"
    made = labelled.select(key, F.inline(F.array(*rows).cast(kind)))
    return made.filter(F.col("target").isNotNull())


PERCENTILES = (50, 90, 95, 99)


def token_lengths(
    labelled: DataFrame,
    tokenizer: TokenizerFactory | None = None,
    max_input: int = MAX_INPUT_TOKENS,
    max_target: int = MAX_TARGET_TOKENS,
    input_column: str = "abstract",
    target_column: str = "summary",
    by: str = "split",
) -> DataFrame:
    """Lengths of inputs and targets before truncation, by split: how many, mean, percentiles, longest, and how many are
    cut at the limits.

    The rows become a histogram of lengths, a partial aggregate that merges; percentiles are exact (the least length that
    so many per cent of the examples do not exceed) and come from its running sums. No row is sorted. A missing text has
    length 0.
    """
    absent = [c for c in (input_column, target_column, by) if c not in labelled.columns]
    if absent:
        raise ValueError(f"missing {absent}: label the papers first")
    tokens = word_tokens if tokenizer is None else tokenizer_column(tokenizer)
    sides = [("input", input_column, max_input), ("target", target_column, max_target)]

    def length(column: str) -> Column:
        return F.size(tokens(F.coalesce(F.col(column), F.lit(""))))

    sizes = [
        F.struct(F.lit(side).alias("side"), length(c).alias("length"), F.lit(most).alias("most"))
        for side, c, most in sides
    ]
    rows = labelled.select(F.col(by), F.inline(F.array(*sizes)))
    histogram = rows.groupBy(by, "side", "most", "length").agg(F.count(F.lit(1)).alias("n"))
    group = Window.partitionBy(by, "side", "most")
    reached = F.sum("n").over(group.orderBy("length").rowsBetween(Window.unboundedPreceding, 0))
    running = histogram.withColumns({"reached": reached, "total": F.sum("n").over(group)})
    cut = F.sum(F.when(F.col("length") > F.col("most"), F.col("n")).otherwise(0))
    report = running.groupBy(by, "side").agg(
        F.sum("n").alias("examples"),
        (F.sum(F.col("n") * F.col("length")) / F.sum("n")).alias("mean_length"),
        *[
            F.min(F.when(F.col("reached") >= F.ceil(F.col("total") * p / 100), F.col("length"))).alias(f"p{p}")
            for p in PERCENTILES
        ],
        F.max("length").alias("longest"),
        cut.alias("truncated"),
    )
    return report.withColumn("truncation_rate", F.col("truncated") / F.col("examples"))
