"""ROUGE (Lin 2004) between predictions and references."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator
from itertools import chain

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillset.functions.lcs import lcs_size, union_lcs_hits
from quillset.functions.stemming import stem, stemmer
from quillset.functions.text import bound, strip
from quillset.session import with_computed

# What counts as a token, how lines are separated, and how scores are reported.
ROUGE_TOKEN = "[a-z0-9]+"
LINE_SEPARATOR = "\n"
SCORE_DECIMALS = 2
SIDES = ("prediction", "reference")
METRICS = ("rouge1", "rouge2", "rougeL", "rougeLsum")
SUBSEQUENCES = ("rougeL", "rougeLsum")

# Up to so many n-grams that a pair shares are counted one by one.
FEW_SHARED = 64


def eval_pairs(predictions: DataFrame, references: DataFrame, key: str = "id") -> DataFrame:
    """Each reference with the prediction of the same key. Keys must be unique on both sides.

    A reference without a prediction stays and scores 0; a prediction without a reference has nothing to be held against.
    """
    return references.select(key, "reference").join(predictions.select(key, "prediction"), key, "left")


def rouge_tokens(text: Column, stemmed: bool = False) -> Column:
    tokens = F.regexp_extract_all(F.lower(text), F.lit(ROUGE_TOKEN), F.lit(0))
    return F.transform(tokens, stem) if stemmed else tokens


def _ngrams(tokens: Column, n: int) -> Column:
    """Runs of ``n`` tokens joined by a space, by zipping the array with its own tails."""
    grams = F.slice(tokens, F.lit(1), F.greatest(F.size(tokens) - (n - 1), F.lit(0)))
    for offset in range(1, n):
        tail = F.slice(tokens, F.lit(offset + 1), F.greatest(F.size(tokens) - (n - 1), F.lit(0)))
        grams = F.zip_with(grams, tail, lambda a, b: F.concat(a, F.lit(" "), b))
    return grams


def _scores(overlap: Column, predicted: Column, expected: Column) -> list[Column]:
    precision = F.when(predicted > 0, overlap / predicted).otherwise(F.lit(0.0))
    recall = F.when(expected > 0, overlap / expected).otherwise(F.lit(0.0))
    # 2PR / (P + R) with the common factors cancelled.
    f1 = F.when(overlap > 0, 2 * overlap / (predicted + expected)).otherwise(F.lit(0.0))
    return [precision.alias("precision"), recall.alias("recall"), f1.alias("f1")]


def _shared_ngrams(one: list[str], other: list[str], n: int) -> int:
    """How many n-grams two lists of tokens share, each as often as both hold it."""
    few, many = [zip(*(tokens[i:] for i in range(n))) for tokens in sorted((one, other), key=len)]
    counts = Counter(few)
    return (counts & Counter(gram for gram in many if gram in counts)).total()


def _pair_counts(metrics: tuple[str, ...], stemmed: bool):
    """The sizes of both texts and the overlap of each metric, from lower-case texts, one pair after the other."""
    names = [*[f"{side}_size" for side in SIDES], *metrics]

    def lines(text: str, stems: Callable[[list[str]], list[str]] | None) -> list[list[str]]:
        # No token spans two lines, so one after the other they are the tokens of the text.
        found = [re.findall(ROUGE_TOKEN, line) for line in text.split(LINE_SEPARATOR)]
        return [stems(line) for line in found] if stems else found

    def overlap(metric: str, predicted: list[list[str]], expected: list[list[str]], whole: list[list[str]]) -> int:
        if metric == "rougeLsum":
            return union_lcs_hits(expected, predicted)
        return lcs_size(whole[1], whole[0]) if metric == "rougeL" else _shared_ngrams(*whole, _size(metric))

    def counts(predicted: list[list[str]], expected: list[list[str]]) -> list[int]:
        whole = [list(chain.from_iterable(side)) for side in (predicted, expected)]
        return [*map(len, whole), *[overlap(m, predicted, expected, whole) for m in metrics]]

    @F.pandas_udf(", ".join(f"{name} long" for name in names))
    def counted(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        stems = stemmer() if stemmed else None
        for prediction, reference in batches:
            rows = [counts(lines(p, stems), lines(r, stems)) for p, r in zip(prediction, reference)]
            yield pd.DataFrame(rows, columns=names, dtype="int64")

    return counted


def _size(metric: str) -> int:
    return int(metric.removeprefix("rouge"))


def _again(grams: Column) -> Column:
    """The second and later occurrences of each n-gram, as the n-gram and a number: sorted, equal ones lie together."""

    def numbered(s: Column) -> Column:
        starts = F.array_compact(F.transform(s, lambda gram, i: F.when((i == 0) | (gram != F.get(s, i - 1)), i)))

        def runs(first: Column) -> Column:
            ends = F.concat(F.slice(first, F.lit(2), F.size(first)), F.array(F.size(s)))
            found = F.zip_with(first, ends, lambda at, end: F.struct(at.alias("at"), (end - at).alias("n")))
            return F.flatten(
                F.transform(
                    F.filter(found, lambda run: run.n > 1),
                    lambda run: F.transform(
                        F.sequence(F.lit(2), run.n), lambda k: F.concat(F.get(s, run["at"]), F.lit(" "), k.cast("string"))
                    ),
                )
            )

        return bound(starts, runs)

    return bound(F.sort_array(grams), numbered)


def _times(grams: Column, gram: Column) -> Column:
    return F.size(grams) - F.size(F.array_remove(grams, gram))


def _shared(one: Column, other: Column) -> Column:
    """How many n-grams two arrays share, each as often as both hold it. A few are looked up; else both sides are sorted."""

    def counted(both: Column) -> Column:
        looked_up = F.aggregate(both, F.lit(0), lambda n, g: n + F.least(_times(one, g), _times(other, g)))
        return F.when(F.size(both) <= FEW_SHARED, looked_up).otherwise(
            F.size(both) + F.size(F.array_intersect(_again(one), _again(other)))
        )

    return bound(F.array_intersect(one, other), counted)


def _ngram_overlap(n: int) -> Column:
    return bound(_ngrams(F.col("prediction"), n), lambda p: bound(_ngrams(F.col("reference"), n), lambda r: _shared(p, r)))


def rouge_scores(
    pairs: DataFrame, metrics: tuple[str, ...] = METRICS, stemmed: bool = True, key: str = "id"
) -> DataFrame:
    """Precision, recall and F1, one row per pair and metric.

    Keys must be unique and not null: where n-grams are counted, others are found and raise.

    Texts are shuffled once, by key, and tokenized once for all metrics. The n-grams of a pair are counted inside its
    row, in sorted arrays, so none of them becomes a row. Common subsequences ask for Python; with them the texts go there
    once, and all metrics are counted there, with stems that a task remembers. What is left of a pair are a few numbers;
    Python loses the partitioning, so these numbers are dealt out by key once more.
    """
    # A given number of partitions keeps the work on tokens spread, however few bytes the texts have.
    partitions = int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    texts = pairs.select(key, F.array("prediction", "reference").alias("texts")).repartition(partitions, key)
    ngram_sizes = {metric: _size(metric) for metric in metrics if metric not in SUBSEQUENCES}
    if len(ngram_sizes) < len(metrics):
        sides = [F.lower(F.coalesce(strip(F.col("texts")[i]), F.lit(""))) for i in range(len(SIDES))]
        counted = texts.select(key, _pair_counts(metrics, stemmed)(*sides).alias("counts")).select(key, "counts.*")
    else:
        whole = [rouge_tokens(F.coalesce(F.col("texts")[i], F.lit("")), stemmed) for i in range(len(SIDES))]
        counted = with_computed(texts, **dict(zip(SIDES, whole))).select(
            key,
            *[F.size(side).alias(f"{side}_size") for side in SIDES],
            *[_ngram_overlap(n).cast("bigint").alias(metric) for metric, n in ngram_sizes.items()],
        )
    if ngram_sizes:
        numbers = [F.first(c).alias(c) for c in counted.columns if c != key]
        counted = counted.groupBy(key).agg(*numbers, F.count(F.lit(1)).alias("pairs"))
        unique = (F.col("pairs") == 1) & F.col(key).isNotNull()
        shown = F.coalesce(F.col(key).cast("string"), F.lit("null"))
        said = F.concat(F.lit("no score for a key that is null or repeated: "), shown)
        checked = {m: F.when(unique, F.col(m)).otherwise(F.raise_error(said).cast("bigint")) for m in metrics}
        counted = counted.withColumns(checked)
    entries = []
    for metric in metrics:
        less = ngram_sizes.get(metric, 1) - 1
        sizes = [F.greatest(F.col(f"{side}_size") - less, F.lit(0)).cast("bigint") for side in SIDES]
        names = ("metric", "predicted", "expected", "overlap")
        values = (F.lit(metric), *sizes, F.col(metric))
        entries.append(F.struct(*[value.alias(name) for name, value in zip(names, values)]))
    spread = counted.select(key, F.inline(F.array(*entries)))
    scores = _scores(F.col("overlap"), F.col("predicted"), F.col("expected"))
    return spread.select(key, "metric", *scores)


def corpus_scores(scores: DataFrame, score: str = "f1") -> DataFrame:
    """Mean per metric times 100; ``scores`` may come from any metric function in long form."""
    return scores.groupBy("metric").agg(F.round(F.avg(score) * 100, SCORE_DECIMALS).alias("value"))
