"""Counts reported by the preparation and labelling stages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillset.functions.dates import parse_published, parse_range
from quillset.functions.text import clean_abstract, word_count
from quillset.operators.papers import in_date_range, is_present
from quillset.operators.splitting import split_sizes
from quillset.schemas import MIN_ABSTRACT_WORDS, TEST_SIZE, VAL_SIZE
from quillset.session import with_computed


def prep_stats(
    raw: DataFrame,
    date_range: str | None = None,
    min_words: int = MIN_ABSTRACT_WORDS,
    test_size: float = TEST_SIZE,
    val_size: float = VAL_SIZE,
) -> DataFrame:
    """One row of counts for a preparation run; ``raw`` counts papers left after dropping empty ones.

    A single pass that shuffles titles with their counters, pre-aggregated per map task: the rows that
    survive deduplication are the titles with at least one paper that passes the filters.
    """
    cleaned = with_computed(raw, abstract=clean_abstract(F.col("abstract")))
    moment = parse_published(F.col("published")) if parse_range(date_range) else F.lit(None).cast("timestamp_ntz")
    counted = with_computed(cleaned, abs_words=word_count(F.col("abstract")), moment=moment)
    in_range = in_date_range(F.col("moment"), date_range)
    passes = is_present() & (F.col("abs_words") >= min_words) & in_range
    flagged = counted.select("title", is_present().alias("present"), passes.alias("kept"))
    per_title = flagged.groupBy("title").agg(
        F.count(F.lit(1)).alias("rows"), F.count_if("present").alias("present"), F.count_if("kept").alias("kept")
    )
    totals = per_title.agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("input_rows"),
        F.coalesce(F.sum("present"), F.lit(0)).alias("raw"),
        F.count_if(F.col("kept") > 0).alias("after_filters"),
    )
    sizes = split_sizes(F.col("after_filters"), test_size, val_size)
    return totals.select("*", *[size.alias(name) for name, size in sizes.items()])


def generation_stats(
    labelled: DataFrame, by: str = "split", expected: Sequence[str] = (), total: str = "all"
) -> DataFrame:
    """Counts, success rate and mean length of the summaries as generated, before any fallback.

    One row per split and one over all of them, named ``total``, from one pass over the rows. Each ``expected`` split has
    its row, and a split without papers, or a table without any, has zeros. Rows without a split are a group of their own.
    """

    def filled(name: str) -> Column:
        return F.coalesce(F.col(name) != "", F.lit(False)) if name in labelled.columns else F.lit(False)

    if total in expected:
        raise ValueError(f"no split can be named {total}, as the total is")
    has_summary = filled("summary")
    length = F.when(has_summary, word_count(F.col("summary"))).alias("length")
    flags = [has_summary.alias("summary"), filled("methods").alias("methods"), filled("results").alias("results")]
    counts = labelled.select(F.col(by).cast("string").alias(by), *flags, length).rollup(by).agg(
        F.grouping(by).cast("boolean").alias("is_total"),
        F.count(F.lit(1)).alias("total_papers"),
        F.count_if("summary").alias("valid_summaries"),
        F.count_if("methods").alias("valid_methods"),
        F.count_if("results").alias("valid_results"),
        F.avg("length").alias("avg_summary_length"),
    )
    counts = counts.withColumn(by, F.when(F.col("is_total"), F.lit(total)).otherwise(F.col(by)))
    wanted = [(name, False) for name in dict.fromkeys(expected)] + [(total, True)]
    wanted = labelled.sparkSession.createDataFrame(wanted, f"`{by}` string, is_total boolean")
    whole = counts.join(wanted, [by, "is_total"], "full").drop("is_total")
    numbers = ["total_papers", "valid_summaries", "valid_methods", "valid_results"]
    return whole.select(
        by,
        *[F.coalesce(c, F.lit(0)).alias(c) for c in numbers],
        F.coalesce("avg_summary_length", F.lit(0.0)).alias("avg_summary_length"),
        F.coalesce(F.try_divide("valid_summaries", "total_papers"), F.lit(0.0)).alias("summary_success_rate"),
    )
