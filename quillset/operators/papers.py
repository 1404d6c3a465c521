"""Building the table of prepared papers: normalise, clean, filter, keep the latest copy."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillset.functions.dates import naive_iso, parse_published, parse_range
from quillset.functions.text import clean_abstract, strip, word_count
from quillset.schemas import MIN_ABSTRACT_WORDS, PAPER_COLUMNS
from quillset.session import with_computed


def normalize_source(results: DataFrame) -> DataFrame:
    """Search results (authors as structs with a name) to raw papers with plain, stripped fields."""
    return results.select(
        "arxiv_id",
        strip(F.coalesce("title", F.lit(""))).alias("title"),
        strip(F.coalesce("abstract", F.lit(""))).alias("abstract"),
        F.transform(F.coalesce("authors", F.array()), lambda a: a["name"]).alias("authors"),
        F.coalesce("categories", F.array()).alias("categories"),
        naive_iso(F.col("published")).alias("published"),
        "pdf_url",
    )


def build_papers(raw: DataFrame) -> DataFrame:
    """Clean and count every abstract, keep the core columns, drop papers with blank title or abstract."""
    cleaned = with_computed(raw, abstract=clean_abstract(F.col("abstract"))).where(is_present())
    counted = with_computed(cleaned, abs_words=word_count(F.col("abstract")))
    return counted.select([c for c in PAPER_COLUMNS if c in counted.columns]).withColumnRenamed("arxiv_id", "id")


def is_present() -> Column:
    """Neither title nor cleaned abstract is blank. A null title passes: only a blank one is empty."""
    return (F.col("title").isNull() | (strip(F.col("title")) != "")) & (F.col("abstract") != "")


def filter_min_words(papers: DataFrame, min_words: int = MIN_ABSTRACT_WORDS) -> DataFrame:
    return papers.where(F.col("abs_words") >= min_words)


def midnight(day: datetime) -> Column:
    """A bound as text, so that neither the zone of the session nor that of the driver process shifts it."""
    return F.lit(day.strftime("%Y-%m-%d 00:00:00")).cast("timestamp_ntz")


def in_date_range(moment: Column, date_range: str | None, end_of_day: bool = False) -> Column:
    """Whether a parsed date lies within ``A..B``. No date fails any range; no separator means no filter.

    The end bound is its midnight; ``end_of_day`` extends it over the whole last day.
    """
    bounds = parse_range(date_range)
    if bounds is None:
        return F.lit(True)
    first, last = bounds
    keep = moment.isNotNull()
    if first:
        keep = keep & (moment >= midnight(first))
    if last and end_of_day:
        keep = keep & (moment < midnight(last + timedelta(days=1)))
    elif last:
        keep = keep & (moment <= midnight(last))
    return F.coalesce(keep, F.lit(False))


def filter_date_range(papers: DataFrame, date_range: str | None, end_of_day: bool = False) -> DataFrame:
    if parse_range(date_range) is None:
        return papers
    parsed = with_computed(papers, _moment=parse_published(F.col("published")))
    return parsed.where(in_date_range(F.col("_moment"), date_range, end_of_day)).drop("_moment")


def dedup_latest(papers: DataFrame, nulls: str = "newest") -> DataFrame:
    """One paper per title, the one published last as text; null titles count as one title.

    A null date beats any other unless ``nulls="oldest"``. Equal dates are settled by id, then abstract.
    Spark keeps one row per title and map task before the shuffle, so a title shared by a large part
    of the table does not pile up in one task.
    """
    published = F.col("published")
    latest: Column = published.desc_nulls_first() if nulls == "newest" else published.desc_nulls_last()
    newest_first = Window.partitionBy("title").orderBy(latest, F.col("id").desc(), F.col("abstract").desc())
    return papers.withColumn("_rank", F.row_number().over(newest_first)).where("_rank = 1").drop("_rank")


def prepare_papers(
    raw: DataFrame, date_range: str | None = None, min_words: int = MIN_ABSTRACT_WORDS
) -> DataFrame:
    """The preparation stage up to the split. Filters run first: they decide which duplicate survives."""
    dated = filter_date_range(build_papers(raw), date_range)
    return dedup_latest(filter_min_words(dated, min_words))
