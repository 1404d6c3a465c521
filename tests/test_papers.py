import pytest
from pyspark.sql import functions as F

from quillset.operators.papers import (
    build_papers,
    dedup_latest,
    filter_date_range,
    filter_min_words,
    normalize_source,
    prepare_papers,
)
from quillset.operators.search import search_papers
from quillset.operators.stats import prep_stats
from quillset.schemas import RAW_PAPER


def raw(spark, *rows):
    """Raw papers from (id, title, abstract, published)."""
    return spark.createDataFrame([(i, t, a, None, ["cs.CL"], p, None) for i, t, a, p in rows], RAW_PAPER)


def ids(df, column="id"):
    return sorted(r[column] for r in df.select(column).collect())


def test_build_keeps_null_titles_and_drops_blank_ones(spark):
    papers = build_papers(
        raw(
            spark,
            ("1", None, "text", "2024"),
            ("2", "  ", "text", "2024"),
            ("3", "T", "$only math$", "2024"),
            ("4", "T", None, "2024"),
            ("5", "T", " two  words ", "2024"),
        )
    )
    assert papers.columns == ["id", "title", "abstract", "abs_words", "authors", "categories", "published", "pdf_url"]
    assert ids(papers) == ["1", "5"]
    assert papers.where("id = '5'").first()[2:4] == ("two words", 2)


def test_build_tolerates_missing_columns(spark):
    papers = build_papers(spark.createDataFrame([("1", "T", "a b")], "arxiv_id string, title string, abstract string"))
    assert papers.columns == ["id", "title", "abstract", "abs_words"]


def test_min_words_is_inclusive(spark):
    papers = build_papers(raw(spark, ("1", "A", "w " * 59, None), ("2", "B", "w " * 60, None)))
    assert ids(filter_min_words(papers)) == ["2"]


def dated(spark):
    return build_papers(
        raw(
            spark,
            ("1", "A", "x", "2024-01-31T12:00:00"),
            ("2", "B", "x", "2024-01-31"),
            ("3", "C", "x", "2024-01-01T00:00:00Z"),
            ("4", "D", "x", "2023-12-31T23:00:00-05:00"),
            ("5", "E", "x", "bad"),
            ("6", "F", "x", None),
        )
    )


@pytest.mark.parametrize(
    "date_range, expected",
    [
        ("2024-01-01..2024-01-31", ["2", "3", "4"]),
        ("2024-01-31..", ["1", "2"]),
        ("..2024-01-01", ["3"]),
        ("..", ["1", "2", "3", "4"]),
        ("2024-01-01", ["1", "2", "3", "4", "5", "6"]),
        ("", ["1", "2", "3", "4", "5", "6"]),
    ],
)
def test_date_range(spark, date_range, expected):
    assert ids(filter_date_range(dated(spark), date_range)) == expected


def test_date_range_end_of_day(spark):
    kept = filter_date_range(dated(spark), "2024-01-01..2024-01-31", end_of_day=True)
    assert ids(kept) == ["1", "2", "3", "4"]


def test_bad_range_raises(spark):
    with pytest.raises(ValueError):
        filter_date_range(dated(spark), "2024-13-01..")


def test_dedup_keeps_latest_and_null_dates_win(spark):
    papers = build_papers(
        raw(
            spark,
            ("1", "a", "x", "2024-01-02"),
            ("2", "a", "x", None),
            ("3", None, "x", "2020"),
            ("4", None, "x", "2021"),
            ("5", "b", "x", "2024-01-01"),
            ("6", "b", "x", "2024-01-01"),
        )
    )
    assert ids(dedup_latest(papers)) == ["2", "4", "6"]
    assert ids(dedup_latest(papers, nulls="oldest")) == ["1", "4", "6"]
    once = dedup_latest(papers.repartition(7))
    assert ids(dedup_latest(once)) == ids(once) == ["2", "4", "6"]


def test_hot_title_survives_once(spark):
    papers = spark.range(30_000).select(
        F.col("id"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("t"), "id")).alias("title"),
        F.lit("x").alias("abstract"),
        F.lit(1).alias("abs_words"),
        F.col("id").cast("string").alias("published"),
    )
    kept = dedup_latest(papers.repartition(8))
    assert kept.count() == 20_001
    assert kept.where("title = 'hot'").first().published == "9999"


def test_filters_run_before_dedup(spark):
    long, short = "w " * 60, "w " * 3
    papers = raw(spark, ("1", "a", long, "2020-01-01"), ("2", "a", short, "2024-01-01"), ("3", "b", long, "2023-01-01"))
    assert ids(prepare_papers(papers)) == ["1", "3"]
    assert ids(prepare_papers(papers, "..2021-01-01")) == ["1"]


def test_prep_stats_count_raw_after_empties(spark):
    long = "w " * 60
    rows = [(str(i), f"t{i % 12}", long, "2024-01-01") for i in range(24)]
    rows += [("x", " ", long, None), ("y", "T", "$m$", None), ("z", None, "short", None)]
    found = prep_stats(raw(spark, *rows)).first().asDict()
    assert found == {"input_rows": 27, "raw": 25, "after_filters": 12, "train": 9, "val": 1, "test": 2}
    in_range = prep_stats(raw(spark, *rows), "2025-01-01..").first()
    assert (in_range.raw, in_range.after_filters, in_range.train) == (25, 0, 0)
    nothing = prep_stats(raw(spark)).first()
    assert tuple(nothing) == (0, 0, 0, 0, 0, 0)


def test_normalize_source(spark):
    results = spark.createDataFrame(
        [("1", " T\n", None, [("Ann",), ("Bo",)], None, "2024-01-01T10:00:00+02:00", None), ("2", None, "a", None, ["c"], None, "u")],
        "arxiv_id string, title string, abstract string, authors array<struct<name:string>>, "
        "categories array<string>, published string, pdf_url string",
    )
    one, two = normalize_source(results).orderBy("arxiv_id").collect()
    assert tuple(one) == ("1", "T", "", ["Ann", "Bo"], [], "2024-01-01T10:00:00", None)
    assert tuple(two) == ("2", "", "a", [], ["c"], None, "u")


def test_search(spark):
    papers = raw(
        spark,
        ("1", "Language Models", "about GPT", "2024-01-01"),
        ("2", "Vision", "no transformers here", "2024-01-02"),
        ("3", "Attention", "a Transformer", "2024-01-03"),
        ("4", "language  model", "x", None),
    )

    def found(*args, **kwargs):
        return [r.arxiv_id for r in search_papers(papers, *args, **kwargs).collect()]

    assert found("cs.CL") == ["3", "2", "1", "4"]
    assert found("cs.CL, stat.ML", "transformer OR gpt") == ["3", "1"]
    assert found("", "language model") == ["4"]
    assert found("", "attention AND transformer OR vision") == ["3", "2"]
    assert found("cs.LG", "gpt") == []
    assert found("cs.CL", max_results=2) == ["3", "2"]
    with pytest.raises(ValueError):
        search_papers(papers, " , ", " ")
    for text in (" OR ", "a OR", "AND b", "a AND  OR b", '"a b"', "(a OR b)", "a [b]"):
        with pytest.raises(ValueError):
            search_papers(papers, "", text)
