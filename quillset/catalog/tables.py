"""The driver's tables in the shape of papers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillset.functions.text import extractive_summary
from quillset.operators.papers import build_papers, prepare_papers
from quillset.operators.rouge import eval_pairs
from quillset.operators.splitting import assign_splits
from quillset.session import spread


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(table(spark, sf_dir, "documents"))


def raw_papers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as raw papers: first line as title, source and language as categories, a date by id."""
    return documents(spark, sf_dir).select(
        F.col("doc_id").alias("arxiv_id"),
        F.substring_index("text", "\n", 1).alias("title"),
        F.col("text").alias("abstract"),
        F.lit(None).cast("array<string>").alias("authors"),
        F.array("source", "lang").alias("categories"),
        published(F.col("doc_id")).alias("published"),
        F.lit(None).cast("string").alias("pdf_url"),
    )


def published(doc_id: Column) -> Column:
    return F.date_add(F.to_date(F.lit("2020-01-01")), (doc_id % 1000).cast("int")).cast("string")


def papers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_papers(raw_papers(spark, sf_dir))


def split_papers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assign_splits(prepare_papers(raw_papers(spark, sf_dir)))


def by_language(papers_: DataFrame) -> DataFrame:
    """Language in the role of the split, for operators that only need some grouping."""
    return papers_.withColumn("split", F.element_at("categories", 2))


def dated(papers_: DataFrame, doc_id: Column) -> DataFrame:
    """Publication dates in the spellings that sources really use, among them two unusable ones."""
    day = F.col("published")
    spelled = (
        F.when(doc_id % 7 == 0, F.concat(day, F.lit("T10:30:00Z")))
        .when(doc_id % 7 == 1, F.concat(day, F.lit("T22:30:00-05:00")))
        .when(doc_id % 7 == 2, F.concat(day, F.lit(" 08:15:30")))
        .when(doc_id % 7 == 3, F.concat(day, F.lit(" (v2)")))
        .when(doc_id % 7 == 4, F.substring(day, 1, 7))
        .when((doc_id % 7 == 5) & (doc_id % 2 == 0), F.lit(None))
        .otherwise(day)
    )
    return papers_.withColumn("published", spelled)


def search_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as a search service returns them: untrimmed text, authors as structs, zoned dates."""
    doc_id = F.col("arxiv_id")
    padded = raw_papers(spark, sf_dir).select(
        "arxiv_id",
        F.when(doc_id % 5 != 0, F.concat(F.lit("\u00a0 \t"), "title", F.lit("\u2003\n"))).alias("title"),
        F.when(doc_id % 11 != 0, F.concat(F.lit("\n "), "abstract", F.lit("\u3000"))).alias("abstract"),
        F.when(doc_id % 3 != 0, F.transform("categories", lambda c: F.struct(c.alias("name")))).alias("authors"),
        F.when(doc_id % 13 != 0, F.col("categories")).alias("categories"),
        "published",
        "pdf_url",
    )
    return dated(padded, doc_id)


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A baseline "model" that says the whole text of its document."""
    return documents(spark, sf_dir).select(F.col("doc_id").alias("id"), F.col("text").alias("prediction"))


def references(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What it is scored against: the first sentences of the document before; the last one has no prediction."""
    return documents(spark, sf_dir).select(
        (F.col("doc_id") + 1).alias("id"), extractive_summary(F.col("text")).alias("reference")
    )


def scored_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return eval_pairs(predictions(spark, sf_dir), references(spark, sf_dir))
