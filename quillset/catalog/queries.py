"""One registered query per operator. Each reads whole tables and returns a lazy result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillset.catalog import tables
from quillset.functions import text
from quillset.functions.dates import parse_published
from quillset.operators import context, examples, labels, neighbours, rouge, splitting, stats
from quillset.operators.papers import dedup_latest, filter_date_range, filter_min_words, normalize_source
from quillset.operators.search import search_papers
from quillset.plans.evaluate import evaluate_predictions
from quillset.schemas import PREPARED_PAPER
from quillset.session import scratch_path
from quillset.sources import atom, jsonl, splits

Query = Callable[[SparkSession, str], DataFrame]

DATE_RANGE = "2020-03-01..2021-06-30"
SEARCH_CATEGORIES = "src1, src2,src3,de"
SEARCH_TEXT = "the AND with OR les OR hyphenated word OR und"


def joined(name: str):
    """Arrays as text, which compares alike in every engine."""
    return F.array_join(name, "|").alias(name)


def joined_ints(name: str):
    return F.array_join(F.col(name).cast("array<string>"), "|").alias(name)


def rounded(df: DataFrame) -> DataFrame:
    return df.select([F.round(c, 6).alias(c) if kind == "double" else F.col(c) for c, kind in df.dtypes])


# Sources and sinks


def scan_jsonl(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw_dir = scratch_path(spark, "raw")
    jsonl.write_snapshot(tables.raw_papers(spark, sf_dir), raw_dir)
    raw = jsonl.read_jsonl(spark, jsonl.latest_snapshot(spark, raw_dir))
    return raw.select("arxiv_id", "title", "abstract", joined("categories"), "published", "pdf_url")


def roundtrip_jsonl(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "papers.jsonl")
    rows = jsonl.write_jsonl(tables.papers(spark, sf_dir), path)
    stored = jsonl.read_jsonl(spark, path, PREPARED_PAPER)
    written = F.lit(rows).alias("rows_written")
    return stored.select("id", "title", "abstract", "abs_words", joined("categories"), written)


def roundtrip_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    out_dir = scratch_path(spark, "splits")
    splits.save_splits(tables.split_papers(spark, sf_dir), out_dir)
    return spark.read.parquet(f"{out_dir}/papers.parquet").select("id", "title", "abstract", "published", "split")


def load_splits(spark: SparkSession, sf_dir: str) -> DataFrame:
    out_dir = scratch_path(spark, "stages")
    papers = tables.split_papers(spark, sf_dir)
    splits.save_splits(papers, out_dir)
    splits.save_splits(labels.filter_labelled(labels.label_papers(papers)), out_dir, "_filtered")
    return splits.load_training_splits(spark, out_dir).select("id", "abs_words", "summary", "split")


def scan_atom(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "feed.xml")
    raw = tables.raw_papers(spark, sf_dir)

    def link(title: str, folder: str):
        href = F.concat(F.lit(f"http://papers.example.org/{folder}/"), "arxiv_id")
        return F.struct(href.alias("_href"), F.lit(title).alias("_title"))

    page, pdf = link("page", "abs"), link("pdf", "pdf")
    feed = raw.select(
        F.concat(F.lit("http://papers.example.org/abs/"), "arxiv_id").alias("id"),
        F.concat(F.lit("\n  "), "title", F.lit(" \n")).alias("title"),
        F.col("abstract").alias("summary"),
        F.concat("published", F.lit("T00:00:00Z")).alias("published"),
        F.transform("categories", lambda c: F.struct(c.alias("name"))).alias("author"),
        F.transform("categories", lambda c: F.struct(c.alias("_term"))).alias("category"),
        F.when(F.col("arxiv_id") % 2 == 0, F.array(page, pdf, pdf)).otherwise(F.array(page)).alias("link"),
    )
    feed.write.format("xml").option("rootTag", "feed").option("rowTag", atom.ENTRY_TAG).save(path)
    papers = atom.read_atom(spark, path)
    return papers.select(
        "arxiv_id", "title", "abstract", joined("authors"), joined("categories"), "published", "pdf_url"
    )


# Papers


def build_papers(spark: SparkSession, sf_dir: str) -> DataFrame:
    papers = tables.papers(spark, sf_dir)
    return papers.select("id", "title", "abstract", "abs_words", joined("categories"), "published", "pdf_url")


def normalized(spark: SparkSession, sf_dir: str) -> DataFrame:
    papers = normalize_source(tables.search_results(spark, sf_dir))
    return papers.select("arxiv_id", "title", "abstract", joined("authors"), joined("categories"), "published")


def min_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_min_words(tables.papers(spark, sf_dir)).select("id", "abs_words")


def date_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    papers = tables.dated(tables.papers(spark, sf_dir), F.col("id"))
    return filter_date_range(papers, DATE_RANGE).select("id", "published", "abs_words")


def latest_per_title(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_latest(tables.papers(spark, sf_dir)).select("id", "title", "abs_words", "published")


def split_assign(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.split_papers(spark, sf_dir).select("id", "abs_words", "published", "split")


def split_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return splitting.count_splits(tables.split_papers(spark, sf_dir))


def prep_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.prep_stats(tables.raw_papers(spark, sf_dir))


def search_topn(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = search_papers(tables.raw_papers(spark, sf_dir), SEARCH_CATEGORIES, SEARCH_TEXT)
    return found.select("arxiv_id", "title", "published", joined("categories"))


# Scalar functions


def clean_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.documents(spark, sf_dir).select("doc_id", text.clean_abstract(F.col("text")).alias("abstract"))


def word_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = F.col("text")
    return tables.documents(spark, sf_dir).select(
        "doc_id",
        text.word_count(source).alias("words"),
        text.whitespace_word_count(source).alias("whitespace_words"),
    )


def compression(spark: SparkSession, sf_dir: str) -> DataFrame:
    ratio = text.compression_ratio(F.col("text"), text.extractive_summary(F.col("text")))
    return rounded(tables.documents(spark, sf_dir).select("doc_id", ratio.alias("compression")))


def extractive_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.documents(spark, sf_dir).select("doc_id", text.extractive_summary(F.col("text")).alias("summary"))


def dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    spelled = tables.dated(tables.raw_papers(spark, sf_dir), F.col("arxiv_id"))
    moment = F.date_format(parse_published(F.col("published")), "yyyy-MM-dd HH:mm:ss")
    return spelled.select("arxiv_id", "published", moment.alias("moment"))


def id_from_url(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = tables.table(spark, sf_dir, "pages")
    return pages.select("page_id", text.last_url_segment(F.col("url")).alias("id"))


def build_prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    abstract = F.col("abstract")
    return tables.papers(spark, sf_dir).select(
        "id",
        text.methods_prompt(abstract).alias("methods_prompt"),
        text.results_prompt(abstract).alias("results_prompt"),
    )


# Labels


def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.by_language(labels.label_papers(tables.papers(spark, sf_dir)))


def summary_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.documents(spark, sf_dir).select("doc_id", text.long_enough(F.col("text")).alias("long_enough"))


def validate_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    summary = text.extractive_summary(F.col("abstract"))
    valid = text.is_valid_summary(F.col("summary")).alias("valid")
    return tables.papers(spark, sf_dir).select("id", summary.alias("summary")).select("id", valid)


def label_papers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return labelled(spark, sf_dir).select("id", "abs_words", "summary")


def label_conditional(spark: SparkSession, sf_dir: str) -> DataFrame:
    return labelled(spark, sf_dir).select("id", "methods", "results")


def first_words_model() -> labels.Predict:
    """A stand-in for a summarisation model: the first 40 words; it refuses texts with a question mark."""

    def predict(texts: list[str]) -> list[str | None]:
        if any("?" in t for t in texts):
            raise ValueError("cannot answer questions")
        return [" " + " ".join(t.split()[:40]) for t in texts]

    return predict


def label_with_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = labels.label_papers(tables.papers(spark, sf_dir), first_words_model, batch_size=32)
    return found.select("id", "summary", "methods", "results", "label_error")


def fallback_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    return labels.fill_fallback(labelled(spark, sf_dir)).select("id", "summary")


def filter_labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return labels.filter_labelled(labelled(spark, sf_dir)).select("id", "summary", "split")


def filter_labelled_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return labels.filter_labelled_stats(labelled(spark, sf_dir))


def attach_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = tables.table(spark, sf_dir, "labels").withColumnRenamed("doc_id", "id")
    return labels.attach_labels(tables.papers(spark, sf_dir), stored).select("id", "abs_words", "quality", "toxic")


def generation_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(stats.generation_stats(labelled(spark, sf_dir), expected=["de", "en", "xx"]))


# Training examples


def tokens_of(found: DataFrame, show) -> DataFrame:
    return found.select("id", show("input_ids"), show("labels"), "input_len", "target_len", "truncated")


def truncate_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens_of(examples.training_examples(labelled(spark, sf_dir)), joined)


def word_length_tokenizer() -> Callable[[list[str]], list[list[int]]]:
    """A stand-in for a subword tokenizer: the lengths of the words."""
    return lambda texts: [[len(word) for word in t.split()] for t in texts]


def truncate_custom_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens_of(examples.training_examples(labelled(spark, sf_dir), word_length_tokenizer), joined_ints)


def multitask_examples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return examples.multitask_examples(labelled(spark, sf_dir))


def token_lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(examples.token_lengths(labelled(spark, sf_dir)))


def repetition_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = tables.documents(spark, sf_dir).select("doc_id", text.first_repeat(F.col("text")).alias("first_repeat"))
    return found.select("doc_id", "first_repeat", F.col("first_repeat").isNotNull().alias("repeats"))


# Retrieval


def asked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.table(spark, sf_dir, "embeddings").filter(F.col("vec_id") % 20 == 0)


def knn_hits(spark: SparkSession, sf_dir: str, k: int, exact: bool) -> DataFrame:
    index = neighbours.build_index(tables.table(spark, sf_dir, "embeddings"), "vec_id", "embedding", k)
    probes = len(index.centres) if exact else None
    return neighbours.search(index, asked(spark, sf_dir), "vec_id", "embedding", k, probes)


def knn_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(knn_hits(spark, sf_dir, 10, exact=True))


def knn_topk_probed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(knn_hits(spark, sf_dir, 10, exact=False))


def recommend(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(neighbours.neighbour_graph(tables.table(spark, sf_dir, "embeddings"), "vec_id", "embedding"))


def rag_context(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = tables.table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "text")
    return context.rag_context(knn_hits(spark, sf_dir, 5, exact=True), texts)


# Evaluation


def scored(spark: SparkSession, sf_dir: str, *metrics: str, stemmed: bool = False) -> DataFrame:
    return rounded(rouge.rouge_scores(tables.scored_pairs(spark, sf_dir), metrics, stemmed))


def rouge1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scored(spark, sf_dir, "rouge1")


def rouge2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scored(spark, sf_dir, "rouge2")


def rouge1_stem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scored(spark, sf_dir, "rouge1", stemmed=True)


def rouge_l(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scored(spark, sf_dir, "rougeL")


def rouge_lsum(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scored(spark, sf_dir, "rougeLsum")


def rouge_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = tables.scored_pairs(spark, sf_dir)
    return rouge.corpus_scores(rouge.rouge_scores(pairs, ("rouge1", "rouge2"), stemmed=False))


def rouge_corpus_stem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate_predictions(tables.predictions(spark, sf_dir), tables.references(spark, sf_dir))


QUERIES: dict[str, Query] = {
    "scan_jsonl": scan_jsonl,
    "roundtrip_jsonl": roundtrip_jsonl,
    "roundtrip_parquet": roundtrip_parquet,
    "load_splits": load_splits,
    "scan_atom": scan_atom,
    "build_papers": build_papers,
    "normalize_source": normalized,
    "filter_min_words": min_words,
    "filter_date_range": date_range,
    "dedup_latest": latest_per_title,
    "split_assign": split_assign,
    "split_sizes": split_sizes,
    "prep_stats": prep_stats,
    "search_topn": search_topn,
    "clean_text": clean_text,
    "word_count": word_count,
    "compression": compression,
    "extractive_summary": extractive_summary,
    "parse_published": dates,
    "id_from_url": id_from_url,
    "build_prompts": build_prompts,
    "summary_guard": summary_guard,
    "validate_summary": validate_summary,
    "label_papers": label_papers,
    "label_conditional": label_conditional,
    "label_with_model": label_with_model,
    "fallback_fill": fallback_fill,
    "filter_labelled": filter_labelled,
    "filter_labelled_stats": filter_labelled_stats,
    "attach_labels": attach_labels,
    "generation_stats": generation_stats,
    "truncate_tokens": truncate_tokens,
    "truncate_custom_tokens": truncate_custom_tokens,
    "multitask_examples": multitask_examples,
    "token_lengths": token_lengths,
    "repetition_flag": repetition_flag,
    "knn_topk": knn_topk,
    "knn_topk_probed": knn_topk_probed,
    "recommend": recommend,
    "rag_context": rag_context,
    "rouge1": rouge1,
    "rouge2": rouge2,
    "rouge1_stem": rouge1_stem,
    "rougeL": rouge_l,
    "rougeLsum": rouge_lsum,
    "rouge_corpus": rouge_corpus,
    "rouge_corpus_stem": rouge_corpus_stem,
}
