"""Record schemas and the names shared by every stage."""

from pyspark.sql import types as T

RAW_PAPER = T.StructType(
    [
        T.StructField("arxiv_id", T.StringType()),
        T.StructField("title", T.StringType()),
        T.StructField("abstract", T.StringType()),
        T.StructField("authors", T.ArrayType(T.StringType())),
        T.StructField("categories", T.ArrayType(T.StringType())),
        T.StructField("published", T.StringType()),
        T.StructField("pdf_url", T.StringType()),
    ]
)

PREPARED_PAPER = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("title", T.StringType()),
        T.StructField("abstract", T.StringType()),
        T.StructField("abs_words", T.IntegerType()),
        T.StructField("authors", T.ArrayType(T.StringType())),
        T.StructField("categories", T.ArrayType(T.StringType())),
        T.StructField("published", T.StringType()),
        T.StructField("pdf_url", T.StringType()),
    ]
)

LABELLED_PAPER = T.StructType(
    PREPARED_PAPER.fields
    + [
        T.StructField("summary", T.StringType()),
        T.StructField("methods", T.StringType()),
        T.StructField("results", T.StringType()),
    ]
)

ATOM_ENTRY = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("title", T.StringType()),
        T.StructField("summary", T.StringType()),
        T.StructField("published", T.StringType()),
        T.StructField("author", T.ArrayType(T.StructType([T.StructField("name", T.StringType())]))),
        T.StructField("category", T.ArrayType(T.StructType([T.StructField("_term", T.StringType())]))),
        T.StructField(
            "link",
            T.ArrayType(
                T.StructType(
                    [T.StructField("_href", T.StringType()), T.StructField("_title", T.StringType())]
                )
            ),
        ),
    ]
)

# The data contract of the files exchanged between stages.
PAPER_COLUMNS = ["arxiv_id", "title", "abstract", "abs_words", "authors", "categories", "published", "pdf_url"]
SPLITS = ["train", "val", "test"]
MAX_RESULTS = 200
MIN_ABSTRACT_WORDS = 60
VAL_SIZE = 0.1
TEST_SIZE = 0.1
SEED = 42
