import re
import sys
import unicodedata

import pytest
from pyspark.sql import functions as F

from quillset.functions import text as t


def evaluate(spark, expression, inputs):
    rows = [(i, value) for i, value in enumerate(inputs)]
    df = spark.createDataFrame(rows, "i int, x string")
    return [r.y for r in df.select("i", expression(F.col("x")).alias("y")).orderBy("i").collect()]


CLEAN = [
    ("foo \\cite{a} bar\n$x$  z", "foo  bar  z"),
    ("cost $5 and $6 ok", "cost 6 ok"),
    ("$$x$$", "$$"),
    ("\\cite{} x", "\\cite{} x"),
    ("a  b", "a b"),
    ("a b", "a b"),
    ("  a  b\t\tc ", "a b c"),
    ("\n", ""),
    (None, ""),
    ("", ""),
]
WORDS = [
    ("naïve café", 2),
    ("étude x", 3),
    ("हिन्दी भाषा", 5),
    ("½ x² Ⅷ", 3),
    ("a​b", 2),
    ("snake_case v1.2", 3),
    ("", 0),
    (None, 0),
]
EXTRACTS = [
    ("A b. C d! E?! F. G", "A b. C d. E."),
    ("v1.2 is 3.5% better. ok", "v1. 2 is 3. 5% better."),
    ("...", ""),
    ("", ""),
    (None, ""),
    ("one", "one."),
]


def test_clean_abstract(spark):
    assert evaluate(spark, t.clean_abstract, [a for a, _ in CLEAN]) == [b for _, b in CLEAN]


def test_word_count(spark):
    assert evaluate(spark, t.word_count, [a for a, _ in WORDS]) == [b for _, b in WORDS]


def test_whitespace_word_count_is_another_counter(spark):
    texts = ["snake-case v1.2  x", " a b\n", "", None]
    assert evaluate(spark, t.whitespace_word_count, texts) == [3, 2, 0, 0]


def test_extractive_summary(spark):
    assert evaluate(spark, t.extractive_summary, [a for a, _ in EXTRACTS]) == [b for _, b in EXTRACTS]
    assert evaluate(spark, lambda c: t.extractive_summary(c, 1), ["A. B."]) == ["A."]


def test_compression_ratio(spark):
    df = spark.createDataFrame([("a b c d", "a b"), ("a b", ""), ("a b", None)], "x string, y string")
    ratios = [r.z for r in df.select(t.compression_ratio(F.col("x"), F.col("y")).alias("z")).collect()]
    assert ratios == [2.0, 0.0, 0.0]


def test_validity(spark):
    cases = [(" ".join(["w"] * n), ok) for n, ok in [(9, False), (10, True), (100, True), (101, False)]]
    cases += [
        ("w " * 12 + "Unable to Generate", False),
        ("w " * 12 + "an ERROR occurred", False),
        ("w " * 12 + "could not summarize", False),
        ("  ", False),
        ("", False),
        (None, False),
    ]
    assert evaluate(spark, t.is_valid_summary, [a for a, _ in cases]) == [b for _, b in cases]


def test_input_guard(spark):
    texts = ["x" * 49, "x" * 50, " " * 9 + "x" * 49 + "\n" * 9, None]
    assert evaluate(spark, t.long_enough, texts) == [False, True, False, False]


def test_one_line_and_url(spark):
    assert evaluate(spark, t.one_line, [" a\nb \n", " x"]) == ["a b", "x"]
    assert evaluate(spark, t.last_url_segment, ["http://h/abs/2401.00001v2", "x", "a/"]) == ["2401.00001v2", "x", ""]


def test_prompts_and_csv(spark):
    assert evaluate(spark, t.methods_prompt, ["A"]) == ["Extract the research methods used: A"]
    assert evaluate(spark, t.results_prompt, ["A"]) == ["Summarize the main findings and results: A"]
    assert t.csv_items(" a, b ,,c") == ["a", "b", "c"]


@pytest.fixture(scope="module")
def code_points(spark):
    # Neither surrogates nor the byte order mark, which decoding swallows.
    valid = spark.range(1, sys.maxunicode + 1).where("id not between 55296 and 57343 and id <> 65279")
    utf32 = F.unhex(F.lpad(F.hex("id"), 8, "0"))
    return valid.select("id", F.decode(utf32, "UTF-32").alias("c"))


def test_whitespace_equals_python_on_every_code_point(spark, code_points):
    python = {i for i in range(1, sys.maxunicode + 1) if chr(i).isspace() and re.match(r"\s", chr(i))}
    matched = {r.id for r in code_points.where(F.col("c").rlike(t.WHITESPACE)).collect()}
    other = {r.id for r in code_points.where(~F.col("c").rlike(t.NON_WHITESPACE)).collect()}
    trimmed = {r.id for r in code_points.where(t.strip(F.col("c")) == "").collect()}
    assert matched == other == trimmed == python


def test_word_characters_differ_from_python_only_in_newer_letters(spark, code_points):
    matched = {r.id for r in code_points.where(F.col("c").rlike(t.WORD_CHARACTER)).collect()}
    python = {i for i in range(1, sys.maxunicode + 1) if re.match(r"\w", chr(i)) and not 55296 <= i <= 57343}
    assert matched <= python
    # Letters and numbers added after the JVM's Unicode tables were made.
    assert all(i >= 0x870 and unicodedata.category(chr(i))[0] in "LN" for i in python - matched)
