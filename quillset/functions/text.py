"""Text cleaning, counting and extraction as native column expressions."""

from __future__ import annotations

import string
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# These patterns, phrases, templates and limits decide the results.
# Single characters and few properties per class: ranges make Java's matcher several times slower.
# Possessive repeats do not walk back through a text after an unmatched opening sign.
WHITESPACE = r"[\t\n\x0b\f\r\x1c\x1d\x1e\x1f \x85\xa0\p{Z}]"
NON_WHITESPACE = r"[^\s\p{Z}\x1c\x1d\x1e\x1f\x85]"
WORD_CHARACTER = "[" + string.ascii_letters + string.digits + r"_\p{L}\p{N}]"
CITATION = r"\\cite\{[^}]++\}"
INLINE_MATH = r"\$[^$]++\$"
SENTENCE_END = r"[.!?]+"
PLACEHOLDERS = ["unable to generate", "error occurred", "could not summarize"]
METHODS_PROMPT = "Extract the research methods used: "
RESULTS_PROMPT = "Summarize the main findings and results: "
MIN_SOURCE_CHARS = 50
MIN_SUMMARY_WORDS = 10
MAX_SUMMARY_WORDS = 100
SUMMARY_SENTENCES = 3
REPEATED_WORDS = 3

# First words of a text that are searched for repeated runs before all of it is.
REPEAT_LOOKS = (64, 2048)

# The characters of WHITESPACE, spelled out for the trim functions.
WHITESPACE_CHARS = "".join(
    chr(c)
    for first, last in [
        (0x09, 0x0D), (0x1C, 0x20), (0x85, 0x85), (0xA0, 0xA0), (0x1680, 0x1680), (0x2000, 0x200A),
        (0x2028, 0x2029), (0x202F, 0x202F), (0x205F, 0x205F), (0x3000, 0x3000),
    ]
    for c in range(first, last + 1)
)


def strip(text: Column) -> Column:
    """Trim every Unicode space, not only U+0020. Linear, unlike a regular expression ending in ``+$``."""
    return F.btrim(text, F.lit(WHITESPACE_CHARS))


def strip_to_null(text: Column) -> Column:
    return F.nullif(strip(text), F.lit(""))


def clean_abstract(text: Column) -> Column:
    """Collapse spaces, then drop citations and inline math. Null becomes empty.

    The order is part of the contract: what a removal leaves behind may be two adjacent spaces.
    """
    collapsed = F.regexp_replace(text, WHITESPACE + "+", " ")
    without_math = F.regexp_replace(F.regexp_replace(collapsed, CITATION, ""), INLINE_MATH, "")
    return F.coalesce(F.btrim(without_math), F.lit(""))


def word_count(text: Column) -> Column:
    """Runs of letters, digits and underscores in any script; used by filters and validity."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD_CHARACTER + "+")), F.lit(0))


def whitespace_word_count(text: Column) -> Column:
    """Runs of anything but space; used by the compression ratio only."""
    return F.coalesce(F.regexp_count(text, F.lit(NON_WHITESPACE + "+")), F.lit(0))


def compression_ratio(source: Column, summary: Column) -> Column:
    ratio = F.try_divide(whitespace_word_count(source), whitespace_word_count(summary))
    return F.coalesce(ratio, F.lit(0.0))


def sentences(text: Column) -> Column:
    parts = F.transform(F.split(F.coalesce(text, F.lit("")), SENTENCE_END), strip)
    return F.filter(parts, lambda s: s != "")


def join_sentences(parts: Column) -> Column:
    return F.array_join(F.transform(parts, lambda s: F.concat(s, F.lit("."))), " ")


def extractive_summary(text: Column, num_sentences: int = SUMMARY_SENTENCES) -> Column:
    """The first sentences of a text, rejoined; empty when there is none."""
    return join_sentences(F.slice(sentences(text), 1, num_sentences))


def long_enough(abstract: Column, min_chars: int = MIN_SOURCE_CHARS) -> Column:
    return F.coalesce(F.char_length(strip(abstract)) >= min_chars, F.lit(False))


def bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is evaluated once, however often the body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _repeat_in(words: Column, n: int) -> Column:
    """The first place at which ``n`` words begin that also begin earlier in the array.

    Only runs of which some are equal are sorted. ``words`` is named for every place, so it has to be a bound value.
    """
    places = F.sequence(F.lit(1), F.size(words) - (n - 1))
    grams = F.transform(places, lambda i: F.array_join(F.slice(words, i, n), " "))

    def later(runs: Column) -> Column:
        placed = F.transform(runs, lambda gram, i: F.struct(gram.alias("gram"), (i + 1).alias("at")))
        return bound(
            F.sort_array(placed),
            lambda g: F.array_min(
                F.zip_with(F.slice(g, F.lit(2), F.size(g)), g, lambda a, b: F.when(a.gram == b.gram, a.at))
            ),
        )

    repeated = bound(grams, lambda runs: F.when(F.size(F.array_distinct(runs)) < F.size(runs), later(runs)))
    return F.when(F.size(words) > n, repeated)


def first_repeat(text: Column, n: int = REPEATED_WORDS) -> Column:
    """The word (from 1) at which the first repeated run of ``n`` words begins again; null if none does.

    Words are those of ``word_count``, in lower case. The beginning of a text is looked at first, so a text that soon
    repeats itself ends early; otherwise all its runs are, once.
    """
    words = F.regexp_extract_all(F.lower(text), F.lit(WORD_CHARACTER + "+"), F.lit(0))

    def found(w: Column) -> Column:
        # The beginning is cut off once, not for every place in it.
        early = [F.when(F.size(w) > size, bound(F.slice(w, 1, size), lambda b: _repeat_in(b, n))) for size in REPEAT_LOOKS]
        return F.coalesce(*early, _repeat_in(w, n))

    return bound(words, found)


def is_valid_summary(
    summary: Column,
    min_words: int = MIN_SUMMARY_WORDS,
    max_words: int = MAX_SUMMARY_WORDS,
    no_repeat: int | None = None,
) -> Column:
    """Not blank, of acceptable length, and free of placeholder phrases. Null is invalid.

    With ``no_repeat`` a summary that repeats a run of so many words is invalid, too.
    """
    lowered = F.lower(summary)
    placeholder = F.lit(False)
    for phrase in PLACEHOLDERS:
        placeholder = placeholder | lowered.contains(phrase)
    valid = (strip(summary) != "") & word_count(summary).between(min_words, max_words) & ~placeholder
    if no_repeat is not None:
        valid = valid & first_repeat(summary, no_repeat).isNull()
    return F.coalesce(valid, F.lit(False))


def methods_prompt(abstract: Column) -> Column:
    return F.concat(F.lit(METHODS_PROMPT), abstract)


def results_prompt(abstract: Column) -> Column:
    return F.concat(F.lit(RESULTS_PROMPT), abstract)


def one_line(text: Column) -> Column:
    return F.replace(strip(text), F.lit("\n"), F.lit(" "))


def last_url_segment(url: Column) -> Column:
    return F.element_at(F.split(url, "/"), -1)


def csv_items(text: str) -> list[str]:
    return [item for item in (part.strip() for part in text.split(",")) if item]
