"""Benchmark decontamination by a generalised suffix automaton of the test items.

The automaton reads the words of a text one by one and always knows the longest match that ends there with a part of
any item. A window is ``window`` consecutive words of an item; an item of fewer words (but not none) is one window.
A match of ``window`` words or more covers all words it holds; so does the occurrence of a whole short item. Words
that no item has reset the automaton, so only stretches of known words are walked.

Items are put into shards of at most ``SHARD_WORDS`` words, each with an automaton of its own that is broadcast. One
shard is the usual case and reads the texts once, without a shuffle; more items mean more passes, one after another, each
of which joins its hits to those written by the pass before.

Null and empty texts have no words; null and empty items have no windows. Items with one id count as one item; an item
without an id is matched but not listed.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillset.llm.common import add_columns
from quillset.session import stage

WINDOW = 10
#: Words of the items in one automaton, at most (an item is never cut).
SHARD_WORDS = 1_000_000
#: Limits of the cleaning stage: a text with a larger covered share goes, as does one with a longer match.
MOST_COVERAGE = 0.5
MOST_WORDS = 400

#: All bytes but digits, letters and those of other alphabets separate words.
SEPARATORS = bytes([*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)])
TO_SPACE = bytes.maketrans(SEPARATORS, b" " * len(SEPARATORS))
word_spans = re.compile(rb"[^\x20]+").finditer

HIT = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("n_hit", T.LongType()),
        T.StructField("longest", T.LongType()),
        T.StructField("words", T.ArrayType(T.ArrayType(T.LongType()))),
        T.StructField("items", T.ArrayType(T.StringType())),
    ]
)


def normal_bytes(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass").lower().translate(TO_SPACE)


@dataclass
class Automaton:
    """A generalised suffix automaton over word numbers.

    ``cover[s]`` is the longest whole short item that ends in state ``s``, ``window_state[s]`` the state of its last
    ``window`` words, ``items[s]`` the items that hold the string of such a state.
    """

    window: int
    vocabulary: dict[bytes, int] = field(default_factory=dict)
    step: list[dict[int, int]] = field(default_factory=lambda: [{}])
    link: list[int] = field(default_factory=lambda: [-1])
    size: list[int] = field(default_factory=lambda: [0])

    @classmethod
    def of(cls, items: list[tuple[str | None, str | None]], window: int = WINDOW) -> Automaton:
        self = cls(window)
        paths = []
        for item_id, text in items:
            words = [self.vocabulary.setdefault(w, len(self.vocabulary)) for w in normal_bytes(text).split()]
            state = 0
            for w in words:
                state = self.extend(state, w)
            paths.append((item_id, words))
        self.finish(paths)
        return self

    def extend(self, last: int, w: int) -> int:
        if w in self.step[last]:
            target = self.step[last][w]
            return target if self.size[target] == self.size[last] + 1 else self.clone(last, w, target)
        new = self.add(self.size[last] + 1, {})
        while last >= 0 and w not in self.step[last]:
            self.step[last][w] = new
            last = self.link[last]
        if last < 0:
            self.link[new] = 0
        else:
            target = self.step[last][w]
            exact = self.size[target] == self.size[last] + 1
            self.link[new] = target if exact else self.clone(last, w, target)
        return new

    def clone(self, last: int, w: int, target: int) -> int:
        copy = self.add(self.size[last] + 1, dict(self.step[target]))
        self.link[copy], self.link[target] = self.link[target], copy
        while last >= 0 and self.step[last].get(w) == target:
            self.step[last][w] = copy
            last = self.link[last]
        return copy

    def add(self, size: int, step: dict[int, int]) -> int:
        self.step.append(step)
        self.size.append(size)
        self.link.append(0)
        return len(self.size) - 1

    def finish(self, paths: list[tuple[str | None, list[int]]]) -> None:
        n = len(self.size)
        whole, holders = [0] * n, [set() for _ in range(n)]
        self.window_state = [-1] * n
        by_size = sorted(range(1, n), key=self.size.__getitem__)
        for s in by_size:
            if self.size[s] >= self.window:
                up = self.link[s]
                self.window_state[s] = s if self.size[up] < self.window else self.window_state[up]
        for item_id, words in paths:
            state = 0
            for w in words:
                state = self.step[state][w]
                if self.window_state[state] >= 0:
                    holders[self.window_state[state]].add(item_id)
            if 0 < len(words) < self.window:
                whole[state] = len(words)
                holders[state].add(item_id)
        self.cover, self.short_link = whole[:], [-1] * n
        for s in by_size:
            up = self.link[s]
            self.short_link[s] = s if whole[s] else self.short_link[up]
            self.cover[s] = whole[s] or self.cover[up]
        self.holders = [frozenset(h) for h in holders]
        self.least = min([self.window, *[x for x in whole if x]])

    def scan(self, text: str | None) -> tuple[int, list[tuple[int, int]], set, int]:
        """Words, merged spans of covered words, ids of the items whose windows occur, longest match in words."""
        words = normal_bytes(text).split()
        ids = np.fromiter(map(self.vocabulary.get, words, [-1] * len(words)), np.int64, len(words))
        unknown = np.concatenate(([-1], np.flatnonzero(ids < 0), [len(ids)]))
        runs = np.flatnonzero(np.diff(unknown) > self.least)
        spans: list[tuple[int, int]] = []
        items: set = set()
        longest = 0
        for r in runs.tolist():
            at, end = int(unknown[r]) + 1, int(unknown[r + 1])
            longest = max(longest, self.walk(ids[at:end].tolist(), at, spans, items))
        return len(words), spans, items, longest

    def walk(self, ids: list[int], at: int, spans: list[tuple[int, int]], items: set) -> int:
        state = length = longest = 0
        for i, w in enumerate(ids, at + 1):
            while state and w not in self.step[state]:
                state = self.link[state]
                length = self.size[state]
            if w in self.step[state]:
                state = self.step[state][w]
                length += 1
            hit = 0
            if length >= self.window:
                hit = length
                items |= self.holders[self.window_state[state]]
            short = self.short_link[state] if self.cover[state] else -1
            while short > 0:
                if self.cover[short] <= length:
                    hit = max(hit, self.cover[short])
                    items |= self.holders[short]
                short = self.short_link[self.link[short]]
            if hit:
                start = i - hit
                longest = max(longest, hit)
                while spans and spans[-1][1] >= start:
                    start = min(start, spans.pop()[0])
                spans.append((start, i))
        return longest


def shards(
    items: DataFrame, id_col="item_id", text_col="text"
) -> tuple[int, Iterator[list[tuple[str | None, str | None]]]]:
    """How many lists of about ``SHARD_WORDS`` words at most the items make, and the lists, fetched one after another.

    Equal items are one; the driver holds one list at a time.
    """
    plain = items.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text")).distinct()
    total = plain.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = 1 + total // (2 * SHARD_WORDS)  # a word and its separator have two bytes at least
    of = F.pmod(F.xxhash64("id", "text"), F.lit(n))
    return n, ([(r["id"], r["text"]) for r in (plain.filter(of == k) if n > 1 else plain).collect()] for k in range(n))


def find_contamination(
    docs: DataFrame, items: DataFrame, text_col="text", item_id="item_id", item_text="text", window=WINDOW, out="hits",
    cut=False,
) -> DataFrame:
    """All columns of ``docs`` and ``out``: (n_words, n_hit, longest, words, items).

    ``words`` are the spans of covered words, ``longest`` the longest match in words, ``items`` the sorted ids of the
    items with occurring windows. With ``cut`` the covered words are cut from the text. An existing ``out`` is replaced.
    """
    found = docs.drop(out)
    n, lists = shards(items, item_id, item_text)
    for i, shard in enumerate(lists):
        shared = docs.sparkSession.sparkContext.broadcast(Automaton.of(shard, window))
        found = scan(found, shared, text_col, out, more=i > 0, cut=cut and i + 1 == n)
        if i + 1 < n:  # so that no task holds two automata, and the driver lets go of this one
            found = stage(found, "contamination")
            shared.destroy()
    return found


def scan(docs: DataFrame, shared, text_col: str, out: str, more: bool, cut: bool) -> DataFrame:
    """One pass; with ``more``, what earlier passes found in column ``out`` is joined."""
    earlier = F.col(out) if more else F.lit(None).cast(HIT)
    pair = docs.withColumn(out, F.struct(F.col(text_col).alias("text"), earlier.alias("earlier")))

    def load():
        automaton = shared.value

        def scanned(rows: list[dict]) -> tuple[list, ...]:
            hits = [joined(*automaton.scan(row["text"]), row["earlier"]) for row in rows]
            if not cut:
                return (hits,)
            return [cut_words(row["text"], hit["words"]) for row, hit in zip(rows, hits, strict=True)], hits

        return scanned

    fields = [T.StructField(text_col, T.StringType())] * cut + [T.StructField(out, HIT)]
    return add_columns(pair, load, out, fields)


def joined(n_words: int, spans: list, items: set, longest: int, earlier: dict | None) -> dict:
    if earlier:
        merged: list[list[int]] = []
        for start, end in sorted([*map(tuple, earlier["words"]), *spans]):
            if merged and start <= merged[-1][1]:
                merged[-1][1] = max(merged[-1][1], end)
            else:
                merged.append([start, end])
        spans = merged
        items = items | set(earlier["items"])
        longest = max(longest, earlier["longest"])
    names = sorted(x for x in items if x is not None)
    hit = sum(end - start for start, end in spans)
    return {"n_words": n_words, "n_hit": hit, "longest": longest, "words": [list(s) for s in spans], "items": names}


def clean(docs: DataFrame, items: DataFrame, text_col="text", coverage=MOST_COVERAGE, words=MOST_WORDS, **names):
    """``docs`` without contamination: a text over a limit goes, from the others the covered spans are cut.

    Where words are cut, what stood before and after is joined by the separators that were there.
    """
    hits = "contamination_"
    found = find_contamination(docs, items, text_col, out=hits, cut=True, **names)
    share = F.col(f"{hits}.n_hit") / F.greatest(F.col(f"{hits}.n_words"), F.lit(1))
    kept = found.filter((share <= coverage) & (F.col(f"{hits}.longest") <= words))
    return kept.select(*docs.columns)


def cut_words(text: str | None, spans: list) -> str | None:
    if not spans:
        return text
    raw = text.encode("utf-8", "surrogatepass")
    places = [m.span() for m in word_spans(normal_bytes(text))]
    at, parts = 0, []
    for start, end in spans:
        parts.append(raw[at : places[start][0]])
        at = places[end - 1][1]
    parts.append(raw[at:])
    return b"".join(parts).decode("utf-8", "surrogatepass")
