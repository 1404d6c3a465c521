"""Language ID by segmentation-marginalised unigrams.

Each language has a probability for every piece of a fixed public vocabulary. The probability of a word is the sum over
all ways to segment it into pieces, by the forward algorithm, and a text is its words. The piece probabilities are
learned by expectation maximisation (forward-backward over the same lattices) on a bounded sample of texts whose
language is known. The score of a prediction is its posterior under equal priors.

Words are runs of letters, in lower case, of any length: words above ``WORD_LETTERS`` letters, and those whose probability
is too small for a float, are summed in logarithms, one by one. A letter that the vocabulary lacks has the same small
probability in all languages. Null texts and texts without a letter are ``und`` with score 0; of languages with equal
probability the first by name is predicted; repeated rows are predicted alike. Without any labelled row every text is
``und``.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillset.llm.common import add_columns, bounded_sample, held_out

#: Labelled texts of each language that the model is fitted on, at most about.
SAMPLE_ROWS = 1500
#: Rounds of expectation maximisation.
ROUNDS = 4
#: Words up to this length share a lattice.
WORD_LETTERS = 48
#: Probabilities below this are computed in logarithms.
LEAST_CHANCE = 1e-250
SMOOTHING = 0.02
UNKNOWN = 1e-7
UNDETERMINED = "und"
CACHED_WORDS = 100_000
WORDS_AT_ONCE = 5_000
#: Words of texts that are looked up together.
MEETING_WORDS = 100_000
START = "▁"

find_words = re.compile(r"[^\W\d_]+").findall


def public_pieces(path: str | None = None) -> list[str]:
    """The pieces of the vocabulary file that can occur in words."""
    import public_tokenizers
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path or public_tokenizers.path("piece_bpe_32k.model"))
    pieces = [model.id_to_piece(i) for i in range(model.get_piece_size())]
    kept = {p for p in pieces if re.fullmatch(START + "?[^\\W\\d_]*", p) and p}
    return sorted(p for p in kept if p == p.lower())


def text_words(text: str | None) -> list[str]:
    return find_words((text or "").lower())


def piece_hashes(letters: np.ndarray, longest: int) -> Iterator[np.ndarray]:
    """For 1, 2, ... ``longest`` letters: the hash of that many letters from each place on."""
    value = (letters.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    value ^= value >> np.uint64(32)
    hashes = np.zeros(len(letters) + 1, np.uint64)
    for size in range(1, longest + 1):
        hashes = hashes[:-1] * np.uint64(0xD1342543DE82EF95) + value[size - 1 :]
        yield hashes


class PieceTable:
    """Numbers of pieces by the hash of their letters; a bitmap turns most other strings away."""

    BITS = 18

    def __init__(self, pieces: list[str]):
        self.pieces = pieces
        self.longest = max(map(len, pieces))
        hashes = np.zeros(len(pieces), np.uint64)
        for i, p in enumerate(pieces):
            letters = np.frombuffer(p.encode("utf-32-le"), "<u4")
            hashes[i] = list(piece_hashes(letters, len(p)))[-1][0]
        self.order = np.argsort(hashes)
        self.hashes = hashes[self.order]
        self.seen = np.zeros(1 << self.BITS, bool)
        self.seen[self.hashes >> np.uint64(64 - self.BITS)] = True

    def find(self, hashes: np.ndarray) -> np.ndarray:
        out = np.full(len(hashes), -1, np.int64)
        maybe = np.flatnonzero(self.seen[hashes >> np.uint64(64 - self.BITS)])
        at = np.minimum(np.searchsorted(self.hashes, hashes[maybe]), len(self.hashes) - 1)
        hit = self.hashes[at] == hashes[maybe]
        out[maybe[hit]] = self.order[at[hit]]
        return out


@dataclass
class Lattice:
    """All segmentations of some words: edges from ``start`` to ``end`` by ``piece``, ordered by end."""

    word: np.ndarray
    start: np.ndarray
    end: np.ndarray
    piece: np.ndarray
    length: np.ndarray

    @classmethod
    def of(cls, words: list[str], pieces: PieceTable) -> Lattice:
        """The pieces at all places of all words at once, length by length."""
        length = np.array([len(w) + 1 for w in words], dtype=np.int64)
        letters = np.frombuffer("".join(START + w for w in words).encode("utf-32-le", "surrogatepass"), "<u4")
        word = np.repeat(np.arange(len(words)), length)
        start = np.arange(len(letters)) - np.repeat(np.cumsum(length) - length, length)
        room = length[word] - start
        parts = []
        for size, hashes in enumerate(piece_hashes(letters, pieces.longest), 1):
            fits = np.flatnonzero(room[: len(hashes)] >= size)
            found = pieces.find(hashes[fits])
            if size == 1:
                found = np.where(found < 0, len(pieces.pieces), found)
            hit = found >= 0
            parts.append((word[fits[hit]], start[fits[hit]], start[fits[hit]] + size, found[hit]))
        w, i, j, p = (np.concatenate(x) for x in zip(*parts, strict=True))
        order = np.argsort(j * len(words) + w, kind="stable")
        return cls(w[order], i[order], j[order], p[order], length)

    def slices(self) -> list[slice]:
        cuts = np.flatnonzero(np.diff(self.end)) + 1
        return [slice(a, b) for a, b in zip([0, *cuts], [*cuts, len(self.end)], strict=True) if b > a]

    def forward(self, chance: np.ndarray) -> np.ndarray:
        """Sum over all segmentations of each prefix: (word, position, language)."""
        alpha = np.zeros((len(self.length), self.length.max(initial=0) + 1, chance.shape[1]))
        alpha[:, 0] = 1
        for part in self.slices():
            w, value = self.word[part], alpha[self.word[part], self.start[part]] * chance[self.piece[part]]
            heads = np.flatnonzero(np.concatenate(([True], w[1:] != w[:-1])))
            alpha[w[heads], self.end[part][heads]] = np.add.reduceat(value, heads, axis=0)
        return alpha

    def chances(self, chance: np.ndarray) -> np.ndarray:
        return self.forward(chance)[np.arange(len(self.length)), self.length]

    def expected(self, chance: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Expected uses of each piece over all segmentations, for one language, but for words that are too improbable;
        and which words these are."""
        alpha = self.forward(chance)[:, :, 0]
        beta = np.zeros_like(alpha)
        whole = alpha[np.arange(len(self.length)), self.length]
        lost = whole < LEAST_CHANCE
        beta[np.arange(len(self.length)), self.length] = np.where(lost, 0.0, weight / np.where(lost, 1.0, whole))
        counts = np.zeros(len(chance))
        for part in reversed(self.slices()):
            w, i, j, p = self.word[part], self.start[part], self.end[part], self.piece[part]
            used = beta[w, j] * chance[p, 0]
            np.add.at(beta, (w, i), used)
            counts += np.bincount(p, used * alpha[w, i], minlength=len(chance))
        return counts, lost

    def log_forward(self, logs: np.ndarray) -> np.ndarray:
        """Logarithms of the sums over all segmentations of each prefix of the only word: (position, language)."""
        alpha = np.full((int(self.length[0]) + 1, logs.shape[1]), -np.inf)
        alpha[0] = 0
        for part in self.slices():
            value = alpha[self.start[part]] + logs[self.piece[part]]
            most = value.max(0)
            alpha[self.end[part.start]] = most + np.log(np.exp(value - most).sum(0))
        return alpha

    def log_expected(self, logs: np.ndarray) -> np.ndarray:
        """Expected uses of each piece in the only word, for one language."""
        alpha, n = self.log_forward(logs)[:, 0], int(self.length[0])
        beta = np.full(n + 1, -np.inf)
        beta[n] = 0
        counts = np.zeros(len(logs))
        for part in reversed(self.slices()):
            i, p, j = self.start[part], self.piece[part], int(self.end[part.start])
            used = logs[p, 0] + beta[j]
            beta[i] = np.logaddexp(beta[i], used)
            np.add.at(counts, p, np.exp(used + alpha[i] - alpha[n]))
        return counts


@dataclass
class LanguageModel:
    languages: list[str]
    pieces: PieceTable
    chance: np.ndarray
    known: dict[str, int] = field(default_factory=dict)
    logs: np.ndarray | None = None

    def meet(self, words: set[str]) -> None:
        """Make the log chances of words known; a full memory starts anew, and so does one with long words."""
        fresh = sorted(words - self.known.keys(), key=lambda w: (len(w), w))
        if len(self.known) + len(fresh) > CACHED_WORDS or self.known and len(next(reversed(self.known))) > WORD_LETTERS:
            self.known.clear()
            fresh = sorted(words, key=lambda w: (len(w), w))
        found = [np.zeros((0, len(self.languages))) if self.logs is None or not self.known else self.logs]
        short = sum(len(w) <= WORD_LETTERS for w in fresh)
        for at in range(0, short, WORDS_AT_ONCE):
            some = fresh[at : min(at + WORDS_AT_ONCE, short)]
            chances = Lattice.of(some, self.pieces).chances(self.chance)
            logs = np.log(np.maximum(chances, LEAST_CHANCE))
            for i in np.flatnonzero((chances < LEAST_CHANCE).any(1)).tolist():
                logs[i] = self.log_chance(some[i])
            found.append(logs)
        found += [self.log_chance(w)[None] for w in fresh[short:]]
        self.known.update({w: len(found[0]) + i for i, w in enumerate(fresh)})
        self.logs = np.concatenate(found) if len(found) > 1 else found[0]

    def log_chance(self, word: str) -> np.ndarray:
        return Lattice.of([word], self.pieces).log_forward(np.log(self.chance))[-1]

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        names, scores = [], np.zeros(len(texts))
        held: list[list[str]] = []
        for i, text in enumerate(texts):
            held.append(text_words(text))
            if sum(map(len, held)) >= MEETING_WORDS or i + 1 == len(texts):
                self.meet(set().union(*held))
                for words in held:
                    language, scores[len(names)] = self.of_words(words)
                    names.append(language)
                held = []
        return names, scores

    def of_words(self, words: list[str]) -> tuple[str, float]:
        if not words or not self.languages:
            return UNDETERMINED, 0.0
        rows = np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))
        total = self.logs[rows].sum(0)
        best = int(np.argmax(total))
        return self.languages[best], float(1 / np.exp(total - total[best]).sum())


def learn(words: dict[str, dict[str, int]], pieces: list[str], rounds: int = ROUNDS) -> LanguageModel:
    """Piece probabilities from word counts by language."""
    table = PieceTable(pieces)
    languages = sorted(words)
    chance = np.empty((len(pieces) + 1, len(languages)))
    for k, language in enumerate(languages):
        own = np.full((len(pieces) + 1, 1), 1 / len(pieces))
        own[-1] = UNKNOWN
        texts = sorted(words[language], key=lambda w: (len(w) > WORD_LETTERS, w))
        counts = np.array([words[language][w] for w in texts], float)
        short = sum(len(w) <= WORD_LETTERS for w in texts)
        for _ in range(rounds):
            expected = np.full(len(pieces) + 1, SMOOTHING)
            alone = list(range(short, len(texts)))
            for at in range(0, short, WORDS_AT_ONCE):
                part = slice(at, min(at + WORDS_AT_ONCE, short))
                found, lost = Lattice.of(texts[part], table).expected(own, counts[part])
                expected += found
                alone += (at + np.flatnonzero(lost)).tolist()
            for i in alone:
                expected += counts[i] * Lattice.of([texts[i]], table).log_expected(np.log(own))
            own[:-1, 0] = expected[:-1] / expected[:-1].sum()
        chance[:, k] = own[:, 0]
    return LanguageModel(languages, table, chance)


def fit(
    docs: DataFrame, id_col="doc_id", text_col="text", lang_col="lang", rows=SAMPLE_ROWS, vocabulary: str | None = None
) -> LanguageModel:
    """A model of every language in ``lang_col``, never learned from rows of the held-out fold.

    Words are counted by the executors; the driver gets the words of about ``rows`` texts of each language.
    """
    known = docs.filter(F.col(lang_col).isNotNull() & ~held_out(id_col)).select(
        F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang")
    )
    sample, _ = bounded_sample(known, "id", "lang", rows)

    def load() -> Callable[[list], list]:
        return lambda texts: [text_words(t) for t in texts]

    split = add_columns(sample.drop("id"), load, "text", [T.StructField("text", T.ArrayType(T.StringType()))])
    counts = split.select("lang", F.explode("text").alias("word")).groupBy("lang", "word").count()
    words: dict[str, dict[str, int]] = {}
    for batch in counts.toArrow().to_batches():
        for lang, word, n in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            words.setdefault(lang, {})[word] = n
    return learn(words, public_pieces(vocabulary))


def identify(docs: DataFrame, model: LanguageModel, text_col="text") -> DataFrame:
    """All columns of ``docs`` with ``lang_pred`` and ``score``; columns of these names are replaced."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def load():
        model = shared.value
        return lambda rows: model.predict([r["text"] for r in rows])

    asked = docs.withColumn("lang_pred", F.struct(F.col(text_col).alias("text")))
    fields = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]
    return add_columns(asked, load, "lang_pred", fields)
