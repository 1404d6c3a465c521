"""Best-fit packing by bin completion.

Documents become token ids with an end id; longer ones than a sequence are cut into full sequences, of which the first
piece may be shorter. So all that has to be packed are the first pieces, of fewer than 1024 lengths whatever the input
is, and the problem is a histogram. The driver packs the histogram: around the largest length left, branch and bound
branches over the fillings of the rest of the sequence that no other filling dominates and over how often each is used,
and prunes by the tokens wasted over the whole plan, against the incumbent: best-fit decreasing. It ends when it meets a
lower bound. Counts may be large and the uses many, so the search first fixes the whole uses of the best plan in
fractions and packs what is left, fewer sequences than there are lengths, and then searches the whole histogram. After
``SEARCH_STEPS`` either search ends; a plan above the lower bound is logged with it.

The pieces get their places without a sort over the input: a piece's rank among those of its length is the number of
such pieces in earlier partitions plus its rank inside its own, and ranks are looked up in the plan.

Null and empty texts are one end id. Rows with repeated or null ids are packed each for itself.
"""

from __future__ import annotations

import functools
import hashlib
import logging
import math
import re
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillset.llm.common import add_columns
from quillset.session import stage

log = logging.getLogger(__name__)

CAPACITY = 1024
END_ID = 2
#: Fillings and numbers of uses that a search over plans looks at, at most; the best plan found stands.
SEARCH_STEPS = 20_000
#: White space in a row from which on a text is read by the library that does not recur over it.
BLANK_RUN = 100_000
#: Fillings that enter the plan in fractions, at most; the lower bound holds whenever it ends.
SIMPLEX_ROUNDS = 300

PIECES = T.ArrayType(
    T.StructType(
        [
            T.StructField("piece", T.IntegerType()),
            T.StructField("start", T.LongType()),
            T.StructField("length", T.LongType()),
            T.StructField("ids_crc32", T.LongType()),
        ]
    )
)

Encoder = Callable[[list[str]], list[list[int]]]


def byte_bpe(ranks: str | None = None, model: str | None = None) -> Encoder:
    """The ids of ``byte_bpe_50k.json`` without special tokens added, from the rank file of the same vocabulary.

    The rank file gives equal ids several times as fast (the tests compare them). As in the other library, the text
    of the one special token is that token. A text with a long run of white space overflows the pattern engine that
    reads the rank file; such texts, found by one cheap search in texts that are long enough, go to the other library.
    """
    import base64

    import public_tokenizers
    import tiktoken

    path = ranks or public_tokenizers.path("byte_bpe_50k.tiktoken")
    with open(path, "rb") as lines:
        table = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    special = {"<|endoftext|>": len(table)}
    encoding = tiktoken.Encoding(
        "byte_bpe_50k", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens=special
    )
    long_blank = re.compile(rf"\s{{{BLANK_RUN}}}")

    @functools.cache
    def other():  # loaded if a text needs it
        from tokenizers import Tokenizer

        return Tokenizer.from_file(model or public_tokenizers.path("byte_bpe_50k.json"))

    def ids(text: str) -> list[int]:
        if len(text) >= BLANK_RUN and long_blank.search(text):
            return other().encode(text, add_special_tokens=False).ids
        return encoding.encode(text, allowed_special="all")

    return lambda texts: [ids(t) for t in texts]


def token_pieces(ids: list[int], capacity: int = CAPACITY) -> list[dict]:
    """The pieces of one document: all full but the first, which has what is left over."""
    whole = np.asarray(ids, dtype="<u4")
    first = len(whole) % capacity or min(capacity, len(whole))
    ends = range(first, len(whole) + 1, capacity)
    starts = [0, *ends[:-1]]
    return [
        {"piece": i, "start": a, "length": b - a, "ids_crc32": zlib.crc32(whole[a:b].tobytes())}
        for i, (a, b) in enumerate(zip(starts, ends, strict=True))
    ]


@dataclass(frozen=True)
class Filling:
    """A sequence of these lengths, largest first, used ``times`` times."""

    lengths: tuple[int, ...]
    times: int


def best_fit(counts: dict[int, int], capacity: int) -> list[Filling]:
    """Best-fit decreasing on a histogram: a length goes to the fullest sequences that have room for it."""
    open_: dict[int, list[list]] = {}
    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            room = min((r for r in open_ if r >= length), default=None)
            if room is None:
                per = capacity // length
                full, rest = divmod(left, per)
                for n, times in ((per, full), (rest, 1)):
                    if n and times:
                        open_.setdefault(capacity - n * length, []).append([(length,) * n, times])
                break
            lengths, times = open_[room].pop()
            if not open_[room]:
                del open_[room]
            fit = min(room // length, left)
            used = min(times, max(1, left // fit))
            open_.setdefault(room - fit * length, []).append([lengths + (length,) * fit, used])
            if used < times:
                open_.setdefault(room, []).append([lengths, times - used])
            left -= fit * used
    return [Filling(tuple(lengths), times) for bins in open_.values() for lengths, times in bins]


def least_sequences(left: np.ndarray) -> int:
    """A lower bound: pieces above half a sequence need one each, and what their room cannot hold needs more.

    ``left`` has the number of pieces by length, up to the capacity. For each ``k`` up to half, the pieces of ``k`` to
    half a sequence are set against the room beside the large pieces that leave at least ``k``.
    """
    capacity = len(left) - 1
    half = capacity // 2
    number, tokens = np.cumsum(left), np.cumsum(left * np.arange(capacity + 1))
    k = np.arange(half + 1)
    room = (number[capacity - k] - number[half]) * capacity - (tokens[capacity - k] - tokens[half])
    small = tokens[half] - np.where(k > 0, tokens[np.maximum(k - 1, 0)], 0)
    return int(number[-1] - number[half] + max(0, int((-(-(small - room) // capacity)).max())))


def dominated(filling: tuple[int, ...], slack: int, left: dict[int, int], lengths_left: int) -> bool:
    """Whether a piece that is left could replace a smaller subset of the filling, the empty one included.

    The subset fits where the piece came from, so some best plan has the piece here instead. A piece may also replace
    several of the same sum. ``lengths_left`` has the bits of the lengths in ``left``, which counts the filling's own.
    """
    one = several = 0
    for n in filling:
        one, several = one | 1 << n, several | several << n | one << n
    free = lengths_left
    for n in set(filling):
        if filling.count(n) >= left[n]:
            free &= ~(1 << n)
    larger, width = (1 | one | several) << 1, 1
    while width < slack:
        step = min(width, slack - width)
        larger, width = larger | larger << step, width + step
    return bool((several | (larger if slack else 0)) & free)


def fillings(room: int, left: dict[int, int], steps: Steps, spare: Callable[[], int]) -> Iterator[tuple[int, ...]]:
    """The fillings of ``room`` that no other dominates, least waste first, then largest pieces first.

    None that wastes more than ``spare()``, which may fall meanwhile. Sums that the pieces cannot reach are known from
    bit sets, so the search meets no dead ends.
    """
    lengths = sorted((n for n in left if n <= room), reverse=True)
    bits, mask = [1], (1 << room + 1) - 1
    for n in reversed(lengths):  # bit s of entry i: pieces of lengths[i:] have the sum s
        sums, copies, step = bits[-1], min(left[n], room // n), 1
        while copies:
            step = min(step, copies)
            sums |= sums << n * step & mask
            copies, step = copies - step, step * 2
        bits.append(sums)
    bits.reverse()
    present = sum(1 << n for n in lengths)

    def exact(at: int, total: int) -> Iterator[tuple[int, ...]]:
        if not total:
            yield ()
        while total and bits[at] >> total & 1:
            n = lengths[at]
            at += 1
            for take in range(min(left[n], total // n), 0, -1):
                if bits[at] >> total - n * take & 1:
                    for more in exact(at, total - n * take):
                        yield (n,) * take + more

    waste = 0
    while waste <= min(spare(), room):
        for filling in exact(0, room - waste):
            if not steps.take():
                return
            if not dominated(filling, waste, left, present):
                yield filling
            if waste > spare():
                return
        waste += 1


class Steps:
    """A number of steps that can be taken."""

    def __init__(self, most: int):
        self.left = most

    def take(self) -> bool:
        self.left -= 1
        return self.left >= 0


def branch(counts: dict[int, int], capacity: int, incumbent: list[Filling], bound: int, most: int) -> list[Filling]:
    """Bin completion: the plan with the fewest sequences, or the incumbent if none has fewer.

    A node has the pieces left. Its branches are the undominated fillings around the largest of them, each with all
    numbers of uses. A branch is cut if the tokens wasted so far exceed what a plan better than the incumbent can waste,
    if the pieces left need too many sequences, or if they were left before after no more sequences. The search ends
    at ``bound`` sequences, which no plan is below, or after ``most`` steps.
    """
    left = np.zeros(capacity + 1, np.int64)
    for n, c in counts.items():
        left[n] = c
    tokens = int((left * np.arange(capacity + 1)).sum())
    fewest, steps, path = size(incumbent), Steps(most), []
    seen: dict[bytes, int] = {}

    def branches(left: np.ndarray, used: int, wasted: int) -> Iterator[tuple[Filling, np.ndarray, int, int]]:
        here = {int(n): int(left[n]) for n in np.flatnonzero(left)}
        largest = max(here)
        here[largest] -= 1
        rest = {n: c for n, c in here.items() if c}
        for filling in fillings(capacity - largest, rest, steps, lambda: (fewest - 1) * capacity - tokens - wasted):
            whole = (largest, *filling)
            uses = {n: whole.count(n) for n in whole}
            waste = capacity - sum(whole)
            for times in range(min(int(left[n]) // k for n, k in uses.items()), 0, -1):
                if not steps.take():
                    return
                if wasted + times * waste > (fewest - 1) * capacity - tokens:
                    continue
                after = left.copy()
                for n, k in uses.items():
                    after[n] -= k * times
                if used + times + least_sequences(after) >= fewest:
                    continue
                key = hashlib.blake2b(after.tobytes(), digest_size=16).digest()
                if seen.get(key, used + times + 1) <= used + times:
                    continue
                seen[key] = used + times
                yield Filling(whole, times), after, used + times, wasted + times * waste

    stack = [branches(left, 0, 0)] if tokens and fewest > bound else []
    while stack:
        found = next(stack[-1], None)
        if found is None:
            stack.pop()
            path = path[: max(0, len(stack) - 1)]
            continue
        filling, after, used, wasted = found
        path = [*path[: len(stack) - 1], filling]
        if after.any():
            stack.append(branches(after, used, wasted))
        elif used < fewest:
            incumbent, fewest = path, used
            if fewest <= bound:
                break
    return incumbent


def fractional_plan(counts: dict[int, int], capacity: int, bound: int) -> tuple[list[tuple[dict[int, int], float]], int]:
    """Fillings and how often a plan in fractions uses them, and the number of sequences that no plan is below.

    Column generation: the simplex method, for which a knapsack over the dual prices finds the next filling. It ends at
    the best plan, or as soon as its size rounded up is the bound.
    """
    lengths = np.array(sorted(counts, reverse=True))
    need = np.array([counts[int(n)] for n in lengths], float)
    columns = np.diag(capacity // lengths)
    inverse = np.diag(1 / (capacity // lengths))
    uses = need / (capacity // lengths)
    first = np.searchsorted(-lengths, -np.arange(capacity + 1)).tolist()
    for _ in range(SIMPLEX_ROUNDS):
        price = inverse.sum(0)
        value, last = np.zeros(capacity + 1), np.full(capacity + 1, -1)
        for room in range(1, capacity + 1):
            value[room] = value[room - 1]
            fits = first[room]
            if fits < len(lengths):
                gain = value[room - lengths[fits:]] + price[fits:]
                best = int(gain.argmax())
                if gain[best] > value[room]:
                    value[room], last[room] = gain[best], fits + best
        bound = max(bound, math.ceil(need @ price / max(1.0, value[-1]) - 1e-6))
        if value[-1] <= 1 + 1e-9 or math.ceil(uses.sum() - 1e-6) <= bound:
            break
        entering, room = np.zeros(len(lengths), int), capacity
        while room > 0:
            if last[room] < 0:
                room -= 1
            else:
                entering[last[room]] += 1
                room -= lengths[last[room]]
        share = inverse @ entering
        falls = share > 1e-9
        ratio = np.where(falls, uses / np.where(falls, share, 1), np.inf)
        row = int(np.argmin(ratio))
        step = ratio[row]
        uses = np.maximum(uses - step * share, 0)
        uses[row] = step
        inverse[row] /= share[row]
        others = np.arange(len(lengths)) != row
        inverse[others] -= np.outer(share[others], inverse[row])
        columns[:, row] = entering
    plan = [({int(n): int(k) for n, k in zip(lengths, c, strict=True) if k}, float(x)) for c, x in zip(columns.T, uses, strict=True)]
    return plan, bound


def whole_uses(plan: list[tuple[dict[int, int], float]], counts: dict[int, int]) -> tuple[list[Filling], dict]:
    """The whole uses of a plan in fractions, as far as there are pieces, and the pieces left."""
    left, fixed = dict(counts), []
    for filling, uses in plan:
        times = min(int(uses + 1e-6), *[left[n] // k for n, k in filling.items()])
        if times:
            fixed.append(Filling(tuple(n for n in sorted(filling, reverse=True) for _ in range(filling[n])), times))
            for n, k in filling.items():
                left[n] -= k * times
    return fixed, {n: c for n, c in left.items() if c}


def size(plan: list[Filling]) -> int:
    return sum(f.times for f in plan)


def bounded_plan(counts: dict[int, int], capacity: int = CAPACITY) -> tuple[list[Filling], int]:
    """A plan and the number of sequences that no plan is below; if they agree, the plan is one of the best."""
    counts = {n: c for n, c in counts.items() if c}
    if not counts:
        return [], 0
    left = np.zeros(capacity + 1, np.int64)
    left[list(counts)] = list(counts.values())
    bound = least_sequences(left)
    plan = best_fit(counts, capacity)
    if size(plan) > bound:
        uses, bound = fractional_plan(counts, capacity, bound)
        fixed, rest = whole_uses(uses, counts)
        ending = branch(rest, capacity, best_fit(rest, capacity), bound - size(fixed), SEARCH_STEPS)
        plan = min(plan, fixed + ending, key=size)
        plan = branch(counts, capacity, plan, bound, SEARCH_STEPS)
    return plan, bound


def plan_bins(counts: dict[int, int], capacity: int = CAPACITY) -> list[Filling]:
    """The plan, with a warning if it could not be shown to be one of the best."""
    plan, bound = bounded_plan(counts, capacity)
    if size(plan) > bound:
        log.warning("packing: %d sequences after %d steps; no plan has below %d", size(plan), SEARCH_STEPS, bound)
    return plan


class Places:
    """Where the piece of a given rank among those of its length goes. Its size follows the number of lengths."""

    def __init__(self, plan: list[Filling]):
        rows: dict[int, list[tuple]] = {}
        ranks: dict[int, int] = {}
        sequence = 0
        for filling in plan:
            offsets = np.concatenate(([0], np.cumsum(filling.lengths)[:-1])).astype(np.int64)
            for n in dict.fromkeys(filling.lengths):
                own = offsets[[i for i, x in enumerate(filling.lengths) if x == n]]
                rows.setdefault(n, []).append((ranks.get(n, 0), sequence, own))
                ranks[n] = ranks.get(n, 0) + len(own) * filling.times
            sequence += filling.times
        self.sequences = sequence
        self.rows = {n: (np.array([r[0] for r in x]), x) for n, x in rows.items()}

    def of(self, lengths: np.ndarray, ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        sequence, offset = np.zeros(len(ranks), np.int64), np.zeros(len(ranks), np.int64)
        for n in np.unique(lengths):
            mine = np.flatnonzero(lengths == n)
            begins, rows = self.rows[int(n)]
            found = np.searchsorted(begins, ranks[mine], side="right") - 1
            for k in np.unique(found):
                at = mine[found == k]
                begin, first, own = rows[k]
                place = ranks[at] - begin
                sequence[at] = first + place // len(own)
                offset[at] = own[place % len(own)]
        return sequence, offset


def pack(
    docs: DataFrame,
    id_col="doc_id",
    text_col="text",
    encoder: Callable[[], Encoder] = byte_bpe,
    capacity: int = CAPACITY,
    end_id: int = END_ID,
) -> DataFrame:
    """One row per piece: (id, piece, start, length, ids_crc32, sequence_id, offset).

    The texts are tokenized once; what is written to the shared folder and shuffled is the list of pieces, not ids.
    Full pieces have a sequence of their own, with a negative number.
    """

    def load():
        encode = encoder()
        return lambda texts: [token_pieces([*ids, end_id], capacity) for ids in encode([t or "" for t in texts])]

    lists = add_columns(docs.select(id_col, text_col), load, text_col, [T.StructField(text_col, PIECES)])
    pieces = lists.select(id_col, F.inline(text_col))
    pieces = pieces.withColumn("part", F.spark_partition_id()).withColumn("row", F.monotonically_increasing_id())
    pieces = stage(pieces, "pieces")
    full = pieces.filter(F.col("length") == capacity)
    full = full.withColumns({"sequence_id": -1 - F.col("row"), "offset": F.lit(0).cast("long")})
    short = pieces.filter(F.col("length") < capacity)
    counts = short.groupBy("length", "part").count()
    sizes = {r[0]: r[1] for r in counts.groupBy("length").agg(F.sum("count")).collect()}
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select("length", "part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("length", "part").orderBy("row")
    ranked = short.withColumn("rank", F.row_number().over(inside) - 1).join(base, ["length", "part"])
    ranked = ranked.withColumn("rank", F.col("rank") + F.col("base"))
    shared = docs.sparkSession.sparkContext.broadcast(Places(plan_bins(sizes, capacity)))

    def placed(rows: list[dict]) -> tuple[np.ndarray, np.ndarray]:
        frame = pd.DataFrame(rows, columns=["length", "rank"])
        return shared.value.of(frame["length"].to_numpy(), frame["rank"].to_numpy())

    asked = ranked.withColumn("sequence_id", F.struct("length", "rank"))
    fields = [T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())]
    found = add_columns(asked, lambda: placed, "sequence_id", fields)
    columns = [id_col, "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    return found.select(columns).union(full.select(columns))
