"""Suffix-array dedup: every byte covered by a string of ``length`` bytes that also starts anywhere else.

1. Anchors. Prefix polynomial hashes give the hash of any substring in constant time. Each window of ``length`` bytes is
   owned by the least hashed gram inside it, and the windows in a row with the same owner form a segment. What a window
   owns depends on its bytes alone, so equal windows lie in segments with the same gram, at the same distance from it.
   Only these segments (about one in 128 bytes, each two hashes) are shuffled, not the suffixes.
2. Classes. Equal segments are one class: the polynomial hash of the gram and a cryptographic digest of the segment's
   bytes agree, 64 bits each. All windows of a class with two members repeat. The counts are partial aggregates, and
   the few classes that hold many segments find their members without a shuffle.
3. Suffix sort. Where different segments share a gram, one member of each class is read and cut into blocks of up to
   ``BLOCK`` window starts, keyed by the bytes that all windows of the block must hold. The suffixes of a key that start at
   the same place are mergesorted; two suffixes are compared by a binary search for their common extension over prefix
   hashes, so a comparison takes a logarithmic number of steps. Neighbours with a common extension of ``length`` bytes
   repeat, which is verified byte by byte.
4. The repeated spans of each row are gathered and joined back to the text.

A key with more than ``GROUP_ROWS`` blocks is not sorted in one task: its blocks are cut into finer ones, whose windows
share more bytes. Equal finer blocks are one class and repeat (their bytes are the grouping key), those with a key of
their own hold no repeat, and the rest is sorted or cut again, down to single windows, for which the classes are the
answer. The classes are partial aggregates, so a passage in a third of all texts makes no hot task.

Null texts are empty; texts shorter than ``length`` keep all bytes. Rows are told apart by 128 bits of hashes of id and
text, so rows with a repeated or null id are documents of their own, and a row that occurs twice repeats itself wholly.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillset.llm.common import add_columns, group_numbers, whole_groups
from quillset.session import stage

LENGTH = 400
#: Windows a gram can own at most; grams have ``length - OWNED + 1`` bytes.
OWNED = 256
#: Window starts of a block.
BLOCK = 64
#: Blocks of a key that are sorted in one task, at most.
GROUP_ROWS = 128
#: Window starts of the finer blocks into which keys with more blocks are cut, one after another.
FINER = (16, 4, 1)
#: Classes with more than this share of all segments, at most as many as its inverse, are dealt by broadcast.
HOT_SHARE = 1e-4
#: Window starts hashed at once; longer texts are hashed piece by piece.
PIECE = 1 << 20
POSITION_BITS = 21

ROW = "row_id long, tag long"


def _odd(seed: int) -> int:
    return int(np.random.default_rng(seed).integers(1 << 62, dtype=np.int64)) * 2 + 1


class PrefixHashes:
    """Hashes of all substrings of ``data``: sums of byte values times powers of an odd base, modulo 2**64."""

    _powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def __init__(self, data: np.ndarray, seed: int = 1):
        n = len(data)
        values = np.random.default_rng(seed).integers(1 << 63, size=256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        if seed not in self._powers or len(self._powers[seed][0]) < n + 1:
            base = _odd(seed + 1000)
            size = max(n + 1, 1 << 16)
            up, down = np.full(size, base, np.uint64), np.full(size, pow(base, -1, 1 << 64), np.uint64)
            up[0] = down[0] = 1
            self._powers[seed] = np.cumprod(up), np.cumprod(down)
        powers, self.inverse = self._powers[seed]
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(values[data] * powers[:n], out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (self.sums[end] - self.sums[start]) * self.inverse[start]

    def grams(self, k: int) -> np.ndarray:
        n = len(self.sums) - k
        return mixed((self.sums[k:] - self.sums[:-k]) * self.inverse[:n])


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(29))


def sliding_least(x: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` values in a row: prefix and suffix minima of blocks of that width."""
    n = len(x)
    padded = np.full(-(-n // width) * width, np.iinfo(x.dtype).max, x.dtype)
    padded[:n] = x
    rows = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(rows, axis=1).ravel()
    behind = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[: n - width + 1], ahead[width - 1 : n])


def segments(data: np.ndarray, length: int, owned: int) -> Iterator[tuple[np.ndarray, ...]]:
    """Arrays (first window, last window, place of the gram, hash of the gram, hash of the segment), piece by piece."""
    k = length - owned + 1
    for at in range(0, len(data) - length + 1, PIECE):
        part = data[at : at + PIECE + length - 1]
        grams = PrefixHashes(part).grams(k)
        low = np.uint64((1 << POSITION_BITS) - 1)
        owner = sliding_least((grams & ~low) | np.arange(len(grams), dtype=np.uint64), owned) & low
        owner = owner.astype(np.int64)
        start = np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1])))
        last = np.concatenate((start[1:], [len(owner)])) - 1
        place = owner[start]
        raw = part.tobytes()
        whole = b"".join(
            hashlib.blake2b(raw[a:b], digest_size=8).digest()
            for a, b in zip(start.tolist(), (last + length).tolist(), strict=True)
        )
        yield start + at, last + at, place + at, grams[place].view(np.int64), np.frombuffer(whole, "<i8")


def as_bytes(text: str | bytes | None) -> np.ndarray:
    raw = text.encode("utf-8", "surrogatepass") if isinstance(text, str) else text or b""
    return np.frombuffer(raw, np.uint8)


def row_key(id_col: str, text_col: str) -> tuple[Column, Column]:
    """128 bits that tell rows apart by id and text: two hashes that begin with different seeds."""
    return F.xxhash64(id_col, text_col), F.xxhash64(F.lit(7), text_col, id_col)


def anchors(docs: DataFrame, length: int, owned: int) -> DataFrame:
    """One row per segment of the texts in (row_id, tag, text)."""

    def found(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            parts: list[tuple] = []
            size = 0
            for row_id, tag, text in zip(frame["row_id"], frame["tag"], frame["text"], strict=True):
                for part in segments(as_bytes(text), length, owned):
                    parts.append((np.full(len(part[0]), row_id), np.full(len(part[0]), tag), *part))
                    size += len(part[0])
                    if size > 50_000:
                        yield together(parts)
                        parts, size = [], 0
            if parts:
                yield together(parts)

    def together(parts: list[tuple]) -> pd.DataFrame:
        names = ["row_id", "tag", "start", "last", "place", "gram", "segment"]
        return pd.DataFrame({n: np.concatenate(x) for n, x in zip(names, zip(*parts, strict=True), strict=True)})

    return docs.mapInPandas(found, f"{ROW}, start long, last long, place long, gram long, segment long")


def blocks(wanted: DataFrame, docs: DataFrame, length: int) -> DataFrame:
    """The bytes of the wanted segments in blocks: (key, row_id, tag, start, lead, alone, data).

    ``lead`` is how far the first start lies before the last one that the block could have.
    """
    parts = ["start", "last", "place", "gram", "alone"]
    packed = F.array("start", "last", "place", "gram", F.col("alone").cast("long"))
    lists = wanted.groupBy("row_id", "tag").agg(F.flatten(F.collect_list(packed)).alias("segments"))
    joined = docs.join(lists.withColumnsRenamed({"row_id": "r", "tag": "t"}), F.expr("row_id = r and tag = t"))

    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        before = None
        for frame in frames:
            rows = []
            for row_id, tag, text, found in zip(*[frame[c] for c in ("row_id", "tag", "text", "segments")], strict=True):
                if (row_id, tag) == before:  # equal rows follow each other after the join; their blocks are the same
                    continue
                before = row_id, tag
                raw = as_bytes(text)
                for start, last, place, gram, alone in np.reshape(found, (-1, len(parts))).tolist():
                    core_hash = PrefixHashes(raw[start : last + length])
                    ends = np.arange(place, start - 1, -BLOCK)
                    ends = ends[ends - BLOCK < last]
                    cores = core_hash.of(ends - start, ends - start + length - BLOCK + 1)
                    keys = mixed(cores + (place - ends).astype(np.uint64)).view(np.int64) ^ gram
                    for key, end in zip(keys.tolist(), ends.tolist(), strict=True):
                        low, high = max(start, end - BLOCK + 1), min(last, end)
                        rows.append((key, row_id, tag, low, end - low, alone > 0, raw[low : high + length].tobytes()))
                if len(rows) > 5000:
                    yield pd.DataFrame(rows, columns=names)
                    rows = []
            if rows:
                yield pd.DataFrame(rows, columns=names)

    names = ["key", "row_id", "tag", "start", "lead", "alone", "data"]
    kinds = f"key long, {ROW}, start long, lead int, alone boolean, data binary"
    return joined.select("row_id", "tag", "text", "segments").mapInPandas(cut, kinds)


class SuffixSort:
    """Mergesort of the suffixes at ``at`` inside classes (runs of equal ``kind``), by their first ``length`` bytes."""

    def __init__(self, data: np.ndarray, length: int):
        self.data, self.length, self.hashes = data, length, PrefixHashes(data)

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Length of the common extension of the suffixes a and b, at most ``length``: binary search over hashes."""
        low, high = np.zeros(len(a), np.int64), np.full(len(a), self.length, np.int64)
        for _ in range(self.length.bit_length()):
            middle = (low + high + 1) >> 1
            same = self.hashes.of(a, a + middle) == self.hashes.of(b, b + middle)
            low, high = np.where(same, middle, low), np.where(same, high, middle - 1)
        return low

    def before(self, a: np.ndarray, b: np.ndarray, or_equal: np.ndarray) -> np.ndarray:
        size = self.common(a, b)
        end = size == self.length
        size = np.where(end, 0, size)
        return np.where(end, or_equal, self.data[a + size] < self.data[b + size])

    def order(self, at: np.ndarray, kind: np.ndarray) -> np.ndarray:
        """Numbers of the suffixes in order. All classes are merged side by side, runs of 1, 2, 4, ... each."""
        n = len(at)
        begin = np.flatnonzero(np.concatenate(([True], kind[1:] != kind[:-1]))) if n else np.zeros(0, int)
        size = np.diff(np.concatenate((begin, [n])))
        first, count = np.repeat(begin, size), np.repeat(size, size)
        order, run = np.arange(n), 1
        while len(size) and run < size.max():
            place = np.arange(n) - first
            mine = place // run
            other = mine ^ 1
            low = np.minimum(other * run, count)
            high = np.minimum(low + run, count)
            base = first + low
            left = mine % 2 == 0
            a, b = np.zeros(n, np.int64), high - low
            while len(open_ := np.flatnonzero(a < b)):
                middle = (a[open_] + b[open_]) >> 1
                rival = at[order[base[open_] + middle]]
                ahead = self.before(rival, at[order[open_]], ~left[open_])
                a[open_] = np.where(ahead, middle + 1, a[open_])
                b[open_] = np.where(ahead, b[open_], middle)
            target = first + (mine // 2) * 2 * run + (place - mine * run) + a
            merged = np.empty_like(order)
            merged[target] = order
            order, run = merged, run * 2
        return order

    def repeated(self, at: np.ndarray, kind: np.ndarray) -> np.ndarray:
        """Whether each suffix shares its first ``length`` bytes with another of its class."""
        order = self.order(at, kind)
        here, after = order[:-1], order[1:]
        pairs = np.flatnonzero(kind[here] == kind[after])
        pairs = pairs[self.common(at[here[pairs]], at[after[pairs]]) == self.length]
        found = np.zeros(len(at), bool)
        for i in range(0, len(pairs), 4096):
            a, b = here[pairs[i : i + 4096]], after[pairs[i : i + 4096]]
            width = np.arange(self.length)
            same = (self.data[at[a][:, None] + width] == self.data[at[b][:, None] + width]).all(1)
            if not same.all():  # two different suffixes with one hash: settle their classes by the bytes themselves
                return self.repeated_exactly(at, kind)
            found[a] = found[b] = True
        return found

    def repeated_exactly(self, at: np.ndarray, kind: np.ndarray) -> np.ndarray:
        raw = self.data.tobytes()
        seen: dict[tuple, list[int]] = {}
        for i, (p, k) in enumerate(zip(at.tolist(), kind.tolist(), strict=True)):
            seen.setdefault((k, raw[p : p + self.length]), []).append(i)
        found = np.zeros(len(at), bool)
        found[[i for rows in seen.values() if len(rows) > 1 for i in rows]] = True
        return found


def repeats_in_blocks(frame: pd.DataFrame, length: int) -> pd.DataFrame:
    """Spans of the rows marked ``alone`` that repeat in another block of the same key."""
    group = group_numbers(frame, ["key"])
    data = [as_bytes(x) for x in frame["data"]]
    sizes = np.array([len(x) for x in data])
    starts = sizes - length + 1
    row = np.repeat(np.arange(len(frame)), starts)
    step = np.arange(len(row)) - np.repeat(np.cumsum(starts) - starts, starts)
    at = np.repeat(np.cumsum(sizes) - sizes, starts) + step
    kind = group[row] * np.int64(BLOCK) + (frame["lead"].to_numpy()[row] - step)
    by_kind = np.argsort(kind, kind="stable")
    row, step, at, kind = row[by_kind], step[by_kind], at[by_kind], kind[by_kind]
    twice = np.zeros(len(kind), bool)
    same = kind[1:] == kind[:-1]
    twice[1:] |= same
    twice[:-1] |= same
    row, step, at, kind = row[twice], step[twice], at[twice], kind[twice]
    hit = SuffixSort(np.concatenate(data), length).repeated(at, kind) & frame["alone"].to_numpy(bool)[row]
    row, step = row[hit], step[hit]
    by_row = np.lexsort((step, row))
    row, step = row[by_row], step[by_row]
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (step[1:] != step[:-1] + 1)
    head = np.flatnonzero(new)
    tail = np.concatenate((head[1:], [len(row)])).astype(int)[: len(head)] - 1
    origin = frame["start"].to_numpy()
    return pd.DataFrame(
        {
            "row_id": frame["row_id"].to_numpy()[row[head]],
            "tag": frame["tag"].to_numpy()[row[head]],
            "start": origin[row[head]] + step[head],
            "end": origin[row[head]] + step[tail] + length,
        }
    )


def sorted_repeats(found: DataFrame, length: int) -> DataFrame:
    """Spans found by the suffix sort; keys with many blocks are first cut into finer ones, by ``FINER``."""
    span = f"{ROW}, start long, end long"

    def sort(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in whole_groups(frames, ["key"], 4000):
            yield repeats_in_blocks(frame, length)

    spans = None
    columns = ["key", "row_id", "tag", "start", "lead", "alone", "data"]
    for size in FINER:
        sizes = found.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.max("alone").alias("any_alone"))
        sized = found.join(sizes.filter("n > 1 and any_alone"), "key")
        usual = sized.filter(F.col("n") <= GROUP_ROWS).select(columns)
        usual = usual.repartition("key").sortWithinPartitions("key").mapInPandas(sort, span)
        spans = usual if spans is None else spans.union(usual)
        finer = stage(finer_blocks(sized.filter(F.col("n") > GROUP_ROWS).select(columns), size, length), "finer-blocks")
        if finer.isEmpty():
            break
        same = ["key", "lead", "data"]
        classes = finer.groupBy(*same).agg(
            F.count(F.lit(1)).alias("members"),
            F.max("alone").alias("any_alone"),
            *[F.first(c).alias(c) for c in ("row_id", "tag", "start")],
        )
        copied = finer.filter("alone").join(classes.filter("members > 1").select(*same), same)
        end = F.col("start") + F.octet_length("data")
        spans = spans.union(copied.select("row_id", "tag", "start", end.alias("end")))
        found = classes.withColumn("alone", F.col("any_alone") & (F.col("members") == 1)).select(columns)
    return spans


def finer_blocks(hot: DataFrame, size: int, length: int) -> DataFrame:
    """Blocks cut into blocks of ``size`` window starts, keyed by the longer part that all their windows hold."""

    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for x in frame.itertuples(index=False):
                raw = as_bytes(x.data)
                n = len(raw) - length + 1
                part = np.arange((x.lead - n + 1) // size, x.lead // size + 1)
                high, low = x.lead - part * size, x.lead - part * size - size + 1
                cores = mixed(PrefixHashes(raw).of(high, low + length) + part.astype(np.uint64))
                keys = (mixed(cores ^ np.int64(x.key).astype(np.uint64))).view(np.int64).tolist()
                for key, top, a, b in zip(keys, high.tolist(), low.tolist(), high.tolist(), strict=True):
                    a, b = max(a, 0), min(b, n - 1)
                    piece = raw[a : b + length].tobytes()
                    rows.append((key, x.row_id, x.tag, x.start + a, top - a, x.alone, piece))
            yield pd.DataFrame(rows, columns=["key", "row_id", "tag", "start", "lead", "alone", "data"])

    return hot.mapInPandas(cut, f"key long, {ROW}, start long, lead int, alone boolean, data binary")


def remove_repeats(
    docs: DataFrame, id_col="doc_id", text_col="text", length: int = LENGTH, owned: int = OWNED, as_text=False
) -> DataFrame:
    """All columns of ``docs``, ``repeats`` (merged, sorted byte spans: start, end) and ``kept`` (the other bytes).

    With ``as_text`` what is kept is text, without the halves of characters that a cut has broken.

    The id must be an integer. Texts are shuffled twice, each time joined by row with what was found in them. Columns
    named ``repeats`` or ``kept`` are replaced.
    """
    key = row_key(id_col, text_col)
    rows = docs.select(key[0].alias("row_id"), key[1].alias("tag"), F.col(text_col).alias("text"))
    rows = rows.filter(F.octet_length("text") >= length)
    found = stage(anchors(rows, length, owned), "segments")
    classes = found.groupBy("gram", "segment").agg(
        F.count(F.lit(1)).alias("members"),
        *[F.first(c).alias(c) for c in ("row_id", "tag", "start", "last", "place")],
    )
    classes = stage(classes, "segment-classes")
    segments_ = classes.agg(F.sum("members")).first()[0] or 0
    hot = F.col("members") > max(1000, segments_ * HOT_SHARE)
    repeated = classes.filter("members > 1").withColumn("hot", hot).select("gram", "segment", "hot")
    many = F.broadcast(repeated.filter("hot"))
    marked = found.join(many, ["gram", "segment"], "left")
    span = ["row_id", "tag", "start", (F.col("last") + length).alias("end")]
    few = marked.filter("hot is null").drop("hot").join(repeated.filter("not hot"), ["gram", "segment"])
    copies = marked.filter("hot").select(span).union(few.select(span))
    grams = classes.groupBy("gram").agg(
        F.count(F.lit(1)).alias("classes"), F.max(F.col("members") == 1).alias("any_alone")
    )
    wanted = classes.join(grams.filter("classes > 1 and any_alone").select("gram"), "gram")
    wanted = wanted.withColumn("alone", F.col("members") == 1)
    spans = copies.union(sorted_repeats(stage(blocks(wanted, rows, length), "segment-blocks"), length))
    spans = spans.groupBy("row_id", "tag").agg(F.collect_set(F.struct("start", "end")).alias("repeats"))
    spans = spans.withColumnsRenamed({"row_id": "span_row", "tag": "span_tag"})
    plain = docs.drop("repeats", "kept").withColumns({"row_id_": key[0], "tag_": key[1]})
    joined = plain.join(spans, F.expr("row_id_ = span_row and tag_ = span_tag"), "left")
    joined = joined.withColumn("repeats", F.struct(F.col(text_col).alias("text"), "repeats"))
    joined = joined.drop("row_id_", "tag_", "span_row", "span_tag")
    kind = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))
    fields = [T.StructField("repeats", kind), T.StructField("kept", T.StringType() if as_text else T.BinaryType())]

    def load():
        def cut(rows: list[dict]) -> tuple[list, list]:
            spans, kept = cut_repeats(rows)
            return spans, [k.decode("utf-8", "ignore") for k in kept] if as_text else kept

        return cut

    return add_columns(joined, load, "repeats", fields)


def cut_repeats(rows: list[dict]) -> tuple[list, list]:
    spans, kept = [], []
    for row in rows:
        raw = (row["text"] or "").encode("utf-8", "surrogatepass")
        found: list[list[int]] = []
        for start, end in sorted((s["start"], s["end"]) for s in row["repeats"] or ()):
            if found and start <= found[-1][1]:
                found[-1][1] = max(found[-1][1], end)
            else:
                found.append([start, end])
        ends = [0, *[end for _, end in found]]
        starts = [*[start for start, _ in found], len(raw)]
        kept.append(b"".join(raw[a:b] for a, b in zip(ends, starts, strict=True)))
        spans.append([{"start": a, "end": b} for a, b in found])
    return spans, kept

