"""Token ids in binary files, coded by a static range asymmetric numeral system.

Writing. Texts become ids with an end id, once; the ids are staged and counted, and the counts of all documents make one
shared frequency table, which is written beside the data. The documents are put into ascending order of their id by range
partitioning, and each partition cuts its run of ids into blocks of ``BLOCK`` ids, documents or not. A block is coded by
itself: ``LANES`` interleaved states take the ids in turn, from the last to the first, and give up 32-bit words that the
decoder takes back in the opposite order. Many blocks are coded side by side, one array operation for all their lanes.

File format. ``ids/part-*`` are blocks (frames) one after another, at most ``FRAMES_PER_FILE`` to a file, each closed by a
line feed; ``table/part-*`` is the frequency table. All numbers are little-endian.

    frame: "QRA1", crc32 of what follows | size of the frame, part, block, ids, words, documents, crc32 of the ids (uint32),
           ids of the part before the block, number of its first document in the part (int64) |
           of each document with ids here: doc_id, ids before the block, ids in all (int64), doc_id is null (uint8) |
           checkpoints, every ``SEGMENT`` steps: words read so far (uint32), state of each lane (uint64) | words (uint32)

Reading. A frame needs nothing but itself and the table, so files are decoded in parallel, and inside a block the
checkpoints let all its segments be decoded side by side. The checksums of the frame and of its ids are compared, and each
segment must end in the state of the next checkpoint (the last one in the state that coding began with); damage raises.
Documents that span blocks or files come in parts, whose CRCs are joined without their ids.

Null and empty texts are the end id alone. Rows with null ids come first; rows with one id follow each other by length and
checksum, and equal rows in the order of the staged table. Columns other than id and text are not read. An empty table
gives files without frames. Very long texts are coded whole; a task holds ``BLOCKS_AT_ONCE`` blocks and one document.
"""

from __future__ import annotations

import struct
import zlib
from array import array
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillset.llm.common import add_columns
from quillset.session import scratch_path, stage

END_ID = 1
#: Ids of a block, states of a block, steps between two checkpoints.
BLOCK, LANES, SEGMENT = 1 << 15, 32, 256
#: Blocks coded side by side.
BLOCKS_AT_ONCE = 32
FRAMES_PER_FILE = 256
#: Ids of a partition, about.
PART_IDS = 1 << 24
#: The frequencies sum to two to this power, or more for large vocabularies.
LEAST_BITS = 18
LOW = np.uint64(1 << 31)
WORD = np.uint64(32)
#: Words kept with their ids in a worker, and the longest that is kept.
CACHED_WORDS, MOST_BYTES = 800_000, 48
#: Bytes of texts that become ids at once, about.
BYTES_AT_ONCE = 1 << 23
#: Letters of Latin-1, which are one code point in the normal form, and ASCII signs that are no letter, digit or apostrophe.
PLAIN, MARKS = "A-Za-zÀ-ÖØ-öø-ÿ", "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"

#: Layouts; heads of frames are two of them in a row.
HEAD, FRAME, TABLE = "<4sI", "<7I2q", "<4s3I"
HEAD_SIZE, TABLE_SIZE = struct.calcsize(HEAD), struct.calcsize(TABLE)
HEADS_SIZE = HEAD_SIZE + struct.calcsize(FRAME)

#: A column of texts to the ids of all of them in a row, and how many each has.
Encoder = Callable[[pa.Array], tuple[np.ndarray, np.ndarray]]


class WordIds:
    """Ids by the tokenizers library, which is asked once for each word between blanks and line feeds.

    The vocabulary's pattern matches no white space and nothing of the normalization looks beyond it, so the ids of a
    text are those of its words in turn. Most words are letters of ``PLAIN`` with signs of ``MARKS`` behind them, which the
    pattern parts from letters: both are whole matches, and the library's model is asked for their ids, the letters in
    lower case and spelled as the vocabulary spells bytes. All other words go through the library as they are. The tests
    compare with whole texts. Words are told apart in Arrow, and what is kept of them is bounded.
    """

    def __init__(self, path: str | None = None):
        import public_tokenizers
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path or public_tokenizers.path("word_bpe_49k.json"))
        spell = self.tokenizer.pre_tokenizer.pre_tokenize_str
        self.spelled = {c: spell(chr(c))[0][0] for c in [*range(0xDF, 0xF7), *range(0xF8, 0x100)]}
        self.forget()

    def forget(self) -> None:
        self.matches: dict[str, int] = {"": 0}
        self.words: dict[str, int] = {}
        self.ids = array("I")
        self.begin = array("Q", [0, 0])  # of each number's ids, and the end of the last

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        lists = pc.split_pattern(pc.replace_substring(pc.fill_null(texts, ""), "\n", " "), " ")
        words = lists.flatten().dictionary_encode()
        if len(self.begin) + len(words.dictionary) > CACHED_WORDS:
            self.forget()
        ids, begin = self.of_words(words.dictionary)
        at, sizes = gathered(begin, words.indices.to_numpy())
        ends = np.append(0, np.cumsum(sizes))[lists.offsets.to_numpy() - lists.offsets[0].as_py()]
        return ids[at], np.diff(ends)

    def of_words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of distinct words in a row, and where each word's begin."""
        core = pc.utf8_rtrim(words, characters=MARKS)
        plain = pc.and_(pc.match_substring_regex(core, f"^[{PLAIN}]+$"), pc.less(pc.binary_length(words), MOST_BYTES))
        is_plain = plain.to_numpy(zero_copy_only=False)
        numbers = np.zeros((len(words), 2), np.int64)
        letters = pc.utf8_lower(core.filter(plain)).dictionary_encode()
        numbers[is_plain, 0] = self.of_matches(letters)
        marked = pc.and_(plain, pc.not_equal(core, words))
        marks = pc.replace_substring_regex(words.filter(marked), f"^[{PLAIN}]+", "").dictionary_encode()
        numbers[marked.to_numpy(zero_copy_only=False), 1] = self.of_matches(marks)
        numbers[~is_plain, 0] = self.of_others(words.filter(pc.invert(plain)).to_pylist())
        at, sizes = gathered(np.frombuffer(self.begin, np.uint64).astype(np.int64), numbers.ravel())
        ids = np.frombuffer(self.ids, np.uint32)[at]
        return ids, np.append(0, np.cumsum(sizes.reshape(-1, 2).sum(1)))

    def of_matches(self, texts: pa.DictionaryArray) -> np.ndarray:
        known, ask, keep, end = self.matches, self.tokenizer.model.tokenize, self.ids.extend, self.begin.append
        distinct = texts.dictionary.to_pylist()
        numbers = list(map(known.get, distinct))
        total = len(self.ids)
        for i, number in enumerate(numbers):
            if number is None:
                x = distinct[i]
                ids = [t.id for t in ask(x if x.isascii() else x.translate(self.spelled))]
                total += len(ids)
                keep(ids)
                numbers[i] = known[x] = len(self.begin) - 1
                end(total)
        return np.array(numbers, np.int64)[texts.indices.to_numpy()]

    def of_others(self, words: list[str]) -> list[int]:
        new = [w for w in words if w not in self.words]
        for at in range(0, len(new), 1000):
            some = new[at : at + 1000]
            for w, e in zip(some, self.tokenizer.encode_batch_fast(some, add_special_tokens=False), strict=True):
                self.words[w] = self.add(e.ids)
        found = [self.words[w] for w in words]
        for w in new:
            if len(w) > MOST_BYTES:
                del self.words[w]
        return found

    def add(self, ids: list[int]) -> int:
        self.ids.extend(ids)
        self.begin.append(len(self.ids))
        return len(self.begin) - 2


def of_bytes(batch: pa.RecordBatch, most: int) -> Iterator[pa.RecordBatch]:
    """Slices of a batch whose texts, the second column, have about so many bytes."""
    sizes = pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False)
    share = np.cumsum(sizes, dtype=np.int64) // most
    edges = [0, *(np.flatnonzero(np.diff(share)) + 1).tolist(), batch.num_rows]
    return (batch.slice(a, b - a) for a, b in zip(edges[:-1], edges[1:], strict=True) if b > a)


def gathered(begin: np.ndarray, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The places of the entries of ``numbers``, and how many each has."""
    size = begin[numbers + 1] - begin[numbers]
    first = np.cumsum(size) - size
    return np.arange(size.sum()) + np.repeat(begin[numbers] - first, size), size


@dataclass
class Table:
    """Shared frequencies: ``ids`` (ascending) with positive ``freq`` that sum to ``1 << bits``."""

    ids: np.ndarray
    freq: np.ndarray
    bits: int
    start: np.ndarray = field(init=False)

    def __post_init__(self):
        self.start = (np.cumsum(self.freq) - self.freq).astype(np.uint64)

    @classmethod
    def of_counts(cls, counts: dict[int, int]) -> Table:
        """Counts scaled to a power of two, none below one; what rounding leaves over goes to the most frequent."""
        ids = np.array(sorted(counts), np.int64)
        number = np.array([counts[i] for i in ids.tolist()], np.float64)
        bits = max(LEAST_BITS, (4 * len(ids)).bit_length())
        freq = np.maximum(1, number * ((1 << bits) / max(number.sum(), 1))).astype(np.int64)
        by_size = np.argsort(-freq, kind="stable")
        left = (1 << bits) - int(freq.sum())
        while left and len(ids):
            if left > 0:
                freq[by_size[0]] += left
                break
            cut = np.minimum(freq[by_size] // 2, np.maximum(1, freq[by_size] * -left // freq.sum()))
            cut = np.minimum(cut, np.maximum(0, -left - (np.cumsum(cut) - cut)))
            freq[by_size] -= cut
            left += int(cut.sum())
        return cls(ids.astype(np.uint32), freq.astype(np.uint64), bits)

    def to_bytes(self) -> bytes:
        body = self.ids.astype("<u4").tobytes() + self.freq.astype("<u4").tobytes()
        return struct.pack(TABLE, b"QRT1", zlib.crc32(body), self.bits, len(self.ids)) + body

    @classmethod
    def from_bytes(cls, raw: bytes) -> Table:
        magic, crc, bits, n = struct.unpack_from(TABLE, raw)
        body = raw[TABLE_SIZE : TABLE_SIZE + 8 * n]
        if magic != b"QRT1" or zlib.crc32(body) != crc:
            raise ValueError("the frequency table is damaged")
        numbers = np.frombuffer(body, "<u4")
        return cls(numbers[:n].copy(), numbers[n:].astype(np.uint64), bits)

    def encode(self, symbols: np.ndarray) -> list[tuple[bytes, np.ndarray, np.ndarray, np.ndarray]]:
        """Code blocks of one size, (block, step, lane): words, number of words, checkpoints (words before, states)."""
        blocks, steps, lanes = symbols.shape
        state = np.full((blocks, lanes), LOW, np.uint64)
        words = np.empty((steps, blocks, lanes), np.uint32)
        full = np.empty((steps, blocks, lanes), bool)
        marks = -(-steps // SEGMENT)
        states = np.empty((blocks, marks, lanes), np.uint64)
        room, bits = np.uint64(63 - self.bits), np.uint64(self.bits)
        for t in range(steps - 1, -1, -1):
            now = symbols[:, t]
            freq = self.freq[now]
            over = state >= freq << room
            words[t], full[t] = state.astype(np.uint32), over
            state = np.where(over, state >> WORD, state)
            whole = state // freq
            state = (whole << bits) + (state - whole * freq) + self.start[now]
            if t % SEGMENT == 0:
                states[:, t // SEGMENT] = state
        before = np.cumsum(full.sum(2), axis=0)
        places = np.zeros((blocks, marks), np.uint32)
        for k in range(1, marks):
            places[:, k] = before[k * SEGMENT - 1]
        out = []
        for b in range(blocks):
            own = words[:, b][full[:, b]]
            out.append((own.astype("<u4").tobytes(), len(own), places[b], states[b]))
        return out

    def lookup(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.ids), dtype=np.uint32), self.freq.astype(np.int64))

    def decode(
        self, lookup: np.ndarray, steps: np.ndarray, states: np.ndarray, places: np.ndarray, words: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Decode segments of ``steps`` steps side by side: ids (segment, step, lane), the last states and places."""
        state, place, most = states.copy(), places.astype(np.int64), int(steps.max(initial=0))
        out = np.zeros((len(steps), most, states.shape[1]), np.uint32)
        mask, bits = np.uint64((1 << self.bits) - 1), np.uint64(self.bits)
        words = np.append(words, np.uint32(0)).astype(np.uint64)
        order = np.argsort(-steps, kind="stable")  # segments that are still going are the first so many
        state, place, steps = state[order], place[order], steps[order]
        ended_state, ended_place = state.copy(), place.copy()
        going = len(steps)
        for t in range(most):
            while steps[going - 1] <= t:
                going -= 1
                ended_state[going], ended_place[going] = state[going], place[going]
            x = state[:going]
            slot = x & mask
            symbol = lookup[slot]
            out[order[:going], t] = self.ids[symbol]
            x = self.freq[symbol] * (x >> bits) + slot - self.start[symbol]
            low = x < LOW
            at = place[:going, None] + np.cumsum(low, axis=1)
            x = np.where(low, (x << WORD) | words[np.minimum(at - 1, len(words) - 1)], x)
            state[:going], place[:going] = x, at[:, -1]
        ended_state[:going], ended_place[:going] = state[:going], place[:going]
        back = np.argsort(order)
        return out, ended_state[back], ended_place[back]


@dataclass
class Documents:
    """Documents that have ids in a block: id, null or not, ids before the block, ids in all."""

    first: int = 0
    rows: list[tuple[int, bool, int, int]] = field(default_factory=list)


def frame(part: int, block: int, before: int, ids: np.ndarray, docs: Documents, coded: tuple) -> bytes:
    words, n_words, places, states = coded
    rows = docs.rows
    directory = np.array([(r[0], r[2], r[3]) for r in rows], "<i8").T.tobytes() + bytes(r[1] for r in rows)
    body = directory + places.astype("<u4").tobytes() + states.astype("<u8").tobytes() + words
    crc = zlib.crc32(ids.astype("<u4").tobytes())
    size = HEADS_SIZE + len(body)
    head = struct.pack(FRAME, size, part, block, len(ids), n_words, len(rows), crc, before, docs.first)
    return struct.pack(HEAD, b"QRA1", zlib.crc32(body, zlib.crc32(head))) + head + body


class PartWriter:
    """Cuts the ids of a partition into blocks and codes them, ``BLOCKS_AT_ONCE`` at a time."""

    def __init__(self, table: Table, part: int):
        self.table, self.part = table, part
        self.number = np.full(int(table.ids.max(initial=0)) + 1, -1, np.int64)
        self.number[table.ids] = np.arange(len(table.ids))
        self.common = int(table.freq.argmax()) if len(table.ids) else 0
        self.held: list[np.ndarray] = []
        self.size = self.block = self.before = self.documents = 0
        self.open: list[tuple[int, bool, int]] = []  # documents with ids that are not coded yet
        self.coded_of_first = 0

    def add(self, doc_id: int | None, ids: np.ndarray) -> Iterator[bytes]:
        self.held.append(ids.astype(np.uint32, copy=False))
        self.open.append((doc_id or 0, doc_id is None, len(ids)))
        self.size += len(ids)
        if self.size >= BLOCK * BLOCKS_AT_ONCE:
            yield from self.blocks(BLOCK)

    def end(self) -> Iterator[bytes]:
        yield from self.blocks(BLOCK)
        if self.size:
            yield from self.blocks(self.size)

    def blocks(self, size: int) -> Iterator[bytes]:
        whole = np.concatenate(self.held) if self.held else np.zeros(0, np.uint32)
        number = len(whole) // size
        for at in range(0, number, BLOCKS_AT_ONCE):
            some = whole[at * size : min(at + BLOCKS_AT_ONCE, number) * size].reshape(-1, size)
            steps = -(-size // LANES)
            symbols = np.full((len(some), steps * LANES), self.common, np.int64)
            symbols[:, :size] = self.number[some]
            for ids, coded in zip(some, self.table.encode(symbols.reshape(-1, steps, LANES)), strict=True):
                yield frame(self.part, self.block, self.before, ids, self.directory(size), coded)
                self.block += 1
                self.before += size
        rest = whole[number * size :]
        self.held, self.size = ([rest] if len(rest) else []), len(rest)

    def directory(self, size: int) -> Documents:
        """Takes the documents of the next block from those that wait."""
        found, used = Documents(self.documents), 0
        while size:
            doc_id, null, total = self.open[used]
            found.rows.append((doc_id, null, self.coded_of_first, total))
            mine = min(size, total - self.coded_of_first)
            size -= mine
            self.coded_of_first += mine
            if self.coded_of_first == total:
                used += 1
                self.coded_of_first = 0
        del self.open[:used]
        self.documents += used
        return found


def frames_of(content: bytes) -> Iterator[bytes]:
    at = 0
    while at < len(content):
        if len(content) - at < HEADS_SIZE:
            raise ValueError("a file of token ids ends inside a frame")
        size = struct.unpack_from(FRAME, content, at + HEAD_SIZE)[0]
        one = content[at : at + size]
        if len(one) < max(size, HEADS_SIZE) or struct.unpack_from(HEAD, one)[0] != b"QRA1":
            raise ValueError("a file of token ids ends inside a frame")
        if zlib.crc32(one[HEAD_SIZE :]) != struct.unpack_from(HEAD, one)[1]:
            _, part, block, *_ = struct.unpack_from(FRAME, one, HEAD_SIZE)
            raise ValueError(f"block {block} of part {part} is damaged")
        yield one
        at += size + 1


def decoded(table: Table, lookup: np.ndarray, frames: list[bytes]) -> Iterator[tuple[tuple, np.ndarray, np.ndarray]]:
    """(head, directory, ids) of each frame; the segments of all of them are decoded side by side."""
    heads, directories, steps, states, places, words, n_segments = [], [], [], [], [], [], []
    n_words = 0
    for raw in frames:
        head = struct.unpack_from(FRAME, raw, HEAD_SIZE)
        _, _, _, n, own_words, n_docs, *_ = head
        at = HEADS_SIZE
        numbers = np.frombuffer(raw, "<i8", 3 * n_docs, at).reshape(3, -1)
        null = np.frombuffer(raw, np.uint8, n_docs, at + 24 * n_docs)
        at += 25 * n_docs
        all_steps = -(-n // LANES)
        marks = -(-all_steps // SEGMENT)
        places.append(np.frombuffer(raw, "<u4", marks, at).astype(np.int64) + n_words)
        states.append(np.frombuffer(raw, "<u8", marks * LANES, at + 4 * marks).reshape(marks, LANES).astype(np.uint64))
        words.append(np.frombuffer(raw, "<u4", own_words, at + (4 + 8 * LANES) * marks))
        steps.append(np.minimum(SEGMENT, all_steps - SEGMENT * np.arange(marks)))
        heads.append(head)
        directories.append(np.vstack((numbers, null[None])))
        n_segments.append(marks)
        n_words += own_words
    if not frames:
        return
    state, place = np.concatenate(states), np.concatenate(places)
    ids, last, read = table.decode(lookup, np.concatenate(steps), state, place, np.concatenate(words))
    first = end = 0
    for head, directory, marks in zip(heads, directories, n_segments, strict=True):
        mine, first = slice(first, first + marks), first + marks
        end += head[4]
        follows = np.vstack((state[mine][1:], np.full((1, LANES), LOW)))
        found = ids[mine].reshape(-1)[: head[3]]
        whole = (last[mine] == follows).all() and (read[mine] == np.append(place[mine][1:], end)).all()
        if not whole or zlib.crc32(found.astype("<u4").tobytes()) != head[6]:
            raise ValueError(f"block {head[2]} of part {head[1]} does not decode to its ids")
        yield head, directory, found


class JoinedCrc:
    """The CRC-32 of strings in a row, from the CRC of each and its bytes.

    A zero bit after a string is a linear map of the 32 bits of its CRC; the maps of 1, 2, 4, ... zero bits are found by
    squaring, once.
    """

    def __init__(self):
        self.maps = [[0xEDB88320, *[1 << k for k in range(31)]]]

    @staticmethod
    def times(rows: list[int], vector: int) -> int:
        out = 0
        for row in rows:
            if vector & 1:
                out ^= row
            vector >>= 1
        return out

    def __call__(self, first: int, second: int, length: int) -> int:
        """The CRC of two strings; ``length`` is the bytes of the second."""
        zeros, k = 8 * length, 0
        while zeros >> k:
            if k == len(self.maps):
                self.maps.append([self.times(self.maps[-1], row) for row in self.maps[-1]])
            if zeros >> k & 1:
                first = self.times(self.maps[k], first)
            k += 1
        return first ^ second


def write_ids(
    docs: DataFrame,
    path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    encoder: Callable[[], Encoder] = WordIds,
    end_id: int = END_ID,
) -> None:
    """Write the ids of all texts, in ascending order of the integer id, below ``path`` (``ids`` and ``table``)."""

    def tokenized(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, total = encoder(), np.zeros(0, np.int64)
        names = ["doc_id", "ids", "n", "crc", "counts"]
        for batch in (some for b in batches for some in of_bytes(b, BYTES_AT_ONCE)):
            found, sizes = encode(batch.column(1))
            ends = np.cumsum(sizes)
            whole = np.insert(found.astype("<u4"), ends, end_id)
            found = np.bincount(whole, minlength=len(total))
            found[: len(total)] += total
            total = found
            edges = 4 * np.append(0, ends + np.arange(1, len(ends) + 1))
            raw = memoryview(whole.tobytes())
            crc = [zlib.crc32(raw[a:b]) for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True)]
            if whole.max(initial=0) < 1 << 16:  # staged and shuffled in half the bytes
                raw, edges = whole.astype("<u2").tobytes(), edges // 2
            ids = pa.Array.from_buffers(pa.large_binary(), len(sizes), [None, pa.py_buffer(edges), pa.py_buffer(raw)])
            columns = [batch.column(0), ids.cast(pa.binary()), pa.array(sizes + 1), pa.array(crc, pa.int64())]
            yield pa.RecordBatch.from_arrays([*columns, pa.nulls(len(sizes), pa.binary())], names=names)
            pa.default_memory_pool().release_unused()
        held = np.flatnonzero(total)
        counts = np.stack((held, total[held])).astype("<i8").tobytes()  # the task's own counts, in a row of their own
        last = [[None], [b""], [0], [0], [counts]]
        kinds = [pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.binary()]
        yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(last, kinds, strict=True)], names=names)

    plain = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    rows = plain.mapInArrow(tokenized, "doc_id long, ids binary, n long, crc long, counts binary")
    rows = stage(rows.withColumn("row", F.monotonically_increasing_id()), "token-rows")
    table = frequencies(rows.filter("counts is not null"))
    rows = rows.filter("counts is null").drop("counts")
    spark = docs.sparkSession
    raw = spark.createDataFrame([(bytearray(table.to_bytes()),)], "value binary").coalesce(1)
    raw.select(F.col("value").cast("string").alias("value")).write.text(f"{path}/table")
    shared = spark.sparkContext.broadcast(table.to_bytes())
    parts = -(-(rows.agg(F.sum("n")).first()[0] or 0) // PART_IDS)
    parts = max(1, parts, min(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * parts))
    order = ["doc_id", "n", "crc", "row"]

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer = PartWriter(Table.from_bytes(shared.value), TaskContext.get().partitionId())
        for batch in batches:
            for doc_id, n, ids in zip(*[batch.column(i).to_pylist() for i in (0, 1)], batch.column(2), strict=True):
                for one in writer.add(doc_id, unpacked(ids.as_buffer(), n)):
                    yield pa.RecordBatch.from_arrays([pa.array([one], pa.binary())], names=["value"])
        for one in writer.end():
            yield pa.RecordBatch.from_arrays([pa.array([one], pa.binary())], names=["value"])

    placed = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    coded = placed.select("doc_id", "n", "ids").mapInArrow(code, "value binary")
    lines = coded.select(F.col("value").cast("string").alias("value"))
    lines.write.option("lineSep", "\n").option("maxRecordsPerFile", FRAMES_PER_FILE).text(f"{path}/ids")


def unpacked(raw: bytes | pa.Buffer, n: int) -> np.ndarray:
    """``n`` staged ids, of two or four bytes each."""
    return np.frombuffer(raw, "<u4" if len(raw) == 4 * n else "<u2")


def frequencies(rows: DataFrame) -> Table:
    """The shared table of all ids, from the counts of each task; as many counts as there are ids come to the driver."""

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for counts in batch.column(0):
                ids, n = np.frombuffer(counts.as_buffer(), "<i8").reshape(2, -1)
                yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(n)], names=["id", "n"])

    counts = rows.select("counts").mapInArrow(unpack, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))
    return Table.of_counts({r.id: r.n for r in counts.collect()})


PIECE = "part long, document long, doc_id long, place long, begin long, n long, total long, crc long"


def read_pieces(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """One row per document and block, decoded from the files.

    ``place`` counts the ids of the part before the piece, ``begin`` those of its document, ``total`` all ids of the
    document. With ``with_ids`` the ids themselves follow, as an array.
    """
    raw = spark.read.format("binaryFile").load(f"{path}/table").filter("length > 0").select("content").first()
    shared = spark.sparkContext.broadcast(bytes(raw[0]))
    names = [c.split()[0] for c in PIECE.split(", ")]

    def pieces(head: tuple, directory: np.ndarray, ids: np.ndarray) -> pa.RecordBatch:
        _, part, _, n, _, docs, _, before, first = head
        doc_id, begin, total, null = directory
        size = np.minimum(total - begin, n)
        start = np.cumsum(size) - size
        size = np.minimum(size, n - start)
        raw = ids.astype("<u4").tobytes()
        crc = [zlib.crc32(raw[4 * a : 4 * (a + b)]) for a, b in zip(start.tolist(), size.tolist(), strict=True)]
        columns = [np.full(docs, part), first + np.arange(docs), doc_id, before + start, begin, size, total, crc]
        arrays = [pa.array(np.asarray(x, np.int64)) for x in columns]
        arrays[2] = pa.array(np.asarray(doc_id, np.int64), mask=null.astype(bool))
        if with_ids:
            ends = pa.array(np.append(start, n).astype(np.int32))
            arrays.append(pa.ListArray.from_arrays(ends, pa.array(ids.astype(np.int32))))
        return pa.RecordBatch.from_arrays(arrays, names=[*names, *["ids"] * with_ids])

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = Table.from_bytes(shared.value)
        lookup = table.lookup()
        for batch in batches:
            for content in batch.column(0):
                some: list[bytes] = []
                for one in frames_of(content.as_py()):
                    some.append(one)
                    if len(some) == BLOCKS_AT_ONCE:
                        yield from (pieces(*x) for x in decoded(table, lookup, some))
                        some = []
                yield from (pieces(*x) for x in decoded(table, lookup, some))

    files = spark.read.format("binaryFile").load(f"{path}/ids").select("content")
    return files.mapInArrow(decode, PIECE + ", ids array<int>" * with_ids)


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of each document, from the files; ``start`` counts all ids before it."""
    pieces = stage(read_pieces(spark, path), "token-pieces")
    parts = pieces.groupBy("part").agg(F.sum("n").alias("part_ids"))
    ahead = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per part
    base = parts.select("part", F.coalesce(F.sum("part_ids").over(ahead), F.lit(0)).alias("base"))
    whole = F.col("n") == F.col("total")
    cut = pieces.filter(~whole).groupBy("part", "document").agg(
        F.first("doc_id").alias("doc_id"),
        F.min("place").alias("place"),
        F.first("total").alias("total"),
        F.sort_array(F.collect_list(F.struct("begin", "n", "crc"))).alias("crc"),
    )

    def load():
        join = JoinedCrc()

        def joined(lists: list) -> list[int]:
            found = []
            for rows in lists:
                crc = 0
                for r in rows:
                    crc = join(crc, r["crc"], 4 * r["n"])
                found.append(crc)
            return found

        return joined

    cut = add_columns(cut, load, "crc", [T.StructField("crc", T.LongType())])
    columns = ["part", "doc_id", "place", "total", "crc"]
    found = pieces.filter(whole).select(columns).union(cut.select(columns)).join(F.broadcast(base), "part")
    return found.select(
        "doc_id",
        (F.col("base") + F.col("place")).alias("start"),
        F.col("total").alias("n_tokens"),
        F.col("crc").alias("ids_crc32"),
    )


def roundtrip(docs: DataFrame, path: str | None = None, **options) -> DataFrame:
    """Write the ids of ``docs`` and read them back: one row per document, as ``read_documents`` gives them."""
    path = path or scratch_path(docs.sparkSession, "token-files")
    write_ids(docs, path, **options)
    return read_documents(docs.sparkSession, path)
