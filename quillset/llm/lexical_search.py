"""Ranked lexical search over posting lists in geometric blocks.

A document's score for an item is the sum of the impacts of the item's terms, and an impact depends on the document and
the term alone, so documents and items are sparse vectors and the score is their product.

Index. Documents are counted once into vectors over the terms that are asked for. A random projection of the vector
sends each document to the nearest of some pivots (a bounded sample of documents); these cells are split by hash until a
cell has about ``CELL_POSTINGS`` postings and ``CELL_DOCUMENTS`` documents, whatever the size of a group of copies. Inside
a cell each term has its posting list, and each list is clustered by the similarity of its documents: as many of them as
the list has blocks are centres, every document joins the most similar centre, and a block has ``BLOCK`` documents of one
centre at most. A block's summary is the coordinatewise maximum of its documents' vectors, rounded up to multiples of a
unit, so no score is above the product of the summary and the item. It has the coordinates that some item holds together
with the list's term, its partners: no item asks this list for others. A cell is one row of the index, which is written to
the shared folder.

Search. Each item's threshold comes first: in every cell the block with the best bound is scored, and the 50th best score
of all cells can only be too low. In the second pass lists whose impacts cannot reach the threshold together are left
out, and of the others those blocks are skipped whose bound is below the threshold. Documents of all other blocks are
scored exactly from their vectors, so the result is exact: a document above the threshold lies in a list that is read, and
its block has a bound that is no lower. Tasks send at most ``k`` rows of each item and cell.

Items come in shards of about ``SHARD_TERMS`` terms; a shard is what the driver holds and what is broadcast. Scores are
64-bit integers; weights are computed in doubles.

Defined results: null and empty texts have no term and count nowhere; an item without terms, or whose terms occur in no
document, has no row; rows with one doc_id are documents of their own; equal scores are ranked by ascending doc_id, null
ids last, equal ids by their place in the staged table; rows of ``items`` are items of their own, repeated ids included;
other columns are not read.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quillset.session import stage

TOP = 50
#: Documents of a block; cells before the split by hash; coordinates of the projection.
BLOCK, PIVOTS, DIMENSIONS = 64, 256, 16
#: Postings and documents of a cell, about.
CELL_POSTINGS, CELL_DOCUMENTS = 1 << 18, 1 << 12
#: Terms of all items of a shard, about.
SHARD_TERMS = 1 << 16
#: Summaries are built for so many entries at once.
ENTRIES_AT_ONCE = 1 << 22
#: Summary values are multiples of a unit up to this.
LEVELS = (1 << 8) - 1

#: Bytes that are no part of a term become blanks, A to Z become a to z.
PLAIN = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


def terms_of(text: str | None) -> list[bytes]:
    """Maximal runs of letters, digits and characters beyond ASCII, as UTF-8 with A to Z in lower case."""
    return (text or "").encode("utf-8", "surrogatepass").translate(PLAIN).split()


def item_terms(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(item, item_id, terms): a number for each row of ``items`` and its distinct terms."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [sorted(set(terms_of(t))) for t in batch.column(1).to_pylist()]
            columns = [batch.column(0), pa.array(found, pa.list_(pa.binary()))]
            yield pa.RecordBatch.from_arrays(columns, names=["item", "terms"])

    rows = items.select(F.col(id_col).alias("item_id"), F.col(text_col).cast("string").alias("text"))
    rows = stage(rows.withColumn("item", F.monotonically_increasing_id()), "items")
    found = rows.select("item", "text").mapInArrow(split, "item long, terms array<binary>")
    return stage(found.join(rows.select("item", "item_id"), "item"), "item-terms")


def vectors(docs: DataFrame, id_col: str, text_col: str, vocabulary: list[bytes]) -> DataFrame:
    """(doc_id, n, terms, counts, row): the terms of each document that are in the vocabulary, as numbers, and all its
    terms counted in ``n``."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = {t: i for i, t in enumerate(shared.value)}
        for batch in batches:
            sizes, terms, counts = [], [], []
            for text in batch.column(1):
                found = Counter(terms_of(text.as_py()))
                sizes.append(found.total())
                mine = sorted((number[t], c) for t, c in found.items() if t in number)
                both = np.array(mine, "<i8").reshape(-1, 2)
                terms.append(both[:, 0].astype("<i4").tobytes())
                counts.append(both[:, 1].astype("<i4").tobytes())
            columns = [pa.array(sizes, pa.int64()), pa.array(terms, pa.binary()), pa.array(counts, pa.binary())]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=["doc_id", "n", "terms", "counts"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    found = rows.mapInArrow(count, "doc_id long, n long, terms binary, counts binary")
    return stage(found.withColumn("row", F.monotonically_increasing_id()), "term-vectors")


@dataclass
class Weights:
    """What impacts are made of: weight of each term, documents with terms, all terms."""

    weight: np.ndarray
    documents: int
    terms: int

    def impacts(self, term: np.ndarray, count: np.ndarray, n: np.ndarray) -> np.ndarray:
        long_ = 50 + (50 * n * self.documents) // max(self.terms, 1)
        return self.weight[term] * ((1_000_000_000 * count) // (1000 * count + 20 * long_))


def weights(rows: DataFrame, size: int) -> Weights:
    """Counts over all documents; tasks count the documents of each term, and ``size`` numbers come to the driver."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for batch in batches:
            whole = b"".join(x.as_buffer().to_pybytes() for x in batch.column(0))
            total += np.bincount(np.frombuffer(whole, "<i4"), minlength=size)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(total[held])], names=["term", "n"])

    held = np.zeros(size, np.int64)
    for r in rows.select("terms").mapInArrow(count, "term long, n long").groupBy("term").agg(F.sum("n")).collect():
        held[r[0]] = r[1]
    documents, terms = rows.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
    weight = [math.floor(1000 * math.log((2 * documents + 2) / (2 * x + 1))) for x in held.tolist()]
    return Weights(np.array(weight, np.int64), documents, terms)


def sparse(terms: list[bytes], counts: list[bytes], n: np.ndarray, by: Weights) -> tuple[np.ndarray, ...]:
    """Vectors in a row: where each begins (and the last ends), terms, counts, impacts; terms without impact go."""
    term = np.frombuffer(b"".join(terms), "<i4").astype(np.int64)
    size = np.array([len(t) // 4 for t in terms], np.int64)
    row = np.repeat(np.arange(len(size)), size)
    count = np.frombuffer(b"".join(counts), "<i4").astype(np.int64)
    impact = by.impacts(term, count, n[row])
    some = impact > 0
    begin = np.zeros(len(size) + 1, np.int64)
    np.cumsum(np.bincount(row[some], minlength=len(size)), out=begin[1:])
    return begin, term[some], count[some], impact[some]


def projected(begin: np.ndarray, term: np.ndarray, impact: np.ndarray, size: int) -> np.ndarray:
    """Unit vectors of ``DIMENSIONS`` coordinates that keep angles, about: random signs by term."""
    signs = np.random.default_rng(11).integers(0, 2, (size, DIMENSIONS)).astype(np.float32) * 2 - 1
    out = np.zeros((len(begin) - 1, DIMENSIONS), np.float32)
    some = np.flatnonzero(np.diff(begin))
    for at in range(0, len(some), 512):
        rows = some[at : at + 512]
        low, high = begin[rows[0]], begin[rows[-1] + 1]
        out[rows] = np.add.reduceat(signs[term[low:high]] * impact[low:high, None].astype(np.float32), begin[rows] - low)
    return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-30)


def expanded(begin: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The places of the entries of ``rows``, and how many each has."""
    size = begin[rows + 1] - begin[rows]
    first = np.cumsum(size) - size
    return np.arange(size.sum()) + np.repeat(begin[rows] - first, size), size


#: Arrays of a cell in the order of their columns: name and type.
ARRAYS = [
    ("id", "<i8"),
    ("no_id", "u1"),
    ("row", "<i8"),
    ("n", "<i8"),  # terms of each document
    ("begin", "<i8"),  # of each document's vector, and the end of the last
    ("term", "<i4"),  # numbers of ``own``
    ("count", "<i4"),
    ("own", "<i4"),  # the terms of the cell
    ("lists", "<i4"),  # first block of each term's list, and the end of the last
    ("blocks", "<i4"),  # first place of each block in ``members``, and the end of the last
    ("members", "<i4"),  # documents
    ("summary", "u1"),  # of each term's list: a row for each block, a column for each partner of the term
]
CELL = "unit long, " + ", ".join(f"{name} binary" for name, _ in ARRAYS)


@dataclass
class Asked:
    """The terms of each item of a shard, and of each term the partners that it has in some item, all ascending."""

    items: list[np.ndarray]
    partners: list[np.ndarray]

    @classmethod
    def of(cls, items: list[list[int]], size: int) -> Asked:
        holders: list[list[int]] = [[] for _ in range(size)]
        for i, terms in enumerate(items):
            for t in terms:
                holders[t].append(i)
        arrays = [np.array(x, np.int64) for x in items]
        once: dict[tuple, np.ndarray] = {}  # terms of the same items share their partners
        for held in map(tuple, holders):
            if held not in once:
                once[held] = np.unique(np.concatenate([np.zeros(0, np.int64), *[arrays[i] for i in held]]))
        return cls(arrays, [once[tuple(held)] for held in holders])


@dataclass
class Cell:
    """Documents of a cell, their vectors, the blocks of each term's list and their summaries."""

    unit: int
    id: np.ndarray
    no_id: np.ndarray
    row: np.ndarray
    n: np.ndarray
    begin: np.ndarray
    term: np.ndarray
    count: np.ndarray
    own: np.ndarray
    lists: np.ndarray
    blocks: np.ndarray
    members: np.ndarray
    summary: np.ndarray

    @classmethod
    def build(cls, ids: list, rows: list, terms: list, counts: list, n: np.ndarray, by: Weights, partners: list) -> Cell:
        begin, term, count, impact = sparse(terms, counts, n, by)
        place = projected(begin, term, impact, len(by.weight))
        own, term = np.unique(term, return_inverse=True)
        document = np.repeat(np.arange(len(ids)), np.diff(begin))
        order = np.argsort(term, kind="stable")
        ends = np.searchsorted(term[order], np.arange(len(own) + 1))
        unit = -(-int(impact.max(initial=1)) // LEVELS)
        vectors = np.zeros((len(ids), len(own) + 1), np.uint8)  # the last column is of terms that the cell lacks
        vectors[document, term] = -(-impact // unit)
        column = np.full(len(by.weight), len(own), np.int64)
        column[own] = np.arange(len(own))
        members, sizes, lists, summary = document[order], [], [0], [np.zeros(0, np.uint8)]
        for t, a, b in zip(own.tolist(), ends[:-1].tolist(), ends[1:].tolist(), strict=True):
            mine = [b - a]
            if b - a > BLOCK:
                cluster, mine = clustered(place[members[a:b]])
                members[a:b] = members[a:b][cluster]
            sizes += mine
            lists.append(len(sizes))
            summary.append(maxima(vectors, members[a:b], mine, column[partners[t]]))
        number = np.array([i or 0 for i in ids], np.int64)
        return cls(
            unit, number, np.array([i is None for i in ids], bool), np.array(rows, np.int64), n, begin, term, count, own,
            np.array(lists), np.cumsum([0, *sizes]), members, np.concatenate(summary),
        )

    def to_row(self) -> list:
        return [self.unit, *[getattr(self, name).astype(kind).tobytes() for name, kind in ARRAYS]]

    @classmethod
    def from_row(cls, unit: int, *raw: bytes | pa.Buffer) -> Cell:
        arrays = [np.frombuffer(x, kind) for x, (_, kind) in zip(raw, ARRAYS, strict=True)]
        return cls(unit, *[x.astype(np.int64) if kind == "<i4" else x for x, (_, kind) in zip(arrays, ARRAYS, strict=True)])

    def scores(self, documents: np.ndarray, asked: np.ndarray, impact: np.ndarray) -> np.ndarray:
        """Exact scores; ``asked`` marks the terms of ``own`` that the item has."""
        at, size = expanded(self.begin, documents)
        sums = np.append(0, np.cumsum(impact[at] * asked[self.term[at]]))
        ends = np.cumsum(size)
        return sums[ends] - sums[ends - size]

    def in_blocks(self, blocks: np.ndarray) -> np.ndarray:
        return np.unique(self.members[expanded(self.blocks, blocks)[0]])

    def best(self, documents: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
        """Places of the ``k`` highest scores, equal ones by id."""
        return np.lexsort((self.row[documents], self.id[documents], self.no_id[documents], -scores))[:k]


def clustered(place: np.ndarray) -> tuple[np.ndarray, list[int]]:
    """An order of documents by their most similar centre, and the sizes of the blocks."""
    n = len(place)
    centres = place[np.linspace(0, n - 1, -(-n // BLOCK)).astype(int)]
    near = place @ centres.T
    centre = near.argmax(1)
    order = np.lexsort((-near[np.arange(n), centre], centre))
    sizes = []
    for size in np.bincount(centre).tolist():
        sizes += [BLOCK] * (size // BLOCK) + [size % BLOCK] * (size % BLOCK > 0)
    return order, sizes


def maxima(vectors: np.ndarray, members: np.ndarray, sizes: list[int], columns: np.ndarray) -> np.ndarray:
    """Coordinatewise maxima of blocks of documents, a few blocks at once."""
    ends = np.cumsum(sizes)
    found, at = [], 0
    while at < len(sizes):
        low = int(ends[at]) - sizes[at]
        to = max(at + 1, int(np.searchsorted(ends, low + ENTRIES_AT_ONCE // max(len(columns), 1), side="right")))
        some = vectors[members[low : ends[to - 1]]][:, columns]
        found.append(np.maximum.reduceat(some, np.append(0, ends[at : to - 1] - low)))
        at = to
    return np.concatenate(found).ravel()


def build_index(rows: DataFrame, by: Weights, partners: list[np.ndarray]) -> DataFrame:
    """One row per cell: see ``ARRAYS``. ``rows`` are the vectors of all documents."""
    spark, size = rows.sparkSession, len(by.weight)
    some = rows.filter(F.octet_length("terms") > 0)
    held = F.sum(F.octet_length("terms") / 4).cast("long").alias("postings")
    number = min(PIVOTS, -(-(some.agg(held).first()[0] or 0) // CELL_POSTINGS)) or 1
    chosen = some.orderBy(F.xxhash64("row")).limit(number).collect()  # a bounded sample, the same at every run
    lists = [[bytes(r[c]) for r in chosen] for c in ("terms", "counts")]
    begin, term, _, impact = sparse(*lists, np.array([r.n for r in chosen], np.int64), by)
    pivots = projected(begin, term, impact, size)
    shared = spark.sparkContext.broadcast((by.weight, by.documents, by.terms, pivots, partners))

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        *known, centres, _ = shared.value
        for batch in batches:
            lists = [[x.as_buffer().to_pybytes() for x in batch.column(i)] for i in (2, 3)]
            begin, term, _, impact = sparse(*lists, batch.column(1).to_numpy(zero_copy_only=False), Weights(*known))
            near = projected(begin, term, impact, size) @ centres.T
            cell = near.argmax(1) if len(centres) else np.zeros(batch.num_rows)
            names = ["doc_id", "n", "terms", "counts", "row", "cell"]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell.astype(np.int32))], names=names)

    kinds = "doc_id long, n long, terms binary, counts binary, row long, cell int"
    dealt = stage(some.mapInArrow(assign, kinds), "cells")
    sizes = dealt.groupBy("cell").agg(held, F.count(F.lit(1)).alias("documents"))
    parts = F.ceil(F.greatest(F.col("postings") / CELL_POSTINGS, F.col("documents") / CELL_DOCUMENTS)).cast("int")
    parts = F.broadcast(sizes.select("cell", parts.alias("parts")))  # a row for each pivot at most
    key = ["cell", "part"]

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        *known, _, partners = shared.value
        held: list[list] = []
        before = None

        def made() -> pa.RecordBatch:
            ids, n, terms, counts, rows = [list(x) for x in zip(*held, strict=True)]
            row = Cell.build(ids, rows, terms, counts, np.array(n, np.int64), Weights(*known), partners).to_row()
            kinds = [pa.int64(), *[pa.binary()] * len(ARRAYS)]
            arrays = [pa.array([x], k) for x, k in zip(row, kinds, strict=True)]
            return pa.RecordBatch.from_arrays(arrays, names=["unit", *[name for name, _ in ARRAYS]])

        for batch in batches:
            for *values, cell, part in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if (cell, part) != before and held:
                    yield made()
                    held = []
                before = cell, part
                held.append(values)
        if held:
            yield made()

    dealt = dealt.join(parts, "cell").withColumn("part", F.pmod(F.xxhash64("row"), "parts").cast("int"))
    grouped = dealt.repartition(*key).sortWithinPartitions(*key, "row")
    return stage(grouped.select("doc_id", "n", "terms", "counts", "row", *key).mapInArrow(build, CELL), "search-index")


def cells_of(batches: Iterator[pa.RecordBatch]) -> Iterator[Cell]:
    """The cells of an index one after another, without a copy of more than one of them."""
    for batch in batches:
        for i in range(batch.num_rows):
            unit, *raw = [c[i] for c in batch.columns]
            yield Cell.from_row(unit.as_py(), *[x.as_buffer() for x in raw])


def searched(
    cell: Cell, asked: Asked, by: Weights, least: np.ndarray, k: int, probe: bool
) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(item, documents, scores) of the best documents of a cell for each item, none below ``least``.

    With ``probe`` only the block with the best bound is scored.
    """
    own, document = cell.own, np.repeat(np.arange(len(cell.n)), np.diff(cell.begin))
    impact = by.impacts(own[cell.term], cell.count, cell.n[document])
    most = np.zeros(len(own), np.int64)
    np.maximum.at(most, cell.term, impact)
    width = np.array([len(asked.partners[t]) for t in own.tolist()], np.int64)
    ends = np.cumsum(np.diff(cell.lists) * width)
    for item, terms in enumerate(asked.items):
        at = np.searchsorted(own, terms)
        mine = at[(at < len(own)) & (own[np.minimum(at, len(own) - 1)] == terms)]
        by_reach = mine[np.argsort(most[mine], kind="stable")]
        reach = np.cumsum(most[by_reach])
        if not len(mine) or reach[-1] < least[item]:
            continue
        blocks, bounds = [], []
        for t in by_reach[reach >= least[item]].tolist():
            partners = asked.partners[own[t]]
            summary = cell.summary[ends[t] - (cell.lists[t + 1] - cell.lists[t]) * width[t] : ends[t]]
            columns = np.searchsorted(partners, terms)
            bounds.append(summary.reshape(-1, width[t])[:, columns].sum(1, dtype=np.int64) * cell.unit)
            blocks.append(np.arange(cell.lists[t], cell.lists[t + 1]))
        block, bound = np.concatenate(blocks), np.concatenate(bounds)
        some = block[[bound.argmax()]] if probe else block[bound >= least[item]]
        if not len(some):
            continue
        documents = cell.in_blocks(some)
        is_asked = np.zeros(len(own), np.int64)
        is_asked[mine] = 1
        scores = cell.scores(documents, is_asked, impact)
        documents, scores = documents[scores >= least[item]], scores[scores >= least[item]]
        if len(documents):
            best = cell.best(documents, scores, k)
            yield item, documents[best], scores[best]


def search(index: DataFrame, asked: Asked, by: Weights, k: int = TOP) -> DataFrame:
    """(item, doc_id, row, score): the documents that can be among the ``k`` best of each item, the ``k`` best among them.

    Items are numbered by their place in ``asked``, with which the index was built.
    """
    spark, number = index.sparkSession, len(asked.items)
    shared = spark.sparkContext.broadcast((asked.items, asked.partners, by.weight, by.documents, by.terms))

    def known() -> tuple[Asked, Weights]:
        items, partners, *rest = shared.value
        return Asked(items, partners), Weights(*rest)

    def first_pass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked, by = known()
        least, best = np.ones(number, np.int64), [np.zeros(0, np.int64)] * number
        for cell in cells_of(batches):
            for item, _, scores in searched(cell, asked, by, least, k, True):
                best[item] = np.sort(np.concatenate((best[item], scores)))[::-1][:k]
                if len(best[item]) == k:
                    least[item] = best[item][-1]
        items = np.repeat(np.arange(number), [len(x) for x in best])
        scores = np.concatenate([np.zeros(0, np.int64), *best])
        yield pa.RecordBatch.from_arrays([pa.array(items), pa.array(scores)], names=["item", "score"])

    seen = index.mapInArrow(first_pass, "item long, score long")
    ahead = Window.partitionBy("item").orderBy(F.col("score").desc())
    seen = seen.withColumn("rank", F.row_number().over(ahead)).filter(F.col("rank") <= k)
    reached = seen.filter(F.col("rank") == k).select("item", "score").collect()  # one row for each item of the shard
    least = np.ones(number, np.int64)
    for r in reached:
        least[r.item] = max(1, r.score)
    limits = spark.sparkContext.broadcast(least)

    def second_pass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked, by = known()
        names = ["item", "doc_id", "row", "score"]
        for cell in cells_of(batches):
            for item, documents, scores in searched(cell, asked, by, limits.value, k, False):
                ids = pa.array(cell.id[documents], mask=cell.no_id[documents].astype(bool))
                columns = [pa.array(np.full(len(documents), item)), ids, pa.array(cell.row[documents]), pa.array(scores)]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return index.mapInArrow(second_pass, "item long, doc_id long, row long, score long")


def rank(
    docs: DataFrame, items: DataFrame, id_col="doc_id", text_col="text", item_col="item_id", item_text="text", k=TOP
) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` best documents of each item with a score above 0."""
    spark = docs.sparkSession
    asked = item_terms(items, item_col, item_text)
    total = asked.agg(F.sum(F.size("terms"))).first()[0] or 0
    shards = max(1, -(-total // SHARD_TERMS))
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), "row"]
    kind = asked.schema["item_id"].dataType.simpleString()
    found = spark.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long")
    for shard in range(shards):
        mine = asked.filter((F.pmod(F.xxhash64("item"), F.lit(shards)) == shard) & (F.size("terms") > 0))
        rows = mine.select("item", "terms").orderBy("item").collect()  # a shard's terms, bounded
        vocabulary = sorted({bytes(t) for r in rows for t in r.terms})
        if not vocabulary:
            continue
        number = {t: i for i, t in enumerate(vocabulary)}
        counted = vectors(docs, id_col, text_col, vocabulary)
        asked_ = Asked.of([[number[bytes(t)] for t in r.terms] for r in rows], len(vocabulary))
        by = weights(counted, len(vocabulary))
        hits = search(build_index(counted, by, asked_.partners), asked_, by, k)
        ahead = Window.partitionBy("item").orderBy(*order)
        best = hits.withColumn("rank", F.row_number().over(ahead)).filter(F.col("rank") <= k)
        places = spark.createDataFrame([(i, r.item) for i, r in enumerate(rows)], "item long, of long")
        named = mine.select(F.col("item").alias("of"), "item_id").join(F.broadcast(places), "of")
        best = best.join(F.broadcast(named), "item").select("item_id", "rank", "doc_id", "score")
        found = found.union(stage(best, "ranked") if shards > 1 else best)
    return found
