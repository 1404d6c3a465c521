"""Nearest vectors by cosine: an inverted-file index for search, and a graph of neighbours for recommendation.

Similarities are computed in double precision from unit vectors and rounded to ``DECIMALS`` places, so copies tie; ties go
to the smaller id. Vectors that are null, empty, zero or hold a null or non-finite component are no neighbours and have
none. Vectors of one call have one length; another length raises.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillset.session import stage

#: Rows that centres and the number of probes are fitted on, about; the index holds every row.
SAMPLE_ROWS = 20_000
MOST_CELLS, FIT_ROUNDS = 4096, 12
#: Rows and queries of a block; a block of each meet in a task, whatever the size of a cell.
BLOCK_ROWS, BLOCK_QUERIES = 4096, 1024
#: Similarities of rows and centres that a task holds at once, and copies of rows that it sends on at once.
PLACE_CELLS, PLACE_ROWS = 1 << 19, 4096
#: Lists of one query that are merged at once.
FAN = 64
#: The share of the true neighbours of sampled rows that the probed cells must hold.
LEAST_RECALL = 0.97
DECIMALS = 9

BEST = "array<struct<far: double, id: bigint>>"
PLACED = "row long, id long, vector array<double>"


def unit_vectors(rows: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(row, id, vector): the usable vectors at length 1; ``row`` tells rows with one id apart."""
    raw = F.transform(F.col(vector_col), lambda x: x.cast("double"))
    usable = F.forall("vector", lambda x: x.isNotNull() & (F.abs(x) < float("inf")))
    found = rows.select(F.col(id_col).cast("long").alias("id"), raw.alias("vector"))
    found = found.filter(F.coalesce((F.size("vector") > 0) & usable, F.lit(False)))
    found = found.withColumn("most", F.array_max(F.transform("vector", F.abs))).filter("most > 0")
    found = found.withColumn("vector", F.transform("vector", lambda x: x / F.col("most")))
    norm = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda a, x: a + x * x))
    found = found.withColumn("norm", norm)
    unit = F.transform("vector", lambda x: x / F.col("norm")).alias("vector")
    return stage(found.select(F.monotonically_increasing_id().alias("row"), "id", unit), "unit-vectors")


def matrix(lists: pa.Array, width: int | None = None) -> np.ndarray:
    """The vectors of a column as rows of a matrix."""
    sizes = np.diff(lists.offsets.to_numpy())
    width = width or (int(sizes[0]) if len(sizes) else 0)
    if (sizes != width).any():
        raise ValueError(f"vectors of {sorted(set(sizes.tolist()) | {width})} components cannot be compared")
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(-1, max(width, 1))


@dataclass
class Index:
    """Vectors by cell (row, id, vector, cell), centres of the cells, cells to be probed by default."""

    rows: DataFrame
    centres: np.ndarray
    probes: int


def build_index(rows: DataFrame, id_col: str, vector_col: str, k: int = 10, cells: int | None = None) -> Index:
    """Fit cells by k-means on a sample and put every row into the nearest; about the root of the rows as cells."""
    vectors = unit_vectors(rows, id_col, vector_col)
    total = vectors.count()
    draw = F.xxhash64("id", "vector") / F.lit(2.0**64) + 0.5
    drawn = vectors.filter(draw < SAMPLE_ROWS / max(total, 1)).select("vector").distinct().toArrow()
    sample = matrix(drawn.column(0).combine_chunks()) if drawn.num_rows else np.zeros((0, 0))
    cells = min(cells or math.isqrt(total), MOST_CELLS, len(sample)) or 1
    centres = fit_centres(sample[np.lexsort(sample.T)] if len(sample) else sample, cells)
    probes = probes_for(sample, centres, k) if len(sample) else 1
    return Index(stage(in_nearest_cells(vectors, centres, 1), "cells"), centres, probes)


def fit_centres(sample: np.ndarray, cells: int) -> np.ndarray:
    """Spherical k-means; a centre that loses all its rows stays where it is."""
    if not len(sample):
        return np.zeros((1, 0))
    centres = sample[np.random.default_rng(5).permutation(len(sample))[:cells]]
    for _ in range(FIT_ROUNDS):
        near = (sample @ centres.T).argmax(1)
        sums = np.zeros_like(centres)
        np.add.at(sums, near, sample)
        length = np.linalg.norm(sums, axis=1, keepdims=True)
        centres = np.where(length > 0, sums / np.maximum(length, 1e-300), centres)
    return centres


def probes_for(sample: np.ndarray, centres: np.ndarray, k: int) -> int:
    """The fewest nearest cells of a query that hold ``LEAST_RECALL`` of its neighbours, over up to 1,000 sampled rows."""
    cell = (sample @ centres.T).argmax(1)
    asked = sample[np.linspace(0, len(sample) - 1, min(1000, len(sample))).astype(int)]
    near = asked @ sample.T
    most = np.argpartition(-near, min(k, len(sample) - 1), axis=1)[:, : k + 1]
    place = np.argsort(np.argsort(-(asked @ centres.T), axis=1), axis=1)
    needed = np.sort(np.take_along_axis(place, cell[most], axis=1).ravel())
    return int(needed[min(len(needed) - 1, int(LEAST_RECALL * len(needed)))]) + 1


def nearest_cells(near: np.ndarray, cells: int) -> np.ndarray:
    """The places of the greatest of each row, in descending order, equal ones by place."""
    if cells == 1:
        return near.argmax(1).astype(np.int32)[:, None]
    return np.argsort(-near, axis=1, kind="stable")[:, :cells].astype(np.int32)


def placed(batches: Iterator[pa.RecordBatch], centres: np.ndarray, cells: int) -> Iterator[pa.RecordBatch]:
    """Rows (row, id, vector) with each of their nearest cells; few rows at once are compared with the centres."""
    names, width = ["row", "id", "vector", "cell"], centres.shape[1]
    step = max(1, min(1024, PLACE_CELLS // len(centres)))
    some = max(1, PLACE_ROWS // step)
    for whole in batches:
        for start in range(0, whole.num_rows, step):
            batch = whole.slice(start, step)
            found = nearest_cells(matrix(batch.column(2), width) @ centres.T, cells)
            for first in range(0, cells, some):
                part = found[:, first : first + some]
                rows = pa.array(np.repeat(np.arange(batch.num_rows), part.shape[1]))
                yield pa.RecordBatch.from_arrays([*[c.take(rows) for c in batch.columns], pa.array(part.ravel())], names=names)


def in_nearest_cells(vectors: DataFrame, centres: np.ndarray, cells: int) -> DataFrame:
    """Each row once for each of its nearest cells: (row, id, vector, cell)."""
    shared, cells = vectors.sparkSession.sparkContext.broadcast(centres), min(cells, len(centres))
    return vectors.mapInArrow(lambda batches: placed(batches, shared.value, cells), PLACED + ", cell int")


def best_of(near: np.ndarray, ids: np.ndarray, k: int) -> list[dict]:
    """The ``k`` best of one row of similarities, equal ones by id."""
    if len(near) > k:
        some = np.flatnonzero(near >= np.partition(near, len(near) - k)[len(near) - k])
    else:
        some = np.arange(len(near))
    some = some[np.lexsort((ids[some], -near[some]))[:k]]
    return [{"far": -s, "id": i} for s, i in zip(near[some].tolist(), ids[some].tolist(), strict=True)]


def merged(k: int) -> Column:
    """The ``k`` best of some lists."""
    return F.slice(F.sort_array(F.flatten(F.collect_list("best"))), 1, k).alias("best")


def search(
    index: Index, queries: DataFrame, id_col: str, vector_col: str, k: int = 10, probes: int | None = None
) -> DataFrame:
    """(query_id, rank, id, similarity): the ``k`` nearest rows of each query in its ``probes`` nearest cells.

    With as many probes as cells the result is exact. A query row is a query of its own. Rows and queries of a cell are
    dealt to blocks of bounded size; each pair of blocks meets once, in a product of two matrices that keeps ``k`` rows a
    query, and the lists are merged ``FAN`` at a time. Rows without id are left out.
    """
    width = index.centres.shape[1]
    asked = unit_vectors(queries, id_col, vector_col).filter(F.lit(width > 0))
    probed = stage(in_nearest_cells(asked, index.centres, probes or index.probes), "probes")
    stored = index.rows.filter("id is not null")
    rows, wanted = [x.groupBy("cell").agg(F.count(F.lit(1)).alias(n)) for x, n in ((stored, "rows"), (probed, "asked"))]
    blocks = rows.join(wanted, "cell").select(
        "cell",
        F.ceil(F.col("rows") / BLOCK_ROWS).cast("int").alias("row_blocks"),
        F.ceil(F.col("asked") / BLOCK_QUERIES).cast("int").alias("query_blocks"),
    )
    blocks = stage(blocks, "blocks")  # one row for each cell
    own, others = F.pmod(F.xxhash64("row"), "row_blocks"), F.sequence(F.lit(0), F.col("query_blocks") - 1)
    left = stored.join(F.broadcast(blocks), "cell").withColumns({"block": own.cast("int"), "part": F.explode(others)})
    own, others = F.pmod(F.xxhash64("row"), "query_blocks"), F.sequence(F.lit(0), F.col("row_blocks") - 1)
    right = probed.join(F.broadcast(blocks), "cell").withColumns({"part": own.cast("int"), "block": F.explode(others)})
    key = ["cell", "block", "part"]
    both = left.select(*key, F.lit(False).alias("asks"), "row", "id", "vector").union(
        right.select(*key, F.lit(True).alias("asks"), "row", "id", "vector")
    )
    dealt = both.repartition(*key).sortWithinPartitions(*key, "asks")
    near = dealt.mapInArrow(lambda batches: met(batches, k, width), f"row long, id long, cell int, block int, best {BEST}")
    most = blocks.agg(F.max("row_blocks")).first()[0] or 1
    while most > FAN:
        near = near.groupBy("row", "id", "cell", F.floor(F.col("block") / FAN).cast("int").alias("block")).agg(merged(k))
        most = -(-most // FAN)
    lists = near.groupBy("row").agg(F.first("id").alias("query_id"), merged(k))
    found = lists.select("query_id", F.posexplode("best").alias("place", "hit"))
    return found.select(
        "query_id", (F.col("place") + 1).alias("rank"), F.col("hit.id").alias("id"), (-F.col("hit.far")).alias("similarity")
    )


def met(batches: Iterator[pa.RecordBatch], k: int, width: int) -> Iterator[pa.RecordBatch]:
    """Each block's rows come first and stay; its queries are compared with them as they come."""
    names = ["row", "id", "cell", "block", "best"]
    key, ids, rows = None, [], []
    for batch in batches:
        columns = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(4)]
        asks = columns[3].astype(bool)
        new = np.zeros(batch.num_rows, bool)
        new[1:] = asks[1:] != asks[:-1]
        for c in columns[:3]:
            new[1:] |= c[1:] != c[:-1]
        edges = [*np.flatnonzero(new).tolist(), batch.num_rows]
        at = 0
        for end in edges:
            if end == at:
                continue
            now = tuple(int(c[at]) for c in columns[:3])
            part = batch.slice(at, end - at)
            vectors = matrix(part.column(6), width)
            if now != key:
                key, ids, rows = now, [], []
            if not asks[at]:
                ids.append(part.column(5).to_numpy(zero_copy_only=False))
                rows.append(vectors)
            elif rows:
                ids, rows = [np.concatenate(ids)], [np.concatenate(rows)]
                near = np.round(vectors @ rows[0].T, DECIMALS)
                kind = pa.list_(pa.struct([("far", pa.float64()), ("id", pa.int64())]))
                best = pa.array([best_of(x, ids[0], k) for x in near], kind)
                where = [pa.array(np.full(len(near), x, np.int32)) for x in key[:2]]
                yield pa.RecordBatch.from_arrays([part.column(4), part.column(5), *where, best], names=names)
            at = end


#: Neighbours that the graph keeps of a row for each one that is asked for, and the rows naming it that meet them.
GRAPH_FACTOR, MEETING = 3, 24
GRAPH_ROUNDS, LEAST_CHANGE = 10, 0.002
#: Rows of a block in which rows meet before the first round, and in how many cells each row does. Cells that share rows
#: keep the graph from falling apart.
START_ROWS, START_CELLS = 1024, 32
#: Of a row's neighbours in one such block, so many for each one that is asked for are sent on.
START_FACTOR = 1
#: Rounding two unit vectors to 16 bits changes their product by less than a quarter of this, sums of products included.
HALF_MARGIN = 2.0**-8
#: Lists that are sent on at once.
SENT_LISTS = 4096

LISTS = "id long, near array<long>, far array<float>"


def neighbour_graph(rows: DataFrame, id_col: str, vector_col: str, k: int = 10) -> DataFrame:
    """(id, rank, neighbour_id, similarity): the ``k`` nearest other rows of each row, by local joins of neighbours.

    First the rows of a cell meet in blocks, each row in its ``START_CELLS`` nearest cells. In each round every row
    brings its neighbours together, those it names and those that name it, as far as one of a pair is new to it: a row's
    neighbours are likely to be neighbours. Of those that name a row, at most ``MEETING`` new and as many known ones
    come, the nearest first, so a round emits a bounded number of pairs for each row and a hub does not grow; only pairs
    that beat the worst neighbour kept so far are emitted, and nobody comes to a row without a new one. It ends when a
    round changes less than ``LEAST_CHANGE`` of the lists, or after ``GRAPH_ROUNDS``.

    Rows meet as numbers of 16 bits, and lists of neighbours are dealt out whole, by id. Of the ``GRAPH_FACTOR`` times
    ``k`` neighbours that are left of each row, all that can be among the ``k`` nearest (``HALF_MARGIN``) are compared
    once more in double precision, which gives order and similarity.
    The result is approximate; the tests measure its recall. The rows' ids must be unique; rows without id are left out.
    """
    index = build_index(rows.filter(F.col(id_col).isNotNull()), id_col, vector_col, k)
    vectors, kept = index.rows.select("id", "vector"), GRAPH_FACTOR * k
    width = index.centres.shape[1]
    total = max(vectors.count(), 1)
    centres = rows.sparkSession.sparkContext.broadcast(index.centres)
    halves = vectors.mapInArrow(lambda batches: halved(batches, centres.value), "id long, half binary, cells array<int>")
    halves = stage(halves, "halves")
    start = halves.select("id", "half", F.explode("cells").alias("cell"))
    sizes = start.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / START_ROWS).cast("int").alias("blocks"))
    block = F.pmod(F.xxhash64("id", "cell"), "blocks").cast("int")  # halves that differ from cell to cell
    dealt = start.join(F.broadcast(sizes), "cell").withColumn("block", block)
    dealt = dealt.repartition("cell", "block").sortWithinPartitions("cell", "block", "id")
    first = dealt.select("cell", "block", "id", "half").mapInArrow(
        lambda batches: local_join(batches, START_FACTOR * k, width), LISTS
    )
    graph = nearest(first.withColumn("fresh", F.lit(True)), kept)
    for _ in range(GRAPH_ROUNDS):
        graph = stage(graph, "neighbours")
        fresh = graph.agg(F.sum(F.size(F.filter("fresh", lambda x: x)))).first()[0] or 0
        if fresh < LEAST_CHANGE * kept * total:
            break
        known = graph.select("id", "near", "far", F.lit(False).alias("fresh"))
        graph = nearest(known.union(candidates(graph, halves, kept, width)), kept)
    return compared(stage(graph, "neighbours"), vectors, k, width)


def halved(batches: Iterator[pa.RecordBatch], centres: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Unit vectors as numbers of 16 bits, with their nearest cells."""
    step, names = max(1, min(1024, PLACE_CELLS // len(centres))), ["id", "half", "cells"]
    for whole in batches:
        for start in range(0, whole.num_rows, step):
            batch = whole.slice(start, step)
            vectors = matrix(batch.column(1), centres.shape[1])
            cells = nearest_cells(vectors @ centres.T, min(START_CELLS, len(centres)))
            half = pa.array([x.tobytes() for x in vectors.astype("<f2")], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), half, pa.array(list(cells), pa.list_(pa.int32()))], names=names)


def unhalved(halves: pa.Array, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(halves.to_pylist()), "<f2").reshape(-1, width).astype(np.float32)


def nearest(lists: DataFrame, k: int) -> DataFrame:
    """(id, near, far, fresh): the ``k`` nearest of each row, each once; a neighbour that was known before is not fresh.

    The lists of a row are shuffled once, and grouping and ranking take place where they arrive.
    """
    pairs = lists.repartition("id").select("id", "fresh", F.inline(F.arrays_zip("near", "far")))
    once = pairs.groupBy("id", "near").agg(F.min("far").alias("far"), F.min("fresh").alias("fresh"))
    ahead = Window.partitionBy("id").orderBy("far", "near")
    best = once.withColumn("rank", F.row_number().over(ahead)).filter(F.col("rank") <= k)
    best = best.groupBy("id").agg(F.sort_array(F.collect_list(F.struct("far", "near", "fresh"))).alias("best"))
    return best.select("id", *[F.col(f"best.{c}").alias(c) for c in ("near", "far", "fresh")])


def candidates(graph: DataFrame, halves: DataFrame, kept: int, width: int) -> DataFrame:
    """(id, near, far, fresh): what rows find that meet at a common neighbour, as far as it beats their worst."""
    edges = graph.select("id", F.inline(F.arrays_zip("near", "far", "fresh")))
    named = edges.select(F.col("id").alias("at"), F.col("near").alias("id"), "fresh")
    ahead = Window.partitionBy("at", "fresh").orderBy("far", F.xxhash64("id"))
    naming = edges.select(F.col("near").alias("at"), "id", "far", "fresh")
    naming = naming.withColumn("rank", F.row_number().over(ahead)).filter(F.col("rank") <= MEETING)
    both = named.union(naming.select("at", "id", "fresh")).repartition("at")
    both = both.groupBy("at", "id").agg(F.max("fresh").alias("fresh"))
    both = both.withColumn("busy", F.max("fresh").over(Window.partitionBy("at"))).filter("busy").drop("busy")
    worst = graph.select("id", F.when(F.size("near") >= kept, F.array_max("far")).alias("worst"))
    members = both.join(halves.select("id", "half").join(worst, "id", "left"), "id")
    dealt = members.repartition("at").sortWithinPartitions("at", "id").select("at", "id", "fresh", "worst", "half")
    return dealt.mapInArrow(lambda batches: meetings(batches, width), LISTS).withColumn("fresh", F.lit(True))


def compared(graph: DataFrame, vectors: DataFrame, k: int, width: int) -> DataFrame:
    """(id, rank, neighbour_id, similarity): the ``k`` best neighbours of each row, compared in double precision."""
    least = F.coalesce(F.get("far", F.lit(k - 1)), F.lit(float("inf"))) + HALF_MARGIN
    some = F.slice("near", F.lit(1), F.size(F.filter("far", lambda x: x <= least)))  # the nearest come first
    edges = graph.select(F.col("id").alias("at"), F.lit(False).alias("own"), F.explode(some).alias("id"))
    both = edges.union(graph.select("id", F.lit(True), "id")).join(vectors, "id")
    dealt = both.repartition("at").sortWithinPartitions("at").select("at", "own", "id", "vector")
    return dealt.mapInArrow(
        lambda batches: best_neighbours(batches, k, width), "id long, rank int, neighbour_id long, similarity double"
    )


def groups(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[pa.RecordBatch]:
    """The rows of each key, which are sorted and few."""
    held: list[pa.RecordBatch] = []
    before = None
    for batch in batches:
        columns = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(keys)]
        new = np.zeros(batch.num_rows, bool)
        for c in columns:
            new[1:] |= c[1:] != c[:-1]
        at = 0
        for end in [*np.flatnonzero(new).tolist(), batch.num_rows]:
            if end == at:
                continue
            now = tuple(c[at] for c in columns)
            if before is not None and now != before:
                yield pa.concat_batches(held)
                held = []
            held.append(batch.slice(at, end - at))
            before, at = now, end
    if held:
        yield pa.concat_batches(held)


def as_lists(parts: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    """Some (ids, sizes of their lists, neighbours one after the other, how far) as rows."""
    ids, sizes, near, far = [np.concatenate(x) for x in zip(*parts)]
    ends = pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32))
    lists = [pa.ListArray.from_arrays(ends, pa.array(x)) for x in (near, far)]
    return pa.RecordBatch.from_arrays([pa.array(ids), *lists], names=["id", "near", "far"])


def gathered(parts: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
    """About ``SENT_LISTS`` lists in a batch."""
    held, rows = [], 0
    for part in parts:
        held.append(part)
        rows += len(part[0])
        if rows >= SENT_LISTS:
            yield as_lists(held)
            held, rows = [], 0
    if held:
        yield as_lists(held)


def local_join(batches: Iterator[pa.RecordBatch], k: int, width: int) -> Iterator[pa.RecordBatch]:
    """The ``k`` nearest others of each row of a block."""

    def parts():
        for block in groups(batches, 2):
            ids, vectors = block.column(2).to_numpy(zero_copy_only=False), unhalved(block.column(3), width)
            far = -(vectors @ vectors.T)
            np.fill_diagonal(far, np.inf)
            size = min(k, len(ids) - 1)
            if size:
                most = np.argpartition(far, size - 1, axis=1)[:, :size]
                yield ids, np.full(len(ids), size), ids[most].ravel(), np.take_along_axis(far, most, axis=1).ravel()

    return gathered(parts())


def meetings(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    """The pairs of rows that meet, one of them fresh, as far as they beat the worst neighbour of the first."""

    def parts():
        for block in groups(batches, 1):
            ids, fresh = [block.column(i).to_numpy(zero_copy_only=False) for i in (1, 2)]
            worst = block.column(3).to_numpy(zero_copy_only=False).astype(np.float32)
            vectors = unhalved(block.column(4), width)
            far = -(vectors @ vectors.T)
            fresh = fresh.astype(bool)
            some = (far < np.where(np.isnan(worst), np.float32(np.inf), worst)[:, None]) & (fresh[:, None] | fresh[None])
            np.fill_diagonal(some, False)
            sizes = some.sum(axis=1)
            if sizes.any():
                a, b = np.nonzero(some)
                yield ids[sizes > 0], sizes[sizes > 0], ids[b], far[a, b]

    return gathered(parts())


def best_neighbours(batches: Iterator[pa.RecordBatch], k: int, width: int) -> Iterator[pa.RecordBatch]:
    """The best of each row's neighbours. Rows that share an id are one, and its own neighbour."""
    names, held = ["id", "rank", "neighbour_id", "similarity"], []
    for block in groups(batches, 1):
        at, vectors = block.column(0)[0].as_py(), matrix(block.column(3), width)
        own, ids = [block.column(i).to_numpy(zero_copy_only=False) for i in (1, 2)]
        own = own.astype(bool)
        others = ~own & (ids != at)
        near, found = np.round(vectors[others] @ vectors[own].T, DECIMALS).max(axis=1), ids[others]
        if (~own & (ids == at)).any():
            itself = np.round(vectors[own] @ vectors[own].T, DECIMALS)
            np.fill_diagonal(itself, -np.inf)
            near, found = np.append(near, itself.max()), np.append(found, at)
        best = np.lexsort((found, -near))
        best = best[np.sort(np.unique(found[best], return_index=True)[1])][:k]
        held.append((np.full(len(best), at), np.arange(1, len(best) + 1, dtype=np.int32), found[best], near[best]))
        if len(held) >= SENT_LISTS:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*held)], names=names)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*held)], names=names)
