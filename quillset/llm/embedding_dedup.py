"""Embedding near-dedup by cross-polytope hashing.

A rotation is three rounds of random signs and a fast Hadamard transform; the hash is the axis (with its sign) that is
nearest to the rotated vector. A bucket is a pair of such hashes, so there are ``(2 * dims) ** 2`` of them a table.
With multiprobe a vector also asks in the buckets that come next by its two largest coordinates of each rotation: it is
filed under its own bucket and asks in the others. Pairs that meet are verified by cosine in double precision.

Each row carries its buckets of all tables, so a pair that meets in several is counted in the first of them only, where
it meets; links are counted in place, and only counts and the stars of what hangs together leave a block. Large buckets
are dealt out to blocks of pairs. Equal vectors are one class with a size, so copies cost one row and no link is lost.

Vectors that are null, empty, zero or hold null or non-finite components link with nothing, nor do vectors whose
length differs. A null or repeated id is allowed: ids are only compared for the smallest, and equal ids count each.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillset.llm.common import (
    add_columns,
    connected_components,
    group_numbers,
    labels_of_links,
    pair_blocks,
    whole_groups,
)
from quillset.session import stage

SIMILARITY = 0.9
TABLES = 10
#: Other buckets of a table in which a vector asks: its best axes of the two rotations are combined.
PROBES = 5
BLOCK_ROWS = 256
SEED = 11


def hadamard(x: np.ndarray) -> np.ndarray:
    """The fast Walsh-Hadamard transform of the rows."""
    n, size = x.shape
    width = 1
    while width < size:
        parts = x.reshape(n, -1, 2, width)
        x = np.concatenate((parts[:, :, 0] + parts[:, :, 1], parts[:, :, 0] - parts[:, :, 1]), axis=2).reshape(n, size)
        width *= 2
    return x


class CrossPolytope:
    """Buckets of vectors of one length. ``buckets[:, t, 0]`` is a vector's own of table t, the others are asked in."""

    def __init__(self, dims: int, tables: int = TABLES, probes: int = PROBES, seed: int = SEED):
        self.size = 1 << max(1, (dims - 1).bit_length())
        self.signs = np.random.default_rng([seed, dims]).choice([-1.0, 1.0], (tables, 2, 3, self.size))
        self.probes = probes

    def buckets(self, x: np.ndarray) -> np.ndarray:
        padded = np.zeros((len(x), self.size))
        padded[:, : x.shape[1]] = x
        return np.stack([self.of_table(padded, signs) for signs in self.signs], axis=1)

    def of_table(self, x: np.ndarray, signs: np.ndarray) -> np.ndarray:
        first, second = (self.axes(x, s) for s in signs)
        (axis1, lost1), (axis2, lost2) = first, second
        ranks = [(i, j) for i in range(axis1.shape[1]) for j in range(axis2.shape[1])]
        lost = np.stack([lost1[:, i] + lost2[:, j] for i, j in ranks], axis=1)
        code = np.stack([axis1[:, i] * (2 * self.size) + axis2[:, j] for i, j in ranks], axis=1)
        best = np.argsort(lost, axis=1, kind="stable")[:, : self.probes + 1]
        return np.take_along_axis(code, best, axis=1)

    def axes(self, x: np.ndarray, signs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The nearest three axes and what each loses against the nearest, squared."""
        for s in signs:
            x = hadamard(x * s) / np.sqrt(self.size)
        both = np.concatenate((x, -x), axis=1)
        top = np.argsort(-both, axis=1, kind="stable")[:, :3]
        value = np.take_along_axis(both, top, axis=1)
        return top.astype(np.int64), (value[:, :1] - value) ** 2


def usable(vectors: list) -> tuple[np.ndarray, np.ndarray]:
    """Which vectors can have a cosine, and the number of components of each."""
    fine = np.zeros(len(vectors), bool)
    dims = np.zeros(len(vectors), np.int64)
    for i, v in enumerate(vectors):
        if v is not None and len(v) and all(c is not None for c in v):
            x = np.asarray(v, float)
            fine[i] = bool(np.isfinite(x).all() and np.any(x))
            dims[i] = len(x)
    return fine, dims


def unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)  # so that squares neither overflow nor vanish
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def with_buckets(classes: DataFrame, tables: int, probes: int) -> DataFrame:
    """The usable classes with ``dims`` and the flat list ``buckets``: for each table its own one, then the others."""

    def load():
        hashes: dict[int, CrossPolytope] = {}

        def hashed(vectors: list) -> tuple[np.ndarray, list]:
            fine, dims = usable(vectors)
            out: list = [None] * len(vectors)
            for d in np.unique(dims[fine]).tolist():
                rows = np.flatnonzero(fine & (dims == d))
                x = unit(np.array([vectors[i] for i in rows], float))
                found = hashes.setdefault(d, CrossPolytope(d, tables, probes)).buckets(x)
                for i, b in zip(rows.tolist(), found.reshape(len(rows), -1).tolist(), strict=True):
                    out[i] = b
            return dims, out

        return hashed

    fields = [T.StructField("dims", T.LongType()), T.StructField("buckets", T.ArrayType(T.LongType()))]
    pair = classes.withColumn("buckets", F.col("vector"))
    return add_columns(pair, load, "buckets", fields).filter(F.col("buckets").isNotNull())


def meetings(buckets: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For pairs of rows, the first table in which one asks or is filed where the other is filed."""
    first = np.full(len(a), buckets.shape[1])
    for t in range(buckets.shape[1] - 1, -1, -1):
        x, y = buckets[a, t], buckets[b, t]
        met = (x == y[:, :1]).any(1) | (y == x[:, :1]).any(1)
        first[met] = t
    return first


def own_bucket(buckets: np.ndarray, a: np.ndarray, b: np.ndarray, t: int) -> np.ndarray:
    """The bucket of table ``t`` in which a meeting pair is looked at: the smaller of those in which it meets."""
    x, y = buckets[a, t], buckets[b, t]
    none = np.iinfo(np.int64).max
    at_y = np.where((x == y[:, :1]).any(1), y[:, 0], none)
    at_x = np.where((y == x[:, :1]).any(1), x[:, 0], none)
    return np.minimum(at_x, at_y)


def compare(frame: pd.DataFrame, similarity: float, probes: int) -> tuple[list, list]:
    """(node, links) counts and (node, root) stars of one block."""
    vectors = unit(np.stack(frame["vector"].to_numpy()).astype(float))
    buckets = np.stack(frame["buckets"].to_numpy()).reshape(len(frame), -1, probes + 1)
    node, size = frame["node"].to_numpy(), frame["members"].to_numpy()
    salt, filed = frame["salt"].to_numpy(), frame["filed"].to_numpy()
    table, bucket = int(frame["table"].iloc[0]), int(frame["bucket"].iloc[0])
    first, second = int(frame["first"].iloc[0]), int(frame["second"].iloc[0])
    left, right = np.flatnonzero(salt == first), np.flatnonzero(salt == second)
    close = np.argwhere(vectors[left] @ vectors[right].T >= similarity - 1e-9)
    a, b = left[close[:, 0]], right[close[:, 1]]
    keep = (a < b) if first == second else np.ones(len(a), bool)
    keep &= filed[a] | filed[b]
    a, b = a[keep], b[keep]
    exact = np.einsum("ij,ij->i", vectors[a], vectors[b]) >= similarity
    a, b = a[exact], b[exact]
    mine = meetings(buckets, a, b) == table
    a, b = a[mine], b[mine]
    mine = own_bucket(buckets, a, b, table) == bucket
    a, b = a[mine], b[mine]
    links = np.bincount(a, size[b], len(frame)) + np.bincount(b, size[a], len(frame))
    root = labels_of_links(len(frame), a, b)
    return list(zip(node[links > 0], links[links > 0].astype(int), strict=True)), [
        (node[i], node[r]) for i, r in enumerate(root) if i != r
    ]


def linked(classes: DataFrame, similarity: float, probes: int) -> DataFrame:
    """(node, root, links): stars of linked classes have a root, counts of links have links."""
    width = probes + 1
    entries = classes.select("node", "members", "dims", "vector", "buckets", F.posexplode("buckets").alias("i", "bucket"))
    entries = entries.withColumns({"table": F.floor(F.col("i") / width).cast("int"), "filed": F.col("i") % width == 0})
    keys = ["dims", "table", "bucket"]
    filed = entries.groupBy(*keys).agg(F.max("filed").alias("any_filed"), F.count(F.lit(1)).alias("asked"))
    slim = entries.select("node", *keys, "filed")
    slim = slim.join(filed.filter("any_filed and asked > 1").select(*keys), keys)
    blocks = pair_blocks(slim, keys, F.xxhash64("node"), BLOCK_ROWS)
    blocks = blocks.join(classes.select("node", "members", "vector", "buckets"), "node")
    keys = [*keys, "first", "second"]

    def compared(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in whole_groups(frames, keys, 5000):
            counts: list = []
            stars: list = []
            group = group_numbers(frame, keys)
            ends = np.flatnonzero(np.diff(np.append(group, -1))) + 1
            for start, end in zip([0, *ends[:-1]], ends, strict=True):
                if end - start > 1:
                    found = compare(frame.iloc[start:end], similarity, probes)
                    counts += found[0]
                    stars += found[1]
            yield pd.DataFrame(
                {
                    "node": pd.Series([x[0] for x in counts + stars], dtype="int64"),
                    "root": pd.Series([None] * len(counts) + [x[1] for x in stars], dtype="Int64"),
                    "links": pd.Series([x[1] for x in counts] + [0] * len(stars), dtype="int64"),
                }
            )

    dealt = blocks.repartition(*keys).sortWithinPartitions(*keys)
    return dealt.mapInPandas(compared, "node long, root long, links long")


def near_duplicates(
    vectors: DataFrame,
    id_col="vec_id",
    vector_col="embedding",
    similarity: float = SIMILARITY,
    tables: int = TABLES,
    probes: int = PROBES,
) -> DataFrame:
    """(id, n_links, component_id, kept): one row per vector.

    ``n_links`` counts the other vectors that are linked directly, copies included; the component is the smallest id
    that links reach, and the row that has it is kept.
    """
    rows = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("vector"))
    rows = rows.withColumn("vector", F.transform("vector", lambda c: c + F.lit(0.0)))  # -0.0 becomes 0.0
    sized = rows.groupBy("vector").agg(F.count(F.lit(1)).alias("members"), F.min("id").alias("least_id"))
    classes = stage(sized.withColumn("node", F.monotonically_increasing_id()), "vector-classes")
    hashed = stage(with_buckets(classes.drop("least_id"), tables, probes), "vector-buckets")
    found = stage(linked(hashed, similarity, probes), "vector-links")
    counts = found.groupBy("node").agg(F.sum("links").alias("links"))
    roots = connected_components(found.filter(F.col("root").isNotNull()).select("node", "root"), "vector")
    own = hashed.select("node", F.lit(True).alias("usable"))
    joined = classes.join(own, "node", "left").join(counts, "node", "left").join(roots, "node", "left")
    joined = joined.withColumn("root", F.coalesce("root", "node"))
    least = joined.groupBy("root").agg(F.min("least_id").alias("component_id"))
    copies = F.when(F.col("usable"), F.col("members") - 1).otherwise(F.lit(0))
    known = joined.join(least, "root").select(
        F.col("vector").alias("class_vector"),
        "usable",
        (F.coalesce("links", F.lit(0)) + copies).alias("n_links"),
        "component_id",
    )
    out = rows.join(known, rows["vector"].eqNullSafe(known["class_vector"]), "left")
    component = F.when(F.col("usable"), F.col("component_id")).otherwise(F.col("id"))
    return out.select(
        F.col("id").alias(id_col),
        "n_links",
        component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"),
    )
