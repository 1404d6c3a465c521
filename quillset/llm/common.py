"""What the operators share: folds, row keys, batches cut at key borders, connected components."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from quillset.session import stage

FOLDS = 5
#: Rows of a batch whose texts are Python objects at the same time.
ROWS_AT_ONCE = 512


def held_out(id_col: str) -> Column:
    """The fold that is never learned from; a null id counts as held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % FOLDS == 0, F.lit(True))


def bounded_sample(rows: DataFrame, id_col: str, label: str, size: int) -> tuple[DataFrame, dict]:
    """About ``size`` rows of each label, drawn by hash of the id, never more than twice that on average over the labels.

    Returns the sample and the counts of all rows by label. Labels are few: their counts come to the driver.
    """
    counts = {r[0]: r[1] for r in rows.filter(F.col(label).isNotNull()).groupBy(label).count().collect()}
    if not counts:
        return rows.limit(0), counts
    shares = F.create_map(*[F.lit(x) for k, n in counts.items() for x in (k, size / n)])
    draw = F.xxhash64(F.col(id_col)) / F.lit(2.0**64) + 0.5
    return rows.filter(draw < F.element_at(shares, F.col(label))).limit(2 * size * len(counts)), counts


def add_columns(
    df: DataFrame, load: Callable[[], Callable[[list], object]], source: str, fields: list[T.StructField]
) -> DataFrame:
    """``df`` with columns computed from ``source``, batch by batch; columns of the same name are replaced.

    ``load`` runs once per task and returns a function from a list of values to an array (one field) or to a tuple of
    arrays. The other columns pass through as Arrow data, untouched.
    """
    rest = df.drop(*[f.name for f in fields if f.name != source])
    schema = T.StructType([*[f for f in rest.schema.fields if f.name not in {x.name for x in fields}], *fields])
    kinds = [to_arrow_type(f.dataType) for f in fields]
    kept = [f.name for f in schema.fields[: -len(fields)]]

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compute = load()
        for batch in (b.slice(at, ROWS_AT_ONCE) for b in batches for at in range(0, b.num_rows, ROWS_AT_ONCE)):
            made = compute(batch.column(batch.schema.get_field_index(source)).to_pylist())
            made = made if isinstance(made, tuple) else (made,)
            columns = [batch.column(batch.schema.get_field_index(c)) for c in kept]
            columns += [pa.array(x, type=kind) for x, kind in zip(made, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, names=[*kept, *[f.name for f in fields]])
            pa.default_memory_pool().release_unused()

    return rest.mapInArrow(added, schema)


def whole_groups(frames: Iterator[pd.DataFrame], keys: list[str], rows: int) -> Iterator[pd.DataFrame]:
    """Frames of at least ``rows`` rows (but for the last) that end where the sorted keys change."""
    held: list[pd.DataFrame] = []
    size = 0
    for frame in frames:
        held.append(frame)
        size += len(frame)
        if size < rows:
            continue
        whole = pd.concat(held, ignore_index=True)
        last = np.ones(len(whole), bool)
        for k in keys:
            last &= (whole[k] == whole[k].iloc[-1]).to_numpy()
        cut = int(np.flatnonzero(~last)[-1]) + 1 if not last.all() else 0
        if cut:
            yield whole.iloc[:cut].reset_index(drop=True)
        held = [whole.iloc[cut:]]
        size = len(whole) - cut
    if size:
        yield pd.concat(held, ignore_index=True)


def group_numbers(frame: pd.DataFrame, keys: list[str]) -> np.ndarray:
    """0, 1, ... for the runs of equal keys."""
    new = np.zeros(len(frame), bool)
    for k in keys:
        values = frame[k].to_numpy()
        new[1:] |= values[1:] != values[:-1]
    return np.cumsum(new)


def labels_of_links(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest number reachable from each of ``n`` nodes over the links a-b."""
    label = np.arange(n)
    while len(a):
        low = np.minimum(label[a], label[b])
        before = label.copy()
        np.minimum.at(label, a, low)
        np.minimum.at(label, b, low)
        np.minimum.at(label, before[a], low)
        np.minimum.at(label, before[b], low)
        label = label[label]
        if np.array_equal(before, label):
            break
    return label


def pair_blocks(members: DataFrame, keys: list[str], by: Column, cap: int) -> DataFrame:
    """Deal the members of each bucket out to blocks, so that every pair of a bucket meets in a block.

    ``members`` has the keys of the bucket. Buckets of one row go. A bucket of more than ``cap`` rows is split into
    salts by ``by``, and a block holds two of them, so a block has about ``2 * cap`` rows whatever the bucket's size.
    The sizes are partial counts, and the join that brings them back can be split at a hot bucket. Adds ``salt``
    (the row's own), ``first`` and ``second`` (the block's).
    """
    sizes = members.groupBy(*keys).agg(F.count(F.lit(1)).alias("bucket_rows")).filter("bucket_rows > 1")
    salts = F.ceil(F.col("bucket_rows") / cap).cast("int")
    sized = members.join(sizes, keys).withColumn("salts", salts)
    salted = sized.withColumn("salt", F.pmod(by, "salts").cast("int"))
    others = F.sequence(F.lit(0), F.col("salts") - 1)
    dealt = salted.withColumn("other", F.explode(others))
    return dealt.select(
        *members.columns,
        "salt",
        F.least("salt", "other").alias("first"),
        F.greatest("salt", "other").alias("second"),
    )


def connected_components(links: DataFrame, name: str) -> DataFrame:
    """(node, root): the smallest node that each linked node can reach.

    ``links`` has two columns of nodes. Alternates large and small stars: each round joins a node's links with the
    smallest neighbour, which is a partial minimum, and the join can be split at a hub. The links of each round are
    written to the shared folder, and only their number and a checksum come to the driver.
    """
    a, b = links.columns
    edges = links.select(F.greatest(a, b).alias("node"), F.least(a, b).alias("root"))
    edges = stage(edges.filter("node <> root").distinct(), f"{name}-links")
    before = None
    while True:
        row = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("node", "root"))).first()
        if tuple(row) == before or row[0] == 0:
            return edges
        before = tuple(row)
        both = edges.select("node", "root").union(edges.select("root", "node"))
        least = both.groupBy("node").agg(F.least(F.min("root"), F.first("node")).alias("least"))
        large = both.join(least, "node").filter("root > node")
        large = large.select(F.col("root").alias("node"), F.col("least").alias("root")).distinct()
        least = large.groupBy("node").agg(F.min("root").alias("least"))
        small = large.join(least, "node")
        up = small.select("node", F.col("least").alias("root"))
        across = small.filter("root > least").select(F.col("root").alias("node"), F.col("least").alias("root"))
        edges = stage(up.union(across).distinct(), f"{name}-links")
