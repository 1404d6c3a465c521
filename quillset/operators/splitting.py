"""Seeded train, validation and test splits of exact size."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillset.schemas import SEED, TEST_SIZE, VAL_SIZE
from quillset.session import stage

PREFIX_CHARS = 4
HASH_CHARS = 32
SORTABLE_ROWS = 10_000


def split_sizes(rows: Column, test_size: float = TEST_SIZE, val_size: float = VAL_SIZE) -> dict[str, Column]:
    """Sizes of the three splits. Too few rows all train; a single held-out row is for testing."""
    rows = rows.cast("bigint")
    share = test_size + val_size
    if share == 0:
        return {"train": rows, "val": F.lit(0).cast("bigint"), "test": F.lit(0).cast("bigint")}
    enough = (rows >= 3) & (F.floor(rows * F.lit(share)) >= 1)
    held_out = F.when(enough, F.ceil(rows * F.lit(share))).otherwise(0).cast("bigint")
    test_share = 1 - val_size / share
    test = F.when(held_out < 2, held_out).otherwise(F.ceil(held_out * F.lit(test_share))).cast("bigint")
    return {"train": rows - held_out, "val": held_out - test, "test": test}


@dataclass(frozen=True)
class _Cut:
    """The hash of the last row on one side; ``prefix`` and ``rank`` locate it while it is unknown."""

    prefix: str
    rank: int
    rows: int


def _split_hash(seed: int, key: list[str]) -> Column:
    """MD5 of the seed and the key's parts, each behind its length, so that different keys are different texts."""
    parts = []
    for c in key:
        text = F.col(c).cast("string")
        parts.append(F.coalesce(F.concat(F.char_length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return F.md5(F.concat(F.lit(f"{seed}/"), *parts))


def _histogram(hashes: DataFrame, depth: int) -> DataFrame:
    """Rows per hash prefix with their running totals: at most 65,536 rows per known shorter prefix."""
    known, prefix = F.substring("h", 1, depth - PREFIX_CHARS), F.substring("h", 1, depth)
    counts = hashes.groupBy(known.alias("known"), prefix.alias("prefix")).agg(F.count(F.lit(1)).alias("rows"))
    running = Window.partitionBy("known").orderBy("prefix")
    return counts.withColumn("upto", F.sum("rows").over(running))


def _locate(histogram: DataFrame, wanted: list[_Cut], ranks: list[Column]) -> list[_Cut]:
    """The prefixes that hold the wanted ranks; one row per cut reaches the driver."""
    cuts = [
        F.struct(F.lit(i).alias("cut"), F.lit(c.prefix).alias("within"), r.alias("rank"))
        for i, (c, r) in enumerate(zip(wanted, ranks))
    ]
    before = F.col("upto") - F.col("rows")
    found = (
        histogram.select("*", F.inline(F.array(*cuts)))
        .where((F.col("known") == F.col("within")) & (F.col("rank") > before) & (F.col("rank") <= F.col("upto")))
        .select("cut", "prefix", (F.col("rank") - before).alias("rank"), "rows")
        .collect()
    )
    by_cut = {row["cut"]: _Cut(row["prefix"], row["rank"], row["rows"]) for row in found}
    return [by_cut.get(i, _Cut("", 0, 0)) for i in range(len(wanted))]


def _last_hash(hashes: DataFrame, cut: _Cut) -> str:
    """The hash at a rank within one prefix of bounded size."""
    if cut.rank == 0:
        return ""
    if cut.rows > SORTABLE_ROWS:
        raise ValueError("the split key is not unique, so no exact cut exists")
    inside = hashes.where(F.col("h").startswith(cut.prefix)).orderBy("h")
    last, *following = [row["h"] for row in inside.offset(cut.rank - 1).limit(2).collect()]
    if last in following:
        raise ValueError("the split key is not unique, so no exact cut exists")
    return last


def assign_splits(
    papers: DataFrame,
    test_size: float = TEST_SIZE,
    val_size: float = VAL_SIZE,
    seed: int = SEED,
    key: tuple[str, ...] = ("id", "title"),
    staged: bool = False,
) -> DataFrame:
    """Add ``split``: papers ranked by a seeded hash of their unique key and cut at the exact sizes.

    No row is ranked or shuffled. Two cut hashes are found from a histogram of hash prefixes, refined
    where a cut falls into a prefix of many rows, and each row is compared with them in place. The
    input is written to the shared folder first, as it is read three times; pass ``staged`` if it is
    already a stored table.
    """
    table = papers if staged else stage(papers, "papers")
    hashes = table.select(_split_hash(seed, list(key)).alias("h"))

    histogram = _histogram(hashes, PREFIX_CHARS)
    total = F.sum("rows").over(Window.partitionBy("known"))
    sizes = split_sizes(F.col("total"), test_size, val_size)
    cuts = _locate(
        histogram.withColumn("total", total), [_Cut("", 0, 0)] * 2, [sizes["train"], sizes["train"] + sizes["val"]]
    )
    depth = PREFIX_CHARS
    while depth < HASH_CHARS and any(c.rows > SORTABLE_ROWS for c in cuts):
        depth += PREFIX_CHARS
        inside = F.substring("h", 1, depth - PREFIX_CHARS).isin([c.prefix for c in cuts if c.rank])
        cuts = _locate(_histogram(hashes.where(inside), depth), cuts, [F.lit(c.rank) for c in cuts])
    last_train, last_val = (_last_hash(hashes, c) for c in cuts)

    h = _split_hash(seed, list(key))
    return table.withColumn(
        "split", F.when(h <= last_train, "train").when(h <= last_val, "val").otherwise("test")
    )


def count_splits(papers: DataFrame) -> DataFrame:
    return papers.groupBy("split").agg(F.count(F.lit(1)).alias("rows"))
