"""Merkle fixity audit of WARC files.

Every record is hashed with its offset and length. A node of level 1 holds the records that begin in one aligned range
of ``RANGE_BYTES`` of its file, a node of the next level ``FANOUT`` such ranges, and so on up to one root per file. A
node's hash covers the ordered hashes below it. Two replicas are compared by their roots; only below mismatching nodes
are the children read and compared, down to the records.

Records are hashed where they are read, so only digests are shuffled, and a node has a bounded number of children: a
hot file spreads over its ranges. Trees are written level by level to the shared folder.

A null file name or offset is a value like any other, a null payload is empty. Records with the same place are compared
as a sorted list, so repeated records count.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillset.session import stage

RANGE_BYTES = 1 << 16
FANOUT = 16
#: Pages of one WARC file, at most.
FILE_PAGES = 500


def warc_records(pages: DataFrame, id_col="page_id", url_col="url", body_col="html") -> DataFrame:
    """(file, offset, length, record_id, payload): pages as response records of WARC files, ``FILE_PAGES`` ids each.

    The payload is the whole record, head and end included. Null urls and bodies are empty; null ids make one file.
    """
    body = F.coalesce(F.col(body_col).cast("binary"), F.lit("").cast("binary"))
    head = F.concat(
        F.lit("WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:"),
        F.coalesce(F.col(id_col).cast("string"), F.lit("")),
        F.lit(">\r\nWARC-Target-URI: "),
        F.coalesce(url_col, F.lit("")),
        F.lit("\r\nContent-Length: "),
        F.octet_length(body).cast("string"),
        F.lit("\r\n\r\n"),
    )
    made = pages.select(
        F.floor(F.col(id_col) / FILE_PAGES).cast("long").alias("file"),
        F.col(id_col).alias("record_id"),
        F.concat(head.cast("binary"), body, F.lit("\r\n\r\n").cast("binary")).alias("payload"),
    )
    return made.withColumn("length", F.octet_length("payload").cast("long"))


def placed(records: DataFrame) -> DataFrame:
    """``offset`` of each record in its file, in the order of the ids: a running sum over a bounded file."""
    before = Window.partitionBy("file").orderBy("record_id").rowsBetween(Window.unboundedPreceding, -1)
    return records.withColumn("offset", F.coalesce(F.sum("length").over(before), F.lit(0)))


def leaves(records: DataFrame) -> DataFrame:
    """(file, offset, length, record_id, digest) of the records of a replica; payloads are hashed and left behind."""
    place = F.concat_ws(":", F.col("offset").cast("string"), F.col("length").cast("string"))
    payload = F.coalesce(F.col("payload").cast("binary"), F.lit("").cast("binary"))
    digest = F.sha2(F.concat(place.cast("binary"), F.lit("\n").cast("binary"), payload), 256)
    return records.select("file", "offset", "length", "record_id", digest.alias("digest"))


@dataclass(frozen=True)
class Tree:
    """``levels[0]`` are the leaves; each row of a higher level is (file, node, digest, records)."""

    levels: list[DataFrame]


def level_of(offset: Column, level: int) -> Column:
    return F.floor(offset / (RANGE_BYTES * FANOUT ** (level - 1))).cast("long")


def height(*replicas: DataFrame) -> int:
    """Levels above the leaves, so that the highest node holds every offset of all replicas."""
    most = max((r.agg(F.max("offset")).first()[0] or 0) for r in replicas)
    level = 1
    while most >= RANGE_BYTES * FANOUT ** (level - 1):
        level += 1
    return level


def build(hashed: DataFrame, levels: int, name: str) -> Tree:
    """The tree over staged leaves."""
    found = [hashed]
    ranges = hashed.groupBy("file", level_of(F.col("offset"), 1).alias("node")).agg(
        F.sort_array(F.collect_list(F.struct("offset", "digest"))).alias("below"), F.count(F.lit(1)).alias("records")
    )
    found.append(stage(ranges.select("file", "node", hash_of("below"), "records"), f"{name}-ranges"))
    for _ in range(1, levels):
        above = found[-1].groupBy("file", F.floor(F.col("node") / FANOUT).cast("long").alias("node")).agg(
            F.sort_array(F.collect_list(F.struct("node", "digest"))).alias("below"), F.sum("records").alias("records")
        )
        found.append(stage(above.select("file", "node", hash_of("below"), "records"), f"{name}-ranges"))
    return Tree(found)


def hash_of(below: str) -> Column:
    children = F.transform(F.col(below), lambda c: c["digest"])
    return F.sha2(F.array_join(children, "\n").cast("binary"), 256).alias("digest")


def differing(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """The keys whose digest differs between two levels, or which only one of them has."""
    sides = a.select(*keys, "digest", F.lit(0).alias("side")).union(b.select(*keys, "digest", F.lit(1).alias("side")))
    found = sides.groupBy(*keys).agg(
        F.min(F.when(F.col("side") == 0, F.col("digest"))).alias("a"),
        F.min(F.when(F.col("side") == 1, F.col("digest"))).alias("b"),
    )
    return found.filter(~F.col("a").eqNullSafe(F.col("b"))).select(*keys)


def below(children: DataFrame, node: Column, suspects: DataFrame) -> DataFrame:
    """The children under suspect nodes only."""
    named = suspects.select(F.col("file").alias("file_"), F.col("node").alias("node_"))
    same = F.col("file").eqNullSafe(F.col("file_")) & node.eqNullSafe(F.col("node_"))
    return children.join(named, same, "left_semi")


def audit(original: DataFrame, replica: DataFrame) -> DataFrame:
    """(file, offset, record_id, damage): where a replica differs from the original, one row per place.

    ``damage`` is ``missing`` (the replica has no record there), ``extra`` (only the replica has) or ``corrupt``.
    """
    a, b = stage(leaves(original), "original-leaves"), stage(leaves(replica), "replica-leaves")
    levels = height(a, b)
    left, right = build(a, levels, "original"), build(b, levels, "replica")
    suspects = stage(differing(left.levels[-1], right.levels[-1], ["file", "node"]), "suspects")
    for level in range(levels - 1, 0, -1):
        parent = F.floor(F.col("node") / FANOUT).cast("long")
        sides = [below(tree.levels[level], parent, suspects) for tree in (left, right)]
        suspects = stage(differing(*sides, ["file", "node"]), "suspects")
    node = level_of(F.col("offset"), 1)
    sides = [below(tree.levels[0], node, suspects) for tree in (left, right)]
    both = sides[0].withColumn("side", F.lit(0)).union(sides[1].withColumn("side", F.lit(1)))
    of = [F.sort_array(F.collect_list(F.when(F.col("side") == k, F.col("digest")))).alias(c) for k, c in enumerate("ab")]
    found = both.groupBy("file", "offset").agg(*of, F.min("record_id").alias("record_id"))
    damage = F.when(F.size("b") == 0, "missing").when(F.size("a") == 0, "extra").otherwise("corrupt")
    return found.filter(F.col("a") != F.col("b")).select("file", "offset", "record_id", damage.alias("damage"))
