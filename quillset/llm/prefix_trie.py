"""Prefix trie of conversations by van Emde Boas recursion.

Turns are known by 128 bits of a digest of role and text; texts are not shuffled. A conversation's turns are numbered
without a window over the conversation: range partitions number what they hold, and the few conversations that begin
before their partition (one for each border at most) get what the earlier partitions count.

Naming. A piece of the trie of depth 2L below one root is cut at half depth. The prefix that ends at the cut is named by
the piece's root and a digest of the L turns above the cut, which is built bottom-up by joining neighbouring halves. So
the upper trie and the lower forest, whose roots are the cut names, are named at the same time by the same rule, down to
single turns: after as many rounds as the depth has binary digits every prefix has its name, however long a conversation
is. The last ``LEAF`` levels run inside one row of at most that many turns, the levels above as joins by
(conversation, cut).

Nodes. Rows with one name are one node: partial counts give its members, its last text's size and the smallest member,
its owner. A conversation owns the lower end of its path, and (owner, depth) is the node's key from then on.

Grafting. Totals over subtrees go upward by the same cuts, from small pieces to large ones. Inside a piece, each node has
the total of its descendants in this piece. To join an upper piece with its lower forest, the total of each lower tree
goes to the cut node it hangs from and to the nodes above that node in the upper piece, which are the path of the cut
node's owner. Each round handles all pieces of a size at the same time; the rows of a round are at most the turns.

A node's list of ending members is hashed in pieces: range partitions write its decimal ids in order, joined to blocks of
``IDS_OF_BLOCK``, and only these blocks of one node meet in a task, which hashes them as a stream.

Defined results: rows with a null conv_id belong to no conversation and are left out; equal turn numbers are ordered by the
digest of role and text, null turn numbers come first, repeated rows count as often as they occur; null role or text is
empty; a table without conversations gives no row, not even a root. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillset.llm.common import add_columns
from quillset.session import stage

#: Turns of the smallest pieces, a power of two.
LEAF = 16
#: Conversations whose first turns are borrowed come in groups of so many; at most ``HEAD - 1`` turns are borrowed.
GROUP, HEAD = 5, 9
IDS_OF_BLOCK = 4096
ROOT = bytes(16)


def digest(*parts: Column) -> Column:
    """128 bits of SHA-256."""
    return F.substring(F.unhex(F.sha2(F.concat(*parts), 256)), 1, 16)


def turns_of(conversations: DataFrame) -> DataFrame:
    """(conv_id, at, digest, size): the turns in order, numbered from 0; ``size`` is the bytes of the text."""
    role, text = [F.coalesce(F.col(c), F.lit("")) for c in ("role", "text")]
    turn = digest(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    rows = conversations.filter("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        "turn",
        turn.alias("digest"),
        F.octet_length(text).cast("long").alias("size"),
        F.monotonically_increasing_id().alias("row"),
    )
    order = ["conv_id", F.col("turn").asc_nulls_first(), "digest", "row"]
    placed = stage(rows, "turn-rows").repartitionByRange(*order).sortWithinPartitions(*order)
    own = stage(placed.select("conv_id", "digest", "size").mapInArrow(numbered, NUMBERED), "turns-in-order")
    counts = own.groupBy("conv_id", "part").agg(F.count(F.lit(1)).alias("rows"))
    ahead = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    later = counts.withColumn("ahead", F.sum("rows").over(ahead)).filter("ahead > 0").drop("rows")
    found = own.join(F.broadcast(later), ["conv_id", "part"], "left")  # one row for each border of partitions at most
    return found.select("conv_id", (F.col("at") + F.coalesce("ahead", F.lit(0))).alias("at"), "digest", "size")


NUMBERED = "conv_id long, part int, at long, digest binary, size long"


def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The place of each row among those of its conversation in this partition."""
    part, last, seen = TaskContext.get().partitionId(), None, 0
    for batch in batches:
        ids = batch.column(0).to_numpy(zero_copy_only=False)
        if not len(ids):
            continue
        new = np.append(True, ids[1:] != ids[:-1])
        first = np.maximum.accumulate(np.where(new, np.arange(len(ids)), 0))
        at = np.arange(len(ids)) - first + np.where(first == 0, seen * (ids[0] == last), 0)
        last, seen = ids[-1], int(at[-1]) + 1
        columns = [batch.column(0), pa.array(np.full(len(ids), part, np.int32)), pa.array(at), *batch.columns[1:]]
        yield pa.RecordBatch.from_arrays(columns, names=["conv_id", "part", "at", "digest", "size"])


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conv_id, turns) of each rebuilt conversation, and its turns: (conv_id, depth, digest, size), depths from 1.

    The first turns of every conversation are a short list, so the borrowed ones need no hot key: a list is asked for by
    ``GROUP`` conversations at most.
    """
    of_id = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % HEAD).cast("int")
    short = F.sort_array(F.collect_list(F.struct("at", "digest", "size")))
    heads = turns.filter(F.col("at") < HEAD).groupBy("conv_id").agg(short.alias("head"))
    base = (F.col("conv_id") - F.col("conv_id") % GROUP).alias("base_id")
    lent = heads.withColumnsRenamed({"conv_id": "base_id", "head": "lent"})
    asked = heads.select("conv_id", base, of_id.alias("h")).join(lent, "base_id", "left")
    asked = asked.withColumn("lent", F.slice(F.coalesce("lent", F.array()), F.lit(1), F.col("h")))
    asked = stage(asked.select("conv_id", "h", "lent", F.size("lent").alias("borrowed")), "borrowed-turns")
    taken = asked.select("conv_id", F.inline("lent")).withColumn("depth", F.col("at") + 1)
    rest = turns.filter(F.col("at") >= of_id).join(asked.select("conv_id", "h", "borrowed"), "conv_id")
    rest = rest.withColumn("depth", F.col("borrowed") + F.col("at") - F.col("h") + 1)
    columns = ["conv_id", "depth", "digest", "size"]
    whole = stage(taken.select(columns).union(rest.select(columns)), "rebuilt-turns")
    sizes = whole.groupBy("conv_id").agg(F.max("depth").alias("turns"))
    sizes = asked.select("conv_id").join(sizes, "conv_id", "left")
    return sizes.select("conv_id", F.coalesce("turns", F.lit(0)).cast("long").alias("turns")), whole


def names_inside(root: bytes | None, turns: list[bytes]) -> list[bytes]:
    """The names of all prefixes inside a smallest piece.

    The prefix of ``p`` turns is the cut of the piece that begins where the lowest binary digit of ``p`` is taken away;
    the digests of the halves above the cuts are joined like the digits of a counter that carries.
    """

    def joined(a: bytes, b: bytes) -> bytes:
        return hashlib.sha256(a + b).digest()[:16]

    names, halves = [root or ROOT], []
    for p, turn in enumerate(turns, 1):
        half, size = turn, 1
        while not p & size:
            half, size = joined(halves.pop(), half), size * 2
        halves.append(half)
        names.append(joined(names[p - size], half))
    return names[1:]


def digest_inside(turns: list[bytes]) -> bytes:
    """The digest of a whole smallest piece."""
    while len(turns) > 1:
        pairs = zip(turns[::2], turns[1::2], strict=True)
        turns = [hashlib.sha256(a + b).digest()[:16] for a, b in pairs]
    return turns[0]


def cut_names(pieces: DataFrame, depth: int) -> DataFrame:
    """(conv_id, cut, cut_name): the names of the prefixes of ``cut * LEAF`` turns, for all pieces that are whole.

    Going up, halves are joined to digests of twice the size; going down, the cuts of each size are named by the root
    above them. Both take one join by (conversation, cut) for each size.
    """
    binary = [T.StructField("half", T.BinaryType())]
    whole = pieces.filter(F.size("turns") == LEAF)
    digests = F.transform("turns", lambda t: t.digest).alias("half")
    whole = whole.select("conv_id", (F.col("piece") + 1).alias("cut"), digests)
    levels = [stage(add_columns(whole, lambda: lambda rows: [digest_inside(t) for t in rows], "half", binary), "halves")]
    while LEAF << len(levels) <= depth:
        pair = F.ceil(F.col("cut") / 2).cast("long")
        both = levels[-1].groupBy("conv_id", pair.alias("cut")).agg(
            F.count(F.lit(1)).alias("halves"), F.min_by("half", "cut").alias("left"), F.max_by("half", "cut").alias("right")
        )
        both = both.filter("halves = 2").select("conv_id", "cut", digest(F.col("left"), F.col("right")).alias("half"))
        levels.append(stage(both, "halves"))
    found = None
    for level in reversed(range(len(levels))):
        odd = levels[level].filter("cut % 2 = 1")
        at = F.col("cut") * (1 << level)
        odd = odd.select("conv_id", at.alias("cut"), (at - (1 << level)).alias("above"), "half")
        if found is None:
            odd = odd.withColumn("root", F.lit(ROOT))
        else:
            root = found.withColumnsRenamed({"cut": "above", "cut_name": "root"})
            odd = odd.join(root, ["conv_id", "above"], "left").withColumn("root", F.coalesce("root", F.lit(ROOT)))
        new = odd.select("conv_id", "cut", digest(F.col("root"), F.col("half")).alias("cut_name"))
        found = stage(new if found is None else found.union(new), "cut-names")
    return found


def named(turns: DataFrame, depth: int) -> DataFrame:
    """(conv_id, depth, size, name): each turn with the name of the prefix that it ends."""
    piece = F.floor((F.col("depth") - 1) / LEAF).alias("piece")
    pieces = turns.groupBy("conv_id", piece).agg(
        F.sort_array(F.collect_list(F.struct("depth", "digest", "size"))).alias("turns")
    )
    if depth > LEAF:
        pieces = stage(pieces, "pieces-of-turns")
        cuts = cut_names(pieces, depth)
        above = cuts.withColumnsRenamed({"cut": "piece", "cut_name": "root"})
        own = cuts.select("conv_id", (F.col("cut") - 1).alias("piece"), F.col("cut_name").alias("last"))
        pieces = pieces.join(above, ["conv_id", "piece"], "left").join(own, ["conv_id", "piece"], "left")
    else:
        pieces = pieces.withColumns({c: F.lit(None).cast("binary") for c in ("root", "last")})

    def names(rows: list[dict]) -> list[list[bytes]]:
        found = []
        for r in rows:
            own = names_inside(r["root"], [t["digest"] for t in r["turns"]])
            if r["last"] is not None and len(own) == LEAF:  # the cut of a larger piece
                own[-1] = r["last"]
            found.append(own)
        return found

    asked = pieces.select("conv_id", "turns", F.struct("root", "last", "turns").alias("names"))
    found = add_columns(asked, lambda: names, "names", [T.StructField("names", T.ArrayType(T.BinaryType()))])
    rows = found.select("conv_id", F.inline(F.arrays_zip("turns", "names")))
    return rows.select("conv_id", "turns.depth", "turns.size", F.col("names").alias("name"))


def grafted(paths: DataFrame, depth: int) -> DataFrame:
    """(conv_id, depth, saved, leaves) to be summed by node: what each node's subtree holds.

    ``paths`` has (conv_id, depth, owner, saved, leaves), the last two being the node's own, and zero but for its owner.
    """
    sums = [F.sum("saved").alias("saved"), F.sum("leaves").alias("leaves")]
    key = [F.col("owner").alias("conv_id"), "depth"]
    piece = F.floor((F.col("depth") - 1) / LEAF).alias("piece")
    below = Window.partitionBy("conv_id", piece).orderBy(F.col("depth").desc()).rowsBetween(Window.unboundedPreceding, 0)
    inside = paths.withColumns({c: F.sum(c).over(below) for c in ("saved", "leaves")})
    totals = [stage(inside.filter("saved > 0 or leaves > 0").groupBy(*key).agg(*sums), "totals")]
    deep, size = totals[0].filter(F.col("depth") > LEAF), LEAF
    while size < depth:
        roots = deep.filter((F.col("depth") - 1) % (2 * size) == size)
        roots = roots.select("conv_id", (F.col("depth") - 1).alias("cut"), "saved", "leaves")
        up = paths.filter(F.col("depth") % (2 * size) == size).select("conv_id", F.col("depth").alias("cut"), "owner")
        trees = roots.join(up, ["conv_id", "cut"]).groupBy(F.col("owner").alias("conv_id"), "cut").agg(*sums)
        upper = paths.filter((F.col("depth") - 1) % (2 * size) < size)
        cut = (F.floor((F.col("depth") - 1) / (2 * size)) * (2 * size) + size).alias("cut")
        upper = upper.select("conv_id", "depth", "owner", cut)
        more = trees.join(upper, ["conv_id", "cut"]).groupBy(*key).agg(*sums)
        totals.append(stage(more, "grafts"))
        deeper = totals[-1].filter(F.col("depth") > LEAF)
        size *= 2
        if size < depth:
            deep = stage(deep.union(deeper).groupBy("conv_id", "depth").agg(*sums), "deep-totals")
    whole = totals[0]
    for more in totals[1:]:
        whole = whole.union(more)
    return whole


def hashed_lists(ends: DataFrame) -> DataFrame:
    """(conv_id, depth, ends_sha256) from (conv_id, depth, member): the ascending decimal ids, comma-joined."""
    order = ["conv_id", "depth", "member"]

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            before, ids = None, []
            for node, depth, member in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if (node, depth) != before or len(ids) == IDS_OF_BLOCK:
                    if ids:
                        rows.append((*before, ids[0], ",".join(map(str, ids)).encode()))
                    before, ids = (node, depth), []
                ids.append(member)
            if ids:
                rows.append((*before, ids[0], ",".join(map(str, ids)).encode()))
            if rows:
                columns = [pa.array(x) for x in zip(*rows, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, names=["conv_id", "depth", "first", "ids"])

    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before, now = None, hashlib.sha256()
        for batch in batches:
            rows: list[tuple] = []
            for node, depth, ids in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if (node, depth) != before:
                    if before is not None:
                        rows.append((*before, now.hexdigest()))
                    before, now = (node, depth), hashlib.sha256()
                else:
                    now.update(b",")
                now.update(ids)
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*rows, strict=True)], names=names)
        if before is not None:
            yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (*before, now.hexdigest())], names=names)

    names = ["conv_id", "depth", "ends_sha256"]
    placed = ends.select(order).repartitionByRange(*order).sortWithinPartitions(*order)
    lists = placed.mapInArrow(blocks, "conv_id long, depth long, first long, ids binary")
    node = ["conv_id", "depth"]
    gathered = lists.repartition(*node).sortWithinPartitions(*node, "first").select(*node, "ids")
    return gathered.mapInArrow(hashes, "conv_id long, depth long, ends_sha256 string")


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """One row per node of the trie of the rebuilt conversations.

    Returns (conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256); ``conversations``
    has conv_id, turn, role and text.
    """
    sizes, turns = rebuilt(turns_of(conversations))
    sizes = stage(sizes, "conversation-turns")
    members, first, depth = sizes.agg(F.count(F.lit(1)), F.min("conv_id"), F.coalesce(F.max("turns"), F.lit(0))).first()
    rows = stage(named(turns, depth), "named-turns")
    nodes = rows.groupBy("name").agg(F.min("conv_id").alias("owner"), F.count(F.lit(1)).alias("n_convs"))
    paths = stage(rows.join(nodes, "name").drop("name"), "paths")
    own = paths.filter("conv_id = owner")
    parents = paths.select("conv_id", (F.col("depth") + 1).alias("depth"), F.col("owner").alias("parent_conv_id"))
    own = own.join(parents, ["conv_id", "depth"], "left")
    own = own.withColumn("parent_conv_id", F.coalesce("parent_conv_id", F.lit(first).cast("long")))
    own = stage(own.select("conv_id", "depth", "size", "n_convs", "parent_conv_id"), "nodes")
    children = own.groupBy(F.col("parent_conv_id").alias("conv_id"), (F.col("depth") - 1).alias("depth")).agg(
        F.count(F.lit(1)).alias("n_children")
    )
    children = stage(children, "children")
    own = own.join(children, ["conv_id", "depth"], "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)))
    own = own.withColumns(
        {"saved": (F.col("n_convs") - 1) * F.col("size"), "leaves": (F.col("n_children") == 0).cast("long")}
    )
    own = stage(own, "weighed-nodes")
    weights = own.select("conv_id", "depth", "saved", "leaves")
    weighed = paths.select("conv_id", "depth", "owner").join(weights, ["conv_id", "depth"], "left")
    weighed = stage(weighed.fillna(0, ["saved", "leaves"]), "weighed-paths")
    totals = grafted(weighed, depth)
    root_key = [F.lit(first).cast("long").alias("conv_id"), F.lit(0).cast("long").alias("depth")]
    totals = totals.select("conv_id", "depth", "saved", "leaves")
    totals = totals.union(totals.filter("depth = 1").select(*root_key, "saved", "leaves"))
    totals = totals.groupBy("conv_id", "depth").agg(F.sum("saved").alias("saved_tokens"), F.sum("leaves").alias("n_leaves"))
    last = paths.select("conv_id", F.col("depth").alias("turns"), "owner")
    ends = sizes.join(last, ["conv_id", "turns"], "left")
    ends = ends.select(
        F.coalesce("owner", F.lit(first).cast("long")).alias("conv_id"),
        F.col("turns").alias("depth"),
        F.col("conv_id").alias("member"),
    )
    lists = hashed_lists(stage(ends, "ends"))
    root = children.sparkSession.range(min(members, 1)).select(
        *root_key,
        F.lit(None).cast("long").alias("parent_conv_id"),
        F.lit(members).cast("long").alias("n_convs"),
    )
    root = root.join(F.broadcast(children.filter("depth = 0")), ["conv_id", "depth"], "left")
    root = root.withColumn("n_children", F.coalesce("n_children", F.lit(0)))
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children"]
    whole = own.select(columns).union(root.select(columns))
    whole = whole.join(totals, ["conv_id", "depth"], "left").join(lists, ["conv_id", "depth"], "left")
    childless = (F.col("n_children") == 0).cast("long")
    return whole.select(
        *columns,
        F.coalesce("n_leaves", childless).alias("n_leaves"),
        F.coalesce("saved_tokens", F.lit(0)).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"),
    )
