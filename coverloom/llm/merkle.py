"""Merkle dataset manifest: built bottom-up, proofs pushed top-down.

A row's leaf is the digest of its fields. The leaves of a group, in their order, are joined in runs of `fanout` to parents, these
again, until one node is left, the group's subroot; the subroots, in the order of their groups, likewise give the root.

Nodes are kept in blocks of `fanout ** stride` neighbours with all levels between them and the node above, so that one shuffle
climbs `stride` levels and one table is written for all of them: with 256 nodes a block, four tables hold four billion leaves. From the top down every block gets the proof of the node above it, by a join of the child's block with its parent's
place, and each node prepends its own siblings to this inherited suffix. Full proofs exist at the leaves alone and are never
shuffled.

Places of leaves come from a range partitioning: a group that spans many partitions is numbered by the counts of the partitions
before, so a group that holds most rows is no task of its own.

Defined cases: a null field counts as null, unlike an empty one; a null group is a group, the first one; rows that tie in the
order are ordered by their leaf, and if that is equal too they have equal digests in neighbouring places; a group of one row has
its leaf as subroot, a manifest of one group its subroot as root; an empty table has no row and no root; columns that aren't
named take no part.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from coverloom.llm.util import bounded, materialize

#: Levels of a block, and rows of a table (places of partitions) that may be broadcast.
STRIDE, BROADCAST_ROWS = 8, 50_000


def encoded(value: Column) -> Column:
    """`-` for null, else the number of bytes, a colon and the value."""
    s = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-"))


def digest(*fields: Column) -> Column:
    """The leaf of a row: lowercase hexadecimal SHA-256 of its encoded fields."""
    return F.sha2(F.concat(*[encoded(x) for x in fields]), 256)


def fold(leaf: Column, proof: Column) -> Column:
    """The root that follows from a leaf and its proof."""
    return F.aggregate(proof, leaf, lambda acc, s: F.sha2(F.concat(s.getField("left"), acc, s.getField("right")), 256))


def proof_digest(proof: Column) -> Column:
    """Digest of all siblings of a proof, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(proof, lambda s: F.concat(s.getField("left"), s.getField("right"))), ""), 256)


@dataclass
class Forest:
    """Block tables from the leaves up: (tree, block, n, levels, rows). n: nodes of this level in the tree; levels: the block's nodes and those of each level above them; rows: what the leaves carry. tops: (tree, top)."""

    blocks: list[DataFrame]
    tops: DataFrame
    fanout: int
    stride: int


@dataclass
class Manifest:
    leaves: Forest
    groups: Forest


def _placed(nodes: DataFrame, many: bool) -> DataFrame:
    """(tree, pos, n, hash, row) from (tree, at, hash, row): places from 0 in each tree in the order of at, then hash."""
    n = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    key = ["tree", "at", "hash"]
    nodes = nodes.repartitionByRange(n, *key) if many else nodes.repartitionByRange(1, *key)
    i = F.monotonically_increasing_id()
    nodes = nodes.sortWithinPartitions(*key).withColumns({"_p": F.shiftright(i, 33), "_i": i.bitwiseAND(F.lit((1 << 33) - 1))})
    nodes = materialize(nodes.drop("at"), "places")
    counts = nodes.groupBy("_p", F.col("tree").alias("_t")).agg(F.min("_i").alias("_first"), F.count(F.lit(1)).alias("_n"))
    own = W.partitionBy("_t")  # a row for each partition that has the tree
    before = F.coalesce(F.sum("_n").over(own.orderBy("_p").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    spans = counts.withColumns({"_before": before, "n": F.sum("_n").over(own)}).withColumnRenamed("_p", "_q")
    met = nodes.join(bounded(spans, BROADCAST_ROWS), (F.col("_p") == F.col("_q")) & F.col("tree").eqNullSafe(F.col("_t")))
    return met.select("tree", (F.col("_before") + F.col("_i") - F.col("_first")).alias("pos"), "n", "hash", "row")


def _depth(n: Column, fanout: int, stride: int) -> Column:
    """Levels that a block of a level of n nodes climbs: stride, or as many as lead to a single node."""
    return sum((F.when(n > fanout**j, 1).otherwise(0) for j in range(stride)), F.lit(0))


def _levels(first: Column, depth: Column, fanout: int, stride: int) -> Column:
    """array of the block's levels, `first` included; beyond depth they repeat the single node."""


    def climb(levels, j):
        last = F.element_at(levels, -1)
        runs = F.sequence(F.lit(0), F.floor((F.size(last) - 1) / F.lit(fanout)).cast("int"))
        up = F.transform(runs, lambda r: F.sha2(F.array_join(F.slice(last, r * fanout + 1, F.lit(fanout)), ""), 256))
        return F.concat(levels, F.array(F.when(depth > j, up).otherwise(last)))

    return F.aggregate(F.sequence(F.lit(0), F.lit(stride - 1)), F.array(first), climb)


def forest(nodes: DataFrame, fanout: int = 2, stride: int = STRIDE, many: bool = True) -> Forest:
    """Trees over nodes (tree, at, hash, row). many: False for a table of few rows, numbered in one task."""
    width, blocks = fanout**stride, []
    placed = _placed(nodes, many)
    most = None
    while most is None or most > 1:
        of = placed.groupBy("tree", F.floor(F.col("pos") / F.lit(width)).alias("block"), "n")
        of = of.agg(F.sort_array(F.collect_list(F.struct("pos", "hash", "row"))).alias("nodes"))
        levels = _levels(F.transform("nodes", lambda x: x.getField("hash")), _depth(F.col("n"), fanout, stride), fanout, stride)
        table = materialize(of.select("tree", "block", "n", levels.alias("levels"), F.transform("nodes", lambda x: x.getField("row")).alias("rows")), "blocks")
        blocks.append(table)
        top = F.get(F.element_at("levels", -1), F.lit(0))
        above = F.ceil(F.col("n") / F.lit(width)).cast("long")
        placed = table.select("tree", F.col("block").alias("pos"), above.alias("n"), top.alias("hash"), F.lit(None).cast("int").alias("row"))
        most = table.agg(F.max("n")).first()[0] or 1 if most is None else most
        most = -(-most // width)
    return Forest(blocks, placed.select("tree", F.col("hash").alias("top")), fanout, stride)


def _steps(i: Column, levels: Column, depth: Column, fanout: int, stride: int) -> Column:
    """The siblings of node i of a block, level by level: array of struct<left, right>, the digests on either side joined."""
    out = []
    for j in range(stride):
        level, p = F.element_at(levels, j + 1), F.floor(i / F.lit(fanout**j)).cast("int")
        run = F.floor(p / F.lit(fanout)).cast("int") * fanout
        left, right = F.slice(level, run + 1, p - run), F.slice(level, p + 2, run + fanout - p - 1)
        out.append(F.struct(F.array_join(left, "").alias("left"), F.array_join(right, "").alias("right")))
    return F.slice(F.array(*out), F.lit(1), depth)


def push(trees: Forest, above: DataFrame) -> DataFrame:
    """(tree, top, root, hash, row, proof) of each leaf. above: (tree, root, proof), what the tops inherit."""
    got = above.select(F.col("tree").alias("_t"), F.lit(0).cast("long").alias("_pos"), F.lit(None).cast("string").alias("top"), "root", F.col("proof").alias("suffix"))
    for k, table in reversed(list(enumerate(trees.blocks))):
        met = table.join(got, F.col("tree").eqNullSafe(F.col("_t")) & (F.col("block") == F.col("_pos"))).drop("_t", "_pos")
        met = met.withColumn("top", F.coalesce("top", F.get(F.element_at("levels", -1), F.lit(0))))
        depth = _depth(F.col("n"), trees.fanout, trees.stride)

        def node(i):
            steps = _steps(i, F.col("levels"), depth, trees.fanout, trees.stride)  # noqa: B023
            place = F.col("block") * trees.fanout**trees.stride + i
            return F.struct(place.alias("_pos"), F.get(F.get("levels", F.lit(0)), i).alias("hash"), F.get("rows", i).alias("row"), F.concat(steps, F.col("suffix")).alias("suffix"))

        each = met.select(F.col("tree").alias("_t"), "top", "root", F.inline(F.transform(F.sequence(F.lit(0), F.size("rows") - 1), node)))
        got = each if k == 0 else materialize(each.drop("hash", "row"), "suffixes")
    return got.select(F.col("_t").alias("tree"), "top", "root", "hash", "row", F.col("suffix").alias("proof"))


def build(df: DataFrame, columns: list[str], group: str, order: str, keep: dict[str, Column] | None = None, fanout: int = 2, stride: int = STRIDE) -> Manifest:
    """The manifest of df: leaves from `columns`, in each `group` ascending by `order`; keep: what proofs shall carry beside the leaf, by name."""
    if fanout < 2 or stride < 1:
        raise ValueError("runs need two nodes and blocks a level at least")
    carried = F.struct(*[c.alias(n) for n, c in keep.items()]) if keep else F.lit(None).cast("int")
    nodes = df.select(F.col(group).alias("tree"), F.col(order).alias("at"), digest(*[F.col(c) for c in columns]).alias("hash"), carried.alias("row"))
    leaves = forest(nodes, fanout, stride)
    tops = leaves.tops.select(F.lit(0).alias("tree"), F.col("tree").alias("at"), F.col("top").alias("hash"), F.struct(F.col("tree").alias("group")).alias("row"))
    few = leaves.tops.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    return Manifest(leaves, forest(tops, fanout, stride, many=not few))


def roots(manifest: Manifest) -> DataFrame:
    """(group, subroot, root) of each group."""
    return _groups(manifest).select(F.col("row.group").alias("group"), F.col("hash").alias("subroot"), "root")


def _groups(manifest: Manifest) -> DataFrame:
    empty = F.array().cast("array<struct<left:string,right:string>>")
    return push(manifest.groups, manifest.groups.tops.select("tree", F.col("top").alias("root"), empty.alias("proof")))


def prove(manifest: Manifest) -> DataFrame:
    """For every row: what was kept of it, leaf, subroot, root, and proof (array of struct<left, right> from the leaf to the root)."""
    above = materialize(_groups(manifest).select(F.col("row.group").alias("tree"), "root", "proof"), "subroots")
    got = push(manifest.leaves, above)
    kept = ["row.*"] if "struct" in got.schema["row"].dataType.simpleString() else []
    return got.select(*kept, F.col("hash").alias("leaf"), F.col("top").alias("subroot"), "root", "proof")
