"""Merkle manifest of a dataset: a hash tree over its rows with a proof for each of them.

Leaves are dealt to groups and ordered within them; every ``fanout`` consecutive nodes become
their parent until one is left, the group's subroot; the subroots, in the order of their
groups, give the root in the same way.

The tree is built by slot pivots. One grouped aggregation spreads the descendants of a block
of ``fanout ** levels`` consecutive nodes into slot columns (a conditional aggregate for each
slot); concatenating the columns of a run of siblings hashes their parent, level by level up
to the block's top, and leaving out a node's own slot column gives its siblings. So a tree of
a hundred thousand million leaves takes ten passes, each over a sixteenth of the nodes of the
one before. On the way down a block's children take over the siblings found above it: the
proof of a leaf is put together from one row of its block.

Defined results: a NULL group is a group of its own, the first. NULL ids come first in their
group; rows of one id are ordered by their leaf, so repeated rows are separate leaves in any
order. An empty table gives no rows. Only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loanmart.llm.common import materialize

FANOUT = 2
#: Levels of the tree hashed in one pass: FANOUT ** LEVELS slot columns.
LEVELS = 4


def digest(*parts: Column) -> Column:
    """Lower-case hex SHA-256 of the parts, concatenated; NULL parts are left out."""
    return F.sha2(F.concat_ws("", *parts), 256)


def field(value: Column) -> Column:
    """A leaf's form of a value: its UTF-8 length, a colon and the value, or a dash."""
    text = value.cast("string")
    return F.when(text.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def ranked(nodes: DataFrame, group: str, order: Sequence[str]) -> DataFrame:
    """``place`` (from 0) of every row in its group, and the group's rows ``n``.

    Rows are dealt by ranges of (group, order), so a group that holds most rows is split; the
    rows that stand before a range come from the counts of the ranges, one row for each.
    """
    dealt = materialize(nodes.repartitionByRange(group, *order).withColumn("_range", F.spark_partition_id()), "merkle-ranges")
    counts = dealt.groupBy(group, "_range").agg(F.count(F.lit(1)).alias("_rows"))
    whole = Window.partitionBy(group)
    earlier = whole.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(group, "_range", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before"), F.sum("_rows").over(whole).alias("n"))
    within = Window.partitionBy(group, "_range").orderBy(*order)
    placed = dealt.join(counts, [group, "_range"]).withColumn("place", F.col("_before") + F.row_number().over(within) - 1)
    return placed.drop("_range", "_before")


def spread(nodes: DataFrame, payload: Sequence[str], fanout: int, levels: int) -> DataFrame:
    """One row for each block of ``fanout ** levels`` consecutive nodes of a group.

    ``nodes``: group, place, n (nodes of the group), h (hash) and payload columns. Columns of
    the result: group, block, n, s{level}_{slot} (hashes of the block's nodes), p{slot}
    (payload of its children) and top, its hash after the levels that a group of n nodes has.
    """
    width = fanout ** levels
    slot = F.col("place") % width
    mine = [F.max(F.when(slot == k, F.col("h"))).alias(f"s0_{k}") for k in range(width)]
    if payload:
        mine += [F.max(F.when(slot == k, F.struct(*payload))).alias(f"p{k}") for k in range(width)]
    block = F.floor(F.col("place") / F.lit(width).cast("decimal(20,0)")).cast("long")
    out = nodes.groupBy("group", block.alias("block")).agg(F.max("n").alias("n"), *mine)
    top = F.col("s0_0")
    for level in range(1, levels + 1):
        runs = [[F.col(f"s{level - 1}_{i * fanout + k}") for k in range(fanout)] for i in range(width // fanout ** level)]
        out = out.withColumns({f"s{level}_{i}": F.when(run[0].isNotNull(), digest(*run)) for i, run in enumerate(runs)})
        top = F.when(F.col("n") > fanout ** (level - 1), F.col(f"s{level}_0")).otherwise(top)
    return out.withColumn("top", top)


def children(pivot: DataFrame, above: DataFrame, carried: Sequence[str], payload: Sequence[str], fanout: int, levels: int) -> DataFrame:
    """The nodes of every block with the siblings on their way to the root.

    ``above``: group, block, path (siblings above the block) and carried columns. Columns of
    the result: group, place, h, payload, path, carried. ``path`` is an array of (left, right),
    the concatenated siblings on either side, from the node's own level upwards.
    """
    width = fanout ** levels

    def siblings(slot: int, level: int) -> Column:
        own = slot // fanout ** level
        first = own - own % fanout
        beside = lambda ks: F.concat_ws("", *(F.col(f"s{level}_{k}") for k in ks))
        return F.when(F.col("n") > fanout ** level, F.struct(beside(range(first, own)).alias("left"), beside(range(own + 1, first + fanout)).alias("right")))

    def child(slot: int) -> Column:
        own = [F.col(f"p{slot}.{c}").alias(c) for c in payload]
        way = F.array_compact(F.array(*(siblings(slot, level) for level in range(levels))))
        return F.when(F.col(f"s0_{slot}").isNotNull(), F.struct((F.col("block") * width + slot).alias("place"), F.col(f"s0_{slot}").alias("h"), *own, F.concat(way, F.col("path")).alias("path")))

    rows = pivot.join(above, ["group", "block"])
    return rows.select("group", *carried, F.inline(F.array_compact(F.array(*map(child, range(width))))))


def climb(nodes: DataFrame, payload: Sequence[str], fanout: int, levels: int) -> list[DataFrame]:
    """The pivots of all passes, from the leaves to the pass where every group is one block."""
    width = fanout ** levels
    passes = []
    while True:
        passes.append(materialize(spread(nodes, payload if not passes else (), fanout, levels), "merkle-pass"))
        last = passes[-1].agg(F.max("block")).first()[0]
        if not last:
            return passes
        left = F.ceil(F.col("n") / F.lit(width).cast("decimal(20,0)")).cast("long")
        nodes = passes[-1].select("group", F.col("block").alias("place"), left.alias("n"), F.col("top").alias("h"))


def descend(passes: list[DataFrame], above: DataFrame, carried: Sequence[str], payload: Sequence[str], fanout: int, levels: int) -> DataFrame:
    """All leaves with their paths; ``above`` has group, path and carried columns of each group."""
    now = above.withColumn("block", F.lit(0).cast("long"))
    for pivot in reversed(passes[1:]):
        now = children(pivot, now, carried, (), fanout, levels).select("group", F.col("place").alias("block"), "path", *carried)
    return children(passes[0], now, carried, payload, fanout, levels)


def proofs(leaves: DataFrame, order: Sequence[str], payload: Sequence[str] = (), fanout: int = FANOUT, levels: int = LEVELS) -> DataFrame:
    """Leaves with the proof of each. ``leaves``: group (string or NULL), h, order and payload columns.

    Columns of the result: payload, h, path (left and right siblings from the leaf up to the
    root), subroot, root.
    """
    no_path = F.array().cast("array<struct<left:string,right:string>>")
    # a key that sorts NULL first; strings compare by their UTF-8 bytes
    keyed = leaves.withColumn("group", F.when(F.col("group").isNull(), "").otherwise(F.concat(F.lit("="), F.col("group"))))
    passes = climb(ranked(keyed.select(*dict.fromkeys(["group", "h", *order, *payload])), "group", order), payload, fanout, levels)
    subroots = passes[-1].select(F.lit("").alias("group"), F.col("group").alias("key"), F.col("top").alias("h"))
    trunk = climb(ranked(subroots, "group", ["key"]), ["key"], fanout, levels)
    whole = trunk[-1].select("group", no_path.alias("path"), F.col("top").alias("root"))
    above = descend(trunk, whole, ["root"], ["key"], fanout, levels)
    above = above.select(F.col("key").alias("group"), "path", F.col("h").alias("subroot"), "root")
    return descend(passes, above, ["subroot", "root"], payload, fanout, levels).select(*payload, "h", "path", "subroot", "root")


def fold(path: Column, leaf: Column) -> Column:
    """The root that a leaf and the siblings on its path lead to."""
    return F.aggregate(path, leaf, lambda h, s: F.sha2(F.concat(s["left"], h, s["right"]), 256))


def proof_digest(path: Column) -> Column:
    """Digest of all siblings of a path."""
    return F.sha2(F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), ""), 256)


def document_leaf(n_chars: Column) -> Column:
    return digest(*(field(c) for c in (F.col("doc_id"), F.col("source"), F.col("lang"), n_chars, F.col("text"))))


def tampered_manifest(docs: DataFrame, fanout: int = FANOUT, levels: int = LEVELS) -> DataFrame:
    """Manifest of documents, and its check after some rows were tampered with.

    Every seventh row by the CRC of its id has 1 added to n_chars. Columns: doc_id, leaf,
    subroot, root, proof_sha256, folded_root (of the row as it is now), verified.
    """
    changed = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    more = F.col("n_chars").cast("decimal(20,0)") + 1
    leaves = docs.select("doc_id", F.col("lang").cast("string").alias("group"), document_leaf(F.col("n_chars")).alias("h"),
                         F.when(changed & F.col("n_chars").isNotNull(), document_leaf(more)).alias("tampered"))
    # the texts are read and hashed here, once
    leaves = materialize(leaves, "merkle-leaves")
    out = proofs(leaves, ["doc_id", "h"], ["doc_id", "tampered"], fanout, levels)
    out = out.select("doc_id", F.col("h").alias("leaf"), "subroot", "root", proof_digest(F.col("path")).alias("proof_sha256"),
                     fold(F.col("path"), F.coalesce("tampered", "h")).alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))
