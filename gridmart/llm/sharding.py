"""Rows into shards by a tree of weighted hash draws. DataFrame functions only."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridmart.llm.common import on_keys, whole

# Rows that one task numbers at a time.
SLOT_BLOCK = 65536


@dataclass(frozen=True)
class Node:
    """A region, rack or shard. A leaf has a shard number; weights add up along the tree."""

    name: str
    children: list[Node] = field(default_factory=list)
    shard: int | None = None
    share: float = 1.0

    @property
    def weight(self) -> float:
        return sum(child.weight for child in self.children) if self.children else self.share


def tree(regions: list[list[list[float]]]) -> Node:
    """A tree from the shard weights by region and rack; shards are numbered in order.

    Nodes are named by their place, so adding a region, rack or shard at the end of its
    level leaves all other draws as they are.
    """
    number = iter(range(sum(len(rack) for racks in regions for rack in racks)))
    return Node(
        "root",
        [
            Node(
                f"r{i}",
                [
                    Node(
                        f"r{i}/k{j}",
                        [
                            Node(f"r{i}/k{j}/s{k}", shard=next(number), share=float(share))
                            for k, share in enumerate(rack)
                        ],
                    )
                    for j, rack in enumerate(racks)
                ],
            )
            for i, racks in enumerate(regions)
        ],
    )


def even_tree(shards: int) -> Node:
    """``shards`` equal shards: regions of two racks of two, what remains in one more region.

    With one more shard the earlier regions keep their shape if the count divides by four:
    the new shard then stands in a region of its own, and rows move into it alone.
    """
    full, rest = divmod(shards, 4)
    regions = [[[1.0, 1.0], [1.0, 1.0]] for _ in range(full)]
    if rest:
        regions.append([[1.0, 1.0][: min(rest, 2)], *([[1.0]] if rest == 3 else [])])
    return tree(regions)


def _draw(key: Column, node: Node) -> Column:
    """An exponential draw at the rate of the node's weight; the smallest wins its level.

    The chance to be the smallest of its level is the weight's share. A draw depends on
    the key, the node's name and its own weight only, so a changed weight moves rows
    only into or out of that node.
    """
    bits = F.shiftrightunsigned(F.xxhash64(key, F.lit(node.name)), 11)
    uniform = (bits.cast("double") + F.lit(0.5)) / F.lit(float(1 << 53))
    return -F.log(uniform) / F.lit(node.weight)


def place(key: Column, node: Node) -> Column:
    """The shard of a key: one draw for each child, level by level."""
    if node.shard is not None:
        return F.lit(node.shard)
    live = [child for child in node.children if child.weight > 0]
    if not live:
        raise ValueError(f"{node.name} has no weight")
    if len(live) == 1:
        return place(key, live[0])
    best = F.array_min(
        F.array(*[F.struct(_draw(key, child), F.lit(i)) for i, child in enumerate(live)])
    )["col2"]
    picked = F.when(best == 0, place(key, live[0]))
    for i, child in enumerate(live[1:-1], 1):
        picked = picked.when(best == i, place(key, child))
    return picked.otherwise(place(key, live[-1]))


def shard(
    docs: DataFrame, now: Node, grown: Node | None = None, block: int = SLOT_BLOCK
) -> DataFrame:
    """The shard of every document, and its gapless slot in the shard.

    Returns doc_id, size (UTF-8 bytes of the text plus 1; null: 1), text_crc32 (null: that
    of the empty text), law ``key``, shard, slot and grown_shard (the shard under the tree
    ``grown``, null without one). The place depends on doc_id and the tree alone: a null
    doc_id is a key like any other, equal ids share a shard, other columns are not read.
    Slots run from 0 within a shard, in the order of hashed blocks of ids and of doc_id,
    size and checksum within a block; repeated rows get slots of their own. An empty
    table gives an empty result.

    Blocks are counted first (a few numbers each), so no task numbers a whole shard.
    Rows that share one doc_id are dealt to blocks by a hash of the text too, so even a
    hot or null id does not fill a block.
    """
    key = F.col("doc_id")
    rows = docs.select("doc_id", "text").select(
        "doc_id",
        (F.octet_length(whole("text")).cast("long") + 1).alias("size"),
        F.crc32(F.encode(whole("text"), "UTF-8")).alias("text_crc32"),
        F.lit("key").alias("law"),
        place(key, now).cast("int").alias("shard"),
        (place(key, grown) if grown else F.lit(None)).cast("int").alias("grown_shard"),
    )
    count = docs.count()
    blocks = max(1, -(-count // block))
    rows = rows.withColumn("block", F.pmod(F.xxhash64("doc_id", "text_crc32"), F.lit(blocks)))
    sizes = rows.groupBy("shard", "block").agg(F.count("*").alias("rows"))
    # A row per shard and block: a table of counts, not of rows.
    before = Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(
        "shard", "block", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("start")
    )
    within = Window.partitionBy("shard", "block").orderBy("doc_id", "size", "text_crc32")
    numbered = rows.withColumn("place", F.row_number().over(within) - 1)
    return (
        numbered.alias("n")
        .join(starts.alias("s"), on_keys("n", "s", ["shard", "block"]))
        .select(
            "n.doc_id",
            "n.size",
            "n.text_crc32",
            "n.law",
            "n.shard",
            (F.col("s.start") + F.col("n.place")).cast("long").alias("slot"),
            "n.grown_shard",
        )
    )
