"""Shards from a weighted tree of hashes: region, then rack, then shard.

On each level a row draws one number for each child from a hash of its key and the child's name,
and takes the child with the least draw, where a child's draws are exponential with its weight as
rate. So a child gets its share of the weight, and when a weight changes, rows only move into or
out of the children whose weights changed. New capacity opens a region of its own: all other
weights stay, and it takes rows only into itself.

Draws use md5 and double logarithms, so that SQL elsewhere can repeat them.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from clickloom.llm.common import dealt_by_range

REGION_RACKS, RACK_SHARDS = 2, 2


@dataclass(frozen=True)
class Leaf:
    shard: int
    region: int
    rack: int
    weight: float = 1.0


def even_tree(shards: int) -> list[Leaf]:
    """Racks of RACK_SHARDS shards and regions of REGION_RACKS racks."""
    return [
        Leaf(n, n // (RACK_SHARDS * REGION_RACKS), n // RACK_SHARDS) for n in range(shards)
    ]


def grown(tree: Sequence[Leaf], weight: float = 1.0) -> list[Leaf]:
    """One more shard, in a rack and a region of its own."""
    return [
        *tree,
        Leaf(
            max((leaf.shard for leaf in tree), default=-1) + 1,
            max((leaf.region for leaf in tree), default=-1) + 1,
            max((leaf.rack for leaf in tree), default=-1) + 1,
            weight,
        ),
    ]


def _draw(key: Column, name: str, weight: float) -> Column:
    """Exponential with the weight as rate, from 48 bits of a hash."""
    bits = F.conv(F.substring(F.md5(F.concat(F.lit(name + ":"), key)), 1, 12), 16, 10)
    share = (bits.cast("double") + F.lit(0.5)) / F.lit(float(1 << 48))
    return -F.ln(share) / F.lit(weight)


def _least(key: Column, children: dict[str, tuple[float, Column]]) -> Column:
    """What belongs to the child with the least draw."""
    if len(children) == 1:
        return next(iter(children.values()))[1]
    drawn = [
        F.struct(_draw(key, name, weight).alias("draw"), F.lit(name).alias("name"))
        for name, (weight, _) in children.items()
    ]
    least = F.least(*drawn)["name"]
    chosen = None
    for name, (_, value) in children.items():
        chosen = (
            F.when(least == name, value) if chosen is None else chosen.when(least == name, value)
        )
    return chosen


def shard_of(key: Column, tree: Sequence[Leaf]) -> Column:
    """The shard of a key (text), descending the tree. Equal keys get the same shard."""
    regions: dict[int, dict[int, list[Leaf]]] = defaultdict(lambda: defaultdict(list))
    for leaf in tree:
        regions[leaf.region][leaf.rack].append(leaf)

    def weight(leaves: list[Leaf]) -> float:
        return sum(leaf.weight for leaf in leaves)

    def in_rack(leaves: list[Leaf]) -> Column:
        return _least(
            key, {f"shard {leaf.shard}": (leaf.weight, F.lit(leaf.shard)) for leaf in leaves}
        )

    def in_region(racks: dict[int, list[Leaf]]) -> Column:
        return _least(
            key,
            {f"rack {rack}": (weight(leaves), in_rack(leaves)) for rack, leaves in racks.items()},
        )

    return _least(
        key,
        {
            f"region {region}": (sum(map(weight, racks.values())), in_region(racks))
            for region, racks in regions.items()
        },
    )


def shard_documents(
    docs: DataFrame, tree: Sequence[Leaf], larger: Sequence[Leaf]
) -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard`` for each row.

    The law is ``key``: the id and the tree decide, so equal ids share a shard, and ids are spread
    whatever their texts. ``slot`` numbers a shard's rows without gaps from 0, in the order of id
    (null first), checksum and size. ``grown_shard`` is the shard in the larger tree. A null text
    has size 1 and the checksum of an empty one; a null id is the key ``null``. Repeated rows
    have slots of their own; other columns are ignored; no rows give none.

    Slots take no task that sees a whole shard: rows are dealt by range in that order, however far
    apart the ids are, and numbered in their range; a shard's first slot of a range is the sum of
    its rows in the ranges before.
    """
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(
        "doc_id",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.monotonically_increasing_id().alias("row"),
    )
    order = ("doc_id", "text_crc32", "size", "row")
    placed = dealt_by_range(rows, "slots", *order).select(
        "*",
        shard_of(key, tree).cast("int").alias("shard"),
        shard_of(key, larger).cast("int").alias("grown_shard"),
    )
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        placed.groupBy("shard", "part")
        .agg(F.count(F.lit(1)).alias("n"))
        .select("shard", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    )
    place = F.row_number().over(Window.partitionBy("shard", "part").orderBy(*order))
    return (
        placed.withColumn("place", place)
        .join(starts, ["shard", "part"])
        .select(
            "doc_id",
            "size",
            "text_crc32",
            F.lit("key").alias("law"),
            "shard",
            (F.col("start") + F.col("place") - 1).alias("slot"),
            "grown_shard",
        )
    )
