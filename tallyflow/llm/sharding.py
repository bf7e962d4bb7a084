"""Sharding by a hierarchical weighted hash tree.

A row descends from region to rack to shard.  On each level every child draws a
number from the row's key and its own name, scaled by its weight, and the least
wins: an exponential race, which child i wins with probability weight i / sum.
The draws of a child depend on nothing else, so a changed weight moves rows only
into or out of the subtree whose weight changed.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common


class Leaf(NamedTuple):
    region: str
    rack: str
    shard: int
    weight: float = 1.0


def even_tree(regions: int, racks: int, shards: int) -> list[Leaf]:
    """A tree of equal weights, with shards numbered from 0."""
    spots = [(r, k) for r in range(regions) for k in range(racks) for _ in range(shards)]
    return [Leaf(f"region{r}", f"rack{k}", i) for i, (r, k) in enumerate(spots)]


def with_region(tree: Sequence[Leaf], shard: int, weight: float = 1.0) -> list[Leaf]:
    """One more shard as a region of its own: no old subtree changes weight, so rows only move into the new shard."""
    return [*tree, Leaf(f"region-of-{shard}", "rack0", shard, weight)]


def _draw(key: Column, name: Column, weight: Column, seed: int) -> Column:
    """Minus the logarithm of a uniform number in (0, 1), over the weight."""
    bits = F.shiftrightunsigned(F.xxhash64(F.lit(seed), key, name), 11)
    return -F.log((bits.cast("double") + 0.5) / F.lit(float(1 << 53))) / weight


def shard_of(key: Column, tree: Sequence[Leaf], seed: int = 0) -> Column:
    """The shard of a key; a null key is a key like any other."""
    if not tree or any(leaf.weight <= 0 for leaf in tree):
        raise ValueError("a tree needs shards, each with a weight above 0")
    children: dict[str, dict[str, float]] = {}
    shards: dict[str, int] = {}
    for leaf in tree:
        region, rack = f"/{leaf.region}", f"/{leaf.region}/{leaf.rack}"
        name = f"{rack}/{leaf.shard}"
        shards[name] = leaf.shard
        for parent, child in (("", region), (region, rack), (rack, name)):
            level = children.setdefault(parent, {})
            level[child] = level.get(child, 0.0) + leaf.weight
    if len(set(shards.values())) < len(tree):
        raise ValueError("every shard has one place in the tree")
    known = F.create_map(
        *[
            x
            for parent, level in children.items()
            for x in (
                F.lit(parent),
                F.array(*[F.struct(F.lit(n).alias("name"), F.lit(float(w)).alias("weight")) for n, w in level.items()]),
            )
        ]
    )

    def descend(at: Column) -> Column:
        draws = F.transform(known[at], lambda c: F.struct(_draw(key, c["name"], c["weight"], seed), c["name"].alias("name")))
        return F.array_min(draws)["name"]

    leaf = descend(descend(descend(F.lit(""))))
    return F.create_map(*[x for name, shard in shards.items() for x in (F.lit(name), F.lit(shard))])[leaf]


def assign(
    docs: DataFrame,
    tree: Sequence[Leaf],
    grown: Sequence[Leaf],
    id_col: str = "doc_id",
    text_col: str = "text",
    seed: int = 0,
) -> DataFrame:
    """`id`, `size`, `text_crc32`, `shard`, `grown_shard` and `slot` for every row.

    The id alone decides the shard, so rows with one id (also a missing one) lie
    together.  `size` is the text's UTF-8 bytes plus 1 and a null text is empty.
    `slot` numbers a shard's rows from 0 in an order hashed from the id, so that
    a shard read by slots is shuffled.  An empty table gives no rows.
    """
    text = common.text_or_empty(text_col)
    key = F.col(id_col).cast("long")
    rows = docs.select(
        key.alias("id"),
        (F.octet_length(text).cast("long") + 1).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    )
    rows = rows.select(
        "*",
        shard_of(F.col("id"), tree, seed).alias("shard"),
        shard_of(F.col("id"), grown, seed).alias("grown_shard"),
        F.xxhash64(F.lit(seed + 1), "id").alias("_order"),
    )
    # Stored first: dealing out by range looks at its input twice.
    rows = common.stored(rows, "shards")
    return common.dense_positions(rows, ["shard"], ["_order", "id", "text_crc32"], "slot").drop("_order")
