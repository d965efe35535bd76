"""Shards by a hash tree: weighted hash draws pick a region, a rack in it and a shard in that."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from telemetry_lake.llm.positions import numbered


@dataclass(frozen=True)
class Shard:
    """A leaf of the tree; a shard draws in proportion to its weight."""

    number: int
    region: int
    rack: int
    weight: float = 1.0


def tree(shards: int, base: int = 24, per_rack: int = 4, racks: int = 3) -> list[Shard]:
    """The first ``base`` shards in full racks and regions; each later one opens a region of its own.

    A new region changes no other weight, so one more shard beyond the base takes rows from all and moves none
    between the others.
    """
    leaves = []
    for number in range(min(shards, base)):
        rack = number // per_rack
        leaves.append(Shard(number, rack // racks, rack % racks))
    regions = -(-base // (per_rack * racks))
    return leaves + [Shard(n, regions + n - base, 0) for n in range(base, shards)]


def _draw(key: Column, level: str, nodes: dict[int, tuple[float, Column]]) -> Column:
    """The result of the node with the least draw: -ln(u) / weight, u from a hash of key, level and node.

    The least of such draws falls on a node in proportion to its weight, and a changed weight moves keys only to the
    node that gained or from the node that lost.
    """
    draws = []
    for node, (weight, result) in sorted(nodes.items()):
        bits = F.shiftrightunsigned(F.xxhash64(key, F.lit(level), F.lit(node)), 11)
        u = (bits.cast("double") + F.lit(0.5)) / F.lit(float(1 << 53))
        draws.append(F.struct((-F.log(u) / F.lit(weight)).alias("draw"), F.lit(node).alias("node"), result.alias("to")))
    return draws[0]["to"] if len(draws) == 1 else F.array_min(F.array(*draws))["to"]


def descend(df: DataFrame, key: Column, leaves: Sequence[Shard], output: str) -> DataFrame:
    """Add the shard of a key, level by level: a row draws a region, then a rack among that region's, then a shard among
    that rack's, and no other subtree is drawn for it. Native columns; null keys have a shard as any other."""
    regions, racks, shards = {}, {}, {}
    for leaf in leaves:
        regions[leaf.region] = regions.get(leaf.region, 0.0) + leaf.weight
        inside = racks.setdefault(leaf.region, {})
        inside[leaf.rack] = inside.get(leaf.rack, 0.0) + leaf.weight
        shards.setdefault((leaf.region, leaf.rack), {})[leaf.number] = leaf.weight
    region, rack = F.col(f"{output}_region"), F.col(f"{output}_rack")
    # A column per level, so that the one above is drawn once and not again for every branch that asks for it.
    df = df.withColumn(f"{output}_region", _draw(key, "region", _nodes(regions)))
    to_rack = [(region == r, _draw(key, f"rack of {r}", _nodes(own))) for r, own in sorted(racks.items())]
    df = df.withColumn(f"{output}_rack", _first(to_rack))
    to_shard = [
        ((region == r) & (rack == k), _draw(key, f"shard of {r}.{k}", _nodes(own))) for (r, k), own in sorted(shards.items())
    ]
    return df.withColumn(output, _first(to_shard)).drop(f"{output}_region", f"{output}_rack")


def _nodes(weights: dict[int, float]) -> dict[int, tuple[float, Column]]:
    return {node: (weight, F.lit(node)) for node, weight in weights.items()}


def _first(cases: Sequence[tuple[Column, Column]]) -> Column:
    """The value of the case that holds; the last case needs no question."""
    value = cases[-1][1]
    for asked, result in reversed(cases[:-1]):
        value = F.when(asked, result).otherwise(value)
    return value


def assign_shards(docs: DataFrame, leaves: Sequence[Shard], grown: Sequence[Shard]) -> DataFrame:
    """Columns of ``docs`` with ``shard`` and ``grown_shard``, by ``doc_id`` and the tree alone (no shuffle).

    Columns of these names are replaced.
    """
    kept = [F.col(f"`{c}`") for c in docs.columns if c not in ("shard", "grown_shard")]
    mark = "_" * (1 + max((len(c) for c in docs.columns), default=0))
    placed = descend(docs.select(*kept), F.col("doc_id"), leaves, f"{mark}shard")
    placed = descend(placed, F.col("doc_id"), grown, f"{mark}grown")
    return placed.select(*kept, F.col(f"{mark}shard").alias("shard"), F.col(f"{mark}grown").alias("grown_shard"))


def shard_slots(docs: DataFrame, shards: int = 24) -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard`` of every row; law: ``key``.

    ``size`` is the text's UTF-8 bytes (a null text has none, and the checksum of no bytes, 0) plus 8. Equal ids share
    a shard. Slots are gapless from 0 in every shard. Texts are read for size and checksum and not shuffled.
    """
    narrow = docs.select(
        F.col("doc_id").cast("bigint"),
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 8).cast("bigint").alias("size"),
        F.coalesce(F.crc32(F.col("text").cast("binary")), F.lit(0)).cast("bigint").alias("text_crc32"),
    )
    placed = assign_shards(narrow, tree(shards), tree(shards + 1))
    slots = numbered(placed, "shard", ["doc_id", "text_crc32", "size"], "slot")
    return slots.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")
