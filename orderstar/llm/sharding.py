"""Consistent-hash ring with virtual nodes and bounded loads.

Every shard owns many arcs of a ring of hashes. A row belongs to the arc its key falls in. No shard
may hold more than its share of rows: rows that overflow a full shard continue clockwise to the next
arcs whose shard has room. Capacities are the row count shared out evenly, so counts differ by at
most one; a change of the number of shards moves the rows of the new arcs and the overflow only.

The ring itself is small (shards x virtual nodes), so who overflows where is settled on counts per
arc. Rows are ranked along the ring by one range-partitioned sort and never gathered.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.keys import with_dense_key
from .common import importable

VIRTUAL_NODES = 512  # per shard
LAW = "rows"


@dataclass(frozen=True)
class Arc:
    """Positions above the previous arc's end, up to ``end``, owned by ``shard``."""

    end: int
    shard: int


def ring(shards: int, virtual_nodes: int = VIRTUAL_NODES) -> list[Arc]:
    """Arcs in clockwise order. Adding a shard only adds arcs."""
    points = {}
    for shard in range(shards):
        for node in range(virtual_nodes):
            digest = hashlib.blake2b(f"{shard}/{node}".encode(), digest_size=8).digest()
            points.setdefault(int.from_bytes(digest, "big", signed=True), shard)
    return [Arc(end, shard) for end, shard in sorted(points.items())]


def capacities(rows: int, shards: int) -> list[int]:
    return [rows // shards + (shard < rows % shards) for shard in range(shards)]


def settle(counts: list[int], arcs: list[Arc], room: list[int]) -> list[tuple[int, int, int, int]]:
    """Which rows of each arc go to which shard: (arc, first rank, shard, first slot) in ring order.

    A shard first takes rows of its own arcs, clockwise, until it is full. Then the overflow of each
    arc, clockwise, goes on to the next arcs whose shard has room.
    """
    room, taken, found, over = list(room), [0] * len(room), [], []

    def take(arc: int, first: int, wanted: int, shard: int) -> int:
        size = min(wanted, room[shard])
        if size:
            found.append((arc, first, shard, taken[shard]))
            room[shard] -= size
            taken[shard] += size
        return size

    for arc, (size, owner) in enumerate(zip(counts, arcs)):
        own = take(arc, 0, size, owner.shard)
        if own < size:
            over.append((arc, own, size - own))
    for arc, first, size in over:
        at = arc
        while size:
            at = (at + 1) % len(arcs)
            moved = take(arc, first, size, arcs[at].shard)
            first, size = first + moved, size - moved
    return sorted(found)


def shard_rows(
    rows: DataFrame,
    key: Column,
    order: list[str],
    shards: int,
    virtual_nodes: int = VIRTUAL_NODES,
) -> DataFrame:
    """Add shard and slot (gapless from 0 in each shard) to every row; counts differ by at most one.

    ``key`` places a row on the ring, ``order`` names columns that order rows of one key; rows equal
    in all of them are interchangeable. Equal keys stay together unless they overflow. NULL keys
    share one place. Columns named shard or slot are replaced; an empty table gives no rows.
    """
    if shards < 1 or virtual_nodes < 1:
        raise ValueError("shards and virtual_nodes must be positive")
    importable(rows.sparkSession)
    arcs = ring(shards, virtual_nodes)
    kept = [c for c in rows.columns if c not in ("shard", "slot")]
    by = {c: f"_by_{i}" for i, c in enumerate(order)}
    # The given columns go out of the way of those that are added here; the last column only lets equal
    # rows lie in several range partitions.
    placed = rows.select(
        F.struct(*kept).alias("row"),
        F.xxhash64(key).alias("_place"),
        *(F.col(c).alias(name) for c, name in by.items()),
        F.monotonically_increasing_id().alias("_tie"),
    )
    ranked = with_dense_key(placed, "_rank", ["_place", *by.values(), "_tie"])

    ends = np.array([arc.end for arc in arcs])

    @F.pandas_udf("int")
    def arc_of(place: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(ends, place.to_numpy()) % len(ends))

    counts = [0] * len(arcs)
    wrapped = 0  # rows past the last arc's end belong to the first arc but rank last
    for row in (
        ranked.groupBy(arc_of("_place").alias("arc"), (F.col("_place") > arcs[-1].end).alias("past"))
        .count()
        .collect()  # one row per arc, and one more
    ):
        counts[row["arc"]] += row["count"]
        wrapped = row["count"] if row["past"] else wrapped

    total = sum(counts)
    starts = np.concatenate(([0], np.cumsum(counts)))
    pieces = settle(counts, arcs, capacities(total, shards))
    first = np.array([starts[arc] + at for arc, at, _, _ in pieces], dtype=np.int64)
    owner = np.array([shard for _, _, shard, _ in pieces], dtype=np.int64)
    slot = np.array([at for _, _, _, at in pieces], dtype=np.int64)

    @F.pandas_udf("shard int, slot long")
    def assigned(rank: pd.Series) -> pd.DataFrame:
        # Clockwise position: the wrapped rows come first.
        position = (rank.to_numpy() - 1 + wrapped) % max(1, total)
        piece = np.searchsorted(first, position, side="right") - 1
        return pd.DataFrame({"shard": owner[piece], "slot": slot[piece] + position - first[piece]})

    return ranked.withColumn("_to", assigned("_rank")).select("row.*", "_to.shard", "_to.slot")
