"""Conversation prefix trie by fixed-length block hashing.

Conversations are cut into blocks of a few turns. The identity of a prefix is the sum of the digests of
its blocks, each bound to its place, so it adds up over range partitions and a conversation of any
length may lie in several. Conversations are grouped by the prefixes that end with a block: every
distinct (prefix, next block) is one edge. Where a prefix has a single next block, the turns inside
that block are a chain and need no comparison; where several follow, their turns are compared one by
one. That happens on distinct blocks, never on conversations.

Nothing walks down or up the trie. A conversation owns the nodes of which it is the smallest member,
which are the last of its path. Sums over a subtree follow from sums over the members of its top: of
the bytes a member does not own, and of the leaves it owns.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import reduce

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.keys import with_dense_key
from ..session import checkpointed
from .common import importable

BLOCK_TURNS = 4
CHUNK = 4096  # members of a list that are joined at a time

# A prefix is known by two numbers of 60 bits; sums of two of them still fit a signed long.
_LANE = (1 << 60) - 1
_DIGEST = 16
NODE = ["hi", "lo"]
_EDGE = ["edge_hi", "edge_lo"]
_UP = ["up_hi", "up_lo"]


def _lanes(block: int, turns: bytes) -> tuple[int, int]:
    """Identity of the turns of a block up to some turn, bound to the block's place."""
    digest = hashlib.sha256(struct.pack("<q", block) + turns).digest()
    hi, lo = struct.unpack_from("<QQ", digest)
    return hi & _LANE, lo & _LANE


def _plus(a: Column, b: Column) -> Column:
    return (a + b).bitwiseAND(F.lit(_LANE))


def _long(*names: str) -> list[T.StructField]:
    return [T.StructField(name, T.LongType()) for name in names]


def ordered(
    turns: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> tuple[DataFrame, DataFrame]:
    """Turns as (conv, rank, digest, size), and conversations as (conv, first, n).

    ``rank`` runs over all turns in the order of conversation and turn (NULL first; turns that share a
    number by their digest), so that a turn's place is its rank less ``first``. ``size`` is the UTF-8
    length of the text. A NULL role or text is empty; rows without a key belong to no conversation.
    """
    said, by = F.coalesce(text, F.lit("")), F.coalesce(role, F.lit(""))
    spelled = F.concat(F.octet_length(by).cast("string"), F.lit(":"), by, said).cast("binary")
    rows = turns.filter(F.col(key).isNotNull()).select(
        F.col(key).alias("conv"),
        F.col(turn).alias("turn"),
        F.substring(F.unhex(F.sha2(spelled, 256)), 1, _DIGEST).alias("digest"),
        F.octet_length(said).cast("long").alias("size"),
        # Lets equal rows lie in several range partitions.
        F.monotonically_increasing_id().alias("tie"),
    )
    # Stored first: a range sort reads its input twice, and this is where the texts are read.
    ranked = with_dense_key(checkpointed(rows), "rank", ["conv", "turn", "digest", "tie"])
    ranked = ranked.drop("turn", "tie")
    spans = ranked.groupBy("conv").agg(F.min("rank").alias("first"), F.count("*").alias("n"))
    # Stored, so that joins with it are plain shuffles and AQE can split a long conversation.
    return ranked, checkpointed(spans)


def placed(ranked: DataFrame, spans: DataFrame) -> DataFrame:
    """(conv, at, digest, size): the turns of ``ordered`` with their place from 0."""
    return ranked.join(spans, "conv").select(
        "conv", (F.col("rank") - F.col("first")).alias("at"), "digest", "size"
    )


def branched(
    ranked: DataFrame, spans: DataFrame, of: Column, turns: Column, most: int
) -> DataFrame:
    """Conversations whose first ``turns`` turns are those of conversation ``of``, as ``placed``.

    Both columns are functions of ``conv``; ``turns`` is at most ``most``. Where that conversation is
    shorter all its turns are taken, where there is none no turn; a conversation's own turns after its
    first ``turns`` follow.
    """
    plan = spans.select("conv", of.alias("of"), turns.alias("taken"))
    lengths = spans.select(F.col("conv").alias("of"), F.col("n").alias("there"))
    plan = checkpointed(
        plan.join(lengths, "of", "left").select(
            "conv", "of", "taken", F.least("taken", F.coalesce("there", F.lit(0))).alias("head")
        )
    )
    sources = placed(ranked, spans).filter(F.col("at") < most).withColumnRenamed("conv", "of")
    heads = sources.join(plan, "of").filter(F.col("at") < F.col("head"))
    tails = placed(ranked, spans).join(plan, "conv").filter(F.col("at") >= F.col("taken"))
    tails = tails.withColumn("at", F.col("at") - F.col("taken") + F.col("head"))
    columns = ["conv", "at", "digest", "size"]
    return heads.select(*columns).unionByName(tails.select(*columns))


def _blocks(rows: DataFrame, block_turns: int) -> DataFrame:
    """One row per block of a conversation: (conv, block, up, edge, before, digests, sizes, size).

    ``up`` and ``edge`` are the prefixes before and after the block, ``before`` the bytes before it.
    """
    schema = T.StructType(
        [
            *_long("part"),
            T.StructField("conv", rows.schema["conv"].dataType),
            T.StructField("lead", T.BooleanType()),
            *_long("block", *_UP, "before", "own_hi", "own_lo"),
            T.StructField("digests", T.BinaryType()),
            T.StructField("sizes", T.ArrayType(T.LongType())),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        conv, lead, hi, lo, before = None, True, 0, 0, 0  # of the conversation so far
        open_block: list = []  # conv, block, digests, sizes

        def closed() -> dict:
            nonlocal conv, lead, hi, lo, before
            key, block, digests, sizes = open_block
            if key != conv:
                lead = conv is None
                conv, hi, lo, before = key, 0, 0, 0
            turns = b"".join(digests)
            own = _lanes(block, turns)
            row = (part, key, lead, block, hi, lo, before, *own, turns, sizes)
            hi, lo, before = (hi + own[0]) & _LANE, (lo + own[1]) & _LANE, before + sum(sizes)
            return dict(zip(schema.names, row))

        for batch in batches:
            done = []
            for key, block, digest, size in zip(*(c.to_pylist() for c in batch.columns)):
                if open_block[:2] != [key, block]:
                    if open_block:
                        done.append(closed())
                    open_block = [key, block, [], []]
                open_block[2].append(digest)
                open_block[3].append(size)
            yield pa.RecordBatch.from_pylist(done, arrow_schema)
        if open_block:
            yield pa.RecordBatch.from_pylist([closed()], arrow_schema)

    arrow_schema = _arrow(schema)
    block = F.floor(F.col("at") / block_turns).cast("long").alias("block")
    turns = checkpointed(rows.select("conv", block, "at", "digest", "size"))
    spread = turns.repartitionByRange("conv", "block")
    local = spread.sortWithinPartitions("conv", "block", "at").drop("at").mapInArrow(run, schema)
    return _carried(checkpointed(local))


def _arrow(schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def _carried(local: DataFrame) -> DataFrame:
    """Add to the first conversation of a partition what partitions before hold of it."""
    sums = [
        _plus(F.col("up_hi"), F.col("own_hi")).alias("hi"),
        _plus(F.col("up_lo"), F.col("own_lo")).alias("lo"),
        (F.col("before") + _total("sizes")).alias("before"),
    ]
    last = F.max_by(F.struct("conv", "lead", *sums), F.struct("conv", "block")).alias("last")
    # One row per partition.
    ends = local.groupBy("part").agg(F.min("conv").alias("conv"), last).orderBy("part").collect()
    offsets, conv, carry = [], None, (0, 0, 0)
    for row in ends:
        if row["conv"] != conv:
            carry = (0, 0, 0)
        elif any(carry):
            offsets.append((row["part"], *carry))
        conv, lead, hi, lo, before = row["last"]
        if not lead:
            carry = (0, 0, 0)
        carry = ((hi + carry[0]) & _LANE, (lo + carry[1]) & _LANE, before + carry[2])
    names = ["part", "add_hi", "add_lo", "add_before"]
    added = local.sparkSession.createDataFrame(offsets, T.StructType(_long(*names)))
    joined = local.join(F.broadcast(added), "part", "left")

    def shifted(name: str, more: str) -> Column:
        return F.col(name) + F.when(F.col("lead"), F.coalesce(more, F.lit(0))).otherwise(0)

    with_up = joined.select(
        "conv",
        "block",
        shifted("up_hi", "add_hi").bitwiseAND(F.lit(_LANE)).alias("up_hi"),
        shifted("up_lo", "add_lo").bitwiseAND(F.lit(_LANE)).alias("up_lo"),
        shifted("before", "add_before").alias("before"),
        "own_hi",
        "own_lo",
        "digests",
        "sizes",
    )
    return with_up.select(
        *(c for c in with_up.columns if not c.startswith("own_")),
        _plus(F.col("up_hi"), F.col("own_hi")).alias("edge_hi"),
        _plus(F.col("up_lo"), F.col("own_lo")).alias("edge_lo"),
    )


def _total(sizes: str) -> Column:
    return F.aggregate(sizes, F.lit(0).cast("long"), lambda a, b: a + b)


def _turns(edges: DataFrame, block_turns: int) -> DataFrame:
    """The nodes along each edge: one row per turn of the block, with the edge's members."""
    schema = T.StructType(
        [
            *_long(*_EDGE),
            T.StructField("apart", T.BooleanType()),
            *_long("depth", *NODE, *_UP, "before", "size", "n"),
            T.StructField("conv", edges.schema["conv"].dataType),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for e in batch.to_pylist():
                up, before = (e["up_hi"], e["up_lo"]), e["before"]
                for i, size in enumerate(e["sizes"], 1):
                    own = _lanes(e["block"], e["digests"][: i * _DIGEST])
                    node = (e["up_hi"] + own[0]) & _LANE, (e["up_lo"] + own[1]) & _LANE
                    depth = e["block"] * block_turns + i
                    head = (e["edge_hi"], e["edge_lo"], e["apart"], depth)
                    row = (*head, *node, *up, before, size, e["n"], e["conv"])
                    found.append(dict(zip(schema.names, row)))
                    up, before = node, before + size
            yield pa.RecordBatch.from_pylist(found, arrow_schema)

    arrow_schema = _arrow(schema)
    return edges.mapInArrow(run, schema)


@dataclass(frozen=True)
class Trie:
    """``nodes`` and which conversation ends where.

    ``nodes``: hi, lo (identity, both 0 for the root), up_hi, up_lo (of the parent), depth, conv (the
    smallest member), up_conv (the parent's), n_convs, n_children, n_leaves, saved. ``ends``: conv, hi,
    lo of its last node.
    """

    nodes: DataFrame
    ends: DataFrame


def trie(rows: DataFrame, keys: DataFrame, block_turns: int = BLOCK_TURNS) -> Trie:
    """The trie of conversations given as (conv, at, digest, size), places counted from 0.

    ``keys`` has every conversation once as conv, those without turns included; they end at the root.
    No conversation gives no node. ``saved`` sums, over the nodes of the subtree, the bytes of the
    node's turn for every member but one.
    """
    importable(rows.sparkSession)
    blocks = _blocks(rows, block_turns)
    alike = ["block", "up_hi", "up_lo", "before", "digests", "sizes"]
    edges = checkpointed(
        blocks.groupBy(*_EDGE).agg(
            F.count("*").alias("n"),
            F.min("conv").alias("conv"),
            *(F.first(c).alias(c) for c in alike),  # the same for all members of an edge
        )
    )
    # Prefixes with several next blocks: there, and only there, turns of different edges may be equal.
    several = edges.groupBy(*_UP).agg(F.count("*").alias("edges")).filter("edges > 1")
    several = checkpointed(several.select(*_UP, F.lit(True).alias("apart")))
    marked = edges.join(several, _UP, "left").withColumn(
        "apart", F.coalesce("apart", F.lit(False))
    )
    along = checkpointed(_turns(marked, block_turns))
    found = ["depth", *NODE, *_UP, "before", "size", "n", "conv"]
    chained = along.filter("NOT apart").select(*found)
    compared = (
        along.filter("apart")
        .groupBy(*NODE)
        .agg(
            *(F.first(c).alias(c) for c in ("depth", *_UP, "before", "size")),
            F.sum("n").alias("n"),
            F.min("conv").alias("conv"),
        )
    )
    nodes = checkpointed(chained.unionByName(compared.select(*found)))
    zero = F.lit(0).cast("long")
    root = keys.agg(F.count("*").alias("n"), F.min("conv").alias("conv")).filter("n > 0")
    root = root.select(
        *(zero.alias(c) for c in ("depth", *NODE, "before", "size")), "n", "conv"
    )
    children = nodes.select(*(F.col(u).alias(c) for u, c in zip(_UP, NODE)), F.lit(1).alias("child"))
    tree = checkpointed(
        _united([nodes, root, children])
        .groupBy(*NODE)
        .agg(
            *(F.max(c).alias(c) for c in ("depth", *_UP, "before", "size", "n", "conv")),
            F.coalesce(F.sum("child"), zero).alias("n_children"),
        )
    )
    own = (
        tree.filter("depth > 0")
        .groupBy("conv")
        .agg(F.sum("size").alias("own"), F.count_if(F.col("n_children") == 0).alias("leaves"))
    )
    last = F.max(F.struct("block", *_EDGE, (F.col("before") + _total("sizes")).alias("total")))
    paths = blocks.groupBy("conv").agg(last.alias("last"))
    values = checkpointed(
        keys.join(paths, "conv", "left")
        .join(own, "conv", "left")
        .select(
            "conv",
            *(F.coalesce(f"last.{e}", zero).alias(c) for e, c in zip(_EDGE, NODE)),
            (F.coalesce("last.total", zero) - F.coalesce("own", zero)).alias("shared"),
            F.coalesce("leaves", zero).alias("leaves"),
        )
    )
    least = F.min(F.struct("conv", "shared")).alias("least")
    sums = [F.sum("shared").alias("shared"), F.sum("leaves").alias("leaves"), least]
    per_edge = (
        blocks.select("conv", *_EDGE)
        .join(values.select("conv", "shared", "leaves"), "conv")
        .groupBy(*_EDGE)
        .agg(*sums)
    )
    per_node = along.select(*_EDGE, *NODE).join(per_edge, _EDGE).drop(*_EDGE)
    at_root = values.agg(*sums).select(*(zero.alias(c) for c in NODE), "shared", "leaves", "least")
    parents = tree.select(
        *(F.col(c).alias(u) for u, c in zip(_UP, NODE)), F.col("conv").alias("up_conv")
    )
    known = tree.join(parents, _UP, "left").drop("size")
    all_known = (
        _united([known, per_node, at_root])
        .groupBy(*NODE)
        .agg(
            *(F.max(c).alias(c) for c in ("depth", *_UP, "conv", "up_conv", "before", "n", "n_children")),
            *(F.sum(c).alias(c) for c in ("shared", "leaves")),
            F.min("least").alias("least"),
        )
        .filter("n IS NOT NULL")
    )
    saved = F.col("shared") - F.col("least.shared") - (F.col("n") - 1) * F.col("before")
    return Trie(
        all_known.select(
            *NODE,
            *_UP,
            "depth",
            "conv",
            "up_conv",
            F.col("n").alias("n_convs"),
            "n_children",
            F.greatest("leaves", F.lit(1)).cast("long").alias("n_leaves"),
            saved.alias("saved"),
        ),
        values.select("conv", *NODE),
    )


def _united(frames: Iterable[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def digests_of_ends(ends: DataFrame) -> DataFrame:
    """(hi, lo, ends_sha256): the keys that end at a node in ascending order, joined by commas.

    A list is spread over range partitions, joined there in chunks, and digested chunk by chunk: the
    memory this takes does not depend on how many conversations end alike.
    """
    importable(ends.sparkSession)
    kind = ends.schema["conv"].dataType
    chunked = T.StructType([*_long(*NODE), T.StructField("first", kind), T.StructField("ids", T.StringType())])
    digested = T.StructType([*_long(*NODE), T.StructField("ends_sha256", T.StringType())])
    chunk_schema, digest_schema = _arrow(chunked), _arrow(digested)

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, ids = None, []
        for batch in batches:
            done = []
            for hi, lo, conv in zip(*(c.to_pylist() for c in batch.columns)):
                if ids and (node != (hi, lo) or len(ids) == CHUNK):
                    done.append((*node, ids[0], ",".join(map(str, ids))))
                    ids = []
                node = hi, lo
                ids.append(conv)
            yield _batch(done, chunk_schema)
        if ids:
            yield _batch([(*node, ids[0], ",".join(map(str, ids)))], chunk_schema)

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, state = None, None
        for batch in batches:
            done = []
            for hi, lo, ids in zip(*(c.to_pylist() for c in batch.columns)):
                if node != (hi, lo):
                    if node:
                        done.append((*node, state.hexdigest()))
                    node, state = (hi, lo), hashlib.sha256()
                else:
                    state.update(b",")
                state.update(ids.encode())
            yield _batch(done, digest_schema)
        if node:
            yield _batch([(*node, state.hexdigest())], digest_schema)

    order = [*NODE, "conv"]
    spread = ends.select(*order).repartitionByRange(*order).sortWithinPartitions(*order)
    chunks = spread.mapInArrow(joined, chunked)
    together = chunks.repartition(*NODE).sortWithinPartitions(*NODE, "first").drop("first")
    return together.mapInArrow(digest, digested)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [()] * len(schema)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema
    )


def conversation_trie(
    turns: DataFrame,
    key: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    block_turns: int = BLOCK_TURNS,
) -> Trie:
    """The trie of the conversations in a table of turns, see ``ordered`` and ``trie``.

    Other columns may have any name. Equal conversations are members of the same nodes; a very long one
    is spread over partitions by block.
    """
    ranked, spans = ordered(turns, key, turn, role, text)
    return trie(placed(ranked, spans), spans.select("conv"), block_turns)
