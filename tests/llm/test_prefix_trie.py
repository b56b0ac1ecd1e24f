import hashlib
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderstar.llm import prefix_trie

from ..helpers import duck_content, spark_content
from .test_oracles import ORACLES, QUERIES

COLUMNS = ["conv_id", "turn", "role", "text"]
KINDS = [T.LongType(), T.LongType(), T.StringType(), T.StringType()]


def table(spark, rows, more=()):
    fields = [T.StructField(n, k) for n, k in zip(COLUMNS, KINDS)]
    fields += [T.StructField(n, T.StringType()) for n in more]
    return spark.createDataFrame([(*r, *["x"] * len(more)) for r in rows], T.StructType(fields))


def plainly(rows):
    """Nodes as (path, values), from all prefixes of all conversations."""
    said = defaultdict(list)
    for key, turn, role, text in rows:
        if key is not None:
            said[key].append((turn is not None, turn, role or "", text or ""))
    paths = {k: [t[2:] for t in sorted(v, key=lambda t: t[:2])] for k, v in said.items()}
    members = defaultdict(list)
    for key in sorted(paths):
        for d in range(len(paths[key]) + 1):
            members[tuple(paths[key][:d])].append(key)
    found = []
    for path, keys in members.items():
        below = [p for p in members if p[: len(path)] == path]
        inner = {p[:-1] for p in members if p}
        ended = ",".join(str(k) for k in keys if len(paths[k]) == len(path))
        found.append(
            (
                keys[0],
                len(path),
                members[path[:-1]][0] if path else None,
                len(keys),
                sum(len(p) == len(path) + 1 for p in below),
                sum(p not in inner for p in below),
                sum((len(members[p]) - 1) * len(p[-1][1].encode()) for p in below if p),
                hashlib.sha256(ended.encode()).hexdigest(),
            )
        )
    return sorted(found, key=str)


def nodes(found):
    digests = prefix_trie.digests_of_ends(found.ends)
    empty = hashlib.sha256(b"").hexdigest()
    rows = found.nodes.join(digests, prefix_trie.NODE, "left").select(
        "conv", "depth", "up_conv", "n_convs", "n_children", "n_leaves", "saved",
        F.coalesce("ends_sha256", F.lit(empty)),
    )
    return sorted((tuple(r) for r in rows.collect()), key=str)


def random_rows(seed, conversations, longest, words=2):
    draw = random.Random(seed)
    return [
        (key, turn if turn or draw.random() < 0.9 else None, draw.choice(["u", None]), draw.choice(["a", "bé", "", None][: words + 1]))
        for key in range(conversations)
        for turn in range(draw.randint(0, longest))
    ]


@pytest.mark.parametrize("block_turns", [1, 2, 4, 7])
def test_random_conversations(spark, block_turns):
    for seed, longest in ((1, 3), (2, 12)):
        rows = random_rows(seed, 40, longest)
        # First turns are numbered 0 or not at all, so no order is left open.
        found = prefix_trie.conversation_trie(table(spark, rows), block_turns=block_turns)
        assert nodes(found) == plainly(rows)


def test_long_conversations_over_partitions(spark):
    """Conversations longer than a partition share their beginning and end apart."""
    draw = random.Random(7)
    shared = [(t, "u", f"turn {draw.random()}") for t in range(400)]
    rows = [(k, *t) for k in (3, 5, 6) for t in shared[: 400 - k]]
    rows += [(5, 1000 + i, "v", "own") for i in range(30)]
    rows += [(9, *t) for t in shared[:9]] + [(1, 0, "v", "other")]
    spark.conf.set("spark.sql.shuffle.partitions", "23")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        trie = prefix_trie.conversation_trie(table(spark, rows))
        assert nodes(trie) == plainly(rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_sums_carried_over_partitions(spark):
    """The prefixes of a conversation are the same however its blocks lie in partitions."""
    rows = [(k, t, "u", f"{t}") for k in range(3) for t in range(200)]
    ranked, spans = prefix_trie.ordered(table(spark, rows))
    placed = prefix_trie.placed(ranked, spans)
    seen = []
    for parts in (1, 2, 9, 40):
        spark.conf.set("spark.sql.shuffle.partitions", str(parts))
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        blocks = prefix_trie._blocks(placed, 4).select("conv", "block", "edge_hi", "edge_lo", "before")
        seen.append(sorted(map(tuple, blocks.collect())))
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(seen[0]) == 150 and all(s == seen[0] for s in seen)
    by_block = defaultdict(set)
    for _, block, *edge in seen[0]:
        by_block[block].add(tuple(edge))
    assert all(len(edges) == 1 for edges in by_block.values())


def test_common_conversations(spark, monkeypatch):
    """Many equal conversations: one path, one list of members made of several chunks."""
    monkeypatch.setattr(prefix_trie, "CHUNK", 7)
    rows = [(k, t, "u", f"say {t}") for k in range(300) for t in range(6)]
    rows += [(1000 + k, t, "u", f"say {t * (t < 5)}") for k in range(50) for t in range(6)]
    trie = prefix_trie.conversation_trie(table(spark, rows))
    assert nodes(trie) == plainly(rows)
    assert trie.nodes.count() == 8


def test_only_blocks_with_siblings_are_compared(spark):
    """Turns of a block that nothing diverges from keep the numbers of their edge."""
    rows = [(k, t, "u", "same" if t < 8 else f"{k}") for k in range(9) for t in range(12)]
    ranked, spans = prefix_trie.ordered(table(spark, rows))
    blocks = prefix_trie._blocks(prefix_trie.placed(ranked, spans), 4)
    counts = blocks.groupBy("block").agg(F.count_distinct("edge_hi").alias("n")).orderBy("block")
    assert [r["n"] for r in counts.collect()] == [1, 1, 9]


def test_odd_rows_keys_and_names(spark):
    rows = [(1, None, None, None), (1, 0, "u", "x"), (None, 0, "u", "x"), (None, 1, "u", "x")]
    rows += [(2, None, "", ""), (2, 5, "u", "x"), (2, 5, "u", "x"), (-7, 1, "u", "long " * 50_000)]
    names = ["conv", "rank", "first", "n", "tie", "at", "digest", "size", "part", "hi", "lo", "block", "_at", "_row", "_part"]
    trie = prefix_trie.conversation_trie(table(spark, rows, names))
    assert nodes(trie) == plainly(rows)
    empty = table(spark, rows).filter("false")
    assert nodes(prefix_trie.conversation_trie(empty)) == []
    keyed = table(spark, rows).withColumn("conv_id", F.concat(F.lit("k"), F.abs("conv_id")))
    text = [(f"k{abs(r[0])}" if r[0] is not None else None, *r[1:]) for r in rows]
    assert nodes(prefix_trie.conversation_trie(keyed)) == plainly(text)


def test_only_turnless_conversations(spark):
    ranked, spans = prefix_trie.ordered(table(spark, [(5, 0, "u", "x"), (4, 0, "u", "y")]))
    none = prefix_trie.placed(ranked, spans).filter("false")
    found = nodes(prefix_trie.trie(none, spans.select("conv")))
    assert found == [(4, 0, None, 2, 0, 1, 0, hashlib.sha256(b"4,5").hexdigest())]


def test_rebuilt_conversations(spark, duck, tmp_path):
    """The query on conversations of many lengths, gaps in the ids and turns without a number."""
    draw = random.Random(11)
    rows = [
        (k, t if t else None, "u", draw.choice(["a", "bb", f"{k}"]))
        for k in [*range(60), *range(70, 90, 3), -3, -5]
        for t in range(draw.randint(1, 14))
    ]
    table(spark, rows).write.parquet(f"{tmp_path}/conversations.parquet")
    frame = duck.execute(f"SELECT * FROM read_parquet('{tmp_path}/conversations.parquet/*.parquet')").df()
    duck.register("rebuilt_turns", frame)
    statement = ORACLES["op11_prefix_trie"].replace("FROM conversations", "FROM rebuilt_turns")
    found = spark_content(QUERIES["op11_prefix_trie"](spark, str(tmp_path)))
    assert found == duck_content(duck, statement) and len(found) > 100
