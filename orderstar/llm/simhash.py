"""SimHash near-duplicates: 64-bit fingerprints, linked by a Gray-order hierarchical index.

The index has two kinds of nodes. Upper nodes are masked bit patterns: two fingerprints that differ
in at most ``d`` bits agree in at least one of ``d + 1`` masks that share out the bits, so
fingerprints meet under (mask, pattern), the key Spark shuffles by. A node that is still large is
split by masks over the bits it has not fixed yet, level after level; four levels fix 44 of 64 bits,
which bounds what one task can hold. Below a key the fingerprints lie in Gray order; runs of them
form binary nodes that keep the bits all members share. Pairs of nodes are walked from the top,
adding up the differences among the bits each level newly shares, and dropped as a whole once these
exceed ``d``.

Nodes hand on a spanning forest of their links, never all pairs. Components come from alternating
star contractions over these links in Spark.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import checkpointed
from .common import importable, stored

BITS = 64
TEXT_BYTES = 4 << 20  # of a long text that are split into words at a time
_SPACE = re.compile(rb"[\x20\x09-\x0D]")
NODE_ROWS = 50_000  # keys above this are split by further masks
LEAF = 16
FRONTIER = 1 << 17  # node pairs looked at together
BUFFER = 1 << 17  # fingerprints indexed together
LEVELS = 4

# ---------------------------------------------------------------- fingerprints


def _votes(hashes: np.ndarray) -> np.ndarray:
    """How often each of the 64 bits is set: byte lanes are summed 255 hashes at a time."""
    whole = np.zeros(-(-len(hashes) // 255) * 255, dtype="<u8")
    whole[: len(hashes)] = hashes
    counts = np.empty((8, 8), dtype=np.int64)
    for bit in range(8):
        lanes = (whole >> np.uint64(bit)) & np.uint64(0x0101010101010101)
        sums = lanes.reshape(-1, 255).sum(axis=1, dtype="<u8")
        counts[:, bit] = sums.view(np.uint8).reshape(-1, 8).sum(axis=0, dtype=np.int64)
    return counts.reshape(64)


def _word_lists(text: bytes) -> Iterator[list[bytes]]:
    """The words of a text, some ``TEXT_BYTES`` at a time."""
    start = 0
    while start < len(text):
        space = _SPACE.search(text, start + TEXT_BYTES)
        end = space.start() if space else len(text)
        yield text[start:end].lower().split()
        start = end


def fingerprint_of(text: bytes | None, shingle: int = 3, seed: int = 42) -> int:
    """SimHash of a text's word shingles, as an unsigned number; 0 without words."""
    from xxhash import xxh64_intdigest as xxh64

    votes, total, words = np.zeros(BITS, dtype=np.int64), 0, []
    for more in _word_lists(text or b""):
        words = words[len(words) - shingle + 1 :] + more if len(words) >= shingle else words + more
        if len(words) < shingle:
            continue
        hashes = np.fromiter(
            (xxh64(b" ".join(run), seed) for run in zip(*(words[i:] for i in range(shingle)))),
            dtype="<u8",
            count=len(words) - shingle + 1,
        )
        votes += _votes(hashes)
        total += len(hashes)
    if not total:
        return xxh64(b" ".join(words), seed) if words else 0
    bits = votes * 2 > total
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def fingerprints(
    docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 3, seed: int = 42
) -> DataFrame:
    """(key, fingerprint) of every row; a NULL or empty text has fingerprint 0.

    Words are split at ASCII white space after lower-casing A-Z. Other columns are ignored, repeated
    rows stay repeated.
    """
    importable(docs.sparkSession)
    rows = docs.select(F.col(key).alias("id"), F.col(text).cast("binary").alias("text"))
    schema = T.StructType(
        [T.StructField("id", rows.schema["id"].dataType), T.StructField("fingerprint", T.LongType())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = np.fromiter(
                (fingerprint_of(t.as_py(), shingle, seed) for t in batch.column(1)),
                dtype=np.uint64,
                count=batch.num_rows,
            )
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(values.view(np.int64))], names=["id", "fingerprint"]
            )

    return rows.mapInArrow(run, schema)


# ---------------------------------------------------------------- index below one key


def gray_rank(codes: np.ndarray) -> np.ndarray:
    """Position of each code in the reflected Gray sequence."""
    rank = codes.astype(np.uint64)
    for step in (1, 2, 4, 8, 16, 32):
        rank = rank ^ (rank >> np.uint64(step))
    return rank


def _popcount(values: np.ndarray) -> np.ndarray:
    return np.bitwise_count(values).astype(np.int16)


class GrayIndex:
    """Binary nodes over groups of Gray-ordered fingerprints; group by group, rows adjacent."""

    def __init__(self, codes: np.ndarray, starts: np.ndarray):
        self.codes, n = codes, len(codes)
        sizes = np.diff(np.append(starts, n))
        self.levels = []  # per level: first node of each group, first row, end row, shared, pattern
        width = LEAF
        while True:
            per_group = -(-sizes // width)
            first = np.concatenate(([0], np.cumsum(per_group)))
            inside = np.arange(first[-1]) - np.repeat(first[:-1], per_group)
            row = np.repeat(starts, per_group) + inside * width
            end = np.minimum(row + width, np.repeat(starts + sizes, per_group))
            ones = np.bitwise_and.reduceat(codes, row)
            any_ = np.bitwise_or.reduceat(codes, row)
            self.levels.append((first, inside, np.repeat(np.arange(len(sizes)), per_group),
                                row, end, ~(ones ^ any_), ones))
            if per_group.max() == 1:
                break
            width *= 2

    def links(self, distance: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Row pairs within the distance. Where whole nodes are, only pairs that connect them."""
        top = len(self.levels) - 1
        nodes = np.arange(len(self.levels[top][3]))
        none = np.zeros(len(nodes), dtype=np.uint64)
        work = [(top, nodes, nodes, none, np.zeros(len(nodes), dtype=np.int16))]
        while work:
            level, a, b, fixed, apart = work.pop()
            if len(a) > FRONTIER:
                half = len(a) // 2
                work.append((level, a[half:], b[half:], fixed[half:], apart[half:]))
                work.append((level, a[:half], b[:half], fixed[:half], apart[:half]))
                continue
            _, inside, group, row, end, shared, pattern = self.levels[level]
            both = shared[a] & shared[b]
            apart = apart + _popcount((pattern[a] ^ pattern[b]) & both & ~fixed)
            near = apart <= distance
            a, b, both, apart = a[near], b[near], both[near], apart[near]
            whole = apart + _popcount(~both) <= distance
            if whole.any():
                yield from self._connect(row[a[whole]], end[a[whole]], row[b[whole]], end[b[whole]])
                a, b, both, apart = a[~whole], b[~whole], both[~whole], apart[~whole]
            if not len(a):
                continue
            if level == 0:
                yield from self._leaves(row[a], end[a], row[b], end[b], distance)
                continue
            below_first = self.levels[level - 1][0]
            base, stop = below_first[group[a]], below_first[group[a] + 1]
            left, right = base + 2 * inside[a], base + 2 * inside[b]
            for i, j in ((0, 0), (0, 1), (1, 0), (1, 1)):
                keep = (left + i < stop) & (right + j < stop)
                if (i, j) == (1, 0):
                    keep &= a != b
                if keep.any():
                    work.append((level - 1, left[keep] + i, right[keep] + j, both[keep], apart[keep]))

    @staticmethod
    def _connect(row_a, end_a, row_b, end_b):
        """Star links of node pairs whose members are all within the distance."""
        for hub, first, end in ((row_a, row_b, end_b), (row_b, row_a, end_a)):
            sizes = end - first
            inside = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            yield np.repeat(hub, sizes), np.repeat(first, sizes) + inside

    def _leaves(self, row_a, end_a, row_b, end_b, distance):
        step = max(1, FRONTIER * 8 // (LEAF * LEAF))
        i, j = np.divmod(np.arange(LEAF * LEAF), LEAF)
        for at in range(0, len(row_a), step):
            cut = slice(at, at + step)
            x, y = row_a[cut, None] + i, row_b[cut, None] + j
            real = (x < end_a[cut, None]) & (y < end_b[cut, None]) & (x < y)
            x, y = x[real], y[real]
            near = np.bitwise_count(self.codes[x] ^ self.codes[y]) <= distance
            yield x[near], y[near]


def _smallest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest node reachable from each of n nodes."""
    label = np.arange(n)
    while True:
        x, y = label[a], label[b]
        if (x == y).all():
            return label
        low = np.minimum(x, y)
        np.minimum.at(label, np.maximum(x, y), low)
        while not (label == label[label]).all():
            label = label[label]


def forest(groups: np.ndarray, codes: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """(code, smallest code linked to it through these groups) for codes that have a smaller one."""
    order = np.lexsort((gray_rank(codes), groups))
    groups, codes = groups[order], codes[order]
    starts = np.flatnonzero(np.append(True, groups[1:] != groups[:-1]))
    distinct, at = np.unique(codes.view(np.int64), return_inverse=True)
    label = np.arange(len(distinct))
    pending, held = [], 0

    def merge(label):
        a = np.concatenate([at[x] for x, _ in pending])
        b = np.concatenate([at[y] for _, y in pending])
        return _smallest(len(distinct), np.concatenate((a, np.arange(len(label)))),
                         np.concatenate((b, label)))

    for x, y in GrayIndex(codes, starts).links(distance):
        pending.append((x, y))
        held += len(x)
        if held > 1 << 20:
            label, pending, held = merge(label), [], 0
    if pending:
        label = merge(label)
    moved = np.flatnonzero(label != np.arange(len(label)))
    return distinct[moved], distinct[label[moved]]


# ---------------------------------------------------------------- index over Spark


def _masks(fixed: int, parts: int) -> list[int]:
    """Share out the bits that are not fixed yet among ``parts`` masks of a quarter of them."""
    free = [bit for bit in range(BITS) if not fixed >> bit & 1]
    return [sum(1 << bit for bit in free[i::parts]) for i in range(parts)]


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def _node_tree(distance: int) -> list[list[int]]:
    """Masks of each level: entry i of level k has its children at entries i*p .. i*p+p-1 of k+1."""
    parts = distance + 1
    levels, above = [], [0]
    for _ in range(LEVELS):
        above = [fixed | mask for fixed in above for mask in _masks(fixed, parts)]
        levels.append(above)
    return levels


def _group_links(rows: DataFrame, distance: int) -> DataFrame:
    """Links below each (mask, pattern): rows of a key come together, many keys per buffer."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        size = 0

        def emit(parts):
            mask, pattern, code = np.concatenate(parts, axis=1)
            change = np.append(True, (mask[1:] != mask[:-1]) | (pattern[1:] != pattern[:-1]))
            a, b = forest(np.cumsum(change), code.view(np.uint64), distance)
            return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(np.stack([c.to_numpy(zero_copy_only=False).astype(np.int64)
                                  for c in batch.columns]))
            size += batch.num_rows
            if size < BUFFER:
                continue
            whole = np.concatenate(held, axis=1)
            last = (whole[0] == whole[0, -1]) & (whole[1] == whole[1, -1])
            cut = int(np.argmax(last))  # the last key may go on in the next batch
            if cut:
                yield emit([whole[:, :cut]])
                whole = whole[:, cut:]
            held, size = [whole], whole.shape[1]
        if size:
            yield emit(held)

    dealt = rows.repartition("mask", "pattern").sortWithinPartitions("mask", "pattern")
    return dealt.mapInArrow(run, "a long, b long")


def near_links(codes: DataFrame, distance: int = 3) -> DataFrame:
    """Links (a, b) that connect distinct fingerprints just as all pairs within the distance do."""
    if not 0 <= distance <= 7:
        raise ValueError("distance must be 0 to 7")
    importable(codes.sparkSession)
    tree = _node_tree(distance)
    parts = distance + 1
    code = F.col("fingerprint")
    masks = F.array(*(F.lit(_signed(m)) for m in tree[0]))
    rows = codes.select(code, F.posexplode(masks).alias("node", "mask"))
    found = None
    for level in range(LEVELS):
        rows = rows.select(
            "node", "mask", code.bitwiseAND(F.col("mask")).alias("pattern"), "fingerprint"
        )
        sizes = rows.groupBy("node", "pattern").agg(F.count("*").alias("size"))
        sized = rows.join(sizes.filter("size > 1"), ["node", "pattern"])
        last = level == LEVELS - 1
        small = sized if last else sized.filter(F.col("size") <= NODE_ROWS)
        links = _group_links(small.select("mask", "pattern", "fingerprint"), distance)
        found = links if found is None else found.unionByName(links)
        if last:
            break
        large = sized.filter(F.col("size") > NODE_ROWS)
        if large.isEmpty():
            break
        below = [
            F.array(*(F.lit(_signed(m)) for m in tree[level + 1][n * parts : (n + 1) * parts]))
            for n in range(len(tree[level]))
        ]
        children = F.element_at(F.array(*below), F.col("node") + 1)
        rows = large.select(
            code, (F.col("node") * parts).alias("base"), F.posexplode(children).alias("i", "mask")
        ).select(code, (F.col("base") + F.col("i")).alias("node"), "mask")
    return found


def components(links: DataFrame) -> DataFrame:
    """(member, root) of every vertex that is linked to a smaller one: alternating star contraction.

    Vertices and roots have the links' own type; a root is the smallest member of its component.
    """
    edges = checkpointed(
        links.filter("a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct()
    )
    seen = None
    while True:
        state = edges.agg(
            F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
        ).first()
        if state == seen or not state[0]:
            return edges.select(F.col("a").alias("member"), F.col("b").alias("root"))
        seen = state
        # Large star: the larger neighbours of a vertex go to its smallest neighbour.
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low"))
        large = (
            both.join(low, "a").filter("b > a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        ).distinct()
        # Small star: a vertex and its smaller neighbours go to the smallest of them.
        low = large.groupBy("a").agg(F.min("b").alias("low"))
        small = large.join(low, "a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        own = low.select("a", F.col("low").alias("b"))
        edges = checkpointed(small.filter("a <> b").unionByName(own).distinct())


def near_duplicates(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    shingle: int = 3,
    distance: int = 3,
    seed: int = 42,
) -> DataFrame:
    """(key, fingerprint, root, component_id) of every row.

    Rows are in one component if a chain of fingerprints, each at most ``distance`` bits from the
    next, joins them. ``root`` is the smallest fingerprint (signed) of the component and names it,
    ``component_id`` the smallest key in it, NULL if all are NULL. Rows without words have
    fingerprint 0 and link like any other. An empty table gives an empty result.
    """
    marked = stored(fingerprints(docs, key, text, shingle, seed), "simhash")
    codes = checkpointed(marked.groupBy("fingerprint").agg(F.min("id").alias("low")))
    roots = components(near_links(codes.select("fingerprint"), distance))
    rooted = codes.join(
        roots.withColumnRenamed("member", "fingerprint"), "fingerprint", "left"
    ).withColumn("root", F.coalesce("root", "fingerprint"))
    lowest = rooted.groupBy("root").agg(F.min("low").alias("component_id"))
    classes = rooted.select("fingerprint", "root").join(lowest, "root")
    return marked.join(classes, "fingerprint").select(
        F.col("id").alias(key), "fingerprint", "root", "component_id"
    )


def keep_one(
    docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 3, distance: int = 3
) -> DataFrame:
    """The rows of ``docs`` without near duplicates: one per component, with the smallest key.

    Rows that tie (same key, same component) are ordered by all their columns; NULL keys come last.
    """
    classes = near_duplicates(docs, key, text, shingle, distance)
    kept = classes.filter(F.col(key).eqNullSafe(F.col("component_id")))
    kept = kept.select(F.col(key).alias("_key"), F.col("root").alias("_root")).distinct()
    # A key that stands for several components, or for several rows, needs its fingerprint again.
    counts = docs.groupBy(F.col(key).alias("_key")).agg(F.count("*").alias("_rows"))
    kept = kept.join(counts, kept["_key"].eqNullSafe(counts["_key"])).select(
        kept["_key"], "_root", "_rows"
    )
    simple = kept.filter("_rows = 1").select("_key")
    result = docs.join(simple, docs[key].eqNullSafe(simple["_key"]), "left_semi")
    tied = kept.filter("_rows > 1")
    if tied.isEmpty():
        return result
    # Repeated keys: their rows' own fingerprints tell which component each row belongs to.
    keys = tied.select("_key").distinct()
    rows = docs.join(keys, docs[key].eqNullSafe(keys["_key"]), "left_semi")
    packed = rows.select(
        F.struct(*(rows[c] for c in rows.columns)).alias("_row"),
        rows[key].alias("_id"),
        rows[text].alias("_text"),
    )
    whole = packed.select(F.struct("_row", "_id").alias("_both"), "_text")
    own = fingerprints(whole, "_both", "_text", shingle).select("id.*", "fingerprint")
    roots = classes.select("fingerprint", F.col("root").alias("_root")).distinct()
    wanted = tied.select(F.col("_key").alias("_id"), F.col("_root"))
    placed = own.join(roots, "fingerprint").alias("p").join(
        wanted.alias("w"),
        F.expr("p._root = w._root AND p._id <=> w._id"),
    ).select("p.*")
    first = placed.groupBy("_root").agg(F.min_by("_row", F.to_json("_row")).alias("_row"))
    return result.unionByName(first.select("_row.*"))
