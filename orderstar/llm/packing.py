"""Packing along a space-filling curve.

Each document becomes token ids and a vector: its ids counted in hashed buckets, projected to four
dimensions. The Hilbert key of that point orders the documents; they are sorted by it in range
partitions and written one after the other into sequences, cut where a sequence is full. Similar
documents so share sequences, and only the last sequence of a partition is short.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import importable, stored
from .tokens import encoder

LENGTH = 2048
END = 1
BUCKETS = 256
DIMENSIONS = 4
BITS = 12  # per dimension
PARTITION_TOKENS = 8 << 20
_LOCAL_BITS = 33  # sequence id: partition above, number inside it below


def _projection(vocabulary: int) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of each token id, and the bucket vectors; the same on every machine."""
    draw = np.random.Generator(np.random.Philox(key=7))
    return draw.integers(0, BUCKETS, vocabulary), draw.standard_normal((BUCKETS, DIMENSIONS))


def point(ids: np.ndarray, bucket: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Grid coordinates of a document."""
    counts = np.sqrt(np.bincount(bucket[ids], minlength=BUCKETS))
    spot = counts @ vectors / max(1e-9, np.sqrt(len(ids)))
    return np.clip((np.tanh(spot) + 1) / 2 * (1 << BITS), 0, (1 << BITS) - 1).astype(np.uint64)


def hilbert_key(points: np.ndarray) -> np.ndarray:
    """Place on the Hilbert curve of rows of grid coordinates."""
    x = points.astype(np.uint64).copy()
    n = x.shape[1]
    one = np.uint64(1)
    for b in range(BITS - 1, 0, -1):  # undo the rotations of each level, from the coarsest
        low = np.uint64((1 << b) - 1)
        for i in range(n):
            turned = (x[:, i] >> np.uint64(b)) & one == one
            swap = np.where(turned, np.uint64(0), (x[:, 0] ^ x[:, i]) & low)
            x[:, 0] ^= np.where(turned, low, np.uint64(0))
            x[:, 0] ^= swap
            x[:, i] ^= swap
    for i in range(1, n):  # Gray code over the dimensions
        x[:, i] ^= x[:, i - 1]
    carry = np.zeros(len(x), dtype=np.uint64)
    for b in range(BITS - 1, 0, -1):
        carry ^= np.where(
            (x[:, n - 1] >> np.uint64(b)) & one == one, np.uint64((1 << b) - 1), np.uint64(0)
        )
    x ^= carry[:, None]
    key = np.zeros(len(x), dtype=np.uint64)
    for b in range(BITS - 1, -1, -1):
        for i in range(n):
            key = (key << one) | ((x[:, i] >> np.uint64(b)) & one)
    return key.astype(np.int64)


def tokenized(docs: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, key on the curve, number of ids, ids as little-endian bytes) of every row.

    A NULL text counts as empty; every row ends with the id ``END``.
    """
    rows = docs.select(F.col(key).alias("id"), F.col(text).alias("text"))
    schema = T.StructType(
        [
            T.StructField("id", rows.schema["id"].dataType),
            T.StructField("place", T.LongType()),
            T.StructField("n", T.LongType()),
            T.StructField("ids", T.BinaryType()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(tokenizer)
        width = coder.id_type
        bucket, vectors = _projection(coder.size)
        for batch in batches:
            points = np.zeros((batch.num_rows, DIMENSIONS), dtype=np.uint64)
            sizes, packed = [], []
            for i, value in enumerate(batch.column(1)):
                ids = np.append(coder.ids(value.as_py() or ""), np.array([END], dtype=width))
                points[i] = point(ids, bucket, vectors)
                sizes.append(len(ids))
                packed.append(ids.tobytes())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(hilbert_key(points)),
                    pa.array(sizes, pa.int64()),
                    pa.array(packed, pa.binary()),
                ],
                names=schema.names,
            )

    return rows.mapInArrow(run, schema)


def pack(
    docs: DataFrame,
    tokenizer: str,
    key: str = "doc_id",
    text: str = "text",
    length: int = LENGTH,
    with_ids: bool = True,
    partition_tokens: int | None = None,
) -> DataFrame:
    """One row per piece of a document, in sequences of ``length`` ids.

    Columns: the key, start (ids of the document before the piece), length, ids_crc32 (of the ids as
    little-endian 32-bit numbers), doc_tokens, sequence_id, offset (in the sequence), and with
    ``with_ids`` the ids (array of int). Every id, the closing ``END`` included, lies in exactly one
    piece; all sequences but the last of a partition are full. Rows that tie on the curve are ordered
    by key; repeated rows are packed each on their own. An empty table has no pieces.
    ``partition_tokens`` (default ``PARTITION_TOKENS``) is how many ids a sorted partition aims at.
    """
    importable(docs.sparkSession)
    tokens = stored(tokenized(docs, tokenizer, key, text), "tokens")
    total = tokens.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    parts = max(1, -(-total // (partition_tokens or PARTITION_TOKENS)))
    # The random last column lets copies with one place and one key lie in several partitions.
    order = ["place", "id", "tie"]
    ordered = (
        tokens.withColumn("tie", F.monotonically_increasing_id())
        .repartitionByRange(parts, *order)
        .sortWithinPartitions(*order)
        .select("id", "n", "ids")
    )
    numbers = ["start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    fields = [T.StructField(key, tokens.schema["id"].dataType)]
    fields += [T.StructField(c, T.LongType()) for c in numbers]
    if with_ids:
        fields.append(T.StructField("ids", T.ArrayType(T.IntegerType())))
    schema = T.StructType(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width = encoder(tokenizer).id_type
        sequence, filled = TaskContext.get().partitionId() << _LOCAL_BITS, 0
        for batch in batches:
            rows, pieces, ids_out = [], [], []
            for i, (n, raw) in enumerate(zip(batch.column(1).to_pylist(), batch.column(2))):
                ids = np.frombuffer(raw.as_buffer(), dtype=width).astype("<u4")
                start = 0
                while start < n:
                    size = min(n - start, length - filled)
                    piece = ids[start : start + size]
                    rows.append(i)
                    pieces.append((start, size, zlib.crc32(piece.tobytes()), n, sequence, filled))
                    if with_ids:
                        ids_out.append(piece.astype(np.int32))
                    start, filled = start + size, filled + size
                    if filled == length:
                        sequence, filled = sequence + 1, 0
            columns = zip(*pieces) if pieces else [()] * 6
            arrays = [
                batch.column(0).take(pa.array(rows, pa.int64())),
                *(pa.array(c, pa.int64()) for c in columns),
            ]
            if with_ids:
                arrays.append(pa.array(ids_out, pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays(arrays, names=schema.names)

    return ordered.mapInArrow(run, schema)
