"""Best-fit packing by minimum bin slack.

Documents become pieces of at most one sequence's length. Sequences are then filled one after the
other: the longest piece left, and of all others the combination that leaves the least room, found
by a subset-sum over a bitset of reachable fillings. What is taken is removed.

Which pieces have a length does not matter to that search, so it runs on how many there are of each
length: a table of no more rows than a sequence has tokens. A combination is used as often as the
numbers allow at once, since as long as its pieces last it stays the fullest. Spark does the rest:
pieces are ranked by length in one range sort, and a piece's rank says in which sequence it lies.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.keys import with_dense_key
from .common import importable, stored
from .word_bpe import word_encoder

LENGTH = 2048
END = 0


def fullest(counts: Counter, room: int) -> list[int]:
    """Lengths, none more often than counted, whose sum comes closest to ``room`` from below.

    Bit s of ``reach`` says that some of the lengths seen so far sum to s. Longer ones are tried first,
    so among equal sums the one of long pieces is found.
    """
    reach, wanted, full = 1, 1 << room, (2 << room) - 1
    tried: list[tuple[int, int]] = []  # a length, and what was reachable without it
    for length in sorted(counts, reverse=True):
        for _ in range(min(counts[length], room // length)):
            more = (reach | reach << length) & full
            if more == reach:
                break
            tried.append((length, reach))
            reach = more
            if reach & wanted:
                break
        if reach & wanted:
            break
    total, chosen = reach.bit_length() - 1, []
    for length, before in reversed(tried):
        if not before >> total & 1:
            chosen.append(length)
            total -= length
    return chosen


def fillings(counts: dict[int, int], length: int = LENGTH) -> list[tuple[list[int], int]]:
    """Combinations of piece lengths, each with how many sequences are filled that way."""
    left = Counter({size: n for size, n in counts.items() if n})
    found = []
    while left:
        seed = max(left)
        left[seed] -= 1
        chosen = [seed, *fullest(+left, length - seed)]
        left[seed] += 1
        often = Counter(chosen)
        times = min(left[size] // n for size, n in often.items())
        for size, n in often.items():
            left[size] -= n * times
        left = +left
        found.append((chosen, times))
    return found


def slots(found: list[tuple[list[int], int]]) -> np.ndarray:
    """Where the pieces of a length go, as rows (length, first piece, first sequence, sequences,
    offset) in order: pieces ``first piece`` and on lie at ``offset`` of one sequence each.
    """
    rows, used, sequence = [], Counter(), 0
    for chosen, times in found:
        at = 0
        for size in chosen:
            rows.append((size, used[size], sequence, times, at))
            used[size] += times
            at += size
        sequence += times
    return np.array(sorted(rows), dtype=np.int64).reshape(-1, 5)


def pieces(
    docs: DataFrame,
    tokenizer: str,
    key: str = "doc_id",
    text: str = "text",
    length: int = LENGTH,
    with_ids: bool = True,
) -> DataFrame:
    """(id, piece, start, length, ids_crc32[, ids]) of every row: its ids cut every ``length`` ids.

    A NULL text counts as empty; every row ends with the id ``END``.
    """
    rows = docs.select(F.col(key).alias("id"), F.col(text).alias("text"))
    fields = [T.StructField("id", rows.schema["id"].dataType), T.StructField("piece", T.IntegerType())]
    fields += [T.StructField(c, T.LongType()) for c in ("start", "length", "ids_crc32")]
    if with_ids:
        fields.append(T.StructField("ids", T.ArrayType(T.IntegerType())))
    schema = T.StructType(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = word_encoder(tokenizer)
        for batch in batches:
            at, cut, ids_out = [], [], []
            for i, value in enumerate(batch.column(1)):
                ids = np.append(coder.ids(value.as_py() or ""), END).astype("<u4")
                for number, start in enumerate(range(0, len(ids), length)):
                    own = ids[start : start + length]
                    at.append(i)
                    cut.append((number, start, len(own), zlib.crc32(own.tobytes())))
                    if with_ids:
                        ids_out.append(own.astype(np.int32))
            numbers, *others = zip(*cut) if cut else [()] * 4
            arrays = [
                batch.column(0).take(pa.array(at, pa.int64())),
                pa.array(numbers, pa.int32()),
                *(pa.array(c, pa.int64()) for c in others),
            ]
            if with_ids:
                arrays.append(pa.array(ids_out, pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays(arrays, names=schema.names)

    return rows.mapInArrow(run, schema)


def pack(
    docs: DataFrame,
    tokenizer: str,
    key: str = "doc_id",
    text: str = "text",
    length: int = LENGTH,
    with_ids: bool = True,
) -> DataFrame:
    """One row per piece: the key, piece, start (ids of the document before it), length, ids_crc32 (of
    the ids as little-endian 32-bit numbers), sequence_id (from 0, without gaps), offset (in the
    sequence, without gaps), and with ``with_ids`` the ids (array of int).

    Only documents longer than a sequence are cut, into whole sequences and a rest; the document's
    last id is ``END``. Pieces of one length are interchangeable; they go to the sequences in the order
    of key and piece, repeated rows each on their own. An empty table has no pieces. Columns other than
    key and text may have any name.
    """
    if length < 1:
        raise ValueError("length must be positive")
    importable(docs.sparkSession)
    # Stored, since a range sort reads its input twice.
    cut = stored(pieces(docs, tokenizer, key, text, length, with_ids), "pieces")
    # The last column lets equal rows lie in several range partitions.
    tied = cut.withColumn("tie", F.monotonically_increasing_id())
    ranked = with_dense_key(tied, "rank", ["length", "id", "piece", "tie"])
    counted = ranked.groupBy("length").count().collect()  # one row per length, at most ``length``
    counts = {row["length"]: row["count"] for row in counted}
    table = slots(fillings(counts, length))
    before = np.cumsum([0] + [counts.get(size, 0) for size in range(1, length + 1)])
    starts = before[table[:, 0] - 1] + table[:, 1]  # rank, from 0, of the first piece of a row

    @F.pandas_udf(T.StructType([T.StructField(c, T.LongType()) for c in ("sequence", "offset")]))
    def place(rank: pd.Series) -> pd.DataFrame:
        position = rank.to_numpy() - 1
        row = np.searchsorted(starts, position, side="right") - 1
        sequence = table[row, 2] + position - starts[row]
        return pd.DataFrame({"sequence": sequence, "offset": table[row, 4]})

    return ranked.withColumn("to", place("rank")).select(
        F.col("id").alias(key),
        "piece",
        "start",
        "length",
        "ids_crc32",
        F.col("to.sequence").alias("sequence_id"),
        F.col("to.offset").alias("offset"),
        *(["ids"] if with_ids else []),
    )
