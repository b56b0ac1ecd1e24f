"""Line dedup that can be taken back: sharded cuckoo filters in front of exact reference tables.

The references are exact: one row per line key and document that holds it. A key that enough
documents hold is *repeated*: its lines go everywhere except in the document with the largest key.
Cuckoo filters, one chain of tables per shard of key hashes, hold the repeated keys only; there are as
many shards as the repeated keys ask for. References meet the filter of their shard in salted
partitions. What passes is looked up in the exact counts, so a false positive never costs a line.

Inserting and deleting documents appends: the references gained or lost, the new counts of the lines
those touch, and the filters of the shards in which a line crossed the threshold. Nothing that was
stored is written again; readers take the last row of a kind, and ``compacted`` starts afresh.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import ascii_lower, importable, stored, unused

MIN_CHARS = 20
MIN_DOCUMENTS = 3
SHARD_LINES = 1 << 16  # repeated lines a shard is made for: a filter of some 150 KB
SALT_REFERENCES = 1 << 16  # references of a shard, and so of a hot line, that are dealt to one salt
SPACE = " \t\n\v\f\r"

# ---------------------------------------------------------------- cuckoo filter


class CuckooFilter:
    """A chain of cuckoo tables: buckets of four 16-bit fingerprints, two buckets per hash."""

    SLOTS = 4
    KICKS = 200

    def __init__(self, buckets: int = 256, tables: list[np.ndarray] | None = None):
        if buckets & (buckets - 1):
            raise ValueError("the number of buckets must be a power of two")
        self.buckets = buckets
        self.tables = [] if tables is None else tables

    @staticmethod
    def _mark(value: int) -> int:
        return (value >> 48 & 0xFFFF) or 1

    def _homes(self, value: int) -> tuple[int, int, int]:
        mark, mask = self._mark(value), self.buckets - 1
        first = value & mask
        return mark, first, (first ^ (mark * 0x5BD1E995)) & mask

    def add(self, value: int) -> None:
        mark, first, other = self._homes(value & (1 << 64) - 1)
        for table in self.tables:
            if self._place(table, mark, first) or self._place(table, mark, other):
                return
        if self.tables:
            mark, first = self._evict(self.tables[-1], mark, other)
            if not mark:
                return
        self.tables.append(np.zeros((self.buckets, self.SLOTS), dtype=np.uint16))
        self._place(self.tables[-1], mark, first)

    def add_all(self, values: np.ndarray) -> None:
        """Add many values: free slots are filled at once, what finds none is added one by one."""
        values = values.astype(np.uint64)
        if not self.tables:
            self.tables.append(np.zeros((self.buckets, self.SLOTS), dtype=np.uint16))
        table = self.tables[-1]
        mark = (values >> np.uint64(48)).astype(np.int64)
        mark[mark == 0] = 1
        first = (values & np.uint64(self.buckets - 1)).astype(np.int64)
        left = np.arange(len(values))
        for homes in (first, (first ^ (mark * 0x5BD1E995)) & (self.buckets - 1)):
            left = left[np.argsort(homes[left], kind="stable")]
            bucket = homes[left]
            # Place of a value among those for its bucket, against the slots that are free there.
            begins = np.flatnonzero(np.diff(bucket, prepend=-1))
            nth = np.arange(len(left)) - np.repeat(begins, np.diff(begins, append=len(left)))
            free = np.argsort(table[bucket] != 0, axis=1, kind="stable")
            fits = nth < (table[bucket] == 0).sum(axis=1)
            slot = free[np.flatnonzero(fits), nth[fits]]
            table[bucket[fits], slot] = mark[left[fits]]
            left = left[~fits]
        for value in values[left]:
            self.add(int(value))

    @staticmethod
    def _place(table: np.ndarray, mark: int, bucket: int) -> bool:
        free = np.flatnonzero(table[bucket] == 0)
        if len(free):
            table[bucket, free[0]] = mark
        return bool(len(free))

    def _evict(self, table: np.ndarray, mark: int, bucket: int) -> tuple[int, int]:
        """Move entries to their other bucket to make room; the one left over, or 0."""
        for kick in range(self.KICKS):
            slot = (mark + kick) % self.SLOTS
            mark, table[bucket, slot] = int(table[bucket, slot]), mark
            bucket = (bucket ^ (mark * 0x5BD1E995)) & (self.buckets - 1)
            if self._place(table, mark, bucket):
                return 0, 0
        return mark, bucket

    def discard(self, value: int) -> bool:
        """Remove one entry of a value that was added."""
        mark, first, other = self._homes(value & (1 << 64) - 1)
        for table in reversed(self.tables):
            for bucket in (first, other):
                held = np.flatnonzero(table[bucket] == mark)
                if len(held):
                    table[bucket, held[0]] = 0
                    return True
        return False

    def maybe_has(self, values: np.ndarray) -> np.ndarray:
        values = values.astype(np.uint64)
        mark = (values >> np.uint64(48)).astype(np.int64)
        mark[mark == 0] = 1
        first = (values & np.uint64(self.buckets - 1)).astype(np.int64)
        other = (first ^ (mark * 0x5BD1E995)) & (self.buckets - 1)
        found = np.zeros(len(values), dtype=bool)
        for table in self.tables:
            for bucket in (first, other):
                found |= (table[bucket] == mark[:, None]).any(axis=1)
        return found

    def to_bytes(self) -> bytes:
        return b"".join(table.tobytes() for table in self.tables)

    @classmethod
    def from_bytes(cls, buckets: int, raw: bytes) -> CuckooFilter:
        size = buckets * cls.SLOTS
        cells = np.frombuffer(raw, dtype=np.uint16).reshape(-1, size)
        return cls(buckets, [c.reshape(buckets, cls.SLOTS).copy() for c in cells])


# ---------------------------------------------------------------- keys and references


def line_key(line: Column) -> Column:
    """The line without ASCII white space at its ends, A-Z lower-cased."""
    return ascii_lower(F.trim(line, F.lit(SPACE)))


def _line_key(line: bytes) -> bytes:
    return line.strip(SPACE.encode()).lower()


def references(
    docs: DataFrame, key: str = "doc_id", text: str = "text", min_chars: int = MIN_CHARS
) -> DataFrame:
    """(line, doc): sha256 of every line key of at least ``min_chars`` characters, once per document.

    Rows with one key are one document; a NULL key is a document too, the smallest. NULL texts hold no line.
    """
    lines = docs.select(
        F.col(key).alias("doc"), F.explode(F.split(F.col(text), "\n", -1)).alias("line")
    ).select("doc", line_key(F.col("line")).alias("line"))
    long_ones = lines.filter(F.char_length("line") >= min_chars)
    return long_ones.select(F.unhex(F.sha2("line", 256)).alias("line"), "doc").distinct()


def repeated(refs: DataFrame, min_documents: int = MIN_DOCUMENTS) -> DataFrame:
    """(line, n_docs, keeper) of lines that at least ``min_documents`` documents hold."""
    return (
        refs.groupBy("line")
        .agg(F.count("*").alias("n_docs"), F.max("doc").alias("keeper"))
        .filter(F.col("n_docs") >= min_documents)
    )


# ---------------------------------------------------------------- filters

FILTERS = "shard int, buckets int, cells binary"


def _shard(line: Column, shards: int) -> Column:
    return F.pmod(F.xxhash64(line), F.lit(shards)).cast("int")


def _hash(line: Column) -> Column:
    return F.xxhash64(line, F.lit(1))


def shards_for(lines: DataFrame) -> int:
    """As many shards as the repeated lines fill."""
    return max(1, -(-lines.count() // SHARD_LINES))


def update_filters(filters: DataFrame, changes: DataFrame, shards: int) -> DataFrame:
    """The filters after ``changes`` (line, added) of the shards that have any: keys that became
    repeated, or are so no longer.

    A filter grows by another table of the size it started with, which its first changes decide.
    """
    importable(changes.sparkSession)
    marked = changes.select(
        _shard(F.col("line"), shards).alias("shard"), _hash(F.col("line")).alias("hash"), "added"
    )

    def apply(before: pd.DataFrame, after: pd.DataFrame) -> pd.DataFrame:
        if after.empty:
            return pd.DataFrame({"shard": [], "buckets": [], "cells": []})
        if before.empty:
            wanted = max(64, len(after) / CuckooFilter.SLOTS / 0.9)
            table = CuckooFilter(1 << int(np.ceil(np.log2(wanted))))
        else:
            table = CuckooFilter.from_bytes(int(before["buckets"].iloc[0]), before["cells"].iloc[0])
        for value in after.loc[~after["added"], "hash"]:
            table.discard(int(value))
        table.add_all(after.loc[after["added"], "hash"].to_numpy())
        shard = int(after["shard"].iloc[0])
        return pd.DataFrame({"shard": [shard], "buckets": [table.buckets], "cells": [table.to_bytes()]})

    return (
        filters.groupBy("shard").cogroup(marked.groupBy("shard")).applyInPandas(apply, FILTERS)
    )


def build_filters(lines: DataFrame, shards: int) -> DataFrame:
    """Filters of all lines of ``repeated``."""
    none = lines.sparkSession.createDataFrame([], FILTERS)
    return update_filters(none, lines.select("line", F.lit(True).alias("added")), shards)


def _passing(refs: DataFrame, filters: DataFrame, shards: int) -> DataFrame:
    """References whose line the filter of its shard may hold.

    References are dealt by shard and salt, a shard having as many salts as its references ask for, and
    the shard's filter stands before them in each: a task holds one filter at a time, however many
    references there are.
    """
    importable(refs.sparkSession)
    sharded = refs.select(_shard(F.col("line"), shards).alias("shard"), "line", "doc")
    salts = F.ceil(F.count("*") / SALT_REFERENCES).cast("int").alias("salts")
    # One row per shard; a shard stands for ``SHARD_LINES`` repeated lines.
    per_shard = F.broadcast(sharded.groupBy("shard").agg(salts))
    every = F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt")
    tables = filters.join(per_shard, "shard").select("shard", every, "buckets", "cells")
    tested = sharded.join(per_shard, "shard").select(
        "shard",
        F.pmod(F.xxhash64("doc"), "salts").cast("int").alias("salt"),
        _hash(F.col("line")).alias("hash"),
        "line",
        "doc",
    )
    together = tables.unionByName(tested, allowMissingColumns=True).repartition("shard", "salt")
    order = ["shard", "salt", F.col("cells").isNull()]
    schema = T.StructType([refs.schema["line"], refs.schema["doc"]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, table = None, None
        for batch in batches:
            shards_of, is_table = batch.column("shard").to_numpy(), batch.column("cells").is_valid()
            is_table = is_table.to_numpy(zero_copy_only=False)
            values = batch.column("hash").fill_null(0).to_numpy()
            found = np.zeros(batch.num_rows, dtype=bool)
            # A stretch ends where the shard changes or a filter comes.
            cuts = np.flatnonzero((np.diff(shards_of, prepend=-1) != 0) | is_table)
            stretches = [0, *cuts[cuts > 0], batch.num_rows]
            for a, b in zip(stretches, stretches[1:]):
                if a == b:
                    continue
                if is_table[a]:
                    cells = batch.column("cells")[a].as_py()
                    shard = shards_of[a]
                    table = CuckooFilter.from_bytes(batch.column("buckets")[a].as_py(), cells)
                    a += 1
                if table is not None and a < b and shards_of[a] == shard:
                    found[a:b] = table.maybe_has(values[a:b])
            kept = batch.filter(pa.array(found))
            yield pa.RecordBatch.from_arrays(
                [kept.column("line"), kept.column("doc")], names=schema.names
            )

    return together.sortWithinPartitions(*order).mapInArrow(run, schema)


# ---------------------------------------------------------------- documents


def drops(refs: DataFrame, lines: DataFrame, filters: DataFrame, shards: int) -> DataFrame:
    """(doc, lines) to take out: the filters choose candidates, the exact counts decide."""
    candidates = _passing(refs, filters, shards)
    lost = candidates.join(lines.select("line", "keeper"), "line").filter(
        ~F.col("doc").eqNullSafe(F.col("keeper"))
    )
    return lost.groupBy("doc").agg(F.collect_list("line").alias("lines"))


def rewrite(
    docs: DataFrame,
    lost: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    min_chars: int = MIN_CHARS,
) -> DataFrame:
    """``docs`` with the lost lines taken out of their texts, and n_lines (before) and n_dropped.

    A NULL text stays NULL and counts as one empty line. Columns named n_lines and n_dropped are replaced.
    """
    kept = [c for c in docs.columns if c not in ("n_lines", "n_dropped")]
    doc, gone, raw = (unused(docs.columns, name) for name in ("doc", "gone", "raw"))
    renamed = lost.select(F.col("doc").alias(doc), F.col("lines").alias(gone))
    rows = docs.select(*(docs[c] for c in kept)).join(
        renamed, docs[key].eqNullSafe(renamed[doc]), "left"
    )
    rows = rows.select(*kept, F.col(text).cast("binary").alias(raw), gone)
    at = kept.index(text)
    importable(docs.sparkSession)
    schema = T.StructType(
        [
            *(docs.schema[c] for c in kept),
            T.StructField("n_lines", T.LongType()),
            T.StructField("n_dropped", T.LongType()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, counts, dropped = [], [], []
            for raw, lines in zip(batch.column(len(kept)), batch.column(len(kept) + 1)):
                raw, gone = raw.as_py(), set(lines.as_py() or ())
                own = (raw or b"").split(b"\n")
                left = own if not gone else [x for x in own if not _lost_line(x, gone, min_chars)]
                texts.append(None if raw is None else b"\n".join(left))
                counts.append(len(own))
                dropped.append(len(own) - len(left))
            columns = batch.columns[: len(kept)]
            columns[at] = pa.array(texts, pa.binary()).cast(columns[at].type)
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(counts, pa.int64()), pa.array(dropped, pa.int64())],
                names=schema.names,
            )

    return rows.mapInArrow(run, schema)


def _lost_line(line: bytes, gone: set[bytes], min_chars: int) -> bool:
    own = _line_key(line)
    if len(own) < min_chars:  # fewer bytes than characters there must be
        return False
    return hashlib.sha256(own).digest() in gone


class LineStore:
    """References, repeated lines and filters of a corpus, each a stored table and what was appended.

    Each change gives a new store and leaves the old one valid.
    """

    def __init__(
        self,
        key: str = "doc_id",
        text: str = "text",
        min_chars: int = MIN_CHARS,
        min_documents: int = MIN_DOCUMENTS,
        shards: int | None = None,
    ):
        """``shards``: number of filters; by default as many as the repeated lines of ``build`` ask for."""
        self.key, self.text, self.min_chars = key, text, min_chars
        self.min_documents, self.shards = min_documents, shards
        # (line, doc, held), (line, n_docs, keeper) and filters, the later ones over the earlier.
        self._refs: list[DataFrame] = []
        self._lines: list[DataFrame] = []
        self._filters: list[DataFrame] = []

    @classmethod
    def build(cls, docs: DataFrame, **options) -> LineStore:
        new = cls(**options)
        return new._based_on(references(docs, new.key, new.text, new.min_chars))

    def _based_on(self, refs: DataFrame) -> LineStore:
        new = LineStore(self.key, self.text, self.min_chars, self.min_documents, self.shards)
        new._refs = [stored(refs.withColumn("held", F.lit(True)), "line-references")]
        new._lines = [stored(repeated(new.refs, new.min_documents), "lines")]
        new.shards = new.shards or shards_for(new._lines[0])
        new._filters = [stored(build_filters(new._lines[0], new.shards), "line-filters")]
        return new

    def compacted(self) -> LineStore:
        """The same store in single tables, with shards for the lines repeated now."""
        same = LineStore(self.key, self.text, self.min_chars, self.min_documents)
        return same._based_on(self.refs)

    @property
    def refs(self) -> DataFrame:
        """(line, doc) of all documents held."""
        return self._held(self._refs)

    @property
    def lines(self) -> DataFrame:
        """(line, n_docs, keeper) of the repeated lines."""
        return _last(self._lines, ["line"]).filter(F.col("n_docs") >= self.min_documents)

    @property
    def filters(self) -> DataFrame:
        return _last(self._filters, ["shard"])

    @staticmethod
    def _held(parts: list[DataFrame]) -> DataFrame:
        return _last(parts, ["line", "doc"]).filter("held").select("line", "doc")

    def _changed(self, delta: DataFrame, touched: DataFrame) -> LineStore:
        """Append ``delta`` (line, doc, held), and what it changes for the ``touched`` lines."""
        new = LineStore(self.key, self.text, self.min_chars, self.min_documents, self.shards)
        new._refs = [*self._refs, stored(delta, "line-references")]
        near = [part.join(touched, "line", "left_semi") for part in new._refs]
        now = repeated(self._held(near), self.min_documents)
        state = touched.join(now, "line", "left").select(
            "line", F.coalesce("n_docs", F.lit(0)).alias("n_docs"), "keeper"
        )
        new._lines = [*self._lines, stored(state, "lines")]
        was = [part.join(touched, "line", "left_semi") for part in self._lines]
        was = _last(was, ["line"]).select("line", (F.col("n_docs") >= self.min_documents).alias("was"))
        crossed = new._lines[-1].join(was, "line", "left").select(
            "line",
            (F.col("n_docs") >= self.min_documents).alias("added"),
            F.coalesce("was", F.lit(False)).alias("was"),
        )
        crossed = stored(crossed.filter("added <> was").drop("was"), "line-changes")
        filters = update_filters(self.filters, crossed, self.shards)
        new._filters = [*self._filters, stored(filters, "line-filters")]
        return new

    def insert(self, docs: DataFrame) -> LineStore:
        """Add documents; those already held gain the lines they did not have."""
        given = stored(references(docs, self.key, self.text, self.min_chars), "line-given")
        touched = stored(given.select("line").distinct(), "line-touched")
        known = self._held([part.join(touched, "line", "left_semi") for part in self._refs])
        on = (given["line"] == known["line"]) & given["doc"].eqNullSafe(known["doc"])
        gained = given.join(known, on, "left_anti")
        return self._changed(gained.withColumn("held", F.lit(True)), touched)

    def delete(self, keys: DataFrame) -> LineStore:
        """Forget the documents whose keys the first column of ``keys`` lists."""
        gone = stored(keys.select(F.col(keys.columns[0]).alias("gone")).distinct(), "line-gone")
        own = [p.join(gone, p["doc"].eqNullSafe(gone["gone"]), "left_semi") for p in self._refs]
        lost = stored(self._held(own).withColumn("held", F.lit(False)), "line-given")
        touched = stored(lost.select("line").distinct(), "line-touched")
        return self._changed(lost, touched)

    def apply(self, docs: DataFrame) -> DataFrame:
        """``docs`` (all or some of the documents held) without their repeated lines; see ``rewrite``.

        An empty store changes no text; texts are taken whole, however long.
        """
        lost = drops(self.refs, self.lines, self.filters, self.shards)
        return rewrite(docs, lost, self.key, self.text, self.min_chars)


def _last(parts: list[DataFrame], key: list[str]) -> DataFrame:
    """Of several tables with the same columns, the last row of each key."""
    if len(parts) == 1:
        return parts[0]
    others = [c for c in parts[0].columns if c not in key]
    numbered = [p.withColumn("step", F.lit(i)) for i, p in enumerate(parts)]
    last = F.max_by(F.struct(*others), "step").alias("last")
    folded = reduce(DataFrame.unionByName, numbered).groupBy(*key).agg(last)
    return folded.select(*key, "last.*")
