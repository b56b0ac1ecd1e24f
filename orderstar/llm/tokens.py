"""Token ids and token counts of a tokenizer file.

Counting works on pre-tokens: a text is split once, the pieces of each distinct pre-token are counted
once over the whole corpus, and a document's count is the sum over its pre-token frequencies. Ids are
never built for documents.

Frequencies stay together in blocks of documents, so that what is shuffled is one row per distinct
pre-token of a block, not one per word.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import importable, stored

BLOCK_PRETOKENS = 400_000  # distinct pre-tokens of a block before it is closed
BLOCK_BYTES = 64 << 20
RUN = 5_000  # pre-tokens of a block listed in one row

# Fixed value: the published split pattern of byte-level BPE vocabularies.
_SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
# Character classes of the libraries differ above U+0557 for newly assigned letters.
_UNUSUAL = re.compile("[\u0558-\u200f\u2060-\U0010ffff]")


@lru_cache(maxsize=1)
def encoder(path: str) -> Encoder:
    """One encoder per Python worker, for all the tasks it runs."""
    return Encoder(path)


class Encoder:
    """A ``tokenizers`` file, with short cuts that give the same ids and pre-tokens.

    Special strings inside texts become their special id, as the library does by default. What a use
    does not need (the library, the faster encoder) is not loaded.
    """

    def __init__(self, path: str):
        import regex

        self.path = path
        with open(path, encoding="utf-8") as file:
            described = json.load(file)
        tokens = described["added_tokens"]
        self.size = 1 + max([t["id"] for t in tokens] + [len(described["model"]["vocab"]) - 1])
        self.id_type = "<u2" if self.size <= 1 << 16 else "<u4"
        added = sorted((t["content"] for t in tokens), key=len, reverse=True)
        self.special = re.compile("(" + "|".join(map(re.escape, added)) + ")") if added else None
        before = described["pre_tokenizer"] or {}
        self.byte_level = (
            not any(t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"] for t in tokens)
            and described["normalizer"] is None
            and before.get("type") == "ByteLevel"
            and before.get("use_regex", True)
            and not before.get("add_prefix_space")
        )
        self._may_cut = self.byte_level and not any(" " in content for content in added)
        self._split = regex.compile(_SPLIT).findall

    @cached_property
    def library(self):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        loaded = Tokenizer.from_file(self.path)
        loaded.no_truncation()
        loaded.no_padding()
        return loaded

    @cached_property
    def _fast(self):
        """The same vocabulary as byte ranks, for a faster encoder; None if it isn't one by rank."""
        if not self.byte_level:
            return None
        import tiktoken

        with open(self.path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
        hidden = [b for b in range(256) if b not in shown]
        byte = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        numbers = [model["vocab"].get(a + b, -1) for a, b in pairs]
        if numbers != sorted(set(numbers)) or -1 in numbers:
            return None
        ranks = {bytes(byte[c] for c in piece): number for piece, number in model["vocab"].items()}
        return tiktoken.Encoding(
            "ranks", pat_str=_SPLIT, mergeable_ranks=ranks, special_tokens={}
        ).encode_ordinary

    def segments(self, text: str) -> Iterator[str]:
        """A long text in parts that are encoded independently of each other.

        Before a single space between other characters and a letter the split pattern always cuts.
        """
        start = 0
        while self._may_cut and len(text) - start > TEXT_CHARS:
            cut = _SAFE_CUT.search(text, start + TEXT_CHARS)
            if not cut:
                break
            yield text[start : cut.start()]
            start = cut.start()
        yield text[start:]

    def ids(self, text: str) -> np.ndarray:
        """All ids of the text, in the narrowest type that holds the vocabulary."""
        parts = [np.array(self._ids(part), dtype=self.id_type) for part in self.segments(text)]
        return np.concatenate(parts) if len(parts) > 1 else parts[0]

    def _ids(self, text: str) -> list[int]:
        plain = not (self.special and self.special.search(text)) and not _LONG_RUN.search(text)
        if plain and self._fast:
            return self._fast(text)
        return self.library.encode(text, add_special_tokens=False).ids

    def pretokens(self, text: str) -> list[str]:
        """Pieces of the text that are encoded independently of each other."""
        if not self.byte_level:
            return [text] if text else []
        parts = self.special.split(text) if self.special else [text]
        found: list[str] = []
        for i, part in enumerate(parts):
            if i % 2:
                found.append(part)
            elif _UNUSUAL.search(part):
                spans = self.library.pre_tokenizer.pre_tokenize_str(part)
                found.extend(part[a:b] for _, (a, b) in spans)
            else:
                found.extend(self._split(part))
        return found

    def counts(self, pretokens: list[str]) -> list[int]:
        encoded = self.library.encode_batch_fast(pretokens, add_special_tokens=False)
        return [len(one.ids) for one in encoded]


TEXT_CHARS = 4 << 20  # of a long text that are encoded at a time
_SAFE_CUT = re.compile(r"(?<=\S) (?=[A-Za-z])")
# Runs the fast encoder may take very long or much stack for.
_LONG_RUN = re.compile(r"\s{5000}|[^\W\d_]{20000}|\d{20000}|[^\s\w]{20000}")


def _frequencies(docs: DataFrame, tokenizer: str, key: str, text: str) -> DataFrame:
    """Two kinds of rows per block: documents with the frequencies of their pre-tokens, given by their
    code in the block (packed, see ``_packed``), and the block's distinct pre-tokens in runs, ``first``
    being a run's first code.
    """
    rows = docs.select(F.col(key).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = rows.select("id", F.octet_length("text").cast("long").alias("n_bytes"), "text")
    schema = T.StructType(
        [
            T.StructField("block", T.LongType()),
            T.StructField("id", rows.schema["id"].dataType),
            T.StructField("n_bytes", T.LongType()),
            T.StructField("frequencies", T.BinaryType()),
            T.StructField("first", T.IntegerType()),
            T.StructField("pretokens", T.ArrayType(T.StringType())),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(tokenizer)
        block, place, size = TaskContext.get().partitionId() << 33, {}, 0

        def vocabulary():
            firsts = range(0, len(place), RUN)
            n, listed = len(firsts), list(place)
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([block] * n, pa.int64()),
                    pa.nulls(n, id_type),
                    pa.nulls(n, pa.int64()),
                    pa.nulls(n, pa.binary()),
                    pa.array(firsts, pa.int32()),
                    pa.array([listed[i : i + RUN] for i in firsts], pa.list_(pa.string())),
                ],
                names=schema.names,
            )

        for batch in batches:
            id_type, blocks, packed, full = batch.column(0).type, [], [], []
            lengths = batch.column(1).to_pylist()
            for length, value in zip(lengths, batch.column(2)):
                found = [
                    np.array([place.setdefault(p, len(place)) for p in coder.pretokens(part)], np.int32)
                    for part in coder.segments(value.as_py())
                ]
                code, often = np.unique(np.concatenate(found), return_counts=True)
                blocks.append(block)
                packed.append(_packed(code, often))
                size += length
                if len(place) >= BLOCK_PRETOKENS or size >= BLOCK_BYTES:
                    full.append(vocabulary())
                    block, place, size = block + 1, {}, 0
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(blocks, pa.int64()),
                    batch.column(0),
                    batch.column(1),
                    pa.array(packed, pa.binary()),
                    pa.nulls(len(blocks), pa.int32()),
                    pa.nulls(len(blocks), pa.list_(pa.string())),
                ],
                names=schema.names,
            )
            yield from full
        if place:
            yield vocabulary()

    return rows.mapInArrow(run, schema)


def _packed(codes: np.ndarray, times: np.ndarray) -> bytes:
    """Sorted codes as steps, and how often each occurs, byte by byte so that they compress well.

    Pre-tokens a block has not seen before get the next codes, so most steps are 1.
    """
    import zstandard

    steps = np.diff(codes, prepend=0)
    both = np.concatenate((steps, times)).astype("<u4")
    return zstandard.compress(both.view(np.uint8).reshape(-1, 4).T.tobytes(), 3)


def _unpacked(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    import zstandard

    planes = np.frombuffer(zstandard.decompress(raw), dtype=np.uint8).reshape(4, -1)
    both = np.ascontiguousarray(planes.T).view("<u4").ravel()
    half = len(both) // 2
    return np.cumsum(both[:half], dtype=np.int64), both[half:].astype(np.int64)


def _piece_counts(listed: DataFrame, tokenizer: str) -> DataFrame:
    """(of, packed codes and pieces) of all listed pre-tokens, one row per block and batch.

    All rows of a pre-token lie side by side in one partition, so it is encoded once.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(tokenizer)
        last, pieces = None, 0
        for batch in batches:
            runs = pa.compute.run_end_encode(batch.column(0))
            ends, values = runs.run_ends.to_numpy(), runs.values.to_pylist()
            again = values[:1] == [last]  # the last pre-token may go on in the next batch
            counts = [pieces] if again else []
            counts = np.array(counts + coder.counts(values[again:]), dtype=np.int64)
            if values:
                last, pieces = values[-1], counts[-1]
            per_row = np.repeat(counts, np.diff(ends, prepend=0))
            blocks, codes = batch.column(1).to_numpy(), batch.column(2).to_numpy()
            order = np.lexsort((codes, blocks))
            blocks, codes, per_row = blocks[order], codes[order], per_row[order]
            starts = np.flatnonzero(np.diff(blocks, prepend=-1))
            packed = [
                _packed(codes[i:j], per_row[i:j]) for i, j in zip(starts, [*starts[1:], len(blocks)])
            ]
            yield pa.RecordBatch.from_arrays(
                [pa.array(blocks[starts]), pa.array(packed, pa.binary())], names=["of", "packed"]
            )

    dealt = listed.repartition("pretoken").sortWithinPartitions("pretoken")
    return dealt.select("pretoken", "block", "code").mapInArrow(run, "of long, packed binary")


def count_tokens(
    docs: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(key, n_bytes, n_tokens) of every row, repeated rows included; a NULL text counts as empty.

    ``n_tokens`` is what the library gives for the whole text without added special tokens.
    """
    importable(docs.sparkSession)
    rows = stored(_frequencies(docs, tokenizer, key, text), "frequencies")
    listed = rows.filter("first IS NOT NULL").select(
        "block", "first", F.posexplode("pretokens").alias("at", "pretoken")
    ).select("block", (F.col("first") + F.col("at")).alias("code"), "pretoken")
    known = _piece_counts(listed, tokenizer)
    texts = rows.filter("first IS NULL").select("block", "id", "n_bytes", "frequencies")
    schema = T.StructType(
        [
            T.StructField(key, rows.schema["id"].dataType),
            T.StructField("n_bytes", T.LongType()),
            T.StructField("n_tokens", T.LongType()),
        ]
    )

    def total(block: pa.Table, vocabulary: pa.Table) -> pa.Table:
        """Documents of a block; what is together here is bounded by the size of a block."""
        known = [_unpacked(raw.as_py()) for raw in vocabulary["packed"]]
        pieces = np.zeros(1 + max((codes[-1] for codes, _ in known), default=0), dtype=np.int64)
        for codes, counts in known:
            pieces[codes] = counts
        tokens = []
        for raw in block["frequencies"]:
            codes, times = _unpacked(raw.as_py())
            tokens.append(int(pieces[codes] @ times))
        return pa.table([block["id"], block["n_bytes"], pa.array(tokens, pa.int64())], names=schema.names)

    return (
        texts.groupBy("block")
        .cogroup(known.groupBy("of"))
        .applyInArrow(total, schema)
    )
