"""Language identification by compression.

Per language a raw-content zstandard dictionary is filled with text in that language. A text is cut
into short blocks, each compressed with every dictionary; the language whose dictionary gives the
fewest bytes in all wins. Short blocks keep the dictionary the main source of matches however long
the text is, and bound the memory of a task. Where languages come within a hundredth of the best, they
are compared once more by the mean over sixteen smaller dictionaries each, which tells sizes apart that
whole bytes of one encoding cannot. Margins that stay narrow are rejected.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import importable

SAMPLE_ROWS = 256  # labelled rows taken per language
SAMPLE_CHARS = 4_000  # at most so much of each, so that many texts fit
DICTIONARY_BYTES = 128 * 1024
TOTAL_BYTES = 64 * DICTIONARY_BYTES  # of all dictionaries; with more than 64 labels each is smaller
LEAST_BYTES = 1024  # but never smaller than this, however many labels there are
BLOCK_BYTES = 1024
LEVEL = 9
NARROW = 0.01  # closer languages are compared again with every sixteenth of their dictionaries
PARTS = 16
MIN_MARGIN = 0.003
UNKNOWN = "und"


@dataclass(frozen=True)
class LanguageModel:
    """Dictionary bytes per language, the most frequent label first."""

    dictionaries: dict[str, bytes]


def dictionary_bytes(labels: int) -> int:
    """Size of each dictionary: the more labels, the smaller, so that all together stay bounded."""
    return max(LEAST_BYTES, min(DICTIONARY_BYTES, TOTAL_BYTES // max(1, labels)))


def fit(
    docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang"
) -> LanguageModel:
    """Fill dictionaries from labelled rows.

    The sample is bounded: per language the ``SAMPLE_ROWS`` rows with the smallest hash of their key,
    ``SAMPLE_CHARS`` characters of each, up to ``dictionary_bytes``. Every label gets a dictionary. Rows
    without text or label are not used. Equal samples are used once.
    """
    labelled = docs.select(
        F.col(key).alias("key"), F.col(text).alias("text"), F.col(lang).alias("lang")
    ).filter("lang IS NOT NULL AND length(trim(text)) > 0")
    sizes = labelled.groupBy("lang").agg(F.count("*").alias("size"))
    largest = sizes.orderBy(F.desc("size"), "lang").collect()  # one row per label
    share = dictionary_bytes(len(largest))
    sizes = docs.sparkSession.createDataFrame(largest, sizes.schema)
    # Only keys are ranked, and of a large language only about twice as many as are wanted.
    place = F.shiftrightunsigned("hash", 11) / float(1 << 53)
    order = Window.partitionBy("lang").orderBy("hash", "key", "text")
    narrow = Window.partitionBy("lang").orderBy("hash", "key")
    chosen = (
        labelled.select("lang", "key", F.xxhash64("key").alias("hash"))
        .join(F.broadcast(sizes), "lang")  # one row per label
        .filter(place * F.col("size") < 2 * SAMPLE_ROWS)
        .withColumn("rank", F.row_number().over(narrow))
        .filter(F.col("rank") <= SAMPLE_ROWS)
        .select("lang", F.col("key").alias("chosen"))
        .distinct()
    )
    if len(largest) * DICTIONARY_BYTES <= TOTAL_BYTES:
        chosen = F.broadcast(chosen)  # SAMPLE_ROWS per label
    on = (labelled["lang"] == chosen["lang"]) & labelled["key"].eqNullSafe(chosen["chosen"])
    sample = (
        labelled.join(chosen, on, "left_semi")
        .select("lang", "key", F.left("text", F.lit(SAMPLE_CHARS)).alias("text"))
        .distinct()
        .withColumn("hash", F.xxhash64("key"))
        .withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= SAMPLE_ROWS)
    )
    # Only what can enter a dictionary goes to the driver: a byte a character at least, copies once.
    earlier = Window.partitionBy("lang").orderBy("rank").rowsBetween(Window.unboundedPreceding, -1)
    sample = (
        sample.groupBy("lang", "text")
        .agg(F.min("rank").alias("rank"))
        .withColumn("before", F.coalesce(F.sum(F.length("text")).over(earlier), F.lit(0)))
        .filter(F.col("before") < 2 * share)  # twice, as lower-casing can make more copies
    )
    filled: dict[str, dict[bytes, None]] = {}
    for row in sorted(sample.collect(), key=lambda r: (r["lang"], r["rank"])):
        filled.setdefault(row["lang"], {})[row["text"].lower().encode()] = None
    return LanguageModel(
        {r["lang"]: b"\n".join(filled[r["lang"]])[:share] for r in largest if r["lang"] in filled}
    )


class Compressors:
    """Compressed sizes of blocks under the dictionaries of a model."""

    def __init__(self, model: LanguageModel):
        self.names = list(model.dictionaries)
        self._contents = list(model.dictionaries.values())
        self._whole = [self._compressor(content) for content in self._contents]
        self._parts: dict[int, list] = {}  # made when first needed

    @staticmethod
    def _compressor(content: bytes):
        import zstandard

        shared = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        shared.precompute_compress(level=LEVEL)
        made = zstandard.ZstdCompressor(
            level=LEVEL, dict_data=shared, write_content_size=False, write_checksum=False
        )
        return made.compress

    def sizes(self, blocks: list[bytes]) -> list[float]:
        return [sum(len(compress(block)) for block in blocks) for compress in self._whole]

    def mean_size(self, language: int, blocks: list[bytes]) -> float:
        if language not in self._parts:
            content = self._contents[language]
            step = max(64, -(-len(content) // PARTS))
            self._parts[language] = [
                self._compressor(content[at : at + step]) for at in range(0, len(content), step)
            ]
        parts = self._parts[language]
        return sum(len(compress(block)) for compress in parts for block in blocks) / len(parts)


def classify(text: str | None, coders: Compressors) -> tuple[str, float, float]:
    """(language, score, margin) of one text; ties go to the more frequent label."""
    import math

    if not coders.names or not text or not any(map(str.isalpha, text)):
        return UNKNOWN, 0.0, 0.0
    raw = text.lower().encode("utf-8", "replace")
    blocks = [raw[at : at + BLOCK_BYTES] for at in range(0, len(raw), BLOCK_BYTES)]
    sizes = coders.sizes(blocks)
    close = [i for i, size in enumerate(sizes) if size <= min(sizes) / (1 - NARROW)]
    if len(close) > 1:
        again = {i: coders.mean_size(i, blocks) for i in close}
        # The others lie further behind than the smallest dictionaries cost.
        worse = max(again.values()) - min(sizes)
        sizes = [again.get(i, size + worse) for i, size in enumerate(sizes)]
    best, *others = sorted(range(len(sizes)), key=lambda i: sizes[i])
    score = 1 / sum(math.exp(-min(50.0, (size - sizes[best]) / 4)) for size in sizes)
    margin = 1 - sizes[best] / sizes[others[0]] if others else 1.0
    return coders.names[best], score, margin


def identify(
    docs: DataFrame,
    model: LanguageModel,
    text: str = "text",
    columns: list[str] | None = None,
    min_margin: float = MIN_MARGIN,
) -> DataFrame:
    """Add lang_pred, score, margin and accepted to the named columns (default: all) of every row.

    ``score`` is the share of the winner when each byte saved counts a quarter nat; ``margin`` how
    much smaller the best encoding is than the second; ``accepted`` is false where the margin is
    below ``min_margin`` or the text is NULL or has no letter (``lang_pred`` is then ``und``).
    Columns of the same names in ``docs`` are replaced. The language of a row depends on its text
    only.
    """
    added = {
        "lang_pred": T.StringType(),
        "score": T.DoubleType(),
        "margin": T.DoubleType(),
        "accepted": T.BooleanType(),
    }
    kept = [c for c in (docs.columns if columns is None else columns) if c not in added]
    read = kept if text in kept else [*kept, text]
    rows, at = docs.select(*(docs[c] for c in read)), read.index(text)
    schema = T.StructType(
        [T.StructField(c, docs.schema[c].dataType) for c in kept]
        + [T.StructField(c, kind) for c, kind in added.items()]
    )
    importable(rows.sparkSession)
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coders = Compressors(shared.value)
        for batch in batches:
            found = [classify(t.as_py(), coders) for t in batch.column(at)]
            langs, scores, margins = zip(*found) if found else ((), (), ())
            accepted = [l != UNKNOWN and m >= min_margin for l, m in zip(langs, margins)]
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns[: len(kept)],
                    pa.array(langs, pa.string()),
                    pa.array(scores, pa.float64()),
                    pa.array(margins, pa.float64()),
                    pa.array(accepted, pa.bool_()),
                ],
                names=schema.names,
            )

    return rows.mapInArrow(run, schema)


def held_out(key: Column) -> Column:
    """Rows no model may learn from: crc32 of the key's text is 2 modulo 4. A NULL key counts as ''."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % 4 == 2
