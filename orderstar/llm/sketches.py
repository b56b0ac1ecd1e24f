"""Threshold-scaled sketches of documents.

A sketch keeps every shingle hash below a fixed fraction of the hash range. Its size follows the
document, so the sketch of a union is the union of sketches, and what part of a short text lies in a
long one can be told from the two sketches alone. The smallest hash is kept besides, for texts too
short to have any hash below the threshold.
"""

from __future__ import annotations

import math

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import ascii_lower, unused

SHINGLE = 5
FRACTION_BITS = 2  # hashes below a quarter of the range are kept
BUCKET_ROWS = 1_000  # neighbours are looked for inside buckets of about so many rows
MAX_BUCKETS = 100_000  # what the driver holds of them; beyond it buckets grow, and their windows spill


def words(text: Column) -> Column:
    """Runs of characters other than ASCII white space, A-Z lower-cased; NULL has none."""
    lower = ascii_lower(F.coalesce(text, F.lit("")))
    return F.array_remove(F.split(lower, r"[\x20\x09-\x0D]+", -1), "")


def hashes(own: Column, shingle: int = SHINGLE) -> Column:
    """Hash of each run of ``shingle`` words; of all words where there are fewer; none without words."""
    count = F.size(own)
    runs = F.transform(
        F.sequence(F.lit(0), F.greatest(count - shingle, F.lit(0))),
        lambda i: F.xxhash64(*(F.get(own, i + k) for k in range(shingle))),
    )
    return F.when(count > 0, runs).otherwise(F.array().cast("array<bigint>"))


def sketch(all_hashes: Column, fraction_bits: int = FRACTION_BITS) -> Column:
    """Struct of the kept hashes, sorted, and the smallest hash of all (NULL without shingles)."""
    kept = F.filter(all_hashes, lambda h: F.shiftrightunsigned(h, 64 - fraction_bits) == 0)
    return F.struct(
        F.array_sort(F.array_distinct(kept)).alias("kept"),
        F.array_min(all_hashes).alias("smallest"),
    )


def merged(a: Column, b: Column) -> Column:
    """Sketch of two texts' shingles together."""
    return F.struct(
        F.array_sort(F.array_union(a["kept"], b["kept"])).alias("kept"),
        F.least(a["smallest"], b["smallest"]).alias("smallest"),
    )


def containment(a: Column, b: Column) -> Column:
    """Estimated part of the smaller text's shingles that the larger one has too, 0 to 1.

    Where a sketch holds no hash the smallest hashes decide: 1 if equal (two empty texts too), else 0.
    """
    least = F.least(F.size(a["kept"]), F.size(b["kept"]))
    shared = F.size(F.array_intersect(a["kept"], b["kept"]))
    same = a["smallest"].eqNullSafe(b["smallest"]).cast("double")
    return F.when(least > 0, shared / least).otherwise(same)


def shown(one: Column) -> Column:
    """The smallest hash and the kept ones in hexadecimal."""
    kept = F.array_join(F.transform(one["kept"], lambda h: F.lower(F.hex(h))), ",")
    return F.concat(F.coalesce(F.lower(F.hex(one["smallest"])), F.lit("")), F.lit(":"), kept)


def fingerprints(docs: DataFrame, text: str = "text", name: str = "sketch") -> DataFrame:
    """Add the sketch of every row's text; a column of that name is replaced."""
    kept = [c for c in docs.columns if c != name]
    spelled, hashed = unused(kept, "words"), unused(kept, "hashes")
    rows = docs.select(*(docs[c] for c in kept), words(docs[text]).alias(spelled))
    rows = rows.select(*kept, hashes(F.col(spelled)).alias(hashed))
    return rows.select(*kept, sketch(F.col(hashed)).alias(name))


def with_next(
    docs: DataFrame, key: str = "doc_id", bucket_rows: int = BUCKET_ROWS
) -> tuple[DataFrame, Window]:
    """Rows dealt by descending key into buckets, and the window in which ``lead`` finds the next row.

    Adds ``_bucket`` and ``_guest``. The first rows of each bucket also visit the bucket before, the
    very first rows the last bucket; after ``lead``, rows with ``_guest`` have to go. Text keys are
    ordered by their bytes, the first six of which decide the bucket; NULL keys come last. Texts move in
    one shuffle only.
    """
    place = F.col("_key").cast("double")
    if isinstance(docs.schema[key].dataType, T.StringType):
        first = F.rpad(F.hex(F.substring(F.col("_key").cast("binary"), 1, 6)), 12, "0")
        place = F.conv(first, 16, 10).cast("double")
    rows = docs.withColumn("_key", docs[key])
    count = docs.count()
    parts = min(MAX_BUCKETS, max(1, -(-count // bucket_rows)))
    cuts = []
    if parts > 1:
        at = [i / parts for i in range(1, parts)]
        found = rows.agg(
            F.percentile_approx(place, at, max(10_000, 10 * parts)).alias("cuts")
        ).first()["cuts"]
        cuts = sorted(set(found or []))  # one number per bucket
    rows = _bucketed(rows.withColumn("_place", place), cuts)
    heads = rows.groupBy("_bucket").agg(F.max("_key").alias("_head")).collect()  # one row per bucket
    if not heads:
        visits = [(0, None, 0)]
    else:
        heads = sorted(heads, key=lambda r: r["_bucket"])
        before = [heads[-1], *heads[:-1]]
        visits = [(own["_bucket"], own["_head"], to["_bucket"]) for own, to in zip(heads, before)]
    kind = rows.schema["_key"].dataType.simpleString()
    visiting = rows.sparkSession.createDataFrame(visits, f"_of int, _head {kind}, _to int")
    on = (F.col("_bucket") == F.col("_of")) & F.col("_key").eqNullSafe(F.col("_head"))
    stays = F.struct(F.col("_bucket").alias("bucket"), F.lit(0).alias("guest"))
    visit = F.struct(F.col("_to").alias("bucket"), F.lit(1).alias("guest"))
    sent = (
        rows.join(F.broadcast(visiting), on, "left")  # one row per bucket
        .withColumn(
            "_sent", F.explode(F.when(F.col("_to").isNull(), F.array(stays)).otherwise(F.array(stays, visit)))
        )
        .select(*docs.columns, "_key", "_sent.*")
        .withColumnsRenamed({"bucket": "_bucket", "guest": "_guest"})
        .repartition("_bucket")
    )
    return sent, Window.partitionBy("_bucket")


def _bucketed(rows: DataFrame, cuts: list[float]) -> DataFrame:
    """Add ``_bucket`` from ``_place``: bucket 0 holds the largest keys, the last one the NULLs."""
    splits = [-math.inf, *(cuts or [0.0]), math.inf]  # two buckets at least
    cuts = splits[1:-1]
    found = Bucketizer(
        splits=splits, inputCol="_place", outputCol="_from_below"
    ).setHandleInvalid("keep")
    above = F.lit(len(cuts)) - F.col("_from_below").cast("int")
    last = F.lit(len(cuts) + 1)
    placed = found.transform(rows).withColumn(
        "_bucket", F.when(F.col("_place").isNull(), last).otherwise(above)
    )
    return placed.drop("_place", "_from_below")


def against_next(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Every row's sketch, that of its edited text, and how like they and the next row's are.

    The edited text has the last third of its code points replaced by the first as many (or all) of
    the next row's text, in descending order of the key and, among equal keys, ascending of the text.
    After the last row comes the first, so a single row is its own next. NULL texts count as empty.
    """
    plain = docs.select(docs[key].alias("id"), F.coalesce(docs[text], F.lit("")).alias("text"))
    dealt, window = with_next(plain, "id")
    sketched = fingerprints(dealt)
    order = window.orderBy("_guest", F.desc_nulls_last("_key"), "text")
    placed = sketched.select(
        "id",
        "text",
        "sketch",
        "_guest",
        F.lead("text").over(order).alias("next_text"),
        F.lead("sketch").over(order).alias("next_sketch"),
    ).filter("_guest = 0")
    n = F.char_length("text")
    cut = F.floor(n / 3).cast("int")
    edited = placed.select(
        "*",
        n.cast("long").alias("n_chars"),
        F.concat(F.left("text", n - cut), F.left("next_text", cut)).alias("edited_text"),
    )
    both = fingerprints(edited, "edited_text", "edited_sketch")
    return both.select(
        F.col("id").alias(key),
        "n_chars",
        "edited_text",
        "sketch",
        "edited_sketch",
        containment(F.col("sketch"), F.col("edited_sketch")).alias("near_edited"),
        containment(F.col("sketch"), F.col("next_sketch")).alias("near_next"),
    )
