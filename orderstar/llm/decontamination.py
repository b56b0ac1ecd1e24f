"""Benchmark decontamination: windows of test words looked up in every document.

All windows of the benchmark form a hash set that is broadcast after its size has been measured. The
words of a document are walked once; each place is looked up by the hash of the words that start
there, and a hit is verified word by word. What is found depends on a text only, so hits are kept per
text digest: copies add nothing, and rows need no identity of their own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import ascii_lower, stored

WINDOW = 10
#: Larger window sets are joined without a hint, by shuffling the places of all words.
BROADCAST_BYTES = 256 << 20
_SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"  # after lower-casing
_ANY_CASE = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """Runs of a-z, 0-9 and non-ASCII characters after lower-casing A-Z; NULL has none."""
    lower = ascii_lower(F.coalesce(text, F.lit("")))
    return F.array_remove(F.split(lower, _SEPARATORS, -1), "")


def text_digest(text: Column) -> Column:
    return F.unhex(F.md5(F.coalesce(text, F.lit("")).cast("binary")))


def _hash(at: Column, size: int) -> Column:
    return F.xxhash64(*(F.get("words", at + i) for i in range(size)))


def _places(rows: DataFrame, sizes: list[int]) -> DataFrame:
    """One row per window of each size: the columns of ``rows``, size, at (from 0) and hash."""
    count = F.size("words")
    # Outer, as an inner explode makes Spark split the text a second time to test for emptiness.
    every = F.explode(F.array(*map(F.lit, sizes))) if len(sizes) > 1 else F.lit(sizes[0])
    for_size = rows.withColumn("size", every)
    starts = F.when(count >= F.col("size"), F.sequence(F.lit(0), count - F.col("size")))
    placed = for_size.withColumn("at", F.explode_outer(starts))
    value = _hash(F.col("at"), sizes[0])
    for size in sizes[1:]:
        value = F.when(F.col("size") == size, _hash(F.col("at"), size)).otherwise(value)
    return placed.withColumn("hash", value)


def _spelled(size: str = "size") -> Column:
    return F.array_join(F.slice("words", F.col("at") + 1, F.col(size)), " ")


def windows(benchmark: DataFrame, item: str = "item_id", text: str = "text", size: int = WINDOW) -> DataFrame:
    """(item, size, hash, spelled) of all windows; an item of fewer words, but some, is one window."""
    items = benchmark.select(F.col(item).alias("item"), words(F.col(text)).alias("words"))
    items = items.filter(F.size("words") > 0)
    split = items.withColumn("size", F.least(F.lit(size), F.size("words")))
    placed = split.withColumn(
        "at", F.explode(F.sequence(F.lit(0), F.size("words") - F.col("size")))
    )
    value = _hash(F.col("at"), size)
    for shorter in range(1, size):
        value = F.when(F.col("size") == shorter, _hash(F.col("at"), shorter)).otherwise(value)
    return placed.select("item", "size", value.alias("hash"), _spelled().alias("spelled")).distinct()


def hits(docs: DataFrame, found: DataFrame, text: str = "text") -> DataFrame:
    """(digest, at, size, spelled) of every occurrence of a window, once per different text."""
    sets = found.select("size", "hash", "spelled").distinct()
    shape = sets.agg(
        F.collect_set("size").alias("sizes"),  # at most WINDOW values
        F.coalesce(F.sum(F.length("spelled") + 24), F.lit(0)).alias("bytes"),
    ).first()
    sizes = sorted(shape["sizes"], reverse=True) or [WINDOW]
    if shape["bytes"] <= BROADCAST_BYTES:
        sets = F.broadcast(sets)
    rows = docs.select(text_digest(docs[text]).alias("digest"), words(docs[text]).alias("words"))
    placed = _places(rows, sizes)
    return (
        placed.alias("p")
        .join(
            sets.alias("w"),
            (F.col("p.hash") == F.col("w.hash"))
            & (F.col("p.size") == F.col("w.size"))
            & (_spelled("p.size") == F.col("spelled")),
        )
        .select("digest", "at", F.col("p.size").alias("size"), "spelled")
        .distinct()
    )


def findings(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    size: int = WINDOW,
) -> DataFrame:
    """Per contaminated text: (digest, n_hit, items, spans); spans are [start, end) in words, merged."""
    found = windows(benchmark, item, item_text, size)
    occurring = stored(hits(docs, found, text), "benchmark-hits")
    before = Window.partitionBy("digest").orderBy("at", "size").rowsBetween(
        Window.unboundedPreceding, -1
    )
    # A span grows while windows overlap or touch.
    places = occurring.groupBy("digest", "at").agg(F.max("size").alias("size"))
    reached = F.coalesce(F.max(F.col("at") + F.col("size")).over(before), F.lit(-1))
    opened = places.select("digest", "at", "size", (F.col("at") > reached).cast("int").alias("new"))
    numbered = opened.withColumn(
        "span", F.sum("new").over(Window.partitionBy("digest").orderBy("at"))
    )
    spans = numbered.groupBy("digest", "span").agg(
        F.min("at").alias("start"), F.max(F.col("at") + F.col("size")).alias("end")
    )
    covered = spans.groupBy("digest").agg(
        F.sum(F.col("end") - F.col("start")).alias("n_hit"),
        F.sort_array(F.collect_list(F.struct("start", "end"))).alias("spans"),
    )
    owners = found.select("spelled", F.col("item").cast("string").alias("item"))
    named = (
        occurring.select("digest", "spelled")
        .distinct()
        .join(owners, "spelled")
        .groupBy("digest")
        .agg(F.array_sort(F.collect_set("item")).alias("items"))
    )
    result = covered.join(named, "digest").select("digest", "n_hit", "items", "spans")
    # Stored, so that joins with the documents have a plain shuffle on both sides: copies of one text
    # can then be split.
    return stored(result, "benchmark-findings")


def _joined(docs: DataFrame, result: DataFrame, text: str, how: str) -> DataFrame:
    own = result.select(*(F.col(c).alias(f"_{c}") for c in result.columns))
    return docs.join(own, text_digest(docs[text]) == own["_digest"], how)


def report(
    docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", **options
) -> DataFrame:
    """(key, n_words, n_hit, items, contaminated) of every row, repeated rows included.

    Texts that are NULL or have no word are clean; an empty benchmark leaves all clean. ``items`` are
    the ids of occurring items as sorted strings.
    """
    result = findings(docs, benchmark, text, **options)
    narrow = docs.select(
        docs[key].alias("key"),
        text_digest(docs[text]).alias("digest"),
        F.size(words(docs[text])).cast("long").alias("n_words"),
    )
    joined = narrow.join(result, "digest", "left")
    return joined.select(
        F.col("key").alias(key),
        "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        F.col("n_hit").isNotNull().alias("contaminated"),
    )


def drop_documents(docs: DataFrame, benchmark: DataFrame, text: str = "text", **options) -> DataFrame:
    """``docs`` without the rows in which any window occurs."""
    return _joined(docs, findings(docs, benchmark, text, **options), text, "left_anti")


def cut_spans(docs: DataFrame, benchmark: DataFrame, text: str = "text", **options) -> DataFrame:
    """``docs`` with every hit word, and what separates it from the word before, taken out."""
    # The other columns go out of the way of those that are added here.
    others = [c for c in docs.columns if c != text]
    rows = docs.select(F.col(text).alias("text"), F.struct(*others, F.lit(0)).alias("others"))
    joined = _joined(rows, findings(rows, benchmark, "text", **options), "text", "left")
    separators = F.split(F.col("text"), f"(?:(?!{_ANY_CASE})[\\s\\S])+", -1)
    own = F.array_remove(F.split(F.col("text"), _ANY_CASE, -1), "")
    gone = F.flatten(
        F.transform("_spans", lambda s: F.sequence(s["start"], s["end"] - 1))
    )
    rows = joined.withColumns({"_own": own, "_between": separators})
    left = F.array_except(F.sequence(F.lit(0), F.size("_own") - 1), gone)
    kept = F.array_join(
        F.transform(left, lambda i: F.concat(F.get("_between", i), F.get("_own", i))), ""
    )
    clean = F.concat(kept, F.get("_between", F.size("_own")))
    text_left = F.when(F.col("_spans").isNull(), F.col("text")).otherwise(clean)
    return rows.select(
        *(
            text_left.alias(c) if c == text else F.col("others").getField(c).alias(c)
            for c in docs.columns
        )
    )
