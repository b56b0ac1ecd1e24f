"""Fill-in-middle transformation by repeated-capture matching.

A text is a sequence of units: runs of ASCII letters, and every other character on its own. One
``fullmatch`` of ``(unit)*`` keeps where each repetition ended; the number of ends is the number of
units, and both cuts are looked up among them. The middle then moves to the end of the text.

Matching runs in Arrow batches; drawing, cutting and rebuilding are DataFrame functions. Rows do not
depend on each other, so nothing is shuffled.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import importable

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SEED = "1:"
INFILL_PERCENT = 90  # texts that are rearranged
SUFFIX_FIRST_PERCENT = 20  # of those, with the suffix before the prefix

#: A longer text is matched in parts of about this many characters: every repetition that is kept
#: takes some 150 bytes while its part is matched.
PART_CHARS = 1 << 20

# No unit goes over a place with something else than a letter on either side.
_BETWEEN_UNITS = re.compile(r"(?<![A-Za-z])|(?![A-Za-z])")


@lru_cache(maxsize=1)
def _units():
    import regex

    return regex.compile(r"([A-Za-z]+|[^A-Za-z])*")


def ends(text: str) -> list[int]:
    """Where each unit of the text ends, in code points."""
    return _units().fullmatch(text).ends(1)


def parts(text: str) -> Iterator[tuple[int, int]]:
    """[start, end) of pieces of a text that share no unit; a long run of letters stays whole."""
    start = 0
    while len(text) - start > PART_CHARS:
        end = _BETWEEN_UNITS.search(text, start + PART_CHARS).start()
        yield start, end
        start = end
    yield start, len(text)


def cuts(text: str, first: int, second: int) -> tuple[int, int, int]:
    """Units of the text, and the ends of its prefix and middle in code points.

    ``first`` and ``second`` are reduced modulo one more than the units; the prefix has as many units
    as the smaller remainder says, prefix and middle together as many as the larger.
    """
    if len(text) <= PART_CHARS:
        found = [0, *ends(text)]
        n = len(found) - 1
        low, high = sorted((first % (n + 1), second % (n + 1)))
        return n, found[low], found[high]
    spans = list(parts(text))
    counts = [len(ends(text[a:b])) for a, b in spans]
    n = sum(counts)
    wanted = sorted((first % (n + 1), second % (n + 1)))
    at, before = [], 0
    for (a, b), size in zip(spans, counts):
        inside = [w - before for w in wanted[len(at) :] if w - before <= size]
        if inside:
            found = [0, *ends(text[a:b])]
            at += [a + found[w] for w in inside]
        before += size
    return n, *at


_CUTS = ["n", "prefix_end", "middle_end"]


@F.arrow_udf(T.StructType([T.StructField(c, T.LongType()) for c in _CUTS]))
def _cut(text: pa.Array, first: pa.Array, second: pa.Array) -> pa.Array:
    found = [
        cuts(t.as_py(), a, b) for t, a, b in zip(text, first.to_pylist(), second.to_pylist())
    ]
    columns = zip(*found) if found else [()] * 3
    return pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in columns], _CUTS)


def draws(key: Column, seed: str = SEED) -> list[Column]:
    """Four numbers below 2^32 that depend on the key alone; a NULL key draws as an empty one."""
    digest = F.sha2(
        F.concat(F.lit(seed), F.coalesce(key.cast("string"), F.lit(""))).cast("binary"), 256
    )
    return [F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("long") for i in range(4)]


def infill(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    seed: str = SEED,
    infill_percent: int = INFILL_PERCENT,
    suffix_first_percent: int = SUFFIX_FIRST_PERCENT,
) -> DataFrame:
    """(key, n, form, prefix_chars, middle_chars, output) of every row, repeated rows included.

    ``n`` counts the units of the text. ``form`` is ``plain`` for texts left as they are (``output`` is
    the text, both lengths are NULL): a share of all, empty and NULL texts, and texts that hold one of
    the three marks. Otherwise it is ``psm`` or ``spm`` by the order of the parts in ``output``. Equal
    keys draw alike. Texts of any length are matched whole; an empty table gives no rows, and columns
    other than key and text may have any name.
    """
    importable(docs.sparkSession)
    first, second, third, fourth = draws(F.col("id"), seed)
    rows = docs.select(F.col(key).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    found = rows.withColumn("cut", _cut("text", first, second))
    whole, size = F.col("text"), F.length("text")
    marked = [F.contains(whole, F.lit(m)) for m in (PREFIX, SUFFIX, MIDDLE)]
    plain = (size == 0) | marked[0] | marked[1] | marked[2] | (third % 100 >= infill_percent)
    start, end = F.col("cut.prefix_end"), F.col("cut.middle_end")
    formed = found.select(
        "id",
        "text",
        F.col("cut.n").alias("n"),
        start.cast("int").alias("start"),
        end.cast("int").alias("end"),
        F.when(plain, "plain")
        .when(fourth % 100 < suffix_first_percent, "spm")
        .otherwise("psm")
        .alias("form"),
    )
    start, end, form = F.col("start"), F.col("end"), F.col("form")
    prefix = F.substring(whole, F.lit(1), start)
    middle = F.substring(whole, start + 1, end - start)
    suffix = F.substring(whole, end + 1, size - end)
    marks = [F.lit(m) for m in (PREFIX, SUFFIX, MIDDLE)]
    output = (
        F.when(form == "plain", whole)
        .when(form == "psm", F.concat(marks[0], prefix, marks[1], suffix, marks[2], middle))
        .otherwise(F.concat(marks[1], suffix, marks[0], prefix, marks[2], middle))
    )
    moved = form != "plain"
    return formed.select(
        F.col("id").alias(key),
        "n",
        "form",
        F.when(moved, start.cast("long")).alias("prefix_chars"),
        F.when(moved, (end - start).cast("long")).alias("middle_chars"),
        output.alias("output"),
    )


def restore(output: Column, form: Column) -> Column:
    """The text from what ``infill`` made of it.

    The parts hold no mark, and none can arise where a part meets one, so the first place of a mark
    is the one that was set.
    """

    def between(first: str, second: str) -> list[Column]:
        """What stands after the opening mark, after the second and after the middle's."""
        at = F.locate(second, output)
        last = F.locate(MIDDLE, output)
        width = len(PREFIX)
        return [
            F.substring(output, F.lit(1 + len(first)), at - 1 - len(first)),
            F.substring(output, at + width, last - at - width),
            F.substring(output, last + width, F.length(output)),
        ]

    prefix, suffix, middle = between(PREFIX, SUFFIX)
    suffix2, prefix2, middle2 = between(SUFFIX, PREFIX)
    return (
        F.when(form == "plain", output)
        .when(form == "psm", F.concat(prefix, middle, suffix))
        .otherwise(F.concat(prefix2, middle2, suffix2))
    )
