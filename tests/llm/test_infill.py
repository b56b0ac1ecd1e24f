import hashlib
import re

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderstar.llm import infill


def plainly(key, text):
    """(n, form, prefix_chars, middle_chars, output), stated without captures."""
    text = text or ""
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    digest = hashlib.sha256(f"1:{'' if key is None else key}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[i : i + 8], 16) for i in range(0, 32, 8))
    low, high = sorted((h1 % (len(units) + 1), h2 % (len(units) + 1)))
    prefix, middle = "".join(units[:low]), "".join(units[low:high])
    suffix = "".join(units[high:])
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return len(units), "plain", None, None, text
    if h4 % 100 < 20:
        output, form = f"<S>{suffix}<P>{prefix}<M>{middle}", "spm"
    else:
        output, form = f"<P>{prefix}<S>{suffix}<M>{middle}", "psm"
    return len(units), form, len(prefix), len(middle), output


def check(rows, docs):
    made = infill.infill(docs)
    back = made.withColumn("back", infill.restore(F.col("output"), F.col("form")))
    found = [tuple(r) for r in back.collect()]
    wanted = [(k, *plainly(k, t), t or "") for k, t in rows]
    assert sorted(found, key=str) == sorted(wanted, key=str)
    return found


def test_whole_table(docs, texts):
    assert {row[2] for row in check(texts, docs)} == {"plain", "psm", "spm"}


def test_odd_rows(odd, odd_rows):
    check(odd_rows, odd)


def test_marks_and_places_like_marks(make):
    """Texts with a mark stay; halves of marks at every cut do not confuse the way back."""
    rows = [(1, "a <P> b"), (2, "<S>"), (3, "x<M>y")]
    rows += [(k, "<<<P<S<M P> S> <") for k in range(10, 200)]
    rows += [(k, "<<<P S><S M><") for k in range(200, 400)]
    found = check(rows, make(*rows))
    assert {r[2] for r in found if r[0] < 10} == {"plain"}


def test_long_texts_are_matched_in_parts(make, monkeypatch):
    """Parts share no unit, wherever they are cut, so counts and cuts are those of the whole."""
    text = "".join(("word" * (i % 7), " ", "é" * (i % 3), "\n", "X" * (i % 40)) [i % 5] for i in range(3000))
    for size in (1, 2, 3, 10, 500):
        monkeypatch.setattr(infill, "PART_CHARS", size)
        spans = list(infill.parts(text))
        assert "".join(text[a:b] for a, b in spans) == text and len(spans) > 3
        for first, second in ((0, 0), (5, 900), (10**9, 17), (4, 2**32 - 1)):
            got = infill.cuts(text, first, second)
            monkeypatch.setattr(infill, "PART_CHARS", 10**9)
            assert got == infill.cuts(text, first, second)
            monkeypatch.setattr(infill, "PART_CHARS", size)
    monkeypatch.undo()
    long = ("ab1 " * 700_000) + "Z" * 3_000_000
    check([(k, long) for k in range(4)], make(*[(k, long) for k in range(4)]))


def test_names_keys_and_empty_tables(spark, empty):
    assert infill.infill(empty).collect() == []
    names = ["text", "doc_id", "id", "cut", "n", "form", "start", "end", "output", "prefix_chars"]
    rows = [("one two", "k", *["x"] * 8), ("three", None, *["x"] * 8), ("three", None, *["x"] * 8)]
    docs = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in names))
    check([(r[1], r[0]) for r in rows], docs)
    for name in names[2:]:
        renamed = docs.select(F.col("doc_id").alias(name), F.col("text").alias("body"))
        got = infill.infill(renamed, key=name, text="body") if name not in RESULT else None
        assert got is None or got.columns[0] == name and got.count() == 3
    assert infill.infill(docs).schema["doc_id"].dataType == T.StringType()


RESULT = {"n", "form", "output", "prefix_chars"}


@pytest.mark.parametrize("percent", [0, 100])
def test_shares(docs, percent):
    found = infill.infill(docs, infill_percent=100, suffix_first_percent=percent)
    forms = {r["form"] for r in found.filter("n > 0").select("form").distinct().collect()}
    assert {"spm" if percent else "psm"} <= forms <= {"spm" if percent else "psm", "plain"}
    assert infill.infill(docs, infill_percent=0).filter("form != 'plain'").count() == 0
