"""Operators that keep the columns they are given take any other column names, and keys of any kind."""

import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from orderstar.llm import decontamination, lines, sharding, simhash, sketches

FOLDER = Path(decontamination.__file__).parent
#: Every name the operators give a column: in quotes, in their own files.
INTERNAL = sorted(
    {
        name
        for file in [*FOLDER.glob("*.py"), FOLDER.parent / "operators" / "keys.py"]
        if file.name not in ("queries.py", "oracles.py")
        for name in re.findall(r"""["']([a-z_]+[a-z])["']""", file.read_text())
    }
    - {"doc_id", "text"}
)
RESULTS = {"shard", "slot", "sketch", "n_lines", "n_dropped"}


@pytest.fixture(scope="module")
def named(spark):
    """Text keys, one of them NULL, and a column of each internal name."""
    rows = [("a", "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda"), ("b", "other"), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id string, text string")
    return docs.select("doc_id", "text", *(F.lit(n).alias(n) for n in INTERNAL))


def unchanged(found, docs, also=()):
    kept = [c for c in docs.columns if c not in RESULTS and c not in also]
    assert set(kept) <= set(found.columns)
    row = found.first()
    return all(row[c] == c for c in kept if c not in ("doc_id", "text"))


def test_there_are_names_to_clash_with():
    assert {"_rank", "_digest", "_spans", "_tie", "_part", "words", "others", "gone"} <= set(INTERNAL)


def test_line_store(named):
    assert unchanged(lines.LineStore.build(named).apply(named), named)


def test_shards(named):
    found = sharding.shard_rows(named, F.col("text"), ["text", "_rank", "doc_id"], 2)
    assert unchanged(found, named) and {r["slot"] for r in found.collect()} == {0, 1}


def test_decontamination(named, spark):
    items = spark.createDataFrame([("i", "BETA gamma delta")], "item_id string, text string")
    cut = decontamination.cut_spans(named, items)
    assert cut.columns == named.columns and unchanged(cut, named)
    texts = {r["doc_id"]: r["text"] for r in cut.select("doc_id", "text").collect()}
    assert texts["a"].split() == "alpha epsilon zeta eta theta iota kappa lambda".split()
    assert texts["b"] == "other" and texts[None] is None
    left = decontamination.drop_documents(named, items)
    assert left.columns == named.columns and left.count() == 2


def test_sketches(named):
    found = sketches.fingerprints(named)
    assert unchanged(found, named) and found.count() == 3


def test_near_copies(named):
    assert unchanged(simhash.keep_one(named), named)


def test_text_keys_are_ordered_by_their_bytes(spark):
    keys = [f"{p}{i}" for p in ("é", "z", "prefix-of-all-", "") for i in range(40)]
    docs = spark.createDataFrame([(k, f"text of {k}") for k in keys] + [(None, "none")], "doc_id string, text string")
    dealt, window = sketches.with_next(docs, bucket_rows=7)
    order = window.orderBy("_guest", F.desc_nulls_last("_key"), "text")
    rows = dealt.withColumn("after", F.lead("doc_id").over(order)).filter("_guest = 0")
    found = {r["doc_id"]: r["after"] for r in rows.collect()}
    wanted = sorted(keys, key=str.encode, reverse=True)
    assert len(found) == len(keys) + 1
    assert [found[k] for k in wanted] == [*wanted[1:], None] and found[None] == wanted[0]
