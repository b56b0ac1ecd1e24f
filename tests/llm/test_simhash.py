import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from orderstar.llm import simhash
from orderstar.llm.queries import QUERIES

from . import brute


def signed(code):
    return code - (1 << 64) if code >> 63 else code


def clustered(seed, centres=40, each=12, flips=3):
    draw = random.Random(seed)
    codes = {0, (1 << 64) - 1}
    for _ in range(centres):
        centre = draw.getrandbits(64)
        for _ in range(each):
            code = centre
            for bit in draw.sample(range(64), draw.randint(0, flips)):
                code ^= 1 << bit
            codes.add(code)
    return sorted(codes, key=signed)


def test_fingerprint_is_the_majority_of_the_shingle_hashes():
    draw = random.Random(1)
    for n in [0, 1, 2, 3, 4, 255, 256, 257, 700]:
        text = " ".join(draw.choice(["a", "Bc", "dé", "F\t"]) for _ in range(n))
        assert simhash.fingerprint_of(text.encode()) == brute.simhash(text)
    assert simhash.fingerprint_of(None) == 0


def test_long_texts_are_split_in_parts(monkeypatch):
    monkeypatch.setattr(simhash, "TEXT_BYTES", 7)
    draw = random.Random(2)
    for n in range(60):
        text = draw.choice(["", " ", "\n\n"]) + "".join(
            draw.choice(["a", "bb", "a-very-long-word"]) + draw.choice([" ", "  \t ", "\n"]) for _ in range(n)
        )
        assert simhash.fingerprint_of(text.encode()) == brute.simhash(text)


def test_gray_rank_inverts_the_gray_code():
    numbers = np.arange(5000, dtype=np.uint64) * np.uint64(3689348814741910323)
    assert (simhash.gray_rank(numbers ^ (numbers >> np.uint64(1))) == numbers).all()


@pytest.mark.parametrize("node_rows", [50_000, 6])
@pytest.mark.parametrize("distance", [0, 1, 3])
def test_links_connect_what_all_pairs_connect(spark, monkeypatch, distance, node_rows):
    """The second size splits nodes down to the last level."""
    monkeypatch.setattr(simhash, "NODE_ROWS", node_rows)
    codes = clustered(distance)
    frame = spark.createDataFrame([(signed(c),) for c in codes], "fingerprint long")
    roots = {r["member"]: r["root"] for r in simhash.components(simhash.near_links(frame, distance)).collect()}
    expected = brute.classes(codes, distance)
    assert [roots.get(signed(c), signed(c)) for c in codes] == [signed(codes[i]) for i in expected]


def test_dense_balls_are_joined_without_all_pairs():
    """Every code of 12 free bits: 4096 codes, all reachable."""
    codes = np.arange(4096, dtype=np.uint64) | np.uint64(1 << 60)
    members, roots = simhash.forest(np.zeros(4096, dtype=np.int64), codes, 3)
    assert len(members) == 4095 and set(roots) == {1 << 60}


def test_components_of_long_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(60)] + [(1000, 1000 + i) for i in range(1, 80)]
    random.Random(3).shuffle(chain)
    links = spark.createDataFrame([p if i % 2 else p[::-1] for i, p in enumerate(chain)], "a long, b long")
    found = {r["member"]: r["root"] for r in simhash.components(links).collect()}
    assert found == {**{i: 0 for i in range(1, 61)}, **{1000 + i: 1000 for i in range(1, 80)}}


def test_query_equals_brute_force(spark, sf_dir, texts):
    texts = sorted(texts)
    codes = [brute.simhash(t) for _, t in texts]
    roots = brute.classes(codes)
    expected = {(k, f"{c:016x}", texts[r][0]) for (k, _), c, r in zip(texts, codes, roots)}
    assert {tuple(r) for r in QUERIES["op2_simhash"](spark, sf_dir).collect()} == expected
    assert len({r for *_, r in expected}) < len(expected)


def test_odd_rows(odd, odd_rows, empty):
    rows = simhash.near_duplicates(odd).collect()
    assert len(rows) == len(odd_rows)
    by_key = {r["doc_id"]: r for r in rows}
    assert by_key[2]["fingerprint"] == by_key[10]["fingerprint"] == 0
    assert by_key[2]["component_id"] == 1  # the smallest key of rows without words; NULL is none
    assert by_key[5]["component_id"] == 4 and by_key[8]["component_id"] == 7
    assert simhash.near_duplicates(empty).count() == 0


def test_one_row_of_each_component_stays(odd, empty):
    kept = simhash.keep_one(odd)
    assert kept.columns == odd.columns
    texts = sorted((r["text"] or "").strip()[:12] for r in kept.collect())
    assert texts == sorted(["", "one", "Ein Straße —", "word0 word1 ", "without a ke", "." * 12])
    assert simhash.keep_one(empty).count() == 0


def test_keys_that_repeat_with_other_texts(make):
    rows = make((1, "a b c d e f"), (1, "p q r s t u"), (1, "p q r s t u"), (2, "a b c d e f"))
    kept = sorted(r["text"] for r in simhash.keep_one(rows).collect())
    assert kept == ["a b c d e f", "p q r s t u"]


def test_hot_copies(make):
    rows = make(*((i, "the same words again and again") for i in range(300)), (300, "other words stand here"))
    assert sorted(r["doc_id"] for r in simhash.keep_one(rows).collect()) == [0, 300]
    found = simhash.near_duplicates(rows).groupBy("component_id").agg(F.count("*").alias("n"))
    assert sorted(r["n"] for r in found.collect()) == [1, 300]
