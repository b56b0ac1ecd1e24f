import zlib
from collections import defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from orderstar.llm import packing
from orderstar.llm.common import tokenizer_path
from orderstar.llm.queries import QUERIES

PATH = tokenizer_path("byte_bpe_50k.json")


def check(pieces, texts, length=2048):
    """Every id once, at its place; sequences gapless. Returns the ids missing to full sequences."""
    library = Tokenizer.from_file(PATH)
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_doc[p["doc_id"]].append(p)
        by_sequence[p["sequence_id"]].append(p)
    assert set(by_doc) == {k for k, _ in texts}
    for key, text in texts:
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 1], dtype="<u4")
        at = 0
        for p in sorted(by_doc[key], key=lambda p: p["start"]):
            assert (p["start"], p["doc_tokens"]) == (at, len(ids))
            assert p["ids_crc32"] == zlib.crc32(ids[at : at + p["length"]].tobytes())
            at += p["length"]
        assert at == len(ids)
    missing = 0
    for own in by_sequence.values():
        at = 0
        for p in sorted(own, key=lambda p: p["offset"]):
            assert p["offset"] == at and p["length"] > 0
            at += p["length"]
        assert at <= length
        missing += length - at
    return missing


def test_hilbert_neighbours_are_neighbours(monkeypatch):
    monkeypatch.setattr(packing, "BITS", 3)
    grid = np.array(np.meshgrid(*[range(8)] * 3)).reshape(3, -1).T
    keys = packing.hilbert_key(grid)
    assert sorted(keys) == list(range(512))
    walk = grid[np.argsort(keys)]
    assert (np.abs(np.diff(walk, axis=0)).sum(axis=1) == 1).all()


def test_query(spark, sf_dir, texts):
    pieces = QUERIES["op8_packing"](spark, sf_dir).collect()
    assert check(pieces, texts) < 2048  # one partition, one short sequence


def test_many_partitions_and_short_sequences(monkeypatch, docs, texts):
    monkeypatch.setattr(packing, "PARTITION_TOKENS", 20_000)
    found = packing.pack(docs, PATH, length=128)
    pieces = found.collect()
    assert check(pieces, texts, 128) < 128 * 15
    assert all(len(p["ids"]) == p["length"] for p in pieces)


def test_similar_documents_lie_together(docs):
    """Documents of one language share sequences more often than chance would have it."""
    langs = {r["doc_id"]: r["lang"] for r in docs.collect()}
    by_sequence = defaultdict(set)
    for p in packing.pack(docs, PATH, with_ids=False).collect():
        by_sequence[p["sequence_id"]].add(p["doc_id"])
    pairs = [(a, b) for own in by_sequence.values() for a in own for b in own if a < b]
    shares = np.unique(list(langs.values()), return_counts=True)[1] / len(langs)
    assert np.mean([langs[a] == langs[b] for a, b in pairs]) > (shares**2).sum() + 0.1


def test_odd_rows(make, odd_rows, odd, empty):
    total = sum(p["length"] for p in packing.pack(odd, PATH).collect())
    library = Tokenizer.from_file(PATH)
    assert total == sum(len(library.encode(t or "", add_special_tokens=False).ids) + 1 for _, t in odd_rows)
    unique = list(dict(odd_rows).items())
    check(packing.pack(make(*unique), PATH).collect(), unique)
    assert packing.pack(empty, PATH).count() == 0


@pytest.mark.parametrize("copies", [400])
def test_hot_copies_are_spread(make, monkeypatch, copies):
    monkeypatch.setattr(packing, "PARTITION_TOKENS", 500)
    rows = make(*((7, "one text that is copied") for _ in range(copies)))
    pieces = packing.pack(rows, PATH, with_ids=False).collect()
    assert len({p["sequence_id"] >> 33 for p in pieces}) > 3
    assert sum(p["length"] for p in pieces) == copies * pieces[0]["doc_tokens"]


def test_the_curve_of_production_is_one_walk():
    """4 dimensions of 12 bits: an aligned cube is one stretch of the curve, in steps to neighbours."""
    draw = np.random.default_rng(9)
    for side in (2, 8):
        for corner in draw.integers(0, (1 << packing.BITS) // side, (5, packing.DIMENSIONS)) * side:
            grid = np.array(np.meshgrid(*[range(side)] * packing.DIMENSIONS)).reshape(packing.DIMENSIONS, -1).T
            keys = packing.hilbert_key(grid + corner)
            walk = grid[np.argsort(keys)]
            assert np.ptp(keys) == len(grid) - 1 == len(set(keys)) - 1
            assert (np.abs(np.diff(walk, axis=0)).sum(axis=1) == 1).all()


def test_sequences_follow_the_curve(docs):
    places = {r["id"]: r["place"] for r in packing.tokenized(docs, PATH).select("id", "place").collect()}
    pieces = packing.pack(docs, PATH, with_ids=False, partition_tokens=20_000).collect()
    walked = [p["doc_id"] for p in sorted(pieces, key=lambda p: (p["sequence_id"], p["offset"]))]
    assert len({p["sequence_id"] >> packing._LOCAL_BITS for p in pieces}) > 1
    assert [places[k] for k in walked] == sorted(places[k] for k in walked)
