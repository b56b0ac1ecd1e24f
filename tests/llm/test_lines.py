import random

import numpy as np

from orderstar.llm import lines
from orderstar.llm.queries import QUERIES

from . import brute


def applied(store, docs):
    return {r["doc_id"]: (r["text"], r["n_lines"], r["n_dropped"]) for r in store.apply(docs).collect()}


def expected(rows):
    kept = brute.line_dedup(rows)
    return {
        k: (None if t is None else "\n".join(kept[k][0]), kept[k][1], kept[k][1] - len(kept[k][0]))
        for k, t in rows
    }


def corpus(seed, n=60, first=0):
    draw = random.Random(seed)
    shared = [f"Shared line number {i} of the site " for i in range(25)]
    return [
        (first + i, "\n".join(draw.choice([draw.choice(shared), draw.choice(shared).upper(), "short", f"own line of {first + i} here"]) for _ in range(8)))
        for i in range(n)
    ]


def test_filter_holds_what_was_added_and_forgets_what_was_discarded():
    draw = np.random.default_rng(5)
    values = draw.integers(-(2**63), 2**63, 3000)
    table = lines.CuckooFilter(64)  # far too small: grows by tables
    for value in values:
        table.add(int(value))
    assert len(table.tables) > 5
    table = lines.CuckooFilter.from_bytes(64, table.to_bytes())
    assert table.maybe_has(values).all()
    for value in values:
        assert table.discard(int(value))
    assert not table.maybe_has(values).any() and not any(t.any() for t in table.tables)


def test_filter_rarely_errs():
    table = lines.CuckooFilter(1024)
    draw = np.random.default_rng(6)
    for value in draw.integers(-(2**63), 2**63, 3500):
        table.add(int(value))
    assert len(table.tables) == 1
    assert table.maybe_has(draw.integers(-(2**63), 2**63, 100_000)).mean() < 0.001


def test_query_equals_brute_force(spark, sf_dir, texts):
    kept = brute.line_dedup(texts)
    wanted = {(k, n, n - len(left), brute.sha256("\n".join(left))) for k, (left, n) in kept.items()}
    found = QUERIES["op10_line_dedup"](spark, sf_dir).select("doc_id", "n_lines", "n_dropped", "kept_sha256")
    assert {tuple(r) for r in found.collect()} == wanted


def test_inserting_and_deleting_documents(make, spark):
    old, new = corpus(1), corpus(2, first=100)
    store = lines.LineStore.build(make(*old), shards=4)
    assert applied(store, make(*old)) == expected(old)
    both = store.insert(make(*new))
    assert applied(both, make(*old, *new)) == expected(old + new)
    gone = [k for k, _ in old[::2]] + [k for k, _ in new]
    less = both.delete(spark.createDataFrame([(k,) for k in gone], "k long"))
    left = [r for r in old if r[0] not in gone]
    assert applied(less, make(*left)) == expected(left)
    assert applied(store, make(*old)) == expected(old)  # the first store is as it was
    back = both.delete(make(*new).select("doc_id"))
    assert applied(back, make(*old)) == expected(old)
    for one, other in ((back, store), (back.compacted(), store), (both.compacted(), both)):
        for table in ("refs", "lines"):
            assert sorted(map(str, getattr(one, table).collect())) == sorted(map(str, getattr(other, table).collect()))
    assert applied(both.compacted(), make(*old, *new)) == expected(old + new)


def test_a_change_writes_no_more_than_it_touches(make, spark, monkeypatch):
    """One document more, and gone again, in a corpus of many: rows written are those of its lines."""
    rows = corpus(5, n=400)
    store = lines.LineStore.build(make(*rows), shards=16)
    written = []
    write = lines.stored
    monkeypatch.setattr(lines, "stored", lambda df, name: written.append((name, write(df, name))) or written[-1][1])
    one = (9000, "Shared line number 3 of the site\nown line of 100 here\nown line of 9000 here")
    more = store.insert(make(one))
    counts = [(name, df.count()) for name, df in written]
    assert sum(n for name, n in counts if name == "line-references") == 3
    assert all(n <= 3 for _, n in counts), counts
    assert applied(more, make(*rows, one)) == expected([*rows, one])
    written.clear()
    less = more.delete(spark.createDataFrame([(9000,)], "k long"))
    assert all(df.count() <= 3 for _, df in written)
    assert applied(less, make(*rows)) == expected(rows)
    assert store.refs.count() > 1000


def test_lines_cross_the_threshold_both_ways(make, spark):
    line = "one line that three documents hold"
    store = lines.LineStore.build(make((1, line), (2, line)))
    assert store.lines.isEmpty() and store.filters.isEmpty()
    three = store.insert(make((3, line), (3, line + " "), (None, "another line of enough length")))
    assert [tuple(r)[1:] for r in three.lines.collect()] == [(3, 3)] and three.filters.count() == 1
    assert applied(three, make((1, line), (3, line))) == {1: ("", 1, 1), 3: (line, 1, 0)}
    two = three.delete(spark.createDataFrame([(3,), (None,)], "k long"))
    assert two.lines.isEmpty() and not any(two.filters.first()["cells"])
    again = two.insert(make((0, line), (2, line)))
    assert applied(again, make((2, line), (0, line))) == {2: (line, 1, 0), 0: ("", 1, 1)}


def test_filters_follow_the_repeated_lines(make, monkeypatch):
    """More lines, more filters; the result is the same for any number of them, and of salts."""
    rows = corpus(3)
    seen = []
    for lines_each, references_each in ((1 << 16, 1 << 16), (5, 40), (1, 1)):
        monkeypatch.setattr(lines, "SHARD_LINES", lines_each)
        monkeypatch.setattr(lines, "SALT_REFERENCES", references_each)
        store = lines.LineStore.build(make(*rows))
        seen.append(store.shards)
        assert applied(store, make(*rows)) == expected(rows)
    assert seen[0] == 1 < seen[1] < seen[2] == store.lines.count()


def test_filters_choose_the_candidates(make, spark):
    """Lines that are not repeated hardly ever pass; those that are always do."""
    rows = corpus(4, n=300)
    store = lines.LineStore.build(make(*rows), shards=3)
    passed = lines._passing(store.refs, store.filters, store.shards)
    wanted = store.refs.join(store.lines, "line", "left_semi").count()
    assert wanted <= passed.count() <= wanted + 3 < store.refs.count()
    none = store.filters.filter("shard = 1")
    assert lines._passing(store.refs, none, 3).filter(lines._shard(lines.F.col("line"), 3) != 1).isEmpty()


def test_bulk_adding_holds_what_single_adding_holds():
    draw = np.random.default_rng(8)
    for buckets, n in ((64, 10), (64, 220), (64, 900), (1024, 3600), (64, 0)):
        values = draw.integers(-(2**63), 2**63, n)
        values[: n // 3] = values[0] if n else 0  # equal ones too
        table = lines.CuckooFilter(buckets)
        table.add_all(values)
        assert n == 0 or table.maybe_has(values).all()
        assert sum(int((t != 0).sum()) for t in table.tables) == n
        for value in values:
            assert table.discard(int(value))
        assert not any(t.any() for t in table.tables)


def test_extra_columns_may_have_any_name(make):
    rows = corpus(6, n=20)
    names = ["doc", "gone", "raw", "line", "lines", "held", "_lost", "_raw", "_doc", "n_lines", "step"]
    docs = make(*rows).select("doc_id", "text", *(lines.F.lit(n).alias(n) for n in names))
    store = lines.LineStore.build(docs)
    assert applied(store, docs) == expected(rows)
    left = store.apply(docs)
    assert set(names) < set(left.columns) and left.first()["_lost"] == "_lost"


def test_odd_rows(odd, odd_rows, empty):
    found = lines.LineStore.build(odd).apply(odd)
    assert found.columns == [*odd.columns, "n_lines", "n_dropped"]
    rows = found.collect()
    assert len(rows) == len(odd_rows)
    assert {r["doc_id"]: r["n_lines"] for r in rows}[10] == 501
    assert all(r["n_dropped"] == 0 for r in rows)
    assert lines.LineStore.build(empty).apply(empty).count() == 0


def test_repeated_rows_are_one_document(make):
    line = "a line that is long enough to count"
    rows = make((1, line), (1, line), (2, line))
    assert {r["n_dropped"] for r in lines.LineStore.build(rows).apply(rows).collect()} == {0}
    rows = make((1, line), (1, line), (2, line + "\r"), (None, "  " + line.upper()))
    found = sorted((r["doc_id"] or 0, r["n_dropped"]) for r in lines.LineStore.build(rows).apply(rows).collect())
    assert found == [(0, 1), (1, 1), (1, 1), (2, 0)]


def test_length_is_counted_in_characters(make):
    rows = make(*((i, "é" * 19 + "\n" + "é" * 20) for i in range(3)))
    found = {r["doc_id"]: r["text"] for r in lines.LineStore.build(rows).apply(rows).collect()}
    assert found == {0: "é" * 19, 1: "é" * 19, 2: "é" * 19 + "\n" + "é" * 20}
