import pytest

from orderstar.llm import decontamination as decon
from orderstar.llm.queries import QUERIES

from . import brute

ITEM = "Alpha beta, gamma delta epsilon zeta eta theta iota kappa lambda mu."


@pytest.fixture(scope="module")
def bench(spark):
    rows = [(1, ITEM), (2, "short item"), (3, None), (4, "..."), (5, ITEM), (6, "solo7")]
    return spark.createDataFrame(rows, "item_id long, text string")


def found(docs, bench):
    return {
        r["doc_id"]: (r["n_words"], r["n_hit"], r["items"], r["contaminated"])
        for r in decon.report(docs, bench).collect()
    }


def test_query_equals_brute_force(spark, sf_dir, texts):
    items = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    wanted = {
        (k, n, len(hit), len(names), brute.sha256(",".join(names)), bool(hit))
        for k, (n, hit, names) in brute.decontamination(texts, items).items()
    }
    result = QUERIES["op3_decontamination"](spark, sf_dir)
    assert {tuple(r) for r in result.collect()} == wanted
    assert any(w[-1] for w in wanted)


def test_windows_of_every_length_and_overlaps(make, bench):
    rows = [
        (1, "x " + ITEM.upper().replace(" ", "--") + " y"),
        (2, "a SHORT, item! and short item"),
        (3, "beta gamma delta epsilon zeta eta theta iota kappa lambda"),
        (4, "beta gamma delta epsilon zeta eta theta iota kappa"),
        (5, ITEM + " " + ITEM + " solo7 short"),
        (6, "shorter item"),
    ]
    items = [tuple(r) for r in bench.collect()]
    wanted = {k: (n, len(hit), names, bool(hit)) for k, (n, hit, names) in brute.decontamination(rows, items).items()}
    assert found(make(*rows), bench) == wanted
    assert wanted[3][1] == 10 and wanted[4][1] == 0


def test_without_broadcast(make, bench, monkeypatch):
    monkeypatch.setattr(decon, "BROADCAST_BYTES", -1)
    assert found(make((1, ITEM), (2, "nothing")), bench) == {1: (12, 12, ["1", "5"], True), 2: (1, 0, [], False)}


def test_documents_and_spans(make, bench):
    rows = make((1, f"Keep this. {ITEM} And that."), (2, "clean"), (3, None), (3, None), (4, "solo7"))
    kept = decon.drop_documents(rows, bench)
    assert sorted(r["doc_id"] for r in kept.collect()) == [2, 3, 3] and kept.columns == rows.columns
    cut = decon.cut_spans(rows, bench)
    assert cut.columns == rows.columns
    texts = {r["doc_id"]: r["text"] for r in cut.collect()}
    assert texts == {1: "Keep this. And that.", 2: "clean", 3: None, 4: ""}


def test_odd_rows(odd, odd_rows, empty, bench):
    rows = decon.report(odd, bench).collect()
    assert len(rows) == len(odd_rows) and not any(r["contaminated"] for r in rows)
    assert {r["doc_id"]: r["n_words"] for r in rows}[7] == 60_000
    assert decon.report(empty, bench).count() == 0
    none = bench.filter("false")
    assert not any(r["contaminated"] for r in decon.report(odd, none).collect())
    assert decon.drop_documents(odd, none).count() == len(odd_rows)
