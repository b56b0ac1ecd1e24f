import math

import zstandard
from pyspark.sql import functions as F

from orderstar.llm import language
from orderstar.llm.queries import QUERIES


def test_held_out_accuracy(spark, sf_dir, docs):
    found = QUERIES["op1_language_id"](spark, sf_dir)
    joined = found.join(docs.select("doc_id", "lang"), "doc_id").filter("held_out").collect()
    right = sum(r["lang"] == r["lang_pred"] for r in joined)
    assert found.count() == docs.count()
    assert right / len(joined) >= 0.95
    accepted = [r for r in joined if r["accepted"]]
    assert sum(r["lang"] == r["lang_pred"] for r in accepted) / len(accepted) >= right / len(joined)
    assert all(0 <= r["score"] <= 1 for r in joined)


def test_predictions_do_not_depend_on_other_columns_or_rows(docs):
    model = language.fit(docs.filter(~language.held_out(F.col("doc_id"))))
    some = docs.limit(30)
    mixed = some.withColumn("lang", F.lit("xx")).withColumn("doc_id", -F.col("doc_id"))
    a = {r["text"]: r["lang_pred"] for r in language.identify(some, model).collect()}
    b = {r["text"]: r["lang_pred"] for r in language.identify(mixed, model).collect()}
    assert a == b


def test_samples_are_bounded_and_skip_the_held_out(docs):
    model = language.fit(docs)
    assert all(0 < len(d) <= language.DICTIONARY_BYTES for d in model.dictionaries.values())
    again = language.fit(docs.repartition(7))
    assert again == model


def test_odd_rows(docs, odd, odd_rows, empty):
    model = language.fit(docs)
    found = language.identify(odd, model)
    rows = found.collect()
    assert len(rows) == len(odd_rows) and set(odd.columns) < set(found.columns)
    for row in rows:
        letters = any(map(str.isalpha, row["text"] or ""))
        assert (row["lang_pred"] == language.UNKNOWN) == (not letters)
        assert row["accepted"] is False or letters
    assert language.identify(empty, model).count() == 0
    nothing = language.fit(empty)
    assert {r["lang_pred"] for r in language.identify(odd, nothing).collect()} == {language.UNKNOWN}


def test_one_language_only(make):
    rows = make((1, "only one label here", "xx"), (2, "another text", "xx"))
    assert {r["lang_pred"] for r in language.identify(rows, language.fit(rows)).collect()} == {"xx"}


def test_every_label_gets_a_dictionary(make):
    def text(label, row):
        return " ".join(f"{chr(97 + label % 26)}{chr(97 + label // 26)}{chr(97 + (row + k) % 9)}or" for k in range(40))

    rows = make(*((1000 * n + r, text(n, r), f"l{n:02}") for n in range(80) for r in range(3)))
    model = language.fit(rows)
    assert len(model.dictionaries) == 80
    assert sum(map(len, model.dictionaries.values())) <= language.TOTAL_BYTES
    found = language.identify(rows, model).collect()
    assert all(r["lang_pred"] == f"l{r['doc_id'] // 1000:02}" for r in found)


def plainly(text, dictionaries):
    """The language whose dictionary encodes the text in fewest bytes, stated for one text alone."""
    if not any(c.isalpha() for c in text or ""):
        return "und", 0.0
    raw = text.lower().encode()
    blocks = [raw[i : i + language.BLOCK_BYTES] for i in range(0, len(raw), language.BLOCK_BYTES)]

    def size(content):
        given = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        options = {"dict_data": given, "write_content_size": False, "write_checksum": False}
        return sum(len(zstandard.ZstdCompressor(language.LEVEL, **options).compress(b)) for b in blocks)

    sizes = {name: size(content) for name, content in dictionaries.items()}
    least = min(sizes.values())
    close = [name for name in sizes if sizes[name] * (1 - language.NARROW) <= least]
    if len(close) > 1:
        for name in close:
            step = max(64, math.ceil(len(dictionaries[name]) / language.PARTS))
            parts = [dictionaries[name][i : i + step] for i in range(0, len(dictionaries[name]), step)]
            sizes[name] = sum(map(size, parts)) / len(parts)
        behind = max(sizes[name] for name in close) - least
        sizes |= {name: sizes[name] + behind for name in sizes if name not in close}
    best = min(sizes, key=lambda name: sizes[name])
    weights = [math.exp(-min(50.0, (s - sizes[best]) / 4)) for s in sizes.values()]
    return best, 1 / sum(weights)


def test_predictions_equal_a_plain_statement(spark, sf_dir, docs, odd, odd_rows):
    model = language.fit(docs.filter(~language.held_out(F.col("doc_id"))))
    texts = {r["doc_id"]: r["text"] for r in docs.select("doc_id", "text").collect()}
    found = QUERIES["op1_language_id"](spark, sf_dir).collect()
    for row in found[::3]:
        name, score = plainly(texts[row["doc_id"]], model.dictionaries)
        assert row["lang_pred"] == name and abs(row["score"] - score) < 1e-9
    given = [t for _, t in odd_rows if len(t or "") < 10_000]
    rows = language.identify(odd, model).filter("text IS NULL OR length(text) < 10000").collect()
    assert sorted(r["lang_pred"] for r in rows) == sorted(plainly(t, model.dictionaries)[0] for t in given)
