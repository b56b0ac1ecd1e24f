import pytest

from orderstar.llm import preferences as pref


@pytest.fixture(scope="module")
def turns(spark):
    rows = [
        (2, 0, "user", "hi"), (2, 1, "assistant", "hello"), (2, 2, "user", "more"), (2, 3, "assistant", "sure"),
        (2, 4, "user", "bye"),
        (3, 0, "user", "hi"), (3, 1, "assistant", "no"),
        (4, 0, "user", "alone"), (4, 1, "assistant", "left out"),
        (6, 0, "user", "nobody answers"), (7, 0, None, None), (7, None, "assistant", "first"),
        (None, 0, "user", "no key"), (None, 0, "user", "no key"),
    ]
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")


def rendered(*turns):
    return "".join(f"<|{r}|>\n{t}\n<|end|>\n" for r, t in turns)


def test_pairs(turns):
    pairs = pref.with_alternative_answer(pref.conversations(turns))
    found = pref.format_pairs(pairs, "conv_id").collect()
    rows = {r["conv_id"]: r for r in found}
    assert len(rows) == 6 and len(found) == 7  # turns without a key stand alone
    two = rows[2]
    assert two["n_prompt_turns"] == 3
    assert two["prompt"] == rendered(("user", "hi"), ("assistant", "hello"), ("user", "more"))
    assert two["chosen"] == rendered(("assistant", "sure"), ("user", "bye"))
    assert two["rejected"] == rendered(("assistant", "no"))
    (span,) = two["chosen_mask"]
    assert two["chosen"][span["start"] : span["end"]] == "sure\n<|end|>\n"
    assert rows[3]["rejected"] == rendered(("assistant", "sure"))
    assert rows[4]["rejected"] == "" and rows[4]["rejected_mask"] == []
    assert rows[6]["chosen"] == rows[6]["rejected"] == "" and rows[6]["n_prompt_turns"] == 1
    assert rows[7]["chosen"] == rendered(("assistant", "first"), ("", ""))
    assert rows[None]["prompt"] == rendered(("user", "no key"))


def test_given_pairs_with_long_and_missing_sides(spark):
    schema = "id long, chosen array<struct<role:string,text:string>>, rejected array<struct<role:string,text:string>>"
    many = [("user" if i % 2 else "assistant", f"t{i}") for i in range(400)]
    pairs = spark.createDataFrame([(1, many, many[:-1]), (2, None, many), (3, many, many), (4, [], [])], schema)
    rows = {r["id"]: r for r in pref.format_pairs(pairs, "id").collect()}
    assert rows[1]["n_prompt_turns"] == 399 and rows[1]["rejected"] == ""
    assert rows[2]["n_prompt_turns"] == 0 and len(rows[2]["rejected_mask"]) == 200
    assert rows[3]["n_prompt_turns"] == 400 and rows[3]["chosen"] == ""
    for span, (_, text) in zip(rows[2]["rejected_mask"], many[::2]):
        assert rows[2]["rejected"][span["start"] : span["end"]] == f"{text}\n<|end|>\n"
    assert rows[4]["prompt"] == ""


def test_empty(turns):
    pairs = pref.with_alternative_answer(pref.conversations(turns.filter("false")))
    assert pref.format_pairs(pairs, "conv_id").count() == 0


def test_long_texts_other_names_and_many_turns_without_a_key(spark):
    names = ["key", "alone", "turns", "_of", "_answer", "last", "chosen", "rejected", "prompt"]
    long = "word " * 100_000
    rows = [(1, 0, "user", long), (1, 1, "assistant", long), (None, 0, "assistant", "x")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    turns = turns.unionByName(spark.range(2000).selectExpr("NULL AS conv_id", "id AS turn", "'user' AS role", "'t' AS text"))
    for name in names:
        turns = turns.withColumn(name, pref.F.lit("x"))
    convs = pref.conversations(turns)
    assert convs.count() == 2002 and convs.filter("size(turns) > 1").count() == 1
    done = pref.format_pairs(pref.with_alternative_answer(convs), "conv_id").filter("conv_id = 1").first()
    assert done["prompt"] == rendered(("user", long)) and done["chosen"] == rendered(("assistant", long))
    assert done["rejected"] == ""
