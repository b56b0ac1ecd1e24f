"""Chat formatting of preference pairs.

A pair is a chosen and a rejected conversation. The turns both begin with are rendered once, as the
prompt; what follows is rendered for each side, with a mask that marks what the assistant wrote.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPEN, CLOSE, END = "<|", "|>\n", "\n<|end|>\n"
ASSISTANT = "assistant"


def conversations(
    turns: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """(key, turns) with the turns of each conversation as an array of (role, text) in order.

    Turns that share a number are ordered by role and text and stay repeated; a NULL role or text
    becomes ''; NULL turn numbers come first. Turns without a key do not belong together: each is a
    conversation of its own, however many there are. Texts are taken whole, other columns may have any
    name, and an empty table has no conversation.
    """
    one = F.struct(
        F.col(turn).alias("turn"),
        F.coalesce(role, F.lit("")).alias("role"),
        F.coalesce(text, F.lit("")).alias("text"),
    )
    alone = F.when(F.col(key).isNull(), F.monotonically_increasing_id())
    rows = turns.select(F.col(key).alias("key"), alone.alias("alone"), one.alias("turn"))
    gathered = rows.groupBy("key", "alone").agg(F.sort_array(F.collect_list("turn")).alias("turns"))
    plain = F.transform("turns", lambda t: F.struct(t["role"], t["text"]))
    return gathered.select(F.col("key").alias(key), plain.alias("turns"))


def with_alternative_answer(convs: DataFrame, key: str = "conv_id") -> DataFrame:
    """Pairs (key, chosen, rejected) made of conversations that have no second version.

    Rejected is the conversation up to its last answer, followed by the last answer of its neighbour
    (keys 2k and 2k+1 are neighbours), or by nothing where that has none. Without an answer of its
    own a conversation is both chosen and rejected.
    """
    answers = F.filter("turns", lambda t: t["role"] == ASSISTANT)
    places = F.transform("turns", lambda t, i: F.when(t["role"] == ASSISTANT, i + 1).otherwise(0))
    own = convs.select(key, "turns", F.coalesce(F.array_max(places), F.lit(0)).alias("last"))
    offered = convs.select(
        F.col(key).bitwiseXOR(F.lit(1)).alias("_of"), F.get(F.reverse(answers), F.lit(0)).alias("_answer")
    ).filter("_of IS NOT NULL AND _answer IS NOT NULL")
    joined = own.join(offered, own[key] == offered["_of"], "left")
    before = F.slice("turns", F.lit(1), F.greatest(F.col("last") - 1, F.lit(0)))
    other = F.when(F.col("_answer").isNull(), before).otherwise(
        F.concat(before, F.array("_answer"))
    )
    return joined.select(
        key,
        F.col("turns").alias("chosen"),
        F.when(F.col("last") == 0, F.col("turns")).otherwise(other).alias("rejected"),
    )


def _rendered(turn: Column) -> Column:
    return F.concat(F.lit(OPEN), turn["role"], F.lit(CLOSE), turn["text"], F.lit(END))


def render(turns: Column) -> Column:
    return F.array_join(F.transform(turns, _rendered), "")


def answer_spans(turns: Column) -> Column:
    """[start, end) in characters of what the assistant wrote, its end mark included."""
    span = "array<struct<start:int,end:int>>"
    start = F.struct(F.lit(0).alias("at"), F.array().cast(span).alias("spans"))

    def step(state: Column, turn: Column) -> Column:
        end = state["at"] + F.char_length(_rendered(turn))
        body = state["at"] + F.char_length(F.concat(F.lit(OPEN), turn["role"], F.lit(CLOSE)))
        found = F.array(F.struct(body.alias("start"), end.alias("end")))
        spans = F.when(turn["role"] == ASSISTANT, F.concat(state["spans"], found)).otherwise(
            state["spans"]
        )
        return F.struct(end.alias("at"), spans.alias("spans"))

    return F.aggregate(turns, start, step, lambda state: state["spans"])


def common_turns(a: Column, b: Column) -> Column:
    """How many turns both arrays begin with."""
    least = F.least(F.size(a), F.size(b))
    places = F.when(least > 0, F.sequence(F.lit(0), least - 1)).otherwise(F.array().cast("array<int>"))
    apart = F.filter(places, lambda i: F.get(a, i) != F.get(b, i))
    return F.coalesce(F.get(apart, F.lit(0)), least)


def format_pairs(pairs: DataFrame, key: str) -> DataFrame:
    """Prompt, completions and masks of pairs (key, chosen, rejected), one row each.

    ``chosen_mask`` and ``rejected_mask`` are the spans of the completion to learn from. Sides that
    are equal give empty completions; a NULL side counts as one without turns.
    """
    none = F.array().cast("array<struct<role:string,text:string>>")
    sides = pairs.select(
        key, F.coalesce("chosen", none).alias("chosen"), F.coalesce("rejected", none).alias("rejected")
    )
    shared = sides.withColumn("n_prompt_turns", common_turns(F.col("chosen"), F.col("rejected")))

    def rest(side: str) -> Column:
        return F.slice(side, F.col("n_prompt_turns") + 1, F.size(side))

    cut = shared.select(
        key,
        "n_prompt_turns",
        F.slice("chosen", F.lit(1), F.col("n_prompt_turns")).alias("prompt"),
        rest("chosen").alias("chosen"),
        rest("rejected").alias("rejected"),
    )
    return cut.select(
        key,
        F.col("n_prompt_turns").cast("long").alias("n_prompt_turns"),
        render(F.col("prompt")).alias("prompt"),
        render(F.col("chosen")).alias("chosen"),
        answer_spans(F.col("chosen")).alias("chosen_mask"),
        render(F.col("rejected")).alias("rejected"),
        answer_spans(F.col("rejected")).alias("rejected_mask"),
    )


def shown(spans: Column) -> Column:
    """Spans as start-end, separated by commas."""
    ends = F.transform(spans, lambda s: F.concat_ws("-", *(s[c].cast("string") for c in ("start", "end"))))
    return F.array_join(ends, ",")
