"""Named queries of the operators over the test tables, and their SQL where there is one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    bin_slack,
    decontamination,
    infill,
    language,
    licenses,
    lines,
    packing,
    preferences,
    prefix_trie,
    sharding,
    simhash,
    sketches,
    tokens,
)
from .common import documents, tokenizer_path
from .oracles import ORACLES  # noqa: F401

TOKENIZER = "byte_bpe_50k.json"
WORD_TOKENIZER = "word_bpe_49k.json"
TOKEN_LIMIT = 1024
SHARD_COUNT = 8


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).withColumn("held_out", language.held_out(F.col("doc_id")))
    model = language.fit(docs.filter(~F.col("held_out")))
    return language.identify(docs, model, columns=["doc_id", "held_out"])


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(documents(spark, sf_dir))
    return found.select(
        "doc_id",
        F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"),
        "component_id",
    )


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = decontamination.report(documents(spark, sf_dir), benchmark)
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        "contaminated",
    )


def op4_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    pairs = preferences.with_alternative_answer(preferences.conversations(turns))
    done = preferences.format_pairs(pairs, "conv_id")
    masks = {c: preferences.shown(F.col(c)) for c in ("chosen_mask", "rejected_mask")}
    return done.withColumns(masks)


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = tokens.count_tokens(documents(spark, sf_dir), tokenizer_path(TOKENIZER))
    return counted.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.col("text")
    rows = documents(spark, sf_dir).select(
        "doc_id",
        (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"),
        F.xxhash64(text).alias("place"),
    )
    # Equal texts have one key on the ring, so they share a shard unless it overflows.
    placed = sharding.shard_rows(
        rows, F.col("place"), ["text_crc32", "size", "doc_id"], SHARD_COUNT
    )
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit(sharding.LAW).alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    found = licenses.report(docs, licenses.fit(docs))
    return found.withColumns(
        {c: F.array_join(c, ",") for c in ("licences", "unconfirmed")}
    )


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir), tokenizer_path(TOKENIZER), with_ids=False)


def op9_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sketches.against_next(documents(spark, sf_dir)).select(
        "doc_id",
        "n_chars",
        F.sha2(F.col("edited_text").cast("binary"), 256).alias("edited_sha256"),
        sketches.shown(F.col("sketch")).alias("fingerprint"),
        sketches.shown(F.col("edited_sketch")).alias("edited_fingerprint"),
        "near_edited",
        "near_next",
    )


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    left = lines.LineStore.build(docs).apply(docs)
    return left.select(
        "doc_id",
        "n_lines",
        "n_dropped",
        F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256"),
    )


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    ranked, spans = prefix_trie.ordered(turns)
    conv = F.col("conv")
    # Conversations of five consecutive ids share up to eight of their first turns.
    taken = F.crc32(conv.cast("string").cast("binary")) % 9
    rows = prefix_trie.branched(ranked, spans, conv - conv % 5, taken, 8)
    found = prefix_trie.trie(rows, spans.select("conv"))
    digests = prefix_trie.digests_of_ends(found.ends)
    return found.nodes.join(digests, prefix_trie.NODE, "left").select(
        F.col("conv").alias("conv_id"),
        "depth",
        F.col("up_conv").alias("parent_conv_id"),
        "n_convs",
        "n_children",
        "n_leaves",
        F.col("saved").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"),
    )


def op12_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return bin_slack.pack(docs, tokenizer_path(WORD_TOKENIZER), with_ids=False)


def op13_infill(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = infill.infill(documents(spark, sf_dir))
    restored = infill.restore(F.col("output"), F.col("form"))
    return made.select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
        F.sha2(restored.cast("binary"), 256).alias("restored_sha256"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_language_id": op1_language_id,
    "op2_simhash": op2_simhash,
    "op3_decontamination": op3_decontamination,
    "op4_chat_format": op4_chat_format,
    "op5_token_counts": op5_token_counts,
    "op6_sharding": op6_sharding,
    "op7_license_scan": op7_license_scan,
    "op8_packing": op8_packing,
    "op9_fingerprints": op9_fingerprints,
    "op10_line_dedup": op10_line_dedup,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_best_fit": op12_best_fit,
    "op13_infill": op13_infill,
}
