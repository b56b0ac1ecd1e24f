"""From raw documents to packed training sequences, one operator per stage."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderstar.llm import decontamination, language, lines, packing, simhash
from orderstar.llm.common import documents, intermediates, tokenizer_path
from orderstar.llm.queries import TOKENIZER
from orderstar.session import remove_folder, work_folder


def _wrapped(docs: DataFrame) -> DataFrame:
    """Key, text, and the other columns out of the way of what an operator adds."""
    others = [docs[c].alias(c) for c in docs.columns if c not in ("doc_id", "text")]
    return docs.select("doc_id", "text", F.struct(*others, F.lit(0).alias("_")).alias("others"))


def _unwrapped(rows: DataFrame, docs: DataFrame) -> DataFrame:
    return rows.select(
        *(c if c in ("doc_id", "text") else F.col("others").getField(c).alias(c) for c in docs.columns)
    )


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the compression classifier accepts.

    It learns from labelled documents that the evaluation split leaves it, and judges texts alone.
    """
    model = language.fit(docs.filter(~language.held_out(F.col("doc_id"))))
    judged = language.identify(_wrapped(docs), model)
    return _unwrapped(judged.filter("accepted"), docs)


def unrepeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that three documents hold stay in one of them; documents that lose every line go."""
    left = lines.LineStore.build(docs).apply(_wrapped(docs))
    return _unwrapped(left.filter("n_dropped < n_lines"), docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return simhash.keep_one(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no window of a benchmark item occurs."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontamination.drop_documents(docs, benchmark)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents, in the sequences they are packed to."""
    return packing.pack(docs, tokenizer_path(TOKENIZER))


STAGES = [
    ("language_id", known_language),
    ("line_dedup", unrepeated_lines),
    ("near_dedup", without_near_copies),
    ("decontamination", without_benchmark),
    ("packing", packed),
]

#: Compression and token ids have no SQL form.
ORACLE_SQL = None


def _complete(spark: SparkSession, path: str) -> bool:
    """Whether a writer finished here."""
    mark = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return mark.getFileSystem(spark._jsc.hadoopConfiguration()).exists(mark)


def run(spark: SparkSession, sf_dir: str, folder: str | None = None) -> DataFrame:
    """All stages over ``documents``, each stored and read again before the next.

    What operators store on the way goes with their stage. With ``folder`` (on storage all executors
    share) the stages lie there, stay, and are not repeated where they are complete, so a run that was
    broken off goes on; the folder belongs to one input. Without it a stage goes once the next is stored.
    """
    stages = folder or f"{work_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    docs, before = documents(spark, sf_dir), None
    for number, (name, stage) in enumerate(STAGES, 1):
        path = f"{stages.rstrip('/')}/{number}-{name}"
        if not _complete(spark, path):
            with intermediates(spark):
                made = stage(spark, docs, sf_dir)
                made.write.mode("overwrite").option("compression", "zstd").parquet(path)
        docs = spark.read.parquet(path)
        if before and not folder:
            remove_folder(spark, before)
        before = path
    return docs
