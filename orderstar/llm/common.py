"""What several operators share: stored intermediate tables and tokenizer files."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import remove_folder, scratch, work_folder

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only."""
    return F.translate(text, _UPPER, _UPPER.lower())


_folders: list[str] = []


@contextmanager
def intermediates(spark: SparkSession) -> Iterator[str]:
    """Everything operators store inside the block is deleted at its end, also when it fails."""
    path = f"{work_folder(spark)}/llm/{uuid.uuid4().hex}"
    _folders.append(path)
    try:
        with scratch(spark):
            yield path
    finally:
        _folders.remove(path)
        remove_folder(spark, path)


def stored(rows: DataFrame, name: str) -> DataFrame:
    """Write rows to the shared folder and read them back: lineage ends here, executors may go.

    Outside ``intermediates`` the files stay until ``session.work_folder`` is deleted.
    """
    spark = rows.sparkSession
    folder = _folders[-1] if _folders else f"{work_folder(spark)}/llm"
    path = f"{folder}/{name}-{uuid.uuid4().hex}"
    rows.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def unused(names: list[str], wanted: str) -> str:
    """A column name like the wanted one that none of ``names`` is."""
    taken = {name.lower() for name in names}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted


def importable(spark: SparkSession) -> None:
    """Let Python workers find this package where the driver found it.

    On machines without that path the package comes with ``--py-files``, as ever.
    """
    environment = spark.sparkContext.environment
    root = str(Path(__file__).resolve().parents[2])
    paths = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([*paths, root])


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)
