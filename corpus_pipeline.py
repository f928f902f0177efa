"""The corpus pipeline: five stages from the documents to a mixed, clean training set.

Each stage gets the rows that the one before kept and returns them with the columns of ``documents``; the last one adds
``copies``, how often a document is to be read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lendgrid.llm.decontaminate import drop_leaks
from lendgrid.llm.frames import scratch_path
from lendgrid.llm.line_dedup import drop_boilerplate
from lendgrid.llm.mixing import mix_sources
from lendgrid.llm.ordinal_quality import keep_good
from lendgrid.llm.simhash import drop_near_duplicates


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_good(docs, _table(spark, sf_dir, "labels"))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_boilerplate(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_near_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_leaks(docs, _table(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mix_sources(docs)


STAGES = [
    ("quality classifier", quality),
    ("line dedup", lines),
    ("simhash near-dedup", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("source mixing", mixing),
]

#: The classifier, the classes of near duplicates and the latent search have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's rows are written to the shared folder and read again by the next."""
    docs = _table(spark, sf_dir, "documents")
    folder = scratch_path(spark, "pipeline")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs.write.parquet(f"{folder}/{i}")
            docs = spark.read.schema(docs.schema).parquet(f"{folder}/{i}")
    return docs
