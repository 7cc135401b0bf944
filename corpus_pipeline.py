"""From raw documents to packed training sequences, one operator per stage.

STAGES lists (name, function); a function takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet
and reread as the next stage's ``docs``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from memberlytics.llm.decontaminate import keep_clean
from memberlytics.llm.language import keep_known
from memberlytics.llm.packing import default_tokenizer, pack
from memberlytics.llm.registry import table
from memberlytics.llm.secrets import keep_unsecret
from memberlytics.llm.simhash import keep_first
from memberlytics.session import stage


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a recognised language go."""
    return keep_known(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group stays."""
    return keep_first(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark passage go."""
    return keep_clean(docs, table(spark, sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a secret go."""
    return keep_unsecret(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their token ids and places in training sequences."""
    return pack(docs, default_tokenizer())


STAGES = [
    ("language", language), ("near_duplicates", near_duplicates), ("decontamination", decontamination), ("secrets", secrets),
    ("packing", packing),
]

#: Fingerprints, a tagger and token ids are beyond SQL; tests use a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), name)
    return docs
