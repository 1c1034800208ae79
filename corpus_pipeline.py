"""The corpus pipeline: documents through five stages, each written as Parquet
and read again.  ``ORACLE_SQL`` is None: learned stages and hash fingerprints
are not expressible in SQL; tests/llm checks the stages against brute force."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lexisift.llm import decontaminate, mixing, quality, simhash, toxicity
from lexisift.llm.common import written

ORACLE_SQL = None


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.drop_toxic(docs, _table(spark, sf_dir, "labels"))


def drop_bad(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.drop_bad(docs, _table(spark, sf_dir, "labels"))


def keep_one(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one(docs, shingle=3, max_bits=3)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.drop_contaminated(docs, _table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("quality classifier", drop_bad),
    ("SimHash near-dedup", keep_one),
    ("benchmark decontamination", drop_contaminated),
    ("mixing sources to target weights", mix_sources),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name.split()[0].lower())
    return docs
