"""A training corpus from the documents table, in five stages.

Every stage takes (spark, docs, sf_dir) and returns the documents it keeps, all
columns included; its result is written as Parquet and read again as the next
stage's input.  The last stage adds the slot and shard of each row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlens.llm import decontaminate, language, mixing, neardup, sharding
from fleetlens.llm.common import id_crc, ready, stored, table
from fleetlens.llm.queries import SHARDS, TABLE_SIZE
from fleetlens.plans.registry import query


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in an identifiable language; the model learns from three quarters of those that name theirs."""
    model = language.fit(docs.where(id_crc(F.col("doc_id")) % 4 != 2))
    return language.keep_known(docs, model)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies (five-word shingles, Jaccard >= 0.8)."""
    return neardup.keep_one(docs)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item occurs, up to edits of a tenth of its characters."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"), rate=0.1)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as the mix of their sources reads them, once or twice each."""
    return mixing.apply(docs, block=256)


def assign_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Slot and shard of every row, beside its columns."""
    return sharding.place(docs, sharding.document_key(docs), SHARDS, TABLE_SIZE)


STAGES = [
    ("language identification", identify_language),
    ("n-gram Jaccard join", drop_near_copies),
    ("benchmark decontamination", drop_benchmark_leaks),
    ("source mixing", mix_sources),
    ("sharding", assign_shards),
]

#: Language identification is a trained model and the edit matching has no SQL form; tests compare with brute force.
ORACLE_SQL = None


@query("pipeline", ORACLE_SQL)
def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole documents table."""
    ready(spark)
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
