"""A corpus from raw documents to packed sequences, one operator a stage.

Each stage takes all that the one before kept; `run` writes each result as Parquet in the
shared folder and reads it again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinweave.llm.exact_dedup import drop_copies
from kinweave.llm.jaccard_join import one_per_group
from kinweave.llm.language_id import UNDETERMINED, fit, identify
from kinweave.llm.mixing import mix
from kinweave.llm.packing import pack_documents
from kinweave.session import CORPUS_SETTINGS, cut, tune


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the model knows; those without a text or a letter go."""
    tune(spark, CORPUS_SETTINGS)
    return docs.where(identify(docs, fit(docs))["lang_pred"] != UNDETERMINED)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    tune(spark, CORPUS_SETTINGS)
    return drop_copies(docs)


def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    tune(spark, CORPUS_SETTINGS)
    return one_per_group(docs)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it.  The mix's answer is its last column, whatever columns the documents have."""
    tune(spark, CORPUS_SETTINGS)
    mixed = mix(docs)
    answer = mixed.columns[-1]
    times = F.col(answer)["times"]
    return mixed.where(times > 0).withColumn(answer, F.explode(F.sequence(F.lit(1), times))).select(*docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of at most 1024 tokens."""
    tune(spark, CORPUS_SETTINGS)
    packed = pack_documents(docs)
    return packed.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"), "sequence_id", "offset")


STAGES = [
    ("language_id", language_id),
    ("exact_dedup", exact_dedup),
    ("jaccard_join", jaccard_join),
    ("source_mixing", source_mixing),
    ("packing", packing),
]

# Language models, similarity and tokens have no SQL form; tests/llm has a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
