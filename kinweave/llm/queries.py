"""One query per operator, over whole tables, with the columns the checks ask for."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinweave.llm.collocations import collocations
from kinweave.llm.common import read
from kinweave.llm.exact_dedup import mark_copies
from kinweave.llm.jaccard_join import similar_groups
from kinweave.llm.language_id import tag_languages
from kinweave.llm.mixing import mix
from kinweave.llm.packing import pack_documents
from kinweave.llm.quality_crf import classify
from kinweave.llm.quality_rules import judge
from kinweave.llm.sharding import shards
from kinweave.llm.suffix_dedup import remove_repeats
from kinweave.llm.url_filter import judge_urls
from kinweave.llm.vector_codes import compress, digest
from kinweave.llm.warc import archive_folder, archive_records, key_of, read_warc, write_warc

SHARDS = 24


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mark_copies(read(spark, sf_dir, "documents"))


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = pack_documents(read(spark, sf_dir, "documents"))
    return packed.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"), "sequence_id", "offset")


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = judge(read(spark, sf_dir, "documents"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar_groups(read(spark, sf_dir, "documents"))


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = archive_folder(spark)
    write_warc(archive_records(read(spark, sf_dir, "pages")), folder)
    responses = read_warc(spark, folder).where("record_type = 'response'")
    revisits = read_warc(spark, folder, payload=False).where("record_type = 'revisit'")
    back = responses.withColumn("bytes", F.length("payload")).unionByName(revisits.withColumn("bytes", F.col("payload_length")))
    return back.select(
        key_of(F.col("record_id")).alias("page_id"), F.col("bytes").cast("long").alias("payload_bytes"),
        "payload_digest", "record_type", key_of(F.col("refers_to")).alias("refers_to"),
    )


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tag_languages(read(spark, sf_dir, "documents"))


def op8_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix(read(spark, sf_dir, "documents"))
    return mixed.select(
        "doc_id", "mix.size", "mix.source_size", "mix.target", (F.col("mix.times") * F.col("mix.size")).alias("taken")
    )


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(read(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict")


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = remove_repeats(read(spark, sf_dir, "documents"))
    return cleaned.select(
        "doc_id", "n_bytes", (F.col("n_bytes") - F.length("kept")).alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"),
    )


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded, books = compress(read(spark, sf_dir, "embeddings"))
    digits = F.array_join(F.transform("code", lambda c: F.lpad(F.lower(F.hex(c)), 2, "0")), "")
    return coded.select("vec_id", digits.alias("code"), "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = collocations(read(spark, sf_dir, "documents"))
    return found.select("lang", F.col("rank").cast("long"), "phrase", "a", "l", "r", "n", "score")


def op13_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    text_crc32 = F.crc32(F.coalesce("text", F.lit("")).cast("binary"))
    placed = shards(docs.withColumn("text_crc32", text_crc32), SHARDS, carry=("doc_id", "text_crc32"))
    return placed.select(
        "doc_id", "place.size", "text_crc32", F.lit("bytes").alias("law"), "place.shard", "place.slot", F.lit(None).cast("int").alias("grown_shard"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_exact_dedup, op2_quality_classifier, op3_best_fit_packing, op4_quality_rules, op5_jaccard_join, op6_warc,
        op7_language_id, op8_source_mixing, op9_url_filter, op10_suffix_dedup, op11_vector_codes, op12_collocations, op13_sharding,
    )
}
