"""Exact dedup by content sort.

Texts are range-partitioned by sampled splitters and sorted outside memory, so equal ones lie
side by side; a window over the sorted rows compares each whole text with its neighbour's.
The splitters see the first bytes, then a 64-bit fingerprint of the whole text, so a sample
row is small however long the texts are.  A text with very many copies is a run that several
partitions share: the most frequent fingerprints get a salt, and their few groups are
aggregated before anything is shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kinweave.llm.common import shuffle_width, squeeze
from kinweave.session import cut

# Characters of a text without its blanks that the sampled splitters see before its fingerprint.
HEAD = 48


def _best(points: Column, key: Column) -> Column:
    """Smallest for the text with the most code points, then the smallest id, NULL last."""
    return F.struct((-points).alias("less"), key.isNull().alias("no_id"), key.alias("id"))


def _frequent(docs: DataFrame, text: str) -> DataFrame:
    """(h) of the most frequent fingerprints, four times as many as there are shuffle partitions:
    any text that fills more than a quarter of a partition's share is among them."""
    width = shuffle_width(docs.sparkSession)
    counts = docs.groupBy(F.xxhash64(squeeze(F.col(text))).alias("h")).count().where("count > 1")
    return cut(counts.orderBy(F.desc("count"), "h").limit(4 * width).select("h"), "frequent")


def mark_copies(docs: DataFrame, key: str = "doc_id", text: str = "text", carry: Sequence[str] = ()) -> DataFrame:
    """Every row of `docs` with its group of equal texts.

    Returns key, `carry`, and keep_id, group_size, kept, text_sha256.  Texts are equal when
    they are after deleting [\\x20\\x09-\\x0D]; of equal ones the row with the most code points,
    then the smallest key stays.  Defined cases: NULL text is empty; empty texts equal each
    other; a NULL key comes after all others, and keep_id is NULL where only such rows
    share a text; of repeated rows (same key and text) one is kept; an empty table gives no
    rows; other columns are ignored unless listed in `carry`, and may have any name but
    those of the result.
    """
    width = shuffle_width(docs.sparkSession)
    inner = docs.select(
        F.col(key).alias("_key"), F.col(text).alias("_text"), *[F.col(c).alias(f"_carry_{i}") for i, c in enumerate(carry)]
    )
    points = F.length(F.coalesce("_text", F.lit("")))
    hot = F.broadcast(_frequent(docs, text))
    fingerprint = F.xxhash64(squeeze(F.col("_text")))

    # At most 4 * width groups, summed up where the rows lie.
    groups = cut(
        inner.select("_key", "_text").withColumn("h", fingerprint).join(hot, "h")
        .groupBy("h", F.unhex(F.sha2(squeeze(F.col("_text")), 256)).alias("g_sha"))
        .agg(F.min(_best(points, F.col("_key"))).alias("g_best"), F.count(F.lit(1)).alias("g_size")),
        "groups",
    )
    salt = F.when(F.col("is_hot"), F.pmod(F.xxhash64("_key"), F.lit(width))).otherwise(0)
    placed = (
        inner.withColumn("h", fingerprint)
        .withColumn("_head", F.substring(squeeze(F.col("_text")), 1, HEAD))
        .join(hot.withColumn("is_hot", F.lit(True)), "h", "left").withColumn("_salt", salt)
        .repartitionByRange("_head", "h", "_salt")
        .withColumn("_norm", squeeze(F.col("_text")))
    )
    run = Window.partitionBy("_head", "h", "_salt", "_norm")
    ordered = run.orderBy(_best(points, F.col("_key")))
    whole = run.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    runs = placed.select(
        "_key", *[f"_carry_{i}" for i in range(len(carry))], "is_hot", "h",
        _best(points, F.col("_key")).alias("_best"), F.sha2("_norm", 256).alias("_sha"),
        F.row_number().over(ordered).alias("_place"), F.count(F.lit(1)).over(whole).alias("_size"),
        F.min(_best(points, F.col("_key"))).over(whole).alias("_first"),
    )
    joined = runs.join(
        F.broadcast(groups.select("h", F.lower(F.hex("g_sha")).alias("_sha"), "g_best", "g_size")), ["h", "_sha"], "left"
    )
    best = F.coalesce("g_best", "_first")
    return joined.select(
        F.col("_key").alias(key), *[F.col(f"_carry_{i}").alias(c) for i, c in enumerate(carry)],
        best["id"].alias("keep_id"), F.coalesce("g_size", "_size").alias("group_size"),
        ((F.col("_place") == 1) & F.col("_best").eqNullSafe(best)).alias("kept"), F.col("_sha").alias("text_sha256"),
    )


def drop_copies(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The kept rows of `docs`, with its own columns."""
    others = [c for c in docs.columns if c != key]
    marked = mark_copies(docs.select(key, *[F.col(c).alias(f"c{i}") for i, c in enumerate(others)]), key,
                         f"c{others.index(text)}", [f"c{i}" for i in range(len(others))])
    names = {c: F.col(f"c{i}").alias(c) for i, c in enumerate(others)}
    return marked.where("kept").select(*[names.get(c, F.col(key)) for c in docs.columns])
