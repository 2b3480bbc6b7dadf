"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Every document draws the key -ln(u) / weight, with u from a hash of its id and its quality
as weight; in rising order the keys are a weighted sample without replacement.  A source
gives as many complete epochs as fit in its target, then documents in key order until their
prefix sum meets the rest.  Prefix sums are taken over fine buckets of the key, which are
partial aggregates; only the bucket in which a source's budget ends is sorted by key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kinweave.llm.common import WORD, squeeze
from kinweave.session import cut

BUCKETS = 16_384
LAST_ID = 9_223_372_036_854_775_807


def quality_weight(text: Column) -> Column:
    """Share of letters among the non-blank characters, at least 0.05."""
    solid = squeeze(text)
    letters = F.length(F.regexp_replace(solid, r"\P{L}+", ""))
    return F.greatest(F.lit(0.05), F.coalesce(F.try_divide(letters.cast("double"), F.length(solid).cast("double")), F.lit(0.0)))


def draw(key: Column, weight: Column, seed: int) -> Column:
    """The exponential key of a document: from an MD5 of its id, the same in every run."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("null")))
    bits = F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double")
    return -F.log((bits + 0.5) / F.lit(float(2**52))) / weight


def targets(sizes: DataFrame, most: float = 3.0) -> DataFrame:
    """(source, source_size, target) from (source, source_size), one row per source.

    Sources in code point order, NULL last, weigh 1, 2, 3, repeating.  Together the targets
    are the sum of all sizes; a target stops at `most` times its source's size and the excess
    goes to the others by weight.  That is min(level * weight, limit) with one level for all:
    with sources in the order of limit / weight, the first k being at their limits, the level
    is the first that does not exceed the next source's own ratio.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    by_ratio = Window.orderBy("ratio", F.col("source").asc_nulls_last())
    everything = by_ratio.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    level = (F.sum("source_size").over(everything) - F.coalesce(F.sum("limit").over(before), F.lit(0.0))) / F.sum(
        "weight"
    ).over(by_ratio.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    ranked = (
        sizes.withColumn("weight", ((F.row_number().over(by_name) - 1) % 3 + 1).cast("double"))
        .withColumn("limit", F.lit(most) * F.col("source_size")).withColumn("ratio", F.col("limit") / F.col("weight"))
        .withColumn("level", level)
    )
    chosen = F.min(F.when(F.col("level") <= F.col("ratio"), F.struct("ratio", "level"))).over(everything)["level"]
    return ranked.withColumn("chosen", chosen).select(
        "source", "source_size", F.least(F.col("chosen") * F.col("weight"), F.col("limit")).alias("target")
    )


def _keyed(docs: DataFrame, key: str, text: str, source: str, seed: int) -> list[Column]:
    size = F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")
    return [
        F.col(source).alias("m_source"), size.alias("m_size"),
        draw(F.col(key), quality_weight(F.col(text)), seed).alias("m_draw"),
        F.coalesce(F.col(key).try_cast("long"), F.when(F.col(key).isNotNull(), F.xxhash64(F.col(key).cast("string"))), F.lit(LAST_ID)).alias("m_id"),
    ]


def plan(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", seed: int = 0) -> DataFrame:
    """One row per source: m_source, source_size, target, epochs, and the last place (last_draw, last_id)
    in key order that is taken once more, NULL where none is.  Runs jobs."""
    bucket = F.floor(BUCKETS * (1 - F.exp(-F.col("m_draw")))).cast("int")
    keyed = cut(docs.select(*_keyed(docs, key, text, source, seed)).withColumn("bucket", bucket), "keyed")
    sums = cut(keyed.groupBy("m_source", "bucket").agg(F.sum("m_size").alias("words")), "sums")
    wanted = targets(sums.groupBy(F.col("m_source").alias("source")).agg(F.sum("words").alias("source_size")))
    epochs = F.coalesce(F.floor(F.try_divide("target", F.col("source_size").cast("double"))), F.lit(0)).cast("int")
    wanted = cut(
        wanted.withColumnRenamed("source", "m_source").withColumn("epochs", epochs)
        .withColumn("rest", F.col("target") - F.col("epochs") * F.col("source_size")),
        "wanted",
    )
    # The bucket in which each budget ends, then the place within it.
    upto = Window.partitionBy("m_source").orderBy("bucket")
    ends = (
        sums.withColumn("before", F.sum("words").over(upto) - F.col("words"))
        .join(wanted.withColumnRenamed("m_source", "w_source"), F.col("m_source").eqNullSafe(F.col("w_source")))
        .where("rest > 0 and before < rest and before + words >= rest").select("m_source", "bucket", "before", "rest")
    )
    ends = ends.withColumnsRenamed({"m_source": "e_source", "bucket": "e_bucket"})
    places = (
        keyed.join(ends, F.col("m_source").eqNullSafe(F.col("e_source")) & (F.col("bucket") == F.col("e_bucket")))
        .groupBy("m_source", "before", "rest", "m_draw", "m_id").agg(F.sum("m_size").alias("words"))
        .withColumn("total", F.col("before") + F.sum("words").over(Window.partitionBy("m_source").orderBy("m_draw", "m_id")))
    )
    near = (F.col("total") <= F.col("rest")) | (F.col("total") - F.col("rest") < F.col("rest") - (F.col("total") - F.col("words")))
    last = (
        places.groupBy("m_source", "before")
        .agg(F.max(F.when(near, F.struct("m_draw", "m_id"))).alias("last"), F.min("m_draw").alias("start"))
        # Nothing of the bucket is taken: the budget ends just before its first key.
        .select(F.col("m_source").alias("l_source"), F.coalesce(F.col("last.m_draw"), F.col("start")).alias("last_draw"),
                F.coalesce(F.col("last.m_id"), F.lit(-LAST_ID)).alias("last_id"))
    )
    joined = wanted.join(last, F.col("m_source").eqNullSafe(F.col("l_source")), "left")
    return cut(joined.select("m_source", "source_size", "target", "epochs", "last_draw", "last_id"), "plan")


def mix(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", seed: int = 0) -> DataFrame:
    """The columns of `docs`, and `mix`: a struct of size, source_size, target and times.

    `times` is how often the document stands in the mix: its source's complete epochs, and
    once more if the weighted sample reaches it.  The document on which the budget ends is
    taken when that comes nearer to the target.  Defined cases: NULL text has size 0; NULL is
    a source of its own, the last; a NULL key draws from the word null; a key need not be a number; rows with the
    same key and draw are taken together; a source without words has target 0; an empty
    table gives no rows; clashing column names are kept, as the result is one struct.
    """
    planned = plan(docs, key, text, source, seed)
    name, taken = "mix", {c.lower() for c in docs.columns}
    while name in taken:
        name = f"_{name}"
    columns = [F.col(c).alias(f"c{i}") for i, c in enumerate(docs.columns)]
    rows = docs.select(*columns, *_keyed(docs, key, text, source, seed))
    rows = rows.join(planned.withColumnRenamed("m_source", "p_source"), F.col("m_source").eqNullSafe(F.col("p_source")))
    more = F.expr("m_draw < last_draw or (m_draw = last_draw and m_id <= last_id)")
    times = F.col("epochs") + F.when(more, 1).otherwise(0)
    return rows.select(
        *[F.col(f"c{i}").alias(c) for i, c in enumerate(docs.columns)],
        F.struct(F.col("m_size").alias("size"), "source_size", "target", times.alias("times")).alias(
            name),
    )
