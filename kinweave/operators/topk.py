"""The best k partners of each record.

Ranks are by score, then by partner id.  Only k + 1 members of a group of copies can be
among the best k of anyone, and a profile needs no more than k partner profiles, so both
are bounded before records are expanded; the result is the same as ranking all pairs.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kinweave.operators.exact import all_present
from kinweave.operators.ladder import best_partners
from kinweave.operators.similarity import FuzzyField, profiles
from kinweave.session import cut


def first_members(df: DataFrame, id_col: str, fields: Sequence[str], count: int) -> DataFrame:
    """Per profile, its `count` smallest ids.

    Spark turns the filter on the rank into a group limit before the shuffle, so a profile
    with very many copies sends `count` rows per map task.
    """
    keyed = df.where(all_present(fields)).select(*fields, F.col(id_col).alias("id"))
    by_profile = Window.partitionBy(*fields).orderBy("id")
    return keyed.withColumn("r", F.row_number().over(by_profile)).where(F.col("r") <= count).drop("r")


def top_matches(
    df: DataFrame, id_col: str, exact: Sequence[str], fuzzy: Sequence[FuzzyField], k: int = 10,
    min_score: float = 0.0, **limits: float,
) -> DataFrame:
    """(id_a, id_b, score): pairs that are among the best `k` of either record."""
    if k < 1:
        raise ValueError("k must be at least 1")
    fields = [*exact, *[f.name for f in fuzzy]]
    distinct_rows = cut(profiles(df, id_col, fields), "profiles")
    kept = best_partners(distinct_rows, exact, fuzzy, k, min_score, **limits)

    pid_of = distinct_rows.select("pid", *fields)
    heads = first_members(df, id_col, fields, k + 1).join(pid_of, fields).select("pid", "id")
    others = kept.join(heads.select(F.col("pid").alias("partner"), F.col("id").alias("other")), "partner")
    own = heads.select("pid", F.col("id").alias("other"), F.lit(1.0).alias("score"))
    candidates = others.select("pid", "other", "score").unionByName(own)
    shortlist = candidates.withColumn(
        "r", F.row_number().over(Window.partitionBy("pid").orderBy(F.desc("score"), "other"))
    ).where(F.col("r") <= k + 1)

    # The list of a profile, k + 1 long at most, serves all its records: each skips itself
    # and takes the first k of the rest.
    lists = shortlist.groupBy("pid").agg(F.sort_array(F.collect_list(F.struct("r", "other", "score"))).alias("list"))
    records = df.where(all_present(fields)).select(*fields, F.col(id_col).alias("id"))
    mine = records.join(pid_of.join(lists, "pid").select(*fields, "list"), fields)
    best = mine.select(
        "id", F.inline(F.slice(F.filter("list", lambda m: m["other"] != F.col("id")), 1, k))
    )
    return best.select(
        F.least("id", "other").alias("id_a"), F.greatest("id", "other").alias("id_b"), "score"
    ).distinct()
