"""Match output: records with their group, unmatched records, counts and id mapping."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinweave.session import cut


def best_link(links: DataFrame) -> DataFrame:
    """Per record, its link of the first rule, of those the one with the highest score."""
    ends = links.select(F.col("id_a").alias("id"), "rule_index", "rule_id", F.col("score_a").alias("score")).unionByName(
        links.select(F.col("id_b").alias("id"), "rule_index", "rule_id", "score")
    )
    best = F.struct("rule_index", (-F.col("score")).alias("down"), "rule_id")
    return ends.groupBy("id").agg(F.min(best).alias("best")).select(
        "id", F.col("best.rule_id").alias("rule_id"), (-F.col("best.down")).alias("score"),
        F.col("best.rule_index").alias("rule_index"),
    )


def match_records(
    df: DataFrame, id_col: str, groups: DataFrame, links: DataFrame,
    source_fields: Sequence[str] = (), match_type: str = "rule",
) -> DataFrame:
    """One output record per input record; `groups` is (id, root).

    An unmatched record is a group of its own: `matchId` is its id, the rest is NULL.
    """
    found = groups.join(best_link(links), "id", "left").select(
        F.col("id").alias(id_col), "root", "score", "rule_id",
    )
    fields = [F.struct(*[f for f in source_fields]).alias("sourceFields")] if source_fields else []
    joined = df.join(found, id_col, "left")
    return joined.select(
        F.col(id_col).alias("sourceId"),
        F.coalesce("root", id_col).alias("matchId"),
        F.col("score").alias("confidenceScore"),
        F.when(F.col("root").isNotNull(), F.lit(match_type)).alias("matchType"),
        F.col("rule_id").alias("ruleId"),
        *fields,
    )


def unmatched(df: DataFrame, id_col: str, groups: DataFrame) -> DataFrame:
    """Input records that are in no group."""
    return df.join(groups.select(F.col("id").alias(id_col)), id_col, "left_anti")


def group_sizes(records: DataFrame, match_id: str = "matchId") -> DataFrame:
    return records.groupBy(match_id).agg(F.count(F.lit(1)).alias("group_size"))


def size_distribution(records: DataFrame, match_id: str = "matchId") -> DataFrame:
    """How many groups there are of each size."""
    return group_sizes(records, match_id).groupBy("group_size").agg(F.count(F.lit(1)).alias("n_groups"))


def job_stats(records: DataFrame, match_id: str = "matchId") -> DataFrame:
    """Input records, matched records and groups of two or more."""
    return group_sizes(records, match_id).agg(
        F.coalesce(F.sum("group_size"), F.lit(0)).alias("input_records"),
        F.coalesce(F.sum(F.when(F.col("group_size") > 1, F.col("group_size"))), F.lit(0)).alias("matched_records"),
        F.count_if(F.col("group_size") > 1).alias("match_groups"),
    )


def id_mapping(records: DataFrame, namespace: str, id_col: str, match_id: str) -> DataFrame:
    """(ns_from, id_from, ns_to, id_to, match_id): each id in the terms of every other
    namespace of its group, where the group's smallest id speaks for a namespace.

    Linear: a group gives one row per member and other namespace, never member times member.
    The speakers are cut into a table so that AQE can split the join of a large group.
    """
    speakers = records.groupBy(match_id, F.col(namespace).alias("ns_to")).agg(F.min(id_col).alias("id_to"))
    members = records.select(match_id, F.col(namespace).alias("ns_from"), F.col(id_col).alias("id_from"))
    return members.join(cut(speakers, "speakers"), match_id).where("ns_from <> ns_to").select(
        "ns_from", "id_from", "ns_to", "id_to", F.col(match_id).alias("match_id")
    )


def id_graph(records: DataFrame, namespace: str, id_col: str, match_id: str) -> DataFrame:
    """(ns, id, match_id): the edges from ids to the entities they stand for."""
    return records.select(
        F.col(namespace).alias("ns"), F.col(id_col).alias("id"), F.col(match_id).alias("match_id")
    ).distinct()
