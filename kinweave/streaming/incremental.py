"""Matching a new batch against what is already loaded."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinweave.operators.components import components
from kinweave.operators.groups import best_link
from kinweave.plans.rules import Rule, all_links
from kinweave.session import cut
from kinweave.sinks.merge import KeyedTable
from kinweave.streaming.index import SignatureIndex, memberships, signatures

STATE = ("match_id", "score", "rule_id")


@dataclass(frozen=True)
class FrameState:
    """What is loaded, as one DataFrame without an index: it is read for every question."""

    rows: DataFrame
    id_col: str
    rules: Sequence[Rule]

    def lookup(self, ids: DataFrame, columns: Sequence[str]) -> DataFrame:
        return self.rows.select(*columns).join(ids, self.id_col, "left_semi")

    def near(self, batch: DataFrame) -> DataFrame:
        old = signatures(self.rows, self.id_col, self.rules)
        sought = signatures(batch, self.id_col, self.rules, sought=True).select("h").distinct()
        found = old.join(sought, "h", "left_semi").groupBy("h", "p").agg(F.min("id").alias(self.id_col))
        return found.select(self.id_col).distinct()

    def members(self, groups: DataFrame) -> DataFrame:
        wanted = groups.select(F.col(groups.columns[0]).alias("match_id"))
        return self.rows.select(self.id_col, "match_id").join(wanted, "match_id", "left_semi").select(self.id_col)


@dataclass(frozen=True)
class IndexedState:
    """A version of a keyed table and of its index: questions read the buckets that hold the answer."""

    table: KeyedTable
    index: SignatureIndex
    version: int

    def lookup(self, ids: DataFrame, columns: Sequence[str]) -> DataFrame:
        return self.table.lookup(ids, columns, self.version)

    def near(self, batch: DataFrame) -> DataFrame:
        return self.index.near(batch, self.version)

    def members(self, groups: DataFrame) -> DataFrame:
        return self.index.members(groups, self.version)


@dataclass(frozen=True)
class BatchMatch:
    """`rows`: (id, match_id, score, rule_id, is_new), what to merge; `entries`: what the index has to note."""

    rows: DataFrame
    entries: DataFrame


def match_batch(batch: DataFrame, loaded: DataFrame, id_col: str, rules: Sequence[Rule]) -> DataFrame:
    """The rows of `match_with` for a loaded table that is one DataFrame, without an index."""
    return match_with(batch, FrameState(loaded, id_col, rules), id_col, rules).rows


def match_with(batch: DataFrame, state: FrameState | IndexedState, id_col: str, rules: Sequence[Rule]) -> BatchMatch:
    """Match a batch of normalized records, one per id, with what is loaded.

    Groups and scores come out as if everything had been matched together.  Rules run on the batch, on one loaded row of
    each combination of values that it could match, and on the groups of records that were sent again: such a
    group is matched anew, so a record whose new values no longer match leaves it, and what
    only that record held together falls apart.  Groups that are not touched so are edges
    from a record to its `match_id`; a batch row may unite two of them, whose members then
    get a new `match_id`.
    """
    fields = sorted({name for rule in rules for name in rule.names})
    batch = cut(batch.select(id_col, *fields), "batch")
    ids = batch.select(id_col)
    again = cut(state.lookup(ids, [id_col, *fields, *STATE]), "again")
    torn = again.select("match_id").distinct()
    wanted, resent = state.near(batch), not again.isEmpty()
    if resent:
        wanted = wanted.unionByName(state.members(torn)).distinct()
    wanted = wanted.join(ids, id_col, "left_anti")
    old = state.lookup(cut(wanted, "wanted"), [id_col, *fields, *STATE])
    old = cut(old.join(torn.withColumn("is_torn", F.lit(True)), "match_id", "left").fillna(False, "is_torn"), "old")
    links = cut(all_links(batch.unionByName(old.select(id_col, *fields)), id_col, rules), "links")
    whole = old.where(~F.col("is_torn"))
    edges = links.select("id_a", "id_b").unionByName(whole.select(F.col("match_id").alias("id_a"), F.col(id_col).alias("id_b")))
    groups = cut(components(edges), "groups")
    best = cut(best_link(links).select(
        F.col("id").alias(id_col), F.col("score").alias("new_score"), F.col("rule_id").alias("new_rule")), "best")

    # Rows that are matched anew: the batch, and the rest of the groups of records sent again.
    was = [F.col(c).alias(f"old_{c}") for c in STATE]
    anew = ids.join(again.select(id_col, *was), id_col, "left").withColumn("is_new", F.lit(True)).unionByName(
        old.where("is_torn").select(id_col, *was, F.lit(False).alias("is_new")))
    anew = anew.join(groups.withColumnRenamed("id", id_col), id_col, "left").join(best, id_col, "left").select(
        id_col, F.coalesce("root", id_col).alias("match_id"), F.col("new_score").alias("score"), F.col("new_rule").alias("rule_id"), "is_new",
        *[f"old_{c}" for c in STATE])

    # Rows of other groups: a group may get another name, a row its first or a better link.
    moved = whole.select(F.col("match_id").alias("id")).distinct().join(groups, "id").where("id <> root")
    moved = cut(moved.withColumnsRenamed({"id": "match_id"}), "moved")
    rest = whole.select(id_col, *STATE)
    if not moved.isEmpty():
        rest = rest.unionByName(state.lookup(cut(state.members(moved.select("match_id")), "members"), [id_col, *STATE])).distinct()
    rest = rest.join(moved, "match_id", "left").join(best, id_col, "left")
    place = F.create_map(*[x for i, r in enumerate(rules) for x in (F.lit(r.name), F.lit(i))])
    old_place, new_place = F.try_element_at(place, F.col("rule_id")), F.try_element_at(place, F.col("new_rule"))
    better = F.col("new_rule").isNotNull() & (
        F.col("rule_id").isNull() | (new_place < old_place)
        | ((new_place == old_place) & (F.col("new_score") > F.col("score")))
    )
    rest = rest.where(F.col("root").isNotNull() | better).join(anew.select(id_col), id_col, "left_anti").select(
        id_col, F.coalesce("root", "match_id").alias("match_id"), F.when(better, F.col("new_score")).otherwise(F.col("score")).alias("score"),
        F.when(better, F.col("new_rule")).otherwise(F.col("rule_id")).alias("rule_id"), F.lit(False).alias("is_new"), *was)

    # Rows that come out as they were are left alone.
    both = cut(anew.unionByName(rest), "found")
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"old_{c}")) for c in STATE])
    rows = both.where(F.col("is_new") | ~same).select(F.col(id_col).alias("id"), *STATE, "is_new")

    # The index: new signatures of the batch and lost ones of records sent again, and members that changed groups.
    stay = F.col("old_match_id").isNull() | (F.col("old_match_id") != F.col("match_id"))
    gained = signatures(batch, id_col, rules).unionByName(memberships(both.where(stay), id_col))
    left = both.where(F.col("old_match_id") != F.col("match_id")).select(id_col, F.col("old_match_id").alias("match_id"))
    lost = memberships(left, id_col)
    if resent:
        lost = lost.unionByName(signatures(again.select(id_col, *fields), id_col, rules))
    entries = gained.withColumn("live", F.lit(True)).unionByName(lost.withColumn("live", F.lit(False)))
    return BatchMatch(rows, entries)
