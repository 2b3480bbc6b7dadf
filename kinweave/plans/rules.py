"""Matching rules: an ordered OR of ANDs of field tests.

Every rule is its own equi-join; the OR is a union of their links.  (One join on the OR
itself would plan as a nested loop.)  Each rule puts records into rule groups:

* exact fields only: records with equal keys;
* with fuzzy fields: connected components of the similar pairs.

A rule group is written as links to its smallest id, so the size of the output is linear
in the input.  Each end of a link carries the score of its own best pair: 1 for exact rules
and equal copies, otherwise the highest mean field score of a pair the rule found.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kinweave.operators.components import components, thinned
from kinweave.operators.exact import exact_links
from kinweave.operators.ladder import linking_pairs
from kinweave.operators.similarity import FuzzyField, copy_links, profiles, similar_pairs
from kinweave.schema import Attribute
from kinweave.session import cut


@dataclass(frozen=True)
class Exact:
    """The field's normalized values are equal."""

    name: str


class Fuzzy(FuzzyField):
    """The field's normalized values reach a similarity threshold."""


@dataclass(frozen=True)
class Rule:
    """All field tests hold, and the mean field score reaches `min_score`."""

    name: str
    fields: tuple[Exact | Fuzzy, ...]
    min_score: float = 0.0

    def __post_init__(self) -> None:
        object.__setattr__(self, "fields", tuple(self.fields))
        if not self.fields:
            raise ValueError(f"rule {self.name} has no fields")
        if not 0.0 <= self.min_score <= 1.0:
            raise ValueError(f"rule {self.name}: min_score must lie between 0 and 1")

    @property
    def exact(self) -> list[str]:
        return [f.name for f in self.fields if isinstance(f, Exact)]

    @property
    def fuzzy(self) -> list[FuzzyField]:
        return [f for f in self.fields if isinstance(f, FuzzyField)]

    @property
    def names(self) -> list[str]:
        return [f.name for f in self.fields]


def parse_rules(document: Mapping, min_score: float = 0.0) -> list[Rule]:
    """Rules from the documented JSON forms: `MatchingKeys`, or `Rules` with names, each a list
    of fields; a `MatchingThreshold` is the least score of a pair where none is given."""
    rules = []
    min_score = min_score or float(document.get("MatchingThreshold", 0.0))
    entries = document["Rules"] if "Rules" in document else document["MatchingKeys"]
    for number, entry in enumerate(entries, start=1):
        fields: list[Exact | Fuzzy] = []
        keys = entry.get("MatchingKeys", entry.get("MatchingKey"))
        for f in ({"FieldName": k} if isinstance(k, str) else k for k in keys):
            if f.get("ExactMatch", True):
                fields.append(Exact(f["FieldName"]))
            else:
                fields.append(Fuzzy(f["FieldName"], float(f["FuzzyMatchScore"])))
        rules.append(Rule(entry.get("RuleName", f"Rule-{number}"), tuple(fields), min_score))
    return rules


def default_rules(attributes: Iterable[Attribute]) -> list[Rule]:
    """One exact rule per match key; the members of a group make one rule together."""
    keys: dict[str, list[str]] = {}
    for a in attributes:
        if a.match_key:
            keys.setdefault(a.group or a.name, []).append(a.name)
    return [
        Rule(f"Rule-{i}", tuple(Exact(n) for n in names))
        for i, names in enumerate(keys.values(), start=1)
    ]


def spread(df: DataFrame, id_col: str, names: Sequence[str]) -> DataFrame:
    """`id_col` and the fields, one row for each element of an array field: records match
    when any of their elements do."""
    out = df.select(id_col, *names)
    for name in names:
        if isinstance(df.schema[name].dataType, T.ArrayType):
            out = out.withColumn(name, F.explode(F.array_distinct(name)))
    return out


def rule_pairs(df: DataFrame, id_col: str, rule: Rule, **limits: float) -> DataFrame:
    """(id_a, id_b, score): similar pairs of profiles, and copies linked to theirs.

    A profile stands for all records with the same compared values, under its smallest id.
    `limits` are those of `similar_pairs`.
    """
    df = spread(df, id_col, rule.names)
    if not rule.fuzzy:
        return exact_links(df, id_col, rule.names).distinct().withColumn("score", F.lit(1.0))
    distinct_rows = cut(profiles(df, id_col, rule.names), "profiles")
    copies = copy_links(df, id_col, rule.names, distinct_rows)
    return copies.unionByName(similar_pairs(distinct_rows, rule.exact, rule.fuzzy, rule.min_score, **limits))


def best_scores(pairs: DataFrame) -> DataFrame:
    """(id, best): the score of every record's best pair."""
    ends = pairs.select(F.col("id_a").alias("id"), "score").unionByName(pairs.select(F.col("id_b").alias("id"), "score"))
    return ends.groupBy("id").agg(F.max("score").alias("best"))


def rule_links(df: DataFrame, id_col: str, rule: Rule, **limits: float) -> DataFrame:
    """(id_a, id_b, score_a, score): the rule's groups as links to their smallest id.

    `score_a` and `score` are those of the best pair that the rule found for `id_a` and for
    `id_b`, with whomever: never below what the rule asks of a pair.
    """
    df = spread(df, id_col, rule.names)
    if not rule.fuzzy:
        links = exact_links(df, id_col, rule.names).distinct()
        return links.select("id_a", "id_b", F.lit(1.0).alias("score_a"), F.lit(1.0).alias("score"))
    distinct_rows = cut(profiles(df, id_col, rule.names), "profiles")
    copies = copy_links(df, id_col, rule.names, distinct_rows).distinct()
    pairs = cut(linking_pairs(distinct_rows, rule.exact, rule.fuzzy, rule.min_score, **limits), "pairs")
    best = cut(best_scores(pairs), "best")
    member = components(thinned(pairs.select("id_a", "id_b"))).where("id <> root")
    stars = member.join(best, "id").join(best.select(F.col("id").alias("root"), F.col("best").alias("root_best")), "root")
    stars = stars.select(
        F.col("root").alias("id_a"), F.col("id").alias("id_b"), F.col("root_best").alias("score_a"), F.col("best").alias("score"))
    return copies.select("id_a", "id_b", F.lit(1.0).alias("score_a"), "score").unionByName(stars)


def all_links(df: DataFrame, id_col: str, rules: Sequence[Rule], **limits: float) -> DataFrame:
    """Links of all rules; where several rules give the same link, the first one counts,
    and of one rule the best scores."""
    parts = None
    for index, rule in enumerate(rules, start=1):
        part = rule_links(df, id_col, rule, **limits).select(
            "id_a", "id_b", F.lit(index).alias("rule_index"), F.lit(rule.name).alias("rule_id"), "score_a", "score"
        )
        parts = part if parts is None else parts.unionByName(part)
    if parts is None:
        raise ValueError("no rules given")
    best = F.struct("rule_index", "rule_id", "score_a", "score")
    order = F.struct("rule_index", -F.col("score_a"), -F.col("score"))
    return (
        parts.groupBy("id_a", "id_b").agg(F.min_by(best, order).alias("best"))
        .select("id_a", "id_b", "best.*")
    )
