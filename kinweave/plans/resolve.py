"""The process job: input, match, output, statistics."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinweave.operators.components import components
from kinweave.operators.groups import job_stats, match_records, unmatched
from kinweave.operators.mapping import map_schema, normalize
from kinweave.operators.model import Matcher, model_links, pair_features
from kinweave.operators.provider import provider_links, provider_match
from kinweave.operators.quality import split_required
from kinweave.plans.rules import Rule, all_links, default_rules, rule_pairs
from kinweave.schema import Attribute
from kinweave.session import cut
from kinweave.sinks.writers import write_results

TECHNIQUES = ("provider", "rule", "model")


@dataclass(frozen=True)
class Provider:
    """An identity table and the attribute its keys are digests of."""

    reference: DataFrame
    key: str
    reference_key: str = "key_hash"
    reference_id: str = "provider_id"


@dataclass(frozen=True)
class Model:
    """A fitted matcher, the loose rule that proposes pairs to it, and its threshold."""

    matcher: Matcher
    candidates: Rule
    threshold: float = 0.9


@dataclass(frozen=True)
class ResolveResult:
    """Lazy outputs of a job; None where a dry run stops."""

    technique: str
    normalized: DataFrame
    rejected: DataFrame
    links: DataFrame | None = None
    groups: DataFrame | None = None
    records: DataFrame | None = None
    unmatched: DataFrame | None = None
    stats: DataFrame | None = None
    output: str | None = None


def choose_technique(
    technique: str | None, rules: Sequence[Rule] | None, model: Model | None, provider: Provider | None
) -> str:
    """The one asked for; else provider, rules, model in this order by what is given; else
    the default rules."""
    if technique:
        if technique not in TECHNIQUES:
            raise ValueError(f"unknown technique {technique!r}; use one of {TECHNIQUES}")
        needs = {"provider": provider, "model": model}
        if technique in needs and needs[technique] is None:
            raise ValueError(f"technique {technique} needs its {technique} argument")
        return technique
    if provider is not None:
        return "provider"
    if rules:
        return "rule"
    return "model" if model is not None else "rule"


def find_links(
    normalized: DataFrame, id_col: str, technique: str,
    rules: Sequence[Rule], model: Model | None, provider: Provider | None,
) -> DataFrame:
    """(id_a, id_b, rule_index, rule_id, score) of one technique."""
    if technique == "rule":
        return all_links(normalized, id_col, rules)
    if technique == "provider":
        matched = provider_match(
            normalized, id_col, provider.key, provider.reference, provider.reference_key, provider.reference_id
        )
        links = provider_links(matched)
    else:
        pairs = cut(rule_pairs(normalized, id_col, model.candidates), "candidates")
        features = pair_features(pairs, normalized, id_col, model.matcher.fields)
        links = model_links(features, model.matcher, model.threshold)
    return links.select(
        "id_a", "id_b", F.lit(1).alias("rule_index"), F.lit(None).cast("string").alias("rule_id"),
        F.col("score").alias("score_a"), "score",
    )


def resolve(
    df: DataFrame, attributes: Sequence[Attribute], id_col: str = "id",
    rules: Sequence[Rule] | None = None, technique: str | None = None,
    model: Model | None = None, provider: Provider | None = None, include_source: bool = True,
    carry: Sequence[str] = (), threshold: float | None = None, dry_run: bool = False,
    output: str | None = None, fmt: str = "json", run: str | datetime | None = None,
    source_fields: Mapping[str, str] | None = None,
) -> ResolveResult:
    """Match the records of `df`.

    `source_fields` names the source column of each attribute that is called otherwise there.

    Rows that lack a required attribute are rejected.  Keys are normalized once into a
    table of the shared folder, from which every rule scans just its columns; source
    fields stay out of all matching shuffles and are joined to the result at the end.
    `threshold` is the least score of a matching pair: for rules that ask for less, and in
    place of the model's own.  `carry` columns (a source name, say) pass through to `normalized`.  With `output` the
    records are written there.  A dry run plans the input and does no matching.
    """
    chosen = choose_technique(technique, rules, model, provider)
    if source_fields is not None:
        df = map_schema(df, attributes, source_fields, carry)
    rules = list(rules or default_rules(attributes))
    if threshold is not None:
        rules = [replace(r, min_score=max(r.min_score, threshold)) for r in rules]
        model = replace(model, threshold=threshold) if model else None
    fields = [a.name for a in attributes if a.name != id_col]
    typed = df.select(id_col, *[c for c in df.columns if c in set(fields) | set(carry)])
    accepted, rejected = split_required(typed, attributes)
    keys = [a for a in attributes if a.name != id_col]
    normalized = normalize(accepted, keys, keep=[id_col, *carry])
    if dry_run:
        return ResolveResult(chosen, normalized, rejected)
    normalized = cut(normalized, "normalized")
    links = cut(find_links(normalized, id_col, chosen, rules, model, provider), "links")
    groups = components(links)
    records = match_records(
        accepted, id_col, groups, links, [id_col, *fields] if include_source else (), chosen
    )
    path = write_results(records, output, fmt, run) if output else None
    return ResolveResult(
        chosen, normalized, rejected, links, groups, records, unmatched(accepted, id_col, groups),
        job_stats(records), path,
    )

