"""kinweave: record linkage and keyed loading as Spark DataFrame jobs."""

from kinweave.plans.load import LoadResult, load
from kinweave.plans.pipeline import run_pipeline
from kinweave.plans.resolve import ResolveResult, resolve
from kinweave.plans.rules import Exact, Fuzzy, Rule, default_rules, parse_rules
from kinweave.schema import Attribute

__all__ = [
    "Attribute", "Exact", "Fuzzy", "LoadResult", "ResolveResult", "Rule", "default_rules",
    "load", "parse_rules", "resolve", "run_pipeline",
]
