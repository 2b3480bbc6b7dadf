"""Match weights learned without labels: Fellegi and Sunter's model, fitted by expectation maximisation.

A pair agrees, disagrees or cannot be compared in each field; given that it is a match, or not, fields are taken to be independent.
Only the counts of agreement patterns are needed: one aggregate over the pairs, at most 3 to the number of fields rows, on which
the rounds run.  Scoring is a column expression of the fitted weights; links are those of `model_links`, which takes
this model like one that was trained on labels.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Probabilities are kept this far from 0 and 1, so that no weight is infinite.
LEAST = 1e-6


@dataclass(frozen=True)
class AgreementModel:
    """Per field the probability of agreement among matches (`m`) and among other pairs (`u`); `share`
    of all candidate pairs are matches."""

    fields: tuple[str, ...]
    least: tuple[float, ...]
    m: tuple[float, ...]
    u: tuple[float, ...]
    share: float
    rounds: int
    converged: bool

    def weights(self) -> dict[str, tuple[float, float]]:
        """(agreement, disagreement) weight of each field, in bits."""
        return {f: (math.log2(m / u), math.log2((1 - m) / (1 - u))) for f, m, u in zip(self.fields, self.m, self.u)}

    def weight(self) -> Column:
        """The weight of a pair of `pair_features`: the sum over its fields."""
        terms = []
        for name, least, (agree, differ) in zip(self.fields, self.least, self.weights().values()):
            level = agreement(name, least)
            terms.append(F.when(level == 1, F.lit(agree)).when(level == 0, F.lit(differ)).otherwise(F.lit(0.0)))
        return reduce(Column.__add__, terms, F.lit(math.log2(self.share / (1 - self.share))))

    def probability(self) -> Column:
        return 1 / (1 + F.pow(F.lit(2.0), -self.weight()))


def agreement(name: str, least: float) -> Column:
    """1 where the values of a pair are similar enough, 0 where not, NULL where one is missing."""
    return F.when(F.col(f"missing_{name}") == 0, (F.col(f"sim_{name}") >= F.lit(least)).cast("int"))


def agreement_patterns(features: DataFrame, least: Mapping[str, float]) -> DataFrame:
    """How many pairs there are of each pattern: a column per field, and `pairs`."""
    levels = [agreement(name, t).alias(name) for name, t in least.items()]
    return features.select(*levels).groupBy(*least).agg(F.count(F.lit(1)).alias("pairs"))


def fit_agreement(
    patterns: DataFrame, least: Mapping[str, float], rounds: int = 100, m: float = 0.9, u: float = 0.1, share: float = 0.1, settled: float = 1e-9,
) -> AgreementModel:
    """Expectation maximisation over pattern counts, from `m`, `u` and `share` for every field, until no probability
    moves by more than `settled`."""
    fields = list(least)
    rows = [(tuple(r[f] for f in fields), r.pairs) for r in patterns.collect()]
    if not rows:
        raise ValueError("there are no candidate pairs to learn from")
    ms, us = [m] * len(fields), [u] * len(fields)
    total, done, converged = sum(n for _, n in rows), 0, False
    while done < rounds and not converged:
        expected = []
        for pattern, _ in rows:
            match, other = share, 1 - share
            for level, pm, pu in zip(pattern, ms, us):
                if level is not None:
                    match, other = match * (pm if level else 1 - pm), other * (pu if level else 1 - pu)
            expected.append(match / (match + other))
        new = [share, *ms, *us]
        share = _inside(sum(e * n for e, (_, n) in zip(expected, rows)) / total)
        ms = [_inside(_rate(rows, expected, i)) for i in range(len(fields))]
        us = [_inside(_rate(rows, [1 - e for e in expected], i)) for i in range(len(fields))]
        done += 1
        converged = max(abs(a - b) for a, b in zip(new, [share, *ms, *us])) <= settled
    return AgreementModel(tuple(fields), tuple(least.values()), tuple(ms), tuple(us), share, done, converged)


def _inside(p: float) -> float:
    return min(max(p, LEAST), 1 - LEAST)


def _rate(rows: Sequence[tuple], weight: Sequence[float], field: int) -> float:
    """The weighted share of agreement among the patterns that can be compared in a field."""
    compared = [(w * n, p[field]) for w, (p, n) in zip(weight, rows) if p[field] is not None]
    whole = sum(w for w, _ in compared)
    return sum(w for w, level in compared if level) / whole if whole else 0.5
