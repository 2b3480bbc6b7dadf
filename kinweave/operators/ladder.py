"""Best pairs, groups and best partners without all pairs of a dense crowd.

Similar pairs are looked for by falling scores.  A pair of score t lacks no more than
(1 - t) times the number of fields, so each of its fields reaches a threshold raised
accordingly, and the search at t is a similarity join that lists all pairs from t on.

* A record that has a pair of score t or more has its best pair among those listed, and all
  its later pairs are only needed for what they link.  So a step looks for pairs between
  different components of what earlier steps linked; records without a pair are components
  of their own.  A crowd that is one component costs nothing any more.
* A record with k partners from t on has its best k among them and asks no further.

* Where rows meet by fields with few values, large blocks of them are compared in tiles
  instead (`tiles`), which list about a pair a row.

The steps only choose the order; the last one has the thresholds asked for, so the result
is that of all pairs.  A table without crowded signatures is done in that one step.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kinweave.operators.components import components, thinned
from kinweave.operators.similarity import (
    ASKS, ROOT, SPLIT_GAIN, SPLIT_PAIRS, WORTH_PLANNING, FuzzyField, Plan, _plan, crowds, similar_pairs,
)
from kinweave.operators.tiles import TILED_PAIRS, linked_blocks
from kinweave.session import cut

# Steps between the score of equal values (0) and the least score a pair can have (1).
STEPS = (0.25, 0.5)
# Below this many candidate pairs in crowded signatures, steps cost more than they save.
WORTH_CLIMBING = 200_000_000
# Scores are rounded to 6 places.
ROUNDING = 1e-6


def step_scores(exact: Sequence[str], fuzzy: Sequence[FuzzyField], min_score: float, steps: Sequence[float]) -> list[float]:
    """Falling scores to look from, all above the least that a pair can have."""
    least = max(min_score, (len(exact) + sum(f.threshold for f in fuzzy)) / (len(exact) + len(fuzzy)))
    return [round(1.0 - (1.0 - least) * step, 6) for step in sorted(steps) if 0 < step < 1 and least < 1.0 - ROUNDING]


def raised(exact: Sequence[str], fuzzy: Sequence[FuzzyField], score: float) -> list[FuzzyField]:
    """The thresholds that the fields of every pair of at least this score reach."""
    lack = (len(exact) + len(fuzzy)) * (1.0 - score + ROUNDING)
    return [FuzzyField(f.name, min(max(f.threshold, 1.0 - lack), 1.0 - ROUNDING)) for f in fuzzy]


def _is_crowded(
    rows: DataFrame, exact: Sequence[str], fuzzy: Sequence[FuzzyField], worth: float, limits: dict[str, float],
    plan: Plan | None = None,
) -> tuple[bool, Plan | None]:
    """Whether steps are worth it, and the plan of all pairs if it was made for that; a table too
    small for that many pairs is not asked."""
    if worth <= 0 or rows.count() ** 2 < worth:
        return worth <= 0, plan
    counted = {"split_pairs": SPLIT_PAIRS, "split_gain": SPLIT_GAIN, "worth_planning": WORTH_PLANNING} | limits
    plan = plan or _plan(rows, exact, fuzzy, counted["worth_planning"])
    return crowds(rows, exact, fuzzy, counted["split_pairs"], counted["split_gain"], plan) >= worth, plan


def linking_pairs(
    rows: DataFrame, exact: Sequence[str], fuzzy: Sequence[FuzzyField], min_score: float = 0.0,
    steps: Sequence[float] = STEPS, worth_climbing: float = WORTH_CLIMBING, **limits: float,
) -> DataFrame:
    """(id_a, id_b, score): some of the similar pairs of profile rows, with the same connected
    components as all of them and with a best pair of every row that has one.

    Rows that meet in large blocks, by fields with few values, are compared there, tile by
    tile, and no pair but those is listed.

    Runs jobs: a similarity join and the components a step.
    """
    plan = None
    if worth_climbing > 0 and rows.count() ** 2 >= worth_climbing:
        plan = _plan(rows, exact, fuzzy, limits.get("worth_planning", WORTH_PLANNING), TILED_PAIRS)
        if plan[0] and (found := linked_blocks(rows, exact, fuzzy, min_score, plan)) is not None:
            return found
    crowded, plan = _is_crowded(rows, exact, fuzzy, worth_climbing, limits, plan)
    if not crowded:
        return similar_pairs(rows, exact, fuzzy, min_score, **limits, plan=plan)
    found = None
    marked, mark = rows, None
    for score in step_scores(exact, fuzzy, min_score, steps):
        pairs = similar_pairs(marked, exact, raised(exact, fuzzy, score), score, **limits, mark=mark, fine=True)
        pairs = cut(pairs, "step")
        found = pairs if found is None else found.unionByName(pairs)
        member = components(thinned(found.select("id_a", "id_b"))).select(F.col("id").alias("pid"), F.col("root").alias(ROOT))
        marked = cut(rows.join(member, "pid", "left").withColumn(ROOT, F.coalesce(ROOT, "pid")), "marked")
        mark = ROOT
    rest = similar_pairs(marked, exact, fuzzy, min_score, **limits, mark=mark, plan=plan)
    return rest if found is None else found.unionByName(rest)


def _ranked(pairs: DataFrame, k: int) -> DataFrame:
    """(pid, partner, score): the best `k` listed partners of either end."""
    both_ways = pairs.select(F.col("id_a").alias("pid"), F.col("id_b").alias("partner"), "score").unionByName(
        pairs.select(F.col("id_b").alias("pid"), F.col("id_a").alias("partner"), "score")
    )
    rank = Window.partitionBy("pid").orderBy(F.desc("score"), "partner")
    return both_ways.withColumn("r", F.row_number().over(rank)).where(F.col("r") <= k).drop("r")


def best_partners(
    rows: DataFrame, exact: Sequence[str], fuzzy: Sequence[FuzzyField], k: int, min_score: float = 0.0,
    steps: Sequence[float] = STEPS, worth_climbing: float = WORTH_CLIMBING, **limits: float,
) -> DataFrame:
    """(pid, partner, score): the best `k` similar profile rows of each, by score, then id."""
    crowded, plan = _is_crowded(rows, exact, fuzzy, worth_climbing, limits)
    if not crowded:
        return _ranked(similar_pairs(rows, exact, fuzzy, min_score, **limits, plan=plan), k)
    marked = rows.withColumn(ASKS, F.lit(True))
    done = None
    for score in [*step_scores(exact, fuzzy, min_score, steps), None]:
        last = score is None
        fields = fuzzy if last else raised(exact, fuzzy, score)
        pairs = similar_pairs(
            marked, exact, fields, min_score if last else score, **limits, mark=ASKS, fine=not last, plan=plan if last else None)
        best = cut(_ranked(pairs, k).join(marked.where(ASKS).select("pid"), "pid", "left_semi"), "partners")
        if not last:
            proven = best.groupBy("pid").count().where(F.col("count") >= k).select("pid")
            best = best.join(proven, "pid", "left_semi")
            left = proven.withColumn("_proven", F.lit(True))
            marked = cut(
                marked.join(left, "pid", "left").withColumn(ASKS, F.col(ASKS) & F.col("_proven").isNull()).drop("_proven"),
                "marked")
        done = best if done is None else done.unionByName(best)
    return done
