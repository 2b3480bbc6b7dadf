"""Golden records: one row per match group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Names of the two reconciliation modes.
FIRST_SOURCE = "CHOOSE_FIRST_SOURCE"
NO_MERGE = "NONE"


def source_rank(source: str, priority: Sequence[str]) -> Column:
    """Position of a source in the priority list; sources not listed come last."""
    place = F.array_position(F.array(*[F.lit(s) for s in priority]), F.col(source))
    return F.when(place > 0, place).otherwise(F.lit(len(priority) + 1)).cast("int")


def golden_records(
    records: DataFrame, attributes: Sequence[str], priority: Sequence[str],
    match_id: str = "match_id", id_col: str = "id", source: str = "source",
    mode: str = FIRST_SOURCE,
) -> DataFrame:
    """Per attribute the first value that is not NULL, by source priority and then by id.

    A partial aggregate per attribute: a group of any size costs a row per map task.
    """
    if mode == NO_MERGE:
        return records
    if mode != FIRST_SOURCE:
        raise ValueError(f"unknown reconciliation mode {mode!r}")
    ranked = records.withColumn("rank", source_rank(source, priority))
    order = F.struct("rank", id_col)
    values = [
        F.min_by(a, F.when(F.col(a).isNotNull(), order)).alias(a) for a in attributes
    ]
    return ranked.groupBy(match_id).agg(*values, F.count(F.lit(1)).alias("n_records"))
