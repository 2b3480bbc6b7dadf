"""Equality of keys: links between records that share a key.

Records with equal keys form a group.  A group of n records is written as n - 1 links from
its smallest id to the others, never as its n * (n - 1) / 2 pairs: same groups, linear size.
The group minimum is a partial aggregate, so a key held by a third of all rows costs one
row per map task.  The minima are cut into a table before they are joined back: AQE splits
a skewed join partition only where both sides come straight from a shuffle, not where an
aggregate stands in between.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinweave.session import cut


def all_present(cols: Sequence[str]) -> Column:
    test = F.lit(True)
    for c in cols:
        test = test & F.col(c).isNotNull()
    return test


def text_digest(c: Column) -> Column:
    """32-byte key standing for a long text, so that shuffles do not carry the text."""
    return F.unhex(F.sha2(c, 256))


def exact_links(df: DataFrame, id_col: str, keys: Sequence[str]) -> DataFrame:
    """(id_a, id_b): the smallest id of each key group with every other id of it.

    A row with a NULL key part belongs to no group.  Runs the job that finds the minima;
    `df` is read twice, so a caller with costly keys cuts them into a table first.
    """
    keyed = df.select(F.col(id_col).alias("id_b"), *keys).where(all_present(keys))
    anchors = (
        keyed.groupBy(*keys)
        .agg(F.min("id_b").alias("id_a"), F.max("id_b").alias("last"))
        .where("id_a < last").drop("last")
    )
    return keyed.join(cut(anchors, "anchors"), list(keys)).where("id_b > id_a").select("id_a", "id_b")


def element_links(df: DataFrame, id_col: str, array_key: str) -> DataFrame:
    """Links between records whose array keys share an element."""
    from kinweave.operators.mapping import explode_key

    return exact_links(explode_key(df, id_col, array_key), id_col, [array_key]).distinct()


def dedup_within(df: DataFrame, id_col: str, keys: Sequence[str], source: str = "source") -> DataFrame:
    """One row per (source, keys): that with the smallest id.  NULL keys compare equal.

    The kept row travels through a partial aggregate, so a key with many copies needs no
    sort of all of them in one task.
    """
    row = F.struct(*[c for c in df.columns])
    kept = df.groupBy(source, *keys).agg(F.min_by(row, F.col(id_col)).alias("kept"))
    return kept.select("kept.*")
