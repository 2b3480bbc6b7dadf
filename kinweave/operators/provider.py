"""Matching against an external identity table the caller supplies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinweave.session import cut


def key_digest(c: Column) -> Column:
    """The form in which identity tables carry keys: hex SHA-256."""
    return F.sha2(c, 256)


def provider_match(
    df: DataFrame, id_col: str, key: str, reference: DataFrame,
    reference_key: str = "key_hash", reference_id: str = "provider_id",
) -> DataFrame:
    """(id, provider_id): each record with the identity its key has, NULL when it has none.

    A key the reference lists twice gives its smallest identity.  Rows without a key skip
    the join: however many there are, they would all meet in one task.  Whether the
    reference is broadcast is left to Spark's size check; where it is not, AQE splits a
    key that very many records share, as the reference is cut into a table first.
    """
    unique = reference.groupBy(F.col(reference_key).alias("digest")).agg(
        F.min(reference_id).alias("provider_id")
    )
    keyed = df.where(F.col(key).isNotNull()).select(
        F.col(id_col).alias("id"), key_digest(F.col(key)).alias("digest")
    )
    found = keyed.join(cut(unique, "identities"), "digest", "left").select("id", "provider_id")
    without = df.where(F.col(key).isNull()).select(
        F.col(id_col).alias("id"), F.lit(None).cast(unique.schema["provider_id"].dataType).alias("provider_id")
    )
    return found.unionByName(without)


def provider_links(matched: DataFrame) -> DataFrame:
    """(id_a, id_b, score): records with one identity, linked to the smallest of them."""
    from kinweave.operators.exact import exact_links

    return exact_links(matched, "id", ["provider_id"]).withColumn("score", F.lit(1.0))
