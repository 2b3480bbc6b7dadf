"""Similarity, object paths, JSON records and run ids as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def similarity(a: Column, b: Column) -> Column:
    """1 - edit distance / longer length; two equal values, empty ones too, give 1."""
    share = F.levenshtein(a, b) / F.greatest(F.length(a), F.length(b))
    return F.when((a == "") & (b == ""), F.lit(1.0)).otherwise(F.lit(1.0) - share)


def edit_budget(length: Column, threshold: float) -> Column:
    """The most edits two values may differ by when the longer one has `length` characters."""
    return F.floor(length * F.lit(1.0 - threshold) + F.lit(1e-9)).cast("int")


def is_similar(a: Column, b: Column, threshold: float) -> Column:
    """`similarity(a, b) >= threshold` (to 1e-9), as one banded edit distance.

    It stops at the most edits allowed and answers -1 beyond them.
    """
    budget = edit_budget(F.greatest(F.length(a), F.length(b)), threshold)
    return F.call_function("levenshtein", a, b, budget) >= 0


def bucket_of(path: Column) -> Column:
    """First part of `scheme://bucket/key` or `bucket/key`."""
    return F.nullif(F.regexp_extract(path, r"^(?:[A-Za-z0-9]+://)?([^/]+)/?", 1), F.lit(""))


def key_of(path: Column) -> Column:
    """Everything after the bucket."""
    return F.nullif(F.regexp_extract(path, r"^(?:[A-Za-z0-9]+://)?[^/]+/(.*)$", 1), F.lit(""))


def object_uri(bucket: Column, key: Column, scheme: str = "s3") -> Column:
    return F.concat(F.lit(f"{scheme}://"), bucket, F.lit("/"), key)


def encode_record(*cols: Column | str) -> Column:
    return F.to_json(F.struct(*cols))


def decode_record(text: Column, schema: str) -> Column:
    return F.from_json(text, schema)


def run_id(ts: Column) -> Column:
    return F.date_format(ts, "yyyyMMdd_HHmmss")
