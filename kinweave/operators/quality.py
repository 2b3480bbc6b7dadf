"""Row checks, quarantine of bad rows and the data-quality report."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinweave.functions.normalize import normalizer, strip_blanks
from kinweave.schema import Attribute


def is_present(c: Column, array: bool = False) -> Column:
    """Neither NULL nor blank; an array needs an element."""
    if array:
        return c.isNotNull() & (F.size(c) > 0)
    return c.isNotNull() & (strip_blanks(c.cast("string")) != "")


def in_domain(c: Column, values: Sequence) -> Column:
    """One of `values`; NULL is not."""
    return F.coalesce(c.isin(list(values)), F.lit(False))


def is_object_path(c: Column) -> Column:
    """A bucket and a slash, with `s3://` before them or no scheme at all; a bucket has no colon."""
    return F.coalesce(c.rlike(r"^(s3://)?[^/:]+/"), F.lit(False))


def missing_attributes(attributes: Iterable[Attribute]) -> Column:
    """Names of the required attributes a row lacks, as one comma list."""
    names = [
        F.when(~is_present(F.col(a.name), a.array), F.lit(a.name)) for a in attributes if a.required
    ]
    return F.concat_ws(",", *names) if names else F.lit("")


def split_required(df: DataFrame, attributes: Sequence[Attribute]) -> tuple[DataFrame, DataFrame]:
    """Accepted rows, and rejected rows with the `missing` attributes named."""
    marked = df.withColumn("missing", missing_attributes(attributes))
    return marked.where("missing = ''").drop("missing"), marked.where("missing <> ''")


def quality_report(df: DataFrame, attributes: Sequence[Attribute]) -> DataFrame:
    """Per attribute: rows, missing values and values its normalizer refuses; one pass."""
    def counts(a: Attribute) -> Column:
        value = F.col(a.name)
        present = is_present(value, a.array)
        refused = present & normalizer(a.type, a.subtype)(value.cast("string")).isNull()
        return F.struct(
            F.lit(a.name).alias("attribute"),
            F.count(F.lit(1)).alias("n_rows"),
            F.count_if(~present).alias("n_missing"),
            F.count_if(refused).alias("n_invalid"),
        )

    row = df.agg(F.array(*[counts(a) for a in attributes]).alias("report"))
    return row.select(F.inline("report"))
