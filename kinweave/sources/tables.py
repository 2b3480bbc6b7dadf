"""Catalog tables, parameterized queries and several sources as one input."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kinweave.sources.readers import CSV_DIALECT, as_struct

FORMATS = ("csv", "json", "parquet", "orc", "avro")


def quoted(name: str) -> str:
    return ".".join(f"`{part.replace('`', '``')}`" for part in name.split("."))


def text_literal(value: str) -> str:
    escaped = value.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def register_table(
    spark: SparkSession, name: str, path: str, schema: T.StructType | str, fmt: str = "csv"
) -> DataFrame:
    """Create or update an external table over the files of `path`, and read it.

    A table that owns its files is not replaced, as dropping it would delete them.
    """
    if spark.catalog.tableExists(name) and spark.catalog.getTable(name).tableType != "EXTERNAL":
        raise ValueError(f"{name} is not an external table; choose another name or drop it first")
    fmt = fmt.lower() if fmt.lower() in FORMATS else "csv"
    columns = ", ".join(f"{quoted(f.name)} {f.dataType.simpleString()}" for f in as_struct(schema))
    options = ""
    if fmt == "csv":
        options = "OPTIONS (" + ", ".join(f"{k} {text_literal(v)}" for k, v in CSV_DIALECT.items()) + ")"
    spark.sql(f"DROP TABLE IF EXISTS {quoted(name)}")
    spark.sql(
        f"CREATE TABLE {quoted(name)} ({columns}) USING {fmt} {options} LOCATION {text_literal(path)}"
    )
    return spark.table(name)


def read_table(spark: SparkSession, name: str, limit: int | None = None) -> DataFrame:
    table = spark.table(name)
    return table if limit is None else table.limit(limit)


def sql_source(spark: SparkSession, query: str, args: Mapping | list | None = None, **tables: DataFrame) -> DataFrame:
    """A caller's query with bound parameters; `{name}` in it stands for a DataFrame."""
    return spark.sql(query, args=args, **tables)


def union_sources(sources: Mapping[str, DataFrame], column: str = "source") -> DataFrame:
    """Several sources under one schema, each row marked with its source's name."""
    parts = [df.withColumn(column, F.lit(name)) for name, df in sources.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
