"""Target tables: create, append, insert, overwrite."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kinweave.sources.tables import quoted, text_literal


def create_target(
    spark: SparkSession, name: str, schema: T.StructType, path: str | None = None,
    fmt: str = "parquet", replace: bool = False,
) -> DataFrame:
    """Create the table unless it exists; `replace` starts an empty one, also where files of
    an earlier table lie at `path`."""
    if replace:
        spark.sql(f"DROP TABLE IF EXISTS {quoted(name)}")
    columns = ", ".join(
        f"{quoted(f.name)} {f.dataType.simpleString()}{'' if f.nullable else ' NOT NULL'}" for f in schema
    )
    location = f" LOCATION {text_literal(path)}" if path else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {quoted(name)} ({columns}) USING {fmt}{location}")
    if replace and path:
        spark.createDataFrame([], schema).write.insertInto(name, overwrite=True)
    return spark.table(name)


def _write(df: DataFrame, table: str, overwrite: bool) -> int:
    target = df.sparkSession.table(table).schema
    have = set(df.columns)
    by_name = df.select(*[
        (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in target
    ])
    seen = Observation()
    by_name.observe(seen, F.count(F.lit(1)).alias("rows")).write.insertInto(table, overwrite=overwrite)
    return seen.get["rows"]


def append_rows(df: DataFrame, table: str) -> int:
    """Append by column name; the number of rows written is counted by the write itself."""
    return _write(df, table, overwrite=False)


def insert_rows(df: DataFrame, table: str) -> int:
    """Insert supplied rows; columns the table does not have are an error, no rows give 0."""
    unknown = set(df.columns) - set(df.sparkSession.table(table).columns)
    if unknown:
        raise ValueError(f"{table} has no columns {sorted(unknown)}")
    if df.isEmpty():
        return 0
    return _write(df, table, overwrite=False)


def overwrite_rows(df: DataFrame, table: str) -> int:
    """Replace the table's rows."""
    return _write(df, table, overwrite=True)
