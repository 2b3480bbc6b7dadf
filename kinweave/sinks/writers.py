"""Match output as files, one directory per run."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

FORMATS = ("csv", "json", "parquet", "orc")


def flatten_structs(df: DataFrame) -> DataFrame:
    """Struct fields as columns `struct_field`, for formats without nesting."""
    cols = []
    for f in df.schema:
        if isinstance(f.dataType, T.StructType):
            cols += [F.col(f"{f.name}.{n}").alias(f"{f.name}_{n}") for n in f.dataType.fieldNames()]
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def write_results(df: DataFrame, base: str, fmt: str = "json", run: str | datetime | None = None) -> str:
    """Write below `base`/output/`run`/ and return that path; an existing run is an error.

    `run` is a name or the time of the run, by default now.
    """
    fmt = fmt.lower()
    if fmt not in FORMATS:
        raise ValueError(f"unknown output format {fmt!r}; use one of {FORMATS}")
    if not isinstance(run, str):
        run = (run or datetime.now()).strftime("%Y%m%d_%H%M%S")
    path = f"{base.rstrip('/')}/output/{run}"
    writer = flatten_structs(df).write.option("header", True) if fmt == "csv" else df.write
    writer.mode("errorifexists").format(fmt).save(path)
    return path
