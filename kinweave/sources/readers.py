"""File readers with declared schemas, NULL tokens and treatment of malformed rows."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kinweave.sources.csv_records import csv_records, opens

# CSV dialects of entity files and of loads, and the tokens that mean NULL in a load.
LOAD_DIALECT = {"sep": ",", "quote": '"', "escape": '"'}
CSV_DIALECT = {"sep": ",", "quote": '"', "escape": "\\"}
NULL_TOKENS = ("NULL", "null", "")

CORRUPT = "_corrupt_record"


def _csv(spark: SparkSession, schema: T.StructType | str, header: bool, options: dict[str, str]) -> DataFrameReader:
    return spark.read.schema(schema).options(**CSV_DIALECT, **options).option("header", header)


def read_entities(
    spark: SparkSession, path: str | list[str], fmt: str = "csv",
    schema: T.StructType | str | None = None, header: bool = False, **options: str,
) -> DataFrame:
    """Entity files of a format; a format not known is read as CSV.  `options` say which files of a folder are read."""
    fmt = fmt.lower()
    if fmt in ("parquet", "orc"):
        reader = spark.read.schema(schema) if schema is not None else spark.read
        return reader.options(**options).format(fmt).load(path)
    if fmt == "avro":
        return read_avro(spark, path, schema, **options)
    if schema is None:
        raise ValueError(f"{fmt} files need a schema")
    if fmt == "json":
        return read_json_lines(spark, path, schema, **options)
    return _csv(spark, schema, header, options).csv(path)


def read_avro(spark: SparkSession, path: str | list[str], schema: T.StructType | str | None = None, **options: str) -> DataFrame:
    reader = spark.read.schema(schema) if schema is not None else spark.read
    try:
        return reader.options(**options).format("avro").load(path)
    except AnalysisException as error:
        if "find data source" in str(error):
            raise RuntimeError(
                "reading Avro needs the external spark-avro package on the session's classpath"
            ) from error
        raise


def as_struct(schema: T.StructType | str) -> T.StructType:
    return T.StructType.fromDDL(schema) if isinstance(schema, str) else schema


def read_csv_load(
    spark: SparkSession, path: str | list[str], schema: T.StructType | str, on_error: str = "abort",
) -> tuple[DataFrame, DataFrame | None]:
    """CSV with header and optional quotes, inside which `""` is a quote and lines may end: (rows, rejects).

    Large files are read in splits, whose borders may lie within a quoted field.  Every field is read as text, NULL tokens become NULL and the rest is cast; a row is
    malformed if it has another number of fields or a text that its type refuses.  `abort`
    fails the job at the first malformed row, whatever columns are selected, so there are no
    rejects; `continue` keeps the good rows and returns the others in `_corrupt_record`.
    """
    if on_error not in ("abort", "continue"):
        raise ValueError(f"on_error must be abort or continue, not {on_error!r}")
    fields = as_struct(schema).fields
    text = T.StructType([*[T.StructField(f.name, T.StringType()) for f in fields], T.StructField(CORRUPT, T.StringType())])
    parsed = F.from_csv("value", text.simpleString(), {**LOAD_DIALECT, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    rows = csv_records(spark, path).select(parsed.alias("r"), "value")
    # A quote that is still open at the end of a record takes in what was never meant for it.
    unclosed = F.when(opens(F.col("value")), F.col("value"))
    rows = rows.select(*[F.col(f"r.`{f.name}`") for f in fields], F.coalesce(f"r.{CORRUPT}", unclosed).alias(CORRUPT))
    given = {f.name: F.when(~F.col(f.name).isin(*NULL_TOKENS), F.col(f.name)) for f in fields}
    typed = [given[f.name].try_cast(f.dataType).alias(f.name) for f in fields]
    refused = F.lit(False)
    for f in fields:
        refused = refused | (given[f.name].isNotNull() & given[f.name].try_cast(f.dataType).isNull())
    bad = F.col(CORRUPT).isNotNull() | refused
    line = F.coalesce(CORRUPT, F.concat_ws(",", *[F.col(f.name) for f in fields]))
    if on_error == "abort":
        return rows.where(_or_raise(bad, line)).select(*typed), None
    return rows.where(~bad).select(*typed), rows.where(bad).select(line.alias(CORRUPT))


def _or_raise(bad: Column, line: Column) -> Column:
    """A filter that ends the job at the first bad row; it needs all fields, so none is pruned."""
    return F.when(bad, F.raise_error(F.concat(F.lit("malformed record: "), line)).cast("boolean")).otherwise(True)


def read_json_array(spark: SparkSession, path: str | list[str], schema: T.StructType | str) -> DataFrame:
    """Files that each hold one outer array of records."""
    return spark.read.schema(schema).option("multiLine", True).option("mode", "FAILFAST").json(path)


def _json_lines(
    spark: SparkSession, path: str | list[str], schema: T.StructType | str, options: dict[str, str],
) -> tuple[DataFrame, Column]:
    """Lines with their record `r`, and whether one is no object, or a value does not fit its type."""
    marked = T.StructType([*as_struct(schema).fields, T.StructField(CORRUPT, T.StringType())])
    lines = spark.read.options(**options).text(path).where(F.trim("value") != "")
    lines = lines.select("value", F.from_json("value", marked, {"columnNameOfCorruptRecord": CORRUPT, "mode": "PERMISSIVE"}).alias("r"))
    return lines, ~F.col("value").rlike(r"^\s*\{") | F.col("r").isNull() | F.col(f"r.{CORRUPT}").isNotNull()


def read_json_load(
    spark: SparkSession, path: str | list[str], schema: T.StructType | str, on_error: str = "abort", strict: bool = False,
    **options: str,
) -> tuple[DataFrame, DataFrame | None]:
    """JSON lines: (records, rejects), every field being parsed whatever is selected.

    A line is malformed if it is broken, no object, or has a value of another type, and with
    `strict` also if it repeats a key: the plain reader would keep the last of the two
    values, the variant parser refuses.  `abort` fails the job at the first such line.
    """
    if on_error not in ("abort", "continue"):
        raise ValueError(f"on_error must be abort or continue, not {on_error!r}")
    lines, bad = _json_lines(spark, path, schema, options)
    if strict:
        bad = bad | F.try_parse_json("value").isNull()
    names = [F.col(f"r.`{f.name}`") for f in as_struct(schema)]
    if on_error == "abort":
        return lines.where(_or_raise(bad, F.col("value"))).select(*names), None
    return lines.where(~bad).select(*names), lines.where(bad).select("value")


def read_json_lines(
    spark: SparkSession, path: str | list[str], schema: T.StructType | str, on_error: str = "abort", **options: str,
) -> DataFrame:
    """The records of `read_json_load`, for callers that have no use for the rejects."""
    return read_json_load(spark, path, schema, on_error, **options)[0]


def read_json_strict(
    spark: SparkSession, path: str | list[str], schema: T.StructType | str
) -> tuple[DataFrame, DataFrame]:
    """JSON lines: (records, rejects); lines with a repeated key are rejected like broken ones."""
    return read_json_load(spark, path, schema, "continue", strict=True)
