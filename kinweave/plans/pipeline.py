"""Register, process, load."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from kinweave.operators.mapping import rename_results, sink_struct, to_sink
from kinweave.plans.load import LoadResult, load
from kinweave.plans.resolve import Model, Provider, ResolveResult, resolve
from kinweave.plans.rules import Rule
from kinweave.schema import Attribute, source_struct
from kinweave.sinks.merge import KeyedTable
from kinweave.sources.batches import read_latest
from kinweave.sources.tables import register_table


@dataclass(frozen=True)
class PipelineResult:
    resolved: ResolveResult | None
    loaded: LoadResult


def run_pipeline(
    spark: SparkSession, input_path: str, attributes: Sequence[Attribute], target: KeyedTable,
    rules: Sequence[Rule] | None, as_of: datetime | str, fmt: str = "parquet",
    table: str = "kinweave_input", id_col: str = "id", output: str | None = None,
    run: str | None = None, newest_batch: str | None = None, dry_run: bool = False,
    source: DataFrame | None = None, source_fields: Mapping[str, str] | None = None, technique: str | None = None,
    model: Model | None = None, provider: Provider | None = None, threshold: float | None = None, on_error: str = "abort",
) -> PipelineResult:
    """Register `input_path` as a table, match its records, merge the result by id.

    With `newest_batch`, a part of file names, only the greatest directory of `input_path`
    that has such files is the input; without any, nothing is done.
    `source` takes the place of the files; `source_fields` names the source columns that are called otherwise than
    their attributes, in files too; it, `technique`, `model`, `provider` and
    `threshold` go to `resolve`, and rows it rejects count as failed in the load, of which
    `on_error` says what a failed write does.
    With `output` the match records are written as a run there and the load reads the
    latest run back, as separate jobs would.
    """
    names = source_fields or {}
    files = T.StructType([T.StructField(names.get(f.name, f.name), f.dataType) for f in source_struct(attributes)])
    if source is not None:
        pass
    elif newest_batch is None:
        source = register_table(spark, table, input_path, files, fmt)
    else:
        source = read_latest(spark, input_path, fmt, files, newest_batch)
        if source is None:
            return PipelineResult(None, load(None, target))
    resolved = resolve(
        source, attributes, id_col, rules, technique, model, provider, threshold=threshold, dry_run=dry_run, output=output,
        fmt="parquet", run=run, source_fields=source_fields,
    )
    if dry_run:
        return PipelineResult(resolved, load(None, target, dry_run=True))
    records = resolved.records
    if output:
        records = read_latest(spark, f"{output.rstrip('/')}/output", "parquet", records.schema, ".parquet")
    rows = to_sink(rename_results(records), attributes, as_of)
    if target.read() is None:
        target.write(spark.createDataFrame([], sink_struct(attributes)))
    return PipelineResult(resolved, load(rows, target, "merge", as_of, on_error, resolved.rejected))
