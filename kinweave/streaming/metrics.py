"""Metric rollups and alarms over live events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from kinweave.operators.metrics import alarms, metric_rollup

LATENESS = "10 minutes"


def _watermarked(events: DataFrame, ts: str, lateness: str) -> DataFrame:
    """Event times without zone are taken as those of the session's zone."""
    return events.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, lateness)


def live_rollup(
    events: DataFrame, ts: str = "ts", name: str = "name", value: str = "value", period: int = 300,
    lateness: str = LATENESS,
) -> DataFrame:
    """The rollup of each period, given out once the watermark has passed its end."""
    return metric_rollup(_watermarked(events, ts, lateness), ts, name, value, period)


def live_alarms(
    events: DataFrame, ts: str, statistic: Column, threshold: float, inclusive: bool = True,
    period: int = 60, lateness: str = LATENESS,
) -> DataFrame:
    return alarms(_watermarked(events, ts, lateness), ts, statistic, threshold, inclusive, period)


def write_metrics(rollup: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append finished periods to parquet files, for all events that have arrived."""
    return (
        rollup.writeStream.outputMode("append").format("parquet").option("path", path)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
