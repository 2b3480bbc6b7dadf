"""Match quality, metric rollups and threshold alarms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _pairs_of(n: Column) -> Column:
    """Pairs in a group of n, as a double: n may be large and n * n larger."""
    return n.cast("double") * (n - 1).cast("double") / 2


def match_quality(labelled: DataFrame, predicted: str, truth: str) -> DataFrame:
    """Precision, recall and F1 over record pairs, from group labels of each record.

    Pairs are counted from group sizes, not listed: pairs in both groupings are the pairs
    within each (predicted, true) cell.
    """
    cells = labelled.groupBy(predicted, truth).agg(F.count(F.lit(1)).alias("n"))
    in_both = cells.agg(F.coalesce(F.sum(_pairs_of(F.col("n"))), F.lit(0.0)).alias("true_pairs"))
    in_predicted = cells.groupBy(predicted).agg(F.sum("n").alias("n")).agg(
        F.coalesce(F.sum(_pairs_of(F.col("n"))), F.lit(0.0)).alias("predicted_pairs"))
    in_truth = cells.groupBy(truth).agg(F.sum("n").alias("n")).agg(
        F.coalesce(F.sum(_pairs_of(F.col("n"))), F.lit(0.0)).alias("actual_pairs"))
    one = F.lit(1).alias("one")
    counts = (
        in_both.select("*", one).join(in_predicted.select("*", one), "one")
        .join(in_truth.select("*", one), "one").drop("one")
    )
    tp, pp, ap = F.col("true_pairs"), F.col("predicted_pairs"), F.col("actual_pairs")
    return counts.select(
        tp, pp, ap,
        F.round(F.when(pp > 0, tp / pp), 6).alias("precision"),
        F.round(F.when(ap > 0, tp / ap), 6).alias("recall"),
        F.round(F.when(pp + ap > 0, 2 * tp / (pp + ap)), 6).alias("f1"),
    )


def pair_quality(predicted: DataFrame, truth: DataFrame) -> DataFrame:
    """Precision, recall and F1 of listed pairs (id_a, id_b) against labelled pairs."""
    p = predicted.select("id_a", "id_b").distinct().withColumn("p", F.lit(1))
    t = truth.select("id_a", "id_b").distinct().withColumn("t", F.lit(1))
    counts = p.join(t, ["id_a", "id_b"], "full").agg(
        F.count_if(F.col("p").isNotNull() & F.col("t").isNotNull()).alias("true_pairs"),
        F.count("p").alias("predicted_pairs"), F.count("t").alias("actual_pairs"),
    )
    tp, pp, ap = F.col("true_pairs"), F.col("predicted_pairs"), F.col("actual_pairs")
    return counts.select(
        tp, pp, ap,
        F.round(F.when(pp > 0, tp / pp), 6).alias("precision"),
        F.round(F.when(ap > 0, tp / ap), 6).alias("recall"),
        F.round(F.when(pp + ap > 0, 2 * tp / (pp + ap)), 6).alias("f1"),
    )


def metric_rollup(
    events: DataFrame, ts: str = "ts", name: str = "name", value: str = "value", period: int = 300
) -> DataFrame:
    """Sum, average and count of each metric per tumbling period of `period` seconds."""
    window = F.window(F.col(ts), f"{period} seconds")
    return events.groupBy(window, F.col(name).alias("name")).agg(
        F.sum(value).alias("total"), F.avg(value).alias("average"), F.count(value).alias("samples")
    ).select(
        F.col("window.start").alias("period_start"), "name", "total", "average", "samples"
    )


def duration_limit_ms(timeout_seconds: int) -> int:
    """Limit of the duration alarm: three quarters of the timeout, in milliseconds."""
    return int(timeout_seconds * 3 // 4) * 1000


def alarms(
    events: DataFrame, ts: str, statistic: Column, threshold: float, inclusive: bool = True,
    period: int = 60,
) -> DataFrame:
    """(period_start, observed): periods whose aggregate reaches the threshold (exceeds it
    when not `inclusive`).  A period without events gives no row, so no alarm."""
    window = F.window(F.col(ts), f"{period} seconds")
    observed = events.groupBy(window).agg(statistic.alias("observed")).select(
        F.col("window.start").alias("period_start"), "observed"
    )
    limit = F.lit(threshold)
    return observed.where(F.col("observed") >= limit if inclusive else F.col("observed") > limit)


def error_alarm(events: DataFrame, ts: str, is_error: Column, period: int = 60) -> DataFrame:
    """At least one error in the period; also the alarm on failed runs."""
    return alarms(events, ts, F.sum(is_error.cast("long")), 1, True, period)


def duration_alarm(events: DataFrame, ts: str, duration: Column, limit: float, period: int = 60) -> DataFrame:
    """The longest duration in the period exceeds the limit."""
    return alarms(events, ts, F.max(duration), limit, False, period)
