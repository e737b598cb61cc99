"""Anomaly scores on daily metrics: trailing-window z-score per repo and metric.

The daily table has no row for idle days. Each active day is followed by the idle days up to the next one (``lead`` within the repository,
then one ``explode``): no join, no second pass for the span, and one shuffle by repository for the whole computation, as the statistics of
all metrics are windows over the same partition and order. Rows per repo are bounded by the time span, not by activity. Only the end
turns the metrics into rows.

Score of day *d*: ``(x_d - mean) / stddev_samp`` over the previous ``window``
days (``rowsBetween(-window, -1)``: today is not part of its own baseline).
No score while fewer than ``min_history`` previous days exist or the baseline
is flat. A partition holds one repo's days, however busy the repo is.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SCORED_METRICS = ("commits", "prs_opened", "issues_opened")


def fill_idle_days(daily: DataFrame, metrics: Sequence[str], key: str = "repo_full_name") -> DataFrame:
    """One row per day from a key's first to its last active day, zeros on idle ones."""
    following = F.lead("day").over(Window.partitionBy(key).orderBy("day"))
    until = F.greatest(F.coalesce(F.date_sub(following, 1), F.col("day")), F.col("day"))
    spans = daily.where("day IS NOT NULL").select(key, F.col("day").alias("_active"), *metrics, F.sequence(
        F.col("day"), until, F.expr("INTERVAL 1 DAY")).alias("_days"))
    each = spans.select(key, "_active", *metrics, F.explode("_days").alias("day"))
    active = F.col("day") == F.col("_active")
    return each.select(key, "day", *[F.when(active, F.col(m)).otherwise(0).cast("bigint").alias(m) for m in metrics])


def anomaly_scores(daily: DataFrame, metrics: Sequence[str] = SCORED_METRICS, window: int = 28,
                   min_history: int = 7, threshold: float = 3.0, key: str = "repo_full_name") -> DataFrame:
    filled = fill_idle_days(daily, metrics, key)
    w = Window.partitionBy(key).orderBy("day").rowsBetween(-window, -1)
    measured = [F.struct(F.lit(m).alias("metric"), F.col(m).alias("value"), F.avg(m).over(w).alias("_mean"), F.stddev_samp(m).over(w).alias("_std")).alias(f"_{m}")
                for m in metrics]
    wide = filled.select(key, "day", F.count(F.lit(1)).over(w).alias("history_days"), *measured)
    stats = wide.select(key, "day", "history_days", F.inline(F.array(*[f"_{m}" for m in metrics])))
    usable = (F.col("history_days") >= min_history) & (F.col("_std") > 0)
    z = F.when(usable, (F.col("value") - F.col("_mean")) / F.col("_std"))
    return stats.select(
        key, "day", "metric", "value", F.col("history_days").cast("bigint").alias("history_days"),
        F.col("_mean").alias("baseline_mean"),
        F.col("_std").alias("baseline_std"),
        z.alias("z_score"),
        F.coalesce(F.abs(z) >= F.lit(threshold), F.lit(False)).alias("is_anomaly"),
    )
