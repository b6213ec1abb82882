"""Summaries of score rows.

Score rows are a long table ``idx, metric, score, error``; every summary is
a hash aggregate with partial aggregation, so a metric holding most of the
rows still combines map-side."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from qaspark.operators.order import reindex

# The pass threshold of both evaluation runs.
PASS_THRESHOLD = 0.7


def passed(score_col: str = "score", threshold: float = PASS_THRESHOLD):
    return F.col(score_col) >= F.lit(float(threshold))


def metric_summary(scores: DataFrame, by=("metric",), threshold: float = PASS_THRESHOLD) -> DataFrame:
    """Mean score, pass rate and number of scores per metric (A2-A4); a
    metric without any score is omitted. Double literals keep the pass
    rate in floating point (N4)."""
    s = F.col("score")
    out = scores.where(s.isNotNull()).groupBy(*by).agg(
        F.avg(s).alias("avg_score"),
        F.avg(F.when(passed("score", threshold), F.lit(1.0)).otherwise(F.lit(0.0))).alias("pass_rate"),
        F.count(s).alias("n"),
    )
    return out.where(F.col("n") > 0)


def failed_cases(scores: DataFrame, by=()) -> DataFrame:
    """Cases where some metric failed and none produced a score (A5)."""
    per_case = scores.groupBy(*by, "idx").agg(
        F.bool_or(F.col("error").isNotNull()).alias("any_error"),
        F.count("score").alias("n_scored"),
    )
    failed = (F.col("any_error") & (F.col("n_scored") == 0)).cast("int")
    return per_case.groupBy(*by).agg(
        F.coalesce(F.sum(failed), F.lit(0)).cast("long").alias("n_failed"),
        F.count(F.lit(1)).alias("n_cases"),
    )


def case_score_map(scores: DataFrame) -> DataFrame:
    """Per case ``map<metric, score>`` of the stored scores (A7). One group
    per case holds one entry per metric, so it is bounded by the metric list."""
    entries = F.array_sort(F.collect_list(F.struct("metric", "score")))
    return scores.where(F.col("score").isNotNull()).groupBy("idx").agg(F.map_from_entries(entries).alias("scores"))


def run_counts(cases: DataFrame, n_metrics: int, scores: DataFrame | None = None) -> DataFrame:
    """Cases, metric calls, stored scores and failed calls (A8), in one
    aggregate over the union of both inputs."""
    rows = cases.select(F.lit(True).alias("_case"), F.lit(None).cast("double").alias("score"),
                        F.lit(None).cast("string").alias("error"))
    if scores is not None:
        rows = rows.unionByName(scores.select(F.lit(False).alias("_case"), "score", "error"))
    out = rows.agg(
        F.count_if(F.col("_case")).cast("long").alias("n_samples"),
        F.count("score").alias("n_scores"),
        F.count("error").alias("n_errors"),
    )
    return out.withColumn("total_calls", F.col("n_samples") * F.lit(n_metrics))


def scores_long(entries: DataFrame, scores: str = "scores") -> DataFrame:
    """``map`` column to rows ``idx, metric, score``."""
    return entries.select("idx", F.explode(scores).alias("metric", "score"))


def scores_wide(scores: DataFrame, metrics) -> DataFrame:
    """One column per metric (F23); the metric list is given so the pivot
    needs no extra job to find its values."""
    return scores.groupBy("idx").pivot("metric", list(metrics)).agg(F.first("score"))


def passing_cases(scores: DataFrame, threshold: float = PASS_THRESHOLD) -> DataFrame:
    """Score rows at or above the threshold."""
    return scores.where(passed("score", threshold))


def ordered_cases(cases: DataFrame, idx: str = "idx") -> DataFrame:
    """Cases with their position in ``idx`` order (L3), computed by range,
    not in one partition."""
    return reindex(cases, [idx], "pos")


def preview(df: DataFrame, order: str, cols, n_chars: int = 150) -> DataFrame:
    """First row in ``order`` with text prefixes."""
    first = df.orderBy(order).limit(1)
    return first.select(order, *[F.substring(c, 1, n_chars).alias(f"{c}_{n_chars}") for c in cols])


def run_summary(scores: DataFrame, cases: DataFrame, meta: dict, threshold: float = PASS_THRESHOLD,
                by: str = "run") -> DataFrame:
    """One nested summary row per run (S7): metadata, sample and failure
    counts, and ``metrics: map<metric, struct<avg_score, pass_rate, n>>``.
    The per-case list stays a table (``case_score_map``)."""
    per_metric = metric_summary(scores, (by, "metric"), threshold)
    metrics = per_metric.groupBy(by).agg(
        F.map_from_entries(F.collect_list(F.struct("metric", F.struct(
            F.round("avg_score", 4).alias("avg_score"), F.round("pass_rate", 4).alias("pass_rate"), "n"))))
        .alias("metrics")
    )
    failed = failed_cases(scores, (by,)).select(by, "n_failed")
    n = cases.groupBy(by).agg(F.count(F.lit(1)).alias("n_samples"))
    out = n.join(failed, by, "left").join(metrics, by, "left")
    for k, v in meta.items():
        out = out.withColumn(k, F.lit(v))
    return out.withColumn("threshold", F.lit(float(threshold))).withColumn(
        "n_failed", F.coalesce(F.col("n_failed"), F.lit(0)).cast("long"))
