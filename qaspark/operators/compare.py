"""Comparing two evaluation runs.

Summaries have one row per metric; the joins below carry no broadcast
hint: AQE measures the summary at run time and switches to a broadcast
hash join when it is below the broadcast threshold."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Verdict bounds on the rounded change of the verdict
# metric, and the verdict labels.
SIGNIFICANT, MODERATE = 0.15, 0.05
VERDICTS = ("SIGNIFICANT IMPROVEMENT", "MODERATE IMPROVEMENT", "MARGINAL / FLAT")
VERDICT_METRIC = "Correctness"


def paired_answers(base: DataFrame, post: DataFrame, idx: str = "idx") -> DataFrame:
    """Baseline and second-run answers side by side, by case key."""
    b = base.select(idx, "question", "expected_answer", F.col("generated_answer").alias("baseline_answer"),
                    F.coalesce(F.col("context"), F.lit("")).alias("context"))
    p = post.select(idx, F.col("generated_answer").alias("finetuned_answer"))
    return b.join(p, idx, "inner")


def metric_join(post: DataFrame, base: DataFrame) -> DataFrame:
    """Every second-run metric with its baseline; a missing baseline counts
    as 0 and metrics only in the baseline vanish (J4)."""
    b = base.select("metric", F.col("avg_score").alias("base_avg"), F.col("pass_rate").alias("base_pass"),
                    F.lit(True).alias("_has_base"))
    p = post.select("metric", F.col("avg_score").alias("post_avg"), F.col("pass_rate").alias("post_pass"))
    j = p.join(b, "metric", "left")
    return j.select(
        "metric",
        F.coalesce("base_avg", F.lit(0.0)).alias("baseline_avg"),
        F.coalesce("base_pass", F.lit(0.0)).alias("baseline_pass"),
        F.col("post_avg").alias("finetuned_avg"),
        F.col("post_pass").alias("finetuned_pass"),
        F.coalesce("_has_base", F.lit(False)).alias("has_baseline"),
    )


def dropped_metrics(post: DataFrame, base: DataFrame) -> DataFrame:
    """Baseline metrics that the comparison leaves out."""
    return base.join(post.select("metric"), "metric", "left_anti")


def relative_change(delta: Column, base: Column) -> Column:
    """Percent change; 0 when the base is not positive."""
    return F.when(base > 0, delta / base * F.lit(100.0)).otherwise(F.lit(0.0))


def metric_delta(joined: DataFrame) -> DataFrame:
    d = F.col("finetuned_avg") - F.col("baseline_avg")
    return joined.withColumn("delta", d).withColumn("relative_change", relative_change(d, F.col("baseline_avg")))


def verdict(rounded_delta: Column) -> Column:
    """Verdict from the rounded change (F14); null (missing metric) is 0."""
    d = F.coalesce(rounded_delta, F.lit(0.0))
    return F.when(d >= SIGNIFICANT, F.lit(VERDICTS[0])).when(d >= MODERATE, F.lit(VERDICTS[1])).otherwise(
        F.lit(VERDICTS[2]))


def regressed(rounded_delta: Column) -> Column:
    return F.coalesce(rounded_delta, F.lit(0.0)) < 0


def delta_report(joined: DataFrame) -> DataFrame:
    """Nested delta report rows (S8): baseline, fine_tuned and delta structs,
    rounded as in the report (4 and 2 digits)."""
    d = F.col("finetuned_avg") - F.col("baseline_avg")
    rel = relative_change(d, F.col("baseline_avg"))
    dp = F.col("finetuned_pass") - F.col("baseline_pass")
    return joined.select(
        "metric",
        F.struct(F.col("baseline_avg").alias("avg_score"), F.col("baseline_pass").alias("pass_rate")).alias("baseline"),
        F.struct(F.col("finetuned_avg").alias("avg_score"), F.col("finetuned_pass").alias("pass_rate")).alias("fine_tuned"),
        F.struct(F.round(d, 4).alias("avg_score_change"), F.round(rel, 2).alias("relative_change_percent"),
                 F.round(dp, 4).alias("pass_rate_change")).alias("delta"),
    )


def compare_runs(post: DataFrame, base: DataFrame, post_specs: DataFrame | None = None,
                 base_specs: DataFrame | None = None, verdict_metric: str = VERDICT_METRIC) -> DataFrame:
    """Full comparison (X6): per metric baseline / second-run mean and pass
    rate, change, relative change, pass-rate change, whether both runs used
    the same metric definition, and the run verdict (from the verdict
    metric, on the change rounded to 4 digits) on every row."""
    j = metric_delta(metric_join(post, base))
    j = j.withColumn("pass_rate_change", F.col("finetuned_pass") - F.col("baseline_pass"))
    if post_specs is not None and base_specs is not None:
        ps = post_specs.select("metric", F.col("spec_hash").alias("_ph"))
        bs = base_specs.select("metric", F.col("spec_hash").alias("_bh"))
        j = j.join(ps, "metric", "left").join(bs, "metric", "left").withColumn(
            "spec_match", F.coalesce(F.col("_ph") == F.col("_bh"), F.lit(False))).drop("_ph", "_bh")
    # the table has one row per metric, so a window over all of it is small
    vd = F.max(F.when(F.col("metric") == verdict_metric, F.round("delta", 4))).over(Window.partitionBy())
    out = j.withColumn("_vd", vd)
    return out.withColumn("verdict", verdict(F.col("_vd"))).withColumn("regressed", regressed(F.col("_vd"))).drop("_vd")


def report_lines(report: DataFrame) -> DataFrame:
    """Fixed-width text lines as printed by the reference report."""
    d = F.col("delta")
    rel = F.col("relative_change")
    line = F.format_string(
        "%-30s %10.3f %12.3f %s%9.3f %s%8.1f%%",
        F.col("metric"), F.col("baseline_avg"), F.col("finetuned_avg"),
        F.when(d >= 0, F.lit("+")).otherwise(F.lit("")), d,
        F.when(rel >= 0, F.lit("+")).otherwise(F.lit("")), rel,
    )
    pass_line = F.format_string(
        "%-30s %9.1f%% %11.1f%% %s%8.1f%%",
        F.col("metric"), F.col("baseline_pass") * 100, F.col("finetuned_pass") * 100,
        F.when(F.col("pass_rate_change") >= 0, F.lit("+")).otherwise(F.lit("")), F.col("pass_rate_change") * 100,
    )
    return report.select("metric", line.alias("score_line"), pass_line.alias("pass_line"))
