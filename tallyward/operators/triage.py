"""Isolation-Forest triage score beside the rule score.

Features, scaling and verdict are projections over the scorecard; the forest is a
table of nodes, see ``operators.forest``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyward.functions import keys as K
from tallyward.functions.bands import risk_band
from tallyward.operators.forest import fit_forest, forest_scores
from tallyward.operators.quantiles import SMALL_ROWS, exact_quantile
from tallyward.sources.shared import cut

# Fixed value.
MODEL_NAME = "isolation_forest_source_day_v1"
SEED = 42
TREES = 100
SUBSAMPLE = 256
SMALL_BATCH = 4
OUTLIER_SCORE = 80

# Feature column, label written as the model driver, transform.
FEATURES = (
    ("anomaly_score", "rule anomaly score", "identity"),
    ("duplicate_ratio", "duplicate pressure", "identity"),
    ("negative_stake_ratio", "negative stake pressure", "identity"),
    ("issue_ratio", "quality issue density", "identity"),
    ("payout_ratio", "payout ratio pressure", "identity"),
    ("total_bet_rows", "bet volume", "log1p"),
    ("total_issue_rows", "issue volume", "log1p"),
    ("alert_count", "alert volume", "log1p"),
    ("critical_alert_count", "critical alert volume", "log1p"),
    ("net_revenue_amount", "net revenue movement", "signed_log1p"),
)
FEATURE_COLUMNS = [f"f_{name}" for name, _, _ in FEATURES]
#: What tells the rows of a scorecard apart.
FOREST_KEY = ["source_file", "report_date"]

# The columns read and written.
ML_INPUT_COLUMNS = [
    "anomaly_id",
    "source_file",
    "report_date",
    "anomaly_score",
    "risk_band",
    "primary_driver",
    "recommended_action",
    "total_bet_rows",
    "total_issue_rows",
    "duplicate_ratio",
    "negative_stake_ratio",
    "issue_ratio",
    "payout_ratio",
    "alert_count",
    "critical_alert_count",
    "net_revenue_amount",
]
ML_COLUMNS = [
    "ml_score_id",
    "model_name",
    "source_file",
    "report_date",
    "rule_anomaly_score",
    "rule_risk_band",
    "ml_anomaly_score",
    "ml_risk_band",
    "model_outlier_flag",
    "model_driver",
    "primary_driver",
    "recommended_action",
    "total_bet_rows",
    "total_issue_rows",
    "alert_count",
    "duplicate_ratio",
    "negative_stake_ratio",
    "issue_ratio",
    "payout_ratio",
    "net_revenue_amount",
]


def ml_feature_rows(scorecard: DataFrame) -> DataFrame:
    return scorecard.select(*ML_INPUT_COLUMNS).orderBy(F.asc_nulls_last("report_date"), "source_file")


def _number(column: str) -> Column:
    return F.coalesce(F.col(column).cast("double"), F.lit(0.0))


def _transformed(value: Column, transform: str) -> Column:
    if transform == "log1p":
        return F.log1p(F.greatest(value, F.lit(0.0)))
    if transform == "signed_log1p":
        size = F.log1p(F.abs(value))
        return F.when(value < 0, -size).otherwise(size)
    return value


def with_features(rows: DataFrame) -> DataFrame:
    """Ten double features; NULL counts as zero."""
    return rows.withColumns(
        {out: _transformed(_number(name), how) for out, (name, _, how) in zip(FEATURE_COLUMNS, FEATURES)}
    )


def standard_scaler(features: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Zero mean and unit population variance; a constant column becomes zeros."""
    columns = columns or FEATURE_COLUMNS
    stats = features.agg(
        F.struct(
            *[F.avg(c).alias(f"mean_{c}") for c in columns],
            *[F.stddev_pop(c).alias(f"std_{c}") for c in columns],
        ).alias("stats")
    )
    scaled = features.withColumn("_stats", stats.scalar())
    return scaled.withColumns(
        {
            c: (F.col(c) - F.col(f"_stats.mean_{c}"))
            / F.when(F.col(f"_stats.std_{c}") > 0, F.col(f"_stats.std_{c}")).otherwise(1.0)
            for c in columns
        }
    ).drop("_stats")


def normalize_scores(df: DataFrame, raw: str, fallback: str, out: str) -> DataFrame:
    """Min-max to 0..100; when all raw scores are close, the fallback clamped to 0..100."""
    span = df.agg(F.struct(F.min(raw).alias("low"), F.max(raw).alias("high"))).scalar()
    low, high = F.col("_span.low"), F.col("_span.high")
    close = F.abs(high - low) <= 1e-9 * F.greatest(F.abs(high), F.abs(low))
    clamped = F.greatest(F.lit(0.0), F.least(F.lit(100.0), F.col(fallback).cast("double")))
    scaled = (F.col(raw) - low) / F.nullif(high - low, F.lit(0.0)) * 100
    return (
        df.withColumn("_span", span)
        .withColumn(out, F.round(F.when(close, clamped).otherwise(scaled), 4))
        .drop("_span")
    )


def _medians(df: DataFrame, columns: list[str], rows: int | None) -> Column:
    """Exact medians as one struct; of a number of rows known to be small, in one aggregation."""
    if rows is not None and rows <= SMALL_ROWS:
        return df.agg(F.struct(*[F.percentile(c, 0.5).alias(c) for c in columns])).scalar()
    return exact_quantile(df, columns, 0.5).select(F.struct(*columns)).scalar()


def robust_drivers(features: DataFrame, columns: list[str] | None = None, rows: int | None = None) -> DataFrame:
    """Add ``model_driver``: the feature farthest from its median in units of its MAD. ``rows``: how many there are, where known."""
    columns = columns or FEATURE_COLUMNS
    medians = _medians(features, columns, rows)
    centred = features.withColumn("_median", medians)
    deviations = [F.abs(F.col(c) - F.col(f"_median.{c}")).alias(c) for c in columns]
    mads = _medians(centred.select(*deviations), columns, rows)
    labels = F.array(*[F.lit(label) for _, label, _ in FEATURES])
    scores = F.array(
        *[
            F.abs(F.col(c) - F.col(f"_median.{c}"))
            / F.when(F.col(f"_mad.{c}") != 0, F.col(f"_mad.{c}")).otherwise(1.0)
            for c in columns
        ]
    )
    return (
        centred.withColumn("_mad", mads)
        .withColumn("_scores", scores)
        .withColumn(
            "model_driver",
            F.element_at(labels, F.array_position("_scores", F.array_max("_scores")).cast("int")),
        )
        .drop("_median", "_mad", "_scores")
    )


def ml_recommended_action() -> Column:
    """Fixed texts by outlier flag, rule band and model band."""
    outlier = F.col("model_outlier_flag")
    return (
        F.when(
            outlier & F.col("rule_risk_band").isin("critical", "high"),
            "Investigate immediately; ML agrees with rule-based anomaly pressure",
        )
        .when(outlier, "Review model-only anomaly against raw transactions")
        .when(F.col("ml_risk_band").isin("medium", "high"), "Monitor during daily reconciliation")
        .otherwise("No ML action required")
    )


def contamination(rows: int) -> float:
    return min(0.2, max(1 / rows, 0.05))


def small_batch_scores(features: DataFrame) -> DataFrame:
    """Too few rows for a forest: min-max of the rule score, outlier from 80."""
    rule = features.withColumn("_rule", _number("anomaly_score"))
    scored = normalize_scores(rule, "_rule", "anomaly_score", "ml_anomaly_score").drop("_rule")
    return scored.withColumn("predicted_outlier", F.col("ml_anomaly_score") >= OUTLIER_SCORE)


def isolation_scores(
    features: DataFrame, rows: int, trees: int = TREES, subsample: int = SUBSAMPLE, seed: int = SEED
) -> DataFrame:
    """Isolation score per row relative to the outlier cut, normalised and flagged.

    The cut is the exact (1 - contamination) quantile of the scores; rows above
    it are predicted outliers.
    """
    nodes = cut(fit_forest(features, rows, FOREST_KEY, FEATURE_COLUMNS, trees, subsample, seed), "forest")
    scored = cut(forest_scores(features, nodes, rows, FEATURE_COLUMNS, trees, subsample), "isolation_scores")
    threshold = exact_quantile(scored, ["isolation"], 1 - contamination(rows)).scalar()
    relative = scored.withColumn("isolation", F.col("isolation") - threshold)
    normal = normalize_scores(relative, "isolation", "anomaly_score", "ml_anomaly_score")
    return normal.withColumn("predicted_outlier", F.col("isolation") > 0).drop("isolation")


def with_ml_verdict(scored: DataFrame) -> DataFrame:
    """Band, outlier flag and action from ``ml_anomaly_score`` and ``predicted_outlier``."""
    return (
        scored.withColumn("ml_risk_band", risk_band(F.col("ml_anomaly_score")))
        .withColumn(
            "model_outlier_flag",
            F.col("predicted_outlier") | (F.col("ml_anomaly_score") >= OUTLIER_SCORE),
        )
        .withColumn("rule_risk_band", F.col("risk_band"))
        .withColumn("recommended_action", ml_recommended_action())
    )


def in_triage_order(scores: DataFrame) -> DataFrame:
    return scores.orderBy(
        F.desc("ml_anomaly_score"),
        F.desc("rule_anomaly_score"),
        F.asc_nulls_last("report_date"),
        "source_file",
    )


def ml_scores(
    scorecard: DataFrame, trees: int = TREES, subsample: int = SUBSAMPLE, seed: int = SEED
) -> DataFrame:
    """Triage output, highest model score first."""
    features = with_features(cut(scorecard.select(*ML_INPUT_COLUMNS), "ml_input"))
    rows = features.count()
    if rows < SMALL_BATCH:
        scored = small_batch_scores(features)
    else:
        scored = isolation_scores(features, rows, trees, subsample, seed)
    verdict = with_ml_verdict(robust_drivers(scored, rows=rows))
    ratios = ("duplicate_ratio", "negative_stake_ratio", "issue_ratio", "payout_ratio")
    return (
        verdict.withColumns(
            {
                "ml_score_id": K.ml_score_id(MODEL_NAME),
                "model_name": F.lit(MODEL_NAME),
                "rule_anomaly_score": F.round(_number("anomaly_score"), 4),
                "net_revenue_amount": F.round(_number("net_revenue_amount"), 2),
                **{c: F.round(_number(c), 4) for c in ratios},
            }
        )
        .select(*ML_COLUMNS)
        .transform(in_triage_order)
    )


def ml_report_metrics(scores: DataFrame) -> DataFrame:
    """Rows scored, outliers and the highest model score."""
    return scores.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count_if("model_outlier_flag").alias("outlier_count"),
        F.coalesce(F.max("ml_anomaly_score"), F.lit(0.0)).alias("max_ml_anomaly_score"),
    )


def ml_figures(scores: DataFrame) -> DataFrame:
    """The figures with the first rows of the triage list as JSON, one row: what a model report shows."""
    top = ml_top(scores).select(F.struct(*ML_COLUMNS).alias("row"))
    listed = top.agg(F.to_json(F.collect_list("row")).alias("top_rows"))
    return ml_report_metrics(scores).withColumn("top_rows", listed.scalar())


def ml_top(scores: DataFrame, rows: int = 5) -> DataFrame:
    """The first rows of the triage list."""
    return in_triage_order(scores).limit(rows)
