"""End-of-day and dashboard figures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyward.functions.bands import gravity_order
from tallyward.operators.triage import ml_top


def _or_zero(value: Column, type_name: str | None = None) -> Column:
    zero = F.lit(0)
    return F.coalesce(value, zero.cast(type_name) if type_name else zero)


def eod_overview(scorecard: DataFrame, feed: DataFrame, issue_summary: DataFrame) -> DataFrame:
    """One row of totals. ``issue_summary`` is the daily issue summary, whose counts add up to all issues."""
    alerts = feed.agg(F.count(F.lit(1)))
    issues = issue_summary.agg(_or_zero(F.sum("issue_count")))
    return scorecard.agg(
        F.count(F.lit(1)).alias("source_day_count"),
        _or_zero(F.sum("total_bet_rows")).alias("total_bet_rows"),
        F.count_if(F.col("reconciliation_status") == "review").alias("review_source_day_count"),
        F.count_if(F.col("risk_band").isin("critical", "high")).alias("high_risk_source_day_count"),
        _or_zero(F.sum("total_stake_amount")).alias("total_stake_amount"),
        _or_zero(F.sum("total_payout_amount")).alias("total_payout_amount"),
        _or_zero(F.sum("net_revenue_amount")).alias("net_revenue_amount"),
        _or_zero(F.max("anomaly_score")).alias("max_anomaly_score"),
    ).withColumns(
        {"total_alert_count": alerts.scalar(), "total_quality_issue_count": issues.scalar()}
    )


def eod_risk_bands(scorecard: DataFrame) -> DataFrame:
    """Source-days and highest score per band, gravest band first."""
    return (
        scorecard.groupBy("risk_band")
        .agg(F.count(F.lit(1)).alias("source_day_count"), F.max("anomaly_score").alias("max_anomaly_score"))
        .orderBy(gravity_order(F.col("risk_band")))
    )


def eod_top_anomalies(scorecard: DataFrame, rows: int = 10) -> DataFrame:
    """Highest scores above zero, latest day first on ties."""
    return (
        scorecard.where(F.col("anomaly_score") > 0)
        .orderBy(F.desc("anomaly_score"), F.desc_nulls_first("report_date"), "source_file")
        .limit(rows)
        .select(
            "report_date",
            "source_file",
            "anomaly_score",
            "risk_band",
            "primary_driver",
            "recommended_action",
            "total_bet_rows",
            "total_issue_rows",
            "alert_count",
            "payout_ratio",
        )
    )


def eod_alert_summary(feed: DataFrame) -> DataFrame:
    """Alerts per severity and type, gravest first."""
    return (
        feed.groupBy("severity", "alert_type")
        .agg(F.count(F.lit(1)).alias("alert_count"))
        .orderBy(gravity_order(F.col("severity")), "alert_type")
    )


def eod_quality_issues(issues: DataFrame) -> DataFrame:
    """Issues per rule, most frequent first."""
    return (
        issues.groupBy("issue_type")
        .agg(F.count(F.lit(1)).alias("issue_count"))
        .orderBy(F.desc("issue_count"), "issue_type")
    )


def dash_kpis(
    reconciliation: DataFrame, scorecard: DataFrame, feed: DataFrame, ml_scores: DataFrame
) -> DataFrame:
    """One row of eleven headline figures; all zero on empty reports."""
    scores = scorecard.agg(
        F.struct(
            F.count_if(F.col("risk_band").isin("critical", "high")).alias("high_risk_source_day_count"),
            _or_zero(F.max("anomaly_score").cast("double")).alias("max_rule_score"),
        )
    )
    triage = ml_scores.agg(
        F.struct(
            F.count_if(F.col("model_outlier_flag").cast("boolean")).alias("ml_outlier_count"),
            _or_zero(F.max("ml_anomaly_score").cast("double")).alias("max_ml_score"),
        )
    )
    return (
        reconciliation.agg(
            F.count(F.lit(1)).alias("source_day_count"),
            _or_zero(F.sum("total_bet_rows")).alias("total_bet_rows"),
            F.count_if(F.col("reconciliation_status") == "review").alias("review_source_day_count"),
            *[
                _or_zero(F.sum(c)).alias(c)
                for c in ("total_stake_amount", "total_payout_amount", "net_revenue_amount")
            ],
        )
        .withColumns(
            {
                "_scores": scores.scalar(),
                "_triage": triage.scalar(),
                "alert_count": feed.agg(F.count(F.lit(1))).scalar(),
            }
        )
        .select("*", "_scores.*", "_triage.*")
        .drop("_scores", "_triage")
    )


def dash_top_anomalies(scorecard: DataFrame, rows: int = 5) -> DataFrame:
    """Highest rule scores; ties keep the order of the exported scorecard."""
    return scorecard.orderBy(
        F.desc("anomaly_score"), F.asc_nulls_last("report_date"), "source_file"
    ).limit(rows)


def dash_top_ml(scores: DataFrame, rows: int = 5) -> DataFrame:
    """Highest model scores; ties keep the order of the exported triage list."""
    return ml_top(scores, rows)


def dash_alert_mix(feed: DataFrame, rows: int = 8) -> DataFrame:
    return eod_alert_summary(feed).limit(rows)


def dash_issue_mix(issue_summary: DataFrame, rows: int = 8) -> DataFrame:
    """Issue counts added over all days, most frequent rule first."""
    return (
        issue_summary.groupBy("issue_type")
        .agg(F.sum("issue_count").alias("issue_count"))
        .orderBy(F.desc("issue_count"), "issue_type")
        .limit(rows)
    )
