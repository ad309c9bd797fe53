"""Source-day anomaly score, 0 to 100, from five capped components."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyward.functions import keys as K
from tallyward.functions.bands import band_action, risk_band
from tallyward.operators.alerts import SOURCE_RULES, AlertRule
from tallyward.operators.reconcile import ratio

# Component column, cap, and the driver name when it is the largest;
# ties go to the first in this order.
COMPONENTS = (
    ("duplicate_component_score", 30, "duplicate_pressure"),
    ("negative_stake_component_score", 25, "negative_stake_pressure"),
    ("payout_loss_component_score", 20, "payout_loss_pressure"),
    ("issue_density_component_score", 15, "issue_density"),
    ("alert_severity_component_score", 10, "alert_severity"),
)
SEVERITY_POINTS = (("critical", 10), ("high", 6), ("medium", 3))
SCORE = "decimal(6,2)"

SCORECARD_COLUMNS = [
    "anomaly_id",
    "source_file",
    "report_date",
    "anomaly_score",
    "risk_band",
    "primary_driver",
    "recommended_action",
    "total_bet_rows",
    "distinct_bet_key_count",
    "duplicate_extra_row_count",
    "total_issue_rows",
    "negative_stake_issue_rows",
    "missing_event_timestamp_issue_rows",
    "cancelled_with_payout_issue_rows",
    "payout_without_stake_issue_rows",
    "alert_count",
    "critical_alert_count",
    "high_alert_count",
    "medium_alert_count",
    "duplicate_ratio",
    "negative_stake_ratio",
    "issue_ratio",
    "total_stake_amount",
    "total_payout_amount",
    "net_revenue_amount",
    "payout_ratio",
    "duplicate_component_score",
    "negative_stake_component_score",
    "payout_loss_component_score",
    "issue_density_component_score",
    "alert_severity_component_score",
    "reconciliation_status",
]


def _alert_counts(severities: Column) -> dict[str, Column]:
    def with_severity(name: str) -> Column:
        return F.size(F.filter(severities, lambda s: s == name)).cast("long")

    counts = {f"{name}_alert_count": with_severity(name) for name, _ in SEVERITY_POINTS}
    return {"alert_count": F.size(severities).cast("long"), **counts}


def alert_counts_by_source_day(feed: DataFrame) -> DataFrame:
    """Source-scope alerts per source-day, in total and per severity."""
    return (
        feed.where(F.col("alert_scope") == "source_day")
        .groupBy("source_file", "report_date")
        .agg(
            F.count(F.lit(1)).alias("alert_count"),
            *[
                F.count_if(F.col("severity") == name).alias(f"{name}_alert_count")
                for name, _ in SEVERITY_POINTS
            ],
        )
    )


def score_base_metrics(
    reconciliation: DataFrame, rules: tuple[AlertRule, ...] = SOURCE_RULES
) -> DataFrame:
    """Reconciliation rows with their alert counts and three ratios.

    A source-day's alerts depend on its own row only, so they are counted in
    place instead of joining the alert feed back. Days without a date have none.
    """
    metrics = ["duplicate_ratio", "negative_stake_ratio"]
    rows = reconciliation.withColumns(
        {
            "duplicate_ratio": ratio(F.col("duplicate_extra_row_count"), F.col("total_bet_rows")),
            "negative_stake_ratio": ratio(F.col("negative_stake_issue_rows"), F.col("total_bet_rows")),
            "issue_ratio": ratio(F.col("total_issue_rows"), F.col("total_bet_rows")),
        }
    )
    raised = F.array_compact(F.array(*[F.when(rule.fires(), rule.severity()) for rule in rules]))
    dated = F.col("source_file").isNotNull() & F.col("report_date").isNotNull()
    rows = rows.withColumn("_raised", F.when(dated, raised).otherwise(F.array().cast("array<string>")))
    zero = F.lit(0).cast("decimal(18,4)")
    return rows.withColumns(
        {
            **_alert_counts(F.col("_raised")),
            **{c: F.coalesce(F.col(c), zero) for c in (*metrics, "issue_ratio")},
        }
    ).drop("_raised")


def _capped(points: Column, cap: int) -> Column:
    return F.least(F.lit(cap).cast(SCORE), F.round(points, 2).cast(SCORE))


def score_components(base: DataFrame) -> DataFrame:
    """The five components, each rounded to 2 decimals and capped."""
    one = F.lit(1).cast("decimal(18,4)")
    loss = F.greatest(F.coalesce("payout_ratio", F.lit(0)) - 1, F.lit(0).cast("decimal(18,4)"))
    severity = sum(
        (F.col(f"{name}_alert_count") * points for name, points in SEVERITY_POINTS[1:]),
        F.col(f"{SEVERITY_POINTS[0][0]}_alert_count") * SEVERITY_POINTS[0][1],
    )
    # Points per unit of each ratio. Past a ratio of one every cap is long reached.
    points = {
        "duplicate_component_score": F.least(F.col("duplicate_ratio"), one) * 200,
        "negative_stake_component_score": F.least(F.col("negative_stake_ratio"), one) * 150,
        "payout_loss_component_score": F.least(loss, one) * 100,
        "issue_density_component_score": F.least(F.col("issue_ratio"), one) * 50,
        "alert_severity_component_score": severity.cast("decimal(18,0)"),
    }
    return base.withColumns({name: _capped(points[name], cap) for name, cap, _ in COMPONENTS})


def with_anomaly_score(components: DataFrame) -> DataFrame:
    total = sum((F.col(name) for name, _, _ in COMPONENTS[1:]), F.col(COMPONENTS[0][0]))
    return components.withColumn("anomaly_score", F.least(F.lit(100).cast(SCORE), total.cast(SCORE)))


def primary_driver() -> Column:
    """Name of the largest component, the earliest on ties; none for a zero score."""
    largest = F.greatest(*[F.col(name) for name, _, _ in COMPONENTS])
    driver = F.lit(COMPONENTS[-1][2])
    for name, _, label in reversed(COMPONENTS[:-1]):
        driver = F.when(F.col(name) == largest, label).otherwise(driver)
    return F.when(F.col("anomaly_score") == 0, "none").otherwise(driver)


def anomaly_scorecard(
    reconciliation: DataFrame, rules: tuple[AlertRule, ...] = SOURCE_RULES
) -> DataFrame:
    """Full scorecard: a projection over the reconciliation rows, no further shuffle."""
    scored = with_anomaly_score(score_components(score_base_metrics(reconciliation, rules)))
    return scored.withColumns(
        {
            "anomaly_id": K.anomaly_id(),
            "risk_band": risk_band(F.col("anomaly_score")),
            "primary_driver": primary_driver(),
            "recommended_action": band_action(F.col("anomaly_score")),
        }
    ).select(*SCORECARD_COLUMNS)
