"""Threshold alerts on source-days and bookmaker-days."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyward.functions import keys as K
from tallyward.operators.reconcile import ratio

ALERT_COLUMNS = [
    "alert_id",
    "alert_scope",
    "report_date",
    "source_file",
    "bookmaker_name",
    "severity",
    "alert_type",
    "alert_owner",
    "alert_message",
    "total_bet_rows",
    "duplicate_extra_row_count",
    "duplicate_ratio",
    "negative_stake_issue_rows",
    "negative_stake_ratio",
    "total_issue_rows",
    "total_stake_amount",
    "total_payout_amount",
    "net_revenue_amount",
    "payout_ratio",
]

SOURCE_SCOPE = "source_day"
BOOKMAKER_SCOPE = "bookmaker_day"
SEVERITIES = ("critical", "high", "medium")


@dataclass(frozen=True)
class AlertRule:
    """One threshold rule: minimum size, minimum ratio, and the ratio where gravity rises.

    ``steps`` lists (severity, ratio floor) from the gravest down; below all of
    them the alert has severity ``base``.
    """

    name: str
    owner: str
    minimums: tuple[tuple[str, float], ...]
    ratio_column: str
    ratio_floor: str
    steps: tuple[tuple[str, str], ...]
    base: str
    label: str

    def _at_least(self, floor: str) -> Column:
        return F.col(self.ratio_column) >= F.lit(floor).cast("decimal(18,4)")

    def fires(self) -> Column:
        hit = self._at_least(self.ratio_floor)
        for column, least in self.minimums:
            hit = hit & (F.col(column) >= least)
        return F.coalesce(hit, F.lit(False))

    def severity(self) -> Column:
        result = F.lit(self.base)
        for name, floor in reversed(self.steps):
            result = F.when(self._at_least(floor), name).otherwise(result)
        return result

    def message(self, subject: str) -> Column:
        if self.ratio_column == "payout_ratio":
            figure, tail = F.col(self.ratio_column).cast("decimal(18,4)"), " exceeded loss threshold for "
        else:
            figure = F.round(F.col(self.ratio_column) * 100, 2).cast("decimal(18,2)")
            tail = "% exceeded threshold for "
        # concat_ws skips NULL, so an unnamed subject still gets a message.
        return F.concat_ws("", F.lit(self.label), figure.cast("string"), F.lit(tail), F.col(subject))


# Default thresholds, owners and labels of the rules.
SOURCE_RULES = (
    AlertRule(
        name="duplicate_ratio_spike",
        owner="integrity_ops",
        minimums=(("total_bet_rows", 500), ("duplicate_extra_row_count", 100)),
        ratio_column="duplicate_ratio",
        ratio_floor="0.10",
        steps=(("critical", "0.25"),),
        base="high",
        label="Duplicate bet-key ratio ",
    ),
    AlertRule(
        name="negative_stake_spike",
        owner="reconciliation_ops",
        minimums=(("total_bet_rows", 100), ("negative_stake_issue_rows", 50)),
        ratio_column="negative_stake_ratio",
        ratio_floor="0.10",
        steps=(("critical", "0.50"), ("high", "0.25")),
        base="medium",
        label="Negative stake ratio ",
    ),
    AlertRule(
        name="loss_day_payout_ratio",
        owner="finance_recon",
        minimums=(("total_stake_amount", 50000),),
        ratio_column="payout_ratio",
        ratio_floor="1.05",
        steps=(("critical", "1.20"),),
        base="high",
        label="Payout ratio ",
    ),
)
BOOKMAKER_RULES = (
    AlertRule(
        name="bookmaker_duplicate_ratio_spike",
        owner="integrity_ops",
        minimums=(("total_bet_rows", 100), ("duplicate_extra_row_count", 25)),
        ratio_column="duplicate_ratio",
        ratio_floor="0.10",
        steps=(("critical", "0.25"),),
        base="high",
        label="Bookmaker duplicate ratio ",
    ),
    AlertRule(
        name="bookmaker_loss_day",
        owner="finance_recon",
        minimums=(("total_stake_amount", 100000),),
        ratio_column="payout_ratio",
        ratio_floor="1.05",
        steps=(("critical", "1.20"),),
        base="high",
        label="Bookmaker payout ratio ",
    ),
)


def source_metrics(reconciliation: DataFrame) -> DataFrame:
    """Reconciliation rows with duplicate and negative-stake ratios."""
    return reconciliation.withColumns(
        {
            "duplicate_ratio": ratio(F.col("duplicate_extra_row_count"), F.col("total_bet_rows")),
            "negative_stake_ratio": ratio(F.col("negative_stake_issue_rows"), F.col("total_bet_rows")),
        }
    ).select(
        "source_file",
        "report_date",
        "total_bet_rows",
        "duplicate_extra_row_count",
        "negative_stake_issue_rows",
        "total_issue_rows",
        "total_stake_amount",
        "total_payout_amount",
        "net_revenue_amount",
        "payout_ratio",
        "duplicate_ratio",
        "negative_stake_ratio",
    )


def bookmaker_metrics(bookmaker_summary: DataFrame) -> DataFrame:
    """Bookmaker-days with duplicate and payout ratios."""
    return bookmaker_summary.withColumns(
        {
            "duplicate_ratio": ratio(F.col("duplicate_extra_row_count"), F.col("total_bet_rows")),
            "payout_ratio": ratio(F.col("total_payout_amount"), F.col("total_stake_amount")),
        }
    ).select(
        "bookmaker_name",
        "report_date",
        "total_bet_rows",
        "duplicate_extra_row_count",
        "total_stake_amount",
        "total_payout_amount",
        "net_revenue_amount",
        "duplicate_ratio",
        "payout_ratio",
    )


def fired_alerts(rules: tuple[AlertRule, ...], subject: str) -> Column:
    """Array of the alerts a metrics row raises."""
    return F.array_compact(
        F.array(
            *[
                F.when(
                    rule.fires(),
                    F.struct(
                        rule.severity().alias("severity"),
                        F.lit(rule.name).alias("alert_type"),
                        F.lit(rule.owner).alias("alert_owner"),
                        rule.message(subject).alias("alert_message"),
                    ),
                )
                for rule in rules
            ]
        )
    )


def source_day_alerts(
    reconciliation: DataFrame, rules: tuple[AlertRule, ...] = SOURCE_RULES
) -> DataFrame:
    """Alerts of the source scope: one pass, each row explodes into what it raises."""
    return (
        source_metrics(reconciliation)
        .select("*", F.inline(fired_alerts(rules, "source_file")))
        .withColumns(
            {"alert_scope": F.lit(SOURCE_SCOPE), "bookmaker_name": F.lit(None).cast("string")}
        )
        .withColumn("alert_id", K.source_alert_id())
        .select(*ALERT_COLUMNS)
    )


def bookmaker_day_alerts(
    bookmaker_summary: DataFrame, rules: tuple[AlertRule, ...] = BOOKMAKER_RULES
) -> DataFrame:
    """Alerts of the bookmaker scope; surplus rows stand for all issue rows."""
    return (
        bookmaker_metrics(bookmaker_summary)
        .select("*", F.inline(fired_alerts(rules, "bookmaker_name")))
        .withColumns(
            {
                "alert_scope": F.lit(BOOKMAKER_SCOPE),
                "source_file": F.lit(None).cast("string"),
                "negative_stake_issue_rows": F.lit(None).cast("long"),
                "negative_stake_ratio": F.lit(None).cast("decimal(18,4)"),
                "total_issue_rows": F.col("duplicate_extra_row_count"),
            }
        )
        .withColumn("alert_id", K.bookmaker_alert_id())
        .select(*ALERT_COLUMNS)
    )


def alerts_of(feed: DataFrame, alert_type: str) -> DataFrame:
    return feed.where(F.col("alert_type") == alert_type)


def alert_feed(
    reconciliation: DataFrame,
    bookmaker_summary: DataFrame,
    source_rules: tuple[AlertRule, ...] = SOURCE_RULES,
    bookmaker_rules: tuple[AlertRule, ...] = BOOKMAKER_RULES,
) -> DataFrame:
    """Both scopes in one shape."""
    return source_day_alerts(reconciliation, source_rules).unionByName(
        bookmaker_day_alerts(bookmaker_summary, bookmaker_rules)
    )


def alert_summary(feed: DataFrame) -> DataFrame:
    return (
        feed.groupBy("report_date", "alert_scope", "severity", "alert_type")
        .agg(F.count(F.lit(1)).alias("alert_count"))
        .orderBy(F.asc_nulls_last("report_date"), "alert_scope", "severity", "alert_type")
    )
