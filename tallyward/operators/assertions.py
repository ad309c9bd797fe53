"""Table invariants. Each operator returns the violating rows; empty means the invariant holds."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyward.functions.bands import BANDS, risk_band
from tallyward.operators.alerts import (
    BOOKMAKER_RULES,
    BOOKMAKER_SCOPE,
    SEVERITIES,
    SOURCE_RULES,
    SOURCE_SCOPE,
    AlertRule,
)
from tallyward.operators.reconcile import ISSUE_COUNT_COLUMNS
from tallyward.operators.scorecard import COMPONENTS


class AssertionsError(RuntimeError):
    """Tables of a run break at least one invariant."""


# Columns that must be filled, and columns that must be unique, by table.
NOT_NULL = {
    "raw": ("ingestion_id", "source_file", "source_row_number", "source_uuid"),
    "bets": ("ingestion_id", "source_uuid", "bet_placed_at", "bet_record_key", "bet_business_key"),
    "dim_customers": ("customer_key",),
    "dim_events": ("event_key",),
    "fct_payouts": ("payout_record_key",),
    "validation_issues": ("bet_record_key", "issue_type"),
    "validation_summary": ("issue_type",),
    "daily_reconciliation_summary": ("source_file", "report_date"),
    "source_day_alerts": ("alert_id",),
    "bookmaker_day_alerts": ("alert_id",),
    "alert_feed": ("alert_id",),
    "anomaly_scorecard": ("anomaly_id", "source_file", "report_date", "risk_band"),
}
UNIQUE = {
    "raw": ("ingestion_id",),
    "bets": ("ingestion_id", "bet_record_key"),
    "dim_customers": ("customer_key",),
    "dim_events": ("event_key",),
    "fct_payouts": ("payout_record_key",),
    "validation_summary": ("issue_type",),
    "source_day_alerts": ("alert_id",),
    "bookmaker_day_alerts": ("alert_id",),
    "alert_feed": ("alert_id",),
    "anomaly_scorecard": ("anomaly_id",),
}


def _any(conditions: Sequence[Column]) -> Column:
    return reduce(or_, conditions)


def assert_not_null(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNull())


def assert_unique(df: DataFrame, column: str) -> DataFrame:
    """Values met more than once, with their count; NULL is not a value."""
    return (
        df.where(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("row_count"))
        .where(F.col("row_count") > 1)
    )


def assert_accepted_values(df: DataFrame, column: str, values: Sequence[str] = BANDS) -> DataFrame:
    """Values outside the domain, with their count."""
    return (
        df.where(~F.col(column).isin(list(values)))
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("row_count"))
    )


def assert_alert_scope(feed: DataFrame, severities: Sequence[str] = SEVERITIES) -> DataFrame:
    """Severity in its domain, and exactly the subject of the scope filled in."""
    has_file, has_bookmaker = F.col("source_file").isNotNull(), F.col("bookmaker_name").isNotNull()
    fits = F.when(F.col("alert_scope") == SOURCE_SCOPE, has_file & ~has_bookmaker).when(
        F.col("alert_scope") == BOOKMAKER_SCOPE, has_bookmaker & ~has_file
    )
    return feed.where(~F.col("severity").isin(list(severities)) | ~F.coalesce(fits, F.lit(False)))


def assert_summary_matches_feed(feed: DataFrame, summary: DataFrame) -> DataFrame:
    """Summary groups whose count differs from the feed, in either direction."""
    group = ["report_date", "alert_scope", "severity", "alert_type"]
    counted = feed.groupBy(*group).agg(F.count(F.lit(1)).alias("feed_alert_count"))
    return (
        counted.join(summary.select(*group, F.col("alert_count").alias("summary_alert_count")), group, "full")
        .where(~F.col("feed_alert_count").eqNullSafe(F.col("summary_alert_count")))
        .select(*group, "feed_alert_count", "summary_alert_count")
    )


def assert_risk_band(scorecard: DataFrame) -> DataFrame:
    return scorecard.where(F.col("risk_band") != risk_band(F.col("anomaly_score"))).select(
        "anomaly_id", "anomaly_score", "risk_band"
    )


def assert_score_bounds(scorecard: DataFrame, low: float = 0, high: float = 100) -> DataFrame:
    return scorecard.where(~F.col("anomaly_score").between(low, high)).select("anomaly_id", "anomaly_score")


def assert_components_sum(scorecard: DataFrame, cap: float = 100) -> DataFrame:
    total = sum((F.col(name) for name, _, _ in COMPONENTS[1:]), F.col(COMPONENTS[0][0]))
    return scorecard.where(F.col("anomaly_score") != F.least(F.lit(cap).cast("decimal(6,2)"), total)).select(
        "anomaly_id", "anomaly_score", *[name for name, _, _ in COMPONENTS]
    )


def _breaks(rule: AlertRule) -> Column:
    """An alert of this type that its own rule does not explain."""
    explained = rule.fires() & (F.col("severity") == rule.severity()) & (F.col("alert_owner") == rule.owner)
    return (F.col("alert_type") == rule.name) & ~explained


def assert_source_thresholds(alerts: DataFrame, rules: tuple[AlertRule, ...] = SOURCE_RULES) -> DataFrame:
    """Source alerts that miss their thresholds, severity, owner or scope."""
    return alerts.where(
        _any([_breaks(rule) for rule in rules])
        | (F.col("alert_scope") != SOURCE_SCOPE)
        | F.col("source_file").isNull()
        | F.col("bookmaker_name").isNotNull()
    )


def assert_bookmaker_thresholds(
    alerts: DataFrame, rules: tuple[AlertRule, ...] = BOOKMAKER_RULES
) -> DataFrame:
    """Bookmaker alerts that miss their thresholds, severity, owner or scope."""
    return alerts.where(
        _any([_breaks(rule) for rule in rules])
        | (F.col("alert_scope") != BOOKMAKER_SCOPE)
        | F.col("source_file").isNotNull()
        | F.col("bookmaker_name").isNull()
    )


def assert_reconciliation_counts(reconciliation: DataFrame) -> DataFrame:
    """No part exceeds the rows of its day, and all issues are at least the sum of the rules."""
    issue_columns = list(ISSUE_COUNT_COLUMNS.values())
    parts = [
        "distinct_bet_key_count",
        "duplicate_bet_key_group_count",
        "duplicate_extra_row_count",
        "named_customer_rows",
        "cancelled_bet_rows",
        "refunded_bet_rows",
        *issue_columns,
    ]
    per_rule = sum((F.coalesce(c, F.lit(0)) for c in issue_columns[1:]), F.coalesce(issue_columns[0], F.lit(0)))
    return reconciliation.where(
        _any([F.col(c) > F.col("total_bet_rows") for c in parts]) | (F.col("total_issue_rows") < per_rule)
    )


def assert_reconciliation_status(reconciliation: DataFrame) -> DataFrame:
    """Review exactly when there are issues; a payout ratio exactly when there is stake."""
    expected = F.when(F.col("total_issue_rows") == 0, "pass").otherwise("review")
    no_stake = F.col("total_stake_amount") == 0
    return reconciliation.where(
        (F.col("reconciliation_status") != expected) | (no_stake != F.col("payout_ratio").isNull())
    )


def column_counts(name: str, df: DataFrame, filled: Sequence[str] = (), unique: Sequence[str] = ()) -> DataFrame:
    """(assertion, violations) of every column that must be filled or unique, in one scan and one shuffle of the table.

    A row gives a cell for each missing value and one with a 128-bit digest for each value that must be unique. Counted
    by (constraint, digest), partly before the shuffle, these cells answer all constraints; a value met more than once
    is one violation, as in ``assert_unique``, and a missing value is no value.
    """
    missing = [F.when(F.col(c).isNull(), F.struct(F.lit(k).alias("k"), F.lit(None).cast("binary").alias("digest")))
               for k, c in enumerate(filled)]
    values = [F.when(F.col(c).isNotNull(), F.struct(F.lit(k).alias("k"), F.unhex(F.md5(F.col(c).cast("string"))).alias("digest")))
              for k, c in enumerate(unique, len(filled))]
    cells = df.select(F.inline(F.filter(F.array(*missing, *values), lambda cell: cell.isNotNull())))
    counted = cells.groupBy("k", "digest").agg(F.count(F.lit(1)).alias("rows"))
    figures = [F.coalesce(F.sum(F.when(F.col("k") == k, F.col("rows"))), F.lit(0)) for k in range(len(filled))]
    figures += [F.count_if((F.col("k") == k) & (F.col("rows") > 1)) for k in range(len(filled), len(filled) + len(unique))]
    names = [f"not_null {name}.{c}" for c in filled] + [f"unique {name}.{c}" for c in unique]
    one = counted.agg(*[figure.alias(f"c{k}") for k, figure in enumerate(figures)])
    return one.select(
        F.inline(F.array(*[F.struct(F.lit(n).alias("assertion"), F.col(f"c{k}").alias("violations")) for k, n in enumerate(names)]))
    )


def violation_count(name: str, violations: DataFrame) -> DataFrame:
    return violations.agg(F.lit(name).alias("assertion"), F.count(F.lit(1)).alias("violations"))


def run_assertions(tables: dict[str, DataFrame]) -> DataFrame:
    """(assertion, violations) of every invariant over the tables of a run."""
    found = [column_counts(name, tables[name], NOT_NULL.get(name, ()), UNIQUE.get(name, ())) for name in {**NOT_NULL, **UNIQUE}]
    card, recon, feed = tables["anomaly_scorecard"], tables["daily_reconciliation_summary"], tables["alert_feed"]
    found += [
        violation_count("accepted_values anomaly_scorecard.risk_band", assert_accepted_values(card, "risk_band")),
        violation_count("alert_scope", assert_alert_scope(feed)),
        violation_count("summary_matches_feed", assert_summary_matches_feed(feed, tables["alert_summary"])),
        violation_count("risk_band", assert_risk_band(card)),
        violation_count("score_bounds", assert_score_bounds(card)),
        violation_count("components_sum", assert_components_sum(card)),
        violation_count("source_thresholds", assert_source_thresholds(tables["source_day_alerts"])),
        violation_count("bookmaker_thresholds", assert_bookmaker_thresholds(tables["bookmaker_day_alerts"])),
        violation_count("reconciliation_counts", assert_reconciliation_counts(recon)),
        violation_count("reconciliation_status", assert_reconciliation_status(recon)),
    ]
    return reduce(DataFrame.unionByName, found)


def enforce_assertions(counts: DataFrame) -> None:
    """Raise once with every broken invariant; there is one row for each that was asked."""
    broken = counts.where("violations > 0").orderBy("assertion").collect()
    if broken:
        raise AssertionsError("; ".join(f"{r.assertion}: {r.violations} rows" for r in broken))
