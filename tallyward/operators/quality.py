"""Row-level rules: one output row per bet and violated rule."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Rule name -> text written to issue_detail.
ISSUE_DETAILS = {
    "duplicate_bet_key": "Duplicate source_uuid + ticket_no within the same source file",
    "negative_total_stake": "Total stake amount is below zero after parsing win/place stake values",
    "missing_event_timestamp": "Event timestamp is null after combining event date and time fields",
    "cancelled_with_payout": "Cancelled bet still shows a positive payout amount",
    "payout_without_stake": "Positive payout amount exists while parsed stake amount is zero or null",
}
ISSUE_TYPES = tuple(ISSUE_DETAILS)

ISSUE_COLUMNS = [
    "issue_type",
    "ingestion_id",
    "bet_record_key",
    "bet_business_key",
    "source_file",
    "source_row_number",
    "source_refid",
    "source_uuid",
    "ticket_no",
    "bookmaker_name",
    "bet_placed_at",
    "total_stake_amount",
    "total_payout_amount",
    "issue_detail",
]


def rule_hit(issue_type: str) -> Column:
    """Condition of one rule over keyed bets; never NULL."""
    stake = F.coalesce("total_stake_amount", F.lit(0))
    payout = F.coalesce("total_payout_amount", F.lit(0))
    rules = {
        "duplicate_bet_key": (F.col("bet_key_rows") > 1)
        & F.col("source_uuid").isNotNull()
        & F.col("ticket_no").isNotNull(),
        "negative_total_stake": stake < 0,
        "missing_event_timestamp": F.col("event_scheduled_at").isNull(),
        "cancelled_with_payout": F.coalesce("is_cancelled", F.lit(False)) & (payout > 0),
        "payout_without_stake": (stake == 0) & (payout > 0),
    }
    return rules[issue_type]


def issues_of(bets: DataFrame, issue_type: str) -> DataFrame:
    """Rows violating one rule."""
    return (
        bets.where(rule_hit(issue_type))
        .withColumns({"issue_type": F.lit(issue_type), "issue_detail": F.lit(ISSUE_DETAILS[issue_type])})
        .select(*ISSUE_COLUMNS)
    )


def validation_issues(bets: DataFrame) -> DataFrame:
    """All rules in a single pass: each bet explodes into the rules it violates."""
    hits = F.array_compact(
        F.array(
            *[
                F.when(
                    rule_hit(name),
                    F.struct(F.lit(name).alias("issue_type"), F.lit(detail).alias("issue_detail")),
                )
                for name, detail in ISSUE_DETAILS.items()
            ]
        )
    )
    kept = [c for c in ISSUE_COLUMNS if c not in ("issue_type", "issue_detail")]
    return bets.select(*kept, F.inline(hits)).select(*ISSUE_COLUMNS)


def validation_summary(issues: DataFrame) -> DataFrame:
    """Issues per rule, most frequent first."""
    return (
        issues.groupBy("issue_type")
        .agg(F.count(F.lit(1)).alias("issue_count"))
        .orderBy(F.desc("issue_count"), "issue_type")
    )
