"""Day-grain rules that the demonstration day does not reach."""

from datetime import datetime
from decimal import Decimal

from pyspark.sql import functions as F

from tallyward.operators import bets, quality, reconcile

SCHEMA = (
    "ingestion_id long, source_file string, source_sheet string, source_row_number long, source_refid string, "
    "source_uuid string, ticket_no string, bookmaker_name string, bet_placed_at timestamp_ntz, "
    "event_scheduled_at timestamp_ntz, event_category string, venue_name string, venue_state_code string, "
    "race_number int, runner_number int, runner_name string, customer_name string, is_cancelled boolean, "
    "is_refunded boolean, total_stake_amount decimal(15,2), total_payout_amount decimal(15,2)"
)
D1, D2 = datetime(2026, 3, 1, 10), datetime(2026, 3, 2, 10)


def bet(i, uuid, ticket, when, bookmaker="b", stake="10.00", payout="0.00", cancelled=False):
    return (
        i, "f", "s", i + 1, None, uuid, ticket, bookmaker, when, D1, "R", None, None, None, None, None, None,
        cancelled, None, Decimal(stake), Decimal(payout),
    )


def keyed(spark, *rows):
    return bets.key_bets(spark.createDataFrame(list(rows), SCHEMA))


def test_three_notions_of_duplicate(spark):
    # One key on two days, and two rows without any id on one day.
    df = keyed(
        spark, bet(1, "u", "t", D1), bet(2, "u", "t", D2), bet(3, None, None, D1), bet(4, None, None, D1),
        bet(5, "u", None, D1), bet(6, "u", None, D1),
    )
    recon = {str(r.report_date): r for r in reconcile.daily_reconciliation_summary(df).collect()}
    # Surplus counts within the day, rows without ids included.
    assert recon["2026-03-01"].duplicate_extra_row_count == 2
    assert recon["2026-03-02"].duplicate_extra_row_count == 0
    # The issue rule counts over the whole file, and only with both ids.
    assert recon["2026-03-01"].duplicate_bet_key_issue_rows == 1
    assert recon["2026-03-02"].duplicate_bet_key_issue_rows == 1
    # The bookmaker grain uses the rank over the whole file.
    books = {str(r.report_date): r for r in reconcile.daily_bookmaker_summary(df).collect()}
    assert books["2026-03-02"].duplicate_extra_row_count == 1
    assert books["2026-03-01"].duplicate_extra_row_count == 2


def test_rows_without_a_day_or_bookmaker_count_zero(spark):
    df = keyed(
        spark, bet(1, "u", "t", None), bet(2, "u", "t", None, stake="-5.00"), bet(3, "u", "t", D1, bookmaker=None),
    )
    recon = {r.report_date: r for r in reconcile.daily_reconciliation_summary(df).collect()}
    blank = recon[None]
    assert blank.total_bet_rows == 2 and blank.total_issue_rows == 0 and blank.duplicate_extra_row_count == 0
    assert blank.reconciliation_status == "pass"
    issue_days = reconcile.daily_issue_summary(quality.validation_issues(df))
    assert issue_days.where(F.col("report_date").isNull()).agg(F.sum("issue_count")).first()[0] == 3
    books = reconcile.daily_bookmaker_summary(df).where(F.col("bookmaker_name").isNull() | F.col("report_date").isNull())
    assert {r.duplicate_extra_row_count for r in books.collect()} == {0}


def test_zero_stake_has_no_payout_ratio(spark):
    row = reconcile.daily_reconciliation_summary(keyed(spark, bet(1, "u", "t", D1, stake="0.00", payout="5.00"))).first()
    assert row.payout_ratio is None and row.payout_without_stake_issue_rows == 1


def test_one_bet_can_break_several_rules(spark):
    df = keyed(spark, bet(1, "u", "t", D1, stake="0.00", payout="5.00", cancelled=True), bet(2, "u", "t", D1))
    assert sorted(r.issue_type for r in quality.validation_issues(df).where("source_row_number = 2").collect()) == [
        "cancelled_with_payout", "duplicate_bet_key", "payout_without_stake",
    ]


def test_payouts_keep_negative_amounts(spark):
    df = keyed(spark, bet(1, "u", "t", D1, payout="-5.00"), bet(2, "v", "t", D1))
    for c in ("paid_status", "win_result", "place_result", "win_payout_amount", "place_payout_amount"):
        df = df.withColumn(c, F.lit(None).cast("string"))
    assert [r.total_payout_amount for r in bets.fct_payouts(df).collect()] == [Decimal("-5.00")]
