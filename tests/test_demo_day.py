"""Known figures of the demonstration day, through every stage."""

from decimal import Decimal

import pytest

from tallyward.operators import alerts, bets, quality, reconcile, scorecard, staging, summaries
from tests.demo import demo_raw


@pytest.fixture(scope="module")
def keyed(spark):
    return bets.key_bets(staging.stage_bets(demo_raw(spark))).cache()


@pytest.fixture(scope="module")
def recon(keyed):
    return reconcile.daily_reconciliation_summary(keyed).cache()


def test_shapes(spark, keyed):
    staged = staging.stage_bets(demo_raw(spark))
    assert len(staged.columns) == 61
    assert len(bets.fct_bets(keyed).columns) == 53
    assert len(bets.fct_payouts(keyed).columns) == 28
    assert bets.fct_payouts(keyed).count() == 596


def test_issues(keyed):
    counts = {r.issue_type: r.issue_count for r in quality.validation_summary(quality.validation_issues(keyed)).collect()}
    assert counts == {
        "duplicate_bet_key": 242,
        "negative_total_stake": 81,
        "missing_event_timestamp": 6,
        "cancelled_with_payout": 6,
        "payout_without_stake": 6,
    }
    for name, n in counts.items():
        assert quality.issues_of(keyed, name).count() == n


def test_reconciliation(recon):
    row = recon.first()
    assert recon.count() == 1 and len(recon.columns) == 20
    assert (row.total_bet_rows, row.distinct_bet_key_count) == (600, 479)
    assert (row.duplicate_bet_key_group_count, row.duplicate_extra_row_count) == (121, 121)
    assert row.total_issue_rows == 341
    assert row.total_stake_amount == Decimal("60088.00")
    assert row.total_payout_amount == Decimal("94670.40")
    assert row.net_revenue_amount == Decimal("-34582.40")
    assert row.payout_ratio == Decimal("1.5755")
    assert row.reconciliation_status == "review"


def test_alerts(recon, keyed):
    feed = alerts.alert_feed(recon, reconcile.daily_bookmaker_summary(keyed))
    assert len(feed.columns) == 19
    found = {(r.alert_type, r.severity): r.alert_message for r in feed.collect()}
    assert found == {
        ("loss_day_payout_ratio", "critical"): "Payout ratio 1.5755 exceeded loss threshold for demo_dump.csv",
        ("duplicate_ratio_spike", "high"): "Duplicate bet-key ratio 20.17% exceeded threshold for demo_dump.csv",
        ("negative_stake_spike", "medium"): "Negative stake ratio 13.50% exceeded threshold for demo_dump.csv",
        ("bookmaker_duplicate_ratio_spike", "high"): "Bookmaker duplicate ratio 20.17% exceeded threshold for Demo Bookmaker",
    }


def test_scorecard(recon):
    card = scorecard.anomaly_scorecard(recon)
    row = card.first()
    assert len(card.columns) == 32
    assert [
        row.duplicate_component_score, row.negative_stake_component_score, row.payout_loss_component_score,
        row.issue_density_component_score, row.alert_severity_component_score,
    ] == [Decimal("30.00"), Decimal("20.25"), Decimal("20.00"), Decimal("15.00"), Decimal("10.00")]
    assert row.anomaly_score == Decimal("95.25")
    assert (row.risk_band, row.primary_driver) == ("critical", "duplicate_pressure")
    assert row.recommended_action == "Immediate integrity and finance review"
    assert (row.duplicate_ratio, row.negative_stake_ratio, row.issue_ratio) == (
        Decimal("0.2017"), Decimal("0.1350"), Decimal("0.5683"),
    )


def test_overview(recon, keyed):
    feed = alerts.alert_feed(recon, reconcile.daily_bookmaker_summary(keyed))
    issue_days = reconcile.daily_issue_summary(quality.validation_issues(keyed))
    row = summaries.eod_overview(scorecard.anomaly_scorecard(recon), feed, issue_days).first()
    assert (row.source_day_count, row.total_bet_rows, row.high_risk_source_day_count) == (1, 600, 1)
    assert (row.total_alert_count, row.total_quality_issue_count) == (4, 341)


def test_customers(spark):
    row = bets.dim_customers(staging.stage_bets(demo_raw(spark))).first()
    assert (row.customer_name_normalized, row.bet_count, row.bookmaker_count) == ("DEMO CUSTOMER", 600, 1)
    assert row.total_stake_amount == Decimal("60088.00")
