from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallyward.functions.bands import band_action, gravity_order, risk_band
from tallyward.operators import alerts as A
from tallyward.operators import scorecard as S

RECON = (
    "source_file string, report_date date, total_bet_rows long, distinct_bet_key_count long, "
    "duplicate_bet_key_group_count long, duplicate_extra_row_count long, named_customer_rows long, "
    "cancelled_bet_rows long, refunded_bet_rows long, total_issue_rows long, duplicate_bet_key_issue_rows long, "
    "negative_stake_issue_rows long, missing_event_timestamp_issue_rows long, "
    "cancelled_with_payout_issue_rows long, payout_without_stake_issue_rows long, "
    "total_stake_amount decimal(24,2), total_payout_amount decimal(24,2), net_revenue_amount decimal(24,2), "
    "payout_ratio decimal(18,4), reconciliation_status string"
)
DAY = date(2026, 3, 4)


def recon_row(file, rows, surplus=0, negative=0, issues=None, stake="1000.00", ratio="0.5000", day=DAY):
    issues = negative if issues is None else issues
    return (
        file, day, rows, rows - surplus, 0, surplus, 0, 0, 0, issues, 0, negative, 0, 0, 0, Decimal(stake),
        Decimal("0.00"), Decimal("0.00"), None if ratio is None else Decimal(ratio),
        "review" if issues else "pass",
    )


def card(spark, *rows):
    df = spark.createDataFrame(list(rows), RECON)
    return {r.source_file: r for r in S.anomaly_scorecard(df).collect()}


def test_worked_examples(spark):
    got = card(
        spark,
        recon_row("b", 668, 0, 130, stake="65663.66", ratio="1.2035"),
        recon_row("c", 820, 0, 53, stake="204807.37", ratio="1.1194"),
        recon_row("d", 1039, 0, 89, stake="23303.32", ratio="0.8412"),
        recon_row("e", 253, 0, 0, stake="29088.50", ratio="0.1174"),
    )
    components = [c for c, _, _ in S.COMPONENTS]
    parts = {f: [str(getattr(r, c)) for c in components] for f, r in got.items()}
    assert parts["b"] == ["0.00", "25.00", "20.00", "9.73", "10.00"]
    assert parts["c"] == ["0.00", "9.69", "11.94", "3.23", "6.00"]
    assert parts["d"] == ["0.00", "12.86", "0.00", "4.29", "0.00"]
    assert [str(got[f].anomaly_score) for f in "bcde"] == ["64.73", "30.86", "17.15", "0.00"]
    assert [got[f].risk_band for f in "bcde"] == ["high", "low", "low", "normal"]
    assert [got[f].primary_driver for f in "bcde"] == [
        "negative_stake_pressure", "payout_loss_pressure", "negative_stake_pressure", "none",
    ]
    assert (got["b"].critical_alert_count, got["b"].medium_alert_count, got["b"].alert_count) == (1, 1, 2)


def test_days_without_a_date_have_no_alert_points(spark):
    got = card(spark, recon_row("x", 668, 0, 130, stake="65663.66", ratio="1.2035", day=None))
    assert got["x"].alert_count == 0 and str(got["x"].alert_severity_component_score) == "0.00"


def test_null_ratio_and_negative_ratio_score_nothing(spark):
    got = card(spark, recon_row("x", 100, ratio=None), recon_row("y", 100, ratio="-2.0000"))
    assert str(got["x"].payout_loss_component_score) == "0.00"
    assert str(got["y"].payout_loss_component_score) == "0.00"


def test_extreme_ratio_is_capped(spark):
    got = card(spark, recon_row("x", 100, ratio="99999999.0000"))
    assert str(got["x"].payout_loss_component_score) == "20.00"


def test_driver_ties_go_to_the_earlier_component(spark):
    df = spark.createDataFrame(
        [(10, 10, 10, 10, 10), (1, 2, 2, 2, 2), (0, 0, 3, 3, 3), (0, 0, 0, 4, 4), (0, 0, 0, 0, 5), (0, 0, 0, 0, 0)],
        [c for c, _, _ in S.COMPONENTS],
    )
    df = df.withColumn("anomaly_score", sum(F.col(c) for c, _, _ in S.COMPONENTS))
    assert [r.d for r in df.select(S.primary_driver().alias("d")).collect()] == [
        "duplicate_pressure", "negative_stake_pressure", "payout_loss_pressure", "issue_density", "alert_severity",
        "none",
    ]


def test_band_edges(spark):
    values = ["0", "14.99", "15", "34.99", "35", "59.99", "60", "79.99", "80", "100"]
    df = spark.createDataFrame([(Decimal(v),) for v in values], "s decimal(6,2)")
    rows = df.select(risk_band(F.col("s")).alias("b"), band_action(F.col("s")).alias("a")).collect()
    assert [r.b for r in rows] == [
        "normal", "normal", "low", "low", "medium", "medium", "high", "high", "critical", "critical",
    ]
    assert rows[-1].a == "Immediate integrity and finance review" and rows[0].a == "No action required"
    order = spark.createDataFrame([(b,) for b in ("normal", "low", "critical", "medium", "high")], "b string")
    assert [r.b for r in order.orderBy(gravity_order(F.col("b"))).collect()] == [
        "critical", "high", "medium", "low", "normal",
    ]


@pytest.mark.parametrize(
    "row, expected",
    [
        (recon_row("f", 500, 100, 0, stake="1"), {("duplicate_ratio_spike", "high")}),
        (recon_row("f", 499, 100, 0, stake="1"), set()),
        (recon_row("f", 500, 99, 0, stake="1"), set()),
        (recon_row("f", 1001, 100, 0, stake="1"), set()),
        (recon_row("f", 500, 125, 0, stake="1"), {("duplicate_ratio_spike", "critical")}),
        (recon_row("f", 100, 0, 50, stake="1"), {("negative_stake_spike", "critical")}),
        (recon_row("f", 200, 0, 50, stake="1"), {("negative_stake_spike", "high")}),
        (recon_row("f", 500, 0, 50, stake="1"), {("negative_stake_spike", "medium")}),
        (recon_row("f", 99, 0, 50, stake="1"), set()),
        (recon_row("f", 10, stake="50000.00", ratio="1.0500"), {("loss_day_payout_ratio", "high")}),
        (recon_row("f", 10, stake="50000.00", ratio="1.2000"), {("loss_day_payout_ratio", "critical")}),
        (recon_row("f", 10, stake="49999.99", ratio="1.2000"), set()),
        (recon_row("f", 10, stake="50000.00", ratio="1.0499"), set()),
        (recon_row("f", 10, stake="50000.00", ratio=None), set()),
    ],
)
def test_source_thresholds(spark, row, expected):
    feed = A.source_day_alerts(spark.createDataFrame([row], RECON))
    assert {(r.alert_type, r.severity) for r in feed.collect()} == expected


def test_rules_are_arguments(spark):
    from dataclasses import replace

    df = spark.createDataFrame([recon_row("f", 10, 1, 0, stake="1")], RECON)
    rule = replace(A.SOURCE_RULES[0], minimums=(("total_bet_rows", 10),))
    assert [r.alert_type for r in A.source_day_alerts(df, (rule,)).collect()] == ["duplicate_ratio_spike"]


def test_unnamed_bookmaker_still_gets_a_message_and_id(spark):
    df = spark.createDataFrame(
        [(None, DAY, 100, 100, 0, 0, 0, 0, Decimal("100000.00"), Decimal("130000.00"), Decimal("-30000.00"))],
        "bookmaker_name string, report_date date, total_bet_rows long, distinct_bet_key_count long, "
        "named_customer_rows long, cancelled_bet_rows long, refunded_bet_rows long, "
        "duplicate_extra_row_count long, total_stake_amount decimal(24,2), total_payout_amount decimal(24,2), "
        "net_revenue_amount decimal(24,2)",
    )
    row = A.bookmaker_day_alerts(df).first()
    assert row.alert_message == "Bookmaker payout ratio 1.3000 exceeded loss threshold for "
    assert row.alert_id is not None and row.negative_stake_ratio is None and row.total_issue_rows == 0
