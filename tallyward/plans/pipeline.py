"""One whole run: land, stage, check, reconcile, alert, score, triage, assert, export, gate."""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import asdict, dataclass, field
from datetime import datetime, timezone
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyward.functions.parsing import STRICT
from tallyward.operators import alerts, assertions, bets, gates, quality, reconcile, scorecard, staging, summaries, triage
from tallyward.session import tune
from tallyward.sources import exports, landing
from tallyward.sources.shared import cut, cut_lean, scratch


@dataclass
class Reports:
    """Report tables of a run; each is written once and read by all later stages."""

    daily_reconciliation_summary: DataFrame
    daily_issue_summary: DataFrame
    daily_bookmaker_summary: DataFrame
    alert_feed: DataFrame
    alert_summary: DataFrame
    anomaly_scorecard: DataFrame


@dataclass
class RunRecord:
    run_id: str
    generated_at: str
    source_file_count: int
    source_row_count: int
    output_rows: dict[str, int]
    metrics: dict[str, float]
    checks: int
    assertions: dict[str, int] = field(default_factory=dict)


# What the reports read of a keyed bet; a cut of just these is narrow.
REPORT_INPUT = [
    "source_file",
    "source_row_number",
    "ingestion_id",
    "source_refid",
    "source_uuid",
    "ticket_no",
    "bookmaker_name",
    "customer_key",
    "bet_placed_at",
    "event_scheduled_at",
    "total_stake_amount",
    "total_payout_amount",
    "is_cancelled",
    "is_refunded",
    "bet_record_key",
    "bet_business_key",
    "bet_key_rows",
    "is_duplicate_bet_key",
]


# What those columns are made of: the keys are digests, which are long and don't compress, so they are derived behind the cut.
REPORT_KEYS = ("bet_record_key", "bet_business_key", "customer_key")
REPORT_PARTS = [c for c in REPORT_INPUT if c not in REPORT_KEYS] + ["source_sheet", "customer_name"]


def report_bets(staged: DataFrame, last_positions: DataFrame | None = None, few_repeats: bool = False) -> DataFrame:
    """``REPORT_INPUT`` of ``key_bets``, cut."""
    ranked = bets.rank_duplicates(staged, last_positions=last_positions, few_repeats=few_repeats)
    return bets.with_surrogate_keys(cut_lean(ranked.select(*REPORT_PARTS), "bets"), REPORT_KEYS).select(*REPORT_INPUT)


def build_reports(keyed: DataFrame) -> Reports:
    """Reports from keyed bets. The three day-grain tables are cut; the rest derive from them."""
    recon = cut_lean(reconcile.daily_reconciliation_summary(keyed), "daily_reconciliation_summary")
    bookmakers = cut_lean(reconcile.daily_bookmaker_summary(keyed), "daily_bookmaker_summary")
    issues = cut_lean(
        reconcile.daily_issue_summary(quality.validation_issues(keyed)), "daily_issue_summary"
    )
    return derived_reports(recon, bookmakers, issues)


def derived_reports(recon: DataFrame, bookmakers: DataFrame, issues: DataFrame) -> Reports:
    """All reports from the three day-grain tables."""
    feed = alerts.alert_feed(recon, bookmakers)
    return Reports(
        daily_reconciliation_summary=recon,
        daily_issue_summary=issues,
        daily_bookmaker_summary=bookmakers,
        alert_feed=feed,
        alert_summary=alerts.alert_summary(feed),
        anomaly_scorecard=scorecard.anomaly_scorecard(recon),
    )


def run_metrics(checks: DataFrame, reports: Reports, ml: DataFrame | None = None) -> DataFrame:
    """One row of figures for the run record."""
    row = reports.anomaly_scorecard.agg(
        F.count(F.lit(1)).alias("anomaly_row_count"),
        F.max("anomaly_score").cast("double").alias("max_anomaly_score"),
        F.count_if(F.col("risk_band") == "critical").alias("critical_anomaly_count"),
    ).withColumns(
        {
            "alert_row_count": reports.alert_feed.agg(F.count(F.lit(1))).scalar(),
            "issue_row_count": reports.daily_issue_summary.agg(
                F.coalesce(F.sum("issue_count"), F.lit(0))
            ).scalar(),
            "failed_check_count": checks.agg(F.count_if(~F.col("passed"))).scalar(),
        }
    )
    if ml is None:
        return row
    figures = triage.ml_report_metrics(ml).select(
        F.struct(
            F.col("row_count").alias("ml_row_count"),
            F.col("outlier_count").alias("ml_outlier_count"),
            "max_ml_anomaly_score",
        )
    )
    return row.withColumn("_ml", figures.scalar()).select("*", "_ml.*").drop("_ml")


# What of a run's figures is written beside the reports: one CSV each, one or a few rows.
def figures(reports: Reports, issues: DataFrame, ml: DataFrame | None) -> dict[str, DataFrame]:
    card, feed, by_day = reports.anomaly_scorecard, reports.alert_feed, reports.daily_issue_summary
    found = {
        "eod_overview": summaries.eod_overview(card, feed, by_day),
        "eod_risk_bands": summaries.eod_risk_bands(card),
        "eod_top_anomalies": summaries.eod_top_anomalies(card),
        "eod_alert_summary": summaries.eod_alert_summary(feed),
        "eod_quality_issues": summaries.eod_quality_issues(issues),
        "dash_top_anomalies": summaries.dash_top_anomalies(card),
        "dash_alert_mix": summaries.dash_alert_mix(feed),
        "dash_issue_mix": summaries.dash_issue_mix(by_day),
    }
    if ml is not None:
        found["dash_kpis"] = summaries.dash_kpis(reports.daily_reconciliation_summary, card, feed, ml)
        found["dash_top_ml"] = summaries.dash_top_ml(ml)
        found["ml_report_metrics"] = triage.ml_figures(ml)
    return found


def run_pipeline(
    spark: SparkSession,
    raw_path: str,
    table: str,
    out_dir: str,
    fmt: str = "csv",
    replace_files: bool = True,
    parse_mode: str = STRICT,
    skip_ml: bool = False,
    require_alerts: bool = False,
    limit_files: int | None = None,
    limit_rows: int | None = None,
    date_formats: Sequence[str] = (),
    multi_line: bool = False,
    enforce: bool = True,
    few_repeats: bool = False,
) -> RunRecord:
    """Run every stage over the dumps under ``raw_path``; raise if an assertion or a gate fails.

    ``table`` is the landed Parquet table, which may hold earlier dumps too: the
    reports cover all of it, the gates only the dumps of this run, empty ones
    included. Everything is written to ``out_dir`` before assertions are
    enforced; ``enforce=False`` only writes what they found. Intermediate tables
    are removed at the end. ``few_repeats`` (most bets have ids of their own) spares
    rows with unique ids the shuffle; it never changes a result.
    """
    tune(spark)
    with scratch(spark):
        return _run(
            spark, raw_path, table, out_dir, fmt, replace_files, parse_mode, skip_ml, require_alerts, limit_files,
            limit_rows, date_formats, multi_line, enforce, few_repeats,
        )


def _run(
    spark, raw_path, table, out_dir, fmt, replace_files, parse_mode, skip_ml, require_alerts, limit_files, limit_rows,
    date_formats, multi_line, enforce, few_repeats,
) -> RunRecord:
    dumps = landing.open_dumps(spark, raw_path, fmt, limit_files=limit_files, multi_line=multi_line)
    first_id = landing.next_ingestion_id(spark, table)
    incoming = landing.landing_scan(spark, limit_rows=limit_rows, first_id=first_id, dumps=dumps)
    files = cut(dumps.names(), "dumps")
    landing.land(incoming, table, replace_files, files)
    landed = landing.read_landed(spark, table)
    in_table = landed.groupBy("source_file").agg(F.count(F.lit(1)).alias("row_count"))
    counts = cut(files.join(in_table, "source_file", "left").fillna(0, ["row_count"]), "dump_rows")

    # Readers of this table take just the columns they need.
    last = landed.groupBy("source_file").agg(F.max("source_row_number").alias("_last"))
    staged = staging.stage_bets(landed, parse_mode, date_formats)
    keyed = cut(bets.key_bets(staged, last_positions=last, few_repeats=few_repeats), "bets")
    models = {
        "dim_customers": bets.dim_customers(keyed),
        "dim_events": bets.dim_events(keyed),
        "fct_bets": bets.fct_bets(keyed),
        "fct_payouts": bets.fct_payouts(keyed),
    }
    for name, model in models.items():
        model.write.mode("overwrite").parquet(f"{out_dir}/{name}")
    written = {name: spark.read.schema(model.schema).parquet(f"{out_dir}/{name}") for name, model in models.items()}

    reports = build_reports(keyed)
    outputs = {
        name: exports.export_report(name, getattr(reports, name), out_dir) for name in exports.EXPORTS
    }
    ml = None
    expected = exports.EXPORTS
    if not skip_ml:
        ml = cut(triage.ml_scores(reports.anomaly_scorecard), "ml_anomaly_scores")
        outputs["ml_anomaly_scores"] = exports.write_csv(
            triage.in_triage_order(ml), f"{out_dir}/ml_anomaly_scores.csv"
        )
        expected = gates.EXPECTED_OUTPUTS
    issues = quality.validation_issues(keyed)
    for name, figure in figures(reports, issues, ml).items():
        outputs[name] = exports.write_csv(figure, f"{out_dir}/{name}.csv")
    exports.write_csv(counts.orderBy("source_file"), f"{out_dir}/source_files.csv")

    broken = cut(
        assertions.run_assertions(
            {
                "raw": landed,
                "bets": keyed,
                **written,
                "validation_issues": issues,
                "validation_summary": quality.validation_summary(issues),
                "daily_reconciliation_summary": reports.daily_reconciliation_summary,
                "source_day_alerts": alerts.source_day_alerts(reports.daily_reconciliation_summary),
                "bookmaker_day_alerts": alerts.bookmaker_day_alerts(reports.daily_bookmaker_summary),
                "alert_feed": reports.alert_feed,
                "alert_summary": reports.alert_summary,
                "anomaly_scorecard": reports.anomaly_scorecard,
            }
        ),
        "assertions",
    )
    exports.write_csv(broken.orderBy("assertion"), f"{out_dir}/assertions.csv")

    checks = cut(
        gates.gate_checks(
            files,
            counts,
            gates.gate_anomaly_metrics(reports.anomaly_scorecard, files),
            gates.gate_alert_types(reports.alert_feed, files),
            None if ml is None else gates.gate_ml_metrics(ml, files),
            gates.output_inventory(spark, out_dir, outputs, expected),
            require_alerts,
        ),
        "gate_checks",
    )
    exports.write_csv(checks.orderBy("check", "subject"), f"{out_dir}/gate_checks.csv")
    gates.enforce_gate(checks)
    if enforce:
        assertions.enforce_assertions(broken)
    total = counts.agg(F.count(F.lit(1)).alias("files"), F.coalesce(F.sum("row_count"), F.lit(0)).alias("rows")).first()
    record = RunRecord(
        run_id=str(uuid4()),
        generated_at=datetime.now(timezone.utc).isoformat(timespec="seconds"),
        source_file_count=total.files,
        source_row_count=total.rows,
        output_rows=outputs,
        metrics=run_metrics(checks, reports, ml).first().asDict(),
        checks=checks.count(),
        assertions={r.assertion: r.violations for r in broken.where("violations > 0").collect()},
    )
    spark.createDataFrame([(json.dumps(asdict(record)),)], "value string").coalesce(1).write.mode(
        "overwrite"
    ).text(f"{out_dir}/run_record.json")
    return record
