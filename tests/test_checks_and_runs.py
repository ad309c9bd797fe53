import os

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tallyward.operators import alerts, assertions, gates, scorecard, summaries
from tallyward.plans import catalog, pipeline
from tallyward.sources import exports
from tallyward.sources.contract import HEADER_TO_COLUMN, TEXT_COLUMNS
from tests.demo import FILE, demo_raw

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def demo_dir(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("demo") / "in")
    headers = {c: h for h, c in HEADER_TO_COLUMN.items()}
    rows = demo_raw(spark).orderBy("source_row_number").select(
        F.lit(FILE).alias("source_file"), *[F.col(c).alias(headers[c]) for c in TEXT_COLUMNS]
    )
    rows.coalesce(1).write.partitionBy("source_file").option("header", True).csv(folder)
    return folder


def test_whole_run(spark, demo_dir, tmp_path):
    record = pipeline.run_pipeline(spark, demo_dir, str(tmp_path / "raw"), str(tmp_path / "out"), skip_ml=True)
    assert (record.source_file_count, record.source_row_count) == (1, 600) and record.assertions == {}
    assert record.metrics["max_anomaly_score"] == 95.25 and record.metrics["issue_row_count"] == 341
    assert {name: record.output_rows[name] for name in exports.EXPORTS} == {
        "daily_reconciliation_summary": 1, "daily_issue_summary": 5, "daily_bookmaker_summary": 1, "alert_feed": 4,
        "alert_summary": 4, "anomaly_scorecard": 1,
    }
    read = lambda name: spark.read.option("header", True).csv(str(tmp_path / "out" / f"{name}.csv"))
    assert {r.passed for r in read("gate_checks").collect()} == {"true"}
    assert [tuple(r) for r in read("source_files").collect()] == [(FILE, "600")]
    assert read("assertions").where("violations <> '0'").count() == 0 and read("assertions").count() > 40
    for name in ("eod_overview", "eod_risk_bands", "eod_top_anomalies", "dash_alert_mix", "dash_issue_mix"):
        assert read(name).count() == record.output_rows[name] > 0
    for name in ("dim_customers", "dim_events", "fct_bets", "fct_payouts"):
        assert spark.read.parquet(str(tmp_path / "out" / name)).count() > 0
    assert os.path.isdir(str(tmp_path / "out" / "run_record.json"))
    # A rerun replaces the dump instead of doubling it.
    again = pipeline.run_pipeline(spark, demo_dir, str(tmp_path / "raw"), str(tmp_path / "out"), require_alerts=True)
    assert again.source_row_count == 600 and again.output_rows["ml_anomaly_scores"] == 1
    feed = exports.read_artifact(
        spark, str(tmp_path / "out" / "alert_feed.csv"), ", ".join(f"{c} string" for c in alerts.ALERT_COLUMNS)
    )
    assert feed.count() == 4


def test_gate_lists_every_failure(spark, tmp_path):
    assert exports.write_csv(spark.sql("select 1 as a where false"), str(tmp_path / "alert_feed.csv")) == 0
    counts = spark.createDataFrame([("a.csv", 5)], "source_file string, row_count long")
    card = spark.createDataFrame([("a.csv", 20.0, "low")], "source_file string, anomaly_score double, risk_band string")
    feed = spark.createDataFrame([("a.csv", "duplicate_ratio_spike")], "source_file string, alert_type string")
    ml = spark.createDataFrame(
        [("a.csv", 91.5, False), ("b.csv", 99.0, True)],
        "source_file string, ml_anomaly_score double, model_outlier_flag boolean",
    )
    metrics = gates.gate_ml_metrics(ml, ["a.csv"])
    assert tuple(metrics.first()) == (1, 0, 91.5)
    checks = gates.gate_checks(
        ["a.csv", "gone.csv"], counts, gates.gate_anomaly_metrics(card, ["a.csv"]),
        gates.gate_alert_types(feed, ["a.csv"]), metrics,
        gates.output_inventory(spark, str(tmp_path), {"alert_feed": 0}, ["alert_feed", "alert_summary"]), require_alerts=True,
    )
    failed = {(r.check, r.subject) for r in gates.gate_failures(checks).collect()}
    assert failed == {
        ("raw_rows_loaded", "gone.csv"), ("output_complete", "alert_summary"),
        ("expected_alert_type", "negative_stake_spike"), ("expected_alert_type", "loss_day_payout_ratio"),
        ("critical_anomaly", "anomaly_scorecard"), ("ml_outlier", "ml_anomaly_scores"),
    }
    with pytest.raises(gates.QualityGateError, match="gone.csv"):
        gates.enforce_gate(checks)


def test_no_files_fails_the_gate(spark):
    checks = gates.gate_checks(
        [], spark.createDataFrame([], "source_file string, row_count long"),
        spark.sql("select 0 as anomaly_row_count, 0 as critical_anomaly_count"),
        spark.createDataFrame([], "alert_type string"),
    )
    assert {r.check for r in gates.gate_failures(checks).collect()} == {"source_files_present", "scorecard_rows"}


def test_default_invariants_hold(spark):
    recon = catalog.recon(spark, SF).where(F.col("report_date").isNotNull()).cache()
    books = catalog.bookmakers(spark, SF).where(F.col("report_date").isNotNull()).cache()
    # Low thresholds, so that the smallest tables raise alerts of every kind.
    from dataclasses import replace

    loud = [
        tuple(replace(r, minimums=tuple((c, 1) for c, _ in r.minimums)) for r in rules)
        for rules in (alerts.SOURCE_RULES, alerts.BOOKMAKER_RULES)
    ]
    source = alerts.source_day_alerts(recon, loud[0]).cache()
    book = alerts.bookmaker_day_alerts(books.where("bookmaker_name is not null"), loud[1]).cache()
    feed = source.unionByName(book)
    card = scorecard.anomaly_scorecard(recon)
    assert source.select("alert_type").distinct().count() == 3 and book.count() > 0
    for violations in (
        assertions.assert_alert_scope(feed),
        assertions.assert_summary_matches_feed(feed, alerts.alert_summary(feed)),
        assertions.assert_risk_band(card),
        assertions.assert_score_bounds(card),
        assertions.assert_components_sum(card),
        assertions.assert_source_thresholds(source, loud[0]),
        assertions.assert_bookmaker_thresholds(book, loud[1]),
        assertions.assert_reconciliation_counts(recon),
        assertions.assert_reconciliation_status(recon),
        assertions.assert_unique(feed, "alert_id"),
        assertions.assert_unique(card, "anomaly_id"),
        assertions.assert_not_null(card, "risk_band"),
        assertions.assert_accepted_values(card, "risk_band"),
    ):
        assert violations.count() == 0
    assert assertions.assert_source_thresholds(source).count() > 0
    assert assertions.assert_bookmaker_thresholds(book).count() > 0
    broken = card.withColumn("risk_band", F.lit("odd")).withColumn("anomaly_score", F.lit(101).cast("decimal(6,2)"))
    assert assertions.assert_risk_band(broken).count() == card.count()
    assert assertions.assert_score_bounds(broken).count() == card.count()
    assert assertions.assert_components_sum(broken).count() == card.count()
    flipped = feed.withColumn("alert_scope", F.lit("other"))
    assert assertions.assert_alert_scope(flipped).count() == feed.count()
    assert assertions.assert_reconciliation_status(recon.withColumn("reconciliation_status", F.lit("x"))).count() > 0
    assert assertions.assert_reconciliation_counts(recon.withColumn("total_bet_rows", F.lit(0))).count() > 0


def test_column_counts_equal_the_single_assertions_in_one_scan(spark, tmp_path):
    rows = [(1, "a", None), (1, "b", None), (2, "a", ""), (None, "a", ""), (3, None, "x"), (None, None, "1"), (4, "1", "y")]
    spark.createDataFrame(rows, "n long, s string, t string").write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    got = assertions.column_counts("t", df, ["n", "s", "t"], ["n", "s", "t"])
    counts = {r.assertion: r.violations for r in got.collect()}
    assert counts == {
        **{f"not_null t.{c}": assertions.assert_not_null(df, c).count() for c in df.columns},
        **{f"unique t.{c}": assertions.assert_unique(df, c).count() for c in df.columns},
    }
    assert counts["not_null t.n"] == 2 and counts["unique t.s"] == 1 and counts["unique t.t"] == 1
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") == 1
    empty = {r.violations for r in assertions.column_counts("t", df.limit(0), ["n"], ["s"]).collect()}
    assert empty == {0}


def test_dashboard_figures(spark):
    recon = spark.sql("select 600L as total_bet_rows, 60088.00 as total_stake_amount, 94670.40 as total_payout_amount, -34582.40 as net_revenue_amount, 'review' as reconciliation_status")
    card = spark.sql("select 95.25 as anomaly_score, 'critical' as risk_band")
    feed = spark.sql("select * from values ('critical', 'loss'), ('high', 'dup'), ('odd', 'z'), ('high', 'a') as t(severity, alert_type)")
    ml = spark.sql("select 100.0D as ml_anomaly_score, true as model_outlier_flag")
    row = summaries.dash_kpis(recon, card, feed, ml).first()
    assert (row.source_day_count, row.total_bet_rows, row.review_source_day_count, row.alert_count) == (1, 600, 1, 4)
    assert (row.high_risk_source_day_count, row.ml_outlier_count, row.max_rule_score, row.max_ml_score) == (1, 1, 95.25, 100.0)
    assert [(r.severity, r.alert_type) for r in summaries.dash_alert_mix(feed).collect()] == [
        ("critical", "loss"), ("high", "a"), ("high", "dup"), ("odd", "z"),
    ]
    empty = summaries.dash_kpis(recon.limit(0), card.limit(0), feed.limit(0), ml.limit(0)).first()
    assert set(empty.asDict().values()) == {0}


def test_missing_artifact_is_empty(spark, tmp_path):
    assert exports.read_artifact(spark, str(tmp_path / "none.csv"), "a string").count() == 0


def test_export_round_trip_and_order(spark, tmp_path):
    feed = spark.sql(
        """select date'2026-03-01' as report_date, 'source_day' as alert_scope, s as severity, 't' as alert_type,
        'f' as source_file, cast(null as string) as bookmaker_name
        from values ('critical'), ('medium'), ('high') as v(s)"""
    )
    assert exports.export_report("alert_feed", feed, str(tmp_path)) == 3
    back = exports.read_artifact(spark, str(tmp_path / "alert_feed.csv"), feed.schema)
    assert [r.severity for r in back.collect()] == ["medium", "high", "critical"]


def test_every_answer_has_a_query():
    names = entry.queries()
    assert set(entry.oracle_sql()) <= set(names)
    # Only what SQL can't express is without: fitted models and tokenizers, tested against brute force.
    assert {n for n in set(names) - set(entry.oracle_sql()) if not n.startswith("op")} <= {"pipeline"}


@pytest.mark.parametrize("name", ["fct_bets", "validation_issues", "anomaly_scorecard", "daily_bookmaker_summary"])
def test_against_duckdb(spark, name):
    db = duckdb.connect()
    db.execute(f"create view lineitem as select * from read_parquet('{SF}/lineitem.parquet')")
    df = entry.queries()[name](spark, SF)
    result = db.execute(entry.oracle_sql()[name])
    names = [d[0] for d in result.description]
    order = sorted(names)
    assert sorted(df.columns) == order
    expected = sorted((str([r[names.index(c)] for c in order]) for r in result.fetchall()))
    got = sorted(str([r[c] for c in order]) for r in df.collect())
    assert got == expected


def clean_dump(folder, name, rows):
    os.makedirs(folder, exist_ok=True)
    cells = {"REFID": "r", "UUID": "u", "Ticket No": "t", "Bookmaker": "BM", "Bet Date": "2026-03-01", "Bet Time": "10:00:00",
             "Event Date": "2026-03-01", "Event Time": "12:00:00", "Bet Amount Win": "10.00", "Win Payout Amount": "0"}
    with open(f"{folder}/{name}", "w") as out:
        out.write(",".join(cells) + "\n")
        for k in range(rows):
            out.write(",".join(v + str(k) if h in ("REFID", "UUID", "Ticket No") else v for h, v in cells.items()) + "\n")


def test_a_clean_run_passes_and_an_empty_dump_does_not(spark, tmp_path):
    raw, table, out = (str(tmp_path / n) for n in ("in", "raw", "out"))
    clean_dump(raw, "a.csv", 5)
    clean_dump(raw, "b.csv", 3)
    record = pipeline.run_pipeline(spark, raw, table, out, skip_ml=True)
    assert record.output_rows["alert_feed"] == record.output_rows["daily_issue_summary"] == 0
    assert record.source_row_count == 8 and exports.exported_size(spark, f"{out}/alert_feed.csv") > 0
    # Intermediate tables are gone.
    root = spark.conf.get("spark.checkpoint.dir")
    assert not [d for d in os.listdir(f"{root}/tallyward") if d.startswith("run-")]
    clean_dump(raw, "b.csv", 0)
    with pytest.raises(gates.QualityGateError, match="raw_rows_loaded failed for b.csv"):
        pipeline.run_pipeline(spark, raw, table, out, skip_ml=True)
    with open(f"{raw}/b.csv", "w") as file:
        file.write("REFID,UUID,Bet Date\nr,,2026-03-01\n")
    with pytest.raises(assertions.AssertionsError, match="not_null raw.source_uuid: 1 rows"):
        pipeline.run_pipeline(spark, raw, table, out, skip_ml=True)
    record = pipeline.run_pipeline(spark, raw, table, out, skip_ml=True, enforce=False, replace_files=False)
    assert record.assertions["not_null raw.source_uuid"] == 2 and "unique raw.ingestion_id" not in record.assertions
