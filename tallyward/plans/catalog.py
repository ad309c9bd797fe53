"""Every operator as a query over a folder of benchmark tables.

Each query starts from ``lineitem`` (presented as a dirty bet dump) and runs its
whole lineage; queries on the landing operators first have Spark write that dump
as CSV into the shared folder and then read it back through the landing scan.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyward.functions import keys as K
from tallyward.functions import parsing as P
from tallyward.functions.bands import BAND_FLOORS
from tallyward.operators import alerts as A
from tallyward.operators import assertions as X
from tallyward.operators import bets as B
from tallyward.operators import gates as G
from tallyward.operators import quality as Q
from tallyward.operators import reconcile as R
from tallyward.operators import scorecard as S
from tallyward.operators import forest, staging, summaries, triage
from tallyward.operators.quantiles import exact_quantiles
from tallyward.plans import pipeline, refresh
from tallyward.session import tune
from tallyward.sources import exports, landing
from tallyward.sources.contract import HEADER_TO_COLUMN, TEXT_COLUMNS
from tallyward.sources.lineitem_dump import blank_position, lineitem_in_order, lineitem_raw, rounds_of_dumps, write_dumps
from tallyward.sources.shared import cut, new_folder, scratch, shuffles_dropped

# Tasks that line items are dealt to before the text work; bench.py sets it, as its table is a single row group.
SPREAD: int | None = None
ROW = ["source_file", "source_row_number"]
DAY = ["source_file", "report_date"]
FILES = ["dump_A.csv", "dump_N.csv"]
Query = Callable[[SparkSession, str], DataFrame]


def plain(df: DataFrame) -> DataFrame:
    """Columns in types every engine prints alike: money as double, days and flags as text."""

    def cast(field):
        kind = field.dataType.simpleString()
        column = F.col(f"`{field.name}`")
        if kind.startswith("decimal") or kind == "float":
            return column.cast("double").alias(field.name)
        if kind in ("date", "boolean"):
            return column.cast("string").alias(field.name)
        if kind.startswith("timestamp"):
            return F.date_format(column, "yyyy-MM-dd HH:mm:ss").alias(field.name)
        if kind in ("tinyint", "smallint", "int"):
            return column.cast("bigint").alias(field.name)
        return column

    return df.select(*[cast(f) for f in df.schema.fields])


# --- shared stages ---------------------------------------------------------------


def staged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.stage_bets(lineitem_raw(spark, sf_dir, spread=SPREAD))


def keyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return B.key_bets(staged(spark, sf_dir))


def recon(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.daily_reconciliation_summary(keyed(spark, sf_dir))


def bookmakers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.daily_bookmaker_summary(keyed(spark, sf_dir))


def issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.validation_issues(keyed(spark, sf_dir))


def feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both summaries read one narrow table of keyed bets."""
    bets = pipeline.report_bets(staged(spark, sf_dir))
    return A.alert_feed(R.daily_reconciliation_summary(bets), R.daily_bookmaker_summary(bets))


def card(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.anomaly_scorecard(recon(spark, sf_dir))


def issue_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.daily_issue_summary(issues(spark, sf_dir))


def reloaded(spark: SparkSession, sf_dir: str) -> pipeline.Reports:
    """Reports kept up to date: dump_A was first landed with other stakes and bookmakers, then reloaded."""
    rows = lineitem_raw(spark, sf_dir, spread=SPREAD)
    table, partials = new_folder(spark, "landed"), new_folder(spark, "day_partials")
    wrong = F.col("source_file") == "dump_A.csv"
    earlier = {c: F.when(wrong, F.lit(v)).otherwise(F.col(c)) for c, v in (("bet_amount_win", "$1.00"), ("bookmaker", "Earlier"))}
    landing.land(rows.withColumns(earlier), table)
    refresh.refresh_reports(spark, table, partials)
    landing.land(rows.where(wrong), table)
    return refresh.refresh_reports(spark, table, partials, rows.where(wrong).select("source_file").distinct())


def of(stage: Query, operator: Callable[[DataFrame], DataFrame] = lambda df: df) -> Query:
    return lambda spark, sf_dir: operator(stage(spark, sf_dir))


def staged_columns(*names: str) -> Query:
    return of(staged, lambda df: df.select(*ROW, *names))


def keyed_columns(*names: str) -> Query:
    return of(keyed, lambda df: df.select(*ROW, *names))


# --- landing ---------------------------------------------------------------------

# Rows of the dumps that lie as plain text at once, unless a single dump has more.
ROUND_ROWS = 1 << 24
# Part files the written dumps have at least; more for larger tables.
DUMP_PARTS = 8
_DUMPS: dict[tuple[str, str], str] = {}


def dumps(spark: SparkSession, sf_dir: str) -> str:
    """Folder of CSV dumps written from the tables, once per application and input."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _DUMPS:
        _DUMPS[key] = write_dumps(lineitem_in_order(spark, sf_dir, DUMP_PARTS), new_folder(spark, "dumps"), "gzip")
    return _DUMPS[key]


def landed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return landing.landing_scan(spark, dumps(spark, sf_dir), with_raw_payload=False)


LANDED = [*ROW, "source_sheet", "refid", "source_uuid", "ticket_no", "bookmaker", "bet_date", "bet_time",
          "race_number", "bet_amount_win"]


def header_contract_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark, "dumps_with_unknown_header")
    (
        lineitem_raw(spark, sf_dir)
        .select(
            "source_file",
            F.col("refid").alias("REFID"),
            F.col("bookmaker").alias(" Bookmaker "),
            F.col("venue").alias("Unexpected Column"),
        )
        .write.partitionBy("source_file")
        .option("header", True)
        .csv(folder)
    )
    return landing.check_headers(landing.dump_headers(spark, folder))


def header_contract_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columnar dumps, of which one file has a column beyond the contract: its dump alone is named."""
    folder = new_folder(spark, "columnar_dumps")
    raw = lineitem_raw(spark, sf_dir).select("source_file", F.col("refid").alias("REFID"), F.col("venue").alias("Unexpected Column"))
    raw.drop("Unexpected Column").write.partitionBy("source_file").parquet(folder)
    raw.where("source_file = 'dump_R.csv'").drop("source_file").write.mode("append").parquet(f"{folder}/source_file=dump_R.csv")
    return landing.check_headers(landing.dump_headers(spark, folder, "parquet"))


def landing_multi_line(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dumps in which every row has line breaks, quotes and separators inside a cell."""
    said = F.concat(F.lit("Row "), F.trim("refid"), F.lit('\n"of", '), F.col("source_file"), F.lit("\n\nends"))
    found, landed_rows = new_folder(spark, "multi_line_rows"), None
    # Some dumps at a time, whose files go once they are landed: as text, dumps are many times their table.
    for names in rounds_of_dumps(spark, sf_dir, ROUND_ROWS) or [[]]:
        with scratch(spark), shuffles_dropped(spark):
            rows = lineitem_in_order(spark, sf_dir, DUMP_PARTS, names).withColumn("bet_details", said)
            # Not compressed, so that files are read in splits, and rows reach over their borders.
            folder = write_dumps(rows, new_folder(spark, "multi_line"))
            landed_rows = landing.landing_scan(spark, folder, multi_line=True, with_raw_payload=False).select(*ROW, "refid", "bet_details")
            landed_rows.write.mode("append").parquet(found)
    return spark.read.schema(landed_rows.schema).parquet(found)


def header_rename(spark: SparkSession, sf_dir: str) -> DataFrame:
    headers = {column: header for header, column in HEADER_TO_COLUMN.items()}
    dump = lineitem_raw(spark, sf_dir).withColumnsRenamed(headers)
    return landing.rename_headers(dump).select(*ROW, F.lit("BM").alias("prefix"), "bookmaker", "venue")


def cell_to_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(
        "l_orderkey",
        "l_linenumber",
        F.col("l_shipdate").alias("ship_text"),
        F.col("l_shipdate").cast("date").alias("day_text"),
        (F.col("l_quantity") > 25).alias("big_text"),
        F.concat(F.lit("  "), F.col("l_returnflag"), F.lit(" $1,000.00\t ")).alias("padded_text"),
        F.col("l_partkey").alias("part_text"),
    )
    return landing.cells_to_text(cells, [c for c in cells.columns if c.endswith("_text")])


def drop_blank_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = lineitem_raw(spark, sf_dir)
    blanked = raw.select(*ROW, *[F.when(~blank_position(), F.col(c)).alias(c) for c in TEXT_COLUMNS])
    return landing.drop_blank_rows(blanked, TEXT_COLUMNS).select(*ROW)


def raw_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["refid", "source_uuid", "bookmaker", "bet_date", "ticket_no", "race_number", "bet_amount_win"]
    headers = {column: header for header, column in HEADER_TO_COLUMN.items()}
    # The scan's own payload, of which the answer spells out some cells.
    scan = landing.landing_scan(spark, dumps(spark, sf_dir))
    cells = F.from_json("raw_payload", "map<string,string>")
    some = F.struct(*[F.col("_cells")[headers[c]].alias(headers[c]) for c in columns])
    whole = F.raise_error(F.lit("a payload must name every header of its dump")).cast("string")
    text = F.when(F.size("_cells") == len(HEADER_TO_COLUMN), F.to_json(some, {"ignoreNullFields": "false"})).otherwise(whole)
    return scan.withColumn("_cells", cells).select(*ROW, text.alias("raw_payload"))


def landing_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = new_folder(spark, "landed")
    # The same files twice: listed, and gone over for their places, once.
    found = landing.open_dumps(spark, dumps(spark, sf_dir))
    landing.land(landing.landing_scan(spark, dumps=found, with_raw_payload=False), table, replace_files=False)
    first = landing.next_ingestion_id(spark, table)
    again = landing.landing_scan(spark, dumps=found, first_id=first, with_raw_payload=False)
    landing.land(again, table, replace_files=False)
    rows = landing.read_landed(spark, table)
    return rows.groupBy("source_file").agg(F.count_distinct("ingestion_id").alias("row_count"))


def landing_replace_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = new_folder(spark, "landed")
    rows = landed(spark, sf_dir)
    landing.land(rows, table)
    landing.land(rows.where(F.col("source_file").isin(FILES)), table)
    # Loaded again after it lost all its rows: a dump then has none, and new ids start above the old ones.
    emptied = spark.createDataFrame([("dump_R.csv",), ("dump_A.csv",)], "source_file string")
    first = landing.next_ingestion_id(spark, table)
    again = rows.where("source_file = 'dump_A.csv'").withColumn("ingestion_id", F.col("ingestion_id") + first)
    landing.land(again, table, names=emptied)
    stored = landing.read_landed(spark, table)
    return stored.groupBy("source_file").agg(F.count(F.lit(1)).alias("row_count"), F.count_distinct("ingestion_id").alias("id_count"))


def landing_replace_by_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = landed(spark, sf_dir).select(*ROW)
    first = rows.withColumn("load", F.lit("first"))
    second = rows.where(F.col("source_file").isin(FILES)).withColumn("load", F.lit("second"))
    return landing.replace_by_file(first, second)


def landing_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    profile = landing.landing_profile(landed(spark, sf_dir))
    # The sample's first field is enough to tell which row it came from.
    return profile.select(
        "source_file", "source_sheet", "row_count", F.substring_index("sample", ",", 1).alias("sample_start")
    )


LANDING: dict[str, Query] = {
    "landing_scan": of(landed, lambda df: df.select(*LANDED)),
    "header_contract_check": header_contract_check,
    "header_contract_parquet": header_contract_parquet,
    "landing_multi_line": landing_multi_line,
    "header_rename": header_rename,
    "cell_to_text": cell_to_text,
    "drop_blank_rows": drop_blank_rows,
    "raw_payload": raw_payload,
    "landing_append": landing_append,
    "landing_replace_by_file": landing_replace_by_file,
    "landing_replace_write": landing_replace_write,
    "landing_limit_files": of(landed, lambda df: landing.limit_to_files(df, 2).select(*ROW, "refid")),
    "landing_limit_rows": of(landed, lambda df: landing.limit_to_rows(df, 50).select(*ROW, "refid")),
    "landing_profile": landing_profile,
    "landing_row_counts": of(landed, lambda df: landing.landing_row_counts(df, FILES)),
}

# --- parsing, keys, models ---------------------------------------------------------

PARSING: dict[str, Query] = {
    "clean_text": staged_columns("source_refid", "source_uuid", "event_category", "customer_name", "bet_information"),
    "parse_money": staged_columns("stake_win_amount", "stake_place_amount", "win_payout_amount", "place_payout_amount"),
    "parse_decimal": staged_columns(*[out for out, kind, *_ in staging.STAGING_RULES if kind == "decimal"]),
    "parse_integer": staged_columns("race_number", "runner_number", "placing"),
    "parse_boolean_flag": staged_columns("is_cancelled", "is_betback", "is_refunded"),
    "parse_source_timestamp": staged_columns("bet_placed_at", "event_scheduled_at", "cancelled_at"),
    "normalize_customer_name": of(
        staged,
        lambda df: df.select(
            *ROW, P.normalize_customer_name(F.col("customer_name")).alias("customer_name_normalized")
        ),
    ),
    "stage_bets": of(staged, lambda df: df.drop("raw_payload")),
    "stage_flags": staged_columns("missing_refid_flag", "missing_stake_flag", "negative_stake_flag"),
    "stage_totals": staged_columns("total_stake_amount", "total_payout_amount"),
    **{name: of(staged, lambda df, n=name: B.with_surrogate_keys(df).select(*ROW, n))
       for name in ("bet_record_key", "bet_business_key", "event_key", "customer_key", "selection_key")},
    "duplicate_rank": keyed_columns("duplicate_rank"),
    "is_duplicate_bet_key": keyed_columns("is_duplicate_bet_key"),
    "payout_record_key": of(
        staged,
        lambda df: B.with_surrogate_keys(df)
        .where(F.col("total_payout_amount") != 0)
        .select(*ROW, K.payout_record_key().alias("payout_record_key")),
    ),
    "alert_id": of(
        feed,
        lambda df: df.select("alert_scope", "alert_type", "report_date", "source_file", "bookmaker_name", "alert_id"),
    ),
    "anomaly_id": of(card, lambda df: df.select(*DAY, "anomaly_id")),
    "ml_score_id": of(
        recon, lambda df: df.select(*DAY, K.ml_score_id(triage.MODEL_NAME).alias("ml_score_id"))
    ),
}

MODELS: dict[str, Query] = {
    "dim_customers": of(staged, B.dim_customers),
    "dim_events": of(staged, B.dim_events),
    "fct_bets_filtered": of(staged, lambda df: B.fct_bets(B.key_bets(df, few_repeats=True)).drop("raw_payload")),
    # Facts are wide: only rows whose key may repeat are shuffled, and spilled, with all their columns.
    "fct_bets": of(staged, lambda df: B.fct_bets(B.key_bets(df, few_repeats=True)).drop("raw_payload")),
    "fct_payouts": of(keyed, B.fct_payouts),
}

# --- checks, reconciliation, alerts, score -------------------------------------------

QUALITY: dict[str, Query] = {
    **{f"issue_{name}": of(keyed, lambda df, n=name: Q.issues_of(df, n)) for name in Q.ISSUE_TYPES},
    "validation_issues": issues,
    "validation_summary": of(issues, Q.validation_summary),
}

RECONCILE: dict[str, Query] = {
    "daily_issue_summary": issue_days,
    "daily_bets_agg": of(keyed, R.daily_bets_agg),
    "duplicate_groups": of(keyed, R.duplicate_groups),
    "issue_counts_pivot": of(issue_days, R.issue_counts_pivot),
    "daily_reconciliation_summary": recon,
    "daily_bookmaker_summary": bookmakers,
    "reconciliation_after_reload": lambda spark, sf_dir: reloaded(spark, sf_dir).daily_reconciliation_summary,
    "bookmakers_after_reload": lambda spark, sf_dir: reloaded(spark, sf_dir).daily_bookmaker_summary,
}

ALERTS: dict[str, Query] = {
    **{f"alert_{rule.name}": of(of(recon, A.source_day_alerts), lambda df, n=rule.name: A.alerts_of(df, n))
       for rule in A.SOURCE_RULES},
    **{f"alert_{rule.name}": of(of(bookmakers, A.bookmaker_day_alerts), lambda df, n=rule.name: A.alerts_of(df, n))
       for rule in A.BOOKMAKER_RULES},
    "source_metrics": of(recon, A.source_metrics),
    "bookmaker_metrics": of(bookmakers, A.bookmaker_metrics),
    "source_day_alerts": of(recon, A.source_day_alerts),
    "bookmaker_day_alerts": of(bookmakers, A.bookmaker_day_alerts),
    "alert_feed": feed,
    "alert_summary": of(feed, A.alert_summary),
}


def score_base_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = S.score_base_metrics(recon(spark, sf_dir))
    return base.select(*[c for c in S.SCORECARD_COLUMNS if c in base.columns])


SCORECARD: dict[str, Query] = {
    # Days without a date belong to no source-day.
    "alert_counts_by_source_day": of(of(recon, A.source_day_alerts), S.alert_counts_by_source_day),
    "score_base_metrics": score_base_metrics,
    "score_components": of(
        recon,
        lambda df: S.score_components(S.score_base_metrics(df)).select(*DAY, *[c for c, _, _ in S.COMPONENTS]),
    ),
    **{name: of(card, lambda df, n=name: df.select(*DAY, n))
       for name in ("anomaly_score", "risk_band", "primary_driver", "recommended_action")},
    "anomaly_scorecard": card,
}

# --- triage ----------------------------------------------------------------------


def features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return triage.with_features(card(spark, sf_dir))


def features_cut(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = cut(card(spark, sf_dir).select(*triage.ML_INPUT_COLUMNS), "ml_input")
    return triage.with_features(rows)


def rule_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The verdict on known scores and known predictions: min-max of the rule score, and every third volume an outlier."""
    scored = triage.small_batch_scores(features_cut(spark, sf_dir))
    return triage.with_ml_verdict(scored.withColumn("predicted_outlier", F.col("total_bet_rows") % 3 == 0))


def rounded_features(df: DataFrame) -> DataFrame:
    # Adding 0.0 turns a rounded -0.0 into 0.0.
    return df.select(*DAY, *[(F.round(c, 6) + F.lit(0.0)).alias(c) for c in triage.FEATURE_COLUMNS])


def forest_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node of the forest."""
    rows = features_cut(spark, sf_dir)
    nodes = forest.fit_forest(rows, rows.count(), triage.FOREST_KEY, triage.FEATURE_COLUMNS, triage.TREES, triage.SUBSAMPLE, triage.SEED)
    # Logarithms of two libraries differ in their last digits.
    return nodes.select("tree", "node", "depth", "rows", "feature", *[F.round(c, 6).alias(c) for c in ("threshold", "path")])


def forest_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = features_cut(spark, sf_dir)
    return triage.isolation_scores(rows, rows.count()).select(*DAY, "ml_anomaly_score", "predicted_outlier")


def ml_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return triage.ml_scores(card(spark, sf_dir))


def ml_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    figures = triage.ml_figures(cut(ml_scores(spark, sf_dir), "ml_scores"))
    listed = F.from_json("top_rows", "array<struct<ml_score_id: string, ml_anomaly_score: double>>")
    return figures.select(
        "row_count", "outlier_count", "max_ml_anomaly_score",
        F.to_json(listed).alias("top_rows"),
    )


def amount_quantiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    amounts = staged(spark, sf_dir).select(
        F.col("total_stake_amount").cast("double").alias("stake"),
        F.col("total_payout_amount").cast("double").alias("payout"),
    )
    wanted = [(f"{c}_{int(100 * q)}", c, q) for c in ("stake", "payout") for q in (0.5, 0.95)]
    return exact_quantiles(amounts, wanted).select(*[F.round(name, 6).alias(name) for name, _, _ in wanted])


TRIAGE: dict[str, Query] = {
    "ml_feature_rows": of(card, triage.ml_feature_rows),
    "ml_features": of(features, rounded_features),
    "standard_scaler": of(features_cut, lambda df: rounded_features(triage.standard_scaler(df))),
    "isolation_forest_fit": forest_fit,
    "isolation_forest_score": forest_score,
    "ml_normalize_scores": of(
        features_cut,
        lambda df: triage.normalize_scores(df, "f_anomaly_score", "anomaly_score", "ml_anomaly_score").select(
            *DAY, "ml_anomaly_score"
        ),
    ),
    "ml_small_batch": of(
        features_cut, lambda df: triage.small_batch_scores(df).select(*DAY, "ml_anomaly_score", "predicted_outlier")
    ),
    "ml_risk_band": of(rule_only, lambda df: df.select(*DAY, "ml_risk_band")),
    "ml_robust_driver": of(features_cut, lambda df: triage.robust_drivers(df).select(*DAY, "model_driver")),
    "ml_outlier_flag": of(rule_only, lambda df: df.select(*DAY, "model_outlier_flag")),
    "ml_recommended_action": of(rule_only, lambda df: df.select(*DAY, "recommended_action")),
    "ml_scores": ml_scores,
    "ml_report_metrics": ml_report,
    "exact_quantile": amount_quantiles,
}

# --- summaries, exports ------------------------------------------------------------


def report_tables(spark: SparkSession, sf_dir: str) -> pipeline.Reports:
    return pipeline.build_reports(pipeline.report_bets(staged(spark, sf_dir)))


def eod_overview(spark: SparkSession, sf_dir: str) -> DataFrame:
    reports = report_tables(spark, sf_dir)
    return summaries.eod_overview(reports.anomaly_scorecard, reports.alert_feed, reports.daily_issue_summary)


def dash_kpis(spark: SparkSession, sf_dir: str) -> DataFrame:
    reports = report_tables(spark, sf_dir)
    ml = cut(triage.ml_scores(reports.anomaly_scorecard), "ml_scores")
    return summaries.dash_kpis(reports.daily_reconciliation_summary, reports.anomaly_scorecard, reports.alert_feed, ml)


def csv_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = card(spark, sf_dir)
    folder = new_folder(spark, "exports")
    written = exports.export_report("anomaly_scorecard", report, folder)
    back = exports.read_artifact(spark, f"{folder}/anomaly_scorecard.csv", report.schema)
    return back.withColumn("rows_written", F.lit(written).cast("long"))


def ml_scores_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = ml_scores(spark, sf_dir)
    folder = f"{new_folder(spark, 'exports')}/ml_anomaly_scores.csv"
    exports.write_csv(scores, folder)
    return exports.read_artifact(spark, folder, scores.schema)


def artifact_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = card(spark, sf_dir)
    folder = new_folder(spark, "exports")
    exports.export_report("anomaly_scorecard", report, folder)

    def rows(artifact: str, name: str) -> DataFrame:
        return exports.read_artifact(spark, f"{folder}/{name}.csv", report.schema).agg(
            F.lit(artifact).alias("artifact"), F.count(F.lit(1)).alias("row_count")
        )

    return rows("present", "anomaly_scorecard").unionByName(rows("missing", "alert_feed"))


def exported(report: str, stage: Query) -> Query:
    return of(stage, lambda df: exports.sorted_for_export(report, df))


SUMMARIES: dict[str, Query] = {
    "eod_overview": eod_overview,
    "eod_risk_bands": of(card, summaries.eod_risk_bands),
    "eod_top_anomalies": of(card, summaries.eod_top_anomalies),
    "eod_alert_summary": of(feed, summaries.eod_alert_summary),
    "eod_quality_issues": of(issues, summaries.eod_quality_issues),
    "dash_kpis": dash_kpis,
    "dash_top_anomalies": of(card, summaries.dash_top_anomalies),
    "dash_top_ml": of(ml_scores, summaries.dash_top_ml),
    "dash_alert_mix": of(feed, summaries.dash_alert_mix),
    "dash_issue_mix": of(issue_days, summaries.dash_issue_mix),
    "export_daily_reconciliation": exported("daily_reconciliation_summary", recon),
    "export_daily_issues": exported("daily_issue_summary", issue_days),
    "export_daily_bookmaker": exported("daily_bookmaker_summary", bookmakers),
    "export_alert_feed": exported("alert_feed", feed),
    "export_alert_summary": exported("alert_summary", of(feed, A.alert_summary)),
    "export_scorecard": exported("anomaly_scorecard", card),
    "csv_sink": csv_sink,
    "ml_scores_sink": ml_scores_sink,
    "artifact_scan": artifact_scan,
}

# --- assertions, gates -------------------------------------------------------------
# Where the data satisfies an invariant, the query asserts a narrower one, so that
# violations show up and can be compared.


def narrowed(rules: tuple[A.AlertRule, ...], name: str, critical: str) -> tuple[A.AlertRule, ...]:
    """The rules with the critical step of one of them out of reach."""
    return tuple(replace(r, steps=(("critical", critical), *r.steps[1:])) if r.name == name else r for r in rules)


def summary_mismatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    reports = report_tables(spark, sf_dir)
    summary = A.alert_summary(reports.alert_feed.where(F.col("alert_scope") == A.SOURCE_SCOPE))
    return X.assert_summary_matches_feed(reports.alert_feed, summary)


def gate_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    reports = report_tables(spark, sf_dir)
    files = [*FILES, "dump_missing.csv"]
    counts = reports.daily_reconciliation_summary.groupBy("source_file").agg(
        F.sum("total_bet_rows").alias("row_count")
    )
    everything = [*files, "dump_R.csv"]
    return G.gate_checks(
        files,
        counts,
        G.gate_anomaly_metrics(reports.anomaly_scorecard, everything),
        G.gate_alert_types(reports.alert_feed, everything),
        require_alerts=True,
    ).unionByName(
        G.gate_checks(
            ["dump_R.csv"],
            counts,
            G.gate_anomaly_metrics(reports.anomaly_scorecard, everything),
            G.gate_alert_types(reports.alert_feed, everything),
        ).where(F.col("check") == "raw_rows_loaded")
    )


def output_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    reports = report_tables(spark, sf_dir)
    folder = new_folder(spark, "exports")
    found = {
        name: exports.export_report(name, getattr(reports, name), folder)
        for name in ("anomaly_scorecard", "alert_feed")
    }
    # No issues at all: a header and no rows, which is complete.
    found["daily_issue_summary"] = exports.export_report("daily_issue_summary", reports.daily_issue_summary.limit(0), folder)
    return G.output_inventory(spark, folder, found, ["anomaly_scorecard", "alert_feed", "daily_issue_summary", "ml_anomaly_scores"])


def run_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    reports = report_tables(spark, sf_dir)
    ml = cut(triage.ml_scores(reports.anomaly_scorecard), "ml_scores")
    checks = G.gate_checks(
        FILES,
        reports.daily_reconciliation_summary.groupBy("source_file").agg(F.sum("total_bet_rows").alias("row_count")),
        G.gate_anomaly_metrics(reports.anomaly_scorecard, FILES),
        G.gate_alert_types(reports.alert_feed, FILES),
        G.gate_ml_metrics(ml, FILES),
    )
    return pipeline.run_metrics(checks, reports, ml)


def some(df: DataFrame, column: str, wrong: str | int, when: str) -> DataFrame:
    """The table broken on purpose, where ``when`` holds."""
    return df.withColumn(column, F.when(F.expr(when), F.lit(wrong)).otherwise(F.col(column)))


EVEN = "total_bet_rows % 2 = 0"


MEDIUM = dict(BAND_FLOORS)["high"]
CHECKS: dict[str, Query] = {
    "assert_not_null": of(staged, lambda df: X.assert_not_null(df, "source_uuid").select(*ROW, "source_uuid")),
    "assert_unique": of(staged, lambda df: X.assert_unique(df, "source_uuid")),
    "assert_accepted_values": of(card, lambda df: X.assert_accepted_values(df, "risk_band", ["normal", "low"])),
    "assert_alert_scope": of(
        feed, lambda df: X.assert_alert_scope(some(df, "alert_scope", "other", "severity = 'high'"))
    ),
    "assert_summary_matches_feed": summary_mismatch,
    "assert_risk_band": of(card, lambda df: X.assert_risk_band(some(df, "risk_band", "odd", EVEN))),
    "assert_score_bounds": of(card, lambda df: X.assert_score_bounds(df, 0, 50)),
    "assert_components_sum": of(card, lambda df: X.assert_components_sum(df, MEDIUM)),
    "assert_source_thresholds": of(
        of(recon, A.source_day_alerts),
        lambda df: X.assert_source_thresholds(df, narrowed(A.SOURCE_RULES, "duplicate_ratio_spike", "9")),
    ),
    "assert_bookmaker_thresholds": of(
        of(bookmakers, A.bookmaker_day_alerts),
        lambda df: X.assert_bookmaker_thresholds(some(df, "alert_owner", "nobody", EVEN)),
    ),
    "assert_reconciliation_counts": of(
        recon, lambda df: X.assert_reconciliation_counts(some(df, "total_bet_rows", 0, EVEN))
    ),
    "assert_reconciliation_status": of(
        recon, lambda df: X.assert_reconciliation_status(some(df, "reconciliation_status", "odd", EVEN))
    ),
    "gate_anomaly_metrics": of(card, lambda df: G.gate_anomaly_metrics(df, FILES)),
    "gate_alert_types": of(of(recon, A.source_day_alerts), lambda df: G.gate_alert_types(df, FILES)),
    "gate_missing_alert_types": of(
        feed,
        lambda df: G.gate_missing_alert_types(
            G.gate_alert_types(df, FILES), [*G.EXPECTED_ALERT_TYPES, "bookmaker_loss_day"]
        ),
    ),
    "gate_ml_metrics": of(ml_scores, lambda df: G.gate_ml_metrics(df, FILES)),
    "gate_checks": gate_checks,
    "output_inventory": output_inventory,
    "run_metrics": run_metrics,
}

GROUPS = (LANDING, PARSING, MODELS, QUALITY, RECONCILE, ALERTS, SCORECARD, TRIAGE, SUMMARIES, CHECKS)


def queries() -> dict[str, Query]:
    """Name -> query; each tunes the session it is given and returns plainly typed columns."""

    def wrapped(query: Query) -> Query:
        return lambda spark, sf_dir: plain(query(tune(spark), sf_dir))

    return {name: wrapped(query) for group in GROUPS for name, query in group.items()}
