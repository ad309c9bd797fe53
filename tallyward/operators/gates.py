"""Run gates: counts and expectations that decide whether a run may be published."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyward.operators.alerts import SOURCE_RULES
from tallyward.sources.exports import EXPORTS, exported_size

EXPECTED_ALERT_TYPES = tuple(rule.name for rule in SOURCE_RULES)
ML_OUTPUTS = ("ml_anomaly_scores",)
EXPECTED_OUTPUTS = (*EXPORTS, *ML_OUTPUTS)


class QualityGateError(RuntimeError):
    """The run failed at least one gate."""


def files_table(spark: SparkSession, source_files: Sequence[str] | DataFrame) -> DataFrame:
    """Dump names as a table with the column ``source_file``."""
    if isinstance(source_files, DataFrame):
        return source_files.select("source_file")
    return spark.createDataFrame([(f,) for f in source_files], "source_file string")


def _of_files(df: DataFrame, source_files: Sequence[str] | DataFrame) -> DataFrame:
    return df.join(files_table(df.sparkSession, source_files), "source_file", "left_semi")


def gate_anomaly_metrics(scorecard: DataFrame, source_files: Sequence[str] | DataFrame) -> DataFrame:
    return _of_files(scorecard, source_files).agg(
        F.count(F.lit(1)).alias("anomaly_row_count"),
        F.coalesce(F.max("anomaly_score"), F.lit(0)).alias("max_anomaly_score"),
        F.count_if(F.col("risk_band") == "critical").alias("critical_anomaly_count"),
    )


def gate_alert_types(feed: DataFrame, source_files: Sequence[str] | DataFrame) -> DataFrame:
    """Alert types raised for the files; bookmaker alerts have no file and drop out."""
    return _of_files(feed, source_files).select("alert_type").distinct().orderBy("alert_type")


def gate_missing_alert_types(seen: DataFrame, expected: Sequence[str] = EXPECTED_ALERT_TYPES) -> DataFrame:
    wanted = seen.sparkSession.createDataFrame([(name,) for name in expected], "alert_type string")
    return wanted.join(seen, "alert_type", "left_anti").orderBy("alert_type")


def gate_ml_metrics(ml_scores: DataFrame, source_files: Sequence[str] | DataFrame) -> DataFrame:
    return _of_files(ml_scores, source_files).agg(
        F.count(F.lit(1)).alias("ml_row_count"),
        F.count_if(F.col("model_outlier_flag").cast("boolean")).alias("ml_outlier_count"),
        F.greatest(F.coalesce(F.max("ml_anomaly_score").cast("double"), F.lit(0.0)), F.lit(0.0)).alias(
            "max_ml_anomaly_score"
        ),
    )


def output_inventory(
    spark: SparkSession, out_dir: str, counts: Mapping[str, int], expected: Sequence[str] = EXPECTED_OUTPUTS
) -> DataFrame:
    """Expected outputs in a folder. One is complete when it is there, with its header at least; rows are information."""
    rows = [(name, int(counts.get(name, 0)), exported_size(spark, f"{out_dir}/{name}.csv") > 0) for name in expected]
    return spark.createDataFrame(rows, "output string, row_count long, complete boolean")


def gate_checks(
    source_files: Sequence[str] | DataFrame,
    row_counts: DataFrame,
    anomaly_metrics: DataFrame,
    alert_types: DataFrame,
    ml_metrics: DataFrame | None = None,
    inventory: DataFrame | None = None,
    require_alerts: bool = False,
) -> DataFrame:
    """Every check of the run as (check, subject, observed, passed).

    Without ``ml_metrics`` the model checks are left out. ``require_alerts``
    adds the checks of a demonstration run: all expected alert types, a critical
    score and a model outlier.
    """
    spark = row_counts.sparkSession
    files = files_table(spark, source_files).withColumnRenamed("source_file", "subject")

    def at_least_one(check: str, subject: str, metrics: DataFrame, column: str) -> DataFrame:
        return metrics.select(
            F.lit(check).alias("check"), F.lit(subject).alias("subject"), F.col(column).alias("observed")
        )

    checks = [
        files.agg(F.count(F.lit(1)).alias("observed")).select(
            F.lit("source_files_present").alias("check"), F.lit("run").alias("subject"), "observed"
        ),
        files.join(row_counts.withColumnRenamed("source_file", "subject"), "subject", "left").select(
            F.lit("raw_rows_loaded").alias("check"),
            "subject",
            F.coalesce("row_count", F.lit(0)).alias("observed"),
        ),
        at_least_one("scorecard_rows", "anomaly_scorecard", anomaly_metrics, "anomaly_row_count"),
    ]
    if inventory is not None:
        checks.append(
            inventory.select(
                F.lit("output_complete").alias("check"),
                F.col("output").alias("subject"),
                F.col("complete").cast("long").alias("observed"),
            )
        )
    if ml_metrics is not None:
        checks.append(at_least_one("ml_rows", "ml_anomaly_scores", ml_metrics, "ml_row_count"))
    if require_alerts:
        expected = spark.createDataFrame([(n,) for n in EXPECTED_ALERT_TYPES], "alert_type string")
        checks.append(
            expected.join(alert_types.withColumn("seen", F.lit(1)), "alert_type", "left").select(
                F.lit("expected_alert_type").alias("check"),
                F.col("alert_type").alias("subject"),
                F.coalesce("seen", F.lit(0)).alias("observed"),
            )
        )
        checks.append(
            at_least_one("critical_anomaly", "anomaly_scorecard", anomaly_metrics, "critical_anomaly_count")
        )
        if ml_metrics is not None:
            checks.append(at_least_one("ml_outlier", "ml_anomaly_scores", ml_metrics, "ml_outlier_count"))
    combined = checks[0]
    for check in checks[1:]:
        combined = combined.unionByName(check)
    return combined.withColumn("observed", F.col("observed").cast("long")).withColumn(
        "passed", F.col("observed") > 0
    )


def gate_failures(checks: DataFrame) -> DataFrame:
    return checks.where(~F.col("passed"))


def enforce_gate(checks: DataFrame) -> None:
    """Raise once with every failed check."""
    line = F.format_string("%s failed for %s", "check", "subject")
    failed = gate_failures(checks).agg(F.array_join(F.array_sort(F.collect_list(line)), "; ")).first()[0]
    if failed:
        raise QualityGateError(failed)
