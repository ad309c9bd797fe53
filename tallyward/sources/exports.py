"""Sorted CSV exports of the reports, and reading them back."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

EXPORTS = (
    "daily_reconciliation_summary",
    "daily_issue_summary",
    "daily_bookmaker_summary",
    "alert_feed",
    "alert_summary",
    "anomaly_scorecard",
)


# The sort orders of the reports.
def export_order(report: str) -> list[Column]:
    """Sort order of an exported report; NULL days last, severity descending as text."""
    day = F.asc_nulls_last("report_date")
    orders = {
        "daily_reconciliation_summary": [day, F.asc("source_file")],
        "daily_issue_summary": [day, F.asc("source_file"), F.asc("issue_type")],
        "daily_bookmaker_summary": [day, F.asc_nulls_last("bookmaker_name")],
        "alert_feed": [
            day,
            F.asc("alert_scope"),
            F.desc("severity"),
            F.asc("alert_type"),
            F.coalesce("source_file", "bookmaker_name").asc_nulls_last(),
        ],
        "alert_summary": [day, F.asc("alert_scope"), F.asc("severity"), F.asc("alert_type")],
        "anomaly_scorecard": [day, F.desc("anomaly_score"), F.asc("source_file")],
    }
    return orders[report]


def sorted_for_export(report: str, df: DataFrame) -> DataFrame:
    return df.orderBy(*export_order(report))


def write_csv(df: DataFrame, folder: str) -> int:
    """Write rows with a header line per part and return how many; counted while writing."""
    seen = Observation()
    header = ",".join(df.columns)
    (
        df.observe(seen, F.count(F.lit(1)).alias("rows"))
        .write.mode("overwrite")
        .option("header", True)
        .csv(folder)
    )
    rows = seen.get["rows"]
    if not rows:  # without rows there may be no part, and so no header
        df.sparkSession.createDataFrame([(header,)], "value string").coalesce(1).write.mode("overwrite").text(folder)
    return rows


def exported_size(spark: SparkSession, folder: str) -> int:
    """Bytes of an export; 0 if it isn't there."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return files.getContentSummary(path).getLength() if files.exists(path) else 0


def export_report(report: str, df: DataFrame, out_dir: str) -> int:
    return write_csv(sorted_for_export(report, df), f"{out_dir}/{report}.csv")


def read_artifact(spark: SparkSession, folder: str, schema: T.StructType | str) -> DataFrame:
    """Read an exported CSV back; a missing export is an empty table."""
    try:
        return spark.read.schema(schema).option("header", True).csv(folder)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)
