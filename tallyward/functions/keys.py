"""md5 surrogate keys. Parts are joined by a vertical bar."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyward.functions.parsing import normalize_customer_name

EVENT_PARTS = ("event_category", "venue_state_code", "venue_name", "event_scheduled_at", "race_number")


def hashed(*parts: Column) -> Column:
    """md5 over the parts that are not NULL."""
    return F.md5(F.concat_ws("|", *[p.cast("string") for p in parts]))


def or_empty(part: Column) -> Column:
    return F.coalesce(part.cast("string"), F.lit(""))


def bet_record_key() -> Column:
    return hashed(F.col("source_file"), F.col("source_sheet"), F.col("source_row_number"))


def bet_business_key() -> Column:
    return hashed(F.col("source_file"), or_empty(F.col("source_uuid")), or_empty(F.col("ticket_no")))


def event_key() -> Column:
    return hashed(*[or_empty(F.col(c)) for c in EVENT_PARTS])


def selection_key() -> Column:
    return hashed(*[or_empty(F.col(c)) for c in (*EVENT_PARTS, "runner_number", "runner_name")])


def customer_key() -> Column:
    # md5 of NULL is NULL, so unnamed rows get no key.
    return F.md5(normalize_customer_name(F.col("customer_name")))


def payout_record_key() -> Column:
    return hashed(F.col("bet_record_key"), or_empty(F.col("total_payout_amount")))


def anomaly_id() -> Column:
    return hashed(F.col("source_file"), F.col("report_date"))


def source_alert_id() -> Column:
    """The absent bookmaker is written as an empty last part."""
    return hashed(
        F.col("alert_scope"), F.col("source_file"), F.col("report_date"), F.col("alert_type"), F.lit("")
    )


def bookmaker_alert_id() -> Column:
    """The absent source file is written as an empty second part."""
    return hashed(
        F.col("alert_scope"), F.lit(""), F.col("report_date"), F.col("alert_type"), F.col("bookmaker_name")
    )


def ml_score_id(model_name: str) -> Column:
    """A day without a date is written as the word None."""
    return hashed(F.lit(model_name), F.col("source_file"), F.coalesce(F.col("report_date").cast("string"), F.lit("None")))
