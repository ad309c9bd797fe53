"""Raw landing text to typed columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyward.functions import parsing as P

MONEY_SUM = "decimal(15,2)"

# Staged column, how it is parsed, raw column(s); in output order.
STAGING_RULES = (
    ("ingestion_id", "keep", "ingestion_id"),
    ("source_file", "keep", "source_file"),
    ("source_sheet", "keep", "source_sheet"),
    ("source_row_number", "keep", "source_row_number"),
    ("ingested_at", "keep", "ingested_at"),
    ("source_refid", "text", "refid"),
    ("source_uuid", "text", "source_uuid"),
    ("license", "text", "license"),
    ("bookmaker_name", "text", "bookmaker"),
    ("location_name", "text", "location"),
    ("state_code", "text", "state"),
    ("area_name", "text", "area"),
    ("wagering_provider", "text", "wagering_provider"),
    ("system_version", "text", "sys_ver_no"),
    ("bet_placed_at", "moment", "bet_date", "bet_time"),
    ("event_scheduled_at", "moment", "event_date", "event_time"),
    ("ticket_no", "text", "ticket_no"),
    ("event_category", "text", "event_category"),
    ("sport_event_name", "text", "sport_event"),
    ("venue_name", "text", "venue"),
    ("venue_state_code", "text", "venue_state"),
    ("bet_type", "text", "bet_type"),
    ("bet_method", "text", "bet_method"),
    ("bet_details", "text", "bet_details"),
    ("race_number", "integer", "race_number"),
    ("runner_number", "integer", "runner_number"),
    ("runner_name", "text", "runner_name"),
    ("stake_win_amount", "money", "bet_amount_win"),
    ("stake_place_amount", "money", "bet_amount_place"),
    ("total_stake_amount", "total", "stake_win_amount", "stake_place_amount"),
    ("win_price", "decimal", "win_price"),
    ("place_price", "decimal", "place_price"),
    ("customer_name", "text", "customer_name"),
    ("betback_claim", "text", "betback_claim"),
    ("bet_information", "text", "bet_information"),
    ("is_cancelled", "flag", "cancelled_flag"),
    ("cancelled_at", "moment", "bet_date", "time_cancelled"),
    ("bet_win_takeout", "decimal", "bet_win_takeout"),
    ("bet_place_takeout", "decimal", "bet_place_takeout"),
    ("horse_win_takeout", "decimal", "horse_win_takeout"),
    ("horse_win_hold", "decimal", "horse_win_hold"),
    ("horse_place_takeout", "decimal", "horse_place_takeout"),
    ("horse_place_hold", "decimal", "horse_place_hold"),
    ("race_hold", "decimal", "race_hold"),
    ("betback_information", "text", "betback_information"),
    ("is_betback", "flag", "betback_flag"),
    ("is_refunded", "flag", "refund_flag"),
    ("placing", "integer", "placing_position"),
    ("win_deduction", "decimal", "win_deduction"),
    ("place_deduction", "decimal", "place_deduction"),
    ("win_result", "decimal", "win_result"),
    ("place_result", "decimal", "place_result"),
    ("win_payout_amount", "money", "win_payout_amount"),
    ("place_payout_amount", "money", "place_payout_amount"),
    ("total_payout_amount", "total", "win_payout_amount", "place_payout_amount"),
    ("paid_status", "text", "paid_status"),
    ("bet_terminal", "text", "bet_terminal"),
    ("raw_payload", "keep", "raw_payload"),
    ("missing_refid_flag", "absent", "source_refid"),
    ("missing_stake_flag", "absent", "stake_win_amount", "stake_place_amount"),
    ("negative_stake_flag", "negative", "total_stake_amount"),
)
STAGED_COLUMNS = [rule[0] for rule in STAGING_RULES]
_DERIVED = ("total", "absent", "negative")


def total_amount(first: Column, second: Column) -> Column:
    """Sum of two amounts where NULL counts as zero."""
    zero = F.lit(0).cast("decimal(14,2)")
    return (F.coalesce(first, zero) + F.coalesce(second, zero)).cast(MONEY_SUM)


def with_totals(df: DataFrame) -> DataFrame:
    """Total stake and total payout from the parsed win and place amounts."""
    return df.withColumns(
        {
            out: total_amount(F.col(args[0]), F.col(args[1]))
            for out, kind, *args in STAGING_RULES
            if kind == "total"
        }
    )


def with_flags(df: DataFrame) -> DataFrame:
    """Missing reference, missing stake and negative stake flags; never NULL."""
    flags = {}
    for out, kind, *args in STAGING_RULES:
        if kind == "absent":
            flags[out] = F.coalesce(*[F.col(a) for a in args]).isNull()
        elif kind == "negative":
            flags[out] = F.col(args[0]) < 0
    return df.withColumns(flags)


def stage_bets(raw: DataFrame, mode: str = P.STRICT, date_formats: Sequence[str] = ()) -> DataFrame:
    """All typed columns of a landed dump: one projection, no shuffle."""
    parsers = {
        "keep": F.col,
        "text": lambda c: P.clean_text(F.col(c)),
        "integer": lambda c: P.parse_integer(F.col(c), mode),
        "money": lambda c: P.parse_money(F.col(c), mode),
        "decimal": lambda c: P.parse_decimal(F.col(c), mode),
        "flag": lambda c: P.parse_boolean_flag(F.col(c)),
        "moment": lambda d, t: P.parse_source_timestamp(F.col(d), F.col(t), mode, date_formats),
    }
    parsed = raw.select(
        *[parsers[kind](*args).alias(out) for out, kind, *args in STAGING_RULES if kind not in _DERIVED]
    )
    return with_flags(with_totals(parsed)).select(*STAGED_COLUMNS)
