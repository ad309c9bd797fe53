"""The closed 52-column contract of a source dump."""

from __future__ import annotations

from pyspark.sql import types as T

# Dump header -> landing column.
HEADER_TO_COLUMN = {
    "REFID": "refid",
    "UUID": "source_uuid",
    "License": "license",
    "Bookmaker": "bookmaker",
    "Location": "location",
    "State": "state",
    "Area": "area",
    "Wagering Provider": "wagering_provider",
    "SysVerNo": "sys_ver_no",
    "Bet Date": "bet_date",
    "Bet Time": "bet_time",
    "Event Date": "event_date",
    "Event Time": "event_time",
    "Ticket No": "ticket_no",
    "Event": "event_category",
    "Sport Event": "sport_event",
    "Venue": "venue",
    "Venue State": "venue_state",
    "Bet Type": "bet_type",
    "Bet Method": "bet_method",
    "Bet Details": "bet_details",
    "Race Number": "race_number",
    "Runner Number": "runner_number",
    "Runner Name": "runner_name",
    "Bet Amount Win": "bet_amount_win",
    "Bet Amount Place": "bet_amount_place",
    "WinPrice": "win_price",
    "Place Price": "place_price",
    "Customer Name": "customer_name",
    "Betback Claim": "betback_claim",
    "Bet Information": "bet_information",
    "Cancelled Flag": "cancelled_flag",
    "Time Cancelled": "time_cancelled",
    "Bet Win Takeout": "bet_win_takeout",
    "Bet Place Takeout": "bet_place_takeout",
    "Horse Win Takeout": "horse_win_takeout",
    "Horse Win Hold": "horse_win_hold",
    "Horse Place Takeout": "horse_place_takeout",
    "Horse PlaceHold": "horse_place_hold",
    "Race Hold": "race_hold",
    "BetBack Information": "betback_information",
    "BetBack Flag": "betback_flag",
    "Refund Flag": "refund_flag",
    "Placing": "placing_position",
    "Win Deduction": "win_deduction",
    "Place Deduction": "place_deduction",
    "Win Result": "win_result",
    "Place Result": "place_result",
    "Win Payout Amount": "win_payout_amount",
    "Place Payout Amount": "place_payout_amount",
    "Paid Status": "paid_status",
    "Bet Terminal": "bet_terminal",
}

HEADERS = list(HEADER_TO_COLUMN)
TEXT_COLUMNS = list(HEADER_TO_COLUMN.values())

RAW_SCHEMA = T.StructType(
    [
        T.StructField("ingestion_id", T.LongType()),
        T.StructField("source_file", T.StringType()),
        T.StructField("source_sheet", T.StringType()),
        T.StructField("source_row_number", T.LongType()),
        T.StructField("ingested_at", T.TimestampType()),
        *[T.StructField(c, T.StringType()) for c in TEXT_COLUMNS],
        T.StructField("raw_payload", T.StringType()),
    ]
)
RAW_COLUMNS = RAW_SCHEMA.fieldNames()
