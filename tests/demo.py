"""The 600-row demonstration day, in raw landing shape."""

from pyspark.sql import functions as F

from tallyward.sources.contract import RAW_COLUMNS, TEXT_COLUMNS

FILE = "demo_dump.csv"


def demo_raw(spark):
    i = F.col("i")
    paired = i.between(9, 248)
    group = F.when(paired, F.floor((i - 9) / 2)).otherwise(i)
    code = F.lpad(group.cast("string"), 4, "0")
    edge = i <= 8
    win = (
        F.when(i.isin(2, 3), "$15.00")
        .when(i == 4, "($20.00)")
        .when(i.isin(7, 8), "$0.00")
        .when(edge, "$10.00")
        .when(i.between(249, 328), "($10.00)")
        .when(i.between(339, 343), "$0.00")
        .otherwise("$120.00")
    )
    payout = (
        F.when(i == 1, "$32.00")
        .when(i == 6, "$25.00")
        .when(i == 7, "$50.00")
        .when(edge, "$0.00")
        .when(i.between(339, 343), "$125.00")
        .otherwise("$160.00")
    )
    cancelled = (i == 6) | i.between(329, 333)
    no_event = (i == 5) | i.between(334, 338)
    cells = {
        "refid": F.concat(F.lit("DEMO_"), F.lpad(i.cast("string"), 4, "0")),
        "source_uuid": F.when(i.isin(2, 3), "demo-dup")
        .when(edge, F.concat(F.lit("demo-edge-"), i))
        .when(paired, F.concat(F.lit("demo-pair-"), code))
        .otherwise(F.concat(F.lit("demo-"), code)),
        "ticket_no": F.when(i.isin(2, 3), "TKT-DUP-001")
        .when(paired, F.concat(F.lit("TKT-DUP-"), code))
        .otherwise(F.concat(F.lit("TKT-"), code)),
        "bookmaker": F.lit("Demo Bookmaker"),
        "state": F.lit("NSW"),
        "bet_date": F.lit("2026-03-01"),
        "bet_time": F.when(edge, "12:00:00").otherwise(
            F.concat(F.lit("12:"), F.lpad((i % 60).cast("string"), 2, "0"), F.lit(":00"))
        ),
        "event_date": F.when(~no_event, "2026-03-01"),
        "event_time": F.when(~no_event, "15:00:00"),
        "event_category": F.lit("RACING"),
        "venue": F.lit("Sample Park"),
        "venue_state": F.lit("NSW"),
        "race_number": F.lit("1"),
        "runner_number": F.when(edge, "4").otherwise(((i % 12) + 1).cast("string")),
        "bet_amount_win": win,
        "bet_amount_place": F.when(i == 8, "$8.00").otherwise("$0.00"),
        "win_price": F.lit("3.20"),
        "place_price": F.lit("1.40"),
        "customer_name": F.lit("Demo Customer"),
        "cancelled_flag": F.when(cancelled, "Y").otherwise("N"),
        "time_cancelled": F.when(i == 6, "12:05:00").when(cancelled, "13:30:00"),
        "betback_flag": F.lit("N"),
        "refund_flag": F.lit("N"),
        "win_payout_amount": payout,
        "place_payout_amount": F.when(i == 8, "$18.40").otherwise("$0.00"),
    }
    return (
        spark.range(1, 601)
        .withColumnRenamed("id", "i")
        .select(
            i.alias("ingestion_id"),
            F.lit(FILE).alias("source_file"),
            F.lit("bets").alias("source_sheet"),
            (i + 1).alias("source_row_number"),
            F.current_timestamp().alias("ingested_at"),
            *[cells.get(c, F.lit(None)).cast("string").alias(c) for c in TEXT_COLUMNS],
            F.lit(None).cast("string").alias("raw_payload"),
        )
        .select(*RAW_COLUMNS)
    )
