"""Bet facts, payouts, customers and events."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyward.functions import keys as K
from tallyward.functions.parsing import normalize_customer_name
from tallyward.operators.ranking import BLOCK_ROWS, number_repeated_keys, number_within_key
from tallyward.operators.staging import STAGED_COLUMNS

MONEY = "decimal(24,2)"

KEY_COLUMNS = [
    "bet_record_key",
    "bet_business_key",
    "event_key",
    "customer_key",
    "selection_key",
    "duplicate_rank",
    "is_duplicate_bet_key",
]

# Staged columns the bet fact leaves out.
_NOT_IN_FACT = {
    "ingestion_id",
    "betback_claim",
    "bet_information",
    "bet_win_takeout",
    "bet_place_takeout",
    "horse_win_takeout",
    "horse_win_hold",
    "horse_place_takeout",
    "horse_place_hold",
    "race_hold",
    "betback_information",
    "placing",
    "win_deduction",
    "place_deduction",
    "bet_terminal",
}
BET_COLUMNS = KEY_COLUMNS + [c for c in STAGED_COLUMNS if c not in _NOT_IN_FACT]

PAYOUT_COLUMNS = [
    "payout_record_key",
    "bet_record_key",
    "bet_business_key",
    "event_key",
    "customer_key",
    "source_file",
    "source_refid",
    "source_uuid",
    "ticket_no",
    "bookmaker_name",
    "bet_placed_at",
    "event_scheduled_at",
    "event_category",
    "venue_name",
    "venue_state_code",
    "race_number",
    "runner_number",
    "runner_name",
    "customer_name",
    "paid_status",
    "is_cancelled",
    "is_refunded",
    "is_duplicate_bet_key",
    "win_result",
    "place_result",
    "win_payout_amount",
    "place_payout_amount",
    "total_payout_amount",
]

EVENT_COLUMNS = ["event_category", "venue_name", "venue_state_code", "event_scheduled_at", "race_number"]


def money_sum(amount: Column) -> Column:
    return F.sum(amount).cast(MONEY)


SURROGATE_KEYS = {
    "bet_record_key": K.bet_record_key,
    "bet_business_key": K.bet_business_key,
    "event_key": K.event_key,
    "customer_key": K.customer_key,
    "selection_key": K.selection_key,
}


def with_surrogate_keys(staged: DataFrame, names: Sequence[str] = tuple(SURROGATE_KEYS)) -> DataFrame:
    return staged.withColumns({name: SURROGATE_KEYS[name]() for name in names})


def rank_duplicates(
    staged: DataFrame, block_rows: int = BLOCK_ROWS, last_positions: DataFrame | None = None, few_repeats: bool = False
) -> DataFrame:
    """Rank rows that share file, uuid and ticket, over the whole file; also the group size.

    ``few_repeats`` says that most keys occur once: only rows whose key may repeat are shuffled then, for one more
    pass over the key columns.
    """
    number = number_repeated_keys if few_repeats else number_within_key
    ranked = number(
        staged,
        key=["source_file", "source_uuid", "ticket_no"],
        scope="source_file",
        position="source_row_number",
        tie_break="ingestion_id",
        rank_name="duplicate_rank",
        size_name="bet_key_rows",
        block_rows=block_rows,
        last_positions=last_positions,
    )
    return ranked.withColumn("is_duplicate_bet_key", F.col("duplicate_rank") > 1)


def key_bets(
    staged: DataFrame, block_rows: int = BLOCK_ROWS, last_positions: DataFrame | None = None, few_repeats: bool = False
) -> DataFrame:
    """Every staged column plus keys, duplicate rank and key group size.

    This is what later stages read; ``fct_bets`` is its public projection.
    """
    return with_surrogate_keys(rank_duplicates(staged, block_rows, last_positions, few_repeats))


def fct_bets(bets: DataFrame) -> DataFrame:
    return bets.select(*BET_COLUMNS)


def fct_payouts(bets: DataFrame) -> DataFrame:
    """Bets whose total payout is not zero; negative payouts stay."""
    return (
        bets.where(F.coalesce("total_payout_amount", F.lit(0)) != 0)
        .withColumn("payout_record_key", K.payout_record_key())
        .select(*PAYOUT_COLUMNS)
    )


def dim_customers(staged: DataFrame) -> DataFrame:
    """One row per normalised customer name.

    Rows collapse per (customer, bookmaker, state) before the distinct counts,
    so the distinct rewrite multiplies the reduced rows, not the bets.
    """
    slices = (
        staged.where(F.col("customer_name").isNotNull())
        .withColumn("customer_name_normalized", normalize_customer_name(F.col("customer_name")))
        .groupBy("customer_name_normalized", "bookmaker_name", "state_code")
        .agg(
            F.min("customer_name").alias("example"),
            F.count(F.lit(1)).alias("bets"),
            F.min("bet_placed_at").alias("first_bet"),
            F.max("bet_placed_at").alias("last_bet"),
            money_sum(F.col("total_stake_amount")).alias("stake"),
            money_sum(F.col("total_payout_amount")).alias("payout"),
        )
    )
    return (
        slices.groupBy("customer_name_normalized")
        .agg(
            F.min("example").alias("customer_name_example"),
            F.sum("bets").alias("bet_count"),
            F.count_distinct("bookmaker_name").alias("bookmaker_count"),
            F.count_distinct("state_code").alias("state_count"),
            F.min("first_bet").alias("first_bet_at"),
            F.max("last_bet").alias("last_bet_at"),
            money_sum(F.col("stake")).alias("total_stake_amount"),
            money_sum(F.col("payout")).alias("total_payout_amount"),
        )
        .select(F.md5("customer_name_normalized").alias("customer_key"), "*")
    )


def dim_events(staged: DataFrame) -> DataFrame:
    """One row per event, with distinct runners and bookmakers; NULL parts form groups."""
    slices = staged.groupBy(*EVENT_COLUMNS, "runner_number", "bookmaker_name").agg(
        F.count(F.lit(1)).alias("bets"),
        money_sum(F.col("total_stake_amount")).alias("stake"),
        money_sum(F.col("total_payout_amount")).alias("payout"),
    )
    return (
        slices.groupBy(*EVENT_COLUMNS)
        .agg(
            F.sum("bets").alias("bet_count"),
            F.count_distinct("runner_number").alias("distinct_runner_count"),
            F.count_distinct("bookmaker_name").alias("bookmaker_count"),
            money_sum(F.col("stake")).alias("total_stake_amount"),
            money_sum(F.col("payout")).alias("total_payout_amount"),
        )
        .select(K.event_key().alias("event_key"), "*")
    )
