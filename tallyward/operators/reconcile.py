"""Daily reconciliation per source file and per bookmaker."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyward.operators.bets import MONEY, money_sum
from tallyward.operators.quality import ISSUE_TYPES, rule_hit

# Issue type -> column of the reconciliation summary.
ISSUE_COUNT_COLUMNS = {
    "duplicate_bet_key": "duplicate_bet_key_issue_rows",
    "negative_total_stake": "negative_stake_issue_rows",
    "missing_event_timestamp": "missing_event_timestamp_issue_rows",
    "cancelled_with_payout": "cancelled_with_payout_issue_rows",
    "payout_without_stake": "payout_without_stake_issue_rows",
}

RECONCILIATION_COLUMNS = [
    "source_file",
    "report_date",
    "total_bet_rows",
    "distinct_bet_key_count",
    "duplicate_bet_key_group_count",
    "duplicate_extra_row_count",
    "named_customer_rows",
    "cancelled_bet_rows",
    "refunded_bet_rows",
    "total_issue_rows",
    *ISSUE_COUNT_COLUMNS.values(),
    "total_stake_amount",
    "total_payout_amount",
    "net_revenue_amount",
    "payout_ratio",
    "reconciliation_status",
]

BOOKMAKER_COLUMNS = [
    "bookmaker_name",
    "report_date",
    "total_bet_rows",
    "distinct_bet_key_count",
    "named_customer_rows",
    "cancelled_bet_rows",
    "refunded_bet_rows",
    "duplicate_extra_row_count",
    "total_stake_amount",
    "total_payout_amount",
    "net_revenue_amount",
]


def with_report_date(df: DataFrame) -> DataFrame:
    return df.withColumn("report_date", F.col("bet_placed_at").cast("date"))


def ratio(part: Column, whole: Column, places: int = 4) -> Column:
    """part / whole in decimals, rounded half up; NULL when whole is zero."""
    return F.round(part.cast(MONEY) / F.nullif(whole.cast(MONEY), F.lit(0).cast(MONEY)), places).cast(
        f"decimal(18,{places})"
    )


def _row_measures() -> dict[str, Column]:
    """Aggregates over bets that add up across any split of the rows."""
    return {
        "bets": F.count(F.lit(1)),
        "named": F.count_if(F.col("customer_key").isNotNull()),
        "cancelled": F.count_if("is_cancelled"),
        "refunded": F.count_if("is_refunded"),
        "stake": money_sum(F.col("total_stake_amount")),
        "payout": money_sum(F.col("total_payout_amount")),
    }


def _per_business_key(bets: DataFrame, group: list[str], extra: dict[str, Column]) -> DataFrame:
    measures = {**_row_measures(), **extra}
    return (
        with_report_date(bets)
        # 16 bytes that take the key's place in the shuffle; its 32 digits don't compress there.
        .groupBy(*group, "report_date", F.unhex(F.md5("bet_business_key")).alias("_key"))
        .agg(*[c.alias(name) for name, c in measures.items()])
    )


def _day_measures() -> dict[str, Column]:
    """The same measures from per-key partials, plus what needs whole keys."""
    return {
        "total_bet_rows": F.sum("bets"),
        "distinct_bet_key_count": F.count(F.lit(1)),
        "duplicate_bet_key_group_count": F.count_if(F.col("bets") > 1),
        "key_surplus_rows": F.sum(F.col("bets") - 1),
        "named_customer_rows": F.sum("named"),
        "cancelled_bet_rows": F.sum("cancelled"),
        "refunded_bet_rows": F.sum("refunded"),
        "total_stake_amount": money_sum(F.col("stake")),
        "total_payout_amount": money_sum(F.col("payout")),
    }


def source_day_measures(bets: DataFrame) -> DataFrame:
    """Every source-day figure in two stacked aggregations and no join.

    Level one collapses rows per (file, day, business key) with map-side
    combine, so a hot key is one row per task before the shuffle; level two
    reads distinct keys, duplicate groups and surplus rows off whole keys.
    """
    issues = {ISSUE_COUNT_COLUMNS[t]: F.count_if(rule_hit(t)) for t in ISSUE_TYPES}
    per_key = _per_business_key(bets, ["source_file"], issues)
    return per_key.groupBy("source_file", "report_date").agg(
        *[c.alias(name) for name, c in _day_measures().items()],
        *[F.sum(name).alias(name) for name in issues],
    )


def daily_bets_agg(bets: DataFrame) -> DataFrame:
    return source_day_measures(bets).select(
        "source_file",
        "report_date",
        "total_bet_rows",
        "distinct_bet_key_count",
        "named_customer_rows",
        "cancelled_bet_rows",
        "refunded_bet_rows",
        "total_stake_amount",
        "total_payout_amount",
    )


def duplicate_groups(bets: DataFrame) -> DataFrame:
    """Business keys met more than once within a day, and their surplus rows."""
    return (
        source_day_measures(bets)
        .where(F.col("duplicate_bet_key_group_count") > 0)
        .select(
            "source_file",
            "report_date",
            "duplicate_bet_key_group_count",
            F.col("key_surplus_rows").alias("duplicate_extra_row_count"),
        )
    )


def daily_issue_summary(issues: DataFrame) -> DataFrame:
    return (
        with_report_date(issues)
        .groupBy("source_file", "report_date", "issue_type")
        .agg(F.count(F.lit(1)).alias("issue_count"))
    )


def issue_counts_pivot(issue_summary: DataFrame) -> DataFrame:
    """Issue counts per source-day, one column per rule; NULL where a rule never hit."""
    return issue_summary.groupBy("source_file", "report_date").agg(
        F.sum("issue_count").alias("total_issue_rows"),
        *[
            F.sum(F.when(F.col("issue_type") == issue_type, F.col("issue_count"))).alias(column)
            for issue_type, column in ISSUE_COUNT_COLUMNS.items()
        ],
    )


def daily_reconciliation_summary(bets: DataFrame) -> DataFrame:
    """Rows, keys, issues and money per source-day, with a review/pass status.

    Duplicate and issue figures count as zero on a day without a date: they
    belong to no day.
    """
    return reconciliation_of(source_day_measures(bets))


def reconciliation_of(days: DataFrame) -> DataFrame:
    """The summary from ``source_day_measures``, in place."""
    dated = F.col("source_file").isNotNull() & F.col("report_date").isNotNull()

    def on_a_day(count: Column) -> Column:
        return F.when(dated, count).otherwise(F.lit(0)).cast("long")

    issue_columns = list(ISSUE_COUNT_COLUMNS.values())
    total_issues = sum((F.col(c) for c in issue_columns[1:]), F.col(issue_columns[0]))
    return (
        days.withColumns(
            {
                "total_issue_rows": on_a_day(total_issues),
                "duplicate_bet_key_group_count": on_a_day(F.col("duplicate_bet_key_group_count")),
                "duplicate_extra_row_count": on_a_day(F.col("key_surplus_rows")),
                **{c: on_a_day(F.col(c)) for c in issue_columns},
                "net_revenue_amount": (F.col("total_stake_amount") - F.col("total_payout_amount")).cast(
                    MONEY
                ),
                "payout_ratio": ratio(F.col("total_payout_amount"), F.col("total_stake_amount")),
            }
        )
        .withColumn(
            "reconciliation_status", F.when(F.col("total_issue_rows") > 0, "review").otherwise("pass")
        )
        .select(*RECONCILIATION_COLUMNS)
    )


def bookmaker_day_measures(bets: DataFrame, by_dump: bool = False) -> DataFrame:
    """The same measures per bookmaker-day, or what each dump adds to them; surplus rows come from the rank over the file."""
    group = ["source_file", "bookmaker_name"] if by_dump else ["bookmaker_name"]
    per_key = _per_business_key(bets, group, {"ranked_surplus": F.count_if("is_duplicate_bet_key")})
    return per_key.groupBy(*group, "report_date").agg(
        *[c.alias(name) for name, c in _day_measures().items()],
        F.sum("ranked_surplus").alias("ranked_surplus"),
    )


def merged_bookmaker_days(parts: DataFrame) -> DataFrame:
    """Bookmaker-days from what each dump adds; a business key lies in one dump, so distinct keys add up too."""
    money = ("total_stake_amount", "total_payout_amount")
    sums = [(money_sum(F.col(c)) if c in money else F.sum(c)).alias(c) for c in (*_day_measures(), "ranked_surplus")]
    return parts.groupBy("bookmaker_name", "report_date").agg(*sums)


def daily_bookmaker_summary(bets: DataFrame) -> DataFrame:
    """Rows, keys and money per bookmaker-day."""
    return bookmaker_summary_of(bookmaker_day_measures(bets))


def bookmaker_summary_of(per_day: DataFrame) -> DataFrame:
    """The summary from ``bookmaker_day_measures``, in place."""
    named_day = F.col("bookmaker_name").isNotNull() & F.col("report_date").isNotNull()
    return per_day.withColumns(
        {
            "duplicate_extra_row_count": F.when(named_day, F.col("ranked_surplus")).otherwise(0),
            "net_revenue_amount": (F.col("total_stake_amount") - F.col("total_payout_amount")).cast(MONEY),
        }
    ).select(*BOOKMAKER_COLUMNS)
