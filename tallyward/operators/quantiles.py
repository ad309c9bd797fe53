"""Exact quantiles without gathering a column into one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Rank error of the sketch is at most 1 / ACCURACY of the rows; the bracket is wider on both sides.
ACCURACY = 10000
BRACKET = 0.0005
# Below this many rows the bracket is the whole range; results are the same on both sides.
SMALL_ROWS = 20000
# The values of a bracket are tallied in so many ranges, each in a group of its own.
RANGES = 1024


def exact_quantile(df: DataFrame, columns: Sequence[str], q: float, small_rows: int | None = None) -> DataFrame:
    """One row with the linearly interpolated ``q`` quantile of each column (no NULLs)."""
    return exact_quantiles(df, [(c, c, q) for c in columns], small_rows)


def exact_quantiles(df: DataFrame, wanted: Sequence[tuple[str, str, float]], small_rows: int | None = None) -> DataFrame:
    """One row with a linearly interpolated quantile per (name, column, q), all in the same two passes.

    A sketch brackets the wanted ranks; one more pass counts the rows below each
    bracket and tallies the distinct values inside it (about a thousandth of
    the rows). The tally is split into ranges of values: counts per range give
    each range its start, and order statistics are read off the running tally
    within the ranges.
    """
    small_rows = SMALL_ROWS if small_rows is None else small_rows
    whole = F.col("n") < small_rows
    ends = [(max(q - BRACKET, 0.0), min(q + BRACKET, 1.0)) for _, _, q in wanted]

    sketches = df.agg(
        F.count(F.lit(1)).alias("n"),
        *[F.percentile_approx(c, list(ends[k]), ACCURACY).alias(f"b{k}") for k, (_, c, _) in enumerate(wanted)],
        *[F.min(c).alias(f"x0_{k}") for k, (_, c, _) in enumerate(wanted)],
        *[F.max(c).alias(f"x1_{k}") for k, (_, c, _) in enumerate(wanted)],
    )
    limits = sketches.select(
        F.struct(
            "n",
            F.array(
                *[
                    F.struct(
                        (F.col(f"x0_{k}") if low == 0.0 else F.when(whole, F.col(f"x0_{k}")).otherwise(F.col(f"b{k}")[0])).cast("double").alias("low"),
                        (F.col(f"x1_{k}") if high == 1.0 else F.when(whole, F.col(f"x1_{k}")).otherwise(F.col(f"b{k}")[1])).cast("double").alias("high"),
                        F.lit(float(wanted[k][2])).alias("q"),
                    )
                    for k, (low, high) in enumerate(ends)
                ]
            ).alias("bounds"),
        )
    ).scalar()
    cells = df.select(
        F.posexplode(F.array(*[F.col(c).cast("double") for _, c, _ in wanted])).alias("i", "value"),
    ).withColumn("limit", limits)
    own = F.element_at("limit.bounds", F.col("i") + 1)
    span = own["high"] - own["low"]
    place = F.floor((F.col("value") - own["low"]) / F.when(span > 0, span) * RANGES)
    inside = F.col("value") >= own["low"]
    # Everything below the bracket collapses to one tally row per quantile, in range -1.
    tally = (
        cells.where(F.col("value") <= own["high"])
        .select(
            "i",
            F.when(inside, F.col("value")).alias("value"),
            F.when(inside, F.coalesce(F.least(place, F.lit(RANGES - 1)), F.lit(0))).otherwise(-1).alias("range"),
            ((F.col("limit.n") - 1) * own["q"]).alias("position"),
        )
        .groupBy("i", "range", "value")
        .agg(F.count(F.lit(1)).alias("rows"), F.first("position").alias("position"))
    )
    ahead = Window.partitionBy("i").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = tally.groupBy("i", "range").agg(F.sum("rows").alias("in_range"))
    starts = starts.select("i", "range", F.coalesce(F.sum("in_range").over(ahead), F.lit(0)).alias("before"))
    running = Window.partitionBy("i", "range").orderBy(F.asc_nulls_first("value")).rowsBetween(Window.unboundedPreceding, 0)
    ranked = tally.join(starts, ["i", "range"]).select(
        "i", "value", "position", (F.col("before") + F.sum("rows").over(running)).alias("through")
    )
    # The first value whose running count passes a rank is that order statistic.
    picked = ranked.groupBy("i").agg(
        F.min(F.when(F.col("through") > F.floor("position"), F.col("value"))).alias("lower"),
        F.min(F.when(F.col("through") > F.ceil("position"), F.col("value"))).alias("upper"),
        F.first(F.col("position") - F.floor("position")).alias("share"),
    )
    values = picked.select("i", (F.col("lower") + (F.col("upper") - F.col("lower")) * F.col("share")).alias("v"))
    return values.agg(
        *[F.max(F.when(F.col("i") == k, F.col("v"))).alias(name) for k, (name, _, _) in enumerate(wanted)]
    )
