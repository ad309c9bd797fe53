"""Numbering and sizing of key groups when one key may hold a third of all rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# A window never sees more than this many positions of one key.
BLOCK_ROWS = 1 << 20
# The filter of repeated keys has so many bits (16 MB), however many keys there are.
FILTER_BITS = 1 << 27
# Positions that one bitmap of ``bitmap_construct_agg`` has, eight a byte, lowest bit first.
BITMAP_BITS = 1 << 15


def _encoded(key: Sequence[str]) -> Column:
    """One text per key; a NULL part differs from an empty one, and parts can't run into each other."""
    text = [F.col(name).cast("string") for name in key]
    return F.concat(*[F.coalesce(F.concat(F.length(t).cast("string"), F.lit("="), t), F.lit("-")) for t in text])


def may_repeat(df: DataFrame, key: Sequence[str], bits: int = FILTER_BITS) -> Column:
    """Condition on rows of ``df``: true wherever another row has the same key, and for few others.

    One pass over the key columns counts 64-bit digests (partial counts first,
    so a hot key is one row a task). Those met twice set their bit in a Bloom
    filter with one hash function and ``bits`` bits, made of bitmaps in parallel. The
    filter is a scalar of the plan, so the condition is pushed down to the scan.
    Many repeated keys fill it up: then more rows pass, and none is missed.
    """
    buckets = -(-bits // BITMAP_BITS)
    # NULL parts leave this digest as it is: a few more keys look alike, which the window tells apart.
    digest = F.xxhash64(*key)
    slot = F.pmod(digest, F.lit(buckets * BITMAP_BITS))
    digests = df.select(digest.alias("_digest")).groupBy("_digest").agg(F.count(F.lit(1)).alias("_rows"))
    repeated = digests.where(F.col("_rows") > 1).select(F.pmod("_digest", F.lit(buckets * BITMAP_BITS)).alias("_slot"))
    bitmaps = repeated.groupBy(F.expr(f"_slot div {BITMAP_BITS}").alias("_bucket")).agg(
        F.bitmap_construct_agg(F.col("_slot") % BITMAP_BITS).alias("_bitmap")
    )
    every = df.sparkSession.range(0, buckets, 1, 1).withColumnRenamed("id", "_bucket")
    in_order = F.sort_array(F.collect_list(F.struct("_bucket", "_bitmap")))
    bloom = every.join(bitmaps, "_bucket", "left").agg(in_order).scalar()

    bitmap = F.element_at(bloom, F.floor(slot / BITMAP_BITS).cast("int") + 1)["_bitmap"]
    byte = F.conv(F.hex(F.substring(bitmap, F.floor(slot % BITMAP_BITS / 8).cast("int") + 1, F.lit(1))), 16, 10)
    return F.coalesce(F.getbit(byte.cast("int"), (slot % 8).cast("int")) == 1, F.lit(False))


def number_repeated_keys(
    df: DataFrame,
    key: Sequence[str],
    scope: str,
    position: str,
    tie_break: str,
    rank_name: str,
    size_name: str,
    block_rows: int = BLOCK_ROWS,
    last_positions: DataFrame | None = None,
    bits: int = FILTER_BITS,
) -> DataFrame:
    """``number_within_key`` for wide rows whose keys seldom repeat: only rows that may share their key are shuffled.

    All others get rank and size 1 in place. It reads the key columns once more,
    so narrow rows are better off without it. ``df`` must give the same rows
    whenever it is read.
    """
    repeats = may_repeat(df, key, bits)
    one = F.lit(1).cast("long")
    alone = df.where(~repeats).withColumns({rank_name: one, size_name: one})
    if last_positions is None:
        last_positions = df.groupBy(scope).agg(F.max(position).alias("_last"))
    shared = number_within_key(
        df.where(repeats), key, scope, position, tie_break, rank_name, size_name, block_rows, last_positions
    )
    return shared.unionByName(alone)


def number_within_key(
    df: DataFrame,
    key: Sequence[str],
    scope: str,
    position: str,
    tie_break: str,
    rank_name: str,
    size_name: str,
    block_rows: int = BLOCK_ROWS,
    last_positions: DataFrame | None = None,
) -> DataFrame:
    """Add ``row_number()`` and ``count(*)`` per key, ordered by position, NULL keys grouped.

    The position axis is cut into blocks, and the window runs per key and block,
    so a hot key (for instance all rows without any id) is spread over as many
    tasks as it has blocks. Keys that cross a block border get the rows of the
    earlier blocks added from a small (key, block, count) table. Only dumps
    longer than one block can contain such keys; when there are none, AQE sees
    the empty broadcast and drops the whole correction branch.

    ``scope`` is the key column naming the dump that ``position`` counts within.
    ``last_positions`` (scope, _last) saves a pass over ``df`` where the last
    positions are known already. ``block_rows`` never changes a result.
    """
    block = "_block"
    parts = ["_key"]
    # One digest per row, so that window and join share their partitioning.
    digest = F.unhex(F.md5(_encoded(key)))
    keyed = df.withColumns({"_key": digest, block: F.floor(F.col(position) / F.lit(block_rows)).cast("long")})

    in_block = Window.partitionBy(*parts, block)
    local = keyed.withColumns(
        {
            "_rank": F.row_number().over(in_block.orderBy(position, tie_break)),
            "_size": F.count(F.lit(1)).over(in_block),
        }
    )

    if last_positions is None:
        last_positions = df.groupBy(scope).agg(F.max(position).alias("_last"))
    long_dumps = (
        last_positions
        .where(F.col("_last") >= block_rows)
        .select(scope)
    )
    over_key = Window.partitionBy(*parts)
    crossing = (
        # A name per dump; a join by dump would put each long dump into one task.
        keyed.join(F.broadcast(long_dumps), scope, "left_semi")
        .groupBy(*parts, block)
        .agg(F.count(F.lit(1)).alias("_rows"))
        .withColumns(
            {
                "_before": F.sum("_rows").over(
                    over_key.orderBy(block).rowsBetween(Window.unboundedPreceding, -1)
                ),
                "_total": F.sum("_rows").over(over_key),
                "_blocks": F.count(F.lit(1)).over(over_key),
            }
        )
        .where(F.col("_blocks") > 1)
        .select(*parts, block, "_before", "_total")
    )

    return (
        local.join(crossing, [*parts, block], "left")
        .withColumns(
            {
                rank_name: F.col("_rank") + F.coalesce("_before", F.lit(0)),
                size_name: F.coalesce("_total", "_size"),
            }
        )
        .drop(*parts, block, "_rank", "_size", "_before", "_total")
    )
