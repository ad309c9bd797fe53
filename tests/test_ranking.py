import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tallyward.operators import bets, ranking, staging
from tallyward.operators.ranking import may_repeat, number_repeated_keys, number_within_key
from tallyward.plans import catalog
from tests.demo import demo_raw


def rows_with_hot_keys(seed):
    rng = random.Random(seed)
    rows = []
    for file in ("a", "b", "short"):
        size = 12 if file == "short" else 400
        for position in range(2, size + 2):
            draw = rng.random()
            if draw < 0.34:
                uuid, ticket = None, None  # a third of all rows without any id
            elif draw < 0.6:
                uuid, ticket = "hot", "t"
            else:
                uuid, ticket = rng.choice(["", None, f"u{rng.randrange(60)}"]), f"t{rng.randrange(3)}"
            rows.append((file, uuid, ticket, position))
    # The same file landed twice: equal positions, told apart by the id.
    rows += [r for r in rows if r[0] == "b"]
    rng.shuffle(rows)
    return [(i, *r) for i, r in enumerate(rows)]


def only_repeated(bits):
    return lambda *args: number_repeated_keys(*args, bits=bits)


@pytest.mark.parametrize("number", [number_within_key, only_repeated(1), only_repeated(1 << 20)])
@pytest.mark.parametrize("block_rows", [1, 7, 64, 1 << 20])
def test_matches_plain_numbering(spark, block_rows, number):
    rows = rows_with_hot_keys(block_rows)
    names = ["id", "file", "uuid", "ticket", "pos"]
    df = spark.createDataFrame(rows, "id long, file string, uuid string, ticket string, pos long").repartition(5)
    got = number(df, ["file", "uuid", "ticket"], "file", "pos", "id", "rank", "size", block_rows)
    assert got.columns == [*names, "rank", "size"]
    got = got.toPandas().set_index("id").sort_index()

    brute = pd.DataFrame(rows, columns=names).sort_values(["pos", "id"])
    key = [brute[c].map(lambda v: ("null",) if v is None else ("v", v)) for c in ("file", "uuid", "ticket")]
    groups = brute.groupby([k.rename(i) for i, k in enumerate(key)])
    brute["rank"] = groups.cumcount() + 1
    brute["size"] = groups["id"].transform("count")
    brute = brute.set_index("id").sort_index()
    assert (got["rank"] == brute["rank"]).all()
    assert (got["size"] == brute["size"]).all()


def test_windows_are_split_by_block_and_short_dumps_pay_nothing(spark):
    df = spark.range(1000).select(
        F.lit("f").alias("file"), F.lit(None).cast("string").alias("k"), F.col("id").alias("pos"), "id"
    )
    out = number_within_key(df, ["file", "k"], "file", "pos", "id", "rank", "size", ranking.BLOCK_ROWS)
    out.collect()
    final = out._jdf.queryExecution().executedPlan().toString()
    # With no dump longer than a block the correction branch is gone from the final plan.
    final = final.split("Initial Plan")[0]
    assert "Join" not in final
    assert "_block" in final


def test_filter_knows_every_repeated_key_and_few_others(spark):
    df = spark.range(40000).select("id", F.when(F.col("id") < 39000, F.col("id")).otherwise(F.col("id") % 500).alias("k"))
    flagged = {r.id for r in df.where(may_repeat(df, ["k"], bits=1 << 18)).collect()}
    shared = {i for i in range(40000) if i < 500 or i >= 39000}
    assert shared <= flagged
    # 500 of 2^18 bits are set, so about 75 of 38 500 other keys may pass.
    assert len(flagged - shared) < 300
    assert df.limit(0).where(may_repeat(df.limit(0), ["k"], bits=1 << 15)).count() == 0


def test_unique_rows_are_not_shuffled(spark):
    df = spark.range(5000).select(F.lit("f").alias("file"), (F.col("id") % 4990).alias("k"), F.col("id").alias("pos"), "id")
    out = number_repeated_keys(df, ["file", "k"], "file", "pos", "id", "rank", "size", bits=1 << 20)
    assert out.where("size = 2").count() == 20
    assert out.where("rank = 2").count() == 10
    assert out.count() == 5000
    # 20 rows share their keys; the window gets these and the few that share a bit with them.
    assert df.where(may_repeat(df, ["file", "k"], bits=1 << 20)).count() < 60


def test_long_dumps_are_no_join_keys(spark):
    """A join by dump would put all rows of a long dump into one task."""
    df = spark.range(100).select(F.concat(F.lit("f"), F.col("id") % 2).alias("file"), (F.col("id") % 3).alias("k"), F.col("id").alias("pos"), "id")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = number_within_key(df, ["file", "k"], "file", "pos", "id", "rank", "size", 10)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    semi = [line for line in plan.splitlines() if "LeftSemi" in line]
    assert semi and all("BroadcastHashJoin" in line for line in semi)


def test_facts_shuffle_only_rows_whose_key_may_repeat(spark):
    raw = demo_raw(spark)
    plan = catalog.queries()["fct_bets"]
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(catalog, "lineitem_raw", lambda *a, **k: raw)
        found = plan(spark, "")
        expected = catalog.plain(bets.fct_bets(bets.key_bets(staging.stage_bets(raw))).drop("raw_payload"))
    assert "bitmap_construct_agg" in found._jdf.queryExecution().analyzed().toString()
    assert sorted(map(str, found.drop("ingested_at").collect())) == sorted(map(str, expected.drop("ingested_at").collect()))
