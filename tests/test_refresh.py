"""Reports kept up to date dump by dump equal the reports of a whole run."""

import os

import pytest
from pyspark.sql import functions as F

from tallyward.operators import bets, reconcile, staging
from tallyward.plans import pipeline, refresh
from tallyward.plans.pipeline import build_reports
from tallyward.sources import exports, landing, shared
from tests.demo import demo_raw


def dump(spark, name, first_id=0, day="2026-03-01", bookmaker="Demo Bookmaker", stake=None):
    rows = demo_raw(spark).withColumns(
        {
            "source_file": F.lit(name),
            "ingestion_id": F.col("ingestion_id") + first_id,
            "bet_date": F.when(F.col("source_row_number") % 5 == 0, F.lit(None)).otherwise(F.lit(day)),
            "bookmaker": F.when(F.col("source_row_number") % 7 == 0, F.lit(None)).otherwise(F.lit(bookmaker)),
        }
    )
    return rows if stake is None else rows.withColumn("bet_amount_win", F.lit(stake))


def names_of(spark, *names):
    return spark.createDataFrame([(n,) for n in names], "source_file string")


def whole(spark, table):
    return build_reports(bets.key_bets(staging.stage_bets(landing.read_landed(spark, table))))


def same(found, expected):
    for name in exports.EXPORTS:
        a, b = getattr(found, name), getattr(expected, name)
        assert a.columns == b.columns and a.dtypes == b.dtypes, name
        assert sorted(map(str, a.collect())) == sorted(map(str, b.collect())), name


def test_reloads_equal_whole_runs(spark, tmp_path, monkeypatch):
    table, partials = str(tmp_path / "raw"), str(tmp_path / "partials")
    landing.land(dump(spark, "a").unionByName(dump(spark, "b", 1000)).unionByName(dump(spark, "c", 2000, "2026-03-02", "Other")), table)
    same(refresh.refresh_reports(spark, table, partials), whole(spark, table))

    seen = []
    stage = staging.stage_bets

    def watched(landed, *args):
        seen.append({r.source_file for r in landed.select("source_file").distinct().collect()})
        return stage(landed, *args)

    # Other stakes, another day and a bookmaker the dump had not: the old days of b go.
    landing.land(dump(spark, "b", 3000, "2026-03-05", "Third", "$3.00"), table)
    expected = whole(spark, table)
    monkeypatch.setattr(staging, "stage_bets", watched)
    for _ in range(2):
        same(refresh.refresh_reports(spark, table, partials, names_of(spark, "b", "b")), expected)
    assert seen == [{"b"}, {"b"}]

    # A new dump and one that became empty; a name that was never landed.
    landing.land(dump(spark, "d", 4000), table, names=names_of(spark, "c"))
    monkeypatch.setattr(refresh, "NAMED", 1)  # joined instead of named
    found = refresh.refresh_reports(spark, table, partials, names_of(spark, "c", "d", "e"))
    monkeypatch.undo()
    same(found, whole(spark, table))
    assert {r.source_file for r in found.daily_reconciliation_summary.select("source_file").collect()} == {"a", "b", "d"}
    # No names change nothing.
    same(refresh.refresh_reports(spark, table, partials, names_of(spark)), whole(spark, table))


def test_a_dump_that_loses_its_issues(spark, tmp_path):
    table, partials = str(tmp_path / "raw"), str(tmp_path / "partials")
    landing.land(dump(spark, "a"), table)
    assert refresh.refresh_reports(spark, table, partials).daily_issue_summary.count() > 0
    clean = dump(spark, "a", 1000).where("source_row_number = 400").withColumn("bet_date", F.lit("2026-03-01"))
    landing.land(clean, table)
    found = refresh.refresh_reports(spark, table, partials, names_of(spark, "a"))
    assert found.daily_issue_summary.count() == 0
    assert found.daily_reconciliation_summary.first().total_bet_rows == 1


def test_nothing_to_replace(spark, tmp_path):
    table = str(tmp_path / "raw")
    landing.land(dump(spark, "a"), table)
    with pytest.raises(refresh.MissingPartials):
        refresh.refresh_reports(spark, table, str(tmp_path / "none"), names_of(spark, "a"))


def test_reload_of_files(spark, tmp_path):
    table, partials, out = (str(tmp_path / n) for n in ("raw", "partials", "out"))
    folder = tmp_path / "dumps"
    folder.mkdir()
    from tallyward.sources.contract import HEADER_TO_COLUMN

    def write(name, rows):
        frame = rows.select(*[F.col(c).alias(h) for h, c in HEADER_TO_COLUMN.items()]).toPandas()
        frame.to_csv(folder / name, index=False)

    write("a.csv", demo_raw(spark))
    landing.land(landing.landing_scan(spark, str(folder)), table)
    refresh.refresh_reports(spark, table, partials)
    write("a.csv", demo_raw(spark).where("ingestion_id > 8"))
    rows = refresh.reload_dumps(spark, str(folder), table, partials, out)
    assert set(rows) == set(exports.EXPORTS)
    assert rows["daily_reconciliation_summary"] == 1
    assert landing.read_landed(spark, table).count() == 592


def files_under(spark, kind):
    found = os.walk(spark.conf.get("spark.checkpoint.dir"))
    return {f"{at}/{n}" for at, _, names in found for n in names if f"/{kind}" in at and n.endswith(".parquet")}


def test_bets_go_once_a_refresh_has_what_they_add(spark, tmp_path):
    table, partials = str(tmp_path / "raw"), str(tmp_path / "partials")
    landing.land(dump(spark, "a").unionByName(dump(spark, "b", 1000)), table)
    before = files_under(spark, "bets")
    refresh.refresh_reports(spark, table, partials)
    same(refresh.refresh_reports(spark, table, partials, names_of(spark, "a")), whole(spark, table))
    assert files_under(spark, "bets") == before


def test_report_bets_are_the_keyed_bets_without_digests_on_disk(spark):
    staged = staging.stage_bets(dump(spark, "a"))
    before = files_under(spark, "bets")
    found = pipeline.report_bets(staged)
    expected = bets.key_bets(staged).select(*pipeline.REPORT_INPUT)
    assert found.dtypes == expected.dtypes and sorted(map(str, found.collect())) == sorted(map(str, expected.collect()))
    written = spark.read.parquet(*(files_under(spark, "bets") - before))
    assert not set(pipeline.REPORT_KEYS) & set(written.columns) and written.count() == staged.count()
    # Nor in the shuffle of what is counted by business key.
    plan = reconcile.source_day_measures(found)._jdf.queryExecution().executedPlan().toString()
    exchanges = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert exchanges and not any("bet_business_key" in line for line in exchanges)


def test_shuffles_of_a_lean_cut_go_with_it(spark):
    root = spark.conf.get("spark.local.dir", None) or spark.sparkContext._jvm.org.apache.spark.util.Utils.getLocalDir(spark.sparkContext._jsc.sc().conf())
    shuffled = lambda: {n for _, _, names in os.walk(root) for n in names if n.startswith("shuffle_")}
    rows = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count()
    spark.sparkContext._jvm.System.gc()
    before = shuffled()
    assert shared.cut_lean(rows, "counts").count() == 7
    # The count of the table itself leaves one shuffle.
    assert len({n.split("_")[1] for n in shuffled() - before}) <= 1
