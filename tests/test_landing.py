import json
import os

import pytest
from pyspark.sql import functions as F

from tallyward.plans import catalog
from tallyward.sources import landing, lineitem_dump, shared
from tallyward.sources.contract import HEADERS, RAW_COLUMNS


def write(folder, name, lines):
    os.makedirs(os.path.dirname(f"{folder}/{name}"), exist_ok=True)
    with open(f"{folder}/{name}", "w", encoding="utf-8") as out:
        out.write("\n".join(lines) + "\n")


@pytest.fixture
def mixed(tmp_path):
    """Two files with different columns and order, padded cells and blank rows."""
    folder = str(tmp_path / "in")
    write(folder, "b.csv", ["UUID,REFID, Bookmaker ", "u1,r1,  BM one  ", ",,", "u2,r2,", '"u,3",r3,x'])
    write(folder, "a c+d.csv", ["REFID,Ticket No", "q1,t1"])
    return folder


def test_mixed_layouts(spark, mixed):
    got = landing.landing_scan(spark, mixed)
    assert got.columns == RAW_COLUMNS
    rows = {(r.source_file, r.source_row_number): r for r in got.collect()}
    assert set(rows) == {("b.csv", 2), ("b.csv", 4), ("b.csv", 5), ("a c+d.csv", 2)}
    assert (rows["b.csv", 2].refid, rows["b.csv", 2].source_uuid, rows["b.csv", 2].bookmaker) == ("r1", "u1", "BM one")
    assert rows["b.csv", 5].source_uuid == "u,3"
    assert rows["a c+d.csv", 2].ticket_no == "t1" and rows["a c+d.csv", 2].source_uuid is None
    assert len({r.ingestion_id for r in rows.values()}) == 4


def test_payload_keeps_own_headers_and_nulls(spark, tmp_path):
    folder = str(tmp_path)
    write(folder, "b.csv", ["REFID,UUID", "r1,", "r2,u2"])
    rows = landing.landing_scan(spark, folder).orderBy("source_row_number").collect()
    assert [json.loads(r.raw_payload) for r in rows] == [{"REFID": "r1", "UUID": None}, {"REFID": "r2", "UUID": "u2"}]


@pytest.mark.parametrize("fmt", ["csv", "json"])
def test_unknown_headers_are_named(spark, tmp_path, fmt):
    folder = str(tmp_path)
    if fmt == "csv":
        write(folder, "b.csv", ["REFID,Unexpected Column", "1,2"])
    else:
        write(folder, "b.json", ['{"REFID": "1"}', '{"REFID": "1", "Unexpected Column": "2"}'])
    found = landing.check_headers(landing.dump_headers(spark, folder, fmt)).collect()
    assert [(r.source_file, r.header) for r in found] == [(f"b.{fmt}", "Unexpected Column")]
    with pytest.raises(landing.UnknownHeadersError, match="Unexpected Column"):
        landing.landing_scan(spark, folder, fmt)


@pytest.mark.parametrize("max_bytes", ["2000", "134217728"])
def test_row_numbers_over_splits_and_part_files(spark, tmp_path, max_bytes):
    folder = str(tmp_path)
    line = 0
    for part in range(3):
        rows = []
        for _ in range(700):
            line += 1
            rows.append(",," if line % 100 == 0 else f"r{line},u{line},x")
        write(folder, f"source_file=big dump.csv/part-{part:05d}.csv", ["REFID,UUID,Venue", *rows])
    write(folder, "small.csv", ["REFID,UUID,Venue", "r1,u1,x", "r2,u2,x"])
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", max_bytes)
    try:
        got = landing.landing_scan(spark, folder, with_raw_payload=False)
        rows = got.select("source_file", "source_row_number", "refid", "ingestion_id").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    big = {r.source_row_number: r.refid for r in rows if r.source_file == "big dump.csv"}
    assert big == {n + 1: f"r{n}" for n in range(1, 2101) if n % 100}
    assert {r.source_row_number: r.refid for r in rows if r.source_file == "small.csv"} == {2: "r1", 3: "r2"}
    assert len({r.ingestion_id for r in rows}) == len(rows)


def test_json_and_parquet(spark, tmp_path):
    write(str(tmp_path / "j"), "d.json", ['{"REFID": "r1", "Venue": " v "}', '{"UUID": "u2"}'])
    rows = landing.landing_scan(spark, str(tmp_path / "j"), "json").orderBy("source_row_number").collect()
    assert [(r.source_row_number, r.refid, r.source_uuid, r.venue) for r in rows] == [
        (2, "r1", None, "v"), (3, None, "u2", None),
    ]
    out = str(tmp_path / "p")
    spark.sql("select 'r1' as REFID, true as `Cancelled Flag`, timestamp_ntz'2026-03-01 10:00:00' as `Bet Date`").write.parquet(out)
    row = landing.landing_scan(spark, out, "parquet").first()
    assert (row.refid, row.cancelled_flag, row.bet_date) == ("r1", "true", "2026-03-01T10:00:00")
    assert row.source_row_number == 2


def test_limits(spark, tmp_path):
    folder = str(tmp_path)
    write(folder, "a.csv", ["REFID,UUID", "1,", "2,", "3,", "4,"])
    write(folder, "b.csv", ["REFID,UUID", "1,", ",", ",", "4,", "5,"])
    write(folder, "c.csv", ["REFID,UUID", "1,"])

    def numbers(**limits):
        got = landing.landing_scan(spark, folder, **limits).orderBy("source_file", "source_row_number").collect()
        return [(r.source_file, r.source_row_number) for r in got]

    assert numbers(limit_files=1) == [("a.csv", 2), ("a.csv", 3), ("a.csv", 4), ("a.csv", 5)]
    # In b the row at the limit is blank, so reading goes on to the next filled row.
    assert numbers(limit_rows=2) == [("a.csv", 2), ("a.csv", 3), ("b.csv", 2), ("b.csv", 5), ("c.csv", 2)]
    assert numbers(limit_rows=1) == [("a.csv", 2), ("b.csv", 2), ("c.csv", 2)]


def test_profile_and_counts(spark, mixed):
    landed = landing.landing_scan(spark, mixed)
    profile = {r.source_file: r for r in landing.landing_profile(landed).collect()}
    assert (profile["b.csv"].row_count, profile["b.csv"].source_sheet) == (3, "bets")
    sample = json.loads(profile["b.csv"].sample)
    assert list(sample) == list(landing.PREVIEW_COLUMNS) and sample["refid"] == "r1"
    counts = landing.landing_row_counts(landed, ["b.csv", "nope.csv"]).collect()
    assert [(r.source_file, r.row_count) for r in counts] == [("b.csv", 3)]


def test_append_doubles_and_replace_does_not(spark, mixed, tmp_path):
    table = str(tmp_path / "table")
    rows = landing.landing_scan(spark, mixed)
    landing.land(rows, table)
    landing.land(rows, table)
    assert landing.read_landed(spark, table).count() == 4
    again = landing.landing_scan(spark, mixed, first_id=landing.next_ingestion_id(spark, table))
    landing.land(again, table, replace_files=False)
    stored = landing.read_landed(spark, table)
    assert stored.count() == 8
    assert stored.select("ingestion_id").distinct().count() == 8
    # Replacing one dump leaves the others alone.
    landing.land(rows.where(F.col("source_file") == "b.csv"), table)
    counts = {r.source_file: r["count"] for r in landing.read_landed(spark, table).groupBy("source_file").count().collect()}
    assert counts == {"b.csv": 3, "a c+d.csv": 2}
    kept = landing.replace_by_file(stored.limit(0).unionByName(rows), rows.where(F.col("source_file") == "b.csv"))
    assert kept.count() == 4


def test_contract_has_52_headers():
    assert len(HEADERS) == 52 and len(RAW_COLUMNS) == 58


def test_all_unknown_headers_are_reported(spark, tmp_path):
    write(str(tmp_path), "b.csv", [",".join(["REFID", *[f"X{k:02d}" for k in range(30)], '"Foo, Bar"']), "1"])
    with pytest.raises(landing.UnknownHeadersError) as error:
        landing.landing_scan(spark, str(tmp_path))
    assert all(f"X{k:02d}" in str(error.value) for k in range(30)) and "'Foo, Bar'" in str(error.value)


def test_separators_of_any_kind(spark, tmp_path):
    write(str(tmp_path), "b.csv", ["REFID^UUID", "r1^u1"])
    assert landing.landing_scan(spark, str(tmp_path), sep="^").first().source_uuid == "u1"
    write(str(tmp_path / "two"), "b.csv", ["REFID||UUID", "r1||u1"])
    assert landing.landing_scan(spark, str(tmp_path / "two"), sep="||").first().source_uuid == "u1"


def test_limited_files_are_not_validated(spark, tmp_path):
    folder = str(tmp_path)
    write(folder, "a.csv", ["REFID", "1"])
    write(folder, "b.csv", ["Unexpected", "1"])
    write(folder, "source_file=a0.csv/part-0.csv", ["REFID", "7"])
    got = landing.landing_scan(spark, folder, limit_files=2).orderBy("source_file").collect()
    assert [(r.source_file, r.refid) for r in got] == [("a.csv", "1"), ("a0.csv", "7")]
    with pytest.raises(landing.UnknownHeadersError):
        landing.landing_scan(spark, folder, limit_files=3)


def test_json_padding_and_broken_lines(spark, tmp_path):
    lines = ['{" Bookmaker ": " BM ", "REFID": 8.50}', '{"REFID": "r2"}']
    write(str(tmp_path / "j"), "d.json", lines)
    first, second = landing.landing_scan(spark, str(tmp_path / "j"), "json").orderBy("source_row_number").collect()
    assert (first.bookmaker, first.refid, second.bookmaker) == ("BM", "8.5", None)
    assert json.loads(second.raw_payload) == {"Bookmaker": None, "REFID": "r2"}
    write(str(tmp_path / "k"), "d.json", [lines[0], '{"REFID": ', "", lines[1]])
    with pytest.raises(landing.BrokenRowsError, match="1 broken lines in 1 dumps, the first of them d.json"):
        landing.landing_scan(spark, str(tmp_path / "k"), "json")
    kept = landing.landing_scan(spark, str(tmp_path / "k"), "json", tolerant=True).orderBy("source_row_number").collect()
    assert [(r.source_row_number, r.refid) for r in kept] == [(2, "8.5"), (3, None), (5, "r2")]
    assert kept[1].raw_payload == '{"REFID": '


def test_line_breaks_inside_cells(spark, tmp_path):
    write(str(tmp_path), "b.csv", ["REFID,Bet Details", 'r1,"one', 'two"', "r2,x"])
    with pytest.raises(landing.BrokenRowsError, match="multi_line"):
        landing.landing_scan(spark, str(tmp_path))
    rows = landing.landing_scan(spark, str(tmp_path), multi_line=True).orderBy("source_row_number").collect()
    assert [(r.source_row_number, r.refid, r.bet_details) for r in rows] == [(2, "r1", "one\ntwo"), (3, "r2", "x")]
    assert json.loads(rows[1].raw_payload) == {"REFID": "r2", "Bet Details": "x"}


@pytest.mark.parametrize("other", [[], ["UUID", "u1"]])
def test_cells_beyond_the_header(spark, tmp_path, other):
    write(str(tmp_path), "b.csv", ["REFID,Venue", "r1,v,more"])
    if other:
        write(str(tmp_path), "c.csv", other)
    with pytest.raises(Exception, match="more cells than its header"):
        landing.landing_scan(spark, str(tmp_path)).collect()
    rows = landing.landing_scan(spark, str(tmp_path), extra_cells="drop").orderBy("source_file").collect()
    assert (rows[0].refid, rows[0].venue) == ("r1", "v")


def test_payload_of_mixed_layouts_is_each_dumps_own(spark, mixed):
    rows = {(r.source_file, r.source_row_number): json.loads(r.raw_payload) for r in landing.landing_scan(spark, mixed).collect()}
    assert rows["b.csv", 2] == {"UUID": "u1", "REFID": "r1", "Bookmaker": "BM one"}
    assert rows["a c+d.csv", 2] == {"REFID": "q1", "Ticket No": "t1"}


def test_emptied_dumps_and_ids(spark, tmp_path):
    folder, table = str(tmp_path / "in"), str(tmp_path / "table")
    assert landing.next_ingestion_id(spark, table) == 1
    write(folder, "a b.csv", ["REFID", "1", "2"])
    write(folder, "c.csv", ["REFID", "3"])
    write(folder, "none.csv", [])
    for _ in range(2):
        dumps = landing.open_dumps(spark, folder)
        assert {r[0] for r in dumps.names().collect()} == {"a b.csv", "c.csv", "none.csv"}
        first = landing.next_ingestion_id(spark, table)
        landing.land(landing.landing_scan(spark, dumps=dumps, first_id=first), table, names=dumps.names())
        write(folder, "a b.csv", ["REFID"])
    stored = landing.read_landed(spark, table).collect()
    assert [(r.source_file, r.refid) for r in stored] == [("c.csv", "3")] and stored[0].ingestion_id > 3
    # Had the second write failed, the table would be as the first left it: there is one commit, and no deletion beside it.
    bad = landing.read_landed(spark, table).withColumn("refid", F.raise_error(F.lit("lost")).cast("string"))
    before = sorted(os.listdir(table))
    with pytest.raises(Exception, match="lost"):
        landing.land(bad, table, names=spark.createDataFrame([("c.csv",), ("d.csv",)], "source_file string"))
    assert sorted(f for f in os.listdir(table) if not f.startswith(".")) == [f for f in before if not f.startswith(".")]
    assert landing.read_landed(spark, table).count() == 1
    rows = landing.read_landed(spark, table)
    assert landing.replace_by_file(rows, rows.limit(0), spark.createDataFrame([("c.csv",)], "source_file string")).count() == 0


def test_columnar_headers_belong_to_their_dump(spark, tmp_path):
    folder = str(tmp_path)
    spark.sql("select 'r1' as REFID").write.parquet(f"{folder}/source_file=one.csv")
    spark.sql("select 'r2' as REFID, 'x' as Odd").write.parquet(f"{folder}/source_file=two.csv")
    spark.sql("select 'v' as Venue").write.mode("append").parquet(f"{folder}/source_file=two.csv")
    headers = {tuple(r) for r in landing.dump_headers(spark, folder, "parquet").collect()}
    assert headers == {("one.csv", "REFID"), ("two.csv", "REFID"), ("two.csv", "Odd"), ("two.csv", "Venue")}
    assert [tuple(r) for r in landing.check_headers(landing.dump_headers(spark, folder, "parquet")).collect()] == [("two.csv", "Odd")]


def test_places_beyond_the_broadcast_size_are_joined(spark, mixed, monkeypatch):
    want = sorted(landing.landing_scan(spark, mixed).drop("ingested_at").collect())
    monkeypatch.setattr(landing, "BROADCAST_BYTES", 0)
    got = landing.landing_scan(spark, mixed)
    assert sorted(got.drop("ingested_at").collect()) == want


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_line_items_are_ordered_before_they_are_text(spark, tmp_path, monkeypatch):
    flags = ["A", "N", None, "R", "AB"]
    items = [(k, k % 9, k % 7, k % 7 + 1, float(k % 49 + 1), 10.5 * k, k % 10 / 100, k % 9 / 100, flags[k % 5], "F", "1998-01-01") for k in range(300)]
    names = "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate string"
    df = spark.createDataFrame(items, names).withColumn("l_shipdate", F.to_timestamp("l_shipdate"))
    df.coalesce(1).write.parquet(str(tmp_path / "lineitem.parquet"))
    plain = lineitem_dump.lineitem_raw(spark, str(tmp_path))
    monkeypatch.setattr(lineitem_dump, "PART_ROWS", 25)
    ordered = lineitem_dump.lineitem_in_order(spark, str(tmp_path), 2)
    assert sorted(map(str, ordered.collect())) == sorted(map(str, plain.collect()))
    # As many parts as the rows take, in order of dump and row number.
    assert ordered.rdd.getNumPartitions() == 12
    places = [(r["source_file"] or "", r["source_row_number"]) for r in ordered.select("source_file", "source_row_number").collect()]
    assert places == sorted(places)
    shuffled = plan_of(ordered).split("Exchange rangepartitioning")[1]
    assert "Customer" not in shuffled
    for compression in ("none", "gzip"):
        folder = lineitem_dump.write_dumps(ordered.where("source_file is not null"), str(tmp_path / compression), compression)
        landed = landing.landing_scan(spark, folder)
        got = {(r.source_file, r.source_row_number): (r.refid or "").strip() for r in landed.collect()}
        want = {}
        for row in sorted(plain.where("source_file is not null").collect(), key=lambda r: r.source_row_number):
            at = sum(name == row.source_file for name, _ in want) + 2
            want[row.source_file, at] = row
        blank = {k for k, r in want.items() if r.source_file == "dump_A.csv" and r.runner_number == "33"}
        assert got == {k: (r.refid or "").strip() for k, r in want.items() if k not in blank} and blank


def test_dumps_are_no_join_keys_of_rows(spark, mixed):
    """A join or a sort by dump would put each dump into one task."""
    landed = landing.landing_scan(spark, mixed)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for df in (landing.limit_to_rows(landed, 1), landing.limit_to_files(landed, 1), landing.replace_by_file(landed, landed)):
            assert "SortMergeJoin" not in plan_of(df)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "SortAggregate" not in plan_of(landing.landing_profile(landed))


def test_landing_keeps_files_open_instead_of_sorting(spark, tmp_path):
    name = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(name)
    many = shared.OPEN_FILES + 5  # dumps in one task; the rest is sorted
    rows = spark.range(0, 200, 1, 1).select(
        F.concat(F.lit("d"), F.col("id") % many).alias("source_file"), F.col("id").alias("ingestion_id"), F.col("id").alias("source_row_number"), F.current_timestamp().alias("ingested_at")
    )
    rows = rows.select("*", *[F.lit("x").alias(c) for c in RAW_COLUMNS if c not in rows.columns]).select(*RAW_COLUMNS)
    seen = []
    table = str(tmp_path / "table")
    with shared.unsorted_writes(spark):
        seen.append(spark.conf.get(name))
    landing.land(rows, table)
    assert seen == [str(shared.OPEN_FILES)] and spark.conf.get(name) == before
    stored = landing.read_landed(spark, table)
    assert {(r.source_file, r.ingestion_id) for r in stored.collect()} == {(f"d{k % many}", k) for k in range(200)}


def test_lines_are_parsed_once(spark, tmp_path):
    folder = str(tmp_path / "in")
    write(folder, "b.csv", ["UUID,REFID,Bookmaker", "u1,r1,  BM one  ", ",,", "u2,,", ",,x"])
    got = landing.landing_scan(spark, folder, with_raw_payload=False)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.lower().count("from_csv") + plan.lower().count("csvtostructs") == 1
    rows = got.orderBy("source_row_number").collect()
    assert [(r.source_row_number, r.source_uuid, r.refid, r.bookmaker) for r in rows] == [(2, "u1", "r1", "BM one"), (4, "u2", None, None), (5, None, None, "x")]


def test_multi_line_dumps_go_once_they_are_landed(spark, tmp_path, monkeypatch):
    items = [
        (k, k, k, k % 7 + 1, 1.0 + k % 30, 1000.0 + k, 0.01 * (k % 11), 0.01 * (k % 9), "ANR"[k % 3] if k % 10 else None, "OF"[k % 2], "1996-03-13")
        for k in range(60)
    ]
    names = "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate string"
    spark.createDataFrame(items, names).coalesce(1).write.parquet(f"{tmp_path}/lineitem.parquet")
    root = spark.conf.get("spark.checkpoint.dir")
    texts = lambda: {f"{at}/{n}" for at, _, found in os.walk(root) for n in found if n.endswith(".csv")}
    before, seen = texts(), []
    for rows in (1, 1 << 24):
        monkeypatch.setattr(catalog, "ROUND_ROWS", rows)
        seen.append(sorted(map(str, catalog.landing_multi_line(spark, str(tmp_path)).collect())))
        assert texts() == before
    assert seen[0] == seen[1] and len(seen[0]) == 60
    assert [len(r) for r in lineitem_dump.rounds_of_dumps(spark, str(tmp_path), 1)] == [1, 1, 1, 1]
    assert [len(r) for r in lineitem_dump.rounds_of_dumps(spark, str(tmp_path), 30)] == [2, 1, 1]
