"""Quoted cells with line breaks, whatever the size of the input splits."""

import json
import random
from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

from tallyward.sources import landing, quoted

COLUMNS = ["REFID", "Bet Details", "Venue"]


@contextmanager
def split_size(spark, size):
    name = "spark.sql.files.maxPartitionBytes"
    old = spark.conf.get(name)
    spark.conf.set(name, str(size))
    try:
        yield
    finally:
        spark.conf.set(name, old)


def cell(draw):
    words = ["a", "", "x y", "5\" pipe", "line\nbreak", "a,b", "two\n\nbreaks", "ends\\\\", "say \\\"hi\\\"\n,", "q\"\"q", "tail,\n", "\n", "é€"]
    text = draw.choice(words)
    quoted_cell = draw.random() < 0.3 or "\n" in text or "," in text
    if not quoted_cell:
        return text.replace("\\", "")
    return '"' + text.replace('"', '\\"').replace('\\\\"', '\\"') + '"'


def dump(seed, n=70):
    draw = random.Random(seed)
    return [f"r{k}," + cell(draw) + "," + cell(draw) for k in range(n)]


@pytest.mark.parametrize("seed", [1, 2])
def test_rows_equal_those_of_a_whole_file(spark, tmp_path, seed):
    """Against Spark's own reader, which reads such a file in one task."""
    path = tmp_path / "in" / "b.csv"
    path.parent.mkdir()
    path.write_text("\n".join([",".join(COLUMNS), *dump(seed)]) + "\n", encoding="utf-8")
    options = {"multiLine": True, "header": True, "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    whole = spark.read.options(**options).csv(str(path)).collect()
    assert [r["REFID"] for r in whole] == [f"r{k}" for k in range(70)]
    clean = lambda x: x if x is None else x.strip()
    want = [(k + 2, r["REFID"], clean(r["Bet Details"]), clean(r["Venue"])) for k, r in enumerate(whole)]
    for size in (90, 1 << 20):
        with split_size(spark, size):
            got = landing.landing_scan(spark, str(path.parent), multi_line=True)
            rows = got.select("source_row_number", "refid", "bet_details", "venue", "ingestion_id", "raw_payload").orderBy("source_row_number").collect()
        assert [tuple(r)[:4] for r in rows] == want
        assert len({r["ingestion_id"] for r in rows}) == len(rows)
        assert [json.loads(r["raw_payload"])["Bet Details"] for r in rows] == [w[2] for w in want]


def test_part_files_blank_lines_and_mixed_layouts(spark, tmp_path):
    folder = tmp_path / "in"
    parts = folder / "source_file=big.csv"
    parts.mkdir(parents=True)
    (parts / "part-0.csv").write_text('\n"RE\nFID",Venue\nr1,"a\nb"\n\nr3,x\n'.replace('"RE\nFID"', "REFID"))
    (parts / "part-1.csv").write_text('REFID,Venue\n"r\n4","c\n\nd"\n')
    (folder / "small.csv").write_bytes(b'"Venue",REFID\r\n"x\r\ny",s1\r\n')
    (folder / "none.csv").write_text("")
    want = [("big.csv", 2, "r1", "a\nb"), ("big.csv", 4, "r3", "x"), ("big.csv", 5, "r\n4", "c\n\nd"), ("small.csv", 2, "s1", "x\ny")]
    for size in (20, 1 << 20):
        with split_size(spark, size):
            rows = landing.landing_scan(spark, str(folder), multi_line=True).select("source_file", "source_row_number", "refid", "venue")
            assert sorted(map(tuple, rows.collect())) == want


def test_broken_dumps(spark, tmp_path):
    (tmp_path / "open").mkdir()
    (tmp_path / "open" / "b.csv").write_text('REFID,Venue\nr1,"never\nclosed\n')
    with pytest.raises(landing.BrokenRowsError, match="b.csv"):
        landing.landing_scan(spark, str(tmp_path / "open"), multi_line=True)
    rows = landing.landing_scan(spark, str(tmp_path / "open"), multi_line=True, tolerant=True)
    assert rows.count() <= 1
    (tmp_path / "over").mkdir()
    (tmp_path / "over" / "b.csv").write_text('REFID,Venue\nr1,x\n')
    assert landing.landing_scan(spark, str(tmp_path / "over"), multi_line=True).count() == 1


def test_line_functions(spark):
    lines = ['a,b', 'a,"b', 'a,"b"', '"a",b"', 'b"', 'b",c', '"', '""', 'a,"b\\"', 'x"y', '"a"x,b', '', 'b","c']
    table = spark.createDataFrame([(x,) for x in lines], "value string")
    got = table.select("value", quoted.ends_inside(F.col("value"), ",").alias("a"), quoted.ends_inside(F.concat(F.lit('"'), "value"), ",").alias("b"))
    functions = {r[0]: (int(r[1]), int(r[2])) for r in got.collect()}
    assert functions == {
        'a,b': (0, 1), 'a,"b': (1, 1), 'a,"b"': (0, 0), '"a",b"': (0, 0), 'b"': (0, 0), 'b",c': (0, 0), '"': (1, 0), '""': (0, 0),
        'a,"b\\"': (1, 1), 'x"y': (0, 1), '"a"x,b': (1, 1), '': (0, 1), 'b","c': (1, 1),
    }
