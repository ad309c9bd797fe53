from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallyward.functions import parsing as P

# text, money, integer, flag
CASES = [
    (None, None, None, None),
    ("", None, None, None),
    ("   ", None, None, None),
    ("$1,000.00", "1000.00", 100000, None),
    ("($10.00)", "-10.00", 1000, None),
    ("  (10)  ", "-10.00", 10, None),
    ("(-5)", "-5.00", -5, None),
    ("()", None, None, None),
    ("-$3.5", "-3.50", -35, None),
    ("1.005", "1.01", 1005, None),
    ("-1.005", "-1.01", -1005, None),
    ("3.0", "3.00", 30, None),
    ("abc", None, None, None),
    ("(line\n12)", "-12.00", 12, None),
    ("y", None, None, True),
    (" Yes ", None, None, True),
    ("TRUE", None, None, True),
    ("1", "1.00", 1, True),
    ("n", None, None, False),
    ("No", None, None, False),
    ("false", None, None, False),
    ("0", "0.00", 0, False),
    ("maybe", None, None, None),
]


def test_amounts_integers_and_flags(spark):
    df = spark.createDataFrame([(c[0],) for c in CASES], "s string")
    rows = df.select(
        "s",
        P.parse_money(F.col("s")).alias("money"),
        P.parse_integer(F.col("s")).alias("whole"),
        P.parse_boolean_flag(F.col("s")).alias("flag"),
    ).collect()
    for row, (text, money, whole, flag) in zip(rows, CASES):
        assert row.money == (None if money is None else Decimal(money)), text
        assert row.whole == whole, text
        assert row.flag is flag, text


def test_decimal_keeps_four_places_half_up(spark):
    df = spark.createDataFrame([("1.00005",), ("(12.34567)",), (".2",), ("$1,234",)], "s string")
    got = [r.d for r in df.select(P.parse_decimal(F.col("s")).alias("d")).collect()]
    assert got == [Decimal("1.0001"), Decimal("-12.3457"), Decimal("0.2000"), Decimal("1234.0000")]


@pytest.mark.parametrize("text", ["1-2", "5-", "-"])
def test_malformed_amount_fails_when_strict_and_is_null_when_tolerant(spark, text):
    df = spark.createDataFrame([(text,)], "s string")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        df.select(P.parse_money(F.col("s"))).collect()
    row = df.select(
        P.parse_money(F.col("s"), P.TOLERANT).alias("m"), P.parse_integer(F.col("s"), P.TOLERANT).alias("i")
    ).first()
    assert row.m is None and row.i is None


def test_source_timestamps(spark):
    cases = [
        ("2026-03-01T00:00:00", "12:04:05", datetime(2026, 3, 1, 12, 4, 5)),
        ("2026-03-01T09:30:00", "12:04", datetime(2026, 3, 1, 12, 4)),
        ("2026-03-01T09:30:00", None, datetime(2026, 3, 1, 9, 30)),
        ("2026-03-01T09:30:00", "  ", datetime(2026, 3, 1, 9, 30)),
        (" 2026-03-01 ", None, datetime(2026, 3, 1)),
        ("2026-3-1", "1:02:03", datetime(2026, 3, 1, 1, 2, 3)),
        (None, "12:00", None),
        ("  ", "12:00", None),
    ]
    df = spark.createDataFrame([c[:2] for c in cases], "d string, t string")
    got = [r.ts for r in df.select(P.parse_source_timestamp(F.col("d"), F.col("t")).alias("ts")).collect()]
    assert got == [c[2] for c in cases]


def test_extra_date_formats_and_tolerant_dates(spark):
    df = spark.createDataFrame([("01/03/2026", "12:00:00"), ("junk", None)], "d string, t string")
    with pytest.raises(Exception):
        df.select(P.parse_source_timestamp(F.col("d"), F.col("t"))).collect()
    got = [
        r.ts
        for r in df.select(
            P.parse_source_timestamp(F.col("d"), F.col("t"), P.TOLERANT, ["dd/MM/yyyy"]).alias("ts")
        ).collect()
    ]
    assert got == [datetime(2026, 3, 1, 12), None]


def test_clean_text_strips_spaces_only(spark):
    df = spark.createDataFrame([(" a ",), ("\ta ",), (" ",), (None,)], "s string")
    assert [r.c for r in df.select(P.clean_text(F.col("s")).alias("c")).collect()] == ["a", "\ta", None, None]


def test_customer_names(spark):
    df = spark.createDataFrame([("  jo\t  Ann ",), ("\t\n",), (None,)], "s string")
    got = [r.c for r in df.select(P.normalize_customer_name(F.col("s")).alias("c")).collect()]
    assert got == ["JO ANN", None, None]


def test_cells_to_text(spark):
    from tallyward.sources.landing import cells_to_text

    df = spark.sql(
        """select timestamp_ntz'2026-03-01 12:30:29' as a, timestamp_ntz'2026-03-01 12:30:29.5' as b,
        date'2026-03-01' as c, true as d, ' \t$1,000.00 ' as e, 7 as f, 12345678.5D as g, 1.0D as h,
        cast(null as string) as i, 20000000D as j"""
    )
    row = cells_to_text(df, df.columns).first()
    assert list(row) == [
        "2026-03-01T12:30:29", "2026-03-01T12:30:29.500000", "2026-03-01", "true", "$1,000.00", "7",
        "12345678.5", "1.0", None, "20000000.0",
    ]


def test_cells_lose_all_white_space_of_unicode(spark):
    points = [chr(c) for c in range(1, 0x3100) if not 0xD800 <= c < 0xE000] + ["﻿", "🙂"]
    cells = spark.createDataFrame([(f"{c}{c}a{c}b{c}",) for c in points] + [(None,), ("",), (" \t　",)], "cell string")
    found = cells.select("cell", P.cell_to_text(F.col("cell")).alias("got"), F.regexp_replace("cell", r"(?U)^\s+|\s+\z", "").alias("stripped"))
    assert found.where(~F.col("got").eqNullSafe(F.col("stripped"))).collect() == []
    assert "regexp_replace" not in cells.select(P.cell_to_text(F.col("cell")))._jdf.queryExecution().optimizedPlan().toString()
