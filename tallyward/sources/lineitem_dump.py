"""Present a TPC-H ``lineitem`` table as a dirty 52-column bet dump.

Stands in for real exports wherever only the benchmark tables exist. It is a
single projection (no join, no shuffle): each line item becomes one text row,
with the accounting negatives, padded cells, spelled flags, missing cells and
repeated ids that the parsing and checking operators are there to handle.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyward.sources.contract import HEADER_TO_COLUMN, RAW_COLUMNS, TEXT_COLUMNS

SHEET = "bets"
# Row numbers of a many-part table: part number in the high bits, row in the low ones.
PART_SHIFT = 1 << 32
# Rows of a part file of a written dump, about 70 MB of text; there are as many parts as that takes.
PART_ROWS = 250_000


def _spelled(pick: str, *words: str) -> str:
    """One of the spellings, by ``pick`` modulo their number."""
    cases = " ".join(f"when {i} then {word}" for i, word in enumerate(words))
    return f"case ({pick}) % {len(words)} {cases} end"


def _padded(number: str) -> str:
    return f"lpad(string({number}), 2, '0')"


def _money(cents: str) -> str:
    """Cents as ``$1,234.56`` / ``1234.56`` / padded, with three ways to write a negative."""
    size = f"abs({cents})"
    fraction = f"'.' || {_padded(f'{size} % 100')}"
    grouped = (
        f"if({size} >= 100000, concat({size} div 100000, ',', lpad(string({size} div 100 % 1000), 3, '0')), "
        f"string({size} div 100)) || {fraction}"
    )
    plain = f"({size} div 100) || {fraction}"
    return (
        f"case line % 3 when 0 then if({cents} < 0, '($' || {grouped} || ')', '$' || {grouped}) "
        f"when 1 then if({cents} < 0, '-' || {plain}, {plain}) "
        f"else if({cents} < 0, ' (' || {grouped} || ') ', '  $' || {grouped} || ' ') end"
    )


# Typed view of a line item; each step may use the names of the earlier ones.
_STEPS = (
    {
        "file": "l_returnflag",
        "source_file": "concat('dump_', l_returnflag, '.csv')",
        "line": "l_linenumber",
        "part": "l_partkey",
        "supp": "l_suppkey",
        "ord": "l_orderkey",
        "ship": "date(l_shipdate)",
        "status": "l_linestatus",
        "position": f"file_part * {PART_SHIFT} + idx",
        "qty": "int(l_quantity)",
        "disc": "int(round(l_discount * 100))",
        "tax": "int(round(l_tax * 100))",
        "cents": "bigint(round(l_extendedprice * 100)) div 100",
        "quarter": "trunc(date(l_shipdate), 'quarter')",
    },
    {
        "clean": "file = 'R'",
        "month": "month(quarter)",
        "day_text": "string(quarter)",
        "half_part": "part div 2",
        "no_stake": "file <> 'R' and qty = 48 and line = 4",
        "zero_stake": "file <> 'R' and qty = 50",
        "cancelled": "file <> 'R' and tax = 8 and status = 'F'",
        "no_event": "file <> 'R' and line = 7 and status = 'O'",
        "no_date": "file = 'A' and qty = 2 and line = 7",
        "own_time": "line = 3 and qty = 1",
        # Negative stakes: a floor on the discount per file, with a few odd years.
        "negative": """disc >= case file when 'A' then 9 when 'N' then if(year(quarter) = 1998, 4, 7)
                       else case year(quarter) when 1999 then 8 when 2000 then 10 when 2001 then 9 else 99 end end""",
    },
    {
        "win_cents": "case when no_stake then null when zero_stake then 0 when negative then -cents else cents end",
        "place_cents": """case when no_stake or line = 2 then null
                          when line = 6 and not zero_stake and not negative then 500 + part % 100 else 0 end""",
        "win_payout": """case when clean then cents div 2 when file = 'A' and tax >= 5 then 2 * cents
                         when file = 'N' and tax >= 7 and month in (1, 7) then 2 * cents else 0 end""",
        "place_payout": """case when line = 2 then null
                           when file = 'A' and line = 6 and tax >= 5 then 700 else 0 end""",
    },
)

_CELLS = {
    "refid": "if(qty = 7, '  ', 'REF' || ord)",
    "source_uuid": """case when clean then concat('r-', ord, '-', line)
                      when (qty = 50 and line = 1) or (qty = 49 and line = 2) then '   '
                      when file = 'A' then concat('a', half_part, '-', replace(left(day_text, 7), '-', ''))
                      when supp % 4 = 0 then ' n' || part
                      else concat('n', part, '-', replace(left(day_text, 7), '-', '')) end""",
    "license": "'LIC-1'",
    "bookmaker": "if(supp % 50 <> 49, 'BM' || (supp % 7), null)",
    "location": "'Site ' || (supp % 5)",
    "state": _spelled("supp", "'NSW'", "'VIC'", "'QLD'", "null"),
    "area": "'Metro'",
    "wagering_provider": "'WP' || (supp % 2)",
    "sys_ver_no": "'1.0'",
    "bet_date": """case when no_date then null when own_time then day_text || 'T09:30:00'
                   when line = 5 then day_text || 'T00:00:00' else day_text end""",
    "bet_time": f"""if(own_time, null,
                    concat_ws(':', {_padded('ord % 24')}, {_padded('part % 60')}, {_padded('supp % 60')}))""",
    "event_date": "if(no_event, null, string(ship))",
    "event_time": f"if(no_event or line = 1, null, {_padded('supp % 24')} || ':30:00')",
    "ticket_no": """case when clean then concat_ws('-', part, supp, cents)
                    when qty = 50 and line = 1 then null else 'T' || (half_part % 100) end""",
    "event_category": _spelled("supp", "'RACING'", "'GREYHOUNDS'", "' SPORT '"),
    "sport_event": "'Meeting ' || (part % 50)",
    "venue": "'Venue ' || (supp % 20)",
    "venue_state": _spelled("supp % 20", "'NSW'", "'VIC'", "'QLD'", "null"),
    "bet_type": "if(line = 6, 'PLACE', 'WIN')",
    "bet_method": _spelled("ord", "'Terminal'", "'Phone'", "'Online'"),
    "bet_details": "null",
    "race_number": "case when qty = 3 then null when line = 4 then '4.0' when line = 5 then ' 5 ' else string(line) end",
    "runner_number": "if(part % 200 = 0, 'n/a', string(qty))",
    "runner_name": "'Runner ' || part",
    "bet_amount_win": _money("win_cents"),
    "bet_amount_place": _money("place_cents"),
    "win_price": "(part % 900 + 100) || '.125'",
    "place_price": f"'1.' || {_padded('part % 100')}",
    "customer_name": """case when supp % 10 < 3 then null
                        when line % 3 = 0 then '  Customer ' || lpad(string(ord div 10), 9, '0')
                        when line % 3 = 1 then 'customer   ' || lpad(string(ord div 10), 9, '0')
                        else 'CUSTOMER' || chr(9) || lpad(string(ord div 10), 9, '0') || ' ' end""",
    "betback_claim": "null",
    "bet_information": "if(qty = 5, ' fixed odds ', null)",
    "cancelled_flag": f"""case when cancelled then {_spelled("line", "'Y'", "'yes'", "'TRUE'", "' 1 '")}
                          when qty = 20 then null
                          else {_spelled("line", "'N'", "'no'", "'FALSE'", "' 0 '")} end""",
    "time_cancelled": f"if(cancelled, concat('13:', {_padded('part % 60')}, ':00'), null)",
    "bet_win_takeout": "if(line = 1, '0.1550', null)",
    "bet_place_takeout": "if(line = 1, '.2', null)",
    "horse_win_takeout": "null",
    "horse_win_hold": "'$' || part",
    "horse_place_takeout": "null",
    "horse_place_hold": "if(line = 2, '(12.34567)', null)",
    "race_hold": "(supp * 1000) || '.00005'",
    "betback_information": "null",
    "betback_flag": "if(qty = 11, 'maybe', 'N')",
    "refund_flag": "if(qty = 10, 'Yes', 'No')",
    "placing_position": "if(win_payout > 0, '1st', null)",
    "win_deduction": "if(line = 3, '-0.05', null)",
    "place_deduction": "null",
    "win_result": "if(win_payout > 0, '1', '0')",
    "place_result": "'()'",
    "win_payout_amount": _money("win_payout"),
    "place_payout_amount": _money("place_payout"),
    "paid_status": "if(win_payout > 0, 'Paid', 'Unpaid')",
    "bet_terminal": f"'TERM-' || {_padded('supp % 40')}",
}


def _items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with the place they are read from."""
    items = spark.read.parquet(f"{sf_dir}/lineitem.parquet").selectExpr(
        "*",
        "_metadata.row_index as idx",
        "bigint(coalesce(nullif(regexp_extract(_metadata.file_name, 'part-([0-9]+)', 1), ''), '0')) as file_part",
    )
    numbers = [re.search(r"part-([0-9]+)", name.rsplit("/", 1)[-1]) for name in items.inputFiles()]
    if len(numbers) > 1 and (None in numbers or len({int(n[1]) for n in numbers}) < len(numbers)):
        raise ValueError("several files need distinct part numbers in their names, or their rows would share positions")
    return items


def _raw(rows: DataFrame) -> DataFrame:
    """Raw landing rows from line items; partitions and their order stay."""
    for step in _STEPS:
        rows = rows.selectExpr("*", *[f"{expression} as {name}" for name, expression in step.items() if name not in rows.columns])
    return rows.selectExpr(
        "position + 1 as ingestion_id",
        "source_file",
        f"'{SHEET}' as source_sheet",
        "position + 2 as source_row_number",
        "timestamp'2026-01-01 00:00:00' as ingested_at",
        *[f"string({_CELLS[c]}) as {c}" for c in TEXT_COLUMNS],
        "string(null) as raw_payload",
    ).select(*RAW_COLUMNS)


def lineitem_raw(spark: SparkSession, sf_dir: str, spread: int | None = None) -> DataFrame:
    """Raw landing rows (without payload) from ``<sf_dir>/lineitem.parquet``.

    ``spread`` deals the rows to so many tasks first: for a table of a single row
    group, which one task would read.
    """
    items = _items(spark, sf_dir)
    return _raw(items if spread is None else items.repartition(spread, "idx"))


def _items_of_dumps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _items(spark, sf_dir).withColumn("source_file", F.expr(_STEPS[0]["source_file"]))


def rounds_of_dumps(spark: SparkSession, sf_dir: str, rows: int) -> list[list[str | None]]:
    """All dumps of the table, some at a time: as many as have up to ``rows`` rows together, or one that is longer."""
    rounds, held = [], 0
    for name, n in _items_of_dumps(spark, sf_dir).groupBy("source_file").count().orderBy("source_file").collect():
        if not rounds or held + n > rows:
            rounds.append([])
            held = 0
        rounds[-1].append(name)
        held += n
    return rounds


def lineitem_in_order(spark: SparkSession, sf_dir: str, least_parts: int = 8, dumps: Sequence[str | None] | None = None) -> DataFrame:
    """The same rows (of the named dumps) ordered by dump and row number over all partitions, of about ``PART_ROWS`` rows each.

    Line items are ordered, and each becomes its text row behind the shuffle: as text they are seven times as wide.
    """
    items = _items_of_dumps(spark, sf_dir)
    if dumps is not None:
        named = F.col("source_file").isin([name for name in dumps if name is not None])
        items = items.where(F.when(F.col("source_file").isNull(), None in dumps).otherwise(named))
    parts = max(least_parts, -(-items.count() // PART_ROWS))
    place = ["source_file", "file_part", "idx"]
    return _raw(items.repartitionByRange(parts, *place).sortWithinPartitions(*place))


def blank_position() -> Column:
    """Rows that a written dump leaves wholly blank."""
    return (F.col("source_file") == "dump_A.csv") & (F.col("runner_number") == "33")


def write_dumps(raw: DataFrame, folder: str, compression: str = "none") -> str:
    """Write raw rows that are in order as CSV dumps, one ``source_file=<name>`` directory each."""
    headers = {column: header for header, column in HEADER_TO_COLUMN.items()}
    cells = [F.when(~blank_position(), F.col(c)).alias(headers[c]) for c in TEXT_COLUMNS]
    (
        raw.select("source_file", *cells)
        .write.partitionBy("source_file")
        .option("header", True)
        .option("compression", compression)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(folder)
    )
    return folder
