"""Landing: read dumps as text with provenance, check headers, append or replace by file.

A dump is either one file or a ``source_file=<name>`` directory of part files;
the directory form is what a dump too large for one file looks like. Either way
its rows are numbered from 2 in (part name, position) order, header being row 1.

Everything a run wants to know about its files comes from one listing and one
pass over the text (``open_dumps``): which dumps there are, empty ones included,
their headers, and where each input split starts counting. A second pass reads
the data.
"""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyward.functions.parsing import cell_to_text
from tallyward.sources import quoted
from tallyward.sources.contract import HEADER_TO_COLUMN, HEADERS, RAW_COLUMNS, RAW_SCHEMA, TEXT_COLUMNS
from tallyward.sources.shared import cut, unsorted_writes

FORMATS = ("csv", "json", "parquet")
# Dumps whose columns are read at once.
SCHEMA_READS = 8
# Places of splits are sent to every task up to this size, and joined by shuffle beyond.
BROADCAST_BYTES = 128 << 20
# The columns of a preview.
PREVIEW_COLUMNS = (
    "refid",
    "bookmaker",
    "bet_date",
    "bet_time",
    "sport_event",
    "bet_type",
    "bet_amount_win",
    "customer_name",
)


class UnknownHeadersError(ValueError):
    """A dump carries headers outside the contract."""


class BrokenRowsError(ValueError):
    """A dump holds lines that can't be read as rows."""


@dataclass(frozen=True)
class Dumps:
    """What the listing and the first pass found.

    files: (file_path, source_file) of every file, empty ones too. places: one row
    per input split with its first data row's id (``first``), its ``last`` id, how
    many rows its dump has before it, and its file's ``header``. broken: lines per
    file that are no rows.
    """

    path: str | list[str]
    fmt: str
    sep: str
    multi_line: bool
    files: DataFrame
    places: DataFrame
    headers: DataFrame
    broken: DataFrame

    def names(self) -> DataFrame:
        return self.files.select("source_file").distinct()


def _dump_name() -> Column:
    """Name of the ``source_file=`` directory, or else of the file."""
    folder = F.regexp_extract(F.col("_metadata.file_path"), r"/source_file=([^/]+)/[^/]+$", 1)

    def unescape(text: Column) -> Column:
        return F.url_decode(F.replace(text, F.lit("+"), F.lit("%2B")))

    # Names are URL-encoded, and partition directories escape special characters themselves.
    return F.when(folder != "", unescape(unescape(folder))).otherwise(unescape(F.col("_metadata.file_name")))


def _lines(spark: SparkSession, path) -> DataFrame:
    """(value, _path, source_file, _block, _id) of every line."""
    return spark.read.option("recursiveFileLookup", True).text(path).select(
        "value",
        F.col("_metadata.file_path").alias("_path"),
        _dump_name().alias("source_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_id"),
    )


def _parsed(line: Column, sep: str, width: int) -> Column:
    """Cells of a delimited line, by the CSV reader's own rules."""
    schema = T.StructType([T.StructField(f"_c{i}", T.StringType()) for i in range(width)])
    options = {"sep": sep, "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    return F.from_csv(line, schema.simpleString(), options)


def _as_array(parsed: Column, width: int) -> Column:
    return F.array(*[parsed[f"_c{i}"] for i in range(width)])


def _header_cells(top: DataFrame, sep: str) -> DataFrame:
    """(_path, header) from the header line (``_header``) of each file."""
    # At least as many columns as the widest header has; quoted separators only add empty ones.
    seps = (F.length("_header") - F.length(F.replace("_header", F.lit(sep), F.lit("")))) / len(sep)
    width = int(top.agg(F.max(seps)).first()[0] or 0) + 1
    line = F.regexp_replace("_header", "^\ufeff", "")
    header = F.transform(_as_array(_parsed(line, sep, width), width), lambda h: F.trim(F.regexp_replace(h, "^\ufeff", "")))
    # Empty names behind the last column are none.
    size = F.array_max(F.transform(header, lambda h, i: F.when(h.isNotNull() & (h != ""), i + 1).otherwise(0)))
    return top.select("_path", F.slice(header, 1, F.greatest(size, F.lit(0))).alias("header"))


def _csv_places(lines: DataFrame, sep: str) -> tuple[DataFrame, DataFrame]:
    """Splits with the header that starts their file, and broken lines per file."""
    filled = F.trim("value") != ""
    odd = (F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))) % 2
    opens = (F.col("_block") == 0) & filled
    found = lines.groupBy("_path", "source_file", "_block").agg(
        F.min("_id").alias("_from"),
        F.max("_id").alias("last"),
        F.min(F.when(opens, F.col("_id"))).alias("_header_id"),
        F.min_by("value", F.when(opens, F.col("_id"))).alias("_header"),
        F.sum(odd.cast("long")).alias("broken"),
        # Collected, so that Spark aggregates by hash although the header is text; it would sort all lines else.
        F.collect_set(F.when(opens, F.lit(True))).alias("_opens"),
    )
    splits = cut(found.withColumn("first", F.coalesce(F.col("_header_id") + 1, "_from")), "splits")
    top = _header_cells(splits.where(F.col("_header").isNotNull()).select("_path", "_header"), sep)
    places = splits.drop("_header", "_header_id", "_from", "_opens", "broken").join(top, "_path", "left")
    return places, splits.groupBy("source_file").agg(F.sum("broken").alias("broken"))


def _quoted_places(lines: DataFrame, sep: str) -> tuple[DataFrame, DataFrame]:
    """The same where cells hold line breaks; places within a split count from 0. Broken: files that end inside a cell, and headers that reach over a split."""
    splits = cut(quoted.begin_states(cut(quoted.read_splits(lines, sep), "read_splits")), "splits")
    top = _header_cells(splits.where(F.col("_header").isNotNull()).select("_path", "_header"), sep)
    places = splits.select(
        "_path", "source_file", "_block", F.coalesce(F.col("header_at") + 1, F.lit(0)).alias("first"), (F.col("rows") - 1).alias("last"), "begins", "ends"
    ).join(top, "_path", "left")
    open_end = F.col("is_last") & (F.col("ends") == quoted.INSIDE)
    cut_header = (F.col("_block") == 0) & F.col("_header").isNull() & (F.col("ends") == quoted.INSIDE)
    return places, splits.groupBy("source_file").agg(F.sum((open_end | cut_header).cast("long")).alias("broken"))


def _json_places(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    keys = F.json_object_keys("value")
    blank = F.trim("value") == ""
    # One pass: a row per key, and one without for the line itself.
    seen = lines.select(
        "_path", "source_file", "_block", "_id",
        (keys.isNull() & ~blank).cast("long").alias("broken"),
        F.explode(F.array_append(F.coalesce(keys, F.array().cast("array<string>")), F.lit(None))).alias("key"),
    ).groupBy("_path", "source_file", "_block", F.trim("key").alias("key")).agg(
        F.min("_id").alias("first"), F.max("_id").alias("last"), F.sum(F.when(F.col("key").isNull(), F.col("broken"))).alias("broken")
    )
    seen = cut(seen, "splits")
    names = seen.where(F.col("key").isNotNull()).groupBy("_path").agg(F.array_sort(F.collect_set("key")).alias("header"))
    splits = seen.where(F.col("key").isNull()).select("_path", "source_file", "_block", "first", "last")
    broken = seen.groupBy("source_file").agg(F.coalesce(F.sum("broken"), F.lit(0)).alias("broken"))
    return splits.join(names, "_path", "left"), broken


def _numbered_places(places: DataFrame) -> DataFrame:
    """Add ``before``: rows of the dump ahead of the split. One narrow row per split is ordered per dump."""
    earlier = Window.partitionBy("source_file").orderBy("_path", "_block").rowsBetween(Window.unboundedPreceding, -1)
    return places.withColumn("before", F.coalesce(F.sum(F.col("last") - F.col("first") + 1).over(earlier), F.lit(0)))


def _columns_by_dump(spark: SparkSession, files: DataFrame) -> DataFrame:
    """(source_file, header) of columnar dumps: Spark merges the footers of each dump's own files, a few dumps at a time."""

    def columns(dump: Row) -> list[tuple[str, str]]:
        return [(dump.source_file, c) for c in spark.read.option("mergeSchema", True).parquet(*dump.files).columns]

    listed = files.groupBy("source_file").agg(F.collect_list("file_path").alias("files")).collect()
    with ThreadPoolExecutor(SCHEMA_READS) as pool:
        found = [pair for pairs in pool.map(columns, listed) for pair in pairs]
    return spark.createDataFrame(found, "source_file string, header string")


def open_dumps(
    spark: SparkSession,
    path: str | Sequence[str],
    fmt: str = "csv",
    sep: str = ",",
    limit_files: int | None = None,
    multi_line: bool = False,
) -> Dumps:
    """List the dumps under ``path`` and go over their text once.

    ``limit_files`` keeps the first dumps by name before anything is read.
    ``multi_line`` allows line breaks inside quoted cells; see ``sources.quoted``.
    """
    if fmt not in FORMATS:
        raise ValueError(f"unknown format {fmt}, expected one of {FORMATS}")
    path = [path] if isinstance(path, str) else list(path)
    listing = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    files = listing.select(
        F.col("_metadata.file_path").alias("file_path"), _dump_name().alias("source_file"), F.col("path").alias("raw_path")
    )
    if limit_files is not None:
        kept = files.select("source_file").distinct().orderBy("source_file").limit(limit_files)
        files = files.join(kept, "source_file", "left_semi")
        folder = F.regexp_extract("raw_path", r"^(.*/source_file=[^/]+)/[^/]+$", 1)
        # One place per dump that is kept.
        path = [r[0] for r in files.select(F.when(folder != "", folder).otherwise(F.col("raw_path"))).distinct().collect()]
    files = cut(files.select("file_path", "source_file"), "files")
    nothing = spark.createDataFrame([], "source_file string, broken long")
    if fmt == "parquet":
        headers = _columns_by_dump(spark, files)
        return Dumps(path, fmt, sep, False, files, spark.createDataFrame([], "_path string"), headers, nothing)
    if not path:
        places = spark.createDataFrame([], "_path string, source_file string, _block long, first long, last long, header array<string>, before long")
        return Dumps(path, fmt, sep, multi_line, files, places, spark.createDataFrame([], "source_file string, header string"), nothing)
    lines = _lines(spark, path)
    if fmt == "json":
        places, broken = _json_places(lines)
    else:
        places, broken = _quoted_places(lines, sep) if multi_line else _csv_places(lines, sep)
    places = cut(_numbered_places(places), "places")
    headers = places.select("source_file", F.explode("header").alias("header")).where("header <> ''").distinct()
    return Dumps(path, fmt, sep, multi_line, files, places, headers, broken)


def dump_headers(
    spark: SparkSession, path: str | Sequence[str], fmt: str = "csv", sep: str = ","
) -> DataFrame:
    """(dump, header) pairs found in the files of a directory."""
    found = open_dumps(spark, path, fmt, sep).headers
    return found.select("source_file", F.trim("header").alias("header")).distinct()


def check_headers(headers: DataFrame) -> DataFrame:
    """Headers outside the contract, per dump; empty means the dumps may be landed."""
    return headers.where(~F.col("header").isin(HEADERS)).select("source_file", "header")


def require_known_headers(headers: DataFrame) -> None:
    """Raise with every unknown name."""
    unknown = check_headers(headers).agg(F.array_sort(F.collect_set("header"))).first()[0]
    if unknown:
        raise UnknownHeadersError(f"unknown source headers: {unknown}")


def require_whole_rows(dumps: Dumps) -> None:
    """Raise when lines of a dump are no rows: an open quote, or text that is no JSON object."""
    broken = dumps.broken.where("broken > 0").agg(F.count("*"), F.sum("broken"), F.min("source_file")).first()
    if broken[0]:
        hint = "; multi_line reads cells with line breaks" if dumps.fmt == "csv" else ""
        raise BrokenRowsError(f"{broken[1]} broken lines in {broken[0]} dumps, the first of them {broken[2]}{hint}")


def rename_headers(dump: DataFrame) -> DataFrame:
    """Source headers to landing columns; other columns keep their name."""
    return dump.withColumnsRenamed(
        {c: HEADER_TO_COLUMN[c.strip()] for c in dump.columns if c.strip() in HEADER_TO_COLUMN}
    )


def fill_contract(df: DataFrame) -> DataFrame:
    """Absent contract columns become NULL text."""
    missing = [c for c in TEXT_COLUMNS if c not in df.columns]
    return df.withColumns({c: F.lit(None).cast("string") for c in missing}) if missing else df


def cells_to_text(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Render the named columns as landing text, whatever their type."""
    kinds = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    return df.withColumns({c: cell_to_text(F.col(f"`{c}`"), kinds[c]) for c in columns})


def drop_blank_rows(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Leave out rows where every named cell is NULL."""
    return df.dropna(how="all", subset=list(columns))


def with_payload(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Keep the dump's own header -> text object as JSON, NULL cells included."""
    headers = {column: header for header, column in HEADER_TO_COLUMN.items()}
    payload = F.struct(*[F.col(c).alias(headers[c]) for c in columns])
    return df.withColumn("raw_payload", F.to_json(payload, {"ignoreNullFields": "false"}))


def number_rows(scanned: DataFrame) -> DataFrame:
    """Add ``source_row_number`` from the (block, id) coordinates of a file scan.

    Row ids grow within a file block. Counting rows per block and summing the
    counts of the earlier blocks of a dump gives each block one offset; the rows
    themselves are never sorted or shuffled. The broadcast side has one narrow
    row per input split (about 30 MB for 100 TB in 128 MB splits).
    """
    coordinates = scanned.select(
        "source_file", "_path", "_block", "_id", F.shiftright("_id", 33).alias("_task")
    )
    blocks = coordinates.groupBy("source_file", "_path", "_block", "_task").agg(
        F.min("_id").alias("_first"), F.max("_id").alias("_last")
    )
    earlier = (
        Window.partitionBy("source_file")
        .orderBy("_path", "_block")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    rows_before = F.coalesce(F.sum(F.col("_last") - F.col("_first") + 1).over(earlier), F.lit(0))
    offsets = blocks.select(
        "_task", "_first", "_last", (rows_before - F.col("_first") + 2).alias("_offset")
    )
    located = scanned.withColumn("_task", F.shiftright("_id", 33))
    return (
        located.join(
            offsets.withColumnRenamed("_task", "_block_task"),
            (F.col("_task") == F.col("_block_task")) & F.col("_id").between(F.col("_first"), F.col("_last")),
        )
        .withColumn("source_row_number", F.col("_id") + F.col("_offset"))
        .drop("_task", "_block_task", "_first", "_last", "_offset")
    )


def _with_coordinates(rows: DataFrame) -> DataFrame:
    """Add where each row stands, and whether any of its cells is filled.

    The test for blank rows belongs here, next to the cells as read: as a filter
    over 52 derived columns it would have Catalyst derive a constraint for every
    subset of them.
    """
    cells = [F.col(f"`{c}`") for c in rows.columns]
    return rows.select(
        *cells,
        F.coalesce(*[c.cast("string") for c in cells]).isNotNull().alias("_filled"),
        _dump_name().alias("source_file"),
        F.col("_metadata.file_path").alias("_path"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_id"),
    )


def _small(places: DataFrame) -> bool:
    """Whether every task can have the places of all splits: by the bytes of their columns, headers included."""
    size = F.lit(0).cast("long")
    for field in places.schema.fields:
        text = isinstance(field.dataType, (T.StringType, T.ArrayType))
        size = size + (F.coalesce(F.octet_length(F.to_json(F.struct(field.name))), F.lit(0)) + 16 if text else 8)
    return (places.agg(F.sum(size)).first()[0] or 0) <= BROADCAST_BYTES


def _placed(lines: DataFrame, dumps: Dumps, *more: str, at: str = "_id") -> DataFrame:
    """Data rows with ``source_row_number``; header lines, and dumps that aren't wanted, fall away. ``at``: what ``first`` and ``last`` count."""
    places = dumps.places.select("_path", "_block", "first", "last", "before", *more)
    if _small(places):
        places = F.broadcast(places)
    inside = F.col(at) >= F.col("first")
    # Both passes split the files alike; if a listing changed in between, stop rather than misnumber.
    checked = F.when(F.col(at) <= F.col("last"), F.col(at) - F.col("first") + F.col("before") + 2).otherwise(
        F.raise_error(F.lit("the files changed while they were landed")).cast("long")
    )
    return lines.join(places, ["_path", "_block"]).where(inside).withColumn("source_row_number", checked)


def _csv_rows(spark: SparkSession, dumps: Dumps, extra_cells: str) -> tuple[DataFrame, list[str] | None]:
    """Rows with their cells as contract columns; the layout if all files share one, else a ``cells`` map."""
    lines, at = _lines(spark, dumps.path), "_id"
    if dumps.multi_line:
        states = dumps.places.select("_path", "_block", "begins", "ends")
        lines, at = quoted.read_rows(lines, states, dumps.sep, _small(states)), "_at"
    layouts = dumps.places.where(F.col("header").isNotNull()).select("header").distinct().limit(2).collect()
    beyond = F.raise_error(F.concat(F.lit("a row has more cells than its header has names, in "), F.col("source_file"))).cast("string")
    if len(layouts) <= 1:
        headers = list(layouts[0].header) if layouts else list(HEADERS)
        width = len(headers) + 1
        # Generated, not projected: the filter of blank rows would be pushed below a projection, and parse each line again.
        rows = _placed(lines, dumps, at=at).select("source_file", "_path", "_id", "source_row_number", F.inline(F.array(_parsed(F.col("value"), dumps.sep, width))))
        cells = {h: F.col(f"_c{i}") for i, h in enumerate(headers) if h}
        over = F.col(f"_c{width - 1}").isNotNull()
        keep = [F.when(over, beyond).otherwise(c) if extra_cells == "raise" and k == 0 else c for k, c in enumerate(cells.values())]
        return rows.select("source_file", "_path", "_id", "source_row_number", *[c.alias(h) for h, c in zip(cells, keep)]), list(cells)
    # Files differ in their columns: cells by position, named by each file's own header.
    width = (dumps.places.agg(F.max(F.size("header"))).first()[0] or 0) + 1
    rows = _placed(lines, dumps, "header", at=at)
    rows = rows.withColumn("cells", _as_array(_parsed(F.col("value"), dumps.sep, width), width))
    n = F.size("header")
    named = F.filter(F.arrays_zip(F.col("header").alias("h"), F.slice("cells", 1, n).alias("c")), lambda e: e["h"] != "")
    over = F.exists(F.slice("cells", n + 1, width), lambda c: c.isNotNull())
    cells = F.map_from_entries(named)
    if extra_cells == "raise":
        cells = F.when(over, F.map_from_arrays(F.array(beyond), F.array(beyond))).otherwise(cells)
    return rows.select("source_file", "_path", "_id", "source_row_number", cells.alias("cells")), None


def _json_rows(spark: SparkSession, dumps: Dumps) -> DataFrame:
    lines = _lines(spark, dumps.path)
    own = F.transform_keys(F.from_json("value", "map<string,string>"), lambda k, v: F.trim(k))
    # The names of the file, in the row's own spelling of the values; a line that is no object keeps its text.
    whole = F.map_from_arrays("header", F.transform("header", lambda h: F.element_at(F.col("_own"), h)))
    return _placed(lines, dumps, "header").withColumn("_own", own).select(
        "source_file", "_path", "_id", "source_row_number",
        F.when(F.json_object_keys("value").isNotNull(), whole).alias("cells"),
        F.when(F.json_object_keys("value").isNull() & (F.trim("value") != ""), F.col("value")).alias("_broken"),
    )


def landing_scan(
    spark: SparkSession,
    path: str | Sequence[str] | None = None,
    fmt: str = "csv",
    sheet: str = "bets",
    sep: str = ",",
    limit_files: int | None = None,
    limit_rows: int | None = None,
    first_id: int = 1,
    with_raw_payload: bool = True,
    multi_line: bool = False,
    tolerant: bool = False,
    extra_cells: str = "raise",
    dumps: Dumps | None = None,
) -> DataFrame:
    """Read every dump under ``path`` (or of ``dumps``) into the raw landing shape.

    Unknown headers are an error; absent ones become NULL. Lines that are no rows
    are an error too; ``tolerant`` keeps them, as rows whose payload is the line
    (JSON) or as the reader takes them (CSV). ``extra_cells`` beyond the header
    "raise" or "drop". ``first_id`` starts the ingestion ids, which stay unique and
    follow scan order.
    """
    dumps = dumps or open_dumps(spark, path, fmt, sep, limit_files, multi_line)
    require_known_headers(dumps.headers.select("source_file", F.trim("header").alias("header")))
    if not tolerant:
        require_whole_rows(dumps)
    headers: list[str] | None = None
    if not dumps.path:
        rows = spark.createDataFrame([], "source_file string, _path string, _id long, source_row_number long")
        headers = []
    elif dumps.fmt == "csv":
        rows, headers = _csv_rows(spark, dumps, extra_cells)
    elif dumps.fmt == "json":
        rows = _json_rows(spark, dumps)
    else:
        read = spark.read.option("recursiveFileLookup", True).option("mergeSchema", True).parquet(*dumps.path)
        headers = list(read.columns)
        rows = number_rows(_with_coordinates(read)).where("_filled")
    if headers is not None:
        columns = [HEADER_TO_COLUMN[h.strip()] for h in headers]
        cells = F.coalesce(*[F.col(f"`{h}`").cast("string") for h in headers]) if headers else F.lit(None).cast("string")
        filled = rows if dumps.fmt == "parquet" else rows.withColumn("_any", cells).where("_any is not null").drop("_any")
        landed = cells_to_text(rename_headers(filled), columns)
        landed = with_payload(landed, columns) if with_raw_payload and columns else landed.withColumn("raw_payload", F.lit(None).cast("string"))
        landed = fill_contract(landed)
    else:
        clean = F.transform_values("cells", lambda k, v: cell_to_text(v, "string"))
        held = rows.withColumn("cells", clean)
        kept = F.exists(F.map_values("cells"), lambda v: v.isNotNull())
        payload = F.to_json("cells", {"ignoreNullFields": "false"})
        if "_broken" in rows.columns:
            kept, payload = F.coalesce(kept, F.lit(False)) | F.col("_broken").isNotNull(), F.coalesce("_broken", payload)
        landed = held.where(kept).withColumns({column: F.col("cells")[header] for header, column in HEADER_TO_COLUMN.items()})
        landed = landed.withColumn("raw_payload", payload if with_raw_payload else F.lit(None).cast("string"))
    landed = landed.withColumns(
        {
            "ingestion_id": F.col("_id") + F.lit(first_id).cast("long"),
            "source_sheet": F.lit(sheet),
            "ingested_at": F.current_timestamp(),
        }
    ).select(*RAW_COLUMNS)
    return landed if limit_rows is None else limit_to_rows(landed, limit_rows)


def limit_to_files(landed: DataFrame, files: int) -> DataFrame:
    """Rows of the first dumps by name, of a table that is landed already (a scan takes ``limit_files`` instead)."""
    names = landed.select("source_file").distinct().orderBy("source_file").limit(files)
    return landed.join(F.broadcast(names), "source_file", "left_semi")


def limit_to_rows(landed: DataFrame, rows: int) -> DataFrame:
    """The first data rows of each dump.

    Blank rows use up the limit, except that reading only stops at a row with
    content: when the row at the limit is blank, the next filled row still counts.
    """
    beyond = F.col("source_row_number") - 1 >= rows
    stops = (
        landed.where(beyond).groupBy("source_file").agg(F.min("source_row_number").alias("_stop"))
    )
    # One narrow row per dump; a join by dump would put each dump into one task.
    return (
        landed.join(F.broadcast(stops), "source_file", "left")
        .where(~beyond | (F.col("source_row_number") <= F.col("_stop")))
        .select(*landed.columns)
    )


def landing_profile(landed: DataFrame) -> DataFrame:
    """Per dump: sheet, row count and its first row as a JSON sample."""
    sample = F.to_json(F.struct(*PREVIEW_COLUMNS), {"ignoreNullFields": "false"})
    # Sheets are few; collected, so that Spark aggregates by hash although the sample is text, and sorts no rows.
    return landed.groupBy("source_file").agg(
        F.array_min(F.collect_set("source_sheet")).alias("source_sheet"),
        F.count(F.lit(1)).alias("row_count"),
        F.min_by(sample, "source_row_number").alias("sample"),
    )


def landing_row_counts(landed: DataFrame, source_files: Sequence[str]) -> DataFrame:
    """Rows per dump, for the given dumps."""
    return (
        landed.where(F.col("source_file").isin(list(source_files)))
        .groupBy("source_file")
        .agg(F.count(F.lit(1)).alias("row_count"))
    )


def next_ingestion_id(spark: SparkSession, table: str) -> int:
    """First id above those already landed in a table folder; 1 where there is no table yet."""
    try:
        top = spark.read.schema(RAW_SCHEMA).parquet(table).agg(F.max("ingestion_id")).first()[0]
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return 1
    return 1 if top is None else top + 1


def land(landed: DataFrame, table: str, replace_files: bool = True, names: DataFrame | None = None) -> None:
    """Write landed rows to a Parquet table partitioned by dump.

    Replacing overwrites exactly the partitions of the incoming dumps, so a
    reload is idempotent; appending keeps what is there, so a reload doubles it.
    ``names`` (the dumps of the run) lets a dump that became empty lose its rows: each
    gets one row without an ingestion id, which ``read_landed`` leaves out, so
    replaced and emptied dumps are one write with one commit.
    """
    with unsorted_writes(landed.sparkSession):
        if not replace_files:
            landed.write.partitionBy("source_file").mode("append").parquet(table)
            return
        if names is not None:
            landed = landed.unionByName(names.select("source_file").distinct(), allowMissingColumns=True)
        landed.write.partitionBy("source_file").mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(table)


def read_landed(spark: SparkSession, table: str) -> DataFrame:
    """The landed table; its schema needs no inference."""
    return spark.read.schema(RAW_SCHEMA).parquet(table).where("ingestion_id is not null").select(*RAW_COLUMNS)


def replace_by_file(existing: DataFrame, incoming: DataFrame, names: DataFrame | None = None) -> DataFrame:
    """The same replacement as a query: existing rows of other dumps, plus the incoming rows.

    ``names`` are the dumps of the run; without them, those that have incoming rows.
    """
    names = incoming.select("source_file").distinct() if names is None else names
    # A name per dump; a join by dump would put each dump into one task.
    return existing.join(F.broadcast(names), "source_file", "left_anti").unionByName(incoming)
