"""Text-to-type column functions.

All of them are native Column expressions, so they stay inside whole-stage
codegen. ``mode="strict"`` lets a malformed cell fail the job (ANSI cast);
``mode="tolerant"`` turns it into NULL.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

STRICT = "strict"
TOLERANT = "tolerant"

# Spellings of a flag, compared in upper case.
TRUE_WORDS = ("Y", "YES", "TRUE", "1")
FALSE_WORDS = ("N", "NO", "FALSE", "0")
# White space of Unicode, which source cells are stripped of.
BLANKS = "\t\n\x0b\x0c\r \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"


def _convert(text: Column, type_name: str, mode: str) -> Column:
    if mode not in (STRICT, TOLERANT):
        raise ValueError(f"unknown parse mode: {mode}")
    return text.try_cast(type_name) if mode == TOLERANT else text.cast(type_name)


def clean_text(text: Column) -> Column:
    """Strip spaces (only U+0020) from both ends; nothing left means NULL."""
    return F.nullif(F.trim(text.cast("string")), F.lit(""))


def cell_to_text(value: Column, type_name: str = "string") -> Column:
    """Render a source cell as landing text: ISO dates and times, lower-case booleans, stripped text.

    ``type_name`` is the Spark type of the cell (``df.schema[name].dataType.simpleString()``).
    """
    if type_name in ("timestamp", "timestamp_ntz"):
        seconds = F.date_format(value, "yyyy-MM-dd'T'HH:mm:ss")
        micros = F.date_format(value, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
        return F.when(micros.endswith(".000000"), seconds).otherwise(micros)
    if type_name in ("double", "float"):
        text = value.cast("string")
        # Plain digits in the range where a spreadsheet shows them, instead of 1.0E7.
        plain = F.regexp_replace(text.try_cast("decimal(38,18)").cast("string"), r"(\.\d+?)0*$", "$1")
        # Beyond it, the shortest exponent form: 1e-05, 2.5e+17.
        power = F.regexp_extract(text, "E(-?[0-9]+)$", 1).try_cast("int")
        short = F.regexp_replace(F.regexp_extract(text, "^(.*)E", 1), r"\.0$", "")
        exponent = F.concat(short, F.format_string("e%s%02d", F.when(power < 0, "-").otherwise("+"), F.abs(power)))
        return F.when(~text.contains("E"), text).when(F.abs(value).between(1e-4, 1e16), plain).otherwise(exponent)
    if type_name != "string":
        return value.cast("string")
    # Stripped by its characters: a pattern costs more than reading the cell does.
    return F.btrim(value, F.lit(BLANKS))


def _parse_amount(text: Column, scale: int, mode: str) -> Column:
    trimmed = F.trim(text.cast("string"))
    kept = F.regexp_replace(trimmed, "[^0-9.-]", "")
    # Accounting negatives: the whole value in parentheses. A minus sign inside them is dropped.
    wrapped = trimmed.startswith("(") & trimmed.endswith(")") & (F.length(trimmed) >= 2)
    inner = F.concat(F.lit("-"), F.replace(kept, F.lit("-"), F.lit("")))
    number = F.when(wrapped, F.regexp_replace(inner, "^-$", "")).otherwise(kept)
    # nullif evaluates its argument once, ahead of the cast.
    return _convert(F.nullif(number, F.lit("")), f"decimal(14,{scale})", mode)


def parse_money(text: Column, mode: str = STRICT) -> Column:
    """``$1,000.00``, ``(10.00)``, ``-3.5`` to decimal(14,2), half up."""
    return _parse_amount(text, 2, mode)


def parse_decimal(text: Column, mode: str = STRICT) -> Column:
    """The same shapes to decimal(14,4)."""
    return _parse_amount(text, 4, mode)


def parse_integer(text: Column, mode: str = STRICT) -> Column:
    """Keep digits and minus signs only, so ``3.0`` reads as 30."""
    digits = F.regexp_replace(F.trim(text.cast("string")), "[^0-9-]", "")
    return _convert(F.nullif(digits, F.lit("")), "int", mode)


def parse_boolean_flag(text: Column) -> Column:
    """Three-valued: known yes-word, known no-word, anything else NULL."""
    word = F.upper(F.trim(text.cast("string")))
    return F.when(word.isin(*TRUE_WORDS), F.lit(True)).when(word.isin(*FALSE_WORDS), F.lit(False))


def _to_timestamp(text: Column, mode: str, formats: Sequence[str]) -> Column:
    if not formats:
        return _convert(text, "timestamp_ntz", mode)
    attempts = [text.try_cast("timestamp_ntz")]
    attempts += [F.try_to_timestamp(text, F.lit(f)).cast("timestamp_ntz") for f in formats]
    parsed = F.coalesce(*attempts)
    if mode == TOLERANT:
        return parsed
    return F.coalesce(parsed, text.cast("timestamp_ntz"))


def parse_source_timestamp(
    date_text: Column,
    time_text: Column,
    mode: str = STRICT,
    date_formats: Sequence[str] = (),
) -> Column:
    """Join a date cell and a time cell into a zone-free timestamp.

    Without a time the date cell keeps its own time part; with one, only its
    date part is used. ``date_formats`` adds non-ISO date patterns.
    """
    day = F.trim(date_text.cast("string"))
    clock = F.trim(time_text.cast("string"))
    has_clock = clock != ""
    moment = _to_timestamp(F.nullif(day, F.lit("")), mode, date_formats)
    if date_formats:
        date_part = moment.cast("date").cast("string")
    else:
        date_part = F.substring_index(F.substring_index(day, "T", 1), " ", 1)
    joined = _convert(F.concat(date_part, F.lit(" "), clock), "timestamp_ntz", mode)
    return F.when((day != "") & has_clock, joined).otherwise(moment)


def normalize_customer_name(name: Column) -> Column:
    """Upper case, whitespace runs to one space, stripped; nothing left means NULL."""
    return clean_text(F.regexp_replace(F.upper(name), r"\s+", " "))
