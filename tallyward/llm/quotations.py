"""Chat formatting by quotation linking.

A line that starts with ``>`` marks, blanks between them allowed, quotes; the number of marks is its level. Lines of one
level in a row are a passage. Passages and messages' own text are cut into units, every line, every paragraph and every
sentence of it (whatever the line breaks), in lower case with runs of blanks as one; units are hashed. A quoted unit belongs to the
earliest message of its conversation that holds the unit as text of its own, if that stands before the quoting message.
A message replies to the message from which its shallowest linked level quotes most characters (the latest, if several
do). Following replies upwards leads to the message that began the thread, at a depth.

Every message comes out without its quoted lines, and without a line that only introduces them ("... wrote:").
Reply order of a conversation is its order by (thread_turn, turn): replies never precede what they reply to.

Scale: only conversations with a quoting message take part in the join; a unit that many messages hold is reduced to its
earliest holder before the join; threads are followed by doubling, each round written to the shared folder.

Defined cases: null texts are empty; a message whose conversation or turn is null is no original and replies to nothing;
rows that share conversation and turn are one message in links, each with its own row; other input columns are ignored;
an empty table has no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyward.sources.shared import cut

MARKS = re.compile(r"[ \t]*((?:>[ \t]?)+)")
INTRODUCES = re.compile(r"\b(wrote|writes|schrieb|escribi[óo]|a écrit)\s*:\s*$", re.IGNORECASE)
SENTENCE_ENDS = re.compile(r"(?<=[.!?]) ")
QUOTES = r"(?m)^[ \t]*>"
MESSAGE = ["conv", "turn"]


def parse(text: str | None) -> tuple[list[str], list[tuple[int, list[str]]]]:
    """(own lines, passages as (level, lines)) of a message."""
    own: list[str] = []
    passages: list[tuple[int, list[str]]] = []
    last = 0
    for line in (text or "").split("\n"):
        m = MARKS.match(line)
        level = m[1].count(">") if m else 0
        if not level:
            own.append(line)
        else:
            if not last:
                while own and not own[-1].strip():
                    own.pop()
                if own and INTRODUCES.search(own[-1]):
                    own.pop()
            if level != last:
                passages.append((level, []))
            passages[-1][1].append(line[m.end() :])
        last = level
    return own, passages


def units(lines: list[str]) -> dict[int, int]:
    """Hash to length of every line, paragraph and sentence, normalised."""
    found: set[str] = set()
    paragraph: list[str] = []
    for line in [*lines, ""]:
        plain = " ".join(line.lower().split())
        if plain:
            found.add(plain)
            paragraph.append(plain)
        elif paragraph:
            whole = " ".join(paragraph)
            found.update([whole, *SENTENCE_ENDS.split(whole)])
            paragraph = []
    return {xxhash.xxh3_64_intdigest(unit.encode()) - (1 << 63): len(unit) for unit in found}


def own_text(text: str | None) -> str:
    return "\n".join(parse(text)[0]).strip("\n")


def _units(messages: DataFrame) -> DataFrame:
    """(conv, turn, level, unit, length): level 0 is the message's own text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for conv, turn, text in zip(*(batch.column(k).to_pylist() for k in range(3))):
                own, passages = parse(text)
                for level, lines in [(0, own), *passages]:
                    rows += [(conv, turn, level, unit, length) for unit, length in units(lines).items()]
            kinds = [batch.column(0).type, pa.int64(), pa.int32(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)], [*MESSAGE, "level", "unit", "length"])

    kind = messages.schema["conv"].dataType.simpleString()
    return messages.select(*MESSAGE, "text").mapInArrow(run, f"conv {kind}, turn long, level int, unit long, length long")


def replies(messages: DataFrame) -> DataFrame:
    """(conv, turn, parent_turn, parent_level): what each quoting message replies to."""
    usable = messages.where("conv is not null and turn is not null")
    quoting = usable.where(F.col("text").rlike(QUOTES)).select("conv").distinct()
    found = cut(_units(usable.join(quoting, "conv", "left_semi")), "units")
    holders = found.where("level = 0").groupBy("conv", "unit").agg(F.min("turn").alias("holder"))
    quoted = found.where("level > 0").distinct()
    linked = quoted.join(holders, ["conv", "unit"]).where("holder < turn")
    weight = linked.groupBy(*MESSAGE, "level", "holder").agg(F.sum("length").alias("length"))
    best = weight.groupBy(*MESSAGE).agg(F.max(F.struct((-F.col("level")).alias("near"), "length", "holder")).alias("best"))
    return best.select(*MESSAGE, F.col("best.holder").alias("parent_turn"), (-F.col("best.near")).alias("parent_level"))


def threads(links: DataFrame) -> DataFrame:
    """(conv, turn, parent_turn, parent_level, thread_turn, depth) of messages that reply, by doubling."""
    now = cut(links.withColumn("top", F.col("parent_turn")).withColumn("depth", F.lit(1).cast("long")), "threads")
    while True:
        above = now.select("conv", F.col("turn").alias("top"), F.col("top").alias("higher"), F.col("depth").alias("more"))
        joined = now.join(above, ["conv", "top"], "left")
        if joined.where("higher is not null").isEmpty():
            return now.withColumnRenamed("top", "thread_turn")
        now = cut(
            joined.select(*MESSAGE, "parent_turn", "parent_level", F.coalesce("higher", "top").alias("top"), (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth")),
            "threads",
        )


def quoting(messages: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", text_col: str = "text") -> DataFrame:
    """The table as a mail thread would hold it: three of four turns, by the hash of their ids, quote before their own text.

    A turn quotes the message 1 to 3 turns before it, that message's own quotation a level deeper, and the one that quotes a
    level deeper still. Rows keep all columns. Turns without such a message, with quotes of their own or without conversation
    or turn stay as they are; rows that share conversation and turn are quoted by their smallest text.
    """
    turn = F.col(turn_col).cast("long")
    back = F.crc32(F.concat_ws(":", F.lit("quote"), F.col(conv_col).cast("string"), turn.cast("string"))) % 4
    said = messages.groupBy(F.col(conv_col).alias("conv"), turn.alias("at"), back.alias("back")).agg(F.min(F.col(text_col).cast("string")).alias("said"))
    said = cut(said.where("conv is not null and at is not null"), "said")

    def earlier(level: int) -> DataFrame:
        up = F.when(F.col("back") > 0, F.col("at") - F.col("back"))
        return said.select("conv", F.col("at").alias(f"at{level}"), F.col("said").alias(f"said{level}"), up.alias(f"up{level}"))

    linked = said.select("conv", "at", F.when(F.col("back") > 0, F.col("at") - F.col("back")).alias("at1"))
    for level in (1, 2, 3):
        linked = linked.join(earlier(level), ["conv", f"at{level}"], "left").withColumnRenamed(f"up{level}", f"at{level + 1}")

    def marked(level: int) -> Column:
        return F.concat(F.lit("> " * level), F.replace(F.coalesce(f"said{level}", F.lit("")), F.lit("\n"), F.lit("\n" + "> " * level)), F.lit("\n"))

    quoted = F.concat(F.lit("Someone wrote:\n"), *[F.when(F.col(f"said{k}").isNotNull(), marked(k)).otherwise("") for k in (3, 2, 1)], F.lit("\n"))
    mark = "_quoting"
    while any(c.lower().startswith(mark) for c in messages.columns):
        mark += "_"
    ahead = linked.where("said1 is not null").select(F.col("conv").alias(f"{mark}conv"), F.col("at").alias(f"{mark}turn"), quoted.alias(f"{mark}text"))
    text = F.col(text_col).cast("string")
    plain = F.coalesce(text, F.lit(""))
    whole = F.when(F.col(f"{mark}text").isNull() | plain.rlike(QUOTES), text).otherwise(F.concat(f"{mark}text", plain))
    joined = messages.join(ahead, (F.col(conv_col) == F.col(f"{mark}conv")) & (turn == F.col(f"{mark}turn")), "left")
    return joined.withColumn(text_col, whole).select(*messages.columns)


def conversations(
    messages: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """One row per row: conversation, turn, role, text without quotes, parent_turn, parent_level, thread_turn, depth, formatted."""
    plain = messages.select(
        F.col(conv_col).alias("conv"), F.col(turn_col).cast("long").alias("turn"), F.col(role_col).cast("string").alias("role"), F.col(text_col).cast("string").alias("text")
    )
    linked = threads(replies(plain))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = pa.array([own_text(t.as_py()) for t in batch.column(3)], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), texts], [*MESSAGE, "role", "text"])

    kind = plain.schema["conv"].dataType.simpleString()
    cleaned = plain.mapInArrow(run, f"conv {kind}, turn long, role string, text string")
    formatted = F.concat(F.lit("<|"), F.coalesce("role", F.lit("")), F.lit("|>\n"), F.col("text"), F.lit("\n"))
    return cleaned.join(linked, MESSAGE, "left").select(
        F.col("conv").alias(conv_col), F.col("turn").alias(turn_col), F.col("role").alias(role_col), F.col("text").alias(text_col),
        "parent_turn", "parent_level", F.coalesce("thread_turn", "turn").alias("thread_turn"), F.coalesce("depth", F.lit(0).cast("long")).alias("depth"),
        formatted.alias("formatted"),
    )
