"""Benchmark decontamination by canonical templates with typed slots.

Words of a text become template tokens: numbers, units behind numbers, and capitalised words inside a sentence (names)
turn into typed placeholders, everything else is the lower-cased word without edge punctuation. Windows of ``WINDOW``
tokens of the benchmark items and of the documents are hashed and joined; a window with fewer than ``LITERALS`` literal
words says too little and is skipped. Items that differ only in the values of their slots, and repeat them in the same
pattern, are one template, so a benchmark made from one template is one class in the join.

Beside these, the exact lower-cased windows of every item are hashed and joined the same way, whatever they consist of; so a
verbatim copy of an item that is rich in numbers or names is found too. The first word of an item or of a document's window is
read both as a word and as a name if it is capitalised, as it may stand behind a heading.

A match is a run on one diagonal (document position minus item position). On a diagonal, every name of the template must
stand for one value of the document wherever it occurs: the item's own value if it is there, else the most frequent one; windows
with another value are dropped, and all windows with the name when two values are as frequent. Equal numbers and units may be
equal by chance, so each is a slot of its own. A document is contaminated by a
template when consistent diagonals cover ``COVERAGE`` of its windows; it is re-parameterised when a slot's value differs.

Scale: the documents' windows never leave their task unless they pass a Bloom filter of the benchmark's windows, whose
size is fixed (``FILTER_BITS``); what passes goes through a shuffled join, and is grouped by document, template and
diagonal. The filter is built from a bitmap aggregated in Spark.

Defined cases: null and empty texts match nothing; an item shorter than a window is one window of its own length; an item
without enough literal words is found verbatim only; a document that holds an item in both ways has one row for it; equal items are one template, named by the smallest id; rows that share an
id are one document; rows without an id are never reported; other input columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyward.sources.shared import cut

WINDOW = 8
LITERALS = 5
COVERAGE = 0.5
FILTER_BITS = 24
KNOWN_WORDS = 400_000
#: Fixed value: unit words that make a placeholder behind a number.
UNITS = frozenset(
    "mm cm m km in ft yd mi mg g kg lb oz ml l s ms sec min h hr hours minutes seconds days weeks years % usd eur dollars"
    " euros cents miles meters metres kilometers kilometres grams kilograms liters litres degrees percent kmh mph".split()
)
NUMBER = re.compile(r"[+-]?[$€£]?\d[\d.,:/]*(?:st|nd|rd|th)?[%€$£]?$")
EDGES = ".,;:!?\"'()[]{}<>|*#&-_"
PLAIN, IS_NUMBER, IS_UNIT, IS_NAME, EMPTY = 0, 1, 2, 3, 4
ENDS = 8
#: Keeps hashes of exact windows apart from those of template windows.
EXACT = 1 << 32
_U = np.uint64
_STEP = _U(0x9E3779B97F4A7C15)
_MARKS = {IS_NUMBER: _U(0x1B873593CC9E2D51), IS_UNIT: _U(0x85EBCA6BC2B2AE35), IS_NAME: _U(0x27D4EB2F165667C5)}


class Words(dict):
    """Word to (hash << 4 | whether a sentence ends here | kind)."""

    def __missing__(self, word: str) -> int:
        low, kind, ends = word, PLAIN, 0
        if word.isalpha() and word.islower():  # most words
            if word in UNITS:
                kind = IS_UNIT
        else:
            bare = word.strip(EDGES)
            low = bare.lower()
            if not bare:
                kind = EMPTY
            elif NUMBER.match(bare):
                kind = IS_NUMBER
            elif low in UNITS:
                kind = IS_UNIT
            elif bare[0].isupper() and not bare.isupper():
                kind = IS_NAME
            if word.rstrip("\"')]").endswith((".", "!", "?")):
                ends = ENDS
        value = (xxhash.xxh3_64_intdigest(low.encode()) >> 4 << 4) | ends | kind
        if len(word) <= 64:
            if len(self) >= KNOWN_WORDS:
                self.clear()
            self[word] = value
        return value


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> _U(27))) * _U(0x94D049BB133111EB)
    return h ^ (h >> _U(31))


def template(text: str | None, known: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Tokens of the canonical text, which of them are slots, the words' hashes, and which are capitalised where a sentence begins."""
    words = (text or "").split()
    raw = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
    raw = raw[(raw & _U(7)) != EMPTY] if len(raw) else raw
    kind, value = (raw & _U(7)).astype(np.int8), raw >> _U(4)
    first = np.ones(len(raw), bool)
    first[1:] = (raw[:-1] & _U(ENDS)) > 0
    behind = np.zeros(len(raw), bool)
    behind[1:] = kind[:-1] == IS_NUMBER
    lead = (kind == IS_NAME) & first
    kind[lead] = PLAIN
    kind[(kind == IS_UNIT) & ~behind] = PLAIN
    tokens = value.copy()
    for k, mark in _MARKS.items():
        tokens[kind == k] = mark
    return tokens, kind != PLAIN, value, lead


def runs(tokens: np.ndarray, size: int) -> list[np.ndarray]:
    """Hashes of all runs of 1, 2, 4 ... tokens, up to ``size``."""
    out = [tokens]
    while 2 ** len(out) <= size:
        half = 2 ** (len(out) - 1)
        out.append(mixed(out[-1][:-half] * _STEP + out[-1][half:]))
    return out


def hashed(parts: list[np.ndarray], size: int, start: int) -> np.ndarray:
    """Hash of every window of ``size`` tokens, put together from ``runs``."""
    h, at = parts[-1], 2 ** (len(parts) - 1)
    n = len(parts[0]) - size + 1
    for k in range(len(parts) - 2, -1, -1):
        if size >> k & 1:
            h = mixed(h[:n] * _STEP + parts[k][at : at + n])
            at += 2**k
    return h[:n] ^ _U(start)


def hashed_at(places: np.ndarray, first: np.ndarray, parts: list[np.ndarray], size: int, start: int) -> np.ndarray:
    """``hashed`` of the windows at ``places``, with ``first`` as their first tokens; where these are few."""
    h, at = first, 1
    for k in range(len(parts) - 1):
        h = mixed(h * _STEP + parts[k][places + at])
        at += 2**k
    for k in range(len(parts) - 2, -1, -1):
        if size >> k & 1:
            h = mixed(h * _STEP + parts[k][places + at])
            at += 2**k
    return h ^ _U(start)


def windows(tokens: np.ndarray, slots: np.ndarray, values: np.ndarray, lead: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, hash, whether its first word is read the other way) of the windows with enough literal words."""
    n = len(tokens) - size + 1
    if n <= 0:
        return np.empty(0, np.int64), np.empty(0, np.uint64), np.empty(0, bool)
    literal = np.concatenate([[0], np.cumsum(~slots)])
    literal = literal[size:] - literal[:-size]
    least = min(LITERALS, size)
    at = np.flatnonzero(literal >= least)
    parts = runs(tokens, size)
    h = hashed(parts, size, size)[at]
    names = tokens == _MARKS[IS_NAME]
    other = np.flatnonzero((names | lead)[:n] & (literal + names[:n] - lead[:n] >= least))
    if not len(other):
        return at, h, np.zeros(len(at), bool)
    first = np.where(names[other], values[other], np.where(lead[other], _MARKS[IS_NAME], tokens[other]))
    h = np.concatenate([h, hashed_at(other, first, parts, size, size)])
    return np.concatenate([at, other]), h, np.arange(len(h)) >= len(at)


def exact_windows(values: np.ndarray, size: int) -> np.ndarray:
    """Hash of every window of lower-cased words."""
    return hashed(runs(values, size), size, EXACT + size) if 0 < size <= len(values) else np.empty(0, np.uint64)


def _as_long(values: np.ndarray) -> list[int]:
    return values.astype(np.int64).tolist()


def benchmark_templates(items: DataFrame, window: int, id_col: str, text_col: str) -> DataFrame:
    """One row per template: (template, family, item_id, n_items, size, hashes, starts, slot_at, slot_no, slot_value).

    An item has a template for its exact windows too; its family is the template with slots, if the item has windows there.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Words()
        for batch in batches:
            rows = []
            for item, text in zip(batch.column(0), batch.column(1)):
                tokens, slots, values, lead = template(text.as_py(), known)
                size = min(window, len(tokens))
                if not size:
                    continue
                at, hashes, other = windows(tokens, slots, values, lead, size)
                # Inside an item there is one reading; only its first word may stand elsewhere.
                fits = ~other | (at == 0)
                at, hashes = at[fits], hashes[fits]
                places = np.flatnonzero(slots)
                _, numbers = np.unique(values[places], return_inverse=True)
                seen: dict[int, int] = {}
                numbers = [seen.setdefault(int(k), len(seen)) for k in numbers]  # by first occurrence
                shape = xxhash.xxh3_128_hexdigest(tokens.tobytes() + repr(numbers).encode())
                exact = "exact " + xxhash.xxh3_128_hexdigest(values.tobytes())
                whole = exact_windows(values, size)
                rows.append((exact, shape if len(at) else exact, item.as_py(), size, _as_long(whole), list(range(len(whole))), [], [], []))
                if not len(at):
                    continue
                # Only names inside sentences are tied to each other.
                places = np.flatnonzero(slots | (lead & (np.arange(len(lead)) == 0)))
                _, numbers = np.unique(values[places], return_inverse=True)
                tied = tokens[places] == _MARKS[IS_NAME]
                numbers = np.where(tied, numbers, len(tokens) + places).tolist()
                rows.append((shape, shape, item.as_py(), size, _as_long(hashes), at.tolist(), places.tolist(), numbers, _as_long(values[places])))
            kinds = [pa.string(), pa.string(), pa.int64(), pa.int32(), *[pa.list_(t) for t in (pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int64())]]
            names = ["template", "family", "item_id", "size", "hashes", "starts", "slot_at", "slot_no", "slot_value"]
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)], names)

    schema = "template string, family string, item_id long, size int, hashes array<long>, starts array<int>, slot_at array<int>, slot_no array<int>, slot_value array<long>"
    rows = items.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, schema)
    # The item with the smallest id speaks for its template.
    packed = F.struct(F.col("item_id").isNull().alias("no_id"), "item_id", "family", "size", "hashes", "starts", "slot_at", "slot_no", "slot_value")
    best = rows.groupBy("template").agg(F.min(packed).alias("best"), F.count("*").alias("n_items"))
    return best.select("template", "n_items", *[f"best.{c}" for c in ("family", "item_id", "size", "hashes", "starts", "slot_at", "slot_no", "slot_value")])


def bloom(templates: DataFrame, bits: int) -> np.ndarray:
    """Bitmap of the windows' hashes; Spark merges them to at most 2**bits / 64 words."""
    place = F.col("hash").bitwiseAND((1 << bits) - 1)
    words = (
        templates.select(F.explode("hashes").alias("hash"))
        .select(F.shiftright(place, 6).alias("word"), F.expr(f"shiftleft(1L, cast((hash & {(1 << bits) - 1}) & 63 as int))").alias("bit"))
        .groupBy("word")
        .agg(F.bit_or("bit").alias("bits"))
        .toPandas()
    )
    out = np.zeros(1 << (bits - 6), np.uint64)
    out[words["word"].to_numpy(np.int64)] = words["bits"].to_numpy(np.int64).astype(np.uint64)
    return out


def matches(docs: DataFrame, templates: DataFrame, window: int, bits: int, id_col: str, text_col: str) -> DataFrame:
    """Document windows that may be in the benchmark: (id, start, hash, slot_at, slot_value); slots count from the window."""
    spark = docs.sparkSession
    sizes = sorted(r["size"] for r in templates.select("size").distinct().collect())  # at most ``window`` of them
    shared = spark.sparkContext.broadcast(bloom(templates, bits))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, bitmap, low = Words(), shared.value, _U((1 << bits) - 1)
        for batch in batches:
            rows = []
            for doc, text in zip(batch.column(0), batch.column(1)):
                tokens, slots, values, lead = template(text.as_py(), known)
                for size in sizes:
                    at, hashes, _ = windows(tokens, slots, values, lead, size)
                    whole = exact_windows(values, size)
                    at, hashes, plain = np.concatenate([at, np.arange(len(whole))]), np.concatenate([hashes, whole]), len(at)
                    place = hashes & low
                    hit = np.flatnonzero((bitmap[place >> _U(6)] >> (place & _U(63))) & _U(1))
                    for k, start, h in zip(hit.tolist(), at[hit].tolist(), _as_long(hashes[hit])):
                        inside = np.flatnonzero(slots[start : start + size]) if k < plain else np.empty(0, np.int64)
                        if k < plain and lead[start]:
                            inside = np.concatenate([[0], inside])
                        rows.append((doc.as_py(), start, h, inside.tolist(), _as_long(values[start + inside])))
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int64())]
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)], ["id", "start", "hash", "slot_at", "slot_value"])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")).where("id is not null")
    return rows.mapInArrow(run, "id long, start int, hash long, slot_at array<int>, slot_value array<long>")


def contaminated(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, coverage: float = COVERAGE, bits: int = FILTER_BITS,
    id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
) -> DataFrame:
    """One row per contaminated document and template: id, item_id, n_items, n_windows, coverage, reparameterised."""
    templates = cut(benchmark_templates(benchmark, window, item_col, item_text_col), "templates")
    found = cut(matches(docs, templates, window, bits, id_col, text_col), "windows")
    entries = templates.select("template", F.explode(F.arrays_zip("hashes", "starts")).alias("w")).select(
        "template", F.col("w.hashes").alias("hash"), F.col("w.starts").alias("item_start")
    )
    runs = found.join(entries, "hash").select("id", "template", (F.col("start") - F.col("item_start")).alias("diagonal"), "item_start", "slot_at", "slot_value")
    runs = cut(runs, "runs")
    # Each slot of a window, with the number its value has in the template.
    slots = (
        runs.where(F.size("slot_at") > 0)
        .select("id", "template", "diagonal", "item_start", F.explode(F.arrays_zip("slot_at", "slot_value")).alias("s"))
        .select("id", "template", "diagonal", "item_start", (F.col("item_start") + F.col("s.slot_at")).alias("place"), F.col("s.slot_value").alias("value"))
    )
    numbers = templates.select("template", F.explode(F.arrays_zip("slot_at", "slot_no", "slot_value")).alias("s")).select(
        "template", F.col("s.slot_at").alias("place"), F.col("s.slot_no").alias("number"), F.col("s.slot_value").alias("own")
    )
    slots = slots.join(numbers, ["template", "place"]).withColumn("changed", (F.col("value") != F.col("own")).cast("int"))
    slot = ["id", "template", "diagonal", "number"]
    by_value = slots.groupBy(*slot, "value").agg(F.min("changed").alias("changed"), F.count_distinct("place").alias("places"))
    by_value = by_value.groupBy(*slot, "changed", "places").agg(F.count("*").alias("ties"), F.min("value").alias("value"))
    agreed = by_value.groupBy(*slot).agg(F.max_by(F.when(F.col("ties") == 1, F.col("value")), F.struct(-F.col("changed"), "places")).alias("agreed"))
    verdicts = slots.join(agreed, slot).groupBy("id", "template", "diagonal", "item_start").agg(
        F.max(F.coalesce((F.col("value") != F.col("agreed")).cast("int"), F.lit(1))).alias("inconsistent"), F.max("changed").alias("changed")
    )
    consistent = runs.select("id", "template", "diagonal", "item_start").join(verdicts, ["id", "template", "diagonal", "item_start"], "left")
    consistent = consistent.where(F.coalesce("inconsistent", F.lit(0)) == 0)
    covered = consistent.groupBy("id", "template", "item_start").agg(F.min(F.coalesce("changed", F.lit(0))).alias("changed"))
    covered = covered.groupBy("id", "template").agg(F.count("*").cast("long").alias("n_windows"), (F.max("changed") == 1).alias("reparameterised"))
    sized = templates.select("template", "family", F.size(F.array_distinct("starts")).alias("of"))
    named = templates.select(F.col("template").alias("family"), "item_id", "n_items")
    found = covered.join(sized, "template").withColumn("coverage", F.col("n_windows") / F.col("of")).where(F.col("coverage") >= coverage)
    # An item found in both ways is one row, with the figures of the template with slots.
    figures = F.struct("n_windows", "coverage", "reparameterised")
    best = found.groupBy("id", "family").agg(F.max_by(figures, F.struct(F.col("template") == F.col("family"), "coverage", "n_windows")).alias("best"))
    return best.join(named, "family").select(F.col("id").alias(id_col), "item_id", "n_items", "best.n_windows", "best.coverage", "best.reparameterised")


def keep_clean(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """Rows of ``docs`` that no benchmark item contaminates; columns as they came."""
    gone = contaminated(docs, benchmark, id_col=id_col, text_col=text_col, **options).select(id_col).distinct()
    return docs.join(gone, id_col, "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])
