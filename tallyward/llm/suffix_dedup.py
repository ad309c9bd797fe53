"""Repeated passages of all documents, found with suffix arrays of the places where texts may repeat.

A window (``LENGTH`` bytes) repeats if it also starts anywhere else; every byte a repeated window covers is removed.

*Where equal windows meet.* The anchor of a window is its k-mer (``KMER`` bytes) of smallest hash, the leftmost of equals, so
equal windows have equal anchors at equal places. Following windows with one anchor place are a run; its text is what they
cover. Runs are tallied by anchor, and those whose anchor occurs once are done with: nothing in them repeats. Runs with
equal texts collapse into one text with a count; all windows of a text that occurs twice repeat.

*Pieces.* Anchors with several unlike texts are left. Their texts fall into pieces by ranges of ``WIDTH`` places of the anchor;
all windows of a range share ``LENGTH - WIDTH + 1`` bytes, which are the key of the piece. Pieces with a key of their own
are done with, and equal pieces collapse.

*Suffix arrays.* Unlike pieces with one key are laid side by side, what they share as one symbol, in blocks of about ``BLOCK``
symbols of whole keys. Each block's suffixes are ordered by linear grouping (``lyndon_groups``): a window repeats when it
equals that of the suffix before or behind it. A key with more than ``MOST`` unlike pieces, as the border of a common
passage makes, is no block's work: its windows are tallied one by one, over all tasks.

Copies are one text throughout. Text travels twice: joined to the places where it's wanted, and to the ranges that go.

Memory of a task: ``CHUNK`` bytes of text at a time in the first pass, one block, or one document and its ranges.

Defined cases: a null text has no bytes; texts shorter than ``LENGTH`` lose nothing; matches never cross documents. Ids may be
null or repeat: rows are told apart by id and text, and equal rows repeat each other. Other columns are ignored, so clashing
names don't matter; an empty table gives an empty table. Removal may cut a character in two, as only bytes count.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyward.llm.lyndon_groups import suffix_array
from tallyward.sources.shared import cut

LENGTH = 400
KMER = 64
CHUNK = 1 << 20
#: Windows of a piece at most, below 256.
WIDTH = 32
#: Symbols of a suffix array, and the unlike parts one piece may bring to it.
BLOCK = 1 << 16
MOST = 1024
#: Fixed odd multipliers, one for each doubling of the k-mer length.
ODD = [np.uint64(0x9E3779B97F4A7C15 + 2 * k * 0x632BE59BD9B4E019 & 0xFFFFFFFFFFFFFFFF | 1) for k in range(16)]


def kmer_hashes(data: np.ndarray, k: int) -> np.ndarray:
    """A 64-bit hash of the ``k`` bytes from each place on; k is a power of two."""
    h = (data.astype(np.uint64) + np.uint64(1)) * ODD[15]
    span, step = 1, 0
    while span < k:
        h = h[:-span] * ODD[step] + (h[span:] ^ (h[span:] >> np.uint64(31)))
        h ^= h >> np.uint64(29)
        span, step = span * 2, step + 1
    return h * ODD[14]


def anchors(data: np.ndarray, length: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Per window the place of its anchor, and the hashes of all k-mers."""
    h = kmer_hashes(data, k)
    width, n = length - k + 1, len(data) - length + 1
    low = np.uint64(2 * CHUNK - 1)
    ranked = np.full(-(-len(h) // width) * width, np.iinfo(np.uint64).max)
    ranked[: len(h)] = h & ~low | np.arange(len(h), dtype=np.uint64)
    rows = ranked.reshape(-1, width)
    ahead = np.minimum.accumulate(rows, axis=1).ravel()
    behind = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return (np.minimum(behind[:n], ahead[width - 1 : width - 1 + n]) & low).astype(np.int64), h


def chunks(texts: list[memoryview], length: int) -> Iterator[list[tuple[int, int, memoryview]]]:
    """Parts (row, first byte, bytes) of about ``CHUNK`` bytes together; parts of a text share ``length`` - 1 bytes."""
    held, size = [], 0
    for row, text in enumerate(texts):
        for at in range(0, len(text) - length + 1, CHUNK - length + 1):
            part = text[at : at + CHUNK]
            if size and size + len(part) > CHUNK:
                yield held
                held, size = [], 0
            held.append((row, at, part))
            size += len(part)
    if held:
        yield held


def find_runs(parts: list[tuple[int, int, memoryview]], length: int, k: int) -> Iterator[tuple[int, int, int, int, int, int, int]]:
    """(row, first window, windows, repetitions, place of the anchor in the text, anchor hash, text hash).

    Following runs with equal texts, as periodic text has them, are one with a number of repetitions.
    """
    joined = b"".join(part for _, _, part in parts)
    place, h = anchors(np.frombuffer(joined, np.uint8), length, k)
    sizes = np.array([len(part) for _, _, part in parts])
    begins = np.r_[0, np.cumsum(sizes)[:-1]]
    starts = np.r_[True, place[1:] != place[:-1]]
    starts[begins] = True
    ends = begins + sizes - length + 1  # windows behind cross into the next part
    starts[ends[:-1]] = True
    firsts = np.flatnonzero(starts)
    part_of = np.searchsorted(begins, firsts, "right") - 1
    counts = np.diff(np.r_[firsts, len(place)])
    inside = firsts < ends[part_of]
    firsts, part_of, counts = firsts[inside], part_of[inside], counts[inside]
    at = place[firsts]
    found = zip(part_of.tolist(), firsts.tolist(), counts.tolist(), (at - firsts).tolist(), h[at].view(np.int64).tolist())
    digest, whole = xxhash.xxh3_64_intdigest, memoryview(joined)
    last = None
    for part, first, count, offset, core in found:
        text = digest(whole[first : first + count - 1 + length]) - (1 << 63)
        row, base = parts[part][:2]
        first += base - int(begins[part])
        if last and last[0] == row and last[2] == count and last[4:] == (offset, core, text) and last[1] + last[3] * count == first:
            last = (*last[:3], last[3] + 1, *last[4:])
            continue
        if last:
            yield last
        last = (row, first, count, 1, offset, core, text)
    if last:
        yield last


def row_key(row_id: int | None, text: memoryview) -> int:
    return xxhash.xxh3_64_intdigest(text, seed=row_id is None) - (1 << 63)


def bytes_of(column: pa.Array) -> list[memoryview]:
    return [memoryview(x.as_buffer()) if x.is_valid else memoryview(b"") for x in column]


RUNS = "id long, th long, at long, count int, times long, offset int, core long, seg long"


def runs_of(docs: DataFrame, length: int, k: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.int64()]
        names = [name.split(" ")[0] for name in RUNS.split(", ")]
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), bytes_of(batch.column(1))
            keys: dict[int, int] = {}
            for parts in chunks(texts, length):
                found = list(find_runs(parts, length, k))
                for row in {f[0] for f in found} - keys.keys():
                    keys[row] = row_key(ids[row], texts[row])
                rows = [(ids[f[0]] or 0, keys[f[0]], *f[1:]) for f in found]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names) if rows else pa.RecordBatch.from_arrays([pa.array([], t) for t in kinds], names)

    return docs.mapInArrow(run, RUNS)


def with_keys(docs: DataFrame) -> DataFrame:
    """(row_id, id, th, text): the id as given, and what tells a row apart."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0)
            keys = [row_key(i, t) for i, t in zip(ids.to_pylist(), bytes_of(batch.column(1)))]
            yield pa.RecordBatch.from_arrays([ids, ids.fill_null(0), pa.array(keys, pa.int64()), batch.column(1)], ["row_id", "id", "th", "text"])

    return docs.mapInArrow(run, "row_id long, id long, th long, text string")


PIECES = "core long, seg long, lo int, n long, count int, ahead binary, behind binary, piece long, part long"


def pieces_of(docs: DataFrame, wanted: DataFrame, length: int, width: int) -> DataFrame:
    """Texts of ``wanted`` (core, seg, n, id, th, at, count, offset), each read from one document, cut by ranges of ``width`` places.

    The windows of a piece have the anchor within one range of places, so they all hold the bytes around it that any such
    window holds. ``piece`` is a hash of those, ``ahead`` and ``behind`` are the bytes of the piece before and after, ``part``
    is a hash of both, ``lo`` the first window. Equal documents bring a text more than once, but only texts that occur twice anyway.
    """
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.int64(), pa.int64()]
    names = [name.split(" ")[0] for name in PIECES.split(", ")]
    digest = xxhash.xxh3_64_intdigest

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text, places in zip(bytes_of(batch.column(0)), batch.column(1)):
                for p in places.as_py():
                    at, count, offset = p["at"], p["count"], p["offset"]
                    anchor = at + offset
                    for kind in range((offset - count + 1) // width, offset // width + 1):
                        lo, hi = max(0, offset - (kind + 1) * width + 1), min(count, offset - kind * width + 1)
                        begin, end = anchor - kind * width, anchor - (kind + 1) * width + 1 + length
                        ahead, behind = bytes(text[at + lo : begin]), bytes(text[end : at + hi - 1 + length])
                        piece = digest(text[begin:end], seed=kind) - (1 << 63)
                        part = digest(ahead + bytes([hi - lo]) + behind, seed=len(ahead)) - (1 << 63)
                        rows.append((p["core"], p["seg"], lo, p["n"], hi - lo, ahead, behind, piece, part))
                if len(rows) > 20_000:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names)
                    rows = []
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names)

    places = wanted.groupBy("id", "th").agg(F.collect_set(F.struct("core", "seg", "n", "at", "count", "offset")).alias("places"))
    return docs.join(places, ["id", "th"]).select("text", "places").mapInArrow(run, PIECES)


def repeated_windows(texts: list[tuple[int, bytes, bytes]], width: int) -> list[np.ndarray]:
    """Per text (group, bytes before, bytes after what its group shares) which of its windows also start elsewhere in its group.

    What a group shares is one symbol of its own, so a window is ``width`` symbols. One suffix array holds all texts.
    """
    symbols, whole, begins = [], [], []
    size = 0
    for group, ahead, behind in texts:
        begins.append(size)
        symbols += [*(b + 1 for b in ahead), 257 + group, *(b + 1 for b in behind), 0]
        n = len(ahead) + len(behind) + 2
        starts = n - width
        whole += [True] * starts + [False] * width
        size += n
    text, usable = np.array(symbols, np.int32), np.array(whole)
    order = suffix_array(text)
    order = order[usable[order]]  # windows that run into the next text match nothing
    windows = sliding_window_view(text, width)
    hit = np.zeros(size, bool)
    for at in range(0, len(order) - 1, 4096):
        a, b = order[at : at + 4096], order[at + 1 : at + 4097]
        a = a[: len(b)]
        same = (windows[a] == windows[b]).all(axis=1)
        hit[a[same]] = True
        hit[b[same]] = True
    return [hit[begin : begin + len(ahead) + len(behind) + 2 - width] for begin, (_, ahead, behind) in zip(begins, texts)]


def ranges(flags: np.ndarray) -> list[tuple[int, int]]:
    edges = np.flatnonzero(np.diff(np.r_[0, flags.astype(np.int8), 0]))
    return list(zip(edges[::2].tolist(), edges[1::2].tolist()))


def from_suffix_arrays(parts: DataFrame, width: int) -> DataFrame:
    """(piece, part, from, to): ranges of repeated windows of parts that occur once. Pieces stay whole within a block."""
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int, int, int, bytes, bytes]] = []
        size = group = 0

        def block() -> pa.RecordBatch:
            flags = repeated_windows([(g, ahead, behind) for g, _, _, _, ahead, behind in held], width)
            out = [(piece, part, lo, hi) for (_, piece, part, n, _, _), f in zip(held, flags) if n == 1 for lo, hi in ranges(f)]
            held.clear()
            columns = zip(*out) if out else [[]] * 4
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], ["piece", "part", "from", "to"])

        for batch in batches:
            for piece, part, n, ahead, behind in zip(*(column.to_pylist() for column in batch.columns)):
                if held and held[-1][1] != piece:
                    group += 1
                    if size >= BLOCK:
                        yield block()
                        size = group = 0
                held.append((group, piece, part, n, ahead, behind))
                size += len(ahead) + len(behind) + 2
        if held:
            yield block()

    dealt = parts.select("piece", "part", "n", "ahead", "behind").repartition("piece").sortWithinPartitions("piece")
    return dealt.mapInArrow(run, "piece long, part long, from int, to int")


def window_by_window(parts: DataFrame, width: int) -> DataFrame:
    """The same for crowded pieces, whose unlike parts are too many for one block: every window by itself."""
    window = F.explode(F.sequence(F.lit(0), F.col("count") - 1))
    opened = parts.withColumn("from", window)
    before = F.expr("substring(ahead, from + 1)")
    after = F.expr(f"substring(behind, 1, from + {width - 1} - length(ahead))")
    opened = opened.select("piece", "part", "n", "from", F.xxhash64(F.length(before), before, after).alias("window"))
    again = opened.groupBy("piece", "window").agg(F.sum("n").alias("total")).where("total > 1").select("piece", "window")
    return opened.where("n = 1").join(again, ["piece", "window"]).select("piece", "part", "from", (F.col("from") + 1).alias("to"))


def marks_of(pieces: DataFrame, width: int, most: int) -> DataFrame:
    """(core, seg, lo, hi): repeated windows of the texts in ``pieces`` that occur once."""
    repeating = pieces.groupBy("piece").agg(F.sum("n").alias("total")).where("total > 1").select("piece")
    again = cut(pieces.join(repeating, "piece"), "repeating_pieces")
    parts = again.groupBy("piece", "part").agg(
        F.sum("n").alias("n"), F.first("count").alias("count"), F.first("ahead").alias("ahead"), F.first("behind").alias("behind")
    )
    parts = cut(parts, "parts")
    groups = parts.groupBy("piece").agg(F.count("*").alias("unlike"), F.min("n").alias("least")).where("unlike > 1 and least = 1")
    open_parts = parts.join(groups.select("piece", "unlike"), "piece")
    found = (
        parts.where("n > 1")
        .select("piece", "part", F.lit(0).alias("from"), F.col("count").alias("to"))
        .unionByName(from_suffix_arrays(open_parts.where(F.col("unlike") <= most), width))
        .unionByName(window_by_window(open_parts.where(F.col("unlike") > most), width))
    )
    places = again.where("n = 1").select("core", "seg", "lo", "piece", "part")
    return places.join(found, ["piece", "part"]).select("core", "seg", (F.col("lo") + F.col("from")).alias("lo"), (F.col("lo") + F.col("to")).alias("hi"))


def repeated_ranges(docs: DataFrame, length: int = LENGTH, k: int = KMER, width: int = WIDTH, most: int = MOST) -> DataFrame:
    """(id, th, gone): per row of ``with_keys`` the byte ranges that repeated windows cover, as a set of (begin, end); rows without any are left out."""
    runs = cut(runs_of(docs.select("row_id", "text"), length, k), "runs")
    repeating = runs.groupBy("core").agg(F.sum("times").alias("total")).where("total > 1").select("core")
    runs = cut(runs.join(repeating, "core"), "repeating_runs")
    texts = runs.groupBy("core", "seg").agg(F.sum("times").alias("n"), F.min(F.struct("id", "th", "at", "count", "offset")).alias("from"))
    texts = cut(texts.select("core", "seg", "n", "from.*"), "texts")
    unlike = texts.groupBy("core").agg(F.count("*").alias("unlike"), F.min("n").alias("least")).where("unlike > 1 and least = 1").select("core")
    pieces = cut(pieces_of(docs, texts.join(unlike, "core"), length, width), "pieces")
    alike = texts.where("n > 1").select("core", "seg", F.lit(0).alias("lo"), F.col("count").alias("hi"))
    marks = cut(alike.unionByName(marks_of(pieces, width, most)), "marks")
    full = (F.col("lo") == 0) & (F.col("hi") == F.col("count"))
    covered = runs.join(marks, ["core", "seg"]).select(
        "id", "th",
        (F.col("at") + F.when(full, 0).otherwise(F.col("lo"))).alias("begin"),
        (F.col("at") + F.when(full, F.col("count") * F.col("times")).otherwise(F.col("hi")) - 1 + length).alias("end"),
    )
    return covered.groupBy("id", "th").agg(F.collect_set(F.struct("begin", "end")).alias("gone"))


def merged(gone: list[dict] | None) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for begin, end in sorted((g["begin"], g["end"]) for g in gone or []):
        if out and begin <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((begin, end))
    return out


def remove_repeats(table: DataFrame, length: int = LENGTH, k: int = KMER, width: int = WIDTH, most: int = MOST, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``table``: id, n_bytes, n_removed, spans (byte ranges that go), kept (the bytes that stay)."""
    docs = with_keys(table.select(F.col(id_col).cast("long").alias("row_id"), F.col(text_col).cast("string").alias("text")))
    gone = repeated_ranges(docs, length, k, width, most)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        span = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))
        for batch in batches:
            sizes, removed, spans, kept = [], [], [], []
            for text, found in zip(bytes_of(batch.column(1)), batch.column(2)):
                cuts = merged(found.as_py())
                edges = [0, *(e for c in cuts for e in c), len(text)]
                sizes.append(len(text))
                removed.append(sum(end - begin for begin, end in cuts))
                spans.append([{"begin": begin, "end": end} for begin, end in cuts])
                kept.append(b"".join(text[a:z] for a, z in zip(edges[::2], edges[1::2])))
            columns = [batch.column(0), pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()), pa.array(spans, span), pa.array(kept, pa.large_binary())]
            yield pa.RecordBatch.from_arrays(columns, [id_col, "n_bytes", "n_removed", "spans", "kept"])

    schema = f"`{id_col}` long, n_bytes long, n_removed long, spans array<struct<begin: long, end: long>>, kept binary"
    return docs.join(gone, ["id", "th"], "left").select("row_id", "text", "gone").mapInArrow(run, schema)


def digest(cleaned: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """What ``remove_repeats`` did, in figures."""
    return cleaned.select(id_col, "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
