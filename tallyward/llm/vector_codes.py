"""Product codes of vectors, their nearest codebook entries found by Orchard's search.

Components become whole numbers ``floor(256 * x)``, and vectors are cut into ``PARTS`` parts with a codebook of at most
``ENTRIES`` entries each. A round assigns every part to its nearest entry and moves the entries to their parts' means, floored.

*Orchard search.* Every entry keeps a list of all entries by distance from it. A search stands at an entry and walks its list;
an entry nearer to the part (or as near, with a smaller index) is jumped to, and its own list is walked from the start.
Entries seen before are marked and skipped. Once the list's distance is beyond twice the part's distance from where the
search stands, nothing nearer can follow. A search starts at the entry whose components' sum is next to the part's. All parts
of a batch walk at once, each with its own place, list and marks.

*On Spark.* Codebooks (``PARTS * ENTRIES`` entries) go to every task; a task returns one sum and count per entry, which Spark
adds up, so a round shuffles a bounded number of rows per task. Errors by label are added up and joined back.

Arithmetic is exact in 64-bit integers. Defined cases: rows whose vector is null, or holds null or non-finite components, are
left out, as are empty vectors, those whose length isn't a multiple of ``PARTS``, and those of another length than the
smallest id's. Ids may be null (last in order) or repeat (ties in the order go by the vector). Fewer rows than
entries give shorter codebooks, and no rows give no rows. A component whose whole number has more than 24 bits raises, because
errors would leave the range of a long. Other columns are ignored, so clashing names don't matter.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyward.sources.shared import cut

PARTS = 16
ENTRIES = 64
ROUNDS = 2
#: Parts that walk at once.
BATCH = 1 << 15
MOST = 1 << 24


class Orchard:
    """Nearest entries of one codebook: rows of whole numbers; ties go to the smaller index."""

    def __init__(self, entries: np.ndarray):
        self.entries, n = entries, len(entries)
        apart = ((entries[:, None, :] - entries[None, :, :]) ** 2).sum(axis=2)
        self.lists = np.lexsort((np.broadcast_to(np.arange(n), (n, n)), apart), axis=1)
        self.apart = np.take_along_axis(apart, self.lists, axis=1)
        sums = entries.sum(axis=1)
        self.by_sum = np.argsort(sums, kind="stable")
        self.sums = sums[self.by_sum]

    def nearest(self, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of the nearest entry of each part, and its squared distance."""
        n = len(self.entries)
        best = self.by_sum[np.minimum(np.searchsorted(self.sums, parts.sum(axis=1)), n - 1)]
        least = ((parts - self.entries[best]) ** 2).sum(axis=1)
        seen = np.zeros((len(parts), n), bool)
        seen[np.arange(len(parts)), best] = True
        walking, at = np.arange(len(parts)), np.zeros(len(parts), np.int64)
        while len(walking):
            here = best[walking]
            # Squared: beyond twice the distance is beyond four times its square.
            on = (at < n) & (self.apart[here, np.minimum(at, n - 1)] <= 4 * least[walking])
            walking, at, here = walking[on], at[on], here[on]
            other = self.lists[here, at]
            at += 1
            new = ~seen[walking, other]
            rows, found = walking[new], other[new]
            seen[rows, found] = True
            apart = ((parts[rows] - self.entries[found]) ** 2).sum(axis=1)
            better = (apart < least[rows]) | ((apart == least[rows]) & (found < best[rows]))
            best[rows[better]], least[rows[better]] = found[better], apart[better]
            at[np.flatnonzero(new)[better]] = 0
        return best, least


def assign(vectors: np.ndarray, codebooks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per vector the entry of each part, and each part's squared distance. codebooks: part, entry, component."""
    codes = np.empty((len(vectors), len(codebooks)), np.int64)
    apart = np.empty_like(codes)
    parts = vectors.reshape(len(vectors), len(codebooks), -1)
    for k, entries in enumerate(codebooks):
        search = Orchard(entries)
        for at in range(0, len(vectors), BATCH):
            codes[at : at + BATCH, k], apart[at : at + BATCH, k] = search.nearest(parts[at : at + BATCH, k])
    return codes, apart


def whole_numbers(table: DataFrame, parts: int, id_col: str, vec_col: str, label_col: str) -> DataFrame:
    """(id, label, size, v): the rows that can be coded; v holds the components as little-endian 64-bit integers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, labels, sizes, out = [], [], [], []
            for k, item in enumerate(batch.column(2)):
                if not item.is_valid or item.values.null_count:
                    continue
                v = item.values.to_numpy(zero_copy_only=False)
                if not len(v) or len(v) % parts or not np.isfinite(v).all():
                    continue
                whole = np.floor(256 * v)
                if (np.abs(whole) >= MOST).any():
                    raise ArithmeticError(f"a component of row {k} of a batch is too large for exact errors")
                ids.append(k)
                sizes.append(len(v))
                out.append(whole.astype("<i8").tobytes())
            kept = pa.array(ids, pa.int64())
            columns = [batch.column(0).take(kept), batch.column(1).take(kept), pa.array(sizes, pa.int32()), pa.array(out, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["id", "label", "size", "v"])

    rows = table.select(
        F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("string").alias("label"), F.col(vec_col).cast("array<double>").alias("v")
    )
    return rows.mapInArrow(run, "id long, label string, size int, v binary")


def matrix(column: pa.Array, size: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<i8").reshape(len(column), size).astype(np.int64)


def moved(rows: DataFrame, codebooks: np.ndarray, size: int) -> np.ndarray:
    """The codebooks after one round: means of the parts next to each entry; an entry without any stays."""
    kept = rows.sparkSession.sparkContext.broadcast(codebooks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = kept.value
        parts, entries, width = books.shape
        counts, sums = np.zeros(parts * entries, np.int64), np.zeros((parts * entries, width), np.int64)
        for batch in batches:
            vectors = matrix(batch.column(0), size)
            codes, _ = assign(vectors, books)
            cells = (codes + np.arange(parts) * entries).ravel()
            counts += np.bincount(cells, minlength=len(counts))
            np.add.at(sums, cells, vectors.reshape(-1, width))
        cell = np.repeat(np.flatnonzero(counts), width)
        place = np.tile(np.arange(width), len(cell) // width)
        columns = [cell, place, sums[cell, place], counts[cell]]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["cell", "place", "total", "many"])

    tallied = rows.select("v").mapInArrow(run, "cell long, place long, total long, many long").groupBy("cell", "place")
    # At most parts * entries * width rows, whatever the table's size. Sums of all rows may pass a long, so they're decimals.
    means = tallied.agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"), F.sum("many").alias("many")).toArrow()
    books = codebooks.copy().reshape(-1, codebooks.shape[2])
    for cell, place, total, many in zip(*(means.column(c).to_pylist() for c in ("cell", "place", "total", "many"))):
        books[cell, place] = int(total) // many
    return books.reshape(codebooks.shape)


def codebooks_sha256(codebooks: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, codebooks.ravel().tolist())).encode()).hexdigest()


def compress(
    table: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label"
) -> tuple[DataFrame, np.ndarray]:
    """(id, label, codes as one byte a part, error) of each row that can be coded, and the codebooks (part, entry, component)."""
    rows = cut(whole_numbers(table, parts, id_col, vec_col, label_col), "whole_numbers")
    by_id = [F.col("id").asc_nulls_last(), F.col("v")]
    first = rows.orderBy(*by_id).limit(1).collect()
    size = first[0]["size"] if first else parts
    rows = rows.where(F.col("size") == size)
    first = rows.orderBy(*by_id).limit(entries).collect()
    start = np.array([np.frombuffer(r["v"], "<i8") for r in first], np.int64).reshape(len(first), parts, size // parts)
    codebooks = np.ascontiguousarray(start.transpose(1, 0, 2))
    for _ in range(rounds if len(first) else 0):
        codebooks = moved(rows, codebooks, size)
    kept = rows.sparkSession.sparkContext.broadcast(codebooks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes, apart = assign(matrix(batch.column(2), size), kept.value)
            out = [c.tobytes() for c in codes.astype(np.uint8)]
            columns = [batch.column(0), batch.column(1), pa.array(out, pa.binary()), pa.array(apart.sum(axis=1), pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["id", "label", "codes", "error"])

    coded = rows.select("id", "label", "v").mapInArrow(run, "id long, label string, codes binary, error long")
    return coded.withColumnRenamed("id", id_col).withColumnRenamed("label", label_col), codebooks


def report(table: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """Per coded row: id, code, error, label_error, codebooks_sha256."""
    coded, codebooks = compress(table, id_col=id_col, vec_col=vec_col, label_col=label_col)
    coded = cut(coded.select(F.col(id_col).alias("id"), F.col(label_col).alias("label"), F.lower(F.hex("codes")).alias("code"), "error"), "codes")
    by_label = coded.groupBy(F.col("label").alias("of_label")).agg(F.sum("error").alias("label_error"))
    return coded.join(by_label, F.col("label").eqNullSafe(F.col("of_label")), "left").select(
        F.col("id").alias(id_col), "code", "error", "label_error", F.lit(codebooks_sha256(codebooks)).alias("codebooks_sha256")
    )
