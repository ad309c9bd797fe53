"""Near-duplicate vectors by cosine, from int8 tile products with error bounds.

Equal vectors of a label become one class first, so a group of copies is one row from there on. Classes of a label are
dealt by hash into tiles of about ``TILE`` rows, and every pair of tiles of the label is one group: rows are sent once for
each tile of their label. Within a pair, vectors of unit length are rounded to int8; ``x = q/s + e`` with the length of e
kept per vector, so a product of two vectors differs from the product of their codes by at most ``d1 + d2 + 3*d1*d2``.
Only pairs whose product may reach the threshold within that bound are recomputed in double precision.

A pair of tiles returns, per class, how many vectors it links to, and a spanning forest of the links (at most one edge a
row), never the pairs themselves; components come from the forests of all pairs. Memory of a task: two tiles and a block
of ``BLOCK * TILE`` products.

Defined cases: a vector that is null, empty, zero, or holds null or non-finite values links with nothing, nor does one
whose label or id is null, nor two vectors of different length; such rows are their own component. Rows that share an
id are one vertex. The work grows with the square of a label's distinct vectors, in blocks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyward.llm.components import components
from tallyward.sources.shared import cut

THRESHOLD = 0.98
TILE = 3072
BLOCK = 512
#: What float32 scaling may add to an error bound.
SLACK = 1e-5


def codes(unit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """int8 codes of rows of unit length, their scales, and the length of what rounding left over."""
    scale = 127.0 / np.abs(unit).max(axis=1)
    q = np.rint(unit * scale[:, None]).astype(np.int8)
    return q, scale, np.linalg.norm(unit - q / scale[:, None], axis=1)


def linked(x: np.ndarray, y: np.ndarray, threshold: float, same: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs of rows of ``x`` and ``y`` with cosine at or above the threshold, block by block; same: i < j only."""
    nx, ny = np.linalg.norm(x, axis=1), np.linalg.norm(y, axis=1)
    (qx, sx, dx), (qy, sy, dy) = codes(x / nx[:, None]), codes(y / ny[:, None])
    # Products of int8 codes are sums of integers: exact in float32 below 2**24, in float64 beyond.
    exact = np.float32 if x.shape[1] * 127 * 127 < 2**24 else np.float64
    right = np.ascontiguousarray(qy.T.astype(exact))
    for at in range(0, len(x), BLOCK):
        rows = slice(at, at + BLOCK)
        about = (qx[rows].astype(exact) @ right) / sx[rows, None].astype(exact) / sy[None, :].astype(exact)
        bound = dx[rows, None] + dy[None, :] + 3 * dx[rows, None] * dy[None, :] + SLACK
        i, j = np.nonzero(about + bound >= threshold)
        i += at
        if same:
            i, j = i[i < j], j[i < j]
        keep = np.empty(len(i), bool)
        for k in range(0, len(i), 65536):
            a, b = i[k : k + 65536], j[k : k + 65536]
            keep[k : k + 65536] = np.einsum("ij,ij->i", x[a], y[b]) / (nx[a] * ny[b]) >= threshold
        yield i[keep], j[keep]


def tile_pair(group: pd.DataFrame, threshold: float) -> pd.DataFrame:
    """Links within one pair of tiles: per class how many vectors it links to, and an edge to its local root."""
    first = group["tile"].to_numpy() == group["tile_a"].to_numpy()
    same = bool(group["tile_a"].iloc[0] == group["tile_b"].iloc[0])
    ids, sizes = group["rep"].to_numpy(), group["size"].to_numpy()
    vectors = np.frombuffer(b"".join(group["vec"]), "<f8").reshape(len(group), -1)
    left, right = np.flatnonzero(first), np.arange(len(group)) if same else np.flatnonzero(~first)
    counts, root = np.zeros(len(group), np.int64), np.arange(len(group))
    if len(left) and len(right):
        for i, j in linked(vectors[left], vectors[right], threshold, same):
            i, j = left[i], right[j]
            counts += np.bincount(i, sizes[j], len(group)).astype(np.int64) + np.bincount(j, sizes[i], len(group)).astype(np.int64)
            starts = np.flatnonzero(np.r_[True, i[1:] != i[:-1]]) if len(i) else []
            for a, z in zip(starts, [*starts[1:], len(i)]):
                around = np.unique(np.r_[root[i[a]], root[j[a:z]]])
                if len(around) > 1:
                    root[np.isin(root, around)] = around[0]
    hit = counts > 0
    smallest = pd.Series(ids).groupby(root).transform("min").to_numpy()
    return pd.DataFrame({"rep": ids[hit], "links": counts[hit], "other": smallest[hit]})


def near_duplicates(
    table: DataFrame, threshold: float = THRESHOLD, tile: int = TILE, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label"
) -> DataFrame:
    """One row per row of ``table``: id, n_links, component_id (smallest id reachable), kept (id is component_id)."""
    rows = table.select(
        F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("string").alias("label"), F.col(vec_col).cast("array<double>").alias("v")
    )

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for item in batch.column(2):
                v = np.array(item.as_py() or [], dtype=np.float64)  # null components become nan
                good = len(v) and np.isfinite(v).all() and v.any()
                # Scaled by a power of two, which leaves the cosine as it is and keeps squares within range.
                out.append((np.ldexp(v, -int(np.frexp(np.abs(v).max())[1])) + 0.0).astype("<f8").tobytes() if good else None)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.binary())], ["id", "label", "vec"])

    rows = rows.mapInArrow(digest, "id long, label string, vec binary")
    usable = F.col("vec").isNotNull() & F.col("label").isNotNull() & F.col("id").isNotNull()
    keyed = cut(rows.withColumn("key", F.when(usable, F.md5(F.concat("vec", F.encode("label", "utf-8"))))), "vectors")
    classes = cut(
        keyed.where("key is not null")
        .groupBy("key")
        .agg(F.min("id").alias("rep"), F.count("*").alias("size"), F.first("label").alias("label"), F.first("vec").alias("vec"))
        .withColumn("dim", F.octet_length("vec")),
        "classes",
    )
    tiles = classes.groupBy("label", "dim").agg(F.ceil(F.count("*") / tile).cast("int").alias("tiles"))
    dealt = (
        classes.join(tiles, ["label", "dim"])
        .withColumn("tile", F.pmod(F.xxhash64("key"), F.col("tiles")).cast("int"))
        .withColumn("with", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
        .withColumn("tile_a", F.least("tile", "with"))
        .withColumn("tile_b", F.greatest("tile", "with"))
        .select("label", "dim", "tile_a", "tile_b", "tile", "rep", "size", "vec")
    )
    found = cut(
        dealt.groupBy("label", "dim", "tile_a", "tile_b").applyInPandas(
            lambda group: tile_pair(group, threshold), "rep long, links long, other long"
        ),
        "tile_links",
    )
    links = found.groupBy("rep").agg(F.sum("links").alias("links"))
    # Rows that share an id are one vertex, also when their vectors differ.
    hung = keyed.where("key is not null").select("key", "id").distinct().join(classes.select("key", "rep"), "key").where("id <> rep")
    parts = components(found.select(F.col("rep").alias("a"), F.col("other").alias("b")).unionByName(hung.select(F.col("id").alias("a"), F.col("rep").alias("b"))))
    return (
        keyed.select("id", "key")
        .join(classes.select("key", "rep", "size"), "key", "left")
        .join(links, "rep", "left")
        .join(parts.withColumnRenamed("node", "id"), "id", "left")
        .select(
            F.col("id").alias(id_col),
            (F.coalesce("links", F.lit(0)) + F.coalesce(F.col("size") - 1, F.lit(0))).alias("n_links"),
            F.coalesce("component", "id").alias("component_id"),
            F.coalesce(F.coalesce("component", "id") == F.col("id"), F.lit(True)).alias("kept"),
        )
    )
