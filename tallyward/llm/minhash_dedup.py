"""Near-duplicate documents by one-permutation MinHash, banded buckets and star-shaped candidate edges.

A document's set is its distinct word shingles, as 64-bit hashes. Documents with equal sets become one class first. One
hash value per shingle is both bin and rank: a bin's value is the smallest hash in it, and an empty bin takes the value of
the first filled bin on its own probe sequence (optimal densification), which keeps the chance of agreement at the
similarity for short texts too. ``BINS / ROWS`` bands give buckets.

Candidates are stars: each bucket names one centre, and only pairs of centre and member are compared, so a bucket of m
classes gives m - 1 pairs. Pairs are confirmed on the full sets. Buckets whose members aren't all in one component yet
name ``CENTRES`` others in the next round, members of the smallest components first, so that stragglers get compared with
all of their bucket. At most ``ROUNDS`` rounds run, and none behind one that linked nothing.

*What the stars leave.* Members of buckets that are still open, and all sets of few shingles (whose bins hide each other, so
that a band may be missed), are joined exactly by prefixes: with a set's shingles ordered by how many of these sets hold them,
rarest first, two sets at the threshold share a shingle among the first ``n - ceil(0.75 n) + 1`` of both. Only shingles that
several sets hold are kept, counted from the end, so a set without three quarters of such shingles drops out; sizes and the
place of the shared shingle rule out most others within the join. A passage that very many documents share lies at the end
of their order, so it brings no pairs. A pair of larger sets at similarity 0.75 shares no bucket with a chance of 5e-6.

Skew: copies collapse before anything is joined; buckets are counted with partial aggregates; a centre with very many
members is one row on the other side of a join that AQE splits.

Defined cases: texts that are null or hold no word have an empty set and link with nothing; fewer words than a shingle
make one shingle; rows that share an id are one vertex, for which the set with the smallest key speaks when they differ; a
row without an id links with nothing, has no component and is kept; other input columns are ignored; an empty table has no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyward.llm.components import components
from tallyward.sources.shared import cut

WORDS = 5
NUMERATOR, DENOMINATOR = 75, 100
BINS, ROWS = 128, 4
CENTRES = 4
ROUNDS = 2
#: Sets of so few shingles, and what may be similar to them, are compared exactly.
FEW = 32
KNOWN_WORDS = 200_000

_U = np.uint64


class WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= KNOWN_WORDS:
            self.clear()
        self[word] = value = xxhash.xxh3_64_intdigest(word)
        return value


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijective finaliser that spreads 64-bit values."""
    h = (h ^ (h >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> _U(27))) * _U(0x94D049BB133111EB)
    return h ^ (h >> _U(31))


def shingles(text: str | None, size: int, known: WordHashes) -> np.ndarray:
    """Sorted distinct hashes of the text's shingles. ``bytes.lower`` and ``bytes.split`` are just A-Z and \\x20\\x09-\\x0D."""
    words = (text or "").encode().lower().split()
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
    n = max(1, len(words) - size + 1)
    value = np.full(n, len(words) if len(words) < size else size, np.uint64)
    for k in range(min(size, len(words))):
        value = mixed(value * _U(0x9E3779B97F4A7C15) + h[k : k + n])
    return np.unique(value)


def signature(hashes: np.ndarray, bins: int, probes: np.ndarray) -> np.ndarray:
    """Smallest hash of each bin; ``hashes`` is sorted and the top bits are the bin."""
    width = _U(64 - (bins.bit_length() - 1))
    starts = np.arange(bins, dtype=np.uint64) << width
    at = np.searchsorted(hashes, starts)
    filled = at < len(hashes)
    filled[filled] = (hashes[at[filled]] >> width) == np.flatnonzero(filled)
    value = np.zeros(bins, np.uint64)
    value[filled] = hashes[at[filled]]
    empty = np.flatnonzero(~filled)
    step = 0
    while len(empty):
        # Probe sequences are drawn once; longer ones go on from there with the step mixed in.
        to = probes[empty, step] if step < probes.shape[1] else (mixed(empty.astype(np.uint64) + _U(step << 20)) % _U(bins)).astype(np.int64)
        hit = filled[to]
        value[empty[hit]] = value[to[hit]]
        empty = empty[~hit]
        step += 1
    return value


def probe_table(bins: int, length: int = 512) -> np.ndarray:
    numbers = np.arange(bins * length, dtype=np.uint64).reshape(bins, length)
    return (mixed(numbers + _U(0x5851F42D4C957F2D)) % _U(bins)).astype(np.int64)


def band_keys(values: np.ndarray, rows: int) -> np.ndarray:
    """One 64-bit key a band, with the band's number in it."""
    table = values.reshape(-1, rows)
    key = np.arange(1, len(table) + 1, dtype=np.uint64)
    for k in range(rows):
        key = mixed(key * _U(0x9E3779B97F4A7C15) + table[:, k])
    return key.astype(np.int64)


def hash_sets(docs: DataFrame, words: int, bins: int = 0, rows: int = ROWS) -> DataFrame:
    """(id, n_shingles, set_key, hashes): the bands' keys if ``bins``, else the shingles' hashes themselves. set_key is null for empty sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, probes = WordHashes(), probe_table(bins) if bins else None
        for batch in batches:
            sizes, keys, lists = [], [], []
            for text in batch.column(1):
                found = shingles(text.as_py(), words, known)
                sizes.append(len(found))
                keys.append(hashlib.md5(found.tobytes()).digest() if len(found) else None)
                values = signature(found, bins, probes) if bins and len(found) else None
                lists.append(None if not len(found) else found.astype(np.int64) if values is None else band_keys(values, rows))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()), pa.array(lists, pa.list_(pa.int64()))],
                ["id", "n_shingles", "set_key", "hashes"],
            )

    return docs.select("id", "text").mapInArrow(run, "id long, n_shingles long, set_key binary, hashes array<long>")


def full_sets(wanted: DataFrame, docs: DataFrame, reps: DataFrame, words: int) -> DataFrame:
    """(id, hashes) of the class representatives ``wanted`` (rep)."""
    wanted = wanted.join(reps.select("rep", "set_key"), "rep")
    texts = docs.join(wanted.select(F.col("rep").alias("id")), "id", "left_semi")
    # An id may stand for several texts; the one that speaks has the class's key.
    speaks = wanted.select(F.col("rep").alias("id"), F.col("set_key").alias("key"))
    sets = hash_sets(texts, words).join(speaks, "id").where(F.col("set_key") == F.col("key"))
    return cut(sets.select("id", "hashes").dropDuplicates(["id"]), "sets")


def confirmed(pairs: DataFrame, sets: DataFrame, numerator: int, denominator: int) -> DataFrame:
    """Pairs (a, b) of class representatives, with their sets' sizes, whose full sets are similar enough."""
    side = lambda name: sets.select(F.col("id").alias(name), F.col("hashes").alias(f"set_{name}"))
    shared = F.size(F.array_intersect("set_a", "set_b")).cast("long")
    similar = shared * denominator >= (F.col("n_a") + F.col("n_b") - shared) * numerator
    return pairs.join(side("b"), "b").join(side("a"), "a").where(similar).select("a", "b")


def ends_of(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("a").alias("rep")).unionByName(pairs.select(F.col("b").alias("rep"))).distinct()


def merged(parts: DataFrame | None, found: DataFrame) -> DataFrame:
    """(rep, part) after the links (a, b) joined parts; only links between parts are followed."""
    if parts is None:
        return components(found).select(F.col("node").alias("rep"), F.col("component").alias("part"))
    part_of = lambda end: parts.select(F.col("rep").alias(end), F.col("part").alias(f"part_{end}"))
    between = found.join(part_of("a"), "a", "left").join(part_of("b"), "b", "left")
    joined = components(between.select(F.coalesce("part_a", "a").alias("a"), F.coalesce("part_b", "b").alias("b")))
    joined = joined.select(F.col("node").alias("part"), F.col("component").alias("onto"))
    fresh = joined.select(F.col("part").alias("rep")).join(parts.select("rep"), "rep", "left_anti").withColumn("part", F.col("rep"))
    return parts.unionByName(fresh).join(joined, "part", "left").select("rep", F.coalesce("onto", "part").alias("part"))


def prefix_pairs(rows: DataFrame, sets: DataFrame, numerator: int, denominator: int) -> DataFrame:
    """Pairs (a, b, n_a, n_b) of ``rows`` (rep, n_shingles, part) in different parts that may be similar enough; none that is gets lost."""
    held = rows.join(sets.withColumnRenamed("id", "rep"), "rep")
    tokens = held.select("rep", "n_shingles", "part", F.explode("hashes").alias("token"))
    often = tokens.groupBy("token").agg(F.count("*").alias("holders")).where("holders > 1")
    common = tokens.join(often, "token")
    # Places count from the rarest shingle on; those that no other set holds come first and aren't needed.
    from_end = F.row_number().over(Window.partitionBy("rep").orderBy(F.desc("holders"), "token"))
    placed = common.withColumn("place", F.col("n_shingles") - from_end)
    needed = F.expr(f"(n_shingles * {numerator} + {denominator} - 1) div {denominator}")
    prefix = cut(placed.where(F.col("place") <= F.col("n_shingles") - needed).select("token", "rep", "n_shingles", "part", "place"), "prefixes")
    side = lambda name: prefix.select("token", *[F.col(c).alias(f"{c}_{name}") for c in ("rep", "n_shingles", "part", "place")])
    n_a, n_b = F.col("n_shingles_a"), F.col("n_shingles_b")
    fits = F.least(n_a, n_b) * denominator >= F.greatest(n_a, n_b) * numerator
    # What both can still share from this shingle on must reach the overlap that the sizes ask for.
    left = F.least(n_a - F.col("place_a"), n_b - F.col("place_b"))
    reaches = left * (numerator + denominator) >= (n_a + n_b) * numerator
    pairs = side("a").join(side("b"), "token").where((F.col("rep_a") < F.col("rep_b")) & (F.col("part_a") != F.col("part_b")) & fits & reaches)
    return pairs.select(F.col("rep_a").alias("a"), F.col("rep_b").alias("b"), n_a.alias("n_a"), n_b.alias("n_b")).distinct()


def near_duplicates(
    docs: DataFrame, words: int = WORDS, numerator: int = NUMERATOR, denominator: int = DENOMINATOR, bins: int = BINS, rows: int = ROWS,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """One row per row of ``docs``: id, n_shingles, component_id (smallest id reachable), kept (id is component_id)."""
    docs = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    signed = cut(hash_sets(docs, words, bins, rows), "signatures")
    usable = signed.where("id is not null and set_key is not null").groupBy("id").agg(F.min("set_key").alias("set_key"))
    firsts = usable.groupBy("set_key").agg(F.min("id").alias("rep")).withColumnRenamed("set_key", "key")
    classes = cut(
        signed.join(firsts, (F.col("id") == F.col("rep")) & (F.col("set_key") == F.col("key")))
        .select("rep", "set_key", "n_shingles", F.col("hashes").alias("bands"))
        .dropDuplicates(["rep"]),
        "classes",
    )
    reps = classes.select("rep", "set_key", "n_shingles")
    buckets = classes.select("rep", "n_shingles", F.explode("bands").alias("bucket"))
    crowded = buckets.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1").select("bucket")
    members = cut(buckets.join(crowded, "bucket"), "buckets")

    # parts: of the classes that are linked so far, the smallest one reachable.
    parts, compared = None, None
    columns = ["bucket", "rep", "n_shingles", "part", "size"]
    open_members = members.withColumn("part", F.col("rep")).withColumn("size", F.lit(1).cast("long"))
    for turn in range(ROUNDS + 1):
        if turn:
            still_open = open_members.groupBy("bucket").agg(F.min("part").alias("low"), F.max("part").alias("high")).where("low <> high")
            open_members = cut(open_members.join(still_open.select("bucket"), "bucket"), "members")
        if turn == ROUNDS:
            break
        order, slot = F.col("rep"), F.lit(0)
        if turn:
            # Small components first, in another order every round.
            order = F.least("size", F.lit(1 << 20)) * (1 << 40) + F.pmod(F.xxhash64("rep", "bucket", F.lit(turn)), F.lit(1 << 40))
            slot = F.pmod(F.xxhash64("rep", F.lit(turn)), F.lit(CENTRES))
        centres = open_members.groupBy("bucket", slot.alias("slot")).agg(
            F.min_by("rep", order).alias("a"), F.min_by("n_shingles", order).alias("n_a"), F.min_by("part", order).alias("part_a")
        )
        stars = open_members.join(centres.drop("slot"), "bucket")
        # Sets whose sizes alone rule the similarity out need no comparison.
        fits = F.least("n_a", "n_shingles") * denominator >= F.greatest("n_a", "n_shingles") * numerator
        ends = [F.struct(F.col("a").alias("id"), F.col("n_a").alias("n")), F.struct(F.col("rep").alias("id"), F.col("n_shingles").alias("n"))]
        pairs = stars.where((F.col("part") != F.col("part_a")) & fits).select(F.least(*ends).alias("a"), F.greatest(*ends).alias("b"))
        pairs = pairs.select(F.col("a.id").alias("a"), F.col("b.id").alias("b"), F.col("a.n").alias("n_a"), F.col("b.n").alias("n_b")).distinct()
        if compared is not None:
            pairs = pairs.join(compared, ["a", "b"], "left_anti")
        pairs = cut(pairs, "candidates")
        compared = pairs if compared is None else compared.unionByName(pairs)
        found = cut(confirmed(pairs, full_sets(ends_of(pairs), docs, reps, words), numerator, denominator), "links")
        if found.isEmpty():
            break
        parts = cut(merged(parts, found), "parts")
        sized = parts.join(parts.groupBy("part").agg(F.count("*").alias("size")), "part")
        linked = open_members.select("bucket", "rep", "n_shingles").join(sized, "rep", "left")
        open_members = linked.withColumns({"part": F.coalesce("part", "rep"), "size": F.coalesce("size", F.lit(1))}).select(*columns)
    # The rest exactly: members of open buckets, and small sets with all that may be similar to one.
    few = reps.where(F.col("n_shingles") * numerator <= FEW * denominator).select("rep", "n_shingles")
    rest = open_members.select("rep", "n_shingles").unionByName(few).distinct()
    rest = rest.withColumn("part", F.col("rep")) if parts is None else rest.join(parts, "rep", "left").withColumn("part", F.coalesce("part", "rep"))
    rest = cut(rest, "rest")
    sets = full_sets(rest.select("rep"), docs, reps, words)
    pairs = prefix_pairs(rest, sets, numerator, denominator)
    if compared is not None:
        pairs = pairs.join(compared, ["a", "b"], "left_anti")
    found = cut(confirmed(pairs, sets, numerator, denominator), "links")
    if not found.isEmpty():
        parts = cut(merged(parts, found), "parts")
    # Rows that share a set, or an id, belong together without any comparison.
    placed = usable.join(classes.select("set_key", "rep"), "set_key").select("id", "rep")
    if parts is not None:
        placed = placed.join(parts, "rep", "left").select("id", F.coalesce("part", "rep").alias("rep"))
    return (
        signed.select("id", "n_shingles")
        .join(placed.withColumnRenamed("rep", "component"), "id", "left")
        .select(
            F.col("id").alias(id_col), "n_shingles", F.coalesce("component", "id").alias("component_id"),
            F.coalesce(F.coalesce("component", "id") == F.col("id"), F.lit(True)).alias("kept"),
        )
    )


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """Rows of ``docs`` whose id is the smallest of its component; columns as they came. Rows that repeat an id all stay."""
    dropped = near_duplicates(docs, id_col=id_col, text_col=text_col, **options).where("not kept").select(id_col).distinct()
    return docs.join(dropped, id_col, "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])
