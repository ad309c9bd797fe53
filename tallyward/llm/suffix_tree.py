"""Language-model scores from a probabilistic suffix tree over words.

Symbols are the words of a text (A-Z in lower case), then one end. The root holds the next-symbol distribution without
context: absolute discounting of the training counts, the rest of the mass for unknown words. A state is a context of up
to ``DEPTH`` words, of any words. It is kept when its next-symbol distribution diverges from that of its longest proper
suffix: over the symbols that follow it at least ``LEAST`` times, the counts times their log ratio must add up to
``DIVERGENCE`` a state, and within it a symbol counts as its own when it alone reaches ``SYMBOL_DIVERGENCE``. A kept state
smooths its counts with ``PRIOR`` virtual counts of its suffix's distribution, and symbols that aren't its own share what is
left in proportion to that distribution; probabilities of every state add up to one. A symbol is scored at the state of the
longest suffix of what stands before it.

The tree is a table. A word, or a sequence of a context and its next symbol, is named by a 64-bit digest, and what it adds
to the log10 probability of a text wherever it stands is a row: words what the root says, own symbols what they differ by
from the suffix's distribution, states what they scale other symbols by. Lengths are counted one after the other, and only
sequences whose two shorter parts stand at least ``LEAST`` times. Words that make 1 / ``VOCABULARY`` of all tokens and
sequences that make 1 / ``SEQUENCES``, so at most that many of each length, go to the tasks, which look them up in place; all
others are joined by digest, so no join has hot rows. Filters of at most ``FILTER_BITS`` keep digests without a row at home;
where they fill up, more rows are shuffled and results stay. No constant but ``DEPTH``, ``LEAST``, ``DIVERGENCE``,
``SYMBOL_DIVERGENCE`` and ``PRIOR`` changes a score.

Defined cases: null and empty texts are one end; rows without an id are training rows like any other and are scored;
repeated rows count as often as they stand; other input columns are ignored; without training rows every score is 0.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.core.broadcast import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyward.sources.shared import cut, drop_shuffles, new_folder, scratch, shuffles_dropped

DEPTH = 2
LEAST = 2
VOCABULARY = 1 << 17
SEQUENCES = 1 << 19
# What ``Tree`` shows on the driver: words up to so many bytes, and states whose context words make 1 / ``CONTEXT_WORDS``.
LONGEST = 64
CONTEXT_WORDS = 1 << 10
DIVERGENCE = 20.0
SYMBOL_DIVERGENCE = 6.0
PRIOR = 20.0
COUNTED_WORDS = 400_000
HELD_SEQUENCES = 1 << 20
HELD_LOOKUPS = 1 << 19
SENT_ROWS = 1 << 17
CHUNK_CHARS = 1 << 22
# Rows that a bucket of packed rows holds, about.
BUCKET_ROWS = 1 << 18
# Documents are scored in so many parts by the hash of their id, one after the other: what one part looks up lies on disk at a time.
SLICES = 4
FILTER_BITS = 1 << 28
# Positions that one bitmap of ``bitmap_construct_agg`` has.
BITMAP_BITS = 1 << 15
#: Packed rows of a bucket: of the tree, to look up in it, and documents.
TABLE, LOOKUPS, DOCUMENT = range(3)
#: The end of a text, as a word that no text holds.
END = b"\n"


def words_of(text: str | None) -> list[bytes]:
    return [*(text or "").encode().lower().split(), END]


def digests(words: pa.Array) -> np.ndarray:
    return pd.util.hash_array(words.cast(pa.binary()).to_numpy(zero_copy_only=False), categorize=False)


def sequence_digests(contexts: np.ndarray, suffixes: np.ndarray, length: int) -> np.ndarray:
    """Digest of a sequence from those of all but its last word and of all but its first."""
    with np.errstate(over="ignore"):
        x = contexts * np.uint64(0x9E3779B97F4A7C15) + suffixes + np.uint64(length)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def chunks(texts: pa.Array) -> Iterator[pa.Array]:
    """Runs of texts of about ``CHUNK_CHARS`` bytes."""
    texts = pc.fill_null(texts.cast(pa.string()), "")
    sizes, first = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False)), 0
    while first < len(texts):
        done = sizes[first - 1] if first else 0
        after = min(int(np.searchsorted(sizes, done + CHUNK_CHARS)) + 1, len(texts))
        yield texts.slice(first, after - first)
        first = after


def numbered_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The distinct words, the number among them of each word of all texts in order, and the words of each text; ends included."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts))
    flat, of = lists.flatten(), pc.list_parent_indices(lists).to_numpy()
    filled = pc.greater(pc.binary_length(flat), 0)
    lengths = np.bincount(of[filled.to_numpy(zero_copy_only=False)], minlength=len(texts)) + 1
    coded = flat.filter(filled).dictionary_encode()
    words = pa.concat_arrays([coded.dictionary.cast(pa.binary()), pa.array([END], pa.binary())])
    ends = np.zeros(int(lengths.sum()), bool)
    ends[np.cumsum(lengths) - 1] = True
    numbers = np.full(len(ends), len(words) - 1)
    numbers[~ends] = coded.indices.to_numpy()
    return words, numbers, lengths


def count_words(texts: DataFrame) -> DataFrame:
    """(word, c, key) over the column ``text``; counts leave a task before they grow past ``COUNTED_WORDS`` words."""

    def added(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        sums = pa.Table.from_batches(held).group_by("word", use_threads=False).aggregate([("c", "sum")])
        sums = sums.select(["word", "c_sum"]).rename_columns(["word", "c"]).combine_chunks()
        return pa.RecordBatch.from_arrays([pa.concat_arrays(c.chunks) for c in sums.columns], ["word", "c"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            for texts in chunks(batch.column(0)):
                words, numbers, _ = numbered_words(texts)
                held.append(pa.RecordBatch.from_arrays([words, pa.array(np.bincount(numbers, minlength=len(words)))], ["word", "c"]))
                if sum(map(len, held)) >= COUNTED_WORDS:
                    held = [added(held)]
                    if 2 * len(held[0]) >= COUNTED_WORDS:
                        yield from held
                        held = []
        if held:
            yield added(held)

    def with_key(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(digests(batch.column(0)).view(np.int64))], ["word", "c", "key"])

    sums = texts.select("text").mapInArrow(run, "word binary, c long").groupBy("word").agg(F.sum("c").alias("c"))
    return sums.mapInArrow(with_key, "word binary, c long, key long")


def bucket_bits(rows: int) -> int:
    """How many of the highest bits of a digest tell its bucket, for so many rows."""
    return max(1, (rows // BUCKET_ROWS).bit_length())


def roughly(keys: np.ndarray) -> np.ndarray:
    """Their order by all but the lowest bits: places stand there instead, as numbers sort several times faster than they are ranked."""
    low = np.uint64((1 << len(keys).bit_length()) - 1)
    return (np.sort(keys & ~low | np.arange(len(keys), dtype=np.uint64)) & low).astype(np.int64)


def ordered(keys: np.ndarray) -> np.ndarray:
    order = roughly(keys)
    at = keys[order]
    return order if (at[1:] >= at[:-1]).all() else np.argsort(keys)


def firsts(keys: np.ndarray) -> np.ndarray:
    """Where each run of equal keys starts."""
    return np.flatnonzero(np.concatenate([np.ones(min(1, len(keys)), bool), keys[1:] != keys[:-1]]))


def dealt(keys: np.ndarray, order: np.ndarray, columns: list[np.ndarray], bits: int) -> tuple[list[int], list[bytes]]:
    """Buckets, and the rows of each in ``order``: columns of eight bytes, one behind the other. The order keeps the keys of a bucket together."""
    rows = np.empty((len(columns), len(order)), np.uint64)
    for row, column in zip(rows, columns):
        np.take(column.view(np.uint64), order, out=row, mode="clip")
    bucket = (keys[order] >> np.uint64(64 - bits)).astype(np.int64)
    edges = np.flatnonzero(np.diff(bucket, prepend=-1, append=-1)) if len(bucket) else np.zeros(0, np.int64)
    return bucket[edges[:-1]].tolist(), [rows[:, a:z].tobytes() for a, z in zip(edges[:-1], edges[1:])]


PACKED = "bucket int, rows binary"


def packed_rows(buckets: list[int], rows: list[bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(buckets, pa.int32()), pa.array(rows, pa.binary())], ["bucket", "rows"])


def unpacked(rows: pa.Scalar, width: int) -> np.ndarray:
    return np.frombuffer(rows.as_buffer(), np.uint64).reshape(width, -1)


def whole_buckets(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[int, np.ndarray]]:
    """Each bucket with all its rows, from (bucket, rows) in the order of buckets."""
    held: list[np.ndarray] = []
    of = None
    for batch in batches:
        for bucket, rows in zip(batch.column(0).to_pylist(), batch.column(1)):
            if held and bucket != of:
                yield of, np.concatenate(held, axis=1)
                held = []
            held.append(unpacked(rows, width))
            of = bucket
    if held:
        yield of, np.concatenate(held, axis=1)


def by_bucket(packed: DataFrame, *then: str) -> DataFrame:
    return packed.repartition("bucket").sortWithinPartitions("bucket", *then)


class Bits:
    """A set of digests as bits: what was added passes, and little else."""

    def __init__(self, size: int):
        self.mask = size - 1
        self.bits = np.zeros(size // 8, np.uint8)

    def add(self, found: np.ndarray) -> None:
        slot = np.unique(found[~self.passes(found)] & np.uint64(self.mask))
        np.add.at(self.bits, slot >> np.uint64(3), np.uint8(1) << (slot & np.uint64(7)).astype(np.uint8))

    def passes(self, found: np.ndarray) -> np.ndarray:
        slot = found & np.uint64(self.mask)
        return (self.bits[slot >> np.uint64(3)] >> (slot & np.uint64(7)).astype(np.uint8) & 1).astype(bool)


class Filter(Bits):
    """The column ``key`` of ``n`` rows as bits. Tasks send the bitmaps that their rows fill."""

    def __init__(self, keys: DataFrame, n: int):
        size, page = max(BITMAP_BITS, min(FILTER_BITS, 1 << (16 * n).bit_length())), BITMAP_BITS // 8
        super().__init__(size)

        def pages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            own = Bits(size)
            for batch in batches:
                own.add(batch.column(0).to_numpy().view(np.uint64))
            rows = own.bits.reshape(-1, page)
            filled = np.flatnonzero(rows.any(axis=1))
            for first in range(0, len(filled), 1024):
                at = filled[first : first + 1024]
                yield pa.RecordBatch.from_arrays([pa.array(at), pa.array([rows[k].tobytes() for k in at], pa.binary())], ["at", "bits"])

        bitmaps = keys.select("key").mapInArrow(pages, "at long, bits binary").groupBy("at").agg(F.bitmap_or_agg("bits").alias("bits"))
        # At once: an iterator would come back for shuffle files that ``shuffles_dropped`` has removed, and Spark would make them again.
        for at, bits in bitmaps.collect():
            self.bits[at * page : at * page + page] = np.frombuffer(bits, np.uint8)


class Tree:
    """Totals of the training words, and what is frequent: words with their counts, and states below the root."""

    def __init__(self, words: dict[bytes, int], total: int, distinct: int, once: int, twice: int):
        self.total, self.distinct = total, distinct
        self.discount = min(max(once / (once + 2 * twice) if once + twice else 0.5, 0.1), 0.9)
        self.counts = words
        self.symbols = {w: k for k, w in enumerate(sorted(words, key=lambda w: (-words[w], w)))}
        self.states: dict[tuple[int, ...], tuple[float, dict[int, float]]] = {}
        #: (key, base, score) of every word and sequence: the whole tree. frequent: the same of frequent ones, as bits and sorted arrays.
        self.gains: DataFrame | None = None
        self.frequent: tuple[Bits, np.ndarray, np.ndarray, np.ndarray] | None = None
        self.filter: Filter | None = None
        self.bits = 1

    def root(self, c: float) -> float:
        """Probability of a word with count ``c``; 0 is the unknown word."""
        return (c - self.discount) / self.total if c else self.discount * self.distinct / self.total

    def probability(self, context: tuple[int, ...], symbol: int, c: float) -> float:
        while context and context not in self.states:
            context = context[1:]
        if not context:
            return self.root(c)
        rest, own = self.states[context]
        found = own.get(symbol)
        return found if found is not None else rest * self.probability(context[1:], symbol, c)

    def show(self, levels: list[DataFrame]) -> None:
        """Fill ``states`` from the frequent sequences of each length, for contexts of very frequent words."""
        keys = digests(pa.array(list(self.symbols), pa.binary())).view(np.int64).tolist()
        named = {key: (symbol,) for key, symbol in zip(keys, self.symbols.values())}
        heads = {symbol for word, symbol in self.symbols.items() if self.counts[word] * CONTEXT_WORDS >= self.total}
        for level in levels:
            longer = {}
            for r in level.where(F.col("c") * SEQUENCES >= self.total).collect():
                if r["ctx"] in named and r["suffix"] in named:
                    context, symbol = named[r["ctx"]], named[r["suffix"]][-1]
                    longer[r["key"]] = (*context, symbol)
                    if r["own"] and heads.issuperset(context):
                        self.states.setdefault(context, (r["rest"], {}))[1][symbol] = r["p"]
            named = longer

    def hold(self) -> None:
        """Take what is frequent, and the filter of all else, from the table of gains."""
        rows = self.gains.where("frequent").select("key", "base", "score").toPandas()
        keys, place = np.unique(rows["key"].to_numpy(np.int64).view(np.uint64), return_inverse=True)
        often = Bits(max(BITMAP_BITS, 1 << (16 * len(keys)).bit_length()))
        often.add(keys)
        self.frequent = (often, keys, *(np.bincount(place, rows[c].to_numpy(float), len(keys)) for c in ("base", "score")))
        others = self.gains.where("not frequent")
        n = others.count()
        self.filter, self.bits = Filter(others, n), bucket_bits(n)

    def packed(self) -> DataFrame:
        """(bucket, rows): digest, base and score of all that is not frequent, in the order of digests; one row a bucket."""
        bits = self.bits

        def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held: list[pa.RecordBatch] = []
            for batch in batches:
                held.append(batch)
                if sum(map(len, held)) >= HELD_LOOKUPS:
                    yield of(held)
            if held:
                yield of(held)

        def of(held: list[pa.RecordBatch]) -> pa.RecordBatch:
            keys, base, score = (np.concatenate([batch.column(k).to_numpy() for batch in held]) for k in range(3))
            held.clear()
            keys = keys.view(np.uint64)
            return packed_rows(*dealt(keys, roughly(keys), [keys, base, score], bits))

        def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for bucket, (keys, base, score) in whole_buckets(batches, 3):
                order = ordered(keys)
                first = firsts(keys[order])
                sums = [np.add.reduceat(values.view(float)[order], first) for values in (base, score)]
                yield packed_rows([bucket], [np.stack([keys[order[first]], *(x.view(np.uint64) for x in sums)]).tobytes()])

        rows = self.gains.where("not frequent").select("key", "base", "score")
        return by_bucket(rows.mapInArrow(pack, PACKED)).mapInArrow(merged, PACKED)


def longer_digests(found: np.ndarray, length: int) -> np.ndarray:
    """Digests of the sequences of ``length`` that end at each word, from those one shorter; meaningless where a text has too few."""
    return np.concatenate([found[:1], sequence_digests(found[:-1], found[1:], length)])


def words_before(lengths: np.ndarray) -> np.ndarray:
    """How many words stand before each in its text."""
    return np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)


def sequences(texts: pa.Array, length: int, known: Filter) -> tuple[np.ndarray, np.ndarray]:
    """Digests of all but the last word and of all but the first, of every sequence whose two parts are known."""
    words, numbers, lengths = numbered_words(texts)
    found, before = digests(words), words_before(lengths)
    if length == 2:
        ok, found = known.passes(found)[numbers], found[numbers]
    else:
        found = found[numbers]
        for shorter in range(2, length):
            found = longer_digests(found, shorter)
        ok = known.passes(found) & (before >= length - 2)
    at = np.flatnonzero(ok[1:] & ok[:-1] & (before[1:] >= length - 1))
    return found[at], found[at + 1]


def sequence_counts(texts: DataFrame, known: Filter, length: int, total: int) -> DataFrame:
    """(ctx, suffix, c) of the sequences of ``length`` words that stand at least ``LEAST`` times. known: those one shorter. total: all words.

    Most sequences stand once, so a row each would be shuffled and dropped behind: tasks count what they meet and send
    packed buckets of it, and each bucket is summed as a whole.
    """
    shared = texts.sparkSession.sparkContext.broadcast(known)
    bits = bucket_bits(total)
    high = np.uint64((1 << bits) - 1 << 64 - bits)

    def packed(held: list[tuple[np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
        contexts, suffixes = (np.concatenate(part) for part in zip(*held))
        held.clear()
        keys = sequence_digests(contexts, suffixes, length)
        order = roughly(keys)  # few equal ones stand apart, and meet in their bucket
        first = firsts(keys[order])
        c, at = np.diff(first, append=len(keys)), order[first]
        keys, contexts, suffixes = keys[at], contexts[at], suffixes[at]
        order = roughly(keys & high | contexts >> np.uint64(bits))  # rows of one context beside each other compress better
        # A few at a time, as Spark holds a batch beside its heap.
        for at in range(0, len(order), SENT_ROWS):
            yield packed_rows(*dealt(keys, order[at : at + SENT_ROWS], [contexts, suffixes, c], bits))
        pa.default_memory_pool().release_unused()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for texts in chunks(batch.column(0)):
                held.append(sequences(texts, length, shared.value))
                size += len(held[-1][0])
                if size >= HELD_SEQUENCES:
                    yield from packed(held)
                    size = 0
        if held:
            yield from packed(held)

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, (contexts, suffixes, c) in whole_buckets(batches, 3):
            keys = sequence_digests(contexts, suffixes, length)
            order = ordered(keys)
            first = firsts(keys[order])
            sums = np.add.reduceat(c.view(np.int64)[order], first)
            often = sums >= LEAST
            at = order[first[often]]
            columns = [contexts[at].view(np.int64), suffixes[at].view(np.int64), sums[often]]
            yield pa.RecordBatch.from_arrays([pa.array(column) for column in columns], ["ctx", "suffix", "c"])

    counted = texts.select("text").mapInArrow(run, PACKED)
    return by_bucket(counted).mapInArrow(summed, "ctx long, suffix long, c long")


def with_keys(found: DataFrame, length: int) -> DataFrame:
    """Add the digests ``key`` of sequences to (ctx, suffix, ...)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            contexts, suffixes = (batch.column(name).to_numpy().view(np.uint64) for name in ("ctx", "suffix"))
            key = sequence_digests(contexts, suffixes, length).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(key), *batch.columns], ["key", *batch.schema.names])

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in found.schema.fields)
    return found.mapInArrow(run, f"key long, {kinds}")


def with_shorter(found: DataFrame, by: str, shorter: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``found`` with the columns of ``shorter`` that ``by`` names: rows of its frequent keys, which are broadcast, and all others."""
    table = shorter.withColumnRenamed("key", by)
    hot, cold = (table.where(c).drop("frequent") for c in ("frequent", "not frequent"))
    return found.join(F.broadcast(hot), by), found.join(F.broadcast(hot.select(by)), by, "left_anti").join(cold, by)


def with_expected(found: DataFrame, shorter: DataFrame) -> DataFrame:
    """Add to (ctx, suffix, c) the probability ``expected`` of the sequence without its first word."""
    after = shorter.select("key", F.col("p").alias("expected"), "frequent")
    return DataFrame.unionByName(*with_shorter(found, "suffix", after))


def grown(found: DataFrame, shorter: DataFrame) -> DataFrame:
    """What the tree says about sequences: the probability ``p``, whether it is the state's ``own``, and the state's ``rest``.

    found: (ctx, suffix, c, expected). shorter: (key, c, p, frequent) of all sequences one shorter. Sequences of a frequent
    context meet by partial sums and a broadcast, the others by shuffle.
    """
    n, c, expected = F.col("n"), F.col("c"), F.col("expected")
    smooth = (c + PRIOR * expected) / (n + PRIOR)

    def settled(rows: DataFrame, few: bool) -> DataFrame:
        rows = rows.withColumn("gain", c * F.log(c / (n * expected)) - c + n * expected)
        strong = rows.where(F.col("gain") >= SYMBOL_DIVERGENCE).groupBy("ctx")
        sums = strong.agg(F.sum("gain").alias("gains"), (1 - F.sum(smooth)).alias("left"), (1 - F.sum(expected)).alias("below"))
        states = sums.where((F.col("gains") >= DIVERGENCE) & (F.col("left") > 1e-9) & (F.col("below") > 1e-9))
        states = states.select("ctx", (F.col("left") / F.col("below")).alias("rest"))
        return rows.join(F.broadcast(states) if few else states, "ctx", "left")

    context = shorter.select("key", F.col("c").alias("n"), "frequent")
    few, many = with_shorter(found, "ctx", context)
    both = settled(few, True).unionByName(settled(many, False))
    own = F.col("rest").isNotNull() & (F.col("gain") >= SYMBOL_DIVERGENCE)
    below = F.coalesce("rest", F.lit(1.0)) * expected
    return both.select(
        "ctx", "suffix", "c", "n", own.alias("own"), "rest", F.when(own, smooth).otherwise(below).alias("p"),
        F.when(own, F.log10(smooth / below)).otherwise(0.0).alias("score"),
    )


def train(texts: DataFrame) -> tuple[Tree, DataFrame] | None:
    """Tree over the column ``text``, and the table (word, c, key) of all words; None without rows. ``texts`` is read ``DEPTH`` + 1 times."""
    spark = texts.sparkSession
    counts = cut(count_words(texts), "words")
    facts = counts.agg(
        F.sum("c").alias("total"), F.count("*").alias("distinct"), F.count(F.when(F.col("c") == 1, 1)).alias("once"),
        F.count(F.when(F.col("c") == 2, 1)).alias("twice"),
    ).first()
    if not facts["distinct"]:
        return None
    shown = counts.where((F.col("c") * VOCABULARY >= facts["total"]) & (F.octet_length("word") <= LONGEST)).collect()
    tree = Tree({bytes(r["word"]): r["c"] for r in shown}, facts["total"], facts["distinct"], facts["once"], facts["twice"])
    base, zero = F.log10(F.col("c") + 1), F.lit(0.0)
    frequent_word, frequent = F.col("c") * VOCABULARY >= tree.total, F.col("c") * SEQUENCES >= tree.total
    shorter = counts.select("key", "c", ((F.col("c") - tree.discount) / tree.total).alias("p"), frequent_word.alias("frequent"))
    gains = [shorter.select("key", "frequent", base.alias("base"), (F.log10("p") - math.log10(tree.root(0))).alias("score"))]
    kept, levels = new_folder(spark, "gains"), []
    with scratch(spark), shuffles_dropped(spark):
        for length in range(2, DEPTH + 2):
            shorter = shorter.where(F.col("c") >= LEAST)
            folder = new_folder(spark, "level")
            with scratch(spark):
                expected = new_folder(spark, "expected")
                with scratch(spark):
                    counted = cut(sequence_counts(texts, Filter(shorter, shorter.count()), length, tree.total), "sequences")
                    drop_shuffles(spark)
                    found = with_expected(counted, shorter)
                    found.write.parquet(expected)
                drop_shuffles(spark)
                level = grown(spark.read.schema(found.schema).parquet(expected), shorter)
                # Frequent sequences stay although they say nothing: tasks know them all, and never send one away.
                level = with_keys(level if length <= DEPTH else level.where(F.col("own") | frequent), length)
                names = ("ctx", "suffix", "n", "rest")
                said = level.withColumns({name: F.when(F.col("own") | frequent, F.col(name)) for name in names})
                said.write.parquet(folder)
            drop_shuffles(spark)
            level = spark.read.schema(said.schema).parquet(folder)
            levels.append(level)
            gains.append(level.where(F.col("own") | frequent).select("key", frequent.alias("frequent"), zero.alias("base"), "score"))
            states = level.where("own").groupBy(F.col("ctx").alias("key")).agg(F.max("n").alias("c"), F.log10(F.max("rest")).alias("score"))
            gains.append(states.select("key", (frequent_word if length == 2 else frequent).alias("frequent"), zero.alias("base"), "score"))
            shorter = level.select("key", "c", "p", frequent.alias("frequent"))
        reduce(DataFrame.unionByName, gains).write.parquet(kept)
        tree.show(levels)
    drop_shuffles(spark)
    tree.gains = spark.read.schema("key long, frequent boolean, base double, score double").parquet(kept)
    tree.hold()
    return tree, counts


def score(docs: DataFrame, tree: Tree, counts: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, n_tokens, n_known, train_tokens, base_score (add-one words), score (the tree).

    counts: the words that ``tree.gains`` stands for. ``docs`` is read, and its scores are written, ``SLICES`` times a part of it.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast((tree.frequent, tree.filter))
    with shuffles_dropped(spark):
        packed = cut(tree.packed(), "packed_gains")
    parts, slice_of = [], F.pmod(F.xxhash64(id_col), F.lit(SLICES))
    for k in range(SLICES):
        with shuffles_dropped(spark):
            parts.append(cut(score_slice(docs.where(slice_of == k), tree, packed, shared, id_col, text_col), "scores"))
        drop_shuffles(spark)
    return reduce(DataFrame.unionByName, parts)


def score_slice(docs: DataFrame, tree: Tree, packed: DataFrame, shared: Broadcast, id_col: str, text_col: str) -> DataFrame:
    """``score`` in one go. packed: the other rows by bucket. shared: the frequent rows and the filter. Rows are numbered by their place in ``docs``, which must not change while it runs."""
    names, bits = ["id", "n_tokens", "n_known", "base", "score"], tree.bits
    id_kind = docs.schema[id_col].dataType.simpleString()
    numbers = id_kind in ("bigint", "int", "smallint", "tinyint")
    id_type, wide = (pa.int64(), "bigint") if numbers else (pa.string(), "string")
    kinds = [id_type, pa.int64(), pa.int64(), pa.float64(), pa.float64()]

    def of_bucket(buckets: list[int], rows: list[bytes]) -> pa.RecordBatch:
        n = len(buckets)
        columns = [pa.array(buckets, pa.int32()), pa.array(np.full(n, LOOKUPS, np.int32)), pa.array(rows, pa.binary()), pa.nulls(n, pa.int64())]
        return pa.RecordBatch.from_arrays([*columns, pa.nulls(n, pa.struct(list(zip(names, kinds))))], ["bucket", "kind", "rows", "row", "doc"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row for each document with what is frequent in it, and packed rows of its other words and sequences that may say something."""
        (often, keys, base, gain), wanted = shared.value
        waiting: list[tuple[np.ndarray, np.ndarray]] = []

        def sent() -> pa.RecordBatch:
            rows, found = (np.concatenate(part) for part in zip(*waiting))
            waiting.clear()
            return of_bucket(*dealt(found, roughly(found), [found, rows], bits))

        task, number = TaskContext.get().partitionId() << 40, 0
        for batch in batches:
            first = 0
            for texts in chunks(batch.column(1)):
                words, numbers, lengths = numbered_words(texts)
                rows, before = task + number + np.arange(len(texts)), words_before(lengths)
                number += len(texts)
                starts, row_of = np.cumsum(lengths) - lengths, np.repeat(rows, lengths)
                found = digests(words)
                sums, others = np.zeros((3, len(texts))), []
                for length in range(1, DEPTH + 2):
                    if length > 1:
                        found = longer_digests(found, length)
                    # Most aren't frequent, and a bit tells so sooner than a search.
                    at = np.flatnonzero(often.passes(found))
                    place = np.searchsorted(keys, found[at])
                    hit = keys[np.minimum(place, len(keys) - 1)] == found[at] if len(at) else np.zeros(0, bool)
                    at, place = at[hit], place[hit]
                    away = wanted.passes(found)
                    away[at] = False
                    said = [np.zeros(len(found)) for _ in range(2 if length == 1 else 1)]
                    for values, all_values in zip(said, (gain, base)):
                        values[at] = all_values[place]
                    if length == 1:  # looked up once for each distinct word; only words have a base
                        said.append((said[1] > 0).astype(float))
                        found, away, said = found[numbers], away[numbers], [values[numbers] for values in said]
                    ok = before >= length - 1
                    for total, values in zip(sums[::-1], said):
                        total += np.add.reduceat(np.where(ok, values, 0.0), starts)
                    away &= ok
                    others.append((row_of[away], found[away]))
                # A document's own key only spreads these rows.
                own = sequence_digests(rows.view(np.uint64), rows.view(np.uint64), 0) >> np.uint64(64 - bits)
                ids = batch.column(0).slice(first, len(texts))
                first += len(texts)
                columns = [lengths, sums[0].astype(np.int64), sums[1], sums[2]]
                columns = [ids.cast(id_type), *map(pa.array, columns, kinds[1:])]
                n = len(rows)
                columns = [pa.array(own.astype(np.int32)), pa.array(np.full(n, DOCUMENT, np.int32)), pa.nulls(n, pa.binary()), pa.array(rows), pa.StructArray.from_arrays(columns, names)]
                yield pa.RecordBatch.from_arrays(columns, ["bucket", "kind", "rows", "row", "doc"])
                waiting += others
                if sum(len(found) for _, found in waiting) >= HELD_LOOKUPS:
                    yield sent()
        if waiting:
            yield sent()
        pa.default_memory_pool().release_unused()

    def found_sums(found: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
        rows, base, score = (np.concatenate(part) for part in zip(*found))
        found.clear()
        row, place = np.unique(rows, return_inverse=True)
        sums = [np.bincount(place, values, len(row)) for values in (base > 0, base, score)]
        columns = [pa.array(row.view(np.int64)), pa.nulls(len(row), id_type), pa.nulls(len(row), pa.int64())]
        return pa.RecordBatch.from_arrays([*columns, pa.array(sums[0].astype(np.int64)), *map(pa.array, sums[1:])], ["row", *names])

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Documents as they are, and sums over what was looked up for them; a bucket of the tree stands before what is looked up in it."""
        of, found, size = None, [], 0
        keys = base = score = np.zeros(0)
        for batch in batches:
            docs = batch.filter(pc.equal(batch.column(1), DOCUMENT))
            yield pa.RecordBatch.from_arrays([docs.column(3), *docs.column(4).flatten()], ["row", *names])
            for bucket, kind, rows in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                if kind == TABLE:
                    of, (keys, base, score) = bucket, unpacked(rows, 3)
                    base, score = base.view(float), score.view(float)
                elif kind == LOOKUPS and bucket == of:
                    wanted, row = unpacked(rows, 2)
                    place = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
                    there = keys[place] == wanted
                    found.append((row[there], base[place[there]], score[place[there]]))
                    size += len(found[-1][0])
                    if size >= HELD_LOOKUPS:
                        yield found_sums(found)
                        size = 0
        if found:
            yield found_sums(found)

    narrow = docs.select(F.col(id_col).cast(wide).alias("id"), F.col(text_col).cast("string").alias("text"))
    doc = f"id: {wide}, n_tokens: long, n_known: long, base: double, score: double"
    said = narrow.mapInArrow(run, f"bucket int, kind int, rows binary, row long, doc struct<{doc}>")
    table = packed.select("bucket", F.lit(TABLE).alias("kind"), "rows")
    met = by_bucket(said.unionByName(table, allowMissingColumns=True), "kind")
    whole = met.mapInArrow(look_up, f"row long, {doc.replace(':', '')}").groupBy("row").agg(
        F.max("id").alias("id"), F.max("n_tokens").alias("n_tokens"), F.sum("n_known").alias("n_known"), F.sum("base").alias("base"), F.sum("score").alias("score")
    )
    return whole.select(
        F.col("id").cast(id_kind).alias(id_col), "n_tokens", "n_known", F.lit(tree.total).cast("long").alias("train_tokens"),
        (F.col("base") - F.col("n_tokens") * math.log10(tree.total + tree.distinct + 1)).alias("base_score"),
        (F.col("score") + F.col("n_tokens") * math.log10(tree.root(0))).alias("score"),
    )
