"""Importance resampling towards the benchmark's distribution, with the features of equal lines counted once.

Features are runs of one or two words, hashed to ``BUCKETS`` buckets. A bucket's gain is the log ratio of its share among the
target's features and among the documents'; a document's weight is the mean gain of its features, and Gumbel noise from
the hash of its id turns the weights into a draw without replacement.

*Segment deduplication.* Newlines separate words, so a text's features are those within its lines, and one pair of words for
each border between lines with words. Lines are grouped over all documents first: a distinct line is read once, its
features are counted once and multiplied by its occurrences, and its gain is summed once and joined to the documents that
hold it. Pairs across borders are counted along the documents and added to both.

Lines are told apart by their text while they're grouped and by a 128-bit hash from there on. Lines that make more than a
thousandth of all (so fewer than a thousand) are joined by broadcast, all others by shuffle. Bucket counts are added up within a task
first. Equal rows (id and text) are one row with a number of copies until the draw.

The draw needs no global sort: scores are whole numbers in a range that grows with the logarithm of the counts only, so they
are tallied, and rows of one score (noise leaves none with more than a few of ten thousand rows) are numbered by id.

Defined cases: a null text holds no words; a null id is hashed as an empty string and comes last among equal scores; equal
rows get ranks of their own; without documents of ``WORDS`` words nothing is drawn; an empty target or table gives counts of 0.
Other columns are ignored, so clashing names don't matter.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyward.sources.shared import cut

#: Below 2**16, as buckets travel in 16 bits.
BUCKETS = 10_000
WORDS = 20
PERCENT = 25
SEED = 7
#: Words whose hash state is remembered by a task.
REMEMBERED = 200_000
#: Digits, small letters and bytes beyond ASCII make words; capitals become small; all else separates.
SPACED = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c > 127 else 32 for c in range(256))


def words_of(text: bytes) -> list[bytes]:
    return text.translate(SPACED).split()


class Features:
    """Buckets of a line's words and pairs of words. The hash of a pair goes on from that of its first word and the space."""

    def __init__(self, buckets: int):
        self.buckets = buckets
        self.known: dict[bytes, tuple[int, int]] = {}

    def word(self, word: bytes) -> tuple[int, int]:
        """The bucket of a word, and the hash state behind it and a space."""
        found = self.known.get(word)
        if found is None:
            if len(self.known) >= REMEMBERED:
                self.known.clear()
            state = crc32(word)
            found = self.known[word] = state % self.buckets, crc32(b" ", state)
        return found

    def of(self, words: list[bytes]) -> list[int]:
        seen = list(map(self.word, words))
        buckets = self.buckets
        return [b for b, _ in seen] + [crc32(word, state) % buckets for (_, state), word in zip(seen, words[1:])]

    def border(self, last: bytes, first: bytes) -> int:
        return crc32(first, self.word(last)[1]) % self.buckets


def line_key(line: bytes) -> tuple[int, int]:
    value = xxhash.xxh3_128_intdigest(line)
    return (value >> 64) - (1 << 63), (value & (1 << 64) - 1) - (1 << 63)


def batch_of(rows: list[tuple], names: list[str], kinds: list[pa.DataType]) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [[]] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names)


def raw(column: pa.Array) -> list[bytes]:
    return [x.as_buffer().to_pybytes() if x.is_valid else b"" for x in column]


def distinct_lines(texts: DataFrame, buckets: int) -> DataFrame:
    """(hi, lo, times, n_words, buckets): every distinct line of ``texts`` (column text) with its occurrences and its features' buckets."""
    lines = texts.select(F.explode(F.split("text", "\n")).alias("line")).groupBy("line").agg(F.count("*").alias("times"))
    names = ["hi", "lo", "times", "n_words", "buckets"]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features(buckets)
        for batch in batches:
            rows = []
            for line, times in zip(raw(batch.column(0)), batch.column(1).to_pylist()):
                words = words_of(line)
                rows.append((*line_key(line), times, len(words), np.array(features.of(words), np.uint16).tobytes()))
            yield batch_of(rows, names, kinds)

    return lines.mapInArrow(run, "hi long, lo long, times long, n_words long, buckets binary")


def document_lines(docs: DataFrame, buckets: int) -> DataFrame:
    """Per document (id, text) its distinct lines with words: (id, missing, th, head, hi, lo, times, borders).

    ``head`` is 1 on one row of each document, which holds the buckets of the pairs across borders; a document without words has only
    that row, without a line. ``id, missing, th`` tell rows apart by id and text.
    """
    names = ["id", "missing", "th", "head", "hi", "lo", "times", "borders"]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features(buckets)
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), raw(batch.column(1))):
                key = (doc_id or 0, int(doc_id is None), xxhash.xxh3_64_intdigest(text) - (1 << 63))
                held: Counter[bytes] = Counter()
                borders, last = [], None
                for line in text.split(b"\n"):
                    spaced = line.translate(SPACED).strip()
                    if spaced:
                        held[line] += 1
                        if last is not None:
                            borders.append(features.border(last, spaced.split(None, 1)[0]))
                        last = spaced.rsplit(None, 1)[-1]
                packed = np.array(borders, np.uint16).tobytes()
                for k, (line, times) in enumerate(held.items()):
                    rows.append((*key, int(not k), *line_key(line), times, b"" if k else packed))
                if not held:
                    rows.append((*key, 1, None, None, 0, packed))
            yield batch_of(rows, names, kinds)

    schema = "id long, missing long, th long, head long, hi long, lo long, times long, borders binary"
    return docs.mapInArrow(run, schema)


def tally(packed: DataFrame, buckets: int) -> DataFrame:
    """(bucket, many) of ``packed`` (times, buckets of a line); a task returns one row a bucket at most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            times = batch.column(0).to_numpy()
            lists = batch.column(1).to_pylist()
            found = np.frombuffer(b"".join(lists), np.uint16)
            weights = np.repeat(times, [len(x) // 2 for x in lists])
            once = weights == 1
            total += np.bincount(found[once], minlength=buckets)
            np.add.at(total, found[~once], weights[~once])
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held, pa.int64()), pa.array(total[held], pa.int64())], ["bucket", "many"])

    return packed.mapInArrow(run, "bucket long, many long").groupBy("bucket").agg(F.sum("many").alias("many"))


def target_counts(target: DataFrame, buckets: int) -> DataFrame:
    """(times, buckets) of whole texts, as ``tally`` takes them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features(buckets)
        for batch in batches:
            rows = [(1, np.array(features.of(words_of(text)), np.uint16).tobytes()) for text in raw(batch.column(0))]
            yield batch_of(rows, ["times", "buckets"], [pa.int64(), pa.binary()])

    return target.mapInArrow(run, "times long, buckets binary")


def gains(own: DataFrame, wanted: DataFrame, buckets: int) -> np.ndarray:
    """The gain of every bucket, from (bucket, many) of the documents and of the target."""
    spark = own.sparkSession
    counts = (
        spark.range(buckets)
        .withColumnRenamed("id", "bucket")
        .join(own.withColumnRenamed("many", "s"), "bucket", "left")
        .join(wanted.withColumnRenamed("many", "t"), "bucket", "left")
        .select("bucket", *(F.coalesce(c, F.lit(0)).cast("double").alias(c) for c in "st"))
    )
    totals = counts.agg(F.sum("s").alias("all_s"), F.sum("t").alias("all_t"))
    ratio = (F.col("t") + 1) * (F.col("all_s") + buckets) / ((F.col("s") + 1) * (F.col("all_t") + buckets))
    rows = counts.join(F.broadcast(totals)).select("bucket", F.floor(1000 * F.ln(ratio)).cast("long").alias("gain")).collect()
    out = np.zeros(buckets, np.int64)
    for bucket, gain in rows:  # one row a bucket
        out[bucket] = gain
    return out


def summed(table: DataFrame, column: str, gain: np.ndarray, name: str) -> DataFrame:
    """``table`` with the summed gains of its packed buckets in ``column`` instead of them."""
    kept = table.sparkSession.sparkContext.broadcast(gain)
    others = [c for c in table.columns if c != column]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(len(others)).to_pylist()
            ends = np.cumsum([0] + [len(x) // 2 for x in lists])
            sums = np.concatenate([[0], np.cumsum(kept.value[np.frombuffer(b"".join(lists), np.uint16)])])
            columns = [batch.column(k) for k in range(len(others))]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(sums[ends[1:]] - sums[ends[:-1]], pa.int64())], [*others, name])

    schema = ", ".join(f"{c} {table.schema[c].dataType.simpleString()}" for c in others) + f", {name} long"
    return table.select(*others, column).mapInArrow(run, schema)


def weigh(docs: DataFrame, target: DataFrame, buckets: int) -> DataFrame:
    """Per distinct (id, text) of ``docs``: id (null as given), copies, n_words, n_features, weight."""
    texts = docs.select(F.coalesce("text", F.lit("")).alias("text"))
    lines = cut(distinct_lines(texts, buckets), "lines")
    held = cut(document_lines(docs, buckets), "document_lines")
    within = lines.select("times", "buckets")
    across = held.where("head = 1").select(F.lit(1).cast("long").alias("times"), F.col("borders").alias("buckets"))
    own = tally(within.unionByName(across), buckets)
    gain = gains(own, tally(target_counts(target, buckets), buckets), buckets)
    of_lines = cut(summed(lines, "buckets", gain, "gain"), "line_gains")
    total = of_lines.agg(F.sum("times").alias("n")).first()["n"] or 0
    often = F.col("times") * 1000 > total  # fewer than a thousand lines
    columns = ["hi", "lo", "n_words", "gain"]
    rows = held.select("id", "missing", "th", "hi", "lo", "times")
    frequent = rows.join(F.broadcast(of_lines.where(often).select(columns)), ["hi", "lo"], "left")
    frequent = cut(frequent, "with_frequent_lines")
    rare = frequent.where("gain is null and hi is not null").drop("n_words", "gain").join(of_lines.where(~often).select(columns), ["hi", "lo"])
    found = frequent.where("gain is not null").unionByName(rare)
    parts = found.select("id", "missing", "th", F.lit(0).cast("long").alias("head"), (F.col("times") * F.col("n_words")).alias("n_words"), (F.col("times") * F.col("gain")).alias("gain"))
    heads = summed(held.where("head = 1").select("id", "missing", "th", "head", "borders"), "borders", gain, "gain")
    heads = heads.withColumn("n_words", F.lit(0).cast("long"))
    whole = parts.unionByName(heads).groupBy("id", "missing", "th").agg(F.sum("head").alias("copies"), F.sum("n_words").alias("n_words"), F.sum("gain").alias("gain"))
    one = whole.withColumn("n_words", F.expr("n_words div copies")).withColumn("gain", F.expr("gain div copies"))  # copies are equal, so this is exact
    n_features = F.greatest(2 * F.col("n_words") - 1, F.lit(0))
    return one.withColumn("n_features", n_features).select(
        F.when(F.col("missing") == 0, F.col("id")).alias("id"), "copies", "n_words", "n_features",
        F.when(F.col("n_features") == 0, F.lit(0)).otherwise(F.expr("(gain - pmod(gain, n_features)) div n_features")).cast("long").alias("weight"),
    )


def noise(id_col: str, seed: int) -> Column:
    """Gumbel noise in thousandths, from the hash of the id."""
    digits = F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))), 256), 1, 8)
    u = (F.conv(digits, 16, 10).cast("double") + 0.5) / 4294967296
    return F.floor(-1000 * F.ln(-F.ln(u))).cast("long")


def resample(
    table: DataFrame, target: DataFrame, buckets: int = BUCKETS, words: int = WORDS, percent: int = PERCENT, seed: int = SEED, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per row of ``table``: id, n_features, weight, score, rank (1, 2, ... of those drawn; else null)."""
    docs = table.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    weighed = weigh(docs, target.select(F.col(text_col).cast("string").alias("text")), buckets)
    scored = cut(weighed.withColumn("score", F.col("weight") + noise("id", seed)), "scores")
    fit = F.col("n_words") >= words
    tallied = scored.where(fit).groupBy("score").agg(F.sum("copies").alias("many"))
    drawn = (tallied.agg(F.sum("many").alias("n")).first()["n"] or 0) * percent // 100
    above = F.coalesce(F.sum("many").over(Window.orderBy(F.desc("score")).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    reached = tallied.withColumn("above", above).where(F.col("above") < drawn).select("score", "above")
    # Distinct scores are bounded by the noise's and the gains' range, some ten thousand.
    rows = scored.join(F.broadcast(reached), "score", "left").withColumn("above", F.when(fit, F.col("above")))
    rows = rows.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
    order = Window.partitionBy("score").orderBy(F.col("id").asc_nulls_last(), "n_features")
    numbered = rows.where("above is not null").withColumn("rank", F.col("above") + F.row_number().over(order))
    numbered = numbered.withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank")))
    undrawn = rows.where("above is null").withColumn("rank", F.lit(None).cast("long"))
    return numbered.unionByName(undrawn).select(F.col("id").alias(id_col), "n_features", "weight", "score", "rank")
