"""Quality by perplexity under an interpolated modified Kneser-Ney n-gram model of trusted text.

Symbols are the bytes themselves, so an n-gram of order 4 is a 32-bit number. Counts are pre-aggregated in the task and
summed in Spark; continuation counts, discounts, context totals and back-off weights are aggregations and joins of those
tables by context. The probabilities go to the tasks, where they are looked up for every byte of every whole text: n-grams of
small letters, space and marks, most of a text, in a dense table of 2**24 cells (``symbol_table`` gives these bytes a class of
their own), all others in sorted tables of the n-grams that were seen. Beyond ``SHARD_GRAMS`` of these the tables are cut into
shards by context, and a task holds one shard at a time. The model is fitted on all trusted texts. Up to ``BROADCAST_IDS``
of their ids are sent to every task, so that no text is shuffled; beyond, texts are joined with the ids by shuffle.

Decision. For every language, quantiles of the perplexity of all trusted texts (on a fine fixed grid, so that they don't depend
on the partitioning) give a centre and spreads to both sides; a text is rejected when it lies further out than the
outermost quantile by more than ``MARGIN`` spreads. Short texts scatter more, so quantiles are taken by language and by
the power of four of the text's length.

Defined cases: null and empty texts have no perplexity and are kept; an unknown language (null, or with fewer than
``MIN_TEXTS`` trusted texts of that length) is held against the quantiles of all languages; where those are missing too,
against the nearest shorter length that has some, of its language or else of all (longer texts scatter less, so those
bounds are wide enough), or of all lengths together if no length has; so no text is too long to be judged. Texts shorter
than every length with bounds are kept, and everything with fewer than ``MIN_TEXTS`` trusted texts at all. Repeated labels of one id count as trusted only if all say so; other input columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyward.sources.shared import cut

ORDER = 4
#: Bits of a byte, and of a class in the dense table.
BYTE, BITS = 8, 6
#: Stands in front of a text; no byte of UTF-8.
START = 0xFF
#: N-grams of ORDER that a task holds besides the dense table, of 8 bytes each.
SHARD_GRAMS = 1 << 23
QUANTILES = (0.005, 0.5, 0.995)
MARGIN = 0.5
MIN_TEXTS = 50
BROADCAST_IDS = 1 << 20
GRID = 1000
CHUNK = 1 << 22
#: More than a text can have; ALL stands for all lengths.
BANDS, ALL = 32, -1


def symbol_table() -> np.ndarray:
    """Byte to class of the dense table; class 0 stands only in front of a text. Bytes that share their class are told apart by the sorted tables."""
    classes = np.full(256, 54, np.uint8)
    for c in range(26):
        classes[ord("a") + c] = 1 + c
    classes[ord("A") : ord("Z") + 1] = 27
    classes[ord("0") : ord("9") + 1] = 28
    classes[ord(" ")] = 29
    classes[[9, 10, 11, 12, 13]] = 30
    for k, mark in enumerate(b".,!?-:;()\"'/@#$%&*|_+="):
        classes[mark] = 31 + k
    classes[0x80:0xC0] = 55 + np.arange(64) % 8
    classes[0xC0:START] = 63
    classes[START] = 0
    return classes


def plain_bytes(classes: np.ndarray) -> np.ndarray:
    """Which bytes have a class of their own, START among them."""
    return np.bincount(classes, minlength=1 << BITS)[classes] == 1


def runs(texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(bytes, inside, sizes) for runs of texts: START in front of each text, where the texts' own bytes are, and how many each has."""
    run, size = [], 0
    for k, text in enumerate(texts):
        raw = (text or "").encode()
        run.append(raw)
        size += len(raw)
        if size >= CHUNK or k == len(texts) - 1:
            sizes = np.array([len(r) for r in run])
            pad = bytes([START]) * (ORDER - 1)
            joined = np.frombuffer(pad.join([b"", *run]), np.uint8)
            yield joined, joined != START, sizes
            run, size = [], 0


def coded(symbols: np.ndarray, bits: int) -> np.ndarray:
    """The n-gram that ends at each symbol."""
    codes = symbols.astype(np.uint32)
    for back in range(1, ORDER):
        codes[back:] |= symbols[:-back].astype(np.uint32) << np.uint32(bits * back)
    return codes


def grams(texts: list[str | None], symbols: np.ndarray | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(codes, sizes) for runs of texts: the n-gram that ends at each byte (of ``symbols`` of bytes, if given), and how many bytes each text has."""
    for raw, inside, sizes in runs(texts):
        yield coded(raw if symbols is None else symbols[raw], BYTE)[inside], sizes


def found_in(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(value, whether there is one) by sorted keys."""
    if not len(keys):
        return np.zeros(len(wanted), values.dtype), np.zeros(len(wanted), bool)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return values[at], keys[at] == wanted


class Short:
    """Probabilities of bytes behind up to two others, and weights of contexts: dense for pairs, sorted for three bytes."""

    def __init__(self, shares: list[tuple[np.ndarray, np.ndarray]], weights: list[tuple[np.ndarray, np.ndarray]]):
        table = np.full(1 << BYTE, 1.0 / START)
        table[START] = 0
        for k in (0, 1):
            back = np.ones(1 << BYTE * k)
            back[weights[k][0]] = weights[k][1]
            table = (back[:, None] * table[None, -(1 << BYTE) :]).ravel()
            table[shares[k][0]] += shares[k][1]
        self.pairs, self.back = table, np.ones(1 << 2 * BYTE)
        self.back[weights[2][0]] = weights[2][1]
        self.codes = shares[2][0].astype(np.uint32)
        self.values = shares[2][1] + self.shorter(self.codes)

    def shorter(self, codes: np.ndarray) -> np.ndarray:
        return self.back[codes >> BYTE] * self.pairs[codes & ((1 << 2 * BYTE) - 1)]

    def probabilities(self, codes: np.ndarray) -> np.ndarray:
        """Of n-grams of three bytes."""
        value, known = found_in(self.codes, self.values, codes)
        value[~known] = self.shorter(codes[~known])
        return value


class Shard:
    """Log10 probabilities of the n-grams of ORDER that were seen, and weights of their contexts."""

    def __init__(self, short: Short, shares: tuple[np.ndarray, np.ndarray], weights: tuple[np.ndarray, np.ndarray]):
        self.codes, self.contexts = shares[0].astype(np.uint32), weights[0].astype(np.uint32)
        self.weights = weights[1].astype(np.float32)
        back = found_in(self.contexts, weights[1], self.codes >> BYTE)[0]
        self.logs = np.log10(shares[1] + back * short.probabilities(self.codes & ((1 << 3 * BYTE) - 1))).astype(np.float32)

    def costs(self, short: Short, codes: np.ndarray) -> np.ndarray:
        """Log10 probabilities: a seen n-gram's own, else its context's weight times the shorter one's probability."""
        value, known = found_in(self.codes, self.logs, codes)
        left = codes[~known]
        back, has = found_in(self.contexts, self.weights, left >> BYTE)
        value[~known] = np.log10(np.where(has, back, 1.0) * short.probabilities(left & ((1 << 3 * BYTE) - 1)))
        return value


class Model:
    """Log10 probabilities by n-gram. ``shards`` are broadcast where there are several; a task is given them beside the model."""

    def __init__(self, short: Short, seen: list[tuple[np.ndarray, np.ndarray]], back: list[tuple[np.ndarray, np.ndarray]], shards: list):
        self.short, self.seen, self.back, self.shards, self.dense = short, seen, back, shards, None

    def __getstate__(self) -> dict:
        return self.__dict__ | {"dense": None, "shards": self.shards if len(self.shards) == 1 else []}

    def log_probabilities(self) -> np.ndarray:
        """Dense, by the classes of ``symbol_table``: the last one in total; a class of several bytes among the earlier ones, and what is before it, tells nothing."""
        if self.dense is None:
            sizes = np.bincount(symbol_table()[:START], minlength=1 << BITS)
            table = sizes / START
            for k, ((codes, share), (contexts, weight)) in enumerate(zip(self.seen, self.back)):
                back = np.ones(1 << BITS * k)
                back[contexts] = weight
                # Without a continuation of its own, an n-gram has its context's weight times the shorter one's value.
                table = (back.reshape(-1, max(1, len(table) >> BITS), 1) * table.reshape(1, -1, 1 << BITS)).ravel()
                np.add.at(table, codes, share)
            with np.errstate(divide="ignore"):
                self.dense = np.log10(table).astype(np.float32)
        return self.dense

    def rare(self, codes: np.ndarray, shards: list) -> np.ndarray:
        if len(shards) == 1:
            return shards[0].costs(self.short, codes)
        out = np.empty(len(codes), np.float32)
        of = (codes >> BYTE) % np.uint32(len(shards))
        for k, shared in enumerate(shards):
            mine = of == k
            if mine.any():
                out[mine] = shared.value.costs(self.short, codes[mine])
                shared.__dict__.pop("_value", None)  # read again when it is needed
        return out

    def costs(self, texts: list[str | None], classes: np.ndarray, shards: list | None = None) -> tuple[np.ndarray, np.ndarray]:
        """-log10 probability a byte, and bytes, of each text; nan without bytes."""
        table, out, lengths = self.log_probabilities(), [], []
        plain = plain_bytes(classes)
        for raw, inside, sizes in runs(texts):
            logs = table[coded(classes[raw], BITS)[inside]]
            odd = ~plain[raw]
            for back in range(1, ORDER):
                odd[back:] |= ~plain[raw[:-back]]
            odd &= inside
            logs[odd[inside]] = self.rare(coded(raw, BYTE)[odd], shards or self.shards)
            sums = np.zeros(len(sizes))
            full = sizes > 0
            if full.any():
                starts = (np.cumsum(sizes) - sizes)[full]
                sums[full] = np.add.reduceat(logs, starts, dtype=np.float64)
            with np.errstate(invalid="ignore", divide="ignore"):
                out.append(np.where(full, -sums / sizes, np.nan))
            lengths.append(sizes)
        return (np.concatenate(out), np.concatenate(lengths)) if out else (np.empty(0), np.empty(0, np.int64))


def count(texts: DataFrame) -> DataFrame:
    """(code, n) of all n-grams of the column ``text``, summed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for codes, _ in grams([t.as_py() for t in batch.column(0)]):
                found, n = np.unique(codes, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(found.astype(np.int64)), pa.array(n.astype(np.int64))], ["code", "n"])

    return texts.select("text").mapInArrow(run, "code long, n long").groupBy("code").agg(F.sum("n").alias("n"))


def discounts(counted: DataFrame) -> list[float]:
    """D1, D2, D3+ from how many n-grams were counted once to four times."""
    row = counted.agg(*[F.count(F.when(F.col("n") == k, 1)).alias(f"n{k}") for k in (1, 2, 3, 4)]).first()
    n1, n2, n3, n4 = (max(1, row[f"n{k}"]) for k in (1, 2, 3, 4))
    y = n1 / (n1 + 2 * n2)
    return [min(max(k - (k + 1) * y * b / a, 0.1), k - 0.05) for k, a, b in ((1, n1, n2), (2, n2, n3), (3, n3, n4))]


def _arrays(table: DataFrame, key: str, value: str) -> tuple[np.ndarray, np.ndarray]:
    """Key and value, in order of the key."""
    found = table.select(key, value).toArrow()
    keys, values = found[key].to_numpy(), found[value].to_numpy()
    order = np.argsort(keys)
    return keys[order], values[order]


def _folded(codes: np.ndarray, values: np.ndarray, length: int, fold_last: bool) -> tuple[np.ndarray, np.ndarray]:
    """The n-grams of plain bytes, by classes; the last byte may be any with ``fold_last``."""
    classes = symbol_table()
    plain = plain_bytes(classes)
    kept, out = np.ones(len(codes), bool), np.zeros(len(codes), np.int64)
    for back in range(length):
        byte = (codes >> (BYTE * back)) & 0xFF
        out |= classes[byte].astype(np.int64) << (BITS * back)
        if back or not fold_last:
            kept &= plain[byte]
    return out[kept], values[kept]


def train(texts: DataFrame) -> Model | None:
    """Model of the column ``text``; None without any symbol."""
    top = cut(count(texts), "counts")
    if top.isEmpty():
        return None
    counted = [top]
    for k in range(ORDER - 1, 0, -1):  # continuation counts: in how many longer n-grams
        counted.append(counted[-1].groupBy(F.col("code").bitwiseAND((1 << BYTE * k) - 1).alias("code")).agg(F.count("*").alias("n")))
    seen, back, shares, weights, shards = [], [], [], [], []
    parts = -(-top.count() // SHARD_GRAMS)
    for k, table in enumerate(reversed(counted)):
        d = discounts(table)
        less = F.when(F.col("n") == 1, d[0]).when(F.col("n") == 2, d[1]).otherwise(d[2])
        keyed = table.withColumn("context", F.shiftright("code", BYTE))
        totals = keyed.groupBy("context").agg(F.sum("n").alias("total"), F.sum(less).alias("given"))
        share = keyed.join(totals, "context").select("context", "code", ((F.col("n") - less) / F.col("total")).alias("share"))
        weight = totals.select("context", (F.col("given") / F.col("total")).alias("weight"))
        if k < ORDER - 1:
            shares.append(_arrays(share, "code", "share"))
            weights.append(_arrays(weight, "context", "weight"))
            seen.append(_folded(*shares[-1], k + 1, True))
            back.append(_folded(*weights[-1], k, False))
            continue
        short, folded = Short(shares, weights), []
        if parts > 1:
            share, weight = cut(share, "shares"), cut(weight, "weights")
        for part in range(parts):
            mine = F.col("context") % parts == part
            own, backs = _arrays(share.where(mine), "code", "share"), _arrays(weight.where(mine), "context", "weight")
            folded.append((_folded(*own, ORDER, True), _folded(*backs, ORDER - 1, False)))
            shard = Shard(short, own, backs)
            shards.append(shard if parts == 1 else texts.sparkSession.sparkContext.broadcast(shard))
        for k, into in enumerate((seen, back)):
            into.append(tuple(np.concatenate(arrays) for arrays in zip(*(pair[k] for pair in folded))))
    return Model(short, seen, back, shards)


def cost_column(spark, model: Model, text: Column) -> Column:
    """Struct of cost (-log10 probability a byte, null without bytes) and n_bytes."""
    shared, classes = spark.sparkContext.broadcast(model), symbol_table()
    shards = model.shards if len(model.shards) > 1 else None

    def run(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in parts:
            cost, lengths = shared.value.costs(list(texts), classes, shards)
            yield pd.DataFrame({"cost": np.round(cost, 6), "n_bytes": lengths.astype(np.int64)})

    return F.pandas_udf(run, "cost double, n_bytes long")(text.cast("string"))


def strata(lang: Column, n_bytes: Column) -> list[Column]:
    band = F.floor(F.log(F.greatest(n_bytes, F.lit(1)).cast("double")) / np.log(4.0)).cast("int")
    return [F.coalesce(lang.cast("string"), F.lit("")).alias("lang"), band.alias("band")]


def quantiles(costs: DataFrame) -> DataFrame:
    """Quantiles of (lang, band, cost), and over all languages as lang ``*``, of all lengths too as band ALL; taken on a grid of 1/GRID."""
    step = F.round(F.col("cost") * GRID).cast("long")
    cells = costs.where("cost is not null and not isnan(cost)").groupBy("lang", "band", step.alias("cell")).agg(F.count("*").alias("n"))
    every = cells.groupBy(F.lit("*").alias("lang"), "band", "cell").agg(F.sum("n").alias("n"))
    cells = cells.unionByName(every).unionByName(every.groupBy("lang", F.lit(ALL).alias("band"), "cell").agg(F.sum("n").alias("n")))
    # A stratum has as many cells as the grid, however many texts there are.
    order = "partition by lang, band order by cell rows between unbounded preceding and current row"
    ranked = cells.selectExpr("*", f"sum(n) over ({order}) as upto", "sum(n) over (partition by lang, band) as texts")
    at = [F.min(F.when(F.col("upto") >= F.ceil(F.col("texts") * q), F.col("cell")) / GRID).alias(f"q{k}") for k, q in enumerate(QUANTILES)]
    return ranked.where(F.col("texts") >= MIN_TEXTS).groupBy("lang", "band").agg(*at)


def borrowed(limits: DataFrame) -> DataFrame:
    """(lang, band, own, low, high) from (lang, band, low, high) of some bands: a band's own, or those of the nearest shorter one."""
    by_band = limits.where(F.col("band") != ALL)
    if by_band.isEmpty():
        by_band = limits
    to = limits.sparkSession.range(BANDS).select(F.col("id").cast("int").alias("to"))
    pairs = by_band.crossJoin(F.broadcast(to)).where(F.col("band") <= F.col("to"))
    found = F.max_by(F.struct((F.col("band") == F.col("to")).alias("own"), "low", "high"), "band")
    return pairs.groupBy("lang", F.col("to").alias("band")).agg(found.alias("b")).select("lang", "band", "b.own", "b.low", "b.high")


def trusted_ids(labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality") -> DataFrame:
    """Ids whose labels all say 1, as ``_id``."""
    good = labels.select(F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("_label")).dropna()
    return good.groupBy("_id").agg(F.min("_label").alias("_label")).where("_label = 1").select("_id")


class Judge:
    """A model fitted on the trusted ones of ``docs``, with the bounds of each stratum, and the cost of every document."""

    def __init__(self, docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang"):
        self.text_col, self.lang_col, self.id_col = text_col, lang_col, id_col
        self.spark = docs.sparkSession
        good = cut(trusted_ids(labels, id_col), "trusted")
        few = good.count() <= BROADCAST_IDS
        texts = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang"))
        self.model = train(texts.join(F.broadcast(good) if few else good, "_id", "left_semi"))
        if self.model is None:
            size = F.octet_length(F.coalesce("text", F.lit(""))).cast("long")
            found = texts.select("_id", "lang", F.struct(F.lit(None).cast("double").alias("cost"), size.alias("n_bytes")).alias("c"))
        else:
            found = texts.select("_id", "lang", cost_column(self.spark, self.model, F.col("text")).alias("c"))
        self.costs = cut(found.select("_id", *strata(F.col("lang"), F.col("c.n_bytes")), "c"), "costs")
        trusted = self.costs.join(good, "_id", "left_semi").select("lang", "band", "c.cost")
        spread = lambda a, b: MARGIN * (F.col(b) - F.col(a))
        limits = quantiles(trusted).select("lang", "band", (F.col("q0") - spread("q0", "q1")).alias("low"), (F.col("q2") + spread("q1", "q2")).alias("high"))
        self.bounds = cut(borrowed(cut(limits, "limits")), "bounds")

    def verdicts(self, rows: DataFrame, into: str) -> DataFrame:
        """Rows with lang, band and the struct c get ``into``: cost, n_bytes, low, high (null where nothing bounds it), kept."""
        own = self.bounds.where("lang <> '*'").select("lang", "band", F.struct("own", "low", "high").alias("of_lang"))
        any_lang = self.bounds.where("lang = '*'").select("band", F.struct("own", "low", "high").alias("of_any"))
        rows = rows.join(own, ["lang", "band"], "left").join(any_lang, "band", "left")
        bounds = F.coalesce(*[F.when(F.col(c)["own"], F.col(c)) for c in ("of_lang", "of_any")], "of_lang", "of_any")
        low, high = bounds["low"], bounds["high"]
        cost = F.when(~F.isnan("c.cost"), F.col("c.cost"))
        verdict = F.struct(
            cost.alias("cost"), F.col("c.n_bytes").alias("n_bytes"), low.alias("low"), high.alias("high"),
            F.coalesce(cost.between(low, high), F.lit(True)).alias("kept"),
        )
        return rows.withColumn(into, verdict)

    def report(self) -> DataFrame:
        """One row per document the judge was made of: id, perplexity (of a byte), n_bytes, low and high bounds of it, kept."""
        return _report(self.verdicts(self.costs.withColumnRenamed("_id", self.id_col), "_found"), self.id_col)

    def judged(self, docs: DataFrame, into: str) -> DataFrame:
        """``docs``, which may be others than those the judge was made of, with a verdict."""
        if self.model is None:
            return docs.withColumn(into, F.struct(F.lit(True).alias("kept")))
        names = list(docs.columns)
        rows = docs.select(F.struct(*[docs[f"`{n}`"] for n in names]).alias("row"), cost_column(self.spark, self.model, docs[f"`{self.text_col}`"]).alias("c"))
        rows = self.verdicts(rows.select("row", "c", *strata(F.col(f"row.`{self.lang_col}`"), F.col("c.n_bytes"))), into)
        return rows.select(*[F.col(f"row.`{n}`").alias(n) for n in names], into)


def _report(found: DataFrame, id_col: str) -> DataFrame:
    power = lambda c: F.pow(F.lit(10.0), F.col(f"_found.{c}"))
    return found.select(
        id_col, power("cost").alias("perplexity"), "_found.n_bytes", power("low").alias("low"), power("high").alias("high"), "_found.kept"
    )


def keep_good(docs: DataFrame, judge: Judge) -> DataFrame:
    """Rows of ``docs`` that are kept; columns as they came."""
    name = "_quality"
    while name in docs.columns:
        name += "_"
    return judge.judged(docs, name).where(F.col(name)["kept"]).drop(name)
