"""Toxic spans by a linear-chain conditional random field, and a document score from its marginals.

Learning, from a bounded sample: of each class at most ``SAMPLE_DOCS`` labelled documents, those with the smallest hashes
of their ids. Their ids are few enough to be sent to every task, so no text is shuffled. Of documents with the same
smallest shingle hash, as copies and most near copies have, one teaches. Words are counted in the sample, and beginnings
of words that aren't cues themselves; those that lean towards toxic documents by ``MIN_LEAN`` (log odds) and stand in at
least ``MIN_SHARE`` of them are cues, ``MAX_CUES`` at most. A cue in a toxic document labels its token 1, any other is 0.
On the first ``FIT_DOCS`` of each class the weights of a two-state chain are fitted by gradient ascent on its likelihood,
and a logistic curve from a document's marginals to its score.

Scoring. A document is cut into sequences of ``SEQUENCE`` words. Forward-backward gives each word's marginal; sequences
without a cue all look alike, so their sums come from a table by length. Marginals of a document add up to its score, and
words of marginal 0.5 and more are its offending spans (character offsets).

Defined cases: null and empty texts score as a text without cues; documents without an id are scored, but teach nothing;
several labels of one id count as toxic if one of them does; with no labels of either class, or no cues, every score is 0;
other input columns are ignored. Ids, languages, sources and labels are no inputs of a score.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyward.sources.shared import cut

MIN_LEAN = 3.0
MIN_SHARE = 0.01
MIN_DOCS = 5
MAX_CUES = 20_000
BEGINNINGS = (4, 5, 6, 7)
SAMPLE_DOCS = 8000
FIT_DOCS = 1500
SEQUENCE = 64
KINDS = 8
CUT_SCORE = 0.7
KNOWN_WORDS = 300_000
SPAN_SCHEMA = "score double, n_spans int, span_starts array<int>, span_ends array<int>"
_EDGES = b".,;:!?\"'()[]{}<>|*#$%&-_"
_WORD = re.compile(r"[^\x20\x09-\x0D]+")


def beginnings(bare: bytes) -> list[bytes]:
    """Cut between letters, and marked by a *."""
    text = bare.decode("utf-8", "replace")
    return [text[:k].encode() + b"*" for k in BEGINNINGS if len(text) >= k]


class Kinds(dict):
    """Word to its observation: 0 for a plain word, else 1 + the step of its strongest cue's lean."""

    def __init__(self, lean: dict[bytes, float]):
        super().__init__()
        self.lean = lean

    def __missing__(self, word: bytes) -> int:
        bare = word.strip(_EDGES)
        best = max((self.lean.get(cue, 0.0) for cue in (bare, *beginnings(bare))), default=0.0)
        kind = 0 if best <= 0 else min(KINDS, 1 + int(best - MIN_LEAN))
        if len(self) >= KNOWN_WORDS:
            self.clear()
        self[word] = kind
        return kind


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().lower().split()


class Chain:
    """Two states (plain, toxic); weights: emission[kind, state], step[from, to], start[state]."""

    def __init__(self, emission: np.ndarray, step: np.ndarray, start: np.ndarray):
        self.emission, self.step, self.start = emission, step, start

    @classmethod
    def blank(cls) -> Chain:
        return cls(np.zeros((KINDS + 1, 2)), np.zeros((2, 2)), np.zeros(2))

    def marginals(self, kinds: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For rows of kinds, padded behind their lengths: state marginals, summed pair marginals, log normalisers."""
        n, width = kinds.shape
        e, step = self.emission[kinds], self.step
        forward = np.empty((n, width, 2))
        forward[:, 0] = self.start + e[:, 0]
        for t in range(1, width):
            forward[:, t] = np.logaddexp(forward[:, t - 1, :1] + step[0], forward[:, t - 1, 1:] + step[1]) + e[:, t]
        rows = np.arange(n)
        ends = forward[rows, lengths - 1]
        norm = np.logaddexp(ends[:, 0], ends[:, 1])
        backward = np.zeros((n, width, 2))
        pairs = np.zeros((2, 2))
        for t in range(width - 2, -1, -1):
            ahead = e[:, t + 1] + backward[:, t + 1]
            inside = (t + 1 < lengths)[:, None]
            backward[:, t] = np.where(inside, np.logaddexp(step[:, 0] + ahead[:, :1], step[:, 1] + ahead[:, 1:]), 0.0)
            joint = forward[:, t, :, None] + step + ahead[:, None, :] - norm[:, None, None]
            pairs += (np.exp(np.minimum(joint, 0.0)) * inside[:, :, None]).sum(axis=0)
        state = np.exp(forward + backward - norm[:, None, None])
        state *= (np.arange(width) < lengths[:, None])[:, :, None]
        return state, pairs, norm

    def fit(self, kinds: np.ndarray, tags: np.ndarray, lengths: np.ndarray, weight: np.ndarray, rounds: int = 120, decay: float = 1e-3) -> Chain:
        """Adam on the mean log likelihood of the tags; weight: how often each row stands."""
        held = np.arange(kinds.shape[1]) < lengths[:, None]
        seen_e, seen_s, seen_0 = np.zeros_like(self.emission), np.zeros_like(self.step), np.zeros(2)
        w = np.broadcast_to(weight[:, None], kinds.shape)
        np.add.at(seen_e, (kinds[held], tags[held]), w[held])
        both = held[:, 1:]
        np.add.at(seen_s, (tags[:, :-1][both], tags[:, 1:][both]), w[:, 1:][both])
        np.add.at(seen_0, tags[:, 0], weight)
        values = np.concatenate([self.emission.ravel(), self.step.ravel(), self.start])
        m, v = np.zeros_like(values), np.zeros_like(values)
        total = (lengths * weight).sum()
        for t in range(1, rounds + 1):
            self.emission, self.step, self.start = values[: 2 * KINDS + 2].reshape(-1, 2), values[-6:-2].reshape(2, 2), values[-2:]
            expected_e, expected_s, expected_0 = np.zeros_like(seen_e), np.zeros_like(seen_s), np.zeros(2)
            for count in np.unique(weight):
                rows = weight == count
                state, pairs, _ = self.marginals(kinds[rows], lengths[rows])
                np.add.at(expected_e, kinds[rows], state * count)
                expected_s += pairs * count
                expected_0 += state[:, 0].sum(axis=0) * count
            slope = np.concatenate([(seen_e - expected_e).ravel(), (seen_s - expected_s).ravel(), seen_0 - expected_0]) / total * 1000
            slope -= decay * values
            m, v = 0.9 * m + 0.1 * slope, 0.99 * v + 0.01 * slope**2
            values = values + 0.15 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-8)
        self.emission, self.step, self.start = values[: 2 * KINDS + 2].reshape(-1, 2), values[-6:-2].reshape(2, 2), values[-2:]
        return self

    def plain_sums(self) -> np.ndarray:
        """Sum of toxic marginals of a sequence without cues, by its length."""
        lengths = np.arange(1, SEQUENCE + 1)
        state, _, _ = self.marginals(np.zeros((SEQUENCE, SEQUENCE), np.int64), lengths)
        return np.concatenate([[0.0], state[:, :, 1].sum(axis=1)])


def logistic(x: np.ndarray, y: np.ndarray, rounds: int = 50) -> np.ndarray:
    """Weights by Newton's method, with a small ridge."""
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (p * (1 - p))[:, None]).T @ x + 1e-2 * np.eye(len(w))
        move = np.linalg.solve(h, x.T @ (y - p) - 1e-2 * w)
        w += move
        if np.abs(move).max() < 1e-6:
            break
    return w


class Model:
    """Cues with the fitted chain and curve; ``curve`` is None when there was nothing to learn."""

    def __init__(self, lean: dict[bytes, float], chain: Chain | None, curve: np.ndarray | None):
        self.lean, self.chain, self.curve = lean, chain, curve
        self.plain = None  # sums for sequences without cues, made in the task

    def measures(self, kinds: list[np.ndarray]) -> tuple[np.ndarray, list[list[tuple[int, float]]]]:
        """Of each document: summed and largest marginals, and its offending words (index, marginal)."""
        if self.plain is None:
            self.plain = self.chain.plain_sums()
        plain = self.plain
        out, spans = np.zeros((len(kinds), 2)), [[] for _ in kinds]
        where, rows = [], []
        for d, k in enumerate(kinds):
            full, rest = divmod(len(k), SEQUENCE)
            out[d, 0] = full * plain[SEQUENCE] + plain[rest]
            if k.any():
                for s in np.unique(np.flatnonzero(k) // SEQUENCE):
                    part = k[s * SEQUENCE : (s + 1) * SEQUENCE]
                    out[d, 0] -= plain[len(part)]
                    where.append((d, s * SEQUENCE, len(part)))
                    rows.append(np.pad(part, (0, SEQUENCE - len(part))))
        for at in range(0, len(rows), 4096):
            some = where[at : at + 4096]
            state, _, _ = self.chain.marginals(np.array(rows[at : at + 4096]), np.array([n for _, _, n in some]))
            for (d, first, _), p in zip(some, state[:, :, 1]):
                out[d, 0] += p.sum()
                out[d, 1] = max(out[d, 1], p.max())
                spans[d] += [(first + int(t), float(p[t])) for t in np.flatnonzero(p >= 0.5)]
        return out, spans

    def curve_input(self, measures: np.ndarray) -> np.ndarray:
        return np.column_stack([np.ones(len(measures)), np.log1p(measures[:, 0]), measures[:, 1]])


def copy_key(text: str | None) -> int:
    """Smallest hash of the text's five-word shingles."""
    words = words_of(text)
    return min((xxhash.xxh3_64_intdigest(b" ".join(words[k : k + 5])) for k in range(max(1, len(words) - 4))), default=0) >> 1


def copy_keys(texts: pd.Series) -> pd.Series:
    return texts.map(copy_key)


def count_cues(texts: DataFrame, wanted: frozenset[bytes] | None = None, known: frozenset[bytes] | None = None) -> DataFrame:
    """(cue, docs): in how many texts each cue (of the wanted ones) stands, pre-aggregated by batch.

    Cues are words; or, where ``known`` words are given, beginnings of all other words.
    """

    def cues(text: str | None) -> set[bytes]:
        words = {word.strip(_EDGES) for word in words_of(text)} - {b""}
        found = words if known is None else {cue for word in words - known for cue in beginnings(word)}
        return found if wanted is None else found & wanted

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: Counter = Counter()
            for text in batch.column(0):
                seen.update(cues(text.as_py()))
            yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.binary()), pa.array(list(seen.values()), pa.int64())], ["cue", "docs"])

    return texts.select("text").mapInArrow(run, "cue binary, docs long").groupBy("cue").agg(F.sum("docs").alias("docs"))


def leaning(labelled: DataFrame, n_clean: int, n_toxic: int, known: frozenset[bytes] | None = None) -> dict[bytes, float]:
    """Cues with their lean: frequent among toxic texts first (few, by their share), then counted among clean ones."""
    frequent = (
        count_cues(labelled.where("toxic = 1"), None, known)
        .where((F.col("docs") >= max(MIN_DOCS, MIN_SHARE * n_toxic)) & (F.octet_length("cue") <= 64))
        .orderBy(F.desc("docs"), "cue")
        .limit(10 * MAX_CUES)
    )
    toxic = {bytes(r["cue"]): r["docs"] for r in frequent.collect()}
    clean = {bytes(r["cue"]): r["docs"] for r in count_cues(labelled.where("toxic = 0"), frozenset(toxic), known).collect()}
    odds = lambda docs, n: math.log((docs + 1) / (n + 2))
    leans = {cue: odds(docs, n_toxic) - odds(clean.get(cue, 0), n_clean) for cue, docs in toxic.items()}
    return {cue: lean for cue, lean in leans.items() if lean >= MIN_LEAN}


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> Model:
    """Fit on ``docs`` with a label; leave rows out of ``docs`` to hold them out."""
    known = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("toxic")).dropna()
    known = known.groupBy("id").agg((F.max("toxic") > 0).cast("int").alias("toxic"))
    order = F.xxhash64("id")
    drawn = [known.where(F.col("toxic") == t).orderBy(order, "id").limit(SAMPLE_DOCS) for t in (0, 1)]
    # At most 2 * SAMPLE_DOCS ids.
    drawn = F.broadcast(drawn[0].unionByName(drawn[1]))
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    keyed = cut(texts.join(drawn, "id").withColumn("copies", F.pandas_udf(copy_keys, "long")(F.col("text"))), "labelled")
    first = keyed.groupBy("toxic", "copies").agg(F.min("id").alias("id")).select("id")
    labelled = keyed.drop("copies").join(F.broadcast(first), "id", "left_semi")
    totals = {r["toxic"]: r["n"] for r in labelled.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if len(totals) < 2:
        return Model({}, None, None)
    n_clean, n_toxic = totals[0], totals[1]
    leans = leaning(labelled, n_clean, n_toxic)
    leans |= leaning(labelled, n_clean, n_toxic, frozenset(leans))
    best = sorted(leans, key=lambda cue: (-leans[cue], cue))[:MAX_CUES]
    model = Model({cue: leans[cue] for cue in best}, None, None)
    if not model.lean:
        return model
    first = [labelled.where(F.col("toxic") == t).orderBy(order, "id").limit(FIT_DOCS) for t in (0, 1)]
    sample = first[0].unionByName(first[1])
    lean_by_cue = model.lean

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = Kinds(lean_by_cue)
        for batch in batches:
            kinds = [np.fromiter(map(of.__getitem__, w := words_of(t.as_py())), np.uint8, len(w)) for t in batch.column(1)]
            # What leaves the task is bounded: number of words, and the sequences that hold a cue.
            parts = [[k[s * SEQUENCE : (s + 1) * SEQUENCE].tobytes() for s in np.unique(np.flatnonzero(k) // SEQUENCE)] for k in kinds]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array([len(k) for k in kinds], pa.int64()), pa.array(parts, pa.list_(pa.binary()))],
                ["id", "toxic", "n", "parts"],
            )

    kind = docs.schema[id_col].dataType.simpleString()
    rows = sample.select("id", "text", "toxic").mapInArrow(run, f"id {kind}, toxic int, n long, parts array<binary>").orderBy("id", "n").collect()
    sequences, tags, weights = [], [], []
    plain = Counter()
    for row in rows:
        for part in row["parts"]:
            k = np.frombuffer(part, np.uint8)
            sequences.append(k)
            tags.append((k > 0) * row["toxic"])
            weights.append(1)
        plain[SEQUENCE] += max(0, row["n"] // SEQUENCE - len(row["parts"]))
    if plain[SEQUENCE]:
        sequences.append(np.zeros(SEQUENCE, np.uint8))
        tags.append(np.zeros(SEQUENCE, np.int64))
        weights.append(plain[SEQUENCE])
    lengths = np.array([len(k) for k in sequences])
    padded = lambda parts: np.array([np.pad(p, (0, SEQUENCE - len(p))) for p in parts]).astype(np.int64)
    model.chain = Chain.blank().fit(padded(sequences), padded(tags), lengths, np.array(weights, float))
    measures, at = np.zeros((len(rows), 2)), 0
    base = model.chain.plain_sums()
    states = model.chain.marginals(padded(sequences), lengths)[0][:, :, 1]
    for d, row in enumerate(rows):
        n = len(row["parts"])
        own = states[at : at + n]
        full, rest = divmod(row["n"], SEQUENCE)
        plain_part = full * base[SEQUENCE] + base[rest] - sum(base[len(p)] for p in row["parts"])
        measures[d] = plain_part + own.sum(), own.max(initial=0.0)
        at += n
    model.curve = logistic(model.curve_input(measures), np.array([r["toxic"] for r in rows], float))
    return model


def score_column(spark, model: Model, text: Column) -> Column:
    """A struct of ``SPAN_SCHEMA`` for each text."""
    shared = spark.sparkContext.broadcast(model)

    def run(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model = shared.value
        of = Kinds(model.lean)
        for texts in parts:
            if model.curve is None:
                empty = [[] for _ in texts]
                yield pd.DataFrame({"score": [0.0] * len(texts), "n_spans": 0, "span_starts": empty, "span_ends": empty})
                continue
            kinds = [np.fromiter(map(of.__getitem__, w := words_of(t)), np.uint8, len(w)) for t in texts]
            measures, spans = model.measures(kinds)
            x = np.clip(model.curve_input(measures) @ model.curve, -30, 30)
            starts, ends = [], []
            for text, found in zip(texts, spans):
                places = [m.span() for m in _WORD.finditer(text)] if found else []
                starts.append([places[i][0] for i, _ in found])
                ends.append([places[i][1] for i, _ in found])
            yield pd.DataFrame({"score": 1 / (1 + np.exp(-x)), "n_spans": [len(s) for s in spans], "span_starts": starts, "span_ends": ends})

    return F.pandas_udf(run, SPAN_SCHEMA)(text.cast("string"))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, score, predicted (score of ``CUT_SCORE`` and more), and the offending spans."""
    found = docs.select(F.col(id_col), score_column(docs.sparkSession, model, F.col(text_col)).alias("_found"))
    return found.select(
        id_col, "_found.score", (F.col("_found.score") >= CUT_SCORE).cast("int").alias("predicted"),
        "_found.n_spans", "_found.span_starts", "_found.span_ends",
    )


def keep_clean(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """Rows of ``docs`` below ``CUT_SCORE``; columns as they came."""
    name = "_toxicity"
    while name in docs.columns:
        name += "_"
    scored = docs.withColumn(name, score_column(docs.sparkSession, model, F.col(text_col)))
    return scored.where(F.col(name)["score"] < CUT_SCORE).drop(name)
