"""Orchard search and product codes against brute force."""

import hashlib
import math
import random

import numpy as np
import pytest

from tallyward.llm import vector_codes


@pytest.mark.parametrize(("n", "width", "spread"), [(1, 4, 9), (64, 4, 400), (64, 1, 3), (40, 3, 2), (64, 4, 1), (7, 2, 30)])
def test_search_finds_the_nearest(n, width, spread):
    draw = np.random.default_rng(n + spread)
    entries = draw.integers(-spread, spread, (n, width))
    parts = draw.integers(-2 * spread, 2 * spread + 1, (3000, width))
    parts[: min(n, 20)] = entries[:20]
    apart = ((parts[:, None, :] - entries[None, :, :]) ** 2).sum(axis=2)
    index, least = vector_codes.Orchard(entries).nearest(parts)
    assert (index == apart.argmin(axis=1)).all() and (least == apart.min(axis=1)).all()


class Counted:
    """An array that counts how many of its values are read."""

    def __init__(self, values):
        self.values, self.read = values, 0

    def __getitem__(self, key):
        out = self.values[key]
        self.read += out.size
        return out


def test_search_walks_short_stretches_of_the_lists():
    draw = np.random.default_rng(3)
    entries = draw.integers(-5000, 5000, (64, 4))
    parts = entries[draw.integers(0, 64, 2000)] + draw.integers(-20, 20, (2000, 4))
    search = vector_codes.Orchard(entries)
    search.lists = Counted(search.lists)
    search.nearest(parts)
    assert search.lists.read < 2000 * 64 / 4


def brute(rows, parts=16, entries=64, rounds=2):
    kept = [(i, v, label) for i, v, label in rows if v and None not in v and all(map(math.isfinite, v)) and len(v) % parts == 0]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, np.floor(256 * np.array(r[1])).astype("<i8").tobytes()))
    kept = [r for r in kept if len(r[1]) == len(kept[0][1])]
    whole = np.array([[math.floor(256 * x) for x in v] for _, v, _ in kept]).reshape(len(kept), parts, -1)
    books = whole[:entries].transpose(1, 0, 2).copy()

    def nearest():
        apart = ((whole[:, :, None, :] - books[None]) ** 2).sum(axis=3)
        return apart.argmin(axis=2), apart.min(axis=2)

    for _ in range(rounds):
        codes, _ = nearest()
        for p in range(parts):
            for e in range(books.shape[1]):
                own = whole[codes[:, p] == e, p]
                if len(own):
                    books[p, e] = [int(c) // len(own) for c in own.sum(axis=0)]
    codes, apart = nearest()
    errors = apart.sum(axis=1).tolist()
    by_label = {}
    for (_, _, label), e in zip(kept, errors):
        by_label[label] = by_label.get(label, 0) + e
    sha = hashlib.sha256(",".join(str(x) for x in books.ravel()).encode()).hexdigest()
    return sorted(((i, "".join(f"{c:02x}" for c in row), e, by_label[label], sha) for (i, _, label), row, e in zip(kept, codes.tolist(), errors)), key=str)


SCHEMA = "vec_id long, embedding array<double>, label int, code string, error long, v binary, size int"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, b"y", 2) for r in rows], SCHEMA).repartition(4)


def test_codes(spark):
    draw = np.random.default_rng(8)
    centres = draw.normal(size=(20, 32))
    rows = [(k, (centres[k % 20] + draw.normal(size=32) * 0.3).tolist(), k % 4 if k % 7 else None) for k in range(700)]
    rows += [(1000 + k, rows[9][1], 3) for k in range(300)]  # copies
    rows += [(None, rows[1][1], 1), (5, rows[30][1], 2), (5, rows[31][1], 2), (2000, None, 1), (2001, [], 1), (2002, [None] + [0.0] * 31, 1)]
    rows += [(2003, [math.inf] * 32, 0), (2004, [math.nan] * 32, 0), (2005, [1.0] * 30, 0), (2006, [1.0] * 16, 0), (2007, [0.0] * 32, None)]
    random.Random(1).shuffle(rows)
    got = sorted(map(tuple, vector_codes.report(frame(spark, rows)).collect()), key=str)
    assert got == brute(rows)


def test_few_or_no_rows(spark):
    rows = [(3, [0.5, -0.5] * 8, 1), (1, [0.1] * 16, None), (9, [0.1] * 16, None)]
    assert sorted(map(tuple, vector_codes.report(frame(spark, rows)).collect()), key=str) == brute(rows)
    assert vector_codes.report(frame(spark, rows).limit(0)).collect() == []
    assert vector_codes.report(frame(spark, [(1, None, 1)])).collect() == []
    coded, books = vector_codes.compress(frame(spark, rows))
    assert coded.count() == 3 and books.shape == (16, 3, 1)


def test_too_large_for_exact_errors(spark):
    with pytest.raises(Exception, match="too large for exact errors"):
        vector_codes.report(frame(spark, [(1, [1e9] * 16, 1)])).collect()
