"""Suffix arrays by linear grouping, and the removal of repeated passages, against brute force."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from tallyward.llm import suffix_dedup
from tallyward.llm.lyndon_groups import lyndon_groups, suffix_array


def test_suffix_array():
    draw = random.Random(5)
    texts = [[], [3], [1] * 40, [0, 1] * 20, list(b"mississippi"), list(b"abracadabra" * 9)]
    texts += [[draw.randrange(draw.choice([1, 2, 3, 9])) for _ in range(draw.randrange(30))] for _ in range(3000)]
    for text in texts:
        assert suffix_array(np.array(text, np.int64)).tolist() == sorted(range(len(text)), key=lambda i: text[i:])


def test_groups_are_longest_lyndon_prefixes():
    draw = random.Random(6)
    for _ in range(300):
        text = [draw.randrange(3) for _ in range(draw.randrange(1, 20))]

        def lyndon(i):
            return max((text[i:j] for j in range(i + 1, len(text) + 1) if all(text[i:j] < text[k:j] for k in range(i + 1, j))), key=len)

        prefixes = [lyndon(i) for i in range(len(text))]
        group, smaller = lyndon_groups(np.array(text))
        assert group == [sum(p < q for p in prefixes) for q in prefixes]
        assert smaller == [max((j for j in range(i) if text[j:] < text[i:] and prefixes[j] != prefixes[i]), default=-1) for i in range(len(text))]


def brute(texts, length):
    raw = [(t or "").encode() for t in texts]
    seen = Counter(t[i : i + length] for t in raw for i in range(len(t) - length + 1))
    out = []
    for t in raw:
        gone = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out.append((len(t), sum(gone), spans, hashlib.sha256(bytes(b for b, g in zip(t, gone) if not g)).hexdigest()))
    return out


def planted(seed, length, n=60):
    draw = random.Random(seed)
    word = lambda: "".join(draw.choice("abé ") for _ in range(draw.randrange(1, 9)))
    prose = lambda size: "".join(word() for _ in range(size))
    shared = [prose(length // draw.choice([2, 3, 5])) for _ in range(6)]
    texts = []
    for _ in range(n):
        parts = [draw.choice([prose(draw.randrange(1, 30)), draw.choice(shared), draw.choice(shared)[draw.randrange(20) :]]) for _ in range(draw.randrange(1, 6))]
        texts.append("".join(parts))
    texts += [texts[3], texts[3] + "x", texts[4][:-1], None, "", "a" * 3000, "ab" * 900, "abc" * 500 + shared[0], "short", "z" * (length - 1), "z" * length]
    # One passage of a third of all rows, in ever other surroundings.
    return texts + [prose(12) + shared[1] + prose(12) for _ in range(n // 2)]


@pytest.mark.parametrize(("length", "k", "width", "most"), [(60, 16, 8, 1024), (60, 16, 8, 1), (60, 8, 53, 5), (60, 32, 29, 3), (60, 8, 1, 2), (100, 16, 32, 4)])
def test_repeats_against_all_windows(spark, length, k, width, most):
    texts = planted(length + width, length)
    rows = [(i, t, 7, "x", "y") for i, t in enumerate(texts)]
    table = spark.createDataFrame(rows, "doc_id long, text string, id long, th string, gone string").repartition(5)
    got = {r["doc_id"]: tuple(r)[1:] for r in suffix_dedup.digest(suffix_dedup.remove_repeats(table, length, k, width, most)).collect()}
    assert [got[i] for i in range(len(texts))] == brute(texts, length)


def test_small_blocks_and_chunks(spark, monkeypatch):
    texts = planted(1, 60)
    want = brute(texts, 60)
    for parts in suffix_dedup.chunks([memoryview(b"x" * 1000)], 60):
        assert b"".join(bytes(p) for _, _, p in parts) == b"x" * 1000
    monkeypatch.setattr(suffix_dedup, "CHUNK", 256)
    raw = [memoryview((t or "").encode()) for t in texts]
    for row, text in enumerate(raw):
        covered = [w for parts in suffix_dedup.chunks([text], 60) for _, first, count, times, *_ in suffix_dedup.find_runs(parts, 60, 16) for w in range(first, first + count * times)]
        assert sorted(covered) == list(range(max(0, len(text) - 59)))
    monkeypatch.undo()
    pieces = [(g, bytes(a), bytes(b)) for g, a, b in [(0, b"ab", b"cde"), (0, b"zab", b"cdx"), (1, b"zab", b"cdx"), (1, b"b", b"cdy")]]
    flags = suffix_dedup.repeated_windows(pieces, 5)
    assert [f.tolist() for f in flags] == [[True, False], [False, True, False], [False, False, False], [False]]
    assert len(want) == len(texts)


def test_ids_nulls_and_empty(spark):
    text = "".join(random.Random(2).choice("abcdef ") for _ in range(900))
    rows = [(1, text), (1, text), (None, text + "!"), (None, None), (2, None), (2, "other"), (0, text[:400])]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(map(tuple, suffix_dedup.digest(suffix_dedup.remove_repeats(table)).collect()), key=str)
    want = sorted(((r[0], *b) for r, b in zip(rows, brute([t for _, t in rows], 400))), key=str)
    assert got == want
    assert suffix_dedup.digest(suffix_dedup.remove_repeats(table.limit(0))).collect() == []
