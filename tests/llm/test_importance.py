"""Importance resampling against a plain count of whole texts."""

import hashlib
import math
import random
import re
from collections import Counter
from zlib import crc32

from tallyward.llm import importance

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def features(text):
    words = WORD.findall((text or "").translate(LOWER))
    return words + [f"{a} {b}" for a, b in zip(words, words[1:])], len(words)


def brute(rows, target):
    bucket = lambda f: crc32(f.encode()) % 10_000
    s = Counter(bucket(f) for _, text in rows for f in features(text)[0])
    t = Counter(bucket(f) for text in target for f in features(text)[0])
    all_s, all_t = s.total(), t.total()
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1.0) * (all_s + 10_000.0) / ((s[b] + 1.0) * (all_t + 10_000.0))))
    out, fit = [], []
    for k, (doc_id, text) in enumerate(rows):
        found, n_words = features(text)
        weight = sum(gain(bucket(f)) for f in found) // len(found) if found else 0
        h = int(hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        out.append([doc_id, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None])
        if n_words >= 20:
            fit.append(k)
    fit.sort(key=lambda k: (-out[k][3], out[k][0] is None, out[k][0] or 0, out[k][1]))
    for rank, k in enumerate(fit[: 25 * len(fit) // 100], 1):
        out[k][4] = rank
    return sorted(map(tuple, out), key=str)


def texts():
    draw = random.Random(11)
    word = lambda: "".join(draw.choice("abcÄßé0") for _ in range(draw.randrange(1, 4)))
    line = lambda: " ".join(word() for _ in range(draw.randrange(9)))
    common = [line() for _ in range(12)] + ["", "...", "One common Line, of many words, that stands in a third of ALL rows"]
    made = ["\n".join(draw.choice([line(), draw.choice(common)]) for _ in range(draw.randrange(1, 9))) for _ in range(400)]
    made += [f"{line()}\n{common[-1]}\n\n--\n{line()}" for _ in range(200)]
    made += [None, "", "\n\n", " . \n . ", "a\nb\nc", "x" * 5000, "word " * 4000, "A\x00b\x1fC\r\nd e", "\n".join(["end", "", "of", "-", "it"] * 5)]
    return made


SCHEMA = "doc_id long, text string, id long, head long, rank long, th long"


def test_against_whole_texts(spark):
    rows = [(k, t) for k, t in enumerate(texts())]
    rows += [(7, rows[300][1])] * 3 + [(None, rows[301][1]), (None, rows[302][1]), (8, None), (0, rows[301][1])]
    random.Random(3).shuffle(rows)
    target = [t for t in texts()[5:25]] + [None]
    table = spark.createDataFrame([(*r, 1, 2, 3, 4) for r in rows], SCHEMA).repartition(6)
    wanted = spark.createDataFrame([(k, t, 1) for k, t in enumerate(target)], "item_id long, text string, bucket int")
    got = sorted(map(tuple, importance.resample(table, wanted).collect()), key=str)
    assert got == brute(rows, target)


def test_empty_tables(spark):
    table = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    got = sorted(map(tuple, importance.resample(table, table.limit(0)).collect()), key=str)
    assert got == brute([(1, "a b"), (2, None)], [])
    assert importance.resample(table.limit(0), table).collect() == []


def test_equal_lines_are_read_once(spark):
    lines = importance.distinct_lines(spark.createDataFrame([("a b\nc",), ("a b\na b",), ("c",)], "text string"), 10_000).collect()
    assert sorted((r["times"], r["n_words"], len(r["buckets"])) for r in lines) == [(2, 1, 2), (3, 2, 6)]
