"""Components, near duplicates, the suffix tree, WARC audits and toxicity against brute force."""

import math
import random
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from tallyward.llm import embedding_dedup, minhash_dedup, suffix_tree, toxicity, warc
from tallyward.llm.components import components

DOCS = "doc_id long, text string, lang string, source string, n_chars long, component string, id string"


def joined(links, nodes):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_components(spark):
    draw = random.Random(1)
    links = [(draw.randrange(300), draw.randrange(300)) for _ in range(170)] + [(400 + k, 401 + k) for k in range(50)] + [(900, k) for k in range(800, 900)]
    nodes = {x for link in links if link[0] != link[1] for x in link}
    table = spark.createDataFrame([*links, (1, None), (None, None)], "a long, b long")
    got = {r["node"]: r["component"] for r in components(table).collect()}
    assert got == joined([x for x in links if x[0] != x[1]], nodes)
    assert components(table.limit(0)).collect() == []


def brute_vectors(rows, threshold=0.98):
    good = [(i, np.array(v, float), label) for i, v, label in rows if i is not None and label is not None and v and None not in v and np.isfinite(v).all() and np.any(v)]
    links = [
        (a[0], b[0]) for a in good for b in good
        if a is not b and a[2] == b[2] and len(a[1]) == len(b[1]) and a[1] @ b[1] / (np.linalg.norm(a[1]) * np.linalg.norm(b[1])) >= threshold
    ]
    return Counter(a for a, _ in links), joined(links, {r[0] for r in rows if r[0] is not None})


def test_embeddings(spark):
    draw = np.random.default_rng(2)
    centres = draw.normal(size=(12, 16))
    rows = [(k, (centres[k % 12] + draw.normal(size=16) * draw.choice([0.01, 0.09, 0.13])).tolist(), k % 3) for k in range(300)]
    rows += [(300 + k, rows[5][1], 2) for k in range(20)] + [(400, [x * 1e200 for x in rows[5][1]], 2), (401, None, 1), (402, [0.0] * 16, 1), (403, [], 1)]
    rows += [(404, [float("nan")] * 16, 1), (405, [None] + [1.0] * 15, 1), (406, rows[0][1], None), (407, rows[0][1][:8], 0), (408, [math.inf] * 16, 0)]
    table = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, embedding array<double>, label int, links string, tile int")
    n_links, parts = brute_vectors(rows[:320] + rows[321:])  # products of 1e200 overflow in the plain formula
    for tile in (3072, 17):
        got = {r["vec_id"]: r for r in embedding_dedup.near_duplicates(table, tile=tile).collect()}
        assert len(got) == len(rows) and got[400]["component_id"] == got[300]["component_id"] == parts[300]
        for i, r in got.items():
            if i != 400:
                assert (r["n_links"] - (got[400]["n_links"] and parts[i] == parts[300] and r["n_links"] == n_links[i] + 1), r["component_id"], r["kept"]) == (n_links[i], parts[i], parts[i] == i)
    nulls = spark.createDataFrame([(None, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (1, [0.0, 1.0], 1), (2, [0.0, 1.0], 1)], "vec_id long, embedding array<double>, label int")
    got = embedding_dedup.near_duplicates(nulls).collect()
    assert sorted((r["vec_id"], r["component_id"]) for r in got if r["vec_id"]) == [(1, 1), (1, 1), (2, 1)]
    assert [(r["n_links"], r["component_id"], r["kept"]) for r in got if r["vec_id"] is None] == [(0, None, True)]
    assert embedding_dedup.near_duplicates(nulls.limit(0)).collect() == []


def test_error_bounds():
    draw = np.random.default_rng(4)
    for dim in (2, 64, 1500):
        x = draw.normal(size=(200, dim)) * draw.choice([1e-3, 1.0, 50.0], size=(200, 1))
        x[0, 1:] = 0
        unit = x / np.linalg.norm(x, axis=1)[:, None]
        q, scale, left = embedding_dedup.codes(unit)
        about = (q.astype(float) @ q.T.astype(float)) / scale[:, None] / scale[None, :]
        assert (np.abs(about - unit @ unit.T) <= left[:, None] + left[None, :] + 3 * np.outer(left, left) + 1e-12).all()


def brute_documents(rows):
    sets = {}
    for i, text in rows:
        words = (text or "").encode().lower().split()
        sets[i] = {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set()
    links = [(a, b) for a in sets for b in sets if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    return sets, joined(links, set(sets))


def changed(draw, text, n):
    words = text.split()
    for _ in range(n):
        words[draw.randrange(len(words))] = f"new{draw.randrange(10**6)}"
    return " ".join(words)


def test_near_documents(spark):
    draw = random.Random(8)
    vocabulary = [f"w{k}" for k in range(400)]
    originals = [" ".join(draw.choice(vocabulary) for _ in range(draw.choice([3, 7, 12, 40, 150, 400]))) for _ in range(60)]
    rows = list(enumerate(originals))
    for k in range(200):
        original = draw.choice(originals)
        rows.append((100 + k, changed(draw, original, draw.choice([0, 0, 1, 1, 2, len(original.split()) // 40, len(original.split()) // 20]))))
    rows += [(500, None), (501, ""), (502, " \t\n"), (503, "Abc d"), (504, "aBC\nd"), (505, "abc d e"), (506, "w1 " * 30000), (507, "w1 " * 50)]
    sets, parts = brute_documents(rows)
    docs = spark.createDataFrame([(i, t, "en", "s", 0, "clash", "clash") for i, t in rows], DOCS)
    got = {r["doc_id"]: r for r in minhash_dedup.near_duplicates(docs).collect()}
    assert {i: r["n_shingles"] for i, r in got.items()} == {i: len(s) for i, s in sets.items()}
    assert {i: r["component_id"] for i, r in got.items()} == parts
    assert all(r["kept"] == (r["component_id"] == i) for i, r in got.items())
    kept = minhash_dedup.keep_one(docs)
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.collect()} == set(parts.values())


def test_near_document_edges(spark):
    text = "one two three four five six seven"
    rows = [(None, text), (None, None), (4, text), (4, text), (4, "quite another text of more than five words"), (9, text), (10, "quite another text of more than five words")]
    docs = spark.createDataFrame([(i, t, "en", "s", 0, "", "") for i, t in rows], DOCS)
    got = minhash_dedup.near_duplicates(docs).collect()
    assert len(got) == 7 and all(r["kept"] and r["component_id"] is None for r in got if r["doc_id"] is None)
    # The text whose set has the smaller key speaks for id 4; the other links nothing.
    ids = {r["doc_id"]: r["component_id"] for r in got if r["doc_id"] is not None}
    assert ids[4] == 4 and sorted((ids[9], ids[10])) in ([4, 10], [4, 9])
    assert minhash_dedup.keep_one(docs).where("doc_id is null").count() == 2
    assert minhash_dedup.near_duplicates(docs.limit(0)).collect() == []


def test_near_documents_in_crowded_buckets(spark):
    draw = random.Random(11)
    passage = " ".join(f"shared{k}" for k in range(70))
    own = lambda n: " ".join(f"x{draw.randrange(10**9)}" for _ in range(n))
    rows = [(k, f"{passage} {own(14)}") for k in range(240)]
    rows += [(1000 + k, rows[37 * k + 7][1] + " " + own(1)) for k in range(6)]
    docs = spark.createDataFrame([(i, t, "en", "s", 0, "", "") for i, t in rows], DOCS)
    _, parts = brute_documents(rows)
    # Nearly all buckets hold nearly all documents, and few of them are ever a centre.
    got = {r["doc_id"]: r["component_id"] for r in minhash_dedup.near_duplicates(docs, bins=2, rows=1).collect()}
    assert got == parts and sum(i != c for i, c in got.items()) == 6


def test_few_shingles_and_a_clashing_column(spark):
    """Short sets, whose bands may all differ, are found without them."""
    draw = random.Random(17)
    words = [f"w{k}" for k in range(9)]
    rows = [(k, " ".join(draw.choice(words[: draw.choice([2, 3, 9])]) for _ in range(draw.randrange(3, 14)))) for k in range(500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("_gone", F.lit(1)).withColumn("rep", F.lit("x"))
    _, parts = brute_documents(rows)
    # One band of all bins finds next to nothing.
    got = {r["doc_id"]: r["component_id"] for r in minhash_dedup.near_duplicates(docs, bins=128, rows=128).collect()}
    assert got == parts
    kept = minhash_dedup.keep_one(docs)
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.collect()} == set(parts.values())


def test_prefix_pairs_against_all_pairs(spark):
    draw = random.Random(23)
    common = draw.sample(range(10**6), 60)
    sets = {}
    for k in range(300):
        base = draw.sample(common, draw.choice([0, 5, 40, 60])) + draw.sample(range(10**6, 10**7), draw.choice([1, 9, 14, 30]))
        sets[k] = set(base)
        if k % 3 == 2:
            sets[k] = set(list(sets[k - 1])[: draw.randrange(1, 60)]) | set(draw.sample(range(10**7), draw.randrange(4)))
    rows = spark.createDataFrame([(k, len(v), k % 50 if k < 100 else k) for k, v in sets.items()], "rep long, n_shingles long, part long")
    hashes = spark.createDataFrame([(k, sorted(v)) for k, v in sets.items()], "id long, hashes array<long>")
    pairs = minhash_dedup.prefix_pairs(rows, hashes, 75, 100)
    part = {r["rep"]: r["part"] for r in rows.collect()}
    want = {(a, b) for a in sets for b in sets if a < b and part[a] != part[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])}
    found = {(r["a"], r["b"]) for r in pairs.collect()}
    assert want <= found and len(found) < 4 * len(want) + 50
    assert {tuple(r) for r in minhash_dedup.confirmed(pairs, hashes, 75, 100).collect()} == want


def test_densified_signatures_follow_similarity():
    draw = np.random.default_rng(3)
    probes = minhash_dedup.probe_table(128)
    for n in (6, 40, 2000):
        agree = []
        for _ in range(60):
            both = np.unique(draw.integers(0, 2**63, n, dtype=np.uint64) * np.uint64(2))
            more = np.unique(np.concatenate([both, draw.integers(0, 2**63, n // 3, dtype=np.uint64) * np.uint64(2) + np.uint64(1)]))
            a, b = (minhash_dedup.signature(x, 128, probes) for x in (both, more))
            assert np.isin(a, both).all() and np.isin(b, more).all()
            agree.append((a == b).mean())
        assert abs(np.mean(agree) - 0.75) < 0.06


def test_suffix_tree(spark, monkeypatch):
    draw = random.Random(6)
    words = [f"w{k}" for k in range(30)]
    texts = [" ".join(sum(([w, "then", "always"] if draw.random() < 0.3 else [w] for w in draw.choices(words, k=80)), [])) for _ in range(120)]
    texts += ["", None, "Unseen\tThen ALWAYS unseen", "w1 " * 20000, "rare" + "x" * 100]
    docs = spark.createDataFrame([(k, t, "en", "s", 0, "", "") for k, t in enumerate(texts)] + [(None, "w1 w2", "", "", 0, "", ""), (0, "w1", "", "", 0, "", "")], DOCS)
    training = docs.where("doc_id < 100").select("text")
    for name, value in (("VOCABULARY", 200), ("CONTEXT_WORDS", 64), ("SEQUENCES", 4096), ("CHUNK_CHARS", 700), ("HELD_SEQUENCES", 500), ("COUNTED_WORDS", 20)):
        monkeypatch.setattr(suffix_tree, name, value)
    tree, counts = suffix_tree.train(training)
    expected = Counter(w for t in texts[:100] for w in suffix_tree.words_of(t))
    expected.update(suffix_tree.words_of("w1"))  # id 0 stands twice
    assert {bytes(r["word"]): r["c"] for r in counts.collect()} == expected
    lengths = Counter(map(len, tree.states))
    assert lengths[1] >= 1 and (tree.symbols[b"then"],) in tree.states
    by_symbol = {s: tree.counts[w] for w, s in tree.symbols.items()}
    for context in tree.states:  # each state's probabilities, unknown word included, add up to one
        total = sum(tree.probability(context, s, c) for s, c in by_symbol.items())
        total += sum(tree.probability(context, -1, c) for w, c in expected.items() if w not in tree.symbols) + tree.probability(context, -1, 0)
        assert abs(total - 1) < 1e-9
    n, v = sum(expected.values()), len(expected)
    for r in suffix_tree.score(docs, tree, counts).collect():
        text = "w1 w2" if r["doc_id"] is None else texts[r["doc_id"]]
        options = [suffix_tree.words_of(text)] + ([suffix_tree.words_of("w1")] if r["doc_id"] == 0 else [])
        found = next(w for w in options if len(w) == r["n_tokens"])
        assert (r["n_known"], r["train_tokens"]) == (sum(expected[w] > 0 for w in found), n)
        assert abs(r["base_score"] - sum(math.log10((expected[w] + 1) / (n + v + 1)) for w in found)) < 1e-6
        ids, total = [tree.symbols.get(w, -1) for w in found], 0.0
        for t, word in enumerate(found):
            context = ()
            for back in (1, 2):
                if t - back < 0 or ids[t - back] < 0:
                    break
                context = (ids[t - back], *context)
            total += math.log10(tree.probability(context, ids[t], expected[word]))
        assert abs(r["score"] - total) < 1e-6
    held_out = suffix_tree.score(docs.where("doc_id between 100 and 119"), tree, counts).agg(F.sum("score"), F.sum("base_score")).first()
    assert held_out[0] > held_out[1]
    assert suffix_tree.train(training.limit(0)) is None and suffix_tree.score(docs.limit(0), tree, counts).collect() == []


def test_suffix_tree_against_every_sequence(spark, monkeypatch):
    """Rare words and sequences are states and symbols like frequent ones, whatever is looked up in place."""
    draw = random.Random(29)
    rare = [f"Rare{k} {'y' * (80 if k == 4 else k)}" for k in range(9)]
    texts = [" ".join(f"v{min(int(draw.paretovariate(0.7)), 90)}" for _ in range(draw.randrange(120))) for _ in range(150)]
    for k, passage in ((3, rare), (70, rare), (5, rare[:4]), (9, ["a b c"] * 30), (149, ["a b c"] * 3), *((k, [f"m{draw.randrange(5)} x n"] * 3) for k in range(20, 60))):
        texts[k] = " ".join([texts[k], *passage, texts[k + 1 if k < 140 else 0]])
        texts[k] = " ".join(w + before[1:] if w == "n" else w for before, w in zip(["", "", *texts[k].split()], texts[k].split()))  # n after m3 x is n3
    texts += [None, "", " \t ", "\x0bunseen\x0cA\r\nB  c unseen \u00c4 ", *rare[:2], " ".join(rare), "v1 v2 " * 500]
    learned = texts[:-4]
    every = [suffix_tree.words_of(t) for t in learned]
    total = sum(map(len, every))
    counts = {n: Counter(tuple(w[k : k + n]) for w in every for k in range(len(w) - n + 1)) for n in (1, 2, 3)}
    words = counts[1]
    once, twice = (sum(c == k for c in words.values()) for k in (1, 2))
    discount = min(max(once / (once + 2 * twice), 0.1), 0.9)
    states = {}

    def probability(context, word):
        while context and context not in states:
            context = context[1:]
        if not context:
            c = words[(word,)]
            return (c - discount) / total if c else discount * len(words) / total
        rest, own = states[context]
        return own[word] if word in own else rest * probability(context[1:], word)

    for n in (2, 3):
        after = {}
        for sequence, c in counts[n].items():
            if c >= suffix_tree.LEAST:
                after.setdefault(sequence[:-1], {})[sequence[-1]] = c
        for context, follow in after.items():
            seen = counts[n - 1][context]
            e = {w: probability(context[1:], w) for w in follow}
            gain = {w: c * math.log(c / (seen * e[w])) - c + seen * e[w] for w, c in follow.items()}
            own = {w: (follow[w] + suffix_tree.PRIOR * e[w]) / (seen + suffix_tree.PRIOR) for w, g in gain.items() if g >= suffix_tree.SYMBOL_DIVERGENCE}
            if sum(gain[w] for w in own) >= suffix_tree.DIVERGENCE:
                states[context] = ((1 - sum(own.values())) / (1 - sum(e[w] for w in own)), own)
    assert any(words[context[:1]] < 8 for context in states) and {1, 2} == set(map(len, states))
    want = {k: sum(math.log10(probability(tuple(w[max(0, t - 2) : t]), w[t])) for t in range(len(w))) for k, w in enumerate(map(suffix_tree.words_of, texts))}
    docs = spark.createDataFrame([(k, t, "en", "s", 0, "", "") for k, t in enumerate(texts)], DOCS).repartition(3).localCheckpoint()
    training = docs.where(f"doc_id < {len(learned)}").select("text")
    for share, bits in ((32, 1 << 15), (1 << 17, 1 << 28)):
        for name, value in (("VOCABULARY", share), ("SEQUENCES", share), ("FILTER_BITS", bits), ("CHUNK_CHARS", 5000), ("HELD_SEQUENCES", 300), ("COUNTED_WORDS", 50)):
            monkeypatch.setattr(suffix_tree, name, value)
        tree, table = suffix_tree.train(training)
        assert {bytes(r["word"]): r["c"] for r in table.collect()} == {w[0]: c for w, c in words.items()}
        found = {r["doc_id"]: r for r in suffix_tree.score(docs, tree, table).collect()}
        assert len(found) == len(texts)
        for k, w in enumerate(map(suffix_tree.words_of, texts)):
            assert (found[k]["n_tokens"], found[k]["n_known"]) == (len(w), sum(words[(x,)] > 0 for x in w))
            assert abs(found[k]["base_score"] - sum(math.log10((words[(x,)] + 1) / (total + len(words) + 1)) for x in w)) < 1e-6
            assert abs(found[k]["score"] - want[k]) < 1e-6, k


def test_suffix_tree_shuffles_packed_rows(spark, monkeypatch):
    """Sequences are sent as a few packed buckets, not a row each, and counted as Counter does, wherever equal digests stand."""
    draw = random.Random(17)
    texts = [" ".join(f"v{draw.randrange(40)}" for _ in range(60)) for _ in range(100)] + ["", None, "v1"]
    words = [suffix_tree.words_of(t) for t in texts]
    frame = spark.createDataFrame([(t,) for t in texts], "text string").repartition(3).localCheckpoint()
    total = sum(map(len, words))
    for name, value in (("BUCKET_ROWS", 500), ("HELD_SEQUENCES", 700), ("CHUNK_CHARS", 3000)):
        monkeypatch.setattr(suffix_tree, name, value)
    keys = suffix_tree.cut(suffix_tree.count_words(frame), "words")
    found = suffix_tree.sequence_counts(frame, suffix_tree.Filter(keys, keys.count()), 2, total)
    number = {r["key"]: bytes(r["word"]) for r in keys.collect()}
    want = {p: c for p, c in Counter(p for w in words for p in zip(w, w[1:])).items() if c >= suffix_tree.LEAST}
    assert {(number[r["ctx"]], number[r["suffix"]]): r["c"] for r in found.collect()} == want
    sent = found._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" not in sent and "rows" in sent
    equal = np.array([5, 9, 5, 7, 9, 5], np.uint64)
    for order in (suffix_tree.ordered(equal), suffix_tree.ordered(equal + np.uint64(2**63))):
        assert equal[order].tolist() == [5, 5, 5, 7, 9, 9]
    buckets, rows = suffix_tree.dealt(equal << np.uint64(61), suffix_tree.ordered(equal << np.uint64(61)), [equal], 3)
    assert buckets == [1, 5, 7] and [np.frombuffer(r, np.uint64).tolist() for r in rows] == [[9, 9], [5, 5, 5], [7]]


def test_suffix_tree_keeps_little_on_disk(spark, monkeypatch):
    """What is shuffled for one table goes as soon as it is written, and documents are scored part by part."""

    def shuffled():
        files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        names = [files.apply(i).getName() for i in range(files.size())]
        return {n for n in names if n.startswith("shuffle_")}

    words = ["a b c", "c a b a", "b b", "", None]
    texts = spark.createDataFrame([(k if k % 9 else None, words[k % 5]) for k in range(80)], "doc_id long, text string").repartition(3).localCheckpoint()
    monkeypatch.setattr(suffix_tree, "drop_shuffles", lambda spark: None)  # nothing waits for the JVM to collect
    tree, counts = suffix_tree.train(texts.select("text"))
    got = {}
    for parts in (1, 3):
        monkeypatch.setattr(suffix_tree, "SLICES", parts)
        before = shuffled()
        scored = suffix_tree.score(texts, tree, counts)
        assert not shuffled() - before
        got[parts] = sorted((str(r["doc_id"]), r["n_tokens"], r["n_known"], round(r["base_score"], 9), round(r["score"], 9)) for r in scored.collect())
        assert len(scored.inputFiles()) >= parts
    assert got[1] == got[3] and len(got[1]) == 80


PAGES = "page_id long, url string, html string, node string, bytes string"


def test_warc_audit(spark):
    rows = [(k * 37, f"http://x/{k}", f"<p>{k}</p>é" * (k % 5)) for k in range(500)] + [(2**40, "u", "far"), (-5, "u", "negative"), (None, "u", "no id"), (None, None, None)]
    rows += [(10**6, "u", "copy")] * 30 + [(10**6 + 1, "a", "one"), (10**6 + 1, "b", "two")]
    other = [(i, u, h + "!" if i == 37 else h) for i, u, h in rows if i not in (74, 2**40)] + [(3, "new", "extra")]
    other = [r for r in other if r != (10**6, "u", "copy")] + [(10**6, "u", "copy")] * 29
    draw = random.Random(2)
    draw.shuffle(other)
    frame = lambda data: spark.createDataFrame([(*r, "clash", "clash") for r in data], PAGES)
    got = {r["page_id"]: r for r in warc.fixity_report(frame(rows), frame(other)).collect()}
    damage = {i: r["status"] for i, r in got.items() if r["status"] != "intact"}
    assert damage == {37: "altered", 74: "missing", 2**40: "missing", 3: "extra", 10**6: "altered"}
    size = lambda r: len(("WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:%s>\r\nWARC-Target-URI: %s\r\nContent-Type: text/html\r\nContent-Length: %d\r\n\r\n%s\r\n\r\n" % ("" if r[0] is None else r[0], r[1] or "", len((r[2] or "").encode()), r[2] or "")).encode())
    at = 0
    for i in sorted({r[0] for r in rows}, key=lambda i: (i is not None, i or 0)):
        mine = [size(r) for r in rows if r[0] == i]
        assert (got[i]["offset"], got[i]["length"], got[i]["n_records"]) == (at, sum(mine), len(mine))
        at += sum(mine)
    assert all(r["status"] == "intact" for r in warc.fixity_report(frame(rows), frame(rows[::-1])).collect())
    assert {r["status"] for r in warc.fixity_report(frame(rows).limit(0), frame(other)).collect()} == {"extra"}
    assert warc.fixity_report(frame(rows).limit(0), frame(rows).limit(0)).collect() == []


def test_forward_backward():
    draw = np.random.default_rng(7)
    chain = toxicity.Chain(draw.normal(size=(toxicity.KINDS + 1, 2)), draw.normal(size=(2, 2)), draw.normal(size=2))
    kinds, lengths = draw.integers(0, toxicity.KINDS + 1, (5, 7)), np.array([1, 3, 7, 6, 2])
    state, pairs, norm = chain.marginals(kinds, lengths)
    both = np.zeros((2, 2))
    for row, n in enumerate(lengths):
        weights, marginal = [], np.zeros((n, 2))
        for path in range(2**n):
            tags = [path >> t & 1 for t in range(n)]
            s = chain.start[tags[0]] + sum(chain.emission[kinds[row, t], tags[t]] for t in range(n)) + sum(chain.step[a, b] for a, b in zip(tags, tags[1:]))
            weights.append((tags, math.exp(s)))
        total = sum(w for _, w in weights)
        for tags, w in weights:
            for t in range(n):
                marginal[t, tags[t]] += w / total
            for a, b in zip(tags, tags[1:]):
                both[a, b] += w / total
        assert np.allclose(state[row, :n], marginal) and np.allclose(state[row, n:], 0) and np.isclose(norm[row], math.log(total))
    assert np.allclose(pairs, both)


def test_toxicity_held_out(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{n}.parquet") for n in ("documents", "labels"))
    draw = F.crc32(F.col("doc_id").cast("string")) % 3
    model = toxicity.train(docs.where(draw != 1), labels)
    found = toxicity.score(docs.where(draw == 1).drop("lang", "source"), model).join(labels, "doc_id")
    counts = {(r["toxic"], r["predicted"]): r["n"] for r in found.groupBy("toxic", "predicted").agg(F.count("*").alias("n")).collect()}
    assert counts.get((0, 1), 0) <= 0.02 * counts[0, 0] and counts[1, 1] >= 0.85 * (counts[1, 1] + counts.get((1, 0), 0))
    # Plain sums by table are what the chain gives for the whole text.
    text = "plain words " * 100 + "idiot " + "more plain words " * 40
    kinds = np.array([toxicity.Kinds(model.lean)[w] for w in toxicity.words_of(text)])
    measures, spans = model.measures([kinds, kinds[:0]])
    pieces = [kinds[k : k + toxicity.SEQUENCE] for k in range(0, len(kinds), toxicity.SEQUENCE)]
    plain = sum(model.chain.marginals(p[None, :], np.array([len(p)]))[0][0, :, 1].sum() for p in pieces)
    assert abs(measures[0, 0] - plain) < 1e-9 and [i for i, _ in spans[0]] == [200] and measures[1].tolist() == [0.0, 0.0]


def test_toxicity_edges(spark):
    rows = [(k, f"calm words {k} here", "en", "s", 0, "", "") for k in range(40)] + [(100 + k, f"calm words vileword {k} here", "en", "s", 0, "", "") for k in range(20)]
    odd = [(200, None, None, None, None, None, None), (201, "", "", "", 0, "", ""), (None, "a VILEWORD, indeed", "", "", 0, "", ""), (202, "fine " * 50000 + "vileword", "", "", 0, "", "")]
    docs = spark.createDataFrame(rows + odd, DOCS).withColumn("_toxicity", F.lit(1)).withColumn("score", F.lit("clash"))
    marks = [(k, 0) for k in range(40)] + [(100 + k, 1) for k in range(20)] + [(5, None), (None, 1), (100, 0), (999, 1)]
    labels = spark.createDataFrame(marks, "doc_id long, toxic int")
    model = toxicity.train(docs, labels)
    got = {r["doc_id"]: r for r in toxicity.score(docs, model).collect()}
    assert all(0 <= r["score"] <= 1 for r in got.values()) and got[105]["score"] > got[5]["score"]
    assert [(r["n_spans"], list(r["span_starts"]), list(r["span_ends"])) for r in (got[None], got[200])] == [(1, [2], [11]), (0, [], [])]
    assert got[None]["predicted"] == 1 and got[200]["predicted"] == got[201]["predicted"] == 0 and got[202]["n_spans"] == 1
    kept = toxicity.keep_clean(docs, model)
    assert kept.columns == docs.columns and {200, 201, 5} <= {r["doc_id"] for r in kept.collect()}
    untaught = toxicity.train(docs, labels.where("toxic = 0"))
    assert {r["score"] for r in toxicity.score(docs, untaught).collect()} == {0.0}
    assert toxicity.score(docs.limit(0), model).collect() == []
