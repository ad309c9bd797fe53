"""BPE, licences, quotations, decontamination and perplexity against plain definitions."""

import collections
import hashlib
import math
import random
import re

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tallyward.llm import bpe, decontaminate, licenses, perplexity, quotations

PATH = public_tokenizers.path("byte_bpe_50k.json")
DOCS = "doc_id long, text string, lang string, source string, n_chars long, n_tokens string, score string"
LONG = "Word after word, and 1234 numbers!  \n\n" * 4000
TEXTS = ["", " ", "a", "<|endoftext|>", "x<|endoftext|> y<|endoftext|>", "it's we'LL\tgo", "  two  spaces ", "\n\n\nlines\r\n", "ça où ñandú 日本語 🙂🙂",
         " nbsp　wide", "x" * 3000, "aA1!" * 500, "a \nb", "tail "]


def docs_of(spark, texts, first=0):
    return spark.createDataFrame([(first + k, t, "en", "s", 0, "clash", "clash") for k, t in enumerate(texts)], DOCS)


def test_bpe_is_the_library(spark):
    library, own = Tokenizer.from_file(PATH), bpe.Bpe(open(PATH, encoding="utf-8").read())
    letters = random.Random(5)
    noise = ["".join(letters.choice("ab \n'sé1.,😀\t") for _ in range(60)) for _ in range(300)]
    for text in [*TEXTS, *noise, LONG]:
        ids = library.encode(text, add_special_tokens=False).ids
        packed = own.encode(text)
        assert memoryview(packed).cast("I").tolist() == ids
        assert own.decode(packed) == library.decode(ids, skip_special_tokens=False) == text


def test_bpe_cache_turns_over(monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_PIECES", 3)
    monkeypatch.setattr(bpe, "CACHE_CHUNKS", 3)
    library, own = Tokenizer.from_file(PATH), bpe.Bpe(open(PATH, encoding="utf-8").read())
    text = "one two three four five six seven one two three eight nine one"
    assert memoryview(own.encode(text)).cast("I").tolist() == library.encode(text, add_special_tokens=False).ids


def test_bpe_rows(spark):
    docs = docs_of(spark, [*TEXTS, None, LONG]).unionByName(spark.createDataFrame([(None, "x", "en", "s", 0, "", ""), (0, "", "en", "s", 0, "", "")], DOCS))
    rows = bpe.encode_decode(docs, PATH, with_ids=True).collect()
    assert len(rows) == len(TEXTS) + 4
    by_id = {r["doc_id"]: r for r in rows}
    assert by_id[len(TEXTS)]["n_tokens"] == 0 and by_id[len(TEXTS)]["decoded"] == ""
    library = Tokenizer.from_file(PATH)
    for k, text in enumerate(TEXTS):
        ids = library.encode(text, add_special_tokens=False).ids
        packed = b"".join(i.to_bytes(4, "little") for i in ids)
        r = by_id[k]
        assert (r["n_tokens"], list(r["ids"]), r["ids_sha256"]) == (len(ids), ids, hashlib.sha256(packed).hexdigest())
        assert r["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()
    assert bpe.encode_decode(docs.limit(0), PATH).collect() == []


def brute_licences(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))
    found = [
        (k, label) for phrase, label in licenses.BASE.items() for k in range(len(words)) if words[k : k + len(phrase.split())] == phrase.split()
    ]
    starts = [k for k, _ in found]
    return len(words), len(found), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in found}))


def test_licence_base(spark):
    letters = random.Random(3)
    vocabulary = "gnu general public license apache mit cc by CC BY-NC MIT. License, é the".split()
    texts = [" ".join(letters.choice(vocabulary) for _ in range(60)) for _ in range(200)]
    texts += ["", "MIT-License mit/LICENSE", "gnu\ngeneral\tpublic;license", "cc by cc by cc by", "xmit license", LONG + " MIT License"]
    rows = licenses.scan(docs_of(spark, [*texts, None])).collect()
    for r in rows:
        text = texts[r["doc_id"]] if r["doc_id"] < len(texts) else ""
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) == brute_licences(text)
        assert 0 <= r["score"] <= 1 and set(r["base_labels"].split(",")) - {""} <= set(r["labels"].split(","))
    assert licenses.scan(docs_of(spark, ["x"]).limit(0)).collect() == []


@pytest.mark.parametrize(
    ("text", "names", "demand"),
    [
        ("mit", "mit", 0),
        ("mit or gpl-3.0", "gpl-3.0,mit", 0),
        ("mit and gpl-3.0", "gpl-3.0,mit", 2),
        ("(mit or apache-2.0) and lgpl-2.1", "apache-2.0,lgpl-2.1,mit", 1),
        ("mit or apache-2.0 and gpl-2.0", "apache-2.0,gpl-2.0,mit", 0),
        ("gpl-2.0 with classpath-exception-2.0", "gpl-2.0", 1),
        ("mit */ more words", "mit", 0),
        ("mit and (gpl-2.0", "mit", 0),
        ("mit or", "mit", 0),
        ("mit and see license for details", "mit", 0),
        ("mit or later versions", "mit", 0),
        ("mit. or gpl-3.0", "mit", 0),
        ("gpl-3.0-or-later and licenseref-own", "gpl-3.0-or-later,licenseref-own", 2),
        ("gpl-2.0+ with thanks", "gpl-2.0+", 2),
        ("(apache-2.0 with llvm-exception) or bsd-3-clause.", "apache-2.0,bsd-3-clause", 0),
    ],
)
def test_licence_expressions(text, names, demand):
    found, asked = licenses.expression(text, 0)
    assert (",".join(sorted(found)), asked) == (names, demand)


def test_licence_tags(spark):
    built = licenses.automaton((*licenses.BASE, *licenses.MORE, licenses.TAG))
    row = licenses.scan_text("// SPDX-License-Identifier: MIT OR Apache-2.0\nspdx-license-identifier: )", built)
    assert row[5] == "spdx:apache-2.0,spdx:mit" and row[7] == 1 and row[8] == 0
    assert licenses.expression(" and", 0) is None and licenses.expression("see license", 0) is None and licenses.postfix(["mit", "mit"]) is None and licenses.postfix(["(", "mit"]) is None


CHAT = "conv_id long, turn long, role string, text string, conv string, level int"


def test_quotations(spark):
    rows = [
        (1, 0, "user", "Hello there.\nHow are\nyou today?"),
        (1, 1, "assistant", "> How are you today?\nFine, thanks."),
        (1, 2, "user", "Bob wrote:\n> > How are you today?\n> Fine,   THANKS.\nGood."),
        (1, 3, "user", "> Hello there.\nYes"),
        (1, 4, "user", ">> how are you today?\nlate"),
        (1, 5, None, None),
        (1, 6, "user", "> Late"),
        (2, 0, "user", "> Fine, thanks."),
        (2, 1, "user", "Fine, thanks."),
        (None, 0, "user", "> Fine, thanks."),
        (3, None, "user", "> x"),
        (4, 0, "user", "same"),
        (4, 0, "user", "same"),
        (4, 1, "user", "> same"),
        (4, 1, "user", "> same"),
    ]
    table = spark.createDataFrame([(*r, "clash", 9) for r in rows], CHAT)
    got = quotations.conversations(table).collect()
    assert len(got) == len(rows)
    by = {(r["conv_id"], r["turn"]): r for r in got}
    links = {k: (r["parent_turn"], r["thread_turn"], r["depth"]) for k, r in by.items() if r["parent_turn"] is not None}
    assert links == {(1, 1): (0, 0, 1), (1, 2): (1, 0, 2), (1, 3): (0, 0, 1), (1, 4): (0, 0, 1), (1, 6): (4, 0, 2), (4, 1): (0, 0, 1)}
    assert by[1, 2]["text"] == "Good." and by[1, 2]["formatted"] == "<|user|>\nGood.\n" and by[1, 5]["text"] == ""
    assert by[1, 4]["parent_level"] == 2 and by[2, 0]["thread_turn"] == 0 and by[2, 0]["text"] == ""
    assert quotations.conversations(table.limit(0)).collect() == []


def test_long_threads(spark):
    rows = [(7, k, "user", (f"> message number {k - 1}\n" if k else "") + f"message number {k}", "", 0) for k in range(40)]
    got = quotations.conversations(spark.createDataFrame(rows, CHAT)).collect()
    assert {(r["turn"], r["thread_turn"], r["depth"], r["parent_turn"]) for r in got} == {(k, 0, k, k - 1 if k else None) for k in range(40)}


def linked_by_hand(messages):
    """(conv, turn) -> (parent, level) by comparing every quoted unit with every earlier message's own units."""
    def split(text):
        own, quoted = [], {}
        for line in text.split("\n"):
            m = re.match(r"[ \t]*((?:>[ \t]?)+)", line)
            level = m[1].count(">") if m else 0
            # Passages are runs of lines of one level.
            (quoted.setdefault(level, []) if level else own).append(line[m.end() :] if m else line)
        return own, quoted

    def units(lines):
        found = set()
        for paragraph in "\n".join(lines).split("\n\n"):
            rows = [" ".join(x.lower().split()) for x in paragraph.split("\n")]
            whole = " ".join(r for r in rows if r)
            found |= {*rows, whole, *re.split(r"(?<=[.!?]) ", whole)} - {""}
        return found

    owns = {key: units(split(text)[0]) for key, text in messages.items()}
    links = {}
    for (conv, turn), text in messages.items():
        for level, lines in sorted(split(text)[1].items()):
            weight = {}
            for unit in units(lines):
                holders = [t for (c, t), own in owns.items() if c == conv and unit in own]
                if holders and min(holders) < turn:
                    weight[min(holders)] = weight.get(min(holders), 0) + len(unit)
            if weight:
                links[conv, turn] = (max(weight, key=lambda t: (weight[t], t)), level)
                break
    return links


def test_derived_quotations_against_every_pair(spark):
    draw = random.Random(9)
    words = ["yes", "no", "why", "later", "fine", "go"]
    said = {(c, t): ". ".join(" ".join(draw.choices(words, k=draw.randint(1, 3))) for _ in range(draw.randint(1, 4))) + "." for c in range(12) for t in range(15)}
    said[3, 4], said[3, 9] = "first line\nsecond line", ""
    table = spark.createDataFrame([(c, t, "user", text, "clash", 9) for (c, t), text in said.items()], CHAT)
    quoting = quotations.quoting(table)
    assert quoting.columns == table.columns
    texts = {(r["conv_id"], r["turn"]): r["text"] for r in quoting.collect()}
    assert len(texts) == len(said) and all(texts[k].endswith(said[k]) for k in said)
    assert any("\n> > > " in t for t in texts.values()) and sum("> " in t for t in texts.values()) > len(said) / 2
    got = quotations.conversations(quoting).collect()
    assert {(r["conv_id"], r["turn"]): r["text"] for r in got} == said
    found = {(r["conv_id"], r["turn"]): (r["parent_turn"], r["parent_level"]) for r in got if r["parent_turn"] is not None}
    assert found == linked_by_hand(texts) and len(found) > 80
    edges = [(None, 1, "a"), (1, None, "b"), (1, 1, None), (1, 1, "c"), (1, 2, "> own"), (1, 3, "d"), (1, 4, "e")]
    odd = spark.createDataFrame([(c, t, "user", x, "", 0) for c, t, x in edges], CHAT)
    rows = quotations.quoting(odd.withColumn("_quotingConv", F.lit(1))).collect()
    assert len(rows) == len(edges) and [r["text"] for r in rows if r["turn"] == 2] == ["> own"]
    assert quotations.quoting(odd.limit(0)).collect() == []


QUESTION = "A train leaves Paris with 8 cars and goes to Rome, and 30 people wait in Paris for lunch at 12 km away today."


def test_templates(spark):
    swapped = QUESTION.replace("Paris", "Oslo").replace("30", "41")
    mixed_up = swapped.replace("wait in Oslo", "wait in Bonn")
    filler = "the quick brown fox jumps over the lazy dog while nobody looks at it " * 30
    texts = [filler + QUESTION + " " + filler, swapped, mixed_up, QUESTION[:50], filler, "", None, "tiny item here with five words", LONG, swapped]
    docs = docs_of(spark, texts).unionByName(spark.createDataFrame([(None, QUESTION, "", "", 0, "", ""), (0, "x", "", "", 0, "", "")], DOCS))
    items = [(5, QUESTION), (9, QUESTION.replace("Rome", "Bern")), (2, "Tiny item here with five words"), (3, ""), (4, None), (6, "7 8 9"), (None, "some item that has no id but enough words in it")]
    bench = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, template string")
    got = {(r["doc_id"], r["item_id"]): (r["n_items"], r["coverage"], r["reparameterised"]) for r in decontaminate.contaminated(docs, bench).collect()}
    assert got == {(0, 5): (2, 1.0, False), (1, 5): (2, 1.0, True), (9, 5): (2, 1.0, True), (7, 2): (1, 1.0, False)}
    kept = decontaminate.keep_clean(docs, bench)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect() if r["doc_id"] is not None) == [2, 3, 4, 5, 6, 8]
    assert decontaminate.contaminated(docs, bench.limit(0)).collect() == [] and decontaminate.contaminated(docs.limit(0), bench).collect() == []


def test_leaks_with_altered_slots(spark):
    item = "Anna buys 5 apples and 5 pears while Anna waits for the slow bus to the town and then walks back home"
    other = "a small boat sails over the wide lake to Anna and then on to Anna before it comes back to the old harbour"
    texts = [item.replace("5 apples", "7 apples").replace("5 pears", "9 pears"), item.replace("while Anna", "while Anno"), other.replace("on to Anna", "on to Anni")]
    bench = spark.createDataFrame([(1, item), (2, other)], "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]): r["reparameterised"] for r in decontaminate.contaminated(docs_of(spark, texts), bench).collect()}
    assert got == {(0, 1): True, (1, 1): True, (2, 2): False}


def test_leaks_without_literals(spark):
    numbers, short = "Compute 12 + 7 * 3 - 48 / 6 = 25 , then 9 * 9 = 81 .", "What is the capital city of France?"
    texts = [f"some words before it {numbers} and some behind", f"Q: {short} A: Paris", f"Q: {short.replace('France', 'Spain')} A: Madrid", "What is the capital gain of France?", numbers.replace("48", "47").replace("12", "13")]
    bench = spark.createDataFrame([(1, numbers), (2, short)], "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]): r["reparameterised"] for r in decontaminate.contaminated(docs_of(spark, texts), bench).collect()}
    assert got == {(0, 1): False, (1, 2): False, (2, 2): True}


def test_leaks_against_substrings(spark):
    docs, bench = (spark.read.parquet(f"/root/testdata/sf0.01/{n}.parquet") for n in ("documents", "benchmark"))
    squeezed = lambda t: " ".join(t.split())
    items = [(r["item_id"], squeezed(r["text"])) for r in bench.collect()]
    expected = {(r["doc_id"], i) for r in docs.collect() for i, t in items if t in squeezed(r["text"])}
    got = {(r["doc_id"], r["item_id"]) for r in decontaminate.contaminated(docs, bench).collect()}
    assert expected and got == expected


def test_kneser_ney_adds_up(spark):
    texts = docs_of(spark, ["the cat sat on the mat. " * 3, "a cat and a dog sat.", "THE END!", None, ""])
    model = perplexity.train(texts.select("text"))
    table = 10.0 ** model.log_probabilities().reshape(-1, 64).astype(float)
    assert abs(table.sum(axis=1) - 1).max() < 1e-4
    # By hand, for one text: the n-gram that ends at each byte.
    classes = perplexity.symbol_table()
    text = b"the cat"
    symbols = [0] * 3 + [int(classes[b]) for b in text]
    codes = [sum(symbols[k + j] << 6 * (3 - j) for j in range(4)) for k in range(len(text))]
    cost, size = model.costs(["the cat", None, ""], classes)
    assert abs(cost[0] + sum(float(model.log_probabilities()[c]) for c in codes) / len(text)) < 1e-9 and list(size) == [7, 0, 0]
    assert str(cost[1]) == str(cost[2]) == "nan"
    assert perplexity.train(texts.limit(0).select("text")) is None and perplexity.train(texts.where("text = ''").select("text")) is None


def test_chunks_do_not_matter(monkeypatch):
    classes = perplexity.symbol_table()
    texts = ["abc def", "", None, "x", "é" * 50, "end."]
    whole = list(perplexity.grams(texts, classes))
    monkeypatch.setattr(perplexity, "CHUNK", 5)
    parts = list(perplexity.grams(texts, classes))
    assert [c for codes, _ in whole for c in codes] == [c for codes, _ in parts for c in codes] and len(parts) > 2
    assert [n for _, sizes in whole for n in sizes] == [n for _, sizes in parts for n in sizes] == [7, 0, 0, 1, 100, 4]


def test_perplexity_on_held_out_labels(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{n}.parquet") for n in ("documents", "labels"))
    fitted = perplexity.Judge(docs.where("doc_id % 2 = 0"), labels)
    found = fitted.judged(docs.where("doc_id % 2 = 1"), "verdict").select("doc_id", "verdict.kept").join(labels, "doc_id")
    counts = {(r["quality"], r["kept"]): r["n"] for r in found.groupBy("quality", "kept").agg(F.count("*").alias("n")).collect()}
    assert counts.get((1, False), 0) <= 0.02 * counts[1, True]
    assert counts[0, False] >= 0.85 * (counts[0, False] + counts.get((0, True), 0))


def test_quality_edges(spark):
    rows = [(k, f"plain words number {k} go here and there.", "en", "s", 0, "c", "c") for k in range(60)]
    odd = [(100, None, None, None, None, None, None), (101, "", "en", "", 0, "", ""), (102, "%%% $$$ ### @@@ !!! &&& *** ||| ===", "en", "", 0, "", ""), (None, "plain words go.", "xx", "", 0, "", "")]
    docs = spark.createDataFrame(rows + odd, DOCS).withColumn("_quality", F.lit(1))
    labels = spark.createDataFrame([(k, 1, 0) for k in range(60)] + [(0, 0, 0), (1, None, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    assert perplexity.trusted_ids(labels).count() == 59
    fitted = perplexity.Judge(docs, labels)
    report = {r["doc_id"]: r for r in fitted.report().collect()}
    assert len(report) == 64 and report[100]["perplexity"] is None and report[100]["kept"] and not report[102]["kept"]
    kept = perplexity.keep_good(docs, fitted)
    assert kept.columns == docs.columns
    ids = {r["doc_id"] for r in kept.collect()}
    assert {100, 101, None} <= ids and 102 not in ids
    nothing = perplexity.Judge(docs, labels.limit(0))
    assert perplexity.keep_good(docs, nothing).count() == 64 and all(r["kept"] for r in nothing.report().collect())
    assert perplexity.keep_good(docs.limit(0), fitted).collect() == [] and perplexity.Judge(docs.limit(0), labels).report().collect() == []


def test_quality_of_long_texts(spark):
    draw = random.Random(3)
    words = "plain words of a calm text that goes on and on about the sea the hills and some people".split()
    prose = lambda n: " ".join(draw.choice(words) for _ in range(n)) + "."
    # A length that no trusted text has, of a known language and of an unknown one.
    texts = [prose(60) for _ in range(60)] + ["&&& *** %%% " * 3000, "&&& *** %%% " * 3000, prose(4000), prose(4000)]
    docs = docs_of(spark, texts).withColumn("lang", F.expr("if(doc_id in (61, 63), 'xx', lang)"))
    labels = spark.createDataFrame([(k, 1) for k in range(60)], "doc_id long, quality int")
    report = {r["doc_id"]: r for r in perplexity.Judge(docs, labels).report().collect()}
    assert [report[k]["kept"] for k in range(60, 64)] == [False, False, True, True]
    assert all(report[k]["low"] < report[k]["high"] for k in range(60, 64))
    spread = spark.createDataFrame([("*", perplexity.ALL, 1.0, 4.0)], "lang string, band int, low double, high double")
    assert {(r["own"], r["low"], r["high"]) for r in perplexity.borrowed(spread).collect()} == {(False, 1.0, 4.0)}


@pytest.mark.parametrize("few", [1, 1 << 20])
def test_quality_learns_from_all_trusted_texts(spark, monkeypatch, few):
    docs = docs_of(spark, [f"plain words of text {k}" for k in range(40)])
    labels = docs.select("doc_id", F.when(F.col("doc_id") % 4 == 0, 0).otherwise(1).alias("quality"))
    learned = []
    monkeypatch.setattr(perplexity, "BROADCAST_IDS", few)
    monkeypatch.setattr(perplexity, "train", lambda texts: learned.extend(r["_id"] for r in texts.collect()))
    perplexity.Judge(docs, labels)
    assert sorted(learned) == [r["doc_id"] for r in docs.where("doc_id % 4 <> 0").orderBy("doc_id").collect()]


def kneser_ney(texts, tested):
    """Log10 probability of each byte of ``tested`` by the definition: dictionaries of n-grams of whole bytes."""
    grams = lambda t: [(None, None, None, *t.encode())[i : i + 4] for i in range(len(t.encode()))]
    tables = [collections.Counter(g for t in texts for g in grams(t))]
    for _ in range(3):
        tables.append(collections.Counter(g[1:] for g in tables[-1]))

    def probability(gram, table):
        if not gram:
            return 1 / 255
        counts = tables[table]
        n = [max(1, sum(c == k for c in counts.values())) for k in (1, 2, 3, 4)]
        y = n[0] / (n[0] + 2 * n[1])
        d = [min(max(k - (k + 1) * y * n[k] / n[k - 1], 0.1), k - 0.05) for k in (1, 2, 3)]
        same = [c for g, c in counts.items() if g[:-1] == gram[:-1]]
        shorter = probability(gram[1:], table + 1)
        if not same:
            return shorter
        own = counts[gram] - d[min(counts[gram], 3) - 1] if gram in counts else 0
        return own / sum(same) + sum(d[min(c, 3) - 1] for c in same) / sum(same) * shorter

    return [math.log10(probability(g, 0)) for g in grams(tested)]


@pytest.mark.parametrize("size", [40, 1 << 23])
def test_every_byte_counts(spark, monkeypatch, size):
    # Capitals, digits and bytes beyond ASCII are symbols of their own, among the earlier ones too, whatever the shards.
    texts = ["Ein Haus in Köln, 1234 mal 77.", "THE END of 1234 days\n\tand 42 nights", "naïve déjà vu: 12:30", "Ein HAUS."]
    monkeypatch.setattr(perplexity, "SHARD_GRAMS", size)
    model = perplexity.train(docs_of(spark, texts).select("text"))
    assert (len(model.shards) > 1) == (size == 40)
    tested = ["Ein Haus 1234", "EIN hAUS 4321", "Köln déjà", "K÷ln dèjá", "\x01\x02 中文 zzz", "the end of days"]
    rows = spark.createDataFrame(list(enumerate(tested)), "k int, text string")
    found = rows.select("k", perplexity.cost_column(spark, model, F.col("text")).alias("c")).orderBy("k").collect()
    for text, row in zip(tested, found):
        expected = kneser_ney(texts, text)
        assert row["c"]["n_bytes"] == len(expected) == len(text.encode())
        assert abs(row["c"]["cost"] + sum(expected) / len(expected)) < 1e-5
    costs = [row["c"]["cost"] for row in found]
    assert costs[0] < costs[1] and costs[2] < costs[3]
