"""License scan: notice phrases and identifier tags, with licence expressions evaluated.

One Aho-Corasick automaton finds all phrases in a text's words. A text that has the identifier tag is read again behind
each tag: the longest well-formed expression over identifiers of the public licence list (or ``LicenseRef-`` names; other
words end it) is turned into postfix order by a shunting-yard parser (``with`` binds
closest, then ``and``, then ``or``) and evaluated to how much its licences demand (0 permissive, 1 weak or unknown, 2
strong): ``and`` takes the larger, ``or`` the smaller, ``with`` relaxes a strong licence by one.

Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the text with A-Z in lower case. A phrase is found where its words stand
consecutively, whatever stands between them. Memory: one Arrow batch plus one text.

Defined cases: a null or empty text has no words, empty labels and score 0; ids may be null or repeat, each row gives
one row; other input columns are ignored; an empty table gives an empty table.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: The phrases every scan reports, and the label of each.
BASE = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
#: Notices beyond the base.
MORE = {
    "gnu lesser general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "mozilla public license": "mpl",
    "eclipse public license": "epl",
    "bsd license": "bsd",
    "isc license": "isc",
    "public domain": "public-domain",
    "all rights reserved": "reserved",
}
TAG = "spdx license identifier"
TAG_TEXT = re.compile(r"spdx-license-identifier:[ \t]*")
SYMBOL = re.compile(r"[ \t]*([()]|[a-z0-9][a-z0-9.+-]*)")
STRONG = ("gpl", "agpl", "sspl")
WEAK = ("lgpl", "mpl", "epl", "cddl", "cc-by-sa")
PERMISSIVE = ("mit", "apache", "bsd", "isc", "cc0", "cc-by", "zlib", "unlicense", "0bsd")
#: Identifiers of the public SPDX licence list, as names with the versions they come in ("" for none).
IDENTIFIERS = {
    "afl": "1.1 1.2 2.0 2.1 3.0", "agpl": "1.0 3.0", "apache": "1.0 1.1 2.0", "apsl": "1.0 1.1 1.2 2.0", "artistic": "1.0 2.0",
    "bsl": "1.0", "busl": "1.1", "cc-by": "1.0 2.0 2.5 3.0 4.0", "cc-by-nc": "1.0 2.0 2.5 3.0 4.0",
    "cc-by-nc-nd": "1.0 2.0 2.5 3.0 4.0", "cc-by-nc-sa": "1.0 2.0 2.5 3.0 4.0", "cc-by-nd": "1.0 2.0 2.5 3.0 4.0",
    "cc-by-sa": "1.0 2.0 2.5 3.0 4.0", "cc0": "1.0", "cddl": "1.0 1.1", "cecill": "1.0 1.1 2.0 2.1", "cpal": "1.0", "cpl": "1.0",
    "ecl": "1.0 2.0", "efl": "1.0 2.0", "elastic": "2.0", "epl": "1.0 2.0", "eupl": "1.0 1.1 1.2", "gfdl": "1.1 1.2 1.3",
    "gpl": "1.0 2.0 3.0", "ipl": "1.0", "lgpl": "2.0 2.1 3.0", "lppl": "1.0 1.1 1.2 1.3a 1.3c", "mpl": "1.0 1.1 2.0",
    "odbl": "1.0", "ofl": "1.0 1.1", "osl": "1.0 1.1 2.0 2.1 3.0", "php": "3.0 3.01", "psf": "2.0", "python": "2.0 2.0.1", "qpl": "1.0",
    "spl": "1.0", "sspl": "1.0", "upl": "1.0", "vim": "", "zpl": "1.1 2.0 2.1", "0bsd": "", "beerware": "", "bsd-1-clause": "",
    "bsd-2-clause": "", "bsd-2-clause-patent": "", "bsd-3-clause": "", "bsd-3-clause-clear": "", "bsd-4-clause": "",
    "blueoak": "1.0.0", "curl": "", "hpnd": "", "ijg": "", "icu": "", "isc": "", "json": "", "libpng": "", "mit": "", "mit-0": "",
    "ms-pl": "", "ms-rl": "", "ncsa": "", "ntp": "", "openssl": "", "postgresql": "", "ruby": "", "sleepycat": "", "tcl": "",
    "unicode-dfs-2016": "", "unlicense": "", "w3c": "", "wtfpl": "", "x11": "", "xnet": "", "zend": "2.0", "zlib": "",
}
#: Families whose names may end in these.
ENDED, ENDINGS = ("agpl", "gpl", "lgpl", "gfdl"), ("-only", "-or-later")
BINDS = {"with": 3, "and": 2, "or": 1}
NOTICE_WEIGHT, TAG_WEIGHT = 0.6, 0.9

_SPACED = bytes(c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else 0x20 for c in range(256))


def automaton(phrases: tuple[str, ...]) -> ahocorasick.Automaton:
    built = ahocorasick.Automaton()
    for phrase in phrases:
        built.add_word(f" {phrase} ", phrase)
    built.make_automaton()
    return built


def demand(licence: str) -> int:
    """0 permissive, 1 weak or unknown, 2 strong; by the name's stem."""
    starts = lambda stems: any(licence == s or licence.startswith((s + "-", s + ".")) for s in stems)
    return 1 if starts(WEAK) else 2 if starts(STRONG) else 0 if starts(PERMISSIVE) else 1


def known_identifiers() -> frozenset[str]:
    names = set()
    for name, versions in IDENTIFIERS.items():
        for version in versions.split() or [""]:
            whole = f"{name}-{version}" if version else name
            names.update([whole, *(whole + e for e in ENDINGS if name in ENDED)])
    return frozenset(names)


KNOWN = known_identifiers()


def is_operand(name: str, exception: bool) -> bool:
    """Whether a symbol names a licence; behind ``with``, an exception (their names end so, before a version)."""
    if exception:
        return re.search(r"-(exception|note)(-[0-9.]+)?$", name) is not None
    return name.removesuffix("+") in KNOWN or name.startswith("licenseref-")


def postfix(symbols: list[str]) -> list[str] | None:
    """Shunting-yard; None when the symbols aren't one well-formed expression."""
    out, held, operand_next = [], [], True
    for s in symbols:
        if s == "(":
            if not operand_next:
                return None
            held.append(s)
        elif s == ")":
            if operand_next:
                return None
            while held and held[-1] != "(":
                out.append(held.pop())
            if not held:
                return None
            held.pop()
        elif s in BINDS:
            if operand_next:
                return None
            while held and held[-1] != "(" and BINDS[held[-1]] >= BINDS[s]:
                out.append(held.pop())
            held.append(s)
            operand_next = True
        else:
            if not operand_next:
                return None
            out.append(s)
            operand_next = False
    if operand_next or "(" in held:
        return None
    return out + held[::-1]


def evaluate(order: list[str]) -> tuple[set[str], int]:
    """Licences named, and what they demand together."""
    stack: list[tuple[set[str], int]] = []
    for s in order:
        if s not in BINDS:
            stack.append(({s}, demand(s)))
            continue
        (more, b), (names, a) = stack.pop(), stack.pop()
        if s == "with":  # the right side names an exception, not a licence
            stack.append((names, max(a - 1, 0) if a == 2 else a))
        else:
            stack.append((names | more, max(a, b) if s == "and" else min(a, b)))
    return stack.pop()


def expression(text: str, at: int) -> tuple[set[str], int] | None:
    """The longest well-formed expression that starts at ``at``, evaluated."""
    symbols: list[str] = []
    operand_next, depth, good = True, 0, 0
    while m := SYMBOL.match(text, at):
        s = m[1].rstrip(".-")
        opens = s == "(" and operand_next
        closes = s == ")" and not operand_next and depth > 0
        links = s in BINDS and not operand_next
        names = s not in BINDS and s not in "()" and operand_next and is_operand(s, symbols[-1:] == ["with"])
        if not (opens or closes or links or names):
            break
        symbols.append(s)
        depth += opens - closes
        operand_next = opens or links
        if not operand_next and depth == 0:
            good = len(symbols)
        if s != m[1]:  # a full stop ends it
            break
        at = m.end()
    order = postfix(symbols[:good]) if good else None
    return evaluate(order) if order else None


def scan_text(text: str, built: ahocorasick.Automaton) -> tuple:
    """n_words, n_base, first_word, last_word, base_labels, labels, score, n_tags, demand of one text."""
    raw = text.encode()
    words = raw.lower().translate(_SPACED).split()
    spaced = " " + b" ".join(words).decode("latin-1") + " "
    starts: list[int] = []
    base, labels, notices, tagged = set(), set(), 0, False
    gaps: list[int] | None = None
    for end, phrase in built.iter(spaced):
        if phrase == TAG:
            tagged = True
            continue
        notices += 1
        if label := BASE.get(phrase):
            if gaps is None:
                gaps = [m.start() for m in re.finditer(" ", spaced)]
            starts.append(bisect_left(gaps, end - len(phrase) - 1))
            base.add(label)
        else:
            labels.add(MORE[phrase])
    tags, most = 0, None
    if tagged:
        lower = raw.lower().decode()
        for m in TAG_TEXT.finditer(lower):
            if found := expression(lower, m.end()):
                tags += 1
                labels |= {f"spdx:{name}" for name in found[0]}
                most = found[1] if most is None else max(most, found[1])
    score = 1.0 - (1 - NOTICE_WEIGHT) ** notices * (1 - TAG_WEIGHT) ** tags
    join = lambda names: ",".join(sorted(names))
    return (len(words), len(starts), min(starts, default=None), max(starts, default=None), join(base), join(base | labels), score, tags, most)


COLUMNS = {
    "n_words": pa.int64(), "n_base": pa.int64(), "first_word": pa.int64(), "last_word": pa.int64(),
    "base_labels": pa.string(), "labels": pa.string(), "score": pa.float64(), "n_tags": pa.int64(), "demand": pa.int32(),
}


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id and the fields of ``COLUMNS``."""
    phrases = (*BASE, *MORE, TAG)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        built = automaton(phrases)
        for batch in batches:
            found = [scan_text(text.as_py() or "", built) for text in batch.column(1)]
            columns = [pa.array([row[k] for row in found], kind) for k, kind in enumerate(COLUMNS.values())]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], [id_col, *COLUMNS])

    kind = docs.schema[id_col].dataType.simpleString()
    schema = (
        f"`{id_col}` {kind}, n_words long, n_base long, first_word long, last_word long, base_labels string,"
        " labels string, score double, n_tags long, demand int"
    )
    return docs.select(id_col, F.col(text_col).cast("string").alias("_text")).mapInArrow(run, schema)
