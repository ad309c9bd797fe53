"""Byte-level BPE: encode whole texts, and decode them again.

A text is cut into pieces by the tokenizer's pattern. Within a piece, adjacent symbols form a doubly linked list, and a
heap holds every mergeable pair by (rank, position). Popping a pair that no longer stands there (one of its symbols was
merged meanwhile) is a stale entry and skipped. Decoding concatenates the vocabulary strings of the ids.

The vocabulary file has a fixed size; its content travels with the task. Pieces seen before come from a table of two
generations of at most ``CACHE_PIECES`` pieces each per Python worker. Memory is bounded by one Arrow batch plus one text.

Defined cases: a null text is an empty text (no ids, empty string); ids of rows may be null or repeat, each row gives
one row; other columns of the input are ignored, so clashing names don't matter; an empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CACHE_PIECES = 150_000
CACHE_CHUNKS = 250_000
CACHED_CHARS = 64
#: Fixed value: the split pattern of byte-level BPE vocabularies with 50k entries.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
RUN_OF_BLANKS = re.compile(r"\s\s").search


def byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in a byte-level vocabulary."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


class Kept(dict):
    """Results of ``make`` in two generations: when the newer is full it becomes the older, so that common keys stay."""

    def __init__(self, make: Callable[[str], bytes], most: int):
        super().__init__()
        self.make, self.most, self.older = make, most, {}

    def __missing__(self, key: str) -> bytes:
        found = self.older.get(key)
        if found is None:
            found = self.make(key)
        if len(key) <= CACHED_CHARS:
            if len(self) >= self.most:
                self.older = dict(self)
                self.clear()
            self[key] = found
        return found


class Bpe:
    """Encodes to ids as little-endian 32-bit integers, and decodes them."""

    def __init__(self, spec: str):
        doc = json.loads(spec)
        model, letters = doc["model"], byte_letters()
        raw = lambda token: bytes(letters[c] for c in token)
        ids = model["vocab"]
        self.vocab: dict[int, bytes] = {i: raw(t) for t, i in ids.items()}
        self.special = {t["content"]: t["id"] for t in doc.get("added_tokens", [])}
        self.vocab.update({i: s.encode() for s, i in self.special.items()})
        self.of_byte = [0] * 256
        for letter, byte in letters.items():
            self.of_byte[byte] = ids[letter]
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        self.made = [ids[a + b] for a, b in pairs]  # the symbol that the pair of each rank becomes
        self.follow: list[dict[int, int]] = [{} for _ in range(max(ids.values(), default=0) + 1)]  # of a left symbol: right symbol to rank
        for rank, (left, right) in enumerate(pairs):
            self.follow[ids[left]].setdefault(ids[right], rank)
        self.none = len(pairs)  # no pair has this rank
        self.first = [[self.follow[x].get(y, self.none) for y in self.of_byte] for x in self.of_byte]
        self.packed = {i: i.to_bytes(4, "little") for i in self.vocab}
        self.pieces = regex.compile(PATTERN).findall
        self.special_ids = {text: i.to_bytes(4, "little") for text, i in self.special.items()}
        longest_first = sorted(self.special, key=len, reverse=True)
        self.cut = regex.compile("(" + "|".join(map(regex.escape, longest_first)) + ")").split if self.special else None
        self.of_piece, self.of_chunk = Kept(self.piece_ids, CACHE_PIECES), Kept(self.chunk_ids, CACHE_CHUNKS)

    def merge(self, piece: bytes) -> list[int]:
        """Merge by rank over a linked list of symbols. A heap entry is rank and position in one integer.

        ``waiting`` holds the rank of the pair that starts at each position now; an entry of another rank is stale.
        """
        n, none, made, follow, first = len(piece), self.none, self.made, self.follow, self.first
        of_byte = self.of_byte
        symbols = [of_byte[b] for b in piece]
        waiting = [first[left][right] for left, right in zip(piece, piece[1:])]
        waiting.append(none)
        bits = n.bit_length()
        low = (1 << bits) - 1
        heap = [rank << bits | at for at, rank in enumerate(waiting) if rank != none]
        heapq.heapify(heap)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        pop, push = heapq.heappop, heapq.heappush
        while heap:
            top = pop(heap)
            at, rank = top & low, top >> bits
            if waiting[at] != rank:
                continue  # stale: the pair is no longer there
            right = after[at]
            symbols[at] = new = made[rank]
            symbols[right] = -1
            waiting[right] = none
            after[at] = far = after[right]
            if far < n:
                before[far] = at
                waiting[at] = found = follow[new].get(symbols[far], none)
                if found != none:
                    push(heap, found << bits | at)
            else:
                waiting[at] = none
            near = before[at]
            if near >= 0:
                waiting[near] = found = follow[symbols[near]].get(new, none)
                if found != none:
                    push(heap, found << bits | near)
        return [s for s in symbols if s >= 0]

    def piece_ids(self, piece: str) -> bytes:
        return b"".join(map(self.packed.__getitem__, self.merge(piece.encode())))

    def chunk_ids(self, chunk: str) -> bytes:
        """Of a chunk and the space before it, which are one piece if the chunk has only letters."""
        if chunk.isascii() and chunk.isalpha():
            return self.of_piece[" " + chunk]
        return b"".join(map(self.of_piece.__getitem__, self.pieces(" " + chunk)))

    def encode_plain(self, text: str) -> bytes:
        """A space between two other characters always starts a piece, so without runs of blanks chunks stand alone."""
        if RUN_OF_BLANKS(text):
            return b"".join(map(self.of_piece.__getitem__, self.pieces(text)))
        out = []
        for k, line in enumerate(text.split("\n")):
            if k:
                out.append(self.of_piece["\n"])
            first, _, rest = line.partition(" ")
            out.extend(map(self.of_piece.__getitem__, self.pieces(first)))
            if _:
                out.extend(map(self.of_chunk.__getitem__, rest.split(" ")))
        return b"".join(out)

    def encode(self, text: str) -> bytes:
        if self.cut is None:
            return self.encode_plain(text)
        parts = (self.special_ids[part] if part in self.special_ids else self.encode_plain(part) for part in self.cut(text))
        return b"".join(parts)

    def decode(self, packed: bytes) -> str:
        ids = memoryview(packed).cast("I").tolist()  # the machine's order is little-endian wherever Spark runs
        return b"".join(map(self.vocab.__getitem__, ids)).decode("utf-8", "replace")


_MODELS: dict[str, Bpe] = {}


def model_of(spec: str) -> Bpe:
    key = hashlib.sha256(spec.encode()).hexdigest()
    if key not in _MODELS:
        _MODELS.clear()
        _MODELS[key] = Bpe(spec)
    return _MODELS[key]


def encode_decode(docs: DataFrame, tokenizer: str, with_ids: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, n_tokens, ids_sha256, decoded_sha256; with_ids adds ids and the decoded text."""
    with open(tokenizer, encoding="utf-8") as file:
        spec = docs.sparkSession.sparkContext.broadcast(file.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = model_of(spec.value)
        for batch in batches:
            n_tokens, ids, decoded, id_lists, texts = [], [], [], [], []
            for text in batch.column(1):
                packed = model.encode(text.as_py() or "")
                back = model.decode(packed)
                n_tokens.append(len(packed) // 4)
                ids.append(hashlib.sha256(packed).hexdigest())
                decoded.append(hashlib.sha256(back.encode()).hexdigest())
                if with_ids:
                    id_lists.append(memoryview(packed).cast("I").tolist())
                    texts.append(back)
            columns = [batch.column(0), pa.array(n_tokens, pa.int64()), pa.array(ids, pa.string()), pa.array(decoded, pa.string())]
            names = [id_col, "n_tokens", "ids_sha256", "decoded_sha256"]
            if with_ids:
                columns += [pa.array(id_lists, pa.list_(pa.int64())), pa.array(texts, pa.string())]
                names += ["ids", "decoded"]
            yield pa.RecordBatch.from_arrays(columns, names)

    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"`{id_col}` {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    if with_ids:
        schema += ", ids array<long>, decoded string"
    return docs.select(id_col, F.col(text_col).cast("string").alias("_text")).mapInArrow(run, schema)
