"""Byte-level BPE encoding and decoding from a public vocabulary file.

Texts are cut before white space that follows a non-space, where no pre-token
can span; the pieces are cut by the vocabulary's pattern into pre-tokens, and
each is merged with a priority queue of merge ranks over a doubly linked symbol
list, entries gone stale being skipped when they surface. Encoded pieces are
remembered per worker, up to a fixed number (a cache: it never changes results).
Decoding concatenates vocabulary strings.
"""

from __future__ import annotations

import heapq
import json
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ship

#: Remembered pieces and pre-tokens per worker; full caches start anew.
CACHE = 150_000
#: Longer ones aren't remembered.
LONGEST = 64
#: Fixed value: the pattern that byte-level BPE vocabularies of this kind split text with.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_ODD_SPACE = re.compile(r"[\t\r\x0b\x0c\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
_PIECES = re.compile("[ \n]*[^ \n]+|[ \n]+")


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in vocabulary strings:
    printable Latin-1 bytes are themselves, the others follow from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(rest)) for b in range(256)]


class Remembered:
    """Bounded memory in two generations: what was used since the last turn-over survives the next one."""

    def __init__(self, limit: int = CACHE):
        self.limit, self.new, self.old = limit, {}, {}

    def get(self, key):
        out = self.old.get(key)
        if out is not None:
            self.put(key, out)
        return out

    def put(self, key, value) -> None:
        if len(self.new) >= self.limit:
            self.old = dict(self.new)
            self.new.clear()  # the same dict stays: callers hold its ``get``
        self.new[key] = value


class Merger:
    """Merges of one vocabulary over rows of symbol ids."""

    def __init__(self, vocab: dict[str, int], merges: list):
        self.shift = max(vocab.values()).bit_length()
        self.rank: dict[int, int] = {}
        self.made: list[int] = []
        for m in merges:
            x, y = m if isinstance(m, list) else m.split(" ")
            self.rank[vocab[x] << self.shift | vocab[y]] = len(self.made)
            self.made.append(vocab[x + y])

    def merge(self, ids: list[int]) -> list[int]:
        """Always the pair of lowest rank, leftmost first. The heap holds rank and
        position in one number; ``at`` is the rank each position's pair has now."""
        n = len(ids)
        if n < 2:
            return ids
        shift, rank, made = self.shift, self.rank.get, self.made
        at = [rank(x << shift | y, -1) for x, y in zip(ids, ids[1:])]
        width = n.bit_length()
        heap = [r << width | i for i, r in enumerate(at) if r >= 0]
        if len(heap) < 2:
            if heap:
                i = heap[0] & ((1 << width) - 1)
                ids[i:i + 2] = [made[at[i]]]
                return self.merge(ids) if n > 2 else ids
            return ids
        heapq.heapify(heap)
        low = (1 << width) - 1
        at.append(-1)
        right = list(range(1, n + 1))
        left = list(range(-1, n))
        while heap:
            e = heappop(heap)
            i = e & low
            if at[i] != e >> width:
                continue  # stale: one of the two was merged meanwhile
            j = right[i]
            k = right[i] = right[j]
            new = ids[i] = made[e >> width]
            ids[j] = at[j] = -1
            if k < n:
                left[k] = i
                r = at[i] = rank(new << shift | ids[k], -1)
                if r >= 0:
                    heappush(heap, r << width | i)
            else:
                at[i] = -1
            h = left[i]
            if h >= 0:
                r = at[h] = rank(ids[h] << shift | new, -1)
                if r >= 0:
                    heappush(heap, r << width | h)
        return [t for t in ids if t >= 0]


class ByteBPE:
    """Encoder and decoder of one vocabulary file (byte-level, added tokens found in the text first)."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letters = byte_letters()
        vocab = spec["model"]["vocab"]
        back = {c: b for b, c in enumerate(letters)}
        self.strings = [b""] * (max([*vocab.values(), *[t["id"] for t in spec["added_tokens"]]]) + 1)
        for s, i in vocab.items():
            self.strings[i] = bytes(back[c] for c in s) if all(c in back for c in s) else s.encode()
        self.byte_ids = [vocab[c] for c in letters]
        self.merger = Merger(vocab, spec["model"]["merges"])
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        for s, i in self.added.items():
            self.strings[i] = s.encode()
        self.find_added = regex.compile("(" + "|".join(map(regex.escape, sorted(self.added, key=len, reverse=True))) + ")")
        self.split = regex.compile(PATTERN).findall
        self.tokens, self.pieces = Remembered(), Remembered()

    def _token(self, token: str) -> bytes:
        out = self.tokens.new.get(token) or self.tokens.get(token)
        if out is None:
            byte_ids = self.byte_ids
            out = array("I", self.merger.merge([byte_ids[b] for b in token.encode()])).tobytes()
            if len(token) <= LONGEST:
                self.tokens.put(token, out)
        return out

    def _piece(self, piece: str) -> bytes:
        out = self.pieces.get(piece)
        if out is None:
            out = b"".join([self._token(t) for t in self.split(piece)])
            if len(piece) <= LONGEST:
                self.pieces.put(piece, out)
        return out

    def _plain(self, text: str) -> bytes:
        if _ODD_SPACE.search(text):
            return b"".join([self._token(t) for t in self.split(text)])
        known = self.pieces.new.get
        return b"".join([known(p) or self._piece(p) for p in _PIECES.findall(text)])

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        if not any(s in text for s in self.added):
            return self._plain(text)
        return b"".join([self.added[p].to_bytes(4, "little") if p in self.added else self._plain(p)
                         for p in self.find_added.split(text) if p])

    def decode(self, ids: bytes) -> str:
        """Vocabulary strings joined; bytes that aren't UTF-8 become U+FFFD. Unknown ids give nothing."""
        strings, n = self.strings, len(self.strings)
        return b"".join([strings[i] for i in np.frombuffer(ids, "<u4").tolist() if i < n]).decode("utf-8", "replace")


@lru_cache(maxsize=4)
def encoder(path: str) -> ByteBPE:
    return ByteBPE(path)


ENCODED = "id long, ids binary"


def encode(docs: DataFrame, vocab_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids) per row: the whole text's ids as little-endian unsigned 32-bit integers.

    Null or empty text has no ids; ids and repeated rows pass through as they
    are; an empty table gives no rows. The vocabulary file must be at
    ``vocab_path`` on every executor (it is part of an installed package).
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(vocab_path)
        for b in batches:
            for s in range(0, b.num_rows, 512):  # output batches of bounded size
                part = b.slice(s, 512)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([own.encode(t or "") for t in part.column(1).to_pylist()], pa.binary())],
                    ["id", "ids"])
    ship(docs.sparkSession)
    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")
                       ).mapInArrow(run, ENCODED)


def decode(encoded: DataFrame, vocab_path: str) -> DataFrame:
    """(id, ids, text): the ids' text, special tokens included; null ids give null."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(vocab_path)
        for b in batches:
            texts = [None if x is None else own.decode(x) for x in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(texts, pa.string())], ["id", "ids", "text"])
    ship(encoded.sparkSession)
    return encoded.select("id", "ids").mapInArrow(run, f"{ENCODED}, text string")

