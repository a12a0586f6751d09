"""Packing of tokenised documents into fixed-length sequences by a configuration LP.

Tokenised pieces enter only as a histogram of lengths, whose size is bounded by
the sequence length and not by the data. A configuration is a multiset of lengths
that fits a sequence. The configuration LP (cover every length's count with as
few configurations as possible) is solved in fractions on the driver by multiplicative
weights: a knapsack dynamic program prices all configurations under the present
weights, near-best ones are raised, and lengths covered less than the average gain weight;
the gap to the LP's lower bound is stated. The fractions are rounded once, what that
leaves open is packed best-fit decreasing, and the plan is never worse than best-fit decreasing
of everything. The plan (runs of ranks per length) then places the pieces in
parallel: a piece's rank among those of its length tells its sequence and offset.
"""

from __future__ import annotations

import re
import unicodedata
import zlib
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain, filterfalse

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .bpe import LONGEST, Remembered
from .common import give_back, materialise, parts_for, ship

#: Fixed value: the pattern of the lower-casing word vocabulary's pre-tokens.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: Characters whose pre-tokens are told here: of ASCII and the Latin letters up to U+00FF, which every
#: Unicode version lower-cases and composes alike.
_PLAIN = re.compile("[ -~À-ÖØ-öø-ÿ]+").fullmatch
#: The word pattern among them, lower-cased.
_PRE_TOKENS = re.compile("'(?:[stmd]|re|ve|ll)|[a-zß-öø-ÿ]+|[0-9]|[^a-zß-öø-ÿ0-9]+").findall
#: Unknown chunks sent to the tokenizer together.
GROUP = 1000
#: Frequent chunks of the first texts, looked up before all others.
HOT = 20_000
#: Documents tokenised together.
STEP = 2048
#: Chunks, and words of chunks, remembered per worker (two generations of so many each, about 280 bytes each); never changes a result.
CACHE = 450_000


class WordEncoder:
    """Ids by the tokenizers library, one call for many new words.

    No pre-token spans white space, so a text's ids are its chunks' ids in
    order. A new chunk of plain letters, digits and marks is cut here into its lower-cased
    pre-tokens; those that are new are encoded joined by spaces by the library's tokenizer of the same vocabulary
    that cuts at spaces only. Other new chunks are encoded whole, joined by spaces. Since every pre-token ends
    in exactly one end-of-word id, pre-token counts tell the ids apart.
    Counts that don't add up are settled by encoding chunk by chunk.
    """

    def __init__(self, path: str, remember: int = CACHE):
        from tokenizers import Tokenizer, normalizers, pre_tokenizers
        self.lib, self.bare = Tokenizer.from_file(path), Tokenizer.from_file(path)
        self.bare.normalizer = normalizers.Sequence([])
        self.bare.pre_tokenizer = pre_tokenizers.Sequence([
            pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        vocab = self.lib.get_vocab(with_added_tokens=True)
        self.ends = np.zeros(max(vocab.values()) + 1, bool)
        self.ends[[i for s, i in vocab.items() if s.endswith("</w>")]] = True
        self.added = [t.content for t in self.lib.get_added_tokens_decoder().values()]
        self.find = regex.compile(WORD_PATTERN).findall
        self.known, self.words, self.hot = Remembered(remember), Remembered(remember), {}

    def _one(self, chunk: bytes) -> bytes:
        return np.array(self.lib.encode(chunk.decode(), add_special_tokens=False).ids, "<u4").tobytes()

    def _cut(self, ids: list[int], counts: list[int]) -> list[bytes] | None:
        """The ids of neighbours that have so many pre-tokens each; None: the counts don't add up."""
        ids = np.array(ids, "<u4")
        ends = np.flatnonzero(self.ends[ids]) + 1
        if len(ends) != sum(counts) or (len(ids) and ends[-1] != len(ids)):
            return None
        cuts = (4 * np.r_[0, np.r_[0, ends][np.cumsum(counts)]]).tolist()
        raw = ids.tobytes()
        return [raw[a:b] for a, b in zip(cuts[:-1], cuts[1:])]

    def _group(self, chunks: list[bytes]) -> list[bytes]:
        text = b" ".join(chunks).decode()
        if not text.isascii():
            text = unicodedata.normalize("NFC", text)
        find = self.find
        counts = [len(find(t)) for t in text.lower().split(" ")]
        out = None
        if len(counts) == len(chunks) and not any(a in text for a in self.added):
            out = self._cut(self.lib.encode(text, add_special_tokens=False).ids, counts)
        return [self._one(c) for c in chunks] if out is None else out

    def _plain(self, chunks: list[bytes], text: str) -> list[bytes]:
        """As ``_group``, for chunks (joined: ``text``) of ``PLAIN`` characters without added tokens."""
        cut = [_PRE_TOKENS(t) for t in text.lower().split(" ")]
        recent, known, table, fresh = self.words.new.get, self.words.get, {}, []
        for w in set().union(*cut):
            ids = recent(w)
            if ids is None and (ids := known(w)) is None:
                fresh.append(w)
            else:
                table[w] = ids
        for s in range(0, len(fresh), GROUP):
            group = fresh[s:s + GROUP]
            got = self._cut(self.bare.encode_batch_fast([" ".join(group)], add_special_tokens=False)[0].ids, [1] * len(group))
            if got is None:
                return self._group(chunks)
            for w, ids in zip(group, got):
                table[w] = ids
                if len(w) <= LONGEST:
                    self.words.put(w, ids)
        return [b"".join([table[w] for w in ws]) for ws in cut]

    def _new(self, chunks: list[bytes]) -> Iterator[tuple[bytes, bytes]]:
        plain, rest, text = chunks, [], b" ".join(chunks).decode()
        if not _PLAIN(text):
            plain = [c for c in chunks if _PLAIN(c.decode())]
            rest, text = [c for c in chunks if not _PLAIN(c.decode())], b" ".join(plain).decode()
        if any(a in text for a in self.added):
            plain, rest = [], chunks
        if plain:
            yield from zip(plain, self._plain(plain, text))
        for s in range(0, len(rest), GROUP):
            group = rest[s:s + GROUP]
            yield from zip(group, self._group(group))

    def encode(self, texts: list[bytes]) -> Iterator[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        words = [t.split() for t in texts]
        hot = self.hot
        recent, known, table, fresh = self.known.new.get, self.known.get, dict(hot), []
        for w in set().union(*[filterfalse(hot.__contains__, ws) for ws in words]):
            ids = recent(w)
            if ids is None and (ids := known(w)) is None:
                fresh.append(w)
            else:
                table[w] = ids
        for w, ids in self._new(fresh):
            table[w] = ids
            if len(w) <= LONGEST:
                self.known.put(w, ids)
        if not hot:
            often = Counter(chain.from_iterable(words)).most_common(HOT)
            self.hot = {w: table[w] for w, n in often if n > 1 and len(w) <= LONGEST}
        for ws in words:
            yield b"".join(map(table.__getitem__, ws))


@lru_cache(maxsize=2)
def word_encoder(path: str, remember: int = CACHE) -> WordEncoder:
    return WordEncoder(path, remember)


PIECES = "id long, piece int, start long, length int, crc long"


def tokenised_pieces(docs: DataFrame, vocab_path: str, capacity: int, end_id: int = 0, id_col: str = "doc_id",
                     text_col: str = "text", with_ids: bool = False, remember: int = CACHE) -> DataFrame:
    """(id, piece, start, length, crc[, ids]): each document's ids and ``end_id``,
    cut into pieces of ``capacity`` where longer. crc: of the piece's ids as
    little-endian unsigned 32-bit integers. Null text is empty (the end id alone)."""
    end = int(end_id).to_bytes(4, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = word_encoder(vocab_path, remember)
        for whole in batches:
            for at in range(0, whole.num_rows, STEP):
                b = whole.slice(at, STEP)
                texts = [t or b"" for t in b.column(1).cast(pa.binary()).to_pylist()]
                rows = []
                for i, ids in zip(b.column(0).to_pylist(), own.encode(texts)):
                    ids += end
                    for n, s in enumerate(range(0, len(ids), 4 * capacity)):
                        cut = ids[s:s + 4 * capacity]
                        rows.append((i, n, s // 4, len(cut) // 4, zlib.crc32(cut), cut))
                cols = list(zip(*rows)) if rows else [()] * 6
                types = [pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.binary()]
                names = ["id", "piece", "start", "length", "crc", "ids"]
                n = 6 if with_ids else 5
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols[:n], types)], names[:n])
        give_back()
    ship(docs.sparkSession)
    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")
                       ).mapInArrow(run, PIECES + (", ids binary" if with_ids else ""))


def price(lengths: np.ndarray, values: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Unbounded knapsack: for every room w the best value that fits, and the
    index of the length to take there (-1: leave one token empty). ``lengths`` ascend."""
    best, take = np.zeros(capacity + 1), np.full(capacity + 1, -1, np.int64)
    fits = np.searchsorted(lengths, np.arange(capacity + 1), side="right")
    for w in range(1, capacity + 1):
        best[w] = best[w - 1]
        if n := fits[w]:
            got = best[w - lengths[:n]] + values[:n]
            k = int(got.argmax())
            if got[k] > best[w]:
                best[w], take[w] = got[k], k
    return best, take


class Plan:
    """Whole sequences by configuration: runs of ranks per length."""

    def __init__(self):
        self.used: dict[int, int] = {}
        self.rows: list[tuple[int, int, int, int, int]] = []  # length, first rank, count, first sequence, offset
        self.sequences = 0
        self.pricings, self.gap = 0, 0.0  # of the linear program: knapsacks solved, its cost over its lower bound

    def add(self, config: list[int], times: int) -> None:
        at = 0
        for length in config:
            first = self.used.get(length, 0)
            self.rows.append((length, first, times, self.sequences, at))
            self.used[length] = first + times
            at += length
        self.sequences += times


def best_fit(counts: dict[int, int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Best-fit decreasing by runs of equal sequences: (lengths of a sequence, how many such)."""
    groups: dict[int, list[list]] = {}  # room -> [lengths, times]

    def put(room: int, lengths: tuple, times: int) -> None:
        if times:
            groups.setdefault(room, []).append([lengths, times])
    for x in sorted((x for x, n in counts.items() if n > 0), reverse=True):
        n = counts[x]
        for room in sorted(r for r in groups if r >= x):
            fit = room // x  # best fit goes on in the same sequence while it has room
            for lengths, times in groups.pop(room):
                whole = min(times, n // fit)
                put(room - fit * x, lengths + (x,) * fit, whole)
                n -= whole * fit
                part = min(n, fit - 1) if whole < times else 0
                put(room - part * x, lengths + (x,) * part, int(part > 0))
                n -= part
                put(room, lengths, times - whole - int(part > 0))
            if not n:
                break
        fit = capacity // x
        put(capacity - fit * x, (x,) * fit, n // fit)
        put(capacity - n % fit * x, (x,) * (n % fit), int(n % fit > 0))
    return [(lengths, times) for room in groups for lengths, times in groups[room]]


def _filled(k: int, lengths: list[int], take: list[int], open_: list[float], capacity: int) -> dict[int, int]:
    """The best configuration that holds length ``k``: the knapsack's choices, where a length
    that is covered gives way to the longest that fits and isn't."""
    config, room = {k: 1}, capacity - lengths[k]
    while room > 0:
        j = take[room]
        if j < 0:
            room -= 1
            continue
        if open_[j] <= 0:
            j = bisect_right(lengths, room) - 1
            while j >= 0 and open_[j] <= 0:
                j -= 1
            if j < 0:
                break
        config[j] = config.get(j, 0) + 1
        room -= lengths[j]
    return config


def fractional(counts: dict[int, int], capacity: int, rounds: int = 40, share: float = 0.25, eta: float = 1.0,
               slack: float = 0.01) -> tuple[dict[tuple, float], int, float]:
    """The configuration program: cover every length's count by configurations, as few as can be, in fractions.

    Multiplicative weights: a length's value is its size times a weight, and each round multiplies
    the weights by exp(eta * (open share - mean open share)), so lengths less covered than the
    average gain. A knapsack prices all configurations; those that are within ``slack`` of the best
    are raised by ``share`` of what their scarcest length has open. Returns the
    configurations with their fractions, the number of knapsacks, and the gap: their
    number, what is still open counted as if it filled sequences, over the best lower bound (the
    counts' value over that of the best configuration), minus one.
    """
    lengths = sorted(counts)
    size = np.array(lengths, np.int64)
    n = np.array([counts[x] for x in lengths], np.float64)
    open_ = n.copy()
    weight = np.ones(len(lengths))
    x: dict[tuple, float] = {}
    bound, done = float(size @ n) / capacity, 0
    for done in range(1, rounds + 1):
        values = size / capacity * weight
        best, take = price(size, values, capacity)
        bound = max(bound, float(values @ n) / best[capacity])
        worth, choices, left = values + best[capacity - size], take.tolist(), open_.tolist()
        for rank, k in enumerate(np.argsort(-worth, kind="stable").tolist()):
            if rank and worth[k] < (1 - slack) * best[capacity]:
                break
            if left[k] <= 0:
                continue
            config = _filled(k, lengths, choices, left, capacity)
            step = share * min(left[j] / c for j, c in config.items())
            for j, c in config.items():
                left[j] = left[j] - c * step if left[j] - c * step > 1e-6 * n[j] else 0.0
            key = tuple(sorted((lengths[j] for j, c in config.items() for _ in range(c)), reverse=True))
            x[key] = x.get(key, 0.0) + step
        open_ = np.array(left)
        if size @ open_ <= 1e-3 * (size @ n):
            break
        behind = open_ / n
        weight = np.clip(weight * np.exp(eta * (behind - behind.mean())), 0.25, 4)
    return x, done, (sum(x.values()) + float(size @ open_) / capacity) / bound - 1


def solve(counts: dict[int, int], capacity: int, rounds: int = 40) -> Plan:
    """Plan for ``counts`` pieces of each length (1..capacity) into sequences of ``capacity``.

    The fractional program is rounded once: of every configuration its whole part, as far
    as pieces are left, then single ones for the fractions, largest first; what stays open is packed best-fit
    decreasing. Every share of the single ones that is tried, and none of the program at all, leaves a
    whole plan: the one of the fewest sequences is taken, so none is worse than best-fit decreasing.
    """
    plan = Plan()
    counts = {int(x): int(m) for x, m in counts.items() if m > 0}
    if m := counts.pop(capacity, 0):  # fills a sequence alone
        plan.add([capacity], m)
    if not counts:
        return plan
    x, plan.pricings, plan.gap = fractional(counts, capacity, rounds)
    left, whole = dict(counts), []

    def place(config: tuple, most: int, out: list) -> None:
        need = Counter(config)
        times = min(most, *(left[y] // c for y, c in need.items()))
        if times > 0:
            out.append((config, times))
            for y, c in need.items():
                left[y] -= c * times
    order = sorted(x, key=lambda c: (-sum(c), -x[c], c))  # the fullest first
    for config in order:
        place(config, int(x[config]), whole)
    singles: list = []
    for config in sorted(x, key=lambda c: (-sum(c), int(x[c]) - x[c], c)):
        place(config, 1, singles)
    plans = [best_fit(counts, capacity)]
    for share in (0.0, 0.25, 0.5, 0.75, 0.9, 1.0):
        kept = whole + singles[:int(share * len(singles))]
        open_ = Counter(counts)
        for config, times in kept:
            for y in config:
                open_[y] -= times
        plans.append(kept + best_fit(open_, capacity))
    for config, times in min(plans, key=lambda p: sum(t for _, t in p)):
        plan.add(list(config), times)
    return plan


PLACED = PIECES + ", sequence_id long, offset long"


def pack(docs: DataFrame, vocab_path: str, capacity: int = 2048, end_id: int = 0, id_col: str = "doc_id",
         text_col: str = "text", per_group: int = 50_000, remember: int = CACHE) -> DataFrame:
    """One row per piece: id, piece, start, length, crc, sequence_id, offset.

    Null or empty text is one piece holding the end id; repeated rows and null
    ids are packed like any other row; an empty table gives no rows. ``remember``: chunks whose
    ids a worker keeps (time against memory).
    """
    pieces = materialise(tokenised_pieces(docs, vocab_path, capacity, end_id, id_col, text_col, remember=remember), "pieces")
    total = pieces.count()
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    plan = solve(counts, capacity)
    # Rank among the pieces of a length; frequent lengths are split by a hash, so no task sorts a whole length.
    parts = parts_for(total, per_group)
    keyed = pieces.withColumn("sub", F.pmod(F.xxhash64("id", "piece", "crc"), F.lit(parts)))
    sizes = keyed.groupBy("length", "sub").agg(F.count("*").alias("n"))
    by = Window.partitionBy("length").orderBy("sub")  # at most `parts` narrow rows a length
    firsts = sizes.select("length", "sub", (F.sum("n").over(by) - F.col("n")).alias("first"))
    nth = F.row_number().over(Window.partitionBy("length", "sub").orderBy("id", "piece", "crc", "start"))
    ranked = (keyed.withColumn("nth", nth).join(firsts, ["length", "sub"])
              .select("id", "piece", "start", "length", "crc", (F.col("first") + F.col("nth") - 1).alias("rank")))
    rows = np.array(sorted(plan.rows), np.int64).reshape(-1, 5)
    # Bounded by the histogram, not by the data: a few runs per length and round of the solver.
    shared = docs.sparkSession.sparkContext.broadcast(rows)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs = shared.value
        key = runs[:, 0] << 44 | runs[:, 1]
        for b in batches:
            length, rank = b.column(3).to_numpy().astype(np.int64), b.column(5).to_numpy()
            k = np.searchsorted(key, length << 44 | rank, side="right") - 1
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:5], pa.array(runs[k, 3] + rank - runs[k, 1]), pa.array(runs[k, 4])],
                [*b.schema.names[:5], "sequence_id", "offset"])
    return ranked.mapInArrow(place, PLACED)
