"""Packs token pieces into sequences of fixed capacity by a linear grouping scheme.

Tokenising is a map over documents. The plan is made from the histogram of piece lengths alone, so
the driver holds at most one count for each length up to the capacity, however many documents there
are: large lengths are rounded up within groups of equal cardinality; for the few sizes left,
configurations are built that fill a sequence best; ranges of actual pieces take the places of the
rounded ones; small pieces are then best-fitted into what stays free. A piece finds its place by its
length and its number among pieces of that length.

Defined cases: a null or empty text is the end token alone. Repeated rows are packed once each. Null
ids are kept. Other columns are not read. An empty table gives no rows.
"""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .kit import Scratch, map_batches

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


@dataclass(frozen=True)
class Packing:
    capacity: int = 4096
    end: int = 1           # id after each document
    groups: int = 1_500    # of large lengths
    large: float = 1 / 4   # of the capacity; shorter pieces are small
    cache_words: int = 350_000  # tokenised words that a worker remembers


#: A letter before ASCII punctuation ends a word for the tokenizer; a blank put there changes no id.
LETTER = np.array([97 <= b <= 122 for b in range(256)])
PUNCTUATION = np.array([33 <= b <= 47 or 58 <= b <= 64 or 91 <= b <= 96 or 123 <= b <= 126 for b in range(256)])
#: Words of small Latin letters: each is one unit of the tokenizer, and no normal form changes it.
PLAIN = re.compile(rb"(?:[a-z]|\xc3[\x9f-\xb6\xb8-\xbf])+")
#: The tokenizer's letters for bytes: printable Latin-1 for itself, the other bytes in order from 256 on.
_PRINTED = [*range(33, 127), *range(161, 173), *range(174, 256)]
BYTE_LETTERS = {b: chr(b) if b in _PRINTED else chr(256 + sum(x not in _PRINTED for x in range(b))) for b in range(256)}


class Encoder:
    """Ids of texts. Words between ASCII blanks are encoded on their own, since the tokenizer drops blanks before it splits,
    and are remembered in two generations, so memory stays bounded. Case of Latin letters is folded first, as the tokenizer does; texts
    that may hold the name of a special token are left as they are."""

    def __init__(self, path: str, remember: int):
        from tokenizers import Tokenizer
        self.tokenizer, self.most = Tokenizer.from_file(path), remember
        self.new: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}

    def __call__(self, texts: list[bytes]) -> list[bytes]:
        """Little-endian 32-bit ids of each text."""
        split = [t.split() for t in self._spaced(texts)]
        look = self.new.get
        out = [list(map(look, words)) for words in split]
        gaps = [i for i, ids in enumerate(out) if None in ids]
        if gaps:
            self._learn({w for i in gaps for w, ids in zip(split[i], out[i]) if ids is None})
            for i in gaps:
                out[i] = list(map(look, split[i]))
        if len(self.new) > self.most:
            self.old, self.new = self.new, {}
        return list(map(b"".join, out))

    def _spaced(self, texts: list[bytes]) -> list[bytes]:
        """Small letters, and a blank after each word that ASCII punctuation follows."""
        data = np.frombuffer(bytearray(b"".join(texts).lower()), dtype=np.uint8)
        latin = np.flatnonzero(data[:-1] == 0xC3) + 1  # second bytes of accented letters, and of two signs
        latin = latin[(data[latin] != 0x97) & (data[latin] != 0xB7)]
        data[latin[(data[latin] >= 0x80) & (data[latin] <= 0x9E)]] += 0x20
        letter = LETTER[data]
        letter[latin] = True
        wide = np.ones(len(data), dtype=np.uint8)
        wide[:-1] += letter[:-1] & PUNCTUATION[data[1:]]
        ends = np.concatenate(([0], np.cumsum([len(t) for t in texts])))
        after = np.flatnonzero(wide == 2)
        moved = (ends + np.searchsorted(after, ends)).tolist()
        data = np.repeat(data, wide)
        data[after + np.arange(1, len(after) + 1)] = 32
        raw = data.tobytes()
        return [t if b"<|" in t else raw[a:b] for t, a, b in zip(texts, moved, moved[1:])]

    def _learn(self, missing: set[bytes]) -> None:
        fresh = []
        for word in missing:
            known = self.old.get(word)
            if known is None:
                fresh.append(word)
            else:
                self.new[word] = known
        one, rest = self.tokenizer.model.tokenize, []
        for word in fresh:
            if PLAIN.fullmatch(word):
                ids = [t.id for t in one(word.decode("latin-1").translate(BYTE_LETTERS))]
                self.new[word] = struct.pack(f"<{len(ids)}I", *ids)
            else:
                rest.append(word)
        for at in range(0, len(rest), 4096):
            part = rest[at:at + 4096]
            for word, e in zip(part, self.tokenizer.encode_batch_fast([w.decode("utf-8", "replace") for w in part], add_special_tokens=False)):
                self.new[word] = np.array(e.ids, dtype="<u4").tobytes()


_ENCODERS: dict[tuple, Encoder] = {}


def encoder(path: str, remember: int) -> Encoder:
    """One for each worker process: later tasks find the words that earlier ones have met."""
    if (path, remember) not in _ENCODERS:
        _ENCODERS[path, remember] = Encoder(path, remember)
    return _ENCODERS[path, remember]


def pieces(docs: DataFrame, tokenizer: str, how: Packing = Packing()) -> DataFrame:
    """One row for each piece; ``part`` and ``nth`` number the pieces of one length within a task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        encode, part = encoder(tokenizer, how.cache_words), TaskContext.get().partitionId()
        seen = np.zeros(how.capacity + 1, dtype=np.int64)
        end = np.array([how.end], dtype="<u4").tobytes()
        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                rows = batch.slice(at, 200)
                texts = [x or b"" for x in rows.column(1).cast(pa.binary()).to_pylist()]
                out: dict[str, list] = {c: [] for c in ("doc_id", "piece", "start", "length", "ids_crc32", "part", "nth")}
                for doc, ids in zip(rows.column(0).to_pylist(), encode(texts)):
                    ids += end
                    for k, start in enumerate(range(0, len(ids) // 4, how.capacity)):
                        own = ids[4 * start:4 * (start + how.capacity)]
                        size = len(own) // 4
                        for c, v in zip(out, (doc, k, start, size, zlib.crc32(own), part, int(seen[size]))):
                            out[c].append(v)
                        seen[size] += 1
                yield out
    return map_batches(docs.select("doc_id", "text"), run, PIECES + ", part int, nth long")


@dataclass
class Plan:
    """Ranges of pieces: ``count`` pieces of a length, from number ``rank`` on, go to as many sequences from ``sequence`` on."""
    capacity: int
    rows: list[tuple[int, int, int, int, int]] = field(default_factory=list)  # length, rank, count, sequence, offset
    sequences: int = 0
    used: dict[int, int] = field(default_factory=dict)

    def place(self, length: int, count: int, sequence: int, offset: int) -> None:
        rank = self.used.get(length, 0)
        self.used[length] = rank + count
        self.rows.append((length, rank, count, sequence, offset))

    def arrays(self) -> np.ndarray:
        return np.array(sorted(self.rows), dtype=np.int64).reshape(-1, 5)


def grouped(lengths: list[tuple[int, int]], groups: int) -> list[list[tuple[int, int]]]:
    """(length, count) pairs, longest first, cut into runs of nearly equal total count."""
    total = sum(n for _, n in lengths)
    out: list[list[tuple[int, int]]] = []
    left, room = list(reversed(lengths)), 0
    size = -(-total // groups) if total else 0
    while left:
        if not room:
            out.append([])
            room = size
        length, n = left.pop()
        take = min(n, room)
        out[-1].append((length, take))
        room -= take
        if n > take:
            left.append((length, n - take))
    return out


def best_fill(sizes: list[int], demand: list[int], capacity: int, first: int) -> list[int]:
    """Groups, with repetition, that together with one of ``first`` fill the capacity best; bounded by what is in demand."""
    room = capacity - sizes[first]
    by = np.full(room + 1, -1, dtype=np.int32)      # the group whose piece reached this fill last
    by[0] = len(sizes)
    for g, size in enumerate(sizes):
        for _ in range(min(demand[g] - (g == first), room // size)):
            reached = by >= 0
            fresh = np.zeros(room + 1, dtype=bool)
            fresh[size:] = reached[:room + 1 - size]
            fresh &= ~reached
            if not fresh.any():
                break
            by[fresh] = g
            if by[room] >= 0:
                break
        if by[room] >= 0:
            break
    fill, out = int(np.flatnonzero(by >= 0).max()), [first]
    while fill:
        out.append(int(by[fill]))
        fill -= sizes[by[fill]]
    return out


def make_plan(histogram: dict[int, int], how: Packing = Packing()) -> Plan:
    plan = Plan(how.capacity)
    full = histogram.get(how.capacity, 0)
    if full:
        plan.place(how.capacity, full, 0, 0)
    plan.sequences = full
    least = int(how.capacity * how.large)
    large = sorted(((k, n) for k, n in histogram.items() if least < k < how.capacity and n), reverse=True)
    small = sorted(((k, n) for k, n in histogram.items() if k <= least and n), reverse=True)

    groups = grouped(large, how.groups)
    sizes = [g[0][0] for g in groups]
    demand = [sum(n for _, n in g) for g in groups]
    free: dict[int, list[tuple[int, int, int]]] = {}  # room left -> (sequence, count, offset)
    first = 0
    while first < len(groups):
        if not demand[first]:
            first += 1
            continue
        chosen = best_fill(sizes, demand, how.capacity, first)
        uses = {g: chosen.count(g) for g in chosen}
        times = min(demand[g] // k for g, k in uses.items())
        for g, k in uses.items():
            demand[g] -= times * k
        _substitute(plan, [groups[g] for g in chosen], times, free)
    _best_fit(plan, small, free)
    return plan


def _substitute(plan: Plan, slots: list[list[tuple[int, int]]], times: int, free: dict) -> None:
    """Actual lengths in the places of rounded ones; sequences alike in all lengths are one range."""
    while times:
        lead = min([times, *(s[0][1] for s in slots)])
        # a group may fill several slots: its first run must last for all of them
        for s in slots:
            lead = min(lead, max(1, s[0][1] // sum(1 for x in slots if x is s)))
        offset = 0
        for s in slots:
            length, n = s[0]
            plan.place(length, lead, plan.sequences, offset)
            s[0] = (length, n - lead)
            if n == lead:
                s.pop(0)
            offset += length
        free.setdefault(plan.capacity - offset, []).append((plan.sequences, lead, offset))
        plan.sequences += lead
        times -= lead


def _best_fit(plan: Plan, small: list[tuple[int, int]], free: dict) -> None:
    open_rooms = np.zeros(plan.capacity + 1, dtype=bool)
    for room, ranges in free.items():
        open_rooms[room] = bool(ranges)
    for length, n in small:
        while n:
            fits = np.argmax(open_rooms[length:]) + length
            if not open_rooms[fits]:
                each = plan.capacity // length
                whole, rest = divmod(n, each)
                for count, per in ((whole, each), (int(rest > 0), rest)):
                    if count:
                        for j in range(per):
                            plan.place(length, count, plan.sequences, j * length)
                        _release(free, open_rooms, plan.capacity - per * length, (plan.sequences, count, per * length))
                        plan.sequences += count
                break
            sequence, count, offset = free[fits].pop()
            take = min(n, count)
            plan.place(length, take, sequence, offset)
            if count > take:
                free[fits].append((sequence + take, count - take, offset))
            open_rooms[fits] = bool(free[fits])
            _release(free, open_rooms, int(fits) - length, (sequence, take, offset + length))
            n -= take


def _release(free: dict, open_rooms: np.ndarray, room: int, item: tuple[int, int, int]) -> None:
    if room:
        free.setdefault(room, []).append(item)
        open_rooms[room] = True


def packed(docs: DataFrame, tokenizer: str, ws: Scratch, how: Packing = Packing()) -> DataFrame:
    """Every piece with its sequence_id and offset."""
    own = ws.keep("pieces", pieces(docs, tokenizer, how))
    each = own.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n"))
    each = ws.keep("counts", each)  # a row for each task and length
    histogram = {r.length: r.n for r in each.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # at most capacity rows
    plan = make_plan(histogram, how).arrays()
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = each.select("part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    ranked = own.join(base, ["part", "length"]).select(*(c.split()[0] for c in PIECES.split(", ")), (F.col("base") + F.col("nth")).alias("rank"))
    key = plan[:, 0] << 44 | plan[:, 1]
    shared = docs.sparkSession.sparkContext.broadcast((key, plan))  # bounded by the capacity, not by the corpus

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        keys, rows = shared.value
        for batch in batches:
            length, rank = batch.column(3).to_numpy(), batch.column(5).to_numpy()
            at = rows[np.searchsorted(keys, length << 44 | rank, side="right") - 1]
            yield {**dict(zip(batch.schema.names[:5], batch.columns[:5])), "sequence_id": at[:, 3] + rank - at[:, 1], "offset": at[:, 4]}
    return map_batches(ranked, run, PIECES + ", sequence_id long, offset long")
