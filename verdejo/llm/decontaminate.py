"""Benchmark decontamination by an FM-index for each shard of the documents.

A task gathers documents into shards of about a million words, builds an FM-index over word symbols
(suffix array by prefix doubling, Burrows-Wheeler transform in a wavelet matrix, sampled suffix
positions), searches every benchmark window backwards, locates the occurrences and merges their
spans. Symbols are 16 bits of a word's hash, so each located place is compared with the full hashes
of the window's words. Nothing is shuffled. The benchmark is the query set: it is streamed through the
driver, which writes it in blocks of bounded size; each shard reads them one after the other, and a worker
holds one at a time.

Defined cases: null texts have no words and cannot be hit; an item without words has no window; the
same window in several items counts for each; items without an id hit but are not named. Repeated
rows give repeated results, null ids are kept, other columns are not read. A text longer than a
shard is indexed in parts that overlap by a window.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.broadcast import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .kit import Scratch, map_batches, row_key, rows_by
from .words import IN_ALNUM, Words, columns

LEVELS = 16


@dataclass(frozen=True)
class Search:
    window: int = 13
    shard_words: int = 1_000_000
    sample: int = 16            # one suffix position in so many is stored
    block_phrases: int = 200_000  # windows shipped at once
    least_share: int = 20       # contaminated: hits are at least one word in so many


def symbols_of(hashes: np.ndarray) -> np.ndarray:
    return np.maximum(hashes >> np.uint64(48), np.uint64(1)).astype(np.uint16)


def suffix_array(symbols: np.ndarray) -> np.ndarray:
    """Order of all suffixes. Symbol 0 ends a text; equal ends are ordered by place, so comparisons never cross them."""
    n = len(symbols)
    order = np.argsort(symbols, kind="stable")
    ordered = symbols[order]
    opens = np.ones(n, dtype=bool)
    opens[1:] = (ordered[1:] != ordered[:-1]) | (ordered[1:] == 0)
    rank = np.empty(n, dtype=np.int64)
    rank[order] = np.maximum.accumulate(np.where(opens, np.arange(n), 0))
    alone = opens & np.append(opens[1:], True)
    active, step = order[~alone], 1
    while len(active):
        key = rank[active] * n + rank[active + step]
        by = np.argsort(key, kind="stable")
        active, key = active[by], key[by]
        group = key // n
        first = np.ones(len(key), dtype=bool)
        first[1:] = group[1:] != group[:-1]
        new = np.ones(len(key), dtype=bool)
        new[1:] = key[1:] != key[:-1]
        at = np.arange(len(key))
        rank[active] = group + np.maximum.accumulate(np.where(new, at, 0)) - np.maximum.accumulate(np.where(first, at, 0))
        active = active[~(new & np.append(new[1:], True))]
        step *= 2
    out = np.empty(n, dtype=np.int64)
    out[rank] = np.arange(n)
    return out


class FMIndex:
    def __init__(self, symbols: np.ndarray, sample: int):
        suffixes = suffix_array(symbols)
        self.bwt = symbols[suffixes - 1]
        counts = np.bincount(symbols, minlength=(1 << LEVELS) + 1)
        self.before = np.concatenate(([0], np.cumsum(counts)))
        # every sample-th place is stored, and each first word of a text, since no walk crosses an end
        stored = np.zeros(len(symbols), dtype=bool)
        stored[::sample] = True
        stored[0] = True
        stored[1:] |= symbols[:-1] == 0
        marked = stored[suffixes]
        self.marked, self.places = marked, suffixes[marked]
        self.marks_before = np.concatenate(([0], np.cumsum(marked)))
        self.ones, self.zeros, level = [], [], self.bwt
        for bit in range(LEVELS - 1, -1, -1):
            bits = (level >> np.uint16(bit)) & np.uint16(1)
            ones = np.zeros(len(level) + 1, dtype=np.int32)
            np.cumsum(bits, out=ones[1:], dtype=np.int32)
            self.ones.append(ones)
            self.zeros.append(len(level) - int(ones[-1]))
            level = np.concatenate((level[bits == 0], level[bits == 1]))

    def rank(self, symbol: np.ndarray, row: np.ndarray) -> np.ndarray:
        """How often each symbol stands in the transform before each row."""
        low, high = np.zeros_like(row), row
        for depth, (ones, zeros) in enumerate(zip(self.ones, self.zeros)):
            one = (symbol >> (LEVELS - 1 - depth)) & 1 == 1
            a, b = ones[low], ones[high]
            low, high = np.where(one, zeros + a, low - a), np.where(one, zeros + b, high - b)
        return high - low

    def search(self, phrases: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Backward search: phrases found, and their ranges of suffixes. Row i holds ``lengths[i]`` symbols."""
        last = phrases[np.arange(len(phrases)), lengths - 1].astype(np.int64)
        low, high = self.before[last], self.before[last + 1]
        open_ = np.flatnonzero(high > low)
        done = [], [], []
        low, high = low[open_], high[open_]
        for back in range(2, phrases.shape[1] + 2):
            ended = lengths[open_] < back
            for out, x in zip(done, (open_, low, high)):
                out.append(x[ended])
            open_, low, high = open_[~ended], low[~ended], high[~ended]
            if not len(open_):
                break
            symbol = phrases[open_, lengths[open_] - back].astype(np.int64)
            low, high = self.before[symbol] + self.rank(symbol, low), self.before[symbol] + self.rank(symbol, high)
            some = high > low
            open_, low, high = open_[some], low[some], high[some]
        return tuple(np.concatenate(x) for x in done)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Places of suffixes: walk back to a stored one."""
        rows, out = rows.copy(), np.zeros(len(rows), dtype=np.int64)
        walk, steps = np.arange(len(rows)), 0
        while len(walk):
            here = self.marked[rows[walk]]
            end = walk[here]
            out[end] = self.places[self.marks_before[rows[end]]] + steps
            walk = walk[~here]
            symbol = self.bwt[rows[walk]].astype(np.int64)
            rows[walk] = self.before[symbol] + self.rank(symbol, rows[walk])
            steps += 1
        return out


@dataclass
class Phrases:
    """Windows as rows of word hashes, with the items that hold them in ``items[starts[i]:starts[i + 1]]``."""
    hashes: np.ndarray
    lengths: np.ndarray
    starts: np.ndarray
    items: np.ndarray

    @staticmethod
    def of(windows: dict[tuple, set], width: int) -> "Phrases":
        hashes = np.zeros((len(windows), width), dtype=np.uint64)
        lengths = np.array([len(w) for w in windows], dtype=np.int64)
        for row, w in zip(hashes, windows):
            row[:len(w)] = w
        return Phrases(hashes, lengths, np.cumsum([0, *map(len, windows.values())]), np.array([i for s in windows.values() for i in sorted(s)], dtype=object))


def phrase_blocks(benchmark: DataFrame, how: Search) -> Iterator[Phrases]:
    windows: dict[tuple, set] = {}
    for r in benchmark.select("item_id", "text").toLocalIterator():
        data = np.frombuffer((r.text or "").encode(), dtype=np.uint8)
        words = Words(data, np.array([0, len(data)]), IN_ALNUM, lower=True).hashes().tolist()
        for at in range(max(len(words) - how.window + 1, min(1, len(words)))):
            windows.setdefault(tuple(words[at:at + how.window]), set()).update(() if r.item_id is None else (r.item_id,))
            if len(windows) >= how.block_phrases:
                yield Phrases.of(windows, how.window)
                windows = {}
    if windows:
        yield Phrases.of(windows, how.window)


class Blocks:
    """Broadcast blocks, read anew each time they are gone through unless there is only one; none is kept once the next is asked for."""

    def __init__(self, shipped: list[Broadcast]):
        self.shipped = shipped

    def __iter__(self) -> Iterator[Phrases]:
        return map(self.read, self.shipped)

    def read(self, one: Broadcast) -> Phrases:
        block = one.value
        if len(self.shipped) > 1 and getattr(one, "_path", None):  # it can be read again from its file
            one.__dict__.pop("_value", None)
        return block


def find(hashes: np.ndarray, starts: np.ndarray, blocks: Blocks, how: Search) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, Phrases]]:
    """Occurrences of each block's phrases: text number, first word in the text, phrase. ``starts`` bounds the texts."""
    n_texts = len(starts) - 1
    ends = starts[1:] + np.arange(n_texts)          # where the closing symbols go
    full = np.zeros(len(hashes) + n_texts, dtype=np.uint64)
    inner = np.ones(len(full), dtype=bool)
    inner[ends] = False
    full[inner] = hashes
    symbols = symbols_of(full)
    symbols[ends] = 0
    index = FMIndex(symbols, how.sample)
    for block in blocks:
        phrase, low, high = index.search(symbols_of(block.hashes), block.lengths)
        count = high - low
        rows = np.repeat(low, count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        phrase, place = np.repeat(phrase, count), index.locate(rows)
        same = np.ones(len(place), dtype=bool)
        for j in range(how.window):
            inside = block.lengths[phrase] > j
            same[inside] &= full[place[inside] + j] == block.hashes[phrase[inside], j]
        phrase, place = phrase[same], place[same]
        text = np.searchsorted(ends, place)
        yield text, place - starts[text] - text, phrase, block
        del block  # before the next one is read


class Shard:
    """Documents gathered until there are enough words for an index."""

    def __init__(self, how: Search, blocks: Blocks):
        self.how, self.blocks = how, blocks
        self.ids: list = []
        self.keys: list[int] = []
        self.counts: list[int] = []
        self.hashes: list[np.ndarray] = []
        self.size = 0

    def add(self, doc_id, key: int, hashes: np.ndarray) -> None:
        self.ids.append(doc_id)
        self.keys.append(key)
        self.counts.append(len(hashes))
        self.hashes.append(hashes)
        self.size += len(hashes)

    def results(self) -> dict:
        how, counts = self.how, np.array(self.counts, dtype=np.int64)
        hashes = np.concatenate(self.hashes) if self.hashes else np.empty(0, dtype=np.uint64)
        base = np.concatenate(([0], np.cumsum(counts)))
        edges = np.zeros(len(hashes) + 1, dtype=np.int32)
        items: dict[int, set] = {}
        step = how.shard_words
        for at in range(0, max(len(hashes), 1), step):  # more than one part only if a single text is longer than a shard
            stop = min(len(hashes), at + step + how.window - 1)
            starts = np.unique(np.clip(base, at, stop)) if at or stop < len(hashes) else base
            if stop <= at:
                break
            for text, first, phrase, block in find(hashes[at:stop], starts - at, self.blocks, how):
                place = starts[text] + first
                np.add.at(edges, place, 1)
                np.add.at(edges, place + block.lengths[phrase], -1)
                owner = np.searchsorted(base, place, side="right") - 1
                for doc, p in np.unique(np.stack((owner, phrase)), axis=1).T.tolist():
                    items.setdefault(doc, set()).update(block.items[block.starts[p]:block.starts[p + 1]].tolist())
                del block
        hit = np.cumsum(edges[:-1]) > 0
        total = np.concatenate(([0], np.cumsum(hit)))
        n_hit = total[base[1:]] - total[base[:-1]]
        named = [sorted(str(x) for x in items.get(i, ())) for i in range(len(counts))]
        return {"doc_id": self.ids, "key": self.keys, "n_words": counts, "n_hit": n_hit, "n_items": [len(x) for x in named],
                "items_sha256": [hashlib.sha256(",".join(x).encode()).hexdigest() for x in named],
                "contaminated": (n_hit > 0) & (how.least_share * n_hit >= counts),
                "spans": [_spans(hit[a:b]) if n else [] for a, b, n in zip(base, base[1:], n_hit)]}


def _spans(hit: np.ndarray) -> list[dict]:
    """Runs of hit words: merged removal spans, as first word and word after the last."""
    turns = np.flatnonzero(np.diff(np.concatenate(([0], hit.view(np.int8), [0]))))
    return [{"first": int(a), "after": int(b)} for a, b in zip(turns[::2], turns[1::2])]


RESULT = ("doc_id long, key long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean, "
          "spans array<struct<first: int, after: int>>")


def judged(docs: DataFrame, benchmark: DataFrame, how: Search = Search()) -> DataFrame:
    """One row for each document: counts, items, verdict and removal spans; ``key`` is ``row_key`` of id and text."""
    context = docs.sparkSession.sparkContext
    blocks: list[Broadcast] = [context.broadcast(b) for b in phrase_blocks(benchmark, how)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        shard = Shard(how, Blocks(blocks))
        for batch in batches:
            ids, keys = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for a, b, data, offsets in columns(batch, "text"):
                words = Words(data, offsets, IN_ALNUM, lower=True)
                hashes = words.hashes()
                for i in range(a, b):
                    own = hashes[words.first[i - a]:words.first[i - a + 1]]
                    if shard.ids and shard.size + len(own) > how.shard_words:
                        yield shard.results()
                        shard = Shard(how, shard.blocks)
                    shard.add(ids[i], keys[i], own)
        if shard.ids:
            yield shard.results()
    return map_batches(docs.select("doc_id", row_key("doc_id", "text").alias("key"), "text"), run, RESULT)


def kept_documents(docs: DataFrame, benchmark: DataFrame, ws: Scratch, how: Search = Search()) -> DataFrame:
    """Documents that are not contaminated, with all their columns."""
    bad = ws.keep("contaminated", judged(docs, benchmark, how).where("contaminated").select(F.col("key").alias("_key")).distinct())
    return rows_by(docs, row_key("doc_id", "text")).join(bad, "_key", "left_anti").select("_row.*")
