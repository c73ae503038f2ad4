"""Repeated spans of at least ``window`` words, by compaction of a sparse De Bruijn graph.

1. Of every window's k-mers the one with the smallest hash is an anchor, so two equal windows have
   an anchor in common at the same place. Anchors are the nodes that are kept of the graph; the
   words from one anchor to the next, with the next k-mer, are an edge.
2. Nodes found once cannot lie in a repeated window. The others are joined back to their documents;
   edges between neighbouring ones are counted.
3. An edge that is found as often as both its ends does not branch: all sources go the same way
   through it. Paths of such edges are compacted, document by document, through joins with the
   counts; every window inside a compacted path is found as often as the path.
4. Windows that reach over the end of a path are verified by source coordinates: their 128-bit
   hashes are counted over the corpus.
5. Covered words are removed; windows are judged on the input.

Defined cases: a null or empty text has no words and nothing removed. Rows that repeat count as
further places, so all their windows are removed. Null ids are kept. Texts shorter than a window lose
nothing. Columns besides id and text are not read. Key of a row: ``row_key`` of id and text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .kit import Scratch, map_batches, row_key, signed
from .words import IN_WORD, Words, columns, mix, windows


@dataclass(frozen=True)
class Repeats:
    window: int = 35
    kmer: int = 10


def smallest_places(values: np.ndarray, width: int) -> np.ndarray:
    """Place of the leftmost smallest value of each run of ``width`` values, by doubling."""
    best = np.arange(len(values))
    span = 1
    while span < width:
        step = min(span, width - span)
        left, right = best[:len(best) - step], best[step:]
        best = np.where(values[right] < values[left], right, left)
        span += step
    return best


def anchors(hashes: np.ndarray, how: Repeats) -> tuple[np.ndarray, np.ndarray]:
    """Places of a text's anchors, and the hash of each k-mer there."""
    if len(hashes) < how.window:
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.uint64)
    kmers = windows(hashes, how.kmer)
    places = smallest_places(kmers, how.window - how.kmer + 1)
    places = np.unique(places)
    return places, kmers[places]


def texts_of(batches: Iterator[pa.RecordBatch], column: str = "text") -> Iterator[tuple[pa.RecordBatch, int, np.ndarray]]:
    """Batch, row, and word hashes of each text."""
    for batch in batches:
        for a, b, data, offsets in columns(batch, column):
            words = Words(data, offsets, IN_WORD)
            hashes = words.hashes()
            for i in range(a, b):
                yield batch, i, hashes[words.first[i - a]:words.first[i - a + 1]]


class Rows:
    """Gathers arrays of columns and hands them out in pieces."""

    def __init__(self, *names: str, most: int = 100_000):
        self.names, self.most, self.parts, self.size = names, most, [], 0

    def add(self, *arrays) -> bool:
        if len(arrays[0]):
            self.parts.append(arrays)
            self.size += len(arrays[0])
        return self.size >= self.most

    def take(self) -> dict:
        out = {n: np.concatenate([p[i] for p in self.parts]) for i, n in enumerate(self.names)} if self.parts else {n: [] for n in self.names}
        self.parts, self.size = [], 0
        return out


def anchor_rows(docs: DataFrame, how: Repeats) -> DataFrame:
    """key, place and kmer of every anchor."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        rows = Rows("key", "place", "kmer")
        for batch, i, hashes in texts_of(batches):
            places, kmers = anchors(hashes, how)
            if rows.add(np.full(len(places), batch.column(0)[i].as_py()), places, signed(kmers)):
                yield rows.take()
        yield rows.take()
    return map_batches(docs.select("key", "text"), run, "key long, place int, kmer long")


class Spans:
    """Hashes of word spans of one text, in constant time each; two independent ones."""

    def __init__(self, hashes: np.ndarray):
        self.sums, self.inverse = [], []
        for base in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F):
            powers = np.cumprod(np.full(len(hashes) + 1, base, dtype=np.uint64))
            sums = np.zeros(len(hashes) + 1, dtype=np.uint64)
            np.cumsum(hashes * powers[:-1], out=sums[1:])
            self.sums.append(sums)
            self.inverse.append(np.cumprod(np.full(len(hashes) + 1, pow(base, -1, 1 << 64), dtype=np.uint64)))

    def of(self, start: np.ndarray, stop: np.ndarray) -> list[np.ndarray]:
        size = (stop - start).astype(np.uint64)
        return [mix((s[stop] - s[start]) * inv[start] + size) for s, inv in zip(self.sums, self.inverse)]


def packed(df: DataFrame, *values: str) -> DataFrame:
    """One row for each key with its distinct values, as arrays ordered by the first of them; no longer than the key's text."""
    return df.groupBy("key").agg(F.sort_array(F.collect_set(F.struct(*values))).alias("x")).select(
        "key", *(F.col(f"x.{v}").alias(v) for v in values))


def edge_rows(docs: DataFrame, repeated: DataFrame, how: Repeats) -> DataFrame:
    """Edges between neighbouring anchors that are both repeated: key, both places, both node counts, edge hash."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        rows = Rows("key", "place", "next", "n_place", "n_next", "e1", "e2")
        for batch, i, hashes in texts_of(batches):
            places, _ = anchors(hashes, how)
            found, counts = (np.asarray(batch.column(c)[i].as_py(), dtype=np.int64) for c in (2, 3))
            at = np.searchsorted(places, found)
            near = np.flatnonzero(at[1:] == at[:-1] + 1)
            a, b = found[near], found[near + 1]
            e1, e2 = Spans(hashes).of(a, b + how.kmer)
            if rows.add(np.full(len(a), batch.column(0)[i].as_py()), a, b, counts[near], counts[near + 1], signed(e1), signed(e2)):
                yield rows.take()
        yield rows.take()
    own = docs.select("key", "text").join(packed(repeated, "place", "n"), "key")
    return map_batches(own, run, "key long, place int, next int, n_place long, n_next long, e1 long, e2 long")


def paths(edges: DataFrame, how: Repeats) -> DataFrame:
    """Compacted paths of each text: key, first word and word after the last; only those that hold a whole window."""
    counts = edges.groupBy("e1", "e2").agg(F.count(F.lit(1)).alias("n_edge")).where("n_edge > 1")
    inner = edges.join(counts, ["e1", "e2"]).where("n_edge = n_place and n_edge = n_next")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            rows = Rows("key", "first", "after")
            for key, a, b in zip(*(x.to_pylist() for x in batch.columns)):
                a, b = np.array(a), np.array(b)
                opens = np.ones(len(a), dtype=bool)
                opens[1:] = a[1:] != b[:-1]
                first, last = a[opens], b[np.append(opens[1:], True)] + how.kmer
                long = last - first >= how.window
                rows.add(np.full(long.sum(), key), first[long], last[long])
            yield rows.take()
    return map_batches(packed(inner, "place", "next"), run, "key long, first int, after int")


def open_windows(docs: DataFrame, repeated: DataFrame, found: DataFrame, how: Repeats) -> DataFrame:
    """Windows of repeated anchors that no path holds: key, start, 128-bit hash."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        rows = Rows("key", "start", "w1", "w2")
        width = how.window - how.kmer + 1
        for batch, i, hashes in texts_of(batches):
            kmers = windows(hashes, how.kmer)
            starts = np.arange(len(hashes) - how.window + 1)
            anchor = smallest_places(kmers, width)[:len(starts)]
            open_ = np.isin(anchor, np.asarray(batch.column(2)[i].as_py(), dtype=np.int64))
            for a, b in zip(batch.column(3)[i].as_py() or (), batch.column(4)[i].as_py() or ()):
                open_[a:b - how.window + 1] = False
            starts = starts[open_]
            w1, w2 = Spans(hashes).of(starts, starts + how.window)
            if rows.add(np.full(len(starts), batch.column(0)[i].as_py()), starts, signed(w1), signed(w2)):
                yield rows.take()
        yield rows.take()
    own = docs.select("key", "text").join(packed(repeated, "place"), "key").join(packed(found, "first", "after"), "key", "left")
    return map_batches(own, run, "key long, start int, w1 long, w2 long")


def covered(docs: DataFrame, ws: Scratch, how: Repeats = Repeats()) -> DataFrame:
    """Removal spans: key, first word and word after the last, in arrays; spans may overlap."""
    own = docs.select(row_key("doc_id", "text").alias("key"), "text")
    nodes = anchor_rows(own, how)
    counts = nodes.groupBy("kmer").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    repeated = ws.keep("nodes", nodes.join(counts, "kmer").select("key", "place", "n"))
    edges = ws.keep("edges", edge_rows(own, repeated, how))
    inside = ws.keep("paths", paths(edges, how))
    ws.drop("edges")
    left = ws.keep("windows", open_windows(own, repeated, inside, how))
    twice = left.groupBy("w1", "w2").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("w1", "w2")
    spans = inside.union(left.join(twice, ["w1", "w2"]).select("key", F.col("start").alias("first"), (F.col("start") + how.window).alias("after")))
    return packed(spans, "first", "after")


def removed(docs: DataFrame, ws: Scratch, how: Repeats = Repeats()) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 and the kept words joined by blanks, for each row."""
    spans = ws.keep("spans", covered(docs, ws, how))
    ws.drop("nodes", "paths", "windows")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                part = batch.slice(at, 200)
                out: dict[str, list] = {"n_words": [], "n_removed": [], "kept_sha256": [], "kept": []}
                for text, first, after in zip(part.column(1).cast(pa.binary()).to_pylist(), *(part.column(c).to_pylist() for c in (2, 3))):
                    words = (text or b"").split()
                    kept = words
                    if first:
                        edges = np.zeros(len(words) + 1, dtype=np.int32)
                        np.add.at(edges, first, 1)
                        np.add.at(edges, after, -1)
                        kept = [words[i] for i in np.flatnonzero(np.cumsum(edges[:-1]) == 0)]
                    joined = b" ".join(kept)
                    for c, v in zip(out, (len(words), len(words) - len(kept), hashlib.sha256(joined).hexdigest(), joined)):
                        out[c].append(v)
                yield {"doc_id": part.column(0), **out, "kept": pa.array(out["kept"], pa.binary()).cast(pa.string())}
    rows = docs.select("doc_id", "text", row_key("doc_id", "text").alias("key")).join(spans, "key", "left").select("doc_id", "text", "first", "after")
    return map_batches(rows, run, "doc_id long, n_words long, n_removed long, kept_sha256 string, kept string")
