"""Exact n-gram Jaccard join with a prefix tree.

1. Every whole text becomes a set of n-gram hashes; equal sets are one class from here on.
2. Hash space is cut into more ranges than two similar sets can differ in elements, so many that they
   agree on a whole range which is not empty. A passage that many texts share can fill a range alone; so sets that share
   the digest of a range join a family only if their parity sketches allow it: each element flips one
   of 512 bits, for large sets also one of 4 096, so similar sets differ in no more bits than elements.
   Families that are large all the same are cut again by fresh ranges, under another hash, as long as
   that makes them smaller.
   Similar sets pass all these tests and are never parted.
3. In each family the ordered sets, rarest n-gram first, are stored in a prefix tree. A probe walks
   the tree once for all sets that share a beginning, carrying the overlap so far, and leaves a
   subtree when the elements left on either side cannot reach the threshold. Pairs already joined
   are not looked at again, so a family gives at most one link for each set.
   A family of more than ``block`` sets is cut into blocks; each pair of blocks is a task of its own.
4. Links become components.

Defined cases: null or empty texts have an empty set and link with nothing; a text with fewer than n
words is one n-gram. Repeated rows are equal sets. Rows that share an id are one document. A row
without an id takes the component of an equal set, or null, and adds no links. Columns besides id
and text are not read.
"""

from __future__ import annotations

from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cache
from math import exp, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import links
from .kit import Scratch, map_batches, rows_by, signed
from .words import IN_WORD, Words, columns, mix, windows


SHORT_BITS, LONG_BITS = 512, 4096   # of the sketches
LARGE_SET = 700                     # elements from which a set has the long sketch too


@dataclass(frozen=True)
class Similarity:
    """Two sets link when 100 * intersection >= percent * union."""
    n: int = 4
    percent: int = 85
    block: int = 2_000
    large: int = 1_000   # families of more sets are cut again

    def need(self, a: int, b: int) -> int:
        """The least intersection of linked sets of sizes a and b."""
        return -(-self.percent * (a + b) // (100 + self.percent))

    def most_different(self, a: int, b: int) -> int:
        """The largest symmetric difference of linked sets."""
        return a + b - 2 * self.need(a, b)


def gram_sets(words: Words, n: int, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct n-gram hashes of each text, one text after the other, and the bounds of the texts."""
    hashes = words.hashes() if not seed else mix(words.hashes() ^ np.uint64(seed * 0x2545F4914F6CDD1D & (1 << 64) - 1))
    all_windows = windows(hashes, n)
    parts, sizes = [], []
    for a, b in zip(words.first.tolist(), words.first[1:].tolist()):
        if b - a >= n:
            own = np.sort(all_windows[a:b - n + 1])
            own = own[np.concatenate(([True], own[1:] != own[:-1]))]
        else:
            own = windows(hashes[a:b], b - a, seed=11 + b - a) if b > a else hashes[:0]
        parts.append(own)
        sizes.append(len(own))
    return np.concatenate(parts) if parts else hashes[:0], np.concatenate(([0], np.cumsum(sizes))).astype(np.int64)


def size_bounds(most: int) -> np.ndarray:
    """Sizes at which size classes begin; each class is at most half as wide again as the one before."""
    out = [1]
    while out[-1] <= most:
        out.append(max(out[-1] + 1, out[-1] * 3 // 2))
    return np.array(out, dtype=np.int64)


@cache
def range_count(least: int, most: int) -> int:
    """The fewest ranges of which a set of ``least`` elements or more fills more than ``most``, but for odd cases.

    Similar sets differ in at most ``most`` ranges, so one that both fill is left to agree on.
    """
    def filled(k: int) -> float:
        none = exp(-least / k)
        return k - k * none - 3 * sqrt(k * none * (1 - (1 + least / k) * none))
    low, high = most + 2 + most // 24, max(2 * least, 2 * most + 4)
    while low < high:
        middle = (low + high) // 2
        low, high = (low, middle) if filled(middle) > most else (middle + 1, high)
    return low


def range_digests(values: np.ndarray, bounds: np.ndarray, how: Similarity) -> tuple[np.ndarray, np.ndarray]:
    """Text number and digest of every range that a text fills, or of every range if it fills too few."""
    size = np.diff(bounds)
    steps = size_bounds(int(size.max(initial=1)) * 200 // how.percent + 2)
    own = np.searchsorted(steps, size, side="right") - 1
    reach = np.searchsorted(steps, size * 100 // how.percent, side="right") - 1
    texts, digests = [], []
    # a set meets larger ones of the next class under that class's ranges
    for chosen, level in ((np.flatnonzero(size > 0), own), (np.flatnonzero((size > 0) & (reach > own)), own + 1)):
        top = steps[level[chosen] + 1] - 1
        most = top * 2 * (100 - how.percent) // (100 + how.percent)
        least = steps[level[chosen]] * how.percent // 100  # the smallest set that meets this class
        ranges = np.array([range_count(a, b) for a, b in zip(least.tolist(), most.tolist())], dtype=np.int64)
        some = most > 0  # else linked sets are equal
        chosen, most, ranges = chosen[some], most[some], ranges[some]
        if not len(chosen):
            continue
        counts = size[chosen]
        heads = np.cumsum(counts) - counts
        at = np.arange(counts.sum()) - np.repeat(heads, counts) + np.repeat(bounds[chosen], counts)
        own_values, of = values[at], np.repeat(np.arange(len(chosen)), counts)
        k = ranges.astype(np.uint64)
        part = ((own_values >> np.uint64(32)) * k[of]) >> np.uint64(32)
        opens = np.ones(len(part), dtype=bool)
        opens[1:] = (of[1:] != of[:-1]) | (part[1:] != part[:-1])
        first = np.flatnonzero(opens)
        sums = np.add.reduceat(mix(own_values + np.uint64(0x51)), first)
        texts.append(chosen[of[first]])
        digests.append(mix(sums + part[first] * np.uint64(0xC2B2AE3D27D4EB4F) + k[of[first]] * np.uint64(0x165667B19E3779F9)))
        filled = np.bincount(of[first], minlength=len(chosen))
        for i in np.flatnonzero(filled <= most):  # too few filled ranges: the empty ones may be all that agrees
            empty = np.setdiff1d(np.arange(ranges[i], dtype=np.uint64), part[first][of[first] == i])
            texts.append(np.full(len(empty), chosen[i]))
            digests.append(mix(empty * np.uint64(0xC2B2AE3D27D4EB4F) + k[i:i + 1] * np.uint64(0x165667B19E3779F9)))
    if not texts:
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.uint64)
    return np.concatenate(texts), np.concatenate(digests)


def sketches(values: np.ndarray, bounds: np.ndarray, bits: int) -> np.ndarray:
    """Parity bits of each set: |difference of two sets| is at least the number of bits that differ."""
    n = len(bounds) - 1
    of = np.repeat(np.arange(n), np.diff(bounds))
    flips = np.bincount(of * bits + (values & np.uint64(bits - 1)).astype(np.int64), minlength=bits * n)
    return np.packbits((flips & 1).astype(np.uint8)).reshape(n, bits // 8)


def all_sketches(values: np.ndarray, bounds: np.ndarray) -> list[bytes]:
    """512 bits of each set, followed by 4 096 more if it is large: few bits say nothing about many differences."""
    out = [x.tobytes() for x in sketches(values, bounds, SHORT_BITS)]
    for i in np.flatnonzero(np.diff(bounds) >= LARGE_SET):
        out[i] += sketches(values[bounds[i]:bounds[i + 1]], np.array([0, bounds[i + 1] - bounds[i]]), LONG_BITS).tobytes()
    return out


def measured(docs: DataFrame, how: Similarity) -> DataFrame:
    """doc_id, n_shingles, a 128-bit digest of the set, its sketch, and the digests of its ranges (packed 64-bit numbers)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            for a, b, data, offsets in columns(batch, "text"):
                values, bounds = gram_sets(Words(data, offsets, IN_WORD, lower=True), how.n)
                padded = np.append(values, np.uint64(0))
                size = np.diff(bounds)

                def total(x: np.ndarray) -> np.ndarray:
                    sums = np.add.reduceat(x, np.minimum(bounds[:-1], len(values)))
                    return np.where(size > 0, sums, np.uint64(0))
                texts, digests = range_digests(values, bounds, how)
                digests = digests[np.argsort(texts, kind="stable")]
                cuts = np.concatenate(([0], np.cumsum(np.bincount(texts, minlength=b - a)))).tolist()
                yield {"doc_id": batch.column(0).slice(a, b - a), "n_shingles": size, "d1": signed(total(mix(padded))),
                       "d2": signed(total(mix(padded ^ np.uint64(0x9E3779B97F4A7C15)))), "sketch": all_sketches(values, bounds),
                       "ranges": [digests[x:y].tobytes() for x, y in zip(cuts, cuts[1:])]}
    return map_batches(docs.select("doc_id", "text"), run, "doc_id long, n_shingles long, d1 long, d2 long, sketch binary, ranges binary")


def shared_digests(rows: DataFrame) -> DataFrame:
    """The rows (digest, node) whose digest another node has too."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        held = None  # the last row, which the next batch decides on, and whether the one before it has its digest
        for batch in batches:
            digest, node = (batch.column(i).to_numpy() for i in (0, 1))
            pair = False
            if held is not None:
                digest, node, pair = np.append(held[0], digest), np.append(held[1], node), held[2]
            fresh = np.concatenate(([True], (digest[1:] != digest[:-1]) | (node[1:] != node[:-1])))  # rows that repeat count once
            digest, node = digest[fresh], node[fresh]
            same = digest[1:] == digest[:-1]
            alike = np.append(same, False) | np.concatenate(([pair], same))
            held = (digest[-1:], node[-1:], bool(alike[-1]))
            yield {"digest": digest[:-1][alike[:-1]], "node": node[:-1][alike[:-1]]}
        if held is not None and held[2]:
            yield {"digest": held[0], "node": held[1]}
    return map_batches(rows.repartition("digest").sortWithinPartitions("digest", "node"), run, "digest long, node long")


class Meeting:
    """Joins nodes that may be similar; rows come in order of digests."""

    def __init__(self, how: Similarity, most: int = 50_000):
        self.how, self.most, self.parent = how, most, {}

    def find(self, i: int) -> int:
        parent = self.parent
        while (up := parent.setdefault(i, i)) != i:
            parent[i] = i = parent[up]
        return i

    def join(self, pairs) -> None:
        for a, b in pairs:
            x, y = self.find(a), self.find(b)
            self.parent[max(x, y)] = min(x, y)

    def allowed(self, n: np.ndarray, bits: np.ndarray, m: np.ndarray, others: np.ndarray) -> np.ndarray:
        p = self.how.percent
        most = n + m - 2 * -(-p * (n + m) // (100 + p))
        short = SHORT_BITS // 64
        good = (np.bitwise_count(bits[..., :short] ^ others[..., :short]).sum(axis=-1, dtype=np.int64) <= most) & (100 * np.minimum(n, m) >= p * np.maximum(n, m))
        both = np.flatnonzero(good & (np.minimum(n, m) >= LARGE_SET))
        bits = np.broadcast_to(bits, others.shape)
        for at in np.array_split(both, len(both) // 4096 + 1):
            good[at] = np.bitwise_count(bits[at, short:] ^ others[at, short:]).sum(axis=-1, dtype=np.int64) <= most[at]
        return good

    def groups(self, digest: np.ndarray, node: np.ndarray, n: np.ndarray, bits: np.ndarray) -> None:
        first = np.flatnonzero(np.concatenate(([True], digest[1:] != digest[:-1])))
        counts = np.diff(np.append(first, len(digest)))
        lead = np.repeat(first, counts)
        good = self.allowed(n, bits, n[lead], bits[lead])
        pairs = np.unique(np.stack((node[lead], node))[:, good & (node != node[lead])], axis=1)
        self.join(pairs.T.tolist())
        # those that their leader does not allow may still go with others of the group
        for g in np.flatnonzero(np.add.reduceat(~good, first)):
            at = slice(first[g], first[g] + counts[g])
            if counts[g] > 2:
                self.within(node[at], n[at], bits[at])

    def within(self, node: np.ndarray, n: np.ndarray, bits: np.ndarray) -> None:
        if len(node) > self.most:  # too many to compare here: no test is always safe
            self.join((int(node[0]), x) for x in node[1:].tolist())
            return
        roots = np.array([self.find(x) for x in node.tolist()])
        kinds, sizes = np.unique(roots, return_counts=True)
        for i in np.flatnonzero(roots != kinds[sizes.argmax()]) if len(kinds) > 1 else ():
            apart = np.flatnonzero(roots != roots[i])
            apart = apart[self.allowed(n[i], bits[i], n[apart], bits[apart])]
            if len(apart):
                self.join((int(node[i]), x) for x in node[apart].tolist())
                met = np.isin(roots, np.append(roots[apart], roots[i]))
                roots[met] = roots[met].min()

    def edges(self) -> Iterator[dict]:
        nodes = list(self.parent)
        for at in range(0, len(nodes), 50_000):
            part = [(self.find(i), i) for i in nodes[at:at + 50_000]]
            yield {"a": [a for a, b in part if a != b], "b": [b for a, b in part if a != b]}


def meetings(rows: DataFrame, classes: DataFrame, how: Similarity) -> DataFrame:
    """Edges (a, b) that connect all nodes which have a digest in common and may be similar.

    rows: digest, node, each digest at least twice; classes: node, n_shingles, sketch. A task hands out
    one edge for each node that it joins with others, so the edge table is short and flat.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        meeting, held = Meeting(how), None  # rows of the digest that the next batch may go on with
        for batch in batches:
            own = [batch.column(i).to_numpy() for i in (0, 1, 2)]
            full = (SHORT_BITS + LONG_BITS) // 8
            own.append(np.frombuffer(b"".join(x.ljust(full, b"\x00") for x in batch.column(3).to_pylist()), dtype=np.uint64).reshape(-1, full // 8))
            if held is not None:
                own = [np.concatenate(x) for x in zip(held, own)]
            cut = np.searchsorted(own[0], own[0][-1])
            if cut:
                meeting.groups(*(x[:cut] for x in own))
            held = [x[cut:] for x in own]
            if len(held[0]) > meeting.most:  # a group of this size is joined untested: its first row stands for it
                meeting.join((int(held[1][0]), x) for x in held[1][1:].tolist())
                held = [x[:1] for x in held]
        if held is not None:
            meeting.groups(*held)
        yield from meeting.edges()
    known = rows.join(classes.select("node", "n_shingles", "sketch").dropDuplicates(["node"]), "node").select("digest", "node", "n_shingles", "sketch")
    return map_batches(known.repartition("digest").sortWithinPartitions("digest", "node"), run, "a long, b long")


def families(classes: DataFrame, ws: Scratch, how: Similarity) -> DataFrame:
    """(node, root) of the sets that may be similar to another, over any number of steps."""
    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                packed = [x or b"" for x in part.column(1).to_pylist()]
                yield {"digest": np.frombuffer(b"".join(packed), dtype=np.int64),
                       "node": np.repeat(part.column(0).to_numpy(), [len(x) // 8 for x in packed])}
    shared = ws.keep("shared", shared_digests(map_batches(classes.select("node", "ranges"), unpack, "digest long, node long")))
    return links.components(ws.keep("meetings", meetings(shared, classes, how)), ws, "families")


def refined(members: DataFrame, texts: DataFrame, classes: DataFrame, ws: Scratch, how: Similarity) -> DataFrame:
    """Families after large ones have been cut by ranges under other hashes; who has no partner left drops out."""
    def fresh(seed: int):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
            for batch in batches:
                for a, b, data, offsets in columns(batch, "text"):
                    values, bounds = gram_sets(Words(data, offsets, IN_WORD, lower=True), how.n, seed)
                    of, digests = range_digests(values, bounds, how)
                    yield {"digest": signed(digests), "node": batch.column(0).slice(a, b - a).to_numpy()[of], "root": batch.column(1).slice(a, b - a).to_numpy()[of]}
        return run
    before, turn = None, 0
    while True:
        size = members.groupBy("root").agg(F.count(F.lit(1)).alias("size")).where(F.col("size") > how.large).select("root")
        large = ws.keep(f"large-{turn}", members.join(size, "root", "left_semi").select("node", "root"))
        count = large.count()
        if not count or before is not None and count > 0.9 * before:
            return members
        before, turn = count, turn + 1
        rows = map_batches(texts.join(large, "node").select("node", "root", "text"), fresh(turn), "digest long, node long, root long")
        shared = shared_digests(rows.select(F.xxhash64("digest", "root").alias("digest"), "node"))
        cut = links.components(meetings(shared, classes, how), ws, f"cut-{turn}")
        small = members.join(large.select("node"), "node", "left_anti").select("node", "root")
        members = ws.keep(f"members-{turn}", small.union(cut.select("node", "root")))


@dataclass
class Tree:
    """A compressed prefix tree: an edge holds a run of n-gram ranks."""
    run: tuple[int, ...] = ()
    members: frozenset = frozenset()
    below: dict[int, "Tree"] = field(default_factory=dict)
    ends: list[int] = field(default_factory=list)   # sets that end here
    shortest: int = 1 << 62
    longest: int = 0

    def insert(self, ranks: list[int], name: int) -> None:
        node, at = self, 0
        while True:
            node.shortest, node.longest = min(node.shortest, len(ranks)), max(node.longest, len(ranks))
            if at == len(ranks):
                node.ends.append(name)
                return
            child = node.below.get(ranks[at])
            if child is None:
                tail = tuple(ranks[at:])
                node.below[ranks[at]] = Tree(tail, frozenset(tail), {}, [name], len(ranks), len(ranks))
                return
            same = 0
            for x, y in zip(child.run, ranks[at:at + len(child.run)]):
                if x != y:
                    break
                same += 1
            if same < len(child.run):
                head, tail = child.run[:same], child.run[same:]
                upper = Tree(head, frozenset(head), {tail[0]: child}, [], child.shortest, child.longest)
                child.run, child.members = tail, frozenset(tail)
                node.below[head[0]] = child = upper
            node, at = child, at + same


class Joined:
    """Which sets are joined already."""

    def __init__(self, n: int):
        self.parent = list(range(n))

    def links(self) -> list[tuple[int, int]]:
        """One from the first set of each group to each other one."""
        return [(self.find(i), i) for i in range(len(self.parent)) if self.find(i) != i]

    def find(self, i: int) -> int:
        while self.parent[i] != i:
            self.parent[i] = i = self.parent[self.parent[i]]
        return i

    def join(self, i: int, j: int) -> None:
        a, b = self.find(i), self.find(j)
        if a != b:
            self.parent[max(a, b)] = min(a, b)


def probe(tree: Tree, ranks: list[int], name: int, joined: Joined, how: Similarity) -> None:
    """Joins set ``name`` with every similar set in the tree that it is not joined with yet."""
    own, n = frozenset(ranks), len(ranks)
    walk = [(child, 0, 0) for child in tree.below.values()]
    while walk:
        node, depth, overlap = walk.pop()
        if how.need(n, node.shortest) > min(n, node.shortest) and node.shortest >= n:
            continue  # all sets below are too long
        if node.longest < n and how.need(n, node.longest) > node.longest:
            continue  # all are too short
        overlap += len(own & node.members)
        depth += len(node.run)
        if node.below:
            left = n - bisect_right(ranks, node.run[-1])
            if overlap + min(node.longest - depth, left) < how.need(n, node.shortest) or overlap + node.longest - depth < how.need(n, node.longest):
                continue
            walk.extend((child, depth, overlap) for child in node.below.values())
        if node.ends and overlap >= how.need(n, depth):
            for other in node.ends:
                joined.join(other, name)


def tree_links(sets: list[np.ndarray], how: Similarity, first: int = 0) -> list[tuple[int, int]]:
    """Links that join all similar sets. With ``first``, only pairs of one set before it and one from it on are looked at."""
    values, ranks = np.unique(np.concatenate(sets), return_inverse=True)
    order = np.lexsort((values, np.bincount(ranks)))  # rarest first
    place = np.empty(len(order), dtype=np.int64)
    place[order] = np.arange(len(order))
    ranks = place[ranks]
    tree, joined, at = Tree(), Joined(len(sets)), 0
    for i, s in enumerate(sets):
        own = np.sort(ranks[at:at + len(s)]).tolist()
        at += len(s)
        if i >= first:
            probe(tree, own, i, joined, how)
        if not first or i < first:
            tree.insert(own, i)
    return joined.links()


def family_links(texts: DataFrame, how: Similarity) -> DataFrame:
    """Links (a, b) of each cell; rows: cell (a pair of blocks of one family), side (0 or 1), node, text; sorted by cell and side."""
    def flush(nodes: list[int], sides: list[int], raw: list[bytes]) -> dict:
        offsets = np.concatenate(([0], np.cumsum([len(x) for x in raw]))).astype(np.int64)
        values, bounds = gram_sets(Words(np.frombuffer(b"".join(raw), dtype=np.uint8), offsets, IN_WORD, lower=True), how.n)
        found = tree_links([values[a:b] for a, b in zip(bounds, bounds[1:])], how, sides.count(0) if 1 in sides else 0)
        return {"a": [nodes[i] for i, _ in found], "b": [nodes[j] for _, j in found]}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        cell, nodes, sides, raw = None, [], [], []
        for batch in batches:
            for c, side, node, text in zip(*(x.to_pylist() for x in batch.columns[:3]), batch.column(3).cast(pa.binary()).to_pylist()):
                if c != cell:
                    if len(nodes) > 1:
                        yield flush(nodes, sides, raw)
                    cell, nodes, sides, raw = c, [], [], []
                nodes.append(node)
                sides.append(side)
                raw.append(text or b"")
        if len(nodes) > 1:
            yield flush(nodes, sides, raw)
    # A number of partitions keeps adaptive execution from putting many cells, small in bytes but not in work, into one task.
    tasks = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = texts.select("cell", "side", "node", "text").repartition(tasks, "cell").sortWithinPartitions("cell", "side", "node")
    return map_batches(dealt, run, "a long, b long")


def cells(members: DataFrame, how: Similarity) -> DataFrame:
    """(node, cell, side): one cell for a family of up to ``block`` sets, else one for each pair of its blocks."""
    sizes = members.groupBy("root").agg(F.ceil(F.count(F.lit(1)) / how.block).cast("int").alias("blocks"))
    rows = members.join(sizes, "root").withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return rows.select("node", F.xxhash64("root", F.least("own", "other"), F.greatest("own", "other")).alias("cell"),
                       (F.col("own") > F.col("other")).cast("int").alias("side"))


def grouped(docs: DataFrame, ws: Scratch, how: Similarity = Similarity()) -> DataFrame:
    """doc_id, n_shingles and component_id for each row."""
    docs = docs.select("doc_id", "text")
    rows = ws.keep("sets", measured(docs, how))
    classes = ws.keep("classes", rows.where("n_shingles > 0").groupBy("d1", "d2").agg(F.min("doc_id").alias("node")).where("node is not null"))
    first = rows.join(classes, ["d1", "d2"]).where("doc_id = node").select("node", "n_shingles", "sketch", "ranges")
    members = ws.keep("members", families(first, ws, how))
    texts = ws.keep("texts", docs.join(members, F.col("doc_id") == F.col("node")).select("node", "text"))
    members = refined(members, texts, first, ws, how)
    texts = texts.join(cells(members, how), "node")
    roots = links.components(ws.keep("links", family_links(texts, how)), ws, "joined")
    return (rows.select("doc_id", "n_shingles", "d1", "d2").join(classes, ["d1", "d2"], "left").join(roots, "node", "left")
            .select("doc_id", "n_shingles", F.coalesce("root", "node", "doc_id").alias("component_id")))


def representatives(docs: DataFrame, ws: Scratch, how: Similarity = Similarity()) -> DataFrame:
    """The rows of ``docs``, with all their columns, that lead their component; rows with empty sets, and without any
    id in reach, stay. Of rows that repeat a leading id and text, all stay."""
    found = grouped(docs, ws, how).where("component_id is not null and not (component_id <=> doc_id)").where("doc_id is not null").select(F.col("doc_id").alias("_key")).distinct()
    gone = ws.keep("gone", found)
    return rows_by(docs, F.col("doc_id")).join(gone, "_key", "left_anti").select("_row.*")
