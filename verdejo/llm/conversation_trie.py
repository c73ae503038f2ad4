"""The prefix trie of rebuilt conversations, found by peeling turns off from the deepest ones.

A conversation c takes the first h original turns of conversation c - c % 20 and its own turns after its first h,
h being the CRC-32 of its decimal id modulo 4. Each distinct sequence of first d turns is a node of depth d.

Texts do not travel. A turn becomes a 128-bit digest of role and text and a count of words where it is read; a
rebuilt conversation becomes a chain of 128-bit keys, each the digest of the key before and of the turn, so that one
key stands for a whole prefix. Chains are stored in segments of ``SPAN`` depths. Conversations that are equal
throughout meet first: their ids become one count, one smallest id and one digest, streamed in order of id through
blocks of bounded size. From then on one conversation stands for all its copies.

Peeling goes from the deepest segment up. At a depth, nodes that survived from the depth below and conversations that
end here are grouped by key; that group is a node, and its sums are final, because all that lies below it has been
merged. Its last turn is stripped, the key before names its parent, and the next depth is grouped. So nodes are found
and summed in one pass, and a depth costs a partial aggregate over its own nodes alone: a first turn that a third of
all conversations share is one key that is summed on the map side. A survivor carries one segment, not its chain; at
a segment's end it joins the next one by the id of its smallest member. Segments that few conversations reach
(``Peeling.together``) are peeled in tasks, all depths in one job; both ways give the same nodes.

Nulls: turns are ordered by turn, null first, repeated turn numbers by digest; null roles and texts are empty. Rows
without conv_id belong to no conversation. ``%`` keeps the sign of c, so -7 looks to conversation 0. A conversation
without turns (its own are replaced by those of an absent one) ends at the root. No conversation, no node: an empty
table has an empty result. Extra columns are not read. The digests of one conversation (24 bytes a turn) have to fit
into a task, and a job is run for each depth of a segment that is widely reached, so depth is assumed to stay in the
thousands.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .kit import Scratch, map_batches

#: Every conversation of such a run of ids looks to its first for its opening turns.
RUN = 20
#: Opening turns number less than this.
OPENINGS = 4
WORDS = r"[^ \t-\r]+"

#: Depths in one stored segment of a chain.
SPAN = 16
#: Ids in one block of a list that is digested.
BLOCK = 8192

ROOT = b"\x00" * 16
EMPTY = hashlib.sha256(b"").hexdigest()


@dataclass(frozen=True)
class Peeling:
    """Segments that at most this many different conversations reach are peeled within tasks."""

    together: int = 4096


def _turns(rows: DataFrame) -> DataFrame:
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    whole = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    return rows.where("conv_id is not null").select(
        "conv_id", F.col("turn").isNotNull().alias("numbered"), "turn", F.substring(F.unhex(F.sha2(whole, 256)), 1, 16).alias("digest"),
        F.regexp_count(text, F.lit(WORDS)).cast("long").alias("words"))


def rebuilt(rows: DataFrame) -> DataFrame:
    """``(conv_id, digests, words)`` of every conversation of ``rows(conv_id, turn, role, text)`` after its opening was exchanged."""
    own = _turns(rows).groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("numbered", "turn", "digest", "words"))).alias("own"))
    heads = own.where(f"conv_id % {RUN} = 0").select(F.col("conv_id").alias("base"), F.slice("own", 1, OPENINGS - 1).alias("head"))
    h = (F.crc32(F.col("conv_id").cast("string")) % OPENINGS).cast("int")
    turns = F.concat(F.coalesce(F.slice(F.col("head"), F.lit(1), h), F.slice("own", 1, 0)), F.slice(F.col("own"), h + 1, F.size("own")))
    # At most RUN conversations look to one base, so no key of this join is hot.
    return own.join(heads, F.expr(f"conv_id - conv_id % {RUN}") == F.col("base"), "left").select("conv_id", turns.alias("t")).select(
        "conv_id", F.col("t.digest").alias("digests"), F.col("t.words").alias("words"))


SEGMENT = "conv_id long, depth int, segment int, keys array<binary>, words array<long>"


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """Chains in pieces: the keys of depths low to high of a segment, and the words of the turns above low."""
    out: dict = {c: [] for c in ("conv_id", "depth", "segment", "keys", "words")}
    for batch in batches:
        for conv_id, digests, words in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "digests", "words"))):
            chain = [ROOT]
            for d in digests:
                chain.append(hashlib.blake2b(chain[-1] + d, digest_size=16).digest())
            for low in range(0, max(len(digests), 1), SPAN):
                for c, value in (("conv_id", conv_id), ("depth", len(digests)), ("segment", low // SPAN),
                                 ("keys", chain[low:low + SPAN + 1]), ("words", words[low:low + SPAN])):
                    out[c].append(value)
        yield out
        out = {c: [] for c in out}


def _gathered(rows: Iterator[tuple[int, dict]]) -> Iterator[dict]:
    """Columns of many rows at a time; the number beside a row says how many ids it holds."""
    out: dict = {}
    held = 0
    for ids, row in rows:
        for c, value in row.items():
            out.setdefault(c, []).append(value)
        held += ids
        if held >= BLOCK:
            yield out
            out, held = {}, 0
    if out:
        yield out


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """Runs of one end in ordered rows, cut into blocks: the ids as text, the first one and their number."""
    def rows() -> Iterator[tuple[int, dict]]:
        now, ids = None, []

        def block() -> tuple[int, dict]:
            return len(ids), {"depth": now[0], "key": now[1], "first": ids[0], "n": len(ids), "ids": ",".join(map(str, ids))}

        for batch in batches:
            for depth, key, conv_id in zip(*(batch.column(c).to_pylist() for c in ("depth", "key", "conv_id"))):
                if now != (depth, key) or len(ids) == BLOCK:
                    if ids:
                        yield block()
                    now, ids = (depth, key), []
                ids.append(conv_id)
        if ids:
            yield block()
    return _gathered(rows())


def _ends(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """One row for each end of ordered blocks; only the digest's state is held between them."""
    def rows() -> Iterator[tuple[int, dict]]:
        now, state, first, n = None, None, None, 0
        for batch in batches:
            for depth, key, least, count, ids in zip(*(batch.column(c).to_pylist() for c in ("depth", "key", "first", "n", "ids"))):
                if now != (depth, key):
                    if state:
                        yield 1, {"depth": now[0], "conv_id": first, "n": n, "sha": state.hexdigest()}
                    now, state, first, n = (depth, key), hashlib.sha256(), least, 0
                else:
                    state.update(b",")
                state.update(ids.encode())
                n += count
        if state:
            yield 1, {"depth": now[0], "conv_id": first, "n": n, "sha": state.hexdigest()}
    return _gathered(rows())


def ended(segments: DataFrame, ws: Scratch) -> DataFrame:
    """``(depth, conv_id, n, sha)`` for every different conversation: its smallest id, its copies and the digest of their ids."""
    last = segments.where(F.expr(f"segment = greatest(depth - 1, 0) div {SPAN}"))
    ids = last.select("depth", F.element_at("keys", -1).alias("key"), "conv_id")
    # An end's ids may spread over many partitions; each makes blocks of its own, and blocks are few.
    ordered = ids.repartitionByRange("depth", "key", "conv_id").sortWithinPartitions("depth", "key", "conv_id")
    blocks = ws.keep("blocks", map_batches(ordered, _blocks, "depth int, key binary, first long, n long, ids string"))
    return map_batches(blocks.repartition("depth", "key").sortWithinPartitions("depth", "key", "first"), _ends,
                       "depth int, conv_id long, n long, sha string")


#: What peeling hands on: a node or the conversations that end at it. ``chain`` is the piece of the segment up to this depth.
SUMS = ("n_convs", "n_children", "n_leaves", "saved_tokens")
NODE = "depth int, key binary, parent binary, conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"
RESULT = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"


def _level(rows: DataFrame, depth: int, low: int) -> DataFrame:
    """Nodes of one depth from the rows that meet there."""
    words = F.element_at("words", depth - low) if depth > low else F.lit(0)
    merged = rows.groupBy("key").agg(
        F.min("conv_id").alias("conv_id"), *(F.sum(c).alias(c) for c in SUMS), F.max("ends_sha256").alias("ends_sha256"),
        F.min_by(F.struct("keys", "words"), "conv_id").alias("chain"))
    leaf = F.when(F.col("n_children") == 0, 1).otherwise(F.col("n_leaves"))
    return merged.select("*", "chain.*").select(
        F.lit(depth).alias("depth"), "key", (F.element_at("keys", depth - low) if depth > low else F.lit(None).cast("binary")).alias("parent"),
        "conv_id", "n_convs", "n_children", leaf.alias("n_leaves"),
        (F.col("saved_tokens") + (F.col("n_convs") - 1) * words).alias("saved_tokens"), F.coalesce("ends_sha256", F.lit(EMPTY)).alias("ends_sha256"),
        "keys", "words")


def _stripped(nodes: DataFrame, *chain: str) -> DataFrame:
    """Survivors at the depth above: nodes without their last turn."""
    return nodes.select(F.col("parent").alias("key"), "conv_id", "n_convs", F.lit(1).cast("long").alias("n_children"), "n_leaves", "saved_tokens",
                        F.lit(None).cast("string").alias("ends_sha256"), *chain)


def _fresh(ends: DataFrame) -> DataFrame:
    """Conversations at the depth where they end."""
    zero = F.lit(0).cast("long")
    return ends.select(F.element_at("keys", -1).alias("key"), "conv_id", F.col("n").alias("n_convs"), zero.alias("n_children"), zero.alias("n_leaves"),
                       zero.alias("saved_tokens"), F.col("sha").alias("ends_sha256"), "keys", "words")


def _peel(batches: Iterator[pa.RecordBatch], low: int, high: int) -> Iterator[dict]:
    """All depths of a segment above ``low``, for rows whose subtrees are complete."""
    waiting: dict[int, dict[bytes, list]] = {d: {} for d in range(low, high + 1)}

    def meet(depth: int, key: bytes, conv_id: int, n: int, children: int, leaves: int, saved: int, sha: str | None, keys: list, words: list) -> None:
        node = waiting[depth].setdefault(key, [conv_id, 0, 0, 0, 0, None, keys, words])
        if conv_id < node[0]:
            node[0], node[6], node[7] = conv_id, keys, words
        for i, more in enumerate((n, children, leaves, saved)):
            node[i + 1] += more
        node[5] = sha or node[5]

    for batch in batches:
        for row in batch.to_pylist():
            meet(row["at"], row["key"], row["conv_id"], *(row[c] for c in SUMS), row["ends_sha256"], row["keys"], row["words"])
    for depth in range(high, low, -1):
        out: dict = {c.split()[0]: [] for c in NODE.split(", ")}
        for key, (conv_id, n, children, leaves, saved, sha, keys, words) in waiting.pop(depth).items():
            leaves, saved, parent = leaves if children else 1, saved + (n - 1) * words[depth - low - 1], keys[depth - low - 1]
            for c, value in zip(out, (depth, key, parent, conv_id, n, children, leaves, saved, sha or EMPTY)):
                out[c].append(value)
            if depth - 1 > low:
                meet(depth - 1, parent, conv_id, n, 1, leaves, saved, None, keys, words)
        if out["depth"]:
            yield out


def trie(rows: DataFrame, ws: Scratch, how: Peeling = Peeling()) -> DataFrame:
    """A row for every node; see the module's docstring."""
    segments = ws.keep("segments", map_batches(rebuilt(rows), _segments, SEGMENT))
    ends = ws.keep("ends", ended(segments, ws))
    path = f"{ws.root}/chains"
    own = ends.select(F.col("depth").alias("d"), F.col("conv_id").alias("c"), "n", "sha")
    # One conversation for all its copies; each segment is a folder, so a depth reads no other.
    segments.join(own, (F.col("conv_id") == F.col("c")) & (F.col("depth") == F.col("d"))).drop("c", "d").write.partitionBy("segment").parquet(path)
    chains = ws.spark.read.schema("conv_id long, depth int, keys array<binary>, words array<long>, n long, sha string, segment int").parquet(path)
    reach = {r.segment: r for r in chains.groupBy("segment").agg(F.count(F.lit(1)).alias("rows"), F.max("depth").alias("depth")).collect()}
    found: list[DataFrame] = []
    below: DataFrame | None = None  # the lowest nodes of the segment beneath
    for segment in sorted(reach, reverse=True):  # one number for each SPAN turns of the longest conversation
        low, part = segment * SPAN, chains.where(F.col("segment") == segment)
        high = min(reach[segment].depth, low + SPAN)
        survivors = None
        if below is not None:
            survivors = _stripped(below).join(part.select("conv_id", "keys", "words"), "conv_id")
        if reach[segment].rows <= how.together:
            meeting = _fresh(part.where(F.col("depth").between(low + 1, high))).withColumn("at", F.lit(low) + F.size("words"))
            if survivors is not None:
                meeting = meeting.unionByName(survivors.withColumn("at", F.lit(high)))
            nodes = map_batches(meeting.repartition(F.col("keys")[0]), lambda batches, a=low, b=high: _peel(batches, a, b), NODE)
            below = ws.keep(f"nodes-{segment}", nodes)
            found.append(below)
            below = below.where(F.col("depth") == low + 1)
        else:
            for depth in range(high, low, -1):
                meeting = _fresh(part.where(F.col("depth") == depth))
                if survivors is not None:
                    meeting = meeting.unionByName(survivors)
                below = ws.keep(f"nodes-{segment}-{depth}", _level(meeting, depth, low))
                found.append(below)
                survivors = _stripped(below, "keys", "words")
    if not reach:
        return ws.spark.createDataFrame([], RESULT)
    none = [F.array().cast("array<binary>").alias("keys"), F.array().cast("array<long>").alias("words")]
    meeting = _fresh(chains.where("depth = 0"))
    if below is not None:
        meeting = meeting.unionByName(_stripped(below).select("*", *none))
    found.append(ws.keep("root", _level(meeting, 0, 0)))
    names = [c.split()[0] for c in NODE.split(", ")]
    nodes = found[0].select(*names)
    for f in found[1:]:
        nodes = nodes.unionByName(f.select(*names))
    # A parent is one row; a hot parent's many children are split by adaptive execution.
    up = nodes.select((F.col("depth") + 1).alias("child_depth"), F.col("key").alias("own"), F.col("conv_id").alias("parent_conv_id"))
    return nodes.join(up, (F.col("parent") == F.col("own")) & (F.col("depth") == F.col("child_depth")), "left").select(
        "conv_id", F.col("depth").cast("long").alias("depth"), "parent_conv_id", *SUMS, "ends_sha256")
