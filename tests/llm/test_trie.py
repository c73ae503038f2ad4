"""The prefix trie of conversations against plain counting."""

import hashlib
import random
import zlib

import pytest

from plain import WORD
from verdejo.llm import conversation_trie
from verdejo.llm.kit import Scratch

ROWS = "conv_id long, turn long, role string, text string"


def rebuilt(rows):
    own = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            own.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [(r, t) for _, _, r, t in sorted(turns, key=lambda x: x[:2])] for c, turns in own.items()}

    def opening(c):
        base = abs(c) // 20 * 20 * (1 if c >= 0 else -1)
        return own.get(base, [])
    h = {c: zlib.crc32(str(c).encode()) % 4 for c in own}
    return {c: opening(c)[:h[c]] + turns[h[c]:] for c, turns in own.items()}


def plain(rows):
    members, ends = {}, {}
    for c, turns in rebuilt(rows).items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), set()).add(c)
        ends.setdefault(tuple(turns), set()).add(c)
    children, leaves, saved = {}, {}, {}
    for node in sorted(members, key=len, reverse=True):
        leaves[node] = leaves.get(node, 0) or 1
        saved[node] = saved.get(node, 0) + (len(members[node]) - 1) * (len(WORD.findall(node[-1][1])) if node else 0)
        if node:
            up = node[:-1]
            children[up] = children.get(up, 0) + 1
            leaves[up] = leaves.get(up, 0) + leaves[node]
            saved[up] = saved.get(up, 0) + saved[node]
    return sorted((min(m), len(n), min(members[n[:-1]]) if n else None, len(m), children.get(n, 0), leaves[n], saved[n],
                   hashlib.sha256(",".join(map(str, sorted(ends.get(n, ())))).encode()).hexdigest()) for n, m in members.items())


def talks(seed, n, longest):
    """Shared openings, copies, prefixes of one another, few words so that turns repeat, gaps between ids."""
    rng, rows = random.Random(seed), []
    for c in rng.sample(range(-60, 6 * n), n):
        size = rng.choice([1, 2, 3, 5, 8, longest])
        rows += [(c, t, rng.choice(["user", "assistant", None]), rng.choice(["a b", "a", "", None, "long  text\there", "é"])) for t in range(size)]
    block = [("user", "same"), ("assistant", "a b c")] * (longest // 2)
    for c in range(10 * n, 10 * n + 45):
        rows += [(c, t, *turn) for t, turn in enumerate(block[:len(block) - c % 3])]
    return rows


def got(spark, rows, how, extra=""):
    df = conversation_trie.trie(spark.createDataFrame(rows, ROWS + extra), Scratch(spark), how)
    return sorted(map(tuple, df.collect()))


@pytest.mark.parametrize("together", [0, 20, 10 ** 6])
def test_depths_one_by_one_and_together(spark, together):
    rows = talks(4, 60, 20)
    assert got(spark, rows, conversation_trie.Peeling(together)) == plain(rows)


def test_blocks_of_one_end(spark, monkeypatch):
    rows = [(c, t, "user", str(t)) for c in range(0, 3000) for t in range(2)]
    monkeypatch.setattr(conversation_trie, "BLOCK", 7)
    assert got(spark, rows, conversation_trie.Peeling()) == plain(rows)


def test_segment_borders(spark):
    rows = [(c, t, "user", f"t{t}") for c, n in ((100, 16), (101, 17), (102, 32), (103, 33), (104, 48)) for t in range(n)]
    for together in (0, 10):
        assert got(spark, rows, conversation_trie.Peeling(together)) == plain(rows)


def test_nulls_ties_and_names(spark):
    rows = [(None, 1, "user", "lost"), (5, None, "user", "first"), (5, 0, None, None), (5, 1, "user", "x y"), (-7, 0, "user", "one"), (40, 0, "system", "s")]
    assert got(spark, rows, conversation_trie.Peeling()) == plain(rows)
    tied = [(3, 1, "user", "b"), (3, 1, "user", "a"), (3, 1, "user", "a"), (0, 0, "user", "z")]
    assert got(spark, tied, conversation_trie.Peeling()) == got(spark, tied[::-1], conversation_trie.Peeling())
    wide = [(*r, 1, "k", b"w") for r in rows]
    assert got(spark, wide, conversation_trie.Peeling(), ", depth int, key string, words binary") == plain(rows)


def test_without_turns_or_rows(spark):
    lone = next(c for c in range(21, 40) if zlib.crc32(str(c).encode()) % 4 == 3)
    rows = [(lone, 0, "user", "gone"), (lone, 1, "user", "gone too")]
    assert got(spark, rows, conversation_trie.Peeling()) == plain(rows) == [(lone, 0, None, 1, 0, 1, 0, hashlib.sha256(str(lone).encode()).hexdigest())]
    assert got(spark, [], conversation_trie.Peeling()) == []
