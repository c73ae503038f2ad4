"""Chat windows against plain code: escapes, budgets, repeated context, masks, and reading back."""

import hashlib
import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from plain import WORD
from verdejo.llm import chat_windows
from verdejo.llm.chat_windows import Budget

ROWS = "conv_id long, turn long, role string, text string"
PIECES = ["<", "|", ">", "[", "]", "/", "\\", "s>", "INST]", "</s>", "<s>", "[INST]", "[/INST]", "<|", "|>", "user", " ", "\n", "é", "𝄞", "$1"]


def ordered(rows):
    out = {}
    for conv, turn, role, text in rows:
        out.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    return {c: [t[2:] for t in sorted(turns)] for c, turns in out.items()}


def plain_windows(turns, how):
    """Indices of (repeated, new) turns of each window."""
    size = [len(WORD.findall(t)) + chat_windows.MARKS for _, t in turns]
    s = int(turns[0][0] == "system")
    out, i = [], s
    while i < len(turns) or not out:
        left = how.budget - sum(size[:s])
        left = left if not out else max(left - how.history, 1)
        j, used = i, 0
        while j < len(turns) and (j == i or used + size[j] <= left):
            used += size[j]
            j += 1
        past = [] if not out else [k for k in range(max(s, i - how.repeats), i) if sum(size[k:i]) <= how.history]
        out.append(((list(range(s)) if out else []) + past, ([] if out else list(range(s))) + list(range(i, j))))
        i = j
    return out


def check(spark, rows, how, extra=""):
    parts = chat_windows.windows(spark.createDataFrame(rows, ROWS + extra), how)
    plain = ordered([r[:4] for r in rows])
    got = {}
    for r in parts.collect():
        got.setdefault(r.conv_id, []).append(r)
    assert set(got) == set(plain)
    for conv, turns in plain.items():
        expected = plain_windows(turns, how)
        mine = sorted(got[conv], key=lambda r: r.window)
        assert [(r.window, r.n_repeated, r.n_turns) for r in mine] == [(k, len(a), len(a) + len(b)) for k, (a, b) in enumerate(expected)]
        for r, (past, new) in zip(mine, expected):
            assert r.text.count("</s>") == r.n_turns and not any(c in r.text for c in ("<s>", "[INST]", "[/INST]"))
            assert len(r.mask) == sum(turns[k][0] == "assistant" for k in new)
    back = {r.conv_id: r for r in chat_windows.read_back(parts).collect()}
    for conv, turns in plain.items():
        assert [tuple(t) for t in back[conv].turns] == turns
        assert back[conv].loss == [t for role, t in turns if role == "assistant"]
        assert back[conv].formatted_chars == sum(len(r.text) for r in got[conv])
    return got


def talks(seed, n=40):
    rng, rows = random.Random(seed), []
    for c in range(n):
        for t in range(rng.choice([1, 2, 5, 12, 30])):
            text = rng.choice([None, "", "one", "a b c d", " ".join("w" * rng.randint(1, 40)), "".join(rng.choices(PIECES, k=6))])
            rows.append((c, t, rng.choice(["system", "user"]) if t == 0 else rng.choice(["user", "assistant", "assistant", "tool|>", None]), text))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("how", [Budget(), Budget(30, 10, 3), Budget(12, 0, 0), Budget(1, 5, 2)])
def test_windows(spark, how):
    got = check(spark, talks(how.budget), how)
    assert how.budget > 100 or max(map(len, got.values())) > 3


def test_bounds(spark):
    how = Budget(40, 12, 4)
    rows = [r for r in talks(9) if len((r[3] or "").split()) <= 8]
    for parts in check(spark, rows, how).values():
        assert all(r.n_tokens <= how.budget for r in parts)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.lists(st.sampled_from(PIECES), max_size=6), st.lists(st.sampled_from(PIECES), max_size=12)), min_size=30, max_size=60))
def test_escapes(spark, turns):
    check(spark, [(1, i, "".join(role), "".join(text)) for i, (role, text) in enumerate(turns)], Budget(25, 8, 2))


def test_nulls_ties_names_and_empty(spark):
    rows = [(None, 0, "user", "a"), (None, None, None, None), (3, 1, "user", "b"), (3, 1, "user", "a"), (3, 1, "user", "a"), (4, 0, "system", "only")]
    check(spark, rows, Budget())
    check(spark, [(*r, "x", 1, 2) for r in rows], Budget(), ", head string, s int, window int")
    empty = chat_windows.windows(spark.createDataFrame([], ROWS))
    assert empty.count() == 0 and chat_windows.digests(chat_windows.read_back(empty)).count() == 0


def test_digests(spark):
    rows = [(-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]"), (1, 0, "user", "hé"), (1, 1, "assistant", "𝄞")]
    got = {r.conv_id: r for r in chat_windows.digests(chat_windows.read_back(chat_windows.windows(spark.createDataFrame(rows, ROWS)))).collect()}
    text = "</s>[INST] ok [/INST]"
    assert (got[-7].n_turns, got[-7].loss_chars) == (2, len(text))
    assert got[-7].turns_sha256 == hashlib.sha256(f"user\n{text}\nassistant\n{text}\n".encode()).hexdigest()
    assert got[-7].loss_sha256 == hashlib.sha256(text.encode()).hexdigest()
    assert (got[1].loss_chars, got[1].loss_sha256) == (1, hashlib.sha256("𝄞".encode()).hexdigest())


def test_long_conversation(spark):
    check(spark, [(5, i, "assistant" if i % 2 else "user", "word " * (i % 9)) for i in range(3000)], Budget(64, 16, 4))
