"""Brute-force versions of the operators, in plain Python, and small tables to run them on."""

from __future__ import annotations

import random
import re
from collections import Counter

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
DOCS = "doc_id long, text string"


def lower(text: str | None) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def prose(rng: random.Random, n: int, lines: bool = True) -> str:
    """n words; Zipf-like, with accents, capitals, punctuation, tabs and line breaks."""
    words = [w + s for w in ("the", "of", "Été", "über", "niño", "and", "Lorem", "zq", "wit", "haus") for s in ("", "a", "en", "ing", ".", ",", "x7", "ß")]
    out = [rng.choice(words) if rng.random() < 0.7 else rng.choice(words) + rng.choice(words).strip(".,") for _ in range(n)]
    return "".join(w + rng.choice([" ", " ", " ", "  ", "\t", "\n" if lines else " "]) for w in out)


def corpus(seed: int = 3) -> list[tuple[int | None, str | None]]:
    """Short, long and empty texts, nulls, exact copies, near copies, shared passages."""
    rng = random.Random(seed)
    rows: list[tuple[int | None, str | None]] = [(i, prose(rng, rng.choice([1, 3, 4, 8, 30, 60, 120, 300]))) for i in range(60)]
    base, passage = prose(rng, 150), prose(rng, 50, lines=False)
    for i in range(60, 75):
        words = base.split(" ")
        for _ in range(rng.randint(0, 3)):
            words[rng.randrange(len(words))] = rng.choice(["new", "other", "edit"])
        rows.append((i, " ".join(words)))
    rows += [(i, prose(rng, 40) + passage + prose(rng, rng.randint(0, 80))) for i in range(75, 90)]
    rows += [(90, base), (91, base), (92, None), (93, ""), (94, " \n\t "), (95, "x " * 90), (96, "x " * 36), (97, "x " * 35), (98, "one"),
             (99, "é é   \x1c z"), (100, prose(rng, 6000))]
    return rows


def groups(n: int, pairs) -> list[int]:
    """Smallest member of each one's connected group."""
    parent = list(range(n))

    def find(i: int) -> int:
        while parent[i] != i:
            i = parent[i]
        return i
    for i, j in pairs:
        a, b = find(i), find(j)
        parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def shingles(text: str | None, n: int) -> frozenset:
    words = WORD.findall(lower(text))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i:i + n]) for i in range(max(1, len(words) - n + 1)))


def jaccard_components(rows, n: int, percent: int) -> dict:
    rows = sorted(rows)
    sets = [shingles(t, n) for _, t in rows]
    found = groups(len(rows), ((j, i) for i in range(len(rows)) for j in range(i) if sets[i] and sets[j]
                               and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j])))
    return {rows[i][0]: (len(sets[i]), rows[found[i]][0]) for i in range(len(rows))}


def statistics(text: str | None) -> tuple:
    words = WORD.findall(text or "")
    windows = Counter(zip(words, words[1:], words[2:]))
    covered = {i + j for i in range(len(words) - 2) if windows[tuple(words[i:i + 3])] > 1 for j in range(3)}
    seen, repeats = set(), 0
    for line in (text or "").split("\n"):
        if WORD.search(line):
            repeats += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), repeats, len(covered)


def kept_words(rows, window: int) -> dict:
    texts = [(i, WORD.findall(t or "")) for i, t in rows]
    count = Counter(tuple(w[i:i + window]) for _, w in texts for i in range(len(w) - window + 1))
    out = {}
    for key, w in texts:
        gone = {i + j for i in range(len(w) - window + 1) if count[tuple(w[i:i + window])] > 1 for j in range(window)}
        out[key] = len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)
    return out


def benchmark_hits(text: str | None, items, window: int = 13) -> tuple[int, int, list[str]]:
    words, hit, found = ALNUM.findall(lower(text)), set(), set()
    for item, own in items:
        own = ALNUM.findall(lower(own))
        for i in range(max(len(own) - window + 1, min(1, len(own)))):
            phrase = own[i:i + window]
            for j in range(len(words) - len(phrase) + 1):
                if words[j:j + len(phrase)] == phrase:
                    hit |= set(range(j, j + len(phrase)))
                    if item is not None:
                        found.add(str(item))
    return len(words), len(hit), sorted(found)
