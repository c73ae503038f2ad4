"""The Merkle manifest against a plain tree."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from plain import lower
from verdejo.llm import merkle
from verdejo.llm.kit import Scratch

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def H(*inputs):
    return hashlib.sha256("".join(inputs).encode()).hexdigest()


def leaf(row, text):
    doc_id, _, lang, source, n_chars = row
    return H(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)))


def climbed(members, hashes):
    """One node over ``hashes``; ``members`` below each are (…, folded, siblings) records, which climb along."""
    while len(hashes) > 1:
        upper, above = [], []
        for a in range(0, len(hashes), 8):
            run = hashes[a:a + 8]
            upper.append(H(*run))
            above.append([])
            for j in range(len(run)):
                for m in members[a + j]:
                    m["proof"] += run[:j] + run[j + 1:]
                    m["folded"] = H(*run[:j], m["folded"], *run[j + 1:])
                    above[-1].append(m)
        hashes, members = upper, above
    return hashes[0]


def plain(rows):
    by_lang = {}
    for row in rows:
        own, text = leaf(row, row[1]), row[1]
        if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 3 == 0 and text is not None:
            text = lower(text)
        by_lang.setdefault(row[2], []).append({"id": row[0], "leaf": own, "folded": leaf(row, text), "proof": []})
    subroots = []
    langs = sorted(by_lang, key=lambda x: (x is not None, (x or "").encode()))
    for lang in langs:
        by_lang[lang].sort(key=lambda m: (m["id"] is not None, m["id"] or 0, m["leaf"]))
        subroots.append(climbed([[m] for m in by_lang[lang]], [m["leaf"] for m in by_lang[lang]]))
    root = climbed([by_lang[x] for x in langs], subroots) if langs else None
    return sorted(((m["id"], m["leaf"], s, root, H(*m["proof"]), m["folded"], m["folded"] == root)
                   for x, s in zip(langs, subroots) for m in by_lang[x]), key=str)


def manifest(spark, rows, extra=""):
    docs = spark.createDataFrame(rows, DOCS + extra)
    ws = Scratch(spark)
    return merkle.climb(merkle.build(docs, ws, merkle.tampered(F.col("doc_id"), F.col("text"))), ws)


def document(i, lang, rng):
    return (i, rng.choice([None, "", "Plain Text", "ÉTÉ A:B\n-", "x" * 5000 + "Q"]) if i is None or i % 5 else f"Text {i}", lang,
            rng.choice([None, "web", "ö"]), rng.choice([None, i, 3]))


@pytest.mark.parametrize("sizes", [{"en": 1}, {"en": 8}, {"en": 9, None: 1}, {"en": 65, "": 8, "é": 7, None: 3, "z": 1}, {f"l{i:02}": 1 + i % 2 for i in range(20)}])
def test_tree(spark, sizes):
    rng = random.Random(5)
    ids = iter(rng.sample(range(-500, 5000), 400))
    rows = [document(next(ids), lang, rng) for lang, n in sizes.items() for _ in range(n)]
    rng.shuffle(rows)
    assert sorted(map(tuple, manifest(spark, rows).collect()), key=str) == plain(rows)


def test_nulls_repeats_and_names(spark):
    rng = random.Random(2)
    rows = [document(None, "en", rng) for _ in range(5)] + [document(4, "en", rng) for _ in range(6)] + [(7, "Same", "en", None, None)] * 9 + [(None,) * 5] * 2
    expected = plain(rows)
    assert sorted(map(tuple, manifest(spark, rows).collect()), key=str) == expected
    wide = [(*r, "x", 1, b"y", 5) for r in rows]
    assert sorted(map(tuple, manifest(spark, wide, ", hash string, node long, part binary, n long").collect()), key=str) == expected


def test_empty(spark):
    assert manifest(spark, []).count() == 0


def test_the_changed_ones_fail(spark):
    rows = [(i, f"Text {i}" if i % 2 else f"text {i}", "en", "web", 6) for i in range(120)]
    got = {r.doc_id: r.verified for r in manifest(spark, rows).collect()}
    assert got == {i: not (zlib.crc32(str(i).encode()) % 3 == 0 and i % 2 == 1) for i in range(120)}


def test_limit_is_put_back(spark):
    before = spark.conf.get("spark.sql.cteRecursionRowLimit")
    manifest(spark, [(1, "a", "en", "web", 1)]).collect()
    assert spark.conf.get("spark.sql.cteRecursionRowLimit") == before
