"""N-gram join, line dedup and components against brute force."""

import random

import pytest
import regex
from pyspark.sql import functions as F

from plain import DOCS, corpus, groups, jaccard_components
from verdejo.llm import line_dedup, links, ngram_join
from verdejo.llm.kit import Scratch


@pytest.mark.parametrize("how", [ngram_join.Similarity(), ngram_join.Similarity(5, 80), ngram_join.Similarity(2, 60, block=4, large=2)])
def test_join(spark, how):
    rows = corpus()
    df = spark.createDataFrame([(i, t, "extra", i) for i, t in rows], DOCS + ", component_id string, node long")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.grouped(df, Scratch(spark), how).collect()}
    assert got == jaccard_components(rows, how.n, how.percent)


@pytest.mark.parametrize("how", [ngram_join.Similarity(), ngram_join.Similarity(5, 80)])
def test_join_long_texts(spark, how):
    """Sets on both sides of the size from which sketches are longer, edited by about as much as a link allows."""
    rng, rows = random.Random(9), []
    passage = [f"p{i}" for i in range(60)]
    for size in (500, 690, 700, 760, 1500, 2600):
        base = [f"w{rng.randrange(5000)}" for _ in range(size)]
        for share in (0, 0.005, 0.015, 0.02, 0.022, 0.025, 0.03, 0.04):
            words = [("edit%d" % rng.randrange(10**6) if rng.random() < share else w) for w in base]
            rows.append((len(rows), " ".join(words + passage)))
        rows.append((len(rows), " ".join(base[:int(size * rng.uniform(0.8, 0.9))])))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.grouped(spark.createDataFrame(rows, "doc_id long, text string"), Scratch(spark), how).collect()}
    expected = jaccard_components(rows, how.n, how.percent)
    assert got == expected and 6 < len({c for _, c in expected.values()}) < len(rows) - 6


def test_join_repeated_and_null_ids(spark):
    text = "a b c d e f g h i j"
    df = spark.createDataFrame([(5, text), (5, text), (3, text.upper()), (None, text), (None, "only here and there"), (7, None)], DOCS)
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in ngram_join.grouped(df, Scratch(spark)).collect()), key=str)
    assert got == sorted([(5, 7, 3), (5, 7, 3), (3, 7, 3), (None, 7, 3), (None, 1, None), (7, 0, 7)], key=str)
    kept = ngram_join.representatives(df, Scratch(spark)).collect()
    assert sorted((r.doc_id or 0, r.text or "") for r in kept) == [(0, "a b c d e f g h i j"), (0, "only here and there"), (3, text.upper()), (7, "")]


def test_join_empty(spark):
    assert ngram_join.grouped(spark.createDataFrame([], DOCS), Scratch(spark)).count() == 0


def test_components(spark):
    rng = random.Random(1)
    pairs = [(rng.randrange(300), rng.randrange(300)) for _ in range(180)] + [(i, i + 1) for i in range(400, 440)] + [(7, 7)]
    got = {r.node: r.root for r in links.components(spark.createDataFrame([*pairs, (None, 3)], "a long, b long"), Scratch(spark)).collect()}
    expected = groups(500, pairs)
    assert all(got[n] == expected[n] for p in pairs if p[0] != p[1] for n in p)
    assert all(got.get(n, n) == expected[n] for n in range(500))


def _lines_brute(spark, rows, how):
    df = spark.createDataFrame(rows, DOCS)
    kinds, places = {}, {}
    for r in line_dedup.hashed_lines(df, how).collect():
        text = dict(rows)[r.doc_id].split("\n")[r.line_no]
        kinds[r.h] = (r.s, regex.sub(r"[^\p{L}\p{N}]+", " ", text.lower()).strip(" "))
        places.setdefault(r.h, []).append((r.doc_id, r.line_no))
    names = sorted(kinds)

    def distance(a, b):
        p = list(range(len(b) + 1))
        for i, x in enumerate(a):
            c = [i + 1]
            for j, y in enumerate(b):
                c.append(min(p[j] + (x != y), p[j + 1] + 1, c[j] + 1))
            p = c
        return p[-1]

    def linked(i, j):
        (s, a), (t, b) = kinds[names[i]], kinds[names[j]]
        return bin((s ^ t) & (1 << 64) - 1).count("1") <= how.distance and distance(a, b) <= max(len(a), len(b)) * (100 - how.percent) // 100
    found = groups(len(names), ((j, i) for i in range(len(names)) for j in range(i) if linked(i, j)))
    by_group = {}
    for i, g in enumerate(found):
        by_group.setdefault(g, []).extend(places[names[i]])
    gone = {p for members in by_group.values() for p in sorted(members)[1:]}
    return {d: None if t is None else "\n".join(x for i, x in enumerate(t.split("\n")) if (d, i) not in gone) for d, t in rows}, len(gone)


@pytest.mark.parametrize("how", [line_dedup.Fuzziness(), line_dedup.Fuzziness(distance=12, blocks=14, percent=70, least_words=2)])
def test_lines(spark, how):
    rng = random.Random(5)
    stock = [" ".join(rng.choice("alpha beta gamma delta eins zwei drei été niño über".split()) + str(rng.randrange(30)) for _ in range(rng.randint(2, 25))) for _ in range(25)]
    rows = []
    for d in range(30):
        lines = []
        for _ in range(rng.randint(0, 6)):
            line = rng.choice(stock)
            if rng.random() < 0.5:
                words = line.split()
                words[rng.randrange(len(words))] = rng.choice(["edit", "x", words[0].upper()])
                line = rng.choice(["", "* ", "  "]) + " ".join(words) + rng.choice(["", "!", " ..."])
            lines.append(line)
        rows.append((d, "\n".join(lines)))
    rows += [(40, None), (41, ""), (42, "\n\n"), (43, "short\nshort"), (44, stock[0] + "\n" + stock[0])]
    expected, cut = _lines_brute(spark, rows, how)
    df = spark.createDataFrame([(*r, "other", 1) for r in rows], DOCS + ", key string, line_no int")
    got = line_dedup.deduped(df, Scratch(spark), how).collect()
    assert cut > 5 and {r.doc_id: r.text for r in got} == expected
    assert all(r.key == "other" and r.line_no == 1 for r in got)


def test_lines_repeated_rows_and_empty(spark):
    line = "one two three four five six seven"
    df = spark.createDataFrame([(2, f"{line}\n{line}"), (2, f"{line}\n{line}"), (None, line), (1, "ONE two, three four five six seven!")], DOCS)
    got = sorted((r.doc_id or 0, r.text) for r in line_dedup.deduped(df, Scratch(spark)).collect())
    assert got == [(0, ""), (1, "ONE two, three four five six seven!"), (2, ""), (2, "")]
    assert line_dedup.deduped(spark.createDataFrame([], DOCS), Scratch(spark)).count() == 0


def test_short_lines_and_lines_without_blanks(spark):
    rows = [(1, "All rights reserved\n---\n\n春の海ひねもすのたりのたりかな"), (2, "new line here\n* all RIGHTS reserved.\n春の海ひねもすのたりのたりかな\n---\n"), (3, "Go\ngo\nGo on")]
    got = {r.doc_id: r.text for r in line_dedup.deduped(spark.createDataFrame(rows, DOCS), Scratch(spark)).collect()}
    assert got == {1: rows[0][1], 2: "new line here\n---\n", 3: "Go\nGo on"}


def test_normal_form_keeps_letters_and_digits(spark):
    row = spark.createDataFrame([("  Één, 2-mal!\tTest_x ",)], "t string").select(line_dedup.normal(F.col("t")).alias("n")).first()
    assert row.n == "één 2 mal test x"


def test_repeated_rows_keep_the_hash_of_a_line(spark):
    line, rows = "one two two three four five six seven", lambda n: spark.createDataFrame([(1, "one two two three four five six seven\n\nx")] * n, DOCS)
    one, many = ({(r.line_no, r.h, r.s, r.n_words) for r in line_dedup.hashed_lines(rows(n), line_dedup.Fuzziness()).collect()} for n in (1, 3))
    assert many == one and {n for *_, n in one} == {len(line.split()), 1}
    assert line_dedup.hashed_lines(rows(3), line_dedup.Fuzziness()).count() == 6


def test_lines_of_unlike_length_are_not_paired(spark):
    class Seen(Scratch):
        def keep(self, name, df):
            kept = super().keep(name, df)
            sizes[name] = kept.count()
            return kept
    sizes = {}
    rows = [(n, "the " * int(20 * 1.3 ** n) + f"end{n}") for n in range(12)]  # one SimHash, since one word is most of each
    got = line_dedup.deduped(spark.createDataFrame(rows, DOCS), Seen(spark)).collect()
    assert sorted((r.doc_id, r.text) for r in got) == rows and sizes["led"] == 0


def test_short_lines_with_an_edit_are_compared(spark):
    rng, rows = random.Random(4), []
    for n in range(60):
        line = " ".join("".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(9, 14))) for _ in range(rng.randint(1, 4)))
        at = rng.randrange(len(line.split()[0]))
        rows += [(2 * n, line), (2 * n + 1, line[:at] + "q" + line[at + 1:])]
    got = {r.doc_id: r.text for r in line_dedup.deduped(spark.createDataFrame(rows, DOCS), Scratch(spark)).collect()}
    expected, cut = _lines_brute(spark, rows, line_dedup.Fuzziness())
    assert got == expected and cut >= 10


@pytest.mark.parametrize("how", [line_dedup.Fuzziness(crowd=3), line_dedup.Fuzziness(distance=12, blocks=14, percent=70, least_words=2, crowd=2)])
def test_crowded_blocks_lose_no_link(spark, how):
    rng = random.Random(8)
    rows = []
    for d in range(60):
        words = ["the"] * 12 + ["of"] * rng.randint(4, 12) + ["and"] * rng.randint(1, 8)
        words += [rng.choice(["alpha", "beta", "gamma", "delta"]) for _ in range(rng.randint(0, 6))]
        rng.shuffle(words)
        rows += [(2 * d, " ".join(words)), (2 * d + 1, " ".join(words[:-1] + [rng.choice(["x", "edit", words[-1] + "s"])]))]
    expected, cut = _lines_brute(spark, rows, how)
    got = line_dedup.deduped(spark.createDataFrame(rows, DOCS), Scratch(spark), how).collect()
    assert cut > 20 and {r.doc_id: r.text for r in got} == expected


def test_crowded_blocks_are_not_compared_row_by_row(spark):
    """Lines of one frequent word share their blocks; those that cannot be alike share no cell."""
    rows = [(n, 7 if n % 2 else -1, 10 + 5 * n * n, 1) for n in range(300)]
    df = line_dedup.cells(spark.createDataFrame(rows, "h long, s long, size int, block long"), line_dedup.Fuzziness(crowd=20))
    most = df.groupBy("cell").count().agg(F.max("count")).first()[0]
    assert most <= 30 and df.select("h").distinct().count() == 300
    alone = line_dedup.cells(spark.createDataFrame([(1, 5, 30, 1), (2, 5, 30, 2)], "h long, s long, size int, block long"), line_dedup.Fuzziness())
    assert alone.count() == 0
