"""Quality rules, decontamination, substring dedup, language model and packing against brute force."""

import hashlib
import math
import random
import tracemalloc
import weakref
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from plain import DOCS, WORD, benchmark_hits, corpus, kept_words, lower, prose, statistics
from verdejo.llm import debruijn, decontaminate, gru_lm, ngram_join, packing, quality_rules
from verdejo.llm.kit import Scratch

LABELS = "doc_id long, quality int, toxic int"


def path() -> str:
    return pytest.importorskip("public_tokenizers").path("word_bpe_49k.json")


def test_statistics(spark):
    rows = corpus() + [(200, "a b c a b c a b c"), (201, "l one\nl one\n\n \nl  one\nl one"), (202, "# *$ x%&|<>"), (203, "x")]
    df = spark.createDataFrame([(i, t, 1, "w") for i, t in rows], DOCS + ", n_words int, words string")
    got = {r.doc_id: tuple(r[c] for c in quality_rules.BASE) for r in quality_rules.statistics(df).collect()}
    assert got == {i: statistics(t) for i, t in rows}


def test_rules_are_learned_from_labels(spark):
    rng = random.Random(2)
    rows, labels = [], []
    for i in range(240):
        bad = i % 4 == 0
        text = prose(rng, 80)
        rows.append((i, text.replace(" ", " ## ") if bad else text))
        labels += [(i, int(not bad), 0)] * (1 + i % 2)
    labels += [(1, 0, 0), (2, None, 0), (None, 0, 0), (9999, 0, 1)]
    rows += [(300, None), (301, "short text"), (300, None), (None, prose(rng, 70))]
    got = quality_rules.judged(spark.createDataFrame(rows, DOCS), spark.createDataFrame(labels, LABELS), Scratch(spark)).collect()
    assert len(got) == len(rows)
    for r in got:
        if r.doc_id is not None and r.doc_id < 240:
            assert r.kept == (r.doc_id % 4 != 0) and not r.base_failed
    assert all(r.base_failed and not r.kept for r in got if r.doc_id in (300, 301))
    assert [r.kept for r in got if r.doc_id is None] == [True]


def test_rules_without_labels_or_rows(spark):
    none = spark.createDataFrame([], LABELS)
    got = quality_rules.judged(spark.createDataFrame([(1, "w " * 60), (2, "each word of this differs " + " ".join(map(str, range(60))))], DOCS), none, Scratch(spark)).collect()
    assert {r.doc_id: r.kept for r in got} == {1: False, 2: True}
    assert quality_rules.judged(spark.createDataFrame([], DOCS), none, Scratch(spark)).count() == 0


ITEMS = [(1, "The quick brown fox jumps over the lazy dog again and again until night falls over the hills"), (20, "short item"), (3, None), (4, "..."),
         (None, "nobody knows this item"), (5, "the quick brown fox jumps over the lazy dog again and again until dawn"), (20, "Short ITEM"), (6, "é1 über")]


@pytest.mark.parametrize("how", [decontaminate.Search(), decontaminate.Search(shard_words=40, sample=3), decontaminate.Search(block_phrases=2)])
def test_decontamination(spark, how):
    rng = random.Random(4)
    rows = corpus()[:40] + [(i, prose(rng, rng.randint(0, 60)) + " ".join(rng.sample([t or "" for _, t in ITEMS], 2)) + "\n" + prose(rng, rng.randint(0, 900)))
                            for i in range(200, 220)]
    rows += [(300, None), (301, ""), (302, "SHORT, item"), (303, "shorté item"), (304, "short item short item"), (302, "SHORT, item"), (None, "x É1 ÜBER é1 über")]
    df = spark.createDataFrame([(i, t, 0) for i, t in rows], DOCS + ", key int")
    got = decontaminate.judged(df, spark.createDataFrame(ITEMS, "item_id long, text string"), how).collect()
    expected = Counter()
    for i, t in rows:
        n, hit, items = benchmark_hits(t, ITEMS)
        expected[(i, n, hit, len(items), hashlib.sha256(",".join(items).encode()).hexdigest(), hit > 0 and 20 * hit >= n)] += 1
    assert Counter((r.doc_id, r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in got) == expected
    assert all(sum(s.after - s.first for s in r.spans) == r.n_hit for r in got)


def test_one_block_of_the_benchmark_is_held(spark):
    how = decontaminate.Search(block_phrases=2)
    items = spark.createDataFrame([(i, f"a few words of item number {i}") for i in range(9)], "item_id long, text string")
    shipped = [spark.sparkContext.broadcast(b) for b in decontaminate.phrase_blocks(items, how)]
    hashes = np.concatenate([b.hashes[0, :b.lengths[0]] for b in decontaminate.Blocks(shipped)])
    held = []
    for *_, block in decontaminate.find(hashes, np.array([0, len(hashes)]), decontaminate.Blocks(shipped), how):
        held.append(weakref.ref(block))
        del block
        assert sum(h() is not None for h in held) == 1 and not any("_value" in b.__dict__ for b in shipped)
    assert len(held) == len(shipped) == 5


def test_decontaminated_rows_keep_their_columns(spark):
    df = spark.createDataFrame([(1, "short item", "a"), (2, "fine text here", "b"), (3, None, "c")], DOCS + ", _key string")
    kept = decontaminate.kept_documents(df, spark.createDataFrame(ITEMS, "item_id long, text string"), Scratch(spark))
    assert kept.schema == df.schema and sorted((r.doc_id, r._key) for r in kept.collect()) == [(2, "b"), (3, "c")]
    empty = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.judged(df, empty).where("contaminated").count() == 0
    assert decontaminate.judged(df.limit(0), empty).count() == 0


def test_suffix_array_and_search():
    rng = np.random.default_rng(1)
    symbols = rng.integers(1, 4, 400).astype(np.uint16)
    symbols[[57, 58, 200, 399]] = 0
    order = decontaminate.suffix_array(symbols).tolist()

    def tail(i):
        out = []
        while symbols[i]:
            out.append(int(symbols[i]) + 1000)
            i += 1
        return [*out, i]
    assert order == sorted(range(400), key=tail)
    index = decontaminate.FMIndex(symbols, 5)
    phrases = rng.integers(1, 4, (60, 4)).astype(np.uint16)
    lengths = rng.integers(1, 5, 60)
    found = {p: set(index.locate(np.arange(a, b)).tolist()) for p, a, b in zip(*(x.tolist() for x in index.search(phrases, lengths)))}
    for p in range(60):
        own = phrases[p, :lengths[p]].tolist()
        assert found.get(p, set()) == {i for i in range(400) if symbols[i:i + len(own)].tolist() == own}


@pytest.mark.parametrize("how", [debruijn.Repeats(), debruijn.Repeats(12, 5), debruijn.Repeats(6, 6)])
def test_substring_dedup(spark, how):
    rows = corpus() + [(300, "y " * 34), (301, "p q " * 60), (302, "Y " * 35)]
    df = spark.createDataFrame([(i, t, 7) for i, t in rows], DOCS + ", place int")
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept, r.kept_sha256) for r in debruijn.removed(df, Scratch(spark), how).collect()}
    expected = {i: (n, gone, kept, hashlib.sha256(kept.encode()).hexdigest()) for i, (n, gone, kept) in kept_words(rows, how.window).items()}
    assert got == expected and sum(e[1] for e in expected.values()) > 500


def test_substring_dedup_repeated_rows(spark):
    text = " ".join(f"w{i}" for i in range(40))
    df = spark.createDataFrame([(1, text), (1, text), (None, "k " + text), (2, None)], DOCS)
    got = sorted((r.doc_id or 0, r.n_words, r.n_removed) for r in debruijn.removed(df, Scratch(spark)).collect())
    assert got == [(0, 41, 40), (1, 40, 40), (1, 40, 40), (2, 0, 0)]
    assert debruijn.removed(spark.createDataFrame([], DOCS), Scratch(spark)).count() == 0


@pytest.mark.parametrize("listed", [1 << 18, 5])
def test_language_model(spark, listed):
    rng = random.Random(6)
    first, second = "alpha beta gamma delta".split(), "eins zwei drei vier".split()
    rows = [(i, " ".join(rng.choice(first if i % 2 else second) for _ in range(rng.randint(5, 60)))) for i in range(600, 2000)]
    rows += [(500, None), (501, ""), (500, None), (None, "alpha Eins never-seen"), (502, "ALPHA\tbeta " * 800)]
    how = gru_lm.Model(listed=listed, words=8, classes=6, hidden=8, streams=16, gather=9000, rate=1e-2)
    got = gru_lm.scored(spark.createDataFrame(rows, DOCS), Scratch(spark), how).collect()

    def tokens(t):
        return [*WORD.findall(lower(t)), None]

    def apart(i):
        return zlib.crc32(("" if i is None else str(i)).encode()) % 5 == 1
    c = Counter(w for i, t in rows if not apart(i) for w in tokens(t))
    n, v = sum(c.values()), len(c)
    expected = Counter((i, apart(i), len(tokens(t)), sum(c[w] > 0 for w in tokens(t)), n) for i, t in rows)
    assert Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens) for r in got) == expected
    base = {(i, len(tokens(t))): sum(math.log10((c[w] + 0.5) / (n + 0.5 * (v + 1))) for w in tokens(t)) for i, t in rows}
    assert all(math.isclose(r.base_score, base[r.doc_id, r.n_tokens], rel_tol=1e-9) for r in got)
    held = [r for r in got if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)  # each text keeps to one of two word lists


def test_language_model_probabilities_sum_to_one_and_gradients():
    how = gru_lm.Model(words=9, classes=5, hidden=4, streams=3, window=50)
    network = gru_lm.Network(np.array([30, 12, 9, 8, 7, 5, 4, 3, 2, 2, 1], dtype=float), how)
    h = np.random.default_rng(0).normal(size=(1, 4)).astype(np.float32)
    total = sum(math.exp(network.log_probability(h, np.array([t]))[0]) for t in range(11))
    assert math.isclose(total, 1, rel_tol=1e-5)
    texts = [np.array([3, 4, 1, 5, 0]), np.array([2, 2, 10, 0]), np.array([7, 0]), np.array([0])]
    for name in gru_lm.Network.NAMES:
        setattr(network, name, getattr(network, name).astype(np.float64))

    class Recorder:
        def update(self, grads, scale):
            self.grads = grads
    seen = Recorder()
    gru_lm.train(network, texts, how, seen)
    rng = np.random.default_rng(1)
    for name in gru_lm.Network.NAMES:
        p = getattr(network, name)
        for _ in range(4):
            at = tuple(int(rng.integers(s)) for s in p.shape)
            old = p[at]
            p[at] = old + 1e-5
            up = gru_lm.score(network, texts, how).sum()
            p[at] = old - 1e-5
            down = gru_lm.score(network, texts, how).sum()
            p[at] = old
            assert abs(-(up - down) / 2e-5 - seen.grads[name][at]) < 1e-3, (name, at)


def test_vocabulary_grows_with_the_corpus(spark):
    rows = [(i, 1000 if i < 2000 else 3) for i in range(6000)]
    counts = spark.createDataFrame([*rows, (int(gru_lm.END.astype(np.int64)), 500)], "word long, n long")
    how = gru_lm.Model()
    listed, by_id = gru_lm.listed_words(counts, how)
    assert len(by_id) == 2002 and (listed.n_outside, listed.kinds_outside) == (12_000, 4000)
    network = gru_lm.Network(by_id, how)
    assert len(network.bounds) - 1 >= 40
    h = np.random.default_rng(0).normal(size=(1, how.hidden)).astype(np.float32)
    p = network.log_probability(np.repeat(h, 2002, axis=0), np.arange(2002))
    assert math.isclose(np.exp(p.astype(np.float64)).sum(), 1, rel_tol=1e-4)
    again = gru_lm.Network(by_id, how).load(network.pack())
    assert all((a == b).all() for a, b in zip(again.parameters(), network.parameters()))


def test_language_model_keeps_its_size():
    how = gru_lm.Model()
    assert how.hidden >= 16 and how.classes >= 32


def test_layout_does_not_grow_with_longest_text_times_streams():
    how = gru_lm.Model(words=9, classes=5, hidden=4)
    network = gru_lm.Network(np.array([30, 12, 9, 8, 7, 5, 4, 3, 2, 2, 1], dtype=float), how)
    rng = np.random.default_rng(3)
    texts = [np.append(rng.integers(1, 11, n), 0) for n in [20_000, *[3] * 191]]
    tracemalloc.start()
    together = gru_lm.score(network, texts, how)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 20_000 * 192 * 2  # laid out as longest text x streams it took 25 bytes a cell
    apart = [gru_lm.score(network, [t], how)[0] for t in texts]
    assert np.allclose(together, apart, rtol=1e-4)


def test_sample_of_null_and_repeated_ids(spark):
    rows = [(None, f"text {i} of null id") for i in range(3000)] + [(7, "a text that repeats")] * 3000 + [(None, None)] * 3000
    docs = spark.createDataFrame(rows, DOCS)
    got = gru_lm.sampled(docs, 33_000, gru_lm.Model(sample_tokens=1100)).count()
    assert 40 < got < 160


def test_language_model_without_training_rows(spark):
    assert gru_lm.scored(spark.createDataFrame([], DOCS), Scratch(spark)).count() == 0


def test_packing(spark):
    tokenizers = pytest.importorskip("tokenizers")
    tokenizer = tokenizers.Tokenizer.from_file(path())
    rows = corpus() + [(300, "<|endoftext|> ÉÀ don't!!'s The, é.x"), (300, "twice"), (300, "twice"), (None, "no id")]
    how = packing.Packing(capacity=64, cache_words=50)
    df = spark.createDataFrame([(i, t, 1) for i, t in rows], DOCS + ", rank int").repartition(3)
    got = packing.packed(df, path(), Scratch(spark), how).collect()
    expected = Counter()
    for i, t in rows:
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids + [1]
        for k, at in enumerate(range(0, len(ids), 64)):
            own = ids[at:at + 64]
            expected[(i, k, at, len(own), zlib.crc32(np.array(own, dtype="<u4").tobytes()))] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == expected
    sequences = {}
    for r in got:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in sequences.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= 64
    assert len(sequences) <= -(-sum(r.length for r in got) // 64) * 1.02 + 1
    assert packing.packed(df.limit(0), path(), Scratch(spark), how).count() == 0


@pytest.mark.parametrize("seed", range(6))
def test_plans_place_every_piece_once(seed):
    rng = random.Random(seed)
    histogram = Counter(rng.choice([rng.randint(1, 100), rng.randint(30, 50), 100]) for _ in range(rng.choice([1, 7, 500, 20_000])))
    plan = packing.make_plan(histogram, packing.Packing(capacity=100, groups=rng.choice([3, 40])))
    fill, seen = np.zeros(plan.sequences, dtype=int), Counter()
    for length, rank, count, sequence, offset in plan.rows:
        assert rank == seen[length]
        seen[length] += count
        fill[sequence:sequence + count] += length
    assert seen == histogram and fill.max() <= 100 and fill.min() > 0


def test_fold_of_null_id_is_training(spark):
    row = spark.createDataFrame([(None,)], "doc_id long").select(gru_lm.held_out().alias("h"), F.lit(1)).first()
    assert row.h is False


def test_kept_rows_keep_columns_of_any_name(spark):
    good = " ".join(f"word{i}" for i in range(60))
    df = spark.createDataFrame([(1, good, "a", 7), (2, "too short", "b", 8), (3, good, "c", 9)], DOCS + ", _key string, _gone int")
    labels = spark.createDataFrame([], "doc_id long, quality int")
    ruled = quality_rules.kept_documents(df, labels, Scratch(spark))
    assert ruled.schema == df.schema and sorted(map(tuple, ruled.collect())) == [(1, good, "a", 7), (3, good, "c", 9)]
    led = ngram_join.representatives(df, Scratch(spark))
    assert led.schema == df.schema and sorted(map(tuple, led.collect())) == [(1, good, "a", 7), (2, "too short", "b", 8)]


@pytest.mark.parametrize("scale", [1, 60, 4000])
def test_softmax_in_blocks_and_of_any_size(scale, monkeypatch):
    rng = np.random.default_rng(6)
    h, w, b, target = rng.normal(size=(40, 4)), rng.normal(size=(4, 9)) * scale, rng.normal(size=9), rng.integers(0, 9, 40)
    logits = h @ w + b
    share = np.exp(logits - logits.max(axis=1, keepdims=True))
    total = share.sum(axis=1)
    expected = (logits - logits.max(axis=1, keepdims=True))[np.arange(40), target] - np.log(total)
    error = share / total[:, None] - np.eye(9)[target]
    for held in (1 << 17, 27):
        monkeypatch.setattr(gru_lm, "SHARES", held)
        got = gru_lm.softmax(h, w, b, target, True)
        for x, y in zip(got, (expected, error @ w.T, h.T @ error, error.sum(axis=0))):
            assert np.allclose(x, y, rtol=1e-9, atol=1e-9 * scale)


def test_steps_in_blocks_equal_whole_steps(monkeypatch):
    grads = {n: None for n in gru_lm.Network.NAMES}

    def learned(block):
        monkeypatch.setattr(gru_lm.Adam, "BLOCK", block)
        network = gru_lm.Network(np.arange(40, 0, -1.0), gru_lm.Model(classes=5, hidden=4))
        adam, rng = gru_lm.Adam(network, 0.01), np.random.default_rng(2)
        for _ in range(3):
            adam.update({n: rng.normal(size=getattr(network, n).shape).astype(np.float32) for n in grads}, 0.5)
        return network.parameters()
    assert all((a == b).all() for a, b in zip(learned(7), learned(1 << 20)))
