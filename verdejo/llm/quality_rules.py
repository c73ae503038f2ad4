"""Quality rules as a learned decision list, on DataFrame functions only.

Statistics of every whole text are computed in place. Rules are grown and pruned by sequential
covering: each step is one aggregate over all labelled rows, and the driver sees only the counts
of a few hundred (statistic, threshold) cells. The list becomes one ordered ``CASE WHEN``.

Defined cases: a null or empty text has no words and zero statistics, and fails the base rule.
Repeated rows give repeated results. A null id is kept as null. A document whose labels disagree,
or are null, teaches nothing; without usable labels the list is empty and the base rule decides.
Other columns of the input are not read, so their names cannot clash.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .kit import Scratch, row_key, rows_by

BLANK = " \t\n\x0b\x0c\r"
BREAKS = r"[ \t-\r]+"
SYMBOLS = r"[#*$%&|<>]"
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")

#: What the rules may test. Ratios are zero for texts without words.
TESTED = ("n_words", "mean_length", "symbol_rate", "dup_line_rate", "repeat_rate", "upper_rate", "variety")


@dataclass(frozen=True)
class Learning:
    bins: int = 24              # thresholds for each statistic
    max_rules: int = 12
    max_tests: int = 4          # tests in one rule
    least_covered: int = 4      # rejected rows that a rule must cover while it grows
    edge: float = 0.02          # share of covered bad rows that a widened threshold may give up
    least_precision: float = 0.8  # share of bad rows among those covered, on the pruning fold


@dataclass(frozen=True)
class Test:
    statistic: str
    above: bool
    threshold: float

    def column(self) -> Column:
        return F.col(self.statistic) > self.threshold if self.above else F.col(self.statistic) <= self.threshold


@dataclass(frozen=True)
class Rule:
    tests: tuple[Test, ...]

    def column(self) -> Column:
        out = F.lit(True)
        for t in self.tests:
            out = out & t.column()
        return out


def statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """The input's columns and a column for each statistic (BASE and TESTED), replacing columns of those names."""
    inner = [c for c in docs.columns if c not in {*BASE, *TESTED}]
    trimmed = F.btrim(F.col(text), F.lit(BLANK))
    lines = F.filter(F.split(F.coalesce(F.col(text), F.lit("")), "\n"), lambda x: x.rlike(r"[^ \t-\r]"))
    df = docs.select(*inner, F.when(F.length(trimmed) > 0, F.split(trimmed, BREAKS)).otherwise(F.array().cast("array<string>")).alias("_words"))
    df = df.select(*inner, "_words", F.size("_words").cast("long").alias("n_words"), lines.alias("_lines"))
    # a window and its place, ordered by window: equal windows of one text become neighbours
    places = F.when(F.col("n_words") >= 3, F.sequence(F.lit(0), (F.col("n_words") - 3).cast("int"))).otherwise(F.array().cast("array<int>"))
    found = F.sort_array(F.transform(places, lambda i: F.struct(
        F.xxhash64(F.get("_words", i), F.get("_words", i + 1), F.get("_words", i + 2)).alias("h"), i.alias("p"))))
    df = df.select(*inner, "n_words", "_lines", found.alias("_found"), F.size(F.array_distinct("_words")).alias("_kinds"))
    twice = F.filter("_found", lambda x, i: (x["h"] == F.get("_found", i - 1)["h"]) | (x["h"] == F.get("_found", i + 1)["h"]))
    df = df.select(*inner, "n_words", "_lines", "_kinds", F.sort_array(F.transform(twice, lambda x: x["p"])).alias("_starts"))
    covered = F.aggregate(F.transform("_starts", lambda p, i: F.coalesce(F.least(F.lit(3), F.get("_starts", i + 1) - p), F.lit(3))),
                          F.lit(0), lambda a, x: a + x)
    own = F.coalesce(F.col(text), F.lit(""))
    df = df.select(*inner, "n_words", "_kinds", covered.cast("long").alias("n_repeat_words"),
                   F.length(F.regexp_replace(own, BREAKS, "")).cast("long").alias("word_chars"),
                   F.regexp_count(own, F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
                   F.regexp_count(own, F.lit(r"\p{Lu}")).alias("_upper"), F.size("_lines").alias("_n_lines"),
                   (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"))

    def rate(a, b) -> Column:
        return F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(0.0)
    return df.select(*inner, *BASE, rate("word_chars", "n_words").alias("mean_length"), rate("n_symbols", "n_words").alias("symbol_rate"),
                     rate("n_dup_lines", "_n_lines").alias("dup_line_rate"), rate("n_repeat_words", "n_words").alias("repeat_rate"),
                     rate("_upper", "word_chars").alias("upper_rate"), rate("_kinds", "n_words").alias("variety"))


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def learn(labelled: DataFrame, ws: Scratch, how: Learning = Learning()) -> list[Rule]:
    """An ordered rule list from rows with TESTED statistics, ``bad`` (boolean) and ``fold`` (true: pruning)."""
    quantiles = [(i + 1) / (how.bins + 1) for i in range(how.bins)]
    found = labelled.agg(*(F.percentile_approx(F.col(s).cast("double"), quantiles, 10_000).alias(s) for s in TESTED)).first()
    cuts = {s: sorted(set(found[s] or [])) for s in TESTED}

    def bin_of(s: str) -> Column:
        return F.size(F.filter(F.array(*map(F.lit, cuts[s])).cast("array<double>"), lambda t: F.col(s) > t)).alias(f"b_{s}")
    binned = ws.keep("binned", labelled.select("bad", "fold", *TESTED, *map(bin_of, TESTED)))

    def holds(tests) -> Column:
        out = F.lit(True)
        for s, above, k in tests:
            out = out & (F.col(f"b_{s}") > k if above else F.col(f"b_{s}") <= k)
        return out

    def cells(rows: DataFrame) -> dict:
        """Bad and good rows by statistic and bin; at most len(TESTED) * (bins + 1) cells."""
        each = rows.select("bad", F.explode(F.array(*(F.struct(F.lit(s).alias("s"), F.col(f"b_{s}").alias("b")) for s in TESTED))).alias("x"))
        out = {s: [[0, 0] for _ in range(len(cuts[s]) + 1)] for s in TESTED}
        for r in each.groupBy("x.s", "x.b").agg(F.count_if("bad").alias("p"), F.count_if(~F.col("bad")).alias("n")).collect():
            out[r.s][r.b] = [r.p, r.n]
        return out

    rules, taken = [], F.lit(False)
    while len(rules) < how.max_rules:
        tests: list[tuple[str, bool, int]] = []
        left = binned.where(~taken)
        while len(tests) < how.max_tests:
            counts = cells(left.where(~F.col("fold") & holds(tests)))
            all_p, all_n = (sum(c[j] for c in counts[TESTED[0]]) for j in (0, 1))
            best = _best(counts, all_p, all_n, how.least_covered)
            if not best:
                break
            tests.append(best)
        if not tests:
            break
        scored = left.where("fold").agg(*(f(holds(tests[:k]) & (F.col("bad") if j == 0 else ~F.col("bad"))).alias(f"{k}_{j}")
                                          for k in range(1, len(tests) + 1) for j, f in enumerate((F.count_if, F.count_if)))).first()
        worth = {k: (scored[f"{k}_0"] - scored[f"{k}_1"]) / max(1, scored[f"{k}_0"] + scored[f"{k}_1"]) for k in range(1, len(tests) + 1)}
        k = max(worth, key=lambda k: (worth[k], -k))
        if not scored[f"{k}_0"] or scored[f"{k}_0"] < how.least_precision * (scored[f"{k}_0"] + scored[f"{k}_1"]):
            break
        rules.append(Rule(_widened(left.where(F.col("bad") & holds(tests[:k])), [(s, above, float(cuts[s][b])) for s, above, b in tests[:k]], how)))
        taken = taken | rules[-1].column()
    ws.drop("binned")
    return rules


def _widened(covered: DataFrame, tests: list[tuple[str, bool, float]], how: Learning) -> tuple[Test, ...]:
    """Thresholds moved half way from the good rows to all but a few of the bad rows that the rule covers."""
    edge = covered.agg(*(F.percentile_approx(F.col(s).cast("double"), how.edge if above else 1 - how.edge, 10_000).alias(str(i))
                         for i, (s, above, _) in enumerate(tests))).first()
    return tuple(Test(s, above, (t + edge[str(i)]) / 2) for i, (s, above, t) in enumerate(tests))


def _best(counts: dict, all_p: int, all_n: int, least: int):
    """The test with the largest information gain over the rows covered so far."""
    if not all_p or not all_n:
        return None
    found, top = None, 1e-9
    for s in TESTED:
        p = n = 0
        for b, (dp, dn) in enumerate(counts[s][:-1]):
            p, n = p + dp, n + dn
            for above, cp, cn in ((False, p, n), (True, all_p - p, all_n - n)):
                if cp >= least:
                    gain = cp * (math.log2(cp / (cp + cn)) - math.log2(all_p / (all_p + all_n)))
                    if gain > top:
                        found, top = (s, above, b), gain
    return found


def verdict(rules: list[Rule]) -> Column:
    """True for texts to keep: the first rule that holds rejects, else the text stays."""
    out = F.when(base_failed(), F.lit(False))
    for r in rules:
        out = out.when(r.column(), F.lit(False))
    return out.otherwise(F.lit(True))


def train(measured: DataFrame, labels: DataFrame, ws: Scratch, how: Learning = Learning()) -> list[Rule]:
    """Rules from all labelled rows of ``measured`` (id and statistics); only rows that pass the base rule teach."""
    known = labels.where("doc_id is not null").groupBy("doc_id").agg(F.min("quality").alias("lo"), F.max("quality").alias("hi")).where("lo = hi and lo in (0, 1)")
    rows = measured.where(~base_failed()).join(known, "doc_id").select(
        (F.col("lo") == 0).alias("bad"), (F.crc32(F.col("doc_id").cast("string")) % 3 == 0).alias("fold"), *TESTED)
    return learn(rows, ws, how)


def judged(docs: DataFrame, labels: DataFrame, ws: Scratch, how: Learning = Learning()) -> DataFrame:
    """doc_id, all statistics, base_failed and kept, one row for each input row; also ``_key``, see ``row_key``."""
    measured = ws.keep("measured", statistics(docs.select("doc_id", "text", row_key("doc_id", "text").alias("_key"))).drop("text"))
    rules = train(measured, labels, ws, how)
    return measured.withColumn("base_failed", base_failed()).withColumn("kept", verdict(rules))


def kept_documents(docs: DataFrame, labels: DataFrame, ws: Scratch, how: Learning = Learning()) -> DataFrame:
    """The rows of ``docs`` that the list keeps, with all their columns."""
    good = judged(docs, labels, ws, how).where("kept").select("_key").distinct()
    return rows_by(docs, row_key("doc_id", "text")).join(good, "_key", "left_semi").select("_row.*")
