"""Operators on small fixtures against brute force."""

import math
import random
import re
import unicodedata

import numpy as np
import pytest
from pyspark.sql import functions as F

from verdejo.functions import scalar as S
from verdejo.functions.geo import EARTH_KM, Grid, haversine_km
from verdejo.functions.text import normal_form, tight_key
from verdejo.operators import matching
from verdejo.operators.impute import impute_medians
from verdejo.operators.integrity import one_sided, orphans, repeated
from verdejo.operators.keys import all_ids, dense_ids, lasting_ids
from verdejo.operators.picks import dominant, latest, most_frequent
from verdejo.operators import quantiles
from verdejo.operators.quantiles import group_quantiles, money_fence
from verdejo.operators.signature import key_changes, merged, signature
from verdejo.session import Workspace


def plain_rule(text):
    text = unicodedata.normalize("NFKD", (text or "").lower())
    text = "".join(c for c in text if not unicodedata.combining(c))
    return re.sub(r"\s+", " ", re.sub(r"[^a-z0-9 ]", " ", text)).strip()


def test_normal_form_follows_the_rule_on_every_letter(spark):
    rng = random.Random(3)
    names = ["Santa Bárbara d'Oeste", "santa barbara doeste", "Embu-Guaçu", "  São   João ", "ﬁno ½ nº 3ª ①⑩", "", None,
             "ÅNGSTRÖM", "straße", "İstanbul", "é a️b", "㎏ ㏒ ǆ", "\U0001f101x", "a\tb\nc", "Æ ø Ł"]
    codes = [c for c in range(1, 0x2FFFF) if not 0xD800 <= c <= 0xDFFF]
    names += ["x" + chr(c) + "y" for c in rng.sample(codes, 4000)]
    names += ["".join(chr(rng.randrange(32, 0x250)) for _ in range(12)) for _ in range(500)]
    df = spark.createDataFrame([(i, n) for i, n in enumerate(names)], "i int, n string")
    got = {r.i: (r.a, r.b) for r in df.select("i", normal_form("n").alias("a"), tight_key("n").alias("b")).collect()}
    wrong = [(n, got[i][0], plain_rule(n)) for i, n in enumerate(names) if got[i][0] != plain_rule(n)]
    assert not wrong, wrong[:5]
    assert got[0] == ("santa barbara d oeste", "santabarbaradoeste")
    assert got[1][1] == got[0][1] and got[2] == ("embu guacu", "embuguacu") and got[6] == ("", "")


def test_quantiles_are_exact_for_hot_and_small_groups(spark):
    rng = random.Random(5)
    rows = [("hot", rng.gauss(0, 100)) for _ in range(6000)] + [("ties", float(rng.randrange(3))) for _ in range(900)]
    rows += [("skew", 0.0)] * 700 + [("skew", rng.random() * 1e9) for _ in range(301)]
    rows += [("signs", x) for x in (-3.5, -1e-300, 0.0, 1e-300, 2.0, -1e9, 7.25e8)]
    rows += [(f"g{i % 40}", rng.random()) for i in range(400)] + [("hot", None), (None, 4.0), (None, 6.0)]
    df = spark.createDataFrame(rows, "k string, v double").repartition(5)
    probs = {"a": 0.25, "m": 0.5, "z": 0.99}
    got = group_quantiles(df, ["k"], {n: ("v", p) for n, p in probs.items()}, also={"n": F.count("v")}).collect()
    builtin = df.groupBy("k").agg(*(F.percentile("v", F.lit(p)).alias(n) for n, p in probs.items())).collect()
    assert {(r.k, r.a, r.m, r.z) for r in got} == {(r.k, r.a, r.m, r.z) for r in builtin}
    want = {}
    for k, v in rows:
        want.setdefault(k, []).extend([] if v is None else [v])
    assert {r.k for r in got} == set(want) and len(got) == len(want)
    for r in got:
        assert r.n == len(want[r.k])
        for n, p in probs.items():
            assert math.isclose(r[n], float(np.quantile(want[r.k], p)), rel_tol=1e-12, abs_tol=1e-9), (r.k, n)


@pytest.mark.parametrize("small", [0, 1 << 16])
def test_quantiles_of_large_and_small_slices(spark, small):
    rng = random.Random(8)
    near = [-23.55 + rng.random() * 1e-6 for _ in range(3000)] + [0.0, -0.0, 5e-324, -5e-324, 1e308, -1e308, 1.5, 1.5, math.nextafter(1.5, 2)]
    rows = [(v, k % 3) for k, v in enumerate(near)] + [(float("inf"), 7), (1.0, 7), (float("inf"), 7), (2.5, None)]
    df = spark.createDataFrame(rows, "v double, k int").repartition(5)
    got = {r.k: r for r in group_quantiles(df, ["k"], {"a": ("v", 0.1), "m": ("v", 0.5), "t": ("v", 1.0)}, small=small).collect()}
    for k in (0, 1, 2):
        own = [v for v, g in rows if g == k]
        for name, p in (("a", 0.1), ("m", 0.5), ("t", 1.0)):
            assert math.isclose(got[k][name], float(np.quantile(own, p)), rel_tol=1e-15, abs_tol=1e-12), (k, name)
    assert (got[7].m, got[7].t, got[None].m) == (float("inf"), float("inf"), 2.5)


def test_close_values_share_no_large_step(spark):
    """A million latitudes within a thousandth of a degree: one slice, but no piece of more than a few."""
    df = spark.range(1_000_000).select((F.lit(-23.55) + F.col("id") * 1e-9).alias("v"))
    chain = quantiles.steps([], {"m": ("v", 0.5)})
    assert spark.sql(quantiles.sql_of(chain, "_slices"), df=df).count() <= 3
    pieces = spark.sql(quantiles.sql_of(chain, "_pieces"), df=df).agg(F.max("_n"), F.count(F.lit(1))).first()
    assert pieces[0] <= 8 and pieces[1] > 400_000
    got = group_quantiles(df, [], {"m": ("v", 0.5)}).first().m
    assert got == float(np.median(-23.55 + np.arange(1_000_000) * 1e-9))


def test_global_quantile_and_money_fence(spark):
    rng = random.Random(1)
    values = [rng.random() for _ in range(5001)]
    df = spark.createDataFrame([(v,) for v in values], "v double").repartition(4)
    got = group_quantiles(df, [], {"q": ("v", 0.75)}).first().q
    assert math.isclose(got, float(np.quantile(values, 0.75)), rel_tol=1e-12)
    from decimal import Decimal as D
    money = spark.createDataFrame([(D(x),) for x in ("1.01", "1.04", "1.10", "2.33")] + [(None,)], "m decimal(18,2)")
    q, rows = money_fence(money, "m")
    q = q.first()
    # Interpolation is cut to whole cents.
    assert (q.q1, q.q3, q.fence) == (D("1.03"), D("1.40"), D("1.955"))
    assert rows.count() == 5


def test_dense_ids_follow_byte_order_and_put_nulls_last(spark):
    names = [f"é{i}" for i in range(50)] + [f"z{i}" for i in range(300)] + ["Z", "a", "", "ç", None]
    df = spark.createDataFrame([(n, i) for i, n in enumerate(names)], "n string, x int").repartition(7)
    got = dense_ids(df, ["n"], "id", Workspace(spark)).orderBy("id").collect()
    want = sorted([n for n in names if n is not None], key=lambda s: s.encode()) + [None]
    assert [r.n for r in got] == want and [r.id for r in got] == list(range(1, len(names) + 1))


def test_nearest_within_equals_brute_force(spark):
    rng = random.Random(9)
    probes = [(f"p{i}", rng.choice("AB"), rng.uniform(-85, 85), rng.uniform(-180, 180)) for i in range(150)]
    probes += [(f"q{i}", "A", rng.uniform(-1, 1), rng.choice([-179.9, 179.9, 0.0])) for i in range(60)]
    probes += [(f"r{i}", "A", rng.uniform(88.5, 90), rng.uniform(-180, 180)) for i in range(40)] + [("none", "A", None, 1.0)]
    targets = []
    for i, (_, b, la, lo) in enumerate(probes[:-1]):
        for _ in range(2):
            t_lng = lo + rng.uniform(-0.9, 0.9) / max(math.cos(math.radians(la)), 0.01)
            targets.append((f"t{i:04d}{rng.random():.3f}", rng.choice("AB"), max(-90.0, min(90.0, la + rng.uniform(-0.9, 0.9))),
                            (t_lng + 180) % 360 - 180))
    p = spark.createDataFrame(probes, "id string, b string, latitude double, longitude double")
    t = spark.createDataFrame(targets, "code string, b string, latitude double, longitude double")
    got = {r.id: (r.code, round(r.distancia_km, 6)) for r in
           matching.nearest_within(p, t, block="b", code="code", radius_km=50).collect()}

    def km(a, b, c, d):
        h = math.sin(math.radians(c - a) / 2) ** 2 + math.cos(math.radians(a)) * math.cos(math.radians(c)) * math.sin(math.radians(d - b) / 2) ** 2
        return 2 * EARTH_KM * math.asin(math.sqrt(h))

    want = {}
    for i, b, la, lo in probes[:-1]:
        near = sorted((km(la, lo, x, y), c) for c, bb, x, y in targets if bb == b)
        if near and near[0][0] <= 50:
            want[i] = (near[0][1], round(near[0][0], 6))
    assert got == want and len(want) > 100


def test_names_match_once_and_ambiguous_keys_never(spark):
    ref = spark.createDataFrame([("SP", "sao jose", "saojose", "1"), ("SP", "sa o jose", "saojose", "2"), ("SP", "embu guacu", "embuguacu", "3")],
                                "uf string, n string, k string, c string")
    rows = spark.createDataFrame([("a", "SP", "sao jose", "saojose"), ("b", "SP", "saojose", "saojose"), ("c", "SP", "embuguacu", "embuguacu"),
                                  ("d", "RJ", "sao jose", "saojose"), ("e", None, "x", "x")], "id string, uf string, n string, k string")
    got = {r.id: (r.x, r.y) for r in matching.match_names(rows, ref, block="uf", name="n", key="k", code="c", out_name="x", out_key="y").collect()}
    assert got == {"a": ("1", None), "b": (None, None), "c": (None, "3"), "d": (None, None), "e": (None, None)}


def test_picks(spark):
    pay = spark.createDataFrame([("o", "b", 1, 5.0), ("o", "a", 2, 5.0), ("o", "a", 7, 0.0), ("p", None, 1, None), ("p", "z", 3, None), ("q", "k", None, 1.0)],
                                "o string, t string, n int, v double")
    got = {r.o: tuple(r)[1:] for r in dominant(pay, "o", "t", "v", "n", total="s", rows="c", kinds="d", winner="w", winner_carried="wc").collect()}
    assert got == {"o": (10.0, 3, 2, "a", 7), "p": (None, 2, 1, "z", 3), "q": (1.0, 1, 1, "k", None)}
    rev = spark.createDataFrame([("o", 1, None, "a", 5), ("o", 1, 2, "b", 4), ("o", None, 9, "c", 3), ("p", 1, 1, "x", 1), ("p", 1, 1, "y", 2), ("s", 1, 1, "k", 1)],
                                "o string, d int, e int, id string, nota int")
    got = {r.o: (r.id, r.nota, r.dup) for r in latest(rev, "o", ["d", "e", "id"], ["nota"], "dup").collect()}
    assert got == {"o": ("b", 4, True), "p": ("y", 2, True), "s": ("k", 1, False)}
    counts = spark.createDataFrame([("p", "b", "X", 3), ("p", "a", "Y", 3), ("p", "a", "X", 3), ("q", "z", "X", 0)], "k string, c string, u string, n long")
    got = {r.k: r.m for r in counts.groupBy("k").agg(most_frequent("n", ["c", "u"]).alias("m")).collect()}
    assert (got["p"].c, got["p"].u) == ("a", "X") and got["q"] is None


def test_imputation_needs_support_per_measure(spark):
    rows = [(str(i), "cat", 100.0 if i < 5 else None, 10.0 if i < 5 else None, 20.0 if i < 4 else None, None) for i in range(6)]
    df = spark.createDataFrame(rows, "id string, c string, w double, l double, h double, b double")
    got = {r.id: r for r in impute_medians(df, "c", ["w", "l", "h", "b"]).collect()}
    r = got["5"]
    assert (r.w, r.l, r.h, r.b, r._filled_w, r._filled_h) == (100.0, 10.0, None, None, True, False)
    assert not got["4"]._filled_l


def test_bands_sums_and_days(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", None), ("b", 2.0), ("b", 0.5)], "k string, v double")
    got = {r.k: r.s for r in df.groupBy("k").agg(S.known_sum("v").alias("s")).collect()}
    assert got["a"] is None and float(got["b"]) == 2.5
    row = spark.sql("select timestamp_ntz'2020-01-01 23:00:00' a, timestamp_ntz'2020-01-02 01:00:00' b").select(S.day_gap("a", "b").alias("d"))
    assert row.first().d == 1
    with pytest.raises(Exception):
        spark.createDataFrame([("x1",)], "t string").select(S.typed("t", "int")).collect()
    got = [r.b for r in spark.createDataFrame([(None,), (0,), (1,), (3,), (13,)], "n int").select(
        S.band("n", ((1, "1"), (3, "2_3")), "mais", "nada", floor=1).alias("b")).collect()]
    assert got == ["nada", "nada", "1", "2_3", "mais"]


def test_lasting_ids(spark):
    ws = Workspace(spark)

    def rows(*names):
        return spark.createDataFrame([(n, n and n.upper()) for n in names], "n string, label string")

    first = lasting_ids(rows("m", "x", None), ["n"], "k", ws)
    assert {r.n: r.k for r in first.collect()} == {"m": 1, "x": 2, None: 3}
    taken = all_ids(first, ["n"], "k")
    # an earlier name, a later one, and "x" is gone
    second = lasting_ids(rows("a", "m", None, "z"), ["n"], "k", ws, taken)
    assert {r.n: (r.k, r.label) for r in second.collect()} == {"m": (1, "M"), None: (3, None), "a": (4, "A"), "z": (5, "Z")}
    # a number that is free again is not given again; "x" comes back to its own
    third = lasting_ids(rows("x", "b"), ["n"], "k", ws, all_ids(second, ["n"], "k", taken))
    assert {r.n: r.k for r in third.collect()} == {"x": 2, "b": 6}


def test_integrity_and_signature(spark):
    a = spark.createDataFrame([("1", "x"), ("2", None), ("3", "y"), ("3", "y")], "id string, fk string")
    b = spark.createDataFrame([("x",)], "pk string")
    assert orphans(a, "fk", b, "pk").count() == 2
    assert repeated(a, ["id"]).collect()[0].id == "3"
    assert one_sided(a.select("id").distinct(), spark.createDataFrame([("1",), ("9",)], "id string"), [("id", "id")]).count() == 3
    first = signature(a, "t").first()
    assert first == signature(a.orderBy(F.desc("id")).repartition(3), "t").first()
    assert first != signature(a.fillna(""), "t").first() and first != signature(a.distinct(), "t").first()
    assert signature(a.filter("false"), "t").first().linhas == 0
    parts = merged(signature(a.filter("id < '3'"), "t"), signature(a.filter("id >= '3'"), "t")).first()
    assert parts == first and merged(signature(a.filter("false"), "t"), signature(a, "t")).first() == first
    apart = spark.createDataFrame([("1:a", "b")], "a string, b string"), spark.createDataFrame([("1", "a1:b")], "a string, b string")
    assert signature(apart[0], "t").first() != signature(apart[1], "t").first()
    doubles = spark.createDataFrame([(1.5, None), (float("nan"), 1e300), (-0.0, 2.0)], "v double, w double")
    assert signature(doubles, "d").first().s1 == signature(doubles.replace(-0.0, 0.0), "d").first().s1
    x = spark.createDataFrame([("a", 1), ("b", 2), (None, 0)], "n string, s int")
    y = spark.createDataFrame([("a", 1), ("b", 3), (None, 0), ("c", 4)], "n string, s int")
    assert {tuple(r) for r in key_changes(x, y, "n", "s").collect()} == {("b", 2, 3), ("c", None, 4)}


def test_haversine_known_distance(spark):
    d = spark.range(1).select(haversine_km(F.lit(0.0), F.lit(0.0), F.lit(0.0), F.lit(1.0)).alias("d")).first().d
    assert math.isclose(d, math.pi / 180 * EARTH_KM, rel_tol=1e-12)
    assert Grid(50).height * math.pi / 180 * EARTH_KM > 50
