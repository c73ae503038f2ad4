"""Exact, linearly interpolated quantiles per group, by one road for groups of every size.

The wanted ranks are found by narrowing. Values are counted once. The counts are summed over slices of the value axis
whose logarithms agree to 1/4096 of an octave; running sums over a group's slices tell in which one a wanted rank
lies. A slice of many values is cut again, evenly between its smallest and its largest value, and running sums tell the
piece. The values of a small slice, or of one piece, are walked through. A slice holds fewer than 2**41 doubles and a piece a 2**20th of them, so a running sum meets at most
2**24 rows and the last walk at most 2**21 values, however many values there are and however close together they lie;
close values share a slice, but not a piece. Every step is a partial aggregate, so one hot group is summed on the map
side; nothing runs while the plan is built, and the steps are one SQL text, so the plan is analysed once.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_PER_OCTAVE = 4096
_OCTAVES = 1100  # doubles reach down to 2**-1074
PIECES = 1 << 20
#: A slice of more values than this is cut.
SMALL = 1 << 16

Spec = Mapping[str, tuple[str, float]]

# A whole number that never falls when the value rises.
_SIZE = f"cast(floor(if(isnan(_v), {2 * _OCTAVES}, least(log2(abs(_v)), {_OCTAVES}D)) * {_PER_OCTAVE}) as bigint) + {_PER_OCTAVE * _OCTAVES}"
_SLICE = f"case when _v = 0 then 0 when _v < 0 then -({_SIZE}) else {_SIZE} end"
# The place of a value among even pieces between the ends of its slice; never falls when the value rises.
_PIECE = f"if(t._least = t._most, 0, floor((v._v - t._least) / (t._most - t._least) * {PIECES}))"


def steps(keys: Sequence[str], spec: Spec, small: int = SMALL) -> dict[str, str]:
    """The narrowing, step by step: name -> SELECT over ``{df}`` and the steps before."""
    columns = list(dict.fromkeys(c for c, _ in spec.values()))
    by = "".join(f"`{k}`, " for k in keys)
    alike = " and ".join([*(f"v.`{k}` <=> t.`{k}`" for k in keys), "v._i = t._i", "v._s = t._s"])
    own = "".join(f"v.`{k}`, " for k in keys) + "v._i, v._s"
    cells = ", ".join(f"struct({i} as _i, cast(`{c}` as double) as _v)" for i, c in enumerate(columns))
    wanted = ", ".join(f"struct({q} as _q, {columns.index(c)} as _of, {float(p)!r}D as _p)" for q, (c, p) in enumerate(spec.values()))
    running = "order by {} rows between unbounded preceding and current row"
    rank = "explode(array_distinct(array(floor(_pos), ceil(_pos)))) as _rank"
    ends = ", ".join(f"{f}(if(_q = {q}, {c}, null)) as {n}{q}" for q in range(len(spec)) for n, f, c in (
        ("_a", "min", "_value"), ("_b", "max", "_value"), ("_p", "max", "_pos")))
    between = ", ".join(f"if(_a{q} = _b{q}, _a{q}, (ceil(_p{q}) - _p{q}) * _a{q} + (_p{q} - floor(_p{q})) * _b{q}) as `{name}`" for q, name in enumerate(spec))
    return {
        "_cells": f"select {by}inline(array({cells})) from {{df}}",
        "_values": f"select {by}_i, _v, _c, {_SLICE} as _s from (select {by}_i, _v, count(1) as _c from _cells where _v is not null group by {by}_i, _v)",
        "_slices": f"""select {by}_i, _s, _n, _m, _least, _most, sum(_n) over (partition by {by}_i {running.format('_s')}) as _upto, sum(_n) over (partition by {by}_i) as _total
          from (select {by}_i, _s, sum(_c) as _n, count(1) as _m, min(_v) as _least, max(_v) as _most from _values group by {by}_i, _s)""",
        "_targets": f"""select * from (select {by}_i, _s, _q, _pos, _upto - _n as _before, _upto, _m, _least, _most, {rank} from (
          select *, _w._q as _q, (_total - 1) * _w._p as _pos from (select *, explode(array({wanted})) as _w from _slices) where _w._of = _i))
          where _before <= _rank and _rank < _upto""",
        # Where no slice is large, this road is known to be empty at run time and costs nothing.
        "_pieces": f"""select {by}_i, _s, _q, _rank, _d, _n, _pos, _base, _least, _most, sum(_n) over (partition by {by}_i, _s, _q, _rank {running.format('_d')}) as _upto
          from (select {own}, t._q, t._rank, {_PIECE} as _d, sum(v._c) as _n, first(t._pos) as _pos, first(t._before) as _base, first(t._least) as _least, first(t._most) as _most
            from _values v join _targets t on {alike} where t._m > {small} group by {own}, t._q, t._rank, {_PIECE})""",
        "_found": f"""select {by}_i, _s, _q, _rank, _pos, _before, _least, _most, cast(null as bigint) as _piece from _targets where _m <= {small} union all
          select {by}_i, _s, _q, _rank, _pos, _base + _upto - _n, _least, _most, _d from _pieces where _base + _upto - _n <= _rank and _rank < _base + _upto""",
        "_walked": f"""select {own}, t._q, t._rank, first(t._pos) as _pos, aggregate(array_sort(collect_list(struct(v._v, v._c))),
            named_struct('upto', first(t._before), 'v', cast(null as double)),
            (now, x) -> named_struct('upto', now.upto + x._c, 'v', if(now.upto <= t._rank, x._v, now.v)), now -> now.v) as _value
          from _values v join _found t on {alike} where t._piece is null or {_PIECE} = t._piece group by {own}, t._q, t._rank""",
        "_ends": f"select {by}{ends} from _walked" + (f" group by {by[:-2]}" if keys else ""),
        "_result": f"select {by}{between} from _ends",
    }


def sql_of(chain: Mapping[str, str], last: str) -> str:
    names = list(chain)[:list(chain).index(last) + 1]
    return "with " + ", ".join(f"{n} as ({chain[n]})" for n in names) + f" select * from {last}"


def group_quantiles(df: DataFrame, keys: Sequence[str], spec: Spec, also: Mapping[str, Column] | None = None,
                    small: int = SMALL) -> DataFrame:
    """``spec``: output name -> (numeric column, probability). NULL values are left out.

    ``also`` holds further aggregates to compute beside the quantiles.
    """
    keys, also = list(keys), dict(also or {})
    columns = list(dict.fromkeys([*keys, *(c for c, _ in spec.values())]))
    found = df.sparkSession.sql(sql_of(steps(keys, spec, small), "_result"), df=df.select(*columns))

    # groups without any value, and the other aggregates
    own = {k: f"_g{i}" for i, k in enumerate(keys)}
    groups = df.groupBy(*keys).agg(*(c.alias(name) for name, c in also.items()), F.count(F.lit(1)).alias("_rows"))
    right = found.select(*(F.col(k).alias(n) for k, n in own.items()), *spec)
    alike = F.lit(True)
    for k, n in own.items():
        alike = alike & F.col(k).eqNullSafe(F.col(n))
    return groups.join(right, alike, "left").select(*keys, *spec, *also)


def money_fence(df: DataFrame, column: str, reach: float = 1.5) -> tuple[DataFrame, DataFrame]:
    """Quartiles of a decimal(18,2) amount, cut to whole cents, and the upper Tukey fence.

    Returns (one-row quartiles, rows with the fence joined on).
    """
    cents = df.select((F.col(column) * 100).cast("bigint").alias("_cents"))
    q = group_quantiles(cents, [], {"_a": ("_cents", 0.25), "_b": ("_cents", 0.75)})

    def whole(c: str):
        return (F.floor(F.round(F.col(c), 6)).cast("decimal(18,0)") / F.lit(100)).cast("decimal(18,2)")

    quartiles = q.select(whole("_a").alias("q1"), whole("_b").alias("q3"))
    quartiles = quartiles.withColumn(
        "fence", F.col("q3") + F.lit(reach).cast("decimal(2,1)") * (F.col("q3") - F.col("q1")))
    return quartiles, df.crossJoin(F.broadcast(quartiles))  # exactly one row is broadcast
