"""One row per key: dominant, latest and most frequent, as partial aggregates.

All three are min/max over a struct, so a hot key is reduced on the map side
and never sorted in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def ascending(c: str | Column) -> list[Column]:
    c = F.col(c) if isinstance(c, str) else c
    return [c.isNull(), c]


def descending(number: str | Column) -> list[Column]:
    c = F.col(number) if isinstance(number, str) else number
    return [c.isNull(), -c]


def _struct(cols: Sequence[Column]) -> Column:
    return F.struct(*[c.alias(f"f{i}") for i, c in enumerate(cols)])


def dominant(df: DataFrame, key: str, kind: str, value: str, carried: str, *, total: str,
             rows: str, kinds: str, winner: str, winner_carried: str) -> DataFrame:
    """Per key: total value, row count, distinct kinds, and the kind with the largest sum.

    Ties go to the alphabetically first kind. ``carried`` is the maximum of that
    column within the winning kind.
    """
    by_kind = df.groupBy(key, kind).agg(
        F.sum(value).alias("_sum"), F.max(carried).alias("_carried"), F.count(F.lit(1)).alias("_n"))
    best = F.min(_struct([*descending("_sum"), *ascending(kind), F.col("_carried")]))
    return by_kind.groupBy(key).agg(
        F.sum("_sum").alias(total), F.sum("_n").alias(rows), F.count(kind).alias(kinds), best.alias("_best")
    ).select(key, total, rows, kinds,
             F.col("_best.f3").alias(winner), F.col("_best.f4").alias(winner_carried))


def latest(df: DataFrame, key: str, order: Sequence[str], carried: Sequence[str],
           repeated_flag: str) -> DataFrame:
    """Per key the row with the greatest ``order`` columns, NULLs last, and whether there were more."""
    cols = [*order, *carried]
    return df.groupBy(key).agg(
        F.max(F.struct(*cols)).alias("_last"), (F.count(F.lit(1)) > 1).alias(repeated_flag)
    ).select(key, *[F.col(f"_last.{c}").alias(c) for c in cols], repeated_flag)


def most_frequent(n: str, labels: Sequence[str]) -> Column:
    """Aggregate over pre-counted labels: highest count, ties by label order. Zero counts never win."""
    order = [-F.col(n), *[x for label in labels for x in ascending(label)]]
    return F.min(F.when(F.col(n) > 0, F.struct(_struct(order).alias("order"), *labels)))
