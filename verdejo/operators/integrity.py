"""Reference checks between tables: orphans, two-sided coverage, lost identifiers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def orphans(child: DataFrame, fk: str, parent: DataFrame, pk: str) -> DataFrame:
    """Rows with a non-NULL reference that has no parent."""
    keys = parent.select(F.col(pk).alias("_pk"))
    return child.filter(F.col(fk).isNotNull()).join(keys, F.col(fk) == F.col("_pk"), "left_anti")


def one_sided(left: DataFrame, right: DataFrame, keys: Sequence[tuple[str, str]]) -> DataFrame:
    """Rows of a full join that exist on one side only."""
    a = left.select(*[F.col(x).alias(f"_l{i}") for i, (x, _) in enumerate(keys)], F.lit(True).alias("_in_left"))
    b = right.select(*[F.col(y).alias(f"_r{i}") for i, (_, y) in enumerate(keys)], F.lit(True).alias("_in_right"))
    cond = F.lit(True)
    for i in range(len(keys)):
        cond = cond & (F.col(f"_l{i}") == F.col(f"_r{i}"))
    return a.join(b, cond, "full").filter(F.col("_in_left").isNull() | F.col("_in_right").isNull())


def repeated(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1")


def missing_ids(left: DataFrame, right: DataFrame, keys: Sequence[tuple[str, str]]) -> DataFrame:
    cond = F.lit(True)
    r = right.select(*[F.col(y).alias(f"_r{i}") for i, (_, y) in enumerate(keys)])
    for i, (x, _) in enumerate(keys):
        cond = cond & (F.col(x) == F.col(f"_r{i}"))
    return left.join(r, cond, "left_anti")
