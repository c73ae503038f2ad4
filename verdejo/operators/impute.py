"""Fill gaps with the median of the group, only where the group has enough values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .quantiles import group_quantiles

MIN_SUPPORT = 5  # fixed value: observations needed before a median is trusted


def impute_medians(df: DataFrame, group: str, columns: Sequence[str],
                   min_support: int = MIN_SUPPORT) -> DataFrame:
    """Replaces gaps in ``columns`` and adds ``_filled_<column>`` flags.

    The flag says that the value was missing and the group median was trusted.
    """
    trusted = group_quantiles(
        df, [group], {f"_med_{c}": (c, 0.5) for c in columns},
        also={f"_n_{c}": F.count(c) for c in columns}
    ).select(
        F.col(group).alias("_group"),
        *[F.when(F.col(f"_n_{c}") >= min_support, F.col(f"_med_{c}")).alias(f"_use_{c}") for c in columns])
    joined = df.join(trusted, F.col(group) == F.col("_group"), "left")
    return joined.select(
        *[c for c in df.columns if c not in columns],
        *[F.coalesce(F.col(c), F.col(f"_use_{c}")).alias(c) for c in columns],
        *[(F.col(c).isNull() & F.col(f"_use_{c}").isNotNull()).alias(f"_filled_{c}") for c in columns])
