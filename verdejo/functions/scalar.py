"""Column helpers: typed cleaning, bands, gated measures, ratios."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"
NOT_INFORMED = "nao_informado"


def filled(c: str | Column) -> Column:
    """Text with blanks turned into NULL."""
    return F.nullif(F.trim(_col(c)), F.lit(""))


def typed(c: str | Column, kind: str) -> Column:
    """Blank becomes NULL, anything else must parse: bad text fails the job."""
    return filled(c).cast(kind)


def first_filled(*cols: str | Column) -> Column:
    return F.coalesce(*[filled(c) for c in cols])


def filled_or(c: str | Column, default: str = NOT_INFORMED) -> Column:
    return F.coalesce(filled(c), F.lit(default))


def day_gap(start: str | Column, end: str | Column) -> Column:
    """Calendar-day boundaries crossed from start to end."""
    return F.datediff(_col(end), _col(start)).cast("bigint")


def month_label(c: str | Column) -> Column:
    return F.date_format(_col(c), "yyyy-MM")


def band(value: str | Column, steps: Sequence[tuple], above: str, missing: str,
         floor: int | None = None) -> Column:
    """Label by ascending upper limits.

    A step is ``(limit, label)`` for value <= limit or ``(limit, label, "<")``.
    NULL, and anything under ``floor``, gets the ``missing`` label.
    """
    v = _col(value)
    absent = v.isNull() if floor is None else (v.isNull() | (v < floor))
    out = F.when(absent, F.lit(missing))
    for limit, label, *strict in steps:
        out = out.when((v < F.lit(limit)) if strict else (v <= F.lit(limit)), F.lit(label))
    return out.otherwise(F.lit(above))


def money(c: Column) -> Column:
    return c.cast(MONEY)


def known_sum(c: str | Column) -> Column:
    """Sum that is NULL as soon as one part is unknown."""
    v = _col(c)
    return F.when(F.count(v) == F.count(F.lit(1)), money(F.sum(v)))


def mean(c: str | Column) -> Column:
    return F.avg(_col(c).cast("double"))


def percent(part: Column, whole: Column) -> Column:
    """100 * part / whole as double, NULL on an empty base."""
    return F.lit(100.0) * part.cast("double") / F.nullif(whole.cast("double"), F.lit(0.0))


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c
