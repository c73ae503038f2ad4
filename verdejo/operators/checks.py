"""Data checks as DataFrames: one result row per check.

All row predicates of a table share one aggregate. A check that cannot be
analysed (column gone, type changed) fails instead of stopping the run.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

PASSED, FAILED, ALERT, SKIPPED = "APROVADO", "REPROVADO", "ALERTA", "NAO EXECUTADO"
UNMEASURED = "nao mensuravel"
FIELDS = ("id", "categoria", "descricao", "esperado", "encontrado", "status", "detalhes")


@dataclass(frozen=True)
class Check:
    id: str
    category: str
    text: str
    on_fail: str = FAILED
    expected: str = "0"
    details: str = ""


def _text(value) -> str:
    return "" if value is None else str(value)


def literal(spark: SparkSession, check: Check, expected, found, status: str, details: str = "") -> DataFrame:
    values = (check.id, check.category, check.text, _text(expected), _text(found), status, details or check.details)
    return spark.range(1).select(*[F.lit(v).alias(n) for n, v in zip(FIELDS, values)])


def compared(spark: SparkSession, check: Check, expected, found, details: str = "") -> DataFrame:
    """A check on metadata, already known to the driver."""
    return literal(spark, check, expected, found, PASSED if expected == found else check.on_fail, details)


def skipped(spark: SparkSession, check: Check, reason: str) -> DataFrame:
    return literal(spark, check, "-", "-", SKIPPED, reason)


def _record(check: Check, expected: Column, found: Column, ok: Column, details: Column | None = None) -> Column:
    values = (F.lit(check.id), F.lit(check.category), F.lit(check.text), expected.cast("string"),
              F.coalesce(found.cast("string"), F.lit("")), F.when(ok, PASSED).otherwise(check.on_fail),
              F.coalesce(details, F.lit("")) if details is not None else F.lit(check.details))
    return F.struct(*[v.alias(n) for n, v in zip(FIELDS, values)])


def rows(df: DataFrame, checks: Sequence[tuple[Check, Callable[[], Column] | Column]]) -> DataFrame:
    """Counts the rows that break each predicate, in a single pass over ``df``."""
    usable, broken = [], []
    for check, predicate in checks:
        try:
            bad = predicate() if callable(predicate) and not isinstance(predicate, Column) else predicate
            df.select(F.count_if(bad))
            usable.append((check, bad))
        except AnalysisException as error:
            broken.append(literal(df.sparkSession, check, check.expected, UNMEASURED, FAILED,
                                  f"consulta falhou: {error.getCondition()}"))
    parts = list(broken)
    if usable:
        counts = df.agg(*[F.count_if(bad).alias(f"_{i}") for i, (_, bad) in enumerate(usable)])
        parts.append(counts.select(F.inline(F.array(*[
            _record(check, F.lit(check.expected), F.col(f"_{i}"), F.col(f"_{i}") == 0)
            for i, (check, _) in enumerate(usable)]))))
    return union(parts)


def empty(check: Check, build: Callable[[], DataFrame], spark: SparkSession) -> DataFrame:
    """Passes when the frame has no rows."""
    try:
        counted = build().agg(F.count(F.lit(1)).alias("_n"))
        return counted.select(F.inline(F.array(_record(check, F.lit(check.expected), F.col("_n"), F.col("_n") == 0))))
    except AnalysisException as error:
        return literal(spark, check, check.expected, UNMEASURED, FAILED, f"consulta falhou: {error.getCondition()}")


def equal(check: Check, expected: Callable[[], DataFrame], found: Callable[[], DataFrame], spark: SparkSession) -> DataFrame:
    """Compares two one-row, one-column frames, NULL equal to NULL."""
    try:
        a, b = expected(), found()
        a, b = a.toDF("_e"), b.toDF("_f")
        both = a.crossJoin(b)  # one row each
        return both.select(F.inline(F.array(_record(check, F.coalesce(F.col("_e").cast("string"), F.lit("")), F.col("_f"),
                                                    F.col("_e").eqNullSafe(F.col("_f"))))))
    except AnalysisException as error:
        return literal(spark, check, UNMEASURED, UNMEASURED, FAILED, f"consulta falhou: {error.getCondition()}")


def measured(check: Check, one_row: DataFrame, found: Column, ok: Column, details: Column | None = None) -> DataFrame:
    """A reported figure; ``ok`` decides between passed and ``on_fail``."""
    return one_row.select(F.inline(F.array(_record(check, F.lit(check.expected), found, ok, details))))


def union(parts: Sequence[DataFrame]) -> DataFrame:
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def outcome(results: DataFrame) -> DataFrame:
    """One row: the verdict and how many checks ended in each status."""
    s = F.col("status")
    counts = results.agg(
        F.count(F.lit(1)).alias("executados"), F.count_if(s == PASSED).alias("aprovados"),
        F.count_if(s == ALERT).alias("alertas"), F.count_if(s == FAILED).alias("reprovados"),
        F.count_if(s == SKIPPED).alias("nao_executados"))
    verdict = (F.when(F.col("reprovados") > 0, FAILED)
               .when(F.col("alertas") + F.col("nao_executados") > 0, "APROVADO COM ALERTAS").otherwise(PASSED))
    return counts.select(verdict.alias("resultado_geral"), "*")
