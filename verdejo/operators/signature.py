"""Content signature of a table that does not depend on row order or file layout, and can be merged from parts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Four numbers of 60 bits are taken from each row's digest; their sums are the signature.
PARTS, _DIGITS = 4, 15
PLACES = 6
_SUMS = [f"s{i}" for i in range(1, PARTS + 1)]


def _text(field: T.StructField) -> Column:
    """A value as text that any engine can write alike: doubles as decimals of ``PLACES`` places, half up."""
    value = F.col(f"`{field.name}`")
    if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
        plain = value.cast(T.DecimalType(38, PLACES)).cast("string")
        # What no decimal holds is written as the engine writes it.
        return F.when(F.isnan(value) | (F.abs(value) >= 1e30), value.cast("string")).otherwise(plain)
    return value.cast("string")


def _cell(field: T.StructField) -> Column:
    text = _text(field)
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def shape_of(schema: T.StructType) -> str:
    return ",".join(f"{f.name}:{f.dataType.simpleString()}" for f in schema)


def signature(df: DataFrame, table: str, **also: Column) -> DataFrame:
    """One row: row count, four sums over the rows' digests (240 bits in all), and a hash of the schema.

    A cell is its length in bytes and its text, or ``-`` for NULL, so no two rows of one schema share a text. Sums are
    partial aggregates; repeated rows change them. ``merged`` adds the signatures of parts. ``also`` holds further
    aggregates to compute in the same pass.
    """
    row = F.sha2(F.concat(F.lit(""), *(_cell(f) for f in df.schema)), 256)
    numbers = [F.conv(F.substring("_h", 1 + i * _DIGITS, _DIGITS), 16, 10).cast("decimal(20,0)") for i in range(PARTS)]
    sums = [F.coalesce(F.sum(x), F.lit(0)).cast("decimal(38,0)").cast("string").alias(s) for s, x in zip(_SUMS, numbers)]
    return df.select("*", row.alias("_h")).agg(F.count(F.lit(1)).alias("linhas"), *sums, *(c.alias(n) for n, c in also.items())).select(
        F.lit(table).alias("tabela"), "linhas", *_SUMS, F.md5(F.lit(shape_of(df.schema))).alias("esquema"), *also)


def merged(*parts: DataFrame) -> DataFrame:
    """The signatures of whole tables from those of their parts; parts of another schema stay apart."""
    rows = reduce(DataFrame.unionByName, parts)
    return rows.groupBy("tabela", "esquema").agg(
        F.sum("linhas").alias("linhas"), *(F.sum(F.col(s).cast("decimal(38,0)")).cast("decimal(38,0)").cast("string").alias(s) for s in _SUMS)
    ).select("tabela", "linhas", *_SUMS, "esquema")


def key_changes(before: DataFrame, after: DataFrame, natural: str, surrogate: str) -> DataFrame:
    """Natural keys whose surrogate differs between two loads, or that only one load has."""
    a = before.select(F.col(natural).alias("_na"), F.col(surrogate).alias("antes"))
    b = after.select(F.col(natural).alias("_nb"), F.col(surrogate).alias("depois"))
    return (a.join(b, F.col("_na").eqNullSafe(F.col("_nb")), "full")
            .filter(~F.col("antes").eqNullSafe(F.col("depois")))
            .select(F.coalesce("_na", "_nb").alias(natural), "antes", "depois"))
