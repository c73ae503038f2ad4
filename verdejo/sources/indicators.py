"""Municipal indicators: statistical API responses and their consolidation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scalar as S
from ..operators.integrity import repeated

# Reference year and the markers that mean "no value".
YEAR = 2017
ABSENT = ("", "-", "..", "...", "X", "x")
LABEL = "Município (Código)"  # what the label record has in place of a code


def read_response(spark: SparkSession, path: str, year: int = YEAR) -> DataFrame:
    """A response file: a JSON array whose first record holds the column labels."""
    rows = spark.read.option("multiLine", True).option("primitivesAsString", True).json(path)
    return values(rows, year)


def values(rows: DataFrame, year: int = YEAR) -> DataFrame:
    """(codigo, valor) without the label record. Another year, a code that is none, or a repeated one stops the job."""
    coded = F.col("D1C").rlike("^[0-9]+$")
    data = rows.filter(~F.col("D1C").eqNullSafe(F.lit(LABEL)))
    malformed = data.filter(~F.coalesce(coded, F.lit(False))).limit(1).collect()
    if malformed:
        raise ValueError(f"codigo invalido {malformed[0].D1C}")
    strange = data.filter(~F.col("D3C").eqNullSafe(F.lit(str(year)))).limit(1).collect()
    if strange:
        raise ValueError(f"ano inesperado {strange[0].D3C} em {strange[0].D1C}")
    twice = repeated(data, ["D1C"]).limit(1).collect()
    if twice:
        raise ValueError(f"codigo duplicado {twice[0].D1C}")
    if not data.limit(1).collect():
        raise ValueError("resposta sem dados")
    text = F.trim("V")
    # The code test is repeated in the value, so a later cast never meets the label.
    return data.select(F.col("D1C").alias("codigo"), F.when(coded & ~text.isin(*ABSENT), text).alias("valor"))


def consolidate(population: DataFrame, gdp_thousands: DataFrame, year: int = YEAR) -> DataFrame:
    """Full outer join of both indicators; GDP per head to two decimals where it can be formed."""
    a = population.select(F.col("codigo").alias("_a"), F.col("valor").cast("bigint").alias("populacao_estimada"))
    b = gdp_thousands.select(F.col("codigo").alias("_b"), F.col("valor").cast("decimal(20,0)").alias("_gdp"))
    people = F.col("populacao_estimada")
    head = F.when(people > 0, (F.col("_gdp") * 1000 / people.cast("decimal(20,0)")).cast(S.MONEY))
    return a.join(b, F.col("_a") == F.col("_b"), "full").select(
        F.coalesce("_a", "_b").alias("cod_ibge"), F.lit(year).alias("ano_referencia"),
        "populacao_estimada", head.alias("pib_per_capita"))
