"""Table contracts: exact types, nullability and grain. Extra columns are allowed."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class Contract:
    """The columns that a table must have, as Spark DDL, and the columns that its rows are unique by (none: no key)."""

    grain: tuple[str, ...]
    ddl: str

    @property
    def schema(self) -> T.StructType:
        return T.StructType.fromDDL(self.ddl)


def shape_problems(df: DataFrame, contract: Contract, table: str) -> list[str]:
    """Wrong or missing types, from the schema alone."""
    actual = {f.name: f.dataType for f in df.schema}
    out = []
    for f in contract.schema:
        want, have = f.dataType.simpleString(), actual[f.name].simpleString() if f.name in actual else None
        if have is None:
            out.append(f"{table}: falta a coluna {f.name} ({want})")
        elif have != want:
            out.append(f"{table}: {f.name} veio como {have} e o contrato pede {want}")
    return out


def content_problems(df: DataFrame, contract: Contract, table: str) -> DataFrame:
    """(problema, encontrado): forbidden NULLs per column in one pass, and repeated keys."""
    must = [f.name for f in contract.schema if not f.nullable and f.name in df.columns]
    nulls = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in must]) if must else df.agg(F.lit(0).alias("_"))
    pairs = F.array(*[F.struct(F.lit(f"{table}: {c} sem valor").alias("problema"), F.col(c).alias("encontrado"))
                      for c in must]) if must else F.array(F.struct(F.lit(table).alias("problema"), F.lit(0).cast("bigint").alias("encontrado")))
    out = nulls.select(F.inline(pairs))
    if contract.grain and all(c in df.columns for c in contract.grain):
        twice = df.groupBy(*contract.grain).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").agg(
            F.count(F.lit(1)).alias("encontrado"))
        out = out.unionByName(twice.select(F.lit(f"{table}: mais de uma linha por ({', '.join(contract.grain)})")
                                           .alias("problema"), "encontrado"))
    return out


def verify(tables: Mapping[str, DataFrame | None], contracts: Mapping[str, Contract]) -> list[str]:
    """All problems as text; a row of counts for each table reaches the driver."""
    problems, content = [], None
    for name, contract in contracts.items():
        df = tables.get(name)
        if df is None:
            problems.append(f"{name}: tabela nao entregue")
            continue
        problems += shape_problems(df, contract, name)
        part = content_problems(df, contract, name)
        content = part if content is None else content.unionByName(part)
    if content is not None:
        problems += [f"{r.problema}: {r.encontrado}" for r in content.filter("encontrado > 0").collect()]
    return problems
