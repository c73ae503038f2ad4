"""A star that is loaded again after its sources have grown: what an earlier load has numbered keeps its number."""

from __future__ import annotations

from collections import ChainMap
from collections.abc import Callable, Mapping
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import checks as C
from ..operators.keys import all_ids
from ..operators.signature import key_changes
from ..session import Lazy, Workspace, together
from . import gold

Tables = Mapping[str, DataFrame]

BUILDERS: dict[str, Callable[..., DataFrame]] = {
    "dim_cliente": gold.dim_customer, "dim_produto": gold.dim_product, "dim_vendedor": gold.dim_seller,
    "dim_geografia": gold.dim_geography, "dim_pagamento": gold.dim_payment,
}


def bought_before(s: Tables, day: date) -> Tables:
    """The contract tables as a load on that day would have found them: orders bought before it, and what they refer to."""
    orders = s["pedidos"].filter(F.col("ts_compra") < F.lit(day))
    ids = orders.select("order_id", "customer_id")

    def met(table: str, key: str, seen: DataFrame) -> DataFrame:
        return s[table].join(seen.select(F.col(key).alias("_seen")).distinct(), F.col(key) == F.col("_seen"), "left_semi")

    out = Lazy({
        "pedidos": lambda: orders, "itens_pedido": lambda: met("itens_pedido", "order_id", ids),
        "pagamentos": lambda: met("pagamentos", "order_id", ids), "clientes_municipios": lambda: met("clientes_municipios", "customer_id", ids),
        "clientes": lambda: met("clientes", "customer_id", ids), "produtos": lambda: met("produtos", "product_id", out["itens_pedido"]),
        "vendedores": lambda: met("vendedores", "seller_id", out["itens_pedido"]),
        "geografia_integrada": lambda: met("geografia_integrada", "cod_ibge", out["clientes_municipios"].filter("cod_ibge is not null"))})
    return ChainMap(out, s)


def load(s: Tables, ws: Workspace, known: Tables | None = None) -> Tables:
    return ws.keep_all({dim: build(s, ws, known) for dim, build in BUILDERS.items()})


def two_loads(s: Tables, ws: Workspace, day: date) -> tuple[Tables, Tables]:
    """Dimensions of the early load, and of the full load that was given its key maps."""
    early = load(bought_before(s, day), ws)
    maps = {dim: all_ids(df, gold.NATURAL[dim], gold.KEYS[dim][0]) for dim, df in early.items()}
    return early, load(s, ws, maps)


def grown_keys(s: Tables, ws: Workspace, day: date, dim: str) -> DataFrame:
    """Natural and surrogate keys of one dimension after both loads."""
    early = ws.keep(f"early-{dim}", BUILDERS[dim](bought_before(s, day), ws))
    known = {dim: all_ids(early, gold.NATURAL[dim], gold.KEYS[dim][0])}
    return BUILDERS[dim](s, ws, known).select(*gold.NATURAL[dim], gold.KEYS[dim][0])


def growth(s: Tables, ws: Workspace, day: date) -> DataFrame:
    """Per dimension: keys of the early and of the full load, keys that moved, numbers given twice, the highest number."""
    early, late = two_loads(s, ws, day)

    def row(dim: str) -> DataFrame:
        key, natural = gold.KEYS[dim][0], list(gold.NATURAL[dim])
        name = F.to_json(F.struct(*natural)).alias("_natural")
        moved = key_changes(early[dim].select(name, key), late[dim].select(name, key), "_natural", key).filter(F.col("antes").isNotNull())
        sizes = late[dim].agg(F.count(F.lit(1)).alias("depois"), F.max(key).cast("bigint").alias("maior"),
                              (F.count(F.lit(1)) - F.countDistinct(key)).alias("repetidas"))
        return early[dim].agg(F.count(F.lit(1)).alias("antes")).crossJoin(sizes).crossJoin(  # one row each
            moved.agg(F.count(F.lit(1)).alias("alteradas"))).select(F.lit(dim).alias("dimensao"), "antes", "depois", "maior", "alteradas", "repetidas")

    return C.union(together(row, BUILDERS))
