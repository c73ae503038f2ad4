"""KPI catalogue: every indicator with its base, whole or split by any dimension."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from typing import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import scalar as S
from .silver import DELIVERED

Tables = dict[str, DataFrame]
ORDER, ITEM = "order", "item"

# Chosen band limits; the catalogue leaves them open.
DISTANCE_STEPS = ((100, "ate_100km"), (500, "100_a_500km"), (1000, "500_a_1000km"), (2000, "1000_a_2000km"))
GDP_STEPS = ((15000, "ate_15mil"), (30000, "15_a_30mil"), (45000, "30_a_45mil"))


@dataclass(frozen=True)
class Kpi:
    code: str
    grain: str
    delivered: bool
    value: Callable[[], Column]
    base: Callable[[], Column]


def _count() -> Column:
    return F.count(F.lit(1))


def _sum(c: str) -> Callable[[], Column]:
    return lambda: S.money(F.sum(c))


def _avg(c: str, when: Callable[[], Column] | None = None, fn=lambda x: x) -> Callable[[], Column]:
    def build() -> Column:
        v = fn(F.col(c)) if when is None else F.when(when(), fn(F.col(c)))
        return F.round(S.mean(v), 6)
    return build


def _n(c: str, when: Callable[[], Column] | None = None) -> Callable[[], Column]:
    return lambda: F.count(F.col(c) if when is None else F.when(when(), F.col(c)))


def _share(part: Callable[[], Column], whole: Callable[[], Column]) -> Callable[[], Column]:
    return lambda: F.round(S.percent(part(), whole()), 6)


_score = _n("nota_avaliacao")

KPIS = {k.code: k for k in (
    Kpi("VEN-001", ITEM, False, _sum("valor_total_item"), _n("valor_total_item")),
    Kpi("VEN-002", ITEM, True, _sum("valor_total_item"), _n("valor_total_item")),
    Kpi("VEN-003", ITEM, True, _sum("valor_produto"), _n("valor_produto")),
    Kpi("VEN-004", ITEM, True, _sum("valor_frete"), _n("valor_frete")),
    Kpi("VEN-005", ORDER, False, _count, _count),
    Kpi("VEN-005-ENTREGUES", ORDER, True, _count, _count),
    Kpi("VEN-006", ITEM, False, _count, _count),
    Kpi("VEN-007", ORDER, True, _avg("valor_total_pedido"), _n("valor_total_pedido")),
    Kpi("VEN-008", ORDER, True, _avg("quantidade_itens"), _count),
    Kpi("FRE-001", ITEM, True, _share(lambda: F.sum("valor_frete"), lambda: F.sum("valor_total_item")), _n("valor_total_item")),
    Kpi("LOG-001", ORDER, True, _avg("dias_ate_entrega"), _n("dias_ate_entrega")),
    Kpi("LOG-002", ORDER, True, _share(lambda: F.count_if("flag_atraso"), _n("flag_atraso")), _n("flag_atraso")),
    Kpi("LOG-003", ORDER, True, _avg("dias_atraso", lambda: F.col("flag_atraso")), _n("dias_atraso", lambda: F.col("flag_atraso"))),
    Kpi("LOG-004", ORDER, True, _avg("dias_atraso", lambda: F.col("dias_atraso") < 0, F.abs),
        _n("dias_atraso", lambda: F.col("dias_atraso") < 0)),
    Kpi("LOG-005", ITEM, True, _avg("distancia_km"), _n("distancia_km")),
    Kpi("SAT-001", ORDER, False, _avg("nota_avaliacao"), _score),
    Kpi("SAT-002", ORDER, False, _share(lambda: F.count_if(F.col("nota_avaliacao") >= 4), _score), _score),
    Kpi("SAT-003", ORDER, False, _share(lambda: F.count_if(F.col("nota_avaliacao") <= 2), _score), _score),
    Kpi("SAT-004", ORDER, False, _share(_score, _count), _count),
    Kpi("CLI-001", ORDER, True, lambda: F.countDistinct(F.when(F.col("sk_cliente") != 0, F.col("sk_cliente"))), _count),
)}

# Analysis attribute -> (dimension, key of the dimension, foreign key in the fact). None: a fact column.
ATTRIBUTES = {
    **{a: ("dim_tempo", "sk_tempo", "sk_tempo_compra") for a in ("ano", "trimestre", "mes", "ano_mes", "nome_dia_semana")},
    **{a: ("dim_produto", "sk_produto", "sk_produto") for a in ("categoria_pt", "faixa_peso")},
    **{a: ("dim_geografia", "sk_geografia", "sk_geo_cliente") for a in ("municipio", "uf", "regiao", "porte_municipio")},
    **{a: ("dim_pagamento", "sk_pagamento", "sk_pagamento") for a in ("tipo_pagamento", "faixa_parcelas")},
    **{f"vendedor_{a}": ("dim_vendedor", "sk_vendedor", "sk_vendedor") for a in ("seller_id", "cidade", "uf", "regiao")},
    "faixa_preco": None,
}


def _rows(gold: Tables, kpi: Kpi) -> DataFrame:
    if kpi.grain == ORDER:
        orders = gold["fato_pedido"]
        return orders.filter(F.col("status_pedido") == DELIVERED) if kpi.delivered else orders
    items = gold["fato_item_pedido"]
    return _delivered_items(gold, items) if kpi.delivered else items


def _delivered_items(gold: Tables, items: DataFrame) -> DataFrame:
    # Only the ids of delivered orders travel.
    ids = gold["fato_pedido"].filter(F.col("status_pedido") == DELIVERED).select(F.col("order_id").alias("_o"))
    return items.join(ids, F.col("order_id") == F.col("_o")).drop("_o")


#: Attributes that an order has through its items; it may have several values of them.
OF_ITEMS = tuple(a for a, where in ATTRIBUTES.items() if where is None or where[0] in ("dim_produto", "dim_vendedor"))


def _labelled(gold: Tables, rows: DataFrame, by: Sequence[str]) -> DataFrame:
    for i, attribute in enumerate(by):
        where = ATTRIBUTES[attribute]
        if where is None:
            continue
        dim, key, fk = where
        column = attribute.removeprefix("vendedor_")
        labels = gold[dim].select(F.col(key).alias(f"_k{i}"), F.col(column).alias(attribute))
        rows = rows.join(labels, F.col(fk) == F.col(f"_k{i}"), "left")
    return rows


def bridge(gold: Tables, by: Sequence[str]) -> DataFrame:
    """``(_order, attributes...)``: each combination that an order has among its items, once."""
    keys = list(dict.fromkeys(a if ATTRIBUTES[a] is None else ATTRIBUTES[a][2] for a in by))
    # Keys are made distinct before the labels are joined, so an order of many like items is one row already.
    met = gold["fato_item_pedido"].select(F.col("order_id").alias("_order"), *keys).distinct()
    return _labelled(gold, met, by).select("_order", *by).distinct()


def measure(gold: Tables, code: str, by: Sequence[str] = ()) -> DataFrame:
    """(attributes..., valor, base) of one KPI, whole or per combination of attributes.

    An order KPI by attributes of items goes through the bridge: an order counts once in each group it has an item in,
    so groups overlap and their bases add up to more than the whole (see ``with_total``). Orders without items are in
    no such group.
    """
    kpi = KPIS[code]
    through = [a for a in by if a in OF_ITEMS] if kpi.grain == ORDER else []
    rows = _labelled(gold, _rows(gold, kpi), [a for a in by if a not in through])
    if through:
        rows = rows.join(bridge(gold, through), F.col("order_id") == F.col("_order"))
    return rows.groupBy(*by).agg(kpi.value().alias("valor"), kpi.base().alias("base"))


def with_total(gold: Tables, code: str, by: Sequence[str]) -> DataFrame:
    """``measure`` with the figure of all rows kept apart (``total``): what overlapping groups do not add up to."""
    groups = measure(gold, code, by).select(F.lit(False).alias("total"), *by, "valor", "base")
    whole = measure(gold, code)
    blank = [F.lit(None).cast(groups.schema[a].dataType).alias(a) for a in by]
    return groups.unionByName(whole.select(F.lit(True).alias("total"), *blank, "valor", "base"))


def repurchase(gold: Tables) -> DataFrame:
    """Share of buyers with more than one delivered order."""
    per_buyer = gold["fato_pedido"].filter((F.col("status_pedido") == DELIVERED) & (F.col("sk_cliente") != 0)).groupBy(
        "sk_cliente").agg(F.count(F.lit(1)).alias("_n"))
    return per_buyer.agg(F.round(S.percent(F.count_if(F.col("_n") > 1), _count()), 6).alias("valor"), _count().alias("base"))


def match_rate(maps: DataFrame) -> DataFrame:
    """Entities per match method with their share of all."""
    counts = maps.groupBy("metodo_match").agg(_count().alias("base"))
    total = counts.agg(F.sum("base").alias("_t"))  # at most four methods
    return counts.crossJoin(F.broadcast(total)).select(
        "metodo_match", F.round(S.percent(F.col("base"), F.col("_t")), 6).alias("valor"), "base")


def score_by_lateness(gold: Tables) -> DataFrame:
    rows = gold["fato_pedido"].filter((F.col("status_pedido") == DELIVERED) & F.col("flag_atraso").isNotNull()
                                      & F.col("nota_avaliacao").isNotNull())
    return rows.groupBy("flag_atraso").agg(F.round(S.mean("nota_avaliacao"), 6).alias("nota_media"), _count().alias("pedidos"))


def by_distance(gold: Tables) -> DataFrame:
    """Item view: lateness, days and score per distance band; orders weigh by their items."""
    rows = _delivered_items(gold, gold["fato_item_pedido"])
    banded = S.band("distancia_km", DISTANCE_STEPS, "acima_2000km", S.NOT_INFORMED)
    return rows.groupBy(banded.alias("faixa_distancia")).agg(
        _count().alias("itens"), F.round(S.percent(F.count_if("flag_atraso"), F.count("flag_atraso")), 6).alias("percentual_atraso"),
        F.round(S.mean("dias_ate_entrega"), 6).alias("prazo_medio"), F.round(S.mean("nota_avaliacao"), 6).alias("nota_media"))


def by_gdp(gold: Tables) -> DataFrame:
    banded = S.band("pib_per_capita", GDP_STEPS, "acima_45mil", S.NOT_INFORMED)
    places = gold["dim_geografia"].select(F.col("sk_geografia").alias("sk_geo_cliente"), banded.alias("faixa_pib"))
    rows = gold["fato_pedido"].filter(F.col("status_pedido") == DELIVERED).join(places, "sk_geo_cliente")
    return rows.groupBy("faixa_pib").agg(
        F.round(S.mean("valor_total_pedido"), 6).alias("ticket_medio"), F.count("valor_total_pedido").alias("pedidos"))


def categories(gold: Tables) -> DataFrame:
    """Per category; an order with several categories counts in each."""
    sums = gold["fato_item_pedido"].groupBy("sk_produto").agg(
        _count().alias("_n"), F.sum("valor_produto").alias("_vp"), F.sum("valor_total_item").alias("_vt"),
        F.sum("valor_frete").alias("_f"), F.count("valor_frete").alias("_fn"),
        F.sum("nota_avaliacao").alias("_s"), F.count("nota_avaliacao").alias("_sn"))
    names = gold["dim_produto"].select("sk_produto", "categoria_pt")
    return sums.join(names, "sk_produto").groupBy("categoria_pt").agg(
        F.sum("_n").alias("itens"), S.money(F.sum("_vp")).alias("valor_produtos"), S.money(F.sum("_vt")).alias("valor_total"),
        F.round(_ratio("_f", "_fn"), 6).alias("frete_medio"), F.round(_ratio("_s", "_sn"), 6).alias("nota_media"))


def _ratio(total: str, count: str) -> Column:
    return F.sum(total).cast("double") / F.nullif(F.sum(count).cast("double"), F.lit(0.0))


def seller_metrics(gold: Tables) -> DataFrame:
    """Per seller. One pass over the items; whether the order was delivered comes with its id."""
    status = gold["fato_pedido"].select(F.col("order_id").alias("_o"), (F.col("status_pedido") == DELIVERED).alias("_done"))
    rows = gold["fato_item_pedido"].join(status, F.col("order_id") == F.col("_o"))
    sums = rows.groupBy("sk_vendedor").agg(
        _count().alias("itens"), S.money(F.sum(F.when(F.col("_done"), F.col("valor_total_item")))).alias("valor_entregue"),
        F.round(S.mean("valor_frete"), 6).alias("frete_medio"), F.round(F.avg("distancia_km"), 6).alias("distancia_media"),
        F.round(S.percent(F.count_if("flag_atraso"), F.count("flag_atraso")), 6).alias("percentual_atraso"),
        F.round(S.mean("nota_avaliacao"), 6).alias("nota_media"))
    names = gold["dim_vendedor"].select("sk_vendedor", "seller_id", "uf")
    return names.join(sums, "sk_vendedor").select(
        "sk_vendedor", "seller_id", "uf", "itens", "valor_entregue", "frete_medio", "distancia_media",
        "percentual_atraso", "nota_media")
