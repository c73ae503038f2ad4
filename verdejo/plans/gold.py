"""The star schema: six dimensions with an unknown member, two facts."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import scalar as S
from ..operators.integrity import one_sided, orphans
from ..operators.keys import all_ids, lasting_ids
from ..session import Lazy, Workspace
from .silver import DELIVERED, SIZE_MISSING

Tables = dict[str, DataFrame]

# Calendar limits, names and band labels of the published tables.
CALENDAR_FROM, CALENDAR_TO = date(2016, 1, 1), date(2018, 12, 31)
WEEKDAYS = ("segunda-feira", "terça-feira", "quarta-feira", "quinta-feira", "sexta-feira", "sábado", "domingo")
MONTHS = ("janeiro", "fevereiro", "março", "abril", "maio", "junho", "julho", "agosto", "setembro",
          "outubro", "novembro", "dezembro")
WEIGHT_STEPS = ((1000, "ate_1kg"), (5000, "1_a_5kg"), (20000, "5_a_20kg"))
WEIGHT_ABOVE = "acima_20kg"
INSTALMENT_STEPS = ((1, "1_parcela"), (3, "2_a_3"), (6, "4_a_6"), (12, "7_a_12"))
INSTALMENT_ABOVE = "acima_12"
UNRESOLVED = "nao_resolvido"
MOMENTS = ("ts_compra", "ts_aprovacao", "ts_envio_transportadora", "ts_entrega_cliente", "ts_estimativa_entrega", "ano_mes_compra")  # in no fact

KEYS = {
    "dim_tempo": ("sk_tempo",), "dim_produto": ("sk_produto",), "dim_cliente": ("sk_cliente",),
    "dim_vendedor": ("sk_vendedor",), "dim_geografia": ("sk_geografia",), "dim_pagamento": ("sk_pagamento",),
    "fato_pedido": ("order_id",), "fato_item_pedido": ("order_id", "order_item_id"),
}
#: What a dimension's keys are given to; the numbers ever given are published beside it.
NATURAL = {
    "dim_tempo": ("data_completa",), "dim_cliente": ("customer_unique_id",), "dim_produto": ("product_id",),
    "dim_geografia": ("cod_ibge",), "dim_vendedor": ("seller_id",), "dim_pagamento": ("tipo_pagamento", "quantidade_parcelas"),
}
KEY_MAPS = {f"chaves_{dim}": dim for dim in NATURAL}
# (fact, foreign key, dimension, key)
FOREIGN_KEYS = tuple(
    (fact, fk, dim, KEYS[dim][0])
    for fact, pairs in {
        "fato_pedido": (("sk_tempo_compra", "dim_tempo"), ("sk_tempo_entrega", "dim_tempo"),
                        ("sk_cliente", "dim_cliente"), ("sk_geo_cliente", "dim_geografia"),
                        ("sk_pagamento", "dim_pagamento")),
        "fato_item_pedido": (("sk_tempo_compra", "dim_tempo"), ("sk_tempo_entrega", "dim_tempo"),
                             ("sk_produto", "dim_produto"), ("sk_cliente", "dim_cliente"),
                             ("sk_vendedor", "dim_vendedor"), ("sk_geo_cliente", "dim_geografia"),
                             ("sk_pagamento", "dim_pagamento")),
    }.items() for fk, dim in pairs)


def with_unknown(dim: DataFrame, key: str, **labels: str) -> DataFrame:
    """Append the single member with key 0 that stands for a missing reference."""
    values = {key: 0, **labels}
    row = dim.sparkSession.range(1).select(
        *[F.lit(values.get(f.name)).cast(f.dataType).alias(f.name) for f in dim.schema])
    return dim.unionByName(row)


def _ids(rows: DataFrame, dim: str, ws: Workspace, known: Tables | None) -> DataFrame:
    return lasting_ids(rows, NATURAL[dim], KEYS[dim][0], ws, (known or {}).get(dim))


def calendar(orders: DataFrame, first: date = CALENDAR_FROM, last: date = CALENDAR_TO, known: DataFrame | None = None, ws: Workspace | None = None) -> DataFrame:
    """One row per day over the fixed range, widened by the purchase and delivery days found. Known days keep their keys."""
    bought, came = F.to_date("ts_compra"), F.to_date("ts_entrega_cliente")
    limits = orders.agg(
        F.least(F.lit(first), F.min(bought), F.min(came)).alias("_from"),
        F.greatest(F.lit(last), F.max(bought), F.max(came)).alias("_to"))
    day = F.col("data_completa")
    weekday = F.extract(F.lit("DAYOFWEEK_ISO"), day)
    days = limits.select("_from", F.explode(F.sequence("_from", "_to")).alias("data_completa"))
    dim = days.select(
        (F.datediff(day, F.col("_from")) + 1).alias("sk_tempo"), day, F.dayofmonth(day).alias("dia"),
        F.element_at(F.array(*map(F.lit, WEEKDAYS)), weekday).alias("nome_dia_semana"),
        weekday.alias("numero_dia_semana"), F.weekofyear(day).alias("semana_ano"), F.month(day).alias("mes"),
        F.element_at(F.array(*map(F.lit, MONTHS)), F.month(day)).alias("nome_mes"),
        F.quarter(day).alias("trimestre"), F.year(day).alias("ano"), S.month_label(day).alias("ano_mes"),
        (weekday >= 6).alias("fim_de_semana"))
    if known is not None:
        dim = lasting_ids(dim.drop("sk_tempo"), NATURAL["dim_tempo"], "sk_tempo", ws, known)
    n = S.NOT_INFORMED
    return with_unknown(dim, "sk_tempo", nome_dia_semana=n, nome_mes=n, ano_mes=n)


def dim_customer(s: Tables, ws: Workspace, known: Tables | None = None) -> DataFrame:
    people = s["clientes"].select("customer_unique_id").distinct()
    return with_unknown(_ids(people, "dim_cliente", ws, known), "sk_cliente")


def dim_product(s: Tables, ws: Workspace, known: Tables | None = None) -> DataFrame:
    rows = s["produtos"].select(
        "product_id", F.col("categoria_produto").alias("categoria_pt"),
        F.col("categoria_produto_ingles").alias("categoria_en"), F.col("peso_g").alias("peso_gramas"),
        "comprimento_cm", "altura_cm", "largura_cm",
        (F.col("comprimento_cm") * F.col("altura_cm") * F.col("largura_cm")).alias("volume_cm3"),
        S.band("peso_g", WEIGHT_STEPS, WEIGHT_ABOVE, S.NOT_INFORMED).alias("faixa_peso"),
        F.col("flag_peso_imputado").alias("peso_imputado"),
        F.col("flag_dimensoes_imputadas").alias("dimensoes_imputadas"), "flag_categoria_sem_traducao")
    n = S.NOT_INFORMED
    return with_unknown(_ids(rows, "dim_produto", ws, known), "sk_produto",
                        categoria_pt=n, categoria_en=n, faixa_peso=n)


def dim_geography(s: Tables, ws: Workspace, known: Tables | None = None) -> DataFrame:
    rows = s["geografia_integrada"].select(
        "cod_ibge", "municipio", "uf", "nome_uf", "regiao", "populacao_estimada", "pib_per_capita",
        "porte_municipio", "ano_referencia_indicadores", "latitude_representativa", "longitude_representativa")
    n = S.NOT_INFORMED
    return with_unknown(_ids(rows, "dim_geografia", ws, known), "sk_geografia",
                        municipio=n, uf=n, nome_uf=n, regiao=n, porte_municipio=SIZE_MISSING)


def dim_seller(s: Tables, ws: Workspace, known: Tables | None = None) -> DataFrame:
    how = s["vendedores_municipios"].select(F.col("seller_id").alias("_s"), "cod_ibge", "metodo_match")
    place = s["geografia_integrada"].select(F.col("cod_ibge").alias("_c"), F.col("uf").alias("_uf"), "municipio", "regiao")
    rows = (s["vendedores"].join(how, F.col("seller_id") == F.col("_s"))
            .join(place, F.col("cod_ibge") == F.col("_c"), "left")
            .select("seller_id", "cidade", F.coalesce("_uf", "uf").alias("uf"), "cod_ibge",
                    F.col("municipio").alias("municipio_ibge"), "regiao",
                    F.col("metodo_match").alias("metodo_match_municipio")))
    n = S.NOT_INFORMED
    return with_unknown(_ids(rows, "dim_vendedor", ws, known), "sk_vendedor",
                        cidade=n, uf=n, municipio_ibge=n, regiao=n, metodo_match_municipio=UNRESOLVED)


def dim_payment(s: Tables, ws: Workspace, known: Tables | None = None) -> DataFrame:
    kind, count = F.col("tipo_pagamento_predominante"), F.col("parcelas_tipo_predominante")
    pairs = (s["pagamentos"].filter(kind.isNotNull() | count.isNotNull())
             .select(kind.alias("tipo_pagamento"), count.alias("quantidade_parcelas")).distinct()
             .withColumn("faixa_parcelas", S.band("quantidade_parcelas", INSTALMENT_STEPS, INSTALMENT_ABOVE,
                                                  S.NOT_INFORMED, floor=1)))
    ids = _ids(pairs, "dim_pagamento", ws, known)
    return with_unknown(ids, "sk_pagamento", faixa_parcelas=S.NOT_INFORMED)


Keep = Callable[[str, DataFrame], DataFrame]


def dimension_builders(s: Tables, ws: Workspace, known: Tables | None = None) -> dict[str, Callable[[], DataFrame]]:
    days = (known or {}).get("dim_tempo")
    return {
        "dim_tempo": lambda: calendar(s["pedidos"], known=days, ws=ws), "dim_cliente": lambda: dim_customer(s, ws, known),
        "dim_produto": lambda: dim_product(s, ws, known), "dim_geografia": lambda: dim_geography(s, ws, known),
        "dim_vendedor": lambda: dim_seller(s, ws, known), "dim_pagamento": lambda: dim_payment(s, ws, known),
    }


def _known(c: str) -> F.Column:
    return F.coalesce(F.col(c), F.lit(0))


def order_context(s: Tables, dims: Tables) -> DataFrame:
    """Order with every key it implies; nothing one-to-many takes part."""
    people = dims["dim_cliente"].select(F.col("customer_unique_id").alias("_u"), "sk_cliente")
    places = dims["dim_geografia"].select(F.col("cod_ibge").alias("_g"), F.col("sk_geografia").alias("sk_geo_cliente"))
    how = s["clientes_municipios"].select(
        F.col("customer_id").alias("_m"), "cod_ibge", F.col("metodo_match").alias("metodo_match_municipio"))
    buyers = (s["clientes"].select(F.col("customer_id").alias("_c"), "customer_unique_id")
              .join(how, F.col("_c") == F.col("_m"))
              .join(people, F.col("customer_unique_id") == F.col("_u"), "left")
              .join(places, F.col("cod_ibge") == F.col("_g"), "left")
              .select("_c", "sk_cliente", "sk_geo_cliente", "metodo_match_municipio"))

    modes = dims["dim_pagamento"].select("sk_pagamento", "tipo_pagamento", "quantidade_parcelas")
    paid = s["pagamentos"].join(
        modes, F.col("tipo_pagamento").eqNullSafe(F.col("tipo_pagamento_predominante"))
        & F.col("quantidade_parcelas").eqNullSafe(F.col("parcelas_tipo_predominante")), "left"
    ).select(F.col("order_id").alias("_p"), "sk_pagamento", "valor_total_pago")
    rated = s["avaliacoes"].select(F.col("order_id").alias("_r"), F.col("nota_review").alias("nota_avaliacao"))

    # A calendar has one row per day, so it stays small at any data volume.
    days = dims["dim_tempo"].select("sk_tempo", "data_completa")
    bought = F.broadcast(days.select(F.col("sk_tempo").alias("sk_tempo_compra"), F.col("data_completa").alias("_dc")))
    came = F.broadcast(days.select(F.col("sk_tempo").alias("sk_tempo_entrega"), F.col("data_completa").alias("_de")))
    arrival = F.when(F.col("status_pedido") == DELIVERED, F.to_date("ts_entrega_cliente"))

    joined = (s["pedidos"].join(buyers, F.col("customer_id") == F.col("_c"))
              .join(bought, F.to_date("ts_compra") == F.col("_dc"), "left")
              .join(came, arrival == F.col("_de"), "left")
              .join(paid, F.col("order_id") == F.col("_p"), "left")
              .join(rated, F.col("order_id") == F.col("_r"), "left"))
    return joined.select(
        *s["pedidos"].columns, _known("sk_tempo_compra").alias("sk_tempo_compra"),
        _known("sk_tempo_entrega").alias("sk_tempo_entrega"), _known("sk_cliente").alias("sk_cliente"),
        _known("sk_geo_cliente").alias("sk_geo_cliente"), _known("sk_pagamento").alias("sk_pagamento"),
        "nota_avaliacao", F.col("_r").isNotNull().alias("flag_possui_avaliacao"), "valor_total_pago",
        "metodo_match_municipio")


def _sums() -> list[F.Column]:
    return [F.count(F.lit(1)).alias("quantidade_itens"),
            S.known_sum("preco_produto").alias("valor_produtos"), S.known_sum("valor_frete").alias("valor_frete"),
            S.known_sum("valor_total_item").alias("valor_total_pedido")]


def order_totals(items: DataFrame) -> DataFrame:
    return items.groupBy(F.col("order_id").alias("_i")).agg(*_sums())


def order_sales(items: DataFrame, orders: DataFrame) -> DataFrame:
    """Totals of the orders that have items, and how many different sellers and products their items have.

    The join lays the items out by order, once for the totals and both counts, and splits an order that is too large for a
    task; then the rows that follow are dealt out again, by (order, seller) and so on.
    """
    sold = items.select(F.col("order_id").alias("_i"), "seller_id", "product_id", "preco_produto", "valor_frete", "valor_total_item").join(
        orders.select("order_id").distinct().hint("merge"), F.col("_i") == F.col("order_id")).drop("order_id")
    kinds = {"quantidade_vendedores": "seller_id", "quantidade_produtos": "product_id"}
    for name, of in kinds.items():
        place = F.row_number().over(Window.partitionBy("_i", of).orderBy("_i"))
        sold = sold.withColumn(name, F.col(of).isNotNull() & (place == 1))
    return sold.groupBy("_i").agg(*_sums(), *(F.count_if(name).alias(name) for name in kinds))


def fact_orders(context: DataFrame, items: DataFrame, orders: DataFrame | None = None) -> DataFrame:
    """An order without items totals 0; an order with an unknown part has an unknown total.

    ``orders`` holds at least the context's orders; the context itself by default.
    """
    joined = context.join(order_sales(items, context if orders is None else orders), F.col("order_id") == F.col("_i"), "left")
    none = F.col("_i").isNull()

    def total(c: str) -> F.Column:
        return F.when(none, F.lit(0).cast(S.MONEY)).otherwise(F.col(c)).alias(c)

    def count(c: str) -> F.Column:
        return F.coalesce(F.col(c), F.lit(0).cast("bigint")).alias(c)

    return joined.select(
        "order_id", "sk_tempo_compra", "sk_tempo_entrega", "sk_cliente", "sk_geo_cliente", "sk_pagamento",
        "status_pedido", count("quantidade_itens"), count("quantidade_vendedores"), count("quantidade_produtos"),
        total("valor_produtos"), total("valor_frete"), total("valor_total_pedido"), "valor_total_pago",
        "dias_ate_entrega", "dias_atraso", "flag_atraso", "nota_avaliacao",
        (F.col("status_pedido") == DELIVERED).alias("flag_entregue"), "flag_possui_avaliacao",
        "flag_entrega_ausente", "metodo_match_municipio")


def fact_items(s: Tables, dims: Tables, order_fact: DataFrame) -> DataFrame:
    """Items with what their order implies; ``order_fact`` is the orders' fact or their context."""
    head = order_fact.select(
        F.col("order_id").alias("_o"), "sk_tempo_compra", "sk_tempo_entrega", "sk_cliente", "sk_geo_cliente",
        "sk_pagamento", "dias_ate_entrega", "dias_atraso", "flag_atraso", "nota_avaliacao")
    far = s["distancias_itens"].select(
        F.col("order_id").alias("_d"), F.col("order_item_id").alias("_di"), "distancia_km",
        "flag_distancia_calculada", "motivo_distancia_ausente")
    goods = dims["dim_produto"].select(F.col("product_id").alias("_pid"), "sk_produto")
    shops = dims["dim_vendedor"].select(F.col("seller_id").alias("_sid"), "sk_vendedor")
    # Numbers take the place of names while a row is short; the join by order leaves a layout that the distances can follow,
    # also where few orders could be sent to all items: long rows would then move to meet the distances.
    joined = (s["itens_pedido"]
              .join(goods, F.col("product_id") == F.col("_pid"), "left")
              .join(shops, F.col("seller_id") == F.col("_sid"), "left")
              .join(head.hint("merge"), F.col("order_id") == F.col("_o"))
              .join(far, (F.col("order_id") == F.col("_d")) & (F.col("item_pedido_id") == F.col("_di"))))
    return joined.select(
        "order_id", F.col("item_pedido_id").alias("order_item_id"), "sk_tempo_compra", "sk_tempo_entrega",
        _known("sk_produto").alias("sk_produto"), "sk_cliente", _known("sk_vendedor").alias("sk_vendedor"),
        "sk_geo_cliente", "sk_pagamento", F.col("preco_produto").alias("valor_produto"), "valor_frete",
        "valor_total_item", "dias_ate_entrega", "dias_atraso", "flag_atraso", "distancia_km", "nota_avaliacao",
        F.col("flag_frete_outlier").alias("flag_outlier_frete"), "faixa_preco", "flag_distancia_calculada",
        "motivo_distancia_ausente")


# (table, reference, target, key)
REFERENCES = (
    ("pedidos", "customer_id", "clientes", "customer_id"), ("itens_pedido", "order_id", "pedidos", "order_id"),
    ("itens_pedido", "product_id", "produtos", "product_id"), ("itens_pedido", "seller_id", "vendedores", "seller_id"),
    ("pagamentos", "order_id", "pedidos", "order_id"), ("avaliacoes", "order_id", "pedidos", "order_id"),
    ("clientes_municipios", "cod_ibge", "geografia_integrada", "cod_ibge"),
    ("vendedores_municipios", "cod_ibge", "geografia_integrada", "cod_ibge"),
)
COVERAGES = (
    ("clientes", "clientes_municipios", (("customer_id", "customer_id"),)),
    ("vendedores", "vendedores_municipios", (("seller_id", "seller_id"),)),
    ("itens_pedido", "distancias_itens", (("order_id", "order_id"), ("item_pedido_id", "order_item_id"))),
)


def reference_problems(s: Tables) -> DataFrame:
    """(regra, encontrado): non-NULL references without a target, and one-sided coverage."""
    parts = []
    for table, fk, target, pk in REFERENCES:
        n = orphans(s[table], fk, s[target], pk).agg(F.count(F.lit(1)).alias("encontrado"))
        parts.append(n.select(F.lit(f"{table}.{fk} -> {target}.{pk}").alias("regra"), "encontrado"))
    for left, right, keys in COVERAGES:
        n = one_sided(s[left], s[right], keys).agg(F.count(F.lit(1)).alias("encontrado"))
        parts.append(n.select(F.lit(f"{left} <> {right}").alias("regra"), "encontrado"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def require_references(s: Tables) -> None:
    bad = reference_problems(s).filter("encontrado > 0").collect()
    if bad:
        raise ValueError("referencias inexistentes: " + "; ".join(f"{r.regra}: {r.encontrado}" for r in bad))


def build(s: Tables, ws: Workspace, keep: Keep | None = None, known: Tables | None = None) -> Tables:
    """Writes every table once through ``keep``; facts read the dimensions as written.

    ``known`` holds, by dimension, the keys ever given; their members keep them. The key maps are written beside the star.
    """
    return star(s, ws, keep, known).all()


def star(s: Tables, ws: Workspace, keep: Keep | None = None, known: Tables | None = None) -> Lazy:
    """The tables of ``build``, each written when it is asked for, with what it reads.

    The context of the orders is written once beside them: the items need no totals of their orders.
    """
    aside = Lazy({"contexto": lambda: order_context(s, out).drop(*MOMENTS)}, ws.keep)
    out = Lazy({
        **dimension_builders(s, ws, known),
        **{m: lambda m=m, dim=dim: all_ids(out[dim], NATURAL[dim], KEYS[dim][0], (known or {}).get(dim)) for m, dim in KEY_MAPS.items()},
        "fato_pedido": lambda: fact_orders(aside["contexto"], s["itens_pedido"], s["pedidos"]),
        "fato_item_pedido": lambda: fact_items(s, out, aside["contexto"]),
    }, keep or ws.keep)
    return out
