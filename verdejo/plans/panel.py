"""Panel queries over the published star: one filtered order base, small grouped results."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, GroupedData
from pyspark.sql import functions as F

from ..functions import scalar as S
from .silver import DELIVERED

Tables = dict[str, DataFrame]
ALL = "Todas"
TOP = 10
SIZE_ORDER = ("Pequeno", "Médio", "Grande")


def _done():
    return F.col("status_pedido") == DELIVERED


def options(gold: Tables) -> DataFrame:
    """First and last purchase day and the states found."""
    # Both dimensions keep their size at any order volume; only keys of the fact are read.
    days = gold["dim_tempo"].select(F.col("sk_tempo").alias("sk_tempo_compra"), "data_completa")
    places = gold["dim_geografia"].select(F.col("sk_geografia").alias("sk_geo_cliente"), "uf")
    seen = gold["fato_pedido"].select("sk_tempo_compra", "sk_geo_cliente").distinct()
    return (seen.join(F.broadcast(days), "sk_tempo_compra").join(places, "sk_geo_cliente")
            .agg(F.min("data_completa").alias("inicio"), F.max("data_completa").alias("fim"),
                 F.array_join(F.sort_array(F.collect_set("uf")), ",").alias("ufs")))


def base(gold: Tables, start: str, end: str, state: str = ALL) -> DataFrame:
    """Orders bought between two days (both included), optionally of one state."""
    first, last = date.fromisoformat(start), date.fromisoformat(end)
    if first > last:
        raise ValueError(f"periodo invertido: {start} vem depois de {end}")
    days = gold["dim_tempo"].filter(F.col("data_completa").between(F.lit(first), F.lit(last))).select(
        F.col("sk_tempo").alias("sk_tempo_compra"), "data_completa", "ano_mes")
    places = gold["dim_geografia"].select(F.col("sk_geografia").alias("sk_geo_cliente"), "uf", "porte_municipio")
    if state != ALL:
        places = places.filter(F.col("uf") == state)
    return (gold["fato_pedido"].join(F.broadcast(days), "sk_tempo_compra").join(places, "sk_geo_cliente"))


def summary(orders: DataFrame | GroupedData, *more: Column) -> DataFrame:
    """The cards' sums over all orders, or over each group of a grouping; ``more`` are further aggregates."""
    done, late, score = _done(), F.col("flag_atraso"), F.col("nota_avaliacao")

    def gated(c: str):
        return F.when(done, F.col(c))

    return orders.agg(
        F.count(F.lit(1)).alias("pedidos_filtrados"), F.count_if(done).alias("entregues"),
        S.money(F.sum(gated("valor_total_pedido"))).alias("valor_entregue"),
        F.round(S.mean(gated("valor_total_pedido")), 6).alias("ticket"),
        F.count(gated("valor_total_pedido")).alias("base_ticket"),
        F.round(S.percent(F.sum(gated("valor_frete")), F.sum(gated("valor_total_pedido"))), 6).alias("percentual_frete"),
        F.round(S.mean(gated("dias_ate_entrega")), 6).alias("prazo"), F.count(gated("dias_ate_entrega")).alias("base_prazo"),
        F.round(S.percent(F.count_if(done & late), F.count(gated("flag_atraso"))), 6).alias("atraso"),
        F.count(gated("flag_atraso")).alias("base_atraso"), F.count_if(done & late).alias("atrasados"),
        F.round(S.mean(score), 6).alias("nota"), F.count(score).alias("avaliados"),
        F.round(S.percent(F.count_if(score >= 4), F.count(score)), 6).alias("positivas"),
        F.round(S.percent(F.count_if(score <= 2), F.count(score)), 6).alias("negativas"),
        F.round(S.percent(F.count(score), F.count(F.lit(1))), 6).alias("cobertura"), *more)


def delivered_items(orders: DataFrame, items: DataFrame, *columns: str) -> DataFrame:
    """Items of delivered orders of the base; only order ids travel from the order side."""
    ids = orders.filter(_done()).select(F.col("order_id").alias("_o"))
    return items.select("order_id", *columns).join(ids, F.col("order_id") == F.col("_o")).drop("_o")


def distance(orders: DataFrame, gold: Tables) -> DataFrame:
    return delivered_items(orders, gold["fato_item_pedido"], "distancia_km").agg(
        F.round(F.avg("distancia_km"), 6).alias("distancia"), F.count("distancia_km").alias("base_distancia"))


def monthly_value(orders: DataFrame, gold: Tables | None = None) -> DataFrame:
    return (orders.filter(_done()).groupBy(F.col("ano_mes").alias("nome"))
            .agg(S.money(F.sum("valor_total_pedido")).alias("valor"), F.count(F.lit(1)).alias("base")).orderBy("nome"))


def top_categories(orders: DataFrame, gold: Tables) -> DataFrame:
    """Best categories by item value; items are summed per product before the names are joined."""
    per_product = delivered_items(orders, gold["fato_item_pedido"], "sk_produto", "valor_total_item").groupBy(
        "sk_produto").agg(F.sum("valor_total_item").alias("_v"), F.count(F.lit(1)).alias("_n"))
    names = gold["dim_produto"].select("sk_produto", F.col("categoria_pt").alias("nome"))
    return (per_product.join(names, "sk_produto").groupBy("nome")
            .agg(S.money(F.sum("_v")).alias("valor"), F.sum("_n").alias("base"))
            .orderBy(F.col("valor").desc_nulls_last(), F.col("nome").asc_nulls_last()).limit(TOP))


def ticket_by_size(orders: DataFrame, gold: Tables | None = None) -> DataFrame:
    place = F.lit(len(SIZE_ORDER) + 1)
    for i, name in reversed(list(enumerate(SIZE_ORDER, 1))):
        place = F.when(F.col("nome") == name, i).otherwise(place)
    return (orders.filter(_done()).groupBy(F.col("porte_municipio").alias("nome"))
            .agg(F.round(S.mean("valor_total_pedido"), 6).alias("valor"), F.count("valor_total_pedido").alias("base"))
            .orderBy(place))


def late_by_state(orders: DataFrame, gold: Tables | None = None) -> DataFrame:
    return (orders.filter(_done() & F.col("flag_atraso").isNotNull()).groupBy(F.col("uf").alias("nome"))
            .agg(F.round(S.percent(F.count_if("flag_atraso"), F.count(F.lit(1))), 6).alias("valor"),
                 F.count(F.lit(1)).alias("base"))
            .orderBy(F.col("valor").desc_nulls_last(), F.col("nome").asc_nulls_last()))


def monthly_days(orders: DataFrame, gold: Tables | None = None) -> DataFrame:
    return (orders.filter(_done() & F.col("dias_ate_entrega").isNotNull()).groupBy(F.col("ano_mes").alias("nome"))
            .agg(F.round(S.mean("dias_ate_entrega"), 6).alias("valor"), F.count(F.lit(1)).alias("base")).orderBy("nome"))


def score_histogram(orders: DataFrame, gold: Tables | None = None) -> DataFrame:
    return (orders.filter(F.col("nota_avaliacao").isNotNull()).groupBy("nota_avaliacao")
            .agg(F.count(F.lit(1)).alias("valor")).orderBy("nota_avaliacao")
            .select(F.concat(F.col("nota_avaliacao").cast("string"), F.lit(" estrelas")).alias("nome"),
                    "valor", F.col("valor").alias("base")))


def score_by_lateness(orders: DataFrame, gold: Tables | None = None) -> DataFrame:
    label = F.when(F.col("flag_atraso"), "Com atraso").otherwise("No prazo")
    return (orders.filter(_done() & F.col("flag_atraso").isNotNull() & F.col("nota_avaliacao").isNotNull())
            .groupBy(label.alias("nome"))
            .agg(F.round(S.mean("nota_avaliacao"), 6).alias("valor"), F.count(F.lit(1)).alias("base")).orderBy("nome"))


CHARTS = {
    "mensal": monthly_value, "categorias": top_categories, "porte": ticket_by_size, "atraso_uf": late_by_state,
    "prazo_mensal": monthly_days, "notas": score_histogram, "nota_atraso": score_by_lateness,
}

# Cards (label, value column, base column) and charts (key, title) of each exported panel.
PANELS = {
    "comercial": (
        (("Valor entregue", "valor_entregue", "entregues"), ("Pedidos entregues", "entregues", None),
         ("Ticket médio", "ticket", "base_ticket"), ("Participação do frete", "percentual_frete", None)),
        (("mensal", "Valor entregue ao longo do tempo"), ("categorias", "Categorias que mais vendem"),
         ("porte", "Ticket médio por porte municipal"))),
    "logistica": (
        (("Prazo médio", "prazo", "base_prazo"), ("Entregas atrasadas", "atraso", "base_atraso"),
         ("Pedidos atrasados", "atrasados", None), ("Distância média", "distancia", "base_distancia")),
        (("prazo_mensal", "Evolução do prazo de entrega"), ("atraso_uf", "Atrasos por UF do cliente"))),
    "satisfacao": (
        (("Nota média", "nota", "avaliados"), ("Avaliações positivas", "positivas", "avaliados"),
         ("Cobertura de avaliações", "cobertura", "pedidos_filtrados"), ("Avaliações negativas", "negativas", "avaliados")),
        (("notas", "Distribuição das avaliações"), ("nota_atraso", "Prazo cumprido, experiência melhor?"))),
}


def _spoken(name: Column) -> Column:
    return F.when(name == S.NOT_INFORMED, "Não informado").otherwise(F.replace(name, F.lit("_"), F.lit(" ")))


#: What the charts group orders by; the empty set is the whole period.
_SETS = ("ano_mes", "porte_municipio", "uf", "nota_avaliacao", "flag_atraso")
# chart -> (set, value, base) over the sums of ``_order_sums``
_FROM_SUMS = {
    "mensal": ("ano_mes", "valor_entregue", "entregues"), "porte": ("porte_municipio", "ticket", "base_ticket"),
    "atraso_uf": ("uf", "atraso", "base_atraso"), "prazo_mensal": ("ano_mes", "prazo", "base_prazo"),
    "notas": ("nota_avaliacao", "pedidos_filtrados", "pedidos_filtrados"), "nota_atraso": ("flag_atraso", "nota_entregue", "base_nota_entregue"),
}


def _order_sums(orders: DataFrame) -> DataFrame:
    """The sums of ``summary`` for the whole period and for each group of each chart, from one reading of the orders."""
    sets = orders.groupingSets([[], *([c] for c in _SETS)], *_SETS)
    gated = F.when(_done(), F.col("nota_avaliacao"))
    return summary(sets, F.grouping_id().alias("_set"), F.round(S.mean(gated), 6).alias("nota_entregue"), F.count(gated).alias("base_nota_entregue"))


def _set_id(of: str | None) -> int:
    """What grouping_id is for one of the sets: a bit for each column that it leaves out."""
    return sum(1 << (len(_SETS) - 1 - i) for i, c in enumerate(_SETS) if c != of)


def _row(panel: str, section: str, group: Column, value: Column, base: Column, when: Column) -> Column:
    return F.when(when, F.struct(
        F.lit(panel).alias("painel"), F.lit(section).alias("secao"), group.alias("grupo"),
        F.round(value.cast("double"), 6).alias("valor"), base.cast("bigint").alias("base")))


def _order_rows(orders: DataFrame, panels) -> DataFrame:
    here = F.col("_set")
    label = {
        "nota_avaliacao": F.concat(F.col("nota_avaliacao").cast("string"), F.lit(" estrelas")),
        "flag_atraso": F.when(F.col("flag_atraso"), "Com atraso").otherwise("No prazo")}
    rows = []
    for p in panels:
        cards, charts = PANELS[p]
        rows += [_row(p, "KPI", F.lit(name), F.col(v), F.col(b) if b else F.lit(None), here == _set_id(None))
                 for name, v, b in cards if v != "distancia"]
        for key, title in charts:
            if key in _FROM_SUMS:
                of, v, b = _FROM_SUMS[key]
                # An attribute that is unknown is a bar only where the chart shows all orders of a kind.
                there = F.col("entregues" if key in ("mensal", "porte") else b) > 0
                named = F.lit(True) if key in ("mensal", "porte", "atraso_uf", "prazo_mensal") else F.col(of).isNotNull()
                rows.append(_row(p, title, _spoken(label.get(of, F.col(of))), F.col(v), F.col(b), (here == _set_id(of)) & there & named))
    return _order_sums(orders).select(F.explode(F.array_compact(F.array(*rows))).alias("r")).select("r.*")


def _item_rows(orders: DataFrame, gold: Tables, panels) -> DataFrame:
    """Distance of all items and the best categories, from one reading of the items: the total and ten names."""
    items = delivered_items(orders, gold["fato_item_pedido"], "sk_produto", "valor_total_item", "distancia_km")
    per_product = items.groupBy("sk_produto").agg(
        F.sum("valor_total_item").alias("_v"), F.count(F.lit(1)).alias("_n"), F.sum("distancia_km").alias("_d"), F.count("distancia_km").alias("_dn"))
    names = gold["dim_produto"].select("sk_produto", F.col("categoria_pt").alias("nome"))
    sums = per_product.join(names, "sk_produto").groupingSets([[], ["nome"]], "nome").agg(
        F.grouping_id().alias("_set"), S.money(F.sum("_v")).alias("_v"), F.sum("_n").alias("_n"),
        (F.sum("_d") / F.nullif(F.sum("_dn"), F.lit(0))).alias("_d"), F.coalesce(F.sum("_dn"), F.lit(0)).alias("_dn"))
    best = sums.orderBy(F.col("_set").desc(), F.col("_v").desc_nulls_last(), F.col("nome").asc_nulls_last()).limit(TOP + 1)
    rows = []
    for p in panels:
        cards, charts = PANELS[p]
        rows += [_row(p, "KPI", F.lit(name), F.col("_d"), F.col("_dn"), F.col("_set") == 1) for name, v, _ in cards if v == "distancia"]
        rows += [_row(p, title, _spoken(F.col("nome")), F.col("_v"), F.col("_n"), F.col("_set") == 0) for key, title in charts if key == "categorias"]
    return best.select(F.explode(F.array_compact(F.array(*rows))).alias("r")).select("r.*")


def export(gold: Tables, start: str, end: str, state: str = ALL, panels=tuple(PANELS)) -> DataFrame:
    """Cards and chart rows of the panels as one long table (painel, secao, grupo, valor, base).

    All cards and charts over orders come from one grouping by several sets at once, all over items from another, so
    orders are read once with their measures (and once more for the ids that choose the items), items once.
    """
    orders = base(gold, start, end, state)
    parts = [_order_rows(orders, panels)]
    if any(key == "categorias" for p in panels for key, _ in PANELS[p][1]) or any(v == "distancia" for p in panels for _, v, _ in PANELS[p][0]):
        parts.append(_item_rows(orders, gold, panels))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def write_export(table: DataFrame, path: str) -> None:
    table.write.mode("overwrite").option("header", True).option("sep", ";").option("quoteAll", True).csv(path)
