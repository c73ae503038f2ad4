"""Checks of the star schema before it is published, and its profiles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import scalar as S
from ..operators import checks as C
from ..operators.checks import Check
from ..operators.integrity import missing_ids, repeated
from ..operators.quantiles import group_quantiles, money_fence
from ..operators.signature import signature
from .gold import FOREIGN_KEYS, INSTALMENT_ABOVE, INSTALMENT_STEPS, KEYS
from .silver import DELIVERED

Tables = dict[str, DataFrame]
DECLARED_KEYS = 12
COVERED = (("dim_produto", "produtos", "product_id"), ("dim_cliente", "clientes", "customer_unique_id"),
           ("dim_vendedor", "vendedores", "seller_id"), ("dim_geografia", "geografia_integrada", "cod_ibge"))
ITEM_MEASURES = (("valor_produto", "preco_produto"), ("valor_frete", "valor_frete"), ("valor_total_item", "valor_total_item"))
ORDER_MEASURES = (("valor_produtos", "valor_produto"), ("valor_frete", "valor_frete"), ("valor_total_pedido", "valor_total_item"))


def _n(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("_n"))


def _differs(a: str | F.Column, b: str | F.Column) -> F.Column:
    a = F.col(a) if isinstance(a, str) else a
    return ~a.eqNullSafe(F.col(b) if isinstance(b, str) else b)


def _renamed(df: DataFrame, prefix: str, *columns: str) -> DataFrame:
    return df.select(*[F.col(c).alias(f"{prefix}{c}") for c in columns])


def structure(gold: Tables, s: Tables) -> DataFrame:
    spark = gold["fato_pedido"].sparkSession
    out = []
    for table, key in KEYS.items():
        out.append(C.empty(Check(f"Grao {table}", "Grao", f"{table}: 1 linha por ({', '.join(key)})"),
                           lambda t=table, k=key: repeated(gold[t], k), spark))
        if table.startswith("dim_"):
            members = gold[table].agg(F.count_if(F.col(key[0]) == 0).alias("_n"))
            out.append(C.measured(Check(f"Membro desconhecido {table}", "Grao", "Exatamente um membro 0", expected="1"),
                                  members, F.col("_n"), F.col("_n") == 1))
    for dim, table, natural in COVERED:
        out.append(C.equal(Check(f"Cobertura {dim}", "Cobertura", f"{natural} distintos mais um"),
                           lambda t=table, k=natural: s[t].agg(F.countDistinct(k) + 1), lambda d=dim: _n(gold[d]), spark))
        out.append(C.empty(Check(f"Chave natural {dim}", "Grao", f"{natural} unico"),
                           lambda d=dim, k=natural: repeated(gold[d], [k]), spark))
    out.append(C.empty(Check("Combinacao natural de pagamento", "Grao", "Tipo e parcelas unicos, com nulos"),
                       lambda: repeated(gold["dim_pagamento"], ["tipo_pagamento", "quantidade_parcelas"]), spark))
    out.append(C.compared(spark, Check("Quantidade de FKs declaradas", "Referencias", "Referencias declaradas"),
                          DECLARED_KEYS, len(FOREIGN_KEYS)))
    for fact, table in (("fato_item_pedido", "itens_pedido"), ("fato_pedido", "pedidos")):
        out.append(C.equal(Check(f"Contagem {fact}", "Contagem", f"Linhas iguais a {table}"),
                           lambda t=table: _n(s[t]), lambda f=fact: _n(gold[f]), spark))
    return C.union(out)


def foreign_keys(gold: Tables) -> DataFrame:
    """Keys of a fact without a member. The keys used are first reduced to their distinct values."""
    spark = gold["fato_pedido"].sparkSession

    def lost(fact: str, fk: str, dim: str, pk: str) -> DataFrame:
        used = gold[fact].groupBy(fk).agg(F.count(F.lit(1)).alias("_rows"))
        none = used.join(gold[dim].select(F.col(pk).alias("_pk")), F.col(fk) == F.col("_pk"), "left_anti")
        return none.agg(F.coalesce(F.sum("_rows"), F.lit(0)).alias("_n"))

    return C.union([
        C.measured(Check(f"FK {fact}.{fk}", "Referencias", f"{fact}.{fk} existe em {dim}"), lost(fact, fk, dim, pk),
                   F.col("_n"), F.col("_n") == 0) for fact, fk, dim, pk in FOREIGN_KEYS])


def unknown_use(gold: Tables) -> DataFrame:
    """How many rows of each fact point at the unknown member, one pass per fact."""
    out = None
    for fact in ("fato_pedido", "fato_item_pedido"):
        fks = [fk for f, fk, _, _ in FOREIGN_KEYS if f == fact]
        one = gold[fact].agg(*[F.count_if(F.col(k) == 0).alias(k) for k in fks]).select(F.inline(F.array(*[
            F.struct(F.lit(f"{fact}.{k}").alias("chave"), F.col(k).alias("linhas")) for k in fks])))
        out = one if out is None else out.unionByName(one)
    return out


def rules(gold: Tables) -> DataFrame:
    orders, items, c = gold["fato_pedido"], gold["fato_item_pedido"], F.col
    cat = "Regra de negocio"
    shared = ("sk_cliente", "sk_geo_cliente", "sk_tempo_compra", "sk_tempo_entrega", "sk_pagamento", "nota_avaliacao")
    head = _renamed(orders, "_", "order_id", *shared)
    different = c("_order_id").isNull()
    for k in shared:
        different = different | _differs(k, f"_{k}")
    return C.union([
        C.rows(items, [(Check("Total do item", cat, "Total igual a produto mais frete"),
                        lambda: _differs("valor_total_item", c("valor_produto") + c("valor_frete")))]),
        C.rows(orders, [
            (Check("Entregas elegiveis", cat, "Nao entregue sem prazo"),
             lambda: ~c("flag_entregue") & (c("dias_ate_entrega").isNotNull() | c("dias_atraso").isNotNull() | c("flag_atraso").isNotNull())),
            (Check("Flag de atraso", cat, "Flag igual ao sinal dos dias"), lambda: _differs("flag_atraso", c("dias_atraso") > 0)),
            (Check("Dominio da nota", cat, "Nota entre 1 e 5"), lambda: ~c("nota_avaliacao").between(1, 5))]),
        C.empty(Check("Contexto do pedido nos itens", cat, "Itens repetem o contexto do pedido"),
                lambda: items.join(head.hint("merge"), c("order_id") == c("_order_id"), "left").filter(different), items.sparkSession),
    ])


def reconciliation(gold: Tables, s: Tables) -> DataFrame:
    orders, items, c = gold["fato_pedido"], gold["fato_item_pedido"], F.col
    spark, cat, out = orders.sparkSession, "Reconciliacao", []

    # One full join compares the three measures of an item.
    clean = s["itens_pedido"].select(c("order_id").alias("_o"), c("item_pedido_id").alias("_i"),
                                     *[c(b).alias(f"_{b}") for _, b in ITEM_MEASURES])
    both = items.select("order_id", "order_item_id", *[a for a, _ in ITEM_MEASURES]).join(
        clean, (c("order_id") == c("_o")) & (c("order_item_id") == c("_i")), "full")
    alone = c("order_id").isNull() | c("_o").isNull()
    out.append(C.rows(both, [(Check(f"Valor por item {a}", cat, f"{a} igual ao da tabela limpa"),
                              lambda a=a, b=b: alone | _differs(a, f"_{b}")) for a, b in ITEM_MEASURES]))
    for a, b in ITEM_MEASURES:
        out.append(C.equal(Check(f"Soma {a}", cat, f"Soma de {a}"), lambda b=b: s["itens_pedido"].agg(S.money(F.sum(b))),
                           lambda a=a: items.agg(S.money(F.sum(a))), spark))
    totals = items.groupBy(c("order_id").alias("_o")).agg(*[S.known_sum(b).alias(f"_{a}") for a, b in ORDER_MEASURES])
    joined = orders.select("order_id", *[a for a, _ in ORDER_MEASURES]).join(totals, c("order_id") == c("_o"), "left")
    out.append(C.rows(joined, [(Check(f"Agregacao por pedido {a}", cat, f"{a} igual a soma dos itens"), lambda a=a: _differs(
        a, F.when(c("_o").isNull(), F.lit(0).cast(S.MONEY)).otherwise(c(f"_{a}")))) for a, _ in ORDER_MEASURES]))
    return C.union(out)


def preservation(gold: Tables, s: Tables) -> DataFrame:
    """Values carried from the cleaned tables: one join chain over orders, one over items.

    Tables of orders are merged, also where their files are small enough to be sent: their rows are many times as large in memory.
    """
    orders, items, c = gold["fato_pedido"], gold["fato_item_pedido"], F.col
    cat = "Preservacao"
    days = F.broadcast(gold["dim_tempo"].select("sk_tempo", "data_completa"))  # one row per day
    people = gold["dim_cliente"].select(c("sk_cliente").alias("_sc"), c("customer_unique_id").alias("_person"))
    places = gold["dim_geografia"].select(c("sk_geografia").alias("_sg"), c("cod_ibge").alias("_place"))
    buyers = (_renamed(s["clientes"], "_b", "customer_id", "customer_unique_id")
              .join(_renamed(s["clientes_municipios"], "_m", "customer_id", "cod_ibge"), c("_bcustomer_id") == c("_mcustomer_id")))
    joined = (orders
              .join(_renamed(s["pedidos"], "_p", "order_id", "customer_id", "status_pedido", "ts_compra", "ts_entrega_cliente",
                             "dias_ate_entrega", "dias_atraso", "flag_atraso").hint("merge"), c("order_id") == c("_porder_id"), "left")
              .join(_renamed(s["pagamentos"], "_g", "order_id", "valor_total_pago").hint("merge"), c("order_id") == c("_gorder_id"), "left")
              .join(_renamed(s["avaliacoes"], "_a", "order_id", "nota_review").hint("merge"), c("order_id") == c("_aorder_id"), "left")
              .join(buyers, c("_pcustomer_id") == c("_bcustomer_id"), "left")
              .join(people, c("sk_cliente") == c("_sc"), "left").join(places, c("sk_geo_cliente") == c("_sg"), "left")
              .join(days.select(c("sk_tempo").alias("_k1"), c("data_completa").alias("_bought")), c("sk_tempo_compra") == c("_k1"), "left")
              .join(days.select(c("sk_tempo").alias("_k2"), c("data_completa").alias("_came")), c("sk_tempo_entrega") == c("_k2"), "left"))
    known = c("_porder_id").isNotNull()
    arrived = F.when(c("_pstatus_pedido") == DELIVERED, F.to_date("_pts_entrega_cliente"))
    far = _renamed(s["distancias_itens"], "_d", "order_id", "order_item_id", "distancia_km")
    measured = items.select("order_id", "order_item_id", "distancia_km").join(
        far, (c("order_id") == c("_dorder_id")) & (c("order_item_id") == c("_dorder_item_id")))
    return C.union([
        C.rows(joined, [
            (Check("Pagamento nao multiplicado", cat, "Valor pago igual ao consolidado"),
             lambda: _differs("valor_total_pago", "_gvalor_total_pago")),
            (Check("Avaliacao por pedido preservada", cat, "Nota igual a consolidada"), lambda: _differs("nota_avaliacao", "_anota_review")),
            (Check("Prazos preservados", cat, "Prazos iguais"), lambda: known & (
                _differs("dias_ate_entrega", "_pdias_ate_entrega") | _differs("dias_atraso", "_pdias_atraso")
                | _differs("flag_atraso", "_pflag_atraso"))),
            (Check("Cliente persistente e endereco por pedido", cat, "Pessoa e municipio iguais"),
             lambda: c("_bcustomer_id").isNotNull() & (_differs("_person", "_bcustomer_unique_id") | _differs("_place", "_mcod_ibge"))),
            (Check("Tempo de compra", cat, "Dia da compra"), lambda: known & _differs("_bought", F.to_date("_pts_compra"))),
            (Check("Tempo de entrega", cat, "Dia da entrega"), lambda: known & _differs("_came", arrived)),
        ]),
        C.rows(measured, [(Check("Distancia oficial preservada", cat, "Distancia igual"),
                           lambda: _differs("distancia_km", "_ddistancia_km"))]),
    ])


def analyse(gold: Tables, s: Tables) -> DataFrame:
    """All 59 checks, one row each."""
    return C.union(families(gold, s))


def families(gold: Tables, s: Tables) -> list[DataFrame]:
    """The checks of ``analyse`` in parts that can run one after the other: no plan then holds the joins of all."""
    return [structure(gold, s), foreign_keys(gold), rules(gold), reconciliation(gold, s), preservation(gold, s)]


def counts(gold: Tables) -> DataFrame:
    return C.union([_n(df).select(F.lit(t).alias("tabela"), F.col("_n").alias("linhas")) for t, df in ((t, gold[t]) for t in KEYS)])


def signatures(gold: Tables) -> DataFrame:
    return C.union([signature(gold[t], t) for t in KEYS])


def match_coverage(s: Tables) -> DataFrame:
    return C.union([s[f"{e}_municipios"].groupBy("metodo_match").agg(F.count(F.lit(1)).alias("entidades"))
                    .select(F.lit(e).alias("entidade"), "metodo_match", "entidades") for e in ("clientes", "vendedores")])


# -- profiles ----------------------------------------------------------------

def distance_profile(gold: Tables) -> DataFrame:
    spec = {"mediana": ("distancia_km", 0.5), "p95": ("distancia_km", 0.95), "p99": ("distancia_km", 0.99)}
    d = F.col("distancia_km")
    q = group_quantiles(gold["fato_item_pedido"].select("distancia_km"), [], spec, also={
        "com_distancia": F.count(d), "sem_distancia": F.count_if(d.isNull()),
        "minima": F.min(d), "media": F.avg(d), "maxima": F.max(d)})
    return q.select("com_distancia", "sem_distancia", *[
        F.round(F.col(c), 6).alias(c) for c in ("minima", "mediana", "media", "p95", "p99", "maxima")])


def freight_profile(items: DataFrame) -> DataFrame:
    """Fence, flagged share and spread of freight. Values are never cut."""
    v = F.col("valor_frete")
    quartiles, _ = money_fence(items, "valor_frete")
    spread = group_quantiles(items.select("valor_frete", "flag_frete_outlier").withColumn("_d", v.cast("double")), [],
                             {"mediana": ("_d", 0.5), "p99": ("_d", 0.99)}, also={
        "itens": F.count(F.lit(1)), "sinalizados": F.count_if("flag_frete_outlier"),
        "minimo": F.min(v), "maximo": F.max(v), "soma": S.money(F.sum(v))})
    return quartiles.crossJoin(spread).select(  # one row each
        "q1", "q3", F.col("fence").alias("cerca"), "itens", "sinalizados",
        F.round(S.percent(F.col("sinalizados"), F.col("itens")), 6).alias("percentual"), "minimo",
        F.round("mediana", 6).alias("mediana"), F.round("p99", 6).alias("p99"), "maximo", "soma",
        F.lit(False).alias("winsorizacao"))


def product_profile(gold: Tables) -> DataFrame:
    """Incomplete products and the items sold of them; items are counted per product first."""
    c = F.col
    sold = gold["fato_item_pedido"].groupBy(c("sk_produto").alias("_k")).agg(F.count(F.lit(1)).alias("_n"))
    gap = c("comprimento_cm").isNull() | c("altura_cm").isNull() | c("largura_cm").isNull()
    conds = {"categoria_nao_informada": c("categoria_pt") == S.NOT_INFORMED, "peso_imputado": c("peso_imputado"),
             "dimensoes_imputadas": c("dimensoes_imputadas"), "peso_nulo": c("peso_gramas").isNull(), "dimensoes_nulas": gap}
    rows = gold["dim_produto"].filter("sk_produto <> 0").join(sold, c("sk_produto") == c("_k"), "left")
    figures = []
    for name, cond in conds.items():
        figures += [F.count_if(cond).alias(name), F.sum(F.when(cond, F.coalesce("_n", F.lit(0))).otherwise(0)).alias(f"{name}_itens")]
    return rows.agg(*figures).select(F.inline(F.array(*[F.struct(
        F.lit(n).alias("situacao"), c(n).alias("produtos"), c(f"{n}_itens").alias("itens")) for n in conds])))


def unreviewed(gold: Tables) -> DataFrame:
    none = F.col("nota_avaliacao").isNull()
    return gold["fato_pedido"].agg(F.count(F.lit(1)).alias("pedidos"), F.count_if(none).alias("sem_avaliacao"),
                                   F.round(S.percent(F.count_if(none), F.count(F.lit(1))), 6).alias("percentual"))


def mixed_scores(gold: Tables) -> DataFrame:
    score = F.col("nota_avaliacao")
    return gold["fato_item_pedido"].groupBy("order_id").agg(F.min(score).alias("_a"), F.max(score).alias("_b")).agg(
        F.count_if(F.col("_a") != F.col("_b")).alias("pedidos_inconsistentes"))


def lost_ids(gold: Tables, s: Tables) -> DataFrame:
    pairs = (("pedidos", "fato_pedido", (("order_id", "order_id"),)),
             ("itens_pedido", "fato_item_pedido", (("order_id", "order_id"), ("item_pedido_id", "order_item_id"))))
    out = []
    for clean, fact, on in pairs:
        back = tuple((b, a) for a, b in on)
        out.append(_n(missing_ids(s[clean], gold[fact], on)).select(F.lit(f"{clean} fora de {fact}").alias("caso"), F.col("_n").alias("linhas")))
        out.append(_n(missing_ids(gold[fact], s[clean], back)).select(F.lit(f"{fact} fora de {clean}").alias("caso"), F.col("_n").alias("linhas")))
    return C.union(out)


def payment_controls(gold: Tables, s: Tables) -> DataFrame:
    c, cat = F.col, "Pagamentos"
    pays, spark = s["pagamentos"], s["pagamentos"].sparkSession
    band = S.band("quantidade_parcelas", INSTALMENT_STEPS, INSTALMENT_ABOVE, S.NOT_INFORMED, floor=1)
    kinds = gold["dim_pagamento"].select(c("tipo_pagamento").alias("_t")).distinct()
    unpaid = gold["fato_pedido"].join(pays.select(c("order_id").alias("_o")), c("order_id") == c("_o"), "left_anti")
    return C.union([
        C.empty(Check("PAG-001", cat, "Um registro por pedido"), lambda: repeated(pays, ["order_id"]), spark),
        C.empty(Check("PAG-002", cat, "Tipo dentro do conjunto observado"), lambda: pays.filter(
            "tipo_pagamento_predominante is not null").join(kinds, c("tipo_pagamento_predominante") == c("_t"), "left_anti"), spark),
        C.rows(pays, [(Check("PAG-003", cat, "Parcelas nunca negativas"), c("parcelas_tipo_predominante") < 0)]),
        C.rows(gold["dim_pagamento"], [(Check("PAG-004", cat, "Faixa coerente com a quantidade"), _differs("faixa_parcelas", band))]),
        C.rows(unpaid, [(Check("PAG-005", cat, "Pedido sem pagamento no membro tecnico"), c("sk_pagamento") != 0)]),
    ])


def places_without_indicators(gold: Tables, s: Tables) -> DataFrame:
    c = F.col
    bare = gold["dim_geografia"].filter("sk_geografia <> 0 and (populacao_estimada is null or pib_per_capita is null)")
    codes = bare.select(c("cod_ibge").alias("_c"))
    keys = bare.select(c("sk_geografia").alias("_k"))
    a = _n(s["clientes_municipios"].join(codes, c("cod_ibge") == c("_c"), "left_semi")).withColumnRenamed("_n", "clientes")
    b = _n(gold["fato_pedido"].join(keys, c("sk_geo_cliente") == c("_k"), "left_semi")).withColumnRenamed("_n", "pedidos")
    return a.crossJoin(b)  # one row each
