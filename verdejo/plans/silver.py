"""Typed cleaning: one builder per table, each from landed text columns.

No builder joins orders, items, payments and reviews with each other; that is
left to the star schema so that rows are not multiplied early.
"""

from __future__ import annotations

from collections.abc import Callable
from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import scalar as S
from ..functions.geo import COUNTRY_BOX, Box, outside
from ..functions.text import normal_form
from ..operators.impute import MIN_SUPPORT, impute_medians
from ..operators.picks import dominant, latest, most_frequent
from ..operators.quantiles import group_quantiles, money_fence
from ..session import Lazy

STAMP = "timestamp_ntz"
DELIVERED = "delivered"

# Limits and labels of the published bands.
PRICE_STEPS = ((Decimal("39.90"), "baixo"), (Decimal("74.99"), "medio_baixo"), (Decimal("134.90"), "medio_alto"))
PRICE_ABOVE = "alto"
SIZE_STEPS = ((50_000, "Pequeno", "<"), (500_000, "Médio"))
SIZE_ABOVE, SIZE_MISSING = "Grande", "Não informado"

Raw = dict[str, DataFrame]


def orders(raw: Raw) -> DataFrame:
    done = F.col("status_pedido") == DELIVERED
    arrived = F.col("ts_entrega_cliente")
    base = raw["pedidos"].select(
        "order_id", "customer_id", F.col("order_status").alias("status_pedido"),
        S.typed("order_purchase_timestamp", STAMP).alias("ts_compra"),
        S.typed("order_approved_at", STAMP).alias("ts_aprovacao"),
        S.typed("order_delivered_carrier_date", STAMP).alias("ts_envio_transportadora"),
        S.typed("order_delivered_customer_date", STAMP).alias("ts_entrega_cliente"),
        S.typed("order_estimated_delivery_date", STAMP).alias("ts_estimativa_entrega"))
    return base.select(
        "*",
        (done & arrived.isNull()).alias("flag_entrega_ausente"),
        F.when(done, S.day_gap("ts_compra", arrived)).alias("dias_ate_entrega"),
        F.when(done, S.day_gap("ts_estimativa_entrega", arrived)).alias("dias_atraso"),
        F.when(done, S.day_gap("ts_estimativa_entrega", arrived) > 0).alias("flag_atraso"),
        S.month_label("ts_compra").alias("ano_mes_compra"))


def typed_items(raw: Raw) -> DataFrame:
    """Items with types, total and price band, before the freight fence."""
    base = raw["itens_pedido"].select(
        "order_id", S.typed("order_item_id", "int").alias("item_pedido_id"), "product_id", "seller_id",
        S.typed("shipping_limit_date", STAMP).alias("ts_limite_envio"),
        S.typed("price", S.MONEY).alias("preco_produto"),
        S.typed("freight_value", S.MONEY).alias("valor_frete"))
    return base.select(
        "*", S.money(F.col("preco_produto") + F.col("valor_frete")).alias("valor_total_item"),
        S.band("preco_produto", PRICE_STEPS, PRICE_ABOVE, S.NOT_INFORMED).alias("faixa_preco"))


def order_items(raw: Raw) -> DataFrame:
    items = typed_items(raw)
    _, fenced = money_fence(items, "valor_frete")
    return fenced.select(*items.columns, (F.col("valor_frete") > F.col("fence")).alias("flag_frete_outlier"))


def payments(raw: Raw) -> DataFrame:
    base = raw["pagamentos"].select(
        "order_id", "payment_type",
        S.typed("payment_installments", "int").alias("payment_installments"),
        S.typed("payment_value", S.MONEY).alias("payment_value"))
    picked = dominant(base, "order_id", "payment_type", "payment_value", "payment_installments",
                      total="valor_total_pago", rows="qtd_transacoes", kinds="qtd_metodos_distintos",
                      winner="tipo_pagamento_predominante", winner_carried="parcelas_tipo_predominante")
    return picked.withColumn("valor_total_pago", S.money(F.col("valor_total_pago")))


def reviews(raw: Raw) -> DataFrame:
    base = raw["avaliacoes"].select(
        "order_id", "review_id",
        S.typed("review_score", "int").alias("nota_review"),
        S.filled("review_comment_title").alias("titulo_review"),
        S.filled("review_comment_message").alias("mensagem_review"),
        S.typed("review_creation_date", STAMP).alias("ts_criacao_review"),
        S.typed("review_answer_timestamp", STAMP).alias("ts_resposta_review"))
    picked = latest(base, "order_id", ["ts_criacao_review", "ts_resposta_review", "review_id"],
                    ["nota_review", "titulo_review", "mensagem_review"], "flag_avaliacao_duplicada_pedido")
    return picked.select(*base.columns, "flag_avaliacao_duplicada_pedido")


def products(raw: Raw, min_support: int = MIN_SUPPORT) -> DataFrame:
    sizes = ["peso_g", "comprimento_cm", "altura_cm", "largura_cm"]
    base = raw["produtos"].select(
        "product_id", S.filled_or("product_category_name").alias("categoria_produto"),
        S.typed("product_weight_g", "double").alias("peso_g"),
        S.typed("product_length_cm", "double").alias("comprimento_cm"),
        S.typed("product_height_cm", "double").alias("altura_cm"),
        S.typed("product_width_cm", "double").alias("largura_cm"))
    names = raw["traducao_categorias"].select(
        F.col("product_category_name").alias("_pt"), F.col("product_category_name_english").alias("_en"))
    done = impute_medians(base, "categoria_produto", sizes, min_support).join(
        names, F.col("categoria_produto") == F.col("_pt"), "left")
    return done.select(
        "product_id", "categoria_produto",
        F.coalesce("_en", "categoria_produto").alias("categoria_produto_ingles"),
        ((F.col("categoria_produto") != S.NOT_INFORMED) & F.col("_en").isNull()).alias("flag_categoria_sem_traducao"),
        *sizes,
        F.col("_filled_peso_g").alias("flag_peso_imputado"),
        (F.col("_filled_comprimento_cm") | F.col("_filled_altura_cm") | F.col("_filled_largura_cm"))
        .alias("flag_dimensoes_imputadas"))


def customers(raw: Raw) -> DataFrame:
    return raw["clientes"].select(
        "customer_id", "customer_unique_id", F.col("customer_zip_code_prefix").alias("cep_prefixo"),
        F.trim("customer_city").alias("cidade"), F.trim("customer_state").alias("uf"))


def sellers(raw: Raw) -> DataFrame:
    return raw["vendedores"].select(
        "seller_id", F.col("seller_zip_code_prefix").alias("cep_prefixo"),
        F.trim("seller_city").alias("cidade"), F.trim("seller_state").alias("uf"))


def geo_points(raw: Raw, box: Box = COUNTRY_BOX) -> DataFrame:
    points = raw["geolocalizacao"].select(
        F.col("geolocation_zip_code_prefix").alias("cep_prefixo"),
        S.typed("geolocation_lat", "double").alias("latitude"),
        S.typed("geolocation_lng", "double").alias("longitude"),
        F.trim("geolocation_city").alias("cidade"), F.trim("geolocation_state").alias("uf"))
    return points.withColumn("flag_coordenada_invalida", outside(F.col("latitude"), F.col("longitude"), box))


def geo_prefixes(points: DataFrame) -> DataFrame:
    """Median point, valid and invalid counts and the usual city, for prefixes with a valid point."""
    bad = F.col("flag_coordenada_invalida")
    medians = group_quantiles(points.filter(~bad), ["cep_prefixo"], {
        "latitude_mediana": ("latitude", 0.5), "longitude_mediana": ("longitude", 0.5)})
    by_city = points.groupBy("cep_prefixo", "cidade", "uf").agg(
        F.count_if(~bad).alias("_ok"), F.count_if(bad).alias("_bad"))
    usual = by_city.groupBy(F.col("cep_prefixo").alias("_prefix")).agg(
        F.sum("_ok").alias("qtd_pontos_validos"), F.sum("_bad").alias("qtd_pontos_invalidos"),
        most_frequent("_ok", ["cidade", "uf"]).alias("_usual"))
    return medians.join(usual, F.col("cep_prefixo") == F.col("_prefix")).select(
        "cep_prefixo", "latitude_mediana", "longitude_mediana", "qtd_pontos_validos", "qtd_pontos_invalidos",
        F.col("_usual.cidade").alias("cidade_predominante"), F.col("_usual.uf").alias("uf_predominante"))


def municipalities(raw: Raw) -> DataFrame:
    first, second = "microrregiao_mesorregiao_uf", "regiao_imediata_regiao_intermediaria_uf"
    register = raw["municipios"].select(
        F.col("id").alias("cod_ibge"), F.col("nome").alias("municipio"),
        normal_form("nome").alias("municipio_normalizado"),
        S.first_filled(f"{first}_sigla", f"{second}_sigla").alias("uf"),
        S.first_filled(f"{first}_nome", f"{second}_nome").alias("nome_uf"),
        S.first_filled(f"{first}_regiao_nome", f"{second}_regiao_nome").alias("regiao"),
        S.filled("microrregiao_mesorregiao_nome").alias("mesorregiao"),
        S.filled("microrregiao_nome").alias("microrregiao"))
    facts = raw["indicadores"].select(
        F.col("cod_ibge").alias("_code"),
        S.typed("populacao_estimada", "bigint").alias("populacao"),
        S.typed("pib_per_capita", S.MONEY).alias("pib_per_capita"),
        S.typed("ano_referencia", "int").alias("ano_referencia_indicadores"))
    return register.join(facts, F.col("cod_ibge") == F.col("_code"), "left").drop("_code").withColumn(
        "porte_municipio", S.band("populacao", SIZE_STEPS, SIZE_ABOVE, SIZE_MISSING))


def builders(raw: Raw) -> dict[str, Callable[[], DataFrame]]:
    return {
        "itens_pedido": lambda: order_items(raw), "pedidos": lambda: orders(raw), "pagamentos": lambda: payments(raw),
        "avaliacoes": lambda: reviews(raw), "produtos": lambda: products(raw), "clientes": lambda: customers(raw),
        "vendedores": lambda: sellers(raw), "geolocalizacao_pontos": lambda: geo_points(raw),
        "geolocalizacao_cep": lambda: geo_prefixes(geo_points(raw)), "municipios": lambda: municipalities(raw),
    }


def build(raw: Raw) -> dict[str, DataFrame]:
    return Lazy(builders(raw)).all()
