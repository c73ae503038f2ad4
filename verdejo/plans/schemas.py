"""Declared schemas of the cleaned and integrated tables, each with the key that its rows are unique by.

One declaration serves the structure check, the grain checks and the contract of the star schema.
Fixed values: names, types, NOT NULL and keys are those of the published tables.
"""

from __future__ import annotations

from ..operators.contract import Contract


def _table(key: str, ddl: str) -> Contract:
    return Contract(tuple(key.split()), ddl)


CLEANED: dict[str, Contract] = {
    "pedidos": _table("order_id", """
        order_id STRING NOT NULL, customer_id STRING NOT NULL, status_pedido STRING NOT NULL,
        ts_compra TIMESTAMP_NTZ, ts_aprovacao TIMESTAMP_NTZ, ts_envio_transportadora TIMESTAMP_NTZ,
        ts_entrega_cliente TIMESTAMP_NTZ, ts_estimativa_entrega TIMESTAMP_NTZ,
        flag_entrega_ausente BOOLEAN NOT NULL, dias_ate_entrega BIGINT, dias_atraso BIGINT, flag_atraso BOOLEAN,
        ano_mes_compra STRING"""),
    "itens_pedido": _table("order_id item_pedido_id", """
        order_id STRING NOT NULL, item_pedido_id INT NOT NULL, product_id STRING, seller_id STRING,
        ts_limite_envio TIMESTAMP_NTZ, preco_produto DECIMAL(18,2), valor_frete DECIMAL(18,2),
        valor_total_item DECIMAL(18,2), faixa_preco STRING, flag_frete_outlier BOOLEAN"""),
    "pagamentos": _table("order_id", """
        order_id STRING NOT NULL, valor_total_pago DECIMAL(18,2), qtd_transacoes BIGINT NOT NULL,
        qtd_metodos_distintos BIGINT NOT NULL, tipo_pagamento_predominante STRING, parcelas_tipo_predominante INT"""),
    "avaliacoes": _table("order_id", """
        order_id STRING NOT NULL, review_id STRING, nota_review INT, titulo_review STRING, mensagem_review STRING,
        ts_criacao_review TIMESTAMP_NTZ, ts_resposta_review TIMESTAMP_NTZ, flag_avaliacao_duplicada_pedido BOOLEAN NOT NULL"""),
    "produtos": _table("product_id", """
        product_id STRING NOT NULL, categoria_produto STRING NOT NULL, categoria_produto_ingles STRING NOT NULL,
        flag_categoria_sem_traducao BOOLEAN NOT NULL, peso_g DOUBLE, comprimento_cm DOUBLE, altura_cm DOUBLE,
        largura_cm DOUBLE, flag_peso_imputado BOOLEAN NOT NULL, flag_dimensoes_imputadas BOOLEAN NOT NULL"""),
    "clientes": _table("customer_id", """
        customer_id STRING NOT NULL, customer_unique_id STRING NOT NULL, cep_prefixo STRING, cidade STRING, uf STRING"""),
    "vendedores": _table("seller_id", "seller_id STRING NOT NULL, cep_prefixo STRING, cidade STRING, uf STRING"),
    "geolocalizacao_pontos": _table("", """
        cep_prefixo STRING, latitude DOUBLE, longitude DOUBLE, cidade STRING, uf STRING, flag_coordenada_invalida BOOLEAN"""),
    "geolocalizacao_cep": _table("cep_prefixo", """
        cep_prefixo STRING, latitude_mediana DOUBLE, longitude_mediana DOUBLE, qtd_pontos_validos BIGINT,
        qtd_pontos_invalidos BIGINT, cidade_predominante STRING, uf_predominante STRING"""),
    "municipios": _table("cod_ibge", """
        cod_ibge STRING, municipio STRING, municipio_normalizado STRING, uf STRING, nome_uf STRING, regiao STRING,
        mesorregiao STRING, microrregiao STRING, populacao BIGINT, pib_per_capita DECIMAL(18,2),
        ano_referencia_indicadores INT, porte_municipio STRING"""),
}


def _places(key: str, who: str) -> Contract:
    return _table(key, f"""
        {key} STRING NOT NULL, cod_ibge STRING, metodo_match STRING NOT NULL, distancia_match_km DOUBLE,
        latitude_{who} DOUBLE, longitude_{who} DOUBLE, cidade_original STRING, cidade_normalizada STRING, uf STRING,
        motivo_nao_resolvido STRING""")


INTEGRATED: dict[str, Contract] = {
    "municipios_cliente": _table("customer_id", "customer_id STRING, cod_ibge STRING, metodo_match STRING, distancia_match_km DECIMAL(10,2)"),
    "municipios_vendedor": _table("seller_id", "seller_id STRING, cod_ibge STRING, metodo_match STRING, distancia_match_km DECIMAL(10,2)"),
    "clientes_municipios": _places("customer_id", "cliente"),
    "vendedores_municipios": _places("seller_id", "vendedor"),
    "geografia_integrada": _table("cod_ibge", """
        cod_ibge STRING NOT NULL, municipio STRING NOT NULL, municipio_normalizado STRING NOT NULL, uf STRING NOT NULL,
        nome_uf STRING, regiao STRING, populacao_estimada BIGINT, pib_per_capita DECIMAL(18,2),
        ano_referencia_indicadores INT, porte_municipio STRING NOT NULL, latitude_representativa DOUBLE,
        longitude_representativa DOUBLE"""),
    "distancias_itens": _table("order_id order_item_id", """
        order_id STRING NOT NULL, order_item_id INT NOT NULL, distancia_km DOUBLE, flag_distancia_calculada BOOLEAN NOT NULL,
        motivo_distancia_ausente STRING"""),
    "distancias_vendedor_cliente": _table("seller_id customer_id", """
        seller_id STRING, customer_id STRING, distancia_km DECIMAL(10,2), flag_distancia_estimada BOOLEAN"""),
}

#: What the star is loaded from: cleaned tables of orders and parties, and the integrated ones with columns for it.
_NOT_LOADED = {"geolocalizacao_pontos", "geolocalizacao_cep", "municipios",
               "municipios_cliente", "municipios_vendedor", "distancias_vendedor_cliente"}
STAR_INPUTS: dict[str, Contract] = {t: c for t, c in {**CLEANED, **INTEGRATED}.items() if t not in _NOT_LOADED}

#: Where a cleaned table has another name than the landed one that it comes from; those without any are derived.
LANDED_AS: dict[str, str | None] = {"geolocalizacao_pontos": "geolocalizacao", "geolocalizacao_cep": None}
