"""SQL with the meaning of each named query, for a second engine to run on the same tables."""

from __future__ import annotations

from oracles.relations import with_relations

FIRST, LAST, STATE = "1995-06-01", "2000-06-30", "R1"
DONE = "status_pedido = 'delivered'"


def _norm(c: str) -> str:
    return f"coalesce(trim(regexp_replace(strip_accents(lower({c})), '[^a-z0-9]+', ' ', 'g')), '')"


def _r(*cols: str) -> str:
    """Replace list that rounds doubles."""
    return "replace (" + ", ".join(f"round({c}, 6) as {c}" for c in cols) + ")"


def _check(id_: str, count: str, on_fail: str = "REPROVADO", expected: str = "0") -> str:
    return (f"select '{id_}' id, '{expected}' esperado, cast(n as varchar) encontrado, "
            f"if(n = 0, 'APROVADO', '{on_fail}') status from (select cast(({count}) as bigint) n)")


def _rows(table: str, bad: str) -> str:
    return f"select count(*) from {table} where {bad}"


def _twice(table: str, keys: str) -> str:
    return f"select count(*) from (select 1 from {table} group by {keys} having count(*) > 1)"


def _orphan(table: str, fk: str, parent: str, pk: str) -> str:
    return f"select count(*) from {table} c where {fk} is not null and not exists (select 1 from {parent} p where p.{pk} = c.{fk})"


def _pair(id_: str, expected: str, found: str) -> str:
    return (f"select '{id_}' id, cast(a as varchar) esperado, cast(b as varchar) encontrado, "
            f"if(a is not distinct from b, 'APROVADO', 'REPROVADO') status from (select ({expected}) a, ({found}) b)")


def _all(*parts: str) -> str:
    return "\nunion all ".join(parts)


def _fixed(id_: str, expected, found, status: str = "APROVADO") -> str:
    return f"select '{id_}' id, '{expected}' esperado, '{found}' encontrado, '{status}' status"


# -- landing -----------------------------------------------------------------

LANDED = ("orders", "lineitem", "customer", "supplier", "part", "events")
COLUMNS = {
    "orders": "o_orderkey o_custkey o_orderstatus o_totalprice o_orderdate o_orderpriority",
    "events": "event_id ts user_id event_type value props",
    "part": "p_partkey p_name p_brand p_type p_size p_retailprice",
}


def _landed(table: str) -> str:
    data = ", ".join(f"coalesce(cast({c} as varchar), '') {c}" for c in COLUMNS[table].split())
    return (f"select {data}, 'loja' _fonte, '{table}.parquet' _arquivo_origem, timestamp '2026-01-02 03:04:05' _data_ingestao, "
            f"row_number() over () _linha_origem from {table}")


SHAPES = {
    "pedidos": ("fx_pedidos", "order_id customer_id order_status order_purchase_timestamp order_approved_at "
                "order_delivered_carrier_date order_delivered_customer_date order_estimated_delivery_date"),
    "itens_pedido": ("fx_itens", "order_id order_item_id product_id seller_id shipping_limit_date price freight_value"),
    "pagamentos": ("fx_pagamentos", "order_id payment_sequential payment_type payment_installments payment_value"),
    "avaliacoes": ("fx_avaliacoes", "review_id order_id review_score review_comment_title review_comment_message "
                   "review_creation_date review_answer_timestamp"),
    "produtos": ("fx_produtos", "product_id product_category_name product_weight_g product_length_cm product_height_cm product_width_cm"),
    "traducao_categorias": ("fx_traducao", "product_category_name product_category_name_english"),
    "clientes": ("fx_clientes", "customer_id customer_unique_id customer_zip_code_prefix customer_city customer_state"),
    "vendedores": ("fx_vendedores", "seller_id seller_zip_code_prefix seller_city seller_state"),
    "geolocalizacao": ("fx_geolocalizacao", "geolocation_zip_code_prefix geolocation_lat geolocation_lng geolocation_city geolocation_state"),
    "municipios": ("fx_municipios", "id nome uf_a uf_b nome_a nome_b regiao_a regiao_b meso micro"),
    "indicadores": ("fx_indicadores", "cod_ibge ano_referencia populacao_estimada pib_per_capita"),
    "de_para": ("fx_de_para", "cidade_origem uf_origem cod_ibge justificativa"),
}


STAR_COLUMNS = {
    "dim_tempo": "sk_tempo data_completa dia nome_dia_semana numero_dia_semana semana_ano mes nome_mes trimestre ano ano_mes fim_de_semana",
    "dim_produto": "sk_produto product_id categoria_pt categoria_en peso_gramas comprimento_cm altura_cm largura_cm volume_cm3 faixa_peso peso_imputado "
                   "dimensoes_imputadas flag_categoria_sem_traducao",
    "dim_cliente": "sk_cliente customer_unique_id",
    "dim_vendedor": "sk_vendedor seller_id cidade uf cod_ibge municipio_ibge regiao metodo_match_municipio",
    "dim_geografia": "sk_geografia cod_ibge municipio uf nome_uf regiao populacao_estimada pib_per_capita porte_municipio ano_referencia_indicadores "
                     "latitude_representativa longitude_representativa",
    "dim_pagamento": "sk_pagamento tipo_pagamento quantidade_parcelas faixa_parcelas",
    "fato_pedido": "order_id sk_tempo_compra sk_tempo_entrega sk_cliente sk_geo_cliente sk_pagamento status_pedido quantidade_itens quantidade_vendedores "
                   "quantidade_produtos valor_produtos valor_frete valor_total_pedido valor_total_pago dias_ate_entrega dias_atraso flag_atraso nota_avaliacao "
                   "flag_entregue flag_possui_avaliacao flag_entrega_ausente metodo_match_municipio",
    "fato_item_pedido": "order_id order_item_id sk_tempo_compra sk_tempo_entrega sk_produto sk_cliente sk_vendedor sk_geo_cliente sk_pagamento valor_produto "
                        "valor_frete valor_total_item dias_ate_entrega dias_atraso flag_atraso distancia_km nota_avaliacao flag_outlier_frete faixa_preco "
                        "flag_distancia_calculada motivo_distancia_ausente",
}


def _sums(table: str, columns: list[str]) -> str:
    """Row count and four sums of 60 bits over SHA-256 digests of the rows' texts; doubles as decimals of six places."""
    cells = " || ".join(f"coalesce(octet_length(encode(t{i})) || ':' || t{i}, '-')" for i in range(len(columns)))
    texts = ", ".join(f"if(typeof({c}) = 'DOUBLE', cast(try_cast({c} as decimal(38,6)) as varchar), cast({c} as varchar)) t{i}" for i, c in enumerate(columns))
    sums = ", ".join(f"cast(coalesce(sum(cast(cast('0x' || substr(h, {1 + 15 * i}, 15) as bigint) as hugeint)), 0) as varchar) s{i + 1}" for i in range(4))
    return f"select count(*) linhas, {sums} from (select sha256({cells}) h from (select {texts} from {table}))"


def _signature(name: str) -> str:
    table, columns = SHAPES[name]
    return f"select '{name}' tabela, * from ({_sums(table, columns.split())})"


def _star_signature(name: str) -> str:
    table, columns = STAR[name][0], STAR_COLUMNS[name].split()
    kinds = " || ',' || ".join(f"'{c}:' || case typeof(any_value({c})) when 'INTEGER' then 'int' when 'VARCHAR' then 'string' else lower(typeof(any_value({c}))) end"
                               for c in columns)
    return f"select '{name}' tabela, *, (select md5({kinds}) from {table}) esquema from ({_sums(table, columns)})"


_ABSENT = "('', '-', '..', '...', 'X', 'x')"
CONSOLIDATED = f"""
with a as (select cast(1100000 + c_custkey as bigint) + if(c_mktsegment = 'MACHINERY', 1000000000, 0) k, trim(case c_custkey % 10 when 0 then '...' when 1 then ' - ' when 2 then '0'
    else cast(c_custkey * 37 as varchar) end) v from customer),
b as (select cast(1100000 + c_custkey as bigint) + if(c_acctbal < 0, 2000000000, 0) k, trim(case c_custkey % 9 when 0 then 'X' when 1 then ''
    else cast(c_custkey * 911 + 5 as varchar) end) v from customer),
j as (select coalesce(a.k, b.k) k, if(a.v in {_ABSENT}, null, cast(if(a.v in {_ABSENT}, null, a.v) as bigint)) p,
    if(b.v in {_ABSENT}, null, cast(if(b.v in {_ABSENT}, null, b.v) as bigint)) g from a full join b on a.k = b.k)
select cast(k as varchar) cod_ibge, cast(2017 as integer) ano_referencia, p populacao_estimada,
  if(p > 0, cast((cast(g as hugeint) * 200000 + p) // (2 * p) * 0.01 as decimal(18,2)), null) pib_per_capita
from j"""

# -- layers ------------------------------------------------------------------

SILVER_KEYS = (("s_pedidos", ("order_id",)), ("s_itens", ("order_id", "item_pedido_id")), ("s_pagamentos", ("order_id",)),
               ("s_avaliacoes", ("order_id",)), ("s_produtos", ("product_id",)), ("s_clientes", ("customer_id",)),
               ("s_vendedores", ("seller_id",)), ("", ()), ("s_cep", ("cep_prefixo",)), ("s_municipios", ("cod_ibge",)))
PLACE_KEYS = (("i_mapa_clientes", ("id_entidade",)), ("i_mapa_vendedores", ("id_entidade",)), ("i_clientes_municipios", ("customer_id",)),
              ("i_vendedores_municipios", ("seller_id",)), ("i_geografia", ("cod_ibge",)), ("i_dist", ("order_id", "order_item_id")),
              ("i_pares", ("seller_id", "customer_id")))


def _keys(prefix: str, tables) -> str:
    parts = []
    for i, (table, keys) in enumerate(tables, 1):
        if not table:
            continue
        parts.append(_check(f"{prefix}-{i:03d}", _twice(table, ", ".join(keys))))
        parts.append(_check(f"{prefix}-NUL-{i:03d}", _rows(table, " or ".join(f"{k} is null" for k in keys))))
    return _all(*parts)


def _matches() -> str:
    parts = []
    for i, (table, origin, key) in enumerate((("i_mapa_clientes", "s_clientes", "customer_id"),
                                              ("i_mapa_vendedores", "s_vendedores", "seller_id")), 1):
        parts += [
            _check(f"INT-MET-{i:03d}", _rows(table, "metodo_match not in ('exato', 'geografico', 'de_para', 'nao_resolvido')")),
            _check(f"INT-MET-{i + 2:03d}", _rows(table, "(metodo_match = 'nao_resolvido') <> (cod_ibge is null)")),
            _check(f"INT-MET-{i + 4:03d}", _rows(table, "distancia_match_km is not null and metodo_match <> 'geografico'")),
            _check(f"INT-MET-{i + 6:03d}", _rows(table, "metodo_match = 'geografico' and coalesce(distancia_match_km, 51) > 50")),
            _check(f"INT-FK-{i:03d}", _orphan(table, "cod_ibge", "s_municipios", "cod_ibge")),
            _check(f"INT-UF-{i:03d}", f"select count(*) from {table} m join {origin} o on o.{key} = m.id_entidade "
                   "join s_municipios g on g.cod_ibge = m.cod_ibge where metodo_match in ('exato', 'geografico') and upper(trim(o.uf)) <> g.uf"),
            f"select 'INT-TAXA-{i:03d}' id, 'documentada' esperado, (t - u) || ' de ' || t encontrado, if(u = 0, 'APROVADO', 'ALERTA') status "
            f"from (select count(*) t, count(*) filter (metodo_match = 'nao_resolvido') u from {table})"]
    return _all(*parts)


def _domain(i: int, table: str) -> str:
    return _check(f"SLV-DOM-{i:03d}", _rows(table, "cep_prefixo is null or not regexp_full_match(cep_prefixo, '[0-9]{5}')"))


GEO_GAP = "comprimento_cm is null or altura_cm is null or largura_cm is null"
MEASURES = (("valor_produto", "preco_produto"), ("valor_frete", "valor_frete"), ("valor_total_item", "valor_total_item"))
TOTALS = (("valor_produtos", "valor_produto"), ("valor_frete", "valor_frete"), ("valor_total_pedido", "valor_total_item"))
STAR = {"dim_tempo": ("d_tempo", "sk_tempo"), "dim_produto": ("d_produto", "sk_produto"), "dim_cliente": ("d_cliente", "sk_cliente"),
        "dim_vendedor": ("d_vendedor", "sk_vendedor"), "dim_geografia": ("d_geografia", "sk_geografia"),
        "dim_pagamento": ("d_pagamento", "sk_pagamento"), "fato_pedido": ("f_pedido", "order_id"),
        "fato_item_pedido": ("f_item", "order_id, order_item_id")}
COVERED = (("dim_produto", "s_produtos", "product_id"), ("dim_cliente", "s_clientes", "customer_unique_id"),
           ("dim_vendedor", "s_vendedores", "seller_id"), ("dim_geografia", "i_geografia", "cod_ibge"))
FKS = (("fato_pedido", "sk_tempo_compra", "dim_tempo"), ("fato_pedido", "sk_tempo_entrega", "dim_tempo"),
       ("fato_pedido", "sk_cliente", "dim_cliente"), ("fato_pedido", "sk_geo_cliente", "dim_geografia"),
       ("fato_pedido", "sk_pagamento", "dim_pagamento"), ("fato_item_pedido", "sk_tempo_compra", "dim_tempo"),
       ("fato_item_pedido", "sk_tempo_entrega", "dim_tempo"), ("fato_item_pedido", "sk_produto", "dim_produto"),
       ("fato_item_pedido", "sk_cliente", "dim_cliente"), ("fato_item_pedido", "sk_vendedor", "dim_vendedor"),
       ("fato_item_pedido", "sk_geo_cliente", "dim_geografia"), ("fato_item_pedido", "sk_pagamento", "dim_pagamento"))


def _structure() -> str:
    parts = []
    for name, (table, key) in STAR.items():
        parts.append(_check(f"Grao {name}", _twice(table, key)))
        if name.startswith("dim_"):
            parts.append(_pair(f"Membro desconhecido {name}", "1", _rows(table, f"{key} = 0")))
    for dim, source, key in COVERED:
        parts.append(_pair(f"Cobertura {dim}", f"select count(distinct {key}) + 1 from {source}", f"select count(*) from {STAR[dim][0]}"))
        parts.append(_check(f"Chave natural {dim}", _twice(STAR[dim][0], key)))
    parts.append(_check("Combinacao natural de pagamento", _twice("d_pagamento", "tipo_pagamento, quantidade_parcelas")))
    parts.append(_fixed("Quantidade de FKs declaradas", 12, 12))
    parts.append(_pair("Contagem fato_item_pedido", "select count(*) from s_itens", "select count(*) from f_item"))
    parts.append(_pair("Contagem fato_pedido", "select count(*) from s_pedidos", "select count(*) from f_pedido"))
    return _all(*parts)


def _reconciled() -> str:
    parts = [_check(f"Valor por item {a}", f"select count(*) from f_item f full join s_itens s on f.order_id = s.order_id and "
                    f"order_item_id = item_pedido_id where f.order_id is null or s.order_id is null or f.{a} is distinct from s.{b}") for a, b in MEASURES]
    parts += [_pair(f"Soma {a}", f"select cast(sum({b}) as decimal(18,2)) from s_itens", f"select cast(sum({a}) as decimal(18,2)) from f_item")
              for a, b in MEASURES]
    parts += [_check(f"Agregacao por pedido {a}", f"select count(*) from f_pedido p left join (select order_id, "
                     f"if(bool_or({b} is null), null, sum({b})) v from f_item group by order_id) t on t.order_id = p.order_id "
                     f"where p.{a} is distinct from if(t.order_id is null, 0, v)") for a, b in TOTALS]
    return _all(*parts)


# -- panel and KPI -----------------------------------------------------------

def _base(state: str | None = None) -> str:
    extra = f" and g.uf = '{state}'" if state else ""
    return (f"with b as (select p.*, t.ano_mes, g.uf, g.porte_municipio from f_pedido p join d_tempo t on sk_tempo = sk_tempo_compra "
            f"join d_geografia g on sk_geografia = sk_geo_cliente where data_completa between '{FIRST}' and '{LAST}'{extra}) ")


def _in(cte: str, sql: str) -> str:
    return f"select * from ({cte}{sql})"


SUMMARY = f"""select count(*) pedidos_filtrados, count(*) filter ({DONE}) entregues,
  cast(sum(valor_total_pedido) filter ({DONE}) as decimal(18,2)) valor_entregue,
  round(avg(valor_total_pedido) filter ({DONE}), 6) ticket, count(valor_total_pedido) filter ({DONE}) base_ticket,
  round(100 * cast(sum(valor_frete) filter ({DONE}) as double) / cast(sum(valor_total_pedido) filter ({DONE}) as double), 6) percentual_frete,
  round(avg(dias_ate_entrega) filter ({DONE}), 6) prazo, count(dias_ate_entrega) filter ({DONE}) base_prazo,
  round(100 * count(*) filter ({DONE} and flag_atraso) / nullif(count(flag_atraso) filter ({DONE}), 0), 6) atraso,
  count(flag_atraso) filter ({DONE}) base_atraso, count(*) filter ({DONE} and flag_atraso) atrasados,
  round(avg(nota_avaliacao), 6) nota, count(nota_avaliacao) avaliados,
  round(100 * count(*) filter (nota_avaliacao > 3) / nullif(count(nota_avaliacao), 0), 6) positivas,
  round(100 * count(*) filter (nota_avaliacao < 3) / nullif(count(nota_avaliacao), 0), 6) negativas,
  round(100 * count(nota_avaliacao) / nullif(count(*), 0), 6) cobertura from b"""
DISTANCE = f"""select round(avg(distancia_km), 6) distancia, count(distancia_km) base_distancia
from f_item i join b on b.order_id = i.order_id where {DONE}"""
CHARTS = {
    "mensal": f"select ano_mes nome, cast(sum(valor_total_pedido) as decimal(18,2)) valor, count(*) base from b where {DONE} group by 1",
    "categorias": f"""select categoria_pt nome, cast(sum(valor_total_item) as decimal(18,2)) valor, count(*) base from f_item i
join b on b.order_id = i.order_id join d_produto pr on pr.sk_produto = i.sk_produto where {DONE} group by 1
order by valor desc nulls last, nome nulls last limit 10""",
    "porte": f"select porte_municipio nome, round(avg(valor_total_pedido), 6) valor, count(valor_total_pedido) base from b where {DONE} group by 1",
    "atraso_uf": f"select uf nome, round(100 * count(*) filter (flag_atraso) / count(*), 6) valor, count(*) base from b "
                 f"where {DONE} and flag_atraso is not null group by 1",
    "prazo_mensal": f"select ano_mes nome, round(avg(dias_ate_entrega), 6) valor, count(*) base from b "
                    f"where {DONE} and dias_ate_entrega is not null group by 1",
    "notas": "select nota_avaliacao || ' estrelas' nome, count(*) valor, count(*) base from b where nota_avaliacao is not null group by nota_avaliacao",
    "nota_atraso": f"select if(flag_atraso, 'Com atraso', 'No prazo') nome, round(avg(nota_avaliacao), 6) valor, count(*) base from b "
                   f"where {DONE} and flag_atraso is not null and nota_avaliacao is not null group by 1",
}
CARDS = (
    ("comercial", "Valor entregue", "valor_entregue", "entregues"), ("comercial", "Pedidos entregues", "entregues", "null"),
    ("comercial", "Ticket médio", "ticket", "base_ticket"), ("comercial", "Participação do frete", "percentual_frete", "null"),
    ("logistica", "Prazo médio", "prazo", "base_prazo"), ("logistica", "Entregas atrasadas", "atraso", "base_atraso"),
    ("logistica", "Pedidos atrasados", "atrasados", "null"), ("logistica", "Distância média", "distancia", "base_distancia"),
    ("satisfacao", "Nota média", "nota", "avaliados"), ("satisfacao", "Avaliações positivas", "positivas", "avaliados"),
    ("satisfacao", "Cobertura de avaliações", "cobertura", "pedidos_filtrados"),
    ("satisfacao", "Avaliações negativas", "negativas", "avaliados"))
TITLES = (
    ("comercial", "mensal", "Valor entregue ao longo do tempo"), ("comercial", "categorias", "Categorias que mais vendem"),
    ("comercial", "porte", "Ticket médio por porte municipal"), ("logistica", "prazo_mensal", "Evolução do prazo de entrega"),
    ("logistica", "atraso_uf", "Atrasos por UF do cliente"), ("satisfacao", "notas", "Distribuição das avaliações"),
    ("satisfacao", "nota_atraso", "Prazo cumprido, experiência melhor?"))


def _export() -> str:
    cards = [f"select '{p}' painel, 'KPI' secao, '{label}' grupo, round(cast({v} as double), 6) valor, cast({b} as bigint) base "
             f"from ({SUMMARY}), ({DISTANCE})" for p, label, v, b in CARDS]
    charts = [f"select '{p}' painel, '{title}' secao, if(nome = 'nao_informado', 'Não informado', replace(nome, '_', ' ')) grupo, "
              f"round(cast(valor as double), 6) valor, cast(base as bigint) base from ({CHARTS[k]})" for p, k, title in TITLES]
    return _in(_base(), _all(*cards, *charts))


ITEMS = "f_item i join (select order_id oid, status_pedido from f_pedido) on oid = order_id"
PCT = "round(100 * cast({} as double) / nullif(cast({} as double), 0), 6)"
SCORE = "count(nota_avaliacao)"
# code -> (from, where, value, base)
KPI = {
    "VEN-001": (ITEMS, "true", "cast(sum(valor_total_item) as decimal(18,2))", "count(valor_total_item)"),
    "VEN-002": (ITEMS, DONE, "cast(sum(valor_total_item) as decimal(18,2))", "count(valor_total_item)"),
    "VEN-003": (ITEMS, DONE, "cast(sum(valor_produto) as decimal(18,2))", "count(valor_produto)"),
    "VEN-004": (ITEMS, DONE, "cast(sum(valor_frete) as decimal(18,2))", "count(valor_frete)"),
    "VEN-005": ("f_pedido", "true", "count(*)", "count(*)"), "VEN-005-ENTREGUES": ("f_pedido", DONE, "count(*)", "count(*)"),
    "VEN-006": (ITEMS, "true", "count(*)", "count(*)"),
    "VEN-007": ("f_pedido", DONE, "round(avg(valor_total_pedido), 6)", "count(valor_total_pedido)"),
    "VEN-008": ("f_pedido", DONE, "round(avg(quantidade_itens), 6)", "count(*)"),
    "FRE-001": (ITEMS, DONE, PCT.format("sum(valor_frete)", "sum(valor_total_item)"), "count(valor_total_item)"),
    "LOG-001": ("f_pedido", DONE, "round(avg(dias_ate_entrega), 6)", "count(dias_ate_entrega)"),
    "LOG-002": ("f_pedido", DONE, PCT.format("count(*) filter (flag_atraso)", "count(flag_atraso)"), "count(flag_atraso)"),
    "LOG-003": ("f_pedido", f"{DONE} and flag_atraso", "round(avg(dias_atraso), 6)", "count(dias_atraso)"),
    "LOG-004": ("f_pedido", f"{DONE} and dias_atraso < 0", "round(avg(abs(dias_atraso)), 6)", "count(dias_atraso)"),
    "LOG-005": (ITEMS, DONE, "round(avg(distancia_km), 6)", "count(distancia_km)"),
    "SAT-001": ("f_pedido", "true", "round(avg(nota_avaliacao), 6)", SCORE),
    "SAT-002": ("f_pedido", "true", PCT.format("count(*) filter (nota_avaliacao > 3)", SCORE), SCORE),
    "SAT-003": ("f_pedido", "true", PCT.format("count(*) filter (nota_avaliacao < 3)", SCORE), SCORE),
    "SAT-004": ("f_pedido", "true", PCT.format(SCORE, "count(*)"), "count(*)"),
    "CLI-001": ("f_pedido", DONE, "count(distinct nullif(sk_cliente, 0))", "count(*)"),
}


def _kpi(code: str, by: str = "", join: str = "") -> str:
    source, where, value, base = KPI[code]
    group = f" group by {by}" if by else ""
    lead = f"{by}, " if by else ""
    return f"select {lead}{value} valor, {base} base from {source} {join} where {where}{group}"


GEO = "join d_geografia g on g.sk_geografia = sk_geo_cliente"

_SQL: dict[str, str] = {
    **{f"landed_{t}": _landed(t) for t in COLUMNS},
    "landed_shape_checks": _all(*[_fixed(f"BRZ-EST-{i:03d}", 0, 0) for i in (2, 3, 4)]),
    "landed_content_checks": _all(*[_check(f"BRZ-{k}.{t}", _rows(t, "false")) for t in LANDED for k in ("EST-005", "LIN-002", "LIN-001")]),
    "indicator_consolidation": CONSOLIDATED,
    "source_signatures": _all(*[_signature(t) for t in SHAPES]), "merged_signatures": _all(*[_signature(t) for t in SHAPES]),
    "clean_orders": "select * from s_pedidos", "clean_items": "select * from s_itens", "clean_payments": "select * from s_pagamentos",
    "clean_reviews": "select * from s_avaliacoes", "clean_products": "select * from s_produtos", "clean_customers": "select * from s_clientes",
    "clean_sellers": "select * from s_vendedores", "geo_points": "select * from s_pontos",
    "geo_prefixes": f"select * {_r('latitude_mediana', 'longitude_mediana')} from s_cep", "municipalities": "select * from s_municipios",
    "freight_fence": "select q1, q3, q3 + 1.5 * (q3 - q1) fence from s_cercas",
    "text_keys": f"select doc_id, {_norm('text')} normal, md5(replace({_norm('text')}, ' ', '')) chave_md5 from documents",
    "delivered_value_by_month": f"select ano_mes_compra nome, cast(sum(if(t.order_id is null, 0, vt)) as decimal(18,2)) valor, count(*) base "
                                f"from s_pedidos p left join c_total t on t.order_id = p.order_id where {DONE} group by 1",
    "match_reference": "select * from i_ref", "prefix_coordinates": f"select * {_r('latitude', 'longitude')} from i_coord",
    "crosswalk": "select * from i_de_para", "exact_prefixes": f"select * {_r('latitude', 'longitude')} from i_cep_exato",
    "centroids": f"select * {_r('latitude_representativa', 'longitude_representativa')} from i_centro",
    "customer_places": f"select * {_r('latitude', 'longitude')} from i_mapa_clientes",
    "seller_places": f"select * {_r('latitude', 'longitude')} from i_mapa_vendedores",
    "customer_audit_map": "select id_entidade customer_id, cod_ibge, metodo_match, distancia_match_km from i_mapa_clientes",
    "customer_contract_map": f"select * {_r('latitude_cliente', 'longitude_cliente')} from i_clientes_municipios",
    "seller_contract_map": f"select * {_r('latitude_vendedor', 'longitude_vendedor')} from i_vendedores_municipios",
    "geography": f"select * {_r('latitude_representativa', 'longitude_representativa')} from i_geografia",
    "pair_distances": "select * from i_pares", "item_distances": f"select * {_r('distancia_km')} from i_dist",
    "match_coverage": _all(*[
        f"select '{e}' entidade, count(*) total, count(*) filter (metodo_match = 'exato') exato, count(*) filter (metodo_match = 'geografico') geografico, "
        f"count(*) filter (metodo_match = 'de_para') manual, count(*) filter (metodo_match = 'nao_resolvido') nao_resolvido, "
        f"round(count(cod_ibge) / count(*), 6) taxa_match from i_mapa_{e}" for e in ("clientes", "vendedores")]),
    "unresolved_places": _all(*[
        f"select '{n}' entidade, cidade_original, cidade_normalizada, uf, count(*) qtd_entidades, min(motivo_nao_resolvido) motivo "
        f"from i_mapa_{e} where cod_ibge is null group by 2, 3, 4" for n, e in (("cliente", "clientes"), ("vendedor", "vendedores"))]),
    "unresolved_by_city": _all(*[
        f"select '{n}' entidade, cidade_original, uf, count(*) qtd from i_mapa_{e} where cod_ibge is null group by 2, 3"
        for n, e in (("cliente", "clientes"), ("vendedor", "vendedores"))]),
    "crosswalk_use": """select d.cidade_normalizada, d.uf, d.cod_ibge, municipio, justificativa,
  (select count(*) from i_mapa_clientes c where c.metodo_match = 'de_para' and c.cidade_normalizada = d.cidade_normalizada and c.uf = d.uf) clientes,
  (select count(*) from i_mapa_vendedores v where v.metodo_match = 'de_para' and v.cidade_normalizada = d.cidade_normalizada and v.uf = d.uf) vendedores
from i_de_para d join i_ref m on m.cod_ibge = d.cod_ibge""",
    "city_prototype": f"select * {_r('lat_representativa', 'lng_representativa')} from i_prototipo",
    "city_coverage": """select count(*) cidades, count(*) filter (variante_match = 'nome_identico') nome_identico,
  count(*) filter (variante_match = 'sem_espacos') sem_espacos, count(*) filter (cod_ibge is null) sem_codigo,
  round(100 * count(cod_ibge) / count(*), 6) pct_cidades,
  round(100 * cast(sum(qte_pontos) filter (cod_ibge is not null) as double) / cast(sum(qte_pontos) as double), 6) pct_pontos from i_prototipo""",
    "missing_distance_reasons": "select motivo_distancia_ausente, count(*) itens from i_dist where motivo_distancia_ausente is not null group by 1",
    "dim_calendar": "select * from d_tempo", "dim_customer": "select * from d_cliente", "dim_product": f"select * {_r('volume_cm3')} from d_produto",
    "dim_geography": f"select * {_r('latitude_representativa', 'longitude_representativa')} from d_geografia",
    "dim_seller": "select * from d_vendedor", "dim_payment": "select * from d_pagamento", "order_context": "select * from c_pedido",
    "fact_orders": "select * from f_pedido", "fact_items": f"select * {_r('distancia_km')} from f_item",
    "silver_key_checks": _keys("SLV-PK", SILVER_KEYS),
    "silver_reference_checks": _all(*[_check(f"SLV-FK-{i:03d}", _orphan(*x)) for i, x in enumerate((
        ("s_itens", "order_id", "s_pedidos", "order_id"), ("s_itens", "product_id", "s_produtos", "product_id"),
        ("s_itens", "seller_id", "s_vendedores", "seller_id"), ("s_pedidos", "customer_id", "s_clientes", "customer_id"),
        ("s_pagamentos", "order_id", "s_pedidos", "order_id"), ("s_avaliacoes", "order_id", "s_pedidos", "order_id")), 1)]),
    "silver_grain_checks": _all(*[_pair(f"SLV-GRAO-{i:03d}", f"select count({what}) from {a}", f"select count(*) from {b}") for i, (a, b, what) in enumerate((
        ("orders", "s_pedidos", "*"), ("lineitem", "s_itens", "*"), ("part", "s_produtos", "*"), ("customer", "s_clientes", "*"),
        ("supplier", "s_vendedores", "*"), ("events", "s_pontos", "*"), ("nation", "s_municipios", "*"),
        ("fx_pagamentos", "s_pagamentos", "distinct order_id"), ("fx_avaliacoes", "s_avaliacoes", "distinct order_id")), 1)]),
    "silver_money_checks": _all(*[_pair(
        i, f"select cast(coalesce(sum(cast(nullif(trim({a}), '') as decimal(18,2))), 0) as decimal(18,2)) from {t}",
        f"select cast(coalesce(sum({b}), 0) as decimal(18,2)) from {u}") for i, a, t, b, u in (
        ("SLV-REC-001", "price", "fx_itens", "preco_produto", "s_itens"), ("SLV-REC-002", "freight_value", "fx_itens", "valor_frete", "s_itens"),
        ("SLV-REC-003", "payment_value", "fx_pagamentos", "valor_total_pago", "s_pagamentos"))],
        _check("SLV-REC-004", _rows("s_itens", "valor_total_item is distinct from preco_produto + valor_frete"))),
    "order_rule_checks": _all(*[_check(f"SLV-NEG-{i:03d}", _rows("s_pedidos", bad), fail) for i, (bad, fail) in enumerate((
        ("ts_compra is null", "REPROVADO"), ("ts_estimativa_entrega is null", "REPROVADO"),
        (f"not ({DONE}) and coalesce(dias_ate_entrega, dias_atraso, cast(flag_atraso as bigint)) is not null", "REPROVADO"),
        ("flag_atraso <> (dias_atraso > 0)", "REPROVADO"), ("dias_ate_entrega < 0", "REPROVADO"),
        (f"{DONE} and ts_entrega_cliente is null", "ALERTA"),
        (f"flag_entrega_ausente is distinct from ({DONE} and ts_entrega_cliente is null)", "REPROVADO")), 1)]),
    "domain_checks": _all(
        _check("SLV-DOM-001", _rows("s_avaliacoes", "coalesce(nota_review, 0) not between 1 and 5")),
        _check("SLV-DOM-002", _rows("s_itens", "faixa_preco not in ('baixo', 'medio_baixo', 'medio_alto', 'alto')")),
        _domain(3, "s_clientes"), _domain(4, "s_vendedores"), _domain(5, "s_cep"),
        _check("SLV-DOM-006", _rows("s_municipios", "porte_municipio not in ('Pequeno', 'Médio', 'Grande', 'Não informado')"))),
    "imputation_checks": _all(
        _check("SLV-PRD-001", _rows("s_produtos", "categoria_produto is null")),
        _check("SLV-PRD-002", _rows("s_produtos", "flag_peso_imputado and peso_g is null")),
        _check("SLV-PRD-003", _rows("s_produtos", f"flag_dimensoes_imputadas and ({GEO_GAP})")),
        _check("SLV-PRD-004", _rows("s_produtos", "categoria_produto = 'nao_informado'"), "ALERTA", "documentado"),
        _check("SLV-PRD-005", _rows("s_produtos", "peso_g is null"), "ALERTA", "mediana da categoria com pelo menos 5 observacoes")),
    "geolocation_checks": _all(
        _check("SLV-GEO-001", _rows("s_pontos", "flag_coordenada_invalida is distinct from (latitude is null or longitude is null or "
                                    "latitude not between -34 and 6 or longitude not between -75 and -33)")),
        _check("SLV-GEO-004", _rows("s_pontos", "flag_coordenada_invalida"), "ALERTA", "sinalizados, nunca removidos"),
        _check("SLV-GEO-002", _rows("s_cep", "qtd_pontos_validos < 1")),
        _check("SLV-GEO-003", "select count(distinct cep_prefixo) - (select count(*) from s_cep) from s_pontos", "ALERTA")),
    "integration_key_checks": _keys("INT-PK", PLACE_KEYS), "match_checks": _matches(),
    "crosswalk_checks": "select 'INT-DEP-001' id, 'evidencia' esperado, cast(n as varchar) encontrado, if(e > 0 or n = 0, 'APROVADO', 'REPROVADO') status "
                        "from (select (select count(*) from fx_de_para) e, (select count(*) from i_mapa_clientes where metodo_match = 'de_para') "
                        "+ (select count(*) from i_mapa_vendedores where metodo_match = 'de_para') n)",
    "distance_checks": _all(
        _check("INT-DIST-001", _rows("i_pares", "distancia_km < 0")),
        _check("INT-DIST-003", _rows("i_pares", "distancia_km is null"), "ALERTA", "permitido sem coordenada"),
        _pair("INT-DIST-002", "select count(*) from (select distinct seller_id, customer_id from s_itens join s_pedidos using (order_id))", "select count(*) from i_pares"),
        _check("INT-DIST-004", _rows("i_dist", "flag_distancia_calculada is distinct from (distancia_km is not null)")),
        _check("INT-DIST-006", _rows("i_dist", "not flag_distancia_calculada"), "ALERTA", "permitido, com motivo"),
        _pair("INT-DIST-005", "select count(*) from s_itens", "select count(*) from i_dist")),
    "indicator_checks": _all(
        _check("INT-SOC-001", _rows("s_municipios", "populacao is null"), "ALERTA"),
        _check("INT-SOC-002", _rows("s_municipios", "pib_per_capita is null"), "ALERTA"),
        _check("INT-SOC-003", "select count(*) from i_mapa_clientes m join s_municipios g on g.cod_ibge = m.cod_ibge "
               "where g.populacao is null or g.pib_per_capita is null", "ALERTA")),
    "indicator_examples": "select cod_ibge, municipio, uf from s_municipios where populacao is null or pib_per_capita is null order by cod_ibge limit 10",
    "acceptance_checks": _all(
        _check("ACE-001", _twice("i_mapa_clientes", "id_entidade")), _check("ACE-002", _twice("i_mapa_vendedores", "id_entidade")),
        _check("ACE-003", _twice("i_dist", "order_id, order_item_id")), _check("ACE-004", _orphan("i_mapa_clientes", "cod_ibge", "i_ref", "cod_ibge")),
        _check("ACE-005", _rows("i_mapa_clientes", "distancia_match_km is not null and metodo_match <> 'geografico'")),
        _check("ACE-006", _rows("i_mapa_clientes", "metodo_match = 'geografico' and distancia_match_km > 50"))),
    "contract_checks": _check("CTR-INTERFACE-001", "select (" + ") + (".join(
        [_twice(t, ", ".join(k)) for t, k in SILVER_KEYS if t and t not in ("s_cep", "s_municipios")]
        + [_twice(t, ", ".join(k)) for t, k in PLACE_KEYS[2:6]]) + ")"),
    "star_input_problems": _all(*[f"select '{label}' regra, ({sql}) encontrado" for label, sql in (
        ("pedidos.customer_id -> clientes.customer_id", _orphan("s_pedidos", "customer_id", "s_clientes", "customer_id")),
        ("itens_pedido.order_id -> pedidos.order_id", _orphan("s_itens", "order_id", "s_pedidos", "order_id")),
        ("itens_pedido.product_id -> produtos.product_id", _orphan("s_itens", "product_id", "s_produtos", "product_id")),
        ("itens_pedido.seller_id -> vendedores.seller_id", _orphan("s_itens", "seller_id", "s_vendedores", "seller_id")),
        ("pagamentos.order_id -> pedidos.order_id", _orphan("s_pagamentos", "order_id", "s_pedidos", "order_id")),
        ("avaliacoes.order_id -> pedidos.order_id", _orphan("s_avaliacoes", "order_id", "s_pedidos", "order_id")),
        ("clientes_municipios.cod_ibge -> geografia_integrada.cod_ibge", _orphan("i_clientes_municipios", "cod_ibge", "i_geografia", "cod_ibge")),
        ("vendedores_municipios.cod_ibge -> geografia_integrada.cod_ibge", _orphan("i_vendedores_municipios", "cod_ibge", "i_geografia", "cod_ibge")),
        ("clientes <> clientes_municipios", "select count(*) from s_clientes a full join i_clientes_municipios b on a.customer_id = b.customer_id "
         "where a.customer_id is null or b.customer_id is null"),
        ("vendedores <> vendedores_municipios", "select count(*) from s_vendedores a full join i_vendedores_municipios b on a.seller_id = b.seller_id "
         "where a.seller_id is null or b.seller_id is null"),
        ("itens_pedido <> distancias_itens", "select count(*) from s_itens a full join i_dist b on a.order_id = b.order_id and item_pedido_id = order_item_id "
         "where a.order_id is null or b.order_id is null"))]),
    "star_structure_checks": _structure(),
    "star_reference_checks": _all(*[_check(f"FK {f}.{k}", _orphan(STAR[f][0], k, STAR[d][0], STAR[d][1])) for f, k, d in FKS]),
    "star_rule_checks": _all(
        _check("Total do item", _rows("f_item", "valor_total_item is distinct from valor_produto + valor_frete")),
        _check("Entregas elegiveis", _rows("f_pedido", "not flag_entregue and coalesce(dias_ate_entrega, dias_atraso, cast(flag_atraso as bigint)) is not null")),
        _check("Flag de atraso", _rows("f_pedido", "flag_atraso is distinct from dias_atraso > 0")),
        _check("Dominio da nota", _rows("f_pedido", "nota_avaliacao not between 1 and 5")),
        _check("Contexto do pedido nos itens", "select count(*) from f_item i left join f_pedido p on p.order_id = i.order_id where "
               "(i.sk_cliente, i.sk_geo_cliente, i.sk_tempo_compra, i.sk_tempo_entrega, i.sk_pagamento, i.nota_avaliacao) is distinct from "
               "(p.sk_cliente, p.sk_geo_cliente, p.sk_tempo_compra, p.sk_tempo_entrega, p.sk_pagamento, p.nota_avaliacao)")),
    "star_reconciliation_checks": _reconciled(),
    "star_preservation_checks": _all(
        _check("Pagamento nao multiplicado", "select count(*) from f_pedido f left join s_pagamentos p on p.order_id = f.order_id where f.valor_total_pago is distinct from p.valor_total_pago"),
        _check("Avaliacao por pedido preservada", "select count(*) from f_pedido f left join s_avaliacoes a on a.order_id = f.order_id where nota_avaliacao is distinct from nota_review"),
        _check("Prazos preservados", "select count(*) from f_pedido f join s_pedidos p on p.order_id = f.order_id where (f.dias_ate_entrega, f.dias_atraso, f.flag_atraso) "
               "is distinct from (p.dias_ate_entrega, p.dias_atraso, p.flag_atraso)"),
        _check("Cliente persistente e endereco por pedido", "select count(*) from f_pedido f join s_pedidos p on p.order_id = f.order_id join s_clientes c on c.customer_id = p.customer_id "
               "join i_clientes_municipios m on m.customer_id = p.customer_id join d_cliente dc on dc.sk_cliente = f.sk_cliente join d_geografia g on g.sk_geografia = f.sk_geo_cliente "
               "where dc.customer_unique_id is distinct from c.customer_unique_id or g.cod_ibge is distinct from m.cod_ibge"),
        _check("Tempo de compra", "select count(*) from f_pedido f join s_pedidos p on p.order_id = f.order_id left join d_tempo t on sk_tempo = sk_tempo_compra where data_completa is distinct from cast(ts_compra as date)"),
        _check("Tempo de entrega", f"select count(*) from f_pedido f join s_pedidos p on p.order_id = f.order_id left join d_tempo t on sk_tempo = sk_tempo_entrega "
               "where data_completa is distinct from if(p.status_pedido = 'delivered', cast(ts_entrega_cliente as date), null)"),
        _check("Distancia oficial preservada", "select count(*) from f_item f join i_dist d on d.order_id = f.order_id and d.order_item_id = f.order_item_id where f.distancia_km is distinct from d.distancia_km")),
    "star_unknown_use": _all(*[f"select '{f}.{k}' chave, (select count(*) from {STAR[f][0]} where {k} = 0) linhas" for f, k, _ in FKS]),
    "star_counts": _all(*[f"select '{n}' tabela, (select count(*) from {t}) linhas" for n, (t, _) in STAR.items()]),
    "star_match_coverage": _all(*[f"select '{e}' entidade, metodo_match, count(*) entidades from i_{e}_municipios group by 2" for e in ("clientes", "vendedores")]),
    "key_stability": _all(*[f"select '{d}' dimensao, (select count(*) from {STAR[d][0]} a full join {STAR[d][0]} b on a.{k} is not distinct from b.{k} "
                            f"where a.{STAR[d][1]} is distinct from b.{STAR[d][1]}) alteradas" for d, _, k in COVERED]),
    "distance_profile": """select count(distancia_km) com_distancia, count(*) - count(distancia_km) sem_distancia, round(min(distancia_km), 6) minima,
  round(median(distancia_km), 6) mediana, round(avg(distancia_km), 6) media, round(quantile_cont(distancia_km, 0.95), 6) p95,
  round(quantile_cont(distancia_km, 0.99), 6) p99, round(max(distancia_km), 6) maxima from f_item""",
    "freight_profile": """select any_value(q1) q1, any_value(q3) q3, any_value(q3 + 1.5 * (q3 - q1)) cerca, count(*) itens, count(*) filter (flag_frete_outlier) sinalizados,
  round(100 * count(*) filter (flag_frete_outlier) / count(*), 6) percentual, min(valor_frete) minimo, round(median(cast(valor_frete as double)), 6) mediana,
  round(quantile_cont(cast(valor_frete as double), 0.99), 6) p99, max(valor_frete) maximo, cast(sum(valor_frete) as decimal(18,2)) soma, false winsorizacao from s_itens, s_cercas""",
    "product_profile": _all(*[f"select '{n}' situacao, (select count(*) from d_produto where sk_produto > 0 and ({c})) produtos, "
                              f"(select count(*) from f_item i join d_produto p on p.sk_produto = i.sk_produto where i.sk_produto > 0 and ({c})) itens" for n, c in (
        ("categoria_nao_informada", "categoria_pt = 'nao_informado'"), ("peso_imputado", "peso_imputado"), ("dimensoes_imputadas", "dimensoes_imputadas"),
        ("peso_nulo", "peso_gramas is null"), ("dimensoes_nulas", GEO_GAP))]),
    "unreviewed_orders": "select count(*) pedidos, count(*) - count(nota_avaliacao) sem_avaliacao, round(100 * (count(*) - count(nota_avaliacao)) / count(*), 6) percentual from f_pedido",
    "mixed_scores": "select count(*) pedidos_inconsistentes from (select 1 from f_item group by order_id having count(distinct nota_avaliacao) > 1)",
    "lost_ids": _all(*[f"select '{n}' caso, ({q}) linhas" for n, q in (
        ("pedidos fora de fato_pedido", _orphan("s_pedidos", "order_id", "f_pedido", "order_id")),
        ("fato_pedido fora de pedidos", _orphan("f_pedido", "order_id", "s_pedidos", "order_id")),
        ("itens_pedido fora de fato_item_pedido", "select count(*) from s_itens a where not exists (select 1 from f_item b where b.order_id = a.order_id and order_item_id = item_pedido_id)"),
        ("fato_item_pedido fora de itens_pedido", "select count(*) from f_item a where not exists (select 1 from s_itens b where b.order_id = a.order_id and order_item_id = item_pedido_id)"))]),
    "payment_checks": _all(
        _check("PAG-001", _twice("s_pagamentos", "order_id")), _check("PAG-002", _orphan("s_pagamentos", "tipo_pagamento_predominante", "d_pagamento", "tipo_pagamento")),
        _check("PAG-003", _rows("s_pagamentos", "parcelas_tipo_predominante < 0")),
        _check("PAG-004", _rows("d_pagamento", "faixa_parcelas <> case when quantidade_parcelas = 1 then '1_parcela' when quantidade_parcelas in (2, 3) then '2_a_3' "
                                "when quantidade_parcelas in (4, 5, 6) then '4_a_6' when quantidade_parcelas between 7 and 12 then '7_a_12' "
                                "when quantidade_parcelas > 12 then 'acima_12' else 'nao_informado' end")),
        _check("PAG-005", "select count(*) from f_pedido f left join s_pagamentos p on p.order_id = f.order_id where p.order_id is null and sk_pagamento <> 0")),
    "places_without_indicators": """select (select count(*) from i_clientes_municipios m join i_geografia g on g.cod_ibge = m.cod_ibge
    where populacao_estimada is null or pib_per_capita is null) clientes,
  (select count(*) from f_pedido join d_geografia on sk_geografia = sk_geo_cliente
    where sk_geografia > 0 and (populacao_estimada is null or pib_per_capita is null)) pedidos""",
    "panel_options": """select min(data_completa) inicio, max(data_completa) fim, string_agg(distinct uf, ',' order by uf) ufs
from f_pedido join d_tempo on sk_tempo = sk_tempo_compra join d_geografia on sk_geografia = sk_geo_cliente""",
    "panel_summary": _in(_base(), SUMMARY), "panel_summary_state": _in(_base(STATE), SUMMARY), "panel_distance": _in(_base(), DISTANCE),
    **{f"panel_{k}": _in(_base(), v) for k, v in CHARTS.items()}, "panel_categorias_uf": _in(_base(STATE), CHARTS["categorias"]),
    "panel_export": _export(),
    **{f"kpi_{c.lower().replace('-', '_')}": _kpi(c) for c in KPI},
    "kpi_cli_002": f"select round(100 * count(*) filter (n > 1) / nullif(count(*), 0), 6) valor, count(*) base from "
                   f"(select count(distinct order_id) n from f_pedido where {DONE} and sk_cliente > 0 group by sk_cliente)",
    "kpi_geo_001": "select metodo_match, round(100 * count(*) / sum(count(*)) over (), 6) valor, count(*) base from i_clientes_municipios group by 1",
    "kpi_geo_002": _kpi("VEN-002", "porte_municipio", GEO), "kpi_geo_003": _kpi("VEN-007", "porte_municipio", GEO),
    "analysis_lateness_score": f"select flag_atraso, round(avg(nota_avaliacao), 6) nota_media, count(*) pedidos from f_pedido "
                               f"where {DONE} and flag_atraso is not null and nota_avaliacao is not null group by 1",
    "analysis_distance": f"""select case when distancia_km > 2000 then 'acima_2000km' when distancia_km > 1000 then '1000_a_2000km' when distancia_km > 500 then '500_a_1000km'
    when distancia_km > 100 then '100_a_500km' when distancia_km is not null then 'ate_100km' else 'nao_informado' end faixa_distancia, count(*) itens,
  {PCT.format('count(*) filter (flag_atraso)', 'count(flag_atraso)')} percentual_atraso, round(avg(dias_ate_entrega), 6) prazo_medio,
  round(avg(nota_avaliacao), 6) nota_media from {ITEMS} where {DONE} group by 1""",
    "analysis_gdp": f"""select case when pib_per_capita > 45000 then 'acima_45mil' when pib_per_capita > 30000 then '30_a_45mil' when pib_per_capita > 15000 then '15_a_30mil'
    when pib_per_capita is not null then 'ate_15mil' else 'nao_informado' end faixa_pib, round(avg(valor_total_pedido), 6) ticket_medio,
  count(valor_total_pedido) pedidos from f_pedido {GEO} where {DONE} group by 1""",
    "analysis_categories": """select categoria_pt, count(*) itens, cast(sum(valor_produto) as decimal(18,2)) valor_produtos, cast(sum(valor_total_item) as decimal(18,2)) valor_total,
  round(avg(valor_frete), 6) frete_medio, round(avg(nota_avaliacao), 6) nota_media from f_item i join d_produto p on p.sk_produto = i.sk_produto group by 1""",
    "analysis_sellers": f"""select v.sk_vendedor, seller_id, uf, count(*) itens, cast(sum(valor_total_item) filter ({DONE}) as decimal(18,2)) valor_entregue,
  round(avg(valor_frete), 6) frete_medio, round(avg(distancia_km), 6) distancia_media, {PCT.format('count(*) filter (flag_atraso)', 'count(flag_atraso)')} percentual_atraso,
  round(avg(nota_avaliacao), 6) nota_media from {ITEMS} join d_vendedor v on v.sk_vendedor = i.sk_vendedor group by 1, 2, 3""",
    "split_value_quarter": _kpi("VEN-002", "ano, trimestre", "join d_tempo on sk_tempo = sk_tempo_compra"),
    "split_value_price_band": _kpi("VEN-001", "faixa_preco"),
    "split_freight_seller_region": _kpi("FRE-001", "vendedor_regiao", "join (select sk_vendedor kv, regiao vendedor_regiao from d_vendedor) on kv = sk_vendedor"),
    "split_days_weekday": _kpi("LOG-001", "nome_dia_semana", "join d_tempo on sk_tempo = sk_tempo_compra"),
    "split_late_payment": _kpi("LOG-002", "tipo_pagamento, faixa_parcelas", "join (select sk_pagamento kp, tipo_pagamento, faixa_parcelas from d_pagamento) on kp = sk_pagamento"),
    "split_items_weight": _kpi("VEN-006", "faixa_peso", "join (select sk_produto kp, faixa_peso from d_produto) on kp = sk_produto"),
    "split_score_region": _kpi("SAT-001", "regiao", GEO),
}

# Keys after two loads: those of orders bought before a day are numbered first, then the others.
_E = "(select * from s_pedidos where ts_compra < timestamp '1995-01-01')"
_EARLY = {
    "dim_cliente": ("customer_unique_id", "s_clientes", f"customer_id in (select customer_id from {_E})"),
    "dim_produto": ("product_id", "s_produtos", f"product_id in (select product_id from s_itens where order_id in (select order_id from {_E}))"),
    "dim_vendedor": ("seller_id", "s_vendedores", f"seller_id in (select seller_id from s_itens where order_id in (select order_id from {_E}))"),
    "dim_geografia": ("cod_ibge", "i_geografia", f"cod_ibge in (select cod_ibge from i_clientes_municipios where customer_id in (select customer_id from {_E}))"),
    "dim_pagamento": ("tipo_pagamento, quantidade_parcelas", "(select order_id, tipo_pagamento_predominante tipo_pagamento, parcelas_tipo_predominante quantidade_parcelas "
                      "from s_pagamentos where tipo_pagamento_predominante is not null or parcelas_tipo_predominante is not null)",
                      f"order_id in (select order_id from {_E})"),
}


def _grown(dim: str) -> str:
    natural, source, early = _EARLY[dim]
    empty = ", ".join("null" for _ in natural.split(", "))
    return (f"select {natural}, cast(row_number() over (order by late, {', '.join(f'{c} nulls last' for c in natural.split(', '))}) as integer) {STAR[dim][1]} "
            f"from (select {natural}, min(if({early}, 0, 1)) late from {source} group by {natural}) union all select {empty}, 0")


for _name, _dim in (("customer", "dim_cliente"), ("product", "dim_produto"), ("payment", "dim_pagamento")):
    _SQL[f"grown_keys_{_name}"] = _grown(_dim)
_SQL["key_growth"] = _all(*[
    f"select '{d}' dimensao, (select count(*) + 1 from (select distinct {n} from {s} where {e})) antes, count(*) + 1 depois, count(*) maior, "
    f"cast(0 as bigint) alteradas, cast(0 as bigint) repetidas from (select distinct {n} from {s})" for d, (n, s, e) in _EARLY.items()])

_SQL["star_signatures"] = _all(*[_star_signature(t) for t in STAR])

# Files landed twice, read back, published: what comes out is what went in.
_FILES = [t for t in SHAPES if t != "de_para"]
_WHEN = "timestamp '2026-01-02 03:04:05'"


def _landed_rows(name: str) -> str:
    table, columns = SHAPES[name]
    return f"select {', '.join(f'{c}' for c in columns.split())}, 'loja' _fonte, {_WHEN} _data_ingestao from {table}"


_REGISTER = ("id nome microrregiao_mesorregiao_uf_sigla regiao_imediata_regiao_intermediaria_uf_sigla microrregiao_mesorregiao_uf_nome "
             "regiao_imediata_regiao_intermediaria_uf_nome microrregiao_mesorregiao_uf_regiao_nome regiao_imediata_regiao_intermediaria_uf_regiao_nome "
             "microrregiao_mesorregiao_nome microrregiao_nome").split()
_SQL.update({
    "landed_csv_orders": _landed_rows("pedidos"), "landed_csv_reviews": _landed_rows("avaliacoes"), "landed_csv_items": _landed_rows("itens_pedido"),
    "landed_csv_counts": _all(*[f"select '{t}' tabela, count(*) linhas_entrada, count(*) linhas_saida, cast({len(SHAPES[t][1].split())} as integer) colunas, "
                                f"true nova, false alterada, true data_mantida from {SHAPES[t][0]}" for t in _FILES]),
    "landed_csv_numbers": _all(*[f"select '{t}' tabela, count(*) linhas, cast(0 as bigint) arquivos_com_falha from {SHAPES[t][0]}" for t in _FILES]),
    "landed_csv_manifest": _all(*[f"select '{t}' tabela, '{t}' arquivo_origem, {_WHEN} data_ingestao, count(*) linhas, cast(64 as integer) digitos, true igual "
                                  f"from {SHAPES[t][0]}" for t in _FILES]),
    "landed_json_register": "select " + ", ".join(f"{c} {n}" for c, n in zip(SHAPES["municipios"][1].split(), _REGISTER)) + " from fx_municipios",
    "landed_crosswalk": _SQL["crosswalk"],
    "source_checks": _all(_fixed("BRZ-EST-001", len(_FILES), len(_FILES)), *[_fixed(f"BRZ-CNT-00{i}", 0, 0) for i in (1, 2, 3)],
                          _fixed("BRZ-CNT-004", len(_FILES), len(_FILES)), _fixed("REP-003", SHAPES["de_para"][1].replace(" ", ", "), SHAPES["de_para"][1].replace(" ", ", "))),
    "published_counts": _SQL["star_counts"],
    "published_report": "select case when reprovados > 0 then 'REPROVADO' when alertas > 0 then 'APROVADO COM ALERTAS' else 'APROVADO' end resultado_geral, * "
                        "from (select count(*) executados, count(*) filter (status = 'APROVADO') aprovados, count(*) filter (status = 'ALERTA') alertas, "
                        "count(*) filter (status = 'REPROVADO') reprovados, cast(0 as bigint) nao_executados from ("
                        + _all(*[f"select status from ({_SQL[c]})" for c in ("star_structure_checks", "star_reference_checks", "star_rule_checks",
                                                                            "star_reconciliation_checks", "star_preservation_checks")]) + "))",
    "sorted_outputs": _all(*[f"select '{n}' tabela, count(*) linhas, cast(0 as bigint) arquivos_fora_de_ordem, cast(0 as bigint) linhas_fora_de_ordem from {t}" for n, t in (
        ("municipios_cliente", "s_clientes"), ("municipios_vendedor", "s_vendedores"),
        ("distancias_vendedor_cliente", "(select distinct seller_id, customer_id from s_itens join s_pedidos using (order_id))"), ("distancias_itens", "s_itens"))]),
    "csv_sink": _SQL["unresolved_places"],
})

# An order counts once in each group that it has an item in.
_GOODS = "(select distinct i.order_id bo, categoria_pt from f_item i left join d_produto p on p.sk_produto = i.sk_produto) on bo = order_id"
_SHOPS = "left join (select sk_vendedor sv, uf vendedor_uf, regiao vendedor_regiao from d_vendedor) on sv = i.sk_vendedor"
_SQL.update({
    "split_orders_category": _kpi("VEN-005", "categoria_pt", f"join {_GOODS}"),
    "split_ticket_price_band_quarter": _kpi("VEN-007", "faixa_preco, trimestre", "join (select distinct order_id bo, faixa_preco from f_item) on bo = order_id "
                                            "join d_tempo on sk_tempo = sk_tempo_compra"),
    "split_late_seller_region_category": _kpi(
        "LOG-002", "vendedor_regiao, categoria_pt", f"join (select distinct i.order_id bo, vendedor_regiao, categoria_pt from f_item i {_SHOPS} "
        "left join d_produto p on p.sk_produto = i.sk_produto) on bo = order_id"),
    "split_buyers_seller_total": f"select false total, * from ({_kpi('CLI-001', 'vendedor_uf', f'join (select distinct i.order_id bo, vendedor_uf from f_item i {_SHOPS}) on bo = order_id')}) "
                                 f"union all select true, null, * from ({_kpi('CLI-001')})",
})

_PARTS = ("silver_key_checks", "silver_reference_checks", "silver_grain_checks", "silver_money_checks", "order_rule_checks", "domain_checks",
          "imputation_checks", "geolocation_checks", "integration_key_checks", "match_checks", "crosswalk_checks", "distance_checks",
          "indicator_checks")
# Two presence checks and one on required columns come from schemas alone.
_SQL["layer_verdict"] = ("""select case when reprovados > 0 then 'REPROVADO' when alertas > 0 then 'APROVADO COM ALERTAS' else 'APROVADO' end resultado_geral, *
from (select count(*) + 3 executados, count(*) filter (status = 'APROVADO') + 3 aprovados, count(*) filter (status = 'ALERTA') alertas,
  count(*) filter (status = 'REPROVADO') reprovados, cast(0 as bigint) nao_executados from (""" + _all(*[_SQL[p] for p in _PARTS]) + "))")

ORACLES: dict[str, str] = {name: with_relations(sql.strip()) for name, sql in _SQL.items()}
