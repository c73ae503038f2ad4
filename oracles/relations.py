"""Plain SQL for every derived relation, for an independent engine to run.

Each entry is the body of one named subquery. ``with_relations`` prepends the
ones a query needs, in dependency order.
"""

from __future__ import annotations

import re

STAMP = "'%Y-%m-%d %H:%M:%S'"


def _later(day: str, days: str, hours: str = "0") -> str:
    return f"{day} + to_days(cast({days} as int)) + to_hours(cast({hours} as int))"


def _stamp(expr: str) -> str:
    return f"strftime({expr}, {STAMP})"


def _norm(c: str) -> str:
    return (f"coalesce(trim(regexp_replace(regexp_replace(strip_accents(lower({c})), '[^a-z0-9 ]', ' ', 'g'),"
            f" ' +', ' ', 'g')), '')")


def _tight(c: str) -> str:
    return f"replace({_norm(c)}, ' ', '')"


def _num(c: str, kind: str) -> str:
    return f"cast(nullif(trim({c}), '') as {kind})"


def _km(a: str, b: str, c: str, d: str) -> str:
    return (f"2 * 6371.0088 * asin(sqrt(sin(radians({c} - {a}) / 2) ** 2 + cos(radians({a})) * cos(radians({c}))"
            f" * sin(radians({d} - {b}) / 2) ** 2))")


K, D = "o_orderkey", "o_orderdate"
PRICE = "cast(cast(cast(round(l_extendedprice * 100) as bigint) % 30000 as decimal(18,2)) * 0.01 as decimal(18,2))"


def _city(k: str) -> str:
    return (f"case {k} % 6 when 0 then upper('são ' || n_name) when 1 then 'São ' || n_name"
            f" when 2 then 'sao' || replace(lower(n_name), '_', '') when 3 then ' SAO-' || n_name"
            f" when 4 then 'são ' || lower(n_name) else 'vila ' || cast({k} % 9 as varchar) end")


def _state(k: str) -> str:
    return f"case when {k} % 6 = 4 then 'XX' else 'R' || cast(n_regionkey as varchar) end"


def _size(expr: str, gap: int) -> str:
    return f"case when p_partkey % {gap} = 0 then '' else cast({expr} as varchar) end"


def _tenths(start: int, span: int) -> str:
    return f"cast(cast({start} + (p % {span}) * 10 + event_id % 7 as decimal(18,0)) * 0.01 as decimal(18,2))"


RELATIONS: dict[str, str] = {
    # landed text
    "fx_pedidos": f"""
select cast({K} as varchar) order_id, cast(o_custkey as varchar) customer_id,
  case o_orderstatus when 'F' then 'delivered' when 'O' then 'shipped' else 'canceled' end order_status,
  {_stamp(_later(D, '0', f'{K} % 24'))} order_purchase_timestamp,
  case when {K} % 53 = 0 then '' else {_stamp(_later(D, '1', f'{K} % 24'))} end order_approved_at,
  case when {K} % 59 = 0 then ' ' else {_stamp(_later(D, f'{K} % 5', '3'))} end order_delivered_carrier_date,
  case when {K} % 97 = 0 then '' else {_stamp(_later(D, f'{K} % 40', f'({K} * 7) % 24'))} end order_delivered_customer_date,
  {_stamp(_later(D, '20'))} order_estimated_delivery_date
from orders""",
    "fx_itens": f"""
select cast(l_orderkey as varchar) order_id, cast((r - 1) * 4096 + b + 1 as varchar) order_item_id,
  cast(l_partkey as varchar) product_id, cast(l_suppkey as varchar) seller_id,
  {_stamp('l_shipdate')} shipping_limit_date,
  case when l_partkey % 211 = 0 then '' else cast({PRICE} as varchar) end price,
  cast(cast(l_quantity * case when l_orderkey % 50 = 0 then 10 else 1 end as decimal(18,2)) as varchar) freight_value
from (select *, row_number() over (partition by l_orderkey, b
        order by l_linenumber, l_partkey, l_suppkey, l_shipdate, l_extendedprice) r
      from (select *, (l_partkey * 31 + l_suppkey * 7 + l_linenumber) % 4096 b from lineitem))""",
    "fx_pagamentos": """
select cast(l_orderkey as varchar) order_id, cast(l_linenumber as varchar) payment_sequential,
  case l_returnflag when 'A' then 'boleto' when 'N' then 'credit_card' else 'voucher' end payment_type,
  cast(l_linenumber * 2 - 1 as varchar) payment_installments,
  cast(cast(l_quantity as decimal(18,2)) as varchar) payment_value
from lineitem""",
    "fx_avaliacoes": f"""
select cast(event_id as varchar) review_id, cast((event_id * 2) // 5 as varchar) order_id,
  cast(1 + event_id % 5 as varchar) review_score,
  case when event_id % 3 = 0 then event_type else '' end review_comment_title,
  case when event_id % 4 = 0 then ' ' || event_type || ' ' else ' ' end review_comment_message,
  {_stamp('cast(cast(ts as date) as timestamp)')} review_creation_date, {_stamp('ts')} review_answer_timestamp
from events""",
    "fx_produtos": f"""
select cast(p_partkey as varchar) product_id,
  case when p_partkey % 50 = 0 then '' when p_partkey % 500 = 1 then 'rara' else lower(p_type) end product_category_name,
  {_size('p_size * 700', 11)} product_weight_g, {_size('p_size + 10', 13)} product_length_cm,
  {_size('p_size + 5', 17)} product_height_cm, {_size('p_size + 7', 19)} product_width_cm
from part""",
    "fx_traducao": """
select distinct lower(if(p_type = 'PROMO', 'outro ' || p_type, p_type)) product_category_name, p_type product_category_name_english
from part""",
    "fx_clientes": f"""
select cast(c_custkey as varchar) customer_id, 'u' || cast(c_custkey * 2 // 3 as varchar) customer_unique_id,
  lpad(cast(c_custkey // 3 as varchar), 5, '0') customer_zip_code_prefix,
  {_city('c_custkey')} customer_city, {_state('c_custkey')} customer_state
from customer join nation on c_nationkey = n_nationkey""",
    "fx_vendedores": f"""
select cast(s_suppkey as varchar) seller_id, lpad(cast(s_suppkey * 5 + s_suppkey % 40 as varchar), 5, '0') seller_zip_code_prefix,
  {_city('s_suppkey')} seller_city, {_state('s_suppkey')} seller_state
from supplier join nation on s_nationkey = n_nationkey""",
    "fx_geolocalizacao": f"""
select lpad(cast(event_id // 20 as varchar), 5, '0') geolocation_zip_code_prefix,
  case when event_id % 89 = 0 or p = 519 then '' when event_id % 83 = 0 then '95.00'
    else cast({_tenths(-3300, 380)} as varchar) end geolocation_lat,
  cast({_tenths(-7400, 400)} as varchar) geolocation_lng,
  case when event_id % 13 = 0 then 'sao' || replace(lower(n_name), '_', '')
    when event_id % 17 = 0 then 'ilha ' || lower(n_name) else 'são ' || lower(n_name) end geolocation_city,
  'R' || cast(n_regionkey as varchar) geolocation_state
from (select event_id, (event_id // 20) % 520 p from events)
join nation on n_nationkey = case when event_id % 11 = 0 then (p + 5) % 25 else p // 21 end""",
    "fx_municipios": """
select cast(1100000 + n_nationkey as varchar) id, 'São ' || n_name nome,
  case when n_nationkey % 7 = 0 then '' else 'R' || cast(n_regionkey as varchar) end uf_a,
  'R' || cast(n_regionkey as varchar) uf_b,
  case when n_nationkey % 7 = 0 then '' else r_name end nome_a, r_name nome_b,
  case when n_nationkey % 7 = 0 then '' else lower(r_name) end regiao_a, lower(r_name) regiao_b,
  case when n_nationkey % 7 = 0 then '' else 'R' || cast(n_regionkey as varchar) end meso,
  case when n_nationkey % 7 = 0 then '' else n_name end micro
from nation join region on n_regionkey = r_regionkey""",
    "fx_indicadores": """
select cast(1100000 + n_nationkey as varchar) cod_ibge, '2017' ano_referencia,
  case when n_nationkey = 24 then '' else cast(n_nationkey * 30000 as varchar) end populacao_estimada,
  case when n_nationkey = 24 then ''
    else cast(cast(10000.50 + n_nationkey * 1234.25 as decimal(18,2)) as varchar) end pib_per_capita
from nation""",
    "fx_de_para": """
select if(n_regionkey = 2, 'Outra ', 'São ') || n_name cidade_origem, ' xx ' uf_origem, cast(1100000 + n_nationkey as varchar) cod_ibge,
  'uf divergente: ' || n_name justificativa
from nation""",
    # cleaned
    "s_pedidos": f"""
select *, status_pedido = 'delivered' and ts_entrega_cliente is null flag_entrega_ausente,
  if(status_pedido = 'delivered', cast(ts_entrega_cliente as date) - cast(ts_compra as date), null) dias_ate_entrega,
  if(status_pedido = 'delivered', cast(ts_entrega_cliente as date) - cast(ts_estimativa_entrega as date), null) dias_atraso,
  if(status_pedido = 'delivered', cast(ts_entrega_cliente as date) > cast(ts_estimativa_entrega as date), null) flag_atraso,
  strftime(ts_compra, '%Y-%m') ano_mes_compra
from (select order_id, customer_id, order_status status_pedido,
  {_num('order_purchase_timestamp', 'timestamp')} ts_compra, {_num('order_approved_at', 'timestamp')} ts_aprovacao,
  {_num('order_delivered_carrier_date', 'timestamp')} ts_envio_transportadora,
  {_num('order_delivered_customer_date', 'timestamp')} ts_entrega_cliente,
  {_num('order_estimated_delivery_date', 'timestamp')} ts_estimativa_entrega from fx_pedidos)""",
    "s_itens_base": f"""
select order_id, {_num('order_item_id', 'integer')} item_pedido_id, product_id, seller_id,
  {_num('shipping_limit_date', 'timestamp')} ts_limite_envio,
  {_num('price', 'decimal(18,2)')} preco_produto, {_num('freight_value', 'decimal(18,2)')} valor_frete
from fx_itens""",
    "s_cercas": """
select quantile_cont(valor_frete, 0.25) q1, quantile_cont(valor_frete, 0.75) q3 from s_itens_base""",
    "s_itens": """
select b.*, cast(preco_produto + valor_frete as decimal(18,2)) valor_total_item,
  case when preco_produto is null then 'nao_informado' when preco_produto > 134.90 then 'alto'
    when preco_produto > 74.99 then 'medio_alto' when preco_produto > 39.90 then 'medio_baixo' else 'baixo' end faixa_preco,
  valor_frete > (select q3 + 1.5 * (q3 - q1) from s_cercas) flag_frete_outlier
from s_itens_base b""",
    "s_pag_base": f"""
select order_id, payment_type, {_num('payment_installments', 'integer')} n, {_num('payment_value', 'decimal(18,2)')} v
from fx_pagamentos""",
    "s_pagamentos": """
select order_id, cast(valor as decimal(18,2)) valor_total_pago, qtd qtd_transacoes, metodos qtd_metodos_distintos,
  payment_type tipo_pagamento_predominante, parcelas parcelas_tipo_predominante
from (select order_id, payment_type, max(n) parcelas, sum(sum(v)) over w valor, cast(sum(count(*)) over w as bigint) qtd,
        count(*) over w metodos,
        row_number() over (partition by order_id order by sum(v) desc nulls last, payment_type) r
      from s_pag_base group by order_id, payment_type window w as (partition by order_id))
where r = 1""",
    "s_avaliacoes": f"""
select * from (
  select order_id, review_id, {_num('review_score', 'integer')} nota_review,
    nullif(trim(review_comment_title), '') titulo_review, nullif(trim(review_comment_message), '') mensagem_review,
    {_num('review_creation_date', 'timestamp')} ts_criacao_review, {_num('review_answer_timestamp', 'timestamp')} ts_resposta_review,
    count(*) over (partition by order_id) > 1 flag_avaliacao_duplicada_pedido
  from fx_avaliacoes)
qualify row_number() over (partition by order_id order by ts_criacao_review desc nulls last,
  ts_resposta_review desc nulls last, review_id desc) = 1""",
    "s_prod_base": f"""
select product_id, coalesce(nullif(trim(product_category_name), ''), 'nao_informado') c,
  {_num('product_weight_g', 'double')} w, {_num('product_length_cm', 'double')} l,
  {_num('product_height_cm', 'double')} h, {_num('product_width_cm', 'double')} b
from fx_produtos""",
    "s_prod_med": """
select c mc, if(count(w) >= 5, median(w), null) mw, if(count(l) >= 5, median(l), null) ml,
  if(count(h) >= 5, median(h), null) mh, if(count(b) >= 5, median(b), null) mb
from s_prod_base group by c""",
    "s_produtos": """
select product_id, c categoria_produto, coalesce(product_category_name_english, c) categoria_produto_ingles,
  c <> 'nao_informado' and product_category_name_english is null flag_categoria_sem_traducao,
  coalesce(w, mw) peso_g, coalesce(l, ml) comprimento_cm, coalesce(h, mh) altura_cm, coalesce(b, mb) largura_cm,
  w is null and mw is not null flag_peso_imputado,
  (l is null and ml is not null) or (h is null and mh is not null) or (b is null and mb is not null) flag_dimensoes_imputadas
from s_prod_base left join fx_traducao on product_category_name = c left join s_prod_med on mc = c""",
    "s_clientes": """
select customer_id, customer_unique_id, customer_zip_code_prefix cep_prefixo, trim(customer_city) cidade, trim(customer_state) uf
from fx_clientes""",
    "s_vendedores": """
select seller_id, seller_zip_code_prefix cep_prefixo, trim(seller_city) cidade, trim(seller_state) uf from fx_vendedores""",
    "s_pontos": f"""
select *, not coalesce(latitude between -34 and 6 and longitude between -75 and -33, false) flag_coordenada_invalida
from (select geolocation_zip_code_prefix cep_prefixo, {_num('geolocation_lat', 'double')} latitude,
  {_num('geolocation_lng', 'double')} longitude, trim(geolocation_city) cidade, trim(geolocation_state) uf
  from fx_geolocalizacao)""",
    "s_moda": """
select cep_prefixo mp, cidade, uf from s_pontos where not flag_coordenada_invalida group by cep_prefixo, cidade, uf
qualify row_number() over (partition by cep_prefixo order by count(*) desc, cidade, uf) = 1""",
    "s_cep": """
select cep_prefixo, median(latitude) filter (not flag_coordenada_invalida) latitude_mediana,
  median(longitude) filter (not flag_coordenada_invalida) longitude_mediana,
  count(*) filter (not flag_coordenada_invalida) qtd_pontos_validos,
  count(*) filter (flag_coordenada_invalida) qtd_pontos_invalidos,
  any_value(m.cidade) cidade_predominante, any_value(m.uf) uf_predominante
from s_pontos p join s_moda m on mp = cep_prefixo group by cep_prefixo""",
    "s_municipios": f"""
select id cod_ibge, nome municipio, {_norm('nome')} municipio_normalizado,
  coalesce(nullif(uf_a, ''), uf_b) uf, coalesce(nullif(nome_a, ''), nome_b) nome_uf,
  coalesce(nullif(regiao_a, ''), regiao_b) regiao, nullif(meso, '') mesorregiao, nullif(micro, '') microrregiao,
  {_num('populacao_estimada', 'bigint')} populacao, {_num('pib_per_capita', 'decimal(18,2)')} pib_per_capita,
  {_num('ano_referencia', 'integer')} ano_referencia_indicadores,
  case when nullif(populacao_estimada, '') is null then 'Não informado'
    when cast(populacao_estimada as bigint) > 500000 then 'Grande'
    when cast(populacao_estimada as bigint) >= 50000 then 'Médio' else 'Pequeno' end porte_municipio
from fx_municipios left join fx_indicadores on cod_ibge = id""",
    # places
    "i_ref": f"""
select *, count(*) over (partition by uf, chave_sem_espaco) = 1 chave_unica_na_uf
from (select *, {_tight('municipio')} chave_sem_espaco from s_municipios)""",
    "i_coord": "select cep_prefixo, latitude_mediana latitude, longitude_mediana longitude from s_cep where latitude_mediana is not null",
    "i_de_para": f"""
select {_norm('cidade_origem')} cidade_normalizada, upper(trim(uf_origem)) uf, trim(cod_ibge) cod_ibge, justificativa from fx_de_para""",
    "i_cep_exato": f"""
select cep_prefixo, p.uf_predominante uf, latitude_mediana latitude, longitude_mediana longitude,
  coalesce(a.cod_ibge, b.cod_ibge) cod_ibge
from s_cep p left join i_ref a on a.uf = uf_predominante and a.municipio_normalizado = {_norm('cidade_predominante')}
left join i_ref b on b.uf = uf_predominante and b.chave_sem_espaco = {_tight('cidade_predominante')} and b.chave_unica_na_uf
where coalesce(a.cod_ibge, b.cod_ibge) is not null""",
    "i_centro": """
select cod_ibge, uf, median(latitude) latitude_representativa, median(longitude) longitude_representativa, count(*) qtd_prefixos
from i_cep_exato group by all""",
}

for _ent, _key, _src in (("clientes", "customer_id", "s_clientes"), ("vendedores", "seller_id", "s_vendedores")):
    RELATIONS[f"i_nome_{_ent}"] = f"""
select e.{_key} id_entidade, e.cep_prefixo, e.cidade cidade_original, {_norm('e.cidade')} cidade_normalizada, e.uf,
  coalesce(a.cod_ibge, b.cod_ibge) exato, if(coalesce(a.cod_ibge, b.cod_ibge) is null, d.cod_ibge, null) manual
from {_src} e left join i_ref a on a.uf = e.uf and a.municipio_normalizado = {_norm('e.cidade')}
left join i_ref b on b.uf = e.uf and b.chave_sem_espaco = {_tight('e.cidade')} and b.chave_unica_na_uf
left join i_de_para d on d.uf = e.uf and d.cidade_normalizada = {_norm('e.cidade')}"""
    RELATIONS[f"i_perto_{_ent}"] = f"""
select id_entidade pid, cod_ibge perto, km from (
  select n.id_entidade, c.cod_ibge,
    {_km('g.latitude', 'g.longitude', 'c.latitude_representativa', 'c.longitude_representativa')} km
  from i_nome_{_ent} n join i_coord g on g.cep_prefixo = n.cep_prefixo join i_centro c on c.uf = n.uf
  where exato is null and manual is null)
where km <= 50 qualify row_number() over (partition by id_entidade order by km, cod_ibge) = 1"""
    RELATIONS[f"i_mapa_{_ent}"] = f"""
select id_entidade, n.cep_prefixo, cidade_original, cidade_normalizada, uf, coalesce(exato, manual, perto) cod_ibge,
  case when exato is not null then 'exato' when manual is not null then 'de_para'
    when perto is not null then 'geografico' else 'nao_resolvido' end metodo_match,
  cast(km as decimal(10,2)) distancia_match_km, g.latitude, g.longitude,
  case when coalesce(exato, manual, perto) is not null then null
    when g.latitude is null then 'prefixo de CEP sem coordenada valida'
    else 'sem nome correspondente no IBGE e nenhum centroide a ate 50.0 km na UF' end motivo_nao_resolvido
from i_nome_{_ent} n left join i_perto_{_ent} on pid = id_entidade left join i_coord g on g.cep_prefixo = n.cep_prefixo"""

RELATIONS.update({
    "i_clientes_municipios": """
select id_entidade customer_id, cod_ibge, if(metodo_match = 'de_para', 'manual', metodo_match) metodo_match,
  cast(distancia_match_km as double) distancia_match_km, latitude latitude_cliente, longitude longitude_cliente,
  cidade_original, cidade_normalizada, uf, motivo_nao_resolvido from i_mapa_clientes""",
    "i_vendedores_municipios": """
select id_entidade seller_id, cod_ibge, if(metodo_match = 'de_para', 'manual', metodo_match) metodo_match,
  cast(distancia_match_km as double) distancia_match_km, latitude latitude_vendedor, longitude longitude_vendedor,
  cidade_original, cidade_normalizada, uf, motivo_nao_resolvido from i_mapa_vendedores""",
    "i_geografia": """
select m.cod_ibge, municipio, municipio_normalizado, m.uf, nome_uf, regiao, populacao populacao_estimada, pib_per_capita,
  ano_referencia_indicadores, porte_municipio, latitude_representativa, longitude_representativa
from i_ref m left join i_centro c on c.cod_ibge = m.cod_ibge""",
    "i_pares": f"""
select p.seller_id, p.customer_id,
  cast({_km('cv.latitude_representativa', 'cv.longitude_representativa', 'cc.latitude_representativa', 'cc.longitude_representativa')}
    as decimal(10,2)) distancia_km,
  v.metodo_match <> 'exato' or c.metodo_match <> 'exato' flag_distancia_estimada
from (select distinct seller_id, customer_id from s_itens join s_pedidos using (order_id)) p
left join i_mapa_vendedores v on v.id_entidade = seller_id left join i_mapa_clientes c on c.id_entidade = customer_id
left join i_centro cv on cv.cod_ibge = v.cod_ibge left join i_centro cc on cc.cod_ibge = c.cod_ibge""",
    "i_dist": f"""
select order_id, order_item_id, {_km('va', 'vo', 'ca', 'co')} distancia_km,
  va is not null and ca is not null flag_distancia_calculada,
  case when va is null and ca is null then 'prefixo de CEP do vendedor e do cliente sem coordenada valida'
    when va is null then 'prefixo de CEP do vendedor sem coordenada valida'
    when ca is null then 'prefixo de CEP do cliente sem coordenada valida' end motivo_distancia_ausente
from (select order_id, item_pedido_id order_item_id, v.latitude va, v.longitude vo, c.latitude ca, c.longitude co
  from s_itens join s_pedidos using (order_id) left join i_mapa_vendedores v on v.id_entidade = seller_id
  left join i_mapa_clientes c on c.id_entidade = customer_id)""",
    "i_cidades": f"""
select uf estado, cn cidade_norm, median(latitude) lat_representativa, median(longitude) lng_representativa, count(*) qte_pontos
from (select {_num('geolocation_lat', 'double')} latitude, {_num('geolocation_lng', 'double')} longitude,
    {_norm('geolocation_city')} cn, geolocation_state uf from fx_geolocalizacao)
where latitude between -34 and 5.5 and longitude between -74 and -34 group by all""",
    "i_prototipo": """
select estado, cidade_norm, lat_representativa, lng_representativa, qte_pontos, lpad(coalesce(a.cod_ibge, b.cod_ibge), 7, '0') cod_ibge,
  case when a.cod_ibge is not null then 'nome_identico' when b.cod_ibge is not null then 'sem_espacos' end variante_match,
  if(coalesce(a.cod_ibge, b.cod_ibge) is not null, 'exato', null) metodo_match
from i_cidades left join i_ref a on a.uf = estado and a.municipio_normalizado = cidade_norm
left join i_ref b on b.uf = estado and b.chave_sem_espaco = replace(cidade_norm, ' ', '') and b.chave_unica_na_uf""",
    # star
    "d_limites": """
select least(date '2016-01-01', min(d)) a, greatest(date '2018-12-31', max(d)) b
from (select unnest([cast(ts_compra as date), cast(ts_entrega_cliente as date)]) d from s_pedidos)""",
    "d_tempo": """
select cast(row_number() over (order by d) as integer) sk_tempo, d data_completa, cast(day(d) as integer) dia,
  ['segunda-feira','terça-feira','quarta-feira','quinta-feira','sexta-feira','sábado','domingo'][isodow(d)] nome_dia_semana,
  cast(isodow(d) as integer) numero_dia_semana, cast(week(d) as integer) semana_ano, cast(month(d) as integer) mes,
  ['janeiro','fevereiro','março','abril','maio','junho','julho','agosto','setembro','outubro','novembro','dezembro'][month(d)] nome_mes,
  cast(quarter(d) as integer) trimestre, cast(year(d) as integer) ano, strftime(d, '%Y-%m') ano_mes, isodow(d) > 5 fim_de_semana
from (select cast(unnest(range(a, b + 1, interval 1 day)) as date) d from d_limites)
union all select 0, null, null, 'nao_informado', null, null, null, 'nao_informado', null, null, 'nao_informado', null""",
    "d_cliente": """
select cast(row_number() over (order by u) as integer) sk_cliente, u customer_unique_id
from (select distinct customer_unique_id u from s_clientes) union all select 0, null""",
    "d_produto": """
select cast(row_number() over (order by product_id) as integer) sk_produto, product_id, categoria_produto categoria_pt,
  categoria_produto_ingles categoria_en, peso_g peso_gramas, comprimento_cm, altura_cm, largura_cm,
  comprimento_cm * altura_cm * largura_cm volume_cm3,
  case when peso_g > 20000 then 'acima_20kg' when peso_g > 5000 then '5_a_20kg' when peso_g > 1000 then '1_a_5kg'
    when peso_g is not null then 'ate_1kg' else 'nao_informado' end faixa_peso,
  flag_peso_imputado peso_imputado, flag_dimensoes_imputadas dimensoes_imputadas, flag_categoria_sem_traducao
from s_produtos
union all select 0, null, 'nao_informado', 'nao_informado', null, null, null, null, null, 'nao_informado', null, null, null""",
    "d_geografia": """
select cast(row_number() over (order by cod_ibge) as integer) sk_geografia, cod_ibge, municipio, uf, nome_uf, regiao,
  populacao_estimada, pib_per_capita, porte_municipio, ano_referencia_indicadores, latitude_representativa, longitude_representativa
from i_geografia
union all select 0, null, 'nao_informado', 'nao_informado', 'nao_informado', 'nao_informado', null, null, 'Não informado', null, null, null""",
    "d_vendedor": """
select cast(row_number() over (order by v.seller_id) as integer) sk_vendedor, v.seller_id, v.cidade, coalesce(g.uf, v.uf) uf,
  m.cod_ibge, g.municipio municipio_ibge, g.regiao, m.metodo_match metodo_match_municipio
from s_vendedores v join i_vendedores_municipios m on m.seller_id = v.seller_id left join i_geografia g on g.cod_ibge = m.cod_ibge
union all select 0, null, 'nao_informado', 'nao_informado', null, 'nao_informado', 'nao_informado', 'nao_resolvido'""",
    "d_pagamento": """
select cast(row_number() over (order by t nulls last, q nulls last) as integer) sk_pagamento, t tipo_pagamento, q quantidade_parcelas,
  case when q > 12 then 'acima_12' when q > 6 then '7_a_12' when q > 3 then '4_a_6' when q > 1 then '2_a_3'
    when q = 1 then '1_parcela' else 'nao_informado' end faixa_parcelas
from (select distinct tipo_pagamento_predominante t, parcelas_tipo_predominante q from s_pagamentos)
where t is not null or q is not null
union all select 0, null, null, 'nao_informado'""",
    "c_pedido": """
select p.*, coalesce(tc.sk_tempo, 0) sk_tempo_compra, coalesce(te.sk_tempo, 0) sk_tempo_entrega,
  coalesce(dc.sk_cliente, 0) sk_cliente, coalesce(dg.sk_geografia, 0) sk_geo_cliente, coalesce(dp.sk_pagamento, 0) sk_pagamento,
  a.nota_review nota_avaliacao, a.order_id is not null flag_possui_avaliacao, pa.valor_total_pago, m.metodo_match metodo_match_municipio
from s_pedidos p join s_clientes c on c.customer_id = p.customer_id join i_clientes_municipios m on m.customer_id = p.customer_id
left join d_cliente dc on dc.customer_unique_id = c.customer_unique_id left join d_geografia dg on dg.cod_ibge = m.cod_ibge
left join d_tempo tc on tc.data_completa = cast(ts_compra as date)
left join d_tempo te on te.data_completa = if(status_pedido = 'delivered', cast(ts_entrega_cliente as date), null)
left join s_pagamentos pa on pa.order_id = p.order_id
left join d_pagamento dp on dp.tipo_pagamento = pa.tipo_pagamento_predominante and dp.quantidade_parcelas = pa.parcelas_tipo_predominante
left join s_avaliacoes a on a.order_id = p.order_id""",
    "c_total": """
select order_id, count(*) n, count(distinct seller_id) nv, count(distinct product_id) np,
  if(bool_or(preco_produto is null), null, sum(preco_produto)) vp, if(bool_or(valor_frete is null), null, sum(valor_frete)) vf,
  if(bool_or(valor_total_item is null), null, sum(valor_total_item)) vt
from s_itens group by order_id""",
    "f_pedido": """
select p.order_id, sk_tempo_compra, sk_tempo_entrega, sk_cliente, sk_geo_cliente, sk_pagamento, status_pedido,
  coalesce(n, 0) quantidade_itens, coalesce(nv, 0) quantidade_vendedores, coalesce(np, 0) quantidade_produtos,
  cast(if(t.order_id is null, 0, vp) as decimal(18,2)) valor_produtos, cast(if(t.order_id is null, 0, vf) as decimal(18,2)) valor_frete,
  cast(if(t.order_id is null, 0, vt) as decimal(18,2)) valor_total_pedido, valor_total_pago, dias_ate_entrega, dias_atraso,
  flag_atraso, nota_avaliacao, status_pedido = 'delivered' flag_entregue, flag_possui_avaliacao, flag_entrega_ausente, metodo_match_municipio
from c_pedido p left join c_total t on t.order_id = p.order_id""",
    "f_item": """
select i.order_id, i.item_pedido_id order_item_id, sk_tempo_compra, sk_tempo_entrega, coalesce(sk_produto, 0) sk_produto, sk_cliente,
  coalesce(sk_vendedor, 0) sk_vendedor, sk_geo_cliente, sk_pagamento, preco_produto valor_produto, i.valor_frete, valor_total_item,
  dias_ate_entrega, dias_atraso, flag_atraso, distancia_km, nota_avaliacao, flag_frete_outlier flag_outlier_frete, faixa_preco,
  flag_distancia_calculada, motivo_distancia_ausente
from s_itens i join f_pedido p on p.order_id = i.order_id
join i_dist d on d.order_id = i.order_id and d.order_item_id = i.item_pedido_id
left join d_produto pr on pr.product_id = i.product_id left join d_vendedor v on v.seller_id = i.seller_id""",
})

_NAMES = re.compile(r"\b(?:fx|s|i|d|c|f|x)_[a-z_]+\b")


def with_relations(sql: str, extra: dict[str, str] | None = None) -> str:
    """Prefix ``sql`` with the named subqueries it uses."""
    pool = {**RELATIONS, **(extra or {})}
    order: list[str] = []

    def visit(text: str) -> None:
        for name in _NAMES.findall(text):
            if name in pool and name not in order:
                visit(pool[name])
                if name not in order:
                    order.append(name)

    visit(sql)
    if not order:
        return sql
    # Relations with several uses are computed once.
    return "with " + ",\n".join(f"{n} as materialized ({pool[n].strip()})" for n in order) + "\n" + sql
